"""pulseline — playback-heartbeat analytics on Spark.

Heartbeat events (video-player telemetry) are decoded, validated,
deduplicated by ``event_id`` and aggregated into per-session playback KPIs
(video start time, playback failure rate, rebuffering ratio), in batch and in
Structured Streaming, together with operational reports (ingestion rate,
latency, service levels, dead letters).

Every operator is a plain function ``DataFrame -> DataFrame`` built from
Spark SQL expressions, so Catalyst plans and Tungsten executes it.
"""

from pulseline.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
