"""Operational reports over event, dead-letter and request-log tables.

The reference keeps counters and timers in process and lets a dashboard
evaluate rate/ratio expressions; here they are aggregates over tables or
streams (AGG-10…AGG-14, AGG-16…AGG-19, FLT-8, FN-9). Every report is one
hash aggregate (partial + final); none needs an ordering or a collect.

Request log schema: ``request_id, received_at (timestamp_ntz), latency_ns
(bigint), error (boolean)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseline.functions.scalars import nanos_to_whole_ms, safe_ratio, seconds_to_ms

# Fixed values — service-level limits: ingest latency breach threshold (ms),
# p99 latency limit (ms), error-rate limit, rejected-per-window alert threshold.
SLA_BREACH_MS = 5
P99_LIMIT_MS = 200.0
ERROR_RATE_LIMIT = 0.01
OVERFLOW_ALERT_THRESHOLD = 50


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * scale


def _window(ts: str, window: str, slide: str | None):
    return F.window(ts, window, slide) if slide else F.window(ts, window)


def ingest_summary(decoded: DataFrame, with_stored: bool = False,
                   key: str = "event_id") -> DataFrame:
    """consumed / ok / dead-lettered counts of a decode result (AGG-10).

    ``with_stored`` adds the rows a raw table without earlier rows takes (one
    per id) and the duplicates it absorbs. Rows are counted per (outcome, id)
    first, so the input is decoded once and a frequent id is one counter.
    """
    ok = F.col("decode_error").isNull()
    if not with_stored:
        return decoded.agg(F.count(F.lit(1)).alias("consumed"), F.count_if(ok).alias("ok"),
                           F.count_if(~ok).alias("dead_lettered"))
    per_id = (decoded.select(ok.alias("__ok"), F.when(ok, F.col(key)).alias("__id"))
                     .groupBy("__ok", "__id").agg(F.count(F.lit(1)).alias("__n")))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("__n"))), F.lit(0))
    return per_id.agg(total(F.lit(True)).alias("consumed"), total(F.col("__ok")).alias("ok"),
                      total(~F.col("__ok")).alias("dead_lettered"),
                      F.count_if(F.col("__ok")).alias("stored_new")).withColumn(
                          "duplicates", F.col("ok") - F.col("stored_new"))


def dead_letters_by_reason(dead: DataFrame) -> DataFrame:
    """Dead letters per reason (AGG-11)."""
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("dead_letters"))


def ingestion_rate(df: DataFrame, ts: str = "ts", window: str = "1 minute",
                   slide: str | None = None) -> DataFrame:
    """Events and events/s per event-time window (AGG-12).

    The dashboard's ``rate(x[1m])`` re-evaluated every 15 s is a 1-minute
    window sliding by 15 s: ``window="1 minute", slide="15 seconds"``. Counts
    are exact events in [start, end) divided by the window length; there is
    no extrapolation as in PromQL. Only non-empty windows are returned.
    """
    secs = float(_seconds(window))
    if slide and _seconds(window) % _seconds(slide) == 0:
        agg = _by_panes(df, ts, window, slide)
    else:
        agg = df.groupBy(_window(ts, window, slide).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return agg.select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "events",
                      (F.col("events") / F.lit(secs)).alias("events_per_s"))


def _by_panes(df: DataFrame, ts: str, window: str, slide: str) -> DataFrame:
    """Events per sliding window: rows are counted once, per pane of one slide.

    Only the panes, one row per slide of time, are then copied to the windows
    that contain them, instead of every row.
    """
    panes = df.groupBy(F.window(ts, slide).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    whole, step = (F.expr(f"INTERVAL {_seconds(d)} SECONDS") for d in (window, slide))
    start = F.explode(F.sequence(F.col("p.end") - whole, F.col("p.start"), step))
    per = panes.select(start.alias("start"), "n").groupBy("start").agg(F.sum("n").alias("events"))
    return per.select(F.struct(F.col("start"), (F.col("start") + whole).alias("end")).alias("w"), "events")


def throughput_compare(ingested: DataFrame, consumed: DataFrame, ts: str = "ts",
                       window: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Ingested/s next to consumed/s per window (AGG-14).

    Equivalent to a full outer join of two rate series with 0 for a missing
    side, computed as ONE aggregate over the tagged union (one shuffle
    instead of three).
    """
    secs = float(_seconds(window))
    both = (ingested.select(F.col(ts).alias("__t"), F.lit(True).alias("__in"))
            .unionByName(consumed.select(F.col(ts).alias("__t"), F.lit(False).alias("__in"))))
    agg = both.groupBy(_window("__t", window, slide).alias("w")).agg(
        F.count_if(F.col("__in")).alias("ingested"),
        F.count_if(~F.col("__in")).alias("consumed"))
    return agg.select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "ingested", "consumed",
                      (F.col("ingested") / F.lit(secs)).alias("ingested_per_s"),
                      (F.col("consumed") / F.lit(secs)).alias("consumed_per_s"))


def latency_report(log: DataFrame, window: str = "1 minute", slide: str | None = None,
                   ts: str = "received_at") -> DataFrame:
    """Mean and max ingest latency (ms) per window (AGG-13, FN-9).

    The dashboard divides the timer's Σseconds by its count and scales by
    1000; the log holds nanoseconds, converted once to seconds here.
    """
    secs = F.col("latency_ns") / F.lit(1e9)
    agg = log.groupBy(_window(ts, window, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(secs).alias("__sum_s"), F.max(secs).alias("__max_s"))
    return agg.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "requests",
        seconds_to_ms(F.col("__sum_s") / F.col("requests")).alias("avg_latency_ms"),
        seconds_to_ms(F.col("__max_s")).alias("max_latency_ms"))


def sla_breaches(log: DataFrame, threshold_ms: int = SLA_BREACH_MS) -> DataFrame:
    """Requests whose latency in whole milliseconds exceeds the threshold (FLT-8)."""
    whole = nanos_to_whole_ms("latency_ns")
    return (log.withColumn("latency_ms", whole)
               .filter(F.col("latency_ms") > threshold_ms)
               .select("request_id", "received_at", "latency_ms"))


# Bits of the value that each step of ``exact_quantile`` settles: a step looks
# at no more than 2**_DIGIT counters per group and target.
_DIGIT = 16
_LEVELS = (32, 16, 0)


def exact_quantile(df: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """``key, low, high, weight``: the two values around the ``q`` quantile of each group.

    Exact at any size and without holding a group's values in one task. The
    rows become counters per (group, value); then the value of each wanted
    rank is narrowed down digit by digit: counters are summed per leading
    digits, a running sum over those few sums finds the one that holds the
    rank, and only its values go on. The interpolated quantile is
    ``low + (high - low) * weight`` (as SQL ``quantile_cont``). Null values
    are ignored.
    """
    counts = (df.filter(F.col(value).isNotNull())
                .groupBy(F.col(key).alias("__k"), F.col(value).cast("bigint").alias("__v"))
                .agg(F.count(F.lit(1)).alias("__n")))
    place = (F.col("__total") - 1) * F.lit(q)
    low = F.floor(place)
    wanted = (counts.groupBy("__k").agg(F.sum("__n").alias("__total"))
              .select("__k", (place - low).alias("__w"), F.posexplode(F.array(
                  low, F.least(low + 1, F.col("__total") - 1))).alias("__which", "__rank")))
    parent = F.lit(0).cast("bigint")  # nothing settled yet
    wanted = wanted.withColumn("__parent", parent)
    for level, shift in enumerate(_LEVELS):
        prefix = F.shiftright("__v", shift)
        above = parent if level == 0 else F.shiftright("__v", shift + _DIGIT)
        live = counts.withColumns({"__prefix": prefix, "__parent": above})
        if level:
            live = live.join(wanted.select("__k", "__parent").distinct(), ["__k", "__parent"], "left_semi")
        sums = live.groupBy("__k", "__parent", "__prefix").agg(F.sum("__n").alias("__n"))
        upto = (Window.partitionBy("__k", "__which").orderBy("__prefix")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = sums.join(wanted, ["__k", "__parent"]).withColumn("__upto", F.sum("__n").over(upto))
        inside = (F.col("__upto") > F.col("__rank")) & (F.col("__upto") - F.col("__n") <= F.col("__rank"))
        wanted = found.filter(inside).select(
            "__k", "__w", "__which", (F.col("__rank") - F.col("__upto") + F.col("__n")).alias("__rank"),
            F.col("__prefix").alias("__parent"))
    value_of = lambda which: F.max(F.when(F.col("__which") == which, F.col("__parent")))
    return wanted.groupBy(F.col("__k").alias(key)).agg(
        value_of(0).alias("low"), value_of(1).alias("high"), F.max("__w").alias("weight"))


def sla_report(log: DataFrame, period: str = "1 day", p99_limit_ms: float = P99_LIMIT_MS,
               error_limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Service-level report per period (AGG-17, AGG-18).

    requests / ok / errors, sent/s and ok/s over the period, error rate, p99
    latency (linear interpolation, equal to SQL ``quantile_cont``, by
    ``exact_quantile``) and pass flags against the limits.
    """
    secs = float(_seconds(period))
    w = F.window("received_at", period)
    agg = log.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~F.col("error")).alias("ok"),
        F.count_if(F.col("error")).alias("errors")).withColumn("period_start", F.col("w.start"))
    parts = exact_quantile(log.select(w.getField("start").alias("period_start"), "latency_ns"),
                           "period_start", "latency_ns", 0.99)
    low, high = F.col("low") / F.lit(1e6), F.col("high") / F.lit(1e6)
    p99 = parts.select("period_start", (low + (high - low) * F.col("weight")).alias("p99_latency_ms"))
    rate = safe_ratio(F.col("errors").cast("double"), F.col("requests").cast("double"))
    return agg.join(p99, "period_start", "left").select(
        "period_start", F.col("w.end").alias("period_end"),
        "requests", "ok", "errors", rate.alias("error_rate"), "p99_latency_ms",
        (F.col("requests") / F.lit(secs)).alias("sent_per_s"),
        (F.col("ok") / F.lit(secs)).alias("ok_per_s"),
        (F.col("p99_latency_ms") < p99_limit_ms).alias("p99_pass"),
        (rate < error_limit).alias("error_rate_pass"))


def overflow_alerts(rejected: DataFrame, ts: str = "received_at",
                    window: str = "1 minute",
                    threshold: int = OVERFLOW_ALERT_THRESHOLD) -> DataFrame:
    """Windows whose rejected-event count exceeds the threshold (AGG-16)."""
    agg = rejected.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("rejected"))
    return (agg.filter(F.col("rejected") > threshold)
               .select(F.col("w.start").alias("window_start"),
                       F.col("w.end").alias("window_end"), "rejected"))


def publish_summary(classified: DataFrame, replayed: DataFrame | None = None) -> DataFrame:
    """accepted / rejected / replayed / published counts of a publish run (AGG-19).

    ``classified`` holds all requests with their ``reason`` (null = accepted),
    so they are decoded once; replayed rows are counted in a scalar subquery.
    Shedding, breaker activations and drops cannot happen in a batch job and
    are not reported.
    """
    again = F.lit(0).cast("bigint") if replayed is None else replayed.agg(F.count(F.lit(1))).scalar()
    out = classified.agg(F.count_if(F.col("reason").isNull()).alias("accepted"),
                         F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    return out.withColumn("replayed", again).withColumn("published", F.col("accepted") + F.col("replayed"))
