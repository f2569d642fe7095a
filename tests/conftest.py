import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pulseline.session import get_spark
    s = get_spark("local[*]", app="pulseline-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


def hb_rows(spark, rows):
    """Heartbeat DataFrame from dicts; unspecified fields take neutral values."""
    import datetime as dt

    from pulseline.schemas import HEARTBEAT
    base = {"event_id": None, "session_id": "session-test", "client_id": "client-1",
            "content_id": "content-1", "ts": dt.datetime(2024, 1, 1, 0, 0, 0),
            "video_start_time_ms": 0.0, "playback_failed": False,
            "rebuffer_duration_ms": 0.0, "playback_duration_ms": 0.0,
            "player_version": None, "os": None, "cdn": None}
    out = []
    for i, r in enumerate(rows):
        d = dict(base, event_id=f"e{i}")
        d.update(r)
        out.append(tuple(d[f.name] for f in HEARTBEAT.fields))
    return spark.createDataFrame(out, HEARTBEAT)
