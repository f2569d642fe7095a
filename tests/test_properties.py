"""Property checks against plain-Python models (few examples, each one Spark job)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulseline.functions.murmur import murmur2, session_partition_id
from pulseline.operators import dedup, kpi
from test_partitioning import _py_murmur2

SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.text(max_size=40), min_size=1, max_size=200))
def test_murmur2_matches_model_on_any_text(spark, keys):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, k string")
    got = {r["i"]: (r["h"], r["p"]) for r in df.select(
        "i", murmur2("k").alias("h"), session_partition_id("k", 24).alias("p")).collect()}
    for i, k in enumerate(keys):
        h = _py_murmur2(k.encode("utf-8"))
        assert got[i] == (h, abs(h) % 24), k


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 5), st.integers(0, 1000)),
                min_size=1, max_size=300))
def test_keep_first_matches_model(spark, rows):
    # (id, arrival, payload); ties on arrival are broken by payload (deterministic)
    df = spark.createDataFrame([(str(i), a, p) for i, a, p in rows],
                               "event_id string, arrival_seq long, payload long")
    got = {r["event_id"]: (r["arrival_seq"], r["payload"]) for r in dedup.dedup_events(df).collect()}
    want = {}
    for i, a, p in rows:
        key = str(i)
        if key not in want or (a, p) < want[key]:
            want[key] = (a, p)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.floats(0, 1e4), st.booleans(),
                          st.floats(0, 1e4), st.sampled_from([0.0, 1.0, 250.0, 6e4, float("nan")])),
                min_size=1, max_size=200))
def test_kpis_match_model(spark, rows):
    import datetime as dt
    from conftest import hb_rows
    t0 = dt.datetime(2024, 1, 1)
    df = hb_rows(spark, [{"session_id": f"s{s}", "video_start_time_ms": v, "playback_failed": f,
                          "rebuffer_duration_ms": r, "playback_duration_ms": p,
                          "ts": t0 + dt.timedelta(seconds=j)}
                         for j, (s, v, f, r, p) in enumerate(rows)])
    got = {r["session_id"]: r for r in kpi.session_kpis(df).collect()}
    groups = {}
    for s, v, f, r, p in rows:
        groups.setdefault(f"s{s}", []).append((v, f, r, p))
    assert got.keys() == groups.keys()
    for s, evs in groups.items():
        n = len(evs)
        play = math.fsum(e[3] for e in evs)
        reb = math.fsum(e[2] for e in evs)
        ratio = reb / play if (not math.isnan(play) and play > 0) else 0.0
        assert got[s]["event_count"] == n
        assert math.isclose(got[s]["avg_vst_ms"], math.fsum(e[0] for e in evs) / n, rel_tol=1e-9, abs_tol=1e-9)
        assert got[s]["pfr"] == sum(e[1] for e in evs) / n
        assert math.isclose(got[s]["rebuffering_ratio"], ratio, rel_tol=1e-9, abs_tol=1e-12)


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(" \t\n\r\x0b\x0c\x00\x1f\xa0 ab"), max_size=6),
                min_size=1, max_size=100))
def test_not_blank_matches_model(spark, values):
    import json

    from pulseline.operators.quarantine import classify_requests
    from pulseline.sources.json_source import decode_json
    docs = [json.dumps({"eventId": "e", "sessionId": v, "clientId": "c", "contentId": "m",
                        "timestampMs": 1}) for v in values]
    df = spark.createDataFrame(list(enumerate(docs)), "request_id long, body string")
    got = {r["request_id"]: r["violations"] for r in classify_requests(decode_json(df)).collect()}
    for i, v in enumerate(values):
        blank = not any(ord(ch) > 0x20 for ch in v)
        assert (got[i] == "sessionId: must not be blank") == blank, repr(v)
        assert (got[i] is None) == (not blank), repr(v)
