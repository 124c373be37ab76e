import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from tidemark.operators.matching import fifo_match, keep_first, overlapping_intervals
from tidemark.plans.events import escalation_log

T0 = datetime(2024, 1, 1)


def greedy(events):
    """Each close takes the oldest open raise at or before it. events: (group, minute, id, opens)."""
    out = {}
    for g in {e[0] for e in events}:
        mine = sorted((e for e in events if e[0] == g), key=lambda e: (e[1], not e[3], e[2]))
        waiting = []
        for _, minute, event, opens in mine:
            if opens:
                waiting.append(event)
                out[event] = None
            elif waiting:
                out[waiting.pop(0)] = event
    return sorted(out.items())


def matched(spark, events, slices):
    df = spark.createDataFrame([(g, m, i, o) for g, m, i, o in events], "g string, m int, id int, opens boolean")
    got = fifo_match(
        df, group="g", time="m", event_id="id", opens=F.col("opens"), closes=~F.col("opens"),
        open_fields={"opened": F.col("id")}, close_fields={"closed": F.col("id")}, slices=slices,
    )
    return sorted((r.opened, r.closed) for r in got.collect())


@pytest.mark.parametrize("slices", [None, 2, 13])
def test_fifo_equals_greedy_on_skewed_groups(spark, slices):
    rng = random.Random(4)
    events = [
        ("hot" if rng.random() < 0.4 else f"g{rng.randrange(30)}", rng.randrange(40), i, rng.random() < 0.5)
        for i in range(1500)
    ]
    assert matched(spark, events, slices) == greedy(events)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(hs.lists(hs.tuples(hs.sampled_from("ab"), hs.integers(0, 6), hs.booleans()), min_size=1, max_size=40), hs.integers(1, 5))
def test_fifo_property(spark, found, slices):
    events = [(g, m, i, o) for i, (g, m, o) in enumerate(found)]
    assert matched(spark, events, slices) == greedy(events)


def test_fifo_without_times(spark):
    data = [("g", None, 1, True), ("g", 5, 2, False), ("g", 4, 3, True), ("g", None, 4, False), ("g", 9, 5, False)]
    assert matched(spark, data, 2) == matched(spark, data, None) == [(1, None), (3, 2)]


def test_escalation_log_fixture(spark):
    def event(i, kind, minute, project="P1", severity=None, by=None):
        payload = {k: v for k, v in (("severity", severity), ("resolved_by", by)) if v}
        return (f"e{i}", kind, project, "u1", T0 + timedelta(minutes=minute), payload)

    events = spark.createDataFrame(
        [
            event(1, "escalation_raised", 10, severity="High"),
            event(2, "escalation_raised", 20, severity="Low"),
            event(3, "escalation_resolved", 30, by="x"),
            event(4, "escalation_resolved", 80, by="y"),
            event(5, "escalation_resolved", 90, by="z"),
            event(6, "escalation_resolved", 5, "P2", by="early"),
            event(7, "escalation_raised", 7, "P2"),
            event(8, "escalation_raised", 7, "P3"),
            event(9, "escalation_resolved", 7, "P3", by="same time"),
            event(10, "escalation_raised", 7, None),
            event(11, "login", 7, "P1"),
        ],
        "event_id string, event_type string, project_id string, user_id string, timestamp timestamp, payload map<string,string>",
    )
    log = {r.event_id: r for r in escalation_log(events, slices=3).collect()}
    assert set(log) == {"e1", "e2", "e7", "e8"}
    assert (log["e1"].resolved_by, round(log["e1"].resolution_time_hours, 6)) == ("x", round(20 / 60, 6))
    assert (log["e2"].resolved_by, log["e2"].resolution_time_hours, log["e2"].severity) == ("y", 1.0, "Low")
    assert (log["e7"].resolved, log["e7"].resolved_at) == (False, None)
    assert (log["e8"].resolved, log["e8"].resolution_time_hours) == (True, 0.0)


def test_keep_first_limits_before_the_shuffle(spark):
    data = [("a", 2, "late"), ("a", 1, "early"), ("a", 1, "early2"), ("b", 5, "only"), (None, 1, "n1"), (None, 0, "n0")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    got = keep_first(df, ["k"], ["t", "v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before, one after the exchange
    assert sorted(r.v for r in got.collect()) == ["early", "n0", "only"]


@pytest.mark.parametrize("slices", [None, 4])
def test_overlaps_against_all_pairs(spark, slices):
    rng = random.Random(5)
    spans = []
    for i in range(300):
        start = T0.date() + timedelta(days=rng.randrange(200))
        spans.append((rng.choice(["hot", "hot", f"k{rng.randrange(20)}"]), i, start, start + timedelta(days=rng.randrange(4))))
    df = spark.createDataFrame(spans, "k string, id int, a date, b date")
    got = overlapping_intervals(df, key="k", version="id", start="a", end="b", slices=slices).collect()
    want = {}
    for k, i, a, b in spans:
        earlier = [(e, j) for kk, j, s, e in spans if kk == k and (s, j) < (a, i)]
        if earlier and max(earlier)[0] >= a:
            want[i] = max(earlier)[1]
    assert {r.version_b: r.version_a for r in got} == want
