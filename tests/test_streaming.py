import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import schemas
from tidemark.streaming import events as st


def put(folder, name, data):
    lines = [
        json.dumps({"event_id": i, "event_type": t, "project_id": "P", "user_id": "u", "timestamp": ts, "payload": {"severity": sev}})
        for i, t, ts, sev in data
    ]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


FIRST = [
    ("1", "escalation_raised", "2024-01-01T10:00:00", "Critical"),
    ("2", "escalation_raised", "2024-01-01T11:00:00", "Low"),
    ("3", "login", "2024-01-02T10:00:00", "Critical"),
]
SECOND = [("4", "escalation_raised", "2024-01-02T12:00:00", "Critical"), ("3", "login", "2024-01-02T10:00:00", "Critical")]


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "events_1.jsonl", FIRST)

    def read():
        return st.file_stream(spark, str(folder), schemas.EVENTS, pattern="events_*.jsonl", files_per_batch=1)

    return folder, read


def severity():
    return F.col("payload")["severity"]


def test_ingest_stamps_and_replays_once(spark, source):
    folder, read = source
    landing = st.Landing.fresh(spark, "t-ingest")
    records = st.as_records(read())
    for _ in range(2):
        st.land(st.as_records(read()), landing)
        assert st.landed(spark, records, landing).count() == 3
    put(folder, "events_2.jsonl", SECOND)
    query = st.land(st.as_records(read()), landing)
    got = st.landed(spark, records, landing).collect()
    assert len(got) == 5 and {r.key for r in got} == {"escalation_raised", "login"}
    value = json.loads(got[0].value)
    assert value["produced_at"].startswith("20") and value["event_id"]
    assert st.rate(query)["rows"] == 2


def test_counts_go_on_from_the_checkpoint(spark, source):
    folder, read = source
    landing = st.Landing.fresh(spark, "t-counts")
    counts = st.counts_by_type(read())

    def now():
        query = st.land_updates(st.counts_by_type(read()), landing)
        found = st.report(st.latest(spark, counts, landing, ["event_type"]), spark.range(2), query)
        assert found["total_consumed"] == sum(found["event_counts"].values())
        assert (found["critical_forwarded"], found["event_types"]) == (2, 2)
        return {r.event_type: r.event_count for r in st.latest(spark, counts, landing, ["event_type"]).collect()}

    assert now() == {"escalation_raised": 2, "login": 1}
    assert now() == {"escalation_raised": 2, "login": 1}
    put(folder, "events_2.jsonl", SECOND)
    assert now() == {"escalation_raised": 3, "login": 2}


def test_critical_events_are_forwarded_once(spark, source, tmp_path):
    folder, read = source
    landing, critical = st.Landing.fresh(spark, "t-route"), str(tmp_path / "critical")
    put(folder, "events_2.jsonl", SECOND)
    for _ in range(2):
        st.route(read(), st.is_critical(severity()), landing, critical)
        assert sorted(r.event_id for r in st.routed(spark, schemas.EVENTS, critical).collect()) == ["1", "4"]
        assert st.routed(spark, schemas.EVENTS, landing.data).count() == 5
    forwarded = st.routed(spark, schemas.EVENTS, critical)
    counts = st.routed(spark, schemas.EVENTS, landing.data).groupBy("event_type").agg(F.count("*").alias("event_count"))
    assert tuple(st.summary(counts, forwarded).first()) == (5, 2, 2)


@pytest.mark.parametrize("salts", [0, 4])
def test_dedupe(spark, source, salts):
    folder, read = source
    put(folder, "events_2.jsonl", SECOND)
    unique = st.dedupe(read(), keys=["event_id"], time="timestamp", late_by="2 days", salts=salts)
    landing = st.Landing.fresh(spark, "t-dedupe")
    st.land(unique, landing)
    assert sorted(r.event_id for r in st.landed(spark, unique, landing).collect()) == ["1", "2", "3", "4"]


def test_daily_volume(spark, source):
    folder, read = source
    put(folder, "events_2.jsonl", SECOND)
    daily = st.daily_volume(read(), time="timestamp", late_by="2 days")
    landing = st.Landing.fresh(spark, "t-daily")
    st.land_updates(daily, landing)
    got = st.latest(spark, daily, landing, ["event_date", "event_type"]).collect()
    assert sorted((str(r.event_date), r.event_type, r.event_count) for r in got) == [
        ("2024-01-01", "escalation_raised", 2), ("2024-01-02", "escalation_raised", 1), ("2024-01-02", "login", 2),
    ]
