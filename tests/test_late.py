"""Late and repeated events over several files."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.streaming import events as st
from tidemark.streaming import late


def source(spark, folder, schema="event_id string, event_type string, timestamp timestamp"):
    frame = spark.createDataFrame([], schema)
    return st.file_stream(spark, str(folder), frame.schema, pattern="*.json", files_per_batch=1)


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f'{{"event_id": "{i}", "event_type": "{t}", "timestamp": "{ts}"}}\n' for i, t, ts in rows))


FILES = [
    [("1", "a", "2024-01-05T10:00:00"), ("2", "a", "2024-01-05T11:00:00"), ("2", "a", "2024-01-05T11:00:00")],
    [("3", "a", "2024-01-03T09:00:00"), ("1", "a", "2024-01-05T10:00:00"), ("4", "b", "2024-01-05T10:30:00")],
    [("3", "a", "2024-01-03T09:00:00"), ("5", "b", "2024-01-06T00:00:00"), ("6", "a", "2024-01-03T23:00:00")],
]


def test_first_arrivals_stay_and_late_ones_are_kept(spark, rows, tmp_path):
    folder, landing = tmp_path / "in", st.Landing(f"file://{tmp_path}/out", f"file://{tmp_path}/progress")
    for k, content in enumerate(FILES):
        put(folder, f"{k}.json", content)
        events = source(spark, folder)
        late.land_unique(events, landing, keys=["event_id"], time="timestamp", late_by="1 hour")
    assert rows(late.unique_rows(spark, events, landing, late=False), "event_id") == [("1",), ("2",), ("4",), ("5",)]
    assert rows(late.unique_rows(spark, events, landing, late=True), "event_id") == [("3",), ("6",)]


def test_a_repeated_batch_changes_nothing(spark, rows, tmp_path):
    """Progress is lost after the second batch: it runs again, with more files in it, and replaces its folder."""
    folder = tmp_path / "in"
    for k, content in enumerate(FILES):
        put(folder, f"{k}.json", content)
    events = source(spark, folder)
    landing = st.Landing(f"file://{tmp_path}/out", f"file://{tmp_path}/progress")
    late.land_unique(events, landing, keys=["event_id"], time="timestamp", late_by="1 hour")
    again = st.Landing(f"file://{tmp_path}/out", f"file://{tmp_path}/other-progress")
    late.land_unique(events, again, keys=["event_id"], time="timestamp", late_by="1 hour")
    assert rows(late.unique_rows(spark, events, landing), "event_id") == [(str(k),) for k in range(1, 7)]


def test_closed_days_are_restated(spark, rows, tmp_path):
    folder, landing = tmp_path / "in", st.Landing(f"file://{tmp_path}/out", f"file://{tmp_path}/progress")
    for k, content in enumerate(FILES):
        put(folder, f"{k}.json", content)
    late.land_daily(source(spark, folder), landing, time="timestamp", late_by="1 hour")
    found = late.daily_counts(spark, landing).withColumn("event_date", F.col("event_date").cast("string"))
    assert rows(found) == [
        ("2024-01-03", "a", 3, 3), ("2024-01-05", "a", 4, 0), ("2024-01-05", "b", 1, 0), ("2024-01-06", "b", 1, 0)]


def test_rows_without_a_time(spark, rows, tmp_path):
    folder, landing = tmp_path / "in", st.Landing(f"file://{tmp_path}/out", f"file://{tmp_path}/progress")
    folder.mkdir()
    (folder / "0.json").write_text('{"event_id": "1", "event_type": "a"}\n{"event_id": "1", "event_type": "a"}\n')
    (folder / "1.json").write_text('{"event_id": "1", "event_type": "a"}\n{"event_type": "b", "timestamp": "2024-01-01T00:00:00"}\n')
    events = source(spark, folder)
    late.land_unique(events, landing, keys=["event_id"], time="timestamp", late_by="1 hour")
    assert rows(late.unique_rows(spark, events, landing)) == sorted([("1", "a", None), (None, "b", datetime(2024, 1, 1))], key=repr)
