import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators.star import dim_date
from tidemark.sinks.files import write_clustered, write_csv, write_metrics, write_table
from tidemark.sources import schemas
from tidemark.sources.files import (
    CORRUPT,
    calendar,
    null_profile,
    read_dirty_csv,
    read_file_list,
    read_json_records,
    read_jsonl,
    read_table,
    read_typed_csv,
)
from tidemark.sources.json_arrays import read_json_array


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "projects.csv"
    path.write_text(
        "project_id,project_name,department,status,start_date,end_date,budget,actual_cost,project_manager_id,priority,region\n"
        "P1,One,IT,Completed,2024-01-01,,100.5,,M1,High,North\n"
        "P2,Two,IT,Completed,not a date,2024-02-01,x,5,M1,NA,North\n"
        "P3,Three\n"
    )
    one, two, three = read_typed_csv(spark, str(path), schemas.PROJECTS, keep_corrupt=True).orderBy("project_id").collect()
    assert (one.start_date, one.end_date, one.budget, one.actual_cost) == (date(2024, 1, 1), None, 100.5, None)
    assert (two.start_date, two.budget, two.actual_cost) == (None, None, 5.0)
    assert two.priority is None and three.budget is None
    assert (one[CORRUPT], two[CORRUPT], three[CORRUPT]) == (None, "start_date, budget", "P3,Three")
    assert read_typed_csv(spark, str(path), schemas.PROJECTS).columns == schemas.PROJECTS.names


def test_dirty_csv_and_null_profile(spark, tmp_path):
    path = tmp_path / "employees.csv"
    header = ",".join(f.name for f in schemas.EMPLOYEES)
    path.write_text(f"{header}\nE1,A,NA,IT,Dev,L1,-999,abc,null,N,Active,\nE2,B,  ,IT,Dev,L1,2020-01-01,5,E1,N,Active,nan\n")
    df = read_dirty_csv(spark, str(path))
    assert all(t == "string" for _, t in df.dtypes)
    nulls = {r.column_name: r.null_rows for r in null_profile(df).collect()}
    assert (nulls["email"], nulls["manager_id"], nulls["years_experience"], nulls["salary"]) == (2, 1, 2, 0)


def test_json_records(spark, tmp_path):
    path = tmp_path / "transactions.json"
    records = [
        {"transaction_id": "T1", "amount": 5.5, "transaction_date": "2024-03-01", "approved_by": None},
        {"transaction_id": "T2", "amount": None, "transaction_date": "bad", "approved_by": "E1"},
    ]
    path.write_text(json.dumps(records, indent=2))
    one, two = read_json_records(spark, str(path)).orderBy("transaction_id").collect()
    assert (one.amount, one.transaction_date, one.approved_by) == (5.5, date(2024, 3, 1), None)
    assert (two.amount, two.transaction_date, two.approved_by) == (None, None, "E1")


NASTY = ['plain', 'a "quoted" } { [ ]', 'back\\slash \\" }', '', 'two\nlines', '\u2028 \u00e9', '}, {', ',', None]


def nasty_records(count):
    return [
        {"k": k, "s": NASTY[k % len(NASTY)], "n": {"a": [k, k + 1], "t": NASTY[(k + 3) % len(NASTY)]} if k % 4 else None,
         "l": [{"x": "}" * (k % 50)}] * (k % 3)}
        for k in range(count)
    ]


@pytest.mark.parametrize("split", [64, 333, 100_000])
def test_many_line_arrays_are_split(spark, tmp_path, split):
    records = nasty_records(120)
    indented = json.dumps(records[:50], indent=2)
    (tmp_path / "a.json").write_text(indented)
    (tmp_path / "b.json").write_text("[" + " ,\n".join(json.dumps(r, ensure_ascii=False) for r in records[50:90]) + "]\n\n")
    (tmp_path / "c.json").write_text(indented.replace("  },\n  {", "  }, {").replace("\n", "\r\n"))
    (tmp_path / "d.json").write_text(json.dumps(records[90:]))
    (tmp_path / "e.json").write_text("[ ]\n")
    (tmp_path / "f.json").write_text("")
    (tmp_path / "g.json").write_text(json.dumps(records[7], indent=1))
    schema = "k long, s string, n struct<a: array<long>, t: string>, l array<struct<x: string>>"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    expected = sorted(map(repr, spark.read.schema(schema).option("multiLine", True).json(str(tmp_path)).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert split > 64 or spark.read.text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 50
        found = sorted(map(repr, read_json_array(spark, str(tmp_path), spark.createDataFrame([], schema).schema).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 171 and found == expected


def test_broken_records_of_an_array_are_told(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"k": 1},\n {"k": 2, "s": "open\n },\n {"k": 3},\n 7,\n {"k": 4},\n {"k": 5, "s"')
    found = read_json_array(spark, str(tmp_path), spark.createDataFrame([], "k long, s string").schema, corrupt="bad").collect()
    assert sorted(r.k for r in found if r.bad is None) == [1, 3]
    assert len(found) == 5 and sum(r.bad is not None for r in found) == 3 and any(r.bad == '{"k": 5, "s"' for r in found)


def events_file(folder, name, ids):
    lines = [
        json.dumps({"event_id": i, "event_type": "login", "user_id": "u", "timestamp": "2024-05-01T10:00:00",
                    "payload": {"device": "desktop", "attendees": ["a", "b"]}})
        for i in ids
    ]
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder / name)


def test_jsonl_by_pattern_and_list(spark, tmp_path):
    a = events_file(tmp_path, "events_01.jsonl", ["e1", "e2"])
    b = events_file(tmp_path, "events_02.jsonl", ["e3"])
    events_file(tmp_path, "other.jsonl", ["e4"])
    df = read_jsonl(spark, str(tmp_path))
    assert sorted(r.event_id for r in df.collect()) == ["e1", "e2", "e3"]
    row = df.first()
    assert row.timestamp == datetime(2024, 5, 1, 10) and row.project_id is None
    assert json.loads(row.payload["attendees"]) == ["a", "b"] and "severity" not in row.payload
    assert df.select(F.col("payload")["severity"]).first()[0] is None
    assert read_file_list(spark, [a, b], "some_events").count() == 3
    assert spark.sql("SELECT count(*) FROM some_events").first()[0] == 3
    with pytest.raises(FileNotFoundError):
        read_file_list(spark, [], "none")


def test_calendar(spark):
    days = dim_date(calendar(spark, date(2000, 1, 1), date(2030, 12, 31))).cache()
    assert days.count() == 11323
    first = days.filter("full_date = '2000-01-01'").first()
    assert (first.date_key, first.week, first.day_of_week, first.day_name, first.is_weekend) == (20000101, 52, 6, "Saturday", True)
    leap = days.filter("full_date = '2024-02-29'").first()
    assert (leap.quarter, leap.month_name, leap.is_weekend) == (1, "February", False)


def test_write_table_counts_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select(F.col("id"), (F.col("id") % 4).cast("int").alias("part"))
    assert write_table(df, path, partition_by=["part"]) == 100
    files = [f for f in (tmp_path / "t").rglob("*.parquet")]
    assert len(files) == 4  # one per value, not one per task and value
    pruned = read_table(spark, path).filter("part = 2")
    assert pruned.count() == 25
    assert "PartitionFilters: [isnotnull(part" in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_big_partition_value_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(60_000).select(
            F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.when(F.col("id") < 50_000, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 3)).alias("part"),
        ).repartition(8)
        assert write_table(df, str(tmp_path / "t"), partition_by=["part"]) == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "part=hot").glob("*.parquet"))) > 1


def test_replacing_partitions_leaves_the_others(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([(1, "a"), (2, "b")], "v int, part string")
    write_table(both, path, partition_by=["part"])
    newer = spark.createDataFrame([(9, "b")], "v int, part string")
    for _ in range(2):
        write_table(newer, path, partition_by=["part"], replace_partitions=True)
    assert rows(read_table(spark, path), "v", "part") == [(1, "a"), (9, "b")]


def test_clustered_files_have_narrow_ranges(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "Pending").otherwise("Paid").alias("status"), F.rand(1).alias("amount")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(df, str(tmp_path / "c"), ["status", "amount"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics for f in (tmp_path / "c").glob("*.parquet")]
    assert sum(f.max >= "Pending" for f in files) < len(files) and len(files) > 2
    assert spark.read.parquet(str(tmp_path / "c")).count() == 20_000


def test_csv_and_metrics(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    write_csv(df, str(tmp_path / "c"), single_file=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert rows(read_typed_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)
    write_metrics(df.limit(1), str(tmp_path / "m"))
    assert json.loads(next((tmp_path / "m").glob("*.json")).read_text()) == {"n": 1, "s": "a"}


def test_shared_folder_is_the_configured_one(spark, monkeypatch):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"
            applicationId = "x"

    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster)
