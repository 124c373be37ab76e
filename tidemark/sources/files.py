"""Readers for the raw extracts and for written tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import count_where, is_filled, null_if_token, parse_date
from tidemark.sinks.files import CSV_DIALECT
from tidemark.sources import schemas
from tidemark.sources.json_arrays import read_json_array

CORRUPT = "_corrupt_record"


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, keep_corrupt: bool = False, multi_line: bool = False
) -> DataFrame:
    """Header CSV with declared types; missing-value tokens and unreadable values become null.

    A row with the wrong number of fields stops the read. ``keep_corrupt`` keeps it and adds
    what did not fit: the raw line, or for rows of the right shape the names of the columns
    whose text is not of the declared type. ``multi_line`` allows line breaks inside quotes;
    each file is then read by one task.
    """
    text = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    line = [T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []
    reader = _csv_reader(spark, T.StructType([*text, *line]), multi_line, keep_corrupt)
    raw = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    present = {f.name: null_if_token(F.col(f"`{f.name}`")) for f in schema.fields}
    typed = {f.name: _typed(present[f.name], f.dataType) for f in schema.fields}
    columns = [value.alias(name) for name, value in typed.items()]
    if keep_corrupt:
        unread = [F.when(present[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in typed]
        columns.append(F.coalesce(CORRUPT, F.nullif(F.concat_ws(", ", *unread), F.lit(""))).alias(CORRUPT))
    return raw.select(*columns)


def _csv_reader(spark: SparkSession, schema: T.StructType, multi_line: bool, permissive: bool) -> DataFrameReader:
    reader = spark.read.schema(schema).option("header", True).options(**CSV_DIALECT).option("multiLine", multi_line)
    return reader.option("mode", "PERMISSIVE" if permissive else "FAILFAST")


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        return parse_date(text)
    return F.trim(text).try_cast(kind)


def read_dirty_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.EMPLOYEES, *, multi_line: bool = False
) -> DataFrame:
    """Header CSV kept as text, missing-value tokens as null; a row of the wrong shape stops the read."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = _csv_reader(spark, text, multi_line, False).csv(path)
    return raw.select(*[null_if_token(F.col(c)).alias(c) for c in raw.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """Null (or NaN) and total rows per column, from one aggregate over the table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count_where(~is_filled(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows"))
          for i, c in enumerate(df.columns)]
    )
    return counted.select(F.explode(pairs).alias("p"), "_rows").select(
        "p.column_name", "p.null_rows", F.col("_rows").alias("total_rows")
    )


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.TRANSACTIONS,
    *,
    date_columns: tuple[str, ...] = ("transaction_date",),
    multi_line: bool = True,
) -> DataFrame:
    """JSON arrays of records: arrays over any number of lines (``multi_line``), or one per line.

    Both are read by as many tasks as the files have splits.
    """
    raw = read_json_array(spark, path, schema) if multi_line else spark.read.schema(schema).json(path)
    parsed = [parse_date(F.col(c)).alias(c) if c in date_columns else F.col(c) for c in raw.columns]
    return raw.select(*parsed)


def read_jsonl(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.EVENTS,
    *,
    pattern: str = "events_*.jsonl",
) -> DataFrame:
    """All JSON-lines files of a folder whose name fits ``pattern``."""
    return spark.read.schema(schema).option("pathGlobFilter", pattern).json(folder)


def read_file_list(
    spark: SparkSession, paths: list[str], view: str, schema: T.StructType = schemas.EVENTS
) -> DataFrame:
    """A stated list of JSON-lines files, also registered as a view."""
    if not paths:
        raise FileNotFoundError("no input files match")
    df = spark.read.schema(schema).json(paths)
    df.createOrReplaceTempView(view)
    return df


def read_table(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """A written Parquet table; partition columns come from the folder names."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(folder)


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last`` of a one-row frame."""
    days = F.sequence("first", "last", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("full_date"))
