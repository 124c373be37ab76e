"""Writers. All replace what they wrote before, so a repeated run changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# How text is quoted: doubled quotes, blanks kept. Readers and writers share it.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Header CSV that keeps quotes, commas, blanks and line breaks of text.

    Text with line breaks reads back with ``multi_line``. ``single_file`` is for
    small aggregates such as dashboard extracts.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).options(**CSV_DIALECT).csv(path)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: list[str] | None = None,
    single_file: bool = False,
    replace_partitions: bool = False,
) -> int:
    """Write Parquet and return the rows written, counted by the write itself.

    Rows are brought together by partition value first, so a small value becomes one
    file instead of one per task; the rebalance hint lets adaptive execution cut a value
    holding much of the data into several tasks. ``replace_partitions`` touches only
    the partitions present in ``df``.
    """
    out = df.coalesce(1) if single_file else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    # counted behind the last shuffle, where a repeated task counts once
    counted = Observation()
    writer = out.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return counted.get["rows"]


def write_clustered(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet sorted by ``by`` across and inside files, so that filters on those columns
    skip row groups by their minimum and maximum. End ``by`` in a column with many values."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A report as one text file in a folder."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A small metrics frame as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
