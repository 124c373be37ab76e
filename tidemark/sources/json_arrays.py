"""JSON arrays over many lines, read by as many tasks as the files have splits.

A string of JSON holds no raw line break, so the quote state starts anew on
every line and only the nesting depth is carried. One pass adds up the change
of depth per split; a running sum over the splits of a file, one row each, gives
the depth at which a split begins. With it every split finds where records end
by itself, and only the records that lie across splits are put together
afterwards, two pieces a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A string, or what is left of the line behind a quote that is never closed.
_STRING = r'"(?:[^"\\]++|\\.)*+"?'
# Text up to and with the next closing brace outside strings. Possessive, so that long lines need no stack.
_FRAGMENT = rf'(?:[^"}}]++|{_STRING})*+\}}?'
_BETWEEN = r"^[\s,\[]+"
_NOTHING = r"^[\s,\[\]]*$"


def _depth_change(text: Column) -> Column:
    bare = F.regexp_replace(text, _STRING, "")
    opened = F.length(F.regexp_replace(bare, r"[^\[{]", ""))
    return (opened - F.length(F.regexp_replace(bare, r"[^\]}]", ""))).cast("long")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line, value); line numbers rise within a split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), "value",
    )


def _joined(pieces: Column) -> Column:
    """Pieces (structs of sort keys and ``text``) as one text. Ends of fragments lie outside strings."""
    return F.array_join(F.transform(F.array_sort(pieces), lambda p: p["text"]), "\n")


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of every element of the arrays, unparsed.

    The files hold one array each, or objects one behind the other. What stands
    between two records and is no record (a number, a truncated end) comes with
    the record behind it, or by itself at the end. A brace too many or too few
    shifts the depth of all that follows in its file, which is then one text.
    """
    lines = _lines(spark, path)
    mark = F.nullif(F.substring(F.regexp_replace("value", r"^[\s\x{FEFF}]+", ""), 1, 1), F.lit(""))
    splits = lines.groupBy("file", "split").agg(
        F.sum(_depth_change(F.col("value"))).alias("change"),
        F.min_by(mark, F.when(mark.isNotNull(), F.col("line"))).alias("mark"),
    )
    # One row a split.
    earlier = Window.partitionBy("file").orderBy("split")
    begins = splits.select(
        "file", "split",
        F.coalesce(F.sum("change").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"),
        F.when(F.first("mark", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == "[", 1)
        .otherwise(0).alias("outside"),
    )
    fragments = lines.select(
        "file", "split", "line", F.posexplode(F.regexp_extract_all("value", F.lit(_FRAGMENT), F.lit(0))).alias("at", "text")
    ).filter("text <> ''")
    # A split is bounded by spark.sql.files.maxPartitionBytes, whatever the file's size.
    place = Window.partitionBy("file", "split").orderBy("line", "at")
    depth = F.col("begin") + F.sum(_depth_change(F.col("text"))).over(place)
    ended = fragments.join(begins, ["file", "split"]).withColumn("ends", F.col("text").endswith("}") & (depth == F.col("outside")))
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    numbered = ended.withColumn("record", F.coalesce(F.sum(F.col("ends").cast("long")).over(before), F.lit(0)))
    pieces = numbered.groupBy("file", "split", "record").agg(
        _joined(F.collect_list(F.struct("line", "at", "text"))).alias("text"), F.max("ends").alias("closed")
    )
    inside = (F.col("record") > 0) & F.col("closed")
    order = Window.partitionBy("file").orderBy("split", "record").rowsBetween(Window.unboundedPreceding, -1)
    across = (
        pieces.filter(~inside).withColumn("whole", F.coalesce(F.sum(F.col("closed").cast("long")).over(order), F.lit(0)))
        .groupBy("file", "whole").agg(_joined(F.collect_list(F.struct("split", "record", "text"))).alias("text"))
    )
    found = pieces.filter(inside).select("file", "text").unionByName(across.select("file", "text"))
    return found.select("file", F.regexp_replace("text", rf"^\x{{FEFF}}?{_BETWEEN[1:]}", "").alias("text")).filter(~F.col("text").rlike(_NOTHING))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, *, corrupt: str | None = None) -> DataFrame:
    """The records of the arrays at ``path``, by ``schema``.

    What cannot be read as a record has null fields; ``corrupt`` names a column for its text. Line breaks between the
    parts of a record are line feeds, which shows only where an object or array is asked for as a string.
    """
    extra = [T.StructField(corrupt, T.StringType())] if corrupt else []
    options = {"mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    parsed = F.from_json("text", T.StructType([*schema.fields, *extra]), options)
    return record_texts(spark, path).select(parsed.alias("r")).select("r.*")
