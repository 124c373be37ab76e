"""Column builders used by the cleaning and reporting plans."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that stands for "no value" in the raw extracts.
NULL_TOKENS = ("", "NA", "N/A", "null", "NULL", "None", "nan", "NaN")

OPEN_END = date(9999, 12, 31)
UNKNOWN_START = date(1900, 1, 1)


def null_if_token(c: Column, tokens=NULL_TOKENS) -> Column:
    """Null for blank text and the usual missing-value tokens."""
    return F.when(~F.trim(c).isin(*tokens), c)


def blank_to(c: Column, default: str) -> Column:
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def is_blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def guarded_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null unless ``whole`` is positive."""
    return F.when(whole > 0, part / whole * 100)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``round(100 * part / whole)``; null for a zero ``whole``."""
    whole = whole.cast("double")
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole, F.lit(0.0)), digits)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(3.6e9)


def title_case(c: Column) -> Column:
    """Trimmed text with every run of letters capitalised.

    ``initcap`` only sees words after blanks, so each other separator gets a marked
    blank for the moment; this keeps the expression inside generated code.
    """
    marked = F.regexp_replace(F.lower(F.trim(c)), r"([^\p{L}\s])", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def map_values(c: Column, mapping: Mapping[str, str]) -> Column:
    """Literal lookup; values outside the mapping become null."""
    result = F.lit(None).cast("string")
    for source, target in mapping.items():
        result = F.when(c == source, F.lit(target)).otherwise(result)
    return result


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def date_key(c: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def parse_number(c: Column) -> Column:
    """A number or null; the text ``nan`` is missing, not a number."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def parse_date(c: Column) -> Column:
    """A ``yyyy-MM-dd`` date or null."""
    return F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim(c).try_cast("date"))


# Shapes found in date columns that are not dates.
BARE_NUMBER = r"^-?\d{1,4}$"
LONG_YEAR = r"^\d{5,}-\d{2}-\d{2}$"


def is_filled(df: DataFrame, column: str) -> Column:
    """Whether there is a value; NaN in a column of floats is none."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def row_count() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` is true; null counts as not true."""
    return F.count(F.when(condition, F.lit(1)))
