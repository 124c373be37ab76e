"""Type-2 dimension: build it from a history and a snapshot, and check it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import OPEN_END, UNKNOWN_START, row_count
from tidemark.operators.matching import overlapping_intervals
from tidemark.operators.ordered import Running, in_order, number_rows


@dataclass(frozen=True)
class HistorySpec:
    """Column names of a change history.

    ``versioned`` maps a dimension attribute to the history column holding its new
    value; ``tiebreak`` separates changes of one key on one day, latest highest.
    """

    key: str = "employee_id"
    day: str = "effective_date"
    previous: str = "previous_salary"
    new: str = "new_salary"
    reason: str = "change_reason"
    tiebreak: tuple[str, ...] = ("new_salary",)
    versioned: dict[str, str] = field(
        default_factory=lambda: {"role": "new_role", "level": "new_level", "salary": "new_salary"}
    )


def collapse_same_day(history: DataFrame, spec: HistorySpec = HistorySpec()) -> DataFrame:
    """One change per key and day: the end of the day's chain.

    A change is superseded when another change of that day starts from its new
    value. Where several or (in a cycle) no changes remain, the highest
    ``tiebreak`` is kept; ``terminal_states`` tells how many there were.

    Instead of joining a day's changes with each other, every change is counted
    under its new and under its previous value. Both rows are made in place, so a history
    that is spread by its key is not shuffled again, nor are the changes that come out.
    """
    whole = F.struct(*history.columns)
    ranked = F.struct(F.struct(*spec.tiebreak).alias("rank"), whole.alias("row"))
    unchanged = F.coalesce(F.col(spec.previous) == F.col(spec.new), F.lit(False))
    counted = F.array(
        F.struct(
            F.col(spec.new).alias("_value"), ranked.alias("_any"), F.when(unchanged, ranked).alias("_same"),
            F.lit(0).alias("_starts"), F.lit(0).alias("_own"),
        ),
        F.struct(
            F.col(spec.previous).alias("_value"), F.when(F.lit(False), ranked).alias("_any"),
            F.when(F.lit(False), ranked).alias("_same"), F.lit(1).alias("_starts"), unchanged.cast("int").alias("_own"),
        ),
    )
    per_value = (
        history.select(F.col(spec.key).alias("_id"), F.col(spec.day).alias("_day"), F.explode(counted).alias("_c"))
        .select("_id", "_day", "_c.*")
        .filter((F.col("_starts") == 0) | F.col("_value").isNotNull())
        .groupBy("_id", "_day", "_value")
        .agg(
            F.max("_any").alias("_any"),
            F.count("_any").alias("_changes"),
            F.max("_same").alias("_same"),
            F.sum("_starts").alias("_starts"),
            F.sum("_own").alias("_own"),
        )
        .filter(F.col("_changes") > 0)
    )
    untouched = F.col("_starts") == 0
    only_itself = (F.col("_starts") == 1) & (F.col("_own") == 1)
    candidates = per_value.select(
        "_id", "_day",
        F.when(untouched, F.col("_changes")).when(only_itself, 1).otherwise(0).alias("_ends"),
        F.struct(
            (untouched | only_itself).alias("end"),
            F.when(only_itself, F.col("_same")).otherwise(F.col("_any")).alias("pick"),
        ).alias("_best"),
    )
    per_day = candidates.groupBy("_id", "_day").agg(
        F.max("_best").alias("_best"), F.sum("_ends").alias("terminal_states")
    )
    grouped = {spec.key: "_id", spec.day: "_day"}
    return per_day.select(
        *[F.col(grouped.get(c, f"_best.pick.row.`{c}`")).alias(c) for c in history.columns], "terminal_states"
    )


def build_versions(
    changes: DataFrame,
    snapshot: DataFrame,
    *,
    spec: HistorySpec = HistorySpec(),
    first_day: str = "hire_date",
    surrogate: str = "employee_key",
    slices: int | None = None,
) -> DataFrame:
    """The dimension from collapsed changes and the current snapshot.

    Every change but a key's last is a closed version ending the day before the
    next one. The last one is open and takes its attributes from the snapshot. Keys without
    changes get one open version from ``first_day``. One window over the changes
    (at most one row per key and day) and one join do all three, and the numbers
    follow inside the keys, by which the rows are spread already.
    """
    attributes = list(spec.versioned)
    by_key = Window.partitionBy(spec.key).orderBy(spec.day)
    versions = changes.select(
        F.col(spec.key),
        F.col(spec.day).alias("_from"),
        F.lead(spec.day).over(by_key).alias("_next"),
        F.col(spec.reason).alias("_reason"),
        *[F.col(column).alias(f"_new_{a}") for a, column in spec.versioned.items()],
    )
    joined = snapshot.join(versions, spec.key, "left")
    closed = F.col("_next").isNotNull()
    columns = [
        F.when(closed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c)
        for c in snapshot.columns
    ]
    dimension = joined.select(
        *columns,
        F.coalesce(F.col("_from"), F.col(first_day), F.lit(UNKNOWN_START)).alias("valid_from"),
        F.when(closed, F.date_sub("_next", 1)).otherwise(F.lit(OPEN_END)).alias("valid_to"),
        (~closed).alias("is_current"),
        F.when(closed, F.col("_reason")).alias("change_reason"),
    )
    return number_rows(dimension, [spec.key, "valid_from"], surrogate, slices, grouped=dimension.select(spec.key))


def several_current(dimension: DataFrame, key: str = "employee_id") -> DataFrame:
    """Keys with more than one open version; expect none."""
    counted = dimension.filter("is_current").groupBy(key).agg(F.count(F.lit(1)).alias("current_count"))
    return counted.filter(F.col("current_count") > 1)


def version_counts(dimension: DataFrame, key: str = "employee_id", top: int = 10) -> DataFrame:
    """Keys with the most versions."""
    counted = dimension.groupBy(key).agg(F.count(F.lit(1)).alias("version_count"))
    return counted.orderBy(F.desc("version_count"), key).limit(top)


def version_overlaps(
    dimension: DataFrame, key: str = "employee_id", surrogate: str = "employee_key", slices: int | None = None
) -> DataFrame:
    """Versions starting inside an earlier one of their key; expect none."""
    return overlapping_intervals(
        dimension, key=key, version=surrogate, start="valid_from", end="valid_to", slices=slices
    )


def row_equation(
    dimension: DataFrame, changes: DataFrame, snapshot: DataFrame, key: str = "employee_id"
) -> DataFrame:
    """Rows present against rows expected: one per change plus one per key without changes."""
    known = snapshot.select(key)
    with_person = changes.select(key).join(known, key, "left_semi").agg(row_count()).scalar()
    without_change = known.join(changes.select(key), key, "left_anti").agg(row_count()).scalar()
    return dimension.agg(row_count().alias("actual_rows")).withColumn("expected_rows", with_person + without_change)


def version_gaps(
    dimension: DataFrame, key: str = "employee_id", surrogate: str = "employee_key", slices: int | None = None
) -> DataFrame:
    """Versions not followed directly by the next one; expect none. Rows without a key are left out.

    The dimension may be unsound, with many rows of one key, so groups of any size are spread:
    read backwards, the following start is the last one seen.
    """
    rows = dimension.filter(F.col(key).isNotNull()).select(
        key, surrogate, "valid_to", "valid_from", (-F.unix_date("valid_from")).alias("_back"), (-F.col(surrogate)).alias("_nth"))
    seen = in_order(rows, [key], ["_back", "_nth"], slices=slices).running(
        {"next_valid_from": Running("last", F.col("valid_from"), prior=True)})
    return seen.rows.filter(
        F.col("next_valid_from").isNotNull() & (F.col("next_valid_from") != F.date_add("valid_to", 1))
    ).select(key, surrogate, "valid_to", "next_valid_from")


def adjacent_increases(
    dimension: DataFrame,
    *,
    key: str = "employee_id",
    name: str = "full_name",
    value: str = "salary",
    top: int = 20,
) -> DataFrame:
    """The largest rises from one version to the directly following one.

    The following version is found by ``lead``, one shuffle instead of the two of a
    self join on (key, next day).
    """
    by_key = Window.partitionBy(key).orderBy("valid_from")

    def following(c: str):
        return F.lead(c).over(by_key)

    steps = dimension.select(
        key,
        following(name).alias(name),
        F.col("valid_to"),
        following("valid_from").alias("change_date"),
        F.col(value).alias("previous_salary"),
        following(value).alias("new_salary"),
    ).filter(F.col("change_date") == F.date_add("valid_to", 1))
    rise = F.col("new_salary") - F.col("previous_salary")
    pct = F.round(F.lit(100.0) * rise / F.nullif(F.col("previous_salary"), F.lit(0.0)), 2)
    return (
        steps.select(
            key, name, "change_date", "previous_salary", "new_salary",
            rise.alias("increase_amount"), pct.alias("increase_pct"),
        )
        .orderBy(F.desc("increase_amount"), key, "change_date")
        .limit(top)
    )
