"""Ordered computations that stay distributed when one group holds most rows.

A plain ``Window.partitionBy(group)`` sends a whole group to one task, which is fine
until a group outgrows a task. :func:`in_order` looks at the sizes of the groups first,
reading their columns alone. If every group is small, plain windows are used: one
shuffle, and nothing is written. Otherwise the rows are range-split by (group, order)
into as many slices as the counted rows fill, so that a big group spans several; each slice
computes its own running value, and what earlier slices of the same group contribute
(the carry) is added afterwards. Because slices follow the order of the groups, only
the first group of a slice can continue an earlier one: the carry table has at most one
row per slice, which is what allows broadcasting it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

SLICE = "_slice"

# Largest group, in rows, that is left to a single task.
WHOLE_GROUP_ROWS = 4_000_000

# Largest table, in rows, that is numbered by a single task.
WHOLE_TABLE_ROWS = 500_000

# Rows of a slice, about, and slices at most. Beyond that number slices hold more rows (a slice is
# sorted with spilling), so that what is known per slice stays small enough to broadcast.
SLICE_ROWS = 2_000_000
MOST_SLICES = 100_000

# Last range key: tells apart equal rows of different input partitions, so that a
# large group of copies is cut as well.
_SPREAD = "_spread"

# monotonically_increasing_id() puts the partition number above these bits.
_POSITION_BITS = 33


@dataclass(frozen=True)
class Running:
    """One running value: ``sum``, ``min``, ``max`` or ``last`` (last non-null).

    ``prior=True`` leaves the current row out.
    """

    kind: str
    value: Column
    prior: bool = False


@dataclass(frozen=True)
class Ordered:
    """Rows prepared by :func:`in_order`; its methods add columns to ``rows``."""

    rows: DataFrame
    group: list[str]
    order: list[str]
    split: bool

    @property
    def _parts(self) -> list[str]:
        return [*self.group, SLICE] if self.split else self.group

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return replace(self, rows=self.rows.withColumns(columns))

    def plain(self) -> DataFrame:
        """The rows without the slice number."""
        return self.rows.drop(SLICE)

    def running(self, values: dict[str, Running]) -> Ordered:
        """Add running values over each whole group."""
        here = Window.partitionBy(*self._parts).orderBy(*self.order)
        upto_here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = here.rowsBetween(Window.unboundedPreceding, -1)
        local = self.rows.select(
            "*",
            *[_aggregate(v.kind, v.value).over(before if v.prior else upto_here).alias(name)
              for name, v in values.items()],
        )
        if self.split:
            carried, match = self._carry(values)
            local = local.join(F.broadcast(carried), match, "left")
        carry = {name: F.col(f"_carry_{name}") if self.split else F.lit(None) for name in values}
        combined = [_combine(v, carry[name], F.col(name)).alias(name) for name, v in values.items()]
        return replace(self, rows=local.select(*[F.col(c) for c in self.rows.columns], *combined))

    def _carry(self, values: dict[str, Running]) -> tuple[DataFrame, Column]:
        """What earlier slices of its group pass on to each slice: at most one row per slice."""

        def total(item: Running) -> Column:
            if item.kind == "last":
                return F.max_by(item.value, F.when(item.value.isNotNull(), F.struct(*self.order)))
            return _aggregate(item.kind, item.value)

        per_slice = self.rows.groupBy(*self._parts).agg(*[total(v).alias(name) for name, v in values.items()])
        by_slice = Window.partitionBy(*self.group).orderBy(SLICE)
        earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
        carried = per_slice.select(
            *[F.col(g).alias(f"_to_{g}") for g in self._parts],
            F.row_number().over(by_slice).alias("_nth"),
            *[_aggregate(v.kind, F.col(name)).over(earlier).alias(f"_carry_{name}") for name, v in values.items()],
        )
        match = F.lit(True)
        for g in self._parts:
            match = match & (F.col(g) == F.col(f"_to_{g}"))
        return carried.filter(F.col("_nth") > 1).drop("_nth"), match

    def totals(self, values: dict[str, Column]) -> Ordered:
        """Add sums over each whole group.

        In split groups the sum is joined on (group, slice), which keeps them spread.
        """
        whole = Window.partitionBy(*self.group)
        if not self.split:
            return self.with_columns({name: F.sum(v).over(whole) for name, v in values.items()})
        per_slice = self.rows.groupBy(*self._parts).agg(*[F.sum(v).alias(n) for n, v in values.items()])
        sums = per_slice.select(*self._parts, *[F.sum(n).over(whole).alias(n) for n in values])
        return replace(self, rows=self.rows.join(sums, self._parts))


def in_order(
    df: DataFrame,
    group: list[str],
    order: list[str],
    *,
    slices: int | None = None,
    whole_rows: int = WHOLE_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> Ordered:
    """Prepare ``df`` for running values per group.

    The groups are counted from the plan of ``df`` with all other columns pruned, and rows
    are written only where a group has to be split: once before the split, whose boundaries
    Spark samples in a pass of its own, and once with the slice numbers, as a second
    evaluation could cut elsewhere. ``order`` must make the rows of a group distinct (or
    leave only interchangeable ones). Rows of a null group get no carry. ``slices`` forces a
    split into that many; otherwise their number follows the counted rows. ``counted`` is a frame
    with the same groups that costs less to count than ``df``.
    """
    if slices is None:
        sizes = (df if counted is None else counted).groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
        if (largest or 0) <= whole_rows:
            return Ordered(df, group, order, split=False)
        slices = slice_count(total, min(SLICE_ROWS, whole_rows))
    ranged = _range_split(stage(df, "ordered"), [*group, *order], slices)
    sliced = stage(ranged.drop(_SPREAD).withColumn(SLICE, F.spark_partition_id()), "slices")
    return Ordered(sliced, group, order, split=True)


def slice_count(rows: int, slice_rows: int = SLICE_ROWS) -> int:
    """Slices that ``rows`` fill: in proportion to them, up to ``MOST_SLICES``."""
    return max(1, min(MOST_SLICES, -(-rows // max(1, slice_rows))))


def _range_split(df: DataFrame, keys: list[str], slices: int) -> DataFrame:
    return df.withColumn(_SPREAD, F.spark_partition_id()).repartitionByRange(slices, *keys, _SPREAD)


def number_rows(
    df: DataFrame, order: list[str], name: str, slices: int | None = None, whole_rows: int = WHOLE_TABLE_ROWS,
    rows: int | None = None, grouped: DataFrame | None = None,
) -> DataFrame:
    """Dense 1..n numbering in ``order``, equal to a global ``row_number``.

    A table of at most ``whole_rows`` counted rows is numbered by one window. A larger
    one is cut into range slices: sort each, number inside it, and add the sizes of the
    earlier slices (one row per slice, broadcast), without a single task that sees all
    rows. ``order`` must leave no ties but interchangeable rows. ``slices`` forces a cut.
    ``rows`` is the number of rows where it is known, which spares counting them.
    ``grouped`` is a frame with the same values of the first column of ``order``, as often as in
    ``df``, and small to read: where none of them outgrows a task, rows are numbered inside their
    value, after the sizes of the smaller values. Then ``df`` is spread by that column, which
    lookups by it can use as well, and is not written.
    """
    if slices is None and grouped is not None:
        sizes = grouped.groupBy(F.col(order[0]).alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
        sizes = stage(sizes, "group-sizes")
        rows, largest = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.max("_n")).first()
        if whole_rows < rows and largest <= WHOLE_GROUP_ROWS:
            return _number_inside(df, order, name, sizes, slice_count(rows, min(SLICE_ROWS, whole_rows)))
    if slices is None:
        if rows is None:
            rows = df.select(*order).count()
        if rows <= whole_rows:
            return df.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias(name), *df.columns)
        slices = slice_count(rows, min(SLICE_ROWS, whole_rows))
    staged = _placed(df, order, slices)
    part = F.shiftright("_pos", _POSITION_BITS)
    sizes = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    in_slice = F.col("_pos").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return staged.join(F.broadcast(offsets), part == F.col("_part")).select(
        (F.col("_offset") + in_slice + 1).alias(name), *df.columns
    )


def _number_inside(df: DataFrame, order: list[str], name: str, sizes: DataFrame, slices: int) -> DataFrame:
    """Numbers from the sizes of the smaller values of ``order[0]`` and the place inside a value."""
    ranged = _range_split(sizes, ["_group"], slices).drop(_SPREAD)
    sliced = stage(ranged.withColumn(SLICE, F.spark_partition_id()), "group-slices")
    ahead = Ordered(sliced, [], ["_group"], split=True).running({"_ahead": Running("sum", F.col("_n"), prior=True)})
    place = F.row_number().over(Window.partitionBy(order[0]).orderBy(*order))
    found = df.withColumn("_place", place).join(ahead.rows.select("_group", "_ahead"), F.col(order[0]) == F.col("_group"), "left")
    # null sorts first and matches nothing: nothing is ahead of it
    return found.select((F.coalesce("_ahead", F.lit(0)) + F.col("_place")).cast("long").alias(name), *df.columns)


def _placed(df: DataFrame, order: list[str], slices: int) -> DataFrame:
    """``df`` sorted over range slices, with its slice and position in ``_pos``."""
    ranged = _range_split(df, order, slices).drop(_SPREAD)
    placed = ranged.sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id())
    return stage(placed, "numbered")


def _aggregate(kind: str, value: Column) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "min":
        return F.min(value)
    if kind == "max":
        return F.max(value)
    if kind == "last":
        return F.last(value, ignorenulls=True)
    raise ValueError(f"unknown running value: {kind}")


def _combine(item: Running, carry: Column, local: Column) -> Column:
    if item.kind == "sum":
        zero = F.lit(0)
        return F.coalesce(local, zero) + F.coalesce(carry, zero)
    if item.kind == "min":
        return F.least(local, carry)
    if item.kind == "max":
        return F.greatest(local, carry)
    return F.coalesce(local, carry)
