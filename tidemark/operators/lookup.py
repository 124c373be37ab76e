"""Lookup joins that prove their size and uniqueness before running."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import Running, in_order
from tidemark.session import stage

# A side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key holding more than this share of the rows is joined apart from the rest;
# at most 1 / HOT_SHARE keys can qualify.
HOT_SHARE = 0.001

# So does a key with more rows than this, whatever their share.
HOT_ROWS = 50_000_000

# Values that the search for frequent ones tracks in a pass, and lists. Tracking 12 / HOT_SHARE leaves an error
# of about HOT_SHARE / 4, so none above HOT_SHARE is missed.
_TRACKED = math.ceil(12 / HOT_SHARE)
_LISTED = math.ceil(2 / HOT_SHARE)

# Salts for facts that only pass through a lookup shuffle.
_SALTS = 10_007


class OverlapError(ValueError):
    """Versions of one key overlap, so more than one could be valid on a day."""


class DuplicateKeyError(ValueError):
    """A lookup side has several rows for one key, so joining would add rows."""


@dataclass(frozen=True)
class SideSize:
    rows: int
    copies: int
    bytes: int


def measure(dim: DataFrame, keys: list[str]) -> SideSize:
    """Rows, most rows per key and in-memory bytes of a side, in one job."""
    per_key = dim.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(_row_bytes(dim)).alias("_b")
    )
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    row = per_key.agg(
        F.sum("_n").alias("rows"),
        F.max(F.when(has_key, F.col("_n"))).alias("copies"),
        F.sum("_b").alias("bytes"),
    ).first()
    return SideSize(row["rows"] or 0, row["copies"] or 0, row["bytes"] or 0)


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(16).cast("long")
    for field in df.schema.fields:
        size = size + _value_bytes(F.col(f"`{field.name}`"), field.dataType)
    return size


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        size = F.lit(8).cast("long")
        for field in kind.fields:
            size = size + _value_bytes(value.getField(field.name), field.dataType)
        return size
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.lit(8) + F.coalesce(F.octet_length(F.to_json(value)), F.lit(0))
    return F.lit(8).cast("long")


class HotKeys:
    """Keys with very many rows, for several lookups of one base table in a single pass.

    Searched when the first large lookup asks, then kept in the shared folder.
    """

    def __init__(self, base: DataFrame, columns: list[str]):
        self.base, self.columns = base, columns
        self._rows: int | None = None
        self._found: DataFrame | None = None

    def rows(self) -> int:
        """Rows of the base, from the search where there was one."""
        return self.base.count() if self._rows is None else self._rows

    def of(self, column: str, name: str) -> DataFrame:
        """The hot values of ``column`` as a small table with one column ``name``; null is one of them."""
        if self._found is None:
            self._found, self._rows = _frequent(self.base, self.columns)
        kind = self.base.schema[column].dataType
        return self._found.filter(F.col("c") == column).select(F.col("v").cast(kind).alias(name))


def _frequent(base: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """(column, value as text) of the values above ``HOT_SHARE`` or ``HOT_ROWS``, null too, and the rows of ``base``.

    Every task keeps the values that may be frequent, so the many others are not shuffled. Nothing above the share is
    missed, and what is a quarter below it may be listed, which costs nothing: the keys only choose a way to join.
    Where ``HOT_ROWS`` is less than the share, the values are counted.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    listed = [F.call_function("approx_top_k", t, F.lit(_LISTED), F.lit(_TRACKED)) for t in texts]
    seen = stage(base.agg(
        F.count(F.lit(1)).alias("n"),
        *[top.alias(f"top{i}") for i, top in enumerate(listed)],
        *[F.count(F.when(t.isNull(), 1)).alias(f"null{i}") for i, t in enumerate(texts)],
    ), "key-counts")
    rows = seen.select("n").first()[0]
    if rows * HOT_SHARE > HOT_ROWS:
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), t.alias("v")) for c, t in zip(columns, texts)])
        counts = base.select(F.explode(pairs).alias("p")).groupBy("p.c", "p.v").agg(F.count(F.lit(1)).alias("_n"))
        return stage(_over_bound(stage(counts, "key-counts"), ["c"]), "hot-keys"), rows
    values = F.array(*[
        F.struct(
            F.lit(c).alias("c"),
            F.concat(
                F.transform(F.filter(f"top{i}", lambda x: x["item"].isNotNull()),
                            lambda x: F.struct(x["item"].alias("v"), x["count"].alias("_n"))),
                F.array(F.struct(F.lit(None).cast("string").alias("v"), F.col(f"null{i}").alias("_n"))),
            ).alias("found"),
        )
        for i, c in enumerate(columns)
    ])
    found = seen.select("n", F.explode(values).alias("e")).select("n", "e.c", F.explode("e.found").alias("f"))
    return stage(found.filter(F.col("f._n") > F.col("n") * HOT_SHARE).select("c", "f.v", "f._n"), "hot-keys"), rows


def _over_bound(counts: DataFrame, within: list[str]) -> DataFrame:
    """Counted keys above the share or the row bound; the share is of the same counts."""
    total = counts.groupBy(*within).agg(F.sum("_n").alias("_all"))  # one row per column
    joined = counts.join(F.broadcast(total), within) if within else counts.withColumn("_all", total.select("_all").scalar())
    return joined.filter((F.col("_n") > F.col("_all") * HOT_SHARE) | (F.col("_n") > HOT_ROWS)).drop("_all")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    columns: list[str] | dict[str, str],
    *,
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``columns`` of ``dim`` to ``fact`` without changing its row count.

    ``on`` maps fact column to lookup column. The lookup side is measured first:
    duplicate keys raise :class:`DuplicateKeyError`, a side within ``max_bytes``
    is broadcast, and a larger one is shuffled with the hot keys split off. ``hot``
    shares the count of hot keys between the lookups of one fact.
    ``how='inner'`` drops facts without a match instead.
    """
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    taken = set(names) & set(fact.columns)
    if taken:
        raise ValueError(f"columns already present: {sorted(taken)}")
    side = dim.select(
        *[F.col(d).alias(f"_k{i}") for i, d in enumerate(on.values())],
        *[F.col(c).alias(f"_v_{n}") for n, c in names.items()],
    )
    keys = [f"_k{i}" for i in range(len(on))]
    size = measure(side, keys)
    if size.copies > 1:
        raise DuplicateKeyError(f"lookup key {list(on.values())} has up to {size.copies} rows per value")
    if size.bytes <= max_bytes:
        joined = fact.join(F.broadcast(side), _match(on), how)
    else:
        joined = _join_apart(fact, side, on, how, hot)
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], *[F.col(f"_v_{n}").alias(n) for n in names])


def _match(on: dict[str, str]) -> Column:
    condition = F.lit(True)
    for i, column in enumerate(on):
        condition = condition & (F.col(f"`{column}`") == F.col(f"_k{i}"))
    return condition


def _join_apart(
    fact: DataFrame, side: DataFrame, on: dict[str, str], how: str, known: HotKeys | None
) -> DataFrame:
    """Shuffle join for the many small keys, broadcast join for the few hot ones, in one pass.

    Where no key is hot, nor the missing key, it is a plain join, whose partitions the next
    lookup by the same key can use without another shuffle. Otherwise facts answered by the broadcast, and facts without a key, go through the shuffle
    with an empty key and a salt, which spreads them evenly and matches nothing.
    """
    fact_keys = list(on)
    side_keys = [f"_k{i}" for i in range(len(on))]
    values = [c for c in side.columns if c not in side_keys]
    if known is not None and len(fact_keys) == 1 and fact_keys[0] in known.columns:
        hot = known.of(fact_keys[0], side_keys[0])
    else:
        hot = _hot_keys(fact, fact_keys, side_keys)
    if hot.isEmpty():
        return fact.join(side, _match(on), how)
    hot = hot.dropna()
    # at most 1 / HOT_SHARE rows, and one for each HOT_ROWS rows of the fact
    found = side.join(F.broadcast(hot), side_keys, "left_semi").withColumn("_found", F.lit(True))
    hot_side = hot.join(F.broadcast(found), side_keys, "left").select(
        *side_keys, F.lit(True).alias("_hot"),
        F.col("_found").alias("_hot_found"), *[F.col(v).alias(f"_hot{v}") for v in values],
    )
    marked = fact.join(F.broadcast(stage(hot_side, "hot-side")), _match(on), "left").drop(*side_keys)

    apart = F.col("_hot").isNotNull()
    for key in fact_keys:
        apart = apart | F.col(f"`{key}`").isNull()
    plain = [F.col(f"`{f.name}`") for f in fact.schema.fields if isinstance(f.dataType, T.AtomicType)]
    salt = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(_SALTS))
    salted = marked.select(
        "*",
        *[F.when(~apart, F.col(f"`{key}`")).alias(f"_c{i}") for i, key in enumerate(fact_keys)],
        F.when(apart, salt).otherwise(F.lit(0)).alias("_salt"),
    )
    # always 0, but not a literal: the optimiser would take a literal out of the join keys
    unsalted = side.dropna(subset=side_keys).select(
        "*", F.lit(True).alias("_found"), F.pmod(F.xxhash64(*side_keys), F.lit(1)).alias("_zero")
    )
    condition = F.col("_salt") == F.col("_zero")
    for i, key in enumerate(side_keys):
        condition = condition & (F.col(f"_c{i}") == F.col(key))
    joined = salted.join(unsalted, condition, "left")
    if how == "inner":
        joined = joined.filter(F.coalesce("_found", "_hot_found"))
    hit = F.col("_hot").isNotNull()
    return joined.select(
        *[F.col(f"`{c}`") for c in fact.columns],
        *[F.when(hit, F.col(f"_hot{v}")).otherwise(F.col(v)).alias(v) for v in values],
    )


def _hot_keys(fact: DataFrame, fact_keys: list[str], side_keys: list[str]) -> DataFrame:
    """The keys above ``HOT_SHARE`` or ``HOT_ROWS``, missing ones too, as a small stored table. Keys of several columns are counted."""
    if len(fact_keys) == 1 and isinstance(fact.schema[fact_keys[0]].dataType, T.AtomicType):
        return HotKeys(fact, fact_keys).of(fact_keys[0], side_keys[0])
    keyed = fact.select(*[F.col(f"`{k}`").alias(s) for k, s in zip(fact_keys, side_keys)])
    counts = keyed.groupBy(*side_keys).agg(F.count(F.lit(1)).alias("_n"))
    return stage(_over_bound(stage(counts, "key-counts"), []).select(*side_keys), "hot-keys")


def missing_references(fact: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
    """Values of ``column`` absent from the reference, with how many rows hold each.

    Rows are counted per value before the anti join, so a value held by most rows
    crosses the shuffle once.
    """
    used = fact.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = reference.select(F.col(ref_column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return used.join(known, "value", "left_anti")


def point_in_time_join(
    fact: DataFrame,
    versions: DataFrame,
    *,
    key: str,
    date: str,
    order: list[str] | None = None,
    version_key: str,
    valid_from: str,
    valid_to: str,
    columns: dict[str, str],
    max_bytes: int = BROADCAST_BYTES,
    slices: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the columns of the version valid on the fact's date (both ends inclusive).

    Facts before the first version, or in a gap, keep nulls. Versions of a key
    that share a start raise :class:`DuplicateKeyError`, others that overlap raise
    :class:`OverlapError`, before anything is joined, so both ways below give one row
    per fact. Versions without key, start or end match nothing. A measured small version table is broadcast and matched by
    range; otherwise facts and versions are merged in date order and each fact
    takes the last version started, with groups of any size spread over slices.
    ``order`` has no effect: facts of equal key and date take the same version. ``counted``
    is a frame with the facts' keys that costs less to count than ``fact``.
    """
    side = versions.select(
        F.col(version_key).alias("_k0"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        F.struct(*[F.col(c).alias(n) for n, c in columns.items()]).alias("_version"),
    )
    side = stage(side.dropna(subset=["_k0", "_from", "_to"]), "versions")
    size = measure(side, ["_k0", "_from"])
    if size.copies > 1:
        raise DuplicateKeyError(f"up to {size.copies} versions of one {version_key} start on one day")
    earlier = in_order(side.select("_k0", "_from", "_to"), ["_k0"], ["_from"], slices=slices).running(
        {"_reach": Running("max", F.col("_to"), prior=True)})
    if not earlier.rows.filter(F.col("_reach") >= F.col("_from")).isEmpty():
        raise OverlapError(f"versions of one {version_key} overlap")
    if size.bytes <= max_bytes:
        in_range = (F.col(f"`{key}`") == F.col("_k0")) & F.col(date).between(F.col("_from"), F.col("_to"))
        joined = fact.join(F.broadcast(side), in_range, "left")
    else:
        joined = _latest_started(fact, side, key, date, fact if counted is None else counted, slices)
    return joined.select(
        *[F.col(f"`{c}`") for c in fact.columns], *[F.col(f"_version.{n}").alias(n) for n in columns]
    )


def _latest_started(fact, side, key, date, counted, slices):
    """Facts and versions in one date order; a fact takes the last version started before it.

    Facts without key find no version in their group, those without date sort before all.
    The columns of the facts stay columns, so that those not asked for are not shuffled.
    """
    starts = side.select(
        F.col("_k0").alias("_id"), F.col("_from").alias("_on"), F.lit(0).alias("_kind"),
        F.struct("_to", "_version").alias("_start"),
    )
    shared = {
        c: part for c, part in ((key, "_id"), (date, "_on")) if fact.schema[c].dataType == starts.schema[part].dataType
    }
    names = {c: shared.get(c, f"_f{i}") for i, c in enumerate(fact.columns)}
    rows = fact.select(
        F.col(f"`{key}`").alias("_id"), F.col(f"`{date}`").alias("_on"), F.lit(1).alias("_kind"),
        *[F.col(f"`{c}`").alias(n) for c, n in names.items() if c not in shared],
    )
    merged = rows.unionByName(starts, allowMissingColumns=True)
    keys = counted.select(F.col(f"`{key}`").alias("_id")).unionByName(starts.select("_id"))
    ordered = in_order(merged, ["_id"], ["_on", "_kind"], slices=slices, counted=keys)
    latest = ordered.running({"_latest": Running("last", F.col("_start"))})
    return latest.rows.filter(F.col("_kind") == 1).select(
        *[F.col(n).alias(c) for c, n in names.items()],
        F.when(F.col("_latest._to") >= F.col("_on"), F.col("_latest._version")).alias("_version"),
    )
