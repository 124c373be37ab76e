"""Exact duplicates by skew-safe combining.

Three combining steps, each grouping by digest *and* full text, so two texts
that share a digest are never taken for one another:

1. local: map tasks collapse their own copies before anything moves;
2. salted: the local survivors meet by (digest, salt), so even a text held by
   a third of all rows is combined by many tasks;
3. global: at most ``salts`` survivors per text meet by digest.

Only survivors carry text. Decisions travel back to the rows by (digest, salt)
with no text at all; digests that stand for several texts, if there are any,
go back by text.

Defined cases: a null text counts as empty; a null id loses to any other; rows
with equal text and equal id are all marked as kept by ``exact_groups`` and
collapse to one row in ``drop_exact_copies``; an empty table gives an empty
result; further columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_names, stage

SALTS = 64


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _combined(rows: DataFrame) -> DataFrame:
    """(digest, t) -> keep, n: the salted and the global step over rows (id, t, digest, salt)."""
    salted = rows.groupBy("digest", "salt", "t").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "t").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: id, digest, keep (largest id of the equal texts), n (group size)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("t"),
        digest(text).alias("digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
    )
    members = stage(rows.select("id", "digest", "salt"), "exact-members")
    winners = stage(
        _combined(rows).select("digest", "keep", "n", F.xxhash64("t").alias("variant")), "exact-winners"
    )
    variants = winners.groupBy("digest").agg(F.count(F.lit(1)).alias("variants"), F.max("keep").alias("keep"), F.max("n").alias("n"))
    # At most `salts` rows per digest, so no key of this or the next join outgrows the others.
    salted = members.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("m")).drop("m").join(variants, "digest")
    out = members.join(salted, ["digest", "salt"])
    plain = out.filter("variants = 1").select("id", "digest", "keep", "n")
    shared = variants.filter("variants > 1").select("digest")
    if shared.isEmpty():
        return plain
    # Texts that share a digest are told apart by content, here too.
    rest = rows.join(shared, "digest", "left_semi")
    by_text = rest.join(_combined(rest), ["digest", "t"])
    return plain.unionByName(by_text.select("id", "digest", "keep", "n"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the one with the largest id."""
    digest, salt, key, row = fresh_names(docs, "digest", "salt", "key", "row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    winner = F.max_by(row, F.struct(F.col(f"{row}.{id_col}").isNotNull(), F.col(f"{row}.{id_col}"))).alias(row)
    return (
        docs.select(
            sha256(text).alias(digest),
            F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias(salt),
            text.alias(key),
            F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias(row),
        )
        .groupBy(digest, salt, key).agg(winner)
        .groupBy(digest, key).agg(winner)
        .select(f"{row}.*")
    )
