"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mix; share * mix size / source size is
the mean number of times its documents are repeated. A document's number of
copies is a Poisson draw with that mean: the inverse of the distribution at a
uniform number hashed from the seed and the document's id. Copies are exploded
and the whole mix is put in an order hashed from seed, id and copy.

The draw depends on nothing but seed, id and mean, so a task that runs again
draws alike, and a mix can be made again. Sizes are UTF-8 bytes of text,
counted over all rows.

Defined cases: a null source is a source of its own; a null id draws as the
text "null"; null texts have size 0; a source without size or without a share
gives no copies; rows of one id share their draw; an empty table gives an
empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_names, slices_for, stage

SEED = "mix-1"
EXPONENT = 0.7  # of a source's size in its default share: smaller sources are repeated, larger ones thinned
PART = 500.0  # means above are drawn in parts: the smallest probability of a part must not underflow
BROADCAST_ROWS = 10_000  # sources up to which their table is broadcast
SLICE_BYTES = 64 << 20


def uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of the MD5 of the parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def distribution(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, ... up to where nothing measurable is left."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def following(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), last), start, following, lambda state: state["c"])


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", shares: DataFrame | None = None) -> DataFrame:
    """(source, size, share, rate, parts, cdf) per source.

    ``shares`` (source, share) are relative targets; by default a source's size
    to the power of ``EXPONENT``. The mix is as large as the corpus.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")).alias("size"))
    if shares is None:
        shared = sizes.withColumn("share", F.pow(F.col("size").cast("double"), F.lit(EXPONENT)))
    else:
        wanted = shares.groupBy(F.col("source").alias("wanted")).agg(F.sum("share").cast("double").alias("share"))
        shared = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").drop("wanted")
    shared = stage(shared.withColumn("share", F.when(F.col("size") > 0, F.coalesce("share", F.lit(0.0))).otherwise(0.0)), "mix-sizes")
    total = shared.agg(F.sum("size").alias("size"), F.sum("share").alias("share")).first()
    if not total["size"] or not total["share"]:
        shared = shared.withColumn("rate", F.lit(0.0))
    else:
        rate = F.col("share") / F.lit(float(total["share"])) * F.lit(float(total["size"])) / F.col("size")
        shared = shared.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
    return stage(
        shared.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int"))
        .withColumn("cdf", distribution(F.col("rate") / F.col("parts"))),
        "mix-rates",
    )


def mix_sources(
    docs: DataFrame, shares: DataFrame | None = None, seed: str = SEED,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """All columns, plus ``copy`` (1 to ``copies``) and ``copies``, in the order of the mix."""
    spark = docs.sparkSession
    copy, copies, source, parts, cdf, key = fresh_names(docs, "copy", "copies", "mix_source", "mix_parts", "mix_cdf", "mix_key")
    rates = source_rates(docs, source_col, text_col, shares)
    found = rates.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    table = rates.select(F.col("source").alias(source), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    if found["n"] <= BROADCAST_ROWS:
        table = F.broadcast(table)
    one = lambda k: F.size(F.filter(F.col(cdf), lambda c: c < uniform(F.lit(seed), F.col(id_col), k)))
    draw = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda n, k: n + one(k))
    drawn = docs.join(table, F.col(source_col).eqNullSafe(F.col(source))).withColumn(copies, draw).drop(source, parts, cdf)
    repeated = drawn.filter(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    order = uniform(F.lit(seed), F.lit("order"), F.col(id_col), F.col(copy))
    slices = slices_for(spark, found["size"] or 0, SLICE_BYTES)
    return (
        repeated.withColumn(key, order).repartitionByRange(slices, key).sortWithinPartitions(key)
        .select(*docs.columns, copy, copies)
    )
