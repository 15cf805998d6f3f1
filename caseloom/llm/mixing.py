"""Mixing sources to target weights by Poisson replication.

Method.  A source of size S that should make up a share w of a mix of size T
is repeated w * T / S times on average.  Every document draws its number of
copies from a Poisson distribution with that mean: a hash of seed and document
gives a uniform number, and the count is where the cumulative distribution
passes it.  Copies are made by exploding the count; then all rows are shuffled
globally: a seeded hash deals them over partitions and orders them inside.

Sources are counted over all rows.  Nothing groups rows by source but one
pre-aggregated sum, so a source that holds a third of the corpus is dealt out
like any other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import SEED, pack, unpack
from caseloom.session import materialize

STEP = 16.0  # a mean above this is the sum of several draws, so that exp(-mean) stays far from zero
TERMS = 96  # the distribution's tail beyond this many terms is below 2 ** -53 for means up to STEP
MAX_BROADCAST_SOURCES = 10_000  # above this the sources' rates are joined by a shuffle
UNIT = 16 ** 13  # 52 bits of a hash: exact in a double

ABSENT = "\u0000none"  # stands for a null source


def document_key(row: str = "doc") -> Column:
    """What a document's draw hangs on: its id, or its text where it has none."""
    return F.coalesce(F.col(f"{row}.doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(f"{row}.text"), F.lit("")))))


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on key and salt alone."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(UNIT))


def source_rates(docs: DataFrame, weights: dict[str | None, float], other: float, total: int | None = None) -> DataFrame:
    """(name, rate) per source: the mean number of copies; sizes are characters of all texts.

    total: size of the mix, that of the corpus if not given.  Weights are shares
    among the sources present; a source that is not named weighs `other`.
    """
    name = F.coalesce("source", F.lit(ABSENT))
    sizes = docs.groupBy(name.alias("name")).agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("size"))
    weight = F.lit(float(other))
    for source, w in weights.items():
        weight = F.when(F.col("name") == (ABSENT if source is None else source), float(w)).otherwise(weight)
    sizes = materialize(sizes.select("name", "size", weight.alias("weight")), "sources")
    sums = sizes.where("size > 0").agg(F.sum("size"), F.sum("weight")).first()
    size, weight_sum = (total if total is not None else sums[0]) or 0, sums[1] or 0.0
    rate = F.when((F.col("size") > 0) & F.lit(weight_sum > 0), F.col("weight") * F.lit(float(size)) / (F.lit(weight_sum or 1.0) * F.col("size")))
    return sizes.select("name", F.coalesce(rate, F.lit(1.0)).alias("rate"))


def poisson_count(key: Column, mean: Column, seed: int) -> Column:
    """Copies of a document: the inverse of the cumulative distribution at a hashed uniform number.

    A mean above STEP is drawn in equal parts, whose sum has the same distribution.
    """
    parts = F.greatest(F.ceil(mean / STEP), F.lit(1))
    part = mean / parts

    def draw(i: Column) -> Column:
        u = uniform(F.concat_ws("|", key, i.cast("string")), f"copies {seed}")
        start = F.struct(F.lit(0), F.exp(-part), F.exp(-part)).cast("struct<n:int,term:double,sum:double>")

        def add(a: Column, k: Column) -> Column:
            term = a["term"] * part / k
            more = F.struct(a["n"] + 1, term, a["sum"] + term).cast("struct<n:int,term:double,sum:double>")
            return F.when(a["sum"] <= u, more).otherwise(a)

        return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, lambda a: a["n"])

    return F.aggregate(F.transform(F.sequence(F.lit(1).cast("bigint"), parts), draw), F.lit(0), lambda a, b: a + b)


def replicate(docs: DataFrame, weights: dict[str | None, float], other: float = 1.0, total: int | None = None,
              seed: int = SEED) -> DataFrame:
    """(doc, copy, place): the packed row, its copy number from 1, and the key of its place in the mix.

    A document without copies is not in the mix: that is what its source's rate
    says.  A null source is a source of its own; a source without any
    characters has a mean of one; rows that repeat an id draw alike; an empty table gives no rows.
    """
    rates = source_rates(docs, weights, other, total)
    rows = pack(docs).withColumn("name", F.coalesce("doc.source", F.lit(ABSENT)))
    small = rates.count() <= MAX_BROADCAST_SOURCES
    rated = rows.join(F.broadcast(rates) if small else rates, "name")
    count = poisson_count(document_key(), F.col("rate"), seed)
    drawn = rated.select("doc", count.alias("copies")).where("copies > 0")
    copies = drawn.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return copies.withColumn("place", F.md5(F.concat_ws("|", F.lit(f"place {seed}"), document_key(), F.col("copy").cast("string"))))


def shuffled(mix: DataFrame) -> DataFrame:
    """All rows in an order that has nothing to do with where they came from: dealt by hash, sorted by hash."""
    return mix.repartition("place").sortWithinPartitions("place")


def mix_sources(docs: DataFrame, weights: dict[str | None, float], other: float = 1.0, total: int | None = None,
                seed: int = SEED) -> DataFrame:
    """The mix with the columns of docs, shuffled; a document is there once for each copy."""
    return unpack(shuffled(replicate(docs, weights, other, total, seed)).select("doc"))
