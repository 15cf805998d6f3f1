"""Reproducible samples, top-n and set operations.

"Random" order is the md5 of id and seed: the same rows come out of any
partitioning, any cluster and any other engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.session import materialize

_RANK, _PART = "_rank", "_part"

# Up to this n Spark cuts groups before the shuffle (its default threshold);
# beyond it every task's share of a group is a slice of its own at first.
MAX_PARTIAL_LIMIT, PER_TASK = 1000, 1 << 20


Key = str | Sequence[str]


def key_list(key: Key) -> list[str]:
    """A row's key: one column, or several where the first one repeats (a post with many replies)."""
    return [key] if isinstance(key, str) else list(key)


def sample_order(key: Key, seed: int = fv.SAMPLE_SEED) -> list[Column]:
    """Sort columns of the seeded permutation; further key columns break ties."""
    columns = [F.col(k) for k in key_list(key)]
    return [F.md5(F.concat_ws(":", columns[0].cast("string"), F.lit(str(seed)))), *columns]


def first_per_key(df: DataFrame, keys: list[Column], order_by: list[Column]) -> DataFrame:
    return top_n_per_group(df, keys, order_by, 1, fan_in=1)


def top_n_per_group(df: DataFrame, group: list[Column], order_by: list[Column], n: int,
                    fan_in: int = 64) -> DataFrame:
    """First n rows of every group.

    Each task first cuts its own rows to n per group, then groups are cut again
    in fan_in slices of tasks, then as a whole: even a group that holds most of
    the table never meets in one task before it is down to fan_in * n rows.
    """
    names = [f"_group{i}" for i in range(len(group))]
    out = df.withColumns(dict(zip(names, group)))
    slices = [fan_in] if fan_in > 1 else []
    if n > MAX_PARTIAL_LIMIT:
        slices = [PER_TASK, *slices]
    for count in slices:
        out = out.withColumn(_PART, F.spark_partition_id() % count)
        out = _first_rows(out, [*names, _PART], order_by, n).drop(_PART)
    return _first_rows(out, names, order_by, n).drop(*names)


def _first_rows(df: DataFrame, keys: list[str], order_by: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) <= n).drop(_RANK)


def head_per_intent(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    return top_n_per_group(df, [F.col(group)], [F.col(order)], n)


def distinct_buckets(df: DataFrame, bucket: str) -> DataFrame:
    return df.select(bucket).distinct()


def value_counts(df: DataFrame, bucket: str) -> DataFrame:
    return df.groupBy(bucket).agg(F.count("*").alias("count"))


def stratified_sample(df: DataFrame, bucket: str, target: int = fv.GOLDEN_TARGET,
                      key: Key = "customer_tweet_id", seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """max(1, target // buckets) rows of every bucket, without replacement."""
    buckets = distinct_buckets(df, bucket).count()
    per_bucket = max(1, target // max(1, buckets))
    return top_n_per_group(df, [F.col(bucket)], sample_order(key, seed), per_bucket)


def sample_remainder(df: DataFrame, sample: DataFrame, key: Key = "customer_tweet_id") -> DataFrame:
    keys = key_list(key)
    taken = sample.select(*[F.col(k).alias(f"_taken_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_taken_{k}")) for k in keys])
    return df.join(taken, same, "left_anti")


def topup_sample(df: DataFrame, sample: DataFrame, target: int = fv.GOLDEN_TARGET,
                 key: Key = "customer_tweet_id", seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """Fill the sample up to the target from the rows it left out."""
    drawn = materialize(sample, "sample")
    shortfall = target - drawn.count()
    if shortfall <= 0:
        return drawn
    rest = sample_remainder(df, drawn, key)
    return union_samples(drawn, fixed_size_sample(rest, shortfall, key, seed))


def fixed_size_sample(df: DataFrame, n: int, key: Key = "customer_tweet_id",
                      seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """The first n rows of the seeded order; 0 means all rows.

    The keys alone are cut, by a tree over the tasks, to find where the n-th row
    stands; the rows up to there are then read.  Texts never meet in one task.
    """
    return _first_in_order(df, sample_order(key, seed), n) if n else df


def _first_in_order(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    names = [F.col(f"_place.o{i}") for i in range(len(order))]
    first = top_n_per_group(df.select(place.alias("_place")), [F.lit(0)], names, n)
    last = materialize(first.agg(F.max("_place").alias("_last")), "cut")  # one row
    near = df.withColumn("_place", place).join(F.broadcast(last), F.col("_place") <= F.col("_last")).drop("_last")
    # only rows of equal keys can be more than n
    return top_n_per_group(near, [F.lit(0)], names, n).drop("_place")


def shuffle_rows(df: DataFrame, key: Key = "customer_tweet_id", seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """Seeded permutation, by a distributed sort."""
    return df.orderBy(*sample_order(key, seed))


def spread_sample(df: DataFrame, score: str, n: int = fv.HUMAN_SAMPLE_SIZE,
                  key: str = "customer_tweet_id", seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """A third of the lowest scores, a third of the highest, the rest drawn from between.

    Unscored rows count as lowest.  Where the table is smaller than the
    request the parts overlap, and every id is returned once.
    """
    third = n // 3
    known = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    low = _first_in_order(df, [known, F.col(key)], max(third, 1))
    high = _first_in_order(df, [-known, -F.col(key)], max(third, 1))
    ends = materialize(unique_by_id(union_samples(low, high), key), "spread")
    middle = fixed_size_sample(not_in_set(df, ends, key=key), n - 2 * third, key, seed)
    return unique_by_id(union_samples(ends, middle), key)


def union_samples(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unique_by_id(df: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    return df.dropDuplicates([key])


def union_ids(*parts: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    return union_samples(*[p.select(key) for p in parts])


def not_in_set(df: DataFrame, *parts: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """Rows whose id is in none of the parts."""
    return df.join(union_ids(*parts, key=key), key, "left_anti")
