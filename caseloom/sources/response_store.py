"""Answers of a scorer, kept as a log of segments that is compacted now and then.

    path/segments/<name>/bucket=<n>/...   answers; bucket: the key's first byte
    path/filters/<name>/...               which keys a segment may hold
    path/manifest/<number>/               the segments that count

An append writes one segment and its filter: for every bucket a field of bits, of
which each key sets three (a key is a digest, so its digits are the hashes).  A
lookup first asks the filters, which answer "not there" without reading an
answer, then reads the buckets that are left: a partition filter on the scan.
Compaction writes the newest answer of each key as one segment with a wider
filter, and publishes it in place of the segments it read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.joins import join_lookup
from caseloom.session import materialize
from caseloom.sources import manifests
from caseloom.sources.tables import RESPONSE_CACHE

BUCKETS, PLACES, WORD = 32, 3, 63  # a bit field's words are longs; their sign stays free
MAX_LISTED_KEYS = 1_000  # so few keys are a filter on the scan of their own
LEAST_WORDS, BITS_PER_KEY = 64, 12

_SCHEMA = "name string, words int, keys bigint"


def bucket_of(key: Column) -> Column:
    """0 to BUCKETS - 1; a key that is no hex digest is hashed."""
    return F.coalesce(F.conv(F.substring(key, 1, 2), 16, 10).try_cast("int"), F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")) % BUCKETS


def _bits(key: Column, words: int) -> Column:
    """array<struct<word, mask>>: the bits of a key in a field of so many words."""
    places = [F.pmod(F.xxhash64(F.lit(i), key), F.lit(words * WORD)) for i in range(PLACES)]
    return F.array(*[F.struct(F.floor(p / WORD).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (p % WORD).cast("int")).alias("mask"))
                     for p in places])


@dataclass(frozen=True)
class ResponseStore:
    """The segments of one manifest: (name, words of its filter's fields, keys)."""

    spark: SparkSession
    path: str
    segments: tuple[tuple[str, int, int], ...] = ()

    @staticmethod
    def open(spark: SparkSession, path: str) -> ResponseStore:
        """The newest state; an empty store where there is none yet."""
        listed = manifests.read(spark, f"{path}/manifest")
        rows = [] if listed is None else sorted(tuple(r) for r in listed.collect())  # a row per segment
        return ResponseStore(spark, path, tuple(r for r in rows if r[0]))

    def _read(self, buckets: list[int] | None = None) -> DataFrame:
        if not self.segments:
            return self.spark.createDataFrame([], RESPONSE_CACHE).withColumn("bucket", F.lit(0))
        base = f"{self.path}/segments"
        # the newest segments may hold few buckets: the schema is given, not looked for
        schema = RESPONSE_CACHE.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ") + ", name string, bucket int"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/name={n}" for n, _, _ in self.segments])
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def rows(self) -> DataFrame:
        """Every answer written, as (key, response, written_at)."""
        return self._read().select("key", "response", "written_at")

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """The distinct keys that some segment's filter does not rule out, with their bucket."""
        asked = keys.select("key").where("key is not null").distinct().withColumn("bucket", bucket_of(F.col("key")))
        if not self.segments:
            return asked.limit(0)
        filters = self.spark.read.parquet(*[f"{self.path}/filters/{n}" for n, _, _ in self.segments])
        sizes = {w for _, w, _ in self.segments}
        tested = asked.select("key", "bucket", F.explode(F.array(*[F.lit(w) for w in sorted(sizes)])).alias("words"))
        bits = F.when(F.col("words") == min(sizes), _bits(F.col("key"), min(sizes)))
        for w in sorted(sizes)[1:]:
            bits = bits.when(F.col("words") == w, _bits(F.col("key"), w))
        spread = tested.select("key", "bucket", "words", F.explode(bits).alias("b")).select("key", "bucket", "words", "b.word", "b.mask")
        hits = spread.join(filters, ["bucket", "words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) != 0)
        full = hits.groupBy("key", "bucket", "segment").agg(F.count_distinct("word", "mask").alias("hits"))
        # two of a key's bits may fall together
        wanted = spread.groupBy("key", "words").agg(F.count_distinct("word", "mask").alias("bits")).groupBy("key").agg(F.min("bits").alias("bits"))
        return full.join(wanted, "key").where("hits >= bits").select("key", "bucket").distinct()

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(key, response) newest answers of the keys that have one; only the buckets asked for are read."""
        maybe = materialize(self.maybe_known(keys), "asked")
        return self._latest(maybe)

    def _latest(self, maybe: DataFrame) -> DataFrame:
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # BUCKETS at most
        few = [r["key"] for r in maybe.select("key").limit(MAX_LISTED_KEYS + 1).collect()]
        rows = self._read(sorted(buckets))
        if len(few) <= MAX_LISTED_KEYS:  # segments are sorted by key, so row groups are skipped
            rows = rows.where(F.col("key").isin(few))
        found = rows.join(maybe.select("key"), "key", "left_semi")
        return newest(found).select("key", "response")

    def append(self, answers: DataFrame) -> ResponseStore:
        """The store with further answers (key, response, written_at); rows without key or response stay out."""
        kept = answers.where("key is not null and response is not null").select("key", "response", "written_at")
        segment = self._write(kept)
        return self if segment is None else self._publish((*self.segments, segment))

    def compact(self) -> ResponseStore:
        """One segment of the newest answer of each key, in place of all."""
        if not self.segments:
            return self
        segment = self._write(newest(self.rows()))
        return self._publish(() if segment is None else (segment,))

    def _write(self, answers: DataFrame) -> tuple[str, int, int] | None:
        name = uuid.uuid4().hex
        home = f"{self.path}/segments/name={name}"
        placed = answers.withColumn("bucket", bucket_of(F.col("key")))
        # rows are cut by key where a bucket is large
        placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(home)
        written = self.spark.read.schema("key string, bucket int").parquet(home)
        n = written.count()
        if not n:
            return None
        words = max(LEAST_WORDS, 1 << (n * BITS_PER_KEY // (BUCKETS * WORD)).bit_length())
        bits = written.select("bucket", F.explode(_bits(F.col("key"), words)).alias("b"))
        fields = bits.groupBy("bucket", "b.word").agg(F.bit_or("b.mask").alias("bits"))
        fields.select(F.lit(name).alias("segment"), F.lit(words).alias("words"), "bucket", "word", "bits").write.parquet(f"{self.path}/filters/{name}")
        return name, words, n

    def _publish(self, segments: tuple) -> ResponseStore:
        manifests.publish(self.spark, f"{self.path}/manifest", list(segments) or [("", 0, 0)], _SCHEMA)
        return ResponseStore(self.spark, self.path, tuple(segments))


def newest(answers: DataFrame) -> DataFrame:
    """The last written answer of each key; of answers written at once, the greater."""
    last = F.max(F.struct("written_at", "response")).alias("last")
    return answers.groupBy("key").agg(last).select("key", "last.response", "last.written_at")


def without(requests: DataFrame, known: DataFrame) -> DataFrame:
    """Requests whose key has no known answer."""
    marked = join_lookup(requests, known.select("key", F.lit(True).alias("_known")), "key")
    return marked.where(F.col("_known").isNull()).drop("_known")
