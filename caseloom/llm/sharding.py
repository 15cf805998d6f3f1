"""Shards by a two-pass external shuffle.

Method.  Pass one scatters the rows by a seeded hash into buckets that fit in
memory; Spark's shuffle files are the external storage.  Pass two shuffles each
bucket by Fisher and Yates (the built-in `shuffle`, seeded) and lays the
buckets end to end: a row's place is the number of rows in the buckets before
plus its place in its own.  Places are dealt to the shards like cards, so
shards differ by one row at most (law `rows`).

A bucket's content depends on ids and seed only, and rows are sorted before
they are shuffled, so a lost task comes back the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import SEED, pack
from caseloom.llm.mixing import document_key
from caseloom.session import materialize

SHARDS = 40
BUCKET_BYTES = 8 << 20  # of text; a task holds a few times this much while it shuffles a bucket
ROW_BYTES = 16


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """(doc, shard, slot): every packed row with its shard and its place there, gapless from 0.

    Null and empty texts have a size of 16; rows without id are scattered by their
    text; rows that repeat id and text meet in one bucket; extra columns come
    along; an empty table gives no rows.
    """
    rows = pack(docs)
    total = docs.agg(F.sum(row_size(F.col("text")))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), document_key(), F.coalesce(F.col("doc.text"), F.lit("")))
    scattered = rows.select(F.pmod(hashed, F.lit(n)).alias("bucket"), hashed.alias("h"), "doc")
    # one row per bucket: n follows from the size of the corpus, 8 MB of text for each
    counts = materialize(scattered.groupBy("bucket").agg(F.count("*").alias("rows")), "buckets")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    held = (scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("h", "doc"))).alias("rows"))
            .join(offsets, "bucket").sortWithinPartitions("bucket"))
    dealt = held.select("offset", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("at", "row"))
    place = F.col("offset") + F.col("at")
    return dealt.select(F.col("row.doc").alias("doc"), (place % shards).cast("int").alias("shard"), F.floor(place / shards).cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> None:
    """Write the rows below path, a folder for each shard; slot gives the order."""
    placed = shuffle_into_shards(docs, shards, bucket_bytes, seed)
    placed.select("doc.*", "shard", "slot").write.partitionBy("shard").parquet(path)


def placements(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, from the shuffled rows themselves."""
    placed = shuffle_into_shards(docs.select("doc_id", "text"), shards, bucket_bytes, seed)
    return placed.select(F.col("doc.doc_id").alias("doc_id"), row_size(F.col("doc.text")).alias("size"),
                         F.crc32(F.coalesce(F.col("doc.text"), F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
