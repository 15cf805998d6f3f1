"""Document fingerprints from spot signatures.

Method.  A spot starts at a common word (an anchor) and is the chain of the
content words that follow it.  The set of a document's spots is its
fingerprint: chains hang on running text, so menus, tables and other dressing
leave few of them.  Sets are compared by Jaccard similarity; two sets whose
sizes differ by more than the threshold allows cannot reach it, so a join needs
only sets of neighbouring size classes, and only pairs that share a rare spot.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType

from caseloom.session import materialize

# Common words of four languages.
ANCHORS = frozenset("""
a an and are as at be by for from had has have he in is it its not of on or she that the their they this to was were which will with you
au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne nous on ou par pas pour que qui sa se ses son sur un une vous
al como con de del el en es esta este ha la las lo los más no o para pero por que se si sin sobre su sus un una y
aber als am an auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht oder sich sie sind so und von war wie wird zu zum zur
""".split())

CHAIN = 2  # content words of a spot
PARTITION_BYTES = 24 << 20  # of text
_WORD = re.compile(r"[^\W_]+")


@lru_cache(maxsize=4)  # a document is looked at as itself and as the one that follows
def spots(text: str) -> frozenset[int]:
    """Hashes of a text's spots; of all chains of words if it has no spot, of the text itself if it has no words."""
    words = _WORD.findall(text.lower())
    content = [w for w in words if w not in ANCHORS]
    found, ahead = set(), 0  # ahead: content words before this place
    for w in words:
        if w in ANCHORS:
            chain = content[ahead: ahead + CHAIN]
            if len(chain) == CHAIN:
                found.add(hash_of(f"{w} {' '.join(chain)}"))
        else:
            ahead += 1
    if not found:
        chains = [words[i: i + CHAIN] for i in range(max(1, len(words) - CHAIN + 1))] if words else [[text]]
        found = {hash_of(" ".join(c)) for c in chains}
    return frozenset(found)


def hash_of(spot: str) -> int:
    return int.from_bytes(hashlib.blake2b(spot.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little")


def as_text(found: frozenset[int]) -> str:
    """The sorted hashes, 32 bits each, in base 64; an empty text has a fingerprint of its own."""
    return base64.b64encode(np.sort(np.fromiter(found, "<u4", len(found))).tobytes()).decode()


def as_set(fingerprint: str) -> frozenset[int]:
    return frozenset(np.frombuffer(base64.b64decode(fingerprint), "<u4").tolist())


def likeness(a: frozenset[int], b: frozenset[int]) -> float:
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared) if shared else 0.0


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the following one's beginning, or all of it."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


# --- neighbours in the order of ids ---------------------------------------

def _cuts(docs: DataFrame, parts: int) -> list[int]:
    """The greatest id of each of `parts` ranges; ids alone are shuffled, and one number per range reaches the driver."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    ranged = ids.repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(F.max("doc_id").alias("top"))
    return sorted({r["top"] for r in ranged.collect()})


def _range_of(cuts: list[int]):
    tops = np.array(cuts or [0], np.int64)

    @pandas_udf("int")
    def find(ids: pd.Series) -> pd.Series:
        known = ids.fillna(tops[0]).to_numpy(np.int64)
        return pd.Series(np.minimum(np.searchsorted(tops, known), len(tops) - 1).astype(np.int32))

    return find


def with_following(docs: DataFrame, kernel, schema: str, arrow: pa.Schema) -> DataFrame:
    """kernel(doc_id, text, following text) of every row; the following row is the next one by descending id.

    Rows are dealt by ranges of ids, with the greatest row of a range as a guest
    in the next one, so each range finds all its neighbours: one shuffle of the
    texts, streamed row by row.  The row of the least id is followed by that of
    the greatest.  Null ids come last; rows of equal id follow by text.
    """
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = _cuts(read, max(1, -(-total // PARTITION_BYTES)))
    parts = max(1, len(cuts))
    ranged = read.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(_range_of(cuts)("doc_id")))
    least_null = not read.where(F.col("doc_id").isNull()).isEmpty()
    top = F.col("doc_id") == F.element_at(F.lit(cuts or [0]).cast("array<bigint>"), F.col("range") + 1)
    homes = F.when(top, F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("guest")),
                                F.struct(F.pmod(F.col("range") + 1, F.lit(parts)).alias("r"), F.lit(True).alias("guest"))))
    homes = homes.otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("guest"))))
    if least_null and not cuts:  # no row has an id: all follow each other in the one range
        homes = F.array(F.struct(F.lit(0).alias("r"), F.lit(False).alias("guest")))
    dealt = ranged.select("doc_id", "text", F.explode(homes).alias("home")).select("doc_id", "text", F.col("home.r").alias("r"), F.col("home.guest").alias("guest"))
    ordered = dealt.repartition(parts, "r").sortWithinPartitions("r", F.asc("guest"), F.desc_nulls_last("doc_id"), "text")
    return ordered.mapInArrow(_stream(kernel, arrow), schema)


def _stream(kernel, arrow: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, first, guested, now = None, None, False, None

        def finish(out):
            if waiting is not None:  # no guest: the only range, which is its own neighbour
                out.append(kernel(*waiting, first))

        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "text", "r", "guest")]
            for low in range(0, batch.num_rows, 200):
                out = []
                for doc_id, text, r, guest in zip(*(c.slice(low, 200).to_pylist() for c in columns)):
                    if r != now:
                        finish(out)
                        waiting, first, guested, now = None, None, False, r
                    if guest and guested:
                        continue
                    if waiting is not None:
                        out.append(kernel(*waiting, text))
                    guested = guest
                    waiting = None if guest else (doc_id, text)
                    first = text if first is None else first
                if out:
                    yield pa.RecordBatch.from_pylist(out, arrow)
        out = []
        finish(out)
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return run


def _compared(doc_id: int | None, text: str, following: str) -> dict:
    changed = edited(text, following)
    own, other, nxt = spots(text), spots(changed), spots(following)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": as_text(own), "edited_fingerprint": as_text(other), "near_edited": likeness(own, other), "near_next": likeness(own, nxt)}


COMPARED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                            ("near_edited", pa.float64()), ("near_next", pa.float64())])
COMPARED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_following(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and its likeness to that and to the next document.

    Null texts are empty; equal texts have equal fingerprints; a single row is
    followed by itself; extra columns are ignored; an empty table gives no rows.
    """
    return with_following(docs, _compared, COMPARED, COMPARED_ARROW)


# --- similarity join ------------------------------------------------------

@pandas_udf(ArrayType(LongType()))
def spot_set(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(spots(t or "")))


def similar_texts(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): doc_id with its text class, and pairs of classes (a, b, likeness) of at least the threshold.

    Copies are one class, named by the digest of their spot set.  A pair must
    share one of the rarest spots of both sets (so many that a pair without one
    stays below the threshold) and be of equal or neighbouring size class;
    shared counts then give the exact similarity.
    """
    rows = materialize(docs.select("doc_id", spot_set("text").alias("spots")).withColumn("class", F.md5(F.array_join(F.col("spots").cast("array<string>"), ","))), "spots")
    sets = rows.dropDuplicates(["class"]).select("class", "spots", F.size("spots").alias("n"))
    each = sets.select("class", "n", F.explode("spots").alias("spot"))
    counts = each.groupBy("spot").agg(F.count("*").alias("held"))
    ranked = (each.join(counts, "spot").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("held", "spot"))).alias("ranked")))
    keep = F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1
    prefix = ranked.select("class", "n", F.explode(F.slice("ranked", 1, keep.cast("int"))).alias("x"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    left = prefix.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("x.spot").alias("spot"),
                         F.explode(F.array(size_class - 1, size_class, size_class + 1)).alias("size"))
    right = prefix.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("x.spot").alias("spot"), size_class.alias("size"))
    close = (left.join(right, ["spot", "size"]).where("a < b").where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
             .select("a", "b").distinct())
    of = lambda x: sets.select(F.col("class").alias(x), F.col("spots").alias(f"of_{x}"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    near = close.join(of("a"), "a").join(of("b"), "b").select("a", "b", (shared / (F.size("of_a") + F.size("of_b") - shared)).alias("likeness"))
    return rows.select("doc_id", "class"), near.where(F.col("likeness") >= threshold)
