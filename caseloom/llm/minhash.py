"""Near-duplicate classes by dart-thrown weighted MinHash and banding.

Method.  A document is a weighted set of five-word shingles.  Every shingle
owns the region [0, weight) x [0, inf): darts fall into its unit cells as a
Poisson process whose places depend on the shingle alone, so equal regions of
two documents are hit by the same darts.  A dart names one of the signature's
coordinates, and each coordinate keeps its earliest dart.  Throwing stops at
rank t / total weight with t = k ln k + 2k darts expected, which fills all k
coordinates in one pass over the set; the few documents left with a gap are
thrown again at twice the rank.  Bands of the signature are joined, and a
candidate pair counts only after its exact Jaccard similarity is computed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import mix, pack, unpack, word_list
from caseloom.llm.components import components
from caseloom.operators.joins import join_lookup
from caseloom.session import materialize

SHINGLE_WORDS, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS = 25, 5  # a pair at 0.8 misses every band once in 20,000 times
STAR_ROUNDS = 3  # how often a bucket's texts are compared with one of them before all others are
SMALL_BUCKET = 32  # up to this size a bucket's pairs are all compared at once
BLOCK_ROWS = 256  # rows of a block of a larger bucket
SLACK = 0.17  # over four standard deviations of the share of equal coordinates
SHINGLES_AT_ONCE = 400_000  # bounds what a Python worker holds

_GOLD, _FRAC = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- signatures -----------------------------------------------------------

def shingle_sets(words: np.ndarray, starts: np.ndarray, size: int = SHINGLE_WORDS):
    """Distinct shingles of each document: (document, hash, count), sorted by document and hash.

    words: hashes of all documents' words in one array, starts: n+1 offsets.
    A document of fewer words is one shingle of all of them; one without words has none.
    """
    lengths = np.diff(starts)
    with np.errstate(over="ignore"):
        w = mix(words.astype(np.int64).view(np.uint64) + _GOLD)
        places = max(len(w) - size + 1, 0)
        rolled = np.zeros(places, np.uint64)
        for j in range(size):
            rolled = rolled * _FRAC + w[j: places + j]
        n = np.maximum(lengths - size + 1, 0)
        doc = np.repeat(np.arange(len(lengths)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[:-1], n)
        hashes = mix(rolled[place]) if len(place) else np.zeros(0, np.uint64)
        short = np.flatnonzero((lengths > 0) & (lengths < size))
        whole = []
        for d in short:
            h = np.uint64(lengths[d])
            for x in w[starts[d]: starts[d + 1]]:
                h = mix(np.array([h * _GOLD + x], np.uint64))[0]
            whole.append(h)
    doc = np.concatenate([doc, short])
    hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    if not len(doc):
        return doc, hashes, np.zeros(0)
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])
    return doc[first], hashes[first], np.diff(np.r_[first, len(doc)]).astype(float)


def dart_signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """n_docs x k earliest darts; a document without elements keeps zeros.

    doc, hashes, weights: one entry per element, sorted by document; weights may be any positive numbers.
    """
    signature = np.zeros(n_docs * k, np.uint64)
    total = np.bincount(doc, weights, n_docs)
    t = k * math.log(k) + 2 * k
    todo, factor = np.flatnonzero(total > 0), 1.0
    while len(todo):
        wanted = np.zeros(n_docs, bool)
        wanted[todo] = True
        limit = np.divide(t * factor, total, out=np.zeros(n_docs), where=total > 0)
        own = np.flatnonzero(wanted[doc])
        best = np.full(n_docs * k, np.inf)
        slots, ranks, darts = _throw(doc[own], hashes[own], weights[own], limit, k)
        np.minimum.at(best, slots, ranks)
        won = ranks == best[slots]
        signature[slots[won]] = darts[won]
        gaps = np.isinf(best.reshape(n_docs, k)).any(axis=1)
        todo, factor = todo[gaps[todo]], factor * 2
    return signature.reshape(n_docs, k)


def _throw(doc, hashes, weights, limit, k):
    """All darts of rank at most limit[doc]: (slot = doc * k + coordinate, rank, dart)."""
    cells = np.ceil(weights).astype(np.int64)
    element = np.repeat(np.arange(len(doc)), cells)
    cell = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
    slots, ranks, darts = [], [], []
    with np.errstate(over="ignore"):
        seed = mix(hashes[element] ^ mix(cell.astype(np.uint64) + _GOLD))
        rank, turn = np.zeros(len(element)), 0
        while len(element):
            turn += 1
            h = mix(seed + np.uint64(turn) * _GOLD)
            # gaps of a Poisson process: exponential, mean 1
            rank = rank - np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53)
            live = rank <= limit[doc[element]]
            element, cell, seed, rank, h = element[live], cell[live], seed[live], rank[live], h[live]
            dart = mix(h ^ _FRAC)
            height = (dart >> np.uint64(40)).astype(float) * 2.0 ** -24
            inside = cell + height < weights[element]
            slots.append(doc[element[inside]] * k + (dart[inside] % np.uint64(k)).astype(np.int64))
            ranks.append(rank[inside])
            darts.append(dart[inside])
    return np.concatenate(slots or [np.zeros(0, np.int64)]), np.concatenate(ranks or [np.zeros(0)]), np.concatenate(darts or [np.zeros(0, np.uint64)])


def _slices(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about SHINGLES_AT_ONCE words."""
    low = 0
    while low < len(starts) - 1:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + SHINGLES_AT_ONCE, "right")) - 1)
        yield low, high
        low = high


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _signer(weighted: bool, bands: int, rows: int):
    k = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, starts = _lists(batch.column("words"))
            for low, high in _slices(starts):
                own = words[starts[low]: starts[high]]
                doc, hashes, counts = shingle_sets(own, starts[low: high + 1] - starts[low])
                weights = counts if weighted else np.ones(len(counts))
                sig = dart_signatures(doc, hashes, weights, high - low, k)
                with np.errstate(over="ignore"):
                    h = np.zeros((high - low, bands), np.uint64) + np.arange(bands, dtype=np.uint64)
                    for r in range(rows):
                        h = mix(h * _GOLD + sig[:, r::rows])
                empty = np.bincount(doc, minlength=high - low) == 0
                sizes = np.where(empty, 0, bands)
                flat = pa.array(h[~empty].view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(low, high - low),
                    batch.column("node").slice(low, high - low),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), flat),
                    pa.array([x.tobytes() for x in sig.astype(np.uint16)], pa.binary()),
                ], ["doc_id", "node", "bands", "sig"])

    return sign


def signatures(docs: DataFrame, weighted: bool = False, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, node, bands, sig) per document.  node: digest of the word sequence, equal for copies."""
    words = word_list(F.col("text"))
    hashed = docs.select("doc_id", words.alias("w")).select(
        "doc_id", F.unhex(F.md5(F.array_join("w", " "))).alias("node"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("words"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(_signer(weighted, bands, rows), f"doc_id {kind}, node binary, bands array<bigint>, sig binary")


# --- candidate pairs ------------------------------------------------------

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, starts = _lists(batch.column("words"))
        for low, high in _slices(starts):
            doc, hashes, _ = shingle_sets(words[starts[low]: starts[high]], starts[low: high + 1] - starts[low])
            sizes = np.bincount(doc, minlength=high - low)
            yield pa.RecordBatch.from_arrays([
                batch.column("node").slice(low, high - low),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(hashes.view(np.int64))),
            ], ["node", "shingles"])


def _agree(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in a share of at least `least` coordinates."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
        if batch.num_rows:
            near = pa.array((a == b).mean(axis=1) >= least)
            yield batch.select(["a", "b"]).filter(near)


def _block_links(least: float, threshold: float):
    def run(batch):
        """Links of different components between two blocks of one bucket, or inside one block.

        A pair that shares an earlier band is left to that band's bucket.
        """
        node, side, root = (np.array(batch.column(c).to_pylist(), object) for c in ("node", "side", "root"))
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(len(node), -1)
        bands = np.array(batch.column("bands").to_pylist(), np.int64).reshape(len(node), -1)
        flat, starts = _lists(batch.column("shingles"))
        sets = [flat[x:y] for x, y in zip(starts, starts[1:])]
        earlier = int(np.flatnonzero(bands[0] == batch.column("band")[0].as_py())[0])
        found = []
        right = np.flatnonzero(side != 0)
        for i in np.flatnonzero(side != 1):
            others = right[root[right] != root[i]]
            others = others[(bands[others, :earlier] != bands[i, :earlier]).all(axis=1)]
            for j in others[(sig[others] == sig[i]).mean(axis=1) >= least]:
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if shared >= threshold * (len(sets[i]) + len(sets[j]) - shared):
                    found.append((min(node[i], node[j]), max(node[i], node[j])))
        found = sorted(set(found))
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([x for _, x in found], pa.binary())})

    return run


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, node, n): rows of buckets of at least two texts."""
    rows = classes.select("node", F.explode("bands").alias("band"))
    stats = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    return join_lookup(rows, stats, "band", "inner").select("band", "node", "n")


def _near(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Candidate pairs kept by their signatures."""
    sigs = classes.select("node", "sig")
    both = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))
    return both.mapInArrow(lambda it: _agree(it, least), "a binary, b binary")


def _sets_of(needed: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes needed, from whole texts."""
    ids = classes.join(needed, "node", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    words = word_list(F.col("text"))
    texts = (docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(words.alias("w"))
             .select(F.unhex(F.md5(F.array_join("w", " "))).alias("node"), F.transform("w", lambda w: F.xxhash64(w)).alias("words"))
             .join(needed, "node", "left_semi").dropDuplicates(["node"]))
    return texts.mapInArrow(_sets, "node binary, shingles array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of an exact Jaccard similarity of shingle sets of at least the threshold."""
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(shared >= threshold * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False) -> DataFrame:
    """(doc_id, class_id, copies, texts, class_key) for every row: its class, the class's rows and different texts.

    class_id is the least doc_id of the class, class_key a digest that no other class has
    (an id that repeats with unlike texts may be the least of several classes); classes are the connected
    components of pairs whose five-word shingle sets have a Jaccard similarity of
    at least the threshold.  weighted=True throws darts at shingle counts rather
    than at sets; the exact check is on sets either way.  Copies (equal word
    sequences) form one node before any pair is made.  The texts of a
    bucket are compared with one of them, a few times over; where that leaves several
    components, texts of different components are compared with each other, in blocks
    where a bucket has more than 32, so no link is lost to a limit.  Null texts count
    as empty, empty texts are copies of each other, null ids stay in their class and
    have no say in class_id unless all are null; other columns are ignored.
    """
    return _classes_of(_rooted(*_linked(docs, threshold, weighted)))


def _linked(docs: DataFrame, threshold: float, weighted: bool) -> tuple[DataFrame, DataFrame | None]:
    """Signed rows, and the root of every text that has a link."""
    docs = docs.select("doc_id", "text")
    least = threshold - SLACK
    signed = materialize(signatures(docs, weighted), "signatures")
    first = Window.partitionBy("node").orderBy(F.asc_nulls_last("doc_id"))
    classes = materialize(signed.withColumn("r", F.row_number().over(first)).where("r = 1").drop("r"), "classes")
    buckets = materialize(_buckets(classes), "buckets")
    sets = materialize(_sets_of(buckets.select("node").distinct(), docs, classes), "shingles")
    edges, roots = None, None
    for turn in range(STAR_ROUNDS + 1):
        rows = materialize(_open(buckets, roots), "open")
        if rows.isEmpty():
            break
        pairs = _stars(rows, turn) if turn < STAR_ROUNDS else _across_small(rows)
        found = _verified(materialize(_near(pairs, classes, least), "pairs"), sets, threshold)
        if turn == STAR_ROUNDS:
            found = found.union(_across_blocks(rows, classes, sets, least, threshold))
        edges = materialize(found if edges is None else edges.union(found), "edges")
        roots = components(edges)
    return signed, roots


def _open(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(band, node, root, n): rows of buckets that hold several components."""
    if roots is None:
        return buckets.withColumn("root", F.col("node"))
    named = join_lookup(buckets, roots, "node").withColumn("root", F.coalesce("root", "node"))
    open_ = named.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
    return join_lookup(named, open_, "band", "inner").select("band", "node", "root", "n")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _stars(rows: DataFrame, turn: int) -> DataFrame:
    """Each row of a bucket with one leader, another one every turn, where they are of different components."""
    leaders = rows.groupBy("band").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", "root")).alias("leader"))
    led = join_lookup(rows, leaders, "band", "inner").where(F.col("root") != F.col("leader.root"))
    return led.select(F.col("leader.node").alias("x"), F.col("node").alias("y")).select(*_pair("x", "y")).distinct()


def _across_small(rows: DataFrame) -> DataFrame:
    """All pairs of different components in buckets of at most SMALL_BUCKET rows."""
    left, right = (rows.where(F.col("n") <= SMALL_BUCKET).select("band", F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    return left.join(right, "band").where("a < b and root_a <> root_b").select("a", "b").distinct()


def _across_blocks(rows: DataFrame, classes: DataFrame, sets: DataFrame, least: float, threshold: float) -> DataFrame:
    """Links of different components in larger buckets, checked block by block; only true links leave a block."""
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    cut = rows.where(F.col("n") > SMALL_BUCKET).withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "node", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    full = cut.join(classes.select("node", "sig", "bands"), "node").join(sets, "node")
    return full.groupBy("band", "i", "j").applyInArrow(_block_links(least, threshold), "a binary, b binary")


def _rooted(signed: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(doc_id, node, root) of every row."""
    if roots is None:
        return signed.select("doc_id", "node", F.col("node").alias("root"))
    return join_lookup(signed.select("doc_id", "node"), roots, "node").withColumn("root", F.coalesce("root", "node"))


def _classes_of(rows: DataFrame) -> DataFrame:
    texts = rows.groupBy("root", "node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    classes = texts.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("copies"), F.count("*").alias("texts"))
    return join_lookup(rows, classes, "root").select("doc_id", "class_id", "copies", "texts", F.hex("root").alias("class_key"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every near-duplicate class: the least doc_id's, ids before none; all columns stay.

    A class is told by its text digests, not by ids: rows of one id whose texts are
    unlike are in different classes and stay.  Of rows that repeat both the kept id
    and its words, the least text stays; rows without id are in classes like others.
    """
    rooted = _rooted(*_linked(docs, threshold, False))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "node")).alias("least")
    won = rooted.groupBy("root").agg(least).select(F.col("least.doc_id").alias("k"), F.col("least.node").alias("won"))
    node = F.unhex(F.md5(F.array_join(word_list(F.col("doc.text")), " ")))
    kept = pack(docs).withColumn("node", node).join(won, (F.col("node") == F.col("won")) & F.col("doc.doc_id").eqNullSafe(F.col("k")), "left_semi")
    first = Window.partitionBy("node").orderBy("doc.text")
    return unpack(kept.withColumn("r", F.row_number().over(first)).where("r = 1").select("doc"))
