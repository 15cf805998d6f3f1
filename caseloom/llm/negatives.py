"""Hard negatives by cover trees over norm-augmented candidates.

Method.  A coordinate sqrt(M^2 - |x|^2), M the greatest length, puts all candidates
of a block on one sphere, where a larger inner product is a smaller angle.  A
cover tree is grown over them: a node covers its points by a radius, and its
children are points farther apart than the next smaller radius, each with the
points it covers.  The angle between a query and a node's centre, less and plus
the angle of the radius, bounds every inner product below the node.  The descent
takes the node of the greatest bound first, skips nodes whose bounds lie outside a
query's windows or below its k-th best, and computes leaves exactly, in integers.

Scale.  Candidates are ordered by label and cut into blocks of BLOCK_ROWS, one tree
each.  Queries come in chunks of CHUNK_ROWS; a chunk is sent to the trees it needs
and streams past them, so a task holds one tree and one chunk at a time.  Queries
are a stated set against all rows, in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import materialize

POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100  # a negative scores LOW to HIGH percent of its positive
SCALE = 256
BLOCK_ROWS, CHUNK_ROWS = 4_096, 256
PIVOTS = 64
SALTS = 32  # parts of the list of trees a chunk is sent to
SHRINK = 0.6  # a level's covering radius, of the level's above
FEW = 8  # a child of so few points is verified with its parent
WIDEST = 1 << 26  # of a component: products of larger ones would not fit 64 bits
NEVER = 1 << 62
NOTHING = 1 - (1 << 63)


# --- trees ------------------------------------------------------------------

class Tree:
    """A cover tree: points in tree order, and per node its centre, radius, own points and children."""

    def __init__(self, ids, labels, vectors, nodes, radii, sphere):
        self.ids, self.labels, self.vectors, self.nodes, self.radii, self.sphere = ids, labels, vectors, nodes, radii, sphere
        self.whole = vectors.astype(np.float64)
        self.widest = float(np.abs(self.whole).max(initial=0.0))

    @classmethod
    def grow(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
        x = vectors.astype(np.float64)
        norms = (x * x).sum(axis=1)
        sphere = float(np.sqrt(norms.max()))
        x = np.hstack([x, np.sqrt(np.maximum(norms.max() - norms, 0.0))[:, None]])
        squares = (x * x).sum(axis=1)

        def apart(centers: np.ndarray, points: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(squares[centers][:, None] + squares[points] - 2.0 * (x[centers] @ x[points].T), 0.0))

        order, nodes, radii = [], [], []  # node: centre, first own point, end of own points, first child, end of children
        middle = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
        level = [(middle, np.arange(len(x)))]
        placed = children = 0
        while level:
            below = []
            children += len(level)
            for center, points in level:
                distance = apart(np.array([center]), points)[0]
                # rounding of the distance is far below a thousandth of a unit
                radius = float(distance.max()) + 1e-3
                own, kids = [], []
                if len(points) <= 4 * FEW or distance.max() == 0:
                    own.append(points)
                else:
                    cover = SHRINK * float(distance.max())
                    left = np.r_[center, points[points != center]]
                    while len(left):  # the first points not covered yet become centres, PIVOTS at a time
                        near = apart(left[:PIVOTS], left) <= cover
                        open_ = np.ones(len(left), bool)
                        for i in range(len(near)):
                            if open_[i]:
                                near[i, i] = True
                                covered = near[i] & open_
                                group = left[covered]
                                (own if len(group) <= FEW else kids).append(group)
                                open_ &= ~covered
                        left = left[open_]
                own = np.concatenate(own) if own else np.zeros(0, np.int64)
                order.append(own)
                nodes.append((center, placed, placed + len(own), children + len(below), children + len(below) + len(kids)))
                radii.append(radius)
                placed += len(own)
                below += [(int(g[0]), g) for g in kids]
            level = below
        order = np.concatenate(order)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes = np.array(nodes, np.int64)
        nodes[:, 0] = place[nodes[:, 0]]
        return cls(ids[order], labels[order], vectors[order], nodes, np.array(radii), sphere)

    def bounds(self, nodes: np.ndarray, queries: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner products possible below the nodes: queries x nodes."""
        reach = lengths[:, None] * self.sphere
        with np.errstate(invalid="ignore", divide="ignore"):
            angle = np.arccos(np.clip(np.nan_to_num(queries @ self.whole[self.nodes[nodes, 0]].T / reach), -1.0, 1.0))
            wide = 2.0 * np.arcsin(np.clip(np.nan_to_num(self.radii[nodes] / (2.0 * self.sphere), nan=1.0, posinf=1.0), 0.0, 1.0))
        slack = 1e-7 * reach + 1e-3  # the arc cosine rounds
        low = reach * np.cos(np.minimum(angle + wide, np.pi)) - slack
        return low, reach * np.cos(np.maximum(angle - wide, 0.0)) + slack

    def search(self, asked: Asked, k: int, same_label: bool) -> tuple[np.ndarray, ...]:
        """(query's place, window, id, score) of the k best of every window, best first, ties to smaller ids."""
        n, windows = asked.low.shape
        best = np.full((n, windows, k), NOTHING)
        best_id = np.full((n, windows, k), np.iinfo(np.int64).max)
        exact = asked.widest * self.widest * max(self.whole.shape[1], 1) < 2 ** 53
        low, high = asked.low.astype(np.float64), asked.high.astype(np.float64)

        def wanted(at: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
            fits = (most[:, None] >= low[at]) & (least[:, None] <= high[at]) & (np.minimum(most[:, None], high[at]) >= best[at, :, -1])
            return fits.any(axis=1)

        def verify(at: np.ndarray, first: int, end: int) -> None:
            if exact:
                score = (asked.whole[at] @ self.whole[first:end].T).astype(np.int64)
            else:
                score = asked.vectors[at].astype(np.int64) @ self.vectors[first:end].astype(np.int64).T
            equal = asked.labels[at][:, None] == self.labels[first:end][None, :]
            open_ = (equal if same_label else ~equal) & (asked.ids[at][:, None] != self.ids[first:end][None, :])
            for w in range(windows):
                take = open_ & (score >= asked.low[at, w][:, None]) & (score <= asked.high[at, w][:, None]) & (score >= best[at, w, -1][:, None])
                rows = np.flatnonzero(take.any(axis=1))
                if not len(rows):
                    continue
                kept = np.where(take[rows], score[rows], NOTHING)
                if kept.shape[1] > k:
                    take = take[rows] & (kept >= np.partition(kept, -k, axis=1)[:, -k][:, None])
                else:
                    take = take[rows]
                r, c = np.nonzero(take)
                at_rows = at[rows]
                who = np.r_[r, np.repeat(np.arange(len(rows)), k)]
                scores = np.r_[kept[r, c], best[at_rows, w].ravel()]
                ids = np.r_[self.ids[first:end][c], best_id[at_rows, w].ravel()]
                rank = np.lexsort((ids, -scores, who))
                who, scores, ids = who[rank], scores[rank], ids[rank]
                top = np.arange(len(who)) - np.searchsorted(who, who, "left") < k
                best[at_rows, w] = scores[top].reshape(-1, k)
                best_id[at_rows, w] = ids[top].reshape(-1, k)

        everyone = np.arange(n)
        least, most = self.bounds(np.array([0]), asked.whole, asked.lengths)
        frontier = [(-float(most.max(initial=-np.inf)), 0, everyone, least[:, 0], most[:, 0])]
        while frontier:
            _, node, at, least, most = heapq.heappop(frontier)
            at = at[wanted(at, least, most)]
            if not len(at):
                continue
            _, first, end, child, last = self.nodes[node]
            if end > first:
                verify(at, first, end)
            if last > child:
                below = np.arange(child, last)
                least, most = self.bounds(below, asked.whole[at], asked.lengths[at])
                for i, one in enumerate(below):
                    go = wanted(at, least[:, i], most[:, i])
                    if go.any():
                        heapq.heappush(frontier, (-float(most[go, i].max()), int(one), at[go], least[go, i], most[go, i]))
        query, window, place = np.nonzero(best > NOTHING)
        return query, window, best_id[query, window, place], best[query, window, place]


class Asked:
    """A chunk of queries: ids, labels, vectors, and windows of wanted scores."""

    def __init__(self, ids, labels, vectors, low, high):
        self.ids, self.labels, self.vectors, self.low, self.high = ids, labels, vectors, low, high
        self.whole = vectors.astype(np.float64)
        self.lengths = np.sqrt((self.whole * self.whole).sum(axis=1))
        self.widest = float(np.abs(self.whole).max(initial=0.0))


# --- blocks and chunks --------------------------------------------------------

_POINTS = "ids binary, labels binary, vectors binary"
_TREE = f"block bigint, dim int, own array<bigint>, {_POINTS}, nodes binary, radii binary, sphere double"
_CHUNK = f"chunk bigint, dim int, label bigint, single boolean, {_POINTS}, low binary, high binary"


def _runs(batches: Iterator[pa.RecordBatch], size: int, keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, in tables of at most `size`."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        n = table.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = True
        for key in keys:
            column = table.column(key).combine_chunks()
            new[1:] |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False), bool)
        since = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        starts = np.flatnonzero(new | (since % size == 0))
        for a, b in zip(starts, starts[1:]):
            yield table.slice(a, b - a)
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def _points(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    ids, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
    return ids, labels, vectors.reshape(len(ids), -1)


_TREE_SCHEMA = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("own", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("ids", "labels", "vectors", "nodes", "radii")],
                          ("sphere", pa.float64())])
_CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("dim", pa.int32()), ("label", pa.int64()), ("single", pa.bool_()),
                           *[(c, pa.binary()) for c in ("ids", "labels", "vectors", "low", "high")]])
_FOUND_SCHEMA = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _grower(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for table in _runs(batches, size, ["dim"]):
            tree = Tree.grow(*_points(table))
            yield pa.RecordBatch.from_pylist([{
                "block": block, "dim": tree.vectors.shape[1], "own": np.unique(tree.labels).tolist(), "ids": tree.ids.tobytes(), "labels": tree.labels.tobytes(),
                "vectors": tree.vectors.tobytes(), "nodes": tree.nodes.tobytes(), "radii": tree.radii.tobytes(), "sphere": tree.sphere}], schema=_TREE_SCHEMA)
            block += 1

    return run


def _chunker(size: int, keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for table in _runs(batches, size, keys):
            ids, labels, vectors = _points(table)
            low, high = (np.array(table.column(c).to_pylist(), np.int64).reshape(len(ids), -1) for c in ("low", "high"))
            yield pa.RecordBatch.from_pylist([{
                "chunk": chunk, "dim": vectors.shape[1], "label": int(labels[0]), "single": bool((labels == labels[0]).all()), "ids": ids.tobytes(),
                "labels": labels.tobytes(), "vectors": vectors.tobytes(), "low": low.tobytes(), "high": high.tobytes()}], schema=_CHUNK_SCHEMA)
            chunk += 1

    return run


def _searcher(k: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A tree's row comes before those of the chunks that search it."""
        tree = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(ids), -1)
                if row["chunk"] is None:
                    tree = Tree(ids, labels, vectors, np.frombuffer(row["nodes"], np.int64).reshape(-1, 5), np.frombuffer(row["radii"], np.float64), row["sphere"])
                    continue
                low, high = (np.frombuffer(row[c], np.int64).reshape(len(ids), -1) for c in ("low", "high"))
                query, window, found, score = tree.search(Asked(ids, labels, vectors, low, high), k, same_label)
                yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(window.astype(np.int32)), pa.array(found), pa.array(score)], schema=_FOUND_SCHEMA)

    return run


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows by dimension and label, a label's rows in an order of their ids that has nothing to do with their vectors."""
    keyed = rows.withColumn("_h", F.xxhash64("vec_id"))
    return keyed.repartitionByRange("dim", "label", "_h", "vec_id").sortWithinPartitions("dim", "label", "_h", "vec_id").drop("_h")


def plant(points: DataFrame) -> DataFrame:
    """Trees over points (vec_id, label, v, dim), one row each."""
    return materialize(_ordered(points.select("vec_id", "label", "v", "dim")).mapInArrow(_grower(BLOCK_ROWS), _TREE), "trees")


def search(trees: DataFrame, asks: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor_id, window, vec_id, score, rank): the k best points of every window of every query.

    asks: vec_id, label, v, dim, low and high: arrays of equal length, the windows' least and greatest scores.
    Points of the query's label are searched, or of all other labels.
    """
    keys = ["dim", "label"] if same_label else ["dim"]
    chunks = materialize(_ordered(asks).mapInArrow(_chunker(CHUNK_ROWS, keys), _CHUNK), "chunks")
    known = trees.select("dim", "block", "own", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt"))
    if same_label:
        known = known.select("dim", F.explode("own").alias("label"), "block", "salt")
    # a number and its labels per block of BLOCK_ROWS points, in parts, so that no key is hot
    to = known.groupBy(*keys, "salt").agg(F.collect_list("block" if same_label else F.struct("block", "own")).alias("blocks"))
    parts = chunks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sent = parts.join(materialize(to, "blocks"), [*keys, "salt"]).withColumn("to", F.explode("blocks"))
    if not same_label:
        alone = F.col("single") & (F.size("to.own") == 1) & (F.col("to.own")[0] == F.col("label"))
        sent = sent.where(~alone).withColumn("to", F.col("to.block"))
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    points = ("ids", "labels", "vectors")
    rows = trees.select("block", *none("bigint", "chunk"), *points, "nodes", "radii", "sphere", *none("binary", "low", "high")).unionByName(
        sent.select(F.col("to").alias("block"), "chunk", *points, *none("binary", "nodes", "radii"), *none("double", "sphere"), "low", "high"))
    met = rows.repartition("block").sortWithinPartitions("block", F.asc_nulls_first("chunk"))
    found = met.mapInArrow(_searcher(k, same_label), "anchor_id bigint, window int, vec_id bigint, score bigint")
    best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


# --- mining -------------------------------------------------------------------

def whole_points(embeddings: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, v, dim): usable rows with components floor(256 x), one row per id."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= WIDEST))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), x.alias("x"), bad.alias("bad"))
    rows = rows.where("vec_id is not null and label is not null and x is not null and not bad and size(x) > 0")
    v = F.transform("x", lambda c: F.floor(c * SCALE).cast("int"))
    rows = rows.select("vec_id", F.struct("label", v.alias("v")).alias("row"))
    once = rows.groupBy("vec_id").agg(F.min("row").alias("row"))
    return once.select("vec_id", "row.label", "row.v", F.size("row.v").alias("dim"))


def _share(score: Column, percent: int, up: bool) -> Column:
    """A percentage of a score, rounded up or down, in integers."""
    x = score * F.lit(percent).cast("bigint")
    whole = F.call_function("div", x, F.lit(100).cast("bigint"))
    rest = x - whole * 100
    return whole + F.when(rest > 0, 1 if up else 0).when(rest < 0, 0 if up else -1).otherwise(0)


def mine(embeddings: DataFrame, anchors: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), as integers.

    anchors: a condition on vec_id.  Scores are inner products of components floor(256 x).
    An anchor's positives are its best other rows of the same label; a positive's negatives
    the best rows of other labels that score from low to high percent of it; ties go to the
    smaller id.  Rows take no part where id, label or vector is null, a vector is empty or a
    component is null, not finite, or so large that products would not fit 64 bits.  Rows
    that repeat an id count once, by their least label and vector; vectors of different
    lengths are not compared; other columns are ignored; an empty table gives no rows.
    """
    points = materialize(whole_points(embeddings, F.col("label") if label is None else label), "points")
    # of equal vectors of a label only the first ids can be among the best, one more for the anchor itself
    copies = Window.partitionBy("label", "v").orderBy("vec_id")
    few = points.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy")
    trees = plant(few)
    asked = points.where(anchors)
    everything = [F.array(F.lit(x).cast("bigint")).alias(c) for c, x in (("low", -NEVER), ("high", NEVER))]
    near = materialize(search(trees, asked.select("*", *everything), positives, same_label=True), "positives")
    # windows of an anchor: one per positive, empty ones to make up their number
    best = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("best"))
    score = lambda i: F.get("best", F.lit(i))["score"]
    least, most = [_share(score(i), low, up=True) for i in range(positives)], [_share(score(i), high, up=False) for i in range(positives)]
    some = [F.coalesce(a <= b, F.lit(False)) for a, b in zip(least, most)]
    asks = asked.join(best, "vec_id").withColumns({
        "low": F.array(*[F.when(s, a).otherwise(NEVER) for s, a in zip(some, least)]),
        "high": F.array(*[F.when(s, b).otherwise(-NEVER) for s, b in zip(some, most)])}).drop("best")
    hard = search(trees, asks, negatives, same_label=False)
    pairs = near.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(pairs, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
