"""Hard negatives against all pairs, and the cover tree's invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step, positives=5, negatives_=5):
    """rows: (vec_id, list, label) -> the six columns, as tuples."""
    good = {}
    for i, x, label in rows:
        if i is None or label is None or not x or any(c is None or not np.isfinite(c) for c in x):
            continue
        v = [int(np.floor(256 * float(np.float32(c)))) for c in x]
        good[i] = min(good.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in good.items():
        if a % step:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i, other) for i, (other, w) in good.items() if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fit = sorted(x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)
            out += [(a, p, r, n, -s, -t) for r, (t, n, _) in enumerate(fit[:negatives_], 1)]
    return sorted(out)


def found(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def clustered(n, dim, rng, spread=0.2):
    centers = rng.normal(size=(8, dim))
    x = centers[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, dim))
    return (x * rng.uniform(0.5, 1.5, (n, 1))).astype(np.float32)


def test_clusters_of_unequal_lengths(spark):
    rng = np.random.default_rng(1)
    x = clustered(1_500, 12, rng)
    rows = [(i, v.tolist(), int(rng.integers(0, 6))) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(negatives.mine(df, F.col("vec_id") % 25 == 0)) == brute(rows, 25)


def test_small_blocks_chunks_and_copies(spark, monkeypatch):
    """Several trees per label, several chunks, a vector that a third of the rows share, ties everywhere."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.5, 0.25] if i % 3 == 0 else rng.integers(-2, 3, 3).astype(float).tolist(), int(rng.integers(0, 3))) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(negatives.mine(df, F.col("vec_id") % 20 == 0)) == brute(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, None, 1), (200, [nan, 1.0], 1), (300, [inf, 1.0], 1), (400, [None, 1.0], 1), (None, [1.0, 1.0], 1), (500, [1.0, 0.0], None),
            (1, [2.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.9, 0.0], 2), (3, [1.7, 0.0], 2), (4, [1.0, 2.0, 3.0], 1), (5, [0.0, 0.0], 2), (6, [], 1), (600, [0.0, 0.0], 1),
            (7, [-1.0, 0.0], 1), (700, [-2.0, 0.0], 1), (8, [-1.9, 0.1], 3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("v", "dim", "block", "chunk", "score", "rank", "low", "bad", "row")})
    got = found(negatives.mine(df, F.col("vec_id") % 100 == 0))
    assert got == brute(rows, 100) and got
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_no_other_label_and_a_lone_label(spark):
    rows = [(i, [float(i), 1.0], 1) for i in range(5)]
    assert found(negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0)) == []
    rows = [(i, [float(i), 1.0], i) for i in range(5)]
    assert found(negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0)) == []


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_a_tree_covers_its_points_and_bounds_hold(spread):
    rng = np.random.default_rng(3)
    v = np.floor(256 * clustered(900, 10, rng, spread).astype(float)).astype(np.int32)
    tree = negatives.Tree.grow(np.arange(900), np.zeros(900, np.int64), v)
    assert sorted(tree.ids) == list(range(900)) and (tree.vectors == v[tree.ids]).all()
    q = np.floor(256 * rng.normal(size=(20, 10)))
    low, high = tree.bounds(np.arange(len(tree.nodes)), q, np.sqrt((q * q).sum(axis=1)))
    product = q @ tree.whole.T

    def below(node):
        _, first, end, child, last = tree.nodes[node]
        return list(range(first, end)) + [p for c in range(child, last) for p in below(c)]

    assert len(below(0)) == 900
    for node in range(len(tree.nodes)):
        points = below(node)
        assert (product[:, points] <= high[:, node, None]).all() and (product[:, points] >= low[:, node, None]).all()


def test_nodes_outside_the_windows_are_skipped(monkeypatch):
    """On clusters most points are never verified."""
    rng = np.random.default_rng(4)
    v = np.floor(256 * clustered(4_000, 16, rng, 0.03).astype(float)).astype(np.int32)
    tree = negatives.Tree.grow(np.arange(4_000), rng.integers(0, 4, 4_000), v)
    asked = negatives.Asked(np.array([-1]), np.array([0]), v[:1], np.array([[-negatives.NEVER]]), np.array([[negatives.NEVER]]))
    seen = []
    matrix = type("Counted", (np.ndarray,), {"__getitem__": lambda self, k: (isinstance(k, slice) and seen.append(k.stop - k.start)) or np.asarray(self)[k]})
    tree.whole = tree.whole.view(matrix)
    _, _, ids, scores = tree.search(asked, 5, same_label=False)
    all_scores = v.astype(np.int64) @ v[0].astype(np.int64)
    order = sorted((-s, i) for i, s in enumerate(all_scores) if tree.labels[np.flatnonzero(tree.ids == i)[0]] != 0)[:5]
    assert [(-s, i) for s, i in order] == list(zip(scores.tolist(), ids.tolist()))
    assert sum(seen) < 1_000


def test_scores_beyond_doubles_are_exact():
    big = (1 << 25) + np.arange(6, dtype=np.int64)
    v = np.stack([big, big + 1, big + 2], axis=1).astype(np.int32)
    tree = negatives.Tree.grow(np.arange(6), np.ones(6, np.int64), np.tile(v, (1, 20)))
    asked = negatives.Asked(np.array([-1]), np.array([0]), np.tile(v[:1], (1, 20)), np.array([[-negatives.NEVER]]), np.array([[negatives.NEVER]]))
    _, _, ids, scores = tree.search(asked, 6, same_label=False)
    want = np.tile(v, (1, 20)).astype(object) @ np.tile(v[0], 20).astype(object)
    assert ids.tolist() == [5, 4, 3, 2, 1, 0] and scores.tolist() == sorted(want, reverse=True)
