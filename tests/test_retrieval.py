import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import retrieval as r
from caseloom.operators.latent import embed_text

SCHEMA = "id long, embedding array<float>"


def vectors(spark, matrix, first=0, partitions=4):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def brute(q, c, k, first=0):
    q, c = (np.asarray(m, dtype="float32").astype("float64") for m in (q, c))
    out = set()
    for i, x in enumerate(q):
        d = ((c - x) ** 2).sum(1)
        for rank, j in enumerate(sorted(range(len(c)), key=lambda j: (d[j], j))[:k], 1):
            out.add((i, first + j, rank))
    return out


def found(df):
    return {(x.query_id, x.corpus_id, x.rank) for x in df.collect()}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 12)) * 4
    corpus = np.concatenate([c + rng.normal(size=(90, 12)) * 0.3 for c in centers])
    queries = np.concatenate([c + rng.normal(size=(4, 12)) * 0.3 for c in centers])
    return queries, corpus


@pytest.mark.parametrize("options", [{}, {"max_broadcast_floats": 0}, {"n_cells": 1}, {"n_cells": 6}, {"n_cells": 40}])
def test_exact_equals_brute_force(spark, clustered, options):
    q, c = clustered
    assert found(r.knn_exact(vectors(spark, q), vectors(spark, c), 5, **options)) == brute(q, c, 5)


def test_exact_on_small_blocks_and_chunks(spark, clustered, monkeypatch):
    q, c = clustered
    monkeypatch.setattr(r, "BLOCK_ROWS", 50)
    monkeypatch.setattr(r, "CHUNK_ROWS", 7)
    got = r.knn_exact(vectors(spark, q), vectors(spark, c), 3, n_cells=4)
    assert found(got) == brute(q, c, 3)


@pytest.mark.parametrize("options", [{}, {"n_cells": 4}])
def test_a_third_of_the_corpus_are_copies(spark, clustered, options):
    q, c = clustered
    c = np.concatenate([np.repeat(q[:1], 200, axis=0), c])
    assert found(r.knn_exact(vectors(spark, q), vectors(spark, c), 3, **options)) == brute(q, c, 3)


@pytest.mark.parametrize("options", [{}, {"n_cells": 2}])
def test_fewer_rows_than_asked_for(spark, options):
    q, c = np.eye(3), np.eye(3)[:2]
    assert found(r.knn_exact(vectors(spark, q), vectors(spark, c), 5, **options)) == brute(q, c, 5)


def test_rows_without_vector_take_no_part(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], SCHEMA)
    assert found(r.knn_exact(c, c, 3)) == {(1, 1, 1)}
    assert r.knn_exact(c.limit(0), c, 3).count() == 0 == r.knn_exact(c, c.limit(0), 3).count()


def test_approximate_recall(spark, clustered):
    q, c = clustered
    exact = brute(q, c, 5)
    got = found(r.knn_approx(vectors(spark, q), vectors(spark, c), 5, n_cells=12, probes=3))
    assert len({x[:2] for x in got} & {x[:2] for x in exact}) / len(exact) >= 0.95
    assert found(r.knn_approx(vectors(spark, q), vectors(spark, c), 5, n_cells=12, probes=12)) == exact


def test_recall_on_given_vectors(spark):
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    exact = found(r.knn_exact(v, v, 3, "vec_id", "vec_id"))
    near = found(r.knn_approx(v, v, 3, "vec_id", "vec_id", n_cells=8, probes=4))
    hits = {x[:2] for x in near} & {x[:2] for x in exact}
    assert len(hits) / len(exact) >= 0.8
    # the neighbours of vector 0 among ids from 5 on
    rest = v.where("vec_id >= 5")
    first = r.knn_exact(v.where("vec_id = 0"), rest, 3, "vec_id", "vec_id").orderBy("rank").collect()
    assert [x.corpus_id for x in first] == [365, 334, 387]
    assert [round(x.distance, 6) for x in first] == [1.260013, 1.274556, 1.337723]


def test_no_cross_join_in_the_plans(spark, clustered):
    q, c = clustered
    for options in ({}, {"n_cells": 4}):
        plan = r.knn_exact(vectors(spark, q), vectors(spark, c), 3, **options)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "WindowGroupLimit" in plan


def pair_table(spark, matrix):
    return vectors(spark, matrix).withColumnRenamed("id", "customer_tweet_id").withColumns({
        "customer_text": F.concat(F.lit("post "), "customer_tweet_id"),
        "apple_reply_text": F.concat(F.lit("reply "), "customer_tweet_id"),
        "is_dm_redirect": F.col("customer_tweet_id") % 2 == 0})


def test_precedents_come_nearest_first_and_may_be_none(spark, clustered):
    q, c = clustered
    queries = pair_table(spark, q).unionByName(pair_table(spark, q[:1]).withColumns(
        {"customer_tweet_id": F.lit(77).cast("long"), "embedding": F.lit(None).cast("array<float>")}))
    rows = {x.customer_tweet_id: x for x in r.retrieve_precedent(queries, pair_table(spark, c), 3).collect()}
    assert rows[77].precedents == [] and len(rows) == len(q) + 1
    expected = sorted((rank, j) for i, j, rank in brute(q, c, 3) if i == 4)
    assert [(p.rank, p.id) for p in rows[4].precedents] == expected
    assert rows[4].precedents[0].apple_reply_text == f"reply {expected[0][1]}"
    probe = r.retrieval_probe(queries, pair_table(spark, c), 2)
    assert probe.columns == ["query_id", "rank", "distance", "is_dm_redirect", "matched_text", "reply_text"]
    assert probe.count() == 2 * len(q)


def test_embedding(spark):
    texts = ["the battery is dead", "The Battery is dead!", "billing and refund", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {x.id: np.array(x.embedding) for x in embed_text(df, "text", 64).collect()}
    assert all(v.shape == (64,) for v in got.values())
    assert np.allclose(got[0], got[1]) and np.isclose(np.linalg.norm(got[2]), 1)
    assert not got[3].any() and not got[4].any()
    assert got[0] @ got[2] < 0.5


def test_repeated_ids_count_once(spark):
    from caseloom.operators.retrieval import knn_exact
    q = spark.createDataFrame([(1, [0.0, 0.0]), (1, [0.0, 0.0])], "id long, embedding array<float>")
    c = spark.createDataFrame([(i % 5, [float(i % 5), 0.0]) for i in range(20)], "id long, embedding array<float>")
    for options in ({}, {"n_cells": 2}):
        got = knn_exact(q, c, 3, **options).orderBy("rank").collect()
        assert [(r.query_id, r["rank"], r.corpus_id) for r in got] == [(1, 1, 0), (1, 2, 1), (1, 3, 2)]


def test_vectors_of_mixed_length_are_refused(spark):
    from caseloom.operators.retrieval import knn_exact
    q = spark.createDataFrame([(1, [0.0, 0.0])], "id long, embedding array<float>")
    c = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "id long, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        knn_exact(q, c, 1).collect()


def test_only_visited_blocks_are_copied(spark):
    from caseloom.operators import retrieval as r
    c = spark.range(200).selectExpr("id", "array(cast(id % 20 as float), cast(id as float)) as embedding")
    seen = []
    whole = r.join_lookup
    r.join_lookup = lambda rows, lookup, *a, **k: seen.append(whole(rows, lookup, *a, **k)) or seen[-1]
    size, r.CHUNK_ROWS = r.CHUNK_ROWS, 10
    try:
        r.knn_approx(c, c, 3, n_cells=8, probes=1).collect()
        left = seen[0].selectExpr("sum(chunks)").first()[0]
    finally:
        r.join_lookup, r.CHUNK_ROWS = whole, size
    assert left < 200 * 8


@pytest.fixture
def written(monkeypatch):
    """Rows of all tables that a search writes."""
    rows, whole = [], r.materialize

    def counted(df, name):
        out = whole(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(r, "materialize", counted)
    return rows


@pytest.mark.parametrize("search", [
    lambda v: r.knn_approx(v, v, 3, n_cells=40, probes=30),
    lambda v: r.knn_exact(v, v, 3, n_cells=40),
    lambda v: r.knn_join(v, v, 3, n_cells=40)])
def test_no_query_is_written_once_per_cell(spark, written, search):
    """Vectors without clusters: a query looks into most cells, but its vector is written once."""
    v = vectors(spark, np.random.default_rng(11).normal(size=(600, 16)))
    assert len(found(search(v))) == 3 * 600
    assert max(written) <= 600


def test_cells_share_blocks_and_large_ones_are_cut():
    layout = r._layout(np.array([3, 4, 0, 25, 2, 9]), 10)
    assert layout.first.tolist() == [0, 0, 0, 1, 4, 5] and layout.parts.tolist() == [1, 1, 1, 3, 1, 1]
    assert list(zip(layout.low.tolist(), layout.high.tolist())) == [(0, 3), (3, 4), (3, 4), (3, 4), (4, 5), (5, 6)]


@pytest.mark.parametrize("shift", [0.0, 1e4, 1e20])
def test_vectors_too_close_for_single_precision(spark, shift):
    rng = np.random.default_rng(12)
    c = (rng.normal(size=(300, 4)) * (1e-3 if shift < 1e9 else 1e18) + shift).astype("float32")
    assert found(r.knn_exact(vectors(spark, c[:40]), vectors(spark, c), 4, n_cells=3)) == brute(c[:40], c, 4)


# --- the kernel of the searches

@pytest.mark.parametrize("k", [1, 3, 64])
def test_search_by_tiles_equals_brute_force(k):
    from caseloom.operators import retrieval as r
    rng = np.random.default_rng(k)
    search = r._kernels(k)[2]
    for n in (1, 5, 63, 64, 65, 1023, 1024, 1025, 5000):
        c, q = (rng.integers(-2, 3, (m, 4)).astype("float32") for m in (n, 300))  # many ties
        if n == 1025:
            c[7, 1], c[8, 2] = np.nan, np.inf
        ids, columns = rng.permutation(n), np.flatnonzero(rng.random(n) < 0.7)
        for some in (None, columns):
            at = np.arange(n) if some is None else some
            q_ids, found, distance = search(ids, c)(np.arange(300), q, some)
            for i in (0, 255, 256, 299):
                d = ((q[i].astype(float) - c[at]) ** 2).sum(1)
                best = [j for j in np.lexsort((ids[at], d)) if np.isfinite(d[j])][:k]
                assert found[q_ids == i].tolist() == ids[at][best].tolist() and distance[q_ids == i].tolist() == d[best].tolist()


def test_search_holds_one_tile_of_distances(monkeypatch):
    """A slice's distances to a whole block are not in memory at once."""
    import tracemalloc

    from caseloom.operators import retrieval as r
    c = np.random.default_rng(2).normal(size=(60_000, 4)).astype("float32")
    nearest = r._kernels(3)[2](np.arange(len(c)), c)
    nearest(np.arange(2), c[:2])
    tracemalloc.start()
    got = nearest(np.arange(256), c[:256])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6 and got[1][::3].tolist() == list(range(256))


def test_rows_are_compared_only_where_many_may_be_equal(monkeypatch):
    from caseloom.operators import retrieval as r
    c, ids = np.random.default_rng(3).normal(size=(500, 4)), np.arange(500)[::-1].copy()
    c[100:140] = c[0]
    c[200:202] = c[1]
    compared, whole = [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, *a, axis=None, **b: (compared.append(len(x)) if axis == 0 else None) or whole(x, *a, axis=axis, **b))
    at = r._kernels(3)[1](ids, c)
    assert compared == [41] and len(at) == 500 - 38 and (np.diff(ids[at]) > 0).all()
    assert sorted(ids[at][(c[at] == c[0]).all(1)]) == sorted(ids[100:140])[:3]
