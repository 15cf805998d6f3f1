"""Trained cells, codes, the latent text model, and the stored index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import cells as trained
from caseloom.operators import latent
from caseloom.operators import retrieval as r
from caseloom.session import scratch_path
from caseloom.sources import retrieval_store as store

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")


@pytest.fixture(scope="module")
def pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.select(F.col("doc_id").alias("customer_tweet_id"), F.col("text").alias("customer_text"), F.col("text").alias("apple_reply_text"),
                       F.lit(None).cast("boolean").alias("is_dm_redirect"), F.lit(1).cast("bigint").alias("thread_depth"))


@pytest.fixture(scope="module")
def built(spark, pairs):
    path = scratch_path(spark, "index")
    model = latent.fit_latent(pairs, "customer_text", 24, features=512)
    store.build_retrieval_table(pairs.where("customer_tweet_id % 3 <> 0"), model, path)
    return path


# --- cells

def test_recall_and_pairs_on_the_given_vectors(given):
    """Nine in ten of the exact neighbours, though true distances are computed for an eighth of all pairs."""
    v = given.select("id", F.col("embedding").alias("v"))
    placed, cells = r.trained_cells(v)
    cells = r.measured_probes(placed, cells, v, 3)
    found = {(x.query_id, x.corpus_id) for x in r.top_k_neighbours(r.search_codes(v, placed, cells, 3, cells.probes), 3).collect()}
    exact = {(x.query_id, x.corpus_id) for x in r.knn_exact(given, given, 3).collect()}
    assert len(found & exact) / len(exact) >= 0.9
    n = int(cells.rows.sum())
    x = np.array([row["v"] for row in v.collect()], float)
    order, far = cells.ranked(x, cells.probes)
    by_code = np.where(np.isfinite(far), cells.rows[order], 0).sum() / n ** 2
    assert r.RERANKED / n < 0.13 and by_code < 0.55, by_code


def test_clustered_vectors_need_few_cells(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(40, 16)) * 3
    x = (centers[rng.integers(0, 40, 3_000)] + rng.normal(size=(3_000, 16)) * 0.3).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    placed, cells = r.trained_cells(df)
    cells = r.measured_probes(placed, cells, df, 5)
    order, far = cells.ranked(x.astype(float), cells.probes)
    assert np.where(np.isfinite(far), cells.rows[order], 0).sum() / 3_000 ** 2 < 0.15


def test_codes_stand_near_their_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 10))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    cells = trained.fit_cells(df, 9, 600, 1)
    assert cells.codebooks.shape == (3, trained.CODEWORDS, trained.SLICE)  # the last slice is padded
    cell = cells.nearest(x)
    back = cells.decode(cells.encode(x, cell), cell)
    assert back.shape == x.shape and ((back - x) ** 2).sum() < 0.1 * ((x - cells.centers[cell]) ** 2).sum()


def test_far_points_find_small_clusters(spark):
    x = np.concatenate([np.zeros((500, 3)), np.full((5, 3), 50.0), np.array([[0.0, 90.0, 0.0]] * 3)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    centers = trained.parallel_kmeans(df, 3, 1)
    assert sorted(map(tuple, centers.round(6))) == [(0.0, 0.0, 0.0), (0.0, 90.0, 0.0), (50.0, 50.0, 50.0)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(30)]])
def test_few_or_equal_vectors(spark, rows):
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    got = r.knn_approx(df, df, 2).collect()
    want = r.knn_exact(df, df, 2).collect()
    assert sorted(got) == sorted(want)


# --- join

@pytest.mark.parametrize("n_cells", [None, 1, 9])
def test_knn_join_equals_brute_force(spark, n_cells, monkeypatch):
    monkeypatch.setattr(r, "BLOCK_ROWS", 60)
    monkeypatch.setattr(r, "CHUNK_ROWS", 25)
    rng = np.random.default_rng(21)
    centers = rng.normal(size=(10, 6)) * 6
    sides = [(centers[rng.integers(0, 10, n)] + rng.normal(size=(n, 6)) * 0.4).astype("float32") for n in (150, 700)]
    sides[1][:120] = sides[0][0]  # copies of one vector
    left, right = (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<float>") for x in sides)
    got = {(x.query_id, x["rank"], x.corpus_id) for x in r.knn_join(left, right, 4, n_cells=n_cells).collect()}
    want = set()
    for i, v in enumerate(sides[0].astype(float)):
        d = ((sides[1].astype(float) - v) ** 2).sum(1)
        want |= {(i, rank, int(j)) for rank, j in enumerate(np.lexsort((np.arange(len(d)), d))[:4], 1)}
    assert got == want
    if n_cells is None:
        counts = r.join_pairs(left, right, 4).first()
        assert counts["all_pairs"] == 150 * 700 and counts["met"] < 0.4 * counts["all_pairs"]


def test_knn_join_of_nothing(spark):
    some = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (None, [1.0, 1.0])], "id long, embedding array<float>")
    assert r.knn_join(some, some.limit(0), 2).collect() == [] == r.knn_join(some.limit(0), some, 2).collect()
    assert [(x.query_id, x.corpus_id) for x in r.knn_join(some, some, 2).collect()] == [(1, 1)]


# --- text model

def test_latent_projection_equals_a_full_decomposition(spark):
    rng = np.random.default_rng(10)
    topics = [[f"t{t}w{i}" for i in range(12)] for t in range(4)]
    texts = [" ".join(rng.choice(topics[i % 4], 15)) for i in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    weights = latent.fit_weights(df, "text", 256)
    a = np.array([row["embedding"] for row in weights.embed(df, "text").orderBy("id").collect()])
    model = latent.fit_latent(df, "text", 4, features=256, passes=4)
    values = np.linalg.svd(a)[1][:4]
    kept = np.linalg.norm(a @ model.projection, axis=0)
    assert np.allclose(kept, values, rtol=0.02) and np.allclose(model.projection.T @ model.projection, np.eye(4), atol=1e-8)
    got = {row["id"]: np.array(row["embedding"]) for row in model.embed(df, "text").collect()}
    assert got[0] @ got[4] > 0.9 and abs(got[0] @ got[1]) < 0.3  # a topic's texts are alike
    assert not got[200].any() and not got[201].any()


def test_a_loaded_model_gives_equal_vectors(spark, pairs):
    path = scratch_path(spark, "model")
    for model in (latent.fit_latent(pairs, "customer_text", 8, features=128), latent.fit_weights(pairs, "customer_text", 64)):
        model.save(spark, f"{path}-{model.dim}")
        again = latent.TextModel.load(spark, f"{path}-{model.dim}")
        assert again.dim == model.dim
        few = pairs.limit(50)
        assert sorted(map(str, model.embed(few, "customer_text").collect())) == sorted(map(str, again.embed(few, "customer_text").collect()))


# --- index

def test_an_index_is_loaded_as_it_was_built(spark, built, pairs):
    index = store.open_index(spark, built)
    assert index.rows().count() == pairs.where("customer_tweet_id % 3 <> 0").count() == index.cells.rows.sum()
    assert index.cells.probes > 0 and index.model.dim == 24
    extent = index.rows().groupBy("cell").count().collect()
    assert {x["cell"]: x["count"] for x in extent} == {i: n for i, n in enumerate(index.cells.rows) if n}


def test_searching_prunes_folders_and_fits_nothing(spark, built, monkeypatch):
    index = store.open_index(spark, built)
    monkeypatch.setattr(trained, "fit_cells", None)  # would fail if called
    monkeypatch.setattr(latent, "fit_weights", None)
    plan = index.rows_of([0, 1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "top#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [" in plan and "cell" in plan.split("PushedFilters: [")[1].split("]")[0]
    folders = set(index.rows_of([0]).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert all("/top=" in f for f in folders) and len({f.split("/top=")[1].split("/")[0] for f in folders}) == 1


def test_texts_in_precedents_out(spark, built, pairs):
    index = store.open_index(spark, built)
    asked = pairs.where("customer_tweet_id % 3 = 1").limit(40).select("customer_tweet_id", "customer_text")
    exact = {x["query_id"]: [p["id"] for p in x["precedents"]] for x in index.find_precedents(asked, approximate=False).collect()}
    near = {x["query_id"]: [p["id"] for p in x["precedents"]] for x in index.find_precedents(asked).collect()}
    assert len(exact) == 40 and all(len(p) == 3 for p in exact.values())
    texts = {x["customer_tweet_id"]: x["customer_text"] for x in pairs.collect()}
    assert all(texts[p[0]] == texts[q] or q in p for q, p in exact.items())  # an indexed text finds itself or a copy
    hits = sum(len(set(exact[q]) & set(near[q])) for q in exact)
    assert hits >= 0.9 * 3 * 40


def test_appending(spark, built, pairs):
    before = store.open_index(spark, built)
    n = before.rows().count()
    grown = before.append(pairs.where("customer_tweet_id % 3 = 0").limit(60).union(pairs.where("customer_tweet_id = 1")))
    assert before.rows().count() == n and store.open_index(spark, built).rows().count() == n + 60 == grown.cells.rows.sum()
    new = grown.rows().where("customer_tweet_id % 3 = 0").first()
    found = grown.find_precedents(spark.createDataFrame([(1, new["customer_text"])], "customer_tweet_id long, customer_text string"), approximate=False)
    assert any(p["customer_text"] == new["customer_text"] for p in found.first()["precedents"])
    # an unfinished manifest is not seen
    spark.range(1).write.parquet(f"{built}/manifest/9999999999")
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{built}/manifest/9999999999/_SUCCESS")
    done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(done, False)
    assert store.open_index(spark, built).rows().count() == n + 60
    assert store.open_index(spark, built, 1).rows().count() == n


def test_no_index(spark):
    with pytest.raises(FileNotFoundError):
        store.open_index(spark, scratch_path(spark, "none"))


def test_triage_over_an_index(spark, built, pairs):
    from caseloom.operators.scoring import column_scorer
    from caseloom.plans.triage import run_triage
    scorer = column_scorer(lambda system, prompt: F.lit("[]"))
    out = run_triage(pairs.limit(5).select("customer_tweet_id", "customer_text"), store.open_index(spark, built), scorer, scorer, keep_precedents=True)
    assert [len(x["precedents"]) for x in out.collect()] == [3] * 5


def test_a_latent_fit_hashes_every_text_once(spark, pairs, monkeypatch):
    calls, whole = [], latent.word_features
    monkeypatch.setattr(latent, "word_features", lambda *a: calls.append(a) or whole(*a))
    model = latent.fit_latent(pairs, "customer_text", 4, features=64)
    assert len(calls) == 1
    assert np.array_equal(model.idf, latent.fit_weights(pairs, "customer_text", 64).idf)


# --- what an index writes and moves

PAIR = "customer_tweet_id long, customer_text string, apple_reply_text string, is_dm_redirect boolean, thread_depth long"


def test_building_writes_every_text_once(spark, tmp_path):
    import os
    import random

    from caseloom.session import scratch_root
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=20_000)) for _ in range(120)]
    rows = spark.createDataFrame([(i, x, None, None, 1) for i, x in enumerate(texts)], PAIR)
    rows.write.parquet(f"{tmp_path}/pairs")
    pairs = spark.read.parquet(f"{tmp_path}/pairs")

    def written(folder):
        return {os.path.join(at, f) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}

    before, path = written(scratch_root(spark)), f"{tmp_path}/index"
    store.build_retrieval_table(pairs, latent.fit_weights(pairs, "customer_text", 16), path)
    new = (written(scratch_root(spark)) - before) | written(path)
    assert sum(os.path.getsize(f) for f in new) < 1.5 * sum(os.path.getsize(f) for f in written(f"{tmp_path}/pairs"))


def test_ids_without_fields_read_no_text(spark, built, pairs):
    index = store.open_index(spark, built)
    asked = pairs.where("customer_tweet_id % 3 = 1").limit(30).select("customer_tweet_id", "customer_text")
    vectors = index.embed(asked).select("customer_tweet_id", "embedding")
    bare = index.find_precedents(vectors, approximate=False, fields=())
    whole = index.find_precedents(vectors, approximate=False).selectExpr("query_id", "transform(precedents, p -> struct(p.rank, p.distance, p.id)) AS precedents")
    assert sorted(bare.collect()) == sorted(whole.collect()) and bare.count() == 30
    assert "customer_text" not in bare._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_and_held_ids(spark, tmp_path):
    """Of rows that repeat an id the first by text stays; null ids stay out; an append leaves ids out that are held."""
    path = f"{tmp_path}/index"
    rows = [(1, "b b", "x", True, 1), (1, "a b", "z", None, 2), (1, "a b", "y", None, 3), (2, "c d", "q", False, 1), (None, "e", "e", None, 1), (3, None, "n", None, 1)]
    first = spark.createDataFrame(rows, PAIR)
    model = latent.fit_weights(first, "customer_text", 16)
    built = store.build_retrieval_table(first, model, path)
    columns = ["customer_tweet_id", "customer_text", "apple_reply_text", "is_dm_redirect", "thread_depth"]

    def held(index):
        return sorted(tuple(x) for x in index.rows().select(*columns).collect())

    want = [(1, "a b", "y", False, 3), (2, "c d", "q", False, 1), (3, None, "n", False, 1)]
    assert held(built) == want and built.cells.rows.sum() == 3 == built.placed().count()
    more = spark.createDataFrame([(2, "new", "new", None, 1), (4, "d", "b", True, 1), (4, "c", "b", True, 1), (5, "e", "e", None, 1)], PAIR)
    grown = built.append(more)
    assert held(grown) == [*want, (4, "c", "b", True, 1), (5, "e", "e", False, 1)]
    assert grown.cells.rows.sum() == 5 == grown.placed().count() and held(store.open_index(spark, path)) == held(grown)
    assert sorted(tuple(x) for x in store.load_retrieval_table(spark, path).select(*columns).collect()) == held(grown)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_wide_blocks_find_the_same(spark, monkeypatch, kind):
    monkeypatch.setattr(r, "BLOCK_ROWS", 40)
    monkeypatch.setattr(r, "CHUNK_ROWS", 40)
    assert [r._width(n, n, 6, 8) for n in (40, 200, 240, 480, 9_000)] == [1, 1, 2, 4, 4] and r._width(9_000, 9_000, 1 << 18, 8) == 1
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(500, 6)), 3).astype("float32" if kind == "float" else "float64")
    x[:90] = x[90]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"id long, embedding array<{kind}>")
    seen, whole = [], r._width
    monkeypatch.setattr(r, "_width", lambda *a: seen.append(whole(*a)) or seen[-1])
    got = {(f.query_id, f["rank"], f.corpus_id): f.distance for f in r.knn_exact(df, df, 3, n_cells=7).collect()}
    want = {}
    for i, v in enumerate(x.astype(float)):
        d = ((x.astype(float) - v) ** 2).sum(1)
        want |= {(i, rank, int(j)): float(d[j]) for rank, j in enumerate(np.lexsort((np.arange(len(d)), d))[:3], 1)}
    assert got == want and seen == [4]


# --- what a text costs

def test_words_are_hashed_as_spark_cuts_them(spark):
    """Cut by Java's letters and digits after lower-casing, of whatever script; null and invalid bytes too."""
    signs = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2200), 0x130, 0x212A, 0x2160, 0x3042, 0x3002, 0x663, 0xE0001, 0x1D518, 0x1F600]]
    texts = [f"a{c}B {c}{c}_1" for c in signs] + ["", "  ", None, "Σ ΑΣ, don't--stop"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").unionByName(
        spark.createDataFrame([(b"ab\xffcd \xc3",)], "b binary").selectExpr("CAST(b AS string) AS text"))
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}_]+"), "")
    plain = F.transform(words, lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"), F.lit(1_000_003)).cast("int"))
    for got in rows.select(latent.word_features(F.col("text"), 1_000_003).alias("got"), plain.alias("want")).collect():
        assert got.got == got.want


def test_a_filter_on_vectors_embeds_no_text_twice(spark):
    """Neither does it embed, below a join, the texts that the join leaves out."""
    pairs = spark.createDataFrame([(i, f"w{i} x", "y", None, 1) for i in range(9)], PAIR)
    model = latent.TextModel(np.ones(16))
    golden = pairs.where("customer_tweet_id % 3 = 0").select("customer_tweet_id")
    plan = store._tidy(model.embed(pairs.join(golden, "customer_tweet_id", "left_anti"), "customer_text"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("vector(") == 1 and plan.index("vector(") < plan.index("LeftAnti")


def test_long_texts_are_cut_in_parts(monkeypatch):
    texts = [b"a b  a", b"", b" x" * 400, b"b", b"c"]
    whole = latent._hashed(texts, 50)
    monkeypatch.setattr(latent, "PART_BYTES", 10)
    parts = list(latent._parts(texts, 50))
    assert [t for p in parts for t in p] == texts and len(parts) > 1
    assert np.concatenate([latent._hashed(p, 50)[1] for p in parts]).tolist() == whole[1].tolist()
    assert np.bincount(whole[0], minlength=5).tolist() == [3, 0, 400, 1, 1]
