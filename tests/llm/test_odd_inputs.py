"""Every operator and stage over nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseloom.llm import fingerprints, licenses, minhash, mixing, neighbours, packing, pii, sharding, toxicity, urls

CLASHING = ("doc", "node", "band", "bands", "sig", "root", "a", "b", "h", "bucket", "rows", "copy", "copies", "place", "name", "rate", "start",
            "tokens", "ids", "queue", "base", "spans", "score", "label", "toxic", "k", "r", "w", "row", "n")


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with every oddity, and columns named like the operators' helpers."""
    rows = [(1, "the same words of a text that is long enough to have some shingles in it", "s"),
            (2, "the same words of a text that is long enough to have some shingles in it", "s"),
            (2, "the same words of a text that is long enough to have some shingles in it", "s"),
            (3, None, None), (4, "", "t"), (5, "  \n \t", "t"), (6, "x", None), (7, "word " * 30_000, "s"), (8, "z" * 60_000, "u"),
            (9, "\u0000 😀 é 日本語 \ud7ff", "u"), (10, "mail a.b@c.de or 10.0.0.1 or +49 (30) 123456-7", "v"), (None, "no id at all", "v"),
            (None, None, None), (11, "idiot idiot idiot. MORON!", "v")]
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def labels(spark):
    """Labels of odd documents: null, repeated, of no document."""
    rows = [(1, 0), (2, 0), (11, 1), (11, 1), (10, None), (None, 1), (999, 1), (4, 0)]
    return spark.createDataFrame([(i, 1, t) for i, t in rows], "doc_id long, quality int, toxic int")


PER_ROW = {
    "personal data": lambda d, _: pii.find_personal_data(d),
    "toxicity": toxicity.score_documents,
    "fingerprints": lambda d, _: fingerprints.compare_with_following(d),
    "shards": lambda d, _: sharding.placements(d),
    "licences": lambda d, _: licenses.scan(d),
    "near duplicates": lambda d, _: minhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(odd, labels, name):
    found = PER_ROW[name](odd, labels).collect()
    ids = sorted((r["doc_id"] for r in odd.select("doc_id").collect()), key=lambda i: (i is None, i))
    assert sorted((r["doc_id"] for r in found), key=lambda i: (i is None, i)) == ids


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(odd, labels, name):
    assert PER_ROW[name](odd.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stage(spark, odd, labels, stage, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    run = dict(corpus_pipeline.STAGES)[stage]
    out, none = run(spark, odd, str(tmp_path)), run(spark, odd.limit(0), str(tmp_path))
    assert none.collect() == []
    if stage != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == odd.columns == none.columns
        assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING)
    if stage == "near_duplicates":
        kept = [r["doc_id"] for r in out.collect()]
        assert sorted(i for i in kept if i) == [1, 3, 6, 7, 8, 9, 10, 11] and kept.count(None) == 1


def test_a_source_without_text_has_a_mean_of_one(odd):
    rates = mixing.source_rates(odd.where("source is null and text is null"), {None: 3.0}, 1.0).collect()
    assert [r["rate"] for r in rates] == [1.0]


def test_packing_odd_rows(odd):
    pieces = packing.pack_windows(odd).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] == 3) == 1 and sum(p["length"] for p in pieces if p["doc_id"] == 4) == 1
    assert len({p["doc_id"] for p in pieces}) == 12


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (None, [1.0, 1.0]), (1, [2.0, 0.0]),
            (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1))
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_odd_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "x://com/"), (4, ""), (5, "x://" + "a" * 50_000), (5, "x://com/"), (None, "x://b.net/es/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("own"), "label": F.lit("own")})
    got = urls.judge(df).collect()
    assert len(got) == 7 and urls.judge(df.limit(0)).collect() == []
    assert {r["page_id"]: r["host"] for r in got}[2] == "" and all(r["verdict"] in ("allow", "block") for r in got)
