"""Operators against plain versions, exact round trips and held-out accuracy."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseloom.llm import fingerprints, minhash, mixing, neighbours, packing, pii, sharding, toxicity, urls
from caseloom.llm.common import table
from caseloom.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


# --- near duplicates

def test_near_duplicates_agree_with_all_pairs(spark, docs):
    rng = random.Random(3)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    vocabulary = [f"w{i}" for i in range(900)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(90):  # near copies around the threshold, in buckets larger than the small ones
        copy = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 4))):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts[10_000 + i] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == brute.near_classes(texts)


A, B = ("some words of a text that is long enough to be a text of its own", "quite another text whose words are not the words of that other one")


def test_an_id_of_two_unlike_texts_loses_neither(spark):
    df = spark.createDataFrame([(5, A), (5, B), (7, B)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in minhash.drop_near_duplicates(df).collect()) == [(5, B), (5, A)]
    keys = {(r["doc_id"], r["class_key"]) for r in minhash.near_duplicates(df).collect()}
    assert len(keys) == 3 and len({k for _, k in keys}) == 2


def test_near_copies_without_id_go(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(None, long), (None, long + " more"), (3, long + " end"), (None, A), (None, A), (None, B + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(((r["doc_id"], r["text"]) for r in minhash.drop_near_duplicates(df).collect()), key=repr) == sorted(
        [(3, long + " end"), (None, A), (None, B + "!")], key=repr)


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    hashes = np.sort(rng.integers(0, 2 ** 63, 60).astype(np.uint64))
    x, y = rng.uniform(0.2, 4, 60), rng.uniform(0.2, 4, 60)
    sig = minhash.dart_signatures(np.repeat([0, 1], 60), np.r_[hashes, hashes], np.r_[x, y], 2, 4_000)
    want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_blocks_find_what_leaders_leave(spark, monkeypatch, docs):
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 0)
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 2)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 2)
    texts = {r["doc_id"]: r["text"] for r in docs.limit(120).collect()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()} == brute.near_classes(texts)


# --- personal data

HARD = ["a@b.com@c.org a@b.c_d@e.f x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.003.255", "+1 (988) 555-2485 ++49 30 123456-7 +1+2+3",
        "😀😀 me@x.de 4111111111111111 4111-1111-1111-1111 4111 1111 1111 1112", "9" * 20_000, "a" * 200_000, "a.b" * 9_000 + "@", "+1" + "(" * 5_000,
        None, "", "..@a..b@c.d.e.", "1..2.3.4.5", "+12 345 678 9012 .", "12345678901234567890 4 4 4"]


def test_base_spans(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()} | {10_000 + i: t for i, t in enumerate(HARD)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.find_personal_data(df).collect():
        want = brute.base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(brute.joined(want)), texts[r["doc_id"]][:200]
        assert [r[f"n_{k}"] for k in brute.KINDS] == [sum(k == x for _, x, _ in want) for k in range(4)]
        assert set(brute.joined(want).split(",")) <= set(r["spans"].split(",")) or not want


def test_redaction_leaves_other_text(spark):
    rows = pii.redact(spark.createDataFrame([(1, "x me@x.de, 1.2.3.4!", 19), (2, "plain", 5)], "doc_id long, text string, n_chars long")).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, "x [EMAIL], [IP]!", 16), (2, "plain", 5)]


def test_trees_as_columns_give_the_models_margin(spark):
    rng = random.Random(1)
    texts = [(i, f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now, number {rng.randint(10 ** 7, 10 ** 8)} of {rng.randint(10 ** 15, 10 ** 16)}") for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    model = pii.fit(df)
    assert model and 0 < model.threshold <= 1
    clean = spark.createDataFrame([(1, "nothing here 12 34"), (2, "dial (456) 555-2186 please")], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.with_spans(clean.select(F.struct("*").alias("doc")), "doc.text", model).select("doc.doc_id", pii._joined(F.col("spans")).alias("spans")).collect()}
    assert spans[1] == "" and spans[2] in ("", "phone:5:19")


def test_spans_that_the_rules_miss_are_found(spark):
    """Numbers that touch another one, lack their plus or have written-out at signs: precision and recall against what was planted."""
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while True:
            d = "4" + digits(15)
            if sum(int(c) if i % 2 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d)) % 10 == 0:
                return d

    def phone():
        return f"({rng.randint(200, 999)}) 555-{digits(4)}"

    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(rng.randint(3, 8)))
    rows, planted = [], {}
    for i in range(900):
        plain = [f"+1 {phone()}", card(), f"{word()}.{digits(2)}@mail{digits(1)}.example.com", f"order {digits(7)}", f"key {digits(16)}"]
        text = f"{word()} {rng.choice(plain)} {word()} {rng.choice(plain)} {word()}"
        if i % 9 == 0:
            at, c, d = len(text) + 1, card(), card()
            made = [(f"{c} {d}", [("card", 0, 16), ("card", 17, 33)]), (f"+1 {phone()} {c}", [("phone", 0, 17), ("card", 18, 34)]), (phone(), [("phone", 0, 14)]),
                    (written := f"{word()}.12 [at] mail3.example.com", [("email", 0, len(written))])][i // 9 % 4]
            text, planted[i] = f"{text} {made[0]} {word()}", {f"{k}:{at + x}:{at + y}" for k, x, y in made[1]}
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    added = {(r["doc_id"], s) for r in pii.find_personal_data(df).collect() for s in r["spans"].split(",") if s} - {
        (i, s) for i, t in rows for s in brute.joined(brute.base_spans(t)).split(",")}
    want = {(i, s) for i, spans in planted.items() for s in spans} - {(i, s) for i, t in rows for s in brute.joined(brute.base_spans(t)).split(",")}
    assert len(want) > 100 and len(added & want) >= 0.9 * len(want) and len(added & want) >= 0.9 * len(added), (len(added), len(want), sorted(added - want)[:5], sorted(want - added)[:5])


def test_many_numbers_in_one_text(spark):
    n = 20_000
    text = "x a@b.de 1.2.3.4 030 1234 5678 zz\n" * n
    model = pii.Model([(1.0, (1, 3.0, 0.0, 1.0))], 5.0, 0.0, 0.9)
    df = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    row = pii.with_spans(df.select(F.struct("*").alias("doc")), "doc.text", model).select("base", "spans").first()
    assert [tuple(b) for b in row["base"]] == brute.base_spans(text)
    assert [tuple(s) for s in row["spans"]][-3:] == [(len(text) - 32, 0, len(text) - 26), (len(text) - 25, 1, len(text) - 18), (len(text) - 17, 3, len(text) - 4)]
    assert len(row["spans"]) == 3 * n
    assert pii.redact(df).first()["text"] == "x [EMAIL] [IP] 030 1234 5678 zz\n" * n


def test_a_frequent_candidate_counts_once(spark):
    rows = [(i, "call +1 (200) 555-0101 now") for i in range(3_000)] + [(10_000 + i, f"dial +1 ({200 + i}) 555-0199 or {10 ** 9 + i}") for i in range(300)]
    got = pii.training_rows(spark.createDataFrame(rows, "doc_id long, text string"), max_rows=400).count()
    assert 100 < got < 800


# --- toxicity

def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("aeiounrstlmd") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    rows = []
    for i in range(1_500):
        words = [rng.choice(vocabulary) for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["gobshyte", "nitwhack", "plonkerz"])
        rows.append((i, " ".join(w + "." * (n % 9 == 8) for n, w in enumerate(words)), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"))
    scored = toxicity.score_documents(df.drop("toxic"), df.select("doc_id", "toxic")).join(df.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in scored if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    assert sum((r["predicted"] == 1) == (r["toxic"] == 1) for r in held) >= 0.97 * len(held)
    kernel = toxicity.Kernel(model.landmarks)
    say = lambda t: float(model.score(model.document_rows(kernel, pa.array([t], pa.string())))[0])
    for spelled in ("you g.o.b.s.h.y.t.e and n i t w h a c k", "gobxshyte. nitwhhack"):
        assert say(spelled) > say("you are all right and fine"), spelled


def test_kernel_is_the_gapped_triple_kernel():
    kernel = toxicity.Kernel(["abcd"])

    def phi(word):
        out = collections.Counter()
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, len(word)):
                    if k - i < toxicity.MAX_SPAN:
                        out[word[i] + word[j] + word[k]] += toxicity.LAMBDA ** (k - i + 1)
        return out

    a = phi("abcd")
    for word in ("abcd", "abxcd", "zabzcz"):
        want = sum(v * a[t] for t, v in phi(word).items()) / sum(v * v for v in a.values())
        rows, row = kernel.rows([word])
        assert abs(rows[row[0], 0] - (want if want >= toxicity.LEAST_LIKENESS else 0)) < 1e-5


# --- mixing, shards, packing

def test_poisson_counts_have_the_right_mean(spark):
    for mean in (0.3, 2.0, 40.0, 2_000.0):
        n = spark.range(3_000).select(mixing.poisson_count(F.col("id").cast("string"), F.lit(mean), 1).alias("n"))
        m, v = n.agg(F.avg("n"), F.var_samp("n")).first()
        assert abs(m - mean) < 5 * (mean / 3_000) ** 0.5 and 0.85 < v / mean < 1.15


def test_mix_reaches_target_weights(spark):
    df = spark.range(6_000).select(F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("source"))
    got = {r["source"]: r["count"] for r in mixing.mix_sources(df, {"a": 1.0, "b": 3.0}).groupBy("source").count().collect()}
    assert abs(got["b"] / sum(got.values()) - 0.75) < 0.03 and abs(sum(got.values()) - 6_000) < 400


def test_shards_are_even_and_gapless(spark, docs):
    rows = sharding.placements(docs, bucket_bytes=50_000).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert len(rows) == docs.count() and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    text = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) and r["size"] == len(text[r["doc_id"]]) + 16 for r in rows)


def test_written_shards_hold_every_row(docs, spark, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    assert spark.read.parquet(str(tmp_path / "out")).select(docs.columns).exceptAll(docs).isEmpty()


@pytest.mark.parametrize("weights", [None, {"src0": 5.0, None: 2.0}])
def test_packing_round_trip(spark, docs, weights):
    import public_tokenizers
    from tokenizers import Tokenizer
    more = spark.createDataFrame([(10 ** 6 + i, t, s) for i, (t, s) in enumerate([(None, None), ("", "z"), ("a <|endoftext|> b", "z"), ("x" * 30_000, "src0"), ("é 日本 😀", "q")])],
                                 "doc_id long, text string, source string")
    df = docs.select("doc_id", "text", "source").union(more)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4") for r in df.collect()}
    by_doc, by_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack_windows(df, weights).collect():
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_window[r["sequence_id"]].append((r["offset"], r["length"], r["source"]))
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]: r["start"] + r["length"]].tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    for pieces, size in [*((p, len(ids[d])) for d, p in by_doc.items()), *(([x[:2] for x in w], 2048) for k, w in by_window.items() if k < max(by_window))]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == size
    assert by_doc.keys() == ids.keys() and sorted(by_window) == list(range(len(by_window)))
    if weights is None:  # every full window keeps the shares, to the token
        sizes = collections.Counter({s: 0 for w in by_window.values() for _, _, s in w})
        for w in by_window.values():
            for _, n, s in w:
                sizes[s] += n
        total = sum(sizes.values())
        for k in range(max(by_window)):
            own = collections.Counter()
            for _, n, s in by_window[k]:
                own[s] += n
            assert all(abs(own[s] - 2048 * sizes[s] / total) <= 2 for s in sizes)


# --- fingerprints, neighbours, URLs

def test_following_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "PARTITION_BYTES", 1 << 16)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.compare_with_following(docs).collect()}
    for i, (d, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        assert got[d]["edited_sha256"] == brute.sha(t[: len(t) - len(t) // 3] + n[: len(t) // 3])
        a, b = fingerprints.as_set(got[d]["fingerprint"]), fingerprints.as_set(got[rows[(i + 1) % len(rows)][0]]["fingerprint"])
        assert got[d]["near_next"] == fingerprints.likeness(a, b)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.9


def test_similar_texts_are_all_found(docs):
    texts = {r["doc_id"]: fingerprints.spots(r["text"]) for r in docs.collect()}
    members, pairs = fingerprints.similar_texts(docs, 0.6)
    named = {r["doc_id"]: r["class"] for r in members.collect()}
    got = {frozenset((r["a"], r["b"])) for r in pairs.collect()}
    want = {frozenset((named[x], named[y])) for x in texts for y in texts if named[x] != named[y] and fingerprints.likeness(texts[x], texts[y]) >= 0.6}
    assert got == want and all((texts[x] == texts[y]) == (named[x] == named[y]) for x in texts for y in texts)


def test_neighbours_are_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATE_ROWS", 60)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 5)
    df = table(spark, SF, "embeddings").select("vec_id", "embedding").limit(300)
    df = df.union(df.where("vec_id < 30").selectExpr("vec_id + 100000", "embedding"))  # ties
    rows = df.collect()
    ids, m = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    for i, q in enumerate(ids):
        if q % 20 == 0:
            order = np.lexsort((ids, -np.round(m @ m[i], 12)))
            assert got[q] == [ids[j] for j in order if ids[j] != q][:20]


def test_rules_and_trees(spark):
    pages = table(spark, SF, "pages")
    got = urls.judge(pages).collect()
    for r in got:
        rest = r["url"].split("://", 1)[1]
        assert rest.startswith(r["path"], len(r["host"])) and rest.lower().startswith(r["host"])
        fits = [(len(a), a, v) for a, v in urls.RULES if (r["host"] == a.split("/")[0] or r["host"].endswith("." + a.split("/")[0])) and r["path"].startswith("/" + a.split("/", 1)[1])]
        assert r["rule"] == (max(fits)[1] if fits else None) and (not fits or r["verdict"] == max(fits)[2])


def test_trees_learn_verdicts(spark):
    rng = random.Random(2)
    said = lambda i: "9" * 8 if i % 2 else "story"
    rows = [(i, f"http://h{rng.randint(0, 40)}.s{rng.randint(0, 4)}.net/{'es' if i % 2 else 'xs'}/{said(i)}{rng.randint(0, 99)}") for i in range(400)]
    rows += [(1_000 + i, f"http://h{i}.s{rng.randint(0, 4)}.net/ab/{said(i)}{i}") for i in range(20)]
    rules = (("net/es/", "block"), ("net/xs/", "allow"))
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert all(got[1_000 + i]["rule"] is None and got[1_000 + i]["verdict"] == ("block" if i % 2 else "allow") for i in range(20))


# --- the pipeline

def test_pipeline_stages_in_order(spark):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    pieces = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns) and pieces.count() > 0


def test_stage_keeps_one_of_each_class(spark, docs):
    want = brute.near_classes({r["doc_id"]: r["text"] for r in docs.collect()})
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))


def test_a_frequent_url_counts_once_in_the_sample(spark):
    rows = [("http://hot.com/a", 0.0)] * 5_000 + [(f"http://h{i}.net/es/{i}", 1.0) for i in range(2_000)] + [("http://none.org/", None)]
    described = spark.createDataFrame(rows, "url string, label double")
    assert urls.training_urls(described, 10_000, 2_001).count() == 2_001
    assert 150 < urls.training_urls(described, 300, 2_001).count() < 450


def test_trees_judge_held_out_urls_like_their_rules(spark):
    """Rules on half of the hosts label URLs; the other half's verdicts, which depend on the path's start, are for the trees."""
    rng = random.Random(3)
    rows = []
    for i in range(4_000):
        bad = rng.random() < 0.4
        name = "".join(rng.choice("abcdefghij") for _ in range(6)) + ("".join(rng.choice("0123456789") for _ in range(5)) if bad else "")
        tail = f"?{'&'.join(f'k{j}={rng.randint(0, 999)}' for j in range(6))}" if bad else "/page.html"
        zone = rng.choice(["seen", "new"])
        rows.append((i, f"http://{name}.{zone}/{'x' if bad else 'y'}/{rng.randint(0, 99)}{tail}", zone, bad))
    rules = (("seen/x/", "block"), ("seen/y/", "allow"))
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"), rules).collect()}
    new = [(got[i], bad) for i, _, zone, bad in rows if zone == "new"]
    assert all(r["rule"] is None for r, _ in new) and sum((r["verdict"] == "block") == bad for r, bad in new) >= 0.95 * len(new)


def test_every_candidate_trains(spark):
    """More different candidates than any sample held: all of them are rows of the fit."""
    rows = [(i, f"order {10 ** 9 + 7 * i} shipped") for i in range(25_000)]
    assert pii.training_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).count() >= 25_000
