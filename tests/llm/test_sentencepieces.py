"""Encoding and decoding against the sentencepiece library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from caseloom.llm import sentencepieces
from caseloom.llm.common import table
from caseloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ALPHABET = "ab ▁  \t\nzé日本😀\u0000<0x41>s/ thein.,"


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path(sentencepieces.MODEL), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def codec(model):
    return sentencepieces.Codec(model)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op13_sentencepiece"](spark, SF).collect()
    assert len(got) == len(texts) and all(r["agrees"] for r in got)
    for r in got:
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_random_texts(codec, library):
    rng = random.Random(1)
    for _ in range(4_000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(90)))
        assert codec.encode(text) == (library.encode(text), True)
        ids = library.encode(text)
        assert codec.decode(ids) == library.decode(ids)


def test_random_ids_decode_alike(codec, library):
    rng = random.Random(2)
    for _ in range(2_000):  # broken characters, controls and unknown ids among them
        ids = [rng.randrange(260) if rng.random() < 0.5 else rng.randrange(32_000) for _ in range(rng.randrange(25))]
        assert codec.decode(ids) == library.decode(ids)


def test_both_agendas_agree(codec):
    rng = random.Random(3)
    stretches = ["".join(rng.choice("theinaors▁▁▁▁é日") for _ in range(rng.randrange(1, 60))) for _ in range(2_000)]
    for stretch, symbols in zip(stretches, codec._merge_many(stretches)):
        assert [codec.pieces[i] if i < sentencepieces.OTHER else chr(i - sentencepieces.OTHER) for i in symbols] == codec._merge_long(stretch)


def test_long_stretches_without_blanks(codec, library):
    for text in ("z" * 50_000, "日本" * 5_000, "thein" * 5_000, " " * 5_000, "a1" * 30 + "é" * 100):
        assert codec.encode(text)[0] == library.encode(text)


def test_a_wrong_stretch_is_noticed(model):
    codec = sentencepieces.Codec(model)
    merge = codec._merge_many
    codec._merge_many = lambda part: [tuple(codec.ids[c] for c in s) if s == "▁second" else m for s, m in zip(part, merge(part))]
    assert [codec.encode(t)[1] for t in ("first word", "the second word", "second", "third word", "  ")] == [True, False, False, True, True]


def test_memory_of_stretches_is_bounded(model, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "STRETCHES_KEPT", 3)
    codec = sentencepieces.Codec(model)
    text = "one two three four five six one two three"
    for _ in range(3):
        assert codec.encode(text)[0] == library.encode(text) and len(codec.known) <= 9 and len(codec.older) <= 9


def test_other_model_types_are_refused(model):
    at = model.rindex(b"\x18\x02")  # the trainer's model type
    with pytest.raises(ValueError):
        sentencepieces.Codec(model[:at] + b"\x18\x01" + model[at + 2:])


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "no id"), (4, "same"), (4, "same"), (5, "word " * 30_000), (6, "\u0000 é😀")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("ids", "n_tokens", "agrees", "pieces")})
    got = sentencepieces.encode(df).collect()
    assert len(got) == len(rows) and all(r["agrees"] for r in got)
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert [(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in empty] == [(0, sha(""), sha(""))] * 2
    assert sentencepieces.encode(df.limit(0)).collect() == []


def test_round_trip_of_stored_ids(spark):
    texts = [(1, "some text, kept"), (2, "日本 and 😀"), (3, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    ids = sentencepieces.encode(df, keep_ids=True)
    assert {r["doc_id"]: r["text"] for r in sentencepieces.decode(ids).collect()} == {1: "some text, kept", 2: "日本 and 😀", 3: ""}


def test_encoded_ids_decode_without_a_look_at_each():
    import public_tokenizers
    from caseloom.llm import sentencepieces
    with open(public_tokenizers.path(sentencepieces.MODEL), "rb") as file:
        codec = sentencepieces.codec_of(file.read())
    for text in ["", "a b", " 日本 \U0001f600\x00", "é\n\tü  x"]:
        ids, same = codec.encode(text)
        assert same and codec.decode(ids, encoded=True) == codec.decode(ids) == codec.library.decode(ids)
