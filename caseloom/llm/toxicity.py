"""Toxic documents by a subsequence string kernel, Nystroem landmarks and a linear SVM.

Method.  Two words are alike by the gap-weighted subsequences of three letters
they share: a triple that spans s letters counts LAMBDA ** s, so an insult with
letters inserted or spread out keeps most of its likeness.  Landmarks are
words and word beginnings whose document frequency differs most between the
labels.  A sentence is described by its words' largest likeness to each
landmark, turned by the inverse root of the landmarks' own kernel matrix
(Nystroem), and a linear SVM is fitted on labelled sentences: those of
documents labelled 0, and the most telling ones of documents labelled 1.  A
logistic curve, fitted on labelled documents, turns the margins of the three
worst sentences and the number of sentences into a document's score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from caseloom.llm.common import pack, unpack, word_list
from caseloom.session import materialize

ORDER, LAMBDA, MAX_SPAN = 3, 0.5, 6
MAX_TRAINING_DOCS = 10_000  # labelled documents a fit reads at most, about; picked by hash of the id
LANDMARKS, CLEAN_LANDMARKS, CANDIDATES = 40, 8, 2000
PREFIXES = (4, 5, 6, 7, 8)
WORST = 3  # sentences that a document's score looks at
HARD, OTHER = 3, 3  # sentences of a document the fit sees: the most telling ones, and others
REG, ROOT_FLOOR = 1e-3, 1e-2
WORDS_AT_ONCE, CHARS_AT_ONCE = 8_000, 2 << 20  # bound what a Python worker holds
LEAST_LIKENESS = 0.3  # less counts as none

_SPREAD = re.compile(r"(?:^|\s)\S\s+\S\s+\S(?:\s|$)")
_PLAIN = re.compile(r"[\W_]+")
_GAPS = [(i, j) for i in range(1, MAX_SPAN) for j in range(1, MAX_SPAN - i)]
_CHARS = 0x600  # code points below this have letters of their own; others are gaps


@dataclass
class Kernel:
    """Landmarks, and what is needed to compare words with them."""

    landmarks: list[str]

    def __post_init__(self):
        letters = sorted({ord(c) for x in self.landmarks for c in x if ord(c) < _CHARS})
        self.base = len(letters) + 1
        self.letter = np.zeros(_CHARS + 1, np.int64)
        self.letter[letters] = np.arange(1, self.base)
        self.place = np.full(self.base ** 3, -1, np.int32)
        own, codes, weights = self._triples(self.landmarks)
        found, triple = np.unique(codes, return_inverse=True)
        self.place[found] = np.arange(len(found))
        phi = np.zeros((len(found), len(self.landmarks)), np.float64)
        np.add.at(phi, (triple, own), weights)
        gram = phi.T @ phi
        self_likeness = np.maximum(np.diag(gram), 1e-12)
        self.phi = (phi / self_likeness).astype(np.float32)
        unit = gram / np.sqrt(np.outer(self_likeness, self_likeness))
        values, vectors = np.linalg.eigh(unit)
        self.root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, ROOT_FLOOR))) @ vectors.T

    def _triples(self, words: list[str]):
        """(word, triple code, weight) of every gapped triple of known letters."""
        raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        c = self.letter[np.minimum(raw, _CHARS)]
        lengths = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        end = np.repeat(np.cumsum(lengths), lengths)
        parts = []
        for i, j in _GAPS:
            n = len(c) - i - j
            if n <= 0:
                continue
            at = np.flatnonzero((end[:n] > np.arange(n) + i + j) & (c[:n] > 0) & (c[i: n + i] > 0) & (c[i + j:] > 0))
            parts.append((word[at], (c[at] * self.base + c[at + i]) * self.base + c[at + i + j],
                          np.full(len(at), LAMBDA ** (i + j + 1))))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Likeness of words to each landmark: shared triples, as a share of the landmark's own.

        Row 0 is zero and stands for all words that are like no landmark; the
        second result is each word's row.
        """
        found, row, n = [np.zeros((1, len(self.landmarks)), np.float32)], np.zeros(len(words), np.int64), 1
        for low in range(0, len(words), WORDS_AT_ONCE):
            own, codes, weights = self._triples(words[low: low + WORDS_AT_ONCE])
            triple = self.place[codes]
            hit = triple >= 0
            own, triple, weights = own[hit], triple[hit], weights[hit].astype(np.float32)
            if len(own):
                order = np.argsort(own, kind="stable")
                own, terms = own[order], self.phi[triple[order]] * weights[order, None]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                alike = np.minimum(np.add.reduceat(terms, first, axis=0), 1.25)
                alike[alike < LEAST_LIKENESS] = 0
                some = alike.any(axis=1)
                found.append(alike[some])
                row[low + own[first[some]]] = np.arange(n, n + len(found[-1]))
                n += len(found[-1])
        return np.concatenate(found), row


def sentences(kernel: Kernel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, likenesses) per sentence that has words; likenesses is the maximum over its words.

    Words are cut, and counted once each, by Arrow; a sentence ends with a piece that ends in . ! or ?.
    """
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    spelled = pc.match_substring_regex(texts, _SPREAD.pattern)
    if pc.any(spelled).as_py():
        texts = pa.array([f"{t} . {_spread(t)}" if s else t for t, s in zip(texts.to_pylist(), spelled.to_pylist())])
    lists = pc.utf8_split_whitespace(texts)
    pieces = pc.dictionary_encode(lists.flatten())
    if isinstance(pieces, pa.ChunkedArray):
        pieces = pieces.combine_chunks()
    starts = lists.offsets.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    word, own = pieces.indices.to_numpy(), pieces.dictionary.to_pylist()
    plain = [_PLAIN.sub("", p) for p in own]
    there = np.fromiter(map(bool, plain), bool, len(plain))
    ends = np.fromiter((p.endswith((".", "!", "?")) for p in own), bool, len(own))
    rows, row = kernel.rows(plain)
    # a piece begins a sentence if it begins a document or follows an end
    begins = np.r_[True, (doc[1:] != doc[:-1]) | ends[word[:-1]]] if len(word) else np.zeros(0, bool)
    sentence = np.cumsum(begins) - 1
    number = int(sentence[-1]) + 1 if len(word) else 0
    of_doc = doc[begins]
    likeness = np.zeros((number, rows.shape[1]), np.float32)
    telling = np.flatnonzero(row[word])
    if len(telling):
        at, hit = sentence[telling], row[word[telling]]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        for low in range(0, len(first), 5_000):  # bounds the gathered rows
            x, y = first[low], first[low + 5_000] if low + 5_000 < len(first) else len(hit)
            likeness[at[first[low: low + 5_000]]] = np.maximum.reduceat(rows[hit[x:y]], first[low: low + 5_000] - x, axis=0)
    spoken = np.bincount(sentence[there[word]], minlength=number) > 0 if number else np.zeros(0, bool)
    return of_doc[spoken], likeness[spoken]


def _spread(text: str) -> str:
    """Words spelled with a space after each letter: the runs of three or more single characters, joined."""
    out, run = [], ""
    for p in [*text.split(), "  "]:
        if len(p) == 1:
            run += p
        else:
            if len(run) > 2:
                out.append(run)
            run = ""
    return " ".join(out)


def _texts(batch: pa.RecordBatch) -> pa.Array:
    """The column text, or that field of the rows in doc: a text is sent to a worker once."""
    return batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("doc"), "text")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about CHARS_AT_ONCE bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(_texts(batch)), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + CHARS_AT_ONCE, "right")))
        yield batch.slice(low, high - low)
        low = high


@dataclass
class Model:
    """Linear in the likenesses: margin of a sentence, then a logistic curve over a document's worst ones."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    curve: list[float]  # of the WORST largest margins and the logarithm of the number of sentences
    offset: float

    def document_rows(self, kernel: Kernel, texts: pa.Array) -> np.ndarray:
        """Per text: its WORST largest sentence margins, and log(1 + sentences)."""
        out = np.full((len(texts), WORST + 1), self.bias)
        doc, likeness = sentences(kernel, texts)
        margin = likeness @ self.weights.astype(np.float32) + self.bias
        order = np.lexsort((-margin, doc))
        doc, margin = doc[order], margin[order]
        place = np.arange(len(doc)) - np.searchsorted(doc, doc)
        worst = place < WORST
        out[doc[worst], place[worst]] = margin[worst]
        out[:, WORST] = np.log1p(np.bincount(doc, minlength=len(texts)))
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ np.array(self.curve) + self.offset, -50, 50)))


def held_out(doc_id: Column) -> Column:
    """Every fifth document by crc32 of its id; none without id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def training_docs(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """(text, toxic) of about max_docs labelled documents at most, never held-out ones."""
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = marked.count()
    if n > max_docs:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(1e6 * max_docs / n))
    # the sample's ids are bounded by max_docs, so they can be sent to every task
    return materialize(docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic")), "training")


def _beginnings(n: int) -> Column:
    return F.transform(F.filter("w", lambda w: F.length(w) > n), lambda w: F.substring(w, 1, n))


def _landmarks(sample: DataFrame) -> list[str]:
    """Words and beginnings of words whose document frequencies differ most; found over the whole sample."""
    words = word_list(F.col("text"))
    starts = [_beginnings(n) for n in PREFIXES]
    per_doc = sample.select("toxic", words.alias("w")).select("toxic", F.explode(F.array_distinct(F.concat("w", *starts))).alias("w"))
    counts = (per_doc.where(F.length("w").between(ORDER, 24)).groupBy("w")
              .agg(F.sum("toxic").alias("n1"), F.count("*").alias("n")))
    share = sample.agg(F.avg("toxic")).first()[0] or 0.0
    if not 0 < share < 1:
        return []
    expected = F.col("n") * share
    z = (F.col("n1") - expected) / F.sqrt(expected * (1 - share))
    ranked = counts.where("n >= 5").withColumn("z", z)
    telling = ranked.orderBy(F.desc("z"), F.desc(F.length("w")), "w").limit(CANDIDATES).collect()
    plain = [r["w"] for r in ranked.orderBy("z", "w").limit(CLEAN_LANDMARKS).collect()]
    chosen: dict[str, int] = {}
    for r in telling:
        if len(chosen) == LANDMARKS:
            break
        longer = [n for w, n in chosen.items() if w.startswith(r["w"])]
        said = any(r["w"].startswith(w) for w in chosen)  # a word of a stem that is chosen
        if not said and r["n1"] >= 1.3 * max(longer, default=0):
            chosen[r["w"]] = r["n1"]
    chosen = list(chosen)
    return chosen + [w for w in plain if w not in chosen]


def _sampled_sentences(kernel: Kernel, n_telling: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(_parts, batches)):
            toxic = np.array(batch.column("toxic").to_pylist())
            doc, likeness = sentences(kernel, _texts(batch))
            evidence = likeness[:, :n_telling].max(axis=1, initial=0)
            order = np.lexsort((-evidence, doc))
            doc, likeness, evidence = doc[order], likeness[order], evidence[order]
            place = np.arange(len(doc)) - np.searchsorted(doc, doc)
            bad = toxic[doc] > 0
            # of a toxic document its most telling sentences, of others the most telling ones and some more
            some = (place < HARD) | (place % 7 == 6) & (place < HARD + 7 * OTHER)
            take = np.where(bad, (place == 0) | (place <= HARD) & (evidence >= 0.9), some)
            rows = likeness[take] @ kernel.root
            yield pa.RecordBatch.from_arrays([pa.array(bad[take].astype(float)), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["label", "row"])

    return run


def _document_rows(model: Model, column: str, out: str, finish):
    """A column that stays, and one that is made of each text's sentences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(model.landmarks)
        for batch in chain.from_iterable(map(_parts, batches)):
            rows = model.document_rows(kernel, _texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column(column), finish(rows)], [column, out])
            pa.default_memory_pool().release_unused()  # what a slice took, before the next one

    return run


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model | None:
    """A model of the label toxic; None when the sample does not hold both labels."""
    # not at the top: Python workers import this module and never fit
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.functions import array_to_vector

    sample = training_docs(docs, labels, max_docs)
    landmarks = _landmarks(sample)
    if not landmarks:
        return None
    kernel = Kernel(landmarks)
    n_telling = len(landmarks) - min(CLEAN_LANDMARKS, len(landmarks) - 1)
    sentences = materialize(sample.mapInArrow(_sampled_sentences(kernel, n_telling), "label double, row array<double>"), "sentences")
    share = sentences.agg(F.avg("label")).first()[0]
    weight = F.when(F.col("label") == 1, math.sqrt((1 - share) / share)).otherwise(1.0)  # between one each and equal sums
    svm = LinearSVC(maxIter=60, regParam=REG, standardization=False, weightCol="weight").fit(
        sentences.select("label", array_to_vector("row").alias("features"), weight.alias("weight")))
    model = Model(landmarks, kernel.root @ np.array(svm.coefficients.toArray()), float(svm.intercept), [], 0.0)
    as_lists = lambda rows: pa.array(rows.tolist(), pa.list_(pa.float64()))
    rows = materialize(sample.mapInArrow(_document_rows(model, "toxic", "row", as_lists), "toxic int, row array<double>"), "curve")
    curve = LogisticRegression(maxIter=60, regParam=1e-4).fit(
        rows.select(F.col("toxic").cast("double").alias("label"), array_to_vector("row").alias("features")))
    model.curve, model.offset = [float(x) for x in curve.coefficients], float(curve.intercept)
    return model


def with_score(rows: DataFrame, model: Model | None) -> DataFrame:
    """The column doc and its score, of the column text or else of doc.text; without a model every score is 0."""
    if model is None:
        return rows.select("doc", F.lit(0.0).alias("score"))
    kind = StructType([rows.schema["doc"]]).add("score", DoubleType())
    return rows.mapInArrow(_document_rows(model, "doc", "score", lambda r: pa.array(model.score(r))), kind)


def score_documents(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the whole text is read.

    Null and empty texts get the score of a sentence without words; repeated rows
    are scored alike; a document labelled twice counts as toxic if either says so;
    with no labels, or one label only, every score is 0; extra columns are ignored.
    """
    model = fit(docs, labels, max_docs)
    rows = with_score(docs.select(F.struct(F.col("doc_id")).alias("doc"), "text"), model)
    return rows.select(F.col("doc.doc_id").alias("doc_id"), held_out(F.col("doc.doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """Rows whose text scores below 0.5, all columns as they came."""
    model = fit(docs, labels, max_docs)
    return unpack(with_score(pack(docs), model).where(F.col("score") < 0.5).select("doc"))
