"""Text embeddings: hashed words weighted by rarity, and a latent projection of them.

A word's feature is a number made of its md5, the same in every engine.  Spark
lowers the texts and blanks what separates words beyond ASCII; a task cuts some
texts at once at the blanks and hashes each of their different words once.  The latent model is a truncated singular value decomposition of the weighted
document-feature matrix by randomised range finding: a random test matrix is
multiplied by the matrix's own square, task by task, and only sums of the size
features x rank leave a task, so no pass needs more than one scan of the texts.
A model is fitted once, saved with the index that uses it, and loaded again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import materialize

FEATURES, RANK, EXTRA, PASSES, SEED = 4096, 64, 8, 2, 7
_FAR_BREAK = r"[^\p{L}\p{N}\x00-\x7F]+"  # what separates words and is not ASCII
_BLANKS = bytes(c if c >= 128 or chr(c).isalnum() or c == ord("_") else ord(" ") for c in range(256))
PART_BYTES, PART_NUMBERS = 1 << 22, 1 << 19  # texts cut at once; entries of a dense matrix of rows by features


def _lowered(text: Column) -> Column:
    """Lower-case UTF-8 bytes in which words are parted by ASCII alone."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _FAR_BREAK, " ").cast("binary")


def _parts(texts: list[bytes], features: int) -> Iterator[list[bytes]]:
    """Runs of texts that are short enough to be cut, and to be a dense matrix, at once."""
    most, low, held = max(512, PART_NUMBERS // features), 0, 0
    for at, text in enumerate(texts):
        if at - low == most or held > PART_BYTES:
            yield texts[low:at]
            low, held = at, 0
        held += len(text)
    if len(texts) > low:
        yield texts[low:]


def _hashed(texts: list[bytes], features: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word of lowered texts: the first 32 bits of its md5, modulo the features."""
    parted = pa.array([t.translate(_BLANKS) for t in texts], pa.large_binary()).view(pa.large_string())
    lists = pc.ascii_split_whitespace(parted)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.view(pa.large_binary()).to_pylist()
    numbers = np.frombuffer(b"".join(hashlib.md5(w, usedforsecurity=False).digest() for w in words), ">u4")[::4].astype(np.int64) % features
    row, at = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy())), coded.indices.to_numpy()
    held = np.array([len(w) > 0 for w in words], bool)[at]  # blanks at an end part an empty word off
    return row[held], numbers[at[held]]


def word_features(text: Column, features: int) -> Column:
    """array<int>: the feature of every word of a text."""

    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        out = []
        for part in _parts(texts.to_list(), features):
            row, feature = _hashed(part, features)
            out += np.split(feature.astype(np.int32), np.searchsorted(row, np.arange(1, len(part))))
        return pd.Series(out, dtype=object)

    return hashed(_lowered(text))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _distinct(pair: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers below `most` in order, and how often each occurs."""
    if most > 16 * len(pair):
        return np.unique(pair, return_counts=True)
    count = np.bincount(pair, minlength=most)
    held = np.flatnonzero(count)
    return held, count[held]


def _weighted(row: np.ndarray, feature: np.ndarray, n: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight) of the distinct features of rows of unit length; features of no weight are left out."""
    pair, count = _distinct(row * len(idf) + feature, n * len(idf))
    row, feature = pair // len(idf), pair % len(idf)
    weight = count * idf[feature]
    held = weight > 0
    row, feature, weight = row[held], feature[held], weight[held]
    length = np.sqrt(np.bincount(row, weight * weight, n))
    return row, feature, weight / length[row]


@dataclass(frozen=True)
class TextModel:
    """Weights of the features, and their projection (features x rank); without one the features themselves are the vector."""

    idf: np.ndarray
    projection: np.ndarray | None = None

    @property
    def dim(self) -> int:
        return len(self.idf) if self.projection is None else self.projection.shape[1]

    def embed(self, df: DataFrame, col: str) -> DataFrame:
        """Adds "embedding" (array<float>): unit length, or zeros for a text without known words."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<float>")
        def vector(texts: pd.Series) -> pd.Series:
            model, out = shared.value, []
            for part in _parts(texts.to_list(), len(model.idf)):
                row, feature, weight = _weighted(*_hashed(part, len(model.idf)), len(part), model.idf)
                dense = np.zeros((len(part), len(model.idf)))
                dense[row, feature] = weight
                if model.projection is not None:
                    dense = dense @ model.projection
                    length = np.sqrt((dense * dense).sum(1, keepdims=True))
                    dense = np.divide(dense, length, out=np.zeros_like(dense), where=length > 1e-12)
                out += list(dense.astype(np.float32))
            return pd.Series(out, dtype=object)

        # never null, and Spark is told so: else a filter on null vectors has every text embedded
        # a second time, below the joins that leave texts out
        return df.withColumn("embedding", F.coalesce(vector(_lowered(F.col(f"`{col}`"))), F.array().cast("array<float>")))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per feature, as Parquet."""
        rows = [(i, float(w), [] if self.projection is None else self.projection[i].tolist()) for i, w in enumerate(self.idf)]
        spark.createDataFrame(rows, "feature int, idf double, projection array<double>").coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["feature"])  # a row per feature
        return TextModel(np.array([r["idf"] for r in rows]), np.array([r["projection"] for r in rows]) if rows[0]["projection"] else None)


def fit_weights(texts: DataFrame, col: str, features: int) -> TextModel:
    """Rarity weights ln((rows + 1) / (rows with the feature + 1)) over all texts."""

    def read(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for part in _parts(batch.column("f").to_pylist(), features):
            yield len(part), *_hashed(part, features)

    return _weights_of(texts.select(_lowered(F.col(f"`{col}`")).alias("f")), features, read)


def _listed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows, and (row, feature) of every word, of lists of features."""
    for low in range(0, batch.num_rows, 512):
        part = batch.slice(low, 512)
        yield part.num_rows, *_flat(part.column("f"))


def _weights_of(rows: DataFrame, features: int, read=_listed) -> TextModel:
    """The weights from the column f of every text, in one pass: texts are counted as a feature of their own; a task sends its own counts only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(features + 1, np.int64)
        for batch in batches:
            for n, row, feature in read(batch):
                pair = _distinct(row * features + feature, n * features)[0]
                seen[:features] += np.bincount(pair % features, minlength=features)
                seen[features] += n
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(seen[held])], ["f", "n"])

    seen = np.zeros(features + 1)
    for r in rows.mapInArrow(count, "f int, n bigint").groupBy("f").agg(F.sum("n").alias("n")).collect():  # a row per feature
        seen[r["f"]] = r["n"]
    return TextModel(np.log((seen[features] + 1.0) / (seen[:features] + 1.0)))


def _squared_times(hashed: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'A q for the weighted matrix A of the texts; a task sends its own sum only."""
    shared = hashed.sparkSession.sparkContext.broadcast((idf, q))
    width = q.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, q = shared.value
        total = np.zeros(q.shape)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                row, feature = _flat(part.column("f"))
                row, feature, weight = _weighted(row, feature, part.num_rows, idf)
                if len(row):
                    dense = np.zeros((part.num_rows, len(idf)))
                    dense[row, feature] = weight
                    total += dense.T @ (dense @ q)
        held = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(list(total[held]), pa.list_(pa.float64()))], ["feature", "y"])

    parts = hashed.mapInArrow(add, "feature int, y array<double>")
    out = np.zeros(q.shape)
    for r in parts.groupBy("feature").agg(*[F.sum(F.col("y")[j]).alias(f"y{j}") for j in range(width)]).collect():  # features x rank numbers
        out[r["feature"]] = [r[f"y{j}"] for j in range(width)]
    return out


def fit_latent(texts: DataFrame, col: str, rank: int = RANK, features: int = FEATURES, passes: int = PASSES, seed: int = SEED) -> TextModel:
    """Weights and the leading right singular vectors of the weighted document-feature matrix.

    All texts are read once, their features once for the weights and once per pass.  Fewer directions come
    out where the matrix has a smaller rank; signs are fixed by each direction's largest entry.
    """
    hashed = materialize(texts.select(word_features(F.col(f"`{col}`"), features).alias("f")), "features")
    weights = _weights_of(hashed, features)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(features, min(rank + EXTRA, features))))[0]
    for _ in range(passes):
        q = np.linalg.qr(_squared_times(hashed, weights.idf, q))[0]
    small = q.T @ _squared_times(hashed, weights.idf, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:rank]
    best = best[values[best] > 1e-9 * max(values.max(initial=0.0), 1e-300)]
    found = q @ vectors[:, best]
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])]) if found.size else np.zeros(0)
    return TextModel(weights.idf, found * signs if found.size else np.zeros((features, 1)))


def embed_text(df: DataFrame, col: str, dim: int = 256, fit_on: DataFrame | None = None) -> DataFrame:
    """Adds "embedding": hashed words, weighted by rarity, unit length.

    fit_on gives the texts the weights are learned from; queries and corpus must share
    it for their distances to mean anything.  A TextModel keeps the weights.
    """
    return fit_weights(df if fit_on is None else fit_on, col, dim).embed(df, col)
