"""The retrieval index: historical pairs with their vectors, in trained cells, on shared storage.

    path/texts/gen=<name>/             pairs and vectors, as they came
    path/rows/gen=<name>/top=<n>/...   ids, vectors and codes, sorted by cell
    path/parts/<name>/{cells,codes,model}   centres, codebooks and the text model
    path/manifest/<number>/            the parts, the generations, and the extent of every cell

A manifest is complete once its _SUCCESS file is there; readers take the complete
one of the highest number, so a rebuild or an append shows at once or not at all,
and readers of an older manifest keep their files.  Appending places new rows in
the cells as they are.  Searches read only the folders of the top cells they look
into, and of their files only the row groups that hold a cell wanted.  Texts are
written once and take part in no shuffle, unless their id repeats.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.operators import retrieval as r
from caseloom.operators.cells import CODEWORDS, SLICE, Cells, assign, with_extent
from caseloom.operators.latent import TextModel
from caseloom.session import materialize
from caseloom.sources import manifests

Embedder = Callable[[DataFrame], DataFrame]  # adds a column "embedding"

KEY = "customer_tweet_id"
PAYLOAD = (KEY, "customer_text", "apple_reply_text", "is_dm_redirect", "thread_depth")
MAX_LISTED_CELLS = 4_096  # more are not worth a filter on the scan


def _write_small(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


@dataclass(frozen=True)
class RetrievalIndex:
    """One state of the index: what its manifest names."""

    spark: SparkSession
    path: str
    parts: str
    generations: tuple[str, ...]
    cells: Cells
    model: TextModel | None

    # --- rows

    def texts(self) -> DataFrame:
        """All pairs of the index with their embedding."""
        return _texts(self.spark, self.path, self.generations)

    def placed(self) -> DataFrame:
        """Id, embedding, code, top and cell of all pairs."""
        folders = [f"{self.path}/rows/gen={g}" for g in self.generations]
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(*folders).select(KEY, "embedding", "code", "top", "cell")

    def rows(self) -> DataFrame:
        """All pairs of the index with top, cell, embedding and code."""
        return self.texts().join(self.placed().drop("embedding"), KEY)

    def rows_of(self, cells: list[int]) -> DataFrame:
        """The placed rows of some cells; the filter prunes folders and row groups."""
        tops = sorted({int(self.cells.top_of[c]) for c in cells})
        return self.placed().where(F.col("top").isin(tops) & F.col("cell").isin(sorted(cells)))

    # --- searching

    def embed(self, df: DataFrame, col: str = "customer_text") -> DataFrame:
        """The rows with a vector of the index's own text model."""
        if self.model is None:
            raise ValueError("this index was built from ready vectors and has no text model")
        return self.model.embed(df, col)

    def neighbours(self, queries: DataFrame, k: int = fv.TOP_K, approximate: bool = True, probes: int | None = None,
                   reranked: int = r.RERANKED, key: str = KEY) -> DataFrame:
        """query_id, corpus_id, distance, rank; queries carry their id and "embedding"."""
        q = r._vectors(queries, key)
        probes = max(1, min(probes or self.cells.probes or len(self.cells), len(self.cells)))
        placed = self._placed(q, probes) if approximate else self.placed().select(F.col(KEY).alias("id"), F.col("embedding").alias("v"), "cell", "code")
        if approximate:
            found = r.search_codes(q, placed, self.cells, k, probes, reranked)
        else:
            found = r.search_cells(q, placed, self.cells, k, None)
        return r.top_k_neighbours(found, k)

    def _placed(self, queries: DataFrame, probes: int) -> DataFrame:
        """Rows of the cells that any query looks into."""
        shared = self.spark.sparkContext.broadcast(self.cells)

        @F.pandas_udf("array<int>")
        def visited(v):
            import pandas as pd
            cells, far = shared.value.ranked(np.stack(v.to_numpy()).astype(float), probes)
            return pd.Series([c[np.isfinite(f)].astype("int32") for c, f in zip(cells, far)], dtype=object)

        wanted = queries.select(F.explode(visited("v")).alias("cell")).distinct()
        few = [w["cell"] for w in wanted.limit(MAX_LISTED_CELLS + 1).collect()]
        rows = self.placed() if len(few) > MAX_LISTED_CELLS else self.rows_of(few)
        return rows.select(F.col(KEY).alias("id"), F.col("embedding").alias("v"), "cell", "code")

    def find_precedents(self, queries: DataFrame, k: int = fv.TOP_K, key: str = KEY, approximate: bool = True,
                        fields: Sequence[str] = r.PRECEDENT_FIELDS, **options) -> DataFrame:
        """query_id, precedents of queries that carry their text; a ready "embedding" is used as it is.  fields: see attach_precedents."""
        ready = queries if "embedding" in queries.columns else self.embed(queries)
        return r.attach_precedents(self.neighbours(ready.select(key, "embedding"), k, approximate, key=key, **options), self.texts(), KEY, fields)

    # --- growing

    def append(self, pairs: DataFrame) -> RetrievalIndex:
        """The index with further pairs, embedded by its own model unless they carry "embedding"; ids it has already are left out."""
        ready = pairs if "embedding" in pairs.columns else self.embed(pairs)
        generation = _write_texts(ready, self.path, self.placed().select(KEY))
        placed = materialize(assign(_vectors(_texts(self.spark, self.path, [generation])), self.cells), "appended")
        _write_rows(placed, self.path, generation)
        grown = with_extent(self.cells, placed)
        cells = replace(self.cells, rows=self.cells.rows + grown.rows, radius=np.maximum(self.cells.radius, grown.radius))
        return replace(self, generations=(*self.generations, generation), cells=cells)._publish()

    def _publish(self) -> RetrievalIndex:
        rows = [("parts", 0, 0, 0.0, self.parts), ("probes", 0, self.cells.probes, 0.0, "")]
        rows += [("generation", i, 0, 0.0, g) for i, g in enumerate(self.generations)]
        rows += [("cell", i, int(n), float(x), "") for i, (n, x) in enumerate(zip(self.cells.rows, self.cells.radius))]
        manifests.publish(self.spark, f"{self.path}/manifest", rows, "what string, at int, n bigint, radius double, name string")
        return self


def _tidy(pairs: DataFrame) -> DataFrame:
    """The index's columns; rows without id or vector stay out."""
    return pairs.where(F.col(KEY).isNotNull() & F.col("embedding").isNotNull()).select(
        KEY, "customer_text", "apple_reply_text", F.coalesce("is_dm_redirect", F.lit(False)).alias("is_dm_redirect"),
        "thread_depth" if "thread_depth" in pairs.columns else F.lit(None).cast("bigint").alias("thread_depth"), "embedding")


def _texts(spark: SparkSession, path: str, generations: Sequence[str]) -> DataFrame:
    # an index of an earlier version holds its texts with the rows
    folders = [new if manifests.exists(spark, new := f"{path}/texts/gen={g}") else f"{path}/rows/gen={g}" for g in generations]
    return spark.read.parquet(*folders).select(*PAYLOAD, "embedding")


def _vectors(texts: DataFrame) -> DataFrame:
    return texts.select(F.col(KEY).cast("bigint").alias("id"), F.col("embedding").alias("v"))


def _write_texts(ready: DataFrame, path: str, held: DataFrame | None = None) -> str:
    """A generation of pairs: of rows that repeat an id the first by text, and none of an id that is held.

    The rows are written as they come, and only ids are counted.  If some have to go, the others are written
    anew, and the first folder stays without a manifest that names it; only texts of repeated ids are sorted.
    """
    spark, generation, rows = ready.sparkSession, uuid.uuid4().hex, _tidy(ready)
    rows.write.option("compression", "zstd").parquet(f"{path}/texts/gen={generation}")
    raw = spark.read.schema(rows.schema).parquet(f"{path}/texts/gen={generation}")
    ids = raw.groupBy(KEY).count()
    known = ids.withColumn("held", F.lit(False)) if held is None else ids.join(
        held.withColumn("held", F.lit(True)), KEY, "left").withColumn("held", F.coalesce("held", F.lit(False)))
    odd = materialize(known.where("held OR count > 1").select(KEY, "held"), "odd")
    if odd.isEmpty():
        return generation
    several = raw.join(odd.where("NOT held").select(KEY), KEY, "left_semi")
    first = r.first_per_key(several, [F.col(KEY)], [F.col(c) for c in raw.columns[1:]])
    generation = uuid.uuid4().hex
    raw.join(odd.select(KEY), KEY, "left_anti").unionByName(first).write.option("compression", "zstd").parquet(f"{path}/texts/gen={generation}")
    return generation


def _write_rows(placed: DataFrame, path: str, generation: str) -> None:
    ranged = placed.repartitionByRange("top", "cell", F.xxhash64("id")).sortWithinPartitions("top", "cell")
    rows = ranged.select(F.col("id").alias(KEY), F.col("v").alias("embedding"), "top", "cell", "code")
    rows.write.partitionBy("top").parquet(f"{path}/rows/gen={generation}")


def build_retrieval_table(pairs: DataFrame, embedder: Embedder | TextModel, path: str, excluded: DataFrame | None = None,
                          n_cells: int | None = None, k: int = fv.TOP_K, recall: float = r.RECALL) -> RetrievalIndex:
    """Build the index from scratch, without the excluded (golden) ids, and publish it as the newest state of path.

    embedder: a text model, which is stored with the index, or a function that adds
    "embedding".  The cells are trained on a sample of the pairs, and the number of cells a
    search looks into is measured on another, against an exact scan.
    """
    spark = pairs.sparkSession
    kept = pairs if excluded is None else pairs.join(excluded, KEY, "left_anti")
    model = embedder if isinstance(embedder, TextModel) else None
    generation = _write_texts(model.embed(kept, "customer_text") if model else embedder(kept), path)
    vectors = _vectors(_texts(spark, path, [generation]))
    placed, cells = r.trained_cells(vectors, n_cells)
    cells = r.measured_probes(placed, cells, vectors, k, recall)
    parts = uuid.uuid4().hex
    base = f"{path}/parts/{parts}"
    centers = [("top", 0, i, v.tolist()) for i, v in enumerate(cells.tops)]
    centers += [("cell", int(t), i, v.tolist()) for i, (t, v) in enumerate(zip(cells.top_of, cells.centers))]
    _write_small(spark, centers, "level string, top int, at int, v array<double>", f"{base}/cells")
    words = [(s, i, v.tolist()) for s, book in enumerate(cells.codebooks) for i, v in enumerate(book)]
    _write_small(spark, words, "slice int, at int, v array<double>", f"{base}/codes")
    if model:
        model.save(spark, f"{base}/model")
    _write_rows(placed, path, generation)
    return RetrievalIndex(spark, path, parts, (generation,), cells, model)._publish()


def open_index(spark: SparkSession, path: str, number: int | None = None) -> RetrievalIndex:
    """The newest state of the index, or that of a manifest's number.  Centres, codebooks and one number a cell are read to the driver."""
    manifest = manifests.read(spark, f"{path}/manifest", number)
    if manifest is None:
        raise FileNotFoundError(f"no complete manifest under {path}")
    listed: dict[str, list] = {}
    for row in manifest.collect():
        listed.setdefault(row["what"], []).append(row)
    of = lambda what: sorted(listed.get(what, []), key=lambda x: x["at"])
    parts = of("parts")[0]["name"]
    base = f"{path}/parts/{parts}"
    centers: dict[str, list] = {}
    for row in spark.read.parquet(f"{base}/cells").collect():
        centers.setdefault(row["level"], []).append(row)
    tops, low = (sorted(centers[x], key=lambda c: c["at"]) for x in ("top", "cell"))
    words = sorted(spark.read.parquet(f"{base}/codes").collect(), key=lambda w: (w["slice"], w["at"]))
    cells = Cells(np.array([c["v"] for c in tops]), np.array([c["v"] for c in low]), np.array([c["top"] for c in low]),
                  np.array([c["n"] for c in of("cell")], "int64"), np.array([c["radius"] for c in of("cell")]),
                  np.array([w["v"] for w in words]).reshape(-1, CODEWORDS, SLICE), of("probes")[0]["n"])
    stored = manifests.exists(spark, f"{base}/model")
    return RetrievalIndex(spark, path, parts, tuple(g["name"] for g in of("generation")), cells, TextModel.load(spark, f"{base}/model") if stored else None)


def load_retrieval_table(spark: SparkSession, path: str) -> DataFrame:
    """All pairs of the newest state of the index, with their vectors."""
    return open_index(spark, path).texts()


def count_entries(store: DataFrame) -> DataFrame:
    return store.agg(F.count("*").alias("entries"))
