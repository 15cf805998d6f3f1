"""Embedding and nearest-neighbour retrieval.

Neither path is a cross join.  A small query side is broadcast, after its size
was counted, and each task scans its own part of the corpus.  Otherwise the
corpus is cut into blocks of bounded size, every query goes to the blocks that
can hold one of its neighbours, and block and queries meet by an equi-join on
the block.  Only k candidates per query leave a task; payload columns are
fetched for the final neighbours alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import truncate_text
from caseloom.operators import cells as trained
from caseloom.operators.joins import join_lookup
from caseloom.operators.sampling import first_per_key, fixed_size_sample, sample_order
from caseloom.session import materialize

MAX_BROADCAST_FLOATS = 4_000_000  # 32 MB of query vectors in a task
BLOCK_ROWS = 32_768  # corpus rows of a block
CHUNK_ROWS = 32_768  # queries that meet a block at once
MAX_WIDTH, WIDE_FLOATS = 4, 1 << 24  # blocks and chunks grow up to so many times, and to so many numbers, while every core has a pair of them
CODED_CHUNKS = 4  # a block of codes, which are 16 times shorter than vectors, has the rows of so many chunks
TILE, RUN, RUNS = 1_024, 64, 4  # rows multiplied at once; of a run of distances the least is looked at first; runs for each neighbour at least
MOST_COLUMNS = 0.8  # a larger share of a block costs more to pick than the rest to look at
DISTANCES_AT_ONCE = 4_000_000  # of queries to centres, in a task
RECALL, MEASURED_QUERIES = 0.93, 200  # share of neighbours whose cell is looked into, measured on so many queries
RERANKED = 64  # candidates a query, by their codes, whose true distances are computed
PRECEDENT_FIELDS = ("customer_text", "apple_reply_text", "is_dm_redirect")

_FOUND = "query_id bigint, corpus_id bigint, distance double"


def _vectors(df: DataFrame, key: str) -> DataFrame:
    """id, v: one row per id that has a vector, the least of its vectors; written once, as it feeds several steps."""
    rows = df.where(F.col("embedding").isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col("embedding").alias("v"))
    return materialize(rows.groupBy("id").agg(F.min("v").alias("v")), "vectors")


def _kernels(k: int):
    """The functions tasks run, as closures: executors need no copy of this package."""

    def matrix(column) -> np.ndarray:
        """A list column as a 2-d array of its own numbers, without going through Python objects."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        flat = column.flatten().to_numpy(zero_copy_only=False)
        if len(np.unique(np.diff(column.offsets.to_numpy()))) > 1:
            raise ValueError("vectors of different lengths cannot be compared")
        return (flat if flat.dtype == np.float32 else flat.astype("float64")).reshape(len(column), -1)

    def kept(ids: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Places of the rows by id; of equal vectors only the k lowest ids can matter.

        Equal rows have equal digests, so only rows whose digest occurs more than k times are compared.
        """
        order = np.argsort(ids, kind="stable")
        bits = np.ascontiguousarray(c).view(np.uint32)
        odd = np.random.default_rng(0).integers(1, 1 << 63, bits.shape[1], np.uint64) * 2 + 1
        digest = np.concatenate([(bits[low: low + 4096] * odd).sum(1) for low in range(0, max(len(c), 1), 4096)])
        _, group, n = np.unique(digest[order], return_inverse=True, return_counts=True)
        many = np.flatnonzero(n[group] > k)
        if not len(many):
            return order
        _, first = np.unique(c[order[many]], axis=0, return_inverse=True)
        groups = pd.Series(first.ravel()).groupby(first.ravel()).cumcount().to_numpy()
        return np.delete(order, many[groups >= k])

    def near_cut(tiles, n: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all finite distances up to the k-th least of their query, and a slack beyond.

        tiles: first row and distances (rows x queries, infinite ones at the end), while they are in
        the cache.  The k-th least of the minima of runs of rows is no less than the k-th least distance,
        so only the runs whose minimum lies below it are looked at again; it falls from tile to tile.
        """
        best, found = np.full((k, n), np.inf), []
        for low, d in tiles:
            run = min(RUN, max(4, 1 << max(0, ((low + len(d)) // (RUNS * k)).bit_length() - 1)))
            runs = d.reshape(-1, run, n)
            least = runs.min(axis=1)
            best = np.partition(np.concatenate([best, least]), k - 1, axis=0)[:k]
            cut = (best[k - 1] + slack).astype(d.dtype)
            at, query = np.nonzero((least <= cut) & (least < np.inf))
            inside = runs[at, :, query]
            of_run, place = np.nonzero((inside <= cut[query][:, None]) & (inside < np.inf))
            found.append((query[of_run], low + at[of_run] * run + place, inside[of_run, place]))
        query, row, distance = (np.concatenate(f) for f in zip(*found))
        near = distance <= cut[query]
        return query[near], row[near]

    def search(c_ids: np.ndarray, c: np.ndarray, slice_rows: int = 256):
        """A function (query ids, queries, columns, looks) to the k nearest rows of c per query, ties by the lower id.

        c: as kept().  columns: places of the rows to look at, all without; looks: of queries
        by those rows, false where a query does not look.  Distances are found in single
        precision first, around the middle of c; what may be within the cut is measured again in double.
        """
        plain = len(c) > 0 and np.isfinite(c).all() and np.abs(c).max(initial=0.0) < 1e15
        middle = c.mean(0, dtype=np.float64) if plain else np.zeros(c.shape[1])
        norms = np.concatenate([((c[low: low + 4096] - middle) ** 2).sum(1) for low in range(0, max(len(c), 1), 4096)])
        reach = math.sqrt(norms.max(initial=0.0)) if plain else 0.0
        sides: dict = {}

        def side(kind) -> np.ndarray:
            if kind not in sides:
                sides[kind] = np.empty((len(c), c.shape[1] + 1), kind)
                for low in range(0, len(c), 4096):
                    sides[kind][low: low + 4096, :-1] = -2.0 * (c[low: low + 4096] - middle)
                sides[kind][:, -1] = norms
            return sides[kind]

        def tiles(left: np.ndarray, columns, looks):
            """First row, and distances of rows to queries, less the squares of the queries: of some rows after the others."""
            right, n, room = side(left.dtype.type), len(c) if columns is None else len(columns), np.empty((TILE, len(left)), left.dtype)
            for low in range(0, n, TILE):
                some = right[low: low + TILE] if columns is None else right[columns[low: low + TILE]]
                d = np.matmul(some, left.T, out=room[: len(some)])
                if looks is not None:
                    d[~looks[:, low: low + TILE].T] = np.inf
                if not plain:
                    d[np.isnan(d)] = np.inf
                whole = -(-len(some) // RUN) * RUN
                room[len(some): whole] = np.inf
                yield low, room[:whole]

        def hits(part: np.ndarray, columns, looks, kind) -> tuple[np.ndarray, np.ndarray]:
            x = part - middle
            left = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(kind)
            slack = np.zeros(len(x)) if not plain else (x.shape[1] + 8) * np.finfo(kind).eps * (np.sqrt((x * x).sum(1)) + reach) ** 2
            if not (len(c) if columns is None else len(columns)):
                return np.empty(0, "int64"), np.empty(0, "int64")
            qi, ci = near_cut(tiles(left, columns, looks), len(x), slack.astype(kind) + (0 if plain else 1e-9))
            return qi, ci if columns is None else columns[ci]

        def nearest(q_ids: np.ndarray, q: np.ndarray, columns: np.ndarray | None = None, looks=None):
            out = []
            for low in range(0, len(q), slice_rows):
                part = q[low: low + slice_rows].astype(np.float64)
                own, seen = (columns, None) if looks is None else looks(low, low + slice_rows)
                single = plain and np.abs(part).max(initial=0.0) < 1e15
                qi, ci = hits(part, own, seen, np.float32 if single else np.float64)
                if single and len(qi) > len(part) * (32 * k + 256):  # too close together for single precision
                    qi, ci = hits(part, own, seen, np.float64)
                exact = ((part[qi] - c[ci]) ** 2).sum(1)
                rank = np.lexsort((c_ids[ci], exact, qi))
                qi, ci, exact = qi[rank], ci[rank], exact[rank]
                first = np.searchsorted(qi, qi, side="left")
                keep = np.arange(len(qi)) - first < k
                out.append((q_ids[low + qi[keep]], c_ids[ci[keep]], exact[keep]))
            return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0)]

        return nearest

    return matrix, kept, search


def _scan_with_broadcast(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Each task keeps its k best per query while it reads its part of the corpus."""
    matrix, kept, search = _kernels(k)
    table = queries.toArrow()  # counted before: at most MAX_BROADCAST_FLOATS
    shared = corpus.sparkSession.sparkContext.broadcast(
        (table["id"].to_numpy(), matrix(table["v"]) if table.num_rows else None))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = shared.value
        best = None
        for batch in batches:
            if q is None or batch.num_rows == 0:
                continue
            ids, c = batch.column("id").to_numpy(), matrix(batch.column("v"))
            at = kept(ids, c)
            found = pd.DataFrame(dict(zip(("query_id", "corpus_id", "distance"), search(ids[at], c[at])(q_ids, q))))
            best = found if best is None else (
                pd.concat([best, found]).sort_values(["query_id", "distance", "corpus_id"])
                .groupby("query_id", sort=False).head(k))
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    return corpus.mapInArrow(scan, _FOUND)


def cell_count(n_rows: int) -> int:
    """Cells of a block each, and as many as the root of the rows once that is fewer.

    From there on cells grow with the root of the corpus too, so what a query
    compares itself with grows more slowly than the corpus at every size.
    """
    return max(1, min(-(-n_rows // BLOCK_ROWS), math.isqrt(n_rows)))


@dataclass(frozen=True)
class _Cells:
    """Centres of the corpus cells with their extent; see cell_count for their number."""

    centers: np.ndarray
    rows: np.ndarray
    radius: np.ndarray


@dataclass(frozen=True)
class _Layout:
    """Blocks of at most `size` rows: neighbouring small cells share one, a larger cell is cut into several by id hash."""

    first: np.ndarray  # of a cell: its first block
    parts: np.ndarray  # of a cell: the number of its blocks
    low: np.ndarray  # of a block: its first cell
    high: np.ndarray  # of a block: the cell after its last one

    def __len__(self) -> int:
        return len(self.low)

    def home(self):
        """UDF: the block of a row, by its cell and a hash of its id."""
        first, parts = self.first, self.parts

        @F.pandas_udf("int")
        def home(cell: pd.Series, h: pd.Series) -> pd.Series:
            at = cell.to_numpy()
            return pd.Series((first[at] + h.to_numpy() % parts[at]).astype("int32"))

        return home


def _layout(rows: np.ndarray, size: int) -> _Layout:
    first, parts, low, high, held = [], [], [], [], size + 1
    for cell, n in enumerate(rows):
        pieces = max(1, -(-int(n) // size))
        if pieces > 1 or held + n > size:
            first.append(len(low))
            low += [cell] * pieces
            high += [cell + 1] * pieces
            held = size + 1 if pieces > 1 else n
        else:
            first.append(len(low) - 1)
            high[-1], held = cell + 1, held + n
        parts.append(pieces)
    return _Layout(*(np.array(x, "int64") for x in (first, parts, low, high)))


def _nearest_cell(centers: np.ndarray):
    matrix_of = np.asarray(centers)

    @F.pandas_udf("struct<cell:int,reach:double>")
    def nearest_cell(v: pd.Series) -> pd.DataFrame:
        x = np.stack(v.to_numpy()).astype("float64")
        d = (x * x).sum(1)[:, None] + (matrix_of * matrix_of).sum(1)[None, :] - 2.0 * (x @ matrix_of.T)
        cell = d.argmin(1)
        reach = np.sqrt(((x - matrix_of[cell]) ** 2).sum(1))
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": reach})

    return nearest_cell


def _fit_cells(corpus: DataFrame, n_cells: int, dim: int, seed: int) -> tuple[DataFrame, _Cells]:
    """Cell of every corpus row.

    The centres are the vectors of the first n_cells rows of the seeded order,
    equal ones once: nothing is fitted, and any engine finds the same cells.
    """
    first = [] if n_cells == 1 else (
        fixed_size_sample(corpus, n_cells, "id", seed).orderBy(*sample_order("id", seed)).select("v").collect())
    distinct = list(dict.fromkeys(tuple(r["v"]) for r in first))
    centers = np.array(distinct, "float64") if distinct else np.zeros((1, dim))
    celled = corpus.withColumn("at", _nearest_cell(centers)(F.col("v"))).select(
        "id", "v", F.col("at.cell").alias("cell"), F.col("at.reach").alias("reach"))
    stats = celled.groupBy("cell").agg(F.count("*").alias("rows"), F.max("reach").alias("radius")).collect()
    rows, radius = np.zeros(len(centers), dtype="int64"), np.zeros(len(centers))
    for s in stats:
        rows[s["cell"]], radius[s["cell"]] = s["rows"], s["radius"]
    return celled.select("id", "v", "cell"), _Cells(centers, rows, radius)


def _visits(queries: DataFrame, cells, layout: _Layout, k: int, probes: int | None) -> DataFrame:
    """id, v, block, looks: the blocks a query has to look into, and there its cells, a bit each.

    cells: centers, rows and radius.  probes=None keeps every cell that can hold one of
    the k nearest: its nearest possible point is no farther than a radius known to
    enclose k rows.  Otherwise cells are the trained ones and rank themselves.
    """
    centers, rows, radius = cells.centers, cells.rows, cells.radius
    lengths = np.sqrt((centers * centers).sum(1))

    def cells_of(x: np.ndarray) -> np.ndarray:
        """Queries by cells: whether to look there."""
        if probes is not None:
            nearest, far = cells.ranked(x, probes)
            chosen = np.zeros((len(x), len(rows)), bool)
            np.put_along_axis(chosen, nearest, np.isfinite(far), axis=1)
            return chosen
        own = np.sqrt((x * x).sum(1))
        d = np.sqrt(np.maximum((own ** 2)[:, None] + (lengths ** 2)[None, :] - 2.0 * (x @ centers.T), 0.0))
        d[:, rows == 0] = np.inf
        far = d + radius
        # cells without rows are infinitely far, so k of the others have k rows
        some = np.argpartition(far, k - 1, axis=1)[:, :k] if k < len(rows) else np.broadcast_to(np.arange(len(rows)), far.shape)
        order = np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, axis=1), axis=1), axis=1)
        enough = (np.cumsum(rows[order], axis=1) < k).sum(axis=1)  # cells before the one that brings k rows
        last = np.take_along_axis(order, np.minimum(enough, order.shape[1] - 1)[:, None], axis=1)
        limit = np.where(enough < order.shape[1], np.take_along_axis(far, last, axis=1)[:, 0], np.inf)
        slack = 1e-6 * (1.0 + own + lengths.max())  # the matrix product rounds
        return (d - radius <= (limit + slack)[:, None]) & (rows > 0)

    @F.pandas_udf("array<binary>")
    def visit(v: pd.Series) -> pd.Series:
        out, step = [], max(1, DISTANCES_AT_ONCE // len(rows))
        for low in range(0, len(v), step):
            chosen = cells_of(np.stack(v.iloc[low:low + step].to_numpy()).astype("float64"))
            by_block = []
            for first, end in zip(layout.low, layout.high):
                part = chosen[:, first:end]
                by_block.append([bits.tobytes() if some else None for bits, some in zip(np.packbits(part, axis=1), part.any(axis=1))])
            out += [list(x) for x in zip(*by_block)]
        return pd.Series(out, dtype=object)

    # written as one row a query; exploded, a vector is repeated for every block
    looking = materialize(queries.select("id", "v", visit(F.col("v")).alias("looks")), "visits")
    return looking.select("id", "v", F.posexplode("looks").alias("block", "looks")).where(F.col("looks").isNotNull())


def _width(n_rows: int, n_queries: int, dim: int, cores: int) -> int:
    """How many times longer than BLOCK_ROWS and CHUNK_ROWS both sides are cut: what travels shrinks by as much."""
    width, pairs = 1, -(-n_rows // BLOCK_ROWS) * -(-n_queries // CHUNK_ROWS)
    while 2 * width <= MAX_WIDTH and pairs >= 4 * width * width * cores and 2 * width * max(BLOCK_ROWS, CHUNK_ROWS) * dim <= WIDE_FLOATS:
        width *= 2
    return width


def _meet_by_block(visits: DataFrame, blocked: DataFrame, blocks: int, meet, chunk_rows: int) -> DataFrame:
    """Candidates of queries (id, v, block, looks) among blocked rows (id, block, ...), by an equi-join on the block.

    A block is copied once per chunk_rows queries that visit it; blocks without visits stay at home.
    """
    counts = np.zeros(blocks, "int64")
    for r in visits.groupBy("block").count().collect():  # a number per block
        counts[r["block"]] = -(-r["count"] // chunk_rows)
    of_block = F.get(F.array(*[F.lit(int(n)) for n in counts]), F.col("block"))
    chunks = visits.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block")).withColumn("chunks", of_block).where("chunks > 0")
    left = join_lookup(blocked, chunks, "block", "inner").select(
        *blocked.columns, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    right = visits.withColumn("chunk", F.pmod(F.xxhash64("id"), of_block).cast("int"))
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(meet, _FOUND)


def _pairs_table(found) -> pa.Table:
    return pa.table(dict(zip(("query_id", "corpus_id", "distance"), found or [np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0)])))


def _looking(q: pa.Table, x: np.ndarray, centers: np.ndarray, cell: np.ndarray, strict: bool):
    """(order of the queries, function from a slice of them to the places its queries look at, and which query does).

    Queries near the same cell stand together, so that a slice looks at few cells.  Only
    where strict is the single query kept to its own cells.
    """
    width = len(centers)
    packed = np.frombuffer(b"".join(q["looks"].to_pylist()), np.uint8).reshape(len(x), -1)
    looks = np.unpackbits(packed, axis=1, count=width).astype(bool)
    if looks.all():
        return np.arange(len(x)), None
    order = np.argsort((np.where(looks, (centers * centers).sum(1) - 2.0 * (x @ centers.T), np.inf)).argmin(1), kind="stable")
    looks = looks[order]

    def of_slice(low: int, high: int):
        part = looks[low:high]
        columns = np.flatnonzero(part.any(axis=0)[cell])
        if not strict and len(columns) > MOST_COLUMNS * len(cell):
            return None, None
        seen = part[:, cell[columns]] if strict else None
        return None if len(columns) == len(cell) else columns, seen

    return order, of_slice


def search_cells(queries: DataFrame, celled: DataFrame, cells, k: int, probes: int | None) -> DataFrame:
    """Candidates by true distances in the cells a query looks into; celled: id, v, cell."""
    centers = cells.centers
    width = _width(int(cells.rows.sum()), queries.count(), centers.shape[1], queries.sparkSession.sparkContext.defaultParallelism)
    layout = _layout(cells.rows, width * BLOCK_ROWS)
    matrix, kept, search = _kernels(k)

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        if not c.num_rows or not q.num_rows:
            return _pairs_table(None)
        block = c["block"][0].as_py()
        low, high = layout.low[block], layout.high[block]
        ids, v, x = c["id"].to_numpy(), matrix(c["v"]), matrix(q["v"])
        at = kept(ids, v)
        order, looks = _looking(q, x, centers[low:high], c["cell"].to_numpy()[at] - low, probes is not None)
        return _pairs_table(search(ids[at], v[at])(q["id"].to_numpy()[order], x[order], looks=looks))

    blocked = celled.select("id", "v", "cell", layout.home()("cell", F.xxhash64("id")).alias("block"))
    return _meet_by_block(_visits(queries, cells, layout, k, probes), blocked, len(layout), meet, width * CHUNK_ROWS)


def search_codes(queries: DataFrame, placed: DataFrame, cells: trained.Cells, k: int, probes: int, reranked: int = RERANKED) -> DataFrame:
    """Candidates by codes in the nearest cells, then true distances of the best `reranked` of each query.

    placed: id, v, cell, code.  Codes alone meet the queries; vectors are fetched for the best candidates.
    """
    layout, wanted = _layout(cells.rows, CODED_CHUNKS * CHUNK_ROWS), max(reranked, k)
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    matrix, kept, search = _kernels(wanted)

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        if not c.num_rows or not q.num_rows:
            return _pairs_table(None)
        own, block = shared.value, c["block"][0].as_py()
        low, high = layout.low[block], layout.high[block]
        codes = np.frombuffer(b"".join(c["code"].to_pylist()), np.uint8).reshape(c.num_rows, -1)
        ids, cell, x = c["id"].to_numpy(), c["cell"].to_numpy(), matrix(q["v"])
        # of equal codes only the lowest ids can matter
        at = kept(ids, np.concatenate([cell[:, None], codes], axis=1))
        ids, cell, codes = ids[at], cell[at], codes[at]
        order, looks = _looking(q, x, own.centers[low:high], cell - low, True)
        # a slice holds its distances to a whole block
        nearest = search(ids, own.decode(codes, cell), max(16, DISTANCES_AT_ONCE // max(1, len(ids))))
        return _pairs_table(nearest(q["id"].to_numpy()[order], x[order], looks=looks))

    blocked = placed.select("id", "cell", "code", layout.home()("cell", F.xxhash64("id")).alias("block"))
    best = top_k_neighbours(_meet_by_block(_visits(queries, cells, layout, k, probes), blocked, len(layout), meet, CHUNK_ROWS), wanted).select("query_id", "corpus_id")
    full = (best.join(placed.select(F.col("id").alias("corpus_id"), F.col("v").alias("c")), "corpus_id")
            .join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id"))
    squares = F.zip_with("q", "c", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    return full.select("query_id", "corpus_id", F.aggregate(squares, F.lit(0.0), lambda a, b: a + b).alias("distance"))


def top_k_neighbours(found: DataFrame, k: int = fv.TOP_K) -> DataFrame:
    """k smallest distances per query with their 1-based rank, ties by id."""
    nearest_first = Window.partitionBy("query_id").orderBy("distance", "corpus_id")
    return found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)


def _none_found(df: DataFrame, k: int) -> DataFrame:
    return top_k_neighbours(df.sparkSession.createDataFrame([], _FOUND), k)


def knn_exact(queries: DataFrame, corpus: DataFrame, k: int = fv.TOP_K,
              query_key: str = "id", corpus_key: str = "id", n_cells: int | None = None,
              seed: int = fv.SAMPLE_SEED, max_broadcast_floats: int = MAX_BROADCAST_FLOATS) -> DataFrame:
    """query_id, corpus_id, distance (squared L2), rank of the k nearest corpus rows."""
    q, c = _vectors(queries, query_key), _vectors(corpus, corpus_key)
    size = q.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    dim = size["d"] or 0
    if n_cells is None and size["n"] * dim <= max_broadcast_floats:
        return top_k_neighbours(_scan_with_broadcast(q, c, k), k)
    celled, cells = _fit_cells(c, max(1, cell_count(c.count()) if n_cells is None else n_cells), dim, seed)
    return top_k_neighbours(search_cells(q, celled, cells, k, None), k)


def knn_join(left: DataFrame, right: DataFrame, k: int = fv.TOP_K, left_key: str = "id", right_key: str = "id",
             n_cells: int | None = None, seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """query_id, corpus_id, distance, rank: the k nearest right rows of every left row, exactly.

    Both sides are put into the same trained cells.  By the triangle inequality a left
    cell needs a right cell only if the nearest two points they can hold are no farther
    apart than a distance within which every left row is known to have k right rows; and
    of the rows of a needed cell a left row meets only those whose distance to the cell's
    centre differs from its own by no more than that.  See join_pairs for the pairs left.
    Cells are packed into chunks of left and blocks of right rows, and a block travels once
    per chunk that needs one of its cells.
    """
    c = _vectors(right, right_key)
    if c.isEmpty():
        return _none_found(left, k)
    q, placed, cells, extent = _both_in_cells(_vectors(left, left_key), c, n_cells, seed)
    chunks = _layout(np.array([extent[x][0] if x in extent else 0 for x in range(len(cells))]), CHUNK_ROWS)
    blocks = _layout(cells.rows, BLOCK_ROWS)
    meeting = _needed_cells(q, cells, extent, k, blocks, chunks).select("chunk", "block").distinct()
    meeting = materialize(meeting, "meeting")  # a row per chunk and block
    matrix, kept, search = _kernels(k)
    shared = q.sparkSession.sparkContext.broadcast((cells, extent))

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        if not c.num_rows or not q.num_rows:
            return _pairs_table(None)
        (cells, extent), block = shared.value, c["block"][0].as_py()
        low, high = blocks.low[block], blocks.high[block]
        ids, v = c["id"].to_numpy(), matrix(c["v"])
        at = kept(ids, v)
        cell, reach = c["cell"].to_numpy()[at] - low, c["reach"].to_numpy()[at]
        nearest = search(ids[at], v[at])
        q_ids, x, own_of, found = q["id"].to_numpy(), matrix(q["v"]).astype("float64"), q["cell"].to_numpy(), []
        for own in np.unique(own_of):
            mine = np.flatnonzero(own_of == own)
            to, limit = _bound(cells, extent[own][1], own, k)
            # rows in rings around each cell's centre
            away = np.sqrt(trained.squared(x[mine], cells.centers[low:high]))
            slack = 1e-6 * (1.0 + away.max(axis=0) + cells.radius[low:high])
            inner, outer = away.min(axis=0) - limit - slack, away.max(axis=0) + limit + slack
            columns = np.flatnonzero(to[low:high][cell] & (reach >= inner[cell]) & (reach <= outer[cell]))
            if len(columns):
                found.append(nearest(q_ids[mine], x[mine], None if len(columns) == len(cell) else columns))
        return _pairs_table([np.concatenate(f) for f in zip(*found)] if found else None)

    asked = q.select("id", "v", "cell", chunks.home()("cell", F.xxhash64("id")).alias("chunk")).join(meeting, "chunk")
    held = placed.select("id", "v", "cell", "reach", blocks.home()("cell", F.xxhash64("id")).alias("block")).join(meeting, "block")
    found = held.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(meet, _FOUND)
    return top_k_neighbours(found, k)


def join_pairs(left: DataFrame, right: DataFrame, k: int = fv.TOP_K, left_key: str = "id", right_key: str = "id",
               n_cells: int | None = None, seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """One row: pairs of rows in cells that meet in knn_join, and all pairs of the two sides."""
    q, _, cells, extent = _both_in_cells(_vectors(left, left_key), _vectors(right, right_key), n_cells, seed)
    one = np.zeros(len(cells), "int64")
    needed = _needed_cells(q, cells, extent, k, _Layout(one, one + 1, one, one), _Layout(one, one + 1, one, one)).select("pairs", "own").distinct()
    met = needed.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("met"))
    return met.withColumn("all_pairs", F.lit(int(sum(n for n, _ in extent.values()) * cells.rows.sum())))


def _both_in_cells(q: DataFrame, c: DataFrame, n_cells: int | None, seed: int):
    """Left rows and right rows in the right side's cells, the cells, and rows and radius of every cell of the left side."""
    placed, cells = trained_cells(c, n_cells, seed, codes=False)
    q = materialize(trained.assign(q, cells).select("id", "v", "cell", "reach"), "left")
    sizes = q.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("r")).collect()  # two numbers per cell
    return q, placed, cells, {r["cell"]: (r["n"], r["r"]) for r in sizes}


def _bound(cells: trained.Cells, extent: float, own: int, k: int) -> tuple[np.ndarray, float]:
    """Whether a left cell needs each right cell, and the distance that bounds its rows' neighbours."""
    apart = np.sqrt(trained.squared(cells.centers[own: own + 1], cells.centers)[0])
    far = np.where(cells.rows > 0, apart + extent + cells.radius, np.inf)
    order = np.argsort(far, kind="stable")
    enough = int((np.cumsum(cells.rows[order]) < k).sum())
    limit = far[order[enough]] if enough < len(order) else np.inf
    return (cells.rows > 0) & (apart - extent - cells.radius <= limit + 1e-6 * (1.0 + apart)), limit


def _needed_cells(q: DataFrame, cells: trained.Cells, extent: dict, k: int, blocks: _Layout, chunks: _Layout) -> DataFrame:
    """own, chunk, block, pairs: blocks that the chunks of a left cell need; pairs of rows in the cells that meet."""
    shared = q.sparkSession.sparkContext.broadcast((cells, extent))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, extent = shared.value
        for batch in batches:
            for own in batch.column("own").to_pylist():
                to = np.flatnonzero(_bound(cells, extent[own][1], own, k)[0])
                parts = [np.arange(blocks.first[c], blocks.first[c] + blocks.parts[c]) for c in to]
                block = np.unique(np.concatenate(parts)) if parts else np.empty(0, "int64")
                mine = np.arange(chunks.first[own], chunks.first[own] + chunks.parts[own])
                n = len(block) * len(mine)
                pairs = int(extent[own][0] * cells.rows[to].sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, own, np.int32)), pa.array(np.repeat(mine, len(block)).astype(np.int32)),
                                                  pa.array(np.tile(block, len(mine)).astype(np.int32)), pa.array(np.full(n, pairs))], ["own", "chunk", "block", "pairs"])

    return q.select(F.col("cell").alias("own")).distinct().mapInArrow(needed, "own int, chunk int, block int, pairs bigint")


def trained_cells(corpus: DataFrame, n_cells: int | None = None, seed: int = fv.SAMPLE_SEED, codes: bool = True) -> tuple[DataFrame, trained.Cells]:
    """(id, v, top, cell, reach, code) of a corpus (id, v), written once, and its trained cells; by default three times the root of its rows."""
    n = corpus.count()
    cells = trained.fit_cells(corpus, max(1, min(n, n_cells or 3 * math.isqrt(n))), n, seed, codes)
    placed = materialize(trained.assign(corpus, cells), "placed")
    return placed, trained.with_extent(cells, placed)


def measured_probes(placed: DataFrame, cells: trained.Cells, asked: DataFrame, k: int, recall: float = RECALL, seed: int = fv.SAMPLE_SEED) -> trained.Cells:
    """The cells with the number of probes that reaches the recall on MEASURED_QUERIES of the asked rows (id, v), against an exact scan."""
    some = materialize(fixed_size_sample(asked, MEASURED_QUERIES, "id", seed), "measured")
    truth = top_k_neighbours(_scan_with_broadcast(some, placed.select("id", "v"), k), k)
    known = truth.join(some.select(F.col("id").alias("query_id"), "v"), "query_id").select("v", "corpus_id")
    return trained.calibrated(cells, placed, known, recall)


def knn_approx(queries: DataFrame, corpus: DataFrame, k: int = fv.TOP_K,
               query_key: str = "id", corpus_key: str = "id", n_cells: int | None = None,
               probes: int | None = None, seed: int = fv.SAMPLE_SEED, reranked: int | None = RERANKED, recall: float = RECALL) -> DataFrame:
    """As knn_exact, looking only into the nearest trained cells of each query.

    probes: cells a query looks into; by default as many as reach `recall` on a sample
    of the queries.  reranked: candidates a query, chosen by their codes, whose true
    distances are computed; None computes those of all rows of the cells.
    """
    q, c = _vectors(queries, query_key), _vectors(corpus, corpus_key)
    if c.isEmpty():
        return _none_found(q, k)
    placed, cells = trained_cells(c, n_cells, seed, codes=reranked is not None)
    if probes is None:
        cells = measured_probes(placed, cells, q, k, recall, seed)
    probes = max(1, min(probes or cells.probes, len(cells)))
    found = search_cells(q, placed, cells, k, probes) if reranked is None else search_codes(q, placed, cells, k, probes, reranked)
    return top_k_neighbours(found, k)


def attach_precedents(neighbours: DataFrame, corpus: DataFrame, key: str = "customer_tweet_id",
                      fields: Sequence[str] = PRECEDENT_FIELDS) -> DataFrame:
    """query_id, precedents: array of structs, nearest first.

    fields: columns of the corpus that a precedent has besides rank, distance and id.  A
    text goes to every query that found it, so who needs ids alone asks for no fields:
    the corpus is not read then.
    """
    if not fields:
        found = neighbours
    else:
        # an id that repeats stands for one post: one of its rows speaks for it
        columns = [F.col(c) for c in fields]
        payload = first_per_key(corpus.select(F.col(key).alias("corpus_id"), *columns), [F.col("corpus_id")], columns)
        found = neighbours.join(payload, "corpus_id")
    one = F.struct("rank", "distance", F.col("corpus_id").alias("id"), *fields).alias("p")
    return found.select("query_id", one).groupBy("query_id").agg(F.array_sort(F.collect_list("p")).alias("precedents"))


def find_precedents(queries: DataFrame, corpus: DataFrame, k: int = fv.TOP_K, key: str = "customer_tweet_id",
                    approximate: bool = False, fields: Sequence[str] = PRECEDENT_FIELDS, **options) -> DataFrame:
    """query_id, precedents for every query that has any."""
    search = knn_approx if approximate else knn_exact
    found = search(queries.select(key, "embedding"), corpus, k, query_key=key, corpus_key=key, **options)
    return attach_precedents(found, corpus, key, fields)


def join_precedents(queries: DataFrame, found: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """The query rows with their precedents; an empty array where none exist."""
    joined = queries.join(found.withColumnRenamed("query_id", key), key, "left")
    nothing = F.array().cast(found.schema["precedents"].dataType)
    return joined.withColumn("precedents", F.coalesce("precedents", nothing))


def retrieve_precedent(queries: DataFrame, corpus: DataFrame, k: int = fv.TOP_K,
                       key: str = "customer_tweet_id", approximate: bool = False, **options) -> DataFrame:
    return join_precedents(queries, find_precedents(queries, corpus, k, key, approximate, **options), key)


def retrieval_probe(queries: DataFrame, corpus: DataFrame, k: int = fv.TOP_K,
                    key: str = "customer_tweet_id") -> DataFrame:
    """A readable line per neighbour: rank, distance, flag, clipped texts."""
    found = knn_exact(queries, corpus, k, query_key=key, corpus_key=key)
    payload = corpus.select(
        F.col(key).alias("corpus_id"), "is_dm_redirect",
        truncate_text(F.col("customer_text"), fv.PROBE_QUERY_CLIP).alias("matched_text"),
        truncate_text(F.col("apple_reply_text"), fv.EXAMPLE_CLIP).alias("reply_text"))
    payload = first_per_key(payload, [F.col("corpus_id")], [F.col("matched_text"), F.col("reply_text"), F.col("is_dm_redirect")])
    return found.join(payload, "corpus_id").select(
        "query_id", "rank", "distance", "is_dm_redirect", "matched_text", "reply_text")
