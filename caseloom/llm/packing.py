"""Token windows of mixed sources by deficit round-robin.

Method.  Each source is a queue of tokens.  A window of 2048 tokens is filled in
rounds: every queue's deficit grows by its quantum, 2048 times its target
proportion, the queue sends the whole tokens its deficit holds, and the rest
is carried to the next window.  What rounding leaves of a window goes to the
next queue in line, so windows are always full and a queue is never more than
one token off its proportion.  Deficits are a closed function of the window's
number, so a task that starts at any window starts with the carried deficits:
that is how they cross partitions.

Documents are cut where a window ends, so only the last window can have padding.

Stages: texts are tokenised once, where they are read; a row remembers its start
in the queue as seen by its task.  The sums of (queue, task) give each task's
start.  Pieces are then cut row by row.  Tokens are never moved between tasks.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.operators.joins import join_lookup
from caseloom.session import materialize

WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k"  # the ids of byte_bpe_50k.json; its ranks file gives the same ids several times faster
SPECIAL = {"<|endoftext|>": 50256}
MAX_QUEUES = 512  # sources beyond that, the smallest, are one queue: a window has no token for each of them
MAX_BROADCAST_STARTS = 200_000

NULL_SOURCE = "\u0000none"


class Encoder:
    """Token ids of a text, then the end id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(self, text: str | None) -> np.ndarray:
        return np.array([*self.encoding.encode(text or "", allowed_special="all"), END_ID], np.uint32)


def _tokenise(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path or public_tokenizers.path(f"{VOCABULARY}.tiktoken"))
        task, ahead = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                queues = [NULL_SOURCE if s is None else s for s in part.column("source").to_pylist()]
                ids = [encoder.ids(t) for t in part.column("text").to_pylist()]
                starts = []
                for q, x in zip(queues, ids):
                    starts.append(ahead[q])
                    ahead[q] += len(x)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(queues), pa.array([task] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype(np.uint16).tobytes() for x in ids], pa.binary())],
                    ["doc_id", "source", "task", "start", "tokens", "ids"])

    return run


class Schedule:
    """Which tokens of a queue stand where in the packed stream.

    A phase is a stretch of the stream over which the active queues keep their
    proportions; it ends when one of them is empty.  Before position p of a phase
    of n tokens, the queues up to j have sent p * sums[j] // n tokens together.
    """

    def __init__(self, sizes: list[int], weights: list[float] | None = None):
        left, place = list(sizes), 0
        self.phases = []  # (first position, length, sums over the queues, tokens of each queue sent before)
        sent = [0] * len(sizes)
        while any(left):
            if weights is None:
                take = list(left)
            else:
                active = [j for j, n in enumerate(left) if n]
                w = {j: max(weights[j], 1e-9) for j in active}
                first = min(active, key=lambda j: left[j] / w[j])
                take = [min(left[j], int(left[first] * w[j] / w[first])) if left[j] else 0 for j in range(len(left))]
                take[first] = left[first]
            sums = [0]
            for n in take:
                sums.append(sums[-1] + n)
            self.phases.append((place, sums[-1], sums, list(sent)))
            place += sums[-1]
            sent = [a + b for a, b in zip(sent, take)]
            left = [a - b for a, b in zip(left, take)]
        self.total = place

    def pieces(self, j: int, start: int, length: int, window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
        """(offset in the document, length, position in the stream) of a document's pieces; start: its place in queue j."""
        done = 0
        i = max(bisect_right([p[3][j] for p in self.phases], start) - 1, 0)
        while done < length:
            first, n, sums, sent = self.phases[i]
            below, upto = sums[j], sums[j + 1]
            own, at = upto - below, start + done - sent[j]
            if at >= own:
                i += 1
                continue
            # the window whose share of queue j holds token `at`: a guess, then a step or two
            k = (first + at * n // own) // window
            while self._sent(first, n, below, upto, k, window) > at:
                k -= 1
            while self._sent(first, n, below, upto, k + 1, window) <= at:
                k += 1
            low = self._sent(first, n, below, upto, k, window)
            high = self._sent(first, n, below, upto, k + 1, window)
            p = min(max(k * window - first, 0), n)
            end = min(max((k + 1) * window - first, 0), n)
            # queues before j stand first in the window
            ahead = (end * below // n) - (p * below // n)
            size = min(high - at, length - done)
            yield done, size, first + p + ahead + (at - low)
            done += size

    @staticmethod
    def _sent(first: int, n: int, below: int, upto: int, k: int, window: int) -> int:
        p = min(max(k * window - first, 0), n)
        return p * upto // n - p * below // n


def _cut(schedule: Schedule, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                row, start, length, crc, place = [], [], [], [], []
                columns = (part.column(c).to_pylist() for c in ("queue", "start", "ahead", "tokens", "ids"))
                for r, (j, own, ahead, n, ids) in enumerate(zip(*columns)):
                    data = memoryview(np.frombuffer(ids, np.uint16).astype("<u4").tobytes())
                    for a, size, position in schedule.pieces(j, own + ahead, n, window):
                        row.append(r)
                        start.append(a)
                        length.append(size)
                        crc.append(zlib.crc32(data[4 * a: 4 * (a + size)]))
                        place.append(position)
                row = pa.array(row, pa.int32())
                place = np.array(place, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(row), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    part.column("tokens").take(row), pa.array(place // window), pa.array(place % window), part.column("source").take(row)], names)

    return run


def pack_windows(docs: DataFrame, weights: dict[str | None, float] | None = None, window: int = WINDOW,
                 ranks_path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source) per piece; every token is in one piece.

    weights: target proportions by source, as long as a source lasts; by default
    the sources' own shares of all tokens, which all windows then keep to the end.
    A source that is not named weighs 1.  Null texts are empty, an empty document
    is its end id; null sources are one queue; rows that repeat an id are packed
    row by row; other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    tokens = materialize(read.mapInArrow(_tokenise(ranks_path), f"doc_id {kind}, source string, task int, start bigint, tokens bigint, ids binary"), "tokens")
    sums = materialize(tokens.groupBy("source", "task").agg(F.sum("tokens").alias("n")), "sums")
    sizes = sums.groupBy("source").agg(F.sum("n").alias("n"))
    named = {NULL_SOURCE if s is None else s for s in (weights or {})}
    top = sizes.orderBy(F.desc(F.col("source").isin(list(named))), F.desc("n"), "source").limit(MAX_QUEUES).collect()
    queues = {r["source"]: j for j, r in enumerate(sorted(top, key=lambda r: r["source"]))}
    rest = len(queues)
    total = sums.agg(F.sum("n")).first()[0] or 0
    lengths = [0] * (rest + 1)
    for r in top:
        lengths[queues[r["source"]]] = r["n"]
    lengths[rest] = total - sum(lengths)
    by_queue = None
    if weights is not None:
        by_name = {NULL_SOURCE if s is None else s: w for s, w in weights.items()}
        by_queue = [by_name.get(s, 1.0) for s in sorted(queues)] + [1.0]
    schedule = Schedule(lengths, by_queue)
    number = F.lit(rest)
    for s, j in queues.items():
        number = F.when(F.col("source") == s, j).otherwise(number)
    number = number.cast("int")
    # tokens of a queue in the tasks before; a queue's window holds a row per task (and per small source)
    before = Window.partitionBy("queue").orderBy("task", "source").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("queue", number).select("source", "task", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    starts = materialize(starts, "starts")
    if starts.count() <= MAX_BROADCAST_STARTS:
        placed = tokens.join(F.broadcast(starts), ["source", "task"])
    else:
        key = F.concat_ws("|", F.col("task").cast("string"), "source").alias("place")
        placed = join_lookup(tokens.select("*", key), starts.select(key, "queue", "ahead"), "place", "inner")
    rows = placed.select("doc_id", "source", "queue", "start", "ahead", "tokens", "ids")
    return rows.mapInArrow(_cut(schedule, window), f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string")
