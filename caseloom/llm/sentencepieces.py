"""SentencePiece encoding and decoding of merge-type vocabularies.

Method.  A text is normalised, then starts as a row of single characters.  All
adjacent pairs that together are a piece stand on an agenda, ordered by the
piece's score and then by place; the best pair is merged, the pairs it forms
with its neighbours join the agenda, pairs whose halves have changed since are
passed over, and encoding ends when the agenda is empty.  Characters that are no
piece become their UTF-8 bytes.

A merge can never span two characters that stand side by side in no piece.
Texts are therefore cut there first, and a worker merges a stretch that comes
again (most words do) only once; its memory of stretches forgets what was not met for long.

In every Arrow batch the sentencepiece library encodes the stretches that were
merged there and decodes the ids of every whole text; the column `agrees` says
whether it has the same ids and the same text.  The rows always come from the
agenda.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
SPACE = "▁"  # stands for a blank inside pieces
BPE_TYPE = 2
STRETCHES_KEPT = 600_000  # in a worker's memory
PLACE_BITS = 40
PLACES = (1 << PLACE_BITS) - 1
SYMBOL_BITS = 24
SYMBOLS = (1 << SYMBOL_BITS) - 1
NO_PAIR = 1 << 62
OTHER = 1 << 22  # numbers of symbols that are no piece start here
ROWS_AT_ONCE, CHARS_AT_ONCE = 8_192, 1 << 20  # bound what a Python worker holds
LONG_STRETCH = 48  # characters; longer ones are cut further and not remembered


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised protocol buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at: at + size], at + size
        yield tag >> 3, value


class Codec:
    """A merge-type vocabulary: ids of a text, text of ids.

    Raises ValueError for other model types and for pieces that users defined or marked as unused.
    """

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        top = list(_fields(model))
        trainer = dict(_fields(next((v for n, v in top if n == 2), b"")))
        normaliser = dict(_fields(next((v for n, v in top if n == 3), b"")))
        types = [dict(_fields(v)).get(3, 1) for n, v in top if n == 1]
        if trainer.get(3, 1) != BPE_TYPE or {4, 5} & set(types):
            raise ValueError("only merge-type vocabularies without user-defined or unused pieces")
        self.prefixed = bool(normaliser.get(3, 1)) or bool(normaliser.get(4, 1))
        self.trimmed = bool(normaliser.get(4, 1))
        self.pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        plain = [i for i, kind in enumerate(types) if kind == 1]
        self.ids = {self.pieces[i]: i for i in plain}
        order = {score: k for k, score in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        self.rank = {self.pieces[i]: order[lib.get_score(i)] for i in plain}  # equal scores, equal ranks
        self.unknown = lib.unk_id()
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i, kind in enumerate(types) if kind == 6}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        self.control = {i for i, kind in enumerate(types) if kind == 3}
        # what stands for an id in a text; bytes of longer characters as lone surrogates until they are joined
        self.surface = [p.replace(SPACE, " ") for p in self.pieces]
        for i, b in self.byte_of.items():
            self.surface[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.plain_text = {*plain, *self.byte_of}
        # numbers of symbols: ids of pieces, other characters by their code points
        every = {**self.ids, **{c: OTHER + ord(c) for c in {c for p in self.ids for c in p} - set(self.ids)}}
        self.symbol = np.arange(OTHER, OTHER + 0x110000, dtype=np.int64)
        for c, i in every.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        pairs = {}  # of two symbols: rank and number of the piece
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = every.get(p[:k]), every.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << SYMBOL_BITS | b] = self.rank[p] << SYMBOL_BITS | i
        self.pair_keys, self.pair_values = _table(pairs)
        self.side_by_side = {p[i: i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(x[0] != SPACE and x[1] == SPACE for x in self.side_by_side):
            self.alone, self.cut = "", re.compile(r".+", re.S)
        else:
            self.alone = alone = "".join(c for c in "\n\r\t" if not any(c in x for x in self.side_by_side))  # such a character merges with nothing
            self.cut = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|[{alone}]" if alone else ""))
        self.number = [str(i) for i in range(len(self.pieces))]
        self.known: dict[str, tuple] = {}  # tuples of numbers: nothing the collector has to walk
        self.older: dict[str, tuple] = {}
        self.wrong: set[str] = set()  # stretches for which the library has other ids

    def _pairs_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and number of the piece that two symbols make; NO_PAIR where they make none or are none."""
        key = np.where((left < 0) | (right < 0), -1, left << SYMBOL_BITS | right).ravel()
        size = len(self.pair_keys) - 1
        at, out, open_ = _slot(key) & size, np.full(len(key), NO_PAIR), np.flatnonzero(key >= 0)
        while len(open_):
            there = self.pair_keys[at[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.pair_values[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
            at[open_] = (at[open_] + 1) & size
        return out.reshape(left.shape)

    def _merge_many(self, stretches: list[str]) -> list[tuple[int, ...]]:
        """Symbols of many stretches: a row of the matrix is a stretch's agenda, and a round merges every row's best pair."""
        lengths = np.array([len(s) for s in stretches])
        width = int(lengths.max())
        columns = np.arange(width)
        symbols = np.full((len(stretches), width), -1, np.int64)
        symbols[columns < lengths[:, None]] = self.symbol[np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)]
        agenda = np.full(symbols.shape, NO_PAIR)
        agenda[:, :-1] = self._pairs_of(symbols[:, :-1], symbols[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(stretches)
        rows = np.arange(len(stretches))
        while len(rows):
            live = agenda.min(axis=1) < NO_PAIR
            if not live.all():
                for r, found in zip(rows[~live].tolist(), symbols[~live].tolist()):
                    out[r] = tuple(found[: found.index(-1)] if found[-1] < 0 else found)
                rows, symbols, agenda = rows[live], symbols[live], agenda[live]
                if not len(rows):
                    break
            at = (agenda >> SYMBOL_BITS).argmin(axis=1)  # the first of the best rank
            every = np.arange(len(rows))
            merged = agenda[every, at] & SYMBOLS
            # the pair's right half leaves the row, and its place on the agenda with it
            symbols = np.take_along_axis(np.pad(symbols, ((0, 0), (0, 1)), constant_values=-1), columns + (columns > at[:, None]), axis=1)
            agenda = np.take_along_axis(np.pad(agenda, ((0, 0), (0, 1)), constant_values=NO_PAIR), columns + (columns >= at[:, None]), axis=1)
            symbols[every, at] = merged
            after = np.where(at + 1 < width, symbols[every, np.minimum(at + 1, width - 1)], -1)
            agenda[every, at] = self._pairs_of(merged, after)
            inner = at > 0
            agenda[every[inner], at[inner] - 1] = self._pairs_of(symbols[every[inner], at[inner] - 1], merged[inner])
        return out

    def _merge_long(self, stretch: str) -> list[str]:
        """The agenda as a heap of numbers of rank and left end."""
        parts, n, rank = list(stretch), len(stretch), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [rank[p] << PLACE_BITS | i for i, p in enumerate(map(add, parts, parts[1:])) if p in rank]
        heapify(agenda)
        while agenda:
            best = heappop(agenda)
            left = best & PLACES
            right = after[left]
            if right >= n:
                continue
            merged = parts[left] + parts[right]
            if not parts[left] or rank.get(merged) != best >> PLACE_BITS:
                continue
            parts[left], parts[right] = merged, ""
            after[left] = beyond = after[right]
            if beyond < n:
                before[beyond] = left
                if (p := merged + parts[beyond]) in rank:
                    heappush(agenda, rank[p] << PLACE_BITS | left)
            ahead = before[left]
            if ahead >= 0 and (p := parts[ahead] + merged) in rank:
                heappush(agenda, rank[p] << PLACE_BITS | ahead)
        return [p for p in parts if p]

    def _ids_of(self, stretch: str) -> tuple[int, ...]:
        return tuple(x for p in self._merge_long(stretch) for x in self._ids_of_piece(p))

    def _ids_of_symbols(self, symbols: tuple[int, ...]) -> tuple[int, ...]:
        if max(symbols) < OTHER:
            return symbols
        return tuple(x for i in symbols for x in ((i,) if i < OTHER else self._ids_of_piece(chr(i - OTHER))))

    def _ids_of_piece(self, piece: str) -> tuple[int, ...]:
        found = self.ids.get(piece)
        if found is not None:
            return (found,)
        return tuple(map(self.byte_ids.get, piece.encode())) if self.byte_ids else (self.unknown,)

    def _cuts(self, stretch: str) -> Iterator[str]:
        """A long stretch, cut between characters that are side by side in no piece."""
        low = 0
        for i in range(1, len(stretch)):
            if stretch[i - 1: i + 1] not in self.side_by_side:
                yield stretch[low: i]
                low = i
        yield stretch[low:]

    def _learn(self, stretches: set[str]) -> None:
        """Ids of stretches, from the older half of the memory or by merging; merged ones are checked."""
        merged = []
        for stretch in stretches:
            ids = self.older.get(stretch)
            if ids is None:
                merged.append(stretch)
            else:
                self.known[stretch] = ids
        merged.sort(key=len)  # rows of a matrix are of about one length
        short = bisect_right(merged, LONG_STRETCH, key=len)
        for low in range(0, short, ROWS_AT_ONCE):
            part = merged[low: min(low + ROWS_AT_ONCE, short)]
            self.known.update(zip(part, map(self._ids_of_symbols, self._merge_many(part))))
        for stretch in merged[short:]:
            self.known[stretch] = tuple(i for part in self._cuts(stretch) for i in self._ids_of(part))
        self._check(merged)

    def _check(self, stretches: list[str]) -> None:
        """Holds stretches against the library, all in one text if a character that merges with nothing can stand between them."""
        if not self.alone or not self._same(stretches):
            self.wrong.update(s for s in stretches if not self._same([s]))

    def _same(self, stretches: list[str]) -> bool:
        if self.alone:
            between = self._ids_of(self.alone[0])
            expected = [i for s in stretches for i in chain(between, self.known[s])]
            text = "".join(self.alone[0] + s for s in stretches)
            found = self.library.encode(text)
            return found[len(found) - len(expected):] == expected  # before them stands the blank put before a text
        text = stretches[0][1:] if self.prefixed and stretches[0][0] == SPACE else stretches[0]
        return not text or self.library.encode(text) == list(self.known[stretches[0]])

    def encode(self, text: str) -> tuple[list[int], bool]:
        """Ids of a text, and whether the library has the same ids for all its stretches."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[list[int], bool]]:
        """encode() of every text; what is new in any of them is merged at once."""
        cut = [self.cut.findall(self.library.normalize(t)) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.known)
        self._learn(new)
        for stretches in cut:
            ids = list(chain.from_iterable(map(self.known.__getitem__, stretches)))
            if not self.byte_ids:  # unknown characters side by side are one id
                ids = [i for k, i in enumerate(ids) if i != self.unknown or not k or ids[k - 1] != self.unknown]
            yield ids, not self.wrong or self.wrong.isdisjoint(stretches)
        for s in new:
            if len(s) > LONG_STRETCH:
                del self.known[s]
        if len(self.known) > STRETCHES_KEPT:  # what was not met again since the last time is forgotten
            self.older, self.known = self.known, {}

    def decode(self, ids: list[int], encoded: bool = False) -> str:
        """Text of ids: blanks for their sign, bytes joined to characters, the blank put before a text taken off.

        encoded: the ids come from encode(), which has no other than pieces and bytes where there are bytes.
        """
        if ids and (encoded and self.byte_ids or self.plain_text.issuperset(ids)):
            text = "".join(map(self.surface.__getitem__, ids))
            try:
                text = text.encode("utf-8", "surrogateescape").decode() if not text.isascii() else text
                return text[1:] if self.prefixed and not self.trimmed and self.pieces[ids[0]][0] == SPACE else text
            except UnicodeDecodeError:
                pass  # broken characters
        return self._decode_slowly(ids)

    def _decode_slowly(self, ids: list[int]) -> str:
        out, at_start = [], True
        byte_of, pieces = self.byte_of, self.pieces
        run = bytearray()
        for i in ids:
            b = byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_characters(run))
                run, at_start = bytearray(), False
            if i in self.control:
                continue
            if i == self.unknown:
                out.append(" ⁇ ")
                at_start = False
                continue
            piece = pieces[i]
            if at_start:
                if self.prefixed and piece[0] == SPACE:
                    piece, at_start = piece[1:], self.trimmed
                if piece:
                    at_start = False
            out.append(piece.replace(SPACE, " "))
        if run:
            out.append(_characters(run))
        return "".join(out)


@lru_cache(maxsize=1)
def codec_of(model: bytes) -> Codec:
    """One codec per worker, which keeps its stretches from task to task."""
    return Codec(model)


def _slot(key: np.ndarray) -> np.ndarray:
    """A place for a pair's key, well spread."""
    h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(40)).astype(np.int64)


def _table(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values in a table of open places; -1: free."""
    size = 1 << (4 * len(pairs) + 1).bit_length()
    keys, values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    at = _slot(np.array(list(pairs), np.int64)) & (size - 1)
    for place, (key, value) in zip(at.tolist(), pairs.items()):
        while keys[place] >= 0:
            place = (place + 1) & (size - 1)
        keys[place], values[place] = key, value
    return keys, values


def _characters(run: bytearray) -> str:
    """Characters of bytes; every byte of a broken character is one U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError as broken:
        low = run[: broken.start].decode()
        return low + "�" + _characters(run[broken.start + 1:])


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _groups(texts) -> Iterator[list[str]]:
    """Texts of an Arrow column, about CHARS_AT_ONCE characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


_OUT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean"


def _run(model, extra: list[str], keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value)
        lib = codec.library
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows, lists = [], []
                for ids, same in chain.from_iterable(map(codec.encode_all, _groups(part.column("text")))):
                    decoded = codec.decode(ids, encoded=True)
                    decimal = ",".join(map(codec.number.__getitem__, ids))
                    rows.append((len(ids), _digest(decimal), _digest(decoded), same and lib.decode(ids) == decoded))
                    if keep_ids:
                        lists.append(ids)
                columns = [part.column(c) for c in extra]
                for i, kind in enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_())):
                    columns.append(pa.array([r[i] for r in rows], kind))
                names = [*extra, "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
                if keep_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode(docs: DataFrame, model_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees) for every row; keep_ids adds the ids.

    ids_sha256: of the decimal ids joined by commas; decoded_sha256: of the text
    that the ids decode to; agrees: the library has the same ids for the text's stretches and decodes them to the same text.
    Null texts count as empty and have no ids; repeated rows and null ids are
    encoded like others; other columns are ignored; an empty table gives no rows.
    Texts are read whole, one at a time; nothing is shuffled.
    """
    with open(model_path or public_tokenizers.path(MODEL), "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())  # a model file of half a MB
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_OUT}" + (", ids array<int>" if keep_ids else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_run(model, ["doc_id"], keep_ids), schema)


def decode(rows: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids array<int>); null lists and null ids decode to nothing."""
    with open(model_path or public_tokenizers.path(MODEL), "rb") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value)
        for batch in batches:
            texts = [codec.decode(ids.as_py() or []) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    ids = F.filter(F.coalesce("ids", F.array().cast("array<int>")), lambda i: i.isNotNull())
    return rows.select("doc_id", ids.alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")
