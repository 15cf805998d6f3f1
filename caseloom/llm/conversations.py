"""Cheapest repair of damaged conversations, by prefix-doubling path ranking.

A repaired conversation's roles read (system? (user assistant)+)?.  Every row is
kept (0), given another role (2) or deleted (3), and empty rows may be inserted
(2 each); a kept row that ends in mid-sentence costs one more.  Of the cheapest
repairs the one whose audit, the edits' initials in order, is least counts.

Method.  Nodes are (row, state of the pattern).  A dynamic program from the last
row to the first gives every node its least cost to the end; arcs that lie on a
cheapest path stay.  Nodes are then ranked by the least audit of one letter
that starts there, then of two, four, eight, each round from the ranks and the
pointers of the round before: a node's rank and the rank of the node its doubled
pointer leads to are the key of the next.  A letter leads from a node to one node
only, so ranks single out one path, which is read off the doubled pointers.

Scale.  Rows become short runs (digest, turn, role, kind; equal rows are counted)
before they are ordered, by ranges of (conversation, turn), so a conversation of
any length is spread over tasks and cut into blocks of BLOCK_ROWS.  Blocks of one
conversation are chained by 4 x 4 matrices of least costs.  Whole texts are
shuffled once, for the digest of the repaired text, which must be read in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.operators.joins import join_lookup
from caseloom.session import materialize

BLOCK_ROWS = 16_384
RUNS_AT_ONCE = 50_000  # bounds what a Python worker holds

DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
BLANKS = " \t\n\x0b\f\r"

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.  Initials: 0 s, 1 u, 2 a, 3 any other.
KEPT_TO = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
NEXT = np.array([2, 2, 3, 2])  # where a row of the wanted role leads
END = np.array([0.0, 4.0, 2.0, 0.0])  # least cost once no row is left
TRUNCATED, FORCED, BLANK = 4, 8, 16  # added to an initial; forced: a blank or a repeated row
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)  # in order; 0: the end

_BLOCK = ("conv string, place bigint, turns array<bigint>, roles array<string>, keys array<binary>, "
          "codes array<int>, ms array<bigint>")
_SOLVED = ("conv string, place bigint, audit string, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "turns bigint, first_turn bigint, last_turn bigint, first_init int, last_init int, "
           "edits array<struct<turn:bigint,role:string,key:binary,before:string,own:string,after:string>>")


# --- rows -----------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, times) after damage by crc32("conv_id:turn") % 20; nulls count as one blank.

    0 drops the row, 1 empties its text, 2 takes out its full stops, exclamation and
    question marks, 3 doubles it (times = 2), 4 makes its role user.
    """
    h = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), h.alias("h"))
    return rows.where("h <> 0").select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("h") == 3, 2).otherwise(1).cast("bigint").alias("times"))


def _conv(conv_id: str = "conv_id") -> Column:
    """A conversation's name that is never null."""
    return F.when(F.col(conv_id).isNull(), "").otherwise(F.concat(F.lit("c"), F.col(conv_id).cast("string")))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with their conversation's name and a digest of conversation, role and text."""
    named = rows.withColumn("conv", _conv())
    key = F.unhex(F.md5(F.concat_ws("|", F.length("conv"), "conv", F.length("role"), "role", "text")))
    return named.withColumn("key", key)


def _runs(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one row with their number m and code; a row whose key an earlier turn has is forced out."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
            + F.when(body == "", FORCED + BLANK).otherwise(F.when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(TRUNCATED)))
    narrow = _keyed(rows).select("conv", "turn", "role", "key", code.cast("int").alias("code"), "times")
    runs = narrow.groupBy("conv", "turn", "role", "key", "code").agg(F.sum("times").alias("m"))
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    again = runs.groupBy("key").agg(first.alias("first"), F.count("*").alias("runs")).where("runs > 1").select("key", "first")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    forced = F.when(later & (F.col("code") < FORCED), F.col("code") + FORCED).otherwise(F.col("code"))
    return join_lookup(runs, again, "key").select("conv", "turn", "role", "key", forced.cast("int").alias("code"), "m")


def _packer(block_rows: int):
    return lambda batches: _pack(batches, block_rows)


def _pack(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Runs in order, as blocks: of one conversation, of at most block_rows."""
    place, held = TaskContext.get().partitionId() << 33, None

    def packed(table: pa.Table, starts: np.ndarray, upto: int) -> pa.RecordBatch:
        nonlocal place
        offsets = pa.array(np.r_[starts, upto].astype(np.int32))
        flat = table.slice(0, upto).combine_chunks()
        column = lambda c: flat.column(c).combine_chunks() if flat.column(c).num_chunks != 1 else flat.column(c).chunk(0)
        lists = [pa.ListArray.from_arrays(offsets, column(c)) for c in ("turn", "role", "key", "code", "m")]
        names = np.arange(place, place + len(starts), dtype=np.int64)
        place += len(starts)
        return pa.RecordBatch.from_arrays([column("conv").take(pa.array(starts)), pa.array(names), *lists],
                                          ["conv", "place", "turns", "roles", "keys", "codes", "ms"])

    for batch in batches:
        table = pa.Table.from_batches([batch]).combine_chunks()
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        n = table.num_rows
        if not n:
            continue
        conv = table.column("conv")
        new = np.r_[True, np.asarray(pc.not_equal(conv.slice(1), conv.slice(0, n - 1)).combine_chunks().to_numpy(zero_copy_only=False), bool)]
        since = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        starts = np.flatnonzero(new | (since % block_rows == 0))
        last = int(starts[-1])  # the next batch may go on with it
        if last:
            yield packed(table, starts[:-1], last)
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield packed(held.combine_chunks(), np.array([0]), held.num_rows)


# --- cost, ranks, paths -----------------------------------------------------

def costs(codes: np.ndarray, offsets: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Least cost from every node to its block's tail: (runs + blocks) x 4 states x tails.

    offsets: blocks + 1 starts in codes; tails: blocks x 4 x n costs from a block's end on.
    """
    lengths, blocks = np.diff(offsets), len(offsets) - 1
    base = offsets[:-1] + np.arange(blocks)
    cost = np.empty((len(codes) + blocks, 4, tails.shape[2]))
    cost[base + lengths] = tails
    by_length = np.argsort(-lengths, kind="stable")
    kept_to = np.where(KEPT_TO < 0, 4, KEPT_TO)  # 4: nowhere
    for step in range(1, int(lengths.max(initial=0)) + 1):
        live = by_length[: np.searchsorted(-lengths[by_length], -step, "right")]
        row = offsets[live + 1] - step
        at = base[live] + lengths[live] - step
        code = codes[row]
        after = np.concatenate([cost[at + 1], np.full((len(live), 1, tails.shape[2]), np.inf)], axis=1)
        stay = np.where(code >= FORCED, np.inf, np.where(code & TRUNCATED, float(TRUNCATED_COST), 0.0))[:, None, None]
        keep = stay + np.take_along_axis(after, kept_to[:, code & 3].T[:, :, None], axis=1)
        now = np.minimum(np.minimum(keep, stay + REROLE_COST + after[:, NEXT]), after[:, :4] + DELETE_COST)
        now[:, 2], now[:, 3] = np.minimum(now[:, 2], now[:, 3] + INSERT_COST), np.minimum(now[:, 3], now[:, 2] + INSERT_COST)
        now[:, :2] = np.minimum(now[:, :2], now[:, 2:3] + INSERT_COST)
        cost[at] = now
    return cost


def least_arcs(codes: np.ndarray, offsets: np.ndarray, cost: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letter, target) of every node's optimal arc of the least letter; the end is a node that leads to itself.

    cost: as from costs, of one tail; last: blocks after which the conversation ends.
    """
    blocks, lengths = len(offsets) - 1, np.diff(offsets)
    base = offsets[:-1] + np.arange(blocks)
    cost = cost[:, :, 0]
    n = len(cost)
    row_at = np.ones(n, bool)
    row_at[base + lengths] = False
    code = np.zeros(n, np.int64)
    code[row_at] = codes
    letter, target = np.zeros((n, 4), np.int8), np.arange(4 * n).reshape(n, 4)
    here = np.arange(n)
    beyond = np.vstack([cost[1:], np.full((1, 4), np.inf)])
    beyond[~row_at] = np.inf
    stay = np.where(code >= FORCED, np.inf, np.where(code & TRUNCATED, float(TRUNCATED_COST), 0.0))[:, None]
    kept = KEPT_TO[:, code & 3].T
    insertable = row_at.copy()
    insertable[(base + lengths)[last]] = True
    arcs = [  # the greatest letter first, so that the least is written last
        (4, stay + REROLE_COST + beyond[:, NEXT], (here[:, None] + 1) * 4 + NEXT),
        (3, np.where(kept >= 0, stay + np.take_along_axis(beyond, np.maximum(kept, 0), axis=1), np.inf), (here[:, None] + 1) * 4 + kept),
        (2, np.where(insertable[:, None], cost[:, NEXT] + INSERT_COST, np.inf), here[:, None] * 4 + NEXT),
        (1, beyond + DELETE_COST, (here[:, None] + 1) * 4 + np.arange(4))]
    for name, through, to in arcs:
        optimal = np.isfinite(through) & (through == cost)
        letter[optimal], target[optimal] = name, to[optimal]
    return letter.ravel(), target.ravel()


def ranked(letter: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the nodes by their least audits, and pointers of 1, 2, 4, ... letters.

    A round orders the nodes by (rank, rank of the node the pointer leads to), which is
    their order by audits of twice the length; rounds end once every pointer is at an end.
    """
    rank, pointers = letter.astype(np.int64), [target]
    while letter[pointers[-1]].any():
        jump = pointers[-1]
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
        pointers.append(jump[jump])
    return rank, pointers


def read_paths(letter: np.ndarray, pointers: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, offsets) of the paths from the start nodes, without their ends, read off the doubled pointers."""
    at, length = starts.copy(), np.zeros(len(starts), np.int64)
    for k in range(len(pointers) - 1, -1, -1):
        ahead = pointers[k][at]
        on = letter[ahead] != 0
        length[on] += 1 << k
        at = np.where(on, ahead, at)
    length[letter[at] != 0] += 1
    offsets = np.r_[0, np.cumsum(length)]
    nodes = np.repeat(starts, length)
    step = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length)
    for k, jump in enumerate(pointers):
        turn = (step >> k & 1).astype(bool)
        nodes[turn] = jump[nodes[turn]]
    return nodes, offsets


# --- blocks -----------------------------------------------------------------

def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Blocks in slices of about RUNS_AT_ONCE runs."""
    ends = np.cumsum(np.asarray(pc.list_value_length(batch.column("codes")).to_numpy(zero_copy_only=False)))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + RUNS_AT_ONCE, "right")))
        yield batch.slice(low, high - low)
        low = high


def _flat(batch: pa.RecordBatch, name: str):
    return batch.column(name).flatten()


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    lengths = batch.column("codes").value_lengths().to_numpy(zero_copy_only=False)
    return _flat(batch, "codes").to_numpy(zero_copy_only=False).astype(np.int64), np.r_[0, np.cumsum(lengths)].astype(np.int64)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least cost from every state before a block to every state after it."""
    for whole in batches:
        for batch in _slices(whole):
            codes, offsets = _codes(batch)
            blocks = batch.num_rows
            unit = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
            cost = costs(codes, offsets, np.broadcast_to(unit, (blocks, 4, 4)))
            through = cost[offsets[:-1] + np.arange(blocks)].reshape(blocks, 16)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("place"), pa.array(list(through), pa.list_(pa.float64()))],
                                             ["conv", "place", "through"])


def _chain_tails(group: pa.Table) -> pa.Table:
    """Costs after each block of a conversation, from its last block to its first; a group holds 4 x 4 numbers a block."""
    group = group.sort_by("place")
    through = np.array(group.column("through").to_pylist()).reshape(-1, 4, 4)
    tails = np.empty((len(through), 4))
    tail = END
    for b in range(len(through) - 1, -1, -1):
        tails[b] = tail
        tail = (through[b] + tail).min(axis=1)
    place = np.arange(len(through))
    return pa.table({"conv": group.column("conv"), "place": group.column("place"), "tail": pa.array(list(tails), pa.list_(pa.float64())),
                     "first": pa.array(place == 0), "last": pa.array(place == len(through) - 1)})


def _paths(batch: pa.RecordBatch, tails: np.ndarray, last: np.ndarray):
    codes, offsets = _codes(batch)
    cost = costs(codes, offsets, tails[:, :, None])
    letter, target = least_arcs(codes, offsets, cost, last)
    _, pointers = ranked(letter, target)
    return codes, offsets, cost, letter, target, pointers


def _tails(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.array(batch.column("tail").to_pylist(), float).reshape(-1, 4), np.array(batch.column("last").to_pylist(), bool)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state a block's least path ends in, for each state it may start in."""
    for whole in batches:
        for batch in _slices(whole):
            codes, offsets, _, letter, _, pointers = _paths(batch, *_tails(batch))
            starts = (offsets[:-1] + np.arange(batch.num_rows))[:, None] * 4 + np.arange(4)
            ends = pointers[-1][starts] % 4
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("place"), batch.column("tail"),
                                              batch.column("first"), batch.column("last"), pa.array(list(ends.astype(np.int32)), pa.list_(pa.int32()))],
                                             ["conv", "place", "tail", "first", "last", "ends"])


def _chain_entries(group: pa.Table) -> pa.Table:
    """The state each block of a conversation starts in."""
    group = group.sort_by("place")
    entries, state = [], 0
    for ends in group.column("ends").to_pylist():
        entries.append(state)
        state = ends[state]
    return group.drop_columns(["ends"]).append_column("entry", pa.array(entries, pa.int32()))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _slices(whole):
            if batch.num_rows:
                yield _solved(batch)


def _solved(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Audit, cost, counts and edits of every block."""
    blocks = batch.num_rows
    tails, last = _tails(batch)
    entry = batch.column("entry").to_numpy(zero_copy_only=False).astype(np.int64)
    codes, offsets, cost, letter, target, pointers = _paths(batch, tails, last)
    base = offsets[:-1] + np.arange(blocks)
    nodes, path = read_paths(letter, pointers, base * 4 + entry)
    ms = _flat(batch, "ms").to_numpy(zero_copy_only=False)

    # audits: a run's further copies are deleted right after its first
    own_letter = letter[nodes]
    block = np.repeat(np.arange(blocks), np.diff(path))
    row = nodes // 4 - block  # of codes; of an insertion: the row it comes before
    width = np.where(own_letter == 2, 1, ms[np.minimum(row, len(ms) - 1)])
    ends = np.cumsum(width)
    signs = np.full(int(ends[-1]) if len(ends) else 0, ord("D"), np.uint8)
    signs[ends - width] = LETTERS[own_letter]
    bounds = np.r_[0, ends][path]
    audits = pa.array([signs[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])], pa.string())

    # edits, row by row
    to_user = target[nodes] % 4 == 2
    own = np.full(len(codes), "", object)
    own[row[own_letter == 3]] = "K"
    changed = own_letter == 4
    own[row[changed]] = np.where(to_user[changed], "u", "a")
    before, after = np.full(len(codes), "", object), np.full(len(codes), "", object)
    for at in np.flatnonzero(own_letter == 2):
        r, sign = row[at], "u" if to_user[at] else "a"
        if r < offsets[block[at] + 1]:
            before[r] += sign
        else:
            after[r - 1] += sign
    said = np.flatnonzero((own != "") | (before != "") | (after != ""))
    rows_of = pa.array(said)
    edits = pa.StructArray.from_arrays(
        [_flat(batch, "turns").take(rows_of), _flat(batch, "roles").take(rows_of), _flat(batch, "keys").take(rows_of),
         *(pa.array(list(x[said]), pa.string()) for x in (before, own, after))], ["turn", "role", "key", "before", "own", "after"])
    edits = pa.ListArray.from_arrays(pa.array(np.searchsorted(said, offsets).astype(np.int32)), edits)

    # counts
    def per_block(x: np.ndarray) -> pa.Array:
        sums = np.r_[0, np.cumsum(x.astype(np.int64))]
        return pa.array(sums[offsets[1:]] - sums[offsets[:-1]])

    blank, forced, initial = (codes & BLANK) > 0, (codes & FORCED) > 0, codes & 3
    inside = np.ones(len(codes), bool)
    inside[offsets[:-1]] = False  # rows with a row before them in their block
    legal = np.isin(np.r_[3, initial[:-1]] * 4 + initial, (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))
    turns = _flat(batch, "turns")
    known = turns.is_valid().to_numpy(zero_copy_only=False)
    number = turns.fill_null(0).to_numpy(zero_copy_only=False)
    fresh = known & ~(inside & np.r_[False, known[:-1]] & (np.r_[0, number[:-1]] == number))
    first_known = pa.array([number[a:b][known[a:b]][0] if known[a:b].any() else None for a, b in zip(offsets, offsets[1:])], pa.int64())
    last_known = turns.take(pa.array(offsets[1:] - 1))
    first = np.array(batch.column("first").to_pylist(), bool)
    copies = np.asarray(per_block(DELETE_COST * (ms - 1)))
    spent = np.where(first, cost[base, entry, 0], 0).astype(np.int64) + copies  # the first block knows the cost to the end
    return pa.RecordBatch.from_arrays(
        [batch.column("conv"), batch.column("place"), audits,
         pa.array(spent),
         per_block(np.where(blank, ms, 0)), per_block(np.where(blank, 0, np.where(forced, ms, ms - 1))),
         per_block(~forced & ((codes & TRUNCATED) > 0)), per_block((ms - 1) + (inside & ~legal)), per_block(fresh),
         first_known, last_known, pa.array(initial[offsets[:-1]].astype(np.int32)), pa.array(initial[offsets[1:] - 1].astype(np.int32)),
         edits],
        ["conv", "place", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn",
         "first_init", "last_init", "edits"])


_TAIL = "conv string, place bigint, tail array<double>, first boolean, last boolean"


def _solved_blocks(rows: DataFrame) -> DataFrame:
    order = ["conv", "turn", "role", "key"]
    ordered = _runs(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = materialize(ordered.mapInArrow(_packer(BLOCK_ROWS), _BLOCK), "blocks")
    several = materialize(blocks.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv"), "several")
    one = blocks.join(several, "conv", "left_anti").withColumns({
        "tail": F.array(*[F.lit(float(x)) for x in END]), "first": F.lit(True), "last": F.lit(True), "entry": F.lit(0)})
    many = materialize(blocks.join(several, "conv", "left_semi"), "chained")
    through = many.select("conv", "place", "codes").mapInArrow(_matrices, "conv string, place bigint, through array<double>")
    tails = materialize(through.groupBy("conv").applyInArrow(_chain_tails, _TAIL), "tails")
    ends = many.select("conv", "place", "codes").join(tails, ["conv", "place"]).mapInArrow(_exits, f"{_TAIL}, ends array<int>")
    entries = materialize(ends.groupBy("conv").applyInArrow(_chain_entries, f"{_TAIL}, entry int"), "entries")
    known = one.unionByName(many.join(entries, ["conv", "place"]))
    return materialize(known.mapInArrow(_solve, _SOLVED), "solved")


# --- repaired texts -----------------------------------------------------------

_ROLES = {"u": "user", "a": "assistant"}


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str, str]]:
    """(conv, edit, role, text) of every repaired row; edits and texts come in order, an edit before its text."""
    waiting = None
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            columns = (batch.column(c).slice(low, 256).to_pylist() for c in ("conv", "key", "role", "kind", "before", "own", "after", "text"))
            for conv, key, role, kind, before, own, after, text in zip(*columns):
                if kind == 0:
                    for sign in before:
                        yield conv, "I", _ROLES[sign], ""
                    waiting = (conv, key, own, after) if own else None
                    for sign in "" if own else after:
                        yield conv, "I", _ROLES[sign], ""
                elif waiting is not None and waiting[:2] == (conv, key):
                    _, _, own, after = waiting
                    yield conv, "K" if own == "K" else "R", _ROLES.get(own, role), text
                    for sign in after:
                        yield conv, "I", _ROLES[sign], ""
                    waiting = None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every conversation's repaired rows, read one at a time."""
    found, now, digest = [], None, None
    names = ["conv", "repaired_sha256"]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names)

    for conv, _, role, text in _told(batches):
        if conv != now:
            if now is not None:
                found.append((now, digest.hexdigest()))
                if len(found) >= 4096:
                    yield out()
                    found.clear()
            now, digest = conv, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if now is not None:
        found.append((now, digest.hexdigest()))
    yield out()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, now, place = [], None, 0
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], kind) for i, kind in enumerate(kinds)],
                                          ["conv", "place", "edit", "role", "text"])

    for conv, edit, role, text in _told(batches):
        place = place + 1 if conv == now else 0
        now = conv
        held.append((conv, place, edit, role, text))
        if len(held) >= 1024:
            yield out()
            held.clear()
    yield out()


def _in_order(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Edits and texts of each conversation in one task, in order."""
    texts = _keyed(rows).where(F.rtrim(F.col("text"), F.lit(BLANKS)) != "").select(
        "conv", "turn", "role", "key", F.lit(1).alias("kind"), *[F.lit(None).cast("string").alias(c) for c in ("before", "own", "after")], "text")
    edits = solved.select("conv", F.explode("edits").alias("e")).select(
        "conv", "e.turn", "e.role", "e.key", F.lit(0).alias("kind"), "e.before", "e.own", "e.after", F.lit(None).cast("string").alias("text"))
    return edits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "turn", "role", "key", "kind")


def _complete(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, times) without nulls in role and text."""
    times = F.col("times").cast("bigint") if "times" in rows.columns else F.lit(1).cast("bigint")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), blank("role"), blank("text"), times.alias("times"))


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of every row of the repaired conversations, as repair() counts them.

    edit: K kept, R given another role, I inserted.
    """
    rows = _complete(rows)
    told = _in_order(rows, _solved_blocks(rows)).mapInArrow(_repaired, "conv string, place bigint, edit string, role string, text string")
    kind = rows.schema["conv_id"].dataType
    return told.select(F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id"), "place", "edit", "role", "text")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    rows: conv_id, turn, role, text, and times where a row counts more than once;
    conversations: all conv_ids to report (by default those of rows); without rows they
    get zeros, an empty audit and the digest of nothing.  Rows are in the order of turn,
    nulls first, then role, then a digest of the text.  Null ids are one conversation; null
    roles and texts count as one blank; a role is its first character, and one without
    characters can only be replaced or deleted; repeated rows are duplicates; other columns
    are ignored; an empty table gives no rows.
    """
    rows = _complete(rows)
    solved = _solved_blocks(rows)
    along = Window.partitionBy("conv").orderBy("place")
    pair = F.lag("last_init").over(along) * 4 + F.col("first_init")
    counted = solved.drop("edits").withColumns({
        "illegal": F.col("illegal") + F.when(pair.isNotNull() & ~pair.isin(1, 6, 9), 1).otherwise(0),
        "turns": F.col("turns") - F.when(F.lag("last_turn").over(along) == F.col("first_turn"), 1).otherwise(0)})
    audits = F.array_sort(F.collect_list(F.struct("place", "audit")))
    totals = counted.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns")],
        F.min("first_turn").alias("low"), F.max("last_turn").alias("high"),
        F.array_join(F.transform(audits, lambda a: a["audit"]), "").alias("audit"))
    digests = _in_order(rows, solved).mapInArrow(_digests, "conv string, repaired_sha256 string")
    asked = (rows if conversations is None else conversations).select("conv_id", _conv().alias("conv"))
    every = asked.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    whole = every.join(totals, "conv", "left").join(digests, "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("bigint")
    return whole.select("conv_id", gaps.alias("gaps"), *[zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
