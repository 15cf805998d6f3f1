"""Conversation repair against a search over all edits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import conversations
from caseloom.llm.common import table
from caseloom.llm.queries import QUERIES
from tests.llm import brute_conversations as brute

FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def as_dict(df):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


@pytest.fixture(scope="module")
def wild(spark):
    """Conversations of any order of roles, with repeats, nulls, blanks and ties."""
    rng = random.Random(4)
    texts = ["Yes.", "No", "What?", "", " \t", "It is so.", "cut off in", "é!", None, "a.b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "aide"]
    rows = []
    for conv in [*range(400), None]:
        turns = [rng.choice([None, *range(12)]) for _ in range(rng.randrange(1, 11))]
        rows += [(conv, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}.") for t in turns]
    rows += [(1_000, t, "user", "the same") for t in range(30)] + [(1_001, 5, "assistant", "the same.")] * 25
    return rows


def test_query_equals_the_search(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = [tuple(r) for r in table(spark, f"/root/testdata/{sf}", "conversations").select("conv_id", "turn", "role", "text").collect()]
        want = brute.repair(brute.damaged(rows), {r[0] for r in rows})
        assert as_dict(QUERIES["op12_path_ranking"](spark, f"/root/testdata/{sf}")) == want


def test_damage(spark, wild):
    df = spark.createDataFrame(wild, SCHEMA)
    got = [r[:4] for r in conversations.damage(df).collect() for _ in range(r["times"])]
    assert sorted(got, key=repr) == sorted(brute.damaged(wild), key=repr)


@pytest.mark.parametrize("block_rows", [conversations.BLOCK_ROWS, 3])
def test_wild_conversations(spark, wild, block_rows, monkeypatch):
    """Blocks of three rows: paths, counts and costs cross many blocks and tasks."""
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block_rows)
    df = spark.createDataFrame(wild, SCHEMA).withColumns({c: F.lit("own") for c in ("conv", "key", "code", "place", "m", "kind", "own")})
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in wild]
    assert as_dict(conversations.repair(df)) == brute.repair(rows, {r[0] for r in rows})


def test_small_blocks_are_really_used(spark, monkeypatch):
    """Workers import the module anew, so the packing function must see the smaller size."""
    runs = spark.createDataFrame([("c1", t, "user", b"k", 1, 1) for t in range(10)], "conv string, turn long, role string, key binary, code int, m long")
    blocks = runs.coalesce(1).mapInArrow(conversations._packer(3), conversations._BLOCK).collect()
    assert [len(b["codes"]) for b in blocks] == [3, 3, 3, 1]


def test_repaired_rows_have_a_legal_order(spark, wild):
    df = spark.createDataFrame(wild, SCHEMA)
    told = {}
    for r in sorted(conversations.repaired_rows(df).collect(), key=lambda r: r["place"]):
        told[r["conv_id"]] = told.get(r["conv_id"], "") + r["role"][:1]
    for roles in told.values():
        body = roles[1:] if roles[:1] == "s" else roles
        assert body == "ua" * (len(body) // 2) and (body or not roles)


def test_ranks_order_nodes_by_their_audits():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 4, 60) + 4 * rng.integers(0, 2, 60) + 8 * (rng.random(60) < 0.2)
    offsets = np.array([0, 1, 8, 25, 60])
    tails = np.broadcast_to(conversations.END[:, None], (4, 4, 1))
    cost = conversations.costs(codes, offsets, tails)
    letter, target = conversations.least_arcs(codes, offsets, cost, np.ones(4, bool))
    rank, pointers = conversations.ranked(letter, target)
    nodes = np.arange(len(letter))
    path, at = conversations.read_paths(letter, pointers, nodes)
    audits = [bytes(letter[path[a:b]]) for a, b in zip(at, at[1:])]
    assert all((rank[i] < rank[j]) == (audits[i] < audits[j]) for i in nodes[::3] for j in nodes)


def test_a_long_conversation(spark):
    rows = [(7, t, ("user", "assistant", "assistant")[t % 3], f"text {t}" + "." * (t % 5 > 0)) for t in range(30_000)]
    got = as_dict(conversations.repair(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute.repair(rows, {7})


def test_nothing_left_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1, "user", "a."), (1, 2, "assistant", "b.")], SCHEMA)
    empty = brute.repair([], [1])
    assert as_dict(conversations.repair(df.limit(0), df)) == empty
    assert conversations.repair(df.limit(0)).collect() == [] and conversations.damage(df.limit(0)).collect() == []
