"""The trie of conversations against one built in plain Python."""

import hashlib
import random
import zlib

import pytest

import __spark_entry__ as entry
from gaugeline.llm import prefix_trie

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
RESULT = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [turn[2:] for turn in sorted(turns)] for c, turns in own.items()}
    grown = {}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 9
        grown[c] = own.get(c - c % 5, [])[:head] + turns[head:]
    members, children = {}, {}
    for c, turns in grown.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, found = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below, own_members = children.get(node, []), members[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below)
        if node:
            saved[node] += (len(own_members) - 1) * len(node[-1][1].encode())
        ends = ",".join(str(c) for c in sorted(own_members) if len(grown[c]) == len(node))
        found.append(
            (
                min(own_members),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own_members),
                len(below),
                leaves[node],
                saved[node],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def rows_of(df):
    assert df.columns == RESULT
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(5)
    words = ["x", "yé", None, "z"]
    rows = [
        (c, t, draw.choice(["u", "a", None]), draw.choice(words))
        for c in [*range(-7, 20), 10**12]
        for t in range(draw.randint(1, 12))
    ]
    # Long ones that share their beginning, one without a donor, rows that belong nowhere.
    rows += [(c, 100 + t, "u", "same" if t < 20 else draw.choice(words)) for c in (5, 6, 8) for t in range(37)]
    return rows + [(23, 1, "u", "x"), (None, 1, "u", "x"), (3, None, "u", "first"), (3, 50, "a", "p"), (3, 50, "a", "p")]


@pytest.mark.parametrize("leaf", [4, 64])
def test_odd_conversations(spark, odd_rows, leaf):
    """With a small leaf the long conversations are cut four times by Spark."""
    table = spark.createDataFrame(odd_rows, COLUMNS).selectExpr("*", "1 as block", "2 as depth", "'o' as owner")
    assert rows_of(prefix_trie.conversation_trie(table, leaf)) == brute(odd_rows)


def test_query(spark):
    table = spark.read.parquet(f"{entry.SMOKE_DIR}/conversations.parquet")
    given = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = entry.queries()["op12_conversation_prefix_trie"](spark, entry.SMOKE_DIR)
    assert rows_of(found) == brute(given)


def test_no_conversations(spark):
    assert rows_of(prefix_trie.conversation_trie(spark.createDataFrame([], COLUMNS))) == []


def test_many_equal_conversations(spark, monkeypatch):
    """One node has all members; their ids are written out in several runs."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 200) for t in range(3)]
    assert rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, COLUMNS))) == brute(rows)
