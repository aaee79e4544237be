"""Conversation prefix trie (op 12) against a plain trie."""
import hashlib
import random
import zlib

import pytest
from conftest import SF001

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns: dict = {}
    for r in rows:
        if r[0] is not None:
            turns.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members: dict = {}
    ends: dict = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c / 5) * 5 if abs(c) < 2**50 else (abs(c) % 5) * (1 if c > 0 else -1)
        seq = turns.get(c - base, [])[:h] + turns[c][h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids: dict = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = sum(saved[k] for k in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), -1 if not p else min(members[p[:-1]]), len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


def awkward():
    random.seed(5)
    rows = [(c, t, random.choice(["user", None, "assistant"]), random.choice(["a", "", None, "ß漢", "long " * 50])) for c in range(-12, 40)
            for t in range(random.randint(1, 14))]
    rows += [(None, 0, "user", "x"), (50, None, "user", "first"), (50, 0, "user", "second"), (50, 0, "user", "second"), (50, 0, None, None)]
    rows += [(c, 0, "user", "same") for c in range(100, 160)] + [(200, t, "user", str(t % 3)) for t in range(300)]
    return rows + [(2**62, 0, "user", "same"), (-(2**62), 0, "user", "same")]


@pytest.mark.parametrize("local_nodes", [None, 3, 0])
def test_equals_plain_trie(spark, local_nodes):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS node", "3 AS _rn", "4 AS size")
    assert got(prefix_trie.prefix_trie(df, local_nodes)) == plain(rows)


def test_chunked_sums(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_TURNS", 7)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 4)
    rows = awkward()
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_query(spark):
    from tidemark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_prefix_trie"](spark, SF001)) == plain(rows)


def test_empty(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
