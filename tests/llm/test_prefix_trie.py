"""Operator 13 against a trie of dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from docmart.llm import prefix_trie as T
from docmart.llm.shared import cut

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """The turns of each conversation, in order."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}


def trie(convs):
    """{(least member, depth): (parent's least member, members, children, leaves, saved, ids that end)}"""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = {}
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        children = sum(len(n) == len(node) + 1 for n in below)
        parent = min(members[node[:-1]]) if node else None
        out[min(own), len(node)] = (parent, len(own), children, len(childless), saved, sorted(ends.get(node, [])))
    return out


def check(paths, convs):
    nodes, ends = T.prefix_trie(paths)
    ended = {}
    for e in ends.collect():
        ended.setdefault(bytes(e.digest), []).append(e.conv_id)
    got = {(n.conv_id, n.depth): (n.parent_conv_id, n.n_convs, n.n_children, n.n_leaves, n.saved_tokens, sorted(ended.get(bytes(n.digest), []))) for n in nodes.collect()}
    assert got == trie(convs)
    hashes = {bytes(h.digest): h.ends_sha256 for h in T.end_digests(ends).collect()}
    assert hashes == {d: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest() for d, ids in ended.items()}


def odd_rows(seed):
    r = random.Random(seed)
    rows = []
    for c in range(60):
        start = r.choice([[("user", "hi")], [("user", "hi"), ("assistant", "yes\né𝒳")], []])
        turns = start + [(r.choice(["user", "assistant", None, ""]), r.choice(["a", "bb", "", None, "x:y"])) for _ in range(r.randint(0, 4))]
        rows += [(c * 7 - 20, r.choice([t, t, None]), *x) for t, x in enumerate(turns)]
    return rows + [(None, 0, "user", "no conversation"), (5, 1, "user", "tie"), (5, 1, "user", "tie")]


@pytest.mark.parametrize("shard", [1, 12, 1 << 18])
def test_trie(spark, monkeypatch, shard):
    """Also with shards so small that most nodes are cut."""
    monkeypatch.setattr(T, "SHARD", shard)
    rows = odd_rows(shard)
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA + ", depth int, digest string").repartition(5)
    check(T.conversation_paths(df), sequences(rows))


def test_copies(spark, monkeypatch):
    """Half of all conversations are equal, and one is long."""
    monkeypatch.setattr(T, "SHARD", 40)
    rows = [(c, t, "user", f"same {t}") for c in range(80) for t in range(3)] + [(100 + c, t, "user", f"{c}") for c in range(80) for t in range(2)] + [(999, t, "user", "w" * 300) for t in range(150)]
    check(T.conversation_paths(spark.createDataFrame(rows, SCHEMA).repartition(6)), sequences(rows))


def test_rebuilt(spark):
    """The first turns come from the first conversation of the hundred; without one, conversations may be left without turns."""
    r = random.Random(1)
    rows = [(c, t, r.choice("ua"), r.choice("xyz")) for c in [0, 1, 2, 7, 55, 99, 100, 101, 250, 251, 252, 253, 300, 399, -7] for t in range(r.randint(1, 7))]
    own = sequences(rows)
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        convs[c] = own.get(base, [])[:h] + turns[h:]
    assert any(not t for t in convs.values())
    check(T.rebuilt(cut(T.conversation_paths(spark.createDataFrame(rows, SCHEMA)))), convs)


def test_empty_table(spark):
    nodes, ends = T.prefix_trie(T.conversation_paths(spark.createDataFrame([], SCHEMA)))
    assert nodes.count() == ends.count() == T.end_digests(ends).count() == 0


def test_perfect_hash():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 5000):
        keys = r.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        keys[: n // 3, 0] = 7  # half of a key in common
        table = T.PerfectHash(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(n))
        others = table.slots(r.integers(0, 1 << 63, (100, 2)).astype(np.uint64))  # any slot or none: slots are checked by the caller
        assert (others < n).all()
    with pytest.raises(ValueError):
        T.PerfectHash(np.zeros((2, 2), np.uint64))


def test_one_digest_for_two_prefixes(monkeypatch):
    """A collision is told, not merged."""
    real = T.prefixes
    monkeypatch.setattr(T, "prefixes", lambda paths: ((d := real(paths))[0][:-1] + [d[0][1]], d[1] & (np.arange(len(d[1])) < len(d[1]) - 1)))
    a, b = b"a" * 16, b"b" * 16
    with pytest.raises(ValueError):
        list(T._shard([1, 2], [[a], [b]], [[1], [1]]))
