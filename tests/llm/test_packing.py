"""Operator 12: every piece in its place, as few sequences as can be, ids of the tokenizer."""

import itertools
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from docmart.llm import packing as P


def held(plan, capacity):
    """How many pieces of each length a plan holds; and its sequences."""
    out = np.zeros(capacity + 1, np.int64)
    for config, times in plan:
        assert times > 0 and 0 < sum(config) <= capacity
        for length in config:
            out[length] += times
    return out, sum(times for _, times in plan)


def fewest(lengths, capacity):
    """The least number of sequences, by trying every subset."""
    n = len(lengths)
    fits = [sum(lengths[k] for k in range(n) if s >> k & 1) <= capacity for s in range(1 << n)]

    @lru_cache(maxsize=None)
    def rest(s):
        if not s:
            return 0
        low, others = s & -s, s & (s - 1)
        best, sub = n, others
        while True:
            if fits[sub | low]:
                best = min(best, 1 + rest(others ^ sub))
            if not sub:
                return best
            sub = (sub - 1) & others

    return rest((1 << n) - 1)


@pytest.mark.parametrize("seed", range(3))
def test_small_plans_against_every_subset(seed):
    r = random.Random(seed)
    more = 0
    for _ in range(40):
        lengths = [r.randint(1, 30) for _ in range(r.randint(1, 9))]
        counts = np.bincount(lengths, minlength=31)
        got, n = held(P.packed(counts), 30)
        assert (got == counts).all()
        more += n - fewest(tuple(lengths), 30)
    assert more <= 1


@pytest.mark.parametrize("seed", range(3))
def test_large_counts(seed):
    """Also where a third of all pieces have one length, and where the weights must find pairs (60 + 40)."""
    r = np.random.default_rng(seed)
    for counts in (r.integers(0, 5000, 257), np.bincount([60] * 700 + [40] * 700 + [100] * 5, minlength=101), np.where(np.arange(257) == 77, 300_000, r.integers(0, 3000, 257))):
        capacity = len(counts) - 1
        counts[0] = 0
        got, n = held(P.packed(counts), capacity)
        assert (got == counts).all()
        assert n <= held(P.best_fit(counts), capacity)[1] * 1.005 + 1
    counts = np.where(np.arange(1025) % 1024, r.poisson(300 * np.exp(-np.arange(1025) / 250)), 0)  # enough short ones to fill all room
    got, n = held(P.packed(counts), 1024)
    assert (got == counts).all() and n <= np.ceil((counts * np.arange(1025)).sum() / 1024) * 1.002 + 1


def test_knapsack():
    r = random.Random(4)
    for _ in range(30):
        price = np.array([0.0] + [r.choice((0, r.random())) for _ in range(12)])
        value, first = P.knapsack(price)
        best = [0.0] * 13
        for room in range(1, 13):
            best[room] = max([0.0] + [price[s] + best[room - s] for s in range(1, room + 1)])
        assert np.allclose(value, best)


def test_ids_are_the_tokenizers():
    t = Tokenizer.from_file(P.TOKENIZER)
    t.encode_special_tokens = True
    encode, r = P.encoder(P.TOKENIZER), random.Random(1)
    parts = ["a", "the ", " ", "\n", "\t", "é", "'s", "'S", "12", "²", "日本", "!?", "<|endoftext|>", "ß", "\xa0", "x" * 30, "  ", "🙂", "\x00", "İ"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 60))) for _ in range(500)] + ["a" * 3000, " " * 3000 + "b"]
    for text in texts:
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def placed(rows, capacity):
    """Checks the places; returns {(doc_id, text's ids): pieces} and the number of sequences."""
    taken = {}
    for p in rows:
        taken.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in taken.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(taken)


def test_documents(spark):
    encode, r = P.encoder(P.TOKENIZER), random.Random(2)
    texts = [" ".join(r.choices(["alpha", "be ta", "ünü", "x"], k=r.choice((1, 5, 20, 90)))) for _ in range(300)] + [None, "", "", "w " * 500]
    rows = [(k if k % 7 else None, t, "c", k) for k, t in enumerate(texts)] + [(1, texts[1], "c", 1)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, share int").repartition(5)
    capacity = 64
    pieces = P.pack_documents(df, capacity=capacity)
    got = pieces.collect()
    want = []
    for k, text, *_ in rows:
        ids = [*encode(text or ""), 0]
        head = len(ids) % capacity or min(len(ids), capacity)
        for piece, at in enumerate([0, *range(head, len(ids), capacity)]):
            part = ids[at : at + (capacity if at else head)]
            want.append((k, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((p.doc_id, p.piece, p.start, p.length, zlib.crc32(p.ids)) for p in got), key=key) == sorted(want, key=key)
    counts = np.bincount([x[3] for x in want], minlength=capacity + 1)
    assert placed(got, capacity) == held(P.packed(counts), capacity)[1] <= held(P.best_fit(counts), capacity)[1] + 1
    whole = {s.sequence_id: s for s in P.sequences(pieces).collect()}
    for p in got:
        assert whole[p.sequence_id].ids[4 * p.offset : 4 * (p.offset + p.length)] == p.ids
    assert P.pack_documents(df.limit(0)).count() == 0


def test_one_length_everywhere(spark):
    """All pieces of one length, as many repeated rows: dealt over the shares and still without gaps."""
    df = spark.range(2000).selectExpr("if(id % 3 = 0, 5, id) AS doc_id", "'a b' AS text")
    got = P.pack_documents(df, capacity=10).collect()
    n = got[0].length
    assert placed(got, 10) == -(-2000 // (10 // n)) and len(got) == 2000
    assert list(itertools.chain(*[[p.piece] for p in got])) == [0] * 2000
