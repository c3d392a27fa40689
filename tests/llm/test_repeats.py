"""Operators 5 and 6 against brute force over every window."""

import hashlib
import random

import numpy as np
import pytest

from docmart.llm import repeats as R
from docmart.llm.recompression import interior_symbols, substring_dedup
from docmart.llm.repeats import window_starts
from docmart.llm.suffix_array import first_digits, suffix_array_dedup


def brute(rows, cut, width, join):
    seen = {}
    rows = [(i, cut((t or "").encode())) for i, t in rows]
    for i, w in rows:
        for k in range(len(w) - width + 1):
            key = join(w[k : k + width])
            seen[key] = min(seen.get(key, i), i)
    out = {}
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if seen[join(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out[i] = (len(w), sum(gone), hashlib.sha256(join([x for x, g in zip(w, gone) if not g])).hexdigest())
    return out


def texts(seed, n=60):
    r = random.Random(seed)
    words = ["a", "b", "ab", "é", "the", "of", "x" * 9, "zz", "Q.", "\tu"]
    shared = [" ".join(r.choices(words, k=r.randint(5, 80))) for _ in range(6)]
    out = [None, "", " ", "x" * 300, "x" * 260, "x x " * 120, "x x " * 90 + "y", "short"]
    while len(out) < n:
        t = [" ".join(r.choices(words, k=r.randint(0, 60)))]
        for _ in range(r.randint(0, 3)):
            t += [r.choice(shared)[r.randint(0, 20) :], " ".join(r.choices(words, k=r.randint(0, 20)))]
        out.append(r.choice([" ", "\n", "  "]).join(t))
    out += [out[20], out[21], out[20] + "!"]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffix_array_dedup(df, with_text=True).collect()}
    want = brute(rows, lambda b: b, 50, bytes)
    assert {i: (r.n_bytes, r.n_removed, r.kept_sha256) for i, r in got.items()} == want
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got.values())


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_words(spark, seed):
    rows = texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df, width=20).collect()}
    assert got == brute(rows, lambda b: b.split(), 20, b" ".join)


@pytest.mark.parametrize("anchors,width", [(first_digits(8), 20), (interior_symbols(3), 50), (interior_symbols(2), 20)])
def test_equal_windows_have_equal_anchors(anchors, width):
    r = np.random.Generator(np.random.PCG64(5))
    alphabet = r.integers(1, 1 << 60, 3, dtype=np.uint64)
    codes = alphabet[r.integers(0, 3, 4000)]
    codes[500:600] = codes[500]
    codes[1000:1300] = codes[2000:2300]
    bounds = np.array([0, 1500, 1500, 4000])
    starts = window_starts(bounds, width)
    place, name = anchors(codes, bounds, starts, width)
    by_window = {}
    for s, n in zip(starts, name):
        by_window.setdefault(codes[s : s + width].tobytes(), set()).add(int(n))
    assert all(len(v) == 1 for v in by_window.values())
    assert len(starts) > 3000


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, codes int, doc string")
    assert suffix_array_dedup(empty).count() == 0
    assert substring_dedup(empty).count() == 0
    t = "one two three four five six seven eight nine ten " * 12
    df = spark.createDataFrame([(None, t, 1, "x"), (2, t, None, None), (2, t, 1, "x"), (7, t, 1, "x")], "doc_id long, text string, codes int, doc string")
    assert sorted((r.doc_id or -1, r.n_removed) for r in suffix_array_dedup(df).collect()) == [(-1, 0), (2, 0), (2, 0), (7, len(t))]
    assert sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup(df).collect()) == [(-1, 0), (2, 0), (2, 0), (7, 120)]


@pytest.mark.parametrize("seed", range(8))
def test_interior_symbols_are_decided_by_the_window(seed):
    """Equal windows agree on their anchor whatever surrounds them, runs included."""
    r = np.random.Generator(np.random.PCG64(seed))
    alphabet = r.integers(1, 1 << 60, 2 + seed, dtype=np.uint64)
    passage = np.repeat(alphabet[r.integers(0, len(alphabet), 60)], r.integers(1, 4, 60))[:100]
    parts = [np.concatenate((alphabet[r.integers(0, len(alphabet), r.integers(0, 9))], passage, alphabet[r.integers(0, len(alphabet), r.integers(0, 9))])) for _ in range(80)]
    codes, bounds = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    for width in (12, 20, 50):
        starts = window_starts(bounds, width)
        _, name = interior_symbols(3)(codes, bounds, starts, width)
        by_window = {}
        for s, n in zip(starts, name):
            by_window.setdefault(codes[s : s + width].tobytes(), set()).add(int(n))
        assert all(len(v) == 1 for v in by_window.values())


def test_hot_anchors_and_buckets(spark, monkeypatch):
    """With every shared anchor hot, and with one bucket for everything, results are the same."""
    rows = texts(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, lambda b: b, 50, bytes), brute(rows, lambda b: b.split(), 20, b" ".join)
    for hot, bits in ((0, None), (R.HOT, 0)):
        # the settings are read where tasks are made, so they go along as the kind's own functions would
        monkeypatch.setattr(R, "shared_anchors", with_hot(R.shared_anchors, hot))
        if bits is not None:
            monkeypatch.setattr(R, "dealt", lambda docs: (3, 1))
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_array_dedup(df).collect()}
        assert got == want[0]
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df, width=20).collect()}
        assert got == want[1]


def with_hot(fn, hot):
    def run(batches):
        R.HOT = hot
        yield from fn(batches)

    return run


@pytest.mark.parametrize("seed", range(4))
def test_radix_sort(seed):
    r = np.random.Generator(np.random.PCG64(seed))
    data = r.integers(0, 3, 3000).astype(np.uint8)
    start = r.integers(0, 2900, 700)
    length = r.choice([1, 7, 8, 9, 16, 31], 700)
    name = r.integers(0, 2, 700).astype(np.uint64)
    doc = r.integers(0, 40, 700)
    least = {}
    keys = [(int(n), data[s : s + k].tobytes()) for n, s, k in zip(name, start, length)]
    for k, d in zip(keys, doc.tolist()):
        least[k] = min(least.get(k, d), d)
    assert R.repeated(data, start, length, name, doc).tolist() == [d > least[k] for k, d in zip(keys, doc.tolist())]


def test_places_of_long_texts():
    """Beyond 2**24 tokens a place takes more bits, so none wraps."""
    assert R.place_bits(10) == (1 << 24) - 1 and R.place_bits((1 << 24) + 5) == (1 << 25) - 1
    for n in ((1 << 24) - 1, 1 << 24, 40_000_000):
        assert n <= R.place_bits(n)


def test_one_long_text_and_runs(spark):
    """A text of two million bytes that repeats itself, and one run, beside short ones that share parts of them."""
    long = "abcdefghij " * 180_000
    rows = [(1, "x" * 200_000), (2, long), (3, long[77:400]), (4, "x" * 70 + "y"), (5, "y" * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_removed for r in suffix_array_dedup(df).collect()}
    assert got == {1: 0, 2: 0, 3: 323, 4: 70, 5: 0}
    got = {r.doc_id: r.n_removed for r in substring_dedup(df, width=20).collect()}
    assert got == {1: 0, 2: 0, 3: 29, 4: 0, 5: 0}
