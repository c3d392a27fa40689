"""Operator 1 against all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docmart.llm import kernels as K
from docmart.llm import minhash as M


def test_samples_agree_as_weighted_jaccard_says():
    r = np.random.Generator(np.random.PCG64(3))
    name = r.integers(0, 1 << 63, 600, dtype=np.uint64)
    wa, wb = r.gamma(2, 1, 600) + 0.1, r.gamma(2, 1, 600) + 0.1
    wb[:450] = wa[:450]
    j = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    doc = np.repeat([0, 1], 600)
    drawn = M.samples(doc, np.concatenate((name, name)), np.concatenate((wa, wb)), 400)
    assert abs((drawn[:, 0] == drawn[:, 1]).mean() - j) < 0.07


def test_shingles_of_short_texts_and_places():
    s = next(K.slices(pa.array(["a b", "", "x y z u v w", "a b", "p x y z u v w"])))
    idf = np.linspace(1, 9, 1 << M.DF_BITS).astype(np.float32)
    doc, name, weight = M.weighted_shingles(M._words(s), idf, 5)
    assert doc.tolist() == [0, 2, 2, 3, 4, 4, 4]
    assert name[0] == name[3] and weight[0] == weight[3]
    assert set(zip(name[1:3].tolist(), weight[1:3].tolist())) < set(zip(name[4:].tolist(), weight[4:].tolist()))


def classes(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    links = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(90)] + [(k, k + 1) for k in range(200, 230)]
    got = {x.node: x["class"] for x in M.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links for n in (a, b) if a != b}
    want = classes([(a, b) for a, b in links if a != b], nodes)
    assert got == want


def test_near_copies(spark):
    r = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(12):
        base = r.choices(vocabulary, k=r.choice([60, 200, 500]))
        for _ in range(r.choice([1, 2, 4, 9])):
            w = list(base)
            for _ in range(max(1, len(w) // 100)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append(" ".join(w))
        rows.append(" ".join(base).upper() + "!")
    rows += ["", "?", "two words", "Two, words", rows[0]]
    r.shuffle(rows)
    table = list(enumerate(rows)) + [(500, None), (None, rows[0]), (7, rows[7])]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    out = M.near_duplicates(df).collect()
    assert len(out) == len(table)
    got = {x.doc_id: x.class_id for x in out if x.doc_id is not None}
    idf = M.inverse_frequencies(df.where("doc_id is not null").select("doc_id", "text"))
    weights = {}
    for s in K.slices(pa.array([t for _, t in table[:-3]])):
        for d, n, w in zip(*M.weighted_shingles(M._words(s), idf, 5)):
            weights.setdefault(int(s.rows[d]), {})[int(n)] = w
    sure, open_ = [], []
    for a, x in weights.items():
        for b in weights:
            if b < a:
                y = weights[b]
                least = sum(min(w, y[n]) for n, w in x.items() if n in y)
                j = least / (sum(x.values()) + sum(y.values()) - least)
                if j >= 0.8:
                    sure.append((a, b))
    assert len(sure) > 30
    want = classes(sure, range(len(rows))) | {500: 500}
    assert got == want


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, bands string")
    assert M.near_duplicates(empty).count() == 0
    assert M.drop_near_duplicates(empty).columns == empty.columns


def brute_classes(df, rows):
    """Classes of (id, text) rows by the exact similarity of all pairs, and the linked pairs."""
    idf = M.inverse_frequencies(df)
    weights = {}
    for s in K.slices(pa.array([t for _, t in rows])):
        for d, n, w in zip(*M.weighted_shingles(M._words(s), idf, 5)):
            weights.setdefault(rows[int(s.rows[d])][0], {})[int(n)] = w
    total = {a: sum(x.values()) for a, x in weights.items()}
    links = []
    for a, x in weights.items():
        for b, y in weights.items():
            if b < a and min(total[a], total[b]) >= 0.8 * max(total[a], total[b]):
                least = sum(min(x[n], y[n]) for n in x.keys() & y.keys())
                if least >= 0.8 * (total[a] + total[b] - least):
                    links.append((a, b))
    return classes(links, weights), links


def changed(r, words, at, vocabulary):
    """The words with those at the given places replaced."""
    out = list(words)
    for k in at:
        out[k] = r.choice(vocabulary)
    return out


def chains(copies, count):
    """A group of copies of A, and chains A-B-C where only B is like A."""
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(900)]
    a = r.choices(vocabulary, k=400)
    rows = [changed(r, a, [r.randrange(400)], vocabulary) for _ in range(copies)]
    for _ in range(count):
        b = changed(r, a, r.sample(range(0, 200, 5), 6), vocabulary)
        rows += [b, changed(r, b, r.sample(range(200, 400, 5), 6), vocabulary)]
    return list(enumerate(" ".join(w) for w in rows))


def test_chains_beside_a_large_group(spark):
    rows = chains(300, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, _ = brute_classes(df, rows)
    got = {x.doc_id: x.class_id for x in M.near_duplicates(df).collect()}
    assert sum(c == want[0] for c in want.values()) > 360
    assert sum(got[n] != want[n] for n in want) <= 1  # a link of about 0.8 that sampling misses


def test_bands_of_texts_with_passages_appended(spark):
    """Of pairs of similarity 0.8 to 0.85, where one text has the other and more, nearly all share a band."""
    r = np.random.Generator(np.random.PCG64(8))
    rows = []
    for pair in range(3000):
        more = 36 + pair % 15  # of 200 shingles before
        name, weight = r.integers(0, 1 << 63, 200 + more, dtype=np.uint64), np.ones(200 + more)
        doc = np.concatenate((np.zeros(200, np.int64), np.ones(200 + more, np.int64)))
        drawn = M.samples(doc, np.concatenate((name[:200], name)), np.concatenate((weight[:200], weight)), M.SAMPLES)
        rows += [(pair, side, drawn[:, side].astype(np.uint32).view(np.int32).tolist()) for side in (0, 1)]
    df = spark.createDataFrame(rows, "pair long, side int, drawn array<int>")
    keys = df.select("pair", "side", F.explode(M.band_keys(F.col("drawn"))).alias("key"))
    met = keys.groupBy("pair", "key").agg(F.countDistinct("side").alias("n")).where("n = 2").select("pair").distinct().count()
    assert met >= 3000 * 0.994


def test_refined_buckets_keep_pairs_together(spark):
    r = np.random.Generator(np.random.PCG64(9))
    rows = []
    for pair in range(4000):
        x = r.integers(0, 1 << 30, M.SAMPLES)
        y = np.where(r.random(M.SAMPLES) < 0.8, x, x + 1)
        rows += [(pair, side, z.tolist()) for side, z in enumerate((x, y))]
    df = spark.createDataFrame(rows, "pair long, side int, drawn array<int>")
    keys = df.select("pair", "side", F.explode(M.refined_keys(F.col("drawn"), F.col("pair"), 1)).alias("key"))
    met = keys.groupBy("pair", "key").agg(F.countDistinct("side").alias("n")).where("n = 2").select("pair").distinct().count()
    assert met >= 4000 * 0.99


def test_chains_in_refined_buckets(spark, monkeypatch):
    """As beside a large group, with a bound that only small buckets keep."""
    monkeypatch.setattr(M, "COMPARED", 2000)
    rows = chains(100, 20)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, _ = brute_classes(df, rows)
    got = {x.doc_id: x.class_id for x in M.near_duplicates(df).collect()}
    assert sum(got[n] != want[n] for n in want) <= 1


def test_refined_buckets_lose_no_pair(spark, monkeypatch):
    """In a bucket far above the bound, all pairs that share enough samples are met, and each is verified in one place."""
    r = np.random.Generator(np.random.PCG64(14))
    family = r.integers(0, 1 << 30, (40, M.SAMPLES))
    family[:, :10] = family[0, :10]
    drawn = np.where(r.random((480, M.SAMPLES)) < 0.8, family[np.arange(480) % 40], r.integers(0, 1 << 30, (480, M.SAMPLES))).astype(np.int32)
    drawn[:, M.BANDS[2]] = 7
    table = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(drawn)], "doc long, drawn array<int>")
    label = spark.createDataFrame([(k, 5) for k in range(0, 480, 9)], "node long, class long")
    left, _ = M.unsettled(table.select("doc", F.lit(1).alias("key"), F.lit(2).alias("band"), F.lit(100).alias("bytes")), label)
    c = np.where(np.arange(480) % 9 == 0, 5, np.arange(480))
    shared = (drawn[:, None] == drawn[None]).sum(2)
    want = np.triu((shared >= M.AGREE) & (c[:, None] != c[None]), 1)
    before = (drawn[:, None][..., M.BANDS[:2]] == drawn[None][..., M.BANDS[:2]]).all(3).any(2)
    assert want.sum() > 1000 and 0 < (want & before).sum() < want.sum() / 2
    for compared in (1 << 28, 50_000, 300):
        monkeypatch.setattr(M, "COMPARED", compared)
        buckets = {}
        for x in M.refined(left, label, table).collect():
            buckets.setdefault(x.key, []).append(x)
        met, taken = np.zeros((480, 480), int), np.zeros((480, 480), int)
        for rows in buckets.values():
            docs = np.array([x.doc for x in rows])
            met[docs[:, None], docs[None]] = 1
            every = M.Members(docs, c[docs], np.array([x.is_open for x in rows]), drawn[docs], np.array([x.seen for x in rows]))
            own = every.pick(np.flatnonzero(every.is_open))
            np.add.at(taken, (own.doc[:, None], docs[None]), M.to_verify(own, every, rows[0].band))
        assert (met >= want).all()
        assert (np.triu(taken + taken.T, 1) == (want & ~before)).all()
        assert (len(buckets) == 1) == (compared == 1 << 28)


def pairs_in_one_bucket(monkeypatch, count):
    """Texts by twos that are alike, all in one bucket, where two share just enough of the samples that stand in for theirs."""

    def drawn(doc):
        draw, twins = np.random.Generator(np.random.PCG64([17, doc])), np.random.Generator(np.random.PCG64([18, doc // 2]))
        out = draw.integers(0, 1 << 30, M.SAMPLES)
        free = np.setdiff1d(np.arange(M.SAMPLES), M.BANDS[0])
        same = M.BANDS[1]
        while any(set(own) <= {*same, *M.BANDS[0]} for own in M.BANDS[1:].tolist()):  # the two share no other bucket
            same = twins.permutation(free)[: M.AGREE - M.ROWS]
        out[same] = twins.integers(0, 1 << 30, len(same))
        out[M.BANDS[0]] = 10
        return out.tolist()

    def sketch(idf, size):
        def run(batches):
            for b in batches:
                docs = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((docs, docs, docs, [400] * len(docs), [drawn(d) for d in docs]), M._SKETCH, strict=True)], schema=M._SKETCH)

        return run

    monkeypatch.setattr(M, "_sketch", sketch)
    r = random.Random(18)
    rows = []
    for k in range(count):
        words = r.choices([f"w{k}" for k in range(900)], k=80)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words, "more"]))]
    return rows


def test_pairs_with_just_enough_samples_in_a_large_bucket(spark, monkeypatch):
    rows = pairs_in_one_bucket(monkeypatch, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for compared in (M.COMPARED, 1000):
        monkeypatch.setattr(M, "COMPARED", compared)
        assert {x.doc_id: x.class_id for x in M.near_duplicates(df).collect()} == {k: k - k % 2 for k, _ in rows}


def pairs_at_the_bound(monkeypatch):
    """Texts by twos in one bucket, one the first four fifths of the other, and texts like no other; each word is in two texts, so all weigh the same."""
    pairs_in_one_bucket(monkeypatch, 0)
    words = [f"w{k}" for k in range(7000)]
    terms = M._term(M._words(next(K.slices(pa.array([" ".join(words)])))).hashes())
    words = iter([words[k] for k in np.unique(terms, return_index=True)[1]])
    rows = []
    for pair in range(30):
        k = (5, 16, 17, 18, 19)[pair % 5]
        long = [next(words) for _ in range(10 * k + 4)]
        sides = [long, long[: 8 * k + 4]][:: 1 if pair % 2 else -1]
        rest = long[8 * k + 4 :][::-1]
        apart = [rest[:k], rest[k:]]
        rows += [(at + side, " ".join(x[side])) for at, x in ((2 * pair, sides), (2 * pair + 60, apart)) for side in (0, 1)]
    return sorted(rows)


def test_pairs_at_the_bound_are_linked_whatever_a_bucket_needs(spark, monkeypatch):
    rows = pairs_at_the_bound(monkeypatch)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for compared in (M.COMPARED, 1000):
        monkeypatch.setattr(M, "COMPARED", compared)
        assert {x.doc_id: x.class_id for x in M.near_duplicates(df).collect()} == {k: k - k % 2 if k < 60 else k for k, _ in rows}


def test_similarity_is_exact_from_either_side():
    for k in range(2, 40):
        for weight in (2.3077, 4.2958, 4.6972, 5.3862):
            sides = [(np.arange(n * k, dtype=np.uint64), np.full(n * k, weight)) for n in (10, 8)]
            for (name, own), (other, its) in (sides, sides[::-1]):
                others = M.Others()
                others.add(1, 1, True, None, other, its)
                others.ready(False)
                assert others.similarity(name, own).tolist() == [0.8]


def dense_classes(df, rows):
    """As brute_classes, by one dense table of weights."""
    idf = M.inverse_frequencies(df)
    s = next(K.slices(pa.array([t for _, t in rows]), 1 << 30))
    doc, name, weight = M.weighted_shingles(M._words(s), idf, 5)
    names, column = np.unique(name, return_inverse=True)
    table = np.zeros((len(rows), len(names)))
    table[doc, column] = weight
    total = table.sum(1)
    links = []
    for a in range(len(rows)):
        own = np.flatnonzero(table[a])
        least = np.minimum(table[:a, own], table[a, own]).sum(1)
        links += [(a, int(b)) for b in np.flatnonzero(least >= 0.8 * (total[:a] + total[a] - least))]
    return classes(links, range(len(rows))), links


def test_a_group_of_over_a_thousand(spark, monkeypatch):
    """Copies with 0 to 9 changed words around one text: many linked to the middle, many to each other only, many to none."""
    r = random.Random(6)
    vocabulary = [f"w{k}" for k in range(2000)]
    base = r.choices(vocabulary, k=240)
    rows = [changed(r, base, r.sample(range(240), r.randint(0, 9)), vocabulary) for _ in range(1200)]
    rows = list(enumerate(" ".join(w) for w in rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, _ = dense_classes(df, rows)
    assert 300 < Counter(want.values()).most_common(1)[0][1] < 1150
    for blocks in ((256, 512, 1024), (32, 64, 128)):
        monkeypatch.setattr(M, "GROUP", blocks[0])
        monkeypatch.setattr(M, "OPEN_BLOCK", blocks[1])
        monkeypatch.setattr(M, "BLOCK", blocks[2])
        got = {x.doc_id: x.class_id for x in M.near_duplicates(df).collect()}
        assert sum(got[n] != want[n] for n in want) <= 3  # links of about 0.8 that sampling misses


def test_blocks_send_each_pair_once():
    r = np.random.Generator(np.random.PCG64(4))
    drawn = r.integers(0, 50, (30, M.SAMPLES)).astype(np.int32)
    drawn[15:] = np.where(r.random((15, M.SAMPLES)) < 0.85, drawn[:15], drawn[15:])
    doc = np.arange(30)
    x = M.Members(doc, doc, np.ones(30, bool), drawn)
    band = lambda i, j: {k for k, own in enumerate(M.BANDS) if (drawn[i, own] == drawn[j, own]).all()}
    taken = sum(M.to_verify(x, x, k).astype(int) * np.array([[k in band(i, j) for j in range(30)] for i in range(30)]) for k in range(len(M.BANDS)))
    agree = (drawn[:, None] == drawn[None]).sum(2) >= M.AGREE
    want = np.array([[i < j and agree[i, j] and bool(band(i, j)) for j in range(30)] for i in range(30)])
    assert want.sum() > 10 and (taken == want).all()


def test_draws_of_texts_with_more_shingles_than_the_pool():
    r = np.random.Generator(np.random.PCG64(12))
    name = r.integers(0, 1 << 63, 300_000, dtype=np.uint64)
    doc = np.repeat([0, 1], 270_000)
    drawn = M.samples(doc, np.concatenate((name[:270_000], name[30_000:])), np.full(540_000, 3.0), 200)
    assert abs((drawn[:, 0] == drawn[:, 1]).mean() - 0.8) < 0.09
