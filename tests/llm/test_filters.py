"""Operators 3, 4, 8, 9 and the pipeline on small tables."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa

import corpus_pipeline
from docmart.llm import attention as A
from docmart.llm import kernels as K
from docmart.llm import quality_rules as Q
from docmart.llm.line_dedup import line_dedup
from docmart.llm.mixing import mix_sources

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(r, n):
    return " ".join(r.choice(["the", "of", "élan", "words,", "and.", "Then", "come"]) + r.choice(["", "", "x", "yz", "qu"]) for _ in range(n))


def junk(r, n):
    return " ".join(r.choice(["AB", "cd", "E"]) + r.choice(["***", "!!", "$$$", "###"]) for _ in range(n))


# 3


def labelled(spark, n=400):
    r = random.Random(3)
    rows, labels = [], []
    for k in range(n):
        good = r.random() < 0.7
        text = prose(r, r.randint(20, 900)) if good else prose(r, 130) + " " + junk(r, r.randint(200, 500))
        rows.append((k, text, "s"))
        labels.append((k, int(good), 0))
    rows += [(n, None, "s"), (n + 1, "", None), (None, "x", "s"), (0, rows[0][1], "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(1, None, 0), (None, 1, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")


def test_training_takes_whole_documents(spark, monkeypatch):
    """Passages after the 64th take part; a bound on passages leaves documents out, whole."""
    r = random.Random(6)
    long = [" ".join(["word"] * 128 * 66 + [prose(r, 600) if k % 2 else junk(r, 600)]) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(A, "fit", lambda x, at, y: seen.append((x, at, y)))
    A.train(docs, labels)
    x, at, y = seen.pop()
    assert set((at[1:] - at[:-1]).tolist()) == {71}
    A.train(docs, labels, train_passages=10 * 71 + 5)
    assert (seen[0][1][1:] - seen[0][1][:-1]).tolist() == [71] * 10


def test_classifier_on_held_out_documents(spark):
    docs, labels = labelled(spark)
    got = A.quality_scores(docs, labels).collect()
    assert len(got) == 404 and all(0 <= g.score <= 1 for g in got)
    assert all(g.held_out == (g.doc_id is not None and crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    truth = {x.doc_id: x.quality for x in labels.collect() if x.quality in (0, 1)}
    held = [g for g in got if g.held_out and g.doc_id in truth]
    assert sum(g.predicted == truth[g.doc_id] for g in held) / len(held) > 0.95
    kept = A.filter_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == sorted(g.doc_id for g in got if g.doc_id is not None and g.predicted)


def test_classifier_without_labels(spark):
    docs, labels = labelled(spark, 20)
    assert len({g.score for g in A.quality_scores(docs, labels.limit(0)).collect()}) == 1
    assert A.quality_scores(docs.limit(0), labels).count() == 0


def plain_score(model, x):
    """The forward pass for one bag, written out."""
    p = {k: v.tolist() for k, v in model.p.items()}
    dot = lambda v, m, j: sum(a * row[j] for a, row in zip(v, m))
    hs, es = [], []
    for row in x.tolist():
        row = [(a - m) / s for a, m, s in zip(row, model.mean.tolist(), model.scale.tolist())]
        h = [math.tanh(dot(row, p["w"], j) + p["b"][j]) for j in range(len(p["b"]))]
        es.append(sum(math.tanh(dot(h, p["v"], j)) / (1 + math.exp(-dot(h, p["u"], j))) * p["a"][j] for j in range(len(p["a"]))))
        hs.append(h)
    total = sum(math.exp(e) for e in es)
    bag = [sum(math.exp(e) / total * h[j] for e, h in zip(es, hs)) for j in range(len(p["b"]))]
    return 1 / (1 + math.exp(-(sum(b * z for b, z in zip(bag, p["z"])) + p["z0"][0])))


def small_model(r, width, hidden=4, gates=3):
    shape = {"w": (width, hidden), "b": (hidden,), "v": (hidden, gates), "u": (hidden, gates), "a": (gates,), "z": (hidden,), "z0": (1,)}
    return A.Model(r.random(width), r.random(width) + 0.5, {k: r.normal(0, 0.5, s) for k, s in shape.items()})


def test_forward_pass_and_gradients():
    r = np.random.Generator(np.random.PCG64(1))
    model, at, y = small_model(r, 5), np.array([0, 1, 4, 9]), np.array([1.0, 0.0, 1.0])
    x = r.random((9, 5))
    assert np.allclose(model.score(x, at), [plain_score(model, x[i:j]) for i, j in zip(at, at[1:])], atol=1e-8)
    loss = lambda: -np.mean([math.log(s if t else 1 - s) for s, t in zip([plain_score(model, x[i:j]) for i, j in zip(at, at[1:])], y)])
    for k, got in model.gradients(x, at, y).items():
        for place in np.ndindex(got.shape):
            kept = model.p[k][place]
            model.p[k][place] = kept + 1e-5
            above = loss()
            model.p[k][place] = kept - 1e-5
            below = loss()
            model.p[k][place] = kept
            assert abs((above - below) / 2e-5 - got[place]) < 1e-6, (k, place)


def test_a_text_scores_the_same_in_any_company(spark):
    r = random.Random(8)
    texts = [r.choice([prose, junk])(r, r.choice([1, 30, 127, 128, 400])) + r.choice(["", "!", " ", "\n"]) for _ in range(120)] + ["", None, "x", "x", " "]
    model = small_model(np.random.Generator(np.random.PCG64(2)), A.WIDTH)
    alone = [float(model.score(*A.encode(next(K.slices(pa.array([t], pa.string())))))[0]) for t in texts]
    for limit in (1 << 20, 3000, 500):
        together = np.concatenate([model.score(*A.encode(s)) for s in K.slices(pa.array(texts), limit)])
        assert together.tolist() == alone
    docs, labels = labelled(spark, 120)
    one, many = ({(g.doc_id, g.score) for g in A.quality_scores(docs.repartition(n), labels).collect()} for n in (1, 7))
    assert one == many


def test_passages_cover_the_whole_text():
    s = next(K.slices(pa.array(["a b " * 200, None, " ", "é " * 128])))
    x, at = A.encode(s)
    assert at.tolist() == [0, 4, 5, 6, 7]
    assert [round(math.expm1(v)) for v in x[:, 65]] == [128, 128, 128, 16, 0, 0, 128]


# 4


def facts(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    hit = {p for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for p in range(k, k + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_quality_figures(spark):
    r = random.Random(4)
    texts = [None, "", "\n\n", "a\n\na\n", "x " * 40, "𝒳é# 1", *(r.choice(["\n", " "]).join(r.choices(["a b", "c", "dé|", "e f g h", "\x0b", " "], k=r.randint(0, 60))) for _ in range(200))]
    rows = list(enumerate(texts)) + [(None, "a"), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Q.quality_report(df).collect()
    assert len(got) == len(rows)
    for g in got:
        n, chars, symbols, dup, repeat = facts(texts[g.doc_id] if g.doc_id is not None else "a")
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert g.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (g.kept and g.base_failed)
    verdicts = {g.doc_id: g.kept for g in Q.quality_verdicts(df).collect()}
    assert verdicts == {g.doc_id: g.kept for g in got}


def test_cascade_order():
    rules = (Q.Rule("slow", None), Q.Rule("quick", None), Q.Rule("idle", None))
    measured = [{"rule": "slow", "rejected": 50, "seconds": 10.0}, {"rule": "quick", "rejected": 10, "seconds": 0.1}, {"rule": "idle", "rejected": 0, "seconds": 0.1}]
    assert [r.name for r in Q.ordered(rules, measured)] == ["quick", "slow", "idle"]
    seen = []
    look = lambda name, out: Q.Rule(name, lambda f: (seen.append((name, len(f.n_words))), out(f))[1])
    s = next(K.slices(pa.array(["a", "a b", "a b c"])))
    kept, by = Q.cascade(Q.Facts(s), (look("one", lambda f: f.n_words == 2), look("two", lambda f: f.n_words == 3)))
    assert kept.tolist() == [True, False, False] and by.tolist() == [-1, 0, 1]
    assert seen == [("one", 3), ("two", 2)]


def test_facts_go_along_with_what_is_left():
    s = next(K.slices(pa.array(["A b\nA b", "c", "D e f", ""])))
    f = Q.Facts(s)
    f.n_words, f.n_dup_lines
    rest = f.only(np.array([True, False, True, False]))
    assert {"n_words", "n_dup_lines"} <= set(rest.__dict__)
    assert rest.n_words.tolist() == [4, 3] and rest.n_dup_lines.tolist() == [1, 0] and rest.n_upper.tolist() == [2, 1]


def test_quality_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, kept string, n_words string")
    assert Q.quality_report(empty).count() == 0 and Q.quality_verdicts(empty).count() == 0
    long = "word " * 400_000
    df = spark.createDataFrame([(1, long, "x", "y"), (None, None, None, None), (2, "", "x", "y"), (2, "", "x", "y")], empty.schema)
    got = sorted((g.doc_id or 0, g.n_words, g.n_repeat_words, g.kept) for g in Q.quality_report(df).collect())
    assert got == [(0, 0, 0, False), (1, 400_000, 400_000, False), (2, 0, 0, False), (2, 0, 0, False)]


# 8


def test_mixing_reaches_the_weights(spark):
    rows = [(k, "t", f"s{0 if k < 6000 else 1}" if k % 500 else None) for k in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mix_sources(df, {"s0": 1.0, "s1": 3.0}, target_rows=8000).collect()
    by = Counter(g.source for g in got)
    assert set(by) == {"s0", "s1"}
    assert abs(by["s0"] - 2000) < 200 and abs(by["s1"] - 6000) < 350
    again = mix_sources(df.repartition(7), {"s0": 1.0, "s1": 3.0}, target_rows=8000).collect()
    key = lambda g: (g.doc_id, g.mix_copy, g.mix_order)
    assert sorted(map(key, got)) == sorted(map(key, again))
    copies = Counter(g.doc_id for g in got if g.source == "s1")
    zero = sum(1 for k, _, s in rows if s == "s1" and k not in copies)
    n = sum(1 for _, _, s in rows if s == "s1")
    assert abs(zero / n - math.exp(-6000 / n)) < 0.02


def test_mixing_odd_rows(spark):
    df = spark.createDataFrame([(None, "a", None, 5), (1, None, "s", 6), (1, None, "s", 6)], "doc_id long, text string, source string, mix_copy int")
    got = mix_sources(df, target_rows=400).collect()
    ones = [g for g in got if g.doc_id == 1]
    assert len(got) > 300 and len(ones) % 2 == 0
    assert mix_sources(df.limit(0)).count() == 0


# 9


def test_line_dedup(spark):
    rows = [(k, f"head {k % 2}\nbody {k}\n\nfoot", "h1") for k in range(20)] + [(100, "foot\nfoot", "h2"), (101, None, "h1"), (102, "foot", None), (None, "foot\nx", "h1"), (3, rows_text := "head 1\nbody 3\n\nfoot", "h1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = line_dedup(df, ratio=0.6, min_pages=3).collect()
    assert rows_text and len(got) == len(rows)
    for g in got:
        text = dict((r[0], r[1]) for r in rows)[g.doc_id]
        want = text if g.source != "h1" or text is None else "\n".join(x for x in text.split("\n") if x != "foot")
        assert g.text == want
        assert g.line_total == (0 if text is None else len(text.split("\n")))
    assert line_dedup(df.limit(0)).columns == ["doc_id", "text", "source", "line_total", "line_dropped"]


def test_line_dedup_on_odd_rows(spark):
    rows = [(k, "foot\n\t\n" + ("long " * 100_000 if k == 0 else f"b{k}"), "h", 9, "x") for k in range(12)] + [(1, "foot\n\t\nb1", "h", 9, "x"), (None, "", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, line_total int, name string")
    got = line_dedup(df, ratio=0.5, min_pages=3).collect()
    assert all(g.text == "" if g.doc_id is None else g.text.startswith("\t\n") and g.line_total == 3 and g.line_dropped == 1 for g in got)  # a line of a tab is blank
    kept = line_dedup(df, ratio=0.5, min_pages=3, counts=False)
    assert kept.columns == df.columns and {g.line_total for g in kept.collect()} == {9, None}


# pipeline


def test_pipeline(spark, tmp_path):
    r = random.Random(9)
    docs, labels = [], []
    secret = [prose(r, 40) for _ in range(3)]
    for k in range(260):
        good = k % 4 != 0
        docs.append((k, f"site line\n{prose(r, 150)}" if good else junk(r, 200), "en", f"s{k % 2}", 0))
        labels.append((k, int(good), 0))
    docs[1] = (1, docs[2][1], "en", "s1", 0)
    docs[5] = (5, f"{secret[0]} {prose(r, 60)}", "en", "s1", 0)
    d = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(secret)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    rows = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, d)
        assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    got = {x.doc_id: x for x in rows.collect()}
    assert all("site line" not in x.text and x.n_chars == len(x.text) for x in got.values())
    assert 1 in got and 2 not in got and 5 not in got
    assert len(got) > 180 and sum(k % 4 == 0 for k in got) < 6
    ids = {x.doc_id for x in corpus_pipeline.run(spark, d).collect()}
    assert ids <= set(got) and len(ids) > 90


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty texts, ties, repeated rows, a very long text, and columns that clash with those of the operators."""
    r = random.Random(10)
    schema = "doc_id long, text string, lang string, source string, n_chars long, line_total int, class_id string, score double, a string, row string"
    more = (7, "c", 0.5, "a", "r")
    rows = [(k, prose(r, 120), "en", f"s{k % 2}", 1, *more) for k in range(80)] + [(100 + k, junk(r, 150), "en", "s0", 1, *more) for k in range(30)]
    odd = [(None, prose(r, 90), None, None, None, *[None] * 5), (200, None, "en", "s0", None, *more), (201, "", "en", None, 0, *more), (202, rows[3][1], "en", "s1", 1, *more), rows[4], rows[4], (203, prose(r, 200_000), "en", "s0", 1, *more), (None, None, None, None, None, *[None] * 5)]
    labels = [(k, 1) for k in range(80)] + [(100 + k, 0) for k in range(30)] + [(None, 1), (3, None)]
    for name, docs in (("some", rows + odd), ("none", [])):
        d = str(tmp_path / name)
        spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, rows[7][1]), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        frame = spark.read.parquet(f"{d}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, d)
            assert frame.columns == [c.split()[0] for c in schema.split(", ")]
        kept = frame.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, frame, d)
        assert last.columns == [*frame.columns, "mix_copy", "mix_order"] and (last.count() > 0) == bool(docs)
        if docs:
            ids = Counter(x.doc_id for x in kept)
            assert ids[4] == 1 and ids[3] == 1 and 202 not in ids and 7 not in ids and ids[203] == 1 and ids[None] >= 1
            assert all((x.line_total, x.class_id, x.score, x.a, x.row) == (more if x.doc_id is not None else (None,) * 5) for x in kept)
            assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in kept)
