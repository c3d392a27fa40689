"""Operator 2 against a plain search of every window."""

import hashlib
import random
import re

from docmart.llm import decontamination as D
from docmart.llm.decontamination import decontamination_report, filter_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=13):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    lengths = {len(k) for k in windows}
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_against_brute_force(spark):
    r = random.Random(7)
    vocabulary = ["the", "of", "É", "é", "Zug", "a1", "q", "x"]
    for size in (3, 8):
        some = vocabulary[:size]
        items = [(k, " ".join(r.choices(some, k=r.choice([0, 1 if size > 3 else 6, 5, 12, 13, 14, 40])))) for k in range(25)] + [(100, None), (101, "..."), (3, "again the of the of the of")]
        docs = [(d, " ".join(r.choices(some, k=r.randint(0, 120)))) for d in range(60)] + [(200, None), (201, "")]
        docs += [(300 + k, "zz " * r.randint(0, 300) + str(t) + "! yy" * r.randint(0, 9)) for k, (_, t) in enumerate(items)]
        got = decontamination_report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), with_text=True).collect()
        want = brute(docs, items)
        assert {g.doc_id: (g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) for g in got} == want
        assert all(len(words(g.clean_text)) == g.n_words - g.n_hit for g in got)


def test_parts_of_a_large_benchmark(spark):
    """A benchmark cut into parts gives what it gives whole: hits of parts overlap, items are told apart."""
    r = random.Random(17)
    some = ["the", "of", "É", "a1", "q"]
    items = [(k, " ".join(r.choices(some[: r.choice([2, 5])], k=r.choice([5, 13, 14, 30])))) for k in range(40)] + [(3, "once more the of the of"), (None, "the of"), (50, None)]
    docs = [(d, " ".join(r.choices(some, k=r.randint(0, 90)))) for d in range(50)]
    docs += [(100 + k, f"zz {t} yy") for k, (_, t) in enumerate(items)] + [(None, items[0][1]), (7, docs[7][1]), (200, None), (201, "")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, h1 string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    key = lambda rows: sorted((g.doc_id or -1, *g[1:]) for g in rows)
    whole = decontamination_report(df, bench, with_text=True).collect()
    parts = decontamination_report(df, bench, with_text=True, part_bytes=150).collect()
    assert key(whole) == key(parts) and sum(g.contaminated for g in whole) > 20
    kept = [sorted((g.doc_id or -1, g.text or "", g.h1) for g in filter_contaminated(df, bench, part_bytes=n).collect()) for n in (150, 1 << 20)]
    assert kept[0] == kept[1] == sorted((g.doc_id or -1, t or "", "x") for (d, t), g in zip(docs, sorted_like(docs, whole)) if not g.contaminated)


def test_ten_parts_read_the_documents_as_often_as_two(spark, monkeypatch):
    """The documents are scanned a fixed number of times; parts then see the texts that share a mark with them."""
    r = random.Random(5)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(r.choice((1, 4, 13, 30))))) for k in range(60)]
    docs = [(d, " ".join(f"d{r.randint(0, 500)}" for _ in range(60)) + " " + items[d % 60][1] * (d % 4 == 0)) for d in range(200)] + [(None, None), (900, "")] * 30
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t) for _, t in items)
    read, whole = {}, sorted((g.doc_id or -1, g.n_hit, g.items_sha256) for g in decontamination_report(df, bench).collect())
    for parts in (2, 10):
        seen = spark.sparkContext.accumulator(0)

        path = D._text_marks

        def marked(lengths, window, path=path, seen=seen):
            run = path(lengths, window)

            def go(batches):
                for b in batches:
                    seen.add(b.num_rows)
                    yield from run([b])

            return go

        monkeypatch.setattr(D, "_text_marks", marked)
        got = sorted((g.doc_id or -1, g.n_hit, g.items_sha256) for g in decontamination_report(df, bench, part_bytes=-(-size // parts)).collect())
        monkeypatch.setattr(D, "_text_marks", path)
        assert got == whole
        read[parts] = seen.value
    assert read[2] == read[10] == 200


def sorted_like(docs, report):
    by = {(g.doc_id, g.clean_text, g.n_words): g for g in report}
    by_id = {}
    for g in by.values():
        by_id[g.doc_id] = g
    return [by_id[d] for d, _ in docs]


def test_odd_documents(spark):
    item = " ".join(f"w{k}" for k in range(20))
    long = "pad " * 300_000 + item + " pad" * 300_000
    docs = spark.createDataFrame([(1, long, "a", 1), (2, None, "b", 2), (None, item, "c", 3), (4, "", "d", 4), (4, "", "d", 4)], "doc_id long, text string, item_id string, n_hit int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    for part_bytes in (1 << 20, 10):
        got = sorted((g.doc_id or 0, g.n_words, g.n_hit, g.contaminated) for g in decontamination_report(docs, bench, part_bytes=part_bytes).collect())
        assert got == [(0, 20, 20, True), (1, 600_020, 20, False), (2, 0, 0, False), (4, 0, 0, False), (4, 0, 0, False)]
        kept = filter_contaminated(docs, bench, part_bytes=part_bytes)
        assert kept.columns == docs.columns and sorted(g.n_hit for g in kept.collect()) == [1, 2, 4, 4]
        assert filter_contaminated(docs.limit(0), bench, part_bytes=part_bytes).count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {(g.n_words, g.n_hit, g.contaminated) for g in decontamination_report(docs, none).collect()} == {(2, 0, False), (1, 0, False)}
    assert decontamination_report(docs.limit(0), none).count() == 0
