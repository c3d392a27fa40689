"""Every stage of the pipeline against a plain version of it, each on what its predecessor has kept."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import test_decontamination
import test_minhash
from test_filters import junk, prose

import corpus_pipeline
from docmart.llm.attention import quality_scores

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lines(rows):
    pages, of = Counter(r.source for r in rows), defaultdict(Counter)
    for r in rows:
        of[r.source].update({x for x in (r.text or "").split("\n") if x.strip()})
    gone = {(s, x) for s, c in of.items() for x, n in c.items() if n >= 5 and n / pages[s] > 0.05}
    return {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x) not in gone) if r.text is not None else None for r in rows}


def copies(rows):
    """How often each id comes out: the Poisson distribution of each source's mean, inverted at the hash of the id."""
    n = Counter(r.source or "" for r in rows)
    out = {}
    for r in rows:
        rate = len(rows) / len(n) / n[r.source or ""]
        draws = math.ceil(rate / 16)
        total = 0
        for j in range(1, draws + 1):
            u = int(hashlib.md5(f"20240901:{r.doc_id}:{j}".encode()).hexdigest()[:13], 16) / (1 << 52)
            p, k = math.exp(-rate / draws), 0
            below = p
            while below <= u and k < 95:
                k += 1
                p *= rate / draws / k
                below += p
            total += k
        out[r.doc_id] = total
    return out


def test_every_stage(spark, tmp_path):
    r = random.Random(21)
    secret = [prose(r, 30) for _ in range(4)]
    docs = []
    for k in range(180):
        text = junk(r, 150) if k % 5 == 0 else f"site {k % 2}\n{prose(r, r.randint(60, 160))}\nfoot {k}"
        docs.append((k, text, "en", f"s{k % 3 % 2}", len(text)))
    for k in (11, 46, 102):  # near copies, with one word changed
        words = docs[k][1].split(" ")
        words[20] = "changed"
        docs.append((200 + k, " ".join(words), "en", "s0", 0))
    docs += [(400 + k, f"{prose(r, 20)} {s} {prose(r, 60)}", "en", "s1", 0) for k, s in enumerate(secret)] + [(500, None, "en", "s0", None), (501, "", "en", "s1", 0), (502, "two words", "en", None, 9)]
    d = str(tmp_path)
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, int(k % 5 != 0)) for k in range(180)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    items = [(k, s) for k, s in enumerate(secret)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    before = spark.read.parquet(f"{d}/documents.parquet")
    texts = lambda rows: {x.doc_id: x.text for x in rows}

    def run(name, frame):
        path = f"{d}/{name}"
        stages[name](spark, frame, d).write.parquet(path)
        frame = spark.read.parquet(path)
        return frame, frame.collect()

    scores = {x.doc_id: x.score for x in quality_scores(before, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    frame, rows = run("quality", before)
    assert texts(rows) == {k: t for k, t, *_ in docs if scores[k] >= 0.3} and 140 < len(rows) < 170

    want = lines(rows)
    frame, rows = run("lines", frame)
    assert texts(rows) == want and sum(x.startswith("site") for x in want.values() if x) < 5

    classes, _ = test_minhash.brute_classes(frame, [(x.doc_id, x.text) for x in rows])
    want = {k: t for k, t in texts(rows).items() if classes.get(k, k) == k}
    frame, rows = run("near_duplicates", frame)
    assert texts(rows) == want and not {211, 246, 302} & set(want)

    bad = {k for k, g in test_decontamination.brute(list(want.items()), items).items() if g[-1]}
    frame, rows = run("decontamination", frame)
    assert texts(rows) == {k: t for k, t in want.items() if k not in bad} and {400, 401, 402, 403} & set(want) == bad

    want = copies(rows)
    frame, rows = run("mixing", frame)
    assert Counter(x.doc_id for x in rows) == Counter({k: n for k, n in want.items() if n})
    assert sorted((x.doc_id, x.mix_copy) for x in rows) == sorted((k, c) for k, n in want.items() for c in range(1, n + 1))


def test_near_duplicates_go_whatever_a_bucket_needs(spark, monkeypatch):
    """The stage keeps the same rows whether its buckets are compared in full or replaced by smaller ones."""
    rows = [(k, t, "en", "s", len(t)) for k, t in test_minhash.pairs_in_one_bucket(monkeypatch, 60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for compared in (test_minhash.M.COMPARED, 1000):
        monkeypatch.setattr(test_minhash.M, "COMPARED", compared)
        assert sorted(corpus_pipeline.near_duplicates(spark, df, "").collect()) == rows[::2]


def test_near_duplicates_at_the_bound_go_whatever_a_bucket_needs(spark, monkeypatch):
    """As above, with pairs of a similarity of exactly the least that links."""
    rows = [(k, t, "en", "s", len(t)) for k, t in test_minhash.pairs_at_the_bound(monkeypatch)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for compared in (test_minhash.M.COMPARED, 1000):
        monkeypatch.setattr(test_minhash.M, "COMPARED", compared)
        assert sorted(corpus_pipeline.near_duplicates(spark, df, "").collect()) == [x for x in rows if x[0] >= 60 or x[0] % 2 == 0]
