"""Operator 11 against a plain shortest path over all repairs."""

import hashlib
import itertools
import random

import pytest

from docmart.llm import structure as S

LETTER = {0: "s", 1: "u", 2: "a", 3: "x"}


def plain(codes, entry=S.START, ends=S.ENDS):
    """Row by row, every state's least (cost, audit), with as many inserts as can help."""
    labels = {entry: (0, "")}

    def inserts(labels):
        for _ in range(3):
            for q, (cost, audit) in list(labels.items()):
                new = (cost + 5, audit + "I")
                if new < labels.get(S.NEXT[q], (1 << 60, "")):
                    labels[S.NEXT[q]] = new
        return labels

    labels = inserts(labels)
    for code in codes:
        initial, fault, after = code & 3, code >> 2, {}
        for q, (cost, audit) in labels.items():
            ways = [(q, cost + 2, "D")]
            if fault < 2:
                ways.append((S.NEXT[q], cost + 1 + 5 * fault, "R"))
                if q in S.KEEP[initial]:
                    ways.append((S.KEEP[initial][q], cost + 5 * fault, "K"))
            for p, c, e in ways:
                after[p] = min(after.get(p, (1 << 60, "")), (c, audit + e))
        labels = inserts(after)
    return min((labels[q] for q in ends if q in labels), default=None)


def test_all_short_conversations():
    """All codes of up to three rows, which have many ties."""
    for n in range(4):
        for codes in itertools.product((0, 1, 2, 3, 5, 6, 8), repeat=n):
            assert S.search(bytes(codes)) == plain(codes)


@pytest.mark.parametrize("seed", range(4))
def test_search_and_joined_runs(seed):
    r = random.Random(seed)
    for _ in range(150):
        codes = bytes(r.choice((0, 1, 1, 2, 2, 3, 4, 5, 6, 9, 13)) for _ in range(r.randint(0, 40)))
        want = plain(codes)
        assert S.search(codes) == want
        cuts = sorted(r.sample(range(len(codes) + 1), min(len(codes), r.randint(0, 5))))
        parts = [S.between(codes[a:z]) for a, z in zip([0, *cuts], [*cuts, len(codes)])]
        assert min(v for v in (S.joined(parts)[x] for x in S.ENDS) if v) == want


def repaired(rows):
    """One conversation's report and lines, by hand."""
    rows = [(t, role if role is not None else " ", text if text is not None else " ") for t, role, text in rows]
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))
    seen, codes = set(), []
    for _, role, text in rows:
        ends = text.rstrip(S.WHITE)
        fault = S.BLANK if not ends else S.REPEAT if (role, text) in seen else S.CUT_OFF if ends[-1] not in ".!?" else S.FINE
        seen.add((role, text))
        codes.append("sua".find(role[:1] or "x") % 4 + 4 * fault)
    faults = [c >> 2 for c in codes]
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = plain(codes)
    lines, left, odd, place = [], list(rows), sum(e != "D" for e in audit) % 2, 0
    for e in audit:
        row = left.pop(0) if e != "I" else None
        if e != "D":
            role = row[1] if e == "K" else ("user", "assistant")[(place - odd) % 2]
            lines.append(f"{role}:{row[2] if row else ''}")
            place += 1
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, faults.count(3), faults.count(2), faults.count(1), illegal, cost, audit), "\n".join(lines)


def check(spark, rows, more=()):
    df = spark.createDataFrame([(*x, *more) for x in rows], "conv_id long, turn long, role string, text string" + (", at long, code string, n int" if more else "")).repartition(5)
    turns, report = S.repair(df)
    got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
    hashes = {r.conv_id: r.repaired_sha256 for r in S.digests(turns).collect()}
    assert set(got) == {x[0] for x in rows}
    for c in got:
        want, text = repaired([x[1:] for x in rows if x[0] == c])
        assert got[c] == want
        assert hashes.get(c, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(text.encode()).hexdigest()


def test_conversations(spark, monkeypatch):
    """Odd rows, also with runs of three rows, so that most conversations are cut and joined."""
    r = random.Random(3)
    texts = ["Yes.", "no", "", " \t", None, "Why?", "Ünü.  ", "a\nb!"]
    rows = [(c, r.choice([0, 1, 2, 3, 4, 9, None]), r.choice(["user", "assistant", "system", "tool", "", None]), r.choice(texts)) for c in [*range(25), None] for _ in range(r.randint(1, 12))]
    check(spark, rows)
    monkeypatch.setattr(S, "BLOCK", 3)
    check(spark, rows, (1, "x", None))


def test_hot_conversation(spark, monkeypatch):
    """A third of all rows in one conversation, and one row repeated as often; a very long text."""
    monkeypatch.setattr(S, "BLOCK", 64)
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}." if t % 7 else "t") for t in range(600)]
    rows += [(2, 0, "user", "same.")] * 600 + [(3 + t, t, "user", "x" * (300_000 if t == 5 else 3) + ".") for t in range(600)]
    check(spark, rows)


def test_empty_table(spark):
    turns, report = S.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert turns.count() == report.count() == S.digests(turns).count() == 0


def test_damage(spark):
    """Dropped conversations are told, and the query's whole result agrees with SQL (tests/test_queries.py of the driver)."""
    rows = [(c, t, "user", "Hm. So?") for c in range(60) for t in range(3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    import zlib

    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else text.replace(".", "").replace("?", "") if kind == 2 else text)
            want += [row] * (2 if kind == 3 else 1)
    key = lambda x: tuple((v is not None, v or 0) if k < 2 else v for k, v in enumerate(x))
    assert sorted(map(tuple, S.damaged(df).collect()), key=key) == sorted(want, key=key)
