"""Operator 7: positions against Python's own matching, and the ledger's increments."""

import random
import re

from docmart.llm.secrets import BASE, RULES, Ledger, Rule, scan_secrets


def expected(text, rules):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text, re.ASCII):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), k, m.end(), r.kind))
    return sorted(out)


def texts():
    r = random.Random(4)
    parts = ["token = ", "api-key:", "API_KEY='", "Secret: ", "password=secret:", "passwd : \"", "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef" * 4, "é\n", "𝒳 ", "x" * 11, "abcDEF123456+/", "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh-_", "ghp_" + "a1" * 12, "Z" * 20, "  ", "=="]
    return ["".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(150)] + ["", "a" * 40000, "token=" * 3000]


def test_positions(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([*rows, (None, None), (3, rows[3][1])], "doc_id long, text string").repartition(3)
    by_path, _, scanned = scan_secrets(df)
    got = by_path.collect()
    assert len(got) == len(rows) + 2
    for g in got:
        want = expected(rows[g.path][1] if g.path is not None else "", RULES)
        assert [(x.begin, x.rule_no, x.end, x.kind) for x in g.findings] == want
    assert scanned.count() == len({t for _, t in rows}) * len(RULES)


def test_ledger(spark):
    first = spark.createDataFrame([(1, "token = abcdefghijkl"), (2, "nothing")], "doc_id long, text string")
    _, found, ledger = scan_secrets(first, rules=BASE)
    found, ledger = spark.createDataFrame(found.collect(), found.schema), spark.createDataFrame(ledger.collect(), ledger.schema)
    second = spark.createDataFrame([(1, "token = abcdefghijkl"), (3, "token = abcdefghijkl"), (4, "0123456789abcdef")], "doc_id long, text string")
    by_path, all_found, scanned = scan_secrets(second, ledger, found, BASE)
    assert scanned.count() == len(BASE)  # the one new blob
    assert {r.path: [x.kind for x in r.findings] for r in by_path.collect()} == {1: ["assign"], 3: ["assign"], 4: ["hex"]}
    newer = (*BASE[:2], Rule("hex", r"[0-9a-f]{12,}", least=12, version=2))
    _, _, scanned = scan_secrets(second, ledger, found, newer)
    assert sorted(r.rule for r in scanned.collect()) == ["access@1", "assign@1", "hex@2", "hex@2"]
    assert scan_secrets(first.limit(0))[0].count() == 0


def test_ledger_in_a_folder(spark, tmp_path):
    """Runs over successive versions scan what is new, a new rule version scans old blobs with that rule alone, and a broken run leaves nothing behind."""
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    schema = "doc_id long, text string, blob string, found int"
    first = spark.createDataFrame([(1, "token = abcdefghijkl", "x", 1), (2, "nothing", "x", 1), (5, None, None, None)], schema)
    kinds = lambda df: {r.path: [x.kind for x in r.findings] for r in df.collect()}
    scanned = lambda: sorted((r.blob[:4], r.rule) for r in ledger.read("scanned", ledger.SCANNED).collect())
    assert ledger.parts() == [] and kinds(ledger.scan(first, BASE)) == {1: ["assign"], 2: [], 5: []}
    assert len(scanned()) == 3 * len(BASE)
    second = spark.createDataFrame([(1, "token = abcdefghijkl0", "x", 1), (3, "token = abcdefghijkl", "x", 1), (4, "0123456789abcd", "x", 1), (4, "0123456789abcd", "x", 1)], schema)
    before = len(scanned())
    assert kinds(ledger.scan(second, BASE)) == {1: ["assign"], 3: ["assign"], 4: []}
    assert len(scanned()) - before == 2 * len(BASE)
    newer = (*BASE[:2], Rule("hex", r"[0-9a-f]{12,}", least=12, version=2))
    before = len(scanned())
    (tmp_path / "ledger" / "broken" / "found").mkdir(parents=True)
    got = kinds(ledger.scan(second, newer))
    assert got == {1: ["assign"], 3: ["assign"], 4: ["hex"]}
    assert {r for _, r in set(scanned())} == {"assign@1", "access@1", "hex@1", "hex@2"} and len(scanned()) - before == 3
    whole = kinds(scan_secrets(second, rules=newer)[0])
    assert whole == got and kinds(ledger.scan(second, newer)) == got
    assert ledger.scan(first.limit(0), newer).count() == 0
