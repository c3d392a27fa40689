"""Operators on small tables."""

import json
import random
import re

import pandas as pd
from pyspark.sql import functions as F

from docmart.functions import extract as E
from docmart.operators import cells as C
from docmart.operators import layout as L
from docmart.operators import mart as M
from docmart.operators import predicates as P
from docmart.operators import reshape as K
from docmart.operators import rules as R
from docmart.operators.predicates import expand_pages


def fields(spark, rows):
    return spark.createDataFrame([(1, "f", i, *r) for i, r in enumerate(rows)], R.FIELDS)


def shown(df):
    return {r.key: r.s if r.kind == "s" else list(r.arr) if r.kind == "a" else [tuple(x) for x in r.kv] for r in df.collect()}


def test_merge_order_and_kinds(spark):
    f = fields(spark, [("a1", "a", None, ["x"], None), ("new", "s", "old", None, None), ("a2", "a", None, ["y"], None), ("d1", "d", None, None, [("k", "1")]), ("d2", "d", None, None, [("k", "2"), ("l", "3")])])
    got = shown(K.merge_keys(f, [("new", ["^a"]), ("d", ["^d"]), ("none", ["zzz"])]))
    assert got == {"new": ["x", "y"], "d": [("k", "2"), ("l", "3")]}
    assert shown(K.merge_keys(f, [("new", ["zzz"])]))["new"] == "old"


def test_clone_takes_the_first_and_runs_in_order(spark):
    f = fields(spark, [("b2", "s", "2", None, None), ("b1", "s", "1", None, None), ("copy", "s", "old", None, None)])
    assert shown(K.clone_keys(f, [("copy", "b"), ("more", "copy")])) == {"b2": "2", "b1": "1", "copy": "2", "more": "2"}


def test_flatten_round_trip(spark):
    f = fields(spark, [("s", "s", "v", None, None), ("d", "d", None, None, [("a", "1"), ("b", "2")]), ("l", "a", None, ["p", "q"], None)])
    assert shown(R.flatten(f)) == {"s": "v", "d.a": "1", "d.b": "2", "l": ["p", "q"]}


def test_failed_extraction_passes_through(spark):
    f = fields(spark, [("benchmark", "s", "none here", None, None)])
    level = [R.Dispatch("bench", "text", {"pattern": r"(\d+)", "full_on_miss": False})]
    assert shown(R.apply_level(f, level)) == {"benchmark": "none here"}


def test_sections_lose_no_line(spark):
    r = random.Random(1)
    rows = [(1, k, r.random() < 0.3, f"Head {r.randint(1, 3)}" if r.random() < 0.5 else f"text {k}") for k in range(60)]
    rows = [(d, k, h, t, not h) for d, k, h, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, ord int, is_header boolean, text string, is_body boolean")
    secs = L.unique_headers(L.section_lines(L.sections(df, ["doc_id"]), ["doc_id"]), ["doc_id"]).collect()
    assert sorted(t for s in secs for t in s.lines) == sorted(t for _, _, h, t, _ in rows if not h)
    assert len({s.header for s in secs}) == len(secs)


def snapped(spans, tolerance=3.0):
    lines, out = [], []
    for n, x, y, t in spans:
        near = min(((abs(b - y), k) for k, b in enumerate(lines)), default=None)
        if near and near[0] <= tolerance:
            b = lines[near[1]]
        else:
            b = y
            lines.append(y)
        out.append((b, x, n, t))
    return sorted(out)


def test_snap_lines(spark):
    r = random.Random(2)
    spans = [(n, float(r.randint(0, 50)), float(r.randint(0, 30)), f"t{n}") for n in range(40)]
    df = spark.createDataFrame([(1, *s) for s in spans], "doc_id long, span_no long, x double, y double, text string")
    got = [(g.baseline, g.x, g.span_no, g.text) for g in L.snap_lines(df, ["doc_id"]).orderBy("line_ord").collect()]
    assert got == snapped(spans)


def test_cells(spark):
    rows = [(1, 0, 0, 0, "T"), (1, 0, 0, 1, "a"), (1, 0, 1, 0, None), (1, 0, 1, 1, "b"), (1, 1, 0, 0, "U"), (1, 1, 0, 1, " ")]
    df = spark.createDataFrame(rows, "doc_id long, table_no int, row_no int, col_no int, text string")
    stacked = C.stack_tables(df, pad=0)
    got = C.collect_by_title(C.fill_titles(stacked)).collect()
    assert [(g.title, list(g.texts)) for g in got] == [("t", ["a", "b"])]


def side_rows(cells, roles, name, open_end, twice):
    """Side tables of cells (doc_id, row_no, col_no, text), document by document."""
    out = {}
    for doc in {c[0] for c in cells if c[0] is not None}:
        own = [c for c in cells if c[0] == doc and c[2] is not None]
        cols = {r: {k for k in {c[2] for c in own} if sum(len(re.findall("|".join(words), t or "")) for _, _, x, t in own if x == k) >= least} for r, (words, least) in roles.items()}
        if open_end and cols[open_end]:
            cols[open_end] = {c[2] for c in own if c[2] >= min(cols[open_end])}
        cols[name] = {min(cols[name])} if cols[name] else set()
        scheme = None
        for n in sorted({c[1] for c in own if any(c[2] in k for k in cols.values())}):
            found = [m[0] for _, x, k, t in own if x == n and k in cols[name] and (m := re.search("red [a-z]+", t or ""))]
            scheme = max(found) if found else scheme
            if scheme is None:
                continue
            for r in roles.keys() - {name}:
                text = " ".join(t or "" for _, x, k, t in sorted(own, key=lambda c: (c[2], c[3] or "")) if x == n and k in cols[r])
                out.setdefault((doc, scheme), {}).setdefault(r, []).extend([text, f"{max(found)} {text}"] if found and twice else [text])
    return out


def test_side_table_by_brute_force(spark):
    """Columns with several roles or none, an open end, null cells and names that change, against each document on its own."""
    r = random.Random(5)
    cells = [(d, n, k, r.choice([None, "red ant", "red bee", "brand 7", "12", "x red", "brand red cow", "plain", ""])) for d in range(25) for n in range(r.randint(1, 5)) for k in range(4) if r.random() < 0.8]
    cells += [(3, 0, None, "brand red ant"), (None, 0, 0, "red ant"), (99, 0, 0, None)]
    df = spark.createDataFrame(cells, "doc_id long, row_no int, col_no int, text string")
    roles = {"name": (["red"], 2), "brand": (["brand"], 1), "size": ([r"^\d+$", "plain"], 1)}
    for open_end, twice in ((None, False), ("size", True), ("brand", False)):
        got = C.side_table(df, roles, "name", "red [a-z]+", open_end=open_end, twice=twice).collect()
        assert {(g.doc_id, g.scheme): {"brand": list(g.brand), "size": list(g["size"])} for g in got} == side_rows(cells, roles, "name", open_end, twice)


def test_two_sources(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "name string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 4)], "name string, v int")
    assert sorted(map(tuple, M.diff_sources(a, b, "name", ["v"]).collect())) == [("y", "v", "2", "3"), ("z", "v", None, "4")]


def test_page_ranges(spark):
    assert spark.range(1).select(expand_pages(F.lit("3,4, 6-8,x,4,9-7"))).first()[0] == [3, 4, 6, 7, 8]


def test_registered_extractors_dispatch(spark):
    """A registered extractor, a list one and a pandas one, through a level of dispatch."""
    E.register_extractor("upper", lambda c, rule: F.upper(c))
    E.register_extractor("chars", lambda c, rule: F.split(c, ""), kind="a")

    def backwards(text: pd.Series, rule: pd.Series) -> pd.Series:
        return text.str[::-1] + rule.map(lambda r: json.loads(r)["end"])

    E.register_pandas_extractor("reversed", backwards)
    f = fields(spark, [("name", "s", "abc", None, None), ("list", "s", "xy", None, None), ("back", "s", "abc", None, None), ("other", "s", "z", None, None)])
    level = [R.Dispatch("name", "upper"), R.Dispatch("list", "chars"), R.Dispatch("back", "reversed", {"end": "!"})]
    assert shown(R.apply_level(f, level)) == {"name": "ABC", "list": ["x", "y"], "back": "cba!", "other": "z"}


def test_every_registered_extractor_builds(spark):
    two, people = {"pattern": r"(\w+) (\w+)"}, {"pattern": r"(\w+)", "fields": ("name",)}
    rules = {
        **dict.fromkeys(E.EXTRACTORS, two), "scheme": {"keywords": ["ab", "cd"]}, "metrics": {"key": "a", "value": "b"}, "aligned": {"key": "a", "value": "b"}, "managers": people, "reversed": {"end": ""},
        "people": {"name": r"\w+", "since": r"\d+", "exp": r"\d+"}, "dated_people": {"name": r"\w+", "date": r"\w+", "year": r"\d+", "exp": r"\d+"}, "assets": {"pattern": r"(\w+) (\w+)", "order": ("instrument_type", "min")}, "text": {"pattern": "x"}, "first": {"pattern": "x"}, "first_or_text": {"pattern": "x"}, "benchmark": {"pattern": "x"}, "date": {"pattern": "x"},
    }
    kinds = {"s": "string", "a": "array<string>", "m": "array<string>", "d": "array<struct<k:string,v:string>>"}
    for name, e in E.EXTRACTORS.items():
        got = spark.range(1).select(e.build(F.lit("ab cd"), rules[name]).alias("v"))
        assert got.schema["v"].dataType.simpleString() == kinds[e.kind_of(rules[name])], name
        assert len(got.collect()) == 1


def test_many_rules(spark):
    f = fields(spark, [("k0", "s", "v", None, None)])
    got = shown(K.clone_keys(f, [(f"k{i + 1}", f"k{i}$") for i in range(30)]))
    assert got == {f"k{i}": "v" for i in range(31)}


def test_keys_inside_dictionaries_are_dropped(spark):
    f = fields(spark, [("a.b", "s", "1", None, None), ("d", "d", None, None, [("entry load", "x"), ("p.entry", "y"), ("exit", "z")])])
    from docmart.operators.predicates import drop_keys_at_any_level

    assert shown(drop_keys_at_any_level(f, ["^entry", "^b$"])) == {"d": [("exit", "z")]}


def test_titles_of_one_key(spark):
    rows = [(1, 0, 0, "A b"), (1, 0, 1, "x"), (1, 1, 0, "a  B"), (1, 1, 1, "y"), (1, 2, 0, None), (1, 2, 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, row_no int, col_no int, text string")
    got = {g.title: list(g.texts) for g in C.collect_by_title(C.fill_titles(df)).collect()}
    assert got == ({"a_b": ["x"], "a__b": ["y", "z"]} if "a__b" in got else {"a_b": ["y", "z"]})
    same = df.withColumn("text", F.regexp_replace("text", "  ", " "))
    assert [list(g.texts) for g in C.collect_by_title(C.fill_titles(same)).collect()] == [["y", "z"]]


def test_numbers_of_a_dimension(spark):
    names = spark.createDataFrame([(f"Customer {k:05d}",) for k in range(500)] + [("Customer 00001",), (None,)], "name string").repartition(7)
    known = spark.createDataFrame([("Customer 00010", 4), ("old", 9)], "name string, id long")
    got = {r.name: r.id for r in M.dense_dimension_keys(names, known, "name", "id").collect()}
    fresh = [f"Customer {k:05d}" for k in range(500) if k != 10]
    assert got == {"Customer 00010": 4, "old": 9} | {n: 10 + k for k, n in enumerate(fresh)}
    empty = M.dense_dimension_keys(names.limit(0), known.limit(0), "name", "id")
    assert empty.count() == 0


def test_report_keeps_every_hit(spark):
    hits = spark.createDataFrame([(1, 1, ["a", "b", "c"], 3)], "doc_id long, page long, hits array<string>, n_hits int")
    titles = spark.createDataFrame([(1, 1, "t"), (1, 2, "u")], "doc_id long, page long, title string")
    got = {r.page: (r.n_hits, r.idx_1, r.idx_2, r.idx_3) for r in M.page_report(hits, titles, ["a", "b", "c"]).collect()}
    assert got == {1: (3, "a", "b", "c"), 2: (0, None, None, None)}


def test_two_named_keys(spark):
    f = fields(spark, [("x.a", "a", None, ["1"], None), ("x.b", "a", None, ["2"], None), ("y.a", "s", "only", None, None), ("a", "s", "t", None, None), ("b", "d", None, None, [("k", "v")]), ("c", "s", "c", None, None)])
    assert shown(K.merge_named(f, "a", "b")) == {"x.a": ["1", "2"], "y.a": "only", "a": ["t", "v"], "c": "c"}


def test_rules_by_house(spark):
    rows = [(1, "f", "h0", 0, "a", "s", "1", None, None), (2, "f", "h1", 0, "a", "s", "2", None, None), (3, "f", "h9", 0, "a", "s", "3", None, None)]
    f = spark.createDataFrame(rows, "doc_id long, fund string, amc_key string, ord long, key string, kind string, s string, arr array<string>, kv array<struct<k:string,v:string>>")
    got = lambda df: sorted((r.doc_id, r.key, r.s) for r in df.collect())
    merged = K.merge_keys(f, R.Houses({"h0": [("m", ["a"])], "h1": [("n", ["zzz"]), ("m2", ["^a"])]}))
    assert sorted((r.doc_id, r.key, r.amc_key) for r in merged.collect()) == [(1, "m", "h0"), (2, "m2", "h1"), (3, "a", "h9")]
    filled = K.fill_defaults(f, R.Houses({"h1": {"a": "x", "b": "y"}}))
    assert got(filled) == [(1, "a", "1"), (2, "a", "2"), (2, "b", "y"), (3, "a", "3")]
    combined = K.combine_keys(f, R.Houses({"h0": [("all", ["a"])]}))
    assert sorted(r.key for r in combined.collect()) == ["a", "a", "all"]


def test_vintages_and_skipped_houses(spark, tmp_path):
    path = tmp_path / "rules"
    path.mkdir()
    (path / "a.json").write_text('{"amc_key": "a", "rules": {"h": [["n", "p"]]}}\n{"amc_key": "a", "vintage": "2019", "rules": {"h": [["o", "q"], ["n", "p"]]}}\n{"amc_key": "b", "rules": {"h": [["x", "y"]]}}\n')
    rules = R.read_rules(spark, str(path))
    assert R.houses(rules, "h") == {"a": [("n", "p")], "b": [("x", "y")]}
    assert R.houses(rules, "h", "2019") == {"a": [("o", "q"), ("n", "p")], "b": [("x", "y")]}
    wanted = spark.createDataFrame([("a",), ("c",), (None,)], "amc_key string")
    assert [r.amc_key for r in R.skipped(wanted, rules).collect() if r.amc_key] == ["c"]


def test_keyword_spans_by_plain_search(spark):
    import re

    r = random.Random(5)
    words = ["Alpha", "beta", "Gamma", "x", "\n", " ", "y z", "alphabet"]
    texts = ["".join(r.choices(words, k=r.randint(0, 25))) for _ in range(150)] + ["", "Alpha", "Alpha beta", "beta Gamma Alpha x beta y"]
    keys = ["Alpha", "beta", "Gamma", "END"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for ignore in (False, True):
        flags = re.S | (re.I if ignore else 0)
        got = {g.id: [tuple(x) for x in g.kv] for g in df.select("id", E.keyword_spans("text", keys, ignore_case=ignore).alias("kv")).collect()}
        for i, text in enumerate(texts):
            want = {}
            for a, b in zip(keys, keys[1:]):
                for m in re.finditer(rf"(\b{a}\b)\s*(.*?)\s*(?:\b{b}\b|\Z|(?=\n\Z))", text.strip(), flags):
                    want.setdefault(m[1].lower(), m[2].strip())
            assert dict(got[i]) == want, text


def test_terms_are_no_patterns(spark):
    """Punctuation in a term is no pattern, and a table of terms hits as the list does."""
    texts = ["r o e 5", "The C++ (net) fund", "alpha  beta", "Alpha beta, gamma", "xalpha beta", "", None, "  ünïted  ", "beta"]
    spans = spark.createDataFrame([(1, k // 3, k, t) for k, t in enumerate(texts)], "doc_id long, page int, span_no long, text string")
    terms = ["r.o.e", "c++ (net", "alpha beta", "ünïted", "beta", "Beta", "\\E.*", "(", "5"]
    table = spark.createDataFrame([(t, k) for k, t in enumerate(terms)] + [("  ", 0), (None, 0)], "term string, priority int")
    by_list = {(r.doc_id, r.page): (r.hits, r.n_hits) for r in P.page_hits(spans, terms).collect()}
    by_table = {(r.doc_id, r.page): (r.hits, r.n_hits) for r in P.page_hits(spans, table, longest=3).collect()}
    assert by_list == by_table == {(1, 0): (["5", "beta"], 2), (1, 1): (["alpha beta", "beta"], 2), (1, 2): (["ünïted", "beta"], 2)}


def test_rules_in_a_table_extract_as_literals(spark):
    """Every extractor gives the same with its patterns in a table as with literal ones."""
    from docmart.functions.extract import EXTRACTORS
    from docmart.operators import rules as R

    text = "Entry Load Nil Exit Load 2% Mr. Asha Rao since 2011, 5 years; Turnover 3 Beta 4 amt 100 and 10"
    cases = {
        "text": {"pattern": r"Load (\w+)"}, "pairs": {"pattern": r"(\w+) Load (\S+)"}, "generic": {"pattern": r"(entry|exit) load (\S+)", "escape": r"\d%"}, "no_blanks": {"pattern": r"EntryLoad(\w{3})"}, "first": {"pattern": "zzz"},
        "first_or_text": {"pattern": "zzz", "escape": "Entry"}, "scheme": {"keywords": ["Entry Load", "Exit Load", "Turnover", "EOL"]}, "amount": {"pattern": r"amt (\d+) and (\d+)"}, "load": {"pattern": r"Entry Load (\S+) Exit Load (\S+)"},
        "lump": {"pattern": r"amt (\d+) and (\d+)"}, "metrics": {"key": "Turnover|Beta", "value": r"\b\d\b"}, "aligned": {"key": "Turnover|Beta", "value": r"\b\d\b"}, "managers": {"pattern": r"Mr\. (\w+ \w+) since (\d+)", "fields": ["name", "managing_fund_since"]},
        "people": {"name": r"Mr\. (\w+ \w+)", "since": r"since (\d+)", "exp": r"(\d+) years"}, "dated_people": {"name": r"Mr\. (\w+)", "date": r"(\w+) Load", "year": r"(\d{4})", "exp": r"(\d+) years"},
        "assets": {"pattern": r"(\w+) Load (\S+)", "order": ["instrument_type", "min"]}, "benchmark": {"pattern": r"(Exit Load)", "remove": "Entry Load Nil "}, "join": {"escape": "Load "}, "identity": {},
    }
    assert set(cases) | {"date"} <= set(EXTRACTORS)
    fields = spark.createDataFrame([(1, "f", k, name, "s", text, None, None) for k, name in enumerate(cases)], R.FIELDS.replace("amc_key", "x"))
    level = [R.Dispatch(f"{name}$", name, rule) for name, rule in cases.items()]
    got = {r["key"]: (r["kind"], r["s"], r["arr"], r["kv"]) for r in R.apply_level(fields, level).collect()}
    for name, rule in cases.items():
        e = EXTRACTORS[name]
        want = spark.range(1).select(e.build(F.lit(text), rule).alias("v")).first()["v"]
        kind, *values = got[name]
        if want is not None:
            assert (kind, values[{"s": 0, "a": 1, "m": 1, "d": 2}[kind]]) == (e.kind_of(rule), want), name


def test_rules_of_houses_and_of_all(spark):
    """Rules for all houses and rules of one keep their common order; houses without rules take the rules for all."""
    from docmart.operators import rules as R

    rows = [(1, "f", k, "key", "s", "abc", None, None, h) for k, h in enumerate(["h0", "h1", "h2"])]
    fields = spark.createDataFrame(rows, R.FIELDS + ", amc_key string")
    level = [R.Dispatch("key", "text", {"pattern": "a"}, "h0"), R.Dispatch("key", "text", {"pattern": "b"}), R.Dispatch("key", "text", {"pattern": "c"}, "h1")]
    assert {r["amc_key"]: r["s"] for r in R.apply_level(fields, level).collect()} == {"h0": "a", "h1": "b", "h2": "b"}


def test_spans_to_records_deal_once(spark):
    """The whole chain from spans to records has one exchange by key, and an empty table gives no records."""
    import re

    from docmart.plans.chain import factsheets
    from docmart.plans.layout_queries import sheet

    empty = spark.createDataFrame([], "doc_id long, page int, block_no int, span_no long, x double, y double, size double, color int, font string, text string")
    got = factsheets(empty, sheet())
    assert got.count() == 0
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = factsheets(empty, sheet())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan)) == 1


def test_migration_with_odd_rows(spark, tmp_path):
    """Null keys and names, repeated rows, an empty batch, and a run that broke off."""
    from docmart.operators.migrate import Migration

    m = Migration(spark, str(tmp_path), "id int, name string, v int", ["id"], {"name": "name_id"})
    rows = lambda r: spark.createDataFrame(r, "id int, name string, v int")
    assert m.staged().count() == m.mart().count() == 0
    m.stage(rows([(1, "a", 1), (1, "a", 1), (2, None, 2), (None, "a", 3)]), 0)
    m.run(0)
    assert {(r.id, r.name, r.v, r.name_id is None, r.run) for r in m.mart().collect()} == {(1, "a", 1, False, 0), (2, None, 2, True, 0), (None, "a", 3, False, 0)}
    keys = {r.name: r.name_id for r in m.dimension("name").collect()}
    m.stage(rows([(2, "b", 5)]), 1)
    m.load(1)  # no flags: nothing of it is seen
    assert {r.id: r.v for r in m.mart().collect()} == {1: 1, 2: 2, None: 3} and m.staged().where("not is_migrated").count() == 1
    m.run(1)
    m.stage(rows([]), 2)
    m.run(2)
    assert {(r.id, r.v, r.run) for r in m.mart().collect()} == {(1, 1, 0), (2, 5, 1), (None, 3, 0)} and m.staged().where("not is_migrated").count() == 0
    assert {r.name: r.name_id for r in m.dimension("name").collect()}["a"] == keys["a"]
