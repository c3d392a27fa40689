"""Queries over the long field table: key predicates (F6-F11), rule dispatch (R) and reshaping (K)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions.text import is_alpha, is_alphanumeric, is_numeric, normalize_key
from ..operators import predicates as P
from ..operators import reshape as K
from ..operators import rules as R
from ..sources.documents import work_folder
from .harness import FACT, query, table, view

#: The fields of each fund: key -> (kind, SQL of the value as text; '|' between items, '=' inside pairs).
BASE = {
    "Benchmark Index": ("s", "': ' || p_brand || ' TRI'"),
    "Min Amount": ("d", "'amt=' || (p_size * 100) || '|thraftr=' || (1 + p_size % 5)"),
    "Load Structure": ("d", "'entry load=Nil|exit load=' || p_size || '%'"),
    "Fund Lines": ("a", "p_name || '|' || p_brand"),
    "Fund Lines Two": ("a", "p_type"),
    "Metrics": ("d", "'port_turnover_ratio=' || (p_size % 7) || '.5 times|avg_maturity=' || p_size || ' days|beta='"),
    "Launch.Date": ("s", "lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') || '-0' || (1 + p_size % 9) || '-2015'"),
    "Blank": ("s", "''"),
}


def rows_sql(fields: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT p_partkey AS doc_id, '{k}' AS key, '{kind}' AS kind, {v} AS value FROM part" for k, (kind, v) in fields.items())


def base_fields(spark, d) -> DataFrame:
    """The same fields in Spark, built from the typed columns."""
    size = F.col("p_size").cast("string")
    kv = lambda *p: F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in p])
    values = {
        "Benchmark Index": F.concat(F.lit(": "), "p_brand", F.lit(" TRI")),
        "Min Amount": kv(("amt", (F.col("p_size") * 100).cast("string")), ("thraftr", (1 + F.col("p_size") % 5).cast("string"))),
        "Load Structure": kv(("entry load", F.lit("Nil")), ("exit load", F.concat(size, F.lit("%")))),
        "Fund Lines": F.array("p_name", "p_brand"),
        "Fund Lines Two": F.array("p_type"),
        "Metrics": kv(("port_turnover_ratio", F.concat((F.col("p_size") % 7).cast("string"), F.lit(".5 times"))), ("avg_maturity", F.concat(size, F.lit(" days"))), ("beta", F.lit(""))),
        "Launch.Date": F.concat(F.lpad((1 + F.col("p_partkey") % 28).cast("string"), 2, "0"), F.lit("-0"), (1 + F.col("p_size") % 9).cast("string"), F.lit("-2015")),
        "Blank": F.lit(""),
    }
    none = {"s": "string", "a": "array<string>", "d": E.KV}
    items = []
    for i, (key, value) in enumerate(values.items()):
        kind = BASE[key][0]
        parts = [(value if k == kind else F.lit(None).cast(t)).alias(n) for k, t, n in (("s", none["s"], "s"), ("a", none["a"], "arr"), ("d", none["d"], "kv"))]
        items.append(F.struct(F.lit(i).alias("ord"), F.lit(key).alias("key"), F.lit(kind).alias("kind"), *parts))
    part = table(spark, d, "part")
    return part.select(F.col("p_partkey").cast("long").alias("doc_id"), F.concat("p_name", F.lit(" Fund")).alias("fund"), F.explode(F.array(*items)).alias("x")).select("doc_id", "fund", "x.*")


def flat(fields: DataFrame) -> DataFrame:
    pairs = F.array_join(F.transform("kv", lambda x: F.concat(x["k"], F.lit("="), F.coalesce(x["v"], F.lit("")))), "|")
    value = F.when(F.col("kind") == "a", F.array_join("arr", "|")).when(F.col("kind") == "d", pairs).otherwise(F.col("s"))
    return fields.select("doc_id", "key", "kind", value.alias("value"))


def _on_fields(name: str, fn, fields: dict[str, tuple[str, str]], more: str | None = None) -> None:
    @query(name, rows_sql(fields) + (f" UNION ALL {more}" if more else ""))
    def run(spark, d):
        return flat(fn(base_fields(spark, d)))


def but(*gone: str, **more: tuple[str, str]) -> dict[str, tuple[str, str]]:
    return {k: v for k, v in BASE.items() if k not in gone} | {k.replace("__", "."): v for k, v in more.items()}


_on_fields("f6_select_keys", lambda f: P.select_keys(f, ["benchmark", "min"]), {k: BASE[k] for k in ("Benchmark Index", "Min Amount")})
_on_fields("f7_delete_keys", lambda f: P.delete_keys(f, ["amount", "two$"]), but("Min Amount", "Fund Lines Two"))
_on_fields("f8_drop_keys", lambda f: P.drop_keys(f, ["Lines", "blank"]), but("Fund Lines", "Fund Lines Two"))
_on_fields("f8b_keep_keys", lambda f: P.keep_keys(f, ["Lines", "blank"]), {k: BASE[k] for k in ("Fund Lines", "Fund Lines Two")})
_on_fields("f9_drop_nested", lambda f: P.drop_keys_at_any_level(f, ["^Date$", "^entry", "^beta$"]), {**but("Launch.Date", "Load Structure", "Metrics"), "Load Structure": ("d", "'exit load=' || p_size || '%'"), "Metrics": ("d", "'port_turnover_ratio=' || (p_size % 7) || '.5 times|avg_maturity=' || p_size || ' days'")})
_on_fields("f10_drop_empty", P.drop_empty, but("Blank"))
_on_fields("k1_flatten", R.flatten, {
    **but("Min Amount", "Load Structure", "Metrics"),
    "Min Amount.amt": ("s", "CAST(p_size * 100 AS VARCHAR)"), "Min Amount.thraftr": ("s", "CAST(1 + p_size % 5 AS VARCHAR)"),
    "Load Structure.entry load": ("s", "'Nil'"), "Load Structure.exit load": ("s", "p_size || '%'"),
    "Metrics.port_turnover_ratio": ("s", "(p_size % 7) || '.5 times'"), "Metrics.avg_maturity": ("s", "p_size || ' days'"), "Metrics.beta": ("s", "''"),
})
_on_fields("k2_key_names", K.normalize_keys, {k.lower().replace(" ", "_"): (kind, v.replace("entry load", "entry_load").replace("exit load", "exit_load")) for k, (kind, v) in BASE.items()})
_on_fields("k3_clone", lambda f: K.clone_keys(f, [("copy", "Fund Lines"), ("again", "copy"), ("none", "xyz")]), but(copy=BASE["Fund Lines"], again=BASE["Fund Lines"]))
_on_fields("k4_merge_lists", lambda f: K.merge_keys(f, [("lines", ["^fund lines"])]), but("Fund Lines", "Fund Lines Two", lines=("a", "p_name || '|' || p_brand || '|' || p_type")))
_on_fields("k4b_merge_dicts", lambda f: K.merge_keys(f, [("both", ["min amount", "load"]), ("none", ["xyz"])]), but("Min Amount", "Load Structure", both=("d", f"{BASE['Min Amount'][1]} || '|' || {BASE['Load Structure'][1]}")))
_on_fields("k4c_merge_mixed", lambda f: K.merge_keys(f, [("mix", ["min amount", "benchmark"])]), but("Min Amount", "Benchmark Index", mix=("d", f"'Benchmark Index=' || {BASE['Benchmark Index'][1]} || '|' || {BASE['Min Amount'][1]}")))
_on_fields("k5_combine", lambda f: K.combine_keys(f, [("all", ["Fund Lines Two", "Benchmark Index", "Fund Lines"])]), but("Fund Lines", "Fund Lines Two", "Benchmark Index", all=("a", "p_type || '|: ' || p_brand || ' TRI|' || p_name || '|' || p_brand")))
_on_fields("k6_promote", lambda f: K.promote_keys(f, [("Load Structure", "exit", "exit"), ("Metrics", "none", "xyz")]), {**but("Load Structure"), "Load Structure": ("d", "'entry load=Nil'"), "exit": ("s", "p_size || '%'")})
_on_fields("k6b_promote_search", lambda f: K.promote_keys(f, [("structure", "exit", "load$")], search=True), {**but("Load Structure"), "Load Structure": ("d", "'exit load=' || p_size || '%'"), "exit": ("s", "'Nil'")})
_on_fields("k7_merge_two", lambda f: K.merge_named(f, "Fund Lines", "Fund Lines Two"), {**but("Fund Lines Two"), "Fund Lines": ("a", "p_name || '|' || p_brand || '|' || p_type")})
_on_fields("k9_constants", lambda f: K.add_constants(f, {"amc_name": F.lit("House"), "Blank": F.lit("set")}), but("Blank", amc_name=("s", "'House'"), Blank=("s", "'set'")))
_on_fields("k10_defaults", lambda f: K.fill_defaults(f, {"Blank": "x", "exchange_listed": "no", "horizon": None}), but(exchange_listed=("s", "'no'"), horizon=("s", "CAST(NULL AS VARCHAR)")))
_on_fields("k11_amounts", lambda f: K.split_amounts(f, ["Min Amount"]), {**but("Min Amount"), "Min Amount": ("s", "CAST(p_size * 100 AS VARCHAR)"), "Min Amount_multiple": ("s", "CAST(1 + p_size % 5 AS VARCHAR)")})
_on_fields("r2_key_map", lambda f: R.map_keys(f, [("benchmark_index", "Benchmark"), ("lines", "Fund Lines")]), {**but("Benchmark Index", "Fund Lines", "Fund Lines Two"), "benchmark_index": BASE["Benchmark Index"], "lines": BASE["Fund Lines Two"]})


@query("k12_loads", "SELECT p_partkey AS doc_id, unnest(['entry_load', 'exit_load']) AS type, unnest(['Nil', p_size || '%']) AS comment FROM part")
def k12(spark, d):
    f = base_fields(spark, d).where("key = 'Load Structure'")
    return f.select("doc_id", F.explode(K.load_list(F.col("kv"))).alias("x")).select("doc_id", "x.type", "x.comment")


_on_fields("k12b_scheme_loads", lambda f: K.scheme_loads(f.withColumn("key", F.when(F.col("key").isin("Load Structure", "Blank"), "load").otherwise(F.col("key")))).withColumn("kind", F.when(F.col("kind") == "m", "a").otherwise(F.col("kind"))), {
    **but("Load Structure", "Blank"), "load": ("a", """'{"type":"entry_load","value":"Nil"}|{"type":"exit_load","value":"' || p_size || '%"}'"""),
}, more="SELECT p_partkey, 'load', 's', '' FROM part")


@query("k8_fan_out", "SELECT p_partkey, CASE WHEN p_brand LIKE '%1' THEN unnest(['A', 'B']) ELSE p_brand END AS fund FROM (SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE '%1') UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_brand NOT LIKE '%1'")
def k8(spark, d):
    return K.fan_out(table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("fund")), [("1$", ["A", "B"])])


def pages(spark, d) -> DataFrame:
    """The pages of each fund, from 0."""
    part = table(spark, d, "part")
    return part.select(F.col("p_partkey").cast("long").alias("doc_id"), F.concat("p_name", F.lit(" Fund")).alias("fund"), F.array("p_size", F.col("p_size") + 3).alias("pages"))


_EMITTED = "['benchmark_index', 'min_amt', 'load_entry_load', 'load_exit_load', 'metrics_port_turnover_ratio', 'metrics_avg_maturity', 'fund_manager_managing_fund_since', 'fund_manager_name', 'fund_manager_qualification', 'fund_manager_total_exp']"


@query("k14_locations", f"SELECT p_partkey // 10 AS doc_id, p_partkey AS part, unnest({_EMITTED}) AS field, CAST(p_size + 1 AS VARCHAR) AS page, scheme_count FROM (SELECT *, count(*) OVER (PARTITION BY p_partkey // 10) AS scheme_count FROM part)")
def k14(spark, d):
    """Ten funds a document; every emitted field with its fund's first page."""
    ten = lambda df: df.withColumn("fund", F.col("doc_id").cast("string")).withColumn("doc_id", F.floor(F.col("doc_id") / 10).cast("long"))
    got = K.field_locations(ten(records(spark, d)), ten(pages(spark, d)), ["benchmark_index", "min_amt"])
    return got.select("doc_id", F.col("fund").cast("long").alias("part"), "field", "page", F.col("scheme_count").cast("long").alias("scheme_count"))


@query("k14b_group_locations", "SELECT p_partkey AS doc_id, unnest(['benchmark_index', 'min_amt', 'min_amt_multiple']) AS field, unnest([CAST(p_size AS VARCHAR), '7', '7']) AS page FROM part")
def k14b(spark, d):
    """Locations by field group, as scheme documents have them."""
    groups = {"index": ["benchmark_index"], "amounts": ["min_amt", "min_amt_multiple"]}
    return K.group_locations(records(spark, d), scheme_pages(spark, d), groups).select("doc_id", "field", "page")


@query("r1_header_map", r"""
WITH l AS (SELECT doc_id, i AS line_no, trim(regexp_replace(regexp_replace(t, '[^\p{L}\p{N}_\s]', '', 'g'), '^\s+|\s+$', '', 'g')) AS line
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))
SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '(?i)^the') THEN 'english' WHEN regexp_matches(line, '(?i)^(de|la)') THEN 'romance' ELSE line END AS head FROM l""")
def r1(spark, d):
    from ..sources.documents import page_lines

    lines = page_lines(table(spark, d, "documents"), ["doc_id"])
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), R.map_header("line", [("english", "the"), ("romance", "de|la")]).alias("head"))


@query("r3_metric_map", "SELECT event_type, CASE WHEN event_type LIKE 'c%' THEN 'c_metric' ELSE event_type END AS metric, count(*) AS n FROM events GROUP BY ALL")
def r3(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("event_type", R.map_metric(F.concat(F.lit(" "), F.upper("event_type"), F.lit("--")), [("c_metric", "c")]).alias("metric")).agg(F.count(F.lit(1)).alias("n"))


def _rule(extractor: str, pattern: str, **rule) -> str:
    return json.dumps({"extractor": extractor, "pattern": pattern} | rule)


#: Rule files of three houses, one with an older vintage; patterns in any case.
_BLOCKS = [
    {"amc_key": "h0", "rules": {
        "headers": [["benchmark", "BENCHMARK"], ["min_amount", "min amount"], ["lines", "fund lines"], ["load", "load"]],
        "primary": [["min_amount", _rule("generic", r"(AMT|thraftr) (\d+)")]],
        "secondary": [["benchmark", _rule("generic", r"(brand#\d+)")]],
        "tertiary": [[r"load\.exit", _rule("text", r"(\d+)%")]],
    }},
    {"amc_key": "h1", "rules": {
        "headers": [["index", "benchmark"], ["load", "load structure"]],
        "primary": [["index", _rule("benchmark", r"BRAND#(\d+)")], ["load", _rule("load", r"ENTRY load (\S+) exit load (\S+)")]],
        "secondary": [["fund lines two", _rule("generic", r"no such (\d+)", on_miss="empty")]],
    }},
    {"amc_key": "h1", "vintage": "2019", "rules": {"headers": [["old_index", "benchmark"]]}},
    {"amc_key": "h2", "rules": {"headers": [["benchmark", "benchmark"]], "primary": [["benchmark", _rule("text", "tri", source="both")]]}},
]


def rule_files(spark, blocks=_BLOCKS) -> DataFrame:
    """The blocks written as rule files, one a house and vintage, and read."""
    path = work_folder(spark)
    lines = spark.createDataFrame([(json.dumps(b), f"{b['amc_key']}-{b.get('vintage', 'current')}") for b in blocks], "value string, file string")
    lines.write.partitionBy("file").text(path)
    return R.read_rules(spark, path)


def housed(spark, d) -> DataFrame:
    """The fields with a house for each document; a quarter of the documents have a house without rules."""
    f = base_fields(spark, d)
    return R.with_house(f, f.select("doc_id").distinct().withColumn("amc_key", F.concat(F.lit("h"), F.col("doc_id") % 4)))


def rows_by_house(by_house: dict[int, dict[str, tuple[str, str]]]) -> str:
    return " UNION ALL ".join(f"SELECT p_partkey AS doc_id, '{k}' AS key, '{kind}' AS kind, {v} AS value FROM part WHERE p_partkey % 4 = {h}" for h, fields in by_house.items() for k, (kind, v) in fields.items())


_TRI = "regexp_extract(p_brand, '[0-9]+')"


@query("r4_dispatch", rows_by_house({
    0: BASE, 1: {**but("Load Structure"), "Load Structure": ("d", "'entry_load=Nil|exit_load=' || p_size || '%'")}, 2: {**but("Benchmark Index"), "Benchmark Index": ("s", "'TRI'")}, 3: BASE,
}))
def r4(spark, d):
    """The first level of three houses in one plan, from their rule files; a house without rules keeps its fields."""
    return flat(R.apply_level(housed(spark, d), R.dispatches(rule_files(spark), "primary")))


_METRICS_FLAT = {"Metrics.port_turnover_ratio": ("s", "(p_size % 7) || '.5 times'"), "Metrics.avg_maturity": ("s", "p_size || ' days'"), "Metrics.beta": ("s", "''")}
_AMOUNT_FLAT = {"Min Amount.amt": ("s", "CAST(p_size * 100 AS VARCHAR)"), "Min Amount.thraftr": ("s", "CAST(1 + p_size % 5 AS VARCHAR)")}
_LOAD_FLAT = {"Load Structure.entry_load": ("s", "'Nil'"), "Load Structure.exit_load": ("s", "p_size || '%'")}
_REST = {**_METRICS_FLAT, "LaunchDate": BASE["Launch.Date"], "Blank": BASE["Blank"]}


@query("r5_refine", rows_by_house({
    0: {**_REST, "benchmark": ("s", "p_brand"), "min_amount.amt": ("s", "CAST(p_size * 100 AS VARCHAR)"), "min_amount.thraftr": ("s", "CAST(1 + p_size % 5 AS VARCHAR)"),
        "load.entry_load": ("s", "'Nil'"), "load.exit_load": ("s", "CAST(p_size AS VARCHAR)"), "lines": BASE["Fund Lines"], "lines_bravo": BASE["Fund Lines Two"]},
    1: {**_REST, **_AMOUNT_FLAT, "index": ("s", _TRI), "load.entry_load": ("s", "'Nil'"), "load.exit_load": ("s", "p_size || '%'"), "Fund Lines": BASE["Fund Lines"], "Fund Lines Two": ("d", "''")},
    2: {**_REST, **_AMOUNT_FLAT, **_LOAD_FLAT, "benchmark": ("s", "'TRI'"), "Fund Lines": BASE["Fund Lines"], "Fund Lines Two": BASE["Fund Lines Two"]},
    3: {**_REST, **_AMOUNT_FLAT, **_LOAD_FLAT, "Benchmark Index": BASE["Benchmark Index"], "Fund Lines": BASE["Fund Lines"], "Fund Lines Two": BASE["Fund Lines Two"]},
}))
def r5(spark, d):
    """All levels, over all fields, with the rules of three houses in one plan."""
    book = R.rule_book(rule_files(spark))
    return flat(R.refine(housed(spark, d), R.houses(book, "headers"), *[R.dispatches(book, t) for t in ("primary", "secondary", "tertiary")]))


MANY, EACH = 54, 20


def many_blocks() -> list[dict]:
    """Two levels of 20 rules for each of 54 houses, every pattern its house's own; one rule of each level fits, at another place in each house."""
    out = []
    for h in range(MANY):
        brand = (r"(?:h%d)?#(\d)", r"(?:h%d)?#(\d+)", r"(?:h%d)?(BRAND)#")[h % 3] % h
        others = lambda level: [[f"none {level} {h} {k}", _rule("text", rf"h{h} (\d{{{k + 1}}})")] for k in range(EACH)]  # noqa: B023, E731
        primary, secondary = others(1), others(2)
        primary[h % EACH] = ["benchmark", _rule("text", brand)]
        secondary[(7 * h) % EACH] = [r"metrics\.port", _rule("generic", rf"(?:h{h})?(\d+)\.5")] if h % 2 else ["launch", _rule("text", rf"(?:h{h})?(\d{{4}})$")]
        out.append({"amc_key": f"h{h}", "rules": {"headers": [[f"bench_{h}", f"bench h{h}"]], "primary": primary, "secondary": secondary}})
    return out


_BRAND_PART = "CASE p_partkey % 54 % 3 WHEN 0 THEN substr(regexp_extract(p_brand, '[0-9]+'), 1, 1) WHEN 1 THEN regexp_extract(p_brand, '[0-9]+') ELSE 'Brand' END"


@query("r5b_many_houses", rows_sql({
    **_AMOUNT_FLAT, **_LOAD_FLAT, "Blank": BASE["Blank"], "Fund Lines": BASE["Fund Lines"], "Fund Lines Two": BASE["Fund Lines Two"], "Metrics.avg_maturity": _METRICS_FLAT["Metrics.avg_maturity"], "Metrics.beta": ("s", "''"),
    "Benchmark Index": ("s", _BRAND_PART),
    "Metrics.port_turnover_ratio": ("s", "CASE WHEN p_partkey % 54 % 2 = 1 THEN CAST(p_size % 7 AS VARCHAR) ELSE (p_size % 7) || '.5 times' END"),
    "LaunchDate": ("s", f"CASE WHEN p_partkey % 54 % 2 = 0 THEN '2015' ELSE {BASE['Launch.Date'][1]} END"),
}))
def r5b(spark, d):
    """A rule set of the size of a real one: 54 houses with 40 extraction rules each, in one plan."""
    f = base_fields(spark, d)
    own = R.with_house(f, f.select("doc_id").distinct().withColumn("amc_key", F.concat(F.lit("h"), F.col("doc_id") % MANY)))
    book = R.rule_book(rule_files(spark, many_blocks()))
    return flat(R.refine(own, R.houses(book, "headers"), *[R.dispatches(book, t) for t in ("primary", "secondary", "tertiary")]))


_on_fields("r6_special", lambda f: R.special_pass(f, [("Launch", "launch_year", "text", {"pattern": r"(\d{4})$"}), ("Benchmark", "Blank", "text", {"pattern": r"(\d+)"})]), {**but("Blank"), "launch_year": ("s", "'2015'"), "Blank": ("s", "regexp_extract(p_brand, '[0-9]+')")})


@query("r7_amc_rules", rows_by_house({
    0: {**but("Benchmark Index", "Fund Lines Two"), "benchmark_index": BASE["Benchmark Index"]},
    1: {"Benchmark Index": BASE["Benchmark Index"], "Min Amount": BASE["Min Amount"], "first": BASE["Benchmark Index"], "amc_name": ("s", "'House One'")},
    2: {}, 3: {**BASE, "amc_name": ("s", "'Other'")},
}))
def r7(spark, d):
    """Overrides by house in one plan: each operator takes every house's own rules, and leaves a house without any alone."""
    f = housed(spark, d)
    f = P.delete_keys(f, R.Houses({"h0": ["two$"], "h2": ["."]}))
    f = K.clone_keys(f, R.Houses({"h1": [("first", "Benchmark")]}))
    f = R.map_keys(f, R.Houses({"h0": [("benchmark_index", "Benchmark")]}))
    f = P.select_keys(f, R.Houses({"h0": ["."], "h1": ["benchmark", "min", "first"], "h3": ["."]}))
    return flat(K.add_constants(f, R.Houses({"h1": {"amc_name": F.lit("House One")}, "h3": {"amc_name": F.lit("Other")}})))


@query("s7_rule_rows", """
SELECT n_name, amc_key, priority, name FROM nation JOIN (VALUES
  ('h0', 0, 'benchmark'), ('h0', 1, 'min_amount'), ('h0', 2, 'lines'), ('h0', 3, 'load'), ('h1', 0, 'old_index'), ('h2', 0, 'benchmark')
) v(amc_key, priority, name) ON amc_key = 'h' || n_regionkey""")
def s7(spark, d):
    """The header rules of each house from its files, the vintage 2019 where there is one, joined to the houses that use them."""
    old = R.houses(rule_files(spark), "headers", "2019")
    rules = spark.createDataFrame([(h, k, name) for h, block in old.items() for k, (name, _) in enumerate(block)], "amc_key string, priority int, name string")
    return R.lookup(table(spark, d, "nation").select("n_name", F.concat(F.lit("h"), F.col("n_regionkey").cast("string")).alias("amc_key")), rules).select("n_name", "amc_key", "priority", "name")


@query("s7b_dated_rules", """
SELECT p_partkey AS doc_id, CASE p_partkey % 4 WHEN 1 THEN CASE WHEN p_size % 4 IN (1, 2) THEN 'old_index' ELSE 'index' END WHEN 3 THEN 'Benchmark Index' ELSE 'benchmark' END AS key FROM part""")
def s7b(spark, d):
    """One run over documents of several years: each takes the vintage of its house that was valid at its date."""
    f = base_fields(spark, d).where("key = 'Benchmark Index'")
    year = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("doc_id"), F.concat(F.lit("h"), F.col("p_partkey") % 4).alias("amc_key"), F.expr("make_date(2018 + p_size % 4, 6, 1)").alias("doc_date"))
    valid = spark.createDataFrame([("h1", "2019", "2019-01-01"), ("h1", "current", "2021-01-01")], "amc_key string, vintage string, valid_from string").withColumn("valid_from", F.to_date("valid_from"))
    dated = R.with_house(f, R.with_vintage(year, valid))
    book = R.dated_rule_book(rule_files(spark))
    return dated.select("doc_id", F.coalesce(R.first_by_house("key", R.houses(book, "headers")), F.col("key")).alias("key"))


@query("f11_types", "SELECT p_partkey, p_size % 3 = 0 AS numeric, p_size % 3 IN (0, 1) AS alphanumeric, p_size % 3 = 1 AS alpha FROM part")
def f11(spark, d):
    k = F.col("p_size") % 3
    c = F.when(k == 0, F.col("p_size").cast("string")).when(k == 1, "abc").otherwise("a b-")
    return table(spark, d, "part").select("p_partkey", is_numeric(c).alias("numeric"), is_alphanumeric(c).alias("alphanumeric"), is_alpha(c).alias("alpha"))


CHAIN = {
    "clone": [("benchmark_copy", "Benchmark")],
    "merge": [("load", ["load structure"])],
    "select": ["benchmark", "min", "load", "metrics", "launch", "managed"],
    "map": [("benchmark_index", "Benchmark Index"), ("min_amt", "Min Amount"), ("scheme_launch_date", "Launch"), ("metrics", "Metrics"), ("load", "load")],
    "metrics": [("port_turnover_ratio", "turnover"), ("avg_maturity", "avg")],
    "special": [("managed_by", "fund_manager", "managers", {"pattern": r"(MR\. \w+ \w+) \w* ?SINCE (\d+), (\d+ years)", "fields": ("name", "managing_fund_since", "total_exp")})],
    "defaults": {"exchange_listed": "", "min_addl_amt": ""},
    "record": ["benchmark_index", "min_amt", "min_amt_multiple", "scheme_launch_date", "exchange_listed"],
}
_RECORD_SQL = """
SELECT p_partkey AS doc_id, p_brand || ' TRI' AS benchmark_index, CAST(p_size * 100 AS VARCHAR) AS min_amt, CAST(1 + p_size % 5 AS VARCHAR) AS min_amt_multiple,
  '20150' || (1 + p_size % 9) || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') AS scheme_launch_date, '' AS exchange_listed,
  'entry_load:Nil|exit_load:' || p_size || '%' AS loads,
  'port_turnover_ratio:' || ((p_size % 7) * 100 + 50) AS turnover, round(p_size / CAST(365 AS DOUBLE), 4) AS maturity, 2 AS n_metrics,
  'Asha ' || CASE WHEN p_size % 2 = 0 THEN 'Rao' ELSE 'Sen' END || '/' || (2000 + p_size % 20) || '/' || (1 + p_size % 30) || ' Years|Second Person/2011/9 Years' AS managers
FROM part"""


def with_managers(spark, d) -> DataFrame:
    """The fields and, for each fund, a text that names two managers, one with a repeated word."""
    who = F.concat(F.lit("Mr. asha "), F.when(F.col("p_size") % 2 == 0, "rao").otherwise("sen"), F.lit(" since "), (2000 + F.col("p_size") % 20).cast("string"), F.lit(", "), (1 + F.col("p_size") % 30).cast("string"), F.lit(" Years; mr. Second Person since 2011, 9 years; Mr. x 1 since 1, 2 years"))
    part = table(spark, d, "part")
    none = F.lit(None)
    more = part.select(F.col("p_partkey").cast("long").alias("doc_id"), F.concat("p_name", F.lit(" Fund")).alias("fund"), F.lit(50).alias("ord"), F.lit("Managed By").alias("key"), F.lit("s").alias("kind"), who.alias("s"), none.cast("array<string>").alias("arr"), none.cast(E.KV).alias("kv"))
    return base_fields(spark, d).unionByName(more)


def records(spark, d) -> DataFrame:
    return K.merge_and_select(with_managers(spark, d), CHAIN)


@query("k16_chain", _RECORD_SQL)
def k16(spark, d):
    """From fields to records in the fixed order of the chain, with K15's assembly at its end."""
    r = records(spark, d)
    metric = lambda n: F.get(F.filter("metrics", lambda x: x["name"] == n), F.lit(0))["value"]
    loads = F.array_join(F.transform("load", lambda x: F.concat(x["type"], F.lit(":"), x["comment"])), "|")
    people = F.array_join(F.transform("fund_manager", lambda x: F.concat_ws("/", x["name"], x["managing_fund_since"], x["total_exp"])), "|")
    return r.select("doc_id", *CHAIN["record"], loads.alias("loads"), F.concat(F.lit("port_turnover_ratio:"), metric("port_turnover_ratio")).alias("turnover"), metric("avg_maturity").cast("double").alias("maturity"), F.size("metrics").alias("n_metrics"), people.alias("managers"))


#: Promotion follows the load list, so the promoted text comes from the metrics, which are still a dictionary then.
SCHEME = {
    "merge": [("load", ["load structure"])], "select": ["benchmark", "min", "load", "metrics", "fund lines"], "map": [("benchmark_index", "Benchmark Index"), ("min_amt", "Min Amount")],
    "promote": [("metrics", "maturity_note", "avg")], "constants": {"face_value": "10"}, "defaults": {"sponsor": "none"}, "delete": ["fund lines$", "^metrics"],
}
_SCHEME_SQL = """
SELECT p_partkey AS doc_id, p_brand || ' TRI' AS benchmark_index, CAST(p_size * 100 AS VARCHAR) AS min_amt, CAST(1 + p_size % 5 AS VARCHAR) AS min_amt_multiple, p_size || ' days' AS maturity_note, '10' AS face_value, 'none' AS sponsor,
  'entry_load:Nil|exit_load:' || p_size || '%' AS loads FROM part"""


@query("k16b_scheme_chain", _SCHEME_SQL)
def k16b(spark, d):
    """The chain of scheme documents: amounts, defaults, load list, promotion by search, constants, deletion at the end."""
    keys = ["benchmark_index", "min_amt", "min_amt_multiple", "maturity_note", "face_value", "sponsor"]
    r = K.merge_and_select_scheme(base_fields(spark, d), SCHEME | {"record": keys})
    return r.select("doc_id", *keys, F.array_join(F.transform("load", lambda x: F.concat(x["type"], F.lit(":"), x["comment"])), "|").alias("loads"))


def scheme_pages(spark, d) -> DataFrame:
    """The page of each group of fields."""
    part = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("doc_id"), "p_size")
    groups = F.explode(F.array(F.struct(F.lit("index").alias("group"), F.col("p_size").cast("int").alias("page")), F.struct(F.lit("amounts").alias("group"), F.lit(7).alias("page")))).alias("x")
    return part.select("doc_id", groups).select("doc_id", "x.*")


def told(value: Column) -> Column:
    """A VARIANT written as JSON, and read again: what a record holds survives its file."""
    return F.parse_json(F.to_json(value))


@query("k16c_sid_records", """
SELECT p_partkey AS doc_id, p_brand || ' TRI' AS benchmark, 'entry_load|exit_load' AS load_types, 'Nil|' || p_size || '%' AS load_comments, CAST(1 + p_size % 5 AS VARCHAR) AS multiple, p_type AS kept_line,
  'benchmark_index@' || p_size || '|min_amt@7|min_amt_multiple@7' AS places, 9 AS n_keys FROM part""")
def k16c(spark, d):
    """Full scheme documents as VARIANT records, with loads, a list and locations, through JSON and back."""
    r = K.scheme_records(base_fields(spark, d), SCHEME, scheme_pages(spark, d), {"index": ["benchmark_index"], "amounts": ["min_amt", "min_amt_multiple"]})
    r = r.withColumn("value", told(F.col("value")))
    v = lambda path, t="string": F.try_variant_get("value", path, t)
    listed = lambda path, kind, one: F.array_join(F.transform(v(path, kind), one), "|")
    loads, places = "array<struct<type:string,comment:string>>", "array<struct<field:string,page:string>>"
    return r.select(
        "doc_id", v("$.benchmark_index").alias("benchmark"), listed("$.load", loads, lambda x: x["type"]).alias("load_types"), listed("$.load", loads, lambda x: x["comment"]).alias("load_comments"),
        v("$.min_amt_multiple").alias("multiple"), v("$['Fund Lines Two'][0]").alias("kept_line"), listed("$.field_location", places, lambda x: F.concat_ws("@", x["field"], x["page"])).alias("places"),
        F.size(F.map_keys(F.try_variant_get("value", "$", "map<string,variant>"))).alias("n_keys"),
    )


@query("k16d_kim_records", """
SELECT p_partkey AS doc_id, unnest([0, 1]) AS n, unnest(['Equity ' || p_brand, 'Debt']) AS instrument, unnest(['High', '']) AS risk, unnest(['min=' || (p_size % 50) || '|max=100|total=', 'min=0|max=' || (50 - p_size % 50) || '|total=' || p_size]) AS allocation,
  p_brand || ' TRI' AS benchmark FROM part""")
def k16d(spark, d):
    """Key memoranda as VARIANT records: the rows of their asset tables become nested allocations."""
    size, none = F.col("p_size"), F.lit(None)
    rows = F.array(
        F.to_json(F.struct(F.concat(F.lit("Equity  "), "p_brand").alias("instrument"), (size % 50).cast("string").alias("min"), F.lit("100").alias("max"), F.lit("High").alias("risk_profile"))),
        F.to_json(F.struct(F.lit("Debt").alias("instrument"), F.lit("0").alias("min"), (50 - size % 50).cast("string").alias("max"), size.cast("string").alias("total"))),
    )
    assets = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("doc_id"), F.concat("p_name", F.lit(" Fund")).alias("fund"), F.lit(60).alias("ord"), F.lit("asset_allocation_pattern").alias("key"), F.lit("m").alias("kind"), none.cast("string").alias("s"), rows.alias("arr"), none.cast(E.KV).alias("kv"))
    rules = {"select": ["benchmark", "asset"], "map": [("benchmark_index", "Benchmark Index")], "defaults": {"scheme_type": ""}}
    r = K.scheme_records(base_fields(spark, d).unionByName(assets), rules, kim=True).withColumn("value", told(F.col("value")))
    pattern = "array<struct<allocation:array<struct<type:string,value:string>>,instrument_type:string,risk_profile:string>>"
    one = r.select("doc_id", F.try_variant_get("value", "$.benchmark_index", "string").alias("benchmark"), F.posexplode(F.try_variant_get("value", "$.asset_allocation_pattern", pattern)).alias("n", "x"))
    parts = F.array_join(F.transform("x.allocation", lambda y: F.concat_ws("=", y["type"], y["value"])), "|")
    return one.select("doc_id", "n", F.col("x.instrument_type").alias("instrument"), F.col("x.risk_profile").alias("risk"), parts.alias("allocation"), "benchmark")


@query("k15_documents", "SELECT CAST(p_partkey AS VARCHAR) AS document_name, 'FS' AS file_type, 1 AS n_records, p_name || ' Fund' AS fund, 2 AS n_managers, 10 AS n_locations, CAST(p_size + 1 AS VARCHAR) AS page FROM part")
def k15(spark, d):
    """Documents of records with managers and the locations of their fields."""
    r = records(spark, d)
    docs = K.documents_of(K.with_locations(r, K.field_locations(r, pages(spark, d), ["benchmark_index", "min_amt"])), "20250101")
    value = F.col("records")[0]["value"]
    return docs.select("metadata.document_name", "metadata.file_type", F.size("records").alias("n_records"), value["fund"].alias("fund"), F.size(value["fund_manager"]).alias("n_managers"), F.size(value["field_location"]).alias("n_locations"), value["field_location"][0]["page"].alias("page"))


@query("minimum_slice", "SELECT p_partkey AS doc_id, p_name || ' Fund' AS fund, p_brand || ' TRI' AS benchmark_index, CAST(p_size * 100 AS VARCHAR) AS min_amt, CAST(1 + p_size % 5 AS VARCHAR) AS min_amt_multiple FROM part")
def minimum_slice(spark, d):
    """Benchmark and minimum amount of each scheme, from the factsheet text itself."""
    facts = view(spark, d, FACT).withColumn("doc_id", F.col("doc_id").cast("long")).repartition("doc_id", "fund")  # before the extraction, so that it runs in all tasks
    keywords = ["Inception Date", "Benchmark", "Entry Load", "Exit Load", "Minimum Amount", "Turnover", "EOL"]
    spans = facts.select("doc_id", "fund", F.posexplode(E.keyword_spans("text", keywords)).alias("ord", "x"))
    none = F.lit(None)
    fields = spans.select("doc_id", "fund", "ord", normalize_key(F.col("x.k")).alias("key"), F.lit("s").alias("kind"), F.col("x.v").alias("s"), none.cast("array<string>").alias("arr"), none.cast(E.KV).alias("kv"))
    fields = R.apply_level(fields, [R.Dispatch("minimum", "amount", {"pattern": r"Rs\.(\d+) and multiples of (\d+)"})])
    rules = {"select": ["benchmark", "minimum"], "map": [("benchmark_index", "benchmark"), ("min_amt", "minimum")], "record": ["benchmark_index", "min_amt", "min_amt_multiple"]}
    return K.merge_and_select(fields, rules, partitioned=True).select("doc_id", "fund", *rules["record"])
