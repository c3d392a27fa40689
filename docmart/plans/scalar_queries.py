"""Queries of the scalar functions and extractors (N, E, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions import text as T
from ..operators import rules as R
from .harness import FACT, query, table, view


def _ws(e: str) -> str:
    return rf"trim(regexp_replace({e}, '\s+', ' ', 'g'))"


def _on_documents(name: str, fn, sql_value: str) -> None:
    @query(name, f"SELECT doc_id, {sql_value} AS value FROM documents")
    def run(spark, d):
        return table(spark, d, "documents").select("doc_id", fn("text").alias("value"))


_on_documents("n1_whitespace", T.normalize_whitespace, _ws("text"))
_on_documents("n2_alphanumeric", T.normalize_alphanumeric, f"lower({_ws("regexp_replace(text, '[^a-zA-Z0-9]+', ' ', 'g')")})")
_on_documents("n3_alpha", T.normalize_alpha, f"lower({_ws("regexp_replace(text, '[^a-zA-Z]+', ' ', 'g')")})")
_on_documents("n4_numeric", T.normalize_numeric, f"lower({_ws("regexp_replace(text, '[^0-9.]+', ' ', 'g')")})")
_on_documents("n5_keep_symbols", lambda c: T.normalize_alphanumeric_keep(c, "%&"), f"lower({_ws("regexp_replace(text, '[^%&a-zA-Z0-9]+', ' ', 'g')")})")
_on_documents("n6_percent", T.normalize_alphanumeric_percent, rf"lower({_ws(r"regexp_replace(text, '[^A-Za-z0-9%\s]+', '', 'g')")})")
_on_documents("n7_key", T.normalize_key, r"lower(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s.]', '', 'g'), '\s+', '_', 'g'))")
_on_documents("n9_non_word", T.remove_non_word_space, r"regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g'), '^\s+|\s+$', '', 'g')")
_on_documents("n10_leading_noise", lambda c: T.clean_leading_noise(F.concat(F.lit(" :- | •"), F.col(c))), r"regexp_replace(regexp_replace(' :- | •' || text, '^[\s\\:;\-–—•|]+', ''), '^\s+|\s+$', '', 'g')")
_on_documents("n10b_leading_specials", lambda c: T.clean_leading_specials(F.concat(F.lit(" *-., "), F.col(c))), r"regexp_replace(' *-., ' || text, '^[\s:*\-.,]+', '')")
_on_documents("n15_duplicate_words", T.remove_duplicate_words, r"array_to_string((SELECT list(w ORDER BY i) FROM (SELECT regexp_replace(w, '^\s+|\s+$', '', 'g') AS w, min(i) AS i FROM (SELECT unnest(string_split(lower(text), ' ')) AS w, unnest(range(len(string_split(lower(text), ' ')))) AS i) GROUP BY 1)), ' ')")
_on_documents("n18_cell_pipeline", lambda c: T.cell_pipeline(c, ("newline_to_space", "collapse", "strip", "lower", "blank_to_null", "null_to_blank")), f"lower({_ws("coalesce(text, '')")})")


@query("n8_alnum_underscore", "SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_type || '--(' || p_name || ')'), '[^a-z0-9_]', '_', 'g'), '__+', '_', 'g'), '^_+|_+$', '', 'g') AS value FROM part")
def n8(spark, d):
    return table(spark, d, "part").select("p_partkey", T.key_to_alnum_underscore(F.concat("p_type", F.lit("--("), "p_name", F.lit(")"))).alias("value"))


@query("n11_date_text", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') || ' (x)' AS raw, strftime(o_orderdate, '%d/%m/%Y') || ' x' AS value FROM orders")
def n11(spark, d):
    raw = F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" (x)"))
    return table(spark, d, "orders").select("o_orderkey", raw.alias("raw"), T.normalize_date(raw).alias("value"))


@query("n12_date_format", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN 'on demand' ELSE strftime(o_orderdate, '%Y%m%d') END AS value FROM orders")
def n12(spark, d):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format("o_orderdate", "d MMMM yyyy")).when(k == 1, F.date_format("o_orderdate", "dd-MM-yyyy")).when(k == 2, F.date_format("o_orderdate", "MMMM d, yyyy"))
    raw = raw.when(k == 3, F.concat(F.date_format("o_orderdate", "d"), F.lit("th "), F.date_format("o_orderdate", "MMM yyyy"))).otherwise("on demand")
    return table(spark, d, "orders").select("o_orderkey", T.date_to_yyyymmdd(raw).alias("value"))


@query("n13_month_end", "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y%m%d') AS value FROM orders")
def n13(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.previous_month_end("o_orderdate").alias("value"))


@query("n14_currency", "SELECT p_partkey AS doc_id, 'Rs. ' || (p_size * 100) || ',00 Cr' AS value FROM part")
def n14(spark, d):
    raw = F.concat(F.lit("₹Rs. "), F.col("p_size") * 100, F.lit(",00 Cr/-"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), T.clean_currency(raw).alias("value"))


@query("n16_title", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), '''') AS value FROM part")
def n16(spark, d):
    return table(spark, d, "part").select("p_partkey", T.title_case(F.replace(F.upper("p_name"), F.lit(" "), F.lit("'"))).alias("value"))


@query("n17_rgb", "SELECT p_partkey, ((p_partkey * 7919) >> 16 & 255) / 255.0 AS r, ((p_partkey * 7919) >> 8 & 255) / 255.0 AS g, ((p_partkey * 7919) & 255) / 255.0 AS b FROM part".replace("/ 255.0", "/ CAST(255 AS DOUBLE)"))
def n17(spark, d):
    return table(spark, d, "part").select("p_partkey", T.rgb(F.col("p_partkey") * 7919).alias("c")).select("p_partkey", "c.*")


@query("n19_amount", "SELECT p_partkey AS doc_id, CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size * 1000 AS VARCHAR) END AS value, CAST(p_size AS VARCHAR) AS sid_value FROM part")
def n19(spark, d):
    part = table(spark, d, "part")
    fund = F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" ETF"))).otherwise(F.concat("p_name", F.lit(" Fund")))
    return part.select(F.col("p_partkey").alias("doc_id"), T.clean_amount(fund, F.concat("p_size", F.lit(",000 "))).alias("value"), T.clean_amount_any(F.concat(F.lit("any "), "p_size", F.lit("."))).alias("sid_value"))


_METRIC_SQL = """
SELECT p_partkey AS doc_id, CAST((p_size % 7) * 100 + 50 AS VARCHAR) AS turnover, CAST(p_size AS VARCHAR) AS ytm,
  round(p_size / CAST(365 AS DOUBLE), 4) AS days, round(p_size / CAST(12 AS DOUBLE), 4) AS months, CAST(NULL AS VARCHAR) AS missing FROM part"""


@query("n20b_suspects", "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'several numbers' WHEN 1 THEN 'sign lost' WHEN 2 THEN NULL WHEN 3 THEN 'no number' ELSE NULL END AS why FROM part")
def n20b(spark, d):
    size, k = F.col("p_size").cast("string"), F.col("p_size") % 5
    name = F.when(k == 3, "beta").when(k == 4, "ytm").otherwise("macaulay")
    value = F.when(k == 0, F.concat(size, F.lit(" years 3 months"))).when(k == 1, F.concat(F.lit(" -"), size, F.lit(" days"))).when(k == 2, F.concat(size, F.lit(".5 years"))).when(k == 3, F.concat(size, F.lit(" or so"))).otherwise(F.concat(size, F.lit(" %")))
    return table(spark, d, "part").select("p_partkey", T.metric_suspect(name, value).alias("why"))


@query("n20_metric", _METRIC_SQL)
def n20(spark, d):
    m = lambda name, value: T.clean_metric(F.lit("fund"), F.lit(name), value)
    size = F.col("p_size").cast("string")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("doc_id"),
        m("port_turnover_ratio", F.concat((F.col("p_size") % 7).cast("string"), F.lit(".5 times"))).alias("turnover"),
        m("ytm", F.concat(size, F.lit("%"))).alias("ytm"),
        m("avg_maturity", F.concat(size, F.lit(" days"))).cast("double").alias("days"),
        m("macaulay", F.concat(size, F.lit(" Months"))).cast("double").alias("months"),
        m("beta", F.lit(" na ")).alias("missing"),
    )


@query("n21_manager", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Supplier ' || CASE WHEN s_suppkey % 2 = 0 THEN 'Anand' ELSE 'Bose' END WHEN 1 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'Anand Rao' ELSE 'Bose Rao' END END AS value FROM supplier")
def n21(spark, d):
    who = F.when(F.col("s_suppkey") % 2 == 0, "ANAND").otherwise("bose")
    k = F.col("s_suppkey") % 3
    text = F.when(k == 0, F.concat(F.lit("Mr. "), F.regexp_extract("s_name", "(?i)(supplier)", 1), F.lit(" supplier, "), who)).when(k == 1, F.concat(F.lit("dr "), who, F.lit(" (rao) RAO 12"))).otherwise("Ms. 12 x")
    return table(spark, d, "supplier").select("s_suppkey", T.clean_manager_name(text).alias("value"))


def _on_fact(name: str, sql_columns: str, *columns) -> None:
    @query(name, f"SELECT p_partkey AS doc_id, {sql_columns} FROM part")
    def run(spark, d):
        built = [c() if callable(c) else c for c in columns]
        return view(spark, d, FACT).select("doc_id", *built)


_on_fact("e1_identity", "concat(p_name, ' Fund') AS value", lambda: E.EXTRACTORS["identity"].build(F.col("fund"), {}).alias("value"))
_on_fact("e2_join", "concat(p_name, ' Fund') AS value", lambda: E.join_list(F.split("fund", " ")).alias("value"))

_SPAN_KEYS = ("Inception Date", "Benchmark", "Entry Load", "Exit Load", "Minimum Amount", "Turnover", "EOL")
_SPAN_SQL = "p_brand || ' TRI' AS benchmark, CAST(p_size AS VARCHAR) || '% within 365 days' AS exit_load, 'Nil' AS entry_load, 6 AS n"


def _spans_query(name: str, ignore_case: bool) -> None:
    keys = [k.lower() for k in _SPAN_KEYS] if ignore_case else _SPAN_KEYS

    @query(name, f"SELECT p_partkey AS doc_id, {_SPAN_SQL} FROM part")
    def run(spark, d):
        facts = view(spark, d, FACT).select("doc_id", E.keyword_spans("text", keys, ignore_case=ignore_case).alias("kv"))
        get = lambda k, n: E.kv_get(F.col("kv"), k).alias(n)
        return facts.select("doc_id", get("benchmark", "benchmark"), get("exit load", "exit_load"), get("entry load", "entry_load"), F.size("kv").alias("n"))


_spans_query("e3_keyword_spans", True)
_spans_query("e4_keyword_spans_case", False)
_on_fact("e5_generic", "p_brand AS benchmark, CAST(p_size AS VARCHAR) AS maturity", lambda: E.generic_text("text", r"BENCHMARK (\S+) tri").alias("benchmark"), lambda: E.kv_get(E.generic_pairs("text", r"(Maturity) (\d+)"), "Maturity").alias("maturity"))
_on_fact("e6_generic_full", "p_brand AS benchmark, concat(p_name, ' Fund') AS missed", lambda: E.generic_text("text", r"BENCHMARK (\S+) tri", full_on_miss=True).alias("benchmark"), lambda: E.generic_text("fund", r"no such text (\d+)", full_on_miss=True).alias("missed"))
_on_fact("e7_no_blanks", "CAST(p_size * 100 AS VARCHAR) AS amount", lambda: E.generic_text(E.without_blanks("text"), r"amountRS\.(\d+)AND").alias("amount"))
_on_fact("e8_first_or_text", "p_brand AS benchmark, concat(p_name, ' Fund') AS missed", lambda: E.first_match("text", r"BENCHMARK (\S+) tri").alias("benchmark"), lambda: E.first_match("fund", r"(\d{9})", otherwise=F.col("fund")).alias("missed"))
_on_fact("e9_metric_zip", "CAST(p_size % 7 AS VARCHAR) || '.5 times' AS turnover, CAST(p_size AS VARCHAR) || ' days' AS maturity", *[(lambda k=k, n=n: E.kv_get(E.metric_zip("text", "Turnover|Average Maturity", r"\d[\d.]* (?:TIMES|days(?= eol))"), k).alias(n)) for k, n in (("Turnover", "turnover"), ("Average Maturity", "maturity"))])
_on_fact("e10_aligned", "CAST(p_size % 7 AS VARCHAR) || '.5' AS turnover, CAST(p_size AS VARCHAR) AS maturity, CAST(p_size * 100 AS VARCHAR) AS amount", *[(lambda k=k, n=n: E.kv_get(E.positional_pairs("text", "turnover|average maturity|minimum amount", r"\d+(?:\.\d+)?"), k).alias(n)) for k, n in (("Turnover", "turnover"), ("Average Maturity", "maturity"), ("Minimum Amount", "amount"))])
_on_fact("e11_load", "'Nil' AS entry_load, CAST(p_size AS VARCHAR) || '%' AS exit_load", *[(lambda k=k: E.kv_get(E.load_pair("text", r"entry load (\w+) EXIT load (\d+%)"), k).alias(k)) for k in ("entry_load", "exit_load")])
_on_fact("e12_amount", "CAST(p_size * 100 AS VARCHAR) AS amt, CAST(1 + p_size % 5 AS VARCHAR) AS thraftr", *[(lambda k=k: E.kv_get(E.amount_pair("text", r"amount rs\.(\d+) AND multiples of (\d+)"), k).alias(k)) for k in ("amt", "thraftr")])
_on_fact("e13_lump", "CAST(p_size * 100 AS VARCHAR) AS min_amt, CAST(1 + p_size % 5 AS VARCHAR) AS add_amt", *[(lambda k=k: E.kv_get(E.lump_pair("text", r"RS\.(\d*) And Multiples of (\d*)"), k).alias(k)) for k in ("min_amt", "add_amt")])


@query("e14_managers", "SELECT s_suppkey, 'Supplier' AS name, CAST(1 + s_suppkey % 30 AS VARCHAR) || ' Years' AS total_exp, '' AS qualification FROM supplier")
def e14(spark, d):
    text = F.concat(F.lit("Managed by SUPPLIER, "), (1 + F.col("s_suppkey") % 30).cast("string"), F.lit(" years of experience"))
    m = E.managers(text, r"BY (\w+), (\d+ YEARS)", ("name", "total_exp"))
    return table(spark, d, "supplier").select("s_suppkey", F.explode(m).alias("m")).select("s_suppkey", "m.name", "m.total_exp", "m.qualification")


@query("e15_manager_rows", "SELECT s_suppkey, 'Supplier' AS name, CAST(s_suppkey % 30 AS VARCHAR) AS total_exp FROM supplier WHERE s_suppkey % 2 = 0")
def e15(spark, d):
    row = F.struct(F.when(F.col("s_suppkey") % 2 == 0, "Supplier, CFA").otherwise("-").alias("name"), F.concat((F.col("s_suppkey") % 30).cast("string"), F.lit(" yrs")).alias("total_exp"))
    got = E.managers_from_rows(F.array(row), {"name": r"SUPPLIER", "total_exp": r"\d+"})
    return table(spark, d, "supplier").select("s_suppkey", F.explode(got).alias("m")).select("s_suppkey", "m.name", "m.total_exp")


@query("e16_benchmark", "SELECT p_partkey, p_brand AS value, '' AS missed FROM part")
def e16(spark, d):
    text = F.concat(F.lit("Index: "), "p_brand", F.lit(" TRI"))
    return table(spark, d, "part").select("p_partkey", E.first_match(text, r"INDEX: (\S+)").alias("value"), E.first_match(text, r"Bench: (\S+)").alias("missed"))


@query("e17_date_from_key", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS inception_date FROM orders")
def e17(spark, d):
    """The key holds the date; the field becomes {inception_date: ...}."""
    key = F.concat(F.lit("Inception_Date "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" onwards"))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("f").alias("fund"), F.lit(0).cast("long").alias("ord"), key.alias("key"), F.lit("s").alias("kind"), F.lit("no date").alias("s"), F.lit(None).cast("array<string>").alias("arr"), F.lit(None).cast(E.KV).alias("kv"))
    got = R.apply_level(rows, [R.Dispatch("inception", "date", {"pattern": r"\d{2}/\d{2}/\d{4}"})])
    return got.select(F.col("doc_id").alias("o_orderkey"), E.kv_get(F.col("kv"), "inception_date").alias("inception_date"))


_ASSET_SQL = """
SELECT p_partkey, p_brand AS instrument_type, CAST(p_size AS VARCHAR) AS min, CAST(p_size + 50 AS VARCHAR) AS max, '' AS total, CASE WHEN p_size > 25 THEN 'High' ELSE 'Low' END AS risk_profile FROM part"""


def _asset_rows(spark, d):
    text = F.concat("p_brand", F.lit(" "), F.col("p_size").cast("string"), F.lit(" - "), (F.col("p_size") + 50).cast("string"), F.lit(" "), F.when(F.col("p_size") > 25, "High").otherwise("Low"))
    return table(spark, d, "part").select("p_partkey", E.asset_rows(text, r"(brand#\d+) (\d+) - (\d+) (HIGH|low)", ("instrument_type", "min", "max", "risk_profile")).alias("rows"))


@query("e18_assets", _ASSET_SQL)
def e18(spark, d):
    return _asset_rows(spark, d).select("p_partkey", F.explode("rows").alias("r")).select("p_partkey", "r.*")


@query("k13_asset_list", "SELECT p_partkey, p_brand AS instrument_type, unnest(['min', 'max', 'total']) AS type, unnest([CAST(p_size AS VARCHAR), CAST(p_size + 50 AS VARCHAR), '']) AS value FROM part")
def k13(spark, d):
    rows = _asset_rows(spark, d).select("p_partkey", F.explode(E.restructure_assets(F.col("rows"))).alias("r"))
    return rows.select("p_partkey", "r.instrument_type", F.explode("r.allocation").alias("a")).select("p_partkey", "instrument_type", "a.type", "a.value")


def _people(how: str, name: str, since_sql: str, n_sql: str) -> None:
    @query(name, f"SELECT s_suppkey, i, CAST(s_suppkey AS VARCHAR) || '/' || i AS name, {since_sql} AS since FROM (SELECT s_suppkey, unnest(range(CAST({n_sql} AS BIGINT))) AS i FROM supplier)")
    def run(spark, d):
        key = F.col("s_suppkey").cast("string")
        names = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.concat(key, F.lit("/"), i.cast("string")))
        since = F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(1), (F.col("s_suppkey") % 3).cast("int"))
        got = E.zip_people(names, since, names, how)
        return table(spark, d, "supplier").select("s_suppkey", F.posexplode(got).alias("i", "m")).select("s_suppkey", F.col("i").cast("long").alias("i"), "m.name", F.col("m.managing_fund_since").alias("since"))


_people("pad", "m1_zip_pad", "CASE WHEN i < s_suppkey % 3 THEN substr('abc', i + 1, 1) ELSE '' END", "3")
_people("cut", "m2_zip_cut", "substr('abc', i + 1, 1)", "s_suppkey % 3")
_people("repeat", "m3_zip_repeat", "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE substr('abc', CAST(least(i + 1, s_suppkey % 3) AS BIGINT), 1) END", "3")


@query("m1b_zip_fields", """
SELECT s_suppkey, i, CASE i WHEN 0 THEN 'Asha Rao' WHEN 1 THEN 'Ben Sen' ELSE 'Cy Das' END AS name, CASE WHEN i < s_suppkey % 3 THEN CAST(2000 + i AS VARCHAR) ELSE '' END AS since, CASE WHEN i < 2 THEN CAST(s_suppkey % 9 + i AS VARCHAR) ELSE '' END AS exp
FROM (SELECT s_suppkey, unnest(range(3)) AS i FROM supplier)""")
def m1b(spark, d):
    """Names, dates and experience under three keys, of unequal length."""
    from ..operators.reshape import zip_people_fields

    key = F.col("s_suppkey")
    since = F.array_join(F.slice(F.array(F.lit("since 2000"), F.lit("since 2001")), F.lit(1), (key % 3).cast("int")), ", ")
    texts = {"fund_manager": F.lit("Mr. Asha Rao; Mr. Ben Sen; Mr. Cy Das"), "managing_fund_since": since, "experience": F.concat((key % 9).cast("string"), F.lit(" years, "), (key % 9 + 1).cast("string"), F.lit(" years"))}
    none = F.lit(None)
    item = lambda n, k, v: F.struct(F.lit(n).cast("long").alias("ord"), F.lit(k).alias("key"), F.lit("s").alias("kind"), v.alias("s"), none.cast("array<string>").alias("arr"), none.cast(E.KV).alias("kv"))
    fields = table(spark, d, "supplier").select(key.cast("long").alias("doc_id"), F.lit("f").alias("fund"), F.explode(F.array(*[item(n, k, v) for n, (k, v) in enumerate(texts.items())])).alias("x")).select("doc_id", "fund", "x.*")
    got = zip_people_fields(fields, "people", {"name": r"\bfund_manager\b", "since": "managing_fund", "exp": "experience"}, {"name": r"Mr\. (\w+ \w+)", "since": r"since (\d+)", "exp": r"(\d+) years"})
    m = F.from_json("j", "managing_fund_since string, name string, total_exp string")
    rows = got.where("key = 'people'").select(F.col("doc_id").alias("s_suppkey"), F.posexplode("arr").alias("i", "j")).withColumn("m", m)
    return rows.select("s_suppkey", F.col("i").cast("long").alias("i"), "m.name", F.col("m.managing_fund_since").alias("since"), F.col("m.total_exp").alias("exp"))


@query("m2b_dated_people", """
SELECT s_suppkey, i, CASE i WHEN 0 THEN 'Asha Rao' ELSE 'Ben Sen' END AS name, CASE i WHEN 0 THEN 'June 1, 2015' ELSE 'May 2, 2016' END AS since, (s_suppkey % 9 + i) || ' years' AS exp
FROM (SELECT s_suppkey, unnest(range(CAST(1 + s_suppkey % 2 AS BIGINT))) AS i FROM supplier)""")
def m2b(spark, d):
    """Dates and years found apart and joined; names are cut to the years of experience."""
    key = F.col("s_suppkey")
    text = F.concat(F.lit("Asha Rao; Ben Sen; Cy Das; June 1, May 2, 2015 2016 2017 over "), (key % 9).cast("string"), F.when(key % 2 == 1, F.concat(F.lit(" over "), (key % 9 + 1).cast("string"))).otherwise(""))
    got = E.dated_people(text, name=r"([A-Z][a-z]+ [A-Z][a-z]+);", date=r"([A-Za-z]+\s*\d+),", year=r"\b(\d{4})\b", exp=r"over (\d+)")
    rows = table(spark, d, "supplier").select("s_suppkey", F.posexplode(got).alias("i", "m"))
    return rows.select("s_suppkey", F.col("i").cast("long").alias("i"), "m.name", F.col("m.managing_fund_since").alias("since"), F.col("m.total_exp").alias("exp"))


@query("m4_named_managers", "SELECT s_suppkey, 'Supplier' AS name, CAST(2000 + s_suppkey % 20 AS VARCHAR) AS managing_fund_since FROM supplier")
def m4(spark, d):
    text = F.concat(F.lit("since "), (2000 + F.col("s_suppkey") % 20).cast("string"), F.lit(": supplier;"))
    m = E.managers(text, r"since (\d+): (\w+);", ("managing_fund_since", "name"))
    return table(spark, d, "supplier").select("s_suppkey", F.explode(m).alias("m")).select("s_suppkey", "m.name", "m.managing_fund_since")


@query("m5_benchmark_variants", "SELECT p_partkey, 'Nifty ' || p_size AS repaired, p_brand AS removed, 'x ' || p_brand AS kept_text FROM part")
def m5(spark, d):
    part = table(spark, d, "part")
    repaired = E.benchmark(F.concat(F.lit("Ni y "), F.col("p_size").cast("string"), F.lit(" TRI")), r"(Nifty \d+)")
    removed = E.benchmark(F.concat(F.lit("(old) "), "p_brand"), r"(Brand#\d+)", remove=r"\(old\) ")
    return part.select("p_partkey", repaired.alias("repaired"), removed.alias("removed"), E.benchmark(F.concat(F.lit("x "), "p_brand"), r"^(Nifty)", else_text=True).alias("kept_text"))


@query("m5b_benchmark_inputs", "SELECT p_partkey, p_brand || ' ' || p_size AS of_values, p_brand AS of_both FROM part")
def m5b(spark, d):
    """Benchmarks looked for in a dictionary's values alone, and in key and value together."""
    p = table(spark, d, "part")
    kv = F.array(F.struct(F.lit("one").alias("k"), F.col("p_brand").alias("v")), F.struct(F.lit("two").alias("k"), F.col("p_size").cast("string").alias("v")))
    one = lambda n, key, kind, s, kv: F.struct(F.lit(n).cast("long").alias("ord"), key.alias("key"), F.lit(kind).alias("kind"), s.cast("string").alias("s"), F.lit(None).cast("array<string>").alias("arr"), kv.cast(E.KV).alias("kv"))
    rows = F.array(one(0, F.lit("values"), "d", F.lit(None), kv), one(1, F.concat(F.lit("both of "), "p_brand"), "s", F.lit("tri"), F.lit(None)))
    fields = p.select(F.col("p_partkey").alias("doc_id"), F.lit("f").alias("fund"), F.explode(rows).alias("x")).select("doc_id", "fund", "x.*")
    level = [R.Dispatch("values", "benchmark", {"pattern": r"BRAND#\d+ \d+", "source": "values"}), R.Dispatch("both", "benchmark", {"pattern": r"(brand#\d+) TRI", "source": "both"})]
    got = R.apply_level(fields, level).groupBy("doc_id").agg(F.max(F.when(F.col("ord") == 0, F.col("s"))).alias("of_values"), F.max(F.when(F.col("ord") == 1, F.col("s"))).alias("of_both"))
    return got.select(F.col("doc_id").alias("p_partkey"), "of_values", "of_both")


@query("m6_launch_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS first, strftime(o_orderdate, '%Y-%m-%d') || ' 2001-01-01' AS joined FROM orders")
def m6(spark, d):
    text = F.concat(F.lit("launched "), F.col("o_orderdate").cast("date").cast("string"), F.lit(", again 2001-01-01"))
    return table(spark, d, "orders").select("o_orderkey", E.first_match(text, r"\d{4}-\d{2}-\d{2}").alias("first"), E.date_from_key(text, r"\d{4}-\d{2}-\d{2}").alias("joined"))
