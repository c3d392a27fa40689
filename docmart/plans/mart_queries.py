"""Queries over grid cells (T), joins (J), the mart (A), inventories and sinks (S) and ingest (W)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as Ty
from pyspark.sql.window import Window

from ..functions import extract as E
from ..functions.text import metric_suspect
from ..operators import cells as C
from ..operators import mart as M
from ..operators import reshape as K
from ..operators import rules as R
from ..sources import documents as S
from ..sources.documents import work_folder
from ..streaming import ingest as W
from . import field_queries as Q
from .harness import CELLS, query, table, view


def grid(spark, d):
    return view(spark, d, CELLS)


def stacked(spark, d):
    return C.stack_tables(grid(spark, d), pad=0)


_CELLS = f"WITH c AS MATERIALIZED ({CELLS.replace('cast(row_no / 2 AS int)', 'cast(floor(row_no / 2) AS int)')})"
_HEIGHT = "h AS (SELECT doc_id, max(row_no) + 1 AS n FROM c WHERE table_no = 0 GROUP BY doc_id)"
#: Both tables of a document below each other.
_STACKED = f"{_CELLS}, {_HEIGHT}, s AS MATERIALIZED (SELECT c.doc_id, row_no + CASE table_no WHEN 1 THEN n ELSE 0 END AS row_no, col_no, text FROM c JOIN h USING (doc_id))"
_PLAIN = "regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')"


@query("t1_stack", f"{_CELLS}, {_HEIGHT} SELECT c.doc_id, row_no + CASE table_no WHEN 1 THEN n + 1 ELSE 0 END AS row_no, col_no, text FROM c JOIN h USING (doc_id)")
def t1(spark, d):
    return C.stack_tables(grid(spark, d)).select("doc_id", "row_no", "col_no", "text")


@query("t1b_beside", f"{_CELLS} SELECT doc_id, row_no, col_no + table_no * 5 AS col_no, text FROM c")
def t1b(spark, d):
    return C.stack_tables(grid(spark, d), horizontal=True).select("doc_id", "row_no", F.col("col_no").cast("int").alias("col_no"), "text")


@query("t2_find_rows", f"{_STACKED}, r AS (SELECT doc_id, row_no FROM s GROUP BY ALL HAVING count(*) FILTER (regexp_matches({_PLAIN}, 'red|brand 1')) >= 2) SELECT doc_id, row_no FROM r UNION ALL SELECT DISTINCT doc_id, 0 FROM s WHERE doc_id NOT IN (SELECT doc_id FROM r)")
def t2(spark, d):
    return C.find_rows(stacked(spark, d), ["red", "brand 1"], 2).select("doc_id", "row_no")


@query("t3_find_columns", f"{_STACKED}, r AS (SELECT doc_id, col_no FROM s GROUP BY ALL HAVING sum(len(regexp_extract_all({_PLAIN}, 'red|small'))) >= 3) SELECT doc_id, col_no FROM r UNION ALL SELECT DISTINCT doc_id, 0 FROM s WHERE doc_id NOT IN (SELECT doc_id FROM r)")
def t3(spark, d):
    return C.find_columns(stacked(spark, d), ["red", "small"], 3)


@query("t4_sub_grid", f"{_CELLS} SELECT doc_id, table_no, row_no - 5 AS row_no, col_no - 1 AS col_no, text FROM c WHERE row_no BETWEEN 5 AND 11 AND col_no >= 1")
def t4(spark, d):
    g = C.sub_grid(grid(spark, d), (5, 12), (1, 99))
    return g.select("doc_id", "table_no", "row_no", F.col("col_no").cast("int").alias("col_no"), "text")


@query("t5_drop_blank", f"{_CELLS}, w AS (SELECT *, count(text) OVER (PARTITION BY doc_id, table_no, row_no) AS r, count(text) OVER (PARTITION BY doc_id, table_no, col_no) AS k FROM (SELECT * FROM c WHERE col_no IN (0, 1, 3))) SELECT doc_id, table_no, row_no, col_no, text FROM w WHERE r > 0 AND k > 0")
def t5(spark, d):
    """Grids without their size column: rows can be blank, and the last column always is."""
    some = grid(spark, d).where("col_no <> 2")
    return C.drop_blank_lines(some, ["doc_id", "table_no"]).select("doc_id", "table_no", "row_no", F.col("col_no").cast("int").alias("col_no"), "text")


def _filled(cells: str) -> str:
    """``f``: the title of each row of the cells."""
    return f"f AS (SELECT doc_id, row_no, last_value(text IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY row_no) AS title FROM {cells} WHERE col_no = 0)"


def _collected(cells: str) -> str:
    key = "lower(replace(regexp_replace(title, '[^a-zA-Z0-9_ .]', '', 'g'), ' ', '_'))"
    texts = f"string_agg(text, '|' ORDER BY {cells}.row_no, col_no)"
    return f"{_filled(cells)} SELECT {cells}.doc_id, {key} AS title, {texts} AS texts FROM {cells} JOIN f ON {cells}.doc_id = f.doc_id AND {cells}.row_no = f.row_no WHERE col_no > 0 AND title IS NOT NULL AND text IS NOT NULL GROUP BY {cells}.doc_id, title"


@query("t6_fill_titles", f"{_STACKED}, {_filled('s')} SELECT s.doc_id, s.row_no, col_no, title FROM s JOIN f ON s.doc_id = f.doc_id AND s.row_no = f.row_no")
def t6(spark, d):
    return C.fill_titles(stacked(spark, d)).select("doc_id", "row_no", F.col("col_no").cast("int").alias("col_no"), "title")


@query("t7_collect", f"{_STACKED}, {_collected('s')}")
def t7(spark, d):
    return C.collect_by_title(C.fill_titles(stacked(spark, d))).select("doc_id", "title", F.array_join("texts", "|").alias("texts"))


#: The column of the first keyword, 0 where there is none, and three columns from there.
_SLICED = f"k AS (SELECT doc_id, coalesce(min(col_no) FILTER (hits), 0) AS at0 FROM (SELECT doc_id, col_no, sum(len(regexp_extract_all({_PLAIN}, 'brand 1|brand 2'))) >= 1 AS hits FROM s GROUP BY ALL) GROUP BY doc_id), b AS MATERIALIZED (SELECT s.doc_id, row_no, col_no - at0 AS col_no, text FROM s JOIN k ON s.doc_id = k.doc_id AND col_no BETWEEN at0 AND at0 + 2)"


@query("t8_scheme_table", f"{_STACKED}, {_SLICED}, {_collected('b')}")
def t8(spark, d):
    """Titles are looked for in the brand column, if the document has one of the brands."""
    return C.scheme_table(grid(spark, d), ["brand 1", "brand 2"], 3).select("doc_id", "title", F.array_join("texts", "|").alias("texts"))


_FROM_ROW = "r AS (SELECT doc_id, coalesce(min(row_no) FILTER (regexp_matches(coalesce(text, ''), '(?i)red')), 0) AS at0 FROM s GROUP BY doc_id)"


@query("t9_manager_table", f"{_STACKED}, {_FROM_ROW} SELECT s.doc_id, row_no, max(text) FILTER (col_no = 1) AS name, max(text) FILTER (col_no = 2) AS since FROM s JOIN r ON s.doc_id = r.doc_id AND row_no > at0 GROUP BY s.doc_id, row_no")
def t9(spark, d):
    return C.manager_table(grid(spark, d), ["red"], {1: "name", 2: "since"}).select("doc_id", "row_no", "name", "since")


@query("t10_allocation", f"{_STACKED}, {_FROM_ROW} SELECT s.doc_id, row_no, trim(regexp_replace(regexp_replace(string_agg(lower(coalesce(text, '')), ' ' ORDER BY col_no), '[^%a-z0-9]+', ' ', 'g'), ' +', ' ', 'g')) AS text, 'scheme ' || s.doc_id AS scheme FROM s JOIN r ON s.doc_id = r.doc_id AND row_no > at0 AND row_no < at0 + 5 GROUP BY s.doc_id, row_no")
def t10(spark, d):
    cells = stacked(spark, d)
    names = cells.select("doc_id").distinct().withColumn("clip_text", F.concat(F.lit("Scheme: "), "doc_id"))
    return C.allocation_rows(cells, ["red"], 2, names=names).select("doc_id", "row_no", "text", "scheme")


def _side(values: str, join: str) -> str:
    return f"""{_STACKED}, r AS (SELECT doc_id, row_no, coalesce(string_agg(coalesce(text, ''), ' ' ORDER BY col_no) FILTER (col_no IN ({values})), '') AS row_text,
  max(nullif(regexp_extract(text, '(red|blue|small) [a-z]+'), '')) FILTER (col_no = 0) AS own FROM s GROUP BY ALL),
f AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY row_no) AS scheme FROM r)
SELECT doc_id, scheme, {join} FROM f WHERE scheme IS NOT NULL GROUP BY ALL"""


@query("t11_side_table", _side("1, 2", "count(*) AS n_texts, min(row_text) AS first, max(row_text) AS last"))
def t11(spark, d):
    got = C.scheme_side_table(stacked(spark, d), 0, [1, 2], "(red|blue|small) [a-z]+")
    return got.select("doc_id", "scheme", F.size("texts").alias("n_texts"), F.array_min("texts").alias("first"), F.array_max("texts").alias("last"))


@query("t12_side_text", _side("2", "string_agg(row_text, '; ' ORDER BY row_no) AS text"))
def t12(spark, d):
    return C.scheme_side_table(stacked(spark, d), 0, [2], "(red|blue|small) [a-z]+", sep="; ")


#: In each document the columns stand in another order.
_TURNED = f"{_STACKED}, q AS (SELECT doc_id, row_no, max(text) FILTER (col_no = 0) AS name, coalesce(max(text) FILTER (col_no = 1), '') AS brand, coalesce(max(text) FILTER (col_no = 2), '') AS size FROM s GROUP BY ALL), f AS (SELECT *, nullif(regexp_extract(name, '(red|blue|small) [a-z]+'), '') AS own, last_value(nullif(regexp_extract(name, '(red|blue|small) [a-z]+'), '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY row_no) AS scheme FROM q)"


def turned(spark, d):
    cells = stacked(spark, d)
    return cells.withColumn("col_no", (F.col("col_no") + F.col("doc_id") % 4) % 4)


@query("t11b_side_columns", f"{_TURNED} SELECT doc_id, scheme, string_agg(CASE WHEN own IS NULL THEN brand ELSE brand || '|' || own || ' ' || brand END, '|' ORDER BY row_no) AS texts FROM f WHERE scheme IS NOT NULL AND doc_id IN (SELECT doc_id FROM q WHERE brand <> '') GROUP BY ALL")
def t11b(spark, d):
    """Columns found by keyword in each document; a row that names its scheme gives its text twice."""
    got = C.side_table(turned(spark, d), {"name": (["red", "blue", "small"], 1), "brand": (["brand"], 1)}, "name", "(red|blue|small) [a-z]+", twice=True, partitioned=True)
    return got.select("doc_id", "scheme", F.array_join("brand", "|").alias("texts"))


@query("t12b_side_columns", f"{_TURNED} SELECT doc_id, scheme, string_agg(brand, '; ' ORDER BY row_no) AS brand, string_agg(size, '; ' ORDER BY row_no) AS size FROM f WHERE scheme IS NOT NULL GROUP BY ALL")
def t12b(spark, d):
    """Two value columns found by their cells, joined for each scheme."""
    roles = {"name": (["red", "blue", "small"], 1), "brand": (["brand"], 1), "size": ([r"^\d+$"], 1)}
    return C.side_table(turned(spark, d), roles, "name", "(red|blue|small) [a-z]+", sep="; ", partitioned=True)


# joins

_RULES = [(1, "ring"), (2, "widget"), (3, "bolt"), (4, "gear")]


@query("j1_bridge", """
WITH n AS (SELECT DISTINCT p_name FROM part), r AS (SELECT * FROM (VALUES (1, 'ring'), (2, 'widget'), (3, 'bolt'), (4, 'gear')) v(i, p)),
l AS (SELECT p_name AS fund, i FROM n, r WHERE contains(p_name, p)),
s AS (SELECT 'side of ' || p_name AS side_fund, i FROM n, r WHERE contains(p_name, p) AND p_name LIKE '%e%')
SELECT n.p_name AS fund, side_fund, length(side_fund) AS side_value FROM n LEFT JOIN (SELECT DISTINCT l.fund, side_fund FROM l JOIN s USING (i)) b ON b.fund = n.p_name""")
def j1(spark, d):
    names = table(spark, d, "part").select(F.col("p_name").alias("fund")).distinct()
    side = names.where("fund like '%e%'").select(F.concat(F.lit("side of "), "fund").alias("side_fund")).withColumn("side_value", F.length("side_fund"))
    return M.bridge_join(names, side, _RULES).select("fund", "side_fund", F.col("side_value").cast("long").alias("side_value"))


@query("j1b_override", """
WITH p AS (SELECT *, p_partkey // 20 AS doc_id, p_name || ' ' || p_partkey AS fund FROM part), r AS (SELECT * FROM (VALUES (1, 'ring'), (2, 'widget'), (3, 'bolt'), (4, 'gear')) v(i, p)),
l AS (SELECT doc_id, fund, i FROM p, r WHERE contains(p_name, r.p)), s AS (SELECT DISTINCT doc_id, i, p_partkey, p_brand, p_size FROM p, r WHERE contains(p_name, r.p) AND p_name LIKE '%e%'),
m AS (SELECT l.doc_id, fund, arg_max(p_brand, p_partkey) AS brand, arg_max(CAST(p_size AS VARCHAR), p_partkey) FILTER (p_size % 2 = 0) AS size FROM l JOIN s USING (doc_id, i) GROUP BY ALL)
SELECT doc_id, fund, 'type' AS key, 0 AS ord, p_type AS value FROM p UNION ALL SELECT p.doc_id, fund, 'brand', 1, coalesce(m.brand, 'own') FROM p LEFT JOIN m USING (doc_id, fund)
UNION ALL SELECT doc_id, fund, 'size', 2, size FROM m WHERE size IS NOT NULL""")
def j1b(spark, d):
    """Fields of side tables override a fund's own, the last side fund winning; a new key comes behind."""
    p = table(spark, d, "part").withColumn("doc_id", F.floor(F.col("p_partkey") / 20).cast("long"))
    text = lambda n, key, v: F.struct(F.lit(n).cast("long").alias("ord"), F.lit(key).alias("key"), F.lit("s").alias("kind"), v.cast("string").alias("s"), F.lit(None).cast("array<string>").alias("arr"), F.lit(None).cast(E.KV).alias("kv"))
    fields = p.select("doc_id", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("fund"), F.explode(F.array(text(0, "type", F.col("p_type")), text(1, "brand", F.lit("own")))).alias("x")).select("doc_id", "fund", "x.*")
    sides = F.when(F.col("p_size") % 2 == 0, F.array(text(0, "brand", F.col("p_brand")), text(1, "size", F.col("p_size")))).otherwise(F.array(text(0, "brand", F.col("p_brand"))))
    side = p.where("p_name like '%e%'").select("doc_id", F.concat(F.lit("side of "), "p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("side_fund"), F.col("p_partkey").alias("side_no"), F.explode(sides).alias("x")).select("doc_id", "side_fund", "side_no", "x.*")
    got = M.override_side(fields, side, _RULES)
    return got.select("doc_id", "fund", "key", (F.row_number().over(Window.partitionBy("doc_id", "fund").orderBy("ord")) - 1).alias("ord"), F.col("s").alias("value"))


@query("j2_mart_read", "SELECT o_orderkey, o_orderpriority, l.qty, m.disc FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) l ON o_orderkey = l.l_orderkey LEFT JOIN (SELECT l_orderkey, max(l_discount) AS disc FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) m ON o_orderkey = m.l_orderkey WHERE o_orderpriority LIKE '%LOW%' AND o_orderstatus = 'F'")
def j2(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_orderkey", "key")
    items = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "key")
    loads = items.groupBy("key").agg(F.sum("l_quantity").alias("qty"))
    metrics = items.where("l_linenumber = 1").groupBy("key").agg(F.max("l_discount").alias("disc"))
    got = M.read_mart(orders, loads, metrics, ["key"], like=("o_orderpriority", "%LOW%"), equal={"o_orderstatus": "F"})
    return got.select(F.col("key").alias("o_orderkey"), "o_orderpriority", "qty", "disc")


@query("j3_union", "SELECT 'a' AS source, o_orderkey AS name, o_totalprice AS price, NULL::VARCHAR AS status FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'b', o_orderkey, NULL, o_orderstatus FROM orders WHERE o_orderkey % 7 = 0")
def j3(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "name")
    a = o.where("o_orderstatus = 'O'").select(F.col("o_totalprice").alias("price"), "name")
    b = o.where("name % 7 = 0").select("name", F.col("o_orderstatus").alias("status"))
    nothing = o.limit(0).select("o_custkey")  # a house without records
    return M.union_sources({"a": a, "none": nothing, "b": b}, "name")


@query("j4_diff", """
SELECT o_orderkey AS name, 'price' AS field, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS a, CAST(CAST(floor(o_totalprice) AS BIGINT) + 1 AS VARCHAR) AS b FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT o_orderkey, unnest(['price', 'status']), unnest([CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), o_orderstatus]), NULL FROM orders WHERE o_orderkey % 10 = 2""")
def j4(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("name"), F.floor("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    b = o.where("name % 10 <> 2").withColumn("price", F.when(F.col("name") % 10 == 1, F.col("price") + 1).otherwise(F.col("price")))
    return M.diff_sources(o, b, "name", ["price", "status"])


@query("j5_dimension", "SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE (SELECT max(c_custkey) FROM customer WHERE c_custkey % 2 = 0) + row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_name) END AS id FROM customer")
def j5(spark, d):
    c = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    return M.dense_dimension_keys(c, c.where("id % 2 = 0"), "name", "id")


def _houses(spark, d):
    params = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("amc_key"), "n_name")
    return table(spark, d, "customer").withColumnRenamed("c_nationkey", "amc_key"), params


@query("j6_lookup", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey < 3")
def j6(spark, d):
    return R.lookup(*_houses(spark, d)).select("c_custkey", "n_name")


@query("j6b_skipped", "SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def j6b(spark, d):
    return R.skipped(*_houses(spark, d)).select("c_custkey")


# aggregation and mart

_EVENTS = ("click", "error", "purchase", "signup", "view")
_PIVOT = ", ".join(f"arg_max(event_id, event_id) FILTER (event_type = '{e}') AS \"{e}\"" for e in _EVENTS)


@query("a6_metric_pivot", f"SELECT user_id, {_PIVOT} FROM events GROUP BY user_id")
def a6(spark, d):
    return M.pivot_last(table(spark, d, "events"), ["user_id"], "event_type", "event_id", "event_id", _EVENTS, default=None)


@query("a1_wide_rows", """
SELECT p_partkey AS doc_id, p_brand || ' TRI' AS benchmark_index, CAST(p_size * 100 AS VARCHAR) AS min_amt, 'Nil' AS entry_load, p_size || '%' AS exit_load,
 CAST((p_size % 7) * 100 + 50 AS VARCHAR) AS port_turnover_ratio, round(p_size / CAST(365 AS DOUBLE), 4) AS avg_maturity, '' AS beta FROM part""")
def a1(spark, d):
    wide = M.wide_rows(Q.records(spark, d), ["benchmark_index", "min_amt"], ["port_turnover_ratio", "avg_maturity", "beta"])
    return wide.withColumn("avg_maturity", F.col("avg_maturity").cast("double")).drop("fund")


@query("a1b_wide_all", f"""
SELECT p_partkey AS doc_id, {', '.join(f"{v} AS {k}" for k, v in {k: "''" for k in (*M.WIDE_TEXTS, *M.WIDE_METRICS)}.items() if k not in ('benchmark_index', 'min_amt', 'min_amt_multiple', 'average_div_yield', 'ytm', 'amc_name'))},
 p_brand || ', ' || p_type AS benchmark_index, CAST(p_size * 100 AS VARCHAR) AS min_amt, CAST(1 + p_size % 5 AS VARCHAR) AS min_amt_multiple, 'House' AS amc_name, '1.5' AS average_div_yield, CAST(p_size AS VARCHAR) AS ytm, 'Nil' AS entry_load, p_size || '%' AS exit_load FROM part""")
def a1b(spark, d):
    """All 11 texts, both loads and 22 metrics of a wide row; a list of benchmarks is joined, of a repeated metric the last counts."""
    size = F.col("p_size").cast("string")
    pair = lambda a, k, b, v: F.struct(k.alias(a), v.alias(b))
    metrics = F.array(*[pair("name", F.lit(k), "value", v) for k, v in (("average_div_yield", F.lit("1.5")), ("ytm", F.lit("0")), ("ytm", size), ("average_div_yld", F.lit("9")), ("unknown", F.lit("1")))])
    loads = F.array(*[pair("type", F.lit(k), "comment", v) for k, v in (("entry_load", F.lit("old")), ("entry_load", F.lit("Nil")), ("exit_load", F.concat(size, F.lit("%"))))])
    records = table(spark, d, "part").select(
        F.col("p_partkey").cast("long").alias("doc_id"), F.col("p_name").alias("fund"), F.lit("House").alias("amc_name"), F.array("p_brand", "p_type").alias("benchmark_index"), F.lit(None).cast("string").alias("monthly_aaum_date"),
        (F.col("p_size") * 100).cast("string").alias("min_amt"), (1 + F.col("p_size") % 5).cast("string").alias("min_amt_multiple"), metrics.alias("metrics"), loads.alias("load"),
    )
    return M.wide_rows(records).drop("fund")


@query("a2_sheet_rows", "SELECT p_brand AS sheet, p_partkey AS doc_id, p_brand || ' TRI' AS benchmark_index, 'Nil' AS entry_load, count(*) OVER (PARTITION BY p_brand) AS n_rows FROM part")
def a2(spark, d):
    """The wide rows of each house on a sheet of its own, written and read back."""
    path = work_folder(spark)
    wide = M.wide_rows(Q.records(spark, d), ["benchmark_index"], [])
    house = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("doc_id"), "p_brand")
    S.write_sheets(wide.join(house, "doc_id").select("doc_id", "benchmark_index", "entry_load", "p_brand"), "p_brand", path)
    rows = spark.read.option("header", True).schema("doc_id long, benchmark_index string, entry_load string, p_brand string, sheet string").csv(path)
    return rows.select("sheet", "doc_id", "benchmark_index", "entry_load", F.count(F.lit(1)).over(Window.partitionBy("sheet")).alias("n_rows"))


@query("a3_funds", """
SELECT p_partkey AS doc_id, p_partkey % 7 AS amc_id, '2025-02-01' AS entered_time, 'jan_25' AS amc_for_month, 'factsheet' AS data_from, '' AS amc_name, p_brand || ' TRI' AS benchmark_index,
 '' AS main_scheme_name, '' AS mutual_fund_name, '' AS monthly_aaum_date, '' AS monthly_aaum_value, '20150' || (1 + p_size % 9) || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') AS scheme_launch_date,
 '' AS min_addl_amt, '' AS min_addl_amt_multiple, CAST(p_size * 100 AS VARCHAR) AS min_amt, CAST(1 + p_size % 5 AS VARCHAR) AS min_amt_multiple, p_size * 100.0 AS min_amt_num, CAST(NULL AS DOUBLE) AS min_addl_amt_num,
 CAST(DATE '2015-01-01' + to_months(CAST(p_size % 9 AS INT)) + to_days(CAST(p_partkey % 28 AS INT)) AS DATE) AS launch_date FROM part""")
def a3(spark, d):
    return M.funds_table(Q.records(spark, d), F.col("doc_id") % 7, F.lit("2025-02-01"), F.lit("jan_25"), "factsheet")


_FACT_KEYS = "p_partkey % 7 AS amc_id, p_partkey AS doc_id, p_name || ' Fund' AS main_scheme_name, '2025-02-01' AS entered_time, 'jan_25' AS amc_for_month, 'factsheet' AS data_from"


def _facts(make, spark, d):
    return make(Q.records(spark, d), F.col("doc_id") % 7, F.lit("2025-02-01"), F.lit("jan_25"), "factsheet")


@query("a4_managers", f"SELECT {_FACT_KEYS}, 'Asha ' || CASE WHEN p_size % 2 = 0 THEN 'Rao' ELSE 'Sen' END AS name, CAST(2000 + p_size % 20 AS VARCHAR) AS managing_fund_since, '' AS qualification, CAST(1 + p_size % 30 AS VARCHAR) || ' Years' AS total_exp FROM part UNION ALL SELECT {_FACT_KEYS}, 'Second Person', '2011', '', '9 Years' FROM part")
def a4(spark, d):
    return _facts(M.managers_table, spark, d)


@query("a5_loads", f"SELECT {_FACT_KEYS}, 'Nil' AS entry_load, p_size || '%' AS exit_load FROM part")
def a5(spark, d):
    """Loads with both spellings of the type; of one type the last counts."""
    def make(r, *keys):
        older = F.transform("load", lambda x: F.struct(F.lit("old").alias("comment"), F.regexp_replace(x["type"], "_load$", "").alias("type")))
        return M.loads_table(r.withColumn("load", F.concat(older, "load")), *keys)

    return _facts(make, spark, d)


_OF_PART = "FROM part"


@query("a7_normalised", f"""
SELECT 'common' AS tab, p_partkey AS doc_id, p_brand || ' TRI' AS k1, CAST(p_size * 100 AS VARCHAR) AS k2, false AS is_migrated {_OF_PART}
UNION ALL SELECT 'benchmarks', p_partkey, p_brand || ' TRI', '', false {_OF_PART}
UNION ALL SELECT 'managers', p_partkey, unnest(['Asha ' || CASE WHEN p_size % 2 = 0 THEN 'Rao' ELSE 'Sen' END, 'Second Person']), unnest([CAST(2000 + p_size % 20 AS VARCHAR), '2011']), false {_OF_PART}
UNION ALL SELECT 'loads', p_partkey, unnest(['entry_load', 'exit_load']), unnest(['Nil', p_size || '%']), false {_OF_PART}
UNION ALL SELECT 'asset_allocation', p_partkey, p_brand, 'High', false {_OF_PART}
UNION ALL SELECT 'field_locations', p_partkey, unnest(['benchmark_index', 'min_amt', 'load_entry_load', 'load_exit_load', 'metrics_port_turnover_ratio', 'metrics_avg_maturity', 'fund_manager_managing_fund_since', 'fund_manager_name', 'fund_manager_qualification', 'fund_manager_total_exp']), CAST(p_size + 1 AS VARCHAR), false {_OF_PART}""")
def a7(spark, d):
    """All normalised tables, from records whose lists hold every row twice."""
    r = Q.records(spark, d)
    asset = F.struct(F.array(F.struct(F.lit("min").alias("type"), F.lit("1").alias("value"))).alias("allocation"), F.regexp_replace("benchmark_index", " TRI", "").alias("instrument_type"), F.lit("High").alias("risk_profile"))
    r = r.withColumns({c: F.concat(c, c) for c in ("load", "fund_manager")} | {"assets": F.array(asset, asset)})
    places = K.field_locations(r, Q.pages(spark, d), ["benchmark_index", "min_amt"])
    t = M.normalised_tables(r, places.unionByName(places), ["benchmark_index", "min_amt"], "assets")
    keys = {"common": ("benchmark_index", "min_amt"), "benchmarks": ("benchmark_index",), "managers": ("name", "since"), "loads": ("type", "value"), "asset_allocation": ("instrument_type", "risk_level"), "field_locations": ("field_name", "page_no")}
    parts = [t[n].select(F.lit(n).alias("tab"), "doc_id", F.col(k[0]).alias("k1"), (F.col(k[1]) if len(k) > 1 else F.lit("")).alias("k2"), "is_migrated") for n, k in keys.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("a8_distinct_keys", """
SELECT DISTINCT 'm' AS level, 1 AS depth, unnest(json_keys(props)) AS key FROM events UNION SELECT DISTINCT 't', 1, event_type || '_x' FROM events
UNION SELECT 't', 2, unnest(['inner_list', 'user_id']) UNION SELECT DISTINCT 't', 3, 'u' || (user_id % 5) FROM events""")
def a8(spark, d):
    """Keys of a map, and of a map of structs with a list of maps, at every depth."""
    deep = F.struct(F.array(F.create_map(F.concat(F.lit("U"), (F.col("user_id") % 5).cast("string")), F.lit(1))).alias("Inner List"), "user_id")
    e = table(spark, d, "events").select(F.from_json("props", "map<string,string>").alias("m"), F.create_map(F.concat(F.initcap("event_type"), F.lit(" X")), deep).alias("t"))
    return M.distinct_keys(e, ["m", "t"])


@query("a10_run_summary", "SELECT year(o_orderdate) AS run, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def a10(spark, d):
    ledger = table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("run"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("file_name"))
    return M.run_summary(ledger)


# sources and sinks


_FILES = "SELECT 'in/' || CASE page_id % 4 WHEN 0 THEN 'axis_fund' ELSE 'b' || (page_id % 9) END || '/' || (page_id % 12) || '_30-Apr-25' || CASE WHEN page_id % 5 = 0 THEN '_1' ELSE '' END || '_' || CASE WHEN page_id % 3 = 0 THEN 'SID' ELSE 'FS' END || '.pdf' AS path, page_id % 12 AS amc, page_id FROM pages"


def files(spark, d):
    p = F.col("page_id")
    text = lambda c: c.cast("string")
    folder = F.when(p % 4 == 0, "axis_fund").otherwise(F.concat(F.lit("b"), text(p % 9)))
    name = F.concat(text(p % 12), F.lit("_30-Apr-25"), F.when(p % 5 == 0, "_1").otherwise(""), F.lit("_"), F.when(p % 3 == 0, "SID").otherwise("FS"), F.lit(".pdf"))
    return table(spark, d, "pages").select(F.concat(F.lit("in/"), folder, F.lit("/"), name).alias("path")).distinct()


@query("s1_inventory", f"""
WITH f AS (SELECT DISTINCT path FROM ({_FILES})), p AS (SELECT path, string_split(path, '/')[-1] AS n FROM f),
k AS (SELECT path, CASE WHEN n LIKE '%SID.pdf' THEN 'SID' ELSE 'FS' END AS doc_type, CASE WHEN n LIKE '%SID.pdf' THEN string_split(n, '_')[1] ELSE string_split(n, '_')[1] || '_' || CASE WHEN n LIKE '%\\_1\\_%' ESCAPE '\\' THEN '1' ELSE '0' END END AS fund_key FROM p)
SELECT doc_type, fund_key, CASE doc_type WHEN 'FS' THEN all_paths ELSE last_path END AS paths FROM (SELECT doc_type, fund_key, string_agg(path, '|' ORDER BY path) AS all_paths, max(path) AS last_path FROM k GROUP BY ALL)""")
def s1(spark, d):
    return S.inventory(files(spark, d)).withColumn("paths", F.array_join("paths", "|"))


@query("s2_display_names", f"SELECT DISTINCT path, CASE WHEN path LIKE '%axis%' THEN 'Axis Fund' ELSE 'B' || regexp_extract(path, 'in/b([0-9])', 1) END || CASE WHEN path LIKE '%\\_1\\_%' ESCAPE '\\' THEN ' Passive' ELSE '' END AS display_name FROM ({_FILES})")
def s2(spark, d):
    return S.display_names(files(spark, d))


@query("s3_folder_suffixes", f"WITH f AS (SELECT DISTINCT path, regexp_replace(path, '/[^/]*$', '') AS folder FROM ({_FILES})), n AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY path) AS n FROM f) SELECT path, folder, CASE n WHEN 1 THEN folder ELSE folder || '_' || chr(CAST(n + 64 AS INT)) END AS folder_key FROM n")
def s3(spark, d):
    return S.folder_suffixes(files(spark, d))


@query("s4_first_per_folder", f"SELECT regexp_replace(path, '/[^/]*$', '') AS folder, min(path) AS path FROM ({_FILES}) GROUP BY 1")
def s4(spark, d):
    return S.first_per_folder(files(spark, d))


@query("s6_read_documents", "SELECT p_partkey AS doc_id, 'FS' AS file_type, p_brand || ' TRI' AS benchmark_index, CAST(p_size * 100 AS VARCHAR) AS min_amt, 2 AS n_loads FROM part")
def s6(spark, d):
    """Records written as JSON documents and read back."""
    from ..operators.reshape import documents_of

    path = work_folder(spark)
    documents_of(Q.records(spark, d), "20250101").write.json(path)
    r = S.read_documents(spark, path, multi_line=False)
    return r.select(F.col("document_name").cast("long").alias("doc_id"), "file_type", "benchmark_index", "min_amt", F.size("load").alias("n_loads"))


@query("s9_document_files", "SELECT CAST(s_suppkey AS VARCHAR) AS document_name, 1 AS n_records FROM supplier")
def s9(spark, d):
    """One folder and file for each document."""
    from ..operators.reshape import documents_of

    path = work_folder(spark)
    records = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.col("s_name").alias("fund"))
    S.write_documents(documents_of(records, "20250101"), path)
    files = S.list_files(spark, path, "*.json").select(F.regexp_extract("path", "document=([^/]+)/", 1).alias("document_name")).distinct()
    read = S.read_documents(spark, path, multi_line=False).groupBy("document_name").agg(F.count(F.lit(1)).cast("int").alias("n_records"))
    return files.join(read, "document_name")


@query("s6b_drifted", "SELECT p_partkey, p_brand AS value FROM part")
def s6b(spark, d):
    j = F.when(F.col("p_size") % 2 == 0, F.to_json(F.array("p_brand"))).otherwise(F.concat(F.lit('"'), "p_brand", F.lit('"')))
    return table(spark, d, "part").select("p_partkey", S.drifted_text(F.parse_json(j)).alias("value"))


@query("s8_terms", "SELECT DISTINCT p_name AS term FROM part")
def s8(spark, d):
    path = work_folder(spark)
    table(spark, d, "part").select(F.col("p_name").alias("indexes")).write.option("header", True).csv(path)
    return S.term_set(spark, path)


@query("s10_sheets", "SELECT n_name || '_x_' AS sheet, n_nationkey FROM nation")
def s10(spark, d):
    path = work_folder(spark)
    rows = table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit("/x*")).alias("name"))
    S.write_sheets(rows, "name", path)
    return spark.read.option("header", True).schema("n_nationkey int, name string, sheet string").csv(path).select("sheet", "n_nationkey")


@query("s11_ledger", "SELECT 2 AS run, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 1, 'failed', count(*) FROM orders WHERE o_orderstatus = 'F'")
def s11(spark, d):
    path = work_folder(spark)
    o = table(spark, d, "orders").select(F.lit(2).alias("run"), F.col("o_orderkey").cast("string").alias("file_name"), F.lit("p").alias("path"), F.col("o_orderstatus").alias("status"))
    S.append_ledger(o, path)
    S.append_ledger(o.where("status = 'F'").withColumn("run", F.lit(1)).withColumn("status", F.lit("failed")), path)
    return spark.read.parquet(path).groupBy("run", "status").agg(F.count(F.lit(1)).alias("n"))


@query("s12_mart_tables", "SELECT p_partkey AS doc_id, p_brand || ' TRI' AS benchmark_index, 'Nil' AS entry_load, p_size || '%' AS exit_load FROM part")
def s12(spark, d):
    """Mart tables written to a database and read from it in parts.

    The database is the session's; without one, on a single machine, an embedded one in a new folder, which only one process can open.
    """
    name, own = f"m{uuid.uuid4().hex[:12]}", {}
    if not spark.conf.get("spark.docmart.jdbc.url", ""):
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.docmart.jdbc.url to a database that all executors reach")
        own = {"url": f"jdbc:derby:{work_folder(spark)};create=true"}
    r = S.cut(Q.records(spark, d).select("doc_id", "benchmark_index", "load"))  # worked out once for all that follows
    S.write_mart(r.select("doc_id", "benchmark_index"), f"{name}_funds", options=own)
    S.write_mart(r.select("doc_id", *M.load_columns(F.col("load"))), f"{name}_loads", options=own)
    top = r.agg(F.max("doc_id")).first()[0] or 1
    funds, loads = (S.read_mart_table(spark, f"{name}_{t}", "doc_id", 0, top, 4, options=own) for t in ("funds", "loads"))
    return M.read_mart(funds, loads, r.select("doc_id"), ["doc_id"])


@query("a7b_migration", """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' 2' ELSE s_name END AS s_name, CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS run, true AS is_migrated, count(*) OVER (PARTITION BY s_nationkey) AS n_of_key FROM supplier""")
def a7b(spark, d):
    """Two batches migrated in two runs, the second of which breaks off before its flags and is made again."""
    from ..operators.migrate import Migration

    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", F.concat(F.lit("nation "), "s_nationkey").alias("nation"))
    m = Migration(spark, work_folder(spark), "s_suppkey bigint, s_name string, nation string", ["s_suppkey"], {"nation": "nation_id"})
    m.stage(rows, 0)
    m.run(0)
    m.stage(rows.where("s_suppkey % 3 = 0").withColumn("s_name", F.concat("s_name", F.lit(" 2"))), 1)
    m.load(1)  # broken off here
    m.run(1)
    m.run(2)  # finds nothing
    state = m.staged().select("s_suppkey", "is_migrated")
    got = m.mart().withColumn("n_of_key", F.count(F.lit(1)).over(Window.partitionBy("nation_id"))).join(state, "s_suppkey")
    return got.select("s_suppkey", "s_name", "run", "is_migrated", "n_of_key")


@query("w3b_observed", "SELECT count(*) AS rows, count(*) FILTER (p_size % 3 = 0) AS several, count(*) FILTER (p_size % 3 = 1) AS sign FROM part")
def w3b(spark, d):
    """Suspect values counted in the pass that writes the rows."""
    size = F.col("p_size").cast("string")
    value = F.when(F.col("p_size") % 3 == 0, F.concat(size, F.lit(" years 3 months"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("-"), size, F.lit(" days"))).otherwise(F.concat(size, F.lit(" days")))
    why = metric_suspect(F.lit("avg_maturity"), value)
    rows, seen = W.count_errors(table(spark, d, "part").select("p_partkey", why.alias("why")), {"several": F.when(F.col("why") == "several numbers", 1), "sign": F.when(F.col("why") == "sign lost", 1)})
    rows.write.parquet(work_folder(spark))
    return spark.createDataFrame([seen.get], "rows long, several long, sign long")


# ingest

_EVENT_SCHEMA = Ty.StructType([Ty.StructField("file_name", Ty.LongType()), Ty.StructField("ts", Ty.TimestampNTZType()), Ty.StructField("event_type", Ty.StringType()), Ty.StructField("value", Ty.DoubleType())])


def _drop_folder(spark, d, path: str) -> None:
    """Events as delivered documents, a part of them twice."""
    e = table(spark, d, "events").select(F.col("event_id").alias("file_name"), "ts", "event_type", "value")
    e.repartition(4, "file_name").write.parquet(f"{path}/drop")
    e.where("file_name % 20 = 0").coalesce(1).write.mode("append").parquet(f"{path}/drop")


@query("w1_watch_folder", "SELECT event_type, count(*) AS n FROM (SELECT event_type FROM events UNION ALL SELECT event_type FROM events WHERE event_id % 20 = 0) GROUP BY 1")
def w1(spark, d):
    path = work_folder(spark)
    _drop_folder(spark, d, path)
    stream = W.watch_folder(spark, f"{path}/drop", _EVENT_SCHEMA, per_trigger=2)
    W.run_batches(stream, lambda rows, k: rows.write.mode("overwrite").parquet(f"{path}/out/batch={k}"), f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("w2_settled", "SELECT event_id FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 300 SECOND")
def w2(spark, d):
    return W.settled(table(spark, d, "events"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), mtime="ts").select("event_id")


@query("w2c_settle_once", "SELECT event_id AS file_name, event_type FROM events WHERE event_id % 50 <> 0")
def w2c(spark, d):
    """Repeats go and what changed a moment ago waits, in one stream with state and a timer for each document."""
    path = work_folder(spark)
    _drop_folder(spark, d, path)
    soon = F.when(F.col("file_name") % 50 == 0, F.timestamp_millis(F.unix_millis(F.current_timestamp()) + 3_600_000)).otherwise(F.col("ts").cast("timestamp"))
    stream = W.watch_folder(spark, f"{path}/drop", _EVENT_SCHEMA, per_trigger=2).withColumn("mtime", soon)
    run = W.run_batches(W.settle_once(stream, "file_name"), lambda rows, k: rows.write.mode("overwrite").parquet(f"{path}/out/batch={k}"), f"{path}/checkpoint", once=False, every="1 second")
    W.drain(run)
    return spark.read.parquet(f"{path}/out").select("file_name", "event_type")


@query("w2b_held_back", "SELECT event_id AS file_name, CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 300 SECOND THEN 0 ELSE 1 END AS batch FROM events WHERE ts <= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 300 SECOND")
def w2b(spark, d):
    """Two batches: what has not settled at the first waits, and is released with the second if it has by then."""
    path = work_folder(spark)
    clock = ["2024-01-15 00:00:00", "2024-02-01 00:00:00"]
    now = lambda: F.lit(clock[batch[0]]).cast("timestamp_ntz")
    batch = [0]
    hold = W.hold_until_settled(f"{path}/held", lambda rows, k: rows.write.mode("overwrite").parquet(f"{path}/out/batch={k}"), now, mtime="ts")
    e = table(spark, d, "events").select(F.col("event_id").alias("file_name"), "ts", "event_type", "value")
    hold(e, 0)
    batch[0] = 1
    hold(e.limit(0), 1)  # no new files
    return spark.read.parquet(f"{path}/out").select("file_name", F.col("batch").cast("int").alias("batch"))


@query("w3_isolation", "SELECT event_id, concat_ws(',', CASE WHEN value < 5 THEN 'value' END, CASE WHEN event_type = 'error' THEN 'type' END) AS error FROM events WHERE value < 5 OR event_type = 'error' OR value IS NULL")
def w3(spark, d):
    _, failed = W.isolate(table(spark, d, "events"), {"value": F.col("value") >= 5, "type": F.col("event_type") != "error"})
    return failed.select("event_id", "error")


@query("w4_batch_outputs", """
WITH r AS (SELECT value FROM events UNION ALL SELECT value FROM events WHERE event_id % 20 = 0), t AS (SELECT CASE WHEN value >= 5 THEN 'done' ELSE 'failed' END AS status, count(*) AS n FROM r GROUP BY 1)
SELECT status, n, n AS in_ledger, CASE status WHEN 'done' THEN n END AS in_json FROM t""")
def w4(spark, d):
    """JSON, ledger and summary of each batch; the files of finished batches move to the archive."""
    path = work_folder(spark)
    _drop_folder(spark, d, path)
    outputs = W.batch_outputs(f"{path}/out", {"value": F.col("value") >= 5})
    W.run_batches(W.watch_folder(spark, f"{path}/drop", _EVENT_SCHEMA, per_trigger=3, archive=f"{path}/archive"), outputs, f"{path}/checkpoint").awaitTermination()
    summary = spark.read.parquet(f"{path}/out/summary").groupBy("status").agg(F.sum("n").alias("n"))
    ledger = spark.read.parquet(f"{path}/out/ledger").groupBy("status").agg(F.count(F.lit(1)).alias("in_ledger"))
    good = spark.read.schema("file_name long").json(f"{path}/out/good").groupBy().agg(F.count(F.lit(1)).alias("in_json")).withColumn("status", F.lit("done"))
    return summary.join(ledger, "status").join(good, "status", "left").select("status", "n", "in_ledger", "in_json")


@query("w5_repeats", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def w5(spark, d):
    path = work_folder(spark)
    _drop_folder(spark, d, path)
    stream = W.drop_repeats(W.watch_folder(spark, f"{path}/drop", _EVENT_SCHEMA), ["file_name"], delay="400 days")
    W.run_batches(stream, lambda rows, k: rows.write.mode("overwrite").parquet(f"{path}/out/batch={k}"), f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
