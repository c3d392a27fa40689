"""Queries of page filters (F1-F5, F12), layout (L) and text scans over spans (S5, S13, S14, T13)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import layout as L
from ..operators import predicates as P
from ..sources import documents as S
from ..operators import rules as R
from .chain import Sheet, factsheets
from .harness import SPANS, TURNS, query, table, view

_HIT = " ".join(f"WHEN regexp_matches(regexp_replace(text, '[^a-zA-Z0-9_\\s]', '', 'g'), '(?i)\\b{t}\\b') THEN '{t}'" for t in ("goldenrod", "lavender", "steel", "red"))
WORDS = ("goldenrod", "lavender", "steel", "red")


def _words_of(spans):
    """Spans whose text has a few of the listed terms; colours stand in where names have none."""
    colour = F.element_at(F.array(*[F.lit(w) for w in (*WORDS, "plain", "blue")]), (F.col("span_no") % 6 + 1).cast("int"))
    return spans.withColumn("text", F.concat_ws(" ", "text", colour))


_TERM_SPANS = f"SELECT doc_id, page, block_no, span_no, x, y, text || ' ' || (['goldenrod', 'lavender', 'steel', 'red', 'plain', 'blue'])[span_no % 6 + 1] AS text FROM ({SPANS})"
_PAGE_HITS = f"""
SELECT doc_id, page, coalesce(list(term ORDER BY first_at, term) FILTER (term IS NOT NULL), []) AS hits, count(*) FILTER (term IS NOT NULL) AS n_hits
FROM (SELECT doc_id, page, CASE {_HIT} END AS term, min(span_no) AS first_at FROM ({_TERM_SPANS}) GROUP BY ALL) GROUP BY ALL"""


def page_hits(spark, d):
    return P.page_hits(_words_of(view(spark, d, SPANS)), WORDS)


@query("f1_term_hits", f"SELECT doc_id, page, array_to_string(hits, ',') AS hits, n_hits FROM ({_PAGE_HITS})")
def f1(spark, d):
    return page_hits(spark, d).select("doc_id", "page", F.array_join("hits", ",").alias("hits"), "n_hits")


#: One term for each name of a part and for some of its words, terms with punctuation, and one that is listed twice.
_TERM_ROWS = """
SELECT upper(p_name) AS term, min(p_partkey) AS priority FROM part GROUP BY p_name UNION ALL SELECT split_part(p_name, ' ', 2), 100000 + min(p_partkey) FROM part GROUP BY 1
UNION ALL SELECT 'r.o.e ' || s_suppkey, -1 FROM supplier UNION ALL SELECT 'c++ (' || p_name, -2 FROM part UNION ALL SELECT 'goldenrod', -3 UNION ALL SELECT 'goldenrod', 5 UNION ALL SELECT 'blue ' || l_linenumber, l_linenumber FROM lineitem"""


@query("f1b_term_index", f"""
WITH s AS (SELECT doc_id, page, span_no, text FROM ({_TERM_SPANS}) x), t AS (SELECT lower(term) AS run, min({{'priority': priority, 'term': term}}) AS t FROM ({_TERM_ROWS}) y WHERE regexp_matches(term, '^[a-zA-Z0-9 ]+$') GROUP BY 1),
w AS (SELECT DISTINCT text, string_split(lower(text), ' ') AS w FROM s),
g AS (SELECT text, unnest(w) AS run FROM w UNION SELECT text, w[i] || ' ' || w[i + 1] FROM (SELECT text, w, unnest(range(1, len(w))) AS i FROM w)),
h AS (SELECT text, min(t).term AS term FROM g JOIN t USING (run) GROUP BY text),
p AS (SELECT doc_id, page, term, min(span_no) AS first_at FROM s LEFT JOIN h USING (text) GROUP BY ALL)
SELECT doc_id, page, coalesce(string_agg(term, ',' ORDER BY first_at, term) FILTER (term IS NOT NULL), '') AS hits, count(term) AS n_hits FROM p GROUP BY ALL""")
def f1b(spark, d):
    """A term table instead of a list: names as terms, many of them, punctuation in some."""
    spans = _words_of(view(spark, d, SPANS))
    table(spark, d, "supplier").createOrReplaceTempView("supplier")
    terms = spark.sql(_TERM_ROWS)
    return P.page_hits(spans, terms, longest=2).select("doc_id", "page", F.array_join("hits", ",").alias("hits"), "n_hits")


def _titles(spark, d):
    pages = view(spark, d, SPANS).select("doc_id", "page").distinct()
    return pages.select("doc_id", "page", F.when(F.col("page") == 3, "").otherwise(F.concat(F.lit("Fund "), (F.col("doc_id") % 5).cast("string"))).alias("title"), F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("amc_key"))


@query("f2_qualified_pages", f"SELECT doc_id, page, n_hits, 'Fund ' || (doc_id % 5) AS title FROM ({_PAGE_HITS}) WHERE page <> 3 AND n_hits >= CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END")
def f2(spark, d):
    params = spark.createDataFrame([("even", 1), ("odd", 2)], "amc_key string, hit_threshold int")
    return P.qualified_pages(_titles(spark, d), page_hits(spark, d), params).select("doc_id", "page", "n_hits", "title")


_INSIDE = "x >= {0} AND x < {1} AND y >= {2} AND y < {3}"


@query(
    "f3_clip_regions",
    f"""WITH s AS ({SPANS})
SELECT doc_id, page, span_no, 1 AS region_no FROM s WHERE page <> 2 AND {_INSIDE.format(0, 25, 0, 60)}
UNION ALL SELECT doc_id, page, span_no, 2 FROM s WHERE {_INSIDE.format(20, 60, 0, 200)}
UNION ALL SELECT doc_id, page, span_no, 1 FROM s WHERE page = 2 AND {_INSIDE.format(0, 10, 0, 200)}""",
)
def f3(spark, d):
    boxes = spark.createDataFrame([("h", 1, None, 0.0, 0.0, 25.0, 60.0), ("h", 2, None, 20.0, 0.0, 60.0, 200.0), ("h", 1, 2, 0.0, 0.0, 10.0, 200.0)], "amc_key string, region_no int, page int, x0 double, y0 double, x1 double, y1 double")
    spans = view(spark, d, SPANS).withColumn("amc_key", F.lit("h"))
    return P.clip_regions(spans, boxes).select("doc_id", "page", "span_no", "region_no")


@query("f4_line_split", f"""
WITH s AS ({SPANS}), b AS (SELECT doc_id, page, block_no, arg_min(CASE WHEN x < 25 THEN 0 ELSE 1 END, span_no) AS side_no FROM s WHERE x <> 25 GROUP BY ALL)
SELECT s.doc_id, s.span_no, side_no FROM s JOIN b USING (doc_id, page, block_no)""")
def f4(spark, d):
    return P.split_by_line(view(spark, d, SPANS), 25).select("doc_id", "span_no", "side_no")


@query("f5_stop_words", f"SELECT doc_id, span_no FROM ({SPANS}) WHERE lower(text) NOT IN (SELECT lower(p_name) FROM part WHERE p_partkey <= 2)")
def f5(spark, d):
    words = table(spark, d, "part").where("p_partkey <= 2").select(F.upper("p_name").alias("word"))
    return P.drop_stop_words(view(spark, d, SPANS), words).select("doc_id", "span_no")


@query("f12_page_ranges", "SELECT n_nationkey, unnest(list_sort(list_distinct([n_nationkey, 3] || range(6, 9 + n_regionkey)))) - 1 AS page FROM nation")
def f12(spark, d):
    n = table(spark, d, "nation")
    text = F.concat(F.col("n_nationkey").cast("string"), F.lit(", 3,x,6-"), (8 + F.col("n_regionkey")).cast("string"))
    return n.select("n_nationkey", F.explode(P.expand_pages(text, zero_based=True)).alias("page")).withColumn("page", F.col("page").cast("long"))


@query("l1_titles", r"SELECT page_id, trim(regexp_replace(coalesce(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), ''), '\s+', ' ', 'g')) AS title FROM pages")
def l1(spark, d):
    return table(spark, d, "pages").select("page_id", L.page_title("html", "<title>(.*?)</title>").alias("title"))


@query("l2_block_dedupe", f"SELECT doc_id, page, x, y, t, min(block_no) AS block_no FROM (SELECT doc_id, page, block_no, min(x) AS x, min(y) AS y, min_by(text, span_no) AS t FROM ({SPANS}) GROUP BY ALL) GROUP BY ALL")
def l2(spark, d):
    """Blocks with their box and the first text of their lines, each delivered twice, the second time as a later block."""
    blocks = view(spark, d, SPANS).groupBy("doc_id", "page", "block_no").agg(F.min("x").alias("x"), F.min("y").alias("y"), F.min_by("text", "span_no").alias("t"))
    twice = blocks.withColumn("block_no", F.explode(F.array("block_no", F.col("block_no") + 100)))
    return L.dedupe_blocks(twice, ["doc_id", "page"], ["x", "y", "t"]).select("doc_id", "page", "x", "y", "t", "block_no")


@query("l3_reading_order", f"SELECT doc_id, span_no, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, x, span_no) AS ord FROM ({SPANS})")
def l3(spark, d):
    return L.reading_order(view(spark, d, SPANS), ["doc_id", "page"], ["y", "x", "span_no"]).select("doc_id", "span_no", "ord")


@query("l4_region_starts", f"""
SELECT doc_id, span_no, coalesce(lag(page) OVER w <> page, true) AS region_start, 'region_' || page AS region_header FROM ({SPANS}) WINDOW w AS (PARTITION BY doc_id ORDER BY page, y, x, span_no)""")
def l4(spark, d):
    rows = L.reading_order(view(spark, d, SPANS).withColumn("region_no", F.col("page")), ["doc_id"], ["page", "y", "x", "span_no"])
    return L.region_starts(rows, ["doc_id"]).select("doc_id", "span_no", "region_start", "region_header")


@query("l4b_region_sections", f"""
WITH o AS (SELECT *, row_number() OVER w AS ord, coalesce(lag(page) OVER w <> page, false) AS start, size >= 40 AS head FROM ({SPANS}) WINDOW w AS (PARTITION BY doc_id ORDER BY page, y, x, span_no)),
n AS (SELECT *, sum(CAST(head AS INT) + CAST(start AND NOT head AS INT)) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS sec FROM o)
SELECT doc_id, sec AS section_no, coalesce(max(CASE WHEN head THEN lower(replace(text, ' ', '_')) WHEN start THEN 'region_' || page END), 'before') AS header, string_agg(text, '|' ORDER BY ord) FILTER (size <= 25 AND NOT head) AS lines
FROM n WHERE head OR start OR size <= 25 GROUP BY doc_id, sec""")
def l4b(spark, d):
    """Sections that begin at headers and at region boundaries; what follows a boundary is under the region's own name."""
    rows = L.reading_order(view(spark, d, SPANS).withColumn("region_no", F.col("page")), ["doc_id"], ["page", "y", "x", "span_no"])
    rows = L.region_starts(rows, ["doc_id"]).withColumns({"is_header": F.col("size") >= 40, "is_body": F.col("size") <= 25})
    secs = L.section_lines(L.sections(rows, ["doc_id"], regions=True), ["doc_id"])
    return secs.select("doc_id", "section_no", "header", F.when(F.size("lines") > 0, F.array_join("lines", "|")).alias("lines"))


@query("l5_fund_pages", f"SELECT doc_id, CASE WHEN page = 3 THEN 'b' ELSE 'a' END AS fund, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages FROM ({SPANS}) GROUP BY ALL")
def l5(spark, d):
    pages = view(spark, d, SPANS).select("doc_id", "page", F.when(F.col("page") == 3, "b").otherwise("a").alias("fund"))
    return L.group_funds(pages).select("doc_id", "fund", F.array_join("pages", ",").alias("pages"))


@query("l6_header_size", f"SELECT doc_id, span_no, CASE WHEN size >= 10 AND size < 30 AND color IN (1, 2) AND font IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14', 'Brand#15', 'Brand#16', 'Brand#17', 'Brand#18', 'Brand#19') THEN 99.0 ELSE size END AS size FROM ({SPANS})")
def l6(spark, d):
    return L.promote_headers(view(spark, d, SPANS), 10, 30, [1, 2], [f"Brand#1{k}" for k in range(1, 10)], 99).select("doc_id", "span_no", "size")


@query("l7_header_lines", f"""
WITH s AS (SELECT *, CASE WHEN size >= 25 THEN 50.0 ELSE size END AS sz, ceil(y / 40) AS yy FROM ({SPANS}))
SELECT doc_id, page, sz AS size, min(span_no) AS ord, string_agg(text, ' ' ORDER BY span_no) AS text FROM s WHERE sz = 50 GROUP BY doc_id, page, yy, sz
UNION ALL SELECT doc_id, page, sz, span_no, text FROM s WHERE sz <> 50""")
def l7(spark, d):
    spans = view(spark, d, SPANS).withColumn("size", F.when(F.col("size") >= 25, 50.0).otherwise(F.col("size"))).withColumn("y", F.col("y") / 40)
    return L.merge_header_lines(spans, 50.0, ["doc_id", "page"], order="span_no").select("doc_id", "page", "size", F.col("span_no").alias("ord"), "text")


@query("l7b_header_attributes", f"""
WITH s AS (SELECT *, CASE WHEN size >= 25 THEN 50.0 ELSE size END AS sz, ceil(y / 40) AS yy FROM ({SPANS}))
SELECT doc_id, page, min(span_no) AS ord, arg_min(x, span_no) AS x, arg_min(color, span_no) AS color, arg_min(font, span_no) AS font FROM s WHERE sz = 50 GROUP BY doc_id, page, yy, sz
UNION ALL SELECT doc_id, page, span_no, x, color, font FROM s WHERE sz <> 50""")
def l7b(spark, d):
    """Merged headers keep place, colour and font of their first span."""
    spans = view(spark, d, SPANS).withColumn("size", F.when(F.col("size") >= 25, 50.0).otherwise(F.col("size"))).withColumn("y", F.col("y") / 40)
    return L.merge_header_lines(spans, 50.0, ["doc_id", "page"], order="span_no").select("doc_id", "page", F.col("span_no").alias("ord"), "x", "color", "font")


_NAME = r"lower(regexp_replace(trim(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g')), '\s+', '_', 'g'))"
_SECTIONS = f"""
SELECT doc_id, sec AS section_no, coalesce(max(CASE WHEN is_header THEN {_NAME} END), 'before') AS header, coalesce(list(text ORDER BY ord) FILTER (NOT is_header), []) AS lines
FROM (SELECT *, sum(CAST(is_header AS INT)) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS sec FROM ({TURNS})) GROUP BY doc_id, sec"""


def sections(spark, d):
    rows = L.sections(view(spark, d, TURNS), ["doc_id"])
    return L.section_lines(rows, ["doc_id"])


@query("l8_sections", f"SELECT doc_id, section_no, header, array_to_string(lines, '|') AS lines FROM ({_SECTIONS})")
def l8(spark, d):
    return sections(spark, d).select("doc_id", "section_no", "header", F.array_join("lines", "|").alias("lines"))


@query("l14_section_text", f"SELECT doc_id, header, len(lines) AS n_lines, len(array_to_string(lines, '')) AS n_chars FROM ({_SECTIONS})")
def l14(spark, d):
    return sections(spark, d).select("doc_id", "header", F.size("lines").alias("n_lines"), F.length(F.array_join("lines", "")).alias("n_chars"))


@query("l9_unique_headers", f"""
SELECT doc_id, section_no, h || CASE WHEN rn > 1 THEN '_' || rn ELSE '' END AS header
FROM (SELECT doc_id, section_no, CASE WHEN header = 'before' THEN header ELSE 'same' END AS h, row_number() OVER (PARTITION BY doc_id, header = 'before' ORDER BY section_no) AS rn FROM ({_SECTIONS}))""")
def l9(spark, d):
    same = sections(spark, d).withColumn("header", F.when(F.col("header") == "before", F.col("header")).otherwise("same"))
    return L.unique_headers(same, ["doc_id"]).select("doc_id", "section_no", "header")


@query("l10_canonical_suffix", f"""
SELECT doc_id, section_no, CASE WHEN rn = 1 THEN 'head' WHEN rn <= 11 THEN 'head_' || (['bravo', 'charlie', 'delta', 'echo', 'foxtrot', 'golf', 'hotel', 'india', 'juliett', 'kilo'])[rn - 1] ELSE 'head_exhausted' END AS header
FROM (SELECT doc_id, section_no, row_number() OVER (PARTITION BY doc_id ORDER BY section_no) AS rn, count(*) OVER (PARTITION BY doc_id) AS n
      FROM (SELECT doc_id, ord * 10 + i AS section_no FROM ({TURNS}), range(0, 7) t(i))) WHERE rn <= 11 OR rn = n""")
def l10(spark, d):
    """Seven sections a turn, so that long conversations run past the alphabet."""
    turns = view(spark, d, TURNS).select("doc_id", F.col("ord").cast("long").alias("ord"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i"))
    secs = turns.select("doc_id", (F.col("ord") * 10 + F.col("i")).alias("section_no"), F.lit("head").alias("header"))
    return L.suffix_canonical(secs, ["doc_id"]).select("doc_id", "section_no", "header")


_SNAPPED = f"""
WITH RECURSIVE s AS MATERIALIZED (SELECT doc_id, page, span_no, x, y, text, row_number() OVER (PARTITION BY doc_id, page ORDER BY span_no) AS i FROM ({SPANS})),
g AS (SELECT *, y AS baseline, [y] AS bases FROM s WHERE i = 1 UNION ALL
  SELECT doc_id, page, span_no, x, y, text, i, CASE WHEN near.d <= 3 THEN near.b ELSE y END, CASE WHEN near.d <= 3 THEN bases ELSE list_append(bases, y) END
  FROM (SELECT s.*, g.bases, list_sort([{{'d': abs(g.bases[k] - s.y), 'k': k, 'b': g.bases[k]}} for k in range(1, len(g.bases) + 1)])[1] AS near FROM g JOIN s ON s.doc_id = g.doc_id AND s.page = g.page AND s.i = g.i + 1))"""


@query("l11_snap_lines", f"{_SNAPPED} SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY baseline, x, span_no) - 1 AS line_ord, baseline, x, span_no, text FROM g")
def l11(spark, d):
    """Greedy baselines in arrival order: SQL goes span by span."""
    return L.snap_lines(view(spark, d, SPANS), ["doc_id", "page"])


@query("l11b_gap_lines", f"""
SELECT doc_id, span_no, sum(new) OVER (PARTITION BY doc_id, page ORDER BY y, x, span_no ROWS UNBOUNDED PRECEDING) AS line_no
FROM (SELECT *, CASE WHEN coalesce(y - lag(y) OVER (PARTITION BY doc_id, page ORDER BY y, x, span_no) > 3, true) THEN 1 ELSE 0 END AS new FROM ({SPANS}))""")
def l11b(spark, d):
    return L.snap_by_gap(view(spark, d, SPANS), ["doc_id", "page"]).select("doc_id", "span_no", "line_no")


@query("l12_original_order", f"""{_SNAPPED}, t AS (SELECT doc_id, page, min_by(text, span_no) AS header, string_agg(text, '|' ORDER BY span_no) AS orig, string_agg(text, '|' ORDER BY baseline, x, span_no) AS snapped FROM g GROUP BY ALL)
SELECT doc_id, page, CASE WHEN regexp_matches(header, '(?i)^(red|blue|small)') THEN orig ELSE snapped END AS lines FROM t""")
def l12(spark, d):
    """Pages as sections that go by their first text; their lines as they arrived and as they are snapped to baselines."""
    texts = lambda *order: F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col("text").alias("_t")))), lambda r: r["_t"])
    lines = L.snap_lines(view(spark, d, SPANS), ["doc_id", "page"])
    secs = lines.groupBy("doc_id", "page").agg(F.min_by("text", "span_no").alias("header"), texts("span_no").alias("lines_orig"), texts("line_ord").alias("lines_snapped"))
    return L.original_order(secs, ["red", "blue", "small"]).select("doc_id", "page", F.array_join("lines", "|").alias("lines"))


@query("l13_canonical_fund", "SELECT p_partkey, CASE WHEN p_name LIKE '%1%' THEN 'One' WHEN p_name LIKE '%2%' THEN 'Two' ELSE trim(p_name) END AS fund FROM part")
def l13(spark, d):
    raw = F.concat(F.lit("* "), F.col("p_name"), F.lit("  "))
    return table(spark, d, "part").select("p_partkey", L.canonical_fund(raw, [("One", "1"), ("Two", "2")], escape=r"\*").alias("fund"))


@query("s5_span_rows", f"SELECT doc_id, page, round_even(size / 2, 0) AS size, text, x, y FROM ({SPANS}) GROUP BY ALL")
def s5(spark, d):
    """Nested blocks, made from the span view, read back as span rows."""
    span = F.struct((F.col("size") / 2).alias("size"), F.concat("text", F.lit("  ")).alias("text"), F.col("color").cast("int").alias("color"), "x", "y", "font")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("span_no", span.alias("s")))), lambda r: r["s"])
    pages = view(spark, d, SPANS).groupBy("doc_id", "page").agg(ordered.alias("spans"))
    text = F.struct(F.lit(0).alias("type"), F.array(F.struct("spans")).alias("lines"))
    image = F.struct(F.lit(1).alias("type"), F.array(F.struct("spans")).alias("lines"))
    pages = pages.select("doc_id", "page", F.array(text, image, text).alias("blocks"))
    return S.span_rows(pages).select("doc_id", "page", "size", "text", "x", "y").distinct()


@query("s13_page_lines", "SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents")
def s13(spark, d):
    return S.page_lines(table(spark, d, "documents"), ["doc_id"]).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


@query("s14_page_blocks", f"SELECT doc_id, string_agg(text, ' ' ORDER BY page, y, x, span_no) AS text FROM ({SPANS}) WHERE page IN (1, 2) GROUP BY doc_id")
def s14(spark, d):
    return S.page_blocks(view(spark, d, SPANS), [1, 2])


@query("t13_page_one", f"SELECT doc_id, coalesce(string_agg(text, ' ' ORDER BY y, x, span_no) FILTER (x < 25), '') AS box_text, count(*) AS n_texts FROM ({SPANS}) WHERE page = 1 GROUP BY doc_id")
def t13(spark, d):
    spans = view(spark, d, SPANS)
    box = S.page_blocks(spans.where("x < 25"), [1]).withColumnRenamed("text", "box_text")
    full = S.page_blocks(spans, [1], joined=False)
    return full.join(box, "doc_id", "left").select("doc_id", F.coalesce("box_text", F.lit("")).alias("box_text"), F.size("text").cast("long").alias("n_texts"))


@query("a9_page_report", f"""
SELECT doc_id, page, CASE WHEN page = 3 THEN '' ELSE 'Fund ' || (doc_id % 5) END AS title, n_hits, hits[1] AS idx_1, hits[2] AS idx_2, hits[3] AS idx_3, hits[4] AS idx_4 FROM ({_PAGE_HITS})""")
def a9(spark, d):
    from ..operators.mart import page_report

    return page_report(page_hits(spark, d), _titles(spark, d).drop("amc_key"), WORDS)


#: Spans as a factsheet has them: titles above the page, headers of two kinds, body lines with a brand and an amount.
_SHEET_SPANS = f"""
SELECT doc_id, page - 1 AS page, block_no, span_no, x, cast(span_no * 10 AS double) AS y, size, color, font,
  CASE WHEN size >= 25 THEN CASE WHEN size % 2 = 0 THEN 'Benchmark Index:' ELSE 'Min. Amount' END ELSE concat(font, ' TRI Rs.', cast(cast(size * 100 AS int) AS varchar(9))) END AS text
FROM ({SPANS}) body
UNION ALL SELECT DISTINCT doc_id, page - 1, 0, 0, cast(0 AS double), cast(-5 AS double), cast(9 AS double), 0, 't', CASE page WHEN 2 THEN 'The  Beta Fund, monthly' WHEN 3 THEN 'nothing' ELSE 'Alpha Fund' END FROM ({SPANS}) title"""


def sheet() -> Sheet:
    levels = ([R.Dispatch("benchmark", "first", {"pattern": r"(Brand#\d+)"}), R.Dispatch("min", "first", {"pattern": r"Rs\.(\d+)"})], (), ())
    chain = {"select": ["benchmark", "min"], "map": [("benchmark_index", "benchmark_index$"), ("min_amt", "min_amt$")], "record": ["benchmark_index", "min_amt"]}
    return Sheet(
        title_box=F.col("y") < 0, title_pattern=r"(\w+\s+Fund)", terms=["brand3", "brand 1", "tri"], min_hits=1, header_size=50.0, body_sizes=(1.0, 24.0), schemes=[("Alpha", "alpha"), ("Beta", "beta")],
        headers=(25.0, 51.0, range(4), [f"Brand#{i}" for i in range(1, 60)]), heads=[("benchmark_index", "benchmark"), ("min_amt", "min")], levels=levels, chain=chain,
    )


@query("chain_spans_to_records", f"""
WITH s AS (SELECT * FROM ({_SHEET_SPANS}) z WHERE y >= 0), q AS (SELECT doc_id, page FROM s WHERE size < 25 AND page < 2 GROUP BY ALL),
r AS (SELECT s.*, CASE page WHEN 1 THEN 'Beta' ELSE 'Alpha' END AS fund, row_number() OVER (PARTITION BY doc_id, page ORDER BY block_no, span_no) AS ord FROM s JOIN q USING (doc_id, page)),
c AS (SELECT *, sum(CAST(size >= 25 AS INT)) OVER (PARTITION BY doc_id, fund ORDER BY ord) AS sec FROM r),
n AS (SELECT doc_id, fund, sec, max(CASE WHEN size >= 25 THEN CASE WHEN size % 2 = 0 THEN 'b' ELSE 'm' END END) AS name, coalesce(string_agg(text, ' ' ORDER BY ord) FILTER (size < 25), '') AS lines FROM c GROUP BY ALL),
f AS (SELECT doc_id, fund, name, arg_min(lines, sec) AS lines FROM n WHERE name IS NOT NULL GROUP BY ALL)
SELECT doc_id, fund, max(regexp_extract(lines, 'Brand#[0-9]+')) FILTER (name = 'b') AS benchmark_index, max(regexp_extract(lines, 'Rs\\.([0-9]+)', 1)) FILTER (name = 'm') AS min_amt,
  string_agg(CASE name WHEN 'b' THEN 'benchmark_index' ELSE 'min_amt' END || '@' || CASE fund WHEN 'Alpha' THEN 1 ELSE 2 END, ',' ORDER BY name) AS places,
  count(*) OVER (PARTITION BY doc_id) AS n_funds
FROM f GROUP BY doc_id, fund""")
def chain(spark, d):
    """From spans to records with locations, in one plan that deals spans by document once (tests/test_operators.py counts its exchanges)."""
    r = factsheets(view(spark, d, _SHEET_SPANS), sheet())
    places = F.array_join(F.transform("field_location", lambda x: F.concat_ws("@", x["field"], x["page"])), ",")
    return r.select("doc_id", "fund", "benchmark_index", "min_amt", places.alias("places"), F.count(F.lit(1)).over(Window.partitionBy("doc_id")).alias("n_funds"))
