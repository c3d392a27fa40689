"""Operator 9: boilerplate lines by their frequency relative to the site.

Per host, the number of pages that contain a line is divided by the host's
number of pages; lines above a ratio are boilerplate and go from every page of
that host.  Lines are counted by a 128-bit name, with partial sums before the shuffle,
and only lines that are common enough meet the host totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO, MIN_PAGES = 0.05, 5


def _name(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(11), line).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, host: Column, ratio: float, min_pages: int) -> DataFrame:
    """(host, name) of lines on at least ``min_pages`` pages of a host and on more than ``ratio`` of them."""
    pages = docs.select(host.alias("host"), F.explode(F.array_distinct(F.filter(_lines("text"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))).alias("line"))
    counts = pages.groupBy("host", _name(F.col("line")).alias("name")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    totals = docs.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages")).select("host", "name")


def line_dedup(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", counts: bool = True) -> DataFrame:
    """Drop lines that more than ``ratio`` of a host's pages contain, and at least ``min_pages`` of them.

    Returns the input's columns, the text without those lines, and ``line_total``
    and ``line_dropped``, the numbers of lines before and of those that went.
    Lines end at a newline and are compared whole, however long; blank ones, of white space alone, always stay.

    A null text stays null with 0 lines but counts as a page; a null host is a
    host of its own.  Ids may be null or repeat: a page is a row.  Input
    columns that are named line_total or line_dropped are replaced; without ``counts`` they pass through,
    as all others do. Repeated rows give repeated rows, an empty table an empty one.
    """
    row = [c for c in docs.columns if not counts or c not in ("line_total", "line_dropped")]
    host = F.coalesce(F.concat(F.lit("h"), F.col("row")[host_col].cast("string")), F.lit(""))
    packed = docs.select(F.struct("*").alias("row")).select("row", F.col("row")[id_col].alias("id"), host.alias("host"), F.col("row")[text_col].alias("text"))
    common = boilerplate(packed, F.col("host"), ratio, min_pages)
    pages = packed.select("host", "id", F.explode(F.array_distinct(_lines("text"))).alias("line")).select("host", "id", _name(F.col("line")).alias("name"))
    found = pages.join(common, ["host", "name"]).groupBy("host", "id").agg(F.collect_set("name").alias("bad"))
    found = found.select(F.col("host").alias("f_host"), F.col("id").alias("f_id"), "bad")
    both = packed.join(found, F.col("host").eqNullSafe(F.col("f_host")) & F.col("id").eqNullSafe(F.col("f_id")), "left")
    kept = F.when(F.col("bad").isNull(), _lines("text")).otherwise(F.filter(_lines("text"), lambda x: ~F.array_contains("bad", _name(x))))
    both = both.select("row", "text", kept.alias("kept"))
    total = F.coalesce(F.size(_lines("text")), F.lit(0)).cast("long")
    total = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(total)
    dropped = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise((F.size(_lines("text")) - F.size("kept")).cast("long"))
    text = F.when(F.col("text").isNotNull(), F.array_join("kept", "\n"))
    kept_row = [(text if c == text_col else F.col("row")[c]).alias(c) for c in row]
    return both.select(*kept_row, *([total.alias("line_total"), dropped.alias("line_dropped")] if counts else []))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return out.select("doc_id", "line_total", "line_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, source FROM documents),
l AS (SELECT rid, doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d WHERE text IS NOT NULL),
c AS (SELECT source, line, count(DISTINCT rid) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
t AS (SELECT source, count(*) AS pages FROM d GROUP BY ALL),
b AS (SELECT c.source, line FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= {MIN_PAGES} AND n > {RATIO} * pages),
k AS (SELECT l.rid, l.i, l.line, b.line IS NOT NULL AS bad FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line),
a AS (SELECT rid, count(*) AS n, count(*) FILTER (bad) AS dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '') AS kept FROM k GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS line_total, coalesce(dropped, 0) AS line_dropped, CASE WHEN text IS NOT NULL THEN sha256(kept) END AS kept_sha256
FROM d LEFT JOIN a USING (rid)
"""
