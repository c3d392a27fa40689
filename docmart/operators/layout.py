"""Layout: from positioned spans to titled sections of ordered lines.

Everything is partitioned by the document, so one exchange serves a whole chain of these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import _c, normalize_whitespace, strip
from .predicates import any_of


def page_title(text, pattern: str, escape: str | None = None) -> Column:
    """The first match over the whole text (dots match newlines), blanks collapsed; '' if none."""
    text = F.regexp_replace(_c(text), escape, "") if escape else _c(text)
    return normalize_whitespace(F.coalesce(F.get(F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(1)), F.lit(0)), F.lit("")))


def ordered_text(spans: DataFrame, by: Sequence[str], order: Sequence[str], sep: str = " ", name: str = "text") -> DataFrame:
    """The texts of each group as one, in order."""
    got = F.array_sort(F.collect_list(F.struct(*order, F.col("text").alias("_t"))))
    return spans.groupBy(*by).agg(F.array_join(F.transform(got, lambda x: x["_t"]), sep).alias(name))


def dedupe_blocks(blocks: DataFrame, by: Sequence[str], same: Sequence[str]) -> DataFrame:
    """The first of blocks that agree in box and first texts, per region."""
    w = Window.partitionBy(*by, *same).orderBy("block_no")
    return blocks.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedupe_spans(spans: DataFrame, by: Sequence[str], same: Sequence[str], order: str = "span_no") -> DataFrame:
    w = Window.partitionBy(*by, *same).orderBy(order)
    return spans.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def reading_order(spans: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "ord") -> DataFrame:
    return spans.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def region_starts(spans: DataFrame, by: Sequence[str], order: str = "ord") -> DataFrame:
    """Flag the first row of each region and name its boundary section ``region_<k>``."""
    before = F.lag("region_no").over(Window.partitionBy(*by).orderBy(order))
    return spans.withColumn("region_start", F.coalesce(before != F.col("region_no"), F.lit(True))).withColumn("region_header", F.concat(F.lit("region_"), F.col("region_no")))


def group_funds(pages: DataFrame, doc: str = "doc_id", fund: str = "fund") -> DataFrame:
    """The sorted pages of each fund of a document."""
    return pages.groupBy(doc, fund).agg(F.array_sort(F.collect_set("page")).alias("pages"))


def promote_headers(spans: DataFrame, lo: float, hi: float, colors: Sequence[int], fonts: Sequence[str], update_size: float) -> DataFrame:
    """Spans of a size in [lo, hi), a listed colour and a listed font get the header size."""
    header = (F.col("size") >= lo) & (F.col("size") < hi) & F.col("color").isin(*colors) & F.col("font").isin(*fonts)
    return spans.withColumn("size", F.when(header, F.lit(float(update_size))).otherwise(F.col("size")))


def merge_header_lines(spans: DataFrame, header_size: float, region: Sequence[str], order: str = "ord") -> DataFrame:
    """Header spans on one line become one text with the other attributes of the first of them; other lines keep their spans; lines are ordered by first appearance."""
    line = [*region, "line_y", "size"]
    spans = spans.withColumn("line_y", F.ceil("y"))
    first = F.min(order).over(Window.partitionBy(*line))
    spans = spans.withColumn("group_ord", first)
    head = F.col("size") == header_size
    item = F.struct(F.col(order).alias("o"), F.col("text").alias("t"))
    others = [c for c in spans.columns if c not in (*line, "group_ord", "text", order)]
    first_of = [F.min_by(c, order).alias(c) for c in others]
    got = spans.groupBy(*line, "group_ord", F.when(head, F.lit(None)).otherwise(F.col(order)).alias("_own")).agg(F.min(order).alias(order), F.array_sort(F.collect_list(item)).alias("_all"), *first_of)
    texts = F.filter(F.transform("_all", lambda x: x["t"]), lambda t: strip(t) != "")
    text = F.when(head, F.array_join(texts, " ")).otherwise(F.col("_all")[0]["t"])
    return got.select(*line, "group_ord", order, text.alias("text"), *others).where(~head | (F.col("text") != ""))


def section_name(c) -> Column:
    """A header as a lower-case name: other than word characters become underscores."""
    return F.lower(F.regexp_replace(strip(F.regexp_replace(_c(c), r"(?U)[^\w\s]", "")), r"(?U)\s+", "_"))


def sections(rows: DataFrame, by: Sequence[str], order: str = "ord", header: str = "is_header", body: str = "is_body", regions: bool = False) -> DataFrame:
    """Body rows with the section they belong to: number, and the name of its header ('before' ahead of the first).

    With ``regions``, rows come from :func:`region_starts`, and a boundary between regions begins a section of the region's
    name, so what follows it is not under the last header of the region before.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    starts, name, kept = F.col(header), F.when(F.col(header), section_name("text")), F.col(header) | F.col(body)
    if regions:
        inner = F.col("region_start") & (F.row_number().over(Window.partitionBy(*by).orderBy(order)) > 1) & ~F.col(header)
        rows = rows.withColumn("_boundary", inner)
        starts, name, kept = starts | F.col("_boundary"), F.coalesce(name, F.when(F.col("_boundary"), F.col("region_header"))), kept | F.col("_boundary")
    rows = rows.withColumn("section_no", F.sum(starts.cast("int")).over(w))
    rows = rows.withColumn("header", F.coalesce(F.last(name, ignorenulls=True).over(w), F.lit("before"))).where(kept)
    return rows.drop("_boundary")


def _is_body(rows: DataFrame) -> Column:
    """A boundary row is kept for its section's name; its text counts only if it is body text."""
    return F.col("is_body") if "is_body" in rows.columns else F.lit(True)


def section_lines(rows: DataFrame, by: Sequence[str], order: str = "ord", header: str = "is_header") -> DataFrame:
    """One row for each section with its lines in order; an empty 'before' has none and does not appear."""
    lines = F.array_sort(F.collect_list(F.when(~F.col(header) & _is_body(rows), F.struct(F.col(order).alias("o"), F.col("text").alias("t")))))
    return rows.groupBy(*by, "section_no", "header").agg(F.transform(lines, lambda x: x["t"]).alias("lines"))


def unique_headers(secs: DataFrame, by: Sequence[str]) -> DataFrame:
    """The n-th section of a name in a document gets the suffix ``_n``, from the second on."""
    n = F.row_number().over(Window.partitionBy(*by, "header").orderBy("section_no"))
    return secs.withColumn("_n", n).withColumn("header", F.when(F.col("_n") > 1, F.concat_ws("_", "header", F.col("_n"))).otherwise(F.col("header"))).drop("_n")


#: Suffixes of repeated canonical heads, in order.
SUFFIXES = ("bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliett", "kilo")


def suffix_canonical(secs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Repeated canonical heads get a spelling-alphabet suffix; beyond the alphabet the last one stays as 'exhausted'."""
    n = F.row_number().over(Window.partitionBy(*by, "header").orderBy("section_no"))
    total = F.count(F.lit(1)).over(Window.partitionBy(*by, "header"))
    rows = secs.withColumn("_n", n).withColumn("_total", total).where((F.col("_n") <= len(SUFFIXES) + 1) | (F.col("_n") == F.col("_total")))
    suffix = F.coalesce(F.get(F.array(*[F.lit(s) for s in SUFFIXES]), F.col("_n") - 2), F.lit("exhausted"))
    return rows.withColumn("header", F.when(F.col("_n") > 1, F.concat_ws("_", "header", suffix)).otherwise(F.col("header"))).drop("_n", "_total")


def snap_lines(spans: DataFrame, by: Sequence[str], tolerance: float = 3.0, arrival: str = "span_no") -> DataFrame:
    """Snap each span to the nearest earlier baseline within ``tolerance``, else open one; lines by baseline, then x.

    The greedy assignment runs in arrival order inside one aggregate per group: (baselines so far, rows with their baseline).
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(arrival).alias("n"), F.col("x"), F.col("y"), F.col("text"))))
    out_type = "array<struct<b:double,x:double,n:bigint,text:string>>"
    start = F.struct(F.array().cast("array<double>").alias("lines"), F.array().cast(out_type).alias("out"))

    def step(acc, r):
        near = F.array_min(F.transform(acc["lines"], lambda b, k: F.struct(F.abs(b - r["y"]).alias("d"), k.alias("k"), b.alias("b"))))
        snapped = near.isNotNull() & (near["d"] <= tolerance)
        base = F.when(snapped, near["b"]).otherwise(r["y"].cast("double"))
        row = F.struct(base.alias("b"), r["x"].cast("double").alias("x"), r["n"].cast("bigint").alias("n"), r["text"].alias("text"))
        return F.struct(F.when(snapped, acc["lines"]).otherwise(F.array_append(acc["lines"], base)).alias("lines"), F.array_append(acc["out"], row).alias("out"))

    snapped = F.aggregate(rows, start, step, lambda acc: F.array_sort(acc["out"]))
    return spans.groupBy(*by).agg(snapped.alias("lines")).select(*by, F.posexplode("lines").alias("line_ord", "l")).select(*by, "line_ord", F.col("l.b").alias("baseline"), F.col("l.x").alias("x"), F.col("l.n").alias(arrival), F.col("l.text").alias("text"))


def snap_by_gap(spans: DataFrame, by: Sequence[str], tolerance: float = 3.0) -> DataFrame:
    """Baselines by gaps: spans in order of y begin a new line where y grows by more than the tolerance."""
    w = Window.partitionBy(*by).orderBy("y", "x", "span_no")
    new = F.coalesce(F.col("y") - F.lag("y").over(w) > tolerance, F.lit(True)).cast("int")
    rows = spans.withColumn("_new", new)
    return rows.withColumn("line_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def original_order(secs: DataFrame, patterns: Sequence[str], original: str = "lines_orig", snapped: str = "lines_snapped") -> DataFrame:
    """Sections whose header matches keep their lines in the original order."""
    return secs.withColumn("lines", F.when(F.col("header").rlike(f"(?i)^{any_of(patterns)}"), F.col(original)).otherwise(F.col(snapped)))


def canonical_fund(c, schemes: Sequence[tuple[str, str]], escape: str | None = None) -> Column:
    """The first scheme (name, pattern) found in the cleaned name, case aside, else the cleaned name."""
    clean = normalize_whitespace(F.regexp_replace(_c(c), escape, "") if escape else _c(c))
    return F.coalesce(*[F.when(clean.rlike(f"(?i){p}"), F.lit(name)) for name, p in schemes], clean)
