"""Spans to records in one plan: titles, qualified pages, funds, headers, sections, extraction, records with locations.

Every step is a window, a grouping or an array function within a document, so spans are dealt by document once and never
again; what a record must know of its origin (the fund's first page, the document's number of funds) travels with its fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.extract import KV
from ..operators import layout as L
from ..operators import predicates as P
from ..operators import reshape as K
from ..operators import rules as R

_PAGE, _FUND = ("doc_id", "page"), ("doc_id", "fund")


@dataclass(frozen=True)
class Sheet:
    """How factsheets are read: where titles stand, what makes a page count, what a header is, and the rules of their fields."""

    title_box: Column
    title_pattern: str
    terms: Sequence[str]
    min_hits: int
    header_size: float
    body_sizes: tuple[float, float]
    schemes: Sequence[tuple[str, str]] = ()
    headers: tuple[float, float, Sequence[int], Sequence[str]] | None = None
    stop_words: Sequence[str] = ()
    heads: object = ()
    levels: tuple[Sequence[R.Dispatch], ...] = ((), (), ())
    chain: dict = field(default_factory=dict)


def titled_pages(spans: DataFrame, sheet: Sheet) -> DataFrame:
    """Body spans of the pages that have a title and enough terms, with their ``fund``. Pages are numbered from 0; a page has some hundreds of spans."""
    page = Window.partitionBy(*_PAGE)
    in_title = F.when(sheet.title_box, F.struct("span_no", "text"))
    title = F.array_join(F.transform(F.array_sort(F.collect_list(in_title).over(page)), lambda x: x["text"]), " ")
    hits = F.size(F.collect_set(P.term_hit("text", sheet.terms)).over(page))
    rows = spans.withColumn("_title", L.page_title(title, sheet.title_pattern)).withColumn("_hits", hits)
    rows = rows.where((F.col("_title") != "") & (F.col("_hits") >= sheet.min_hits) & ~sheet.title_box)
    return rows.withColumn("fund", L.canonical_fund("_title", sheet.schemes)).drop("_title", "_hits")


def section_fields(spans: DataFrame, sheet: Sheet) -> DataFrame:
    """The sections of each fund as fields of kind a, in reading order over the fund's pages, with ``first_page`` (from 1) and ``scheme_count``."""
    rows = titled_pages(spans, sheet)
    if sheet.stop_words:
        rows = rows.where(~F.lower("text").isin([w.lower() for w in sheet.stop_words]))
    if sheet.headers:
        rows = L.promote_headers(rows, *sheet.headers, update_size=sheet.header_size)
    number = F.dense_rank().over(Window.partitionBy("doc_id").orderBy("fund"))
    rows = rows.withColumn("_no", number).withColumn("scheme_count", F.max("_no").over(Window.partitionBy("doc_id"))).drop("_no")
    rows = rows.withColumn("first_page", F.min("page").over(Window.partitionBy(*_FUND)) + 1)
    rows = L.reading_order(rows, _FUND, ["page", "block_no", "span_no"])
    origin = [*_FUND, "first_page", "scheme_count"]
    lines = L.merge_header_lines(rows, sheet.header_size, [*origin, "page"])
    lo, hi = sheet.body_sizes
    lines = lines.withColumns({"is_header": F.col("size") == sheet.header_size, "is_body": F.col("size").between(lo, hi)})
    secs = L.unique_headers(L.section_lines(L.sections(lines, origin), origin), origin)
    none = F.lit(None)
    return secs.select(*origin, F.col("section_no").alias("ord"), F.col("header").alias("key"), F.lit("a").alias("kind"), none.cast("string").alias("s"), F.col("lines").alias("arr"), none.cast(KV).alias("kv"))


def factsheets(spans: DataFrame, sheet: Sheet) -> DataFrame:
    """Records of all funds with ``field_location``: (field, page) of every field that a record emits, on its fund's first page.

    ``spans(doc_id, page, block_no, span_no, x, y, size, color, font, text)``; empty tables give empty ones, and a document without a qualified page has no record.
    """
    fields = R.refine(section_fields(spans.repartition("doc_id"), sheet), sheet.heads, *sheet.levels, partitioned=True)
    records = K.merge_and_select(fields, sheet.chain, partitioned=True)
    page = F.col("first_page").cast("string")
    return records.withColumn("field_location", F.transform(K.field_names(sheet.chain["record"]), lambda f: F.struct(f.alias("field"), page.alias("page"))))
