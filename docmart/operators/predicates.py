"""Filters and predicates over spans and fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c, strip


def any_of(patterns: Sequence[str]) -> str:
    """One pattern that matches where any of them does."""
    return "(?:" + "|".join(f"(?:{p})" for p in patterns) + ")" if patterns else "(?!)"


def starts_with_any(c, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    return _c(c).rlike(f"{'(?i)' * ignore_case}^{any_of(patterns)}")


def contains_any(c, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    return _c(c).rlike(f"{'(?i)' * ignore_case}{any_of(patterns)}")


def without_punctuation(text) -> Column:
    return F.regexp_replace(_c(text), r"(?U)[^\w\s]", "")


def term_hit(text, terms: Sequence[str]) -> Column:
    """The first listed term found as a whole word in the text without its punctuation, case aside; null if none. A term is no pattern: one with punctuation is in no such text."""
    plain = without_punctuation(text)
    quoted = lambda t: "\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.coalesce(*[F.when(plain.rlike(rf"(?iU)\b{quoted(t)}\b"), F.lit(t)) for t in terms])


def word_runs(text, longest: int) -> Column:
    """All runs of one to ``longest`` words of the text without its punctuation, in lower case, white space between words as it is."""
    parts = F.regexp_extract_all(F.lower(strip(without_punctuation(text))), F.lit(r"(?U)(\w+|\s+)"), F.lit(0))  # word, gap, word, ...
    firsts = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts), F.lit(2))).otherwise(F.array().cast("array<int>"))
    run = lambda i: F.transform(F.sequence(F.lit(1), F.lit(2 * longest - 1), F.lit(2)), lambda n: F.when(i + n - 1 <= F.size(parts), F.array_join(F.slice(parts, i, n), "")))
    return F.array_distinct(F.array_compact(F.flatten(F.transform(firsts, run))))


def term_hits(spans: DataFrame, terms: DataFrame, longest: int, page: Sequence[str] = ("doc_id", "page")) -> DataFrame:
    """Per page and term: ``at``, the first span of which the term is the first listed one, as in :func:`term_hit`; for term lists of any length.

    ``terms(term, priority)``; ``longest`` is the number of words of the longest term that counts. Spans are cut into runs of words, which meet the terms by an equi-join, so the
    cost does not grow with a pattern for each term. ``span_no`` is unique in a page. Terms without a word, or with punctuation, hit nothing;
    white space around a term is ignored; of equal terms the least priority counts, and of equal priorities the first in order of text.
    """
    name = F.lower(strip("term"))
    listed = terms.where(strip("term").rlike(r"(?U)^\w[\w\s]*$")).groupBy(name.alias("_run")).agg(F.min(F.struct("priority", "term")).alias("_term"))
    runs = spans.repartition(*page).select(*page, "span_no", F.explode(word_runs("text", longest)).alias("_run"))
    first = runs.join(listed, "_run").groupBy(*page, "span_no").agg(F.min("_term")["term"].alias("term"))
    return first.groupBy(*page, "term").agg(F.min("span_no").alias("at"))


def page_hits(spans: DataFrame, terms: Sequence[str] | DataFrame, page: Sequence[str] = ("doc_id", "page"), longest: int = 5) -> DataFrame:
    """Per page: distinct hit terms in the order of their first hit, and their number; pages without a hit have none.

    A few terms are a list; many are a table (:func:`term_hits`).
    """
    if isinstance(terms, DataFrame):
        pages = spans.select(*page).distinct()
        hits = pages.join(term_hits(spans, terms, longest, page), list(page), "left")
    else:
        hits = spans.withColumn("term", term_hit("text", terms)).groupBy(*page, "term").agg(F.min("span_no").alias("at"))
    found = F.array_sort(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("at", "term"))))
    return hits.groupBy(*page).agg(found.alias("x")).select(*page, F.transform("x", lambda t: t["term"]).alias("hits"), F.size("x").alias("n_hits"))


def qualified_pages(titles: DataFrame, hits: DataFrame, params: DataFrame, page: Sequence[str] = ("doc_id", "page")) -> DataFrame:
    """Pages with a title and at least the fund house's number of hits; ``params(amc_key, hit_threshold)`` is a small rule table."""
    joined = titles.join(hits, list(page)).join(params, "amc_key")
    return joined.where((F.col("title") != "") & (F.col("n_hits") >= F.col("hit_threshold"))).select(*page, "amc_key", "title", "hits", "n_hits")


def clip_regions(spans: DataFrame, boxes: DataFrame) -> DataFrame:
    """Spans whose origin lies in a half-open box, one row for each box.

    ``boxes(amc_key, region_no, page, x0, y0, x1, y1)``: a box with a page replaces that page's general box
    of the same region.  Joined on the fund house; the table is a few rows each.
    """
    region = ["amc_key", "region_no"]
    own = boxes.where("page is not null").groupBy(*region).agg(F.collect_set("page").alias("own_pages"))
    b = boxes.withColumnRenamed("page", "box_page").join(own, region, "left").withColumn("own_pages", F.coalesce("own_pages", F.array().cast("array<int>")))
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))
    page = F.col("page").cast("int")
    here = F.when(F.col("box_page").isNull(), ~F.array_contains("own_pages", page)).otherwise(F.col("box_page") == page)
    return spans.join(b, "amc_key").where(inside & here).select(*spans.columns, "region_no")


def split_by_line(spans: DataFrame, line_x: float, side: str = "both", block: Sequence[str] = ("doc_id", "page", "block_no")) -> DataFrame:
    """Blocks left or right of a vertical line, by their first span off the line; ``side_no`` orders left before right."""
    where = F.when(F.col("x") < line_x, F.lit(0)).when(F.col("x") > line_x, F.lit(1))
    allowed = {"left": [0], "right": [1], "both": [0, 1]}[side]
    sides = spans.withColumn("side_no", where).where(F.col("side_no").isin(allowed)).groupBy(*block).agg(F.min_by("side_no", "span_no").alias("side_no"))
    return spans.join(sides, list(block))


def drop_stop_words(spans: DataFrame, words: DataFrame) -> DataFrame:
    """Without spans whose text is a stop word, case aside; ``words(word)``."""
    return spans.join(words.select(F.lower("word").alias("_word")).distinct(), F.lower("text") == F.col("_word"), "left_anti")


def matches(condition: Column) -> Column:
    """A condition that is unknown, as for a house without rules, does not hold."""
    return F.coalesce(condition, F.lit(False))


def _where(fields: DataFrame, patterns, test, keep: bool) -> DataFrame:
    from .rules import by_house

    hit = matches(by_house(patterns, lambda p: test("key", p)))
    return fields.where(hit if keep else ~hit)


def select_keys(fields: DataFrame, patterns) -> DataFrame:
    """Fields whose key matches a pattern at its start, case aside. Patterns are a list, here and below, or lists by house."""
    return _where(fields, patterns, starts_with_any, True)


def delete_keys(fields: DataFrame, patterns) -> DataFrame:
    return _where(fields, patterns, contains_any, False)


def drop_keys(fields: DataFrame, patterns) -> DataFrame:
    return _where(fields, patterns, lambda c, p: contains_any(c, p, ignore_case=False), False)


def keep_keys(fields: DataFrame, patterns) -> DataFrame:
    return _where(fields, patterns, lambda c, p: contains_any(c, p, ignore_case=False), True)


def drop_keys_at_any_level(fields: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Without fields that have a matching name anywhere on their dotted path, and without matching names inside dictionaries."""
    gone = any_of(patterns)
    rows = fields.where(~F.exists(F.split("key", r"\."), lambda p: p.rlike(gone)))
    return rows.withColumn("kv", F.filter("kv", lambda x: ~F.exists(F.split(x["k"], r"\."), lambda p: p.rlike(gone))))


def drop_empty(fields: DataFrame) -> DataFrame:
    """Without empty texts, lists and dictionaries."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return fields.where((F.coalesce(F.length("s"), F.lit(0)) > 0) | (size("arr") > 0) | (size("kv") > 0))


def expand_pages(c, zero_based: bool = False) -> Column:
    """"3,4,6-8" as sorted distinct page numbers; parts that are no numbers are skipped."""
    def part(p):
        ends = F.split(strip(p), "-")
        lo = strip(F.get(ends, F.lit(0))).try_cast("int")
        hi = F.coalesce(strip(F.get(ends, F.lit(1))).try_cast("int"), lo)
        return F.when(lo.isNotNull() & (hi >= lo), F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    pages = F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(_c(c), ","), part))))
    return F.transform(pages, lambda p: p - 1) if zero_based else pages
