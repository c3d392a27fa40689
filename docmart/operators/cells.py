"""Grid-cell tables in long form: (doc_id, table_no, row_no, col_no, text), places from 0."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import cell_pipeline, normalize_alphanumeric, normalize_key, strip
from .predicates import any_of


def stack_tables(cells: DataFrame, by: Sequence[str] = ("doc_id",), pad: int = 1, horizontal: bool = False) -> DataFrame:
    """All tables of a document below each other (or beside), ``pad`` blank rows (columns) apart."""
    place = "col_no" if horizontal else "row_no"
    one = Window.partitionBy(*by, "table_no")
    size = F.when(F.row_number().over(one.orderBy("row_no", "col_no")) == 1, F.max(place).over(one) + 1 + pad)
    before = Window.partitionBy(*by).orderBy("table_no").rangeBetween(Window.unboundedPreceding, -1)
    rows = cells.repartition(*by).withColumn("_size", size).withColumn("_off", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    return rows.withColumn(place, (F.col(place) + F.col("_off")).cast(cells.schema[place].dataType)).drop("_size", "_off")


def _row_hits(keywords: Sequence[str]):
    return F.count_if(normalize_alphanumeric("text").rlike(f"(?i){any_of(keywords)}"))


def _column_hits(keywords: Sequence[str]):
    return F.sum(F.regexp_count(normalize_alphanumeric("text"), F.lit(f"(?i){any_of(keywords)}")))


def _or_zero(found: DataFrame, by: Sequence[str], place: str, thresh: int) -> DataFrame:
    """Places with enough hits, or place 0 of a document without one."""
    got = found.groupBy(*by).agg(F.collect_list(F.when(F.col("_n") >= thresh, F.col(place))).alias("_all"))
    return got.select(*by, F.explode_outer("_all").alias(place)).withColumn(place, F.coalesce(place, F.lit(0)))


def find_rows(cells: DataFrame, keywords: Sequence[str], thresh: int = 1, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Rows with at least ``thresh`` cells that contain a keyword; a document without one has row 0."""
    return _or_zero(cells.groupBy(*by, "row_no").agg(_row_hits(keywords).alias("_n")), by, "row_no", thresh)


def find_columns(cells: DataFrame, keywords: Sequence[str], thresh: int = 1, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns in which the keywords occur at least ``thresh`` times; a document without one has column 0.

    Occurrences are counted cell by cell and summed, so no column is gathered in one place.
    """
    return _or_zero(cells.groupBy(*by, "col_no").agg(_column_hits(keywords).alias("_n")), by, "col_no", thresh)


def with_first(cells: DataFrame, place: str, hits, thresh: int, by: Sequence[str]) -> DataFrame:
    """Cells with ``_at``, the document's first row (column) with enough hits, or 0; windows over the document, no join."""
    rows = cells.withColumn("_n", hits.over(Window.partitionBy(*by, place)))
    return rows.withColumn("_at", F.coalesce(F.min(F.when(F.col("_n") >= thresh, F.col(place))).over(Window.partitionBy(*by)), F.lit(0))).drop("_n")


def sub_grid(cells: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Cells in rows [a, b) and columns [c, d), with places from 0 again."""
    (a, b), (c, d) = rows, cols
    a, c = max(a, 0), max(c, 0)
    got = cells.where(F.col("row_no").between(a, b - 1) & F.col("col_no").between(c, d - 1))
    return got.withColumn("row_no", F.col("row_no") - a).withColumn("col_no", F.col("col_no") - c)


def drop_blank_lines(cells: DataFrame, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Without rows and columns that have no text at all."""
    texts = lambda place: F.count("text").over(Window.partitionBy(*by, place))
    return cells.withColumn("_r", texts("row_no")).withColumn("_c", texts("col_no")).where("_r > 0 and _c > 0").drop("_r", "_c")


def fill_titles(cells: DataFrame, by: Sequence[str] = ("doc_id",), title_col: int = 0) -> DataFrame:
    """Cells with the ``title`` of their row: the last text of the title column at or above it."""
    down = Window.partitionBy(*by).orderBy("row_no").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("title", F.last(F.when(F.col("col_no") == title_col, F.col("text")), ignorenulls=True).over(down))


def collect_by_title(titled: DataFrame, by: Sequence[str] = ("doc_id",), title_col: int = 0) -> DataFrame:
    """Per title, as a key, the texts of its cells by row and column; blank ones are left out.

    Titles that differ but have one key: the one that starts last keeps it.
    """
    body = titled.where((F.col("col_no") != title_col) & F.col("title").isNotNull() & (F.coalesce(strip("text"), F.lit("")) != ""))
    cells = F.array_sort(F.collect_list(F.struct("row_no", "col_no", "text")))
    own = body.groupBy(*by, normalize_key("title").alias("key"), "title").agg(F.min("row_no").alias("_at"), cells.alias("_cells"))
    last = own.groupBy(*by, "key").agg(F.max(F.struct("_at", "_cells")).alias("x"))
    return last.select(*by, F.col("key").alias("title"), F.transform("x._cells", lambda x: x["text"]).alias("texts"))


def clean_cells(cells: DataFrame, steps: Sequence[str] = ("newline_to_space", "collapse", "strip", "blank_to_null")) -> DataFrame:
    return cells.withColumn("text", cell_pipeline("text", steps))


def scheme_table(cells: DataFrame, keywords: Sequence[str], width: int, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Stack, find the keyword column, slice from it, clean, fill titles down, collect by title."""
    stacked = with_first(stack_tables(cells, by, pad=0), "col_no", _column_hits(keywords), 1, by)
    part = stacked.where(F.col("col_no").between(F.col("_at"), F.col("_at") + width - 1)).withColumn("col_no", F.col("col_no") - F.col("_at")).drop("_at")
    return collect_by_title(fill_titles(clean_cells(part), by), by)


def manager_table(cells: DataFrame, keywords: Sequence[str], order: dict[int, str], by: Sequence[str] = ("doc_id",), thresh: int = 1) -> DataFrame:
    """Stack, cut below the keyword row, clean, drop blank lines, name columns by ``order``."""
    stacked = with_first(stack_tables(cells, by, pad=0), "row_no", _row_hits(keywords), thresh, by)
    part = drop_blank_lines(clean_cells(stacked.where(F.col("row_no") > F.col("_at")).drop("_at")), by)
    return part.groupBy(*by, "row_no").agg(*[F.max(F.when(F.col("col_no") == k, F.col("text"))).alias(v) for k, v in order.items()])


def allocation_rows(cells: DataFrame, keywords: Sequence[str], n: int, by: Sequence[str] = ("doc_id",), keep: str = "%", names: DataFrame | None = None) -> DataFrame:
    """The rows [m + 1, m + 3 + n) below the first keyword row m, each as one cleaned text.

    ``names(*by, clip_text)`` gives the text of the clip that names the scheme, which stands beside the rows as ``scheme``.
    """
    from ..functions.text import normalize_alphanumeric_keep

    rows = with_first(cells.repartition(*by), "row_no", _row_hits(keywords), 1, by)
    part = rows.where((F.col("row_no") > F.col("_at")) & (F.col("row_no") < F.col("_at") + 3 + n))
    texts = F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("text", F.lit("")).alias("t"))))
    got = part.groupBy(*by, "row_no").agg(normalize_alphanumeric_keep(F.array_join(F.transform(texts, lambda x: x["t"]), " "), keep).alias("text"))
    if names is None:
        return got
    return got.join(names.select(*by, normalize_alphanumeric_keep("clip_text", keep).alias("scheme")), list(by), "left")


def scheme_side_table(cells: DataFrame, name_col: int, value_cols: Sequence[int], name_pattern: str, by: Sequence[str] = ("doc_id",), sep: str | None = None) -> DataFrame:
    """Scheme names found in a column carry down; the row texts below belong to them, as a list or joined by ``sep``."""
    texts = F.array_sort(F.collect_list(F.when(F.col("col_no").isin(*value_cols), F.struct("col_no", F.coalesce("text", F.lit("")).alias("t")))))
    name = F.max(F.when(F.col("col_no") == name_col, F.regexp_extract("text", name_pattern, 0)))
    rows = cells.groupBy(*by, "row_no").agg(F.array_join(F.transform(texts, lambda x: x["t"]), " ").alias("row_text"), F.nullif(name, F.lit("")).alias("own"))
    rows = rows.withColumn("scheme", F.last("own", ignorenulls=True).over(Window.partitionBy(*by).orderBy("row_no")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_no", F.col("row_text").alias("t")))), lambda x: x["t"])
    got = rows.where("scheme is not null").groupBy(*by, "scheme").agg(lines.alias("texts"))
    return got if sep is None else got.withColumn("text", F.array_join("texts", sep)).drop("texts")


def with_roles(cells: DataFrame, roles: dict[str, tuple[Sequence[str], int]], by: Sequence[str] = ("doc_id",), open_end: str | None = None) -> DataFrame:
    """Cells with a truth value ``_is_<role>`` for each role: whether in their column of the document the role's keywords occur at least as often as it asks.

    ``roles`` are (keywords, threshold), keywords patterns in the cleaned text. The role ``open_end`` has its first column and all behind it.
    A column may have several roles; a document without a role's column lacks that role. Windows over the document, no join.
    """
    column, hit = Window.partitionBy(*by, "col_no"), lambda role: F.col(f"_is_{role}")
    found = {f"_is_{role}": F.regexp_count("_plain", F.lit(f"(?i){any_of(words)}")) for role, (words, _) in roles.items()}
    rows = cells.withColumn("_plain", normalize_alphanumeric("text")).withColumns(found).drop("_plain")
    rows = rows.withColumns({f"_is_{role}": F.coalesce(F.sum(hit(role)).over(column) >= least, F.lit(False)) for role, (_, least) in roles.items()})
    if open_end:
        first = F.min(F.when(hit(open_end), F.col("col_no"))).over(Window.partitionBy(*by))
        rows = rows.withColumn(f"_is_{open_end}", F.coalesce(F.col("col_no") >= first, F.lit(False)))
    return rows


def side_table(
    cells: DataFrame, roles: dict[str, tuple[Sequence[str], int]], name: str, name_pattern: str, by: Sequence[str] = ("doc_id",), sep: str | None = None, open_end: str | None = None, twice: bool = False, partitioned: bool = False
) -> DataFrame:
    """Scheme side tables whose columns each document lays out its own way: one row for each scheme with a column for each role but ``name``.

    Columns are found by :func:`with_roles`; the scheme's name is what the pattern finds in the first column of role ``name`` and carries down. The texts of
    the rows, a role's cells joined by a blank, are a list or joined by ``sep``. With ``twice`` a row that names its scheme gives its text once more, with the name before it.
    All of it works on documents, in the exchange made here or, with ``partitioned``, in the one that :func:`stack_tables` made.
    """
    cells = cells if partitioned else cells.repartition(*by)
    cells = with_roles(cells.where(reduce(and_, [F.col(c).isNotNull() for c in (*by, "col_no")])), roles, by, open_end)
    hit = lambda role: F.col(f"_is_{role}")
    first = F.min(F.when(hit(name), F.col("col_no"))).over(Window.partitionBy(*by))
    placed = cells.withColumn(f"_is_{name}", F.coalesce(F.col("col_no") == first, F.lit(False))).where(reduce(or_, map(hit, roles)))
    values = [r for r in roles if r != name]
    text = F.coalesce("text", F.lit(""))
    joined = lambda r: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(hit(r), F.struct("col_no", text.alias("t"))))), lambda x: x["t"]), " ")
    own = F.nullif(F.max(F.when(hit(name), F.regexp_extract("text", name_pattern, 0))), F.lit(""))
    rows = placed.groupBy(*by, "row_no").agg(*[joined(r).alias(r) for r in values], own.alias("_own"))
    rows = rows.withColumn("scheme", F.last("_own", ignorenulls=True).over(Window.partitionBy(*by).orderBy("row_no"))).where("scheme is not null")
    each = lambda r: F.array(F.col(r), F.concat_ws(" ", "_own", r)) if twice else F.array(r)
    texts = lambda r: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_no", F.when(F.col("_own").isNotNull(), each(r)).otherwise(F.array(r)).alias("t")))), lambda x: x["t"]))
    got = rows.groupBy(*by, "scheme").agg(*[texts(r).alias(r) for r in values])
    return got if sep is None else got.withColumns({r: F.array_join(r, sep) for r in values})
