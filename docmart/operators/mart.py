"""The relational mart: wide rows, dimension and fact tables, joins and comparisons of two sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import normalize_alphanumeric
from ..sources.documents import cut


def pivot_last(rows: DataFrame, by: Sequence[str], name: str, value: str, order: str, names: Sequence[str], default: str | None = "") -> DataFrame:
    """One column for each listed name with its last value; other names are ignored. One pass of partial aggregates."""
    cell = lambda n: F.max_by(F.when(F.col(name) == n, F.col(value)), F.when(F.col(name) == n, F.col(order)))
    fill = lambda c: F.coalesce(c, F.lit(default)) if default is not None else c
    return rows.groupBy(*by).agg(*[fill(cell(n)).alias(n) for n in names])


#: The metric columns of the mart.
METRICS = (
    "alpha", "arithmetic_mean_ratio", "average_div_yld", "average_pb", "average_pe", "avg_maturity", "beta", "correlation_ratio", "downside_deviation", "information_ratio", "macaulay",
    "mod_duration", "port_turnover_ratio", "r_squared_ratio", "roe_ratio", "sharpe", "sortino_ratio", "std_dev", "tracking_error", "treynor_ratio", "upside_deviation", "ytm",
)


#: The metric columns of a wide row.
WIDE_METRICS = (
    "alpha", "arithmetic_mean_ratio", "average_div_yield", "average_pb", "average_pe", "avg_maturity", "beta", "correlation_ratio", "downside_deviation", "information_ratio", "macaulay",
    "mod_duration", "port_turnover_ratio", "r_squared_ratio", "roe_ratio", "sharpe", "sortino_ratio", "std_dev", "tracking_error", "treynor_ratio", "upside_deviation", "ytm",
)
#: The text columns of a wide row.
WIDE_TEXTS = ("amc_name", "main_scheme_name", "mutual_fund_name", "benchmark_index", "monthly_aaum_date", "monthly_aaum_value", "scheme_launch_date", "min_addl_amt", "min_addl_amt_multiple", "min_amt", "min_amt_multiple")


def load_columns(loads: Column) -> list[Column]:
    """entry_load and exit_load from a list of (type, comment), both spellings of the type, the last of each."""
    def last(kind: str) -> Column:
        found = F.filter(loads, lambda x: x["type"].isin(kind, f"{kind}_load"))
        return F.coalesce(F.try_element_at(found, F.lit(-1))["comment"], F.lit("")).alias(f"{kind}_load")

    return [last("entry"), last("exit")]


def wide_rows(records: DataFrame, static: Sequence[str] = WIDE_TEXTS, metrics: Sequence[str] = WIDE_METRICS) -> DataFrame:
    """One flat row for each record: static keys (lists joined by ", "), entry and exit load, a column for each metric, '' where absent."""
    def text(k: str) -> Column:
        if k not in records.columns:
            return F.lit("").alias(k)
        value = F.array_join(k, ", ") if isinstance(records.schema[k].dataType, T.ArrayType) else F.col(k)
        return F.coalesce(value, F.lit("")).alias(k)

    def metric(n: str) -> Column:
        return F.coalesce(F.try_element_at(F.filter("metrics", lambda x: x["name"] == n), F.lit(-1))["value"], F.lit("")).alias(n)

    return records.select("doc_id", "fund", *[text(k) for k in static], *load_columns(F.col("load")), *[metric(m) for m in metrics])


#: The text columns of the funds table.
FUND_TEXTS = ("amc_name", "benchmark_index", "main_scheme_name", "mutual_fund_name", "monthly_aaum_date", "monthly_aaum_value", "scheme_launch_date", "min_addl_amt", "min_addl_amt_multiple", "min_amt", "min_amt_multiple")


def funds_table(records: DataFrame, amc_id: Column, entered: Column, month: Column, data_from: str) -> DataFrame:
    """The funds table: key and load columns, the texts ('' where absent), and typed companions of amounts and the launch date."""
    have = set(records.columns)
    texts = [(F.coalesce(c, F.lit("")) if c in have else F.lit("")).alias(c) for c in FUND_TEXTS]
    out = records.select("doc_id", amc_id.alias("amc_id"), entered.alias("entered_time"), month.alias("amc_for_month"), F.lit(data_from).alias("data_from"), *texts)
    numbers = {f"{c}_num": F.col(c).try_cast("double") for c in ("min_amt", "min_addl_amt")}
    return out.withColumns(numbers | {"launch_date": F.try_to_timestamp("scheme_launch_date", F.lit("yyyyMMdd")).cast("date")})


def _facts(records: DataFrame, amc_id: Column, entered: Column, month: Column, data_from: str) -> list[Column]:
    """The key columns of a fact row: house, document, scheme, time, month and source."""
    return [amc_id.alias("amc_id"), F.col("doc_id"), F.col("fund").alias("main_scheme_name"), entered.alias("entered_time"), month.alias("amc_for_month"), F.lit(data_from).alias("data_from")]


def managers_table(records: DataFrame, amc_id: Column, entered: Column, month: Column, data_from: str, people: str = "fund_manager") -> DataFrame:
    """One row for each manager: the key columns and name, since, qualification and experience ('' where absent)."""
    rows = records.select(*_facts(records, amc_id, entered, month, data_from), F.explode(people).alias("m"))
    texts = [F.coalesce(F.col("m")[c], F.lit("")).alias(c) for c in ("name", "managing_fund_since", "qualification", "total_exp")]
    return rows.select("amc_id", "doc_id", "main_scheme_name", "entered_time", "amc_for_month", "data_from", *texts)


def loads_table(records: DataFrame, amc_id: Column, entered: Column, month: Column, data_from: str) -> DataFrame:
    """One row for each record: the key columns, entry and exit load, both spellings of the type."""
    return records.select(*_facts(records, amc_id, entered, month, data_from), *load_columns(F.col("load")))


#: The normalised tables and the columns that make their rows unique, besides document and scheme.
NORMALISED = {
    "asset_allocation": ("instrument_type", "risk_level"),
    "benchmarks": ("benchmark_index",),
    "field_locations": ("field_name", "page_no"),
    "managers": ("name", "since", "qualification", "experience"),
    "loads": ("type", "value"),
}


def normalised(records: DataFrame, child: str, key: Sequence[str]) -> DataFrame:
    """A child list as a table, unique by document, scheme and its key columns, not migrated yet."""
    rows = records.select("doc_id", "fund", F.explode(child).alias("x")).select("doc_id", "fund", "x.*")
    return rows.dropDuplicates(["doc_id", "fund", *key]).withColumn("is_migrated", F.lit(False))


def normalised_tables(records: DataFrame, locations: DataFrame, common: Sequence[str], assets: str | None = None) -> dict[str, DataFrame]:
    """All normalised tables of assembled records: common texts, allocations, benchmarks, locations, managers and loads."""
    def texts(x: Column, names: dict[str, str]) -> Column:
        return F.struct(*[x[old].alias(new) for new, old in names.items()])

    people = {"name": "name", "since": "managing_fund_since", "qualification": "qualification", "experience": "total_exp"}
    shaped = records.withColumns({
        "_managers": F.transform("fund_manager", lambda x: texts(x, people)),
        "_loads": F.transform("load", lambda x: texts(x, {"type": "type", "value": "comment"})),
        "_benchmarks": F.when(F.coalesce("benchmark_index", F.lit("")) != "", F.array(F.struct("benchmark_index"))),
    })
    out = {"common": records.select("doc_id", "fund", *[F.coalesce(c, F.lit("")).alias(c) for c in common]).dropDuplicates(["doc_id", "fund"]).withColumn("is_migrated", F.lit(False))}
    for name in ("managers", "loads", "benchmarks"):
        out[name] = normalised(shaped, f"_{name}", NORMALISED[name])
    place = locations.select("doc_id", "fund", F.col("field").alias("field_name"), F.col("page").alias("page_no"))
    out["field_locations"] = place.dropDuplicates(["doc_id", "fund", *NORMALISED["field_locations"]]).withColumn("is_migrated", F.lit(False))
    if assets:
        shaped = records.withColumn("_assets", F.transform(assets, lambda x: F.struct(x["instrument_type"].alias("instrument_type"), x["risk_profile"].alias("risk_level"), x["allocation"].alias("allocation"))))
        out["asset_allocation"] = normalised(shaped, "_assets", NORMALISED["asset_allocation"])
    return out


def distinct_keys(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All keys at every depth of the given columns, lower snake, with the column they are in and their depth (1 at the top).

    Depth ends where the declared type does: maps give their keys, structs their fields, and lists are looked into.
    """
    from ..functions.text import normalize_key

    def inside(value: Column, kind: T.DataType, depth: int) -> list[Column]:
        """Arrays of (depth, key) of a value."""
        item = lambda k: F.struct(F.lit(depth).alias("depth"), k.alias("key"))
        if isinstance(kind, T.MapType):
            below = inside_each(F.map_values(value), kind.valueType, depth + 1)
            return [F.transform(F.map_keys(value), item), *below]
        if isinstance(kind, T.StructType):
            own = F.when(value.isNotNull(), F.array(*[item(F.lit(f.name)) for f in kind.fields]))
            return [own, *[x for f in kind.fields for x in inside(value[f.name], f.dataType, depth + 1)]]
        if isinstance(kind, T.ArrayType):
            return inside_each(value, kind.elementType, depth)
        return []

    def inside_each(values: Column, kind: T.DataType, depth: int) -> list[Column]:
        empty = F.array().cast("array<struct<depth:int,key:string>>")
        if not inside(F.lit(None), kind, depth):
            return []
        return [F.flatten(F.transform(values, lambda x: F.concat(*[F.coalesce(p, empty) for p in inside(x, kind, depth)])))]

    empty = F.array().cast("array<struct<depth:int,key:string>>")

    def at(level: str, part: Column) -> Column:
        return F.transform(F.coalesce(part, empty), lambda x: F.struct(F.lit(level).alias("level"), x["depth"].alias("depth"), x["key"].alias("key")))

    found = [at(c, part) for c in columns for part in inside(F.col(c), rows.schema[c].dataType, 1)]
    return rows.select(F.explode(F.concat(*found)).alias("x")).select("x.level", "x.depth", normalize_key(F.col("x.key")).alias("key")).distinct()


def page_report(hits: DataFrame, titles: DataFrame, terms: Sequence[str], page: Sequence[str] = ("doc_id", "page")) -> DataFrame:
    """Page, title, hit count and the hits spread over ``idx_1`` … as many as there are terms, so that no hit is left out."""
    return titles.join(hits, list(page), "left").select(*page, "title", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), *[F.get("hits", F.lit(i)).alias(f"idx_{i + 1}") for i in range(len(terms))])


def run_summary(ledger: DataFrame, by: Sequence[str] = ("run", "status")) -> DataFrame:
    """Documents by run and status; the files themselves are the ledger's rows."""
    return ledger.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def scheme_ids(names: DataFrame, name: str, schemes: Sequence[tuple[int, str]]) -> DataFrame:
    """Rows with the id of every scheme rule found in the cleaned name, exploded."""
    clean = normalize_alphanumeric(name)
    ids = F.array_compact(F.array(*[F.when(clean.rlike(f"(?i){p}"), F.lit(i)) for i, p in schemes]))
    return names.withColumn("rule_id", F.explode(ids))


def bridge_join(funds: DataFrame, side: DataFrame, schemes: Sequence[tuple[int, str]], fund: str = "fund", side_name: str = "side_fund") -> DataFrame:
    """Funds with the side rows that one scheme pattern finds in both names; funds without one stay.

    Both sides go through rule ids, two linear passes and an equi-join, never name against name.
    """
    left = scheme_ids(funds.select(fund).distinct(), fund, schemes)
    right = scheme_ids(side.select(side_name).distinct(), side_name, schemes)
    pairs = left.join(right, "rule_id").select(fund, side_name).distinct()
    return funds.join(pairs, fund, "left").join(side, side_name, "left")


def override_side(fields: DataFrame, side: DataFrame, schemes: Sequence[tuple[int, str]], by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A document's fields with those of its side tables: a fund takes the fields of every side fund in whose name one of its scheme rules is found too, in side order, later ones winning.

    ``fields`` is a field table; ``side`` has the same columns with ``side_fund`` for the fund and ``side_no``, the order. A side field
    takes the place of the field with its key, or comes behind all. Side fields are first reduced to one for each rule and key, so what a rule joins is funds times
    keys and never funds times side funds.
    """
    item = F.struct("side_no", "ord", "kind", "s", "arr", "kv")
    names = scheme_ids(side.select(*by, "side_fund").distinct(), "side_fund", schemes)
    last = side.join(names, [*by, "side_fund"]).groupBy(*by, "rule_id", "key").agg(F.max(item).alias("_last"), F.min(F.struct("side_no", "ord")).alias("_first"))
    funds = scheme_ids(fields.select(*by, "fund").distinct(), "fund", schemes)
    new = funds.join(last, [*by, "rule_id"]).groupBy(*by, "fund", "key").agg(F.max("_last").alias("_last"), F.min("_first").alias("_first"))
    own = fields.withColumn("_new", F.lit(None).cast(new.schema["_last"].dataType)).withColumn("_first", F.lit(None).cast(new.schema["_first"].dataType))
    extra = new.select(*by, "fund", "key", F.col("_last").alias("_new"), "_first")
    both = own.unionByName(extra, allowMissingColumns=True)
    old = F.struct("ord", "kind", "s", "arr", "kv")
    got = both.groupBy(*by, "fund", "key").agg(F.max(F.when(F.col("_new").isNull(), old)).alias("_old"), F.max("_new").alias("_new"), F.max("_first").alias("_first"))
    take = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
    # behind all fields of the fund, in the order in which the side tables bring new keys
    place = F.coalesce("_old.ord", 1_000_000_000 + F.dense_rank().over(Window.partitionBy(*by, "fund").orderBy("_first", "key")))
    return got.select(*by, "fund", place.cast("long").alias("ord"), "key", *[take(c) for c in ("kind", "s", "arr", "kv")])


def read_mart(funds: DataFrame, loads: DataFrame, metrics: DataFrame, key: Sequence[str], like: tuple[str, str] | None = None, equal: dict[str, object] | None = None) -> DataFrame:
    """Funds with their loads and metrics where they have any, filtered by a LIKE pattern and by equality before the joins."""
    if like:
        funds = funds.where(F.col(like[0]).like(like[1]))
    for column, value in (equal or {}).items():
        funds = funds.where(F.col(column) == value)
    return funds.join(loads, list(key), "left").join(metrics, list(key), "left")


def union_sources(sources: dict[str, DataFrame], name: str) -> DataFrame:
    """Rows of several sources with a ``source`` tag; the tag and the name come first, missing columns are null.

    A source without the name column has nothing to compare and is skipped, as are rows without a name.
    """
    parts = [df.withColumn("source", F.lit(tag)) for tag, df in sources.items() if name in df.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.where(F.col(name).isNotNull()).select("source", name, *[c for c in out.columns if c not in ("source", name)])


def diff_sources(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, field, a, b) wherever two sources differ, including rows that only one has."""
    def long(df: DataFrame, tag: str) -> DataFrame:
        items = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns])
        return df.select(key, F.explode(items).alias("x")).select(key, F.col("x.field").alias("field"), F.col("x.v").alias(tag))

    return long(a, "a").join(long(b, "b"), [key, "field"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))


def dimension_keys(names: DataFrame, known: DataFrame, name: str, key: str) -> DataFrame:
    """All names with a key: known ones keep theirs, new ones get a hash of the name, so writers need no coordination."""
    fresh = names.select(name).distinct().join(known.select(name), name, "left_anti").select(name, F.xxhash64(name).alias(key))
    return known.select(name, key).unionByName(fresh)


def dense_dimension_keys(names: DataFrame, known: DataFrame, name: str, key: str) -> DataFrame:
    """New names get the next numbers in order of the name.

    Names are dealt by ranges; each range counts its own, and the counts of the ranges, one row each, give its
    first number. Rows of a range are numbered within it, so no task orders them all.
    """
    fresh = names.where(F.col(name).isNotNull()).select(name).distinct().join(known.select(name), name, "left_anti")
    ranges = fresh.repartitionByRange(name).withColumn("_part", F.spark_partition_id())
    ranges = cut(ranges)  # the ranges must not change between counting and numbering
    sizes = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min(name).alias("_from"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))
    offsets = sizes.withColumn("_off", before).crossJoin(F.broadcast(top)).select("_part", (F.col("_off") + F.col("_top")).alias("_off"))  # one row a range; top is one row
    numbered = ranges.join(offsets, "_part").withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(name)))
    return known.select(name, key).unionByName(numbered.select(name, (F.col("_off") + F.col("_rn")).cast(known.schema[key].dataType).alias(key)))
