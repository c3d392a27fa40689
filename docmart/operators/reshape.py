"""Reshaping of the long field table: clone, merge, combine, promote, defaults, records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.extract import KV, kv_get, last_wins
from . import folds
from .folds import fold
from .rules import by_house, emit, owner, row, same_row

_FUND = ("doc_id", "fund")


def normalize_keys(fields: DataFrame) -> DataFrame:
    """Normalised keys at both levels."""
    inner = F.transform("kv", lambda x: F.struct(T.normalize_key(x["k"]).alias("k"), x["v"].alias("v")))
    return fields.withColumn("key", T.normalize_key("key")).withColumn("kv", inner)


def clone_keys(fields: DataFrame, rules) -> DataFrame:
    """For each (new key, pattern): the first key that matches at its start is copied, replacing a field of the new name.

    Here and below rules are a list, or lists by house (:class:`~docmart.operators.rules.Houses`) that take effect on their house's
    funds, and all rules of a call are one pass over the fund's fields.
    """
    return fold(fields, folds.cloned(rules))


def merge_keys(fields: DataFrame, rules) -> DataFrame:
    """For each (new key, patterns): matching fields become one.

    Lists are joined; dictionaries are united, later keys win; with other kinds among
    them, the result is a dictionary in which texts stand under their old key.
    An empty result is not stored.  Rules run in order on what the one before left.
    """
    return fold(fields, folds.merged(rules))


def combine_keys(fields: DataFrame, rules) -> DataFrame:
    """For each (new key, keys): lists are joined and texts appended, in the order of the keys."""
    return fold(fields, folds.combined(rules))


def promote_keys(fields: DataFrame, rules, search: bool = False) -> DataFrame:
    """For each (section, new key, pattern): the first sub-key of the section that matches moves to the top level.

    The section is named exactly and the pattern stands at the start or, with ``search``, both are searched for.
    """
    return fold(fields, folds.promoted(rules, search))


def zip_people_fields(fields: DataFrame, new: str, keys: dict[str, str], patterns: dict[str, str], how: str = "pad") -> DataFrame:
    """Managers from lists under different keys, see :func:`~docmart.operators.folds.people_zipped`."""
    return fold(fields, [folds.people_zipped(new, keys, patterns, how)])


def merge_two(a: Column, b: Column, kind: str) -> Column:
    """Two values of one kind as one: lists join, dictionaries unite, texts join by a blank."""
    if kind == "a":
        return F.concat(a, b)
    if kind == "d":
        return last_wins(F.concat(a, b))
    return F.concat_ws(" ", a, b)


def merge_named(fields: DataFrame, key: str, other: str) -> DataFrame:
    """Fields ``…key`` and ``…other`` under the same path as one; unlike kinds become a list of both texts. One pass over the fund's fields by path."""
    path = F.regexp_extract("key", r"^(.*\.)?[^.]+$", 1)
    name = F.regexp_extract("key", r"([^.]+)$", 1)
    own = owner(fields)
    # fields of other names are groups of their own
    group = F.when(name.isin(key, other), path).otherwise(F.concat_ws("\x00", F.lit("-"), "key", "ord"))
    item = F.struct("ord", "key", "kind", "s", "arr", "kv")
    side = lambda cond: F.array_compact(F.collect_list(F.when(cond, item)))
    rows = fields.groupBy(*own, group.alias("_group")).agg(side(name == key).alias("a"), side(name == other).alias("b"), side(~name.isin(key, other)).alias("c"))
    text = lambda x: F.when(x["kind"] == "s", x["s"]).when(x["kind"] == "d", F.array_join(F.transform(x["kv"], lambda y: y["v"]), " ")).otherwise(F.array_join(x["arr"], " "))
    a, b = F.get("a", F.lit(0)), F.get("b", F.lit(0))
    same = a["kind"] == b["kind"]
    made = row(
        a["ord"], a["key"], F.when(same, a["kind"]).otherwise("a"), F.when(same & (a["kind"] == "s"), merge_two(a["s"], b["s"], "s")),
        F.when(same & (a["kind"] == "a"), merge_two(a["arr"], b["arr"], "a")).when(~same, F.array(text(a), text(b))), F.when(same & (a["kind"] == "d"), merge_two(a["kv"], b["kv"], "d")),
    )
    both = (F.size("a") > 0) & (F.size("b") > 0)
    out = F.when(both, F.array(made)).otherwise(F.concat("a", "b", "c"))
    return rows.select(*own, F.explode(out).alias("x")).select(*own, "x.*")


def fan_out(funds: DataFrame, rules: Sequence[tuple[str, Sequence[str]]], fund: str = "fund") -> DataFrame:
    """A fund that matches a pattern becomes one row for each of the rule's names."""
    names = F.coalesce(*[F.when(F.col(fund).rlike(f"(?i){p}"), F.array(*[F.lit(n) for n in ns])) for p, ns in rules], F.array(fund))
    return funds.withColumn(fund, F.explode(names))


def add_constants(fields: DataFrame, constants) -> DataFrame:
    """Constant text fields for every fund, after its other fields; ``{key: value}``, or that by house."""
    return fold(fields, [folds.added(constants)]) if constants else fields


def fill_defaults(fields: DataFrame, defaults) -> DataFrame:
    """Every expected key that a fund lacks, with its default; ``{key: default}``, or that by house."""
    return fold(fields, [folds.defaulted(defaults)]) if defaults else fields


def split_amounts(fields: DataFrame, keys: Sequence[str] = ("min_amt", "min_addl_amt")) -> DataFrame:
    """{amt, thraftr} under a key becomes the key and ``key_multiple``."""
    hit = F.col("key").isin(*keys) & (F.col("kind") == "d")
    get = lambda k: F.coalesce(kv_get(F.col("kv"), k), F.lit(""))
    one, two = row(F.col("ord"), F.col("key"), "s", get("amt")), row(F.col("ord") + 1, F.concat(F.col("key"), F.lit("_multiple")), "s", get("thraftr"))
    return emit(fields, F.when(hit, one).otherwise(same_row()), two, hit)


def load_list(kv: Column, item: str = "comment") -> Column:
    """Sub-keys that name an entry or exit load, with a text, as (type, comment); both may hold for one. Scheme documents name the text ``value``."""
    def one(kind: str, pattern: str) -> Column:
        return F.transform(F.filter(kv, lambda x: x["k"].rlike(f"(?i){pattern}") & (x["v"] != "")), lambda x: F.struct(F.lit(kind).alias("type"), x["v"].alias(item)))

    return F.concat(one("entry_load", "entry"), one("exit_load", "exit"))


def scheme_loads(fields: DataFrame, key: str = "load") -> DataFrame:
    """Load dictionaries of scheme documents as lists of JSON texts {type, value}; loads of another kind stay untouched."""
    hit = (F.col("key") == key) & (F.col("kind") == "d")
    rows = F.transform(load_list(F.col("kv"), "value"), lambda x: F.to_json(x))
    return fields.withColumns({"kind": F.when(hit, F.lit("m")).otherwise(F.col("kind")), "arr": F.when(hit, rows).otherwise(F.col("arr")), "kv": F.when(~hit, F.col("kv"))})


PEOPLE = "array<struct<managing_fund_since:string,name:string,qualification:string,total_exp:string>>"


def field_names(keys: Sequence[str]) -> Column:
    """The names of all fields that a record emits: its texts, ``metrics_<name>``, ``load_<type>`` and ``fund_manager_<attribute>``."""
    texts = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in keys]))
    metrics = F.transform("metrics", lambda x: F.concat(F.lit("metrics_"), x["name"]))
    loads = F.transform("load", lambda x: F.concat(F.lit("load_"), x["type"]))
    people = F.when(F.size("fund_manager") > 0, F.array(*[F.lit(f"fund_manager_{a}") for a in ("managing_fund_since", "name", "qualification", "total_exp")]))
    return F.array_distinct(F.concat(texts, metrics, loads, F.coalesce(people, F.array().cast("array<string>"))))


def field_locations(records: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(doc_id, fund, field, page, scheme_count): every emitted field of a record with its first page, counted from 1, and the document's number of funds.

    ``pages(doc_id, fund, pages)`` are places from 0. The funds of a document are few, so they are numbered in one window.
    """
    numbered = records.join(pages.select(*_FUND, (F.array_min("pages") + 1).cast("string").alias("page")), list(_FUND))
    fund_no = F.dense_rank().over(Window.partitionBy("doc_id").orderBy("fund"))
    counted = numbered.withColumn("_n", fund_no).withColumn("scheme_count", F.max("_n").over(Window.partitionBy("doc_id")))
    return counted.select(*_FUND, F.explode(field_names(keys)).alias("field"), "page", "scheme_count")


def with_locations(records: DataFrame, locations: DataFrame) -> DataFrame:
    """Records with ``field_location``, the list of (field, page) of their fields; a record has some dozens."""
    places = locations.groupBy(*_FUND).agg(F.array_sort(F.collect_list(F.struct("field", "page"))).alias("field_location"))
    return records.join(places, list(_FUND), "left")


def group_locations(records: DataFrame, pages: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Locations in scheme documents: (doc_id, fund, field, page), every present field of a group with that group's page, from ``pages(doc_id, group, page)``."""
    named = F.filter(F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.lit(g).alias("group"), F.lit(k).alias("field"))) for g, ks in groups.items() for k in ks]), lambda x: x.isNotNull())
    fields = records.select(*_FUND, F.explode(named).alias("x")).select(*_FUND, "x.*")
    return fields.join(pages, ["doc_id", "group"]).select(*_FUND, "field", F.col("page").cast("string").alias("page"))


def assemble_records(fields: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each fund with the chosen text keys, whitespace-normalised, its loads (a dictionary, or the list of a scheme document), metrics and managers.

    Null or empty metrics go, benchmark noise and load comments are cleaned, managers stay if there are any. A chosen key of
    another kind than text is left out, as are unknown kinds.
    """
    text = T.normalize_whitespace(F.col("s"))
    columns = [F.max(F.when((F.col("key") == k) & (F.col("kind") == "s"), T.clean_leading_noise(text) if "benchmark" in k else text)).alias(k) for k in sorted(keys)]
    loads = F.max(F.when((F.col("key") == "load") & (F.col("kind") == "d"), F.col("kv"))).alias("_load")
    listed = F.max(F.when((F.col("key") == "load") & (F.col("kind") == "m"), F.col("arr"))).alias("_listed")
    metrics = F.max(F.when((F.col("key") == "metrics") & (F.col("kind") == "d"), F.col("kv"))).alias("_metrics")
    people = F.max(F.when((F.col("key") == "fund_manager") & (F.col("kind") == "m"), F.col("arr"))).alias("_people")
    got = fields.groupBy(*owner(fields)).agg(*columns, loads, listed, metrics, people)
    made = lambda t: F.from_json(t, "type string, comment string, value string")  # noqa: E731  scheme documents have their list already
    given = F.transform(F.coalesce("_listed", F.array().cast("array<string>")), lambda t: F.struct(made(t)["type"].alias("type"), F.coalesce(made(t)["comment"], made(t)["value"]).alias("comment")))
    cleaned = F.transform(F.concat(load_list(F.coalesce("_load", F.array().cast(KV))), given), lambda x: F.struct(T.clean_leading_noise(x["comment"]).alias("comment"), x["type"].alias("type")))
    named = F.transform(F.filter(F.coalesce("_metrics", F.array().cast(KV)), lambda x: F.coalesce(x["v"], F.lit("")) != ""), lambda x: F.struct(x["k"].alias("name"), x["v"].alias("value")))
    persons = F.from_json(F.concat(F.lit("["), F.array_join(F.coalesce("_people", F.array().cast("array<string>")), ","), F.lit("]")), PEOPLE)
    return got.select(*owner(fields), *sorted(keys), persons.alias("fund_manager"), cleaned.alias("load"), named.alias("metrics"))


def documents_of(records: DataFrame, run_date: str, file_type: str = "FS") -> DataFrame:
    """One row for each document: metadata and its records in fund order."""
    value = F.struct(*[c for c in records.columns if c != "doc_id"])
    got = records.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("fund", F.struct(value.alias("value")).alias("r")))).alias("x"))
    meta = F.struct(F.col("doc_id").cast("string").alias("document_name"), F.lit(file_type).alias("file_type"), F.lit(run_date).alias("process_date"))
    return got.select(meta.alias("metadata"), F.transform("x", lambda x: x["r"]).alias("records"))


def merge_and_select(fields: DataFrame, rules: dict, partitioned: bool = False) -> DataFrame:
    """The full chain from refined fields to records, in this order: clone, merge, clone, select, map, split amounts, defaults, key names, metric names, special rules, promote, value and manager clean-up, assembly.

    Every part of ``rules`` may be by house; ``metrics`` maps metric names, ``stop_words`` is a pattern that goes from managers' names.
    Fields that lie together by document and fund already (``partitioned``) are not exchanged again. All rules up to the special ones are
    one grouping and one fold.
    """
    from .rules import special_pass

    fields = fields if partitioned else fields.repartition(*_FUND)  # the chain's one exchange
    clone = folds.cloned(rules.get("clone", ()))
    steps = [*clone, *folds.merged(rules.get("merge", ())), *clone, folds.selected(rules["select"]), folds.mapped(rules.get("map", ())), folds.amounts_split(AMOUNTS)]
    steps += [folds.defaulted(rules["defaults"])] if rules.get("defaults") else []
    steps += [folds.each_item(_normal_item)]
    steps += [folds.each_item(lambda x: _metrics_item(x, rules["metrics"]))] if rules.get("metrics") else []
    promote = folds.promoted(rules.get("promote", ()))
    if rules.get("special"):
        out = special_pass(fold(fields, steps), rules["special"])
        out = fold(out, promote) if promote else out
    else:
        out = fold(fields, steps + promote)
    return assemble_records(clean_values(out, rules.get("stop_words")), rules["record"])


AMOUNTS = ("min_amt", "min_addl_amt")


def _normal_item(x: Column) -> Column:
    inner = F.transform(x["kv"], lambda y: F.struct(T.normalize_key(y["k"]).alias("k"), y["v"].alias("v")))
    return folds.with_(x, key=T.normalize_key(x["key"]), kv=inner)


def _metrics_item(x: Column, keys) -> Column:
    from .rules import map_metric

    named = F.transform(x["kv"], lambda y: F.struct(F.coalesce(by_house(keys, lambda k: map_metric(y["k"], k)), y["k"]).alias("k"), y["v"].alias("v")))
    return folds.with_(x, kv=F.when((x["key"] == "metrics") & (x["kind"] == "d"), last_wins(named)).otherwise(x["kv"]))


def map_metrics(fields: DataFrame, keys) -> DataFrame:
    """The canonical names of the metrics in ``metrics``; ``[(name, pattern)]``, or that by house. A later metric of one name wins."""
    return fold(fields, [folds.each_item(lambda x: _metrics_item(x, keys))]) if keys else fields


def clean_values(fields: DataFrame, stop_words: str | None = None) -> DataFrame:
    """Values by the kind of their key: currency, launch date, amounts, metrics and managers."""
    s, key = F.col("s"), F.col("key")
    amounts = ["min_amt", "min_addl_amt", "min_amt_multiple", "min_addl_amt_multiple"]
    s = F.when(key == "monthly_aaum_value", T.clean_currency(s)).when(key == "scheme_launch_date", T.date_to_yyyymmdd(s)).when(key.isin(*amounts), T.clean_amount("fund", s)).otherwise(s)
    metric = F.filter(F.transform("kv", lambda x: F.struct(x["k"].alias("k"), T.clean_metric("fund", x["k"], x["v"]).alias("v"))), lambda x: x["v"].isNotNull())

    def person(x: Column) -> Column:
        m = F.from_json(x, "managing_fund_since string, name string, qualification string, total_exp string")
        clean = lambda c: T.clean_manager_name(c, stop_words) if stop_words else T.clean_manager_name(c)
        return F.to_json(F.struct(m["managing_fund_since"].alias("managing_fund_since"), clean(m["name"]).alias("name"), m["qualification"].alias("qualification"), m["total_exp"].alias("total_exp")))

    people = F.filter(F.transform("arr", person), lambda x: F.get_json_object(x, "$.name") != "")
    is_people = (key == "fund_manager") & (F.col("kind") == "m")
    return fields.withColumns({"s": s, "kv": F.when(key == "metrics", metric).otherwise(F.col("kv")), "arr": F.when(is_people, people).otherwise(F.col("arr"))})


def scheme_steps(rules: dict, kim: bool = False) -> tuple[list[folds.Step], list[folds.Step]]:
    """The steps of scheme documents before and after the special rules.

    Clone, merge, clone, select, map; then, of a full document (SID), split amounts, defaults and the load list, of a key memorandum (KIM) the
    asset list and defaults; after the special rules promotion by search and constants. Deletion comes at the very end, behind the locations.
    """
    clone = folds.cloned(rules.get("clone", ()))
    steps = [*clone, *folds.merged(rules.get("merge", ())), *clone, folds.selected(rules["select"]), folds.mapped(rules.get("map", ()))]
    steps += [folds.each_item(_assets_item)] if kim else [folds.amounts_split(AMOUNTS)]
    steps += [folds.defaulted(rules["defaults"])] if rules.get("defaults") else []
    steps += [] if kim else [folds.each_item(_loads_item)]
    after = folds.promoted(rules.get("promote", ()), search=True)
    after += [folds.added(rules["constants"])] if rules.get("constants") else []
    return steps, after


def _loads_item(x: Column) -> Column:
    hit = (x["key"] == "load") & (x["kind"] == "d")
    clean = F.transform(load_list(F.transform(x["kv"], lambda y: F.struct(y["k"].alias("k"), T.clean_leading_noise(T.normalize_whitespace(y["v"])).alias("v")))), lambda y: F.to_json(F.struct(y["comment"].alias("comment"), y["type"].alias("type"), F.lit("").alias("value"))))
    return F.when(hit, folds.with_(x, kind=F.lit("m"), arr=clean, kv=F.lit(None).cast(KV))).otherwise(folds.with_(x))


def _assets_item(x: Column) -> Column:
    """Rows {instrument, min, max, total, risk_profile} of a KIM's allocation as {allocation, instrument_type, risk_profile}."""
    def one(text: Column) -> Column:
        r = F.from_json(text, "instrument string, instrument_type string, min string, max string, total string, risk_profile string")
        blank = lambda c: F.coalesce(c, F.lit(""))
        parts = F.array(*[F.struct(F.lit(t).alias("type"), blank(r[t]).alias("value")) for t in ("min", "max", "total")])
        return F.to_json(F.struct(parts.alias("allocation"), T.normalize_whitespace(blank(F.coalesce(r["instrument"], r["instrument_type"]))).alias("instrument_type"), blank(r["risk_profile"]).alias("risk_profile")))

    hit = (x["key"] == "asset_allocation_pattern") & (x["kind"] == "m")
    return folds.with_(x, arr=F.when(hit, F.transform(x["arr"], lambda t: F.when(t.contains('"allocation"'), t).otherwise(one(t)))).otherwise(x["arr"]))


def merge_and_select_scheme(fields: DataFrame, rules: dict, kim: bool = False, partitioned: bool = False) -> DataFrame:
    """The chain of scheme documents up to assembly (:func:`scheme_steps`), as one row for each document with the texts of ``rules["record"]``, loads, metrics and managers."""
    return assemble_records(_scheme_fields(fields, rules, kim, partitioned), rules["record"])


def _scheme_fields(fields: DataFrame, rules: dict, kim: bool, partitioned: bool = False) -> DataFrame:
    from .predicates import delete_keys
    from .rules import special_pass

    fields = fields if partitioned else fields.repartition(*_FUND)  # the chain's one exchange
    before, after = scheme_steps(rules, kim)
    if rules.get("special"):
        out = special_pass(fold(fields, before), rules["special"])
        out = fold(out, after) if after else out
    else:
        out = fold(fields, before + after)
    out = delete_keys(out, rules["delete"]) if rules.get("delete") else out
    amounts = F.when(F.col("key").rlike("^min_"), T.clean_amount_any(F.col("s"))).otherwise(F.col("s"))
    return out.withColumn("s", amounts)


def variant_records(fields: DataFrame, pages: DataFrame | None = None, groups: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One row for each fund: its fields, keys sorted, as one VARIANT ``value``, whatever the kinds: text, list, dictionary, or list of objects.

    With ``pages(doc_id, group, page)`` and ``groups`` of field names the value has ``field_location``: [{field, page}] of the fields that are there.
    Texts are cleaned as in :func:`assemble_records`; a key of unknown kind is left out; of equal keys the last stays.
    """
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r"(?s)^.{5}(.*).$", 1)
    text = T.normalize_whitespace(F.col("s"))
    text = F.when(F.col("key").contains("benchmark"), T.clean_leading_noise(text)).otherwise(text)
    body = (
        F.when(F.col("kind") == "s", F.when(F.col("s").isNull(), "null").otherwise(quoted(text)))
        .when(F.col("kind") == "a", F.to_json(F.coalesce("arr", F.array().cast("array<string>"))))
        .when(F.col("kind") == "d", F.to_json(F.map_from_entries(F.transform(last_wins(F.filter("kv", lambda x: x["k"].isNotNull())), lambda x: F.struct(x["k"], F.coalesce(x["v"], F.lit("")))))))
        .when(F.col("kind") == "m", F.concat(F.lit("["), F.array_join("arr", ","), F.lit("]")))
    )
    own = owner(fields)
    told = fields.select(*own, "ord", "key", body.alias("body")).where("body is not null")
    item = F.struct("key", "ord", "body")
    got = told.groupBy(*own).agg(F.array_sort(F.collect_list(item)).alias("_all"))
    got = got.withColumn("_all", F.filter("_all", lambda x, i: F.coalesce(F.get("_all", i + 1)["key"] != x["key"], F.lit(True))))
    if groups:
        place = pages.groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("group", F.col("page").cast("string")))).alias("_pages"))  # a document has a few groups
        got = got.join(place, "doc_id", "left")
        named = F.array(*[F.struct(F.lit(k).alias("field"), F.lit(g).alias("group")) for g, ks in groups.items() for k in ks])
        here = F.filter(named, lambda n: F.exists("_all", lambda x: x["key"] == n["field"]) & F.col("_pages")[n["group"]].isNotNull())
        where = F.to_json(F.transform(here, lambda n: F.struct(n["field"].alias("field"), F.col("_pages")[n["group"]].alias("page"))))
        got = got.withColumn("_all", F.array_sort(F.concat("_all", F.array(F.struct(F.lit("field_location").alias("key"), F.lit(0).cast("long").alias("ord"), where.alias("body"))))))
    parts = F.array_join(F.transform("_all", lambda x: F.concat(quoted(x["key"]), F.lit(":"), x["body"])), ",")
    return got.select(*own, F.parse_json(F.concat(F.lit("{"), parts, F.lit("}"))).alias("value"))


def scheme_records(fields: DataFrame, rules: dict, pages: DataFrame | None = None, groups: dict[str, Sequence[str]] | None = None, kim: bool = False) -> DataFrame:
    """The chain of scheme documents to VARIANT records, with loads, allocations and locations (:func:`variant_records`)."""
    return variant_records(_scheme_fields(fields, rules, kim), pages, groups)
