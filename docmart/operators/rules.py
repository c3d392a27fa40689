"""Rule dispatch: header and key maps, levels of extractors, refinement.

Rules are small tables in priority order.  A map from patterns to names becomes a chain of
literal conditions, each compiled once, of which the first that holds decides.

Extraction rules are data: a level finds the number of a field's rule, the rule's patterns come from a table by that
number, and the plan holds one expression for each shape (extractor, options, groups), however many
houses and rules there are.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.extract import EXTRACTORS, KV, Pattern, groups
from ..functions.text import _c, key_to_alnum_underscore, normalize_key, strip

#: A field row: text in ``s``, list in ``arr``, dictionary in ``kv``, as ``kind`` says (s, a, d; m: a list of JSON texts in ``arr``).
#: ``amc_key`` may stand beside doc_id and fund; with it, rules can differ by fund house.
FIELDS = f"doc_id bigint, fund string, ord bigint, key string, kind string, s string, arr array<string>, kv {KV}"


def first_rule(c: Column, rules: Sequence[tuple[str, str]], ignore_case: bool = True, at_start: bool = True) -> Column:
    """The name of the first (name, pattern) that matches, else null."""
    flags = "(?i)" * ignore_case
    tests = [F.when(c.rlike(f"{flags}{'^' * at_start}(?:{p})"), F.lit(name)) for name, p in rules]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def sql_text(text: str) -> str:
    """A text as SQL writes it."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_by_house(column: str, rules, ignore_case: bool = True) -> Column:
    """The name or number of the first (name, pattern) that matches at the start, of a list or of the row's house in :class:`Houses`; else null.

    Written as one SQL expression: hundreds of houses and rules make a plan in a moment. It stands in a function of arrays, which Spark
    interprets: as generated code, a condition for each rule would be too long to compile. Each pattern is compiled once a task.
    """
    if not isinstance(rules, Houses):
        return F.expr(first_by_house_sql(column, rules, ignore_case))
    return F.expr(f"get(transform(array({column}), k -> {first_by_house_sql('k', rules, ignore_case)}), 0)")


def first_by_house_sql(column: str, rules, ignore_case: bool = True) -> str:
    flags = "(?i)" * ignore_case
    name = lambda n: str(n) if isinstance(n, int) else sql_text(n)

    def chain(own: Sequence[tuple]) -> str:
        tests = " ".join(f"WHEN {column} RLIKE {sql_text(f'{flags}^(?:{p})')} THEN {name(n)}" for n, p in own)
        return f"CASE {tests} END" if tests else "NULL"

    if not isinstance(rules, Houses):
        return chain(rules)
    rest = chain(rules.rest)
    return f"CASE amc_key {' '.join(f'WHEN {sql_text(h)} THEN {chain(own)}' for h, own in rules.items())} ELSE {rest} END" if rules else rest


def map_header(c, heads: Sequence[tuple[str, str]]) -> Column:
    """The canonical head of a header, punctuation aside, else the header itself without punctuation."""
    text = strip(F.regexp_replace(_c(c), r"(?U)[^\w\s]", ""))
    return F.coalesce(first_rule(text, heads), text)


def map_key(c, keys: Sequence[tuple[str, str]]) -> Column:
    """The canonical key (case matters), else the key."""
    return F.coalesce(first_rule(_c(c), keys, ignore_case=False), _c(c))


def map_metric(c, keys: Sequence[tuple[str, str]]) -> Column:
    key = key_to_alnum_underscore(c)
    return F.coalesce(first_rule(key, keys, ignore_case=False), key)


def owner(fields: DataFrame) -> list[str]:
    """The columns that say whose a field is: document and fund, and, where the table has them, the fund house and the fund's origin."""
    return [c for c in ("doc_id", "fund", "amc_key", "first_page", "scheme_count") if c in fields.columns]


def by_house(rules, build: Callable[[object], Column]) -> Column:
    """``build(rule)`` for all fields or, of rules by house ``{amc_key: rule}``, for the fields of each; null where a house has none."""
    if not isinstance(rules, Houses):
        return build(rules)
    if not rules:
        return F.lit(None)
    return F.coalesce(*[F.when(F.col("amc_key") == house, build(rule)) for house, rule in rules.items()])


class Houses(dict):
    """Rules by fund house, all in one plan: an operator takes its k-th rule of each house in its k-th step. ``rest`` is for other houses."""

    rest: Sequence = ()


def in_steps(rules) -> list:
    """The rules in order or, of lists by house, the k-th of each house together."""
    if not isinstance(rules, Houses):
        return list(rules)
    longest = max(map(len, rules.values()), default=0)
    return [Houses({h: r[k] for h, r in rules.items() if k < len(r)}) for k in range(longest)]


def row(ord_, key, kind, s=None, arr=None, kv=None) -> Column:
    """A field of the same fund as the row at hand."""
    typed = lambda v, t: (F.lit(None) if v is None else v).cast(t)
    return F.struct(
        ord_.cast("long").alias("ord"), (F.lit(key) if isinstance(key, str) else key).alias("key"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        typed(s, "string").alias("s"), typed(arr, "array<string>").alias("arr"), typed(kv, KV).alias("kv"),
    )


def same_row(ord_: Column | None = None, kv: Column | None = None) -> Column:
    return row(F.col("ord") if ord_ is None else ord_, F.col("key"), F.col("kind"), F.col("s"), F.col("arr"), F.col("kv") if kv is None else kv)


def each(fields: DataFrame, rows: Column) -> DataFrame:
    """The rows of an array for each field. Document and fund stay outside it, so Spark knows that their partitioning holds.

    An inner explode would have Spark work the array out twice, once to filter by its size.
    """
    own = owner(fields)
    return fields.select(*own, F.explode_outer(rows).alias("x")).where("x is not null").select(*own, "x.*")


def emit(fields: DataFrame, first: Column, second: Column, when: Column) -> DataFrame:
    """For each field one row, and a second one where the condition holds: fields are added and replaced in one pass, without reading the table twice."""
    return each(fields, F.when(when, F.array(first, second)).otherwise(F.array(first)))


def last_per_key(fields: DataFrame) -> DataFrame:
    """Of fields that ended up with one key, the last."""
    w = Window.partitionBy("doc_id", "fund", "key").orderBy(F.desc("ord"))
    return fields.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def map_keys(fields: DataFrame, keys) -> DataFrame:
    """Keys by their map, ``[(name, pattern)]`` or :class:`Houses` of them; a house without one keeps its keys."""
    return last_per_key(fields.withColumn("key", F.coalesce(first_by_house("key", keys, ignore_case=False), F.col("key"))))


@dataclass(frozen=True)
class Dispatch:
    """Keys that match ``key_pattern`` at their start go to an extractor with a rule; ``house`` is the fund house it is for, None for all."""

    key_pattern: str
    extractor: str
    rule: dict = field(default_factory=dict)
    house: str | None = None

    @property
    def kind(self) -> str:
        return EXTRACTORS[self.extractor].kind_of(self.rule)

    def shape(self) -> tuple[str, list[str]]:
        """What the plan must know of the rule, as a text to compare, and its patterns."""
        if not EXTRACTORS[self.extractor].columns:
            return json.dumps([self.extractor, self.rule], sort_keys=True), []
        texts: list[str] = []
        told = {n: _walk(n, v, texts.append) for n, v in sorted(self.rule.items())}
        return json.dumps([self.extractor, [[n, [groups(t) for t in texts] if told[n] is not self.rule[n] else told[n]] for n in told]], default=list), texts

    def open_rule(self) -> dict:
        """The rule with columns of ``_p`` for its patterns."""
        if not EXTRACTORS[self.extractor].columns:
            return self.rule
        count = iter(range(len(self.rule) + len(self.rule.get("keywords", ()))))
        hold = lambda text: Pattern(F.get("_p", F.lit(next(count))), groups(text))
        return {n: _walk(n, v, hold) for n, v in sorted(self.rule.items())}


def _walk(name: str, value, use: Callable[[str], object]):
    """A part of a rule with ``use`` of each of its patterns, or the part itself if it has none."""
    if name == "keywords":
        return [use(k) for k in value]
    return use(value) if name in PATTERNS and isinstance(value, str) and value else value


#: The parts of a rule that are patterns.
PATTERNS = ("pattern", "escape", "key", "value", "name", "since", "exp", "remove", "date", "year")


def value_text() -> Column:
    """A field's value as one text."""
    pairs = F.array_join(F.transform("kv", lambda x: F.concat_ws(" ", x["k"], x["v"])), " ")
    return F.when(F.col("kind").isin("a", "m"), F.array_join("arr", " ")).when(F.col("kind") == "d", pairs).otherwise(F.col("s"))


def source_text(source: str) -> Column:
    """What an extractor reads: the value as text, the key, both, or the values of a dictionary without its keys."""
    if source == "key":
        return F.col("key")
    if source == "both":
        return F.concat_ws(" ", F.col("key"), value_text())
    if source == "values":
        return F.when(F.col("kind") == "d", F.array_join(F.transform("kv", lambda x: x["v"]), " ")).otherwise(value_text())
    return value_text()


def _ruled(fields: DataFrame, level: Sequence[Dispatch]) -> DataFrame:
    """Fields with ``_no``, the number of their rule (null: none), what it extracts in ``_s``, ``_arr`` or ``_kv``, the ``_kind`` of that, and ``_empty``, whether a miss leaves an empty dictionary.

    The rules' patterns are joined by number: a local table as large as the rules, which are in the plan anyhow.
    """
    by_house_: dict[str | None, list] = {}
    for no, d in enumerate(level):
        by_house_.setdefault(d.house, []).append((no, d.key_pattern))
    rest = by_house_.pop(None, [])
    rules = Houses({h: sorted(own + rest) for h, own in by_house_.items()}) if by_house_ else rest
    if isinstance(rules, Houses):
        rules.rest = rest
    shapes: dict[str, tuple[int, Dispatch, dict]] = {}
    rows = []
    for no, d in enumerate(level):
        told, texts = d.shape()
        if told not in shapes:
            shapes[told] = (len(shapes), d, d.open_rule())
        rows.append((no, shapes[told][0], texts))
    table = fields.sparkSession.createDataFrame(rows, "_no int, _shape int, _p array<string>")
    out = fields.withColumn("_no", first_by_house("key", rules).cast("int")).join(F.broadcast(table), "_no", "left")

    def of(kinds: str, type_: str) -> Column:
        value = lambda d, rule: EXTRACTORS[d.extractor].build(source_text(rule.get("source", EXTRACTORS[d.extractor].source)), rule)
        return F.coalesce(*[F.when(F.col("_shape") == k, value(d, rule)) for k, d, rule in shapes.values() if d.kind in kinds], F.lit(None).cast(type_))

    kind = F.coalesce(*[F.when(F.col("_shape").isin([k for k, d, _ in shapes.values() if d.kind == kind]), F.lit(kind)) for kind in "samd"], F.lit("s"))
    empty = F.col("_shape").isin([k for k, d, _ in shapes.values() if d.rule.get("on_miss") == "empty"])
    return out.withColumns({"_s": of("s", "string"), "_arr": of("am", "array<string>"), "_kv": of("d", KV), "_kind": kind, "_empty": F.coalesce(empty, F.lit(False))})


def apply_level(fields: DataFrame, level: Sequence[Dispatch]) -> DataFrame:
    """One level of dispatch: the first rule for the field's house whose pattern fits the key extracts; other fields pass through.

    An extractor that returns null leaves the field as it was or, where its rule says ``"on_miss": "empty"``, an empty dictionary.
    """
    if not level:
        return fields
    rows = _ruled(fields, level)
    missed = F.col("_empty") & F.coalesce("_s", F.array_join("_arr", ""), F.when(F.col("_kv").isNotNull(), "")).isNull()
    rows = rows.withColumn("_missed", missed).withColumn("_kv", F.when(F.col("_missed"), F.array().cast(KV)).otherwise(F.col("_kv")))
    changed = F.col("_s").isNotNull() | F.col("_arr").isNotNull() | F.col("_kv").isNotNull()
    kind = F.when(F.col("_missed"), F.lit("d")).when(changed, F.col("_kind")).otherwise(F.col("kind"))
    keep = lambda c: F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return rows.select(*owner(fields), "ord", "key", kind.alias("kind"), keep("s"), keep("arr"), keep("kv"))


def flatten(fields: DataFrame) -> DataFrame:
    """Dictionaries become fields with dotted keys, in place; lists and texts stay."""
    at = F.col("ord") * 1000
    inner = F.transform("kv", lambda x, i: row(at + i, F.concat_ws(".", F.col("key"), x["k"]), "s", x["v"]))
    return each(fields, F.when(F.col("kind") == "d", inner).otherwise(F.array(same_row(at))))


def refine(fields: DataFrame, heads, primary: Sequence[Dispatch], secondary: Sequence[Dispatch], tertiary: Sequence[Dispatch], partitioned: bool = False) -> DataFrame:
    """Three levels: canonical head, primary extraction, key normalisation and suffixes, flattening, then the other levels.

    Each level sees what the one before made; of equal keys the later overwrites. ``heads`` may be by house, as dispatch rules are.
    """
    from .layout import suffix_canonical

    fields = fields if partitioned else fields.repartition("doc_id", "fund")
    plain = fields.withColumn("key", map_header("key", ()))
    rows = apply_level(plain.withColumn("key", F.coalesce(first_by_house("key", heads), F.col("key"))), primary)
    rows = rows.withColumn("kv", F.transform("kv", lambda x: F.struct(normalize_key(x["k"]).alias("k"), x["v"].alias("v"))))
    named = suffix_canonical(rows.withColumnRenamed("key", "header").withColumnRenamed("ord", "section_no"), ["doc_id", "fund"])
    rows = flatten(named.withColumnRenamed("header", "key").withColumnRenamed("section_no", "ord").select(*fields.columns))
    for level in (secondary, tertiary):
        rows = last_per_key(apply_level(rows, level))
    return rows


def special_pass(fields: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """For keys that match a special rule (pattern, new key, extractor, rule, house or none): the value computed for the new key, which replaces one of that name."""
    if not rules:
        return fields
    level = [Dispatch(r[0], r[2], r[3], r[4] if len(r) > 4 else None) for r in rules]
    rows = _ruled(fields, level)
    names = fields.sparkSession.createDataFrame([(no, r[1]) for no, r in enumerate(rules)], "_no int, _new string")
    rows = rows.join(F.broadcast(names), "_no", "left")  # as many rows as rules
    made = row(F.col("ord") + 500_000_000, F.col("_new"), F.col("_kind"), F.col("_s"), F.col("_arr"), F.col("_kv"))
    return last_per_key(emit(rows, same_row(), made, F.col("_no").isNotNull()))


RULE_ROWS = "amc_key string, rule_table string, priority int, name string, pattern string, vintage string"


def rule_rows(spark, amc_key: str, table: str, rules: Sequence[tuple[str, ...]], vintage: str = "current") -> DataFrame:
    """A rule block as long rows; the order of the block is the priority."""
    return spark.createDataFrame([(amc_key, table, k, *map(str, r[:2]), vintage) for k, r in enumerate(rules)], RULE_ROWS)


def read_rules(spark, path: str) -> DataFrame:
    """Rule files, JSON lines ``{amc_key, vintage, rules: {table: [[name, pattern], ...]}}``, as long rows."""
    blocks = spark.read.schema("amc_key string, vintage string, rules map<string, array<array<string>>>").json(path)
    rows = blocks.select("amc_key", F.coalesce("vintage", F.lit("current")).alias("vintage"), F.explode("rules").alias("rule_table", "block"))
    rows = rows.select("amc_key", "rule_table", "vintage", F.posexplode("block").alias("priority", "r"))
    return rows.select("amc_key", "rule_table", "priority", F.get("r", F.lit(0)).alias("name"), F.get("r", F.lit(1)).alias("pattern"), "vintage")


def rule_book(rules: DataFrame, vintage: str = "current") -> dict[str, Houses]:
    """All tables of all houses' rules, of the vintage, or else of ``current`` where a house's table has none of it: {table: {amc_key: [(name, pattern)]}}.

    One pass. Rules make the plan, so they come to the driver: a few hundred short rows a house.
    """
    found: dict[str, dict[str, dict[str, list]]] = {}
    for r in rules.where(F.col("vintage").isin(vintage, "current")).collect():
        found.setdefault(r["rule_table"], {}).setdefault(r["amc_key"], {}).setdefault(r["vintage"], []).append((r["priority"], r["name"], r["pattern"]))
    own = lambda by: [x[1:] for x in sorted(by.get(vintage) or by["current"])]
    return {table: Houses({h: own(by) for h, by in sorted(houses_.items())}) for table, houses_ in found.items()}


def dated_rule_book(rules: DataFrame) -> dict[str, Houses]:
    """The rules of all vintages in one book, by ``house@vintage``; a table that a vintage lacks is the house's ``current`` one."""
    found: dict[tuple[str, str], dict[str, list]] = {}
    for r in rules.collect():  # as in rule_book
        found.setdefault((r["amc_key"], r["vintage"]), {}).setdefault(r["rule_table"], []).append((r["priority"], r["name"], r["pattern"]))
    book: dict[str, Houses] = {}
    for (house, vintage), own in sorted(found.items()):
        for table, block in {**found.get((house, "current"), {}), **own}.items():
            book.setdefault(table, Houses())[f"{house}@{vintage}"] = [x[1:] for x in sorted(block)]
    return book


def with_vintage(documents: DataFrame, vintages: DataFrame, date: str = "doc_date") -> DataFrame:
    """``documents(doc_id, amc_key, date)`` with the key ``house@vintage``: the house's last vintage that is valid at the document's date, else ``current``; for :func:`dated_rule_book`.

    ``vintages(amc_key, vintage, valid_from)`` has a few rows a house, which are gathered for each house before the join. A null date is ``current``.
    """
    of_house_ = vintages.groupBy("amc_key").agg(F.array_sort(F.collect_list(F.struct("valid_from", "vintage"))).alias("_all"))
    last = F.try_element_at(F.filter("_all", lambda v: v["valid_from"] <= F.col(date)), F.lit(-1))["vintage"]
    dated = documents.join(of_house_, "amc_key", "left").withColumn("amc_key", F.concat_ws("@", "amc_key", F.coalesce(last, F.lit("current"))))
    return dated.select(*documents.columns)


def houses(rules: DataFrame | dict[str, Houses], table: str, vintage: str = "current") -> Houses:
    """One table of a rule book, or of rule rows."""
    return (rules if isinstance(rules, dict) else rule_book(rules.where(F.col("rule_table") == table), vintage)).get(table, Houses())


def dispatches(rules: DataFrame | dict[str, Houses], level: str, vintage: str = "current") -> list[Dispatch]:
    """Dispatch rules of all houses: in rows of table ``level`` the name is the key's pattern and the pattern JSON ``{extractor, ...rule}``."""
    out = []
    for house, own in houses(rules, level, vintage).items():
        for key_pattern, text in own:
            rule = json.loads(text)
            out.append(Dispatch(key_pattern, rule.pop("extractor"), rule, house))
    return out


def with_house(fields: DataFrame, documents: DataFrame) -> DataFrame:
    """Fields with the ``amc_key`` of their document; documents without a house are skipped. ``documents(doc_id, amc_key)``.

    The documents grow with the fields. By the size of compressed files Spark may take a million of them for a small table and send them all through the driver, so the join is by sorting.
    """
    return fields.join(documents.where("amc_key is not null").select("doc_id", "amc_key").hint("merge"), "doc_id")


def skipped(houses_: DataFrame, known: DataFrame, key: str = "amc_key") -> DataFrame:
    """Houses that a run asks for and no rules or parameters are known of."""
    return houses_.join(known.select(key).distinct(), key, "left_anti")


def lookup(rows: DataFrame, params: DataFrame, key: str = "amc_key") -> DataFrame:
    """Rows with the parameters of their house; rows of a house without any are skipped. A few parameters a house, so the join is Spark's to choose."""
    return rows.join(params, key)
