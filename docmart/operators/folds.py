"""Rules folded over one ordered array of fields per fund.

A fund has some dozens of fields.  They are gathered once, and every rule is an expression from array to
array, so a chain of rules is one grouping and some projections: no window, sort or exchange for a rule.
A step takes the name of the array column and returns the new array; :func:`fold` puts steps one after another.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extract import KV, last_wins
from ..functions.text import let
from .rules import Houses, by_house, in_steps, owner, sql_text

FIELD = ("ord", "key", "kind", "s", "arr", "kv")
FIELD_ARRAY = f"array<struct<ord:bigint,key:string,kind:string,s:string,arr:array<string>,kv:{KV}>>"
Step = Callable[[Column], Column]


def gathered(fields: DataFrame) -> DataFrame:
    """One row for each fund with ``_f``, its fields in order."""
    item = F.struct(F.col("ord").cast("long").alias("ord"), *FIELD[1:])
    return fields.groupBy(*owner(fields)).agg(F.array_sort(F.collect_list(item)).alias("_f"))


def scattered(funds: DataFrame) -> DataFrame:
    """The field table again. An inner explode would have Spark filter by the array's size below all steps, which would write every step out many times."""
    own = owner(funds)
    return funds.select(*own, F.explode_outer("_f").alias("x")).where("x is not null").select(*own, "x.*")


def fold(fields: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """The field table after all steps."""
    return scattered(folded(gathered(fields), steps))


def folded(funds: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for step in steps:
        funds = funds.withColumn("_f", step(F.col("_f")))
    return funds


def field(ord_, key, kind, s=None, arr=None, kv=None) -> Column:
    """An item of the array."""
    typed = lambda v, t: (F.lit(None) if v is None else v).cast(t)
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(
        ord_.cast("long").alias("ord"), text(key).cast("string").alias("key"), text(kind).alias("kind"), typed(s, "string").alias("s"), typed(arr, "array<string>").alias("arr"), typed(kv, KV).alias("kv")
    )


def with_(x: Column, **changed: Column) -> Column:
    """An item with some parts replaced."""
    return F.struct(*[changed.get(n, x[n]).alias(n) for n in FIELD])


def of_house(step, part: Callable[[object], str]) -> Column:
    """A text of the rule, or of the rule of the row's house; null for a house without one."""
    if not isinstance(step, Houses):
        return F.lit(part(step))
    return F.expr(f"CASE amc_key {' '.join(f'WHEN {sql_text(h)} THEN {sql_text(part(r))}' for h, r in step.items())} END")


def holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def found(x: Column, pattern: Column) -> Column:
    """Whether the item's key holds the pattern; a null pattern is held by none."""
    return holds(F.rlike(x["key"], pattern))


def unique(fields: Column) -> Column:
    """Of items with one key the last."""
    return let(fields, lambda a: F.filter(a, lambda x, i: ~F.exists(F.slice(a, i + 2, F.size(a)), lambda y: y["key"] == x["key"])))


def _none() -> Column:
    return F.array().cast(FIELD_ARRAY)


def cloned(rules) -> list[Step]:
    """A step for each (new key, pattern), see :func:`~docmart.operators.reshape.clone_keys`."""
    def step(no: int, rule) -> Step:
        new, pattern = of_house(rule, lambda r: r[0]), of_house(rule, lambda r: f"^(?:{r[1]})")

        def use(a: Column) -> Column:
            first = F.slice(F.filter(a, lambda x: found(x, pattern)), 1, 1)
            copies = F.transform(first, lambda x: with_(x, ord=x["ord"] + 100_000_000 * (no + 1), key=new))
            return let(copies, lambda c: F.when(F.size(c) > 0, F.concat(F.filter(a, lambda x: x["key"] != new), c)).otherwise(a))

        return use

    return [step(no, r) for no, r in enumerate(in_steps(rules))]


def _one(a: Column, hits: Column, rest: Column, new: Column, lists_only: bool) -> Column:
    """The items ``hits`` as one item ``new`` among the rest; an empty one is not stored."""
    def use(h: Column) -> Column:
        alone = lambda x, v: F.array(F.struct(x["key"].alias("k"), v.alias("v")))
        pairs = F.flatten(F.transform(h, lambda x: F.when(x["kind"] == "d", x["kv"]).when(x["kind"] == "a", alone(x, F.array_join(x["arr"], " "))).otherwise(alone(x, x["s"]))))
        lists = F.flatten(F.transform(h, lambda x: F.coalesce(x["arr"], F.array(x["s"]))))
        as_list = F.lit(True) if lists_only else F.forall(h, lambda x: x["kind"] == "a")
        made = field(
            F.array_min(F.transform(h, lambda x: x["ord"])), new, F.when(as_list, F.lit("a")).otherwise(F.lit("d")), arr=F.when(as_list, lists), kv=F.when(~as_list, last_wins(pairs)) if not lists_only else None
        )
        return let(made, lambda m: F.when(
            F.size(h) == 0, a).when(
            (F.coalesce(F.size(m["arr"]), F.lit(0)) > 0) | (F.coalesce(F.size(m["kv"]), F.lit(0)) > 0), F.array_sort(F.concat(F.filter(rest, lambda x: x["key"] != new), F.array(m)))).otherwise(rest))

    return let(hits, use)


def merged(rules) -> list[Step]:
    """A step for each (new key, patterns), see :func:`~docmart.operators.reshape.merge_keys`."""
    from .predicates import any_of

    def step(rule) -> Step:
        new, pattern = of_house(rule, lambda r: r[0]), of_house(rule, lambda r: f"(?i){any_of(r[1])}")
        return lambda a: _one(a, F.filter(a, lambda x: found(x, pattern)), F.filter(a, lambda x: ~found(x, pattern)), new, lists_only=False)

    return [step(r) for r in in_steps(rules)]


def combined(rules) -> list[Step]:
    """A step for each (new key, keys), see :func:`~docmart.operators.reshape.combine_keys`."""
    def step(rule) -> Step:
        new = of_house(rule, lambda r: r[0])
        keys = by_house(rule, lambda r: F.array(*[F.lit(k) for k in r[1]]))
        place = lambda x: F.coalesce(F.array_position(keys, x["key"]), F.lit(0))

        def use(a: Column) -> Column:
            hits = F.array_sort(F.transform(F.filter(a, lambda x: place(x) > 0), lambda x: F.struct(place(x).alias("o"), x.alias("x"))))
            return _one(a, F.transform(hits, lambda y: y["x"]), F.filter(a, lambda x: place(x) == 0), new, lists_only=True)

        return use

    return [step(r) for r in in_steps(rules)]


def promoted(rules, search: bool = False) -> list[Step]:
    """A step for each (section, new key, pattern), see :func:`~docmart.operators.reshape.promote_keys`."""
    start = "" if search else "^"

    def step(no: int, rule) -> Step:
        section, new, pattern = of_house(rule, lambda r: r[0]), of_house(rule, lambda r: r[1]), of_house(rule, lambda r: f"(?i){start}(?:{r[2]})")
        is_section = lambda x: holds(F.rlike(x["key"], F.concat(F.lit("(?i)"), section)) if search else x["key"] == section) & (x["kind"] == "d")

        def place(x: Column) -> Column:
            return F.when(is_section(x), F.array_position(F.transform(x["kv"], lambda y: F.rlike(y["k"], pattern)), F.lit(True)).cast("int")).otherwise(0)

        def use(a: Column) -> Column:
            placed = F.transform(a, lambda x: F.struct(x.alias("x"), F.coalesce(place(x), F.lit(0)).alias("at")))
            left = lambda b: F.transform(b, lambda y: with_(y["x"], kv=F.when(y["at"] > 0, F.filter(y["x"]["kv"], lambda z, i: i != y["at"] - 1)).otherwise(y["x"]["kv"])))
            moved = lambda b: F.transform(F.filter(b, lambda y: y["at"] > 0), lambda y: field(y["x"]["ord"] + 200_000_000 + no, new, "s", F.element_at(y["x"]["kv"], y["at"])["v"]))
            return let(placed, lambda b: F.when(F.exists(b, lambda y: y["at"] > 0), unique(F.concat(left(b), moved(b)))).otherwise(a))

        return use

    return [step(no, r) for no, r in enumerate(in_steps(rules))]


def selected(patterns) -> Step:
    """Items whose key matches a pattern at its start, case aside."""
    from .predicates import any_of

    pattern = of_house(patterns, lambda p: f"(?i)^{any_of(p)}")
    return lambda a: F.filter(a, lambda x: found(x, pattern))


def deleted(patterns) -> Step:
    from .predicates import any_of

    pattern = of_house(patterns, lambda p: f"(?i){any_of(p)}")
    return lambda a: F.filter(a, lambda x: ~found(x, pattern))


def mapped(keys) -> Step:
    """Keys by their map, the last item of a key stays."""
    from .rules import first_by_house_sql

    name = first_by_house_sql("x.key", keys, ignore_case=False)
    return lambda a: unique(F.expr(f"transform(_f, x -> named_struct('ord', x.ord, 'key', coalesce({name}, x.key), 'kind', x.kind, 's', x.s, 'arr', x.arr, 'kv', x.kv))"))


def each_item(change: Callable[[Column], Column]) -> Step:
    return lambda a: F.transform(a, change)


def amounts_split(keys: Sequence[str]) -> Step:
    from ..functions.extract import kv_get

    def rows(x: Column) -> Column:
        get = lambda k: F.coalesce(kv_get(x["kv"], k), F.lit(""))
        two = F.array(field(x["ord"], x["key"], "s", get("amt")), field(x["ord"] + 1, F.concat(x["key"], F.lit("_multiple")), "s", get("thraftr")))
        return F.when(x["key"].isin(*keys) & (x["kind"] == "d"), two).otherwise(F.array(with_(x)))

    return lambda a: F.flatten(F.transform(a, rows))


def added(constants) -> Step:
    """Constants, texts or columns, after the other items, replacing those of their names; ``{key: value}``, or that by house."""
    want = by_house(constants, lambda c: F.array(*[field(F.lit(900_000_000 + i), k, "s", F.lit(v)) for i, (k, v) in enumerate(c.items())]))
    return lambda a: unique(F.concat(a, F.coalesce(want, _none())))


def defaulted(defaults) -> Step:
    """Every expected key that is not there, with its default."""
    want = by_house(defaults, lambda d: F.array(*[field(F.lit(950_000_000), k, "s", F.lit(v)) for k, v in sorted(d.items())]))
    return lambda a: F.concat(a, F.filter(F.coalesce(want, _none()), lambda x: ~F.exists(a, lambda y: y["key"] == x["key"])))


def people_zipped(new: str, keys: dict[str, str], patterns: dict[str, str], how: str = "pad") -> Step:
    """Managers whose names, dates and experience stand in fields of different keys, zipped by position (:func:`~docmart.functions.extract.zip_people`) into a field ``new``.

    ``keys`` and ``patterns`` are for ``name``, ``since`` and ``exp``: which keys hold the list, searched case aside, and what is taken from the text. A key that fits an earlier
    part is not looked at for a later one; of several fields for a part the last counts. A fund without any of the fields stays as it is.
    """
    from ..functions.extract import as_json, find_all, zip_people

    parts = ("name", "since", "exp")

    def use(a: Column) -> Column:
        part = lambda x: F.coalesce(*[F.when(found(x, F.lit(f"(?i){keys[p]}")), F.lit(p)) for p in parts])
        text = lambda x: F.when(x["kind"] == "a", F.array_join(x["arr"], " ")).otherwise(x["s"])
        of = F.transform(F.filter(a, lambda x: part(x).isNotNull()), lambda x: F.struct(part(x).alias("p"), text(x).alias("t"), x["ord"].alias("ord")))

        def made(b: Column) -> Column:
            last = lambda p: F.try_element_at(F.filter(b, lambda y: y["p"] == p), F.lit(-1))["t"]
            lists = [F.coalesce(find_all(last(p), patterns[p]), F.array().cast("array<string>")) for p in parts]
            one = field(F.array_max(F.transform(b, lambda y: y["ord"])), new, "m", arr=as_json(zip_people(*lists, how)))
            return F.when(F.size(b) > 0, unique(F.concat(a, F.array(one)))).otherwise(a)

        return let(of, made)

    return use
