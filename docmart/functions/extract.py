"""Extractors: from a section's text to values, as column expressions.

A rule's pattern is a literal or, where rules stand in a table, a :class:`Pattern` column;
the number of its groups is known when the plan is made and picks the branch.  Key/value results are arrays of (k, v) structs: order
and repeated keys matter, which a map would lose.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, let, strip, title_case

KV = "array<struct<k:string,v:string>>"


@dataclass(frozen=True)
class Pattern:
    """A pattern that stands in a column, and how many groups it has."""

    column: Column
    n_groups: int = 0


def regex(*parts: str | Pattern) -> Column:
    """A pattern of literal and column parts."""
    if not any(isinstance(p, Pattern) for p in parts):
        return F.lit("".join(parts))
    columns = [p.column if isinstance(p, Pattern) else F.lit(p) for p in parts if p != ""]
    return columns[0] if len(columns) == 1 else F.concat(*columns)


def joined(c, escape: str | Pattern | None = None) -> Column:
    """A text without what ``escape`` matches, stripped."""
    text = _c(c)
    return strip(F.regexp_replace(text, regex(escape), F.lit(""))) if escape else text


def join_list(lines: Column) -> Column:
    """A list of lines as one text, a blank between."""
    return F.array_join(lines, " ")


def find_all(text: Column, pattern: str | Pattern, group: int | None = None, ignore_case: bool = True) -> Column:
    """All matches, case aside: the only group if there is one, else the whole match."""
    if group is None:
        group = 1 if groups(pattern) == 1 else 0
    return F.regexp_extract_all(text, regex("(?iu)" * ignore_case, pattern), F.lit(group))


def _python(pattern: str) -> str:
    """The pattern as Python reads it, to count its groups."""
    return re.sub(r"\(\?[iuUsm]+\)", "", pattern).replace(r"\p{L}", "A").replace(r"\p{N}", "0")


def groups(pattern: str | Pattern) -> int:
    if isinstance(pattern, Pattern):
        return pattern.n_groups
    return re.compile(_python(pattern)).groups


def pairs(keys: Column, values: Column) -> Column:
    """(k, v) structs of two arrays, cut to the shorter."""
    zipped = F.arrays_zip(keys.alias("k"), values.alias("v"))
    whole = F.filter(zipped, lambda x: x["k"].isNotNull() & x["v"].isNotNull())
    return F.transform(whole, lambda x: F.struct(strip(x["k"]).alias("k"), strip(x["v"]).alias("v")))


def _first_wins(kv: Column) -> Column:
    return F.filter(kv, lambda x, i: ~F.exists(F.slice(kv, F.lit(1), i), lambda y: y["k"] == x["k"]))


def first_wins(kv: Column) -> Column:
    """Keep the first pair of each key, in order."""
    return let(kv, _first_wins)


def last_wins(kv: Column) -> Column:
    """Each key at its first place, with its last value."""
    def use(all_: Column) -> Column:
        last = lambda x: F.element_at(F.filter(all_, lambda y: y["k"] == x["k"]), -1)["v"]
        return F.transform(_first_wins(all_), lambda x: F.struct(x["k"].alias("k"), last(x).alias("v")))

    return let(kv, use)


def kv_get(kv: Column, key: str) -> Column:
    return F.get(F.filter(kv, lambda x: x["k"] == key), F.lit(0))["v"]


def keyword_spans(c, keywords: Sequence[str], escape: str | None = None, ignore_case: bool = False) -> Column:
    """For consecutive keywords: the text between one and the next (or the end); a key's first occurrence wins."""
    text = joined(c, escape)
    flags = "(?isu)" if ignore_case else "(?s)"

    def span(start: str | Pattern, end: str | Pattern) -> Column:
        # one scan finds the spans, and each span is then read by itself
        found = F.regexp_extract_all(text, regex(rf"{flags}(\b", start, r"\b)\s*(.*?)\s*(?:\b", end, r"\b|$)"), F.lit(0))
        whole = regex(rf"{flags}^(\b", start, r"\b)\s*(.*?)\s*(?:\b", end, r"\b)?$")
        part = lambda x, g: F.call_function("regexp_extract", x, whole, F.lit(g))
        return F.transform(found, lambda x: F.struct(strip(F.lower(part(x, 1))).alias("k"), strip(part(x, 2)).alias("v")))

    return first_wins(F.flatten(F.array(*[span(a, b) for a, b in zip(keywords, keywords[1:], strict=False)])))


def first_match(c, pattern: str, otherwise: Column | None = None, escape: str | None = None) -> Column:
    """The first match, else ``otherwise`` (an empty string by default)."""
    return F.coalesce(F.get(find_all(joined(c, escape), pattern), F.lit(0)), F.lit("") if otherwise is None else otherwise)


def generic_text(c, pattern: str, escape: str | None = None, full_on_miss: bool = False) -> Column:
    """For patterns of at most one group: the first match; a miss gives null or, with ``full_on_miss``, the cleaned text."""
    text = joined(c, escape)
    return F.coalesce(F.get(find_all(text, pattern), F.lit(0)), text if full_on_miss else F.lit(None).cast("string"))


def generic_pairs(c, pattern: str, escape: str | None = None) -> Column:
    """For patterns of two groups or more: {group 1: group 2} of all matches, a later key wins."""
    text = joined(c, escape)
    return last_wins(pairs(find_all(text, pattern, 1), find_all(text, pattern, 2)))


def without_blanks(c) -> Column:
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def metric_zip(c, key: str, value: str, escape: str | None = None, first: bool = True) -> Column:
    """The k-th key match with the k-th value match."""
    text = joined(c, escape)
    kv = pairs(find_all(text, key, 0), find_all(text, value, 0))
    return first_wins(kv) if first else last_wins(kv)


def positional_pairs(c, key: str, value: str, escape: str | None = None, skip_repeats: bool = True) -> Column:
    """Each key takes the first unused value located after it; a repeated key takes none.

    One pass over the alternation of keys and values in text order: keys wait in a queue,
    a value goes to the key at its head, and a value that no key waits for is dropped.
    """
    text = joined(c, escape)
    both = regex("(?iu)((?i:", key, "))|(", value, ")")
    find = lambda g: F.regexp_extract_all(text, both, F.lit(g))
    tokens = F.arrays_zip(find(1).alias("k"), find(2).alias("v"))
    start = F.struct(F.array().cast("array<string>").alias("wait"), F.array().cast("array<string>").alias("seen"), F.array().cast(KV).alias("out"))

    def step(acc, t):
        k, waiting = strip(t["k"]), acc["wait"]
        known = F.array_contains(acc["seen"], k) if skip_repeats else F.lit(False)
        on_key = F.struct(F.when(known, waiting).otherwise(F.array_append(waiting, k)).alias("wait"), F.array_append(acc["seen"], k).alias("seen"), acc["out"].alias("out"))
        took = F.struct(F.get(waiting, F.lit(0)).alias("k"), strip(t["v"]).alias("v"))
        on_value = F.struct(F.slice(waiting, 2, F.greatest(F.size(waiting), F.lit(1))).alias("wait"), acc["seen"].alias("seen"), F.array_append(acc["out"], took).alias("out"))
        return F.when(t["k"] != "", on_key).when(F.size(waiting) > 0, on_value).otherwise(acc)

    return F.aggregate(tokens, start, step, lambda acc: acc["out"])


def load_pair(c, pattern: str) -> Column:
    """{entry_load, exit_load} of the last match, else empty."""
    last = lambda g: F.coalesce(F.try_element_at(find_all(_c(c), pattern, g), F.lit(-1)), F.lit(""))
    return F.array(*[F.struct(F.lit(k).alias("k"), strip(last(g)).alias("v")) for g, k in ((1, "entry_load"), (2, "exit_load"))])


def amount_pair(c, pattern: str, escape: str | None = None) -> Column:
    """{amt, thraftr} of the first match, else empty."""
    first = lambda g: F.coalesce(F.get(find_all(joined(c, escape), pattern, g), F.lit(0)), F.lit(""))
    return F.array(*[F.struct(F.lit(k).alias("k"), strip(first(g)).alias("v")) for g, k in ((1, "amt"), (2, "thraftr"))])


def lump_pair(c, pattern: str, escape: str | None = None) -> Column:
    """{min_amt, add_amt} of the last match with a group that is not blank, else empty."""
    text = joined(c, escape)
    rows = F.filter(F.arrays_zip(find_all(text, pattern, 1).alias("a"), find_all(text, pattern, 2).alias("b")), lambda x: F.trim(F.concat(x["a"], x["b"])) != "")
    got = F.try_element_at(rows, F.lit(-1))
    return F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(got[g], F.lit("")).alias("v")) for g, k in (("a", "min_amt"), ("b", "add_amt"))])


MANAGER = ("managing_fund_since", "name", "qualification", "total_exp")


def managers(c, pattern: str, fields: Sequence[str], escape: str | None = None) -> Column:
    """Every match as a manager; ``fields`` names the groups, missing attributes are empty, all in title case."""
    text = joined(c, escape)
    found = {f: find_all(text, pattern, g + 1 if groups(pattern) else 0) for g, f in enumerate(fields)}
    zipped = F.arrays_zip(*[v.alias(k) for k, v in found.items()])
    return F.transform(zipped, lambda x: F.struct(*[(title_case(strip(x[a])) if a in found else F.lit("")).alias(a) for a in MANAGER]))


def managers_from_rows(rows: Column, patterns: dict[str, str]) -> Column:
    """Managers from table rows (structs of texts): per column, all matches joined by a blank; rows without a name go."""
    one = lambda x, a: F.array_join(find_all(x[a], patterns[a], 0), " ") if a in patterns else F.lit("")
    return F.filter(F.transform(rows, lambda x: F.struct(*[one(x, a).alias(a) for a in MANAGER])), lambda m: m["name"] != "")


def date_from_key(key, pattern: str) -> Column:
    """All matches in the key, joined by a blank."""
    return F.array_join(find_all(_c(key), pattern), " ")


ASSET = ("instrument_type", "min", "max", "total", "risk_profile")


def asset_rows(c, pattern: str, order: Sequence[str]) -> Column:
    """Every match as an allocation row; ``order`` names the groups."""
    found = {f: find_all(_c(c), pattern, g + 1) for g, f in enumerate(order)}
    return F.transform(F.arrays_zip(*[v.alias(k) for k, v in found.items()]), lambda x: F.struct(*[(strip(x[a]) if a in found else F.lit("")).alias(a) for a in ASSET]))


def restructure_assets(rows: Column) -> Column:
    """min, max and total of a row become its ``allocation`` list."""
    allocation = lambda x: F.array(*[F.struct(F.lit(t).alias("type"), x[t].alias("value")) for t in ("min", "max", "total")])
    return F.transform(rows, lambda x: F.struct(allocation(x).alias("allocation"), x["instrument_type"].alias("instrument_type"), x["risk_profile"].alias("risk_profile")))


def zip_people(names: Column, since: Column, exp: Column, how: str = "pad") -> Column:
    """Managers from three lists: short lists are padded with '', all cut to the shortest, or the last element repeats."""
    if how == "cut":
        n = F.least(F.size(names), F.size(since), F.size(exp))
    else:
        n = F.size(names)
    item = lambda a, i: F.coalesce(F.get(a, i), F.try_element_at(a, F.lit(-1)) if how == "repeat" else F.lit(""), F.lit(""))
    index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(index, lambda i: F.struct(item(since, i).alias("managing_fund_since"), F.get(names, i).alias("name"), F.lit("").alias("qualification"), item(exp, i).alias("total_exp")))


def benchmark(c, pattern: str, remove: str | None = None, repair: Sequence[tuple[str, str]] = ((r"Ni\s*y", "Nifty"),), else_text: bool = False) -> Column:
    """A benchmark name: repair scanning errors, remove a pattern, then the first match (or the text)."""
    text = _c(c)
    for bad, good in repair:
        text = F.regexp_replace(text, f"(?i){bad}", good)
    if remove:
        text = F.regexp_replace(text, regex("(?iu)", remove), F.lit(""))
    return first_match(text, pattern, otherwise=text if else_text else None)


def people(c, name: str, since: str, exp: str, how: str = "pad", escape: str | None = None) -> Column:
    """Managers from the matches of three patterns, zipped as ``how`` says (:func:`zip_people`)."""
    text = joined(c, escape)
    return zip_people(*[find_all(text, p) for p in (name, since, exp)], how)


def dated_people(c, name: str, date: str, year: str, exp: str, escape: str | None = None) -> Column:
    """Managers from one text whose names, dates, years and experience are listed apart: all lists are cut to the years of experience, then to the shortest; "date, year" is since when."""
    text = joined(c, escape)
    found = {k: find_all(text, p) for k, p in (("exp", exp), ("name", name), ("date", date), ("year", year))}

    def use(x: Column) -> Column:
        n = F.least(*[F.size(x[k]) for k in found])
        person = lambda i: F.struct(F.concat_ws(", ", F.get(x["date"], i), F.get(x["year"], i)).alias("managing_fund_since"), F.get(x["name"], i).alias("name"), F.lit("").alias("qualification"), F.concat(F.get(x["exp"], i), F.lit(" years")).alias("total_exp"))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), person)

    return let(F.struct(*[v.alias(k) for k, v in found.items()]), use)


def as_json(rows: Column) -> Column:
    """A list of structs as a list of texts, for a field of kind ``m``."""
    return F.transform(rows, lambda x: F.to_json(x))


@dataclass(frozen=True)
class Extractor:
    """``build(text, rule)`` makes a column when the plan is made; ``kind`` says what it returns.

    Kinds: ``s`` a text, ``a`` a list of texts, ``d`` an array of (k, v), ``m`` a list of JSON texts. ``source`` is what it reads: the value
    as ``text``, the ``key``, ``both``, or a dictionary's ``values``; a rule's own ``source`` comes first.
    """

    build: Callable[[Column, dict], Column]
    kind: str | Callable[[dict], str] = "s"
    source: str = "text"
    #: Whether patterns may come as :class:`Pattern` columns. If not, every rule is a part of the plan.
    columns: bool = True

    def kind_of(self, rule: dict) -> str:
        return self.kind(rule) if callable(self.kind) else self.kind


def _generic(c: Column, rule: dict) -> Column:
    if groups(rule["pattern"]) >= 2:
        return generic_pairs(c, rule["pattern"], rule.get("escape"))
    return generic_text(c, rule["pattern"], rule.get("escape"), rule.get("full_on_miss", False))


#: Extractors by name. ``register_extractor`` adds one.
EXTRACTORS: dict[str, Extractor] = {
    "identity": Extractor(lambda c, rule: c),
    "join": Extractor(lambda c, rule: joined(c, rule.get("escape"))),
    "text": Extractor(lambda c, rule: generic_text(c, rule["pattern"], rule.get("escape"), rule.get("full_on_miss", True))),
    "pairs": Extractor(lambda c, rule: generic_pairs(c, rule["pattern"], rule.get("escape")), "d"),
    "generic": Extractor(_generic, lambda rule: "d" if groups(rule["pattern"]) >= 2 else "s"),
    "no_blanks": Extractor(lambda c, rule: _generic(without_blanks(c), rule), lambda rule: "d" if groups(rule["pattern"]) >= 2 else "s"),
    "first_or_text": Extractor(lambda c, rule: first_match(c, rule["pattern"], otherwise=joined(c, rule.get("escape")), escape=rule.get("escape"))),
    "first": Extractor(lambda c, rule: first_match(c, rule["pattern"], escape=rule.get("escape"))),
    "scheme": Extractor(lambda c, rule: keyword_spans(c, rule["keywords"], rule.get("escape"), rule.get("ignore_case", False)), "d"),
    "amount": Extractor(lambda c, rule: amount_pair(c, rule["pattern"], rule.get("escape")), "d"),
    "load": Extractor(lambda c, rule: load_pair(c, rule["pattern"]), "d"),
    "lump": Extractor(lambda c, rule: lump_pair(c, rule["pattern"], rule.get("escape")), "d"),
    "metrics": Extractor(lambda c, rule: metric_zip(c, rule["key"], rule["value"], rule.get("escape"), rule.get("first", True)), "d"),
    "aligned": Extractor(lambda c, rule: positional_pairs(c, rule["key"], rule["value"], rule.get("escape"), rule.get("skip_repeats", True)), "d"),
    "managers": Extractor(lambda c, rule: as_json(managers(c, rule["pattern"], rule["fields"], rule.get("escape"))), "m"),
    "people": Extractor(lambda c, rule: as_json(people(c, rule["name"], rule["since"], rule["exp"], rule.get("how", "pad"), rule.get("escape"))), "m"),
    "dated_people": Extractor(lambda c, rule: as_json(dated_people(c, rule["name"], rule["date"], rule["year"], rule["exp"], rule.get("escape"))), "m"),
    "assets": Extractor(lambda c, rule: as_json(restructure_assets(asset_rows(c, rule["pattern"], rule["order"]))), "m"),
    "benchmark": Extractor(lambda c, rule: benchmark(c, rule["pattern"], rule.get("remove"), else_text=rule.get("else_text", False))),
    "date": Extractor(lambda c, rule: F.array(F.struct(F.lit("inception_date").alias("k"), date_from_key(c, rule["pattern"]).alias("v"))), "d", "key"),
}


def register_extractor(name: str, build: Callable[[Column, dict], Column], kind: str | Callable[[dict], str] = "s", source: str = "text") -> None:
    """Make an extractor available to dispatch rules; it builds a column of the given kind when the plan is made."""
    EXTRACTORS[name] = Extractor(build, kind, source, columns=False)


def register_pandas_extractor(name: str, fn: Callable, kind: str = "s") -> None:
    """Make ``fn(text: Series, rule: Series) -> Series`` an extractor: Arrow batches of values, and the rule as JSON beside each."""
    udf = F.pandas_udf(fn, {"s": "string", "a": "array<string>", "d": KV, "m": "array<string>"}[kind])
    register_extractor(name, lambda c, rule: udf(c, F.lit(json.dumps(rule))), kind)
