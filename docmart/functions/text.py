r"""Scalar normalisation of text, dates, numbers and people, as column expressions.

All are null-safe: a null stays null.  ``\w``, ``\s`` and ``\b`` are Unicode-aware
through ``(?U)``; patterns are literals, so they are compiled once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: All characters that ``\s`` matches under ``(?U)``.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(_c(c), F.lit(WHITE))


def normalize_whitespace(c) -> Column:
    return strip(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def _only(c, allowed: str) -> Column:
    """Other characters to a blank, blanks collapsed, lower case."""
    return F.lower(normalize_whitespace(F.regexp_replace(_c(c), f"[^{allowed}]+", " ")))


def normalize_alphanumeric(c) -> Column:
    return _only(c, "a-zA-Z0-9")


def normalize_alpha(c) -> Column:
    return _only(c, "a-zA-Z")


def normalize_numeric(c) -> Column:
    return _only(c, r"0-9\.")


def normalize_alphanumeric_keep(c, keep: str = "") -> Column:
    """Letters, digits and the characters of ``keep``."""
    return _only(c, "".join(f"\\{k}" if not k.isalnum() else k for k in keep) + "a-zA-Z0-9")


def normalize_alphanumeric_percent(c) -> Column:
    """Characters other than letters, digits, percent signs and white space vanish."""
    return F.lower(normalize_whitespace(F.regexp_replace(_c(c), r"(?U)[^A-Za-z0-9%\s]+", "")))


def normalize_key(c) -> Column:
    """Keep word characters, dots and blanks; runs of blanks become underscores; lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(_c(c), r"(?U)[^\w\s.]", ""), r"(?U)\s+", "_"))


def key_to_alnum_underscore(c) -> Column:
    spaced = F.regexp_replace(F.lower(strip(c)), r"(?U)\W", "_")
    return F.regexp_replace(F.regexp_replace(spaced, "__+", "_"), "^_+|_+$", "")


def remove_non_word_space(c) -> Column:
    return strip(F.regexp_replace(_c(c), r"(?U)[^\w\s]", ""))


def clean_leading_noise(c) -> Column:
    return strip(F.regexp_replace(_c(c), r"(?U)^[\s\\:;\-–—•|]+", ""))


def clean_leading_specials(c) -> Column:
    return F.regexp_replace(_c(c), r"(?U)^[\s:*\-.,]+", "")


def normalize_date(c) -> Column:
    """Keep letters, digits and date separators."""
    return normalize_whitespace(F.regexp_replace(_c(c), r"(?U)[^A-Za-z0-9\s./,\-\\]+", " "))


#: Tried in this order; day before month.
DATE_FORMATS = ("d MMMM yyyy", "d MMM yyyy", "d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d-MMM-yyyy", "yyyyMMdd", "yyyy-MM-dd")


def parse_date(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A date, or null where no format fits; ordinal endings of days are dropped."""
    cleaned = F.regexp_replace(normalize_date(c), r"(?i)\b(\d{1,2})\s?(?:st|nd|rd|th)\b", "$1")
    return F.coalesce(*[F.try_to_timestamp(cleaned, F.lit(f)) for f in formats]).cast("date")


def date_to_yyyymmdd(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date as yyyyMMdd; what cannot be read stays as it is."""
    return F.coalesce(F.date_format(parse_date(c, formats), "yyyyMMdd"), _c(c))


def previous_month_end(d) -> Column:
    return F.date_format(F.last_day(F.add_months(_c(d), -1)), "yyyyMMdd")


def clean_currency(c) -> Column:
    return F.regexp_replace(_c(c), r"[^0-9.,a-zA-Z ]+", "")


def remove_duplicate_words(c) -> Column:
    """Lower-cased words without later repeats, order kept."""
    return F.array_join(F.array_distinct(F.transform(F.split(F.lower(_c(c)), " "), strip)), " ")


def title_case(c) -> Column:
    """Every run of letters begins with a capital, after apostrophes and hyphens too."""
    parts = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(0))
    return F.array_join(F.transform(parts, F.initcap), "")


def rgb(c) -> Column:
    """A colour integer as fractions of red, green and blue."""
    c = _c(c)
    part = lambda bits: F.shiftright(c, bits).bitwiseAND(F.lit(255)) / F.lit(255.0)
    return F.struct(part(16).alias("r"), part(8).alias("g"), part(0).alias("b"))


#: Steps of a cell pipeline, by name.
CELL_STEPS = {
    "newline_to_space": lambda c: F.regexp_replace(c, r"[\r\n]+", " "),
    "collapse": lambda c: F.regexp_replace(c, r"(?U)\s+", " "),
    "strip": strip,
    "lower": F.lower,
    "blank_to_null": lambda c: F.when(strip(c) != "", c),
    "null_to_blank": lambda c: F.coalesce(c, F.lit("")),
}


def cell_pipeline(c, steps: Sequence[str]) -> Column:
    return reduce(lambda acc, step: CELL_STEPS[step](acc), steps, _c(c))


def is_etf(fund) -> Column:
    return _c(fund).rlike(r"(?i)\betf\b")


def clean_amount(fund, value) -> Column:
    """Null for exchange-traded funds; else without commas, blanks and dots, unless nothing would be left."""
    cleaned = F.regexp_replace(_c(value), r"(?U)[,\s.]+", "")
    return F.when(is_etf(fund), F.lit(None)).otherwise(F.when(cleaned != "", cleaned).otherwise(_c(value)))


def clean_amount_any(value) -> Column:
    """The scheme-document variant: the word "any" goes too, and there is no rule for exchange-traded funds."""
    cleaned = F.regexp_replace(_c(value), r"(?iU)any|[,\s.]+", "")
    return F.when(cleaned != "", cleaned).otherwise(_c(value))


NUMERIC = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)$"


def is_numeric(c) -> Column:
    return _c(c).rlike(NUMERIC)


def is_alphanumeric(c) -> Column:
    return _c(c).rlike("^[A-Za-z0-9]+$")


def is_alpha(c) -> Column:
    return _c(c).rlike("^[A-Za-z]+$")


def metric_suspect(name, value) -> Column:
    """Why a metric's cleaned value should not be trusted, null if nothing speaks against it.

    A duration of several numbers is read as one number and a minus sign is lost; other values may be no numbers at all.
    """
    name, v = _c(name), strip(value)
    duration = name.isin("avg_maturity", "macaulay", "mod_duration")
    numbers = F.regexp_count(v, F.lit(r"\d+(?:\.\d+)?"))
    bare = strip(F.regexp_replace(v, r"(?i)%+$|times?$", ""))
    return (
        F.when(v.rlike("(?i)^NA$") | (v == ""), F.lit(None))
        .when(duration & (numbers > 1), "several numbers")
        .when(duration & v.startswith("-"), "sign lost")
        .when(duration & (numbers == 0), "no number")
        .when(~duration & ~is_numeric(bare), "no number")
    )


def clean_metric(fund, name, value, turnover_as_is: str = "(?!)") -> Column:
    """A metric's value by its name; null where the value means "not available".

    Turnover ratios in times or as bare numbers become whole percents (funds that
    match ``turnover_as_is`` keep theirs); percent signs go; durations become
    years, from days, months or years in that order.  All digits of a duration are
    read as one number.
    """
    fund, name = _c(fund), _c(name)

    def cleaned(v: Column) -> Column:
        hundredfold = lambda x: (F.expr("try_cast(null as double)") if x is None else x.try_cast("double") * 100).cast("bigint").cast("string")
        times = strip(F.regexp_replace(v, "(?i)times?$", ""))
        turnover = (
            F.when(fund.rlike(f"(?i){turnover_as_is}"), v)
            .when(v.rlike("(?i)times?$"), F.when(is_numeric(times), hundredfold(times)).otherwise(times))
            .when(v.endswith("%"), strip(F.regexp_replace(v, "%+$", "")))
            .when(is_numeric(v), hundredfold(v))
            .otherwise(v)
        )
        percent = F.when(v.endswith("%"), strip(F.regexp_replace(v, "%+$", ""))).otherwise(v)
        divide = F.when(v.rlike("(?i)day"), 365).when(v.rlike("(?i)month"), 12).otherwise(1)
        digits = F.regexp_replace(v, "[^0-9.]+", "")
        duration = F.when(is_numeric(digits), F.round(digits.try_cast("double") / divide, 4).cast("string")).otherwise(digits)
        out = F.when(name == "port_turnover_ratio", turnover).when(name.isin("std_dev", "ytm", "tracking_error"), percent).when(name.isin("avg_maturity", "macaulay", "mod_duration"), duration).otherwise(v)
        return out

    return let(let(strip(value), cleaned), lambda out: F.when(~strip(out).rlike("(?i)^NA$"), out))


def clean_manager_name(c, stop_words: str = r"\b(?:mr|mrs|ms|dr|shri|smt)\b\.?") -> Column:
    """A name of letters only, without stop words and repeats, in title case; null if under 3 letters."""
    name = title_case(remove_duplicate_words(normalize_alpha(F.regexp_replace(_c(c), f"(?i){stop_words}", " "))))
    return F.when(F.length(name) >= 3, name)
