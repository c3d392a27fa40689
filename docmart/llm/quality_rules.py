"""Operator 4: quality rules as a short-circuit cascade.

Each rule says which documents it rejects.  Its cost and its selectivity are
measured on a sample in the cluster's own tasks; rules then run in order of
rejections per second, each on what all before it left.  What an earlier rule has counted
goes along, so a later one does not count it again.  The order changes the
work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import batch

SYMBOL = K.byte_class([(ord(c), ord(c)) for c in "#*$%&|<>"])
UPPER, DIGIT = K.byte_class([(0x41, 0x5A)]), K.byte_class([(0x30, 0x39)])
LETTER = UPPER | K.byte_class([(0x61, 0x7A), (0x80, 0xFF)])


class Facts:
    """What the rules look at, for all documents of a slice; each is computed when first asked for."""

    #: Figures by document.
    COUNTS = ("n_words", "word_chars", "n_symbols", "n_upper", "n_letters", "n_digits", "n_lines", "n_dup_lines", "n_repeat_words")

    def __init__(self, s: K.Slice, keep: np.ndarray | None = None):
        self._of, self._keep = s, keep

    @cached_property
    def slice(self) -> K.Slice:
        return self._of if self._keep is None or self._keep.all() else subset(self._of, self._keep)

    def only(self, keep: np.ndarray) -> Facts:
        """The facts of some documents; what was counted stays, and no text is copied before a rule asks for it."""
        whole = np.ones(len(self._of.rows), bool) if self._keep is None else self._keep.copy()
        whole[np.flatnonzero(whole)[~keep]] = False
        rest = Facts(self._of, whole)
        rest.__dict__ |= {k: self.__dict__[k][keep] for k in self.COUNTS if k in self.__dict__}
        return rest

    @cached_property
    def words(self) -> K.Words:
        return self.slice.words(K.SPACED_WORD)

    @cached_property
    def first(self) -> np.ndarray:
        return self.words.first()

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def _bytes(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each document are flagged."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.slice.ends] - total[self.slice.starts]

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._bytes(K.SPACED_WORD[self.slice.data] & ((self.slice.data & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._bytes(SYMBOL[self.slice.data])

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self._bytes(UPPER[self.slice.data])

    @cached_property
    def n_letters(self) -> np.ndarray:
        return self._bytes(LETTER[self.slice.data])

    @cached_property
    def n_digits(self) -> np.ndarray:
        return self._bytes(DIGIT[self.slice.data])

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and name of each line with a word, in order."""
        s = self.slice
        ends = np.flatnonzero(s.data == 0x0A)
        doc = np.searchsorted(s.starts, ends, side="right") - 1
        begin = np.concatenate((s.starts, ends + 1))
        of = np.concatenate((np.arange(len(s.starts)), doc))
        order = np.lexsort((begin, of))
        begin, of = begin[order], of[order]
        end = np.concatenate((begin[1:] - 1, [0])) if len(begin) else begin
        last = np.concatenate((of[1:] != of[:-1], [True])) if len(of) else np.zeros(0, bool)
        end[last] = s.ends[of[last]]
        inside = np.concatenate(([0], np.cumsum(K.SPACED_WORD[s.data])))
        some = inside[end] > inside[begin]
        begin, end, of = begin[some], end[some], of[some]
        return of, K.ranges(K.prefix(K.BYTE_CODES[0][s.data]), begin, end)

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines[0], minlength=len(self.slice.rows))

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        of, name = self._lines
        order = np.lexsort((name, of))
        of, name = of[order], name[order]
        again = np.zeros(len(of), bool)
        again[1:] = (of[1:] == of[:-1]) & (name[1:] == name[:-1])
        return np.bincount(of[again], minlength=len(self.slice.rows))

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in 5-word windows that the text has twice or more."""
        w, width = self.words, 5
        names = K.rolling(K.prefix(w.hashes()), width)
        n = len(names)
        if not n:
            return np.zeros(len(self.slice.rows), np.int64)
        own = w.doc[:n] == w.doc[width - 1 :]
        at = np.flatnonzero(own)
        name = names[at] ^ K.mix(w.doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(name, kind="stable")
        name = name[order]
        same = name[1:] == name[:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = at[order[twice]]
        hit = K.covered(len(w.doc), found, found + width)
        return np.bincount(w.doc[hit], minlength=len(self.slice.rows))


@dataclass(frozen=True)
class Rule:
    """A name, and which documents are rejected."""

    name: str
    rejects: Callable[[Facts], np.ndarray]


#: The base rules, which the contract fixes.
BASE = (
    Rule("few_words", lambda f: f.n_words < 10),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > 20 * f.n_words),
)
#: More rules, with thresholds that running prose keeps well away from.
MORE = (
    Rule("symbols", lambda f: 10 * f.n_symbols > 3 * f.n_words),
    Rule("capitals", lambda f: 2 * f.n_upper > f.n_letters),
    Rule("digits", lambda f: f.n_digits > f.n_letters),
    Rule("word_length", lambda f: (f.word_chars < 2 * f.n_words) | (f.word_chars > 20 * f.n_words)),
    Rule("duplicate_lines", lambda f: 2 * f.n_dup_lines > f.n_lines),
)
RULES = BASE + MORE
VERDICT = pa.schema([("doc_id", pa.int64()), ("kept", pa.bool_()), ("rejected_by", pa.string())])
MEASURED = pa.schema([("rule", pa.string()), ("docs", pa.int64()), ("rejected", pa.int64()), ("seconds", pa.float64())])


def cascade(facts: Facts, rules: tuple[Rule, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Which documents stay, and the place of the rule that rejected each other one; later rules see only what is left."""
    n = len(facts._of.rows) if facts._keep is None else int(facts._keep.sum())
    by, live = np.full(n, -1), np.arange(n)
    for k, rule in enumerate(rules):
        if not len(live):
            break
        out = rule.rejects(facts)
        by[live[out]] = k
        if out.any():
            live, facts = live[~out], facts.only(~out)
    return by < 0, by


def subset(s: K.Slice, keep: np.ndarray) -> K.Slice:
    size = (s.ends - s.starts)[keep]
    end = np.cumsum(size)
    data = s.data[np.repeat(keep, s.ends - s.starts)]
    return K.Slice(s.rows[keep], data, end - size, end)


def measure(docs: DataFrame, rules: tuple[Rule, ...], sample_docs: int, seed: int, given: tuple[str, ...] = ()) -> list[dict]:
    """Seconds and rejections of each rule, alone, over a sample of about ``sample_docs`` documents.

    ``given`` names the facts that are counted anyhow; a rule's seconds are what it takes besides them.
    """

    def run(batches):
        for b in batches:
            for s in K.slices(b.column(1)):
                known = Facts(s)
                for name in given:
                    getattr(known, name)
                for rule in rules:
                    facts = known.only(np.ones(len(s.rows), bool))
                    began = time.process_time()
                    out = rule.rejects(facts)
                    yield batch(MEASURED, [rule.name], [len(out)], [int(out.sum())], [time.process_time() - began])

    n = docs.count()
    sample = docs.sample(min(1.0, sample_docs / n), seed) if n else docs
    rows = sample.mapInArrow(run, "rule string, docs long, rejected long, seconds double").groupBy("rule").agg(F.sum("docs").alias("docs"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))
    return [r.asDict() for r in rows.collect()]


def ordered(rules: tuple[Rule, ...], measured: list[dict]) -> tuple[Rule, ...]:
    """By rejections per second, most first; rules without figures last, ties by name."""
    gain = {m["rule"]: m["rejected"] / max(m["seconds"], 1e-6) for m in measured}
    return tuple(sorted(rules, key=lambda r: (-gain.get(r.name, -1.0), r.name)))


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 2000, seed: int = 7) -> DataFrame:
    """doc_id, kept, and the rule that rejected (null if kept), by the cascade in its measured order.

    A null text counts as empty, and an empty one as without words; a text is judged whole, however long; ids may be
    null or repeat, other columns of any name are ignored, an empty table gives an empty one.  ``kept`` is the same for any
    order; which of several failing rules is named depends on the order.
    """
    docs = _input(docs, id_col, text_col)
    rules = ordered(rules, measure(docs, rules, sample_docs, seed))
    names = pa.array([r.name for r in rules], pa.string())

    def run(batches):
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            for s in K.slices(b.column(1)):
                kept, by = cascade(Facts(s), rules)
                yield batch(VERDICT, ids.take(pa.array(s.rows)), kept, names.take(pa.array(by, mask=kept)))

    return docs.mapInArrow(run, "doc_id long, kept boolean, rejected_by string")


#: The figures of the report.
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORED = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in FIGURES), ("base_failed", pa.bool_()), ("kept", pa.bool_())])


def quality_report(docs: DataFrame, more: tuple[Rule, ...] = MORE, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 2000, seed: int = 7) -> DataFrame:
    """The base figures and verdict of every document, and whether the cascade keeps it.

    All rules, the base ones too, run in the measured order, on the figures that the report has at hand
    and with costs measured besides them.  Returns
    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept.  Nulls, empty texts and repeats as in :func:`quality_verdicts`.
    """
    docs = _input(docs, id_col, text_col)
    rules = ordered(BASE + more, measure(docs, BASE + more, sample_docs, seed, FIGURES))

    def run(batches):
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            for s in K.slices(b.column(1)):
                f = Facts(s)
                figures = [getattr(f, name) for name in FIGURES]
                kept, _ = cascade(f, rules)
                base = np.logical_or.reduce([r.rejects(f) for r in BASE])  # from the figures alone
                yield batch(SCORED, ids.take(pa.array(s.rows)), *figures, base, kept)

    return docs.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_report(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: The same figures and the same rules for DuckDB.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d
), f AS (
  SELECT rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits,
         strlen(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters,
         list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, ws
  FROM w
), g AS (
  SELECT rid, i, array_to_string(ws[i:i+4], ' ') AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM f WHERE len(ws) >= 5)
), r AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 5)) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1)
  GROUP BY rid
), a AS (
  SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, n_upper, n_digits, n_letters
  FROM f LEFT JOIN r USING (rid)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_upper > n_letters OR n_digits > n_letters
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM b
"""
