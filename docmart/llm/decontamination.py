"""Operator 2: benchmark decontamination with a generalised suffix automaton.

The automaton holds every word string inside any benchmark item.  Document words
stream through it; after each word it knows the longest string of items that
ends there.  Where that is at least a window long, the window's words are hit and the
state names the items that have it.  Whole stretches that no item can match are skipped
first: a vectorised look-up finds the places whose short word strings occur in some item.

One automaton holds ``PART_BYTES`` of item text.  A larger benchmark is cut into parts by item, and the documents are still read once:
each window of an item, and of a document, is marked by the least name of its short word strings, and a join of the marks tells which
texts can match which parts.  A part's automaton streams over those texts alone; hit places and items of the parts are then merged by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .repeats import window_starts
from .shared import batch, cut, kept

REPORT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest", pa.int64()), ("clean_text", pa.string())]
)


#: Item text of one automaton. One of 1 MB takes about 110 MB of a task's memory (measured), so 2 MB about 220.
PART_BYTES = 2 << 20


class Automaton:
    """Generalised suffix automaton over word names, with the items of each state at which a window ends."""

    def __init__(self, items: Iterable[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(i, w) for i, w in items if w]
        for _, words in items:
            last = 0
            for w in words:
                last = self._add(last, w)
        self.items: dict[int, set[str]] = {}
        self.whole: dict[tuple[int, int], set[str]] = {}
        for item, words in items:
            state = 0
            for k, w in enumerate(words):
                state = self.next[state][w]
                if k + 1 >= window:
                    self.items.setdefault(self.part(state, window), set()).add(item)
            if len(words) < window:
                self.whole.setdefault((self.part(state, len(words)), len(words)), set()).add(item)
        self.short = sorted({n for _, n in self.whole})
        self.shortest = min([window, *self.short])
        #: Names of all word strings of ``gram`` words: where none occurs there is no match.
        self.gram = min(3, self.shortest)
        grams = [K.rolling(K.prefix(np.array(w, np.uint64)), self.gram) for _, w in items if len(w) >= self.gram]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.empty(0, np.uint64)
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.grams & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _add(self, last: int, w: int) -> int:
        have = self.next[last].get(w)
        if have is not None and self.length[have] == self.length[last] + 1:
            return have
        if have is not None:
            return self._clone(last, have, w)
        new = self._state(self.length[last] + 1, {})
        while last >= 0 and w not in self.next[last]:
            self.next[last][w] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            q = self.next[last][w]
            self.link[new] = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        return new

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def part(self, state: int, n: int) -> int:
        """The state of the last n words of a match that ends in ``state``."""
        while self.length[self.link[state]] >= n and self.link[state] >= 0:
            state = self.link[state]
        return state

    def stream(self, words: Iterable[int]) -> Iterator[tuple[int, int, set[str]]]:
        """For each word at which some window ends: (place, length of the longest such window, items)."""
        state = length = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state, length = self.next[state][w], length + 1
            else:
                length = 0
            if length < self.shortest:
                continue
            found, longest = set(), 0
            if length >= self.window:
                found |= self.items[self.part(state, self.window)]
                longest = self.window
            for n in self.short:
                if length >= n and (whole := self.whole.get((self.part(state, n), n))):
                    found |= whole
                    longest = max(longest, n)
            if longest:
                yield i, longest, found, length

    def candidates(self, words: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """Stretches [a, b) of words, each within one document, in which alone windows can lie."""
        names = K.rolling(K.prefix(words), self.gram)
        near = np.flatnonzero(self.sieve[(names & np.uint64(0xFFFF)).astype(np.int64)])
        near = near[np.isin(names[near], self.grams) & (doc[near] == doc[near + self.gram - 1])]
        flags = np.zeros(len(names), bool)
        flags[near] = True
        edge = np.zeros(len(names), bool)
        edge[1:] = doc[1 : len(names)] != doc[: len(names) - 1]
        a, b = [], []
        for x, y in zip(*K.runs(flags), strict=True):
            cuts = [x, *(np.flatnonzero(edge[x + 1 : y]) + x + 1), y]
            a += cuts[:-1]
            b += cuts[1:]
        return [(x, y + self.gram - 1) for x, y in zip(a, b, strict=True) if y - x + self.gram - 1 >= self.shortest]


def _words(s: K.Slice) -> K.Words:
    return s.words(K.PLAIN_WORD, lower=True)


def item_words(texts: list[str | None]) -> list[list[int]]:
    """The names of each text's words."""
    out: list[list[int]] = []
    for s in K.slices(pa.array(texts, pa.string())):
        w = _words(s)
        names, first = w.hashes(), w.first()
        out += [names[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


class Hits:
    """Hit words, items and longest match of the documents of a slice, by one automaton."""

    def __init__(self, automaton: Automaton, s: K.Slice):
        self.words = w = _words(s)
        names = w.hashes()
        self.hit = np.zeros(len(names), bool)
        self.items: dict[int, set[str]] = {}
        self.longest = np.zeros(len(s.rows), np.int64)
        for x, y in automaton.candidates(names, w.doc) if len(names) else ():
            d = int(w.doc[x])
            for i, n, found, length in automaton.stream(names[x:y].tolist()):
                self.hit[x + i - n + 1 : x + i + 1] = True
                self.items.setdefault(d, set()).update(found)
                self.longest[d] = max(self.longest[d], length)


@dataclass(frozen=True)
class Limits:
    """When a document counts as contaminated: hit words are a share of at least ``per_mille``, or more than ``max_hit``."""

    per_mille: int = 50
    max_hit: int | None = None

    def exceeded(self, n_hit: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        bad = (n_hit > 0) & (1000 * n_hit >= self.per_mille * n_words)
        return bad if self.max_hit is None else bad | (n_hit > self.max_hit)


def _report(s: K.Slice, w: K.Words, hit: np.ndarray, items: list[list[str]], longest: np.ndarray, limits: Limits, with_text: bool) -> list:
    """The columns after doc_id."""
    first = w.first()
    n_words = np.diff(first)
    n_hit = np.diff(np.concatenate(([0], np.cumsum(hit)))[first])
    digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
    columns = [n_words, n_hit, [len(x) for x in items], digests, limits.exceeded(n_hit, n_words), longest]
    return columns + [_without(s, w, hit)] * with_text


def _scan(automaton: Automaton, limits: Limits, with_text: bool):
    schema = REPORT if with_text else pa.schema(list(REPORT)[:-1])

    def run(batches):
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            for s in K.slices(b.column(1)):
                h = Hits(automaton, s)
                items = [sorted(h.items.get(d, ())) for d in range(len(s.rows))]
                yield batch(schema, ids.take(pa.array(s.rows)), *_report(s, h.words, h.hit, items, h.longest, limits, with_text))

    return run


_PART = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n_words", pa.int64()), ("longest", pa.int64()), ("runs", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_PART_SQL = "h1 long, h2 long, n_words long, longest long, runs array<bigint>, items array<string>"


def _scan_part(automaton: Automaton):
    """Of each text with hits: its name, and the runs of hit words as starts and ends in turn."""

    def run(batches):
        for b in batches:
            for s in K.slices(b.column(2)):
                h = Hits(automaton, s)
                first = h.words.first()
                have = sorted(h.items)
                if have:
                    runs = [np.stack(K.runs(h.hit[first[d] : first[d + 1]]), 1).ravel().tolist() for d in have]
                    at = pa.array(s.rows[have])
                    yield batch(_PART, b.column(0).take(at), b.column(1).take(at), np.diff(first)[have], h.longest[have], runs, [sorted(h.items[d]) for d in have])

    return run


def _finish(limits: Limits, with_text: bool):
    """Rows (doc_id, text, longest, runs, items) to the report; null where a text has no hits."""
    schema = REPORT if with_text else pa.schema(list(REPORT)[:-1])

    def run(batches):
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            longest = b.column(2).fill_null(0).to_numpy(zero_copy_only=False)
            for s in K.slices(b.column(1)):
                w = _words(s)
                first, hit = w.first(), np.zeros(len(w.doc), bool)
                items: list[list[str]] = []
                for k, r in enumerate(s.rows):
                    runs = b.column(3)[int(r)]
                    if runs.is_valid:
                        ends = runs.values.to_numpy().reshape(-1, 2) + first[k]
                        hit[first[k] : first[k + 1]] = K.covered(int(first[k + 1]), ends[:, 0], ends[:, 1])[first[k] :]
                    items.append(sorted(b.column(4)[int(r)].as_py() or ()))
                yield batch(schema, ids.take(pa.array(s.rows)), *_report(s, w, hit, items, longest[s.rows], limits, with_text))

    return run


def _without(s: K.Slice, w: K.Words, hit: np.ndarray) -> list[str]:
    """The texts without the hit spans, each from its first word to its last."""
    gone = np.zeros(len(s.data), bool)
    both = np.zeros(len(hit), bool)
    both[:-1] = hit[:-1] & hit[1:] & (w.doc[:-1] == w.doc[1:])
    at = np.flatnonzero(hit)
    gone |= K.covered(len(s.data), w.start[at], np.where(both[at], w.start[np.minimum(at + 1, len(hit) - 1)], w.end[at]))
    return [s.data[a:b][~gone[a:b]].tobytes().decode("utf-8", "replace") for a, b in zip(s.starts, s.ends, strict=True)]


def automata_of(benchmark: DataFrame, item_col: str, item_text_col: str, window: int, part_bytes: int) -> tuple[DataFrame, int, Iterator[Automaton]]:
    """The items with their ``part``, the number of parts, and their automata, one at a time. Rows of one item are in one part."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // part_bytes))
    items = items.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int"))

    def of(k: int) -> Automaton:
        own = items.where(F.col("part") == k)
        rows = sorted((r["item"], r["text"]) for r in own.collect())  # about part_bytes
        return Automaton(zip([r[0] for r in rows], item_words([r[1] for r in rows]), strict=True), window)

    return items, parts, (of(k) for k in range(parts))


def _named(docs: DataFrame, text: Column, row: Column) -> DataFrame:
    """Rows with the two names of their text. A null or empty text has none (``h2`` is null) and is dealt by the row, so that such rows meet nothing and no task has them all."""
    some = F.coalesce(text != "", F.lit(False))
    return docs.withColumns({"h1": F.when(some, F.xxhash64(text)).otherwise(F.xxhash64(row)), "h2": F.when(some, F.xxhash64(F.lit(7), text))})


def _marks(s: K.Slice, lengths: Iterable[int], window: int, own_length: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of windows: the texts of the slice that have one, and the windows' marks, each once a text.

    A mark is the least name of the window's strings of up to three words, so equal windows have equal marks and windows next to each other mostly share one. With ``own_length``
    a text has windows of one length: of ``window`` words or, if it has fewer, of all its words.
    """
    w = _words(s)
    pre, bounds = K.prefix(w.hashes()), w.first()
    own = np.minimum(np.diff(bounds), window)
    for n in lengths if lengths else np.unique(own[own > 0]).tolist():
        starts = window_starts(bounds, n)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        if own_length:
            starts, doc = starts[own[doc] == n], doc[own[doc] == n]
        if len(starts):
            gram = min(3, n)
            name = K.mix(K.sliding_min(K.rolling(pre, gram), n - gram + 1)[starts] + np.uint64(n))
            order = np.lexsort((name, doc))
            doc, name = doc[order], name[order]
            new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])))
            yield n, doc[new], name[new].view(np.int64)


def _item_marks(window: int):
    schema = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("mark", pa.int64())])

    def run(batches):
        for b in batches:
            for s in K.slices(b.column(1)):
                for n, doc, mark in _marks(s, (), window, True):
                    yield batch(schema, b.column(0).take(pa.array(s.rows[doc])), np.full(len(doc), n, np.int32), mark)

    return run


def _text_marks(lengths: list[int], window: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("mark", pa.int64())])

    def run(batches):
        for b in batches:
            for s in K.slices(b.column(2)):
                for _, doc, mark in _marks(s, lengths, window, False) if lengths else ():
                    at = pa.array(s.rows[doc])
                    yield batch(schema, b.column(0).take(at), b.column(1).take(at), mark)

    return run


#: Tasks that the texts of one part are dealt to, so that a part that many documents match is in no single file.
SPREAD = 16


def candidates(texts: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``texts(h1, h2, text)`` with each ``part`` of ``items(item, text, part)`` that they may match, in a table by part; one pass over the texts for their marks and one for those that are kept."""
    marks = cut(items.select("part", "text").mapInArrow(_item_marks(window), "part int, n int, mark long").distinct())
    lengths = sorted(r["n"] for r in marks.select("n").distinct().collect())  # window lengths: at most ``window`` rows
    named = texts.mapInArrow(_text_marks(lengths, window), "h1 long, h2 long, mark long")
    wanted = named.join(marks.select("part", "mark"), "mark").select("h1", "h2", "part").distinct()
    found = texts.join(wanted, ["h1", "h2"]).repartition("part", F.pmod("h1", F.lit(SPREAD)))
    return kept(found, "candidates", by="part")


def _merged_hits(texts: DataFrame, items: DataFrame, automata: Iterator[Automaton], window: int) -> DataFrame:
    """``texts(h1, h2, text)`` to one row for each text with hits in some part: the runs and items of all parts together."""
    found, near = None, candidates(texts.where("h2 is not null"), items, window)
    for k, automaton in enumerate(automata):
        own = near.where(F.col("part") == k).select("h1", "h2", "text")
        part = cut(own.mapInArrow(_scan_part(automaton), _PART_SQL).dropDuplicates(["h1", "h2"]))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("h1", "h2").agg(F.first("n_words").alias("n_words"), F.max("longest").alias("longest"), F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("items")).alias("items"))


def _overlaid(batches):
    """The number of hit words of each row, from runs that may overlap."""
    for b in batches:
        n = [int(K.covered(int(w), x.values.to_numpy()[::2], x.values.to_numpy()[1::2]).sum()) for w, x in zip(b.column(2).to_pylist(), b.column(4), strict=True)]
        yield batch(_HIT, b.column(0), b.column(1), b.column(2), n)


_HIT = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64())])


def decontamination_report(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    coverage_per_mille: int = 50,
    max_hit: int | None = None,
    with_text: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """What each document shares with the benchmark.

    A word is hit inside any occurrence of ``window`` consecutive item words; an
    item of fewer words, but not none, is one window.  Returns doc_id, n_words,
    n_hit, n_items, items_sha256, contaminated (hit words are a share of at least
    ``coverage_per_mille``, or more than ``max_hit``), longest (the longest match
    at which a window ends) and, with ``with_text``, clean_text: the text without
    the hit spans.

    A null text has no words and is never contaminated; a text is read whole, however long.  Items without
    an id or without words are ignored, equal ids are one item.  Repeated rows get equal
    results; an empty table, or an empty benchmark, gives no hits; other columns, of any name, are ignored.
    A benchmark of over ``part_bytes`` is matched in parts, with the same result; the documents are read as often whatever the number of parts.
    """
    limits = Limits(coverage_per_mille, max_hit)
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long" + ", clean_text string" * with_text
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items, parts, automata = automata_of(benchmark, item_col, item_text_col, window, part_bytes)
    if parts == 1:
        return docs.mapInArrow(_scan(next(automata), limits, with_text), schema)
    named = _named(docs, F.col("text"), F.col("doc_id"))
    found = _merged_hits(named.select("h1", "h2", "text"), items, automata, window)
    rows = named.join(found, ["h1", "h2"], "left").select("doc_id", "text", "longest", "runs", "items")
    return rows.mapInArrow(_finish(limits, with_text), schema)


def filter_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 13, coverage_per_mille: int = 50, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated.

    Cases as in :func:`decontamination_report`: rows with a null or empty text stay, repeated rows go or stay
    together, ids are not looked at, and columns of any name pass through.
    """
    limits = Limits(coverage_per_mille)
    items, parts, automata = automata_of(benchmark, item_col, item_text_col, window, part_bytes)
    if parts > 1:
        whole = docs.select(F.struct("*").alias("row"))
        named = _named(whole, F.col("row")[text_col].cast("string"), F.to_json("row"))
        found = _merged_hits(named.select("h1", "h2", F.col("row")[text_col].cast("string").alias("text")), items, automata, window)
        hits = found.mapInArrow(_overlaid, "h1 long, h2 long, n_words long, n_hit long")
        bad = hits.where((F.col("n_hit") > 0) & (1000 * F.col("n_hit") >= limits.per_mille * F.col("n_words")))
        return named.join(bad.select("h1", "h2"), ["h1", "h2"], "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])
    scan = _scan(next(automata), limits, False)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            rows = pa.RecordBatch.from_arrays([pa.array(range(b.num_rows), pa.int64()), b.column(place)], names=["id", "text"])
            bad = [x.column(5).to_numpy(zero_copy_only=False) for x in scan([rows])]
            yield b.filter(pa.array(~np.concatenate(bad))) if bad else b

    return docs.mapInArrow(run, docs.schema)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decontamination_report(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("longest")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS g
       FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
       FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
h AS (SELECT rid, item, i, n FROM dw JOIN bw USING (n, g)),
p AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)
"""
