"""Operator 6: repeated word windows, by recompression.

Each text is a string of words.  A round first replaces every run of equal
symbols by one symbol (symbol, length), then every neighbouring pair whose left
symbol falls in the left half of the alphabet and whose right one in the right
half.  A symbol's name is a hash of what it stands for and its half a bit of
that hash, so all tasks give equal things equal names without asking each other,
and no name table is collected.  Whether a symbol is made depends on its near
neighbours only: alongside each symbol goes the stretch of words that decided
it, and inside any window every symbol decided by that window's words
alone is made in each occurrence of the window.  After ``ROUNDS`` rounds the least of these
interior symbols is the window's anchor; a window that has none (one long run,
say) is its own anchor.  :mod:`docmart.llm.repeats` finds the symbols that several documents share on Spark,
and verifies the windows around them word for word.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .repeats import Kind, Tokens, gathered, place_bits, removed_tokens, repeated_spans
from .shared import batch

#: Rounds of runs and pairs. A symbol then covers about (4/3)**ROUNDS words, 2**ROUNDS at most but for runs.
ROUNDS = 3
CONTEXT = 16

RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def word_tokens(s: K.Slice) -> Tokens:
    """Words, and their bytes with one space between."""
    w = s.words(K.SPACED_WORD)
    length = w.end - w.start
    begin = np.cumsum(length + 1) - (length + 1)
    data = np.full(int((length + 1).sum()), 0x20, np.uint8)
    data[np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))] = s.data[K.SPACED_WORD[s.data]]
    return Tokens(w.hashes(0), w.first(), data, begin, begin + length)


def word_windows(data, start, length, n, width):
    length = length.astype(np.int64)
    text, at = gathered(data, start, length), np.cumsum(length) - length
    space = np.flatnonzero(text == 0x20)
    begins, ends = np.sort(np.concatenate((at, space + 1))), np.sort(np.concatenate((at + length, space)))
    words = n + width - 1
    first = np.repeat(np.cumsum(words) - words - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return begins[first] + np.repeat(start - at, n), ends[first + width - 1] - begins[first]


def recompress(names: np.ndarray, bounds: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds, and for each the words [lo, hi) that decided it; over a document's end it is undecided."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    lo, hi = np.arange(len(names)), np.arange(1, len(names) + 1)
    before, beyond = bounds[:-1] - 1, bounds[1:] + 1  # outside the document, so never inside a window of it
    for r in range(rounds):
        if not len(names):
            break
        same = np.zeros(len(names), bool)
        same[1:] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
        first = np.flatnonzero(~same)
        last = np.append(first[1:], len(names)) - 1
        count = last - first + 1
        edge_l = np.concatenate(([True], doc[1:] != doc[:-1]))[first]
        edge_r = np.concatenate((doc[1:] != doc[:-1], [True]))[last]
        many = count > 1
        # the neighbours on both sides show where a run, or a single symbol, begins and ends
        run_lo = np.where(edge_l, before[doc[first]], lo[np.maximum(first - 1, 0)])
        run_hi = np.where(edge_r, beyond[doc[last]], hi[np.minimum(last + 1, len(hi) - 1)])
        names = np.where(many, K.mix(names[first] + count.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), names[first])
        lo, hi, doc = run_lo, run_hi, doc[first]
        right = (K.mix(names ^ np.uint64(0x1234567 + r)) & np.uint64(1)).astype(bool)
        n = len(names)
        next_in = np.append(doc[1:] == doc[:-1], False)
        prev_in = np.insert(doc[1:] == doc[:-1], 0, False)
        heads = np.zeros(n, bool)
        heads[:-1] = ~right[:-1] & right[1:] & next_in[:-1]
        tails = np.zeros(n, bool)
        tails[1:] = heads[:-1]
        # a left symbol stays alone because of the one behind it, a right symbol because of the one before it
        new_lo = np.where(~heads & right, np.where(prev_in, np.roll(lo, 1), before[doc]), lo)
        new_hi = np.where(~heads & ~right, np.where(next_in, np.roll(hi, -1), beyond[doc]), hi)
        at = np.flatnonzero(heads)
        out = names.copy()
        out[at] = K.mix(names[at] * np.uint64(3) + K.mix(names[at + 1] + np.uint64(r)))
        new_hi[at] = hi[at + 1]
        keep = ~tails
        names, lo, hi, doc = out[keep], new_lo[keep], new_hi[keep], doc[keep]
    return names, lo, hi


def interior_symbols(rounds: int):
    """Anchor of each window: of the symbols that its own words decide, the one whose words have the least name.

    A symbol goes by the words that decided it, and ``CONTEXT`` words at least, so that two documents rarely share one by chance, however many there are.
    """

    def anchors(codes, bounds, starts, width):
        _, lo, hi = recompress(codes, bounds, rounds)
        hi = np.maximum(hi, lo + min(CONTEXT, width))
        pre = K.prefix(codes)
        names = K.ranges(pre, np.clip(lo, 0, len(codes)), np.clip(hi, 0, len(codes)))
        a = np.searchsorted(np.minimum.accumulate(lo[::-1])[::-1], starts)
        b = np.searchsorted(np.maximum.accumulate(hi), starts + width, side="right")
        place_of = place_bits(len(names))
        keyed = (names & ~place_of) | np.arange(len(names), dtype=np.uint64)
        best = np.full(len(starts), np.iinfo(np.uint64).max)
        length = b - a
        level, table = 0, keyed
        while True:  # least of a range from two overlapping ranges of a power of two
            here = np.flatnonzero((length >= 1 << level) & (length < 2 << level))
            if len(here):
                best[here] = np.minimum(table[a[here]], table[b[here] - (1 << level)])
            if len(table) <= 1 << level or not (length >= 2 << level).any():
                break
            table = np.minimum(table[: len(table) - (1 << level)], table[1 << level :])
            level += 1
        some = length > 0
        place = np.where(some, (best & place_of).astype(np.int64), len(names) + starts)
        name = np.empty(len(starts), np.uint64)
        name[some] = names[place[some]]
        own = starts[~some]
        name[~some] = K.ranges(pre, own, own + width)
        return place, name

    return anchors


def _finish(width: int, with_text: bool):
    schema = RESULT if with_text else pa.schema(list(RESULT)[:-1])

    def run(batches):
        for b in batches:
            offsets, data = K.text_buffers(b.column(1))
            codes = b.column(2)
            rows = []
            for i in range(b.num_rows):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                gone = removed_tokens(codes[i], len(words), width)
                kept = b" ".join(compress(words, ~gone) if gone.any() else words)
                rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept)[: None if with_text else -1])
            if rows:
                columns = [*zip(*rows, strict=True)]
                if with_text:
                    columns[-1] = pa.array(columns[-1], pa.binary()).cast(pa.string())
                yield batch(schema, b.column(0).cast(pa.int64()), *columns)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, rounds: int = ROUNDS, with_text: bool = False) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts in a document with a smaller id.

    Words are runs without ASCII white space, unchanged; windows are judged on
    the input.  Returns doc_id, n_words, n_removed, kept_sha256 and, with
    ``with_text``, the kept words joined by one space.

    A null or blank text has no words; one of fewer than ``width`` is kept whole, and one of any length is judged whole.
    A null id has no order: its row is kept whole and removes nothing.
    Repeated rows get equal results; if rows of one id hold different texts, their
    removed places are pooled and cut to each text's length.  An empty table gives an empty one; other columns, of any name, are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    spans = repeated_spans(docs, Kind(word_tokens, interior_symbols(rounds), word_windows, width))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return docs.join(spans, "doc", "left").select("doc", "text", "codes").mapInArrow(_finish(width, with_text), schema)


def op6_recompression(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
m AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS least_id FROM w) WHERE doc_id > least_id),
x AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS p FROM m),
k AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
a AS (SELECT k.rid, count(x.p) AS n_removed, string_agg(word, ' ' ORDER BY k.p) FILTER (x.p IS NULL) AS kept FROM k LEFT JOIN x ON k.rid = x.rid AND k.p = x.p GROUP BY k.rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (rid)
"""
