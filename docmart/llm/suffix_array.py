"""Operator 5: repeated byte strings, by a depth-limited radix sort of suffixes.

Suffixes are compared through ``width`` bytes only, by most-significant digits.  The first digit is the
``DIGIT``-byte string at the suffix's sampled place (the one with the least hash among those in its first
``width`` bytes: a place that equal suffixes agree on); a digit that only one document has ends the sort of its
suffixes.  The others are sorted by their real bytes, eight at a time: first the stretches of suffixes that
share a place, then the suffixes of stretches that differ.  After each pass a group of one document is done;
groups left equal after the last pass are exactly the repeated windows.  :mod:`docmart.llm.repeats` runs the passes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .repeats import Kind, Tokens, place_bits, removed_tokens, repeated_spans
from .shared import batch

#: Bytes of the first digit; at most ``width``.
DIGIT = 24

RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def byte_tokens(s: K.Slice) -> Tokens:
    at = np.arange(len(s.data))
    return Tokens(K.BYTE_CODES[0][s.data], np.append(s.starts, s.ends[-1:]), s.data, at, at + 1)


def byte_windows(data, start, length, n, width):
    begin = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return begin, np.full(len(begin), width)


def first_digits(digit: int):
    """Anchor of each window: the least of its digits, the leftmost of equal ones."""

    def anchors(codes, bounds, starts, width):
        names = K.rolling(K.prefix(codes), min(digit, width))
        place_of = place_bits(len(names))
        best = K.sliding_min((names & ~place_of) | np.arange(len(names), dtype=np.uint64), width - min(digit, width) + 1)
        place = (best[starts] & place_of).astype(np.int64)
        return place, names[place]

    return anchors


def _finish(width: int, with_text: bool):
    schema = RESULT if with_text else pa.schema(list(RESULT)[:-1])

    def run(batches):
        for b in batches:
            offsets, data = K.text_buffers(b.column(1))
            codes = b.column(2)
            rows = []
            for i in range(b.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                gone = removed_tokens(codes[i], len(text), width)
                kept = text[~gone].tobytes() if gone.any() else text.tobytes()
                rows.append((len(text), int(gone.sum()), len(K.runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept)[: None if with_text else -1])
            if rows:
                yield batch(schema, b.column(0).cast(pa.int64()), *zip(*rows, strict=True))

    return run


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, digit: int = DIGIT, with_text: bool = False) -> DataFrame:
    """Remove each byte covered by a ``width``-byte string that also starts in a document with a smaller id.

    Matches never cross documents and are judged on the input.  Returns doc_id,
    n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, with
    ``with_text``, the remaining bytes as ``kept`` (cutting bytes can split a
    character, so they are binary).

    A null text is empty; a text under ``width`` bytes is kept whole, and one of any length is judged whole.  A null
    id has no order: its row is kept whole and removes nothing.  Repeated rows
    get equal results, and equal ids never remove each other; if rows of one id
    hold different texts, their removed places are pooled and cut to each text's
    length.  An empty table gives an empty one; other columns, of any name, are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    spans = repeated_spans(docs, Kind(byte_tokens, first_digits(digit), byte_windows, width))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return docs.join(spans, "doc", "left").select("doc", "text", "codes").mapInArrow(_finish(width, with_text), schema)


def op5_suffix_array(spark, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: Every window of every text, as hex digits; those that one document has, by a hash, are left out first.
ORACLE_SQL = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT rid, doc_id, b, substr(h, 512 * b + 1, 610) AS part FROM (SELECT *, unnest(range(0, strlen(h) // 512 + 1)) AS b FROM d)),
w AS MATERIALIZED (SELECT rid, doc_id, i, g, hash(g) AS name FROM (SELECT rid, doc_id, 256 * b + j AS i, substr(part, 2 * j + 1, 100) AS g FROM (SELECT *, unnest(range(0, least(256, strlen(part) // 2 - 49))) AS j FROM c WHERE strlen(part) >= 100))),
f AS (SELECT name FROM w GROUP BY name HAVING min(doc_id) < max(doc_id)),
x AS (SELECT rid, doc_id, i, g FROM w JOIN f USING (name)),
m AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS least_id FROM x) WHERE doc_id > least_id),
s AS (SELECT rid, i, sum(apart) OVER (PARTITION BY rid ORDER BY i) AS k FROM (SELECT rid, i, CASE WHEN i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 1 ELSE 0 END AS apart FROM m)),
r AS (SELECT rid, min(i) AS a, max(i) + 50 AS z FROM s GROUP BY rid, k),
p AS (SELECT rid, a, z, lag(z, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS before FROM r),
g AS (SELECT rid, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last_z, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM p JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, strlen(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept || substr(h, 2 * last_z + 1), h))) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""
