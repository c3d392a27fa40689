"""Repeated windows across documents: the part that suffix sorting (bytes) and recompression (words) share.

A *window* is ``width`` consecutive tokens of one document.  A token is removed
if a window over it also starts in a document with a smaller id.  Shipping every
window through a shuffle would move many times the input, so windows are sorted in two passes:

1. Every window is named by an *anchor*, a place in it that depends on nothing
   but the window's own tokens, so equal windows have equal anchors.  Windows
   next to each other mostly share one; such a *stretch* (a dozen or more windows)
   is one small item ``(anchor name, doc, first window, windows)``.  Items are dealt by anchor.  An anchor that only
   one document has is done: nothing in it is repeated.
2. Of the anchors that are left, the text of each stretch is sent, dealt by anchor again, and sorted there by its real bytes:
   first whole stretches, then the windows of those that differ, in most-significant-digit passes.  What is
   equal to the last byte in a smaller document is a repeat.

Names are 64-bit hashes; they only deal and sieve, so two anchors with one name cost time and change nothing.
Copies inside one batch are sorted out before each shuffle, so a passage that a third of all documents share sends a
row for each batch and not for each document.  The stretches of an anchor with over ``HOT`` of them are dealt
as single windows by the windows' names, so that no bucket gathers all that stands around a common passage.
A bucket holds about ``BUCKET_BYTES`` of text whatever the input, and a task settles one at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import batch, cut, ids_of, pack, unpack

PACKED = pa.schema([("bucket", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())])
PACKED_SQL, SPANS_SQL = "bucket long, kind byte, blob binary", "doc long, code long"
SPANS = pa.schema([("doc", pa.int64()), ("code", pa.int64())])
#: A stretch: anchor name, document, first window and number of windows; with 0 windows, an anchor that so many stretches of a batch have.
_ITEM = [np.uint64, np.int64, np.int32, np.uint8]
_MEMBER = [np.uint64, np.int64, np.int64]
_TEXT = [np.uint64, np.int64, np.int32, np.uint8, np.int32]
#: Flush packed rows after so many bytes of text (first pass) and of stretches (second pass): the working memory of a task.
FLUSH_BYTES, FLUSH_TEXTS = 8 << 20, 4 << 20
#: Windows that are sorted at a time.
CHUNK = 1 << 17
#: Input text of a shuffle partition and of a bucket in it.
PART_BYTES, BUCKET_BYTES = 64 << 20, 2 << 20
HOT = 1 << 14
_CODEC = pa.Codec("zstd", compression_level=3)
#: Windows of a stretch at most.
LONGEST = 255


@dataclass
class Tokens:
    """Tokens of a slice: hashes, the index of each document's first and the number at the end, and the bytes data[start:end] of each.

    Runs of tokens in ``data`` are equal if and only if the tokens are.
    """

    codes: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


#: anchors(codes, bounds, starts, width) -> (anchor place and name for each window start of ``starts``)
Anchors = Callable[[np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]
#: windows(data, start, length, n, width) -> (start, length) of all windows of stretches of n windows each, in order
Windows = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Kind:
    """What tokens are, how windows are anchored, and where the windows of a stretch begin and end."""

    tokens: Callable[[K.Slice], Tokens]
    anchors: Anchors
    windows: Windows
    width: int


def _code(at: np.ndarray, n: np.ndarray | int, hot: np.ndarray | int = 0) -> np.ndarray:
    return (at.astype(np.int64) << 9) | (np.asarray(n, np.int64) << 1) | hot


def _decode(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return code >> 9, (code >> 1) & 255, (code & 1).astype(bool)


def place_bits(n: int) -> np.uint64:
    """A mask for places 0..n-1 in the low bits of a name; of equal high bits the leftmost is least, in any occurrence of a window."""
    return np.uint64((1 << max(24, int(n).bit_length())) - 1)


def window_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows that lie within one document."""
    n = int(bounds[-1])
    if n < width:
        return np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: n - width + 1]
    at = np.arange(n - width + 1)
    return at[at + width <= bounds[1:][doc]]


def _rows(parts: list) -> Iterator[pa.RecordBatch]:
    if parts:
        yield batch(PACKED, *zip(*parts, strict=True))


def _buckets(batches) -> Iterator[tuple[int, int, np.ndarray]]:
    for b in batches:
        kinds, blobs = b.column(1).to_numpy(), b.column(2)
        for i, bucket in enumerate(b.column(0).to_numpy()):
            yield int(bucket), int(kinds[i]), np.frombuffer(blobs[i].as_buffer(), np.uint8)


def _spans(doc: np.ndarray, code: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(doc), 1 << 20):
        yield batch(SPANS, doc[i : i + (1 << 20)], code[i : i + (1 << 20)])


# pass 1


def _stretches(kind: Kind, t: Tokens) -> tuple[np.ndarray, ...]:
    """Of each stretch: its document in the slice, first window (in tokens of the slice), number of windows, anchor name."""
    starts = window_starts(t.bounds, kind.width)
    if not len(starts):
        return starts, starts, starts, starts.astype(np.uint64)
    _, name = kind.anchors(t.codes, t.bounds, starts, kind.width)
    doc = np.searchsorted(t.bounds, starts, side="right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)  # a run of one name, as in a text that repeats itself, is cut into stretches of a bounded length
    new[(np.arange(len(starts)) - first[np.cumsum(new) - 1]) % LONGEST == 0] = True
    new = np.flatnonzero(new)
    return doc[new], starts[new], np.diff(np.append(new, len(starts))), name[new]


def anchors_of(kind: Kind, bits: int):
    """Before the shuffle: the anchors of each batch; of those that several of its documents have one row, and the members apart."""

    def flush(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        name, doc, at, n = (np.concatenate(p) for p in parts)
        order = np.argsort(name, kind="stable")
        name, doc, at, n = name[order], doc[order], at[order], n[order]
        where = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        size = np.diff(np.append(where, len(name)))
        several = np.minimum.reduceat(doc, where) < np.maximum.reduceat(doc, where)
        member = np.repeat(several, size)
        rows = [*pack(name[~member], bits, [x[~member] for x in (name, doc, at, n)])]
        first = where[several]
        rows += pack(name[first], bits, [name[first], doc[first], size[several].astype(np.int32), np.zeros(len(first), np.uint8)])
        rows += pack(name[member], bits, [name[member], doc[member], _code(at[member], n[member])], kind=1)
        yield from _rows(rows)

    def run(batches):
        parts: list[list[np.ndarray]] = [[] for _ in _ITEM]
        size = 0
        for b in batches:
            ids = ids_of(b.column(0))
            for s in K.slices(b.column(1)):
                t = kind.tokens(s)
                doc, at, n, name = _stretches(kind, t)
                if len(doc):
                    for p, x in zip(parts, (name, ids[s.rows[doc]], (at - t.bounds[doc]).astype(np.int32), n.astype(np.uint8)), strict=True):
                        p.append(x)
                size += len(s.data)
                if size >= FLUSH_BYTES:
                    if parts[0]:
                        yield from flush(parts)
                    parts, size = [[] for _ in _ITEM], 0
        if parts[0]:
            yield from flush(parts)

    return run


def shared_anchors(batches):
    """After the shuffle, in the order of bucket and kind: the stretches whose anchor several documents have, and whether it is hot."""

    def settle(blobs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        name, doc, at, n = unpack(blobs, _ITEM)
        order = np.argsort(name, kind="stable")
        name, doc, at, n = name[order], doc[order], at[order], n[order]
        where = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        several = (np.minimum.reduceat(n, where) == 0) | (np.minimum.reduceat(doc, where) < np.maximum.reduceat(doc, where))
        hot = np.add.reduceat(np.where(n == 0, at, 1), where) > HOT
        size = np.diff(np.append(where, len(name)))
        keep = np.repeat(several, size) & (n > 0)
        return doc[keep], _code(at[keep], n[keep], np.repeat(hot, size)[keep].astype(np.int64)), name[where[hot]]

    last, waiting, hot = None, [], np.empty(0, np.uint64)
    for bucket, kind, blob in _buckets(batches):
        if waiting and (kind or bucket != last):
            doc, code, hot = settle(waiting)
            waiting = []
            yield from _spans(doc, code)
        last = bucket
        if kind:  # these anchors have a row of kind 0 in the bucket, so hot is known
            name, doc, code = unpack([blob], _MEMBER)
            yield from _spans(doc, code | np.isin(name, hot))
        else:
            waiting.append(blob)
    if waiting:
        yield from _spans(*settle(waiting)[:2])


# pass 2


def repeated(data: np.ndarray, start: np.ndarray, length: np.ndarray, name: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which strings data[start:start+length] of a name also stand in a smaller document, by a radix sort of their bytes.

    Most significant digits of eight bytes first.  After each pass, a group that only one document is left in is done.
    """
    found = np.zeros(len(start), bool)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    digits = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    live, keys, depth = np.arange(len(start)), [name, length], 0
    while len(live):
        order = np.lexsort(keys[::-1])
        live = live[order]
        new = np.zeros(len(live), bool)
        new[0] = True
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
        where = np.flatnonzero(new)
        own = doc[live]
        least = np.minimum.reduceat(own, where)
        several = (least < np.maximum.reduceat(own, where))[np.cumsum(new) - 1]
        ended = several & (length[live] <= depth)  # the lengths of a group are equal
        found[live[ended]] = own[ended] > least[np.cumsum(new) - 1][ended]
        go_on = several & ~ended
        live, group = live[go_on], np.cumsum(new)[go_on]
        digit = digits[start[live] + depth].astype(np.uint64)
        over = np.clip(8 - (length[live] - depth), 0, 7).astype(np.uint64) * np.uint64(8)
        keys = [group, (digit >> over) << over]
        depth += 8
    return found


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The strings one after another."""
    parts, step = [], max(1, (1 << 20) // max(1, int(length.mean()) if len(length) else 1))
    for i in range(0, len(start), step):
        n = length[i : i + step]
        begin = np.cumsum(n) - n
        parts.append(data[np.repeat(start[i : i + step] - begin, n) + np.arange(int(n.sum()))])
    return np.concatenate(parts) if parts else np.empty(0, np.uint8)


def _pack_texts(bits: int, name, doc, at, n, length, start, data) -> Iterator[tuple[int, int, bytes]]:
    """Rows (bucket, 0, blob): the number of items and of bytes, the columns, and the bytes, compressed: they are most of what is shuffled."""
    bucket = (name >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((name, bucket))  # texts of one name side by side
    bucket, columns = bucket[order], [x[order] for x in (name, doc, at, n, length)]
    where = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
    for a, b in zip(where, [*where[1:], len(bucket)], strict=True):
        own = order[a:b]
        text = gathered(data, start[own], length[own])
        yield int(bucket[a]), 0, np.array([b - a, len(text)], np.int64).tobytes() + b"".join(c[a:b].tobytes() for c in columns) + _CODEC.compress(text, asbytes=True)


def _unpack_texts(blobs: list[np.ndarray]) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for t in _TEXT)
    heads, data = [], []
    for blob in blobs:
        n, size = (int(x) for x in np.frombuffer(blob, np.int64, 2))
        heads.append(unpack([blob[16 : 16 + n * width].tobytes()], _TEXT))
        data.append(np.frombuffer(_CODEC.decompress(blob[16 + n * width :], size), np.uint8))
    return [np.concatenate(x) for x in zip(*heads, strict=True)] + [np.concatenate(data)]


def _items(kind: Kind, t: Tokens, plain: np.ndarray, hot: np.ndarray, doc, at, n, name) -> Iterator[tuple[np.ndarray, ...]]:
    """Stretches to send (document, first window, windows, name), those of hot anchors as single windows by their own names, some thousands at a time."""
    own = np.flatnonzero(plain)
    for i in range(0, len(own), CHUNK // 8):
        k = own[i : i + CHUNK // 8]
        yield doc[k], at[k], n[k], name[k]
    own = np.flatnonzero(hot)
    pre = K.prefix(t.codes) if len(own) else None
    for i in range(0, len(own), CHUNK // LONGEST):
        k = own[i : i + CHUNK // LONGEST]
        m = n[k]
        first = np.repeat(at[k] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        yield np.repeat(doc[k], m), first, np.ones(len(first), np.int64), K.ranges(pre, first, first + kind.width)


def texts_of(kind: Kind, bits: int):
    """Before the shuffle: the texts of shared stretches (rows doc, text, codes), without those that the batch itself has in a smaller document."""
    width = kind.width

    def flush(parts) -> Iterator[pa.RecordBatch]:
        name, doc, at, n, length, data = (np.concatenate(p) for p in parts)
        start = np.cumsum(length.astype(np.int64)) - length
        gone = repeated(data, start, length, name, doc)
        rows = [*_pack_texts(bits, *(x[~gone] for x in (name, doc, at, n, length, start)), data)]
        rows += pack(K.mix(doc[gone].astype(np.uint64)), bits, [doc[gone], _code(at[gone], n[gone])], kind=1)  # done, so any bucket will do
        yield from _rows(rows)

    def run(batches):
        parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        size = 0
        for b in batches:
            ids, codes = ids_of(b.column(0)), b.column(2)
            for s in K.slices(b.column(1)):
                t = kind.tokens(s)
                doc, at, n, name = _stretches(kind, t)
                if not len(doc):
                    continue
                take, hot = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
                for k, row in enumerate(s.rows):
                    code = codes[int(row)].values.to_numpy()
                    a, z = np.searchsorted(doc, (k, k + 1))
                    place, _, is_hot = _decode(code)
                    own = np.searchsorted(at[a:z] - t.bounds[k], place)
                    own = np.minimum(own, z - a - 1)  # rows of one id with several texts share their codes
                    if z > a:
                        take[a + own], hot[a + own] = True, is_hot
                hot &= take
                for d, first, m, called in _items(kind, t, take & ~hot, hot, doc, at, n, name):
                    begin, stop = t.start[first], t.end[first + m - 2 + width]
                    text = gathered(t.data, begin, stop - begin)
                    for p, x in zip(parts, (called, ids[s.rows[d]], (first - t.bounds[d]).astype(np.int32), m.astype(np.uint8), (stop - begin).astype(np.int32), text), strict=True):
                        p.append(x)
                    size += len(text) + 25 * len(d)
                    if size >= FLUSH_TEXTS:
                        yield from flush(parts)
                        parts, size = [[] for _ in range(6)], 0
        if parts[0]:
            yield from flush(parts)

    return run


def settle_texts(kind: Kind):
    """After the shuffle, in the order of bucket: windows that stand in a smaller document, first by whole stretches."""

    def settle(blobs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        name, doc, at, n, length, data = _unpack_texts(blobs)
        start = np.cumsum(length.astype(np.int64)) - length
        gone = repeated(data, start, length, name, doc)
        yield from _spans(doc[gone], _code(at[gone], n[gone]))
        left = np.flatnonzero(~gone)
        left = left[np.argsort(name[left], kind="stable")]
        if not len(left):
            return
        where = np.flatnonzero(np.concatenate(([True], name[left][1:] != name[left][:-1])))
        several = np.minimum.reduceat(doc[left], where) < np.maximum.reduceat(doc[left], where)
        left = left[np.repeat(several, np.diff(np.append(where, len(left))))]
        total = np.cumsum(n[left].astype(np.int64))
        part = total // CHUNK
        _, group = np.unique(name[left], return_inverse=True)
        # a chunk of windows at a time, all of a name together
        part = part[np.searchsorted(group, group)]
        for p in np.unique(part):
            own = left[part == p]
            m = n[own].astype(np.int64)
            begin, size = kind.windows(data, start[own], length[own], m, kind.width)
            first = np.repeat(at[own] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            of = np.repeat(own, m)
            hit = repeated(data, begin, size, name[of], doc[of])
            yield from _spans(doc[of[hit]], _code(first[hit], 1))

    def run(batches):
        last, waiting = None, []
        for bucket, settled, blob in _buckets(batches):
            if settled:
                yield from _spans(*unpack([blob], [np.int64, np.int64]))
                continue
            if waiting and bucket != last:
                yield from settle(waiting)
                waiting = []
            last = bucket
            waiting.append(blob)
        if waiting:
            yield from settle(waiting)

    return run


def dealt(docs: DataFrame) -> tuple[int, int]:
    """Shuffle partitions, and the bits of a name that are its bucket, for the bytes of text that there are."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    return parts, max(4, (max(4 * parts, size // BUCKET_BYTES) - 1).bit_length())


def repeated_spans(docs: DataFrame, kind: Kind) -> DataFrame:
    """``docs(doc, text)`` to ``(doc, codes)``: packed runs of windows that start in a smaller document too."""
    if not 2 <= kind.width <= 128:
        raise ValueError("the width of a window must be from 2 to 128 tokens")
    # Null ids have no order, so such rows neither remove nor are removed.
    docs = docs.where(F.col("doc").isNotNull())
    parts, bits = dealt(docs)
    by_bucket = lambda df: df.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")
    by_doc = lambda df: df.groupBy("doc").agg(F.collect_list("code").alias("codes"))
    shared = cut(by_doc(by_bucket(docs.mapInArrow(anchors_of(kind, bits), PACKED_SQL)).mapInArrow(shared_anchors, SPANS_SQL)))
    texts = docs.join(shared, "doc").select("doc", "text", "codes").mapInArrow(texts_of(kind, bits), PACKED_SQL)
    return cut(by_doc(by_bucket(texts).mapInArrow(settle_texts(kind), SPANS_SQL)))


def removed_tokens(codes: pa.Scalar, n: int, width: int) -> np.ndarray:
    """Flags of the tokens under the windows named by ``codes``, for a document of n tokens."""
    if not codes.is_valid or not n:
        return np.zeros(n, bool)
    at, count, _ = _decode(codes.values.to_numpy())
    at = np.minimum(at, n)
    return K.covered(n, at, np.minimum(at + count - 1 + width, n))
