"""Operator 1: near-duplicates by improved consistent weighted sampling.

Shingles are ``SHINGLE`` consecutive words, weighted by TF-IDF: how often the
document has the shingle, times the mean inverse document frequency of its words.
Word frequencies are counted over all documents in a hashed table of fixed size.
Improved consistent weighted sampling (Ioffe 2010) draws samples that two documents
share with a probability equal to their weighted Jaccard similarity; bands of
samples propose candidates, and each proposal is verified by the exact similarity.

Documents with the same words collapse to one representative first.  Then links are found in three
steps, each of which leaves out what the one before has connected, so that their number grows with the documents
of a group and not with its pairs:

1. Each document is verified against one leader, the most connected member of all its buckets.
2. In buckets that still hold several classes, each document outside the largest class is verified against
   the one of another class that shares most samples with it.
3. What is then still outside is verified against all members of other classes that share enough samples, in
   blocks: a block's texts are sent to a task once, where all its pairs are verified.

Buckets that need more than ``COMPARED`` comparisons of samples are replaced by smaller ones in which all pairs that share
enough samples still meet (``refined``), so the same pairs are verified whatever a bucket's size.  Which of two texts is
verified against the other may differ by that; their similarity is the same from either side.  Links are joined to
classes by star contraction on Spark tables.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import batch, cut, fitted, ids_of

SHINGLE, SIMILARITY = 5, 0.8
#: Decimals of a shingle's mean inverse document frequency.
DECIMALS = 4
#: Samples of a document, and how many make a band. Bands are the pieces of ``DEALS`` random orders of the samples, so a sample serves in several.
SAMPLES, ROWS, DEALS = 40, 5, 3
#: A pair is verified if it shares so many samples: at a similarity of 0.8 it shares fewer in 2 of 1000 cases.
AGREE = 24
#: Documents that are verified against one leader in a group; open members and members of any kind of a block, and their bytes of text.
GROUP, OPEN_BLOCK, BLOCK, BLOCK_BYTES = 256, 512, 1024, 4 << 20
#: A bucket that needs more comparisons of samples is replaced by smaller ones if they need at most half as many. It bounds time and no result.
COMPARED = 1 << 28
#: Samples that this part of the documents or more have are put in order by how many have them, others by their names.
OFTEN = 1 << 12
#: Hashed table of word frequencies, and the pieces in which tasks send their counts.
DF_BITS, DF_BLOCK = 18, 1 << 12
#: Random draws of the sampler are taken from a pool by a hash of (sample, shingle).
_POOL_BITS = 16
_pool_rng = np.random.Generator(np.random.PCG64(20240902))
_R = _pool_rng.gamma(2, 1, 1 << _POOL_BITS).astype(np.float32) + np.float32(1e-6)
_LN_C = np.log(_pool_rng.gamma(2, 1, 1 << _POOL_BITS)).astype(np.float32)
_BETA = _pool_rng.random(1 << _POOL_BITS).astype(np.float32)
_R_INV = (1 / _R).astype(np.float32)
_ODD = _pool_rng.integers(1, 1 << 62, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _words(s: K.Slice) -> K.Words:
    return s.words(K.PLAIN_WORD, lower=True)


def _term(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - DF_BITS)).astype(np.int64)


_COUNTS = pa.schema([("block", pa.int32()), ("counts", pa.binary())])


def _count_terms(batches):
    """The number of documents with each term, and, as a last block, of documents with words."""
    total, docs = np.zeros(1 << DF_BITS, np.int64), 0
    for b in batches:
        for s in K.slices(b.column(0)):
            w = _words(s)
            pairs = np.unique((w.doc.astype(np.int64) << DF_BITS) | _term(w.hashes()))
            total += np.bincount(pairs & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
            docs += len(np.unique(w.doc))
    blocks = [k for k in range((1 << DF_BITS) // DF_BLOCK) if total[k * DF_BLOCK : (k + 1) * DF_BLOCK].any()]
    yield batch(_COUNTS, [*blocks, -1], [*(total[k * DF_BLOCK : (k + 1) * DF_BLOCK].tobytes() for k in blocks), np.int64(docs).tobytes()])


def _add_counts(batches):
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(x, np.int64)
    if sums:
        yield batch(_COUNTS, [*sums], [x.tobytes() for x in sums.values()])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The smoothed IDF of each hashed term over all documents: ln((1 + N) / (1 + n)) + 1."""
    kind = "block int, counts binary"
    rows = docs.select("text").mapInArrow(_count_terms, kind).repartition("block").mapInArrow(_add_counts, kind).collect()  # a table of fixed size
    total, n = np.zeros(1 << DF_BITS, np.int64), 0
    for r in rows:
        x = np.frombuffer(bytes(r["counts"]), np.int64)
        if r["block"] < 0:
            n = int(x[0])
        else:
            total[r["block"] * DF_BLOCK : (r["block"] + 1) * DF_BLOCK] = x
    return (np.log((1 + n) / (1 + total)) + 1).astype(np.float32)


def weighted_shingles(w: K.Words, idf: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle) in that order, with TF-IDF weights; a document with fewer words is one shingle."""
    names = w.hashes()
    first = w.first()
    idfs = np.concatenate(([0.0], np.cumsum(idf[_term(names)], dtype=np.float64)))
    n_words = np.diff(first)
    start = np.arange(len(names))
    whole = start[start + size <= first[1:][w.doc]] if len(names) else start
    short = first[:-1][(n_words > 0) & (n_words < size)]
    start = np.concatenate((whole, short))
    end = np.concatenate((whole + size, short + n_words[w.doc[short]])) if len(start) else start
    name = K.ranges(K.prefix(names), start, end)
    doc = w.doc[start]
    order = np.lexsort((name, doc))
    name, doc, start, end = name[order], doc[order], start[order], end[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(name)))
    # the mean is rounded so that it is the same wherever in a slice the shingle stands
    weight = times * np.round((idfs[end[at]] - idfs[start[at]]) / (end[at] - start[at]), DECIMALS)
    return doc[at], name[at], weight


def samples(doc: np.ndarray, name: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """The consistent weighted samples of each document, one row for each of ``count`` draws."""
    begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    ln_w = np.log(weight).astype(np.float32)
    low = name & np.uint64(0xFFFFFFFF)
    out = np.empty((count, len(begin)), np.uint64)
    for j in range(count):
        at = ((name * _ODD[j]) >> np.uint64(64 - _POOL_BITS)).astype(np.int64)
        r = _R[at]
        t = np.floor(ln_w * _R_INV[at] + _BETA[at])
        ln_a = _LN_C[at] - r * (t - _BETA[at] + np.float32(1))
        bits = ln_a.view(np.int32)
        key = (bits ^ ((bits >> 31) | np.int32(-(1 << 31)))).view(np.uint32).astype(np.uint64) << np.uint64(32)
        key |= (low + t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        out[j] = np.minimum.reduceat(key, begin)
    return out & np.uint64(0xFFFFFFFF)


_SKETCH = pa.schema([("doc", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("bytes", pa.int64()), ("drawn", pa.list_(pa.int32()))])


def _sketch(idf: np.ndarray, size: int):
    def run(batches):
        for b in batches:
            ids = ids_of(b.column(0))
            for s in K.slices(b.column(1)):
                w = _words(s)
                if not len(w.doc):
                    continue
                doc, name, weight = weighted_shingles(w, idf, size)
                drawn = np.ascontiguousarray(samples(doc, name, weight, SAMPLES).T.astype(np.uint32)).view(np.int32)
                have = np.unique(doc)
                first = w.first()
                h = [K.ranges(K.prefix(w.hashes(t)), first[have], first[have + 1]).view(np.int64) for t in (0, 1)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, drawn.size + 1, SAMPLES), pa.int32()), pa.array(drawn.ravel()))
                yield batch(_SKETCH, ids[s.rows[have]], *h, (s.ends - s.starts)[have], lists)

    return run


_deal = np.random.Generator(np.random.PCG64(20240903))
#: The samples of each band.
BANDS = np.concatenate([_deal.permutation(SAMPLES) for _ in range(DEALS)]).reshape(-1, ROWS)


def band_keys(drawn: Column) -> Column:
    """The names of a document's bands."""
    return F.array(*[F.xxhash64(F.lit(k), *[drawn[int(i)] for i in own]) for k, own in enumerate(BANDS)])


def rarest_first(drawn: DataFrame) -> DataFrame:
    """(doc, tokens, bits): the names of each document's samples in one order for all documents, rare ones first, and 2 to the number of each."""
    drawn, n = fitted(drawn)
    tokens = F.array(*[F.struct(F.xxhash64(F.lit(j), F.col("drawn")[j]).alias("token"), F.lit(1 << j).cast("long").alias("bit")) for j in range(SAMPLES)])
    named = drawn.select("doc", F.inline(tokens))
    often = named.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= max(2, n // OFTEN))  # at most 1.5 * SAMPLES * OFTEN
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("m", F.lit(0)).alias("m"), "token", "bit"))).alias("t")
    return named.join(F.broadcast(often), "token", "left").groupBy("doc").agg(order).select("doc", F.col("t.token").alias("tokens"), F.col("t.bit").alias("bits"))


def refined_keys(tokens: Column, key: Column, step: int, after: Column | None = None) -> Column:
    """The names of the smaller buckets of a member of a large bucket, by its tokens behind the place ``after``.

    Tokens stand in one order for all documents.  Of two documents that share ``AGREE`` of ``SAMPLES`` or more, the first ``step``
    tokens that they share are among the first ``SAMPLES - AGREE + step`` of both, so both have the bucket named by these.
    """
    after = F.lit(-1) if after is None else after
    rest = F.slice(tokens, after + 2, F.lit(SAMPLES - AGREE + step - 1) - after)
    return F.transform(rest, lambda token: F.xxhash64(key, token))


_CANDIDATE = pa.schema([("doc", pa.int64()), ("other", pa.int64()), ("shared", pa.int32())])
_NEEDED = pa.schema([("gid", pa.int64()), ("band", pa.int32()), ("doc", pa.int64()), ("c", pa.int64()), ("own", pa.bool_()), ("is_open", pa.bool_()), ("seen", pa.int64())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@dataclass
class Members:
    """One side of a block: documents, their classes so far, whether each is open, their samples, and for a refined bucket ``seen``.

    That has bits for the samples up to the last token that names the bucket, in the document's order, and above them the number of these tokens.
    """

    doc: np.ndarray
    c: np.ndarray
    is_open: np.ndarray
    drawn: np.ndarray
    seen: np.ndarray | None = None

    def pick(self, rows: np.ndarray) -> Members:
        return Members(self.doc[rows], self.c[rows], self.is_open[rows], self.drawn[rows], None if self.seen is None else self.seen[rows])


def shared_samples(x: Members, y: Members) -> np.ndarray:
    """How many samples each document of one side shares with each of the other; 0 within a class."""
    shared = np.zeros((len(x.doc), len(y.doc)), np.int8)
    for j in range(SAMPLES):
        shared += x.drawn[:, j][:, None] == y.drawn[:, j][None, :]
    shared[x.c[:, None] == y.c[None, :]] = 0
    return shared


def to_verify(x: Members, y: Members, band: int) -> np.ndarray:
    """The pairs of a block that share enough samples, each in one block only: that of the first band that both share, of the first tokens that both share if the bucket is refined, and once of two open ones."""
    take = shared_samples(x, y) >= AGREE
    take &= ~(y.is_open[None, :] & (x.doc[:, None] >= y.doc[None, :]))
    seen = x.seen if x.seen is not None and x.seen.any() else None
    if band > 0 or seen is not None:
        i, j = np.nonzero(take)
        for at in range(0, len(i), 1 << 15):
            k, m = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
            same = x.drawn[k] == y.drawn[m]
            before = np.zeros(len(k), bool)
            for own in BANDS[:band]:
                before |= same[:, own].all(1)
            if seen is not None:
                before |= (same & (seen[k, None] >> np.arange(SAMPLES) & 1).astype(bool)).sum(1) != seen[k] >> SAMPLES
            take[k[before], m[before]] = False
    return take


def _blocks(pick):
    """Apply ``pick`` to the two sides of each block of (gid, band, members)."""

    def run(batches):
        for b in batches:
            for gid, band, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                m = members.values
                flag = lambda name: m.field(name).to_numpy(zero_copy_only=False)
                every = Members(m.field("doc").to_numpy(), m.field("c").to_numpy(), flag("is_open"), m.field("drawn").flatten().to_numpy().reshape(-1, SAMPLES), m.field("seen").to_numpy())
                own = flag("own")
                yield from pick(every.pick(np.flatnonzero(own)), every.pick(np.flatnonzero(~own)), band, gid)

    return run


def _best_partner(x: Members, y: Members, band: int, gid: int):
    for k in range(0, len(x.doc), 64):
        part = x.pick(np.arange(k, min(k + 64, len(x.doc))))
        shared = shared_samples(part, y)
        if shared.size:
            top = shared.argmax(1)
            most = shared[np.arange(len(top)), top]
            found = most >= AGREE
            yield batch(_CANDIDATE, part.doc[found], y.doc[top[found]], most[found])


def _needed(x: Members, y: Members, band: int, gid: int):
    """The members of a block that are in some pair to verify; only their texts are sent."""
    mine, others = np.zeros(len(x.doc), bool), np.zeros(len(y.doc), bool)
    for k in range(0, len(x.doc), 64):
        take = to_verify(x.pick(np.arange(k, min(k + 64, len(x.doc)))), y, band)
        mine[k : k + 64] = take.any(1)
        others |= take.any(0)
    for side, keep, own in ((x, mine, True), (y, others, False)):
        n = int(keep.sum())
        yield batch(_NEEDED, np.full(n, gid), np.full(n, band), side.doc[keep], side.c[keep], np.full(n, own), side.is_open[keep], side.seen[keep])


def units(weight: np.ndarray) -> np.ndarray:
    """Weights as whole numbers of their last decimal, whose sums are exact in any order."""
    return np.rint(weight * 10**DECIMALS)


class Others:
    """The weighted shingles of one side of a group, by shingle."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.index = None

    def add(self, doc: int, c: int, is_open: bool, drawn: np.ndarray | None, name: np.ndarray, weight: np.ndarray) -> None:
        self.parts.append((doc, c, is_open, drawn, name, units(weight)))

    def ready(self, masked: bool) -> None:
        if self.index is not None:
            return
        doc, c, is_open, drawn, names, weights = zip(*self.parts, strict=True)
        self.parts = []
        self.side = Members(np.array(doc), np.array(c), np.array(is_open), np.stack(drawn) if masked else np.empty(0))
        row = np.repeat(np.arange(len(doc)), [len(x) for x in names])
        name, weight = np.concatenate(names), np.concatenate(weights)
        self.total = np.bincount(row, weight, minlength=len(doc))
        order = np.argsort(name, kind="stable")
        self.row, self.weight = row[order], weight[order]
        self.index, at = np.unique(name[order], return_index=True)
        self.at = np.append(at, len(name))

    def similarity(self, name: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of each to the given shingles: the same from either side, and at the bound exactly."""
        weight = units(weight)
        place = np.minimum(np.searchsorted(self.index, name), len(self.index) - 1)
        met = self.index[place] == name
        place, own = place[met], weight[met]
        size = self.at[place + 1] - self.at[place]
        entry = np.repeat(self.at[place] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        least = np.bincount(self.row[entry], np.minimum(np.repeat(own, size), self.weight[entry]), minlength=len(self.total))
        return least / np.maximum(self.total + weight.sum() - least, 1e-12)


def _verify(idf: np.ndarray, size: int, least: float, masked: bool):
    """Links within groups: rows (gid, own, band, doc, c, is_open, seen, drawn, text) in the order of gid, own and doc.

    Each row that is ``own`` is verified against the others of its group, which come first,
    and linked with the most similar one of each other class.  ``masked`` leaves out pairs by their samples.
    """

    def run(batches):
        gid, others, last = None, Others(), None
        for b in batches:
            gids, own, bands, docs, cs, opens, seen = (b.column(k).to_numpy(zero_copy_only=False) for k in range(7))
            found: list[tuple[int, int]] = []
            for s in K.slices(b.column(8)):
                in_slice, name, weight = weighted_shingles(_words(s), idf, size)
                at = np.searchsorted(in_slice, np.arange(len(s.rows) + 1))
                for k, r in enumerate(s.rows):
                    if gids[r] != gid:
                        gid, others = gids[r], Others()
                    x = slice(at[k], at[k + 1])
                    if at[k] == at[k + 1] or last == (gid, own[r], docs[r]):  # a repeated row
                        continue
                    last = (gid, own[r], docs[r])
                    drawn = b.column(7)[int(r)].values.to_numpy() if masked else None
                    if not own[r]:
                        others.add(docs[r], cs[r], opens[r], drawn, name[x], weight[x])
                        continue
                    if others.index is None and not others.parts:
                        continue
                    others.ready(masked)
                    side = others.side
                    if masked:
                        me = Members(docs[r : r + 1], cs[r : r + 1], opens[r : r + 1], drawn[None, :], seen[r : r + 1])
                        take = to_verify(me, side, int(bands[r]))[0]
                    else:
                        take = side.c != cs[r]
                    if not take.any():
                        continue
                    alike = np.where(take, others.similarity(name[x], weight[x]), -1.0)
                    ok = np.flatnonzero(alike >= least)
                    ok = ok[np.argsort(-alike[ok], kind="stable")]
                    for m in ok[np.unique(side.c[ok], return_index=True)[1]]:
                        found.append((int(docs[r]), int(side.doc[m])))
            if found:
                a, z = np.array(found).T
                yield batch(_LINK, np.maximum(a, z), np.minimum(a, z))

    return run


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to (node, class): each node's least connected node, for all nodes with a link.

    Alternates large-star and small-star contraction (Kiveris et al. 2014) until nothing changes.
    """

    def star(e: DataFrame, both: bool) -> DataFrame:
        e = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else e
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(least, "u")
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")) if both else joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(joined.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e, _ = fitted(cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()))
    before = mark(e)
    while before[0]:
        e, _ = fitted(cut(star(star(e, True), False)))
        now = mark(e)
        if now == before:
            break
        before = now
    labels = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class"))
    return labels.unionByName(labels.select(F.col("class").alias("node"), "class").distinct())


def joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (node, class) after more links: only the classes that the links touch are contracted."""
    at = lambda side: label.select(F.col("node").alias(side), F.col("class").alias(f"c_{side}"))
    e = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    moved = components(e).select(F.col("node").alias("class"), F.col("class").alias("into"))
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    old = label.unionByName(nodes.join(label, "node", "left_anti").select("node", F.col("node").alias("class")))
    return fitted(cut(old.join(moved, "class", "left").select("node", F.coalesce("into", "class").alias("class"))))[0]


def leaders(open_: DataFrame) -> DataFrame:
    """(doc, leader, n): of the leaders of all its buckets (the member with the highest score) the one with the highest, and that bucket's size."""
    top = open_.groupBy("key").agg(F.max(F.struct("score", (-F.col("doc")).alias("less"))).alias("top"))
    led = open_.join(top, "key").where(F.col("doc") != -F.col("top.less"))
    best = led.groupBy("doc").agg(F.max(F.struct("top.score", "top.less", "n")).alias("t"))
    return best.select("doc", (-F.col("t.less")).alias("leader"), F.col("t.n").alias("n"))


def unsettled(open_: DataFrame, label: DataFrame, *more: str) -> tuple[DataFrame, int]:
    """Members of the buckets of several classes, with ``more`` columns; those outside the bucket's largest class are open. u and n count open ones and all."""
    rows = open_.select("key", "band", "doc", "bytes", *more).join(label.select(F.col("node").alias("doc"), "class"), "doc", "left").withColumn("c", F.coalesce("class", "doc"))
    kinds = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("size"))
    lead = F.max(F.struct("m", "c", "size")).alias("lead")
    counts = kinds.groupBy("key").agg(F.sum("m").alias("n"), F.sum("size").alias("n_bytes"), lead, F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    counts = counts.select("key", "n", "n_bytes", (F.col("n") - F.col("lead.m")).alias("u"), (F.col("n_bytes") - F.col("lead.size")).alias("u_bytes"), F.col("lead.c").alias("lead"))
    return fitted(cut(rows.join(counts, "key").withColumn("is_open", F.col("c") != F.col("lead")).drop("lead", "class")))


def refined(rows: DataFrame, label: DataFrame, drawn: DataFrame) -> DataFrame:
    """The same table, and ``seen``, with large buckets replaced by smaller ones in which all pairs of several classes that share ``AGREE`` samples still meet.

    A step replaces each bucket of more than ``COMPARED`` comparisons by one for each token behind those that name it; one whose
    smaller ones need more than half of its comparisons stays whole.  Of buckets of the same members the one of the first token stays: it
    has what the first tokens that two of them share.
    """
    work = F.col("u") * F.col("n")
    rows = rows.withColumn("seen", F.lit(0).cast("long"))
    found = rows.where(work > COMPARED)
    if found.isEmpty():
        return rows
    tokens = cut(rarest_first(cut(drawn.join(found.select("doc").distinct(), "doc", "left_semi"))))
    rows = rows.withColumn("after", F.lit(-1)).withColumn("whole", F.lit(False))
    for step in range(1, AGREE + 1):
        large = (work > COMPARED) & ~F.col("whole")
        found = rows.where(large)
        if found.isEmpty():
            break
        names = refined_keys(F.col("tokens"), F.col("key"), step, F.col("after"))
        keys = found.join(tokens, "doc").select("doc", "bytes", "band", "c", "is_open", F.col("key").alias("parent"), "after", "bits", F.posexplode(names).alias("k", "key"))
        keys = keys.withColumn("after", F.col("after") + 1 + F.col("k")).join(keys.where("is_open").select("key").distinct(), "key", "left_semi")
        print_ = F.sum(F.xxhash64("doc").cast("decimal(20,0)")).alias("print")
        met = keys.groupBy("parent", "key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m"), print_, F.sum("after").alias("at"))
        again = met.where("lo <> hi").groupBy("parent", "m", "print").agg(F.min(F.struct("at", "key")).alias("t")).select(F.col("t.key").alias("key"))
        seen = F.aggregate(F.slice("bits", 1, F.col("after") + 1), F.lit(step << SAMPLES).cast("long"), lambda x, bit: x + bit)
        smaller, _ = unsettled(keys.join(again, "key").withColumn("seen", seen), label, "parent", "after", "seen")
        needs = smaller.groupBy("parent", "key").agg(F.max(work).alias("work")).groupBy("parent").agg(F.sum("work").alias("then"))
        now = found.groupBy(F.col("key").alias("parent")).agg(F.max(work).alias("now"))
        split = cut(now.join(needs, "parent", "left").where(2 * F.coalesce("then", F.lit(0)) <= F.col("now")).select("parent"))
        stay = found.join(split.withColumnRenamed("parent", "key"), "key", "left_anti").withColumn("whole", F.lit(True))
        smaller = smaller.join(split, "parent", "left_semi").withColumn("whole", F.lit(False)).drop("parent")
        rows, _ = fitted(cut(rows.where(~large).unionByName(stay).unionByName(smaller)))
    return rows.drop("after", "whole")


def blocks(rows: DataFrame, drawn: DataFrame) -> DataFrame:
    """(gid, band, members): each block of a bucket's open members with each block of all its members; a block's size is bounded in members and in bytes of text."""
    parts = lambda side, of: F.ceil(F.greatest(F.col(side) / of, F.col(f"{side}_bytes") / BLOCK_BYTES))
    deal = lambda of, salt: F.pmod(F.xxhash64("doc", F.lit(salt)), of)
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), of - 1))
    i, j = parts("u", OPEN_BLOCK), parts("n", BLOCK)
    same = ["key", "band", "doc", "c", "is_open", "seen"]
    open_side = rows.where("is_open").select(*same, F.lit(True).alias("own"), deal(i, 1).alias("i"), every(j).alias("j"))
    all_side = rows.select(*same, F.lit(False).alias("own"), every(i).alias("i"), deal(j, 2).alias("j"))
    both = open_side.unionByName(all_side).join(drawn, "doc")
    grouped = both.groupBy("key", "i", "j").agg(F.first("band").alias("band"), F.collect_list(F.struct("doc", "c", "own", "is_open", "seen", "drawn")).alias("members"))
    return grouped.select(F.xxhash64("key", "i", "j").alias("gid"), "band", "members")


def similar_classes(texts: DataFrame, reps: DataFrame, idf: np.ndarray, size: int, similarity: float) -> DataFrame:
    """Classes of representatives by verified links: ``texts(doc, text)``, ``reps(doc, bytes, drawn)`` to (node, class) of all with a link."""
    buckets = reps.select("doc", "bytes", F.posexplode(band_keys(F.col("drawn"))).alias("band", "key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    open_ = buckets.join(sizes, "key")
    score = open_.groupBy("doc").agg(F.sum(F.round(64 * F.log2("n")).cast("long")).alias("score"))
    open_, _ = fitted(cut(open_.join(score, "doc")))

    def verify(groups: DataFrame, masked: bool = False) -> DataFrame:
        drawn = F.col("drawn") if masked else F.lit(None).cast("array<int>").alias("drawn")
        rows = groups.join(texts, "doc").select("gid", "own", "band", "doc", "c", "is_open", "seen", drawn, "text")
        rows = rows.repartition("gid").sortWithinPartitions("gid", "own", "doc")
        return fitted(cut(rows.mapInArrow(_verify(idf, size, similarity, masked), "a long, b long")))[0]

    def against(pairs: DataFrame, other: str, parts: Column) -> DataFrame:
        """Groups of one ``other`` and a part of the documents that are verified against it, so its text is sent once for many."""
        gid = F.xxhash64(other, parts, F.pmod(F.xxhash64("doc"), parts)).alias("gid")
        plain = [F.lit(0).alias("band"), F.col("doc").alias("c"), F.lit(False).alias("is_open"), F.lit(0).cast("long").alias("seen")]
        mine = pairs.select(gid, "doc", F.lit(True).alias("own")).unionByName(pairs.select(gid, F.col(other).alias("doc"), F.lit(False).alias("own")).distinct())
        return mine.select("gid", "doc", "own", *plain)

    # 1: each document against its leader
    label = components(verify(against(leaders(open_), "leader", F.ceil(F.col("n") / GROUP))))
    left, n = unsettled(open_, label)
    if not n:
        return label
    wanted = left.select("doc").distinct()
    drawn, _ = fitted(cut(reps.select("doc", "drawn").join(wanted, "doc", "left_semi")))
    texts = cut(texts.join(drawn, "doc"))
    left = refined(left, label, drawn)
    # 2: each open document against the one of another class that shares most samples
    partner = blocks(left, drawn).mapInArrow(_blocks(_best_partner), "doc long, other long, shared int")
    partner = partner.groupBy("doc").agg(F.max(F.struct("shared", "other")).alias("t")).select("doc", F.col("t.other").alias("other"))
    label = joined(label, verify(against(partner, "other", F.lit(16))))
    # 3: what is still open, against all members of other classes that share enough samples
    left, n = unsettled(left, label, "seen")
    if not n:
        return label
    needed = blocks(left, drawn).mapInArrow(_blocks(_needed), "gid long, band int, doc long, c long, own boolean, is_open boolean, seen long")
    return joined(label, verify(needed, masked=True))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id: the least id of all documents connected by links of at least ``similarity``.

    Words are lower-cased runs of letters, digits and non-ASCII characters, so
    texts that differ in case and punctuation only are copies.  With fewer than ``shingle`` words all
    words are one shingle.  A null text, or one without words, is like no other
    and has a class of its own; a null id has a null class and takes no part.
    All shingles of a text take part, however long it is.  Repeated rows give repeated results; an id with several
    texts is compared by one of them; an empty table gives an empty one.  Other columns, of any name, are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    known = docs.where("doc is not null")
    idf = inverse_frequencies(known)
    sketches = cut(known.mapInArrow(_sketch(idf, shingle), "doc long, h1 long, h2 long, bytes long, drawn array<int>"))
    reps = cut(sketches.groupBy("h1", "h2").agg(F.min(F.struct("doc", "bytes", "drawn")).alias("r")).select("h1", "h2", F.col("r.doc").alias("rep"), "r.bytes", "r.drawn"))
    label = similar_classes(known, reps.select(F.col("rep").alias("doc"), "bytes", "drawn").dropDuplicates(["doc"]), idf, shingle, similarity)
    members = sketches.join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).select("doc", "rep").distinct()
    classes = members.join(label.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc").agg(F.min(F.coalesce("class", "rep")).alias("class"))
    out = docs.select("doc").join(classes, "doc", "left")
    return out.select(F.col("doc").alias("doc_id"), F.coalesce("class", "doc").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, that of the least id, with all its columns.

    Rows with a null id all stay.  Of rows with the same id and text one stays; rows with the same id and
    different texts stay together or go together.
    """
    classes = near_duplicates(docs, id_col, text_col, **options)
    kept = classes.where("doc_id = class_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(kept, id_col, "left_semi").dropDuplicates([id_col, text_col]).select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def op1_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
