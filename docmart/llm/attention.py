"""Operator 3: quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Each passage is
encoded as the frequencies of pairs of neighbouring character classes, the share of words that
it repeats, and its length; a small network turns that into a representation,
gated attention (a tanh branch times a sigmoid branch) weighs the passages of the
document, and the weighted sum is scored.  Only document labels are used; the attention
learns which passages show the label.

Encoding and scoring run in Spark tasks over whole texts.  Training fits the few
thousand weights on the driver, on a bounded sample of labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import batch

PASSAGE_WORDS = 128
#: The bound on the training sample, in documents and in passages of all of them; a document is taken whole or not at all.
TRAIN_DOCS, TRAIN_PASSAGES = 6000, 6000 * 64
HELD_OUT_OF = 5
THRESHOLD = 0.3

_CLASSES = np.full(256, 6, np.uint8)  # other printable signs
for _k, _spec in enumerate(([(0x61, 0x7A)], [(0x41, 0x5A)], [(0x30, 0x39)], [(0x20, 0x20), (0x09, 0x0D)], [(0x80, 0xFF)], [(0x2C, 0x2C), (0x2E, 0x2E), (0x27, 0x27)])):
    _CLASSES[K.byte_class(_spec)] = _k
_CLASSES[K.byte_class([(0x21, 0x21), (0x3F, 0x3F)])] = 7
WIDTH = 64 + 2


def encode(s: K.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a slice, and where each document's passages begin; each document has at least one."""
    w = s.words(K.SPACED_WORD)
    first = w.first()
    n_words = np.diff(first)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    at = np.concatenate(([0], np.cumsum(n_passages)))
    place = at[w.doc] + (np.arange(len(w.doc)) - first[w.doc]) // PASSAGE_WORDS
    x = np.zeros((at[-1], WIDTH), np.float32)
    if len(w.doc):
        begins = np.concatenate(([True], place[1:] != place[:-1]))
        start = w.start[begins]
        stop = np.concatenate((start[1:], [0]))
        last = np.concatenate((w.doc[begins][1:] != w.doc[begins][:-1], [True]))
        stop[last] = s.ends[w.doc[begins][last]]
        of = place[begins]
        row = np.repeat(of, stop - start)
        own = K.covered(len(s.data), start, stop)
        c = _CLASSES[s.data]
        pair = c.astype(np.int64) * 8
        pair[:-1] += c[1:]
        ends = s.ends[s.ends > s.starts] - 1  # behind a document's last byte stands a blank, not the next document
        pair[ends] = c[ends].astype(np.int64) * 8 + _CLASSES[0x20]
        counts = np.bincount(row * 64 + pair[own], minlength=at[-1] * 64).reshape(-1, 64)
        x[:, :64] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
        names = w.hashes() ^ K.mix(place.astype(np.uint64))
        distinct = np.unique(names, return_index=True)[1]
        words = np.bincount(place, minlength=at[-1])
        x[:, 64] = (words - np.bincount(place[distinct], minlength=at[-1])) / np.maximum(words, 1)
        x[:, 65] = np.log1p(words)
    return x, at


@dataclass
class Model:
    """Weights of the encoder (w, b), the attention branches (v, u, a) and the score (z, z0), and the scaling of features."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, at: np.ndarray):
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-h @ p["u"]))
        e = (t * g) @ p["a"]
        begin = at[:-1]
        size = np.diff(at)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), size))
        alpha = e / np.repeat(np.add.reduceat(e, begin), size)
        bag = np.add.reduceat(alpha[:, None] * h, begin, axis=0)
        return x, h, t, g, alpha, bag, 1 / (1 + np.exp(-(bag @ p["z"] + p["z0"])))

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """In double precision and rounded, so that a score does not depend on the other documents of the slice."""
        return np.round(self.forward(x.astype(np.float64), at)[-1], 9)

    def gradients(self, x: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of the bags, with respect to each weight."""
        p, size = self.p, np.diff(at)
        xs, h, t, g, alpha, bag, out = self.forward(x, at)
        d = ((out - y) / len(y)).astype(x.dtype)
        d_bag = np.repeat(d[:, None] * p["z"], size, axis=0)
        d_alpha = (d_bag * h).sum(1)
        d_e = alpha * (d_alpha - np.repeat(np.add.reduceat(alpha * d_alpha, at[:-1]), size))
        d_t, d_g = d_e[:, None] * p["a"] * g, d_e[:, None] * p["a"] * t
        d_t, d_g = d_t * (1 - t * t), d_g * g * (1 - g)
        d_h = (alpha[:, None] * d_bag + d_t @ p["v"].T + d_g @ p["u"].T) * (1 - h * h)
        return {"w": xs.T @ d_h, "b": d_h.sum(0), "v": h.T @ d_t, "u": h.T @ d_g, "a": (t * g).T @ d_e, "z": bag.T @ d, "z0": d.sum(keepdims=True)}


def fit(x: np.ndarray, at: np.ndarray, y: np.ndarray, hidden: int = 32, gates: int = 16, epochs: int = 60, seed: int = 11) -> Model:
    """Adam on the log loss, in mini-batches of bags."""
    r = np.random.Generator(np.random.PCG64(seed))
    shape = {"w": (x.shape[1], hidden), "b": (hidden,), "v": (hidden, gates), "u": (hidden, gates), "a": (gates,), "z": (hidden,), "z0": (1,)}
    p = {k: (r.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "az" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    model = Model(x.mean(0), x.std(0) + 1e-3, p)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(y))
        for i in range(0, len(y), 256):
            pick = np.sort(order[i : i + 256])
            size = np.diff(at)[pick]
            rows = np.repeat(at[pick], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            own = np.concatenate(([0], np.cumsum(size)))
            step += 1
            for k, v in model.gradients(x[rows], own, y[pick]).items():
                v = v + 1e-4 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                p[k] -= (0.004 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


_BAG = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("x", pa.binary())])
_SIZE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64())])


def _sizes(batches):
    """The number of passages of each document."""
    for b in batches:
        for s in K.slices(b.column(1)):
            n_words = np.diff(s.words(K.SPACED_WORD).first())
            yield batch(_SIZE, b.column(0).take(pa.array(s.rows)), np.maximum(1, -(-n_words // PASSAGE_WORDS)))


def _bags(batches):
    for b in batches:
        ids, quality = b.column(0), b.column(2)
        for s in K.slices(b.column(1)):
            x, at = encode(s)
            rows = pa.array(s.rows)
            yield batch(_BAG, ids.take(rows), quality.take(rows), [x[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(HELD_OUT_OF)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES) -> Model:
    """Fit on at most ``train_docs`` labelled documents that are not held out, chosen by a hash of the id, of ``train_passages`` passages together."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
    sizes = sample.mapInArrow(_sizes, "doc_id long, n long").groupBy("doc_id").agg(F.sum("n").alias("n")).select("doc_id", "n", F.xxhash64("doc_id").alias("place")).collect()
    total, fit_in = 0, []
    for r in sorted(sizes, key=lambda r: (r["place"], r["doc_id"])):
        total += r["n"]
        if fit_in and total > train_passages:
            break
        fit_in.append(r["doc_id"])
    if len(fit_in) < len(sizes):
        sample = sample.join(F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in fit_in], "doc_id long")), "doc_id", "left_semi")
    rows = sample.mapInArrow(_bags, "doc_id long, quality int, x binary").collect()
    bags = sorted((r["doc_id"], r["quality"], bytes(r["x"])) for r in rows)
    if len({q for _, q, _ in bags}) < 2:  # nothing to tell apart: the score is the share of label 1, or a half
        share = (sum(q for _, q, _ in bags) + 1) / (len(bags) + 2)
        zero = {k: np.zeros(s, np.float32) for k, s in {"w": (WIDTH, 1), "b": (1,), "v": (1, 1), "u": (1, 1), "a": (1,), "z": (1,)}.items()}
        return Model(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), zero | {"z0": np.array([np.log(share / (1 - share))], np.float32)})
    parts = [np.frombuffer(x, np.float32).reshape(-1, WIDTH) for _, _, x in bags]
    at = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
    return fit(np.concatenate(parts), at, np.array([q for _, q, _ in bags], np.float32))


_SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    Scores depend on the text alone, all of it however long, and not on what else is scored with it.  Labels with a null or other quality than 0
    and 1 are ignored; a document labelled both ways counts as 0.  A null or empty text is
    one empty passage and has a score too.  Without labels of both kinds the score is
    the same for all.  Null ids are scored and not held out; repeated rows get equal scores; an empty table gives an empty one; other columns, also of
    the result's names, are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = train(docs, labels, train_docs)

    def run(batches):
        for b in batches:
            for s in K.slices(b.column(1)):
                yield batch(_SCORE, b.column(0).take(pa.array(s.rows)), model.score(*encode(s)))

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``threshold``.

    Cases as in :func:`quality_scores`: a null or empty text is scored as one empty passage, rows with null ids or
    repeated rows each by their own text, columns of any other name pass through, and an empty table gives an empty one.
    """
    model = train(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), labels, train_docs)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            keep = [model.score(*encode(s)) >= threshold for s in K.slices(b.column(place))]
            yield b.filter(pa.array(np.concatenate(keep))) if keep else b

    return docs.mapInArrow(run, docs.schema)


def op3_attention(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
