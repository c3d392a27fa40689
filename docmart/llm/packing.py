"""Operator 12: best-fit packing by a configuration linear program over the length histogram.

Only the histogram of piece lengths, a number for each length up to the capacity, comes to the driver,
whatever the size of the corpus.  A configuration is a set of lengths that fits into one sequence.  The linear
program asks for the fewest configurations that cover every length as often as it
occurs; multiplicative weights solve it: each round prices lengths by their
weights, a knapsack table gives the best configuration around every length, all
that are nearly as good as the best are played, and weights fall as coverage rises.  The
plays are rounded to whole numbers, carrying the fractions on, and what rounding leaves is put
where it fits best.

The plan is a list of slots: the pieces of one length, numbered, fill the
sequences in order.  Numbers are given within 256 shares of a length, so that no
length, however common, is numbered by one task; the plan and the shares'
starts are tables whose size the capacity bounds, and every task holds them.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import batch, kept

CAPACITY, EOS = 2048, 0
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Rounds of multiplicative weights, their step, and how full and how near to the best value a played configuration is at least.
ROUNDS, STEP, NEAR = 8, 0.1, 0.999
#: Configurations that a length starts in a round, at most.
TRIES = 8
#: Roundings that are tried: which share of the program's uses is rounded, before best fit has the rest.
SHARES_KEPT = (1.0, 0.5, 0.25, 0.125)
#: Pieces of a length are numbered in so many shares.
SHARES = 256


def knapsack(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each size up to the capacity, the best value of lengths that fit, and the length to take first (0: none)."""
    capacity = len(price) - 1
    value, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sizes = np.flatnonzero(price > 0)
    for room in range(1, capacity + 1):
        fit = sizes[: np.searchsorted(sizes, room, side="right")]
        if len(fit):
            gains = price[fit] + value[room - fit]
            k = int(gains.argmax())
            value[room], first[room] = gains[k], fit[k]
    return value, first


def play(counts: np.ndarray, rounds: int = ROUNDS, step: float = STEP, near: float = NEAR) -> dict[tuple[int, ...], float]:
    """Configurations (lengths, longest first) and how often each is used, fractions allowed, to cover ``counts[length]``.

    A length is behind if it is covered less than the rounds so far ask for. In each round every length that is behind, longest first, is
    completed by others that are behind, each within ``near`` of the best value for its room; what fills less than ``near`` of a sequence waits.
    """
    capacity = len(counts) - 1
    used: dict[tuple[int, ...], float] = {}
    n = counts.astype(float)
    n[capacity] = 0  # pieces as long as a sequence have one each
    sizes = np.flatnonzero(n)
    weight, covered = np.ones(capacity + 1), np.zeros(capacity + 1)
    for r in range(rounds):
        lack = np.maximum((r + 1) / rounds * n - covered, 0)
        behind = sizes[lack[sizes] > 0]
        price = np.zeros(capacity + 1)
        price[behind] = behind * weight[behind]
        value, _ = knapsack(price)
        for leader in behind[::-1].tolist():
            for _ in range(TRIES):
                if lack[leader] <= 0:
                    break
                lengths, room = [leader], capacity - leader
                lack[leader] -= 1
                while value[room] > 0:
                    fit = behind[: np.searchsorted(behind, room, side="right")]
                    volume = np.where(price[fit] + value[room - fit] >= near * value[room], fit * lack[fit], -1)
                    k = int(volume.argmax())
                    if volume[k] <= 0:
                        break
                    length = int(fit[k])
                    lengths.append(length)
                    lack[length] -= 1
                    room -= length
                at, copies = np.unique(lengths, return_counts=True)
                lack[at] += copies
                times = float((lack[at] / copies).min())
                if times <= 0 or sum(lengths) < near * capacity:
                    break
                config = tuple(sorted(lengths, reverse=True))
                used[config] = used.get(config, 0.0) + times
                lack[at] -= times * copies
                covered[at] += times * copies
        ahead = covered[sizes] / n[sizes] - (r + 1) / rounds
        weight[sizes] *= np.exp(-step * rounds * np.clip(ahead, -1 / rounds, 0))
        weight /= weight[sizes].mean() if len(sizes) else 1
    return used


def rounded(used: dict[tuple[int, ...], float], counts: np.ndarray, share: float = 1.0) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Whole uses of configurations, none beyond what there is, and the counts that are left. ``share`` of each use is rounded."""
    left, out, carried = counts.copy(), [], 0.0
    capacity = len(counts) - 1
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    for config in sorted(used, reverse=True):
        carried += share * used[config]
        lengths, copies = np.unique(config, return_counts=True)
        times = min(int(carried), int((left[lengths] // copies).min()))
        if times:
            out.append((config, times))
            left[lengths] -= copies * times
        carried -= int(carried)
    return out, left


def best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """The rest, longest first, each length where the least room stays; sequences that look alike are handled together."""
    capacity = len(left) - 1
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    present = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fits = np.flatnonzero(present[length:])
            if len(fits):
                room = length + int(fits[0])
                config, k = rooms[room].pop()
                if not rooms[room]:
                    present[room] = False
                take = min(k, n)
                if k > take:
                    rooms[room].append((config, k - take))
                    present[room] = True
                config, room, n = (*config, length), room - length, n - take
            else:
                each = capacity // length  # a fresh sequence takes as many of this length as fit
                take, many = (n // each, each) if n >= each else (1, n)
                config, room, n = (length,) * many, capacity - many * length, n - take * many
            rooms.setdefault(room, []).append((config, take))
            present[room] = True
    return [x for same in rooms.values() for x in same]


def packed(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how many sequences each has, which together hold ``counts[length]`` pieces of every length.

    Of several roundings, which leave more or less to best fit, the one with the fewest sequences is taken.
    """
    used, plans = play(counts), []
    for share in SHARES_KEPT:
        out, left = rounded(used, counts, share)
        plans.append(out + best_fit(left))
    return min(plans, key=lambda plan: sum(k for _, k in plan))


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[np.ndarray]:
    """Where pieces go: length, number of the first one, first sequence, copies in a sequence, offset of the first copy; sorted.

    The k-th piece from a row's first number on goes to sequence first + k // copies, as its copy k % copies.
    """
    rows, taken, sequence = [], {}, 0
    for config, times in plan:
        offset = 0
        for length in sorted(set(config), reverse=True):
            copies = config.count(length)
            rows.append((length, taken.get(length, 0), sequence, copies, offset))
            taken[length] = taken.get(length, 0) + copies * times
            offset += copies * length
        sequence += times
    return [np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)] or [np.empty(0, np.int64)] * 5


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to ids, as the tokenizer of a byte-level file gives them.

    The file's own vocabulary, as merge ranks, in the faster of two libraries; texts with very long runs go to the other one, whose time does not grow with the square of a run.
    """
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True  # their strings in a text are ordinary text
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {_bytes(t): k for t, k in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        return plain.encode(text, add_special_tokens=False).ids if _RUN.search(text) else fast.encode_ordinary(text)

    return encode


#: Fixed: how byte-level tokenizers of this kind split a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUN = re.compile(r"\S{512}|\s{512}")


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its Latin-1 letter if that is printable, and else as a letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _bytes(token: str) -> bytes:
    letters = _byte_letters()
    return bytes(letters[c] for c in token)


def _pieces(path: str, capacity: int, eos: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        encode = encoder(path)
        for b in batches:
            out, size = [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), eos], "<u4")
                head = (len(ids) - 1) % capacity + 1  # only the first piece may be shorter
                for k, at in enumerate([0, *range(head, len(ids), capacity)]):
                    part = ids[at : head if not at else at + capacity]
                    out.append((key, k, at, len(part), part.tobytes()))
                size += len(ids)
                if size >= 1 << 20:
                    yield batch(schema, *zip(*out, strict=True))
                    out, size = [], 0
            if out:
                yield batch(schema, *zip(*out, strict=True))

    return run


def _placed(numbers: dict[int, np.ndarray], plan: list[np.ndarray]):
    """Sequence and offset of each piece from its length, share and number in that share."""
    length, first, sequence, copies, offset = plan
    key = _key(length, first)

    def run(batches):
        for b in batches:
            names = [f.name for f in b.schema]
            own, share, rank = (b.column(names.index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "share", "rank"))
            number = rank - 1
            for n in np.unique(own).tolist():
                here = own == n
                number[here] += numbers[n][share[here]]
            at = np.searchsorted(key, _key(own, number), side="right") - 1
            k = number - first[at]
            stay = [c for c in names if c not in ("share", "rank")]
            yield pa.RecordBatch.from_arrays([*(b.column(names.index(c)) for c in stay), pa.array(sequence[at] + k // copies[at]), pa.array(offset[at] + k % copies[at] * own)], names=[*stay, "sequence_id", "offset"])

    return run


def _key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Sorts by length, then number; numbers stay below 2**48."""
    return (length << 48) + number


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER, eos: int = EOS) -> DataFrame:
    """One row for each piece of a document: doc_id, piece, start, length, ids, sequence_id and offset.

    A document's ids and ``eos`` are cut into pieces of ``capacity`` only if they are more; the first piece may
    be shorter. ``ids`` are little-endian 32-bit numbers. The pieces of a sequence lie in it without gaps from offset 0; sequences are numbered from 0.

    A null or empty text is ``eos`` alone, a text of any length is taken whole, each repeated row is packed, a null id stays null,
    an empty table gives an empty one, and other columns, of any name, are ignored. Equal rows change places at most among themselves.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = rows.mapInArrow(_pieces(tokenizer, capacity, eos), "doc_id long, piece int, start long, length long, ids binary")
    # equal rows of one share are alike, so their order in it does not matter
    shared = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(SHARES)).cast("int"))
    ranked = shared.withColumn("rank", F.row_number().over(Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids")).cast("long"))
    ranked = kept(ranked, "pieces")
    # at most capacity x SHARES rows
    sizes = ranked.groupBy("length", "share").agg(F.max("rank").alias("n")).toPandas()
    counts, numbers = np.zeros(capacity + 1, np.int64), {}
    for length, own in sizes.groupby("length"):
        n = np.zeros(SHARES, np.int64)
        n[own["share"].to_numpy()] = own["n"].to_numpy()
        counts[length], numbers[int(length)] = n.sum(), np.cumsum(n) - n
    plan = slots(packed(counts))
    schema = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    return ranked.mapInArrow(_placed(numbers, plan), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids and the pieces' bounds (array of doc_id, piece, offset, length): at most ``capacity`` ids a row."""
    part = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(part.alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("pieces"))


def op12_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
