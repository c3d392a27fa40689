"""Operator 11: repair of conversation structure by bidirectional Dijkstra over the edit lattice.

A conversation is right if the initials of its roles are ``(s?(ua)+)?`` and no
turn is blank or repeats an earlier one.  A node of its lattice is (turns read,
state of that pattern); edges keep, rerole, delete or insert a turn.  One heap
goes forward from the start and one backward from the ends; they stop when their least costs together exceed
the best crossing, so every crossing of that cost has been met, and the least of the joined audits wins.

Rows are sorted by (conversation, turn) over ranges, so a conversation of any
length may lie on many tasks.  A run of at most ``BLOCK`` rows is one lattice; of a
conversation that is cut, each run is searched from every state to every state,
and the runs are joined in pairs.  Only initials and faults of rows enter a
lattice, never texts; the edits then meet the rows again by a join.

Audits: the state and an edit's initial fix the role that comes out, so an audit
names one repair.  Two audits between the same nodes at the same cost are never prefixes of
one another (what follows a prefix would be inserts, which cost), so the least
audit is made of least parts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, cut

#: A longer conversation is searched in runs of so many rows.
BLOCK = 1024
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
WHITE = " \t\n\u000b\f\r"
#: A row's code is its initial (s, u, a, other) and four times its fault.
FINE, CUT_OFF, REPEAT, BLANK = range(4)
# states: 0 nothing yet, 1 behind the system turn, 2 behind a user's, 3 behind an assistant's
START, ENDS = 0, (0, 3)
KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
NEXT = (2, 2, 3, 2)
KEPT_FROM = [[[p for p, q in k.items() if q == state] for state in range(4)] for k in KEEP]
NEXT_FROM = [[p for p in range(4) if NEXT[p] == state] for state in range(4)]

Label = tuple[int, str]


def _forward(codes: bytes, i: int, q: int):
    if i < len(codes):
        initial, fault = codes[i] & 3, codes[i] >> 2
        yield i + 1, q, DELETE, "D"
        if fault < REPEAT:
            more = TRUNCATED * fault
            if q in KEEP[initial]:
                yield i + 1, KEEP[initial][q], more, "K"
            yield i + 1, NEXT[q], more + REROLE, "R"
    yield i, NEXT[q], INSERT, "I"


def _backward(codes: bytes, i: int, q: int):
    if i:
        initial, fault = codes[i - 1] & 3, codes[i - 1] >> 2
        yield i - 1, q, DELETE, "D"
        if fault < REPEAT:
            more = TRUNCATED * fault
            for p in KEPT_FROM[initial][q]:
                yield i - 1, p, more, "K"
            for p in NEXT_FROM[q]:
                yield i - 1, p, more + REROLE, "R"
    for p in NEXT_FROM[q]:
        yield i, p, INSERT, "I"


@lru_cache(maxsize=1 << 15)
def search(codes: bytes, entry: int = START, ends: tuple[int, ...] = ENDS) -> Label | None:
    """The least (cost, audit) that leads over all rows from one state to one of others, or None."""
    ahead: dict[tuple[int, int], Label] = {(0, entry): (0, "")}
    behind: dict[tuple[int, int], Label] = {(len(codes), q): (0, "") for q in ends}
    # among equal costs, nodes nearer to the side's own end come first: then free edges lead only to later ones
    heads, tails = [(0, 0, entry)], [(0, 0, q) for q in ends]
    done: tuple[set, set] = (set(), set())
    best = float("inf")
    while heads and tails and heads[0][0] + tails[0][0] <= best:
        onward = heads[0][0] <= tails[0][0]
        cost, depth, q = heappop(heads if onward else tails)
        node = (depth if onward else len(codes) - depth, q)
        if node in done[onward]:
            continue
        done[onward].add(node)
        own, other = (ahead, behind) if onward else (behind, ahead)
        audit = own[node][1]
        for i, p, w, edit in (_forward if onward else _backward)(codes, *node):
            label = (cost + w, audit + edit if onward else edit + audit)
            old = own.get((i, p))
            if old is None or label < old:
                own[i, p] = label
                if old is None or label[0] < old[0]:
                    heappush(heads if onward else tails, (label[0], i if onward else len(codes) - i, p))
            if (i, p) in other:
                best = min(best, label[0] + other[i, p][0])
        if node in other:
            best = min(best, cost + other[node][0])
    crossings = [(ahead[v][0] + behind[v][0], ahead[v][1] + behind[v][1]) for v in ahead.keys() & behind.keys()]
    return min(crossings, default=None)


def between(codes: bytes) -> list[Label | None]:
    """``search`` from each state to each state, row by row."""
    return [search(codes, e, (x,)) for e in range(4) for x in range(4)]


def joined(parts: list[list[Label | None]]) -> list[Label | None]:
    """The labels over runs that follow one another, joined in pairs so that audits are copied once a level."""
    while len(parts) > 1:
        parts = [_pair(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def _pair(a: list[Label | None], b: list[Label | None]) -> list[Label | None]:
    out: list[Label | None] = []
    for e in range(4):
        for x in range(4):
            ways = [(l[0] + r[0], l[1], r[1]) for m in range(4) if (l := a[4 * e + m]) and (r := b[4 * m + x])]
            least = min((w[0] for w in ways), default=0)
            out.append((least, min(w[1] + w[2] for w in ways if w[0] == least)) if ways else None)
    return out


RUN = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "at", "n", "first", "last", "illegal", "low", "high", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated")]
    + [("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string()))]
)
RUN_COLUMNS = ", ".join(f"{f.name} {'array<long>' if f.name == 'cost' else 'array<string>' if f.name == 'audit' else 'long'}" for f in RUN)
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True


def _runs(batches):
    """One row for each run of a conversation's rows in this partition, with its searched lattice."""
    held, opened = None, True  # opened: the first held row may go on a conversation of an earlier partition or run
    for b in batches:
        if b.num_rows:
            now = [_numbers(b.column(k)) for k in range(4)]
            held = now if held is None else [tuple(np.concatenate(x) for x in zip(h, c, strict=True)) for h, c in zip(held, now, strict=True)]
            (conv, none), n = held[0], len(held[0][0])
            starts = np.flatnonzero(np.concatenate(([True], (conv[1:] != conv[:-1]) | (none[1:] != none[:-1]))))
            edges = np.concatenate([np.arange(a, z, BLOCK) for a, z in zip(starts, [*starts[1:], n], strict=True)] + [[n]]).astype(np.int64)
            if len(edges) > 2:
                yield _solved(held, edges[:-1], starts, opened)
                keep = edges[-2]
                opened = keep not in starts
                held = [tuple(x[keep:] for x in h) for h in held]
    if held is not None:
        yield _solved(held, np.array([0, len(held[0][0])]), np.array([0]), True)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integers, and where they are null."""
    return column.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)


def _solved(held, edges: np.ndarray, starts: np.ndarray, opened: bool) -> pa.RecordBatch:
    (conv, none), (turn, no_turn), (code, _), (at, _) = held
    a, z = edges[:-1], edges[1:]
    begins = np.isin(a, starts) & ~((a == 0) & opened)
    whole = begins & np.isin(z, starts)
    initial, fault = code & 3, code >> 2
    inner = np.ones(edges[-1], bool)
    inner[a] = False
    odd = np.zeros(edges[-1], np.int64)
    odd[1:] = inner[1:] & ~LEGAL[initial[: edges[-1] - 1], initial[1 : edges[-1]]]
    some, cost, audit = ~no_turn, [], []
    new_turn = np.zeros(edges[-1], np.int64)  # nulls come first, so turns are sorted behind them
    new_turn[1:] = inner[1:] & some[1 : edges[-1]] & (turn[1 : edges[-1]] != turn[: edges[-1] - 1]) & some[: edges[-1] - 1]
    filled = np.add.reduceat(some[: edges[-1]].astype(np.int64), a)
    raw = code[: edges[-1]].astype(np.uint8).tobytes()
    for x, y, alone in zip(a.tolist(), z.tolist(), whole.tolist(), strict=True):
        labels = [search(raw[x:y])] if alone else between(raw[x:y])
        cost.append([None if v is None else v[0] for v in labels])
        audit.append([None if v is None else v[1] for v in labels])
    empty = filled == 0
    first_some = np.minimum(z - filled, z - 1)
    value = lambda v: pa.array(v, pa.int64(), mask=empty)
    count = lambda kind: np.add.reduceat((fault[: edges[-1]] == kind).astype(np.int64), a)
    columns = [pa.array(conv[a], pa.int64(), mask=none[a]), at[a], z - a, initial[a], initial[z - 1], np.add.reduceat(odd, a)]
    columns += [value(turn[first_some]), value(turn[z - 1]), value(turn[first_some]), value(turn[z - 1]), np.add.reduceat(new_turn, a) + ~empty]
    return batch(RUN, *columns, count(BLANK), count(REPEAT), count(CUT_OFF), pa.array(cost, pa.list_(pa.int64())), pa.array(audit, pa.list_(pa.string())))


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
STITCHED = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("at", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])


def _stitch(batches):
    for b in batches:
        rows = []
        for conv, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            labels = [[None if c is None else (c, t) for c, t in zip(r["cost"], r["audit"], strict=True)] for r in runs]
            if len(labels) == 1 and len(labels[0]) == 1:
                cost, audit = labels[0][0]
            else:
                cost, audit = min(v for v in (joined(labels)[4 * START + x] for x in ENDS) if v)
            illegal, turns, last = sum(r["illegal"] for r in runs), 0, None
            for k, r in enumerate(runs):
                illegal += bool(k) and not LEGAL[runs[k - 1]["last"], r["first"]]
                turns += r["turns"] - (r["turns"] > 0 and r["first_turn"] == last)
                last = r["last_turn"] if r["turns"] else last
            low, high = [r["low"] for r in runs if r["turns"]], [r["high"] for r in runs if r["turns"]]
            gaps = max(high) - min(low) + 1 - turns if low else 0
            rows.append((conv, gaps, *(sum(r[c] for r in runs) for c in ("blank", "duplicate", "truncated")), int(illegal), cost, audit, [r["at"] for r in runs], [r["n"] for r in runs]))
        if rows:
            yield batch(STITCHED, *zip(*rows, strict=True))


EDIT = pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("new_role", pa.string())])
#: So many edits are unfolded at a time.
EDITS = 1 << 16


def _edits(batches):
    """The audits' edits but for deletes, each with the place of its row and the role that it sets."""
    for b in batches:
        for conv, audit, starts, sizes in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            ends, edits = np.cumsum(sizes), np.frombuffer(audit.encode(), np.uint8)
            step = np.flatnonzero(edits != ord("D"))
            row = (np.cumsum(edits != ord("I")) - 1)[step]
            edit = edits[step]
            run = np.searchsorted(ends, row, side="right").clip(0, len(sizes) - 1)
            at = np.array(starts, np.int64)[run] + row - (ends - sizes)[run]
            place = np.arange(len(step)) - len(step) % 2  # turns come in pairs, so an odd one is the system's and stands first
            for k in range(0, len(step), EDITS):
                part = slice(k, k + EDITS)
                inserted, kept = edit[part] == ord("I"), edit[part] == ord("K")
                letters, roles = np.array(["K", "R", "I"])[np.where(kept, 0, 1 + inserted)], np.where(place[part] % 2, "assistant", "user")
                yield batch(EDIT, pa.array([conv] * len(letters), pa.int64()), step[part], pa.array(at[part], pa.int64(), mask=inserted), pa.array(letters.tolist()), pa.array(roles.tolist(), pa.string(), mask=kept))


def coded(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, role, text, copy and code: a row for each turn, with its initial and first fault."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("same", F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256))
    # a null turn is less than any other, as a struct
    first = rows.groupBy("conv_id", "same").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1").select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    ends = F.rtrim("text", F.lit(WHITE))
    again = (F.col("copy") > 1) | F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    fault = F.when(ends == "", BLANK).when(again, REPEAT).when(~F.right(ends, F.lit(1)).isin(".", "!", "?"), CUT_OFF).otherwise(FINE)
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    return rows.select("conv_id", "turn", "role", "text", "copy", (initial + 4 * fault).cast("int").alias("code"))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The repaired turns and a report.

    Turns: conv_id, step (their order), edit (K, R or I), source_turn (null for inserted ones), role, text; deleted ones are left out. Report, one row for each
    conversation: conv_id, gaps (missing turn numbers), blank, duplicate, truncated (rows by first fault), illegal
    (neighbours whose roles cannot follow one another), cost and audit (the edits' initials).

    A null role or text is one space, so such a text is blank. Turns are ordered by turn, nulls first, then role, then text; of rows with equal
    role and text the first one stays and all others, repeated rows too, are duplicates. Rows with a null
    conversation form one. Texts of any length are taken whole; an empty table gives two empty ones; other columns, of any name, are ignored.
    """
    order = ("conv_id", "turn", "role", "text", "copy")
    rows = coded(turns, conv_col, turn_col, role_col, text_col)
    rows = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    runs = rows.select("conv_id", "turn", "code", "at").mapInArrow(_runs, RUN_COLUMNS)
    grouped = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", *[c for c in runs.columns if c not in ("conv_id", "at")]))).alias("runs"))
    found = cut(grouped.mapInArrow(_stitch, REPORT.replace("audit string", "audit string, at array<long>, n array<long>")))
    edits = found.select("conv_id", "audit", "at", "n").mapInArrow(_edits, "conv_id long, step long, at long, edit string, new_role string")
    here = rows.select(F.col("at").alias("row_at"), "turn", "role", "text")
    old = edits.where("at is not null").join(here, F.col("at") == F.col("row_at"))
    old = old.select("conv_id", "step", "edit", F.col("turn").alias("source_turn"), F.coalesce("new_role", "role").alias("role"), "text")
    new = edits.where("at is null").select("conv_id", "step", "edit", F.lit(None).cast("long").alias("source_turn"), F.col("new_role").alias("role"), F.lit("").alias("text"))
    return old.unionByName(new), found.drop("at", "n")


def _hashed(batches):
    """The digest of each conversation's lines; rows come sorted, and a conversation may reach over batches."""
    conv, state, n = None, None, 0
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    for b in batches:
        out = []
        for c, role, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            if state is None or c != conv:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state, n = c, hashlib.sha256(), 0
            state.update(("\n" if n else "").encode() + f"{role}:{text}".encode())
            n += 1
        if out:
            yield batch(schema, *zip(*out, strict=True))
    if state is not None:
        yield batch(schema, [conv], [state.hexdigest()])


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines, streamed in order."""
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "step")
    return dealt.select("conv_id", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, unpunctuated, repeated or given to the user by a hash of conversation and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("time")).drop("time")


def op11_structure_repair(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    repaired, report = repair(damaged(turns))
    convs = turns.select(F.col("conv_id").alias("c")).distinct()
    found = convs.join(report, F.col("c").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    hashes = digests(repaired).withColumnRenamed("conv_id", "h")
    found = found.join(hashes, F.col("c").eqNullSafe(F.col("h")), "left")
    zero = [F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))



#: SQL for a table ``tab`` with the list ``t`` of what each byte does to a CRC-32.
CRC_TABLE = """tab AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))
)"""


def crc32_sql(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text, with ``tab`` in reach."""
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


#: SQL reads forward only: the least label (cost, then audit) of each state behind each row.
ORACLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, tab
), d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, range(2) r(time) WHERE kind <> 0 AND (time = 0 OR kind = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ends
  FROM d
), f AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN ends = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(ends, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o
), n AS (
  SELECT conv_id, max(i) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
), ins(p, q, e, w) AS (VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 5), (1, 2, 'I', 5), (2, 3, 'I', 5), (3, 2, 'I', 5), (0, 3, 'II', 10), (1, 3, 'II', 10)
), edit(p, q, e, initial) AS (
  SELECT CAST(p AS INT), CAST(p AS INT), 'D', CAST(NULL AS VARCHAR) FROM range(4) r(p) UNION ALL VALUES (0, 2, 'R', NULL), (1, 2, 'R', NULL), (2, 3, 'R', NULL), (3, 2, 'R', NULL),
         (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'), (2, 3, 'K', 'a')
), l AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, q, printf('%012d', w) || e AS label FROM n, ins WHERE p = 0
  UNION ALL
  SELECT conv_id, i, q, min(label) FROM (
    SELECT l.conv_id, f.i, ins.q, printf('%012d', CAST(left(label, 12) AS BIGINT) + ins.w + CASE edit.e WHEN 'D' THEN 2 ELSE CASE edit.e WHEN 'R' THEN 1 ELSE 0 END + CASE fault WHEN 't' THEN 5 ELSE 0 END END)
           || substr(label, 13) || edit.e || ins.e AS label
    FROM l JOIN f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = l.i + 1
    JOIN edit ON edit.p = l.q AND (edit.initial IS NULL OR edit.initial = f.initial) AND (edit.e = 'D' OR fault NOT IN ('b', 'd'))
    JOIN ins ON ins.p = edit.q) s
  GROUP BY conv_id, i, q
), a AS (
  SELECT n.*, (SELECT min(label) FROM l WHERE l.conv_id IS NOT DISTINCT FROM n.conv_id AND l.i = n.rows AND l.q IN (0, 3)) AS label FROM n
), e AS (
  SELECT conv_id, rows, step, letter, sum(CASE letter WHEN 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY step) AS i, sum(CASE letter WHEN 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY step) AS place,
         (SELECT count(*) FROM range(13, length(label) + 1) r(x) WHERE substr(label, CAST(x AS INT), 1) <> 'D') % 2 AS odd
  FROM (SELECT conv_id, rows, label, unnest(range(13, length(label) + 1)) AS step, unnest(string_split(substr(label, 13), '')) AS letter FROM a WHERE length(label) > 12)
), t AS (
  SELECT e.conv_id, string_agg(CASE letter WHEN 'K' THEN role WHEN 'D' THEN NULL ELSE CASE WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY step) AS out
  FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND letter <> 'I' WHERE letter <> 'D' GROUP BY e.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(left(label, 12) AS BIGINT), 0) AS cost, coalesce(substr(label, 13), '') AS audit, sha256(coalesce(out, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
