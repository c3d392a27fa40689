"""Operator 13: the prefix trie of conversations, with a minimal perfect hash over its nodes.

A conversation becomes a path of turn digests; no text goes further.  Paths are
sorted over ranges, so the members of a node stand together, however many there are, and a
stretch of paths is a shard.  A shard lists its distinct prefix digests, a minimal perfect hash gives each a slot, every prefix's
slot is checked against its digest, its parent and its last turn, counts are scattered into flat arrays, and sums
go from slots to parent slots, deepest first.

Only nodes on the first and the last path of a shard can have members elsewhere.  Of these each shard
tells what it has seen; they are added by digest and summed upward once more, level by level.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import batch, cut, kept
from .structure import CRC_TABLE, crc32_sql

#: A shard holds so many prefixes, and at least one conversation.
SHARD = 1 << 18
#: Room for each key in a level of the hash, and levels after which keys must be equal.
ROOM, LEVELS = 1.5, 60
ROOT = bytes(16)


def _mixed(keys: np.ndarray, level: int, room: int) -> np.ndarray:
    """A place below ``room`` for each key of two 64-bit words, another one at each level."""
    x = keys[:, 0] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x ^= keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(room)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for n different keys: at each level, keys that are alone in their place stay there."""

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, used = keys, 0
        while len(left):
            if len(self.levels) == LEVELS:
                raise ValueError("equal prefix digests")
            place = _mixed(left, len(self.levels), room := int(ROOM * len(left)) + 1)
            alone = np.bincount(place, minlength=room) == 1
            self.levels.append((alone, used + np.cumsum(alone) - 1))
            used += int(alone.sum())
            left = left[~alone[place]]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The keys' slots; of a key that is in no level, -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            place = _mixed(keys[left], level, len(alone))
            here = alone[place]
            out[left[here]] = rank[place[here]]
            left = left[~here]
        return out


NODE, EDGE, END = range(3)
NUMBERS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars")
SHARDS = pa.schema([("kind", pa.int32()), ("digest", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in NUMBERS)])
SHARD_COLUMNS = "kind int, digest binary, parent binary, " + ", ".join(f"{c} long" for c in NUMBERS)


def prefixes(paths: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The digests of all prefixes of sorted paths, each path's root first, and whether a prefix is new."""
    out, new, last, chain = [], [], None, [ROOT]
    for path in paths:
        same = 0
        if last is not None:
            limit = min(len(path), len(last))
            while same < limit and path[same] == last[same]:
                same += 1
        del chain[same + 1 :]
        for turn in path[same:]:
            chain.append(hashlib.blake2b(chain[-1] + turn, digest_size=16).digest())
        new += [last is None, *([False] * same), *([True] * (len(path) - same))]
        out += chain
        last = path
    return out, np.array(new, bool)


def _shard(convs: list[int], paths: list[list[bytes]], chars: list[list[int]]):
    """The rows of one shard: finished nodes, what it knows of edge nodes, and where conversations end."""
    digests, new = prefixes(paths)
    sizes = np.array([len(p) + 1 for p in paths])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    depth = np.arange(ends[-1]) - np.repeat(begins, sizes)
    conv = np.repeat(np.array(convs, np.int64), sizes)
    turn = [ROOT] * int(ends[-1])
    length = np.zeros(ends[-1], np.int64)
    for a, path, n in zip(begins.tolist(), paths, chars, strict=True):
        turn[a + 1 : a + 1 + len(path)] = path
        length[a + 1 : a + 1 + len(path)] = n
    keys = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    turns = np.frombuffer(b"".join(turn), np.uint64).reshape(-1, 2)
    table = PerfectHash(keys[new])
    slot, m = table.slots(keys), int(new.sum())
    above = np.concatenate(([-1], slot[:-1]))
    above[begins] = -1
    first = np.empty(m, np.int64)
    first[slot[new]] = np.flatnonzero(new)
    at = first[slot]
    if (slot < 0).any() or (keys[at] != keys).any() or (above[at] != above).any() or (turns[at] != turns).any():
        raise ValueError("different prefixes with one digest")
    parent, level, own = above[first], depth[first], length[first]
    n = np.bincount(slot, minlength=m)
    least = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv)
    edge = np.zeros(m, bool)
    edge[slot[: ends[0]]] = edge[slot[begins[-1] :]] = True
    inner = ~edge
    children = np.bincount(parent[inner], minlength=m)  # the root is an edge, so no inner node is without a parent
    leaves = (inner & (children == 0)).astype(np.int64)
    saved = np.where(inner, (n - 1) * own, 0)
    order = np.flatnonzero(inner)
    order = order[np.argsort(-level[order], kind="stable")]
    for some in np.split(order, np.flatnonzero(np.diff(level[order])) + 1) if len(order) else []:
        np.add.at(leaves, parent[some], leaves[some])
        np.add.at(saved, parent[some], saved[some])
    names = np.array(digests, object)[first]
    no_parent = parent < 0
    over = pa.array(least[parent], pa.int64(), mask=no_parent | edge[parent] | edge)
    upper = pa.array([None if p < 0 else names[p] for p in parent.tolist()], pa.binary())
    yield batch(SHARDS, pa.array(edge.astype(np.int32)), pa.array(names.tolist(), pa.binary()), upper, least, level, over, n, children, leaves, saved, own)
    last = pa.array([digests[z - 1] for z in ends.tolist()], pa.binary())
    blank = [pa.nulls(len(convs), f.type) for f in list(SHARDS)[5:]]
    yield batch(SHARDS, np.full(len(convs), END, np.int32), last, pa.nulls(len(convs), pa.binary()), np.array(convs, np.int64), pa.array(sizes - 1), *blank)


def _shards(batches):
    convs, paths, chars, held = [], [], [], 0
    for b in batches:
        for conv, path, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            convs.append(conv)
            paths.append(path)
            chars.append(n)
            held += len(path) + 1
            if held >= SHARD:
                yield from _shard(convs, paths, chars)
                convs, paths, chars, held = [], [], [], 0
    if convs:
        yield from _shard(convs, paths, chars)


EDGES = pa.schema([("digest", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in NUMBERS if c not in ("parent_conv_id", "chars"))])


def _upward(batches):
    """Edge nodes come deepest first; each takes what its children among them have sent. Two levels are held."""
    level, now, sent = None, {}, {}
    for b in batches:
        out = []
        for digest, parent, conv, depth, n, children, leaves, saved, chars in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if depth != level:
                level, now, sent = depth, sent, {}
            more = now.pop(digest, (0, 0, 0))
            children, saved = children + more[0], saved + more[2] + (n - 1) * chars
            leaves = leaves + more[1] if children else 1
            if parent is not None:
                old = sent.get(parent, (0, 0, 0))
                sent[parent] = (old[0] + 1, old[1] + leaves, old[2] + saved)
            out.append((digest, parent, conv, depth, n, children, leaves, saved))
        if out:
            yield batch(EDGES, *zip(*out, strict=True))


def conversation_paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns, an array of (digest of role and text, code points of the text): 40 bytes a turn.

    Turns are ordered by turn, nulls first, then role, then text; repeated rows are turns of their own. A null
    role or text is empty. Rows with a null conversation belong to none and are left out. Texts are taken whole; an empty table
    gives an empty one; other columns, of any name, are ignored.
    """
    order = ("conv_id", "turn", "role", "text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text")).where("conv_id is not null")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.unhex(F.left(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256), F.lit(32)))
    turn = F.struct(F.monotonically_increasing_id().alias("at"), digest.alias("digest"), F.char_length("text").cast("long").alias("chars"))
    # a conversation may lie in several ranges; each has one list of it
    grouped = rows.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def prefix_trie(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of ``paths`` (conv_id, turns), and the node at which each conversation ends.

    Nodes: digest, conv_id (the least member's), depth, parent_conv_id (null at the root), n_convs (members),
    n_children, n_leaves (childless nodes in the subtree, the node included) and saved_tokens: over the subtree, (members - 1)
    times the code points of a node's last text. Ends: digest, conv_id, depth.

    A conversation without turns is a member of the root alone; equal conversations share all nodes; without conversations there is no node.
    Different prefixes with one digest raise an error.
    """
    path = F.transform("turns", lambda t: t["digest"])
    rows = paths.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"))
    rows = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    told = kept(rows.mapInArrow(_shards, SHARD_COLUMNS), "trie")
    same = lambda c: F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c)).otherwise(F.raise_error(F.lit("different prefixes with one digest"))).alias(c)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    edges = told.where(F.col("kind") == EDGE).groupBy("digest").agg(same("parent"), F.min("conv_id").alias("conv_id"), same("depth"), *sums, same("chars"))
    # a shard has at most two edge nodes of a depth
    edges = edges.coalesce(1).sortWithinPartitions(F.desc("depth"))
    edges = cut(edges.mapInArrow(_upward, "digest binary, parent binary, " + ", ".join(f"{f.name} long" for f in list(EDGES)[2:])))
    out = ["digest", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = told.where(F.col("kind") == NODE)
    above = edges.select(F.col("digest").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    open_ = inner.where("parent_conv_id is null").select(*edges.columns).unionByName(edges.where("parent is not null"))
    root = edges.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    under = open_.join(above, F.col("parent") == F.col("above"))
    nodes = inner.where("parent_conv_id is not null").select(*out).unionByName(under.select(*out)).unionByName(root.select(*out))
    return nodes, told.where(F.col("kind") == END).select("digest", "conv_id", "depth")


def _hashed(batches):
    """For sorted (digest, conv_id): the SHA-256 of each digest's ids, joined by commas."""
    schema = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])
    digest, state = None, None
    for b in batches:
        out, names, ids = [], b.column(0).to_pylist(), b.column(1).to_pylist()
        a = 0
        while a < len(names):
            z = a + 1
            while z < len(names) and names[z] == names[a]:
                z += 1
            if state is None or names[a] != digest:
                if state is not None:
                    out.append((digest, state.hexdigest()))
                digest, state = names[a], hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(map(str, ids[a:z])).encode())
            a = z
        if out:
            yield batch(schema, *zip(*out, strict=True))
    if state is not None:
        yield batch(schema, [digest], [state.hexdigest()])


def end_digests(ends: DataFrame) -> DataFrame:
    """digest and the SHA-256 of the ids that end there, ascending; a hash is taken in order, so one task reads a node's ids, 24 bytes each."""
    dealt = ends.select("digest", "conv_id").repartition("digest").sortWithinPartitions("digest", "conv_id")
    return dealt.mapInArrow(_hashed, "digest binary, ends_sha256 string")


#: Rebuilding: a conversation begins with up to so many less one turns of the first one of its hundred.
BORROWED, HUNDRED = 6, 100


def rebuilt(paths: DataFrame) -> DataFrame:
    """Each conversation with its first turns replaced by those of the first one of its hundred, where that has some."""
    hundred = F.col("conv_id") % HUNDRED
    heads = paths.where(hundred == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, BORROWED - 1).alias("head"))
    own = paths.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % BORROWED).cast("int")).withColumn("wanted", F.col("conv_id") - hundred)
    both = own.join(heads, F.col("wanted") == F.col("base"), "left")
    head: Column = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return both.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    nodes, ends = prefix_trie(rebuilt(cut(conversation_paths(turns))))
    hashes = end_digests(ends).withColumnRenamed("digest", "ended")
    found = nodes.join(hashes, F.col("digest") == F.col("ended"), "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))


ORACLE_SQL = f"""
WITH {CRC_TABLE}, turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), n AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id
), c AS (
  SELECT n.conv_id, h, b, least(h, coalesce(m.n, 0)) AS borrowed
  FROM (SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {BORROWED} AS h, conv_id - conv_id % {HUNDRED} AS b FROM n, tab) n LEFT JOIN n m ON m.conv_id = b
), r AS (
  SELECT c.conv_id AS c, p AS d, role, text FROM c JOIN turns t ON t.conv_id = b AND p <= h
  UNION ALL SELECT c.conv_id, p - h + borrowed, role, text FROM c JOIN turns t ON t.conv_id = c.conv_id AND p > h
), k AS (
  SELECT c, d, sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY c ORDER BY d)) AS key, length(text) AS chars FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM n
), v AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM k GROUP BY key, d
), w AS (
  SELECT v.*, p.key AS parent, u.conv_id AS parent_conv_id
  FROM v LEFT JOIN k p ON p.c = v.conv_id AND p.d = v.d - 1 LEFT JOIN v u ON u.key = p.key AND u.d = p.d
), s AS (SELECT parent, count(*) AS n_children FROM w WHERE d > 0 GROUP BY parent
), x AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM w LEFT JOIN s ON s.parent = w.key
), a AS (
  SELECT k.key, k.d, sum((n_convs - 1) * x.chars) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM x JOIN k ON k.c = x.conv_id AND k.d <= x.d GROUP BY k.key, k.d
), e AS (SELECT key, d, string_agg(c, ',' ORDER BY c) AS ids FROM k WHERE (c, d) IN (SELECT (c, max(d)) FROM k GROUP BY c) GROUP BY key, d)
SELECT x.conv_id, x.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM x JOIN a ON a.key = x.key AND a.d = x.d LEFT JOIN e ON e.key = x.key AND e.d = x.d
"""
