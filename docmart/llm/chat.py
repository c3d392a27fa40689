"""Operator 10: chat formatting with offset-aligned loss masks.

A conversation is rendered whole, remembering where each turn's text lies, and
encoded once with character offsets.  Turn spans and token spans are both sorted,
so a token's turn is found by binary search; the loss mask is what
the spans of assistant texts and of tokens have in common.

Template: ``<|role|>``, newline, text, newline, ``<|end|>``, newline for each turn.
In roles and texts a backslash precedes every backslash and every bar, so control
strings, which all have a bar, never occur inside them and one rule undoes it.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
END = "\n<|end|>\n"
#: Encode so many characters at a time: token objects are large.
CHARS = 1 << 19
_ESCAPE, _UNESCAPE = re.compile(r"[\\|]"), re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|((?:[^\\|]|\\.)*)\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The formatted conversation, and the bounds of each turn's text in it."""
    parts, begin, end, at = [], [], [], 0
    for role, text in turns:
        head, body = f"<|{escape(role)}|>\n", escape(text)
        begin.append(at + len(head))
        end.append(at + len(head) + len(body))
        parts += [head, body, END]
        at = end[-1] + len(END)
    return "".join(parts), np.array(begin, np.int64), np.array(end, np.int64)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    while m := _TURN.match(formatted, at):
        stop = formatted.index(END, m.end())  # bars are escaped inside texts
        out.append((unescape(m[1]), unescape(formatted[m.end() : stop])))
        at = stop + len(END)
    return out


def loss_mask(token_begin: np.ndarray, token_end: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted, disjoint spans [begin, end): which tokens share characters with one, and the shared bounds.

    A token longer than a span can touch several, so each (token, span) overlap is a row: (token, from, to).
    """
    some = end > begin
    begin, end = begin[some], end[some]
    lo = np.searchsorted(end, token_begin, side="right")
    hi = np.searchsorted(begin, token_end, side="left")
    n = np.maximum(hi - lo, 0)
    token = np.repeat(np.arange(len(token_begin)), n)
    span = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n) + lo[token]
    a, b = np.maximum(token_begin[token], begin[span]), np.minimum(token_end[token], end[span])
    return token[a < b], a[a < b], b[a < b]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep the blanks
    return t


FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()), ("token_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())), ("loss_spans", pa.list_(pa.int32()))]
)


def _format(path: str, train_role: str):
    def run(batches):
        for b in batches:
            conv, turns = b.column(0).cast(pa.int64()), b.column(1)
            at = 0
            while at < b.num_rows:
                texts, spans, size, first = [], [], 0, at
                while at < b.num_rows and size < CHARS:
                    rows = [(t["role"], t["text"]) for t in turns[at].as_py()]
                    text, begin, end = render(rows)
                    own = np.array([r == train_role for r, _ in rows], bool)
                    texts.append(text)
                    spans.append((begin[own], end[own]))
                    size += len(text)
                    at += 1
                ids, masks, marks = [], [], []
                for code, (begin, end) in zip(_tokenizer(path).encode_batch(texts, add_special_tokens=False), spans, strict=True):
                    offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
                    token, a, z = loss_mask(offsets[:, 0], offsets[:, 1], begin, end)
                    mask = np.zeros(len(offsets), bool)
                    mask[token] = True
                    ids.append(code.ids)
                    masks.append(mask)
                    marks.append(np.column_stack((a, z)).ravel().astype(np.int32))
                yield batch(FORMATTED, conv.slice(first, at - first), texts, ids, masks, marks)

    return run


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", train_role: str = "assistant", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row for each conversation: conv_id, formatted, token_ids, loss_mask and loss_spans.

    ``loss_mask`` marks tokens that share characters with a text of
    ``train_role``; ``loss_spans`` holds the shared bounds (from, to, from, to, ...)
    in characters of ``formatted``, for a token that reaches over a text's end.

    Turns are ordered by turn, then role, then text, so ties and repeated rows
    have a fixed order and all stay.  Null roles and texts are empty; a null
    turn comes first; rows with a null conversation form one.  A text is encoded whole, however long; an empty
    table gives an empty one.  Other columns, of any name, are ignored.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    grouped = turns.select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    schema = "conv_id long, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_spans array<int>"
    return grouped.mapInArrow(_format(tokenizer, train_role), schema)


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(batches):
    for b in batches:
        rows = []
        for text, marks in zip(b.column(1).to_pylist(), b.column(2), strict=True):
            turns = parse(text)
            spans = marks.values.to_numpy().reshape(-1, 2)
            flags = np.zeros(len(text) + 1, np.int64)
            np.add.at(flags, spans[:, 0], 1)
            np.add.at(flags, spans[:, 1], -1)
            edge = np.diff(np.concatenate(([0], np.cumsum(flags) > 0)).astype(np.int8))
            loss = unescape("".join(text[a:z] for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)))
            all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
            rows.append((len(turns), _sha(all_turns), len(loss), _sha(loss), len(text)))
        if rows:
            yield batch(DIGEST, b.column(0), *zip(*rows, strict=True))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations and their masks hold."""
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


TRICKY = "\\### Assistant: </turn> ok"


def op10_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return read_back(format_chats(turns.unionByName(more)))


ORACLE_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '{TRICKY}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
), l AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(role) + length(text) + length(regexp_replace(role || text, '[^\\\\|]', '', 'g')) + {len("<||>") + 1 + len(END)}) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM l
"""
