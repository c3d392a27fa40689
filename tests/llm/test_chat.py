"""Operator 10: exact round trips."""

import hashlib
import random

import numpy as np
import pytest

from docmart.llm import chat as C

PARTS = ["\\", "<|", "|>", "<|end|>", "\n", "\n<|end|>\n", "<|assistant|>\n", "a b", "é𝒳", " ", "", "\\<|", "|", "<", "### Assistant:", "</turn>"]


def tricky(r):
    return "".join(r.choices(PARTS, k=r.randint(0, 9)))


@pytest.mark.parametrize("seed", range(3))
def test_render_and_parse(seed):
    r = random.Random(seed)
    for _ in range(400):
        turns = [(tricky(r), tricky(r)) for _ in range(r.randint(0, 5))]
        text, begin, end = C.render(turns)
        assert C.parse(text) == turns
        assert [C.unescape(text[a:b]) for a, b in zip(begin, end)] == [t for _, t in turns]


def test_mask_by_binary_search():
    token, a, b = C.loss_mask(np.array([0, 2, 2, 5, 9]), np.array([2, 5, 5, 9, 12]), np.array([1, 4, 6, 12]), np.array([3, 4, 11, 14]))
    assert list(zip(token, a, b)) == [(0, 1, 2), (1, 2, 3), (2, 2, 3), (3, 6, 9), (4, 9, 11)]


def test_conversations(spark):
    r = random.Random(8)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]), tricky(r) if r.random() < 0.9 else None) for c in range(40) for t in range(r.randint(1, 6))]
    rows += [(None, 0, "assistant", "x"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (4, None, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {g.conv_id: g for g in C.read_back(C.format_chats(df)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for c in {x[0] for x in rows}:
        turns = sorted(((-1 if t is None else t, role or "", text or "") for k, t, role, text in rows if k == c))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (g.loss_chars, g.loss_sha256) == (len(loss), sha(loss))
    formatted = C.format_chats(df).collect()
    assert all(len(f.token_ids) == len(f.loss_mask) for f in formatted)
    assert C.format_chats(df.limit(0)).count() == 0


def test_odd_tables(spark):
    """A very long text, empty and null ones, repeated rows, and columns that clash with the operator's own."""
    long = "tok <|end|> é " * 60_000
    rows = [(1, 0, "user", long, "x", 1), (1, 1, "assistant", long, "x", 1), (2, 0, "assistant", "", None, None), (2, 0, "assistant", "", None, None), (3, 5, None, None, "x", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, loss_mask int").repartition(2)
    got = {g.conv_id: (g.n_turns, g.loss_chars) for g in C.read_back(C.format_chats(df)).collect()}
    assert got == {1: (2, len(long)), 2: (2, 0), 3: (1, 0)}
    assert C.read_back(C.format_chats(df.limit(0))).count() == 0
