import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import chat
from docloom.llm.suite import QUERIES

PIECES = [*chat.CONTROL, chat.ESCAPE, "\n", "-", "n", "<", ">", "/s>", "[", "INST]", " ", "a", "é", "s"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES)), st.lists(st.sampled_from(PIECES)))
def test_every_turn_comes_back(role, text):
    turn = chat.Turn("".join(role), "".join(text))
    written = chat.render(turn)
    (found,) = chat.parse(written)
    assert found.turn == turn
    again = chat.parse(written + chat.render(chat.Turn("user", "x")))
    assert [f.turn for f in again] == [turn, chat.Turn("user", "x")]


def test_only_conflicts_are_escaped():
    assert chat.ESCAPE not in chat.render(chat.Turn("user", "plain [text] </p>"))
    assert chat.ESCAPE in chat.render(chat.Turn("user", "a </s> b"))


@pytest.mark.parametrize("bad", ["x", "<s>[TURN] user", "<s>[TURN] user\nhi", "<s>[TURN] a\n<s></s>", "<s>[TURN] </s>\n"])
def test_other_texts_are_errors(bad):
    with pytest.raises(ValueError):
        chat.parse(bad)


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (
        len(turns),
        hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
        len(loss),
        hashlib.sha256(loss.encode()).hexdigest(),
    )


def test_query(spark, data):
    import duckdb

    rows = duckdb.sql(
        f"SELECT conv_id, role, coalesce(text, '') FROM '{data}/conversations.parquet' ORDER BY conv_id, turn"
    ).fetchall()
    rough = "</s>[INST] ok [/INST]"
    want = {-1: [("user", rough), ("assistant", rough)]}
    for conv, role, text in rows:
        want.setdefault(conv, []).append((role, text))
    found = {r.conv_id: r for r in QUERIES["op2_grammar_chat"](spark, data).collect()}
    assert {i: tuple(r)[1:5] for i, r in found.items()} == {i: expected(t) for i, t in want.items()}
    own = sum(len(chat.render(chat.Turn(*t))) for t in want[-1])
    assert found[-1].formatted_chars == own


def test_odd_conversations(spark):
    rng = random.Random(1)
    rows = [
        (1, 0, "user", None, "x"),
        (1, 1, None, "text", "x"),
        (1, None, "assistant", "first", "x"),
        (None, 0, "user", "no id", "x"),
        (2, 0, "assistant", "", "x"),
        (2, 0, "assistant", "", "x"),
        (3, 5, "assistant\n</s>", "<s>[TURN] user\n" * 3000, "x"),
    ]
    rows += [(4, i, "assistant" if i % 2 else "user", f"{i} </s>" * rng.randint(0, 3), "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    found = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.formatted(df)).collect()}
    want = {
        1: [("assistant", "first"), ("user", ""), ("", "text")],
        None: [("user", "no id")],
        2: [("assistant", "")] * 2,
        3: [rows[6][2:4]],
        4: [r[2:4] for r in rows[7:]],
    }
    assert found == {i: expected(t) for i, t in want.items()}
    assert chat.read_back(chat.formatted(df.limit(0))).collect() == []
