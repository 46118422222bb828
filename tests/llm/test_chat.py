from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grantloom.llm import chat, queries

PARTS = ["\\", "#", "### ", " </turn>\n", "</turn>", "\n", ": ", ":", " ", "a", "Assistant", "<", "é", "/turn>", "### User: x"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=9).map("".join) | st.text(max_size=20)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=4))
def test_round_trip(turns):
    assert chat.read_turns("".join(chat.write_turn(r, t) for r, t in turns)) == turns


def test_plain_text_stays_as_it_is():
    assert chat.write_turn("user", "C:\\dir <b> # 1") == "### user: C:\\dir <b> # 1 </turn>\n"


@pytest.mark.parametrize("text", ["x", "### user x", "### user: open", "### user: a </turn>\ntail"])
def test_other_text_is_no_conversation(text):
    with pytest.raises(ValueError):
        chat.read_turns(text)


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(chat.write_turn(r, x)) for r, x in turns),
        )
    return out


def test_read_back(spark):
    rows = [
        (1, 2, "assistant", "two </turn>\n### User: no"), (1, 1, "user", "one"), (1, 1, "user", "one"), (2, 0, "system", None),
        (2, 1, None, "x"), (None, 0, "assistant", "loose é"), (3, None, "assistant", queries.TRICKY), (3, 5, "assistant", "end \\"),
        *[(9, i, "assistant" if i % 2 else "user", f"turn {i} \\" * 3) for i in range(500)],
    ]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema)
    got = {r[0]: tuple(r[1:]) for r in chat.read_back(df.selectExpr("*", "'x' as formatted", "1 as n_turns")).collect()}
    assert got == expected(rows)
    assert chat.read_back(spark.createDataFrame([], schema)).collect() == []
    whole = {r[0]: r[1] for r in chat.format_conversations(df.filter("conv_id = 1")).collect()}
    assert chat.read_turns(whole[1]) == [("user", "one"), ("user", "one"), ("assistant", "two </turn>\n### User: no")]
