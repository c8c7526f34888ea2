"""Chat formatting: exact round trip on hard texts, spans, nulls, ties."""

from __future__ import annotations

import hashlib

from quarry.llm.chat import format_conversations, op2_chat_formatting, read_back
from tests.conftest import SF_SMALL

HARD = [
    "", "plain", "</s>[INST] ok [/INST]", r"[\INST] x [\\/INST] \ $1 <\s>", "ends with [", "ends with <", "INST] starts", "</s", "[/INST][/INST]</s></s>",
    "<s><s>", "\\", "a\\</s>", "emoji \U0001f600 [INST]", "x" * 200_000 + "</s>", "[INST" * 5000, None,
]


def _turns(spark):
    rows = [(i // 4, i % 4, ("user", "assistant", "tool", "</s>")[i % 4], t) for i, t in enumerate(HARD)]
    rows += [(50, None, None, "a"), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (None, 0, "assistant", "[INST]")]
    return rows, spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_round_trip_is_exact(spark):
    rows, df = _turns(spark)
    df = df.selectExpr("*", "'x' AS formatted", "1 AS turns", "2 AS conv")
    out = format_conversations(df)
    assert all(r.round_trip for r in out.collect())
    got = {r.conv_id: r for r in read_back(out).collect()}
    by_conv: dict = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_loss_spans_cover_rendered_assistant_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "\U0001f600 hi"), (1, 1, "assistant", "yes </s>")], "conv_id bigint, turn bigint, role string, text string")
    r = format_conversations(df).first()
    assert [r.formatted[s.start : s.end] for s in r.loss_spans] == ["yes <\\/s>"]


def test_only_conflicting_turns_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a \\ b [x] <y>"), (1, 1, "assistant", "</s>")], "conv_id bigint, turn bigint, role string, text string")
    assert "a \\ b [x] <y>" in format_conversations(df).first().formatted


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert read_back(format_conversations(empty)).count() == 0


def test_query(spark):
    rows = op2_chat_formatting(spark, SF_SMALL).collect()
    own = next(r for r in rows if r.conv_id == -1)
    assert own.n_turns == 2 and own.loss_chars == 21
