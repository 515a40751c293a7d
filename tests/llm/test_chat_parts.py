"""Operator 10: escapes are reversible, parts are visited in order, loss lies on the assistant's texts."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from carelake.llm import chat_parts
from carelake.llm.queries import QUERIES

SCHEMA = f"conv_id bigint, turn bigint, role string, parts {chat_parts.PART}, formatted int"


def text(value):
    return ("text", value, None, None)


def formatted(spark, rows):
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    return chat_parts.format_chats(frame, "conv_id", "turn", "role", "parts")


def test_escapes_are_reversible(spark):
    chance = random.Random(5)
    marks = ["<", "[", "\\", "</s>", "<s>", "[INST] ", " [/INST]", "<<SYS>>\n", "<image>", "a", "é", "\n", "s>", "/", "<\\"]
    given = ["", *("".join(chance.choice(marks) for _ in range(chance.randint(1, 9))) for _ in range(400))]
    frame = spark.createDataFrame([(t,) for t in given], "t string")
    out = frame.select("t", chat_parts.escape(F.col("t")).alias("e"), chat_parts.unescape(chat_parts.escape(F.col("t"))).alias("back"))
    for r in out.collect():
        assert r.back == r.t
        assert not any(m.strip() in r.e for m in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<<ROLE>>", "<image>"))


def test_parts(spark):
    parts = [text("look: <image> "), ("image", None, "s3://a.png", 784 * 3 + 1), text(None), ("audio", None, "b.wav", 41),
             ("document", "ignored", None, None), ("video", None, "c", 9), (None, "plain", None, None), text("end")]
    r = formatted(spark, [(1, 1, "user", parts), (1, 2, "assistant", [text("fine"), ("image", None, "d.png", 1)])]).first()
    turns = formatted(spark, [(1, 1, "user", parts)]).select(F.explode(chat_parts.parse(F.col("formatted"))).alias("t")).first().t
    assert turns.role == "user"
    assert r.formatted.startswith("<s>[INST] look: <\\image> <image><audio><document><attachment>plainend [/INST]</s>")
    assert [(a.turn, a.type, a.ref, a.n_tokens) for a in r.attachments] == [
        (1, "image", "s3://a.png", 4), (1, "audio", "b.wav", 2), (1, "document", None, 1), (1, "video", "c", 1), (2, "image", "d.png", 1)]
    assert r.n_attachment_tokens == 9
    (span,) = r.loss
    assert r.formatted[span.start : span.start + span.length] == "fine<image>"


def test_ties_nulls_and_repeats(spark):
    rows = [(1, 2, "assistant", [text("b")]), (1, 2, "assistant", [text("a")]), (1, None, None, [text("first")]),
            (1, 2, "assistant", [text("b")]), (None, 1, "user", None), (2, 1, "assistant", [])]
    got = {r.conv_id: r for r in formatted(spark, rows).select(
        "conv_id", chat_parts.parse(F.col("formatted")).alias("t"), chat_parts.learned(F.col("formatted"), F.col("loss")).alias("l")).collect()}
    assert [(t.role, t.text) for t in got[1].t] == [("", "first"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert got[1].l == "abb"
    assert [(t.role, t.text) for t in got[None].t] == [("user", "")]
    assert [(t.role, t.text) for t in got[2].t] == [("assistant", "")] and got[2].l == ""


def test_query(spark, parquet):
    rows = [(5, 0, "system", "<<SYS>>\n be [INST]"), (5, 1, "user", "hi </s>"), (5, 2, "assistant", "é \\<s>"), (5, 3, "tool]<", "x"),
            (5, 4, "assistant", ""), (5, 5, "assistant", "more"), (6, 0, "user", None), (7, 0, None, "é" * 50_000)]
    folder = parquet("conversations", [(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, parts int")
    got = {r.conv_id: r for r in QUERIES["op10_chat_parts"](spark, folder).collect()}
    trap = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", trap), (-1, 1, "assistant", trap)]
    assert set(got) == {5, 6, 7, -1}
    for conv, r in got.items():
        own = [(role or "", t or "") for c, _, role, t in rows if c == conv]
        told, learned = "".join(f"{a}\n{b}\n" for a, b in own), "".join(b for a, b in own if a == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert r.loss_chars == len(learned) and r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_empty_table_and_native_plan(spark, parquet):
    folder = parquet("conversations", [], "conv_id bigint, turn bigint, role string, text string")
    out = QUERIES["op10_chat_parts"](spark, folder)
    assert [r.conv_id for r in out.collect()] == [-1]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
