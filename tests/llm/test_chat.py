"""Chat formatting: what is read back is what was given, whatever the texts hold."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import chat

TURNS = f"conv_id long, turn long, role string, parts array<{chat.PART}>, formatted string, place int"


def text(t):
    return ("text", t, None, None, None, None, None)


def image(ref, w=None, h=None):
    return ("image", None, ref, w, h, None, None)


def hard_texts(n):
    rng = random.Random(n)
    bits = ["\\", "#", "##", "###", "</turn>", "<", "/turn>", "</turn", "\n", ": ", ":", " ", "a", "é", "😀", "\\[image:0]", "[image:1]", "$1", "\r\n", "<|end|>"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_hard_texts_and_roles_come_back(spark):
    texts = hard_texts(300)
    rows = [(i // 5, i % 5, "assistant" if i % 2 else texts[-i - 1], [text(t[: len(t) // 2]), text(t[len(t) // 2 :])], "x", 1) for i, t in enumerate(texts)]
    out = chat.formatted(spark.createDataFrame(rows, TURNS).repartition(7))
    got = {r.conv_id: r for r in out.select("*", chat.read_turns().alias("turns"), chat.read_loss().alias("loss")).collect()}
    for conv in range(60):
        own = [r for r in rows if r[0] == conv]
        whole = [(r[2], r[3][0][1] + r[3][1][1]) for r in own]
        assert [tuple(t) for t in got[conv].turns] == whole
        assert got[conv].loss == "".join(t for role, t in whole if role == "assistant")
        assert got[conv].formatted.count("</turn>") == len(own) == got[conv].n_turns
        body = got[conv].formatted.encode()
        for s in got[conv].loss_spans:
            assert got[conv].formatted[s.start : s.start + s.length].encode() == body[s.start_byte : s.start_byte + s.n_bytes]


def test_parts_become_numbered_placeholders(spark):
    rows = [
        (1, 0, "user", [text("see "), image("a.png", 600, 500), text(" and \\[audio:9]"), ("audio", None, "b.wav", None, None, 2.5, None)], "", 0),
        (1, 1, "assistant", [text("fine")], "", 0),
        (1, 2, "user", [("document", "not shown", "c.pdf", None, None, None, 3), image(None), ("video", "unknown kind", "d", None, None, None, None), None], "", 0),
    ]
    (r,) = chat.formatted(spark.createDataFrame(rows, TURNS)).withColumn("turns", chat.read_turns()).collect()
    assert r.formatted == (
        "### user: see \\[image:0] and \\\\[audio:9]\\[audio:1]</turn>\n### assistant: fine</turn>\n"
        "### user: \\[document:2]\\[image:3]unknown kind</turn>\n"
    )
    assert [t.text for t in r.turns] == ["see  and \\[audio:9]", "fine", "unknown kind"]
    costs = chat.Costs()
    tokens = [2 * costs.per_tile + costs.per_image, 63, 3 * costs.per_page, costs.per_image]
    assert [tuple(a) for a in r.attachments] == [
        (0, 0, "image", "a.png", tokens[0]), (1, 0, "audio", "b.wav", tokens[1]),
        (2, 2, "document", "c.pdf", tokens[2]), (3, 2, "image", None, tokens[3]),
    ]
    assert r.attachment_tokens == sum(tokens)


def test_nulls_ties_repeats_and_order(spark):
    rows = [
        (None, 2, "user", [text("b")]), (None, None, "user", None), (5, 1, "assistant", [text("z")]), (5, 1, "assistant", [text("z")]),
        (5, 1, "assistant", [text("a")]), (5, 0, None, [text(None)]), (6, 10, "user", []), (6, 9, "user", [text("nine")]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    got = {r.conv_id: r.formatted for r in chat.formatted(df).collect()}
    assert got == {
        None: "### user: </turn>\n### user: b</turn>\n",
        5: "### : </turn>\n### assistant: a</turn>\n### assistant: z</turn>\n### assistant: z</turn>\n",
        6: "### user: nine</turn>\n### user: </turn>\n",
    }


def test_empty_and_very_long(spark):
    assert chat.formatted(spark.createDataFrame([], TURNS)).count() == 0
    long = "<#\\ é</turn>###" * 200_000
    many = [(2, i, "assistant", [text(f"{i}é")], "", 0) for i in range(3000)]
    df = spark.createDataFrame([(1, 0, "assistant", [text(long)], "", 0), *many], TURNS)
    got = {r.conv_id: r for r in chat.digests(chat.formatted(df)).collect()}
    assert got[1].loss_chars == len(long) and got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[2].n_turns == 3000
    assert got[2].loss_sha256 == hashlib.sha256("".join(f"{i}é" for i in range(3000)).encode()).hexdigest()


def test_no_python_in_the_plan(spark):
    df = chat.digests(chat.formatted(spark.range(3).select(
        (F.col("id") % 2).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), chat.text_parts(F.lit("x")).alias("parts"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("t", ["####", "#####", "######</turn></turn>", "\\\\###\\", "<</turn>", "</turn</turn>"])
def test_marks_never_stay(spark, t):
    row = spark.range(1).select(chat.escaped(F.lit(t)).alias("e")).withColumn("u", chat.unescaped(F.col("e"))).first()
    assert "###" not in row.e and "</turn>" not in row.e and row.u == t
