import hashlib

import pytest

from indicata.llm import chat
from pyspark.sql import functions as F

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\b\\l\\q", "[INST]", " [/INST]", "<<SYS>>x<</SYS>>", "a\nb", "", " ", "<s", "[ROLE] \n",
         "<", "\\n", "x</s>", "[INST] [/INST] <s> </s>", "é\U0001d518", "\u0000\u0001"]


def conversations():
    rows = []
    for k, t in enumerate(NASTY):
        rows += [(k, 0, "user", t), (k, 1, "assistant", t), (k, 2, "assistant", t + t), (k, 3, "tool", t), (k, 4, t, t)]
    rows += [(100, 0, "user", None), (100, 1, None, "x"), (100, 1, "assistant", None), (100, 1, "assistant", None),
             (None, 0, "user", "no id"), (101, None, "system", "s"), (101, 2, "assistant", "long " * 50_000)]
    rows += [(102, k, "user" if k % 2 == 0 else "assistant", f"t{k}</s>") for k in range(400)]
    return rows


@pytest.fixture(scope="module")
def formatted(spark):
    frame = spark.createDataFrame([(*r, "z") for r in conversations()], "conv_id long, turn long, role string, text string, rendered string")
    return chat.format_conversations(frame).cache()


def test_turns_read_back(formatted):
    want = {}
    for c, n, role, text in conversations():
        want.setdefault(c, []).append(((n is not None, n or 0), role or "", text or ""))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in formatted.collect()}
    assert got == {c: [(r, t) for _, r, t in sorted(v)] for c, v in want.items()}


def test_control_strings_only_where_the_template_puts_them(formatted):
    rows = formatted.select("formatted", F.size("turns").alias("n"), F.regexp_count("formatted", F.lit(chat.CONTROL)).alias("marks")).collect()
    assert all(r.marks == 2 * r.n for r in rows)


def test_plain_turns_are_not_escaped(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a < b [1] \\ c"), (1, 1, "assistant", "yes")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(frame).first().formatted == "[INST] a < b [1] \\ c [/INST]<s> yes </s>"


def test_other_texts_do_not_parse(spark):
    bad = ["[INST] x", "x", "[INST] x </s>", "[INST]x[/INST]", "<s> a </s> ", " <s> a </s>"]
    frame = chat.parse(spark.createDataFrame([(b,) for b in bad], "t string"), "t", "back")
    assert [r.back for r in frame.collect()] == [None] * len(bad)


def test_digests_and_empty_table(formatted, spark):
    row = chat.conversation_digests(formatted).where("conv_id = 0").first()
    t = NASTY[0]
    turns = [("user", t), ("assistant", t), ("assistant", t + t), ("tool", t), (t, t)]
    assert row.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256((t * 3).encode()).hexdigest()
    assert (row.n_turns, row.loss_chars) == (5, len(t) * 3)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_conversations(empty)).count() == 0


def test_native_plan(formatted):
    plan = formatted._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
