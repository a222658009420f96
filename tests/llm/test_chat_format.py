from __future__ import annotations

import random
import time

import pytest

import oracle
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format as cf
from ledgerloom.llm.common import ORACLES, QUERIES

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", r"[\INST]", r"[\/INST]", r"[/\INST]", r"<\s>", r"</\\s>", "\\", "[", "<",
         "/INST]", "s>", "\n", " ", "ok", "é", "%0A", "%25", "😀"]


def hostile(count: int):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice(PARTS) for _ in range(rng.randrange(n)))
    return [(c, t, rng.choice(["user", "assistant", "system", text(4)]), text(9))
            for c in range(count) for t in range(rng.randrange(1, 5))]


def test_query_equals_sql(spark, small_folder):
    problems, _ = oracle.compare(
        spark, oracle.connect(small_folder), QUERIES["op5_chat_format"], ORACLES["op5_chat_format"], small_folder)
    assert not problems


def test_any_text_comes_back(spark):
    rows = hostile(600)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = cf.format_conversations(frame).select(
        "*", cf.parse(F.col("formatted")).alias("turns"), cf.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    levels = set()
    for r in made.collect():
        own = sorted((t, role, text) for c, t, role, text in rows if c == r.conv_id)
        assert [(x.role, x.text) for x in r.turns] == [(role, text) for _, role, text in own]
        said = [text for _, role, text in own if role == "assistant"]
        assert r.loss == "".join(said) and len(r.loss_spans) == len(said)
        assert all(r.formatted[s.start - 3:s.start] == "<s>" and r.formatted[s.end:s.end + 4] == "</s>" for s in r.loss_spans)
        levels.add(r.level)
    assert levels == {0, 1}


def test_plain_texts_are_not_escaped(spark):
    frame = spark.createDataFrame(
        [(1, 1, "assistant", "b"), (1, 0, "user", "a [INST"), (2, 0, None, None), (2, None, "user", "late"), (None, 0, "user", "x")],
        "conv_id bigint, turn bigint, role string, text string",
    ).withColumn("formatted", F.lit(0))
    got = {r.conv_id: (r.formatted, r.level) for r in cf.format_conversations(frame).collect()}
    assert got[1] == ("[INST]user\na [INST[/INST]<s>b</s>", 0)
    assert got[None] == ("[INST]user\nx[/INST]", 0)
    assert cf.format_conversations(frame.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "word </s> " * 200_000
    frame = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    made = cf.format_conversations(frame).select(cf.parse(F.col("formatted")).alias("turns"), "level").first()
    assert [t.text for t in made.turns] == [text, text] and made.level == 1


def test_plan_has_no_python(spark, small_folder, capsys):
    QUERIES["op5_chat_format"](spark, small_folder).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "")


@pytest.mark.parametrize("text", ["[/INST]" + "<s>" * 330_000, "<s>" * 330_000, "[INST]" * 160_000 + "[/INST]", "</s>" * 250_000])
def test_a_megabyte_of_control_strings_takes_seconds(spark, text):
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "user", "end")],
                                 "conv_id bigint, turn bigint, role string, text string").cache()
    rows.count()
    began = time.perf_counter()
    said = cf.format_conversations(rows).select(cf.parse(F.col("formatted")).alias("turns")).first()
    assert time.perf_counter() - began < 30
    assert [(t.role, t.text) for t in said.turns] == [("user", text), ("assistant", text), ("user", "end")]


def test_other_columns_are_left_alone(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x", "f", 1)], "conv_id bigint, turn bigint, role string, text string, formatted string, level int")
    assert cf.format_conversations(rows).columns == ["conv_id", "formatted", "level", "loss_spans"]
