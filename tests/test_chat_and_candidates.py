"""Rendering (P1-P6, P13, P14) and candidate reshaping."""

import pytest
from pyspark.sql import functions as F

from pairforge.functions.chat import DEFAULT_BOS, normalise_chat, render_chat, reward_model_text
from pairforge.functions.text import PY_WHITESPACE, py_strip, strip_echo
from pairforge.operators.candidates import drop_short, join_candidates, overlength_guard, to_long, to_wide
from pairforge.operators.tokens import role_mask

MSG = "array<struct<role:string,content:string>>"


def one(spark, value, ddl, expr):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(expr(F.col("v")).alias("x")).first().x


def test_strip_matches_python(spark):
    vals = ["\n hi　\t", "", " ", "　", "x", " a b ", "\u0085x ", "  ", None,
            "aé", "  z  ", "\x1c\x1d\x1e\x1fq"] + [c + "w" + c for c in PY_WHITESPACE]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(py_strip("v").alias("s"))
    assert [r.s for r in df.collect()] == [None if v is None else v.strip() for v in vals]


def test_render_empty_list(spark):
    assert one(spark, [], MSG, render_chat) == ""
    assert one(spark, [], MSG, lambda c: render_chat(c, add_generation_prompt=True)) == \
        "<|start_header_id|>assistant<|end_header_id|>\n\n"


def test_render_two_messages(spark):
    msgs = [("system", "  be brief \n"), ("user", "\n hi　\t")]
    got = one(spark, msgs, MSG, render_chat)
    assert got == (DEFAULT_BOS + "<|start_header_id|>system<|end_header_id|>\n\nbe brief<|eot_id|>"
                   "<|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>")


def test_reward_text_removes_every_bos(spark):
    df = spark.createDataFrame([([("user", f"a{DEFAULT_BOS}b")], "r")], f"m {MSG}, r string")
    got = df.select(reward_model_text("m", "r").alias("x")).first().x
    assert DEFAULT_BOS not in got
    assert got.endswith("<|start_header_id|>assistant<|end_header_id|>\n\nr<|eot_id|>")
    assert "ab<|eot_id|>" in got


def test_length_counts_code_points(spark):
    assert one(spark, "a\U0001F600b", "string", F.length) == 3


def test_strip_echo_short_text(spark):
    df = spark.createDataFrame([("abc", "abcdef"), ("abcdefXY", "abcdef")], "t string, p string")
    assert [r.x for r in df.select(strip_echo("t", "p").alias("x")).collect()] == ["", "XY"]


def test_normalise_chat(spark):
    conv = [("system", "s"), ("human", "q"), ("gpt", "a")]
    df = spark.createDataFrame([(conv,)], "c array<struct<`from`:string,value:string>>")
    out = df.select(normalise_chat("c", {"system": "system", "human": "user", "gpt": "assistant"}).alias("m")).first().m
    assert [(m.role, m.content) for m in out] == [("system", "s"), ("user", "q"), ("assistant", "a")]
    bad = spark.createDataFrame([([("robot", "x")],)], "c array<struct<`from`:string,value:string>>")
    with pytest.raises(Exception):
        bad.select(normalise_chat("c", {"human": "user"})).collect()


def test_role_mask(spark):
    df = spark.createDataFrame([(1, 0, "user", "a b"), (1, 1, "assistant", "c  d e")],
                               "row_id long, turn long, role string, content string")
    out = role_mask(df).collect()
    assert sum(1 for r in out if r.label == -100) == 2
    assert sum(1 for r in out if r.label != -100) == 3


def test_long_wide_round_trip(spark):
    rows = [(1, 2, "c", 0.5), (1, 0, "a", 1.0), (1, 1, "b", -1.0), (2, 0, "x", 2.0)]
    long = spark.createDataFrame(rows, "row_id long, k int, response string, reward double")
    wide = to_wide(long)
    got = {r.row_id: (r.responses, r.rewards) for r in wide.collect()}
    assert got[1] == (["a", "b", "c"], [1.0, -1.0, 0.5])
    back = sorted(map(tuple, to_long(wide).collect()))
    assert back == sorted((r, k, t, w) for r, k, t, w in rows)


def test_drop_short_keeps_extra(spark):
    df = spark.createDataFrame([(1, ["a"] * 5), (2, ["a"] * 3), (3, ["a"] * 4)], "row_id long, responses array<string>")
    assert sorted(r.row_id for r in drop_short(df, 4).collect()) == [1, 3]


def test_overlength_guard(spark):
    df = spark.createDataFrame([(1, "x" * 10, ["a"]), (2, "x" * 3, ["a"])],
                               "row_id long, p string, responses array<string>")
    got = {r.row_id: r.responses for r in overlength_guard(df, 5, F.col("p")).collect()}
    assert got == {1: [], 2: ["a"]}


def test_join_candidates_strict(spark):
    prompts = spark.createDataFrame([(1, [("user", "q")]), (2, [("user", "r")])], f"row_id long, context_messages {MSG}")
    resp = spark.createDataFrame([(1, ["a", "b"])], "row_id long, responses array<string>")
    assert join_candidates(prompts, resp).count() == 1
    with pytest.raises(RuntimeError):
        join_candidates(prompts, resp, strict=True)


def test_reward_text_from_rendered_prompt_is_equal(spark):
    from pairforge.functions.chat import reward_model_text_rendered
    rows = [([], "r"), ([("user", "q")], "a"), ([("system", f" s{DEFAULT_BOS} "), ("user", "x")], f"{DEFAULT_BOS}b "),
            ([("user", "<|begin_of_")], "text|>tail")]
    df = spark.createDataFrame(rows, f"m {MSG}, r string")
    out = df.select(reward_model_text("m", "r").alias("a"),
                    reward_model_text_rendered(render_chat("m"), "r").alias("b")).collect()
    assert all(x.a == x.b for x in out)


def test_render_long_equals_render_chat(spark):
    from pairforge.functions.chat import render_long
    rows = [(1, 2, "assistant", " a "), (1, 0, "system", "s"), (1, 1, "user", f"q{DEFAULT_BOS}"), (2, 5, "user", "solo")]
    long = spark.createDataFrame(rows, "row_id long, turn long, role string, content string")
    got = {r.row_id: r.text for r in render_long(long, add_generation_prompt=True).collect()}
    lists = {1: [("system", "s"), ("user", f"q{DEFAULT_BOS}"), ("assistant", " a ")], 2: [("user", "solo")]}
    wide = spark.createDataFrame([(k, v) for k, v in lists.items()], f"row_id long, m {MSG}")
    exp = {r.row_id: r.text for r in wide.select("row_id", render_chat("m", add_generation_prompt=True).alias("text")).collect()}
    assert got == exp
