"""Golden cases worked out by hand, and properties against plain Python."""

import re
import time

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import packing as pk
from tidemark.functions import scans
from tidemark.functions import text as tx
from tidemark.functions import timing as tm
from tidemark.operators.timeline import snap


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "value, function, expected",
    [
        ("a b中文，12", tx.text_width, 5.5),
        (" [Music] ", tx.is_pure_marker, True),
        ("[x] hi", tx.is_pure_marker, False),
        ("Ça-va, L'Été!", tx.norm, "caval'ete"),
        ("in 1.17 we go. Next", tx.sentences_en, ["in 1.17 we go.", "Next"]),
        ("真的？！好。", tx.sentences_zh, ["真的？", "！", "好。"]),
        ("See Mr. Fox. He ran... far. Ok", tx.sentences_subtitle, ["See Mr. Fox.", "He ran... far.", "Ok"]),
        ("main (aka alt); B*", tx.split_terms, ["main", "alt", "B"]),
        ("world edit/WorldEdit", tx.term_forms, ["world edit", "worldedit", "world-edit", "WorldEdit", "World Edit"]),
        ("a 【延伸句】tail of it. b", tx.strip_stitch_marks, "a  b"),
        ("a 【承接句】lead", tx.strip_stitch_prefix, "a lead"),
        ("（一", tx.bracket_state, "bracket"),
        ("“一”", tx.quote_state, "ok"),
        ("中 文 a b", tx.collapse_mixed, "中文 a b"),
        ("x-片3", tx.label_gid, "x"),
        ("x-片3", tx.label_part, 3),
        ("x-片y", tx.label_part, 1),
        ("a/b c\\d", tx.safe_name, "a_b_c_d"),
        ("01:02:03,004", tm.parse_time, 3723004),
        ("bad", tm.parse_time, None),
        ("甲的 乙", tx.norm_zh, "甲乙"),
    ],
)
def test_golden(spark, value, function, expected):
    assert one(spark, value, function) == expected


def test_word_pattern_bounds(spark):
    df = spark.createDataFrame([("B36", "B36 and B360", True), ("B36", "B360", False), ("box", "two boxes", True), ("col.umn", "colxumn", False)], "f string, t string, want boolean")
    rows = df.select("t", "want", tx.word_pattern(F.col("f")).alias("p"))
    assert all(r["got"] == r["want"] for r in rows.withColumn("got", F.expr("t rlike p")).collect())


def test_times(spark):
    row = spark.range(1).select(tm.format_time(F.lit(3723004)).alias("a"), tm.format_time(F.lit(-5)).alias("b"), *[tm.round_100(F.lit(x)).alias(f"r{x}") for x in (50, 150, 250, 350)]).first()
    assert (row["a"], row["b"]) == ("01:02:03,004", "00:00:00,000")
    assert [row[f"r{x}"] for x in (50, 150, 250, 350)] == [0, 200, 200, 400]
    assert tm.capacity() == 1310 and tm.capacity(amplification=None) == 6553


def test_split_point_and_mismatch(spark):
    row = spark.range(1).select(tm.split_point(F.lit(1000), F.lit(2000), F.lit(3), F.lit(1)).alias("t"), tm.needs_interpolation(F.lit(3271), F.lit(3290)).alias("no"), tm.needs_interpolation(F.lit(800), F.lit(2600)).alias("yes")).first()
    assert (row["t"], row["no"], row["yes"]) == (1750, False, True)


def test_levels(spark):
    text = "这是一个很长的句子需要在逗号处切开，然后继续写下去直到超过宽度；再来一段"
    assert "".join(one(spark, text, tx.split_levels)) == text


def test_zh_brackets():
    assert pk.split_zh("（一。二）三。") == ["（一。二）三。"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab中，", min_size=1, max_size=12), max_size=12))
def test_fill_keeps_all_and_fits(pieces):
    units = pk.fill(pieces)
    assert "".join(units) == "".join(pieces)
    assert all(pk.width(u) <= 26 for u in units)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=80), st.lists(st.floats(0.5, 20), min_size=1, max_size=6))
def test_apportion_keeps_words(text, weights):
    parts = pk.apportion(text, weights)
    assert " ".join(p for p in parts if p).split() == text.split() and len(parts) == len(weights)


@settings(max_examples=200, deadline=None)
@given(st.text("ab \n", max_size=200), st.integers(5, 40))
def test_wrap_width(text, limit):
    assert all(len(line) <= limit for line in pk.wrap(text, limit).split("\n"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=6), st.integers(0, 1000), st.integers(1500, 20000), st.lists(st.integers(0, 22000), max_size=12))
def test_snap_covers_span(weights, start, span, bounds):
    out = snap(weights, start, start + span, sorted(set(bounds)))
    assert out[0][0] == start and out[-1][1] == start + span
    assert all(a[1] == b[0] for a, b in zip(out, out[1:]))


def test_pandas_functions(spark):
    df = spark.createDataFrame([(["aa", "bb", "cc"], "一。二")], "s array<string>, z string")
    row = df.select(pk.greedy_pack("s", F.lit(5)).alias("g"), pk.split_zh_udf("z").alias("z"), pk.apportion_words(F.lit("a b c"), F.array(F.lit(1.0), F.lit(2.0))).alias("w")).first()
    assert row["g"] == ["aa bb", "cc"] and row["z"] == ["一。", "二"] and row["w"] == ["a", "b c"]
    assert pd.Series(row["g"]).size == 2


def test_split_levels_cuts_at_marks_only(spark):
    """A lambda's second parameter is the place in the array: the marks were lost, and letters of their column's name cut words."""
    text = "This is a longer sentence with some more words in it，and another piece of the same long one、with a third"
    want = ["This is a longer sentence with some more words in it，", "and another piece of the same long one、with a third"]
    assert one(spark, text, tx.split_levels) == want
    assert pk.plan(text, [(m, re.compile(f"(?<=[{m}])")) for m in ("，；：", "、", "—")]) == (want, "err")


def test_sentences_zh_of_a_long_text_without_marks(spark):
    text = "字" * 300_000  # quadratic before: every place was searched to the end
    began = time.monotonic()
    assert one(spark, "好。" + text, tx.sentences_zh) == ["好。", text] and time.monotonic() - began < 60


def test_scans_agree_with_the_patterns(spark):
    texts = ["İKK ß Éa'b", "a\x1cb \x85c. d", " x!　y", "", None, "é.  F?! g", "a\x0b\x0cb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    marked = F.regexp_replace(tx.collapse(t), r"([.!?]+)( |$)", "$1\n")
    pairs = [(tx.norm(t), scans.norm(t)), (tx.norm_ascii(t), scans.norm_ascii(t)), (F.filter(F.split(marked, "\n"), lambda s: s != ""), tx.sentences_en(t))]
    for old, new in pairs:
        assert df.filter(~old.eqNullSafe(new)).count() == 0
