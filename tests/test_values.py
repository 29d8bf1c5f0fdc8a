"""Text, number and seeded expressions on hand-made values."""

import math

import pytest
from pyspark.sql import functions as F

from scoreline.functions import numbers as N
from scoreline.functions import seeded
from scoreline.functions import text as X
from scoreline.operators import columns as C


def one(frame, value, kind, expression):
    return frame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize("text, number", [
    ("12.5", 12.5), ("nan", None), ("x", None), (None, None), ("", None), (" 7 ", 7.0), ("-3e2", -300.0)])
def test_coerce_numeric(frame, text, number):
    assert one(frame, text, "string", N.coerce_numeric) == number


@pytest.mark.parametrize("text, number", [("70.50%", 0.705), ("64%", 0.64), ("-", None), (None, None)])
def test_percent(frame, text, number):
    assert one(frame, text, "string", N.percent_to_ratio) == (pytest.approx(number) if number is not None else None)


@pytest.mark.parametrize("value, cut", [(1.23456, 1.234), (-1.23456, -1.234), (0.0, 0.0), (2.0, 2.0), (None, None)])
def test_trunc(frame, value, cut):
    assert one(frame, value, "double", N.trunc_decimals) == cut


@pytest.mark.parametrize("value, limited", [(-0.5, 0.0), (0.25, 0.25), (1.5, 1.0), (None, None)])
def test_clip(frame, value, limited):
    assert one(frame, value, "double", N.clip) == limited


def test_division_by_zero_gives_null(frame):
    row = frame([(4.0, 0.0)], "a double, b double").select(
        N.ratio(F.col("a"), F.col("b")), N.sum_then_rate([F.col("a"), F.col("a")], F.col("b"))).first()
    assert tuple(row) == (None, None)


def test_choices(frame):
    df = frame([(0.5, 0.5), (0.6, 0.4), (0.4, 0.6)], "a double, b double")
    assert [r[0] for r in df.select(N.choose_greater(F.col("a"), F.col("b"))).collect()] == [1, 0, 1]
    assert [r[0] for r in df.select(N.argmax(F.col("a"), F.col("b"))).collect()] == [0, 0, 1]


def test_label_counts_null_as_other(frame):
    df = frame([(1, 1), (2, 1), (None, 1)], "w int, t int")
    assert [r[0] for r in df.select(N.equality_label(F.col("w"), F.col("t"))).collect()] == [1, 0, 0]


@pytest.mark.parametrize("url, found", [
    ("https://a/_next/data/HASH/x.json", "HASH"), ("https://a/_next/data/HASH", "HASH"), ("https://a/b", None)])
def test_between(frame, url, found):
    assert one(frame, url, "string", lambda c: X.between(c, "/_next/data/", "/")) == found


def test_first_match(frame):
    assert one(frame, "https://x/2024_Season/2025", "string", X.first_match) == "2024"
    assert one(frame, "none", "string", X.first_match) is None


def test_non_breaking_blank(frame):
    assert one(frame, "a b", "string", lambda c: X.replace_text(c, {" ": " "})) == "a b"


def test_concat_key_with_null(frame):
    df = frame([(1, 2), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(X.concat_key(F.col("a"), F.col("b"))).collect()] == ["1-2", None]


def test_map_values_absent(frame):
    df = frame([(0,), (9,), (None,)], "r int")
    assert [r[0] for r in df.select(X.map_values(F.col("r"), {0: "Slayer"})).collect()] == ["Slayer", None, None]


@pytest.mark.parametrize("name, clean, snake", [
    ("S&D Win %", "S_DWin%", "s_d_win_pct"), ("HP +/-", "HP+-", "hp_diff"), ("T.E.S", "T.E.S", "t_e_s"),
    ("HP K/10M", "HPK10M", "hp_k_10m"), ("First Blood %", "FirstBlood%", "first_blood_pct")])
def test_names(name, clean, snake):
    assert X.clean_name(name) == clean
    assert X.snake_name(name) == snake


@pytest.mark.parametrize("name, other", [
    ("mw_team1", "mw_team2"), ("mw_team2", "mw_team1"), ("team_1_id", "team_2_id"), ("team_2_score", "team_1_score"),
    ("winner_id", "winner_id")])
def test_other_side(name, other):
    assert C.other_side(name) == other


def test_names_with_dots_survive(frame):
    df = frame([(1.0, 2.0)], "`T.E.S` double, `K/D` double")
    assert C.select_columns(df, ["K/D", "T.E.S"]).columns == ["K/D", "T.E.S"]
    assert C.select_numeric(df).columns == ["T.E.S", "K/D"]


def test_header_levels():
    assert C.join_header_levels(["Overall", "S&D"], ["K/D", "Win %"]) == ["Overall_KD", "S_D_Win%"]
    assert C.join_header_levels(["Overall"], ["K/D"]) == ["Overall_KD"]


def test_strict_cast_fails(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        C.cast_columns(frame([("x",)], "v string"), {"v": "double"}).collect()


def test_gaussian_moments_and_stability(spark):
    df = spark.range(20000)
    for draw in (seeded.hash_gaussian(1, F.col("id"), scale=0.5), seeded.fast_gaussian(1, F.col("id"), scale=0.5)):
        mean, sd, low, high = df.select(draw.alias("g")).agg(
            F.avg("g"), F.stddev("g"), F.min("g"), F.max("g")).first()
        assert abs(mean) < 0.02 and abs(sd - 0.5) < 0.02
        assert math.isfinite(low) and math.isfinite(high)
        once = df.repartition(1).select("id", draw.alias("g")).agg(F.sum(F.hash("id", "g"))).first()
        again = df.repartition(7).select("id", draw.alias("g")).agg(F.sum(F.hash("id", "g"))).first()
        assert once == again


def test_hash_bucket_range(spark):
    counts = spark.range(20000).select(seeded.hash_bucket(42, F.col("id")).alias("b")).groupBy("b").count().collect()
    assert {r["b"] for r in counts} == set(range(100))
    assert all(120 < r["count"] < 290 for r in counts)
