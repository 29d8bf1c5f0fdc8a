"""Nothing is dropped or mixed up in silence, and numbers survive size."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from scoreline.models import evaluate, simulate, train
from scoreline.operators import order, sample, stats
from scoreline.sources import csv, html, json, sinks


def page(header, *rows):
    cells = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in (header, *rows))
    return f"<table>{cells}</table>"


def test_pages_are_united_by_name(frame):
    pages = frame([("a", page(["Player", "K", "D", ""], ["x", 1, 2, "-"])), ("b", page(["Player", "D", "K", "A"], ["y", 3, 4, 5])),
                   ("a", page(["Player", "K"], ["z", 6])), (None, None)], "url string, html string")
    wide = html.wide_table(pages, "url", "html", 0, header_rows=1)
    assert wide.columns == ["url", "Player", "D", "K", "A"]
    assert rows_of(wide) == [("a", "x", "2", "1", None), ("a", "z", None, "6", None), ("b", "y", "3", "4", "5")]


def test_too_many_names_are_an_error(frame):
    pages = frame([(1, page([f"c{i}" for i in range(9)], range(9)))], "url int, html string")
    with pytest.raises(ValueError, match="names"):
        html.wide_table(pages, "url", "html", 0, header_rows=1, most_columns=8)


def test_links_of_any_spelling(frame):
    text = """<a href="/1">one</a><A class="x" href='/2' id=y>two <b>bold</b></A><a
      href = /3>three</a ><a data-href="/no" href="/4"></a><abbr href="/5">no</abbr>"""
    assert rows_of(html.links(frame([(7, text)], "page int, html string"), "page", "html")) == [
        (7, 1, "/1", "one"), (7, 2, "/2", "two bold"), (7, 3, "/3", "three"), (7, 4, "/4", "")]


def test_rows_like_a_header_line_are_kept(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text("All,All\nPlayer,K\nPlayer,K\nAll,All\nx,1\n")
    assert rows_of(csv.read_two_row_header(spark, str(tmp_path))) == [("All", "All")] * 2 + [("Player", "K")] * 2 + [("x", "1")] * 2


def test_broken_documents_are_an_error_or_shown(frame):
    documents = frame([('{"1": {"k": 5}}',), ("{broken",), (None,)], "text string")
    with pytest.raises(Exception, match="MALFORMED"):
        json.map_rows(documents, "text", "struct<k:int>").collect()
    assert rows_of(json.map_rows(documents, "text", "struct<k:int>", mode="PERMISSIVE")) == [("1", 5)]
    assert rows_of(json.malformed(documents, "text")) == [("{broken",)]


def test_tables_are_found_in_documents(frame):
    documents = frame([('{"r": {"a": [{"x": 1, "y": "u"}, {"x": null}], "b": [{"z": true}], "c": "no", "d": [1]}}',)], "text string")
    found = json.found_tables(documents, "text", "r", skipped=["b"]).drop("document")
    assert rows_of(found) == [("a", 0, "x", "1"), ("a", 0, "y", "u"), ("a", 1, "x", None)]


def test_failed_replacement_keeps_the_table(spark, tmp_path, frame):
    path = str(tmp_path / "table")
    assert sinks.replace_table(frame([(1,)], "a int"), path)
    bad = frame([(0,)], "a int").select(F.raise_error(F.lit("no")).cast("int").alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(bad, path)
    assert not sinks.replace_table(frame([], "a int"), path)
    assert rows_of(spark.read.parquet(path)) == [(1,)]
    # The table may be read while it is replaced.
    assert sinks.replace_table(spark.read.parquet(path).select((F.col("a") + 1).alias("a")), path)
    assert sinks.append_table(frame([(5,)], "a int"), path)
    spark.catalog.refreshByPath(path)
    assert rows_of(spark.read.parquet(path)) == [(2,), (5,)]


def test_games_with_missing_features_are_predicted(frame):
    rows = frame([(i, float(i % 2) if i % 7 else None, float("nan") if i == 3 else 1.0, i % 2) for i in range(40)], "game int, a double, b double, label int")
    made = train.model_input(rows, ["a", "b"], {"a": 0.5})
    assert made.count() == 40
    values = {r["game"]: r["features"].toArray().tolist() for r in made.collect()}
    assert values[0] == [0.5, 1.0, 1.0] and values[3] == [1.0, 0.0, 1.0] and values[1] == [1.0, 1.0, 0.0]
    model = train.forest(trees=3, depth=3).fit(train.training_table(rows, ["a", "b"], ["game"], ["game", "label"]))
    votes = simulate.noise_ensemble(rows, "game", ["a", "b"], lambda r: model.transform(train.model_input(r, ["a", "b"])), "prediction", draws=5)
    assert votes.count() == 40


def test_pairings_are_simulated_once(frame):
    games = frame([(1, "a", "b", 0.2), (2, "a", "b", 0.2), (3, "b", "a", -0.2), (4, None, "a", -0.9)], "game int, one string, two string, score double")
    seen = []

    def run(pairings, key):
        seen.append(pairings.count())
        return simulate.noise_ensemble(pairings, key, ["score"], lambda r: r.withColumn("p", (F.col("score") > 0).cast("int")), "p", draws=2000, scale=0.3)

    votes = {r["game"]: r for r in simulate.by_pairing(games, "game", ["one", "two"], ["score"], run).collect()}
    assert seen == [3] and len(votes) == 4 and votes[1]["team_2_win_prob"] == votes[2]["team_2_win_prob"] and votes[1]["draws"] == 2000
    assert votes[1]["team_2_win_prob"] == pytest.approx(0.75, abs=0.04) and votes[4]["winner_pred"] == 0


def test_roles_and_classes_may_be_missing(frame):
    rows = frame([(["x", "y", None][i % 3], float(i), float(i % 5), float(2 * i)) for i in range(60)], "role string, a double, b double, t double")
    weights = train.importance_weights(rows, "role", ["a", "b"], ["t"], trees=3, depth=3)
    assert sorted((r["role"] or "") for r in weights.collect()) == ["", "x", "y"]
    with pytest.raises(ValueError, match="roles"):
        train.importance_weights(rows, "role", ["a"], ["t"], most_roles=2)
    with pytest.raises(Exception, match="(?i)null"):
        train.index_classes(rows, "role", "class").collect()


def test_variance_analysis_far_from_zero(frame):
    rng = random.Random(4)
    near = [(g, rng.gauss(g, 1.0)) for g in (1, 2, 3) for _ in range(30)]
    a = stats.anova_oneway(frame(near, "g int, v double"), "g", "v").first()
    b = stats.anova_oneway(frame([(g, v + 1e9) for g, v in near], "g int, v double"), "g", "v").first()
    assert a["f_statistic"] == pytest.approx(b["f_statistic"], rel=1e-5) and a["p_value"] == pytest.approx(b["p_value"], rel=1e-4)


@pytest.mark.parametrize("n", [1, 3, 40, 1e4, 1e8, 1e10])
def test_f_tail_of_equal_degrees(n):
    assert stats.f_distribution_tail(1.0, n, n) == pytest.approx(0.5, abs=1e-9)


def test_f_tail_of_uneven_degrees():
    # With two degrees above, the tail has a closed form; with endlessly many below it tends to exp(-f).
    for f in (0.3, 1.0, 7.0):
        assert stats.f_distribution_tail(f, 2, 30) == pytest.approx((1 + 2 * f / 30) ** -15, rel=1e-12)
        assert stats.f_distribution_tail(f, 2, 1e12) == pytest.approx(2.718281828459045 ** -f, rel=1e-5)
    assert stats.f_distribution_tail(1.0, 4, 1e12) == pytest.approx(0.40600585, abs=1e-7)


def test_correlation_ignores_nan_and_takes_forty_columns(frame, spark):
    rows = frame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (float("nan"), 100.0), (4.0, None)], "a double, b double")
    found = {(r[0], r[1]): r[2] for r in stats.correlation_rows(rows, ["a", "b"]).collect()}
    assert found["a", "b"] == pytest.approx(0.999015, abs=1e-5) and found["a", "a"] == pytest.approx(1)
    wide = spark.range(200).select(*[F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(97)).alias(f"c{i}") for i in range(40)])
    matrix = stats.correlation_rows(wide, wide.columns).collect()
    assert len(matrix) == 1600 and all(abs(r[2] - 1) < 1e-9 for r in matrix if r[0] == r[1])


def test_curve_area_counts_in_doubles(spark):
    scores = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.4, 0), (0.9, 1)], "score double, label int")
    assert evaluate.roc_auc(scores, "label", "score").first()[0] == pytest.approx(0.875)
    plan = evaluate.roc_auc(scores, "label", "score")._jdf.queryExecution().analyzed().toString()
    assert "cast(sum(_pos" in plan and "cast(sum(_neg" in plan


def test_ranks_are_wide(frame):
    ranked = order.average_rank(frame([(3.0,), (2.0,), (2.0,), (None,)], "s double"), "s", "rank")
    assert dict(ranked.dtypes)["rank"] == "bigint" and rows_of(ranked) == [(2.0, 2), (2.0, 2), (3.0, 1), (None, None)]


def test_samples_need_a_unique_key(frame):
    rows = frame([(i // 10, i) for i in range(100)], "k int, i int")
    with pytest.raises(ValueError, match="unique"):
        sample.sample_n(rows, 15, 1, ["k"]).count()
    assert sample.sample_n(rows, 15, 1, ["k", "i"]).count() == 15
