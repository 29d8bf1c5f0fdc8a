"""Files with awkward shapes."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from scoreline.operators.columns import on_text_columns, rename_positions
from scoreline.functions.numbers import strip_thousands
from scoreline.sources import csv, html, json, sinks, tables
from scoreline.storage import release, settle, workspace


def test_two_row_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(' , ,Overall,Overall,\n#,Team,K,K/D,year\n1,X,"13,857",1.1,2024\n')
    (tmp_path / "b.csv").write_text(' , ,Overall,Overall,\n#,Team,K,K/D,year\n2,Y,"9,001",0.9,2025\n')
    df = csv.read_two_row_header(spark, str(tmp_path))
    assert df.columns == [" _#", " _Team", "Overall_K", "Overall_K/D", "_year"]
    clean = on_text_columns(rename_positions(df, ["rank", "team"], ["year"]), strip_thousands)
    assert rows_of(clean) == [("1", "X", "13857", "1.1", "2024"), ("2", "Y", "9001", "0.9", "2025")]


def test_header_names_must_match_the_schema(spark, tmp_path):
    (tmp_path / "games.csv").write_text("team_1_name,team_2_name\nA,B\nB,A\n")
    df = csv.read_with_header(spark, str(tmp_path), "team_1_name string, team_2_name string")
    assert rows_of(df) == [("A", "B"), ("B", "A")]
    with pytest.raises(Exception):
        csv.read_with_header(spark, str(tmp_path), "other string, team_2_name string").collect()


def test_json_map(frame):
    df = frame([('{"1": {"team1_id": "3", "team2_id": "4"}, "2": {"team1_id": "5"}}',)], "text string")
    assert rows_of(json.map_rows(df, "text", "struct<team1_id:string,team2_id:string>")) == [("1", "3", "4"), ("2", "5", None)]


def test_json_pages(frame):
    text = '{"pageProps": {"matches": [{"id": 1, "score": 2.5}, {"id": 2}], "event": [{"id": 9}], "empty": []}}'
    found = json.page_tables(frame([(text,)], "text string"), "text", "pageProps",
                             {"matches": "struct<id:int,score:double>", "event": "struct<id:int>", "empty": "struct<id:int>"},
                             skipped=["event"])
    assert sorted(found) == ["empty", "matches"]
    assert rows_of(found["matches"]) == [("1", "2.5"), ("2", None)]
    assert found["empty"].count() == 0


def test_json_parent(frame):
    text = '{"team": {"id": 7, "players": [{"id": 1, "tag": "a"}, {"id": 2, "tag": "b"}]}, "standings": {"w": 3, "l": 0}}'
    df = json.children_with_parent(
        frame([(text,), ('{"notFound": true}',)], "text string"), "text",
        "struct<team:struct<id:int,players:array<struct<id:int,tag:string>>>,standings:struct<w:int,l:int>>", "team.players",
        {"team_id": F.col("doc.team.id"), "rate": F.try_divide(F.col("doc.standings.w"), F.col("doc.standings.w") + F.col("doc.standings.l"))})
    assert rows_of(df) == [(7, 1.0, 1, "a"), (7, 1.0, 2, "b")]


def test_json_flatten(frame):
    df = frame([(1, '{"a": {"b": 2, "c": {"d": "x"}}, "e": 3}')], "id int, doc string")
    flat = json.parse_and_flatten(df, "doc", "struct<a:struct<b:int,c:struct<d:string>>,e:int>")
    assert flat.columns == ["id", "doc_a_b", "doc_a_c_d", "doc_e"] and rows_of(flat) == [(1, 2, "x", 3)]


def test_html_tables(frame):
    page = ("<table><tr><th>Team<th>MW%</tr><tr><td>A &amp; B</td><td>64%</td></tr>"
            "<tr><td><table><tr><td>inner</td></tr></table></td></tr></table><p>x</p><table><tr><td>2</td></tr></table>")
    rows = html.table_rows(frame([(1, page), (2, None), (3, "<p>none</p>")], "id int, html string"), "id", "html").collect()
    found = {(r["id"], r["table_no"], r["row_no"]): list(r["cells"]) for r in rows}
    assert found[(1, 0, 0)] == ["Team", "MW%"] and found[(1, 0, 1)] == ["A & B", "64%"]
    assert found[(1, 1, 0)] == ["inner"] and found[(1, 2, 0)] == ["2"]
    assert {k[0] for k in found} == {1}


def test_html_links(frame):
    page = '<li><a href="/a">A</a></li><li><a href="/b">B</a></li>'
    assert rows_of(html.links(frame([(1, page), (2, "<p>")], "id int, html string"), "id", "html")) == [
        (1, 1, "/a", "A"), (1, 2, "/b", "B")]


def test_sinks(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    empty, two = frame([], "id int"), frame([(1,), (2,)], "id int")
    assert sinks.append_table(empty, path) is False
    assert sinks.append_table(two, path) and sinks.append_table(two, path)
    assert tables.scan(spark, path).count() == 4
    assert sinks.replace_table(two, path) and tables.scan(spark, path).count() == 2


def test_projected_scan_is_pushed(spark, small):
    df = tables.projected_scan(spark, f"{small}/orders.parquet", ["o_orderkey"], F.col("o_orderstatus") == "F")
    plan = df._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_workspace_follows_the_session(spark, frame):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = workspace(spark, "x")
    assert path != workspace(spark, "x")
    assert base is None or path.startswith(base)
    assert rows_of(settle(frame([(1, None)], "a int, b string"))) == [(1, None)]
    assert settle(frame([], "a int, b string")).schema.names == ["a", "b"]


def test_release_deletes_what_was_written(spark, frame):
    kept = settle(frame([(1,)], "a int"))
    assert kept.count() == 1 and release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0])


def test_html_spans(frame):
    page = ("<table><tr><th rowspan=2>Player<th colspan='2'>Overall</tr><tr><th>K/D</th><th>K/D</th></tr>"
            "<tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td><td>3</td></tr></table>")
    df = html.wide_table(frame([("u", page)], "url string, html string"), "url", "html", 0)
    assert df.columns == ["url", "Player_Player", "Overall_KD", "Overall_KD.1"]
    assert rows_of(df) == [("u", "a", "1", None), ("u", "b", "2", "3")]


def test_spans_are_numbers_within_the_limits_of_html(frame):
    page = "<table><tr><th colspan='²'>A<th>B</tr><tr><td colspan='5000000'>x</td></tr><tr><td rowspan='99999999999999999999'>y</td><td colspan=''>z</td></tr></table>"
    rows = html.wide_table(frame([("u", page)], "url string, html string"), "url", "html", 0).collect()
    assert html._span([("colspan", "5000000")], "colspan") == 1000 and html._span([("rowspan", "9" * 20)], "rowspan") == 65534
    assert html._span([("colspan", "²")], "colspan") == 1 and html._span([("colspan", "007")], "colspan") == 7 and len(rows) == 1
