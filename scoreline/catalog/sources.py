"""Reading and writing: tables, CSV, JSON, HTML, replace, append."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.changes import union_filling
from ..operators.columns import add_constants, cast_columns
from ..sources import csv, html, json, sinks, tables
from ..storage import workspace
from .registry import query

# Fixed value: the number of rows packed into one landed document.
_DOCUMENT_ROWS = 50

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("src_table_scan", _CUSTOMER_SQL)
def src_table_scan(t):
    return tables.scan(t.spark, t.path("customer"))


@query("src_projected_scan",
       "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def src_projected_scan(t):
    return tables.projected_scan(t.spark, t.path("orders"), ["o_orderkey", "o_custkey", "o_totalprice"],
                                 F.col("o_orderstatus") == "F")


@query("src_csv_header", _CUSTOMER_SQL)
def src_csv_header(t):
    path = workspace(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return csv.read_with_header(t.spark, path, t.customer.schema)


@query("src_csv_two_row_header", """
SELECT c_custkey AS "Overall_Player", c_name AS "Overall_Tag", c_nationkey AS "Team_Id",
       c_acctbal AS "Team_Balance", c_mktsegment AS "Team_Role" FROM customer""")
def src_csv_two_row_header(t):
    # One file for every five thousand customers, each with both header lines.
    path = workspace(t.spark, "csv")
    header = "Overall,Overall,Team,Team,Team\nPlayer,Tag,Id,Balance,Role\n"
    packed = t.customer.groupBy(F.floor(F.col("c_custkey") / 5000).alias("file")).agg(
        F.collect_list(F.to_csv(F.struct(*t.customer.columns))).alias("lines"))
    packed.select("file", F.concat(F.lit(header), F.array_join("lines", "\n")).alias("value")).write.partitionBy("file").text(path)
    rows = csv.read_two_row_header(t.spark, path)
    return cast_columns(rows, {"Overall_Player": "bigint", "Team_Id": "int", "Team_Balance": "double"})


def _customer_documents(t, *columns):
    """Customers packed into documents of a bounded number of rows."""
    return t.customer.groupBy(F.floor(F.col("c_custkey") / _DOCUMENT_ROWS).alias("document")).agg(
        F.collect_list(F.struct(*columns)).alias("rows"))


@query("src_json_map_rows",
       "SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name AS tag, c_nationkey AS team_id FROM customer")
def src_json_map_rows(t):
    packed = _customer_documents(
        t, F.col("c_custkey").cast("string").alias("key"),
        F.struct(F.col("c_name").alias("tag"), F.col("c_nationkey").alias("team_id")).alias("value"))
    documents = packed.select(F.to_json(F.map_from_entries("rows")).alias("text"))
    return json.map_rows(documents, "text", "struct<tag:string,team_id:int>")


def _pages_of_customers(t):
    packed = _customer_documents(t, "*")
    members = F.transform("rows", lambda r: F.struct(
        r["c_custkey"].alias("id"), r["c_name"].alias("tag"), r["c_nationkey"].alias("team_id")))
    balances = F.transform("rows", lambda r: F.struct(
        r["c_custkey"].alias("id"), r["c_acctbal"].cast("int").alias("balance")))
    props = F.struct(members.alias("players"), balances.alias("balances"),
                     F.lit("dark").alias("theme"))
    return packed.select(F.to_json(F.struct(props.alias("page"))).alias("text"))


@query("src_json_explode", """
SELECT 'players' AS table_name, CAST(c_custkey AS VARCHAR) AS id, c_name AS tag,
       CAST(c_nationkey AS VARCHAR) AS team_id, CAST(NULL AS VARCHAR) AS balance FROM customer
UNION ALL
SELECT 'balances', CAST(c_custkey AS VARCHAR), NULL, NULL, CAST(CAST(trunc(c_acctbal) AS INT) AS VARCHAR)
FROM customer""")
def src_json_explode(t):
    found = json.page_tables(
        _pages_of_customers(t), "text", "page",
        {"players": "struct<id:bigint,tag:string,team_id:int>",
         "balances": "struct<id:bigint,balance:int>", "theme": "string"},
        skipped=["theme"])
    return union_filling(*[add_constants(df, {"table_name": name}) for name, df in found.items()])


@query("src_json_found_tables", """
SELECT 'players' AS table_name, column_name, value, count(*) AS n FROM (
  UNPIVOT (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS tag, CAST(c_nationkey AS VARCHAR) AS team_id FROM customer)
  ON id, tag, team_id INTO NAME column_name VALUE value) u GROUP BY ALL
UNION ALL
SELECT 'balances', column_name, value, count(*) FROM (
  UNPIVOT (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(CAST(trunc(c_acctbal) AS INT) AS VARCHAR) AS balance FROM customer)
  ON id, balance INTO NAME column_name VALUE value) u GROUP BY ALL""")
def src_json_found_tables(t):
    cells = json.found_tables(_pages_of_customers(t), "text", "page")
    return cells.groupBy("table_name", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


@query("src_json_parent_broadcast", """
SELECT c_nationkey AS team_id, n_name AS name, c_custkey AS id, c_name AS tag,
       CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS match_wins,
       CAST(sum(CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END) OVER w AS BIGINT) AS match_losses
FROM customer JOIN nation ON n_nationkey = c_nationkey
WINDOW w AS (PARTITION BY c_nationkey, c_custkey // 1000)""")
def src_json_parent_broadcast(t):
    # One page per team and thousand of player numbers, so that no page grows with the table.
    pages = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        "c_nationkey", F.floor(F.col("c_custkey") / 1000).alias("part")).agg(
        F.min("n_name").alias("name"),
        F.count_if(F.col("c_acctbal") > 0).alias("match_wins"), F.count_if(F.col("c_acctbal") <= 0).alias("match_losses"),
        F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("tag"))).alias("players"))
    team = F.struct(F.col("c_nationkey").alias("id"), "name", "players")
    documents = pages.select(F.to_json(F.struct(
        team.alias("team"), F.struct("match_wins", "match_losses").alias("standings"))).alias("text"))
    return json.children_with_parent(
        documents, "text",
        "struct<team:struct<id:int,name:string,players:array<struct<id:bigint,tag:string>>>,"
        "standings:struct<match_wins:bigint,match_losses:bigint>>",
        "team.players",
        {"team_id": F.col("doc.team.id"), "name": F.col("doc.team.name"),
         "match_wins": F.col("doc.standings.match_wins"), "match_losses": F.col("doc.standings.match_losses")})


@query("src_json_flatten", """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INT) AS props_k FROM events""")
def src_json_flatten(t):
    return json.parse_and_flatten(t.events.select("event_id", "user_id", "props"), "props", "struct<k:int>")


_LINK_SQL = "'" + html.LINK.replace("'", "''") + "'"


@query("src_html_extract", """
SELECT page_id, CAST(position AS INT) AS position, href, regexp_replace(label, '<[^>]*>', '', 'g') AS label FROM (
  SELECT page_id, generate_subscripts(a, 1) AS position, concat(unnest(a), unnest(b), unnest(c)) AS href, unnest(l) AS label
  FROM (SELECT page_id, """ + ", ".join(f"regexp_extract_all(html, {_LINK_SQL}, {i}) AS {n}" for i, n in enumerate("abcl", 1)) + """
        FROM pages) p) q""")
def src_html_extract(t):
    return html.links(t.pages, "page_id", "html")


@query("src_html_table", """
SELECT CAST(c_custkey // 50 AS BIGINT) AS page_no, CAST(c_custkey AS BIGINT) AS player_id, c_name AS tag,
       c_mktsegment AS role FROM customer""")
def src_html_table(t):
    cell = "concat('<tr><td>', r.c_custkey, '</td><td>', r.c_name, '</td><td>', r.c_mktsegment, '</td></tr>')"
    pages = _customer_documents(t, "c_custkey", "c_name", "c_mktsegment").select(
        F.col("document").alias("page_no"),
        F.concat(F.lit("<html><body><table><tr><th>Player</th><th>Tag</th><th>Role</th></tr>"),
                 F.expr(f"array_join(transform(rows, r -> {cell}), '')"),
                 F.lit("</table></body></html>")).alias("html"))
    rows = html.table_rows(pages, "page_no", "html").where("table_no = 0 AND row_no > 0")
    return rows.select("page_no", F.col("cells")[0].cast("bigint").alias("player_id"),
                       F.col("cells")[1].alias("tag"), F.col("cells")[2].alias("role"))


@query("src_backfill_union", """
SELECT o_orderkey, o_custkey, CAST(2001 AS INT) AS year, CAST(NULL AS VARCHAR) AS note FROM orders
WHERE year(o_orderdate) = 2001
UNION ALL
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INT), 'static' FROM orders WHERE year(o_orderdate) < 2001""")
def src_backfill_union(t):
    season = F.year("o_orderdate")
    path = workspace(t.spark, "backfill")
    t.orders.where(season < 2001).select(
        "o_orderkey", "o_custkey", season.alias("year"), F.lit("static").alias("note")).write.option(
        "header", True).csv(path)
    earlier = csv.read_with_header(
        t.spark, path, "o_orderkey bigint, o_custkey bigint, year int, note string")
    current = t.orders.where(season == 2001).select("o_orderkey", "o_custkey", F.lit(2001).alias("year"))
    return union_filling(current, earlier)


@query("sink_replace", "SELECT o_orderkey, o_totalprice FROM orders")
def sink_replace(t):
    path = workspace(t.spark, "replace")
    sinks.replace_table(t.customer.select("c_custkey"), path)
    sinks.replace_table(t.orders.select("o_orderkey", "o_totalprice"), path)
    return tables.scan(t.spark, path)


@query("sink_append", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def sink_append(t):
    path = workspace(t.spark, "append")
    sinks.append_table(t.customer.select("c_custkey", "c_name"), path)
    sinks.append_table(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), path)
    return tables.scan(t.spark, path)


@query("sink_snapshot_replace", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0")
def sink_snapshot_replace(t):
    """A table of snapshots, replaced by some of its own rows."""
    path, rows = workspace(t.spark, "snapshots"), t.orders.select("o_orderkey", "o_totalprice")
    sinks.store_snapshot(rows, path, "replace")
    sinks.store_snapshot(sinks.read_snapshot(t.spark, path, rows.schema).where("o_orderkey % 2 = 0"), path, "replace")
    return sinks.read_snapshot(t.spark, path, rows.schema)


@query("sink_snapshot_append", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def sink_snapshot_append(t):
    """Two batches, of which the second comes twice, as after a failure."""
    path, customers = workspace(t.spark, "snapshots"), t.customer.select("c_custkey", "c_name")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    stored = [sinks.store_snapshot(rows, path, "append", ("load", n)) for n, rows in ((0, customers), (1, suppliers), (1, suppliers))]
    if stored != [True, True, False]:
        raise AssertionError("a batch must be stored once")
    return sinks.read_snapshot(t.spark, path, customers.schema)


@query("sink_skip_empty", "SELECT o_orderkey, o_orderstatus FROM orders")
def sink_skip_empty(t):
    path = workspace(t.spark, "skip")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    wrote_none = sinks.append_table(rows.where(F.col("o_orderstatus") == "none"), path)
    wrote_all = sinks.append_table(rows, path)
    if wrote_none or not wrote_all:
        raise AssertionError("an empty frame must not be written")
    return tables.scan(t.spark, path)


