"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import scan
from ..storage import settle
from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_STATEMENTS: dict[str, str] = {}


class Tables:
    """The stored tables of one folder, and the match views derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.table("supplier")

    @cached_property
    def matches(self) -> DataFrame:
        return views.matches(self)

    @cached_property
    def settled_matches(self) -> DataFrame:
        return views.settled_matches(self)

    @cached_property
    def played(self) -> DataFrame:
        return settle(views.played_orders(self), "played")

    @cached_property
    def played_matches(self) -> DataFrame:
        return views.played_matches(self.played)

    @cached_property
    def played_seasons(self) -> DataFrame:
        return views.played_seasons(self, self.played)

    @cached_property
    def player_seasons(self) -> DataFrame:
        return views.player_seasons(self)

    @cached_property
    def team_seasons(self) -> DataFrame:
        return views.team_seasons(self.matches)

    @cached_property
    def roster(self) -> DataFrame:
        return views.roster(self)

    @cached_property
    def line_totals(self) -> DataFrame:
        return views.line_totals(self)


def query(name: str, sql: str | None = None):
    """Register a function from Tables to DataFrame; ``sql`` may use the ``fx_`` views."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            _STATEMENTS[name] = sql
        return build

    return register


def oracles() -> dict[str, str]:
    """The SQL statements with the views they use."""
    return {name: views.with_views(sql) for name, sql in _STATEMENTS.items()}
