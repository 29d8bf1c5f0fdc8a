"""Repeated markup of landed HTML pages as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_name
from ..session import ship_package
from ..storage import settle

# An anchor with its target in double, single or no quotes, its inner markup, and a tag in that.
LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a\s*>"""
TAG = r"<[^>]*>"


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Every link of a page: key, position from 1, target and text without inner tags."""
    parts = [F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(i)) for i in range(1, 5)]
    found = F.arrays_zip(*[p.alias(f"g{i}") for i, p in enumerate(parts)])
    rows = pages.select(key, F.posexplode(found).alias("position", "link")).select(key, "position", "link.*")
    places = [c for c in rows.columns if c not in (key, "position")]
    return rows.select(key, (F.col("position") + 1).alias("position"),
                       F.concat(*[F.col(f"`{p}`") for p in places[:3]]).alias("href"),
                       F.regexp_replace(F.col(f"`{places[3]}`"), F.lit(TAG), F.lit("")).alias("label"))


# The largest spans that HTML knows; larger ones are cut to them.
_MOST = {"colspan": 1000, "rowspan": 65534}


def _span(attributes: list[tuple[str, str | None]], name: str) -> int:
    value = (dict(attributes).get(name) or "1").strip()
    if not (value.isascii() and value.isdigit()):
        return 1
    return min(max(int(value), 1), _MOST[name]) if len(value.lstrip("0")) < 10 else _MOST[name]


class _Table:
    """One open table: finished rows, the row under construction, cells that reach down."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.rows: list[list[str]] = []
        self.row: list[tuple[str, int, int]] | None = None
        self.text: list[str] | None = None
        self.spans = (1, 1)
        self.hanging: dict[int, tuple[int, str]] = {}

    def end_cell(self) -> None:
        if self.text is not None:
            self.row.append(("".join(self.text).strip(), *self.spans))
            self.text = None

    def end_row(self) -> None:
        self.end_cell()
        if self.row:
            self.rows.append(self._laid_out())
        self.row = None

    def _laid_out(self) -> list[str]:
        cells: list[str] = []
        below: dict[int, tuple[int, str]] = {}

        def take_hanging() -> None:
            while len(cells) in self.hanging:
                left, text = self.hanging[len(cells)]
                if left > 1:
                    below[len(cells)] = (left - 1, text)
                cells.append(text)

        for text, across, down in self.row:
            take_hanging()
            for _ in range(across):
                if down > 1:
                    below[len(cells)] = (down - 1, text)
                cells.append(text)
        take_hanging()
        self.hanging = below
        return cells


class _TableReader(HTMLParser):
    """Collects the cells of a page's tables; inner tables count as tables of their own."""

    def __init__(self) -> None:
        super().__init__()
        self.tables: list[_Table] = []
        self._open: list[_Table] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._open.append(_Table(len(self.tables)))
            self.tables.append(self._open[-1])
        elif self._open and tag == "tr":
            self._open[-1].end_row()
            self._open[-1].row = []
        elif self._open and tag in ("td", "th"):
            table = self._open[-1]
            table.end_cell()
            table.row = table.row or []
            table.text, table.spans = [], (_span(attrs, "colspan"), _span(attrs, "rowspan"))

    def handle_data(self, data):
        if self._open and self._open[-1].text is not None:
            self._open[-1].text.append(data)

    def handle_endtag(self, tag):
        if not self._open:
            return
        if tag in ("td", "th"):
            self._open[-1].end_cell()
        elif tag == "tr":
            self._open[-1].end_row()
        elif tag == "table":
            self._open.pop().end_row()

    def close(self):
        super().close()
        while self._open:
            self._open.pop().end_row()


#: Rows of pages that a task gathers before it hands them on.
_ROWS_AT_ONCE = 5000


def _tables(text: str | None) -> list[_Table]:
    reader = _TableReader()
    reader.feed(text or "")
    reader.close()
    return reader.tables


def _in_parts(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    while part := list(islice(rows, _ROWS_AT_ONCE)):
        yield pd.DataFrame(part, columns=columns)


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Every row of every HTML table: key, table and row number from 0, cells.

    A cell that spans columns or rows is repeated in each of them.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((name, table.number, number, cells) for frame in frames for name, text in zip(frame[key], frame[html], strict=True)
                for table in _tables(text) for number, cells in enumerate(table.rows))
        return _in_parts(rows, [key, "table_no", "row_no", "cells"])

    ship_package(pages.sparkSession)
    key_type = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(
        read, f"`{key}` {key_type}, table_no int, row_no int, cells array<string>")


def _named(header: list[list[str]], rule: Callable[[str], str]) -> list[str | None]:
    """The name of each column: its header cells joined; a repeated name is numbered, a column without a name has none."""
    names: list[str | None] = []
    for levels in zip(*header, strict=False):
        plain = rule("_".join(levels)) if any(levels) else ""
        name, repeated = plain, 0
        while name and name in names:
            repeated += 1
            name = f"{plain}.{repeated}"
        names.append(name or None)
    return names


def table_records(pages: DataFrame, key: str, html: str, table_no: int, header_rows: int = 2,
                  rule: Callable[[str], str] = clean_name) -> DataFrame:
    """The rows of one table of every page: key, row number from 0, and the cells by the names in the page's own header.

    ``names`` has the names in the order of their columns; columns without a name are left out.
    """

    def records(table: _Table) -> Iterator[tuple[int, list[str], dict[str, str]]]:
        names = _named(table.rows[:header_rows], rule)
        for number, cells in enumerate(table.rows[header_rows:]):
            yield number, [n for n in names if n], {n: c for n, c in zip(names, cells, strict=False) if n}

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((name, *record) for frame in frames for name, text in zip(frame[key], frame[html], strict=True)
                for table in _tables(text) if table.number == table_no for record in records(table))
        return _in_parts(rows, [key, "row_no", "names", "cells"])

    ship_package(pages.sparkSession)
    key_type = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(read, f"`{key}` {key_type}, row_no int, names array<string>, cells map<string,string>")


def wide_table(pages: DataFrame, key: str, html: str, table_no: int, header_rows: int = 2,
               rule: Callable[[str], str] = clean_name, most_columns: int = 1000) -> DataFrame:
    """One table of every page as text columns, united by name; a page lacks what its header lacks (NULL).

    Columns come in the order of their first place in any page, then by name. The names
    are collected; more than ``most_columns`` are an error.
    """
    records = settle(table_records(pages, key, html, table_no, header_rows, rule), "records")
    found = records.select(F.posexplode("names").alias("place", "name")).groupBy("name").agg(F.min("place").alias("place"))
    names = [r["name"] for r in found.orderBy("place", "name").limit(most_columns + 1).collect()]
    if len(names) > most_columns:
        raise ValueError(f"the pages' headers have more than {most_columns} names")
    return records.select(key, *[F.col("cells").getItem(n).alias(n) for n in names])
