"""Text expressions. Every function takes a Column and returns a Column."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix(text: Column, length: int = 4) -> Column:
    """The first ``length`` characters, e.g. the season at the head of an id."""
    return F.substring(text, 1, length)


def first_match(text: Column, pattern: str = r"\d{4}") -> Column:
    """The first match of ``pattern``, NULL when there is none."""
    found = F.regexp_extract(text, pattern, 0)
    return F.when(found != "", found)


def between(text: Column, start: str, end: str) -> Column:
    """The text between the first ``start`` and the ``end`` that follows it."""
    tail = F.when(F.contains(text, F.lit(start)),
                  F.substring(text, F.instr(text, start) + F.lit(len(start)), F.length(text)))
    return F.substring_index(tail, end, 1)


def replace_text(text: Column, replacements: Mapping[str, str]) -> Column:
    """Literal replacements, applied in the order given."""
    for old, new in replacements.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def concat_key(*parts: Column, separator: str = "-") -> Column:
    """One text key of several columns; NULL when any part is NULL."""
    key = F.concat_ws(separator, *[p.cast("string") for p in parts])
    missing = F.lit(False)
    for part in parts:
        missing = missing | part.isNull()
    return F.when(~missing, key)


def map_values(column: Column, mapping: Mapping) -> Column:
    """Look a value up in a small fixed mapping; NULL when absent."""
    result = F.lit(None)
    for key, value in mapping.items():
        result = F.when(column == F.lit(key), F.lit(value)).otherwise(result)
    return result


# Fixed value: the naming rule of the season tables.
def clean_name(name: str) -> str:
    """A column name without ``/`` and blanks, and with ``_`` for ``&``."""
    return name.replace("/", "").replace(" ", "").replace("&", "_")


def snake_name(name: str) -> str:
    """A column name that never needs back-ticks: ``S&D Win %`` gives ``s_d_win_pct``."""
    spelled = name.replace("+/-", " diff ").replace("%", " pct ")
    return re.sub(r"[^0-9a-z]+", "_", spelled.lower()).strip("_")
