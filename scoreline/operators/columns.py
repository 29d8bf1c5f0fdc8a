"""Choosing, naming and typing columns. All of it is schema work, no data pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_name


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; names that do not occur are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_lenient(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names that do not occur are ignored."""
    return df.drop(*names)


def rename_positions(df: DataFrame, first: Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
    """Give the first and the last columns new names, keep the ones between."""
    names = list(df.columns)
    names[: len(first)] = first
    if last:
        names[-len(last):] = last
    return df.toDF(*names)


def normalise_names(df: DataFrame, rule: Callable[[str], str] = clean_name) -> DataFrame:
    """Apply a naming rule to every column name."""
    return df.toDF(*[rule(n) for n in df.columns])


def join_header_levels(upper: Sequence[str], lower: Sequence[str],
                       rule: Callable[[str], str] = clean_name) -> list[str]:
    """Names of a two-level header: both levels joined by ``_``, then cleaned."""
    return [rule(f"{u}_{low}") for u, low in zip(upper, lower, strict=True)]


def keep_first_of_equal_names(df: DataFrame) -> DataFrame:
    """Of columns with the same name keep the first."""
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    first_position: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first_position.setdefault(name, i)
    return numbered.select(*[F.col(f"c{i}").alias(n) for n, i in first_position.items()])


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The stored training columns in their stored order, after the columns to keep."""
    return df.select(*keep, *features)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns of a number type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return select_columns(df, numeric_columns(df))


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Literal columns such as the season or the run date."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})


def other_side(name: str) -> str:
    """The name of the same column for the other team."""
    for one, two in (("team1", "team2"), ("team_1", "team_2")):
        if one in name:
            return name.replace(one, two)
        if two in name:
            return name.replace(two, one)
    return name


def swap_sides(df: DataFrame) -> DataFrame:
    """Exchange the columns of the two teams, keeping the column order."""
    return df.select(*[F.col(other_side(n)).alias(n) for n in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Strict casts by dictionary: unreadable text is an error."""
    return df.withColumns({n: F.col(n).cast(t) for n, t in types.items()})


def on_text_columns(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Apply an expression to every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: change(F.col(n)) for n in texts})
