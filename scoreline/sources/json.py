"""JSON documents landed as one text per row.

Every document is parsed by the task that holds it, with a declared schema. A document
that is no JSON is an error; with ``mode="PERMISSIVE"`` it gives no rows, and
``malformed`` returns such documents.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parsed(text: str, schema: str, mode: str) -> Column:
    return F.from_json(F.col(text), schema, {"mode": mode})


def malformed(documents: DataFrame, text: str) -> DataFrame:
    """The documents that are no JSON."""
    return documents.where(F.col(text).isNotNull() & F.try_parse_json(text).isNull())


def map_rows(documents: DataFrame, text: str, entry: str, key: str = "row_key", mode: str = "FAILFAST") -> DataFrame:
    """``{"1": {...}, "2": {...}}``: one row per entry; ``entry`` is the struct type."""
    parsed = _parsed(text, f"map<string,{entry}>", mode)
    return documents.select(F.explode(parsed).alias(key, "_entry")).select(key, "_entry.*")


def exploded_table(documents: DataFrame, text: str, path: str, entry: str, as_text: bool = False,
                   mode: str = "FAILFAST") -> DataFrame:
    """The array of objects at a dotted path as rows; ``as_text`` makes every column a string."""
    outer = f"array<{entry}>"
    for name in reversed(path.split(".")):
        outer = f"struct<`{name}`:{outer}>"
    parsed = documents.select(_parsed(text, outer, mode).alias("_doc"))
    rows = parsed.select(F.inline(F.col(f"_doc.{path}")))
    return rows.select(*[F.col(c).cast("string") for c in rows.columns]) if as_text else rows


def page_tables(documents: DataFrame, text: str, root: str, entries: Mapping[str, str],
                skipped: Sequence[str] = ()) -> dict[str, DataFrame]:
    """One table per array below ``root``, except the skipped ones, all columns as text."""
    return {key: exploded_table(documents, text, f"{root}.{key}", entry, as_text=True)
            for key, entry in entries.items() if key not in skipped}


def found_tables(documents: DataFrame, text: str, root: str, skipped: Sequence[str] = ()) -> DataFrame:
    """Every array of objects below ``root``, whatever its name, as cells: table_name, document, entry, column_name, value.

    The documents are parsed once. ``document`` numbers them, ``entry`` is the place in the
    array from 0, and values are texts.
    """
    spark, parsed = documents.sparkSession, documents.select(
        F.monotonically_increasing_id().alias("document"), F.parse_json(text).alias("_doc"))
    arrays = parsed.lateralJoin(spark.tvf.variant_explode(F.variant_get(F.col("_doc").outer(), f"$.{root}", "variant")).select(
        F.col("key").alias("table_name"), F.col("value").alias("_array"))).where(
        F.schema_of_variant("_array").startswith("ARRAY<OBJECT") & ~F.col("table_name").isin(list(skipped)))
    entries = arrays.select("table_name", "document", "_array").lateralJoin(spark.tvf.variant_explode(F.col("_array").outer()).select(
        F.col("pos").alias("entry"), F.col("value").alias("_entry")))
    cells = entries.select("table_name", "document", "entry", "_entry").lateralJoin(spark.tvf.variant_explode(F.col("_entry").outer()).select(
        F.col("key").alias("column_name"), F.col("value").alias("_value")))
    return cells.select("table_name", "document", "entry", "column_name", F.variant_get("_value", "$", "string").alias("value"))


def children_with_parent(documents: DataFrame, text: str, schema: str, children: str,
                         parent: Mapping[str, Column], mode: str = "FAILFAST") -> DataFrame:
    """One row per child object, with values of the enclosing document.

    ``parent`` gives result names and expressions over the parsed document ``doc``.
    """
    parsed = documents.select(_parsed(text, schema, mode).alias("doc"))
    return parsed.select(*[value.alias(name) for name, value in parent.items()], F.inline(F.col(f"doc.{children}")))


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested struct columns as flat columns named by their path."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Column]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                found.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return found

    return df.select(*leaves(df.schema))


def parse_and_flatten(df: DataFrame, text: str, schema: str, separator: str = "_", mode: str = "FAILFAST") -> DataFrame:
    """Parse a JSON text column and flatten it in its place."""
    return flatten(df.withColumn(text, _parsed(text, schema, mode)), separator)
