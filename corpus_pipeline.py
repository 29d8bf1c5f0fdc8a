"""A training corpus from raw documents: five stages, each written and read again before the next.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame. All but the last
return the columns of the documents. What is decided about a row holds for that row: rows
with one doc_id, or without any, are told apart by their place in the stored files that ``docs``
is read from.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreline.llm import exact, mixing, packing, simhash, toxicity
from scoreline.llm.common import documents, named_rows, settle, unused, workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic."""
    row = unused(docs, "_row")
    rows, model = named_rows(docs, row), toxicity.train(docs, documents(spark, sf_dir, "labels"))
    rejected = settle(toxicity.score(rows, model, key=row).where("predicted = 1").select(row), "rejected")
    return rows.join(rejected, row, "left_anti").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id; of rows with one doc_id and text, one."""
    index = exact.DigestIndex(spark, workspace(spark, "digest-index"))
    own, key, digest = (unused(docs, name) for name in ("_own", "_key", "_digest"))
    kept = exact.deduplicate(docs, index).where("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(digest))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(digest))
    return docs.withColumn(own, exact.text_digest(F.col("text"))).join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id (NULL last), of several the first in the files."""
    row, key = unused(docs, "_row"), unused(docs, "_key")
    rows = named_rows(docs, row)
    keyed = rows.select(F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(row).alias("row")).alias(key), "text")
    found = simhash.near_duplicates(keyed, key=key)
    kept = settle(found.where(F.col(key) == F.col("component_id")).select(F.col(key)["row"].alias(row)), "kept")
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn by calibrated probabilities; doc_id and cell decide."""
    cell = {"source": F.coalesce(F.col("source").cast("string"), F.lit("")), "lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
            "topic": mixing.topic_of(F.coalesce(F.col("text"), F.lit("")))}
    drawn = mixing.op2_mixing(docs).where("selected").select("doc_id", *cell).distinct()
    others = {name: unused(docs, f"_{name}") for name in drawn.columns}
    same = F.col("doc_id").eqNullSafe(F.col(others["doc_id"]))
    for name, own in cell.items():
        same &= own == F.col(others[name])
    return docs.join(drawn.toDF(*others.values()), same, "left_semi")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents by training sequence."""
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", draw_mixture),
    ("packing", pack_sequences),
]

#: Neither a learned score nor XXH64 fingerprints nor tokens can be had in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
