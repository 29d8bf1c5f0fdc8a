"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact, language, mixing, packing, phrases, secrets, sharding, simhash, suffix, toxicity, turns, vectors, windows
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, apply: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: apply(documents(spark, folder, table))


QUERIES: dict[str, Query] = {
    "op1_toxicity": lambda spark, folder: toxicity.op1_toxicity(documents(spark, folder), documents(spark, folder, "labels")),
    "op2_mixing": _over("documents", mixing.op2_mixing),
    "op3_simhash": _over("documents", simhash.op3_simhash),
    "op4_suffix": _over("documents", suffix.op4_suffix),
    "op5_exact_dedup": _over("documents", exact.op5_exact_dedup),
    "op6_shard_lookup": _over("documents", sharding.op6_shard_lookup),
    "op7_vectors": _over("embeddings", vectors.op7_vectors),
    "op8_windows": _over("documents", windows.op8_windows),
    "op10_secrets": _over("documents", secrets.op10_secrets),
    "op9_packing": _over("documents", packing.op9_packing),
    "op11_language": _over("documents", language.op11_language),
    "op12_turns": _over("conversations", turns.op12_turns),
    "op13_phrases": _over("documents", phrases.op13_phrases),
}

ORACLES: dict[str, str] = {"op5_exact_dedup": exact.OP5_SQL}
