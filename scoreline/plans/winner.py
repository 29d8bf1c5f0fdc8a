"""Train a winner model on match features and report on held-out matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seeded import hash_bucket
from ..models import boosting, search, split, train
from ..models.evaluate import accuracy, class_report


def train_and_hold(table: DataFrame, features: Sequence[str], estimator: Estimator, label: str, row_key: Sequence[str],
                   test_percent: int = 15, seed: int = 42) -> tuple[Model, DataFrame]:
    """Fit on the training matches with balanced classes: the model and all rows with predictions.

    The split (``is_test``, if the table has it) goes by the match, so mirrored and noisy copies of a match stay on
    its side of it. ``estimator`` must not have a weight column yet.
    """
    if "is_test" not in table.columns:
        table = split.mark_test(table, test_percent, seed, row_key)
    marked = split.add_class_weights(table, label)
    keep = [c for c in marked.columns if c not in features]
    rows = train.training_table(marked, features, row_key, keep)
    model = train.counted(estimator, "weight").fit(train.merged(rows.where(F.col("is_test") == 0), [label], "weight"))
    return model, model.transform(rows)


def search_and_hold(table: DataFrame, features: Sequence[str], label: str, row_key: Sequence[str], grid: Mapping[str, Sequence] = search.BOOSTED_SETTINGS,
                    draws: int = 50, folds: int = 5, patience: int = 50, seed: int = 42) -> tuple[boosting.Model, DataFrame, DataFrame]:
    """Search settings on the training matches with balanced classes and refit the best: model, all rows scored, search table.

    ``table`` has ``is_test``; the folds go by the match like the split, so that no copy of a match
    is in two of them. Test matches tell when to stop. At most about ``search.FIT_ROWS`` rows are fitted on.
    """
    spark = table.sparkSession
    marked = split.add_class_weights(table, label)
    marked = marked.withColumn("fold", hash_bucket(seed + 1, *[F.col(k) for k in row_key]) % folds)
    rows = train.training_table(marked, features, row_key, [c for c in marked.columns if c not in features])
    bins = boosting.fit_bins(rows.where("is_test = 0"))
    own = search.sample(rows, bins, label=label, weight="weight", watched="is_test", row_key=row_key[0])
    settings = search.drawn_settings(grid, draws, seed)
    tried = search.random_search(spark, own, settings, patience)
    model = search.fit_boosted(spark, own, settings[tried.first()["number"]], patience)
    return model, model.predict(rows), tried


def accuracy_by_part(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """The accuracy on the training and on the held-out matches."""
    parts = [accuracy(scored.where(F.col("is_test") == flag), label, prediction).withColumn("part", F.lit(name))
             for flag, name in ((0, "training"), (1, "held out"))]
    return parts[0].unionByName(parts[1])


def held_out_report(scored: DataFrame, label: str, prediction: str = "prediction", copies: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and f1 per class on the held-out matches, without rows that a flag in ``copies`` marks as made."""
    held = scored.where(F.col("is_test") == 1)
    for flag in copies:
        held = held.where(F.col(flag) == 0)
    return class_report(held.withColumn(
        prediction, F.col(prediction).cast(scored.schema[label].dataType)), label, prediction)
