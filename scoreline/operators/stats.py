"""Statistics over whole columns and over groups.

A fit reads its table once and returns the few numbers of one result row; to
apply them is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import exp, isqrt, lgamma, log, log1p, pi

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import settle


@dataclass(frozen=True)
class Scaling:
    """``(x - shift) / scale`` per column."""

    shift: Mapping[str, float | None]
    scale: Mapping[str, float | None]

    def apply(self, df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
        """Scale the columns in place, or into the renamed columns."""
        names = rename or {c: c for c in self.shift}
        return df.withColumns({
            r: (F.col(c) - F.lit(self.shift[c])) / F.lit(self.scale[c]) for c, r in names.items()})

    def invert(self, df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
        """Bring scaled columns back to their units."""
        names = rename or {c: c for c in self.shift}
        return df.withColumns({
            r: F.col(c) * F.lit(self.scale[c]) + F.lit(self.shift[c]) for c, r in names.items()})


def _numbers(df: DataFrame, columns: Sequence[str], functions: Mapping[str, object]) -> dict:
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{name}_{c}")
                   for c in columns for name, f in functions.items()]).first()
    return {name: {c: row[f"{name}_{c}"] for c in columns} for name in functions}


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Scaling to [0, 1]; a constant column becomes 0."""
    found = _numbers(df, columns, {"lo": F.min, "hi": F.max})
    spans = {c: None if found["lo"][c] is None else (found["hi"][c] - found["lo"][c]) or 1.0 for c in columns}
    return Scaling(found["lo"], spans)


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Scaling to mean 0 and population deviation 1; a constant column becomes 0."""
    found = _numbers(df, columns, {"mean": F.avg, "sd": F.stddev_pop})
    return Scaling(found["mean"], {c: found["sd"][c] or 1.0 for c in columns})


#: Pairs of columns in one aggregate: more make generated code that the JVM does not compile.
_PAIRS_AT_ONCE = 40


def _correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """Rows (column_1, column_2, correlation) for every pair of a left and a right column.

    A pair uses the rows that have both values; NaN counts as missing, and a constant
    column has no correlation. Up to forty pairs take one pass of the JVM's own
    aggregate; for more the columns are written once and read in slices of pairs.
    """
    names = list(dict.fromkeys([*left, *right]))
    pairs = list(dict.fromkeys(tuple(sorted((a, b), key=names.index)) for a in left for b in right))

    def number(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)

    def correlation(a: str, b: str) -> Column:
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    rows = df.select(*[number(c).alias(f"_{i}") for i, c in enumerate(names)])
    if len(pairs) > _PAIRS_AT_ONCE:
        rows = settle(rows, "correlated")
    found = None
    for at in range(0, len(pairs), _PAIRS_AT_ONCE):
        some = pairs[at:at + _PAIRS_AT_ONCE]
        one_row = rows.agg(*[correlation(f"_{names.index(a)}", f"_{names.index(b)}").alias(f"r{i}") for i, (a, b) in enumerate(some)])
        cells = [F.struct(F.lit(c).alias("column_1"), F.lit(d).alias("column_2"), F.col(f"r{i}").alias("correlation"))
                 for i, (a, b) in enumerate(some) for c, d in dict.fromkeys([(a, b), (b, a)]) if c in left and d in right]
        part = one_row.select(F.inline(F.array(*cells)))
        found = part if found is None else found.unionByName(part)
    return found


def correlation_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The correlation matrix as rows (column_1, column_2, correlation)."""
    return _correlations(df, columns, columns)


def target_correlation_rows(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The correlation of each feature with the target, the largest first."""
    rows = _correlations(df, features, [target]).select(F.col("column_1").alias("feature"), "correlation")
    return rows.orderBy(F.col("correlation").desc_nulls_last(), "feature")


def low_correlation_features(df: DataFrame, features: Sequence[str], target: str, limit: float = 0.15) -> list[str]:
    """Features whose absolute correlation with the target is below the limit."""
    found = {r["feature"]: r["correlation"] for r in target_correlation_rows(df, features, target).collect()}
    return [f for f in features if found.get(f) is not None and abs(found[f]) < limit]


def zero_variance_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with one value throughout."""
    row = df.agg(*[(F.min(f) == F.max(f)).alias(f) for f in features]).first()
    return [f for f in features if row[f]]


def _beta_fraction(a: float, b: float, x: float) -> float:
    # Converges within some sqrt(max(a, b)) steps.
    tiny, steps = 1e-300, 1000 + 20 * isqrt(int(max(a, b)))
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = d
    for m in range(1, steps):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 4e-16:
            return value
    raise ArithmeticError(f"the incomplete beta function of {a} and {b} at {x} does not converge")


def _log_gamma_rest(a: float) -> float:
    """ln(gamma(a)) without its large terms, (a - 1/2) ln(a) - a + ln(2 pi) / 2, for a of 10 and more."""
    return 1 / (12 * a) - 1 / (360 * a**3) + 1 / (1260 * a**5) - 1 / (1680 * a**7)


def _log_front(a: float, b: float, x: float, rest: float) -> float:
    """ln(x^a rest^b / B(a, b)), without differences of large logarithms; ``rest`` is 1 - x."""
    if min(a, b) >= 10:
        n = a + b
        # Every large term is the logarithm of a ratio near one.
        large = a * log1p((x * n - a) / a) + b * log1p((rest * n - b) / b)
        return large + 0.5 * log(a * b / (2 * pi * n)) + _log_gamma_rest(n) - _log_gamma_rest(a) - _log_gamma_rest(b)
    if max(a, b) >= 10:
        small, big = min(a, b), max(a, b)
        n = a + b
        # lgamma(n) - lgamma(big) by Stirling's series, where lgamma itself would lose all digits.
        ratio = (big - 0.5) * log1p(small / big) + small * log(n) - small + _log_gamma_rest(n) - _log_gamma_rest(big)
        p, q = (x, rest) if a <= b else (rest, x)
        return ratio - lgamma(small) + small * log(p) + big * (log1p(-p) if p < 0.5 else log(q))
    return lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(rest)


def f_distribution_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f) by the continued fraction of the incomplete beta function."""
    if f <= 0.0:
        return 1.0
    x, rest = df2 / (df2 + df1 * f), df1 * f / (df2 + df1 * f)
    a, b = df2 / 2.0, df1 / 2.0
    if x == 0.0 or rest == 0.0:
        return 0.0 if x == 0.0 else 1.0
    front = exp(_log_front(a, b, x, rest))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, rest) / b


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: F statistic, its degrees of freedom and the p-value.

    Groups are reduced to count, mean and variance before they are combined.
    """
    groups = df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"))
    # Written, as the total mean is taken first: differences from it keep the digits that squares of large means lose.
    groups = settle(groups, "groups")
    total = groups.agg(F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))).first()[0]
    gap = F.col("mean") - F.lit(total)
    sums = groups.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("n") * gap * gap).alias("between"),
                      F.sum(F.col("n") * F.col("var")).alias("within"))
    tested = sums.select(
        F.try_divide(F.try_divide(F.col("between"), F.col("groups") - 1),
                     F.try_divide(F.col("within"), F.col("n") - F.col("groups"))).alias("f_statistic"),
        (F.col("groups") - 1).alias("df_between"), (F.col("n") - F.col("groups")).alias("df_within"))

    def tail(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["p_value"] = [
                None if pd.isna(f) else f_distribution_tail(f, a, b)
                for f, a, b in zip(frame["f_statistic"], frame["df_between"], frame["df_within"], strict=True)]
            yield frame

    return tested.mapInPandas(tail, "f_statistic double, df_between bigint, df_within bigint, p_value double")


def ols_simple(df: DataFrame, target: str, predictor: str) -> DataFrame:
    """One row: slope, intercept and R2 of a one-predictor least-squares fit."""
    x = F.when(F.col(target).isNotNull(), F.col(predictor).cast("double"))
    y = F.when(F.col(predictor).isNotNull(), F.col(target).cast("double"))
    sums = df.agg(F.covar_pop(y, x).alias("cov"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"),
                  F.avg(x).alias("mx"), F.avg(y).alias("my"))
    slope = F.try_divide(F.col("cov"), F.col("vx"))
    return sums.select(
        slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"),
        F.try_divide(F.col("cov") * F.col("cov"), F.col("vx") * F.col("vy")).alias("r2"))


def weighted_score(df: DataFrame, role: str, weights: DataFrame, metrics: Sequence[str], result: str) -> DataFrame:
    """The sum of metric times the weight of the row's role.

    ``weights`` has one row per role and one column per metric.
    """
    table = weights.select(F.col(role).alias("_role"), *[F.col(m).alias(f"_w_{m}") for m in metrics])
    score = sum((F.col(m) * F.col(f"_w_{m}") for m in metrics[1:]), F.col(metrics[0]) * F.col(f"_w_{metrics[0]}"))
    joined = df.join(table, F.col(role) == F.col("_role"), "left").withColumn(result, score)
    return joined.drop("_role", *[f"_w_{m}" for m in metrics])
