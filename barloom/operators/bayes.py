"""Naive Bayes and linear discriminant classifiers, one model per symbol, from grouped sums."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.regressors import P, PAIRS, unpack_gram
from barloom.schema import CODE, DATE


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _features():
    return [F.col("features")[i] for i in range(P)]


def fit_gaussian(samples: DataFrame, smoothing: float = 1e-9) -> DataFrame:
    """Per symbol and label: log prior, means and variances.

    Variances are raised by ``smoothing`` times the largest overall variance of a feature.
    """
    x = _features()
    stats = samples.groupBy(CODE, "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(v) for v in x]).alias("mean"),
        F.array(*[F.var_pop(v) for v in x]).alias("var"),
    )
    per_code = Window.partitionBy(CODE)
    total = F.sum("n").over(per_code)
    overall = []
    for i in range(P):
        m, v, n = F.col("mean")[i], F.col("var")[i], F.col("n")
        mean = F.sum(n * m).over(per_code) / total
        overall.append(F.sum(n * (v + m * m)).over(per_code) / total - mean * mean)
    return stats.select(
        CODE,
        "label",
        F.log(F.col("n") / total).alias("log_prior"),
        "mean",
        "var",
        (F.greatest(*overall) * smoothing).alias("_eps"),
    ).select(CODE, "label", "log_prior", "mean", F.transform("var", lambda v: v + F.col("_eps")).alias("var"))


def _gaussian_score() -> Column:
    fit_term = F.zip_with("features", "mean", lambda x, m: (x - m) * (x - m))
    spread = F.zip_with(fit_term, F.col("var"), lambda d, v: F.log(2.0 * math.pi * v) + d / v)
    return F.col("log_prior") - 0.5 * F.aggregate(spread, F.lit(0.0), lambda s, t: s + t)


def fit_multinomial(samples: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """Per symbol and label: log prior and log feature shares."""
    sums = samples.groupBy(CODE, "label").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in _features()]).alias("total")
    )
    weight = F.aggregate("total", F.lit(0.0), lambda s, t: s + t) + smoothing * P
    return sums.withColumn("_w", weight).select(
        CODE,
        "label",
        F.log(F.col("n") / F.sum("n").over(Window.partitionBy(CODE))).alias("log_prior"),
        F.transform("total", lambda t: F.log((t + smoothing) / F.col("_w"))).alias("log_share"),
    )


def _multinomial_score() -> Column:
    return F.col("log_prior") + _dot(F.col("features"), F.col("log_share"))


def fit_bernoulli(samples: DataFrame, smoothing: float = 1.0, threshold: float = 0.0) -> DataFrame:
    """Per symbol and label: log odds of each feature lying above the threshold."""
    sums = samples.groupBy(CODE, "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum((v > threshold).cast("double")) for v in _features()]).alias("total"),
    )
    share = F.transform("total", lambda t: (t + smoothing) / (F.col("n") + 2.0 * smoothing))
    return sums.select(
        CODE,
        "label",
        F.log(F.col("n") / F.sum("n").over(Window.partitionBy(CODE))).alias("log_prior"),
        share.alias("share"),
        F.lit(float(threshold)).alias("threshold"),
    )


def _bernoulli_score() -> Column:
    terms = F.zip_with(
        "features", "share", lambda x, p: F.when(x > F.col("threshold"), F.log(p)).otherwise(F.log(1.0 - p))
    )
    return F.col("log_prior") + F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def classify_by_score(score: Callable[[], Column]):
    """Classifier for models with one row per symbol and label: best score, ties to the lower label."""

    def run(model: DataFrame, windows: DataFrame) -> DataFrame:
        scored = windows.join(model, CODE).withColumn("_s", score())
        return scored.groupBy(CODE).agg(
            F.max(DATE).alias(DATE), F.max_by("label", F.struct("_s", -F.col("label"))).alias("prediction")
        )

    return run


classify_gaussian = classify_by_score(_gaussian_score)
classify_multinomial = classify_by_score(_multinomial_score)
classify_bernoulli = classify_by_score(_bernoulli_score)


def _discriminant(tolerance: float):
    """Weights w and offset c with label 1 when x.w + c > 0, for a stack of symbols."""

    def solve(n: pd.Series, scatter: pd.Series, mean0: pd.Series, mean1: pd.Series, odds: pd.Series) -> pd.Series:
        s = unpack_gram(scatter)
        count = n.to_numpy(float)[:, None]
        m0, m1 = np.stack(mean0.to_numpy()).astype(float), np.stack(mean1.to_numpy()).astype(float)
        std = np.sqrt(np.maximum(np.einsum("bii->bi", s), 0.0) / count)
        std = np.where(std == 0, 1.0, std)
        scaled = s / std[:, :, None] / std[:, None, :] / np.maximum(count - 2.0, 1.0)[:, :, None]
        lam, vec = np.linalg.eigh(scaled)
        keep = lam > tolerance**2
        inverse = np.where(keep, 1.0 / np.where(keep, lam, 1.0), 0.0)
        gap = np.einsum("bji,bj->bi", vec, (m1 - m0) / std) * inverse
        w = np.einsum("bij,bj->bi", vec, gap) / std
        c = odds.to_numpy(float) - 0.5 * np.einsum("bi,bi->b", m0 + m1, w)
        return pd.Series(list(np.hstack([w, c[:, None]])))

    return F.pandas_udf(solve, T.ArrayType(T.DoubleType()))


def fit_discriminant(samples: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Linear discriminant with pooled covariance: ``(code, weights, offset)``.

    Directions in which the standardised within-class data does not vary are left out. A
    symbol whose samples all have one label has no discriminant and gets no model row.
    """
    x = _features()
    per_class = samples.groupBy(CODE, "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(v) for v in x]).alias("mean"),
        F.expr(f"array({', '.join(f'covar_pop(features[{i}], features[{j}])' for i, j in PAIRS)})").alias("cov"),
    )
    scatter = F.expr(f"array({', '.join(f'sum(n * cov[{k}])' for k in range(len(PAIRS)))})")
    joined = per_class.groupBy(CODE).agg(
        F.sum("n").alias("n"),
        scatter.alias("scatter"),
        *[F.max(F.when(F.col("label") == c, F.col("mean"))).alias(f"mean{c}") for c in (0, 1)],
        *[F.max(F.when(F.col("label") == c, F.col("n"))).alias(f"n{c}") for c in (0, 1)],
    ).where(F.col("n0").isNotNull() & F.col("n1").isNotNull())
    solved = joined.withColumn(
        "_w", _discriminant(tolerance)("n", "scatter", "mean0", "mean1", F.log(F.col("n1") / F.col("n0")))
    )
    return solved.select(CODE, F.slice("_w", 1, P).alias("weights"), F.element_at("_w", P + 1).alias("offset"))


def classify_discriminant(model: DataFrame, windows: DataFrame) -> DataFrame:
    above = _dot(F.col("features"), F.col("weights")) + F.col("offset") > 0
    return windows.join(model, CODE).select(CODE, DATE, above.cast("int").alias("prediction"))
