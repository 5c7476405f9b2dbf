"""Ridge and Lasso for every symbol in one job.

The samples of a symbol reduce to sums of products in an ordinary grouped aggregation with
map-side combine; only the 14x14 systems reach Python, batched by Arrow and solved as a
stack. The model is a table of coefficients keyed by symbol.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import CODE, FEATURE_LENGTH

P = FEATURE_LENGTH
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def gram_sums(samples: DataFrame) -> DataFrame:
    """Per symbol: sample count, means, and centred sums of products.

    Features and label are shifted by the symbol's mean label first, so the products stay
    small and centring loses no digits.
    """
    columns = ["y", *[f"f{i}" for i in range(P)]]
    shifted = samples.withColumn("_m", F.avg("label").over(Window.partitionBy(CODE))).selectExpr(
        CODE, "_m", "label - _m AS y", *[f"features[{i}] - _m AS f{i}" for i in range(P)]
    )
    products = [f"sum(f{i} * f{j})" for i, j in PAIRS] + [f"sum(f{i} * y)" for i in range(P)]
    sums = shifted.groupBy(CODE).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("_m").alias("shift"),
        F.expr(f"array({', '.join(f'sum({c})' for c in columns)})").alias("s"),
        F.expr(f"array({', '.join(products)})").alias("ss"),
    )
    # In the array of sums the label comes first.
    gram = [f"ss[{k}] - s[{i + 1}] * s[{j + 1}] / n" for k, (i, j) in enumerate(PAIRS)]
    moment = [f"ss[{len(PAIRS) + i}] - s[{i + 1}] * s[0] / n" for i in range(P)]
    return sums.selectExpr(
        CODE,
        "n",
        "shift",
        f"transform(slice(s, 2, {P}), v -> v / n) AS mean_x",
        "s[0] / n AS mean_y",
        f"array({', '.join(gram)}) AS gram",
        f"array({', '.join(moment)}) AS moment",
    )


def unpack_gram(gram: pd.Series) -> np.ndarray:
    flat = np.stack(gram.to_numpy()).astype(float)
    full = np.empty((len(flat), P, P))
    for k, (i, j) in enumerate(PAIRS):
        full[:, i, j] = full[:, j, i] = flat[:, k]
    return full


def _ridge_weights(alpha: float):
    def solve(gram: pd.Series, moment: pd.Series, n: pd.Series) -> pd.Series:
        a = unpack_gram(gram) + alpha * np.eye(P)
        b = np.stack(moment.to_numpy()).astype(float)
        return pd.Series(list(np.linalg.solve(a, b[:, :, None])[:, :, 0]))

    return F.pandas_udf(solve, T.ArrayType(T.DoubleType()))


def _lasso_weights(alpha: float, rounds: int = 100_000, tolerance: float = 1e-11):
    """Coordinate descent. Each symbol stops by itself, when no weight moved by more than the
    tolerance times its largest weight; one that has not after all rounds is an error."""

    def solve(gram: pd.Series, moment: pd.Series, n: pd.Series) -> pd.Series:
        a, b = unpack_gram(gram), np.stack(moment.to_numpy()).astype(float)
        penalty = alpha * n.to_numpy(float)
        w, left = np.zeros_like(b), np.arange(len(b))
        for _ in range(rounds):
            if not len(left):
                break
            g, m, v, p = a[left], b[left], w[left], penalty[left]
            before = v.copy()
            for j in range(P):
                d = g[:, j, j]
                rho = m[:, j] - np.einsum("bk,bk->b", g[:, j], v) + d * v[:, j]
                shrunk = np.sign(rho) * np.maximum(np.abs(rho) - p, 0.0)
                v[:, j] = np.divide(shrunk, d, out=np.zeros_like(d), where=d > 0)
            w[left] = v
            moved = np.abs(v - before).max(1) > tolerance * np.maximum(np.abs(v).max(1), 1e-300)
            left = left[moved]
        if len(left):
            raise ArithmeticError(f"Lasso did not converge for {len(left)} symbols in {rounds} rounds")
        return pd.Series(list(w))

    return F.pandas_udf(solve, T.ArrayType(T.DoubleType()))


def fit(samples: DataFrame, regression_type: str = "Ridge", alpha: float = 1.0) -> DataFrame:
    """Model table ``(code, n, weights, intercept)``; free intercept, squared loss.

    Ridge penalises alpha * |w|^2 against the sum of squares, Lasso alpha * |w| against half
    their mean, as those models are commonly defined.
    """
    weights = (_ridge_weights if regression_type == "Ridge" else _lasso_weights)(float(alpha))
    solved = gram_sums(samples).withColumn("weights", weights("gram", "moment", "n"))
    dot = F.aggregate(F.zip_with("weights", "mean_x", lambda w, m: w * (m + F.col("shift"))), F.lit(0.0), lambda s, x: s + x)
    return solved.select(CODE, "n", "weights", (F.col("mean_y") + F.col("shift") - dot).alias("intercept"))


def predict(model: DataFrame, windows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """``(code, date, prediction)``; with ``base`` (code, base) scaled back to a price."""
    dot = F.aggregate(F.zip_with("weights", "features", lambda w, x: w * x), F.lit(0.0), lambda s, x: s + x)
    out = windows.join(model, CODE).withColumn("prediction", F.col("intercept") + dot)
    if base is not None:
        out = out.join(base, CODE).withColumn("prediction", F.col("prediction") * F.col("base"))
    return out.select(CODE, "date", "prediction")
