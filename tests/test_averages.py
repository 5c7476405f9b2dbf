"""Average types against plain loops, with and without blocks."""

import math

import numpy as np
import pytest

from barloom.operators import stochastics as st
from barloom.operators.series import apply


def plain(x, n, kind):
    """The average of a list without gaps; None before its first row."""
    if n == 1:
        return list(x)
    out = [None] * len(x)

    def chained(v, start, k):
        e, state = [None] * len(v), None
        for i in range(start + n - 1, len(v)):
            state = sum(v[i - n + 1 : i + 1]) / n if state is None else state + (v[i] - state) * 2 / (n + 1)
            e[i] = state
        return e

    if kind == st.SIMPLE:
        for i in range(n - 1, len(x)):
            out[i] = sum(x[i - n + 1 : i + 1]) / n
    elif kind == st.WEIGHTED:
        for i in range(n - 1, len(x)):
            out[i] = sum(w * v for w, v in enumerate(x[i - n + 1 : i + 1], 1)) / (n * (n + 1) / 2)
    elif kind == st.TRIANGULAR:
        weights = [min(k, n + 1 - k) for k in range(1, n + 1)]
        for i in range(n - 1, len(x)):
            out[i] = sum(w * v for w, v in zip(weights, x[i - n + 1 : i + 1], strict=True)) / sum(weights)
    elif kind == st.ADAPTIVE:
        for i in range(n, len(x)):
            way = sum(abs(x[j] - x[j - 1]) for j in range(i - n + 1, i + 1))
            net = abs(x[i] - x[i - n])
            s = ((1.0 if way <= net else net / way) * (2 / 3 - 2 / 31) + 2 / 31) ** 2
            before = x[n - 1] if i == n else out[i - 1]
            out[i] = before + s * (x[i] - before)
    else:
        links = {st.EXPONENTIAL: 1, st.DOUBLE: 2, st.TRIPLE: 3, st.T3: 6}[kind]
        e, v = [], x
        for k in range(links):
            v = chained(v, k * (n - 1), k)
            e.append(v)
        a = 0.7
        mix = {1: [1.0], 2: [2.0, -1.0], 3: [3.0, -3.0, 1.0], 6: [0, 0, 1 + 3 * a + a**3 + 3 * a * a, -6 * a * a - 3 * (a + a**3), 3 * (a * a + a**3), -(a**3)]}
        for i in range(links * (n - 1), len(x)):
            out[i] = sum(w * l[i] for w, l in zip(mix[links], e, strict=True) if w)
    return out


def raw_k(g, n=5):
    low, high = g.low.rolling(n).min(), g.high.rolling(n).max()
    span = high - low
    return np.where(span == 0, 0.0, (g.adj_close - low) / span.where(span != 0, 1) * 100)[n - 1 :].tolist()


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        missing = a is None or math.isnan(a)
        assert missing == (b is None) and (missing or abs(a - b) < 1e-8)


@pytest.mark.parametrize("kind", st.TYPES)
@pytest.mark.parametrize("block", [None, 45])
def test_stochastics(spark, walks, walk_rows, kind, block):
    """One block, and blocks of 45 rows with values carried from each into the next."""
    if block:
        rows = apply(walks, [st.stoch(5, 4, kind, 3, kind), st.stochf(5, 7, kind)], block=block)
    else:
        rows = apply(walks, [st.stoch(5, 4, kind, 3, kind), st.stochf(5, 7, kind)])
    got = {c: g.sort_values("date") for c, g in rows.toPandas().groupby("code")}
    for code, g in walk_rows.items():
        k = raw_k(g) if len(g) >= 5 else []
        slow, fast = plain(k, 4, kind), plain(k, 7, kind)
        known = next((i for i, v in enumerate(slow) if v is not None), len(slow))
        slowd = [None] * known + plain(slow[known:], 3, kind)
        pad = [None] * (len(g) - len(k))
        same(got[code].slowk, pad + [a if b is not None else None for a, b in zip(slow, slowd, strict=True)])
        same(got[code].slowd, pad + slowd)
        same(got[code].fastk, pad + [a if b is not None else None for a, b in zip(k, fast, strict=True)])
        same(got[code].fastd, pad + fast)


def test_one_row_averages_copy_and_types_are_checked(spark, walks):
    both = apply(walks, [st.stoch(5, 1, st.T3, 1, st.ADAPTIVE), st.stochf(5, 1, st.DOUBLE)])
    assert both.where("not (slowk <=> fastk) or not (slowd <=> slowk) or not (fastd <=> fastk)").count() == 0
    assert both.where("slowk is not null").count() > 0
    for bad in (7, 9, -1):
        with pytest.raises(ValueError):
            st.stoch(5, 3, bad)
    with pytest.raises(ValueError):
        st.stochf(5, 0)


def test_long_series_in_many_blocks(spark):
    """Products of varying factors stay in range over thousands of rows."""
    import pandas as pd

    from barloom.schema import BARS
    from conftest import walk

    rows = [(str(r[0]), r[1], *map(float, r[2:])) for r in walk("L", 3000, 5)]
    bars = spark.createDataFrame(pd.DataFrame(rows, columns=BARS.fieldNames()), BARS)
    got = apply(bars, [st.stochf(5, 4, st.ADAPTIVE)]).toPandas().sort_values("date")
    k = raw_k(bars.toPandas().sort_values("date").reset_index(drop=True))
    same(got.fastd, [None] * 4 + plain(k, 4, st.ADAPTIVE))
