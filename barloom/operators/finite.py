"""Indicators over a finite window of bars. ``adj_close`` is the close of every indicator."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.scan import RN
from barloom.operators.series import Frame, Indicator, Stage, number_rows, ratio_or_zero, since
from barloom.schema import CODE, DATE

C, H, L, V = "adj_close", "high", "low", "volume"


def typical():
    return (F.col(H) + F.col(L) + F.col(C)) / 3.0


def sma(n: int = 5) -> Indicator:
    """Mean of the last ``n`` closes, from running sums: a sliding frame would cost n updates a row."""
    name = f"sma{n}"

    def build(f: Frame):
        return [
            Stage({"_csum": F.sum(C).over(f.so_far)}),
            Stage({name: since(n, (F.col("_csum") - f.lag_or_zero("_csum", n)) / float(n))}),
        ]

    return Indicator([name], build)


def mfi(n: int = 14) -> Indicator:
    name = f"mfi{n}"

    def build(f: Frame):
        step = F.col("_tp") - F.col("_tp_prev")
        pos = F.sum(F.when(step > 0, F.col("_flow")).otherwise(0.0)).over(f.last(n))
        neg = F.sum(F.when(step < 0, F.col("_flow")).otherwise(0.0)).over(f.last(n))
        return [
            Stage({"_tp": typical()}),
            Stage({"_tp_prev": f.lag("_tp"), "_flow": F.col("_tp") * F.col(V)}),
            Stage({f"_pos{n}": pos, f"_neg{n}": neg}),
            Stage(
                {
                    name: since(
                        n + 1,
                        F.when(F.col(f"_pos{n}") + F.col(f"_neg{n}") < 1, 0.0).otherwise(
                            100.0 * F.col(f"_pos{n}") / (F.col(f"_pos{n}") + F.col(f"_neg{n}"))
                        ),
                    )
                }
            ),
        ]

    return Indicator([name], build)


def roc(n: int = 10) -> Indicator:
    name = f"roc{n}"

    def build(f: Frame):
        old = f.lag(C, n)
        return [Stage({name: since(n + 1, F.when(old == 0, 0.0).otherwise((F.col(C) / old - 1.0) * 100.0))})]

    return Indicator([name], build)


def mom(n: int = 10) -> Indicator:
    name = f"mom{n}"
    return Indicator([name], lambda f: [Stage({name: F.col(C) - f.lag(C, n)})])


def cci(n: int = 14) -> Indicator:
    name = f"cci{n}"

    def build(f: Frame):
        mean = F.avg("_tp").over(f.last(n))
        window = F.collect_list("_tp").over(f.last(n))
        m = F.col(f"_tpm{n}")
        spread = F.aggregate(F.col(f"_tpw{n}"), F.lit(0.0), lambda s, x: s + F.abs(x - m)) / float(n)
        return [
            Stage({"_tp": typical()}),
            Stage({f"_tpm{n}": mean, f"_tpw{n}": window}),
            Stage({f"_dev{n}": since(n, spread)}),
            Stage(
                {
                    name: since(
                        n,
                        # The mean of equal prices can miss them by the last bits: that is no deviation.
                        F.when(F.least(F.abs(F.col("_tp") - m), F.col(f"_dev{n}")) <= F.abs(m) * 1e-13, 0.0).otherwise(
                            (F.col("_tp") - m) / (0.015 * F.col(f"_dev{n}"))
                        ),
                    )
                }
            ),
        ]

    return Indicator([name], build)


def true_range_stages(f: Frame):
    return [
        Stage({"_pc": f.lag(C)}),
        Stage(
            {
                "_tr": since(2, F.greatest(F.col(H), F.col("_pc")) - F.least(F.col(L), F.col("_pc"))),
                "_bp": since(2, F.col(C) - F.least(F.col(L), F.col("_pc"))),
            }
        ),
    ]


def ultosc(short: int = 7, middle: int = 14, long: int = 28) -> Indicator:
    def build(f: Frame):
        sums, total = {}, F.lit(0.0)
        for n, weight in ((short, 4.0), (middle, 2.0), (long, 1.0)):
            sums[f"_bp{n}"] = F.sum("_bp").over(f.last(n))
            sums[f"_trs{n}"] = F.sum("_tr").over(f.last(n))
            total = total + weight * ratio_or_zero(F.col(f"_bp{n}"), F.col(f"_trs{n}"))
        first = max(short, middle, long) + 1
        return [*true_range_stages(f), Stage(sums), Stage({"ultosc": since(first, 100.0 * total / 7.0)})]

    return Indicator(["ultosc"], build)


def willr(n: int = 14) -> Indicator:
    name = f"willr{n}"

    def build(f: Frame):
        low, high = F.min(L).over(f.last(n)), F.max(H).over(f.last(n))
        span = F.col(f"_hh{n}") - F.col(f"_ll{n}")
        return [
            Stage({f"_ll{n}": low, f"_hh{n}": high}),
            Stage({name: since(n, ratio_or_zero(F.col(f"_hh{n}") - F.col(C), span, -100.0))}),
        ]

    return Indicator([name], build)


def tr() -> Indicator:
    """True range and its percentage of the typical price."""

    def build(f: Frame):
        return [*true_range_stages(f), Stage({"tr": F.col("_tr"), "vl": F.try_divide("_tr", typical()) * 100.0})]

    return Indicator(["tr", "vl"], build)


def ret_index() -> Indicator:
    """Value of one unit invested at the first bar."""
    return Indicator(["ret_index"], lambda f: [Stage({"ret_index": F.try_divide(C, f.first(C))})])


def vol(n: int = 250, min_periods: int = 50, of: str = "ret_index") -> Indicator:
    """Rolling sample deviation of a column (by default the return index level) times sqrt(n).

    The frame is added up anew for each row: differences of running sums would lose the digits of
    a small deviation after a long rise. Values are counted by a running count, which loses nothing.
    """

    def build(f: Frame):
        count = F.col(f"_n_{of}")
        held = count - F.coalesce(f.lag(count, n), F.lit(0))
        value = F.when(held >= max(min_periods, 2), F.stddev_samp(of).over(f.last(n)) * math.sqrt(n))
        first = [Stage({"ret_index": F.try_divide(C, f.first(C))})] if of == "ret_index" else []
        return [*first, Stage({f"_n_{of}": F.count(of).over(f.so_far)}), Stage({"vol": value})]

    return Indicator(["vol"], build)


def resumed_vol(place: Column, new: Column, value: Column, cut: Column, n: int = 250, min_periods: int = 50) -> Column:
    """:func:`vol` of ``value`` at the new rows of each symbol; NaN at old ones.

    ``place`` counts a symbol's rows from 1, which must arrive together and in date order; the first may
    bring the values ``cut`` off before it, the last ``n - 1`` at least if there were more. The frame of a
    row is added up anew, as differences from its last value, for a stack of rows at once.
    """
    fewest = max(min_periods, 2)

    def deviations(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        before, at, known = np.zeros(n - 1), 0, 0
        for places, news, values, cuts in batches:
            p, x = places.to_numpy(np.int64), values.to_numpy(float)
            rows, held, pieces, total = np.empty(len(p), np.int64), np.empty(len(p), np.int64), [before], n - 1
            edges = sorted({0, *np.flatnonzero(p == 1).tolist(), len(p)})
            for a, b in zip(edges, edges[1:]):
                if p[a] == 1:
                    at, known = 0, 0
                    if cuts[a] is not None:
                        pieces.append(np.asarray(cuts[a], float))
                        known = len(pieces[-1])
                        total += known
                if (p[a:b] != np.arange(at + 1, at + 1 + b - a)).any():
                    raise RuntimeError("rows of a symbol must arrive together and in date order")
                pieces.append(x[a:b])
                rows[a:b], held[a:b] = np.arange(total, total + b - a), np.arange(known + 1, known + 1 + b - a)
                at, known, total = at + b - a, known + b - a, total + b - a
            series = np.concatenate(pieces)
            out, frames = np.full(len(p), np.nan), np.lib.stride_tricks.sliding_window_view(series, n)
            todo = np.flatnonzero(news.to_numpy(bool) & (held >= fewest))
            for some in np.array_split(todo, len(todo) // 1024 + 1):
                size = np.minimum(held[some], n)[:, None]
                inside = np.arange(n) >= n - size
                gap = np.where(inside, frames[rows[some] - n + 1] - series[rows[some]][:, None], 0.0)
                gap = np.where(inside, gap - gap.sum(1, keepdims=True) / size, 0.0)
                out[some] = np.sqrt((gap * gap).sum(1) / (size[:, 0] - 1) * n)
            before = series[len(series) - n + 1 :]
            yield pd.Series(out)

    # Not deterministic to the optimizer: no filter may move below it and cut the history.
    return F.pandas_udf(deviations, "double").asNondeterministic()(place, new, value, cut)


def volume_rate() -> Indicator:
    """Volume relative to the largest of the kept window, scaled for both chart panels."""

    def build(f: Frame):
        return [
            Stage({"_vmax": F.max(V).over(f.whole), "_top": F.max(H).over(f.whole), "_under": F.min(L).over(f.whole)}),
            Stage({"_vr": F.when(F.col("_vmax") != 0, F.col(V) / F.col("_vmax"))}),
            Stage(
                {
                    "v_rate": F.col("_vr") * 50.0,
                    "v_rate_p": F.col("_vr") * ((F.col("_top") - F.col("_under")) / 4.0) + F.col("_under"),
                }
            ),
        ]

    return Indicator(["v_rate", "v_rate_p"], build)


def rolling_corr(bars: DataFrame, reference: DataFrame, window: int = 5) -> DataFrame:
    """Correlation of daily changes with a reference series ``(date, adj_close)``.

    Both tables are used as passed in, null rows included: gaps are padded forward, so a
    holiday is a change of 0. A value needs ``window`` pairs in a row of the union of both
    date lists; since the lists are sets of dates, that holds exactly when all the window's
    own dates are found in the reference and their reference positions are consecutive.
    """
    own = Frame()
    pad = F.last(C, ignorenulls=True).over(own.so_far)
    left = number_rows(bars).withColumn("_p", pad)
    left = left.withColumn("_c", F.try_divide(F.col("_p"), own.lag("_p")) - 1.0)

    # One row per calendar day at most: 366 rows a year whatever the number of symbols.
    ref = reference.groupBy(DATE).agg(F.max(C).alias(C)).withColumn(CODE, F.lit("ref"))
    ref = number_rows(ref).withColumn("_q", F.last(C, ignorenulls=True).over(own.so_far))
    ref = ref.select(
        DATE, (F.try_divide(F.col("_q"), own.lag("_q")) - 1.0).alias("_r"), F.col(RN).alias("_pos")
    )

    joined = left.join(F.broadcast(ref), DATE, "left")
    w = own.last(window)
    pair = F.col("_c").isNotNull() & F.col("_r").isNotNull()
    full = (F.count(F.when(pair, 1)).over(w) == window) & (
        F.col("_pos") - F.lag("_pos", window - 1).over(own.order) == window - 1
    )
    spread = F.stddev_pop("_c").over(w) * F.stddev_pop("_r").over(w)
    corr = F.when(full, F.try_divide(F.covar_pop("_c", "_r").over(w), spread))
    return joined.withColumn("rolling_corr", corr).select(*bars.columns, "rolling_corr")
