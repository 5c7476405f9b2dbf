"""Moving averages by type, and the stochastics that smooth with them.

An average takes a column that is known from some row on and is known itself a number of rows
later, its lookback; averages chain that way.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators.finite import C, H, L
from barloom.operators.recursive import ema_decay, seeded
from barloom.operators.scan import RN, Varying
from barloom.operators.series import Frame, Indicator, Stage, ratio_or_zero, since

# The numbers that average types are chosen by. Type 7 takes no length and follows
# the phase of a price, which an oscillator does not have; it is not offered.
SIMPLE, EXPONENTIAL, WEIGHTED, DOUBLE, TRIPLE, TRIANGULAR, ADAPTIVE, T3 = 0, 1, 2, 3, 4, 5, 6, 8
TYPES = (SIMPLE, EXPONENTIAL, WEIGHTED, DOUBLE, TRIPLE, TRIANGULAR, ADAPTIVE, T3)
# Spans of the fastest and slowest average an adaptive one moves between, and the T3 factor.
FASTEST, SLOWEST, VOLUME_FACTOR = 2, 30, 0.7


def lookback(n: int, kind: int) -> int:
    """Rows from the first known input to the first average."""
    if kind not in TYPES:
        raise ValueError(f"average type must be one of {TYPES}")
    if n < 1:
        raise ValueError("an average needs at least one row")
    if n == 1:
        return 0
    return {DOUBLE: 2, TRIPLE: 3, T3: 6}.get(kind, 1) * (n - 1) + (kind == ADAPTIVE)


def average(f: Frame, source: str, n: int, kind: int, start: int) -> tuple[str, int, list[Stage]]:
    """The average of a column known from row ``start`` on: its name, its first row, its stages."""
    first, name = start + lookback(n, kind), f"{source}_{kind}_{n}"
    if n == 1:
        return source, start, []
    x = F.col(source)
    chain = {EXPONENTIAL: 1, DOUBLE: 2, TRIPLE: 3, T3: 6}.get(kind, 0)
    if chain:
        stages, value = [], x
        for k in range(chain):
            link = seeded(value, n, ema_decay(n), start=start + k * (n - 1))
            stages.append(Stage({}, {f"{name}_e{k + 1}": link}))
            value = F.col(f"{name}_e{k + 1}")
        e = [F.col(f"{name}_e{k + 1}") for k in range(chain)]
        return name, first, [*stages, Stage({name: since(first, _mixed(kind, e))})]
    if kind == SIMPLE:
        return name, first, [Stage({name: since(first, F.avg(source).over(f.last(n)))})]
    if kind == WEIGHTED:
        # Weights 1 to n by the row number, so that one frame serves any length.
        at, frame = F.col(RN).cast("double"), f.last(n)
        total = F.sum(at * x).over(frame) - (at - float(n)) * F.sum(x).over(frame)
        return name, first, [Stage({name: since(first, total / (n * (n + 1) / 2.0))})]
    if kind == TRIANGULAR:
        short, inner = n // 2 + n % 2, f"{name}_m"
        long = n // 2 + 1
        return name, first, [
            Stage({inner: since(start + short - 1, F.avg(source).over(f.last(short)))}),
            Stage({name: since(first, F.avg(inner).over(f.last(long)))}),
        ]
    return name, first, _adaptive(f, source, name, n, start)


def _mixed(kind: int, e: list):
    """The average out of chained exponential ones."""
    if kind == EXPONENTIAL:
        return e[0]
    if kind == DOUBLE:
        return 2.0 * e[0] - e[1]
    if kind == TRIPLE:
        return 3.0 * e[0] - 3.0 * e[1] + e[2]
    v = VOLUME_FACTOR
    # The published weights of the third to the sixth average.
    return (
        -(v**3) * e[5]
        + 3 * (v**2 + v**3) * e[4]
        + (-6 * v**2 - 3 * (v + v**3)) * e[3]
        + (1 + 3 * v + v**3 + 3 * v**2) * e[2]
    )


def _adaptive(f: Frame, source: str, name: str, n: int, start: int) -> list[Stage]:
    """An exponential average whose factor follows how straight the last ``n`` rows went.

    It starts from the last value before the first full window. The factor differs from row to
    row, so the average is a recurrence with varying coefficients.
    """
    slow, fast = 2.0 / (SLOWEST + 1), 2.0 / (FASTEST + 1)
    first, x = start + n, F.col(source)
    step, way, factor = f"{name}_d", f"{name}_w", f"{name}_s"
    net = F.abs(x - f.lag(source, n))
    straight = F.when(F.col(way) <= net, 1.0).otherwise(net / F.col(way))
    s = F.col(factor)
    return [
        Stage({step: since(start + 1, F.abs(x - f.lag(source)))}),
        Stage({way: since(first, F.sum(step).over(f.last(n)))}),
        Stage({factor: since(first, F.pow(straight * (fast - slow) + slow, F.lit(2.0)))}),
        Stage({}, {f"{name}_y": Varying(1.0 - fast**2, s * x, start=first, factor=1.0 - s, seed=x)}),
        Stage({name: since(first, F.col(f"{name}_y"))}),
    ]


def _raw_k(f: Frame, n: int):
    low, high = F.min(L).over(f.last(n)), F.max(H).over(f.last(n))
    return [
        Stage({f"_ll{n}": low, f"_hh{n}": high}),
        Stage(
            {
                f"_k{n}": since(
                    n, ratio_or_zero(F.col(C) - F.col(f"_ll{n}"), F.col(f"_hh{n}") - F.col(f"_ll{n}"), 100.0)
                )
            }
        ),
    ]


def stoch(
    fastk_period: int = 5, slowk_period: int = 3, slowk_matype: int = 0, slowd_period: int = 3, slowd_matype: int = 0
) -> Indicator:
    """Slow stochastics; both columns start where the later one does."""
    lookback(slowk_period, slowk_matype), lookback(slowd_period, slowd_matype)

    def build(f: Frame):
        slow, at, smooth = average(f, f"_k{fastk_period}", slowk_period, slowk_matype, fastk_period)
        again, first, smoother = average(f, slow, slowd_period, slowd_matype, at)
        shown = {"slowk": since(first, F.col(slow)), "slowd": since(first, F.col(again))}
        return [*_raw_k(f, fastk_period), *smooth, *smoother, Stage(shown)]

    return Indicator(["slowk", "slowd"], build)


def stochf(fastk_period: int = 5, fastd_period: int = 3, fastd_matype: int = 0) -> Indicator:
    """Fast stochastics; both columns start where the average does."""
    lookback(fastd_period, fastd_matype)

    def build(f: Frame):
        k = f"_k{fastk_period}"
        d, first, smooth = average(f, k, fastd_period, fastd_matype, fastk_period)
        return [*_raw_k(f, fastk_period), *smooth, Stage({"fastk": since(first, F.col(k)), "fastd": since(first, F.col(d))})]

    return Indicator(["fastk", "fastd"], build)
