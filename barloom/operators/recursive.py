"""Indicators defined by a recurrence, computed with the block-wise scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.operators.finite import C, true_range_stages
from barloom.operators.scan import RN, Recurrence
from barloom.operators.series import Frame, Indicator, Stage, since


def ema_decay(n: int) -> float:
    return 1.0 - 2.0 / (n + 1.0)


def wilder_decay(n: int) -> float:
    return (n - 1.0) / n


def seeded(value: Column, n: int, decay: float, start: int = 1) -> Recurrence:
    """Moving average that starts as the plain mean of n rows from ``start`` on."""
    return Recurrence(decay, value, gain=1.0 - decay, start=start, seed_rows=n)


def ewma(span: int = 5) -> Indicator:
    """Exponentially weighted mean with weights normalised over the rows seen so far."""
    name, raw = f"ewma{span}", f"_ew{span}"
    q = ema_decay(span)

    def build(f: Frame):
        weights = (1.0 - F.pow(F.lit(q), F.col(RN).cast("double"))) / (1.0 - q)
        return [Stage({}, {raw: Recurrence(q, F.col(C))}), Stage({name: F.col(raw) / weights})]

    return Indicator([name], build)


def rsi(n: int = 14) -> Indicator:
    name, up, down = f"rsi{n}", f"_up{n}", f"_dn{n}"
    q = wilder_decay(n)

    def build(f: Frame):
        step = F.col(C) - F.col("_pc")
        gain, loss = F.greatest(step, F.lit(0.0)), F.greatest(-step, F.lit(0.0))
        total = F.col(up) + F.col(down)
        return [
            Stage({"_pc": f.lag(C)}),
            Stage({}, {up: seeded(gain, n, q, start=2), down: seeded(loss, n, q, start=2)}),
            Stage({name: since(n + 1, F.when(total == 0, 0.0).otherwise(100.0 * F.col(up) / total))}),
        ]

    return Indicator([name], build)


def _atr_stages(f: Frame, n: int) -> list[Stage]:
    return [
        *true_range_stages(f),
        Stage({}, {f"_atr{n}": seeded(F.col("_tr"), n, wilder_decay(n), start=2)}),
    ]


def atr(n: int = 14) -> Indicator:
    return Indicator(["atr"], lambda f: [*_atr_stages(f, n), Stage({"atr": since(n + 1, F.col(f"_atr{n}"))})])


def natr(n: int = 14) -> Indicator:
    def build(f: Frame):
        value = F.when(F.col(C) == 0, 0.0).otherwise(F.col(f"_atr{n}") / F.col(C) * 100.0)
        return [*_atr_stages(f, n), Stage({"natr": since(n + 1, value)})]

    return Indicator(["natr"], build)


def macd(fastperiod: int = 12, slowperiod: int = 26, signalperiod: int = 9) -> Indicator:
    """Difference of two seeded averages and its own average.

    Both averages start at the row of the slow one, so the fast seed uses the rows just
    before it rather than the first ones.
    """
    fast, slow = sorted((fastperiod, slowperiod))
    sig = signalperiod
    first = slow + sig - 1
    key = f"{fast}_{slow}"

    def build(f: Frame):
        close, line = F.col(C), F.col(f"_ml{key}")
        return [
            Stage(
                {},
                {
                    f"_mf{key}": seeded(close, fast, ema_decay(fast), start=slow - fast + 1),
                    f"_ms{key}": seeded(close, slow, ema_decay(slow)),
                },
            ),
            Stage({f"_ml{key}": since(slow, F.col(f"_mf{key}") - F.col(f"_ms{key}"))}),
            Stage({}, {f"_mg{key}_{sig}": seeded(line, sig, ema_decay(sig), start=slow)}),
            Stage(
                {
                    "macd": since(first, line),
                    "macdsignal": since(first, F.col(f"_mg{key}_{sig}")),
                    "macdhist": since(first, line - F.col(f"_mg{key}_{sig}")),
                }
            ),
        ]

    return Indicator(["macd", "macdsignal", "macdhist"], build)


def bbands(n: int = 5, deviations: float = 2.0, vfactor: float = 0.7) -> Indicator:
    """Bands around a T3 average: six chained seeded averages mixed with fixed weights."""
    q, v = ema_decay(n), vfactor
    # Weights of the third to sixth average in the published T3 formula.
    w6, w5, w4, w3 = (
        -(v**3),
        3 * (v**2 + v**3),
        -6 * v**2 - 3 * (v + v**3),
        1 + 3 * v + v**3 + 3 * v**2,
    )
    first = 6 * (n - 1) + 1

    def build(f: Frame):
        stages, source = [], F.col(C)
        for k in range(1, 7):
            name = f"_t{k}_{n}"
            stages.append(Stage({}, {name: seeded(source, n, q, start=(k - 1) * (n - 1) + 1)}))
            source = F.col(name)
        stages[-1].cols[f"_sd{n}"] = F.stddev_pop(C).over(f.last(n))
        e = {k: F.col(f"_t{k}_{n}") for k in range(3, 7)}
        middle = w6 * e[6] + w5 * e[5] + w4 * e[4] + w3 * e[3]
        width = deviations * F.col(f"_sd{n}")
        stages.append(
            Stage(
                {
                    "middleband": since(first, middle),
                    "upperband": since(first, middle + width),
                    "lowerband": since(first, middle - width),
                }
            )
        )
        return stages

    return Indicator(["upperband", "middleband", "lowerband"], build)
