"""Wilder's parabolic stop-and-reverse.

The stop flips sides on a condition on its own previous value, so it is no linear recurrence
and no window aggregate. The rows of a symbol are already together and in date order after
the row numbering; an Arrow-batched iterator UDF carries four numbers from row to row. Only
symbol, row number, high and low cross into Python, the other columns stay in the JVM, the
shuffle of the numbering is reused and no group is ever held as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.scan import RN
from barloom.operators.series import Frame, Indicator, Stage
from barloom.schema import CODE


class Stop:
    """The stop of one symbol, bar by bar. Its state is the six numbers that ``state`` returns."""

    __slots__ = ("acceleration", "maximum", "long", "stop", "extreme", "factor", "high", "low")

    def __init__(self, acceleration: float = 0.02, maximum: float = 0.2):
        self.acceleration, self.maximum = acceleration, maximum
        self.long, self.stop, self.extreme, self.factor = True, 0.0, 0.0, min(acceleration, maximum)
        self.high = self.low = 0.0

    def state(self) -> tuple[bool, float, float, float, float, float]:
        return self.long, self.stop, self.extreme, self.factor, self.high, self.low

    def resume(self, state: tuple) -> Stop:
        self.long, self.stop, self.extreme, self.factor, self.high, self.low = state
        return self

    def step(self, rn: int, high: float, low: float) -> float | None:
        """The stop shown at bar ``rn``, counted from 1."""
        if rn == 1:
            self.high, self.low = high, low
            return None
        if rn == 2:
            fall, rise = self.low - low, high - self.high
            self.long = not (fall > 0 and fall > rise)
            self.extreme, self.stop = (high, self.low) if self.long else (low, self.high)
            self.factor = min(self.acceleration, self.maximum)
            self.high, self.low = high, low
        # Work on mirrored prices in a fall, so one rule serves both sides.
        if self.long:
            sign, near, far, near_before, far_before = 1.0, low, high, self.low, self.high
        else:
            sign, near, far, near_before, far_before = -1.0, -high, -low, -self.high, -self.low
        s, e = sign * self.stop, sign * self.extreme
        if near <= s:
            s = max(e, far_before, far)
            shown = sign * s
            self.factor, e = min(self.acceleration, self.maximum), near
            s = max(s + self.factor * (e - s), far_before, far)
            self.long = not self.long
        else:
            shown = sign * s
            if far > e:
                e, self.factor = far, min(self.factor + self.acceleration, self.maximum)
            s = min(s + self.factor * (e - s), near_before, near)
        self.stop, self.extreme = sign * s, sign * e
        self.high, self.low = high, low
        return shown


def _stop_column(acceleration: float, maximum: float):
    def stops(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        owner, row, stop = None, 0, Stop(acceleration, maximum)
        for codes, rows, highs, lows in batches:
            out = []
            for code, rn, high, low in zip(codes.tolist(), rows.tolist(), highs.tolist(), lows.tolist()):
                if rn > 1 and (code != owner or rn != row + 1):
                    raise RuntimeError("rows of a symbol must arrive together and in date order")
                out.append(stop.step(rn, high, low))
                owner, row = code, rn
            yield pd.Series(out, dtype="float64")

    # Not deterministic to the optimizer: no filter may move below it and cut the history.
    return F.pandas_udf(stops, T.DoubleType()).asNondeterministic()


#: What a resumed run keeps of a symbol's stop.
STATE = "long boolean, stop double, extreme double, factor double, high double, low double"


def resumed_stop(rn: Column, high: Column, low: Column, held: Column, state: Column, *settings: float) -> Column:
    """The stop and its state ``(shown, long, stop, ...)`` at each row after ``held``, the last old one.

    ``state`` is what it was there; both are null for a history that starts here. Rows must
    arrive by symbol and in date order.
    """
    names = ["long", "stop", "extreme", "factor", "high", "low"]

    def stops(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        row, stop = 0, Stop(*settings)
        for columns in batches:
            rows, highs, lows, olds = (c.tolist() for c in columns[:4])
            before, out = list(zip(*(c.tolist() for c in columns[4:]), strict=True)), []
            for k, (n, h, l, old) in enumerate(zip(rows, highs, lows, olds, strict=True)):
                if n <= old:  # never for a history that starts here, where it is NaN
                    shown = None
                    if n == old:
                        stop.resume((bool(before[k][0]), *before[k][1:]))
                elif n > 1 and row != n - 1:
                    raise RuntimeError("rows of a symbol must arrive together and in date order")
                else:
                    shown = stop.step(n, h, l)
                out.append((shown, *stop.state()))
                row = n
            yield pd.DataFrame(out, columns=["shown", *names])

    columns = [rn, high, low, held.cast("double"), *(state[n].cast("double") for n in names)]
    return F.pandas_udf(stops, f"shown double, {STATE}").asNondeterministic()(*columns)


def sar(acceleration: float = 0.02, maximum: float = 0.2) -> Indicator:
    """``sar`` from raw high and low; NULL on a symbol's first bar."""

    def build(f: Frame):
        stop = _stop_column(acceleration, maximum)(F.col(CODE), F.col(RN), F.col("high"), F.col("low"))
        return [Stage(folds={"sar": F.nanvl(stop, F.lit(None).cast("double"))})]

    return Indicator(["sar"], build)
