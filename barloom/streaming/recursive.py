"""Recursive indicators updated bar by bar on a stream.

The state of a symbol is a handful of named numbers: how many bars were seen and the last of
them, the running averages, the closes that a deviation still needs, and the stop. A new bar
costs the same whatever the length of the history, and the state can start from stored bars.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barloom.operators.bars import valid_bars
from barloom.operators.sar import Stop
from barloom.schema import CODE, DATE

#: The date of a bar in days since 1970, which crosses into Python as a plain number.
DAY = "day"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LINKS = 6
CHAIN = [f"e{k}" for k in range(1, LINKS + 1)]
MEANS = ["num", "den", "up", "down", "spread", "fast", "slow", "signal", *CHAIN]
#: The published weights of the sixth to the third average, for a factor of 0.7.
W6, W5, W4, W3 = -(0.7**3), 3 * (0.7**2 + 0.7**3), -6 * 0.7**2 - 3 * (0.7 + 0.7**3), 1 + 3 * 0.7 + 0.7**3 + 3 * 0.7**2


class History:
    """The averages of one symbol. ``means`` and ``closes`` are plain numbers, as they are stored."""

    def __init__(self, span: int, period: int, fast: int, slow: int, signal: int, bands: int):
        self.span, self.period, self.bands = span, period, bands
        self.fast, self.slow, self.signal = *sorted((fast, slow)), signal
        self.n, self.day, self.close = 0, None, None
        self.means = dict.fromkeys(MEANS, 0.0)
        self.closes: deque[float] = deque(maxlen=bands)
        self.stop = Stop()

    @staticmethod
    def _seeded(value: float, x: float, row: int, n: int, start: int, step: float) -> float:
        """Sum over the seed rows from ``start`` on, its mean at the last of them, then the average."""
        if row >= start + n:
            return value + (x - value) * step
        if row < start:
            return 0.0
        if row < start + n - 1:
            return value + x
        return (value + x) / n

    def add(self, high: float, low: float, c: float) -> tuple[float | None, ...]:
        """The indicators at the next bar."""
        m, p = self.means, self.period
        self.n = n = self.n + 1
        q = 1.0 - 2.0 / (self.span + 1.0)
        m["num"], m["den"] = m["num"] * q + c, m["den"] * q + 1.0
        if n > 1:
            step = c - self.close
            ranged = max(high, self.close) - min(low, self.close)
            for name, x in (("up", max(step, 0.0)), ("down", max(-step, 0.0)), ("spread", ranged)):
                m[name] = self._seeded(m[name], x, n, p, 2, 1.0 / p)
        fast, slow, signal = self.fast, self.slow, self.signal
        m["fast"] = self._seeded(m["fast"], c, n, fast, slow - fast + 1, 2.0 / (fast + 1))
        m["slow"] = self._seeded(m["slow"], c, n, slow, 1, 2.0 / (slow + 1))
        line = m["fast"] - m["slow"]
        m["signal"] = self._seeded(m["signal"], line, n, signal, slow, 2.0 / (signal + 1))
        x, b = c, self.bands
        for k, link in enumerate(CHAIN):
            m[link] = x = self._seeded(m[link], x, n, b, k * (b - 1) + 1, 2.0 / (b + 1))
        self.closes.append(c)
        stop = self.stop.step(n, high, low)
        self.close = c

        total, out = m["up"] + m["down"], [m["num"] / m["den"]]
        ready = n > p
        out += [(100.0 * m["up"] / total if total else 0.0) if ready else None, m["spread"] if ready else None]
        out.append((m["spread"] / c * 100.0 if c else 0.0) if ready else None)
        out += [line, m["signal"], line - m["signal"]] if n >= slow + signal - 1 else [None] * 3
        if n > LINKS * (b - 1):
            middle = W6 * m["e6"] + W5 * m["e5"] + W4 * m["e4"] + W3 * m["e3"]
            mean = sum(self.closes) / len(self.closes)
            wide = 2.0 * math.sqrt(sum([(c - mean) * (c - mean) for c in self.closes]) / len(self.closes))
            out += [middle + wide, middle, middle - wide]
        else:
            out += [None] * 3
        return (*out, stop)


class BarIndicators(StatefulProcessor):
    """Named state of each symbol; one that is silent for ``idle_days`` of event time is forgotten."""

    def __init__(self, columns: list[str], idle_days: int | None, *periods: int):
        self.columns, self.idle_days, self.periods = columns, idle_days, periods

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n long, day long, close double")
        self.means = handle.getValueState("means", ", ".join(f"{m} double" for m in MEANS))
        self.closes = handle.getListState("closes", "close double")
        self.stop = handle.getValueState("stop", "long boolean, stop double, extreme double, factor double, high double, low double")

    def _load(self) -> History:
        h = History(*self.periods)
        if (seen := self.seen.get()) is not None:
            h.n, h.day, h.close = seen
            h.means = dict(zip(MEANS, self.means.get(), strict=True))
            h.closes.extend(row[0] for row in self.closes.get())
            h.stop.resume(self.stop.get())
        return h

    def _store(self, h: History) -> None:
        self.seen.update((h.n, h.day, h.close))
        self.means.update(tuple(h.means[m] for m in MEANS))
        self.closes.put([(c,) for c in h.closes])
        self.stop.update(h.stop.state())
        if self.idle_days:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((h.day + self.idle_days) * 86_400_000)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        h = self._load()
        for row in initialState.itertuples():
            for day, high, low, c in zip(row.days, row.highs, row.lows, row.closes, strict=True):
                h.add(high, low, c)
                h.day = int(day)
        if h.n:
            self._store(h)

    def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        h, out = self._load(), []
        parts = list(rows)
        columns = [np.concatenate([p[c].to_numpy() for p in parts]) for c in (DAY, "high", "low", "adj_close")]
        order = np.lexsort(columns[::-1])
        for day, high, low, c in zip(*(column[order].tolist() for column in columns), strict=True):
            if h.day is None or day > h.day:
                out.append((key[0], day, *h.add(high, low, c)))
                h.day = day
        if out:
            self._store(h)
            yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.seen, self.means, self.closes, self.stop):
            state.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_indicators(
    bars: DataFrame,
    span: int = 5,
    period: int = 14,
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    bands: int = 5,
    stored: DataFrame | None = None,
    idle_days: int | None = None,
    delay: str = "0 days",
) -> DataFrame:
    """``ewma{span}``, ``rsi{period}``, ``atr``, ``natr``, macd, bands and ``sar`` for a stream of bars.

    Incomplete and weekend bars do not count, as in the batch indicators. Bars of a symbol dated
    on or before its last seen one are ignored, like rows that are not newer than the stored
    history; of two for one day in a batch the first by price counts. ``stored`` bars fill the
    state of a stream that starts for the first time, without being emitted. With ``idle_days``
    a symbol without bars for so long, by the days of the stream, is dropped from the state and
    starts anew if it comes back; bars older than ``delay`` are then late and dropped. Start the
    query under :func:`row_store`.
    """
    names = [f"ewma{span}", f"rsi{period}", "atr", "natr", "macd", "macdsignal", "macdhist"]
    names += ["upperband", "middleband", "lowerband", "sar"]
    output = ", ".join([f"{CODE} string", f"{DAY} int", *(f"{n} double" for n in names)])
    rows = valid_bars(bars).select(CODE, F.unix_date(DATE).alias(DAY), "high", "low", "adj_close", DATE)
    if idle_days:
        rows = rows.withColumn("_ts", F.col(DATE).cast("timestamp")).withWatermark("_ts", delay)
    rows = rows.drop(DATE)
    initial = None
    if stored is not None:
        bar = F.struct(F.unix_date(DATE).alias("day"), "high", "low", "adj_close")
        tail = valid_bars(stored).groupBy(CODE).agg(F.sort_array(F.collect_list(bar)).alias("b"))
        fields = {"days": "day", "highs": "high", "lows": "low", "closes": "adj_close"}
        initial = tail.select(CODE, *[F.col(f"b.{c}").alias(n) for n, c in fields.items()]).groupBy(CODE)
    processor = BarIndicators([CODE, DAY, *names], idle_days, span, period, fast, slow, signal, bands)
    mode = "EventTime" if idle_days else "None"
    made = rows.groupBy(CODE).transformWithStateInPandas(processor, output, "Append", mode, initial)
    return made.select(CODE, F.date_from_unix_date(DAY).alias(DATE), *names)


@contextmanager
def row_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which named state needs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)
