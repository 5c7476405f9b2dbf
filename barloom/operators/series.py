"""Applying indicators to bars.

An indicator is a short list of stages. A stage holds plain columns (window expressions over
one symbol's bars) and linear recurrences; a stage may use the columns of earlier stages.
``apply`` runs the stages of all requested indicators together, so any set of indicators
costs one shuffle on the symbol: equal window specifications collapse into one operator, and
the block order used by the recurrences is also a date order, so later windows need no new
sort. Stages run as late as possible, which keeps the rows narrow while the chains run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.bars import valid_bars
from barloom.operators.scan import BASE, BEFORE, BLK, RN, Recurrence, block_length, run_recurrences
from barloom.schema import CODE, DATE


@dataclass
class Frame:
    """Window shortcuts in the order the enclosing plan sorts by."""

    blocked: bool = False
    resumed: bool = False

    @property
    def order(self):
        spec = Window.partitionBy(CODE)
        return spec.orderBy(BLK, DATE) if self.blocked else spec.orderBy(DATE)

    def last(self, n: int):
        return self.order.rowsBetween(-(n - 1), 0)

    @property
    def so_far(self):
        return self.order.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def whole(self):
        return self.order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def first(self, col: str) -> Column:
        """The value at a symbol's first bar, which a resumed run was told."""
        first = F.first(col).over(self.so_far)
        return F.coalesce(F.col(BASE), first) if self.resumed else first

    def lag(self, col: str | Column, n: int = 1) -> Column:
        return F.lag(col, n).over(self.order)

    def lag_or_zero(self, col: str | Column, n: int) -> Column:
        return F.coalesce(F.lag(col, n).over(self.order), F.lit(0.0))


@dataclass
class Stage:
    """Columns, recurrences, and columns that rely on rows arriving in date order."""

    cols: dict[str, Column] = field(default_factory=dict)
    recurrences: dict[str, Recurrence] = field(default_factory=dict)
    folds: dict[str, Column] = field(default_factory=dict)


@dataclass
class Indicator:
    """``build`` turns a Frame into stages; ``outputs`` are the columns kept."""

    outputs: Sequence[str]
    build: Callable[[Frame], list[Stage]]


def since(row: int, value: Column) -> Column:
    """The value from the given 1-based row of the symbol on, NULL before."""
    return F.when(F.col(RN) >= row, value)


def ratio_or_zero(num: Column, den: Column, scale: float = 1.0) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den * scale)


def number_rows(bars: DataFrame) -> DataFrame:
    """Position of each bar in its symbol's history; a repeated key is an error."""
    w = Window.partitionBy(CODE).orderBy(DATE)
    repeated = F.col(DATE) == F.lag(DATE).over(w)
    return bars.withColumn(
        RN,
        F.when(
            repeated,
            F.raise_error(F.concat(F.lit("two bars for one symbol and date: "), F.col(CODE))).cast("int"),
        ).otherwise(F.row_number().over(w)),
    )


def apply(
    bars: DataFrame,
    indicators: Sequence[Indicator],
    max_rows: int | None = None,
    block: int | None = None,
    resumed: bool = False,
) -> DataFrame:
    """The complete business-day bars plus the output columns of all indicators.

    ``max_rows`` tells that no symbol has more rows, for instance after keeping the last N
    bars; recurrences then need no blocks. A symbol with more is an error. ``block`` forces the
    block length. With ``resumed`` the bars carry the columns of :mod:`barloom.operators.resume`, and
    the row numbers and the recurrences are returned too.
    """
    probe = Frame(resumed=resumed)
    built = [(i, i.build(probe)) for i in indicators]
    df = bars
    for group in _split_by_block(built) if block is None else [built]:
        df = _apply_group(df, group, max_rows, block, resumed)
    wanted = list(dict.fromkeys(o for i in indicators for o in i.outputs))
    if resumed:
        wanted += [RN, *recurrence_names(indicators)]
    return df.select(*[c for c in bars.columns if c not in wanted], *wanted)


Built = list[tuple[Indicator, list[Stage]]]


def recurrence_names(indicators: Sequence[Indicator]) -> list[str]:
    """The recurrences behind some indicators, whose last values a resumed run needs."""
    return sorted({n for i in indicators for s in i.build(Frame()) for n in s.recurrences})


def _recurrences(built: Built) -> list[Recurrence]:
    return [r for _, stages in built for s in stages for r in s.recurrences.values()]


def _split_by_block(built: Built) -> list[Built]:
    """Seeds must lie in the first block: very long periods get a pass of their own."""
    recs = _recurrences(built)
    limit = block_length(recs)
    far = [b for b in built if any(r.seed_row > limit for r in _recurrences([b]))]
    near = [b for b in built if b not in far]
    return [g for g in (near, far) if g]


def _apply_group(bars: DataFrame, built: Built, max_rows: int | None, block: int | None, resumed: bool = False) -> DataFrame:
    recs = _recurrences(built)
    block = block or block_length(recs)
    if recs and max(r.seed_row for r in recs) > block:
        raise ValueError("the block must hold the seed rows of every recurrence")
    blocked = bool(recs) and not (max_rows is not None and 0 < max_rows <= block)
    plans = [i.build(Frame(True, resumed)) if blocked else stages for i, stages in built]
    levels = max(len(p) for p in plans)

    df = number_rows(valid_bars(bars))
    if resumed:
        df = df.withColumn(RN, F.col(RN) + F.coalesce(BEFORE, F.lit(0)))
    if max_rows:
        too_many = F.raise_error(F.concat(F.lit(f"more than max_rows={max_rows} bars of symbol "), F.col(CODE))).cast("int")
        df = df.withColumn(RN, F.when(F.col(RN) > max_rows, too_many).otherwise(F.col(RN)))
    if blocked:
        df = df.withColumn(BLK, F.floor((F.col(RN) - 1) / block))
    known: set[str] = set()
    for level in range(levels):
        cols: dict[str, Column] = {}
        recurrences: dict[str, Recurrence] = {}
        for p in plans:
            k = level - (levels - len(p))
            if k >= 0:
                cols.update({n: c for n, c in p[k].cols.items() if n not in known})
                recurrences.update({n: r for n, r in p[k].recurrences.items() if n not in known})
        known.update(cols, recurrences)
        if recurrences:
            df = run_recurrences(df, cols, recurrences, block, blocked, resumed)
        elif cols:
            df = df.withColumns(cols)
    folds = {name: col for p in plans for s in p for name, col in s.folds.items()}
    if folds:
        # The windows below already left this order, so the sort is dropped at planning.
        df = df.sortWithinPartitions(*([CODE, BLK, DATE] if blocked else [CODE, DATE])).withColumns(folds)
    kept = [o for i, _ in built for o in i.outputs]
    if resumed:
        kept += [RN, *recurrence_names([i for i, _ in built])]
    return df.select(*[c for c in bars.columns if c not in kept], *dict.fromkeys(kept))
