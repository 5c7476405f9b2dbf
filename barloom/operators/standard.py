"""The indicator set of the daily analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators import finite as fin
from barloom.operators import recursive as rec
from barloom.operators import stochastics as stc
from barloom.operators.sar import sar
from barloom.operators.series import Indicator, apply
from barloom.schema import STANDARD_COLUMNS


def standard_indicators() -> list[Indicator]:
    return [
        *[fin.sma(n) for n in (5, 25, 50, 75, 200)],
        *[rec.ewma(n) for n in (5, 25, 50, 75, 200)],
        rec.bbands(),
        sar(),
        fin.ret_index(),
        fin.vol(),
        *[rec.rsi(n) for n in (9, 14)],
        fin.mfi(),
        *[fin.roc(n) for n in (10, 25, 50, 75, 150)],
        fin.cci(),
        fin.ultosc(),
        stc.stoch(),
        stc.stochf(),
        rec.macd(),
        fin.willr(),
        *[fin.mom(n) for n in (10, 25)],
        fin.tr(),
        rec.atr(),
        rec.natr(),
        fin.volume_rate(),
    ]


def enrich(bars: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Bars plus all columns of the standard set, in the order of the enriched table."""
    df = apply(bars, standard_indicators(), max_rows=max_rows)
    return df.select(*bars.columns, *STANDARD_COLUMNS)
