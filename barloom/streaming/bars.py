"""Ticks to bars as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.schema import CODE, DATE
from barloom.sources.ticks import order_key


def stream_bars(ticks: DataFrame, delay: str = "1 day") -> DataFrame:
    """Business-day bars from a stream of ``(code, ts, seq, value)``.

    A bar is emitted once the watermark has passed its day; later ticks are dropped. Weekend
    ticks move to the Friday before them by shifting their event time, and the watermark
    follows the shifted time, so they are not late. State holds one row per open bar, since
    ticks are reduced before the shuffle.
    """
    back = F.greatest(F.weekday("ts") - 4, F.lit(0))
    day = ticks.select(
        CODE,
        (F.col("ts") - F.make_dt_interval(back)).alias("bar_ts"),
        F.col("value").alias("_v"),
        order_key((F.unix_micros("ts"), 19), (F.col("seq"), 19)).alias("_o"),
    ).where(F.col("_v").isNotNull())
    return (
        day.withWatermark("bar_ts", delay)
        .groupBy(CODE, F.window("bar_ts", "1 day").alias("_w"))
        .agg(
            F.min_by("_v", "_o").alias("open"),
            F.max("_v").alias("high"),
            F.min("_v").alias("low"),
            F.max_by("_v", "_o").alias("close"),
        )
        .select(CODE, F.to_date("_w.start").alias(DATE), "open", "high", "low", "close")
    )
