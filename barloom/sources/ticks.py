"""Bars out of tick-like tables.

A daily bar is built from algebraic aggregates only (min, max, sum, first and last by an
order key), so every map task reduces its own ticks first. A symbol that owns a third of all
ticks therefore reaches the shuffle as at most one row per map task and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import business_day, clean
from barloom.operators.bars import fill_bins
from barloom.schema import BAR_COLUMNS, CODE, DATE


def ohlc(
    ticks: DataFrame,
    code: Column,
    day: Column,
    value: Column,
    order: Column,
    volume: Column | None = None,
) -> DataFrame:
    """One open/high/low/close(/volume) row per symbol and day.

    ``order`` must be a total order of the ticks of one day in one number of fixed width, see
    :func:`order_key`. A struct would do as well, but only fixed-width values let the partial
    sums stay in a hash table; otherwise every task sorts its raw ticks.
    """
    aggs = [
        F.min_by("_v", "_o").alias("open"),
        F.max("_v").alias("high"),
        F.min("_v").alias("low"),
        F.max_by("_v", "_o").alias("close"),
    ]
    # The symbol keeps its own type until the ticks are reduced: numbers sort and hash faster.
    cols = [code.alias(CODE), day.cast("date").alias(DATE), clean(value).alias("_v"), order.alias("_o")]
    if volume is not None:
        aggs.append(F.sum("_q").alias("volume"))
        cols.append(clean(volume).alias("_q"))
    # Quote null rows out before ordering: a day without any value has no bar.
    bars = ticks.select(*cols).where(F.col("_v").isNotNull()).groupBy(CODE, DATE).agg(*aggs)
    return bars.withColumn(CODE, F.col(CODE).cast("string"))


def order_key(*parts: tuple[Column, int]) -> Column:
    """Several non-negative whole numbers as one, the first the most significant.

    Each comes with its number of decimal digits, 38 in all. A value that needs more digits
    is an error.
    """
    if sum(digits for _, digits in parts) > 38:
        raise ValueError("an order key has at most 38 digits")
    key = None
    for value, digits in parts:
        whole = value.cast("decimal(38,0)")
        limit = F.lit(str(10**digits)).cast("decimal(38,0)") if digits < 38 else None
        if limit is not None:
            bad = F.raise_error(F.concat(F.lit(f"a part of an order key has more than {digits} digits: "), whole.cast("string")))
            whole = F.when((whole >= 0) & (whole < limit), whole).when(whole.isNotNull(), bad.cast("decimal(38,0)"))
        key = whole if key is None else (key * limit + whole).cast("decimal(38,0)")
    return key


def lineitem_bars(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Daily bars of the unit price each supplier shipped at.

    ``where`` filters the ticks on columns of the table, before symbols become text.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li = li if where is None else li.where(where)
    bars = ohlc(
        li,
        code=F.col("l_suppkey"),
        day=F.col("l_shipdate"),
        value=F.try_divide("l_extendedprice", "l_quantity"),
        order=order_key(
            (F.col("l_orderkey"), 12),
            (F.col("l_linenumber"), 1),
            (F.col("l_partkey"), 11),
            (F.round(F.col("l_extendedprice") * 100), 9),
            (F.round(F.col("l_quantity") * 100), 5),
        ),
        volume=F.col("l_quantity"),
    )
    return bars.withColumn("adj_close", F.col("close")).select(BAR_COLUMNS)


def event_ticks(events: DataFrame) -> DataFrame:
    """The event table as ``(code, ts, seq, value)`` ticks."""
    return events.select(
        F.col("event_type").alias(CODE),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        clean(F.col("value")).alias("value"),
    )


def resample_ticks(ticks: DataFrame, freq: str = "B", fill: bool = False) -> DataFrame:
    """OHLC of a value series per business day (``B``), calendar day (``D``), week or month.

    Weekend ticks belong to the Friday before them when the frequency is ``B``. With ``fill``, bins
    without ticks between a symbol's first and last one are null rows; they are made after the
    ticks are reduced.
    """
    day = F.to_date("ts")
    bucket = {
        "B": business_day(day),
        "D": day,
        "W": F.date_trunc("week", "ts").cast("date"),
        "M": F.date_trunc("month", "ts").cast("date"),
    }
    if freq not in bucket:
        raise ValueError(f"frequency must be one of {sorted(bucket)}")
    bars = ohlc(
        ticks,
        code=F.col(CODE),
        day=bucket[freq],
        value=F.col("value"),
        order=order_key((F.unix_micros("ts"), 19), (F.col("seq"), 19)),
    )
    return fill_bins(bars, freq) if fill else bars


def supplier_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier table as a symbol list."""
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").cast("string").alias(CODE),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("fullname"),
        F.lit(None).cast("string").alias("sector"),
        F.lit(None).cast("string").alias("group"),
    )
