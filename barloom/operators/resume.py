"""Indicators of new bars from the tail of a history and a few carried numbers.

A recurrence goes on from its last value, a finite window from the bars of the tail, and what
concerns the whole history (its first close, its largest volume, its range) is carried along. So
new bars of a symbol cost as much as the tail, whatever the length of its history.

A carry is one row for each symbol: ``n`` bars so far, ``base`` the first close, ``vmax``,
``top`` and ``under`` the extremes, ``means`` the values of all recurrences, ``stop`` the state of
the stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.bars import valid_bars
from barloom.operators.finite import resumed_vol, typical
from barloom.operators.sar import resumed_stop
from barloom.operators.scan import BASE, BEFORE, CARRY, HELD, RN
from barloom.operators.series import Indicator, apply, recurrence_names
from barloom.operators.standard import standard_indicators
from barloom.schema import CODE, DATE, STANDARD_COLUMNS

#: Columns that depend on the whole history; :func:`with_volume_rate` adds them when rows are read.
VOLUME_RATE = ["v_rate", "v_rate_p"]
#: Columns that follow from others of the same row; :func:`with_row_columns` adds them when rows are read.
ROW_COLUMNS = ["macdhist", "vl", "natr"]
#: Columns that look back further than ``REACH`` bars, and what they are made from; no recurrences.
FAR = ["ret_index", "vol", "sma75", "sma200", "roc75", "roc150"]
#: Bars that all other columns look back, at most, and that start every recurrence.
REACH = 64
#: Bars of the longest window, that of ``vol``.
LONGEST = 250


def resumable() -> list[Indicator]:
    """The standard set without what is made apart: the stop, and the volume against all bars."""
    return [i for i in standard_indicators() if list(i.outputs) not in (["sar"], VOLUME_RATE)]


def with_carry(bars: DataFrame, carry: DataFrame | None, tail: int) -> DataFrame:
    """Bars, old tail and new, with the columns a resumed run needs.

    A symbol with less than ``REACH`` bars starts anew from its tail, so warm-up rows need no care.
    """
    names = recurrence_names(resumable())
    if carry is None:
        means = "struct<" + ",".join(f"{n}:double" for n in names) + ">"
        none = {BEFORE: "long", HELD: "long", BASE: "double", CARRY: means, "_old": "long"}
        empty = {c: F.lit(None).cast(t) for c, t in none.items()}
        stop = F.lit(None).cast("struct<long:boolean,stop:double,extreme:double,factor:double,high:double,low:double>")
        extremes = {f"_{c}": F.lit(None).cast("double") for c in ("vmax", "top", "under")}
        return bars.withColumns({**empty, "_stop": stop, **extremes})
    goes_on = F.col("n") >= REACH
    return bars.join(
        carry.select(
            CODE,
            F.when(goes_on, F.greatest(F.col("n") - tail, F.lit(0))).alias(BEFORE),
            F.when(goes_on, F.col("n")).alias(HELD),
            F.col("base").alias(BASE),
            F.when(goes_on, F.col("means")).alias(CARRY),
            F.col("n").alias("_old"),
            F.when(goes_on, F.col("stop")).alias("_stop"),
            *[F.col(c).alias(f"_{c}") for c in ("vmax", "top", "under")],
        ),
        CODE,
        "left",
    )


def enrich_resumed(bars: DataFrame) -> DataFrame:
    """All rows of :func:`with_carry` that are new, and the few old ones before them, with the standard
    columns but the volume rate, and ``_new``.

    What looks far back is made first, from the whole tail; the rest sees the end of it, with the values that
    ``vol`` needs of the rows cut off in the first row that is left.
    """
    far = [i for i in resumable() if set(i.outputs) <= set(FAR) and list(i.outputs) != ["vol"]]
    near = [i for i in resumable() if not set(i.outputs) <= set(FAR)]
    df = apply(valid_bars(bars), far, resumed=True)
    start = F.greatest(F.col(BEFORE), F.col(HELD) - REACH)
    cut = F.col(RN).between(start - (LONGEST - 2), start)
    whole = Window.partitionBy(CODE).orderBy(DATE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("_cut", F.collect_list(F.when(cut, F.col("ret_index"))).over(whole))
    df = df.where(F.col(HELD).isNull() | (F.col(RN) > start)).withColumn("_cut", F.when(F.col(RN) == start + 1, F.col("_cut")))
    df = apply(df.drop(RN).withColumn(BEFORE, start), near, resumed=True)
    rn, new = F.col(RN), F.col(RN) > F.coalesce(HELD, F.lit(0))
    stop = resumed_stop(rn, F.col("high"), F.col("low"), F.col(HELD), F.col("_stop"))
    vol = resumed_vol(rn - F.coalesce(BEFORE, F.lit(0)), new, F.col("ret_index"), F.col("_cut"), LONGEST)
    # Both need the order of the rows, which is not known any more behind the first of them.
    ordered = df.sortWithinPartitions(CODE, DATE).withColumns({"_sar": stop, "vol": F.nanvl(vol, F.lit(None).cast("double"))})
    return ordered.withColumn("sar", F.col("_sar.shown")).withColumn("_new", rn > F.coalesce("_old", F.lit(0)))


def last_only(last: str) -> list[Column]:
    """What :func:`next_carry` reads of a symbol's last row, dated ``last``; null in all others."""
    kept = [RN, BASE, "_vmax", "_top", "_under", *recurrence_names(resumable()), "_sar"]
    return [F.when(F.col(DATE) == F.col(last), F.col(c)).alias(c) for c in kept]


def next_carry(enriched: DataFrame) -> DataFrame:
    """The carry after the new rows of :func:`enrich_resumed`; what is carried stands in each symbol's last
    row only, see :func:`last_only`."""
    names = recurrence_names(resumable())
    fields = ["long", "stop", "extreme", "factor", "high", "low"]
    # Numbers of fixed width are summed up in a hash table, without sorting the rows; the wide values are one row each.
    spans = enriched.groupBy(CODE).agg(
        F.max(DATE).alias(DATE),
        F.min_by("adj_close", DATE).alias("_first"),
        *[F.max(c).alias(f"_max_{c}") for c in ("volume", "high")],
        F.min("low").alias("_min_low"),
    )
    ends = enriched.where(F.col(RN).isNotNull()).select(
        CODE, RN, BASE, "_vmax", "_top", "_under", F.struct(*names).alias("means"), F.struct(*[F.col(f"_sar.{c}").alias(c) for c in fields]).alias("stop")
    )
    return spans.join(ends, CODE).select(
        CODE,
        DATE,
        F.col(RN).cast("long").alias("n"),
        F.coalesce(BASE, "_first").alias("base"),
        F.greatest("_max_volume", "_vmax").alias("vmax"),
        F.greatest("_max_high", "_top").alias("top"),
        F.least("_min_low", "_under").alias("under"),
        "means",
        "stop",
    )


def with_row_columns(rows: DataFrame) -> DataFrame:
    """Stored rows with ``ROW_COLUMNS``, as the indicators make them."""
    atr, close = F.col("atr"), F.col("adj_close")
    natr = F.when(atr.isNotNull(), F.when(close == 0, 0.0).otherwise(atr / close * 100.0))
    made = [F.col("macd") - F.col("macdsignal"), F.try_divide("tr", typical()) * 100.0, natr]
    return rows.withColumns(dict(zip(ROW_COLUMNS, made, strict=True)))


def with_volume_rate(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Stored rows in the order of the enriched table, with volumes against the whole history."""
    rate = F.when(F.col("vmax") != 0, F.col("volume") / F.col("vmax"))
    joined = rows.join(carry.select(CODE, "vmax", "top", "under"), CODE)
    span = (F.col("top") - F.col("under")) / 4.0
    added = {"v_rate": rate * 50.0, "v_rate_p": rate * span + F.col("under")}
    plain = [c for c in rows.columns if c not in STANDARD_COLUMNS]
    return joined.withColumns(added).select(*plain, *STANDARD_COLUMNS)
