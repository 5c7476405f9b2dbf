"""Windows of the return index as training samples.

A symbol yields at most 121 samples whatever the length of its history, because training
looks at the last 135 bars; per-symbol model data is therefore bounded by that constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.schema import CODE, DATE, FEATURE_LENGTH, TRAIN_RANGE_CAP
from barloom.session import checkpoint, spread


def recent_rows(series: DataFrame) -> DataFrame:
    """The last rows of every symbol that training can see."""
    back = Window.partitionBy(CODE).orderBy(F.col(DATE).desc())
    return series.withColumn("_pos", F.row_number().over(back)).where(F.col("_pos") <= TRAIN_RANGE_CAP)


def stored_recent(series: DataFrame) -> DataFrame:
    """Recent rows kept in shared storage and spread by symbol for several fits.

    They are few bytes but become many rows in a fit, so the partition count is fixed.
    """
    return spread(checkpoint(recent_rows(series)), CODE)


def _recent(series: DataFrame, value: str) -> DataFrame:
    rows = series if "_pos" in series.columns else recent_rows(series)
    return rows.select(CODE, DATE, F.col(value).alias("_x"), "_pos")


def _windows(recent: DataFrame, span: int | None, last_target: int) -> DataFrame:
    # Positions count from the end and the order is theirs reversed, so the previous 14 rows
    # in date order are the following 14 in the order the rows already have.
    back = Window.partitionBy(CODE).orderBy("_pos")
    older = back.rowsBetween(1, FEATURE_LENGTH)
    available = F.count(F.lit(1)).over(Window.partitionBy(CODE))
    reach = available if span is None else F.least(available, F.lit(span))
    return (
        recent.withColumn("_reach", reach)
        .withColumn("_older", F.collect_list("_x").over(older))
        .where((F.col("_pos") >= last_target) & (F.col("_pos") <= F.col("_reach") - FEATURE_LENGTH))
        .withColumn("features", F.reverse("_older"))
    )


def binary_class(series: DataFrame, span: int | None = None, value: str = "ret_index") -> DataFrame:
    """14 values and whether the next one is higher than the last of them.

    ``span`` is the number of recent rows used (NULL: all, never more than 135). The newest
    value is never a label, so a span of n gives n - 15 samples.
    """
    rows = _windows(_recent(series, value), span, last_target=2)
    label = (F.element_at("features", -1) < F.col("_x")).cast("int")
    return rows.select(CODE, DATE, "features", label.alias("label"))


def proportion_class(series: DataFrame, span: int | None = None, value: str = "ret_index") -> DataFrame:
    """14 values and the next value; a span of n gives n - 14 samples."""
    rows = _windows(_recent(series, value), span, last_target=1)
    return rows.select(CODE, DATE, "features", F.col("_x").alias("label"))


def scoring_window(series: DataFrame, value: str = "ret_index") -> DataFrame:
    """The last 14 values of every symbol that has as many, dated by its last bar."""
    recent = _recent(series, value).where(F.col("_pos") <= FEATURE_LENGTH)
    newest = Window.partitionBy(CODE).orderBy("_pos").rowsBetween(0, FEATURE_LENGTH - 1)
    return (
        recent.withColumn("features", F.reverse(F.collect_list("_x").over(newest)))
        .where((F.col("_pos") == 1) & (F.size("features") == FEATURE_LENGTH))
        .select(CODE, DATE, "features")
    )
