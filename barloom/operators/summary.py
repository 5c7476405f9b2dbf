"""Cross-symbol reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import change_ratio, truncated
from barloom.operators.bars import by_date, exclude_indices, fresh_only, rank
from barloom.schema import CODE, DATE


def last_rows(enriched: DataFrame, span: int = 1) -> DataFrame:
    """The last row of every symbol with the adjusted close ``span`` rows before it."""
    w = by_date()
    return (
        enriched.withColumn("_start", F.lag("adj_close", span).over(w))
        .withColumn("_next", F.lead(DATE).over(w))
        .where(F.col("_next").isNull())
        .drop("_next")
    )


def summarise(
    enriched: DataFrame,
    symbols: DataFrame,
    asof: str,
    span: int = 1,
    screening_key: str | None = None,
    max_age: int = 10,
) -> DataFrame:
    """One row per listed, fresh, non-index symbol.

    Prices are cut to whole numbers before the change is taken. ``change`` and ``ratio`` are
    NULL when the history is too short. With ``screening_key`` the trend and prediction give
    way to that column. The list is joined by key without a forced broadcast: it grows with
    the number of symbols, so the optimizer decides by its size.
    """
    last = fresh_only(last_rows(exclude_indices(enriched), span), asof, max_age, last_date=DATE)
    close = truncated(F.col("adj_close"))
    change = close - truncated(F.col("_start"))
    if screening_key:
        tail = [truncated(F.col(screening_key)).alias(screening_key)]
    else:
        tail = [truncated(F.col("classified")).alias("trend"), truncated(F.col("predicted")).alias("pred")]
    figures = last.select(
        CODE,
        truncated(F.col("open")).alias("open"),
        truncated(F.col("high")).alias("high"),
        truncated(F.col("low")).alias("low"),
        close.alias("close"),
        change.alias("change"),
        change_ratio(change, close).alias("ratio"),
        *tail,
    )
    # A symbol listed twice keeps one name, as the first of them in text order.
    names = symbols.groupBy(CODE).agg(F.min("name").alias("name"))
    return figures.join(names, CODE, "inner").select(*figures.columns, "name")


def ranked_summary(
    enriched: DataFrame,
    symbols: DataFrame,
    asof: str,
    span: int = 1,
    sortkey: str | None = "ratio",
    ascending: bool = False,
    screening_key: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    report = summarise(enriched, symbols, asof, span, screening_key)
    return rank(report, sortkey, ascending, limit)


def correlation_report(correlated: DataFrame) -> DataFrame:
    """Last rolling correlation of every symbol."""
    w = Window.partitionBy(CODE).orderBy(F.col(DATE).desc())
    return (
        correlated.withColumn("_rd", F.row_number().over(w)).where(F.col("_rd") == 1).select(CODE, DATE, "rolling_corr")
    )
