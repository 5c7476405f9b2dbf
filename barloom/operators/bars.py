"""Table operators on bars: alignment, tails, upserts, resampling and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import change_ratio, is_business_day, is_index, next_business_day, truncated
from barloom.schema import BAR_COLUMNS, CODE, DATE, KEY, OHLC_HEADERS, PRICES, VALUES
from barloom.session import checkpoint


def by_date(descending: bool = False):
    """Bars of one symbol in date order; at most one row per calendar day."""
    return Window.partitionBy(CODE).orderBy(F.col(DATE).desc() if descending else F.col(DATE).asc())


def valid_bars(bars: DataFrame) -> DataFrame:
    """Business-day bars without missing values.

    Aligning to business days and then dropping incomplete rows leaves exactly the complete
    weekday rows, so this needs no calendar and no shuffle; the filter reaches the scan.
    """
    complete = F.lit(True)
    for c in VALUES:
        complete = complete & F.col(c).isNotNull()
    return bars.where(is_business_day(F.col(DATE)) & complete)


#: Length of a bin as an interval; business days are days without weekends.
BIN_STEPS = {"B": "1 day", "D": "1 day", "W": "7 days", "M": "1 month"}


def fill_bins(bars: DataFrame, freq: str = "B") -> DataFrame:
    """Every bin between a symbol's first and last one; bins without a bar are null rows.

    Bars are dated by the first day of their bin. The gaps come from the next date of each row,
    so one window replaces a join with a calendar: every row expands to itself plus the bins
    until the next bar.
    """
    if freq not in BIN_STEPS:
        raise ValueError(f"frequency must be one of {sorted(BIN_STEPS)}")
    nxt = F.lead(DATE).over(by_date())
    days = F.sequence(F.col(DATE), F.coalesce(F.date_sub(nxt, 1), F.col(DATE)), F.expr(f"interval {BIN_STEPS[freq]}"))
    spread = bars.withColumn("_days", days).withColumn("_day", F.explode("_days"))
    own = F.col("_day") == F.col(DATE)
    kept = spread.where(is_business_day(F.col("_day"))) if freq == "B" else spread
    return kept.select(
        CODE,
        F.col("_day").alias(DATE),
        *[F.when(own, F.col(c)).alias(c) for c in bars.columns if c not in KEY],
    )


def business_day_align(bars: DataFrame) -> DataFrame:
    """Every weekday between a symbol's first and last bar; days without a bar are null rows."""
    return fill_bins(bars, "B")


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any missing value."""
    return df.dropna("any", subset=list(subset) if subset else None)


def last_bars(bars: DataFrame, days: int) -> DataFrame:
    """The last ``days`` rows of every symbol; 0 keeps all."""
    if days == 0:
        return bars
    return (
        bars.withColumn("_rd", F.row_number().over(by_date(descending=True)))
        .where(F.col("_rd") <= days)
        .drop("_rd")
    )


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of both tables by key; old values win, new values fill missing cells and rows."""
    cols = [c for c in old.columns if c not in KEY]
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in KEY], "full_outer")
    return joined.select(*[F.coalesce(f"o.{c}", f"n.{c}").alias(c) for c in KEY + cols])


def merge_frames(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join of two tables on symbol and date."""
    return left.join(right, KEY, "inner")


def high_water(bars: DataFrame) -> DataFrame:
    """Last date of every symbol and the next business day, the start of the next fetch."""
    return bars.groupBy(CODE).agg(F.max(DATE).alias("last_date")).withColumn(
        "next_date", next_business_day(F.col("last_date"))
    )


def new_rows(stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed rows from the next business day on; every row of a symbol not stored yet."""
    mark = high_water(stored).select(CODE, "next_date")
    fresh = landed.join(mark, CODE, "left").where(F.col("next_date").isNull() | (F.col(DATE) >= F.col("next_date")))
    return fresh.drop("next_date")


def changed_codes(stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Symbols that got new rows; only they are refitted and saved."""
    return new_rows(stored, landed).select(CODE).distinct()


def resample_bars(bars: DataFrame, interval: str = "w", fill: bool = False) -> DataFrame:
    """Daily, weekly or monthly bars from daily ones; with ``fill`` empty bins are null rows."""
    units = {"d": None, "w": "week", "m": "month"}
    if interval not in units:
        raise ValueError("interval must be 'd', 'w' or 'm'")
    if units[interval] is None:
        return fill_bins(bars, "D") if fill else bars
    period = F.date_trunc(units[interval], F.col(DATE)).cast("date")
    out = (
        bars.groupBy(CODE, period.alias("_p"))
        .agg(
            F.min_by("open", DATE).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", DATE).alias("close"),
            F.sum("volume").alias("volume"),
            F.max_by("adj_close", DATE).alias("adj_close"),
        )
        .withColumnRenamed("_p", DATE)
        .select(BAR_COLUMNS)
    )
    return fill_bins(out, interval.upper()) if fill else out


def ohlc_columns(df: DataFrame) -> DataFrame:
    """Check that a table looks like bars and project Open, Close, High, Low.

    Accepted are exactly the four lower-case price columns or the six file headers, beside
    the key; anything else is an error.
    """
    cols = [c for c in df.columns if c not in KEY]
    reader = OHLC_HEADERS + ["Volume", "Adj Close"]
    if cols == PRICES:
        df = df.select(*KEY, *[F.col(c).alias(c.title()) for c in cols])
    elif cols != reader:
        raise ValueError("data is not ohlc-like")
    return df.select(*KEY, "Open", "Close", "High", "Low")


def quality_report(bars: DataFrame) -> DataFrame:
    """Per symbol: rows, keys used more than once, and rows that break the price order.

    Two-level aggregation: duplicates collapse per key before the per-symbol counts.
    """
    low_bad = F.col("low") > F.least("open", "close")
    high_bad = F.col("high") < F.greatest("open", "close")
    missing = F.lit(False)
    for c in VALUES:
        missing = missing | F.col(c).isNull()

    def hits(cond: Column) -> Column:
        return F.sum(F.coalesce(cond.cast("long"), F.lit(0)))

    per_key = bars.groupBy(CODE, DATE).agg(
        F.count(F.lit(1)).alias("n"),
        hits(low_bad).alias("low_bad"),
        hits(high_bad).alias("high_bad"),
        hits(missing).alias("missing"),
        hits(~is_business_day(F.col(DATE))).alias("weekend"),
    )
    return per_key.groupBy(CODE).agg(
        F.sum("n").alias("bars"),
        F.sum((F.col("n") > 1).cast("long")).alias("duplicate_keys"),
        F.sum("low_bad").alias("low_above_body"),
        F.sum("high_bad").alias("high_below_body"),
        F.sum("missing").alias("incomplete_rows"),
        F.sum("weekend").alias("weekend_rows"),
    )


def rows_from_end(df: DataFrame, k: int = 1, upto: int | None = None) -> DataFrame:
    """The k-th row from the end of every symbol (1 = last), or the rows from there to ``upto``
    with their number in ``_rd``."""
    ranked = df.withColumn("_rd", F.row_number().over(by_date(descending=True)))
    return ranked.where(F.col("_rd") == k).drop("_rd") if upto is None else ranked.where(F.col("_rd").between(k, upto))


def cell(df: DataFrame, column: str, date: str) -> DataFrame:
    """One column at one date, for every symbol that has the date."""
    return df.where(F.col(DATE) == F.lit(date).cast("date")).select(*KEY, column)


def exclude_indices(df: DataFrame) -> DataFrame:
    return df.where(~is_index(F.col(CODE)))


def fresh_only(df: DataFrame, asof: str, days: int = 10, last_date: str = "last_date") -> DataFrame:
    """Rows whose last date is at most ``days`` before ``asof``."""
    return df.where(F.col(last_date) >= F.date_sub(F.lit(asof).cast("date"), days))


def numbered(ordered: DataFrame, name: str = "rank") -> DataFrame:
    """Number the rows of an ordered table from 1, without bringing them together.

    The sorted partitions are stored once; only their numbers of rows come to the driver.
    """
    at = F.col("_at")
    stored = checkpoint(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright(at, 33)
    rows = dict(stored.groupBy(part.alias("p")).count().collect())
    offsets, total = [], 0
    for p in sorted(rows):
        offsets += [F.lit(p).cast("long"), F.lit(total).cast("long")]
        total += rows[p]
    if not offsets:
        return stored.withColumn(name, at).drop("_at")
    before = F.element_at(F.create_map(*offsets), part)
    return stored.withColumn(name, before + at - F.shiftleft(part, 33) + 1).drop("_at")


def rank(df: DataFrame, sortkey: str | None = None, ascending: bool = False, limit: int | None = None) -> DataFrame:
    """Order a per-symbol table by a column, ties by symbol; by symbol alone without a key."""
    if sortkey is None:
        out = df.orderBy(F.col(CODE).asc() if ascending else F.col(CODE).desc())
    else:
        key = F.col(sortkey)
        out = df.orderBy(key.asc_nulls_last() if ascending else key.desc_nulls_last(), F.col(CODE))
    return out if limit is None else out.limit(limit)


def last_change(bars: DataFrame) -> DataFrame:
    """Last and previous close per symbol with the change and ratio of captions."""
    w = by_date()
    prev = F.lag("adj_close").over(w)
    last = (
        bars.select(*KEY, "adj_close", prev.alias("_prev"), F.lead(DATE).over(w).alias("_next"))
        .where(F.col("_next").isNull())
        .select(CODE, DATE, truncated(F.col("adj_close")).alias("close"), truncated(F.col("_prev")).alias("previous"))
    )
    change = F.col("close") - F.col("previous")
    return last.withColumn("change", change).withColumn("ratio", change_ratio(change, F.col("close")))
