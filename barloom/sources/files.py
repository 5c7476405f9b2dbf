"""File readers. Schemas are explicit: nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barloom.functions import clean, local_date
from barloom.operators.bars import business_day_align
from barloom.schema import BAR_COLUMNS, CODE, DATE, PRICE_FILE, RAW_FILE, SYMBOLS, VALUES


def _code_from_name(prefix: str):
    return F.regexp_extract(F.col("_metadata.file_name"), rf"^{prefix}(.+?)\.csv", 1)


def _to_bars(df: DataFrame, code, date) -> DataFrame:
    return df.select(
        code.alias(CODE),
        date.alias(DATE),
        *[clean(F.col(h)).alias(v) for h, v in zip(["Open", "High", "Low", "Close", "Volume", "Adj Close"], VALUES)],
    )


def read_price_csv(spark: SparkSession, path: str | list[str], prefix: str = "stock_", folder: bool = False) -> DataFrame:
    """Price histories named ``<prefix><code>.csv``; ``path`` may be a glob over all symbols.

    With ``folder`` it is the folder that holds them. A folder is listed in one call, whereas
    every file that a glob finds is listed again by itself.
    """
    reader = spark.read.option("pathGlobFilter", f"{prefix}*.csv") if folder else spark.read
    raw = (
        reader.schema(PRICE_FILE)
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("enforceSchema", False)
        .csv(path)
    )
    return _to_bars(raw, _code_from_name(prefix), F.col("Date"))


def read_exported(spark: SparkSession, path: str) -> DataFrame:
    """Bars exported as text with one directory per symbol."""
    schema = StructType([*PRICE_FILE.fields, StructField(CODE, StringType())])
    raw = spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return _to_bars(raw, F.col(CODE), F.col("Date"))


def read_raw_history(spark: SparkSession, path: str | list[str], prefix: str = "raw_") -> DataFrame:
    """Landed raw pages: seven columns by position, dates in the 2015年3月20日 form."""
    raw = spark.read.schema(RAW_FILE).option("header", True).csv(path)
    return normalise_raw(raw.withColumn(CODE, _code_from_name(prefix)))


def normalise_raw(raw: DataFrame) -> DataFrame:
    """Rename, parse and align raw rows ``(7 columns in file order, code)``."""
    named = raw.toDF("Date", "Open", "High", "Low", "Close", "Volume", "Adj Close", CODE)
    return business_day_align(_to_bars(named, F.col(CODE), local_date(F.col("Date"))))


def read_symbols(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Stock list without header; missing trailing fields become NULL, codes stay text."""
    df = (
        spark.read.schema(SYMBOLS)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return df.where(F.col(CODE).isNotNull())


def concat_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """All result pages as one table; columns match by name."""
    return reduce(lambda a, b: a.unionByName(b), pages)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars written by :func:`barloom.sources.sinks.write_table`."""
    return spark.read.parquet(path).withColumn(CODE, F.col(CODE).cast("string")).select(BAR_COLUMNS)


def read_enriched(spark: SparkSession, path: str, symbols: DataFrame) -> DataFrame:
    """Enriched rows of the listed symbols, with their names; absent symbols are skipped. A symbol
    listed twice keeps one name, the first in text order, as in the reports."""
    ti = spark.read.parquet(path).withColumn(CODE, F.col(CODE).cast("string"))
    return ti.join(symbols.groupBy(CODE).agg(F.min("name").alias("name")), CODE, "inner")


def missing_history(symbols: DataFrame, bars: DataFrame) -> DataFrame:
    """Listed symbols without any bar: the ones to fetch from scratch."""
    return symbols.join(bars.select(CODE).distinct(), CODE, "left_anti")


def date_range(bars: DataFrame, asof: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows between ``start`` (default: 365 days before ``asof``) and ``end`` (default ``asof``)."""
    day = F.lit(asof).cast("date")
    lo = F.lit(start).cast("date") if start else F.date_sub(day, 365)
    hi = F.lit(end).cast("date") if end else day
    return bars.where(F.col(DATE).between(lo, hi))
