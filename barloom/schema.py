"""Column names, explicit schemas and fixed values of the data model.

Every table of bars is keyed by ``(code, date)`` and holds at most one row per symbol and
calendar day. That grain is what bounds each per-symbol window: a century is about 36,500 rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

CODE, DATE = "code", "date"
KEY = [CODE, DATE]
PRICES = ["open", "high", "low", "close"]
VALUES = ["open", "high", "low", "close", "volume", "adj_close"]
BAR_COLUMNS = KEY + VALUES

# The four market indices that are not exchange-listed codes.
INDEX_CODES = ("N225", "GSPC", "IXIC", "DJI")

# Length of a feature window, and the longest history used for training.
FEATURE_LENGTH = 14
TRAIN_RANGE_CAP = 135
COMPAT_RANGE = 16

# Headers of the price-history files.
CSV_HEADERS = ["Date", "Open", "High", "Low", "Close", "Volume", "Adj Close"]
OHLC_HEADERS = ["Open", "High", "Low", "Close"]

BARS = T.StructType(
    [T.StructField(CODE, T.StringType()), T.StructField(DATE, T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in VALUES]
)

PRICE_FILE = T.StructType(
    [T.StructField("Date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in CSV_HEADERS[1:]]
)

RAW_FILE = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in CSV_HEADERS[1:]]
)

SYMBOLS = T.StructType(
    [
        T.StructField(CODE, T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("fullname", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("group", T.StringType()),
    ]
)

# Column order of the enriched table after the bars.
STANDARD_COLUMNS = [
    "sma5", "sma25", "sma50", "sma75", "sma200",
    "ewma5", "ewma25", "ewma50", "ewma75", "ewma200",
    "upperband", "middleband", "lowerband", "sar", "ret_index", "vol",
    "rsi9", "rsi14", "mfi14", "roc10", "roc25", "roc50", "roc75", "roc150",
    "cci14", "ultosc", "slowk", "slowd", "fastk", "fastd",
    "macd", "macdsignal", "macdhist", "willr14", "mom10", "mom25",
    "tr", "vl", "atr", "natr", "v_rate", "v_rate_p",
]
