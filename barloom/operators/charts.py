"""Chart-ready tables: the series a chart shows, and its caption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import change_ratio, display_name, signed_text, thousands, trend_arrow, truncated
from barloom.operators.bars import by_date
from barloom.schema import CODE, DATE


def series_for(axis: int = 2, complexity: int = 3) -> list[tuple[str, str, str, float, float]]:
    """``(panel, series, column, factor, offset)`` shown at a level of detail.

    Oscillators are scaled for a common 0..100 axis here only; stored tables stay unscaled.
    """
    price, osc = "price", "oscillator"
    show = [(price, c, c, 1.0, 0.0) for c in ("open", "high", "low", "close")]
    show += [(price, c, c, 1.0, 0.0) for c in ("ewma25", "ewma50", "ewma75")]
    if complexity >= 2:
        show += [(price, "ewma5", "ewma5", 1.0, 0.0), (price, "sar", "sar", 1.0, 0.0)]
    else:
        show += [(price, "ewma200", "ewma200", 1.0, 0.0)]
    if complexity >= 3:
        show += [(price, c, c, 1.0, 0.0) for c in ("upperband", "lowerband")]
    if axis == 1:
        show += [(price, "v_rate_p", "v_rate_p", 1.0, 0.0)]
    if axis >= 2:
        show += [(osc, c, c, 1.0, 0.0) for c in ("rsi9", "rsi14", "v_rate")]
        show += [(osc, "vl", "vl", 5.0, 0.0)]
        if complexity >= 2:
            show += [(osc, c, c, 1.0, 0.0) for c in ("mfi14", "ultosc", "slowk", "slowd")]
        if complexity >= 3:
            show += [(osc, c, c, 1.0, 50.0) for c in ("roc10", "roc25")]
            show += [(osc, "willr14", "willr14", 1.0, 100.0)]
    return show


def chart_series(enriched: DataFrame, axis: int = 2, complexity: int = 3) -> DataFrame:
    """Long table ``(code, date, panel, series, value)``; a narrow expansion without shuffle."""
    points = [
        F.struct(
            F.lit(panel).alias("panel"),
            F.lit(series).alias("series"),
            (F.col(column) * factor + offset).alias("value"),
        )
        for panel, series, column, factor, offset in series_for(axis, complexity)
    ]
    return (
        enriched.select(CODE, DATE, F.explode(F.array(*points)).alias("_p"))
        .select(CODE, DATE, "_p.panel", "_p.series", "_p.value")
        .where(F.col("value").isNotNull())
    )


def chart_caption(enriched: DataFrame, symbols: DataFrame | None = None, asof: str | None = None) -> DataFrame:
    """Figures and the text under each chart; the grouping reuses the window's shuffle."""
    prev = F.lag("adj_close").over(by_date())
    last = F.struct(DATE, "adj_close", "_prev", "volume", "classified", "predicted")
    base = enriched.withColumn("_prev", prev).groupBy(CODE).agg(
        F.max_by(last, DATE).alias("_last"), F.max("high").alias("_high"), F.min("low").alias("_low")
    )
    close, prev = truncated(F.col("_last.adj_close")), truncated(F.col("_last._prev"))
    change = close - prev
    out = base.select(
        CODE,
        F.col("_last.date").alias("last_date"),
        truncated(F.col("_last.volume")).alias("volume"),
        close.alias("close"),
        change.alias("change"),
        change_ratio(change, close).alias("ratio"),
        truncated(F.col("_high")).alias("highest"),
        truncated(F.col("_low")).alias("lowest"),
        trend_arrow(F.col("_last.classified")).alias("trend"),
        truncated(F.col("_last.predicted")).alias("pred"),
    )
    if symbols is not None:
        names = symbols.groupBy(CODE).agg(F.min_by(display_name(F.col("name"), F.col("fullname")), "name").alias("title"))
        out = out.join(names, CODE, "left")
    else:
        out = out.withColumn("title", F.col(CODE))
    day = F.lit(asof).cast("date") if asof else F.col("last_date")
    # The caption's labels and their order.
    text = F.concat(
        F.coalesce("title", CODE), F.lit("("), F.col(CODE), F.lit(")  "), F.date_format(day, "yyyy/MM/dd"),
        F.lit("\n終値:"), thousands(F.col("close")),
        F.lit(" ("), F.coalesce(signed_text(F.col("change")), F.lit("")), F.lit(", "),
        F.coalesce(F.col("ratio").cast("string"), F.lit("")), F.lit("%)\n"),
        F.lit(" 出来高:"), thousands(F.col("volume")),
        F.lit(" 最高:"), thousands(F.col("highest")),
        F.lit(" 最安:"), thousands(F.col("lowest")),
        F.lit(" 分類器予測:"), F.coalesce("trend", F.lit("")),
        F.lit(" 回帰分析:"), F.coalesce(thousands(F.col("pred")), F.lit("")),
    )
    return out.withColumn("caption", text)

