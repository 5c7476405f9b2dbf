"""Composed jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions import output_class, truncated
from barloom.operators import regressors
from barloom.operators.bars import by_date, last_bars, merge_frames, new_rows, valid_bars
from barloom.operators.classifiers import CLASSIFIERS, class_samples, classify_pooled, fit_pooled, value_samples
from barloom.operators.features import scoring_window, stored_recent
from barloom.operators.finite import ret_index
from barloom.operators.resume import (
    ROW_COLUMNS,
    VOLUME_RATE,
    enrich_resumed,
    last_only,
    next_carry,
    with_carry,
    with_row_columns,
    with_volume_rate,
)
from barloom.operators.scan import BASE
from barloom.operators.series import apply
from barloom.operators.standard import enrich
from barloom.operators.summary import ranked_summary
from barloom.schema import BAR_COLUMNS, CODE, COMPAT_RANGE, DATE, FEATURE_LENGTH, KEY, STANDARD_COLUMNS
from barloom.session import checkpoint, shuffles_freed
from barloom.sources.keyed import KeyedStore
from barloom.sources.sinks import append_snapshot, write_summary


#: Bars that an indicator of the standard set or a model looks back, at most.
LONGEST_WINDOW = 250
#: The standard columns that are stored for whole histories.
WHOLE_COLUMNS = [c for c in STANDARD_COLUMNS if c not in [*VOLUME_RATE, *ROW_COLUMNS]]


def kept_bars(bars: DataFrame, days: int) -> DataFrame:
    """The last ``days`` complete business-day bars of each symbol (0: all)."""
    return last_bars(valid_bars(bars), days)


def forecasts(
    kept: DataFrame,
    classifier: str = "Decision Tree",
    regression_type: str = "Ridge",
    alpha: float = 1.0,
    mode: str = "full",
    pooled: bool = False,
) -> DataFrame:
    """``(code, date, classified, predicted)`` for the last kept bar of every symbol.

    Symbols too short for a model get NULL instead. Training and scoring share the recent
    part of the return index, at most 135 short rows per symbol, which is stored once.
    """
    first = F.first("adj_close").over(by_date())
    if BASE in kept.columns:  # the rows are only the end of a history
        first = F.coalesce(F.col(BASE), first)
    index = valid_bars(kept).select(*KEY, F.try_divide("adj_close", first).alias("ret_index"), first.alias("base"))
    recent = stored_recent(index)
    windows = scoring_window(recent)
    samples = class_samples(recent, mode)
    if pooled:
        labels = classify_pooled(fit_pooled(samples, classifier), windows)
    else:
        kind = CLASSIFIERS[classifier]
        labels = kind.classify(kind.fit(samples), windows)
    model = regressors.fit(value_samples(recent, mode), regression_type, alpha)
    base = recent.groupBy(CODE).agg(F.max(DATE).alias(DATE), F.max("base").alias("base"))
    prices = regressors.predict(model, windows, base.select(CODE, "base"))
    return (
        base.select(*KEY)
        .join(labels.select(CODE, F.col("prediction").alias("classified")), CODE, "left")
        .join(prices.select(CODE, truncated(F.col("prediction")).alias("predicted")), CODE, "left")
    )


def analyse(
    bars: DataFrame,
    days: int = 240,
    classifier: str = "Decision Tree",
    regression_type: str = "Ridge",
    alpha: float = 1.0,
    mode: str = "full",
    pooled: bool = False,
) -> DataFrame:
    """The enriched table of all symbols: bars, indicators, and forecasts on the last bar.

    The kept bars are checkpointed once because indicators and forecasts both read them;
    without that the ticks behind ``bars`` would be scanned and shuffled again. Forecasts are
    joined by symbol before the indicators run, so the wide enriched rows never move.
    """
    kept = checkpoint(kept_bars(bars, days))
    marks = forecasts(kept, classifier, regression_type, alpha, mode, pooled)
    marks = marks.withColumnRenamed(DATE, "_last")
    at_end = F.col(DATE) == F.col("_last")
    marked = kept.join(marks, CODE, "left").select(
        *kept.columns, *[F.when(at_end, F.col(c)).alias(c) for c in ("classified", "predicted")]
    )
    enriched = enrich(marked, max_rows=days or None)
    return enriched.select(*kept.columns, *STANDARD_COLUMNS, "classified", "predicted")


def analysis_errors(kept: DataFrame) -> DataFrame:
    """Symbols whose kept history is too short for a forecast, with the reason."""
    n = F.col("bars")
    return (
        kept.groupBy(CODE)
        .agg(F.count(F.lit(1)).alias("bars"))
        .where(n < COMPAT_RANGE)
        .withColumn(
            "reason",
            F.when(n < FEATURE_LENGTH + 1, "no sample for the classifier and the regressor").otherwise(
                "no sample for the classifier"
            ),
        )
    )


def chart_classes(bars: DataFrame, days: int) -> DataFrame:
    """Chart family of each symbol for a run over ``days`` bars."""
    return bars.select(CODE).distinct().withColumn("chart", output_class(F.lit(days)))


class DailyStore(KeyedStore):
    """The tables of the daily job under one folder, see :mod:`barloom.sources.keyed`.

    ``bars``: the history, which grows by the new rows of each run. Of the others a symbol's last
    run counts: ``tail``, its last complete bars; ``enriched``, its analysed rows. A store that
    analyses whole histories keeps ``whole`` instead, analysed rows that grow like the bars, with
    ``carry``, what the next run goes on from, and ``marks``, the forecasts for the last bar.
    """

    def __init__(self, spark: SparkSession, path: str, tail: int = 600, live: int = 8):
        if tail < LONGEST_WINDOW:
            raise ValueError(f"the tail must hold the longest window, {LONGEST_WINDOW} bars")
        super().__init__(spark, path, live)
        self.tail = tail

    def history(self, run: int | None = None) -> DataFrame:
        """All stored bars, as of a run."""
        return self.all_rows("bars", run)

    def enriched(self, run: int | None = None) -> DataFrame:
        """The enriched rows of every symbol, as of a run."""
        whole = self.all_rows("whole", run)
        if whole is None:
            rows = self.current("enriched", run)
            return rows and with_row_columns(rows).select(*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted")
        whole = with_row_columns(whole.select(*BAR_COLUMNS, *WHOLE_COLUMNS))
        marks = self.to_all(self.current("marks", run).select(*KEY, "classified", "predicted"), run)
        carry = self.to_all(self.current("carry", run).select(CODE, "vmax", "top", "under"), run)
        return with_volume_rate(whole, carry).join(marks, KEY, "left")


def daily_run(store: DailyStore, landed: DataFrame, run: int, days: int = 240) -> DataFrame:
    """Append new bars and analyse the symbols that got any; returns all current enriched rows.

    New rows start after a symbol's last stored day, so they never meet a stored key and the
    history is neither read nor rewritten. A run costs the landed rows, the tails of the symbols
    that changed, one index row for each symbol, and now and then the merging of small parts.

    ``days`` bars of a symbol are analysed, up to the store's tail, or its whole history with
    ``days=0``: new bars then go on from carried values. A store keeps to one of the two. Runs
    are numbered upwards from 0; a run without news changes nothing.
    """
    if not 0 <= days <= store.tail:
        raise ValueError(f"days must be 0 or at most the store's tail, {store.tail}")
    with shuffles_freed(store.spark):
        _analysed(store, landed, run, days)
    return store.enriched()


def _analysed(store: DailyStore, landed: DataFrame, run: int, days: int) -> None:
    """Make the run's parts count."""
    index = store.index(run - 1)
    known = "whole" if days == 0 else "enriched"
    if index is not None and not store.has(known):
        raise ValueError("a store analyses either the last bars or whole histories")
    fresh = landed if index is None else new_rows(index.select(*KEY), landed)
    fresh = store.stage(run, "bars", fresh)
    if fresh.isEmpty():
        return
    changed = fresh.groupBy(CODE).agg(F.max(DATE).alias(DATE))
    tail = valid_bars(fresh)
    old = store.current("tail", run - 1)
    if old is not None:
        tail = tail.unionByName(old.join(changed.select(CODE), CODE, "left_semi"))
    if days:
        kept = store.stage(run, "tail", last_bars(tail, store.tail))
        store.stage(run, "enriched", analyse(kept, days).drop(*ROW_COLUMNS))
        keyed, growing = ["tail", "enriched"], ["bars"]
    else:
        _whole_histories(store, tail, changed, run)
        keyed, growing = ["tail", "carry", "marks"], ["bars", "whole"]
    store.commit(run, changed, keyed, growing)


def _whole_histories(store: DailyStore, bars: DataFrame, changed: DataFrame, run: int) -> None:
    """Stage what a run adds to whole histories: analysed new rows, carries and marks.

    Wide rows are written once, the new ones; what is carried stands in a symbol's last row.
    """
    carry = store.current("carry", run - 1)
    carried = with_carry(bars, carry, store.tail)
    last = F.max(DATE).over(Window.partitionBy(CODE))
    enriched = enrich_resumed(carried.withColumn("_last", last)).where("_new")
    rows = store.stage(run, "whole", enriched.select(*BAR_COLUMNS, *WHOLE_COLUMNS, *last_only("_last")))
    carries = next_carry(rows)
    if carry is not None:  # symbols whose new bars are all incomplete keep theirs
        same = carry.join(changed.select(CODE), CODE, "left_semi").join(rows.select(CODE), CODE, "left_anti")
        carries = carries.unionByName(same)
    store.stage(run, "carry", carries)
    store.stage(run, "marks", forecasts(carried.select(*BAR_COLUMNS, BASE)))
    store.stage(run, "tail", last_bars(bars.select(*BAR_COLUMNS), store.tail))


def demo(bars: DataFrame) -> DataFrame:
    """Bars joined with their return index."""
    index = apply(bars, [ret_index()]).select(*KEY, "ret_index")
    return merge_frames(bars, index)


# The reports of the scheduled job (rows back, sort key, ascending, screening key).
DAILY_REPORTS = {
    "summary": dict(span=1, sortkey="ratio", ascending=False, screening_key=None),
    "summary_10": dict(span=10, sortkey="ratio", ascending=False, screening_key=None),
    "portfolio": dict(span=1, sortkey="ratio", ascending=False, screening_key=None),
    "screening_rsi9": dict(span=1, sortkey="ratio", ascending=False, screening_key="rsi9"),
    "screening_rsi14": dict(span=1, sortkey="rsi14", ascending=True, screening_key="rsi14"),
}


def write_reports(
    enriched: DataFrame, lists: dict[str, DataFrame], default_list: DataFrame, asof: str, out: str
) -> None:
    """All reports of the scheduled job; the first also keeps a dated copy."""
    for name, options in DAILY_REPORTS.items():
        report = ranked_summary(enriched, lists.get(name, default_list), asof, **options)
        write_summary(report, f"{out}/{name}")
        if name == "summary":
            append_snapshot(report, f"{out}/history", asof)
