"""Every operator as a query over the given tables.

Outputs are cut to steps of 1/10,000 so that two engines can be compared by value; the operators themselves
return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import functions as fn
from barloom.operators import bars as tb
from barloom.operators import charts, finite, recursive, regressors, stochastics, summary
from barloom.operators import features as feat
from barloom.operators.classifiers import CLASSIFIERS, ModelStore, class_samples, value_samples
from barloom.operators.sar import sar
from barloom.operators.series import apply
from barloom.operators.standard import enrich
from barloom.plans import analysis
from barloom.schema import BAR_COLUMNS, CODE, CSV_HEADERS, DATE, INDEX_CODES, KEY, STANDARD_COLUMNS, VALUES
from barloom.session import CODEC, checkpoint, remove, scratch_path, stored, unstore
from barloom.sources import files, sinks, ticks
from barloom.streaming.bars import stream_bars
from barloom.streaming.recursive import row_store, stream_indicators
from barloom.streaming.upsert import read_upserted, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

# The runs below use fixed days so that results do not depend on the clock.
ASOF = "2001-11-04"
SPLIT = "2000-01-01"
EVENT_ASOF = "2024-01-20"
STREAM_CUTS = ("1998-09-01", "1999-04-01", SPLIT, "2000-11-01")


# Values are compared in steps of 1/SCALE. The offset of the steps is no simple fraction, so
# exact prices never lie on a step's edge, where the last bit would decide.
SCALE = 10_000
OFFSET = 0.41421356
# Columns around 1 that are one division away from the prices are compared in steps of 1/FINE.
FINE = 100_000_000
FINE_COLUMNS = ("ret_index", "oldest", "newest", "label")


def rounded(df: DataFrame) -> DataFrame:
    def cut(n: str):
        scale = float(FINE if n in FINE_COLUMNS else SCALE)
        return (F.floor(F.col(n) * scale + OFFSET) / scale).alias(n)

    return df.select(*[cut(n) if k == "double" else F.col(n) for n, k in df.dtypes])


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return ticks.lineitem_bars(spark, sf)


def _stored_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The bars, made once for jobs of several runs."""
    return stored(_bars(spark, sf))


def _event_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return ticks.event_ticks(spark.read.parquet(f"{sf}/events.parquet"))


def _symbols(spark: SparkSession, sf: str) -> DataFrame:
    return ticks.supplier_symbols(spark, sf)


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    """The suppliers and the four market indices, which have no bars here."""
    s = _symbols(spark, sf)
    rows = F.explode(F.array(*[F.lit(c) for c in INDEX_CODES]))
    nulls = [F.lit(None).cast("string").alias(c) for c in ("fullname", "sector", "group")]
    indices = spark.range(1).select(rows.alias(CODE)).select(CODE, F.col(CODE).alias("name"), *nulls)
    return s.unionByName(indices)


def _indicator(*make) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        made = [m() for m in make]
        out = apply(_bars(spark, sf), made)
        return rounded(out.select(*KEY, *[o for i in made for o in i.outputs]))

    return run


def _averaged(kind: int) -> Query:
    """Both stochastics smoothed by one type of average."""
    return _indicator(lambda: stochastics.stoch(5, 4, kind, 3, kind), lambda: stochastics.stochf(5, 6, kind))


def _on_bars(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: rounded(f(_bars(spark, sf)))


def _halves(spark: SparkSession, sf: str, made: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A stored history with gaps, and a landed one that covers everything at other prices."""
    b = _bars(spark, sf) if made is None else made
    old = b.where(F.col(DATE) < F.lit(SPLIT).cast("date")).withColumn(
        "volume", F.when(F.col("volume") <= 40, F.col("volume"))
    )
    new = b.select(*KEY, *[(F.col(c) * 2.0).alias(c) for c in VALUES])
    return old, new


def _upsert(spark, sf):
    return rounded(tb.upsert(*_halves(spark, sf)))


def _new_rows(spark, sf):
    return rounded(tb.new_rows(*_halves(spark, sf)))


def _changed(spark, sf):
    return tb.changed_codes(*_halves(spark, sf))


def _store_round_trip(spark, sf):
    path = scratch_path(spark, "history")
    sinks.write_table(_bars(spark, sf), path)
    return rounded(files.read_bars(spark, path))


def _text_round_trip(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_summary(_summary()(spark, sf), path)
    back = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False).schema(
        "Code string, Open long, High long, Low long, Close long, Change long, Ratio double, rsi14 long, Name string"
    )
    out = back.csv(path)
    return out.toDF(*[c.lower() for c in out.columns])


def _price_csv_round_trip(spark, sf):
    path = scratch_path(spark, "prices")
    sinks.export_price_files(_bars(spark, sf), path)
    return rounded(files.read_price_csv(spark, path, folder=True))


def _exported_round_trip(spark, sf):
    path = scratch_path(spark, "prices")
    sinks.export_csv(_bars(spark, sf), path)
    return rounded(files.read_exported(spark, path))


def _symbol_list_round_trip(spark, sf):
    path = scratch_path(spark, "symbols")
    sinks.write_symbols(_symbols(spark, sf), path)
    return files.read_symbols(spark, path)


def _snapshots(spark, sf):
    path = scratch_path(spark, "snapshots")
    report = _summary()(spark, sf)
    for day in (SPLIT, ASOF, ASOF):
        sinks.append_snapshot(report, path, day)
    return spark.read.parquet(path).select("snapshot_date", CODE, "close", "ratio")


def _raw_history(spark, sf):
    b = _bars(spark, sf)
    local = F.concat(F.year(DATE), F.lit("年"), F.month(DATE), F.lit("月"), F.dayofmonth(DATE), F.lit("日"))
    raw = b.select(local.alias("Date"), *[F.col(c).alias(h) for c, h in zip(VALUES, CSV_HEADERS[1:])], CODE)
    pages = [raw.where(F.col("Volume") <= 25), raw.where(F.col("Volume") > 25)]
    return rounded(files.normalise_raw(files.concat_pages(pages)))


def _routing(spark, sf):
    return _listed(spark, sf).select(CODE, fn.is_index(F.col(CODE)).alias("is_index"))


def _not_indices(spark, sf):
    return tb.exclude_indices(_listed(spark, sf)).select(CODE, "name")


def _missing(spark, sf):
    return files.missing_history(_listed(spark, sf), _bars(spark, sf)).select(CODE, "name")


def _display_names(spark, sf):
    s = _listed(spark, sf).withColumn("fullname", F.when(fn.is_index(F.col(CODE)), F.lit("")).otherwise(F.concat("name", F.lit(" K.K."))))
    return s.select(CODE, fn.display_name(F.col("name"), F.col("fullname")).alias("title"))


def _listed_rows(spark, sf):
    path = scratch_path(spark, "enriched")
    sinks.write_table(apply(_bars(spark, sf), [finite.ret_index()]), path)
    listed = _listed(spark, sf)
    twice = listed.withColumn("name", F.concat(F.lit("A second "), F.col("name"))).where(F.expr("try_cast(code as int) % 2 = 0"))
    return rounded(files.read_enriched(spark, path, listed.unionByName(twice)).select(*KEY, "ret_index", "name"))


def _fresh(spark, sf):
    return tb.fresh_only(tb.high_water(_bars(spark, sf)), ASOF).select(CODE, "last_date")


def _summary_input(spark, sf):
    kept = analysis.kept_bars(_bars(spark, sf), 240)
    made = [recursive.rsi(9), recursive.rsi(14)]
    return apply(kept, made, max_rows=240)


def _summary(span=1, sortkey="ratio", ascending=False, screening_key="rsi14", limit=None) -> Query:
    def run(spark, sf):
        return summary.ranked_summary(
            _summary_input(spark, sf), _symbols(spark, sf), ASOF, span, sortkey, ascending, screening_key, limit
        )

    return run


def _ranked(query: Query) -> Query:
    """A report with the place of each row."""
    return lambda spark, sf: rounded(tb.numbered(query(spark, sf)))


def _full_summary(spark, sf):
    kept = checkpoint(analysis.kept_bars(_bars(spark, sf), 240))
    marks = analysis.forecasts(kept, classifier="Gaussian Naive Bayes")
    table = kept.join(marks, KEY, "left")
    return summary.ranked_summary(table, _symbols(spark, sf), ASOF)


def _caption(spark, sf):
    kept = checkpoint(analysis.kept_bars(_bars(spark, sf), 240))
    marks = analysis.forecasts(kept, classifier="Gaussian Naive Bayes")
    return rounded(charts.chart_caption(kept.join(marks, KEY, "left"), _symbols(spark, sf), ASOF))


def _chart(axis: int, complexity: int, days: int) -> Query:
    def run(spark, sf):
        return rounded(charts.chart_series(enrich(analysis.kept_bars(_bars(spark, sf), days), days), axis, complexity))

    return run


def _chart_families(spark, sf):
    b = _bars(spark, sf)
    runs = [analysis.chart_classes(b, d).withColumn("days", F.lit(d)) for d in (240, 600, 60, 0)]
    return files.concat_pages(runs)


def _last_cells(spark, sf):
    two = tb.rows_from_end(tb.valid_bars(_bars(spark, sf)), 1, 2)
    at = lambda k, c: F.max(F.when(F.col("_rd") == k, F.col(c)))
    cells = {"last_date": at(1, DATE), "last_close": at(1, "adj_close"), "previous_date": at(2, DATE), "previous_close": at(2, "adj_close")}
    return rounded(two.groupBy(CODE).agg(*[c.alias(n) for n, c in cells.items()]).where(F.col("previous_date").isNotNull()))


def _cell(spark, sf):
    return rounded(tb.cell(_bars(spark, sf), "adj_close", "2000-03-01"))


def _ohlc_columns(spark, sf):
    out = tb.ohlc_columns(ticks.resample_ticks(_event_ticks(spark, sf)))
    return rounded(out.toDF(*[c.lower() for c in out.columns]))


def _quality(spark, sf):
    b = _bars(spark, sf)
    # Landed twice for large volumes, and with a broken low for some rows.
    again = b.where(F.col("volume") > 60)
    broken = b.withColumn("low", F.when(F.col("volume") > 80, F.col("high") * 2).otherwise(F.col("low")))
    broken = broken.withColumn("adj_close", F.when(F.col("volume") <= 70, F.col("adj_close")))
    return tb.quality_report(broken.unionByName(again))


def _short_history_errors(spark, sf):
    b = analysis.kept_bars(ticks.resample_ticks(_event_ticks(spark, sf), "W").withColumns({"volume": F.lit(1.0), "adj_close": F.col("close")}).select(BAR_COLUMNS), 0)
    return analysis.analysis_errors(b)


def _rolling_corr(spark, sf):
    # The first supplier stands in for a market index. The filter is on the key's own type, so
    # that the scan for the reference can skip row groups.
    b = tb.business_day_align(_bars(spark, sf))
    reference = tb.business_day_align(ticks.lineitem_bars(spark, sf, F.col("l_suppkey") == 0)).select(DATE, "adj_close")
    return rounded(finite.rolling_corr(b, reference).select(*KEY, "rolling_corr"))


def _index(spark, sf):
    return apply(_bars(spark, sf), [finite.ret_index()])


def _class_samples(spark, sf):
    return _round_features(class_samples(_index(spark, sf)))


def _class_samples_90(spark, sf):
    return _round_features(feat.binary_class(_index(spark, sf), 90))


def _value_samples(spark, sf):
    return _round_features(value_samples(_index(spark, sf)))


def _scoring(spark, sf):
    return _round_features(feat.scoring_window(_index(spark, sf)))


def _round_features(df: DataFrame) -> DataFrame:
    """Feature arrays as their sum and corner values, which compare across engines."""
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x)
    extra = [c for c in df.columns if c not in (CODE, DATE, "features")]
    return rounded(
        df.select(
            *KEY,
            F.size("features").alias("n"),
            F.element_at("features", 1).alias("oldest"),
            F.element_at("features", -1).alias("newest"),
            total.alias("total"),
            *extra,
        )
    )


def _regression(kind: str, alpha: float = 1.0, mode: str = "full") -> Query:
    def run(spark, sf):
        b = tb.valid_bars(_bars(spark, sf))
        first = F.first("adj_close").over(tb.by_date())
        recent = feat.stored_recent(
            b.select(*KEY, (F.col("adj_close") / first).alias("ret_index"), first.alias("base"))
        )
        model = regressors.fit(value_samples(recent, mode), kind, alpha)
        base = recent.groupBy(CODE).agg(F.max("base").alias("base"))
        return rounded(regressors.predict(model, feat.scoring_window(recent), base))

    return run


def _classifier(name: str, mode: str = "full") -> Query:
    def run(spark, sf):
        recent = feat.stored_recent(_index(spark, sf).select(*KEY, "ret_index"))
        kind = CLASSIFIERS[name]
        return kind.classify(kind.fit(class_samples(recent, mode)), feat.scoring_window(recent))

    return run


def _stored_model(spark, sf):
    from barloom.operators.classifiers import load_model, save_model

    recent = feat.stored_recent(_index(spark, sf).select(*KEY, "ret_index"))
    path = scratch_path(spark, "model")
    kind = CLASSIFIERS["Gaussian Naive Bayes"]
    save_model(kind.fit(class_samples(recent)), path)
    return kind.classify(load_model(spark, path), feat.scoring_window(recent))


def _models_by_run(spark, sf):
    """Models of all symbols after a first history, then of two thirds after more bars; all are used.

    A symbol without news has no newer bars either, so its first model is its right one.
    """
    bars, store = _stored_bars(spark, sf), ModelStore(spark, scratch_path(spark, "models"))
    early, third = F.col(DATE) < F.lit(SPLIT).cast("date"), F.col(CODE).cast("int") % 3 != 0
    bayes = CLASSIFIERS["Gaussian Naive Bayes"]
    windows = []
    for run, rows in enumerate((bars.where(early), bars.where(third)), 1):
        recent = feat.stored_recent(apply(rows, [finite.ret_index()]).select(*KEY, "ret_index"))
        store.save("Gaussian Naive Bayes", bayes.fit(class_samples(recent)), run)
        store.save("Ridge", regressors.fit(value_samples(recent)), run)
        windows.append(feat.scoring_window(recent))
    now = checkpoint(windows[0].where(~third).unionByName(windows[1]))
    up = bayes.classify(store.load("Gaussian Naive Bayes"), now)
    value = regressors.predict(store.load("Ridge"), now).withColumnRenamed("prediction", "value")
    return rounded(up.join(value, KEY))


def _enriched(spark, sf):
    return rounded(enrich(_bars(spark, sf)).select(*KEY, *STANDARD_COLUMNS))


def _analysed(spark, sf):
    out = analysis.analyse(_bars(spark, sf), 240)
    return rounded(out.select(*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted"))


def _daily(spark: SparkSession, sf: str, days: int = 240) -> analysis.DailyStore:
    """Three runs: a first history, news for two thirds of the symbols, and no news.

    What lands again of the stored days has other prices, which must not count.
    """
    bars = _stored_bars(spark, sf)
    early = F.col(DATE) < F.lit(SPLIT).cast("date")
    store = analysis.DailyStore(spark, scratch_path(spark, "daily"))
    again = bars.where(F.col(CODE).cast("int") % 3 != 0).select(*KEY, *[F.when(early, F.col(c) * 2.0).otherwise(F.col(c)).alias(c) for c in VALUES])
    analysis.daily_run(store, bars.where(early), 1, days)
    analysis.daily_run(store, again, 2, days)
    analysis.daily_run(store, again, 3, days)
    unstore(bars)
    return store


def _daily_history(spark, sf):
    return rounded(_daily(spark, sf).history().select(BAR_COLUMNS))


def _daily_enriched(spark, sf):
    out = _daily(spark, sf).enriched()
    return rounded(out.select(*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted"))


def _daily_whole(spark, sf):
    """The same three runs over whole histories, with a tail shorter than they are."""
    bars = _stored_bars(spark, sf)
    store = analysis.DailyStore(spark, scratch_path(spark, "daily"), tail=analysis.LONGEST_WINDOW)
    day, third = F.col(DATE), F.col(CODE).cast("int") % 3 != 0
    for run, cut in enumerate(("2000-06-01", "2000-06-20", "2001-03-01", "9999-12-31"), 1):
        landed = bars.where((day < F.lit(cut).cast("date")) & (third | F.lit(run in (1, 4))))
        analysis.daily_run(store, landed, run, days=0)
    unstore(bars)
    return rounded(store.enriched().select(*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted"))


def _daily_earlier(spark, sf):
    """The rows as they were after the first run."""
    return rounded(_daily(spark, sf).enriched(run=1).select(*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted"))


def _demo(spark, sf):
    return rounded(analysis.demo(tb.valid_bars(_bars(spark, sf))))


def _resampled(freq: str) -> Query:
    return lambda spark, sf: rounded(ticks.resample_ticks(_event_ticks(spark, sf), freq))


def _resampled_filled(freq: str) -> Query:
    """Ticks of single users, which leave bins empty."""

    def run(spark, sf):
        events = spark.read.parquet(f"{sf}/events.parquet").withColumn("event_type", F.col("user_id").cast("string"))
        return rounded(ticks.resample_ticks(ticks.event_ticks(events), freq, fill=True))

    return run


def _periods_filled(interval: str) -> Query:
    """Bars of large volumes only, which leave weeks and months empty."""
    return _on_bars(lambda b: tb.resample_bars(b.where(F.col("volume") >= 49), interval, fill=True))


def _bucketed(spark, sf):
    """Indicators of a table bucketed by symbol, joined with its bars."""
    path = scratch_path(spark, "bucketed")
    table = sinks.save_bucketed(_bars(spark, sf), path.rsplit("/", 1)[-1].replace("-", "_"), path, 8)
    made = apply(table, [finite.sma(25), recursive.rsi(14)]).select(*KEY, "sma25", "rsi14")
    return rounded(tb.merge_frames(table, made))


def _tick_range(spark, sf):
    b = ticks.resample_ticks(_event_ticks(spark, sf))
    return rounded(files.date_range(b, EVENT_ASOF, start="2024-01-08"))


def _year_range(spark, sf):
    return rounded(files.date_range(_bars(spark, sf), ASOF))


def _streamed_bars(spark, sf):
    source = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    path = scratch_path(spark, "stream")
    bars = stream_bars(ticks.event_ticks(stream))
    query = (
        bars.writeStream.format("parquet")
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return rounded(spark.read.schema(bars.schema).parquet(f"{path}/out"))


def _landed(spark, path: str, schema) -> DataFrame:
    """A stream of the bar files under ``path``; all that landed since the last start are one batch."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def _streamed_upsert(spark, sf):
    """Three batches with common keys: cells that are null at first, and other prices later, which must not count."""
    bars = _stored_bars(spark, sf)
    old, new = _halves(spark, sf, bars)
    third = new.select(*KEY, *[(F.col(c) * 1.5).alias(c) for c in VALUES])
    path = scratch_path(spark, "upsert")
    for i, part in enumerate([old, new.where(F.col(CODE).cast("int") % 2 == 1), third]):
        if i:
            remove(spark, f"{path}/in/{i - 1}")  # all of it is in the table; the newest stays
        part.write.parquet(f"{path}/in/{i}", compression=CODEC)
        if part is third:
            unstore(bars)
        stream_upsert(_landed(spark, f"{path}/in", old.schema), f"{path}/table", f"{path}/state").awaitTermination()
    return rounded(read_upserted(spark, f"{path}/table"))


def _pieces(bars: DataFrame) -> list[DataFrame]:
    """The bars in five pieces by date; the days before each cut land again at other prices."""
    day = F.col(DATE)
    cuts = [F.lit(c).cast("date") for c in STREAM_CUTS]
    pieces = [bars.where(day < cuts[0])]
    for lo, hi in zip(cuts, [*cuts[1:], F.lit("9999-12-31").cast("date")], strict=True):
        again = bars.where((day < lo) & (day >= F.date_sub(lo, 40)))
        again = again.select(*KEY, *[(F.col(c) * 2.0).alias(c) for c in VALUES])
        pieces.append(bars.where((day >= lo) & (day < hi)).unionByName(again))
    return pieces


def _streamed_indicators(stored_pieces: int = 0) -> Query:
    """Each piece lands, and the stream starts anew from its state; the first ones may be stored bars instead."""

    def run(spark, sf):
        path, pieces = scratch_path(spark, "indicators"), _pieces(_stored_bars(spark, sf))
        stored = files.concat_pages(pieces[:stored_pieces]).dropDuplicates(KEY) if stored_pieces else None
        for i, piece in enumerate(pieces[stored_pieces:]):
            piece.write.parquet(f"{path}/in/{i}")
            out = stream_indicators(_landed(spark, f"{path}/in", piece.schema), stored=stored)
            with row_store(spark):
                query = (
                    out.writeStream.format("parquet")
                    .option("path", f"{path}/out")
                    .option("checkpointLocation", f"{path}/state")
                    .trigger(availableNow=True)
                    .start()
                )
                query.awaitTermination()
        return rounded(spark.read.schema(out.schema).parquet(f"{path}/out"))

    return run


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks to bars, indicators and the ranked report, end to end."""
    kept = analysis.kept_bars(_bars(spark, sf), 240)
    table = apply(kept, [finite.sma(25), finite.roc(10), finite.ret_index(), recursive.rsi(14)], max_rows=240)
    return rounded(summary.ranked_summary(table, _symbols(spark, sf), ASOF, screening_key="rsi14"))


QUERIES: dict[str, Query] = {
    "flagship_report": flagship,
    # sources and sinks
    "bars_from_ticks": _on_bars(lambda b: b),
    "history_round_trip": _store_round_trip,
    "price_csv_round_trip": _price_csv_round_trip,
    "exported_round_trip": _exported_round_trip,
    "bucketed_indicators": _bucketed,
    "symbol_list_round_trip": _symbol_list_round_trip,
    "report_round_trip": _text_round_trip,
    "report_snapshots": _snapshots,
    "raw_history": _raw_history,
    "date_range_default": _year_range,
    "date_range_given": _tick_range,
    "code_routing": _routing,
    "missing_history": _missing,
    "listed_enriched": _listed_rows,
    # table operators
    "business_day_align": _on_bars(tb.business_day_align),
    "valid_bars": _on_bars(tb.valid_bars),
    "drop_incomplete": lambda spark, sf: rounded(tb.drop_incomplete(_halves(spark, sf)[0])),
    "last_240_bars": _on_bars(lambda b: analysis.kept_bars(b, 240)),
    "upsert_cells": _upsert,
    "next_business_day": _on_bars(tb.high_water),
    "new_rows": _new_rows,
    "changed_codes": _changed,
    "resample_ticks": _resampled("B"),
    "resample_ticks_weekly": _resampled("W"),
    "resample_ticks_filled": _resampled_filled("B"),
    "resample_ticks_daily_filled": _resampled_filled("D"),
    "resample_ticks_weekly_filled": _resampled_filled("W"),
    "resample_weekly_filled": _periods_filled("w"),
    "resample_monthly_filled": _periods_filled("m"),
    "resample_weekly": _on_bars(lambda b: tb.resample_bars(b, "w")),
    "resample_monthly": _on_bars(lambda b: tb.resample_bars(b, "m")),
    "ohlc_columns": _ohlc_columns,
    "quality_report": _quality,
    "last_cells": _last_cells,
    "cell_lookup": _cell,
    "exclude_indices": _not_indices,
    "fresh_symbols": _fresh,
    "last_change": _on_bars(lambda b: tb.last_change(tb.valid_bars(b))),
    "display_names": _display_names,
    "chart_families": _chart_families,
    "short_history_errors": _short_history_errors,
    # reports
    "summary": _ranked(_full_summary),
    "summary_10": _ranked(_summary(span=10)),
    "screening_rsi9": _ranked(_summary(screening_key="rsi9")),
    "screening_rsi14": _ranked(_summary(sortkey="rsi14", ascending=True)),
    "ranking_top20": _ranked(_summary(limit=20)),
    "chart_series_main": _chart(2, 3, 240),
    "chart_series_long": _chart(1, 1, 600),
    "chart_series_price": _chart(1, 3, 240),
    "chart_series_plain": _chart(2, 1, 240),
    "chart_series_short": _chart(2, 2, 60),
    "chart_caption": _caption,
    # indicators
    "sma": _indicator(*[lambda n=n: finite.sma(n) for n in (5, 25, 50, 75, 200)]),
    "ewma": _indicator(*[lambda n=n: recursive.ewma(n) for n in (5, 25, 50, 75, 200)]),
    "rsi": _indicator(lambda: recursive.rsi(9), lambda: recursive.rsi(14)),
    "mfi": _indicator(finite.mfi),
    "roc": _indicator(*[lambda n=n: finite.roc(n) for n in (10, 25, 50, 75, 150)]),
    "cci": _indicator(finite.cci),
    "ultosc": _indicator(finite.ultosc),
    "stoch": _indicator(stochastics.stoch),
    "stochf": _indicator(stochastics.stochf),
    **{f"stoch_average_{t}": _averaged(t) for t in stochastics.TYPES if t},
    "stoch_average_mixed": _indicator(lambda: stochastics.stoch(5, 3, stochastics.WEIGHTED, 5, stochastics.ADAPTIVE)),
    "macd": _indicator(recursive.macd),
    "mom": _indicator(lambda: finite.mom(10), lambda: finite.mom(25)),
    "bbands": _indicator(recursive.bbands),
    "sar": _indicator(sar),
    "willr": _indicator(finite.willr),
    "tr": _indicator(finite.tr),
    "atr": _indicator(recursive.atr),
    "natr": _indicator(recursive.natr),
    "ret_index": _indicator(finite.ret_index),
    "vol": _indicator(finite.vol),
    "volume_rate": _indicator(finite.volume_rate),
    "rolling_corr": _rolling_corr,
    # features and models
    "binary_class": _class_samples,
    "binary_class_90": _class_samples_90,
    "proportion_class": _value_samples,
    "scoring_window": _scoring,
    "ridge": _regression("Ridge"),
    "ridge_compat_last": _regression("Ridge", mode="compat_last"),
    "lasso": _regression("Lasso"),
    "lasso_small_penalty": _regression("Lasso", alpha=0.001),
    "lasso_large_penalty": _regression("Lasso", alpha=1e9),
    "decision_tree": _classifier("Decision Tree"),
    "decision_tree_compat_last": _classifier("Decision Tree", mode="compat_last"),
    "random_forest": _classifier("Random Forest"),
    "adaboost": _classifier("AdaBoost"),
    "gaussian_nb": _classifier("Gaussian Naive Bayes"),
    "multinomial_nb": _classifier("Multinomial Naive Bayes"),
    "bernoulli_nb": _classifier("Bernoulli Naive Bayes"),
    "discriminant": _classifier("LDA"),
    "stored_model": _stored_model,
    "models_by_run": _models_by_run,
    # streams
    "stream_bars": _streamed_bars,
    "stream_upsert": _streamed_upsert,
    "stream_indicators": _streamed_indicators(),
    "stream_indicators_stored": _streamed_indicators(stored_pieces=1),
    # composed jobs
    "enriched_all": _enriched,
    "analysed_240": _analysed,
    "daily_run_history": _daily_history,
    "daily_run_enriched": _daily_enriched,
    "daily_run_whole": _daily_whole,
    "daily_run_earlier": _daily_earlier,
    "return_index_demo": _demo,
}
