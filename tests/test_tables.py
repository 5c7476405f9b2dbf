import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom import functions as fn
from barloom.operators import bars as tb
from barloom.operators import charts, summary
from barloom.plans import analysis
from barloom.schema import BARS, SYMBOLS
from barloom.sources import files, sinks, ticks

D = dt.date


def bar(code, day, price, volume=10.0):
    p = None if price is None else float(price)
    return (code, day, p, p, p, p, volume, p)


def make(spark, rows):
    return spark.createDataFrame(rows, BARS)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_align_fills_weekdays_and_drops_weekends(spark):
    df = make(spark, [bar("a", D(2024, 1, 4), 1), bar("a", D(2024, 1, 6), 2), bar("a", D(2024, 1, 9), 3), bar("b", D(2024, 1, 7), 9)])
    got = rows(tb.business_day_align(df), "code", "date", "close")
    assert got == [("a", D(2024, 1, 4), 1.0), ("a", D(2024, 1, 5), None), ("a", D(2024, 1, 8), None), ("a", D(2024, 1, 9), 3.0)] or got == sorted(
        [("a", D(2024, 1, 4), 1.0), ("a", D(2024, 1, 5), None), ("a", D(2024, 1, 8), None), ("a", D(2024, 1, 9), 3.0)], key=str
    )


def test_valid_equals_align_then_drop(spark, walks):
    noisy = walks.withColumn("close", F.when(F.col("volume") > 100, F.col("close")))
    a = tb.valid_bars(noisy)
    b = tb.drop_incomplete(tb.business_day_align(noisy))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_last_bars(walks):
    assert tb.last_bars(walks, 0).count() == walks.count()
    n = {r.code: r["count"] for r in tb.last_bars(walks, 20).groupBy("code").count().collect()}
    assert n["A"] == 1 and n["I"] == 20


def test_upsert_keeps_old_cells_and_is_idempotent(spark):
    old = make(spark, [("a", D(2024, 1, 1), 1.0, None, 1.0, 1.0, 5.0, 1.0)])
    new = make(spark, [bar("a", D(2024, 1, 1), 7), bar("a", D(2024, 1, 2), 8), bar("b", D(2024, 1, 1), 9)])
    merged = tb.upsert(old, new)
    assert rows(merged, "code", "date", "open", "high") == [
        ("a", D(2024, 1, 1), 1.0, 7.0), ("a", D(2024, 1, 2), 8.0, 8.0), ("b", D(2024, 1, 1), 9.0, 9.0),
    ]
    again = tb.upsert(merged, new)
    assert again.exceptAll(merged).count() == 0


def test_next_business_day(spark):
    days = [D(2024, 1, d) for d in (3, 5, 6, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[1] for r in df.select("d", fn.next_business_day(F.col("d"))).orderBy("d").collect()]
    assert got == [D(2024, 1, 4), D(2024, 1, 8), D(2024, 1, 8), D(2024, 1, 8)]


def test_new_rows_and_changed_codes(spark):
    stored = make(spark, [bar("a", D(2024, 1, 5), 1), bar("b", D(2024, 1, 8), 1)])
    landed = make(spark, [bar("a", D(2024, 1, 5), 2), bar("a", D(2024, 1, 8), 2), bar("b", D(2024, 1, 8), 2), bar("c", D(2024, 1, 1), 2)])
    assert rows(tb.new_rows(stored, landed), "code", "date") == [("a", D(2024, 1, 8)), ("c", D(2024, 1, 1))]
    assert rows(tb.changed_codes(stored, landed), "code") == [("a",), ("c",)]


def test_resample_ticks_rolls_weekends_back_and_breaks_ties(spark):
    t = dt.datetime
    df = spark.createDataFrame(
        [
            ("a", t(2024, 1, 5, 9), 1, 10.0), ("a", t(2024, 1, 5, 9), 2, 11.0), ("a", t(2024, 1, 6, 9), 3, 20.0),
            ("a", t(2024, 1, 7, 9), 4, 5.0), ("a", t(2024, 1, 8, 9), 5, 7.0), ("a", t(2024, 1, 8, 9), 6, None),
        ],
        "code string, ts timestamp, seq long, value double",
    )
    got = rows(ticks.resample_ticks(df), "date", "open", "high", "low", "close")
    assert got == [(D(2024, 1, 5), 10.0, 20.0, 5.0, 5.0), (D(2024, 1, 8), 7.0, 7.0, 7.0, 7.0)]
    with pytest.raises(ValueError):
        ticks.resample_ticks(df, "x")


def test_resample_bars(spark, walks):
    assert tb.resample_bars(walks, "d") is walks
    weekly = tb.resample_bars(walks, "w")
    assert weekly.agg(F.sum("volume")).first()[0] == walks.agg(F.sum("volume")).first()[0]
    with pytest.raises(ValueError):
        tb.resample_bars(walks, "v")


def test_hot_symbol_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
        F.timestamp_seconds(F.lit(1704700000) + F.col("id") % 5).alias("ts"),
        F.col("id").alias("seq"),
        F.col("id").cast("double").alias("value"),
    )
    bars = ticks.resample_ticks(hot)
    got = bars.where("code = 'hot'").collect()
    assert len(got) == 1 and (got[0].high, got[0].low) == (29997.0, 0.0)
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[min_by") < plan.index("Exchange") < plan.index("partial_min_by")


def test_ohlc_columns(spark, walks):
    four = walks.select("code", "date", "open", "high", "low", "close")
    assert tb.ohlc_columns(four).columns == ["code", "date", "Open", "Close", "High", "Low"]
    named = walks.toDF("code", "date", "Open", "High", "Low", "Close", "Volume", "Adj Close")
    assert tb.ohlc_columns(named).columns == ["code", "date", "Open", "Close", "High", "Low"]
    with pytest.raises(ValueError, match="not ohlc-like"):
        tb.ohlc_columns(walks)


def test_quality_report(spark):
    day = D(2024, 1, 6)
    df = make(spark, [bar("a", day, 1), bar("a", day, 1), ("b", D(2024, 1, 4), 2.0, 1.0, 3.0, 2.0, None, 2.0)])
    got = {r.code: r.asDict() for r in tb.quality_report(df).collect()}
    assert got["a"]["duplicate_keys"] == 1 and got["a"]["weekend_rows"] == 2
    assert got["b"]["low_above_body"] == 1 and got["b"]["high_below_body"] == 1 and got["b"]["incomplete_rows"] == 1


def test_price_csv_round_trip(spark, golden_bars, tmp_path):
    assert golden_bars.count() == 307
    assert [r.code for r in golden_bars.select("code").distinct().collect()] == ["N225"]
    last = tb.rows_from_end(golden_bars, 1).first()
    assert (last.date, last.adj_close) == (D(2015, 3, 20), 19560.22)
    assert tb.business_day_align(golden_bars).count() == 315
    sinks.write_table(golden_bars, str(tmp_path / "t"))
    assert files.read_bars(spark, str(tmp_path / "t")).exceptAll(golden_bars).count() == 0


def test_exported_text_reads_back(spark, walks, tmp_path):
    sinks.export_csv(walks, str(tmp_path / "c"))
    back = files.read_exported(spark, str(tmp_path / "c"))
    assert back.columns == walks.columns
    assert back.count() == walks.count() and back.exceptAll(walks).count() == 0
    one = files.read_price_csv(spark, str(next((tmp_path / "c" / "code=I").glob("*.csv"))))
    assert one.drop("code").exceptAll(walks.where("code = 'I'").drop("code")).count() == 0


@pytest.mark.parametrize("mounted", [True, False])
def test_price_files_are_listed_once(spark, walks, tmp_path, monkeypatch, mounted):
    """The driver's calls and Spark's listing jobs do not add up over the symbols, but for renames."""
    path, renamed = str(tmp_path / "p"), sinks._rename_staged
    names = ["I", "x,y", "a b", "50%"]
    if not mounted:  # as on a file system that only Spark reaches
        monkeypatch.setattr(sinks, "MOUNTED", "none")
    monkeypatch.setattr(sinks, "_rename_staged", (lambda *a: pytest.fail("the driver renames files")) if mounted else renamed)
    one = walks.where("code = 'I'")
    many = one.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("code"), *one.columns[1:])
    sinks.export_price_files(many, path)
    sinks.export_price_files(many.withColumn("volume", F.lit(7.0)).where("code != 'a b'"), path)  # replaces three files
    assert {p.name for p in (tmp_path / "p").glob("[!.]*")} == {f"stock_{n}.csv" for n in names}
    sinks.export_csv(one, str(tmp_path / "c"))
    assert next((tmp_path / "c" / "code=I").glob("part-*")).read_text() == (tmp_path / "p" / "stock_a b.csv").read_text()
    jobs, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    jobs.setJobGroup("listing", "listing")
    got = files.read_price_csv(spark, path, folder=True)
    jobs.setJobGroup("", "")
    assert len(got.inputFiles()) == 4 and list(tracker.getJobIdsForGroup("listing")) == []
    want = many.withColumn("volume", F.when(F.col("code") == "a b", F.col("volume")).otherwise(7.0))
    rows = got.select("date", "open", "volume").exceptAll(want.select("date", "open", "volume"))
    assert got.count() == many.count() and rows.count() == 0
    few = files.read_price_csv(spark, str(tmp_path / "p" / "stock_[Ix]*.csv")).select("code").distinct().collect()
    assert {r.code for r in few} == {"I", "x,y"}


def test_order_key_keeps_ticks_in_a_hash_table(spark, small):
    plan = ticks.lineitem_bars(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    key = ticks.order_key((F.col("a"), 2), (F.col("b"), 3))
    df = spark.createDataFrame([(1, 999), (2, 0), (None, 5)], "a long, b long")
    assert [r[0] if r[0] is None else int(r[0]) for r in df.select(key).collect()] == [1999, 2000, None]
    for bad in ((100, 0), (-1, 0)):
        with pytest.raises(Exception, match="order key"):
            spark.createDataFrame([bad], "a long, b long").select(key).collect()
    with pytest.raises(ValueError, match="38"):
        ticks.order_key((F.col("a"), 20), (F.col("b"), 19))


def test_csv_reading(spark, tmp_path):
    head = "Date,Open,High,Low,Close,Volume,Adj Close\n"
    (tmp_path / "stock_7203.csv").write_text(head + "2024-01-04,1,2,0.5,1.5,100,1.4\n2024-01-05,NaN,2,0.5,1.5,,1.4\n")
    (tmp_path / "stock_0001.csv").write_text(head + "2024-01-04,1,2,0.5,1.5,100,1.4\n")
    got = files.read_price_csv(spark, f"{tmp_path}/stock_*.csv")
    assert rows(got.where("volume is not null"), "code", "adj_close") == [("0001", 1.4), ("7203", 1.4)]
    odd = got.where("volume is null").first()
    assert odd.open is None and odd.date == D(2024, 1, 5)


def test_raw_history(spark, tmp_path):
    head = "日付,始値,高値,安値,終値,出来高,調整後終値*\n"
    (tmp_path / "raw_7203.csv").write_text(head + "2015年3月20日,1,2,0.5,1.5,100,1.4\n2015年3月18日,1,2,0.5,1.5,100,1.3\n", encoding="utf-8")
    got = files.read_raw_history(spark, f"{tmp_path}/raw_*.csv").orderBy("date").collect()
    assert [(r.date, r.adj_close) for r in got] == [(D(2015, 3, 18), 1.3), (D(2015, 3, 19), None), (D(2015, 3, 20), 1.4)]


def test_symbol_list(spark, tmp_path):
    p = tmp_path / "list.txt"
    p.write_text("0042,Foo,(株)Foo,食品,CORE\nN225,日経\n6758,Bar,Bar Inc,,Favorite\n", encoding="utf-8")
    s = files.read_symbols(spark, str(p))
    got = {r.code: r for r in s.collect()}
    assert got["0042"].fullname == "(株)Foo" and got["N225"].fullname is None and got["6758"].sector is None
    names = {r.code: r.t for r in s.select("code", fn.display_name(F.col("name"), F.col("fullname")).alias("t")).collect()}
    assert names == {"0042": "(株)Foo", "N225": "日経", "6758": "Bar Inc"}
    assert rows(tb.exclude_indices(s), "code") == [("0042",), ("6758",)]
    assert rows(files.missing_history(s, make(spark, [bar("0042", D(2024, 1, 1), 1)])), "code") == [("6758",), ("N225",)]


def test_summary_formulas(spark):
    days = [D(2024, 1, d) for d in (1, 2, 3, 4)]
    table = make(
        spark,
        [bar("a", d, p) for d, p in zip(days, (10.9, 20.5, 30.7, 29.9))]
        + [bar("old", D(2023, 12, 1), 5), bar("N225", days[3], 5), bar("one", days[3], 8.2), bar("x", days[3], 4)],
    ).withColumns({"classified": F.lit(1), "predicted": F.lit(31.9), "rsi9": F.lit(55.9)})
    names = spark.createDataFrame([(c, c.upper(), None, None, None) for c in ("a", "old", "N225", "one")], SYMBOLS)
    got = {r.code: r for r in summary.ranked_summary(table, names, "2024-01-10").collect()}
    assert set(got) == {"a", "one"}
    assert (got["a"].close, got["a"].change, got["a"].ratio, got["a"].trend, got["a"].pred) == (29, -1, 0.0, 1, 31)
    assert got["one"].change is None and got["one"].ratio is None
    wide = summary.ranked_summary(table, names, "2024-01-10", span=2, screening_key="rsi9").where("code = 'a'").first()
    assert (wide.change, wide.ratio, wide.rsi9) == (9, round(10 / 29 * 100, 2), 55)
    order = [r.code for r in summary.ranked_summary(table, names, "2024-01-10", sortkey=None).collect()]
    assert order == ["one", "a"]


def test_reports_are_written_in_order(spark, walks, tmp_path):
    from barloom.operators import recursive
    from barloom.operators.series import apply

    table = apply(walks, [recursive.rsi(9), recursive.rsi(14)]).withColumns(
        {"classified": F.lit(1), "predicted": F.lit(3.0)}
    )
    names = walks.select("code").distinct().select("code", F.col("code").alias("name"))
    asof = str(walks.agg(F.max("date")).first()[0])
    analysis.write_reports(table, {}, names, asof, str(tmp_path))
    parts = sorted((tmp_path / "summary").glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines() if not line.startswith("Code\t")]
    ratios = [float(line.split("\t")[6]) for line in lines]
    assert ratios == sorted(ratios, reverse=True)
    history = spark.read.parquet(str(tmp_path / "history"))
    assert [str(r[0]) for r in history.select("snapshot_date").distinct().collect()] == [asof]


def test_caption_and_chart(spark):
    df = make(spark, [bar("a", D(2024, 1, 1), 1000.5), bar("a", D(2024, 1, 2), 1234567.9, 4321.0)]).withColumns(
        {"classified": F.lit(0), "predicted": F.lit(1250000)}
    )
    got = charts.chart_caption(df, asof="2024-01-02").first()
    assert (got.close, got.change, got.highest, got.lowest, got.trend) == (1234567, 1233567, 1234567, 1000, "↓")
    assert "終値:1,234,567 (+1233567, 99.92%)" in got.caption and got.caption.startswith("a(a)  2024/01/02\n")
    names = {(a, c): {s for _, s, *_ in charts.series_for(a, c)} for a in (1, 2) for c in (1, 2, 3)}
    assert "ewma200" in names[1, 1] and "ewma5" not in names[1, 1] and "v_rate_p" in names[1, 1]
    assert "rsi9" in names[2, 1] and "mfi14" not in names[2, 1] and "sar" in names[2, 2]
    assert {"roc10", "willr14", "upperband"} <= names[2, 3] and "rsi9" not in names[1, 3]
    chart = spark.range(4).select(F.explode(F.array(*[F.lit(x) for x in (0, 60, 240, 600)])).alias("d")).distinct()
    got = {r.d: r.k for r in chart.select("d", fn.output_class(F.col("d")).alias("k")).collect()}
    assert got == {0: "short", 60: "short", 240: "chart", 600: "long"}


def test_date_range(spark, walks):
    got = files.date_range(walks, "2019-01-10", start="2019-01-08").agg(F.min("date"), F.max("date")).first()
    assert (got[0], got[1]) == (D(2019, 1, 8), D(2019, 1, 10))
    assert files.date_range(walks, "2020-06-30").agg(F.min("date")).first()[0] >= D(2019, 7, 1)


def test_filters_reach_the_scan(spark, small):
    bars = tb.valid_bars(ticks.lineitem_bars(spark, small)).where(F.col("code") == "3")
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" in plan.split("PushedFilters")[1]
    one = ticks.lineitem_bars(spark, small, F.col("l_suppkey") == 3)
    assert "EqualTo(l_suppkey,3)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.exceptAll(ticks.lineitem_bars(spark, small).where("code = '3'")).count() == 0
    assert "l_discount" not in plan and "l_tax" not in plan


def test_fill_bins(spark):
    d = dt.date
    rows = [("a", d(2024, 1, 1), 1.0), ("a", d(2024, 3, 1), 2.0), ("b", d(2024, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "code string, date date, close double")
    got = {f: [(r.code, r.date, r.close) for r in tb.fill_bins(df, f).orderBy("code", "date").collect()] for f in "BDM"}
    assert got["M"] == [("a", d(2024, 1, 1), 1.0), ("a", d(2024, 2, 1), None), ("a", d(2024, 3, 1), 2.0), ("b", d(2024, 1, 1), 3.0)]
    assert len(got["D"]) == 62 and len(got["B"]) == 46 and sum(c is None for _, _, c in got["B"]) == 43
    weeks = df.withColumn("date", F.date_trunc("week", "date").cast("date"))
    assert [r.date for r in tb.fill_bins(weeks, "W").where("code = 'a'").orderBy("date").collect()] == [d(2024, 1, 1) + dt.timedelta(7 * k) for k in range(9)]
    assert tb.fill_bins(df.limit(0), "W").count() == 0
    with pytest.raises(ValueError):
        tb.fill_bins(df, "Q")


def test_numbered_rows(spark):
    df = spark.range(1000).repartition(7).withColumn("v", F.col("id") % 13).orderBy("v", F.col("id").desc())
    got = tb.numbered(df).orderBy("rank").collect()
    want = sorted(range(1000), key=lambda i: (i % 13, -i))
    assert [r["id"] for r in got] == want and [r["rank"] for r in got] == list(range(1, 1001))
    assert tb.numbered(df.where("id < 0")).count() == 0


def test_bucketed_bars_need_no_shuffle(spark, walks, tmp_path):
    from barloom.operators import finite, recursive
    from barloom.operators.series import apply
    from barloom.sources.sinks import save_bucketed

    made = [finite.sma(5), recursive.ewma(5), recursive.rsi(14)]
    table = save_bucketed(walks, "bucketed_walks", str(tmp_path / "b"), 4)
    keys = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        indicators = apply(table, made)
        joined = tb.merge_frames(table, indicators.select("code", "date", "sma5", "rsi14"))
        for df in (indicators, joined):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert indicators.exceptAll(apply(walks, made)).count() == 0 and joined.count() == indicators.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_price_files_by_name(spark, walks, tmp_path):
    from barloom.sources import files, sinks

    some = walks.where("code in ('A', 'I')").withColumn("code", F.concat("code", F.lit("=1.T")))
    sinks.export_price_files(some, str(tmp_path / "p"))
    assert sorted(f.name for f in (tmp_path / "p").glob("*.csv")) == ["stock_A=1.T.csv", "stock_I=1.T.csv"]
    back = files.read_price_csv(spark, str(tmp_path / "p" / "stock_*.csv"))
    assert back.exceptAll(some).count() == 0 and back.count() == some.count()


def test_models_by_run(spark, tmp_path):
    from barloom.operators.classifiers import ModelStore

    store = ModelStore(spark, str(tmp_path / "m"))
    assert store.load("Ridge") is None
    store.save("Ridge", spark.createDataFrame([("a", 1.0), ("b", 1.0)], "code string, w double"), 1)
    store.save("Ridge", spark.createDataFrame([("b", 2.0), ("c", 2.0)], "code string, w double"), 2)
    assert {r.code: r.w for r in store.load("Ridge").collect()} == {"a": 1.0, "b": 2.0, "c": 2.0}
    assert {r.code: r.w for r in store.load("Ridge", run=1).collect()} == {"a": 1.0, "b": 1.0}
    assert store.load("Naive Bayes") is None
