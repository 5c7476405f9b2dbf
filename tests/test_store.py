"""The keyed store over many runs, and whole histories resumed from carries."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from barloom.operators.bars import valid_bars
from barloom.operators.series import apply
from barloom.operators import resume, stochastics
from barloom.plans import analysis
from barloom.plans.registry import QUERIES
from barloom.schema import BAR_COLUMNS, KEY, STANDARD_COLUMNS
from barloom.session import CLEANUP, shuffles_freed, stored, unstore
from barloom.sources.keyed import KeyedStore

DAY = dt.date(2024, 1, 1)


def one_run(spark, store, run, codes):
    rows = [(f"c{k}", DAY + dt.timedelta(run), run * 100 + k) for k in codes]
    df = spark.createDataFrame(rows, "code string, date date, value int").coalesce(1)
    store.stage(run, "state", df)
    store.stage(run, "log", df)
    store.commit(run, df.select(*KEY), ["state"], ["log"])
    return {r[0]: r[2] for r in rows}, [r[2] for r in rows]


def test_twenty_runs_read_few_files(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), live=4)
    assert store.index() is None and store.current("state") is None and store.all_rows("log") is None
    state, log, then, files = {}, [], {}, []
    for run in range(1, 21):
        codes = range(40) if run == 1 else [(run * 7 + k) % 40 for k in range(5)]
        new, rows = one_run(spark, store, run, codes)
        state, log = {**state, **new}, log + rows
        then[run] = (dict(state), list(log))
        now, grown = store.current("state"), store.all_rows("log")
        files.append([len({f for f in df.inputFiles() if f"/{t}/" in f}) for df, t in ((now, "state"), (grown, "log"))])
    assert all(a <= 4 and b <= 4 for a, b in files), files
    assert max(files[4:12]) == max(files[12:]), files
    for run in (1, 6, 13, 20):  # as it was
        assert {r.code: r.value for r in store.current("state", run).collect()} == then[run][0]
        assert sorted(r.value for r in store.all_rows("log", run).collect()) == sorted(then[run][1])
    # Only what still counts is opened: the plan's scan names no other part.
    parts = {r.part for r in store.index().select("part").distinct().collect()}
    assert {int(f.split("part=")[1].split("/")[0]) for f in store.current("state").inputFiles() if "/state/" in f} == parts


def test_broken_and_repeated_runs(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), live=2)
    one_run(spark, store, 1, [1, 2])
    broken = spark.createDataFrame([("c1", DAY, -1)], "code string, date date, value int")
    store.stage(2, "state", broken)
    store.stage(2, "log", broken)
    assert {r.value for r in store.current("state").collect()} == {101, 102} and store.all_rows("log").count() == 2
    for _ in range(2):
        one_run(spark, store, 2, [2, 3])
    assert {r.value for r in store.current("state").collect()} == {101, 202, 203} and store.all_rows("log").count() == 4
    for run in range(3, 8):
        one_run(spark, store, run, [3])
    assert store.current("state", 2).count() == 3
    gone = store.vacuum()
    assert gone and store.vacuum() == [] and store.runs() == [7]
    assert {r.value for r in store.current("state").collect()} == {101, 202, 703} and store.all_rows("log").count() == 9
    with pytest.raises(ValueError):
        KeyedStore(spark, "x", live=1)


def test_whole_histories(spark, walks, tmp_path):
    """Four runs with a short tail equal one analysis of all bars."""
    store = analysis.DailyStore(spark, str(tmp_path / "daily"), tail=250)
    bars = walks.where("code in ('C', 'E', 'G', 'H', 'I', 'Z')")
    ends = ["2019-01-20", "2020-01-15", "2020-01-30", "2021-01-01"]
    for run, end in enumerate(ends, 1):
        out = analysis.daily_run(store, bars.where(f"date < '{end}'"), run, days=0)
    columns = [*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted"]
    got = {(r.code, r.date): r for r in out.select(columns).collect()}
    want = {(r.code, r.date): r for r in analysis.analyse(bars, 0).select(columns).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        for c in columns[2:]:
            a, b = got[key][c], row[c]
            assert (a is None) == (b is None) and (b is None or abs(a - b) <= 1e-8 * max(1, abs(b))), (key, c, a, b)
    early = analysis.analyse(bars.where("date < '2020-01-15'"), 0).count()
    assert store.enriched(run=2).count() == early
    with pytest.raises(ValueError, match="longest"):
        analysis.DailyStore(spark, "x", tail=100)
    with pytest.raises(ValueError, match="either"):
        analysis.daily_run(store, bars, 9, days=240)


def test_varying_recurrences_resume(spark, walks):
    """An adaptive average goes on from its carried value, whatever the block."""
    made = [stochastics.stochf(5, 4, stochastics.ADAPTIVE)]
    whole = apply(walks, made).where("code = 'I'").select(*KEY, "fastd").collect()
    name = "_k5_6_4_y"
    bars = valid_bars(walks).where("code = 'I'").withColumn("n", F.expr("row_number() over (partition by code order by date)"))
    for at in (150, 261):
        carried = apply(walks.where("code = 'I'").withColumns({"_before": F.lit(0), "_held": F.lit(None).cast("long"), "_base": F.lit(None).cast("double"), "_carry": F.struct(F.lit(0.0).alias(name))}), made, resumed=True)
        value = carried.where(f"_rn = {at}").first()[name]
        rest = bars.where(f"n > {at - 40}").drop("n").withColumns(
            {"_before": F.lit(at - 40), "_held": F.lit(at).cast("long"), "_base": F.lit(None).cast("double"), "_carry": F.struct(F.lit(value).alias(name))}
        )
        for block in (None, 64):
            got = {r.date: r.fastd for r in apply(rest, made, block=block, resumed=True).where(f"_rn > {at}").collect()}
            want = {r.date: r.fastd for r in whole}
            assert len(got) == 300 - at and all(abs(v - want[d]) < 1e-9 for d, v in got.items())
    assert resume.recurrence_names(made) == [name]


def test_a_run_leaves_no_shuffles_and_no_wide_rows_move(spark, walks, tmp_path):
    def shuffled():
        """Bytes of the shuffle files that are there."""
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return sum(os.path.getsize(f) for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data") and os.path.exists(f))

    spark._jvm.System.gc()
    before, store = shuffled(), analysis.DailyStore(spark, str(tmp_path / "daily"))
    analysis.daily_run(store, walks.where("date < '2019-05-01'"), 1)
    analysis.daily_run(store, walks, 2)
    until = time.time() + 10
    while shuffled() > before + 4000 and time.time() < until:  # files are deleted in the background
        time.sleep(0.2)
    # What stays is of looking up which parts count, a few numbers each.
    assert shuffled() <= before + 4000 and spark.conf.get(CLEANUP) == "false"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.enriched()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not set(resume.ROW_COLUMNS) & set(spark.read.parquet(f"{tmp_path}/daily/enriched").columns)
    assert [*BAR_COLUMNS, *STANDARD_COLUMNS, "classified", "predicted"] == store.enriched().columns


def test_stored_tables_can_be_deleted(spark, tmp_path):
    made = stored(spark.range(10))
    folder = made.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder)
    unstore(made)
    assert not os.path.exists(folder)
    spark.range(10).write.parquet(f"{tmp_path}/other")
    unstore(spark.read.parquet(f"{tmp_path}/other"))
    assert os.path.isdir(f"{tmp_path}/other")
    with pytest.raises(ValueError), shuffles_freed(spark):
        raise ValueError
    assert spark.conf.get(CLEANUP) == "false"


def test_what_was_upserted_does_not_stay(spark, tmp_path):
    """What landed before the newest piece is in the table, and the bars it was made from are read by no later job."""
    rows = [(k, 1, k % 3, 100.0 + k, 10.0 + k % 50, k % 4, dt.datetime(1999, 11, 1) + dt.timedelta(k // 4)) for k in range(400)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_quantity double, l_suppkey long, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    assert QUERIES["stream_upsert"](spark, str(tmp_path)).count() == 400
    left = [f"{d}/{f}" for new in set(os.listdir(shared)) - before for d, _, files in os.walk(f"{shared}/{new}") for f in files if f.endswith(".parquet")]
    assert left and all("/table/batch=" in f or "/in/2/" in f for f in left), left
