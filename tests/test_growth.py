"""Steps whose cost must not outgrow the tables: each would have failed before it was mended."""

import datetime as dt
import os

from pyspark.sql import functions as F

from barloom.operators import trees
from barloom.operators.bars import valid_bars
from barloom.plans import analysis, registry
from barloom.schema import BARS, CODE, DATE
from barloom.sources import files, sinks
from barloom.sources.keyed import KeyedStore


def numbered_codes(walks, days_back=0):
    return walks.select(F.ascii(CODE).cast("string").alias(CODE), F.date_sub(DATE, days_back).alias(DATE), *walks.columns[2:])


def landed_files(path):
    return {i: len([f for f in os.listdir(f"{path}/in/{i}") if f.endswith(".parquet")]) for i in os.listdir(f"{path}/in")}


def test_a_part_is_made_once(spark, tmp_path):
    """Staging a part runs what makes it once (before: twice, the first time to sample its keys)."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).select(F.col("id").cast("string").alias(CODE)).mapInArrow(count, "code string")
    assert KeyedStore(spark, str(tmp_path / "s")).stage(1, "state", rows).count() == 1000
    assert seen.value == 1000


def test_whole_histories_write_wide_rows_once(spark, walks, tmp_path, monkeypatch):
    """No indicator columns are written beside the table itself; a symbol with incomplete news keeps its carry."""
    widths, plain = [], analysis.checkpoint
    monkeypatch.setattr(analysis, "checkpoint", lambda df: widths.append(len(df.columns)) or plain(df))
    store = analysis.DailyStore(spark, str(tmp_path / "daily"), tail=250)
    bars = walks.where("code in ('H', 'I')")
    early = F.col(DATE) < dt.date(2019, 3, 1)
    analysis.daily_run(store, bars.where(early), 1, days=0)
    before = {r.code: r for r in store.current("carry").collect()}
    news = bars.where(~early).withColumn("open", F.when(F.col(CODE) == "I", F.col("open")))
    analysis.daily_run(store, news, 2, days=0)
    after = {r.code: r for r in store.current("carry").collect()}
    assert max(widths, default=0) <= 12
    assert after["H"] == before["H"] and after["I"].n == 300
    assert store.enriched().columns[-2:] == ["classified", "predicted"]


def test_landed_pieces_are_several_files(spark, walks, tmp_path, monkeypatch):
    """A landed piece is written and read by many tasks, and still is one batch."""
    bars = numbered_codes(walks, 7300).repartition(5)
    monkeypatch.setattr(registry, "_stored_bars", lambda *_: bars)
    monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / name))
    assert registry._streamed_upsert(spark, "").count() == bars.count()
    assert max(landed_files(tmp_path / "upsert").values()) > 1
    assert len([d for d in os.listdir(tmp_path / "upsert/table") if d.startswith("batch=")]) == 3
    assert registry._streamed_indicators()(spark, "").count() == valid_bars(bars).count()
    assert max(landed_files(tmp_path / "indicators").values()) > 1



def test_a_draw_is_digested_once(spark):
    """One digest for each sample and tree (before: one for each step of the distribution)."""
    samples = spark.createDataFrame([("a", dt.date(2024, 1, 2), [1.0] * 14, 1)], "code string, date date, features array<double>, label int")
    plan = trees.fit_forest(samples, trees=3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 3
