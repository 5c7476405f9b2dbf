import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import recursive
from barloom.operators.series import apply
from barloom.schema import BARS
from barloom.sources import ticks
from barloom.streaming.bars import stream_bars
from barloom.operators.sar import sar
from barloom.streaming.recursive import row_store, stream_indicators
from barloom.streaming.upsert import compact, read_upserted, stream_upsert, write_batch

TICK = "code string, ts timestamp, seq long, value double"


def run_to_table(df, path):
    q = (
        df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out")


def test_bars_from_a_stream(spark, small, tmp_path):
    """Files one by one, all weekends included: emitted bars equal the batch ones."""
    all_ticks = ticks.event_ticks(spark.read.parquet(f"{small}/events.parquet"))
    rows = all_ticks.orderBy("ts").collect()
    for i in range(0, len(rows), 200):
        spark.createDataFrame(rows[i: i + 200], TICK).coalesce(1).write.parquet(f"{tmp_path}/in/{i:06d}")
    stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    got = run_to_table(stream_bars(stream, "1 day"), str(tmp_path))
    batch = ticks.resample_ticks(all_ticks)
    assert got.count() > 0 and got.exceptAll(batch).count() == 0
    left = batch.exceptAll(got).select("date").distinct().count()
    assert left <= 2


def test_late_ticks_are_dropped(spark, tmp_path):
    t = dt.datetime
    parts = [
        [("a", t(2024, 1, 1, 9), 1, 1.0)], [("a", t(2024, 1, 4, 9), 2, 2.0)], [("a", t(2024, 1, 5, 9), 5, 2.5)],
        [("a", t(2024, 1, 1, 10), 3, 99.0)], [("a", t(2024, 1, 9, 9), 4, 3.0)],
    ]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, TICK).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    got = {r.date: r.high for r in run_to_table(stream_bars(stream, "1 day"), str(tmp_path)).collect()}
    assert got == {dt.date(2024, 1, 1): 1.0, dt.date(2024, 1, 4): 2.0, dt.date(2024, 1, 5): 2.5}


def test_upsert_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([("a", day, 1.0, None, 1.0, 1.0, 1.0, 1.0)], BARS)
    second = spark.createDataFrame([("a", day, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0), ("b", day, *[2.0] * 6)], BARS)
    write_batch(first, 0, path)
    for _ in range(2):
        write_batch(second, 1, path)
    got = {r.code: r for r in read_upserted(spark, path).collect()}
    assert (got["a"].open, got["a"].high, got["b"].open) == (1.0, 9.0, 2.0)
    compact(spark, path, str(tmp_path / "u"))
    write_batch(first.withColumn("open", F.lit(5.0)), 2, str(tmp_path / "u"))
    assert read_upserted(spark, str(tmp_path / "u")).exceptAll(read_upserted(spark, path)).count() == 0


def test_stream_upsert(spark, walks, tmp_path):
    walks.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(BARS).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    stream_upsert(stream, str(tmp_path / "t"), str(tmp_path / "s")).awaitTermination()
    assert read_upserted(spark, str(tmp_path / "t")).exceptAll(walks).count() == 0


NAMES = ["ewma5", "rsi14", "atr", "natr", "macd", "macdsignal", "macdhist", "upperband", "middleband", "lowerband", "sar"]


def batch_indicators(bars):
    made = [recursive.ewma(5), recursive.rsi(14), recursive.atr(), recursive.natr(), recursive.macd(), recursive.bbands(), sar()]
    return apply(bars, made).select("code", "date", *NAMES)


def assert_same(got, want):
    got, want = ({(r.code, r.date): r for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for key, row in want.items():
        for c in NAMES:
            a, b = got[key][c], row[c]
            assert (a is None) == (b is None) and (b is None or abs(a - b) <= 1e-8 * max(1, abs(b))), (key, c, a, b)


def streamed(spark, path, parts, **options):
    """The parts land one after the other, and the stream is started anew for each."""
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{path}/in/{i}")
        stream = spark.readStream.schema(BARS).option("recursiveFileLookup", True).parquet(f"{path}/in")
        with row_store(spark):
            got = run_to_table(stream_indicators(stream, **options), path)
    return got


def dirty(spark, walks):
    """The walks, with incomplete and weekend bars between."""
    broken = walks.where("day(date) % 5 = 0").select("code", (F.col("date") + F.expr("interval 1 hour")).cast("date").alias("date"), "open", "high", "low", "close", "volume", "adj_close")
    broken = broken.withColumn("adj_close", F.lit(None).cast("double"))
    kept = walks.join(broken.select("code", "date"), ["code", "date"], "left_anti").select(walks.columns)
    weekend = kept.where("weekday(date) = 4").withColumn("date", F.date_add("date", 1)).withColumn("high", F.lit(1e6))
    return kept, kept.unionByName(broken).unionByName(weekend)


def test_incremental_indicators_equal_batch(spark, walks, tmp_path):
    kept, rows = dirty(spark, walks)
    cuts = ["date < '2019-01-15'", "date >= '2019-01-15' and date < '2019-02-20'", "date >= '2019-02-20' and date < '2019-06-01'", "date >= '2019-05-20' and date < '2019-09-01'", "date >= '2019-09-01'"]
    parts = [rows.where(c) for c in cuts]
    again = rows.where("date < '2019-03-01'").withColumn("adj_close", F.col("adj_close") * 2)  # old days land again
    assert_same(streamed(spark, str(tmp_path), [*parts[:3], parts[3].unionByName(again), parts[4]]), batch_indicators(kept))


def test_state_from_stored_bars(spark, walks, tmp_path):
    old, new = walks.where("date < '2019-03-01'"), walks.where("date >= '2019-02-20'")
    cut = "date >= '2019-03-01'"
    got = streamed(spark, str(tmp_path), [new.where("date < '2019-05-01'"), new.where("date >= '2019-05-01'")], stored=old)
    assert_same(got, batch_indicators(walks).where(cut))


def test_silent_symbols_are_forgotten(spark, walks, tmp_path):
    """Symbol I goes on, H comes back after 100 days without a bar and starts anew."""
    both = walks.where("code in ('H', 'I')")
    gap = "not (code = 'H' and date between '2019-02-01' and '2019-03-15')"
    moved = both.where(gap).withColumn("date", F.when(F.expr("code = 'H' and date > '2019-03-15'"), F.date_add("date", 112)).otherwise(F.col("date")))
    parts = ["date < '2019-02-01'", "date >= '2019-02-01' and date < '2019-05-20'", "date >= '2019-05-20' and date < '2019-06-01'", "date >= '2019-06-01'"]
    got = streamed(spark, str(tmp_path), [moved.where(p) for p in parts], idle_days=60, delay="0 days")
    first, later = "code = 'I' or date < '2019-02-01'", "code = 'H' and date > '2019-05-20'"
    want = batch_indicators(moved.where(first)).unionByName(batch_indicators(moved.where(later)))
    assert_same(got, want)


def test_a_key_repeated_in_a_batch_is_an_error(spark, walks, tmp_path):
    with pytest.raises(Exception, match="two bars"):
        write_batch(walks.union(walks.limit(1)), 0, str(tmp_path / "t"))
