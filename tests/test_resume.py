"""What a run makes of new bars, their tail and carried values."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import resume
from barloom.operators.bars import valid_bars
from barloom.operators.finite import resumed_vol
from barloom.operators.series import apply
from barloom.operators.standard import standard_indicators
from barloom.schema import BAR_COLUMNS, KEY, STANDARD_COLUMNS


def test_short_histories_go_on(spark, walks):
    """From 64 bars on only new rows and 64 old ones are made, with the values of the whole history."""
    bars = valid_bars(walks).where("code in ('C', 'H', 'I', 'Z')")
    early = bars.where("date < '2019-04-15'")
    first = resume.enrich_resumed(resume.with_carry(early, None, 250).withColumn("_last", F.max("date").over(Window.partitionBy("code"))))
    rows = first.select(*BAR_COLUMNS, *resume.last_only("_last")).where("date = _last")
    carry = resume.next_carry(rows)
    assert {r.code: r.n for r in carry.collect()} == {"C": 14, "H": 60, "I": 74, "Z": 74}
    # What is carried of whole histories is made of all rows, here of the last ones only.
    spans = early.groupBy("code").agg(F.max("volume").alias("vmax"), F.max("high").alias("top"), F.min("low").alias("under"), F.min_by("adj_close", "date").alias("base"))
    carry = carry.drop("vmax", "top", "under", "base").join(spans, "code")
    rest = resume.enrich_resumed(resume.with_carry(bars, carry, 250))
    old = rest.where("not _new").groupBy("code").count().collect()
    assert {r.code: r["count"] for r in old} == {"C": 14, "H": 60, "I": resume.REACH, "Z": resume.REACH}
    columns = [c for c in STANDARD_COLUMNS if c not in resume.VOLUME_RATE]
    got = {(r.code, r.date): r for r in rest.where("_new").collect()}
    want = {(r.code, r.date): r for r in apply(bars, standard_indicators()).collect()}
    assert {k[0] for k in got} == {"I", "Z"} and len(got) == 300 - 74 + 80 - 74
    for key, row in got.items():
        for c in columns:
            a, b = row[c], want[key][c]
            assert (a is None) == (b is None) and (b is None or abs(a - b) <= 1e-8 * max(1, abs(b))), (key, c, a, b)


def test_resumed_vol(spark):
    """Frames reach back over batches and into the values cut off; equal values have no deviation."""
    rng = np.random.default_rng(3)
    series = {"a": [2.0] * 70, "b": [1e6 + float(x) for x in rng.normal(size=400)], "c": [0.5, 1.0, 3.0]}
    cut = {"a": 0, "b": 100, "c": 0}
    rows = [
        (code, p, k >= cut[code] + 5, v, values[:k] if k == cut[code] and k else None)
        for code, values in series.items()
        for k, v in enumerate(values)
        for p in [k - cut[code] + 1]
        if p > 0
    ]
    df = spark.createDataFrame(rows, "code string, place int, new boolean, x double, cut array<double>").coalesce(1)
    made = df.sortWithinPartitions("code", "place").withColumn("vol", resumed_vol(F.col("place"), F.col("new"), F.col("x"), F.col("cut"), 60, 10))
    got = {(r.code, r.place): r.vol for r in made.collect()}
    for code, place, new, _, _ in rows:
        k = place + cut[code]
        frame, value = series[code][max(0, k - 60) : k], got[code, place]
        if not new or k < 10:
            assert value is None or math.isnan(value)
        else:
            assert abs(value - np.std(frame, ddof=1) * math.sqrt(60)) < 1e-7 and (code != "a" or value == 0)


def test_row_columns(walks):
    made = apply(walks, standard_indicators())
    added = resume.with_row_columns(made.drop(*resume.ROW_COLUMNS))
    columns = [*KEY, *resume.ROW_COLUMNS]
    assert sorted(map(tuple, added.select(columns).collect()), key=str) == sorted(map(tuple, made.select(columns).collect()), key=str)
