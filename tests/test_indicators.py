import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from barloom.operators import finite, recursive
from barloom.operators.bars import business_day_align, valid_bars
from barloom.operators.sar import sar
from barloom.operators.series import apply
from barloom.operators.standard import enrich
from barloom.schema import BAR_COLUMNS, BARS, STANDARD_COLUMNS
from conftest import walk, weekdays

GOLDEN = {
    "sma5": 19452.864, "sma25": 18791.3916, "sma75": 17902.110667, "ewma5": 19428.781669, "ewma25": 18821.274391,
    "ewma75": 17990.951309, "rsi14": 74.982651, "mfi14": 62.467464, "roc10": 3.105898, "cci14": 104.272058,
    "ultosc": 72.559897, "fastk": 98.458950, "slowk": 93.788488, "fastd": 93.788488, "slowd": 93.322884,
    "macd": 382.990417, "macdsignal": 345.644377, "macdhist": 37.346040, "upperband": 19661.234509,
    "middleband": 19435.846198, "lowerband": 19210.457886, "sar": 18896.790021, "willr14": -0.528137, "vl": 0.762577,
    "atr": 208.399626, "natr": 1.065426, "ret_index": 1.358999, "vol": 1.562923, "mom10": 589.22, "tr": 148.81,
}


def close(a, b, tol=1e-9):
    if a is None or b is None or (isinstance(a, float) and math.isnan(a)):
        return (a is None or math.isnan(a)) and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def test_golden_values(golden_bars):
    kept = valid_bars(golden_bars).where("date >= '2014-02-17'")
    out = enrich(kept).where("date >= '2015-03-19'").orderBy("date").collect()
    assert kept.count() == 278
    for name, value in GOLDEN.items():
        assert out[1][name] == pytest.approx(value, abs=1e-6), name
    assert out[0]["v_rate"] == pytest.approx(21.841478, abs=1e-6)


def test_golden_last_180(golden_bars):
    from barloom.plans.analysis import kept_bars

    out = enrich(kept_bars(golden_bars, 180), 180)
    assert out.count() == 180
    assert round(out.where("date = '2015-03-20'").first().sma25, 2) == 18791.39


@pytest.mark.parametrize("options", [{}, {"max_rows": 300}, {"block": 40}])
def test_against_loops(walks, walk_rows, options):
    from barloom.operators.standard import standard_indicators

    got = apply(walks, standard_indicators(), **options).toPandas().sort_values(["code", "date"])
    assert list(got.columns[:8]) == BAR_COLUMNS
    for code, g in got.groupby("code"):
        want = brute.everything(walk_rows[code])
        for name in STANDARD_COLUMNS:
            for i, (a, b) in enumerate(zip(g[name].tolist(), want[name])):
                assert close(a, b, 1e-8), (code, name, i, a, b)


def test_long_series_carries_between_blocks(spark):
    rows = walk("L", 5000, 5)
    from barloom.schema import BARS

    df = spark.createDataFrame(rows, BARS)
    made = [recursive.ewma(3), recursive.ewma(200), recursive.rsi(14), recursive.atr(), recursive.macd()]
    got = apply(df, made).orderBy("date").toPandas()
    g = df.toPandas()
    want = brute.everything(g)
    q, num, den, e3 = 0.5, 0.0, 0.0, []
    for x in g["adj_close"]:
        num, den = num * q + x, den * q + 1
        e3.append(num / den)
    for name, ref in [("ewma3", e3)] + [(k, want[k]) for k in ("ewma200", "rsi14", "atr", "macd", "macdsignal")]:
        assert all(close(a, b, 1e-9) for a, b in zip(got[name].tolist(), ref)), name


def test_seed_longer_than_a_block(spark):
    from barloom.schema import BARS

    df = spark.createDataFrame(walk("L", 1500, 6), BARS)
    got = apply(df, [recursive.ewma(2), recursive.rsi(900)]).orderBy("date").toPandas()
    c = df.orderBy("date").toPandas()["adj_close"].tolist()
    up = [0.0] + [max(b - a, 0) for a, b in zip(c, c[1:])]
    dn = [0.0] + [max(a - b, 0) for a, b in zip(c, c[1:])]
    u, d = brute.seeded(up, 900, 1 / 900, 1), brute.seeded(dn, 900, 1 / 900, 1)
    want = [None if a is None else 100 * a / (a + b) for a, b in zip(u, d)]
    assert all(close(a, b, 1e-9) for a, b in zip(got["rsi900"].tolist(), want))


def test_properties(walks):
    # Bounds hold when the close lies between low and high, which an adjusted one need not.
    out = enrich(walks.withColumn("adj_close", F.col("close")))
    bad = out.where(
        "rsi14 not between 0 and 100 or mfi14 not between 0 and 100 or slowk not between 0 and 100.0000001 "
        "or fastk not between 0 and 100.0000001 or willr14 not between -100.0000001 and 0"
    )
    assert bad.count() == 0
    first = out.groupBy("code").agg(F.min_by("ret_index", "date").alias("r"))
    assert first.where("r != 1").count() == 0
    flat = out.where("code = 'Z'").orderBy(F.col("date").desc()).first()
    assert flat.willr14 == 0 and flat.cci14 == 0 and flat.fastk == 0


def test_result_does_not_depend_on_partitions(walks):
    a = apply(walks, [recursive.macd(), sar()])
    b = apply(walks.repartition(1), [recursive.macd(), sar()])
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_repeated_key_is_an_error(spark, walks):
    with pytest.raises(Exception, match="two bars for one symbol and date"):
        apply(walks.unionByName(walks), [finite.sma(5)]).collect()


def test_incomplete_and_weekend_rows_do_not_count(spark):
    from barloom.schema import BARS

    rows = walk("W", 40, 3)
    gap = [(r if i != 7 else (*r[:3], None, *r[4:])) for i, r in enumerate(rows)]
    weekend = (rows[3][0], rows[3][1].replace(day=5, month=1), *rows[3][2:])
    got = apply(spark.createDataFrame(gap + [weekend], BARS), [finite.sma(5)])
    want = apply(spark.createDataFrame([r for i, r in enumerate(rows) if i != 7], BARS), [finite.sma(5)])
    assert weekend[1].weekday() == 5
    assert got.exceptAll(want).count() == 0 and got.count() == 39


def test_rolling_corr(spark):
    import numpy as np
    import pandas as pd

    from barloom.schema import BARS

    a, b = walk("P", 40, 11), walk("Q", 40, 12)
    del a[9], b[20], b[21]
    df = spark.createDataFrame(a + b, BARS)
    for aligned in (False, True):
        bars = business_day_align(df) if aligned else df
        got = finite.rolling_corr(bars, bars.where("code = 'Q'").select("date", "adj_close")).where("code = 'P'")
        got = {r.date: r.rolling_corr for r in got.collect()}
        pdf = {k: g.sort_values("date").set_index("date")["adj_close"] for k, g in bars.toPandas().groupby("code")}
        change = {k: s.ffill().pct_change(fill_method=None) for k, s in pdf.items()}
        both = pd.concat([change["P"], change["Q"]], axis=1).sort_index()
        for i, day in enumerate(both.index):
            if day not in pdf["P"].index:
                continue
            window = both.iloc[max(0, i - 4): i + 1].to_numpy()
            want = None
            if len(window) == 5 and not np.isnan(window).any() and (window.std(axis=0) > 0).all():
                want = float(np.corrcoef(window[:, 0], window[:, 1])[0, 1])
            assert close(got[day], want, 1e-7), day


def test_one_shuffle_for_all_indicators(walks, spark, tmp_path):
    walks.write.parquet(str(tmp_path / "bars"))
    for rows in (None, 300):
        plan = enrich(spark.read.parquet(str(tmp_path / "bars")), rows)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert plan.count("Sort [") == (2 if rows is None else 1)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_more_rows_than_promised_is_an_error(walks):
    with pytest.raises(Exception, match="max_rows"):
        apply(walks, [recursive.ewma(5)], max_rows=240).collect()


def test_deviation_after_a_long_rise(spark):
    """The index grows a thousandfold, then hardly moves: the digits must stay."""
    rng = np.random.RandomState(3)
    close = np.concatenate([np.geomspace(1, 1000, 300), 1000 + np.cumsum(rng.normal(0, 0.001, 300))])
    rows = [("A", d, c, c, c, c, 1.0, c) for d, c in zip(weekdays(600), map(float, close))]
    got = apply(spark.createDataFrame(rows, BARS), [finite.vol()]).orderBy("date").select("vol").toPandas()["vol"]
    want = pd.Series(close / close[0]).rolling(250, min_periods=50).apply(lambda x: np.std(x, ddof=1), raw=True) * np.sqrt(250)
    assert np.allclose(got, want, rtol=1e-9, equal_nan=True)


def test_the_long_frame_of_vol_only_deviates(spark, walks):
    """Each row adds up 250 others: nothing that a running value can give belongs there."""
    out = apply(walks, [finite.vol(20, 5)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    made = re.findall(r"(\w+)\([^()]*\) windowspecdefinition\((?:(?!windowspecdefinition).)*?-19, currentrow", plan)
    assert set(made) == {"stddev_samp"}
    closes = [r.adj_close for r in valid_bars(walks).where("code = 'I'").orderBy("date").collect()]
    index = [c / closes[0] for c in closes]
    got = [r.vol for r in out.where("code = 'I'").orderBy("date").collect()]
    for i, v in enumerate(got):
        part = index[max(0, i - 19) : i + 1]
        assert (v is None) == (len(part) < 5) and (v is None or abs(v - np.std(part, ddof=1) * math.sqrt(20)) < 1e-9)
