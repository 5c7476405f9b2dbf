import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from barloom.operators import bayes, finite, regressors, trees
from barloom.operators import features as feat
from barloom.operators.bars import valid_bars
from barloom.operators.classifiers import (
    CLASSIFIERS, class_samples, classify_pooled, fit_pooled, load_model, save_model, value_samples,
)
from barloom.operators.series import apply
from barloom.plans import analysis

@pytest.fixture(scope="module")
def golden_index(golden_bars):
    return apply(valid_bars(golden_bars).where("date >= '2014-05-13'"), [finite.ret_index()]).cache()


@pytest.fixture(scope="module")
def index(walks):
    return apply(walks, [finite.ret_index()]).cache()


@pytest.fixture(scope="module")
def samples(index):
    return class_samples(index).cache()


@pytest.fixture(scope="module")
def windows(index):
    return feat.scoring_window(index).cache()


def arrays(df):
    pdf = df.orderBy("code", "date").toPandas()
    return {c: (np.stack(g["features"].to_numpy()), g["label"].to_numpy(float)) for c, g in pdf.groupby("code")}


def last_windows(windows):
    return {r.code: np.array(r.features) for r in windows.collect()}


def predictions(df):
    return {r.code: r.prediction for r in df.collect()}


def test_golden_windows(golden_index):
    rows = class_samples(golden_index).orderBy("date").collect()
    assert len(rows) == 120 and len(rows[0].features) == 14
    assert (round(rows[0].features[0], 5), round(rows[-1].features[-1], 5)) == (1.08871, 1.35486)
    assert feat.binary_class(golden_index, 90).count() == 75
    assert value_samples(golden_index).count() == 121
    last = class_samples(golden_index, "compat_last").collect()
    assert len(last) == 1 and round(last[0].features[0], 5) == 1.30311 and last[0].label == 0


def test_golden_forecasts(golden_index, golden_bars):
    w = feat.scoring_window(golden_index)
    s = class_samples(golden_index)
    base = golden_index.groupBy("code").agg(F.min_by("adj_close", "date").alias("base"))
    ridge = regressors.predict(regressors.fit(value_samples(golden_index)), w, base).first()
    assert round(ridge.prediction, 2) == 19177.97
    lasso = regressors.predict(regressors.fit(value_samples(golden_index), "Lasso"), w).first()
    assert lasso.prediction == pytest.approx(value_samples(golden_index).agg(F.avg("label")).first()[0])
    for name in ("Decision Tree", "Random Forest"):
        kind = CLASSIFIERS[name]
        got = kind.classify(kind.fit(s), w).first().prediction
        assert got == 0 if name == "Decision Tree" else got in (0, 1)
    kind = CLASSIFIERS["Decision Tree"]
    assert kind.classify(kind.fit(class_samples(golden_index, "compat_last")), w).first().prediction == 0
    assert classify_pooled(fit_pooled(s), w).first().prediction == 0


def test_sample_counts(index):
    n = {r.code: r["count"] for r in class_samples(index).groupBy("code").count().collect()}
    v = {r.code: r["count"] for r in value_samples(index).groupBy("code").count().collect()}
    assert n == {"E": 1, "F": 18, "G": 19, "H": 45, "I": 120, "Z": 65}
    assert v == {"D": 1, "E": 2, "F": 19, "G": 20, "H": 46, "I": 121, "Z": 66}
    assert {r.code for r in feat.scoring_window(index).collect()} == {"C", "D", "E", "F", "G", "H", "I", "Z"}


@pytest.mark.parametrize("alpha", [1.0, 0.01])
def test_ridge_is_the_minimum(index, windows, alpha):
    got = predictions(regressors.predict(regressors.fit(value_samples(index), "Ridge", alpha), windows))
    last = last_windows(windows)
    for code, (x, y) in arrays(value_samples(index)).items():
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(14), xc.T @ yc)
        assert got[code] == pytest.approx(y.mean() + (last[code] - x.mean(0)) @ w, rel=1e-9)


def test_lasso_meets_its_optimality_conditions(index):
    alpha = 2e-4
    model = {r.code: np.array(r.weights) for r in regressors.fit(value_samples(index), "Lasso", alpha).collect()}
    for code, (x, y) in arrays(value_samples(index)).items():
        xc, yc = x - x.mean(0), y - y.mean()
        slope = xc.T @ (yc - xc @ model[code]) / len(y)
        on = np.abs(model[code]) > 0
        assert np.all(np.abs(slope) <= alpha * (1 + 1e-3) + 1e-9), code
        assert np.allclose(slope[on], alpha * np.sign(model[code][on]), atol=alpha * 1e-3 + 1e-9), code
    assert any((np.abs(w) > 0).any() for w in model.values())


def test_naive_bayes(samples, windows):
    last = last_windows(windows)
    got = {n: predictions(CLASSIFIERS[n].classify(CLASSIFIERS[n].fit(samples), windows)) for n in CLASSIFIERS if "Bayes" in n}
    for code, (x, y) in arrays(samples).items():
        z, best = last[code], {n: [] for n in got}
        eps = 1e-9 * x.var(0).max()
        for c in np.unique(y):
            xs = x[y == c]
            prior = np.log(len(xs) / len(x))
            var = xs.var(0) + eps
            if eps > 0:
                best["Gaussian Naive Bayes"].append((prior - 0.5 * (np.log(2 * np.pi * var) + (z - xs.mean(0)) ** 2 / var).sum(), -c))
            share = (xs.sum(0) + 1) / (xs.sum() + 14)
            best["Multinomial Naive Bayes"].append((prior + z @ np.log(share), -c))
            best["Bernoulli Naive Bayes"].append((prior + 14 * np.log((len(xs) + 1) / (len(xs) + 2)), -c))
        for n, scores in best.items():
            if scores:
                assert got[n][code] == -max(scores)[1], (n, code)


def test_discriminant(samples, windows):
    model = {r.code: r for r in bayes.fit_discriminant(samples).collect()}
    checked = 0
    for code, (x, y) in arrays(samples).items():
        if len(np.unique(y)) < 2:
            assert code not in model
            continue
        m = [x[y == c].mean(0) for c in (0, 1)]
        xc = np.concatenate([x[y == c] - m[int(c)] for c in (0, 1)])
        if len(x) < 40 or code == "Z":
            continue
        s = xc.T @ xc / (len(x) - 2)
        w = np.linalg.solve(s, m[1] - m[0])
        assert np.allclose(model[code].weights, w, rtol=1e-5, atol=1e-6 * np.abs(w).max()), code
        checked += 1
    assert checked


def test_tree_equals_exhaustive_search(samples, windows):
    model = trees.fit_tree(samples)
    scored = samples.select("code", "date", "features").join(model, "code").withColumn("share", trees.tree_share())
    shares = {(r.code, r.date): r.share for r in scored.collect()}
    got = predictions(trees.classify_trees(model, windows))
    last = last_windows(windows)
    single = lambda a: a.astype(np.float32).astype(float)
    for code, (x, y) in arrays(samples).items():
        tree = brute.gini_tree(single(x), y, np.ones(len(y)), 5)
        assert got[code] == int(brute.descend(tree, single(last[code])) > 0.5), code
        dates = [r.date for r in samples.where(F.col("code") == code).orderBy("date").select("date").collect()]
        for d, row in zip(dates, single(x)):
            assert shares[code, d] == pytest.approx(brute.descend(tree, row)), (code, d)


def test_forest_is_reproducible(samples, windows):
    a = predictions(trees.classify_trees(trees.fit_forest(samples), windows))
    b = predictions(trees.classify_trees(trees.fit_forest(samples.repartition(3)), windows))
    assert a == b and set(a.values()) <= {0, 1}
    assert trees.fit_forest(samples, trees=4).groupBy("code").count().where("count > 4").count() == 0


def boost(x, y, rounds):
    """The update written out sample by sample, on stumps found by exhaustive search."""
    eps = np.finfo(float).eps
    w, stumps = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        tree = brute.gini_tree(x, y, w, 1)
        stumps.append(tree)
        p = np.array([brute.descend(tree, row) for row in x])
        if w[(p > 0.5) != (y > 0.5)].sum() <= 0:
            break
        p = np.clip(p, eps, 1 - eps)
        for i in range(len(y)):
            own, other = (p[i], 1 - p[i]) if y[i] > 0.5 else (1 - p[i], p[i])
            w[i] *= np.exp(-0.5 * (np.log(own) - np.log(other)))
        w /= w.sum()
    return stumps


def test_boosting(samples, windows):
    model = {r.code: r.stumps for r in trees.fit_boosted(samples, rounds=5).collect()}
    for code, (x, y) in arrays(samples).items():
        x = x.astype(np.float32).astype(float)
        want = boost(x, y, 5)
        assert len(model[code]) == len(want), code
        for s, t in zip(model[code], want):
            if isinstance(t, tuple):
                assert (s.f, s.cut) == (t[0], pytest.approx(t[1]))
                assert (s.below, s.above) == (pytest.approx(t[2], abs=1e-8), pytest.approx(t[3], abs=1e-8))
    full = trees.classify_boosted(trees.fit_boosted(samples), windows)
    assert set(predictions(full).values()) <= {0, 1}


@pytest.mark.parametrize("name", ["Decision Tree", "Random Forest", "Gaussian Naive Bayes", "Multinomial Naive Bayes", "Bernoulli Naive Bayes"])
def test_pooled(samples, windows, tmp_path, name):
    model = fit_pooled(samples, name)
    got = predictions(classify_pooled(model, windows))
    save_model(model, str(tmp_path / "m"))
    assert predictions(classify_pooled(load_model(windows.sparkSession, str(tmp_path / "m"), pooled=True), windows)) == got


def test_stored_tables_score_alike(spark, samples, windows, tmp_path):
    for i, (name, kind) in enumerate(CLASSIFIERS.items()):
        model = kind.fit(samples)
        save_model(model, str(tmp_path / str(i)))
        assert predictions(kind.classify(load_model(spark, str(tmp_path / str(i))), windows)) == predictions(kind.classify(model, windows)), name


def test_analysis_of_all_symbols(walks):
    out = analysis.analyse(walks, 240)
    last = out.where("predicted is not null or classified is not null").select("code", "classified", "predicted").collect()
    got = {r.code: r for r in last}
    assert set(got) == {"D", "E", "F", "G", "H", "I", "Z"}
    assert got["D"].classified is None and got["D"].predicted is not None
    assert out.where("code = 'I'").count() == 240
    errors = {r.code: r.bars for r in analysis.analysis_errors(analysis.kept_bars(walks, 240)).collect()}
    assert errors == {"A": 1, "B": 2, "C": 14, "D": 15}


def test_daily_run(spark, walks, tmp_path):
    store = analysis.DailyStore(spark, str(tmp_path / "daily"))
    first = analysis.daily_run(store, walks.where("date < '2019-03-01'"), 1)
    codes = {r.code for r in first.select("code").distinct().collect()}
    landed = walks.where("code in ('H', 'I')")
    again = analysis.daily_run(store, landed, 2)
    assert {r.code for r in again.select("code").distinct().collect()} == codes == {r.code for r in walks.select("code").distinct().collect()}
    assert store.history().where("code = 'I'").count() == 300
    history, enriched = store.history().count(), sorted(map(str, again.collect()))
    want = analysis.analyse(walks.where("code = 'I'"), 240).select("date", "sma25", "predicted").orderBy("date").collect()
    assert again.where("code = 'I'").select("date", "sma25", "predicted").orderBy("date").collect() == want
    for run in (3, 2):  # no news, and a run repeated
        out = analysis.daily_run(store, landed, run)
        assert sorted(map(str, out.collect())) == enriched and store.history().count() == history
    with pytest.raises(ValueError, match="days"):
        analysis.daily_run(store, landed, 4, days=601)
    with pytest.raises(ValueError, match="either"):
        analysis.daily_run(store, landed, 4, days=0)
