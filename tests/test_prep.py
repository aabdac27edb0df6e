import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkassay.operators import folds, iterative, prep
from tests.conftest import FEATURES, KINDS, ROLES

K = 3


def test_mode_smallest_on_ties(spark):
    rows = [(0, 5.0), (1, 2.0), (1, 9.0), (1, 9.0), (2, 2.0), (2, None)]
    df = spark.createDataFrame(rows, "fold int, f double")
    out = {r["cv"]: r["fill"] for r in prep.fit_mode(df, ["f"], 3).collect()}
    assert out == {0: 2.0, 1: 2.0, 2: 9.0}


def test_scaled_training_rows(folded):
    data = prep.preprocess(folded, ROLES, KINDS, K)
    train = data.where("part = 'train'").toPandas()
    for cv, rows in train.groupby("cv"):
        for f in FEATURES:
            assert rows[f].isna().sum() == 0
            assert rows[f].mean() == pytest.approx(0.0, abs=1e-9)
            assert rows[f].std(ddof=0) == pytest.approx(1.0)


def test_closed_form_scaler_equals_filled_data(folded):
    fill = prep.fit_fill(folded, KINDS, K)
    quick = prep.fit_scaler(folded, FEATURES, K, fill)
    slow = prep.fit_scaler_prepared(prep.apply_fill(folds.train_rows(folded, K), fill, FEATURES, K), FEATURES)
    a = {(r["cv"], r["feature"]): (r["mean"], r["scale"]) for r in quick.collect()}
    b = {(r["cv"], r["feature"]): (r["mean"], r["scale"]) for r in slow.collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key])


def test_constant_feature_and_inverse(spark):
    df = spark.createDataFrame([(0, 4.0, 1.0), (1, 4.0, 2.0), (1, 4.0, 6.0)], "fold int, c double, v double")
    scaler = prep.fit_scaler(df, ["c", "v"], 2)
    assert {r["scale"] for r in scaler.where("feature = 'c'").collect()} == {1.0}
    rows = folds.expand_folds(df, 2)
    back = prep.inverse_scale(prep.apply_scaler(rows, scaler, ["c", "v"], 2), scaler, ["c", "v"], 2)
    assert sorted(r["v"] for r in back.collect()) == pytest.approx([1, 1, 2, 2, 6, 6])


def test_test_rows_never_change_the_state(spark, folded):
    """Blowing up fold 1 must leave the state of model index 1 as it was."""
    wild = folded.withColumn("a", F.when(F.col("fold") == 1, 1e6).otherwise(F.col("a"))).withColumn(
        "cat", F.when(F.col("fold") == 1, 9).otherwise(F.col("cat"))
    )
    for fit in (
        lambda d: prep.fit_fill(d, KINDS, K),
        lambda d: prep.fit_scaler(d, FEATURES, K),
        lambda d: iterative.fit_iterative(d, ["a", "b", "noise"], K, max_iter=3).drop("coef"),
    ):
        before = sorted(map(tuple, fit(folded).where("cv = 1").collect()))
        after = sorted(map(tuple, fit(wild).where("cv = 1").collect()))
        assert len(before) == len(after)
        for x, y in zip(before, after):
            assert x[:-1] == pytest.approx(y[:-1]) if not isinstance(x[1], str) else x[:2] == y[:2]
            assert x[-1] == pytest.approx(y[-1])


def test_iterative_recovers_a_linear_feature(folded):
    cols = ["a", "b", "noise"]
    state = iterative.fit_iterative(folded, cols, K)
    full = iterative.apply_iterative(folds.expand_folds(folded, K), state, cols)
    rows = full.join(folded.select("inst_id", F.col("b").alias("b0"), F.col("noise").alias("n0")), "inst_id").toPandas()
    assert rows[cols].isna().sum().sum() == 0
    seen = rows[rows["b0"].notna()]
    assert (seen["b"] == seen["b0"]).all()
    gaps = rows[rows["b0"].isna()]
    assert np.abs(gaps["b"] - 2.0 * gaps["a"]).max() < 0.4


def test_iterative_is_a_fixed_point(spark):
    """At convergence the gaps equal the ridge prediction from the filled rows."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(150, 3)) @ np.array([[1.0, 0.6, 0.2], [0.0, 1.0, 0.5], [0.0, 0.0, 1.0]])
    x[rng.random(x.shape) < 0.12] = np.nan
    rows = [(1, *[None if np.isnan(v) else float(v) for v in r]) for r in x]
    df = spark.createDataFrame(rows, "fold int, a double, b double, c double").repartition(4)
    state = iterative.fit_iterative(df, ["a", "b", "c"], 1 + 0, max_iter=60, tol=1e-9)
    model = iterative.read_state(state, ["a", "b", "c"])[0]
    full, before = iterative.fill_rows(x, *model)
    assert np.abs(full - before).max() < 1e-6
    for t in range(3):
        seen = ~np.isnan(x[:, t])
        other = [i for i in range(3) if i != t]
        z, y = full[seen][:, other], full[seen][:, t]
        zc, yc = z - z.mean(0), y - y.mean()
        w = iterative.bayes_ridge(zc.T @ zc, zc.T @ yc, yc @ yc, seen.sum())
        want = y.mean() + (full[~seen][:, other] - z.mean(0)) @ w
        assert np.abs(want - full[~seen][:, t]).max() < 1e-4


def test_complete_data_need_no_rounds(spark):
    df = spark.createDataFrame([(i % 2, float(i), 2.0 * i) for i in range(10)], "fold int, a double, b double")
    assert not prep.needs_imputation(df, ["a", "b"]).first()["needed"]
    assert iterative.fit_iterative(df, ["a", "b"], 2).where("round > 0").count() == 0


def test_iterative_stays_in_range_with_negative_correlations(spark):
    rng = np.random.default_rng(0)
    cov = np.full((4, 4), -0.31) + np.eye(4) * 1.31
    x = rng.multivariate_normal(np.full(4, 10.0), cov, 1000)
    x[:300, :3] = np.nan
    rows = [(i % 2, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, c double, d double")
    state = iterative.fit_iterative(df, ["a", "b", "c", "d"], 2)
    full = iterative.apply_iterative(folds.expand_folds(df, 2), state, ["a", "b", "c", "d"]).toPandas()
    assert np.abs(full[["a", "b", "c", "d"]].to_numpy() - 10.0).max() < 5.0


def test_needs_imputation_of_a_wide_table(spark):
    names = [f"x{i}" for i in range(3000)]
    df = spark.range(3).selectExpr(*[f"cast(if(id = {i % 3}, null, id) as double) as {n}" for i, n in enumerate(names)])
    assert prep.needs_imputation(df, names).first()["missing"] == 3000


def test_wide_state_fills_scales_and_scores_in_seconds(spark):
    """1,500 features: fill, scale, inverse and naive Bayes are array expressions, equal to plain numpy."""
    import time

    from sparkassay.operators.models import naive_bayes

    d, rng = 1500, np.random.default_rng(5)
    names = [f"f{i}" for i in range(d)]
    values = rng.normal(size=(6, d))
    values[0, :10] = np.nan
    rows = [(i, i % 2, i % 3, *[None if np.isnan(v) else float(v) for v in values[i]]) for i in range(6)]
    schema = "inst_id long, class int, cv int, " + ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame(rows, schema)
    state = spark.createDataFrame(
        [(cv, n, float(cv + i % 7), float(1 + i % 5)) for cv in range(3) for i, n in enumerate(names)],
        "cv int, feature string, mean double, scale double",
    )
    start = time.time()
    filled = prep.apply_fill(df, state.select("cv", "feature", F.col("mean").alias("fill")), names, 3)
    scaled = prep.apply_scaler(filled, state, names, 3)
    back = prep.inverse_scale(scaled, state, names, 3).collect()
    nb_state = spark.createDataFrame(
        [(cv, c, n, float(c), 1.0 + i % 3, 0.5) for cv in range(3) for c in (0, 1) for i, n in enumerate(names)],
        "cv int, class int, feature string, mean double, var double, prior double",
    )
    p = {r["inst_id"]: r["p"] for r in naive_bayes.predict(nb_state, filled, names, 3).collect()}
    took = time.time() - start
    for r in back:
        own = values[r["inst_id"]]
        fill = np.array([r["cv"] + i % 7 for i in range(d)], float)
        assert np.allclose([r[n] for n in names], np.where(np.isnan(own), fill, own))
    for i in range(6):
        x = np.where(np.isnan(values[i]), [i % 3 + j % 7 for j in range(d)], values[i])
        var = 1.0 + np.arange(d) % 3
        joint = [np.log(0.5) - 0.5 * np.log(2 * np.pi * var).sum() - 0.5 * ((x - c) ** 2 / var).sum() for c in (0, 1)]
        assert p[i] == pytest.approx(1 / (1 + np.exp(joint[0] - joint[1])), abs=1e-9)
    assert took < 240
