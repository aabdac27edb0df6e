import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkassay.operators import evaluate, prep
from sparkassay.operators.models import fitted as fm
from sparkassay.operators.models import naive_bayes, nearest, permute, spaces, tune
from sparkassay.session import scratch_path
from tests.conftest import FEATURES, KINDS, ROLES

K = 3


@pytest.fixture(scope="module")
def ready(folded):
    return prep.preprocess(folded, ROLES, KINDS, K).drop("match_id").cache()


@pytest.fixture(scope="module")
def train(ready):
    return ready.where("cv = 0 and part = 'train'").drop("cv", "part").cache()


@pytest.fixture(scope="module")
def held(ready):
    return ready.where("cv = 0 and part = 'test'").drop("cv", "part").cache()


SETUPS = [
    ("NB", {}), ("LR", {"C": 1.0, "class_weight": "balanced"}), ("LR", {"C": 0.5, "penalty": "l1"}),
    ("DT", {"max_depth": 3, "impurity": "entropy"}), ("RF", {"n_trees": 5, "max_depth": 3, "feature_subset": "log2"}),
    ("GB", {"rounds": 3, "column_fraction": 0.8, "class_weight": "positive"}), ("SVM", {"kernel": "linear", "max_iter": 10}),
    ("SVM", {"kernel": "poly", "degree": 2, "max_iter": 10}), ("SVM", {"kernel": "rbf", "max_iter": 10}),
    ("ANN", {"n_layers": 2, "layer_size": 4, "max_iter": 20}), ("KN", {"k": 5, "weights": "distance", "p": 3}),
]


@pytest.mark.parametrize("algorithm, params", SETUPS)
def test_fit_predict_save_load(spark, train, held, algorithm, params):
    model = fm.fit(algorithm, train, ROLES, FEATURES, params)
    out = fm.predictions(model, held, "d", 0).collect()
    assert len(out) == held.count() and all(0 <= r["p"] <= 1 for r in out)
    auc = evaluate.roc_auc(fm.predictions(model, held, "d", 0)).first()["roc_auc"]
    assert auc > 0.6
    path = scratch_path(spark, "model")
    model.save(path)
    again = fm.predictions(fm.load(spark, path), held, "d", 0).collect()
    assert {r["inst_id"]: r["p"] for r in again} == pytest.approx({r["inst_id"]: r["p"] for r in out})


@pytest.mark.parametrize("weights, p", [("uniform", 2), ("distance", 1), ("uniform", 3), ("distance", 4), ("uniform", 5)])
def test_neighbours_brute_force(spark, train, held, monkeypatch, weights, p):
    monkeypatch.setattr(nearest, "CELL_ROWS", 9)
    monkeypatch.setattr(nearest, "BLOCK", 7)
    out = {r["inst_id"]: r["p"] for r in nearest.predict(train, held, FEATURES, 4, weights, p).collect()}
    a, b = train.orderBy("inst_id").toPandas(), held.toPandas()
    x, y = a[FEATURES].to_numpy(float), a["class"].to_numpy()
    for _, row in b.iterrows():
        d = (np.abs(x - row[FEATURES].to_numpy(float)) ** p).sum(1)
        best = np.argsort(d, kind="stable")[:4]
        w = np.ones(4) if weights == "uniform" else 1 / d[best] ** (1 / p)
        assert out[row["inst_id"]] == pytest.approx((w * y[best]).sum() / w.sum())


def test_cells_cut_the_candidates():
    """Rows in tight, distant clusters visit only the cells that can hold their k nearest; the bound is exact."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 100, (20, 4))
    train = np.concatenate([c + rng.normal(0, 1, (50, 4)) for c in centres])
    pivots = train[rng.choice(len(train), 60, replace=False)]
    cell = nearest.to_pivots(train, pivots, 2).argmin(1)
    radius = np.array([nearest.to_pivots(train[cell == c], pivots[c : c + 1], 2).max(initial=0.0) for c in range(60)])
    count = np.bincount(cell, minlength=60)
    queries = centres + rng.normal(0, 1, (20, 4))
    visited = nearest.candidate_cells(queries, pivots, radius, count, 5, 2)
    assert sum(map(len, visited)) < 20 * 60 / 4
    for row, cells in zip(queries, visited):
        best = np.argsort(((train - row) ** 2).sum(1), kind="stable")[:5]
        assert set(cell[best]) <= set(cells)


def test_a_known_distance_cuts_the_cells():
    """Spread rows, where ball bounds reach most cells: the kth distance of one's own cell leaves few; none is lost."""
    rng = np.random.default_rng(4)
    train = np.concatenate([rng.integers(0, 4, (6000, 2)), rng.normal(0, 1, (6000, 2))], axis=1)
    queries = np.concatenate([rng.integers(0, 4, (40, 2)), rng.normal(0, 1, (40, 2))], axis=1)
    feature, cut = nearest.cell_tree(train[:128])
    number, cell, count = np.unique(nearest.to_cells(train, feature, cut), return_inverse=True, return_counts=True)
    assert len(number) > 60 and count.max() < 600
    low = np.array([train[cell == c].min(0) for c in range(len(number))])
    high = np.array([train[cell == c].max(0) for c in range(len(number))])
    bound = np.full(40, np.inf)
    for i, c in enumerate(nearest.to_cells(queries, feature, cut)):
        own = train[number[cell] == c]
        if len(own) >= 5:
            bound[i] = nearest.nearest_rows(queries[i : i + 1], own, np.array([np.inf]), 5, 2)[2][-1]
    visited = nearest.reachable_cells(queries, bound, low, high, count, 5, 2)
    assert sum(map(len, visited)) < 40 * len(number) / 8
    d = ((queries[:, None] - train[None]) ** 2).sum(2)
    for i, cells in enumerate(visited):
        assert set(cell[np.argsort(d[i], kind="stable")[:5]]) <= set(cells)


def test_nearest_rows_in_a_block_with_ties():
    rng = np.random.default_rng(5)
    z, x = rng.integers(0, 5, (3000, 3)).astype(float), rng.integers(0, 5, (50, 3)).astype(float)
    row, col, _ = nearest.nearest_rows(x, z, np.full(50, np.inf), 7, 2)
    for i in range(50):
        best = np.argsort(((z - x[i]) ** 2).sum(1), kind="stable")[:7]
        assert list(col[row == i]) == list(best)


def test_neighbours_at_distance_zero(spark, train):
    same = nearest.predict(train, train, FEATURES, 3, "distance", 2).collect()
    assert all(r["p"] in (0.0, 1.0) for r in same)


def test_weights(train):
    rows = {r["class"]: r for r in fm.class_weights(train).collect()}
    n0, n1 = rows[0]["n"], rows[1]["n"]
    assert rows[1]["balanced"] == pytest.approx((n0 + n1) / (2 * n1))
    assert rows[1]["positive"] == pytest.approx(n0 / n1) and rows[0]["positive"] == 1.0


@pytest.mark.parametrize("kernel,width", [("linear", 4), ("poly", 14), ("rbf", 64)])
def test_training_rows_are_dealt_by_their_bytes(train, held, monkeypatch, kernel, width):
    """One stored part holds all rows: a fit keeps no more than a bounded share of them in one task."""
    seen = []
    spread = fm._spread
    monkeypatch.setattr(fm, "_spread", lambda rows, n, w: seen.append((w, spread(rows, n, w).rdd.getNumPartitions())) or spread(rows, n, w))
    monkeypatch.setattr(fm, "PART_BYTES", 4000)
    one, n = train.coalesce(1), train.count()
    fm.fit("SVM", one, ROLES, FEATURES, {"kernel": kernel, "degree": 2, "max_iter": 2, "n_random": 64})
    fm.fit("DT", one, ROLES, FEATURES, {"max_depth": 2})
    assert seen == [(w, -(-n * (8 * w + 200) // 4000)) for w in (width, 4)]
    monkeypatch.setattr(fm, "PART_BYTES", 32 << 20)
    assert spread(one, n, width) is one


def test_naive_bayes_scores_in_batches(spark):
    """One pass in Arrow batches, no array function per row; missing cells and classes as before."""
    state = spark.createDataFrame([
        (0, 0, "f", 0.0, 1.0, 0.5), (0, 1, "f", 2.0, 1.0, 0.5), (1, 0, "f", 0.0, 1.0, 1.0), (2, 1, "f", 0.0, 1.0, 1.0),
    ], "cv int, class int, feature string, mean double, var double, prior double")
    rows = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, None), (1, 5.0), (2, 5.0), (3, 5.0), (None, 5.0)], "cv int, f double")
    out = naive_bayes.predict(state, rows, ["f"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan
    got = [r["p"] for r in out.collect()]
    assert got[:2] == [0.5, pytest.approx(1 / (1 + np.exp(-2.0)))] and got[2:] == [None, 0.0, 1.0, 0.0, 0.0]


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100):
        for a, b in permute.partners(n, 3, 1):
            assert sorted((r * a + b) % n for r in range(n)) == list(range(n))
    df = spark.createDataFrame([(i, i % 2, float(i), float(-i)) for i in range(20)], "inst_id int, class int, f double, g double")
    out = permute.permuted_rows(df, ["f", "g"], "inst_id", "class", 2, 5).toPandas()
    assert len(out) == 80
    for (feature, _), rows in out.groupby(["feature", "repeat"]):
        assert sorted(rows["f"]) == [float(i) for i in range(20)]
        other = "g" if feature == "f" else "f"
        assert (rows[other].abs() == rows["inst_id"]).all()


@pytest.mark.parametrize("algorithm", ["NB", "DT", "KN"])
def test_permutation_importance(train, algorithm):
    model = fm.fit(algorithm, train, ROLES, FEATURES, {})
    out = {r["feature"]: r["score"] for r in permute.permutation_importance(model, train, n_repeats=3).collect()}
    assert set(out) == set(FEATURES)
    assert max(out["a"], out["b"], out["cat"]) > out["noise"] - 0.02


def test_native_importance(train):
    assert set(fm.fit("LR", train, ROLES, FEATURES, {}).native_importance()) == set(FEATURES)
    assert sum(fm.fit("DT", train, ROLES, FEATURES, {}).native_importance().values()) == pytest.approx(1.0)
    assert fm.fit("NB", train, ROLES, FEATURES, {}).native_importance() is None


def test_sweep_is_reproducible(train):
    space = {"max_depth": ("int", 1, 4), "min_leaf": ("int", 1, 9)}
    a = tune.sweep(train, "DT", ROLES, FEATURES, 3, space=space).orderBy("trial").collect()
    b = tune.sweep(train, "DT", ROLES, FEATURES, 3, space=space, parallel=1).orderBy("trial").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert {r["status"] for r in a} == {"done"}


def test_sweep_limits(spark, train):
    assert tune.sweep(train, "NB", ROLES, FEATURES).first()["status"] == "single"
    late = tune.sweep(train, "DT", ROLES, FEATURES, 2, timeout=-1.0).collect()
    assert {r["status"] for r in late} == {"not started"}
    rows = [(0, "p0", 0.7, "done"), (1, "p1", 0.9, "done"), (2, "p2", 0.9, "done"), (3, "p3", None, "failed")]
    assert tune.best_params(spark.createDataFrame(rows, tune.TRIALS)).first()["params"] == "p1"


def test_draws_stay_in_range():
    rng = random.Random(0)
    for name, space in spaces.SPACES.items():
        for _ in range(50):
            for key, value in spaces.draw(space, rng).items():
                kind, *limits = space[key]
                assert value in limits if kind == "choice" else limits[0] <= value <= limits[1], (name, key)


def test_grid_reports_failures(train):
    views = {0: (train, FEATURES), 1: (train, ["absent"])}
    models, log = tune.train_all(views, ["NB"], ROLES, parallel=2)
    assert set(models) == {(0, "NB")}
    assert {r["fold"]: r["status"].split(":")[0] for r in log.collect()} == {0: "done", 1: "failed"}


def test_tuned_fit(train):
    space = {"max_depth": ("int", 1, 3)}
    model = tune.train_one(train, "DT", ROLES, FEATURES, n_trials=2, space=space)
    assert 1 <= model.params["max_depth"] <= 3
    assert json.dumps(model.params)
    assert tune.train_one(train.withColumn("x", F.lit(1)), "KN", ROLES, FEATURES, subsample=40).table.count() == 40
