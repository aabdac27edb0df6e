import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkassay.operators import evaluate as ev


def preds(spark, rows, alg="A", fold=0):
    data = [("d", alg, fold, i, y, float(p)) for i, (y, p) in enumerate(rows)]
    return spark.createDataFrame(data, "dataset string, algorithm string, fold int, inst_id int, y int, p double")


def one(df):
    return df.first().asDict()


def test_hand_counted(spark):
    rows = [(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.2), (0, 0.5)]
    m = one(ev.all_metrics(preds(spark, rows)))
    assert (m["tp"], m["tn"], m["fp"], m["fn"]) == (1, 2, 1, 1)
    assert m["balanced_accuracy"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert m["f1"] == pytest.approx(0.5) and m["npv"] == pytest.approx(2 / 3)
    assert m["lr_plus"] == pytest.approx(0.5 / (1 / 3)) and m["lr_minus"] == pytest.approx(0.5 / (2 / 3))
    assert m["roc_auc"] == pytest.approx(4 / 6)
    assert m["aps"] == pytest.approx(0.5 * 1 + 0.5 * 0.5)


@pytest.mark.parametrize("rows, want", [
    ([(1, 0.9), (1, 0.1)], {"specificity": 0.0, "lr_minus": 0.0, "npv": 0.0, "balanced_accuracy": 0.5}),  # no negatives
    ([(0, 0.1), (0, 0.2)], {"recall": 0.0, "precision": 0.0, "f1": 0.0, "lr_plus": 0.0, "specificity": 1.0}),
    ([(1, 0.9), (0, 0.1)], {"specificity": 1.0, "lr_plus": 0.0, "lr_minus": 0.0, "roc_auc": 1.0, "aps": 1.0}),
    ([(1, 0.9), (0, 0.8)], {"specificity": 0.0, "lr_minus": 0.0, "npv": 0.0, "precision": 0.5}),
])
def test_zero_rules(spark, rows, want):
    m = one(ev.class_metrics(preds(spark, rows)))
    if "roc_auc" in want:
        m.update(one(ev.areas(preds(spark, rows))))
    for name, value in want.items():
        assert m[name] == pytest.approx(value), name


def test_no_skill_scores(spark):
    m = one(ev.all_metrics(preds(spark, [(i % 2, 0.5) for i in range(10)])))
    assert m["roc_auc"] == pytest.approx(0.5) and m["aps"] == pytest.approx(0.5) and m["tp"] == 0


def test_one_class_gives_no_areas(spark):
    for y in (0, 1):
        df = preds(spark, [(y, 0.9), (y, 0.2), (y, 0.6)])
        m = one(ev.all_metrics(df))
        assert m["roc_auc"] is None and m["accuracy"] == pytest.approx(2 / 3 if y else 1 / 3)
        assert ev.evaluate(df).count() == 16
        assert ev.roc_curve(df).count() == 4 and ev.pr_curve(df).count() == 4
        assert ev.mean_curve(df, "roc").count() >= 1


def test_auc_is_the_rank_statistic(spark):
    rng = random.Random(4)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    u = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert one(ev.roc_auc(preds(spark, rows)))["roc_auc"] == pytest.approx(u / len(pos) / len(neg))


def test_curves_start_and_end(spark):
    df = preds(spark, [(1, 0.9), (0, 0.9), (1, 0.3), (0, 0.1)])
    roc = sorted((r["fpr"], r["tpr"]) for r in ev.roc_curve(df).collect())
    assert roc == [(0.0, 0.0), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]
    prc = sorted((r["recall"], r["precision"]) for r in ev.pr_curve(df).collect())
    assert prc[0] == (0.0, 1.0) and (1.0, pytest.approx(2 / 3)) in prc


@pytest.mark.parametrize("kind", ["roc", "prc"])
def test_interpolation_matches_numpy(spark, kind):
    rng = random.Random(6)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(97)]
    df = preds(spark, rows)
    if kind == "roc":
        pts = sorted((r["threshold"] is not None, -(r["threshold"] or 0), r["fpr"], r["tpr"]) for r in ev.roc_curve(df).collect())
    else:
        pts = sorted((r["threshold"] is not None, -(r["threshold"] or 0), r["recall"], r["precision"]) for r in ev.pr_curve(df).collect())
    x, y = [p[2] for p in pts], [p[3] for p in pts]
    grid = np.linspace(0, 1, 100)
    want = np.interp(grid, x, y)
    if kind == "roc":
        want[0] = 0.0
    got = {r["i"]: r["y"] for r in ev.interpolated_curve(df, kind).collect()}
    assert len(got) == 100
    inner = range(1, 99) if kind == "prc" else range(100)
    assert np.allclose([got[i] for i in inner], [want[i] for i in inner])


def test_threshold_edges(spark):
    """t is compared with >=; the fixed threshold with >."""
    df = preds(spark, [(1, 0.29), (0, 0.57), (1, 1.0), (0, 0.0)])
    at = {round(r["threshold"], 2): r for r in ev.threshold_sweep(df).collect()}
    assert len(at) == 101
    assert (at[0.0]["tp"], at[0.0]["fp"]) == (2, 2)
    assert (at[0.29]["tp"], at[0.3]["tp"]) == (2, 1)
    assert (at[0.57]["fp"], at[0.58]["fp"]) == (1, 0)
    assert at[1.0]["tp"] == 1
    assert one(ev.confusion(df, 0.29))["tp"] == 1


def test_every_primary_metric(spark):
    df = preds(spark, [(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.6)])
    for metric in ("balanced_accuracy", "accuracy", "f1", "recall", "precision", "roc_auc"):
        assert 0 <= one(ev.score(df, metric))["score"] <= 1
    with pytest.raises(ValueError):
        ev.score(df, "nonsense")


def test_mean_curve_band(spark):
    df = preds(spark, [(1, 0.9), (0, 0.2)]).unionByName(preds(spark, [(1, 0.1), (0, 0.8)], fold=1))
    out = {round(r["x"], 4): r for r in ev.mean_curve(df, "roc").collect()}
    assert out[1.0]["mean"] == 1.0
    mid = out[round(50 / 99, 4)]
    assert 0 <= mid["lower"] <= mid["mean"] <= mid["upper"] <= 1


def test_case_probabilities(spark):
    df = preds(spark, [(1, 0.9), (0, 0.2)]).unionByName(preds(spark, [(1, 0.3), (0, 0.1)], "B"))
    labels = df.select("inst_id", F.lit("x").alias("label")).distinct()
    out = ev.case_probabilities(df, labels, ["A", "B"]).orderBy("inst_id").collect()
    assert [(r["p_A"], r["p_B"]) for r in out] == [(0.9, 0.3), (0.2, 0.1)]
