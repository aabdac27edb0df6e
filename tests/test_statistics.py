import itertools
import math
import random

import pytest

from sparkassay.operators import composite, significance, summarize

ALGS = ["A", "B", "C"]


def perf(spark, values, metric="Accuracy", dataset="d"):
    rows = [(dataset, a, f, metric, float(v)) for a, vs in values.items() for f, v in enumerate(vs)]
    return spark.createDataFrame(rows, "dataset string, algorithm string, fold int, metric string, value double")


def test_kruskal_hand(spark):
    out = significance.kruskal(perf(spark, {"A": [1, 2, 3], "B": [4, 5, 6], "C": [7, 8, 9]})).first()
    assert out["statistic"] == pytest.approx(7.2) and out["p_value"] == pytest.approx(round(math.exp(-3.6), 6))
    assert out["sig"] == "*"


def test_all_equal(spark):
    same = perf(spark, {"A": [1, 1, 1], "B": [1, 1, 1]})
    for test in (significance.kruskal, significance.wilcoxon_pairs, significance.mann_whitney_pairs):
        out = test(same).first()
        assert (out["statistic"], out["p_value"], out["sig"]) == (None, 1.0, "")


def exact_signed_rank(d):
    d = [v for v in d if v]
    order = sorted(abs(v) for v in d)
    ranks = [order.index(abs(v)) + 1 for v in d]
    t = min(sum(r for r, v in zip(ranks, d) if v > 0), sum(r for r, v in zip(ranks, d) if v < 0))
    every = [sum(r for r, s in zip(range(1, len(d) + 1), signs) if s) for signs in itertools.product([0, 1], repeat=len(d))]
    return t, min(1.0, 2 * sum(e <= t for e in every) / len(every))


def test_wilcoxon_exact(spark):
    rng = random.Random(3)
    a = [rng.random() for _ in range(10)]
    b = [v + rng.gauss(0.1, 0.2) for v in a]
    out = significance.wilcoxon_pairs(perf(spark, {"A": a, "B": b})).first()
    stat, p = exact_signed_rank([x - y for x, y in zip(a, b)])
    assert out["statistic"] == stat and out["p_value"] == pytest.approx(p, abs=1e-6)


def test_wilcoxon_with_zeros_and_many(spark):
    a = [float(i) for i in range(30)]
    b = [v + (1 if i % 3 else -1) for i, v in enumerate(a)]
    b[0] = a[0]
    out = significance.wilcoxon_pairs(perf(spark, {"A": a, "B": b})).first()
    n, down = 29, 9
    stat = down * (n + 1) / 2
    var = n * (n + 1) * (2 * n + 1) / 24 - (n**3 - n) / 48
    p = math.erfc((n * (n + 1) / 4 - stat) / math.sqrt(var) / math.sqrt(2))
    assert out["statistic"] == stat and out["p_value"] == pytest.approx(p, abs=1e-6)


def test_pairs_and_gate(spark):
    table = perf(spark, {"A": [1, 2, 3, 4], "B": [5, 6, 7, 8], "C": [9, 10, 11, 12]}).unionByName(
        perf(spark, {"A": [1, 5, 3], "B": [2, 4, 3], "C": [3, 1, 5]}, "F1_Score")
    )
    pairs = significance.mann_whitney_pairs(table)
    assert pairs.count() == 6
    kept = significance.gated(pairs, significance.kruskal(table))
    assert {r["metric"] for r in kept.collect()} == {"Accuracy"}
    assert {r["statistic"] for r in kept.collect()} == {0.0}


def test_between_datasets(spark):
    table = perf(spark, {"A": [1, 2, 3], "B": [9, 9, 9]}).unionByName(
        perf(spark, {"A": [4, 5, 6], "B": [1, 1, 1]}, dataset="e")
    )
    best = {r["dataset"]: r["algorithm"] for r in significance.best_algorithm(table).collect()}
    assert best == {"d": "B", "e": "A"}
    row = significance.compare_best(table, "kruskal", ["d", "e"]).first()
    assert (row["best_d1"], row["best_d2"], row["mean_d1"], row["mean_d2"]) == ("B", "A", 9.0, 5.0)
    pair = significance.compare_datasets(table, "mann_whitney", ["d", "e"]).where("algorithm = 'A'").first()
    assert (pair["dataset_1"], pair["dataset_2"], pair["statistic"], pair["mean_1"]) == ("d", "e", 0.0, 2.0)


def test_best_algorithm_first_name_on_ties(spark):
    assert significance.best_algorithm(perf(spark, {"B": [1, 2], "A": [2, 1]})).first()["algorithm"] == "A"


def test_summaries(spark):
    table = perf(spark, {"A": [0.5, 0.7]})
    assert summarize.metric_means(table).first()["Accuracy"] == pytest.approx(0.6)
    assert summarize.metric_stds(table).first()["Accuracy"] == pytest.approx(math.sqrt(0.02))
    assert summarize.best_fold(table, "A", "Accuracy").first()["fold"] == 1
    log = spark.createDataFrame([("d", 0, "NB", 1.0), ("d", 1, "NB", 2.5)], "dataset string, fold int, component string, seconds double")
    assert summarize.runtime_summary(log).first()["seconds"] == 3.5
    plan = spark.createDataFrame([("d", 0, "NB"), ("d", 2, "NB")], "dataset string, fold int, component string")
    assert [r["fold"] for r in summarize.missing_runs(plan, log).collect()] == [2]


def test_composite(spark):
    rows = [("d", "A", 0, "x", 4.0), ("d", "A", 0, "y", 1.0), ("d", "B", 0, "x", -1.0), ("d", "B", 0, "y", 2.0)]
    fi = spark.createDataFrame(rows, "dataset string, algorithm string, fold int, feature string, score double")
    full = composite.align_importance(fi, ["x", "y", "z"])
    assert full.where("feature = 'z' and score = 0").count() == 2
    ba = perf(spark, {"A": [0.9, 0.7], "B": [0.5, 0.4]}, "Balanced Accuracy")
    weights = {r["algorithm"]: r["weight"] for r in composite.ba_weight(ba).collect()}
    assert weights["A"] == pytest.approx(0.6) and weights["B"] == 0.0
    means = composite.fi_mean(full)
    assert {r["feature"] for r in composite.fi_nonzero_union(means).collect()} == {"x", "y"}
    top = composite.fi_top(means, ba, 1).first()
    assert top["feature"] == "x" and top["total"] == pytest.approx(0.6)
    bars = {(r["algorithm"], r["feature"]): (r["value"], r["base"]) for r in composite.composite_fi(means, ba, "Norm").collect()}
    assert bars["A", "x"] == (1.0, 0.0) and bars["B", "y"] == (1.0, 0.25) and bars["B", "x"] == (0.0, 1.0)
    frac = {(r["algorithm"], r["feature"]): r["value"] for r in composite.composite_fi(means, ba, "Norm_Frac").collect()}
    assert frac["A", "x"] == pytest.approx(0.8)
    ranks = {(r["algorithm"], r["feature"]): r["rank"] for r in composite.fi_rank_table(full).collect()}
    assert ranks["A", "x"] == 1 and ranks["B", "z"] == 3
    assert composite.fi_boxplot_data(full, 2).count() == 4
