import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkassay.functions.columns import digamma
from sparkassay.functions.kernels import to_long
from sparkassay.operators import importance, selection
from tests.conftest import FEATURES, KINDS

EULER = 0.5772156649015329


def psi(n):
    return -EULER + sum(1.0 / i for i in range(1, int(n)))


def brute_mi(x, y, k=3):
    x, y = np.asarray(x, float), np.asarray(y)
    keep = np.array([np.sum(y == c) > 1 for c in y])
    x, y = x[keep], y[keep]
    terms = []
    for i in range(len(x)):
        same = np.sort(np.abs(x[(y == y[i]) & (np.arange(len(x)) != i)] - x[i]))
        ki = min(k, len(same))
        r = same[ki - 1]
        gap = np.abs(x - x[i])
        m = np.sum(gap < r) if r > 0 else np.sum(gap == 0)
        terms.append(psi(ki) - psi(np.sum(y == y[i])) - psi(m))
    return max(0.0, psi(len(x)) + float(np.mean(terms)))


def test_digamma(spark):
    out = spark.createDataFrame([(float(n),) for n in (1, 2, 10, 1000)], "x double").select("x", digamma(F.col("x")).alias("d"))
    for r in out.collect():
        assert r["d"] == pytest.approx(psi(r["x"]), abs=1e-7)


@pytest.mark.parametrize("block", [5, 50_000])
def test_neighbour_mi_brute_force(spark, block):
    """Whole and half-unit grids give ties and zero radii; block 5 exercises the halo."""
    rng = random.Random(1)
    rows = []
    for i in range(160):
        y = int(rng.random() < 0.4)
        x = rng.gauss(y, 1.0)
        rows += [("grid", y, round(x * 2) / 2), ("fine", y, round(x, 3)), ("few", y, float(rng.randint(0, 2)))]
    df = spark.createDataFrame(rows, "feature string, class int, value double")
    out = {r["feature"]: r["score"] for r in importance.mi_knn(df, groups=3, block=block).collect()}
    for f in ("grid", "fine", "few"):
        x, y = zip(*[(v, c) for g, c, v in rows if g == f])
        assert out[f] == pytest.approx(brute_mi(x, y), abs=1e-6), f


def test_small_class(spark):
    """A class of one is left out; one with fewer than k others uses what it has."""
    rows = [("f", 0, float(i)) for i in range(12)] + [("f", 1, 2.2), ("f", 1, 2.4), ("f", 1, 9.0)]
    df = spark.createDataFrame(rows, "feature string, class int, value double")
    want = brute_mi([r[2] for r in rows], [r[1] for r in rows])
    assert importance.mi_knn(df, groups=1).first()["score"] == pytest.approx(want, abs=1e-6)
    lone = df.where("class = 0").unionByName(df.where("value = 9.0 and class = 1"))
    assert importance.mi_knn(lone, groups=1).first()["score"] == pytest.approx(0.0, abs=1e-6)


def test_plug_in_mi(spark):
    rows = [("same", c, float(c)) for c in (0, 1) for _ in range(5)] + [("none", c, 1.0) for c in (0, 1) for _ in range(5)]
    df = spark.createDataFrame(rows, "feature string, class int, value double")
    out = {r["feature"]: r["score"] for r in importance.mi_discrete(df).collect()}
    assert out["same"] == pytest.approx(math.log(2)) and out["none"] == pytest.approx(0.0)


def brute_surf(x, y, discrete):
    x = x.copy()
    for f in range(x.shape[1]):
        if not discrete[f]:
            x[:, f] /= np.ptp(x[:, f])
    n, d = x.shape
    score = np.zeros(d)
    for i in range(n):
        gap = np.abs(x - x[i])
        gap = np.where(discrete, (gap > 0).astype(float), gap)
        dist = gap.sum(1)
        other = np.arange(n) != i
        near = other & (dist < dist[other].mean() - dist[other].std() / 2)
        for f in range(d):
            hit, miss = near & (y == y[i]), near & (y != y[i])
            score[f] += (gap[miss, f].mean() if miss.any() else 0) - (gap[hit, f].mean() if hit.any() else 0)
    return score / n


@pytest.fixture(scope="module")
def scored_rows(table):
    return table.na.fill(0.0).withColumn("cv", F.lit(0)).limit(120).cache()


@pytest.mark.parametrize("block_rows", [30, 512])
def test_multisurf_brute_force(scored_rows, block_rows):
    out = {r["feature"]: r["score"] for r in importance.multisurf(scored_rows, KINDS, block_rows=block_rows, rows_bound=120).collect()}
    pdf = scored_rows.toPandas()
    want = brute_surf(pdf[FEATURES].to_numpy(float), pdf["class"].to_numpy(), np.array([True, False, False, False]))
    for f, w in zip(FEATURES, want):
        assert out[f] == pytest.approx(w, abs=1e-9)


def test_turf_keeps_the_better_half(scored_rows):
    full = {r["feature"]: r["score"] for r in importance.multisurf(scored_rows, KINDS, rows_bound=120).collect()}
    out = importance.turf(scored_rows, KINDS, 0.5, rows_bound=120).collect()
    assert {r["feature"] for r in out} == set(FEATURES)
    best = sorted(full, key=lambda f: (-full[f], f))[:2]
    assert {r["feature"] for r in out if r["rounds"] == 2} == set(best)


def score_table(spark):
    mi = {"a": 0.9, "b": 0.8, "c": 0.1, "d": -0.1}
    ms = {"a": 0.1, "b": -0.2, "c": 0.7, "d": 0.6}
    rows = [(0, "mi", f, s) for f, s in mi.items()] + [(0, "ms", f, s) for f, s in ms.items()]
    return spark.createDataFrame(rows, "fold int, algorithm string, feature string, score double")


def test_selection(spark):
    scores = score_table(spark)
    picks = {r["feature"]: r["pick"] for r in selection.cap_features(scores, 3).collect()}
    assert picks == {"a": 1, "c": 2, "b": 3}
    assert selection.cap_features(scores, 10).count() == 4
    counts = selection.informative_counts(scores.where("algorithm = 'mi'")).first()
    assert (counts["informative"], counts["uninformative"]) == (3, 1)
    assert selection.selected_lists(selection.cap_features(scores, 3), ["d", "c", "b", "a"]) == {0: ["c", "b", "a"]}


def test_rows_are_read_once_for_the_neighbour_score(spark, table):
    seen = spark.sparkContext.accumulator(0)

    def passed(value):
        seen.add(1)
        return value

    value = F.udf(passed, "double").asNondeterministic()
    long = to_long(table, ["class"], ["a", "b"]).withColumn("value", value("value"))
    assert {r["feature"] for r in importance.mi_knn(long, groups=2).collect()} == {"a", "b"}
    assert seen.value == 2 * table.count()
