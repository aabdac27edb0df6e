import math
import random

import numpy as np
import pytest

from sparkassay.operators import clean, profile, univariate
from sparkassay.roles import Roles
from tests.conftest import FEATURES, KINDS, ROLES


def test_clean(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1.0, None), (3, 0.0, 1.0)], "inst_id int, class double, f double")
    roles = Roles()
    kept = clean.drop_missing_class(df, roles)
    assert [tuple(r) for r in kept.orderBy("inst_id").collect()] == [(2, 1, None), (3, 0, 1.0)]
    assert clean.drop_missing_class(df, roles, drop_all_missing=True).count() == 1
    with pytest.raises(ValueError):
        clean.drop_features(df, ["nope"])
    with pytest.raises(ValueError):
        clean.align_to(["f", "g"], df, roles)
    with pytest.warns(UserWarning):
        assert clean.resolve_match(df, roles, "matched") == "stratified"


def test_table_without_instance_label(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (1, 1.0)], "class int, f double").repartition(3)
    named, roles = clean.ensure_instance(df, Roles("class", None))
    ids = [r["instance"] for r in named.collect()]
    assert roles.inst_col == "instance" and len(set(ids)) == 3
    assert sorted(ids) == sorted(r["instance"] for r in named.collect())
    assert clean.ensure_instance(named, roles)[1] == roles


def test_awkward_names(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 5.0), (2, 1, None, 6.0)], "inst_id int, class int, `Iron (%)` double, `a.b ` double")
    out = {r["feature"]: r for r in profile.describe(df, ["Iron (%)", "a.b "]).collect()}
    assert out["a.b "]["p50"] == 5.5 and out["Iron (%)"]["count"] == 1
    kinds = {r["feature"]: r["kind"] for r in profile.feature_kinds(df, Roles(), 1).collect()}
    assert kinds == {"Iron (%)": "categorical", "a.b ": "quantitative"}
    listed = profile.feature_kinds(df, Roles(), 1, ("a.b ",)).collect()
    assert {r["feature"]: r["kind"] for r in listed} == {"Iron (%)": "quantitative", "a.b ": "categorical"}


def test_describe_all_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    out = {r["feature"]: r for r in profile.describe(df).collect()}
    assert out["b"]["p25"] == 1.5 and out["a"]["count"] == 0 and out["a"]["p50"] is None
    unique = {r["column"]: r["n_unique"] for r in profile.unique_counts(df).collect()}
    assert unique == {"a": 0, "b": 2}


def test_text_columns_are_categorical(spark):
    rows = [(i, i % 2, f"v{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "inst_id int, class int, t string")
    assert profile.feature_kinds(df, Roles()).first()["kind"] == "categorical"


def test_histogram_flat_and_closed_end(spark):
    flat = spark.createDataFrame([(3.0,)] * 4, "v double")
    out = profile.histogram(flat, "v", 2).collect()
    assert sorted((r["bin"], r["n"], r["bin_start"]) for r in out) == [(0, 0, 2.5), (1, 4, 3.0)]
    rows = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    assert sorted((r["bin"], r["n"]) for r in profile.histogram(rows, "v", 5).collect()) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]


def test_correlations_agree(spark, table):
    """Summed cross-products and pandas on pairwise complete rows."""
    cols = ["a", "b", "noise"]
    found = {(r["feature_1"], r["feature_2"]): r["corr"] for r in profile.correlation_matrix(table, cols).collect()}
    x = table.select(*cols).toPandas().corr()
    for i in cols:
        for j in cols:
            assert found[i, j] == pytest.approx(x.loc[i, j])


@pytest.mark.parametrize("n", [3, 6])
def test_correlation_with_a_constant_is_missing(spark, n):
    names = [f"x{i}" for i in range(n)]
    df = spark.range(20).selectExpr("7.0D AS x0", *[f"cast(id % {i + 2} as double) AS x{i}" for i in range(1, n)])
    found = {(r["feature_1"], r["feature_2"]): r["corr"] for r in profile.correlation_matrix(df, names).collect()}
    assert len(found) == n * n and found["x0", "x1"] is None and found["x1", "x1"] == pytest.approx(1.0)


def test_large_whole_numbers_and_wide_tables(spark):
    df = spark.createDataFrame([(2**53, 1.0), (2**53 + 1, 1.0)], "big long, d double")
    assert {r["column"]: r["n_unique"] for r in profile.unique_counts(df).collect()} == {"big": 2, "d": 1}
    names = [f"x{i}" for i in range(3000)]
    wide = spark.range(2).selectExpr(*[f"if(id = 0, null, {i}) AS {n}" for i, n in enumerate(names)])
    rows = profile.missing_counts(wide).collect()
    assert len(rows) == 3000 and {(r["missing"], r["total_missing"]) for r in rows} == {(1, 3000)}


def test_chi2_yates_and_degenerate(spark):
    rows = [(0, 0, 1)] * 10 + [(0, 1, 1)] * 20 + [(1, 0, 1)] * 30 + [(1, 1, 1)] * 5
    df = spark.createDataFrame(rows, "class int, f int, flat int")
    out = {r["feature"]: r for r in univariate.chi2_by_feature(df, ["f", "flat"], "class").collect()}
    o = np.array([[10, 20], [30, 5]], float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    want = ((np.abs(o - e) - 0.5) ** 2 / e).sum()
    assert out["f"]["statistic"] == pytest.approx(want)
    assert out["f"]["p_value"] == pytest.approx(math.erfc(math.sqrt(want / 2)))
    assert (out["flat"]["statistic"], out["flat"]["p_value"]) == (0.0, 1.0)


def test_mann_whitney_brute_force(spark):
    rng = random.Random(8)
    rows = [(i % 2, float(rng.randint(0, 9)) + 2 * (i % 2) if i % 13 else None, 4.0) for i in range(90)]
    df = spark.createDataFrame(rows, "class int, f double, flat double")
    out = {r["feature"]: r for r in univariate.mann_whitney_by_feature(df, ["f", "flat"], "class").collect()}
    zero = [v for c, v, _ in rows if c == 0 and v is not None]
    one = [v for c, v, _ in rows if c == 1 and v is not None]
    u = sum((a > b) + 0.5 * (a == b) for a in zero for b in one)
    assert out["f"]["u1"] == pytest.approx(u)
    assert out["f"]["u1"] + out["f"]["u2"] == len(zero) * len(one)
    assert out["f"]["p_one_sided"] == pytest.approx(out["f"]["p_value"] / 2)
    assert out["flat"]["p_value"] == 1.0


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "class int, f double")
    r = univariate.mann_whitney_by_feature(df, ["f"], "class").first()
    assert r["statistic"] is None and r["p_value"] == 1.0


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(0, 1.0)], "class int, f double")
    assert univariate.mann_whitney_by_feature(one, ["f"], "class").first()["p_value"] == 1.0
    assert univariate.chi2_by_feature(one, ["f"], "class").first()["p_value"] == 1.0
    roles = Roles("class", None)
    empty = one.where("f > 5")
    counts = {r["variable"]: r["count"] for r in profile.counts_summary(empty, roles, profile.feature_kinds(one, roles)).collect()}
    assert counts["instances"] == 0 and counts["missing_percent"] is None


def test_tests_skip_labels_and_sort(table):
    out = univariate.univariate_tests(table, ROLES, KINDS).collect()
    assert {r["feature"] for r in out} == set(FEATURES)
    p = [r["p_value"] for r in out]
    assert p == sorted(p)
    assert [r["feature"] for r in univariate.top_univariate(univariate.univariate_tests(table, ROLES, KINDS), 2).collect()] == [
        r["feature"] for r in out[:2]
    ]
