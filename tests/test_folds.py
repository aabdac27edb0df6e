from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkassay.operators import folds
from tests.conftest import ROLES


@pytest.mark.parametrize("method", ["random", "stratified"])
def test_folds_partition_rows(table, method):
    out = folds.make_folds(table, 5, 1, ROLES, method).collect()
    assert len({r["inst_id"] for r in out}) == len(out) == 240
    sizes = Counter(r["fold"] for r in out) if method == "random" else Counter((r["class"], r["fold"]) for r in out)
    groups = defaultdict(list)
    for key, n in sizes.items():
        groups[key[0] if method == "stratified" else "all"].append(n)
    for counts in groups.values():
        assert max(counts) - min(counts) <= 1


def test_row_order_never_matters(table):
    a = folds.stratified_folds(table, 4, 9, ROLES).select("inst_id", "fold").collect()
    b = folds.stratified_folds(table.repartition(7).orderBy(F.rand(3)), 4, 9, ROLES).select("inst_id", "fold").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_match_groups_stay_whole(table):
    groups = {r["inst_id"]: r["match_id"] for r in table.collect()}
    out = folds.matched_folds(table, 3, 1, ROLES)
    assert "match_id" not in out.columns
    seen = defaultdict(set)
    for r in out.collect():
        seen[groups[r["inst_id"]]].add(r["fold"])
    assert all(len(v) == 1 for v in seen.values())
    assert Counter(next(iter(v)) for v in seen.values()) == {0: 20, 1: 20, 2: 20}


def test_hot_match_group_and_null_label(spark):
    rows = [(i, 7 if i < 60 else (None if i < 65 else i), i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "inst_id int, match_id int, class int")
    out = folds.matched_folds(df, 4, 1, ROLES).collect()
    assert len(out) == 100
    assert len({r["fold"] for r in out if r["inst_id"] < 60}) == 1


def test_more_folds_than_rows_of_a_class(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(10)], "inst_id int, class int")
    out = folds.stratified_folds(df, 5, 1, ROLES).collect()
    assert {r["fold"] for r in out if r["class"] == 1} == {0, 1}


def test_samples(table):
    out = folds.stratified_sample(table, 60, 4, ROLES).collect()
    share = table.where("class = 1").count() / 240
    assert len(out) == 60 and abs(sum(r["class"] for r in out) - 60 * share) <= 1
    assert folds.stratified_sample(table, 0, 4, ROLES).count() == 240
    assert folds.stratified_sample(table, 999, 4, ROLES).count() == 240
    assert folds.instance_sample(table, 50, 4, ROLES).count() == 50
    assert folds.instance_sample(table, 5000, 4, ROLES).count() == 240


def test_expand(folded):
    out = folds.expand_folds(folded, 3)
    assert out.count() == 720
    assert out.where("part = 'test'").count() == 240
    assert out.where("part = 'test' and fold <> cv").count() == 0
    assert folds.train_rows(folded, 3).where("fold = cv").count() == 0
    inner = folds.inner_folds(folded.where("fold <> 0"), 1, ROLES)
    assert set(inner.select("inner_fold").distinct().toPandas()["inner_fold"]) == {0, 1, 2}


def test_reserved_names_are_refused(spark, table):
    for name in ("fold", "cv", "part"):
        with pytest.raises(ValueError, match=name):
            folds.random_folds(table.withColumnRenamed("a", name), 3, 1, ROLES)
