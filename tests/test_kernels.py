import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkassay.functions import kernels as kn


def frame(spark, values, key="x"):
    return spark.createDataFrame([(key, v) for v in values], "key string, v double")


@pytest.mark.parametrize("width", ["4", "64", "1000"])
def test_quantiles_match_numpy(spark, width):
    rng = random.Random(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        a = [rng.lognormvariate(0, 3) for _ in range(701)] + [5.0] * 400 + [None] * 9
        b = [float(rng.randint(0, 5)) for _ in range(100)]
        df = frame(spark, a, "a").unionByName(frame(spark, b, "b")).coalesce(4)
        probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
        out = {r["key"]: r for r in kn.exact_quantiles(df, ["key"], "v", probs, 2).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for key, values in (("a", a), ("b", b)):
        want = np.quantile([v for v in values if v is not None], probs)
        assert np.allclose([out[key][f"p{int(p * 100)}"] for p in probs], want)


def test_holdout_quantiles(spark):
    rng = random.Random(5)
    rows = [(i % 3, "f", rng.gauss(0, 1) if i % 7 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "fold int, feature string, value double")
    out = kn.exact_quantiles(df, ["feature"], "value", [0.5], 1, ("fold", 3, "cv"), ["m"]).collect()
    assert len(out) == 3
    for r in out:
        want = np.median([v for f, _, v in rows if f != r["cv"] and v is not None])
        assert r["m"] == pytest.approx(want)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60))
def test_running_totals_and_ranks(spark, values):
    df = frame(spark, [float(v) for v in values])
    totals = kn.value_totals(df, ["key"], "v", {"n": F.count(F.lit(1))}, 1)
    out = totals.withColumn("rank", kn.average_rank(totals, "n")).collect()
    for r in out:
        assert r["cum_n"] == sum(v <= r["v"] for v in values)
        assert r["tot_n"] == len(values)
    assert sum(r["rank"] * r["n"] for r in out) == pytest.approx(len(values) * (len(values) + 1) / 2)


def test_descending_totals(spark):
    df = frame(spark, [1.0, 2.0, 2.0, 7.0])
    out = kn.value_totals(df, ["key"], "v", {"n": F.count(F.lit(1))}, 1, descending=True).collect()
    assert {r["v"]: r["cum_n"] for r in out} == {7.0: 1, 2.0: 3, 1.0: 4}


def test_one_hot_key_and_value(spark):
    """A third of all rows share one value; the rest are distinct."""
    values = [0.5] * 500 + [i / 1000 for i in range(1000)]
    totals = kn.value_totals(frame(spark, values), ["key"], "v", {"n": F.count(F.lit(1))}, 1)
    assert totals.where("v = 0.5").first()["cum_n"] == sum(v <= 0.5 for v in values)
    assert totals.count() == 1000


def test_hash_rank_order(spark):
    df = spark.range(500).withColumnRenamed("id", "i")
    out = kn.hash_rank(df, 7, "i").collect()
    want = sorted(range(500), key=lambda i: (hashlib.md5(f"7|{i}".encode()).hexdigest(), i))
    assert [r["i"] for r in sorted(out, key=lambda r: r["rank"])] == want
    head = kn.hash_rank(df, 7, "i", keep_first=F.lit(17)).collect()
    assert {r["i"] for r in head} == set(want[:17])


def test_buckets_do_not_depend_on_partitioning(spark):
    rng = random.Random(2)
    df = frame(spark, [rng.random() for _ in range(400)])
    one = kn.with_value_bucket(df.repartition(1), ["key"], "v", 1).select("v", kn.BUCKET)
    many = kn.with_value_bucket(df.repartition(13), ["key"], "v", 1).select("v", kn.BUCKET)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    ordered = [b for _, b in sorted(map(tuple, one.collect()))]
    assert ordered == sorted(ordered) and len(set(ordered)) > 8


def test_no_window_over_a_whole_group(spark):
    """Row-level windows are partitioned by bucket as well as by key."""
    df = frame(spark, [float(i) for i in range(50)])
    plan = kn.value_totals(df, ["key"], "v", {"n": F.count(F.lit(1))}, None)._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "Window" in line and "sum(n#" in line]
    assert row_windows and all(kn.BUCKET in line for line in row_windows)
