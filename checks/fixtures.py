"""Analysis tables derived from the given parquet tables, on the Spark side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkassay.operators import prep
from sparkassay.operators.clean import drop_missing_class
from sparkassay.operators.evaluate import evaluate
from sparkassay.operators.folds import stratified_folds
from sparkassay.operators.selection import rank_scores
from sparkassay.roles import Roles
from sparkassay.session import scratch_path
from sparkassay.sources.sinks import write_folds

ROLES = Roles("class", "inst_id", "match_id", "fold")
K = 5
CATEGORICAL = ["f_priority", "f_region", "f_segment", "f_big"]
QUANTITATIVE = ["f_price", "f_acctbal", "f_month"]
FEATURES = CATEGORICAL + QUANTITATIVE
KINDS = {"categorical": CATEGORICAL, "quantitative": QUANTITATIVE}


def feat(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with customer and nation attributes; some cells and classes blanked by key arithmetic."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    key = F.col("o_orderkey")

    def blank(every: int, value):
        return F.when(key % every != 0, value)

    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        key.alias("inst_id"),
        F.col("o_custkey").alias("match_id"),
        blank(97, (F.col("o_orderstatus") == "F").cast("int")).alias("class"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("f_priority"),
        blank(11, F.col("n_regionkey")).alias("f_region"),
        F.length("c_mktsegment").alias("f_segment"),
        (F.col("o_totalprice") > 250000).cast("int").alias("f_big"),
        blank(17, F.col("o_totalprice")).alias("f_price"),
        blank(13, F.col("c_acctbal")).alias("f_acctbal"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("f_month"),
    )


_STORED: dict[tuple, str] = {}


def stored(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A derived table written once per application to the shared folder, as the analysis itself does."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        df = build(spark, sf)
        if "fold" in df.columns and name == "fold":
            write_folds(df, path)
        else:
            df.write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def forget() -> None:
    _STORED.clear()


def fold_plan(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_folds(drop_missing_class(feat(spark, sf), ROLES), K, 42, ROLES)


def fold(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "fold", fold_plan)


def pred(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of three make-believe algorithms on two data sets, every row scored by each."""
    setups = [
        ("full", "A", 1, 4), ("full", "B", 2, 2), ("full", "C", 3, 0),
        ("reduced", "A", 4, 4), ("reduced", "B", 5, 0), ("reduced", "C", 6, 2),
    ]
    setup = F.array(*[
        F.struct(F.lit(d).alias("dataset"), F.lit(a).alias("algorithm"), F.lit(s).alias("s"), F.lit(w).alias("w"))
        for d, a, s, w in setups
    ])
    rows = fold(spark, sf).select("inst_id", "fold", F.col("class").alias("y"), F.inline(setup))
    noise = (F.col("inst_id") * 7919 + F.col("s") * 131) % 1000
    raw = F.col("w") * F.col("y") * 1000 + (F.lit(10) - F.col("w")) * noise
    return rows.select(
        "dataset", "algorithm", "fold", "inst_id", "y",
        F.round(raw.cast("double") / 10000.0, 3).alias("p"),
    )


def perf_plan(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate(pred(spark, sf), groups=6 * K)


def perf(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "perf", perf_plan)


def fi(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "fi", fi_plan)


def fi_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Standardised class difference of each feature in each fold, signed per algorithm."""
    rows = fold(spark, sf).select(
        "fold", "class", *[F.col(f).cast("double").alias(f) for f in FEATURES]
    ).unpivot(["fold", "class"], FEATURES, "feature", "value")
    diff = rows.groupBy("fold", "feature").agg(
        ((F.avg(F.when(F.col("class") == 1, F.col("value"))) - F.avg(F.when(F.col("class") == 0, F.col("value"))))
         / F.stddev_pop("value")).alias("d")
    )
    signs = F.array(*[
        F.struct(F.lit(a).alias("algorithm"), F.lit(m).alias("m")) for a, m in (("A", 1.0), ("B", -2.0), ("C", 0.5))
    ])
    return (
        diff.where(~((F.col("fold") == 2) & (F.col("feature") == "f_month")))
        .select("fold", "feature", "d", F.inline(signs))
        .select(F.lit("full").alias("dataset"), "algorithm", "fold", "feature",
                F.round(F.col("d") * F.col("m"), 6).alias("score"))
    )


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Feature scores of two scorers per fold, ranked."""
    base = fi(spark, sf).where(F.col("algorithm") == "A")
    both = F.array(
        F.struct(F.lit("mi").alias("scorer"), F.round(F.abs("score") - 0.02, 6).alias("s")),
        F.struct(F.lit("ms").alias("scorer"), F.col("score").alias("s")),
    )
    rows = base.select("fold", "feature", F.inline(both))
    return rank_scores(rows.select("fold", F.col("scorer").alias("algorithm"), "feature", F.col("s").alias("score")))


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One line per run; its seconds come from the size of the fold."""
    sizes = fold(spark, sf).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    parts = F.array(*[F.lit(c) for c in ("exploratory", "preprocessing", "NB", "LR")])
    rows = sizes.select("fold", "n", F.posexplode(parts).alias("pos", "component"))
    return rows.select(F.lit("full").alias("dataset"), "fold", "component",
                       (F.col("n") * (F.col("pos") + 1) / 1000.0).alias("seconds"))


def fill_state(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "fill", lambda s, d: prep.fit_fill(fold(s, d), KINDS, K))


def scaler_state(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "scaler", lambda s, d: prep.fit_scaler(fold(s, d), FEATURES, K, fill_state(s, d)))
