"""Association of each feature with the class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.functions.columns import q
from sparkassay.functions.kernels import average_rank, small_side, to_long, value_totals
from sparkassay.functions.tails import chi2_p, two_sided_p
from sparkassay.operators.profile import contingency
from sparkassay.roles import Roles


def chi2_by_feature(df: DataFrame, features: list[str], class_col: str) -> DataFrame:
    """Chi-square independence test; Yates' correction when there is one degree of freedom."""
    cells = contingency(df, features, class_col)
    margins = cells.groupBy("feature").agg(
        F.sum("n0").alias("c0"), F.sum("n1").alias("c1"), F.count(F.lit(1)).alias("rows")
    )
    classes = (F.col("c0") > 0).cast("int") + (F.col("c1") > 0).cast("int")
    margins = margins.withColumn("dof", ((F.col("rows") - 1) * (classes - 1)).cast("int"))
    joined = cells.join(small_side(margins, len(features)), "feature")
    total = F.col("c0") + F.col("c1")

    def term(seen, col_total):
        expected = (F.col("n0") + F.col("n1")) * col_total / total
        gap = F.abs(seen - expected)
        gap = F.when(F.col("dof") == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.when(expected > 0, gap * gap / expected).otherwise(F.lit(0.0))

    stat = joined.groupBy("feature", "dof").agg(
        F.sum(term(F.col("n0"), F.col("c0")) + term(F.col("n1"), F.col("c1"))).alias("statistic")
    )
    stat = stat.withColumn("statistic", F.when(F.col("dof") == 0, F.lit(0.0)).otherwise(F.col("statistic")))
    return stat.select(
        "feature", F.lit("chi2").alias("test"), "statistic", "dof", chi2_p("statistic", "dof").alias("p_value")
    )


def rank_sum_columns(n0, n1, r1, ties):
    """U statistics and the normal score of a rank-sum test from its sums."""
    n = n0 + n1
    u1 = r1 - n1 * (n1 + 1) / 2.0
    u0 = n0 * n1 - u1
    var = n0 * n1 / 12.0 * ((n + 1) - F.try_divide(ties, n * (n - 1)))
    z = F.when(var > 0, (F.greatest(u0, u1) - n0 * n1 / 2.0 - 0.5) / F.sqrt(var))
    return u0, u1, z


def mann_whitney_by_feature(df: DataFrame, features: list[str], class_col: str) -> DataFrame:
    """Rank-sum test of class 0 against class 1; ranks come from counts per distinct value."""
    long = to_long(df, [class_col], features)
    sums = {
        "n": F.count(F.lit(1)),
        "n1": F.count_if(q(class_col) == 1),
    }
    totals = value_totals(long, ["feature"], "value", sums, len(features))
    count = F.col("n").cast("double")
    stat = totals.groupBy("feature").agg(
        (F.max("tot_n") - F.max("tot_n1")).cast("double").alias("n0"),
        F.max("tot_n1").cast("double").alias("n1"),
        F.sum(average_rank(totals, "n") * F.col("n1")).alias("r1"),
        F.sum(count * count * count - count).alias("ties"),
    )
    u0, u1, z = rank_sum_columns(F.col("n0"), F.col("n1"), F.col("r1"), F.col("ties"))
    both = (F.col("n0") > 0) & (F.col("n1") > 0)
    stat = stat.select(
        "feature", F.when(both, u0).alias("u1"), F.when(both, u1).alias("u2"), F.when(both, z).alias("z")
    )
    p = F.coalesce(two_sided_p("z"), F.lit(1.0))
    return stat.select(
        "feature", F.lit("mann_whitney").alias("test"), F.least("u1", "u2").alias("statistic"), "u1", "u2",
        p.alias("p_value"), (p / 2.0).alias("p_one_sided"),
    )


def univariate_tests(df: DataFrame, roles: Roles, kinds: dict[str, list[str]]) -> DataFrame:
    """The test that suits each feature, smallest p first; label columns are never tested."""
    own = ["feature", "test", "statistic", "p_value"]
    parts = []
    if kinds.get("categorical"):
        parts.append(chi2_by_feature(df, kinds["categorical"], roles.class_col).select(*own))
    if kinds.get("quantitative"):
        parts.append(mann_whitney_by_feature(df, kinds["quantitative"], roles.class_col).select(*own))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.orderBy("p_value", "feature")


def top_univariate(tests: DataFrame, n: int = 20) -> DataFrame:
    return tests.orderBy("p_value", "feature").limit(n)
