"""Rank tests between algorithms or data sets on the per-fold metric table.

``PERF = (dataset, algorithm, fold, metric, value)`` has runs x 16 rows, so windows per
metric are small whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q, sig_flag
from sparkassay.functions.tails import chi2_p, signed_rank_p, two_sided_p
from sparkassay.operators.univariate import rank_sum_columns

SIX = 6


def _exact(value: Column) -> Column:
    """Values that differ only by the last bits of a division count as tied."""
    return F.round(value, 12)


def _others(by: str) -> list[str]:
    """What stays fixed while ``by`` varies."""
    return ["dataset", "metric"] if by == "algorithm" else ["algorithm", "metric"]


def _ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Average rank ``r`` and tie size ``t`` of each row within keys."""
    group = Window.partitionBy(*[q(k) for k in keys])
    ties = Window.partitionBy(*[q(k) for k in keys], q(value))
    out = df.withColumn("t", F.count(F.lit(1)).over(ties).cast("double"))
    return out.withColumn("r", F.rank().over(group.orderBy(q(value))) + (F.col("t") - 1) / 2.0)


def kruskal(perf: DataFrame, by: str = "algorithm", cutoff: float = 0.05, keys: list[str] | None = None) -> DataFrame:
    """Kruskal-Wallis H over the groups of ``by`` for each metric; all equal gives (NULL, 1)."""
    keys = keys or _others(by)
    known = perf.where(F.col("value").isNotNull()).withColumn("value", _exact(F.col("value")))
    ranked = _ranked(known, keys, "value")
    per_group = ranked.groupBy(*[q(k) for k in keys], q(by)).agg(
        F.sum("r").alias("rs"), F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("t") * F.col("t") - 1).alias("tie")
    )
    h = per_group.groupBy(*[q(k) for k in keys]).agg(
        F.sum(F.col("rs") * F.col("rs") / F.col("n")).alias("s"), F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("g"), F.sum("tie").alias("tie"),
    )
    n = F.col("n")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    spread = 1 - F.try_divide(F.col("tie"), n * n * n - n)
    stat = F.when((F.col("g") > 1) & (spread > 0), raw / spread)
    h = h.select(*[q(k) for k in keys], stat.alias("h"), (F.col("g") - 1).alias("dof"))
    p = F.coalesce(chi2_p("h", "dof"), F.lit(1.0))
    return h.select(
        *[q(k) for k in keys], F.round("h", SIX).alias("statistic"), p.alias("__p")
    ).select(
        *[q(k) for k in keys], "statistic", F.round("__p", SIX).alias("p_value"),
        sig_flag(F.col("__p"), cutoff).alias("sig"),
    )


def _pairs(perf: DataFrame, by: str, keys: list[str], paired: bool) -> DataFrame:
    """Values of both members of each unordered pair, joined on metric (and fold)."""
    rest = [*keys, "fold"] if paired else keys
    a = perf.select(*[q(k) for k in [*keys, "fold"]], q(by).alias("a"), _exact(F.col("value")).alias("va"))
    b = perf.select(*[q(k) for k in [*keys, "fold"]], q(by).alias("b"), _exact(F.col("value")).alias("vb"))
    if not paired:
        b = b.drop("fold")
    return a.join(b, rest).where(F.col("a") < F.col("b"))


def wilcoxon_pairs(
    perf: DataFrame, by: str = "algorithm", cutoff: float = 0.05, keys: list[str] | None = None
) -> DataFrame:
    """Signed-rank test on fold-paired values of each pair; identical values give (NULL, 1)."""
    keys = keys or _others(by)
    pairs = _pairs(perf, by, keys, True).withColumn("d", F.col("va") - F.col("vb"))
    own = [*keys, "a", "b"]
    zeros = pairs.groupBy(*[q(k) for k in own]).agg(F.count_if(F.col("d") == 0).alias("zeros"))
    moved = pairs.where(F.col("d") != 0).withColumn("size", F.round(F.abs("d"), 12))
    ranked = _ranked(moved, own, "size")
    sums = ranked.groupBy(*[q(k) for k in own]).agg(
        F.sum(F.when(F.col("d") > 0, F.col("r")).otherwise(0.0)).alias("up"),
        F.sum(F.when(F.col("d") < 0, F.col("r")).otherwise(0.0)).alias("down"),
        F.count(F.lit(1)).alias("n"), F.sum(F.col("t") * F.col("t") - 1).alias("tie"),
    )
    both = zeros.join(sums, own, "left").withColumn("statistic", F.least("up", "down"))
    p = signed_rank_p("statistic", "n", "zeros", "tie")
    return _finish(both.withColumn("__p", p), own, by, cutoff)


def mann_whitney_pairs(
    perf: DataFrame, by: str = "algorithm", cutoff: float = 0.05, keys: list[str] | None = None
) -> DataFrame:
    """Rank-sum test of each pair; all values equal give (NULL, 1)."""
    keys = keys or _others(by)
    names = perf.select(*[q(k) for k in keys], q(by).alias("g")).distinct()
    pairs = names.withColumnRenamed("g", "a").join(names.withColumnRenamed("g", "b"), keys).where("a < b")
    values = perf.select(*[q(k) for k in keys], q(by).alias("g"), _exact(F.col("value")).alias("value"))
    own = [*keys, "a", "b"]
    rows = pairs.join(values, keys).where((F.col("g") == F.col("a")) | (F.col("g") == F.col("b")))
    ranked = _ranked(rows, own, "value")
    second = F.col("g") == F.col("b")
    sums = ranked.groupBy(*[q(k) for k in own]).agg(
        F.count_if(~second).cast("double").alias("n0"), F.count_if(second).cast("double").alias("n1"),
        F.sum(F.when(second, F.col("r")).otherwise(0.0)).alias("r1"), F.sum(F.col("t") * F.col("t") - 1).alias("tie"),
    )
    u0, u1, z = rank_sum_columns(F.col("n0"), F.col("n1"), F.col("r1"), F.col("tie"))
    out = sums.select(*[q(k) for k in own], F.least(u0, u1).alias("u"), z.alias("z"))
    out = out.withColumn("statistic", F.when(F.col("z").isNotNull(), F.col("u")))
    return _finish(out.withColumn("__p", F.coalesce(two_sided_p("z"), F.lit(1.0))), own, by, cutoff)


def _finish(df: DataFrame, own: list[str], by: str, cutoff: float) -> DataFrame:
    first, second = f"{by}_1", f"{by}_2"
    return df.select(
        *[q(k) for k in own[:-2]], F.col("a").alias(first), F.col("b").alias(second),
        F.round("statistic", SIX).alias("statistic"), F.round("__p", SIX).alias("p_value"),
        sig_flag(F.col("__p"), cutoff).alias("sig"),
    )


def gated(pairs: DataFrame, kruskal_table: DataFrame) -> DataFrame:
    """Pair tests only where the group test is significant."""
    keys = [c for c in ("dataset", "algorithm", "metric") if c in pairs.columns and c in kruskal_table.columns]
    return pairs.join(kruskal_table.where(F.col("sig") == "*").select(*keys), keys, "left_semi")


# --- between data sets ---------------------------------------------------------------------

PAIR_TESTS = {"wilcoxon": wilcoxon_pairs, "mann_whitney": mann_whitney_pairs}


def _moments(perf: DataFrame, keys: list[str]) -> DataFrame:
    return perf.groupBy(*[q(k) for k in keys]).agg(
        F.round(F.avg("value"), SIX).alias("mean"), F.round(F.stddev_samp("value"), SIX).alias("std")
    )


def _with_sides(pairs: DataFrame, stats: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """Attach each side's mean, sd (and algorithm) to a pair table."""
    out = pairs
    for side in ("1", "2"):
        own = stats.select(
            *[q(k) for k in keys], F.col("dataset").alias(f"dataset_{side}"),
            *[q(c).alias(f"{c}_{side}") for c in [*extra, "mean", "std"]],
        )
        out = out.join(own, [*keys, f"dataset_{side}"])
    return out


def _spread(stats: DataFrame, keys: list[str], datasets: list[str], columns: list[str]) -> DataFrame:
    """One row per key with each data set's columns side by side."""
    picks = [
        F.max(F.when(F.col("dataset") == d, q(c))).alias(f"{c}_d{i}")
        for i, d in enumerate(datasets, 1)
        for c in columns
    ]
    return stats.groupBy(*[q(k) for k in keys]).agg(*picks)


def compare_datasets(perf: DataFrame, test: str, datasets: list[str], cutoff: float = 0.05) -> DataFrame:
    """Per algorithm and metric: do data sets differ? With mean and sd of each side."""
    keys = ["algorithm", "metric"]
    stats = _moments(perf, ["dataset", *keys])
    if test == "kruskal":
        wide = _spread(stats, keys, datasets, ["mean", "std"])
        return kruskal(perf, "dataset", cutoff).join(wide, keys)
    return _with_sides(PAIR_TESTS[test](perf, "dataset", cutoff), stats, keys, [])


def best_algorithm(perf: DataFrame) -> DataFrame:
    """Algorithm with the largest mean per data set and metric, first name on ties."""
    means = perf.groupBy("dataset", "metric", "algorithm").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    order = Window.partitionBy("dataset", "metric").orderBy(F.desc(F.round("mean", 12)), "algorithm")
    best = means.withColumn("rn", F.row_number().over(order)).where(F.col("rn") == 1)
    return best.select("dataset", "metric", "algorithm", F.round("mean", SIX).alias("mean"), F.round("std", SIX).alias("std"))


def compare_best(perf: DataFrame, test: str, datasets: list[str], cutoff: float = 0.05) -> DataFrame:
    """The same tests on each data set's best algorithm."""
    best = best_algorithm(perf).withColumnRenamed("algorithm", "best")
    picked = perf.join(
        best.select("dataset", "metric", F.col("best").alias("algorithm")), ["dataset", "metric", "algorithm"], "left_semi"
    )
    if test == "kruskal":
        wide = _spread(best, ["metric"], datasets, ["best", "mean", "std"])
        return kruskal(picked, "dataset", cutoff, ["metric"]).join(wide, "metric")
    pairs = PAIR_TESTS[test](picked, "dataset", cutoff, ["metric"])
    return _with_sides(pairs, best, ["metric"], ["best"])

