"""Profiling aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkassay.functions.columns import q
from sparkassay.functions.kernels import exact_quantiles, small_side, to_long
from sparkassay.roles import Roles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, sample sd, min, quartiles, max of each numeric column."""
    columns = columns or numeric_columns(df)
    long = to_long(df, [], columns)
    stats = [
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ]
    if approx:
        cuts = F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000))
        out = long.groupBy("feature").agg(*stats, cuts.alias("__q"))
        return out.select(
            "feature", "count", "mean", "std", "min",
            *[F.col("__q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))], "max",
        )
    basic = long.groupBy("feature").agg(*stats)
    cuts = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], len(columns))
    joined = basic.join(small_side(cuts, len(columns)), "feature", "left")
    return joined.select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _unpack(agg_row: DataFrame, names: list[str], key: str, value: str, extra: list[Column] = ()) -> DataFrame:
    """One wide aggregate row -> one row per column name."""
    rows = [F.struct(F.lit(n).alias(key), F.col(f"c{i}").alias(value)) for i, n in enumerate(names)]
    return agg_row.select(F.inline(F.array(*rows)), *extra)


def column_types(df: DataFrame) -> DataFrame:
    rows = [F.struct(F.lit(n).alias("column"), F.lit(t).alias("type")) for n, t in df.dtypes]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def unique_counts(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-missing values per column."""
    columns = columns or df.columns
    if approx:
        agg = df.agg(*[F.approx_count_distinct(q(c)).alias(f"c{i}") for i, c in enumerate(columns)])
        return _unpack(agg, columns, "column", "n_unique")
    typed = dict(df.dtypes)
    kinds: dict[str, list[str]] = {}
    for c in columns:  # whole numbers beyond 2^53 stay apart, so each kind is counted in its own type
        whole = typed[c] in ("int", "bigint", "smallint", "tinyint")
        kinds.setdefault("bigint" if whole else "double" if typed[c] in ("double", "float") else "string", []).append(c)
    out = None
    for kind, names in kinds.items():
        wide = df.select(*[q(c).cast(kind).alias(c) for c in names])
        long = wide.unpivot([], [q(c) for c in names], "column", "value")
        part = long.groupBy("column").agg(F.count_distinct("value").alias("n_unique"))
        out = part if out is None else out.unionByName(part)
    return out


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing cells per column, beside the total over all columns."""
    columns = columns or df.columns
    gaps = missing_cells(df, columns)
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    counts = names.join(gaps, "column", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))
    return counts.withColumn("total_missing", F.sum("missing").over(Window.partitionBy()))


def missing_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, missing`` of the columns with a gap; each row adds the positions of its gaps, so width costs nothing."""
    gaps = F.filter(
        F.transform(F.array(*[q(c).isNull() for c in columns]), lambda gap, at: F.when(gap, at)), lambda at: at.isNotNull()
    )
    names = F.array(*map(F.lit, columns))
    counted = df.select(F.explode(gaps).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("missing"))
    return counted.select(names[F.col("at")].alias("column"), "missing")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, distinct values and missing cells of every column."""
    n = len(df.columns)
    return (
        column_types(df)
        .join(small_side(missing_counts(df), n), "column")
        .join(small_side(unique_counts(df), n), "column", "left")
        .select("column", "type", "missing", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"))
    )


def histogram(df: DataFrame, value: str, bins: int = 100, by: list[str] | None = None, groups: int | None = None) -> DataFrame:
    """Equal-width bins over [min, max] of each group, last bin closed, empty bins kept."""
    by = by or []
    rows = df.where(q(value).isNotNull()).select(*[q(b) for b in by], q(value).cast("double").alias("__v"))
    limits = rows.groupBy(*[q(b) for b in by]).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    flat = F.col("__lo") == F.col("__hi")
    limits = limits.select(
        *[q(b) for b in by],
        F.when(flat, F.col("__lo") - 0.5).otherwise(F.col("__lo")).alias("lo"),
        F.when(flat, F.col("__hi") + 0.5).otherwise(F.col("__hi")).alias("hi"),
    )
    if by:
        placed = rows.join(small_side(limits, groups), by)
    else:
        ends = limits.select(F.struct("lo", "hi").alias("ends")).scalar()
        placed = rows.withColumn("__ends", ends).select("*", F.col("__ends.lo"), F.col("__ends.hi"))
    width = F.col("hi") - F.col("lo")
    spot = F.floor((F.col("__v") - F.col("lo")) / width * F.lit(bins)).cast("int")
    placed = placed.withColumn("bin", F.least(F.greatest(spot, F.lit(0)), F.lit(bins - 1)))
    counts = placed.groupBy(*[q(b) for b in by], "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = limits.where(F.col("lo").isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    step = width / F.lit(bins)
    return grid.join(counts, [*by, "bin"], "left").select(
        *[q(b) for b in by], "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def feature_kinds(df: DataFrame, roles: Roles, cutoff: int = 10, override: tuple[str, ...] = ()) -> DataFrame:
    """categorical when few distinct values, not numeric, or listed; a list replaces detection."""
    names = roles.features(df)
    text = [n for n, t in df.dtypes if n in names and t in ("string", "boolean")]
    counts = unique_counts(df.select(*[q(n) for n in names]), names)
    if override:
        categorical = F.col("column").isin(list(override))
    else:
        categorical = (F.col("n_unique") <= cutoff) | F.col("column").isin(text)
    kind = F.when(categorical, F.lit("categorical")).otherwise(F.lit("quantitative"))
    return counts.select(F.col("column").alias("feature"), kind.alias("kind"), "n_unique")


def kinds_dict(kinds: DataFrame) -> dict[str, list[str]]:
    """The small kinds table as planning input: one row per feature."""
    out: dict[str, list[str]] = {"categorical": [], "quantitative": []}
    for row in kinds.orderBy("feature").collect():
        out[row["kind"]].append(row["feature"])
    return out


def counts_summary(df: DataFrame, roles: Roles, kinds: DataFrame) -> DataFrame:
    """Instances, features by kind, missing cells of all columns and their share of rows x features."""
    n_features = len(roles.features(df))
    gaps = F.aggregate(F.array(*[q(c).isNull().cast("int") for c in df.columns]), F.lit(0), lambda a, x: a + x)
    rows = df.agg(F.count(F.lit(1)).alias("instances"), F.coalesce(F.sum(gaps), F.lit(0)).alias("missing_values"))
    by_kind = kinds.agg(
        F.count_if(F.col("kind") == "categorical").alias("categorical_features"),
        F.count_if(F.col("kind") == "quantitative").alias("quantitative_features"),
    )
    both = by_kind.select(F.struct("categorical_features", "quantitative_features").alias("both")).scalar()
    one = rows.withColumn("features", F.lit(n_features).cast("long")).withColumn("__both", both)
    one = one.select("*", F.col("__both.categorical_features"), F.col("__both.quantitative_features"))
    share = F.round(F.try_divide(F.col("missing_values"), F.col("instances") * F.lit(n_features)), 5)
    order = ["instances", "features", "categorical_features", "quantitative_features", "missing_values"]
    items = [F.struct(F.lit(n).alias("variable"), F.col(n).cast("double").alias("count")) for n in order]
    items.append(F.struct(F.lit("missing_percent").alias("variable"), share.alias("count")))
    return one.select(F.inline(F.array(*items)))


def class_counts(df: DataFrame, roles: Roles) -> DataFrame:
    counts = df.groupBy(q(roles.class_col).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "class")


def no_skill(df: DataFrame, roles: Roles) -> DataFrame:
    """Share of positive instances: the precision of guessing."""
    return df.agg(F.avg(q(roles.class_col).cast("double")).alias("no_skill"))


def contingency(df: DataFrame, features: list[str], class_col: str) -> DataFrame:
    """Rows per (feature, value) in class 0 and class 1; missing values left out."""
    long = to_long(df, [class_col], features).where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(
        F.count_if(q(class_col) == 0).alias("n0"), F.count_if(q(class_col) == 1).alias("n1")
    )


def boxplot_stats(df: DataFrame, value: str, by: list[str], groups: int | None = None) -> DataFrame:
    """Quartiles, whiskers at the last datum within 1.5 IQR, and outliers per group."""
    rows = df.where(q(value).isNotNull()).select(*[q(b) for b in by], q(value).alias("__v"))
    cuts = exact_quantiles(rows, by, "__v", [0.25, 0.5, 0.75], groups, names=["q1", "median", "q3"])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    near = F.col("__v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        rows.join(small_side(cuts, groups), by)
        .groupBy(*[q(b) for b in by], "q1", "median", "q3")
        .agg(
            F.min(F.when(near, F.col("__v"))).alias("whisker_low"),
            F.max(F.when(near, F.col("__v"))).alias("whisker_high"),
            F.count_if(~near).alias("outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def correlation_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present; NULL where one is constant.

    Masked cross-products per Arrow batch, added up by Spark.
    """
    d = len(features)
    center = df.agg(*[F.avg(q(f).cast("double")).alias(f"c{i}") for i, f in enumerate(features)]).first()
    shift = [0.0 if v is None else float(v) for v in center]
    wide = df.select(*[q(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])

    def partial(batches):
        import numpy as np
        import pandas as pd

        total = None
        for batch in batches:
            x = batch.to_numpy(dtype="float64") - np.asarray(shift)
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            m = seen.astype("float64")
            part = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(d)
            cols = dict(zip(["n", "sx", "sy", "sxx", "syy", "sxy"], [t[i, j] for t in total]))
            yield pd.DataFrame({"i": i, "j": j, **cols})

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = wide.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    vx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), F.col("n"))
    vy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), F.col("n"))
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    corr = F.when((F.col("n") > 1) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    names = F.array(*[F.lit(f) for f in features])
    half = sums.select("i", "j", corr.alias("corr"))
    both = half.unionByName(half.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))
    return both.select(names[F.col("i")].alias("feature_1"), names[F.col("j")].alias("feature_2"), "corr")
