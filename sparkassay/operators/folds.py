"""Cross-validation folds and samples, reproducible from a seed and the instance label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q, shuffle_number
from sparkassay.functions.kernels import fold_versions, hash_rank, small_side
from sparkassay.operators.clean import resolve_match
from sparkassay.roles import Roles


def _free(df: DataFrame) -> DataFrame:
    """The table, if the names that folds need are free."""
    taken = {"fold", "cv", "part"} & set(df.columns)
    if taken:
        raise ValueError(f"columns named {', '.join(sorted(taken))} clash with those of the folds; rename them")
    return df


def _dealt(rank, k: int):
    return F.pmod(rank - 1, F.lit(k)).cast("int")


def random_folds(df: DataFrame, k: int, seed: int, roles: Roles) -> DataFrame:
    """Round robin over the shuffled rows."""
    ranked = hash_rank(_free(df), seed, roles.inst_col, out="__rank")
    return ranked.withColumn("fold", _dealt(F.col("__rank"), k)).drop("__rank")


def stratified_folds(df: DataFrame, k: int, seed: int, roles: Roles) -> DataFrame:
    """Round robin that starts again at fold 0 in each class."""
    ranked = hash_rank(_free(df), seed, roles.inst_col, [roles.class_col], out="__rank")
    return ranked.withColumn("fold", _dealt(F.col("__rank"), k)).drop("__rank")


def matched_folds(df: DataFrame, k: int, seed: int, roles: Roles) -> DataFrame:
    """Match groups stay whole and are dealt in order of their first shuffled row; the match column goes.

    Only one row per group is ranked. The join back is on a unique side, so a hot
    group is split by the adaptive skew join without copying data rows.
    """
    match = roles.match_col
    _free(df)
    lead = F.min_by(q(roles.inst_col), shuffle_number(seed, q(roles.inst_col)))
    groups = df.groupBy(q(match)).agg(lead.alias("__lead"))
    ranked = hash_rank(groups, seed, "__lead", out="__rank")
    ranked = ranked.select(q(match), _dealt(F.col("__rank"), k).alias("fold"))
    joined = df.alias("d").join(ranked.alias("g"), F.expr(f"d.`{match}` <=> g.`{match}`"))
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns if c != match], F.col("g.fold"))


def make_folds(df: DataFrame, k: int, seed: int, roles: Roles, method: str = "stratified") -> DataFrame:
    method = resolve_match(df, roles, method)
    makers = {"random": random_folds, "stratified": stratified_folds, "matched": matched_folds}
    return makers[method](df, k, seed, roles)


def train_test(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("fold") != fold), df.where(F.col("fold") == fold)


def expand_folds(df: DataFrame, k: int) -> DataFrame:
    """Every row once per model index ``cv``, marked train or test: a narrow explode, no join."""
    cv = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cv")
    part = F.when(F.col("fold") == F.col("cv"), F.lit("test")).otherwise(F.lit("train"))
    return df.select("*", cv).withColumn("part", part)


def train_rows(df: DataFrame, k: int) -> DataFrame:
    """Training rows only, once per model index ``cv``."""
    return df.withColumn("cv", F.explode(fold_versions(F.col("fold"), k)))


def stratified_sample(df: DataFrame, n: int, seed: int, roles: Roles, exact: bool = True) -> DataFrame:
    """n rows with the class shares kept; everything when n is 0 or not below the row count."""
    cls = roles.class_col
    sizes = df.groupBy(q(cls)).agg(F.count(F.lit(1)).alias("__size"))
    every = Window.partitionBy(F.lit(0))
    share = F.lit(float(n)) * F.col("__size") / F.col("__all")
    quotas = sizes.withColumn("__all", F.sum("__size").over(every)).withColumn("__base", F.floor(share))
    rest = F.row_number().over(every.orderBy(F.desc(share - F.col("__base")), q(cls)))
    left = F.lit(n) - F.sum("__base").over(every)
    quota = F.col("__base") + F.when(rest <= left, F.lit(1)).otherwise(F.lit(0))
    whole = (F.lit(n) <= 0) | (F.lit(n) >= F.col("__all"))
    quotas = quotas.select(
        q(cls), F.when(whole, F.col("__size")).otherwise(quota).alias("__quota"), F.col("__size")
    )
    if not exact:
        shares = {r[cls]: min(1.0, r["__quota"] / r["__size"]) for r in quotas.collect()}
        return df.sampleBy(q(cls), shares, seed)
    with_quota = df.join(small_side(quotas.drop("__size"), 64), cls)
    picked = hash_rank(
        with_quota, seed, roles.inst_col, [cls, "__quota"], out="__rank", keep_first=F.col("__quota")
    )
    return picked.select(*[q(c) for c in df.columns])


def instance_sample(df: DataFrame, n: int, seed: int, roles: Roles) -> DataFrame:
    """The first n rows in shuffled order, without replacement."""
    picked = hash_rank(df, seed, roles.inst_col, out="__rank", keep_first=F.lit(n))
    return picked.drop("__rank")


def inner_folds(train: DataFrame, seed: int, roles: Roles, k: int = 3) -> DataFrame:
    """Stratified folds inside a training set, in a column of their own; the outer fold columns go."""
    plain = train.drop("fold", "cv", "part")
    return stratified_folds(plain, k, seed + 1, roles).withColumnRenamed("fold", "inner_fold")
