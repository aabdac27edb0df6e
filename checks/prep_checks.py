"""Imputation, scaling and naive Bayes: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.profile_checks import rounded
from checks.sql_tables import FEATURES, sql
from sparkassay.operators import folds, iterative, prep
from sparkassay.operators.models import naive_bayes
from sparkassay.session import cut_lineage

CAT, QUANT, ROLES, K = fx.CATEGORICAL, fx.QUANTITATIVE, fx.ROLES, fx.K
KINDS = {"categorical": CAT, "quantitative": QUANT}
HEAD = ["cv", "part", "inst_id"]


def filled(s, d):
    base = fx.fold(s, d)
    return prep.apply_fill(folds.expand_folds(base, K), fx.fill_state(s, d), FEATURES, K)


def scaler(s, d):
    base = fx.fold(s, d)
    return prep.fit_scaler(base, FEATURES, K, prep.fit_fill(base, KINDS, K))


def ready(s, d):
    """Prepared rows of all model indexes from the stored state."""
    versions = folds.expand_folds(fx.fold(s, d), K)
    return prep.apply_prep(versions, fx.fill_state(s, d), fx.scaler_state(s, d), FEATURES, K)


def nb_pred(s, d):
    data = ready(s, d)
    state = cut_lineage(naive_bayes.fit(data.where("part = 'train'"), FEATURES), "nb")
    out = naive_bayes.predict(state, data.where("part = 'test'"), FEATURES, K)
    return out.select(F.lit("full").alias("dataset"), F.lit("NB").alias("algorithm"), F.col("cv").alias("fold"),
                      "inst_id", F.col("class").alias("y"), "p")


def imputed_iteratively(s, d):
    base = fx.fold(s, d)
    state = iterative.fit_iterative(base, FEATURES, K)
    full = iterative.apply_iterative(folds.expand_folds(base, K), state, FEATURES)
    return full.groupBy("cv", "part").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in FEATURES],
        *[F.count_if(F.col(f).isNull()).alias(f"gaps_{f}") for f in FEATURES],
    )


QUERIES = {
    "f1_fit_mode": lambda s, d: prep.fit_mode(fx.fold(s, d), CAT, K),
    "f2_fit_median": lambda s, d: rounded(prep.fit_median(fx.fold(s, d), QUANT, K), "fill"),
    "f1_apply_fill": lambda s, d: rounded(filled(s, d).select(*HEAD, *FEATURES), *FEATURES),
    "f3_iterative_imputation": imputed_iteratively,
    "f4_needs_imputation": lambda s, d: prep.needs_imputation(fx.fold(s, d), FEATURES),
    "f5_fit_scaler": lambda s, d: rounded(scaler(s, d), "mean", "scale", digits=5),
    "f5_fit_scaler_unfilled": lambda s, d: rounded(
        prep.fit_scaler(fx.fold(s, d), FEATURES, K), "mean", "scale", digits=5
    ),
    "f5_apply_scaler": lambda s, d: rounded(
        prep.apply_scaler(filled(s, d), fx.scaler_state(s, d), FEATURES, K).select(*HEAD, *FEATURES), *FEATURES, digits=5
    ),
    "f6_inverse_scale": lambda s, d: rounded(
        prep.inverse_scale(ready(s, d), fx.scaler_state(s, d), FEATURES, K).select(*HEAD, *FEATURES), *FEATURES, digits=4
    ),
    "f7_preprocess": lambda s, d: rounded(prep.preprocess(fx.fold(s, d), ROLES, KINDS, K).select(*HEAD, "class", *FEATURES), *FEATURES, digits=5),
    "h1_naive_bayes": lambda s, d: rounded(nb_pred(s, d), "p", digits=5),
    "h1_naive_bayes_state": lambda s, d: rounded(
        naive_bayes.fit(ready(s, d).where("part = 'train'"), FEATURES), "mean", "var", "prior", digits=5
    ),
}

CAT_LIST = "('" + "','".join(CAT) + "')"
FILL = f"""
mode_n AS (SELECT cv, feature, value, count(*) AS n FROM train
  WHERE value IS NOT NULL AND feature IN {CAT_LIST} GROUP BY ALL),
modes AS (SELECT cv, feature, value AS fill FROM mode_n
  QUALIFY row_number() OVER (PARTITION BY cv, feature ORDER BY n DESC, value) = 1),
medians AS (SELECT cv, feature, quantile_cont(value, 0.5) AS fill FROM train
  WHERE value IS NOT NULL AND feature NOT IN {CAT_LIST} GROUP BY ALL),
fills AS (SELECT * FROM modes UNION ALL SELECT * FROM medians),
versions AS (SELECT idx.cv, CASE WHEN fold = idx.cv THEN 'test' ELSE 'train' END AS part, lng.inst_id, lng.class,
  lng.feature, coalesce(value, fill) AS value
  FROM lng CROSS JOIN idx JOIN fills ON fills.cv = idx.cv AND fills.feature = lng.feature),
scaler AS (SELECT cv, feature, avg(value) AS mean,
  CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS scale
  FROM versions WHERE part = 'train' GROUP BY ALL),
scaled AS (SELECT versions.cv, part, inst_id, class, versions.feature, (value - mean) / scale AS value
  FROM versions JOIN scaler ON versions.cv = scaler.cv AND versions.feature = scaler.feature)"""

NB = """
nb0 AS (SELECT cv, class, feature, avg(value) AS mean, var_pop(value) AS v, count(*) AS n
  FROM scaled WHERE part = 'train' GROUP BY ALL),
eps AS (SELECT cv, 1e-9 * max(v) AS e FROM (
  SELECT cv, feature, var_pop(value) AS v FROM scaled WHERE part = 'train' GROUP BY ALL) GROUP BY cv),
nb AS (SELECT nb0.cv, class, feature, mean, v + e AS var, n / sum(n) OVER (PARTITION BY nb0.cv, feature) AS prior
  FROM nb0 JOIN eps ON eps.cv = nb0.cv),
joint_p AS (
  SELECT scaled.cv, inst_id, scaled.class AS y, nb.class AS c,
    max(ln(prior)) + sum(-0.5 * ln(2 * pi() * var) - 0.5 * (value - mean) ** 2 / var) AS l
  FROM scaled JOIN nb ON nb.cv = scaled.cv AND nb.feature = scaled.feature WHERE part = 'test' GROUP BY ALL
),
nb_pred AS (
  SELECT 'full' AS dataset, 'NB' AS algorithm, CAST(cv AS INTEGER) AS fold, inst_id, y,
    1 / (1 + exp(max(l) FILTER (c = 0) - max(l) FILTER (c = 1))) AS p
  FROM joint_p GROUP BY cv, inst_id, y
)"""


def wide(source, extra="", digits=6):
    cols = ", ".join(f"round(max(value) FILTER (feature = '{f}'), {digits}) AS {f}" for f in FEATURES)
    return (
        f"SELECT CAST(cv AS INTEGER) AS cv, part, inst_id{extra}, {cols} FROM {source}"
        f" GROUP BY cv, part, inst_id{extra}"
    )


ORACLES = {
    "f1_fit_mode": sql("train", "SELECT CAST(cv AS INTEGER) AS cv, feature, fill FROM modes", FILL),
    "f2_fit_median": sql(
        "train", "SELECT CAST(cv AS INTEGER) AS cv, feature, round(fill, 6) AS fill FROM medians", FILL
    ),
    "f1_apply_fill": sql("train", wide("versions"), FILL),
    "f4_needs_imputation": sql(
        "long", "SELECT count(*) FILTER (value IS NULL) AS missing, count(*) FILTER (value IS NULL) > 0 AS needed FROM lng"
    ),
    "f5_fit_scaler": sql(
        "train", "SELECT CAST(cv AS INTEGER) AS cv, feature, round(mean, 5) AS mean, round(scale, 5) AS scale FROM scaler",
        FILL
    ),
    "f5_fit_scaler_unfilled": sql(
        "train", "SELECT CAST(cv AS INTEGER) AS cv, feature, round(avg(value), 5) AS mean,"
        " round(stddev_pop(value), 5) AS scale FROM train GROUP BY cv, feature"
    ),
    "f5_apply_scaler": sql("train", wide("scaled", digits=5), FILL),
    "f6_inverse_scale": sql("train", wide("versions", digits=4), FILL),
    "f7_preprocess": sql("train", wide("scaled", ", class", digits=5), FILL),
    "h1_naive_bayes": sql(
        "train", "SELECT dataset, algorithm, fold, inst_id, y, round(p, 5) AS p FROM nb_pred", FILL, NB
    ),
    "h1_naive_bayes_state": sql(
        "train", "SELECT CAST(cv AS INTEGER) AS cv, class, feature, round(mean, 5) AS mean, round(var, 5) AS var,"
        " round(prior, 5) AS prior FROM nb", FILL, NB
    ),
}
