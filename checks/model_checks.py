"""Models, tuning, importances, replication, report tables and files: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.prep_checks import FILL, NB, nb_pred, ready
from checks.profile_checks import rounded
from checks.sql_tables import CURVE, FEATURES, METRIC_COLUMNS, PERF, sql
from checks.summary_checks import BEST, PERF_R, SIMPSON, kruskal_cte
from sparkassay.operators import clean, evaluate, folds, prep, profile, replication, summarize
from sparkassay.operators.models import fitted as fm
from sparkassay.operators.models import tune
from sparkassay.operators.models.permute import permutation_importance
from sparkassay.plans import report
from sparkassay.session import cut_lineage, scratch_path
from sparkassay.sources import readers, sinks

CAT, QUANT, ROLES, K = fx.CATEGORICAL, fx.QUANTITATIVE, fx.ROLES, fx.K
KINDS = {"categorical": CAT, "quantitative": QUANT}
METRICS = [m for m, _ in METRIC_COLUMNS]


def prepared(s, d):
    """The prepared fold table of all model indexes, stored once."""
    return fx.stored(s, d, "prepared", lambda s, d: ready(s, d).drop("match_id"))


def train(s, d, cv=0):
    return prepared(s, d).where((F.col("cv") == cv) & (F.col("part") == "train")).drop("cv", "part")


def test(s, d, cv=0):
    return prepared(s, d).where((F.col("cv") == cv) & (F.col("part") == "test")).drop("cv", "part")


def model_query(algorithm, params):
    """Fit on the training rows of fold 0, predict its test rows."""
    def run(s, d):
        model = fm.fit(algorithm, train(s, d), ROLES, FEATURES, params)
        return fm.predictions(model, test(s, d), "full", 0)
    return run


def knn(s, d):
    out = fm.fit("KN", train(s, d), ROLES, FEATURES, {"k": 7, "weights": "uniform", "p": 2})
    return rounded(fm.predictions(out, test(s, d), "full", 0), "p")


def swept(s, d):
    space = {"max_depth": ("int", 1, 6), "impurity": ("choice", "gini", "entropy")}
    return tune.sweep(train(s, d), "DT", ROLES, FEATURES, n_trials=3, timeout=600, space=space)


def nb_permutation(s, d):
    model = fm.fit("NB", train(s, d), ROLES, FEATURES)
    return permutation_importance(model, train(s, d), n_repeats=3)


def native(s, d):
    model = fm.fit("DT", train(s, d), ROLES, FEATURES, {"max_depth": 4})
    return tune.importance_table(model, train(s, d), "full", 0)


def grid(s, d):
    views = {cv: (train(s, d, cv), FEATURES) for cv in range(K)}
    models, _ = tune.train_all(views, ["NB", "DT"], ROLES, parallel=4)
    parts = None
    for cv in range(K):
        part = fm.many_predictions([models[cv, "NB"], models[cv, "DT"]], test(s, d, cv), "full", cv)
        parts = part if parts is None else parts.unionByName(part)
    return evaluate.evaluate(parts, groups=2 * K)


def repl(s, d):
    """New rows: all orders, columns in another order, one column the training never saw."""
    cols = ["inst_id", "class", *reversed(FEATURES)]
    return fx.feat(s, d).select(*cols, F.lit(1).alias("f_extra"))


def repl_prepared(s, d):
    return replication.prepare_replication(repl(s, d), ROLES, FEATURES, K, fx.fill_state(s, d), fx.scaler_state(s, d))


def repl_models(s, d):
    return {(cv, "NB"): fm.fit("NB", train(s, d, cv), ROLES, FEATURES) for cv in range(K)}


def repl_pred(s, d):
    rows = clean.align_to(FEATURES, clean.drop_missing_class(repl(s, d), ROLES), ROLES)
    state = fx.fill_state(s, d), fx.scaler_state(s, d)
    ready = lambda cv: prep.apply_prep(rows.withColumn("cv", F.lit(cv)), *state, FEATURES, K)
    return replication.apply_models(repl_models(s, d), ready, "repl")


def repl_profile(s, d):
    kinds = profile.feature_kinds(fx.fold(s, d), ROLES)
    return replication.profile_replication(repl(s, d).drop("f_extra"), ROLES, kinds)["counts"]


def fold_files(s, d):
    """Folds written partitioned, read back with the fold filter."""
    path = scratch_path(s, "folds")
    sinks.write_folds(fx.fold(s, d), path)
    table = sinks.read_folds(s, path)
    return table.where("fold <> 2").select("inst_id", "class", "fold")


def stage_files(s, d):
    path = scratch_path(s, "stages")
    sinks.write_stage(fx.fold(s, d).select("inst_id", "f_price"), path, "raw")
    sinks.write_stage(prepared(s, d).where("cv = 0").select("inst_id", "f_price"), path, "scaled")
    return s.read.parquet(path).groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.count("f_price").alias("known"))


def state_files(s, d):
    path = scratch_path(s, "state")
    sinks.save_state(prep.fit_fill(fx.fold(s, d), KINDS, K), path, "fill")
    return rounded(sinks.load_state(s, path, "fill"), "fill")


def csv_round_trip(s, d):
    path = scratch_path(s, "table") + ".csv"
    sinks.write_result(fx.feat(s, d), path, "csv")
    return readers.read_dataset(s, path).groupBy("f_priority").agg(
        F.count(F.lit(1)).alias("n"), F.count("class").alias("labelled"), F.round(F.avg("f_price"), 4).alias("price")
    )


def folder_of_datasets(s, d):
    folder = scratch_path(s, "sets")
    base = fx.feat(s, d)
    sinks.write_result(base, f"{folder}/full.csv", "csv")
    sinks.write_result(base.drop("f_price", "f_segment"), f"{folder}/reduced.csv", "csv")
    found = readers.read_datasets(s, folder)
    return readers.union_datasets(found).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"), F.count("f_price").alias("priced"), F.count("f_month").alias("dated")
    )


def settings(s, d):
    row = fx.fold(s, d).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("fold").alias("k")).first()
    return sinks.settings_table(s, {"instances": row["n"], "folds": row["k"], "class": ROLES.class_col})


def missing_by_name_list(s, d):
    """Columns named in the header of a list file, dropped from the table."""
    path = scratch_path(s, "ignore")
    fx.feat(s, d).select("f_big", "f_month").limit(0).coalesce(1).write.option("header", True).csv(path)
    names = readers.read_name_list(s, path)
    from sparkassay.operators.clean import drop_features

    return drop_features(fx.feat(s, d), names)


def run_times(s, d):
    path = scratch_path(s, "log")
    rows = fx.run_log(s, d)
    for r in rows.collect():
        sinks.log_runtime(s, path, r["dataset"], r["fold"], r["component"], r["seconds"])
    return rounded(sinks.read_run_log(s, path), "seconds")


QUERIES = {
    "a1_read_dataset": csv_round_trip,
    "a2_read_datasets": folder_of_datasets,
    "a3_read_name_list": missing_by_name_list,
    "a4_write_folds": fold_files,
    "a5_write_stage": stage_files,
    "a6_save_state": state_files,
    "a7_settings_table": settings,
    "a9_log_runtime": run_times,
    "h2_logistic_regression": model_query("LR", {"C": 1.0, "class_weight": "balanced"}),
    "h3_decision_tree": model_query("DT", {"max_depth": 5, "min_leaf": 5}),
    "h4_random_forest": model_query("RF", {"n_trees": 20, "max_depth": 6}),
    "h5_gradient_boosting": model_query("GB", {"rounds": 10, "row_fraction": 0.8, "column_fraction": 0.7, "class_weight": "positive"}),
    "h6_svm_linear": model_query("SVM", {"kernel": "linear", "max_iter": 30}),
    "h6_svm_poly": model_query("SVM", {"kernel": "poly", "degree": 2, "max_iter": 30}),
    "h6_svm_rbf": model_query("SVM", {"kernel": "rbf", "max_iter": 30}),
    "h7_neural_net": model_query("ANN", {"n_layers": 1, "layer_size": 8, "max_iter": 50}),
    "h8_k_neighbors": knn,
    "h9_class_weights": lambda s, d: rounded(fm.class_weights(fx.fold(s, d)), "balanced", "positive"),
    "h10_sweep": swept,
    "h11_best_params": lambda s, d: tune.best_params(swept(s, d)),
    "h12_permutation_importance": nb_permutation,
    "h13_native_importance": native,
    "h15_train_all": grid,
    "h1_evaluate": lambda s, d: rounded(evaluate.evaluate(nb_pred(s, d), groups=K), "value", digits=4),
    "k1_profile_replication": repl_profile,
    "k2_prepare_replication": lambda s, d: rounded(
        repl_prepared(s, d).select("cv", "inst_id", "class", *FEATURES), *FEATURES, digits=5
    ),
    "k3_apply_models": lambda s, d: rounded(repl_pred(s, d), "p", digits=5),
    "k4_summarise_replication": lambda s, d: rounded(
        replication.summarise_replication(
            cut_lineage(repl_pred(s, d), "predictions"), repl(s, d), ROLES, K
        )["means"], *METRICS, digits=4
    ),
    "j25_report_best": lambda s, d: report.report_best(fx.perf(s, d)),
    "j25_report_means": lambda s, d: report.report_means(fx.perf(s, d)),
    "j25_report_best_comparison": lambda s, d: report.report_best_comparison(fx.perf(s, d), ["full", "reduced"]),
    "j25_report_runtimes": lambda s, d: report.report_runtimes(fx.run_log(s, d)),
}

KNN = f"""
w AS (SELECT inst_id, part, any_value(class) AS y, {', '.join(f"max(value) FILTER (feature = '{f}') AS {f}" for f in FEATURES)}
  FROM scaled WHERE cv = 0 GROUP BY inst_id, part),
near AS (
  SELECT a.inst_id, any_value(a.y) AS y, arg_min(b.y, {{'d': {' + '.join(f'(a.{f} - b.{f}) * (a.{f} - b.{f})' for f in FEATURES)}, 'i': b.inst_id}}, 7) AS votes
  FROM w a JOIN w b ON a.part = 'test' AND b.part = 'train' GROUP BY a.inst_id
)"""

REPL = """
rl AS (SELECT f.cv, inst_id, class, l.feature, (coalesce(value, fill) - mean) / scale AS value
  FROM lng l JOIN fills f ON f.feature = l.feature JOIN scaler s ON s.cv = f.cv AND s.feature = f.feature),
rj AS (SELECT rl.cv, inst_id, rl.class AS y, nb.class AS c,
    max(ln(prior)) + sum(-0.5 * ln(2 * pi() * var) - 0.5 * (value - mean) ** 2 / var) AS l
  FROM rl JOIN nb ON nb.cv = rl.cv AND nb.feature = rl.feature GROUP BY ALL),
repl_pred AS (SELECT 'repl' AS dataset, 'NB' AS algorithm, CAST(cv AS INTEGER) AS fold, inst_id, y,
    1 / (1 + exp(max(l) FILTER (c = 0) - max(l) FILTER (c = 1))) AS p FROM rj GROUP BY cv, inst_id, y)"""


def metrics_of(source):
    return [f"pred AS (SELECT * FROM {source})", CURVE, PERF]


ORACLES = {
    "a1_read_dataset": sql("feat", """
SELECT f_priority, count(*) AS n, count(class) AS labelled, round(avg(f_price), 4) AS price FROM feat GROUP BY f_priority"""),
    "a2_read_datasets": sql("feat", """
SELECT 'full' AS dataset, count(*) AS n, count(f_price) AS priced, count(f_month) AS dated FROM feat
UNION ALL SELECT 'reduced', count(*), 0, count(f_month) FROM feat"""),
    "a3_read_name_list": sql("feat", "SELECT * EXCLUDE (f_big, f_month) FROM feat"),
    "a4_write_folds": sql("fold", "SELECT inst_id, class, fold FROM fold WHERE fold <> 2"),
    "a5_write_stage": sql("fold", """
SELECT 'raw' AS stage, count(*) AS n, count(f_price) AS known FROM fold
UNION ALL SELECT 'scaled', count(*), count(*) FROM fold"""),
    "a6_save_state": sql("train", "SELECT CAST(cv AS INTEGER) AS cv, feature, round(fill, 6) AS fill FROM fills", FILL),
    "a7_settings_table": sql("fold", """
SELECT 'instances' AS setting, CAST(count(*) AS VARCHAR) AS value FROM fold
UNION ALL SELECT 'folds', CAST(count(DISTINCT fold) AS VARCHAR) FROM fold
UNION ALL SELECT 'class', 'class'"""),
    "a9_log_runtime": sql("runlog", "SELECT dataset, fold, component, round(seconds, 6) AS seconds FROM runlog"),
    "h8_k_neighbors": sql("train", """
SELECT 'full' AS dataset, 'KN' AS algorithm, 0 AS fold, inst_id, y, round(list_sum(votes)::DOUBLE / 7, 6) AS p FROM near""", FILL, KNN),
    "h9_class_weights": sql("fold", """
SELECT class, count(*) AS n, round((SELECT count(*) FROM fold)::DOUBLE / (2 * count(*)), 6) AS balanced,
  round(CASE WHEN class = 1 THEN (SELECT count(*) FROM fold WHERE class = 0)::DOUBLE / count(*) ELSE 1.0 END, 6) AS positive
FROM fold GROUP BY class"""),
    "h1_evaluate": sql("train", "SELECT dataset, algorithm, fold, metric, round(value, 4) AS value FROM perf",
                       FILL, NB, *metrics_of("nb_pred")),
    "k1_profile_replication": sql("long", """
SELECT 'instances' AS variable, count(*)::DOUBLE AS count FROM fold
UNION ALL SELECT 'features', count(DISTINCT feature)::DOUBLE FROM lng
UNION ALL SELECT 'categorical_features', (count(*) FILTER (u <= 10))::DOUBLE FROM k
UNION ALL SELECT 'quantitative_features', (count(*) FILTER (u > 10))::DOUBLE FROM k
UNION ALL SELECT 'missing_values', (count(*) FILTER (value IS NULL))::DOUBLE FROM lng
UNION ALL SELECT 'missing_percent', round((count(*) FILTER (value IS NULL))::DOUBLE / count(*), 5) FROM lng""",
                                  "k AS (SELECT feature, count(DISTINCT value) AS u FROM lng GROUP BY feature)"),
    "k2_prepare_replication": sql("train", "SELECT CAST(cv AS INTEGER) AS cv, inst_id, class, " + ", ".join(
        f"round(max(value) FILTER (feature = '{f}'), 5) AS {f}" for f in FEATURES
    ) + " FROM rl GROUP BY cv, inst_id, class", FILL, NB, REPL),
    "k3_apply_models": sql(
        "train", "SELECT dataset, algorithm, fold, inst_id, y, round(p, 5) AS p FROM repl_pred", FILL, NB, REPL
    ),
    "k4_summarise_replication": sql("train", "SELECT dataset, algorithm, " + ", ".join(
        f"round(avg(value) FILTER (metric = '{m}'), 4) AS \"{m}\"" for m in METRICS
    ) + " FROM perf GROUP BY ALL", FILL, NB, REPL, *metrics_of("repl_pred")),
    "j25_report_best": sql("perf", """
SELECT dataset, metric, algorithm, round(mean, 3) AS value FROM best
WHERE metric IN ('ROC_AUC', 'Balanced Accuracy', 'F1_Score', 'PRC_AUC', 'PRC_APS')""", BEST.replace("FROM pr JOIN", "FROM perf pr JOIN")),
    "j25_report_means": sql("perf", "SELECT dataset, algorithm, " + ", ".join(
        f"round(avg(value) FILTER (metric = '{m}'), 4) AS \"{m}\"" for m in METRICS
    ) + " FROM perf GROUP BY ALL"),
    "j25_report_best_comparison": sql("perf", """
SELECT k.metric, round(round(p, 6), 4) AS p_value, a.algorithm AS best_d1, round(a.mean, 4) AS mean_d1,
  b.algorithm AS best_d2, round(b.mean, 4) AS mean_d2
FROM kb k JOIN best a ON a.metric = k.metric AND a.dataset = 'full' JOIN best b ON b.metric = k.metric AND b.dataset = 'reduced'
""", PERF_R, SIMPSON, BEST, kruskal_cte("kb", "prb", ["metric"], "dataset")),
    "j25_report_runtimes": sql("runlog", "SELECT dataset, component, round(sum(seconds), 2) AS seconds FROM runlog GROUP BY ALL"),
}
