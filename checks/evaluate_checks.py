"""Metrics and curves: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.profile_checks import rounded
from checks.sql_tables import metric_cte, sql
from sparkassay.operators import evaluate as ev
from sparkassay.operators import profile

GROUPS = 6 * fx.K
RATES = ["balanced_accuracy", "accuracy", "f1", "recall", "specificity", "precision", "npv", "lr_plus", "lr_minus"]
AREAS = ["roc_auc", "prc_auc", "aps"]
RUN = "dataset, algorithm, fold"


def train_pred(s, d):
    """Predictions on the training rows: model index next to the row's own fold."""
    cv = F.explode(F.filter(F.sequence(F.lit(0), F.lit(fx.K - 1)), lambda i: i != F.col("fold"))).alias("cv")
    rows = fx.pred(s, d).select("dataset", "algorithm", "inst_id", "y", "p", "fold", cv)
    return rows.drop("fold").withColumnRenamed("cv", "fold")


QUERIES = {
    "i1_confusion": lambda s, d: ev.confusion(fx.pred(s, d)),
    "i2_class_metrics": lambda s, d: rounded(ev.class_metrics(fx.pred(s, d)), *RATES),
    "i3_roc_curve": lambda s, d: rounded(ev.roc_curve(fx.pred(s, d), groups=GROUPS), "fpr", "tpr"),
    "i4_roc_auc": lambda s, d: rounded(ev.roc_auc(fx.pred(s, d), groups=GROUPS), "roc_auc"),
    "i5_pr_curve": lambda s, d: rounded(ev.pr_curve(fx.pred(s, d), groups=GROUPS), "precision", "recall"),
    "i6_pr_auc": lambda s, d: rounded(ev.pr_auc(fx.pred(s, d), groups=GROUPS), "prc_auc"),
    "i7_average_precision": lambda s, d: rounded(ev.average_precision(fx.pred(s, d), groups=GROUPS), "aps"),
    "i8_apply_threshold": lambda s, d: rounded(
        ev.apply_threshold(fx.pred(s, d), 0.62, groups=GROUPS), *RATES, *AREAS
    ),
    "i8_apply_threshold_train": lambda s, d: rounded(
        ev.class_metrics(train_pred(s, d), 0.4), *RATES
    ),
    "i9_threshold_sweep": lambda s, d: rounded(ev.threshold_sweep(fx.pred(s, d)), "fpr", "tpr"),
    "i10_mean_roc": lambda s, d: rounded(
        ev.mean_curve(fx.pred(s, d), "roc", groups=GROUPS), "x", "mean", "lower", "upper"
    ),
    "i10_mean_prc": lambda s, d: rounded(
        ev.mean_curve(fx.pred(s, d), "prc", groups=GROUPS), "x", "mean", "lower", "upper"
    ),
    "i11_curve_summary": lambda s, d: rounded(ev.curve_summary(fx.perf(s, d)), *AREAS),
    "i12_case_probabilities": lambda s, d: ev.case_probabilities(
        fx.pred(s, d), fx.feat(s, d).select("inst_id", "class"), ["A", "B", "C"]
    ),
    "i13_score": lambda s, d: rounded(ev.score(fx.pred(s, d), "f1"), "score"),
    "i13_score_auc": lambda s, d: rounded(ev.score(fx.pred(s, d), "roc_auc", groups=GROUPS), "score"),
    "i14_evaluate": lambda s, d: rounded(fx.perf_plan(s, d), "value"),
    "c11_boxplot_metrics": lambda s, d: rounded(
        profile.boxplot_stats(fx.perf(s, d), "value", ["dataset", "algorithm", "metric"]),
        "q1", "median", "q3", "whisker_low", "whisker_high"
    ),
}


def rates(source, extra=""):
    cols = ", ".join(f'round("{r}", 6) AS "{r}"' for r in RATES)
    return f"SELECT {RUN}, tp, tn, fp, fn, {cols}{extra} FROM {source}"


def area(*names):
    return sql("curve", f"SELECT {RUN}, " + ", ".join(f"round({n}, 6) AS {n}" for n in names) + " FROM area")


def mean_curve(kind):
    """As-of join of the 100 grid points to the curve, then the mean over folds."""
    if kind == "roc":
        points = "fpr AS x, tpr AS y, c0 AS c, all0 AS total"
        y = "CASE WHEN g = 0 THEN 0.0 WHEN g = 99 THEN 1.0 ELSE y END"
    else:
        points = "tpr AS x, prec AS y, c1 AS c, all1 AS total"
        y = "y"
    start = "0.0" if kind == "roc" else "1.0"
    return sql("curve", """
SELECT dataset, algorithm, round(g / 99.0, 6) AS x, round(avg(y), 6) AS mean,
  round(greatest(avg(y) - stddev_pop(y), 0), 6) AS lower, round(least(avg(y) + stddev_pop(y), 1), 6) AS upper
FROM final GROUP BY dataset, algorithm, g""", f"""
pts AS (
  SELECT {RUN}, {points}, -p AS o FROM steps
  UNION ALL SELECT DISTINCT {RUN}, 0.0, {start}, 0.0, {'all0' if kind == 'roc' else 'all1'}, -2.0 FROM steps
),
seg AS (
  SELECT {RUN}, c, total, x, y, lead(c) OVER w AS c_next, lead(x) OVER w AS x_next, lead(y) OVER w AS y_next
  FROM pts WINDOW w AS (PARTITION BY {RUN} ORDER BY o)
),
hit AS (
  SELECT {RUN}, CAST(g AS INTEGER) AS g,
    CASE WHEN c_next IS NULL THEN y ELSE y + (y_next - y) * (g / 99.0::DOUBLE - x) / (x_next - x) END AS y
  FROM seg JOIN range(0, 100) AS r(g)
    ON c * 99 <= g * total AND (c_next IS NULL OR g * total < c_next * 99)
),
final AS (SELECT {RUN}, g, {y} AS y FROM hit)""")


SWEEP = sql("pred", """
SELECT dataset, algorithm, fold, t AS threshold, count(*) FILTER (y = 1 AND p >= t) AS tp,
  count(*) FILTER (y = 0 AND p >= t) AS fp, count(*) FILTER (y = 1 AND p < t) AS fn,
  count(*) FILTER (y = 0 AND p < t) AS tn,
  round((count(*) FILTER (y = 0 AND p >= t))::DOUBLE / count(*) FILTER (y = 0), 6) AS fpr,
  round((count(*) FILTER (y = 1 AND p >= t))::DOUBLE / count(*) FILTER (y = 1), 6) AS tpr
FROM pred CROSS JOIN (SELECT i / 100.0::DOUBLE AS t FROM range(0, 101) AS r(i)) GROUP BY ALL""")

BOX = """
q AS (SELECT dataset, algorithm, metric, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM perf GROUP BY ALL),
b AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS near
  FROM perf JOIN q USING (dataset, algorithm, metric))"""

ORACLES = {
    "i1_confusion": sql("pred", f"SELECT {RUN}, tp, tn, fp, fn FROM cm_n", metric_cte("cm", 0.5)),
    "i2_class_metrics": sql("pred", rates("cm"), metric_cte("cm", 0.5)),
    "i3_roc_curve": sql("curve", f"""
SELECT {RUN}, p AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM steps
UNION ALL SELECT DISTINCT {RUN}, NULL::DOUBLE, 0.0, 0.0 FROM steps"""),
    "i4_roc_auc": area("roc_auc"),
    "i5_pr_curve": sql("curve", f"""
SELECT {RUN}, p AS threshold, round(prec, 6) AS "precision", round(tpr, 6) AS recall FROM steps
UNION ALL SELECT DISTINCT {RUN}, NULL::DOUBLE, 1.0, 0.0 FROM steps"""),
    "i6_pr_auc": area("prc_auc"),
    "i7_average_precision": area("aps"),
    "i8_apply_threshold": sql(
        "curve", rates("cm JOIN area USING (dataset, algorithm, fold)", "".join(f", round({a}, 6) AS {a}" for a in AREAS)),
        metric_cte("cm", 0.62)
    ),
    "i8_apply_threshold_train": sql(
        "fold", rates("cm"), """
setup(dataset, algorithm, s, w) AS (VALUES ('full', 'A', 1, 4), ('full', 'B', 2, 2), ('full', 'C', 3, 0),
  ('reduced', 'A', 4, 4), ('reduced', 'B', 5, 0), ('reduced', 'C', 6, 2)),
pred AS (
  SELECT dataset, algorithm, CAST(cv AS INTEGER) AS fold, inst_id, class AS y,
    round(CAST(w * class * 1000 + (10 - w) * ((inst_id * 7919 + s * 131) % 1000) AS DOUBLE) / 10000.0, 3) AS p
  FROM fold CROSS JOIN setup JOIN range(0, 5) AS r(cv) ON cv <> fold.fold
)""", metric_cte("cm", 0.4)),
    "i9_threshold_sweep": SWEEP,
    "i10_mean_roc": mean_curve("roc"),
    "i10_mean_prc": mean_curve("prc"),
    "i11_curve_summary": sql("curve", "SELECT dataset, algorithm, " + ", ".join(
        f"round(avg({a}), 6) AS {a}" for a in AREAS) + " FROM area GROUP BY ALL"),
    "i12_case_probabilities": sql("pred", """
SELECT inst_id, dataset, pred.fold, max(p) FILTER (algorithm = 'A') AS p_A, max(p) FILTER (algorithm = 'B') AS p_B,
  max(p) FILTER (algorithm = 'C') AS p_C, max(y) AS class FROM pred GROUP BY inst_id, dataset, pred.fold"""),
    "i13_score": sql("pred", f"SELECT {RUN}, round(f1, 6) AS score FROM cm", metric_cte("cm", 0.5)),
    "i13_score_auc": sql("curve", f"SELECT {RUN}, round(roc_auc, 6) AS score FROM area"),
    "i14_evaluate": sql("perf", f"SELECT {RUN}, metric, round(value, 6) AS value FROM perf"),
    "c11_boxplot_metrics": sql("perf", """
SELECT dataset, algorithm, metric, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(value) FILTER (near), 6) AS whisker_low, round(max(value) FILTER (near), 6) AS whisker_high,
  count(*) FILTER (NOT near) AS outliers, count(*) AS n
FROM b GROUP BY dataset, algorithm, metric, q1, median, q3""", BOX),
}
