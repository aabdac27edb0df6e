"""The same analysis tables as ``fixtures.py``, as SQL text for the independent check."""

from __future__ import annotations

FEATURES = ["f_priority", "f_region", "f_segment", "f_big", "f_price", "f_acctbal", "f_month"]

FEAT = """
feat AS (
  SELECT o_orderkey AS inst_id, o_custkey AS match_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS class,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS f_priority,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE n_regionkey END AS f_region,
    CAST(length(c_mktsegment) AS INTEGER) AS f_segment,
    CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS f_big,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS f_price,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE c_acctbal END AS f_acctbal,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS f_month
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

FOLD = """
fold AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY class
      ORDER BY md5('42|' || CAST(inst_id AS VARCHAR)), inst_id) - 1) % 5 AS INTEGER) AS fold
  FROM feat WHERE class IS NOT NULL
)"""

# long rows of the fold table, missing cells included
LONG = "lng AS (\n" + "\nUNION ALL ".join(
    f"SELECT inst_id, class, fold, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM fold" for f in FEATURES
) + "\n)"

# model index x training rows
TRAIN = """
idx AS (SELECT unnest(range(0, 5)) AS cv),
train AS (SELECT idx.cv, lng.* FROM lng JOIN idx ON lng.fold <> idx.cv)"""

PRED = """
setup(dataset, algorithm, s, w) AS (VALUES ('full', 'A', 1, 4), ('full', 'B', 2, 2), ('full', 'C', 3, 0),
  ('reduced', 'A', 4, 4), ('reduced', 'B', 5, 0), ('reduced', 'C', 6, 2)),
pred AS (
  SELECT dataset, algorithm, fold, inst_id, class AS y,
    round(CAST(w * class * 1000 + (10 - w) * ((inst_id * 7919 + s * 131) % 1000) AS DOUBLE) / 10000.0, 3) AS p
  FROM fold CROSS JOIN setup
)"""

CURVE = """
scored AS (
  SELECT dataset, algorithm, fold, p, CAST(sum(y) AS DOUBLE) AS n1, CAST(sum(1 - y) AS DOUBLE) AS n0
  FROM pred GROUP BY ALL
),
curve AS (
  SELECT *, sum(n1) OVER w AS c1, sum(n0) OVER w AS c0,
    sum(n1) OVER g AS all1, sum(n0) OVER g AS all0
  FROM scored
  WINDOW w AS (PARTITION BY dataset, algorithm, fold ORDER BY p DESC),
    g AS (PARTITION BY dataset, algorithm, fold)
),
steps AS (
  SELECT *, c1 / (c1 + c0) AS prec,
    coalesce(lag(c1 / (c1 + c0)) OVER w, 1.0) AS prec0,
    coalesce(lag(c1 / all1) OVER w, 0.0) AS tpr0, c1 / all1 AS tpr,
    coalesce(lag(c0 / all0) OVER w, 0.0) AS fpr0, c0 / all0 AS fpr
  FROM curve
  WINDOW w AS (PARTITION BY dataset, algorithm, fold ORDER BY p DESC)
),
area AS (
  SELECT dataset, algorithm, fold, sum((fpr - fpr0) * (tpr + tpr0) / 2) AS roc_auc,
    sum((tpr - tpr0) * (prec + prec0) / 2) AS prc_auc, sum((tpr - tpr0) * prec) AS aps
  FROM steps GROUP BY ALL
)"""


def metric_cte(name: str, threshold: float, op: str = ">") -> str:
    return f"""
{name}_n AS (
  SELECT dataset, algorithm, fold,
    count(*) FILTER (y = 1 AND p {op} {threshold}) AS tp, count(*) FILTER (y = 0 AND NOT p {op} {threshold}) AS tn,
    count(*) FILTER (y = 0 AND p {op} {threshold}) AS fp, count(*) FILTER (y = 1 AND NOT p {op} {threshold}) AS fn
  FROM pred GROUP BY ALL
),
{name}_r AS (
  SELECT *, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
    CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fp) END AS specificity,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS "precision"
  FROM {name}_n
),
{name} AS (
  SELECT dataset, algorithm, fold, tp, tn, fp, fn, (recall + specificity) / 2 AS balanced_accuracy,
    (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy,
    CASE WHEN recall + "precision" = 0 THEN 0.0 ELSE 2 * recall * "precision" / (recall + "precision") END AS f1,
    recall, specificity, "precision",
    CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fn) END AS npv,
    CASE WHEN specificity = 1 THEN 0.0 ELSE recall / (1 - specificity) END AS lr_plus,
    CASE WHEN specificity = 0 THEN 0.0 ELSE (1 - recall) / specificity END AS lr_minus
  FROM {name}_r
)"""


METRIC_COLUMNS = [
    ("Balanced Accuracy", "balanced_accuracy"), ("Accuracy", "accuracy"), ("F1_Score", "f1"),
    ("Sensitivity (Recall)", "recall"), ("Specificity", "specificity"), ("Precision (PPV)", '"precision"'),
    ("TP", "tp"), ("TN", "tn"), ("FP", "fp"), ("FN", "fn"), ("NPV", "npv"), ("LR+", "lr_plus"), ("LR-", "lr_minus"),
    ("ROC_AUC", "roc_auc"), ("PRC_AUC", "prc_auc"), ("PRC_APS", "aps"),
]

PERF = metric_cte("cm", 0.5) + ",\nwide AS (SELECT * FROM cm JOIN area USING (dataset, algorithm, fold)),\nperf AS (\n" + (
    "\nUNION ALL ".join(
        f"SELECT dataset, algorithm, fold, '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM wide"
        for m, c in METRIC_COLUMNS
    )
) + "\n)"

FI = """
fdiff AS (
  SELECT fold, feature, (avg(value) FILTER (class = 1) - avg(value) FILTER (class = 0)) / stddev_pop(value) AS d
  FROM lng GROUP BY fold, feature
),
fi AS (
  SELECT 'full' AS dataset, algorithm, fold, feature, round(d * m, 6) AS score
  FROM fdiff CROSS JOIN (VALUES ('A', 1.0::DOUBLE), ('B', -2.0::DOUBLE), ('C', 0.5::DOUBLE)) AS signs(algorithm, m)
  WHERE NOT (fold = 2 AND feature = 'f_month')
)"""

SCORES = """
scores0 AS (
  SELECT fold, 'mi' AS algorithm, feature, round(abs(score) - 0.02, 6) AS score FROM fi WHERE algorithm = 'A'
  UNION ALL SELECT fold, 'ms', feature, score FROM fi WHERE algorithm = 'A'
),
scores AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY fold, algorithm ORDER BY score DESC, feature) AS INTEGER) AS rank
  FROM scores0
)"""

RUNLOG = """
runlog AS (
  SELECT 'full' AS dataset, fold, component, n * (pos + 1) / 1000.0::DOUBLE AS seconds
  FROM (SELECT fold, count(*) AS n FROM fold GROUP BY fold)
  CROSS JOIN (VALUES (0, 'exploratory'), (1, 'preprocessing'), (2, 'NB'), (3, 'LR')) AS c(pos, component)
)"""

PARTS = {
    "feat": [FEAT],
    "fold": [FEAT, FOLD],
    "long": [FEAT, FOLD, LONG],
    "train": [FEAT, FOLD, LONG, TRAIN],
    "pred": [FEAT, FOLD, PRED],
    "curve": [FEAT, FOLD, PRED, CURVE],
    "perf": [FEAT, FOLD, PRED, CURVE, PERF],
    "fi": [FEAT, FOLD, LONG, FI],
    "scores": [FEAT, FOLD, LONG, FI, SCORES],
    "runlog": [FEAT, FOLD, RUNLOG],
    "all": [FEAT, FOLD, LONG, FI, PRED, CURVE, PERF],
}


def sql(base: str, body: str, *more: str) -> str:
    """A query over one of the shared tables, with its own further CTEs."""
    return "WITH " + ",".join([*PARTS[base], *more]) + "\n" + body
