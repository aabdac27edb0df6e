"""Selection, summaries, rank tests and composite importances: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.profile_checks import rounded
from checks.sql_tables import FEATURES, METRIC_COLUMNS, sql
from sparkassay.operators import composite as co
from sparkassay.operators import selection as se
from sparkassay.operators import significance as si
from sparkassay.operators import summarize as su
from sparkassay.operators import profile

METRICS = [m for m, _ in METRIC_COLUMNS]
DATASETS = ["full", "reduced"]


def aligned(s, d):
    return co.align_importance(fx.fi(s, d), FEATURES)


def means(s, d):
    return co.fi_mean(aligned(s, d))


def full_perf(s, d):
    return fx.perf(s, d).where("dataset = 'full'")


def long_versions(s, d):
    """Long fold table once per model index."""
    long = fx.fold(s, d).select("inst_id", "fold", *[F.col(f).cast("double").alias(f) for f in FEATURES]).unpivot(
        ["inst_id", "fold"], FEATURES, "feature", "value"
    )
    return long.withColumn("cv", F.explode(F.sequence(F.lit(0), F.lit(fx.K - 1))))


def expected(s, d):
    """Every component of every fold, two of them never run."""
    return fx.run_log(s, d).select("dataset", "fold", "component")


def done(s, d):
    lost = (F.col("component") == "LR") & F.col("fold").isin(1, 3)
    return fx.run_log(s, d).where(~lost)


QUERIES = {
    "b6_select_fold_features": lambda s, d: se.select_fold_features(
        long_versions(s, d), se.cap_features(fx.scores(s, d), 4), 5 * len(FEATURES)
    ).groupBy("cv", "feature").agg(F.count(F.lit(1)).alias("n")),
    "g5_rank_scores": lambda s, d: fx.scores(s, d),
    "g6_mean_scores": lambda s, d: rounded(se.mean_scores(fx.scores(s, d), 4), "mean_score"),
    "g7_informative": lambda s, d: se.informative(fx.scores(s, d)),
    "g8_union_informative": lambda s, d: se.union_informative(fx.scores(s, d)),
    "g9_informative_counts": lambda s, d: se.informative_counts(fx.scores(s, d)),
    "g10_cap_features": lambda s, d: se.cap_features(fx.scores(s, d), 4),
    "g11_select_features": lambda s, d: se.select_features(
        long_versions(s, d), fx.scores(s, d), 5, 5 * len(FEATURES)
    ),
    "h14_align_importance": lambda s, d: aligned(s, d),
    "j1_performance_table": lambda s, d: rounded(su.performance_table(fx.perf(s, d), "A"), *METRICS),
    "j2_metric_means": lambda s, d: rounded(su.metric_means(fx.perf(s, d)), *METRICS),
    "j3_metric_stds": lambda s, d: rounded(su.metric_stds(fx.perf(s, d)), *METRICS),
    "j4_kruskal": lambda s, d: si.kruskal(fx.perf(s, d)),
    "j5_wilcoxon_pairs": lambda s, d: si.wilcoxon_pairs(fx.perf(s, d)),
    "j6_mann_whitney_pairs": lambda s, d: si.mann_whitney_pairs(fx.perf(s, d)),
    "j7_gated": lambda s, d: si.gated(si.mann_whitney_pairs(fx.perf(s, d)), si.kruskal(fx.perf(s, d))),
    "j8_compare_datasets_kruskal": lambda s, d: si.compare_datasets(fx.perf(s, d), "kruskal", DATASETS),
    "j8_compare_datasets_wilcoxon": lambda s, d: si.compare_datasets(fx.perf(s, d), "wilcoxon", DATASETS),
    "j8_compare_datasets_mann_whitney": lambda s, d: si.compare_datasets(fx.perf(s, d), "mann_whitney", DATASETS),
    "j9_best_algorithm": lambda s, d: si.best_algorithm(fx.perf(s, d)),
    "j10_compare_best_kruskal": lambda s, d: si.compare_best(fx.perf(s, d), "kruskal", DATASETS),
    "j10_compare_best_wilcoxon": lambda s, d: si.compare_best(fx.perf(s, d), "wilcoxon", DATASETS),
    "j10_compare_best_mann_whitney": lambda s, d: si.compare_best(fx.perf(s, d), "mann_whitney", DATASETS),
    "j11_dataset_trajectory": lambda s, d: rounded(su.dataset_trajectory(fx.perf(s, d)), "mean"),
    "j12_fi_mean": lambda s, d: rounded(means(s, d), "mean_fi"),
    "j13_fi_normalize": lambda s, d: rounded(co.fi_normalize(means(s, d)), "mean_fi", "norm"),
    "j14_fi_nonzero_union": lambda s, d: co.fi_nonzero_union(means(s, d)),
    "j15_ba_weight": lambda s, d: rounded(co.ba_weight(fx.perf(s, d)), "weight"),
    "j16_fi_top": lambda s, d: rounded(co.fi_top(means(s, d), full_perf(s, d), 4), "total"),
    "j17_fi_fraction": lambda s, d: rounded(
        co.fi_fraction(co.fi_normalize(means(s, d))), "mean_fi", "norm", "fraction"
    ),
    "j18_fi_weighted": lambda s, d: rounded(
        co.fi_weighted(co.fi_normalize(means(s, d)), full_perf(s, d)),
        "mean_fi", "norm", "fraction", "weight", "weighted", "weighted_fraction"
    ),
    **{
        f"j19_composite_{mode.lower()}": (
            lambda s, d, mode=mode: rounded(co.composite_fi(means(s, d), full_perf(s, d), mode, 5), "value", "base")
        )
        for mode in co.MODES
    },
    "j20_fi_rank_table": lambda s, d: rounded(co.fi_rank_table(aligned(s, d)), "rank", "mean_rank"),
    "j21_fi_boxplot_data": lambda s, d: rounded(
        co.fi_boxplot_data(aligned(s, d), 3), "q1", "median", "q3", "whisker_low", "whisker_high"
    ),
    "c5_histogram_fi": lambda s, d: rounded(
        profile.histogram(means(s, d), "mean_fi", 10, ["algorithm"]), "bin_start", "bin_end"
    ),
    "j22_best_fold": lambda s, d: rounded(su.best_fold(fx.perf(s, d), "A", "ROC_AUC"), "value"),
    "j23_runtime_summary": lambda s, d: rounded(su.runtime_summary(fx.run_log(s, d)), "seconds"),
    "j24_missing_runs": lambda s, d: su.missing_runs(expected(s, d), done(s, d)),
}

CAPPED = """
firsts AS (SELECT fold, feature, min({'r': rank, 'a': algorithm}) AS turn FROM scores WHERE score > 0 GROUP BY ALL),
picks AS (SELECT fold, feature, CAST(row_number() OVER (PARTITION BY fold ORDER BY turn) AS INTEGER) AS pick FROM firsts)"""

LV = "lv AS (SELECT CAST(cv AS INTEGER) AS cv, feature, inst_id, fold, value FROM lng CROSS JOIN range(0, 5) AS r(cv))"

PERF_R = "pr AS (SELECT dataset, algorithm, fold, metric, round(value, 12) AS value FROM perf)"

# 2 * upper normal tail by Simpson's rule, as in the univariate checks
SIMPSON = """
simpson AS (SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(0, 4001) AS r(i))"""


def two_sided(z):
    return (
        f"least(1.0, 1 - 2 * (SELECT sum(w * exp(-pow(least({z}, 8.0) * i / 4000.0, 2) / 2)) * least({z}, 8.0) / 12000.0"
        f" / sqrt(2 * pi()) FROM simpson))"
    )


def star(p="p"):
    return f"CASE WHEN {p} < 0.05 THEN '*' ELSE '' END AS sig"


def kruskal_cte(name, source, keys, by):
    k = ", ".join(keys)
    return f"""
{name}_r AS (SELECT {k}, {by} AS g, rank() OVER w + (count(*) OVER (PARTITION BY {k}, value) - 1) / 2.0 AS r,
  count(*) OVER (PARTITION BY {k}, value)::DOUBLE AS t FROM {source} WINDOW w AS (PARTITION BY {k} ORDER BY value)),
{name}_g AS (SELECT {k}, g, sum(r)::DOUBLE AS rs, count(*)::DOUBLE AS n, sum(t * t - 1) AS tie FROM {name}_r GROUP BY ALL),
{name}_h AS (SELECT {k}, sum(n) AS n, count(*) AS groups, 1 - sum(tie) / (sum(n) ** 3 - sum(n)) AS spread,
  12 / (sum(n) * (sum(n) + 1)) * sum(rs * rs / n) - 3 * (sum(n) + 1) AS h0 FROM {name}_g GROUP BY ALL),
{name}_s AS (SELECT {k}, groups, CASE WHEN spread > 0 THEN h0 / spread END AS h FROM {name}_h),
{name} AS (SELECT {k}, round(h, 6) AS statistic,
  CASE WHEN h IS NULL THEN 1.0 WHEN groups = 3 THEN exp(-h / 2) ELSE {two_sided('sqrt(greatest(h, 0))')} END AS p FROM {name}_s)"""


def wilcoxon_cte(name, source, keys, by):
    """Exact p by listing all sign patterns of the ranks (5 folds: at most 32)."""
    k = ", ".join(keys)
    return f"""
{name}_d AS (SELECT {', '.join('a.' + x for x in keys)}, a.{by} AS a, b.{by} AS b, a.value - b.value AS d
  FROM {source} a JOIN {source} b ON {' AND '.join(f'a.{x} = b.{x}' for x in keys)} AND a.fold = b.fold AND a.{by} < b.{by}),
{name}_z AS (SELECT {k}, a, b, count(*) FILTER (d = 0) AS zeros FROM {name}_d GROUP BY ALL),
{name}_q AS (SELECT *, round(abs(d), 12) AS size FROM {name}_d WHERE d <> 0),
{name}_r AS (SELECT *, count(*) OVER (PARTITION BY {k}, a, b, size)::DOUBLE AS t,
  rank() OVER (PARTITION BY {k}, a, b ORDER BY size) + (count(*) OVER (PARTITION BY {k}, a, b, size) - 1) / 2.0 AS r FROM {name}_q),
{name}_s AS (SELECT {k}, a, b, least(coalesce(sum(r) FILTER (d > 0), 0), coalesce(sum(r) FILTER (d < 0), 0))::DOUBLE AS stat,
  count(*) AS n, sum(t * t - 1) AS tie FROM {name}_r GROUP BY ALL),
{name}_pat AS (SELECT n, m, sum(CASE WHEN (m >> (i - 1)) & 1 = 1 THEN i ELSE 0 END) AS rank_sum
  FROM range(1, 6) AS a(n), range(0, 32) AS b(m), range(1, 6) AS c(i) WHERE m < (1 << n) AND i <= n GROUP BY n, m),
{name} AS (SELECT {k}, a AS {by}_1, b AS {by}_2, round(stat, 6) AS statistic,
  CASE WHEN stat IS NULL THEN 1.0
    WHEN zeros = 0 THEN least(1.0, 2.0 * (SELECT count(*) FROM {name}_pat p WHERE p.n = s.n AND rank_sum <= floor(stat)) / (1 << s.n))
    ELSE {two_sided('(abs(stat - n * (n + 1) / 4.0) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - tie / 48.0))')} END AS p
  FROM {name}_z z LEFT JOIN {name}_s s USING ({k}, a, b))"""


def mwu_cte(name, source, keys, by):
    k = ", ".join(keys)
    return f"""
{name}_n AS (SELECT DISTINCT {k}, {by} AS g FROM {source}),
{name}_p AS (SELECT {', '.join('x.' + c for c in keys)}, x.g AS a, y.g AS b
  FROM {name}_n x JOIN {name}_n y ON {' AND '.join(f'x.{c} = y.{c}' for c in keys)} AND x.g < y.g),
{name}_v AS (SELECT {', '.join('p.' + c for c in keys)}, a, b, {by} = b AS second, value FROM {name}_p p
  JOIN {source} s ON {' AND '.join(f'p.{c} = s.{c}' for c in keys)} AND s.{by} IN (a, b)),
{name}_r AS (SELECT *, count(*) OVER (PARTITION BY {k}, a, b, value)::DOUBLE AS t,
  rank() OVER (PARTITION BY {k}, a, b ORDER BY value) + (count(*) OVER (PARTITION BY {k}, a, b, value) - 1) / 2.0 AS r FROM {name}_v),
{name}_s AS (SELECT {k}, a, b, count(*) FILTER (NOT second)::DOUBLE AS n0, count(*) FILTER (second)::DOUBLE AS n1,
  sum(r) FILTER (second)::DOUBLE AS r1, sum(t * t - 1) AS tie FROM {name}_r GROUP BY ALL),
{name}_u AS (SELECT {k}, a, b, n0, n1, r1 - n1 * (n1 + 1) / 2 AS u1,
  n0 * n1 / 12 * (n0 + n1 + 1 - tie / ((n0 + n1) * (n0 + n1 - 1))) AS var FROM {name}_s),
{name} AS (SELECT {k}, a AS {by}_1, b AS {by}_2,
  CASE WHEN var > 0 THEN round(least(u1, n0 * n1 - u1), 6) END AS statistic,
  CASE WHEN var > 0 THEN {two_sided('((greatest(u1, n0 * n1 - u1) - n0 * n1 / 2 - 0.5) / sqrt(var))')} ELSE 1.0 END AS p
  FROM {name}_u)"""


def test_body(name):
    return f"SELECT * EXCLUDE (p), round(p, 6) AS p_value, {star()} FROM {name}"


A_KEYS, D_KEYS = ["dataset", "metric"], ["algorithm", "metric"]
KRUSKAL = kruskal_cte("kw", "pr", A_KEYS, "algorithm")
MOMENTS = """
mo AS (SELECT dataset, algorithm, metric, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std
  FROM perf GROUP BY ALL)"""
BEST = """
mo2 AS (SELECT dataset, algorithm, metric, avg(value) AS mean, stddev_samp(value) AS std FROM perf GROUP BY ALL),
best AS (SELECT dataset, metric, algorithm, round(mean, 6) AS mean, round(std, 6) AS std FROM mo2
  QUALIFY row_number() OVER (PARTITION BY dataset, metric ORDER BY round(mean, 12) DESC, algorithm) = 1),
prb AS (SELECT pr.* FROM pr JOIN best USING (dataset, metric, algorithm))"""


def sides(name, stats, keys, extra=""):
    k = ", ".join(keys)
    more = "".join(f", s{i}.algorithm AS best_{i}" for i in (1, 2)) if extra else ""
    joins = " ".join(
        f"JOIN {stats} s{i} ON s{i}.dataset = t.dataset_{i} AND " + " AND ".join(f"s{i}.{x} = t.{x}" for x in keys)
        for i in (1, 2)
    )
    return (
        f"SELECT t.* EXCLUDE (p), round(p, 6) AS p_value, {star()}, s1.mean AS mean_1, s1.std AS std_1,"
        f" s2.mean AS mean_2, s2.std AS std_2{more} FROM {name} t {joins}"
    )


def spread(name, stats, keys, extra=False):
    more = "".join(f", s{i}.algorithm AS best_d{i}" for i in (1, 2)) if extra else ""
    joins = " ".join(
        f"JOIN {stats} s{i} ON s{i}.dataset = '{ds}' AND " + " AND ".join(f"s{i}.{x} = t.{x}" for x in keys)
        for i, ds in enumerate(DATASETS, 1)
    )
    return (
        f"SELECT t.* EXCLUDE (p), round(p, 6) AS p_value, {star()}, s1.mean AS mean_d1, s1.std AS std_d1,"
        f" s2.mean AS mean_d2, s2.std AS std_d2{more} FROM {name} t {joins}"
    )


def pivot(agg, keys, where=""):
    cols = ", ".join(f'round({agg}(value) FILTER (metric = \'{m}\'), 6) AS "{m}"' for m in METRICS)
    return sql("perf", f"SELECT {keys}, {cols} FROM perf {where} GROUP BY {keys}")


FI_CTES = f"""
al AS (SELECT r.dataset, r.algorithm, r.fold, f.feature, coalesce(score, 0.0) AS score
  FROM (SELECT DISTINCT dataset, algorithm, fold FROM fi) r
  CROSS JOIN (VALUES {', '.join(f"('{f}')" for f in FEATURES)}) AS f(feature)
  LEFT JOIN fi ON fi.dataset = r.dataset AND fi.algorithm = r.algorithm AND fi.fold = r.fold AND fi.feature = f.feature),
fm AS (SELECT dataset, algorithm, feature, avg(score) AS mean_fi FROM al GROUP BY ALL),
fnorm AS (SELECT *, CASE WHEN mean_fi > 0 THEN mean_fi / max(mean_fi) OVER (PARTITION BY dataset, algorithm) ELSE 0.0 END AS norm
  FROM fm)"""

FI_TOP = """
baw AS (SELECT dataset, algorithm, greatest(0.0, (avg(value) - 0.5) / 0.5) AS weight FROM perf
  WHERE metric = 'Balanced Accuracy' GROUP BY ALL),
tot AS (SELECT dataset, feature, sum(norm * weight) AS total FROM fnorm JOIN baw USING (dataset, algorithm)
  WHERE feature IN (SELECT feature FROM fm WHERE mean_fi > 0) GROUP BY ALL),
topf AS (SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY round(total, 12) DESC, feature) AS INTEGER) AS rank FROM tot)"""

COMPOSITE = """
picked AS (SELECT fnorm.*, rank FROM fnorm JOIN topf USING (dataset, feature) WHERE rank <= 5),
frac AS (SELECT *, CASE WHEN sum(norm) OVER w > 0 THEN norm / sum(norm) OVER w ELSE 0.0 END AS fraction FROM picked
  WINDOW w AS (PARTITION BY dataset, algorithm)),
vals AS (SELECT frac.*, norm * weight AS weighted, fraction * weight AS weighted_fraction
  FROM frac JOIN baw USING (dataset, algorithm))"""

BOXFI = """
tops AS (SELECT dataset, algorithm, feature FROM fm
  QUALIFY row_number() OVER (PARTITION BY dataset, algorithm ORDER BY round(mean_fi, 12) DESC, feature) <= 3),
sel AS (SELECT al.* FROM al JOIN tops USING (dataset, algorithm, feature)),
q AS (SELECT dataset, algorithm, feature, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
  quantile_cont(score, 0.75) AS q3 FROM sel GROUP BY ALL),
b AS (SELECT *, score BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS near
  FROM sel JOIN q USING (dataset, algorithm, feature))"""


def perf_sql(body, *ctes):
    return sql("perf", body, PERF_R, SIMPSON, *ctes)


ORACLES = {
    "b6_select_fold_features": sql(
        "scores", "SELECT lv.cv, lv.feature, count(*) AS n FROM lv JOIN picks p ON p.fold = lv.cv AND p.feature = lv.feature"
        " WHERE pick <= 4 GROUP BY ALL", CAPPED, LV
    ),
    "g5_rank_scores": sql("scores", "SELECT * FROM scores"),
    "g6_mean_scores": sql("scores", """
SELECT algorithm, feature, round(m, 6) AS mean_score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY algorithm ORDER BY m DESC, feature) AS INTEGER) AS rank FROM (
    SELECT algorithm, feature, avg(score) AS m FROM scores GROUP BY ALL)) WHERE rank <= 4"""),
    "g7_informative": sql("scores", "SELECT * FROM scores WHERE score > 0"),
    "g8_union_informative": sql("scores", "SELECT DISTINCT fold, feature FROM scores WHERE score > 0"),
    "g9_informative_counts": sql("scores", """
SELECT fold, count(DISTINCT feature) FILTER (score > 0) AS informative,
  count(DISTINCT feature) - count(DISTINCT feature) FILTER (score > 0) AS uninformative FROM scores GROUP BY fold"""),
    "g10_cap_features": sql("scores", "SELECT * FROM picks WHERE pick <= 4", CAPPED),
    "g11_select_features": sql(
        "scores", "SELECT lv.* FROM lv JOIN picks p ON p.fold = lv.cv AND p.feature = lv.feature WHERE pick <= 5", CAPPED, LV
    ),
    "h14_align_importance": sql("fi", "SELECT * FROM al", FI_CTES),
    "j1_performance_table": pivot("max", "dataset, fold", "WHERE algorithm = 'A'"),
    "j2_metric_means": pivot("avg", "dataset, algorithm"),
    "j3_metric_stds": pivot("stddev_samp", "dataset, algorithm"),
    "j4_kruskal": perf_sql(test_body("kw"), KRUSKAL),
    "j5_wilcoxon_pairs": perf_sql(test_body("wx"), wilcoxon_cte("wx", "pr", A_KEYS, "algorithm")),
    "j6_mann_whitney_pairs": perf_sql(test_body("mw"), mwu_cte("mw", "pr", A_KEYS, "algorithm")),
    "j7_gated": perf_sql(
        test_body("mw") + " WHERE (dataset, metric) IN (SELECT (dataset, metric) FROM kw WHERE kw.p < 0.05)",
        KRUSKAL, mwu_cte("mw", "pr", A_KEYS, "algorithm")
    ),
    "j8_compare_datasets_kruskal": perf_sql(
        spread("kd", "mo", D_KEYS), kruskal_cte("kd", "pr", D_KEYS, "dataset"), MOMENTS
    ),
    "j8_compare_datasets_wilcoxon": perf_sql(
        sides("wd", "mo", D_KEYS), wilcoxon_cte("wd", "pr", D_KEYS, "dataset"), MOMENTS
    ),
    "j8_compare_datasets_mann_whitney": perf_sql(
        sides("md", "mo", D_KEYS), mwu_cte("md", "pr", D_KEYS, "dataset"), MOMENTS
    ),
    "j9_best_algorithm": perf_sql("SELECT * FROM best", BEST),
    "j10_compare_best_kruskal": perf_sql(
        spread("kb", "best", ["metric"], True), BEST, kruskal_cte("kb", "prb", ["metric"], "dataset")
    ),
    "j10_compare_best_wilcoxon": perf_sql(
        sides("wb", "best", ["metric"], "best"), BEST, wilcoxon_cte("wb", "prb", ["metric"], "dataset")
    ),
    "j10_compare_best_mann_whitney": perf_sql(
        sides("mb", "best", ["metric"], "best"), BEST, mwu_cte("mb", "prb", ["metric"], "dataset")
    ),
    "j11_dataset_trajectory": sql(
        "perf", "SELECT dataset, algorithm, metric, round(avg(value), 6) AS mean FROM perf GROUP BY ALL"
    ),
    "j12_fi_mean": sql("fi", "SELECT dataset, algorithm, feature, round(mean_fi, 6) AS mean_fi FROM fm", FI_CTES),
    "j13_fi_normalize": sql(
        "fi", "SELECT dataset, algorithm, feature, round(mean_fi, 6) AS mean_fi, round(norm, 6) AS norm FROM fnorm", FI_CTES
    ),
    "j14_fi_nonzero_union": sql("fi", "SELECT DISTINCT dataset, feature FROM fm WHERE mean_fi > 0", FI_CTES),
    "j15_ba_weight": sql(
        "perf", "SELECT dataset, algorithm, round(greatest(0.0, (avg(value) - 0.5) / 0.5), 6) AS weight FROM perf"
        " WHERE metric = 'Balanced Accuracy' GROUP BY ALL"
    ),
    "j16_fi_top": sql(
        "all", "SELECT dataset, feature, round(total, 6) AS total, rank FROM topf WHERE rank <= 4", FI_CTES, FI_TOP
    ),
    "j17_fi_fraction": sql("fi", """
SELECT dataset, algorithm, feature, round(mean_fi, 6) AS mean_fi, round(norm, 6) AS norm,
  round(CASE WHEN sum(norm) OVER w > 0 THEN norm / sum(norm) OVER w ELSE 0.0 END, 6) AS fraction
FROM fnorm WINDOW w AS (PARTITION BY dataset, algorithm)""", FI_CTES),
    "j18_fi_weighted": sql("all", """
SELECT dataset, algorithm, feature, round(mean_fi, 6) AS mean_fi, round(norm, 6) AS norm, round(fraction, 6) AS fraction,
  round(weight, 6) AS weight, round(norm * weight, 6) AS weighted, round(fraction * weight, 6) AS weighted_fraction
FROM (SELECT *, CASE WHEN sum(norm) OVER w > 0 THEN norm / sum(norm) OVER w ELSE 0.0 END AS fraction
  FROM fnorm WINDOW w AS (PARTITION BY dataset, algorithm)) JOIN baw USING (dataset, algorithm)""", FI_CTES, FI_TOP),
    **{
        f"j19_composite_{mode.lower()}": sql("all", f"""
SELECT dataset, feature, rank, algorithm, round({col}, 6) AS value, round(coalesce(sum({col}) OVER w, 0.0), 6) AS base
FROM vals WINDOW w AS (PARTITION BY dataset, feature ORDER BY algorithm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""", FI_CTES, FI_TOP, COMPOSITE)
        for mode, col in (("Norm", "norm"), ("Norm_Frac", "fraction"), ("Norm_Weight", "weighted"),
                          ("Norm_Frac_Weight", "weighted_fraction"))
    },
    "j20_fi_rank_table": sql("fi", """
SELECT dataset, algorithm, feature, round(r, 6) AS rank, round(avg(r) OVER (PARTITION BY dataset, feature), 6) AS mean_rank
FROM (SELECT *, (rank() OVER (PARTITION BY dataset, algorithm ORDER BY size DESC)
    + (count(*) OVER (PARTITION BY dataset, algorithm, size) - 1) / 2.0)::DOUBLE AS r
  FROM (SELECT dataset, algorithm, feature, round(avg(abs(score)), 12) AS size FROM al GROUP BY ALL))""", FI_CTES),
    "j21_fi_boxplot_data": sql("fi", """
SELECT dataset, algorithm, feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(score) FILTER (near), 6) AS whisker_low, round(max(score) FILTER (near), 6) AS whisker_high,
  count(*) FILTER (NOT near) AS outliers, count(*) AS n
FROM b GROUP BY dataset, algorithm, feature, q1, median, q3""", FI_CTES, BOXFI),
    "c5_histogram_fi": sql("fi", """
SELECT algorithm, bin, round(lo + bin * (hi - lo) / 10, 6) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 10, 6) AS bin_end,
  count(b) AS n
FROM (SELECT algorithm, min(mean_fi) AS lo, max(mean_fi) AS hi, unnest(range(0, 10))::INTEGER AS bin FROM fm GROUP BY algorithm) g
LEFT JOIN (SELECT algorithm, least(9, floor((mean_fi - min(mean_fi) OVER w) / (max(mean_fi) OVER w - min(mean_fi) OVER w) * 10)) AS b
  FROM fm WINDOW w AS (PARTITION BY algorithm)) h ON h.algorithm = g.algorithm AND h.b = g.bin
GROUP BY ALL""".replace("SELECT algorithm, bin, round(lo", "SELECT g.algorithm, bin, round(lo"), FI_CTES),
    "j22_best_fold": sql("perf", """
SELECT dataset, fold, round(value, 6) AS value FROM perf WHERE algorithm = 'A' AND metric = 'ROC_AUC'
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY perf.value DESC, fold) = 1"""),
    "j23_runtime_summary": sql(
        "runlog", "SELECT dataset, component, round(sum(seconds), 6) AS seconds FROM runlog GROUP BY ALL"
    ),
    "j24_missing_runs": sql(
        "runlog", "SELECT dataset, fold, component FROM runlog WHERE component = 'LR' AND fold IN (1, 3)"
    ),
}
