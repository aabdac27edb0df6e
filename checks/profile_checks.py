"""Filters, profiling, univariate tests and folds: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.sql_tables import FEATURES, sql
from sparkassay.functions.columns import clean_label, shuffle_key, sig_flag
from sparkassay.operators import clean, folds, profile, univariate

ALL_COLUMNS = ["inst_id", "match_id", "class", *FEATURES]
CAT, QUANT, ROLES, K = fx.CATEGORICAL, fx.QUANTITATIVE, fx.ROLES, fx.K
KINDS = {"categorical": CAT, "quantitative": QUANT}


def rounded(df, *names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def union(parts):
    return "\nUNION ALL ".join(parts)


CONT = f"""
cont AS (
  SELECT feature, value, count(*) FILTER (class = 0) AS n0, count(*) FILTER (class = 1) AS n1
  FROM lng WHERE value IS NOT NULL AND feature IN ('{"','".join(CAT)}') GROUP BY ALL
)"""

CHI = """
marg AS (SELECT feature, sum(n0)::DOUBLE AS c0, sum(n1)::DOUBLE AS c1, CAST(count(*) - 1 AS INTEGER) AS dof
  FROM cont GROUP BY feature),
gap AS (
  SELECT feature, dof, e, abs(o - e) AS g FROM (
    SELECT feature, dof, n0 AS o, (n0 + n1) * c0 / (c0 + c1) AS e FROM cont JOIN marg USING (feature)
    UNION ALL SELECT feature, dof, n1, (n0 + n1) * c1 / (c0 + c1) FROM cont JOIN marg USING (feature))
),
chi AS (
  SELECT feature, dof, sum(CASE WHEN dof = 1 THEN (g - least(0.5, g)) ** 2 ELSE g ** 2 END / e) AS statistic
  FROM gap GROUP BY feature, dof
)"""

# 2 * upper normal tail by Simpson's rule
TAIL = """
simpson AS (
  SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(0, 4001) AS r(i)
)"""


def tail(z: str) -> str:
    return (
        f"(1 - 2 * (SELECT sum(w * exp(-pow(least({z}, 8.0) * i / 4000.0, 2) / 2)) * least({z}, 8.0) / 12000.0"
        f" / sqrt(2 * pi()) FROM simpson))"
    )


CHI_P = f"""
chip AS (
  SELECT feature, dof, statistic, CASE dof
    WHEN 1 THEN {tail('sqrt(statistic)')}
    WHEN 2 THEN exp(-statistic / 2)
    WHEN 4 THEN exp(-statistic / 2) * (1 + statistic / 2) END AS p_value
  FROM chi
)"""

MWU = f"""
ranked AS (
  SELECT feature, class, value, (rank() OVER w + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0)::DOUBLE AS r
  FROM lng WHERE value IS NOT NULL AND feature IN ('{"','".join(QUANT)}')
  WINDOW w AS (PARTITION BY feature ORDER BY value)
),
tied AS (
  SELECT feature, sum(t ** 3 - t) AS ties FROM (
    SELECT feature, value, count(*)::DOUBLE AS t FROM ranked GROUP BY ALL) GROUP BY feature
),
ranksum AS (
  SELECT feature, count(*) FILTER (class = 0)::DOUBLE AS n0, count(*) FILTER (class = 1)::DOUBLE AS n1,
    sum(r) FILTER (class = 0) AS r0, sum(r) FILTER (class = 1) AS r1
  FROM ranked GROUP BY feature
),
mwu AS (
  SELECT feature, r0 - n0 * (n0 + 1) / 2 AS u1, r1 - n1 * (n1 + 1) / 2 AS u2, n0 * n1 / 2 AS mu,
    sqrt(n0 * n1 / 12 * (n0 + n1 + 1 - ties / ((n0 + n1) * (n0 + n1 - 1)))) AS sd
  FROM ranksum JOIN tied USING (feature)
),
mwup AS (SELECT *, least(1.0, {tail('((greatest(u1, u2) - mu - 0.5) / sd)')}) AS p_value FROM mwu)"""

BOX = """
cuts AS (
  SELECT class, quantile_cont(f_price, 0.25) AS q1, quantile_cont(f_price, 0.5) AS median,
    quantile_cont(f_price, 0.75) AS q3 FROM fold WHERE f_price IS NOT NULL GROUP BY class
)"""


def tests_sql():
    return [CONT, CHI, TAIL, CHI_P, MWU, """
tests AS (
  SELECT feature, 'chi2' AS test, statistic, p_value FROM chip
  UNION ALL SELECT feature, 'mann_whitney', least(u1, u2), p_value FROM mwup
)"""]


def tests_df(s, d):
    return univariate.univariate_tests(fx.fold(s, d), ROLES, KINDS)


def keys_of(df):
    return df.select("inst_id", "fold")


QUERIES = {
    "b1_drop_missing_class": lambda s, d: clean.drop_missing_class(fx.feat(s, d), ROLES),
    "b2_drop_features": lambda s, d: clean.drop_features(fx.feat(s, d), ["f_price", "f_big"]),
    "b3_features_only": lambda s, d: clean.features_only(fx.feat(s, d), ROLES),
    "b4_resolve_match": lambda s, d: keys_of(
        folds.make_folds(fx.feat(s, d).where("class is not null").drop("match_id"), K, 7, ROLES, "matched")
    ),
    "b5_align_to": lambda s, d: clean.align_to(
        FEATURES, fx.feat(s, d).select(*reversed(ALL_COLUMNS)).withColumn("f_extra", F.lit(1)), ROLES
    ),
    "b7_feature_names": lambda s, d: clean.feature_names(fx.feat(s, d), ROLES),
    "b8_significant": lambda s, d: rounded(
        clean.significant(tests_df(s, d), 0.5), "statistic", "p_value"
    ),
    "b9_clean_label": lambda s, d: fx.feat(s, d).groupBy(
        clean_label(F.concat(F.lit("Seg ment*"), F.col("f_segment").cast("string"), F.lit("/x"))).alias("label")
    ).agg(F.count(F.lit(1)).alias("n")),
    "b10_sig_flag": lambda s, d: tests_df(s, d).select("feature", sig_flag(F.col("p_value"), 0.5).alias("flag")),
    "c1_describe": lambda s, d: rounded(
        profile.describe(fx.feat(s, d), FEATURES), "mean", "std", "min", "p25", "p50", "p75", "max"
    ),
    "c2_column_profile": lambda s, d: profile.column_profile(fx.feat(s, d)),
    "c3_unique_counts": lambda s, d: profile.unique_counts(fx.feat(s, d)),
    "c4_missing_counts": lambda s, d: profile.missing_counts(fx.feat(s, d)),
    "c5_histogram": lambda s, d: rounded(
        profile.histogram(fx.feat(s, d), "f_price", 50), "bin_start", "bin_end"
    ),
    "c5_histogram_by_class": lambda s, d: rounded(
        profile.histogram(fx.fold(s, d), "f_acctbal", 20, ["class"], 2), "bin_start", "bin_end"
    ),
    "c6_counts_summary": lambda s, d: profile.counts_summary(
        fx.feat(s, d), ROLES, profile.feature_kinds(fx.feat(s, d), ROLES)
    ),
    "c7_class_counts": lambda s, d: profile.class_counts(fx.feat(s, d).where("class is not null"), ROLES),
    "c8_feature_kinds": lambda s, d: profile.feature_kinds(fx.feat(s, d), ROLES),
    "c9_correlation_matrix": lambda s, d: rounded(profile.correlation_matrix(fx.feat(s, d), FEATURES), "corr"),
    "c9_correlation_moments": lambda s, d: rounded(
        profile.correlation_matrix(fx.feat(s, d), FEATURES), "corr"
    ),
    "c10_contingency": lambda s, d: profile.contingency(fx.fold(s, d), CAT, "class"),
    "c11_boxplot_stats": lambda s, d: rounded(
        profile.boxplot_stats(fx.fold(s, d), "f_price", ["class"], 2), "q1", "median", "q3"
    ),
    "c12_no_skill": lambda s, d: rounded(profile.no_skill(fx.fold(s, d), ROLES), "no_skill"),
    "d1_chi2": lambda s, d: rounded(
        univariate.chi2_by_feature(fx.fold(s, d), CAT, "class").drop("test"), "statistic", "p_value"
    ),
    "d2_mann_whitney": lambda s, d: rounded(
        univariate.mann_whitney_by_feature(fx.fold(s, d), QUANT, "class").drop("test", "p_one_sided"), "p_value"
    ),
    "d3_univariate_tests": lambda s, d: rounded(tests_df(s, d), "statistic", "p_value"),
    "d4_top_univariate": lambda s, d: rounded(
        univariate.top_univariate(tests_df(s, d), 4), "statistic", "p_value"
    ),
    "e1_shuffle_key": lambda s, d: fx.feat(s, d).select("inst_id", shuffle_key(42, F.col("inst_id")).alias("key")),
    "e2_random_folds": lambda s, d: keys_of(
        folds.random_folds(clean.drop_missing_class(fx.feat(s, d), ROLES), K, 42, ROLES)
    ),
    "e3_stratified_folds": lambda s, d: fx.fold_plan(s, d).select("inst_id", "class", "fold"),
    "e4_matched_folds": lambda s, d: keys_of(
        folds.matched_folds(clean.drop_missing_class(fx.feat(s, d), ROLES), K, 42, ROLES)
    ),
    "e5_expand_folds": lambda s, d: folds.expand_folds(fx.fold(s, d), K).select("cv", "part", "inst_id", "class"),
    "e5_train_test": lambda s, d: folds.train_test(fx.fold(s, d), 0)[0].select("inst_id", F.lit("train").alias("part"))
    .unionByName(folds.train_test(fx.fold(s, d), 0)[1].select("inst_id", F.lit("test").alias("part"))),
    "e6_stratified_sample": lambda s, d: folds.stratified_sample(fx.fold(s, d), 1000, 9, ROLES).select(
        "inst_id", "class"
    ),
    "e7_instance_sample": lambda s, d: folds.instance_sample(fx.fold(s, d), 2000, 11, ROLES).select("inst_id", "class"),
    "e8_inner_folds": lambda s, d: folds.inner_folds(fx.fold(s, d).where("fold <> 0"), 42, ROLES).select(
        "inst_id", "class", "inner_fold"
    ),
}

UNIQUE = union(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM feat" for c in ALL_COLUMNS)
MISSING = union(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM feat" for c in ALL_COLUMNS
)
KIND = union(
    f"SELECT '{f}' AS feature, count(DISTINCT {f}) AS n_unique FROM feat" for f in FEATURES
)
TYPES = {"inst_id": "bigint", "match_id": "bigint", "f_price": "double", "f_acctbal": "double"}


def key_rank(seed, key, source, part="", k=5, name="fold", keep="inst_id"):
    over = f"PARTITION BY {part} " if part else ""
    return (
        f"SELECT {keep}, CAST((row_number() OVER ({over}ORDER BY md5('{seed}|' || CAST({key} AS VARCHAR)), {key}) - 1)"
        f" % {k} AS INTEGER) AS {name} FROM {source}"
    )


def hist(source, col, bins, by=None):
    sel = f"{by}, " if by else ""
    using = f"USING ({by})" if by else "ON true"
    return f"""
lim AS (SELECT {sel}min({col}) AS lo, max({col}) AS hi FROM {source} WHERE {col} IS NOT NULL {'GROUP BY ' + by if by else ''}),
grid AS (SELECT {sel}lo, hi, CAST(bin AS INTEGER) AS bin FROM lim, range(0, {bins}) AS r(bin)),
cnt AS (
  SELECT {sel}least(CAST(floor(({col} - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
  FROM {source} JOIN lim {using} WHERE {col} IS NOT NULL GROUP BY ALL
)""", (
        f"SELECT {sel}bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_start,"
        f" round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS bin_end, coalesce(n, 0) AS n"
        f" FROM grid LEFT JOIN cnt USING ({sel}bin)"
    )


H1, H1_BODY = hist("feat", "f_price", 50)
H2, H2_BODY = hist("fold", "f_acctbal", 20, "class")
CORR = union(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS corr FROM feat"
    for a in FEATURES for b in FEATURES
)

ORACLES = {
    "b1_drop_missing_class": sql("feat", "SELECT * FROM feat WHERE class IS NOT NULL"),
    "b2_drop_features": sql("feat", "SELECT * EXCLUDE (f_price, f_big) FROM feat"),
    "b3_features_only": sql("feat", f"SELECT {', '.join(FEATURES)} FROM feat"),
    "b4_resolve_match": sql("feat", key_rank(7, "inst_id", "feat WHERE class IS NOT NULL", "class")),
    "b5_align_to": sql("feat", f"SELECT inst_id, match_id, class, {', '.join(FEATURES)} FROM feat"),
    "b7_feature_names": sql("feat", union(
        f"SELECT {i} AS position, '{f}' AS feature, count({f}) AS n_values FROM feat" for i, f in enumerate(FEATURES)
    )),
    "b8_significant": sql(
        "long", "SELECT feature, test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value"
        " FROM tests WHERE p_value <= 0.5", *tests_sql()
    ),
    "b9_clean_label": sql(
        "feat", "SELECT 'Segment' || f_segment || 'x' AS label, count(*) AS n FROM feat GROUP BY 1"
    ),
    "b10_sig_flag": sql(
        "long", "SELECT feature, CASE WHEN p_value < 0.5 THEN '*' ELSE '' END AS flag FROM tests", *tests_sql()
    ),
    "c1_describe": sql("feat", union(
        f"SELECT '{f}' AS feature, count({f}) AS count, round(avg({f}), 6) AS mean, round(stddev_samp({f}), 6) AS std,"
        f" round(min({f})::DOUBLE, 6) AS min, round(quantile_cont({f}::DOUBLE, 0.25), 6) AS p25,"
        f" round(quantile_cont({f}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({f}::DOUBLE, 0.75), 6) AS p75,"
        f" round(max({f})::DOUBLE, 6) AS max FROM feat" for f in FEATURES
    )),
    "c2_column_profile": sql(
        "feat", "SELECT \"column\", CASE " + " ".join(
            f"WHEN \"column\" = '{c}' THEN '{TYPES.get(c, 'int')}'" for c in ALL_COLUMNS
        ) + " END AS type, missing, n_unique FROM u JOIN m USING (\"column\")", f"u AS ({UNIQUE})", f"m AS ({MISSING})"
    ),
    "c3_unique_counts": sql("feat", UNIQUE),
    "c4_missing_counts": sql(
        "feat", "SELECT *, CAST(sum(missing) OVER () AS BIGINT) AS total_missing FROM m", f"m AS ({MISSING})"
    ),
    "c5_histogram": sql("feat", H1_BODY, H1),
    "c5_histogram_by_class": sql("fold", H2_BODY, H2),
    "c6_counts_summary": sql("feat", """
SELECT 'instances' AS variable, count(*)::DOUBLE AS count FROM feat
UNION ALL SELECT 'features', count(*)::DOUBLE FROM k
UNION ALL SELECT 'categorical_features', (count(*) FILTER (n_unique <= 10))::DOUBLE FROM k
UNION ALL SELECT 'quantitative_features', (count(*) FILTER (n_unique > 10))::DOUBLE FROM k
UNION ALL SELECT 'missing_values', sum(missing)::DOUBLE FROM m
UNION ALL SELECT 'missing_percent', round((SELECT sum(missing) FROM m)::DOUBLE / (7 * count(*)), 5) FROM feat
""", f"k AS ({KIND})", f"m AS ({MISSING})"),
    "c7_class_counts": sql("feat", "SELECT class, count(*) AS n FROM feat WHERE class IS NOT NULL GROUP BY class"),
    "c8_feature_kinds": sql(
        "feat", "SELECT feature, CASE WHEN n_unique <= 10 THEN 'categorical' ELSE 'quantitative' END AS kind, n_unique"
        " FROM k", f"k AS ({KIND})"
    ),
    "c9_correlation_matrix": sql("feat", CORR),
    "c9_correlation_moments": sql("feat", CORR),
    "c10_contingency": sql("long", "SELECT * FROM cont", CONT),
    "c11_boxplot_stats": sql("fold", """
SELECT class, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(f_price) FILTER (f_price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(f_price) FILTER (f_price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (f_price NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers,
  count(*) AS n
FROM fold JOIN cuts USING (class) WHERE f_price IS NOT NULL GROUP BY class, q1, median, q3""", BOX),
    "c12_no_skill": sql("fold", "SELECT round(avg(class), 6) AS no_skill FROM fold"),
    "d1_chi2": sql(
        "long", "SELECT feature, round(statistic, 6) AS statistic, dof, round(p_value, 6) AS p_value FROM chip",
        CONT, CHI, TAIL, CHI_P
    ),
    "d2_mann_whitney": sql(
        "long", "SELECT feature, least(u1, u2) AS statistic, u1, u2, round(p_value, 6) AS p_value FROM mwup", TAIL, MWU
    ),
    "d3_univariate_tests": sql(
        "long", "SELECT feature, test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value FROM tests",
        *tests_sql()
    ),
    "d4_top_univariate": sql(
        "long", "SELECT feature, test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value FROM tests"
        " ORDER BY tests.p_value, feature LIMIT 4", *tests_sql()
    ),
    "e1_shuffle_key": sql("feat", "SELECT inst_id, md5('42|' || CAST(inst_id AS VARCHAR)) AS key FROM feat"),
    "e2_random_folds": sql("feat", key_rank(42, "inst_id", "feat WHERE class IS NOT NULL")),
    "e3_stratified_folds": sql("fold", "SELECT inst_id, class, fold FROM fold"),
    "e4_matched_folds": sql("feat", """
SELECT inst_id, fold FROM feat JOIN dealt USING (match_id) WHERE class IS NOT NULL""", """
lead_row AS (
  SELECT match_id, arg_min(inst_id, md5('42|' || CAST(inst_id AS VARCHAR))) AS lead_id
  FROM feat WHERE class IS NOT NULL GROUP BY match_id
),
dealt AS (""" + key_rank(42, "lead_id", "lead_row", keep="match_id") + ")"),
    "e5_expand_folds": sql("fold", """
SELECT CAST(cv AS INTEGER) AS cv, CASE WHEN cv = fold THEN 'test' ELSE 'train' END AS part, inst_id, class
FROM fold CROSS JOIN range(0, 5) AS r(cv)"""),
    "e5_train_test": sql("fold", "SELECT inst_id, CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part FROM fold"),
    "e6_stratified_sample": sql("fold", """
SELECT inst_id, class FROM (
  SELECT inst_id, class, row_number() OVER (PARTITION BY class ORDER BY md5('9|' || CAST(inst_id AS VARCHAR)), inst_id) AS r
  FROM fold) JOIN quota USING (class) WHERE r <= q""", """
sized AS (SELECT class, 1000.0::DOUBLE * count(*) / (SELECT count(*) FROM fold) AS share FROM fold GROUP BY class),
quota AS (
  SELECT class, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, class)
    <= 1000 - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS q FROM sized
)"""),
    "e7_instance_sample": sql(
        "fold", "SELECT inst_id, class FROM fold ORDER BY md5('11|' || CAST(inst_id AS VARCHAR)), inst_id LIMIT 2000"
    ),
    "e8_inner_folds": sql("fold", key_rank(
        43, "inst_id", "fold WHERE fold <> 0", "class", 3, "inner_fold", "inst_id, class"
    )),
}
