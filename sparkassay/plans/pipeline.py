"""All phases in order: profile, folds, preparation, selection, models, statistics, new data.

Each phase writes its tables under ``<out>/<dataset>/`` and the next one reads them, so
a run can stop and go on after any phase and plans stay short. The data themselves are
stored once, as the fold table; prepared versions are expressions over it.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkassay.operators import (
    clean,
    composite,
    evaluate,
    folds,
    importance,
    iterative,
    prep,
    profile,
    replication,
    selection,
    significance,
    summarize,
    univariate,
)
from sparkassay.operators.models import fitted as fm
from sparkassay.operators.models import tune
from sparkassay.roles import Roles
from sparkassay.session import cut_lineage
from sparkassay.sources import sinks


@dataclass
class Settings:
    k: int = 10
    seed: int = 42
    partition_method: str = "stratified"
    categorical_cutoff: int = 10
    categorical: tuple[str, ...] = ()
    ignore: tuple[str, ...] = ()
    sig_cutoff: float = 0.05
    impute: bool = True
    iterative_impute: bool = True
    scale: bool = True
    scorers: tuple[str, ...] = ("mi", "ms")
    instance_subset: int | None = None  # all rows
    use_turf: bool = False
    turf_pct: float = 0.5
    max_features: int | None = None
    filter_features: bool = True
    algorithms: tuple[str, ...] = ("NB", "LR", "DT")
    primary_metric: str = "balanced_accuracy"
    n_trials: int = 100
    timeout: float | None = None
    subsample: int = 0
    uniform_importance: bool = False
    n_repeats: int = 10
    top_features: int | None = None
    parallel: int = 4
    params: dict = field(default_factory=dict)


class Run:
    """One data set's tables under ``<out>/<name>``."""

    def __init__(self, spark: SparkSession, out: str, name: str, roles: Roles, settings: Settings):
        self.spark, self.name, self.settings = spark, name, settings
        self.path = f"{out.rstrip('/')}/{name}"
        self.roles = Roles(roles.class_col, roles.inst_col or "instance", roles.match_col, "fold")

    def save(self, df: DataFrame, table: str) -> DataFrame:
        sinks.write_result(df, f"{self.path}/{table}")
        return self.load(table)

    def load(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}")

    def timed(self, component: str, fold: int | None = None):
        return sinks.timed(self.spark, f"{self.path}/run_log", self.name, component, fold)

    # phase 1
    def explore(self, df: DataFrame) -> None:
        s = self.settings
        df, self.roles = clean.ensure_instance(df, self.roles, self.roles.inst_col)
        roles = self.roles
        with self.timed("exploratory"):
            rows = clean.drop_features(clean.drop_missing_class(df, roles), list(s.ignore))
            method = clean.resolve_match(rows, roles, s.partition_method)
            if method != "matched" and roles.match_col in rows.columns:
                rows = rows.drop(roles.match_col)
            sinks.write_folds(folds.make_folds(rows, s.k, s.seed, roles, method), f"{self.path}/folds", mode="overwrite")
            table = self.load("folds")
            kinds = self.save(profile.feature_kinds(table, roles, s.categorical_cutoff, s.categorical), "kinds")
            by_kind = profile.kinds_dict(kinds)
            features = roles.features(table)
            self.save(profile.column_profile(table), "column_profile")
            self.save(profile.describe(table, features), "describe")
            self.save(profile.counts_summary(table, roles, kinds), "counts")
            self.save(profile.class_counts(table, roles), "class_counts")
            self.save(profile.correlation_matrix(table, features), "correlation")
            self.save(univariate.univariate_tests(table, roles, by_kind), "univariate")
            settings = {k: v for k, v in asdict(s).items()}
            self.save(sinks.settings_table(self.spark, settings), "settings")

    def table(self) -> DataFrame:
        return self.load("folds")

    def kinds(self) -> dict[str, list[str]]:
        return profile.kinds_dict(self.load("kinds"))

    # phase 2
    def preprocess(self) -> None:
        s, table, kinds = self.settings, self.table(), self.kinds()
        features = self.roles.features(table)
        with self.timed("preprocessing"):
            fill = None
            if s.impute and prep.needs_imputation(table, features).first()["needed"]:
                if s.iterative_impute and kinds["quantitative"]:
                    if kinds["categorical"]:
                        fill = self.save(prep.fit_mode(table, kinds["categorical"], s.k), "fill")
                    state = iterative.fit_iterative(table, kinds["quantitative"], s.k)
                    self.save(state, "iterative")
                else:
                    fill = self.save(prep.fit_fill(table, kinds, s.k), "fill")
            if s.scale:
                if self._has("iterative"):
                    train = self._filled(folds.train_rows(table, s.k), features)
                    self.save(prep.fit_scaler_prepared(train, features), "scaler")
                else:
                    self.save(prep.fit_scaler(table, features, s.k, fill), "scaler")

    def _has(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _filled(self, rows: DataFrame, features: list[str]) -> DataFrame:
        kinds = self.kinds()
        if self._has("fill"):
            state = self.load("fill")
            known = [f for f in features if f in set(kinds["categorical"]) or not self._has("iterative")]
            rows = prep.apply_fill(rows, state, known, self.settings.k)
        if self._has("iterative"):
            rows = iterative.apply_iterative(rows, self.load("iterative"), kinds["quantitative"])
        return rows

    def prepared(self, rows: DataFrame, features: list[str]) -> DataFrame:
        """Rows that carry ``cv``, filled and scaled; nothing is stored."""
        out = self._filled(rows, features)
        return prep.apply_scaler(out, self.load("scaler"), features, self.settings.k) if self._has("scaler") else out

    def view(self, cv: int, part: str = "train") -> DataFrame:
        """Prepared rows of one model index; the fold filter prunes files."""
        table = self.table()
        rows = table.where(F.col("fold") != cv if part == "train" else F.col("fold") == cv)
        return self.prepared(rows.withColumn("cv", F.lit(cv)), self.roles.features(table))

    # phases 3 and 4
    def score_features(self) -> None:
        s, kinds = self.settings, self.kinds()
        features = self.roles.features(self.table())
        parts = []
        train = self.prepared(folds.train_rows(self.table(), s.k), features)
        if "mi" in s.scorers:
            with self.timed("mutualinformation"):
                mi = importance.mutual_information(train, kinds, self.roles.class_col, ids=["cv"], versions=s.k)
                parts.append(self.save(mi.select(F.col("cv").alias("fold"), F.lit("mi").alias("algorithm"), "feature", "score"), "scores_mi"))
        if "ms" in s.scorers:
            with self.timed("multisurf"):
                sample = None
                for cv in range(s.k):
                    rows = self.view(cv)
                    if s.instance_subset is not None:
                        rows = folds.instance_sample(rows, s.instance_subset, s.seed + cv, self.roles)
                    sample = rows if sample is None else sample.unionByName(rows)
                options = {"inst": self.roles.inst_col, "class_col": self.roles.class_col}
                scorer = importance.turf if s.use_turf else importance.multisurf
                extra = {"pct": s.turf_pct} if s.use_turf else {}
                ms = scorer(sample, kinds, **extra, **options)
                parts.append(self.save(ms.select(F.col("cv").alias("fold"), F.lit("ms").alias("algorithm"), "feature", "score"), "scores_ms"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        self.save(selection.rank_scores(out), "scores")

    def select(self) -> dict[int, list[str]]:
        s = self.settings
        features = self.roles.features(self.table())
        if not s.filter_features:
            return {cv: features for cv in range(s.k)}
        with self.timed("featureselection"):
            scores = self.load("scores")
            self.save(selection.informative_counts(scores), "informative_counts")
            self.save(selection.mean_scores(scores), "mean_scores")
            chosen = self.save(selection.cap_features(scores, s.max_features), "selected")
        lists = selection.selected_lists(chosen, features)
        without = [cv for cv in range(s.k) if not lists.get(cv)]
        if without:
            raise ValueError(f"no informative feature in model indexes {without}; set filter_features=False to use all")
        return {cv: lists[cv] for cv in range(s.k)}

    # phase 5
    def model(self, chosen: dict[int, list[str]]) -> dict[tuple[int, str], fm.Fitted]:
        s = self.settings
        views = {cv: (self.view(cv), chosen[cv]) for cv in range(s.k)}
        models, log = tune.train_all(
            views, list(s.algorithms), self.roles, s.parallel, n_trials=s.n_trials, timeout=s.timeout,
            metric=s.primary_metric, seed=s.seed, subsample=s.subsample, params=s.params,
        )
        done = self.save(log, "training_log")
        rows = done.select(F.lit(self.name).alias("dataset"), "fold", F.col("algorithm").alias("component"), "seconds")
        rows.write.mode("append").parquet(f"{self.path}/run_log")
        preds, fis = None, None
        for cv in range(s.k):
            own = [models[cv, a] for a in s.algorithms if (cv, a) in models]
            if not own:
                continue
            part = fm.many_predictions(own, self.view(cv, "test"), self.name, cv)
            preds = part if preds is None else preds.unionByName(part)
            for m in own:
                m.save(f"{self.path}/models/{m.algorithm}_{cv}")
                table = tune.importance_table(
                    m, views[cv][0], self.name, cv, s.primary_metric, s.uniform_importance, s.n_repeats, s.seed
                )
                fis = table if fis is None else fis.unionByName(table)
        self.save(preds, "predictions")
        self.save(fis, "importances")
        return models

    # phase 6
    def statistics(self) -> None:
        s = self.settings
        with self.timed("Stats"):
            pred = self.load("predictions")
            groups = s.k * len(s.algorithms)
            perf = self.save(evaluate.evaluate(pred, groups=groups), "performance")
            self.save(summarize.metric_means(perf), "metric_means")
            self.save(summarize.metric_stds(perf), "metric_stds")
            self.save(evaluate.mean_curve(pred, "roc", groups=groups), "mean_roc")
            self.save(evaluate.mean_curve(pred, "prc", groups=groups), "mean_prc")
            self.save(evaluate.curve_summary(perf), "curve_summary")
            if len(s.algorithms) > 1:
                kw = self.save(significance.kruskal(perf, cutoff=s.sig_cutoff), "kruskal")
                self.save(significance.gated(significance.wilcoxon_pairs(perf, cutoff=s.sig_cutoff), kw), "wilcoxon")
                self.save(significance.gated(significance.mann_whitney_pairs(perf, cutoff=s.sig_cutoff), kw), "mann_whitney")
            features = self.roles.features(self.table())
            fi = self.save(composite.align_importance(self.load("importances"), features), "importances_aligned")
            means = composite.fi_mean(fi)
            for mode in composite.MODES:
                self.save(composite.composite_fi(means, perf, mode, s.top_features), f"composite_{mode}")
            self.save(composite.fi_rank_table(fi), "fi_ranks")
        self.save(summarize.runtime_summary(self.load("run_log")), "runtimes")

    # phase 9
    def apply(self, df: DataFrame, rep_name: str, models: dict[tuple[int, str], fm.Fitted] | None = None) -> dict[str, DataFrame]:
        """Score and summarise new data with the stored state and models."""
        s = self.settings
        features = self.roles.features(self.table())
        df = clean.ensure_instance(df, self.roles, self.roles.inst_col)[0]
        rows = clean.align_to(features, clean.drop_missing_class(df, self.roles), self.roles)
        if models is None:
            models = {
                (cv, a): fm.load(self.spark, f"{self.path}/models/{a}_{cv}")
                for cv in range(s.k) for a in s.algorithms if self._has(f"models/{a}_{cv}")
            }
        pred = replication.apply_models(
            models, lambda cv: self.prepared(rows.withColumn("cv", F.lit(cv)), features), rep_name
        )
        pred = self.save(pred, f"applymodel/{rep_name}/predictions")
        out = {
            **replication.profile_replication(rows, self.roles, self.load("kinds")),
            **replication.summarise_replication(pred, rows, self.roles, s.k * len(s.algorithms)),
        }
        return {name: self.save(table, f"applymodel/{rep_name}/{name}") for name, table in out.items()}


def run_dataset(df: DataFrame, name: str, roles: Roles, settings: Settings, out: str) -> tuple[Run, dict]:
    """Phases 1 to 6 on one data set."""
    run = Run(df.sparkSession, out, name, roles, settings)
    run.explore(df)
    run.preprocess()
    if settings.filter_features:
        run.score_features()
    models = run.model(run.select())
    run.statistics()
    return run, models


def compare_runs(runs: list[Run], cutoff: float = 0.05) -> dict[str, DataFrame]:
    """Phase 7: the performance tables of several data sets against each other."""
    perf = runs[0].load("performance")
    for run in runs[1:]:
        perf = perf.unionByName(run.load("performance"))
    perf = cut_lineage(perf, "performance")
    names = [run.name for run in runs]
    out = {"trajectory": summarize.dataset_trajectory(perf), "best": significance.best_algorithm(perf)}
    for test in ("kruskal", "wilcoxon", "mann_whitney"):
        out[test] = significance.compare_datasets(perf, test, names, cutoff)
        out[f"best_{test}"] = significance.compare_best(perf, test, names, cutoff)
    return out
