"""Parameter search and the fold x algorithm grid. The driver only submits Spark jobs."""

from __future__ import annotations

import json
import random
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.operators.evaluate import score
from sparkassay.operators.folds import inner_folds, stratified_sample
from sparkassay.operators.models import fitted as fm
from sparkassay.operators.models.permute import permutation_importance
from sparkassay.operators.models.spaces import SPACES, draw, is_single
from sparkassay.roles import Roles
from sparkassay.session import cut_lineage

TRIALS = "trial int, params string, score double, status string"
SAMPLED = ("GB", "SVM", "ANN", "KN")  # slow learners may train on a subsample


def cv_score(rows: DataFrame, algorithm: str, roles: Roles, features: list[str], params: dict, metric: str, seed: int, k: int = 3) -> float:
    """Mean metric over the inner folds."""
    parts = []
    for j in range(k):
        model = fm.fit(algorithm, rows.where(F.col("inner_fold") != j), roles, features, params, seed)
        parts.append(fm.predictions(model, rows.where(F.col("inner_fold") == j), "inner", j))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return score(every, metric, groups=k).agg(F.avg("score")).first()[0]


def sweep(
    train: DataFrame, algorithm: str, roles: Roles, features: list[str], n_trials: int = 100, timeout: float | None = None,
    metric: str = "balanced_accuracy", seed: int = 42, space: dict | None = None, parallel: int = 4,
) -> DataFrame:
    """Trials ``(trial, params, score, status)``. Draws are seeded and numbered, so the table does not
    depend on which trial ends first; a failing combination is recorded, and none starts after a time limit, if given."""
    space = SPACES[algorithm] if space is None else space
    rng = random.Random(seed)
    if is_single(space):
        only = {name: limits[0] for name, (_, *limits) in space.items()}
        return train.sparkSession.createDataFrame([(0, json.dumps(only), None, "single")], TRIALS)
    rows = cut_lineage(inner_folds(train, seed, roles), "inner")
    draws = [draw(space, rng) for _ in range(n_trials)]
    deadline = float("inf") if timeout is None else time.time() + timeout

    def trial(number: int):
        if time.time() > deadline:
            return (number, json.dumps(draws[number]), None, "not started")
        try:
            value = cv_score(rows, algorithm, roles, features, draws[number], metric, seed)
        except Exception as err:  # Spark's errors of invalid parameters are of several kinds
            return (number, json.dumps(draws[number]), None, f"failed: {str(err)[:500]}")
        if value is None or value != value:
            return (number, json.dumps(draws[number]), None, "failed: no score")
        return (number, json.dumps(draws[number]), float(value), "done")

    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(inheritable_thread_target(trial), range(n_trials)))
    return train.sparkSession.createDataFrame(done, TRIALS)


def best_params(trials: DataFrame) -> DataFrame:
    """Parameters of the best trial that worked, the earlier one on ties; NULL if none did."""
    trials = trials.where("status in ('done', 'single')")
    order = F.struct(F.coalesce("score", F.lit(-1.0)).alias("s"), (-F.col("trial")).alias("t"))
    return trials.agg(F.max_by("params", order).alias("params"), F.max("score").alias("score"))


def train_one(
    train: DataFrame, algorithm: str, roles: Roles, features: list[str], *, n_trials: int = 0, timeout: float | None = None,
    metric: str = "balanced_accuracy", seed: int = 42, subsample: int = 0, params: dict | None = None, space: dict | None = None,
) -> fm.Fitted:
    """Optional subsample, optional sweep, then the final fit."""
    rows = train
    if subsample and algorithm in SAMPLED:
        rows = stratified_sample(train, subsample, seed, roles)
    chosen = dict(params or {})
    if n_trials and not is_single(SPACES[algorithm] if space is None else space):
        trials = sweep(rows, algorithm, roles, features, n_trials, timeout, metric, seed, space)
        best = best_params(trials).first()["params"]
        if best is None:
            raise ValueError(f"no trial of {algorithm} worked: {trials.first()['status']}")
        chosen.update(json.loads(best))
    return fm.fit(algorithm, rows, roles, features, chosen, seed)


def importance_table(
    model: fm.Fitted, train: DataFrame, dataset: str, fold: int, metric: str = "balanced_accuracy", uniform: bool = False,
    n_repeats: int = 10, seed: int = 42,
) -> DataFrame:
    """Rows ``(dataset, algorithm, fold, feature, score)``: the model's own importances, or permutation."""
    own = None if uniform else model.native_importance()
    if own is None:
        scores = permutation_importance(model, train, metric, n_repeats, seed)
    else:
        scores = train.sparkSession.createDataFrame(list(own.items()), "feature string, score double")
    return scores.select(
        F.lit(dataset).alias("dataset"), F.lit(model.algorithm).alias("algorithm"), F.lit(fold).alias("fold"), "feature", "score"
    )


def train_all(
    views: dict[int, tuple[DataFrame, list[str]]], algorithms: list[str], roles: Roles, parallel: int = 4, **options
) -> tuple[dict[tuple[int, str], fm.Fitted], DataFrame]:
    """Fit the fold x algorithm grid. ``views`` maps a fold to its prepared training rows and features.

    Returns the models and a log ``(fold, algorithm, seconds, status)``; a failed run is logged, not raised, but an
    algorithm that fails in every fold raises with the first reason.
    """
    spark = next(iter(views.values()))[0].sparkSession
    grid = [(fold, a) for fold in views for a in algorithms]
    models: dict[tuple[int, str], fm.Fitted] = {}

    def run(task):
        fold, algorithm = task
        rows, features = views[fold]
        start = time.time()
        try:
            models[task] = train_one(rows, algorithm, roles, features, **options)
            status = "done"
        except Exception as err:  # noqa: BLE001 - one bad run must not stop the grid
            status = f"failed: {type(err).__name__}: {str(err)[:200]}"
        return (fold, algorithm, time.time() - start, status)

    with ThreadPoolExecutor(parallel) as pool:
        log = list(pool.map(inheritable_thread_target(run), grid))
    for algorithm in algorithms:
        if not any((fold, algorithm) in models for fold in views):
            reason = next(row[3] for row in log if row[1] == algorithm)
            raise RuntimeError(f"{algorithm} has no model in any fold; {reason}")
    return models, spark.createDataFrame(log, "fold int, algorithm string, seconds double, status string")
