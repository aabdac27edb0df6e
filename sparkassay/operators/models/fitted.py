"""One interface over all classifiers: fit, score rows, importances, save and load."""

from __future__ import annotations

import json
import math
import random
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkassay.functions.columns import q
from sparkassay.operators.models import naive_bayes, nearest
from sparkassay.roles import Roles
from sparkassay.session import cut_lineage

PART_BYTES = 32 << 20  # training rows one task holds in memory, about
ROW_BYTES = 200  # of a row beside its numbers
ROW_WISE = ("NB", "LR", "DT", "RF", "GB", "SVM", "ANN")


@dataclass
class Fitted:
    algorithm: str
    features: list[str]
    params: dict
    roles: Roles
    model: object = None  # spark.ml pipeline
    table: DataFrame | None = None  # naive Bayes state, or the training rows of k neighbours
    scaler: object = None  # margin to probability (support vector machine)
    projection: list = field(default_factory=list)  # random features: weights and phase

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        """``df`` with the probability of class 1 in ``out``."""
        keep = [q(c) for c in df.columns]
        if self.algorithm == "NB":
            scored = naive_bayes.predict(self.table, df.withColumn("cv", F.lit(0)), self.features)
            return scored.select(*keep, F.col("p").alias(out))
        if self.algorithm == "KN":
            return nearest.predict(
                self.table, df, self.features, **self.params, inst=self.roles.inst_col,
                class_col=self.roles.class_col, out=out,
            )
        scored = self.model.transform(_project(df, self.features, self.projection))
        if self.algorithm == "SVM":
            scored = _margin(scored).drop("__probability", "__raw", "__prediction")
            scored = self.scaler.transform(scored)
        return scored.select(*keep, vector_to_array("__probability")[1].alias(out))

    def native_importance(self) -> dict[str, float] | None:
        """exp(coefficient) or impurity decrease; None where a model has neither."""
        last = self.model.stages[-1] if self.model is not None else None
        if self.algorithm == "LR":
            return {f: math.exp(c) for f, c in zip(self.features, last.coefficients.toArray())}
        if self.algorithm in ("DT", "RF", "GB"):
            return dict(zip(self.features, (float(v) for v in last.featureImportances.toArray())))
        return None

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {
            "algorithm": self.algorithm, "features": self.features, "params": self.params,
            "roles": vars(self.roles), "projection": self.projection,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")
        if self.table is not None:
            self.table.write.mode("overwrite").parquet(f"{path}/table")
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")
        if self.scaler is not None:
            self.scaler.write().overwrite().save(f"{path}/scaler")


def load(spark: SparkSession, path: str) -> Fitted:
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    out = Fitted(meta["algorithm"], meta["features"], meta["params"], Roles(**meta["roles"]), projection=meta["projection"])
    if out.algorithm in ("NB", "KN"):
        out.table = spark.read.parquet(f"{path}/table")
    else:
        out.model = PipelineModel.load(f"{path}/model")
    if out.algorithm == "SVM":
        out.scaler = LogisticRegressionModel.load(f"{path}/scaler")
    return out


# --- helpers -------------------------------------------------------------------------------


def class_weights(train: DataFrame, class_col: str = "class") -> DataFrame:
    """Rows, balanced weight n / (2 n_c) and positive weight (negatives per positive) of each class."""
    counts = train.groupBy(q(class_col).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    both = Window.partitionBy(F.lit(0))  # one row per class
    balanced = F.sum("n").over(both) / (F.count(F.lit(1)).over(both) * F.col("n"))
    negatives = F.sum(F.when(F.col("class") == 0, F.col("n"))).over(both)
    positive = F.when(F.col("class") == 1, negatives / F.col("n")).otherwise(F.lit(1.0))
    return counts.select("class", "n", balanced.alias("balanced"), positive.alias("positive"))


def _weight(train: DataFrame, kind: str | None, class_col: str) -> Column:
    """``balanced`` weights, or ``positive``: negatives per positive on class 1."""
    if not kind:
        return F.lit(1.0)
    rows = {r["class"]: r[kind] for r in class_weights(train, class_col).collect()}
    return F.when(q(class_col) == 1, F.lit(float(rows.get(1, 1.0)))).otherwise(F.lit(float(rows.get(0, 1.0))))


def _spread(rows: DataFrame, n: int, width: int) -> DataFrame:
    """Many training rows dealt evenly into parts of ``PART_BYTES``, since an iterative fit keeps its parts in memory
    and stored files may hold them in a few; few rows stay as they are."""
    parts = -(-n * (8 * width + ROW_BYTES) // PART_BYTES)
    if parts <= 4:
        return rows
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism))


def _project(df: DataFrame, features: list[str], projection: list) -> DataFrame:
    """Random Fourier features (Rahimi and Recht 2007) of each Arrow batch, as vector ``__x``."""
    if not projection:
        return df
    size = math.sqrt(2.0 / len(projection))
    weights, phases = [w for w, _ in projection], [p for _, p in projection]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(x: pd.Series) -> pd.Series:
        import numpy as np

        inner = np.vstack(x.to_numpy()) @ np.asarray(weights).T + np.asarray(phases)
        return pd.Series(list(size * np.cos(inner)))

    return df.withColumn("__x", array_to_vector(project(F.array(*[q(f).cast("double") for f in features]))))


def _margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("__m", array_to_vector(F.array(vector_to_array("__margin")[1])))


def _columns(label: str, proba: bool = True) -> dict:
    out = {"featuresCol": "__x", "labelCol": label, "predictionCol": "__prediction", "rawPredictionCol": "__raw"}
    if proba:
        out["probabilityCol"] = "__probability"
    return out


def _estimator(algorithm: str, params: dict, roles: Roles, n: int, d: int, seed: int):
    get = params.get
    own = _columns(roles.class_col)
    if algorithm == "LR":
        return LogisticRegression(
            **own, weightCol="__w", regParam=1.0 / (get("C", 1.0) * n), elasticNetParam=1.0 if get("penalty") == "l1" else 0.0,
            maxIter=get("max_iter", 100), standardization=False,
        )
    tree = {"maxDepth": get("max_depth", 5), "minInstancesPerNode": get("min_leaf", 1), "seed": seed, "weightCol": "__w"}
    if algorithm == "DT":
        return DecisionTreeClassifier(**own, **tree, impurity=get("impurity", "gini"))
    if algorithm == "RF":
        return RandomForestClassifier(
            **own, **tree, impurity=get("impurity", "gini"), numTrees=get("n_trees", 100),
            featureSubsetStrategy=get("feature_subset", "sqrt"), bootstrap=True,
        )
    if algorithm == "GB":
        tree["maxDepth"] = get("max_depth", 3)
        share = get("column_fraction", 1.0)
        return GBTClassifier(
            featuresCol="__x", labelCol=roles.class_col, predictionCol="__prediction", **tree, maxIter=get("rounds", 100),
            stepSize=get("rate", 0.1), subsamplingRate=get("row_fraction", 1.0), minInfoGain=get("min_gain", 0.0),
            featureSubsetStrategy="all" if share >= 1.0 else str(share), minWeightFractionPerNode=get("min_child", 0.0),
        ).setProbabilityCol("__probability").setRawPredictionCol("__raw")
    if algorithm == "ANN":
        hidden = [get("layer_size", 50)] * get("n_layers", 1)
        return MultilayerPerceptronClassifier(
            **own, layers=[d, *hidden, 2], maxIter=get("max_iter", 200), solver=get("solver", "l-bfgs"), seed=seed,
        )
    raise ValueError(f"unknown algorithm: {algorithm}")


def fit(algorithm: str, train: DataFrame, roles: Roles, features: list[str], params: dict | None = None, seed: int = 42) -> Fitted:
    """Fit one classifier on prepared training rows (no missing cells)."""
    params = dict(params or {})
    if algorithm == "NB":
        state = naive_bayes.fit(train.withColumn("cv", F.lit(0)), features, roles.class_col)
        return Fitted(algorithm, features, params, roles, table=cut_lineage(state, "nb"))
    if algorithm == "KN":
        rows = train.select(q(roles.inst_col), q(roles.class_col), *[q(f) for f in features])
        return Fitted(algorithm, features, params, roles, table=rows)
    rows = train.select(q(roles.class_col), *[q(f) for f in features])
    rows = rows.withColumn("__w", _weight(train, params.get("class_weight"), roles.class_col))
    if algorithm == "SVM":
        return _fit_svm(rows, roles, features, params, seed)
    assembler = VectorAssembler(inputCols=features, outputCol="__x")
    n = rows.count()
    estimator = _estimator(algorithm, params, roles, n, len(features), seed)
    model = Pipeline(stages=[assembler, estimator]).fit(_spread(rows, n, len(features)))
    return Fitted(algorithm, features, params, roles, model=model)


def _fit_svm(rows: DataFrame, roles: Roles, features: list[str], params: dict, seed: int) -> Fitted:
    """Linear machine on the features, their polynomial expansion, or random features of the rbf kernel.

    Probabilities come from a logistic fit on the margin.
    """
    kernel = params.get("kernel", "rbf")
    degree = params.get("degree", 3)
    projection: list = []
    stages: list = []
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(q(f)).alias(f"m{i}") for i, f in enumerate(features)],
                    *[F.avg(q(f) * q(f)).alias(f"s{i}") for i, f in enumerate(features)]).first()
    if kernel == "rbf":
        d = len(features)
        mean = sum(sums[f"m{i}"] for i in range(d)) / d
        var = sum(sums[f"s{i}"] for i in range(d)) / d - mean * mean
        gamma = 1.0 / (d * var) if var > 0 else 1.0
        rng = random.Random(seed)
        projection = [
            ([rng.gauss(0.0, math.sqrt(2.0 * gamma)) for _ in features], rng.uniform(0.0, 2.0 * math.pi))
            for _ in range(params.get("n_random", 64))
        ]
    else:
        stages.append(VectorAssembler(inputCols=features, outputCol="__a" if kernel == "poly" else "__x"))
    if kernel == "poly":
        stages.append(PolynomialExpansion(degree=degree, inputCol="__a", outputCol="__x"))
    stages.append(LinearSVC(
        featuresCol="__x", labelCol=roles.class_col, predictionCol="__prediction", rawPredictionCol="__margin",
        weightCol="__w", regParam=1.0 / (params.get("C", 1.0) * sums["n"]), maxIter=params.get("max_iter", 100),
    ))
    width = {"rbf": len(projection), "poly": math.comb(len(features) + degree, degree) - 1}.get(kernel, len(features))
    rows = _spread(rows, sums["n"], width)
    model = Pipeline(stages=stages).fit(_project(rows, features, projection))
    margins = _margin(model.transform(_project(rows, features, projection)).drop("__prediction"))
    platt = LogisticRegression(
        featuresCol="__m", labelCol=roles.class_col, predictionCol="__prediction", rawPredictionCol="__raw",
        probabilityCol="__probability", weightCol="__w",
    ).fit(margins.select("__m", q(roles.class_col), "__w"))
    return Fitted("SVM", features, params, roles, model=model, scaler=platt, projection=projection)


def predictions(fitted: Fitted, df: DataFrame, dataset: str, fold: int) -> DataFrame:
    """Scored rows in the common layout."""
    return many_predictions([fitted], df, dataset, fold)


def many_predictions(models: list[Fitted], df: DataFrame, dataset: str, fold: int) -> DataFrame:
    """All row-wise models of one fold in a single pass over the rows; k neighbours join in."""
    roles = models[0].roles
    base = df.withColumnRenamed("p", "__input_p") if "p" in df.columns else df
    scored = base
    for m in models:
        scored = m.predict(scored, f"__p_{m.algorithm}")
    each = F.array(*[
        F.struct(F.lit(m.algorithm).alias("algorithm"), F.col(f"__p_{m.algorithm}").cast("double").alias("p")) for m in models
    ])
    long = scored.select(q(roles.inst_col).alias("inst_id"), q(roles.class_col).cast("int").alias("y"), F.inline(each))
    return long.select(
        F.lit(dataset).alias("dataset"), "algorithm", F.lit(fold).alias("fold"), "inst_id", "y", "p"
    )
