"""Permutation importance on training data."""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.functions.columns import q
from sparkassay.functions.kernels import hash_rank
from sparkassay.operators.evaluate import score
from sparkassay.operators.models.fitted import Fitted


def partners(n: int, repeats: int, seed: int) -> list[tuple[int, int]]:
    """Multiplier and shift per repeat: rank -> (rank * a + b) mod n is a permutation of the ranks."""
    rng = random.Random(seed)
    out = []
    while len(out) < repeats:
        a = rng.randrange(1, min(max(n, 2), 1 << 20))
        if math.gcd(a, n) == 1:
            out.append((a, rng.randrange(max(n, 1))))
    return out


def permuted_rows(df: DataFrame, features: list[str], inst: str, class_col: str, repeats: int, seed: int) -> DataFrame:
    """Every row once per (feature, repeat) with that feature taken from another row.

    Rows are ranked in hashed order once. A repeat is a fixed bijection of the ranks, so
    a partner is found by one equi-join on the rank for all features together.
    """
    slim = df.select(q(inst), q(class_col), *[q(f) for f in features])
    ranked = hash_rank(slim, seed, inst, out="__rank")
    n = slim.count()
    moves = F.array(*[
        F.struct(F.lit(t).alias("repeat"), F.pmod((F.col("__rank") - 1) * F.lit(a) + F.lit(b), F.lit(n)).alias("__from"))
        for t, (a, b) in enumerate(partners(n, repeats, seed))
    ])
    own = ranked.select(q(inst), q(class_col), *[q(f) for f in features], F.inline(moves))
    other = ranked.select((F.col("__rank") - 1).alias("__from"), *[q(f).alias(f"__o{i}") for i, f in enumerate(features)])
    pairs = own.join(other, "__from")
    which = F.explode(F.array(*[F.lit(f) for f in features])).alias("feature")
    rows = pairs.select("*", which)
    return rows.select(
        q(inst), q(class_col), "feature", "repeat",
        *[F.when(F.col("feature") == f, F.col(f"__o{i}")).otherwise(q(f)).alias(f) for i, f in enumerate(features)],
    )


def permutation_importance(
    fitted: Fitted, train: DataFrame, metric: str = "balanced_accuracy", n_repeats: int = 10, seed: int = 42
) -> DataFrame:
    """Mean loss of the metric when a feature is shuffled: ``(feature, score)``."""
    roles, features = fitted.roles, fitted.features
    label = q(roles.class_col).cast("int").alias("y")
    plain = fitted.predict(train.select(q(roles.inst_col), q(roles.class_col), *[q(f) for f in features]))
    base = score(plain.select(F.lit("all").alias("run"), label, "p"), metric, keys=["run"])
    rows = permuted_rows(train, features, roles.inst_col, roles.class_col, n_repeats, seed)
    if fitted.algorithm == "KN":  # neighbours are looked up by label, which must be unique
        rows = rows.withColumn(roles.inst_col, F.concat_ws("|", q(roles.inst_col), "feature", "repeat"))
    scored = fitted.predict(rows).select("feature", "repeat", label, "p")
    lost = score(scored, metric, keys=["feature", "repeat"], groups=len(features) * n_repeats)
    return lost.groupBy("feature").agg((base.select("score").scalar() - F.avg("score")).alias("score"))
