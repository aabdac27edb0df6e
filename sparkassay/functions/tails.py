"""Tail probabilities. They run on summary rows (one per test), never on data rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail for whole degrees of freedom, by the recurrence of the incomplete gamma function."""
    if dof <= 0 or x <= 0:
        return 1.0
    h = x / 2.0
    a = 0.0 if dof % 2 == 0 else 0.5
    total = 0.0 if dof % 2 == 0 else math.erfc(math.sqrt(h))
    while a < dof / 2.0:
        total += math.exp(a * math.log(h) - h - math.lgamma(a + 1.0))
        a += 1.0
    return min(1.0, total)


def signed_rank_exact(t: float, n: int) -> float:
    """Two-sided exact p of the signed-rank statistic min(T+, T-) for n untied differences."""
    ways = [1] + [0] * (n * (n + 1) // 2)
    for r in range(1, n + 1):
        for s in range(len(ways) - 1, r - 1, -1):
            ways[s] += ways[s - r]
    return min(1.0, 2.0 * sum(ways[: int(math.floor(t)) + 1]) / 2.0**n)


@F.pandas_udf(T.DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else min(1.0, math.erfc(v / math.sqrt(2.0)))).astype("float64")


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    values = [None if pd.isna(a) or pd.isna(d) else chi2_sf(float(a), int(d)) for a, d in zip(x, dof)]
    return pd.Series(values, dtype="float64")


@F.pandas_udf(T.DoubleType())
def signed_rank_p(t: pd.Series, n: pd.Series, zeros: pd.Series, ties: pd.Series) -> pd.Series:
    """Exact for n <= 25 without zero differences, otherwise normal with tie correction."""
    out = []
    for stat, count, zero, tie in zip(t, n, zeros, ties):
        if pd.isna(stat) or pd.isna(count) or count == 0:
            out.append(1.0)
        elif count <= 25 and zero == 0:
            out.append(signed_rank_exact(float(stat), int(count)))
        else:
            mean = count * (count + 1) / 4.0
            var = count * (count + 1) * (2 * count + 1) / 24.0 - tie / 48.0
            z = 0.0 if var <= 0 else abs(stat - mean) / math.sqrt(var)
            out.append(min(1.0, 2.0 * normal_sf(z)))
    return pd.Series(out, dtype="float64")
