"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_name(name: str) -> str:
    """A column name quoted for SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def clean_label(col) -> Column:
    """Drop the characters that are awkward in file or axis names."""
    return F.regexp_replace(col, "[ */]", "")


def sig_flag(p: Column, cutoff: float = 0.05) -> Column:
    return F.when(p < F.lit(cutoff), F.lit("*")).otherwise(F.lit(""))


def shuffle_key(seed: int, col: Column) -> Column:
    """Reproducible shuffle order: the same on every engine and every retry of a task."""
    return F.md5(F.concat(F.lit(f"{seed}|"), col.cast("string")))


SHUFFLE_DIGITS = 15


def shuffle_number(seed: int, col: Column) -> Column:
    """The leading digits of ``shuffle_key`` as a number: same order, a quarter of the bytes to shuffle and sort."""
    return F.conv(F.substring(shuffle_key(seed, col), 1, SHUFFLE_DIGITS), 16, 10).cast("long")


def digamma(x: Column) -> Column:
    """psi(x) for x > 0: six recurrence steps, then the asymptotic series."""
    z = x + 6.0
    series = (
        F.log(z)
        - 0.5 / z
        - F.lit(1.0 / 12.0) / (z * z)
        + F.lit(1.0 / 120.0) / F.pow(z, F.lit(4.0))
        - F.lit(1.0 / 252.0) / F.pow(z, F.lit(6.0))
        + F.lit(1.0 / 240.0) / F.pow(z, F.lit(8.0))
    )
    for step in range(6):
        series = series - 1.0 / (x + float(step))
    return series


def ratio(num: Column, den: Column, otherwise: float = 0.0) -> Column:
    return F.when(den == 0, F.lit(otherwise)).otherwise(num / den)
