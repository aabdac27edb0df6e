"""Rows that arrive as a stream, prepared and scored with stored state.

Preparation and row-wise models are narrow expressions over static state tables, so
the batch functions accept a streaming frame as it is; nothing is kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.functions.columns import q
from sparkassay.operators import prep
from sparkassay.operators.models.fitted import ROW_WISE, Fitted


def score_stream(
    stream: DataFrame, model: Fitted, features: list[str], cv: int, fill: DataFrame | None, scaler: DataFrame | None
) -> DataFrame:
    """Instance label and probability per arriving row."""
    if model.algorithm not in ROW_WISE:
        raise ValueError(f"{model.algorithm} needs all rows at once")
    rows = prep.apply_prep(stream.withColumn("cv", F.lit(cv)), fill, scaler, features)
    return model.predict(rows.drop("cv")).select(q(model.roles.inst_col), "p")
