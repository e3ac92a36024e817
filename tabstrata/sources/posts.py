"""The ``posts`` view: the reference's table shape, derived from the driver's ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# The posts columns the missing-value injection may blank
# (every column but the id and the target).
POST_FEATURES = ["post_hour", "post_day", "category", "k", "user_id"]


def posts(events: DataFrame) -> DataFrame:
    """post_id, post_hour (B2), post_day (B3), category, k, user_id, target."""
    return events.select(
        F.col("event_id").alias("post_id"),
        S.fractional_hour("ts").alias("post_hour"),
        S.day_of_week("ts").alias("post_day"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("user_id"),
        F.col("value").alias("target"),
    )


def posts_with_missing(events: DataFrame, pct: float = 0.05, seed: int = 42) -> DataFrame:
    """``posts`` with A6 nulls in every feature column (never in the id or target)."""
    return S.inject_missing(posts(events), POST_FEATURES, pct, seed, "post_id")
