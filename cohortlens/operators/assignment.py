"""Experiment assignment (AS1-AS3): md5 bucketing, assignment rows, conversion marking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.hashing import md5_bucket, pick_variant
from cohortlens.operators.activity import actions


def assign_variant(user_id: Column, experiment_id: str = config.ONBOARDING_EXPERIMENT_ID,
                   variants: list[tuple[str, float]] | None = None, salt: str = "") -> Column:
    """AS1: md5 of ``user:experiment:salt`` mod 1e6 / 1e6 against cumulative allocations."""
    variants = variants or config.ONBOARDING_VARIANTS
    return pick_variant(md5_bucket(user_id, F.lit(experiment_id), F.lit(salt)), variants)


def variant_bucket(user_id: Column, experiment_id: str = config.ONBOARDING_EXPERIMENT_ID, salt: str = "") -> Column:
    return md5_bucket(user_id, F.lit(experiment_id), F.lit(salt))


def create_experiment_assignments(users: DataFrame, experiment_id: str = config.ONBOARDING_EXPERIMENT_ID,
                                  experiment_name: str = config.ONBOARDING_EXPERIMENT_NAME,
                                  experiment_type: str = config.ONBOARDING_EXPERIMENT_TYPE,
                                  variants: list[tuple[str, float]] | None = None, salt: str = "") -> DataFrame:
    """AS2: one assignment row per user, a pure projection (no shuffle)."""
    variants = variants or config.ONBOARDING_VARIANTS
    variant = assign_variant(F.col("user_id"), experiment_id, variants, salt)
    alloc = None
    for name, share in variants:
        alloc = F.when(F.col("variant_id") == name, F.lit(float(share))) if alloc is None else \
            alloc.when(F.col("variant_id") == name, F.lit(float(share)))
    with_variant = users.select("user_id", "signup_timestamp", variant.alias("variant_id"))
    return with_variant.select(
        F.lit(experiment_id).alias("experiment_id"),
        F.col("user_id"),
        F.col("variant_id"),
        F.col("signup_timestamp").alias("assignment_time"),
        F.lit(experiment_name).alias("experiment_name"),
        F.lit(experiment_type).alias("experiment_type"),
        alloc.alias("traffic_allocation"),
        F.lit(True).alias("is_exposed"),
        F.lit(False).alias("is_converted"),
    )


def mark_converted(assignments: DataFrame, events: DataFrame, event_name: str = "onboarding_complete",
                   source: str = "user_action") -> DataFrame:
    """AS3: is_converted = the user ever performed ``event_name`` as an action (any time)."""
    converters = (actions(events, source).where(F.col("event_name") == event_name)
                  .select("user_id").distinct().withColumn("_conv", F.lit(True)))
    cols = [c for c in assignments.columns]
    out = assignments.join(converters, "user_id", "left")
    return out.select(*[F.col("_conv").isNotNull().alias(c) if c == "is_converted" else F.col(c) for c in cols])
