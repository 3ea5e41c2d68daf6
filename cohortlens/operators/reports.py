"""Summary reports (RP1-RP3, RP6, RP7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.scalars import scalar_row
from cohortlens.functions.stats import safe_div


def dataset_summary(users: DataFrame, events: DataFrame, labels: DataFrame) -> DataFrame:
    """RP1 / RP7: users, events, events per user, churn rate - three scalar aggregates, one row."""
    u = users.agg(F.count(F.lit(1)).alias("users"))
    e = events.agg(F.count(F.lit(1)).alias("events"))
    c = labels.agg(F.avg(F.col("is_churned").cast("double")).alias("churn_rate"),
                   F.count(F.lit(1)).alias("labelled_users"))
    summary = scalar_row(u, e, c)
    return summary.select("users", "events", safe_div("events", "users").alias("events_per_user"),
                          "labelled_users", "churn_rate")


def channel_overview(users: DataFrame, column: str = "acquisition_channel") -> DataFrame:
    """RP2: users per value and share of the total."""
    counts = users.groupBy(column).agg(F.count(F.lit(1)).alias("users"))
    total = users.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()  # scalar subquery, no window
    return counts.withColumn("share", F.col("users") / total).orderBy(column)


def churn_by_group(users: DataFrame, labels: DataFrame, column: str = "acquisition_channel") -> DataFrame:
    """RP3: churn rate per group of labelled users, highest first."""
    j = users.select("user_id", column).join(labels.select("user_id", config.TARGET_COLUMN), "user_id")
    return (j.groupBy(column).agg(F.avg(F.col(config.TARGET_COLUMN).cast("double")).alias("churn_rate"))
            .orderBy(F.desc("churn_rate"), column))


def sample_users(users: DataFrame, n: int = 10, seed: int = config.RANDOM_SEED) -> DataFrame:
    """RP6: deterministic pseudo-random sample: the n smallest md5(user_id:seed) keys (top-k)."""
    key = F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.lit(str(seed))))
    return users.withColumn("_k", key).orderBy("_k", "user_id").limit(n).drop("_k")
