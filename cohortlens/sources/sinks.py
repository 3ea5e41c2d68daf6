"""Table and report writers (IO3, IO4, IO5, IO7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.schemas import PRIVATE_USER_COLUMNS


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """IO3: write a lifecycle table; no index column is ever added."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_events(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Events are laid out by event date so cutoff / label-window filters prune files. Rebalancing
    gives files of about the advisory size: a busy day is split, quiet days share a task."""
    (events.withColumn("event_date", F.to_date("event_timestamp"))
     .hint("rebalance", "event_date")
     .write.mode(mode).partitionBy("event_date").parquet(path))


def write_feature_matrix(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO4: model matrix partitioned by signup date, rebalanced as events are."""
    (features.withColumn("signup_date", F.to_date("signup_timestamp"))
     .hint("rebalance", "signup_date")
     .write.mode(mode).partitionBy("signup_date").parquet(path))


def write_report(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite", single_file: bool = True) -> None:
    """IO5: a result frame as JSON / CSV. ``single_file`` is for small frames (metrics, subgroups,
    examples), computed in parallel and gathered last; frames with a row per user set it False."""
    writer = (df.repartition(1) if single_file else df).write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def publishable_users(users: DataFrame) -> DataFrame:
    """IO7: drop simulator-only columns before the users table is published."""
    return users.drop(*[c for c in PRIVATE_USER_COLUMNS if c in users.columns])
