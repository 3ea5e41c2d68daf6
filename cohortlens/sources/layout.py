"""The event log laid out by user (IO3): per-user work without an exchange of events.

Events are written once as a table bucketed by user_id and sorted by time in each bucket, users as another
with the same buckets. Every per-user aggregate of such a log (funnel, activity, labels) then runs where
its rows lie, and its join with the users is bucket by bucket. A bucket is read by one task, so the users
who hold a large share of the log (:func:`activity.hot_users`) go to a second, plain table: their
aggregates are shuffled with partial sums as before. The two tables share no user.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import activity
from cohortlens.session import ensure_checkpoint_dir


@dataclass
class UserLayout:
    """Events and users by bucket, and the events and rows of the hot users."""

    events: DataFrame
    users: DataFrame
    hot_events: DataFrame
    hot_users: DataFrame

    def per_user(self, work: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``work(users, events)``, which must give rows of single users, over both parts."""
        return work(self.users, self.events).unionByName(work(self.hot_users, self.hot_events))


def write_layout(users: DataFrame, events: DataFrame, name: str, buckets: int, path: str | None = None,
                 hot_threshold: int = activity.HOT_USER_EVENTS) -> None:
    """Write both tables by user in ``buckets`` buckets as ``<name>_events`` and ``<name>_users``, and
    those of the users with ``hot_threshold`` events or more as ``<name>_hot_events`` and
    ``<name>_hot_users``; under ``path`` where given, else in the warehouse. Rows without a user have no
    per-user result and stay out."""
    hot = activity.hot_users(events, hot_threshold).select("user_id")

    def save(df: DataFrame, table: str, bucketed: str | None) -> None:
        writer = df.write.mode("overwrite").format("parquet")
        if bucketed:
            writer = df.repartition(buckets, "user_id").write.mode("overwrite").format("parquet").bucketBy(buckets, "user_id").sortBy("user_id", *([bucketed] if bucketed != "user_id" else []))
        if path:
            writer = writer.option("path", f"{path}/{table}")
        writer.saveAsTable(table)

    for df, kind, order in ((events, "events", "event_timestamp"), (users, "users", "user_id")):
        known = df.where(F.col("user_id").isNotNull())
        save(known.join(hot, "user_id", "left_anti").select(*df.columns), f"{name}_{kind}", order)
        save(known.join(hot, "user_id", "left_semi").select(*df.columns), f"{name}_hot_{kind}", None)


def read_layout(spark: SparkSession, name: str) -> UserLayout:
    return UserLayout(*(spark.table(f"{name}_{kind}") for kind in ("events", "users", "hot_events", "hot_users")))


def staged_layout(users: DataFrame, events: DataFrame, buckets: int | None = None, hot_threshold: int = activity.HOT_USER_EVENTS) -> UserLayout:
    """A layout of this session under the shared checkpoint folder, with a bucket a shuffle partition."""
    spark = users.sparkSession
    name = f"layout_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_layout(users, events, name, buckets, f"{ensure_checkpoint_dir(spark)}/{name}", hot_threshold)
    return read_layout(spark, name)
