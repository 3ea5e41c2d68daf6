"""Shared user-level building blocks.

Every analytic here first collapses the event log to one row per user (or per user-day) with
conditional aggregates - partial aggregation runs map-side, so a user holding a large share of
the log is pre-reduced in every task before the shuffle - and only then joins the users table,
whose rows are one per user and therefore skew-free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USER_ACTION = "user_action"


def actions(events: DataFrame, source: str = USER_ACTION) -> DataFrame:
    return events.where(F.col("event_source") == source)


DAYS_A_MASK = 64


def activity_bitmap(events: DataFrame, source: str = USER_ACTION, names: dict[str, str] | None = None) -> DataFrame:
    """RT2 packed: user_id, _days (map from 64-day stretches since 1970 to a mask of the active days),
    _last (the last action) and a flag for each of ``names`` (flag: event name) that the user ever did. All
    are combined where the rows lie; per user only its stretches are gathered."""
    at, names = F.col("event_timestamp"), names or {}
    day = F.unix_date(F.to_date(at))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(DAYS_A_MASK)))
    part = (actions(events, source).groupBy("user_id", F.floor(day / DAYS_A_MASK).cast("long").alias("_part"))
            .agg(F.bit_or(bit).alias("_mask"), F.max(at).alias("_last"), *[F.max(F.col("event_name") == e).alias(flag) for flag, e in names.items()]))
    days = F.collect_list(F.when(F.col("_part").isNotNull(), F.struct("_part", "_mask")))
    return part.groupBy("user_id").agg(F.map_from_entries(days).alias("_days"), F.max("_last").alias("_last"), *[F.max(flag).alias(flag) for flag in names])


def with_activity(users: DataFrame, events: DataFrame, source: str = USER_ACTION, names: dict[str, str] | None = None) -> DataFrame:
    """``users`` with their activity bitmap and flags (null for users without actions)."""
    return users.join(activity_bitmap(events, source, names), "user_id", "left")


def active_on(day: int, since: str = "signup_timestamp") -> Column:
    """Whether a row of :func:`with_activity` is active on calendar day ``since`` + day."""
    target = F.unix_date(F.to_date(since)) + F.lit(int(day))
    mask = F.try_element_at("_days", F.floor(target / DAYS_A_MASK).cast("long"))
    return F.coalesce(F.getbit(mask, F.pmod(target, F.lit(DAYS_A_MASK))) == 1, F.lit(False))


def first_occurrence(events: DataFrame, names: list[str], source: str = USER_ACTION,
                     prefix: str = "_first_") -> DataFrame:
    """FN1: first timestamp per user of each named action, wide (explicit list, no pivot scan)."""
    ev = actions(events, source).where(F.col("event_name").isin(names))
    return ev.groupBy("user_id").agg(*[
        F.min(F.when(F.col("event_name") == n, F.col("event_timestamp"))).alias(f"{prefix}{i}")
        for i, n in enumerate(names)
    ])


HOT_USER_EVENTS = 1_000_000  # a user with this many events is spread over salt buckets of about as many


def hot_users(events: DataFrame, threshold: int = HOT_USER_EVENTS) -> DataFrame:
    """Users with at least ``threshold`` events and the number of salt buckets that leave about
    ``threshold`` events in each: a partial-aggregated count per user, filtered. At most
    ``events / threshold`` rows, with at most ``2 * events / threshold`` buckets in all.
    """
    return (events.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= threshold).select("user_id", F.ceil(F.col("_n") / threshold).cast("int").alias("_salts")))


def with_user_columns(events: DataFrame, users: DataFrame, columns: list[str],
                      hot_threshold: int | None = HOT_USER_EVENTS, hot: DataFrame | None = None) -> DataFrame:
    """Attach per-user columns (e.g. signup) to each event: inner equi-join on user_id.

    Skew: a user holding a large share of the log would put all of its events into one join task.
    A user with >= ``hot_threshold`` events gets them spread over salt buckets (hash of the event)
    whose number grows with them, and its single users row replicated to each bucket, so the join
    key (user_id, salt) is balanced; every other user keeps salt 0. Exact: each event still meets
    its one users row. Aggregations after the join are partial per salt bucket before their own
    shuffle. ``hot_threshold=None`` disables salting (AQE skew-join splitting still applies).
    ``hot`` (a precomputed :func:`hot_users` list, e.g. shared by every operator of one load)
    skips the counting pass; any list keeps the join exact since both sides use the same one.
    The list is joined as its measured size says (broadcast while it is small).
    """
    u = users.select("user_id", *columns)
    if hot_threshold is None:
        return events.join(u, "user_id", "inner")
    hot = hot if hot is not None else hot_users(events, hot_threshold)
    # row content plus its position in the input split: identical duplicate events spread too,
    # and a recomputed split reproduces the same salts
    row_key = F.xxhash64(*[F.col(c) for c in events.columns], F.monotonically_increasing_id())
    salts = F.coalesce("_salts", F.lit(1))
    ev = (events.withColumn("_key", row_key).join(hot, "user_id", "left")
          .withColumn("_salt", F.pmod("_key", salts).cast("int")).drop("_salts", "_key"))
    us = (u.join(hot, "user_id", "left")
          .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    return ev.join(us, ["user_id", "_salt"], "inner").drop("_salt")


def bool_int(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")
