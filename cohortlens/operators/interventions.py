"""Intervention targeting (IV1, IV2): which message each user gets, when, and on which channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.hashing import md5_bucket
from cohortlens.functions.timeutil import day_index, plus_days
from cohortlens.operators.activity import DAYS_A_MASK, actions, with_user_columns


def first_week_activity(users: DataFrame, events: DataFrame, cutoff_day: int = config.PREDICTION_CUTOFF_DAY,
                        source: str = "user_action", hot_users: DataFrame | None = None) -> DataFrame:
    """IV2: per user, distinct whole-day indices floor((ts - signup) / 24 h) in 0..cutoff_day of
    actions, and whether onboarding was ever completed (any time)."""
    u = users.select("user_id", "signup_timestamp")
    ev = actions(events, source).select("user_id", "event_name", "event_timestamp")
    j = with_user_columns(ev, u, ["signup_timestamp"], hot=hot_users).withColumn(
        "_day", day_index("signup_timestamp", "event_timestamp"))
    day, in_week = F.col("_day").cast("int"), F.col("_day").between(0, cutoff_day)
    if cutoff_day < DAYS_A_MASK:  # days as bits of one mask, or-ed where the rows lie
        days = F.bit_count(F.bit_or(F.when(in_week, F.call_function("shiftleft", F.lit(1).cast("long"), day))))
    else:
        days = F.count_distinct(F.when(in_week, day))
    agg = j.groupBy("user_id").agg(
        days.alias("active_days_first_week"),
        F.max(F.col("event_name") == "onboarding_complete").alias("onboarding_done"))
    out = u.join(agg, "user_id", "left")
    return out.select("user_id", F.coalesce("active_days_first_week", F.lit(0)).cast("bigint").alias("active_days_first_week"),
                      F.coalesce("onboarding_done", F.lit(False)).alias("onboarding_done"))


def _channel(consent, user_id, action: str, options: list[str], seed: int):
    """No consent -> in_app; otherwise a deterministic md5 pick among the eligible channels."""
    idx = md5_bucket(user_id, F.lit(action), F.lit(str(seed)), modulus=len(options))
    pick = F.element_at(F.array(*[F.lit(o) for o in options]), (idx + 1).cast("int"))
    return F.when(consent, pick).otherwise(F.lit("in_app"))


def plan_interventions(users: DataFrame, events: DataFrame, labels: DataFrame,
                       seed: int = config.RANDOM_SEED, hot_users: DataFrame | None = None) -> DataFrame:
    """IV1: first matching rule per user - (1) never onboarded -> complete_onboarding at +3d;
    (2) <= 1 active day in the first week -> re-engagement at +7d; (3) churned label -> win-back
    at +22d; otherwise no row. Open / click / conversion outcomes are not simulated (null)."""
    act = first_week_activity(users, events, hot_users=hot_users)
    lab = labels.select("user_id", F.col(config.TARGET_COLUMN).alias("_churned"))
    j = (users.select("user_id", "signup_timestamp", F.coalesce("marketing_consent", F.lit(False)).alias("_consent"))
         .join(act, "user_id", "left").join(lab, "user_id", "left"))
    rules = [
        (~F.col("onboarding_done"), config.IV_ONBOARDING),
        (F.col("active_days_first_week") <= 1, config.IV_REENGAGE),
        (F.coalesce(F.col("_churned"), F.lit(0)) == 1, config.IV_WIN_BACK),
    ]
    chosen = None
    for cond, (action, days, options) in rules:
        item = F.struct(F.lit(action).alias("action_name"),
                        plus_days("signup_timestamp", days).alias("send_time"),
                        _channel(F.col("_consent"), F.col("user_id"), action, options, seed).alias("channel"))
        chosen = F.when(cond, item) if chosen is None else chosen.when(cond, item)
    planned = j.select("user_id", chosen.alias("_p")).where(F.col("_p").isNotNull())
    msg = F.md5(F.concat_ws("-", F.lit("intervention"), F.lit(str(seed)), F.col("user_id").cast("string"),
                            F.col("_p.action_name")))
    null_ts = F.lit(None).cast("timestamp_ntz")
    return planned.select(
        msg.alias("message_id"), "user_id", F.col("_p.action_name").alias("action_name"),
        F.col("_p.channel").alias("channel"), F.col("_p.send_time").alias("send_time"),
        null_ts.alias("open_time"), null_ts.alias("click_time"), null_ts.alias("conversion_time"),
        F.lit(None).cast("string").alias("experiment_id"))
