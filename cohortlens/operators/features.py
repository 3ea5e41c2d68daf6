"""Leakage-safe pre-cutoff feature matrix (FE1-FE20).

Plan: events join users(user_id, signup, cutoff) -> keep ts < cutoff -> one conditional
``groupBy(user_id)`` for every count / flag / first-last instant, one (user, session) aggregate
for the session-size statistics, then both are left-joined onto the users table (one row per
user, so no skew there). A hot user's events are pre-reduced by partial aggregation in every
task before the shuffle; AQE splits the hot partition of the events-users join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.timeutil import hours_between, minus_days, plus_days
from cohortlens.operators.activity import with_user_columns

SENT_EVENTS = {"num_email_sent": "email_sent", "num_push_sent": "push_sent", "num_in_app_sent": "in_app_message_sent"}
COUNTED_EVENTS = {"ai_assistant_interaction_count": "ai_assistant_interaction",
                  "job_detail_view_count": "job_detail_view", "return_visit_count": "return_visit"}
CORE_FLAG_EVENTS = [e for e in config.CORE_EVENTS if e != "signup"]


def static_features(users: DataFrame) -> DataFrame:
    """FE2-FE4: copied attributes, signup hour / weekday (Monday = 0), consent as 0/1.

    A missing language / timezone *column* becomes 'unknown'; a null consent maps to 0.
    """
    def col_or_unknown(c: str) -> Column:
        return F.col(c) if c in users.columns else F.lit("unknown")

    return users.select(
        "user_id", "signup_timestamp",
        *[F.col(c) for c in ["acquisition_channel", "country", "device_type", "user_intent_level", "career_stage"]],
        col_or_unknown("language").alias("language"), col_or_unknown("timezone").alias("timezone"),
        F.hour("signup_timestamp").alias("signup_hour"),
        F.weekday(F.to_date("signup_timestamp")).alias("signup_day_of_week"),
        F.coalesce(F.col("marketing_consent").cast("int"), F.lit(0)).alias("marketing_consent"),
    )


def variant_features(users: DataFrame, assignments: DataFrame | None,
                     experiment_id: str = config.ONBOARDING_EXPERIMENT_ID) -> DataFrame:
    """FE5: onboarding variant per user, 'unknown' when absent."""
    base = users.select("user_id")
    if assignments is None:
        return base.withColumn("onboarding_variant", F.lit("unknown"))
    sub = assignments.where(F.col("experiment_id") == experiment_id).select(
        "user_id", F.col("variant_id").alias("onboarding_variant"))
    return base.join(sub, "user_id", "left").select(
        "user_id", F.coalesce("onboarding_variant", F.lit("unknown")).alias("onboarding_variant"))


def pre_cutoff_events(users: DataFrame, events: DataFrame, cutoff_day: int = config.PREDICTION_CUTOFF_DAY,
                      hot_users: DataFrame | None = None) -> DataFrame:
    """FE1: every event strictly before signup + cutoff_day (no lower bound), with signup/cutoff."""
    u = users.select("user_id", "signup_timestamp", plus_days("signup_timestamp", cutoff_day).alias("_cutoff"))
    ev = events.select("user_id", "session_id", "event_name", "event_timestamp", "event_source")
    return (with_user_columns(ev, u, ["signup_timestamp", "_cutoff"], hot=hot_users)
            .where(F.col("event_timestamp") < F.col("_cutoff")))


def behavior_features(users: DataFrame, events: DataFrame, cutoff_day: int = config.PREDICTION_CUTOFF_DAY,
                      sent_source: str = "system", action_source: str = "user_action",
                      hot_users: DataFrame | None = None) -> DataFrame:
    """FE6-FE19 for users with at least one pre-cutoff event (others are filled by FE20)."""
    pre = pre_cutoff_events(users, events, cutoff_day, hot_users)
    name, ts, src = F.col("event_name"), F.col("event_timestamp"), F.col("event_source")
    act = src == action_source
    aggs = [F.max(F.when(act & (name == e), 1).otherwise(0)).alias(e) for e in CORE_FLAG_EVENTS]
    aggs += [
        F.count_if(name == "session_start").alias("num_sessions"),
        F.count_if(act).alias("num_user_actions"),
        F.count_distinct(F.when(act, F.to_date(ts))).alias("num_days_active"),
        *[F.count_if((src == sent_source) & (name == e)).alias(k) for k, e in SENT_EVENTS.items()],
        F.count_if(act & F.col("session_id").isNotNull()).alias("total_user_actions_in_sessions"),
        F.count_distinct(name).alias("unique_event_type_count"),
        F.count_if(ts < plus_days("signup_timestamp", 1)).alias("first_day_event_count"),
        F.count_if(ts >= minus_days("_cutoff", 2)).alias("last_2_days_event_count"),
        F.min(F.when(act, ts)).alias("_first_act"),
        F.max(F.when(act, ts)).alias("_last_act"),
        F.max("signup_timestamp").alias("_signup"),
        F.max("_cutoff").alias("_cutoff"),
        *[F.count_if(name == e).alias(k) for k, e in COUNTED_EVENTS.items()],
    ]
    per_user = pre.groupBy("user_id").agg(*aggs)
    sessions = (pre.where(F.col("session_id").isNotNull()).groupBy("user_id", "session_id")
                .agg(F.count(F.lit(1)).alias("_n"))
                .groupBy("user_id").agg(F.avg("_n").alias("_avg_s"), F.max("_n").alias("_max_s")))
    j = per_user.join(sessions, "user_id", "left")
    has_sessions = F.col("num_sessions") > 0
    return j.select(
        "user_id",
        F.col("onboarding_start").alias("onboarding_started"),
        *[F.col(e) for e in CORE_FLAG_EVENTS if e != "onboarding_start"],
        sum(F.col(e) for e in CORE_FLAG_EVENTS).alias("num_core_actions_completed"),
        "num_sessions", "num_user_actions", "num_days_active", *SENT_EVENTS.keys(),
        F.when(has_sessions, F.coalesce("_avg_s", F.lit(0.0))).otherwise(0.0).alias("avg_events_per_session"),
        F.when(has_sessions, F.coalesce("_max_s", F.lit(0))).otherwise(0).alias("max_events_in_session"),
        "total_user_actions_in_sessions", "unique_event_type_count", "first_day_event_count",
        "last_2_days_event_count",
        hours_between("_signup", "_first_act").alias("hours_to_first_action"),
        hours_between("_last_act", "_cutoff").alias("hours_since_last_action_at_cutoff"),
        *COUNTED_EVENTS.keys(),
    )


def build_model_features(users: DataFrame, events: DataFrame, assignments: DataFrame | None = None,
                         cutoff_day: int = config.PREDICTION_CUTOFF_DAY, sent_source: str = "system",
                         hot_users: DataFrame | None = None) -> DataFrame:
    """FE20: user_id, signup_timestamp, 8 categorical + 29 numeric features in fixed order.

    Numeric features are DOUBLE; nulls become 0 except the two ``hours_*`` columns, which stay
    null for users without a pre-cutoff action (imputed later by the model pipeline).
    """
    static = static_features(users)
    behavior = behavior_features(users, events, cutoff_day, sent_source, hot_users=hot_users)
    variant = variant_features(users, assignments)
    j = static.join(behavior, "user_id", "left").join(variant, "user_id", "left")
    numeric = []
    for c in config.NUMERIC_FEATURES:
        v = F.col(c).cast("double")
        numeric.append((v if c in config.NULLABLE_NUMERIC_FEATURES else F.coalesce(v, F.lit(0.0))).alias(c))
    categorical = [F.coalesce(F.col(c), F.lit("unknown")).alias(c) if c == "onboarding_variant" else F.col(c)
                   for c in config.CATEGORICAL_FEATURES]
    return j.select("user_id", "signup_timestamp", *categorical, *numeric)


FEATURE_FAMILIES = {
    "static": ["signup_hour", "signup_day_of_week", "marketing_consent"],
    "counts": ["onboarding_started", "onboarding_complete", "profile_complete", "resume_upload",
               "job_recommendation_view", "job_save", "growth_task_complete", "career_report_generate",
               "num_core_actions_completed", "num_sessions", "num_user_actions", "num_days_active",
               "num_email_sent", "num_push_sent", "num_in_app_sent", "unique_event_type_count",
               "first_day_event_count", "last_2_days_event_count", "ai_assistant_interaction_count",
               "job_detail_view_count", "return_visit_count"],
    "sessions": ["num_sessions", "avg_events_per_session", "max_events_in_session", "total_user_actions_in_sessions"],
    "time": ["hours_to_first_action", "hours_since_last_action_at_cutoff"],
}


def recency_hours(users: DataFrame, events: DataFrame, cutoff_day: int = config.PREDICTION_CUTOFF_DAY,
                  action_source: str = "user_action", hot_users: DataFrame | None = None) -> DataFrame:
    """FE18 alone (user_id, hours_since_last_action_at_cutoff) for users with a pre-cutoff action,
    without building the other features."""
    pre = pre_cutoff_events(users, events.where(F.col("event_source") == action_source), cutoff_day, hot_users)
    last = pre.groupBy("user_id").agg(F.max("event_timestamp").alias("_last"), F.max("_cutoff").alias("_cutoff"))
    return last.select("user_id", hours_between("_last", "_cutoff").alias("hours_since_last_action_at_cutoff"))
