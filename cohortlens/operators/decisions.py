"""Rule-based next best action (NB1, NB2) for every user at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.timeutil import minus_days, plus_days
from cohortlens.operators.activity import actions, with_user_columns

STATE_FLAGS = list(config.STATE_EVENTS) + ["recently_active"]


def compute_user_state(users: DataFrame, events: DataFrame, cutoff_day: int = config.PREDICTION_CUTOFF_DAY,
                       cutoff: Column | None = None, recent_days: int = 2, source: str = "user_action",
                       hot_users: DataFrame | None = None) -> DataFrame:
    """NB1: lifecycle flags from actions with ts <= cutoff (inclusive); recent = ts >= cutoff - 2d.

    ``cutoff`` defaults to signup + ``cutoff_day`` days per user. Users without actions get
    all-false flags (left join onto users).
    """
    cut = cutoff if cutoff is not None else plus_days("signup_timestamp", cutoff_day)
    u = users.select("user_id", cut.alias("_cutoff"))
    ev = actions(events, source).select("user_id", "event_name", "event_timestamp")
    j = with_user_columns(ev, u, ["_cutoff"], hot=hot_users).where(F.col("event_timestamp") <= F.col("_cutoff"))
    flags = j.groupBy("user_id").agg(
        *[F.max(F.col("event_name") == e).alias(flag) for flag, e in config.STATE_EVENTS.items()],
        F.max(F.col("event_timestamp") >= minus_days("_cutoff", recent_days)).alias("recently_active"))
    out = u.join(flags, "user_id", "left")
    return out.select("user_id", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in STATE_FLAGS])


def decide(state: dict[str, Column], consent: Column, score: Column | None,
           threshold: float = config.HIGH_RISK_ACTION_THRESHOLD) -> Column:
    """NB2 rule chain as one struct(action_name, channel, reason) expression (first match wins).

    High risk = score >= threshold, or - when no score is given (null) - onboarded and not
    recently active. A NaN score counts as given but not high.
    """
    onboarded = state["onboarding_completed"]
    heuristic = onboarded & ~state["recently_active"]
    if score is None:
        high = heuristic
    else:
        high = F.when(score.isNull(), heuristic).when(F.isnan(score), F.lit(False)).otherwise(score >= threshold)

    def res(action: str, channel: Column | str, reason: Column | str) -> Column:
        ch = F.lit(channel) if isinstance(channel, str) else channel
        rs = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(action).alias("action_name"), ch.alias("channel"), rs.alias("reason"))

    email_or_app = F.when(consent, "email").otherwise("in_app")
    chain = F.when(high, res(config.NBA_REENGAGE, email_or_app,
                             F.when(consent, config.NBA_REASON_HIGH_RISK_CONSENT)
                             .otherwise(config.NBA_REASON_HIGH_RISK_NO_CONSENT)))
    for flag, action, reason in config.NBA_STEP_RULES:
        chain = chain.when(~state[flag], res(action, "in_app", reason))
    done_action, done_reason = config.NBA_DONE
    return chain.otherwise(res(done_action, email_or_app, done_reason))


def recommend_next_action(users: DataFrame, events: DataFrame, scores: DataFrame | None = None,
                          cutoff_day: int = config.PREDICTION_CUTOFF_DAY,
                          threshold: float = config.HIGH_RISK_ACTION_THRESHOLD,
                          score_col: str = "churn_risk_score", hot_users: DataFrame | None = None) -> DataFrame:
    """NB2 for all users: user_id, action_name, channel, reason (scores: user_id, score_col)."""
    state = compute_user_state(users, events, cutoff_day, hot_users=hot_users)
    base = users.select("user_id", F.coalesce(F.col("marketing_consent"), F.lit(False)).alias("_consent"))
    j = base.join(state, "user_id", "left")
    score = None
    if scores is not None:
        j = j.join(scores.select("user_id", F.col(score_col).alias("_score")), "user_id", "left")
        score = F.col("_score")
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in STATE_FLAGS}
    return j.select("user_id", decide(flags, F.col("_consent"), score, threshold).alias("_r")).select("user_id", "_r.*")
