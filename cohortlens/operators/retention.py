"""Day-N, cohort, rolling and per-variant retention (RT1-RT9, RP4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.stats import safe_div
from cohortlens.functions.timeutil import plus_days, week_label
from cohortlens.operators.activity import active_on, with_activity

SIGNUP_WEEK = "signup_week"


def _rolled(day: int) -> Column:
    """Whether a user row of :func:`with_activity` acts at or after signup + day x 24 h."""
    return F.coalesce(F.col("_last") >= plus_days("signup_timestamp", day), F.lit(False))


def _rate(flag: Column) -> Column:
    return F.avg(flag.cast("double"))


def retained_flags(users: DataFrame, events: DataFrame, days: list[int], keep: list[str] | None = None,
                   source: str = "user_action") -> DataFrame:
    """One row per (user, day): retained iff an action falls on calendar day signup_date + day.

    Each user meets its bitmap of active days once; all days of the (small, fixed) list are bits of it.
    """
    keep = list(keep or [])
    base = with_activity(users.select("user_id", *keep, "signup_timestamp"), events, source)
    flags = F.array(*[F.struct(F.lit(int(d)).alias("day"), active_on(d).alias("retained")) for d in days])
    return base.select("user_id", *keep, F.inline(flags))


def compute_day_retention(users: DataFrame, events: DataFrame, day: int, group_by: str | None = None,
                          source: str = "user_action") -> DataFrame:
    """RT3: [group_by,] day, retention_rate (mean over all users; null groups dropped)."""
    flags = retained_flags(users, events, [day], [group_by] if group_by else [], source)
    rate = F.avg(F.col("retained").cast("double")).alias("retention_rate")
    if group_by is None:
        return flags.agg(rate).select(F.lit(int(day)).alias("day"), "retention_rate")
    return (flags.where(F.col(group_by).isNotNull()).groupBy(group_by).agg(rate)
            .select(group_by, F.lit(int(day)).alias("day"), "retention_rate").orderBy(group_by))


def with_signup_week(users: DataFrame) -> DataFrame:
    """RT5: Monday-Sunday signup-week label."""
    return users.withColumn(SIGNUP_WEEK, week_label("signup_timestamp"))


def compute_cohort_retention(users: DataFrame, events: DataFrame, days=(1, 7, 14),
                             cohort_col: str = SIGNUP_WEEK, source: str = "user_action") -> DataFrame:
    """RT4/RT6: cohort_col, day, users, retained, retention_rate; null cohorts dropped."""
    if cohort_col == SIGNUP_WEEK:
        users = with_signup_week(users)
    elif cohort_col not in users.columns:
        raise ValueError(f"cohort column {cohort_col!r} not in users; merge it first (e.g. variant_id)")
    flags = retained_flags(users, events, list(days), [cohort_col], source)
    flags = flags.where(F.col(cohort_col).isNotNull())
    agg = flags.groupBy(cohort_col, "day").agg(
        F.count(F.lit(1)).alias("users"), F.count_if("retained").alias("retained"))
    return (agg.withColumn("retention_rate", safe_div("retained", "users"))
            .orderBy(cohort_col, "day"))


def cohort_pivot(cohort: DataFrame, days=(1, 7, 14), cohort_col: str = SIGNUP_WEEK) -> DataFrame:
    """RT9: one row per cohort, one ``day_<N>`` column per day (explicit pivot values)."""
    wide = cohort.groupBy(cohort_col).pivot("day", [int(d) for d in days]).agg(F.first("retention_rate"))
    return wide.select(cohort_col, *[F.col(str(int(d))).alias(f"day_{int(d)}") for d in days]).orderBy(cohort_col)


def compute_rolling_retention(users: DataFrame, events: DataFrame, day: int,
                              source: str = "user_action") -> DataFrame:
    """RT7: share of users whose last action instant is >= signup + day x 24 h (0.0 if no users)."""
    j = with_activity(users.select("user_id", "signup_timestamp"), events, source)
    return j.agg(F.coalesce(_rate(_rolled(day)), F.lit(0.0)).alias("retention_rate")) \
        .select(F.lit(int(day)).alias("day"), "retention_rate")


def users_with_variant(users: DataFrame, assignments: DataFrame,
                       experiment_id: str = config.ONBOARDING_EXPERIMENT_ID) -> DataFrame:
    sub = assignments.where(F.col("experiment_id") == experiment_id).select("user_id", "variant_id")
    return users.join(sub, "user_id", "left")


def compute_retention_by_variant(users: DataFrame, events: DataFrame, assignments: DataFrame, day: int,
                                 experiment_id: str = config.ONBOARDING_EXPERIMENT_ID) -> DataFrame:
    """RT8: day-N retention per variant of one experiment; unassigned users drop out."""
    return compute_day_retention(users_with_variant(users, assignments, experiment_id), events, day,
                                 group_by="variant_id")


def retention_summary(users: DataFrame, events: DataFrame, days=(1, 7, 14),
                      rolling_day: int = config.PREDICTION_CUTOFF_DAY) -> DataFrame:
    """RP4: metric, rate rows for D1/D7/D14 plus rolling retention: the events are read once, every rate
    is an average over the users' bitmaps and last actions in one pass.
    """
    j = with_activity(users.select("user_id", "signup_timestamp"), events)
    one = j.agg(F.count(F.lit(1)).alias("n"), *[_rate(active_on(d)).alias(f"d{d}") for d in days],
                F.coalesce(_rate(_rolled(rolling_day)), F.lit(0.0)).alias("rolling"))
    rows = [F.struct(F.lit(f"D{d} retention").alias("metric"), F.col(f"d{d}").alias("rate"), F.lit(d).alias("_o")) for d in days]
    rows.append(F.struct(F.lit(f"D{rolling_day} rolling retention").alias("metric"), F.col("rolling").alias("rate"), F.lit(10_000).alias("_o")))
    # without users there are no day rates, and a rolling one of 0
    out = one.select("n", F.inline(F.array(*rows))).where((F.col("n") > 0) | (F.col("_o") == 10_000))
    return out.orderBy("_o").select("metric", "rate")
