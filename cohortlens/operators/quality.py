"""Data-quality validation (DQ1-DQ23) as one small report DataFrame.

Report rows: check, severity ('error' | 'warning'), passed, violations, detail. Checks on one
table fold into a single aggregate over that table; key checks are anti-joins on distinct ids;
the per-session order check runs in two bounded levels (blocks of the ingest order, then the
blocks of each session), so a giant session never lands in one window partition whole.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.scalars import scalar_row
from cohortlens.functions.stats import chi2_sf
from cohortlens.functions.timeutil import plus_days
from cohortlens.operators.activity import with_user_columns
from cohortlens.sources import schemas

ERROR, WARNING = "error", "warning"

REQUIRED_USER_COLUMNS = [c for c in schemas.USERS.names if c not in schemas.PRIVATE_USER_COLUMNS]
REQUIRED_EVENT_COLUMNS = [c for c in schemas.EVENTS.names if c not in ("experiment_id", "variant_id")]
USER_DOMAINS = {"acquisition_channel": config.ACQUISITION_CHANNELS, "device_type": config.DEVICE_TYPES,
                "user_intent_level": config.USER_INTENT_LEVELS, "career_stage": config.CAREER_STAGES}
SESSION_BLOCK = 1 << 20  # rows of ingest order handled by one window partition at most


def _row(check: str, severity: str, violations: Column, detail: str, passed: Column | None = None,
         value: Column | None = None) -> Column:
    """One report row; ``value`` carries the measured statistic (share, rate, p-value) if any."""
    v = violations.cast("bigint")
    ok = (v == 0) if passed is None else passed
    val = F.lit(None).cast("double") if value is None else value.cast("double")
    return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), ok.alias("passed"),
                    v.alias("violations"), val.alias("value"), F.lit(detail).alias("detail"))


def _invalid(c: str, domain: list[str]) -> Column:
    return F.col(c).isNull() | ~F.col(c).isin(domain)


def _domain_checks(c: str, domain: list[str]) -> list[Column]:
    bad = _invalid(c, domain)
    return [F.count_if(bad).alias(f"_{c}_rows"), F.count_distinct(F.when(bad, F.col(c))).alias(f"_{c}_vals"),
            F.max(bad & F.col(c).isNull()).alias(f"_{c}_null")]


def _domain_row(check: str, c: str, severity: str = ERROR) -> Column:
    """violations = offending rows, value = distinct offending values (null counts as one)."""
    n_vals = F.col(f"_{c}_vals") + F.coalesce(F.col(f"_{c}_null"), F.lit(False)).cast("bigint")
    return _row(check, severity, F.col(f"_{c}_rows"), f"rows with {c} outside the domain", value=n_vals)


def _dup_count(c: str) -> Column:
    # rows after the first per key; nulls compare equal to each other
    return F.count(F.lit(1)) - F.count_distinct(F.col(c)) - F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).cast("bigint")


def _missing_columns(df: DataFrame, required: list[str], check: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    spark = df.sparkSession
    return spark.range(1).select(_row(check, ERROR, F.lit(len(missing)),
                                      "missing: " + ",".join(missing) if missing else "all required columns present"
                                      ).alias("r"))


def _report(df: DataFrame, aggregates: list[Column], rows: list[Column]) -> DataFrame | None:
    return df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("r")) if rows else None


def _users_checks(users: DataFrame, data_freeze: datetime | Column) -> DataFrame | None:
    """The checks whose columns exist; a missing column is an error of its own (DQ1)."""
    has = set(users.columns)
    domains = {c: d for c, d in USER_DOMAINS.items() if c in has}
    aggregates, rows = [], []
    for c in ("acquisition_channel", "device_type"):
        if c in has:
            aggregates += _domain_checks(c, domains[c])
            rows.append(_domain_row(f"{c}_domain", c))
    if "user_id" in has:
        aggregates.append(_dup_count("user_id").alias("_dup"))
        rows.append(_row("unique_user_ids", ERROR, F.col("_dup"), "duplicate user_id rows"))
    broken = [F.col(c).isNull() for c in ("user_id", "signup_timestamp", "marketing_consent") if c in has]
    broken += [_invalid(c, d) for c, d in domains.items()]
    if broken:
        aggregates.append(F.count_if(reduce(or_, broken)).alias("_constraint"))
        rows.append(_row("user_row_constraints", ERROR, F.col("_constraint"), "users rows violating declared types/domains"))
    if "signup_timestamp" in has:
        freeze = data_freeze if isinstance(data_freeze, Column) else F.lit(data_freeze).cast("timestamp_ntz")
        aggregates.append(F.max("signup_timestamp").alias("_max_signup"))
        late = F.coalesce(plus_days(F.col("_max_signup"), config.LABEL_WINDOW_END_DAY) > freeze, F.lit(False))
        rows.append(_row("observation_window", ERROR, late.cast("bigint"), "latest signup + label window beyond data freeze"))
    return _report(users, aggregates, rows)


def _events_checks(events: DataFrame) -> DataFrame | None:
    """The checks whose columns exist; a missing column is an error of its own (DQ2)."""
    has = set(events.columns)
    aggregates, rows = [F.count(F.lit(1)).alias("_n")], []
    for c, domain, severity in (("event_name", config.ALL_EVENT_NAMES, ERROR), ("event_source", config.EVENT_SOURCES, ERROR),
                                ("platform", config.PLATFORMS, WARNING)):
        if c in has:
            aggregates += _domain_checks(c, domain)
            rows.append(_domain_row(f"{c}_domain", c, severity))
    if "event_id" in has:
        aggregates.append(_dup_count("event_id").alias("_dup"))
        rows.append(_row("unique_event_ids", ERROR, F.col("_dup"), "duplicate event_id rows"))
    for c, wrong, check, limit, detail in (
            ("event_properties", F.col("event_properties").isNull(), "event_properties_missing_rate", config.EVENT_PROPERTIES_MISSING_MAX,
             "share of null event_properties"),
            ("event_source", F.col("event_source") == "campaign", "campaign_event_share", config.CAMPAIGN_SHARE_MAX, "share of campaign events")):
        if c in has:
            aggregates.append(F.count_if(wrong).alias(f"_c_{c}"))
            share = F.try_divide(F.col(f"_c_{c}"), F.col("_n"))
            rows.append(_row(check, WARNING, F.col(f"_c_{c}"), detail, ~F.coalesce(share > limit, F.lit(False)), share))
    return _report(events, aggregates, rows)


def offending_values(df: DataFrame, column: str, domain: list[str], top: int = 20) -> DataFrame:
    """DQ3-DQ8 in detail: the most frequent values outside a domain, null among them, with their
    rows (a top-k report: violations are counted in full by :func:`validate`)."""
    bad = df.where(_invalid(column, domain)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return bad.select(F.lit(column).alias("column"), "value", "rows").orderBy(F.desc("rows"), F.asc_nulls_first("value")).limit(top)


def _orphans(child: DataFrame, parent: DataFrame, check: str, severity: str = ERROR) -> DataFrame:
    """Distinct child user_ids (null included) with no parent row."""
    ids = child.select("user_id").distinct()
    orphans = ids.join(parent.select("user_id").distinct(), "user_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("_n")).select(_row(check, severity, F.col("_n"), "distinct user_ids").alias("r"))


def _event_user_keys(users: DataFrame, events: DataFrame) -> DataFrame:
    """DQ10 + DQ22 in one pass over events: the per-user event count (partial aggregation, null
    ids kept as their own group) full-outer-joined with the distinct user ids."""
    ev = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("_ne"))
    us = users.select("user_id").distinct().withColumn("_u", F.lit(True))
    j = ev.join(us, ev["user_id"].eqNullSafe(us["user_id"]), "full_outer")
    agg = j.agg(F.count_if(F.col("_u").isNull()).alias("_orphans"), F.count_if(F.col("_ne").isNull()).alias("_silent"))
    rows = F.array(_row("event_foreign_keys", ERROR, F.col("_orphans"), "distinct user_ids"),
                   _row("users_with_events", ERROR, F.col("_silent"), "distinct user_ids"))
    return agg.select(F.explode(rows).alias("r"))


def _events_before_signup(users: DataFrame, events: DataFrame, hot_users: DataFrame | None = None) -> DataFrame:
    j = with_user_columns(events.select("user_id", "event_timestamp"), users, ["signup_timestamp"], hot=hot_users)
    n = j.agg(F.count_if(F.col("event_timestamp") < F.col("signup_timestamp")).alias("_n"))
    return n.select(_row("event_after_signup", ERROR, F.col("_n"), "events earlier than their user's signup").alias("r"))


def session_order_violations(events: DataFrame, order_cols: list[str], block: int = SESSION_BLOCK) -> DataFrame:
    """DQ16: sessions whose timestamps decrease somewhere in ingest order (ties allowed).

    Level 1 windows over (session, ingest block) - at most ``block`` rows each - flag in-block
    decreases and keep each block's first/last timestamp; level 2 compares consecutive blocks
    of the same session. Null sessions are ignored. Returns (sessions).
    """
    ev = events.where(F.col("session_id").isNotNull())
    ordinal = F.struct(*[F.col(c) for c in order_cols])
    seq = order_cols[-1]
    ev = ev.select("session_id", "event_timestamp", ordinal.alias("_ord"),
                   *[F.col(c) for c in order_cols[:-1]], F.floor(F.col(seq) / block).alias("_blk"))
    blk_keys = ["session_id", *order_cols[:-1], "_blk"]
    w1 = Window.partitionBy(*blk_keys).orderBy("_ord")
    ev = ev.withColumn("_dec", F.lag("event_timestamp").over(w1) > F.col("event_timestamp"))
    blocks = ev.groupBy(*blk_keys).agg(
        F.max(F.coalesce("_dec", F.lit(False))).alias("_dec"),
        F.min_by("event_timestamp", "_ord").alias("_first"),
        F.max_by("event_timestamp", "_ord").alias("_last"),
        F.min("_ord").alias("_ord"))
    w2 = Window.partitionBy("session_id").orderBy("_ord")
    blocks = blocks.withColumn("_dec2", F.coalesce(F.lag("_last").over(w2) > F.col("_first"), F.lit(False)))
    bad = blocks.where(F.col("_dec") | F.col("_dec2")).select("session_id").distinct()
    return bad.agg(F.count(F.lit(1)).alias("sessions"))


def srm_by_experiment(assignments: DataFrame, variants: list[tuple[str, float]] | None = None,
                      alpha: float = config.SRM_ALPHA) -> DataFrame:
    """DQ17: one SRM row per experiment present in the assignments (allocation from config)."""
    alloc = dict(variants or config.ONBOARDING_VARIANTS)
    variant = F.col("variant_id")
    per_exp = assignments.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(variant == v).alias(f"o{i}") for i, v in enumerate(alloc)],
        F.count_if(variant.isNull() | ~variant.isin(list(alloc))).alias("unknown"))
    chi2 = F.lit(0.0)
    for i, share in enumerate(alloc.values()):
        expected = F.lit(share) * F.col("n")
        chi2 = chi2 + F.try_divide(F.pow(F.col(f"o{i}") - expected, 2), expected)
    p = chi2_sf(chi2, len(alloc) - 1)
    return per_exp.select(F.struct(
        F.concat(F.lit("srm_"), F.coalesce("experiment_id", F.lit("null"))).alias("check"), F.lit(ERROR).alias("severity"),
        ((p >= alpha) & (F.col("unknown") == 0)).alias("passed"),
        F.col("unknown").cast("bigint").alias("violations"),
        p.cast("double").alias("value"),
        F.lit("chi-square p-value vs configured allocation; violations = rows of unknown variants").alias("detail"),
    ).alias("r"))


def _label_checks(users: DataFrame, labels: DataFrame, churn_range=config.CHURN_RATE_RANGE) -> DataFrame:
    rate = labels.agg(F.avg(F.col("is_churned").cast("double")).alias("_rate"))
    lo, hi = churn_range
    in_range = F.coalesce(F.col("_rate").between(lo, hi), F.lit(False))
    churn = rate.select(_row("churn_rate_range", ERROR, (~in_range).cast("bigint"), "mean is_churned",
                             in_range, F.col("_rate")).alias("r"))
    lab_ids, user_ids = labels.select("user_id").distinct(), users.select("user_id").distinct()
    extra = lab_ids.join(user_ids, "user_id", "left_anti").agg(F.count(F.lit(1)).alias("_a"))
    missing = user_ids.join(lab_ids, "user_id", "left_anti").agg(F.count(F.lit(1)).alias("_b"))
    both = scalar_row(extra, missing)
    setq = both.select(_row("label_user_set", ERROR, F.col("_a") + F.col("_b"),
                            "label ids not in users plus users without a label").alias("r"))
    return churn.unionByName(setq)


def _assignment_constraints(assignments: DataFrame) -> DataFrame:
    bad = F.col("traffic_allocation").isNull() | ~F.col("traffic_allocation").between(0.0, 1.0)
    return assignments.agg(F.count_if(bad).alias("_n")).select(
        _row("traffic_allocation_range", WARNING, F.col("_n"), "allocation outside [0, 1]").alias("r"))


def _intervention_constraints(interventions: DataFrame) -> DataFrame:
    agg = interventions.agg(*_domain_checks("channel", config.INTERVENTION_CHANNELS))
    return agg.select(_domain_row("intervention_channel_domain", "channel", WARNING).alias("r"))


def validate(users: DataFrame, events: DataFrame, assignments: DataFrame, labels: DataFrame | None = None,
             interventions: DataFrame | None = None, data_freeze: datetime | Column = config.DATA_FREEZE,
             session_order_cols: list[str] | None = None, ordered_events: DataFrame | None = None,
             hot_users: DataFrame | None = None) -> DataFrame:
    """DQ1-DQ23: the whole report; ``passed`` overall = :func:`report_passed`.

    The session-order check (DQ16) runs when ``session_order_cols`` names the ingest-order
    columns, read from ``ordered_events`` (default: ``events``)."""
    parts = [
        _missing_columns(users, REQUIRED_USER_COLUMNS, "users_columns"),
        _missing_columns(events, REQUIRED_EVENT_COLUMNS, "events_columns"),
        _users_checks(users, data_freeze),
        _events_checks(events),
        srm_by_experiment(assignments),
        _assignment_constraints(assignments),
    ]
    if "user_id" not in users.columns:
        interventions = labels = None
    else:
        parts += [_orphans(assignments, users, "experiment_foreign_keys"), _orphans(users, assignments, "users_missing_assignment")]
        if "user_id" in events.columns:
            parts.append(_event_user_keys(users, events))
            if "event_timestamp" in events.columns and "signup_timestamp" in users.columns:
                parts.append(_events_before_signup(users, events, hot_users))
    if interventions is not None:
        parts.append(_orphans(interventions, users, "intervention_foreign_keys"))
        parts.append(_intervention_constraints(interventions))
    if labels is not None:
        parts.append(_label_checks(users, labels))
    if session_order_cols and {"session_id", "event_timestamp"} <= set(events.columns):
        so = session_order_violations(ordered_events if ordered_events is not None else events, session_order_cols)
        parts.append(so.select(_row("session_timestamp_order", WARNING, F.col("sessions"),
                                    "sessions with out-of-order timestamps").alias("r")))
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None]).select("r.*")


def report_passed(report: DataFrame) -> DataFrame:
    """Overall verdict: no failed error-severity check (warnings never fail)."""
    return report.agg(F.coalesce(F.min(F.when(F.col("severity") == ERROR, F.col("passed"))), F.lit(True)).alias("passed"),
                      F.count_if((F.col("severity") == ERROR) & ~F.col("passed")).alias("errors"),
                      F.count_if((F.col("severity") == WARNING) & ~F.col("passed")).alias("warnings"))
