"""Plain-SQL (DuckDB dialect) statements of the registered queries, for side-by-side checks.

Each statement starts from the same adapter CTEs as :mod:`cohortlens.sources.testdata`
(``e`` events, ``u`` users, ``a`` assignments, ``lb`` labels) over the driver's raw views, so the
oracle recomputes everything from the given tables. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from cohortlens import config
from cohortlens.functions.hashing import cumulative_allocations
from cohortlens.plans import faults
from cohortlens.sources import testdata as A
from cohortlens.sources.testdata import ADAPTER_FUNNEL_STEPS

R = 6
P = 12  # p-values are compared to more places: small ones must not become 0


def _case(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def _variant_case(bucket: str) -> str:
    whens = " ".join(f"WHEN CAST({bucket} AS DOUBLE) / 1000000.0 < CAST({cum!r} AS DOUBLE) THEN '{name}'"
                     for name, cum in cumulative_allocations(config.ONBOARDING_VARIANTS))
    return f"CASE {whens} ELSE '{config.ONBOARDING_VARIANTS[-1][0]}' END"


def _md5_bucket(text: str, modulus: int = 1_000_000) -> str:
    acc = "0"
    for i in range(4):
        chunk = f"('0x' || substr(md5({text}), {8 * i + 1}, 8))::BIGINT"
        acc = f"(({acc}) * {(1 << 32) % modulus} + {chunk}) % {modulus}"
    return acc


def _alloc_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{n}' THEN CAST({a!r} AS DOUBLE)" for n, a in config.ONBOARDING_VARIANTS) + " END"


FREEZE = "(SELECT date_trunc('day', max(event_timestamp)) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND FROM e)"


def _of(expr: str, values: dict) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in values.items()) + " END"


_TENS = "((k // 10) % 10)"
_MILESTONE = ("CASE WHEN (day(ts) - 1) % 7 = 0 THEN CASE WHEN hour(ts) < 12 THEN 'signup' "
              f"WHEN {_TENS} < 2 THEN 'onboarding_start' ELSE 'onboarding_complete' END "
              f"ELSE {_of('(day(ts) - 1) % 7', A.MILESTONE_OF_DAY)} END")
_IS_MILESTONE = (f"(event_type IN ({', '.join(repr(t) for t in A.MILESTONE_TYPES)}) "
                 f"OR (event_type = 'click' AND {_TENS} < {A.MILESTONE_CLICKS}))")
EXP = config.ONBOARDING_EXPERIMENT_ID

ADAPTER = f"""
r AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         user_id * 10 + CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 >= {A.QUIET_ENTITIES}
                             THEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 10
                             WHEN json_extract_string(props, '$.k') IS NOT NULL THEN 0 END AS uid
  FROM events
),
e AS (
  SELECT event_id, uid AS user_id,
         CAST(uid AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         CASE WHEN {_IS_MILESTONE} THEN {_MILESTONE} WHEN event_type = 'click' THEN {_of(_TENS, A.CLICK_NAMES)}
              ELSE {_of(_TENS, A.ERROR_NAMES)} END AS event_name,
         ts AS event_timestamp,
         props AS event_properties,
         CAST(NULL AS VARCHAR) AS page_name,
         {_case('event_id % 3', config.PLATFORMS)} AS platform,
         CASE WHEN event_type = 'error' THEN 'system' WHEN event_type = 'click' AND {_TENS} >= {A.CAMPAIGN_CLICKS}
              THEN 'campaign' ELSE 'user_action' END AS event_source
  FROM r
),
u AS (
  SELECT f.user_id, f.signup_timestamp,
         {_of('c.c_mktsegment', A.CHANNEL_OF_SEGMENT)} AS acquisition_channel,
         n.n_name AS country,
         {_case('f.user_id % 3', config.DEVICE_TYPES)} AS device_type,
         coalesce({_case('n.n_nationkey % 4', A.LANGUAGES)}, 'unknown') AS language,
         coalesce({_case('n.n_regionkey % 5', A.TIMEZONES)}, 'unknown') AS timezone, 'free' AS initial_plan_type,
         {_case('(f.user_id // 3) % 3', config.USER_INTENT_LEVELS)} AS user_intent_level,
         {_case('(f.user_id // 9) % 3', config.CAREER_STAGES)} AS career_stage,
         (f.user_id % 2 = 0) AS marketing_consent
  FROM (SELECT user_id, min(event_timestamp) AS signup_timestamp FROM e GROUP BY user_id) f
  LEFT JOIN customer c ON f.user_id // 10 = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
a0 AS (
  SELECT '{EXP}' AS experiment_id, user_id,
         {_variant_case(_md5_bucket("CAST(user_id AS VARCHAR) || ':' || '" + EXP + "' || ':' || ''"))} AS variant_id,
         signup_timestamp AS assignment_time
  FROM u
),
a AS (
  SELECT a0.experiment_id, a0.user_id, a0.variant_id, a0.assignment_time,
         '{config.ONBOARDING_EXPERIMENT_NAME}' AS experiment_name,
         '{config.ONBOARDING_EXPERIMENT_TYPE}' AS experiment_type,
         {_alloc_case('a0.variant_id')} AS traffic_allocation,
         TRUE AS is_exposed,
         a0.user_id IN (SELECT user_id FROM e WHERE event_source = 'user_action'
                        AND event_name = 'onboarding_complete') AS is_converted
  FROM a0
),
lw AS (
  SELECT user_id, signup_timestamp,
         signup_timestamp + INTERVAL {config.PREDICTION_CUTOFF_DAY} DAY AS prediction_cutoff,
         signup_timestamp + INTERVAL {config.LABEL_WINDOW_START_DAY} DAY AS label_start,
         signup_timestamp + INTERVAL {config.LABEL_WINDOW_END_DAY} DAY AS label_end
  FROM u
  WHERE signup_timestamp + INTERVAL {config.LABEL_WINDOW_END_DAY} DAY <= {FREEZE}
),
lb AS (
  SELECT lw.*, CAST(CASE WHEN EXISTS (
      SELECT 1 FROM e WHERE e.user_id = lw.user_id AND e.event_source = 'user_action'
        AND e.event_timestamp BETWEEN lw.label_start AND lw.label_end) THEN 0 ELSE 1 END AS INTEGER) AS is_churned
  FROM lw
)"""


def with_adapter(*ctes: str, recursive: bool = False) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{ADAPTER}{extra}\n"


# ---------------------------------------------------------------- funnel (FN) -----------------

def funnel_sql(group: str | None, steps: list[str] | None = None) -> str:
    steps = steps or ADAPTER_FUNNEL_STEPS
    firsts = ",\n    ".join(f"min(CASE WHEN event_name = '{s}' THEN event_timestamp END) AS t{i}"
                            for i, s in enumerate(steps))
    gsel = f"u.{group} AS g, " if group else ""
    passes = ["TRUE AS p0"]
    chain = "TRUE"
    for i in range(1, len(steps)):
        chain = f"({chain}) AND coalesce(t{i} > t{i - 1}, FALSE)"
        passes.append(f"{chain} AS p{i}")
    counts = ", ".join(f"count(*) FILTER (WHERE p{i}) AS n{i}" for i in range(len(steps)))
    gfilter = "WHERE g IS NOT NULL" if group else ""
    gby = "GROUP BY g" if group else ""
    rows = []
    for i, s in enumerate(steps):
        conv = f"CASE WHEN n0 = 0 THEN 0.0 ELSE n{i} / n0 END"
        drop = "0.0" if i == 0 else f"CASE WHEN n{i - 1} = 0 THEN 0.0 ELSE (n{i - 1} - n{i}) / n{i - 1} END"
        gcol = f", g AS {group}" if group else ""
        rows.append(f"SELECT '{s}' AS step, n{i} AS users, round({conv}, {R}) AS conversion_rate, "
                    f"round({drop}, {R}) AS drop_off_rate{gcol} FROM c")
    union = "\nUNION ALL\n".join(rows)
    return with_adapter(
        f"fo AS (SELECT user_id,\n    {firsts}\n  FROM e WHERE event_source = 'user_action' GROUP BY user_id)",
        f"j AS (SELECT {gsel}fo.* EXCLUDE (user_id) FROM u LEFT JOIN fo ON u.user_id = fo.user_id)",
        f"p AS (SELECT {'g, ' if group else ''}{', '.join(passes)} FROM j {gfilter})",
        f"c AS (SELECT {'g, ' if group else ''}{counts} FROM p {gby})",
    ) + union


# ---------------------------------------------------------------- retention (RT) --------------

AD = "ad AS (SELECT DISTINCT user_id, CAST(event_timestamp AS DATE) AS d FROM e WHERE event_source = 'user_action')"
WEEK = ("strftime(date_trunc('week', signup_timestamp)::DATE, '%Y-%m-%d') || '/' || "
        "strftime(date_trunc('week', signup_timestamp)::DATE + 6, '%Y-%m-%d')")


def _flags_cte(days, keep: str = "") -> str:
    values = ", ".join(f"({int(d)})" for d in days)
    return (f"rf AS (SELECT uu.user_id{keep}, x.day, (ad.user_id IS NOT NULL) AS retained "
            f"FROM uu CROSS JOIN (VALUES {values}) x(day) "
            f"LEFT JOIN ad ON ad.user_id = uu.user_id AND ad.d = CAST(uu.signup_timestamp AS DATE) + x.day)")


def day_retention_sql(day: int, group: str | None = None) -> str:
    if group is None:
        return with_adapter(AD, "uu AS (SELECT * FROM u)", _flags_cte([day])) + \
            f"SELECT day, round(avg(CASE WHEN retained THEN 1.0 ELSE 0.0 END), {R}) AS retention_rate FROM rf GROUP BY day"
    return with_adapter(AD, "uu AS (SELECT * FROM u)", _flags_cte([day], f", uu.{group}")) + \
        f"SELECT {group}, day, round(avg(CASE WHEN retained THEN 1.0 ELSE 0.0 END), {R}) AS retention_rate " \
        f"FROM rf WHERE {group} IS NOT NULL GROUP BY {group}, day"


def retention_by_variant_sql(day: int) -> str:
    uu = (f"uu AS (SELECT u.*, s.variant_id FROM u LEFT JOIN (SELECT user_id, variant_id FROM a "
          f"WHERE experiment_id = '{EXP}') s ON u.user_id = s.user_id)")
    return with_adapter(AD, uu, _flags_cte([day], ", uu.variant_id")) + \
        f"SELECT variant_id, day, round(avg(CASE WHEN retained THEN 1.0 ELSE 0.0 END), {R}) AS retention_rate " \
        f"FROM rf WHERE variant_id IS NOT NULL GROUP BY variant_id, day"


def cohort_sql(cohort: str, days=(1, 7, 14)) -> str:
    uu = f"uu AS (SELECT u.*, {WEEK} AS signup_week FROM u)"
    return with_adapter(AD, uu, _flags_cte(days, f", uu.{cohort}")) + \
        f"SELECT {cohort}, day, count(*) AS users, count(*) FILTER (WHERE retained) AS retained, " \
        f"round(count(*) FILTER (WHERE retained) / count(*), {R}) AS retention_rate " \
        f"FROM rf WHERE {cohort} IS NOT NULL GROUP BY {cohort}, day"


def cohort_pivot_sql(days=(1, 7, 14)) -> str:
    uu = f"uu AS (SELECT u.*, {WEEK} AS signup_week FROM u)"
    cols = ", ".join(f"round(count(*) FILTER (WHERE retained AND day = {d}) / "
                     f"count(*) FILTER (WHERE day = {d}), {R}) AS day_{d}" for d in days)
    return with_adapter(AD, uu, _flags_cte(days, ", uu.signup_week")) + \
        f"SELECT signup_week, {cols} FROM rf WHERE signup_week IS NOT NULL GROUP BY signup_week"


def _rolling_cte(day: int) -> str:
    return (f"rr AS (SELECT coalesce(avg(CASE WHEN l.last_ts >= u.signup_timestamp + INTERVAL {day} DAY "
            f"THEN 1.0 ELSE 0.0 END), 0.0) AS rate FROM u LEFT JOIN (SELECT user_id, max(event_timestamp) AS last_ts "
            f"FROM e WHERE event_source = 'user_action' GROUP BY user_id) l ON u.user_id = l.user_id)")


def rolling_sql(day: int) -> str:
    return with_adapter(_rolling_cte(day)) + f"SELECT {day} AS day, round(rate, {R}) AS retention_rate FROM rr"


def retention_summary_sql(days=(1, 7, 14), rolling_day: int = config.PREDICTION_CUTOFF_DAY) -> str:
    return with_adapter(AD, "uu AS (SELECT * FROM u)", _flags_cte(days), _rolling_cte(rolling_day)) + \
        f"SELECT 'D' || day || ' retention' AS metric, round(avg(CASE WHEN retained THEN 1.0 ELSE 0.0 END), {R}) AS rate " \
        f"FROM rf GROUP BY day UNION ALL SELECT 'D{rolling_day} rolling retention', round(rate, {R}) FROM rr"


# ---------------------------------------------------------------- assignment / experiment -----

def variant_assignment_sql() -> str:
    bucket = _md5_bucket("CAST(user_id AS VARCHAR) || ':' || '" + EXP + "' || ':' || ''")
    return with_adapter() + f"SELECT user_id, {bucket} AS bucket, variant_id FROM a0"


def assignments_sql() -> str:
    return with_adapter() + "SELECT * FROM a"


def srm_sql() -> str:
    k = len(config.ONBOARDING_VARIANTS)
    alloc = ", ".join(f"('{n}', CAST({a!r} AS DOUBLE))" for n, a in config.ONBOARDING_VARIANTS)
    if k - 1 != 2:
        raise NotImplementedError("oracle closed form written for 2 degrees of freedom")
    return with_adapter(
        f"al AS (SELECT * FROM (VALUES {alloc}) t(variant_id, allocation))",
        f"ob AS (SELECT variant_id, count(*) AS observed FROM a WHERE experiment_id = '{EXP}' GROUP BY variant_id)",
        "j AS (SELECT al.allocation, coalesce(ob.observed, 0) AS observed, al.variant_id IS NOT NULL AS known "
        "FROM al FULL OUTER JOIN ob ON al.variant_id = ob.variant_id)",
        "n AS (SELECT sum(observed) AS n FROM j)",
        "c AS (SELECT sum(CASE WHEN known THEN (observed - allocation * n) ^ 2 / (allocation * n) END) AS chi2, "
        "CAST(coalesce(sum(CASE WHEN NOT known THEN observed END), 0) AS BIGINT) AS unknown_variant_rows FROM j, n)",
    ) + (f"SELECT '{EXP}' AS experiment_id, CAST(n AS BIGINT) AS n, round(chi2, {R}) AS chi2, {k - 1} AS dof, "
         f"round(exp(-chi2 / 2), {P}) AS p_value, unknown_variant_rows FROM c, n")


def normal_cdf_sql(z: str) -> str:
    """Same series as the Spark expression, written with log-gamma terms (z > 0 branch)."""
    za = f"least(abs({z}), 8.3)"
    series = (f"list_sum(list_transform(range(0, 151), lambda i: exp((2 * i + 1) * ln({za}) - "
              f"(lgamma(2 * i + 2) - i * ln(2) - lgamma(i + 1)))))")
    upper = (f"CASE WHEN abs({z}) >= 8.3 THEN 1.0 WHEN {z} = 0 THEN 0.5 ELSE "
             f"0.5 + exp(-({za}) * ({za}) / 2) / sqrt(2 * pi()) * {series} END")
    return f"(CASE WHEN {z} >= 0 THEN {upper} ELSE 1.0 - {upper} END)"


def experiment_sql(metrics: dict[str, str] | None = None) -> str:
    metrics = metrics or config.DEFAULT_EXPERIMENT_METRICS
    flags = ", ".join(f"bool_or(event_name = '{e}') AS m{i}" for i, e in enumerate(metrics.values())
                      if e != "d7_retention")
    fcols = []
    for i, e in enumerate(metrics.values()):
        fcols.append("(ad.user_id IS NOT NULL)" if e == "d7_retention" else f"coalesce(fl.m{i}, FALSE)")
    fsel = ", ".join(f"{c} AS f{i}" for i, c in enumerate(fcols))
    counts = ", ".join(f"count(*) FILTER (WHERE f{i}) AS c{i}" for i in range(len(metrics)))
    long = " UNION ALL ".join(f"SELECT '{m}' AS metric, variant_id, n, c{i} AS conv FROM pv"
                              for i, m in enumerate(metrics))
    pa, pb = "(cc / cn)", "(conv / n)"
    pooled = "((cc + conv) / (cn + n))"
    se = f"sqrt({pooled} * (1 - {pooled}) * (1.0 / cn + 1.0 / n))"
    z = f"(CASE WHEN {se} > 0 THEN ({pb} - {pa}) / {se} ELSE 0.0 END)"
    se_diff = f"sqrt({pa} * (1 - {pa}) / cn + {pb} * (1 - {pb}) / n)"
    treat = f"variant_id <> '{config.CONTROL_VARIANT}' AND cn > 0 AND n > 0"
    return with_adapter(
        AD,
        f"sub AS (SELECT a.user_id, a.variant_id, u.signup_timestamp FROM a LEFT JOIN u ON a.user_id = u.user_id "
        f"WHERE a.experiment_id = '{EXP}')",
        f"fl AS (SELECT user_id, {flags} FROM e WHERE event_source = 'user_action' GROUP BY user_id)",
        f"uf AS (SELECT sub.variant_id, {fsel} FROM sub LEFT JOIN fl ON sub.user_id = fl.user_id "
        f"LEFT JOIN ad ON ad.user_id = sub.user_id AND ad.d = CAST(sub.signup_timestamp AS DATE) + 7)",
        f"pv AS (SELECT variant_id, count(*) AS n, {counts} FROM uf GROUP BY variant_id)",
        f"lg AS ({long})",
        f"ct AS (SELECT metric, n AS cn, conv AS cc FROM lg WHERE variant_id = '{config.CONTROL_VARIANT}')",
        f"x AS (SELECT lg.*, coalesce(ct.cn, 0) AS cn, coalesce(ct.cc, 0) AS cc FROM lg LEFT JOIN ct ON lg.metric = ct.metric)",
    ) + (f"SELECT metric, variant_id, n AS sample_size, conv AS conversions, round(conv / n, {R}) AS conversion_rate, "
         f"CASE WHEN variant_id <> '{config.CONTROL_VARIANT}' THEN round({pb} - coalesce(cc / nullif(cn, 0), 0), {R}) END AS absolute_lift, "
         f"CASE WHEN variant_id <> '{config.CONTROL_VARIANT}' AND coalesce(cc / nullif(cn, 0), 0) > 0 "
         f"THEN round(({pb} - {pa}) / {pa}, {R}) END AS relative_lift, "
         f"CASE WHEN {treat} THEN round(2 * (1 - {normal_cdf_sql('abs(' + z + ')')}), {P}) END AS p_value, "
         f"CASE WHEN {treat} THEN round(({pb} - {pa}) - 1.96 * {se_diff}, {R}) END AS ci_lower, "
         f"CASE WHEN {treat} THEN round(({pb} - {pa}) + 1.96 * {se_diff}, {R}) END AS ci_upper FROM x")


def experiment_summary_sql() -> str:
    return (f"SELECT metric, variant_id, sample_size AS n, conversion_rate AS rate, relative_lift AS lift, "
            f"p_value AS p FROM ({experiment_sql()}) x")


def sample_sizes_sql() -> str:
    return with_adapter() + f"SELECT variant_id, count(*) AS sample_size FROM a WHERE experiment_id = '{EXP}' GROUP BY variant_id"


# ---------------------------------------------------------------- labels / reports ------------

def labels_sql() -> str:
    return with_adapter() + "SELECT * FROM lb"


def churn_by_channel_sql() -> str:
    return with_adapter() + (f"SELECT u.acquisition_channel, round(avg(CAST(lb.is_churned AS DOUBLE)), {R}) AS churn_rate "
                             "FROM u JOIN lb ON u.user_id = lb.user_id GROUP BY u.acquisition_channel")


def dataset_summary_sql() -> str:
    return with_adapter() + (
        "SELECT (SELECT count(*) FROM u) AS users, (SELECT count(*) FROM e) AS events, "
        f"round((SELECT count(*) FROM e) / (SELECT count(*) FROM u), {R}) AS events_per_user, "
        "(SELECT count(*) FROM lb) AS labelled_users, "
        f"round((SELECT avg(CAST(is_churned AS DOUBLE)) FROM lb), {R}) AS churn_rate")


def channel_overview_sql() -> str:
    return with_adapter() + (f"SELECT acquisition_channel, count(*) AS users, round(count(*) / sum(count(*)) OVER (), {R}) "
                             "AS share FROM u GROUP BY acquisition_channel")


def user_sample_sql(n: int = 10, seed: int = config.RANDOM_SEED) -> str:
    return with_adapter() + (f"SELECT * FROM u ORDER BY md5(CAST(user_id AS VARCHAR) || ':' || '{seed}'), user_id LIMIT {n}")


# ---------------------------------------------------------------- data quality (DQ) -----------

def _in(c: str, domain: list[str]) -> str:
    return f"({c} IS NULL OR {c} NOT IN ({', '.join(repr(v) for v in domain)}))"


def _dq_row(check, severity, violations, detail, passed=None, value="CAST(NULL AS DOUBLE)") -> str:
    passed = passed or f"({violations}) = 0"
    return (f"SELECT '{check}' AS \"check\", '{severity}' AS severity, {passed} AS passed, "
            f"CAST({violations} AS BIGINT) AS violations, round(CAST({value} AS DOUBLE), {R}) AS value, "
            f"'{detail}' AS detail")


def _dq_domain(check, table, c, domain, severity="error") -> str:
    bad = _in(c, domain)
    return _dq_row(check, severity, f"(SELECT count(*) FILTER (WHERE {bad}) FROM {table})",
                   f"rows with {c} outside the domain",
                   value=f"(SELECT count(DISTINCT CASE WHEN {bad} THEN {c} END) + "
                         f"CAST(coalesce(bool_or({bad} AND {c} IS NULL), FALSE) AS INTEGER) FROM {table})")


def _dq_orphans(check, child, parent) -> str:
    return _dq_row(check, "error", f"(SELECT count(*) FROM (SELECT DISTINCT user_id FROM {child}) x "
                                   f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.user_id = x.user_id))",
                   "distinct user_ids")


def dq_report_sql() -> str:
    ctes, rows = _dq_parts(f"TIMESTAMP '{config.DATA_FREEZE:%Y-%m-%d %H:%M:%S}'", "event_id")
    return with_adapter(*ctes, *_iv_plan_ctes()) + rows


def dq_faults_sql() -> str:
    """The same report over tables with faults that follow from the ids (see ``plans/faults.py``)."""
    ctes, rows = _dq_parts(FREEZE, "ingest_seq")
    shadowed = ", ".join(f"{t} AS (SELECT * FROM f{t})" for t in ("u", "e", "a", "iv"))
    return with_adapter(*_iv_plan_ctes(), *faults.SQL_CTES) + f"SELECT * FROM (WITH {shadowed}, {', '.join(ctes)}\n{rows})"


def offending_sql() -> str:
    parts = [f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, count(*) AS rows FROM f{t} WHERE {_in(c, d)} GROUP BY {c} "
             f"ORDER BY count(*) DESC, {c} NULLS FIRST LIMIT 20)"
             for t, c, d in (("u", "acquisition_channel", config.ACQUISITION_CHANNELS), ("u", "device_type", config.DEVICE_TYPES),
                             ("e", "event_name", config.ALL_EVENT_NAMES), ("e", "event_source", config.EVENT_SOURCES),
                             ("e", "platform", config.PLATFORMS))]
    return with_adapter(*_iv_plan_ctes(), *faults.SQL_CTES) + " UNION ALL ".join(parts)


def _dq_parts(freeze: str, order: str) -> tuple[list[str], str]:
    """The extra CTEs and the report rows over u, e, a, lb and iv."""
    users_constraint = " OR ".join(["user_id IS NULL", "signup_timestamp IS NULL",
                                    _in("acquisition_channel", config.ACQUISITION_CHANNELS),
                                    _in("device_type", config.DEVICE_TYPES),
                                    _in("user_intent_level", config.USER_INTENT_LEVELS),
                                    _in("career_stage", config.CAREER_STAGES), "marketing_consent IS NULL"])
    dup = "(SELECT count(*) - count(DISTINCT {c}) - CAST(coalesce(bool_or({c} IS NULL), FALSE) AS INTEGER) FROM {t})"
    props = "(SELECT count(*) FILTER (WHERE event_properties IS NULL) FROM e)"
    props_share = "(SELECT count(*) FILTER (WHERE event_properties IS NULL) / count(*) FROM e)"
    camp = "(SELECT count(*) FILTER (WHERE event_source = 'campaign') FROM e)"
    camp_share = "(SELECT count(*) FILTER (WHERE event_source = 'campaign') / count(*) FROM e)"
    alloc = ", ".join(f"('{n}', CAST({a!r} AS DOUBLE))" for n, a in config.ONBOARDING_VARIANTS)
    rows = [
        _dq_row("users_columns", "error", "0", "all required columns present"),
        _dq_row("events_columns", "error", "0", "all required columns present"),
        _dq_domain("acquisition_channel_domain", "u", "acquisition_channel", config.ACQUISITION_CHANNELS),
        _dq_domain("device_type_domain", "u", "device_type", config.DEVICE_TYPES),
        _dq_row("unique_user_ids", "error", dup.format(c="user_id", t="u"), "duplicate user_id rows"),
        _dq_row("user_row_constraints", "error", f"(SELECT count(*) FILTER (WHERE {users_constraint}) FROM u)",
                "users rows violating declared types/domains"),
        _dq_row("observation_window", "error",
                f"(SELECT CAST(coalesce(max(signup_timestamp) + INTERVAL {config.LABEL_WINDOW_END_DAY} DAY "
                f"> {freeze}, FALSE) AS INTEGER) FROM u)",
                "latest signup + label window beyond data freeze"),
        _dq_domain("event_name_domain", "e", "event_name", config.ALL_EVENT_NAMES),
        _dq_domain("event_source_domain", "e", "event_source", config.EVENT_SOURCES),
        _dq_domain("platform_domain", "e", "platform", config.PLATFORMS, "warning"),
        _dq_row("unique_event_ids", "error", dup.format(c="event_id", t="e"), "duplicate event_id rows"),
        _dq_row("event_properties_missing_rate", "warning", props, "share of null event_properties",
                passed=f"NOT coalesce({props_share} > {config.EVENT_PROPERTIES_MISSING_MAX}, FALSE)", value=props_share),
        _dq_row("campaign_event_share", "warning", camp, "share of campaign events",
                passed=f"NOT coalesce({camp_share} > {config.CAMPAIGN_SHARE_MAX}, FALSE)", value=camp_share),
        _dq_orphans("event_foreign_keys", "e", "u"),
        _dq_orphans("experiment_foreign_keys", "a", "u"),
        _dq_orphans("users_missing_assignment", "u", "a"),
        _dq_orphans("users_with_events", "u", "e"),
        _dq_row("event_after_signup", "error",
                "(SELECT count(*) FROM e JOIN u ON e.user_id = u.user_id WHERE e.event_timestamp < u.signup_timestamp)",
                "events earlier than their user''s signup"),
        f"SELECT 'srm_' || coalesce(experiment_id, 'null'), 'error', p >= {config.SRM_ALPHA} AND unknown IS NULL, "
        f"CAST(coalesce(unknown, 0) AS BIGINT), round(p, {R}), "
        f"'chi-square p-value vs configured allocation; violations = rows of unknown variants' FROM srm",
        _dq_row("traffic_allocation_range", "warning",
                "(SELECT count(*) FILTER (WHERE traffic_allocation IS NULL OR traffic_allocation NOT BETWEEN 0 AND 1) FROM a)",
                "allocation outside [0, 1]"),
        _dq_row("churn_rate_range", "error",
                f"(SELECT CAST(NOT coalesce(avg(is_churned) BETWEEN {config.CHURN_RATE_RANGE[0]} AND "
                f"{config.CHURN_RATE_RANGE[1]}, FALSE) AS INTEGER) FROM lb)", "mean is_churned",
                passed=f"(SELECT coalesce(avg(is_churned) BETWEEN {config.CHURN_RATE_RANGE[0]} AND "
                       f"{config.CHURN_RATE_RANGE[1]}, FALSE) FROM lb)",
                value="(SELECT avg(CAST(is_churned AS DOUBLE)) FROM lb)"),
        _dq_row("label_user_set", "error",
                "(SELECT count(*) FROM (SELECT DISTINCT user_id FROM lb) x WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.user_id = x.user_id))"
                " + (SELECT count(*) FROM (SELECT DISTINCT user_id FROM u) x WHERE NOT EXISTS (SELECT 1 FROM lb WHERE lb.user_id = x.user_id))",
                "label ids not in users plus users without a label"),
    ]
    rows += [_dq_orphans("intervention_foreign_keys", "iv", "u"),
             _dq_domain("intervention_channel_domain", "iv", "channel", config.INTERVENTION_CHANNELS, "warning"),
             _dq_row("session_timestamp_order", "warning",
                     "(SELECT count(DISTINCT session_id) FROM (SELECT session_id, event_timestamp < "
                     f"lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY {order}) AS dec FROM e "
                     "WHERE session_id IS NOT NULL) WHERE dec)", "sessions with out-of-order timestamps")]
    srm = (f"al AS (SELECT * FROM (VALUES {alloc}) t(variant_id, allocation)), "
           "oc AS (SELECT experiment_id, variant_id, count(*) AS o FROM a GROUP BY experiment_id, variant_id), "
           "pe AS (SELECT experiment_id, sum(o) AS n, sum(CASE WHEN variant_id IS NULL OR variant_id NOT IN (SELECT variant_id FROM al) THEN o END) "
           "AS unknown FROM oc GROUP BY experiment_id), "
           "chi AS (SELECT pe.experiment_id, pe.unknown, sum((coalesce(oc.o, 0) - al.allocation * pe.n) ^ 2 / (al.allocation * pe.n)) AS chi2 "
           "FROM pe CROSS JOIN al LEFT JOIN oc ON oc.experiment_id = pe.experiment_id AND oc.variant_id = al.variant_id "
           "GROUP BY pe.experiment_id, pe.unknown), "
           "srm AS (SELECT experiment_id, unknown, exp(-chi2 / 2) AS p FROM chi)")
    return [srm], "\nUNION ALL\n".join(rows)


def dq_passed_sql() -> str:
    report = dq_report_sql()
    return (f"SELECT coalesce(bool_and(passed) FILTER (WHERE severity = 'error'), TRUE) AS passed, "
            f"count(*) FILTER (WHERE severity = 'error' AND NOT passed) AS errors, "
            f"count(*) FILTER (WHERE severity = 'warning' AND NOT passed) AS warnings FROM ({report}) r")


# ---------------------------------------------------------------- features (FE / LB4) ---------

def _features_ctes(cutoff_day: int = config.PREDICTION_CUTOFF_DAY, sent_source: str = "system") -> list[str]:
    core = [e for e in config.CORE_EVENTS if e != "signup"]
    act = "event_source = 'user_action'"
    flags = ", ".join(f"max(CASE WHEN {act} AND event_name = '{e}' THEN 1 ELSE 0 END) AS {e}" for e in core)
    sent = {"num_email_sent": "email_sent", "num_push_sent": "push_sent", "num_in_app_sent": "in_app_message_sent"}
    counted = {"ai_assistant_interaction_count": "ai_assistant_interaction",
               "job_detail_view_count": "job_detail_view", "return_visit_count": "return_visit"}
    aggs = [flags,
            "count(*) FILTER (WHERE event_name = 'session_start') AS num_sessions",
            f"count(*) FILTER (WHERE {act}) AS num_user_actions",
            f"count(DISTINCT CASE WHEN {act} THEN CAST(event_timestamp AS DATE) END) AS num_days_active",
            *[f"count(*) FILTER (WHERE event_source = '{sent_source}' AND event_name = '{e}') AS {k}" for k, e in sent.items()],
            f"count(*) FILTER (WHERE {act} AND session_id IS NOT NULL) AS total_user_actions_in_sessions",
            "count(DISTINCT event_name) AS unique_event_type_count",
            "count(*) FILTER (WHERE event_timestamp < signup_timestamp + INTERVAL 1 DAY) AS first_day_event_count",
            "count(*) FILTER (WHERE event_timestamp >= cutoff - INTERVAL 2 DAY) AS last_2_days_event_count",
            f"min(CASE WHEN {act} THEN event_timestamp END) AS first_act",
            f"max(CASE WHEN {act} THEN event_timestamp END) AS last_act",
            "max(signup_timestamp) AS s_ts", "max(cutoff) AS c_ts",
            *[f"count(*) FILTER (WHERE event_name = '{e}') AS {k}" for k, e in counted.items()]]
    return [
        f"uc AS (SELECT user_id, signup_timestamp, signup_timestamp + INTERVAL {cutoff_day} DAY AS cutoff FROM u)",
        "pre AS (SELECT e.user_id, e.session_id, e.event_name, e.event_timestamp, e.event_source, uc.signup_timestamp, "
        "uc.cutoff FROM e JOIN uc ON e.user_id = uc.user_id WHERE e.event_timestamp < uc.cutoff)",
        f"pu AS (SELECT user_id, {', '.join(aggs)} FROM pre GROUP BY user_id)",
        "ss AS (SELECT user_id, avg(n) AS avg_s, max(n) AS max_s FROM (SELECT user_id, session_id, count(*) AS n "
        "FROM pre WHERE session_id IS NOT NULL GROUP BY user_id, session_id) GROUP BY user_id)",
        f"va AS (SELECT user_id, variant_id FROM a WHERE experiment_id = '{EXP}')",
        "fm AS (SELECT u.user_id, u.signup_timestamp, u.acquisition_channel, u.country, u.device_type, "
        "u.user_intent_level, u.career_stage, coalesce(va.variant_id, 'unknown') AS onboarding_variant, "
        "u.language, u.timezone, "
        "CAST(hour(u.signup_timestamp) AS DOUBLE) AS signup_hour, "
        "CAST(isodow(u.signup_timestamp) - 1 AS DOUBLE) AS signup_day_of_week, "
        "CAST(coalesce(CAST(u.marketing_consent AS INTEGER), 0) AS DOUBLE) AS marketing_consent, "
        "CAST(coalesce(pu.onboarding_start, 0) AS DOUBLE) AS onboarding_started, "
        + ", ".join(f"CAST(coalesce(pu.{e}, 0) AS DOUBLE) AS {e}" for e in core if e != "onboarding_start") + ", "
        "CAST(coalesce(" + " + ".join(f"pu.{e}" for e in core) + ", 0) AS DOUBLE) AS num_core_actions_completed, "
        + ", ".join(f"CAST(coalesce(pu.{c}, 0) AS DOUBLE) AS {c}" for c in
                    ["num_sessions", "num_user_actions", "num_days_active", *sent]) + ", "
        "CAST(CASE WHEN coalesce(pu.num_sessions, 0) > 0 THEN coalesce(ss.avg_s, 0) ELSE 0 END AS DOUBLE) AS avg_events_per_session, "
        "CAST(CASE WHEN coalesce(pu.num_sessions, 0) > 0 THEN coalesce(ss.max_s, 0) ELSE 0 END AS DOUBLE) AS max_events_in_session, "
        + ", ".join(f"CAST(coalesce(pu.{c}, 0) AS DOUBLE) AS {c}" for c in
                    ["total_user_actions_in_sessions", "unique_event_type_count", "first_day_event_count",
                     "last_2_days_event_count"]) + ", "
        "(epoch_us(pu.first_act) - epoch_us(pu.s_ts)) / 3600000000.0 AS hours_to_first_action, "
        "(epoch_us(pu.c_ts) - epoch_us(pu.last_act)) / 3600000000.0 AS hours_since_last_action_at_cutoff, "
        + ", ".join(f"CAST(coalesce(pu.{c}, 0) AS DOUBLE) AS {c}" for c in counted) +
        " FROM u LEFT JOIN pu ON u.user_id = pu.user_id LEFT JOIN ss ON u.user_id = ss.user_id "
        "LEFT JOIN va ON u.user_id = va.user_id)",
    ]


def features_sql(columns: list[str] | None = None) -> str:
    cols = ", ".join(["user_id"] + [f"round({c}, {R}) AS {c}" if c in config.NUMERIC_FEATURES else c
                                    for c in (columns or [])])
    if columns is None:
        cols = "user_id, signup_timestamp, " + ", ".join(
            config.CATEGORICAL_FEATURES + [f"round({c}, {R}) AS {c}" for c in config.NUMERIC_FEATURES])
    return with_adapter(*_features_ctes()) + f"SELECT {cols} FROM fm"


def model_matrix_sql() -> str:
    cols = "fm.user_id, fm.signup_timestamp, " + ", ".join(
        [f"fm.{c}" for c in config.CATEGORICAL_FEATURES] + [f"round(fm.{c}, {R}) AS {c}" for c in config.NUMERIC_FEATURES])
    return with_adapter(*_features_ctes()) + f"SELECT {cols}, lb.is_churned FROM fm JOIN lb ON fm.user_id = lb.user_id"


# ---------------------------------------------------------------- decisions (NB / IV) ---------

def _state_ctes(cutoff_day: int = config.PREDICTION_CUTOFF_DAY) -> list[str]:
    flags = ", ".join(f"bool_or(e.event_name = '{ev}') AS {f}" for f, ev in config.STATE_EVENTS.items())
    return [
        f"cu_ AS (SELECT user_id, marketing_consent, signup_timestamp + INTERVAL {cutoff_day} DAY AS cutoff FROM u)",
        f"st0 AS (SELECT e.user_id, {flags}, bool_or(e.event_timestamp >= cu_.cutoff - INTERVAL 2 DAY) AS recently_active "
        "FROM e JOIN cu_ ON e.user_id = cu_.user_id WHERE e.event_source = 'user_action' AND e.event_timestamp <= cu_.cutoff "
        "GROUP BY e.user_id)",
        "st AS (SELECT cu_.user_id, coalesce(cu_.marketing_consent, FALSE) AS consent, "
        + ", ".join(f"coalesce(st0.{f}, FALSE) AS {f}" for f in [*config.STATE_EVENTS, "recently_active"])
        + " FROM cu_ LEFT JOIN st0 ON cu_.user_id = st0.user_id)",
    ]


def user_state_sql() -> str:
    return with_adapter(*_state_ctes()) + "SELECT user_id, " + ", ".join([*config.STATE_EVENTS, "recently_active"]) + " FROM st"


def _nba_case(field: str, score: str | None = None) -> str:
    heuristic = "(onboarding_completed AND NOT recently_active)"
    high = heuristic if score is None else (
        f"(CASE WHEN {score} IS NULL THEN {heuristic} WHEN isnan({score}) THEN FALSE "
        f"ELSE {score} >= {config.HIGH_RISK_ACTION_THRESHOLD} END)")
    done_action, done_reason = config.NBA_DONE
    vals = {
        "action_name": (f"'{config.NBA_REENGAGE}'", [f"'{a}'" for _, a, _ in config.NBA_STEP_RULES], f"'{done_action}'"),
        "channel": ("CASE WHEN consent THEN 'email' ELSE 'in_app' END", ["'in_app'"] * len(config.NBA_STEP_RULES),
                    "CASE WHEN consent THEN 'email' ELSE 'in_app' END"),
        "reason": (f"CASE WHEN consent THEN '{config.NBA_REASON_HIGH_RISK_CONSENT}' ELSE "
                   f"'{config.NBA_REASON_HIGH_RISK_NO_CONSENT}' END", [f"'{r}'" for _, _, r in config.NBA_STEP_RULES],
                   f"'{done_reason}'"),
    }[field]
    whens = [f"WHEN {high} THEN {vals[0]}"]
    whens += [f"WHEN NOT {flag} THEN {v}" for (flag, _, _), v in zip(config.NBA_STEP_RULES, vals[1])]
    return "CASE " + " ".join(whens) + f" ELSE {vals[2]} END"


def next_best_action_sql(scored: bool = False) -> str:
    score = "score" if scored else None
    cases = ", ".join(f"{_nba_case(c, score)} AS {c}" for c in ("action_name", "channel", "reason"))
    if not scored:
        return with_adapter(*_state_ctes()) + f"SELECT user_id, {cases} FROM st"
    return with_adapter(*_scored_ctes(), *_state_ctes()) + (
        f"SELECT user_id, {cases} FROM (SELECT st.*, sc.prob AS score FROM st LEFT JOIN sc ON st.user_id = sc.user_id) x")


def model_roundtrip_sql() -> str:
    """A reloaded model scores every test user as before."""
    return with_adapter(_split_cte()) + (
        "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatches FROM lb JOIN sp ON lb.user_id = sp.user_id WHERE sp.split = 'test'")


def preprocessed_sql() -> str:
    cats = " UNION ALL ".join(
        f"SELECT user_id, 'cat__{c}_' || CASE WHEN count(*) OVER (PARTITION BY {c}) >= {config.RARE_CATEGORY_FRACTION} * count(*) OVER () "
        f"THEN coalesce(CAST({c} AS VARCHAR), 'None') ELSE 'infrequent_sklearn' END AS feature, 1.0 AS value FROM tr"
        for c in config.CATEGORICAL_FEATURES)
    nums = " UNION ALL ".join(
        f"SELECT user_id, 'num__{c}' AS feature, (v - avg(v) OVER ()) / CASE WHEN stddev_pop(v) OVER () > 0 THEN stddev_pop(v) OVER () ELSE 1.0 END AS value "
        f"FROM (SELECT user_id, coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0) FROM tr)) AS v FROM tr)"
        for c in config.NUMERIC_FEATURES)
    return with_adapter(*_features_ctes(), _split_cte(),
                        "tr AS (SELECT fm.* FROM fm JOIN lb ON fm.user_id = lb.user_id JOIN sp ON fm.user_id = sp.user_id WHERE sp.split = 'train')") + (
        f"SELECT user_id, feature, round(value, {R}) AS value FROM ({cats} UNION ALL {nums})")


def _descent(name: str, start: str, bounded: bool, steps: int) -> list[str]:
    """Steps against the gradient by the inverse curvature at ``start`` (or by a quarter of the weighted
    moments, which no curvature exceeds, as the sigmoid's slope is at most 1/4); the last one is
    ``<name>_w``. The penalty is 1 on every slot but the constant."""
    slope = "25e-2" if bounded else "p[i] * (1 - p[i])"
    margin = "1 / (1 + exp(-list_dot_product({x}, {w})))"
    return [
        f"{name}_s AS MATERIALIZED (SELECT {start} AS w)",
        f"{name}_p AS MATERIALIZED (SELECT d.*, [{margin.format(x='r', w='s.w')} FOR r IN d.xs] AS p FROM dac d, {name}_s s)",
        f"{name}_b AS (SELECT k, [[list_dot_product([c[i] * {slope} * cols[a][i] FOR i IN range(1, len(c) + 1)], cols[b]) + CASE WHEN a = b AND a < k THEN 1e0 ELSE 0e0 END "
        f"FOR b IN range(1, k + 1)] || [CASE WHEN a = b THEN 1e0 ELSE 0e0 END FOR b IN range(1, k + 1)] FOR a IN range(1, k + 1)] AS m FROM {name}_p)",
        f"{name}_g AS (SELECT 1 AS t, k, m FROM {name}_b UNION ALL SELECT t + 1, k, [CASE WHEN i = t THEN [v / m[t][t] FOR v IN m[t]] "
        f"ELSE [m[i][j] - m[i][t] / m[t][t] * m[t][j] FOR j IN range(1, 2 * k + 1)] END FOR i IN range(1, k + 1)] FROM {name}_g WHERE t <= k)",
        f"{name}_i AS MATERIALIZED (SELECT [r[k + 1:2 * k] FOR r IN m] AS b FROM {name}_g WHERE t = k + 1)",
        f"{name}_t AS (SELECT 0 AS t, w FROM {name}_s UNION ALL SELECT t + 1, [w[a] + list_dot_product(b[a], g) FOR a IN range(1, k + 1)] FROM ("
        "SELECT t, w, k, b, [list_dot_product(cols[a], r) - CASE WHEN a < k THEN w[a] ELSE 0e0 END FOR a IN range(1, k + 1)] AS g FROM ("
        f"SELECT z.t, z.w, d.k, d.cols, v.b, [d.c[i] * (d.y[i] - {margin.format(x='d.xs[i]', w='z.w')}) FOR i IN range(1, len(d.c) + 1)] AS r "
        f"FROM {name}_t z, dac d, {name}_i v WHERE z.t < {steps})))",
        f"{name}_w AS MATERIALIZED (SELECT w FROM {name}_t WHERE t = {steps})",
    ]


def _linear_ctes() -> list[str]:
    """The logistic model fitted in SQL, as a check of the engine's own fit: ``xs`` (user_id, x: the
    slots in the order of ``slots`` and a 1) and ``model`` (w). The objective is strictly convex, so both
    fits have one limit. Steps with a bound of the curvature come near it, steps with the curvature
    there reach it."""
    weighted = [f"SELECT 'cat__{c}_' AS prefix, '{c}' AS col, CAST({c} AS VARCHAR) AS val, user_id FROM fm" for c in config.CATEGORICAL_FEATURES]
    numbers = ", ".join(f"('{c}', CAST({c} AS DOUBLE))" for c in config.NUMERIC_FEATURES)
    return [
        *_features_ctes(), _split_cte(),
        "tru AS (SELECT lb.user_id, CAST(lb.is_churned AS DOUBLE) AS y FROM lb JOIN fm ON fm.user_id = lb.user_id JOIN sp ON sp.user_id = lb.user_id WHERE sp.split = 'train')",
        f"cv AS ({' UNION ALL '.join(weighted)})",
        f"lev AS (SELECT col, val, count(*) >= {config.RARE_CATEGORY_FRACTION} * (SELECT count(*) FROM tru) AS often FROM cv SEMI JOIN tru ON cv.user_id = tru.user_id GROUP BY col, val)",
        "rare AS (SELECT DISTINCT col FROM lev WHERE NOT often)",
        "cl AS (SELECT cv.user_id, cv.prefix || CASE WHEN lev.often THEN coalesce(cv.val, 'None') ELSE 'infrequent_sklearn' END AS feature, 1e0 AS value FROM cv "
        "LEFT JOIN lev ON lev.col = cv.col AND lev.val IS NOT DISTINCT FROM cv.val LEFT JOIN rare ON rare.col = cv.col "
        "WHERE coalesce(lev.often, false) OR rare.col IS NOT NULL)",
        f"nv AS (SELECT user_id, n.col, n.v FROM fm CROSS JOIN LATERAL (VALUES {numbers}) n(col, v))",
        "nm AS (SELECT col, coalesce(quantile_cont(v, 0.5), 0e0) AS med FROM nv SEMI JOIN tru ON nv.user_id = tru.user_id GROUP BY col)",
        "ns AS (SELECT col, any_value(med) AS med, avg(coalesce(v, med)) AS mean, CASE WHEN stddev_pop(coalesce(v, med)) > 0 THEN stddev_pop(coalesce(v, med)) ELSE 1e0 END AS scale "
        "FROM nv JOIN nm USING (col) SEMI JOIN tru ON nv.user_id = tru.user_id GROUP BY col)",
        "sl AS (SELECT user_id, feature, value FROM cl UNION ALL SELECT user_id, 'num__' || col, (coalesce(v, med) - mean) / scale FROM nv JOIN ns USING (col))",
        "slots AS MATERIALIZED (SELECT feature, row_number() OVER (ORDER BY feature) AS i FROM (SELECT DISTINCT feature FROM sl SEMI JOIN tru ON sl.user_id = tru.user_id))",
        "xs AS MATERIALIZED (SELECT f.user_id, list_append(list(coalesce(sl.value, 0e0) ORDER BY s.i), 1e0) AS x FROM (SELECT user_id FROM fm) f CROSS JOIN slots s "
        "LEFT JOIN sl ON sl.user_id = f.user_id AND sl.feature = s.feature GROUP BY f.user_id)",
        "cw AS (SELECT y, (SELECT count(*) FROM tru) / (2e0 * count(*)) AS c FROM tru GROUP BY y)",
        "dat AS MATERIALIZED (SELECT list(x ORDER BY user_id) AS xs, list(y ORDER BY user_id) AS y, list(c ORDER BY user_id) AS c, len(any_value(x)) AS k FROM xs JOIN tru USING (user_id) JOIN cw USING (y))",
        "dac AS MATERIALIZED (SELECT *, [[r[j] FOR r IN xs] FOR j IN range(1, k + 1)] AS cols FROM dat)",
        *_descent("m", f"[0e0 FOR j IN range(1, (SELECT k FROM dac) + 1)]", bounded=True, steps=400),
        *_descent("n", "(SELECT w FROM m_w)", bounded=False, steps=30),
        "model AS MATERIALIZED (SELECT w FROM n_w)",
    ]


SIGMOID = "1 / (1 + exp(-list_dot_product(x, w)))"


def _linear(select: str, *ctes: str) -> str:
    return with_adapter(*_linear_ctes(), *ctes, recursive=True) + select


def lr_scores_sql() -> str:
    return _linear(f"SELECT user_id, lb.is_churned, round({SIGMOID}, {R}) AS prob FROM xs CROSS JOIN model JOIN lb USING (user_id) JOIN sp USING (user_id) WHERE sp.split = 'test'")


def lr_coefficients_sql() -> str:
    return _linear(f"SELECT feature, round(w[i], {R}) AS coefficient, round(abs(w[i]), {R}) AS abs_coefficient FROM slots CROSS JOIN model")


def linear_model_sql() -> str:
    return _linear(f"SELECT feature, round(med, {R}) AS fill, round(coalesce(mean, 0e0), {R}) AS mean, round(coalesce(scale, 1e0), {R}) AS scale, round(w[i], {R}) AS weight "
                   "FROM slots CROSS JOIN model LEFT JOIN ns ON feature = 'num__' || col UNION ALL "
                   f"SELECT 'constant', NULL, 0e0, 1e0, round(w[len(w)], {R}) FROM model")


def linear_contributions_sql() -> str:
    return _linear(f"SELECT user_id, feature, round(value * w[i], {R}) AS contribution FROM sl JOIN slots USING (feature) CROSS JOIN model")


def user_factors_sql(top_n: int = 5) -> str:
    numbers = ", ".join(f"'num__{c}'" for c in config.NUMERIC_FEATURES)
    # equal contributions (of equal columns) follow the order of the slots, the negative ones backwards
    return _linear(
        f"SELECT user_id, direction, CAST(r AS INTEGER) AS rank, feature, round(c, {R}) AS contribution FROM ("
        "SELECT *, row_number() OVER (PARTITION BY user_id, direction ORDER BY round(abs(c), 9) DESC, CASE WHEN c > 0 THEN p ELSE -p END) AS r "
        f"FROM (SELECT user_id, feature, value * w[i] AS c, CASE WHEN value * w[i] > 0 THEN 'positive' ELSE 'negative' END AS direction, "
        f"coalesce(1000 + list_position([{numbers}], feature), i) AS p FROM sl JOIN slots USING (feature) CROSS JOIN model) WHERE c <> 0) WHERE r <= {top_n}")


def _linear_decisions(select: str) -> str:
    cases = ", ".join(f"{_nba_case(c, 'score')} AS {c}" for c in ("action_name", "channel", "reason"))
    return _linear(
        select,
        f"pr AS (SELECT user_id, {SIGMOID} AS prob FROM xs CROSS JOIN model)",
        "sc AS (SELECT pr.user_id, pr.prob, lb.is_churned AS label FROM pr JOIN lb USING (user_id) JOIN sp USING (user_id) WHERE sp.split = 'validation')",
        "tot AS (SELECT CAST(sum(label) AS BIGINT) AS P, CAST(sum(1 - label) AS BIGINT) AS N FROM sc)",
        *sweep_ctes(), "th AS (SELECT t AS threshold FROM sw2 ORDER BY f1 DESC, t LIMIT 1)", *_state_ctes(),
        f"nb AS (SELECT user_id, score, {cases} FROM (SELECT st.*, pr.prob AS score FROM st JOIN pr ON st.user_id = pr.user_id) x)",
        f"de AS (SELECT user_id, round(score, {R}) AS predicted_risk, CAST(score >= threshold AS INTEGER) AS predicted_class, action_name, channel, reason FROM nb CROSS JOIN th)")


def linear_decisions_sql() -> str:
    return _linear_decisions("SELECT * FROM de")


def linear_examples_sql(n: int = 10) -> str:
    return _linear_decisions(
        "SELECT * EXCLUDE (r) FROM (SELECT de.*, row_number() OVER (PARTITION BY predicted_class ORDER BY sp.signup_timestamp, user_id) AS r FROM de JOIN sp USING (user_id) "
        f"SEMI JOIN lb USING (user_id) WHERE sp.split = 'test') WHERE r <= {n // 2}")


def _iv_ctes(cutoff_day: int = config.PREDICTION_CUTOFF_DAY) -> list[str]:
    return [
        "fw0 AS (SELECT e.user_id, count(DISTINCT CASE WHEN d BETWEEN 0 AND {c} THEN d END) AS active_days_first_week, "
        "bool_or(e.event_name = 'onboarding_complete') AS onboarding_done FROM (SELECT e.*, "
        "floor((epoch_us(e.event_timestamp) - epoch_us(u.signup_timestamp)) / 86400000000.0) AS d "
        "FROM e JOIN u ON e.user_id = u.user_id WHERE e.event_source = 'user_action') e GROUP BY e.user_id)".format(c=cutoff_day),
        "fw AS (SELECT u.user_id, u.signup_timestamp, coalesce(u.marketing_consent, FALSE) AS consent, "
        "CAST(coalesce(fw0.active_days_first_week, 0) AS BIGINT) AS active_days_first_week, "
        "coalesce(fw0.onboarding_done, FALSE) AS onboarding_done FROM u LEFT JOIN fw0 ON u.user_id = fw0.user_id)",
    ]


def first_week_activity_sql() -> str:
    return with_adapter(*_iv_ctes()) + "SELECT user_id, active_days_first_week, onboarding_done FROM fw"


def _iv_plan_ctes(seed: int = config.RANDOM_SEED) -> list[str]:
    rules = [("NOT onboarding_done", config.IV_ONBOARDING), ("active_days_first_week <= 1", config.IV_REENGAGE),
             ("coalesce(lb.is_churned, 0) = 1", config.IV_WIN_BACK)]

    def channel(action, options):
        idx = _md5_bucket(f"CAST(fw.user_id AS VARCHAR) || ':' || '{action}' || ':' || '{seed}'", len(options))
        arr = "[" + ", ".join(f"'{o}'" for o in options) + "]"
        return f"CASE WHEN consent THEN {arr}[{idx} + 1] ELSE 'in_app' END"

    act = "CASE " + " ".join(f"WHEN {c} THEN '{a}'" for c, (a, _, _) in rules) + " END"
    send = "CASE " + " ".join(f"WHEN {c} THEN fw.signup_timestamp + INTERVAL {d} DAY" for c, (_, d, _) in rules) + " END"
    chan = "CASE " + " ".join(f"WHEN {c} THEN {channel(a, o)}" for c, (a, _, o) in rules) + " END"
    return [*_iv_ctes(), (
        f"iv AS (SELECT md5('intervention-{seed}-' || CAST(user_id AS VARCHAR) || '-' || action_name) AS message_id, "
        "user_id, action_name, channel, send_time, CAST(NULL AS TIMESTAMP) AS open_time, CAST(NULL AS TIMESTAMP) AS "
        "click_time, CAST(NULL AS TIMESTAMP) AS conversion_time, CAST(NULL AS VARCHAR) AS experiment_id FROM ("
        f"SELECT fw.user_id, {act} AS action_name, {chan} AS channel, {send} AS send_time "
        "FROM fw LEFT JOIN lb ON fw.user_id = lb.user_id) WHERE action_name IS NOT NULL)")]


def intervention_plan_sql(seed: int = config.RANDOM_SEED) -> str:
    return with_adapter(*_iv_plan_ctes(seed)) + "SELECT * FROM iv"


# ---------------------------------------------------------------- split / evaluation ----------

def _linspace(n: int) -> list[float]:
    from cohortlens.operators.evaluate import linspace

    return linspace(n)


def _split_cte(train_frac: float = 0.6, val_frac: float = 0.2) -> str:
    return ("sp AS (SELECT user_id, signup_timestamp, CASE "
            f"WHEN r <= floor(n * CAST({train_frac!r} AS DOUBLE)) THEN 'train' "
            f"WHEN r <= floor(n * CAST({train_frac!r} AS DOUBLE)) + floor(n * CAST({val_frac!r} AS DOUBLE)) THEN 'validation' "
            "ELSE 'test' END AS split FROM (SELECT user_id, signup_timestamp, "
            "row_number() OVER (ORDER BY signup_timestamp, user_id) AS r, count(*) OVER () AS n FROM u))")


def split_sql() -> str:
    return with_adapter(_split_cte()) + "SELECT user_id, signup_timestamp, split FROM sp"


def split_report_sql() -> str:
    return with_adapter(_split_cte(), *_features_ctes()) + (
        "SELECT sp.split, min(fm.signup_timestamp) AS signup_min, max(fm.signup_timestamp) AS signup_max, "
        f"count(*) AS rows, round(avg(CAST(lb.is_churned AS DOUBLE)), {R}) AS churn_rate "
        "FROM fm JOIN lb ON fm.user_id = lb.user_id JOIN sp ON fm.user_id = sp.user_id GROUP BY sp.split")


def _scored_ctes() -> list[str]:
    return [*_features_ctes(),
            "sc AS (SELECT fm.user_id, lb.is_churned AS label, "
            "coalesce(fm.hours_since_last_action_at_cutoff / 168, 1.0) AS prob, "
            "fm.acquisition_channel, fm.career_stage, fm.device_type FROM fm JOIN lb ON fm.user_id = lb.user_id)",
            "tot AS (SELECT CAST(sum(label) AS BIGINT) AS P, CAST(sum(1 - label) AS BIGINT) AS N FROM sc)",
            "ps AS (SELECT prob, CAST(sum(label) AS BIGINT) AS tp, CAST(sum(1 - label) AS BIGINT) AS fp FROM sc GROUP BY prob)",
            "cu AS (SELECT ps.*, sum(tp) OVER (ORDER BY prob DESC) AS cum_tp, sum(fp) OVER (ORDER BY prob DESC) AS cum_fp, "
            "tot.P, tot.N FROM ps, tot)"]


def scored_sql() -> str:
    return with_adapter(*_scored_ctes()) + f"SELECT user_id, label, round(prob, {R}) AS prob FROM sc"


def _cm(t: float) -> str:
    return (f"cm AS (SELECT count(*) FILTER (WHERE prob < {t!r} AND label = 0) AS tn, "
            f"count(*) FILTER (WHERE prob >= {t!r} AND label = 0) AS fp, "
            f"count(*) FILTER (WHERE prob < {t!r} AND label = 1) AS fn, "
            f"count(*) FILTER (WHERE prob >= {t!r} AND label = 1) AS tp FROM sc)")


def _div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END)"


def confusion_sql(t: float = 0.5) -> str:
    return with_adapter(*_scored_ctes(), _cm(t)) + (
        "SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive FROM cm")


def _metric_parts(t: float) -> str:
    eps = 2.220446049250313e-16
    p = f"least(greatest(prob, {eps!r}), {1.0 - eps!r})"
    return (
        "SELECT (SELECT CASE WHEN max(P) > 0 THEN sum(CAST(tp AS DOUBLE) / P * (CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp))) END FROM cu) AS pr_auc, "
        "(SELECT CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(fp * (cum_tp - tp / 2.0)) / (max(P) * max(N)) END FROM cu) AS roc_auc, "
        f"(SELECT -avg(CASE WHEN label = 1 THEN ln({p}) ELSE ln(1.0 - {p}) END) FROM sc) AS log_loss, "
        "(SELECT avg((prob - label) ^ 2) FROM sc) AS brier_score, "
        f"CAST({t!r} AS DOUBLE) AS threshold, "
        f"(SELECT {_div('tp', 'tp + fp')} FROM cm) AS precision, (SELECT {_div('tp', 'tp + fn')} FROM cm) AS recall, "
        f"(SELECT {_div('2.0 * tp', '(tp + fn) + (tp + fp)')} FROM cm) AS f1_score, "
        f"(SELECT {_div('tp + tn', 'tp + tn + fp + fn')} FROM cm) AS accuracy")


def metrics_sql(columns: list[str], t: float = 0.5) -> str:
    cols = ", ".join(f"round({c}, {R}) AS {c}" for c in columns)
    return with_adapter(*_scored_ctes(), _cm(t)) + f"SELECT {cols} FROM ({_metric_parts(t)})"


def sweep_ctes(n: int = 101) -> list[str]:
    return [f"gr AS (SELECT CAST(i AS INTEGER) AS k, CASE WHEN i >= {n - 1} THEN 1.0 ELSE CAST(i AS DOUBLE) * "
            f"CAST({1.0 / (n - 1)!r} AS DOUBLE) END AS t FROM range({n}) r(i))",
            "sw AS (SELECT gr.k, gr.t, count(*) FILTER (WHERE sc.prob >= gr.t AND sc.label = 1) AS tp, "
            "count(*) FILTER (WHERE sc.prob >= gr.t AND sc.label = 0) AS fp FROM gr CROSS JOIN sc GROUP BY gr.k, gr.t)",
            "sw2 AS (SELECT sw.*, tot.P - tp AS fn, tot.N - fp AS tn, "
            f"{_div('CAST(tp AS DOUBLE)', 'tp + fp')} AS precision, {_div('CAST(tp AS DOUBLE)', 'tot.P')} AS recall, "
            f"{_div('2.0 * tp', 'tot.P + tp + fp')} AS f1, {_div('5.0 * tp', '4 * tot.P + tp + fp')} AS f2 FROM sw, tot)"]


def sweep_sql(n: int = 101) -> str:
    return with_adapter(*_scored_ctes(), *sweep_ctes(n)) + (
        f"SELECT k AS threshold_index, round(t, {R}) AS threshold, tp, fp, fn, tn, round(precision, {R}) AS precision, "
        f"round(recall, {R}) AS recall, round(f1, {R}) AS f1, round(f2, {R}) AS f2 FROM sw2")


def select_threshold_sql(criterion: str = "f1", n: int = 101) -> str:
    return with_adapter(*_scored_ctes(), *sweep_ctes(n)) + (
        f"SELECT '{criterion}' AS criterion, round(t, {R}) AS threshold, round({criterion}, {R}) AS score "
        f"FROM sw2 ORDER BY {criterion} DESC, t ASC LIMIT 1")


def youden_sql() -> str:
    return with_adapter(*_scored_ctes()) + (
        "SELECT 'youden' AS criterion, CASE WHEN j > 0 THEN round(prob, 6) ELSE 'inf'::DOUBLE END AS threshold, "
        f"round(j, {R}) AS score FROM (SELECT prob, CAST(cum_tp AS DOUBLE) / P - CAST(cum_fp AS DOUBLE) / N AS j FROM cu "
        "ORDER BY j DESC, prob DESC LIMIT 1)")


def calibration_sql(n_bins: int = 10, min_count: int = 5) -> str:
    qs = "[" + ", ".join(repr(q) for q in _linspace(n_bins + 1)) + "]"
    return with_adapter(*_scored_ctes(), f"ed AS (SELECT list_sort(list_distinct(quantile_cont(prob, {qs}))) AS edges FROM sc)") + (
        f"SELECT bin, round(avg(prob), {R}) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), {R}) AS mean_observed, "
        "count(*) AS count FROM (SELECT sc.prob, sc.label, CAST(greatest(1, len(list_filter(ed.edges, lambda e: e < sc.prob))) "
        f"AS INTEGER) AS bin FROM sc, ed) GROUP BY bin HAVING count(*) >= {min_count}")


def pr_curve_sql() -> str:
    return with_adapter(*_scored_ctes()) + (
        f"SELECT round(prob, {R}) AS threshold, round({_div('CAST(cum_tp AS DOUBLE)', 'cum_tp + cum_fp')}, {R}) AS precision, "
        f"round({_div('CAST(cum_tp AS DOUBLE)', 'P')}, {R}) AS recall FROM cu UNION ALL SELECT NULL, 1.0, 0.0")


def roc_curve_sql() -> str:
    return with_adapter(*_scored_ctes()) + (
        f"SELECT round(prob, {R}) AS threshold, round({_div('CAST(cum_fp AS DOUBLE)', 'N')}, {R}) AS fpr, "
        f"round({_div('CAST(cum_tp AS DOUBLE)', 'P')}, {R}) AS tpr FROM cu UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0")


def histogram_sql(bins: int = 30) -> str:
    return with_adapter(*_scored_ctes(),
                        "rg AS (SELECT CAST(label AS BIGINT) AS label, CASE WHEN min(prob) = max(prob) THEN min(prob) - 0.5 "
                        "ELSE min(prob) END AS lo, CASE WHEN min(prob) = max(prob) THEN max(prob) + 0.5 ELSE max(prob) END "
                        "AS hi FROM sc GROUP BY label)") + (
        f"SELECT label, bin, count(*) AS count, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / {bins}, {R}) "
        f"AS bin_start, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / {bins}, {R}) AS bin_end FROM "
        f"(SELECT rg.label, rg.lo, rg.hi, least({bins}, CAST(floor((sc.prob - rg.lo) / (rg.hi - rg.lo) * {bins}) AS INTEGER) + 1) "
        "AS bin FROM sc JOIN rg ON sc.label = rg.label) GROUP BY label, bin")


def subgroup_sql(t: float = 0.5, groups=("acquisition_channel", "career_stage", "device_type")) -> str:
    unions = " UNION ALL ".join(f"SELECT '{g}' AS group_column, CAST({g} AS VARCHAR) AS group_value, label, prob FROM sc"
                                for g in groups)
    return with_adapter(*_scored_ctes()) + (
        "SELECT group_column, group_value, count(*) AS sample_size, "
        f"round(count(*) FILTER (WHERE label = 1) / count(*), {R}) AS churn_rate, "
        f"round({_div(f'count(*) FILTER (WHERE label = 1 AND prob >= {t!r})', f'count(*) FILTER (WHERE prob >= {t!r})')}, {R}) AS precision, "
        f"round({_div(f'count(*) FILTER (WHERE label = 1 AND prob >= {t!r})', 'count(*) FILTER (WHERE label = 1)')}, {R}) AS recall, "
        f"round({_div(f'2.0 * count(*) FILTER (WHERE label = 1 AND prob >= {t!r})', f'count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE prob >= {t!r})')}, {R}) AS f1_score, "
        f"round(count(*) FILTER (WHERE prob >= {t!r}) / count(*), {R}) AS predicted_positive_rate, "
        f"count(*) < {config.SMALL_SAMPLE_THRESHOLD} AS small_sample "
        f"FROM ({unions}) WHERE group_value IS NOT NULL GROUP BY group_column, group_value")
