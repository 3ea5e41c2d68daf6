"""Adapter: derive the lifecycle tables from the driver's star-schema parquet files.

The driver ships a generic ``events(event_id, ts, user_id, event_type, value, props)`` log plus
``customer`` / ``nation`` dimensions. They are mapped onto the lifecycle data model lazily, so
every downstream operator reads (and scales with) the given tables:

* entity: the raw user's events with ``props.k % 10`` up to 7 are one busy entity, those with 8 and
  9 two quiet ones (``user_id * 10 + 0, 8 or 9``), so the log has users who finish the lifecycle and
  users who churn; ``signup_timestamp`` = the entity's first event;
* ``event_name``: views, purchases, signups and some clicks are the lifecycle milestone of their day
  (days cycle through the seven milestones, the first one split by half-days into signup and
  onboarding); other clicks are extra actions and campaign messages; errors are system events
  (sessions and system messages). ``event_source`` follows; ``session_id`` = entity and day;
* user attributes from ``customer`` / ``nation`` (channel by market segment, country, language and
  timezone by nation) plus deterministic id-derived device, intent, stage and consent;
* experiment assignments by the md5 bucketing rule, labels by the churn-window rule restricted to
  users whose full label window ends by the last day of the log.

The mapping tables below are the adapter's contract with the SQL oracles (``plans/oracle.py``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import config

ADAPTER_FUNNEL_STEPS = config.FUNNEL_STEPS
MILESTONE_OF_DAY = {1: "profile_complete", 2: "resume_upload", 3: "job_recommendation_view", 4: "job_save",
                    5: "growth_task_complete", 6: "career_report_generate"}  # (day of month - 1) % 7; 0: see milestone()
MILESTONE_TYPES = ["view", "purchase", "signup"]
MILESTONE_CLICKS = 4  # clicks whose tens digit of k is below this are milestones too
# tens digit of k -> event name, for the other clicks and for errors
CLICK_NAMES = {4: "job_detail_view", 5: "ai_assistant_interaction", 6: "return_visit", 7: "email_sent", 8: "push_sent", 9: "in_app_message_sent"}
CAMPAIGN_CLICKS = 7  # clicks from this digit on are campaign messages
ERROR_NAMES = {0: "session_start", 1: "session_start", 2: "session_start", 3: "session_start", 4: "session_end", 5: "session_end",
               6: "email_sent", 7: "email_sent", 8: "push_sent", 9: "in_app_message_sent"}
QUIET_ENTITIES = 8  # last digits of k from this on are entities of their own
CHANNEL_OF_SEGMENT = dict(zip(["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], config.ACQUISITION_CHANNELS))
LANGUAGES = ["en", "de", "fr", "es"]  # by nation key
TIMEZONES = ["Africa/Cairo", "America/New_York", "Asia/Shanghai", "Europe/Berlin", "UTC"]  # by region key


class LifecycleTables:
    """The lifecycle tables over one data directory; every frame is built on first use only
    (building a plan costs driver time even before anything runs)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return adapt_events(read_driver(self.spark, self.sf_dir, "events"))

    @cached_property
    def events_in_ingest_order(self) -> DataFrame:
        return adapt_events(read_driver(self.spark, self.sf_dir, "events"), ingest_order=True)

    @cached_property
    def users(self) -> DataFrame:
        """The users dimension, derived from the whole log by one aggregate that a query's branches
        share (exchange reuse); nothing runs while a query is built."""
        return adapt_users(self.events, read_driver(self.spark, self.sf_dir, "customer"),
                           read_driver(self.spark, self.sf_dir, "nation"))

    @cached_property
    def signups(self) -> DataFrame:
        """(user_id, signup_timestamp) of every user, without the other dimensions."""
        return first_events(self.events)

    @cached_property
    def observed_until(self) -> Column:
        """The last microsecond of the log's last day, as a scalar subquery."""
        last = F.to_date(F.max("event_timestamp")).cast("timestamp_ntz") + F.expr("INTERVAL '0 23:59:59.999999' DAY TO SECOND")
        return self.events.agg(last.alias("t")).scalar()

    @cached_property
    def hot_users(self) -> DataFrame:
        """Users holding >= 1M events (at most events / 1M rows) with their salt counts. One shared plan: inside a query
        every salted join references the same subtree, so its count pass runs once (exchange
        reuse) instead of once per join."""
        from cohortlens.operators.activity import hot_users

        return hot_users(self.events)

    @cached_property
    def assignments(self) -> DataFrame:
        from cohortlens.operators.assignment import create_experiment_assignments, mark_converted

        return mark_converted(create_experiment_assignments(self.users), self.events)

    @cached_property
    def interventions(self) -> DataFrame:
        """Intervention log = the targeting rules applied to the tables (outcomes not simulated)."""
        from cohortlens.operators.interventions import plan_interventions

        return plan_interventions(self.users, self.events, self.labels, hot_users=self.hot_users)

    @cached_property
    def labels(self) -> DataFrame:
        from cohortlens.operators.labels import build_labels

        return build_labels(self.users, self.events, data_freeze=self.observed_until, hot_users=self.hot_users)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digit(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def entity_id(user_id: Column, props: Column) -> Column:
    last = F.pmod(_digit(props), F.lit(10))
    return user_id * F.lit(10) + F.when(last >= QUIET_ENTITIES, last).otherwise(F.when(last.isNotNull(), 0))


def _of(key: Column, values: dict) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


def milestone(ts: Column, tens: Column) -> Column:
    """The lifecycle milestone of a day: on each seventh day signup before noon, then onboarding."""
    day = F.pmod(F.dayofmonth(ts) - 1, F.lit(7))
    onboarding = F.when(F.hour(ts) < 12, "signup").when(tens < 2, "onboarding_start").otherwise("onboarding_complete")
    return F.when(day == 0, onboarding).otherwise(_of(day, MILESTONE_OF_DAY))


def event_names(kind: Column, ts: Column, tens: Column) -> tuple[Column, Column]:
    """event_name and event_source."""
    is_milestone = kind.isin(MILESTONE_TYPES) | ((kind == "click") & (tens < MILESTONE_CLICKS))
    name = F.when(is_milestone, milestone(ts, tens)).when(kind == "click", _of(tens, CLICK_NAMES)).otherwise(_of(tens, ERROR_NAMES))
    source = F.when(kind == "error", "system").when((kind == "click") & (tens >= CAMPAIGN_CLICKS), "campaign").otherwise("user_action")
    return name, source


def adapt_events(raw: DataFrame, ingest_order: bool = False) -> DataFrame:
    """Canonical events; ``ingest_order`` adds (ingest_file, ingest_seq) from the file metadata
    for the in-session ordering check only (other plans never read the row index)."""
    uid = entity_id(F.col("user_id"), F.col("props"))
    extra = [F.col("_metadata.file_path").alias("ingest_file"),
             F.col("_metadata.row_index").alias("ingest_seq")] if ingest_order else []
    tens = F.pmod(F.floor(_digit(F.col("props")) / 10), F.lit(10))
    name, source = event_names(F.col("event_type"), F.col("ts"), tens)
    return raw.select(
        F.col("event_id"),
        uid.alias("user_id"),
        F.concat(uid.cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        name.alias("event_name"),
        F.col("ts").alias("event_timestamp"),
        F.col("props").alias("event_properties"),
        F.lit(None).cast("string").alias("page_name"),
        F.element_at(F.array(*[F.lit(p) for p in config.PLATFORMS]),
                     (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int")).alias("platform"),
        source.alias("event_source"),
        F.lit(None).cast("string").alias("experiment_id"),
        F.lit(None).cast("string").alias("variant_id"),
        *extra,
    )


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def first_events(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.min("event_timestamp").alias("signup_timestamp"))


def adapt_users(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per entity; the first event (any source) is the signup instant."""
    first = first_events(events)
    dims = customer.select("c_custkey", "c_mktsegment", "c_nationkey").join(
        nation.select("n_nationkey", "n_name", "n_regionkey"), customer.c_nationkey == nation.n_nationkey, "left")
    uid = F.col("user_id")
    users = first.join(dims, F.floor(uid / 10) == dims.c_custkey, "left")
    return users.select(
        uid,
        "signup_timestamp",
        _of(F.col("c_mktsegment"), CHANNEL_OF_SEGMENT).alias("acquisition_channel"),
        F.col("n_name").alias("country"),
        _pick(config.DEVICE_TYPES, F.pmod(uid, F.lit(3))).alias("device_type"),
        F.coalesce(_pick(LANGUAGES, F.pmod("n_nationkey", F.lit(4))), F.lit("unknown")).alias("language"),
        F.coalesce(_pick(TIMEZONES, F.pmod("n_regionkey", F.lit(5))), F.lit("unknown")).alias("timezone"),
        F.lit("free").alias("initial_plan_type"),
        _pick(config.USER_INTENT_LEVELS, F.pmod(F.floor(uid / 3), F.lit(3))).alias("user_intent_level"),
        _pick(config.CAREER_STAGES, F.pmod(F.floor(uid / 9), F.lit(3))).alias("career_stage"),
        (F.pmod(uid, F.lit(2)) == 0).alias("marketing_consent"),
    )


def load(spark: SparkSession, sf_dir: str) -> LifecycleTables:
    """Lazy lifecycle tables over ``sf_dir``."""
    return LifecycleTables(spark, sf_dir)
