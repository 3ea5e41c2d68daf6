"""Explicit schemas of the lifecycle tables (no inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS, _B, _D, _I = T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


USERS = _struct(
    ("user_id", _S, False), ("signup_timestamp", _TS, False), ("acquisition_channel", _S, True),
    ("country", _S, True), ("device_type", _S, True), ("language", _S, True), ("timezone", _S, True),
    ("initial_plan_type", _S, True), ("user_intent_level", _S, True), ("career_stage", _S, True),
    ("marketing_consent", _B, True),
)

EVENTS = _struct(
    ("event_id", _S, False), ("user_id", _S, True), ("session_id", _S, True), ("event_name", _S, True),
    ("event_timestamp", _TS, True), ("event_properties", _S, True), ("page_name", _S, True),
    ("platform", _S, True), ("event_source", _S, True), ("experiment_id", _S, True), ("variant_id", _S, True),
)

EXPERIMENT_ASSIGNMENTS = _struct(
    ("experiment_id", _S, True), ("user_id", _S, True), ("variant_id", _S, True),
    ("assignment_time", _TS, True), ("experiment_name", _S, True), ("experiment_type", _S, True),
    ("traffic_allocation", _D, True), ("is_exposed", _B, True), ("is_converted", _B, True),
)

INTERVENTIONS = _struct(
    ("message_id", _S, True), ("user_id", _S, True), ("action_name", _S, True), ("channel", _S, True),
    ("send_time", _TS, True), ("open_time", _TS, True), ("click_time", _TS, True),
    ("conversion_time", _TS, True), ("experiment_id", _S, True),
)

LABELS = _struct(
    ("user_id", _S, True), ("signup_timestamp", _TS, True), ("prediction_cutoff", _TS, True),
    ("label_start", _TS, True), ("label_end", _TS, True), ("is_churned", _I, True),
)

TABLES = {
    "users": USERS,
    "events": EVENTS,
    "experiment_assignments": EXPERIMENT_ASSIGNMENTS,
    "interventions": INTERVENTIONS,
    "labels": LABELS,
}

# users columns hidden before publishing (IO7)
# FIXED VALUES: simulator-only columns that must never be published
PRIVATE_USER_COLUMNS = [
    "intrinsic_engagement",
    "career_urgency",
    "product_fit",
    "notification_sensitivity",
    "intent_score",
    "career_stage_score",
    "device_score",
]
