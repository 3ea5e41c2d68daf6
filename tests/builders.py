"""Small builders for lifecycle frames."""

from __future__ import annotations

from datetime import datetime, timedelta

from cohortlens.sources import schemas


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def after(base: datetime, days: float = 0, hours: float = 0, minutes: float = 0, seconds: float = 0) -> datetime:
    return base + timedelta(days=days, hours=hours, minutes=minutes, seconds=seconds)


def make_users(spark, rows: list[dict]):
    """rows: dicts with at least user_id and signup_timestamp; other columns get defaults."""
    defaults = {"acquisition_channel": "referral", "country": "NZ", "device_type": "tablet",
                "language": "mi", "timezone": "Pacific/Auckland", "initial_plan_type": "trial",
                "user_intent_level": "high", "career_stage": "early_career", "marketing_consent": True}
    data = [tuple({**defaults, **r}.get(f.name) for f in schemas.USERS.fields) for r in rows]
    return spark.createDataFrame(data, schemas.USERS)


def make_events(spark, rows: list[dict]):
    """rows: dicts with user_id, event_name, event_timestamp; defaults for the rest."""
    out = []
    for i, r in enumerate(rows):
        d = {"event_id": f"e{i}", "session_id": f"s-{r['user_id']}", "event_properties": "{}", "page_name": None,
             "platform": "web", "event_source": "user_action", "experiment_id": None, "variant_id": None, **r}
        out.append(tuple(d.get(f.name) for f in schemas.EVENTS.fields))
    return spark.createDataFrame(out, schemas.EVENTS)


def rows_by(df, key: str) -> dict:
    return {r[key]: r.asDict() for r in df.collect()}
