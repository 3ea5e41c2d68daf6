"""Activity bitmaps against sets of days, and the plans that use them."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from builders import make_events, make_users, ts
from cohortlens.operators import retention
from cohortlens.operators.activity import DAYS_A_MASK, active_on, activity_bitmap, with_activity
from cohortlens.operators.interventions import first_week_activity


def _events(spark, seed=4):
    rng = random.Random(seed)
    base = ts("1969-11-01T00:00:00")  # stretches before and after 1970
    rows = [{"user_id": f"u{rng.randrange(12)}", "event_name": rng.choice(["job_save", "signup"]), "event_timestamp": base + timedelta(days=rng.randrange(400), hours=rng.randrange(24)),
             "event_source": rng.choice(["user_action", "user_action", "system"])} for _ in range(500)]
    rows += [{"user_id": "none", "event_name": "job_save", "event_timestamp": None}, {"user_id": "late", "event_name": "signup", "event_timestamp": ts("2031-12-31T23:59:59")}]
    return rows, make_events(spark, rows)


def test_bitmap_holds_the_active_days(spark):
    rows, events = _events(spark)
    got = {r["user_id"]: r for r in activity_bitmap(events, names={"saved": "job_save"}).collect()}
    mine = [r for r in rows if r.get("event_source", "user_action") == "user_action"]
    assert got.keys() == {r["user_id"] for r in mine}
    for user, found in got.items():
        own = [r for r in mine if r["user_id"] == user]
        days = {date(1970, 1, 1) + timedelta(days=part * DAYS_A_MASK + bit) for part, mask in found["_days"].items() for bit in range(64) if mask >> bit & 1}
        assert days == {r["event_timestamp"].date() for r in own if r["event_timestamp"]}
        assert found["_last"] == max((r["event_timestamp"] for r in own if r["event_timestamp"]), default=None)
        assert found["saved"] == any(r["event_name"] == "job_save" for r in own)


def test_active_on_any_day(spark):
    rows, events = _events(spark, 9)
    days = {(r["user_id"], r["event_timestamp"].date()) for r in rows if r["event_timestamp"] and r.get("event_source", "user_action") == "user_action"}
    users = make_users(spark, [{"user_id": f"u{i}", "signup_timestamp": ts("1969-12-20T13:00:00") + timedelta(days=9 * i)} for i in range(14)])
    offsets = [-40, 0, 1, 11, 12, 64, 200]
    for r in with_activity(users, events).select("user_id", "signup_timestamp", *[active_on(d).alias(f"d{i}") for i, d in enumerate(offsets)]).collect():
        for i, d in enumerate(offsets):
            assert r[f"d{i}"] == ((r["user_id"], r["signup_timestamp"].date() + timedelta(days=d)) in days)


def test_summary_reads_the_events_once(spark, tmp_path):
    _, events = _events(spark)
    events.write.parquet(str(tmp_path / "events"))
    users = make_users(spark, [{"user_id": "u1", "signup_timestamp": ts("2024-01-01")}])
    out = retention.retention_summary(users, spark.read.parquet(str(tmp_path / "events")))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_summary_without_users(spark):
    _, events = _events(spark)
    rows = retention.retention_summary(make_users(spark, []), events).collect()
    assert [(r["metric"], r["rate"]) for r in rows] == [("D7 rolling retention", 0.0)]


def test_first_week_days_as_bits_and_as_distinct_values(spark):
    rows, events = _events(spark, 12)
    users = make_users(spark, [{"user_id": f"u{i}", "signup_timestamp": ts("1969-12-20T13:00:00") + timedelta(days=9 * i)} for i in range(14)])
    signup = {r["user_id"]: r["signup_timestamp"] for r in users.collect()}
    for cutoff in (7, 63, 64, 300):
        want = {u: len({(r["event_timestamp"] - at).days for r in rows if r["user_id"] == u and r.get("event_source", "user_action") == "user_action"
                        and 0 <= (r["event_timestamp"] - at).days <= cutoff}) for u, at in signup.items()}
        assert {r["user_id"]: r["active_days_first_week"] for r in first_week_activity(users, events, cutoff).collect()} == want
