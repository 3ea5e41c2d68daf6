"""Funnel (FN) and retention (RT) micro fixtures and invariants."""

from __future__ import annotations

import pytest
from builders import after, make_events, make_users, rows_by, ts

from cohortlens.functions.timeutil import week_label
from cohortlens.operators import funnel, retention

S = ts("2026-03-04 05:00:00")


@pytest.fixture(scope="module")
def funnel_data(spark):
    users = make_users(spark, [{"user_id": u, "signup_timestamp": S,
                                "acquisition_channel": "referral" if u in ("u1", "u2") else "social_ads"}
                               for u in ["u1", "u2", "u3", "u4", "u5"]] +
                       [{"user_id": "u6", "signup_timestamp": S, "acquisition_channel": None}])
    ev = []
    for i, name in enumerate(["signup", "onboarding_complete", "profile_complete", "resume_upload",
                              "job_recommendation_view", "job_save", "career_report_generate"]):
        ev.append({"user_id": "u1", "event_name": name, "event_timestamp": after(S, minutes=[0, 5, 10, 20, 30, 40, 50][i])})
    ev += [{"user_id": "u2", "event_name": "signup", "event_timestamp": S},
           {"user_id": "u2", "event_name": "onboarding_complete", "event_timestamp": S},
           {"user_id": "u2", "event_name": "profile_complete", "event_timestamp": after(S, minutes=10)},
           {"user_id": "u3", "event_name": "signup", "event_timestamp": S},
           {"user_id": "u3", "event_name": "onboarding_complete", "event_timestamp": after(S, minutes=5)},
           {"user_id": "u3", "event_name": "profile_complete", "event_timestamp": after(S, minutes=3)},
           {"user_id": "u3", "event_name": "profile_complete", "event_timestamp": after(S, minutes=9)},
           {"user_id": "u4", "event_name": "onboarding_complete", "event_timestamp": after(S, minutes=5)},
           {"user_id": "u5", "event_name": "signup", "event_timestamp": S},
           {"user_id": "u5", "event_name": "onboarding_complete", "event_timestamp": after(S, minutes=5),
            "event_source": "campaign"}]
    return users.where("user_id != 'u6'"), users, make_events(spark, ev)


def test_funnel_fixture(funnel_data):
    users, _, events = funnel_data
    out = funnel.compute_funnel(users, events).collect()
    assert [r.step for r in out][:3] == ["signup", "onboarding_complete", "profile_complete"]
    got = {r.step: (r.users, round(r.conversion_rate, 6), round(r.drop_off_rate, 6)) for r in out}
    assert got["signup"] == (5, 1.0, 0.0)
    assert got["onboarding_complete"] == (2, 0.4, 0.6)  # tie (u2) and non-action source (u5) fail
    assert got["profile_complete"] == (1, 0.2, 0.5)  # u3: first profile_complete precedes onboarding
    for step in ["resume_upload", "job_recommendation_view", "job_save", "career_report_generate"]:
        assert got[step] == (1, 0.2, 0.0)


def test_funnel_grouped_drops_null_groups_and_is_monotone(funnel_data):
    _, users_with_null, events = funnel_data
    out = funnel.compute_funnel(users_with_null, events, group_by="acquisition_channel").collect()
    groups = {r.acquisition_channel for r in out}
    assert groups == {"referral", "social_ads"}
    for g in groups:
        rows = [r for r in out if r.acquisition_channel == g]
        assert len(rows) == 7
        counts = [r.users for r in rows]
        assert counts == sorted(counts, reverse=True)
        assert all(0.0 <= r.conversion_rate <= 1.0 and 0.0 <= r.drop_off_rate <= 1.0 for r in rows)


@pytest.fixture(scope="module")
def retention_data(spark):
    users = make_users(spark, [
        {"user_id": "a", "signup_timestamp": ts("2026-03-04 23:30:00"), "acquisition_channel": "referral"},
        {"user_id": "b", "signup_timestamp": ts("2026-03-04 00:10:00"), "acquisition_channel": "referral"},
        {"user_id": "c", "signup_timestamp": ts("2026-03-04 08:00:00"), "acquisition_channel": "social_ads"},
    ])
    events = make_events(spark, [
        {"user_id": "a", "event_name": "job_save", "event_timestamp": ts("2026-03-05 00:05:00")},
        {"user_id": "b", "event_name": "job_save", "event_timestamp": ts("2026-03-04 23:59:00")},
        {"user_id": "b", "event_name": "email_sent", "event_timestamp": ts("2026-03-05 12:00:00"),
         "event_source": "campaign"},
    ])
    return users, events


def test_day_retention_calendar_day(retention_data):
    users, events = retention_data
    r = retention.compute_day_retention(users, events, 1).first()
    assert r.day == 1 and r.retention_rate == pytest.approx(1 / 3)


def test_rolling_retention_uses_instants(retention_data):
    users, events = retention_data
    r = retention.compute_rolling_retention(users, events, 1).first()
    assert r.retention_rate == 0.0


def test_grouped_day_retention(retention_data):
    users, events = retention_data
    got = rows_by(retention.compute_day_retention(users, events, 1, group_by="acquisition_channel"),
                  "acquisition_channel")
    assert got["referral"]["retention_rate"] == pytest.approx(0.5)
    assert got["social_ads"]["retention_rate"] == 0.0


def test_week_label(spark):
    df = spark.createDataFrame([(ts("2026-03-08 10:00:00"),), (ts("2026-03-09 00:00:00"),)], "t timestamp_ntz")
    labels = [r[0] for r in df.select(week_label("t")).collect()]
    assert labels == ["2026-03-02/2026-03-08", "2026-03-09/2026-03-15"]


def test_cohort_weighted_mean_equals_overall(spark):
    from cohortlens.sources import testdata

    t = testdata.load(spark, "/root/testdata/sf0.001")
    cohort = retention.compute_cohort_retention(t.users, t.events, (1, 7, 14)).collect()
    for day in (1, 7, 14):
        rows = [r for r in cohort if r.day == day]
        weighted = sum(r.retained for r in rows) / sum(r.users for r in rows)
        overall = retention.compute_day_retention(t.users, t.events, day).first().retention_rate
        assert weighted == pytest.approx(overall)


def test_cohort_variant_requires_column(retention_data):
    users, events = retention_data
    with pytest.raises(ValueError):
        retention.compute_cohort_retention(users, events, (1,), cohort_col="variant_id")


def test_salted_user_join_is_exact(spark):
    """The hot-user salted join gives exactly the plain join's rows."""
    from pyspark.sql import functions as F

    from cohortlens.operators.activity import with_user_columns

    users = make_users(spark, [{"user_id": f"u{i}", "signup_timestamp": S} for i in range(5)])
    ev = [{"user_id": "u0", "event_name": "job_save", "event_timestamp": after(S, minutes=m)} for m in range(300)]
    ev += [{"user_id": f"u{i}", "event_name": "signup", "event_timestamp": S} for i in range(1, 4)]
    ev += [{"user_id": "ghost", "event_name": "signup", "event_timestamp": S}]
    events = make_events(spark, ev).select("event_id", "user_id", "event_timestamp")
    plain = sorted(with_user_columns(events, users, ["signup_timestamp"], hot_threshold=None).collect())
    salted = with_user_columns(events, users, ["signup_timestamp"], hot_threshold=100)
    assert sorted(salted.collect()) == plain and len(plain) == 303
    # a shared, precomputed hot list (here one that also names a cold user) stays exact
    from cohortlens.operators.activity import hot_users as _hot

    shared = _hot(events, 1).where("user_id IN ('u0', 'u1')")
    again = with_user_columns(events, users, ["signup_timestamp"], hot=shared)
    assert sorted(again.collect()) == plain
    # the hot user's events really are spread over several salt buckets
    from cohortlens.operators.activity import hot_users

    assert [r.user_id for r in hot_users(events, 100).collect()] == ["u0"]
    # identical duplicates of a hot user's event are still spread over several buckets
    dup = events.where("user_id = 'u0'").limit(1)
    for _ in range(7):
        dup = dup.unionByName(dup)
    assert dup.count() == 128
    spread = (dup.select(F.pmod(F.xxhash64(*[F.col(c) for c in dup.columns], F.monotonically_increasing_id()),
                                F.lit(8)).alias("b")).distinct().count())
    assert spread > 1
    dup_join = with_user_columns(dup, users, ["signup_timestamp"], hot_threshold=100)
    assert dup_join.count() == 128
