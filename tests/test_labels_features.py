"""Churn labels (LB) and pre-cutoff features (FE): boundaries, null paths, metamorphic checks."""

from __future__ import annotations

import pytest
from builders import after, make_events, make_users, rows_by, ts

from cohortlens.operators import features, labels

S = ts("2026-03-04 05:00:00")


def test_label_window_boundaries(spark):
    offsets = {"w8": dict(days=8), "w21": dict(days=21), "before": dict(days=8, seconds=-1),
               "after": dict(days=21, seconds=1), "system": dict(days=10), "none": None}
    users = make_users(spark, [{"user_id": u, "signup_timestamp": S} for u in offsets])
    ev = [{"user_id": u, "event_name": "job_save", "event_timestamp": after(S, **o),
           "event_source": "system" if u == "system" else "user_action"} for u, o in offsets.items() if o]
    got = rows_by(labels.build_labels(users, make_events(spark, ev)), "user_id")
    assert {u: r["is_churned"] for u, r in got.items()} == {
        "w8": 0, "w21": 0, "before": 1, "after": 1, "system": 1, "none": 1}
    assert got["w8"]["label_end"] == after(S, days=21)


def test_label_freeze_keeps_only_full_windows(spark):
    users = make_users(spark, [{"user_id": "old", "signup_timestamp": S},
                               {"user_id": "new", "signup_timestamp": after(S, days=5)}])
    out = labels.build_labels(users, make_events(spark, [{"user_id": "old", "event_name": "signup",
                                                          "event_timestamp": S}]),
                              data_freeze=after(S, days=21))
    assert [r.user_id for r in out.collect()] == ["old"]


def test_leakage_checks(spark):
    issues = labels.check_label_leakage(["future_event_count", "is_churned", "num_sessions"])
    assert len(issues) == 2
    feats = spark.createDataFrame([("u", 1)], "user_id string, future_events int")
    lab = spark.createDataFrame([("u", 1)], "user_id string, is_churned int")
    with pytest.raises(ValueError, match="leakage"):
        labels.attach_labels(feats, lab)


@pytest.fixture(scope="module")
def feature_case(spark):
    users = make_users(spark, [{"user_id": "f1", "signup_timestamp": S, "marketing_consent": True},
                               {"user_id": "f2", "signup_timestamp": S, "marketing_consent": None}])
    ev = [
        {"user_id": "f1", "event_name": "signup", "event_timestamp": S, "session_id": "s1"},
        {"user_id": "f1", "event_name": "onboarding_start", "event_timestamp": after(S, hours=1), "session_id": "s2"},
        {"user_id": "f1", "event_name": "session_start", "event_timestamp": after(S, hours=2), "session_id": "s3"},
        {"user_id": "f1", "event_name": "job_detail_view", "event_timestamp": after(S, hours=2, minutes=5),
         "session_id": "s3"},
        {"user_id": "f1", "event_name": "session_end", "event_timestamp": after(S, hours=2, minutes=20),
         "session_id": "s3"},
        {"user_id": "f1", "event_name": "email_sent", "event_timestamp": after(S, days=3), "session_id": "s4",
         "event_source": "campaign"},
        {"user_id": "f1", "event_name": "push_sent", "event_timestamp": after(S, days=3), "session_id": None,
         "event_source": "system"},
        {"user_id": "f1", "event_name": "job_save", "event_timestamp": after(S, days=7), "session_id": "s5"},
    ]
    return users, make_events(spark, ev)


def test_feature_fixture(feature_case):
    users, events = feature_case
    got = rows_by(features.build_model_features(users, events), "user_id")
    f1 = got["f1"]
    expect = {"signup_hour": 5, "signup_day_of_week": 2, "num_sessions": 1, "num_user_actions": 5,
              "num_days_active": 1, "num_email_sent": 0, "num_push_sent": 1, "num_in_app_sent": 0,
              "avg_events_per_session": 1.5, "max_events_in_session": 3, "total_user_actions_in_sessions": 5,
              "unique_event_type_count": 7, "first_day_event_count": 5, "last_2_days_event_count": 0,
              "hours_to_first_action": 0.0, "onboarding_started": 1, "num_core_actions_completed": 1,
              "job_save": 0, "job_detail_view_count": 1, "marketing_consent": 1}
    for k, v in expect.items():
        assert f1[k] == pytest.approx(v), k
    assert f1["hours_since_last_action_at_cutoff"] == pytest.approx(165.666667, abs=1e-6)
    assert f1["onboarding_variant"] == "unknown"
    f2 = got["f2"]
    assert f2["hours_to_first_action"] is None and f2["hours_since_last_action_at_cutoff"] is None
    assert f2["marketing_consent"] == 0.0
    assert all(f2[c] == 0.0 for c in features.FEATURE_FAMILIES["counts"])
    assert list(got["f1"].keys())[:2] == ["user_id", "signup_timestamp"] and len(got["f1"]) == 39


def test_post_cutoff_events_change_nothing(spark, feature_case):
    users, events = feature_case
    extra = make_events(spark, [{"user_id": "f1", "event_name": n, "event_timestamp": after(S, days=d)}
                                for n, d in [("resume_upload", 7), ("job_save", 9), ("session_start", 30)]])
    a = sorted(features.build_model_features(users, events).collect())
    b = sorted(features.build_model_features(users, events.unionByName(extra)).collect())
    assert a == b


def test_variant_feature(spark, feature_case):
    users, events = feature_case
    a = spark.createDataFrame([("exp_onboarding_v1", "f1", "personalized"), ("other", "f2", "x")],
                              "experiment_id string, user_id string, variant_id string")
    got = rows_by(features.build_model_features(users, events, a), "user_id")
    assert got["f1"]["onboarding_variant"] == "personalized" and got["f2"]["onboarding_variant"] == "unknown"
