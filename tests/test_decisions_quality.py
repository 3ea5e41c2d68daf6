"""Next best action (NB), intervention targeting (IV) and data-quality fault injection (DQ)."""

from __future__ import annotations

import pytest
from builders import after, make_events, make_users, ts
from pyspark.sql import functions as F

from cohortlens.operators import decisions, interventions, quality
from cohortlens.operators.assignment import create_experiment_assignments

S = ts("2026-03-04 05:00:00")
STEPS = ["onboarding_complete", "profile_complete", "resume_upload", "job_recommendation_view", "job_save",
         "growth_task_complete", "career_report_generate"]


@pytest.fixture(scope="module")
def nba_case(spark):
    users = make_users(spark, [
        {"user_id": "idle", "signup_timestamp": S, "marketing_consent": True},
        {"user_id": "new", "signup_timestamp": S, "marketing_consent": False},
        {"user_id": "done", "signup_timestamp": S, "marketing_consent": True},
        {"user_id": "edge", "signup_timestamp": S, "marketing_consent": False},
    ])
    ev = [{"user_id": "idle", "event_name": "onboarding_complete", "event_timestamp": after(S, days=1)}]
    ev += [{"user_id": "done", "event_name": n, "event_timestamp": after(S, days=6)} for n in STEPS]
    ev += [{"user_id": "edge", "event_name": "onboarding_complete", "event_timestamp": after(S, days=7)}]
    return users, make_events(spark, ev)


def _actions(users, events, scores=None):
    return {r.user_id: (r.action_name, r.channel, r.reason)
            for r in decisions.recommend_next_action(users, events, scores).collect()}


def test_user_state_inclusive_cutoff(nba_case):
    users, events = nba_case
    st = {r.user_id: r for r in decisions.compute_user_state(users, events).collect()}
    assert st["edge"].onboarding_completed and st["edge"].recently_active  # ts == cutoff counts
    assert st["idle"].onboarding_completed and not st["idle"].recently_active
    assert not any(st["new"][c] for c in decisions.STATE_FLAGS)


def test_rules_without_scores(nba_case):
    users, events = nba_case
    got = _actions(users, events)
    assert got["idle"] == ("send_reengagement_message", "email", "high churn risk with marketing consent")
    assert got["new"] == ("complete_onboarding", "in_app", "onboarding not completed")
    assert got["done"] == ("continue_weekly_engagement", "email", "all core actions completed")
    assert got["edge"] == ("complete_profile", "in_app", "profile not completed")


def test_rules_with_scores(spark, nba_case):
    users, events = nba_case
    scores = spark.createDataFrame([("idle", 0.6999), ("new", 0.70), ("done", float("nan")), ("edge", None)],
                                   "user_id string, churn_risk_score double")
    got = _actions(users, events, scores)
    assert got["idle"][0] == "complete_profile"  # score given but below 0.70
    assert got["new"] == ("send_reengagement_message", "in_app", "high churn risk without marketing consent")
    assert got["done"][0] == "continue_weekly_engagement"  # NaN: given, not high
    assert got["edge"][0] == "complete_profile"  # null: heuristic, recently active


def test_intervention_targeting(spark):
    users = make_users(spark, [
        {"user_id": "no_onb", "signup_timestamp": S, "marketing_consent": False},
        {"user_id": "one_day", "signup_timestamp": S, "marketing_consent": True},
        {"user_id": "churned", "signup_timestamp": S, "marketing_consent": False},
        {"user_id": "retained", "signup_timestamp": S, "marketing_consent": True},
    ])
    ev = [{"user_id": "one_day", "event_name": "onboarding_complete", "event_timestamp": after(S, hours=2)}]
    for u in ("churned", "retained"):
        ev += [{"user_id": u, "event_name": "onboarding_complete", "event_timestamp": after(S, hours=2)},
               {"user_id": u, "event_name": "job_save", "event_timestamp": after(S, days=1, hours=1)}]
    labels = spark.createDataFrame([("churned", 1), ("retained", 0)], "user_id string, is_churned int")
    out = {r.user_id: r for r in interventions.plan_interventions(users, make_events(spark, ev), labels).collect()}
    assert set(out) == {"no_onb", "one_day", "churned"}
    assert (out["no_onb"].action_name, out["no_onb"].send_time, out["no_onb"].channel) == (
        "complete_onboarding", after(S, days=3), "in_app")
    assert (out["one_day"].action_name, out["one_day"].send_time) == ("send_reengagement_message", after(S, days=7))
    assert out["one_day"].channel in ("email", "push")
    assert (out["churned"].action_name, out["churned"].send_time, out["churned"].channel) == (
        "send_win_back", after(S, days=22), "in_app")


def _report(df):
    return {r.check: r for r in df.collect()}


def test_quality_clean_then_faults(spark):
    users = make_users(spark, [{"user_id": f"u{i}", "signup_timestamp": S} for i in range(4)])
    ev = [{"user_id": f"u{i}", "event_name": "signup", "event_timestamp": after(S, minutes=i)} for i in range(4)]
    events = make_events(spark, ev).withColumn("seq", F.monotonically_increasing_id())
    assign = create_experiment_assignments(users)
    labels = spark.createDataFrame([(f"u{i}", int(i == 0)) for i in range(4)], "user_id string, is_churned int")
    clean = _report(quality.validate(users, events, assign, labels, session_order_cols=["seq"]))
    for check in ["acquisition_channel_domain", "unique_event_ids", "event_foreign_keys", "event_after_signup",
                  "users_with_events", "observation_window", "session_timestamp_order", "churn_rate_range"]:
        assert clean[check].passed, check
    assert clean["churn_rate_range"].value == pytest.approx(0.25)  # inclusive lower bound

    bad_users = users.unionByName(make_users(spark, [
        {"user_id": "late", "signup_timestamp": ts("2026-05-20 00:00:00"), "acquisition_channel": None}]))
    bad_ev = make_events(spark, ev + [
        {"user_id": "ghost", "event_name": "signup", "event_timestamp": S},
        {"user_id": "u1", "event_name": "signup", "event_timestamp": after(S, seconds=-1), "event_source": "bot"},
        {"user_id": "u2", "event_name": "job_save", "event_timestamp": after(S, hours=1), "session_id": "s-u2"},
        {"user_id": "u2", "event_name": "job_save", "event_timestamp": after(S, minutes=30), "session_id": "s-u2"},
    ]).withColumn("seq", F.monotonically_increasing_id())
    bad_ev = bad_ev.unionByName(bad_ev.where("user_id = 'u3'").withColumn("seq", F.lit(10_000).cast("long")))
    bad_labels = spark.createDataFrame([(f"u{i}", int(i == 0)) for i in range(4)] + [("late", 0)],
                                       "user_id string, is_churned int")
    rep = _report(quality.validate(bad_users, bad_ev, assign, bad_labels, session_order_cols=["seq"]))
    assert not rep["acquisition_channel_domain"].passed and rep["acquisition_channel_domain"].violations == 1
    assert not rep["event_source_domain"].passed
    assert rep["unique_event_ids"].violations == 1
    assert rep["event_foreign_keys"].violations == 1
    assert rep["event_after_signup"].violations == 1
    assert not rep["observation_window"].passed
    assert rep["users_missing_assignment"].violations == 1
    assert rep["users_with_events"].violations == 1
    assert rep["session_timestamp_order"].violations >= 1 and rep["session_timestamp_order"].severity == "warning"
    assert not rep["churn_rate_range"].passed  # 1 / 5 = 0.2
    verdict = quality.report_passed(quality.validate(bad_users, bad_ev, assign, bad_labels)).first()
    assert not verdict.passed and verdict.errors > 0


def test_session_order_spans_blocks(spark):
    rows = [("s1", 0, ts("2026-03-01 00:00:00")), ("s1", 1, ts("2026-03-01 00:01:00")),
            ("s1", 2, ts("2026-03-01 00:00:30")), ("s2", 3, ts("2026-03-01 00:00:00")),
            ("s2", 4, ts("2026-03-01 00:00:00")), ("s3", 5, ts("2026-03-01 00:05:00")),
            ("s3", 6, ts("2026-03-01 00:06:00")), ("s3", 7, ts("2026-03-01 00:04:00"))]
    df = spark.createDataFrame(rows, "session_id string, seq long, event_timestamp timestamp_ntz")
    # block size 2 forces the decreases of s1 and s3 across block borders
    assert quality.session_order_violations(df, ["seq"], block=2).first().sessions == 2
