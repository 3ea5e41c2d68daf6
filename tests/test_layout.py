"""The event log laid out by user: same results, no exchange of events, hot users apart."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from builders import make_events, make_users, ts
from cohortlens import config
from cohortlens.operators import funnel
from cohortlens.operators.activity import active_on, with_activity
from cohortlens.sources.layout import read_layout, staged_layout, write_layout

HOT = 60


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    base = ts("2024-03-01T00:00:00")
    rows = [{"user_id": "hot" if rng.random() < 0.4 else f"u{rng.randrange(30)}", "event_name": rng.choice(config.FUNNEL_STEPS), "event_timestamp": base + timedelta(hours=rng.randrange(500)),
             "event_source": rng.choice(["user_action", "system"])} for _ in range(600)]
    rows.append({"user_id": None, "event_name": "signup", "event_timestamp": base})
    users = [{"user_id": u, "signup_timestamp": base + timedelta(hours=i)} for i, u in enumerate(["hot", "silent", *[f"u{i}" for i in range(30)]])]
    return make_users(spark, users), make_events(spark, rows)


@pytest.fixture(scope="module")
def laid(tables):
    return staged_layout(*tables, buckets=4, hot_threshold=HOT)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _flags(users, events):
    return funnel.user_step_flags(users, events, group_by="acquisition_channel")


def _days(users, events):
    return with_activity(users.select("user_id", "signup_timestamp"), events).select("user_id", active_on(1).alias("d1"), active_on(7).alias("d7"))


def test_hot_users_have_tables_of_their_own(laid, tables):
    assert {r[0] for r in laid.hot_events.select("user_id").distinct().collect()} == {"hot"} == {r[0] for r in laid.hot_users.select("user_id").collect()}
    users, events = tables
    assert _rows(laid.users.unionByName(laid.hot_users)) == _rows(users)
    assert _rows(laid.events.unionByName(laid.hot_events)) == _rows(events.where("user_id IS NOT NULL"))


@pytest.mark.parametrize("work", [_flags, _days])
def test_same_results_and_no_exchange(spark, tables, laid, work):
    assert _rows(laid.per_user(work)) == _rows(work(*tables))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = work(laid.users, laid.events)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert "Exchange" in work(laid.hot_users, laid.hot_events)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_bucket_is_one_sorted_file(laid):
    files = laid.events.select(F.input_file_name().alias("f"), "user_id").distinct().groupBy("user_id").count()
    assert files.where("count > 1").count() == 0
    assert len(laid.events.inputFiles()) <= 4


def test_rewriting_replaces_and_empty_tables(spark, tables, tmp_path):
    users, events = tables
    for part in (events, events.limit(0)):
        write_layout(users, part, "layout_test", 2, str(tmp_path / "t"), HOT)
    again = read_layout(spark, "layout_test")
    assert again.events.count() == 0 == again.hot_users.count() and again.users.count() == 32
    assert _rows(again.per_user(_flags)) == _rows(_flags(users, events.limit(0)))
