"""Statistics columns (EX3, EX6), md5 assignment (AS1) and experiment analysis (EX1)."""

from __future__ import annotations

import hashlib
import math

import pytest
from builders import after, make_events, make_users, ts
from pyspark.sql import functions as F

from cohortlens.functions import stats
from cohortlens.operators import assignment, experiment


def _chi2_sf_reference(x: float, k: int) -> float:
    """Independent closed forms via math.erfc / the regularised incomplete gamma recurrence."""
    if k % 2 == 0:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))
    q = math.erfc(math.sqrt(x / 2))
    term = math.sqrt(x / 2) * math.exp(-x / 2) / math.sqrt(math.pi) * 2
    for i in range(1, (k - 1) // 2 + 1):
        q += term
        term *= x / (2 * i + 1)
    return q


def test_normal_cdf_matches_erf(spark):
    zs = [-8.0, -3.2, -1.0, -0.1, 0.0, 0.3, 1.96, 2.5, 5.0, 8.2]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(stats.normal_cdf("z")).collect()]
    for z, g in zip(zs, got):
        assert g == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), abs=1e-14)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_chi2_sf(spark, k):
    xs = [0.1, 1.0, 2.333333333, 7.5, 20.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(stats.chi2_sf("x", k)).collect()]
    for x, g in zip(xs, got):
        assert g == pytest.approx(_chi2_sf_reference(x, k), abs=1e-12)


def test_two_proportion_z_test(spark):
    df = spark.createDataFrame([(40, 100, 55, 100), (0, 100, 0, 100)], "ca long, na long, cb long, nb long")
    t = stats.two_proportion_z_test("ca", "na", "cb", "nb")
    rows = df.select(*[v.alias(k) for k, v in t.items()]).collect()
    assert rows[0].z == pytest.approx(2.123976976, abs=1e-8)
    assert rows[0].p_value == pytest.approx(0.033672069, abs=1e-8)
    assert rows[0].ci_lower == pytest.approx(0.013150448, abs=1e-8)
    assert rows[0].ci_upper == pytest.approx(0.286849552, abs=1e-8)
    assert rows[1].z == 0.0 and rows[1].p_value == pytest.approx(1.0)


def test_assign_variant_buckets(spark):
    expected = {"0": (944593, "simplified"), "1": (977821, "simplified"), "2": (701738, "simplified"),
                "3": (803769, "simplified"), "4": (55044, "control"), "5": (124677, "control")}
    df = spark.createDataFrame([(u,) for u in expected], "user_id string")
    got = df.select("user_id", assignment.variant_bucket(F.col("user_id")).alias("b"),
                    assignment.assign_variant(F.col("user_id")).alias("v")).collect()
    for r in got:
        assert (r.b, r.v) == expected[r.user_id]
    # the fold equals the big-integer remainder for arbitrary ids
    ids = [f"user-{i}" for i in range(200)]
    got = dict(spark.createDataFrame([(u,) for u in ids], "user_id string")
               .select("user_id", assignment.variant_bucket(F.col("user_id"), salt="s1")).collect())
    for u in ids:
        assert got[u] == int(hashlib.md5(f"{u}:exp_onboarding_v1:s1".encode()).hexdigest(), 16) % 1_000_000


def test_srm_matches_closed_form(spark):
    rows = [("exp_onboarding_v1", f"u{i}", v) for i, v in enumerate(["control"] * 420 + ["personalized"] * 280 +
                                                                     ["simplified"] * 300)]
    a = spark.createDataFrame(rows, "experiment_id string, user_id string, variant_id string")
    r = experiment.srm_test(a).first()
    assert r.chi2 == pytest.approx(2.333333333, abs=1e-8)
    assert r.p_value == pytest.approx(0.311403224, abs=1e-8)
    assert r.dof == 2 and r.unknown_variant_rows == 0


def test_srm_absent_variant_counts_as_zero(spark):
    rows = [("exp_onboarding_v1", f"u{i}", "control") for i in range(10)] + [("exp_onboarding_v1", "x", "mystery")]
    a = spark.createDataFrame(rows, "experiment_id string, user_id string, variant_id string")
    r = experiment.srm_test(a).first()
    assert r.n == 11 and r.unknown_variant_rows == 1 and r.p_value < 0.01


def test_analyze_experiment(spark):
    s = ts("2026-03-04 10:00:00")
    users = make_users(spark, [{"user_id": f"u{i}", "signup_timestamp": s} for i in range(6)])
    a = spark.createDataFrame([("exp_onboarding_v1", f"u{i}", "control" if i < 3 else "simplified") for i in range(6)]
                              + [("exp_onboarding_v1", "ghost", "simplified")],
                              "experiment_id string, user_id string, variant_id string")
    events = make_events(spark, [
        {"user_id": "u0", "event_name": "onboarding_complete", "event_timestamp": after(s, days=30)},  # any time
        {"user_id": "u3", "event_name": "onboarding_complete", "event_timestamp": after(s, hours=1)},
        {"user_id": "u4", "event_name": "onboarding_complete", "event_timestamp": after(s, hours=1)},
        {"user_id": "u4", "event_name": "job_save", "event_timestamp": after(s, days=7, hours=13)},  # D7 (calendar)
        {"user_id": "u5", "event_name": "onboarding_complete", "event_timestamp": after(s, hours=2),
         "event_source": "campaign"},
    ])
    out = {(r.metric, r.variant_id): r for r in experiment.analyze_experiment(users, events, a).collect()}
    c = out[("onboarding_completion_rate", "control")]
    t = out[("onboarding_completion_rate", "simplified")]
    assert (c.sample_size, c.conversions) == (3, 1) and c.p_value is None and c.relative_lift is None
    assert (t.sample_size, t.conversions) == (4, 2)  # the unknown 'ghost' user still counts in n
    assert t.absolute_lift == pytest.approx(0.5 - 1 / 3)
    assert t.relative_lift == pytest.approx((0.5 - 1 / 3) / (1 / 3))
    d7 = out[("d7_retention_rate", "simplified")]
    assert d7.conversions == 1
    assert out[("profile_completion_rate", "simplified")].relative_lift is None  # control rate 0
