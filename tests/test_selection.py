"""Order statistics by counting (ranks of keys, quantiles of many columns) against sorted lists."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from builders import ts
from cohortlens.functions import selection
from cohortlens.functions.selection import keys_at_ranks, quantiles, totals_up_to
from cohortlens.operators import evaluate, split


def _sorted_keys(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or ts("2000-01-01"), r[0] is not None, r[0] or ""))


@pytest.fixture(params=[4, selection.PIVOTS])
def pivots(request, monkeypatch):
    """Few pivots leave several rows between two of them."""
    monkeypatch.setattr(selection, "PIVOTS", request.param)


def _rows(n, seed, hot=0.0):
    rng = random.Random(seed)
    at = [None, ts("1969-12-31T23:59:59.999999"), ts("2024-01-01T00:00:00"), *[ts(f"2024-01-0{d}T12:00:0{s}.00000{u}") for d in (1, 2) for s in range(3) for u in range(2)]]
    return [(f"u{i:04d}" if rng.random() > 0.02 else None, at[3] if rng.random() < hot else rng.choice(at)) for i in range(n)]


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_keys_at_ranks_as_sorting(spark, pivots, hot):
    rows = _rows(160, 3, hot)
    rows += rows[:20]  # repeated rows count singly
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "user_id string, at timestamp").repartition(5)
    want = [1, 2, 40, 77, 90, len(rows), 0, len(rows) + 1]
    got = keys_at_ranks(df, "at", "user_id", lambda n: [F.lit(r) for r in want]).first()
    order = _sorted_keys(rows)
    for r, found in zip(want, got):
        assert (tuple(found) if found is not None else None) == ((order[r - 1][1], order[r - 1][0]) if 0 < r <= len(order) else None)


def test_split_follows_the_sorted_order_at_a_shared_instant(spark, pivots):
    rows = [(i, ts("2024-05-01T08:00:00") if i % 3 else ts(f"2024-0{1 + i % 9}-01T00:00:00")) for i in range(101)]
    got = {r["user_id"]: r["split"] for r in split.chronological_split(
        spark.createDataFrame(rows, "user_id long, signup_timestamp timestamp"), 0.6, 0.2).collect()}
    order = [u for u, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert [got[u] for u in order] == ["train"] * 60 + ["validation"] * 20 + ["test"] * 21


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_split_of_few_rows(spark, n):
    df = spark.createDataFrame([(i, ts("2024-01-01")) for i in range(n)], "user_id long, signup_timestamp timestamp")
    parts = [r["split"] for r in split.chronological_split(df).orderBy("user_id").collect()]
    assert parts == ["train"] * int(n * 0.6) + ["validation"] * int(n * 0.2) + ["test"] * (n - int(n * 0.6) - int(n * 0.2))


def test_building_a_split_runs_and_sorts_nothing(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-split", "")
    try:
        df = spark.range(50).select(F.col("id").alias("user_id"), F.timestamp_seconds("id").alias("signup_timestamp"), F.lit("wide").alias("other"))
        out = split.chronological_split(df)
        assert list(tracker.getJobIdsForGroup("build-split")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert "Exchange" not in plan.split("Subquery")[0]  # rows are compared where they lie


def test_medians_need_two_passes_and_no_rows_made(spark, monkeypatch):
    passes = []
    df = spark.range(1000).select(*[(F.pmod(F.col("id") * (7 + i), F.lit(50 + i)) / (i + 1)).alias(f"f{i}") for i in range(12)])
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: passes.append(len(e)) or agg(self, *e))
    got = quantiles(df, [f"f{i}" for i in range(12)])
    assert len(passes) == 2
    for i in range(12):
        assert got[f"f{i}"] == float(np.median([k * (7 + i) % (50 + i) / (i + 1) for k in range(1000)]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(*[st.one_of(st.none(), st.floats(allow_infinity=False, width=32), st.integers(0, 3).map(float))] * 3), max_size=40),
       prob=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]), accuracy=st.sampled_from([2, 10_000]))
def test_quantiles_as_numpy(spark, rows, prob, accuracy):
    df = spark.createDataFrame(rows, "a double, b double, `c d` double")
    got = quantiles(df, ["a", "b", "c d"], prob, accuracy)
    for i, c in enumerate(["a", "b", "c d"]):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        if not values:
            assert got[c] is None
        else:
            assert got[c] == pytest.approx(float(np.quantile(values, prob)), rel=1e-12, abs=1e-300)


def _totals(rows, grouped):
    """(group, key, up to, all) told by sorting."""
    out = set()
    for g in {r[0] for r in rows} if grouped else {None}:
        mine = sorted((r for r in rows if r[0] == g or not grouped), key=lambda r: (r[1] is not None, r[1] or 0.0))
        run = 0
        for r in mine:
            run += r[2]
            out.add((r[0], r[1], run, sum(x[2] for x in mine)))
    return out


@pytest.mark.parametrize("grouped", [False, True])
def test_totals_up_to_as_sorting(spark, pivots, grouped):
    rng = random.Random(4)
    keys = [None, -1.5, 0.0, float("inf"), *[rng.gauss(0, 1) for _ in range(60)]]
    groups = [1, 2, 3] if grouped else [1]
    rows = [(g, k, rng.randrange(0, 5)) for g in groups for k in keys if rng.random() < 0.9] + [(9, 1e9, 3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, k double, n long").repartition(5)
    out = totals_up_to(df, F.col("k"), {"upto": "n"}, ["g"] if grouped else None)
    assert out.columns == ["g", "k", "n", "upto", "all_upto"]
    assert {(r.g, r.k, r.upto, r.all_upto) for r in out.collect()} == _totals(rows, grouped)
    assert totals_up_to(df.limit(0), F.col("k"), {"upto": "n"}, ["g"] if grouped else None).collect() == []


def test_building_an_evaluation_starts_no_job(spark):
    scored = spark.range(50).select((F.col("id") % 2).alias("label"), (F.col("id") / 50).alias("prob"), (F.col("id") % 3).alias("g"))
    spark.sparkContext.setJobGroup("evaluation", "built only")
    try:
        built = [evaluate.average_precision(scored), evaluate.roc_auc(scored), evaluate.pr_curve(scored), evaluate.roc_curve(scored),
                 evaluate.calibration(scored), evaluate.average_precision_by(scored, ["g"]), evaluate.compute_metrics(scored, 0.5)]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("evaluation")) == [] and len(built) == 7
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_average_precision_of_groups_is_that_of_each(spark, pivots):
    rng = random.Random(12)
    rows = [(g, int(rng.random() < 0.4), rng.choice([0.1, 0.5, rng.random()])) for g in range(4) for _ in range(60)] + [(7, 0, 0.3), (8, 1, 0.3)]
    df = spark.createDataFrame(rows, "g int, label int, prob double")
    got = {r.g: r.pr_auc for r in evaluate.average_precision_by(df, ["g"]).collect()}
    assert got.keys() == {0, 1, 2, 3, 7, 8} and got[7] is None and got[8] == 1.0
    for g in range(4):
        assert got[g] == pytest.approx(evaluate.average_precision(df.where(F.col("g") == g)).first()[0], abs=1e-14)


def test_grouped_totals_read_an_aggregate_once(spark):
    """All readings of the aggregated rows are one exchange, so that what lies below (a scoring) runs once."""
    rows = spark.range(400).select(F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(50)) / 50).alias("k"))
    grouped = rows.groupBy("g", "k").agg(F.count(F.lit(1)).alias("n"))
    out = totals_up_to(grouped, F.col("k"), {"upto": "n"}, ["g"])
    assert {r.g for r in out.collect()} == {1, 2, 3, 4}  # no null group
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Range (0, 400") == 1 and "ReusedExchange" in plan
