"""Evaluation (EV), exact distributed ordering helpers and the chronological split (SP)."""

from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from builders import ts
from pyspark.sql import functions as F

from cohortlens.functions.ordered import exact_quantiles, global_rank, running_totals
from cohortlens.operators import evaluate, split, subgroup


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.createDataFrame([("a", 0, 0.1), ("b", 1, 0.4), ("c", 1, 0.8), ("d", 0, 0.4)],
                                 "user_id string, label int, prob double")


def test_metric_bundle(tiny):
    m = evaluate.compute_metrics(tiny, 0.5).first()
    assert m.pr_auc == pytest.approx(0.833333, abs=1e-6)
    assert m.roc_auc == pytest.approx(0.875)
    assert m.brier_score == pytest.approx(0.1425)
    assert m.log_loss == pytest.approx(0.438905, abs=1e-6)
    assert (m.precision, m.recall, m.accuracy) == (1.0, 0.5, 0.75)


def test_confusion(tiny):
    r = evaluate.confusion_counts(tiny, 0.5).first()
    assert (r.true_negative, r.false_positive, r.false_negative, r.true_positive) == (2, 0, 1, 1)


def test_threshold_selection(tiny):
    r = evaluate.select_threshold(tiny, "f1").first()
    assert r.threshold == pytest.approx(0.11) and r.score == pytest.approx(0.8)
    y = evaluate.youden_threshold(tiny).first()
    assert y.threshold == 0.8 and y.score == pytest.approx(0.5)
    with pytest.raises(ValueError):
        evaluate.select_threshold(tiny, "nope")


def test_sweep_matches_naive_grid(spark):
    rng = random.Random(7)
    rows = [(f"u{i}", rng.randint(0, 1), round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "user_id string, label int, prob double")
    grid = np.linspace(0, 1, 101)
    sweep = {r.threshold_index: r for r in evaluate.threshold_sweep(df).collect()}
    y = np.array([r[1] for r in rows])
    p = np.array([r[2] for r in rows])
    for i, t in enumerate(grid):
        pred = p >= t
        assert sweep[i].tp == int((pred & (y == 1)).sum()) and sweep[i].fp == int((pred & (y == 0)).sum())
        assert sweep[i].threshold == float(t)


def test_average_precision_matches_step_formula(spark):
    rng = random.Random(3)
    rows = [(f"u{i}", rng.randint(0, 1), round(rng.random(), 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "user_id string, label int, prob double")
    y = np.array([r[1] for r in rows])
    p = np.array([r[2] for r in rows])
    ap = 0.0
    for s in sorted(set(p), reverse=True):
        sel = p >= s
        tp_s = ((p == s) & (y == 1)).sum()
        ap += tp_s / y.sum() * (y[sel].sum() / sel.sum())
    assert evaluate.average_precision(df).first().pr_auc == pytest.approx(ap, abs=1e-12)
    grouped = df.withColumn("g", F.lit(1)).unionByName(df.withColumn("g", F.lit(2)))
    by = {r.g: r.pr_auc for r in evaluate.average_precision_by(grouped, ["g"]).collect()}
    assert by == {1: pytest.approx(ap, abs=1e-12), 2: pytest.approx(ap, abs=1e-12)}


def test_calibration_matches_quantile_bins(spark):
    rng = random.Random(11)
    rows = [(f"u{i}", rng.randint(0, 1), round(rng.random(), 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "user_id string, label int, prob double")
    p = np.array([r[2] for r in rows])
    y = np.array([r[1] for r in rows])
    edges = np.unique(np.quantile(p, np.linspace(0, 1, 11)))
    bins = np.maximum(1, np.searchsorted(edges, p, side="left"))
    got = {r.bin: r for r in evaluate.calibration(df).collect()}
    for b in np.unique(bins):
        sel = bins == b
        if sel.sum() >= 5:
            assert got[b]["count"] == sel.sum()
            assert got[b].mean_predicted == pytest.approx(p[sel].mean())
            assert got[b].mean_observed == pytest.approx(y[sel].mean())


def test_running_totals_and_quantiles_with_hot_value(spark):
    rng = random.Random(5)
    # a third of the rows share one value: ranks and quantiles must stay exact
    vals = [0.0] * 300 + [round(rng.random() * 10, 3) for _ in range(600)]
    rows = [(i, v, rng.randint(1, 5)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id long, v double, w long")
    out = running_totals(df, [F.col("v").asc(), F.col("id").asc()], {"cw": F.col("w")}, num_partitions=6).collect()
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    cum, expected = 0, {}
    for r in order:
        cum += r[2]
        expected[r[0]] = cum
    assert {r.id: r.cw for r in out} == expected
    ranks = {r.id: r["rank"] for r in global_rank(df, [F.col("v").desc(), F.col("id").asc()]).collect()}
    assert sorted(ranks.values()) == list(range(1, len(rows) + 1))
    qs = [0.0, 0.1, 0.25, 0.3, 0.5, 0.7, 0.9, 1.0]
    got = {r.q: r.quantile for r in exact_quantiles(df, "v", qs).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(np.array(vals), q)), abs=1e-12)


def test_chronological_split_sizes_and_order(spark):
    base = ts("2026-03-01 12:00:00")
    rows = [(f"u{i}", base + timedelta(days=i)) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id string, signup_timestamp timestamp_ntz")
    got = {r.user_id: r.split for r in split.chronological_split(df).collect()}
    assert [got[f"u{i}"] for i in range(10)] == ["train"] * 6 + ["validation"] * 2 + ["test"] * 2
    with pytest.raises(ValueError):
        split.chronological_split(df, 0.8, 0.2)


def test_split_ties_break_by_user_id(spark):
    t = ts("2026-03-01 00:00:00")
    rows = [(f"u{i:02d}", t) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id string, signup_timestamp timestamp_ntz")
    got = {r.user_id: r.split for r in split.chronological_split(df).collect()}
    assert [got[f"u{i:02d}"] for i in range(20)] == ["train"] * 12 + ["validation"] * 4 + ["test"] * 4


def test_subgroups(spark):
    rows = [("u1", "a", "s", "d", 1, 0.9), ("u2", "a", "s", "d", 0, 0.6), ("u3", "b", None, "d", 1, 0.1)]
    df = spark.createDataFrame(rows, "user_id string, acquisition_channel string, career_stage string, "
                                     "device_type string, is_churned int, prob double")
    out = {(r.group_column, r.group_value): r for r in subgroup.evaluate_subgroups(df, 0.5).collect()}
    assert ("career_stage", None) not in out
    a = out[("acquisition_channel", "a")]
    assert (a.sample_size, a.precision, a.recall, a.f1_score, a.predicted_positive_rate) == (2, 0.5, 1.0,
                                                                                              pytest.approx(2 / 3), 1.0)
    assert a.small_sample
    b = out[("acquisition_channel", "b")]
    assert (b.precision, b.recall, b.f1_score) == (0.0, 0.0, 0.0)
