"""Empty groups, single classes, missing columns, dirty rows, restarts: nothing crashes or is lost."""

from __future__ import annotations

import os
import tempfile

import pytest
from builders import make_events, make_users, ts
from pyspark.sql import functions as F

from cohortlens import config, session
from cohortlens.functions.stats import two_proportion_z_test
from cohortlens.operators import evaluate, experiment, quality
from cohortlens.sources import readers, sinks
from cohortlens.streaming import ingest

S = ts("2026-03-04 05:00:00")


@pytest.fixture(scope="module")
def tables(spark):
    users = make_users(spark, [{"user_id": f"u{i}", "signup_timestamp": S} for i in range(6)])
    events = make_events(spark, [{"user_id": f"u{i}", "event_name": "signup", "event_timestamp": S} for i in range(6)])
    assignments = spark.createDataFrame(
        [(config.ONBOARDING_EXPERIMENT_ID, f"u{i}", v, 0.4) for i, v in enumerate(["control", "personalized", None, "mystery", "control", "simplified"])]
        + [(None, "u0", "control", 0.4)], "experiment_id string, user_id string, variant_id string, traffic_allocation double")
    return users, events, assignments


@pytest.mark.parametrize("label", [0, 1])
def test_single_class_scores(spark, label):
    scored = spark.createDataFrame([(label, 0.2), (label, 0.7)], "label int, prob double")
    bundle = evaluate.compute_metrics(scored, 0.5).first()
    assert bundle.roc_auc is None and (bundle.pr_auc is None) == (label == 0)
    assert evaluate.roc_auc(scored).first()[0] is None
    assert (evaluate.average_precision(scored).first()[0] is None) == (label == 0)
    assert evaluate.youden_threshold(scored).first().threshold == float("inf")
    assert evaluate.threshold_sweep(scored).count() == 101 and evaluate.calibration(scored, min_count=1).count() == 2


def test_no_scores_at_all(spark):
    none = spark.createDataFrame([], "label int, prob double")
    assert evaluate.compute_metrics(none, 0.5).first().log_loss is None
    assert evaluate.average_precision(none).first()[0] is None and evaluate.calibration(none).collect() == []


def test_one_pass_bundle_equals_its_parts(spark):
    rows = [(i * 7 % 3 == 0, round((i * 37 % 100) / 100, 2)) for i in range(200)]
    scored = spark.createDataFrame([(int(y), p) for y, p in rows], "label int, prob double")
    bundle = evaluate.compute_metrics(scored, 0.4).first()
    parts = {**evaluate.probability_scores(scored).first().asDict(), **evaluate.threshold_metrics(scored, 0.4).first().asDict(),
             **evaluate.average_precision(scored).first().asDict(), **evaluate.roc_auc(scored).first().asDict()}
    assert all(bundle[k] == pytest.approx(v) for k, v in parts.items())


def test_curve_ends(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.4)], "label int, prob double")
    end = evaluate.pr_curve(scored).where("threshold IS NULL").first()
    assert (end.precision, end.recall) == (1.0, 0.0)
    assert evaluate.roc_curve(scored).first()[:] == (float("inf"), 0.0, 0.0)


def test_empty_groups_in_experiments(spark, tables):
    users, events, assignments = tables
    rows = experiment.analyze_experiment(users, events, assignments, control_variant="absent").collect()
    assert rows and all(r.p_value is None for r in rows)
    found = experiment.srm_test(assignments, "no such experiment").first()
    assert found.n == 0 and found.p_value is None
    z = two_proportion_z_test(F.lit(0), F.lit(0), F.lit(1), F.lit(2))
    assert spark.range(1).select(z["z"], z["p_value"]).first()[:] == (None, None)


def test_report_on_dirty_and_empty_tables(spark, tables):
    users, events, assignments = tables
    report = {r.check: r for r in quality.validate(users, events, assignments).collect()}
    srm = report[f"srm_{config.ONBOARDING_EXPERIMENT_ID}"]
    assert srm.violations == 2 and not srm.passed and "srm_null" in report  # a null and an unknown variant
    empty = {r.check: r for r in quality.validate(users.limit(0), events.limit(0), assignments.limit(0)).collect()}
    assert empty["unique_event_ids"].violations == 0 and empty["event_properties_missing_rate"].value is None


def test_missing_columns_are_reported(spark, tables):
    users, events, assignments = tables
    report = {r.check: r for r in quality.validate(users.drop("acquisition_channel"), events.drop("platform", "event_id"), assignments).collect()}
    assert not report["users_columns"].passed and "acquisition_channel" in report["users_columns"].detail
    assert report["events_columns"].violations == 2 and "platform_domain" not in report
    assert quality.validate(users.drop("user_id"), events.drop("user_id"), assignments).count() > 5


def test_offending_values(spark):
    df = spark.createDataFrame([("web",), ("fridge",), ("fridge",), (None,)], "platform string")
    assert [r[1:] for r in quality.offending_values(df, "platform", config.PLATFORMS).collect()] == [("fridge", 2), (None, 1)]


def test_offsets_are_converted(spark):
    df = spark.createDataFrame([("2026-03-01T00:00:00+08:00",), ("2026-03-01T00:00:00Z",), ("2026-03-01 00:00:00",), ("2026-03-01T00:00:00-0530",), (None,)], "t string")
    assert [r.t for r in readers.coerce_timestamps(df, ["t"]).collect()] == [
        ts("2026-02-28 16:00:00"), ts("2026-03-01 00:00:00"), ts("2026-03-01 00:00:00"), ts("2026-03-01 05:30:00"), None]


def test_ingest_goes_on_after_a_restart(spark):
    folder = tempfile.mkdtemp(prefix="cohortlens-restart-")
    source, sink = os.path.join(folder, "in"), os.path.join(folder, "out")

    def add(n):
        make_events(spark, [{"user_id": f"u{n}", "event_name": "signup", "event_timestamp": S}]).write.mode("append").parquet(source)

    before = spark.sparkContext.getCheckpointDir()
    for n in range(3):  # each run has a checkpoint folder of its own, as a new application would
        add(n)
        spark.sparkContext.setCheckpointDir(os.path.join(folder, f"app{n}"))
        ingest.ingest_events(spark, source, sink, once=True).awaitTermination(120)
    spark.sparkContext.setCheckpointDir(os.path.dirname(before))
    assert spark.read.parquet(sink).count() == spark.read.parquet(source).count() == 3


def test_events_sink_splits_a_busy_day(spark):
    folder = tempfile.mkdtemp(prefix="cohortlens-days-")
    events = make_events(spark, [{"user_id": "u1", "event_name": "signup", "event_timestamp": S}])
    sinks.write_events(events, folder)
    assert spark.read.parquet(folder).count() == 1
    plan = events.hint("rebalance", "event_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_building_a_query_only_reads_schemas(spark):
    import __spark_entry__ as entry

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        plan = entry.queries()["funnel"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one footer read for each of the three tables, and the real plan
    assert len(tracker.getJobIdsForGroup("building")) <= 3 and "events.parquet" in plan and "HashAggregate" in plan
