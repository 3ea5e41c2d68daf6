"""Churn-model training flow over the lifecycle tables (B: matrix -> split -> train -> report).

Fitted models are shared by the ML queries of one session as long as the input files stay the same;
all data stays in DataFrames.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import explain as XP
from cohortlens.models import linear_table
from cohortlens.models import train as T
from cohortlens.operators import decisions, evaluate, features, labels, reports, split, subgroup
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources import sinks
from cohortlens.sources.testdata import LifecycleTables


@dataclass
class TrainingData:
    matrix: DataFrame
    user_splits: DataFrame
    train: DataFrame
    val: DataFrame
    test: DataFrame


def training_data(t: LifecycleTables, train_frac: float = 0.6, val_frac: float = 0.2) -> TrainingData:
    """LB4 matrix, SP2 user split, SP3 membership filters."""
    matrix = labels.prepare_model_matrix(t.users, t.events, t.labels, t.assignments, hot_users=t.hot_users)
    user_splits, _ = split.split_users_and_labels(t.signups, t.labels, train_frac, val_frac)
    parts = {s: split.filter_split(matrix, user_splits, s) for s in (split.TRAIN, split.VALIDATION, split.TEST)}
    return TrainingData(matrix, user_splits, parts[split.TRAIN], parts[split.VALIDATION], parts[split.TEST])


_CACHE: dict[tuple, tuple[TrainingData, T.TrainingResult]] = {}


def _state_of(t: LifecycleTables) -> tuple:
    """What a training depends on: the session and the input files (their bytes, count and time)."""
    spark = t.spark
    found = []
    for name in ("events", "customer", "nation"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{t.sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        size = fs.getContentSummary(path)
        found.append((size.getLength(), size.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return spark.sparkContext.applicationId, t.sf_dir, *found


def trained(t: LifecycleTables, seed: int = config.RANDOM_SEED, gbt_max_iter: int = 500):
    """(TrainingData, TrainingResult) of the tables, shared by the queries of one session as long as
    the input files are the same."""
    k = (*_state_of(t), seed, gbt_max_iter)
    if k not in _CACHE:
        data = training_data(t)
        # materialise the labelled matrix with its split column once in the shared checkpoint
        # folder (training iterates over it); the three parts are filters of that one copy
        ensure_checkpoint_dir(data.train.sparkSession)
        tagged = data.matrix.join(data.user_splits.select("user_id", "split"), "user_id").checkpoint()
        parts = {s: tagged.where(F.col("split") == s).drop("split")
                 for s in (split.TRAIN, split.VALIDATION, split.TEST)}
        data = TrainingData(tagged.drop("split"), data.user_splits, parts[split.TRAIN], parts[split.VALIDATION], parts[split.TEST])
        _CACHE.clear()
        _CACHE[k] = (data, T.train_and_select_model(data.train, data.val, data.test, "f1", seed, gbt_max_iter))
    return _CACHE[k]


@dataclass
class LinearView:
    """The linear candidate as a table, with refined weights and the threshold of its validation scores."""

    weights: list[float]
    table: DataFrame
    threshold: float


def linear_view(result: T.TrainingResult, data: TrainingData) -> LinearView:
    """Computed once a training."""
    if "linear_view" not in vars(result):
        candidate = result.candidates[T.LR]
        weights, constant = linear_table.refined(candidate.pipeline, data.train)
        table = linear_table.model_table(data.train.sparkSession, candidate.spec, weights, constant)
        scored = linear_table.score_by_table(data.val, table, ["user_id", config.TARGET_COLUMN]).withColumnRenamed(config.TARGET_COLUMN, "label")
        result.linear_view = LinearView(weights, table, float(evaluate.select_threshold(scored, "f1").first()["threshold"]))
    return result.linear_view


def model_selection_report(result: T.TrainingResult, spark) -> DataFrame:
    """Candidate validation metrics at 0.5 plus the selected model's validation / test metrics
    at the chosen threshold (one row each)."""
    keys = ["pr_auc", "roc_auc", "log_loss", "brier_score", "threshold", "precision", "recall", "f1_score", "accuracy"]
    rows = [(name, "validation@0.5", False, *[c.at_half.get(k) for k in keys]) for name, c in result.candidates.items()]
    rows.append((result.winner, "validation", True, *[result.on_validation.get(k) for k in keys]))
    rows.append((result.winner, "test", True, *[result.on_test.get(k) for k in keys]))
    schema = "model string, dataset string, selected boolean, " + ", ".join(f"{k} double" for k in keys)
    return spark.createDataFrame(rows, schema)


def score_users(result: T.TrainingResult, t: LifecycleTables, users: DataFrame | None = None,
                threshold: float | None = None, linear: LinearView | None = None) -> DataFrame:
    """NB3: rebuild features from raw tables, score (with the selected model, or with ``linear``), and
    pick the next best action with the score.

    The label never enters: features come from pre-cutoff events only.
    """
    if linear is not None:
        threshold = linear.threshold if threshold is None else threshold
    users = users if users is not None else t.users
    thr = result.threshold if threshold is None else threshold
    feats = features.build_model_features(users, t.events, t.assignments, hot_users=t.hot_users)
    probs = linear_table.score_by_table(feats, linear.table) if linear is not None else T.score(result.model, feats, ["user_id"])
    probs = probs.withColumnRenamed("prob", "predicted_risk")
    nba = decisions.recommend_next_action(users, t.events, probs, score_col="predicted_risk", hot_users=t.hot_users)
    return (probs.join(nba, "user_id")
            .select("user_id", "predicted_risk", (F.col("predicted_risk") >= F.lit(thr)).cast("int").alias("predicted_class"),
                    "action_name", "channel", "reason"))


def nba_examples(result: T.TrainingResult, t: LifecycleTables, test_users: DataFrame, n_examples: int = 10, linear: LinearView | None = None) -> DataFrame:
    """NB4: test users only; the first n // 2 of each predicted class in (signup, user_id) order.

    Each class is a distributed top-k (ordered limit), never a window over a whole class.
    """
    users = t.users.join(test_users.select("user_id"), "user_id", "left_semi")
    scored = score_users(result, t, users, linear=linear).join(users.select("user_id", "signup_timestamp"), "user_id")
    half = n_examples // 2
    high = scored.where(F.col("predicted_class") == 1).orderBy("signup_timestamp", "user_id").limit(half)
    low = scored.where(F.col("predicted_class") == 0).orderBy("signup_timestamp", "user_id").limit(half)
    return high.unionByName(low).drop("signup_timestamp")


def model_roundtrip(result: T.TrainingResult, data: TrainingData) -> DataFrame:
    """IO6: save the selected pipeline under the shared checkpoint folder, reload it and count
    test rows whose probability changed (must be 0)."""
    root = ensure_checkpoint_dir(data.test.sparkSession)
    path = os.path.join(root, "models", uuid.uuid4().hex)
    T.save_model(result.model, path)
    reloaded = T.load_model(path)
    a = T.score(result.model, data.test).withColumnRenamed("prob", "_a")
    b = T.score(reloaded, data.test).withColumnRenamed("prob", "_b")
    j = a.join(b, "user_id", "full_outer")
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("mismatches"))


DISCLAIMER = "Contributions describe this model's score; they are associations in past data, not causes."


def user_report(result: T.TrainingResult, users: DataFrame) -> DataFrame:
    """XP7: explanation of each given labelled user with predicted and actual class and a caveat."""
    explained = XP.explain_users(result.model, result.spec, users)
    actual = users.select("user_id", F.col(config.TARGET_COLUMN).alias("actual_label"))
    return explained.join(actual, "user_id").select(
        "*", (F.col("predicted_risk") >= F.lit(result.threshold)).cast("int").alias("predicted_class"), F.lit(DISCLAIMER).alias("disclaimer"))


def test_scores(result: T.TrainingResult, data: TrainingData, groups: list[str] | None = None) -> DataFrame:
    """The selected model's scores of the test users as (user_id, label, prob, groups): those that the training kept, where it
    kept the groups too."""
    wanted = ["user_id", config.TARGET_COLUMN, *(groups or [])]
    kept = result.tested is not None and set(wanted) <= set(result.tested.columns)
    scored = result.tested.select(*wanted, "prob") if kept else T.score(result.model, data.test, wanted)
    return scored.withColumnRenamed(config.TARGET_COLUMN, "label")


def write_report_set(result: T.TrainingResult, t: LifecycleTables, data: TrainingData, path: str) -> None:
    """IO5: everything a training run reports, one folder each under ``path``: metrics, metadata,
    split, thresholds, subgroups, calibration and curves of the test scores, coefficients or permutation
    importances, user explanations (all test users), a user report and next-best-action examples."""
    spark = t.spark
    scored = test_scores(result, data, list(subgroup.DEFAULT_GROUPS))
    importance = XP.permutation_importance(result.model, result.spec, data.val, result.inputs)
    meta = [(result.winner, result.threshold, config.RANDOM_SEED, len(result.inputs), ",".join(result.inputs))]
    small = {
        "metrics": model_selection_report(result, spark),
        "model_metadata": spark.createDataFrame(meta, "model string, threshold double, seed int, n_features int, features string"),
        "split": split.split_report(data.matrix.join(data.user_splits.select("user_id", "split"), "user_id")),
        "threshold_sweep": evaluate.threshold_sweep(scored),
        "subgroups": subgroup.evaluate_subgroups(scored.withColumnRenamed("label", config.TARGET_COLUMN), result.threshold),
        "calibration": evaluate.calibration(scored),
        "global_explanation": XP.global_explanation(result.model, result.spec, importance),
        "user_report": user_report(result, reports.sample_users(data.test, 3)),
        "nba_examples": nba_examples(result, t, data.test),
    }
    for name, frame in small.items():
        sinks.write_report(frame, f"{path}/{name}")
    for name, frame in (("pr_curve", evaluate.pr_curve(scored)), ("roc_curve", evaluate.roc_curve(scored)),
                        ("user_explanations", XP.explain_users(result.model, result.spec, data.test))):
        sinks.write_report(frame, f"{path}/{name}", single_file=False)
