"""Churn model training, scoring, persistence and selection (ML4-ML8, IO6).

Both candidates are Spark ML pipelines (preprocessing + classifier); fitting runs distributed
(a few jobs per step / boosting round); every metric is a DataFrame computation
from :mod:`cohortlens.operators.evaluate`. Only small scalars (counts, metric values, the chosen
threshold) reach the driver, to drive model selection.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import linear_table
from cohortlens.models.preprocess import PreprocessSpec, build_preprocessor, drop_slots, fit_spec, unscaled
from cohortlens.operators import evaluate, subgroup
from cohortlens.session import ensure_checkpoint_dir

LR, GBT = "logistic_regression", "hist_gradient_boosting"


def feature_columns(df: DataFrame) -> list[str]:
    """ML7: every column except ids and the target."""
    return [c for c in df.columns if c not in config.ID_COLUMNS and c != config.TARGET_COLUMN]


ROWS_A_TASK = 200_000  # rows of slots that one task of an iteration reads at most, where the cores are too few
ROWS_WORTH_A_TASK = 25_000  # fewer rows are not spread further


def packed(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the cluster has cores, or more where a partition would get over
    ``ROWS_A_TASK`` rows. An iterative fit runs one task a partition and a level or step, so a shuffle's many
    small partitions cost more than the rows in them, and fewer partitions than cores leave cores idle in every
    round: these are spread, unless they hold few rows."""
    rows, cores, has = df.count(), df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    parts = max(cores, -(-rows // ROWS_A_TASK))
    if has >= parts:
        return df.coalesce(parts)
    worth = min(parts, rows // ROWS_WORTH_A_TASK)
    return df.repartition(worth) if worth > has else df


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col(config.TARGET_COLUMN).cast("double"))


def build_logistic_regression(train: DataFrame, spec: PreprocessSpec | None = None) -> Pipeline:
    """ML4: balanced class weights n / (2 n_class), L2 with C = 1.

    The weighted sum of losses + ||b||^2 / 2 equals Spark's weighted mean loss + regParam ||b||^2 / 2
    with regParam = 1 / sum(weights) = 1 / n; features arrive standardised, so standardization is
    off to keep the penalty on the same scale.
    """
    spec = spec or fit_spec(train, scale=True)
    counts = {r[0]: r[1] for r in train.groupBy(config.TARGET_COLUMN).count().collect()}  # two rows
    n = sum(counts.values())
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    w_pos = n / (2.0 * n_pos) if n_pos else 0.0
    w_neg = n / (2.0 * n_neg) if n_neg else 0.0
    from pyspark.ml.feature import SQLTransformer

    weights = SQLTransformer(statement=f"SELECT *, CASE WHEN `{config.TARGET_COLUMN}` = 1 THEN {w_pos!r} "
                                       f"ELSE {w_neg!r} END AS _w FROM __THIS__")
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="_w", regParam=1.0 / max(n, 1),
                            elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-13, family="binomial")
    pre = build_preprocessor(spec)
    return Pipeline(stages=[*pre.getStages(), weights, lr])


def stopping_round(losses: list[float], patience: int, tolerance: float = 1e-7) -> int | None:
    """The first round (counted from 1) after which none of the last ``patience`` losses is better, by more
    than the tolerance, than the one before them; None if there is none yet."""
    for end in range(patience + 1, len(losses) + 1):
        before = losses[end - patience - 1]
        if not any(loss < before - tolerance for loss in losses[end - patience:end]):
            return end
    return None


def steady(losses: list[float], patience: int, tolerance: float = 1e-7) -> bool:
    """Whether every one of more than twice ``patience`` rounds was better than the one before it, by more than the
    tolerance: no sign of a stop yet."""
    return len(losses) > 2 * patience and all(b < a - tolerance for a, b in zip(losses, losses[1:]))


def next_rounds(rounds: int, most: int, no_sign: bool = False) -> int:
    """How many rounds to fit after a fit without a stop: all of them where there was ``no_sign`` of one. Every fit
    begins anew, so all fits together have at most a third more rounds than ``most`` and those of the first."""
    return 4 * rounds if 16 * rounds <= most and not no_sign else most


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble of the first rounds of a fit: what a fit of so many rounds gives, as nothing in a fit is
    drawn by chance."""
    fitted = model._java_obj
    jvm = SparkSession.getActiveSession()._jvm
    gateway = SparkSession.getActiveSession().sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(fitted.trees()[:rounds], fitted.treeWeights()[:rounds])):
        trees[i], weights[i] = tree, weight
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(fitted.uid(), trees, weights))
    return model._copyValues(cut, {cut.getParam("maxIter"): rounds})


def fit_gradient_boosting(train: DataFrame, spec: PreprocessSpec | None = None, seed: int = config.RANDOM_SEED, max_iter: int = 500,
                          validation_fraction: float = 0.1, patience: int = 10, first_rounds: int = 24) -> PipelineModel:
    """ML5: boosted trees with early stopping on a deterministic ~10% hash holdout of users.

    A fit of some rounds gives the holdout's loss after each; while ``patience`` rounds without progress
    are not among them, four times as many are fitted, but all ``max_iter`` where those are not many more or
    where every round so far made progress. The
    ensemble that is kept ends at the best round before the stop and is cut out of that fit. Without a holdout
    (few users) all ``max_iter`` rounds stay.
    """
    spec = spec or fit_spec(train, scale=False)
    pre = build_preprocessor(spec).fit(train)
    ensure_checkpoint_dir(train.sparkSession)
    buckets = int(round(1.0 / validation_fraction))
    held_out = F.pmod(F.xxhash64(F.col("user_id").cast("string"), F.lit(seed)), F.lit(buckets)) == 0
    ready = drop_slots(pre.transform(_labelled(packed(train)))).select("features", "label", held_out.alias("held_out")).checkpoint()  # read by every round
    fitting, holdout = ready.where("NOT held_out"), ready.where("held_out")

    def boosted(rounds: int) -> GBTClassificationModel:
        return GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=0.1, maxDepth=5, seed=seed).fit(fitting)

    rounds = max_iter if holdout.isEmpty() else min(first_rounds, max_iter)
    model = boosted(rounds)
    if not holdout.isEmpty():
        while True:
            losses = [float(x) for x in model.evaluateEachIteration(holdout)]
            stop = stopping_round(losses, patience)
            if stop is not None or rounds >= max_iter:
                break
            rounds = next_rounds(rounds, max_iter, steady(losses, patience))
            model = boosted(rounds)
        kept = losses[:stop]
        best = kept.index(min(kept)) + 1
        if best < rounds:
            model = first_trees(model, best)
    return PipelineModel([*pre.stages, model])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    return pipeline.fit(_labelled(packed(train)))


def fit_logistic_regression(train: DataFrame, spec: PreprocessSpec | None = None, most: int = 30, tolerance: float = 1e-7) -> PipelineModel:
    """ML4 at the optimum of its objective, by reweighted least squares from weights of zero: some ten steps that each add
    up one matrix of slots by slots, where the optimiser of :func:`build_logistic_regression` runs a job for each
    of many hundred steps (a slot for every level and a constant: badly conditioned). The step within the tolerance is
    the last; what it leaves is of the tolerance's square. That optimiser is left the tables
    of one class and those where the steps do not converge."""
    spec = spec or fit_spec(train, scale=True)
    pipeline = build_logistic_regression(train, spec)
    *stages, lr = pipeline.getStages()
    label = F.col(config.TARGET_COLUMN)
    classes = train.agg(F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg"), F.count(F.lit(1)).alias("n")).first()
    if classes["pos"] and classes["neg"] and classes["pos"] + classes["neg"] == classes["n"]:
        pre = Pipeline(stages=stages).fit(train)
        rows = linear_table.weighted_rows(pre, packed(train))
        found = linear_table.reweighted(lr, rows, [0.0] * len(spec.slot_columns()), 0.0, most, tolerance)
        if found.converged:
            return PipelineModel([*pre.stages, linear_table.with_weights(lr, found.weights, found.constant)])
    return fit(pipeline, train)


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """ML8: probability of class 1 as ``prob`` (plus the requested passthrough columns)."""
    keep = keep or ["user_id"]
    src = df if config.TARGET_COLUMN in df.columns else df.withColumn(config.TARGET_COLUMN, F.lit(0))
    out = model.transform(_labelled(src))
    return drop_slots(out).select(*keep, vector_to_array("probability")[1].alias("prob"))


def save_model(model: PipelineModel, path: str) -> None:
    """IO6: persist a fitted pipeline (predictions are identical after :func:`load_model`)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class Candidate:
    """A fitted pipeline with its preprocessing and its validation metrics at 0.5."""

    pipeline: PipelineModel
    spec: PreprocessSpec
    at_half: dict[str, float]

    @property
    def average_precision(self) -> float:
        found = self.at_half.get("pr_auc")
        return float("-inf") if found is None else found


@dataclass
class TrainingResult:
    """The candidates by name, which one won, its threshold and its metrics at that threshold."""

    candidates: dict[str, Candidate]
    winner: str
    threshold: float
    on_validation: dict[str, float]
    on_test: dict[str, float]
    inputs: list[str]
    tested: DataFrame | None = field(default=None, repr=False)  # the winner's kept scores of test: ids, target, prob, groups

    @property
    def model(self) -> PipelineModel:
        return self.candidates[self.winner].pipeline

    @property
    def spec(self) -> PreprocessSpec:
        return self.candidates[self.winner].spec


def _metrics_dict(scored: DataFrame, threshold: float) -> dict[str, float]:
    return evaluate.compute_metrics(scored.withColumnRenamed(config.TARGET_COLUMN, "label"), threshold).first().asDict()


def train_and_select_model(train: DataFrame, val: DataFrame, test: DataFrame, threshold_criterion: str = "f1",
                           seed: int = config.RANDOM_SEED, gbt_max_iter: int = 500) -> TrainingResult:
    """ML6: both candidates are fitted and scored on validation, the better average precision wins
    (the linear one at a tie), its threshold follows from the same scores, and test is scored once.

    The candidates are trained at the same time: a boosting round waits for its small jobs more than it computes, and
    the linear steps run on the cores that it leaves idle."""
    if train.isEmpty() or val.isEmpty():
        raise ValueError("training needs labelled users in the train and validation parts")
    keep = ["user_id", config.TARGET_COLUMN]
    linear = fit_spec(train, scale=True)
    specs = {LR: linear, GBT: unscaled(linear)}
    ensure_checkpoint_dir(val.sparkSession)

    def trained(name: str, fitted: PipelineModel) -> tuple[Candidate, DataFrame]:
        scored = score(fitted, val, keep).checkpoint()  # read by up to three reports
        return Candidate(fitted, specs[name], _metrics_dict(scored, 0.5)), scored

    with ThreadPoolExecutor(1) as beside:
        side = beside.submit(inheritable_thread_target(train.sparkSession)(lambda: trained(LR, fit_logistic_regression(train, specs[LR]))))
        boosted = trained(GBT, fit_gradient_boosting(train, specs[GBT], seed, gbt_max_iter))
        both = {LR: side.result(), GBT: boosted}
    candidates = {name: candidate for name, (candidate, _) in both.items()}
    winner = max(candidates, key=lambda name: candidates[name].average_precision)  # the first of equals
    scored = both[winner][1]
    threshold = float(evaluate.select_threshold(scored.withColumnRenamed(config.TARGET_COLUMN, "label"), threshold_criterion).first()["threshold"])
    groups = [c for c in subgroup.DEFAULT_GROUPS if c in test.columns]
    tested = score(candidates[winner].pipeline, test, [*keep, *groups]).checkpoint()  # read by the metrics and the reports on test
    return TrainingResult(candidates, winner, threshold, _metrics_dict(scored, threshold), _metrics_dict(tested.drop(*groups), threshold),
                          feature_columns(train), tested)
