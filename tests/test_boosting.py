"""Early stopping of the boosted model: the patience rule, and what is kept of an ensemble."""

from __future__ import annotations

import random
import threading

import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import train as T
from cohortlens.models.preprocess import fit_spec


def slow_stop(losses, patience, tolerance=1e-7):
    """The rule told round by round: compare each of the last rounds with the one before them."""
    for now in range(len(losses)):
        if now < patience:
            continue
        reference, better = losses[now - patience], False
        for k in range(now - patience + 1, now + 1):
            better = better or losses[k] + tolerance < reference
        if not better:
            return now + 1
    return None


def test_stopping_round():
    assert T.stopping_round([3, 2, 1], 2) is None
    assert T.stopping_round([3, 2, 2, 2], 2) == 4
    assert T.stopping_round([3, 2, 2.5, 1.9, 2.5, 2.5], 2) == 6  # progress within the patience goes on
    assert T.stopping_round([1.0, 1.0 - 1e-9, 1.0 - 2e-9], 2) == 3  # no progress beyond the tolerance
    assert T.stopping_round([], 10) is None
    rng = random.Random(2)
    for _ in range(300):
        losses = [rng.choice([1.0, 0.9, 0.8, 0.7, 0.7 - 5e-8]) for _ in range(rng.randrange(30))]
        patience = rng.randrange(1, 6)
        assert T.stopping_round(losses, patience) == slow_stop(losses, patience)


@pytest.fixture(scope="module")
def users(spark):
    df = spark.range(700).select(F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.lit("a").alias("channel"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("x"),
                                 (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0).alias("y"))
    chance = F.pmod(F.xxhash64("user_id", F.lit(5)), F.lit(1000)) / 1000.0
    effect = 1 / (1 + F.exp(-(F.col("x") * 6 - 3 + F.col("y"))))
    return df.select("*", (chance < effect).cast("int").alias("planted"), (chance < 0.5).cast("int").alias("noise")).checkpoint()


def _fit(users, target, **options):
    train = users.withColumn(config.TARGET_COLUMN, F.col(target)).drop("planted", "noise")
    return train, T.fit_gradient_boosting(train, fit_spec(train, ["channel"], ["x", "y"], scale=False), **options)


def _losses(train, model, rounds, seed=config.RANDOM_SEED):
    """The holdout's loss after each round of a plain fit of so many rounds."""
    ready = model.stages[1].transform(model.stages[0].transform(train)).withColumn("label", F.col(config.TARGET_COLUMN).cast("double"))
    held = F.pmod(F.xxhash64(F.col("user_id"), F.lit(seed)), F.lit(10)) == 0
    plain = GBTClassifier(maxIter=rounds, stepSize=0.1, maxDepth=5, seed=seed).fit(ready.where(~held).select("features", "label"))
    return [float(x) for x in plain.evaluateEachIteration(ready.where(held).select("features", "label"))]


def test_ensemble_ends_at_the_best_round_before_the_stop(users):
    train, model = _fit(users, "planted", max_iter=64, patience=4, first_rounds=4)
    trees = model.stages[-1].getNumTrees
    losses = _losses(train, model, trees + 8)
    stop = slow_stop(losses, 4)
    kept = losses[:stop]
    assert trees == kept.index(min(kept)) + 1 and 1 < trees < 64
    scored = T.score(model, train, ["user_id", "x"])
    low, high = (scored.where(c).agg(F.avg("prob")).first()[0] for c in ("x < 0.2", "x > 0.8"))
    assert isinstance(model.stages[-1], GBTClassificationModel) and low < 0.3 < 0.7 < high


def test_noise_stops_early(users):
    _, model = _fit(users, "noise", max_iter=64, patience=4, first_rounds=8)
    assert model.stages[-1].getNumTrees <= 8


def test_limit_and_no_holdout(users):
    _, model = _fit(users, "planted", max_iter=3, patience=10)
    assert model.stages[-1].getNumTrees <= 3
    few = users.where(F.pmod(F.xxhash64(F.col("user_id"), F.lit(config.RANDOM_SEED)), F.lit(10)) != 0)
    _, model = _fit(few, "planted", max_iter=2)
    assert model.stages[-1].getNumTrees == 2


def test_fits_are_few_and_the_best_is_cut_out(users, monkeypatch):
    """The kept ensemble comes out of a fit that was there already: the same trees, no fit of its own."""
    fits, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: fits.append(self.getMaxIter()) or fit(self, df))
    train, model = _fit(users, "planted", max_iter=64, patience=4, first_rounds=4)
    last = model.stages[-1]
    assert last.getNumTrees < fits[-1] and fits == [4, 16, 64][:len(fits)]
    monkeypatch.undo()
    ready = model.stages[1].transform(model.stages[0].transform(train)).withColumn("label", F.col(config.TARGET_COLUMN).cast("double"))
    held = F.pmod(F.xxhash64(F.col("user_id"), F.lit(config.RANDOM_SEED)), F.lit(10)) == 0
    plain = GBTClassifier(maxIter=last.getNumTrees, stepSize=0.1, maxDepth=5, seed=config.RANDOM_SEED).fit(ready.where(~held).select("features", "label"))
    assert last.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1] and last.treeWeights == plain.treeWeights


def test_rounds_of_all_fits():
    for first in (1, 4, 24, 31, 100):
        rounds = [first]
        while rounds[-1] < 500:
            rounds.append(T.next_rounds(rounds[-1], 500))
        assert rounds[-1] == 500 and sum(rounds) <= 500 * 4 / 3 + first


def test_iterative_fits_read_few_partitions(users, monkeypatch):
    cores = users.sparkSession.sparkContext.defaultParallelism
    many = users.repartition(10 * cores)
    assert T.packed(many).rdd.getNumPartitions() == cores and T.packed(many).count() == users.count()
    assert T.packed(users.coalesce(1).checkpoint()).rdd.getNumPartitions() == 1
    monkeypatch.setattr(T, "ROWS_A_TASK", 50)
    assert T.packed(many).rdd.getNumPartitions() == max(cores, 14)
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    monkeypatch.setattr(T, "ROWS_A_TASK", 1000)
    _fit(many, "planted", max_iter=2)
    assert seen == [cores]


def test_steady_progress_goes_to_all_rounds_at_once(users, monkeypatch):
    falling = [1.0 - 0.01 * i for i in range(24)]
    assert T.steady(falling, 10) and not T.steady(falling[:20], 10)
    assert not T.steady([*falling[:12], falling[11], *falling[12:]], 10) and not T.steady([1.0 - 1e-9 * i for i in range(24)], 10)
    assert T.next_rounds(24, 500, True) == 500 and T.next_rounds(24, 500) == 96
    fits, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: fits.append(self.getMaxIter()) or fit(self, df))
    _fit(users.withColumn("plain", (F.col("x") > 0.5).cast("int")), "plain", max_iter=40, patience=1, first_rounds=4)
    assert fits == [4, 40]  # a rule that the trees find: each round is better; 4, 40 without 16 between


def test_idle_cores_get_rows(users, monkeypatch):
    cores = users.sparkSession.sparkContext.defaultParallelism
    one = users.coalesce(1).checkpoint()
    monkeypatch.setattr(T, "ROWS_WORTH_A_TASK", 300)
    assert T.packed(one).rdd.getNumPartitions() == min(2, cores)
    monkeypatch.setattr(T, "ROWS_WORTH_A_TASK", 10)
    assert T.packed(one).rdd.getNumPartitions() == cores
    assert sorted(r.user_id for r in T.packed(one).collect()) == sorted(r.user_id for r in users.collect())
    monkeypatch.setattr(T, "ROWS_A_TASK", 50)
    assert T.packed(one).rdd.getNumPartitions() == max(cores, 14)


def test_validation_scores_are_computed_once(users, monkeypatch):
    """Metrics and threshold read kept scores: none of their plans scores a row."""
    from cohortlens.operators import evaluate
    monkeypatch.setattr(T, "fit_spec", lambda train, **o: fit_spec(train, ["channel"], ["x", "y"], **o))
    data = users.withColumn(config.TARGET_COLUMN, F.col("planted")).drop("planted", "noise")
    plans, metrics = [], evaluate.compute_metrics
    monkeypatch.setattr(evaluate, "compute_metrics", lambda scored, t, *a: plans.append(scored._jdf.queryExecution().optimizedPlan().toString()) or metrics(scored, t, *a))
    T.train_and_select_model(data, data.where("x < 0.7"), data, gbt_max_iter=2)
    assert len(plans) == 4 and not any("UDF" in p for p in plans[:3])


def _small_training(users, monkeypatch):
    monkeypatch.setattr(T, "fit_spec", lambda train, **o: fit_spec(train, ["channel"], ["x", "y"], **o))
    data = users.withColumn(config.TARGET_COLUMN, F.col("planted")).drop("planted", "noise")
    return data.select("*", *[F.when(F.col("x") < 0.5, "a").alias(c) for c in ("acquisition_channel", "career_stage", "device_type")])


def test_candidates_train_at_the_same_time(users, monkeypatch):
    """Each waits for the start of the other: one after the other, the first would wait in vain."""
    data, begun = _small_training(users, monkeypatch), {name: threading.Event() for name in (T.LR, T.GBT)}

    def meeting(fit, name, other):
        def run(*args):
            begun[name].set()
            assert begun[other].wait(60)
            return fit(*args)
        return run

    monkeypatch.setattr(T, "fit_logistic_regression", meeting(T.fit_logistic_regression, T.LR, T.GBT))
    monkeypatch.setattr(T, "fit_gradient_boosting", meeting(T.fit_gradient_boosting, T.GBT, T.LR))
    result = T.train_and_select_model(data, data.where("x < 0.7"), data, gbt_max_iter=2)
    assert list(result.candidates) == [T.LR, T.GBT] and all(0 < c.average_precision <= 1 for c in result.candidates.values())


def test_a_failing_candidate_is_raised(users, monkeypatch):
    data = _small_training(users, monkeypatch)
    monkeypatch.setattr(T, "fit_logistic_regression", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        T.train_and_select_model(data, data.where("x < 0.7"), data, gbt_max_iter=2)


def test_test_is_scored_once(users, monkeypatch):
    """Metrics and reports read the kept scores of test: no plan of theirs scores a row, and the rows are those of a new score."""
    from cohortlens.operators import evaluate, subgroup
    from cohortlens.plans import training
    data = _small_training(users, monkeypatch)
    plans, metrics = [], evaluate.compute_metrics
    monkeypatch.setattr(evaluate, "compute_metrics", lambda scored, t, *a: plans.append(scored._jdf.queryExecution().optimizedPlan().toString()) or metrics(scored, t, *a))
    result = T.train_and_select_model(data, data.where("x < 0.7"), data, gbt_max_iter=2)
    assert len(plans) == 4 and not any("UDF" in p for p in plans)
    parts = training.TrainingData(data, data.select("user_id"), data, data, data)
    for groups in (None, list(subgroup.DEFAULT_GROUPS), ["x"]):  # x is not kept: scored anew
        found = training.test_scores(result, parts, groups)
        assert ("UDF" in found._jdf.queryExecution().optimizedPlan().toString()) == (groups == ["x"])
        new = T.score(result.model, data, ["user_id", config.TARGET_COLUMN, *(groups or [])])
        assert found.columns == ["user_id", "label", *(groups or []), "prob"] and sorted(found.collect()) == sorted(new.collect())
