"""The linear model as a table: its weights are the optimum, its scores are the pipeline's, its SQL agrees."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import linear_table as L
from cohortlens.models import preprocess
from cohortlens.models import train as T

CATEGORICAL, NUMERIC = ["color", "shape"], ["size", "age"]


@pytest.fixture(scope="module")
def planted(spark):
    n = 600
    df = spark.range(n).select(
        F.col("id").alias("user_id"),
        F.element_at(F.array(F.lit("red"), F.lit("green"), F.lit(None).cast("string"), F.lit("it's")), (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int")).alias("color"),
        F.when(F.col("id") == 5, "rare").when(F.col("id") % 3 == 0, "round").otherwise("flat").alias("shape"),
        F.when(F.col("id") % 11 != 0, (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 10.0)).alias("size"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)).cast("double").alias("age"))
    logit = F.col("size") * 0.4 - F.col("age") * 0.3 + F.when(F.col("color") == "red", 1.0).otherwise(-0.5)
    chance = F.pmod(F.xxhash64("user_id", F.lit(9)), F.lit(1000)) / 1000.0
    return df.withColumn(config.TARGET_COLUMN, F.coalesce((chance < 1 / (1 + F.exp(-logit))).cast("int"), F.lit(0))).checkpoint()


@pytest.fixture(scope="module")
def fitted(planted):
    spec = preprocess.fit_spec(planted, CATEGORICAL, NUMERIC)
    model = T.fit(T.build_logistic_regression(planted, spec), planted)
    return spec, model, L.refined(model, planted)


def _design(planted, spec, model):
    out = model.transform(planted.withColumn("label", F.col(config.TARGET_COLUMN).cast("double"))).orderBy("user_id").collect()
    return np.array([r["features"].toArray() for r in out]), np.array([r["label"] for r in out]), np.array([float(r["_w"]) for r in out])


def test_refined_weights_leave_no_gradient(planted, fitted):
    spec, model, (weights, constant) = fitted
    x, y, mass = _design(planted, spec, model)
    rest = mass * (y - 1 / (1 + np.exp(-(x @ weights + constant))))
    assert np.abs(x.T @ rest - weights).max() < 1e-10 and abs(rest.sum()) < 1e-10
    own = model.stages[-1]
    before = mass * (y - 1 / (1 + np.exp(-(x @ own.coefficients.toArray() + own.intercept))))
    assert np.abs(x.T @ before - own.coefficients.toArray()).max() > np.abs(x.T @ rest - weights).max()


def test_refining_a_refined_model_stops_at_once(planted, fitted, monkeypatch):
    spec, model, (weights, constant) = fitted
    again, c = L.refined(model, planted, most=50)
    assert np.allclose(again, weights, atol=1e-13) and abs(c - constant) < 1e-13


def test_fit_by_reweighting_is_the_optimum_without_the_optimiser(planted, fitted, monkeypatch, tmp_path):
    spec, by_optimiser, (weights, constant) = fitted
    monkeypatch.setattr(T, "fit", lambda *a: pytest.fail("the optimiser ran"))
    steps, step = [], L.LinearRegression.fit
    monkeypatch.setattr(L.LinearRegression, "fit", lambda self, df: steps.append(1) or step(self, df))
    model = T.fit_logistic_regression(planted, spec)
    own = model.stages[-1]
    assert len(steps) < 15
    assert np.allclose(own.coefficients.toArray(), weights, atol=1e-9) and abs(own.intercept - constant) < 1e-9
    assert np.allclose(own.coefficients.toArray(), by_optimiser.stages[-1].coefficients.toArray(), atol=1e-3)
    T.save_model(model, str(tmp_path / "m"))
    a, b = ({r.user_id: r.prob for r in T.score(m, planted).collect()} for m in (model, T.load_model(str(tmp_path / "m"))))
    assert a == b and len(a) == 600
    assert own.getRegParam() == by_optimiser.stages[-1].getRegParam() and own.getWeightCol() == "_w"


def test_optimiser_takes_what_reweighting_cannot(planted, fitted):
    spec = fitted[0]
    one = planted.withColumn(config.TARGET_COLUMN, F.lit(1))
    assert T.fit_logistic_regression(one, spec).stages[-1].intercept == T.fit(T.build_logistic_regression(one, spec), one).stages[-1].intercept
    early = T.fit_logistic_regression(planted, spec, most=1).stages[-1]  # not converged
    assert list(early.coefficients) == list(fitted[1].stages[-1].coefficients)


def test_a_lost_row_is_no_convergence(spark, planted, fitted):
    """A row whose margin has no variance in doubles but the wrong class must not be dropped in silence."""
    rows = L.weighted_rows(fitted[1], planted)
    slots = len(fitted[2][0])
    far = L.reweighted(fitted[1].stages[-1], rows.where("label = 0"), [0.0] * slots, 800.0, 1, 1e300)
    assert not far.converged


def test_table_scores_as_the_pipeline(planted, fitted):
    spec, model, (weights, constant) = fitted
    table = L.model_table(planted.sparkSession, spec, weights, constant)
    assert [r["feature"] for r in table.orderBy("slot").collect()] == [*spec.feature_names(), "constant"]
    other = planted.limit(40).unionByName(planted.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "color": F.lit("never seen"), "shape": F.lit("never seen"),
                                                                      "size": F.lit(None).cast("double")}))
    mine = {r["user_id"]: r["prob"] for r in L.score_by_table(other, table).collect()}
    theirs = {r["user_id"]: r["prob"] for r in T.score(model, other).collect()}
    assert mine.keys() == theirs.keys() and all(mine[u] == pytest.approx(theirs[u], abs=1e-5) for u in mine)


def test_contributions_add_up_to_the_margin(planted, fitted):
    spec, model, (weights, constant) = fitted
    table = L.model_table(planted.sparkSession, spec, weights, constant)
    x, _, _ = _design(planted, spec, model)
    got = {}
    for r in L.contributions(planted, table).collect():
        assert r["feature"] == [*spec.feature_names(), "constant"][r["slot"]]
        got[r["user_id"], r["slot"]] = r["contribution"]
    for u in (0, 5, 11, 599):
        for k in range(len(weights)):
            assert got.get((u, k), 0.0) == pytest.approx(x[u, k] * weights[k], abs=1e-12)
        assert got[u, len(weights)] == constant


def test_one_class_and_empty_tables(spark, planted, fitted):
    spec, model, (weights, constant) = fitted
    assert L.refined(model, planted.limit(0)) == ([float(w) for w in model.stages[-1].coefficients], model.stages[-1].intercept)
    table = L.model_table(spark, spec, weights, constant)
    assert L.score_by_table(planted.limit(0), table).collect() == []


def test_registered_queries_against_sql(spark):
    import __spark_entry__ as entry
    from oracle_compare import compare, duck

    con = duck("/root/testdata/sf0.001")
    for key in ("lr_scores", "lr_coefficients", "linear_model", "linear_contributions", "user_factors", "linear_decisions", "linear_examples"):
        ok, message = compare(entry.queries()[key](spark, "/root/testdata/sf0.001"), con, entry.oracle_sql()[key])
        assert ok, f"{key}: {message}"
