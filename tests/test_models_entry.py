"""Model contracts (ML, IO6, XP), adapter reference numbers and the driver entry points."""

from __future__ import annotations

import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import explain as XP
from cohortlens.models import train as ML
from cohortlens.models.preprocess import fit_spec
from cohortlens.sources import testdata

CATS = ["acquisition_channel"]
NUMS = ["num_sessions", "hours_to_first_action"]


@pytest.fixture(scope="module")
def planted(spark):
    """Small matrix with a planted effect: more sessions -> less churn; one rare channel."""
    rng = random.Random(1)
    rows = []
    for i in range(400):
        sessions = rng.randint(0, 6)
        channel = "rare" if i == 0 else rng.choice(["organic_search", "referral"])
        hours = None if i % 17 == 0 else rng.random() * 100
        p = 1 / (1 + np.exp(-(1.5 - 0.8 * sessions + (0.7 if channel == "referral" else 0.0))))
        rows.append((f"u{i:03d}", channel, float(sessions), hours, int(rng.random() < p)))
    return spark.createDataFrame(rows, "user_id string, acquisition_channel string, num_sessions double, "
                                       "hours_to_first_action double, is_churned int")


def _newton_reference(x: np.ndarray, y: np.ndarray, w: np.ndarray, c: float = 1.0) -> np.ndarray:
    """Minimise C * sum w_i logloss_i + ||beta||^2 / 2 (intercept unpenalised) by Newton steps."""
    xa = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(xa.shape[1])
    pen = np.eye(xa.shape[1])
    pen[-1, -1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-xa @ beta))
        grad = c * xa.T @ (w * (p - y)) + pen @ beta
        hess = c * (xa * (w * p * (1 - p))[:, None]).T @ xa + pen
        beta -= np.linalg.solve(hess, grad)
    return beta


def test_preprocess_spec(planted):
    spec = fit_spec(planted, CATS, NUMS)
    assert spec.categories["acquisition_channel"] == ["organic_search", "referral"]
    assert spec.has_infrequent["acquisition_channel"]  # 'rare' is 1 of 400 < 1%
    vals = sorted(r[0] for r in planted.select("hours_to_first_action").collect() if r[0] is not None)
    assert spec.medians["hours_to_first_action"] == pytest.approx(float(np.median(vals)))
    assert spec.feature_names()[-2:] == ["num__num_sessions", "num__hours_to_first_action"]


def test_logistic_regression_matches_reference_objective(planted):
    spec = fit_spec(planted, CATS, NUMS)
    model = ML.fit(ML.build_logistic_regression(planted, spec), planted)
    coefs = np.array(list(model.stages[-1].coefficients) + [model.stages[-1].intercept])
    xs = XP.transformed(model, planted.withColumn("_w", F.lit(1.0)).withColumn("label", F.lit(0.0)))
    data = [(list(r.features.toArray()), r.is_churned) for r in xs.orderBy("user_id").collect()]
    x = np.array([d[0] for d in data])
    y = np.array([d[1] for d in data], dtype=float)
    n, n_pos = len(y), y.sum()
    w = np.where(y == 1, n / (2 * n_pos), n / (2 * (n - n_pos)))
    ref = _newton_reference(x, y, w)
    assert np.max(np.abs(coefs - ref)) < 1e-4


def test_gbt_contract_and_roundtrip(spark, planted):
    spec = fit_spec(planted, CATS, NUMS, scale=False)
    model = ML.fit_gradient_boosting(planted, spec, max_iter=20)
    a = {r.user_id: r.prob for r in ML.score(model, planted).collect()}
    assert all(0.0 <= p <= 1.0 for p in a.values())
    model2 = ML.fit_gradient_boosting(planted, spec, max_iter=20)
    assert a == {r.user_id: r.prob for r in ML.score(model2, planted).collect()}  # deterministic for a seed
    path = os.path.join(tempfile.mkdtemp(prefix="cohortlens-model-"), "gbt")
    ML.save_model(model, path)
    assert a == {r.user_id: r.prob for r in ML.score(ML.load_model(path), planted).collect()}


def test_linear_explanations(planted):
    spec = fit_spec(planted, CATS, NUMS)
    model = ML.fit(ML.build_logistic_regression(planted, spec), planted)
    out = XP.explain_linear(model, spec, planted.limit(20), top_n=2).collect()
    assert len(out) == 20
    for r in out:
        pos = [f.contribution for f in r.positive_factors]
        neg = [f.contribution for f in r.negative_factors]
        assert len(pos) <= 2 and all(c > 0 for c in pos) and pos == sorted(pos, reverse=True)
        assert len(neg) <= 2 and all(c < 0 for c in neg) and neg == sorted(neg)
        assert 0.0 <= r.predicted_risk <= 1.0


def test_permutation_importance_shapes(planted):
    spec = fit_spec(planted, CATS, NUMS)
    model = ML.fit(ML.build_logistic_regression(planted, spec), planted)
    imp = XP.permutation_importance(model, spec, planted, CATS + NUMS, n_repeats=3).collect()
    assert sorted(r.feature for r in imp) == sorted(CATS + NUMS)
    assert imp[0].feature == "num_sessions"  # the planted driver matters most
    assert all(r.importance_std >= 0 for r in imp)


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_permutation_by_parts_sent_to_their_askers(spark, planted, n):
    """Boosted model: every row gets its donor's part, as told by shuffling the input column row by row."""
    spec = fit_spec(planted, CATS, NUMS, scale=False)
    model = ML.fit_gradient_boosting(planted, spec, max_iter=3)
    val = planted.orderBy("user_id").limit(n)
    got = XP.permutation_importance(model, spec, val, CATS + NUMS, n_repeats=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=shuffle_hash" in plan
    got = {r.feature: (r.importance_mean, r.importance_std) for r in got.collect()}
    order = F.struct(F.xxhash64("user_id", F.lit(config.RANDOM_SEED)), F.col("user_id"))
    rows = [r.asDict() for r in val.orderBy(order).collect()]
    rng = random.Random(config.RANDOM_SEED)

    def precision(table):
        scored = ML.score(model, spark.createDataFrame(table, planted.schema), ["is_churned"]).collect()
        total, area = sum(r.is_churned for r in scored), 0.0
        if not total:
            return None
        for p in sorted({r.prob for r in scored}):
            above = [r.is_churned for r in scored if r.prob >= p]
            area += sum(r.is_churned for r in scored if r.prob == p) / total * (sum(above) / len(above))
        return area

    base = precision([tuple(r.values()) for r in rows])
    for f in CATS + NUMS:
        drops = []
        for _ in range(2):
            a, b = XP._coprime_multiplier(rng, n), rng.randrange(0, n)
            assert a * XP._inverse(a, n) % n == 1 % n
            drops.append([tuple({**r, f: rows[(a * i + b) % n][f]}.values()) for i, r in enumerate(rows)])
        found = [precision(d) for d in drops]
        if base is None:
            assert got[f] == (None, None)
        else:
            assert got[f][0] == pytest.approx(float(np.mean([base - p for p in found])), abs=1e-9)
            assert got[f][1] == pytest.approx(float(np.std([base - p for p in found])), abs=1e-9)


def test_adapter_against_the_raw_log(spark):
    """Users, first actions and labels at sf0.01 against statements on the raw log."""
    import duckdb

    con = duckdb.connect()
    con.execute("""CREATE VIEW r AS SELECT *, user_id * 10 + CASE WHEN k % 10 >= 8 THEN k % 10 ELSE 0 END AS entity FROM (
                   SELECT *, json_extract_string(props, '$.k')::INT AS k FROM '/root/testdata/sf0.01/events.parquet')""")
    t = testdata.load(spark, "/root/testdata/sf0.01")
    users = {r.user_id: r.signup_timestamp for r in t.users.select("user_id", "signup_timestamp").collect()}
    assert users == dict(con.sql("SELECT entity, min(ts) FROM r GROUP BY entity").fetchall())
    system = con.execute("SELECT count(*) FILTER (event_type = 'error'), count(*) FILTER (event_type = 'click' AND k >= 70) FROM r").fetchone()
    got = {r.event_source: r.n for r in t.events.groupBy("event_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert (got["system"], got["campaign"]) == system
    freeze = con.execute("SELECT max(ts)::DATE FROM r").fetchone()[0]
    labelled = con.execute(f"SELECT count(*) FROM (SELECT entity, min(ts) AS s FROM r GROUP BY entity) WHERE s + INTERVAL 21 DAY < DATE '{freeze}' + INTERVAL 1 DAY").fetchone()[0]
    assert t.labels.count() == labelled
    # the whole lifecycle occurs: every event name, every rule, all seven funnel steps
    assert {r[0] for r in t.events.select("event_name").distinct().collect()} == set(config.ALL_EVENT_NAMES)
    matrix = __import__("__spark_entry__").queries()["feature_matrix"](spark, "/root/testdata/sf0.01").toPandas()
    assert [c for c in matrix if matrix[c].nunique(dropna=False) < 2] == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["step", "users", "conversion_rate", "drop_off_rate", "acquisition_channel"]
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 60
    from oracle_compare import compare, duck

    con = duck("/root/testdata/sf0.001")
    for key in ["funnel", "retention_summary", "experiment_metrics", "feature_matrix", "dq_report", "calibration"]:
        ok, msg = compare(qs[key](spark, "/root/testdata/sf0.001"), con, sqls[key])
        assert ok, f"{key}: {msg}"


def test_unseen_and_rare_categories(spark, planted):
    """ML1: unseen values, a null among them, go to the infrequent slot when it exists, else all zeros."""
    from cohortlens.models.preprocess import fit_preprocessor, drop_slots

    spec = fit_spec(planted, CATS, NUMS)
    pre = fit_preprocessor(planted, spec)
    names = spec.feature_names()
    probe = spark.createDataFrame([("a", "brand_new", 1.0, None), ("b", None, 2.0, 3.0), ("c", "referral", 0.0, 1.0)],
                                  "user_id string, acquisition_channel string, num_sessions double, "
                                  "hours_to_first_action double")
    rows = {r.user_id: list(r.features.toArray()) for r in drop_slots(pre.transform(probe)).collect()}
    slot = {n: i for i, n in enumerate(names)}
    assert rows["a"][slot["cat__acquisition_channel_infrequent_sklearn"]] == 1.0
    assert rows["b"][slot["cat__acquisition_channel_infrequent_sklearn"]] == 1.0
    assert rows["c"][slot["cat__acquisition_channel_referral"]] == 1.0
    # a frequent null is a level of its own
    nulls = planted.withColumn("acquisition_channel", F.when(F.col("num_sessions") > 1, F.col("acquisition_channel")))
    with_null = fit_spec(nulls, CATS, NUMS)
    at = with_null.feature_names().index("cat__acquisition_channel_None")
    again = {r.user_id: list(r.features.toArray()) for r in drop_slots(fit_preprocessor(nulls, with_null).transform(probe)).collect()}
    assert again["b"][at] == 1.0 and again["c"][at] == 0.0
    # missing numeric -> median, then standardised
    med = (spec.medians["hours_to_first_action"] - spec.means["hours_to_first_action"]) / spec.scales["hours_to_first_action"]
    assert rows["a"][slot["num__hours_to_first_action"]] == pytest.approx(med)


def test_report_set_of_a_training_run(spark, tmp_path):
    """One training writes its whole report set; the winner, its threshold and metrics agree."""
    import json

    from cohortlens.plans import training

    t = testdata.load(spark, "/root/testdata/sf0.01")
    data, result = training.trained(t, gbt_max_iter=5)
    assert training.trained(t, gbt_max_iter=5)[1] is result  # same files, same session: trained once
    assert result.winner == max(result.candidates, key=lambda n: result.candidates[n].average_precision)
    training.write_report_set(result, t, data, str(tmp_path))

    def rows(name):
        return [json.loads(line) for f in sorted((tmp_path / name).glob("part-*.json")) for line in f.read_text().splitlines()]

    assert {r["dataset"] for r in rows("metrics")} == {"validation@0.5", "validation", "test"}
    assert rows("model_metadata")[0]["model"] == result.winner and rows("model_metadata")[0]["n_features"] == 37
    assert len(rows("threshold_sweep")) == 101 and len(rows("split")) == 3
    assert all(r["disclaimer"] == training.DISCLAIMER and r["predicted_class"] in (0, 1) for r in rows("user_report"))
    assert len(rows("user_explanations")) == data.test.count() and rows("nba_examples") and rows("subgroups") and rows("global_explanation")
    assert rows("calibration") and rows("pr_curve") and rows("roc_curve")
