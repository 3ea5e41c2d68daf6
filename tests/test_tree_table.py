"""The boosted ensemble as a table: scores are the model's own, explanations those of re-scored rows and of SQL."""

from __future__ import annotations

import math
import random
import time

import duckdb
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import explain, tree_table
from cohortlens.models import train as T
from cohortlens.models.preprocess import fit_spec

#: Every tree of the node table walked for every row, once as it is and once for each slot at zero.
WALK = """
WITH RECURSIVE tries AS (SELECT user_id, -1 AS zeroed FROM users UNION ALL SELECT DISTINCT user_id, pos FROM cells),
walk AS (SELECT t.user_id, t.zeroed, n.tree, n.node, n.slot, n.threshold, n.low, n.high, n.value FROM tries t CROSS JOIN nodes n WHERE n.node = 0
         UNION ALL
         SELECT w.user_id, w.zeroed, n.tree, n.node, n.slot, n.threshold, n.low, n.high, n.value FROM walk w
         JOIN cells c ON c.user_id = w.user_id AND c.pos = w.slot
         JOIN nodes n ON n.tree = w.tree AND n.node = CASE WHEN (CASE WHEN w.slot = w.zeroed THEN 0 ELSE c.x END) <= w.threshold THEN w.low ELSE w.high END),
scores AS (SELECT user_id, zeroed, 1 / (1 + exp(-2 * sum(value))) AS p FROM walk WHERE slot IS NULL GROUP BY ALL)
SELECT a.user_id, a.zeroed, b.p, b.p - a.p AS c FROM scores a JOIN scores b ON b.user_id = a.user_id AND b.zeroed = -1 WHERE a.zeroed >= 0
"""


@pytest.fixture(scope="module")
def users(spark):
    df = spark.range(400).select(
        F.concat(F.lit("u"), F.col("id")).alias("user_id"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string")), (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).cast("int")).alias("channel"),
        F.when(F.col("id") % 13 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9)) - 3.0).alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000.0).alias("y"))
    chance = F.pmod(F.xxhash64("user_id", F.lit(5)), F.lit(1000)) / 1000.0
    effect = 1 / (1 + F.exp(-(F.coalesce("x", F.lit(0.0)) * 0.8 - F.col("y") + F.when(F.col("channel") == "a", 1.0).otherwise(-0.5))))
    return df.withColumn(config.TARGET_COLUMN, (chance < effect).cast("int")).checkpoint()


@pytest.fixture(scope="module")
def fitted(users):
    spec = fit_spec(users, ["channel"], ["x", "y"], scale=False)
    model = T.fit_gradient_boosting(users, spec, max_iter=12)
    return spec, model, tree_table.model_table(model.stages[-1]).checkpoint()


@pytest.fixture(scope="module")
def vectors(users, fitted):
    return explain.transformed(fitted[1], users).select("user_id", vector_to_array("features").alias("x"))


def test_table_has_the_models_nodes(fitted):
    _, model, table = fitted
    classifier = model.stages[-1]
    assert table.schema.simpleString() == "struct<tree:int,node:int,slot:int,threshold:double,low:int,high:int,value:double>"
    assert table.count() == classifier.totalNumNodes and table.select("tree").distinct().count() == classifier.getNumTrees > 1
    assert table.where("(slot IS NULL) = (value IS NULL) OR (slot IS NULL) <> (low IS NULL) OR (slot IS NULL) <> (high IS NULL)").isEmpty()


def test_scores_are_the_models(users, fitted, vectors):
    _, model, table = fitted
    own = {r.user_id: r.prob for r in T.score(model, users).collect()}
    got = {r.user_id: r.prob for r in tree_table.score_by_table(vectors, table, "x").collect()}
    assert got.keys() == own.keys() and all(abs(got[u] - own[u]) < 1e-14 for u in own)


def _changes(rows):
    return {(r.user_id, s.pos): s.c for r in rows for s in r.slots}


def test_explanations_are_those_of_rescored_rows(fitted, vectors):
    _, model, table = fitted
    got = _changes(tree_table.explained(vectors, table, "x").collect())
    tried = vectors.select("user_id", "x", F.posexplode("x").alias("pos", "v"))
    for zero in (False, True):
        changed = F.transform("x", lambda v, i: F.when((i == F.col("pos")) & F.lit(zero), F.lit(0.0)).otherwise(v))
        tried = model.stages[-1].transform(tried.withColumn("features", array_to_vector(changed))).withColumn(f"p{int(zero)}", vector_to_array("probability")[1])
        tried = tried.select("user_id", "x", "pos", *[c for c in ("p0", "p1") if c in tried.columns])
    expected = {(r.user_id, r.pos): r.p0 - r.p1 for r in tried.collect()}
    assert got and set(got) <= set(expected)
    assert all(abs(got.get(k, 0.0) - c) < 1e-13 for k, c in expected.items())


def test_explanations_are_those_of_sql_over_the_table(fitted, vectors):
    _, _, table = fitted
    con = duckdb.connect()
    con.register("nodes", table.toPandas().astype({"slot": "Int32", "low": "Int32", "high": "Int32"}))
    con.register("cells", vectors.select("user_id", F.posexplode("x").alias("pos", "x")).toPandas())
    con.register("users", vectors.select("user_id").toPandas())
    rows = tree_table.explained(vectors, table, "x").collect()
    got, prob = _changes(rows), {r.user_id: r.prob for r in rows}
    # a null threshold or value arrives as NaN from pandas, so leaves are known by their slot
    expected = con.execute(WALK).fetchall()
    assert len(expected) == 400 * len(rows[0:1] and vectors.first()["x"])
    for user, pos, p, c in expected:
        assert abs(prob[user] - p) < 1e-12 and abs(got.get((user, pos), 0.0) - c) < 1e-12


def test_plan_neither_explodes_nor_moves_rows(users, fitted, vectors):
    spec, model, table = fitted
    plan = explain.explain_tree(model, spec, users)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan and "Aggregate" not in plan.replace("aggregate", "")
    top = explain.explain_tree(model, spec, users, top_n=2).collect()
    names, rows = spec.feature_names(), {r.user_id: r for r in tree_table.explained(vectors, table, "x").collect()}
    for r in top:
        ranked = sorted(((s.c, names[s.pos]) for s in rows[r.user_id].slots), reverse=True)
        assert r.predicted_risk == round(rows[r.user_id].prob, 6)
        for found, side in ((r.positive_factors, [v for v in ranked if v[0] > 0][:2]), (r.negative_factors, [v for v in ranked[::-1] if v[0] < 0][:2])):
            assert [f.contribution for f in found] == pytest.approx([c for c, _ in side], abs=1e-6)


def test_repeated_rows_empty_input_and_a_model_of_one_leaf(users, fitted, vectors):
    spec, model, table = fitted
    twice = vectors.limit(3).union(vectors.limit(3))
    assert tree_table.explained(twice, table, "x").count() == 6
    assert tree_table.explained(vectors.limit(0), table, "x").collect() == []
    leaf = users.sparkSession.createDataFrame([(0, 0, None, None, None, None, 0.25)], tree_table.SCHEMA)
    rows = tree_table.explained(vectors.limit(2), leaf, "x").collect()
    assert [r.slots for r in rows] == [[], []] and all(abs(r.prob - 0.6224593312018546) < 1e-15 for r in rows)
    odd = vectors.limit(1).withColumn("x", F.transform("x", lambda v: F.lit(float("nan"))))
    assert tree_table.explained(odd, table, "x").first().prob > 0  # NaN goes to the side of larger values, as in the model


def grown(rng, trees, slots, depth, early):
    """Rows of a node table, trees grown at random; a node is a leaf before the last level with the chance ``early``."""
    rows = []
    for tree in range(trees):
        size, todo = 1, [(0, 0)]
        while todo:
            node, level = todo.pop()
            if level == depth or level and rng.random() < early:
                rows.append((tree, node, None, None, None, None, rng.uniform(-0.1, 0.1)))
            else:
                rows.append((tree, node, rng.randrange(slots), rng.choice([0.0, -0.0, rng.uniform(-1, 1)]), size, size + 1, None))
                todo += [(size, level + 1), (size + 1, level + 1)]
                size += 2
    return rows


def walked(nodes, x, zeroed=None):
    """The share of one tree, node by node; a null goes to the side of larger values."""
    at = 0
    while nodes[at][2] is not None:
        _, _, slot, threshold, low, high, _ = nodes[at]
        v = 0.0 if slot == zeroed else x[slot] if slot < len(x) else None
        at = low if v is not None and v <= threshold else high
    return nodes[at][6]


@pytest.mark.parametrize("depth, early", [(1, 0.0), (5, 0.0), (5, 0.3), (8, 0.05), (12, 0.4)])
def test_explanations_are_those_of_walks(spark, depth, early):
    """Trees of one to several words of leaves; rows with nulls, NaN, zeros of both signs and too few slots."""
    rng = random.Random(depth)
    table = grown(rng, 7, 6, depth, early)
    xs = [[rng.choice([0.0, -0.0, None, float("nan"), rng.uniform(-1, 1), rng.uniform(-1, 1)]) for _ in range(rng.choice([6, 6, 6, 8, 3, 0]))] for _ in range(60)] + [None]
    users = spark.createDataFrame([(f"u{i}", x) for i, x in enumerate(xs)], "user_id string, x array<double>")
    got = {r.user_id: r for r in tree_table.explained(users, spark.createDataFrame(table, tree_table.SCHEMA), "x").collect()}
    dense = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(30)]
    whole = spark.createDataFrame([(f"d{i}", x) for i, x in enumerate(dense)], "user_id string, x array<double>")
    got |= {r.user_id: r for r in tree_table.explained(whole, spark.createDataFrame(table, tree_table.SCHEMA), "x").collect()}
    trees = [{r[1]: r for r in table if r[0] == tree} for tree in range(7)]
    for user, x in [*((f"u{i}", x or []) for i, x in enumerate(xs)), *((f"d{i}", x) for i, x in enumerate(dense))]:
        margin = sum(walked(t, x) for t in trees)
        p = 1 / (1 + math.exp(-2 * margin))
        assert abs(got[user].prob - p) < 1e-14
        expected = {}
        for pos in range(6):
            if pos < len(x) and x[pos] is not None and x[pos] != 0:
                without = sum(walked(t, x, pos) for t in trees)
                if abs(without - margin) > 1e-12:
                    expected[pos] = p - 1 / (1 + math.exp(-2 * without))
        found = {s.pos: s.c for s in got[user].slots}
        assert set(expected) <= set(found) and all(abs(c - expected.get(pos, 0.0)) < 1e-14 for pos, c in found.items())


def test_many_trees_are_explained_in_seconds(spark):
    """As many trees as training fits at most, for 4,000 rows: walking them again for every slot took a core 54 s."""
    table = spark.createDataFrame(grown(random.Random(1), 500, 60, 5, 0.0), tree_table.SCHEMA)
    value = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(2000)) / 1000.0 - 1)
    users = spark.range(0, 4000, 1, 1).select(F.col("id").alias("user_id"), value.alias("x"))
    began = time.perf_counter()
    falls = F.transform("slots", lambda s: s["c"])
    found = tree_table.explained(users, table, "x").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("slots")).alias("least"), F.max(F.array_max(falls)).alias("most")).first()
    assert found.n == 4000 and found.least > 40 and found.most > 0
    assert time.perf_counter() - began < 20
