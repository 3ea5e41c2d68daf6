"""The fitted linear model as a table, and scoring as a join and a sum (ML4, ML8, XP2, XP4).

``model_table`` writes a fitted logistic regression out as plain rows, one a slot: which column and level
it reads, what fills a missing number, mean, scale and weight, and one row for the constant. Any engine
that can join and add can score users with it; :func:`score_by_table` does. Before, :func:`refined`
brings the weights from the optimiser's tolerance to the limits of double precision: each step is one
weighted least-squares fit of the working response (the classical reweighting), which Spark solves by the
normal equations from sums that are added up where the rows lie.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models.preprocess import INFREQUENT, PreprocessSpec, drop_slots
from cohortlens.session import ensure_checkpoint_dir

LEVEL, OTHER, NUMBER, CONSTANT = "level", "other level", "number", "constant"
SCHEMA = "slot int, feature string, kind string, column string, level string, fill double, mean double, scale double, weight double"


def weighted_rows(pre: PipelineModel, train: DataFrame) -> DataFrame:
    """(label, features, _c): the labelled rows as the linear model reads them, with their weights of class,
    written once as every step reads them."""
    rows = drop_slots(pre.transform(train.withColumn("label", F.col(config.TARGET_COLUMN).cast("double"))))
    ensure_checkpoint_dir(train.sparkSession)
    return rows.select("label", "features", F.col("_w").cast("double").alias("_c")).checkpoint()


def with_weights(like, weights: list[float], constant: float) -> LogisticRegressionModel:
    """The model of ``like`` (a logistic regression or a model of one) with weights that are known already."""
    spark = SparkSession.active()  # also in a thread of its own
    values = spark.sparkContext._gateway.new_array(spark._jvm.double, len(weights))
    for i, w in enumerate(weights):
        values[i] = float(w)
    ml = spark._jvm.org.apache.spark.ml
    return like._copyValues(LogisticRegressionModel(ml.classification.LogisticRegressionModel(like.uid, ml.linalg.DenseVector(values), float(constant))))


@dataclass
class Reweighted:
    weights: list[float]
    constant: float
    converged: bool


def reweighted(like, rows: DataFrame, weights: list[float], constant: float, most: int, tolerance: float) -> Reweighted:
    """From the given weights of ``like`` on, steps of reweighted least squares over :func:`weighted_rows` until no weight
    changes by more than the tolerance, or ``most`` steps. Not converged either where a step has to leave out a
    row that is wrong by a whole class (its variance is zero in doubles)."""
    complete = True
    for _ in range(most):
        scorer = with_weights(like, weights, constant).setProbabilityCol("").setPredictionCol("")
        margin = vector_to_array(like.getRawPredictionCol())[1]
        at = scorer.transform(rows).withColumn("_m", margin).withColumn("_p", 1 / (1 + F.exp(-F.col("_m")))).withColumn("_v", F.col("_p") * (1 - F.col("_p")))
        mass = F.col("_c") * F.col("_v")
        held = at.select("features", F.when(mass > 0, F.col("_m") + (F.col("label") - F.col("_p")) / F.col("_v")).alias("response"), mass.alias("mass"),
                         ((F.col("_c") > 0) & ~(mass > 0) & (F.col("label") != F.col("_p"))).alias("_lost"))
        work = held.where("mass > 0").select("features", "response", "mass")
        used = F.when(F.col("mass") > 0, F.col("mass"))
        sums = held.agg(F.sum(used).alias("n"), F.sum(used * F.col("response")).alias("s"), F.sum(used * F.col("response") ** 2).alias("q"), F.count_if("_lost").alias("lost")).first()
        complete = not sums["lost"]
        if not sums["n"] or not all(math.isfinite(sums[c]) for c in "nsq"):
            break
        spread = max(sums["q"] / sums["n"] - (sums["s"] / sums["n"]) ** 2, 0.0) ** 0.5
        # Spark divides the penalty by the total mass and by the spread of the response
        step = LinearRegression(labelCol="response", weightCol="mass", regParam=spread / sums["n"], elasticNetParam=0.0,
                                standardization=False, solver="normal").fit(work)
        change = max([abs(a - b) for a, b in zip(weights, step.coefficients)] + [abs(constant - step.intercept)])
        weights, constant = [float(w) for w in step.coefficients], float(step.intercept)
        if change <= tolerance:
            return Reweighted(weights, constant, complete)
    return Reweighted(weights, constant, False)


def refined(model: PipelineModel, train: DataFrame, most: int = 5, tolerance: float = 1e-12) -> tuple[list[float], float]:
    """The weights and the constant of a fitted logistic regression at the optimum of its objective
    (summed weighted losses + half the squared weights), by reweighted least squares from the fitted
    ones. Stops when no weight changes by more than the tolerance, or after ``most`` steps."""
    fitted = model.stages[-1]
    rows = weighted_rows(PipelineModel(model.stages[:-1]), train)
    found = reweighted(fitted, rows, [float(w) for w in fitted.coefficients], float(fitted.intercept), most, tolerance)
    return found.weights, found.constant


def model_table(spark, spec: PreprocessSpec, weights: list[float], constant: float) -> DataFrame:
    """One row a slot (as many as the model has weights) and one for the constant."""
    rows, names = [], spec.feature_names()
    for c in spec.categorical:
        for v in [*spec.categories[c], *[None] * spec.has_null.get(c, False)]:
            rows.append((LEVEL, c, v, None, 0.0, 1.0))
        if spec.has_infrequent[c]:
            rows.append((OTHER, c, INFREQUENT, None, 0.0, 1.0))
    for c in spec.numeric:
        rows.append((NUMBER, c, None, spec.medians[c], spec.means.get(c, 0.0), spec.scales.get(c, 1.0)))
    out = [(i, names[i], *r, w) for i, (r, w) in enumerate(zip(rows, weights))]
    return spark.createDataFrame([*out, (len(out), "constant", CONSTANT, None, None, None, 0.0, 1.0, constant)], SCHEMA)


def contributions(df: DataFrame, table: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(keep..., slot, feature, contribution): what each slot that a row fills adds to its margin, the
    constant included. ``keep`` (user_id) identifies a row. The table has a row a slot and is joined
    by column, level and kind to the row's own values."""
    keep = keep or ["user_id"]
    slots = table.collect()  # a row a slot: at most 100 levels a column
    levels = {c: [r["level"] for r in slots if r["kind"] == LEVEL and r["column"] == c] for c in dict.fromkeys(r["column"] for r in slots if r["kind"] in (LEVEL, OTHER))}
    others = {r["column"] for r in slots if r["kind"] == OTHER}
    values = []
    for c, known in levels.items():
        v = F.col(f"`{c}`").cast("string")
        named = F.coalesce(v.isin([k for k in known if k is not None]), F.lit(None in known))
        kind = F.when(named, LEVEL).when(F.lit(c in others), OTHER)
        values.append(F.struct(kind.alias("kind"), F.lit(c).alias("column"), F.when(named, v).otherwise(INFREQUENT).alias("level"), F.lit(1.0).alias("value")))
    for r in slots:
        if r["kind"] == NUMBER:
            v = (F.coalesce(F.col(f"`{r['column']}`").cast("double"), F.lit(r["fill"])) - F.lit(r["mean"])) / F.lit(r["scale"])
            values.append(F.struct(F.lit(NUMBER).alias("kind"), F.lit(r["column"]).alias("column"), F.lit(None).cast("string").alias("level"), v.alias("value")))
    values.append(F.struct(F.lit(CONSTANT).alias("kind"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("level"), F.lit(1.0).alias("value")))
    long = df.select(*keep, F.inline(F.array(*values))).where("kind IS NOT NULL")
    weight = F.broadcast(table.select("slot", "feature", "kind", F.col("column").alias("_column"), F.col("level").alias("_level"), "weight"))
    same = (long["kind"] == weight["kind"]) & long["column"].eqNullSafe(weight["_column"]) & long["level"].eqNullSafe(weight["_level"])
    return long.join(weight, same).select(*keep, "slot", "feature", (F.col("value") * F.col("weight")).alias("contribution"))


def score_by_table(df: DataFrame, table: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """ML8 from the table: the probability of class 1 as ``prob``, by one sum a row."""
    keep = keep or ["user_id"]
    margin = contributions(df, table, keep).groupBy(*keep).agg(F.sum("contribution").alias("_m"))
    return margin.select(*keep, (1 / (1 + F.exp(-F.col("_m")))).alias("prob"))
