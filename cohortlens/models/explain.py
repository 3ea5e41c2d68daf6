"""Explanations (XP1-XP7): coefficients, permutation importance, per-user contributions.

Per-user contributions are ranked inside the user's own array of slots. Permutation importance shuffles a
feature across the validation rows with a per-(feature, repeat) affine bijection of a hash-ordered row index,
so a shuffle is one equi-join of narrow rows: the donors' parts travel, whole rows are not repeated for it - no
sort of the exploded table, no collect.
"""

from __future__ import annotations

import math
import random

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.scalars import with_scalars
from cohortlens.functions.selection import totals_up_to
from cohortlens.models import tree_table
from cohortlens.models.preprocess import PreprocessSpec, drop_slots
from cohortlens.operators import evaluate
from cohortlens.session import ensure_checkpoint_dir


ROWS_A_TASK = 1_000_000  # shuffled rows that one task makes


def _lr_stage(model: PipelineModel):
    return model.stages[-1]


def extract_logistic_coefficients(model: PipelineModel, spec: PreprocessSpec, weights: list[float] | None = None) -> DataFrame:
    """XP2: feature, coefficient, abs_coefficient sorted by |coefficient| descending (of ``weights``
    where given)."""
    coefs = weights or [float(c) for c in _lr_stage(model).coefficients.toArray()]
    spark = _spark()
    rows = list(zip(spec.feature_names(), coefs, [abs(c) for c in coefs]))
    df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
    return df.orderBy(F.desc("abs_coefficient"), "feature")


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def transformed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Preprocessing stages only (features vector), without the classifier."""
    out = df
    for stage in model.stages[:2]:
        out = stage.transform(out)
    return drop_slots(out)


def explain_linear(model: PipelineModel, spec: PreprocessSpec, df: DataFrame, top_n: int = 5, weights: list[float] | None = None) -> DataFrame:
    """XP4 for every row of ``df``: contribution = transformed value x coefficient.

    Output: user_id, predicted_risk, positive_factors, negative_factors (arrays of
    struct<feature, contribution>, rounded to 6 places; positives > 0 largest first, negatives < 0
    most negative first, at most ``top_n`` each). ``weights`` (refined ones) replace the model's own.
    """
    coefs = weights or [float(c) for c in _lr_stage(model).coefficients.toArray()]
    # the fitted stages name the target; a contribution does not depend on it
    known = df if config.TARGET_COLUMN in df.columns else df.withColumn(config.TARGET_COLUMN, F.lit(0))
    scored = model.transform(known.withColumn("label", F.lit(0.0)))
    base = drop_slots(scored).select("user_id", F.round(vector_to_array("probability")[1], 6).alias("predicted_risk"),
                                     vector_to_array("features").alias("_x"))
    coef_arr = F.array(*[F.lit(c) for c in coefs])
    slots = F.transform("_x", lambda x, i: F.struct((x * F.get(coef_arr, i)).alias("c"), i.alias("pos")))
    return _top_factors(base.withColumn("_slots", slots), spec.feature_names(), top_n)


def _top_factors(base: DataFrame, names: list[str], top_n: int) -> DataFrame:
    """The strongest contributions among a row's own ``_slots`` (array of struct<c, pos>), equal ones (to
    nine places) in the order of the slots: no rows are made or moved."""
    name_arr = F.array(*[F.lit(n) for n in names])

    def top(sign: int):
        kept = F.transform(F.filter("_slots", lambda s: s["c"] * sign > 0),
                           lambda s: F.struct(F.round(s["c"] * -sign, 9).alias("k"), (s["pos"] * sign).alias("tie"), s["pos"].alias("pos"), s["c"].alias("c")))
        return F.transform(F.slice(F.array_sort(kept), 1, top_n), lambda s: F.struct(
            F.get(name_arr, s["pos"]).alias("feature"), F.round(s["c"], 6).alias("contribution")))

    return base.select("user_id", "predicted_risk", top(1).alias("positive_factors"), top(-1).alias("negative_factors"))


def explain_tree(model: PipelineModel, spec: PreprocessSpec, df: DataFrame, top_n: int = 5) -> DataFrame:
    """XP5: contribution of slot j = base probability - probability with transformed slot j = 0, from
    the ensemble's node table inside each user's own row. No contribution is left out."""
    base = transformed(model, df).select("user_id", vector_to_array("features").alias("_x"))
    found = tree_table.explained(base, tree_table.model_table(model.stages[-1]), "_x")
    return _top_factors(found.select("user_id", F.round("prob", 6).alias("predicted_risk"), F.col("slots").alias("_slots")), spec.feature_names(), top_n)


def explain_users(model: PipelineModel, spec: PreprocessSpec, df: DataFrame, top_n: int = 5) -> DataFrame:
    is_linear = hasattr(_lr_stage(model), "coefficients")
    return explain_linear(model, spec, df, top_n) if is_linear else explain_tree(model, spec, df, top_n)


def _coprime_multiplier(rng: random.Random, n: int) -> int:
    if n <= 2:
        return 1
    while True:
        a = rng.randrange(1, n)
        if math.gcd(a, n) == 1:
            return a


def _inverse(a: int, n: int) -> int:
    """The multiplier that undoes ``a`` modulo n."""
    return pow(a, -1, n) if n > 1 else 0


def permutation_importance(model: PipelineModel, spec: PreprocessSpec, val: DataFrame, features: list[str], n_repeats: int = 10,
                           seed: int = config.RANDOM_SEED) -> DataFrame:
    """XP3: mean / population-std drop in average precision when one input feature is shuffled.

    Rows are indexed 0..n-1 in xxhash64(user_id, seed) order (exact distributed rank); the
    shuffle for (feature f, repeat r) sends row i the value of row (a_fr * i + b_fr) mod n with
    gcd(a_fr, n) = 1 - a bijection, so every value is used exactly once.

    Rows are preprocessed once. What a feature gives to a row is the slots it fills, so only those travel
    from the donor; of a linear model only their sum with the weights does, and the row itself is its label and
    the rest of its margin.
    """
    label = config.TARGET_COLUMN
    ready = transformed(model, val.withColumn("label", F.col(label).cast("double")).withColumn("_w", F.lit(1.0)))
    base = ready.select("user_id", F.col(label).alias("label"), vector_to_array("features").alias("_x"))
    ensure_checkpoint_dir(val.sparkSession)
    order = F.struct(F.xxhash64(F.col("user_id").cast("string"), F.lit(seed)), F.col("user_id"))
    ranked = totals_up_to(base.withColumn("_one", F.lit(1).cast("long")), order, {"_idx": "_one"}).select(
        (F.col("_idx") - 1).alias("_idx"), "label", "_x").checkpoint()  # read as askers, as donors and as they are
    n = ranked.count()
    rng = random.Random(seed)
    plan = [(fi, r, _coprime_multiplier(rng, n), rng.randrange(0, max(n, 1)))
            for fi in range(len(features)) for r in range(n_repeats)]
    plan_arr = F.array(*[F.struct(F.lit(fi).alias("f"), F.lit(r).alias("r"), F.lit(a).cast("bigint").alias("a"),
                                  F.lit(b).cast("bigint").alias("b"), F.lit(_inverse(a, n)).cast("bigint").alias("back")) for fi, r, a, b in plan])
    spans = spec.slots_of()
    donor = F.pmod(F.col("a") * F.col("_idx") + F.col("b"), F.lit(max(n, 1))).alias("_donor")
    asker = F.pmod(F.col("back") * (F.col("_idx") - F.col("b")), F.lit(max(n, 1))).alias("_asker")  # whose donor a row is
    linear = hasattr(_lr_stage(model), "coefficients")
    # a task makes as many rows as its own times the plan's: spread by what is made, not by what is read
    spread = ranked.repartition(max(val.sparkSession.sparkContext.defaultParallelism, -(-n * len(plan) // ROWS_A_TASK)))
    scored = (_scored_linear if linear else _scored_slots)(model, ranked, spread, plan_arr, donor if linear else asker, [spans[c] for c in features])
    ap = evaluate.average_precision_by(scored[1], ["f", "r"])
    drops = with_scalars(ap, evaluate.average_precision(scored[0]).withColumnRenamed("pr_auc", "_base"))
    name_arr = F.array(*[F.lit(c) for c in features])
    out = drops.groupBy("f").agg(F.avg(F.col("_base") - F.col("pr_auc")).alias("importance_mean"),
                                 F.stddev_pop(F.col("_base") - F.col("pr_auc")).alias("importance_std"))
    return out.select(F.element_at(name_arr, F.col("f") + 1).alias("feature"), "importance_mean",
                      "importance_std").orderBy(F.desc("importance_mean"), "feature")


def _scored_linear(model, ranked, spread, plan, donor, spans):
    """The rows' own scores and those of every (f, r), from margins: what the donor's feature adds replaces what
    the row's own does. To twelve places, so that rows that are equal stay so however they are added up."""
    weights = [float(c) for c in _lr_stage(model).coefficients.toArray()]
    adds = [sum((F.get("_x", at) * F.lit(weights[at]) for at in range(first, first + size)), F.lit(0.0)) for first, size in spans]
    margin = F.aggregate(F.zip_with("_x", F.array(*[F.lit(w) for w in weights]), lambda v, w: v * w), F.lit(float(_lr_stage(model).intercept)), lambda s, v: s + v)
    narrow, wide = (rows.select("_idx", "label", margin.alias("_m"), F.array(*adds).alias("_adds")) for rows in (ranked, spread))
    asked = wide.select("_idx", "label", "_m", "_adds", F.inline(plan)).select(
        "f", "r", "label", (F.col("_m") - F.get("_adds", F.col("f"))).alias("_rest"), donor)
    given = narrow.select(F.col("_idx").alias("_donor"), F.posexplode("_adds").alias("f", "_add"))
    probability = F.round(1 / (1 + F.exp(-F.col("_margin"))), 12).alias("prob")
    # the rows of both sides are made here, so their size is not what the plan estimates: never a broadcast
    permuted = asked.join(given.hint("shuffle_hash"), ["_donor", "f"]).select("f", "r", "label", (F.col("_rest") + F.col("_add")).alias("_margin"))
    return narrow.select("label", F.col("_m").alias("_margin")).select("label", probability), permuted.select("f", "r", "label", probability)


def _scored_slots(model, ranked, spread, plan, asker, spans):
    """The same for any classifier over the slots: the donor's part replaces the row's own, then the row is scored.
    Each part is sent to the row that asks for it, so that a row's slots move once and not for every (f, r)."""
    classifier = _lr_stage(model)
    parts = [F.slice("_x", first + 1, size) for first, size in spans]
    sent = spread.select("_idx", F.array(*parts).alias("_parts"), F.inline(plan)).select("f", "r", F.get("_parts", F.col("f")).alias("_part"), asker)
    first = F.get(F.array(*[F.lit(at) for at, _ in spans]), F.col("f"))
    size = F.size("_part")
    mixed = F.concat(F.slice("_x", F.lit(1), first), F.col("_part"), F.slice("_x", first + size + 1, F.size("_x")))

    def scored(rows, *keys):
        return classifier.transform(rows).select(*keys, "label", vector_to_array("probability")[1].alias("prob"))

    asking = ranked.select(F.col("_idx").alias("_asker"), "label", "_x")
    permuted = sent.join(asking.hint("shuffle_hash"), "_asker").select("f", "r", "label", array_to_vector(mixed).alias("features"))
    return scored(ranked.select("label", array_to_vector("_x").alias("features"))), scored(permuted, "f", "r")


def global_explanation(model: PipelineModel, spec: PreprocessSpec, importance: DataFrame, top_n: int = 15) -> DataFrame:
    """XP6: top LR coefficients (none for trees) and top permutation importances, long form."""
    perm = importance.limit(top_n).select(F.lit("permutation_importance").alias("kind"), "feature",
                                          F.col("importance_mean").alias("value"), F.col("importance_std").alias("spread"))
    if not hasattr(_lr_stage(model), "coefficients"):
        return perm
    coefs = extract_logistic_coefficients(model, spec).limit(top_n).select(
        F.lit("logistic_coefficients").alias("kind"), "feature", F.col("coefficient").alias("value"),
        F.col("abs_coefficient").alias("spread"))
    return coefs.unionByName(perm)
