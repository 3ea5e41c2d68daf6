"""A/B experiment analysis (EX1-EX7): SRM, per-metric conversion, lift, z-test, CI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.stats import chi2_sf, safe_div, with_two_proportion_z_test
from cohortlens.operators.activity import active_on, with_activity

D7_RETENTION = "d7_retention"


def allocation_table(spark, variants: list[tuple[str, float]] | None = None) -> DataFrame:
    variants = variants or config.ONBOARDING_VARIANTS
    return spark.createDataFrame([(v, float(a)) for v, a in variants], "variant_id string, allocation double")


def sample_sizes(assignments: DataFrame, experiment_id: str) -> DataFrame:
    """EX2: assignment rows per variant."""
    return (assignments.where(F.col("experiment_id") == experiment_id)
            .groupBy("variant_id").agg(F.count(F.lit(1)).alias("sample_size")).orderBy("variant_id"))


def srm_test(assignments: DataFrame, experiment_id: str = config.ONBOARDING_EXPERIMENT_ID,
             variants: list[tuple[str, float]] | None = None) -> DataFrame:
    """EX3: chi-square goodness of fit of observed variant counts against the allocation.

    Expected counts are allocation x n over the configured variants (absent variant = 0
    observed). Rows of variants outside the configuration are reported, not silently dropped.
    Output: experiment_id, n, chi2, dof, p_value, unknown_variant_rows.
    """
    variants = variants or config.ONBOARDING_VARIANTS
    observed = (assignments.where(F.col("experiment_id") == experiment_id)
                .groupBy("variant_id").agg(F.count(F.lit(1)).alias("observed")))
    alloc = F.broadcast(allocation_table(assignments.sparkSession, variants))  # fixed, tiny
    joined = alloc.join(observed, "variant_id", "full_outer")
    known = F.col("allocation").isNotNull()
    total = observed.agg(F.sum("observed").alias("_n")).select("_n").scalar()  # scalar subquery
    per = joined.withColumn("_n", F.coalesce(total, F.lit(0)))
    expected = F.col("allocation") * F.col("_n")
    obs = F.coalesce(F.col("observed"), F.lit(0)).cast("double")
    agg = per.agg(
        F.max("_n").alias("n"),
        F.sum(F.when(known, F.try_divide((obs - expected) * (obs - expected), expected))).alias("chi2"),
        F.coalesce(F.sum(F.when(~known, F.col("observed"))), F.lit(0)).cast("bigint").alias("unknown_variant_rows"),
    )
    dof = len(variants) - 1
    return agg.select(F.lit(experiment_id).alias("experiment_id"), F.col("n").cast("bigint").alias("n"),
                      "chi2", F.lit(dof).alias("dof"), chi2_sf(F.col("chi2"), dof).alias("p_value"),
                      "unknown_variant_rows")


def user_metric_flags(users: DataFrame, events: DataFrame, assignments: DataFrame, experiment_id: str,
                      metrics: dict[str, str]) -> DataFrame:
    """One row per assignment row of the experiment with a boolean per metric (EX4, EX5)."""
    subset = (assignments.where(F.col("experiment_id") == experiment_id).select("user_id", "variant_id")
              .join(users.select("user_id", "signup_timestamp"), "user_id", "left"))
    named = {f"_m_{m}": e for m, e in metrics.items() if e != D7_RETENTION}
    out = with_activity(subset, events, names=named)  # the events are read once for all metrics
    cols = [(active_on(7) if e == D7_RETENTION else F.coalesce(F.col(f"_m_{m}"), F.lit(False))).alias(f"_f_{m}") for m, e in metrics.items()]
    return out.select("user_id", "variant_id", *cols)


def analyze_experiment(users: DataFrame, events: DataFrame, assignments: DataFrame,
                       experiment_id: str = config.ONBOARDING_EXPERIMENT_ID, metrics: dict[str, str] | None = None,
                       control_variant: str = config.CONTROL_VARIANT) -> DataFrame:
    """EX1: metric, variant_id, sample_size, conversions, conversion_rate, absolute_lift,
    relative_lift, p_value, ci_lower, ci_upper. Control rows carry nulls in the comparison columns.

    User flags -> one aggregate per variant (a handful of rows) -> each metric's control row by a window
    over its variants -> z-test as Column arithmetic.
    """
    metrics = dict(metrics or config.DEFAULT_EXPERIMENT_METRICS)
    flags = user_metric_flags(users, events, assignments, experiment_id, metrics)
    per_variant = flags.groupBy("variant_id").agg(
        F.count(F.lit(1)).alias("sample_size"),
        *[F.count_if(F.col(f"_f_{m}")).alias(f"_c_{m}") for m in metrics])
    rows = F.array(*[F.struct(F.lit(i).alias("_metric_order"), F.lit(m).alias("metric"),
                              F.col(f"_c_{m}").alias("conversions")) for i, m in enumerate(metrics)])
    long = per_variant.select("variant_id", "sample_size", F.inline(rows))
    long = long.withColumn("conversion_rate", safe_div("conversions", "sample_size"))
    of_metric = Window.partitionBy("metric")  # a row a variant

    def control(column: str) -> Column:
        return F.max(F.when(F.col("variant_id") == control_variant, F.col(column))).over(of_metric)

    j = long.select("*", F.coalesce(control("conversions"), F.lit(0)).alias("_cc0"), F.coalesce(control("sample_size"), F.lit(0)).alias("_cn0"),
                    control("conversion_rate").alias("_cr"))
    test = with_two_proportion_z_test(j, "_cc0", "_cn0", "conversions", "sample_size")
    is_treat = F.col("variant_id") != control_variant
    cr = F.coalesce(F.col("_cr"), F.lit(0.0))
    out = test.select(
        "_metric_order", "metric", "variant_id", "sample_size", "conversions", "conversion_rate",
        F.when(is_treat, F.col("conversion_rate") - cr).alias("absolute_lift"),
        F.when(is_treat & (cr > 0), (F.col("conversion_rate") - cr) / cr).alias("relative_lift"),
        F.when(is_treat, F.col("p_value")).alias("p_value"),
        F.when(is_treat, F.col("ci_lower")).alias("ci_lower"),
        F.when(is_treat, F.col("ci_upper")).alias("ci_upper"),
    )
    return out.orderBy("_metric_order", "variant_id").drop("_metric_order")


def experiment_summary(analysis: DataFrame) -> DataFrame:
    """RP5: variant, n, rate, relative lift and p per metric (projection of EX1)."""
    return analysis.select("metric", "variant_id", F.col("sample_size").alias("n"),
                           F.col("conversion_rate").alias("rate"), F.col("relative_lift").alias("lift"),
                           F.col("p_value").alias("p"))
