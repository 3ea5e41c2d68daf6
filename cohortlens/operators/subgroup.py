"""Subgroup evaluation (EV13): one grouping pass for all group columns (grouping-sets shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.stats import safe_div

DEFAULT_GROUPS = ["acquisition_channel", "career_stage", "device_type"]


def evaluate_subgroups(df: DataFrame, threshold: float, group_columns: list[str] | None = None,
                       label: str = config.TARGET_COLUMN, prob: str = "prob",
                       small_sample: int = config.SMALL_SAMPLE_THRESHOLD) -> DataFrame:
    """group_column, group_value (text), sample_size, churn_rate, precision, recall, f1_score,
    predicted_positive_rate, small_sample. Null group values are dropped.

    The group columns are unpivoted with ``inline`` so a single ``groupBy`` serves all of them.
    """
    groups = group_columns or DEFAULT_GROUPS
    pairs = F.array(*[F.struct(F.lit(g).alias("group_column"), F.col(g).cast("string").alias("group_value"))
                      for g in groups])
    y = F.col(label).cast("int") == 1
    pred = F.col(prob) >= F.lit(float(threshold))
    long = df.select(y.alias("_y"), pred.alias("_pred"), F.inline(pairs)).where(F.col("group_value").isNotNull())
    agg = long.groupBy("group_column", "group_value").agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.count_if(F.col("_y")).alias("_pos"),
        F.count_if(F.col("_pred")).alias("_pp"),
        F.count_if(F.col("_y") & F.col("_pred")).alias("_tp"))
    order = F.when(F.col("group_column") == groups[0], 0)
    for i, g in enumerate(groups[1:], start=1):
        order = order.when(F.col("group_column") == g, i)
    return agg.select(
        "group_column", "group_value", "sample_size",
        (F.col("_pos") / F.col("sample_size")).alias("churn_rate"),
        safe_div("_tp", "_pp").alias("precision"), safe_div("_tp", "_pos").alias("recall"),
        safe_div(F.lit(2.0) * F.col("_tp"), F.col("_pos") + F.col("_pp")).alias("f1_score"),
        (F.col("_pp") / F.col("sample_size")).alias("predicted_positive_rate"),
        (F.col("sample_size") < small_sample).alias("small_sample"),
    ).orderBy(order, "group_value")
