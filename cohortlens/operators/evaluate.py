"""Classifier evaluation (EV1-EV12) over a keyed ``DataFrame(label, prob)``.

Everything is exact and distributed: curve metrics collapse rows to distinct scores (partial
aggregation), then take cumulative sums in score order with :func:`totals_up_to`; threshold
sweeps collapse rows to at most ``n_thresholds + 1`` grid buckets computed arithmetically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.scalars import with_scalars
from cohortlens.functions.selection import totals_up_to
from cohortlens.functions.stats import safe_div

EPS = 2.220446049250313e-16  # float64 machine epsilon used to clip probabilities


def linspace(n: int) -> list[float]:
    """n evenly spaced values on [0, 1] exactly as a step-multiplied grid (last value pinned to 1)."""
    if n == 1:
        return [0.0]
    step = 1.0 / (n - 1)
    return [i * step for i in range(n - 1)] + [1.0]


def _one_row_join(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row as scalar subqueries (no join)."""
    return with_scalars(df, scalars)


def _label(c: str = "label") -> Column:
    return F.col(c).cast("bigint")


def cumulative(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """One row per distinct score (descending): tp, fp at that score and cumulative counts of
    rows scoring >= it (cum_tp, cum_fp), plus class totals P and N."""
    per_score = scored.groupBy(F.col(prob).alias("prob")).agg(
        F.sum(_label(label)).alias("tp"), F.sum(1 - _label(label)).alias("fp"))
    cum = totals_up_to(per_score, F.col("prob"), {"upto_tp": "tp", "upto_fp": "fp"})
    return cum.select("prob", "tp", "fp", (F.col("all_upto_tp") - F.col("upto_tp") + F.col("tp")).alias("cum_tp"),
                      (F.col("all_upto_fp") - F.col("upto_fp") + F.col("fp")).alias("cum_fp"), F.col("all_upto_tp").alias("P"), F.col("all_upto_fp").alias("N"))


def average_precision_by(scored: DataFrame, by: list[str], label: str = "label", prob: str = "prob") -> DataFrame:
    """EV1 per group (e.g. permutation repeats), null for a group without positives."""
    per_score = scored.groupBy(*by, F.col(prob).alias("prob")).agg(
        F.sum(_label(label)).alias("tp"), F.sum(1 - _label(label)).alias("fp"))
    cum = totals_up_to(per_score, F.col("prob"), {"upto_tp": "tp", "upto_fp": "fp"}, by)
    cum_tp, cum_fp = (F.col(f"all_upto_{c}") - F.col(f"upto_{c}") + F.col(c) for c in ("tp", "fp"))
    term = F.try_divide("tp", "all_upto_tp") * (cum_tp / (cum_tp + cum_fp))
    return cum.groupBy(*by).agg(F.when(F.max("all_upto_tp") > 0, F.sum(term)).alias("pr_auc"))


def _average_precision() -> Column:
    """Over :func:`cumulative` rows; null without positives."""
    term = F.try_divide("tp", "P") * (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp")))
    return F.when(F.max("P") > 0, F.sum(term))


def _roc_area() -> Column:
    """Over :func:`cumulative` rows; null for a single class."""
    term = F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2.0)
    return F.try_divide(F.sum(term), F.max("P") * F.max("N"))


def average_precision(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV1: sum over distinct thresholds of (R_n - R_n-1) * P_n."""
    c = cumulative(scored, label, prob)
    return c.agg(_average_precision().alias("pr_auc"))


def roc_auc(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV2: trapezoidal ROC area with ties, sum fp_s * (TP_{>s} + tp_s / 2) / (P N)."""
    c = cumulative(scored, label, prob)
    return c.agg(_roc_area().alias("roc_auc"))


def probability_scores(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV3 / EV4: log loss (natural log, clipped to [eps, 1 - eps]) and Brier score."""
    p = F.least(F.greatest(F.col(prob), F.lit(EPS)), F.lit(1.0 - EPS))
    y = _label(label)
    ll = F.when(y == 1, F.log(p)).otherwise(F.log(1.0 - p))
    return scored.agg((-F.avg(ll)).alias("log_loss"), F.avg(F.pow(F.col(prob) - y, 2)).alias("brier_score"))


def confusion_counts(scored: DataFrame, threshold: float, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV9: tn, fp, fn, tp with pred = prob >= threshold (zeros for a single-class input)."""
    pred, y = F.col(prob) >= F.lit(float(threshold)), _label(label) == 1
    return scored.agg(F.count_if(~pred & ~y).alias("true_negative"), F.count_if(pred & ~y).alias("false_positive"),
                      F.count_if(~pred & y).alias("false_negative"), F.count_if(pred & y).alias("true_positive"))


def _fbeta(tp: Column, true_sum: Column, pred_sum: Column, beta: float) -> Column:
    b2 = beta * beta
    return safe_div(F.lit(1.0 + b2) * tp, F.lit(b2) * true_sum + pred_sum)


def threshold_metrics(scored: DataFrame, threshold: float, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV5: precision, recall, F1, accuracy at ``threshold`` (zero denominators give 0)."""
    cm = confusion_counts(scored, threshold, label, prob)
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    return cm.select(F.lit(float(threshold)).alias("threshold"), safe_div(tp, tp + fp).alias("precision"),
                     safe_div(tp, tp + fn).alias("recall"), _fbeta(tp, tp + fn, tp + fp, 1.0).alias("f1_score"),
                     safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"))


def compute_metrics(scored: DataFrame, threshold: float, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV6: the nine-metric bundle in one row, from one pass over the (possibly model-scored) input:
    all nine follow from the rows per distinct score."""
    c = cumulative(scored, label, prob)
    p = F.least(F.greatest(F.col("prob"), F.lit(EPS)), F.lit(1.0 - EPS))
    n = F.sum(F.col("tp") + F.col("fp"))
    above = F.col("prob") >= F.lit(float(threshold))
    one = c.agg(
        _average_precision().alias("pr_auc"), _roc_area().alias("roc_auc"),
        F.try_divide(-F.sum(F.col("tp") * F.log(p) + F.col("fp") * F.log(1.0 - p)), n).alias("log_loss"),
        F.try_divide(F.sum(F.col("tp") * F.pow(F.col("prob") - 1, 2) + F.col("fp") * F.pow("prob", F.lit(2))), n).alias("brier_score"),
        n.alias("_n"), F.max("P").alias("_p"),
        F.coalesce(F.sum(F.when(above, F.col("tp"))), F.lit(0)).alias("_tp"), F.coalesce(F.sum(F.when(above, F.col("fp"))), F.lit(0)).alias("_fp"))
    tp, fp, pos = F.col("_tp"), F.col("_fp"), F.col("_p")
    right = tp + (F.col("_n") - pos - fp)
    return one.select("pr_auc", "roc_auc", "log_loss", "brier_score", F.lit(float(threshold)).alias("threshold"),
                      safe_div(tp, tp + fp).alias("precision"), safe_div(tp, pos).alias("recall"),
                      _fbeta(tp, pos, tp + fp, 1.0).alias("f1_score"), safe_div(right, F.col("_n")).alias("accuracy"))


def _grid_value(i: Column, n: int) -> Column:
    step = 1.0 / (n - 1) if n > 1 else 0.0
    return F.when(i >= n - 1, F.lit(1.0)).otherwise(i.cast("double") * F.lit(step))


def grid_bucket(prob: Column, n: int) -> Column:
    """Number of grid thresholds <= prob, computed in O(1) and corrected against the exact grid."""
    step = 1.0 / (n - 1) if n > 1 else 1.0
    k = F.least(F.lit(n), F.greatest(F.lit(0), (F.floor(prob / F.lit(step)) + 1).cast("int")))
    k = F.when((k >= 1) & (_grid_value(k - 1, n) > prob), k - 1).otherwise(k)
    k = F.when((k < n) & (_grid_value(k, n) <= prob), k + 1).otherwise(k)
    return k


def threshold_sweep(scored: DataFrame, n_thresholds: int = 101, label: str = "label", prob: str = "prob") -> DataFrame:
    """Confusion counts and scores at every grid threshold (EV7 input), from <= n+1 buckets."""
    spark = scored.sparkSession
    buckets = scored.groupBy(grid_bucket(F.col(prob), n_thresholds).alias("k")).agg(
        F.sum(_label(label)).alias("pos"), F.sum(1 - _label(label)).alias("neg"))
    dense = spark.range(n_thresholds + 1).select(F.col("id").cast("int").alias("k")).join(buckets, "k", "left").fillna(0)
    upto = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # n + 1 rows only
    every = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    j = dense.select("k", F.sum("pos").over(upto).alias("_pos_le"), F.sum("neg").over(upto).alias("_neg_le"),
                     F.sum("pos").over(every).alias("P"), F.sum("neg").over(every).alias("N")).where(F.col("k") < n_thresholds)
    tp = F.col("P") - F.col("_pos_le")
    fp = F.col("N") - F.col("_neg_le")
    return j.select(
        F.col("k").alias("threshold_index"), _grid_value(F.col("k"), n_thresholds).alias("threshold"),
        tp.alias("tp"), fp.alias("fp"), (F.col("P") - tp).alias("fn"), (F.col("N") - fp).alias("tn"),
        safe_div(tp, tp + fp).alias("precision"), safe_div(tp, F.col("P")).alias("recall"),
        _fbeta(tp, F.col("P"), tp + fp, 1.0).alias("f1"), _fbeta(tp, F.col("P"), tp + fp, 2.0).alias("f2"),
    ).orderBy("threshold_index")


def select_threshold(scored: DataFrame, criterion: str = "f1", n_thresholds: int = 101, label: str = "label",
                     prob: str = "prob") -> DataFrame:
    """EV7: grid threshold maximising the criterion; the lowest threshold wins ties."""
    if criterion == "youden":
        return youden_threshold(scored, label, prob)
    if criterion not in ("f1", "f2", "precision", "recall"):
        raise ValueError(f"no threshold can be selected by {criterion!r}")
    sweep = threshold_sweep(scored, n_thresholds, label, prob)
    best = sweep.agg(F.max_by(F.struct("threshold", F.col(criterion).alias("score")),
                              F.struct(F.col(criterion), -F.col("threshold"))).alias("b"))
    return best.select(F.lit(criterion).alias("criterion"), "b.threshold", "b.score")


def youden_threshold(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV8: distinct score maximising TPR - FPR (highest score on ties); +inf when no J > 0."""
    c = cumulative(scored, label, prob)
    j = F.try_divide("cum_tp", "P") - F.try_divide("cum_fp", "N")  # null for a single class
    best = c.agg(F.max(j).alias("_j"), F.max_by("prob", F.struct(j, F.col("prob"))).alias("_p"))
    thr = F.when(F.col("_j") > 0, F.col("_p")).otherwise(F.lit(float("inf")))
    return best.select(F.lit("youden").alias("criterion"), thr.alias("threshold"), F.col("_j").alias("score"))


def calibration(scored: DataFrame, n_bins: int = 10, min_count: int = 5, label: str = "label",
                prob: str = "prob") -> DataFrame:
    """EV10: quantile bins (lo, hi] with the minimum included, duplicate edges dropped; bins with
    >= min_count rows: bin, mean_predicted, mean_observed, count."""
    c = cumulative(scored, label, prob)  # rows per distinct score: the input is read once
    rows, total = F.col("tp") + F.col("fp"), F.col("P") + F.col("N")
    upto = total - (F.col("cum_tp") + F.col("cum_fp")) + rows  # rows at or below this score
    grid = linspace(n_bins + 1)
    ranks = []
    for i, q in enumerate(grid):
        low = F.floor((total - 1).cast("double") * q)
        ranks += [F.min(F.when(upto >= low + 1, F.col("prob"))).alias(f"_a{i}"),
                  F.min(F.when(upto >= F.least(low + 2, total), F.col("prob"))).alias(f"_b{i}")]
    found = c.agg(F.max(total).alias("_n"), *ranks)
    quantiles = []
    for i, q in enumerate(grid):
        h = (F.col("_n") - 1).cast("double") * q
        t, a, b = h - F.floor(h), F.col(f"_a{i}"), F.col(f"_b{i}")
        quantiles.append(F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t))
    edges = found.select(F.array_distinct(F.array(*quantiles)).alias("_edges"))  # n_bins + 1 values
    j = _one_row_join(c, edges)
    bin_ = F.greatest(F.lit(1), F.size(F.filter("_edges", lambda e: e < F.col("prob"))))
    out = j.groupBy(bin_.alias("bin")).agg((F.sum(F.col("prob") * rows) / F.sum(rows)).alias("mean_predicted"),
                                            (F.sum("tp") / F.sum(rows)).alias("mean_observed"), F.sum(rows).alias("count"))
    return out.where(F.col("count") >= min_count).orderBy("bin")


def pr_curve(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV11: one (threshold, precision, recall) point per distinct score, and the end point of
    recall 0 and precision 1, which has no threshold."""
    c = cumulative(scored, label, prob)
    points = c.select(F.col("prob").alias("threshold"), safe_div("cum_tp", F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
                      safe_div("cum_tp", "P").alias("recall"))
    end = scored.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.union(end).orderBy(F.desc_nulls_first("threshold"))


def roc_curve(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV11: one (threshold, fpr, tpr) point per distinct score, from (0, 0) at infinity on."""
    c = cumulative(scored, label, prob)
    points = c.select(F.col("prob").alias("threshold"), safe_div("cum_fp", "N").alias("fpr"), safe_div("cum_tp", "P").alias("tpr"))
    start = scored.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.union(start).orderBy(F.desc("threshold"))


def risk_histogram(scored: DataFrame, bins: int = 30, label: str = "label", prob: str = "prob") -> DataFrame:
    """EV12: equal-width histogram of scores per class over the class's own [min, max]
    (last bin closed; a constant class is centred in a unit-wide range)."""
    rng = scored.groupBy(_label(label).alias("label")).agg(F.min(prob).alias("_lo"), F.max(prob).alias("_hi"))
    lo = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    hi = F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    rng = rng.select("label", lo.alias("lo"), hi.alias("hi"))  # one row per class
    j = scored.select(_label(label).alias("label"), F.col(prob).alias("_p")).join(F.broadcast(rng), "label")
    b = F.least(F.lit(bins), F.floor((F.col("_p") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int") + 1)
    width = (F.col("hi") - F.col("lo")) / bins
    out = j.groupBy("label", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"), F.first("lo").alias("lo"),
                                                  F.first("hi").alias("hi"))
    return out.select("label", "bin", "count", (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_start"),
                      (F.col("lo") + F.col("bin") * width).alias("bin_end")).orderBy("label", "bin")
