"""Registered queries over the driver tables (keys follow the operator inventory)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.models import preprocess
from cohortlens.operators import funnel
from cohortlens.plans import faults
from cohortlens.plans import oracle as O
from cohortlens.plans.catalog import ORACLES, QUERIES, register, rounded
from cohortlens.session import apply_engine_conf, ensure_checkpoint_dir
from cohortlens.sources import layout, testdata
from cohortlens.sources.testdata import ADAPTER_FUNNEL_STEPS

STEPS = ADAPTER_FUNNEL_STEPS


# ---------------------------------------------------------------- FN ---------------------------

@register("funnel", lambda: O.funnel_sql(None))
def q_funnel(spark, t):
    """FN3: the ordered seven-step funnel over all users."""
    return funnel.compute_funnel(t.users, t.events, steps=STEPS)


@register("funnel_by_channel", lambda: O.funnel_sql("acquisition_channel"))
def q_funnel_by_channel(spark, t):
    """FN4: the same funnel per acquisition channel."""
    return funnel.compute_funnel(t.users, t.events, group_by="acquisition_channel", steps=STEPS)


@register("funnel_by_layout", lambda: O.funnel_sql(None))
def q_funnel_by_layout(spark, t):
    """IO3 + FN3: the funnel from the log laid out by user, whose events no step moves."""
    laid = layout.staged_layout(t.users.select("user_id"), t.events.select("user_id", "event_name", "event_timestamp", "event_source"))
    return funnel.funnel_table(laid.per_user(lambda users, events: funnel.user_step_flags(users, events, STEPS)), STEPS)


# ---------------------------------------------------------------- RT / RP4 ---------------------
from cohortlens.operators import retention  # noqa: E402


def _day_retention(day):
    def q(spark, t):
        return retention.compute_day_retention(t.users, t.events, day)

    q.__doc__ = f"RT3: day-{day} retention over all users."
    return q


for _d in (1, 7, 14):
    register(f"day_retention_{_d}", (lambda d=_d: O.day_retention_sql(d)))(_day_retention(_d))


@register("day_retention_by_channel", lambda: O.day_retention_sql(7, "acquisition_channel"))
def q_day_retention_by_channel(spark, t):
    """RT3 grouped: day-7 retention per acquisition channel."""
    return retention.compute_day_retention(t.users, t.events, 7, group_by="acquisition_channel")


@register("cohort_retention_week", lambda: O.cohort_sql("signup_week"))
def q_cohort_week(spark, t):
    """RT4/RT5: cohort matrix by Monday-Sunday signup week, days 1/7/14."""
    return retention.compute_cohort_retention(t.users, t.events, (1, 7, 14), "signup_week")


@register("cohort_retention_channel", lambda: O.cohort_sql("acquisition_channel"))
def q_cohort_channel(spark, t):
    """RT6: cohort matrix by acquisition channel."""
    return retention.compute_cohort_retention(t.users, t.events, (1, 7, 14), "acquisition_channel")


@register("cohort_retention_device", lambda: O.cohort_sql("device_type"))
def q_cohort_device(spark, t):
    """RT6: cohort matrix by device type."""
    return retention.compute_cohort_retention(t.users, t.events, (1, 7, 14), "device_type")


@register("cohort_pivot", lambda: O.cohort_pivot_sql())
def q_cohort_pivot(spark, t):
    """RT9: signup-week x day wide table."""
    cohort = retention.compute_cohort_retention(t.users, t.events, (1, 7, 14), "signup_week")
    return retention.cohort_pivot(cohort, (1, 7, 14))


@register("rolling_retention_7", lambda: O.rolling_sql(7))
def q_rolling(spark, t):
    """RT7: rolling 7-day retention (last action instant >= signup + 7 x 24 h)."""
    return retention.compute_rolling_retention(t.users, t.events, 7)


@register("retention_by_variant", lambda: O.retention_by_variant_sql(7))
def q_retention_by_variant(spark, t):
    """RT8: day-7 retention per onboarding variant."""
    return retention.compute_retention_by_variant(t.users, t.events, t.assignments, 7)


@register("retention_summary", lambda: O.retention_summary_sql())
def q_retention_summary(spark, t):
    """RP4: D1/D7/D14 and rolling D7 retention rows."""
    return retention.retention_summary(t.users, t.events)


# ---------------------------------------------------------------- AS / EX ----------------------
from cohortlens.operators import assignment, experiment  # noqa: E402


@register("variant_assignment", lambda: O.variant_assignment_sql())
def q_variant_assignment(spark, t):
    """AS1: md5 bucket and variant of every user."""
    return t.users.select("user_id", assignment.variant_bucket(F.col("user_id")).alias("bucket"),
                          assignment.assign_variant(F.col("user_id")).alias("variant_id"))


@register("assignments_converted", lambda: O.assignments_sql())
def q_assignments(spark, t):
    """AS2 + AS3: assignment rows with is_converted from onboarding completion."""
    return t.assignments


@register("variant_sample_sizes", lambda: O.sample_sizes_sql())
def q_sample_sizes(spark, t):
    """EX2: assignment rows per variant."""
    return experiment.sample_sizes(t.assignments, "exp_onboarding_v1")


@register("srm_test", lambda: O.srm_sql())
def q_srm(spark, t):
    """EX3: sample-ratio-mismatch chi-square test."""
    return experiment.srm_test(t.assignments)


@register("experiment_summary", lambda: O.experiment_summary_sql())
def q_experiment_summary(spark, t):
    """RP5: variant, n, rate, relative lift and p-value per metric."""
    return experiment.experiment_summary(experiment.analyze_experiment(t.users, t.events, t.assignments))


@register("experiment_metrics", lambda: O.experiment_sql())
def q_experiment(spark, t):
    """EX1/EX4-EX7: per metric x variant conversion, lift, p-value and CI."""
    return experiment.analyze_experiment(t.users, t.events, t.assignments)


# ---------------------------------------------------------------- LB / RP ----------------------
from cohortlens.operators import reports  # noqa: E402


@register("churn_labels", lambda: O.labels_sql())
def q_labels(spark, t):
    """LB1: churn labels of users with a fully observed label window."""
    return t.labels


@register("churn_by_channel", lambda: O.churn_by_channel_sql())
def q_churn_by_channel(spark, t):
    """RP3: churn rate per acquisition channel."""
    return reports.churn_by_group(t.users, t.labels)


@register("dataset_summary", lambda: O.dataset_summary_sql())
def q_dataset_summary(spark, t):
    """RP1/RP7: users, events, events per user, labelled users, churn rate."""
    return reports.dataset_summary(t.users, t.events, t.labels)


@register("channel_overview", lambda: O.channel_overview_sql())
def q_channel_overview(spark, t):
    """RP2: users and share per acquisition channel."""
    return reports.channel_overview(t.users)


@register("user_sample", lambda: O.user_sample_sql())
def q_user_sample(spark, t):
    """RP6: deterministic 10-user sample (top-k by md5 key)."""
    return reports.sample_users(t.users, 10)


# ---------------------------------------------------------------- DQ ---------------------------
from cohortlens.operators import quality  # noqa: E402


@register("dq_report", lambda: O.dq_report_sql())
def q_dq_report(spark, t):
    """DQ1-DQ23: full validation report (one row per check)."""
    return quality.validate(t.users, t.events, t.assignments, t.labels, t.interventions,
                            session_order_cols=["ingest_file", "ingest_seq"], ordered_events=t.events_in_ingest_order,
                            hot_users=t.hot_users)


@register("dq_passed", lambda: O.dq_passed_sql())
def q_dq_passed(spark, t):
    """Overall validation verdict (no failed error-severity check)."""
    return quality.report_passed(q_dq_report(spark, t))


@register("dq_report_faults", lambda: O.dq_faults_sql())
def q_dq_faults(spark, t):
    """DQ1-DQ23 over the same tables with faults in every checked place."""
    events = faults.faulty_events(t.events)
    return quality.validate(faults.faulty_users(t.users), events, faults.faulty_assignments(t.assignments), t.labels,
                            faults.faulty_interventions(t.interventions), data_freeze=t.observed_until, session_order_cols=["ingest_seq"])


@register("dq_offending_values", lambda: O.offending_sql())
def q_dq_offending(spark, t):
    """DQ3-DQ8 in detail: the most frequent values outside each domain of the faulty tables."""
    users, events = faults.faulty_users(t.users), faults.faulty_events(t.events)
    found = [quality.offending_values(users, c, quality.USER_DOMAINS[c]) for c in ("acquisition_channel", "device_type")]
    found += [quality.offending_values(events, c, d) for c, d in (("event_name", config.ALL_EVENT_NAMES), ("event_source", config.EVENT_SOURCES),
                                                                  ("platform", config.PLATFORMS))]
    return reduce(DataFrame.union, found)


# ---------------------------------------------------------------- FE / LB4 ---------------------
from cohortlens.operators import features, labels  # noqa: E402

_STATIC_COLS = ["acquisition_channel", "country", "device_type", "user_intent_level", "career_stage",
                "language", "timezone", "onboarding_variant", *features.FEATURE_FAMILIES["static"]]


def _feature_query(cols):
    def q(spark, t):
        return features.build_model_features(t.users, t.events, t.assignments, hot_users=t.hot_users).select("user_id", *cols)

    return q


for _fam, _cols in [("static", _STATIC_COLS), ("counts", features.FEATURE_FAMILIES["counts"]),
                    ("sessions", features.FEATURE_FAMILIES["sessions"]), ("time", features.FEATURE_FAMILIES["time"])]:
    _q = _feature_query(_cols)
    _q.__doc__ = f"FE: {_fam} feature family for every user."
    register(f"features_{_fam}", (lambda c=_cols: O.features_sql(c)))(_q)


@register("feature_matrix", lambda: O.features_sql())
def q_feature_matrix(spark, t):
    """FE20: the full 37-feature matrix for every user."""
    return features.build_model_features(t.users, t.events, t.assignments, hot_users=t.hot_users)


@register("model_matrix", lambda: O.model_matrix_sql())
def q_model_matrix(spark, t):
    """LB4: feature matrix of labelled users with is_churned attached (leakage-checked)."""
    return labels.prepare_model_matrix(t.users, t.events, t.labels, t.assignments, hot_users=t.hot_users)


# ---------------------------------------------------------------- NB / IV ----------------------
from cohortlens.operators import decisions, interventions  # noqa: E402


@register("user_state", lambda: O.user_state_sql())
def q_user_state(spark, t):
    """NB1: lifecycle flags at signup + 7d for every user."""
    return decisions.compute_user_state(t.users, t.events, hot_users=t.hot_users)


@register("next_best_action", lambda: O.next_best_action_sql())
def q_next_best_action(spark, t):
    """NB2: rule-based next best action for every user (activity heuristic, no model score)."""
    return decisions.recommend_next_action(t.users, t.events, hot_users=t.hot_users)


@register("next_best_action_scored", lambda: O.next_best_action_sql(scored=True))
def q_next_best_action_scored(spark, t):
    """NB2/NB3: next best action driven by a churn score (the portable recency score of the labelled
    users; others fall back on the activity heuristic)."""
    scores = recency_scored(t).select("user_id", F.col("prob").alias("churn_risk_score"))
    return decisions.recommend_next_action(t.users, t.events, scores, hot_users=t.hot_users)


@register("preprocessed_matrix", lambda: O.preprocessed_sql())
def q_preprocessed(spark, t):
    """ML1-ML3, ML7: the one-hot, imputed and scaled training matrix in long form (zero one-hot slots
    left out), with statistics of the train part."""
    matrix = labels.prepare_model_matrix(t.users, t.events, t.labels, t.assignments, hot_users=t.hot_users)
    users_split, _ = split.split_users_and_labels(t.signups, t.labels)
    ensure_checkpoint_dir(spark)
    train = split.filter_split(matrix, users_split, split.TRAIN).checkpoint()  # fitting passes over it several times
    spec = preprocess.fit_spec(train)
    ready = preprocess.fit_preprocessor(train, spec).transform(train)
    names = F.array(*[F.lit(n) for n in spec.feature_names()])
    slots = ready.select("user_id", F.posexplode(vector_to_array("features")).alias("pos", "value"))
    named = slots.select("user_id", F.get(names, F.col("pos")).alias("feature"), "value")
    return named.where(F.col("feature").startswith("num__") | (F.col("value") != 0.0))


@register("first_week_activity", lambda: O.first_week_activity_sql())
def q_first_week_activity(spark, t):
    """IV2: distinct active day indices 0..7 and onboarding completion per user."""
    return interventions.first_week_activity(t.users, t.events, hot_users=t.hot_users)


@register("intervention_plan", lambda: O.intervention_plan_sql())
def q_intervention_plan(spark, t):
    """IV1: targeted intervention per user (action, send time, channel)."""
    return t.interventions


# ---------------------------------------------------------------- SP / EV ----------------------
from cohortlens.operators import evaluate, split, subgroup  # noqa: E402


def recency_scored(t, with_groups: bool = False):
    """Engine-portable churn score for the evaluation operators: hours since the last action at
    the cutoff / 168 (1.0 without actions); label = is_churned."""
    groups = list(subgroup.DEFAULT_GROUPS) if with_groups else []
    base = t.labels.select("user_id", F.col("is_churned").alias("label"))
    if groups:
        base = base.join(t.users.select("user_id", *groups), "user_id")
    m = base.join(features.recency_hours(t.users, t.events, hot_users=t.hot_users), "user_id", "left")
    prob = F.coalesce(F.col("hours_since_last_action_at_cutoff") / 168.0, F.lit(1.0))
    return m.select("user_id", "label", prob.alias("prob"), *groups)


@register("chronological_split", lambda: O.split_sql())
def q_split(spark, t):
    """SP1/SP2: 60/20/20 chronological split of users by (signup, user_id)."""
    return split.chronological_split(t.signups)


@register("split_report", lambda: O.split_report_sql())
def q_split_report(spark, t):
    """SP3/SP4: labelled matrix rows per split with signup range and churn rate."""
    users_split, _ = split.split_users_and_labels(t.signups, t.labels)
    m = labels.prepare_model_matrix(t.users, t.events, t.labels, t.assignments, hot_users=t.hot_users)
    return split.split_report(m.join(users_split.select("user_id", "split"), "user_id"))


@register("recency_scores", lambda: O.scored_sql())
def q_scores(spark, t):
    """Deterministic recency score per labelled user (input of the EV queries)."""
    return recency_scored(t)


@register("metrics_at_threshold", lambda: O.metrics_sql(["threshold", "precision", "recall", "f1_score", "accuracy"]))
def q_metrics_at_threshold(spark, t):
    """EV5: precision / recall / F1 / accuracy at 0.5."""
    return evaluate.threshold_metrics(recency_scored(t), 0.5)


@register("pr_auc", lambda: O.metrics_sql(["pr_auc"]))
def q_pr_auc(spark, t):
    """EV1: average precision."""
    return evaluate.average_precision(recency_scored(t))


@register("roc_auc", lambda: O.metrics_sql(["roc_auc"]))
def q_roc_auc(spark, t):
    """EV2: ROC AUC."""
    return evaluate.roc_auc(recency_scored(t))


@register("logloss_brier", lambda: O.metrics_sql(["log_loss", "brier_score"]))
def q_logloss_brier(spark, t):
    """EV3/EV4: log loss and Brier score."""
    return evaluate.probability_scores(recency_scored(t))


@register("metrics_bundle", lambda: O.metrics_sql(["pr_auc", "roc_auc", "log_loss", "brier_score", "threshold",
                                                   "precision", "recall", "f1_score", "accuracy"]))
def q_metrics_bundle(spark, t):
    """EV6: the nine-metric bundle at 0.5."""
    return evaluate.compute_metrics(recency_scored(t), 0.5)


@register("threshold_sweep", lambda: O.sweep_sql())
def q_threshold_sweep(spark, t):
    """EV7 input: confusion counts and scores at the 101 grid thresholds."""
    return evaluate.threshold_sweep(recency_scored(t))


@register("select_threshold", lambda: O.select_threshold_sql("f1"))
def q_select_threshold(spark, t):
    """EV7: F1-maximising grid threshold (lowest wins ties)."""
    return evaluate.select_threshold(recency_scored(t), "f1")


@register("select_threshold_f2", lambda: O.select_threshold_sql("f2"))
def q_select_threshold_f2(spark, t):
    """EV7: F2-maximising grid threshold."""
    return evaluate.select_threshold(recency_scored(t), "f2")


@register("youden_threshold", lambda: O.youden_sql())
def q_youden(spark, t):
    """EV8: Youden-J threshold over distinct scores."""
    return evaluate.youden_threshold(recency_scored(t))


@register("confusion_matrix", lambda: O.confusion_sql(0.5))
def q_confusion(spark, t):
    """EV9: confusion counts at 0.5."""
    return evaluate.confusion_counts(recency_scored(t), 0.5)


@register("calibration", lambda: O.calibration_sql())
def q_calibration(spark, t):
    """EV10: decile (quantile-edge) calibration table."""
    return evaluate.calibration(recency_scored(t))


@register("pr_curve", lambda: O.pr_curve_sql())
def q_pr_curve(spark, t):
    """EV11: precision-recall points per distinct score."""
    return evaluate.pr_curve(recency_scored(t))


@register("roc_curve", lambda: O.roc_curve_sql())
def q_roc_curve(spark, t):
    """EV11: ROC points per distinct score."""
    return evaluate.roc_curve(recency_scored(t))


@register("risk_histogram", lambda: O.histogram_sql())
def q_risk_histogram(spark, t):
    """EV12: 30-bin score histogram per class."""
    return evaluate.risk_histogram(recency_scored(t))


@register("subgroup_metrics", lambda: O.subgroup_sql(0.5))
def q_subgroup(spark, t):
    """EV13: metrics per channel / stage / device value at 0.5."""
    return subgroup.evaluate_subgroups(recency_scored(t, True).withColumnRenamed("label", "is_churned"), 0.5)


# ---------------------------------------------------------------- ML / XP / NB3-4 (rows-only) --
from cohortlens.models import explain as XP  # noqa: E402
from cohortlens.models import linear_table, tree_table  # noqa: E402
from cohortlens.models import train as ML  # noqa: E402
from cohortlens.plans import training  # noqa: E402


def _all_features(t):
    return features.build_model_features(t.users, t.events, t.assignments, hot_users=t.hot_users)


def _ml_query(key, oracle=None):
    """Register an ML query; the fitted models are shared by every ML key of a session."""
    def deco(fn):
        def run(spark, sf_dir):
            apply_engine_conf(spark)
            t = testdata.load(spark, sf_dir)
            data, result = training.trained(t)
            return rounded(fn(spark, t, data, result))

        run.__name__ = f"query_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


@_ml_query("model_selection")
def q_model_selection(spark, t, data, result):
    """ML6: candidate validation metrics and the selected model's validation / test metrics."""
    return training.model_selection_report(result, spark)


@_ml_query("lr_scores", lambda: O.lr_scores_sql())
def q_lr_scores(spark, t, data, result):
    """ML4/ML8: logistic-regression churn probability for every test user, from the model's table."""
    return linear_table.score_by_table(data.test, training.linear_view(result, data).table, ["user_id", config.TARGET_COLUMN])


@_ml_query("linear_model", lambda: O.linear_model_sql())
def q_linear_model(spark, t, data, result):
    """ML1-ML4, XP1: the fitted linear model as a table, one row a slot and one for the constant."""
    return training.linear_view(result, data).table.select("feature", "fill", "mean", "scale", "weight")


@_ml_query("linear_contributions", lambda: O.linear_contributions_sql())
def q_linear_contributions(spark, t, data, result):
    """XP4: what every slot adds to every user's margin."""
    return linear_table.contributions(_all_features(t), training.linear_view(result, data).table).where("feature <> 'constant'").drop("slot")


@_ml_query("user_factors", lambda: O.user_factors_sql())
def q_user_factors(spark, t, data, result):
    """XP4: every user's five strongest contributions in each direction, a row each."""
    candidate, view = result.candidates[ML.LR], training.linear_view(result, data)
    top = XP.explain_linear(candidate.pipeline, candidate.spec, _all_features(t), weights=view.weights)
    sides = [top.select("user_id", F.lit(side).alias("direction"), F.posexplode(f"{side}_factors").alias("rank", "f")) for side in ("positive", "negative")]
    return sides[0].union(sides[1]).select("user_id", "direction", (F.col("rank") + 1).alias("rank"), "f.feature", "f.contribution")


@_ml_query("linear_decisions", lambda: O.linear_decisions_sql())
def q_linear_decisions(spark, t, data, result):
    """NB3: score, predicted class and next best action of every user by the linear model."""
    return training.score_users(result, t, linear=training.linear_view(result, data))


@_ml_query("linear_examples", lambda: O.linear_examples_sql())
def q_linear_examples(spark, t, data, result):
    """NB4: five high-risk and five low-risk test users by the linear model."""
    return training.nba_examples(result, t, data.test, linear=training.linear_view(result, data))


@_ml_query("gbt_scores")
def q_gbt_scores(spark, t, data, result):
    """ML5/ML8: boosted-trees churn probability for every test user."""
    return ML.score(result.candidates[ML.GBT].pipeline, data.test, ["user_id", config.TARGET_COLUMN])


@_ml_query("lr_coefficients", lambda: O.lr_coefficients_sql())
def q_lr_coefficients(spark, t, data, result):
    """XP1/XP2: logistic coefficients by one-hot / numeric slot, largest magnitude first."""
    view = training.linear_view(result, data)
    return XP.extract_logistic_coefficients(result.candidates[ML.LR].pipeline, result.candidates[ML.LR].spec, view.weights)


@_ml_query("permutation_importance")
def q_permutation_importance(spark, t, data, result):
    """XP3: permutation importance of the 37 input features on the validation split (10 repeats)."""
    return XP.permutation_importance(result.model, result.spec, data.val, result.inputs, n_repeats=10)


@_ml_query("user_explanations")
def q_user_explanations(spark, t, data, result):
    """XP4: top +/- linear contributions for every user."""
    return XP.explain_linear(result.candidates[ML.LR].pipeline, result.candidates[ML.LR].spec, _all_features(t))


@_ml_query("tree_explanations")
def q_tree_explanations(spark, t, data, result):
    """XP5: zero-out marginal contributions of the boosted model for every user."""
    return XP.explain_tree(result.candidates[ML.GBT].pipeline, result.candidates[ML.GBT].spec, _all_features(t))


@_ml_query("tree_model")
def q_tree_model(spark, t, data, result):
    """ML5: the boosted ensemble as a table, one row a node (what ``tree_explanations`` walks)."""
    return tree_table.model_table(result.candidates[ML.GBT].pipeline.stages[-1])


@_ml_query("global_explanation")
def q_global_explanation(spark, t, data, result):
    """XP6: top-15 coefficients and top-15 permutation importances of the selected model."""
    imp = XP.permutation_importance(result.model, result.spec, data.val, result.inputs, n_repeats=10)
    return XP.global_explanation(result.model, result.spec, imp)


@_ml_query("user_report")
def q_user_report(spark, t, data, result):
    """XP7: explanations of a deterministic 3-user test sample with the actual label."""
    return training.user_report(result, reports.sample_users(data.test, 3))


@_ml_query("model_subgroups")
def q_model_subgroups(spark, t, data, result):
    """EV13 on the selected model's test scores at its threshold."""
    scored = training.test_scores(result, data, list(subgroup.DEFAULT_GROUPS))
    return subgroup.evaluate_subgroups(scored.withColumnRenamed("label", config.TARGET_COLUMN), result.threshold)


@_ml_query("model_calibration")
def q_model_calibration(spark, t, data, result):
    """EV10 on the selected model's test scores."""
    return evaluate.calibration(training.test_scores(result, data))


@_ml_query("nba_scored")
def q_nba_scored(spark, t, data, result):
    """NB3: model score, predicted class and score-driven next best action for every user."""
    return training.score_users(result, t)


@_ml_query("nba_examples")
def q_nba_examples(spark, t, data, result):
    """NB4: five high-risk and five low-risk test users with their recommended action."""
    return training.nba_examples(result, t, data.test)


@_ml_query("model_roundtrip", lambda: O.model_roundtrip_sql())
def q_model_roundtrip(spark, t, data, result):
    """IO6: save / load the selected pipeline; predictions must not change (mismatches = 0)."""
    return training.model_roundtrip(result, data)
