"""Fixed domain values and default parameters.

FIXED VALUES: the names, domains and constants below must stay exactly as written for results to
match the lifecycle model this engine reproduces (event vocabulary, funnel order, variant split,
label window, thresholds). Every operator takes them as keyword defaults, so callers can override.
"""

from __future__ import annotations

from datetime import datetime

# --- FIXED VALUES: time windows (days after signup) -------------------------------------------
PREDICTION_CUTOFF_DAY = 7
LABEL_WINDOW_START_DAY = 8
LABEL_WINDOW_END_DAY = 21
# data freeze used by the observation-window check (naive UTC)
DATA_FREEZE = datetime(2026, 6, 1, 23, 59, 59)

# --- FIXED VALUES: categorical domains --------------------------------------------------------
ACQUISITION_CHANNELS = ["organic_search", "social_ads", "campus_event", "referral", "content_marketing"]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
CAREER_STAGES = ["student", "new_graduate", "early_career"]
USER_INTENT_LEVELS = ["low", "medium", "high"]
PLATFORMS = ["web", "ios", "android"]
INTERVENTION_CHANNELS = ["email", "push", "in_app"]
EVENT_SOURCES = ["user_action", "system", "campaign"]

# --- FIXED VALUES: event vocabulary -----------------------------------------------------------
CORE_EVENTS = [
    "signup",
    "onboarding_start",
    "onboarding_complete",
    "profile_complete",
    "resume_upload",
    "job_recommendation_view",
    "job_save",
    "growth_task_complete",
    "career_report_generate",
]
EXTRA_EVENTS = [
    "session_start",
    "session_end",
    "job_detail_view",
    "ai_assistant_interaction",
    "return_visit",
    "email_sent",
    "push_sent",
    "in_app_message_sent",
]
ALL_EVENT_NAMES = CORE_EVENTS + EXTRA_EVENTS

FUNNEL_STEPS = [
    "signup",
    "onboarding_complete",
    "profile_complete",
    "resume_upload",
    "job_recommendation_view",
    "job_save",
    "career_report_generate",
]

# --- FIXED VALUES: onboarding experiment ------------------------------------------------------
ONBOARDING_EXPERIMENT_ID = "exp_onboarding_v1"
ONBOARDING_EXPERIMENT_NAME = "Onboarding Flow Optimization"
ONBOARDING_EXPERIMENT_TYPE = "onboarding"
# (variant_id, allocation) in assignment order
ONBOARDING_VARIANTS = [("control", 0.40), ("personalized", 0.30), ("simplified", 0.30)]
CONTROL_VARIANT = "control"
DEFAULT_EXPERIMENT_METRICS = {
    "onboarding_completion_rate": "onboarding_complete",
    "profile_completion_rate": "profile_complete",
    "d7_retention_rate": "d7_retention",
}

# --- FIXED VALUES: thresholds -----------------------------------------------------------------
HIGH_RISK_ACTION_THRESHOLD = 0.70
SMALL_SAMPLE_THRESHOLD = 50
SRM_ALPHA = 0.01
CHURN_RATE_RANGE = (0.25, 0.45)
EVENT_PROPERTIES_MISSING_MAX = 0.05
CAMPAIGN_SHARE_MAX = 0.20
RARE_CATEGORY_FRACTION = 0.01
Z_95 = 1.96

# --- FIXED VALUES: leakage rules --------------------------------------------------------------
LEAKAGE_PREFIXES = ("future_", "post_", "label_")
LEAKAGE_COLUMNS = {
    "last_active_date",
    "days_since_last_active",
    "current_stage",
    "churn_risk_score",
    "conversion_propensity_score",
    "is_churned",
}

# --- FIXED VALUES: model matrix layout --------------------------------------------------------
CATEGORICAL_FEATURES = [
    "acquisition_channel",
    "country",
    "device_type",
    "user_intent_level",
    "career_stage",
    "onboarding_variant",
    "language",
    "timezone",
]
NUMERIC_FEATURES = [
    "signup_hour",
    "signup_day_of_week",
    "marketing_consent",
    "onboarding_started",
    "onboarding_complete",
    "profile_complete",
    "resume_upload",
    "job_recommendation_view",
    "job_save",
    "growth_task_complete",
    "career_report_generate",
    "num_core_actions_completed",
    "num_sessions",
    "num_user_actions",
    "num_days_active",
    "num_email_sent",
    "num_push_sent",
    "num_in_app_sent",
    "avg_events_per_session",
    "max_events_in_session",
    "total_user_actions_in_sessions",
    "unique_event_type_count",
    "first_day_event_count",
    "last_2_days_event_count",
    "hours_to_first_action",
    "hours_since_last_action_at_cutoff",
    "ai_assistant_interaction_count",
    "job_detail_view_count",
    "return_visit_count",
]
NULLABLE_NUMERIC_FEATURES = ("hours_to_first_action", "hours_since_last_action_at_cutoff")
ALL_FEATURE_COLUMNS = CATEGORICAL_FEATURES + NUMERIC_FEATURES
TARGET_COLUMN = "is_churned"
ID_COLUMNS = ("user_id", "signup_timestamp")

# --- FIXED VALUES: next-best-action rules (action, reason), in priority order ----------------
NBA_REENGAGE = "send_reengagement_message"
NBA_REASON_HIGH_RISK_CONSENT = "high churn risk with marketing consent"
NBA_REASON_HIGH_RISK_NO_CONSENT = "high churn risk without marketing consent"
# (state flag, action_name, reason) for the in-app steps
NBA_STEP_RULES = [
    ("onboarding_completed", "complete_onboarding", "onboarding not completed"),
    ("profile_completed", "complete_profile", "profile not completed"),
    ("resume_uploaded", "upload_resume", "resume not uploaded"),
    ("job_recommendation_viewed", "view_job_recommendations", "job recommendations not viewed"),
    ("job_saved", "save_relevant_job", "job viewed but not saved"),
    ("growth_task_completed", "complete_growth_task", "growth task not completed"),
    ("career_report_generated", "generate_career_report", "career report not generated"),
]
NBA_DONE = ("continue_weekly_engagement", "all core actions completed")
# user-state flag -> event name
STATE_EVENTS = {
    "onboarding_completed": "onboarding_complete",
    "profile_completed": "profile_complete",
    "resume_uploaded": "resume_upload",
    "job_recommendation_viewed": "job_recommendation_view",
    "job_saved": "job_save",
    "growth_task_completed": "growth_task_complete",
    "career_report_generated": "career_report_generate",
}

# --- FIXED VALUES: intervention targeting -----------------------------------------------------
IV_ONBOARDING = ("complete_onboarding", 3, ["email", "push", "in_app"])
IV_REENGAGE = ("send_reengagement_message", 7, ["email", "push"])
IV_WIN_BACK = ("send_win_back", LABEL_WINDOW_END_DAY + 1, ["email", "push"])

RANDOM_SEED = 42
