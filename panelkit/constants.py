"""Names and thresholds of the hourly vital-sign panel.

Everything below the "fixed values" marker must stay equal to the
published pipeline this library re-implements: column names, clinical
thresholds, category labels and the advice texts served with a tier.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# fixed values (must equal the published pipeline for equal results)
# ---------------------------------------------------------------------------

VITALS = ["HR", "O2Sat", "Temp", "SBP", "MAP", "DBP", "Resp"]

LABS = [
    "EtCO2", "BaseExcess", "HCO3", "FiO2", "pH", "PaCO2", "SaO2",
    "AST", "BUN", "Alkalinephos", "Calcium", "Chloride", "Creatinine",
    "Bilirubin_direct", "Glucose", "Lactate", "Magnesium", "Phosphate",
    "Potassium", "Bilirubin_total", "TroponinI", "Hct", "Hgb",
    "PTT", "WBC", "Fibrinogen", "Platelets",
]

DEMOGRAPHICS = ["Age", "Gender", "Unit1", "Unit2", "HospAdmTime"]

FEATURE_COLS = [
    "hr", "o2sat", "temp", "sbp", "map", "dbp", "resp",
    "age", "gender",
    "hr_mean_3h", "hr_mean_6h", "sbp_mean_3h", "map_mean_3h", "resp_mean_3h",
    "hr_trend", "sbp_trend", "temp_trend", "resp_trend",
    "hr_std_3h", "sbp_std_3h",
    "flag_tachy", "flag_hypoxia", "flag_fever", "flag_hypotemp",
    "flag_low_bp", "flag_tachypnea", "qsofa", "hours_in_icu",
]

PROFILE_FEATURES = [
    "avg_hr", "avg_temp", "avg_o2sat", "avg_sbp", "avg_map",
    "avg_resp", "max_qsofa", "had_tachy", "had_fever",
    "had_low_bp", "had_hypoxia", "total_icu_hours",
]

# rolling means: (output column, source column, rows in frame)
ROLLING_MEANS = [
    ("hr_mean_3h", "hr", 3),
    ("hr_mean_6h", "hr", 6),
    ("sbp_mean_3h", "sbp", 3),
    ("map_mean_3h", "map", 3),
    ("resp_mean_3h", "resp", 3),
]
# first differences: (output column, source column)
TRENDS = [
    ("hr_trend", "hr"),
    ("sbp_trend", "sbp"),
    ("temp_trend", "temp"),
    ("resp_trend", "resp"),
]
# rolling sample standard deviations: (output column, source column, rows)
ROLLING_STDS = [
    ("hr_std_3h", "hr", 3),
    ("sbp_std_3h", "sbp", 3),
]
# alarm flags: (output column, source column, comparison, threshold)
ALARM_FLAGS = [
    ("flag_tachy", "hr", ">", 100.0),
    ("flag_hypoxia", "o2sat", "<", 92.0),
    ("flag_fever", "temp", ">", 38.3),
    ("flag_hypotemp", "temp", "<", 36.0),
    ("flag_low_bp", "map", "<", 65.0),
    ("flag_tachypnea", "resp", ">", 22.0),
]
QSOFA_PARTS = ["flag_tachypnea", "flag_low_bp"]

# event binning for association mining: column -> (rules, default label)
# rules are (comparison, threshold, label), first match wins
EVENT_BINS = {
    "HR_EVENT": ("hr", [(">", 100.0, "HIGH_HR"), ("<", 60.0, "LOW_HR")], "NORMAL_HR"),
    "TEMP_EVENT": ("temp", [(">", 38.3, "FEVER"), ("<", 36.0, "HYPOTHERMIA")], "NORMAL_TEMP"),
    "O2_EVENT": ("o2sat", [("<", 92.0, "LOW_OXYGEN")], "NORMAL_OXYGEN"),
    "BP_EVENT": ("map", [("<", 65.0, "LOW_BP")], "NORMAL_BP"),
    "RESP_EVENT": ("resp", [(">", 22.0, "HIGH_RESP")], "NORMAL_RESP"),
    "QSOFA_EVENT": ("qsofa", [(">=", 2.0, "HIGH_QSOFA")], None),
    "SEPSIS_EVENT": ("sepsislabel", [("==", 1.0, "SEPSIS")], None),
}
EVENT_COLS = ["HR_EVENT", "TEMP_EVENT", "O2_EVENT", "BP_EVENT", "RESP_EVENT",
              "QSOFA_EVENT", "SEPSIS_EVENT"]
TARGET_ITEM = "SEPSIS"
MIN_SUPPORT = 0.05
MAX_ITEMSET_LEN = 3
MIN_CONFIDENCE = 0.3
FALLBACK_CONFIDENCE = 0.1
MIN_LIFT = 1.0
NEGATIVES_PER_POSITIVE = 3

# probability tiers (API): >= 0.7 high, >= 0.4 moderate, else low
PROB_TIERS = [(0.7, "HIGH RISK"), (0.4, "MODERATE RISK")]
LOW_TIER = "LOW RISK"
# neighbour-vote tiers: positives among k neighbours >= 5 high, >= 2 moderate
VOTE_TIERS = [(5, "HIGH RISK"), (2, "MODERATE RISK")]

# tier advice texts, API wording
API_ACTIONS = {
    "HIGH RISK": "Initiate sepsis protocol immediately. Order blood cultures & lactate. Start IV antibiotics within 1 hour.",
    "MODERATE RISK": "Increase monitoring to every 30 minutes. Order CBC and metabolic panel. Notify attending physician.",
    "LOW RISK": "Continue standard monitoring every 4 hours. No immediate intervention required.",
}
DEFAULT_ACTION = "Follow standard protocol"
# tier advice texts, batch look-alike job wording: (recommendation, action)
JOB_ACTIONS = {
    "HIGH RISK": ("Initiate sepsis protocol immediately",
                  "Order blood cultures, lactate, start IV antibiotics"),
    "MODERATE RISK": ("Increase monitoring frequency to every 30 minutes",
                      "Repeat vitals hourly, order CBC and metabolic panel"),
    "LOW RISK": ("Continue standard monitoring",
                 "Routine vitals every 4 hours"),
}

# alert list: (flag column, alert text) in served order, then qSOFA >= 2
ALERTS = [
    ("flag_tachy", "Tachycardia"),
    ("flag_fever", "Fever"),
    ("flag_hypoxia", "Hypoxia"),
    ("flag_low_bp", "Low Blood Pressure"),
    ("flag_tachypnea", "Tachypnea"),
]
QSOFA_ALERT = "High qSOFA"

TREND_MARGIN = 2.0                      # rising / falling / stable
HR_STATUS = [(120.0, "CRITICAL"), (100.0, "WARNING")]
HR_STATUS_DEFAULT = "NORMAL"
ZONES = [(1.5, "RED ZONE"), (0.5, "YELLOW ZONE")]
ZONE_DEFAULT = "GREEN ZONE"
FORECAST_ALERT_HR = 100.0

# segment names by ascending outcome rate
SEGMENT_LABELS = ["Stable Low Risk", "Elevated Risk",
                  "High Risk - Sepsis Likely", "Critical - Immediate Attention"]

OUTCOME_POSITIVE = "HAD SEPSIS"
OUTCOME_NEGATIVE = "No Sepsis"

WINDOW_SIZE = 6
SMOOTHING_ALPHA = 0.3
KNN_K = 10
TEST_FRACTION = 0.2
MEDICAL_RECALL_WEIGHT = 0.6
MEDICAL_AUROC_WEIGHT = 0.4
KMEANS_K = 4
KMEANS_RESTARTS = 10

# partial-record completion defaults (request model defaults)
RECORD_DEFAULTS = {
    "hr": 85.0, "o2sat": 96.0, "temp": 37.0, "sbp": 120.0, "map": 80.0,
    "dbp": 70.0, "resp": 16.0, "age": 50.0, "gender": 1.0,
    "hr_std_3h": 2.0, "sbp_std_3h": 3.0, "hours_in_icu": 1.0,
}
DBP_FROM_MAP_OFFSET = 10.0

# quality-gate floors
MIN_PANEL_ROWS = 700000
MIN_FEATURE_COLUMNS = 60
FLOOR_MEDICAL_SCORE = 0.5
CEIL_RMSE = 15.0
FLOOR_TRAIN_ROWS = 500000
FLOOR_RULES = 50
HR_RANGE = (30.0, 250.0)

# ---------------------------------------------------------------------------
# derived names (lower-case schema of the feature table)
# ---------------------------------------------------------------------------

VITALS_LC = [c.lower() for c in VITALS]
LABS_LC = [c.lower() for c in LABS]
FLAG_COLS = [f for f, _, _, _ in ALARM_FLAGS]
ENGINEERED = ([c for c, _, _ in ROLLING_MEANS] + [c for c, _ in TRENDS]
              + [c for c, _, _ in ROLLING_STDS] + FLAG_COLS
              + ["qsofa", "hours_in_icu"])
