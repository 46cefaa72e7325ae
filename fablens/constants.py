"""Costs, codes and texts that results must carry unchanged."""

# --- fixed values: money (GBP) and service parameters -----------------------
SCRAP_COST = 450.0
INSPECTION_COST = 25.0
WAFER_COST = 120.0
SERVICE_LEVEL_Z = 2.05
SERVICE_LEVEL = 0.98
LEAD_TIME_DAYS = 21
MONTHLY_TARGET = 1000
YIELD_TARGET_PCT = 95.0

# --- fixed values: quality gate ---------------------------------------------
MAX_MISSING_PCT = 50.0
MIN_FAIL_RATE = 0.1
MAX_MISSING_FEATURES = 0.30
FAIL_LABEL = 1
PASS_LABEL = -1
SENSOR_CATEGORY = "INSPECTION_METRIC"
REASON_MISSING = "HIGH_MISSING_RATE_GT_50_PCT"
REASON_CONSTANT = "ZERO_VARIANCE_CONSTANT_FEATURE"
REASON_NONE = "NONE"

# --- fixed values: texts that stand for a missing reading ---------------------
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: shifts -----------------------------------------------------
DAY_SHIFT = "DAY_SHIFT"
EVENING_SHIFT = "EVENING_SHIFT"
NIGHT_SHIFT = "NIGHT_SHIFT"

# --- fixed values: lot routing ----------------------------------------------
ELEVATED_RISK = 0.08
TIER_1 = "TIER_1_CRITICAL"
TIER_2 = "TIER_2_ELEVATED"
TIER_3 = "TIER_3_NOMINAL"
TIER_1_ACTION = "HOLD: Route to Inline Metrology & Defect Review Station"
TIER_2_ACTION = "MONITOR: Tool chamber drift detected; schedule preventative clean"
TIER_3_ACTION = "RELEASE: Nominal lot quality; fast-track to CMP / metallization"

# --- fixed values: threshold grid 0.02, 0.03, .. 0.90 ---------------------------
GRID_FIRST = 2
GRID_STEPS = 89

# --- fixed values: column names of the daily series and its features ------------
SERIES = ["total_runs", "defect_runs", "yield_rate_pct", "total_scrap_cost_gbp"]
FEATURES = ["defect_runs_lag1", "defect_runs_lag7", "defect_runs_roll7_mean", "defect_runs_roll7_std", "day_of_week"]

# --- fixed values: names of the candidate models ---------------------------------
DUMMY = "Dummy (Majority)"
LOGISTIC = "Logistic Regression (Cost-Sensitive)"
FOREST = "Balanced Random Forest"
BOOSTED = "Gradient Boosting (Class-Weighted)"

# --- fixed values: recommended action per sensor ----------------------------------
PLAYBOOK = [
    ("Attribute 60", "Chamber Plasma RF Matching - Inspect capacitor alignment and reflected power impedance"),
    ("Attribute 478", "Wafer Chuck Thermal Uniformity - Check helium backside cooling pressure"),
    ("Attribute 66", "Etch Gas Mass Flow Controller (MFC) - Verify halogen gas ratio flow stability"),
    ("Attribute 34", "Electrostatic Chuck (ESC) Clamping Voltage - Inspect chuck de-chucking charge"),
    ("Attribute 289", "Chamber Base Vacuum Pressure - Audit turbomolecular pump vibration and roughing line"),
    ("Attribute 429", "Lithography Exposure Lamp Intensity - Calibrate UV optic dose and focus budget"),
    ("Attribute 154", "Wet Clean Chemical Concentration - Replenish SC-1 bath ammonium hydroxide ratio"),
    ("Attribute 342", "Chemical Mechanical Polishing (CMP) Downforce - Check pad wear and slurry flow rate"),
    ("Attribute 65", "Chamber Wall Temperature - Verify cooling water jacket recirculation loop"),
    ("Attribute 248", "Post-Etch Ashing Rate - Inspect oxygen plasma radical density"),
]
DEFAULT_ACTION = "Standard Metrology Audit - Inspect tool recipe logs and chamber baseline"
