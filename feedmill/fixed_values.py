"""Fixed values.

Field names, word lists and sizes the feeds and reports are defined by. They
are data, not tuning: changing one changes results.
"""

# --- loan feed (fixed values) -------------------------------------------------
LOAN_FIELDS = [
    "loan_status", "loan_amnt", "int_rate", "installment", "annual_inc", "dti",
    "fico_range_low", "term", "grade", "emp_length", "home_ownership",
]
LOAN_NUMERIC = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti", "fico_range_low"]
LOAN_CATEGORICAL = ["term", "grade", "emp_length", "home_ownership"]
LOAN_REQUIRED = ["loan_amnt", "annual_inc"]
LOAN_STATUS_PAID = "Fully Paid"
LOAN_STATUS_LOST = "Charged Off"
LOAN_RESULT_COLUMNS = ["loan_amnt", "prediction", "label", "grade", "dti"]
MISSING_TEXT = "Unknown"

# --- marketing feed (fixed values) --------------------------------------------
MARKETING_FIELDS = [
    "age", "job", "marital", "education", "default", "balance", "housing", "loan",
    "contact", "day", "month", "duration", "campaign", "pdays", "previous", "poutcome", "y",
]
MARKETING_NUMERIC = ["age", "balance", "duration", "campaign"]
MARKETING_CATEGORICAL = ["job", "marital", "education", "housing", "loan"]
MARKETING_REQUIRED = ["age", "job"]
MARKETING_POSITIVE = "yes"
MARKETING_RESULT_COLUMNS = ["age", "job", "balance", "prediction", "label"]

# --- feed and ingest sizes (fixed values) -------------------------------------
FEED_CHUNK_ROWS = 1_000
INGEST_TRIGGER = "5 seconds"

# --- models (fixed values) ----------------------------------------------------
SPLIT_WEIGHTS = [0.8, 0.2]
SPLIT_SEED = 42
FOREST_TREES = 50
LOGIT_REG_PARAMS = [0.1, 0.01]
LOGIT_FOLDS = 3

# --- marts and report (fixed values) ------------------------------------------
BALANCE_WIDTH = 5000
SCATTER_ROWS = 1_000
GRADES = ["A", "B", "C", "D", "E", "F", "G"]
CLASS_TEXTS = ["0.0", "1.0"]
OUTCOMES = ["yes", "no"]
OFFICE_JOBS = ["admin.", "management", "entrepreneur", "self-employed"]
LABOR_JOBS = ["blue-collar", "technician", "services", "housemaid"]
JOB_GROUPS = ["office", "labor", "other"]
LOW_BAND_TOP = 5000
MIDDLE_BAND_TOP = 50000
ASSET_BANDS = ["debt", "low", "middle", "VIP"]
