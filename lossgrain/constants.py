"""File layouts, code lists, maps and thresholds.

Everything here is data that has to equal the published layout or model
definition; nothing in this module computes.
"""

# Positional layout of the origination text file.
ORIGINATION_COLUMNS = [
    "credit_score",
    "first_payment_date",
    "first_time_homebuyer",
    "maturity_date",
    "msa",
    "mip",
    "num_units",
    "occupancy_status",
    "orig_cltv",
    "orig_dti",
    "orig_upb",
    "orig_ltv",
    "orig_interest_rate",
    "channel",
    "prepayment_penalty_flag",
    "amortization_type",
    "property_state",
    "property_type",
    "postal_code",
    "loan_seq_num",
    "loan_purpose",
    "orig_loan_term",
    "num_borrowers",
    "seller_name",
    "servicer_name",
    "super_conforming_flag",
    "pre_harp_loan_seq_num",
    "program_indicator",
    "harp_indicator",
    "property_valuation_method",
    "io_indicator",
    "mi_cancellation_indicator",
]

# Positional layout of the monthly performance text file.
PERFORMANCE_COLUMNS = [
    "loan_seq_num",
    "monthly_reporting_period",
    "current_upb",
    "current_delinquency_status",
    "loan_age",
    "remaining_months_to_maturity",
    "defect_settlement_date",
    "modification_flag",
    "zero_balance_code",
    "zero_balance_effective_date",
    "current_interest_rate",
    "current_deferred_upb",
    "ddlpi",
    "mi_recoveries",
    "net_sale_proceeds",
    "non_mi_recoveries",
    "expenses",
    "legal_costs",
    "maintenance_costs",
    "taxes_insurance",
    "misc_expenses",
    "actual_loss",
    "modification_cost",
    "step_modification_flag",
    "deferred_payment_plan",
    "estimated_ltv",
    "zero_balance_removal_upb",
    "delinquent_accrued_interest",
    "delinquency_due_to_disaster",
    "borrower_assistance_status",
    "current_month_modification_cost",
    "interest_bearing_upb",
]

# Columns that become numbers after the text stage.
ORIGINATION_NUMERIC = [
    "credit_score", "mip", "num_units", "orig_cltv", "orig_dti", "orig_upb",
    "orig_ltv", "orig_interest_rate", "orig_loan_term", "num_borrowers",
]
PERFORMANCE_NUMERIC = [
    "current_upb", "loan_age", "current_interest_rate",
    "current_deferred_upb", "mi_recoveries", "net_sale_proceeds", "non_mi_recoveries", "expenses", "legal_costs",
    "maintenance_costs", "taxes_insurance", "misc_expenses", "actual_loss",
    "modification_cost", "estimated_ltv", "zero_balance_removal_upb",
    "delinquent_accrued_interest", "current_month_modification_cost",
    "interest_bearing_upb",
]

# Columns that must be present after ingestion.
REQUIRED_ORIGINATION = [
    "loan_seq_num", "orig_ltv", "orig_upb", "orig_interest_rate",
    "orig_loan_term", "property_type", "occupancy_status", "channel",
    "property_state", "first_payment_date",
]
REQUIRED_PERFORMANCE = [
    "loan_seq_num", "monthly_reporting_period", "current_upb",
    "zero_balance_code", "actual_loss", "mi_recoveries",
    "net_sale_proceeds", "expenses",
]

# Text tokens that mean "missing" (the pandas defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Resolution codes that count as a default, and the study window.
DEFAULT_CODES = ["02", "03", "06", "09"]
VINTAGE_WINDOW = (2010, 2015)

# Imputation rules.
ZERO_FILL = [
    "mip", "expenses", "legal_costs", "maintenance_costs", "taxes_insurance",
    "misc_expenses", "modification_cost", "mi_recoveries",
    "non_mi_recoveries", "delinquent_accrued_interest",
    "current_month_modification_cost",
]
MEDIAN_FILL = ["credit_score", "orig_dti", "orig_cltv"]
CONSTANT_FILL = {"modification_flag": "N"}

# Column renames between the merged file and the features.
FEATURE_NAMES = {"property_state": "state", "orig_loan_term": "orig_term"}

# States by region; every other code is "Other".
REGION_STATES = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Southeast": ["DE", "FL", "GA", "MD", "NC", "SC", "VA", "WV", "AL", "KY", "MS", "TN", "AR", "LA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "Southwest": ["AZ", "NM", "OK", "TX"],
    "West": ["AK", "CA", "CO", "HI", "ID", "MT", "NV", "OR", "UT", "WA", "WY", "DC"],
}

# Model features in model order, and the target.
CATEGORICAL_FEATURES = ["property_type", "occupancy_status", "channel", "state"]
NUMERIC_FEATURES = [
    "orig_ltv", "orig_upb", "orig_interest_rate", "orig_term",
    "ltv_at_default", "months_delinquent_at_default", "hpi_change",
    "unemployment_rate_at_default",
]
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
TARGET = "loss_given_default"

# Macro placeholders used when no series is joined.
PLACEHOLDERS = {
    "hpi_change": 0.0,
    "unemployment_rate_at_default": 7.5,
    "months_delinquent_at_default": 3,
}

# Serving codes; anything not listed takes the last number.
SERVING_CODES = {
    "property_type": ({"CO": 0, "CP": 1, "MH": 2, "PU": 3, "SF": 4}, 5),
    "occupancy_status": ({"I": 0, "P": 1, "S": 2}, 3),
    "channel": ({"B": 0, "C": 1, "R": 2, "T": 3}, 4),
}
SERVING_REGION_CODES = {
    "Midwest": 0, "Northeast": 1, "Other": 2,
    "Southeast": 3, "Southwest": 4, "West": 5,
}

# Mean of each numeric feature in training (drift baseline).
TRAINING_MEANS = {
    "orig_ltv": 78.5,
    "orig_upb": 220000.0,
    "orig_interest_rate": 4.5,
    "orig_term": 339.0,
    "ltv_at_default": 95.0,
    "months_delinquent_at_default": 4.5,
    "hpi_change": -0.05,
    "unemployment_rate_at_default": 7.5,
}

# Bounds of a scoring request (lowest, highest; None = open).
REQUEST_RANGES = {
    "orig_ltv": (0, 200),
    "orig_interest_rate": (0, 30),
    "orig_term": (60, 480),
    "ltv_at_default": (0, 300),
    "months_delinquent_at_default": (1, 120),
    "hpi_change": (-1.0, 5.0),
    "unemployment_rate_at_default": (0, 50),
}
REQUEST_POSITIVE = ["orig_upb"]
REQUEST_WHOLE = ["orig_term", "months_delinquent_at_default"]
REQUEST_CHOICES = {
    "property_type": ["SF", "CO", "CP", "MH", "PU"],
    "occupancy_status": ["P", "S", "I"],
    "channel": ["R", "B", "C", "T"],
}
REQUEST_STATE_LENGTH = 2
MAX_BATCH_LOANS = 1000

# Scenarios as (name, severity, unemployment shock in points,
# house-price shock as a change of hpi_change).
SCENARIOS = [
    ("base", 0, 0.0, 0.0),
    ("mild", 1, 2.0, -0.10),
    ("moderate", 2, 4.0, -0.20),
    ("severe", 3, 6.0, -0.30),
]

# Tail weight, split shares and acceptance thresholds.
TAIL_ALPHA = 2.0
TEST_SHARE = 0.15
VALIDATION_SHARE = 0.15
SPLIT_SEED = 42
CALIBRATION_TOLERANCE = 0.05
MIN_MAE_IMPROVEMENT = 15.0
MIN_RMSE_IMPROVEMENT = 10.0
MIN_R2 = 0.30
DRIFT_THRESHOLD = 0.10
MAE_DEGRADATION = 0.05
RANK_SHIFT = 2
