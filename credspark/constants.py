"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the published
data description for results to be right: column names and order, code
books, display labels, domains, costs, bin edges, category merges and the
ensemble configuration.  They are stated plainly and in natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: record layout (21 fields, in file order) -----------------
COLUMNS = [
    "checking_account_status",
    "duration_months",
    "credit_history",
    "purpose",
    "credit_amount",
    "savings_account_bonds",
    "present_employment_since",
    "installment_rate_pct_of_disp_income",
    "personal_status_sex",
    "other_debtors_guarantors",
    "present_residence_since",
    "property",
    "age_years",
    "other_installment_plans",
    "housing",
    "existing_credits_count",
    "job",
    "people_liable_for_maintenance",
    "telephone",
    "foreign_worker",
    "class",
]

NUMERIC_COLUMNS = [
    "duration_months",
    "credit_amount",
    "installment_rate_pct_of_disp_income",
    "present_residence_since",
    "age_years",
    "existing_credits_count",
    "people_liable_for_maintenance",
]

TARGET = "class"
ROW_ID = "row_id"

# --- FIXED VALUES: code book (code -> label) ---------------------------------
CODEBOOK = {
    "checking_account_status": {
        "A11": "< 0 DM",
        "A12": "0 <= ... < 200 DM",
        "A13": ">= 200 DM / salary assign.",
        "A14": "no checking account",
    },
    "credit_history": {
        "A30": "no credits/all paid duly",
        "A31": "all credits here paid duly",
        "A32": "existing credits paid duly",
        "A33": "delay in paying off in past",
        "A34": "critical/other credits exist",
    },
    "purpose": {
        "A40": "car (new)",
        "A41": "car (used)",
        "A42": "furniture/equipment",
        "A43": "radio/television",
        "A44": "domestic appliances",
        "A45": "repairs",
        "A46": "education",
        "A47": "vacation",
        "A48": "retraining",
        "A49": "business",
        "A410": "others",
    },
    "savings_account_bonds": {
        "A61": "< 100 DM",
        "A62": "100 <= ... < 500 DM",
        "A63": "500 <= ... < 1000 DM",
        "A64": ">= 1000 DM",
        "A65": "unknown/no savings account",
    },
    "present_employment_since": {
        "A71": "unemployed",
        "A72": "< 1 year",
        "A73": "1 <= ... < 4 years",
        "A74": "4 <= ... < 7 years",
        "A75": ">= 7 years",
    },
    "personal_status_sex": {
        "A91": "male: divorced/separated",
        "A92": "female: div/sep/married",
        "A93": "male: single",
        "A94": "male: married/widowed",
        "A95": "female: single",
    },
    "other_debtors_guarantors": {
        "A101": "none",
        "A102": "co-applicant",
        "A103": "guarantor",
    },
    "property": {
        "A121": "real estate",
        "A122": "bldg society/life ins.",
        "A123": "car or other",
        "A124": "unknown/no property",
    },
    "other_installment_plans": {
        "A141": "bank",
        "A142": "stores",
        "A143": "none",
    },
    "housing": {
        "A151": "rent",
        "A152": "own",
        "A153": "for free",
    },
    "job": {
        "A171": "unemployed/unskilled non-res.",
        "A172": "unskilled resident",
        "A173": "skilled employee/official",
        "A174": "management/self-employed/etc",
    },
    "telephone": {
        "A191": "none",
        "A192": "yes, registered",
    },
    "foreign_worker": {
        "A201": "yes",
        "A202": "no",
    },
}

# raw class code -> label: 1 = good = positive, 2 = bad = 0 (polarity, T1)
CLASS_CODES = {"1": 1, "2": 0}
POSITIVE = 1  # good applicant

CATEGORICAL_COLUMNS = list(CODEBOOK)

# --- FIXED VALUES: form domains ----------------------------------------------
NUMERIC_DOMAIN = {
    "duration_months": (4, 72),
    "credit_amount": (250, 20000),
    "installment_rate_pct_of_disp_income": (1, 4),
    "present_residence_since": (1, 4),
    "age_years": (18, 80),
    "existing_credits_count": (1, 4),
    "people_liable_for_maintenance": (1, 2),
}

# --- FIXED VALUES: display labels --------------------------------------------
FEATURE_LABELS = {
    "checking_account_status": "Checking Account Status",
    "duration_months": "Loan Duration (months)",
    "credit_history": "Credit History",
    "purpose": "Loan Purpose",
    "credit_amount": "Credit Amount (DM)",
    "savings_account_bonds": "Savings Account / Bonds",
    "present_employment_since": "Present Employment Since",
    "installment_rate_pct_of_disp_income": "Installment Rate (% of Income)",
    "present_residence_since": "Present Residence Since (years)",
    "personal_status_sex": "Personal Status & Sex",
    "other_debtors_guarantors": "Other Debtors / Guarantors",
    "property": "Property",
    "age_years": "Age (years)",
    "other_installment_plans": "Other Installment Plans",
    "housing": "Housing",
    "existing_credits_count": "Existing Credits at Bank",
    "job": "Job",
    "people_liable_for_maintenance": "People Liable for Maintenance",
    "telephone": "Telephone",
    "foreign_worker": "Foreign Worker",
}

# --- FIXED VALUES: feature engineering ---------------------------------------
DROP_COLUMNS = ["other_debtors_guarantors", "telephone", "people_liable_for_maintenance"]

# (column, [old labels], new label), applied in this order
CATEGORY_MERGES = [
    ("purpose", ["education", "retraining"], "personal_development"),
    ("purpose", ["domestic appliances", "repairs", "others"], "home_improvement"),
    ("savings_account_bonds", ["< 100 DM", "100 <= ... < 500 DM"], "< 500 DM"),
    ("savings_account_bonds", ["500 <= ... < 1000 DM", ">= 1000 DM"], ">= 500 DM"),
    ("housing", ["for free", "rent"], "not_own"),
    ("credit_history", ["all credits here paid duly", "no credits/all paid duly"], "all credits paid"),
]

# right-closed bins (lo, hi]
AMOUNT_EDGES = [0, 2000, 4000, 7000, 10000, 50000]
AMOUNT_LABELS = ["a", "b", "c", "d", "e"]
AGE_EDGES = [0, 25, 35, 55, 100]
AGE_LABELS = ["Young", "Early_Career", "Prime", "Mature"]

# --- FIXED VALUES: costs and ensemble ----------------------------------------
COST_FP = 5  # accepting a bad applicant
COST_FN = 1  # rejecting a good applicant
MODEL_ORDER = ["lrc", "rfc", "svc"]
ENSEMBLE_WEIGHTS = [2.5, 1.5, 3.0]
ENSEMBLE_THRESHOLD = 0.63
WEIGHT_RANGE = [0.5, 1.0, 1.5, 2.0, 2.5, 3.0]

# --- FIXED VALUES: per-model feature lists -----------------------------------
PIPELINE_COLUMNS = {
    "svc": {
        "onehot": ["credit_history", "savings_account_bonds", "present_residence_since",
                   "personal_status_sex", "purpose", "checking_account_status",
                   "other_installment_plans"],
        "woe": ["present_employment_since", "foreign_worker",
                "installment_rate_pct_of_disp_income"],
        "target": ["job", "housing", "property"],
        "target_smoothing": 1.0,
        "count": [],
        "ordinal": [],
        "scale": ["credit_amount_squared", "age_years", "existing_credits_count",
                  "monthly_burden_log", "duration_to_age_ratio"],
        "passthrough": ["no_checking"],
        "duplicate_checking": False,
    },
    "lrc": {
        "onehot": ["credit_history", "savings_account_bonds", "present_residence_since",
                   "personal_status_sex", "age_group", "job", "foreign_worker"],
        "woe": ["checking_account_status", "purpose", "present_employment_since",
                "property", "housing"],
        "target": [],
        "target_smoothing": 1.0,
        "count": ["installment_rate_pct_of_disp_income", "other_installment_plans"],
        "ordinal": [],
        "scale": ["duration_log", "credit_log", "existing_credits_count", "monthly_burden_log"],
        "passthrough": ["no_checking"],
        "duplicate_checking": False,
    },
    "rfc": {
        "onehot": ["credit_history", "purpose", "savings_account_bonds",
                   "present_employment_since", "personal_status_sex",
                   "other_installment_plans", "housing", "foreign_worker"],
        "woe": [],
        "target": ["property"],
        "target_smoothing": 5.0,
        "count": [],
        "ordinal": ["installment_rate_pct_of_disp_income", "job", "personal_status_2",
                    "checking_account_status", "age_group"],
        "scale": ["credit_log", "duration_to_age_ratio"],
        "passthrough": ["no_checking", "present_residence_since", "existing_credits_count",
                        "monthly_burden"],
        "duplicate_checking": True,
    },
}

# --- FIXED VALUES: statistics labels -----------------------------------------
CORR_STRENGTH_EDGES = [(0.1, "negligible"), (0.3, "weak"), (0.5, "moderate"), (0.7, "strong")]
CORR_STRENGTH_TOP = "very strong"
PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]

# --- FIXED VALUES: search ranges ----------------------------------------------
LRC_SPACE = {"C": ("log-uniform", 0.1, 20.0), "max_iter": ("int", 1000, 8000),
             "class_weight": ("cat", ["balanced", None])}
RFC_SPACE = {"n_estimators": ("int", 400, 800), "max_depth": ("int", 3, 10), "min_samples_leaf": ("int", 10, 40),
             "max_features": ("cat", ["sqrt", "log2", "0.3", "0.5"]), "max_samples": ("uniform", 0.5, 0.9)}
SVC_SPACE = {"C": ("log-uniform", 0.1, 50.0), "gamma": ("log-uniform", 1e-3, 1.0), "kernel": ("cat", ["rbf", "linear"]),
             "tol": ("log-uniform", 1e-5, 1e-3), "class_weight": ("cat", ["balanced", None])}
