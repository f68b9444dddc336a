"""Column lists, domains and texts that results must equal."""

from __future__ import annotations

ID = "customerID"
TARGET = "Churn"

# --- fixed values: the 21 raw customer columns, in landing order -------------
RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

# --- fixed values: columns a landing file must carry ---------------------------
GATE_COLUMNS = [
    "customerID", "gender", "tenure", "Contract", "MonthlyCharges", "TotalCharges", "Churn",
]
GATE_MIN_ROWS = 1000

# --- fixed values: categorical columns and their allowed values ----------------
_YN = ["No", "Yes"]
_YN_INTERNET = ["No", "No internet service", "Yes"]
DOMAINS = {
    "gender": ["Female", "Male"],
    "Partner": _YN,
    "Dependents": _YN,
    "PhoneService": _YN,
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": _YN_INTERNET,
    "OnlineBackup": _YN_INTERNET,
    "DeviceProtection": _YN_INTERNET,
    "TechSupport": _YN_INTERNET,
    "StreamingTV": _YN_INTERNET,
    "StreamingMovies": _YN_INTERNET,
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": _YN,
    "PaymentMethod": [
        "Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check",
    ],
}
CATEGORICAL = list(DOMAINS)
TARGET_DOMAIN = _YN
SENIOR_DOMAIN = [0, 1]
NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]

# --- fixed values: one-line meaning of each raw column -------------------------
COLUMN_MEANINGS = {
    "customerID": "Unique customer identifier.",
    "gender": "Customer gender (Male/Female).",
    "SeniorCitizen": "Whether the customer is a senior citizen (0/1).",
    "Partner": "Whether the customer has a partner (Yes/No).",
    "Dependents": "Whether the customer has dependents (Yes/No).",
    "tenure": "Number of months the customer has stayed with the company.",
    "PhoneService": "Whether the customer has phone service (Yes/No).",
    "MultipleLines": "Whether the customer has multiple lines (Yes/No/No phone service).",
    "InternetService": "Customer's internet service provider (DSL/Fiber optic/No).",
    "OnlineSecurity": "Whether the customer has online security (Yes/No/No internet service).",
    "OnlineBackup": "Whether the customer has online backup (Yes/No/No internet service).",
    "DeviceProtection": "Whether the customer has device protection (Yes/No/No internet service).",
    "TechSupport": "Whether the customer has tech support (Yes/No/No internet service).",
    "StreamingTV": "Whether the customer has streaming TV (Yes/No/No internet service).",
    "StreamingMovies": "Whether the customer has streaming movies (Yes/No/No internet service).",
    "Contract": "Contract term (Month-to-month/One year/Two year).",
    "PaperlessBilling": "Whether the customer has paperless billing (Yes/No).",
    "PaymentMethod": "Payment method (Electronic check/Mailed check/Bank transfer/Credit card).",
    "MonthlyCharges": "The amount charged to the customer monthly.",
    "TotalCharges": "The total amount charged to the customer (text in raw file; blanks when tenure==0).",
    "Churn": "TARGET — whether the customer churned (Yes/No).",
}

# --- fixed values: engineered numeric features with their group ---------------
ENGINEERED = {
    "average_charge_per_month": "value",
    "total_services": "engagement",
    "service_adoption_score": "engagement",
    "is_month_to_month": "contract",
    "is_long_term_contract": "contract",
    "has_tech_support": "service",
    "has_online_security": "service",
    "has_online_backup": "service",
    "has_device_protection": "service",
    "has_streaming": "engagement",
    "payment_risk_indicator": "risk",
    "contract_risk_indicator": "risk",
    "tenure_risk_indicator": "risk",
}

# --- fixed values: silver / gold column groups ---------------------------------
SECURITY_BUNDLE = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
STREAMING_BUNDLE = ["StreamingTV", "StreamingMovies"]
PACKED_SERVICES = [
    "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies",
]
COUNTED_EVENTS = {
    "complaint": "complaint_count",
    "support_ticket": "support_ticket_count",
    "payment_failed": "payment_failed_count",
    "login": "login_count",
}
# (upper bound, label), right-closed bands
TENURE_COHORTS = [
    (12, "0-12m (New)"), (24, "12-24m (Early)"), (48, "24-48m (Established)"),
    (72, "48-72m (Loyal)"), (100, "72m+ (Champion)"),
]
TENURE_BANDS = [
    (12, "0-12"), (24, "13-24"), (36, "25-36"), (48, "37-48"), (60, "49-60"), (72, "61-72"),
]
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}

# --- fixed values: risk levels, events and their effect on the probability -----
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
URGENCY = {"LOW": "LOW", "MEDIUM": "MEDIUM", "HIGH": "HIGH", "CRITICAL": "IMMEDIATE"}
EVENT_DELTAS = {
    "payment_failed": "0.15",
    "complaint": "0.12",
    "support_ticket": "0.05",
    "cancellation_attempt": "0.30",
    "inactivity": "0.08",
    "plan_downgrade": "0.06",
    "login": "-0.03",
    "purchase": "-0.05",
    "plan_upgrade": "-0.10",
}
ALERT_EVENTS = ["complaint", "payment_failed", "cancellation_attempt"]

# --- fixed values: reason text of each retention action -------------------------
ACTION_REASONS = {
    "no_intervention": "Low churn risk; monitor only, no intervention needed.",
    "account_manager_contact": (
        "Critical churn risk on a high-value customer; escalate to an account manager for "
        "immediate personal outreach."
    ),
    "payment_assistance": (
        "Electronic-check payer with elevated churn risk; offer payment assistance / auto-pay "
        "migration to reduce billing friction."
    ),
    "onboarding_assistance": (
        "New month-to-month customer within the high-churn first year; provide onboarding "
        "assistance and early engagement."
    ),
    "plan_optimization": (
        "Month-to-month contract; propose an annual plan with incentives to lengthen commitment."
    ),
    "technical_support_intervention": (
        "Internet plan without tech support; proactive technical support can address unresolved "
        "issues driving churn."
    ),
    "feature_education": (
        "No online-security add-on; educate on protective features to increase engagement and "
        "stickiness."
    ),
    "loyalty_reward": (
        "High-value at-risk customer; offer a loyalty reward to reinforce the relationship."
    ),
    "personalized_discount": (
        "Elevated churn risk without a dominant driver; a targeted personalised discount is the "
        "most cost-effective lever."
    ),
}

# --- fixed values: monitored features -------------------------------------------
MONITOR_NUMERIC = [
    "tenure", "MonthlyCharges", "TotalCharges", "average_charge_per_month", "total_services",
    "service_adoption_score",
]
MONITOR_CATEGORICAL = [
    "Contract", "PaymentMethod", "InternetService", "TechSupport", "OnlineSecurity",
    "contract_risk_indicator", "payment_risk_indicator", "tenure_risk_indicator",
]
SEGMENT_FEATURES = [
    "tenure", "MonthlyCharges", "TotalCharges", "service_adoption_score", "churn_probability",
]

# --- fixed values: defaults of an ad-hoc customer ---------------------------------
ADHOC_DEFAULTS = {
    "gender": "Female", "SeniorCitizen": 0, "Partner": "No", "Dependents": "No", "tenure": 0,
    "PhoneService": "Yes", "MultipleLines": "No", "InternetService": "Fiber optic",
    "OnlineSecurity": "No", "OnlineBackup": "No", "DeviceProtection": "No", "TechSupport": "No",
    "StreamingTV": "No", "StreamingMovies": "No", "Contract": "Month-to-month",
    "PaperlessBilling": "Yes", "PaymentMethod": "Electronic check", "MonthlyCharges": 70.0,
    "TotalCharges": 70.0,
}

# --- fixed values: warehouse name of each raw column ------------------------------
WAREHOUSE_NAMES = {
    "customerID": "customer_id", "gender": "gender", "SeniorCitizen": "senior_citizen",
    "Partner": "partner", "Dependents": "dependents", "tenure": "tenure",
    "PhoneService": "phone_service", "MultipleLines": "multiple_lines",
    "InternetService": "internet_service", "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup", "DeviceProtection": "device_protection",
    "TechSupport": "tech_support", "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies", "Contract": "contract",
    "PaperlessBilling": "paperless_billing", "PaymentMethod": "payment_method",
    "MonthlyCharges": "monthly_charges", "TotalCharges": "total_charges", "Churn": "churn_label",
}
