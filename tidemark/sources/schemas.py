"""Column names and types of the tables."""

from __future__ import annotations

# Raw file, partition-file stem and column list of each source.
RAW_FILES = {
    "loans": "lms_loan_daily.csv",
    "clickstream": "feature_clickstream.csv",
    "attributes": "features_attributes.csv",
    "financials": "features_financials.csv",
}

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

CLICK_TYPES = {**{f"fe_{i}": "int" for i in range(1, 21)}, "Customer_ID": "string", "snapshot_date": "date"}

MONEY_COLUMNS = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]
COUNT_COLUMNS = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Delay_from_due_date",
    "Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Interest_Rate",
]
CAPPED_COLUMNS = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Num_of_Loan", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
]
FRACTION_COLUMNS = ["Changed_Credit_Limit", "Credit_Utilization_Ratio"]

# Raw columns that the layers read; the snapshot date alone is typed.
RAW_COLUMNS = {
    "loans": list(LOAN_TYPES),
    "clickstream": list(CLICK_TYPES),
    "attributes": ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"],
    "financials": [
        "Customer_ID", *MONEY_COLUMNS, *COUNT_COLUMNS, *FRACTION_COLUMNS, "Credit_History_Age", "Credit_Mix",
        "Payment_of_Min_Amount", "Payment_Behaviour", "snapshot_date",
    ],
}

RISK_FEATURES = [
    "Credit_History_Age", "Loans_per_Credit_Item", "Debt_to_Salary", "Loan_Extent", "Outstanding_Debt",
    "Interest_Rate", "Delay_from_due_date", "Changed_Credit_Limit", "Payment_Behaviour",
]
MODEL_FEATURES = [*RISK_FEATURES, "Age", "Occupation"]
ID_COLUMNS = ["Customer_ID", "snapshot_date", "label", "label_def", "loan_id"]

DRIFT_SCHEMA = (
    "snapshot_date string, model_id string, psi_score double, csi_max double, psi_breach boolean, "
    "csi_breach boolean, psi_threshold double, csi_threshold double"
)
PERFORMANCE_SCHEMA = (
    "auc double, gini double, auc_breach boolean, gini_breach boolean, breach boolean, model_id string"
)
BASELINE_JSON_SCHEMA = (
    "feature_cols array<string>, numeric_cols array<string>, score_bins array<double>, "
    "score_expected array<double>, feature_bins map<string,array<double>>, "
    "feature_expected map<string,array<double>>"
)
BASELINE_SCHEMA = "metric_kind string, feature string, edges array<double>, expected array<double>, model_id string"
PREDICTION_SCHEMA = (
    "Customer_ID string, model_predictions double, model_name string, model_id string, snapshot_date date, "
    "written_at timestamp"
)
LABEL_SCHEMA = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"
METRIC_SCHEMA = "metric string, snapshot_date date, model_id string, value double, logged_at timestamp"
