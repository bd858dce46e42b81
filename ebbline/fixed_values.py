"""Names and numbers that the results depend on."""

# The results are only right with exactly these names, labels, bounds and grids.

TARGET = "Churn"
KEY = "customerID"

SERVICE_COLUMNS = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
]
BINARY_COLUMNS = ["gender", "Partner", "Dependents", "PhoneService", "PaperlessBilling"]
BINARY_CODES = {"Yes": 1, "No": 0, "Male": 1, "Female": 0}
ONE_HOT_COLUMNS = [
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
    "Contract", "PaymentMethod", "tenure_group", "customer_lifecycle",
]
NUMERIC_PLOT_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]
CLASS_PLOT_COLUMNS = ["gender", "SeniorCitizen", "Contract", "InternetService", "PaymentMethod"]

TENURE_GROUP_EDGES = [0, 12, 24, 36, 48, 72]
TENURE_GROUP_LABELS = ["0-1yr", "1-2yr", "2-3yr", "3-4yr", "4+yr"]
LIFECYCLE_EDGES = [0, 6, 12, 24, 72]
LIFECYCLE_LABELS = ["New", "Growing", "Mature", "Loyal"]

HIGH_RISK_CONTRACT = "Month-to-month"
HIGH_RISK_PAYMENT = "Electronic check"

IMPUTE_NEIGHBOURS = 5
HISTOGRAM_BINS = 30
LOW_CARDINALITY = 10
STRONG_CORRELATION = 0.3
SELECT_TOP = 20
VOTES_NEEDED = 2

RISK_HIGH_ABOVE = 0.7
RISK_MEDIUM_ABOVE = 0.3
RISK_ACTIONS = {
    "High": [
        "Contact customer within 24 hours",
        "Offer retention incentives",
        "Schedule customer service call",
        "Escalate to retention team",
    ],
    "Medium": [
        "Monitor customer behavior closely",
        "Consider proactive engagement",
        "Send targeted retention offers",
        "Schedule follow-up in 2 weeks",
    ],
    "Low": [
        "Continue regular service",
        "Include in loyalty programs",
        "Monitor for any behavior changes",
        "Quarterly check-in",
    ],
}

PRECISION_TIERS = (0.8, 0.6)
RECALL_TIERS = (0.7, 0.5)
AUC_TIERS = (0.85, 0.7)
DEPLOY_ABOVE = {"roc_auc": 0.8, "precision": 0.7, "recall": 0.6}

BASELINE_ACCURACY = 0.82
BASELINE_SHARE = 0.95

# Hyper-parameter grids. `None` depth means unlimited.
LOGISTIC_C = [0.1, 1, 10, 100]
LOGISTIC_L1_RATIO = [0.1, 0.5, 0.9]
NEIGHBOUR_GRID = {
    "n_neighbors": [3, 5, 7, 10],
    "weights": ["uniform", "distance"],
    "metric": ["euclidean", "manhattan"],
}
TREE_GRID = {
    "max_depth": [5, 10, 15, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "class_weight": ["balanced", None],
}
FOREST_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [5, 10, 15, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "class_weight": ["balanced", None],
}
SAMPLED_BOOST_GRID = {
    "n_estimators": [100, 200],
    "learning_rate": [0.01, 0.05, 0.1],
    "max_depth": [3, 5, 7],
    "subsample": [0.8, 1.0],
    "colsample_bytree": [0.8, 1.0],
}
BOOST_GRID = {
    "n_estimators": [100, 200],
    "learning_rate": [0.05, 0.1, 0.2],
    "max_depth": [3, 5, 7],
    "subsample": [0.8, 1.0],
}
EXTRA_TREES_GRID = {
    "n_estimators": [100, 200],
    "max_depth": [5, 10, None],
    "min_samples_split": [2, 5],
    "class_weight": ["balanced", None],
}
CV_FOLDS = 5
TEST_SHARE = 0.2
ALTERNATIVE_TEST_SHARE = 0.3
SEED = 42
