"""Explicit schemas of the tables and records; nothing is inferred."""

from pyspark.sql import types as T

from ebbline.fixed_values import KEY, TARGET

_TEXT = T.StringType()
_MONEY = T.DecimalType(10, 2)
_SCORE = T.DecimalType(5, 4)

# Attribute order of the customer record; also the order of the request fields.
ATTRIBUTES = [
    ("gender", _TEXT), ("SeniorCitizen", T.IntegerType()), ("Partner", _TEXT),
    ("Dependents", _TEXT), ("tenure", T.IntegerType()), ("PhoneService", _TEXT),
    ("MultipleLines", _TEXT), ("InternetService", _TEXT), ("OnlineSecurity", _TEXT),
    ("OnlineBackup", _TEXT), ("DeviceProtection", _TEXT), ("TechSupport", _TEXT),
    ("StreamingTV", _TEXT), ("StreamingMovies", _TEXT), ("Contract", _TEXT),
    ("PaperlessBilling", _TEXT), ("PaymentMethod", _TEXT),
    ("MonthlyCharges", T.DoubleType()), ("TotalCharges", _TEXT),
]
ATTRIBUTE_NAMES = [name for name, _ in ATTRIBUTES]

# One scoring request.
REQUEST = T.StructType([T.StructField(KEY, _TEXT)] + [T.StructField(n, t) for n, t in ATTRIBUTES])

# The input table: a request plus the target.
CHURN_TABLE = T.StructType(REQUEST.fields + [T.StructField(TARGET, _TEXT)])

CUSTOMERS = T.StructType(
    [T.StructField(KEY, _TEXT, False)]
    + [T.StructField(n, _MONEY if n == "MonthlyCharges" else t) for n, t in ATTRIBUTES]
    + [
        T.StructField(TARGET, _TEXT),
        T.StructField("active", T.BooleanType()),
        T.StructField("churn_risk_score", _SCORE),
        T.StructField("risk_level", _TEXT),
        T.StructField("last_scored", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

PREDICTIONS = T.StructType([
    T.StructField("customerid", _TEXT),
    T.StructField("churn_prediction", T.IntegerType()),
    T.StructField("churn_probability", _SCORE),
    T.StructField("risk_level", _TEXT),
    T.StructField("model_used", _TEXT),
    T.StructField("prediction_date", T.TimestampType()),
])

MODEL_PERFORMANCE = T.StructType([
    T.StructField("model_name", _TEXT),
    T.StructField("accuracy", _SCORE),
    T.StructField("precision_score", _SCORE),
    T.StructField("recall_score", _SCORE),
    T.StructField("f1_score", _SCORE),
    T.StructField("roc_auc", _SCORE),
    T.StructField("training_date", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
])
