"""Declared schemas and the fixed values the reference pins down.

Values under "Fixed values" must equal the reference's for results to match;
they are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# --------------------------------------------------------------------------

# Required fields of a raw payment event, in schema order.
PAYMENT_REQUIRED_FIELDS = [
    "event_id", "card_id", "user_id", "merchant_id", "device_id", "ip", "account_id",
    "amount", "currency", "mcc", "channel", "is_card_present", "country", "city",
    "lat", "lon", "event_ts", "ingest_ts", "is_fraud",
]

# JSON type of every field ("string", "number", "integer", "boolean").
PAYMENT_FIELD_TYPES = {
    "event_id": "string", "card_id": "string", "user_id": "string", "merchant_id": "string",
    "device_id": "string", "ip": "string", "account_id": "string", "amount": "number",
    "currency": "string", "mcc": "string", "channel": "string", "is_card_present": "boolean",
    "country": "string", "city": "string", "lat": "number", "lon": "number",
    "event_ts": "string", "ingest_ts": "string", "is_fraud": "integer",
}

# Enumerations.
CHANNELS = ["pos", "ecom"]
FRAUD_LABELS = [0, 1]

# Geography pool: (country, city, lat, lon).
GEO_POOL = [
    ("US", "New_York", 40.7128, -74.0060),
    ("US", "San_Francisco", 37.7749, -122.4194),
    ("GB", "London", 51.5072, -0.1276),
    ("IN", "Bengaluru", 12.9716, 77.5946),
    ("SG", "Singapore", 1.3521, 103.8198),
    ("BR", "Sao_Paulo", -23.5505, -46.6333),
]

# Scoring-latency histogram upper bounds, seconds.
LATENCY_BUCKETS = [0.005, 0.01, 0.02, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0]

# Model feature order (training and serving must agree).
FEATURE_ORDER = ["txn_count_1m", "amount_sum_1m", "txn_count_5m", "avg_transaction_amount_5m", "amount"]
ONLINE_FEATURES = ["txn_count_1m", "amount_sum_1m", "txn_count_5m", "avg_transaction_amount_5m"]

# Heuristic fallback model: logit = -6 + amount/250 + 0.35*txn_1m + 0.08*txn_5m, clipped.
HEURISTIC_INTERCEPT = -6.0
HEURISTIC_AMOUNT_DIVISOR = 250.0
HEURISTIC_TXN_1M_WEIGHT = 0.35
HEURISTIC_TXN_5M_WEIGHT = 0.08
HEURISTIC_CLIP = (0.001, 0.999)

# Feature-view TTLs, minutes.
TTL_1M_MINUTES = 120
TTL_5M_MINUTES = 240

# UUID v5 namespace and name prefix for ingested rows.
INGEST_UUID_NAMESPACE = "00000000-0000-0000-0000-000000000001"
INGEST_UUID_PREFIX = "creditcard:"

# Ingestion defaults.
INGEST_START_TIME = "2024-01-01T00:00:00Z"
INGEST_N_CARDS = 50000
INGEST_N_MERCHANTS = 10000
AMOUNT_P999_LIMIT = 100000.0

# Evaluation defaults.
DECISION_THRESHOLD = 0.5
LABEL_GRACE_MINUTES = 5
LABEL_DELAY_MINUTES = 60
RECENT_ROWS = 5000
PSI_BINS = 10
PSI_EPS = 1e-6

# Quality gates (staging, production): join rate, precision, recall, PR-AUC.
GATE_STAGING = {"min_join_rate": 0.99, "min_precision": 0.003, "min_recall": 0.20, "min_pr_auc": 0.004}
GATE_PRODUCTION = {"min_join_rate": 0.995, "min_precision": 0.004, "min_recall": 0.24, "min_pr_auc": 0.005}

# Stream settings.
WATERMARK_DELAY = "5 seconds"
CHECKPOINT_INTERVAL = "10 seconds"
ONLINE_PUSH_MAX_ROWS = 5000
ONLINE_PUSH_INTERVAL = "1 second"
ONLINE_BUCKETS = 64

# --------------------------------------------------------------------------
# Struct types
# --------------------------------------------------------------------------

S, D, L, I, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PAYMENTS_RAW = _st(
    ("event_id", S), ("card_id", S), ("user_id", S), ("merchant_id", S), ("device_id", S), ("ip", S),
    ("account_id", S), ("amount", D), ("currency", S), ("mcc", S), ("channel", S),
    ("is_card_present", B), ("country", S), ("city", S), ("lat", D), ("lon", D),
    ("event_ts", S), ("ingest_ts", S), ("is_fraud", I),
)

# Events are decoded as text first: a number sent as a string keeps its value.
PAYMENTS_TEXT = _st(*[(f.name, S) for f in PAYMENTS_RAW.fields])

PAYMENTS_DLQ = _st(("error", S), ("raw", S), ("topic", S), ("partition", I), ("offset", L))

PAYMENTS_REAL = _st(
    ("event_id", S), ("card_id", S), ("merchant_id", S), ("event_timestamp", TS), ("amount", D),
    ("channel", S), ("country", S), ("city", S), ("lat", D), ("lon", D), ("is_fraud", I),
)

DLQ = T.StructType([
    T.StructField("error", T.StringType()), T.StructField("raw", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
])

DECISIONS = _st(
    ("event_id", S), ("card_id", S), ("amount", D), ("event_ts", S), ("ingest_ts", S),
    ("fraud_probability", D), ("decision", S), ("model_version", S), ("scored_at", S),
)

PREDICTION_LOG = T.StructType(
    [T.StructField(n, t, True) for n, t in [
        ("ts", S), ("event_id", S), ("card_id", S), ("amount", D), ("event_ts", S), ("ingest_ts", S),
        ("txn_count_1m", L), ("amount_sum_1m", D), ("txn_count_5m", L), ("avg_transaction_amount_5m", D),
        ("fraud_probability", D), ("decision", S), ("model_version", S), ("latency_ms", D),
    ]]
    + [T.StructField("missing_features", T.ArrayType(S), True),
       T.StructField("event_id_missing", B, True), T.StructField("status", S, True)]
)

LABELS_LOG = _st(("event_id", S), ("is_fraud", I), ("label_timestamp", S), ("delay_seconds", D))

# Logs are scanned as all-string first (tolerant), then coerced with try_cast.
PREDICTION_LOG_STRINGS = _st(*[(f.name, S) for f in PREDICTION_LOG.fields])
LABELS_LOG_STRINGS = _st(*[(f.name, S) for f in LABELS_LOG.fields])
