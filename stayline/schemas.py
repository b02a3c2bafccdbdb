"""Column contracts of the source tables and of the two stores.

Dates in source tables are YYYYMMDD integers; the stores keep real dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_SHORT, _INT, _STR, _DATE = T.ShortType(), T.IntegerType(), T.StringType(), T.DateType()

TRANSACTIONS = _struct(
    ("msno", _STR, False),
    ("payment_method_id", _SHORT, True),
    ("payment_plan_days", _SHORT, True),
    ("plan_list_price", _INT, True),
    ("actual_amount_paid", _INT, True),
    ("is_auto_renew", _SHORT, True),
    ("transaction_date", _INT, True),
    ("membership_expire_date", _INT, True),
    ("is_cancel", _SHORT, True),
)

USER_LOGS = _struct(
    ("msno", _STR, False),
    ("date", _INT, False),
    ("num_25", _INT, True),
    ("num_50", _INT, True),
    ("num_75", _INT, True),
    ("num_985", _INT, True),
    ("num_100", _INT, True),
    ("num_unq", _INT, True),
    ("total_secs", T.FloatType(), True),
)

MEMBERS = _struct(
    ("msno", _STR, False),
    ("city", _SHORT, True),
    ("bd", _SHORT, True),
    ("gender", _STR, True),
    ("registered_via", _SHORT, True),
    ("registration_init_time", _INT, True),
)

TRAIN_LABELS = _struct(("msno", _STR, False), ("is_churn", _SHORT, False))

LABEL_STORE = _struct(
    ("msno", _STR, False),
    ("anchor_expiry_date", _DATE, False),
    ("feature_cutoff_date", _DATE, False),
    ("is_churn", _SHORT, False),
    ("labeled_date", _DATE, False),
)

PREDICTION_STORE = _struct(
    ("msno", _STR, False),
    ("score", T.FloatType(), False),
    ("risk_tier", _STR, False),
    ("scoring_date", _DATE, False),
    ("expiry_date", _DATE, False),
    ("model_version", _STR, False),
    ("created_at", T.TimestampType(), False),
)

SOURCES: dict[str, T.StructType] = {
    "transactions": TRANSACTIONS,
    "user_logs": USER_LOGS,
    "members": MEMBERS,
    "train_labels": TRAIN_LABELS,
}

# Feature names, their order and their groups are part of the data contract.
TXN_FEATURES = [
    "n_txn", "n_cancel", "ever_cancelled", "ever_promo",
    "last_is_auto_renew", "last_is_cancel", "last_actual_amount_paid",
    "last_payment_plan_days", "last_plan_list_price", "last_discount",
    "cancel_rate", "days_since_last_txn",
]
LOG_FEATURES = [
    "log_days", "avg_daily_secs", "total_secs_sum",
    "avg_completion_ratio", "avg_daily_unq_songs", "days_since_last_log",
]
MEMBER_FEATURES = ["registered_via", "tenure_days"]
FEATURES = TXN_FEATURES + LOG_FEATURES + MEMBER_FEATURES
CATEGORICAL_FEATURES = [
    "last_is_auto_renew", "last_is_cancel", "ever_cancelled", "ever_promo", "registered_via",
]
LABEL_COLUMNS = LABEL_STORE.names

PLAY_COUNTERS = ["num_25", "num_50", "num_75", "num_985", "num_100"]


def require_columns(df: DataFrame, columns: list[str], name: str = "input") -> DataFrame:
    """Plan-time presence check; returns ``df`` so it can sit inside a chain."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Columns missing from {name}: {missing}")
    return df
