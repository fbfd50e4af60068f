"""Table contracts: schemas, keys, foreign keys and value domains.

The schemas are the record contracts of the banking stream and its dimension changelogs.
Ids are text (UUID) in the contract; the functions in this package only compare ids for
equality, so integer ids (as in the TESTDATA mapping) work unchanged.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()
TS, DT = T.TimestampType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Column order of every table (the order rows are written in).
FIELD_ORDER: dict[str, list[str]] = {
    "branch": ["branch_id", "branch_name", "city", "region"],
    "customer": ["customer_id", "name", "dob", "customer_segment", "pan_hash", "city", "created_at"],
    "employee": ["emp_id", "name", "role", "branch_id", "manager_id", "hire_date"],
    "product": ["product_id", "product_name", "product_category"],
    "account": ["account_id", "customer_id", "account_type", "status", "branch_id", "opened_at", "closed_at"],
    "transaction": ["txn_id", "account_id", "txn_type", "amount", "currency", "txn_time", "channel",
                    "status", "product_id", "approved_by_emp_id"],
}

SCHEMAS: dict[str, T.StructType] = {
    "branch": _schema(("branch_id", S, False), ("branch_name", S, False), ("city", S, False),
                      ("region", S, False)),
    "customer": _schema(("customer_id", S, False), ("name", S, False), ("dob", DT, False),
                        ("customer_segment", S, False), ("pan_hash", S, False), ("city", S, False),
                        ("created_at", TS, True)),
    "employee": _schema(("emp_id", S, False), ("name", S, False), ("role", S, False),
                        ("branch_id", S, False), ("manager_id", S, True), ("hire_date", DT, False)),
    "product": _schema(("product_id", S, False), ("product_name", S, False),
                       ("product_category", S, False)),
    "account": _schema(("account_id", S, False), ("customer_id", S, False), ("account_type", S, False),
                       ("status", S, False), ("branch_id", S, False), ("opened_at", TS, True),
                       ("closed_at", TS, True)),
    "transaction": _schema(("txn_id", S, False), ("account_id", S, False), ("txn_type", S, False),
                           ("amount", D, False), ("currency", S, False), ("txn_time", TS, False),
                           ("channel", S, False), ("status", S, False), ("product_id", S, False),
                           ("approved_by_emp_id", S, True)),
}

# Raw wire form of a transaction: event time as epoch milliseconds (timestamp-millis).
RAW_TRANSACTION = _schema(*[(f.name, L if f.name == "txn_time" else f.dataType, f.nullable)
                            for f in SCHEMAS["transaction"].fields])

# Raw wire form of the dimension records: dates and timestamps travel as ISO-8601 text.
RAW_DIMENSIONS: dict[str, T.StructType] = {
    name: _schema(*[(f.name, S if isinstance(f.dataType, (T.DateType, T.TimestampType)) else f.dataType,
                     f.nullable) for f in SCHEMAS[name].fields])
    for name in ("account", "branch", "customer", "employee", "product")
}

# Column that holds the text of a record that is no JSON of its schema.
CORRUPT = "_corrupt_record"

PRIMARY_KEYS: dict[str, list[str]] = {
    "branch": ["branch_id"],
    "customer": ["customer_id"],
    "employee": ["emp_id"],
    "product": ["product_id"],
    "account": ["account_id"],
    "transaction": ["txn_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("account", "customer_id", "customer", "customer_id"),
    ("account", "branch_id", "branch", "branch_id"),
    ("employee", "branch_id", "branch", "branch_id"),
    ("employee", "manager_id", "employee", "emp_id"),
    ("transaction", "account_id", "account", "account_id"),
    ("transaction", "product_id", "product", "product_id"),
    ("transaction", "approved_by_emp_id", "employee", "emp_id"),
]

# Enum domains of the contracts. Account status and customer segment take
# the union of the documented and the generated values.
DOMAINS: dict[tuple[str, str], list[str]] = {
    ("transaction", "txn_type"): ["Deposit", "Withdrawal", "Transfer", "POS", "Fee", "EMI"],
    ("transaction", "currency"): ["USD", "EUR", "GBP", "INR", "AUD"],
    ("transaction", "channel"): ["Digital", "Branch", "POS"],
    ("transaction", "status"): ["approved", "pending", "declined"],
    ("account", "status"): ["Active", "Inactive", "Frozen", "Closed"],
    ("customer", "customer_segment"): ["Retail", "HNI", "Corporate", "SME"],
}

# Target shares of the generated columns (weights as given).
TARGET_WEIGHTS: dict[tuple[str, str], dict[str, float]] = {
    ("customer", "customer_segment"): {"Retail": 0.7, "HNI": 0.2, "Corporate": 0.1},
    ("branch", "city"): {"Mumbai": 30, "Delhi": 15, "Bengaluru": 10, "Chennai": 10, "Pune": 20,
                         "Hyderabad": 15},
    ("account", "status"): {"Active": 0.8, "Inactive": 0.15, "Frozen": 0.05},
    ("transaction", "channel"): {"Digital": 0.6, "Branch": 0.3, "POS": 0.1},
    ("transaction", "status"): {"approved": 0.70, "pending": 0.20, "declined": 0.10},
    ("transaction", "currency"): {"USD": 0.50, "EUR": 0.15, "GBP": 0.10, "INR": 0.20, "AUD": 0.05},
}

# Amount bounds and thresholds of the rollups.
AMOUNT_MIN, AMOUNT_MAX = 1.0, 150_000.0
HIGH_VALUE = 10_000          # Q2: amount > 10,000
CITY_HIGH_VALUE = 50_000     # Q3: amount > 50,000
Q5_MIN_ACCOUNTS = 5          # Q5: account_count > 5
Q5_MIN_AMOUNT = 1_000_000    # Q5: amount >= 1,000,000
WATERMARK_DELAY = "5 seconds"
WINDOW = "1 hour"
MANAGER_SHARE = 0.10         # exactly ceil(10 %) of employees are managers

# Result keys of the maintained tables (used by upsert/refresh).
RESULT_KEYS: dict[str, list[str]] = {
    "q1": ["txn_id"],
    "q2": ["txn_id"],
    "q3": ["window_start", "city"],
    "q3r": ["txn_id"],
    "q4": ["txn_id"],
    "q5a": ["customer_id"],
    "q5b": ["customer_id", "quarter"],
    "q5": ["customer_id", "quarter"],
    "q6": ["branch_id", "txn_date"],
}
