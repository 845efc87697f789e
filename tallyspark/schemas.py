"""Schemas of the change envelope, the transaction row and the feature table."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the source transaction row and of the feature
# table, as the downstream tables and feature views expect them.
USER_COL = "User ID"
TXN_COL = "Transaction ID"
AMOUNT_COL = "Amount"
VENDOR_COL = "Vendor"
SOURCE_COL = "Sources"
TIME_COL = "Time"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fields and types of a row in the messages.
TRANSACTION_ROW = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField(USER_COL, T.StringType(), True),
    T.StructField(TXN_COL, T.StringType(), True),
    T.StructField(AMOUNT_COL, T.DoubleType(), True),
    T.StructField(VENDOR_COL, T.StringType(), True),
    T.StructField(SOURCE_COL, T.StringType(), True),
    T.StructField(TIME_COL, T.StringType(), True),
])

# Only the source fields the operators read.  ``from_json`` parses every
# field of the schema it is given, so a minimal schema is the column pruning
# that Catalyst cannot do inside a JSON string.
SOURCE_MIN = T.StructType([
    T.StructField("ts_ms", T.LongType(), True),
    T.StructField("lsn", T.LongType(), True),
])

def payload_schema(row_schema: T.StructType = TRANSACTION_ROW, row_as_text: bool = False) -> T.StructType:
    """``before``/``after``/``source``/``op``/``ts_ms``."""
    row_t = T.StringType() if row_as_text else row_schema
    return T.StructType([
        T.StructField("before", row_t, True),
        T.StructField("after", row_t, True),
        T.StructField("source", SOURCE_MIN, True),
        T.StructField("op", T.StringType(), True),
        T.StructField("ts_ms", T.LongType(), True),
    ])


def envelope_schema(row_schema: T.StructType = TRANSACTION_ROW, row_as_text: bool = False) -> T.StructType:
    """One schema that reads both message shapes.

    A wrapped message is ``{"schema": …, "payload": {…}}``; a bare one
    (converter schemas disabled) is the payload itself.  Both sets of
    fields are declared, so one ``from_json`` pass reads either shape and
    the caller coalesces them.
    """
    payload = payload_schema(row_schema, row_as_text)
    return T.StructType([T.StructField("payload", payload, True)] + list(payload.fields))


FEATURE_NAMES = ("num_transactions", "total_amount", "avg_amount", "min_amount",
                 "max_amount", "num_vendors", "num_sources")


def feature_columns(label: str = "l1w") -> list[str]:
    return [f"{n}_{label}" for n in FEATURE_NAMES]
