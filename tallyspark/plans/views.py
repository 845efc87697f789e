"""Feature definitions used by the registered queries.

The transaction view reads the backfilled daily feature table (timestamp
column ``date``); the demographic view reads customers joined with their
nation and has no timestamp (joined on the key alone).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import Entity, FeatureSource, FeatureView, Field
from . import inputs as I

CUSTOMER = Entity("customer", ("user_id",), "Customer identifier")

TRANSACTION_FIELDS = (
    Field("num_transactions_l1w", "Int64"),
    Field("total_amount_l1w", "Float32"),
    Field("avg_amount_l1w", "Float32"),
    Field("min_amount_l1w", "Float32"),
    Field("max_amount_l1w", "Float32"),
    Field("num_vendors_l1w", "Int64"),
    Field("num_sources_l1w", "Int64"),
)

TRANSACTION_SOURCE = FeatureSource("transaction_source", None, "parquet", "date")

CUSTOMER_FEATURES = FeatureView("customer_features", (CUSTOMER,), TRANSACTION_FIELDS,
                                TRANSACTION_SOURCE)

# The same view with a short time-to-live, so that older rows drop out.
CUSTOMER_FEATURES_TTL = FeatureView("customer_features_ttl", (CUSTOMER,), TRANSACTION_FIELDS,
                                    TRANSACTION_SOURCE, ttl=dt.timedelta(hours=12))

DEMOGRAPHICS = FeatureView(
    "customer_demographics", (CUSTOMER,),
    (Field("location", "String"), Field("occupation", "String"), Field("balance", "Float64")),
    FeatureSource("customer_source", None, "parquet", None), online=False)

REFS = ["customer_features:num_transactions_l1w", "customer_features:total_amount_l1w",
        "customer_features:num_vendors_l1w"]


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = I.table(spark, sf_dir, "customer")
    n = I.table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        c.c_custkey.cast("string").alias("user_id"),
        n.n_name.alias("location"),
        c.c_mktsegment.alias("occupation"),
        c.c_acctbal.alias("balance"))


def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training entity rows: every event, keyed by user, at its time."""
    ev = I.table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("event_timestamp"))


def online_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Online lookup keys: every customer (most have no transactions)."""
    return I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"))


# Order attributes as texts, some of which do not fit the declared types.
TEXT_FEATURES = FeatureView(
    "order_texts", (Entity("customer", ("user_id",), "Customer identifier"),),
    (Field("priority", "Int64"), Field("price", "Float64"), Field("status", "String")),
    FeatureSource("order_source", None, "parquet", "date"))


def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = I.table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.when(F.col("o_orderkey") % 5 != 0, F.substring("o_orderpriority", 1, 2)).alias("priority"),
                    F.col("o_totalprice").cast("string").alias("price"),
                    F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("date"))
