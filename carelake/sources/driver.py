"""Readers for the driver's analogue tables (explicit schemas, never inferred).

Analogy used by the registered queries (see README): person = ``customer``,
encounter = ``orders``, encounter child (diagnosis / procedure / medication)
= ``lineitem``, code lookup = ``part``, personnel = ``supplier``, claim
events / alerts / change events = ``events``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.schema(..).parquet(..)`` — the scan prunes columns and
    receives pushed filters from the plan that uses it."""
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``t.orders`` reads ``orders.parquet`` of ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_SCHEMAS:
            return read(self.spark, self.sf_dir, name)
        raise AttributeError(name)
