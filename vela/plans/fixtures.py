"""Derived inputs for the checks, built from the given tables only.

The driver tables hold no NULL, NaN, blank or duplicate, so cleaning checks
first blank cells by a key rule.  Every rule is written twice, once as
DataFrame code here and once as SQL text (``*_SQL``) for the DuckDB oracle;
both keep every row of the source table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vela.sources.io import read_table


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, name, sf)


def _blank(col: str, key: str, mod: int, rem: int):
    return F.when(F.pmod(F.col(key), F.lit(mod)) == rem, F.lit(None)).otherwise(F.col(col)).alias(col)


def dirty_orders(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    _blank("o_totalprice", "o_orderkey", 8, 3), "o_orderdate",
                    _blank("o_orderpriority", "o_orderkey", 11, 5))


DIRTY_ORDERS_SQL = """(SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 8 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""


def sparse_orders(spark, sf) -> DataFrame:
    """Orders with four numeric columns blanked at different rates."""
    o = t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        _blank("o_totalprice", "o_orderkey", 3, 1),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(4)) == 1, F.lit(None))
        .otherwise(F.col("o_custkey").cast("double")).alias("x_cust"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(5)) <= 1, F.lit(None))
        .otherwise(F.col("o_totalprice") / 7.0).alias("x_price7"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(2)) == 1, F.lit(None))
        .otherwise(F.col("o_custkey") % 97).cast("double").alias("x_mod"),
        "o_orderstatus")


SPARSE_ORDERS_SQL = """(SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_custkey::DOUBLE END AS x_cust,
  CASE WHEN o_orderkey % 5 <= 1 THEN NULL ELSE o_totalprice / 7.0 END AS x_price7,
  CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE (o_custkey % 97)::DOUBLE END AS x_mod,
  o_orderstatus
  FROM orders)"""


def scored_events(spark, sf) -> DataFrame:
    """Binary label and a probability-like score from ``events``."""
    e = t(spark, sf, "events")
    return e.select("event_id",
                    F.when(F.col("event_type").isin("purchase", "signup"), F.lit(1)).otherwise(F.lit(0))
                    .alias("label"),
                    (F.col("value") / (F.col("value") + F.lit(25.0))).alias("score"),
                    F.col("value").alias("value"), "event_type")


SCORED_EVENTS_SQL = """(SELECT event_id,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS label,
  value / (value + 25.0) AS score, value, event_type
  FROM events)"""
