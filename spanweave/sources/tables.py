"""Timelines read from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.functions.intervals import micros


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_profile(spark: SparkSession, sf_dir: str, value: str, where: str = "true") -> DataFrame:
    """(user_id, lo, hi, value): each event holds until the user's next; the last at its own instant."""
    events = read(spark, sf_dir, "events").filter(where).select("user_id", "event_id", micros("ts").alias("t"), F.expr(value).alias("value"))
    following = F.lead("t").over(Window.partitionBy("user_id").orderBy("t", "event_id"))
    return events.select("user_id", (F.col("t") * 2).alias("lo"), F.coalesce(following * 2, F.col("t") * 2 + 1).alias("hi"), "value").filter("lo < hi")


def line_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_suppkey, l_orderkey, l_linenumber, lo, hi): order lines from the order to the shipping, both days included."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", micros("l_shipdate").alias("e"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", micros("o_orderdate").alias("s"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_suppkey", "l_orderkey", "l_linenumber", (F.col("s") * 2).alias("lo"), (F.col("e") * 2 + 1).alias("hi")).filter("lo < hi")
