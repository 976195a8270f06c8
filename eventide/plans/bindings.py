"""Bindings of the reference's event types onto the provided test tables.

The test tables carry no behaviour logs, so ``events(event_id, ts, user_id,
event_type, value, props)`` stands in for every event stream:

* item / URL id  = ``props.k``
* page view      = ``event_type = 'view'``
* login failure  = ``event_type = 'error'``
* arrival order  = ``event_id`` (the tie-break sequence)

Payments and receipts for reconciliation come from ``orders`` and the first
ship date of each order in ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def behavior_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UserBehavior-shaped view of ``events``: seq, ts, user_id, item_id, behavior."""
    return behavior_view(table(spark, sf_dir, "events"))


def behavior_stream(spark: SparkSession, sf_dir: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """The same view over ``events`` read as a file stream."""
    from eventide.streaming.jobs import stream_table
    return behavior_view(stream_table(spark, sf_dir, "events", max_files_per_trigger))


def behavior_view(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("seq"),
        "ts",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("event_type").alias("behavior"),
    )


def weblog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LogEvent-shaped view: url = '/<event_type>/<k>'."""
    return weblog_view(behavior_events(spark, sf_dir))


def weblog_view(ev: DataFrame) -> DataFrame:
    return ev.select(
        "seq", "ts", "user_id",
        F.concat(F.lit("/"), F.col("behavior"), F.lit("/"),
                 F.col("item_id").cast("string")).alias("url"))


# Channel of a user = element (user_id % 5) of this list.
CHANNELS = [f"channel_{i}" for i in range(5)]


def marketing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MarketingUserBehavior-shaped view: channel from user_id, behavior = type."""
    return marketing_view(behavior_events(spark, sf_dir))


def marketing_view(ev: DataFrame) -> DataFrame:
    channels = F.array(*[F.lit(c) for c in CHANNELS])
    return ev.select(
        "seq", "ts", "user_id",
        F.element_at(channels, (F.pmod(F.col("user_id"), F.lit(len(CHANNELS))) + 1)
                     .cast("int")).alias("channel"),
        "behavior")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay events: one per order; the transaction id is the order key (kept
    BIGINT so the join can reuse the aggregate's partitioning)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"))


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt events: first ship date per order in lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("tx_id"))
            .agg(F.min("l_shipdate").alias("receipt_ts")))
