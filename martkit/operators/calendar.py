"""Months and days of the purchase calendar."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import specs
from ..functions.times import calendar_columns


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def monthly_orders(orders: DataFrame, threshold: float = specs.INCOMPLETE_MONTH_SHARE) -> DataFrame:
    """month, orders, share_of_median, incomplete: every month between the first and the last order.

    Orders are counted per month first, so the windows and the median see one row per month.
    """
    ts = F.col("order_purchase_timestamp")
    counted = orders.where(ts.isNotNull()).groupBy(month_of(ts).alias("month")).agg(F.count("*").alias("n"))
    span = counted.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    filled = spine.join(counted, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("orders"))
    typical = F.percentile("orders", F.lit(0.5)).over(Window.partitionBy())
    share = F.try_divide(F.col("orders").cast("double"), F.col("typical"))
    return filled.withColumn("typical", typical).select(
        "month", "orders", share.alias("share_of_median"),
        F.coalesce(share < threshold, F.lit(False)).alias("incomplete"))


def complete_months(orders: DataFrame) -> DataFrame:
    return monthly_orders(orders).where(~F.col("incomplete")).select("month")


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day of every calendar year that has an order."""
    ts = F.to_date("order_purchase_timestamp")
    span = orders.agg(F.year(F.min(ts)).alias("lo"), F.year(F.max(ts)).alias("hi"))
    days = span.select(F.explode(F.sequence(
        F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("d"))
    parts = days.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])
    whole = complete_months(orders).select(F.col("month").alias("_m"))
    return parts.join(whole, F.col("month_start") == F.col("_m"), "left") \
        .withColumn("is_complete_month", F.col("_m").isNotNull()).drop("_m")
