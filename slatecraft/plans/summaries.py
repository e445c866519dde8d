"""Nested orders to flat orders to customer totals, and a summary by group next to overall totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.functions.numeric import round_to


def flat_orders(raw: DataFrame) -> DataFrame:
    """Fields of the nested customer next to the order; dates as dates."""
    return raw.select(
        "order_id",
        F.col("customer.id").alias("customer_id"),
        F.col("customer.name").alias("customer_name"),
        F.col("customer.email").alias("customer_email"),
        F.to_date("order_date").alias("order_date"),
        F.col("total").alias("order_total"),
    )


def customer_summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id", "customer_name", "customer_email").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("order_total").alias("total_revenue"),
        F.avg("order_total").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def group_statistics(people: DataFrame, group: str, measure: str) -> DataFrame:
    return people.groupBy(group).agg(
        F.count(F.lit(1)).alias("employee_count"),
        F.avg(measure).alias("avg_age"),
        F.min(measure).alias("min_age"),
        F.max(measure).alias("max_age"),
    )


def group_mart(people: DataFrame, users: DataFrame, group: str, measure: str, created: str) -> DataFrame:
    """Rows and mean per group, each with the overall number of users and their active months."""
    groups = people.groupBy(group).agg(
        F.count(F.lit(1)).alias("total_employees"), round_to(F.avg(measure), 1).alias("avg_age")
    )
    total = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    months = users.agg(F.count_distinct(F.date_trunc("month", F.col(created))).alias("n")).scalar()
    return groups.withColumn("total_users", total).withColumn("active_months", months)
