"""Dashboard queries: one per visual, each a grouping, some measures and an order."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .measures import evaluate

MONTH, STATE, REGION = "dim_date.year_month", "dim_customer.state", "dim_customer.region"
CATEGORY, BUCKET, BUCKET_ORDER = "dim_product.category", "fact_orders.delivery_bucket", \
    "fact_orders.delivery_bucket_order"
COMPLETE = ("dim_date.is_complete_month", "is", True)
SELLER = ["dim_seller.seller_id", "dim_seller.seller_label", "dim_seller.state"]


def kpi_row(star) -> DataFrame:
    return evaluate(star, ["revenue", "orders", "aov", "on_time_pct", "avg_review_score", "repeat_customer_pct"])


def revenue_by_month(star) -> DataFrame:
    return evaluate(star, ["revenue"], [MONTH], [COMPLETE]).orderBy("year_month")


def top_categories(star, k: int = 10) -> DataFrame:
    return evaluate(star, ["revenue"], [CATEGORY]).orderBy(F.desc("revenue"), "category").limit(k)


def review_by_bucket(star) -> DataFrame:
    """Average and share of negative reviews per delivery band, in band order."""
    return evaluate(star, ["avg_review_score", "negative_review_pct"], [BUCKET, BUCKET_ORDER]) \
        .where("delivery_bucket IS NOT NULL").orderBy("delivery_bucket_order")


def customer_kpis(star) -> DataFrame:
    return evaluate(star, ["revenue", "aov", "customers", "revenue_per_customer", "repeat_customers",
                           "repeat_customer_pct", "repeat_purchase_pct"])


def growth_by_month(star) -> DataFrame:
    return evaluate(star, ["revenue", "revenue_pm", "revenue_mom_pct", "orders", "orders_pm", "orders_mom_pct",
                           "revenue_py", "revenue_yoy_pct"], [MONTH]).orderBy("year_month")


def revenue_by_state(star) -> DataFrame:
    return evaluate(star, ["revenue", "aov", "orders"], [STATE]).orderBy(F.desc("revenue"), "state")


def category_matrix(star) -> DataFrame:
    return evaluate(star, ["revenue", "orders", "aov", "freight_pct"], [CATEGORY]).orderBy("category")


def ticket_by_installments(star) -> DataFrame:
    by = ["fact_orders.installment_bucket", "fact_orders.installment_bucket_order"]
    return evaluate(star, ["aov_by_order", "avg_installments_card", "installment_pct"], by) \
        .orderBy("installment_bucket_order")


def payment_share(star) -> DataFrame:
    return evaluate(star, ["paid_orders", "payment_share", "aov_by_order"], ["fact_orders.main_payment_type"]) \
        .orderBy(F.desc("payment_share"), "main_payment_type")


def delivery_kpis(star) -> DataFrame:
    return evaluate(star, ["avg_delivery_days", "avg_promised_days", "promise_buffer_days", "on_time_pct",
                           "late_orders", "avg_delay_when_late"])


def delivery_by_month(star) -> DataFrame:
    return evaluate(star, ["avg_delivery_days", "avg_promised_days"], [MONTH]).orderBy("year_month")


def late_by_state(star) -> DataFrame:
    """Late share per state, flagged where it lies above the share over all states."""
    states = evaluate(star, ["late_pct", "late_orders", "delivered_orders"], [STATE])
    overall = states.agg(F.try_divide(F.sum("late_orders").cast("double"), F.sum("delivered_orders").cast("double"))
                         .alias("overall"))
    return states.crossJoin(F.broadcast(overall)).select(
        "state", "late_pct", (F.col("late_pct") > F.col("overall")).alias("above_average")) \
        .orderBy(F.desc("late_pct"), "state")


def lead_times_by_region(star) -> DataFrame:
    return evaluate(star, ["avg_carrier_lead_days", "avg_last_mile_days"], [REGION]).orderBy("region")


def delivered_by_bucket(star) -> DataFrame:
    return evaluate(star, ["delivered_orders"], [BUCKET, BUCKET_ORDER]).where("delivery_bucket IS NOT NULL") \
        .orderBy("delivery_bucket_order")


def satisfaction_kpis(star) -> DataFrame:
    return evaluate(star, ["reviews", "avg_review_score", "negative_review_pct", "five_star_pct",
                           "avg_review_on_time", "avg_review_late", "review_gap"])


def seller_scatter(star, min_orders: int = 50) -> DataFrame:
    return evaluate(star, ["seller_orders", "seller_avg_review", "revenue"], SELLER[:2]) \
        .where(F.col("seller_orders") >= min_orders).orderBy("seller_id")


def risk_sellers(star, min_orders: int = 50, gap: float = 0.3) -> DataFrame:
    return evaluate(star, ["seller_orders", "revenue", "seller_avg_review", "seller_negative_pct", "seller_late_pct",
                           "seller_risk_flag"], SELLER, risk=(min_orders, gap)) \
        .where("seller_risk_flag = 1").orderBy(F.desc("seller_negative_pct"), "seller_id")


REPORTS = {
    "rpt_kpi_row": kpi_row,
    "rpt_revenue_by_month": revenue_by_month,
    "rpt_top10": top_categories,
    "rpt_review_by_bucket": review_by_bucket,
    "rpt_customer_kpis": customer_kpis,
    "rpt_mom_yoy": growth_by_month,
    "rpt_revenue_by_state": revenue_by_state,
    "rpt_category_matrix": category_matrix,
    "rpt_ticket_by_installments": ticket_by_installments,
    "rpt_payment_share": payment_share,
    "rpt_delivery_kpis": delivery_kpis,
    "rpt_delivery_by_month": delivery_by_month,
    "rpt_late_by_state": late_by_state,
    "rpt_lead_times_by_region": lead_times_by_region,
    "rpt_delivered_by_bucket": delivered_by_bucket,
    "rpt_satisfaction_kpis": satisfaction_kpis,
    "rpt_seller_scatter": seller_scatter,
    "rpt_seller_risk": risk_sellers,
}
