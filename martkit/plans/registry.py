"""Every registered query over a folder of test tables: name -> (spark, folder) -> DataFrame."""
from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import round_half_even
from ..operators import checks, cleaning
from ..sources.carriers import desk_tables, raw_tables
from ..operators.calendar import monthly_orders
from .catalogue import CATALOGUE, seller_risk
from .integrity import check_star, data_dictionary, table_overview
from .measures import evaluate
from .operator_queries import OPERATOR_QUERIES
from .reports import REPORTS, risk_sellers, seller_scatter
from .star import STAR_COLUMNS, Star

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, so two engines can be compared value by value."""
    def plain(f: T.StructField):
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)
    return df.select(*[plain(f) for f in df.schema.fields])


def register(name: str, build: Callable[[Star], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, folder: portable(build(Star(raw_tables(spark, folder))))


def register_raw(name: str, build: Query) -> None:
    _QUERIES[name] = lambda spark, folder: portable(build(spark, folder))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---------------------------------------------------------------- business questions
for _name, _build in CATALOGUE.items():
    register(_name, _build)
# The test tables hold at most 16 single-seller orders per seller at the smaller scales, so the floor is lower here.
register("q08_seller_risk", lambda star: seller_risk(star, min_orders=5))

# ---------------------------------------------------------------- star tables
for _name in STAR_COLUMNS:
    register(_name, lambda star, name=_name: star.table(name))
register("monthly_orders", lambda star: monthly_orders(star.raw["orders"]))

# ---------------------------------------------------------------- data quality
_CHECKS = {
    "chk_parsing": checks.check_parsing, "chk_nulls": checks.check_nulls, "chk_coverage": checks.check_coverage,
    "chk_primary_key": checks.check_primary_keys, "chk_full_duplicates": checks.check_full_duplicates,
    "chk_grain": checks.check_grain, "chk_foreign_keys": checks.check_foreign_keys,
    "chk_allowed_values": checks.check_allowed_values, "chk_numeric_ranges": checks.check_numeric_ranges,
    "chk_bbox": checks.check_coordinates, "chk_date_order": checks.check_date_order,
    "chk_status_vs_dates": checks.check_status_vs_dates, "chk_shipping_limit": checks.check_shipping_limit,
    "chk_reconcile": checks.check_payments_vs_items, "chk_iqr_outliers": checks.check_outliers,
    "chk_business_outlier": checks.check_business_outlier, "chk_timeliness": checks.check_timeliness,
    "chk_profile": checks.profile_tables, "missing_ranking": checks.missing_ranking,
}
for _name, _build in _CHECKS.items():
    register(_name, lambda star, build=_build: build(star.raw))
register("chk_summary", lambda star: checks.summarize(checks.run_checks(star.raw), monthly_orders(star.raw["orders"])))

# ---------------------------------------------------------------- report queries and measures
for _name, _build in REPORTS.items():
    register(_name, _build)
register("rpt_seller_scatter", lambda star: seller_scatter(star, min_orders=5))
register("rpt_seller_risk", lambda star: risk_sellers(star, min_orders=5))
# The floors as they are by default, over tables with larger sellers.
for _name, _build in (("q08_seller_risk_50", seller_risk), ("rpt_seller_scatter_50", seller_scatter), ("rpt_seller_risk_50", risk_sellers)):
    register_raw(_name, lambda spark, folder, build=_build: portable(build(Star(desk_tables(spark, folder)))))

_SALES = ["revenue", "orders", "aov", "items_sold", "freight", "freight_pct", "customers", "repeat_customers",
          "repeat_customer_pct", "revenue_per_customer", "active_sellers"]
_OPERATIONS = ["delivered_orders", "late_orders", "on_time_pct", "late_pct", "avg_delivery_days", "avg_promised_days",
               "promise_buffer_days", "avg_delay_when_late", "avg_carrier_lead_days", "avg_last_mile_days"]
_FIRST_HALF = ("dim_date.month_num", "between", (1, 6))
register("msr_sales_by_category", lambda star: evaluate(star, _SALES, ["dim_product.category"]))
register("msr_customers", lambda star: evaluate(
    star, [*_SALES, "repeat_purchase_pct"], ["dim_customer.region", "dim_date.year"], [_FIRST_HALF]))
register("msr_operations_by_state", lambda star: evaluate(
    star, _OPERATIONS, ["dim_customer.state"], [("dim_customer.region", "in", ["South", "Northeast"])]))
register("msr_satisfaction", lambda star: evaluate(
    star, ["reviews", "avg_review_score", "negative_review_pct", "five_star_pct", "avg_review_on_time",
           "avg_review_late", "review_gap"], ["dim_date.year_quarter"]))
register("msr_payments_share", lambda star: evaluate(
    star, ["paid_orders", "payment_share", "installment_pct", "avg_installments_card", "aov_by_order"],
    ["fact_orders.main_payment_type", "dim_date.year"]))
register("msr_sellers", lambda star: evaluate(
    star, ["seller_orders", "seller_avg_review", "seller_negative_pct", "seller_late_pct", "seller_risk_flag",
           "active_sellers", "revenue"], ["dim_seller.seller_id", "dim_seller.seller_label", "dim_date.year"],
    risk=(3, 0.3)))

# Details with subtotals and grand total in one plan.
for _name, _measures, _by in (
        ("rpt_category_matrix_totals", "revenue orders aov freight_pct", "dim_product.category dim_date.year"),
        ("msr_totals_by_region", "revenue orders customers repeat_customers repeat_customer_pct active_sellers late_pct repeat_purchase_pct",
         "dim_customer.region dim_customer.state dim_date.year"),
        ("msr_totals_by_payment", "paid_orders payment_share installment_pct aov_by_order", "fact_orders.main_payment_type dim_date.year"),
        ("msr_totals_by_seller", "seller_orders seller_avg_review seller_late_pct active_sellers revenue", "dim_date.year dim_seller.seller_id")):
    register(_name, lambda star, measures=_measures.split(), by=_by.split(): evaluate(star, measures, by, totals=True))

# Periods over a range, within part of a month, and by year: the earlier dates are the current ones moved back.
_PERIODS = ["revenue", "revenue_pm", "revenue_mom_pct", "orders", "orders_pm", "orders_mom_pct", "revenue_py", "revenue_yoy_pct"]
register("msr_yoy_of_range", lambda star: evaluate(star, _PERIODS, (), [
    ("dim_date.year", "is", 1998), ("dim_date.month_num", "between", (1, 8))]))
register("msr_mom_within_month", lambda star: evaluate(star, _PERIODS, ["dim_customer.region"], [
    ("dim_date.date", "between", (date(1996, 3, 10), date(1996, 3, 31)))]))
register("msr_periods_by_year", lambda star: evaluate(star, _PERIODS, ["dim_date.year"]))

# ---------------------------------------------------------------- cleaning treatments, integrity, documentation


def _centres(star: Star) -> DataFrame:
    zips, cities = cleaning.clean_geolocation(star.raw["geolocation"])
    place = F.concat_ws("/", "state", "city_norm").alias("place")
    both = zips.select(F.col("zip_code_prefix").alias("place"), "lat", "lng").unionByName(
        cities.select(place, "lat", "lng"))
    return both.select("place", *[round_half_even(F.col(c), 6).alias(c) for c in ("lat", "lng")])


register("cl_order_durations", lambda star: cleaning.clean_orders(star.raw["orders"]))
register("cl_item_features", lambda star: cleaning.clean_items(star.raw["order_items"], star.raw["orders"]))
register("cl_main_payment", lambda star: cleaning.clean_payments(star.raw["order_payments"]))
register("cl_latest_per_key", lambda star: cleaning.clean_reviews(star.raw["order_reviews"]))
register("cl_entity_latest_address",
         lambda star: cleaning.latest_address(star.raw["customers"], star.raw["orders"]))
register("cl_median_fallback", _centres)
register("cl_category_map",
         lambda star: cleaning.clean_products(star.raw["products"], star.raw["category_translation"]))
register("cl_log", lambda star: cleaning.cleaning_log(star.raw))
register("star_integrity", lambda star: check_star(star, star.raw))
register("data_dictionary", data_dictionary)
register("table_overview", table_overview)

# ---------------------------------------------------------------- single operators
for _name, _build in OPERATOR_QUERIES.items():
    register_raw(_name, _build)
