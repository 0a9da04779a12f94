"""Registered queries against their SQL, on the smallest scale.

MARTKIT_ALL_QUERIES=1 runs every query; ``python tests/oracle_check.py FOLDER`` does the same for any scale.
"""
from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from martkit.plans.registry import all_queries

SMALL = "/root/testdata/sf0.001"
SOME = ["q01_monthly_trend", "q02_top_categories", "q04_repeat_customers", "q07_payments", "q08_seller_risk",
        "q09_seller_concentration", "fact_order_items", "dim_customer", "chk_nulls", "chk_coverage",
        "chk_full_duplicates", "chk_foreign_keys", "chk_iqr_outliers", "rpt_mom_yoy", "rpt_late_by_state",
        "msr_sellers", "star_integrity", "cl_log", "win_lead_next", "io_csv_roundtrip",
        "q03_revenue_by_state", "q05_delivery_by_state", "q06_delay_vs_review", "fact_orders", "dim_date", "dim_product", "dim_seller",
        "msr_sales_by_category", "msr_customers", "msr_operations_by_state", "msr_satisfaction", "msr_payments_share",
        "msr_yoy_of_range", "msr_mom_within_month", "msr_periods_by_year", "data_dictionary", "table_overview",
        "win_sequence_per_key", "win_row_number_ntile", "fn_text", "fn_time_gaps", "fn_rounding", "fn_bands", "cl_normalize_text",
        "io_csv_typed", "io_parse_failures", "io_load_all", "io_refusals", "io_star_views", "rpt_kpi_row", "rpt_top10",
        "io_csv_split", "io_whole_numbers", "io_cleaning_log", "io_refused_star", "agg_distinct_sets", "rpt_category_matrix_totals",
        "msr_totals_by_region", "msr_totals_by_payment", "msr_totals_by_seller", "q08_seller_risk_50", "rpt_seller_scatter_50", "rpt_seller_risk_50"]
NAMES = sorted(all_queries()) if os.environ.get("MARTKIT_ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(all_queries()) <= set(oracle_sql()) <= set(queries())


def test_entry_has_a_stable_schema(spark):
    df = entry(spark)
    assert df.columns[:3] == ["year_month", "orders", "revenue"] and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_oracle(spark, duck, name):
    ok, note = compare(spark, duck, SMALL, name, queries()[name], oracle_sql()[name])
    assert ok, note
