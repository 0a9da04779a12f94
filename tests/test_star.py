"""Cleaning treatments, star tables and their gate."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row

from martkit.functions import band_label, band_order, fold_city, installment_band, round_half_even, whole_days_elapsed
from martkit.operators import cleaning
from martkit.operators.calendar import dim_date
from martkit.plans.batch import open_star, run_batch, write_star
from martkit.plans.integrity import IntegrityError, assert_star, check_star
from martkit.plans.measures import MEASURES, evaluate
from martkit.plans.star import STAR_COLUMNS, Star, StoredStar
from martkit.specs import DELIVERY_BANDS


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_payments_per_order(tables):
    rows = by(cleaning.clean_payments(tables["order_payments"]), "order_id")
    o1 = rows["o1"]
    assert (o1.payment_total, o1.payment_methods, o1.main_payment_type, o1.used_voucher) == (220, 2, "credit_card", True)
    assert min(r.max_installments for r in rows.values()) == 1 and len(rows) == 3


def test_equal_payments_go_to_the_earlier_row(spark):
    df = spark.createDataFrame([("o", 2, "boleto", 1, 5.0), ("o", 1, "voucher", 1, 5.0), ("o", 3, "card", 1, None)],
                               "order_id string, payment_sequential int, payment_type string, "
                               "payment_installments int, payment_value double")
    assert cleaning.clean_payments(df).first().main_payment_type == "voucher"


def test_latest_review_missing_time_wins_and_copies_count_once(spark):
    t = dt.datetime
    df = spark.createDataFrame(
        [("a", "o", 1, None, None, t(2017, 1, 1), t(2017, 1, 2)), ("b", "o", 2, None, "x", t(2017, 1, 3), t(2017, 1, 4)),
         ("b", "o", 2, None, "x", t(2017, 1, 3), t(2017, 1, 4)), ("c", "p", 3, None, None, t(2017, 1, 1), None),
         ("d", "p", 4, "t", None, None, None)],
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
    rows = by(cleaning.clean_reviews(df), "order_id")
    assert (rows["o"].review_score, rows["o"].review_count, rows["o"].has_comment) == (2, 2, True)
    assert rows["o"].review_response_hours == 24.0
    assert (rows["p"].review_score, rows["p"].review_count) == (4, 2)


def test_products(tables):
    rows = by(cleaning.clean_products(tables["products"], tables["category_translation"]), "product_id")
    assert (rows["p1"].category, rows["p2"].category) == ("Health Beauty", "Pc Gamer")
    assert rows["p2"].product_weight_g is None and rows["p1"].product_volume_cm3 == 3000.0
    assert "product_name_length" in rows["p1"]


def test_delivery_logic(tables):
    rows = by(cleaning.clean_orders(tables["orders"]), "order_id")
    assert [rows[k].is_delivered for k in ("o1", "o2", "o3", "o4")] == [False, False, False, True]
    assert not rows["o3"].is_sale
    o4 = rows["o4"]
    assert (o4.delivery_days, o4.delay_days, o4.is_late) == (4.0, -5, False)
    assert rows["o2"].is_late is None and rows["o1"].flag_delivered_before_carrier


def test_coordinates(tables):
    zips, cities = cleaning.clean_geolocation(tables["geolocation"])
    rows = by(zips, "zip_code_prefix")
    assert set(rows) == {"01001", "20000"} and all(-34 <= r.lat <= 6 for r in rows.values())
    placed = by(cleaning.clean_customers(tables["customers"], tables["orders"], zips, cities), "customer_unique_id")
    assert placed["u2"].geo_source == "missing" and placed["u2"].lat is None
    assert placed["u1"].geo_source == "zip"
    moved = tables["customers"].selectExpr("customer_id", "customer_unique_id", "'99999' AS customer_zip_code_prefix",
                                           "' São  PAULO' AS customer_city", "'SP' AS customer_state")
    placed = cleaning.clean_customers(moved, tables["orders"], zips, cities).first()
    assert (placed.geo_source, placed.lat) == ("city_centroid", -23.55)


def test_city_folding(spark):
    texts = ["  São   Paulo ", "BRASÍLIA", "straße", "a b", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(fold_city(df.s)).collect()] == ["sao paulo", "brasilia", "strae", "a b", "e"]


def test_calendar_covers_whole_years(tables):
    days = dim_date(tables["orders"]).collect()
    assert (min(d.date for d in days), max(d.date for d in days)) == (dt.date(2017, 1, 1), dt.date(2017, 12, 31))
    assert len({d.date_key for d in days}) == len(days) == 365


def test_band_edges(spark):
    values = [-15, -10, -9, -1, 0, 1, 3, 4, 7, 8, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d int")
    rows = df.select(band_label(df.d, DELIVERY_BANDS), band_order(df.d, DELIVERY_BANDS)).collect()
    assert [r[0] for r in rows] == ["10+ days early"] * 2 + ["1-9 days early"] * 2 + ["On promised day"] \
        + ["1-3 days late"] * 2 + ["4-7 days late"] * 2 + ["8+ days late", None]
    assert [r[1] for r in rows] == [1, 1, 2, 2, 3, 4, 4, 5, 5, 6, None]
    cards = spark.createDataFrame([(1, "credit_card"), (6, "credit_card"), (None, "credit_card"), (3, "boleto"),
                                   (3, None)], "n int, m string")
    assert [tuple(r) for r in cards.select(*installment_band(cards.n, cards.m)).collect()] == [
        ("1", 1), ("4-6", 3), (None, 0), ("Not credit card", 9), (None, None)]


def test_whole_days_and_rounding(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2017-01-02 10:00:00' AS a, TIMESTAMP_NTZ '2017-01-02 09:00:00' AS b, "
                   "2.675D AS x, 0.125D AS y, 0.375D AS z")
    row = df.select(whole_days_elapsed(df.a, df.b), *[round_half_even(c, 2) for c in (df.x, df.y, df.z)]).first()
    assert tuple(row) == (-1, 2.68, 0.12, 0.38)


def test_gate_refuses_orphans(spark, tables, tmp_path):
    with pytest.raises(IntegrityError, match="orphans"):
        assert_star(Star(tables), tables)
    with pytest.raises(AssertionError, match="1 orphans"):
        write_star(spark, tables, str(tmp_path / "star"))
    with pytest.raises(FileNotFoundError, match="no published star"):
        open_star(spark, str(tmp_path / "star"))
    failed = {r["check"] for r in check_star(Star(tables), tables).collect() if r.result == "FAIL"}
    assert failed == {"fact_orders.customer_unique_id -> dim_customer.customer_unique_id (no orphans)",
                      "fact_order_items.customer_unique_id -> dim_customer.customer_unique_id (no orphans)"}


def test_published_star_equals_the_lazy_one(spark, sound_tables, tmp_path):
    out = run_batch(spark, sound_tables, str(tmp_path))
    lazy, stored = Star(sound_tables), open_star(spark, str(tmp_path / "star"))
    assert {r.result for r in spark.read.parquet(f"{stored.folder}/integrity").collect()} == {"PASS"}
    assert isinstance(stored, StoredStar)
    for name, columns in STAR_COLUMNS.items():
        assert stored.table(name).columns == columns == out[name].columns
        assert sorted(map(str, stored.table(name).collect())) == sorted(map(str, lazy.table(name).collect()))
    assert out["cleaning_log"].count() == 20
    names = [m for m in MEASURES if m not in ("revenue_pm", "revenue_mom_pct", "orders_pm", "orders_mom_pct",
                                              "revenue_py", "revenue_yoy_pct")]
    for group in ([], ["dim_date.year_month"], ["dim_customer.state"]):
        a, b = (sorted(map(str, evaluate(s, names, group).collect())) for s in (lazy, stored))
        assert a == b


def test_measures_on_known_data(sound_tables):
    row = evaluate(Star(sound_tables), ["revenue", "orders", "aov", "items_sold", "customers", "repeat_customers",
                                        "delivered_orders", "late_orders", "on_time_pct", "avg_delivery_days",
                                        "seller_orders", "payment_share"]).first()
    assert (row.revenue, row.orders, row.items_sold) == (250.0, 3, 4)
    assert (row.customers, row.repeat_customers) == (2, 1) and row.aov == pytest.approx(250 / 3)
    assert (row.delivered_orders, row.late_orders, row.on_time_pct, row.avg_delivery_days) == (1, 0, 1.0, 4.0)
    assert (row.seller_orders, row.payment_share) == (3, 1.0)


def test_measures_reject_what_does_not_filter_them(sound_tables):
    star = Star(sound_tables)
    with pytest.raises(ValueError, match="dim_product.category does not filter fact_orders"):
        evaluate(star, ["delivered_orders"], ["dim_product.category"])
    with pytest.raises(ValueError, match="dim_product.category does not filter fact_orders"):
        evaluate(star, ["revenue", "delivered_orders"], ["dim_customer.state"], [("dim_product.category", "is", "Health Beauty")])
    assert len(MEASURES) == 45


def test_earlier_periods_need_no_month_in_the_context(sound_tables):
    """By state, the dates in context are all days, moved back; months of this data are incomplete, so nothing is compared."""
    rows = evaluate(Star(sound_tables), ["revenue", "revenue_pm", "revenue_mom_pct"], ["dim_customer.state"]).collect()
    assert {r.state: (r.revenue, r.revenue_pm, r.revenue_mom_pct) for r in rows} == {"SP": (50.0, None, None), "RJ": (200.0, None, None)}


def test_totals_equal_each_level_on_its_own(sound_tables):
    """Also for measures that do not add up, and for earlier periods, which are looked up level by level."""
    star, by = Star(sound_tables), ["dim_customer.state", "dim_product.category"]
    for measures, keys in ((["revenue", "orders", "customers", "active_sellers", "seller_risk_flag"], by),
                           (["delivered_orders", "payment_share"], ["fact_orders.main_payment_type", "dim_customer.state"]),
                           (["revenue", "revenue_pm"], ["dim_date.year_month"]), (["orders"], [])):
        names = [k.split(".")[1] for k in keys]
        got = sorted(map(str, evaluate(star, measures, keys, totals=True).collect()))
        want = []
        for level in range(len(keys) + 1):
            for r in evaluate(star, measures, keys[:len(keys) - level]).collect():
                r = {**dict.fromkeys(names), **r.asDict(), "level": level}
                want.append(str(Row(**{c: r[c] for c in [*names, "level", *measures]})))
        assert got == sorted(want), measures


def test_totals_read_the_items_once(sound_tables):
    plan = evaluate(Star(sound_tables), ["revenue", "orders"], ["dim_product.category", "dim_date.year"], totals=True)
    single = evaluate(Star(sound_tables), ["revenue", "orders"], ["dim_product.category", "dim_date.year"])
    text, alone = (df._jdf.queryExecution().executedPlan().toString() for df in (plan, single))
    assert text.count("FileScan") == alone.count("FileScan") and "Generate explode" in text


def test_cleaning_log(tables):
    log = {(r.table, r.action): r.rows_affected for r in cleaning.cleaning_log(tables).collect()}
    assert log[("geolocation", "Drop exact duplicate rows")] == 1
    assert log[("geolocation", "Drop coordinates outside the bounding box")] == 1
    assert log[("order_payments", "Installments = 0 -> 1")] == 1
    assert log[("order_items", "Implausible shipping_limit_date -> NULL")] == 1
    assert log[("order_items", "Flag: freight greater than price")] == 2
    assert log[("customers", "Collapse customer_id -> customer_unique_id")] == 1
    assert log[("customers", "No coordinates available (left NULL)")] == 1
