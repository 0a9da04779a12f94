"""Operators against brute force on skewed data, and results that do not depend on the partitioning."""
from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.operators import keys, quantiles
from martkit.operators.bitmaps import distinct_counts, distinct_sets
from martkit.operators.checks import check_status_vs_dates
from martkit.operators.keys import copied_rows, most_frequent, orphan_counts, row_copies, smallest_overall, smallest_values
from martkit.operators.ordered import in_order, next_in_key, next_per_key, number_in_key, number_in_order, rank_all, sequence_per_key, tile
from martkit.operators.quantiles import exact_quantiles, linear_cell, log_cell
from martkit.plans.registry import all_queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def purchases():
    """(id, key, time): one key owns two thirds of the rows, many within the same minute; some lack key or time."""
    rng = random.Random(7)
    start, rows = dt.datetime(2017, 1, 1), []
    for i in range(900):
        key = rng.choice(["hot", "hot", "hot", "hot", "a", "b", None])
        seconds = rng.choice([rng.randrange(90), rng.randrange(86_400 * 3)])
        rows.append((i, key, None if rng.random() < 0.03 else start + dt.timedelta(seconds=seconds)))
    return rows


def ordered(rows):
    keyed = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2] is None, r[2] or dt.datetime.max, r[0]))
    return [(r, keyed[i + 1] if i + 1 < len(keyed) and keyed[i + 1][1] == r[1] else None) for i, r in enumerate(keyed)]


def test_sequence_and_next_agree_with_brute_force(spark, purchases):
    df = spark.createDataFrame(purchases, "id int, k string, ts timestamp_ntz").repartition(5)
    seq = {r.id: r.n for r in sequence_per_key(df, "k", "ts", "id", "n").collect()}
    nxt = {r.id: r.following for r in next_per_key(df, "k", "ts", "id", "following").collect()}
    assert len(seq) == len(nxt) == len(purchases)
    seen: dict[str, int] = {}
    for row, following in ordered(purchases):
        seen[row[1]] = seen.get(row[1], 0) + 1
        assert seq[row[0]] == seen[row[1]]
        assert nxt[row[0]] == (following[2] if following else None)
    assert all(seq[r[0]] is None and nxt[r[0]] is None for r in purchases if r[1] is None)


@pytest.mark.parametrize("few", [False, True])
def test_millions_of_values_in_one_cell(spark, few):
    """Different values within 0.1 % of each other, and one value with a third of all rows."""
    n = 3_000_000
    df = spark.range(n, numPartitions=8).selectExpr("'a' AS k", "IF(id % 3 = 0, 1000.25D, 1000 + id * 3e-7D) AS v")
    rows = []
    plain = quantiles._narrowed
    quantiles_seen = lambda inner, *rest: rows.append(inner.count()) or plain(inner, *rest)          # noqa: E731
    quantiles._narrowed = quantiles_seen
    try:
        got = exact_quantiles(df, "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, ["k"], few_groups=few).first()
    finally:
        quantiles._narrowed = plain
    i = np.arange(n)
    want = np.quantile(np.where(i % 3 == 0, 1000.25, 1000 + i * 3e-7), [0.1, 0.5, 0.99])
    assert np.allclose([got.p10, got.p50, got.p99], want, rtol=0, atol=1e-12) and got.n == n
    assert rows and rows[0] > quantiles.OPENED


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("cell", [log_cell, linear_cell(0.5), linear_cell(1e6)])
def test_quantiles_agree_with_numpy(spark, cell, few):
    rng = np.random.default_rng(3)
    data = {"hot": np.concatenate([np.full(500, 5.0), rng.normal(0, 100, 501)]), "one": np.array([7.5]),
            "few": np.array([-3.0, 0.0, 0.0, 12.25])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(df, "v", probs, ["k"], cell, few_groups=few).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert [got[k][p] for p in probs] == pytest.approx(list(np.quantile(vs, list(probs.values()))), abs=1e-12)
        assert got[k].n == len(vs) and got[k].max == vs.max()
    whole = exact_quantiles(df, "v", {"m": 0.5}, cell=cell, few_groups=few).first()
    assert whole.m == pytest.approx(np.median(np.concatenate(list(data.values()))))
    assert exact_quantiles(df.where("k = 'none'"), "v", {"m": 0.5}, few_groups=few).count() == 0


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_global_rank_running_total_and_tiles(spark, levels):
    rng = random.Random(5)
    rows = [(i, rng.choice([10, 10, 10, 200, 31])) for i in range(203)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(6)
    cells = {"_v": F.floor(F.col("v") / 100), "_w": F.col("v"), "_i": F.floor(F.col("id") / 10)}
    got = rank_all(df, [F.desc("v"), F.asc("id")], dict(list(cells.items())[:levels]),
                   [F.desc("_v"), F.desc("_w"), F.asc("_i")][:levels], running={"upto": "v"})
    got = {r.id: r for r in got.withColumn("q", tile(F.col("position"), F.col("n_rows"), 4)).collect()}
    total, sizes = 0, [51, 51, 51, 50]
    quartile = [q for q, n in enumerate(sizes, 1) for _ in range(n)]
    for i, (key, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        total += v
        assert (got[key].position, got[key].upto, got[key].q) == (i + 1, total, quartile[i])
        assert got[key].n_rows == len(rows) and got[key].total_upto == sum(v for _, v in rows)


def test_fewer_rows_than_tiles(spark):
    df = spark.range(1, 4).select(tile(F.col("id"), F.lit(3), 4).alias("q"))
    assert sorted(r.q for r in df.collect()) == [1, 2, 3]


def test_copies_orphans_and_samples(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), (None, 1, "z"), (None, 1, "z"), ("b", 2, None), ("b", 2, None)]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    for copies in (row_copies(df), copied_rows(df, ["k", "n"]), copied_rows(df, ["k", "n"], ["t"])):
        assert copies.agg(F.sum(F.col("copies") - 1)).first()[0] == 3
    parent = spark.createDataFrame([("b",), ("b",)], "p string")
    assert [tuple(r) for r in orphan_counts(df, "k", parent, "p").collect()] == [("a", 3)]
    assert {tuple(r) for r in orphan_counts(df, "k", parent, "p", keep_null=True).collect()} == {("a", 3), (None, 2)}
    many = spark.range(100).select(F.lit("g").alias("g"), "id")
    assert smallest_values(many.withColumn("g", F.col("id") % 2), "g", "id", 3).where("g = 1").first().smallest \
        == [1, 3, 5]
    assert smallest_overall(many, "id", 3).first().smallest == [0, 1, 2]
    assert smallest_overall(many.where("id < 0"), "id", 3).first().smallest == []


@pytest.mark.parametrize("name,operator", [
    ("chk_foreign_keys", "TakeOrderedAndProject"), ("chk_allowed_values", "WindowGroupLimit"),
    ("ord_sample_values", "WindowGroupLimit"), ("ord_top_k", "TakeOrderedAndProject")])
def test_samples_are_limited_before_the_shuffle(spark, name, operator):
    plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert operator in plan


@pytest.mark.parametrize("name,columns", [
    ("q06_delay_vs_review", {"l_extendedprice", "l_tax", "l_discount"}), ("q09_seller_concentration", {"l_discount"})])
def test_scans_read_only_needed_columns(spark, name, columns):
    plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and not any(c in line for c in columns for line in scans)


@pytest.mark.parametrize("name", ["q03_revenue_by_state", "q08_seller_risk", "fact_orders", "msr_customers"])
def test_results_do_not_depend_on_partitioning(spark, name):
    seen = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, broadcast in (("1", "10MB"), ("7", "-1")):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
            seen.add(tuple(sorted(map(str, all_queries()[name](spark, SMALL).collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert len(seen) == 1


@pytest.mark.parametrize("key,ts", [
    ("CASE WHEN id % 2 = 0 THEN NULL ELSE id % 1000 END", "TIMESTAMP_NTZ '2020-01-01' + make_interval(0, 0, 0, id % 300, 0, 0, id % 60)"),
    ("0", "TIMESTAMP_NTZ '2020-01-01 10:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 60)"), ("0", "TIMESTAMP_NTZ '2020-01-01 10:00:00'"),
    ("0", "CAST(NULL AS TIMESTAMP_NTZ)")])
def test_no_task_orders_much_more_than_the_others(spark, key, ts):
    """Half the rows without a key; one key in one minute, at one moment, or without times."""
    n = 200_000
    df = spark.range(n).selectExpr("id", f"{key} AS k", f"{ts} AS ts")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for run in (sequence_per_key, next_per_key):
            held = [r["count"] for r in run(df, "k", "ts", "id", "n").groupBy(F.spark_partition_id()).count().collect()]
            assert sum(held) == n and max(held) <= 4 * n / 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("descending", [True, False])
def test_rank_all_keeps_rows_without_a_value_or_id(spark, descending):
    rows = [(None if i % 5 == 0 else i % 7, None if i % 11 == 0 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "v long, id long")
    v = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    got = rank_all(df, [v, F.col("id").asc_nulls_last()], {"_v": F.col("v"), "_h": F.floor(F.col("id") / 10)},
                   [F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_first(), F.col("_h").asc_nulls_last()]).collect()
    order = sorted(rows, key=lambda r: ((r[0] is None, -(r[0] or 0)) if descending else (r[0] is not None, r[0] or 0), r[1] is None, r[1] or 0))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.position)] == order
    assert {r.n_rows for r in got} == {100} and [r.position for r in sorted(got, key=lambda r: r.position)] == list(range(1, 101))


def test_one_hot_order_customer_and_seller(spark):
    """Half of all items belong to one order of one seller, and one customer places a third of the orders."""
    from martkit.plans.catalogue import revenue_by_state, seller_concentration
    from martkit.plans.star import Star
    from martkit.sources.carriers import raw_tables

    raw = dict(raw_tables(spark, SMALL))
    items = raw["order_items"]
    hot = items.limit(1).crossJoin(spark.range(items.count())).drop("id")
    raw["order_items"] = items.unionByName(hot)
    third = F.col("customer_id").between(0, 499)
    raw["customers"] = raw["customers"].withColumn("customer_unique_id",
                                                   F.when(third, F.lit(0)).otherwise(F.col("customer_unique_id")))
    star = Star(raw)
    facts = star.fact_orders("order_id", "customer_unique_id", "is_sale", "has_items", "items_price").collect()
    sales = [f for f in facts if f.is_sale and f.has_items]
    states = revenue_by_state(star).collect()
    assert sum(s.orders for s in states) == len(sales)
    assert sum(s.customers for s in states) == len({f.customer_unique_id for f in sales})
    revenue: dict[int, float] = {}
    for r in star.fact_order_items("seller_id", "price", "is_sale").where("is_sale").collect():
        revenue[r.seller_id] = revenue.get(r.seller_id, 0) + r.price
    upto, total, half = 0, sum(revenue.values()), None
    for i, v in enumerate(sorted(revenue.values(), reverse=True), 1):
        upto += v
        half = half or (i if upto * 2 >= total else None)
    assert seller_concentration(star).first().sellers_for_50pct_revenue == half


def test_very_many_statuses_give_a_short_list(spark):
    n = 200_000
    orders = spark.range(n).selectExpr("IF(id % 4 = 0, 'common', concat('s', id)) AS order_status", "timestamp_ntz '2020-01-01' AS order_delivered_customer_date")
    late = {r["check"]: r for r in check_status_vs_dates({"orders": orders}).collect()}
    row = late["Delivery date present but status is not 'delivered'"]
    assert row.n_affected == n and row.detail.startswith("By status: common=50000, s1=1, ") and len(row.detail) < 500
    assert row.detail.endswith(f", {n * 3 // 4 - 19} more={n * 3 // 4 - 19}")


def test_most_frequent_values(spark):
    df = spark.createDataFrame([("g", v, n) for v, n in (("b", 3), ("a", 3), (None, 9), ("c", 1))] + [("h", "x", 5)], "g string, v string, n long")
    got = {r.g: ([(x.value, x.n) for x in r.listed], r.others, r.rest) for r in most_frequent(df, "g", "v", "n", 2).collect()}
    assert got == {"g": ([(None, 9), ("a", 3)], 2, 4), "h": ([("x", 5)], 0, 0)}


@pytest.mark.parametrize("partitions", [1, 7])
def test_places_in_ranges(spark, partitions):
    """Keys that straddle ranges, a key in all of them, NULL keys and equal rows."""
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(partitions)
    table = in_order(df, [F.col(c).asc_nulls_first() for c in ("k", "v", "id")])
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert [tuple(r)[:3] for r in table.orderBy("_at").collect()] == want
    assert {r.id: r.place for r in number_in_order(table, "place").collect()} == {r[2]: i for i, r in enumerate(want)}
    seen, place = {}, {}
    for k, _, i in want:
        place[i] = seen[k] = seen.get(k, -1) + 1
    assert {r.id: r.place for r in number_in_key(table, ["k"], "place").collect()} == place
    following = {a[2]: b[2] if a[0] == b[0] else None for a, b in zip(want, [*want[1:], ("none", 0, 0)])}
    assert {r.id: r.following for r in next_in_key(table, ["k"], "id", "following").collect()} == following


def test_sequence_takes_two_exchanges_of_rows(spark):
    """The rows are dealt by range once (and written), then by range and key; only edges, which are broadcast, move besides."""
    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "timestamp_ntz '2020-01-01' AS ts")
    plan = sequence_per_key(df, "k", "ts", "id", "n")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    over_rows = [x for x in plan.splitlines() if "Window [row_number()" in x]
    assert len(over_rows) == 1 and "Exchange hashpartitioning(_task" in plan


def test_distinct_sets_roll_up(spark):
    """Equal to plain distinct counts in every context; a group with half the keys, NULL keys and groups, several bitmaps."""
    n = 120_000
    df = spark.range(n).selectExpr("IF(id % 2 = 0, 'hot', concat('g', id % 5)) AS g", "IF(id % 11 = 0, NULL, id % 3) AS h",
                                   "IF(id % 7 = 0, NULL, concat('k', id % 70001)) AS k")
    sets = distinct_sets(df, "k", ["g", "h"])
    assert sets.agg(F.max("bucket") - F.min("bucket")).first()[0] >= 1
    for by in (["g", "h"], ["g"], ["h"], []):
        want = {tuple(r) for r in df.groupBy(*by).agg(F.countDistinct("k")).collect()}
        assert {tuple(r) for r in distinct_counts(sets, by, "n").collect()} == want, by


@pytest.mark.parametrize("name", ["q02_top_categories", "rpt_category_matrix", "rpt_category_matrix_totals", "msr_sales_by_category", "msr_totals_by_region"])
def test_items_are_grouped_behind_the_shuffle(spark, monkeypatch, name):
    # A task ahead of it has as many rows as its file, so a group per order must not be made there.
    want = sorted(map(tuple, all_queries()[name](spark, SMALL).collect()), key=str)
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 700)
    df = all_queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and ", 9), REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, df.collect()), key=str) == want


def test_a_task_has_as_many_rows_whatever_the_table(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 100)
    for n in (1000, 4000):
        held = keys.in_parts(spark.range(n).withColumnRenamed("id", "k"), n, "k").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in held) == n and max(r["count"] for r in held) < 400
    assert keys.in_parts(spark.range(0), 0, "id").count() == 0


def test_distinct_sets_travel_as_rows(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id % 7 AS g", "IF(id % 11 = 0, NULL, id % 500) AS k")
    want = {(r.g, r.n) for r in rows.groupBy("g").agg(F.countDistinct("k").alias("n")).collect()}
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 200)
    assert {(r.g, r.n) for r in distinct_counts(distinct_sets(rows, "k", ["g"], 3000), ["g"], "n").collect()} == want
    assert {(r.g, r.n) for r in distinct_counts(distinct_sets(rows, "k", ["g"]), ["g"], "n").collect()} == want


def test_order_facts_shuffle_each_source_once(spark):
    """Orders, items, payments and reviews are dealt by order; counting different ones shuffles nothing again."""
    from martkit.plans.star import Star
    from martkit.sources.carriers import raw_tables

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        facts = Star(raw_tables(spark, SMALL)).fact_orders(
            "order_id", "items_price", "products_count", "sellers_count", "payment_total", "payment_methods", "main_payment_type", "review_score", "review_count")
        plan = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 4
    assert "Expand" not in plan and "SortAggregate" not in plan


def test_different_products_sellers_and_methods_per_order(spark):
    """Missing and repeated keys, equal rows, and one order with most of the rows, against brute force."""
    from martkit.operators.cleaning import clean_payments
    from martkit.plans.star import items_per_order

    rng = random.Random(11)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([1, 2, None]), rng.choice([*range(9), None]), rng.choice([7, 8, None])) for _ in range(600)]
    items = spark.createDataFrame(rows, "order_id string, order_item_id int, product_id long, seller_id long") \
        .selectExpr("*", "CAST(1.25 AS DECIMAL(18,4)) AS price", "CAST(NULL AS DECIMAL(18,4)) AS freight_value")
    got = {r.order_id: r for r in items_per_order(items, True).collect()}
    pay = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_value long, method long") \
        .selectExpr("order_id", "payment_sequential", "CAST(method AS STRING) AS payment_type", "2 AS payment_installments", "CAST(payment_value AS DECIMAL(18,4)) AS payment_value")
    paid = {r.order_id: r for r in clean_payments(pay).collect()}
    assert set(got) == {"hot", "a", "b", None} and set(paid) == {"hot", "a", "b"}
    for order, r in got.items():
        mine = [x for x in rows if x[0] == order]
        assert r.items_count == sum(x[1] is not None for x in mine) and float(r.items_price) == 1.25 * len(mine) and r.freight_total == 0
        assert (r.products_count, r.sellers_count) == tuple(len({x[i] for x in mine} - {None}) for i in (2, 3))
        if order:
            p, values = paid[order], [x[2] for x in mine if x[2] is not None]
            first = max(mine, key=lambda x: (x[2] is not None, x[2] or 0, x[1] is not None, -(x[1] or 0), x[3] is not None, x[3] or 0))
            assert (p.payment_methods, int(p.payment_total), p.payment_rows) == (len({x[3] for x in mine} - {None}), sum(values), r.items_count)
            assert p.main_payment_type == (None if first[3] is None else str(first[3]))
