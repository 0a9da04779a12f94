"""The single operators, each over whole test tables."""
from __future__ import annotations

import uuid
import warnings
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import (band_label, band_order, close_to, date_key, elapsed_days, exact_avg, fold_city,
                         installment_band, money_avg, round_half_even, short_label, sql_round, strip_space, title_case,
                         whole_days_elapsed, zero_pad)
from ..operators.bitmaps import distinct_counts, distinct_sets
from ..operators.checks import run_checks, with_position
from ..operators.cleaning import cleaning_log
from ..operators.keys import key_counts, orphan_counts, smallest_values
from ..operators.ordered import next_per_key, rank_all, sequence_per_key, tile
from ..operators.quantiles import exact_quantiles
from ..session import scratch_folder
from ..sources import csv_tables
from ..sources.carriers import driver_table, raw_tables
from ..sources.split_csv import read_split_csv
from ..specs import DELIVERY_BANDS, MONEY, REGIONS, SPECS, TableSpec
from .batch import open_star, read_report, write_report, write_star
from .catalogue import id_cell
from .integrity import IntegrityError
from .star import Star


def _money(c: str):
    return F.col(c).cast("decimal(12,2)").cast(MONEY)


# ---------------------------------------------------------------- aggregates

def agg_hash_group(spark: SparkSession, folder: str) -> DataFrame:
    """Sum, count, min, max, distinct count and boolean any per group."""
    return driver_table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(_money("l_extendedprice")).alias("total"), F.min("l_shipdate").alias("first"),
        F.max("l_shipdate").alias("last"), F.countDistinct("l_suppkey").alias("suppliers"),
        F.bool_or(F.col("l_quantity") == 50).alias("any_full"))


def agg_distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber").distinct()


def agg_conditional(spark: SparkSession, folder: str) -> DataFrame:
    """Filtered aggregates, a rate as the mean of a 0/1 case, a conditional minimum."""
    o = driver_table(spark, folder, "orders")
    done = F.col("o_orderstatus") == "F"
    return o.groupBy("o_orderpriority").agg(
        F.count_if(done).alias("done"), F.sum(F.when(done, _money("o_totalprice"))).alias("done_total"),
        F.avg(F.when(done, F.lit(1.0)).otherwise(F.lit(0.0))).alias("done_rate"),
        F.min(F.when(done, F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")))).alias("first_day"))


def agg_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact interpolated quantiles of a large column, per group, without one buffer per group."""
    q = exact_quantiles(driver_table(spark, folder, "lineitem"), "l_extendedprice",
                        {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99}, ["l_returnflag"])
    return q.select("l_returnflag", "n", "max", *[round_half_even(F.col(c), 4).alias(c)
                                                  for c in ("q25", "q50", "q75", "q99")])


def agg_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), "event_type")


def agg_two_level(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer, then overall: repeat buyers, ratio of sums, share of the repeaters."""
    per = driver_table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum(_money("o_totalprice")).alias("total"))
    again = F.col("n") >= 10
    return per.agg(
        F.count("*").alias("customers"), F.count_if(again).alias("frequent"),
        F.try_divide(F.sum("total").cast("double"), F.sum("n").cast("double")).alias("ticket"),
        F.try_divide(F.sum(F.when(again, F.col("total"))).cast("double"), F.sum("total").cast("double"))
        .alias("frequent_share"))


def agg_rows_joined_back(spark: SparkSession, folder: str) -> DataFrame:
    """Group size put back on every row; the size comes from a counted key, not a window."""
    orders = driver_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return orders.join(key_counts(orders, ["o_custkey"], "orders_of_customer"), "o_custkey")


def agg_distinct_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by several contexts, all from one stored aggregate: items by category, year of purchase and region."""
    star = Star(raw_tables(spark, folder))
    items = star.fact_order_items("product_id", "customer_unique_id", "purchase_date", "is_sale").where("is_sale")
    rows = items.join(star.dim_product("product_id", "category"), "product_id", "left") \
        .join(star.dim_customer("customer_unique_id", "region"), "customer_unique_id", "left").withColumn("year", F.year("purchase_date"))
    keys = ["category", "year", "region"]
    sets = distinct_sets(rows, "customer_unique_id", keys, star.item_rows())
    contexts = (keys, ["category"], ["year"], ["region"], ["year", "region"], [])
    return reduce(DataFrame.unionByName, [
        distinct_counts(sets, by, "customers").select(
            F.lit("+".join(by)).alias("context"), *[(F.col(k) if k in by else F.lit(None)).cast("string").alias(k) for k in keys], "customers")
        for by in contexts])


# ---------------------------------------------------------------- windows

def win_lag_running_moving(spark: SparkSession, folder: str) -> DataFrame:
    """Change, running sum and three-row mean over months; the windows see one row per month."""
    month = F.trunc(F.to_date("o_orderdate"), "month")
    m = driver_table(spark, folder, "orders").groupBy(month.alias("month")).agg(
        F.sum(_money("o_totalprice")).alias("total"))
    line = Window.orderBy("month")
    recent = line.rowsBetween(-2, 0)
    return m.select("month", "total", F.lag("total").over(line).alias("previous"),
                    F.sum("total").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
                    (F.sum("total").over(recent).cast("double") / F.count("*").over(recent)).alias("moving"))


def win_rank_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Rank and dense rank of parts sizes by how many parts share them; one row per size."""
    sizes = driver_table(spark, folder, "part").groupBy("p_size").agg(F.count("*").alias("n"))
    line = Window.orderBy(F.desc("n"))
    return sizes.select("p_size", "n", F.rank().over(line).cast("long").alias("rank"),
                        F.dense_rank().over(line).cast("long").alias("dense_rank"))


def win_row_number_ntile(spark: SparkSession, folder: str) -> DataFrame:
    """Global positions, quartiles, running total and share over all customers, cut into cells of the order."""
    c = driver_table(spark, folder, "customer").select("c_custkey", _money("c_acctbal").alias("balance"))
    cells = {"_whole": F.floor("balance"), "_balance": F.col("balance"), "_head": id_cell(c, "c_custkey")}
    ranked = rank_all(c, [F.desc("balance"), F.asc("c_custkey")], cells,
                      [F.desc("_whole"), F.desc("_balance"), F.asc("_head")], position="row_number",
                      running={"running": "balance"})
    return ranked.select("c_custkey", "balance", "row_number", "running", "n_rows",
                         F.try_divide(F.col("balance").cast("double"), F.col("total_running").cast("double"))
                         .alias("share"),
                         tile(F.col("row_number"), F.col("n_rows"), 4).alias("quartile"))


def win_lead_next(spark: SparkSession, folder: str) -> DataFrame:
    o = driver_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return next_per_key(o, "o_custkey", "o_orderdate", "o_orderkey", "next_order")


def win_sequence_per_key(spark: SparkSession, folder: str) -> DataFrame:
    e = driver_table(spark, folder, "events").select("event_id", "user_id", "ts")
    return sequence_per_key(e, "user_id", "ts", "event_id", "seq").select("event_id", "user_id", "seq")


def win_first_last_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """First and last row per key as aggregates, which combine before the shuffle."""
    when = F.struct("ts", "event_id")
    return driver_table(spark, folder, "events").groupBy("user_id").agg(
        F.min_by("event_type", when).alias("first_type"), F.max_by("event_type", when).alias("last_type"),
        F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("largest_event"))


# ---------------------------------------------------------------- joins

def join_left_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Left joins through two lookups with a default for what is not found."""
    c = driver_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = driver_table(spark, folder, "nation")
    r = driver_table(spark, folder, "region").where("r_name <> 'AFRICA'")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left") \
        .select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"),
                F.coalesce("r_name", F.lit("unknown")).alias("region"))


def join_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Anti-join of counted keys: line suppliers that are not among the solvent suppliers."""
    solvent = driver_table(spark, folder, "supplier").where("s_acctbal > 0")
    lines = driver_table(spark, folder, "lineitem")
    return orphan_counts(lines, "l_suppkey", solvent, "s_suppkey")


def join_coverage_null_safe(spark: SparkSession, folder: str) -> DataFrame:
    """Parents without a child where a NULL key matches a NULL key: status P is read as no key on both sides."""
    key = F.nullif("o_orderstatus", F.lit("P"))
    parents = driver_table(spark, folder, "orders").select("o_orderkey", "o_custkey", key.alias("k"))
    children = driver_table(spark, folder, "orders").where("o_totalprice > 300000") \
        .select(F.col("o_custkey").alias("c"), key.alias("ck")).distinct()
    return parents.join(children, (F.col("o_custkey") == F.col("c")) & F.col("k").eqNullSafe(F.col("ck")),
                        "left_anti").select("o_orderkey")


def join_semi_composite(spark: SparkSession, folder: str) -> DataFrame:
    """Membership on two keys."""
    returned = driver_table(spark, folder, "lineitem").where("l_returnflag = 'R'") \
        .select("l_partkey", "l_suppkey").distinct()
    return driver_table(spark, folder, "lineitem").where("l_returnflag = 'A'") \
        .join(returned, ["l_partkey", "l_suppkey"], "left_semi").groupBy("l_suppkey").agg(F.count("*").alias("n"))


def join_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """Two aggregates on the same key; both sides are already partitioned by it."""
    lines = driver_table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(_money("l_extendedprice")).alias("lines"))
    orders = driver_table(spark, folder, "orders").groupBy("o_orderkey").agg(F.sum(_money("o_totalprice")).alias("paid"))
    return lines.join(orders, "o_orderkey").select("o_orderkey", F.abs(F.col("paid") - F.col("lines")).alias("gap"),
                                                   close_to(F.col("paid"), F.col("lines")).alias("equal"))


def join_cross_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Groups against the overall mean: a cross join with one aggregate row."""
    o = driver_table(spark, folder, "orders")
    per = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(_money("o_totalprice")).alias("total"))
    base = per.agg(F.try_divide(F.sum("total").cast("double"), F.sum("n").cast("double")).alias("base"))
    mean = F.try_divide(F.col("total").cast("double"), F.col("n").cast("double"))
    return per.crossJoin(F.broadcast(base)).where((F.col("n") >= 5) & (mean < F.col("base") * 0.9)) \
        .select("o_custkey", "n", mean.alias("mean"), "base")


def join_star(spark: SparkSession, folder: str) -> DataFrame:
    """Fact to dimensions, aggregated per dimension key first."""
    per_part = driver_table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(_money("l_extendedprice")).alias("revenue"), F.count("*").alias("n"))
    part = driver_table(spark, folder, "part").select("p_partkey", "p_type")
    supplier = driver_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return per_part.join(part, F.col("l_partkey") == F.col("p_partkey"), "left") \
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left").groupBy("p_type", "s_nationkey") \
        .agg(F.sum("revenue").alias("revenue"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- sorts and samples

def ord_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "orders").select("o_orderkey", "o_totalprice") \
        .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)


def ord_mixed_directions(spark: SparkSession, folder: str) -> DataFrame:
    """Several keys, mixed directions, NULLs placed explicitly."""
    s = driver_table(spark, folder, "supplier").select(
        "s_suppkey", F.nullif("s_nationkey", F.lit(0)).alias("nation"), "s_acctbal")
    return s.orderBy(F.col("nation").desc_nulls_first(), F.asc("s_acctbal"), "s_suppkey")


def ord_sample_values(spark: SparkSession, folder: str) -> DataFrame:
    """The five smallest order keys per customer as text; each task passes on five rows per customer at most."""
    keys = driver_table(spark, folder, "orders").select("o_custkey", "o_orderkey").distinct()
    return smallest_values(keys, "o_custkey", "o_orderkey", 5).select(
        "o_custkey", F.array_join(F.col("smallest").cast("array<string>"), ", ").alias("sample"))


# ---------------------------------------------------------------- scalar functions

def fn_text(spark: SparkSession, folder: str) -> DataFrame:
    """City folding, trimming, padding and labels over whole texts."""
    text = F.col("text")
    return driver_table(spark, folder, "documents").select(
        "doc_id", F.md5(fold_city(text)).alias("folded"), F.md5(strip_space(text)).alias("stripped"),
        zero_pad(F.col("doc_id").cast("string")).alias("padded"),
        title_case(F.concat_ws("_", "lang", "source")).alias("label"),
        short_label(F.concat("lang", F.lit("-"), "source")).alias("short"))


def fn_time_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Fractional and whole elapsed days, calendar days, day keys between order and shipment."""
    o = driver_table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    lines = driver_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity",
                                                           "l_extendedprice")
    start = F.timestamp_add("MINUTE", F.col("o_totalprice").cast("int") % 1440, F.col("o_orderdate"))
    end = F.timestamp_add("HOUR", F.col("l_quantity").cast("int"), F.col("l_shipdate"))
    both = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({"start": start, "end": end})
    a, b = F.col("start"), F.col("end")
    return both.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", round_half_even(elapsed_days(a, b), 2).alias("days"),
        round_half_even(elapsed_days(a, b) * 24, 1).alias("hours"), whole_days_elapsed(a, b).alias("whole_days"),
        F.datediff(F.to_date(b), F.to_date(a)).alias("calendar_days"), F.to_date(a).alias("day"),
        date_key(F.to_date(a)).alias("day_key"))


def fn_rounding(spark: SparkSession, folder: str) -> DataFrame:
    """Half-even and decimal rounding, safe division, log scale and back."""
    price, tax, q = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_quantity")
    return driver_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        round_half_even(price / q, 2).alias("half_even"), sql_round(price / 4, 2).alias("sql_round"),
        F.try_divide(price, tax).alias("ratio"),
        F.round(F.expm1(F.log1p(price)), 2).alias("there_and_back"),
        (F.abs(price - 50_000) > 1_000).alias("far"))


def fn_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Right-closed bands with label and order, and the band with an override."""
    delay = F.datediff(F.to_date("l_shipdate"), F.lit("1998-06-17").cast("date"))
    method = F.when(F.col("l_returnflag") == "A", "credit_card").when(F.col("l_returnflag") == "N", "boleto")
    number = F.nullif(F.col("l_quantity").cast("int"), F.lit(10))
    label, order = installment_band(number, method)
    return driver_table(spark, folder, "lineitem").groupBy(
        band_label(delay, DELIVERY_BANDS).alias("delivery_bucket"),
        band_order(delay, DELIVERY_BANDS).alias("delivery_bucket_order"), label.alias("installment_bucket"),
        order.alias("installment_bucket_order")).agg(F.count("*").alias("n"))


def fn_averages(spark: SparkSession, folder: str) -> DataFrame:
    """Means that do not depend on the order of the rows."""
    return driver_table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        exact_avg(F.col("l_quantity")).alias("mean_quantity"), exact_avg(F.col("l_discount"), 2).alias("mean_discount"),
        money_avg(_money("l_extendedprice")).alias("mean_price"))


# ---------------------------------------------------------------- files

def io_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders written as CSV and loaded through the typed loader."""
    path = f"{scratch_folder(spark)}/orders-{uuid.uuid4().hex}"
    csv_tables.write_csv(raw_tables(spark, folder)["orders"], path, shrink_dates=False)
    spec = SPECS["orders"]
    return csv_tables.type_table(csv_tables.read_text_table(spark, spec, path), spec)


def io_csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as CSV and read with declared types; what does not fit its type becomes NULL."""
    path = f"{scratch_folder(spark)}/events-{uuid.uuid4().hex}"
    events = driver_table(spark, folder, "events").select(
        "event_id", "value", F.nullif("event_type", F.lit("error")).alias("kind"), F.col("event_type").alias("number"),
        F.col("ts").alias("moment"), "props")
    csv_tables.write_csv(events, path, fractions=True)
    spec = TableSpec("events", "events.csv", T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("value", MONEY), T.StructField("kind", T.StringType()),
        T.StructField("number", T.IntegerType()), T.StructField("moment", T.TimestampNTZType()),
        T.StructField("props", T.StringType())]))
    return csv_tables.type_table(csv_tables.read_text_table(spark, spec, path), spec, fractions=True)


def cl_normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling of whole texts folded to plain lower case."""
    folded = fold_city(F.col("text"))
    return driver_table(spark, folder, "documents").select("doc_id", F.length(folded).alias("length"),
                                                           F.md5(folded).alias("folded"))


def io_parse_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Values that do not fit their declared type, counted in one aggregate: events read as text."""
    text = driver_table(spark, folder, "events").select(
        F.col("value").cast("string").alias("amount"), F.col("event_type").alias("number"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"), F.col("ts").cast("string").alias("instant"))
    spec = TableSpec("events", "events.csv", T.StructType([
        T.StructField("amount", MONEY), T.StructField("number", T.IntegerType()),
        T.StructField("moment", T.TimestampNTZType()), T.StructField("instant", T.TimestampNTZType())]))
    return csv_tables.parse_failures(text, spec)


# ---------------------------------------------------------------- the file layer

def _stored(spark: SparkSession, folder: str) -> tuple[str, dict[str, DataFrame], DataFrame]:
    """The nine raw tables written as CSV, loaded with a typed copy: folder, tables, parse failures."""
    path = f"{scratch_folder(spark)}/raw-{uuid.uuid4().hex}"
    for name, df in raw_tables(spark, folder).items():
        csv_tables.write_csv(df.select(*SPECS[name].columns), f"{path}/{SPECS[name].file}", shrink_dates=False)
    tables, failures = csv_tables.load_all(spark, path, typed_copy=f"{path}/typed")
    return path, tables, failures


def io_load_all(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and filled cells of each raw table after the way through CSV, read back from the typed copy."""
    path, _, _ = _stored(spark, folder)
    tables, _ = csv_tables.load_all(spark, path, typed_copy=f"{path}/typed", reuse=True)
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in df.columns]).select(
            F.lit(name).alias("table"), "rows", reduce(add, [F.col(c) for c in df.columns]).alias("filled"))
        for name, df in tables.items()])


def io_refusals(spark: SparkSession, folder: str) -> DataFrame:
    """What the loader says of missing files and of a missing column; an extra column is kept."""
    path = f"{scratch_folder(spark)}/refused-{uuid.uuid4().hex}"
    raw = raw_tables(spark, folder)
    payments = raw["order_payments"].select(*SPECS["order_payments"].columns)
    said = []
    csv_tables.write_csv(payments.drop("payment_value").withColumn("note", F.lit("x")), f"{path}/short")
    csv_tables.write_csv(payments.withColumn("note", F.lit("x")), f"{path}/long")
    try:
        csv_tables.read_text_table(spark, SPECS["order_payments"], f"{path}/short")
    except csv_tables.SchemaError as e:
        said.append(("column", str(e)))
    try:
        csv_tables.load_all(spark, path)
    except FileNotFoundError as e:
        said.append(("files", str(sum(s.file in str(e) for s in SPECS.values()))))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        kept = csv_tables.read_text_table(spark, SPECS["order_payments"], f"{path}/long")
    counted = kept.agg(F.count("note").cast("string").alias("said")).select(F.lit("extra").alias("what"), "said")
    return spark.createDataFrame(said, "what string, said string").unionByName(counted)


def io_star_views(spark: SparkSession, folder: str) -> DataFrame:
    """The star exported as CSV with shrunk dates, read back typed, and asked in SQL over its views."""
    path = f"{scratch_folder(spark)}/star-{uuid.uuid4().hex}"
    star = Star(raw_tables(spark, folder))
    names = {"fact_order_items": "exported_items", "dim_product": "exported_products", "dim_date": "exported_days"}
    for name in names:
        csv_tables.write_csv(star.table(name), f"{path}/{name}", fractions=True, compression="gzip")
    csv_tables.register_views(spark, {view: csv_tables.read_star_csv(spark, f"{path}/{name}", csv_tables.star_schema(name)) for name, view in names.items()})
    return spark.sql("""
        SELECT d.year, p.category, COUNT(*) AS items, CAST(SUM(i.price) AS DOUBLE) AS revenue
        FROM exported_items i JOIN exported_products p USING (product_id) JOIN exported_days d USING (date_key)
        WHERE i.is_sale GROUP BY d.year, p.category""")


def io_csv_split(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with line breaks and quotes, written as CSV and cut into records by byte ranges."""
    path = f"{scratch_folder(spark)}/texts-{uuid.uuid4().hex}"
    csv_tables.write_csv(driver_table(spark, folder, "documents").select("doc_id", "text", "source"), path)
    text = F.coalesce("text", F.lit(""))
    return read_split_csv(spark, path, ["doc_id", "text", "source"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("length"), F.md5(text).alias("digest"), "source")


def io_whole_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers above 2 ** 53, with a decimal point or without, come through the typed loader as they are."""
    path = f"{scratch_folder(spark)}/numbers-{uuid.uuid4().hex}"
    big = F.col("event_id") + F.lit(9007199254740993)
    csv_tables.write_csv(driver_table(spark, folder, "events").select("event_id", big.alias("big"), F.concat(big.cast("string"), F.lit(".4")).alias("near")), path)
    kind = T.LongType()
    spec = TableSpec("numbers", "numbers.csv", T.StructType([T.StructField(c, kind) for c in ("event_id", "big", "near")]))
    return csv_tables.type_table(csv_tables.read_text_table(spark, spec, path), spec)


def io_check_results(spark: SparkSession, folder: str) -> DataFrame:
    """All check results as the report file holds them, with their place by severity."""
    path = f"{scratch_folder(spark)}/results-{uuid.uuid4().hex}"
    results = with_position(run_checks(raw_tables(spark, folder)))
    write_report(results, path)
    # An empty field of a report is an empty text.
    return read_report(spark, path, results.schema).withColumns({c: F.coalesce(c, F.lit("")) for c in ("detail", "action")})


def io_cleaning_log(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaning log as its file holds it."""
    path = f"{scratch_folder(spark)}/log-{uuid.uuid4().hex}"
    log = cleaning_log(raw_tables(spark, folder))
    write_report(log, path)
    return read_report(spark, path, log.schema)


def io_refused_star(spark: SparkSession, folder: str) -> DataFrame:
    """A star whose orders have lost the customers of one region: what the refusal says, and that nothing is published."""
    path = f"{scratch_folder(spark)}/star-{uuid.uuid4().hex}"
    raw = dict(raw_tables(spark, folder))
    raw["customers"] = raw["customers"].where(~F.col("customer_state").isin(*REGIONS["South"].split()))
    said = []
    try:
        write_star(spark, raw, path)
    except IntegrityError as e:
        said += [("refused", line) for line in str(e).splitlines()[1:]]
    try:
        open_star(spark, path)
    except FileNotFoundError:
        said.append(("published", "nothing"))
    return spark.createDataFrame(said, "what string, said string")


OPERATOR_QUERIES = {f.__name__: f for f in (
    agg_distinct_sets, agg_hash_group, agg_distinct_rows, agg_conditional, agg_quantiles, agg_value_counts, agg_two_level,
    agg_rows_joined_back, win_lag_running_moving, win_rank_dense, win_row_number_ntile, win_lead_next,
    win_sequence_per_key, win_first_last_per_key, join_left_lookup, join_orphans, join_coverage_null_safe,
    join_semi_composite, join_aggregates, join_cross_baseline, join_star, ord_top_k, ord_mixed_directions,
    ord_sample_values, fn_text, fn_time_gaps, fn_rounding, fn_bands, fn_averages, cl_normalize_text,
    io_csv_roundtrip, io_csv_typed, io_parse_failures, io_load_all, io_refusals, io_star_views,
    io_csv_split, io_whole_numbers, io_check_results, io_cleaning_log, io_refused_star)}
