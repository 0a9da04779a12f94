"""Cleaning treatments.

Rows are dropped only when they are exact copies or impossible coordinates; everything else is corrected or flagged.
Each treatment is a lazy transform; ``cleaning_log`` counts what they touch.
"""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import specs
from ..functions import (elapsed_days, elapsed_seconds, fold_city, round_half_even, title_case,
                         whole_days_elapsed)
from .keys import comparable, row_copies
from .quantiles import exact_median, linear_cell

Tables = Mapping[str, DataFrame]

# About eleven metres: a zip or a city spans many such cells, so a crowded one is split over them.
_COORDINATE_CELL = linear_cell(1e-4)


# ---------------------------------------------------------------- coordinates

def _inside_box() -> Column:
    return F.coalesce(F.col("geolocation_lat").between(*specs.LAT_RANGE)
                      & F.col("geolocation_lng").between(*specs.LNG_RANGE), F.lit(False))


def _centre(points: DataFrame, by: list[str]) -> DataFrame:
    """Median latitude and longitude per group; both axes go through one pass in long form."""
    axes = points.select(*by, F.explode(F.array(
        F.struct(F.lit("lat").alias("axis"), F.col("geolocation_lat").alias("v")),
        F.struct(F.lit("lng").alias("axis"), F.col("geolocation_lng").alias("v")))).alias("p")) \
        .select(*by, "p.axis", "p.v")
    medians = exact_median(axes, "v", "mid", [*by, "axis"], _COORDINATE_CELL)
    return medians.groupBy(*by).agg(*[F.max(F.when(F.col("axis") == a, F.col("mid"))).alias(a) for a in ("lat", "lng")])


def clean_geolocation(geo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one coordinate per zip, one per city and state) from distinct points inside the box."""
    # The box depends on one row only, so it can go first and reach the scan.
    points = geo.where(_inside_box()).distinct()
    zips = _centre(points.withColumnRenamed("geolocation_zip_code_prefix", "zip_code_prefix"), ["zip_code_prefix"])
    cities = _centre(
        points.withColumn("city_norm", fold_city(F.col("geolocation_city")))
        .withColumnRenamed("geolocation_state", "state"), ["city_norm", "state"])
    return zips, cities


def attach_coordinates(df: DataFrame, zip_col: str, city_col: str, state_col: str,
                       zips: DataFrame, cities: DataFrame) -> DataFrame:
    """Coordinates by zip, else by city and state; ``geo_source`` says which, or ``missing``."""
    z = zips.select(F.col("zip_code_prefix").alias("_zip"), F.col("lat").alias("_zlat"), F.col("lng").alias("_zlng"))
    c = cities.select(F.col("city_norm").alias("_city"), F.col("state").alias("_state"),
                      F.col("lat").alias("_clat"), F.col("lng").alias("_clng"))
    by_zip = F.col("_zlat").isNotNull()
    joined = df.join(z, F.col(zip_col) == F.col("_zip"), "left").join(
        c, (fold_city(F.col(city_col)) == F.col("_city")) & (F.col(state_col) == F.col("_state")), "left")
    lat = F.when(by_zip, F.col("_zlat")).otherwise(F.col("_clat"))
    lng = F.when(by_zip, F.col("_zlng")).otherwise(F.col("_clng"))
    source = F.when(by_zip, "zip").when(F.col("_clat").isNotNull(), "city_centroid").otherwise("missing")
    return joined.select(*df.columns, round_half_even(lat, 6).alias("lat"), round_half_even(lng, 6).alias("lng"),
                         source.alias("geo_source"))


# ---------------------------------------------------------------- products

def clean_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    # One English name per category even if the lookup repeats one, so products never multiply.
    lookup = translation.groupBy(F.col("product_category_name").alias("_name")) \
        .agg(F.max("product_category_name_english").alias("_english"))
    fixed = F.create_map(*[F.lit(x) for pair in specs.MANUAL_TRANSLATIONS.items() for x in pair])
    name = F.coalesce(F.col("product_category_name"), F.lit(specs.UNKNOWN))
    english = F.coalesce(F.try_element_at(fixed, name),
                         F.when(name != specs.UNKNOWN, F.col("_english")), F.lit(specs.UNKNOWN))
    volume = F.col("product_length_cm").cast("double") * F.col("product_height_cm") * F.col("product_width_cm")
    return (
        products.withColumnsRenamed({"product_name_lenght": "product_name_length",
                                     "product_description_lenght": "product_description_length"})
        .join(lookup, F.col("product_category_name") == F.col("_name"), "left")
        .withColumns({
            "product_category_name": name,
            "category": title_case(english),
            "product_weight_g": F.when(F.col("product_weight_g") != 0, F.col("product_weight_g")),
            "product_volume_cm3": volume,
        })
        .drop("_name", "_english")
    )


# ---------------------------------------------------------------- payments and reviews, one row per order

def fixed_installments() -> Column:
    n = F.col("payment_installments")
    return F.when(n == 0, F.lit(1)).otherwise(n)


def _largest_first(*columns: Column | str) -> list[Column]:
    """The order in which the row that is largest by these columns comes first; NULL is the smallest value."""
    return [F.desc_nulls_last(c) for c in columns]


def clean_payments(payments: DataFrame, methods: bool = True, main: bool = True) -> DataFrame:
    """Totals per order, with ``main`` the main method, and with ``methods`` the number of methods.

    An order has few payments, so for its methods they are dealt by order once and marked there: aggregates of texts sort
    as well, and take several passes.  The number of methods leaves out rows without an order.
    """
    kind = F.col("payment_type")
    totals = {
        "payment_total": F.sum("payment_value"),
        "payment_rows": F.count("payment_sequential"),
        "max_installments": F.max(fixed_installments()),
        "used_voucher": F.bool_or(kind == "voucher"),
    }
    if methods or main:
        rows, order = payments.repartition("order_id"), Window.partitionBy("order_id")
        if methods:
            first = F.row_number().over(Window.partitionBy("order_id", kind).orderBy("payment_sequential")) == 1
            rows = rows.where(F.col("order_id").isNotNull()).withColumn("_new", kind.isNotNull() & first)
            totals["payment_methods"] = F.count_if("_new")
        # The largest amount names the method; equal amounts go to the earlier row.
        largest = order.orderBy(*_largest_first("payment_value", -F.col("payment_sequential"), kind))
        rows = rows.withColumn("_place", F.row_number().over(largest))
        sums = rows.select("order_id", kind.alias("main_payment_type"), "_place", *[c.over(order).alias(n) for n, c in totals.items()]) \
            .where(F.col("_place") == 1).drop("_place")
    else:
        sums = payments.groupBy("order_id").agg(*[c.alias(n) for n, c in totals.items()])
    return sums.withColumns({"payment_total": F.coalesce("payment_total", F.lit(0).cast(specs.MONEY)),
                             "max_installments": F.col("max_installments").cast("long"),
                             "used_voucher": F.coalesce("used_voucher", F.lit(False))})


def _latest(reviews: DataFrame, count: bool = False) -> DataFrame:
    """The newest of reviews that are dealt by order, and how many there are."""
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    commented = F.col("review_comment_message").isNotNull() | F.col("review_comment_title").isNotNull()
    order = Window.partitionBy("order_id")
    newest = order.orderBy(*_largest_first(created.isNull(), created, answered.isNull(), answered, "review_id", "review_score", commented))
    hours = elapsed_seconds(created, answered).cast("double") / F.lit(3600.0)
    many = [F.when(F.col("order_id").isNotNull(), F.count("*").over(order)).alias("review_count")] if count else []
    placed = reviews.withColumn("_place", F.row_number().over(newest)).select("*", *many).where(F.col("_place") == 1)
    return placed.select("order_id", "review_score", commented.alias("has_comment"), "review_creation_date", "review_answer_timestamp",
                         round_half_even(hours, 1).alias("review_response_hours"), *(["review_count"] if count else []))


def latest_review(reviews: DataFrame) -> DataFrame:
    """The customer's final opinion per order.  A missing time counts as the latest."""
    return _latest(reviews.repartition("order_id"))


def review_counts(reviews: DataFrame) -> DataFrame:
    """Distinct reviews per order; comment texts are compared by digest."""
    columns = comparable(reviews, specs.SPECS["order_reviews"].long_text)
    return reviews.select(*columns).distinct().groupBy("order_id").agg(F.count("*").alias("review_count"))


def clean_reviews(reviews: DataFrame, count: bool = True) -> DataFrame:
    """The final opinion, and with ``count`` the number of distinct reviews, which rows without an order do not have.

    Rows are dealt by order once: copies of a review meet there, and one of them is enough for the opinion too.
    """
    if not count:
        return latest_review(reviews)
    columns = comparable(reviews, specs.SPECS["order_reviews"].long_text)
    return _latest(reviews.select(*columns).repartition("order_id").distinct(), count=True)


# ---------------------------------------------------------------- orders and items

def is_sale() -> Column:
    return F.coalesce(~F.col("order_status").isin(*specs.NON_SALE_STATUSES), F.lit(True))


def clean_orders(orders: DataFrame) -> DataFrame:
    """Sale and delivery flags and durations; row-local, so it costs one projection."""
    status = F.col("order_status")
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    handed, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")

    early_hand = F.coalesce(handed < approved, F.lit(False))
    early_delivery = F.coalesce(delivered < handed, F.lit(False))
    arrived = F.coalesce((status == "delivered") & (delivered >= bought), F.lit(False))
    delay = F.when(arrived, F.datediff(F.to_date(delivered), F.to_date(promised)))
    return orders.withColumns({
        "flag_carrier_before_approval": early_hand,
        "flag_delivered_before_carrier": early_delivery,
        "is_sale": is_sale(),
        "is_delivered": arrived,
        "delivery_days": F.when(arrived, round_half_even(elapsed_days(bought, delivered), 2)),
        "approval_hours": F.when(approved >= bought, round_half_even(elapsed_days(bought, approved) * 24, 2)),
        "carrier_lead_days": F.when(~early_hand, round_half_even(elapsed_days(approved, handed), 2)),
        "last_mile_days": F.when(arrived & ~early_delivery, round_half_even(elapsed_days(handed, delivered), 2)),
        "promised_days": round_half_even(elapsed_days(bought, promised), 2),
        "delay_days": delay,
        "is_late": F.when(arrived, F.coalesce(delay > 0, F.lit(False))),
        "purchase_date": F.to_date(bought),
    })


def deadline_off(days: Column) -> Column:
    return F.coalesce((days < 0) | (days > specs.MAX_SHIPPING_DAYS), F.lit(False))


def clean_items(items: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Item totals and flags.  Shipping deadlines need the order's purchase time, hence the join."""
    price, freight = F.col("price"), F.col("freight_value")
    total = price + freight
    share = F.try_divide(freight.cast("double"), total.cast("double"))
    out = items.withColumns({
        "item_total": total.cast(specs.MONEY),
        "freight_gt_price": F.coalesce(freight > price, F.lit(False)),
        "freight_share": round_half_even(share, 4),
    })
    if orders is None:
        return out
    when = orders.select("order_id", "order_purchase_timestamp")
    gap = whole_days_elapsed(F.col("order_purchase_timestamp"), F.col("shipping_limit_date"))
    return (
        out.join(when, "order_id", "left")
        .withColumn("shipping_limit_date", F.when(~deadline_off(gap), F.col("shipping_limit_date")))
        .drop("order_purchase_timestamp")
    )


# ---------------------------------------------------------------- customers and sellers

def latest_address(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person with the address of the most recent order; an unknown time counts as the latest."""
    when = orders.select("customer_id", "order_purchase_timestamp")
    ts = F.col("order_purchase_timestamp")
    address = F.struct("customer_zip_code_prefix", "customer_city", "customer_state")
    people = customers.join(when, "customer_id", "left").groupBy("customer_unique_id") \
        .agg(F.max_by(address, F.struct(ts.isNull(), ts, F.col("customer_id"))).alias("_a"))
    return people.select("customer_unique_id", "_a.*")


def clean_customers(customers: DataFrame, orders: DataFrame, zips: DataFrame, cities: DataFrame) -> DataFrame:
    people = latest_address(customers, orders).withColumn("customer_city", fold_city(F.col("customer_city")))
    return attach_coordinates(people, "customer_zip_code_prefix", "customer_city", "customer_state", zips, cities)


def clean_sellers(sellers: DataFrame, zips: DataFrame, cities: DataFrame) -> DataFrame:
    named = sellers.withColumn("seller_city", fold_city(F.col("seller_city")))
    return attach_coordinates(named, "seller_zip_code_prefix", "seller_city", "seller_state", zips, cities)


def clean(raw: Tables) -> dict[str, DataFrame]:
    """Every cleaned table, lazily."""
    zips, cities = clean_geolocation(raw["geolocation"])
    return {
        "orders": clean_orders(raw["orders"]),
        "order_items": clean_items(raw["order_items"], raw["orders"]),
        "payments": clean_payments(raw["order_payments"]),
        "reviews": clean_reviews(raw["order_reviews"]),
        "products": clean_products(raw["products"], raw["category_translation"]),
        "customers": clean_customers(raw["customers"], raw["orders"], zips, cities),
        "customer_map": raw["customers"].select("customer_id", "customer_unique_id"),
        "sellers": clean_sellers(raw["sellers"], zips, cities),
    }


# ---------------------------------------------------------------- log

# What the log says about each treatment and why it is done, in order.
LOG_ENTRIES = [
    ("geolocation", "Drop exact duplicate rows", "A copy would only weigh its point twice in the median"),
    ("geolocation", "Drop coordinates outside the bounding box", "No address can lie there"),
    ("geolocation", "Aggregate to 1 row per zip prefix (median lat/lng)",
     "Joins need one place per prefix, and a median ignores stray points"),
    ("orders", "Delivered status without delivery date -> not delivered",
     "Without the date no duration can be taken"),
    ("orders", "Flag: handed to carrier before approval", "That one interval is left NULL; the order stays"),
    ("orders", "Flag: delivered before carrier pickup", "That one interval is left NULL; the order stays in"),
    ("order_items", "Implausible shipping_limit_date -> NULL", "Sellers never get a negative span or more than two months"),
    ("order_items", "Flag: freight greater than price", "Nothing is changed; the mark lets reports pick such items out"),
    ("order_payments", "Installments = 0 -> 1", "Zero parts cannot add up to an amount"),
    ("order_payments", "Keep 'not_defined' payment type", "No money moved, so totals are not touched"),
    ("order_payments", "Aggregate to 1 row per order", "One row per order keeps joins from multiplying amounts"),
    ("order_reviews", "Keep latest review per order",
     "One opinion per order enters the mean, the newest one"),
    ("products", "Missing category -> 'unknown'", "Their sales would drop out of every breakdown otherwise"),
    ("products", "Manual translation of untranslated categories", "The lookup table has no row for them"),
    ("products", "Weight = 0 g -> NULL", "Zero stands for a weight nobody entered"),
    ("customers", "Collapse customer_id -> customer_unique_id",
     "Every order brings a fresh customer_id; people are counted by the other key"),
    ("customers", "Zip without coordinates -> city centroid fallback", "A place in the right city beats no place"),
    ("customers", "No coordinates available (left NULL)", "Only maps lose these rows"),
    ("sellers", "Zip without coordinates -> city centroid fallback", "A place in the right city beats no place"),
    ("sellers", "No coordinates available (left NULL)", "Only maps lose these rows"),
]


def _steps(df: DataFrame, counts: dict[int, Column]) -> DataFrame:
    """One aggregate over ``df``, one output row per step number."""
    one = df.agg(*[F.coalesce(c.cast("long"), F.lit(0)).alias(f"s{i}") for i, c in counts.items()])
    pairs = F.array(*[F.struct(F.lit(i).alias("step"), F.col(f"s{i}").alias("rows_affected")) for i in counts])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def cleaning_log(raw: Tables) -> DataFrame:
    """step, table, action, rows_affected, rationale: one aggregate per table, not one pass per step."""
    cleaned = clean(raw)
    inside = _inside_box()

    copies = row_copies(raw["geolocation"]).withColumn("_in", inside)
    per_zip = copies.groupBy("geolocation_zip_code_prefix").agg(
        F.sum("copies").alias("rows"), F.count("*").alias("distinct_rows"), F.count_if("_in").alias("kept"))
    zip_kept = F.col("kept") > 0
    geo = _steps(per_zip, {
        0: F.sum(F.col("rows") - F.col("distinct_rows")),
        1: F.sum(F.col("distinct_rows") - F.col("kept")),
        2: F.sum("kept") - F.count_if(zip_kept & F.col("geolocation_zip_code_prefix").isNotNull()),
    })
    orders = _steps(cleaned["orders"], {
        3: F.count_if((F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull()),
        4: F.count_if("flag_carrier_before_approval"),
        5: F.count_if("flag_delivered_before_carrier"),
    })
    gap = whole_days_elapsed(F.col("order_purchase_timestamp"), F.col("shipping_limit_date"))
    items = _steps(
        clean_items(raw["order_items"]).join(raw["orders"].select("order_id", "order_purchase_timestamp"),
                                             "order_id", "left"),
        {6: F.count_if(deadline_off(gap)), 7: F.count_if("freight_gt_price")})
    pay = raw["order_payments"].groupBy("order_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("payment_installments") == 0).alias("zero"),
        F.count_if(F.col("payment_type") == "not_defined").alias("undefined"))
    payments = _steps(pay, {8: F.sum("zero"), 9: F.sum("undefined"), 10: F.sum(F.col("n") - 1)})
    reviews = _steps(review_counts(raw["order_reviews"]), {11: F.sum(F.col("review_count") - 1)})
    category = F.col("product_category_name")
    products = _steps(raw["products"], {
        12: F.count_if(category.isNull()),
        13: F.count_if(category.isin(*specs.MANUAL_TRANSLATIONS)),
        14: F.count_if(F.col("product_weight_g") == 0),
    })
    people = raw["customers"].join(raw["orders"].select("customer_id", "order_id"), "customer_id", "left") \
        .groupBy("customer_unique_id").agg(F.count("*").alias("n"))
    collapse = _steps(people, {15: F.sum(F.col("n") - 1)})

    def sources(df: DataFrame, first: int) -> DataFrame:
        return _steps(df, {first: F.count_if(F.col("geo_source") == "city_centroid"),
                           first + 1: F.count_if(F.col("geo_source") == "missing")})

    parts = [geo, orders, items, payments, reviews, products, collapse,
             sources(cleaned["customers"], 16), sources(cleaned["sellers"], 18)]
    counts = reduce(DataFrame.unionByName, parts)
    entries = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(t).alias("table"), F.lit(a).alias("action"),
                                 F.lit(r).alias("rationale")) for i, (t, a, r) in enumerate(LOG_ENTRIES)])
    entry = F.element_at(entries, F.col("step") + 1)
    return counts.select("step", entry["table"].alias("table"), entry["action"].alias("action"), "rows_affected",
                         entry["rationale"].alias("rationale"))
