"""The star schema: two facts at different grains and four shared dimensions.

``Star`` assembles a table from raw tables on demand and adds only the branches its requested columns need.  Catalyst
prunes columns, but it cannot drop a left join whose key it does not know to be unique; the builder does know.
``StoredStar`` has the same interface over tables written earlier.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import specs
from ..functions import band_label, band_order, date_key, installment_band, money_sum, short_label
from ..operators import cleaning
from ..operators.ordered import sequence_per_key
from ..operators.calendar import dim_date

# Output columns, in order.
FACT_ORDERS = """
    order_id customer_unique_id date_key purchase_date order_purchase_timestamp order_status
    is_sale has_items is_delivered is_late is_multi_seller is_repeat_purchase customer_order_seq
    items_count products_count sellers_count items_price freight_total order_value
    payment_total main_payment_type payment_methods max_installments is_installment used_voucher
    installment_bucket installment_bucket_order
    order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date
    approval_hours carrier_lead_days last_mile_days delivery_days promised_days delay_days
    delivery_bucket delivery_bucket_order flag_carrier_before_approval flag_delivered_before_carrier
    has_review review_score review_count has_comment review_response_hours
""".split()
FACT_ORDER_ITEMS = """
    order_id order_item_id product_id seller_id customer_unique_id date_key purchase_date shipping_limit_date
    price freight_value item_total freight_share freight_gt_price order_status is_sale
    is_delivered is_late delivery_days review_score is_multi_seller
""".split()
DIM_CUSTOMER = """
    customer_unique_id zip_code_prefix city state region lat lng geo_source
    first_purchase_date last_purchase_date lifetime_orders lifetime_revenue is_repeat_customer
""".split()
DIM_PRODUCT = """
    product_id category category_pt product_weight_g product_length_cm product_height_cm product_width_cm
    product_volume_cm3 product_photos_qty product_name_length product_description_length
""".split()
DIM_SELLER = "seller_id seller_label zip_code_prefix city state region lat lng geo_source".split()
DIM_DATE = """
    date date_key year quarter year_quarter month_num month_name month_short year_month year_month_num month_start
    iso_week day_of_week_num day_name is_weekend is_complete_month
""".split()
STAR_COLUMNS = {
    "fact_orders": FACT_ORDERS, "fact_order_items": FACT_ORDER_ITEMS, "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT, "dim_seller": DIM_SELLER, "dim_date": DIM_DATE,
}

# Which columns need which branch.  ``only_seller`` is an extra: the seller of an order that has just one.
_DISTINCT = {"products_count", "sellers_count"}
_ITEMS = set("items_count items_price freight_total order_value has_items "
             "is_multi_seller only_seller".split())
_PAYMENTS = set("payment_total main_payment_type payment_methods max_installments is_installment used_voucher "
                "installment_bucket installment_bucket_order".split())
_MAIN_METHOD = {"main_payment_type", "installment_bucket", "installment_bucket_order"}
_REVIEWS = set("has_review review_score has_comment review_response_hours".split())
_SEQUENCE = {"customer_order_seq", "is_repeat_purchase"}
_COORDINATES = {"lat", "lng", "geo_source"}
_LIFETIME = set("first_purchase_date last_purchase_date lifetime_orders lifetime_revenue is_repeat_customer".split())


def _region():
    pairs = [F.lit(x) for pair in specs.STATE_REGION.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("state"))


def items_per_order(items: DataFrame, distinct: bool = False) -> DataFrame:
    """Sums per order, and with ``distinct`` the numbers of products and sellers.

    Two distinct counts would shuffle every row three times over.  Instead the items are dealt by order once, and the first row
    of each product and of each seller of an order is marked there.
    """
    counts: list = []
    if distinct:
        def first(key: str):
            place = F.row_number().over(Window.partitionBy("order_id", key).orderBy("order_item_id"))
            return F.col(key).isNotNull() & (place == 1)
        items = items.repartition("order_id").withColumn("_new_product", first("product_id")).withColumn("_new_seller", first("seller_id"))
        counts = [F.count_if("_new_product").alias("products_count"), F.count_if("_new_seller").alias("sellers_count")]
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items_count"),
        F.bround(money_sum(F.col("price")), 2).cast(specs.MONEY).alias("items_price"),
        F.bround(money_sum(F.col("freight_value")), 2).cast(specs.MONEY).alias("freight_total"),
        # Enough to tell one seller from several without a distinct count.
        F.min("seller_id").alias("_first_seller"),
        F.max("seller_id").alias("_last_seller"),
        F.lit(True).alias("_has"),
        *counts,
    )


class Star:
    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw
        self._numbered: DataFrame | None = None
        self._item_rows: int | None = None
        self._centres: tuple[DataFrame, DataFrame] | None = None
        self._one_at_a_time = Lock()

    def item_rows(self) -> int:
        """How many items there are, counted once."""
        if self._item_rows is None:
            self._item_rows = self.raw["order_items"].count()
        return self._item_rows

    # ------------------------------------------------------------ facts
    def fact_orders(self, *columns: str) -> DataFrame:
        columns = columns or tuple(FACT_ORDERS)
        need, raw = set(columns), self.raw
        if need & _SEQUENCE:
            o = self._with_sequence()
        elif "customer_unique_id" in need:
            o = self._with_person()
        else:
            o = cleaning.clean_orders(raw["orders"])
        if need & (_ITEMS | _DISTINCT):
            o = o.join(items_per_order(raw["order_items"], bool(need & _DISTINCT)), "order_id", "left")
        if need & _PAYMENTS:
            payments = cleaning.clean_payments(raw["order_payments"], "payment_methods" in need, bool(need & _MAIN_METHOD))
            o = o.join(payments, "order_id", "left")
        if need & _REVIEWS:
            o = o.join(cleaning.clean_reviews(raw["order_reviews"], "review_count" in need), "order_id", "left")
        elif "review_count" in need:
            o = o.join(cleaning.review_counts(raw["order_reviews"]), "order_id", "left")
        return o.select(*[self._order_column(c) for c in columns])

    def _raw_with_person(self) -> DataFrame:
        people = self.raw["customers"].select("customer_id", "customer_unique_id")
        return self.raw["orders"].join(people, "customer_id", "left")

    def _with_person(self) -> DataFrame:
        return cleaning.clean_orders(self._raw_with_person())

    def _with_sequence(self) -> DataFrame:
        """Number each person's sales.  Non-sales take part as keyless rows, so one join serves both.

        The orders are put in order once per star, whichever tables ask for the sequence.  They travel as they came; what can
        be told from a row alone is added behind that.
        """
        if self._numbered is None:
            person = F.when(cleaning.is_sale(), F.col("customer_unique_id"))
            self._numbered = sequence_per_key(self._raw_with_person().withColumn("_buyer", person), "_buyer", "order_purchase_timestamp",
                                              "order_id", "customer_order_seq").drop("_buyer")
        return cleaning.clean_orders(self._numbered)

    @staticmethod
    def _order_column(name: str):
        c, zero = F.col, F.lit(0).cast(specs.MONEY)
        multi = F.coalesce(c("_first_seller") != c("_last_seller"), F.lit(False)) if name in {"is_multi_seller", "only_seller"} else None
        computed = {
            "date_key": lambda: date_key(c("purchase_date")),
            "has_items": lambda: F.coalesce(c("_has"), F.lit(False)),
            "items_count": lambda: F.coalesce(c("items_count"), F.lit(0)),
            "products_count": lambda: F.coalesce(c("products_count"), F.lit(0)),
            "sellers_count": lambda: F.coalesce(c("sellers_count"), F.lit(0)),
            "items_price": lambda: F.coalesce(c("items_price"), zero),
            "freight_total": lambda: F.coalesce(c("freight_total"), zero),
            "order_value": lambda: (F.coalesce(c("items_price"), zero)
                                    + F.coalesce(c("freight_total"), zero)).cast(specs.MONEY),
            "is_multi_seller": lambda: multi,
            "only_seller": lambda: F.when(~multi, c("_first_seller")),
            "payment_total": lambda: F.bround(c("payment_total"), 2).cast(specs.MONEY),
            "is_installment": lambda: c("max_installments") > 1,
            "installment_bucket": lambda: installment_band(c("max_installments"), c("main_payment_type"))[0],
            "installment_bucket_order": lambda: installment_band(c("max_installments"), c("main_payment_type"))[1],
            "delivery_bucket": lambda: band_label(c("delay_days"), specs.DELIVERY_BANDS),
            "delivery_bucket_order": lambda: band_order(c("delay_days"), specs.DELIVERY_BANDS),
            "is_repeat_purchase": lambda: c("customer_order_seq") > 1,
            "has_review": lambda: c("review_score").isNotNull(),
            "review_count": lambda: F.coalesce(c("review_count"), F.lit(0)),
        }
        return computed[name]().alias(name) if name in computed else c(name)

    def fact_order_items(self, *columns: str) -> DataFrame:
        columns = columns or tuple(FACT_ORDER_ITEMS)
        need = set(columns)
        items = self.raw["order_items"]
        own = set(items.columns) | {"item_total", "freight_share", "freight_gt_price"}
        context = [c for c in columns if c not in own]
        # The deadline check needs the purchase time: take it from the same join instead of a second one.
        bought = ["order_purchase_timestamp"] if "shipping_limit_date" in need else []
        if context or bought:
            items = items.join(self.fact_orders("order_id", *context, *bought), "order_id", "left")
        # What can be told from an item alone is added behind the join, so it does not travel.
        items = cleaning.clean_items(items)
        if bought:
            gap = cleaning.whole_days_elapsed(F.col("order_purchase_timestamp"), F.col("shipping_limit_date"))
            items = items.withColumn("shipping_limit_date",
                                     F.when(~cleaning.deadline_off(gap), F.col("shipping_limit_date")))
        return items.select(*columns)

    def single_seller_orders(self, *context: str) -> DataFrame:
        """Sale orders with items of exactly one seller: ``seller_id`` and order columns, one row per order.

        The seller of such an order is its smallest (and largest) seller id, so nothing has to be made distinct.
        """
        orders = self.fact_orders("order_id", "only_seller", "is_sale", "is_multi_seller", *context)
        return orders.where(F.col("is_sale") & ~F.col("is_multi_seller") & F.col("only_seller").isNotNull()) \
            .select(F.col("only_seller").alias("seller_id"), "order_id", *context)

    # ------------------------------------------------------------ dimensions
    def _coordinates(self) -> tuple[DataFrame, DataFrame]:
        """Medians per zip and city, taken once per star: customers and sellers are placed by the same ones."""
        with self._one_at_a_time:
            if self._centres is None:
                self._centres = cleaning.clean_geolocation(self.raw["geolocation"])
            return self._centres

    def dim_customer(self, *columns: str) -> DataFrame:
        columns = columns or tuple(DIM_CUSTOMER)
        need, raw = set(columns), self.raw
        if need & _COORDINATES:
            people = cleaning.clean_customers(raw["customers"], raw["orders"], *self._coordinates())
        else:
            people = cleaning.latest_address(raw["customers"], raw["orders"]) \
                .withColumn("customer_city", cleaning.fold_city(F.col("customer_city")))
        people = people.withColumnsRenamed({"customer_zip_code_prefix": "zip_code_prefix", "customer_city": "city",
                                            "customer_state": "state"}).withColumn("region", _region())
        if need & _LIFETIME:
            sales = self.fact_orders("customer_unique_id", "purchase_date", "items_price", "is_sale").where("is_sale")
            stats = sales.groupBy("customer_unique_id").agg(
                F.min("purchase_date").alias("first_purchase_date"),
                F.max("purchase_date").alias("last_purchase_date"),
                F.count("*").alias("_orders"),
                F.sum("items_price").cast(specs.MONEY).alias("_revenue"))
            people = people.join(stats, "customer_unique_id", "left").withColumns({
                "lifetime_orders": F.coalesce("_orders", F.lit(0)),
                "lifetime_revenue": F.coalesce(F.col("_revenue"), F.lit(0).cast(specs.MONEY)),
                "is_repeat_customer": F.coalesce("_orders", F.lit(0)) >= 2,
            })
        return people.select(*columns)

    def dim_product(self, *columns: str) -> DataFrame:
        products = cleaning.clean_products(self.raw["products"], self.raw["category_translation"])
        return products.withColumnRenamed("product_category_name", "category_pt").select(*(columns or DIM_PRODUCT))

    def dim_seller(self, *columns: str) -> DataFrame:
        columns = columns or tuple(DIM_SELLER)
        sellers = self.raw["sellers"]
        if set(columns) & _COORDINATES:
            sellers = cleaning.clean_sellers(sellers, *self._coordinates())
        else:
            sellers = sellers.withColumn("seller_city", cleaning.fold_city(F.col("seller_city")))
        return sellers.withColumnsRenamed({"seller_zip_code_prefix": "zip_code_prefix", "seller_city": "city",
                                           "seller_state": "state"}) \
            .withColumns({"region": _region(), "seller_label": short_label(F.col("seller_id"))}).select(*columns)

    def dim_date(self, *columns: str) -> DataFrame:
        return dim_date(self.raw["orders"]).select(*(columns or DIM_DATE))

    def table(self, name: str, *columns: str) -> DataFrame:
        return getattr(self, name)(*columns)


class StoredStar:
    """A star written earlier by ``write_star``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str, *columns: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}").select(*(columns or STAR_COLUMNS[name]))

    def item_rows(self) -> int:
        return self.table("fact_order_items", "order_id").count()

    def single_seller_orders(self, *context: str) -> DataFrame:
        items = self.table("fact_order_items", "order_id", "seller_id", "is_sale", "is_multi_seller", *context)
        return items.where(F.col("is_sale") & ~F.col("is_multi_seller")).groupBy("order_id").agg(
            F.min("seller_id").alias("seller_id"), *[F.max(c).alias(c) for c in context])

    def __getattr__(self, name: str):
        if name not in STAR_COLUMNS:
            raise AttributeError(name)
        return lambda *columns: self.table(name, *columns)


def build_star(raw: Mapping[str, DataFrame]) -> Star:
    return Star(raw)


def tables_of(star, names: Iterable[str] = STAR_COLUMNS) -> dict[str, DataFrame]:
    return {name: star.table(name) for name in names}
