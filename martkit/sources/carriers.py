"""The nine raw tables, derived from the generic order/line/part/supplier test tables.

Defects arise from the values at hand (cheap orders lost their delivery date, urgent pending orders were canceled,
some zips are unknown), so every check and treatment has something to find.  Nothing is cached: each table is a
lazy projection, and Catalyst reads only the columns a query needs.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..specs import STATES

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations")


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _state(nation_key: str) -> str:
    return f"element_at(array({', '.join(repr(s) for s in STATES)}), {nation_key} + 1)"


# The test prices are doubles with two decimals: whole cents first, then exact decimals.
_CENTS = "CAST(rint(o_totalprice * 100) AS BIGINT)"
_PRICE_CENTS = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
_RATE = "(CAST(rint(l_tax * 100) AS BIGINT) + CASE WHEN l_quantity <= 1 THEN 100 ELSE 0 END)"


def _money(ten_thousandths: str) -> str:
    return f"CAST(CAST({ten_thousandths} AS DECIMAL(13,0)) * 0.0001BD AS DECIMAL(18,4))"


_CATEGORY = """CASE WHEN p_name = 'red gear' THEN 'pc_gamer'
                    ELSE concat_ws('_', lower(p_type), element_at(split(p_name, ' '), -1)) END"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "orders").selectExpr(
        "*", f"{_CENTS} AS cents", f"timestampadd(SECOND, {_CENTS} % 86400, o_orderdate) AS bought",
    ).selectExpr(
        "o_orderkey AS order_id",
        "o_orderkey AS customer_id",
        """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'canceled'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'unavailable'
                WHEN o_orderstatus = 'P' THEN 'processing'
                WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'shipped'
                WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'in_transit'
                ELSE 'delivered' END AS order_status""",
        "bought AS order_purchase_timestamp",
        """CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'
                THEN timestampadd(SECOND, cents % 7200 - 60, bought) END AS order_approved_at""",
        """CASE WHEN o_orderstatus <> 'P' THEN timestampadd(SECOND, (cents % 500) * 1000 - 10000, bought) END
               AS order_delivered_carrier_date""",
        """CASE WHEN o_totalprice < 20000 THEN NULL
                WHEN o_totalprice > 495000 THEN timestampadd(DAY, -1, bought)
                WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
                THEN timestampadd(SECOND, cents % 91 * 86400 + cents % 5000, bought) END
               AS order_delivered_customer_date""",
        "timestampadd(DAY, 60, o_orderdate) AS order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS order_item_id", "l_partkey AS product_id",
        "l_suppkey AS seller_id", "l_shipdate AS shipping_limit_date",
        f"{_money(f'{_PRICE_CENTS} * 100')} AS price", f"{_money(f'{_PRICE_CENTS} * {_RATE}')} AS freight_value",
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS payment_sequential",
        """CASE WHEN l_returnflag = 'A' THEN 'credit_card'
                WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'boleto'
                WHEN l_returnflag = 'N' THEN 'voucher'
                WHEN l_linestatus = 'F' THEN 'debit_card'
                WHEN l_tax > 0 THEN 'credit_card' ELSE 'not_defined' END AS payment_type""",
        "CAST(l_quantity AS INT) % 26 AS payment_installments",
        _money(f"{_PRICE_CENTS} * (100 + {_RATE}) + (CAST(rint(l_discount * 100) AS BIGINT) - 5) * 1000")
        + " AS payment_value",
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review for most orders, and a later one for large returned lines (their ids repeat across orders)."""
    first = driver_table(spark, folder, "orders") \
        .where("o_orderstatus <> 'O' OR o_orderpriority <> '4-NOT SPECIFIED'").selectExpr(
            "concat('o', o_orderkey) AS review_id", "o_orderkey AS order_id",
            "CAST(substring(o_orderpriority, 1, 1) AS INT) AS review_score",
            "CAST(NULL AS STRING) AS review_comment_title",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS review_comment_message",
            "timestampadd(DAY, 30, o_orderdate) AS review_creation_date",
            f"timestampadd(SECOND, 30 * 86400 + {_CENTS} % 400000, o_orderdate) AS review_answer_timestamp")
    second = driver_table(spark, folder, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 40").selectExpr(
        "concat('p', l_partkey) AS review_id", "l_orderkey AS order_id",
        "1 + l_linenumber % 5 AS review_score",
        "CASE WHEN l_linestatus = 'F' THEN 'returned' END AS review_comment_title",
        "CAST(NULL AS STRING) AS review_comment_message",
        "l_shipdate AS review_creation_date",
        "timestampadd(HOUR, CAST(l_quantity AS INT), l_shipdate) AS review_answer_timestamp")
    return first.unionByName(second)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order; areas 10 and 11 have no coordinates, and machinery customers live in an unmapped city."""
    o = driver_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = driver_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "o_orderkey AS customer_id", "o_custkey AS customer_unique_id",
        "lpad(CAST(c_nationkey * 1000 + day(o_orderdate) % 12 AS STRING), 5, '0') AS customer_zip_code_prefix",
        "concat('São  ', c_mktsegment, ' ', c_nationkey) AS customer_city",
        f"{_state('c_nationkey')} AS customer_state",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        f"CASE WHEN p_size <> 1 THEN {_CATEGORY} END AS product_category_name",
        "CASE WHEN p_size <> 1 THEN length(p_name) END AS product_name_lenght",
        "CASE WHEN p_size <> 1 THEN p_size * 20 END AS product_description_lenght",
        "CASE WHEN p_size <> 1 THEN p_size % 7 END AS product_photos_qty",
        "CASE WHEN p_size = 2 THEN 0 WHEN p_size <> 3 THEN p_size * 100 END AS product_weight_g",
        "CASE WHEN p_size <> 3 THEN p_size + 10 END AS product_length_cm",
        "CASE WHEN p_size <> 3 THEN p_size + 5 END AS product_height_cm",
        "CASE WHEN p_size <> 3 THEN p_size * 2 END AS product_width_cm",
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    """Promotional categories were never translated."""
    return driver_table(spark, folder, "part").where("p_type <> 'PROMO' AND p_name <> 'red gear'").selectExpr(
        f"{_CATEGORY} AS product_category_name",
        f"concat('all_', {_CATEGORY}) AS product_category_name_english").distinct()


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS seller_id",
        "lpad(CAST(s_nationkey * 1000 + s_suppkey % 12 AS STRING), 5, '0') AS seller_zip_code_prefix",
        "concat('  São Building ', s_nationkey, ' ') AS seller_city",
        f"{_state('s_nationkey')} AS seller_state",
    )


_DESK = "n_regionkey * 10 + CAST(substring(o_orderpriority, 1, 1) AS INT)"


def desk_items(spark: SparkSession, folder: str) -> DataFrame:
    """The items, each order sold by one desk: that of its customer's region and its priority."""
    orders = driver_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    people = driver_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = driver_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    desks = orders.join(people, orders.o_custkey == people.c_custkey).join(nations, people.c_nationkey == nations.n_nationkey) \
        .selectExpr("o_orderkey AS order_id", f"{_DESK} AS seller_id")
    return order_items(spark, folder).drop("seller_id").join(desks, "order_id")


def desk_sellers(spark: SparkSession, folder: str) -> DataFrame:
    priorities = driver_table(spark, folder, "orders").select("o_orderpriority").distinct()
    regions = driver_table(spark, folder, "nation").select("n_regionkey").distinct()
    # Five of each.
    return regions.crossJoin(priorities).selectExpr(
        f"{_DESK} AS seller_id", "lpad(CAST(n_regionkey * 1000 AS STRING), 5, '0') AS seller_zip_code_prefix",
        "concat('  São Building ', n_regionkey, ' ') AS seller_city", f"{_state('n_regionkey')} AS seller_state")


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    """One point per customer on a coarse grid, so points repeat; the ends of the grid lie outside the box."""
    step = "CAST(floor(c_acctbal / 25) AS INT)"
    return driver_table(spark, folder, "customer").selectExpr(
        f"lpad(CAST(c_nationkey * 1000 + pmod({step}, 10) AS STRING), 5, '0') AS geolocation_zip_code_prefix",
        f"{step} / 10.0D - 34.0D AS geolocation_lat",
        f"-28.5D - pmod({step} * 7, 460) / 10.0D AS geolocation_lng",
        """CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Máquinas'
                ELSE concat('SÃO ', c_mktsegment, '   ', c_nationkey) END AS geolocation_city""",
        f"{_state('c_nationkey')} AS geolocation_state",
    )


_BUILDERS = {
    "orders": orders, "order_items": order_items, "order_payments": order_payments, "order_reviews": order_reviews,
    "customers": customers, "products": products, "sellers": sellers, "geolocation": geolocation,
    "category_translation": category_translation,
}


class RawTables(Mapping):
    """The nine raw tables by name; each is opened on first use, so a query touches only the files it reads."""

    def __init__(self, spark: SparkSession, folder: str, builders: Mapping = _BUILDERS):
        self._spark, self._folder, self._builders, self._open = spark, folder, builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._builders[name](self._spark, self._folder)
        return self._open[name]

    def __iter__(self):
        return iter(_BUILDERS)

    def __len__(self) -> int:
        return len(_BUILDERS)


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    return RawTables(spark, folder)


def desk_tables(spark: SparkSession, folder: str) -> RawTables:
    """The same with few sellers of many orders, whose ratings differ: floors of 50 orders have something to keep."""
    return RawTables(spark, folder, {**_BUILDERS, "order_items": desk_items, "sellers": desk_sellers})
