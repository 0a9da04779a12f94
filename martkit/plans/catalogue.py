"""The nine business questions.

Each takes a star and returns one result table.  Facts are aggregated to the key of a dimension before they meet it,
so what a join moves is one row per customer, month or seller, and a customer or seller that owns a third of the
rows arrives as a single partial sum.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import exact_avg, money_avg, sql_round
from ..operators.keys import in_parts
from ..operators.ordered import rank_all, tile
from ..operators.quantiles import exact_median, log_cell

# Labels of the delay bands in the review question (they differ from the star's on purpose).
DELAY_LABELS = ["1. 10+ days early", "2. 1-9 days early", "3. On the promised day", "4. 1-3 days late",
                "5. 4-7 days late", "6. 8+ days late"]
INSTALLMENT_LABELS = ["01 installment", "02-03 installments", "04-06 installments", "07+ installments"]
NO_CARD = "n/a (not credit card)"


def _double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(_double(part) * 100.0, _double(whole))


def _rate(hit: Column) -> Column:
    """Share of rows where ``hit`` holds, from two counts."""
    return F.try_divide(_double(F.count_if(hit)), _double(F.count("*")))


def monthly_trend(star) -> DataFrame:
    """q01: revenue and orders per complete month, change, running total and three-row mean."""
    orders = star.fact_orders("purchase_date", "is_sale", "items_price", "has_items")
    monthly = orders.where("is_sale AND has_items").groupBy(F.trunc("purchase_date", "month").alias("month_start")) \
        .agg(F.count("*").alias("orders"), F.sum("items_price").alias("revenue"))
    complete = star.dim_date("month_start", "is_complete_month").where("is_complete_month") \
        .select("month_start").distinct()
    monthly = monthly.join(complete, "month_start")
    # From here on there is one row per month.
    line = Window.orderBy("month_start")
    running = F.sum("revenue").over(line.rowsBetween(Window.unboundedPreceding, 0))
    recent = line.rowsBetween(-2, 0)
    mean3 = _double(F.sum("revenue").over(recent)) / F.count("*").over(recent)
    growth = (F.try_divide(_double("revenue"), _double(F.lag("revenue").over(line))) - 1.0) * 100.0
    return monthly.select(
        F.date_format("month_start", "yyyy-MM").alias("year_month"),
        "orders",
        sql_round(_double("revenue"), 2).alias("revenue"),
        sql_round(_double("revenue") / F.col("orders"), 2).alias("aov"),
        sql_round(growth, 2).alias("revenue_mom_pct"),
        sql_round(running, 2).alias("revenue_cumulative"),
        sql_round(mean3, 2).alias("revenue_3m_moving_avg"),
    ).orderBy("year_month")


def top_categories(star, k: int = 15) -> DataFrame:
    """q02: categories by revenue with their cumulative share over all categories."""
    items = star.fact_order_items("order_id", "product_id", "price", "freight_share", "is_sale").where("is_sale")
    # Order by category first: the distinct order count becomes a plain count and nothing is expanded.
    joined = items.join(star.dim_product("product_id", "category"), "product_id")
    share = F.rint(F.col("freight_share") * 10_000).cast("long")
    per_order = in_parts(joined, star.item_rows(), "order_id").groupBy("category", "order_id", "_part").agg(
        F.sum("price").alias("revenue"), F.sum(share).alias("share_sum"), F.count("freight_share").alias("share_n"))
    cat = per_order.groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("orders"),
        (F.sum("share_sum").cast("double") / (F.sum("share_n") * 10_000.0)).alias("avg_share"))
    # From here on there is one row per category.
    line = Window.orderBy(F.desc("revenue"), "category")
    total = F.sum("revenue").over(Window.partitionBy())
    running = F.sum("revenue").over(line.rowsBetween(Window.unboundedPreceding, 0))
    return cat.select(
        F.rank().over(Window.orderBy(F.desc("revenue"))).cast("long").alias("rank"),
        "category", "orders",
        sql_round(_double("revenue"), 2).alias("revenue"),
        sql_round(_share(F.col("revenue"), total), 2).alias("revenue_share_pct"),
        sql_round(_share(running, total), 2).alias("cumulative_share_pct"),
        sql_round(F.col("avg_share") * 100.0, 1).alias("avg_freight_share_pct"),
        F.col("revenue").alias("_exact"),
    ).orderBy(F.desc("_exact"), "category").limit(k).drop("_exact")


def revenue_by_state(star) -> DataFrame:
    """q03: revenue and ticket per customer state.

    Orders collapse to one row per customer before the join, which also turns the distinct customer count into a
    plain count.
    """
    sales = star.fact_orders("customer_unique_id", "items_price", "freight_total", "is_sale", "has_items")
    buyers = sales.where("is_sale AND has_items").groupBy("customer_unique_id").agg(
        F.count("*").alias("orders"), F.sum("items_price").alias("revenue"), F.sum("freight_total").alias("freight"))
    states = buyers.join(star.dim_customer("customer_unique_id", "state", "region"), "customer_unique_id") \
        .groupBy("state", "region").agg(
            F.sum("orders").alias("orders"), F.count("*").alias("customers"),
            F.sum("revenue").alias("revenue"), F.sum("freight").alias("freight"))
    total = F.sum("revenue").over(Window.partitionBy())
    return states.select(
        "state", "region", "orders", "customers",
        sql_round(_double("revenue"), 2).alias("revenue"),
        sql_round(_double("revenue") / F.col("orders"), 2).alias("aov"),
        sql_round(_double("freight") / F.col("orders"), 2).alias("avg_freight"),
        sql_round(_share(F.col("revenue"), total), 2).alias("revenue_share_pct"),
    ).orderBy(F.desc("revenue"), "state")


def repeat_customers(star) -> DataFrame:
    """q04: how many customers buy again, and how soon.

    The purchase after a customer's first is the earliest one with a higher sequence number, so two conditional
    minima replace a window over the customer.
    """
    sales = star.fact_orders("customer_unique_id", "order_purchase_timestamp", "items_price", "customer_order_seq",
                             "is_sale", "has_items").where("is_sale AND has_items")
    first, day = F.col("customer_order_seq") == 1, F.to_date("order_purchase_timestamp")
    people = sales.groupBy("customer_unique_id").agg(
        F.count("*").alias("orders"), F.sum("items_price").alias("revenue"),
        F.min(F.when(first, day)).alias("first_day"), F.min(F.when(~first, day)).alias("second_day"),
    ).withColumn("gap", F.datediff("second_day", "first_day"))
    # Everything that remains depends on orders, revenue and gap; the gap has few distinct values.
    by_gap = people.groupBy("gap").agg(
        F.count("*").alias("n"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"),
        F.count_if(F.col("orders") >= 2).alias("again"),
        F.sum(F.when(F.col("orders") >= 2, F.col("revenue"))).alias("again_revenue"),
        F.count_if(F.col("orders") == 1).alias("once"),
        F.sum(F.when(F.col("orders") == 1, F.col("revenue"))).alias("once_revenue"))
    total = by_gap.agg(
        F.sum("n").alias("n"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"),
        F.sum("again").alias("again"), F.sum("again_revenue").alias("again_revenue"),
        F.sum("once").alias("once"), F.sum("once_revenue").alias("once_revenue"),
        F.percentile("gap", F.lit(0.5), F.col("n")).alias("gap"))
    return total.select(
        F.coalesce("n", F.lit(0)).alias("customers"),
        F.coalesce("again", F.lit(0)).alias("repeat_customers"),
        sql_round(_share(F.col("again"), F.col("n")), 2).alias("repeat_customer_pct"),
        sql_round(F.try_divide(_double("revenue"), _double("orders")), 2).alias("aov"),
        sql_round(F.try_divide(_double("once_revenue"), _double("once")), 2).alias("avg_revenue_one_time"),
        sql_round(F.try_divide(_double("again_revenue"), _double("again")), 2).alias("avg_revenue_repeat"),
        sql_round(_share(F.col("again_revenue"), F.col("revenue")), 2).alias("repeat_revenue_share_pct"),
        F.col("gap").alias("median_days_to_2nd_purchase"))


def delivery_by_state(star, min_orders: int = 100) -> DataFrame:
    """q05: delivery time and lateness per state, states below the floor left out."""
    orders = star.fact_orders("customer_unique_id", "delivery_days", "promised_days", "is_late", "review_score",
                              "is_delivered")

    def scaled(c: str) -> Column:
        return F.sum(F.rint(F.col(c) * 100).cast("long")).alias(c)

    people = orders.where("is_delivered").groupBy("customer_unique_id").agg(
        F.count("*").alias("n"), scaled("delivery_days"), F.count("delivery_days").alias("n_delivery"),
        scaled("promised_days"), F.count("promised_days").alias("n_promised"), F.count_if("is_late").alias("late"),
        F.sum("review_score").alias("score"), F.count("review_score").alias("n_score"))
    sums = ["n", "delivery_days", "n_delivery", "promised_days", "n_promised", "late", "score", "n_score"]
    states = people.join(star.dim_customer("customer_unique_id", "state"), "customer_unique_id") \
        .groupBy("state").agg(*[F.sum(c).alias(c) for c in sums]).where(F.col("n") >= min_orders)
    late = F.try_divide(_double("late"), _double("n"))
    return states.select(
        F.dense_rank().over(Window.orderBy(late.desc())).cast("long").alias("late_rank"),
        "state", F.col("n").alias("delivered_orders"),
        sql_round(F.try_divide(_double("delivery_days"), F.col("n_delivery") * 100.0), 1).alias("avg_delivery_days"),
        sql_round(F.try_divide(_double("promised_days"), F.col("n_promised") * 100.0), 1).alias("avg_promised_days"),
        sql_round(late * 100.0, 2).alias("late_pct"),
        sql_round(F.try_divide(_double("score"), _double("n_score")), 2).alias("avg_review"),
    ).orderBy("late_rank", "state")


def delay_vs_review(star) -> DataFrame:
    """q06: review score per delivery delay band."""
    orders = star.fact_orders("delivery_bucket_order", "review_score", "is_delivered", "has_review")
    labels = F.array(*[F.lit(x) for x in DELAY_LABELS])
    # A delivery without a promised date falls into the open last band.
    band = F.element_at(labels, F.coalesce("delivery_bucket_order", F.lit(len(DELAY_LABELS))))
    score = F.col("review_score")
    return orders.where("is_delivered AND has_review").groupBy(band.alias("delivery_bucket")).agg(
        F.count("*").alias("orders"),
        sql_round(exact_avg(score), 2).alias("avg_review"),
        sql_round(_rate(score <= 2) * 100.0, 1).alias("negative_review_pct"),
        sql_round(_rate(score == 5) * 100.0, 1).alias("five_star_pct"),
    ).orderBy("delivery_bucket")


def payments(star) -> DataFrame:
    """q07: payment methods and installment bands, with mean and median ticket."""
    orders = star.fact_orders("main_payment_type", "max_installments", "items_price", "is_sale", "has_items")
    n = F.col("max_installments")
    band = F.when(F.col("main_payment_type") != "credit_card", NO_CARD).when(n == 1, INSTALLMENT_LABELS[0]) \
        .when(n <= 3, INSTALLMENT_LABELS[1]).when(n <= 6, INSTALLMENT_LABELS[2]).otherwise(INSTALLMENT_LABELS[3])
    keys = ["main_payment_type", "installment_bucket"]
    paid = orders.where("is_sale AND has_items AND main_payment_type IS NOT NULL") \
        .select("main_payment_type", band.alias("installment_bucket"), "items_price")
    # One count per distinct ticket carries both the mean and the median.
    groups = paid.groupBy(*keys).agg(F.count("*").alias("orders"), money_avg(F.col("items_price")).alias("mean"))
    medians = exact_median(paid, "items_price", "median", keys, log_cell)
    total = F.sum("orders").over(Window.partitionBy())
    return groups.join(medians, keys).select(
        *keys, "orders",
        sql_round(_share(F.col("orders"), total), 2).alias("order_share_pct"),
        sql_round(F.col("mean"), 2).alias("aov"),
        sql_round(F.col("median"), 2).alias("median_ticket"),
    ).orderBy(*keys)


def seller_risk(star, min_orders: int = 50, gap: float = 0.3) -> DataFrame:
    """q08: sellers with enough orders whose rating lies clearly below the platform's."""
    orders = star.single_seller_orders("review_score", "is_late", "is_delivered")
    score = F.col("review_score")
    stats = orders.groupBy("seller_id").agg(
        F.count("*").alias("orders"), F.sum(score).alias("score"), F.count(score).alias("reviews"),
        F.count_if(score <= 2).alias("negative"), F.count_if("is_delivered").alias("delivered"),
        F.count_if(F.col("is_delivered") & F.col("is_late")).alias("late"))
    platform = stats.agg(F.try_divide(_double(F.sum("score")), _double(F.sum("reviews"))).alias("platform"))
    mean = F.try_divide(_double("score"), _double("reviews"))
    flagged = stats.where(F.col("orders") >= min_orders).crossJoin(F.broadcast(platform)) \
        .where(mean < F.col("platform") - gap)
    revenue = star.fact_order_items("seller_id", "price", "is_sale").where("is_sale") \
        .groupBy("seller_id").agg(F.sum("price").alias("revenue"))
    rows = flagged.join(revenue, "seller_id").join(star.dim_seller("seller_id", "state"), "seller_id")
    # Quartiles by position; sellers with equally many orders are told apart by the head of their id.
    ranked = rank_all(
        rows, [F.desc("orders"), F.asc("seller_id")],
        {"_o": F.col("orders"), "_h": id_cell(rows, "seller_id")}, [F.desc("_o"), F.asc("_h")])
    return ranked.select(
        "seller_id", "state", "orders",
        sql_round(_double("revenue"), 2).alias("revenue"),
        sql_round(mean, 2).alias("avg_review"),
        sql_round(F.col("platform"), 2).alias("platform_avg_review"),
        sql_round(_share(F.col("negative"), F.col("reviews")), 1).alias("negative_review_pct"),
        sql_round(_share(F.col("late"), F.col("delivered")), 1).alias("late_pct"),
        tile(F.col("position"), F.col("n_rows"), 4).alias("volume_quartile_among_flagged"),
    ).orderBy(F.desc("orders"), "seller_id")


def id_cell(df: DataFrame, column: str) -> Column:
    """A coarse key that sorts like ``column``: the head of a text id, or a number without its last 16 bits."""
    kind = dict(df.dtypes)[column]
    return F.substring(column, 1, 2) if kind == "string" else F.shiftright(F.col(column).cast("long"), 16)


def seller_concentration(star) -> DataFrame:
    """q09: how few sellers make half and four fifths of the revenue.

    Sellers with equal revenue are interchangeable, so they are counted per distinct revenue and ranked in cells of
    the revenue axis; inside a run of equals the crossing is found by division.
    """
    sellers = star.fact_order_items("seller_id", "price", "is_sale").where("is_sale") \
        .groupBy("seller_id").agg(F.sum("price").cast("decimal(28,4)").alias("revenue"))
    levels = sellers.groupBy("revenue").agg(F.count("*").alias("n")) \
        .withColumn("amount", (F.col("revenue") * F.col("n")).cast("decimal(38,4)"))
    ranked = rank_all(levels, [F.desc("revenue")], {"_cell": log_cell(F.col("revenue"))}, [F.desc("_cell")],
                      running={"sellers_upto": "n", "revenue_upto": "amount"})

    def crossing(parts: int) -> Column:
        """Smallest position whose cumulative revenue reaches ``parts`` tenths of the total."""
        reached = F.col("revenue_upto") * 10 >= F.col("total_revenue_upto") * parts
        # How many of the equal sellers it takes: whole-number division, rounded up.
        lacking = F.col("total_revenue_upto") * parts - (F.col("revenue_upto") - F.col("amount")) * 10
        each = F.nullif(F.col("revenue") * 10, F.lit(0))
        whole = F.floor(F.try_divide(lacking - lacking % each, each))
        needed = F.greatest(whole + (lacking % each > 0).cast("int"), F.lit(1))
        return F.min(F.when(reached, F.col("sellers_upto") - F.col("n") + needed)).cast("long")

    found = ranked.agg(F.max("total_sellers_upto").alias("sellers"), crossing(5).alias("half"),
                       crossing(8).alias("most"))
    return found.select(
        "sellers", F.col("half").alias("sellers_for_50pct_revenue"), F.col("most").alias("sellers_for_80pct_revenue"),
        sql_round(_share(F.col("most"), F.col("sellers")), 2).alias("pct_sellers_for_80pct_revenue"))


CATALOGUE = {
    "q01_monthly_trend": monthly_trend,
    "q02_top_categories": top_categories,
    "q03_revenue_by_state": revenue_by_state,
    "q04_repeat_customers": repeat_customers,
    "q05_delivery_by_state": delivery_by_state,
    "q06_delay_vs_review": delay_vs_review,
    "q07_payments": payments,
    "q08_seller_risk": seller_risk,
    "q09_seller_concentration": seller_concentration,
}
