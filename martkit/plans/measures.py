"""Business measures, evaluated under any grouping and filters their fact can reach.

    evaluate(star, ["revenue", "orders", "aov"], by=["dim_customer.state"],
             where=[("dim_date.date", "between", ("2017-01-01", "2018-08-31"))])

Measures are compositions of *components*: sums and counts that can be added up in stages.  Facts are aggregated to
one row per order, then per customer, before attributes of a customer are joined; distinct counts of orders and
customers become plain counts at those grains, so no row is expanded and no busy key is gathered in one task.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import calendar_columns
from ..operators.keys import dealt, in_parts

# ---------------------------------------------------------------- components

# Sums and counts over orders: the columns they read, and the aggregate.  All of them add up.
ORDER_COMPONENTS: dict[str, tuple[str, str]] = {
    "o_sales": ("is_sale has_items", "count_if(is_sale AND has_items)"),
    "o_again": ("is_repeat_purchase has_items", "count_if(is_repeat_purchase AND has_items)"),
    "o_delivered": ("is_delivered", "count_if(is_delivered)"),
    "o_late": ("is_late", "count_if(is_late)"),
    "o_delivery_sum": ("is_delivered delivery_days",
                       "sum(IF(is_delivered, CAST(rint(delivery_days * 100) AS BIGINT), NULL))"),
    "o_delivery_n": ("is_delivered delivery_days", "count(IF(is_delivered, delivery_days, NULL))"),
    "o_promised_sum": ("is_delivered promised_days",
                       "sum(IF(is_delivered, CAST(rint(promised_days * 100) AS BIGINT), NULL))"),
    "o_promised_n": ("is_delivered promised_days", "count(IF(is_delivered, promised_days, NULL))"),
    "o_delay_sum": ("is_late delay_days", "sum(IF(is_late, CAST(delay_days AS BIGINT), NULL))"),
    "o_lead_sum": ("carrier_lead_days", "sum(CAST(rint(carrier_lead_days * 100) AS BIGINT))"),
    "o_lead_n": ("carrier_lead_days", "count(carrier_lead_days)"),
    "o_mile_sum": ("last_mile_days", "sum(CAST(rint(last_mile_days * 100) AS BIGINT))"),
    "o_mile_n": ("last_mile_days", "count(last_mile_days)"),
    "o_reviews": ("has_review", "count_if(has_review)"),
    "o_score_sum": ("review_score", "sum(CAST(review_score AS BIGINT))"),
    "o_negative": ("review_score", "count_if(review_score <= 2)"),
    "o_five": ("review_score", "count_if(review_score = 5)"),
    "o_score_ontime_sum": ("is_delivered is_late review_score",
                           "sum(IF(is_delivered AND NOT is_late, CAST(review_score AS BIGINT), NULL))"),
    "o_score_ontime_n": ("is_delivered is_late review_score",
                         "count(IF(is_delivered AND NOT is_late, review_score, NULL))"),
    "o_score_late_sum": ("is_late review_score", "sum(IF(is_late, CAST(review_score AS BIGINT), NULL))"),
    "o_score_late_n": ("is_late review_score", "count(IF(is_late, review_score, NULL))"),
    "o_paid": ("is_sale has_items main_payment_type",
               "count_if(is_sale AND has_items AND main_payment_type IS NOT NULL)"),
    "o_paid_installments": ("is_sale has_items main_payment_type is_installment",
                            "count_if(is_sale AND has_items AND main_payment_type IS NOT NULL AND is_installment)"),
    "o_card_inst_sum": ("is_sale main_payment_type max_installments",
                        "sum(IF(is_sale AND main_payment_type = 'credit_card', max_installments, NULL))"),
    "o_card_inst_n": ("is_sale main_payment_type max_installments",
                      "count(IF(is_sale AND main_payment_type = 'credit_card', max_installments, NULL))"),
    "o_ticket_sum": ("is_sale has_items items_price", "sum(IF(is_sale AND has_items, items_price, NULL))"),
}
SALES_COMPONENTS = ("i_revenue", "i_freight", "i_items", "i_orders", "i_customers", "i_repeat")
SELLER_COMPONENTS = ("s_orders", "s_score_sum", "s_score_n", "s_negative", "s_delivered", "s_late", "s_platform")
_COUNTS = {"i_items", "i_orders", "i_customers", "i_repeat", "a_sellers", "s_orders", "s_score_n", "s_negative",
           "s_delivered", "s_late"} | {n for n, (_, e) in ORDER_COMPONENTS.items() if e.startswith("count")}


# ---------------------------------------------------------------- measures

@dataclass(frozen=True)
class Measure:
    needs: tuple[str, ...]
    value: Callable[..., Column]


def _d(c: Column) -> Column:
    return c.cast("double")


def _div(a: Column, b: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(_d(a), _d(b))


def _hundredths(total: Column, n: Column) -> Column:
    return F.try_divide(_d(total), _d(n) * 100.0)


def _growth(now: Column, before: Column) -> Column:
    return _div(_d(now) - _d(before), before)


def _m(needs: str, value: Callable[..., Column]) -> Measure:
    return Measure(tuple(needs.split()), value)


MEASURES: dict[str, Measure] = {
    # sales
    "revenue": _m("i_revenue", _d),
    "orders": _m("i_orders", lambda n: n),
    "aov": _m("i_revenue i_orders", _div),
    "items_sold": _m("i_items", lambda n: n),
    "freight": _m("i_freight", _d),
    "freight_pct": _m("i_freight i_revenue", _div),
    "revenue_pm": _m("t_revenue_pm", _d),
    "revenue_mom_pct": _m("i_revenue t_revenue_pm", _growth),
    "orders_pm": _m("t_orders_pm", lambda n: n),
    "orders_mom_pct": _m("i_orders t_orders_pm", _growth),
    "revenue_py": _m("t_revenue_py", _d),
    "revenue_yoy_pct": _m("i_revenue t_revenue_py", lambda now, py: F.when(py > 0, _growth(now, py))),
    # customers
    "customers": _m("i_customers", lambda n: n),
    "repeat_customers": _m("i_repeat", lambda n: n),
    "repeat_customer_pct": _m("i_repeat i_customers", _div),
    "repeat_purchase_pct": _m("o_again o_sales", _div),
    "revenue_per_customer": _m("i_revenue i_customers", _div),
    # operations
    "delivered_orders": _m("o_delivered", lambda n: n),
    "late_orders": _m("o_late", lambda n: n),
    "on_time_pct": _m("o_delivered o_late", lambda n, late: _div(n - late, n)),
    "late_pct": _m("o_late o_delivered", _div),
    "avg_delivery_days": _m("o_delivery_sum o_delivery_n", _hundredths),
    "avg_promised_days": _m("o_promised_sum o_promised_n", _hundredths),
    "promise_buffer_days": _m("o_promised_sum o_promised_n o_delivery_sum o_delivery_n",
                              lambda p, pn, d, dn: _hundredths(p, pn) - _hundredths(d, dn)),
    "avg_delay_when_late": _m("o_delay_sum o_late", _div),
    "avg_carrier_lead_days": _m("o_lead_sum o_lead_n", _hundredths),
    "avg_last_mile_days": _m("o_mile_sum o_mile_n", _hundredths),
    # satisfaction
    "reviews": _m("o_reviews", lambda n: n),
    "avg_review_score": _m("o_score_sum o_reviews", _div),
    "negative_review_pct": _m("o_negative o_reviews", _div),
    "five_star_pct": _m("o_five o_reviews", _div),
    "avg_review_on_time": _m("o_score_ontime_sum o_score_ontime_n", _div),
    "avg_review_late": _m("o_score_late_sum o_score_late_n", _div),
    "review_gap": _m("o_score_ontime_sum o_score_ontime_n o_score_late_sum o_score_late_n",
                     lambda a, an, b, bn: _div(a, an) - _div(b, bn)),
    # payments
    "paid_orders": _m("o_paid", lambda n: n),
    "payment_share": _m("o_paid x_paid_all", _div),
    "installment_pct": _m("o_paid_installments o_paid", _div),
    "avg_installments_card": _m("o_card_inst_sum o_card_inst_n", _div),
    "aov_by_order": _m("o_ticket_sum o_sales", _div),
    # sellers
    "seller_orders": _m("s_orders", lambda n: n),
    "seller_avg_review": _m("s_score_sum s_score_n", _div),
    "seller_negative_pct": _m("s_negative s_score_n", _div),
    "seller_late_pct": _m("s_late s_delivered", _div),
    "seller_risk_flag": _m("s_orders s_score_sum s_score_n s_platform", None),
    "active_sellers": _m("a_sellers", lambda n: n),
}

Filter = tuple[str, str, object]
LEVEL = "_level"
_PRODUCT, _SELLER, _CUSTOMER, _DATE = "dim_product", "dim_seller", "dim_customer", "dim_date"


# ---------------------------------------------------------------- contexts

def _split(name: str) -> tuple[str, str]:
    table, column = name.split(".")
    return table, column


def _predicate(column: Column, op: str, value) -> Column:
    if op == "between":
        return column.between(*value)
    if op == "in":
        return column.isin(*value)
    if op == "is":
        return column == F.lit(value)
    raise ValueError(f"unknown filter {op!r}")


class _Context:
    """Group keys and filters of one evaluation, and how a fact obtains them."""

    def __init__(self, star, by: Sequence[str], where: Sequence[Filter], fact: str, levels: bool = False):
        self.star, self.by, self.where, self.fact, self.levels = star, list(by), list(where), fact, levels
        self.keys = [_split(n)[1] for n in by]
        self.months = 0
        if len(set(self.keys)) < len(self.keys):
            raise ValueError("two group keys share a name")
        for name in [*by, *[w[0] for w in where]]:
            table = _split(name)[0]
            own = table == fact
            if not own and (table not in (_CUSTOMER, _DATE) if fact == "fact_orders"
                            else table not in (_CUSTOMER, _DATE, _PRODUCT, _SELLER)):
                raise ValueError(f"{name} does not filter {fact}")

    def _used(self, table: str) -> list[str]:
        names = [*self.by, *[w[0] for w in self.where]]
        return list(dict.fromkeys(c for t, c in map(_split, names) if t == table))

    def filters(self, tables: Sequence[str]) -> list[Filter]:
        return [w for w in self.where if _split(w[0])[0] in tables]

    @property
    def by_customer(self) -> bool:
        return bool(self._used(_CUSTOMER))

    def row_columns(self) -> list[str]:
        """Fact columns needed for the keys and filters that are known on the fact row."""
        cols = [c for c in self._used(self.fact)]
        if self._used(_DATE) or self.months:
            cols.append("purchase_date")
        if self._used(_PRODUCT):
            cols.append("product_id")
        if self._used(_SELLER):
            cols.append("seller_id")
        return list(dict.fromkeys(cols))

    # With levels, each row counts once per grouping set: the details, and the keys without their last, last two, ... up to
    # none.  Keys a level leaves out are NULL there, so a set is a group like any other, and distinct counts stay exact.
    def key(self, k: str) -> str:
        """The group column of a key; the fact's own column of that name stays as it is."""
        return f"_g_{k}" if self.levels else k

    def _on_level(self, k: str, value: Column) -> Column:
        return F.when(F.col(LEVEL) < len(self.keys) - self.keys.index(k), value)

    @property
    def level_key(self) -> list[str]:
        return [LEVEL] if self.levels else []

    def row_keys(self) -> list[str]:
        """Group keys available before customers are joined."""
        return [self.key(k) for n, k in zip(self.by, self.keys) if _split(n)[0] != _CUSTOMER] + self.level_key

    def on_rows(self, rows: DataFrame, part: str | None = None) -> DataFrame:
        """Filter rows by everything but customer attributes, and add those keys; with ``part`` dealt by that column (``_part``)."""
        out = {c: F.col(c) for c in self._used(self.fact)}
        dates = self._used(_DATE)
        if self.months:
            # A row per day and date key of the calendar; its size follows the years, not the facts.
            rows = rows.join(F.broadcast(self.earlier_dates(self.months)), F.col("purchase_date") == F.col("_past"))
            out.update({k: F.col(f"_k_{k}") for k in self.date_keys})
        elif dates:
            parts = calendar_columns(F.col("purchase_date"))
            if "is_complete_month" in dates:
                # One row per month; tiny whatever the size of the facts.
                months = self.star.dim_date("month_start", "is_complete_month").distinct() \
                    .select(F.col("month_start").alias("_month"), "is_complete_month")
                rows = rows.join(F.broadcast(months), F.trunc("purchase_date", "month") == F.col("_month"), "left")
                parts["is_complete_month"] = F.col("is_complete_month")
            out.update({c: parts[c] for c in dates})
        for table, key in ((_PRODUCT, "product_id"), (_SELLER, "seller_id")):
            extra = [c for c in self._used(table) if c != key]
            if extra and not (table == _SELLER and self.late_seller):
                rows = rows.join(self.star.table(table, key, *extra), key, "left")
                out.update({c: F.col(c) for c in extra})
            if key in self._used(table):
                out[key] = F.col(key)
        for name, op, value in self.filters([self.fact, *([] if self.months else [_DATE]), _PRODUCT, _SELLER]):
            rows = rows.where(_predicate(out[_split(name)[1]], op, value))
        if part:
            rows = in_parts(rows, self.star.item_rows(), part)
        late = set(self.late_keys)
        known = [k for n, k in zip(self.by, self.keys) if _split(n)[0] != _CUSTOMER and k not in late]
        if self.levels:
            rows = rows.withColumn(LEVEL, F.explode(F.array(*[F.lit(i) for i in range(len(self.keys) + 1)])))
            return rows.withColumns({self.key(k): self._on_level(k, out[k]) for k in known})
        added = {k: out[k] for k in known}
        return rows.withColumns(added) if added else rows

    # Other attributes of a seller follow from its id, so they can be looked up after aggregating by it.
    @property
    def late_seller(self) -> bool:
        return f"{_SELLER}.seller_id" in self.by and not self.filters([_SELLER]) and not self.levels

    @property
    def late_keys(self) -> list[str]:
        if not self.late_seller:
            return []
        return [k for n, k in zip(self.by, self.keys) if _split(n)[0] == _SELLER and k != "seller_id"]

    def early_keys(self) -> list[str]:
        return [k for k in self.row_keys() if k not in self.late_keys]

    def with_customers(self, grouped: DataFrame) -> DataFrame:
        """Join customer attributes onto rows that are already one per customer and early key."""
        cols = self._used(_CUSTOMER)
        joined = grouped.join(self.star.dim_customer("customer_unique_id", *cols), "customer_unique_id", "left")
        for name, op, value in self.filters([_CUSTOMER]):
            joined = joined.where(_predicate(F.col(_split(name)[1]), op, value))
        if self.levels:
            own = [k for n, k in zip(self.by, self.keys) if _split(n)[0] == _CUSTOMER]
            joined = joined.withColumns({self.key(k): self._on_level(k, F.col(k)) for k in own})
        return joined

    def with_late_keys(self, result: DataFrame) -> DataFrame:
        if not self.late_keys:
            return result
        return result.join(self.star.dim_seller("seller_id", *self.late_keys), "seller_id", "left")

    def final_keys(self) -> list[str]:
        return [self.key(k) for k in self.keys if k not in self.late_keys] + self.level_key

    # ---- earlier periods
    def shifted(self, months: int) -> "_Context":
        """The same context, with each date replaced by the one ``months`` months before it."""
        ctx = _Context(self.star, self.by, self.where, self.fact)
        ctx.months = months
        return ctx

    @property
    def date_keys(self) -> list[str]:
        return [k for n, k in zip(self.by, self.keys) if _split(n)[0] == _DATE]

    def current_dates(self) -> DataFrame:
        """Date keys, date and is_complete_month of the calendar's days in this context; a row per day."""
        days = self.star.dim_date(*dict.fromkeys(["date", "is_complete_month", *self._used(_DATE)]))
        for name, op, value in self.filters([_DATE]):
            days = days.where(_predicate(F.col(_split(name)[1]), op, value))
        return days.select(*[F.col(k).alias(f"_k_{k}") for k in self.date_keys], F.col("date").alias("_now"), F.col("is_complete_month").alias("_now_ok"))

    def earlier_dates(self, months: int) -> DataFrame:
        """Date keys, the earlier date and is_complete_month: each current date moved back by months.

        A day past the end of the earlier month falls on its last day, and the last day of a month takes along all later days
        of the earlier one, so whole months meet whole months.
        """
        now = self.current_dates().withColumn("_m", F.add_months(F.trunc("_now", "month"), -months))
        past = self.star.dim_date("date", "is_complete_month").select(
            F.col("date").alias("_past"), F.col("is_complete_month").alias("_past_ok"), F.trunc("date", "month").alias("_m"))
        day, other = F.dayofmonth("_now"), F.dayofmonth("_past")
        last, other_last = F.last_day("_now") == F.col("_now"), F.last_day("_past") == F.col("_past")
        same = (day == other) | (last & (other >= day)) | (other_last & (day >= other))
        return now.join(past, "_m").where(same).select(*[f"_k_{k}" for k in self.date_keys], "_past", "_past_ok").distinct()


# ---------------------------------------------------------------- evaluation of components

def _sales(ctx: _Context, wanted: set[str]) -> DataFrame:
    """Revenue, freight, items, orders, customers: items -> orders -> customers -> group."""
    people = bool(wanted & {"i_customers", "i_repeat"}) or ctx.by_customer
    orders = people or "i_orders" in wanted
    columns = ["is_sale", *ctx.row_columns()]
    columns += ["price"] if "i_revenue" in wanted else []
    columns += ["freight_value"] if "i_freight" in wanted else []
    columns += ["order_id"] if orders else []
    columns += ["customer_unique_id"] if people else []
    rows = ctx.on_rows(ctx.star.fact_order_items(*dict.fromkeys(columns)).where("is_sale"), "order_id" if orders else None)

    sums = {c: s for c, s in (("i_revenue", F.sum("price")), ("i_freight", F.sum("freight_value"))) if c in wanted}
    level = ctx.early_keys()
    upto = [*level, "order_id"] if orders else level
    upto = [*upto, "customer_unique_id"] if people else upto
    part = ["_part"] if orders else []
    out = rows.groupBy(*upto, *part).agg(*[s.alias(c) for c, s in sums.items()], F.count("*").alias("i_items"))
    again = [F.sum(c).alias(c) for c in (*sums, "i_items")]
    if people:
        again.append(F.sum("i_orders").alias("i_orders"))
        out = out.groupBy(*level, "customer_unique_id", *part).agg(*again[:-1], F.count("*").alias("i_orders"))
        out = dealt(out, ctx.star.item_rows(), "customer_unique_id").groupBy(*level, "customer_unique_id").agg(*again)
        if ctx.by_customer:
            out = ctx.with_customers(out)
        return out.groupBy(*ctx.final_keys()).agg(
            *again, F.count("customer_unique_id").alias("i_customers"),
            F.count_if(F.col("customer_unique_id").isNotNull() & (F.col("i_orders") >= 2)).alias("i_repeat"))
    if orders:
        return out.groupBy(*level).agg(*again, F.count("*").alias("i_orders"))
    return out


def _active_sellers(ctx: _Context) -> DataFrame:
    person = ["customer_unique_id"] if ctx.by_customer else []
    columns = ["is_sale", "seller_id", "order_id", *ctx.row_columns(), *person]
    rows = ctx.on_rows(ctx.star.fact_order_items(*dict.fromkeys(columns)).where("is_sale"), "order_id")
    rows = rows.select(*dict.fromkeys([*ctx.early_keys(), "seller_id", *person, "_part"])).distinct()
    if ctx.by_customer:
        rows = ctx.with_customers(rows)
    keys = [k for k in ctx.final_keys() if k != "seller_id"]
    if "seller_id" in ctx.final_keys():
        return rows.groupBy(*ctx.final_keys()).agg(F.lit(1).cast("long").alias("a_sellers"))
    return rows.select(*keys, "seller_id").distinct().groupBy(*keys).agg(F.count("seller_id").alias("a_sellers"))


def _orders(ctx: _Context, wanted: list[str]) -> DataFrame:
    columns = {c for w in wanted for c in ORDER_COMPONENTS[w][0].split()} | set(ctx.row_columns())
    columns |= {"customer_unique_id"} if ctx.by_customer else set()
    rows = ctx.on_rows(ctx.star.fact_orders(*sorted(columns)))
    level = ctx.early_keys() + (["customer_unique_id"] if ctx.by_customer else [])
    out = rows.groupBy(*level).agg(*[F.expr(ORDER_COMPONENTS[w][1]).alias(w) for w in wanted])
    if not ctx.by_customer:
        return out
    return ctx.with_customers(out).groupBy(*ctx.final_keys()).agg(*[F.sum(w).alias(w) for w in wanted])


def _sellers(ctx: _Context, platform: bool) -> DataFrame:
    """Ratings attributed to the one seller of an order; each order counts once."""
    context = ["review_score", "is_late", "is_delivered"]
    extra = [c for c in ctx.row_columns() if c not in ("seller_id", *context)]
    person = ["customer_unique_id"] if ctx.by_customer else []
    if ctx._used(_PRODUCT):
        columns = ["order_id", "is_sale", "is_multi_seller", *context, *ctx.row_columns(), *person]
        rows = ctx.on_rows(ctx.star.fact_order_items(*dict.fromkeys(columns)).where("is_sale AND NOT is_multi_seller"))
        rows = rows.groupBy(*ctx.early_keys(), "order_id", *person).agg(
            F.max("review_score").alias("review_score"), F.bool_or("is_late").alias("is_late"),
            F.bool_or("is_delivered").alias("is_delivered"))
    else:
        rows = ctx.on_rows(ctx.star.single_seller_orders(*dict.fromkeys([*context, *extra, *person])))
    score = F.col("review_score")
    level = ctx.early_keys() + person
    parts = {"s_orders": F.count("*"), "s_score_sum": F.sum(score.cast("long")), "s_score_n": F.count(score),
             "s_negative": F.count_if(score <= 2), "s_delivered": F.count_if("is_delivered"),
             "s_late": F.count_if("is_late")}
    out = rows.groupBy(*level).agg(*[v.alias(k) for k, v in parts.items()])
    if ctx.by_customer:
        out = ctx.with_customers(out).groupBy(*ctx.final_keys()).agg(*[F.sum(k).alias(k) for k in parts])
    if not platform:
        return out
    # The same average without any seller key: every order has one seller, so its parts add up.
    seller_keys = {ctx.key(k) for n, k in zip(ctx.by, ctx.keys) if _split(n)[0] == _SELLER}
    rest = [k for k in ctx.final_keys() if k not in seller_keys]
    whole = out.groupBy(*rest).agg(_div(F.sum("s_score_sum"), F.sum("s_score_n")).alias("s_platform"))
    if not rest:
        return out.crossJoin(F.broadcast(whole))
    return _join_keys(out, whole, rest)


def _join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be NULL."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _with_periods(ctx: _Context, now: DataFrame, wanted: set[str]) -> DataFrame:
    """Values of the current dates moved back by a month or a year, whatever the date keys and filters.

    The month before counts only if all current days lie in complete months and some earlier day does.
    """
    keys = ctx.final_keys()
    if wanted & {"t_revenue_pm", "t_orders_pm"}:
        need = {"i_revenue"} | ({"i_orders"} if "t_orders_pm" in wanted else set())
        past = _sales(ctx.shifted(1), need).select(*keys, F.col("i_revenue").alias("t_revenue_pm"), *(
            [F.col("i_orders").alias("t_orders_pm")] if "t_orders_pm" in wanted else []))
        now = _beside(now, past, keys)
        names = [f"_k_{k}" for k in ctx.date_keys]
        current = ctx.current_dates().groupBy(*names).agg(F.bool_and("_now_ok").alias("_now_ok"))
        before = ctx.earlier_dates(1).groupBy(*names).agg(F.bool_or("_past_ok").alias("_past_ok"))
        flags = _beside(current, before, names).select(
            *[F.col(n).alias(n.removeprefix("_k_")) for n in names], F.coalesce(F.col("_now_ok") & F.col("_past_ok"), F.lit(False)).alias("_fits"))
        now = _beside(now, flags, ctx.date_keys)
        now = now.withColumn("t_revenue_pm", F.when(F.col("_fits"), F.col("t_revenue_pm")))
        if "t_orders_pm" in wanted:
            now = now.withColumn("t_orders_pm", F.when(F.col("t_revenue_pm").isNotNull(), F.col("t_orders_pm")))
        now = now.drop("_fits")
    if "t_revenue_py" in wanted:
        past = _sales(ctx.shifted(12), {"i_revenue"}).select(*keys, F.col("i_revenue").alias("t_revenue_py"))
        now = _beside(now, past, keys)
    return now


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys, or the one row of ``right`` beside each row where there are no keys."""
    return _join_keys(left, right, keys) if keys else left.crossJoin(F.broadcast(right))


def evaluate(star, measures: Sequence[str], by: Sequence[str] = (), where: Sequence[Filter] = (),
             risk: tuple[int, float] = (50, 0.3), totals: bool = False) -> DataFrame:
    """Group keys and one column per measure.  ``risk`` is the order floor and rating gap of the risk flag.

    With ``totals`` there are also the subtotals over all but the last key, the last two and so on, up to the grand total, in
    one plan; ``level`` says how many keys are left out (those are NULL).  Measures that do not add up, such as numbers of
    orders, customers or sellers, are those of the whole group.  Earlier periods are looked up level by level.
    """
    unknown = [m for m in measures if m not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures {unknown}")
    wanted = {c for m in measures for c in MEASURES[m].needs}
    by = list(by)
    if totals and any(c.startswith("t_") for c in wanted):
        return _totals_by_level(star, measures, by, where, risk)
    parts: list[tuple[DataFrame, list[str]]] = []
    items = _Context(star, by, where, "fact_order_items", totals) if any(c[0] in "ista" for c in wanted) else None
    names = [_split(n)[1] for n in by]
    keys = [f"_g_{k}" for k in names] + [LEVEL] if totals else names

    sales = {c for c in wanted if c in SALES_COMPONENTS}
    periods = {c for c in wanted if c.startswith("t_")}
    if sales or periods:
        found = _sales(items, sales | ({"i_revenue"} if periods else set()))
        if periods:
            found = _with_periods(items, found, periods)
        parts.append((items.with_late_keys(found), sorted(sales | periods)))
    if "a_sellers" in wanted:
        parts.append((items.with_late_keys(_active_sellers(items)), ["a_sellers"]))
    sellers = {c for c in wanted if c in SELLER_COMPONENTS}
    if sellers:
        parts.append((items.with_late_keys(_sellers(items, "s_platform" in wanted)), sorted(sellers)))
    orders = sorted(c for c in wanted if c in ORDER_COMPONENTS)
    if orders:
        ctx = _Context(star, by, where, "fact_orders", totals)
        found = _orders(ctx, orders)
        if "x_paid_all" in wanted:
            rest = [k for k in keys if k != ctx.key("main_payment_type")]
            whole = found.groupBy(*rest).agg(F.sum("o_paid").alias("x_paid_all"))
            found = _join_keys(found, whole, rest) if rest else found.crossJoin(F.broadcast(whole))
            orders = [*orders, "x_paid_all"]
        parts.append((found, orders))

    if len(parts) == 1:
        merged = parts[0][0]
    else:
        # Facts share only the group keys: stack their results and fold equal keys together.
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                         [df.select(*keys, *cols) for df, cols in parts])
        merged = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for _, cols in parts for c in cols])
    col = {c: F.coalesce(F.col(c), F.lit(0)) if c in _COUNTS else F.col(c) for c in wanted}

    def value(name: str) -> Column:
        m = MEASURES[name]
        if name == "seller_risk_flag":
            floor, gap = risk
            low = _div(col["s_score_sum"], col["s_score_n"]) < F.col("s_platform") - gap
            return F.when((col["s_orders"] >= floor) & low, 1).otherwise(0)
        return m.value(*[col[c] for c in m.needs])

    out = [F.col(c).alias(k) for c, k in zip(keys, names)] + ([F.col(LEVEL).cast("long").alias("level")] if totals else [])
    return merged.select(*out, *[value(n).alias(n) for n in measures])


def _totals_by_level(star, measures: Sequence[str], by: list[str], where: Sequence[Filter], risk: tuple[int, float]) -> DataFrame:
    """The dates before a subtotal's are not the sum of those before its parts, so each level is a context of its own."""
    levels = [evaluate(star, measures, by[:len(by) - i], where, risk).withColumn("level", F.lit(i).cast("long")) for i in range(len(by) + 1)]
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)
    return found.select(*[_split(n)[1] for n in by], "level", *measures)
