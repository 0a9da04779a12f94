"""Oracle SQL of measures and report queries: direct aggregates with distinct counts, no staging."""
from __future__ import annotations

from .base import avg_money, avg_scaled, definition, state_of, with_ctes
from .queries import ORACLE


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def cnt(p: str) -> str:
    return f"count(*) FILTER (WHERE {p})"


PAID = "is_sale AND has_items AND main_payment_type IS NOT NULL"
SALE = "is_sale AND has_items"
_D, _P = f"({avg_scaled('CASE WHEN is_delivered THEN delivery_days END', 2)})", \
    f"({avg_scaled('CASE WHEN is_delivered THEN promised_days END', 2)})"
_ON = avg_scaled("CASE WHEN is_delivered AND NOT is_late THEN review_score END")
_LATE = avg_scaled("CASE WHEN is_late THEN review_score END")

ITEM = {
    "revenue": "CAST(sum(price) AS DOUBLE)",
    "orders": "count(DISTINCT order_id)",
    "aov": div("sum(price)", "count(DISTINCT order_id)"),
    "items_sold": "count(*)",
    "freight": "CAST(sum(freight_value) AS DOUBLE)",
    "freight_pct": div("sum(freight_value)", "sum(price)"),
    "customers": "count(DISTINCT customer_unique_id)",
    "revenue_per_customer": div("sum(price)", "count(DISTINCT customer_unique_id)"),
    "active_sellers": "count(DISTINCT seller_id)",
}
ORDER = {
    "repeat_purchase_pct": div(cnt("is_repeat_purchase AND has_items"), cnt(SALE)),
    "delivered_orders": cnt("is_delivered"), "late_orders": cnt("is_late"),
    "on_time_pct": div(f"{cnt('is_delivered')} - {cnt('is_late')}", cnt("is_delivered")),
    "late_pct": div(cnt("is_late"), cnt("is_delivered")),
    "avg_delivery_days": _D, "avg_promised_days": _P, "promise_buffer_days": f"{_P} - {_D}",
    "avg_delay_when_late": avg_scaled("CASE WHEN is_late THEN delay_days END"),
    "avg_carrier_lead_days": avg_scaled("carrier_lead_days", 2),
    "avg_last_mile_days": avg_scaled("last_mile_days", 2),
    "reviews": cnt("has_review"), "avg_review_score": avg_scaled("review_score"),
    "negative_review_pct": div(cnt("review_score <= 2"), cnt("has_review")),
    "five_star_pct": div(cnt("review_score = 5"), cnt("has_review")),
    "avg_review_on_time": _ON, "avg_review_late": _LATE, "review_gap": f"({_ON}) - ({_LATE})",
    "paid_orders": cnt(PAID),
    "installment_pct": div(cnt(f"{PAID} AND is_installment"), cnt(PAID)),
    "avg_installments_card": avg_scaled("CASE WHEN is_sale AND main_payment_type = 'credit_card' "
                                        "THEN max_installments END"),
    "aov_by_order": avg_money(f"CASE WHEN {SALE} THEN items_price END"),
}
SELLER = {
    "seller_orders": "count(*)", "seller_avg_review": avg_scaled("review_score"),
    "seller_negative_pct": div(cnt("review_score <= 2"), "count(review_score)"),
    "seller_late_pct": div(cnt("is_late"), cnt("is_delivered")),
}
JOINS = {
    "dim_customer": ("dim_state", "LEFT JOIN (SELECT customer_unique_id AS _c, state AS c_state, region AS c_region "
                     "FROM dim_state) dc ON dc._c = f.customer_unique_id"),
    "dim_date": ("dim_date", "LEFT JOIN (SELECT date_key AS _d, year, year_month, year_quarter, month_num, "
                 "is_complete_month FROM dim_date) dd ON dd._d = f.date_key"),
    "dim_product": ("dim_product", "LEFT JOIN (SELECT product_id AS _p, category FROM dim_product) dp "
                    "ON dp._p = f.product_id"),
    "dim_seller": ("dim_seller", "LEFT JOIN (SELECT seller_id AS _s, seller_label, state AS s_state FROM dim_seller) "
                   "ds ON ds._s = f.seller_id"),
}
RENAME = {("dim_customer", "state"): "c_state", ("dim_customer", "region"): "c_region",
          ("dim_seller", "state"): "s_state"}


def evaluate(measures: list[str], by: list[str], where: str = "TRUE", where_tables: str = "",
             risk: tuple[int, float] = (50, 0.3)) -> tuple[str, str]:
    """(needed expressions, SELECT) with one sub-query per kind of measure, joined on the group keys."""
    keys = [b.split(".") for b in by]
    tables = {t for t, _ in keys} | set(where_tables.split())
    names = [c for _, c in keys]

    def source(fact: str) -> tuple[str, str]:
        joins = " ".join(JOINS[t][1] for t in sorted(tables) if t in JOINS)
        cols = "".join(f"{RENAME.get((t, c), c)} AS k_{c}, " for t, c in keys)
        return f"(SELECT {cols}f.* FROM {fact} f {joins} WHERE {where})", ", ".join(f"k_{c}" for c in names)

    group = lambda ks: f" GROUP BY {ks}" if ks else ""
    first = lambda ks: f"{ks}, " if ks else ""
    subs = []
    item = [m for m in measures if m in ITEM]
    if item:
        src, ks = source("fact_order_items")
        subs.append(f"SELECT {first(ks)}{', '.join(f'{ITEM[m]} AS {m}' for m in item)} FROM {src} x WHERE is_sale"
                    + group(ks))
    if {"repeat_customers", "repeat_customer_pct"} & set(measures):
        src, ks = source("fact_order_items")
        subs.append(f"SELECT {first(ks)}{cnt('n >= 2')} AS repeat_customers, {div(cnt('n >= 2'), 'count(*)')} AS "
                    f"repeat_customer_pct FROM (SELECT {first(ks)}customer_unique_id, count(DISTINCT order_id) AS n "
                    f"FROM {src} x WHERE is_sale GROUP BY {first(ks)}customer_unique_id) y" + group(ks))
    order = [m for m in measures if m in ORDER or m == "payment_share"]
    if order:
        src, ks = source("fact_orders")
        rest = [f"k_{c}" for c in names if c != "main_payment_type"]
        over = f"sum({cnt(PAID)}) OVER (PARTITION BY {', '.join(rest)})" if rest else f"sum({cnt(PAID)}) OVER ()"
        text = {**ORDER, "payment_share": div(cnt(PAID), over)}
        subs.append(f"SELECT {first(ks)}{', '.join(f'{text[m]} AS {m}' for m in order)} FROM {src} x" + group(ks))
    seller = [m for m in measures if m in SELLER or m == "seller_risk_flag"]
    if seller:
        src, ks = source("fact_order_items")
        rows = (f"(SELECT DISTINCT {first(ks)}order_id, review_score, is_late, is_delivered FROM {src} x "
                "WHERE is_sale AND NOT is_multi_seller)")
        rest = ", ".join(f"k_{c}" for t, c in keys if t != "dim_seller")
        parts = [f"{SELLER[m]} AS {m}" for m in seller if m in SELLER]
        if "seller_risk_flag" in seller:
            part = f"PARTITION BY {rest}" if rest else ""
            platform = (f"(CAST(sum(sum(review_score)) OVER ({part}) AS DOUBLE) "
                        f"/ CAST(sum(count(review_score)) OVER ({part}) AS DOUBLE))")
            parts.append(f"CASE WHEN count(*) >= {risk[0]} AND {avg_scaled('review_score')} < {platform} - "
                         f"{risk[1]}::DOUBLE THEN 1 ELSE 0 END AS seller_risk_flag")
        subs.append(f"SELECT {first(ks)}{', '.join(parts)} FROM {rows} y" + group(ks))
    joined = f"({subs[0]}) s0"
    have = [f"s0.k_{c}" for c in names]
    for i, sub in enumerate(subs[1:], 1):
        if names:
            on = " AND ".join(f"coalesce(CAST({h} AS VARCHAR), '~') = coalesce(CAST(s{i}.k_{c} AS VARCHAR), '~')"
                              for h, c in zip(have, names))
            joined += f" FULL JOIN ({sub}) s{i} ON {on}"
            have = [f"coalesce({h}, s{i}.k_{c})" for h, c in zip(have, names)]
        else:
            joined += f" CROSS JOIN ({sub}) s{i}"
    zero = {"orders", "items_sold", "customers", "active_sellers", "repeat_customers", "delivered_orders", "late_orders",
            "reviews", "paid_orders", "seller_orders", "seller_risk_flag"}
    cols = [f"{h} AS {c}" for h, c in zip(have, names)]
    cols += [f"coalesce({m}, 0) AS {m}" if m in zero else m for m in measures]
    needs = " ".join(["fact_orders", "fact_order_items"] + [JOINS[t][0] for t in sorted(tables) if t in JOINS])
    return needs, f"SELECT {', '.join(cols)} FROM {joined}"


def add(name: str, measures: str, by: str = "", tail: str = "", wrap: str = "", **kw) -> None:
    needs, sql = evaluate(measures.split(), by.split(), **kw)
    body = wrap.format(q=f"({sql}) q") if wrap else (f"SELECT * FROM ({sql}) q {tail}" if tail else sql)
    ORACLE[name] = with_ctes(body, needs)


_SALES = ("revenue orders aov items_sold freight freight_pct customers repeat_customers repeat_customer_pct "
          "revenue_per_customer active_sellers")
_OPS = ("delivered_orders late_orders on_time_pct late_pct avg_delivery_days avg_promised_days promise_buffer_days "
        "avg_delay_when_late avg_carrier_lead_days avg_last_mile_days")
_BUCKET = "fact_orders.delivery_bucket fact_orders.delivery_bucket_order"
add("rpt_kpi_row", "revenue orders aov on_time_pct avg_review_score repeat_customer_pct")
add("rpt_revenue_by_month", "revenue", "dim_date.year_month", where="is_complete_month")
add("rpt_top10", "revenue", "dim_product.category", tail="ORDER BY revenue DESC, category LIMIT 10")
add("rpt_review_by_bucket", "avg_review_score negative_review_pct", _BUCKET, tail="WHERE delivery_bucket IS NOT NULL")
add("rpt_customer_kpis", "revenue aov customers revenue_per_customer repeat_customers repeat_customer_pct "
    "repeat_purchase_pct")
add("rpt_revenue_by_state", "revenue aov orders", "dim_customer.state")
add("rpt_category_matrix", "revenue orders aov freight_pct", "dim_product.category")
add("rpt_ticket_by_installments", "aov_by_order avg_installments_card installment_pct",
    "fact_orders.installment_bucket fact_orders.installment_bucket_order")
add("rpt_payment_share", "paid_orders payment_share aov_by_order", "fact_orders.main_payment_type")
add("rpt_delivery_kpis", "avg_delivery_days avg_promised_days promise_buffer_days on_time_pct late_orders "
    "avg_delay_when_late")
add("rpt_delivery_by_month", "avg_delivery_days avg_promised_days", "dim_date.year_month")
add("rpt_late_by_state", "late_pct late_orders delivered_orders", "dim_customer.state",
    wrap="SELECT state, late_pct, late_pct > CAST(sum(late_orders) OVER () AS DOUBLE) "
         "/ CAST(sum(delivered_orders) OVER () AS DOUBLE) AS above_average FROM {q}")
add("rpt_lead_times_by_region", "avg_carrier_lead_days avg_last_mile_days", "dim_customer.region")
add("rpt_delivered_by_bucket", "delivered_orders", _BUCKET, tail="WHERE delivery_bucket IS NOT NULL")
add("rpt_satisfaction_kpis", "reviews avg_review_score negative_review_pct five_star_pct avg_review_on_time "
    "avg_review_late review_gap")
add("rpt_seller_scatter", "seller_orders seller_avg_review revenue", "dim_seller.seller_id dim_seller.seller_label",
    tail="WHERE seller_orders >= 5")
add("rpt_seller_risk", "seller_orders revenue seller_avg_review seller_negative_pct seller_late_pct seller_risk_flag",
    "dim_seller.seller_id dim_seller.seller_label dim_seller.state", tail="WHERE seller_risk_flag = 1", risk=(5, 0.3))
add("msr_sales_by_category", _SALES, "dim_product.category")
add("msr_customers", _SALES + " repeat_purchase_pct", "dim_customer.region dim_date.year",
    where="month_num BETWEEN 1 AND 6")
add("msr_operations_by_state", _OPS, "dim_customer.state", where="c_region IN ('South', 'Northeast')")
add("msr_satisfaction", "reviews avg_review_score negative_review_pct five_star_pct avg_review_on_time "
    "avg_review_late review_gap", "dim_date.year_quarter")
add("msr_payments_share", "paid_orders payment_share installment_pct avg_installments_card aov_by_order",
    "fact_orders.main_payment_type dim_date.year")
add("msr_sellers", "seller_orders seller_avg_review seller_negative_pct seller_late_pct seller_risk_flag "
    "active_sellers revenue", "dim_seller.seller_id dim_seller.seller_label dim_date.year", risk=(3, 0.3))



def add_totals(name: str, measures: str, by: str) -> None:
    """Details, subtotals over the leading keys and the grand total, each asked for on its own."""
    keys, parts, needs = by.split(), [], set()
    for i in range(len(keys) + 1):
        some = keys[:len(keys) - i]
        need, sql = evaluate(measures.split(), some)
        needs |= set(need.split())
        names = [k.split(".")[1] if k in some else f"NULL AS {k.split('.')[1]}" for k in keys]
        parts.append(f"SELECT {', '.join(names)}, {i} AS level, {', '.join(measures.split())} FROM ({sql}) q{i}")
    ORACLE[name] = with_ctes(" UNION ALL ".join(parts), " ".join(sorted(needs)))


add_totals("rpt_category_matrix_totals", "revenue orders aov freight_pct", "dim_product.category dim_date.year")
add_totals("msr_totals_by_region", "revenue orders customers repeat_customers repeat_customer_pct active_sellers late_pct repeat_purchase_pct",
           "dim_customer.region dim_customer.state dim_date.year")
add_totals("msr_totals_by_payment", "paid_orders payment_share installment_pct aov_by_order", "fact_orders.main_payment_type dim_date.year")
add_totals("msr_totals_by_seller", "seller_orders seller_avg_review seller_late_pct active_sellers revenue", "dim_date.year dim_seller.seller_id")

ORACLE["rpt_mom_yoy"] = with_ctes(f"""
WITH m AS (
    SELECT d.year_month, d.month_start, d.is_complete_month AS ok, sum(price) AS revenue,
           count(DISTINCT order_id) AS orders
    FROM fact_order_items i JOIN dim_date d USING (date_key) WHERE is_sale GROUP BY 1, 2, 3),
mo AS (SELECT DISTINCT month_start, is_complete_month AS ok FROM dim_date),
p AS (
    SELECT m.year_month, m.revenue, m.orders,
           CASE WHEN m.ok AND pm.ok THEN b.revenue END AS pm,
           CASE WHEN m.ok AND pm.ok AND b.revenue IS NOT NULL THEN b.orders END AS opm, y.revenue AS py
    FROM m LEFT JOIN mo pm ON pm.month_start = m.month_start - INTERVAL 1 MONTH
    LEFT JOIN m b ON b.month_start = m.month_start - INTERVAL 1 MONTH
    LEFT JOIN m y ON y.month_start = m.month_start - INTERVAL 12 MONTH)
SELECT year_month, CAST(revenue AS DOUBLE) AS revenue, CAST(pm AS DOUBLE) AS revenue_pm,
       {div('CAST(revenue AS DOUBLE) - CAST(pm AS DOUBLE)', 'pm')} AS revenue_mom_pct,
       orders, opm AS orders_pm, {div('orders - opm', 'opm')} AS orders_mom_pct, CAST(py AS DOUBLE) AS revenue_py,
       CASE WHEN py > 0 THEN {div('CAST(revenue AS DOUBLE) - CAST(py AS DOUBLE)', 'py')} END AS revenue_yoy_pct
FROM p
""", "fact_order_items dim_date")


# Dates moved back: every current day names its earlier days, month by month.
def _periods(where: str, key: str, of: str, join: str = "") -> str:
    """``key``: the group key's expression over the current day ``d`` or the item; ``of``: 'day' or 'item' or ''."""
    day_key = key if of == "day" else "0"
    return f"""
WITH cur AS (SELECT d.date, d.is_complete_month AS ok, {day_key} AS k FROM dim_date d WHERE {where}),
back AS (
    SELECT DISTINCT months, c.k, p.date, p.is_complete_month AS ok FROM cur c, (VALUES (1), (12)) v(months), dim_date p
    WHERE date_trunc('month', p.date) = date_trunc('month', c.date) - to_months(months::INT) AND (
        day(p.date) = day(c.date) OR (c.date = last_day(c.date) AND day(p.date) >= day(c.date))
        OR (p.date = last_day(p.date) AND day(c.date) >= day(p.date)))),
sold AS (SELECT i.date_key, i.price, i.order_id, {key if of == "item" else "0"} AS g FROM fact_order_items i {join} WHERE is_sale),
days AS (SELECT date, date_key FROM dim_date),
now AS (SELECT k, g, sum(price) AS revenue, count(DISTINCT order_id) AS orders FROM sold JOIN days USING (date_key) JOIN cur USING (date) GROUP BY 1, 2),
past AS (
    SELECT months, k, g, sum(price) AS revenue, count(DISTINCT order_id) AS orders
    FROM sold JOIN days USING (date_key) JOIN back USING (date) GROUP BY 1, 2, 3),
fits AS (
    SELECT k, coalesce(bool_and(ok) AND (SELECT bool_or(b.ok) FROM back b WHERE b.months = 1 AND b.k = cur.k), false) AS fits FROM cur GROUP BY k),
p AS (
    SELECT n.k, n.g, n.revenue, n.orders, CASE WHEN fits THEN m.revenue END AS pm,
           CASE WHEN fits AND m.revenue IS NOT NULL THEN m.orders END AS opm, y.revenue AS py
    FROM now n JOIN fits USING (k) LEFT JOIN past m ON m.months = 1 AND m.k = n.k AND m.g IS NOT DISTINCT FROM n.g
    LEFT JOIN past y ON y.months = 12 AND y.k = n.k AND y.g IS NOT DISTINCT FROM n.g)
SELECT {dict(day=f"k AS {key.split('.')[-1]},", item=f"g AS {key.split('.')[-1]},").get(of, "")}
       CAST(revenue AS DOUBLE) AS revenue, CAST(pm AS DOUBLE) AS revenue_pm,
       {div('CAST(revenue AS DOUBLE) - CAST(pm AS DOUBLE)', 'pm')} AS revenue_mom_pct, orders, opm AS orders_pm,
       {div('orders - opm', 'opm')} AS orders_mom_pct, CAST(py AS DOUBLE) AS revenue_py,
       CASE WHEN py > 0 THEN {div('CAST(revenue AS DOUBLE) - CAST(py AS DOUBLE)', 'py')} END AS revenue_yoy_pct
FROM p
"""


ORACLE["msr_yoy_of_range"] = with_ctes(_periods("d.year = 1998 AND d.month_num BETWEEN 1 AND 8", "", ""), "fact_order_items dim_date")
ORACLE["msr_mom_within_month"] = with_ctes(_periods(
    "d.date BETWEEN DATE '1996-03-10' AND DATE '1996-03-31'", "c.region", "item", "JOIN dim_customer c USING (customer_unique_id)"), "fact_order_items dim_date dim_customer")
ORACLE["msr_periods_by_year"] = with_ctes(_periods("true", "d.year", "day"), "fact_order_items dim_date")


def _by_desk(sql: str) -> str:
    """The statement over items sold by the desk of an order's region and priority, with the floor of 50 orders."""
    desks = ("(SELECT o_orderkey AS order_id, n_regionkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS desk FROM orders "
             "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)")
    sellers = ("SELECT DISTINCT n_regionkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS seller_id, "
               "lpad(CAST(n_regionkey * 1000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix, "
               f"'  São Building ' || n_regionkey || ' ' AS seller_city, {state_of('n_regionkey')} AS seller_state FROM nation, orders")
    items, plain_sellers = definition("raw_items"), definition("raw_sellers")
    assert items in sql
    sql = sql.replace(items, f"SELECT i.* REPLACE (d.desk AS seller_id) FROM ({items}) i JOIN {desks} d ON i.order_id = d.order_id")
    return sql.replace(plain_sellers, sellers).replace(">= 5 ", ">= 50 ").replace(">= 5)", ">= 50)")


add("rpt_seller_scatter_50", "seller_orders seller_avg_review revenue", "dim_seller.seller_id dim_seller.seller_label", tail="WHERE seller_orders >= 50")
add("rpt_seller_risk_50", "seller_orders revenue seller_avg_review seller_negative_pct seller_late_pct seller_risk_flag",
    "dim_seller.seller_id dim_seller.seller_label dim_seller.state", tail="WHERE seller_risk_flag = 1")
for _name, _plain in (("rpt_seller_scatter_50",) * 2, ("rpt_seller_risk_50",) * 2, ("q08_seller_risk_50", "q08_seller_risk")):
    ORACLE[_name] = _by_desk(ORACLE[_plain])
