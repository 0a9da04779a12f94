"""Oracle SQL per registered query."""
from __future__ import annotations

import re

from .base import avg_money, avg_scaled, rounded, with_ctes

ORACLE: dict[str, str] = {}


def add(name: str, needs: str, body: str) -> None:
    ORACLE[name] = with_ctes(body, needs)


_TEXT = re.compile(r"date$|_at$|timestamp$|^month$|^month_start$|_ts$")
_NUMBER = set("price freight_value item_total items_price freight_total order_value payment_total "
              "lifetime_revenue".split())


def plain(columns: list[str]) -> str:
    """Select list with dates as text and money as doubles."""
    out = []
    for c in columns:
        if c in _NUMBER:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif _TEXT.search(c):
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


# ---------------------------------------------------------------- business questions
add("q01_monthly_trend", "fact_orders dim_date", f"""
WITH m AS (
    SELECT d.year_month, count(*) AS orders, sum(o.items_price) AS revenue
    FROM fact_orders o JOIN dim_date d USING (date_key)
    WHERE o.is_sale AND o.has_items AND d.is_complete_month GROUP BY 1)
SELECT year_month, orders, {rounded('CAST(revenue AS DOUBLE)', 2)} AS revenue,
       {rounded('CAST(revenue AS DOUBLE) / orders', 2)} AS aov,
       {rounded('(CAST(revenue AS DOUBLE) / CAST(lag(revenue) OVER (ORDER BY year_month) AS DOUBLE) - 1.0::DOUBLE) * 100.0::DOUBLE', 2)}
           AS revenue_mom_pct,
       {rounded('sum(revenue) OVER (ORDER BY year_month ROWS UNBOUNDED PRECEDING)', 2)} AS revenue_cumulative,
       {rounded('CAST(sum(revenue) OVER w3 AS DOUBLE) / count(*) OVER w3', 2)} AS revenue_3m_moving_avg
FROM m WINDOW w3 AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")

add("q02_top_categories", "fact_order_items dim_product", f"""
WITH c AS (
    SELECT p.category, sum(i.price) AS revenue, count(DISTINCT i.order_id) AS orders,
           {avg_scaled('i.freight_share', 4)} AS fs
    FROM fact_order_items i JOIN dim_product p USING (product_id) WHERE i.is_sale GROUP BY 1)
SELECT rank() OVER (ORDER BY revenue DESC) AS rank, category, orders,
       {rounded('CAST(revenue AS DOUBLE)', 2)} AS revenue,
       {rounded('CAST(revenue AS DOUBLE) * 100.0::DOUBLE / CAST(sum(revenue) OVER () AS DOUBLE)', 2)}
           AS revenue_share_pct,
       {rounded('CAST(sum(revenue) OVER (ORDER BY revenue DESC, category ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(revenue) OVER () AS DOUBLE)', 2)}
           AS cumulative_share_pct,
       {rounded('fs * 100.0::DOUBLE', 1)} AS avg_freight_share_pct
FROM c ORDER BY c.revenue DESC, category LIMIT 15
""")

add("q03_revenue_by_state", "fact_orders dim_state", f"""
SELECT c.state, c.region, count(*) AS orders, count(DISTINCT o.customer_unique_id) AS customers,
       {rounded('CAST(sum(items_price) AS DOUBLE)', 2)} AS revenue,
       {rounded(avg_money('items_price'), 2)} AS aov,
       {rounded(avg_money('freight_total'), 2)} AS avg_freight,
       {rounded('CAST(sum(items_price) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(sum(items_price)) OVER () AS DOUBLE)', 2)}
           AS revenue_share_pct
FROM fact_orders o JOIN dim_state c USING (customer_unique_id)
WHERE o.is_sale AND o.has_items GROUP BY 1, 2
""")

add("q04_repeat_customers", "fact_orders", f"""
WITH p AS (
    SELECT customer_unique_id, items_price, customer_order_seq AS seq, order_purchase_timestamp AS ts,
           lead(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id
               ORDER BY order_purchase_timestamp, order_id) AS nxt
    FROM fact_orders WHERE is_sale AND has_items),
c AS (
    SELECT customer_unique_id, count(*) AS orders, sum(items_price) AS revenue,
           min(CASE WHEN seq = 1 THEN datediff('day', CAST(ts AS DATE), CAST(nxt AS DATE)) END) AS gap
    FROM p GROUP BY 1)
SELECT count(*) AS customers, count(*) FILTER (WHERE orders >= 2) AS repeat_customers,
       {rounded('CAST(count(*) FILTER (WHERE orders >= 2) AS DOUBLE) * 100.0::DOUBLE / count(*)', 2)}
           AS repeat_customer_pct,
       {rounded('CAST(sum(revenue) AS DOUBLE) / sum(orders)', 2)} AS aov,
       {rounded('CAST(sum(revenue) FILTER (WHERE orders = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE orders = 1), 0)', 2)}
           AS avg_revenue_one_time,
       {rounded('CAST(sum(revenue) FILTER (WHERE orders >= 2) AS DOUBLE) / nullif(count(*) FILTER (WHERE orders >= 2), 0)', 2)}
           AS avg_revenue_repeat,
       {rounded('CAST(sum(revenue) FILTER (WHERE orders >= 2) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(revenue) AS DOUBLE)', 2)}
           AS repeat_revenue_share_pct,
       CAST(quantile_cont(gap, 0.5) AS DOUBLE) AS median_days_to_2nd_purchase
FROM c
""")

add("q05_delivery_by_state", "fact_orders dim_state", f"""
WITH s AS (
    SELECT c.state, count(*) AS n, {avg_scaled('delivery_days', 2)} AS dd, {avg_scaled('promised_days', 2)} AS pd,
           CAST(count(*) FILTER (WHERE is_late) AS DOUBLE) / count(*) AS late,
           {avg_scaled('review_score')} AS review
    FROM fact_orders o JOIN dim_state c USING (customer_unique_id)
    WHERE is_delivered GROUP BY 1 HAVING count(*) >= 100)
SELECT dense_rank() OVER (ORDER BY late DESC) AS late_rank, state, n AS delivered_orders,
       {rounded('dd', 1)} AS avg_delivery_days, {rounded('pd', 1)} AS avg_promised_days,
       {rounded('late * 100.0::DOUBLE', 2)} AS late_pct, {rounded('review', 2)} AS avg_review
FROM s
""")

add("q06_delay_vs_review", "fact_orders", f"""
SELECT CASE WHEN delay_days <= -10 THEN '1. 10+ days early' WHEN delay_days <= -1 THEN '2. 1-9 days early'
            WHEN delay_days = 0 THEN '3. On the promised day' WHEN delay_days <= 3 THEN '4. 1-3 days late'
            WHEN delay_days <= 7 THEN '5. 4-7 days late' ELSE '6. 8+ days late' END AS delivery_bucket,
       count(*) AS orders, {rounded(avg_scaled('review_score'), 2)} AS avg_review,
       {rounded('CAST(count(*) FILTER (WHERE review_score <= 2) AS DOUBLE) / count(*) * 100.0::DOUBLE', 1)}
           AS negative_review_pct,
       {rounded('CAST(count(*) FILTER (WHERE review_score = 5) AS DOUBLE) / count(*) * 100.0::DOUBLE', 1)}
           AS five_star_pct
FROM fact_orders WHERE is_delivered AND has_review GROUP BY 1
""")

add("q07_payments", "fact_orders", f"""
WITH b AS (
    SELECT main_payment_type, items_price,
           CASE WHEN main_payment_type <> 'credit_card' THEN 'n/a (not credit card)'
                WHEN max_installments = 1 THEN '01 installment' WHEN max_installments <= 3 THEN '02-03 installments'
                WHEN max_installments <= 6 THEN '04-06 installments' ELSE '07+ installments' END
               AS installment_bucket
    FROM fact_orders WHERE is_sale AND has_items AND main_payment_type IS NOT NULL)
SELECT main_payment_type, installment_bucket, count(*) AS orders,
       {rounded('CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(count(*)) OVER () AS DOUBLE)', 2)}
           AS order_share_pct,
       {rounded(avg_money('items_price'), 2)} AS aov,
       {rounded('quantile_cont(CAST(items_price AS DOUBLE), 0.5)', 2)} AS median_ticket
FROM b GROUP BY 1, 2
""")

add("q08_seller_risk", "fact_order_items dim_seller", f"""
WITH so AS (
    SELECT DISTINCT seller_id, order_id, review_score, is_late, is_delivered
    FROM fact_order_items WHERE is_sale AND NOT is_multi_seller),
st AS (
    SELECT seller_id, max(d.state) AS state, count(*) AS orders, {avg_scaled('review_score')} AS review,
           CAST(count(*) FILTER (WHERE review_score <= 2) AS DOUBLE) AS neg, count(review_score) AS rated,
           CAST(count(*) FILTER (WHERE is_delivered AND is_late) AS DOUBLE) AS late,
           count(*) FILTER (WHERE is_delivered) AS delivered
    FROM so JOIN dim_seller d USING (seller_id) GROUP BY 1),
r AS (SELECT seller_id, sum(price) AS revenue FROM fact_order_items WHERE is_sale GROUP BY 1),
p AS (SELECT {avg_scaled('review_score')} AS platform FROM so)
SELECT st.seller_id, state, orders, {rounded('CAST(revenue AS DOUBLE)', 2)} AS revenue,
       {rounded('review', 2)} AS avg_review, {rounded('platform', 2)} AS platform_avg_review,
       {rounded('neg * 100.0::DOUBLE / nullif(rated, 0)', 1)} AS negative_review_pct,
       {rounded('late * 100.0::DOUBLE / nullif(delivered, 0)', 1)} AS late_pct,
       ntile(4) OVER (ORDER BY orders DESC, st.seller_id) AS volume_quartile_among_flagged
FROM st JOIN r USING (seller_id) CROSS JOIN p
WHERE orders >= 5 AND review < platform - 0.3::DOUBLE
""")

add("q09_seller_concentration", "fact_order_items", f"""
WITH s AS (SELECT seller_id, sum(price) AS revenue FROM fact_order_items WHERE is_sale GROUP BY 1),
c AS (
    SELECT row_number() OVER (ORDER BY revenue DESC, seller_id) AS rn, count(*) OVER () AS n,
           sum(revenue) OVER (ORDER BY revenue DESC, seller_id ROWS UNBOUNDED PRECEDING) AS upto,
           sum(revenue) OVER () AS total
    FROM s)
SELECT max(n) AS sellers, min(rn) FILTER (WHERE upto * 10 >= total * 5) AS sellers_for_50pct_revenue,
       min(rn) FILTER (WHERE upto * 10 >= total * 8) AS sellers_for_80pct_revenue,
       {rounded('CAST(min(rn) FILTER (WHERE upto * 10 >= total * 8) AS DOUBLE) * 100.0::DOUBLE / max(n)', 2)}
           AS pct_sellers_for_80pct_revenue
FROM c
""")

# ---------------------------------------------------------------- star tables
_STAR = {
    "fact_orders": """order_id customer_unique_id date_key purchase_date order_purchase_timestamp order_status
        is_sale has_items is_delivered is_late is_multi_seller is_repeat_purchase customer_order_seq
        items_count products_count sellers_count items_price freight_total order_value payment_total
        main_payment_type payment_methods max_installments is_installment used_voucher installment_bucket
        installment_bucket_order order_approved_at order_delivered_carrier_date order_delivered_customer_date
        order_estimated_delivery_date approval_hours carrier_lead_days last_mile_days delivery_days promised_days
        delay_days delivery_bucket delivery_bucket_order flag_carrier_before_approval
        flag_delivered_before_carrier has_review review_score review_count has_comment review_response_hours""",
    "fact_order_items": """order_id order_item_id product_id seller_id customer_unique_id date_key purchase_date
        shipping_limit_date price freight_value item_total freight_share freight_gt_price order_status is_sale
        is_delivered is_late delivery_days review_score is_multi_seller""",
    "dim_customer": """customer_unique_id zip_code_prefix city state region lat lng geo_source first_purchase_date
        last_purchase_date lifetime_orders lifetime_revenue is_repeat_customer""",
    "dim_product": """product_id category category_pt product_weight_g product_length_cm product_height_cm
        product_width_cm product_volume_cm3 product_photos_qty product_name_length product_description_length""",
    "dim_seller": "seller_id seller_label zip_code_prefix city state region lat lng geo_source",
    "dim_date": """date date_key year quarter year_quarter month_num month_name month_short year_month
        year_month_num month_start iso_week day_of_week_num day_name is_weekend is_complete_month""",
}
for _name, _columns in _STAR.items():
    add(_name, _name, f"SELECT {plain(_columns.split())} FROM {_name}")

add("monthly_orders", "monthly_orders", f"SELECT {plain(['month'])}, orders, share_of_median, incomplete "
                                        "FROM monthly_orders")
