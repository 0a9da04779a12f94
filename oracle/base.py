"""Common table expressions of the oracle: test tables -> raw tables -> cleaned tables -> star.

They say in plain SQL what the package computes, with ordinary windows and quantiles and no scale measures.
"""
from __future__ import annotations

STATES = "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO".split()
REGIONS = {
    "North": "AC AP AM PA RO RR TO", "Northeast": "AL BA CE MA PB PE PI RN SE", "Center-West": "DF GO MT MS",
    "Southeast": "ES MG RJ SP", "South": "PR RS SC",
}


def state_of(key: str) -> str:
    return f"([{', '.join(repr(s) for s in STATES)}])[{key} + 1]"


def region_of(state: str) -> str:
    arms = " ".join(f"WHEN {state} IN ({', '.join(repr(s) for s in v.split())}) THEN '{k}'"
                    for k, v in REGIONS.items())
    return f"CASE {arms} END"


def half_even(x: str, places: int) -> str:
    """Round a double the way numpy does."""
    scale = f"{10 ** places}::DOUBLE"
    y = f"(CAST({x} AS DOUBLE) * {scale})"
    return (f"(CASE WHEN abs({y} - trunc({y})) = 0.5::DOUBLE THEN 2::DOUBLE * round({y} / 2::DOUBLE) "
            f"ELSE round({y}) END / {scale})")


def fold(x: str) -> str:
    """City spelling on the letters that occur in the test data: lower case, no accents, single blanks."""
    return (f"regexp_replace(regexp_replace(strip_accents(trim(lower({x}))), '[^\\x00-\\x7F]', '', 'g'), "
            "'\\s+', ' ', 'g')")


def secs(a: str, b: str) -> str:
    return f"CAST(epoch({b}) - epoch({a}) AS BIGINT)"


def days(a: str, b: str) -> str:
    return f"(CAST({secs(a, b)} AS DOUBLE) / 86400::DOUBLE)"


def avg_money(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def avg_scaled(x: str, places: int = 0) -> str:
    scale = f"{10 ** places}::DOUBLE"
    return (f"CAST(sum(CAST(round(CAST({x} AS DOUBLE) * {scale}) AS BIGINT)) AS DOUBLE) "
            f"/ (nullif(count({x}), 0) * {scale})")


def rounded(x: str, places: int) -> str:
    """ROUND over a numeric with three places, as a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(18,3)), {places}) AS DOUBLE)"


CENTS = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)"
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
FREIGHT = (f"CAST({PRICE} * CAST(CAST(l_tax AS DECIMAL(4,2)) + CASE WHEN l_quantity <= 1 THEN 1 ELSE 0 END "
           "AS DECIMAL(4,2)) AS DECIMAL(18,4))")
CATEGORY = ("CASE WHEN p_name = 'red gear' THEN 'pc_gamer' "
            "ELSE lower(p_type) || '_' || split_part(p_name, ' ', -1) END")

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    _CTES[name] = (tuple(needs.split()), body)


# ---------------------------------------------------------------- raw tables
cte("raw_orders", "", f"""
    SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'canceled'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'unavailable'
                WHEN o_orderstatus = 'P' THEN 'processing'
                WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'shipped'
                WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'in_transit'
                ELSE 'delivered' END AS order_status,
           bought AS order_purchase_timestamp,
           CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'
                THEN bought + to_seconds(cents % 7200 - 60) END AS order_approved_at,
           CASE WHEN o_orderstatus <> 'P' THEN bought + to_seconds((cents % 500) * 1000 - 10000) END
               AS order_delivered_carrier_date,
           CASE WHEN o_totalprice < 20000 THEN NULL
                WHEN o_totalprice > 495000 THEN bought - INTERVAL 1 DAY
                WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
                THEN bought + to_seconds(cents % 91 * 86400 + cents % 5000) END AS order_delivered_customer_date,
           o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
    FROM (SELECT *, {CENTS} AS cents, CAST(o_orderdate AS TIMESTAMP) + to_seconds({CENTS} % 86400) AS bought
          FROM orders) x""")
cte("raw_items", "", f"""
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
           CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date, CAST({PRICE} AS DECIMAL(18,4)) AS price,
           {FREIGHT} AS freight_value
    FROM lineitem""")
cte("raw_payments", "", f"""
    SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
           CASE WHEN l_returnflag = 'A' THEN 'credit_card'
                WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'boleto'
                WHEN l_returnflag = 'N' THEN 'voucher'
                WHEN l_linestatus = 'F' THEN 'debit_card'
                WHEN l_tax > 0 THEN 'credit_card' ELSE 'not_defined' END AS payment_type,
           CAST(l_quantity AS INTEGER) % 26 AS payment_installments,
           CAST(CAST({PRICE} AS DECIMAL(18,4)) + {FREIGHT}
                + (CAST(l_discount AS DECIMAL(4,2)) - CAST(0.05 AS DECIMAL(4,2))) * 10 AS DECIMAL(18,4))
               AS payment_value
    FROM lineitem""")
cte("raw_reviews", "", f"""
    SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS review_id, o_orderkey AS order_id,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score,
           CAST(NULL AS VARCHAR) AS review_comment_title,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS review_comment_message,
           CAST(o_orderdate AS TIMESTAMP) + INTERVAL 30 DAY AS review_creation_date,
           CAST(o_orderdate AS TIMESTAMP) + to_seconds(30 * 86400 + {CENTS} % 400000) AS review_answer_timestamp
    FROM orders WHERE o_orderstatus <> 'O' OR o_orderpriority <> '4-NOT SPECIFIED'
    UNION ALL
    SELECT 'p' || CAST(l_partkey AS VARCHAR), l_orderkey, 1 + l_linenumber % 5,
           CASE WHEN l_linestatus = 'F' THEN 'returned' END, NULL, CAST(l_shipdate AS TIMESTAMP),
           CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_quantity AS INTEGER))
    FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40""")
cte("raw_customers", "", f"""
    SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id,
           lpad(CAST(c_nationkey * 1000 + day(o_orderdate) % 12 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           'São  ' || c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) AS customer_city,
           {state_of('c_nationkey')} AS customer_state
    FROM orders JOIN customer ON o_custkey = c_custkey""")
cte("raw_products", "", f"""
    SELECT p_partkey AS product_id, CASE WHEN p_size <> 1 THEN {CATEGORY} END AS product_category_name,
           CASE WHEN p_size <> 1 THEN length(p_name) END AS product_name_lenght,
           CASE WHEN p_size <> 1 THEN p_size * 20 END AS product_description_lenght,
           CASE WHEN p_size <> 1 THEN p_size % 7 END AS product_photos_qty,
           CASE WHEN p_size = 2 THEN 0 WHEN p_size <> 3 THEN p_size * 100 END AS product_weight_g,
           CASE WHEN p_size <> 3 THEN p_size + 10 END AS product_length_cm,
           CASE WHEN p_size <> 3 THEN p_size + 5 END AS product_height_cm,
           CASE WHEN p_size <> 3 THEN p_size * 2 END AS product_width_cm
    FROM part""")
cte("raw_translation", "", f"""
    SELECT DISTINCT {CATEGORY} AS product_category_name, 'all_' || {CATEGORY} AS product_category_name_english
    FROM part WHERE p_type <> 'PROMO' AND p_name <> 'red gear'""")
cte("raw_sellers", "", f"""
    SELECT s_suppkey AS seller_id,
           lpad(CAST(s_nationkey * 1000 + s_suppkey % 12 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           '  São Building ' || CAST(s_nationkey AS VARCHAR) || ' ' AS seller_city,
           {state_of('s_nationkey')} AS seller_state
    FROM supplier""")
cte("raw_geo", "", f"""
    SELECT lpad(CAST(c_nationkey * 1000 + ((step % 10) + 10) % 10 AS VARCHAR), 5, '0')
               AS geolocation_zip_code_prefix,
           step / 10::DOUBLE - 34::DOUBLE AS geolocation_lat,
           -28.5::DOUBLE - ((step * 7 % 460) + 460) % 460 / 10::DOUBLE AS geolocation_lng,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Máquinas'
                ELSE 'SÃO ' || c_mktsegment || '   ' || CAST(c_nationkey AS VARCHAR) END AS geolocation_city,
           {state_of('c_nationkey')} AS geolocation_state
    FROM (SELECT *, CAST(floor(c_acctbal / 25) AS INTEGER) AS step FROM customer) x""")

# ---------------------------------------------------------------- cleaned tables
cte("geo_points", "raw_geo", """
    SELECT DISTINCT * FROM raw_geo
    WHERE geolocation_lat BETWEEN -33.75 AND 5.27 AND geolocation_lng BETWEEN -73.99 AND -28.84""")
cte("zip_coords", "geo_points", """
    SELECT geolocation_zip_code_prefix AS zip_code_prefix, quantile_cont(geolocation_lat, 0.5) AS lat,
           quantile_cont(geolocation_lng, 0.5) AS lng
    FROM geo_points GROUP BY 1""")
cte("city_coords", "geo_points", f"""
    SELECT {fold('geolocation_city')} AS city_norm, geolocation_state AS state,
           quantile_cont(geolocation_lat, 0.5) AS lat, quantile_cont(geolocation_lng, 0.5) AS lng
    FROM geo_points GROUP BY 1, 2""")
cte("c_orders", "raw_orders", f"""
    SELECT *, CASE WHEN is_delivered THEN coalesce(delay_days > 0, FALSE) END AS is_late
    FROM (SELECT *,
        CASE WHEN is_delivered THEN {half_even(days('order_purchase_timestamp', 'order_delivered_customer_date'), 2)}
             END AS delivery_days,
        CASE WHEN order_approved_at >= order_purchase_timestamp
             THEN {half_even(days('order_purchase_timestamp', 'order_approved_at') + ' * 24::DOUBLE', 2)}
             END AS approval_hours,
        CASE WHEN NOT flag_carrier_before_approval
             THEN {half_even(days('order_approved_at', 'order_delivered_carrier_date'), 2)} END AS carrier_lead_days,
        CASE WHEN is_delivered AND NOT flag_delivered_before_carrier
             THEN {half_even(days('order_delivered_carrier_date', 'order_delivered_customer_date'), 2)}
             END AS last_mile_days,
        {half_even(days('order_purchase_timestamp', 'order_estimated_delivery_date'), 2)} AS promised_days,
        CASE WHEN is_delivered THEN datediff('day', CAST(order_estimated_delivery_date AS DATE),
                                             CAST(order_delivered_customer_date AS DATE)) END AS delay_days,
        CAST(order_purchase_timestamp AS DATE) AS purchase_date
    FROM (SELECT *,
        coalesce(order_delivered_carrier_date < order_approved_at, FALSE) AS flag_carrier_before_approval,
        coalesce(order_delivered_customer_date < order_delivered_carrier_date, FALSE)
            AS flag_delivered_before_carrier,
        order_status NOT IN ('canceled', 'unavailable') AS is_sale,
        coalesce(order_status = 'delivered' AND order_delivered_customer_date >= order_purchase_timestamp, FALSE)
            AS is_delivered
    FROM raw_orders) a) b""")
cte("c_items", "raw_items raw_orders", f"""
    SELECT i.* EXCLUDE (shipping_limit_date),
           CASE WHEN floor({days('o.order_purchase_timestamp', 'i.shipping_limit_date')}) BETWEEN 0 AND 60
                THEN i.shipping_limit_date END AS shipping_limit_date,
           CAST(price + freight_value AS DECIMAL(18,4)) AS item_total,
           freight_value > price AS freight_gt_price,
           {half_even('CAST(freight_value AS DOUBLE) / nullif(CAST(price + freight_value AS DOUBLE), 0)', 4)}
               AS freight_share
    FROM raw_items i LEFT JOIN raw_orders o USING (order_id)""")
cte("c_payments", "raw_payments", """
    SELECT p.order_id, sum(payment_value) AS payment_total, count(payment_sequential) AS payment_rows,
           count(DISTINCT payment_type) AS payment_methods,
           max(CASE WHEN payment_installments = 0 THEN 1 ELSE payment_installments END) AS max_installments,
           bool_or(payment_type = 'voucher') AS used_voucher,
           min(CASE WHEN rn = 1 THEN payment_type END) AS main_payment_type
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id
              ORDER BY payment_value DESC, payment_sequential, payment_type DESC) AS rn FROM raw_payments) p
    GROUP BY 1""")
cte("c_reviews", "raw_reviews", f"""
    SELECT order_id, review_score, review_comment_message IS NOT NULL OR review_comment_title IS NOT NULL
               AS has_comment, review_creation_date, review_answer_timestamp, review_count,
           {half_even('CAST(' + secs('review_creation_date', 'review_answer_timestamp') + ' AS DOUBLE) / 3600::DOUBLE', 1)}
               AS review_response_hours
    FROM (SELECT *, count(*) OVER (PARTITION BY order_id) AS review_count,
                 row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date DESC,
                     review_answer_timestamp DESC, review_id DESC, review_score DESC,
                     coalesce(review_comment_title, '') DESC) AS rn
          FROM (SELECT DISTINCT * FROM raw_reviews) d) x
    WHERE rn = 1""")
cte("c_products", "raw_products raw_translation", """
    SELECT product_id, coalesce(product_category_name, 'unknown') AS category_pt,
           (SELECT string_agg(upper(w[1]) || w[2:], ' ' ORDER BY pos)
            FROM (SELECT unnest(string_split(replace(english, '_', ' '), ' ')) AS w,
                         generate_subscripts(string_split(replace(english, '_', ' '), ' '), 1) AS pos) parts)
               AS category,
           nullif(product_weight_g, 0) AS product_weight_g, product_length_cm, product_height_cm, product_width_cm,
           CAST(product_length_cm * product_height_cm * product_width_cm AS DOUBLE) AS product_volume_cm3,
           product_photos_qty, product_name_lenght AS product_name_length,
           product_description_lenght AS product_description_length
    FROM (SELECT p.*, CASE WHEN p.product_category_name = 'pc_gamer' THEN 'pc_gamer'
                           ELSE coalesce(t.product_category_name_english, 'unknown') END AS english
          FROM raw_products p LEFT JOIN raw_translation t USING (product_category_name)) x""")


def _placed(source: str, zip_col: str, city: str, state: str) -> str:
    return f"""
    SELECT x.*, {half_even('coalesce(z.lat, c.lat)', 6)} AS lat,
           {half_even('CASE WHEN z.lat IS NOT NULL THEN z.lng ELSE c.lng END', 6)} AS lng,
           CASE WHEN z.lat IS NOT NULL THEN 'zip' WHEN c.lat IS NOT NULL THEN 'city_centroid'
                ELSE 'missing' END AS geo_source
    FROM {source} x LEFT JOIN zip_coords z ON z.zip_code_prefix = x.{zip_col}
         LEFT JOIN city_coords c ON c.city_norm = x.{city} AND c.state = x.{state}"""


cte("person_address", "raw_customers raw_orders", f"""
    SELECT customer_unique_id, customer_zip_code_prefix AS zip_code_prefix, {fold('customer_city')} AS city,
           customer_state AS state
    FROM (SELECT c.*, row_number() OVER (PARTITION BY customer_unique_id
              ORDER BY order_purchase_timestamp DESC, c.customer_id DESC) AS rn
          FROM raw_customers c LEFT JOIN raw_orders o ON o.customer_id = c.customer_id) x
    WHERE rn = 1""")
cte("c_customers", "person_address zip_coords city_coords",
    _placed("person_address", "zip_code_prefix", "city", "state"))
cte("seller_address", "raw_sellers", f"""
    SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, {fold('seller_city')} AS city,
           seller_state AS state
    FROM raw_sellers""")
cte("c_sellers", "seller_address zip_coords city_coords",
    _placed("seller_address", "zip_code_prefix", "city", "state"))

# ---------------------------------------------------------------- star
cte("monthly", "raw_orders", """
    SELECT m.month, coalesce(n, 0) AS orders
    FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', order_purchase_timestamp)),
                      max(date_trunc('month', order_purchase_timestamp)), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM raw_orders) m
    LEFT JOIN (SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(*) AS n
               FROM raw_orders GROUP BY 1) c USING (month)""")
cte("monthly_orders", "monthly", """
    SELECT month, orders, CAST(orders AS DOUBLE) / typical AS share_of_median,
           CAST(orders AS DOUBLE) / typical < 0.1::DOUBLE AS incomplete
    FROM monthly, (SELECT quantile_cont(orders, 0.5) AS typical FROM monthly) t""")
cte("item_sums", "raw_items", """
    SELECT order_id, count(order_item_id) AS items_count, count(DISTINCT product_id) AS products_count,
           count(DISTINCT seller_id) AS sellers_count,
           CAST(round_even(CAST(sum(price) AS DECIMAL(18,4)), 2) AS DECIMAL(18,4)) AS items_price,
           CAST(round_even(CAST(sum(freight_value) AS DECIMAL(18,4)), 2) AS DECIMAL(18,4)) AS freight_total
    FROM raw_items GROUP BY 1""")


def _band(x: str, bands: list[tuple[str, object]], default: object) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else f"'{v}'"
    return "CASE " + " ".join(f"WHEN {x} {cond} THEN {lit(v)}" for cond, v in bands) + f" ELSE {lit(default)} END"


_DELAY = ["<= -10", "<= -1", "<= 0", "<= 3", "<= 7"]
_DELAY_LABEL = ["10+ days early", "1-9 days early", "On promised day", "1-3 days late", "4-7 days late",
                "8+ days late"]
_INST = ["<= 1", "<= 3", "<= 6"]
_INST_LABEL = ["1", "2-3", "4-6", "7+"]
cte("fact_orders", "c_orders raw_customers item_sums c_payments c_reviews", f"""
    SELECT o.*, f.customer_unique_id, CAST(strftime(purchase_date, '%Y%m%d') AS INTEGER) AS date_key,
           i.order_id IS NOT NULL AS has_items, coalesce(items_count, 0) AS items_count,
           coalesce(products_count, 0) AS products_count, coalesce(sellers_count, 0) AS sellers_count,
           coalesce(items_price, 0) AS items_price, coalesce(freight_total, 0) AS freight_total,
           CAST(coalesce(items_price, 0) + coalesce(freight_total, 0) AS DECIMAL(18,4)) AS order_value,
           coalesce(sellers_count, 0) > 1 AS is_multi_seller,
           CAST(round_even(CAST(payment_total AS DECIMAL(18,4)), 2) AS DECIMAL(18,4)) AS payment_total,
           main_payment_type, payment_methods, max_installments, max_installments > 1 AS is_installment,
           used_voucher,
           CASE WHEN main_payment_type = 'credit_card'
                THEN {_band('max_installments', list(zip(_INST, _INST_LABEL)), '7+')}
                WHEN main_payment_type IS NOT NULL THEN 'Not credit card' END AS installment_bucket,
           CASE WHEN main_payment_type = 'credit_card'
                THEN {_band('max_installments', [(c, k + 1) for k, c in enumerate(_INST)], 4)}
                WHEN main_payment_type IS NOT NULL THEN 9 END AS installment_bucket_order,
           CASE WHEN delay_days IS NOT NULL
                THEN {_band('delay_days', list(zip(_DELAY, _DELAY_LABEL)), _DELAY_LABEL[-1])} END AS delivery_bucket,
           CASE WHEN delay_days IS NOT NULL
                THEN {_band('delay_days', [(c, k + 1) for k, c in enumerate(_DELAY)], 6)} END
               AS delivery_bucket_order,
           review_score IS NOT NULL AS has_review, review_score, coalesce(review_count, 0) AS review_count,
           has_comment, review_response_hours, customer_order_seq, customer_order_seq > 1 AS is_repeat_purchase
    FROM c_orders o
    LEFT JOIN raw_customers f ON f.customer_id = o.customer_id
    LEFT JOIN item_sums i ON i.order_id = o.order_id
    LEFT JOIN c_payments p ON p.order_id = o.order_id
    LEFT JOIN c_reviews r ON r.order_id = o.order_id
    LEFT JOIN (SELECT a.order_id, row_number() OVER (PARTITION BY b.customer_unique_id
                   ORDER BY a.order_purchase_timestamp, a.order_id) AS customer_order_seq
               FROM c_orders a JOIN raw_customers b ON b.customer_id = a.customer_id WHERE a.is_sale) s
           ON s.order_id = o.order_id""")
cte("fact_order_items", "c_items fact_orders", """
    SELECT i.*, f.customer_unique_id, f.date_key, f.purchase_date, f.order_status, f.is_sale, f.is_delivered,
           f.is_late, f.delivery_days, f.review_score, f.is_multi_seller
    FROM c_items i LEFT JOIN fact_orders f ON f.order_id = i.order_id""")
cte("dim_customer", "c_customers fact_orders", f"""
    SELECT c.*, {region_of('state')} AS region, first_purchase_date, last_purchase_date,
           coalesce(n, 0) AS lifetime_orders, coalesce(revenue, 0) AS lifetime_revenue,
           coalesce(n, 0) >= 2 AS is_repeat_customer
    FROM c_customers c LEFT JOIN (
        SELECT customer_unique_id, min(purchase_date) AS first_purchase_date, max(purchase_date) AS last_purchase_date,
               count(*) AS n, CAST(sum(items_price) AS DECIMAL(18,4)) AS revenue
        FROM fact_orders WHERE is_sale GROUP BY 1) s USING (customer_unique_id)""")
cte("dim_state", "person_address", f"SELECT *, {region_of('state')} AS region FROM person_address")
cte("dim_product", "c_products", "SELECT * FROM c_products")
cte("dim_seller", "c_sellers", f"""
    SELECT *, {region_of('state')} AS region, 'S-' || upper(substr(CAST(seller_id AS VARCHAR), 1, 6)) AS seller_label
    FROM c_sellers""")
cte("dim_date", "raw_orders monthly_orders", """
    SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d) AS year,
           'Q' || quarter(d) AS quarter, year(d) || '-Q' || quarter(d) AS year_quarter, month(d) AS month_num,
           strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, strftime(d, '%Y-%m') AS year_month,
           year(d) * 100 + month(d) AS year_month_num, CAST(date_trunc('month', d) AS DATE) AS month_start,
           weekofyear(d) AS iso_week, isodow(d) AS day_of_week_num, strftime(d, '%A') AS day_name,
           isodow(d) >= 6 AS is_weekend,
           CAST(date_trunc('month', d) AS DATE) IN (SELECT month FROM monthly_orders WHERE NOT incomplete)
               AS is_complete_month
    FROM (SELECT CAST(unnest(generate_series(
              CAST(year(min(order_purchase_timestamp)) || '-01-01' AS DATE),
              CAST(year(max(order_purchase_timestamp)) || '-12-31' AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
          FROM raw_orders) x""")


def definition(name: str) -> str:
    return _CTES[name][1]


def with_ctes(body: str, needs: str) -> str:
    """``body`` preceded by the named expressions and everything they rest on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _CTES[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs.split():
        visit(name)
    parts = [f"{name} AS ({_CTES[name][1]}\n)" for name in ordered]
    body = body.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
