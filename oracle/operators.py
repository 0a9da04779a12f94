"""Oracle SQL of cleaning treatments, integrity, documentation and single operators."""
from __future__ import annotations

from .base import avg_money, avg_scaled, days, definition, half_even, rounded, secs, with_ctes
from .checks import RAW
from .measures import div
from .queries import _STAR, add, plain
from .texts import COLUMNS, TABLES, TYPES

_ORDERS = RAW["orders"][1].split()
_EXTRA = ("flag_carrier_before_approval flag_delivered_before_carrier is_sale is_delivered delivery_days approval_hours "
          "carrier_lead_days last_mile_days promised_days delay_days is_late purchase_date").split()
add("cl_order_durations", "c_orders", f"SELECT {plain(_ORDERS + _EXTRA)} FROM c_orders")
add("cl_item_features", "c_items", f"SELECT {plain(RAW['order_items'][1].split())}, "
    f"{plain(['item_total'])}, freight_gt_price, freight_share FROM c_items")
add("cl_main_payment", "c_payments", "SELECT order_id, CAST(payment_total AS DOUBLE) AS payment_total, payment_rows, "
    "payment_methods, max_installments, used_voucher, main_payment_type FROM c_payments")
add("cl_latest_per_key", "c_reviews", "SELECT order_id, review_score, has_comment, review_count, review_response_hours, "
    + plain(["review_creation_date", "review_answer_timestamp"]) + " FROM c_reviews")
add("cl_entity_latest_address", "raw_customers raw_orders", """
SELECT customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
FROM (SELECT c.*, row_number() OVER (PARTITION BY customer_unique_id
          ORDER BY order_purchase_timestamp DESC NULLS FIRST, c.customer_id DESC) AS rn
      FROM raw_customers c LEFT JOIN raw_orders o ON o.customer_id = c.customer_id) x WHERE rn = 1""")
add("cl_median_fallback", "zip_coords city_coords", f"""
SELECT place, {half_even('lat', 6)} AS lat, {half_even('lng', 6)} AS lng FROM (
    SELECT zip_code_prefix AS place, lat, lng FROM zip_coords
    UNION ALL SELECT state || '/' || city_norm, lat, lng FROM city_coords) x""")
add("cl_category_map", "c_products", "SELECT product_id, category_pt AS product_category_name, category, "
    "product_weight_g, product_length_cm, product_height_cm, product_width_cm, product_volume_cm3, product_photos_qty, "
    "product_name_length, product_description_length FROM c_products")

# ---------------------------------------------------------------- cleaning log
_LOG = [
    ("geolocation", "Drop exact duplicate rows", "A copy would only weigh its point twice in the median",
     "(SELECT count(*) FROM raw_geo) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_geo) d)"),
    ("geolocation", "Drop coordinates outside the bounding box", "No address can lie there",
     "(SELECT count(*) FROM (SELECT DISTINCT * FROM raw_geo) d) - (SELECT count(*) FROM geo_points)"),
    ("geolocation", "Aggregate to 1 row per zip prefix (median lat/lng)",
     "Joins need one place per prefix, and a median ignores stray points",
     "(SELECT count(*) FROM geo_points) - (SELECT count(*) FROM zip_coords)"),
    ("orders", "Delivered status without delivery date -> not delivered",
     "Without the date no duration can be taken",
     "(SELECT count(*) FROM c_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL)"),
    ("orders", "Flag: handed to carrier before approval", "That one interval is left NULL; the order stays",
     "(SELECT count(*) FROM c_orders WHERE flag_carrier_before_approval)"),
    ("orders", "Flag: delivered before carrier pickup", "That one interval is left NULL; the order stays in",
     "(SELECT count(*) FROM c_orders WHERE flag_delivered_before_carrier)"),
    ("order_items", "Implausible shipping_limit_date -> NULL", "Sellers never get a negative span or more than two months",
     "(SELECT count(*) FROM c_items WHERE shipping_limit_date IS NULL)"),
    ("order_items", "Flag: freight greater than price", "Nothing is changed; the mark lets reports pick such items out",
     "(SELECT count(*) FROM c_items WHERE freight_gt_price)"),
    ("order_payments", "Installments = 0 -> 1", "Zero parts cannot add up to an amount",
     "(SELECT count(*) FROM raw_payments WHERE payment_installments = 0)"),
    ("order_payments", "Keep ''not_defined'' payment type", "No money moved, so totals are not touched",
     "(SELECT count(*) FROM raw_payments WHERE payment_type = 'not_defined')"),
    ("order_payments", "Aggregate to 1 row per order", "One row per order keeps joins from multiplying amounts",
     "(SELECT count(*) - count(DISTINCT order_id) FROM raw_payments)"),
    ("order_reviews", "Keep latest review per order",
     "One opinion per order enters the mean, the newest one",
     "(SELECT count(*) - count(DISTINCT order_id) FROM (SELECT DISTINCT * FROM raw_reviews) d)"),
    ("products", "Missing category -> ''unknown''", "Their sales would drop out of every breakdown otherwise",
     "(SELECT count(*) FROM raw_products WHERE product_category_name IS NULL)"),
    ("products", "Manual translation of untranslated categories", "The lookup table has no row for them",
     "(SELECT count(*) FROM raw_products WHERE product_category_name = 'pc_gamer')"),
    ("products", "Weight = 0 g -> NULL", "Zero stands for a weight nobody entered",
     "(SELECT count(*) FROM raw_products WHERE product_weight_g = 0)"),
    ("customers", "Collapse customer_id -> customer_unique_id",
     "Every order brings a fresh customer_id; people are counted by the other key",
     "(SELECT count(*) - count(DISTINCT customer_unique_id) FROM raw_customers)"),
]
for _t, _v in (("customers", "c_customers"), ("sellers", "c_sellers")):
    _LOG.append((_t, "Zip without coordinates -> city centroid fallback", "A place in the right city beats no place",
                 f"(SELECT count(*) FROM {_v} WHERE geo_source = 'city_centroid')"))
    _LOG.append((_t, "No coordinates available (left NULL)", "Only maps lose these rows",
                 f"(SELECT count(*) FROM {_v} WHERE geo_source = 'missing')"))
add("cl_log", "raw_geo geo_points zip_coords c_orders c_items raw_payments raw_reviews raw_products raw_customers "
    "c_customers c_sellers", " UNION ALL ".join(
        f"SELECT {i} AS step, '{t}' AS \"table\", '{a}' AS action, {n} AS rows_affected, '{r}' AS rationale"
        for i, (t, a, r, n) in enumerate(_LOG)))

# ---------------------------------------------------------------- star checks and documentation
_PK = {"fact_orders": ["order_id"], "fact_order_items": ["order_id", "order_item_id"],
       "dim_customer": ["customer_unique_id"], "dim_product": ["product_id"], "dim_seller": ["seller_id"],
       "dim_date": ["date_key"]}
_REL = [("fact_orders", "customer_unique_id", "dim_customer"), ("fact_orders", "date_key", "dim_date"),
        ("fact_order_items", "customer_unique_id", "dim_customer"), ("fact_order_items", "date_key", "dim_date"),
        ("fact_order_items", "product_id", "dim_product"), ("fact_order_items", "seller_id", "dim_seller")]
_rows: list[tuple[str, str, str]] = []
for _t, _k in _PK.items():
    _name = "[" + ", ".join(f"''{c}''" for c in _k) + "]"
    _rows.append((f"{_t}: PK {_name} unique & not null",
                  f"(SELECT count(*) = 0 FROM (SELECT 1 FROM {_t} GROUP BY {', '.join(_k)} HAVING count(*) > 1 OR "
                  f"{' OR '.join(f'any_value({c}) IS NULL' for c in _k)}) g)",
                  f"(SELECT format('{{:,}}', count(*)) || ' rows' FROM {_t})"))
for _t, _k, _dim in _REL:
    _n = f"(SELECT count(*) FROM {_t} WHERE {_k} IS NULL OR {_k} NOT IN (SELECT {_PK[_dim][0]} FROM {_dim}))"
    _rows.append((f"{_t}.{_k} -> {_dim}.{_PK[_dim][0]} (no orphans)", f"{_n} = 0", f"{_n} || ' orphans'"))
for _t, _raw, _what in (("fact_orders", "raw_orders", "order"), ("fact_order_items", "raw_items", "item")):
    _rows.append((f"{_t} keeps every raw {_what}", f"(SELECT count(*) FROM {_t}) = (SELECT count(*) FROM {_raw})",
                  f"(SELECT format('{{:,}}', count(*)) FROM {_raw})"))
for _text, _a, _b in (
        ("Revenue reconciles across facts (sum price)", "(SELECT sum(price) FROM fact_order_items)",
         "(SELECT sum(items_price) FROM fact_orders)"),
        ("Payments reconcile with raw table", "(SELECT sum(payment_total) FROM fact_orders)",
         "(SELECT sum(payment_value) FROM raw_payments)")):
    _a, _b = f"CAST({_a} AS DOUBLE)", f"CAST({_b} AS DOUBLE)"
    _rows.append((_text, f"abs({_a} - {_b}) <= 1e-8 + 1e-5 * abs({_b})",
                  f"format('{{:,.2f}}', {_a}) || ' vs ' || format('{{:,.2f}}', {_b})"))
add("star_integrity", " ".join(_STAR) + " raw_orders raw_items raw_payments", " UNION ALL ".join(
    f"SELECT {i} AS step, '{c}' AS \"check\", CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS result, {d} AS detail"
    for i, (c, ok, d) in enumerate(_rows)))


def _q(text: str) -> str:
    return text.replace("'", "''")


add("data_dictionary", " ".join(_STAR), " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {i} AS position, '{c}' AS \"column\", '{TYPES[c]}' AS type, "
    f"{half_even(f'CAST(count(*) - count({c}) AS DOUBLE) * 100.0::DOUBLE / count(*)', 2)} AS pct_null, "
    f"'{_q(COLUMNS[c])}' AS description FROM {t}"
    for t, cols in _STAR.items() for i, c in enumerate(cols.split())))
add("table_overview", " ".join(_STAR), " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{_q(g)}' AS grain, '{', '.join(_PK[t])}' AS primary_key, count(*) AS rows, "
    f"{len(_STAR[t].split())} AS columns, '{_q(p)}' AS purpose FROM {t}" for t, (g, p) in TABLES.items()))

# ---------------------------------------------------------------- single operators
_EP, _TP = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4))", \
    "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,4))"
add("agg_hash_group", "", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum({_EP}) AS DOUBLE) AS total,
       CAST(CAST(min(l_shipdate) AS TIMESTAMP) AS VARCHAR) AS first,
       CAST(CAST(max(l_shipdate) AS TIMESTAMP) AS VARCHAR) AS last, count(DISTINCT l_suppkey) AS suppliers,
       bool_or(l_quantity = 50) AS any_full FROM lineitem GROUP BY 1, 2""")
add("agg_distinct_rows", "", "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem")
add("agg_conditional", "", f"""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done,
       CAST(sum({_TP}) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS done_total,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS done_rate,
       min(CASE WHEN o_orderstatus = 'F' THEN datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) END)
           AS first_day FROM orders GROUP BY 1""")
add("agg_quantiles", "", "SELECT l_returnflag, count(*) AS n, max(l_extendedprice) AS max, " + ", ".join(
    half_even(f"quantile_cont(l_extendedprice, {p})", 4) + f" AS {n}"
    for n, p in (("q25", .25), ("q50", .5), ("q75", .75), ("q99", .99))) + " FROM lineitem GROUP BY 1")
add("agg_value_counts", "", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
add("agg_two_level", "", f"""
WITH p AS (SELECT o_custkey, count(*) AS n, sum({_TP}) AS total FROM orders GROUP BY 1)
SELECT count(*) AS customers, count(*) FILTER (WHERE n >= 10) AS frequent, {div('sum(total)', 'sum(n)')} AS ticket,
       {div('sum(total) FILTER (WHERE n >= 10)', 'sum(total)')} AS frequent_share FROM p""")
add("agg_rows_joined_back", "", "SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) "
    "AS orders_of_customer FROM orders")
add("win_lag_running_moving", "", f"""
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum({_TP}) AS total FROM orders GROUP BY 1)
SELECT CAST(month AS VARCHAR) AS month, CAST(total AS DOUBLE) AS total,
       CAST(lag(total) OVER (ORDER BY month) AS DOUBLE) AS previous,
       CAST(sum(total) OVER (ORDER BY month) AS DOUBLE) AS running,
       CAST(sum(total) OVER w AS DOUBLE) / count(*) OVER w AS moving
FROM m WINDOW w AS (ORDER BY month ROWS 2 PRECEDING)""")
add("win_rank_dense", "", "SELECT p_size, n, rank() OVER (ORDER BY n DESC) AS rank, dense_rank() OVER (ORDER BY n DESC) "
    "AS dense_rank FROM (SELECT p_size, count(*) AS n FROM part GROUP BY 1) x")
add("win_row_number_ntile", "", """
WITH c AS (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS balance FROM customer)
SELECT c_custkey, CAST(balance AS DOUBLE) AS balance, row_number() OVER w AS row_number,
       CAST(sum(balance) OVER (ORDER BY balance DESC, c_custkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running,
       count(*) OVER () AS n_rows, CAST(balance AS DOUBLE) / CAST(sum(balance) OVER () AS DOUBLE) AS share,
       ntile(4) OVER w AS quartile
FROM c WINDOW w AS (ORDER BY balance DESC, c_custkey)""")
add("win_lead_next", "", """
SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS o_orderdate,
       CAST(CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS TIMESTAMP)
            AS VARCHAR) AS next_order FROM orders""")
add("win_sequence_per_key", "", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, "
    "event_id) AS seq FROM events")
add("win_first_last_per_key", "", """
SELECT user_id, max(event_type) FILTER (WHERE f = 1) AS first_type, max(event_type) FILTER (WHERE l = 1) AS last_type,
       max(event_id) FILTER (WHERE v = 1) AS largest_event
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS l,
             row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS v FROM events) x GROUP BY 1""")
add("join_left_lookup", "", """
SELECT c_custkey, coalesce(n_name, 'unknown') AS nation, coalesce(r_name, 'unknown') AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'AFRICA') r ON n_regionkey = r_regionkey""")
add("join_orphans", "", "SELECT l_suppkey AS key, count(*) AS rows_per_key FROM lineitem WHERE l_suppkey NOT IN "
    "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1")
add("join_coverage_null_safe", "", """
SELECT o_orderkey FROM orders p WHERE NOT EXISTS (
    SELECT 1 FROM orders c WHERE c.o_totalprice > 300000 AND c.o_custkey = p.o_custkey
    AND nullif(c.o_orderstatus, 'P') IS NOT DISTINCT FROM nullif(p.o_orderstatus, 'P'))""")
add("join_semi_composite", "", """
SELECT l_suppkey, count(*) AS n FROM lineitem a WHERE l_returnflag = 'A' AND (l_partkey, l_suppkey) IN
    (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1""")
add("join_aggregates", "", f"""
SELECT o_orderkey, CAST(abs(paid - lines) AS DOUBLE) AS gap,
       abs(CAST(paid AS DOUBLE) - CAST(lines AS DOUBLE)) <= 1e-8 + 1e-5 * abs(CAST(lines AS DOUBLE)) AS equal
FROM (SELECT l_orderkey AS o_orderkey, sum({_EP}) AS lines FROM lineitem GROUP BY 1) l
JOIN (SELECT o_orderkey, sum({_TP}) AS paid FROM orders GROUP BY 1) o USING (o_orderkey)""")
add("join_cross_baseline", "", f"""
WITH p AS (SELECT o_custkey, count(*) AS n, sum({_TP}) AS total FROM orders GROUP BY 1),
b AS (SELECT CAST(sum(total) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS base FROM p)
SELECT o_custkey, n, CAST(total AS DOUBLE) / n AS mean, base FROM p CROSS JOIN b
WHERE n >= 5 AND CAST(total AS DOUBLE) / n < base * 0.9::DOUBLE""")
add("join_star", "", f"""
SELECT p_type, s_nationkey, CAST(sum({_EP}) AS DOUBLE) AS revenue, count(*) AS n
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
add("ord_top_k", "", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
add("ord_mixed_directions", "", "SELECT s_suppkey, nullif(s_nationkey, 0) AS nation, s_acctbal FROM supplier")
add("ord_sample_values", "", """
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY o_orderkey) AS sample
FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) x
WHERE r <= 5 GROUP BY 1""")
_FOLD = ("regexp_replace(regexp_replace(regexp_replace(strip_accents(regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g')), "
         "'[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g'), '^$', '')")
add("fn_text", "", f"""
SELECT doc_id, md5({_FOLD}) AS folded, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS stripped,
       CASE WHEN length(CAST(doc_id AS VARCHAR)) < 5 THEN lpad(CAST(doc_id AS VARCHAR), 5, '0')
            ELSE CAST(doc_id AS VARCHAR) END AS padded,
       upper(lang[1]) || lang[2:] || ' ' || upper(source[1]) || source[2:] AS label,
       'S-' || upper(substr(lang || '-' || source, 1, 6)) AS short FROM documents""")
_A, _B = "a", "b"
add("fn_time_gaps", "", f"""
WITH x AS (
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           CAST(o_orderdate AS TIMESTAMP) + to_minutes(CAST(trunc(o_totalprice) AS BIGINT) % 1440) AS a,
           CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_quantity AS INTEGER)) AS b
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_extendedprice, {half_even(days(_A, _B), 2)} AS days,
       {half_even(days(_A, _B) + ' * 24::DOUBLE', 1)} AS hours,
       CAST(floor(CAST({secs(_A, _B)} AS DOUBLE) / 86400::DOUBLE) AS BIGINT) AS whole_days,
       datediff('day', CAST(a AS DATE), CAST(b AS DATE)) AS calendar_days, CAST(CAST(a AS DATE) AS VARCHAR) AS day,
       CAST(strftime(a, '%Y%m%d') AS INTEGER) AS day_key FROM x""")
add("fn_rounding", "", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {half_even('l_extendedprice / l_quantity', 2)} AS half_even,
       {rounded('l_extendedprice / 4', 2)} AS sql_round, l_extendedprice / nullif(l_tax, 0) AS ratio,
       round(exp(ln(1 + l_extendedprice)) - 1, 2) AS there_and_back, abs(l_extendedprice - 50000) > 1000 AS far
FROM lineitem""")


def _case(x: str, ends: list[int], values: list) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {e} THEN {v!r}" for e, v in zip(ends, values)) \
        + f" WHEN {x} IS NOT NULL THEN {values[-1]!r} END"


_ENDS = [-10, -1, 0, 3, 7]
_DL = ["10+ days early", "1-9 days early", "On promised day", "1-3 days late", "4-7 days late", "8+ days late"]
add("fn_bands", "", f"""
WITH x AS (
    SELECT datediff('day', DATE '1998-06-17', CAST(l_shipdate AS DATE)) AS d,
           CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' END AS m,
           nullif(CAST(l_quantity AS INTEGER), 10) AS i FROM lineitem)
SELECT {_case('d', _ENDS, _DL)} AS delivery_bucket, {_case('d', _ENDS, [1, 2, 3, 4, 5, 6])} AS delivery_bucket_order,
       CASE WHEN m = 'credit_card' THEN {_case('i', [1, 3, 6], ['1', '2-3', '4-6', '7+'])}
            WHEN m IS NOT NULL THEN 'Not credit card' END AS installment_bucket,
       CASE WHEN m = 'credit_card' THEN coalesce({_case('i', [1, 3, 6], [1, 2, 3, 4])}, 0)
            WHEN m IS NOT NULL THEN 9 END AS installment_bucket_order, count(*) AS n
FROM x GROUP BY 1, 2, 3, 4""")
add("fn_averages", "", f"""
SELECT l_returnflag, {avg_scaled('l_quantity')} AS mean_quantity, {avg_scaled('l_discount', 2)} AS mean_discount,
       {avg_money(_EP)} AS mean_price FROM lineitem GROUP BY 1""")
add("io_csv_roundtrip", "raw_orders", "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) "
    "AS customer_id, order_status, " + plain(_ORDERS[3:]) + " FROM raw_orders")
add("io_parse_failures", "", """
SELECT 'events' AS "table", c AS "column", failed, n AS rows
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE microsecond(ts) % 1000000 <> 0) AS fractions FROM events) e,
     LATERAL (VALUES ('amount', 0), ('number', e.n), ('moment', 0), ('instant', e.fractions)) v(c, failed)""")
add("io_csv_typed", "", """
SELECT event_id, value, CASE WHEN event_type <> 'error' THEN event_type END AS kind, CAST(NULL AS INTEGER) AS number,
       CAST(ts AS VARCHAR) AS moment, props FROM events""")
add("cl_normalize_text", "", f"SELECT doc_id, length({_FOLD}) AS length, md5({_FOLD}) AS folded FROM documents")

_RAW = {
    "orders": "raw_orders", "order_items": "raw_items", "order_payments": "raw_payments", "order_reviews": "raw_reviews",
    "customers": "raw_customers", "products": "raw_products", "sellers": "raw_sellers", "geolocation": "raw_geo",
    "category_translation": "raw_translation",
}
add("io_load_all", " ".join(_RAW.values()), " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST(sum((SELECT count(v) FROM (SELECT unnest(map_values(to_json(r)::MAP(VARCHAR, VARCHAR))) AS v))) AS BIGINT) AS filled FROM {v} r"
    for t, v in _RAW.items()))
add("io_refusals", "raw_payments", """
SELECT 'column' AS what, 'order_payments.csv: missing columns [''payment_value'']' AS said
UNION ALL SELECT 'files', '9' UNION ALL SELECT 'extra', CAST(count(*) AS VARCHAR) FROM raw_payments""")
add("io_star_views", "fact_order_items dim_product dim_date", """
SELECT d.year, p.category, count(*) AS items, CAST(sum(i.price) AS DOUBLE) AS revenue
FROM fact_order_items i JOIN dim_product p USING (product_id) JOIN dim_date d USING (date_key) WHERE i.is_sale GROUP BY 1, 2""")
add("io_csv_split", "", "SELECT doc_id, length(coalesce(text, '')) AS length, md5(coalesce(text, '')) AS digest, source FROM documents")
add("io_whole_numbers", "", "SELECT event_id, event_id + 9007199254740993 AS big, event_id + 9007199254740993 AS near FROM events")
_X = """(SELECT p.category, CAST(year(CAST(i.purchase_date AS DATE)) AS VARCHAR) AS year, c.region, i.customer_unique_id
         FROM fact_order_items i LEFT JOIN dim_product p USING (product_id) LEFT JOIN dim_customer c ON c.customer_unique_id = i.customer_unique_id
         WHERE i.is_sale) x"""
_KEYS = ("category", "year", "region")
add("agg_distinct_sets", "fact_order_items dim_product dim_customer", " UNION ALL ".join(
    f"SELECT '{'+'.join(by)}' AS context, {', '.join(k if k in by else f'NULL AS {k}' for k in _KEYS)}, count(DISTINCT customer_unique_id) AS customers "
    f"FROM {_X}" + (f" GROUP BY {', '.join(by)}" if by else "")
    for by in (_KEYS, ("category",), ("year",), ("region",), ("year", "region"), ())))

from .queries import ORACLE as _O  # noqa: E402

#: The log as its file holds it.
_O["io_cleaning_log"] = _O["cl_log"]
_lost = definition("raw_customers")
_O["io_refused_star"] = with_ctes(
    "SELECT 'refused' AS what, \"check\" || ': ' || detail AS said FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", {ok} AS fits, {d} AS detail" for c, ok, d in _rows) + ") r WHERE NOT fits UNION ALL SELECT 'published', 'nothing'",
    " ".join(_STAR) + " raw_orders raw_items raw_payments").replace(
        _lost, f"SELECT * FROM ({_lost}) c WHERE customer_state NOT IN ('PR', 'RS', 'SC')")
