"""Oracle SQL of the data-quality checks."""
from __future__ import annotations

from .base import STATES, half_even, secs, with_ctes
from .queries import add

A_NULL = "Give it a label of its own, estimate it, or leave the row out where the value is needed"
A_KEEP = "Leave empty: the process explains why nothing is there"
RAW = {
    "orders": ("raw_orders", "order_id customer_id order_status order_purchase_timestamp order_approved_at "
               "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"),
    "order_items": ("raw_items", "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
    "order_payments": ("raw_payments", "order_id payment_sequential payment_type payment_installments payment_value"),
    "order_reviews": ("raw_reviews", "review_id order_id review_score review_comment_title review_comment_message "
                      "review_creation_date review_answer_timestamp"),
    "customers": ("raw_customers", "customer_id customer_unique_id customer_zip_code_prefix customer_city "
                  "customer_state"),
    "products": ("raw_products", "product_id product_category_name product_name_lenght product_description_lenght "
                 "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm"),
    "sellers": ("raw_sellers", "seller_id seller_zip_code_prefix seller_city seller_state"),
    "geolocation": ("raw_geo", "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
                    "geolocation_state"),
    "category_translation": ("raw_translation", "product_category_name product_category_name_english"),
}
KEYS = {"orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
        "order_payments": ["order_id", "payment_sequential"], "order_reviews": ["review_id", "order_id"],
        "customers": ["customer_id"], "products": ["product_id"], "sellers": ["seller_id"],
        "category_translation": ["product_category_name"]}


def one(dimension: str, table: str, check: str, severity: str, bad: str, total: str, action: str, source: str,
        detail: str = "''") -> str:
    """One result row from aggregates over ``source``."""
    return (f"SELECT '{dimension}' AS dimension, '{table}' AS \"table\", '{check}' AS \"check\", "
            f"'{severity}' AS severity, CAST(coalesce({bad}, 0) AS BIGINT) AS n_affected, "
            f"CAST(coalesce({total}, 0) AS BIGINT) AS n_total, coalesce({detail}, '') AS detail, "
            f"'{action}' AS action FROM {source}")


def finish(parts: list[str]) -> str:
    pct = half_even("coalesce(CAST(n_affected AS DOUBLE) * 100.0::DOUBLE / nullif(n_total, 0), 0)", 4)
    return (f"SELECT *, {pct} AS pct, CASE WHEN n_affected = 0 THEN 'PASS' ELSE severity END AS status FROM (\n"
            + "\nUNION ALL\n".join(parts) + ") results")


def check(name: str, parts: list[str], needs: str | None = None) -> None:
    needs = needs or " ".join(v for v, _ in RAW.values())
    add(name, needs, finish(parts))


# ---------------------------------------------------------------- nulls
EXPECTED = {
    "review_comment_title": "Reviewers may leave the text out", "review_comment_message": "Reviewers may leave the text out",
    "order_approved_at": "Payment was not, or not yet, confirmed",
    "order_delivered_carrier_date": "Nothing was, or yet had been, handed over",
    "order_delivered_customer_date": "Nothing had arrived so far, or ever will",
}
_nulls, _ranking = [], []
for _t, (_v, _cols) in RAW.items():
    for _c in _cols.split():
        others = [o for o in _cols.split() if o != _c]
        together = "concat_ws(', ', " + ", ".join(
            f"CASE WHEN bool_and({o} IS NULL) FILTER (WHERE {_c} IS NULL) THEN '{o}' END" for o in others) + ")"
        text = EXPECTED.get(_c)
        detail = (f"'{text or 'Unexpected missing values'}' || CASE WHEN {together} <> '' "
                  f"THEN '. Always missing together with: ' || {together} ELSE '' END")
        row = one("Completeness", _t, f"Missing values: {_c}", "INFO" if text else "WARNING",
                  f"count(*) FILTER (WHERE {_c} IS NULL)", "count(*)", A_KEEP if text else A_NULL, _v, detail)
        _nulls.append(f"SELECT * FROM ({row}) x WHERE n_affected > 0")
        _ranking.append(f"SELECT '{_t}' AS \"table\", '{_c}' AS \"column\", "
                        f"count(*) FILTER (WHERE {_c} IS NULL) AS nulls, count(*) AS n FROM {_v}")
check("chk_nulls", _nulls)
add("missing_ranking", " ".join(v for v, _ in RAW.values()),
    "SELECT \"table\", \"column\", nulls, CAST(nulls AS DOUBLE) * 100.0::DOUBLE / n AS pct FROM ("
    + " UNION ALL ".join(_ranking) + ") x WHERE nulls > 0")


# ---------------------------------------------------------------- coverage, keys, copies, grain
def statuses(source: str) -> str:
    return (f"(SELECT 'By status: ' || string_agg(order_status || '=' || n, ', ' ORDER BY n DESC, order_status) "
            f"FROM (SELECT order_status, count(*) AS n FROM {source} GROUP BY 1) s)")


_cov = []
for _child, _v in (("order_items", "raw_items"), ("order_payments", "raw_payments"), ("order_reviews", "raw_reviews")):
    lacking = f"(SELECT * FROM raw_orders WHERE order_id NOT IN (SELECT order_id FROM {_v}))"
    _cov.append(one("Completeness", "orders", f"orders without {_child}", "WARNING",
                    f"(SELECT count(*) FROM {lacking} l)", "count(*)",
                    f"Leave these rows out of every measure that needs {_child}", "raw_orders", statuses(f"{lacking} l")))
check("chk_coverage", _cov)

check("chk_primary_key", [
    one("Uniqueness", t, f"Primary key unique & not null ({', '.join(k)})", "CRITICAL",
        "sum(n) FILTER (WHERE n > 1 OR bad)", "sum(n)",
        "Make the key unique first: each join on it multiplies rows",
        f"(SELECT count(*) AS n, bool_or({' OR '.join(c + ' IS NULL' for c in k)}) AS bad FROM {RAW[t][0]} "
        f"GROUP BY {', '.join(k)}) g") for t, k in KEYS.items()])
check("chk_full_duplicates", [
    one("Uniqueness", t, "Exact duplicate rows", "INFO" if t == "geolocation" else "WARNING",
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {v}) d)", "count(*)", "Keep one of each set of equal rows", v,
        "'Many GPS samples per zip prefix'" if t == "geolocation" else "''") for t, (v, _) in RAW.items()])
_GRAIN = [
    ("order_reviews", "review_id", "one review can stand for several orders, so it takes the order as well to name a row"),
    ("order_reviews", "order_id", "several reviews of an order: reduce to one row before orders are joined"),
    ("order_payments", "order_id", "an order may be paid in several ways: sum up before orders are joined"),
    ("customers", "customer_unique_id",
     "people who came back have several customer ids; count them by customer_unique_id")]
check("chk_grain", [
    one("Uniqueness", t, f"Rows per {c} > 1", "INFO", "count(*) FILTER (WHERE n > 1)", "count(*)",
        "Aggregate to the key before this table is joined",
        f"(SELECT {c}, count(*) AS n FROM {RAW[t][0]} WHERE {c} IS NOT NULL GROUP BY 1) g",
        f"'{why}. Max rows for one key: ' || coalesce(max(n), 0)") for t, c, why in _GRAIN])

# ---------------------------------------------------------------- foreign keys
_FK = [("orders", "customer_id", "customers", "customer_id"), ("order_items", "order_id", "orders", "order_id"),
       ("order_items", "product_id", "products", "product_id"), ("order_items", "seller_id", "sellers", "seller_id"),
       ("order_payments", "order_id", "orders", "order_id"), ("order_reviews", "order_id", "orders", "order_id"),
       ("products", "product_category_name", "category_translation", "product_category_name"),
       ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
       ("sellers", "seller_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix")]
_fk = []
for t, c, p, k in _FK:
    orphans = f"(SELECT {c} AS v FROM {RAW[t][0]} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {RAW[p][0]}))"
    sample = (f"(SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM (SELECT DISTINCT v FROM {orphans} o "
              "ORDER BY v LIMIT 5) s)")
    _fk.append(one("Integrity", t, f"{t}.{c} -> {p}.{k}",
                   "WARNING" if p in ("geolocation", "category_translation") else "CRITICAL",
                   f"(SELECT count(*) FROM {orphans} o)", f"count({c})",
                   "Create the parent, or point these rows at a placeholder", RAW[t][0],
                   f"CASE WHEN (SELECT count(*) FROM {orphans} o) > 0 THEN (SELECT count(DISTINCT v) FROM {orphans} o) "
                   f"|| ' distinct orphan values. e.g. ' || {sample} END"))
check("chk_foreign_keys", _fk)

# ---------------------------------------------------------------- validity
_STATUS = "created approved invoiced processing shipped delivered canceled unavailable".split()
_ALLOWED = [("orders", "order_status", _STATUS),
            ("order_payments", "payment_type", "credit_card boleto voucher debit_card".split()),
            ("customers", "customer_state", STATES), ("sellers", "seller_state", STATES),
            ("geolocation", "geolocation_state", STATES)]
_parts = []
for t, c, ok in _ALLOWED:
    bad = f"{c} NOT IN ({', '.join(repr(x) for x in ok)})"
    listed = (f"(SELECT 'Unexpected: [' || string_agg('''' || v || '''', ', ' ORDER BY v) || ']' FROM "
              f"(SELECT DISTINCT {c} AS v FROM {RAW[t][0]} WHERE {bad} ORDER BY 1 LIMIT 10) s)")
    _parts.append(one("Validity", t, f"Allowed values: {c}", "WARNING", f"count(*) FILTER (WHERE {bad})",
                      f"count({c})", "Translate to a listed value; otherwise treat as not known", RAW[t][0], listed))
check("chk_allowed_values", _parts)

_RANGES = [("order_items", "price", 0, None, False), ("order_items", "freight_value", 0, None, True),
           ("order_payments", "payment_value", 0, None, True), ("order_payments", "payment_installments", 1, 24, True),
           ("order_reviews", "review_score", 1, 5, True), ("products", "product_weight_g", 0, None, False),
           ("products", "product_length_cm", 0, None, False), ("products", "product_height_cm", 0, None, False),
           ("products", "product_width_cm", 0, None, False), ("products", "product_photos_qty", 0, None, True)]
_parts = []
for t, c, lo, hi, closed in _RANGES:
    bad = f"({c} {'<' if closed else '<='} {lo}" + (f" OR {c} > {hi})" if hi else ")")
    listed = (f"(SELECT 'Offending values: ' || string_agg(printf('%g', v), ', ' ORDER BY v) FROM "
              f"(SELECT DISTINCT CAST({c} AS DOUBLE) AS v FROM {RAW[t][0]} WHERE {bad} ORDER BY 1 LIMIT 8) s)")
    _parts.append(one("Validity", t, f"Range {c} in {'[' if closed else '('}{lo}, {hi or 'inf'}]", "WARNING",
                      f"count(*) FILTER (WHERE {bad})", f"count({c})",
                      "Clear the value, or repair it where only one repair makes sense", RAW[t][0], listed))
check("chk_numeric_ranges", _parts)
check("chk_bbox", [one(
    "Validity", "geolocation", "Coordinates inside Brazil bounding box", "WARNING",
    "count(*) - count(*) FILTER (WHERE geolocation_lat BETWEEN -33.75 AND 5.27 "
    "AND geolocation_lng BETWEEN -73.99 AND -28.84)", "count(*)",
    "Remove these points before a centre is taken", "raw_geo")])
check("chk_parsing", ["SELECT 'Validity' AS dimension, 'all' AS \"table\", 'All values parsed to target types' "
                      "AS \"check\", 'CRITICAL' AS severity, CAST(0 AS BIGINT) AS n_affected, CAST("
                      + " + ".join(f"(SELECT count(*) FROM {v})" for v, _ in RAW.values())
                      + " AS BIGINT) AS n_total, '' AS detail, '' AS action"])

# ---------------------------------------------------------------- consistency
_ORDER = [("orders", "order_purchase_timestamp", "order_approved_at", "Approved before purchase"),
          ("orders", "order_approved_at", "order_delivered_carrier_date", "Handed to carrier before approval"),
          ("orders", "order_delivered_carrier_date", "order_delivered_customer_date",
           "Delivered to customer before carrier pickup"),
          ("orders", "order_purchase_timestamp", "order_delivered_customer_date", "Delivered before purchase"),
          ("orders", "order_purchase_timestamp", "order_estimated_delivery_date", "Estimated delivery before purchase"),
          ("order_reviews", "review_creation_date", "review_answer_timestamp", "Review answered before it was created")]


def fixed(x: str, places: int) -> str:
    return f"printf('%.{places}f', {half_even(x, places)})"


_parts = []
for t, e, l, text in _ORDER:
    bad, gap = f"{l} < {e}", secs(l, e)
    detail = (f"CASE WHEN count(*) FILTER (WHERE {bad}) > 0 THEN 'Median gap ' || "
              + fixed(f"quantile_cont(CAST({gap} AS DOUBLE), 0.5) FILTER (WHERE {bad}) / 3600::DOUBLE", 1)
              + " || ' h, max ' || " + fixed(f"CAST(max({gap}) FILTER (WHERE {bad}) AS DOUBLE) / 3600::DOUBLE", 1)
              + " || ' h' END")
    _parts.append(one("Consistency", t, f"{text} ({l} < {e})", "WARNING", f"count(*) FILTER (WHERE {bad})",
                      f"count(*) FILTER (WHERE {e} IS NOT NULL AND {l} IS NOT NULL)",
                      "Mark the rows and skip them wherever this interval is measured", RAW[t][0], detail))
check("chk_date_order", _parts)

_other = "(SELECT * FROM raw_orders WHERE order_status <> ''delivered'' AND order_delivered_customer_date IS NOT NULL) o" \
    .replace("''", "'")
check("chk_status_vs_dates", [
    one("Consistency", "orders", "Status ''delivered'' without delivery date", "WARNING",
        "count(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL)",
        "count(*) FILTER (WHERE order_status = 'delivered')", "Skip them when delivery times or punctuality are measured",
        "raw_orders"),
    one("Consistency", "orders", "Delivery date present but status is not ''delivered''", "WARNING",
        f"(SELECT count(*) FROM {_other})", "count(order_delivered_customer_date)",
        "Trust the status and ignore the date", "raw_orders", statuses(_other))])
check("chk_shipping_limit", [one(
    "Consistency", "order_items", "shipping_limit_date within 0-60 days of purchase", "WARNING",
    "count(*) FILTER (WHERE d < 0 OR d > 60)", "count(d)", "Clear the deadline of these rows",
    f"(SELECT CAST(floor(CAST({secs('order_purchase_timestamp', 'shipping_limit_date')} AS DOUBLE) / 86400::DOUBLE) "
    "AS BIGINT) AS d FROM raw_items JOIN raw_orders USING (order_id)) x",
    "'Median ' || " + fixed("quantile_cont(d, 0.5)", 0) + " || ' days; max ' || max(d) || ' days'")])
check("chk_reconcile", [one(
    "Consistency", "order_payments", "sum(payments) = sum(price + freight) +/- 1.0 BRL", "INFO",
    "count(*) FILTER (WHERE abs(diff) > 1)", "count(*)", "Take revenue from item prices; payments serve as a cross-check only",
    "(SELECT CAST(paid - cost AS DECIMAL(18,4)) AS diff FROM (SELECT order_id, sum(price + freight_value) AS cost "
    "FROM raw_items GROUP BY 1) i JOIN (SELECT order_id, sum(payment_value) AS paid FROM raw_payments GROUP BY 1) p "
    "USING (order_id)) x",
    "'Overpaid: ' || count(*) FILTER (WHERE diff > 1) || ' (likely installment interest), underpaid: ' || "
    "count(*) FILTER (WHERE diff < -1) || ' (likely vouchers). Median |diff| among flagged: ' || "
    + fixed("quantile_cont(CAST(abs(diff) AS DOUBLE), 0.5) FILTER (WHERE abs(diff) > 1)", 2) + " || ' BRL'")])

# ---------------------------------------------------------------- accuracy, timeliness, profile
_freight = one("Accuracy", "order_items", "Freight greater than item price", "INFO",
               "count(*) FILTER (WHERE freight_value > price)", "count(*)",
               "Leave them in and mark them (freight_gt_price)", "raw_items",
               "'Relevant for logistics-cost analysis (cheap, heavy items)'")
_parts = []


def grouped(x: str) -> str:
    return f"format('{{:,.2f}}', {half_even(x, 2)})"


for t, c in (("order_items", "price"), ("order_items", "freight_value"), ("order_payments", "payment_value"),
             ("products", "product_weight_g")):
    values = f"(SELECT CAST({c} AS DOUBLE) AS v FROM {RAW[t][0]} WHERE {c} >= 0)"
    # log1p written out: ln(1 + v); expm1 likewise.
    q = (f"(SELECT quantile_cont(ln(1 + v), 0.25) AS q1, quantile_cont(ln(1 + v), 0.75) AS q3, "
         f"quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.99) AS p99, max(v) AS mx, count(*) AS n FROM {values} a)")
    f = f"(SELECT *, exp(q1 - 1.5 * (q3 - q1)) - 1 AS lo, exp(q3 + 1.5 * (q3 - q1)) - 1 AS hi FROM {q} b) f"
    _parts.append(one("Accuracy", t, f"IQR outliers: {c} (log scale)", "INFO",
                      f"(SELECT count(*) FROM {values} a WHERE v < lo OR v > hi)", "n",
                      "Leave them in; shorten axes of charts instead", f,
                      "'Fences [' || " + grouped("greatest(lo, 0)") + " || ', ' || " + grouped("hi")
                      + " || ']; p50=' || " + grouped("p50") + " || ', p99=' || " + grouped("p99")
                      + " || ', max=' || " + grouped("mx")))
check("chk_iqr_outliers", _parts)
check("chk_business_outlier", [_freight])
check("chk_timeliness", [one(
    "Timeliness", "orders", "Months with < 10% of median monthly orders", "WARNING",
    "count(*) FILTER (WHERE incomplete)", "count(*)", "Compare only months that were recorded in full",
    "monthly_orders",
    "'Range ' || (SELECT CAST(CAST(min(order_purchase_timestamp) AS DATE) AS VARCHAR) || ' to ' || "
    "CAST(CAST(max(order_purchase_timestamp) AS DATE) AS VARCHAR) FROM raw_orders) || '. Incomplete: ' || "
    "coalesce(string_agg(strftime(month, '%Y-%m') || ' (' || orders || ')', ', ' ORDER BY month) "
    "FILTER (WHERE incomplete), '')")], "monthly_orders")

_parts = []
for t, (v, cols) in RAW.items():
    cols = cols.split()
    dates = [c for c in cols if c.endswith(("_date", "_at", "_timestamp"))]
    empty = " + ".join(f"count(*) - count({c})" for c in cols)
    rng = "'-'"
    if dates:
        lo = ", ".join(f"min({c})" for c in dates)
        hi = ", ".join(f"max({c})" for c in dates)
        rng = f"CAST(CAST(least({lo}) AS DATE) AS VARCHAR) || ' to ' || CAST(CAST(greatest({hi}) AS DATE) AS VARCHAR)"
    pct = half_even(f"CAST({empty} AS DOUBLE) * 100.0::DOUBLE / (count(*) * {len(cols)})", 2)
    _parts.append(f"SELECT '{t}' AS \"table\", count(*) AS rows, {len(cols)} AS columns, {pct} AS null_cells_pct, "
                  f"{rng} AS date_range FROM {v}")
add("chk_profile", " ".join(v for v, _ in RAW.values()), " UNION ALL ".join(_parts))

_ALL = ["chk_parsing", "chk_nulls", "chk_coverage", "chk_primary_key", "chk_full_duplicates", "chk_grain",
        "chk_foreign_keys", "chk_allowed_values", "chk_numeric_ranges", "chk_bbox", "chk_date_order",
        "chk_status_vs_dates", "chk_shipping_limit", "chk_reconcile", "chk_iqr_outliers", "chk_business_outlier",
        "chk_timeliness"]


def _summary() -> str:
    from .queries import ORACLE
    union = " UNION ALL ".join(f"SELECT status FROM ({ORACLE[n]}) r{i}" for i, n in enumerate(_ALL))
    return with_ctes(f"""
    SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
           count(*) FILTER (WHERE status = 'CRITICAL') AS critical,
           count(*) FILTER (WHERE status = 'WARNING') AS warnings,
           count(*) FILTER (WHERE status = 'INFO') AS informational,
           (SELECT strftime(min(month), '%Y-%m') FROM monthly_orders WHERE NOT incomplete) AS first_month,
           (SELECT strftime(max(month), '%Y-%m') FROM monthly_orders WHERE NOT incomplete) AS last_month,
           (SELECT count(*) FROM monthly_orders WHERE NOT incomplete) AS complete_months
    FROM ({union}) s""", "monthly_orders")


from .queries import ORACLE as _O  # noqa: E402

_O["chk_summary"] = _summary()


def _results() -> str:
    union = " UNION ALL ".join(f"SELECT * FROM ({_O[n]}) r{i}" for i, n in enumerate(_ALL))
    rank = "CASE status WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'INFO' THEN 2 ELSE 3 END"
    return f"SELECT *, row_number() OVER (ORDER BY {rank}, dimension, \"table\", pct DESC, \"check\") AS position FROM ({union}) s"


_O["io_check_results"] = _results()
