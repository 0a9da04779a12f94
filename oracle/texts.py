"""Texts and types of the star's tables as the data dictionary must show them, stated apart from the package."""

TABLES = {
    "fact_orders": ("one row per order", "what happened to each order: sale, payment, delivery and review"),
    "fact_order_items": ("one row per item of an order", "revenue and freight by product, category and seller"),
    "dim_customer": ("one row per person", "where a person lives, and all that person has bought"),
    "dim_product": ("one row per product", "category, size and listing of a product"),
    "dim_seller": ("one row per seller", "where a seller ships from"),
    "dim_date": ("one row per day, whole years", "calendar that orders are grouped and compared by"),
}
COLUMNS = {
    "order_id": "names an order",
    "customer_unique_id": "names a person, whatever account was used to order",
    "date_key": "day of purchase as a number, year then month then day",
    "purchase_date": "day of purchase",
    "order_purchase_timestamp": "moment of purchase",
    "order_status": "last known state of the order",
    "is_sale": "whether the order counts as a sale, that is neither canceled nor unavailable",
    "has_items": "whether any item belongs to the order",
    "is_delivered": "whether the order is marked delivered and has a delivery moment that can be true",
    "is_late": "whether it came after the promised day; unknown unless delivered",
    "is_multi_seller": "whether items of several sellers are in the order",
    "is_repeat_purchase": "whether the person had bought before this sale",
    "customer_order_seq": "place of this sale among the person's sales, from 1; unknown if no sale",
    "items_count": "number of items in the order",
    "products_count": "number of different products in the order",
    "sellers_count": "number of different sellers in the order",
    "items_price": "prices of all items added up, which is the order's revenue",
    "freight_total": "freight of all items added up",
    "order_value": "prices and freight of all items added up",
    "payment_total": "all payments added up, interest of installments included",
    "main_payment_type": "way of paying that bears the largest sum",
    "payment_methods": "number of different ways of paying",
    "max_installments": "most installments of any payment",
    "is_installment": "whether any payment was split into installments",
    "used_voucher": "whether a voucher was part of the payment",
    "installment_bucket": "band that the number of installments falls into",
    "installment_bucket_order": "place of that band when bands are sorted",
    "order_approved_at": "moment the payment was approved",
    "order_delivered_carrier_date": "moment the parcel was given to the carrier",
    "order_delivered_customer_date": "moment the parcel reached the person",
    "order_estimated_delivery_date": "day that was promised at purchase",
    "approval_hours": "hours from purchase to approval",
    "carrier_lead_days": "days from approval until the carrier had the parcel",
    "last_mile_days": "days the parcel was with the carrier",
    "delivery_days": "days from purchase to arrival",
    "promised_days": "days from purchase to the promised day",
    "delay_days": "calendar days from the promised day to arrival, below zero if early",
    "delivery_bucket": "band that the delay falls into",
    "delivery_bucket_order": "place of that band when bands are sorted",
    "flag_carrier_before_approval": "whether the carrier had the parcel before the payment was approved",
    "flag_delivered_before_carrier": "whether the parcel arrived before the carrier had it",
    "has_review": "whether the order was reviewed",
    "review_score": "stars of the newest review, 1 to 5",
    "review_count": "number of reviews of the order",
    "has_comment": "whether the newest review has a text",
    "review_response_hours": "hours from the request for a review to its answer",
    "order_item_id": "number of the item within its order, from 1",
    "product_id": "names a product",
    "seller_id": "names a seller",
    "shipping_limit_date": "last moment for the seller to ship",
    "price": "price of the item",
    "freight_value": "freight of the item",
    "item_total": "price and freight of the item added up",
    "freight_share": "part that freight has in price and freight",
    "freight_gt_price": "whether freight costs more than the item",
    "zip_code_prefix": "first five digits of the postal code",
    "city": "name of the city",
    "state": "two letters of the federal state",
    "region": "part of the country the state lies in",
    "lat": "latitude in degrees",
    "lng": "longitude in degrees",
    "geo_source": "where the coordinates come from, the postal code, the city's centre or nowhere",
    "first_purchase_date": "day of the person's first sale",
    "last_purchase_date": "day of the person's latest sale",
    "lifetime_orders": "number of the person's sales",
    "lifetime_revenue": "revenue of all the person's sales",
    "is_repeat_customer": "whether the person has bought more than once",
    "category": "product category in English, ready to be shown",
    "category_pt": "product category as the source spells it",
    "product_weight_g": "weight in grams; zero is taken as unknown",
    "product_length_cm": "length of the parcel in centimetres",
    "product_height_cm": "height of the parcel in centimetres",
    "product_width_cm": "width of the parcel in centimetres",
    "product_volume_cm3": "length times height times width",
    "product_photos_qty": "number of pictures in the listing",
    "product_name_length": "number of characters of the listing's name",
    "product_description_length": "number of characters of the listing's text",
    "seller_label": "short name of a seller for charts",
    "date": "the day",
    "year": "calendar year",
    "quarter": "quarter of the year, 1 to 4",
    "year_quarter": "year and quarter as a label",
    "month_num": "month of the year, 1 to 12",
    "month_name": "name of the month",
    "month_short": "name of the month in three letters",
    "year_month": "year and month as a label that sorts by time",
    "year_month_num": "year and month as a number",
    "month_start": "first day of the month",
    "iso_week": "week of the year by ISO 8601",
    "day_of_week_num": "day of the week, 1 for Monday",
    "day_name": "name of the day",
    "is_weekend": "whether the day is a Saturday or Sunday",
    "is_complete_month": "whether the month has enough orders to be compared with others",
}
#: Type of each column.
TYPES = {c: kind for kind, names in {
    "bigint": """
        order_id customer_unique_id customer_order_seq items_count products_count sellers_count
        payment_methods max_installments review_count product_id seller_id lifetime_orders""",
    "int": """
        date_key installment_bucket_order delay_days delivery_bucket_order review_score order_item_id
        product_weight_g product_length_cm product_height_cm product_width_cm product_photos_qty
        product_name_length product_description_length year month_num year_month_num iso_week day_of_week_num""",
    "date": """
        purchase_date first_purchase_date last_purchase_date date month_start""",
    "timestamp_ntz": """
        order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date
        order_estimated_delivery_date shipping_limit_date""",
    "string": """
        order_status main_payment_type installment_bucket delivery_bucket zip_code_prefix city state region
        geo_source category category_pt seller_label quarter year_quarter month_name month_short year_month
        day_name""",
    "boolean": """
        is_sale has_items is_delivered is_late is_multi_seller is_repeat_purchase is_installment used_voucher
        flag_carrier_before_approval flag_delivered_before_carrier has_review has_comment freight_gt_price
        is_repeat_customer is_weekend is_complete_month""",
    "decimal(18,4)": """
        items_price freight_total order_value payment_total price freight_value item_total lifetime_revenue""",
    "double": """
        approval_hours carrier_lead_days last_mile_days delivery_days promised_days review_response_hours
        freight_share lat lng product_volume_cm3""",
}.items() for c in names.split()}
