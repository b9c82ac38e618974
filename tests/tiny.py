"""Small hand-made raw tables."""

from tallymart.plans.star import Star

SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, customer_city string, "
                 "customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
              "order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id bigint, product_id string, seller_id string, "
                   "shipping_limit_date string, price double, freight_value double",
    "payments": "order_id string, payment_sequential bigint, payment_type string, payment_installments bigint, "
                "payment_value double",
    "products": "product_id string, product_category_name string, product_length_cm double, product_height_cm double, "
                "product_width_cm double",
    "sellers": "seller_id string, seller_zip_code_prefix bigint, seller_city string, seller_state string",
    "reviews": "review_id string, order_id string, review_score bigint, review_comment_title string, "
               "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "geolocation": "geolocation_zip_code_prefix bigint, geolocation_lat double, geolocation_lng double, "
                   "geolocation_city string, geolocation_state string",
    "category_translation": "product_category_name string, product_category_name_english string",
}


def tiny_star(spark, **rows) -> Star:
    return Star({name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()})


def order(order_id, customer_id="c1", status="delivered", bought="2017-01-10 10:00:00", got="2017-01-15 10:00:00",
          due="2017-01-20 00:00:00", approved="2017-01-10 11:00:00"):
    return (order_id, customer_id, status, bought, approved, None, got, due)


def item(order_id, number=1, product="p1", seller="s1", price=10.0, freight=1.0):
    return (order_id, number, product, seller, None, price, freight)


def review(review_id, order_id, score, message=None, created="2017-02-01 00:00:00"):
    return (review_id, order_id, score, None, message, created, None)


def rows(df):
    return [tuple(r) for r in df.collect()]
