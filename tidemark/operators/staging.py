"""Clean one-to-one views of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import VOID_STATUSES
from tidemark.functions.scalars import dashed_key, lower_trim, month_start, upper_trim, zip_code

# Bounding box of the market: (south, north), (west, east).
LATITUDES = (-34, 6)
LONGITUDES = (-74, -34)


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        zip_code("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        lower_trim("customer_city").alias("customer_city"),
        upper_trim("customer_state").alias("customer_state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        zip_code("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        lower_trim("seller_city").alias("seller_city"),
        upper_trim("seller_state").alias("seller_state"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    status = lower_trim("order_status")
    bought = F.col("order_purchase_timestamp")
    carrier = F.col("order_delivered_carrier_date")
    arrived = F.col("order_delivered_customer_date")

    def suspicious(condition):
        return F.coalesce(condition, F.lit(False))

    issues = (
        suspicious(carrier < bought)
        | suspicious(arrived < bought)
        | suspicious(arrived < carrier)
        | suspicious((status == "delivered") & arrived.isNull())
    )
    return raw.select(
        "order_id",
        "customer_id",
        status.alias("order_status"),
        bought.alias("purchased_at"),
        F.col("order_approved_at").alias("approved_at"),
        F.when(carrier < bought, None).otherwise(carrier).alias("shipped_to_carrier_at"),
        F.when(arrived < bought, None).otherwise(arrived).alias("delivered_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_at"),
        issues.alias("has_date_quality_issue"),
        F.to_date(bought).alias("purchase_date"),
        month_start(F.to_date(bought)).alias("purchase_month"),
        (~status.isin(*VOID_STATUSES)).alias("is_valid_purchase"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        dashed_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        F.col("order_item_id").alias("order_item_number"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").alias("shipping_limit_at"),
        F.col("price").cast("decimal(10,2)").alias("item_price"),
        F.col("freight_value").cast("decimal(10,2)").alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    at_least_one = F.greatest(F.coalesce("payment_installments", F.lit(1)), F.lit(1))
    return raw.select(
        dashed_key("order_id", "payment_sequential").alias("order_payment_key"),
        "order_id",
        F.col("payment_sequential").alias("payment_sequence"),
        lower_trim("payment_type").alias("payment_type"),
        at_least_one.alias("payment_installments"),
        F.col("payment_value").cast("decimal(10,2)").alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        dashed_key("review_id", "order_id").alias("review_order_key"),
        "review_id",
        "order_id",
        "review_score",
        F.col("review_comment_title").alias("comment_title"),
        F.col("review_comment_message").alias("comment_message"),
        F.col("review_comment_message").isNotNull().alias("has_comment"),
        F.col("review_creation_date").alias("survey_sent_at"),
        F.col("review_answer_timestamp").alias("survey_answered_at"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        F.nullif(F.trim("product_category_name"), F.lit("")).alias("product_category_name_pt"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        F.col("product_photos_qty").alias("product_photo_count"),
        F.nullif("product_weight_g", F.lit(0)).alias("product_weight_g"),
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("product_category_name").alias("product_category_name_pt"),
        F.trim("product_category_name_english").alias("product_category_name_en"),
    )


def points_in_box(raw: DataFrame) -> DataFrame:
    return raw.where(
        F.col("geolocation_lat").between(*LATITUDES) & F.col("geolocation_lng").between(*LONGITUDES)
    ).select(
        zip_code("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
        lower_trim("geolocation_city").alias("city"),
        upper_trim("geolocation_state").alias("state"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip: mean point, most frequent city and state (smallest name on a tie).

    Points first collapse to one row per distinct (zip, city, state), so a zip with
    very many points never forms one large group.
    """
    spots = points_in_box(raw).groupBy("zip_code_prefix", "city", "state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("latitude").alias("lat"), F.count("latitude").alias("lat_n"),
        F.sum("longitude").alias("lng"), F.count("longitude").alias("lng_n"),
    )

    def modal(name: str) -> DataFrame:
        tally = spots.where(F.col(name).isNotNull()).groupBy("zip_code_prefix", name).agg(F.sum("n").alias("n"))
        ordering = F.struct((-F.col("n")).alias("fewest"), F.col(name).alias("name"))
        return tally.groupBy("zip_code_prefix").agg(F.min(ordering)["name"].alias(name))

    centre = spots.groupBy("zip_code_prefix").agg(
        F.try_divide(F.sum("lat"), F.sum("lat_n")).alias("latitude"),
        F.try_divide(F.sum("lng"), F.sum("lng_n")).alias("longitude"),
        F.sum("n").alias("source_point_count"),
    )
    return (
        centre.join(modal("city"), "zip_code_prefix", "left")
        .join(modal("state"), "zip_code_prefix", "left")
        .select("zip_code_prefix", "latitude", "longitude", "city", "state", "source_point_count")
    )


STAGING = {
    "customers": stg_customers,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "order_payments": stg_order_payments,
    "order_reviews": stg_order_reviews,
    "products": stg_products,
    "sellers": stg_sellers,
    "geolocation": stg_geolocation,
    "product_category_translation": stg_category_translation,
}
