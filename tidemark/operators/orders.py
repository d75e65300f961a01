"""Per-order roll-ups, the enriched order and the order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import MONEY, sum_of_lines
from tidemark.operators.ordered import ordered_scan
from tidemark.sources.scratch import store

SEQUENCE_COLUMNS = ["customer_order_number", "is_first_purchase"]
FACT_COLUMNS = [
    "order_id", "customer_unique_id", "customer_id", "customer_state", "order_status",
    "is_valid_purchase", "customer_order_number", "is_first_purchase", "purchased_at",
    "purchase_date", "purchase_month", "approved_at", "shipped_to_carrier_at", "delivered_at",
    "estimated_delivery_at", "has_date_quality_issue", "item_count", "distinct_product_count",
    "items_subtotal", "freight_total", "payment_total", "order_revenue", "main_payment_type",
    "max_installments", "review_score_avg", "review_count", "delivery_days", "is_late_delivery",
    "days_late",
]

PURCHASE_COLUMNS = [
    "customer_unique_id", "order_id", "customer_state", "customer_city", "customer_zip_code_prefix", "is_valid_purchase",
    "purchased_at", "purchase_date", "delivered_at", "is_late_delivery", "order_revenue", "item_count", "review_score_avg",
]

#: What uniqueness tests of orders, people, months and categories read of the valid purchases.
KEYED_COLUMNS = [
    "customer_unique_id", "order_id", "is_valid_purchase", "purchased_at", "purchase_date", "purchase_month", "order_revenue",
    "item_count", "review_score_avg",
]


def gathered(lines: DataFrame, key: str = "order_id") -> DataFrame:
    """Lines with an order, brought to the task of their order before they are rolled up.

    An order has few lines, so a partial aggregate before the shuffle keeps nearly every line of a file in a
    hash map (or a sort) and saves nothing; here a task holds the orders of one shuffle partition only, and the
    roll-up needs no other exchange, not even to meet the orders. Lines without an order are left out.
    """
    return lines.where(F.col(key).isNotNull()).repartition(key)


def items_per_order(items: DataFrame) -> DataFrame:
    """Sums collapse map-side; both distinct counts shuffle on (order, value), never on the order alone."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.countDistinct("product_id").alias("distinct_product_count"),
        F.countDistinct("seller_id").alias("seller_count"),
        sum_of_lines("item_price").alias("items_subtotal"),
        sum_of_lines("freight_value").alias("freight_total"),
        sum_of_lines(F.col("item_price") + F.col("freight_value")).alias("items_gross_total"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Main payment type is that of the largest single payment; equal payments prefer the later name."""
    paid = F.col("payment_value").isNotNull()
    largest = F.max(F.when(paid, F.struct("payment_value", "payment_type")))
    return payments.groupBy("order_id").agg(
        sum_of_lines("payment_value").alias("payment_total"),
        F.count(F.lit(1)).alias("payment_count"),
        F.max("payment_installments").alias("max_installments"),
        largest["payment_type"].alias("main_payment_type"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score_avg"),
        F.min("review_score").alias("review_score_min"),
        F.count(F.lit(1)).alias("review_count"),
    )


def joined_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One row per order with its person, money, delivery and review measures (no purchase sequence).

    The three roll-ups are unique on ``order_id``, so nothing fans out, and they
    share one hash partitioning with the orders.
    """
    zero_money = F.lit(0).cast(MONEY)
    delivered, estimated = F.col("delivered_at"), F.col("estimated_delivery_at")
    gap = F.datediff(F.to_date(delivered), F.to_date(estimated))
    return (
        orders.join(customers, "customer_id")
        .join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
        .select(
            "order_id", "customer_id", "customer_unique_id", "customer_state", "customer_city",
            "customer_zip_code_prefix", "order_status", "is_valid_purchase", "purchased_at",
            "purchase_date", "purchase_month", "approved_at", "shipped_to_carrier_at", "delivered_at",
            "estimated_delivery_at", "has_date_quality_issue",
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            F.coalesce("distinct_product_count", F.lit(0)).alias("distinct_product_count"),
            F.coalesce("items_subtotal", zero_money).alias("items_subtotal"),
            F.coalesce("freight_total", zero_money).alias("freight_total"),
            "payment_total", "payment_count", "main_payment_type", "max_installments",
            F.coalesce("payment_total", "items_gross_total", zero_money).alias("order_revenue"),
            "review_score_avg", "review_score_min",
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
            F.datediff(F.to_date(delivered), F.to_date("purchased_at")).alias("delivery_days"),
            (F.to_date(delivered) > F.to_date(estimated)).alias("is_late_delivery"),
            F.when(gap.isNotNull(), F.greatest(gap, F.lit(0))).alias("days_late"),
        )
    )


def purchases(joined: DataFrame, columns: list[str] = PURCHASE_COLUMNS) -> DataFrame:
    """The valid purchases with what the person roll-up and the snapshots read; all else of the orders can be pruned."""
    return joined.where("is_valid_purchase").select(*columns)


def purchase_sequence(joined: DataFrame) -> DataFrame:
    """order_id -> 1, 2, 3... among the person's valid purchases, from the joined orders.

    Works on four narrow columns and an ordered scan, so one person with a very
    large share of all orders is numbered by many tasks.
    """
    valid = joined.where("is_valid_purchase").select("customer_unique_id", "purchased_at", "order_id")
    numbered = ordered_scan(valid, [("purchased_at", True), ("order_id", True)], group=["customer_unique_id"])
    return numbered.select("order_id", F.col("position").alias("customer_order_number"))


def orders_enriched(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    # Numbered and joined back: stored, so that the five tables are joined once.
    joined = store(joined_orders(orders, customers, items, payments, reviews), "joined-orders")
    return with_sequence(joined, purchase_sequence(joined))


def with_sequence(joined: DataFrame, sequence: DataFrame) -> DataFrame:
    numbered = joined.join(sequence, "order_id", "left")
    return numbered.withColumn(
        "is_first_purchase", F.coalesce(F.col("customer_order_number") == 1, F.lit(False))
    )


def fct_orders(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    name = F.coalesce("product_category_name_en", "product_category_name_pt", F.lit("unknown"))
    return products.join(translation, "product_category_name_pt", "left").select(
        "product_id", "product_category_name_pt", name.alias("product_category"),
        "product_name_length", "product_description_length", "product_photo_count", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    )
