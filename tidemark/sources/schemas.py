"""The nine raw tables: columns, types, keys and which columns may be empty."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, STAMP, INT, MONEY, FLOAT = (
    T.StringType(), T.TimestampNTZType(), T.IntegerType(), T.DecimalType(10, 2), T.DoubleType(),
)


@dataclass(frozen=True)
class RawTable:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    # Texts with line breaks: a file of this table cannot be split.
    multi_line: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [n for n, _ in self.columns]


# File layouts in file order, source spelling kept.
RAW_TABLES: dict[str, RawTable] = {
    t.name: t
    for t in (
        RawTable(
            "customers",
            (
                ("customer_id", TEXT), ("customer_unique_id", TEXT), ("customer_zip_code_prefix", TEXT),
                ("customer_city", TEXT), ("customer_state", TEXT),
            ),
            key=("customer_id",),
            required=("customer_id", "customer_unique_id"),
        ),
        RawTable(
            "orders",
            (
                ("order_id", TEXT), ("customer_id", TEXT), ("order_status", TEXT),
                ("order_purchase_timestamp", STAMP), ("order_approved_at", STAMP),
                ("order_delivered_carrier_date", STAMP), ("order_delivered_customer_date", STAMP),
                ("order_estimated_delivery_date", STAMP),
            ),
            key=("order_id",),
            required=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
        ),
        RawTable(
            "order_items",
            (
                ("order_id", TEXT), ("order_item_id", INT), ("product_id", TEXT), ("seller_id", TEXT),
                ("shipping_limit_date", STAMP), ("price", MONEY), ("freight_value", MONEY),
            ),
            key=("order_id", "order_item_id"),
            required=("order_id", "order_item_id", "product_id", "seller_id", "price"),
        ),
        RawTable(
            "order_payments",
            (
                ("order_id", TEXT), ("payment_sequential", INT), ("payment_type", TEXT),
                ("payment_installments", INT), ("payment_value", MONEY),
            ),
            key=("order_id", "payment_sequential"),
            required=("order_id", "payment_sequential", "payment_type", "payment_value"),
        ),
        RawTable(
            "order_reviews",
            (
                ("review_id", TEXT), ("order_id", TEXT), ("review_score", INT),
                ("review_comment_title", TEXT), ("review_comment_message", TEXT),
                ("review_creation_date", STAMP), ("review_answer_timestamp", STAMP),
            ),
            key=("review_id", "order_id"),
            required=("review_id", "order_id", "review_score"),
            multi_line=True,
        ),
        RawTable(
            "products",
            (
                ("product_id", TEXT), ("product_category_name", TEXT), ("product_name_lenght", INT),
                ("product_description_lenght", INT), ("product_photos_qty", INT), ("product_weight_g", INT),
                ("product_length_cm", INT), ("product_height_cm", INT), ("product_width_cm", INT),
            ),
            key=("product_id",),
            required=("product_id",),
        ),
        RawTable(
            "sellers",
            (
                ("seller_id", TEXT), ("seller_zip_code_prefix", TEXT), ("seller_city", TEXT),
                ("seller_state", TEXT),
            ),
            key=("seller_id",),
            required=("seller_id",),
        ),
        RawTable(
            "geolocation",
            (
                ("geolocation_zip_code_prefix", TEXT), ("geolocation_lat", FLOAT), ("geolocation_lng", FLOAT),
                ("geolocation_city", TEXT), ("geolocation_state", TEXT),
            ),
            required=("geolocation_zip_code_prefix",),
        ),
        RawTable(
            "product_category_translation",
            (("product_category_name", TEXT), ("product_category_name_english", TEXT)),
            key=("product_category_name",),
            required=("product_category_name", "product_category_name_english"),
        ),
    )
}
