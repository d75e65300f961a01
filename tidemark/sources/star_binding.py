"""Raw retail tables derived from a generic star schema (orders, lineitem, customer, part, supplier).

Every row of the star tables takes part. A person is a slice of a star-schema
customer, so that most people buy once or twice, as in real marketplaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PEOPLE_PER_ACCOUNT = 8


class StarTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def hex_id(kind: int, key: Column) -> Column:
    """32 lower-case hex digits: the kind of thing, its number, sixteen zeros."""
    return F.concat(F.lower(F.hex(key.cast("long") + F.lit(kind << 60))), F.lit("0" * 16))


ORDER, CUSTOMER, PERSON, REVIEW, PRODUCT, SELLER = range(1, 7)


def state_of(nation: Column) -> Column:
    return F.when(nation % 3 == 0, "SP").when(nation % 3 == 1, "RJ").otherwise("MG")


def zip_of(nation: Column) -> Column:
    return (nation * 397 + 101).cast("string")


def days(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(n) if isinstance(n, int) else n)


def bought_at(order_key: Column, order_date: Column) -> Column:
    return order_date + F.make_dt_interval(F.lit(0), (order_key % 24).cast("int"))


def retail_price(c: str) -> Column:
    """Wholesale line amount scaled to consumer prices, exact to the cent."""
    cents = F.floor(F.round(F.col(c) * 100) / 400)
    return (cents / 100).cast("decimal(10,2)")


def orders(star: StarTables) -> DataFrame:
    # Gathered before the aggregate, as an order's few lines would hardly collapse within a file.
    lines = star.read("lineitem").where("l_orderkey is not null").repartition("l_orderkey")
    ships = lines.groupBy("l_orderkey").agg(
        F.min("l_linenumber").alias("first_line"),
        F.max("l_quantity").cast("int").alias("max_quantity"),
        F.min("l_discount").alias("min_discount"),
        F.max("l_tax").alias("max_tax"),
    )
    o = star.read("orders")
    status, priority = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    order_status = (
        F.when(status == "F", "delivered")
        .when((status == "O") & priority.isin("1", "2"), "shipped")
        .when((status == "O") & (priority == "3"), "approved")
        .when((status == "O") & (priority == "4"), "processing")
        .when(status == "O", "canceled")
        .when(priority == "1", "invoiced")
        .when(priority == "2", "created")
        .when(priority == "3", "delivered")
        .when(priority == "4", "unavailable")
        .otherwise("canceled")
    )
    bought = bought_at(F.col("o_orderkey"), F.col("o_orderdate"))
    carrier_days = F.col("first_line") - F.when(F.col("min_discount") == 0, 2).otherwise(0)
    delivery_days = F.col("max_quantity") - F.when(F.col("max_tax") == 0, 60).otherwise(0)
    has_carrier = order_status.isin("delivered", "shipped")
    return o.join(ships, o.o_orderkey == ships.l_orderkey, "left").select(
        hex_id(ORDER, F.col("o_orderkey")).alias("order_id"),
        hex_id(CUSTOMER, F.col("o_orderkey")).alias("customer_id"),
        order_status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        (bought + F.expr("interval '1' hour")).alias("order_approved_at"),
        F.when(has_carrier, bought + days(carrier_days)).alias("order_delivered_carrier_date"),
        F.when(order_status == "delivered", bought + days(delivery_days)).alias(
            "order_delivered_customer_date"
        ),
        (F.col("o_orderdate") + days(48)).alias("order_estimated_delivery_date"),
    )


def customers(star: StarTables) -> DataFrame:
    o, c = star.read("orders"), star.read("customer")
    nation = F.col("c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        hex_id(CUSTOMER, F.col("o_orderkey")).alias("customer_id"),
        hex_id(PERSON, F.col("o_custkey") * PEOPLE_PER_ACCOUNT + F.col("o_orderkey") % PEOPLE_PER_ACCOUNT).alias("customer_unique_id"),
        zip_of(nation).alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("customer_city"),
        state_of(nation).alias("customer_state"),
    )


def order_items(star: StarTables) -> DataFrame:
    return star.read("lineitem").select(
        hex_id(ORDER, F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        hex_id(PRODUCT, F.col("l_partkey")).alias("product_id"),
        hex_id(SELLER, F.col("l_suppkey")).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        retail_price("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
    )


def order_payments(star: StarTables) -> DataFrame:
    """Returned or accepted lines were paid; open ones have a payment row without a value."""
    kind = (
        F.when(F.col("l_returnflag") == "A", "credit_card")
        .when(F.col("l_linestatus") == "F", "voucher")
        .otherwise("boleto")
    )
    return star.read("lineitem").select(
        hex_id(ORDER, F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        kind.alias("payment_type"),
        (F.col("l_linenumber") - 1).alias("payment_installments"),
        F.when(F.col("l_returnflag") != "N", retail_price("l_extendedprice")).alias("payment_value"),
    )


def order_reviews(star: StarTables) -> DataFrame:
    """Every order was asked for a review; those without a stated priority gave no score."""
    bought = bought_at(F.col("o_orderkey"), F.col("o_orderdate"))
    message = F.concat(
        F.lit('said "'), F.col("o_orderpriority"), F.lit('", on time'), F.lit("\n"),
        F.lit("order "), F.col("o_orderkey").cast("string"),
    )
    stated = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    return star.read("orders").select(
        hex_id(REVIEW, F.col("o_custkey") * 100_000 + F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("review_id"),
        hex_id(ORDER, F.col("o_orderkey")).alias("order_id"),
        F.when(stated, F.substring("o_orderpriority", 1, 1).cast("int")).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.when(F.col("o_orderstatus") == "F", message).alias("review_comment_message"),
        (F.col("o_orderdate") + days(10)).alias("review_creation_date"),
        (bought + days(12)).alias("review_answer_timestamp"),
    )


def products(star: StarTables) -> DataFrame:
    size = F.col("p_size")
    return star.read("part").select(
        hex_id(PRODUCT, F.col("p_partkey")).alias("product_id"),
        F.when(F.col("p_type") != "SMALL", F.lower("p_type")).otherwise(" ").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 4).alias("product_photos_qty"),
        (size % 10).alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def sellers(star: StarTables) -> DataFrame:
    s, n = star.read("supplier"), star.read("nation")
    nation = F.col("s_nationkey")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        hex_id(SELLER, F.col("s_suppkey")).alias("seller_id"),
        zip_of(nation).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        state_of(nation).alias("seller_state"),
    )


def geolocation(star: StarTables) -> DataFrame:
    nation = F.col("c_nationkey")
    return star.read("customer").select(
        zip_of(nation).alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 200 - 30).alias("geolocation_lat"),
        (-(F.col("c_custkey") % 120)).cast("double").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        state_of(nation).alias("geolocation_state"),
    )


def product_category_translation(star: StarTables) -> DataFrame:
    """Every category has an English name; two are filed under an outdated name that no product bears."""
    name = F.when(F.col("p_type").isin("SMALL", "PROMO"), F.concat(F.lower("p_type"), F.lit("_old"))).otherwise(F.lower("p_type"))
    return (
        star.read("part")
        .select(name.alias("product_category_name"), F.concat(name, F.lit("_en")).alias("product_category_name_english"))
        .distinct()
    )


DERIVATIONS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "product_category_translation": product_category_translation,
}


def raw_tables(star: StarTables) -> dict[str, DataFrame]:
    return {name: derive(star) for name, derive in DERIVATIONS.items()}
