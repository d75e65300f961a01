"""Metric marts: headline KPIs, months, acquisition, categories and the cohort grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import RetentionConfig
from tidemark.functions.scalars import TOTAL, exact_ratio, months_between_starts
from tidemark.operators.orders import gathered
from tidemark.sources.scratch import store


def kpi_summary(rollup: DataFrame, customers: DataFrame) -> DataFrame:
    """One row. Medians are over whole days or tenths of days, a small fixed domain."""
    per_order = rollup.agg(
        F.min("first_purchase_date").alias("first_purchase_date"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.sum("order_count").alias("total_orders"),
        F.count("customer_unique_id").alias("unique_customers"),
        F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("total_items").alias("total_items"),
    )
    per_person = customers.agg(
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        F.count(F.lit(1)).alias("people"),
        F.sum("order_count").alias("people_orders"),
        F.sum("total_revenue").alias("people_revenue"),
        F.median("days_since_last_purchase").alias("median_days_since_last_purchase"),
        F.median(F.col("avg_days_between_purchases").cast("double")).alias(
            "median_days_between_purchases_repeaters"
        ),
    )
    return per_order.crossJoin(F.broadcast(per_person)).select(
        "first_purchase_date",
        "last_purchase_date",
        "total_revenue",
        "total_orders",
        "unique_customers",
        exact_ratio("total_revenue", "total_orders", 2).alias("avg_order_value"),
        exact_ratio("total_items", "total_orders", 2).alias("items_per_order"),
        "repeat_customers",
        exact_ratio("repeat_customers", "unique_customers", 4).alias("repeat_purchase_rate"),
        exact_ratio("people_orders", "people", 3).alias("avg_orders_per_customer"),
        exact_ratio("people_revenue", "people", 2).alias("avg_revenue_per_customer"),
        "median_days_since_last_purchase",
        "median_days_between_purchases_repeaters",
    )


def customer_months(joined: DataFrame) -> DataFrame:
    """One row per person and purchase month, with the person's first month.

    Orders collapse here before anything else is keyed by person, so distinct
    counting downstream becomes plain counting and a very active person holds at
    most one row per month.
    """
    monthly = (
        joined.where("is_valid_purchase and customer_unique_id is not null")
        .groupBy("customer_unique_id", "purchase_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_revenue").cast(TOTAL).alias("revenue"),
            F.sum("item_count").alias("items"),
        )
    )
    person = Window.partitionBy("customer_unique_id")
    return monthly.withColumn("acquisition_month", F.min("purchase_month").over(person))


def monthly_revenue(months: DataFrame, cfg: RetentionConfig) -> DataFrame:
    fresh = F.col("acquisition_month") == F.col("purchase_month")
    zero = F.lit(0).cast(TOTAL)
    monthly = months.groupBy("purchase_month").agg(
        F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("unique_customers"),
        F.sum("revenue").cast(TOTAL).alias("revenue"),
        F.sum("items").alias("items"),
        F.count_if(fresh).alias("new_customers"),
        F.count_if(~fresh).alias("returning_customers"),
        F.sum(F.when(fresh, F.col("revenue")).otherwise(zero)).cast(TOTAL).alias("new_customer_revenue"),
        F.sum(F.when(~fresh, F.col("revenue")).otherwise(zero)).cast(TOTAL).alias("returning_customer_revenue"),
    )
    so_far = Window.orderBy("purchase_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "purchase_month",
        "orders",
        "unique_customers",
        "revenue",
        exact_ratio("revenue", "orders", 2).alias("avg_order_value"),
        exact_ratio("items", "orders", 2).alias("items_per_order"),
        "new_customers",
        "returning_customers",
        "new_customer_revenue",
        "returning_customer_revenue",
        exact_ratio("returning_customers", "unique_customers", 4).alias("returning_customer_share"),
        F.sum("revenue").over(so_far).cast(TOTAL).alias("cumulative_revenue"),
        (F.col("orders") < cfg.small_month_orders).alias("is_low_volume_month"),
    )


def customer_acquisition_monthly(customers: DataFrame) -> DataFrame:
    grouped = customers.groupBy("acquisition_month").agg(
        F.count(F.lit(1)).alias("new_customers"),
        F.count_if("is_repeat_customer").alias("customers_who_returned"),
        F.sum("total_revenue").cast(TOTAL).alias("cohort_revenue_to_date"),
        F.max("as_of_date").alias("as_of_date"),
    )
    return grouped.select(
        "acquisition_month",
        "new_customers",
        "customers_who_returned",
        exact_ratio("customers_who_returned", "new_customers", 4).alias("cohort_repeat_rate"),
        "cohort_revenue_to_date",
        exact_ratio("cohort_revenue_to_date", "new_customers", 2).alias("avg_revenue_per_customer"),
        months_between_starts("as_of_date", "acquisition_month").alias("months_observed"),
    )


def category_lines(items: DataFrame, joined: DataFrame, products: DataFrame) -> DataFrame:
    """One row per (order, product) of valid orders with its category and sums.

    Lines are brought to their orders once, summed there per (order, product) and joined
    with the orders in place; only then do they move on to the products.
    """
    lines = gathered(items).groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("item_price").cast(TOTAL).alias("price"),
        F.count("item_price").alias("priced"),
        F.sum("freight_value").cast(TOTAL).alias("freight"),
    )
    valid = joined.where("is_valid_purchase").select("order_id", "customer_unique_id", "review_score_avg")
    category = products.select("product_id", "product_category")
    return lines.join(valid, "order_id").join(category, "product_id")


def category_performance(items: DataFrame, joined: DataFrame, products: DataFrame, stored: bool = True) -> DataFrame:
    """Two levels: (category, order) then category.

    The first level makes orders and order-level reviews plain counts and means,
    leaving one distinct count. Products sold are the distinct products of the same
    lines, which are stored once for both; a reader of few columns needs them once and leaves them a plan.
    """
    lines = category_lines(items, joined, products)
    if stored:
        lines = store(lines, "category-lines")
    per_order = lines.groupBy("product_category", "order_id").agg(
        F.sum("lines").alias("lines"),
        F.sum("price").cast(TOTAL).alias("price"),
        F.sum("priced").alias("priced"),
        F.sum("freight").cast(TOTAL).alias("freight"),
        F.max("customer_unique_id").alias("customer_unique_id"),
        F.max("review_score_avg").alias("review"),
    )
    sales = per_order.groupBy("product_category").agg(
        F.sum("lines").alias("items_sold"),
        F.count("order_id").alias("orders"),
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        F.sum("price").cast(TOTAL).alias("item_revenue"),
        F.sum("freight").cast(TOTAL).alias("freight_revenue"),
        F.sum("priced").alias("priced"),
        F.round(F.avg("review"), 2).alias("avg_review_score"),
    )
    sold = lines.select("product_category", "product_id").distinct().groupBy("product_category").agg(
        F.count(F.lit(1)).alias("products_sold"))
    everything = Window.partitionBy()
    return sales.join(sold, "product_category", "left").select(
        "product_category",
        "items_sold",
        "orders",
        "unique_customers",
        "products_sold",
        "item_revenue",
        "freight_revenue",
        exact_ratio("item_revenue", "priced", 2).alias("avg_item_price"),
        F.round(
            F.col("item_revenue").cast("double") / F.sum("item_revenue").over(everything).cast("double"), 4
        ).alias("item_revenue_share"),
        F.rank().over(Window.orderBy(F.desc("item_revenue"))).cast("long").alias("revenue_rank"),
        "avg_review_score",
    )


def cohort_activity(months: DataFrame) -> DataFrame:
    """(cohort, offset) -> active people; people are already distinct per month."""
    offset = months_between_starts("purchase_month", "acquisition_month")
    return (
        months.select("acquisition_month", offset.alias("months_since_acquisition"))
        .groupBy("acquisition_month", "months_since_acquisition")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )


def cohort_grid(sizes: DataFrame, last_month: DataFrame, last_offset: int | None = None) -> DataFrame:
    """Every month offset of every cohort up to ``last_month``, a single row (bounded by months squared).

    ``last_offset`` shortens the grid for display; activity behind it is then left out.
    """
    reach = months_between_starts("last_month", "acquisition_month")
    if last_offset is not None:
        reach = F.least(reach, F.lit(last_offset))
    within = sizes.crossJoin(F.broadcast(last_month)).where("acquisition_month <= last_month")
    return within.withColumn("months_since_acquisition", F.explode(F.sequence(F.lit(0), reach))).drop("last_month")


def cohort_retention(months: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """The whole grid derives from one (cohort, offset) aggregate of at most months-squared rows."""
    active = cohort_activity(months)
    sizes = active.where("months_since_acquisition = 0").select(
        "acquisition_month", F.col("active_customers").alias("cohort_customers")
    )
    full = monthly_revenue(months, cfg).where(~F.col("is_low_volume_month"))
    last_month = full.agg(F.max("purchase_month").alias("last_month"))
    keys = ["acquisition_month", "months_since_acquisition"]
    people = F.coalesce("active_customers", F.lit(0))
    label = F.concat(
        F.date_format("acquisition_month", "yyyy-MM"), F.lit("+"),
        F.col("months_since_acquisition").cast("string"),
    )
    return cohort_grid(sizes, last_month, cfg.cohort_offsets).join(active, keys, "left").select(
        label.alias("cohort_key"),
        *keys,
        "cohort_customers",
        people.alias("active_customers"),
        exact_ratio(people, "cohort_customers", 5).alias("retention_rate"),
        (F.col("cohort_customers") < cfg.small_cohort_customers).alias("is_small_cohort"),
    )
