"""Staging, roll-ups, core and metric marts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import customers, dashboards, metrics, orders, quality
from tidemark.functions.scalars import exact_ratio, share
from tidemark.plans.catalog import model_query, query

ITEM_MONEY = "item_price freight_value"
ORDER_MONEY = "items_subtotal freight_total payment_total order_revenue"
CUSTOMER_MONEY = "total_revenue"
MONTH_MONEY = "revenue new_customer_revenue returning_customer_revenue cumulative_revenue"

for name in ("stg_customers", "stg_orders", "stg_order_reviews", "stg_products", "stg_category_translation", "stg_sellers"):
    model_query(name, name)
model_query("stg_order_items", "stg_order_items", ITEM_MONEY)
model_query("stg_order_payments", "stg_order_payments", "payment_value")
model_query("stg_geolocation", "stg_geolocation", approx="latitude longitude")
model_query("items_per_order", "items_per_order", "items_subtotal freight_total items_gross_total")
model_query("payments_per_order", "payments_per_order", "payment_total")
model_query("reviews_per_order", "reviews_per_order")
model_query("orders_enriched", "orders_enriched", ORDER_MONEY)
model_query("fct_orders", "fct_orders", ORDER_MONEY)
model_query("dim_products", "dim_products")
model_query("dim_customers", "dim_customers", CUSTOMER_MONEY)
model_query("customer_rfm", "customer_rfm", CUSTOMER_MONEY)
model_query("kpi_summary", "kpi_summary", "total_revenue")
model_query("monthly_revenue", "monthly_revenue", MONTH_MONEY)
model_query("customer_acquisition_monthly", "customer_acquisition_monthly", "cohort_revenue_to_date")
model_query("category_performance", "category_performance", "item_revenue freight_revenue")
model_query("cohort_retention", "cohort_retention")


@query("customer_orders", """
  select customer_unique_id, min(purchase_date) as first_purchase_date, max(purchase_date) as last_purchase_date,
    count(*) as order_count, sum(order_revenue) as total_revenue, sum(item_count)::BIGINT as total_items,
    avg(review_score_avg) as review_mean, count(*) filter (is_late_delivery) as late_delivery_count,
    count(delivered_at) as delivered_order_count from valid group by customer_unique_id""", "total_revenue")
def customer_orders(w):
    return w.customer_rollup.drop("latest")


@query("latest_location", "select customer_unique_id, customer_state, customer_city, customer_zip_code_prefix from dim_customers")
def latest_location(w):
    return w.customer_rollup.select("customer_unique_id", "latest.customer_state", "latest.customer_city", "latest.customer_zip_code_prefix")


@query("customer_order_number", "select order_id, customer_order_number, is_first_purchase from orders_enriched")
def customer_order_number(w):
    return orders.with_sequence(w.stg_orders.select("order_id"), orders.purchase_sequence(w.joined_orders))


@query("geo_centroid", "select zip_code_prefix, latitude, longitude, source_point_count from stg_geolocation", approx="latitude longitude")
def geo_centroid(w):
    return w.stg_geolocation.select("zip_code_prefix", "latitude", "longitude", "source_point_count")


@query("rfm_segment_summary", """
  select rfm_segment, count(*) as customers,
    ((2 * 100 * count(*) * 10 + (sum(count(*)) over ())) // (2 * (sum(count(*)) over ())))::DOUBLE / 10.0 as pct_customers,
    floor(sum(total_revenue) + 0.5)::DOUBLE as revenue,
    floor(sum(days_since_last_purchase) / count(*) + 0.5) as avg_days_since_last_purchase,
    floor(sum(order_count) * 100 / count(*) + 0.5) / 100.0 as avg_orders
  from customer_rfm group by rfm_segment""")
def rfm_segment_summary(w):
    return customers.rfm_segment_summary(w.customer_rfm)


@query("approx_percentiles", """
  select count(*) as repeat_customers, quantile_cont(avg_days_between_purchases, 0.5) as p50_gap_days,
    quantile_cont(avg_days_between_purchases, 0.75) as p75_gap_days, quantile_cont(avg_days_between_purchases, 0.9) as p90_gap_days
  from dim_customers where is_repeat_customer""", approx="p50_gap_days p75_gap_days p90_gap_days")
def approx_percentiles(w):
    return customers.repeat_gap_percentiles(w.dim_customers)


@query("rfm_r_score", "select customer_unique_id, days_since_last_purchase, r_score from rfm_scores")
def rfm_r_score(w):
    days = -F.col("days_since_last_purchase")
    cuts = customers.score_cuts(w.dim_customers, days, "r", bounded=True)
    return w.dim_customers.crossJoin(F.broadcast(cuts)).select(
        "customer_unique_id", "days_since_last_purchase", customers.from_cuts(days, "r").alias("r_score"))


@query("rfm_m_score", "select customer_unique_id, total_revenue, m_score from rfm_scores", "total_revenue")
def rfm_m_score(w):
    spent = F.col("total_revenue")
    cuts = customers.score_cuts(w.dim_customers, spent, "m", bounded=False)
    return w.dim_customers.crossJoin(F.broadcast(cuts)).select(
        "customer_unique_id", "total_revenue", customers.from_cuts(spent, "m").alias("m_score"))


@query("f_score", "select customer_unique_id, order_count, f_score from rfm_scores")
def f_score(w):
    return w.dim_customers.select("customer_unique_id", "order_count", customers.f_score().alias("f_score"))


for key, columns in {
    "rfm_cell_total": "rfm_cell rfm_total_score", "rfm_segment": "rfm_segment", "is_high_value": "is_high_value",
    "activity_status": "activity_status", "retention_priority": "retention_priority",
}.items():
    picked = ["customer_unique_id", *columns.split()]
    query(key, f"select {', '.join(picked)} from customer_rfm")(lambda w, p=picked: w.customer_rfm.select(*p))


@query("running_revenue", "select purchase_month, revenue, cumulative_revenue from monthly_revenue", "revenue cumulative_revenue")
def running_revenue(w):
    return w.monthly_revenue.select("purchase_month", "revenue", "cumulative_revenue")


@query("share_of_total", """
  select product_category, item_revenue, item_revenue::DOUBLE / (sum(item_revenue) over ())::DOUBLE as revenue_share
  from category_performance""", "item_revenue", "revenue_share")
def share_of_total(w):
    total = F.sum("item_revenue").over(Window.partitionBy())
    return w.category_performance.select("product_category", "item_revenue", share("item_revenue", total).alias("revenue_share"))


@query("revenue_rank", "select product_category, revenue_rank from category_performance")
def revenue_rank(w):
    return w.category_performance.select("product_category", "revenue_rank")


@query("cohort_sizes", "select acquisition_month, count(*) as cohort_customers from dim_customers group by acquisition_month")
def cohort_sizes(w):
    return w.dim_customers.groupBy("acquisition_month").agg(F.count(F.lit(1)).alias("cohort_customers"))


@query("cohort_active_counts", "from cohort_activity")
def cohort_active_counts(w):
    return metrics.cohort_activity(w.customer_months)


@query("row_generator", """
  select acquisition_month, cohort_customers,
    unnest(range(0, date_diff('month', acquisition_month, (select max(purchase_month) from valid)) + 1))::INT as months_since_acquisition
  from (select acquisition_month, count(*) as cohort_customers from dim_customers group by acquisition_month)""")
def row_generator(w):
    """One row for every month of every cohort up to the last month with a purchase."""
    last = w.customer_months.agg(F.max("purchase_month").alias("last_month"))
    return metrics.cohort_grid(cohort_sizes(w), last)


@query("month_counts", """
  select date_trunc('month', order_purchase_timestamp)::DATE as order_month, count(*) as orders from raw_orders group by 1""")
def month_counts(w):
    return quality.month_counts(w.raw["orders"])


@query("distinct", "select distinct acquisition_month, customer_state from dim_customers")
def distinct(w):
    return w.dim_customers.select("acquisition_month", "customer_state").distinct()


@query("top_high_value_customers", """
  select customer_unique_id, customer_state, order_count, total_revenue, days_since_last_purchase, rfm_cell, rfm_segment,
    activity_status, retention_priority from customer_rfm where is_high_value
  order by retention_priority, total_revenue desc, customer_unique_id limit 10""", "total_revenue")
def top_high_value_customers(w):
    return customers.top_high_value_customers(w.customer_rfm)


@query("top_categories", "from category_performance order by revenue_rank, product_category limit 15", "item_revenue freight_revenue")
def top_categories(w):
    return dashboards.top_categories(w.category_performance)


@query("repeat_rate_by_state", """
  select customer_state, count(*) as customers, count(*) filter (is_repeat_customer) as repeat_customers,
    floor(10000 * count(*) filter (is_repeat_customer) / count(*) + 0.5) / 10000.0 as repeat_rate
  from dim_customers group by customer_state""")
def repeat_rate_by_state(w):
    grouped = w.dim_customers.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if("is_repeat_customer").alias("repeat_customers"))
    return grouped.withColumn("repeat_rate", exact_ratio("repeat_customers", "customers", 4))
