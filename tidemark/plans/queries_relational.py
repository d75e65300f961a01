"""Filters, joins, set operations and scalar functions, each on the canonical tables."""

from pyspark.sql import functions as F

from tidemark.config import PAYMENT_TYPES, VOID_STATUSES
from tidemark.functions import scalars
from tidemark.operators import customers, metrics, orders, quality, staging
from tidemark.plans.catalog import query


@query("valid_purchase_filter", "select order_id, order_status from stg_orders where is_valid_purchase")
def valid_purchase_filter(w):
    return w.stg_orders.where("is_valid_purchase").select("order_id", "order_status")


@query("not_in_list", """
  select order_id, payment_sequence, payment_type from stg_order_payments join stg_orders using (order_id)
  where order_status not in ('canceled', 'unavailable') and payment_type not in ('voucher', 'boleto')""")
def not_in_list(w):
    valid = w.stg_orders.where(~F.col("order_status").isin(*VOID_STATUSES)).select("order_id")
    paid = w.stg_order_payments.where(~F.col("payment_type").isin(PAYMENT_TYPES[2], PAYMENT_TYPES[1]))
    return paid.join(valid, "order_id").select("order_id", "payment_sequence", "payment_type")


@query("between_range", "select zip as zip_code_prefix, lat as latitude, lng as longitude, city, state from geo_points")
def between_range(w):
    return staging.points_in_box(w.raw["geolocation"])


@query("regex_full_match", """
  select customer_id, regexp_full_match(customer_zip_code_prefix, '[0-9]{5}') as zip_ok,
    regexp_full_match(customer_state, '[A-Z]{2}') as state_ok, regexp_full_match(customer_unique_id, '[0-9a-f]{32}') as id_ok
  from raw_customers""")
def regex_full_match(w):
    return w.raw["customers"].select(
        "customer_id",
        scalars.matches_whole("customer_zip_code_prefix", "[0-9]{5}").alias("zip_ok"),
        scalars.matches_whole("customer_state", "[A-Z]{2}").alias("state_ok"),
        scalars.matches_whole("customer_unique_id", "[0-9a-f]{32}").alias("id_ok"))


@query("like_predicate", """
  select rfm_segment, count(*) as customers from customer_rfm where rfm_segment like 'High-Value%' or rfm_segment like '%Customers' group by 1""")
def like_predicate(w):
    segment = F.col("rfm_segment")
    return w.customer_rfm.where(segment.like("High-Value%") | segment.like("%Customers")).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"))


@query("null_safe_compare", """
  select count(*) as orders, count(*) filter (delivered_at::DATE is not distinct from shipped_to_carrier_at::DATE) as same_or_both_missing from stg_orders""")
def null_safe_compare(w):
    same = F.to_date("delivered_at").eqNullSafe(F.to_date("shipped_to_carrier_at"))
    return w.stg_orders.agg(F.count(F.lit(1)).alias("orders"), F.count_if(same).alias("same_or_both_missing"))


@query("having_filter", "select order_item_key, count(*) as occurrences from stg_order_items group by 1 having count(*) > 1")
def having_filter(w):
    return quality.failing_unique(w.stg_order_items, "order_item_key")


@query("scalar_subquery", """
  select (select count(*) from raw_customers) as customers_rows, (select count(*) from raw_orders) as orders_rows,
    if((select count(*) from raw_customers) = (select count(*) from raw_orders), 'PASS', 'FAIL') as status""")
def scalar_subquery(w):
    return quality.one_customer_row_per_order(w.raw)


# ------------------------------------------------------------------ joins
@query("inner_equi_join", "select o.order_id, c.customer_unique_id, c.customer_state from stg_orders o, stg_customers c where o.customer_id = c.customer_id")
def inner_equi_join(w):
    return w.stg_orders.join(w.stg_customers, "customer_id").select("order_id", "customer_unique_id", "customer_state")


@query("left_outer_join", """
  select o.order_id, i.item_count, p.payment_count, r.review_count from stg_orders o left join items_per_order i on i.order_id = o.order_id
  left join payments_per_order p on p.order_id = o.order_id left join reviews_per_order r on r.order_id = o.order_id""")
def left_outer_join(w):
    rows = w.stg_orders.select("order_id")
    for rollup, column in ((w.items_per_order, "item_count"), (w.payments_per_order, "payment_count"), (w.reviews_per_order, "review_count")):
        rows = rows.join(rollup.select("order_id", column), "order_id", "left")
    return rows


@query("full_outer_join", """
  select ifnull(p.order_id, r.order_id) as order_id, payment_count, review_count
  from payments_per_order p full join reviews_per_order r on p.order_id = r.order_id""")
def full_outer_join(w):
    paid = w.payments_per_order.select("order_id", "payment_count")
    return paid.join(w.reviews_per_order.select("order_id", "review_count"), "order_id", "full")


@query("cross_join_scalar", """
  select customer_unique_id, last_purchase_date, (select max(purchase_date) from valid) as as_of_date from dim_customers""")
def cross_join_scalar(w):
    return w.dim_customers.select("customer_unique_id", "last_purchase_date", "as_of_date")


@query("cross_join_theta", "select acquisition_month, months_since_acquisition, cohort_customers from cohort_retention")
def cross_join_theta(w):
    sizes = w.dim_customers.groupBy("acquisition_month").agg(F.count(F.lit(1)).alias("cohort_customers"))
    last = w.monthly_revenue.where(~F.col("is_low_volume_month")).agg(F.max("purchase_month").alias("last_month"))
    return metrics.cohort_grid(sizes, last, w.cfg.cohort_offsets)


@query("anti_join_not_exists", "select order_id from raw_orders o where not exists (select 1 from raw_order_items i where i.order_id = o.order_id)")
def anti_join_not_exists(w):
    return w.raw["orders"].join(w.raw["order_items"].select("order_id").distinct(), "order_id", "left_anti").select("order_id")


@query("anti_join_left_null", """
  select o.order_id from raw_orders o left join (select distinct order_id from raw_order_payments) p on p.order_id = o.order_id where p.order_id is null""")
def anti_join_left_null(w):
    paid = w.raw["order_payments"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return w.raw["orders"].join(paid, "order_id", "left").where("n is null").select("order_id")


@query("using_join", """
  select order_id, items_gross_total, payment_total from items_per_order join payments_per_order using (order_id)""", "items_gross_total payment_total")
def using_join(w):
    return w.items_per_order.select("order_id", "items_gross_total").join(
        w.payments_per_order.select("order_id", "payment_total"), on=["order_id"])


# ------------------------------------------------------------------ aggregations and set operations
@query("distinct_multi_column", """
  select count(*) as total_rows, count(distinct (order_id, order_item_id)) as distinct_keys from raw_order_items""")
def distinct_multi_column(w):
    keys = w.raw["order_items"].groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"))


@query("distinct_rows", """
  select (select count(*) from raw_order_payments) - (select count(*) from (select distinct * from raw_order_payments)) as exact_duplicate_rows""")
def distinct_rows(w):
    return quality.duplicate_key_count(w.raw["order_payments"], w.raw["order_payments"].columns).select(
        F.col("duplicate_rows").alias("exact_duplicate_rows"))


@query("union_all", """
  select 'items' as kind, order_id from stg_order_items union all select 'payments', order_id from stg_order_payments
  union all select 'reviews', order_id from stg_order_reviews""")
def union_all(w):
    parts = {"items": w.stg_order_items, "payments": w.stg_order_payments, "reviews": w.stg_order_reviews}
    return quality.stack([df.select(F.lit(kind).alias("kind"), "order_id") for kind, df in parts.items()])


# ------------------------------------------------------------------ scalar functions
@query("scalar_text", """
  select order_id, left(order_id, 8) as short_id, order_id || '-' || order_item_number as item_key, lpad('7', 5, '0') as padded,
    upper(trim('  sp ')) as state, nullif(trim('   '), '') as blank from stg_order_items""")
def scalar_text(w):
    return w.stg_order_items.select(
        "order_id", F.substring("order_id", 1, 8).alias("short_id"),
        scalars.dashed_key("order_id", "order_item_number").alias("item_key"),
        scalars.zip_code(F.lit("7")).alias("padded"), scalars.upper_trim(F.lit("  sp ")).alias("state"),
        F.nullif(F.trim(F.lit("   ")), F.lit("")).alias("blank"))


@query("scalar_dates", """
  select order_id, strftime(purchased_at, '%Y-%m') as month_text, purchased_at::DATE as day, date_trunc('month', purchased_at)::DATE as month,
    (estimated_delivery_at::DATE - purchased_at::DATE)::INT as calendar_days, date_diff('second', purchased_at, approved_at) / 86400::DOUBLE as elapsed,
    date_diff('month', purchased_at, estimated_delivery_at)::INT as months_crossed, (purchased_at::DATE + interval 1 month)::DATE as next_month
  from stg_orders""")
def scalar_dates(w):
    bought, due = F.col("purchased_at"), F.col("estimated_delivery_at")
    return w.stg_orders.select(
        "order_id", F.date_format(bought, "yyyy-MM").alias("month_text"), F.to_date(bought).alias("day"),
        scalars.month_start(F.to_date(bought)).alias("month"), F.datediff(F.to_date(due), F.to_date(bought)).alias("calendar_days"),
        scalars.elapsed_days("approved_at", bought).alias("elapsed"),
        scalars.months_between_starts(due, bought).alias("months_crossed"),
        F.add_months(F.to_date(bought), 1).alias("next_month"))


@query("scalar_numeric", """
  select customer_unique_id, floor(days_since_last_purchase / 30)::BIGINT as months_ago, abs(days_since_last_purchase - 365) as distance,
    greatest(days_since_last_purchase, 180) as at_least, least(order_count, 4) as at_most, ln(1 + days_since_last_purchase) as logged,
    exp(-days_since_last_purchase / 365::DOUBLE) as decay, round_even(avg_review_score, 0) as stars, order_count::VARCHAR as text_count
  from dim_customers""", approx="logged decay")
def scalar_numeric(w):
    days = F.col("days_since_last_purchase")
    return w.dim_customers.select(
        "customer_unique_id", F.floor(days / 30).alias("months_ago"), F.abs(days - 365).alias("distance"),
        F.greatest(days, F.lit(180)).alias("at_least"), F.least("order_count", F.lit(4)).alias("at_most"),
        F.log1p(days).alias("logged"), F.exp(-days / 365.0).alias("decay"),
        scalars.half_even("avg_review_score", 0).alias("stars"), F.col("order_count").cast("string").alias("text_count"))


@query("scalar_conditional", """
  select customer_unique_id, case activity_status when 'Cooling' then 1.0 when 'Active' then 0.6 when 'Inactive' then 0.3 end::DOUBLE as urgency,
    case when days_since_last_purchase > 0 then case when days_since_last_purchase <= 90 then '0-90' when days_since_last_purchase <= 180 then '91-180'
      when days_since_last_purchase <= 365 then '181-365' else '365+' end end as recency_bin,
    ifnull(avg_days_between_purchases, -1) as gap_or_default
  from customer_rfm""")
def scalar_conditional(w):
    from tidemark.config import URGENCY
    from tidemark.operators.explore import RECENCY_EDGES, RECENCY_LABELS

    gap = F.coalesce(F.col("avg_days_between_purchases").cast("double"), F.lit(-1.0))
    return w.customer_rfm.select(
        "customer_unique_id", scalars.lookup("activity_status", URGENCY, "double").alias("urgency"),
        scalars.right_closed_bin("days_since_last_purchase", RECENCY_EDGES, RECENCY_LABELS).alias("recency_bin"),
        gap.alias("gap_or_default"))
