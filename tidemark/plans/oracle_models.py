"""Independent DuckDB SQL for every model, used as named CTEs by the oracle queries.

Written for checking only: plain windows and joins, no attention to scale.
"""

from __future__ import annotations

import re

from tidemark.config import ACTIONS, GROUP_PLAYBOOK, MODEL_FEATURES, RECOVERY_ACTION, RECOVERY_REASON, URGENCY


def ratio(num: str, den: str, places: int, scale: int = 0) -> str:
    """Half-up rounding of a non-negative quotient in integer arithmetic."""
    top = f"(({num}) * {10**scale})::HUGEINT"
    bottom = f"(({den})::HUGEINT * {10**scale})"
    return f"((2 * {top} * {10**places} + {bottom}) // nullif(2 * {bottom}, 0))::DOUBLE / {float(10**places)}"


def money_ratio(num: str, den: str, places: int) -> str:
    return ratio(num, den, places, scale=2)


def half_up(x: str, places: int) -> str:
    return f"round({x} + 1e-9, {places})"


def half_even(x: str, places: int) -> str:
    return f"round_even(({x}) * {float(10**places)}::DOUBLE, 0) / {float(10**places)}::DOUBLE"


def avg_rank(expr: str, over: str = "") -> str:
    """Average-tie percentile of an expression, optionally within a partition."""
    part = f"partition by {over}" if over else ""
    tie = f"partition by {over}, {expr}" if over else f"partition by {expr}"
    return (
        f"((rank() over ({part} order by {expr}))::DOUBLE + (count(*) over ({tie}) - 1)::DOUBLE / 2::DOUBLE)"
        f" / (count(*) over ({part}))::DOUBLE"
    )


def case_map(column: str, mapping: dict, cast: str) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"(case {column} {arms} end)::{cast}"


def hex_id(kind: int, key: str) -> str:
    return f"format('{{:x}}', ({key})::BIGINT + {kind << 60}) || repeat('0', 16)"


def state_sql(c: str) -> str:
    return f"case {c} % 3 when 0 then 'SP' when 1 then 'RJ' else 'MG' end"


MODELS: dict[str, str] = {}
MODELS["ships"] = """
  select l_orderkey, min(l_linenumber) as first_line, max(l_quantity)::INT as max_quantity,
         min(l_discount) as min_discount, max(l_tax) as max_tax
  from lineitem group by all"""
MODELS["raw_orders"] = f"""
  with base as (
    select *, o_orderdate + to_hours((o_orderkey % 24)::INT) as bought, left(o_orderpriority, 1) as p,
      case
        when o_orderstatus = 'F' then 'delivered'
        when o_orderstatus = 'O' then case left(o_orderpriority, 1) when '1' then 'shipped' when '2' then 'shipped'
             when '3' then 'approved' when '4' then 'processing' else 'canceled' end
        else case left(o_orderpriority, 1) when '1' then 'invoiced' when '2' then 'created' when '3' then 'delivered'
             when '4' then 'unavailable' else 'canceled' end
      end as st
    from orders left join ships on l_orderkey = o_orderkey)
  select {hex_id(1, 'o_orderkey')} as order_id, {hex_id(2, 'o_orderkey')} as customer_id, st as order_status,
    bought as order_purchase_timestamp, bought + interval 1 hour as order_approved_at,
    case when st in ('delivered', 'shipped')
         then bought + to_days((first_line - if(min_discount = 0, 2, 0))::INT) end as order_delivered_carrier_date,
    case when st = 'delivered'
         then bought + to_days((max_quantity - if(max_tax = 0, 60, 0))::INT) end as order_delivered_customer_date,
    o_orderdate + interval 48 day as order_estimated_delivery_date
  from base"""
MODELS["raw_customers"] = f"""
  select {hex_id(2, 'o_orderkey')} as customer_id, {hex_id(3, 'o_custkey * 8 + o_orderkey % 8')} as customer_unique_id,
    (c_nationkey * 397 + 101)::VARCHAR as customer_zip_code_prefix, ' ' || c_mktsegment as customer_city,
    {state_sql('c_nationkey')} as customer_state
  from orders join customer on c_custkey = o_custkey"""
CENTS = "((l_extendedprice::DECIMAL(12,2) * 100)::BIGINT // 400 / 100.0)::DECIMAL(10,2)"
MODELS["raw_order_items"] = f"""
  select {hex_id(1, 'l_orderkey')} as order_id, l_linenumber as order_item_id, {hex_id(5, 'l_partkey')} as product_id,
    {hex_id(6, 'l_suppkey')} as seller_id, l_shipdate as shipping_limit_date,
    {CENTS} as price, l_quantity::DECIMAL(10,2) as freight_value
  from lineitem"""
MODELS["raw_order_payments"] = f"""
  select {hex_id(1, 'l_orderkey')} as order_id, l_linenumber as payment_sequential,
    case when l_returnflag = 'A' then 'credit_card' when l_linestatus = 'F' then 'voucher' else 'boleto' end as payment_type,
    l_linenumber - 1 as payment_installments, case when l_returnflag <> 'N' then {CENTS} end as payment_value
  from lineitem"""
MODELS["raw_order_reviews"] = f"""
  select {hex_id(4, 'o_custkey * 100000 + year(o_orderdate) * 12 + month(o_orderdate)')} as review_id, {hex_id(1, 'o_orderkey')} as order_id,
    case when o_orderpriority <> '4-NOT SPECIFIED' then left(o_orderpriority, 1)::INT end as review_score, null::VARCHAR as review_comment_title,
    case when o_orderstatus = 'F'
         then 'said "' || o_orderpriority || '", on time' || chr(10) || 'order ' || o_orderkey end as review_comment_message,
    o_orderdate + interval 10 day as review_creation_date,
    o_orderdate + to_hours((o_orderkey % 24)::INT) + interval 12 day as review_answer_timestamp
  from orders"""
MODELS["raw_products"] = f"""
  select {hex_id(5, 'p_partkey')} as product_id, if(p_type <> 'SMALL', lower(p_type), ' ') as product_category_name,
    length(p_name)::INT as product_name_lenght, length(p_brand)::INT as product_description_lenght,
    (p_size % 4)::INT as product_photos_qty, (p_size % 10)::INT as product_weight_g,
    p_size::INT as product_length_cm, p_size::INT as product_height_cm, p_size::INT as product_width_cm
  from part"""
MODELS["raw_sellers"] = f"""
  select {hex_id(6, 's_suppkey')} as seller_id, (s_nationkey * 397 + 101)::VARCHAR as seller_zip_code_prefix,
    n_name as seller_city, {state_sql('s_nationkey')} as seller_state
  from supplier join nation on n_nationkey = s_nationkey"""
MODELS["raw_geolocation"] = f"""
  select (c_nationkey * 397 + 101)::VARCHAR as geolocation_zip_code_prefix, c_acctbal / 200 - 30 as geolocation_lat,
    (-(c_custkey % 120))::DOUBLE as geolocation_lng, c_mktsegment as geolocation_city,
    {state_sql('c_nationkey')} as geolocation_state
  from customer"""
MODELS["raw_product_category_translation"] = """
  select distinct n as product_category_name, n || '_en' as product_category_name_english
  from (select if(p_type in ('SMALL', 'PROMO'), lower(p_type) || '_old', lower(p_type)) as n from part)"""

MODELS["stg_customers"] = """
  from raw_customers select customer_id, customer_unique_id,
    lpad(trim(customer_zip_code_prefix), 5, '0') as customer_zip_code_prefix,
    trim(lower(customer_city)) as customer_city, trim(upper(customer_state)) as customer_state"""
MODELS["stg_sellers"] = """
  from raw_sellers select seller_id, lpad(trim(seller_zip_code_prefix), 5, '0') as seller_zip_code_prefix,
    trim(lower(seller_city)) as seller_city, trim(upper(seller_state)) as seller_state"""
MODELS["stg_orders"] = """
  with o as (from raw_orders select *, trim(lower(order_status)) as st, order_purchase_timestamp as t,
             order_delivered_carrier_date as car, order_delivered_customer_date as arr)
  select order_id, customer_id, st as order_status, t as purchased_at, order_approved_at as approved_at,
    if(car < t, null, car) as shipped_to_carrier_at, if(arr < t, null, arr) as delivered_at,
    order_estimated_delivery_date as estimated_delivery_at,
    (car < t) is true or (arr < t) is true or (arr < car) is true or (st = 'delivered' and arr is null) as has_date_quality_issue,
    t::DATE as purchase_date, date_trunc('month', t)::DATE as purchase_month,
    st <> 'canceled' and st <> 'unavailable' as is_valid_purchase
  from o"""
MODELS["stg_order_items"] = """
  from raw_order_items select order_id || '-' || order_item_id as order_item_key, order_id,
    order_item_id as order_item_number, product_id, seller_id, shipping_limit_date as shipping_limit_at,
    price as item_price, freight_value"""
MODELS["stg_order_payments"] = """
  from raw_order_payments select order_id || '-' || payment_sequential as order_payment_key, order_id,
    payment_sequential as payment_sequence, trim(lower(payment_type)) as payment_type,
    case when payment_installments > 1 then payment_installments else 1 end as payment_installments, payment_value"""
MODELS["stg_order_reviews"] = """
  from raw_order_reviews select review_id || '-' || order_id as review_order_key, review_id, order_id, review_score,
    review_comment_title as comment_title, review_comment_message as comment_message,
    review_comment_message is not null as has_comment, review_creation_date as survey_sent_at,
    review_answer_timestamp as survey_answered_at"""
MODELS["stg_products"] = """
  from raw_products select product_id,
    case when trim(product_category_name) <> '' then trim(product_category_name) end as product_category_name_pt,
    product_name_lenght as product_name_length, product_description_lenght as product_description_length,
    product_photos_qty as product_photo_count,
    case when product_weight_g <> 0 then product_weight_g end as product_weight_g,
    product_length_cm, product_height_cm, product_width_cm"""
MODELS["stg_category_translation"] = """
  from raw_product_category_translation select trim(product_category_name) as product_category_name_pt,
    trim(product_category_name_english) as product_category_name_en"""
MODELS["geo_points"] = """
  select lpad(trim(geolocation_zip_code_prefix), 5, '0') as zip, geolocation_lat as lat, geolocation_lng as lng,
    trim(lower(geolocation_city)) as city, trim(upper(geolocation_state)) as state
  from raw_geolocation
  where geolocation_lat >= -34 and geolocation_lat <= 6 and geolocation_lng >= -74 and geolocation_lng <= -34"""
MODELS["stg_geolocation"] = """
  select g.zip as zip_code_prefix, avg(lat) as latitude, avg(lng) as longitude,
    (select city from geo_points c where c.zip = g.zip group by city order by count(*) desc, city limit 1) as city,
    (select state from geo_points s where s.zip = g.zip group by state order by count(*) desc, state limit 1) as state,
    count(*) as source_point_count
  from geo_points g group by g.zip"""

MODELS["items_per_order"] = """
  select order_id, count(*) as item_count, count(distinct product_id) as distinct_product_count,
    count(distinct seller_id) as seller_count, sum(item_price) as items_subtotal, sum(freight_value) as freight_total,
    sum(item_price) + sum(freight_value) as items_gross_total
  from stg_order_items group by order_id"""
MODELS["payments_per_order"] = """
  with r as (select *, if(payment_value is null, null,
               row_number() over (partition by order_id order by payment_value desc nulls last, payment_type desc)) as n
             from stg_order_payments)
  select order_id, sum(payment_value) as payment_total, count(*) as payment_count,
    max(payment_installments) as max_installments, max(payment_type) filter (n = 1) as main_payment_type
  from r group by order_id"""
MODELS["reviews_per_order"] = """
  select order_id, avg(review_score) as review_score_avg, min(review_score) as review_score_min, count(*) as review_count
  from stg_order_reviews group by order_id"""
MODELS["joined_orders"] = """
  select o.order_id, o.customer_id, customer_unique_id, customer_state, customer_city, customer_zip_code_prefix,
    order_status, is_valid_purchase, purchased_at, purchase_date, purchase_month, approved_at, shipped_to_carrier_at,
    delivered_at, estimated_delivery_at, has_date_quality_issue,
    ifnull(item_count, 0) as item_count, ifnull(distinct_product_count, 0) as distinct_product_count,
    ifnull(items_subtotal, 0) as items_subtotal, ifnull(freight_total, 0) as freight_total,
    payment_total, payment_count, main_payment_type, max_installments,
    case when payment_total is not null then payment_total when items_gross_total is not null then items_gross_total
         else 0 end as order_revenue,
    review_score_avg, review_score_min, ifnull(review_count, 0) as review_count,
    (delivered_at::DATE - purchased_at::DATE)::INT as delivery_days,
    delivered_at::DATE > estimated_delivery_at::DATE as is_late_delivery,
    case when delivered_at::DATE > estimated_delivery_at::DATE then (delivered_at::DATE - estimated_delivery_at::DATE)::INT
         when delivered_at is not null and estimated_delivery_at is not null then 0 end as days_late
  from stg_orders o join stg_customers c using (customer_id)
  left join items_per_order i on i.order_id = o.order_id
  left join payments_per_order p on p.order_id = o.order_id
  left join reviews_per_order r on r.order_id = o.order_id"""
MODELS["orders_enriched"] = """
  with n as (
    select order_id, row_number() over (partition by customer_unique_id order by purchased_at, order_id) as seq
    from joined_orders where is_valid_purchase)
  select j.*, seq as customer_order_number, ifnull(seq = 1, false) as is_first_purchase
  from joined_orders j left join n using (order_id)"""
MODELS["fct_orders"] = """
  select order_id, customer_unique_id, customer_id, customer_state, order_status, is_valid_purchase,
    customer_order_number, is_first_purchase, purchased_at, purchase_date, purchase_month, approved_at,
    shipped_to_carrier_at, delivered_at, estimated_delivery_at, has_date_quality_issue, item_count,
    distinct_product_count, items_subtotal, freight_total, payment_total, order_revenue, main_payment_type,
    max_installments, review_score_avg, review_count, delivery_days, is_late_delivery, days_late
  from orders_enriched"""
MODELS["dim_products"] = """
  select product_id, p.product_category_name_pt,
    ifnull(product_category_name_en, ifnull(p.product_category_name_pt, 'unknown')) as product_category,
    product_name_length, product_description_length, product_photo_count, product_weight_g,
    product_length_cm, product_height_cm, product_width_cm
  from stg_products p left join stg_category_translation t on t.product_category_name_pt = p.product_category_name_pt"""
MODELS["valid"] = "from joined_orders where is_valid_purchase"
MODELS["dim_customers"] = f"""
  with place as (
    select customer_unique_id, customer_state, customer_city, customer_zip_code_prefix from valid
    qualify row_number() over (partition by customer_unique_id order by purchased_at desc, order_id desc) = 1),
  per as (
    select customer_unique_id, min(purchase_date) as f, max(purchase_date) as l, count(*) as n, sum(order_revenue) as rev,
      sum(item_count)::BIGINT as items, avg(review_score_avg) as review,
      count(*) filter (is_late_delivery) as late, count(delivered_at) as arrived
    from valid group by customer_unique_id)
  select customer_unique_id, customer_state, customer_city, customer_zip_code_prefix,
    f as first_purchase_date, date_trunc('month', f)::DATE as acquisition_month, l as last_purchase_date,
    n as order_count, n >= 2 as is_repeat_customer, rev as total_revenue,
    {money_ratio('rev', 'n', 2)} as avg_order_value, items as total_items, {ratio('items', 'n', 2)} as items_per_order,
    {half_up('review', 2)} as avg_review_score, late as late_delivery_count, arrived as delivered_order_count,
    ((select max(l) from per) - l)::INT as days_since_last_purchase, (l - f)::INT as customer_tenure_days,
    case when n >= 2 then {ratio('(l - f)', 'n - 1', 1)} end as avg_days_between_purchases,
    (select max(l) from per) as as_of_date
  from per join place using (customer_unique_id)"""
MODELS["rfm_scores"] = """
  select *,
    least(5, floor(percent_rank() over (order by days_since_last_purchase desc) * 5) + 1)::INT as r_score,
    least(5, floor(percent_rank() over (order by total_revenue) * 5) + 1)::INT as m_score,
    least(order_count, 5)::INT as f_score
  from dim_customers"""
MODELS["customer_rfm"] = """
  with a as (
    select *, r_score::VARCHAR || f_score || m_score as rfm_cell, r_score + f_score + m_score as rfm_total_score,
      m_score = 5 or (f_score > 1 and m_score = 4) as is_high_value,
      if(days_since_last_purchase > 365, 'Inactive', if(days_since_last_purchase > 180, 'Cooling', 'Active')) as activity_status
    from rfm_scores)
  select * exclude (is_high_value, activity_status),
    if(f_score > 1,
       if(r_score < 3, 'At-Risk Repeat Customers', if(r_score > 3 and m_score > 3, 'Champions', 'Loyal Customers')),
       if(m_score = 5, if(r_score > 2, 'High-Value Recent', 'High-Value Lapsing'),
          case r_score when 1 then 'Lost' when 2 then 'Hibernating' when 3 then 'Needs Attention'
               else 'Recent One-Time Buyers' end)) as rfm_segment,
    is_high_value, activity_status,
    if(is_high_value, case activity_status when 'Cooling' then 1 when 'Inactive' then 2 else 3 end,
       if(is_repeat_customer and activity_status <> 'Active', 2, 4))::INT as retention_priority
  from a"""

MODELS["kpi_summary"] = f"""
  with o as (select min(purchase_date) as a, max(purchase_date) as b, sum(order_revenue) as rev, count(*) as n,
               count(distinct customer_unique_id) as u, sum(item_count)::BIGINT as items from valid),
  c as (select count(*) filter (is_repeat_customer) as rep, count(*) as people, sum(order_count)::BIGINT as po,
          sum(total_revenue) as pr, median(days_since_last_purchase) as m1, median(avg_days_between_purchases) as m2
        from dim_customers)
  select a as first_purchase_date, b as last_purchase_date, rev as total_revenue, n as total_orders, u as unique_customers,
    {money_ratio('rev', 'n', 2)} as avg_order_value, {ratio('items', 'n', 2)} as items_per_order,
    rep as repeat_customers, {ratio('rep', 'u', 4)} as repeat_purchase_rate,
    {ratio('po', 'people', 3)} as avg_orders_per_customer, {money_ratio('pr', 'people', 2)} as avg_revenue_per_customer,
    m1::DOUBLE as median_days_since_last_purchase, m2::DOUBLE as median_days_between_purchases_repeaters
  from o, c"""
MODELS["monthly_revenue"] = f"""
  with x as (select v.*, d.acquisition_month = v.purchase_month as fresh
             from valid v join dim_customers d using (customer_unique_id)),
  m as (select purchase_month, count(*) as n, count(distinct customer_unique_id) as u, sum(order_revenue) as rev,
          sum(item_count)::BIGINT as items,
          count(distinct customer_unique_id) filter (fresh) as nu, count(distinct customer_unique_id) filter (not fresh) as ru,
          ifnull(sum(order_revenue) filter (fresh), 0) as nrev, ifnull(sum(order_revenue) filter (not fresh), 0) as rrev
        from x group by purchase_month)
  select purchase_month, n as orders, u as unique_customers, rev as revenue, {money_ratio('rev', 'n', 2)} as avg_order_value,
    {ratio('items', 'n', 2)} as items_per_order, nu as new_customers, ru as returning_customers,
    nrev as new_customer_revenue, rrev as returning_customer_revenue, {ratio('ru', 'u', 4)} as returning_customer_share,
    (select sum(rev) from m e where e.purchase_month <= m.purchase_month) as cumulative_revenue, n < 100 as is_low_volume_month
  from m"""
MODELS["customer_acquisition_monthly"] = f"""
  with g as (select acquisition_month as m, count(*) as n, count(*) filter (is_repeat_customer) as back,
               sum(total_revenue) as rev, max(as_of_date) as d from dim_customers group by acquisition_month)
  select m as acquisition_month, n as new_customers, back as customers_who_returned,
    {ratio('back', 'n', 4)} as cohort_repeat_rate, rev as cohort_revenue_to_date,
    {money_ratio('rev', 'n', 2)} as avg_revenue_per_customer, date_diff('month', m, d)::INT as months_observed
  from g"""
MODELS["category_performance"] = f"""
  with x as (select p.product_category as cat, i.order_id, i.product_id, v.customer_unique_id, v.review_score_avg as rev,
               i.item_price, i.freight_value
             from stg_order_items i join valid v using (order_id) join dim_products p using (product_id)),
  s as (select cat, count(*) as n, count(distinct order_id) as o, count(distinct customer_unique_id) as u,
          count(distinct product_id) as p, sum(item_price) as ir, sum(freight_value) as fr from x group by cat),
  r as (select cat, avg(rev) as review from (select distinct cat, order_id, rev from x) group by cat)
  select cat as product_category, n as items_sold, o as orders, u as unique_customers, p as products_sold,
    ir as item_revenue, fr as freight_revenue, {money_ratio('ir', 'n', 2)} as avg_item_price,
    {half_up('ir::DOUBLE / (sum(ir) over ())::DOUBLE', 4)} as item_revenue_share, rank() over (order by ir desc) as revenue_rank,
    {half_up('review', 2)} as avg_review_score
  from s left join r using (cat)"""
MODELS["cohort_activity"] = """
  select acquisition_month, date_diff('month', acquisition_month, purchase_month)::INT as months_since_acquisition,
    count(distinct customer_unique_id) as active_customers
  from valid join dim_customers using (customer_unique_id) group by 1, 2"""
MODELS["cohort_retention"] = f"""
  with size as (select acquisition_month as m, count(*) as n from dim_customers group by 1),
  lim as (select max(purchase_month) as top from monthly_revenue where not is_low_volume_month),
  grid as (select m, n, unnest(range(0, date_diff('month', m, top) + 1))::INT as k from size, lim where m <= top)
  select strftime(m, '%Y-%m') || '+' || k as cohort_key, m as acquisition_month, k as months_since_acquisition,
    n as cohort_customers, ifnull(active_customers, 0) as active_customers,
    {ratio('ifnull(active_customers, 0)', 'n', 5)} as retention_rate, n < 100 as is_small_cohort
  from grid left join cohort_activity a on a.acquisition_month = m and a.months_since_acquisition = k"""

TRAIN_1, TRAIN_2, TEST = "date '2000-01-01'", "date '2000-06-01'", "date '2001-01-01'"
SCORING = "(select max(purchase_date) + 1 from valid)"


def features_sql(dates: str) -> str:
    return f"""
  with d as ({dates}),
  h as (select d.as_of_date, v.* from valid v, d where v.purchased_at < d.as_of_date::TIMESTAMP),
  b as (select as_of_date, customer_unique_id, min(purchased_at) as first_purchase_at, max(purchased_at) as last_purchase_at,
          count(*) as order_count, count(distinct purchase_date) as pd, sum(order_revenue)::DOUBLE as monetary,
          sum(item_count)::BIGINT as total_items,
          (max(is_late_delivery::INT) filter (delivered_at < as_of_date::TIMESTAMP)) as late from h group by all),
  st as (select as_of_date, customer_unique_id, customer_state from h where customer_state is not null
         qualify row_number() over (partition by as_of_date, customer_unique_id order by purchased_at desc, order_id desc) = 1),
  kr as (select h.as_of_date, h.customer_unique_id, r.review_score from stg_order_reviews r join h using (order_id)
         where r.survey_answered_at < h.as_of_date::TIMESTAMP),
  rc as (select as_of_date, customer_unique_id, avg(review_score) as obs from kr group by all),
  rm as (select as_of_date, avg(review_score) as mean from kr group by all),
  j as (select b.*, st.customer_state, rc.obs, rm.mean, b.as_of_date::TIMESTAMP as t
        from b left join st using (as_of_date, customer_unique_id) left join rc using (as_of_date, customer_unique_id)
        left join rm using (as_of_date))
  select as_of_date, customer_unique_id, first_purchase_at, last_purchase_at, order_count, least(pd, 5) as purchase_days,
    monetary, total_items, customer_state, ifnull(late, 0) as had_late_delivery, ifnull(obs, mean) as avg_review_score,
    obs as avg_review_score_observed, date_diff('second', last_purchase_at, t) / 86400::DOUBLE as recency_days,
    date_diff('second', first_purchase_at, t) / 86400::DOUBLE as days_since_first_purchase,
    date_diff('second', first_purchase_at, last_purchase_at) / 86400::DOUBLE as tenure_days,
    monetary / order_count as avg_order_value, total_items / order_count as items_per_order,
    (pd >= 2)::INT as is_repeat_customer,
    order_count / greatest(date_diff('second', first_purchase_at, t) / 86400::DOUBLE / 30.44::DOUBLE, 1::DOUBLE) as orders_per_month_active,
    (obs is not null)::INT as has_review, ifnull((customer_state = 'SP')::INT, 0) as is_sao_paulo,
    ln(1 + recency_days) as log_recency_days, ln(1 + monetary) as log_monetary, ln(1 + tenure_days) as log_tenure_days
  from j"""


def labelled_sql(features: str) -> str:
    return f"""
  select f.*, (exists (select 1 from valid v where v.customer_unique_id = f.customer_unique_id
      and v.purchased_at >= f.as_of_date::TIMESTAMP and v.purchased_at < f.as_of_date::TIMESTAMP + interval 180 day))::INT as returned
  from {features} f"""


MODELS["features_snapshots"] = features_sql(f"select unnest([{TRAIN_1}, {TRAIN_2}, {TEST}]) as as_of_date")
MODELS["labelled"] = labelled_sql("features_snapshots")
MODELS["features_test"] = features_sql(f"select {TEST} as as_of_date")
MODELS["test_set"] = labelled_sql("features_test")
MODELS["features_current"] = features_sql(f"select {SCORING} as as_of_date")


def rule_rfm_sql(source: str) -> str:
    parts = [avg_rank("(-recency_days)"), avg_rank("purchase_days"), avg_rank("monetary")]
    return f"select *, ({parts[0]} + {parts[1]} + {parts[2]}) / 3::DOUBLE as score from {source}"


RANDOM_SQL = "('0x' || left(md5('0:' || customer_unique_id), 8))::BIGINT / 4294967296::DOUBLE"
MODELS["rule_rfm_test"] = rule_rfm_sql("test_set")
MODELS["rule_long"] = f"""
  select 'Rule: most recent first' as model, customer_unique_id, returned as y, -recency_days as score, null::DOUBLE as proba from test_set
  union all select 'Rule: RFM score', customer_unique_id, returned, score, score from rule_rfm_test
  union all select 'Random (no model)', customer_unique_id, returned, {RANDOM_SQL}, null from test_set"""


def evaluation_models(name: str) -> None:
    """Metrics of the models stacked in ``<name>_long``."""
    MODELS[f"{name}_ranked"] = f"""
  select *, row_number() over (partition by model order by score desc, customer_unique_id) as pos,
    count(*) over (partition by model) as n, (sum(y) over (partition by model))::BIGINT as p
  from {name}_long"""
    MODELS[f"{name}_auc"] = f"""
  with r as (select model, y, {avg_rank('score', 'model')} * count(*) over (partition by model) as avg_rank from {name}_long)
  select model, (sum(avg_rank) filter (y = 1) - sum(y) * (sum(y) + 1) / 2::DOUBLE) / (sum(y) * (count(*) - sum(y)))::DOUBLE as roc_auc
  from r group by model"""
    MODELS[f"{name}_ap"] = f"""
  with s as (select model, score, count(*) as n, sum(y) as pos from {name}_long group by all),
  c as (select *, sum(n) over w as cn, sum(pos) over w as cp, sum(pos) over (partition by model) as tot
        from s window w as (partition by model order by score desc))
  select model, sum(pos * cp / cn) / max(tot) as pr_auc from c group by model"""
    MODELS[f"{name}_top"] = f"""
  with q as (select *, greatest(round_even(n * 0.1::DOUBLE, 0), 1) as k1, greatest(round_even(n * 0.2::DOUBLE, 0), 1) as k2 from {name}_ranked)
  select model,
    (sum(y) filter (pos <= k1) / count(*) filter (pos <= k1)) / (sum(y) / count(*)) as lift_top_10pct,
    sum(y) filter (pos <= k1) / sum(y) as capture_top_10pct,
    (sum(y) filter (pos <= k2) / count(*) filter (pos <= k2)) / (sum(y) / count(*)) as lift_top_20pct,
    sum(y) filter (pos <= k2) / sum(y) as capture_top_20pct
  from q group by model"""
    MODELS[f"{name}_evaluation"] = f"""
  with s as (select model, count(*) as customers, sum(y)::BIGINT as returned, sum(y) / count(*) as base_rate,
      avg((y - proba) * (y - proba)) as brier_score,
      case when count(proba) > 0 then (sum(y) / count(*)) * (1 - sum(y) / count(*)) end as brier_score_baseline
    from {name}_long group by model)
  select model, customers, returned, base_rate, roc_auc, pr_auc, lift_top_10pct, capture_top_10pct, lift_top_20pct,
    capture_top_20pct, brier_score, brier_score_baseline
  from s join {name}_auc using (model) join {name}_ap using (model) join {name}_top using (model)"""


evaluation_models("rule")
MODELS["rule_deciles"] = """
  with r as (select *, row_number() over (order by score desc, customer_unique_id) as pos, count(*) over () as n from rule_rfm_test),
  d as (select *, least(10, greatest(1, ceil(10 * (pos - 1) / (n - 1))))::INT as decile from r),
  g as (select decile, count(*) as customers, sum(returned)::BIGINT as returned, avg(score) as predicted_rate from d group by decile)
  select decile, customers, returned, predicted_rate, returned / customers as actual_rate,
    (returned / customers) / ((select sum(returned) from g) / (select sum(customers) from g)) as lift,
    (select sum(returned) from g e where e.decile <= g.decile) / (select sum(returned) from g) as cumulative_capture
  from g"""

_group_action = {g: a for g, (a, _) in GROUP_PLAYBOOK.items()}
_group_reason = {g: r for g, (_, r) in GROUP_PLAYBOOK.items()}


def decision_models(name: str, scored: str) -> None:
    """Tiers, contact order and score table for the return probability ``score``."""
    MODELS[f"{name}_tiered"] = f"""
  with s as ({scored}),
  j as (select s.* exclude (score), s.score as return_probability, s.score * s.avg_order_value as expected_revenue_180d,
      c.total_revenue, c.first_purchase_date, c.last_purchase_date, c.days_since_last_purchase, c.r_score, c.f_score, c.m_score,
      c.rfm_segment, c.is_high_value, c.activity_status
    from s join customer_rfm c using (customer_unique_id)),
  k as (select *, {avg_rank('total_revenue')} as value_pct, {avg_rank('return_probability')} as likelihood_pct,
      if(is_high_value, 'High', if(m_score >= 3, 'Medium', 'Low')) as value_tier from j),
  l as (select *, if(likelihood_pct <= 0.40::DOUBLE, 'High', if(likelihood_pct > 0.80::DOUBLE, 'Low', 'Medium')) as risk_tier from k),
  m as (select *, if(purchase_days >= 2 and activity_status <> 'Inactive', 'Loyal Customer',
      if(purchase_days = 1 and days_since_first_purchase <= 90, 'New Customer',
      if(value_tier = 'Low', 'Low Value', value_tier || ' Value - ' || if(risk_tier = 'High', 'High Risk', 'Lower Risk')))) as customer_group,
      ifnull(avg_review_score_observed <= 2 and value_tier <> 'Low', false) as unhappy from l),
  n as (select *, if(unhappy, '{RECOVERY_ACTION}', {case_map('customer_group', _group_action, 'VARCHAR')}) as next_best_action,
      if(unhappy, '{RECOVERY_REASON}', {case_map('customer_group', _group_reason, 'VARCHAR')}) as action_reason from m)
  select *, {case_map('next_best_action', ACTIONS, 'DECIMAL(18,2)')} as action_cost_brl,
    {half_even(f"100::DOUBLE * (0.45::DOUBLE * value_pct + 0.35::DOUBLE * likelihood_pct + 0.20::DOUBLE * {case_map('activity_status', URGENCY, 'DOUBLE')})", 1)} as priority_score
  from n"""
    MODELS[f"{name}_decided"] = f"""
  select *, row_number() over w as priority_rank, sum(action_cost_brl) over (w rows unbounded preceding) as cumulative_action_cost_brl
  from {name}_tiered window w as (order by priority_score desc, total_revenue desc, customer_unique_id)"""
    MODELS[f"{name}_table"] = f"""
  select customer_unique_id, customer_state, first_purchase_date, last_purchase_date, {half_even('recency_days', 1)} as recency_days,
    order_count, purchase_days, total_revenue, avg_order_value, {half_even('tenure_days', 1)} as tenure_days, items_per_order,
    avg_review_score_observed, had_late_delivery, is_repeat_customer, rfm_segment, r_score, f_score, m_score, activity_status,
    value_tier, {half_even('return_probability', 5)} as return_probability,
    {half_even('expected_revenue_180d', 2)} as expected_revenue_180d, risk_tier, customer_group, next_best_action, action_reason,
    action_cost_brl, priority_score, priority_rank, cumulative_action_cost_brl, as_of_date as scored_as_of,
    'logreg_v1' as model_version
  from {name}_decided"""


decision_models("rule", rule_rfm_sql('features_current'))
MODELS["customer_extract"] = """
  select t.*, date_trunc('month', t.first_purchase_date)::DATE as acquisition_month, r.avg_review_score, r.late_delivery_count
  from rule_table t join customer_rfm r using (customer_unique_id)"""
MODELS["repeat_gaps"] = """
  select customer_unique_id, order_id,
    floor(date_diff('second', lag(purchased_at) over w, purchased_at) / 86400::DOUBLE)::INT as gap_days
  from valid window w as (partition by customer_unique_id order by purchased_at, order_id)
  qualify gap_days is not null"""
MODELS["lorenz"] = """
  select customer_unique_id, row_number() over w as spend_rank, (row_number() over w) / (count(*) over ())::DOUBLE as share_of_customers,
    (sum(monetary::DECIMAL(28,2)) over (w rows unbounded preceding))::DOUBLE / (sum(monetary::DECIMAL(28,2)) over ())::DOUBLE as share_of_revenue,
    count(*) over () as customers
  from features_current window w as (order by monetary desc, customer_unique_id)"""


# ------------------------------------------------------------------ fitted model
NEWTON_STEPS = 14
_SIZE = len(MODEL_FEATURES) + 1


def newton_sql(inputs: str) -> str:
    """Weights b0 to b9 that minimise summed log loss + |w|^2 / 2 over the rows (y, x0 .. x9) of ``inputs``.

    Newton's method from zero as a recursive query. Each step sums the normal matrix and the gradient, factors the
    matrix (columns l_i_j) and solves forwards (z_i) and backwards (d_i), one SELECT around the other.
    """
    size = range(_SIZE)
    weights = ", ".join(f"b{i}" for i in size)
    sums = ", ".join(
        [f"sum(p * (1 - p) * x{i} * x{j}) + {int(i == j and i > 0)} as h_{i}_{j}" for i in size for j in range(i + 1)]
        + [f"sum((y - p) * x{i})" + (f" - b{i}" if i else "") + f" as g_{i}" for i in size])

    def less(first: str, *products: str) -> str:
        return "(" + " - ".join([first, *products]) + ")"

    levels = []
    for j in size:
        levels.append([f"sqrt{less(f'h_{j}_{j}', *[f'l_{j}_{k} * l_{j}_{k}' for k in range(j)])} as l_{j}_{j}"])
        levels.append([f"{less(f'h_{i}_{j}', *[f'l_{i}_{k} * l_{j}_{k}' for k in range(j)])} / l_{j}_{j} as l_{i}_{j}" for i in range(j + 1, _SIZE)])
    levels += [[f"{less(f'g_{i}', *[f'l_{i}_{k} * z_{k}' for k in range(i)])} / l_{i}_{i} as z_{i}"] for i in size]
    levels += [[f"{less(f'z_{i}', *[f'l_{k}_{i} * d_{k}' for k in range(i + 1, _SIZE)])} / l_{i}_{i} as d_{i}"] for i in reversed(size)]
    solved = f"""
        select step, {weights}, {sums} from (
          select *, 1 / (1 + exp(-({' + '.join(f'b{i} * x{i}' for i in size)}))) as p from newton, {inputs} where step < {NEWTON_STEPS})
        group by step, {weights}"""
    for level in levels:
        if level:
            solved = f"select *, {', '.join(level)} from ({solved})"
    return f"""
  with recursive newton as (
    select 0 as step, {', '.join(f'0::DOUBLE as b{i}' for i in size)}
    union all
    select step + 1, {', '.join(f'b{i} + d_{i}' for i in size)} from ({solved}))
  select {weights} from newton where step = {NEWTON_STEPS}"""


def fitted_models(name: str, rows: str) -> None:
    """Means and deviations, standardised rows, weights and coefficient table of the fit on ``rows``."""
    moments = ", ".join(f"avg({f}) as mean_{f}, if(stddev_pop({f}) = 0, 1, stddev_pop({f})) as std_{f}" for f in MODEL_FEATURES)
    MODELS[f"{name}_moments"] = f"select {moments} from {rows}"
    scaled = ", ".join(f"({f} - mean_{f}) / std_{f} as x{i}" for i, f in enumerate(MODEL_FEATURES, 1))
    MODELS[f"{name}_inputs"] = f"select returned as y, 1 as x0, {scaled} from {rows}, {name}_moments"
    MODELS[f"{name}_weights"] = newton_sql(f"{name}_inputs")
    MODELS[f"{name}_coefficients"] = " union all ".join(
        f"""select '{f}' as feature, b{i} as coefficient, std_{f} as feature_std, exp(b{i}) as odds_ratio_per_sd,
    if(b{i} > 0, 'more likely to return', 'less likely to return') as direction from {name}_weights, {name}_moments"""
        for i, f in enumerate(MODEL_FEATURES, 1))


def fitted_probability_sql(name: str, rows: str) -> str:
    margin = " + ".join(["b0", *[f"b{i} * (({f} - mean_{f}) / std_{f})" for i, f in enumerate(MODEL_FEATURES, 1)]])
    return f"select r.*, 1 / (1 + exp(-({margin}))) as score from {rows} r, {name}_weights, {name}_moments"


MODELS["train_set"] = f"from labelled where as_of_date <> {TEST}"
fitted_models("trained", "train_set")
fitted_models("final", "labelled")
MODELS["fitted_test"] = fitted_probability_sql("trained", "test_set")
MODELS["fitted_long"] = """
  select * exclude (proba), null::DOUBLE as proba from rule_long
  union all select 'Logistic regression', customer_unique_id, returned, score, score from fitted_test"""
evaluation_models("fitted")
decision_models("fitted", fitted_probability_sql("final", "features_current"))


def with_models(body: str) -> str:
    """Prefix a query with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in MODELS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(MODELS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({MODELS[n]})" for n in ordered) + "\n" + body
