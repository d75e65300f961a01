"""Data quality, declarative tests, reconciliation."""

from pyspark.sql import functions as F

from tidemark.config import ORDER_STATUSES, PAYMENT_TYPES
from tidemark.operators import decisions, quality
from tidemark.plans.catalog import query
from tidemark.plans.queries_decisions import SCENARIOS
from tidemark.sources.schemas import RAW_TABLES


def union(parts):
    return " union all ".join(parts)


def quoted(values):
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


PROFILED = ("orders", "order_reviews", "products")


def profile_sql(table):
    return union(
        f"""select '{table}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as nulls,
          floor(10000 * count(*) filter ({c} is null) / count(*) + 0.5) / 100.0 as null_pct, count(distinct {c}) as distinct_values,
          replace(min({c}::VARCHAR), chr(10), ' ') as example from raw_{table}"""
        for c in RAW_TABLES[table].column_names)


@query("profile_columns", union(profile_sql(t) for t in PROFILED))
def profile_columns(w):
    return quality.stack([quality.profile_columns(w.raw[t], t) for t in PROFILED])


KEYED = [s for s in RAW_TABLES.values() if s.key]


@query("duplicate_key_count", union(
    f"""select '{s.name}' as table_name, (select count(*) from raw_{s.name}) as total_rows,
      (select count(*) from raw_{s.name}) - (select count(*) from (select distinct {', '.join(s.key)} from raw_{s.name})) as duplicate_rows"""
    for s in KEYED))
def duplicate_key_count(w):
    return quality.stack([
        quality.duplicate_key_count(w.raw[s.name], list(s.key)).select(F.lit(s.name).alias("table_name"), "total_rows", "duplicate_rows")
        for s in KEYED])


@query("row_count_check", """
  select 'orders' as table_name, (select count(*) from orders) as expected_rows, (select count(*) from raw_orders) as actual_rows,
    0::BIGINT as difference, 'PASS' as status
  union all select 'order_items', (select count(*) from lineitem), (select count(*) from raw_order_items), 0, 'PASS'
  union all select 'products', (select count(*) from part), (select count(*) from raw_products), 0, 'PASS'""")
def row_count_check(w):
    """Rows loaded against the rows of the table each was derived from."""
    inputs = {"orders": "orders", "order_items": "lineitem", "products": "part"}
    expected = quality.stack([
        w.star.read(source).agg(F.count(F.lit(1)).alias("expected_rows")).select(F.lit(t).alias("table_name"), "expected_rows")
        for t, source in inputs.items()])
    return quality.row_count_check({t: w.raw[t] for t in inputs}, expected)


NULL_CHECKS = union(
    f"""select '{s.name}' as table_name, '{c}' as column_name, '{"REQUIRED" if c in s.required else "OPTIONAL"}' as rule,
      count(*) - count({c}) as null_count, count(*) as total_rows, floor(10000 * (count(*) - count({c})) / count(*) + 0.5) / 100.0 as null_pct,
      if(count(*) = count({c}), 'PASS', '{"FAIL" if c in s.required else "INFO"}') as status from raw_{s.name}"""
    for s in RAW_TABLES.values() for c in s.column_names)


@query("null_checks", NULL_CHECKS)
def null_checks(w):
    return quality.null_checks(w.raw)


@query("status_null_crosstab", """
  select order_status, count(*) as orders, count(*) - count(order_approved_at) as null_approved_at,
    count(*) - count(order_delivered_carrier_date) as null_delivered_carrier,
    count(*) - count(order_delivered_customer_date) as null_delivered_customer from raw_orders group by 1""")
def status_null_crosstab(w):
    return quality.status_null_crosstab(w.raw["orders"])


@query("key_uniqueness", union(
    f"""select '{s.name}' as table_name, '{" + ".join(s.key)}' as key_columns, count(*) as total_rows,
      count(distinct ({', '.join(s.key)})) as distinct_keys, count(*) - count(distinct ({', '.join(s.key)})) as duplicate_keys,
      if(count(*) = count(distinct ({', '.join(s.key)})), 'PASS', 'FAIL') as status from raw_{s.name}"""
    for s in KEYED))
def key_uniqueness(w):
    return quality.key_uniqueness(w.raw)


def _more_than_one(label, table, key, what="*"):
    return f"""select '{label}' as check_name, count(*) as value, 'INFO' as status
      from (select {key} from raw_{table} group by 1 having count({what}) > 1)"""


@query("expected_repetition", union([
    _more_than_one("people with more than one order", "customers", "customer_unique_id"),
    "select 'distinct people', count(distinct customer_unique_id), 'INFO' from raw_customers",
    _more_than_one("review ids shared by several orders", "order_reviews", "review_id", "distinct order_id"),
    _more_than_one("orders with more than one review", "order_reviews", "order_id"),
    _more_than_one("orders with more than one payment row", "order_payments", "order_id"),
    "select 'distinct zip prefixes with coordinates', count(distinct geolocation_zip_code_prefix), 'INFO' from raw_geolocation",
]))
def expected_repetition(w):
    return quality.expected_repetition(w.raw)


@query("exact_duplicate_rows", union(
    f"""select '{t}' as table_name, (select count(*) from raw_{t}) - (select count(*) from (select distinct * from raw_{t})) as exact_duplicate_rows"""
    for t in RAW_TABLES))
def exact_duplicate_rows(w):
    return quality.exact_duplicate_rows(w.raw)


@query("top_order_customers", """
  select customer_unique_id, count(*) as orders from raw_customers group by 1 order by orders desc, customer_unique_id limit 10""")
def top_order_customers(w):
    return quality.top_order_customers(w.raw["customers"])


@query("shared_review_ids", """
  select review_id, count(distinct order_id) as orders, min(review_score) as min_score, max(review_score) as max_score
  from raw_order_reviews group by 1 having count(distinct order_id) > 1 order by orders desc, review_id limit 10""")
def shared_review_ids(w):
    return quality.shared_review_ids(w.raw["order_reviews"])


HEX = "[0-9a-f]{32}"
VALUE_CONDITIONS = [
    ("order_reviews", "review score is 1 to 5", "FAIL", "review_score < 1 or review_score > 5"),
    ("order_reviews", "review answered after it was sent", "WARN", "review_creation_date > review_answer_timestamp"),
    ("order_items", "item price is positive", "FAIL", "not price > 0"),
    ("order_items", "freight is not negative", "FAIL", "not freight_value >= 0"),
    ("order_items", "item number starts at 1", "FAIL", "not order_item_id >= 1"),
    ("order_payments", "payment is not negative", "FAIL", "not payment_value >= 0"),
    ("order_payments", "payment number starts at 1", "FAIL", "not payment_sequential >= 1"),
    ("order_payments", "at least one installment", "WARN", "not payment_installments >= 1"),
    ("order_payments", "payment is not zero", "WARN", "payment_value = 0"),
    ("order_payments", "payment type is known", "FAIL", f"payment_type not in ({quoted(PAYMENT_TYPES)})"),
    ("products", "product weight is positive", "WARN", "not product_weight_g > 0"),
    ("products", "product sizes and counts are not negative", "FAIL",
     "least(product_name_lenght, product_description_lenght, product_photos_qty, product_length_cm, product_height_cm, product_width_cm) < 0"),
    ("orders", "order status is known", "FAIL", f"order_status not in ({quoted(ORDER_STATUSES)})"),
    ("orders", "order ids are 32 hex digits", "FAIL", f"not (regexp_full_match(order_id, '{HEX}') and regexp_full_match(customer_id, '{HEX}'))"),
    ("orders", "purchase lies in the data period", "FAIL", "year(order_purchase_timestamp) < 1995 or year(order_purchase_timestamp) > 2001"),
    ("orders", "approved after purchase", "WARN", "order_purchase_timestamp > order_approved_at"),
    ("orders", "carrier pickup after purchase", "WARN", "order_purchase_timestamp > order_delivered_carrier_date"),
    ("orders", "arrival after carrier pickup", "WARN", "order_delivered_carrier_date > order_delivered_customer_date"),
    ("orders", "arrival after purchase", "WARN", "order_purchase_timestamp > order_delivered_customer_date"),
    ("orders", "delivered orders have an arrival date", "WARN", "order_delivered_customer_date is null and order_status = 'delivered'"),
    ("customers", "customer zip has five digits", "WARN", "not regexp_full_match(customer_zip_code_prefix, '[0-9]{5}')"),
    ("customers", "customer state has two capitals", "FAIL", "not regexp_full_match(customer_state, '[A-Z]{2}')"),
    ("customers", "customer ids are 32 hex digits", "FAIL", f"not (regexp_full_match(customer_id, '{HEX}') and regexp_full_match(customer_unique_id, '{HEX}'))"),
    ("sellers", "seller zip has five digits", "WARN", "not regexp_full_match(seller_zip_code_prefix, '[0-9]{5}')"),
    ("sellers", "seller state has two capitals", "FAIL", "not regexp_full_match(seller_state, '[A-Z]{2}')"),
    ("geolocation", "location zip has five digits", "WARN", "not regexp_full_match(geolocation_zip_code_prefix, '[0-9]{5}')"),
    ("geolocation", "coordinates exist on Earth", "FAIL", "abs(geolocation_lat) > 90 or abs(geolocation_lng) > 180"),
    ("geolocation", "coordinates lie in the market", "WARN",
     "geolocation_lat < -34 or geolocation_lat > 6 or geolocation_lng < -74 or geolocation_lng > -34"),
]


@query("value_domain_checks", """select 'all tables' as table_name, 'columns follow the schema contract' as rule_name, 'FAIL' as severity,
    0::BIGINT as violations, 'PASS' as status union all """ + union(
    f"""select '{t}', '{label}', '{severity}', count(*) filter ({bad}), if(count(*) filter ({bad}) = 0, 'PASS', '{severity}') from raw_{t}"""
    for t, label, severity, bad in VALUE_CONDITIONS))
def value_domain_checks(w):
    return quality.value_domain_checks(w.raw, w.cfg)


@query("status_ordered_report", union(
    f"""select '{t}' as table_name, '{label}' as rule_name, count(*) filter ({bad}) as violations,
    if(count(*) filter ({bad}) = 0, 'PASS', '{severity}') as status from raw_{t}""" for t, label, severity, bad in VALUE_CONDITIONS))
def status_ordered_report(w):
    checks = quality.run_rules(w.raw, quality.value_rules(w.cfg))
    checks = checks.withColumn("status", quality.status_of("violations", "severity")).drop("severity")
    return quality.by_status(checks, "rule_name")


@query("dataset_period", """
  select min(order_purchase_timestamp) as first_order, max(order_purchase_timestamp) as last_order,
    (max(order_purchase_timestamp)::DATE - min(order_purchase_timestamp)::DATE)::INT as days_covered from raw_orders""")
def dataset_period(w):
    return quality.dataset_period(w.raw["orders"])


def _orphans(label, severity, child, ck, parent, pk, where="true"):
    test = f"{where} and not exists (select 1 from raw_{parent} p where p.{pk} = c.{ck})"
    return f"""select '{label}' as relationship, '{severity}' as severity, count(*) as orphan_rows, if(count(*) = 0, 'PASS', '{severity}') as status
      from raw_{child} c where {test}"""


@query("relationship_checks", union([
    _orphans("orders have a customer", "FAIL", "orders", "customer_id", "customers", "customer_id"),
    _orphans("items have an order", "FAIL", "order_items", "order_id", "orders", "order_id"),
    _orphans("items have a product", "FAIL", "order_items", "product_id", "products", "product_id"),
    _orphans("items have a seller", "FAIL", "order_items", "seller_id", "sellers", "seller_id"),
    _orphans("payments have an order", "FAIL", "order_payments", "order_id", "orders", "order_id"),
    _orphans("reviews have an order", "FAIL", "order_reviews", "order_id", "orders", "order_id"),
    _orphans("categories have a translation", "WARN", "products", "product_category_name", "product_category_translation",
             "product_category_name", "product_category_name is not null"),
    _orphans("customer zips have coordinates", "WARN", "customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
    _orphans("orders have items", "WARN", "orders", "order_id", "order_items", "order_id"),
    _orphans("orders have payments", "WARN", "orders", "order_id", "order_payments", "order_id"),
    _orphans("orders have reviews", "WARN", "orders", "order_id", "order_reviews", "order_id"),
]))
def relationship_checks(w):
    return quality.relationship_checks(w.raw)


@query("payment_reconciliation", """
  with g as (select order_id, sum(price) + sum(freight_value) as a from raw_order_items group by 1),
  p as (select order_id, sum(payment_value) as b from raw_order_payments group by 1)
  select count(*) as orders_compared, count(*) filter (a - b between -1 and 1) as within_1_brl,
    count(*) filter (a - b > 1 or b - a > 1) as differ_more_than_1_brl from g join p using (order_id)""")
def payment_reconciliation(w):
    return quality.payment_reconciliation(w.raw["order_items"], w.raw["order_payments"])


@query("untranslated_categories", """
  select product_category_name, count(*) as products from raw_products where product_category_name is not null
    and product_category_name not in (select product_category_name from raw_product_category_translation) group by 1""")
def untranslated_categories(w):
    return quality.untranslated_categories(w.raw["products"], w.raw["product_category_translation"])


@query("orders_without_items_by_status", """
  select order_status, count(*) as orders_without_items from raw_orders where order_id not in (select order_id from raw_order_items) group by 1""")
def orders_without_items_by_status(w):
    return quality.orders_without_items_by_status(w.raw["orders"], w.raw["order_items"])


# ------------------------------------------------------------------ declarative tests
def _tests(kind):
    for name, spec in quality.MODEL_TESTS.items():
        if kind == "unique":
            for c in spec.get("unique", []):
                yield name, c, f"(select count(*) from (select {c} from {name} where {c} is not null group by 1 having count(*) > 1))"
        elif kind == "not_null":
            for c in spec.get("not_null", []):
                yield name, c, f"(select count(*) from {name} where {c} is null)"
        elif kind == "accepted_values":
            for c, values in spec.get("accepted", {}).items():
                yield name, c, f"(select count(distinct {c}) from {name} where {c} not in ({quoted(values)}))"
        else:
            for c, parent, pc, where in spec.get("relationships", []):
                yield name, c, f"""(select count(*) from {name} x where {where or 'true'} and x.{c} is not null
                  and x.{c} not in (select {pc} from {parent} where {pc} is not null))"""


def tests_sql(kind):
    return union(f"select '{m}' as model, '{c}' as column_name, '{kind}' as test, {bad} as failures" for m, c, bad in _tests(kind))


@query("generic_unique", tests_sql("unique"))
def generic_unique(w):
    return quality.generic_unique(w.keyed.model)


@query("generic_not_null", tests_sql("not_null"))
def generic_not_null(w):
    return quality.generic_not_null(w.model)


@query("generic_accepted_values", tests_sql("accepted_values"))
def generic_accepted_values(w):
    return quality.generic_accepted_values(w.model)


@query("generic_relationships", tests_sql("relationships"))
def generic_relationships(w):
    return quality.generic_relationships(w.model)


# ------------------------------------------------------------------ singular tests
def singular_sql(facts="joined_orders", customers="dim_customers", rfm="customer_rfm", monthly="monthly_revenue", cohorts="cohort_retention"):
    """Violating rows of each test."""
    valid = f"(from {facts} where is_valid_purchase)"
    return {
        "no negative revenue": f"select 1 from {facts} where least(order_revenue, items_subtotal, freight_total) < 0",
        "no impossible dates": f"""select 1 from {facts} where year(purchased_at) < 1995 or purchased_at > now()::TIMESTAMP
          or purchased_at > least(approved_at, shipped_to_carrier_at, delivered_at)""",
        "no duplicate orders": f"select order_id from {facts} group by 1 having count(*) <> 1",
        "customer revenue reconciles": f"""select 1 from (select sum(order_revenue) as r, count(*) as n from {valid}),
          (select sum(total_revenue) as c, sum(order_count)::BIGINT as m from {customers}) where abs(r - c) > 0.01 or n <> m""",
        "months reconcile": f"""select 1 from (select sum(revenue) as r, sum(orders) as n from {monthly}), kpi_summary
          where abs(r - total_revenue) > 0.01 or n <> total_orders
          union all select 1 from {monthly} where unique_customers <> new_customers + returning_customers""",
        "rfm covers customers": f"""select 1 from (select count(*) as a from {customers}), (select count(*) as b from {rfm}) where a <> b""",
        "cohorts start whole": f"""select 1 from {cohorts} where retention_rate not between 0 and 1
          or (months_since_acquisition = 0 and retention_rate < 1)""",
    }


def check_sql(name, violating):
    return f"""select '{name}' as check_name, count(*) as violations, if(count(*) = 0, 'PASS', 'FAIL') as status from ({violating}) bad"""


def _singular(w, facts=None, customers=None, rfm=None, monthly=None, cohorts=None):
    return quality.singular_tests(
        w.joined_orders if facts is None else facts, w.dim_customers if customers is None else customers,
        w.customer_rfm if rfm is None else rfm, w.monthly_revenue if monthly is None else monthly, w.kpi_summary,
        w.cohort_retention if cohorts is None else cohorts, w.cfg)


ASSERTS = {
    "assert_no_negative_revenue": "no negative revenue", "assert_no_impossible_dates": "no impossible dates",
    "assert_no_duplicate_orders": "no duplicate orders", "assert_customer_revenue_reconciles": "customer revenue reconciles",
    "assert_monthly_reconciles": "months reconcile", "assert_rfm_covers_customers": "rfm covers customers",
    "assert_cohort_month_zero": "cohorts start whole",
}
for _key, _name in ASSERTS.items():
    query(_key, check_sql(_name, singular_sql()[_name]))(lambda w, n=_name: quality.as_check(n, _singular(w)[n]))

# The same tests where rows of the tables were spoiled by their calendar day or score.
PLANTED = {
    "facts": """(select * exclude (order_revenue, approved_at), if(day(purchased_at) = 1, -1 - order_revenue, order_revenue) as order_revenue,
        if(day(purchased_at) = 2, purchased_at - interval 1 hour, approved_at) as approved_at from joined_orders
      union all by name select * from joined_orders where day(purchased_at) = 3)""",
    "rfm": "(from customer_rfm where r_score <> 5)",
    "monthly": "(select * replace (if(month(purchase_month) = 1, new_customers + 1, new_customers) as new_customers) from monthly_revenue)",
    "cohorts": "(select * replace (if(months_since_acquisition = 0, 0.5, retention_rate) as retention_rate) from cohort_retention)",
}


@query("asserts_on_planted_defects", union(check_sql(n, sql) for n, sql in singular_sql(**PLANTED).items()))
def asserts_on_planted_defects(w):
    day = F.dayofmonth("purchased_at")
    revenue = F.when(day == 1, -1 - F.col("order_revenue")).otherwise(F.col("order_revenue")).cast("decimal(18,2)")
    facts = w.joined_orders.withColumns({
        "order_revenue": revenue,
        "approved_at": F.when(day == 2, F.col("purchased_at") - F.expr("interval '1' hour")).otherwise(F.col("approved_at"))})
    facts = facts.unionByName(w.joined_orders.withColumn("order_revenue", F.col("order_revenue").cast("decimal(18,2)")).where(day == 3))
    january = F.month("purchase_month") == 1
    monthly = w.monthly_revenue.withColumn("new_customers", F.col("new_customers") + january.cast("long"))
    start = F.col("months_since_acquisition") == 0
    cohorts = w.cohort_retention.withColumn("retention_rate", F.when(start, 0.5).otherwise(F.col("retention_rate")))
    tests = _singular(w, facts, rfm=w.customer_rfm.where("r_score <> 5"), monthly=monthly, cohorts=cohorts)
    return quality.stack([quality.as_check(n, bad) for n, bad in tests.items()])


@query("marts_vs_raw", """
  with rv as (select order_id, customer_unique_id from raw_orders join raw_customers using (customer_id) where order_status not in ('canceled', 'unavailable')),
  p as (select order_id, sum(payment_value) as paid from raw_order_payments group by 1),
  i as (select order_id, sum(price + freight_value) as gross from raw_order_items group by 1),
  c as (
    select 'valid orders' as check_name, (select count(*) from rv)::DOUBLE as raw_value, (select total_orders from kpi_summary)::DOUBLE as mart_value
    union all select 'unique customers', (select count(distinct customer_unique_id) from rv), (select unique_customers from kpi_summary)
    union all select 'revenue', (select sum(coalesce(paid, gross, 0)) from rv left join p using (order_id) left join i using (order_id)), (select total_revenue from kpi_summary)
    union all select 'repeat customers', (select count(*) from (select 1 from rv group by customer_unique_id having count(*) > 1)), (select repeat_customers from kpi_summary)
    union all select 'all orders', (select count(*) from raw_orders), (select count(*) from joined_orders)
    union all select 'customers in both customer marts', (select count(*) from dim_customers), (select count(*) from customer_rfm)
    union all select 'item revenue', (select sum(price) from raw_order_items join rv using (order_id)), (select sum(item_revenue) from category_performance)
    union all select 'new customers over all months', (select sum(new_customers) from monthly_revenue), (select unique_customers from kpi_summary)
    union all select 'share of top recency score is near 20', 20, (select round(100 * count(*) filter (r_score = 5) / count(*)) from customer_rfm))
  select *, case when check_name like 'share%' then if(abs(raw_value - mart_value) <= 5, 'PASS', 'WARN')
    when abs(raw_value - mart_value) <= 0.01 then 'PASS' else 'FAIL' end as status from c""")
def marts_vs_raw(w):
    return quality.marts_vs_raw(w.raw, w.joined_orders, w.kpi_summary, w.dim_customers, w.customer_rfm, w.category_performance, w.monthly_revenue)


INVARIANTS = {
    "one row per customer of the customer mart": "(select count(*) <> (select count(*) from dim_customers) or count(*) <> count(distinct customer_unique_id) from rule_table)",
    "return probability is in 0 to 1": "(select count(*) from rule_table where return_probability < 0 or return_probability > 1)",
    "priority score is in 0 to 100": "(select count(*) from rule_table where priority_score < 0 or priority_score > 100)",
    "priority rank runs 1 to N": "(select min(priority_rank) <> 1 or max(priority_rank) <> count(*) or count(distinct priority_rank) <> count(*) from rule_table)",
    "every customer has group, action and cost": "(select count(*) from rule_table where (customer_group, next_best_action, action_cost_brl) is null)",
    "revenue equals the customer mart": "((select sum(total_revenue) from rule_table) <> (select sum(total_revenue) from dim_customers))",
    "loyal customers bought on two days": "(select count(*) from rule_table where customer_group = 'Loyal Customer' and purchase_days = 1)",
    "high value groups hold the high tier": "(select count(*) from rule_table where starts_with(customer_group, 'High Value') and value_tier <> 'High')",
    "high risk groups hold the high risk tier": "(select count(*) from rule_table where ends_with(customer_group, 'High Risk') and risk_tier <> 'High')",
    "cumulative cost never falls": """(select count(*) from (select cumulative_action_cost_brl < lag(cumulative_action_cost_brl) over (order by priority_rank) as falls
      from rule_table) where falls)""",
    "budgets are not overspent": f"(select count(*) from ({SCENARIOS}) where spend_brl > budget_brl)",
    "model ranks better than chance": """((select roc_auc from rule_auc where model = 'Rule: RFM score')
      <= (select roc_auc from rule_auc where model = 'Random (no model)'))""",
}


def invariants_sql(name: str, ranked: str) -> str:
    """The twelve checks on ``<name>_table``, with ``ranked`` as the model that should beat chance."""
    checks = union(f"select '{check}' as check_name, ({bad})::BIGINT as problems" for check, bad in INVARIANTS.items())
    checks = checks.replace("rule_table", f"{name}_table").replace("rule_decided", f"{name}_decided").replace("rule_auc", f"{name}_auc")
    return f"select check_name, problems, if(problems = 0, 'PASS', 'FAIL') as status from ({checks.replace('Rule: RFM score', ranked)})"


@query("score_table_invariants", invariants_sql("rule", "Rule: RFM score"))
def score_table_invariants(w):
    """On the rule scores."""
    scenarios = decisions.budget_scenarios(w.rule_decided, w.cfg.budgets)
    return quality.score_table_invariants(w.rule_table, w.dim_customers, scenarios, w.rule_evaluation, "Rule: RFM score")


@query("fitted_score_table_invariants", invariants_sql("fitted", "Logistic regression"))
def fitted_score_table_invariants(w):
    """On the published scores of the fitted model."""
    return quality.score_table_invariants(w.scores, w.dim_customers, w.scenarios, w.model_evaluation)


@query("pipeline_gate", """
  select unnest(['one row per customer', 'every customer is scored', 'probabilities between 0 and 1', 'priority between 0 and 100',
    'every action has a cost', 'no missing group']) as check_name,
    unnest([count(*) = count(distinct customer_unique_id), count(*) = (select count(*) from customer_rfm),
      count(*) = count(*) filter (return_probability between 0 and 1), count(*) = count(*) filter (priority_score between 0 and 100),
      count(*) = count(action_cost_brl), count(*) = count(customer_group)]) as passed from rule_decided""")
def pipeline_gate(w):
    return quality.gate_checks(w.rule_decided, w.customer_rfm)
