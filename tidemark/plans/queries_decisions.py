"""Decision operators on the deterministic rule probability, and the dashboard aggregates."""

from pyspark.sql import functions as F

from tidemark.config import ACTIONS
from tidemark.operators import dashboards, decisions
from tidemark.plans.catalog import model_query, query
from tidemark.plans.queries_models import STABILITY

SCORE_MONEY = "total_revenue action_cost_brl cumulative_action_cost_brl"


def decision(key, columns, money="", source="rule_tiered"):
    picked = ["customer_unique_id", *columns.split()]
    query(key, f"select {', '.join(picked)} from {source}", money)(lambda w: w.model(source).select(*picked))


decision("value_tier", "value_tier")
decision("risk_tier", "likelihood_pct risk_tier")
decision("customer_group", "customer_group")
decision("next_best_action", "next_best_action action_reason action_cost_brl", "action_cost_brl")
decision("priority_score", "priority_score")
decision("expected_revenue_180d", "return_probability expected_revenue_180d")
decision("priority_rank", "priority_rank", source="rule_decided")
decision("cumulative_cost", "priority_rank cumulative_action_cost_brl", "cumulative_action_cost_brl", source="rule_decided")
decision("budget_columns", "priority_score priority_rank action_cost_brl cumulative_action_cost_brl",
         "action_cost_brl cumulative_action_cost_brl", source="rule_decided")
model_query("final_score_projection", "rule_table", SCORE_MONEY)
model_query("customers_extract", "customer_extract", SCORE_MONEY, model="extract")


@query("decide", """
  select customer_unique_id, value_tier, risk_tier, customer_group, next_best_action, priority_score, priority_rank,
    cumulative_action_cost_brl from rule_decided""", "cumulative_action_cost_brl")
def decide(w):
    return w.rule_decided.select("customer_unique_id", "value_tier", "risk_tier", "customer_group", "next_best_action",
                                 "priority_score", "priority_rank", "cumulative_action_cost_brl")


@query("merge_inner_suffix", """
  select f.customer_unique_id, f.order_count, c.order_count as order_count_mart, f.customer_state, c.customer_state as customer_state_mart,
    f.avg_order_value, c.avg_order_value as avg_order_value_mart
  from features_current f join customer_rfm c using (customer_unique_id)""")
def merge_inner_suffix(w):
    scored = w.current.withColumn("return_probability", F.lit(0.0))
    merged = decisions.scored_with_rfm(scored, w.customer_rfm)
    clash = [c for n in ("order_count", "customer_state", "avg_order_value") for c in (n, n + decisions.MART_SUFFIX)]
    return merged.select("customer_unique_id", *clash)


@query("aligned_concat", """
  select customer_unique_id, customer_group, next_best_action, action_reason, action_cost_brl from rule_tiered""", "action_cost_brl")
def aligned_concat(w):
    return decisions.next_best_action(
        w.rule_tiered.drop("next_best_action", "action_reason", "action_cost_brl"), w.cfg
    ).select("customer_unique_id", "customer_group", "next_best_action", "action_reason", "action_cost_brl")


@query("group_summary", """
  select customer_group, count(*) as customers, sum(total_revenue) as revenue, avg(priority_score) as avg_priority
  from rule_decided group by customer_group""", "revenue", "avg_priority")
def group_summary(w):
    return decisions.group_summary(w.rule_tiered)


@query("group_action_summary", """
  select customer_group, next_best_action, count(*) as customers, floor(sum(total_revenue) + 0.5)::DOUBLE as historical_revenue,
    round(avg(return_probability) * 100 + 1e-9, 2) as avg_return_probability_pct, round(avg(priority_score) + 1e-9, 1) as avg_priority
  from rule_table group by all""")
def group_action_summary(w):
    return decisions.group_action_summary(w.rule_table)


@query("action_counts", "select next_best_action, count(*) as customers from rule_tiered group by 1")
def action_counts(w):
    return decisions.action_counts(w.rule_tiered)


_counts = ", ".join(f"count(*) filter (next_best_action = '{a}') as {decisions.action_slug(a)}" for a in ACTIONS)
SCENARIOS = f"""
  select b as budget_brl, count(customer_unique_id) as customers_reached,
    count(customer_unique_id) / (select count(*) from rule_decided) as share_of_customers,
    ifnull(sum(action_cost_brl), 0) as spend_brl, ifnull(sum(total_revenue), 0) as historical_revenue_of_reached,
    ifnull(sum(total_revenue), 0)::DOUBLE / (select sum(total_revenue) from rule_decided)::DOUBLE as share_of_historical_revenue,
    count(*) filter (value_tier = 'High') as high_value_customers_reached,
    ifnull(sum(expected_revenue_180d), 0) as expected_baseline_revenue_180d,
    min(priority_score) as lowest_priority_score_included, {_counts}
  from (select unnest([10000, 25000, 50000, 100000])::INT as b) left join rule_decided on cumulative_action_cost_brl <= b group by b"""


@query("budget_scenarios", SCENARIOS, "spend_brl historical_revenue_of_reached",
       "share_of_customers share_of_historical_revenue expected_baseline_revenue_180d")
def budget_scenarios(w):
    return decisions.budget_scenarios(w.rule_decided, w.cfg.budgets)


@query("within_budget_filter", """
  select customer_unique_id, cumulative_action_cost_brl from rule_decided where cumulative_action_cost_brl <= 25000""",
       "cumulative_action_cost_brl")
def within_budget_filter(w):
    return decisions.within_budget(w.rule_decided, w.cfg.default_budget).select("customer_unique_id", "cumulative_action_cost_brl")


@query("priority_list", """
  select priority_rank, customer_unique_id, customer_group, next_best_action, action_cost_brl, total_revenue, recency_days,
    round(return_probability * 100 + 1e-9, 2) as return_probability_pct, priority_score, cumulative_action_cost_brl
  from rule_table where cumulative_action_cost_brl <= 25000 order by priority_rank limit 50""", SCORE_MONEY)
def priority_list(w):
    return decisions.priority_list(w.rule_table, w.cfg.default_budget)


@query("filtered_running_cost", """
  select customer_unique_id, priority_rank, action_cost_brl, sum(action_cost_brl) over (order by priority_rank) as running_cost
  from rule_decided where customer_state = 'SP'""", "action_cost_brl running_cost")
def filtered_running_cost(w):
    return decisions.filtered_running_cost(w.rule_decided, F.col("customer_state") == "SP")


@query("lag_check", """
  select count(*) as customers, count(*) filter (cumulative_action_cost_brl < before) as decreases from
    (select cumulative_action_cost_brl, lag(cumulative_action_cost_brl) over (order by priority_rank) as before from rule_decided)""")
def lag_check(w):
    from tidemark.operators.ordered import ordered_scan

    rows = w.rule_decided.select("priority_rank", "cumulative_action_cost_brl")
    chained = ordered_scan(rows, [("priority_rank", True)], previous={"before": "cumulative_action_cost_brl"})
    return chained.agg(F.count(F.lit(1)).alias("customers"),
                       F.count_if(F.col("cumulative_action_cost_brl") < F.col("before")).alias("decreases"))


model_query("retention_scores", "fitted_table", SCORE_MONEY, model="scores")


# ------------------------------------------------------------------ dashboards
STAGE = """case when customer_group = 'Loyal Customer' then 'Loyal' when customer_group = 'New Customer' then 'New'
  when risk_tier = 'High' then 'At-risk' else 'Other one-time' end"""
BAND = """case when total_revenue >= 1000 then '6: R$1,000+' when total_revenue >= 500 then '5: R$500-999'
  when total_revenue >= 200 then '4: R$200-499' when total_revenue >= 100 then '3: R$100-199'
  when total_revenue >= 50 then '2: R$50-99' else '1: < R$50' end"""
MILLIONS = "sum(total_revenue)::DOUBLE / 1000000 as revenue_m"
RETURN_PCT = "round(100 * avg(return_probability) + 1e-9, 2) as avg_return_pct"


@query("lifecycle_stage", f"select customer_unique_id, {STAGE} as lifecycle_stage from rule_table")
def lifecycle_stage(w):
    return w.rule_table.select("customer_unique_id", dashboards.lifecycle_stage().alias("lifecycle_stage"))


@query("revenue_band", f"select customer_unique_id, {BAND} as revenue_band from rule_table")
def revenue_band(w):
    return w.rule_table.select("customer_unique_id", dashboards.revenue_band().alias("revenue_band"))


@query("kpi_tiles", """
  select floor(sum(total_revenue) / 10000 + 0.5) / 100.0 as revenue_m, sum(order_count)::BIGINT as orders, count(*) as customers,
    floor(sum(total_revenue) * 100 / sum(order_count) + 0.5) / 100.0 as avg_order_value,
    floor(10000 * count(*) filter (order_count > 1) / count(*) + 0.5) / 100.0 as repeat_rate_pct,
    count(*) filter (value_tier = 'High') as high_value_customers,
    round(100::DOUBLE * (sum(total_revenue) filter (value_tier = 'High')::DOUBLE / sum(total_revenue)::DOUBLE) + 1e-9, 1) as high_value_revenue_pct
  from rule_table""")
def kpi_tiles(w):
    return dashboards.kpi_tiles(w.rule_table)


@query("monthly_trend", """
  select purchase_month, revenue::DOUBLE / 1000 as revenue_k, new_customers, returning_customer_share * 100 as returning_share_pct
  from monthly_revenue where not is_low_volume_month""", approx="revenue_k returning_share_pct")
def monthly_trend(w):
    return dashboards.monthly_trend(w.monthly_revenue)


@query("segment_bars", f"select rfm_segment, {MILLIONS}, count(*) as customers from rule_table group by 1", approx="revenue_m")
def segment_bars(w):
    return dashboards.segment_bars(w.rule_table)


@query("segment_bars_by_state", f"select rfm_segment, {MILLIONS}, count(*) as customers from rule_table where customer_state = 'SP' group by 1",
       approx="revenue_m")
def segment_bars_by_state(w):
    return dashboards.segment_bars(w.rule_table, "SP")


_cells = ", ".join(f"count(*) filter (r_score = {r}) as r{r}_customers, ifnull(sum(total_revenue) filter (r_score = {r}), 0) as r{r}_revenue"
                   for r in range(1, 6))


@query("recency_monetary_matrix", f"select m_score, {_cells} from rule_table group by m_score", " ".join(f"r{r}_revenue" for r in range(1, 6)))
def recency_monetary_matrix(w):
    return dashboards.recency_monetary_matrix(w.rule_table)


@query("value_distribution", f"select {BAND} as revenue_band, count(*) as customers, sum(total_revenue) as revenue from rule_table group by 1", "revenue")
def value_distribution(w):
    return dashboards.value_distribution(w.rule_table)


@query("lifecycle_mix", f"""
  select {STAGE} as lifecycle_stage, count(*) as customers, sum(total_revenue) as revenue,
    sum(total_revenue)::DOUBLE / (select sum(total_revenue) from rule_table)::DOUBLE as revenue_share from rule_table group by 1""",
       "revenue", "revenue_share")
def lifecycle_mix(w):
    return dashboards.lifecycle_mix(w.rule_table)


@query("risk_distribution", f"select risk_tier, count(*) as customers, {RETURN_PCT} from rule_table group by 1")
def risk_distribution(w):
    return dashboards.risk_distribution(w.rule_table)


@query("value_risk_matrix", f"select value_tier, risk_tier, count(*) as customers, {MILLIONS} from rule_table group by all", approx="revenue_m")
def value_risk_matrix(w):
    return dashboards.value_risk_matrix(w.rule_table)


@query("activity_by_value", """
  with g as (select value_tier, activity_status, count(*) as customers from rule_table group by all)
  select *, customers / (select sum(customers) from g t where t.value_tier = g.value_tier) as share_of_tier from g""", approx="share_of_tier")
def activity_by_value(w):
    return dashboards.activity_by_value(w.rule_table)


_months = ", ".join(f"max(floor(retention_rate * 10000 + 0.5 + 1e-7) / 100.0) filter (months_since_acquisition = {k}) as month_{k}" for k in range(1, 13))


@query("cohort_heatmap", f"""
  select acquisition_month, {_months} from cohort_retention
  where not is_small_cohort and months_since_acquisition between 1 and 12 group by 1""")
def cohort_heatmap(w):
    return dashboards.cohort_heatmap(w.cohort_retention)


@query("low_volume_filters", """
  select acquisition_month, months_since_acquisition, retention_rate from cohort_retention
  where cohort_customers >= 100 and months_since_acquisition >= 1 and months_since_acquisition <= 12""")
def low_volume_filters(w):
    kept = ~F.col("is_small_cohort") & F.col("months_since_acquisition").between(1, 12)
    return w.cohort_retention.where(kept).select("acquisition_month", "months_since_acquisition", "retention_rate")


@query("opportunity_map", f"select customer_group, {MILLIONS}, {RETURN_PCT}, count(*) as customers from rule_table group by 1", approx="revenue_m")
def opportunity_map(w):
    return dashboards.opportunity_map(w.rule_table)


@query("action_bars", "select next_best_action, count(*) as customers, sum(action_cost_brl) as total_cost from rule_table group by 1", "total_cost")
def action_bars(w):
    return dashboards.action_bars(w.rule_table)


@query("group_action_detail", """
  select customer_group, next_best_action, action_reason, count(*) as customers, sum(total_revenue) as revenue,
    sum(expected_revenue_180d) as expected_revenue_180d from rule_table group by all""", "revenue", "expected_revenue_180d")
def group_action_detail(w):
    return dashboards.group_action_detail(w.rule_table)


@query("category_bars", """
  select product_category, item_revenue::DOUBLE / 1000 as item_revenue_k, avg_review_score from category_performance
  where revenue_rank <= 15""", approx="item_revenue_k")
def category_bars(w):
    return dashboards.category_bars(w.category_performance)


@query("budget_tiles", """
  select count(*) filter (cumulative_action_cost_brl <= 25000) as customers_in_budget,
    floor(sum(action_cost_brl) filter (cumulative_action_cost_brl <= 25000) + 0.5)::DOUBLE as budget_spend,
    count(*) filter (cumulative_action_cost_brl <= 25000 and value_tier = 'High') as high_value_in_budget,
    round(100::DOUBLE * ((sum(total_revenue) filter (cumulative_action_cost_brl <= 25000))::DOUBLE / sum(total_revenue)::DOUBLE) + 1e-9, 1) as revenue_share_pct
  from rule_table""")
def budget_tiles(w):
    return dashboards.budget_tiles(w.rule_table, w.cfg.default_budget)


@query("budget_curve", """
  select priority_rank, cumulative_action_cost_brl, cumulative_action_cost_brl <= 25000 as within_budget from rule_table""", "cumulative_action_cost_brl")
def budget_curve(w):
    return dashboards.budget_curve(w.rule_table, w.cfg.default_budget)


@query("actions_in_budget", """
  select next_best_action, count(*) as customers from rule_table where cumulative_action_cost_brl <= 25000 group by 1""")
def actions_in_budget(w):
    return dashboards.actions_in_budget(w.rule_table, w.cfg.default_budget)


@query("priority_table", """
  select priority_rank, left(customer_unique_id, 8) as customer, customer_state, customer_group, next_best_action,
    round(return_probability * 100 + 1e-9, 2) as return_probability_pct, priority_score, total_revenue, recency_days, action_cost_brl
  from rule_table where cumulative_action_cost_brl <= 25000 and priority_rank <= 100""", "total_revenue action_cost_brl")
def priority_table(w):
    return dashboards.priority_table(w.rule_table, w.cfg.default_budget)


@query("lift_chart", "select decile, lift from rule_deciles", approx="lift")
def lift_chart(w):
    return dashboards.lift_chart(w.rule_deciles)


@query("model_vs_rules", """
  select model, round(roc_auc + 1e-9, 3) as roc_auc, round(pr_auc + 1e-9, 3) as pr_auc, round(lift_top_10pct + 1e-9, 2) as lift_top_10pct,
    round(capture_top_20pct + 1e-9, 3) as capture_top_20pct from rule_evaluation""")
def model_vs_rules(w):
    return dashboards.model_vs_rules(w.rule_evaluation)


@query("driver_table", f"""
  select feature, odds_ratio_per_sd, stable_direction from ({STABILITY})""", approx="odds_ratio_per_sd")
def driver_table(w):
    return dashboards.driver_table(w.coefficients)


def _tile_sql():
    named = {"revenue_band": BAND, "lifecycle_stage": STAGE}
    for tile, keys in dashboards.TILES.items():
        cells = ", ".join(f"{named.get(k, k)} as {k}" if k in keys else f"null::{'INT' if k.endswith('_score') else 'VARCHAR'} as {k}" for k in dashboards.TILE_KEYS)
        yield f"""select '{tile}' as tile, {cells}, count(*) as customers, sum(total_revenue) as revenue, avg(return_probability) as return_rate,
          sum(action_cost_brl) as total_cost, sum(expected_revenue_180d) as expected_revenue_180d from rule_table group by all"""


@query("dashboard_tiles", " union all ".join(_tile_sql()), "revenue total_cost", "return_rate expected_revenue_180d")
def dashboard_tiles(w):
    """The groups of all eleven tiles from one scan of the extract."""
    return w.tile_measures
