"""Point-in-time features, labels, model fitting, evaluation and exploration."""

from pyspark.sql import functions as F

from tidemark.config import MODEL_FEATURES
from tidemark.operators import evaluation, explore, model, snapshots
from tidemark.operators.ordered import attach, value_ranks
from tidemark.plans.catalog import model_query, query
from tidemark.plans.oracle_models import fitted_probability_sql

LOGS = "log_recency_days log_monetary log_tenure_days"
METRICS = "base_rate roc_auc pr_auc lift_top_10pct capture_top_10pct lift_top_20pct capture_top_20pct brier_score brier_score_baseline"
DECILE = "predicted_rate actual_rate lift cumulative_capture"

model_query("labelled_snapshot", "labelled", approx=LOGS)
model_query("scoring_features", "features_current", approx=LOGS, model="current")
model_query("repeat_gap_days", "repeat_gaps", model="gaps")


@query("load_orders_and_reviews", """
  select v.customer_unique_id, v.order_id, v.customer_state, v.purchased_at, v.delivered_at, v.is_late_delivery,
    v.order_revenue, v.item_count, r.review_score::DOUBLE as review_score, r.survey_answered_at
  from valid v left join stg_order_reviews r using (order_id)""", "order_revenue")
def load_orders_and_reviews(w):
    return w.history.join(w.reviews, "order_id", "left")


@query("customer_history_as_of", """
  select as_of_date, customer_unique_id, first_purchase_at, last_purchase_at, order_count, purchase_days, monetary,
    total_items, customer_state from features_snapshots""")
def customer_history_as_of(w):
    dates = snapshots.as_of_table(w.spark, [*w.cfg.train_dates, w.cfg.test_date])
    base = snapshots.customer_history(w.history, w.reviews, dates)
    return base.select(
        *snapshots.KEYS, "first_purchase_at", "last_purchase_at", "order_count",
        F.least(F.col("all_purchase_days"), F.lit(5)).alias("purchase_days"), "monetary", "total_items", "customer_state")


@query("before_snapshot_filter", """
  select count(*) as orders, count(*) filter (delivered_at < timestamp '2001-01-01') as delivered
  from valid where purchased_at < timestamp '2001-01-01'""")
def before_snapshot_filter(w):
    at = F.lit(w.cfg.test_date).cast("timestamp_ntz")
    return w.history.where(F.col("purchased_at") < at).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("delivered_at") < at).alias("delivered"))


@query("half_open_window_filter", """
  select as_of_date, v.customer_unique_id
  from valid v, (select unnest([date '2000-01-01', date '2000-06-01', date '2001-01-01']) as as_of_date)
  where v.purchased_at >= as_of_date::TIMESTAMP and v.purchased_at < as_of_date::TIMESTAMP + interval 180 day
  group by all""")
def half_open_window_filter(w):
    dates = snapshots.as_of_table(w.spark, [*w.cfg.train_dates, w.cfg.test_date])
    return snapshots.buyers_in_window(w.history, dates, w.cfg.horizon_days)


def _pick(columns):
    return lambda w: w.labelled.select(*snapshots.KEYS, *columns)


for key, columns in {
    "late_flag_as_of": ["had_late_delivery"],
    "review_mean_as_of": ["avg_review_score_observed"],
    "mean_imputation_as_of": ["avg_review_score", "avg_review_score_observed", "has_review"],
    "add_label": ["returned"],
}.items():
    query(key, f"select as_of_date, customer_unique_id, {', '.join(columns)} from labelled")(_pick(columns))

DERIVED = ["recency_days", "days_since_first_purchase", "tenure_days", "avg_order_value", "items_per_order",
           "is_repeat_customer", "orders_per_month_active", "is_sao_paulo", "purchase_days", *LOGS.split()]
query("derived_features", f"select as_of_date, customer_unique_id, {', '.join(DERIVED)} from labelled", approx=LOGS)(_pick(DERIVED))


@query("semi_join_isin", """
  select f.customer_unique_id from features_test f where f.customer_unique_id in
    (select customer_unique_id from valid where purchased_at >= timestamp '2001-01-01' and purchased_at < timestamp '2001-06-30')""")
def semi_join_isin(w):
    dates = snapshots.as_of_table(w.spark, [w.cfg.test_date])
    features = snapshots.build_features(w.history, w.reviews, dates)
    buyers = snapshots.buyers_in_window(w.history, dates, w.cfg.horizon_days)
    return features.join(buyers, snapshots.KEYS, "left_semi").select("customer_unique_id")


@query("index_left_join", """
  select as_of_date, customer_unique_id, order_count, had_late_delivery, avg_review_score_observed from features_current""")
def index_left_join(w):
    base = snapshots.customer_history(w.history, w.reviews, w.scoring_dates)
    return base.select(*snapshots.KEYS, "order_count", "had_late_delivery", "avg_review_score_observed")


@query("concat_snapshots", """
  select as_of_date, count(*) as customers, sum(returned)::BIGINT as returned from labelled
  where as_of_date < date '2001-01-01' group by as_of_date""")
def concat_snapshots(w):
    return w.train.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("customers"), F.sum("returned").alias("returned"))


@query("pct_rank_average", """
  select customer_unique_id, ((rank() over (order by monetary))::DOUBLE + (count(*) over (partition by monetary) - 1)::DOUBLE / 2::DOUBLE)
    / (count(*) over ())::DOUBLE as spend_pct from features_current""")
def pct_rank_average(w):
    spend = w.current.select("customer_unique_id", "monetary")
    ranked = attach(spend, value_ranks(spend, "monetary"), "monetary", spend_pct="pct_rank")
    return ranked.select("customer_unique_id", "spend_pct")


# ------------------------------------------------------------------ rules, model, evaluation
@query("rule_recency", "select customer_unique_id, -recency_days as score from test_set")
def rule_recency(w):
    return w.rule_scores["Rule: most recent first"].select("customer_unique_id", "score")


@query("rule_rfm", "select customer_unique_id, score from rule_rfm_test")
def rule_rfm(w):
    return w.rule_scores["Rule: RFM score"].select("customer_unique_id", "score")


@query("rule_random", "select customer_unique_id, score from rule_long where model = 'Random (no model)'")
def rule_random(w):
    return w.rule_scores["Random (no model)"].select("customer_unique_id", "score")


@query("roc_auc", "from rule_auc", approx="roc_auc")
def roc_auc(w):
    return w.rule_evaluation.select("model", "roc_auc")


@query("average_precision", "from rule_ap", approx="pr_auc")
def average_precision(w):
    return w.rule_evaluation.select("model", "pr_auc")


@query("lift_capture", "from rule_top", approx="lift_top_10pct capture_top_10pct lift_top_20pct capture_top_20pct")
def lift_capture(w):
    return w.rule_evaluation.select("model", "lift_top_10pct", "capture_top_10pct", "lift_top_20pct", "capture_top_20pct")


@query("top_share_selection", "select model, customer_unique_id from rule_ranked where pos <= greatest(round_even(n * 0.1::DOUBLE, 0), 1)")
def top_share_selection(w):
    ranked = evaluation.ranked_scores(evaluation.long_scores(w.rule_scores))
    sizes = evaluation.model_sizes(ranked)
    quota = F.greatest(F.rint(F.col("customers") * 0.10), F.lit(1.0))
    return ranked.join(F.broadcast(sizes.select("model", "customers")), "model").where(F.col("position") <= quota).select("model", "customer_unique_id")


@query("brier", """
  select brier_score, brier_score_baseline from rule_evaluation where brier_score is not null""", approx="brier_score brier_score_baseline")
def brier(w):
    return w.rule_evaluation.where("brier_score is not null").select("brier_score", "brier_score_baseline")


model_query("model_evaluation", "rule_evaluation", approx=METRICS)
model_query("decile_table", "rule_deciles", approx=DECILE)


@query("deciles", """
  with r as (select customer_unique_id, row_number() over (order by score desc, customer_unique_id) as pos, count(*) over () as n from rule_rfm_test)
  select customer_unique_id, least(10, greatest(1, ceil(10 * (pos - 1) / (n - 1))))::INT as decile from r""")
def deciles(w):
    """Who is in which decile."""
    scored = w.rule_scores["Rule: RFM score"].select("customer_unique_id", "score")
    return evaluation.deciles(scored).select("customer_unique_id", "decile")


@query("cumulative_capture", "select decile, cumulative_capture from rule_deciles", approx="cumulative_capture")
def cumulative_capture(w):
    return w.rule_deciles.select("decile", "cumulative_capture")


# ------------------------------------------------------------------ fitted models
# The oracle takes the same Newton steps in a recursive query; both end at the one minimum of the loss.
COEFFICIENTS = "coefficient feature_std odds_ratio_per_sd"


@query("fit_return_model", " union all ".join(
    f"select '{f}' as feature, mean_{f} as feature_mean, std_{f} as feature_std, b{i} as coefficient, b0 as intercept "
    "from trained_weights, trained_moments" for i, f in enumerate(MODEL_FEATURES, 1)), approx="feature_mean feature_std coefficient intercept")
def fit_return_model(w):
    """Everything the fit on the training snapshots found."""
    fitted = w.train_model
    rows = [(f, m, s, c, fitted.intercept) for f, m, s, c in zip(fitted.features, fitted.means, fitted.scales, fitted.coefficients, strict=True)]
    return w.spark.createDataFrame(rows, "feature string, feature_mean double, feature_std double, coefficient double, intercept double")


@query("coefficient_table", "from final_coefficients", approx=COEFFICIENTS)
def coefficient_table(w):
    return model.coefficient_table(w.spark, w.final_model)


@query("predict_return", f"""
  select customer_unique_id, score as return_probability from ({fitted_probability_sql('trained', 'features_current')})""", approx="return_probability")
def predict_return(w):
    return model.predict_return(w.train_model, w.current).select("customer_unique_id", "return_probability")


@query("train_test_refit", f"""
  select customer_unique_id, returned, score as return_probability from ({fitted_probability_sql('final', 'test_set')})""", approx="return_probability")
def train_test_refit(w):
    """The refit on all snapshots, applied to the test snapshot."""
    return model.predict_return(w.final_model, w.test).select("customer_unique_id", "returned", "return_probability")


STABILITY = """
  select f.*, t.odds_ratio_per_sd as odds_ratio_train_only, (f.coefficient > 0) = (t.coefficient > 0) as stable_direction
  from final_coefficients f join trained_coefficients t using (feature)"""


@query("coefficient_stability", STABILITY, approx=f"{COEFFICIENTS} odds_ratio_train_only")
def coefficient_stability(w):
    """Stable is what points the same way in either fit."""
    return w.coefficients


model_query("fitted_model_evaluation", "fitted_evaluation", approx=METRICS, model="model_evaluation")


@query("fitted_decile_table", """
  with r as (select *, row_number() over (order by score desc, customer_unique_id) as pos, count(*) over () as n from fitted_test),
  d as (select *, least(10, greatest(1, ceil(10 * (pos - 1) / (n - 1))))::INT as decile from r),
  g as (select decile, count(*) as customers, sum(returned)::BIGINT as returned, avg(score) as predicted_rate from d group by decile)
  select *, returned / customers as actual_rate, (returned / customers) / ((select sum(returned) from g) / (select sum(customers) from g)) as lift,
    (select sum(returned) from g e where e.decile <= g.decile) / (select sum(returned) from g) as cumulative_capture from g""", approx=DECILE)
def fitted_decile_table(w):
    return w.model_deciles


# ------------------------------------------------------------------ exploration
FREQUENCY = """
  select k::INT as purchase_days, (select count(*) from features_current where least(purchase_days, 4) = k) / (select count(*) from features_current) as share_of_customers
  from range(1, 5) t(k)"""


@query("value_counts_normalised", FREQUENCY)
def value_counts_normalised(w):
    return explore.purchase_frequency(w.current)


@query("purchase_frequency_share", """
  select count(*) filter (purchase_days = 1) / count(*) as share_one_time_buyers,
    1 - count(*) filter (purchase_days = 1) / count(*) as share_repeat_buyers from features_current""")
def purchase_frequency_share(w):
    shares = explore.purchase_frequency(w.current)
    once = F.max(F.when(F.col("purchase_days") == 1, F.col("share_of_customers")))
    return shares.agg(once.alias("share_one_time_buyers"), (1 - once).alias("share_repeat_buyers"))


@query("repeat_gap_stats", """
  select count(*) filter (gap_days = 0) / count(*) as same_day_share,
    count(*) filter (gap_days between 1 and 90) / count(*) filter (gap_days > 0) as within_90d,
    count(*) filter (gap_days between 1 and 180) / count(*) filter (gap_days > 0) as within_180d,
    count(*) filter (gap_days between 1 and 365) / count(*) filter (gap_days > 0) as within_365d,
    median(gap_days) filter (gap_days > 0) as median_days from repeat_gaps""")
def repeat_gap_stats(w):
    return explore.repeat_gap_stats(w.gaps)


@query("repeat_gap_histogram", """
  select (least(least(gap_days, 600) // 15, 39) * 15)::INT as bin_start, count(*) as repeats from repeat_gaps
  where gap_days > 0 group by 1""")
def repeat_gap_histogram(w):
    return explore.repeat_gap_histogram(w.gaps)


@query("lorenz_curve", "from lorenz")
def lorenz_curve(w):
    return explore.lorenz_curve(w.current)


@query("revenue_concentration", """
  select share_of_revenue as top20_revenue_share from lorenz where spend_rank = floor(customers * 0.2::DOUBLE)""")
def revenue_concentration(w):
    return explore.top_fifth_share(w.current)


@query("return_rate_by_recency", """
  select if(recency_days > 365, '365+', if(recency_days > 180, '181-365', if(recency_days > 90, '91-180', '0-90'))) as recency_bucket,
    avg(returned) as return_rate from test_set where recency_days > 0 group by 1""", approx="return_rate")
def return_rate_by_recency(w):
    return explore.return_rate_by_recency(w.test_only)


@query("return_rate_by_review", """
  select round_even(avg_review_score_observed, 0)::INT as review_bucket, avg(returned) as return_rate from test_set
  where has_review = 1 group by 1""", approx="return_rate")
def return_rate_by_review(w):
    return explore.return_rate_by_review(w.test_only)


@query("return_rate_by_lateness", "select had_late_delivery, avg(returned) as return_rate from test_set group by 1", approx="return_rate")
def return_rate_by_lateness(w):
    return explore.return_rate_by_lateness(w.test_only)


DESCRIPTION = """
  select count(*) as customers, quantile_cont(recency_days, 0.5) as median_recency_days, quantile_cont(monetary, 0.5) as median_monetary,
    quantile_cont(avg_order_value, 0.5) as median_avg_order_value from features_current"""
MEDIANS = "median_recency_days median_monetary median_avg_order_value"


@query("base_description", DESCRIPTION, approx=MEDIANS)
def base_description(w):
    return explore.base_description(w.current)


@query("medians", f"select median_recency_days, median_monetary, median_avg_order_value from ({DESCRIPTION})", approx=MEDIANS)
def medians(w):
    return explore.base_description(w.current).drop("customers")


@query("review_by_lateness", """
  with d as (from valid where is_late_delivery is not null)
  select is_late_delivery, count(*) as orders, round(avg(review_score_avg) + 1e-9, 2) as avg_review_score,
    count(*) / (select count(*) from d) as share_of_deliveries from d group by 1""")
def review_by_lateness(w):
    return explore.review_by_lateness(w.joined_orders)


@query("second_purchase_within_180d", """
  with s as (select customer_unique_id, purchased_at, row_number() over w as n, lag(purchased_at) over w as before
             from valid window w as (partition by customer_unique_id order by purchased_at, order_id))
  select count(*) filter (n = 1) as customers, count(*) filter (n = 2 and purchased_at <= before + interval 180 day) as bought_again,
    count(*) filter (n = 2 and purchased_at <= before + interval 180 day) / count(*) filter (n = 1) as share_bought_again from s""")
def second_purchase_within_180d(w):
    return explore.second_purchase_within(w.history)
