"""Hand-made edge rows, one per rule."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.config import RetentionConfig
from tidemark.functions import scalars
from tidemark.operators import (
    customers, decisions, evaluation, explore, metrics, orders, quality, snapshots, staging,
)
from tidemark.sources.schemas import RAW_TABLES

CFG = RetentionConfig()
DAY = dt.datetime(2017, 5, 10, 12)


def raw(spark, table, *rows):
    spec = RAW_TABLES[table]
    filled = [tuple(r.get(c) for c in spec.column_names) for r in rows]
    return spark.createDataFrame(filled, spec.schema)


def at(days=0, hours=0):
    return DAY + dt.timedelta(days=days, hours=hours)


def order(key, bought=DAY, carrier=None, arrived=None, estimate=None, status="delivered"):
    return {
        "order_id": key, "customer_id": f"c{key}", "order_status": status, "order_purchase_timestamp": bought,
        "order_delivered_carrier_date": carrier, "order_delivered_customer_date": arrived,
        "order_estimated_delivery_date": estimate,
    }


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_impossible_dates_become_null_and_are_flagged(spark):
    df = staging.stg_orders(raw(
        spark, "orders",
        order("a", carrier=at(1), arrived=at(-1)), order("b", carrier=at(-1), arrived=at(3)),
        order("c", carrier=at(3), arrived=at(2)), order("d", carrier=at(1)), order("e", carrier=at(1), arrived=at(2))))
    got = by(df, "order_id", "shipped_to_carrier_at", "delivered_at", "has_date_quality_issue")
    assert got == {
        "a": (at(1), None, True), "b": (None, at(3), True), "c": (at(3), at(2), True),
        "d": (at(1), None, True), "e": (at(1), at(2), False)}


def test_status_is_cleaned_before_validity(spark):
    row = staging.stg_orders(raw(spark, "orders", order("a", status=" Canceled "))).first()
    assert (row["order_status"], row["is_valid_purchase"]) == ("canceled", False)


def test_text_and_number_cleaning(spark):
    paid = raw(spark, "order_payments", *[
        {"order_id": str(i), "payment_sequential": 1, "payment_type": " Voucher", "payment_installments": n}
        for i, n in enumerate([None, 0, 3])])
    assert by(staging.stg_order_payments(paid), "order_id", "payment_installments") == {"0": 1, "1": 1, "2": 3}
    people = raw(spark, "customers", {"customer_id": "1", "customer_zip_code_prefix": " 123", "customer_state": "sp "},
                 {"customer_id": "2", "customer_zip_code_prefix": "01234"})
    assert by(staging.stg_customers(people), "customer_id", "customer_zip_code_prefix") == {"1": "00123", "2": "01234"}
    goods = staging.stg_products(raw(spark, "products", {"product_id": "p", "product_category_name": "  ", "product_weight_g": 0}))
    words = staging.stg_category_translation(raw(spark, "product_category_translation", {"product_category_name": "x"}))
    row = orders.dim_products(goods, words).first()
    assert (row["product_category_name_pt"], row["product_weight_g"], row["product_category"]) == (None, None, "unknown")


def test_location_mode_prefers_the_smaller_name_on_a_tie(spark):
    point = {"geolocation_zip_code_prefix": "1", "geolocation_lat": -10.0, "geolocation_lng": -50.0, "geolocation_state": "sp"}
    df = staging.stg_geolocation(raw(
        spark, "geolocation", {**point, "geolocation_city": "b"}, {**point, "geolocation_city": "A"},
        {**point, "geolocation_lat": 50.0, "geolocation_city": "b"}))
    row = df.first()
    assert (row["zip_code_prefix"], row["city"], row["state"], row["source_point_count"]) == ("00001", "a", "SP", 2)


@pytest.fixture(scope="module")
def joined(spark):
    """a: three items, two payments, two reviews; b: items only; c: nothing; d, e, f: lateness."""
    est = dt.datetime(2017, 5, 20)
    heads = raw(
        spark, "orders", order("a"), order("b"), order("c", status="canceled"),
        order("d", arrived=dt.datetime(2017, 5, 20, 23), estimate=est),
        order("e", arrived=dt.datetime(2017, 5, 21), estimate=est), order("f", arrived=at(3)))
    people = raw(spark, "customers", *[{"customer_id": f"c{k}", "customer_unique_id": "p"} for k in "abcdef"])
    items = raw(spark, "order_items", *[
        {"order_id": k, "order_item_id": i, "product_id": str(i), "seller_id": "s", "price": Decimal("10.00"),
         "freight_value": Decimal("1.50")} for k, i in (("a", 1), ("a", 2), ("a", 3), ("b", 1))])
    paid = raw(spark, "order_payments", *[
        {"order_id": "a", "payment_sequential": i, "payment_type": t, "payment_value": Decimal("20.00")}
        for i, t in ((1, "boleto"), (2, "voucher"))])
    asked = raw(spark, "order_reviews", *[{"review_id": str(i), "order_id": "a", "review_score": i} for i in (2, 5)])
    stg = {n: staging.STAGING[n](df) for n, df in (
        ("orders", heads), ("customers", people), ("order_items", items), ("order_payments", paid), ("order_reviews", asked))}
    return orders.orders_enriched(
        stg["orders"], stg["customers"], orders.items_per_order(stg["order_items"]),
        orders.payments_per_order(stg["order_payments"]), orders.reviews_per_order(stg["order_reviews"]))


def test_roll_ups_do_not_fan_out(joined):
    row = joined.where("order_id = 'a'").collect()
    assert len(row) == 1
    r = row[0]
    assert (r["item_count"], r["items_subtotal"], r["payment_total"], r["review_count"], r["review_score_avg"]) == (
        3, Decimal("30.00"), Decimal("40.00"), 2, 3.5)
    assert r["main_payment_type"] == "voucher"  # equal payments prefer the later name


def test_revenue_falls_back_to_items_then_zero(joined):
    assert {k: by(joined, "order_id", "order_revenue")[k] for k in "abc"} == {
        "a": Decimal("40.00"), "b": Decimal("11.50"), "c": Decimal("0.00")}


def test_lateness_compares_dates(joined):
    got = by(joined, "order_id", "is_late_delivery", "days_late")
    assert (got["d"], got["e"], got["a"], got["f"]) == ((False, 0), (True, 1), (None, None), (None, None))


def test_purchase_sequence_skips_canceled_and_breaks_ties_by_id(joined):
    assert by(joined, "order_id", "customer_order_number") == {"a": 1, "b": 2, "c": None, "d": 3, "e": 4, "f": 5}
    assert by(joined, "order_id", "is_first_purchase")["a"] is True


def rfm_rows(spark, rows):
    return spark.createDataFrame(rows, "id int, r_score int, f_score int, m_score int")


def test_nine_segments_in_order(spark):
    cases = [(2, 4, 4), (2, 3, 5), (2, 2, 5), (1, 3, 5), (1, 2, 5), (1, 4, 4), (1, 3, 1), (1, 2, 1), (1, 1, 1)]
    df = rfm_rows(spark, [(i, r, f, m) for i, (f, r, m) in enumerate(cases)])
    got = by(df.withColumn("s", customers.rfm_segment()), "id", "s")
    assert [got[i] for i in range(9)] == [
        "Champions", "Loyal Customers", "At-Risk Repeat Customers", "High-Value Recent", "High-Value Lapsing",
        "Recent One-Time Buyers", "Needs Attention", "Hibernating", "Lost"]


def test_equal_recency_shares_the_lowest_score(spark):
    df = spark.createDataFrame([(i, 30) for i in range(20)], "id int, days_since_last_purchase int")
    key = -F.col("days_since_last_purchase")
    cuts = customers.score_cuts(df, key, "r", bounded=True)
    assert {r["s"] for r in df.crossJoin(cuts).select(customers.from_cuts(key, "r").alias("s")).collect()} == {1}


def test_activity_edges(spark):
    df = spark.createDataFrame([(d,) for d in (180, 181, 365, 366)], "days_since_last_purchase int")
    got = [r[0] for r in df.select(customers.activity_status(CFG)).collect()]
    assert got == ["Active", "Cooling", "Cooling", "Inactive"]


def test_calendar_months_and_bins(spark):
    row = spark.sql("select date'2017-01-31' a, date'2017-02-01' b").select(scalars.months_between_starts("b", "a").alias("m")).first()
    assert row["m"] == 1
    df = spark.createDataFrame([(0.0,), (90.0,), (90.5,), (10000.0,), (10001.0,)], "d double")
    slot = scalars.right_closed_bin("d", explore.RECENCY_EDGES, explore.RECENCY_LABELS)
    assert [r[0] for r in df.select(slot).collect()] == [None, "0-90", "91-180", "365+", "365+"]


def test_rounding_rules(spark):
    df = spark.createDataFrame([(0.25, 2.5)], "a double, b double")
    assert tuple(df.select(scalars.half_even("a", 1), scalars.half_even("b", 0)).first()) == (0.2, 2.0)
    exact = spark.sql("select cast(2469.13 as decimal(18,2)) a, 2 n, 0 z")
    assert tuple(exact.select(scalars.exact_ratio("a", "n", 2), scalars.exact_ratio("a", "z", 2)).first()) == (Decimal("1234.57"), None)


# ------------------------------------------------------------------ cohorts
def test_cohort_grid_has_zero_rows_and_stops(spark):
    months = [dt.date(2015 + m // 12, m % 12 + 1, 1) for m in range(40)]
    rows = [("p0", m, 200, months[0]) for m in months if m != months[2]] + [("p1", months[1], 200, months[1])]
    rows += [("p2", dt.date(2018, 6, 1), 5, months[0])]
    df = spark.createDataFrame(rows, "customer_unique_id string, purchase_month date, orders long, acquisition_month date")
    df = df.withColumn("revenue", F.lit(1).cast("decimal(28,2)")).withColumn("items", F.lit(1).cast("long"))
    grid = metrics.cohort_retention(df, CFG)
    first = by(grid.where(F.col("acquisition_month") == months[0]), "months_since_acquisition", "active_customers")
    assert sorted(first) == list(range(40)) and first[2] == 0
    assert grid.where("acquisition_month >= date'2018-06-01'").count() == 0


# ------------------------------------------------------------------ snapshots
def history(spark, *rows):
    schema = ("customer_unique_id string, order_id string, customer_state string, purchased_at timestamp_ntz, "
              "delivered_at timestamp_ntz, is_late_delivery boolean, order_revenue decimal(18,2), item_count long")
    return spark.createDataFrame([(c, o, s, b, d, late, Decimal("10"), 1) for c, o, s, b, d, late in rows], schema)


def answers(spark, *rows):
    return spark.createDataFrame(list(rows), "order_id string, review_score double, survey_answered_at timestamp_ntz")


D = dt.date(2017, 6, 1)
T0 = dt.datetime(2017, 6, 1)


def test_nothing_from_the_as_of_instant_on_is_used(spark):
    before = T0 - dt.timedelta(days=10)
    h = history(spark, ("p", "1", "SP", before, T0, True), ("p", "2", "RJ", T0, None, None), ("q", "3", "RJ", T0, None, None))
    r = answers(spark, ("1", 1.0, T0))
    rows = snapshots.build_features(h, r, snapshots.as_of_table(spark, [D])).collect()
    assert len(rows) == 1
    f = rows[0]
    assert (f["order_count"], f["customer_state"], f["had_late_delivery"], f["has_review"], f["recency_days"]) == (1, "SP", 0, 0, 10.0)


def test_features_ignore_later_events(spark, workspace):
    """Deleting everything at or after the date changes nothing."""
    cut = F.lit(workspace.cfg.test_date).cast("timestamp_ntz")
    dates = snapshots.as_of_table(spark, [workspace.cfg.test_date])
    h, r = workspace.history, workspace.reviews
    later = F.col("delivered_at") >= cut
    cropped = h.where(F.col("purchased_at") < cut).withColumn("is_late_delivery", F.when(~later, F.col("is_late_delivery"))).withColumn(
        "delivered_at", F.when(~later, F.col("delivered_at")))
    whole = snapshots.build_features(h, r, dates)
    small = snapshots.build_features(cropped, r.where(F.col("survey_answered_at") < cut), dates)
    assert whole.count() > 0 and whole.exceptAll(small).count() == 0 and small.exceptAll(whole).count() == 0


def test_imputation_uses_the_mean_known_by_then(spark):
    b = T0 - dt.timedelta(days=20)
    h = history(spark, ("p", "1", "SP", b, None, None), ("q", "2", "SP", b, None, None), ("r", "3", "SP", b, None, None))
    r = answers(spark, ("1", 5.0, b), ("2", 2.0, b), ("3", 1.0, T0))
    got = by(snapshots.build_features(h, r, snapshots.as_of_table(spark, [D])), "customer_unique_id",
             "avg_review_score", "avg_review_score_observed", "has_review")
    assert got["r"] == (3.5, None, 0) and got["p"] == (5.0, 5.0, 1)


def test_label_window_is_half_open(spark):
    b, end = T0 - dt.timedelta(days=5), T0 + dt.timedelta(days=180)
    h = history(spark, ("p", "1", "SP", b, None, None), ("p", "2", "SP", T0, None, None),
                ("q", "3", "SP", b, None, None), ("q", "4", "SP", end, None, None))
    got = by(snapshots.labelled_snapshots(h, answers(spark, ("1", 1.0, b)), [D], 180), "customer_unique_id", "returned")
    assert got == {"p": 1, "q": 0}


def test_label_window_may_not_pass_the_data(spark):
    h = history(spark, ("p", "1", "SP", T0 + dt.timedelta(days=178), None, None))
    with pytest.raises(snapshots.LabelWindowError):
        snapshots.labelled_snapshots(h, answers(spark, ("1", 1.0, T0)), [D], 180)


def test_overnight_repeat_is_gap_zero_but_two_days(spark):
    h = history(spark, ("p", "1", "SP", dt.datetime(2017, 1, 1, 23), None, None), ("p", "2", "SP", dt.datetime(2017, 1, 2, 1), None, None))
    assert [r["gap_days"] for r in explore.repeat_gaps(h).collect()] == [0]
    f = snapshots.build_features(h, answers(spark, ("1", 1.0, T0)), snapshots.as_of_table(spark, [D])).first()
    assert (f["purchase_days"], f["is_repeat_customer"]) == (2, 1)


# ------------------------------------------------------------------ evaluation
def brute_auc_ap(y, s):
    pos, neg = [a for a, b in zip(s, y) if b], [a for a, b in zip(s, y) if not b]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, hits = 0.0, 0
    for cut in sorted(set(s), reverse=True):
        chosen = [b for a, b in zip(s, y) if a >= cut]
        ap += (sum(chosen) - hits) / len(pos) * sum(chosen) / len(chosen)
        hits = sum(chosen)
    return auc, ap


def test_ranking_metrics_with_ties_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    y = [int(rng.random() < 0.3) for _ in range(203)]
    s = [rng.randint(0, 12) / 4 for _ in y]
    df = spark.createDataFrame([(f"{i:04d}", a, b) for i, (a, b) in enumerate(zip(y, s))], "customer_unique_id string, returned int, score double")
    flipped = df.withColumn("score", -F.col("score"))
    out = {r["model"]: r for r in evaluation.evaluate(evaluation.long_scores({"a": df, "b": flipped}, "a")).collect()}
    auc, ap = brute_auc_ap(y, s)
    assert out["a"]["roc_auc"] == pytest.approx(auc) and out["a"]["pr_auc"] == pytest.approx(ap)
    assert out["b"]["roc_auc"] == pytest.approx(1 - auc) and out["b"]["brier_score"] is None
    best = sorted(zip(s, [f"{i:04d}" for i in range(203)], y), key=lambda t: (-t[0], t[1]))[:20]
    assert out["a"]["capture_top_10pct"] == pytest.approx(sum(b for *_, b in best) / sum(y))


@pytest.mark.parametrize("n", [10, 57, 103])
def test_deciles_follow_quantile_edges(spark, n):
    import numpy as np

    df = spark.createDataFrame([(f"{i:04d}", float(i)) for i in range(n)], "customer_unique_id string, score double")
    got = by(evaluation.deciles(df), "position", "decile")
    edges = np.quantile(np.arange(1, n + 1), np.linspace(0, 1, 11))
    want = {i: int(max(1, np.searchsorted(edges, i, side="left"))) for i in range(1, n + 1)}
    assert got == want


# ------------------------------------------------------------------ decisions
def test_risk_edges_and_service_recovery(spark):
    df = spark.createDataFrame([(0.40,), (0.401,), (0.80,), (0.801,)], "p double")
    assert [r[0] for r in df.select(decisions.risk_tier(F.col("p"), CFG)).collect()] == ["High", "Medium", "Medium", "Low"]
    rows = [("a", "Low Value", 2.0, "Medium"), ("b", "Low Value", 2.0, "Low"), ("c", "Low Value", None, "High")]
    df = spark.createDataFrame(rows, "id string, customer_group string, avg_review_score_observed double, value_tier string")
    got = by(decisions.next_best_action(df, CFG), "id", "next_best_action", "action_cost_brl")
    assert got["a"] == ("Service recovery", Decimal("20.00")) and got["b"][0] == got["c"][0] == "Low-cost email campaign"


def budget_rows(spark, costs):
    total, rows = Decimal(0), []
    for i, cost in enumerate(costs):
        total += Decimal(cost)
        rows.append((str(i), Decimal(cost), total, Decimal("10"), "High", "Win-back offer", 2.0, 90.0 - i))
    return spark.createDataFrame(
        rows, "customer_unique_id string, action_cost_brl decimal(18,2), cumulative_action_cost_brl decimal(28,2), "
        "total_revenue decimal(28,2), value_tier string, next_best_action string, expected_revenue_180d double, priority_score double")


def test_budget_includes_the_exact_amount_and_keeps_empty_budgets(spark):
    got = by(decisions.budget_scenarios(budget_rows(spark, ["25", "25", "25"]), (10, 50, 100)), "budget_brl",
             "customers_reached", "spend_brl", "lowest_priority_score_included", "n_win_back_offer")
    assert got == {10: (0, Decimal("0.00"), None, 0), 50: (2, Decimal("50.00"), 89.0, 2), 100: (3, Decimal("75.00"), 88.0, 3)}


def test_gate_refuses_missing_groups(spark):
    schema = "customer_unique_id string, return_probability double, priority_score double, action_cost_brl double, customer_group string"
    good = spark.createDataFrame([("a", 0.1, 50.0, 1.0, "New Customer")], schema)
    quality.require_gate(quality.gate_checks(good, good))
    bad = spark.createDataFrame([("a", 0.1, 50.0, 1.0, None)], schema)
    with pytest.raises(quality.GateError, match="no missing group"):
        quality.require_gate(quality.gate_checks(bad, bad))


def test_weights_and_windows_are_validated():
    with pytest.raises(ValueError):
        RetentionConfig(weight_value=0.5)
    with pytest.raises(ValueError):
        RetentionConfig(train_dates=(dt.date(2018, 1, 1),))


# ------------------------------------------------------------------ quality
def test_schema_contract_reports_every_kind_of_difference(spark):
    tables = {n: spark.createDataFrame([], s.schema) for n, s in RAW_TABLES.items()}
    assert quality.schema_contract_diff(tables).where("status <> 'PASS'").count() == 0
    tables["sellers"] = spark.createDataFrame([], "seller_id string, seller_city string, seller_zip_code_prefix int, extra string")
    got = by(quality.schema_contract_diff(tables).where("table_name = 'sellers'"), "column_name", "status")
    assert got == {
        "seller_id": "PASS", "seller_city": "FAIL - wrong position", "seller_zip_code_prefix": "FAIL - wrong position",
        "seller_state": "FAIL - missing column", "extra": "FAIL - unexpected column"}


def test_violations_are_found(spark):
    facts = spark.createDataFrame(
        [("a", Decimal("-1"), DAY, at(-1)), ("b", Decimal("1"), DAY, at(1))],
        "order_id string, order_revenue decimal(18,2), purchased_at timestamp_ntz, approved_at timestamp_ntz")
    facts = facts.withColumn("items_subtotal", F.lit(0)).withColumn("freight_total", F.lit(0))
    assert [r["order_id"] for r in quality.negative_revenue(facts).collect()] == ["a"]
    dated = facts.withColumn("shipped_to_carrier_at", F.lit(None).cast("timestamp_ntz")).withColumn("delivered_at", F.lit(None).cast("timestamp_ntz"))
    assert [r["order_id"] for r in quality.impossible_dates(dated, CFG).collect()] == ["a"]
    parents = spark.createDataFrame([("1",)], "k string")
    children = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "k string")
    assert quality.orphans(children, parents, "k", "k").first()[0] == 3
    assert quality.orphans(children, parents, "k", "k", keep_null=False).first()[0] == 2
    assert quality.duplicate_key_count(children, ["k"]).first()["duplicate_rows"] == 1
