"""What is shuffled, and in which form: near-unique keys are not aggregated before their shuffle."""

import datetime as dt
import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.operators import metrics, orders, quality, snapshots


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchanges(df):
    lines = plan(df).splitlines()
    return [(line, below) for line, below in zip(lines, lines[1:], strict=False) if " Exchange " in line]


def test_lines_meet_their_order_before_they_are_rolled_up(spark):
    from tidemark.plans.workspace import Workspace

    with Workspace.over_star(spark, SMALL) as w:
        found = below_exchanges(w.joined_orders)
        assert found and not [below for _, below in found if "Aggregate" in below]
        # Lineitem (three times), reviews, orders (by key, account, customer and id), customers by account and by id.
        assert len(found) <= 10


def test_gathered_lines_roll_up_to_the_same_rows(spark):
    items = spark.createDataFrame(
        [("a", "p", "s", "1.10", "0.10"), ("a", "p", "t", "1.10", "0.10"), ("a", "q", "s", None, "0.30"), ("b", None, "s", "2.00", None),
         (None, "p", "s", "9.00", "9.00"), ("c", "p", "s", "3.00", "1.00"), ("c", "p", "s", "3.00", "1.00")],
        "order_id string, product_id string, seller_id string, price string, freight string",
    ).select("order_id", "product_id", "seller_id", F.col("price").cast("decimal(10,2)").alias("item_price"),
             F.col("freight").cast("decimal(10,2)").alias("freight_value"))
    plain = orders.items_per_order(items).where("order_id is not null")
    assert sorted(orders.items_per_order(orders.gathered(items)).collect()) == sorted(plain.collect())


def test_categories_bring_lines_to_their_order_once(spark, workspace):
    lines = metrics.category_lines(workspace.stg_order_items, workspace.joined_orders, workspace.dim_products)
    found = [(line, below) for line, below in below_exchanges(lines) if "order_id" in line]
    assert found and not [line for line, below in found if "product_id" in line or "Aggregate" in below]


@pytest.mark.parametrize("people", [["x"], ["x", "y", None]])
def test_purchase_days_of_a_slot_count_once(spark, people):
    rows = [(p, f"{p}{d}{h}", "SP" if h else None, dt.datetime(2017, 5, d, h), None, None, "10.00", 1) for p in people for d in (1, 2, 9) for h in (0, 5)]
    history = spark.createDataFrame(
        rows, "customer_unique_id string, order_id string, customer_state string, purchased_at timestamp_ntz, delivered_at timestamp_ntz, "
        "is_late_delivery boolean, revenue string, item_count long").withColumn("order_revenue", F.col("revenue").cast("decimal(18,2)"))
    reviews = spark.createDataFrame([], "order_id string, review_score double, survey_answered_at timestamp_ntz")
    dates = snapshots.as_of_table(spark, [dt.date(2017, 5, 3), dt.date(2017, 6, 1)])
    rolled = snapshots.history_rollup(history, reviews, dates)
    # Slots are in the exchange of the days only; the next one is by person.
    assert len([line for line, _ in below_exchanges(rolled) if "slot" in line]) == 1
    got = {(r.customer_unique_id, r.as_of_date.month): (r.all_purchase_days, r.order_count, r.monetary, r.customer_state) for r in rolled.collect()}
    assert got == {(p, m): v for p in people for m, v in ((5, (2, 4, 40.0, "SP")), (6, (3, 6, 60.0, "SP")))}


def test_wide_rows_move_by_customer_only(workspace):
    """Percentiles are joined to ids; no wide row is shuffled by its spend or likelihood."""
    found = [line for line, _ in below_exchanges(workspace.rule_tiered) if "total_revenue" in line or "return_probability" in line]
    wide = [below for line, below in below_exchanges(workspace.rule_tiered) if line in found and "rfm_segment" in below]
    assert not wide
    stored = next(v for v in workspace.rule_tiered.inputFiles() if "/scored-" in v)
    assert len(workspace.spark.read.parquet(stored).columns) == 3


def test_review_means_follow_from_slots(spark, workspace):
    dates = snapshots.as_of_table(spark, [dt.date(1999, 3, 1), dt.date(2000, 6, 1)])
    rolled = snapshots.history_rollup(workspace.history, workspace.reviews, dates)
    total, count = (F.sum(c) for c in snapshots.REVIEW_PARTS)
    by_person = rolled.groupBy("as_of_date").agg((total / count).alias("known_mean"))
    by_slot = snapshots.known_review_mean(workspace.history, workspace.reviews, dates)
    assert sorted(by_slot.collect()) == sorted(by_person.collect()) and by_slot.count() == 2
    assert "customer_unique_id" not in plan(by_slot).split("Exchange hashpartitioning(slot")[0]


def test_people_leave_other_order_columns_out_of_the_exchanges(spark):
    from tidemark.plans.workspace import Workspace

    with Workspace.over_star(spark, SMALL, keep=True) as w:
        stored = w.purchases
        assert w.customer_rollup.count() and w.history.count() and "joined_orders" not in vars(w)
        assert stored.columns == orders.PURCHASE_COLUMNS
        moved = [line for line, _ in below_exchanges(orders.purchases(w._joined()))]
        assert moved and not [c for c in ("product_id", "seller_id", "payment_type", "payment_installments") if c in plan(orders.purchases(w._joined()))]
        whole = w.joined_orders.where("is_valid_purchase").select(*stored.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))
    with Workspace.over_star(spark, SMALL, keep=True) as w:
        whole = w.joined_orders
        assert w.purchases is whole


def test_wide_rows_are_not_stored_for_their_contact_order(spark):
    from tidemark.plans.workspace import Workspace

    with Workspace.over_star(spark, SMALL, keep=True) as w:
        assert w.rule_decided.count() == w.current.count()
        folder = w.folder.removeprefix("file:")
        stored = [p for p in os.listdir(folder) if p.startswith(("tiered-", "scored-", "ordered-"))]
        assert stored and max(len(spark.read.parquet(f"{w.folder}/{p}").columns) for p in stored) <= 5


def test_values_meet_before_they_are_counted(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5), ("c", 6), ("c", 7), ("c", 8)], "key string, n int")
    found = quality.failing_unique(rows, "key")
    assert {(r.key, r.occurrences) for r in found.collect()} == {("a", 2), ("c", 3)}
    assert [below for _, below in below_exchanges(found)] and not [below for _, below in below_exchanges(found) if "Aggregate" in below]
    rolled = rows.groupBy("key").agg(F.count("n").alias("n"))
    assert quality.failing_unique(rolled, "key", keyed=True).count() == 0
    assert len(below_exchanges(quality.failing_unique(rolled, "key", keyed=True))) == 1


def test_uniqueness_tests_store_no_wide_rows(spark):
    from tidemark.plans.catalog import load
    from tidemark.plans.workspace import Workspace

    with Workspace.over_star(spark, SMALL, keep=True) as w:
        rows = sorted(load()["generic_unique"].build(w).collect())
        stored = [p for p, folders, _ in os.walk(w.folder.removeprefix("file:")) if not folders and "-" in os.path.basename(p)]
        columns = {os.path.basename(p).rsplit("-", 1)[0]: spark.read.parquet(p).columns for p in stored}
        assert "joined_orders" not in vars(w) and columns["purchases"] == orders.KEYED_COLUMNS and not {"joined-orders", "category-lines"} & set(columns)
        assert max(map(len, columns.values())) == len(orders.KEYED_COLUMNS)
        moved = plan(orders.purchases(w.keyed._joined(), orders.KEYED_COLUMNS))
        assert not [c for c in ("product_id", "seller_id", "payment_type", "l_shipdate", "customer_city", "l_tax") if c in moved]
        assert rows == sorted(quality.generic_unique(w.model).collect())
    with Workspace.over_star(spark, SMALL, keep=True) as w:
        whole = w.joined_orders
        assert w.keyed.joined_orders is whole


def test_repeated_keys_are_found_in_narrow_models(spark):
    from tidemark.plans.workspace import STAR_CONFIG, Workspace
    from tidemark.sources.star_binding import StarTables, raw_tables

    raw = raw_tables(StarTables(spark, SMALL))
    few = F.pmod(F.xxhash64("order_id"), F.lit(9)) == 0
    nobody = raw["customers"].withColumn("customer_unique_id", F.when(F.pmod(F.xxhash64("customer_id"), F.lit(7)) > 0, F.col("customer_unique_id")))
    twice = {t: raw[t].unionByName(raw[t].where(few)) for t in ("orders", "order_items", "order_reviews")}
    lost = raw["order_payments"].withColumn("order_id", F.when(~few, F.col("order_id")))
    with Workspace({**raw, **twice, "customers": nobody, "order_payments": lost}, STAR_CONFIG, keep=True) as w:
        narrow = sorted(quality.generic_unique(w.keyed.model).collect())
        assert narrow == sorted(quality.generic_unique(w.model).collect())
        failed = {r.model for r in narrow if r.failures}
        assert {"raw_orders", "stg_orders", "stg_order_items", "stg_order_reviews", "orders_enriched", "fct_orders"} <= failed
        assert not {"dim_customers", "customer_rfm", "items_per_order", "category_performance"} & failed
