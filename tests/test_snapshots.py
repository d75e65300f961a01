"""Features at many dates: prefix aggregation against every date computed by itself."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import snapshots

MONTHS = [dt.date(1999 + k // 12, 1 + k % 12, 1) for k in range(24)]


def each_date_by_itself(history, reviews, day):
    """The definition: only what happened strictly before the date, with plain filters."""
    at = F.lit(day).cast("timestamp_ntz")
    seen = history.where(F.col("purchased_at") < at)
    answers = reviews.where(F.col("survey_answered_at") < at).join(seen.select("order_id", "customer_unique_id"), "order_id")
    scores = answers.groupBy("customer_unique_id").agg(F.avg("review_score").alias("observed"))
    horizon = at + F.make_dt_interval(F.lit(90))
    buyers = history.where((F.col("purchased_at") >= at) & (F.col("purchased_at") < horizon)).select("customer_unique_id", F.lit(1).alias("bought")).distinct()
    late = F.max(F.when(F.col("delivered_at") < at, F.col("is_late_delivery").cast("int")))
    place = F.max(F.when(F.col("customer_state").isNotNull(), F.struct("purchased_at", "order_id", "customer_state")))
    people = seen.groupBy("customer_unique_id").agg(
        F.min("purchased_at").alias("first_purchase_at"), F.max("purchased_at").alias("last_purchase_at"), F.count("order_id").alias("order_count"),
        F.least(F.countDistinct(F.to_date("purchased_at")), F.lit(5)).alias("purchase_days"), F.sum("order_revenue").cast("double").alias("monetary"),
        F.sum("item_count").alias("total_items"), place["customer_state"].alias("customer_state"), F.coalesce(late, F.lit(0)).alias("had_late_delivery"))
    mean = answers.agg(F.avg("review_score").alias("known"))
    rows = people.join(scores, "customer_unique_id", "left").join(buyers, "customer_unique_id", "left").crossJoin(mean)
    return rows.select(
        F.lit(day).alias("as_of_date"), *people.columns, F.round("observed", 9).alias("observed"),
        F.round(F.coalesce("observed", "known"), 9).alias("score"), F.coalesce("bought", F.lit(0)).alias("returned"))


def test_24_monthly_snapshots_equal_each_by_itself(workspace):
    history, reviews = workspace.history, workspace.reviews
    found = snapshots.labelled_snapshots(history, reviews, MONTHS, 90)
    expected = None
    for day in MONTHS:
        part = each_date_by_itself(history, reviews, day)
        expected = part if expected is None else expected.unionByName(part)
    shown = found.withColumns({"observed": F.round("avg_review_score_observed", 9), "score": F.round("avg_review_score", 9)}).select(*expected.columns)
    left, right = (sorted(map(repr, map(tuple, df.collect()))) for df in (shown, expected))
    assert left == right and len(left) > 5000


def test_events_do_not_grow_with_the_dates(workspace):
    history, reviews = workspace.history, workspace.reviews
    few, many = (snapshots._events(history, reviews, days) for days in (MONTHS[-1:], MONTHS))
    assert many.count() == few.count() <= 2 * history.count() + reviews.count()
    states = many.groupBy("customer_unique_id", "slot").count().count()
    assert states < history.count() * 3


def test_slots_are_found_by_bisection(spark):
    moments = spark.sql("""select explode(array(timestamp_ntz'1998-01-01 00:00:00', timestamp_ntz'1999-01-01 00:00:00', timestamp_ntz'1999-01-31 23:59:59',
      timestamp_ntz'1999-02-01 00:00:00', timestamp_ntz'2000-12-01 00:00:00', timestamp_ntz'2030-01-01 00:00:00')) as t""")
    assert [r.s for r in moments.select(snapshots.slot_of(F.col("t"), MONTHS).alias("s")).collect()] == [0, 1, 1, 2, 24, 24]
    assert [r.s for r in moments.select(snapshots.slot_of(F.col("t"), []).alias("s")).collect()] == [0] * 6


def test_no_dates_and_no_history(spark, workspace):
    empty = workspace.history.where("false")
    dates = snapshots.as_of_table(spark, MONTHS)
    assert snapshots.build_features(empty, workspace.reviews, dates).count() == 0
    assert snapshots.build_features(workspace.history, workspace.reviews, snapshots.day_after_last_purchase(empty)).count() == 0
