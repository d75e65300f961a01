"""Point-in-time customer features and labels for several as-of dates in one job.

A feature may only use what was known before its date: orders placed, deliveries
arrived and reviews answered strictly earlier.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import TOTAL, elapsed_days, share

KEYS = ["as_of_date", "customer_unique_id"]
DAYS_PER_MONTH = 30.44


REVIEW_PARTS = ("review_sum", "review_count")


class LabelWindowError(ValueError):
    """A label window runs past the end of the data."""


def purchase_history(joined: DataFrame) -> DataFrame:
    return joined.where("is_valid_purchase").select(
        "customer_unique_id", "order_id", "customer_state", "purchased_at", "delivered_at",
        "is_late_delivery", "order_revenue", "item_count",
    )


def review_answers(reviews: DataFrame) -> DataFrame:
    return reviews.select("order_id", F.col("review_score").cast("double").alias("review_score"), "survey_answered_at")


def as_of_table(spark: SparkSession, dates: Iterable[dt.date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "as_of_date date")


def day_after_last_purchase(history: DataFrame) -> DataFrame:
    return history.agg(F.date_add(F.to_date(F.max("purchased_at")), 1).alias("as_of_date"))


def slot_of(at: Column, dates: Sequence[dt.date]) -> Column:
    """Number of the first of the ascending dates that lies after a moment, by bisection; ``len(dates)`` after all of them."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at < F.lit(dates[middle]).cast("timestamp_ntz"), between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(dates))


def _events(history: DataFrame, reviews: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Every order, delivery and answered review once, under the slot in which it becomes known."""

    def known(*moments: str) -> Column:
        return slot_of(F.greatest(*moments) if len(moments) > 1 else F.col(moments[0]), dates)

    bought = history.where(F.col("purchased_at").isNotNull())
    placed = F.struct(known("purchased_at").alias("slot"), F.lit(True).alias("is_order"), F.lit(None).cast("int").alias("late"))
    delivered = F.struct(
        known("purchased_at", "delivered_at").alias("slot"), F.lit(False).alias("is_order"), F.col("is_late_delivery").cast("int").alias("late"))
    both = F.when(F.col("delivered_at").isNotNull(), F.array(placed, delivered)).otherwise(F.array(placed))
    orders = bought.withColumn("event", F.explode(both)).select(
        "customer_unique_id", "event.*", *[
            F.when(F.col("event.is_order"), F.col(c)).alias(c) for c in ("purchased_at", "order_id", "customer_state", "order_revenue", "item_count")])
    answers = _answers(history, reviews, dates)
    events = orders.unionByName(answers, allowMissingColumns=True)
    # After the last date only purchases matter, for the label.
    return events.where((F.col("slot") < len(dates)) | F.col("purchased_at").isNotNull())


def _answers(history: DataFrame, reviews: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Answered reviews of bought orders, under the slot in which both are known."""
    asked = history.where(F.col("purchased_at").isNotNull()).select("order_id", "customer_unique_id", "purchased_at")
    slot = slot_of(F.greatest("purchased_at", "survey_answered_at"), dates)
    return reviews.where(F.col("survey_answered_at").isNotNull()).join(asked, "order_id").select(
        "customer_unique_id", slot.alias("slot"), "review_score")


def customer_history(history: DataFrame, reviews: DataFrame, dates: DataFrame) -> DataFrame:
    return history_rollup(history, reviews, dates).drop(*REVIEW_PARTS, "next_purchase_at")


def history_rollup(history: DataFrame, reviews: DataFrame, dates: DataFrame) -> DataFrame:
    """What is known of every person at every as-of date, by prefix aggregation.

    Each event is counted once, in the slot before the first date after it, so the shuffle of the
    events does not grow with the dates. The states of a person's slots (at most one
    for each date) are then merged from the first to the last. Purchase days add up over slots, because
    dates part days. ``REVIEW_PARTS`` are the sum and count from which the mean over everybody
    follows; ``next_purchase_at`` is the first purchase at or after the date.
    """
    ordered = sorted({r.as_of_date for r in dates.collect()} - {None})  # the snapshot dates of the run
    located = F.when(F.col("customer_state").isNotNull(), F.struct("purchased_at", "order_id", "customer_state"))
    # A person has at most one row for each slot and day, so all of them can then meet in one task.
    per_day = _events(history, reviews, ordered).groupBy("customer_unique_id", "slot", F.to_date("purchased_at").alias("day")).agg(
        F.min("purchased_at").alias("first"), F.max("purchased_at").alias("last"), F.count("order_id").alias("orders"),
        F.sum("order_revenue").cast(TOTAL).alias("revenue"),
        F.sum("item_count").alias("items"), F.max(located).alias("place"), F.max("late").alias("late"),
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scores"),
    )
    slots = per_day.repartition("customer_unique_id").groupBy("customer_unique_id", "slot").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("orders").alias("orders"),
        F.count("day").alias("days"), F.sum("revenue").cast(TOTAL).alias("revenue"),
        F.sum("items").alias("items"), F.max("place").alias("place"), F.max("late").alias("late"),
        F.sum("score_sum").alias("score_sum"), F.sum("scores").alias("scores"),
    )
    by_slot = Window.partitionBy("customer_unique_id").orderBy("slot")
    so_far, later = by_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow), by_slot.rowsBetween(1, Window.unboundedFollowing)
    until = F.coalesce(F.lead("slot").over(by_slot), F.lit(len(ordered)))
    merged = slots.select(
        "customer_unique_id", "slot", until.alias("until"),
        F.min("first").over(so_far).alias("first_purchase_at"), F.max("last").over(so_far).alias("last_purchase_at"),
        F.sum("orders").over(so_far).alias("order_count"), F.sum("days").over(so_far).alias("all_purchase_days"),
        F.sum("revenue").over(so_far).cast(TOTAL).cast("double").alias("monetary"), F.sum("items").over(so_far).alias("total_items"),
        F.max("place").over(so_far)["customer_state"].alias("customer_state"),
        F.coalesce(F.max("late").over(so_far), F.lit(0)).alias("had_late_delivery"),
        F.sum("score_sum").over(so_far).alias(REVIEW_PARTS[0]), F.sum("scores").over(so_far).alias(REVIEW_PARTS[1]),
        F.min("first").over(later).alias("next_purchase_at"),
    )
    # A slot's state holds until the next one begins.
    day = F.element_at(F.array(*[F.lit(d) for d in ordered]).cast("array<date>"), F.col("at") + 1)
    spread = merged.where(F.col("slot") < F.col("until")).withColumn("at", F.explode(F.sequence("slot", F.col("until") - 1)))
    return spread.select(
        day.alias("as_of_date"), *[c for c in merged.columns if c not in ("slot", "until")],
        F.when(F.col(REVIEW_PARTS[1]) > 0, F.col(REVIEW_PARTS[0]) / F.col(REVIEW_PARTS[1])).alias("avg_review_score_observed"),
    )


def known_review_mean(history: DataFrame, reviews: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per as-of date: mean of every review answered by then, from the sums of the slots."""
    ordered = sorted({r.as_of_date for r in dates.collect()} - {None})
    sums = _answers(history, reviews, ordered).groupBy("slot").agg(
        F.sum("review_score").alias("total"), F.count("review_score").alias("count"))
    days = F.array(*[F.lit(d) for d in ordered]).cast("array<date>")
    # An answer is known at the first date after it and at all later ones.
    known = sums.select("total", "count", F.explode(F.slice(days, F.col("slot") + 1, len(ordered))).alias("as_of_date"))
    count = F.sum("count")
    return known.groupBy("as_of_date").agg(F.when(count > 0, F.sum("total") / count).alias("known_mean"))


def build_features(history: DataFrame, reviews: DataFrame, dates: DataFrame) -> DataFrame:
    return _features(history, reviews, dates).drop("next_purchase_at")


def _features(history: DataFrame, reviews: DataFrame, dates: DataFrame) -> DataFrame:
    rollup = history_rollup(history, reviews, dates)
    means = known_review_mean(history, reviews, dates)
    base = rollup.where(F.col("customer_unique_id").isNotNull())
    as_of = F.col("as_of_date").cast("timestamp_ntz")
    since_first = elapsed_days(as_of, "first_purchase_at")
    days = F.col("all_purchase_days")
    rows = base.join(F.broadcast(means), "as_of_date", "left").select(
        *KEYS, "first_purchase_at", "last_purchase_at", "order_count",
        F.least(days, F.lit(5)).alias("purchase_days"),
        "monetary", "total_items", "customer_state", "had_late_delivery",
        F.coalesce("avg_review_score_observed", "known_mean").alias("avg_review_score"),
        "avg_review_score_observed",
        elapsed_days(as_of, "last_purchase_at").alias("recency_days"),
        since_first.alias("days_since_first_purchase"),
        elapsed_days("last_purchase_at", "first_purchase_at").alias("tenure_days"),
        share("monetary", "order_count").alias("avg_order_value"),
        share("total_items", "order_count").alias("items_per_order"),
        (days >= 2).cast("int").alias("is_repeat_customer"),
        share("order_count", F.greatest(since_first / DAYS_PER_MONTH, F.lit(1.0))).alias("orders_per_month_active"),
        F.col("avg_review_score_observed").isNotNull().cast("int").alias("has_review"),
        F.coalesce((F.col("customer_state") == "SP").cast("int"), F.lit(0)).alias("is_sao_paulo"), "next_purchase_at",
    )
    return rows.withColumns(
        {f"log_{c}": F.log1p(c) for c in ("recency_days", "monetary", "tenure_days")}
    )


def check_label_windows(history: DataFrame, dates: Iterable[dt.date], horizon_days: int) -> None:
    """Refuse windows that end later than one day after the last purchase."""
    last = history.agg(F.max("purchased_at").alias("last")).first()["last"]
    for start in dates:
        end = dt.datetime.combine(start, dt.time()) + dt.timedelta(days=horizon_days)
        if last is None or end > last + dt.timedelta(days=1):
            raise LabelWindowError(f"label window from {start} for {horizon_days} days runs past the data")


def buyers_in_window(history: DataFrame, dates: DataFrame, horizon_days: int) -> DataFrame:
    """Distinct (date, person) with a purchase in [date, date + horizon)."""
    start = F.col("as_of_date").cast("timestamp_ntz")
    end = start + F.make_dt_interval(F.lit(horizon_days))
    bought = F.col("purchased_at")
    return (
        history.select("customer_unique_id", "purchased_at")
        .crossJoin(F.broadcast(dates))
        .where((bought >= start) & (bought < end))
        .select(*KEYS)
        .distinct()
    )


def add_label(features: DataFrame, horizon_days: int) -> DataFrame:
    """Is there a purchase in [date, date + horizon)? The first one from the date on tells."""
    end = F.col("as_of_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(horizon_days))
    bought = F.coalesce(F.col("next_purchase_at") < end, F.lit(False))
    return features.withColumn("returned", bought.cast("int")).drop("next_purchase_at")


def labelled_snapshots(
    history: DataFrame, reviews: DataFrame, dates: list[dt.date], horizon_days: int
) -> DataFrame:
    check_label_windows(history, dates, horizon_days)
    return add_label(_features(history, reviews, as_of_table(history.sparkSession, dates)), horizon_days)
