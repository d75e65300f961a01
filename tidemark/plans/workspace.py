"""All models of a data set, each built on first use.

Most models are lazy plans. Those that several others read are stored when they are
first asked for; the stored folders belong to the workspace and go with ``close()``.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from functools import cached_property as plain_cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import RetentionConfig
from tidemark.operators import (
    customers, dashboards, decisions, evaluation, explore, metrics, model, orders, snapshots, staging,
)
from tidemark.sources.scratch import fresh_path, inside, release, store
from tidemark.sources.star_binding import StarTables, raw_tables

# Dates and period that suit the star-schema data (1995 to 2001).
STAR_CONFIG = dataclasses.replace(
    RetentionConfig(),
    period_start=dt.datetime(1995, 1, 1),
    period_end=dt.datetime(2001, 12, 31, 23, 59, 59),
    train_dates=(dt.date(2000, 1, 1), dt.date(2000, 6, 1)),
    test_date=dt.date(2001, 1, 1),
    scoring_date=None,
)
#: Lets Spark split a hot key on one side of a join even where that costs a later exchange.
SKEW = "spark.sql.adaptive.forceOptimizeSkewedJoin"


class cached_property(plain_cached_property):  # noqa: N801
    """Whatever a model stores while it is built belongs to its workspace."""

    def __get__(self, instance, owner=None):
        if instance is None:
            return self
        with inside(instance.folder):
            return super().__get__(instance, owner)


class Workspace:
    """Models over the nine raw tables.

    ``keep`` also stores the models that only some uses read several times (joined
    orders, customer months, labels). The session's skew-join setting is
    switched on, because people and products may hold a large share of the rows.
    """

    def __init__(self, raw: dict[str, DataFrame], cfg: RetentionConfig, keep: bool = False):
        self.raw, self.cfg, self.keep = raw, cfg, keep
        self.spark: SparkSession = next(iter(raw.values())).sparkSession
        self.spark.conf.set(SKEW, "true")
        self.folder = fresh_path(self.spark, "workspace")

    @classmethod
    def over_star(cls, spark: SparkSession, folder: str, keep: bool = False) -> Workspace:
        star = StarTables(spark, folder)
        workspace = cls(raw_tables(star), STAR_CONFIG, keep)
        workspace.star = star
        return workspace

    def close(self) -> None:
        """Delete everything this workspace stored; its models cannot be read afterwards."""
        release(self.spark, self.folder)
        for name in [n for n, v in vars(type(self)).items() if isinstance(v, cached_property)]:
            self.__dict__.pop(name, None)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _shared(self, df: DataFrame, label: str) -> DataFrame:
        return store(df, label) if self.keep else df

    def model(self, name: str) -> DataFrame:
        """Look a model up by name; raw tables are called raw_<table>."""
        return self.raw[name[4:]] if name.startswith("raw_") else getattr(self, name)

    # staging
    @cached_property
    def stg_customers(self):
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_orders(self):
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self):
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_order_payments(self):
        return staging.stg_order_payments(self.raw["order_payments"])

    @cached_property
    def stg_order_reviews(self):
        return staging.stg_order_reviews(self.raw["order_reviews"])

    @cached_property
    def stg_products(self):
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_category_translation(self):
        return staging.stg_category_translation(self.raw["product_category_translation"])

    @cached_property
    def stg_sellers(self):
        return staging.stg_sellers(self.raw["sellers"])

    @cached_property
    def stg_geolocation(self):
        return staging.stg_geolocation(self.raw["geolocation"])

    # orders
    @cached_property
    def items_per_order(self):
        return orders.items_per_order(self.stg_order_items)

    @cached_property
    def payments_per_order(self):
        return orders.payments_per_order(self.stg_order_payments)

    @cached_property
    def reviews_per_order(self):
        return orders.reviews_per_order(self.stg_order_reviews)

    def _joined(self) -> DataFrame:
        return orders.joined_orders(
            self.stg_orders, self.stg_customers,
            orders.items_per_order(orders.gathered(self.stg_order_items)),
            orders.payments_per_order(orders.gathered(self.stg_order_payments)),
            orders.reviews_per_order(orders.gathered(self.stg_order_reviews)),
        )

    @cached_property
    def joined_orders(self):
        return self._shared(self._joined(), "joined-orders")

    @cached_property
    def purchases(self):
        """What people and snapshots read of the joined orders.

        Stored by itself, so that Spark leaves the other columns out of every exchange below; joined orders
        that are stored already are read instead.
        """
        if not self.keep or "joined_orders" in self.__dict__:
            return self.joined_orders
        return store(orders.purchases(self._joined()), "purchases")

    @cached_property
    def orders_enriched(self):
        # Numbered and joined back, so the join of the five tables is stored in any case.
        joined = self.joined_orders if self.keep else store(self.joined_orders, "joined-orders")
        return orders.with_sequence(joined, orders.purchase_sequence(joined))

    @cached_property
    def fct_orders(self):
        return orders.fct_orders(self.orders_enriched)

    @cached_property
    def dim_products(self):
        return orders.dim_products(self.stg_products, self.stg_category_translation)

    # customers
    @cached_property
    def customer_rollup(self):
        # Read by the as-of date, the dimension and two rankings: always stored.
        return store(customers.customer_rollup(self.purchases), "customer-rollup")

    @cached_property
    def dim_customers(self):
        return customers.dim_customers(self.customer_rollup)

    @cached_property
    def customer_rfm(self):
        return customers.customer_rfm(self.dim_customers, self.cfg)

    # metric marts
    @cached_property
    def customer_months(self):
        return self._shared(metrics.customer_months(self.joined_orders), "customer-months")

    @cached_property
    def kpi_summary(self):
        return metrics.kpi_summary(self.customer_rollup, self.dim_customers)

    @cached_property
    def monthly_revenue(self):
        return metrics.monthly_revenue(self.customer_months, self.cfg)

    @cached_property
    def customer_acquisition_monthly(self):
        return metrics.customer_acquisition_monthly(self.dim_customers)

    @cached_property
    def category_performance(self):
        return metrics.category_performance(self.stg_order_items, self.joined_orders, self.dim_products)

    @cached_property
    def cohort_retention(self):
        return metrics.cohort_retention(self.customer_months, self.cfg)

    # snapshots
    @cached_property
    def history(self):
        # Only a filter and some columns of the purchases, so storing it again would save nothing.
        return snapshots.purchase_history(self.purchases)

    @cached_property
    def reviews(self):
        return snapshots.review_answers(self.stg_order_reviews)

    @cached_property
    def labelled(self):
        """Train and test snapshots from one job."""
        dates = [*self.cfg.train_dates, self.cfg.test_date]
        rows = snapshots.labelled_snapshots(self.history, self.reviews, dates, self.cfg.horizon_days)
        return self._shared(rows, "labelled")

    @cached_property
    def train(self):
        return self.labelled.where(self.labelled.as_of_date != self.cfg.test_date)

    @cached_property
    def test(self):
        return self.labelled.where(self.labelled.as_of_date == self.cfg.test_date)

    @cached_property
    def test_only(self):
        return snapshots.labelled_snapshots(self.history, self.reviews, [self.cfg.test_date], self.cfg.horizon_days)

    @cached_property
    def scoring_dates(self):
        """The configured date, or the day after the last purchase."""
        if self.cfg.scoring_date is not None:
            return snapshots.as_of_table(self.spark, [self.cfg.scoring_date])
        return snapshots.day_after_last_purchase(self.history)

    @cached_property
    def current(self):
        """Features as of the scoring date; ranked and scored, so always stored."""
        return store(snapshots.build_features(self.history, self.reviews, self.scoring_dates), "current")

    # model
    @cached_property
    def train_model(self):
        return model.fit_return_model(self.train)

    @cached_property
    def final_model(self):
        return model.fit_return_model(self.labelled)

    @cached_property
    def coefficients(self):
        return model.coefficient_stability(
            model.coefficient_table(self.spark, self.final_model), model.coefficient_table(self.spark, self.train_model)
        )

    @cached_property
    def rule_scores(self):
        """Test-set scores of the three rules."""
        return self._rules(self.test_only)

    def _rules(self, test: DataFrame) -> dict[str, DataFrame]:
        test = store(test.select("customer_unique_id", "recency_days", "purchase_days", "monetary", "returned"), "test-set")
        return {
            "Rule: most recent first": model.rule_recency(test),
            "Rule: RFM score": model.rule_rfm(test),
            "Random (no model)": model.rule_random(test),
        }

    @cached_property
    def test_scores(self):
        scored = model.predict_return(self.train_model, self.test).withColumnRenamed("return_probability", "score")
        # The fit has the labelled rows of the test date already; the rules alone build only that date.
        return {"Logistic regression": scored, **self._rules(self.test if self.keep else self.test_only)}

    @cached_property
    def model_evaluation(self):
        return evaluation.evaluate(evaluation.long_scores(self.test_scores, "Logistic regression"))

    @cached_property
    def rule_evaluation(self):
        return evaluation.evaluate(evaluation.long_scores(self.rule_scores, "Rule: RFM score"))

    @cached_property
    def model_deciles(self):
        return evaluation.decile_table(self.test_scores["Logistic regression"].select("customer_unique_id", "score", "returned"))

    @cached_property
    def rule_deciles(self):
        return evaluation.decile_table(self.rule_scores["Rule: RFM score"].select("customer_unique_id", "score", "returned"))

    # decisions
    @cached_property
    def rule_probability(self):
        """A deterministic stand-in for the model: the RFM rule score as return probability.

        There is one scoring date and so one row a person; four narrow columns meet their ranks, the rows do not.
        """
        inputs = self.current.select("customer_unique_id", "recency_days", "purchase_days", "monetary")
        scores = model.rule_rfm(inputs).select("customer_unique_id", F.col("score").alias("return_probability"))
        return self.current.join(store(scores, "rule-scores"), "customer_unique_id")

    @cached_property
    def rule_tiered(self):
        return decisions.tiered(self.rule_probability, self.customer_rfm, self.cfg)

    @cached_property
    def rule_decided(self):
        return decisions.add_budget_columns(self.rule_tiered)

    @cached_property
    def rule_table(self):
        """The published table layout on rule probabilities."""
        return decisions.retention_scores(self.rule_decided, self.cfg, F.col("as_of_date"))

    @cached_property
    def decided(self):
        scored = model.predict_return(self.final_model, self.current)
        return decisions.decide(scored, self.customer_rfm, self.cfg)

    @cached_property
    def scores(self):
        return decisions.retention_scores(self.decided, self.cfg, F.col("as_of_date"))

    @cached_property
    def scenarios(self):
        return decisions.budget_scenarios(self.decided, self.cfg.budgets)

    @cached_property
    def extract(self):
        return dashboards.customers_extract(self.rule_table, self.customer_rfm)

    @cached_property
    def tile_measures(self):
        """Groups of every dashboard tile; a few hundred rows that all tiles read."""
        return store(dashboards.tile_measures(self.extract), "tile-measures")

    # tests
    @cached_property
    def keyed(self):
        """The same models for tests that read their keys alone."""
        return KeyedWorkspace(self)

    # exploration
    @cached_property
    def gaps(self):
        return explore.repeat_gaps(self.history)


class KeyedWorkspace(Workspace):
    """Models for tests that read one key column of each.

    The joined orders stay a plan, of which Spark takes what a key needs; stored are only the columns that keys,
    sequences and score cuts come from, so that no wide row is moved or written. Orders that the whole workspace has
    stored already are read instead. Everything stored goes with the whole workspace.
    """

    def __init__(self, whole: Workspace):
        super().__init__(whole.raw, whole.cfg)
        self.whole = whole

    def _joined(self) -> DataFrame:
        return self.whole.joined_orders if self.whole.keep and "joined_orders" in vars(self.whole) else super()._joined()

    @cached_property
    def purchases(self):
        return store(orders.purchases(self.joined_orders, orders.KEYED_COLUMNS), "purchases")

    # A key of no value is none to test, so lines without an order may be left out here as well.
    @cached_property
    def items_per_order(self):
        return orders.items_per_order(orders.gathered(self.stg_order_items))

    @cached_property
    def payments_per_order(self):
        return orders.payments_per_order(orders.gathered(self.stg_order_payments))

    @cached_property
    def reviews_per_order(self):
        return orders.reviews_per_order(orders.gathered(self.stg_order_reviews))

    @cached_property
    def orders_enriched(self):
        return orders.with_sequence(self.joined_orders, orders.purchase_sequence(self.purchases))

    @cached_property
    def customer_rollup(self):
        return store(customers.customer_rollup(self.purchases, customers.KEYED_MEASURES), "customer-rollup")

    @cached_property
    def dim_customers(self):
        return customers.dim_customers(self.customer_rollup, customers.KEYED_COLUMNS)

    @cached_property
    def customer_months(self):
        return store(metrics.customer_months(self.purchases), "customer-months")

    @cached_property
    def category_performance(self):
        return metrics.category_performance(self.stg_order_items, self.purchases, self.dim_products, stored=False)
