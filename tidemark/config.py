"""All tunable business settings of the engine in one immutable object."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

# Thresholds, weights, labels and texts that appear in results.
ACTIONS = {
    "Service recovery": Decimal("20.00"),
    "Win-back offer": Decimal("25.00"),
    "Loyalty reward": Decimal("15.00"),
    "Second-purchase incentive": Decimal("10.00"),
    "Product cross-sell": Decimal("2.00"),
    "Low-cost email campaign": Decimal("0.10"),
}
GROUP_PLAYBOOK = {
    "Loyal Customer": ("Loyalty reward", "Proven repeat buyer: thank and retain"),
    "New Customer": (
        "Second-purchase incentive",
        "First purchase in the last 90 days: the 2nd order is the hardest",
    ),
    "High Value - High Risk": ("Win-back offer", "Spent a lot but unlikely to return without a reason"),
    "High Value - Lower Risk": ("Product cross-sell", "Valuable and still engaged: suggest related products"),
    "Medium Value - High Risk": ("Second-purchase incentive", "Mid spender drifting away: small coupon"),
    "Medium Value - Lower Risk": (
        "Product cross-sell",
        "Mid spender, reasonably engaged: recommend products",
    ),
    "Low Value": ("Low-cost email campaign", "Low historical spend: keep in touch cheaply"),
}
RECOVERY_ACTION = "Service recovery"
RECOVERY_REASON = "Gave a 1-2 star review: apologise before selling"
URGENCY = {"Cooling": 1.0, "Active": 0.6, "Inactive": 0.3}
BUDGETS = (10_000, 25_000, 50_000, 100_000)
MODEL_FEATURES = (
    "log_recency_days",
    "purchase_days",
    "log_monetary",
    "log_tenure_days",
    "items_per_order",
    "avg_review_score",
    "has_review",
    "had_late_delivery",
    "is_sao_paulo",
)
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)
VOID_STATUSES = ("canceled", "unavailable")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
RFM_SEGMENTS = (
    "Champions", "Loyal Customers", "At-Risk Repeat Customers",
    "High-Value Recent", "High-Value Lapsing", "Recent One-Time Buyers",
    "Needs Attention", "Hibernating", "Lost",
)
MODEL_NAMES = ("Logistic regression", "Rule: most recent first", "Rule: RFM score", "Random (no model)")


@dataclass(frozen=True)
class RetentionConfig:
    """Parameters of a run; snapshot dates belong to the data set being analysed."""

    active_days: int = 180
    inactive_days: int = 365
    horizon_days: int = 180
    risk_high_max_pct: float = 0.40
    risk_low_min_pct: float = 0.80
    new_customer_days: int = 90
    poor_review: float = 2.0
    weight_value: float = 0.45
    weight_likelihood: float = 0.35
    weight_urgency: float = 0.20
    budgets: tuple[int, ...] = BUDGETS
    default_budget: int = 25_000
    small_month_orders: int = 100
    small_cohort_customers: int = 100
    # Last month offset shown for a cohort; None shows all up to the last full month.
    cohort_offsets: int | None = None
    model_version: str = "logreg_v1"
    # Purchases must fall in [period_start, period_end] (value checks).
    period_start: dt.datetime = dt.datetime(2016, 1, 1)
    period_end: dt.datetime = dt.datetime(2018, 12, 31, 23, 59, 59)
    train_dates: tuple[dt.date, ...] = (dt.date(2017, 6, 1), dt.date(2017, 9, 1))
    test_date: dt.date = dt.date(2018, 3, 1)
    # None: the day after the last purchase.
    scoring_date: dt.date | None = dt.date(2018, 9, 4)

    def __post_init__(self) -> None:
        total = self.weight_value + self.weight_likelihood + self.weight_urgency
        if abs(total - 1.0) > 1e-9:
            raise ValueError("priority weights must add up to 1")
        horizon = dt.timedelta(days=self.horizon_days)
        if any(day + horizon > self.test_date for day in self.train_dates):
            raise ValueError("a training label window overlaps the test snapshot")
