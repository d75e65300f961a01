"""Data-quality rules as tables of data, evaluated in one aggregate per checked table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import MODEL_NAMES, ORDER_STATUSES, PAYMENT_TYPES, RFM_SEGMENTS, VOID_STATUSES, RetentionConfig
from tidemark.functions.scalars import TOTAL, exact_ratio, matches_whole, month_start, share
from tidemark.operators.ordered import ordered_scan
from tidemark.operators.staging import LATITUDES, LONGITUDES
from tidemark.sources.schemas import RAW_TABLES
from tidemark.sources.scratch import store

Tables = dict[str, DataFrame]


class GateError(RuntimeError):
    """The pipeline gate failed; nothing may be written."""


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def melt_counts(row: DataFrame, labels: dict[str, str], name: str, value: str) -> DataFrame:
    """Turn one wide row of counts into (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).cast("long").alias(value)) for c, label in labels.items()])
    return row.select(F.explode(pairs).alias("p")).select(f"p.{name}", f"p.{value}")


def status_of(violations: str, severity: str | Column) -> Column:
    worst = F.col(severity) if isinstance(severity, str) else severity
    return F.when(F.col(violations) == 0, "PASS").otherwise(worst)


def by_status(checks: DataFrame, then: str) -> DataFrame:
    rank = F.when(F.col("status") == "FAIL", 1).when(F.col("status").isin("WARN", "INFO"), 2).otherwise(3)
    return checks.orderBy(rank, then)


# ---------------------------------------------------------------- profile and counts


#: Registers of the approximate distinct count, as a power of two: a standard error of 1.04 / sqrt(2^12), 1.6 %.
SKETCH_LOG_K = 12


def distinct_values(df: DataFrame) -> DataFrame:
    """Exact number of distinct values (not NULL) of every column: (column_name, distinct_values).

    Values travel as two 64-bit hashes, so what is shuffled does not depend on the length of texts. They
    collapse before the shuffle, so a dominant value is a row for each task. ``collisions`` counts first hashes
    that stand for several values; the second one tells those apart, and only a pair
    of values equal in all 128 bits would be taken for one.
    """
    cells = F.array(*[F.struct(
        F.lit(k).alias("place"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit("second"), v).alias("h2"), v.isNull().alias("missing"),
    ) for k, v in enumerate(F.col(f"`{c}`").cast("string") for c in df.columns)])
    found = df.select(F.explode(F.filter(cells, lambda x: ~x["missing"])).alias("x")).select("x.place", "x.h1", "x.h2")
    pairs = found.distinct().groupBy("place", "h1").agg(F.count(F.lit(1)).alias("values"))
    counted = pairs.groupBy("place").agg(F.sum("values").alias("distinct_values"), F.count_if(F.col("values") > 1).alias("collisions"))
    return counted


def profile_columns(df: DataFrame, table: str, width: int | None = None, approximate: bool = False) -> DataFrame:
    """Nulls, null share, distinct values and smallest example of each column.

    ``width`` shortens the example for display; by default it is whole. Counts and examples come from one aggregate
    over the columns. Distinct values are exact (``distinct_values``), or with ``approximate`` estimated by a
    sketch for each column in the same aggregate, without any shuffle of values.
    """
    values = {k: F.col(f"`{c}`").cast("string") for k, c in enumerate(df.columns)}
    sums = [F.count(F.lit(1)).alias("total_rows")]
    for k, v in values.items():
        sums += [F.count_if(v.isNull()).alias(f"nulls_{k}"), F.min(v).alias(f"example_{k}")]
        if approximate:
            sums.append(F.hll_sketch_estimate(F.hll_sketch_agg(v, F.lit(SKETCH_LOG_K))).alias(f"distinct_{k}"))
    cells = F.array(*[F.struct(
        F.lit(k).alias("place"), F.lit(c).alias("column_name"), F.col(f"nulls_{k}").alias("nulls"), F.col(f"example_{k}").alias("example"),
        (F.col(f"distinct_{k}") if approximate else F.lit(None)).cast("long").alias("estimate"),
    ) for k, c in enumerate(df.columns)])
    per_column = df.agg(*sums).select("total_rows", F.explode(cells).alias("x")).select("total_rows", "x.*")
    if approximate:
        # A column without values has no sketch to ask.
        per_column = per_column.withColumn("distinct_values", F.coalesce("estimate", F.lit(0)))
    else:
        per_column = per_column.join(F.broadcast(distinct_values(df)), "place", "left").withColumn(
            "distinct_values", F.coalesce("distinct_values", F.lit(0)).cast("long"))
    shown = F.regexp_replace("example", "\n", " ")
    return per_column.select(
        F.lit(table).alias("table_name"), "column_name", "nulls", "total_rows", "distinct_values",
        (shown if width is None else F.substring(shown, 1, width)).alias("example"),
    ).select("table_name", "column_name", "nulls", exact_ratio(F.col("nulls") * 100, "total_rows", 2).alias("null_pct"), "distinct_values", "example")


def row_counts(tables: Tables) -> DataFrame:
    return stack([df.agg(F.count(F.lit(1)).alias("actual_rows")).select(F.lit(t).alias("table_name"), "actual_rows")
                  for t, df in tables.items()])


def row_count_check(tables: Tables, expected: DataFrame) -> DataFrame:
    """Expected (table_name, expected_rows) against the rows actually loaded."""
    gap = F.col("actual_rows") - F.col("expected_rows")
    return expected.join(row_counts(tables), "table_name").select(
        "table_name", "expected_rows", "actual_rows", gap.alias("difference"),
        F.when(gap == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def one_customer_row_per_order(tables: Tables) -> DataFrame:
    c = tables["customers"].agg(F.count(F.lit(1)).alias("customers_rows"))
    o = tables["orders"].agg(F.count(F.lit(1)).alias("orders_rows"))
    same = F.col("customers_rows") == F.col("orders_rows")
    return c.crossJoin(F.broadcast(o)).withColumn("status", F.when(same, "PASS").otherwise("FAIL"))


def null_counters(table: str) -> dict[str, Column]:
    """NULLs of every column of a raw table, as aggregates that its load can measure."""
    return {f"nulls {c}": F.count_if(F.col(c).isNull()) for c in RAW_TABLES[table].column_names}


def null_checks(tables: Tables) -> DataFrame:
    """Every raw column against its REQUIRED or OPTIONAL rule, one scan per table."""
    out = []
    for name, spec in RAW_TABLES.items():
        counts = tables[name].agg(F.count(F.lit(1)).alias("total_rows"), *[v.alias(k) for k, v in null_counters(name).items()])
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`nulls {c}`").alias("null_count")) for c in spec.column_names])
        out.append(counts.select(F.lit(name).alias("table_name"), F.explode(cells).alias("x"), "total_rows")
                   .select("table_name", "x.column_name", "x.null_count", "total_rows"))
    return null_report(stack(out))


def null_checks_at_load(spark: SparkSession, measured: dict[str, dict[str, int]]) -> DataFrame:
    """The same report from what the load measured, without reading a table."""
    rows = [(t, c, measured[t][f"nulls {c}"], measured[t]["rows"]) for t, spec in RAW_TABLES.items() for c in spec.column_names]
    return null_report(spark.createDataFrame(rows, "table_name string, column_name string, null_count long, total_rows long"))


def null_report(counts: DataFrame) -> DataFrame:
    required = [F.lit(f"{t} {c}") for t, spec in RAW_TABLES.items() for c in spec.required]
    rule = F.when(F.concat_ws(" ", "table_name", "column_name").isin(*required), "REQUIRED").otherwise("OPTIONAL")
    failed = F.when(F.col("rule") == "REQUIRED", "FAIL").otherwise("INFO")
    return counts.withColumn("rule", rule).select(
        "table_name", "column_name", "rule", "null_count", "total_rows",
        exact_ratio(F.col("null_count") * 100, "total_rows", 2).alias("null_pct"),
        status_of("null_count", failed).alias("status"),
    )


def status_null_crosstab(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("order_approved_at").isNull()).alias("null_approved_at"),
        F.count_if(F.col("order_delivered_carrier_date").isNull()).alias("null_delivered_carrier"),
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("null_delivered_customer"),
    ).orderBy(F.desc("orders"))


# ---------------------------------------------------------------- duplicates


def duplicate_key_count(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key, NULL keys compared as equal."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def key_uniqueness(tables: Tables) -> DataFrame:
    """Rows against distinct keys of each declared key (keys holding a NULL do not count as keys)."""
    out = []
    for name, spec in RAW_TABLES.items():
        if not spec.key:
            continue
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.key])
        per_key = tables[name].groupBy(*spec.key).agg(F.count(F.lit(1)).alias("n"))
        out.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count_if(complete).alias("distinct_keys"),
        ).select(F.lit(name).alias("table_name"), F.lit(" + ".join(spec.key)).alias("key_columns"), "total_rows", "distinct_keys"))
    gap = F.col("total_rows") - F.col("distinct_keys")
    return stack(out).select("*", gap.alias("duplicate_keys"), F.when(gap == 0, "PASS").otherwise("FAIL").alias("status"))


def exact_duplicate_rows(tables: Tables) -> DataFrame:
    return stack([
        duplicate_key_count(tables[name], spec.column_names).select(
            F.lit(name).alias("table_name"), F.col("duplicate_rows").alias("exact_duplicate_rows"))
        for name, spec in RAW_TABLES.items()
    ])


def repeated(df: DataFrame, key: str, measure: Column | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if measure is None else measure
    return df.groupBy(key).agg(n.alias("n")).where("n > 1")


def expected_repetition(tables: Tables) -> DataFrame:
    """Repetition that is business information rather than an error."""
    customers, reviews = tables["customers"], tables["order_reviews"]
    counted = {
        "people with more than one order": repeated(customers, "customer_unique_id"),
        "distinct people": customers.select("customer_unique_id").where("customer_unique_id is not null").distinct(),
        "review ids shared by several orders": repeated(reviews, "review_id", F.countDistinct("order_id")),
        "orders with more than one review": repeated(reviews, "order_id"),
        "orders with more than one payment row": repeated(tables["order_payments"], "order_id"),
        "distinct zip prefixes with coordinates": tables["geolocation"]
        .select("geolocation_zip_code_prefix").where("geolocation_zip_code_prefix is not null").distinct(),
    }
    return stack([
        df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(label).alias("check_name"), "value", F.lit("INFO").alias("status"))
        for label, df in counted.items()
    ])


def top_order_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return (
        customers.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("orders"), "customer_unique_id").limit(n)
    )


def shared_review_ids(reviews: DataFrame, n: int = 10) -> DataFrame:
    return (
        reviews.groupBy("review_id").agg(
            F.countDistinct("order_id").alias("orders"),
            F.min("review_score").alias("min_score"), F.max("review_score").alias("max_score"))
        .where("orders > 1").orderBy(F.desc("orders"), "review_id").limit(n)
    )


# ---------------------------------------------------------------- values and schema


@dataclass(frozen=True)
class Rule:
    severity: str
    label: str
    table: str
    broken: Column


def value_rules(cfg: RetentionConfig) -> list[Rule]:
    """The 28 value, domain, format and date-order rules."""
    c = F.col

    def not_all(*conditions: Column) -> Column:
        return ~reduce(lambda a, b: a & b, conditions)

    def any_of(*conditions: Column) -> Column:
        return reduce(lambda a, b: a | b, conditions)

    def hex32(name: str) -> Column:
        return ~matches_whole(name, "[0-9a-f]{32}")

    bought, carrier, arrived = c("order_purchase_timestamp"), c("order_delivered_carrier_date"), c("order_delivered_customer_date")
    lat, lng = c("geolocation_lat"), c("geolocation_lng")
    measures = ("product_name_lenght", "product_description_lenght", "product_photos_qty",
                "product_length_cm", "product_height_cm", "product_width_cm")
    period = (F.lit(cfg.period_start).cast("timestamp_ntz"), F.lit(cfg.period_end).cast("timestamp_ntz"))
    five, two = "[0-9]{5}", "[A-Z]{2}"
    return [
        Rule("FAIL", "review score is 1 to 5", "order_reviews", ~c("review_score").between(1, 5)),
        Rule("WARN", "review answered after it was sent", "order_reviews", c("review_answer_timestamp") < c("review_creation_date")),
        Rule("FAIL", "item price is positive", "order_items", c("price") <= 0),
        Rule("FAIL", "freight is not negative", "order_items", c("freight_value") < 0),
        Rule("FAIL", "item number starts at 1", "order_items", c("order_item_id") < 1),
        Rule("FAIL", "payment is not negative", "order_payments", c("payment_value") < 0),
        Rule("FAIL", "payment number starts at 1", "order_payments", c("payment_sequential") < 1),
        Rule("WARN", "at least one installment", "order_payments", c("payment_installments") < 1),
        Rule("WARN", "payment is not zero", "order_payments", c("payment_value") == 0),
        Rule("FAIL", "payment type is known", "order_payments", ~c("payment_type").isin(*PAYMENT_TYPES)),
        Rule("WARN", "product weight is positive", "products", c("product_weight_g") <= 0),
        Rule("FAIL", "product sizes and counts are not negative", "products", any_of(*[c(m) < 0 for m in measures])),
        Rule("FAIL", "order status is known", "orders", ~c("order_status").isin(*ORDER_STATUSES)),
        Rule("FAIL", "order ids are 32 hex digits", "orders", any_of(hex32("order_id"), hex32("customer_id"))),
        Rule("FAIL", "purchase lies in the data period", "orders", ~bought.between(*period)),
        Rule("WARN", "approved after purchase", "orders", c("order_approved_at") < bought),
        Rule("WARN", "carrier pickup after purchase", "orders", carrier < bought),
        Rule("WARN", "arrival after carrier pickup", "orders", arrived < carrier),
        Rule("WARN", "arrival after purchase", "orders", arrived < bought),
        Rule("WARN", "delivered orders have an arrival date", "orders", (c("order_status") == "delivered") & arrived.isNull()),
        Rule("WARN", "customer zip has five digits", "customers", ~matches_whole("customer_zip_code_prefix", five)),
        Rule("FAIL", "customer state has two capitals", "customers", ~matches_whole("customer_state", two)),
        Rule("FAIL", "customer ids are 32 hex digits", "customers", any_of(hex32("customer_id"), hex32("customer_unique_id"))),
        Rule("WARN", "seller zip has five digits", "sellers", ~matches_whole("seller_zip_code_prefix", five)),
        Rule("FAIL", "seller state has two capitals", "sellers", ~matches_whole("seller_state", two)),
        Rule("WARN", "location zip has five digits", "geolocation", ~matches_whole("geolocation_zip_code_prefix", five)),
        Rule("FAIL", "coordinates exist on Earth", "geolocation", not_all(lat.between(-90, 90), lng.between(-180, 180))),
        Rule("WARN", "coordinates lie in the market", "geolocation", not_all(lat.between(*LATITUDES), lng.between(*LONGITUDES))),
    ]


def run_rules(tables: Tables, rules: list[Rule]) -> DataFrame:
    """All rules of a table share one scan; a NULL comparison is not a violation."""
    grouped: dict[str, list[Rule]] = {}
    for rule in rules:
        grouped.setdefault(rule.table, []).append(rule)
    out = []
    for table, members in grouped.items():
        counts = tables[table].agg(*[F.count_if(r.broken).alias(f"v{i}") for i, r in enumerate(members)])
        cells = F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(r.label).alias("rule_name"),
                     F.lit(r.severity).alias("severity"), F.col(f"v{i}").alias("violations"))
            for i, r in enumerate(members)
        ])
        out.append(counts.select(F.explode(cells).alias("x")).select("x.*"))
    return stack(out)


def type_label(t: T.DataType) -> tuple[str, int | None]:
    if isinstance(t, T.DecimalType):
        return "NUMBER", t.scale
    if isinstance(t, (T.IntegerType, T.LongType, T.ShortType)):
        return "NUMBER", 0
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "FLOAT", None
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        return "TIMESTAMP", None
    return "TEXT", None


def schema_contract_diff(texts: Tables) -> DataFrame:
    """All-text scans of files against the contract: header places, and values that are not of the declared type.

    Every value is read: one aggregate for each table counts values and those that do not convert.
    """
    return stack([_contract_of(name, df) for name, df in texts.items()])


def _contract_of(name: str, df: DataFrame) -> DataFrame:
    spec = RAW_TABLES[name]
    wanted = {c: (k, t) for k, (c, t) in enumerate(spec.columns, 1)}
    place = {c: k for k, c in enumerate(df.columns, 1)}

    def bad(c: str) -> Column:
        if c not in place or c not in wanted:
            return F.lit(0).cast("long")
        text = F.col(c).cast("string")
        return F.count_if(text.isNotNull() & text.try_cast(wanted[c][1].simpleString()).isNull())

    names = list(dict.fromkeys([*wanted, *place]))
    counted = df.agg(
        *[(F.count(c) if c in place else F.lit(0).cast("long")).alias(f"n{k}") for k, c in enumerate(names)],
        *[bad(c).alias(f"b{k}") for k, c in enumerate(names)],
    )
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(wanted.get(c, (None,))[0]).cast("int").alias("expected_position"),
            F.lit(place.get(c)).cast("int").alias("actual_position"),
            F.lit(type_label(wanted[c][1])[0] if c in wanted else None).cast("string").alias("expected_type"),
            F.col(f"n{k}").alias("filled_values"), F.col(f"b{k}").alias("bad_values"),
        ) for k, c in enumerate(names)
    ])
    # Texts of the report.
    verdict = (
        F.when(F.col("actual_position").isNull(), "FAIL - missing column")
        .when(F.col("expected_position").isNull(), "FAIL - unexpected column")
        .when(F.col("expected_position") != F.col("actual_position"), "FAIL - wrong position")
        .when(F.col("bad_values") > 0, "FAIL - wrong values")
        .otherwise("PASS")
    )
    return counted.select(F.lit(name).alias("table_name"), F.explode(cells).alias("x")).select("table_name", "x.*").withColumn("status", verdict)


CONTRACT_SCHEMA = "table_name string, column_name string, position int, data_type string, numeric_scale int"


def contract_rows(name: str, schema: T.StructType) -> list[tuple]:
    return [(name, f.name, i, *type_label(f.dataType)) for i, f in enumerate(schema.fields, 1)]


def typed_contract_diff(tables: Tables) -> DataFrame:
    """Declared against actual column types of typed tables, full outer: missing, unexpected, moved or retyped."""
    spark = next(iter(tables.values())).sparkSession
    want = [r for n, s in RAW_TABLES.items() for r in contract_rows(n, s.schema)]
    have = [r for n, df in tables.items() for r in contract_rows(n, df.schema)]
    keys = ["table_name", "column_name"]
    expected = spark.createDataFrame(want, CONTRACT_SCHEMA).select(
        *keys, *[F.col(c).alias(f"expected_{a}") for c, a in (("position", "position"), ("data_type", "type"), ("numeric_scale", "scale"))])
    actual = spark.createDataFrame(have, CONTRACT_SCHEMA).select(
        *keys, *[F.col(c).alias(f"actual_{a}") for c, a in (("position", "position"), ("data_type", "type"), ("numeric_scale", "scale"))])
    verdict = (
        F.when(F.col("actual_position").isNull(), "FAIL - missing column")
        .when(F.col("expected_position").isNull(), "FAIL - unexpected column")
        .when(F.col("expected_position") != F.col("actual_position"), "FAIL - wrong position")
        .when(F.col("expected_type") != F.col("actual_type"), "FAIL - wrong type")
        .when(~F.col("expected_scale").eqNullSafe(F.col("actual_scale")), "FAIL - wrong scale")
        .otherwise("PASS")
    )
    return expected.join(actual, keys, "full").withColumn("status", verdict)


def value_domain_checks(tables: Tables, cfg: RetentionConfig) -> DataFrame:
    contract = typed_contract_diff(tables).agg(F.count_if(F.col("status") != "PASS").alias("violations")).select(
        F.lit("all tables").alias("table_name"), F.lit("columns follow the schema contract").alias("rule_name"),
        F.lit("FAIL").alias("severity"), "violations")
    checks = stack([contract, run_rules(tables, value_rules(cfg))])
    return checks.withColumn("status", status_of("violations", "severity"))


def dataset_period(orders: DataFrame) -> DataFrame:
    first, last = F.min("order_purchase_timestamp"), F.max("order_purchase_timestamp")
    return orders.agg(
        first.alias("first_order"), last.alias("last_order"),
        F.datediff(F.to_date(last), F.to_date(first)).alias("days_covered"))


def month_counts(orders: DataFrame) -> DataFrame:
    month = month_start(F.to_date("order_purchase_timestamp")).alias("order_month")
    return orders.groupBy(month).agg(F.count(F.lit(1)).alias("orders")).orderBy("order_month")


# ---------------------------------------------------------------- relationships


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, keep_null: bool = True) -> DataFrame:
    """One row: child rows without a parent. Children collapse to distinct keys before the join."""
    keys = child.groupBy(F.col(child_key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    if not keep_null:
        keys = keys.where("k is not null")
    lost = keys.join(parent.select(F.col(parent_key).alias("k")).distinct(), "k", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))


def relationship_checks(tables: Tables) -> DataFrame:
    t = tables
    links = [
        ("FAIL", "orders have a customer", "orders", "customers", "customer_id", "customer_id", True),
        ("FAIL", "items have an order", "order_items", "orders", "order_id", "order_id", True),
        ("FAIL", "items have a product", "order_items", "products", "product_id", "product_id", True),
        ("FAIL", "items have a seller", "order_items", "sellers", "seller_id", "seller_id", True),
        ("FAIL", "payments have an order", "order_payments", "orders", "order_id", "order_id", True),
        ("FAIL", "reviews have an order", "order_reviews", "orders", "order_id", "order_id", True),
        ("WARN", "categories have a translation", "products", "product_category_translation",
         "product_category_name", "product_category_name", False),
        ("WARN", "customer zips have coordinates", "customers", "geolocation",
         "customer_zip_code_prefix", "geolocation_zip_code_prefix", True),
        ("WARN", "orders have items", "orders", "order_items", "order_id", "order_id", True),
        ("WARN", "orders have payments", "orders", "order_payments", "order_id", "order_id", True),
        ("WARN", "orders have reviews", "orders", "order_reviews", "order_id", "order_id", True),
    ]
    out = [
        orphans(t[child], t[parent], ck, pk, keep).select(
            F.lit(label).alias("relationship"), F.lit(severity).alias("severity"), "orphan_rows")
        for severity, label, child, parent, ck, pk, keep in links
    ]
    return stack(out).withColumn("status", status_of("orphan_rows", "severity"))


def payment_reconciliation(items: DataFrame, payments: DataFrame) -> DataFrame:
    goods = items.groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("items_total"))
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid_total"))
    gap = F.abs(F.col("items_total") - F.col("paid_total"))
    return goods.join(paid, "order_id").agg(
        F.count(F.lit(1)).alias("orders_compared"),
        F.count_if(gap <= 1).alias("within_1_brl"),
        F.count_if(gap > 1).alias("differ_more_than_1_brl"))


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    named = products.where("product_category_name is not null")
    return (
        named.groupBy("product_category_name").agg(F.count(F.lit(1)).alias("products"))
        .join(translation, "product_category_name", "left_anti")
    )


def orders_without_items_by_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    return (
        orders.join(items.select("order_id").distinct(), "order_id", "left_anti")
        .groupBy("order_status").agg(F.count(F.lit(1)).alias("orders_without_items"))
        .orderBy(F.desc("orders_without_items"))
    )


# ---------------------------------------------------------------- declarative column tests


def failing_unique(df: DataFrame, column: str, keyed: bool = False) -> DataFrame:
    """Values that occur more than once and their number of rows.

    Nearly every value is expected once, so a partial aggregate inside a file would keep nearly all of them in a hash
    map, or spill them, and save nothing: the values alone are brought together and counted there, where a frequent
    one is a single entry. ``keyed`` rows are rolled up or joined by the column already and need no other exchange.
    """
    values = df.where(F.col(column).isNotNull()).select(column)
    if not keyed:
        values = values.repartition(column)
    return values.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def failing_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str, where: str | None = None) -> DataFrame:
    rows = child if where is None else child.where(where)
    keys = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing_key")).agg(F.count(F.lit(1)).alias("occurrences"))
    return keys.join(parent.select(F.col(parent_column).alias("missing_key")).distinct(), "missing_key", "left_anti")


def failing_accepted(df: DataFrame, column: str, values: tuple) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("occurrences")).where(~F.col("value").isin(*values))


SCORES = (1, 2, 3, 4, 5)
#: Models that are rolled up or joined by their unique column.
KEYED_MODELS = (
    "raw_product_category_translation", "stg_category_translation", "stg_geolocation", "items_per_order", "payments_per_order",
    "reviews_per_order", "orders_enriched", "fct_orders", "monthly_revenue", "customer_acquisition_monthly", "category_performance",
    "cohort_retention",
)
# model -> unique, not-null, accepted values, relationships (column, parent model, parent column, filter).
MODEL_TESTS: dict[str, dict] = {
    "raw_customers": {"unique": ["customer_id"], "not_null": ["customer_id", "customer_unique_id"]},
    "raw_orders": {"unique": ["order_id"], "not_null": ["order_id", "customer_id"]},
    "raw_order_items": {"not_null": ["order_id"]},
    "raw_order_payments": {"not_null": ["order_id"]},
    "raw_order_reviews": {"not_null": ["order_id"]},
    "raw_products": {"unique": ["product_id"], "not_null": ["product_id"]},
    "raw_sellers": {"unique": ["seller_id"], "not_null": ["seller_id"]},
    "raw_product_category_translation": {"unique": ["product_category_name"], "not_null": ["product_category_name"]},
    "stg_customers": {"unique": ["customer_id"], "not_null": ["customer_id", "customer_unique_id"]},
    "stg_orders": {
        "unique": ["order_id"],
        "not_null": ["order_id", "customer_id", "order_status", "purchased_at", "is_valid_purchase"],
        "accepted": {"order_status": ORDER_STATUSES},
        "relationships": [("customer_id", "stg_customers", "customer_id", None)],
    },
    "stg_order_items": {
        "unique": ["order_item_key"],
        "not_null": ["order_item_key", "order_id", "product_id", "seller_id", "item_price"],
        "relationships": [("order_id", "stg_orders", "order_id", None), ("product_id", "stg_products", "product_id", None),
                          ("seller_id", "stg_sellers", "seller_id", None)],
    },
    "stg_order_payments": {
        "unique": ["order_payment_key"], "not_null": ["order_payment_key", "order_id", "payment_value"],
        "accepted": {"payment_type": PAYMENT_TYPES},
        "relationships": [("order_id", "stg_orders", "order_id", None)],
    },
    "stg_order_reviews": {
        "unique": ["review_order_key"], "not_null": ["review_order_key", "order_id", "review_score"],
        "accepted": {"review_score": SCORES},
        "relationships": [("order_id", "stg_orders", "order_id", None)],
    },
    "stg_products": {"unique": ["product_id"], "not_null": ["product_id"]},
    "stg_category_translation": {
        "unique": ["product_category_name_pt"], "not_null": ["product_category_name_pt", "product_category_name_en"]},
    "stg_sellers": {"unique": ["seller_id"], "not_null": ["seller_id"]},
    "stg_geolocation": {"unique": ["zip_code_prefix"], "not_null": ["zip_code_prefix"]},
    "items_per_order": {"unique": ["order_id"], "not_null": ["order_id"]},
    "payments_per_order": {"unique": ["order_id"], "not_null": ["order_id"]},
    "reviews_per_order": {"unique": ["order_id"], "not_null": ["order_id"]},
    "orders_enriched": {"unique": ["order_id"], "not_null": ["order_id", "customer_unique_id", "order_revenue"]},
    "fct_orders": {
        "unique": ["order_id"], "not_null": ["order_id", "customer_unique_id", "is_valid_purchase", "order_revenue"],
        "accepted": {"order_status": ORDER_STATUSES},
        "relationships": [("customer_unique_id", "dim_customers", "customer_unique_id", "is_valid_purchase")],
    },
    "dim_customers": {
        "unique": ["customer_unique_id"],
        "not_null": ["customer_unique_id", "acquisition_month", "order_count", "total_revenue", "days_since_last_purchase"],
    },
    "dim_products": {"unique": ["product_id"], "not_null": ["product_id", "product_category"]},
    "customer_rfm": {
        "unique": ["customer_unique_id"],
        "not_null": ["customer_unique_id", "r_score", "f_score", "m_score", "rfm_segment", "is_high_value"],
        "accepted": {"r_score": SCORES, "f_score": SCORES, "m_score": SCORES, "rfm_segment": RFM_SEGMENTS,
                     "activity_status": ("Active", "Cooling", "Inactive"), "retention_priority": (1, 2, 3, 4)},
    },
    "monthly_revenue": {"unique": ["purchase_month"], "not_null": ["purchase_month"]},
    "customer_acquisition_monthly": {"unique": ["acquisition_month"], "not_null": ["acquisition_month"]},
    "category_performance": {"unique": ["product_category"], "not_null": ["product_category"]},
    "cohort_retention": {"unique": ["cohort_key"], "not_null": ["cohort_key", "acquisition_month", "months_since_acquisition"]},
}


def _result(model: str, column: str, kind: str, failures: Column | str) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(kind).alias("test"),
            F.coalesce(F.col(failures) if isinstance(failures, str) else failures, F.lit(0)).cast("long").alias("failures")]


def observed_rules(name: str) -> dict[str, Column]:
    """The not-null and accepted-value tests of a model as aggregates that its write can measure."""
    spec = MODEL_TESTS.get(name, {})
    nulls = {f"not_null {c}": F.count_if(F.col(c).isNull()) for c in spec.get("not_null", [])}
    odd = {f"accepted_values {c}": F.count_if(~F.col(c).isin(*values)) for c, values in spec.get("accepted", {}).items()}
    return nulls | odd


def observed_failures(name: str, measured: dict[str, int]) -> list[str]:
    """Rows that failed a rule while the model was written."""
    return [f"{name}.{rule.split(' ', 1)[1]} {rule.split(' ', 1)[0]}: {measured[rule]}" for rule in observed_rules(name) if measured[rule]]


def generic_unique(models, names=None) -> DataFrame:
    """Distinct values that occur more than once, per declared unique column."""
    out = []
    for name, spec in MODEL_TESTS.items():
        for column in spec.get("unique", []):
            if names is None or name in names:
                bad = failing_unique(models(name), column, name in KEYED_MODELS).agg(F.count(F.lit(1)).alias("failures"))
                out.append(bad.select(*_result(name, column, "unique", "failures")))
    return stack(out)


def generic_not_null(models, names=None) -> DataFrame:
    """NULLs per declared column, all columns of a model in one aggregate."""
    out = []
    for name, spec in MODEL_TESTS.items():
        columns = spec.get("not_null", [])
        if columns and (names is None or name in names):
            row = models(name).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            melted = melt_counts(row, {c: c for c in columns}, "column_name", "failures")
            out.append(melted.select(F.lit(name).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures"))
    return stack(out)


def generic_accepted_values(models, names=None) -> DataFrame:
    """Distinct unexpected values, all checked columns of a model in one pass over it."""
    out = []
    for name, spec in MODEL_TESTS.items():
        accepted = spec.get("accepted", {})
        if accepted and (names is None or name in names):
            odd = F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.when(~F.col(c).isin(*values), F.col(c)).cast("string").alias("v"))
                for c, values in accepted.items()
            ])
            # Only unexpected values leave the scan; columns without any come back with 0.
            found = models(name).select(F.explode(F.filter(odd, lambda x: x["v"].isNotNull())).alias("x")).select("x.*").distinct()
            counts = found.groupBy("column_name").agg(F.count(F.lit(1)).alias("failures"))
            columns = counts.sparkSession.createDataFrame([(c,) for c in accepted], "column_name string")
            out.append(columns.join(F.broadcast(counts), "column_name", "left").select(
                F.lit(name).alias("model"), "column_name", F.lit("accepted_values").alias("test"),
                F.coalesce("failures", F.lit(0)).cast("long").alias("failures")))
    return stack(out)


def generic_relationships(models, names=None) -> DataFrame:
    """Child rows whose key has no parent, per declared relationship."""
    out = []
    for name, spec in MODEL_TESTS.items():
        for column, parent, parent_column, where in spec.get("relationships", []):
            if names is None or name in names:
                bad = failing_relationship(models(name), column, models(parent), parent_column, where)
                out.append(bad.agg(F.sum("occurrences").alias("failures")).select(*_result(name, column, "relationships", "failures")))
    return stack(out)


# ---------------------------------------------------------------- singular tests: no rows = pass


def negative_revenue(facts: DataFrame) -> DataFrame:
    money = ("order_revenue", "items_subtotal", "freight_total")
    return facts.where(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in money])).select("order_id", *money)


def impossible_dates(facts: DataFrame, cfg: RetentionConfig, now: Column | None = None) -> DataFrame:
    now = now if now is not None else F.localtimestamp()
    bought = F.col("purchased_at")
    steps = [F.col(c) < bought for c in ("approved_at", "shipped_to_carrier_at", "delivered_at")]
    early = bought < F.lit(cfg.period_start).cast("timestamp_ntz")
    wrong = reduce(lambda a, b: a | b, [early, bought > now, *steps])
    return facts.where(wrong).select("order_id", "purchased_at", "approved_at", "shipped_to_carrier_at", "delivered_at")


def duplicate_orders(facts: DataFrame) -> DataFrame:
    return failing_unique(facts, "order_id")


def customer_revenue_mismatch(facts: DataFrame, customers: DataFrame) -> DataFrame:
    by_order = facts.where("is_valid_purchase").agg(
        F.sum("order_revenue").cast(TOTAL).alias("order_revenue"), F.count(F.lit(1)).alias("orders"))
    by_person = customers.agg(F.sum("total_revenue").cast(TOTAL).alias("customer_revenue"), F.sum("order_count").alias("customer_orders"))
    off = (F.abs(F.col("order_revenue") - F.col("customer_revenue")) > 0.01) | (F.col("orders") != F.col("customer_orders"))
    return by_order.crossJoin(F.broadcast(by_person)).where(off)


def monthly_mismatch(monthly: DataFrame, kpis: DataFrame) -> DataFrame:
    months = monthly.agg(F.sum("revenue").cast(TOTAL).alias("revenue"), F.sum("orders").alias("orders"))
    off = (F.abs(F.col("revenue") - F.col("total_revenue")) > 0.01) | (F.col("orders") != F.col("total_orders"))
    totals = months.crossJoin(F.broadcast(kpis.select("total_revenue", "total_orders"))).where(off).select(
        F.lit("months do not add up to the headline totals").alias("problem"))
    split = monthly.where(F.col("new_customers") + F.col("returning_customers") != F.col("unique_customers")).select(
        F.concat(F.lit("new and returning do not add up in "), F.col("purchase_month").cast("string")).alias("problem"))
    return totals.unionByName(split)


def rfm_coverage_mismatch(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    a = customers.agg(F.count(F.lit(1)).alias("customers"))
    b = rfm.agg(F.count(F.lit(1)).alias("rfm_rows"))
    return a.crossJoin(F.broadcast(b)).where("customers <> rfm_rows")


def cohort_rate_problems(cohorts: DataFrame) -> DataFrame:
    rate = F.col("retention_rate")
    return cohorts.where(((F.col("months_since_acquisition") == 0) & (rate != 1)) | (rate > 1) | (rate < 0))


def as_check(name: str, violating: DataFrame) -> DataFrame:
    """One row (check_name, violations, status) of a singular test."""
    counted = violating.agg(F.count(F.lit(1)).alias("violations"))
    return counted.select(F.lit(name).alias("check_name"), "violations", status_of("violations", F.lit("FAIL")).alias("status"))


def singular_tests(
    facts: DataFrame, customers: DataFrame, rfm: DataFrame, monthly: DataFrame, kpis: DataFrame, cohorts: DataFrame, cfg: RetentionConfig,
) -> dict[str, DataFrame]:
    """Violating rows of the seven singular tests by name."""
    return {
        "no negative revenue": negative_revenue(facts),
        "no impossible dates": impossible_dates(facts, cfg),
        "no duplicate orders": duplicate_orders(facts),
        "customer revenue reconciles": customer_revenue_mismatch(facts, customers),
        "months reconcile": monthly_mismatch(monthly, kpis),
        "rfm covers customers": rfm_coverage_mismatch(customers, rfm),
        "cohorts start whole": cohort_rate_problems(cohorts),
    }


# ---------------------------------------------------------------- reconciliation


def marts_vs_raw(tables: Tables, facts: DataFrame, kpis: DataFrame, customers: DataFrame, rfm: DataFrame,
                 categories: DataFrame, monthly: DataFrame) -> DataFrame:
    """Headline figures recomputed from the raw tables on a second, independent path."""
    valid = (
        tables["orders"].where(~F.col("order_status").isin(*VOID_STATUSES))
        .join(tables["customers"], "customer_id").select("order_id", "customer_unique_id")
    )
    paid = tables["order_payments"].groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    goods = tables["order_items"].groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("gross"), F.sum("price").alias("price"))
    wide = valid.join(paid, "order_id", "left").join(goods, "order_id", "left")
    spent = F.coalesce("paid", "gross", F.lit(0).cast(TOTAL))
    per_person = wide.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(spent).cast(TOTAL).alias("revenue"), F.sum("price").cast(TOTAL).alias("price"))
    raw = per_person.agg(
        F.sum("n").alias("orders"), F.count("customer_unique_id").alias("people"), F.sum("revenue").cast(TOTAL).alias("revenue"),
        F.count_if(F.col("n") >= 2).alias("repeaters"), F.sum("price").cast(TOTAL).alias("item_revenue"))

    count = F.count(F.lit(1))
    fives = F.round(F.lit(100.0) * share(F.count_if(F.col("r_score") == 5), count))
    # Every input becomes one row; the nine comparisons are cells of their product.
    row = raw.select(*[F.col(c).alias(f"raw_{c}") for c in raw.columns])
    for one in (
        tables["orders"].agg(count.alias("raw_orders_all")), facts.agg(count.alias("facts")), customers.agg(count.alias("customers")),
        rfm.agg(count.alias("rfm"), fives.alias("fives")), categories.agg(F.sum("item_revenue").alias("category_revenue")),
        monthly.agg(F.sum("new_customers").alias("month_customers")),
        kpis.select("total_orders", "unique_customers", "total_revenue", "repeat_customers"),
    ):
        row = row.crossJoin(F.broadcast(one))
    pairs = {
        "valid orders": ("raw_orders", "total_orders"), "unique customers": ("raw_people", "unique_customers"),
        "revenue": ("raw_revenue", "total_revenue"), "repeat customers": ("raw_repeaters", "repeat_customers"),
        "all orders": ("raw_orders_all", "facts"), "customers in both customer marts": ("customers", "rfm"),
        "item revenue": ("raw_item_revenue", "category_revenue"),
        "new customers over all months": ("month_customers", "unique_customers"),
        "share of top recency score is near 20": (F.lit(20), "fives"),
    }
    cells = F.array(*[
        F.struct(F.lit(label).alias("check_name"), *[
            (F.col(v) if isinstance(v, str) else v).cast("double").alias(n) for n, v in zip(("raw_value", "mart_value"), pair, strict=True)
        ]) for label, pair in pairs.items()
    ])
    gap = F.abs(F.col("raw_value") - F.col("mart_value"))
    loose = F.col("check_name").like("share of top recency%")
    verdict = (
        F.when(loose, F.when(gap <= 5, "PASS").otherwise("WARN")).when(gap <= 0.01, "PASS").otherwise("FAIL")
    )
    return row.select(F.explode(cells).alias("x")).select("x.*").withColumn("status", verdict)


def score_table_invariants(
    scores: DataFrame, customers: DataFrame, scenarios: DataFrame, evaluation: DataFrame, model: str = MODEL_NAMES[0]
) -> DataFrame:
    """Twelve properties of the published scores; 0 problems = PASS."""
    c = F.col
    group, tier = c("customer_group"), c("value_tier")
    scores = store(scores, "scores")

    def flag(ok: Column) -> Column:
        return F.when(ok, 0).otherwise(1)

    # Ids and ranks collapse to their distinct values before they are counted.
    distinct_ids = scores.groupBy("customer_unique_id").agg(F.lit(1).alias("x")).agg(F.count("customer_unique_id").alias("ids"))
    distinct_ranks = scores.groupBy("priority_rank").agg(F.lit(1).alias("x")).agg(F.count("priority_rank").alias("ranks"))
    body = scores.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~c("return_probability").between(0, 1)).alias("probability"),
        F.count_if(~c("priority_score").between(0, 100)).alias("priority"),
        F.min("priority_rank").alias("rank_low"), F.max("priority_rank").alias("rank_high"),
        F.count_if(group.isNull() | c("next_best_action").isNull() | c("action_cost_brl").isNull()).alias("decision"),
        F.sum("total_revenue").cast(TOTAL).alias("revenue"),
        F.count_if((group == "Loyal Customer") & (c("purchase_days") < 2)).alias("loyal"),
        F.count_if(group.like("High Value%") & (tier != "High")).alias("value"),
        F.count_if(group.like("%High Risk") & (c("risk_tier") != "High")).alias("risk"),
    )
    people = customers.agg(F.count(F.lit(1)).alias("people"), F.sum("total_revenue").cast(TOTAL).alias("people_revenue"))
    chained = ordered_scan(
        scores.select("priority_rank", "customer_unique_id", "cumulative_action_cost_brl"),
        [("priority_rank", True), ("customer_unique_id", True)], previous={"before": "cumulative_action_cost_brl"},
    )
    falling = chained.agg(F.count_if(c("cumulative_action_cost_brl") < c("before")).alias("falling"))
    spending = scenarios.agg(F.count_if(c("spend_brl") > c("budget_brl")).alias("overspent"))
    auc = evaluation.agg(
        F.max(F.when(c("model") == model, c("roc_auc"))).alias("model_auc"),
        F.max(F.when(c("model") == MODEL_NAMES[-1], c("roc_auc"))).alias("random_auc"))
    row = body
    for extra in (distinct_ids, distinct_ranks, people, falling, spending, auc):
        row = row.crossJoin(F.broadcast(extra))
    checks = {
        "one row per customer of the customer mart": flag((c("n") == c("people")) & (c("ids") == c("n"))),
        "return probability is in 0 to 1": c("probability"),
        "priority score is in 0 to 100": c("priority"),
        "priority rank runs 1 to N": flag((c("rank_low") == 1) & (c("rank_high") == c("n")) & (c("ranks") == c("n"))),
        "every customer has group, action and cost": c("decision"),
        "revenue equals the customer mart": flag(F.abs(c("revenue") - c("people_revenue")) < 0.01),
        "loyal customers bought on two days": c("loyal"),
        "high value groups hold the high tier": c("value"),
        "high risk groups hold the high risk tier": c("risk"),
        "cumulative cost never falls": c("falling"),
        "budgets are not overspent": c("overspent"),
        "model ranks better than chance": flag(c("model_auc") > c("random_auc")),
    }
    cells = F.array(*[F.struct(F.lit(n).alias("check_name"), v.cast("long").alias("problems")) for n, v in checks.items()])
    return row.select(F.explode(cells).alias("x")).select("x.*").withColumn("status", status_of("problems", F.lit("FAIL")))


def gate_checks(decided: DataFrame, rfm: DataFrame) -> DataFrame:
    """Six conditions the score table must meet before anything is written."""
    c = F.col
    ids = decided.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("ids"))
    body = decided.agg(
        F.count_if(F.coalesce(~c("return_probability").between(0, 1), F.lit(True))).alias("probability"),
        F.count_if(F.coalesce(~c("priority_score").between(0, 100), F.lit(True))).alias("priority"),
        F.count_if(c("action_cost_brl").isNull()).alias("cost"),
        F.count_if(c("customer_group").isNull()).alias("grouped"),
    )
    people = rfm.agg(F.count(F.lit(1)).alias("people"))
    row = ids.crossJoin(F.broadcast(body)).crossJoin(F.broadcast(people))
    checks = {
        "one row per customer": c("ids") == c("n"),
        "every customer is scored": c("n") == c("people"),
        "probabilities between 0 and 1": c("probability") == 0,
        "priority between 0 and 100": c("priority") == 0,
        "every action has a cost": c("cost") == 0,
        "no missing group": c("grouped") == 0,
    }
    cells = F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(v, F.lit(False)).alias("passed")) for n, v in checks.items()])
    return row.select(F.explode(cells).alias("x")).select("x.*")


def require_gate(checks: DataFrame) -> None:
    failed = [r["check_name"] for r in checks.where("not passed").collect()]  # at most six rows
    if failed:
        raise GateError("nothing was written; failed: " + ", ".join(failed))
