"""Sources and sinks, exercised on files and tables written from the given data."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality
from tidemark.plans.catalog import query
from tidemark.plans.queries_marts import MONTH_MONEY
from tidemark.plans.queries_quality import NULL_CHECKS, profile_sql, union
from tidemark.sources import csv_files, tables
from tidemark.sources.schemas import RAW_TABLES
from tidemark.sources.scratch import fresh_path
from tidemark.sources.versions import VersionedTables


def written_csv(w, table, compression=None, df=None):
    """A raw table as CSV files in a fresh folder."""
    folder = fresh_path(w.spark, f"csv-{table}")
    writer = (df if df is not None else w.raw[table]).write.options(
        header="true", quote='"', escape='"', timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(folder)
    return folder


@query("csv_scan", "from raw_order_reviews")
def csv_scan(w):
    return csv_files.csv_scan(w.spark, written_csv(w, "order_reviews"), "order_reviews")


@query("csv_scan_orders", "from raw_orders")
def csv_scan_orders(w):
    return csv_files.csv_scan(w.spark, written_csv(w, "orders"), "orders")


@query("file_pattern_scan", "from raw_order_items", "price freight_value")
def file_pattern_scan(w):
    folder = written_csv(w, "order_items", "gzip")
    return csv_files.file_pattern_scan(w.spark, folder, "order_items", "part-*")


@query("full_reload", "from raw_sellers")
def full_reload(w):
    source, target = written_csv(w, "sellers"), fresh_path(w.spark, "sellers")
    tables.full_reload(w.spark, source, "sellers", target)
    return tables.full_reload(w.spark, source, "sellers", target)


@query("reload_keeps_the_old_table", "from raw_sellers")
def reload_keeps_the_old_table(w):
    """A second delivery with too few columns in some rows stops while it is written; the first one is still read."""
    target = fresh_path(w.spark, "sellers")
    tables.full_reload(w.spark, written_csv(w, "sellers"), "sellers", target)
    cut = w.raw["sellers"].select(F.when(F.col("seller_state") == "SP", F.lit("x")).otherwise(F.concat_ws(",", *w.raw["sellers"].columns)).alias("value"))
    folder = fresh_path(w.spark, "csv-sellers")
    header = w.spark.createDataFrame([(",".join(w.raw["sellers"].columns),)], "value string")
    header.unionByName(cut).coalesce(1).write.text(folder)
    try:
        tables.full_reload(w.spark, folder, "sellers", target)
    except Exception as error:
        if "MALFORMED" not in str(error).upper():
            raise
    else:
        raise AssertionError("a delivery with cut rows was loaded")
    return VersionedTables(w.spark, target).read("sellers")


@query("null_checks_at_load", NULL_CHECKS)
def null_checks_at_load(w):
    """The NULL report of a load of all nine tables, from what their write measured."""
    raw = VersionedTables(w.spark, fresh_path(w.spark, "raw"))
    with raw.load() as load:
        for name, df in w.raw.items():
            load.write(name, df, quality.null_counters(name))
    return quality.null_checks_at_load(w.spark, raw.current().tables)


def _spoiled(w):
    """Reviews whose best scores are not numbers."""
    score = F.when(F.col("review_score") == 5, "n/a").otherwise(F.col("review_score").cast("string"))
    return written_csv(w, "order_reviews", df=w.raw["order_reviews"].withColumn("review_score", score))


@query("abort_on_error", "select review_id, order_id from raw_order_reviews where review_score = 5")
def abort_on_error(w):
    return csv_files.dry_run(w.spark, _spoiled(w), "order_reviews").select("review_id", "order_id")


@query("load_audit", """
  select 'order_reviews' as table_name, count(*) as rows_parsed, count(*) filter (review_score is distinct from 5) as rows_loaded,
    'LOAD_FAILED' as worst_status, min(review_id) filter (review_score = 5) as first_bad_review from raw_order_reviews""")
def load_audit(w):
    """Rows, worst file status and the id in the first bad row, over all files."""
    audit = csv_files.load_audit(w.spark, _spoiled(w), "order_reviews")
    return audit.groupBy("table_name").agg(
        F.sum("rows_parsed").alias("rows_parsed"), F.sum("rows_loaded").alias("rows_loaded"), F.max("status").alias("worst_status"),
        F.min(F.substring_index("first_error", ",", 1)).alias("first_bad_review"))


def _contract_sql():
    """Counts by table and column; reviews with spoiled scores, sellers with two columns that changed places."""
    moved = {"seller_city": "seller_state", "seller_state": "seller_city"}
    for spec in RAW_TABLES.values():
        place = {c: k for k, (c, _) in enumerate(spec.columns, 1)}
        for c, t in spec.columns:
            spoiled = (spec.name, c) == ("order_reviews", "review_score")
            actual = place[moved.get(c, c)] if spec.name == "sellers" else place[c]
            bad = "count(*) filter (review_score = 5)" if spoiled else "0"
            status = "FAIL - wrong position" if actual != place[c] else "FAIL - wrong values" if spoiled else "PASS"
            yield f"""select '{spec.name}' as table_name, '{c}' as column_name, {place[c]} as expected_position, {actual} as actual_position,
              '{quality.type_label(t)[0]}' as expected_type, count(nullif(trim({c}::VARCHAR), '')) as filled_values, {bad} as bad_values, '{status}' as status from raw_{spec.name}"""


@query("schema_contract_diff", union(_contract_sql()))
def schema_contract_diff(w):
    """All nine tables as text files, two of them with defects."""
    texts = {}
    for spec in RAW_TABLES.values():
        if spec.name == "order_reviews":
            folder = _spoiled(w)
        elif spec.name == "sellers":
            folder = written_csv(w, "sellers", df=w.raw["sellers"].select("seller_id", "seller_zip_code_prefix", "seller_state", "seller_city"))
        else:
            folder = written_csv(w, spec.name)
        texts[spec.name] = csv_files.string_profile_scan(w.spark, folder, spec.multi_line)
    return quality.schema_contract_diff(texts)


@query("string_profile_scan", profile_sql("order_reviews"))
def string_profile_scan(w):
    return quality.profile_columns(csv_files.string_profile_scan(w.spark, written_csv(w, "order_reviews")), "order_reviews")


@query("table_scan_lowercase", "from stg_sellers")
def table_scan_lowercase(w):
    w.stg_sellers.toDF(*[c.upper() for c in w.stg_sellers.columns]).createOrReplaceTempView("sellers_upper")
    return tables.table_scan_lowercase(w.spark, "sellers_upper")


@query("table_overwrite", """
  select order_id, customer_id, order_status, order_purchase_timestamp::DATE as order_purchase_timestamp, order_approved_at::DATE as order_approved_at,
    order_delivered_carrier_date::DATE as order_delivered_carrier_date, order_delivered_customer_date::DATE as order_delivered_customer_date,
    order_estimated_delivery_date::DATE as order_estimated_delivery_date from raw_orders""")
def table_overwrite(w):
    path = fresh_path(w.spark, "orders-table")
    for _ in range(2):
        tables.table_overwrite(w.raw["orders"], "ml", "orders_by_day", path)
    return w.spark.table("ml.orders_by_day")


@query("csv_export", "from monthly_revenue", MONTH_MONEY)
def csv_export(w):
    folder = fresh_path(w.spark, "extracts")
    tables.csv_export({"monthly_revenue": w.monthly_revenue}, folder)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in w.monthly_revenue.schema])
    return w.spark.read.schema(schema).options(header="true").csv(f"{folder}/monthly_revenue")


@query("layer_materialise", """
  select 'marts' as layer, count(*) as rows from dim_products union all select 'staging', count(*) from stg_sellers""")
def layer_materialise(w):
    root = fresh_path(w.spark, "layers")
    tables.layer_materialise({"stg_sellers": w.stg_sellers}, "staging", as_tables=False)
    tables.layer_materialise({"dim_products": w.dim_products}, "marts", as_tables=True, root=root)
    counted = {"marts": w.spark.table("marts.dim_products"), "staging": w.spark.table("staging_stg_sellers")}
    return quality.stack([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), "rows") for layer, df in counted.items()])
