"""CSV sources: typed raw loads, validation, audit and all-text profiling reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import quoted_csv
from tidemark.sources.schemas import RAW_TABLES

CORRUPT = "_corrupt_record"
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "nullValue": "",
    "emptyValue": "",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    # The header must name the columns in order; a file with moved columns is refused.
    "enforceSchema": "false",
}


def _reader(spark: SparkSession, pattern: str | None, **options: str):
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _quoted(spark: SparkSession, folder: str, pattern: str | None, names: list[str], schema: T.StructType, **options: str) -> DataFrame:
    """Rows of files with line breaks in texts, split like any others, with their ``file_name``."""
    records = quoted_csv.without_headers(quoted_csv.records(spark, folder, pattern), names)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return quoted_csv.parsed(records, ddl, {**CSV_OPTIONS, **options})


def csv_scan(spark: SparkSession, folder: str, table: str, pattern: str | None = None) -> DataFrame:
    """Typed load of one raw table; the read stops at the first bad row."""
    spec = RAW_TABLES[table]
    if spec.multi_line:
        return _quoted(spark, folder, pattern, list(spec.column_names), spec.schema, mode="FAILFAST").drop("file_name")
    return _reader(spark, pattern, mode="FAILFAST").schema(spec.schema).csv(folder)


def file_pattern(file_stem: str, prefix: str = "") -> str:
    """Plain or gzip-compressed files of one table (the codec follows the extension) and no others.

    ``prefix`` is what stands before the stem in all file names of a delivery.
    """
    return f"{{{prefix}{file_stem}.csv,{prefix}{file_stem}.csv.gz}}"


def file_pattern_scan(
    spark: SparkSession, folder: str, table: str, file_stem: str | None = None, prefix: str = "",
) -> DataFrame:
    return csv_scan(spark, folder, table, file_pattern(file_stem or table, prefix))


def tolerant_scan(spark: SparkSession, folder: str, table: str, pattern: str | None = None) -> DataFrame:
    spec = RAW_TABLES[table]
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if spec.multi_line:
        rows = _quoted(spark, folder, pattern, list(spec.column_names), schema, **options)
        return rows.select(*schema.names, "file_name")
    rows = _reader(spark, pattern, **options).schema(schema).csv(folder)
    return rows.withColumn("file_name", F.col("_metadata.file_name"))


def _every_column_read(table: str):
    """Always true; refers to all data columns, because a value that is not parsed cannot be found bad."""
    return F.length(F.concat_ws("", *RAW_TABLES[table].column_names)) >= 0


def dry_run(spark: SparkSession, folder: str, table: str, pattern: str | None = None) -> DataFrame:
    """Only the rows that would stop a load; an empty result means the files are good."""
    return tolerant_scan(spark, folder, table, pattern).where(
        F.col(CORRUPT).isNotNull() & _every_column_read(table)
    )


def load_audit(spark: SparkSession, folder: str, table: str, pattern: str | None = None) -> DataFrame:
    """Per file: rows parsed, rows that load, status and the first bad row."""
    bad = F.col(CORRUPT).isNotNull()
    counted = tolerant_scan(spark, folder, table, pattern).groupBy("file_name").agg(
        F.count_if(_every_column_read(table)).alias("rows_parsed"),
        F.count_if(~bad).alias("rows_loaded"),
        F.min(F.when(bad, F.col(CORRUPT))).alias("first_error"),
    )
    complete = F.col("rows_parsed") == F.col("rows_loaded")
    return counted.select(
        F.lit(table).alias("table_name"), "file_name",
        F.when(complete, "LOADED").otherwise("LOAD_FAILED").alias("status"),
        "rows_parsed", "rows_loaded", "first_error", F.current_timestamp().alias("loaded_at"),
    )


def string_profile_scan(spark: SparkSession, path: str, multi_line: bool = True, pattern: str | None = None) -> DataFrame:
    """Everything as text exactly as written; only an empty field is NULL; BOM dropped from the header.

    Give ``multi_line=False`` for files without line breaks in texts: their lines need not be put together.
    """
    # Only the header is read here.
    plain = _reader(spark, pattern, mode="FAILFAST", multiLine=str(multi_line).lower()).csv(path)
    names = [c.lstrip(quoted_csv.BOM) for c in plain.columns]
    if not multi_line:
        return plain.toDF(*names)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return _quoted(spark, path, pattern, names, schema, mode="FAILFAST").drop("file_name")
