"""CSV files with line breaks inside quotes, read in parallel.

A reader that must know whether a line break stands inside quotes starts at the top of
the file, so it is one task a file. Here the files are read as lines, in byte ranges:

1. Each line is a function from "inside quotes before it" to "inside quotes after it".
2. Each range composes the functions of its lines, and one row per range is left. Composing those in file
   order tells for every range whether it starts inside quotes and how many records start before it.
3. The lines are read again; together with their range's row each knows the record it belongs to. Records of
   one line are complete, the lines of others are put together.

Step 3 shuffles the lines by range, so that no task holds more than a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOM = "﻿"
RANGE = ["file_path", "range_start"]

# Java patterns; possessive, so that no line takes more than one pass. A quote opens a value only at its beginning.
_VALUE_REST = '[^"]*+(?:""[^"]*+)*+'
_VALUES = f'(?:(?:"{_VALUE_REST}"[^{{sep}}]*+|[^"{{sep}}][^{{sep}}]*+|){{sep}})*+'
_OPEN_VALUE = f'"{_VALUE_REST}$'


def ends_inside(line: Column, started_inside: bool, sep: str = ",") -> Column:
    """Does a value that is still open at the end of the line continue on the next one?"""
    outside = (_VALUES + _OPEN_VALUE).format(sep=sep)
    if not started_inside:
        return line.rlike("^" + outside)
    closed_first = f'^{_VALUE_REST}"[^{sep}]*+{sep}' + outside
    return line.rlike(f"^{_VALUE_REST}$") | line.rlike(closed_first)


def physical_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Lines with their file, byte range and a number that rises within a range."""
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    line = F.regexp_replace("value", "\r$", "")
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("range_start"), F.monotonically_increasing_id().alias("line_no"), line.alias("line"),
    )


def with_transitions(lines: DataFrame, sep: str) -> DataFrame:
    return lines.withColumns({"after_out": ends_inside(F.col("line"), False, sep), "after_in": ends_inside(F.col("line"), True, sep)})


def composed(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Is each row preceded by an open quote, if its group starts outside (``before_out``) or inside (``before_in``) one?

    A row keeps the state, swaps it, or sets it whatever it was. So the state is that of the last row that
    sets it, or of the start, swapped once for every swapping row since.
    """
    swaps = (F.col("after_out") & ~F.col("after_in")).cast("long")
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("swaps", F.coalesce(F.sum(swaps).over(earlier), F.lit(0)))
    sets = F.when(F.col("after_out") == F.col("after_in"), F.struct("after_out", F.col("swaps").alias("swaps_then")))
    last = counted.withColumn("last_set", F.last(sets, ignorenulls=True).over(earlier))
    odd = (F.col("swaps") - F.coalesce("last_set.swaps_then", F.lit(0))) % 2 == 1

    def before(start: bool) -> Column:
        return F.coalesce("last_set.after_out", F.lit(start)) != odd

    return last.withColumns({"before_out": before(False), "before_in": before(True)}).drop("swaps", "last_set")


def ranges(lines: DataFrame, sep: str) -> DataFrame:
    """One row per byte range: does it start inside quotes, and how many records start before it in its file."""
    narrow = with_transitions(lines, sep).select(*RANGE, "line_no", "after_out", "after_in")
    states = composed(narrow, RANGE, "line_no")
    sums = states.groupBy(*RANGE).agg(
        *[F.max_by(F.when(F.col(f"before_{s}"), F.col("after_in")).otherwise(F.col("after_out")), "line_no").alias(f"after_{s}") for s in ("out", "in")],
        *[F.count_if(~F.col(f"before_{s}")).alias(f"records_{s}") for s in ("out", "in")],
    )
    placed = composed(sums, ["file_path"], "range_start")
    inside = F.col("before_out")
    own = F.when(inside, F.col("records_in")).otherwise(F.col("records_out"))
    by_file = Window.partitionBy("file_path").orderBy("range_start")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    is_last = F.lead("range_start").over(by_file).isNull()
    open_at_end = is_last & F.when(inside, F.col("after_in")).otherwise(F.col("after_out"))
    refused = F.when(open_at_end, F.raise_error(F.concat(F.lit("quote never closed in "), "file_path"))).otherwise(inside)
    return placed.select(*RANGE, refused.alias("inside"), F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("records_before"))


def records(spark: SparkSession, path: str, pattern: str | None = None, sep: str = ",") -> DataFrame:
    """Records (file_path, file_name, record number in the file from 0, text) of all files; empty lines between records are left out.

    Line ends are given as ``\\n``, also inside quotes. A file whose last quote is never closed is refused. Compressed
    files are one range each. The number of ranges follows ``spark.sql.files.maxPartitionBytes``.
    """
    at = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in RANGE]
    lines = composed(with_transitions(physical_lines(spark, path, pattern), sep), RANGE, "line_no")
    through = Window.partitionBy(*RANGE).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = lines.withColumns({f"starts_{s}": F.sum((~F.col(f"before_{s}")).cast("long")).over(through) for s in ("out", "in")})
    placed = counted.alias("l").join(ranges(physical_lines(spark, path, pattern), sep).alias("r"), at, "left")
    inside = F.col("r.inside")
    before = F.when(inside, F.col("before_in")).otherwise(F.col("before_out"))
    # A range without a row would mean that the two reads were split differently.
    known = F.when(inside.isNull(), F.raise_error(F.lit("byte ranges changed between two reads"))).otherwise(before)
    told = placed.select(
        F.col("l.file_path"), "file_name", "line_no", "line", F.col("l.range_start"), known.alias("before"),
        (F.col("records_before") + F.when(inside, F.col("starts_in")).otherwise(F.col("starts_out")) - 1).alias("record_no"),
        F.when(before, F.col("after_in")).otherwise(F.col("after_out")).alias("after"))
    whole = told.where(~F.col("before") & ~F.col("after")).select("file_path", "file_name", "record_no", F.col("line").alias("record"))
    parts = told.where(F.col("before") | F.col("after")).groupBy("file_path", "file_name", "record_no").agg(
        F.array_sort(F.collect_list(F.struct("range_start", "line_no", "line"))).alias("parts"))
    joined = parts.select("file_path", "file_name", "record_no", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"))
    return whole.unionByName(joined).where((F.length(F.trim("record")) > 0) | (F.col("record_no") == 0))


def without_headers(rows: DataFrame, names: list[str]) -> DataFrame:
    """Leave out each file's first record, which must name the columns in order (in any case, quoted or not)."""
    shown = F.lower(F.regexp_replace(F.regexp_replace("record", f"^{BOM}", ""), '"', ""))
    wrong = F.raise_error(F.concat(F.lit("header of "), "file_path", F.lit(" does not name the columns: "), "record"))
    is_header = F.col("record_no") == 0
    return rows.where(F.when(~is_header, F.lit(True)).when(shown == ",".join(names).lower(), F.lit(False)).otherwise(wrong.cast("boolean")))


def parsed(rows: DataFrame, ddl: str, options: dict[str, str]) -> DataFrame:
    """The records' values, typed."""
    return rows.withColumn("parsed", F.from_csv("record", ddl, options)).select("file_name", "parsed.*")
