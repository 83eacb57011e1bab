"""Schedule exports: the tab-delimited text form, read natively, and the SQLite form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import defaults
from ..functions.text import strip

#: The first bytes of a SQLite file.
SQLITE_MARK = b"SQLite format 3"


def file_formats(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, format): ``sqlite`` or ``text`` by a file's first bytes."""
    files = spark.read.format("binaryFile").load(path)
    start = F.substring("content", 1, len(SQLITE_MARK))
    return files.select(F.col("path").alias("source_file"), F.when(start == F.lit(SQLITE_MARK), F.lit("sqlite")).otherwise(F.lit("text")).alias("format"))


def _cells(line: Column, strict_first_cell: bool) -> Column:
    """The cells behind a line's two-character mark, each stripped; without a tab it is one cell.
    An empty first cell is lost, as in the files' usual readers, unless ``strict_first_cell``."""
    body = F.substring(line, 3, 2**31 - 1)
    body = F.regexp_replace(body, r"^\t", "") if strict_first_cell else F.regexp_replace(body, r"^[\t ]+", "")
    return F.transform(F.split(body, "\t", -1), strip)


def scan_text(spark: SparkSession, path: str | Sequence[str], tables: Sequence[str] | None = None, strict_first_cell: bool = False) -> DataFrame:
    """Data rows of all files as (source_file, line_no, table_name, vals) and the header that counts
    for them (``fields``): of several headers of one table in a file the last.

    Lines that are neither a table, a header nor a row are ignored, so text behind a line break in a
    cell is lost.  Rows before any header of their table section are ignored.  A file is one task."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.make_valid_utf8("value").alias("value"))
    lines = text.select("source_file", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("line_no", "line"))
    lines = lines.withColumn("mark", F.substring("line", 1, 2)).where("mark IN ('%T', '%F', '%R')").withColumn("cells", _cells(F.col("line"), strict_first_cell))
    words = F.filter(F.split(strip(F.substring("line", 3, 2**31 - 1)), r"\s+"), lambda c: c != "")
    header = F.when(F.contains("line", F.lit("\t")), F.filter("cells", lambda c: c != "")).otherwise(words)
    upto = Window.partitionBy("source_file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_t", F.when(F.col("mark") == "%T", F.coalesce(F.get(header, F.lit(0)), F.lit(""))))
    lines = lines.withColumn("table_name", F.last("_t", ignorenulls=True).over(upto))
    # a new table forgets the header before it
    lines = lines.withColumn("_f", F.when(F.col("mark") == "%F", header).when(F.col("mark") == "%T", F.array().cast("array<string>")))
    lines = lines.withColumn("_known", F.size(F.last("_f", ignorenulls=True).over(upto)) > 0)
    if tables is not None:
        lines = lines.where(F.col("table_name").isin(*tables))
    headers = lines.where("mark = '%F'").groupBy("source_file", "table_name").agg(F.max_by("_f", "line_no").alias("fields"))
    rows = lines.where("mark = '%R' AND _known").select("source_file", "line_no", "table_name", F.col("cells").alias("vals"))
    return rows.join(headers, ["source_file", "table_name"])


def table_of(scanned: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """One table of a scan with the given string columns (blank where a file has none, or a row is
    short; of a repeated header name the last counts), ``source_file`` and ``ord``, the line's number."""
    rows = scanned.where(F.col("table_name") == name)

    def cell(column: str) -> Column:
        at = F.size("fields") - F.array_position(F.reverse("fields"), F.lit(column)) + 1
        return F.when(F.array_contains("fields", F.lit(column)), F.coalesce(F.get("vals", (at - 1).cast("int")), F.lit(""))).otherwise(F.lit(""))

    return rows.select("source_file", F.col("line_no").cast("long").alias("ord"), *[cell(c).alias(c) for c in columns])


def list_text_tables(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, table_name) in the order of first mention."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    lines = text.select("source_file", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("line_no", "line")).where("startswith(line, '%T')")
    named = lines.select("source_file", "line_no", strip(F.substring("line", 3, 2**31 - 1)).alias("table_name")).where("table_name <> ''")
    return named.groupBy("source_file", "table_name").agg(F.min("line_no").alias("first")).orderBy("source_file", "first").select("source_file", "table_name")


def columns_of(scanned: DataFrame, name: str) -> list[str]:
    """All columns that any file's header has for a table, sorted by first place."""
    rows = scanned.where(F.col("table_name") == name).select("fields").distinct().select(F.posexplode("fields").alias("at", "c"))
    return [r["c"] for r in rows.groupBy("c").agg(F.min("at").alias("at")).orderBy("at", "c").collect()]  # a table's columns


def load_tables(spark: SparkSession, path: str, tables: Sequence[str] = defaults.DEFAULT_TABLES, columns: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Tables of one export, text or SQLite, as string tables with ``ord``; absent ones are empty."""
    kind = file_formats(spark, path).first()["format"]
    if kind == "sqlite":
        from .sqlite import load_sqlite_tables

        return load_sqlite_tables(spark, path, tables)
    scanned = scan_text(spark, path, tables)
    return {t: table_of(scanned, t, (columns or {}).get(t) or columns_of(scanned, t)) for t in tables}
