"""Profiles of raw tables, key overlap, label exports and label statistics, periods and memo aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import defaults
from ..functions.text import blank_to_null, round4, strip, text_or_blank


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, strip_blanks: bool = True) -> DataFrame:
    """(column_name, n_rows, n_blank, null_fraction) of each column in one pass; a blank text counts as null."""
    columns = list(columns or df.columns)

    def blank(c: str) -> Column:
        value = F.col(f"`{c}`").cast("string")
        return F.coalesce((strip(value) if strip_blanks else value) == "", F.lit(True))

    counted = df.agg(F.count("*").alias("n"), *[F.count_if(blank(c)).alias(f"b{k}") for k, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"b{k}").alias("n_blank")) for k, c in enumerate(columns)]))
    return counted.select("n", rows.alias("x")).select(
        "x.column_name", F.col("n").alias("n_rows"), "x.n_blank", round4(F.coalesce(F.try_divide(F.col("x.n_blank").cast("double"), "n"), F.lit(0.0))).alias("null_fraction")
    )


def distinct_text(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-blank values of a column, sorted."""
    return df.select(text_or_blank(column).alias("value")).where("value <> ''").distinct().orderBy("value")


def pair_match(current: DataFrame, previous: DataFrame, groups: Sequence[str] = (), key: str = "task_code") -> DataFrame:
    """How many distinct keys two tables share, and their shares of each (4 decimals)."""
    keys = [*groups, key]
    cur, prev = (df.where(F.col(key) != "").select(*keys).distinct().withColumn(flag, F.lit(1)) for df, flag in ((current, "c"), (previous, "p")))
    counts = cur.join(prev, keys, "full_outer").groupBy(*groups).agg(
        F.count("c").alias("n_current"), F.count("p").alias("n_previous"), F.count_if(F.col("c").isNotNull() & F.col("p").isNotNull()).alias("n_matched")
    )
    rate = lambda n: round4(F.coalesce(F.try_divide(F.col("n_matched").cast("double"), F.col(n)), F.lit(0.0)))
    return counts.select(
        *groups, "n_current", "n_previous", "n_matched", (F.col("n_current") - F.col("n_matched")).alias("n_added"), (F.col("n_previous") - F.col("n_matched")).alias("n_removed"),
        rate("n_current").alias("match_rate_current"), rate("n_previous").alias("match_rate_previous"),
    )


def file_hash(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, 12)


def parse_label(c) -> Column:
    """true, false, or null for blanks and words that aren't labels."""
    value = F.lower(text_or_blank(c))
    return F.when(value.isin(*defaults.LABEL_TRUE), F.lit(True)).when(value.isin(*defaults.LABEL_FALSE), F.lit(False))


def label_stats(rows: DataFrame, label: Column, by: str) -> DataFrame:
    """Totals (``by`` null, ``is_total`` 1) and per ``by`` value: rows, labelled, yes, no, share of yes
    (4 decimals, null without labels); one pass with ROLLUP."""
    rows = rows.withColumn("_l", label)
    counted = rows.rollup(by).agg(F.grouping(by).cast("int").alias("is_total"), F.count("*").alias("n_rows"), F.count("_l").alias("n_labeled"), F.count_if("_l").alias("n_yes"))
    return counted.select(by, "is_total", "n_rows", "n_labeled", "n_yes", (F.col("n_labeled") - F.col("n_yes")).alias("n_no"), round4(F.try_divide(F.col("n_yes").cast("double"), "n_labeled")).alias("yes_rate"))


LABEL_COLUMNS = (
    "memo_id", "chunk_id", "source_file", "reporting_period", "proj_id", "task_id", "task_code", "task_name", "memo_type_label", "text", "char_count",
    "finish_slip_days", "is_quality_related", "quality_category", "labeler_notes", "labeled_by", "labeled_at",
)


def label_export(chunks: DataFrame, tasks: DataFrame, slipped: DataFrame | None = None) -> DataFrame:
    """Memo chunks to be labelled by people, with their task's name and blank label columns; with
    ``slipped`` (task_id, slip_days) only memos of slipped tasks.  Of one chunk id the first (by file
    and place) counts, after that choice."""
    names = tasks.groupBy("task_id").agg(F.max_by("task_name", "ord").alias("task_name"))
    rows = chunks.join(names, "task_id", "left")
    rows = rows.join(slipped.select("task_id", "slip_days"), "task_id") if slipped is not None else rows.withColumn("slip_days", F.lit(None).cast("double"))
    if "source_file" not in rows.columns:
        rows = rows.withColumn("source_file", F.lit(""))
    rest = [c for c in rows.columns if c != "chunk_id"]
    rows = rows.groupBy("chunk_id").agg(F.min_by(F.struct(*rest), F.struct("source_file", "chunk_ord")).alias("r")).select("chunk_id", "r.*")
    given = {
        "memo_id": F.regexp_replace("chunk_id", "^xer-memo-", ""),
        "char_count": F.length("text"),
        "finish_slip_days": F.col("slip_days"),
        "task_name": F.coalesce("task_name", F.lit("")),
    }
    have = set(rows.columns)
    return rows.select(*[given[c].alias(c) if c in given else F.col(c) if c in have else F.lit("").alias(c) for c in LABEL_COLUMNS])


def period_of_name(stem: Column, custom: str | None = None) -> Column:
    """A period from a file's stem: a custom pattern's groups joined by ``-``, else year and month, else a
    cycle token, else the stem."""
    options = []
    if custom is not None:
        # groups are joined; a pattern without groups counts whole
        n = _groups(custom)
        found = F.array_join(F.filter(F.array(*[F.regexp_extract(stem, custom, k) for k in range(1, n + 1)]), lambda x: x != ""), "-") if n else F.regexp_extract(stem, custom, 0)
        options.append(blank_to_null(found))
    month = F.when(stem.rlike(defaults.PERIOD_MONTH), F.concat_ws("-", F.regexp_extract(stem, defaults.PERIOD_MONTH, 1), F.regexp_extract(stem, defaults.PERIOD_MONTH, 2)))
    return F.coalesce(*options, month, blank_to_null(F.regexp_extract(stem, defaults.PERIOD_CYCLE, 1)), stem)


def _groups(pattern: str) -> int:
    import re

    return re.compile(pattern).groups


def programme_of_path(path: Column, default: str) -> Column:
    """The path part behind ``outputs``, else the default."""
    parts = F.split(path, "/")
    at = F.array_position(parts, F.lit("outputs"))
    return F.when(at > 0, F.coalesce(blank_to_null(F.try_element_at(parts, (at + 1).cast("int"))), F.lit(default))).otherwise(F.lit(default))


def period_of_path(path: Column) -> Column:
    return F.regexp_extract(path, r"20\d{2}[-_]\d{2}", 0)


def discover_periods(files: DataFrame, custom: str | None = None) -> DataFrame:
    """(period, source_file) from files (path, depth below the root): in sub-folders the folder's name and
    its first file by name, else the period in the file's name.  Any sub-folder makes all periods folders."""
    parts = F.split("path", "/")
    named = files.select("path", "depth", F.element_at(parts, -1).alias("name"), F.try_element_at(parts, F.lit(-2)).alias("folder"))
    nested = named.where("depth > 0").groupBy("folder").agg(F.min_by("path", "name").alias("source_file")).select(F.col("folder").alias("period"), "source_file")
    flat = named.where("depth = 0").select(period_of_name(F.regexp_replace("name", r"\.[^.]*$", ""), custom).alias("period"), F.col("path").alias("source_file"))
    any_nested = named.agg(F.coalesce(F.max(F.col("depth") > 0), F.lit(False)).alias("any"))
    return nested.union(flat.join(F.broadcast(any_nested.where("NOT any")), how="left_semi")).orderBy("period", "source_file")


def period_pairs(periods: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Each period with the one before it, in text order."""
    before = F.lag("period").over(Window.partitionBy(*groups).orderBy("period"))
    return periods.select(*groups, "period").distinct().withColumn("previous_period", before).where("previous_period IS NOT NULL")


def aggregate_memos(chunks: DataFrame, programme: str = "default") -> tuple[DataFrame, DataFrame]:
    """All memo chunks with text, with programme and source file; and the number of periods and rows read
    (periods counted before blank texts are dropped)."""
    rows = chunks.withColumn("programme", programme_of_path(F.col("source_file"), programme))
    counts = rows.agg(F.count_distinct(blank_to_null(F.col("reporting_period"))).alias("n_periods"), F.count("*").alias("n_rows"), F.count_if(strip("text") != "").alias("n_kept"))
    return rows.where(strip("text") != ""), counts
