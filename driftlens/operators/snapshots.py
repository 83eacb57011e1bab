"""Typed task snapshots, cascading matching of two snapshots, incidents and change reports.

A raw table has the export's string columns and ``ord``, the row's place in its source.  ``groups``
names columns (programme, period, ..) that all rows of one comparison share; they are part of every
key, so any number of comparisons runs as one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import defaults
from ..functions.text import blank_to_null, number, text_or_blank, timestamp

RAW = ("task_id", "proj_id", "task_code", "task_name", "task_type", "wbs_id", "status_code", "early_end_date", "act_end_date", "total_float_hr_cnt", "free_float_hr_cnt", "driving_path_flag")


def is_critical(float_hours: Column, flag: Column, threshold: float = defaults.CRITICAL_FLOAT_HOURS, use_flag: bool = defaults.USE_DRIVING_FLAG, true_values: Sequence[str] = defaults.DRIVING_TRUE) -> Column:
    """Float known and at most the threshold, or the driving flag set; never null."""
    by_float = F.coalesce(float_hours <= F.lit(float(threshold)), F.lit(False))
    return by_float | F.coalesce(flag.isin(*true_values), F.lit(False)) if use_flag else by_float


def snapshots(raw: DataFrame, completed: Sequence[str] = defaults.COMPLETED_STATUS, **critical) -> DataFrame:
    """``raw`` with typed columns added: finish_date, finish_field, float_hours, free_float_hours,
    critical, and ``valid`` (neither id nor code blank).  Missing columns count as blank."""
    have = {c.lower() for c in raw.columns}
    rows = raw.withColumns({c: text_or_blank(c) if c in have else F.lit("") for c in RAW})
    actual, early = timestamp("act_end_date"), timestamp("early_end_date")
    done = F.col("status_code").isin(*completed) & actual.isNotNull()
    return rows.withColumns(
        {
            "finish_date": F.when(done, actual).otherwise(early),
            "finish_field": F.when(done, F.lit("act_end_date")).otherwise(F.lit("early_end_date")),
            "float_hours": number("total_float_hr_cnt"),
            "free_float_hours": number("free_float_hr_cnt"),
            "critical": is_critical(number("total_float_hr_cnt"), F.col("driving_path_flag"), **critical),
            "valid": (F.col("task_id") != "") & (F.col("task_code") != ""),
        }
    )


def last_wins(df: DataFrame, keys: Sequence[str], order: Column | str = "ord") -> DataFrame:
    """The last row of each key, by an aggregate with partial sums (no sort of whole groups)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(*keys, "_last.*")


def match(current: DataFrame, previous: DataFrame, groups: Sequence[str] = (), keys: Sequence[str] = ("task_code", "task_id"), order: Column | str = "ord") -> DataFrame:
    """Every valid row of ``current`` with ``prev``, a struct of the previous row or null.

    Keys are tried in turn, and the first that hits a previous row decides; of previous rows with
    one key the last counts.  A hit that isn't a valid snapshot gives null without a further try."""
    out = current.where("valid").withColumn("prev", F.lit(None).cast(previous.schema)).withColumn("_hit", F.lit(False))
    for k, key in enumerate(keys):
        side, at = f"_side{k}", f"_key{k}"
        index = previous.where(F.col(key) != "").groupBy(*groups, F.concat(F.lit("="), key).alias(at)).agg(F.max_by(F.struct(*previous.columns), order).alias(side))
        index = index.select(*[F.col(g).alias(f"_g_{g}") for g in groups], at, side)
        # rows that look nothing up get keys of their own that hit nothing: nulls would all go to one task
        row = F.xxhash64(*[F.col(c) for c in keys], F.col(order) if isinstance(order, str) else order)
        wanted = F.coalesce(F.when(~F.col("_hit"), F.concat(F.lit("="), blank_to_null(F.col(key)))), F.concat(F.lit("-"), row.cast("string")))
        on = reduce_and([wanted == F.col(at), *[F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]])
        out = out.join(index, on, "left").withColumn("prev", F.coalesce("prev", side)).withColumn("_hit", F.col("_hit") | F.col(side).isNotNull())
        out = out.drop(at, side, *[f"_g_{g}" for g in groups])
    return out.withColumn("prev", F.when(F.col("prev.valid"), F.col("prev"))).drop("_hit")


def reduce_and(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def slip_days(current: Column, previous: Column) -> Column:
    """Calendar days between the dates, time of day dropped; null if either is."""
    return F.datediff(F.to_date(current), F.to_date(previous)).cast("double")


def incident_type(critical: Column, slip: Column, impact_days: float = defaults.IMPACT_SLIP_DAYS, float_days: float = defaults.FLOAT_SLIP_DAYS) -> Column:
    """``impact`` for critical rows that slip by more than one threshold, ``float`` for others from the other threshold up."""
    return F.when(critical & (slip > F.lit(float(impact_days))), F.lit("impact")).when(~critical & (slip >= F.lit(float(float_days))), F.lit("float"))


def incidents(
    matched: DataFrame,
    programme: Column | str,
    period: Column | str,
    previous_period: Column | str,
    impact_days: float = defaults.IMPACT_SLIP_DAYS,
    float_days: float = defaults.FLOAT_SLIP_DAYS,
    excluded: Sequence[str] = defaults.EXCLUDED_TYPES,
    project_row: Column | None = None,
    order: Sequence[str] = ("ord",),
) -> DataFrame:
    """The incidents among matched rows (see ``match``), numbered per programme, period and type in row order.

    They are sorted by ranges and kept on disk, so that their places stay what they are; a number is the
    place within a range and the counts of the ranges before, of which there is a row for each range and type."""
    as_column = lambda c: F.lit(c) if isinstance(c, str) else c
    rows = matched.where(F.col("prev").isNotNull() & ~F.col("task_type").isin(*excluded))
    rows = rows.withColumns({"_programme": as_column(programme), "reporting_period": as_column(period), "previous_period": as_column(previous_period)})
    rows = rows.withColumn("delay_days", slip_days(F.col("finish_date"), F.col("prev.finish_date")))
    rows = rows.withColumn("incident_type", incident_type(F.col("critical"), F.col("delay_days"), impact_days, float_days)).where("incident_type IS NOT NULL")
    given = [project_row] if project_row is not None else []
    kinds = ["_programme", "reporting_period", "incident_type"]
    rows = rows.select(
        *kinds,
        F.coalesce(*[blank_to_null(c) for c in (*given, F.col("proj_id"), F.col("prev.proj_id"))], F.lit("unknown")).alias("project_row_id"),
        F.coalesce(blank_to_null(F.col("proj_id")), F.col("prev.proj_id")).alias("proj_id"),
        "previous_period",
        F.col("task_id").alias("primary_task_id"),
        "task_code",
        "task_name",
        "task_type",
        "delay_days",
        F.lit("finish_slip_calendar_days").alias("delay_metric"),
        F.col("finish_field").alias("finish_field_used"),
        F.col("critical").alias("is_critical"),
        F.col("float_hours").alias("total_float_hours"),
        *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)],
    )
    rows = rows.orderBy(*kinds, *[f"_o{k}" for k in range(len(order))]).drop(*[f"_o{k}" for k in range(len(order))])
    rows = rows.withColumns({"_at": F.monotonically_increasing_id(), "_range": F.spark_partition_id()}).persist(StorageLevel.DISK_ONLY)
    ranges = rows.groupBy(*kinds, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*kinds).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(kinds)], F.col("_range").alias("_k"), (before - F.col("_first") + 1).alias("_add"))
    rows = rows.join(F.broadcast(ranges), reduce_and([F.col("_range") == F.col("_k"), *[F.col(c).eqNullSafe(F.col(f"_k{k}")) for k, c in enumerate(kinds)]]))
    number_ = F.format_string("%s-%s-%s-%04d", "_programme", "reporting_period", "incident_type", F.col("_at") + F.col("_add"))
    return rows.select(number_.alias("incident_id"), *defaults.INCIDENT_COLUMNS[1:])


def slipped_tasks(matched: DataFrame, min_days: float = 1.0, groups: Sequence[str] = (), order: Column | str = "ord") -> DataFrame:
    """(task_id, slip_days) of matched rows that slip by ``min_days`` or more; of one id the last counts."""
    rows = matched.where(F.col("prev").isNotNull()).withColumn("slip_days", slip_days(F.col("finish_date"), F.col("prev.finish_date")))
    rows = rows.where(F.col("slip_days") >= float(min_days))
    return rows.groupBy(*groups, "task_id").agg(F.max_by("slip_days", order).alias("slip_days"))


def delta_tags(current: Column, previous: Column, slip: Column) -> Column:
    """Comma-joined tags of a change between two snapshot structs (null where there is none)."""
    has_cur, has_prev = current.isNotNull(), previous.isNotNull()
    done_cur = F.coalesce(F.contains(current["finish_field"], F.lit("act")), F.lit(False))
    done_prev = F.coalesce(F.contains(previous["finish_field"], F.lit("act")), F.lit(False))
    changed = has_cur & has_prev
    tags = F.array_compact(
        F.array(
            F.when(done_cur & ~done_prev, F.lit("completed")),
            F.when(slip > 0, F.lit("slipped")).when(slip < 0, F.lit("accelerated")),
            F.when(changed & (current["critical"] != previous["critical"]), F.when(current["critical"], F.lit("became_critical")).otherwise(F.lit("lost_criticality"))),
            F.when(changed & (current["status_code"] != previous["status_code"]), F.lit("status_changed")),
        )
    )
    joined = F.coalesce(blank_to_null(F.array_join(tags, ",")), F.lit("stable"))
    return F.when(has_cur & ~has_prev, F.lit("new")).when(has_prev & ~has_cur, F.lit("removed")).otherwise(joined)


def task_changes(current: DataFrame, previous: DataFrame, groups: Sequence[str] = (), order: Column | str = "ord") -> DataFrame:
    """One row for each task code on either side (blank codes dropped, last row of a code wins) with the
    change's tags and both sides' values; columns as in ``defaults.CHANGE_COLUMNS``, behind ``groups``."""
    keys = [*groups, "task_code"]

    def side(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        return df.where("task_code <> ''").groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias(name))

    both = side(current, "_c").join(side(previous, "_p"), keys, "full_outer")
    cur, prev = F.when(F.col("_c.valid"), F.col("_c")), F.when(F.col("_p.valid"), F.col("_p"))
    both = both.withColumn("c", cur).withColumn("p", prev)
    slip = slip_days(F.col("c.finish_date"), F.col("p.finish_date"))
    raw = lambda name: F.coalesce(F.col(f"_c.{name}"), F.col(f"_p.{name}"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return both.select(
        *groups,
        "task_code",
        delta_tags(F.col("c"), F.col("p"), slip).alias("delta_category"),
        blank("c.task_id").alias("task_id_curr"),
        blank("p.task_id").alias("task_id_prev"),
        raw("task_name").alias("task_name"),
        raw("task_type").alias("task_type"),
        raw("wbs_id").alias("wbs_id"),
        blank("p.status_code").alias("status_code_prev"),
        blank("c.status_code").alias("status_code_curr"),
        blank("_p.early_end_date").alias("early_end_date_prev"),
        blank("_c.early_end_date").alias("early_end_date_curr"),
        blank("_p.act_end_date").alias("act_end_date_prev"),
        blank("_c.act_end_date").alias("act_end_date_curr"),
        slip.alias("finish_slip_calendar_days"),
        F.col("p.float_hours").alias("total_float_hr_cnt_prev"),
        F.col("c.float_hours").alias("total_float_hr_cnt_curr"),
        (F.col("c.float_hours") - F.col("p.float_hours")).alias("total_float_change_hr"),
        blank("p.driving_path_flag").alias("driving_path_flag_prev"),
        blank("c.driving_path_flag").alias("driving_path_flag_curr"),
        F.col("p.critical").alias("is_critical_prev"),
        F.col("c.critical").alias("is_critical_curr"),
        blank("p.finish_field").alias("finish_field_used_prev"),
        blank("c.finish_field").alias("finish_field_used_curr"),
    )


def tag_counts(changes: DataFrame) -> DataFrame:
    """(tag, n) over all changes, and the number of rows as ``_total_rows``."""
    tags = changes.select(F.explode(F.split("delta_category", ",")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return tags.union(changes.agg(F.count("*").alias("n")).select(F.lit("_total_rows"), "n"))
