"""Schedule operators over the star schema.  Order lines of a year are a snapshot: the part is the
task's code, the order its id, the shipping date its finish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import defaults
from ..functions.text import CONTROL, MARKUP, html_text, normalise, round4
from ..operators import narratives as N
from ..operators import profiles as P
from ..operators import snapshots as S

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PREVIOUS_YEAR, CURRENT_YEAR, LATER_DAYS = 1996, 1997, 366

LINES_SQL = """
    WITH lines AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS task_id, CAST(l_partkey AS VARCHAR) AS task_code, CAST(l_suppkey % 7 AS VARCHAR) AS proj_id,
               CASE WHEN l_linenumber = 7 THEN 'TT_LOE' ELSE 'TT_Task' END AS task_type, l_returnflag AS status_code,
               CASE WHEN l_linestatus = 'F' THEN 'act_end_date' ELSE 'early_end_date' END AS finish_field,
               l_quantity - 10::DOUBLE AS float_hours, (l_quantity - 10::DOUBLE <= 0::DOUBLE OR l_returnflag = 'R') AS critical,
               CAST(l_shipdate AS DATE) AS ship, year(l_shipdate) AS y,
               l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
        FROM lineitem WHERE year(l_shipdate) IN (1996, 1997)
    ), cur AS (SELECT *, ship AS finish FROM lines WHERE y = 1997),
    prev AS (SELECT *, ship + 366 AS finish FROM lines WHERE y = 1996),
    by_code AS (SELECT * FROM prev QUALIFY row_number() OVER (PARTITION BY task_code ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1),
    by_id AS (SELECT * FROM prev QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1),
    matched AS (
        SELECT c.*, coalesce(a.finish, b.finish) AS prev_finish, coalesce(a.critical, b.critical) AS prev_critical
        FROM cur c LEFT JOIN by_code a ON c.task_code = a.task_code LEFT JOIN by_id b ON a.task_code IS NULL AND c.task_id = b.task_id
    ),
    incidents AS (
        SELECT *, CASE WHEN critical AND finish - prev_finish > 0 THEN 'impact' WHEN NOT critical AND finish - prev_finish >= 1 THEN 'float' END AS incident_type
        FROM matched WHERE prev_finish IS NOT NULL AND task_type <> 'TT_LOE'
    ),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY incident_type ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS seq
        FROM incidents WHERE incident_type IS NOT NULL
    )
"""

ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def lines(spark: SparkSession, sf_dir: str, year: int, later: int = 0) -> DataFrame:
    """Typed snapshots from the order lines of a year, finishing ``later`` days later than they were shipped."""
    start, end = F.lit(f"{year}-01-01").cast("timestamp"), F.lit(f"{year + 1}-01-01").cast("timestamp")
    rows = table(spark, sf_dir, "lineitem").where((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
    hours, flag = F.col("l_quantity") - F.lit(10.0), F.when(F.col("l_returnflag") == "R", F.lit("Y")).otherwise(F.lit("N"))
    return rows.select(
        F.col("l_orderkey").cast("string").alias("task_id"),
        F.col("l_partkey").cast("string").alias("task_code"),
        (F.col("l_suppkey") % 7).cast("string").alias("proj_id"),
        F.lit("").alias("task_name"),
        F.when(F.col("l_linenumber") == 7, F.lit("TT_LOE")).otherwise(F.lit("TT_Task")).alias("task_type"),
        F.col("l_linestatus").alias("wbs_id"),
        F.col("l_returnflag").alias("status_code"),
        F.lit("").alias("early_end_date"),
        F.lit("").alias("act_end_date"),
        flag.alias("driving_path_flag"),
        F.date_add(F.to_date("l_shipdate"), later).alias("finish_date"),
        F.when(F.col("l_linestatus") == "F", F.lit("act_end_date")).otherwise(F.lit("early_end_date")).alias("finish_field"),
        hours.alias("float_hours"),
        S.is_critical(hours, flag).alias("critical"),
        F.lit(True).alias("valid"),
        F.struct(*ORDER).alias("ord"),
    )


def both_years(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return lines(spark, sf_dir, CURRENT_YEAR), lines(spark, sf_dir, PREVIOUS_YEAR, LATER_DAYS)


def found_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, previous = both_years(spark, sf_dir)
    return S.incidents(S.match(current, previous), "tpc", str(CURRENT_YEAR), str(PREVIOUS_YEAR))


@query(LINES_SQL + """
    SELECT printf('tpc-1997-%s-%04d', incident_type, seq) AS incident_id, incident_type, proj_id AS project_row_id, proj_id,
           '1997' AS reporting_period, '1996' AS previous_period, task_id AS primary_task_id, task_code, '' AS task_name, task_type,
           CAST(finish - prev_finish AS DOUBLE) AS delay_days, 'finish_slip_calendar_days' AS delay_metric, finish_field AS finish_field_used,
           critical AS is_critical, float_hours AS total_float_hours
    FROM numbered
""")
def snapshot_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_incidents(spark, sf_dir)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1
""")
def last_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return S.last_wins(rows, ["l_orderkey", "l_linenumber"], F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")).drop("l_shipdate")


CHANGES_SQL = LINES_SQL + """,
    cc AS (SELECT * FROM cur QUALIFY row_number() OVER (PARTITION BY task_code ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1),
    tagged AS (
        SELECT coalesce(c.task_code, p.task_code) AS task_code, c.task_id AS cid, p.task_id AS pid,
               CAST(c.finish - p.finish AS DOUBLE) AS slip, c.float_hours - p.float_hours AS float_change,
               CASE WHEN p.task_code IS NULL THEN 'new' WHEN c.task_code IS NULL THEN 'removed'
                    ELSE coalesce(nullif(concat_ws(',',
                        CASE WHEN c.finish_field = 'act_end_date' AND p.finish_field <> 'act_end_date' THEN 'completed' END,
                        CASE WHEN c.finish > p.finish THEN 'slipped' WHEN c.finish < p.finish THEN 'accelerated' END,
                        CASE WHEN c.critical AND NOT p.critical THEN 'became_critical' WHEN p.critical AND NOT c.critical THEN 'lost_criticality' END,
                        CASE WHEN c.status_code <> p.status_code THEN 'status_changed' END), ''), 'stable') END AS delta_category
        FROM cc c FULL OUTER JOIN by_code p ON c.task_code = p.task_code
    )
"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.task_changes(*both_years(spark, sf_dir))


@query(CHANGES_SQL + "SELECT task_code, delta_category, coalesce(cid, '') AS task_id_curr, coalesce(pid, '') AS task_id_prev, slip AS finish_slip_calendar_days, float_change AS total_float_change_hr FROM tagged")
def task_delta_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).select("task_code", "delta_category", "task_id_curr", "task_id_prev", "finish_slip_calendar_days", "total_float_change_hr")


@query(CHANGES_SQL + "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(delta_category, ',')) AS tag FROM tagged) GROUP BY tag UNION ALL SELECT '_total_rows', count(*) FROM tagged")
def delta_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tag_counts(changes(spark, sf_dir))


@query(LINES_SQL + """
    SELECT task_id, CAST(finish - prev_finish AS DOUBLE) AS slip_days FROM matched WHERE prev_finish IS NOT NULL AND finish - prev_finish >= 1
    QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1
""")
def slipped_task_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.slipped_tasks(S.match(*both_years(spark, sf_dir)))


@query("""
    WITH codes AS (SELECT DISTINCT year(o_orderdate) AS y, o_custkey AS k FROM orders WHERE year(o_orderdate) IN (1996, 1997)),
    n AS (SELECT count(*) FILTER (y = 1997) AS c, count(*) FILTER (y = 1996) AS p, count(*) - count(DISTINCT k) AS m FROM codes)
    SELECT c AS n_current, p AS n_previous, m AS n_matched, c - m AS n_added, p - m AS n_removed,
           floor(m / c::DOUBLE * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS match_rate_current,
           floor(m / p::DOUBLE * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS match_rate_previous
    FROM n
""")
def pair_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.col("o_custkey").cast("string").alias("task_code"))
    return P.pair_match(codes.where("y = 1997"), codes.where("y = 1996"))


@query("""
    WITH d AS (SELECT count(*) AS n, count(*) FILTER (trim(coalesce(lang, '')) = '') AS a, count(*) FILTER (regexp_replace(coalesce(text, ''), '\\s', '', 'g') = '') AS b,
                      count(*) FILTER (source IS NULL OR trim(source) = '') AS c, count(*) FILTER (n_chars IS NULL) AS e FROM documents)
    SELECT column_name, n_rows, n_blank, floor(n_blank / n_rows::DOUBLE * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS null_fraction FROM (
        SELECT 'text' AS column_name, n AS n_rows, b AS n_blank FROM d UNION ALL SELECT 'lang', n, a FROM d
        UNION ALL SELECT 'source', n, c FROM d UNION ALL SELECT 'n_chars', n, e FROM d)
""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.null_profile(table(spark, sf_dir, "documents"), ["text", "lang", "source", "n_chars"])


@query("SELECT DISTINCT trim(p_type) AS value FROM part WHERE trim(coalesce(p_type, '')) <> ''")
def distinct_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.distinct_text(table(spark, sf_dir, "part"), "p_type")


#: Memos from orders: a note's task is the customer, its type a nation; some have no id, text, or label.
MEMOS_SQL = """
    WITH chunks AS (
        SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'xer-memo-' || o_custkey || '-' || o_orderkey % 25 ELSE 'xer-memo-' || o_orderkey END AS chunk_id,
               'xer:prog:7:taskmemo' AS document_id, CAST(o_custkey AS VARCHAR) AS task_id, c_name AS task_code, CAST(o_orderkey % 25 AS VARCHAR) AS memo_type_id,
               CASE WHEN n_nationkey % 5 = 4 THEN CAST(n_nationkey AS VARCHAR) ELSE n_name END AS memo_type_label, o_orderpriority || ' & < ' || o_orderstatus AS text, o_orderkey AS chunk_ord
        FROM orders JOIN nation ON n_nationkey = o_orderkey % 25 LEFT JOIN customer ON c_custkey = o_custkey
        WHERE o_orderkey % 11 <> 0 AND n_nationkey IN (1, 2, 4)
    )
"""
MEMO_LABELS = ("NATION_1", "NATION_2", "4")


def raw_memos(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw memos, memo types and tasks as an export has them: text columns and the order of rows."""
    key, html = F.col("o_orderkey").cast("string"), F.concat(F.lit("<p title='a > b'>"), "o_orderpriority", F.lit(" &amp;<!-- no --> &lt; <b>"), "o_orderstatus", F.lit("</b></p>"))
    memos = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderkey") % 10 == 0, F.lit(" ")).otherwise(key).alias("memo_id"), F.col("o_custkey").cast("string").alias("task_id"),
        (F.col("o_orderkey") % 25).cast("string").alias("memo_type_id"), F.lit("7").alias("proj_id"), F.when(F.col("o_orderkey") % 11 == 0, F.lit("<br> &nbsp;")).otherwise(html).alias("task_memo"),
    )
    name = F.when(F.col("n_nationkey") % 5 == 4, F.lit(" ")).otherwise(F.col("n_name"))
    types = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("memo_type_id"), name.alias("memo_type"), F.col("n_nationkey").alias("ord"))
    tasks = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("task_id"), F.col("c_name").alias("task_code"), F.col("c_mktsegment").alias("task_name"), F.col("c_custkey").alias("ord"))
    return memos, types, tasks


def planner_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.memo_chunks(*raw_memos(spark, sf_dir), "prog", "2024-01", MEMO_LABELS)


@query(MEMOS_SQL + "SELECT * FROM chunks")
def dim_lookup_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner_chunks(spark, sf_dir).select("chunk_id", "document_id", "task_id", "task_code", "memo_type_id", "memo_type_label", "text", "chunk_ord")


@query(MEMOS_SQL + """
    SELECT regexp_replace(chunk_id, '^xer-memo-', '') AS memo_id, chunk_id, task_id, task_code, coalesce(c_mktsegment, '') AS task_name, memo_type_label, text,
           CAST(length(text) AS INTEGER) AS char_count, '' AS is_quality_related
    FROM (SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY chunk_ord) = 1) LEFT JOIN customer ON c_custkey = CAST(task_id AS BIGINT)
""")
def label_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.label_export(planner_chunks(spark, sf_dir), raw_memos(spark, sf_dir)[2])
    return found.select("memo_id", "chunk_id", "task_id", "task_code", "task_name", "memo_type_label", "text", "char_count", "is_quality_related")


@query(MEMOS_SQL + """, i AS (SELECT 'inc-' || c_custkey AS incident_id, CAST(c_custkey AS VARCHAR) AS task_id FROM customer)
    SELECT incident_id, coalesce(string_agg(text, ' ' ORDER BY chunk_ord), '') AS text FROM i LEFT JOIN chunks USING (task_id) GROUP BY incident_id
""")
def incident_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = F.col("c_custkey").cast("string")
    incidents = table(spark, sf_dir, "customer").select(F.concat(F.lit("inc-"), task).alias("incident_id"), task.alias("primary_task_id"))
    return N.incident_texts(incidents, N.link_memos(incidents, planner_chunks(spark, sf_dir)))


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS task_id, CASE WHEN l_linenumber = 6 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS task_code,
           CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN strftime(l_shipdate + INTERVAL 3 DAY, '%Y-%m-%d') || ' 08:30' WHEN l_linenumber <> 4 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 16:00' END AS finish,
           CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'act_end_date' ELSE 'early_end_date' END AS finish_field,
           CASE WHEN l_linenumber <> 5 THEN l_quantity - 10 END AS float_hours, (l_linenumber <> 5 AND l_quantity <= 10) OR l_tax > 0.07 AS critical, l_linenumber <> 6 AS valid
    FROM lineitem
""")
def typed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text columns of a schedule export, with malformed dates, numbers and blank codes."""
    day = lambda c, hour: F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit(hour))
    raw = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("task_id"),
        F.when(F.col("l_linenumber") == 6, F.lit(" ")).otherwise(F.col("l_partkey").cast("string")).alias("task_code"),
        F.when(F.col("l_linestatus") == "F", F.lit("TK_Complete")).otherwise(F.lit("TK_Active")).alias("status_code"),
        F.when(F.col("l_linenumber") == 4, F.lit("soon")).otherwise(day("l_shipdate", " 16:00")).alias("early_end_date"),
        F.when(F.col("l_returnflag") == "R", day(F.date_add("l_shipdate", 3), " 08:30")).otherwise(F.lit("")).alias("act_end_date"),
        F.when(F.col("l_linenumber") == 5, F.lit("n/a")).otherwise((F.col("l_quantity") - 10).cast("string")).alias("total_float_hr_cnt"),
        F.when(F.col("l_tax") > 0.07, F.lit("Y")).otherwise(F.lit("N")).alias("driving_path_flag"),
    )
    found = S.snapshots(raw)
    return found.select("task_id", "task_code", F.date_format("finish_date", "yyyy-MM-dd HH:mm").alias("finish"), "finish_field", "float_hours", "critical", "valid")


@query(LINES_SQL + """,
    ids AS (SELECT printf('tpc-1997-%s-%04d', incident_type, seq) AS incident_id, incident_type, CAST(finish - prev_finish AS DOUBLE) AS delay_days, proj_id, l_orderkey AS k FROM numbered)
    SELECT incident_id, incident_type, delay_days,
           CASE WHEN o_orderkey IS NULL THEN '' ELSE 'order-' || CAST(o_orderkey AS VARCHAR) END AS link_chunk_id,
           CASE WHEN o_orderkey IS NULL THEN '' ELSE 'task_memo' END AS link_method, coalesce(o_orderpriority, '') AS chunk_text
    FROM ids LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON k = o_orderkey
""")
def incident_review_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_incidents(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    chunks = orders.select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("chunk_id"), F.col("o_orderkey").cast("string").alias("task_id"), F.lit("orders").alias("source"),
        F.lit("").alias("memo_type_label"), F.lit("").alias("section_title"), F.col("o_orderpriority").alias("text"), F.col("o_orderkey").alias("chunk_ord"), F.lit(0).alias("source_ord"),
    )
    return N.review(found, N.link_memos(found, chunks), chunks).select("incident_id", "incident_type", "delay_days", "link_chunk_id", "link_method", "chunk_text")


@query(LINES_SQL + """,
    ids AS (SELECT printf('tpc-1997-%s-%04d', incident_type, seq) AS incident_id, proj_id FROM numbered),
    s AS (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey < 20)
    SELECT incident_id, 'supplier-' || CAST(s_suppkey AS VARCHAR) AS chunk_id, 'project_row' AS link_method,
           CASE WHEN s_suppkey % 2 = 0 THEN 0.65::DOUBLE ELSE 0.4::DOUBLE END AS confidence
    FROM ids JOIN s ON proj_id = CAST(s_suppkey AS VARCHAR)
""")
def project_row_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    chunks = suppliers.select(
        F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("chunk_id"), F.col("s_suppkey").cast("string").alias("project_row_id"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("mitigation")).otherwise(F.lit("lookahead")).alias("section_type"), F.lit("").alias("section_title"),
        F.col("s_name").alias("text"), F.col("s_suppkey").alias("chunk_ord"),
    )
    return N.link_project_rows(found_incidents(spark, sf_dir), chunks).select("incident_id", "chunk_id", "link_method", "confidence")


@query(LINES_SQL + """
    SELECT count(*) AS n_incidents, count(*) FILTER (incident_type = 'impact') AS n_impact, count(*) FILTER (incident_type = 'float') AS n_float,
           count(*) FILTER (critical) AS n_critical, sum(CAST(finish - prev_finish AS BIGINT)) AS total_days FROM numbered
""")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("incident_type")
    return found_incidents(spark, sf_dir).agg(
        F.count("*").alias("n_incidents"), F.count_if(kind == "impact").alias("n_impact"), F.count_if(kind == "float").alias("n_float"),
        F.count_if("is_critical").alias("n_critical"), F.sum(F.col("delay_days").cast("long")).alias("total_days"),
    )


@query("""
    SELECT lang, CAST(grouping(lang) AS INTEGER) AS is_total, count(*) AS n_rows, count(quality) AS n_labeled, count(*) FILTER (quality = 1) AS n_yes, count(*) FILTER (quality = 0) AS n_no,
           floor(count(*) FILTER (quality = 1) / count(quality)::DOUBLE * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS yes_rate
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ROLLUP (lang)
""")
def label_stats_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return P.label_stats(rows, P.parse_label("quality"), "lang")


#: Words of the corpus that stand for quality and other causes in queries.
FOR, AGAINST = ("License", "token", "ation", "ung", "idiot"), ("example", "cher")

KEYWORD_SQL = f"""
    WITH k AS (
        SELECT doc_id, list_filter({list(FOR)!r}, lambda w: contains(lower(text), lower(w))) AS hits,
               len(list_filter({list(AGAINST)!r}, lambda w: contains(lower(text), lower(w)))) AS down
        FROM documents
    ), s AS (
        SELECT *, CASE WHEN len(hits) = 0 THEN 0::DOUBLE ELSE least(1::DOUBLE, 0.4::DOUBLE + 0.15::DOUBLE * len(hits)) END AS up FROM k
    ), f AS (SELECT *, CASE WHEN len(hits) > 0 AND down > 0 THEN greatest(0::DOUBLE, up - 0.2::DOUBLE * down) ELSE up END AS score FROM s)
"""


@query(KEYWORD_SQL + """
    SELECT doc_id, score >= 0.5::DOUBLE AS is_quality_related, floor(score * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS quality_confidence,
           array_to_string(hits[1:5], '; ') AS quality_signals, 'keywords' AS classifier,
           CASE WHEN score < 0.75::DOUBLE THEN 'needs_review' ELSE 'auto' END AS review_status, true AS has_linked_memo
    FROM f
""")
def keyword_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.assess(table(spark, sf_dir, "documents").select("doc_id", "text"), quality=FOR, other=AGAINST)


@query(KEYWORD_SQL + """,
    m AS (SELECT f.*, quality * 0.7::DOUBLE + 0.1::DOUBLE AS ml FROM f LEFT JOIN labels USING (doc_id)),
    r AS (SELECT *, len(hits) > 0 AND ml < 0.5::DOUBLE AND score >= 0.6::DOUBLE AS flips FROM m),
    c AS (SELECT *, CASE WHEN ml IS NULL THEN score WHEN len(hits) > 0 AND (ml >= 0.5::DOUBLE OR flips) THEN greatest(ml, score) ELSE ml END AS conf FROM r)
    SELECT doc_id, CASE WHEN ml IS NULL THEN score >= 0.5::DOUBLE ELSE ml >= 0.5::DOUBLE OR flips END AS is_quality_related,
           floor(conf * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS quality_confidence,
           CASE WHEN ml IS NULL THEN 'keywords' WHEN len(hits) > 0 THEN 'hybrid' ELSE 'ml_v1' END AS classifier
    FROM c
""")
def hybrid_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 0.7 + 0.1).alias("ml"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id", "left")
    return N.assess(rows, ml_probability="ml", quality=FOR, other=AGAINST).select("doc_id", "is_quality_related", "quality_confidence", "classifier")


@query(r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s\p{Z}\-/]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS normalised FROM documents
""")
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", normalise("text").alias("normalised"))


@query(r"""
    SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, '\b[A-Z][A-Z0-9]{1,5}-\d{3,6}\b'))) AS codes,
           list_sort(list_distinct(regexp_extract_all(html, '(?i)\b(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2}|\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{4})\b', 1))) AS dates
    FROM pages
""")
def extract_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, dates = N.text_references(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", codes.alias("codes"), dates.alias("dates"))


#: Entities of the pages, in an order in which none makes another.
ENTITIES = (("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def _resolved(column: str) -> str:
    for entity, sign in ENTITIES:
        column = f"replace({column}, '{entity}', '{sign}')"
    return column


@query(rf"""
    WITH a AS (SELECT page_id, regexp_replace(html, '{CONTROL}', ' ', 'g') AS t FROM pages),
    b AS (SELECT page_id, regexp_replace({_resolved("t")}, '{MARKUP.replace("'", "''")}', ' ', 'g') AS t FROM a)
    SELECT page_id, trim(regexp_replace(t, '[\s\x{{a0}}]+', ' ', 'g')) AS plain FROM b
""")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html_text("html").alias("plain"))


@query("""
    WITH p AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period FROM orders)
    SELECT period, lag(period) OVER (ORDER BY period) AS previous_period FROM p QUALIFY previous_period IS NOT NULL
""")
def period_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.period_pairs(table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("period")))


@query(r"""
    WITH n AS (SELECT page_id, regexp_extract(url, '([^/?#]*)/?([?#].*)?$', 1) AS stem FROM pages)
    SELECT page_id, coalesce(CASE WHEN regexp_matches(stem, '20\d{2}[-_]?\d{2}($|\D)') THEN regexp_extract(stem, '(20\d{2})[-_]?(\d{2})($|\D)', 1) || '-' || regexp_extract(stem, '(20\d{2})[-_]?(\d{2})($|\D)', 2) END,
           nullif(regexp_extract(stem, '(?i)(?:^|[^A-Za-z])(P?fA\d{1,3}|C\d{1,3})($|[^A-Za-z\d])', 1), ''), stem) AS period FROM n
""")
def period_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.regexp_extract("url", r"([^/?#]*)/?([?#].*)?$", 1)
    return table(spark, sf_dir, "pages").select("page_id", P.period_of_name(stem).alias("period"))


#: Pages of documents made from orders: headings of two levels, entries of a table of contents, and contents pages.
PAGES_SQL = r"""
    WITH l AS (
        SELECT CAST(o_custkey % 50 AS VARCHAR) AS document, o_orderkey AS page_no, unnest([1, 2, 3]) AS i,
               unnest([CASE o_orderkey % 3 WHEN 0 THEN (o_orderkey % 9 + 1) || ' Period Progress' WHEN 1 THEN (o_orderkey % 9 + 1) || '.' || (o_orderkey % 4 + 1) || ' Critical Path' ELSE o_orderpriority END,
                       'body ' || o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '4 Mitigation Works 12' END]) AS line
        FROM orders WHERE o_orderkey % 13 <> 0
    ), h AS (SELECT *, nullif(regexp_extract(line, '^(\d+(\.\d+)?) [A-Z]', 1), '') AS number FROM l WHERE line IS NOT NULL),
    g AS (SELECT *, count(number) OVER (PARTITION BY document ORDER BY page_no, i) AS s FROM h),
    found AS (
        SELECT document, CAST(s AS INTEGER) AS section_ord, max(number) AS section_number, max(line) FILTER (number IS NOT NULL) AS section_title,
               CAST(min(page_no) FILTER (number IS NOT NULL) AS INTEGER) AS first_page, string_agg(line, chr(10) ORDER BY page_no, i) FILTER (number IS NULL) AS text
        FROM g WHERE s > 0 GROUP BY document, s
    )
"""


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    number = (key % 9 + 1).cast("string")
    top = F.when(key % 3 == 0, F.concat(number, F.lit("  Period Progress"))).when(key % 3 == 1, F.concat(number, F.lit("."), (key % 4 + 1).cast("string"), F.lit(" Critical Path "))).otherwise(F.col("o_orderpriority"))
    text = F.concat_ws("\n", F.when(key % 13 == 0, F.lit(" Table of Contents")), top, F.concat(F.lit("  body "), key.cast("string"), F.lit("  ")), F.when(key % 7 == 0, F.lit("4 Mitigation Works 12")))
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("string").alias("document"), key.alias("page_no"), text.alias("text"))


@query(PAGES_SQL + r"""
    SELECT 'pdf-' || document || '-s' || section_number AS chunk_id, 'pdf:prog:' || document AS document_id, CASE WHEN section_number LIKE '3%' THEN 'row-3' END AS project_row_id, section_number,
           split_part(section_number, '.', 1) AS parent_section_number, CASE WHEN section_title LIKE '%Period%' THEN 'period_progress' ELSE 'cp_float_analysis' END AS section_type,
           section_title, first_page, text, CAST(section_ord AS BIGINT) AS chunk_ord
    FROM found WHERE section_title NOT LIKE '% 12' AND text IS NOT NULL
""")
def section_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = N.section_chunks(N.sections(order_pages(spark, sf_dir)), "prog", "2024-01", {"3": "row-3"})
    return chunks.select("chunk_id", "document_id", "project_row_id", "section_number", "parent_section_number", "section_type", "section_title", "first_page", "text", "chunk_ord")


@query("""
    SELECT count(DISTINCT nullif(role, '')) AS n_periods, count(*) AS n_rows, count(*) FILTER (regexp_replace(text, '\\s', '', 'g') <> '') AS n_kept FROM conversations
""")
def aggregate_memos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("role").alias("reporting_period"), "text", F.concat(F.lit("outputs/prog/"), F.col("conv_id").cast("string")).alias("source_file"))
    return P.aggregate_memos(rows)[1]


@query(r"""
    SELECT conv_id AS document, count(*) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS n_chars,
           CAST(sum(len(regexp_extract_all(text, '\b[A-Z][A-Z0-9]{1,5}-\d{3,6}\b'))) AS BIGINT) AS n_codes,
           CAST(sum(len(regexp_extract_all(text, '(?i)\b(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2}|\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{4})\b'))) AS BIGINT) AS n_dates
    FROM conversations GROUP BY conv_id
""")
def document_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.document_profile(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document"), "text"))


@query("SELECT doc_id, substr(sha256(text), 1, 12) AS hash FROM documents")
def text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", P.file_hash(F.col("text").cast("binary")).alias("hash"))


__all__ = ["ORACLE_SQL", "QUERIES", "defaults", "query", "round4", "table"]
