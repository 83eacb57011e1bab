"""Schedule exports end to end, with results worked out by hand."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from driftlens import defaults
from driftlens.operators import narratives as N
from driftlens.operators import snapshots as S
from driftlens.plans import pipelines as R
from driftlens.sources import xer

HEAD = "task_id proj_id wbs_id task_code task_name status_code early_end_date act_end_date total_float_hr_cnt free_float_hr_cnt driving_path_flag".split()


def export(rows, memos=(), types=((1347, "Planners Notes (CP)"), (9, "Other"))):
    """An export's text: rows are (id, code, finish, float, driving flag)."""
    out = ["ERMHDR\t1", "%T\tTASK", "%F\t" + "\t".join(HEAD)]
    out += ["%R\t" + "\t".join([i, "P1", "W1", code, f"Task {code}", "TK_Active", finish, "", hours, "", flag]) for i, code, finish, hours, flag in rows]
    out += ["%T\tMEMOTYPE", "%F\tmemo_type_id\tmemo_type", *[f"%R\t{k}\t{v}" for k, v in types]]
    out += ["%T\tTASKMEMO", "%F\tmemo_id\ttask_id\tmemo_type_id\tproj_id\ttask_memo", *["%R\t" + "\t".join(m) for m in memos], "%E"]
    return "\r\n".join(out)


MARCH = export([("T1", "A-100", "2025-03-15 16:00", "0", "Y"), ("T2", "A-200", "2025-03-25 16:00", "40", "N"), ("T3", "A-300", "2025-04-10 16:00", "80", "N"), ("T5", "A-500", "2025-01-01", "8", "N")])
APRIL = export(
    [("T1", "A-100", "2025-03-22 16:00", "0", "Y"), ("T2", "A-200", "2025-04-02 16:00", "24", "N"), ("T3", "A-300", "2025-04-10 16:00", "80", "N"), ("T4", "A-400", "2025-05-01", "", "N")],
    [
        ("9001", "T2", "1347", "P1", "<html><body><p>A-200 delayed due to <b>rework</b> on prior activity.</p></body></html>"),
        ("9002", "T2", "9", "P1", "not a planner's"),
        ("9003", "T1", "1347", "P1", "<p> </p>"),
    ],
)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("exports")
    (root / "2025-03.xer").write_text(MARCH, encoding="utf-8")
    (root / "2025-04.xer").write_text(APRIL, encoding="utf-8")
    return root


def test_monthly(spark, folder, tmp_path):
    result = R.run_monthly(spark, str(folder / "2025-03.xer").replace("03", "04"), str(folder / "2025-03.xer"), "prog", "2025-04", "2025-03", str(tmp_path / "out"))
    assert (result["impact_count"], result["float_count"], result["quality_flagged"]) == (1, 1, 1)
    rows = {r["task_code"]: r for r in result["tables"]["incidents"].collect()}
    assert set(rows) == {"A-100", "A-200"} and result["tables"]["incidents"].columns == list(defaults.INCIDENT_COLUMNS)
    assert rows["A-100"]["incident_id"] == "prog-2025-04-impact-0001" and rows["A-100"]["delay_days"] == 7.0
    assert rows["A-200"]["incident_id"] == "prog-2025-04-float-0001" and rows["A-200"]["delay_days"] == 8.0
    chunk = result["tables"]["taskmemo_chunks"].collect()
    assert [c["chunk_id"] for c in chunk] == ["xer-memo-9001"] and chunk[0]["text"] == "A-200 delayed due to rework on prior activity."
    quality = {r["incident_id"]: r for r in result["tables"]["quality"].collect()}
    hit = quality["prog-2025-04-float-0001"]
    assert (hit["is_quality_related"], hit["quality_confidence"], hit["quality_signals"], hit["review_status"]) == (True, 0.55, "rework", "needs_review")
    assert quality["prog-2025-04-impact-0001"]["has_linked_memo"] is False
    review = result["tables"]["review"].collect()
    assert len(review) == 2 and sorted(r["link_chunk_id"] for r in review) == ["", "xer-memo-9001"]
    assert (tmp_path / "out" / "manifest.json").exists() and (tmp_path / "out" / "incidents.csv").read_text(encoding="utf-8-sig").startswith("incident_id,")


def test_batch_and_exports(spark, folder, tmp_path):
    (folder / "2025-05.xer").write_text(APRIL.replace("2025-04-10", "2025-04-12"), encoding="utf-8")
    batch = R.run_batch(spark, str(folder), "prog")
    ids = sorted(r["incident_id"] for r in batch["incidents"].collect())
    assert ids == ["prog-2025-04-float-0001", "prog-2025-04-impact-0001", "prog-2025-05-float-0001"]
    skip = spark.createDataFrame([("2025-04",)], "reporting_period string")
    assert [r["incident_id"] for r in R.run_batch(spark, str(folder), "prog", skip=skip)["incidents"].collect()] == ["prog-2025-05-float-0001"]
    summary = [r.asDict() for r in R.batch_summary(batch).collect()]
    assert [(r["reporting_period"], r["previous_period"], r["n_incidents"], r["impact_count"], r["float_count"]) for r in summary] == [("2025-04", "2025-03", 2, 1, 1), ("2025-05", "2025-04", 1, 0, 1)]
    current, previous = str(folder / "2025-04.xer"), str(folder / "2025-03.xer")
    counts = R.export_schedule(spark, current, previous, str(tmp_path / "dump"), all_tables=True)
    assert counts["TASK"] == 4 and counts["delta"] == {"slipped": 2, "stable": 1, "new": 1, "removed": 1, "_total_rows": 5}
    memos = R.export_memos(spark, current, "prog", previous, slipped_only=True).collect()
    assert [(m["memo_id"], m["finish_slip_days"], m["task_name"]) for m in memos] == [("9001", 8.0, "Task A-200")]
    report = R.profile_schedule(spark, current, previous)
    assert report["xer_format"] == "text" and report["tables"]["TASK"]["row_count"] == 4
    assert report["pair_match"][0]["n_matched"] == 3 and report["pair_match"][0]["match_rate_current"] == 0.75


def test_scan_quirks(spark, tmp_path):
    text = "%R\tlost\n%T\tTASK\n%F\ta\t\tb\n%R\t1\t2\t3\n%R\t\tshifted\n%R\tonly\ncontinued\n%T\tX\n%R\tno header\n%T\tTASK\n%F\tb\ta\tb\n%R\t 4 \t5\t6\n"
    (tmp_path / "q.xer").write_bytes(text.encode() + b"%R\t\xff\t7\n")
    scanned = xer.scan_text(spark, str(tmp_path / "q.xer"))
    rows = [(r["a"], r["b"]) for r in xer.table_of(scanned, "TASK", ["a", "b"]).orderBy("ord").collect()]
    # the last header counts for all rows, of a repeated name its last place; an empty first cell is lost
    assert rows == [("2", "3"), ("", ""), ("", ""), ("5", "6"), ("7", "")]
    assert xer.table_of(scanned, "X", ["a"]).count() == 0
    assert [r["table_name"] for r in xer.list_text_tables(spark, str(tmp_path / "q.xer")).collect()] == ["TASK", "X"]


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "s.xer")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE TASK (task_id TEXT, task_code TEXT, total_float_hr_cnt REAL)")
        c.executemany("INSERT INTO TASK VALUES (?, ?, ?)", [("1", "A", 1.5), ("2", None, None)])
    tables = xer.load_tables(spark, path, ("TASK", "TASKMEMO"))
    assert [tuple(r) for r in tables["TASK"].select("task_id", "task_code", "total_float_hr_cnt").orderBy("ord").collect()] == [("1", "A", "1.5"), ("2", "", "")]
    assert tables["TASKMEMO"].count() == 0


def raw(spark, rows):
    schema = "ord long, task_id string, task_code string, early_end_date string, act_end_date string, status_code string, total_float_hr_cnt string, driving_path_flag string, task_type string"
    return S.snapshots(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], schema))


def test_matching(spark):
    previous = raw(spark, [
        ("1", "A", "2025-01-01", "", "", "0", "", ""),
        ("2", "A", "2025-01-05", "", "", "0", "", ""),  # last of a code wins
        ("3", "", "2025-01-01", "", "", "0", "", ""),  # not a snapshot, but its id can be hit
        ("4", "D", "bad date", "", "", "0", "", ""),
        ("", "E", "2025-01-01", "", "", "0", "", ""),
        ("5", "Z", "2025-01-01", "", "", "9", "", ""),
    ])
    current = raw(spark, [
        ("9", "A", "2025-01-09", "", "", "0", "", ""),
        ("8", "A", "2025-01-08", "", "", "", "N", ""),  # duplicates stay
        ("3", "C", "2025-01-09", "", "", "0", "", ""),
        ("4", "D", "2025-01-09", "", "", "0", "", ""),
        ("5", "E", "2025-01-09", "", "", "0", "", ""),  # its code hits a row that is no snapshot: no second try
        ("5", "Y", "2025-01-02 23:00", "", "", "5", "", ""),  # by id
        ("7", "", "2025-01-09", "", "", "0", "", ""),
        ("5", "Q", "2025-01-09", "", "", "1", "", "TT_LOE"),
    ])
    matched = {r["ord"]: r["prev"] for r in S.match(current, previous).collect()}
    assert {k: (v["task_id"] if v else None) for k, v in matched.items()} == {0: "2", 1: "2", 2: None, 3: "4", 4: None, 5: "5", 7: "5"}
    found = {r["incident_id"]: r for r in S.incidents(S.match(current, previous), "p", "c", "b").collect()}
    assert {k: (r["task_code"], r["delay_days"], r["is_critical"]) for k, r in found.items()} == {"p-c-impact-0001": ("A", 4.0, True), "p-c-float-0001": ("A", 3.0, False), "p-c-float-0002": ("Y", 1.0, False)}
    assert {r["project_row_id"] for r in found.values()} == {"unknown"}


def test_snapshot_types(spark):
    rows = raw(spark, [(" 1 ", "A", "2025-01-01", "2025-02-01 08:00", "TK_Complete", "1_000.5", "Y", ""), ("1", "A", "01-Feb-25 16:00", "", "TK_Complete", "12d", "N", ""), ("1", " ", "x", "", "", "-3", "N", "")]).orderBy("ord").collect()
    assert [(str(r["finish_date"]), r["finish_field"], r["float_hours"], r["critical"], r["valid"]) for r in rows] == [
        ("2025-02-01 08:00:00", "act_end_date", 1000.5, True, True),
        ("2025-02-01 16:00:00", "early_end_date", None, False, True),
        ("None", "early_end_date", -3.0, True, False),
    ]


def test_delta_tags(spark):
    previous = raw(spark, [("1", "A", "2025-01-05", "", "TK_Active", "5", "", ""), ("2", "B", "2025-01-05", "", "TK_Active", "0", "", ""), ("", "C", "2025-01-05", "", "", "0", "", "")])
    current = raw(spark, [("1", "A", "2025-01-09", "2025-01-03", "TK_Complete", "0", "", ""), ("2", "B", "2025-01-05", "", "TK_Active", "0", "", ""), ("", "C", "2025-01-06", "", "", "0", "", "")])
    tags = {r["task_code"]: (r["delta_category"], r["total_float_change_hr"]) for r in S.task_changes(current, previous).collect()}
    assert tags == {"A": ("completed,accelerated,became_critical,status_changed", -5.0), "B": ("stable", 0.0), "C": ("stable", None)}


def test_quality(spark):
    texts = ["Rework, concrete; defects!", "rework of defects, weather", "weather", None, "defect rework snag"]
    rows = N.assess(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), 0.75).orderBy("k").collect()
    assert [(r["quality_confidence"], r["is_quality_related"]) for r in rows] == [(1.0, True), (0.65, True), (0.0, False), (0.0, False), (0.85, True)]
    two_and_one = N.assess(spark.createDataFrame([(1, "rework remedial access")], "k int, text string")).first()
    assert two_and_one["is_quality_related"] is False  # 0.4 + 0.15 * 2 - 0.2 is just below a half in doubles
    ml = spark.createDataFrame([(1, "plain", 0.8), (2, "plain", 0.2), (3, "rework remedial snag", 0.2), (4, "rework", 0.6), (5, "", 0.9)], "k int, text string, p double")
    rows = {r["k"]: (r["is_quality_related"], r["quality_confidence"], r["classifier"]) for r in N.assess(ml, ml_probability="p").collect()}
    assert rows == {1: (True, 0.8, "ml_v1"), 2: (False, 0.2, "ml_v1"), 3: (True, 0.85, "hybrid"), 4: (True, 0.6, "hybrid"), 5: (False, 0.0, "keywords")}


def test_links_and_review(spark):
    incidents = spark.createDataFrame([("i1", "impact", "3", "T1"), ("i2", "float", "4", "T2")], "incident_id string, incident_type string, project_row_id string, primary_task_id string")
    for c in defaults.REVIEW_COLUMNS[4:11]:
        incidents = incidents.withColumn(c, F.lit(""))
    chunks = spark.createDataFrame([("c1", "3", "mitigation", "3.2 Mitigation", "one", 0), ("c2", "3", None, "3.1 Other", "two", 1), ("c3", "", "mitigation", "x", "three", 2)], "chunk_id string, project_row_id string, section_type string, section_title string, text string, chunk_ord long")
    links = N.link_project_rows(incidents, chunks)
    assert {(r["chunk_id"], r["confidence"]) for r in links.collect()} == {("c1", 0.65), ("c2", 0.4)}
    texts = {r["incident_id"]: r["text"] for r in N.incident_texts(incidents, links).collect()}
    assert texts == {"i1": "one two", "i2": ""}
    full = N.review(incidents, links, chunks.withColumn("source", F.lit("pdf")).withColumn("source_ord", F.lit(1)))
    assert sorted((r["incident_id"], r["chunk_section_label"], r["chunk_text"]) for r in full.collect()) == [("i1", "3.1 Other", "two"), ("i1", "3.2 Mitigation", "one"), ("i2", "", "")]


def test_sections(spark):
    pages = [
        ("d", 1, "Contents\n1 Overview 3\n2.1 Critical Path 14"),
        ("d", 2, "1 Overview 3\nlisted, so lost\n1 Overview\nFirst line\n\nlast line of 12/03/2025 and AB-1234, AB-1234"),
        ("d", 3, "still overview\n2.1 Critical Path & Float Analysis\nbody\n3 Empty\n4 Phase 2\nlost as well"),
        ("e", 1, "no heading here"),
        ("f", 1, None),
    ]
    frame = spark.createDataFrame(pages, "document string, page_no int, text string")
    rows = N.sections(frame).orderBy("section_ord").collect()
    assert [(r["section_number"], r["parent_number"], r["heading"], r["section_type"], r["first_page"]) for r in rows] == [("1", "1", "Overview", None, 2), ("2.1", "2", "Critical Path & Float Analysis", "cp_float_analysis", 3)]
    assert rows[0]["text"] == "First line\n\nlast line of 12/03/2025 and AB-1234, AB-1234\nstill overview" and rows[1]["text"] == "body"
    chunk = N.section_chunks(N.sections(frame), "prog", "2025-04", {"2": "ROW2"}).orderBy("chunk_ord").collect()
    assert [(c["chunk_id"], c["project_row_id"]) for c in chunk] == [("pdf-d-s1", None), ("pdf-d-s2.1", "ROW2")]
    assert chunk[0]["activity_codes"] == ["AB-1234"] and chunk[0]["dates"] == ["12/03/2025"]
    profile = {r["heading"]: (r["level"], r["first_page"]) for r in N.section_profile(frame).collect()}
    assert profile["2.1 Critical Path & Float Analysis"] == (2, 3) and "3 Empty" in profile
    assert {r["document"]: r["n_codes"] for r in N.document_profile(frame).collect()} == {"d": 2, "e": 0, "f": 0}


@pytest.fixture
def dealt(spark):
    """Rows of the largest partition of a frame, as it is dealt out without Spark's own repairs."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    was = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield lambda df: df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.xxhash64(*df.columns)).alias("h")).agg(F.max("n"), F.max("h")).first()[0]
    for k, v in was.items():
        spark.conf.set(k, v)


def pairs(spark, n):
    """``n`` tasks that all slip by a day, in two snapshots."""
    side = lambda date: S.snapshots(spark.range(n).selectExpr("id AS ord", "string(id) AS task_id", "concat('C', id) AS task_code", f"'{date}' AS early_end_date", "'' AS act_end_date", "'' AS status_code", "string(id % 2) AS total_float_hr_cnt", "'' AS driving_path_flag", "'' AS task_type"))
    return side("2025-01-02"), side("2025-01-01")


def test_matched_rows_are_dealt_out(spark, dealt):
    matched = S.match(*pairs(spark, 2000))
    assert matched.where("prev IS NOT NULL").count() == 2000 and dealt(matched) < 400


def test_incident_numbers_are_dealt_out(spark, dealt):
    """Numbers follow the rows' order over all ranges, for each type."""
    found = S.incidents(S.match(*pairs(spark, 2000)), "p", "c", "b")
    numbers = {r["incident_id"]: r["primary_task_id"] for r in found.collect()}
    assert numbers == {f"p-c-{kind}-{k + 1:04d}": str(2 * k + at) for k in range(1000) for at, kind in enumerate(("impact", "float"))}
    assert dealt(found) < 500


def test_incidents_of_one_project_row_are_dealt_out(spark, dealt):
    incidents = spark.range(2000).selectExpr("string(id) AS incident_id", "if(id >= 0, '7', '8') AS project_row_id")
    chunks = spark.createDataFrame([("c1", "7", "mitigation", "s", "t", 1), ("c2", "8", None, "s", "t", 2)], "chunk_id string, project_row_id string, section_type string, section_title string, text string, chunk_ord long")
    links = N.link_project_rows(incidents, chunks)
    assert links.select("incident_id").distinct().count() == links.count() == 2000 and {r["chunk_id"] for r in links.collect()} == {"c1"}
    assert dealt(links) < 600


def test_incidents_without_links_are_dealt_out(spark, dealt):
    blank = {c: "''" for c in defaults.INCIDENT_COLUMNS}
    incidents = spark.range(2000).selectExpr("string(id) AS incident_id", *[f"{v} AS {c}" for c, v in blank.items() if c != "incident_id"]).withColumn("primary_task_id", F.col("incident_id"))
    chunks = spark.createDataFrame([("c1", "5", "s", "l", "t", 1, 1)], "chunk_id string, task_id string, source string, memo_type_label string, text string, chunk_ord long, source_ord long")
    rows = N.review(incidents, N.link_memos(incidents, chunks), chunks)
    assert rows.count() == 2000 and [r["incident_id"] for r in rows.where("chunk_text = 't'").collect()] == ["5"]
    assert dealt(rows) < 600
