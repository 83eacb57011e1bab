"""Settings, word lists, patterns and output columns that results depend on."""

from __future__ import annotations

#: Criticality, completion and exclusion of schedule rows.
CRITICAL_FLOAT_HOURS = 0.0
USE_DRIVING_FLAG = True
DRIVING_TRUE = ("Y",)
COMPLETED_STATUS = ("TK_Complete", "TK_CompleteP")
EXCLUDED_TYPES = ("TT_LOE", "TT_WBS")
IMPACT_SLIP_DAYS = 0.0
FLOAT_SLIP_DAYS = 1.0

#: Memo types that count as planners' notes.
PLANNER_LABELS = (
    "Planners Notes",
    "Planners Notes (CP)",
    "Planner Notes",
    "Programme Notes",
    "General Notes",
    "HS2-CPP-Planners notes + explanations",
    "Core Requirements",
)

#: Words for and against a quality cause, and the score they add up to.
QUALITY_WORDS = (
    "defect", "defects", "rework", "snagging", "snag", "non-conformance", "non conformance", "NCR", "punch list",
    "inspection fail", "failed inspection", "test fail", "remedial", "rectification", "quality hold", "hold point", "ITP", "witness point",
)
OTHER_WORDS = ("weather", "permit", "access", "labour shortage", "material delay", "design change", "client instruction", "force majeure")
QUALITY_BASE, QUALITY_STEP, OTHER_STEP = 0.4, 0.15, 0.2
QUALITY_DECISION, ML_DECISION, HYBRID_FLIP = 0.5, 0.5, 0.6
REVIEW_BELOW = 0.75
SIGNALS = 5

#: Link confidences.
MEMO_CONFIDENCE = 0.95
PROJECT_ROW_CONFIDENCE = 0.4
STRONG_ROW_CONFIDENCE = 0.65
STRONG_SECTIONS = ("cp_float_analysis", "mitigation")

#: Quality labels.
LABEL_TRUE = ("1", "true", "yes", "y", "quality", "quality_issue", "quality-related")
LABEL_FALSE = ("0", "false", "no", "n", "not_quality", "non-quality", "other")

#: Tables of a schedule export: read by default, and those worth dumping.
DEFAULT_TABLES = ("TASK", "PROJECT", "TASKPRED", "MEMOTYPE", "TASKMEMO")
USEFUL_TABLES = ("PROJECT", "PROJWBS", "CALENDAR", "TASK", "TASKPRED", "TASKACTV", "ACTVCODE", "ACTVTYPE", "MEMOTYPE", "TASKMEMO", "WBSMEMO")

#: Headings of narrative documents (Java patterns), page numbers behind them, and references in text.
HEADING_1 = r"^(\d{1,2})\s{1,8}([A-Z][\p{L}\p{N}_\s₂&/()–-]{1,70})\s*$"
HEADING_2 = r"^(\d{1,2}\.\d{1,2})\s{1,8}([A-Z][\p{L}\p{N}_\s&/()–-]{1,70})\s*$"
PAGE_NUMBER = r"\s+(?:[-–]\s*)?\d{1,3}(?:\s*[-–])?\s*$"
ACTIVITY_CODE = r"\b[A-Z][A-Z0-9]{1,5}-\d{3,6}\b"
DATE_REFERENCE = (
    r"(?i)\b(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2}|\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{4})\b"
)

#: Phrases in a heading and the section's type; the first that is found counts.
SECTION_TYPES = (
    ("critical path", "cp_float_analysis"),
    ("float analysis", "cp_float_analysis"),
    ("period progress", "period_progress"),
    ("period overview", "period_overview"),
    ("mitigation & opportunities", "mitigation"),
    ("mitigations", "mitigation"),
    ("mitigation", "mitigation"),
    ("look ahead", "lookahead"),
    ("lookahead", "lookahead"),
    ("key decisions", "key_decisions"),
    ("key decision", "key_decisions"),
    ("programme assumptions", "assumptions"),
    ("assumptions", "assumptions"),
)

#: Periods in file names.
PERIOD_MONTH = r"(20\d{2})[-_]?(\d{2})(?!\d)"
PERIOD_CYCLE = r"(?i)(?:^|[^A-Za-z])(P?fA\d{1,3}|C\d{1,3})(?![A-Za-z\d])"

#: Output columns.
INCIDENT_COLUMNS = (
    "incident_id", "incident_type", "project_row_id", "proj_id", "reporting_period", "previous_period", "primary_task_id", "task_code",
    "task_name", "task_type", "delay_days", "delay_metric", "finish_field_used", "is_critical", "total_float_hours",
)
LINK_COLUMNS = ("incident_id", "chunk_id", "link_method", "confidence", "rationale", "memo_type_label")
QUALITY_COLUMNS = ("incident_id", "is_quality_related", "quality_confidence", "quality_signals", "classifier", "review_status", "has_linked_memo")
MEMO_COLUMNS = ("chunk_id", "document_id", "source", "reporting_period", "proj_id", "task_id", "task_code", "memo_type_id", "memo_type_label", "section_title", "text")
PDF_COLUMNS = (
    "chunk_id", "document_id", "source", "reporting_period", "project_row_id", "section_number", "parent_section_number", "section_type",
    "section_title", "first_page", "text", "activity_codes", "dates",
)
REVIEW_COLUMNS = (
    "incident_id", "incident_type", "project_row_id", "primary_task_id", "task_code", "task_name", "task_type", "delay_days", "is_critical",
    "total_float_hours", "finish_field_used", "link_chunk_id", "link_method", "link_confidence", "link_rationale", "chunk_source",
    "chunk_section_label", "chunk_text",
)
CHANGE_COLUMNS = (
    "task_code", "delta_category", "task_id_curr", "task_id_prev", "task_name", "task_type", "wbs_id", "status_code_prev", "status_code_curr",
    "early_end_date_prev", "early_end_date_curr", "act_end_date_prev", "act_end_date_curr", "finish_slip_calendar_days",
    "total_float_hr_cnt_prev", "total_float_hr_cnt_curr", "total_float_change_hr", "driving_path_flag_prev", "driving_path_flag_curr",
    "is_critical_prev", "is_critical_curr", "finish_field_used_prev", "finish_field_used_curr",
)

#: Text scoring.
NGRAMS = 3
MIN_DF, MAX_DF_SHARE, MAX_FEATURES = 2, 0.95, 50_000
TFIDF_THRESHOLD, EMBED_THRESHOLD, PROMPT_THRESHOLD = 0.35, 0.55, 0.5
BANDS = (("low", 0.0, 0.2), ("med", 0.2, 0.5), ("high", 0.5, 1.0001))
DIGIT_BOOST, ACRONYM_BOOST = 1.5, 1.1
