"""Layouts, code maps, rules and table contracts: data, not logic."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: record layout of the public-use survey file -----------------
# field: (one-based start, width)
SURVEY_LAYOUT: dict[str, tuple[int, int]] = {
    "visit_month": (1, 2),
    "visit_weekday": (3, 1),
    "arrival_time": (4, 4),
    "waiting_time_minutes": (8, 4),
    "length_of_stay_minutes": (12, 4),
    "age": (16, 3),
    "sex": (25, 1),
    "arrival_by_ambulance": (33, 2),
    "temperature_f": (48, 4),
    "heart_rate": (52, 3),
    "respiratory_rate": (55, 3),
    "systolic_bp": (58, 3),
    "diastolic_bp": (61, 3),
    "spo2": (64, 3),
    "triage_level": (67, 2),
    "pain_score": (69, 2),
    "reason_for_visit_code": (73, 5),
    "diagnosis_code": (122, 4),
    "no_followup": (488, 1),
    "return_ed": (489, 1),
    "return_refer": (490, 1),
    "left_without_seen": (491, 1),
    "left_before_complete": (492, 1),
    "left_ama": (493, 1),
    "dead_on_arrival": (494, 1),
    "died_in_ed": (495, 1),
    "transfer_nursing": (496, 1),
    "transfer_psych": (497, 1),
    "transfer_other": (498, 1),
    "admit_hospital": (499, 1),
    "observation_hospitalized": (500, 1),
    "observation_discharged": (501, 1),
    "other_disposition": (502, 1),
    "hospital_code": (544, 3),
    "patient_code": (547, 3),
    "survey_year": (2341, 4),
    "patient_weight": (2359, 11),
}
RECORD_WIDTH = 2383
SOURCE_SYSTEM = "CDC_NHAMCS_ED"
SOURCE_YEAR = 2022
VISIT_PREFIX = "NHAMCS-"
RECORD_DIGITS = 6

# Code maps.
SEX_CODES = {"1": "F", "2": "M"}
WEEKDAY_CODES = {
    "1": "Sunday",
    "2": "Monday",
    "3": "Tuesday",
    "4": "Wednesday",
    "5": "Thursday",
    "6": "Friday",
    "7": "Saturday",
}
WEEKEND_CODES = ["1", "7"]

# Dispositions from strongest to weakest, with the flags that set each.
DISPOSITIONS: list[tuple[str, list[str]]] = [
    ("ADMITTED", ["admit_hospital", "observation_hospitalized"]),
    ("DIED_IN_ED", ["died_in_ed"]),
    ("DEAD_ON_ARRIVAL", ["dead_on_arrival"]),
    ("TRANSFERRED", ["transfer_nursing", "transfer_psych", "transfer_other"]),
    ("LEFT_WITHOUT_BEING_SEEN", ["left_without_seen"]),
    ("LEFT_BEFORE_COMPLETE", ["left_before_complete"]),
    ("LEFT_AGAINST_MEDICAL_ADVICE", ["left_ama"]),
    ("OBSERVATION_DISCHARGED", ["observation_discharged"]),
    ("DISCHARGED", ["no_followup", "return_ed", "return_refer"]),
    ("OTHER", ["other_disposition"]),
]

# Inclusive ranges, in the order in which flags are listed.
RANGE_RULES: list[tuple[str, float, float]] = [
    ("age", 0, 120),
    ("triage_level", 1, 5),
    ("temperature", 80, 115),
    ("heart_rate", 1, 300),
    ("respiratory_rate", 1, 100),
    ("systolic_bp", 1, 300),
    ("diastolic_bp", 1, 200),
    ("spo2", 50, 100),
    ("pain_score", 0, 10),
]
FLAG_NAMES = {"triage_level": "INVALID_TRIAGE"}
NOT_VITAL_FLAGS = ["INVALID_TRIAGE", "INVALID_AGE"]

# Age bands as (upper bound, exclusive; label).
AGE_BANDS = [(18, "0-17"), (45, "18-44"), (65, "45-64"), (75, "65-74")]
OLDEST_BAND = "75+"

# Event contract.
EVENT_TYPES = ["ARRIVAL", "TRIAGE", "VITALS_UPDATE", "STATUS_UPDATE", "ADMISSION", "DISCHARGE"]
TERMINAL_TYPES = ["ADMISSION", "DISCHARGE"]
REQUIRED_FIELDS = ["event_id", "event_time", "event_type", "event_version", "patient_id", "visit_id"]
EVENT_VERSION = 1
VITAL_FIELDS = ["heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score"]
WATERMARK_MINUTES = 30

# --- Table schemas --------------------------------------------------------------
BRONZE_VISITS = "raw_record string, source_system string, source_year int, source_filename string, source_row_number long, ingestion_timestamp timestamp"

CLEAN_VISITS = [
    "visit_id", "patient_id", "arrival_time", "arrival_hour", "visit_month", "visit_weekday",
    "weekend_flag", "age", "sex", "triage_level", "chief_complaint", "temperature", "heart_rate",
    "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score", "diagnosis_code",
    "diagnosis_description", "disposition", "admitted_flag", "waiting_time_minutes",
    "length_of_stay_minutes", "source_system", "source_record_id", "source_weight",
    "ingestion_timestamp", "data_quality_flags", "data_quality_status",
]

PATIENT_EVENTS = (
    "event_id string, event_type string, event_version int, patient_id string, visit_id string, "
    "event_time string, triage_level int, age int, sex string, heart_rate double, "
    "respiratory_rate double, systolic_bp double, diastolic_bp double, spo2 double, "
    "pain_score double, status string"
)

# Open visits as stored between micro-batches: the shown state plus its clocks.
STORED_STATE = (
    "visit_id string, patient_id string, arrival_time timestamp, last_event_time timestamp, "
    "triage_level int, age int, sex string, heart_rate double, respiratory_rate double, "
    "systolic_bp double, diastolic_bp double, spo2 double, pain_score double, "
    "current_status string, event_count long, triage_time timestamp, vitals_time timestamp"
)

# Contracts of the five published tables (column order matters).
BI_TABLES: dict[str, str] = {
    "ed_kpis": (
        "snapshot_time timestamp, active_patients long, arrivals long, admissions long, "
        "discharges long, avg_wait_minutes double, median_wait_minutes double, "
        "patients_above_expected long, high_attention_patients long, "
        "critical_attention_patients long"
    ),
    "ed_load_15min": (
        "window_start timestamp, window_end timestamp, active_patients long, new_arrivals long, "
        "admissions long, discharges long, avg_wait_minutes double, high_attention_count long"
    ),
    "active_patients": (
        "visit_id string, patient_id string, arrival_time timestamp, last_event_time timestamp, "
        "triage_level int, current_status string, age int, sex string, heart_rate double, "
        "systolic_bp double, diastolic_bp double, spo2 double, waiting_minutes double, "
        "time_in_ed_minutes double, expected_wait_minutes double, "
        "historical_p90_wait_minutes double, wait_vs_expected_minutes double, wait_ratio double, "
        "attention_score int, attention_level string, attention_reason string, "
        "historical_cohort string, last_update_timestamp timestamp"
    ),
    "historical_context": (
        "cohort_key string, match_level string, triage_level string, age_group string, "
        "arrival_hour string, patient_count long, avg_wait_minutes double, "
        "median_wait_minutes double, p90_wait_minutes double, avg_los_minutes double, "
        "median_los_minutes double, p90_los_minutes double, admission_rate double"
    ),
    "data_quality": (
        "check_name string, status string, record_count long, description string, "
        "generated_at timestamp"
    ),
}

# Catalog of data-quality checks
# (check, report it reads, counter, class, description).
# INFO always passes, SOFT warns above 0, HARD fails above 0.
DQ_CHECKS = [
    ("processed_historical_records", "historical", "row_count", "INFO", "NHAMCS rows processed"),
    ("quality_flagged_records", "historical", "records_flagged", "SOFT", "Records retained with one or more quality flags"),
    ("rejected_historical_records", "historical", "records_rejected", "HARD", "Historical records rejected"),
    ("duplicate_visits", "historical", "duplicate_visit_ids", "HARD", "Duplicate canonical visit identifiers"),
    ("invalid_triage", "historical", "invalid_triage", "HARD", "Visits with an invalid triage category"),
    ("invalid_vitals", "historical", "invalid_vitals", "SOFT", "Vital checks flagged; records remain auditable"),
    ("processed_stream_events", "streaming", "records_processed", "INFO", "Synthetic events processed"),
    ("duplicate_events", "streaming", "duplicate_event_ids", "SOFT", "Duplicate event identifiers ignored"),
    ("malformed_events", "streaming", "malformed_events", "HARD", "Events with malformed JSON"),
    ("late_events", "streaming", "late_events", "SOFT", "Events later than the configured watermark"),
    ("rejected_stream_events", "streaming", "records_rejected", "HARD", "Stream events quarantined or rejected"),
]

# Text that must never appear in an export.
SECRET_MARKERS = ["private key", "client_secret", "password=", "token="]

# Table layout on disk: (partition source column, sort columns).
TABLE_LAYOUT: dict[str, tuple[str | None, list[str]]] = {
    "bronze_visits": ("ingestion_timestamp", ["source_year", "source_filename"]),
    "clean_ed_visits": ("ingestion_timestamp", ["triage_level", "disposition", "data_quality_status"]),
    "historical_cohorts": (None, ["match_level", "triage_level"]),
    "current_ed_state": ("last_update_timestamp", ["triage_level", "current_status", "attention_level"]),
    "ed_kpis": ("as_of", []),
    "ed_load_15min": ("window_start", ["window_start"]),
}

# Day columns that hold a single day per run: their rows need no exchange before a write.
ONE_DAY_PER_RUN = ["ingestion_timestamp", "as_of"]

# Tables whose rows come file by file, so that equal values of their filter columns lie together already.
IN_FILE_ORDER = ["bronze_visits"]

# Columns of the three clinical extracts.
CLINICAL_COLUMNS: dict[str, str] = {
    "edstays": (
        "subject_id long, hadm_id long, stay_id long, intime timestamp, outtime timestamp, "
        "gender string, race string, arrival_transport string, disposition string"
    ),
    "triage": (
        "subject_id long, stay_id long, temperature double, heartrate double, resprate double, "
        "o2sat double, sbp double, dbp double, pain string, acuity double, chiefcomplaint string"
    ),
    "vitalsign": (
        "subject_id long, stay_id long, charttime timestamp, temperature double, "
        "heartrate double, resprate double, o2sat double, sbp double, dbp double, "
        "rhythm string, pain string"
    ),
}

# Column types of schema documents.
DOCUMENT_TYPES = {
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema; needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def names(columns: str) -> list[str]:
    return [column.split()[0] for column in columns.split(", ")]
