"""The registered queries as plain SQL over the driver's tables.

Written independently of the DataFrame code: global windows and sorted lists instead
of chunked windows and histograms.
"""

from __future__ import annotations

from edops.plans.fixtures import DISPOSITION_FLAGS, STAMP
from edops.schemas import (
    BI_TABLES, CLINICAL_COLUMNS, DISPOSITIONS, DQ_CHECKS, RANGE_RULES, RECORD_WIDTH, SOURCE_SYSTEM,
    SOURCE_YEAR, SURVEY_LAYOUT, VITAL_FIELDS, WEEKDAY_CODES, names,
)

MINUTES = 180


def rnd(x: str, d: int) -> str:
    f = f"{10**d}::DOUBLE"
    return f"(round_even(({x})::DOUBLE * {f}, 0) / {f})"


def iso(ts: str) -> str:
    short = f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"
    return f"(CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN {short} ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%fZ') END)"


def iso_list(columns: list[str], stamps: set[str]) -> str:
    return ", ".join(f"{iso(c)} AS {c}" if c in stamps else c for c in columns)


def zeros(x: str, width: int) -> str:
    return f"lpad(({x})::VARCHAR, {width}, '0')"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(needs: list[str], sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    return f"WITH {parts}\n{sql}" if parts else sql


ORACLES: dict[str, str] = {}


def oracle(name: str, needs: list[str], sql: str) -> None:
    ORACLES[name] = with_ctes(needs, sql)


# --- Visits and records ---------------------------------------------------------------

RECORD_ORDER = "l_partkey * 1000000000 + round_even(l_extendedprice * 100, 0)::BIGINT"
WAIT = "(CASE WHEN l_tax <> 0 THEN l_quantity::INT * 3 + l_partkey % 7 END)"

cte("visits", [], f"""
SELECT 'V' || l_orderkey || '-' || l_linenumber AS visit_id,
       nullif(l_linenumber % 6, 0) AS triage_level,
       CASE WHEN l_suppkey % 11 <> 0 THEN l_partkey % 130 END AS age,
       CASE WHEN l_orderkey % 13 <> 0 THEN l_orderkey % 24 END AS arrival_hour,
       {WAIT}::DOUBLE AS waiting_time_minutes,
       ({WAIT} + l_orderkey % 240)::DOUBLE AS length_of_stay_minutes,
       l_returnflag = 'R' AS admitted_flag,
       (90 + l_partkey % 30)::DOUBLE AS temperature,
       l_quantity * 7 AS heart_rate,
       5 + l_quantity AS respiratory_rate,
       (60 + l_partkey % 160)::DOUBLE AS systolic_bp,
       (40 + l_orderkey % 120)::DOUBLE AS diastolic_bp,
       (45 + l_partkey % 60)::DOUBLE AS spo2,
       (l_linenumber + l_suppkey % 6)::DOUBLE AS pain_score,
       {RECORD_ORDER} AS record_order,
       CASE WHEN l_partkey % 9 <> 0 THEN substr('abcdefGHIJ', (l_partkey % 10 + 1)::INT, 1) || (l_suppkey % 100) END AS diagnosis_code
FROM lineitem""")

_TEXTS = {
    "visit_month": zeros("1 + l_orderkey % 12", 2),
    "visit_weekday": "(1 + l_orderkey % 8)::VARCHAR",
    "arrival_time": f"CASE WHEN l_orderkey % 13 = 0 THEN '-9' ELSE {zeros('l_orderkey % 24', 2)} || '30' END",
    "waiting_time_minutes": f"CASE WHEN l_tax = 0 THEN '-9' WHEN l_partkey % 41 = 0 THEN '1.5' ELSE {zeros('l_quantity::INT * 3 + l_partkey % 7', 4)} END",
    "length_of_stay_minutes": f"CASE WHEN l_tax = 0 THEN '-9' ELSE {zeros('l_quantity::INT * 3 + l_partkey % 7 + l_orderkey % 240', 4)} END",
    "age": f"CASE WHEN l_suppkey % 11 = 0 THEN '-9' ELSE {zeros('l_partkey % 130', 3)} END",
    "sex": "(1 + l_partkey % 3)::VARCHAR",
    "arrival_by_ambulance": zeros("1 + l_suppkey % 2", 2),
    "temperature_f": zeros("900 + l_partkey % 300", 4),
    "heart_rate": zeros("l_quantity::INT * 7", 3),
    "respiratory_rate": zeros("5 + l_quantity::INT", 3),
    "systolic_bp": zeros("60 + l_partkey % 160", 3),
    "diastolic_bp": zeros("40 + l_orderkey % 120", 3),
    "spo2": zeros("45 + l_partkey % 60", 3),
    "triage_level": zeros("l_linenumber % 7", 2),
    "pain_score": zeros("l_linenumber + l_suppkey % 6", 2),
    "reason_for_visit_code": f"CASE WHEN l_suppkey % 5 <> 0 THEN {zeros('l_partkey % 100000', 5)} ELSE '' END",
    "diagnosis_code": f"CASE WHEN l_partkey % 9 <> 0 THEN 'R' || {zeros('l_suppkey % 1000', 3)} ELSE '' END",
    "hospital_code": zeros("l_suppkey % 1000", 3),
    "patient_code": zeros("l_partkey % 1000", 3),
    "survey_year": f"'{SOURCE_YEAR}'",
    "patient_weight": f"CASE WHEN l_orderkey % 29 = 0 THEN 'n/a' WHEN l_orderkey % 31 = 0 THEN '-1.5' ELSE {zeros('l_partkey % 10000', 5)} || '.50000' END",
}
for _i, _name in enumerate(DISPOSITION_FLAGS):
    _TEXTS[_name] = f"CASE WHEN l_orderkey % 17 = {_i} OR l_partkey % 17 = {_i} THEN '1' ELSE '0' END"


def _record() -> str:
    pieces, position = [], 1
    for name, (start, width) in sorted(SURVEY_LAYOUT.items(), key=lambda item: item[1]):
        if start > position:
            pieces.append(f"repeat(' ', {start - position})")
        pieces.append(f"lpad({_TEXTS[name]}, {width}, ' ')")
        position = start + width
    pieces.append(f"repeat(' ', {RECORD_WIDTH - position + 1})")
    return " || ".join(pieces)


cte("records", [], f"""
SELECT {_record()} AS raw_record, l_orderkey * 10 + l_linenumber AS source_row_number,
       {RECORD_ORDER} AS record_order
FROM lineitem""")

cte("fields", ["records"], "SELECT source_row_number, record_order, " + ", ".join(
    f"trim(substr(raw_record, {start}, {width})) AS {name}" for name, (start, width) in SURVEY_LAYOUT.items()
) + " FROM records")


def code(x: str) -> str:
    return f"(CASE WHEN TRY_CAST(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN {x} END AS INT) >= 0 THEN TRY_CAST({x} AS INT) END)"


HOUR = "CASE WHEN regexp_full_match(arrival_time, '[0-9]{4}') THEN substr(arrival_time, 1, 2)::INT END"
COMPLAINT = "CASE WHEN reason_for_visit_code <> '' THEN 'RFV_CODE:' || reason_for_visit_code END"
WEIGHT = "CASE WHEN TRY_CAST(patient_weight AS DOUBLE) >= 0 THEN TRY_CAST(patient_weight AS DOUBLE) END"
WEEKDAY = "CASE visit_weekday " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in WEEKDAY_CODES.items()) + " END"
SEX = "CASE sex WHEN '1' THEN 'F' WHEN '2' THEN 'M' END"
TRIAGE = f"CASE WHEN {code('triage_level')} BETWEEN 1 AND 5 THEN {code('triage_level')} END"
WEEKEND = "CASE WHEN visit_weekday IN ('1', '7') THEN 1 ELSE 0 END"
DISPOSITION = "CASE " + " ".join(
    f"WHEN {' OR '.join(f'{flag} = ' + chr(39) + '1' + chr(39) for flag in flags)} THEN '{label}'"
    for label, flags in DISPOSITIONS
) + " END"
ADMITTED = "CASE WHEN admit_hospital = '1' OR observation_hospitalized = '1' THEN 1 ELSE 0 END"
RECORD_ID = f"('{SOURCE_YEAR}-' || CASE WHEN length(source_row_number::VARCHAR) < 6 THEN lpad(source_row_number::VARCHAR, 6, '0') ELSE source_row_number::VARCHAR END)"
VISIT_ID = f"('NHAMCS-' || substr(sha256('{SOURCE_SYSTEM}:' || {RECORD_ID}), 1, 20))"

oracle("fixed_width_bronze", ["records"], f"SELECT raw_record, '{SOURCE_SYSTEM}' AS source_system, {SOURCE_YEAR} AS source_year FROM records")
oracle("fixed_width_parse", ["fields"], "SELECT source_row_number, " + ", ".join(f"{f} AS text_{f}" for f in SURVEY_LAYOUT)
       + f", {HOUR} AS arrival_hour, {COMPLAINT} AS chief_complaint, nullif(diagnosis_code, '') AS diagnosis_code FROM fields")
oracle("parse_numeric_codes", ["fields"], f"""
SELECT source_row_number, {code('age')} AS age, {code('visit_month')} AS visit_month,
       {code('temperature_f')}::DOUBLE / 10::DOUBLE AS temperature,
       {code('waiting_time_minutes')}::DOUBLE AS waiting_time_minutes,
       {code('length_of_stay_minutes')}::DOUBLE AS length_of_stay_minutes, {WEIGHT} AS source_weight
FROM fields""")
oracle("code_maps", ["fields"], f"SELECT source_row_number, {SEX} AS sex, {WEEKDAY} AS visit_weekday, {WEEKEND} AS weekend_flag, {TRIAGE} AS triage_level FROM fields")
oracle("disposition_precedence", ["fields"], f"SELECT source_row_number, coalesce({DISPOSITION}, 'NONE') AS disposition, {ADMITTED} AS admitted_flag FROM fields")
oracle("stable_ids", ["records"], f"SELECT source_row_number, {RECORD_ID} AS source_record_id, {VISIT_ID} AS visit_id FROM records")

FLAGS = "concat_ws('|', " + ", ".join(
    f"CASE WHEN NOT ({c} BETWEEN {low} AND {high}) THEN '{'INVALID_TRIAGE' if c == 'triage_level' else 'INVALID_' + c.upper()}' END"
    for c, low, high in RANGE_RULES
) + ", CASE WHEN systolic_bp <= diastolic_bp THEN 'INVALID_BP_RELATION' END, CASE WHEN coalesce(visit_id, '') = '' THEN 'NULL_VISIT_ID' END)"


def marked(source: str) -> str:
    return f"""
SELECT * REPLACE (CASE WHEN occurrence > 1 THEN concat_ws('|', nullif(data_quality_flags, ''), 'DUPLICATE_VISIT_ID') ELSE data_quality_flags END AS data_quality_flags),
       CASE WHEN occurrence > 1 OR data_quality_flags <> '' THEN 'FLAGGED' ELSE 'VALID' END AS data_quality_status
FROM (SELECT *, {FLAGS} AS data_quality_flags, row_number() OVER (PARTITION BY visit_id ORDER BY record_order) AS occurrence FROM {source})"""


cte("typed", ["fields"], f"""
SELECT {VISIT_ID} AS visit_id, NULL::VARCHAR AS patient_id, NULL::VARCHAR AS arrival_time, {HOUR} AS arrival_hour,
       {code('visit_month')} AS visit_month, {WEEKDAY} AS visit_weekday, {code('age')} AS age, {SEX} AS sex,
       {TRIAGE} AS triage_level, {COMPLAINT} AS chief_complaint, {code('temperature_f')}::DOUBLE / 10::DOUBLE AS temperature,
       {", ".join(f"{code(c)}::DOUBLE AS {c}" for c in ["heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score"])},
       nullif(diagnosis_code, '') AS diagnosis_code, NULL::VARCHAR AS diagnosis_description, {DISPOSITION} AS disposition,
       {code('waiting_time_minutes')}::DOUBLE AS waiting_time_minutes, {code('length_of_stay_minutes')}::DOUBLE AS length_of_stay_minutes,
       '{SOURCE_SYSTEM}' AS source_system, {RECORD_ID} AS source_record_id, {WEIGHT} AS source_weight,
       {iso(f"TIMESTAMP '{STAMP}'")} AS ingestion_timestamp, {WEEKEND} AS weekend_flag, {ADMITTED} AS admitted_flag, record_order
FROM fields""")
cte("silver", ["typed"], marked("typed"))
oracle("clean_visits", ["silver"], "SELECT * EXCLUDE (record_order, occurrence) FROM silver")

cte("marked", ["visits"], marked("visits"))
oracle("quality_flags", ["visits"], f"SELECT visit_id, record_order, {FLAGS} AS data_quality_flags, CASE WHEN {FLAGS} = '' THEN 'VALID' ELSE 'FLAGGED' END AS data_quality_status FROM visits")
oracle("duplicate_visits", ["marked"], "SELECT visit_id, record_order, occurrence, data_quality_flags, data_quality_status FROM marked WHERE occurrence > 1")
cte("flag_counts", ["marked"], """
SELECT flag, count(*) AS records FROM (
  SELECT unnest(string_split(data_quality_flags, '|')) AS flag FROM marked WHERE data_quality_flags <> ''
  UNION ALL SELECT data_quality_status FROM marked) GROUP BY flag""")
oracle("dq_flag_counts", ["flag_counts"], "SELECT flag, records FROM flag_counts")
cte("report", ["marked", "flag_counts"], f"""
SELECT TIMESTAMP '{STAMP}' AS generated_at, count(*) AS row_count, count(*) FILTER (WHERE occurrence > 1) AS duplicate_visit_ids,
       count(*) FILTER (WHERE coalesce(visit_id, '') = '') AS null_critical_fields,
       (SELECT coalesce(sum(records), 0)::BIGINT FROM flag_counts WHERE flag = 'INVALID_TRIAGE') AS invalid_triage,
       (SELECT coalesce(sum(records), 0)::BIGINT FROM flag_counts WHERE flag LIKE 'INVALID#_%' ESCAPE '#' AND flag NOT IN ('INVALID_TRIAGE', 'INVALID_AGE')) AS invalid_vitals,
       count(*) FILTER (WHERE data_quality_status = 'FLAGGED') AS records_flagged, 0 AS records_rejected,
       (SELECT string_agg(flag || '=' || records, ';' ORDER BY flag) FROM flag_counts) AS flag_counts
FROM marked""")
oracle("dq_report", ["report"], f"SELECT * REPLACE ({iso('generated_at')} AS generated_at) FROM report")

# --- Cohorts ------------------------------------------------------------------------------

BAND = "CASE WHEN {0} IS NULL THEN 'UNKNOWN' WHEN {0} < 18 THEN '0-17' WHEN {0} < 45 THEN '18-44' WHEN {0} < 65 THEN '45-64' WHEN {0} < 75 THEN '65-74' ELSE '75+' END"
oracle("age_band", ["visits"], f"SELECT visit_id, record_order, age, {BAND.format('age')} AS age_group FROM visits")
oracle("diagnosis_group", ["visits"], "SELECT visit_id, record_order, coalesce(upper(substr(nullif(diagnosis_code, ''), 1, 1)), 'UNKNOWN') AS diagnosis_group FROM visits")

cte("keyed", ["visits"], f"""
SELECT *, coalesce(nullif(triage_level, 0)::VARCHAR, 'ALL') AS t, {BAND.format('age')} AS a, coalesce(arrival_hour::VARCHAR, 'ALL') AS h FROM visits""")
cte("members", ["keyed"], """
SELECT 'TRIAGE_AGE_HOUR' AS match_level, t AS triage_level, a AS age_group, h AS arrival_hour, waiting_time_minutes AS w, length_of_stay_minutes AS s, admitted_flag FROM keyed
UNION ALL SELECT 'TRIAGE_AGE', t, a, 'ALL', waiting_time_minutes, length_of_stay_minutes, admitted_flag FROM keyed
UNION ALL SELECT 'TRIAGE', t, 'ALL', 'ALL', waiting_time_minutes, length_of_stay_minutes, admitted_flag FROM keyed
UNION ALL SELECT 'OVERALL', 'ALL', 'ALL', 'ALL', waiting_time_minutes, length_of_stay_minutes, admitted_flag FROM keyed""")


def _measures(name: str, x: str) -> str:
    ranked = f"list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))[1 + round_even((count({x}) - 1) * 0.9::DOUBLE, 0)::INT]"
    return f"{rnd(f'avg({x})', 2)} AS avg_{name}_minutes, {rnd(f'median({x})', 2)} AS median_{name}_minutes, {rnd(ranked, 2)} AS p90_{name}_minutes"


cte("cohorts", ["members"], f"""
SELECT match_level || '|' || triage_level || '|' || age_group || '|' || arrival_hour AS cohort_key,
       match_level, triage_level, age_group, arrival_hour, count(*) AS patient_count, {_measures('wait', 'w')}, {_measures('los', 's')},
       {rnd("count(*) FILTER (WHERE admitted_flag) / count(*)::DOUBLE", 6)} AS admission_rate
FROM members GROUP BY match_level, triage_level, age_group, arrival_hour""")
oracle("cohort_rollup", ["cohorts"], "SELECT * FROM cohorts")
oracle("bi_historical_context", ["cohorts"], "SELECT * FROM cohorts")
oracle("nearest_rank_p90", ["cohorts"], "SELECT cohort_key, p90_wait_minutes, p90_los_minutes FROM cohorts")

_KEYS = [
    "'TRIAGE_AGE_HOUR|' || t || '|' || a || '|' || h",
    "'TRIAGE_AGE|' || t || '|' || a || '|ALL'",
    "'TRIAGE|' || t || '|ALL|ALL'",
    "'OVERALL|ALL|ALL|ALL'",
]


def matched(source: str, cohorts: str, columns: str) -> str:
    joins = " ".join(f"LEFT JOIN {cohorts} c{i} ON c{i}.cohort_key = {key}" for i, key in enumerate(_KEYS))
    found = ", ".join(
        f"coalesce(c0.{c}, c1.{c}, c2.{c}, c3.{c}) AS {c}" for c in ["cohort_key", "match_level"]
    )
    values = ", ".join(
        f"CASE WHEN c0.cohort_key IS NOT NULL THEN c0.{c} WHEN c1.cohort_key IS NOT NULL THEN c1.{c} WHEN c2.cohort_key IS NOT NULL THEN c2.{c} ELSE c3.{c} END AS m_{c}"
        for c in ["median_wait_minutes", "avg_wait_minutes", "p90_wait_minutes", "admission_rate"]
    )
    return f"SELECT {columns}, {found}, {values} FROM {source} k {joins}"



def keyed_sql(source: str) -> str:
    return f"SELECT *, coalesce(nullif(triage_level, 0)::VARCHAR, 'ALL') AS t, {BAND.format('age')} AS a, coalesce(arrival_hour::VARCHAR, 'ALL') AS h FROM {source}"


cte("sparse", ["visits"], "SELECT * REPLACE (CASE WHEN triage_level <> 5 OR triage_level IS NULL THEN age END AS age, CASE WHEN triage_level <> 4 OR triage_level IS NULL THEN arrival_hour END AS arrival_hour) FROM visits")
cte("sparse_keyed", ["sparse"], keyed_sql("sparse"))
cte("sparse_cohorts", ["sparse_keyed"], "SELECT *, NULL::DOUBLE AS median_wait_minutes, NULL::DOUBLE AS avg_wait_minutes, NULL::DOUBLE AS p90_wait_minutes, NULL::DOUBLE AS admission_rate FROM (" + " UNION ".join(
    f"SELECT {key} AS cohort_key, '{level}' AS match_level FROM sparse_keyed" for key, level in zip(_KEYS, ["TRIAGE_AGE_HOUR", "TRIAGE_AGE", "TRIAGE", "OVERALL"])) + ")")
cte("probes", [], "SELECT o_orderkey AS order_key, (o_orderkey % 7)::INT AS triage_level, CASE WHEN o_custkey % 10 <> 0 THEN (o_custkey % 100)::INT END AS age, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 24)::INT END AS arrival_hour FROM orders")
cte("probe_keys", ["probes"], keyed_sql("probes"))
cte("fallback", ["probe_keys", "sparse_cohorts"], matched("probe_keys", "sparse_cohorts", "k.order_key"))
oracle("cohort_fallback", ["fallback"], "SELECT order_key, cohort_key, match_level FROM fallback")
EXPECTED = "coalesce(nullif(m_median_wait_minutes, 0), nullif(m_avg_wait_minutes, 0), 0)::DOUBLE"
cte("compared", ["keyed", "cohorts"], f"""
SELECT visit_id, record_order, e AS expected_wait_minutes, {rnd('coalesce(waiting_time_minutes, 0) - e', 2)} AS wait_vs_expected_minutes,
       CASE WHEN e <> 0 THEN {rnd('coalesce(waiting_time_minutes, 0) / e', 3)} END AS wait_ratio
FROM (SELECT *, {EXPECTED} AS e FROM ({matched('keyed', 'cohorts', 'k.visit_id, k.record_order, k.waiting_time_minutes')}))""")
oracle("expected_wait", ["compared"], "SELECT * FROM compared")
oracle("wait_variance_category", ["compared"], "SELECT visit_id, record_order, CASE WHEN wait_vs_expected_minutes <= 0 THEN 'At or below expected' WHEN wait_ratio >= 2 THEN 'At least 2x expected' ELSE 'Above expected' END AS wait_variance_category FROM compared")

# --- Events -----------------------------------------------------------------------------------

cte("ev", [], """
SELECT 'E' || event_id AS event_id,
       CASE event_type WHEN 'signup' THEN 'ARRIVAL' WHEN 'error' THEN 'TRIAGE' WHEN 'click' THEN 'VITALS_UPDATE' WHEN 'view' THEN 'STATUS_UPDATE' ELSE CASE WHEN k < 25 THEN 'ADMISSION' ELSE 'DISCHARGE' END END AS event_type,
       1 AS event_version, 'P' || user_id AS patient_id, 'V' || user_id AS visit_id, ts AS event_ts,
       CASE WHEN event_type = 'error' THEN 1 + k % 5 END AS triage_level,
       CASE WHEN event_type = 'signup' THEN (user_id * 37) % 95 END AS age,
       CASE WHEN event_type = 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END END AS sex,
       CASE WHEN event_type = 'click' THEN round_even(value, 0) END AS heart_rate,
       NULL::DOUBLE AS respiratory_rate,
       CASE WHEN event_type = 'click' AND k % 2 = 0 THEN (70 + k % 150)::DOUBLE END AS systolic_bp,
       NULL::DOUBLE AS diastolic_bp,
       CASE WHEN event_type = 'click' AND k % 3 = 0 THEN (85 + k % 16)::DOUBLE END AS spo2,
       NULL::DOUBLE AS pain_score,
       CASE event_type WHEN 'signup' THEN 'WAITING' WHEN 'error' THEN 'TRIAGED' WHEN 'view' THEN 'IN_TREATMENT' END AS status,
       (event_id + o) * 256 + (255 - o) AS seq, event_id AS number, event_id * 2 + (delay > 0)::INT AS time_seq
FROM (SELECT *, (event_id * 7919) % 50 + delay AS o, regexp_extract(props, '\\d+')::INT AS k
      FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 200] ELSE [0] END) AS delay FROM events))""")

_EVENT_FIELDS = [
    "event_id", "event_type", "event_version", "patient_id", "visit_id", "event_time", "triage_level", "age", "sex",
    "heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score", "status",
]
_STAMP_TEXT = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_DAMAGED = {
    "event_type": "CASE WHEN number % 71 = 0 THEN 'UNKNOWN' ELSE event_type END",
    "event_version": "CASE WHEN number % 83 = 0 THEN 2 ELSE 1 END",
    "visit_id": "CASE WHEN number % 89 <> 0 THEN visit_id END",
    "event_time": f"CASE WHEN number % 73 = 0 THEN 'garbage' ELSE {_STAMP_TEXT} END",
    "event_ts": "CASE WHEN number % 73 <> 0 THEN event_ts END",
    # An invalid level is an error and not read.
    "triage_level": "CASE WHEN number % 79 <> 0 THEN triage_level END",
}
cte("raw", ["ev"], "SELECT seq, time_seq, number, number % 97 = 0 AS bad, " + ", ".join(
    f"CASE WHEN number % 97 <> 0 THEN {_DAMAGED.get(f, f)} END AS {f}" for f in [*_EVENT_FIELDS, "event_ts"]) + " FROM ev")
cte("checked", ["raw"], """
SELECT *, CASE WHEN bad THEN 'MALFORMED_JSON' ELSE concat_ws('|',
  CASE WHEN visit_id IS NULL THEN 'MISSING_VISIT_ID' END, CASE WHEN event_type = 'UNKNOWN' THEN 'UNKNOWN_EVENT_TYPE' END,
  CASE WHEN event_version <> 1 THEN 'UNSUPPORTED_EVENT_VERSION' END, CASE WHEN event_ts IS NULL THEN 'INVALID_EVENT_TIME' END,
  CASE WHEN number % 79 = 0 THEN 'INVALID_TRIAGE' END) END AS errors FROM raw""")
oracle("event_parse", ["raw"], f"SELECT seq, {', '.join(_EVENT_FIELDS)}, {iso('event_ts')} AS event_ts FROM raw")
oracle("event_validation", ["checked"], f"SELECT seq, {iso('event_ts')} AS event_ts, errors, (errors = '')::INT AS valid FROM checked")


def ledger_sql(source: str, order: str = "seq", minutes: int | None = MINUTES) -> str:
    """Outcome and episode of each valid event of ``source``; without minutes nothing is late."""
    late = "false" if minutes is None else (
        f"coalesce(event_ts < max(event_ts) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {minutes} MINUTES, false)"
    )
    past = f"ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
SELECT *, CASE WHEN dup THEN 'DUPLICATE' WHEN late THEN 'LATE_EVENT' WHEN NOT live THEN 'STATE_WITHOUT_ARRIVAL' ELSE 'ACCEPTED' END AS outcome
FROM (SELECT *, coalesce(max(CASE WHEN acc AND event_type = 'ARRIVAL' THEN {order} END) OVER (PARTITION BY visit_id ORDER BY {order}) > episode, false) AS live
  FROM (SELECT *, coalesce(max(CASE WHEN acc AND event_type IN ('ADMISSION', 'DISCHARGE') THEN {order} END) OVER (PARTITION BY visit_id {past}), -2) AS episode
    FROM (SELECT *, NOT dup AND NOT late AS acc
      FROM (SELECT *, coalesce(max(CASE WHEN NOT late THEN 1 END) OVER (PARTITION BY event_id {past}), 0) = 1 AS dup
        FROM (SELECT *, {late} AS late FROM {source})))))"""


def fold_sql(ledger: str, order: str = "seq") -> str:
    past = f"(PARTITION BY visit_id, episode ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    vital = " OR ".join(f"{v} IS NOT NULL" for v in VITAL_FIELDS)

    def latest(x: str, ok: str) -> str:
        return f"arg_max({x}, {order}) FILTER (WHERE {ok} AND {x} IS NOT NULL)"

    ended = "max(CASE WHEN event_type IN ('ADMISSION', 'DISCHARGE') THEN event_type END)"
    return f"""
SELECT visit_id, first(patient_id ORDER BY {order}) AS patient_id, first(event_ts ORDER BY {order}) AS arrival_time, max(event_ts) AS last_event_time,
       {latest('triage_level', 'ok_triage')} AS triage_level, first(age ORDER BY {order}) AS age, first(sex ORDER BY {order}) AS sex,
       {", ".join(f"{latest(v, 'ok_vitals')} AS {v}" for v in VITAL_FIELDS)},
       coalesce({ended}, {latest("nullif(status, '')", 'ok_last')}, first(coalesce(status, 'WAITING') ORDER BY {order})) AS current_status,
       count(*) AS event_count, max(event_ts) FILTER (WHERE triage_level IS NOT NULL) AS triage_time, max(event_ts) FILTER (WHERE {vital}) AS vitals_time,
       episode, {ended} IS NOT NULL AS completed
FROM (SELECT *, event_ts >= coalesce(max(event_ts) OVER {past}, event_ts) AS ok_last,
        event_ts >= coalesce(max(CASE WHEN triage_level IS NOT NULL THEN event_ts END) OVER {past}, event_ts) AS ok_triage,
        event_ts >= coalesce(max(CASE WHEN {vital} THEN event_ts END) OVER {past}, event_ts) AS ok_vitals
      FROM {ledger} WHERE outcome = 'ACCEPTED')
GROUP BY visit_id, episode"""


STATE = [
    "visit_id", "patient_id", "arrival_time", "last_event_time", "triage_level", "age", "sex", *VITAL_FIELDS,
    "current_status", "event_count",
]
CLOCKS = ["triage_time", "vitals_time"]
STAMPS = {"arrival_time", "last_event_time", "triage_time", "vitals_time", "last_update_timestamp"}

cte("ledger", ["ev"], ledger_sql("ev"))
cte("valid", ["checked"], "SELECT * FROM checked WHERE errors = ''")
cte("raw_ledger", ["valid"], ledger_sql("valid"))
cte("fold", ["ledger"], fold_sql("ledger"))
cte("raw_fold", ["raw_ledger"], fold_sql("raw_ledger"))
cte("mark", ["ev"], "SELECT max(event_ts) AS now FROM ev")


def active_sql(fold: str, now: str) -> str:
    waited = rnd(f"greatest(0, (epoch_us(({now})) - epoch_us(arrival_time)) / 6e7::DOUBLE)", 2)
    return f"SELECT {', '.join(STATE)}, {waited} AS waiting_minutes, {waited} AS time_in_ed_minutes, last_event_time AS last_update_timestamp FROM {fold} WHERE NOT completed"


cte("active", ["fold", "mark"], active_sql("fold", "SELECT now FROM mark"))
ACTIVE = [*STATE, "waiting_minutes", "time_in_ed_minutes", "last_update_timestamp"]

oracle("late_events", ["ledger"], f"SELECT seq, event_id, {iso('event_ts')} AS event_ts FROM ledger WHERE late")
oracle("dedupe_events", ["ledger"], f"SELECT seq, event_id, visit_id, {iso('event_ts')} AS event_ts FROM ledger WHERE outcome NOT IN ('DUPLICATE', 'LATE_EVENT')")
oracle("orphan_events", ["ledger"], "SELECT seq, event_id, visit_id, event_type FROM ledger WHERE outcome = 'STATE_WITHOUT_ARRIVAL'")
oracle("episodes", ["fold"], f"SELECT {iso_list([*STATE, *CLOCKS, 'episode'], STAMPS)}, completed::INT AS completed FROM fold")
oracle("completed_visits", ["fold"], f"SELECT {iso_list([*STATE, *CLOCKS, 'episode'], STAMPS)} FROM fold WHERE completed")
oracle("active_state", ["active"], f"SELECT {iso_list(ACTIVE, STAMPS)} FROM active")
oracle("quarantine", ["raw_ledger", "checked"], """
SELECT seq, event_id, errors, CASE WHEN bad THEN '{bad' ELSE event_id END AS raw_event FROM checked WHERE errors <> ''
UNION ALL SELECT seq, event_id, outcome, event_id FROM raw_ledger WHERE outcome IN ('LATE_EVENT', 'STATE_WITHOUT_ARRIVAL')""")
cte("counters", ["raw_ledger", "checked"], """
SELECT count(*) FILTER (WHERE outcome IN ('ACCEPTED', 'STATE_WITHOUT_ARRIVAL')) AS records_processed,
       count(*) FILTER (WHERE outcome IN ('LATE_EVENT', 'STATE_WITHOUT_ARRIVAL')) + (SELECT count(*) FROM checked WHERE errors <> '') AS records_rejected,
       count(*) FILTER (WHERE outcome = 'DUPLICATE') AS duplicate_event_ids,
       (SELECT count(*) FROM checked WHERE bad) AS malformed_events,
       count(*) FILTER (WHERE outcome = 'LATE_EVENT') AS late_events,
       (SELECT count(*) FROM checked WHERE errors LIKE '%MISSING%') AS missing_fields
FROM raw_ledger""")
oracle("dq_streaming", ["counters"], "SELECT * FROM counters")
oracle("replay_evidence", ["counters", "raw_fold", "checked"], """
SELECT (SELECT count(*) FROM checked) AS events, (SELECT count(*) FROM raw_fold WHERE NOT completed) AS active_states,
       (SELECT count(*) FROM raw_fold WHERE completed) AS completed_states, * FROM counters""")
oracle("event_log_append", ["ev"], f"SELECT DISTINCT event_id, visit_id, event_type, {iso('event_ts')} AS event_ts, number FROM ev")
oracle("distinct_visits", ["ev"], "SELECT count(DISTINCT visit_id) AS visits, count(DISTINCT patient_id) AS patients FROM ev")

cte("time_ledger", ["ev"], ledger_sql("ev", "time_seq", None))
cte("time_fold", ["time_ledger"], fold_sql("time_ledger", "time_seq"))
oracle("state_merge", ["time_fold"], f"SELECT {iso_list([*STATE, *CLOCKS], STAMPS)} FROM time_fold WHERE NOT completed")
cte("stream_ledger", ["valid"], ledger_sql("valid", "time_seq", None))
cte("stream_fold", ["stream_ledger"], fold_sql("stream_ledger", "time_seq"))
cte("stream_active", ["stream_fold", "valid"], active_sql("stream_fold", "SELECT max(event_ts) FROM valid"))
for _name in ("stream_state", "state_restore"):
    oracle(_name, ["stream_active"], f"SELECT {iso_list(ACTIVE, STAMPS)} FROM stream_active")
oracle("stream_ingest", ["valid"], f"SELECT {', '.join(f for f in _EVENT_FIELDS if f != 'event_time')}, {iso('event_ts')} AS event_ts FROM valid")
oracle("stream_malformed", ["checked"], "SELECT '{bad' AS raw_value FROM checked WHERE bad")

# --- Context and Gold ---------------------------------------------------------------------------

cte("state_keys", ["active"], f"SELECT *, coalesce(nullif(triage_level, 0)::VARCHAR, 'ALL') AS t, {BAND.format('age')} AS a, hour(arrival_time)::VARCHAR AS h FROM active")
cte("waits", ["state_keys", "cohorts"], f"""
SELECT *, {rnd('waiting_minutes - e', 2)} AS v, CASE WHEN e <> 0 THEN {rnd('waiting_minutes / e', 3)} END AS r
FROM (SELECT *, {EXPECTED} AS e FROM ({matched('state_keys', 'cohorts', ', '.join('k.' + c for c in ACTIVE))}))""")
_RULES = [
    ("triage_level = 1", 40, "TRIAGE_LEVEL_1"),
    ("triage_level = 2", 25, "TRIAGE_LEVEL_2"),
    ("r >= 2", 30, "WAIT_AT_LEAST_2X_EXPECTED"),
    ("r >= 1.25 AND r < 2", 15, "WAIT_ABOVE_EXPECTED"),
    ("coalesce(spo2 < 92, false) OR coalesce(heart_rate NOT BETWEEN 45 AND 130, false) OR coalesce(systolic_bp NOT BETWEEN 80 AND 200, false)", 20, "SYNTHETIC_VITAL_FLAG"),
    ("(epoch_us((SELECT now FROM mark)) - epoch_us(last_event_time)) / 6e7::DOUBLE > 30", 15, "NO_UPDATE_OVER_30_MIN"),
    ("(SELECT count(*) FROM active) >= 20", 10, "HIGH_ED_LOAD"),
]
_SCORE = " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p, _ in _RULES)
_REASONS = "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{x}' END" for c, _, x in _RULES) + ")"
cte("enriched", ["waits", "mark", "active"], f"""
SELECT {', '.join(ACTIVE)}, cohort_key AS historical_cohort_key, match_level AS historical_match_level, e AS expected_wait_minutes,
       m_p90_wait_minutes AS historical_p90_wait_minutes, m_admission_rate AS historical_admission_rate, v AS wait_vs_expected_minutes, r AS wait_ratio,
       score AS attention_score, CASE WHEN score >= 70 THEN 'CRITICAL' WHEN score >= 45 THEN 'HIGH' WHEN score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS attention_level,
       CASE WHEN reasons = '' THEN 'NO_OPERATIONAL_ALERT' ELSE reasons END AS attention_reason
FROM (SELECT *, {_SCORE} AS score, {_REASONS} AS reasons FROM waits)""")
oracle("current_ed_state", ["enriched"], "SELECT * REPLACE (" + ", ".join(f"{iso(c)} AS {c}" for c in ["arrival_time", "last_event_time", "last_update_timestamp"]) + ") FROM enriched")
oracle("attention_score", ["enriched"], "SELECT visit_id, attention_score, attention_level FROM enriched")
oracle("attention_reasons", ["enriched"], "SELECT visit_id, attention_reason FROM enriched")
oracle("match_level_distribution", ["enriched"], "SELECT historical_match_level, count(*) AS visits FROM enriched GROUP BY 1")
oracle("wait_vs_history", ["enriched"], "SELECT visit_id, waiting_minutes, expected_wait_minutes, historical_p90_wait_minutes FROM enriched")
oracle("attention_distribution", ["enriched"], "SELECT attention_level, count(*) AS visits, CASE attention_level WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 WHEN 'CRITICAL' THEN 4 ELSE 0 END AS sort_order FROM enriched GROUP BY attention_level")

_SORTED = "list_sort(list(waiting_minutes))"
cte("kpi", ["enriched", "ev"], f"""
SELECT (SELECT max(event_ts) FROM ev) AS as_of, count(*) AS active_patients,
       (SELECT count(*) FROM ev WHERE event_type = 'ARRIVAL') AS arrivals, (SELECT count(*) FROM ev WHERE event_type = 'DISCHARGE') AS discharges,
       (SELECT count(*) FROM ev WHERE event_type = 'ADMISSION') AS admissions, coalesce({rnd('avg(waiting_minutes)', 2)}, 0) AS avg_wait_minutes,
       coalesce({rnd(f'({_SORTED}[(count(*) + 1) // 2] + {_SORTED}[count(*) // 2 + 1]) / 2', 2)}, 0) AS median_wait_minutes,
       count(*) FILTER (WHERE wait_vs_expected_minutes > 0) AS patients_above_expected_wait,
       count(*) FILTER (WHERE attention_level IN ('HIGH', 'CRITICAL')) AS high_attention_patients
FROM enriched""")
oracle("ed_kpis", ["kpi"], f"SELECT * REPLACE ({iso('as_of')} AS as_of) FROM kpi")
cte("bi_kpi", ["kpi", "enriched"], f"""
SELECT as_of AS snapshot_time, active_patients, arrivals, admissions, discharges, avg_wait_minutes, median_wait_minutes, patients_above_expected_wait AS patients_above_expected,
       high_attention_patients, (SELECT count(*) FROM enriched WHERE attention_level = 'CRITICAL') AS critical_attention_patients FROM kpi""")
oracle("bi_kpis", ["bi_kpi"], f"SELECT * REPLACE ({iso('snapshot_time')} AS snapshot_time) FROM bi_kpi")
cte("load", ["ev", "kpi"], """
SELECT window_start, window_start + INTERVAL 15 MINUTES AS window_end,
       greatest(0, sum(arrived - ended) OVER (ORDER BY window_start))::BIGINT AS active_patients, arrived AS new_arrivals, admissions, discharges,
       (SELECT avg_wait_minutes FROM kpi) AS avg_wait_minutes, (SELECT high_attention_patients FROM kpi) AS high_attention_count
FROM (SELECT time_bucket(INTERVAL 15 MINUTES, event_ts) AS window_start, count(*) FILTER (WHERE event_type = 'ARRIVAL') AS arrived,
        count(*) FILTER (WHERE event_type = 'ADMISSION') AS admissions, count(*) FILTER (WHERE event_type = 'DISCHARGE') AS discharges,
        count(*) FILTER (WHERE event_type IN ('ADMISSION', 'DISCHARGE')) AS ended FROM ev GROUP BY 1)""")
_LOAD_ISO = f"SELECT * REPLACE ({iso('window_start')} AS window_start, {iso('window_end')} AS window_end) FROM load"
oracle("ed_load_15min", ["load"], _LOAD_ISO)
oracle("bi_load_15min", ["load"], _LOAD_ISO)
oracle("load_rollup", ["load"], """
SELECT strftime(window_start, '%Y-%m-%d') AS day, max(active_patients) AS active_patients, sum(new_arrivals)::BIGINT AS new_arrivals, sum(admissions)::BIGINT AS admissions,
       sum(discharges)::BIGINT AS discharges, max(avg_wait_minutes) AS avg_wait_minutes, max(high_attention_count) AS high_attention_count FROM load GROUP BY 1""")
_STREAM_LOAD = f"""
SELECT {iso('w')} AS window_start, {iso("w + INTERVAL 15 MINUTES")} AS window_end, new_arrivals, admissions, discharges
FROM (SELECT time_bucket(INTERVAL 15 MINUTES, event_ts) AS w, count(*) FILTER (WHERE event_type = 'ARRIVAL') AS new_arrivals,
        count(*) FILTER (WHERE event_type = 'ADMISSION') AS admissions, count(*) FILTER (WHERE event_type = 'DISCHARGE') AS discharges
      FROM stream_ledger WHERE outcome <> 'DUPLICATE' GROUP BY 1)"""
for _name in ("stream_load_15min", "stream_load_table"):
    oracle(_name, ["stream_ledger"], _STREAM_LOAD)

# --- BI tables and exports -----------------------------------------------------------------------

cte("queue", ["enriched"], """
SELECT visit_id, patient_id, arrival_time, last_event_time, triage_level, upper(current_status) AS current_status, age, sex, heart_rate, systolic_bp, diastolic_bp, spo2,
       waiting_minutes, time_in_ed_minutes, expected_wait_minutes, historical_p90_wait_minutes, wait_vs_expected_minutes, wait_ratio, attention_score,
       upper(attention_level) AS attention_level, replace(attention_reason, '|', '; ') AS attention_reason, historical_cohort_key AS historical_cohort, last_update_timestamp
FROM enriched""")
oracle("bi_active_patients", ["queue"], "SELECT * REPLACE (" + ", ".join(f"{iso(c)} AS {c}" for c in ["arrival_time", "last_event_time", "last_update_timestamp"]) + ") FROM queue")
oracle("active_queue_topk", ["queue"], "SELECT visit_id, attention_score, waiting_minutes, attention_level, attention_reason FROM queue ORDER BY attention_score DESC, waiting_minutes DESC, visit_id LIMIT 10")
oracle("active_queue_filtered", ["queue"], "SELECT visit_id, triage_level, attention_level, current_status, attention_score FROM queue WHERE triage_level IN (1, 2, 3) AND attention_level IN ('HIGH', 'CRITICAL') AND current_status IN ('IN_TREATMENT', 'TRIAGED')")
oracle("read_head", ["queue"], "SELECT visit_id, current_status, attention_score FROM queue ORDER BY visit_id LIMIT 1000")
_DQ_ROWS = " UNION ALL ".join(
    f"SELECT '{check}' AS check_name, '{kind}' AS kind, (SELECT {counter} FROM {'report' if source == 'historical' else 'counters'}) AS record_count, '{text}' AS description"
    for check, source, counter, kind, text in DQ_CHECKS
)
cte("dq", ["report", "counters"], f"""
SELECT check_name, CASE WHEN kind = 'INFO' OR record_count = 0 THEN 'PASS' WHEN kind = 'SOFT' THEN 'WARN' ELSE 'FAIL' END AS status, record_count, description,
       {iso(f"TIMESTAMP '{STAMP}'")} AS generated_at FROM ({_DQ_ROWS})""")
oracle("bi_data_quality", ["dq"], "SELECT * FROM dq")
_TABLES = {"ed_kpis": "bi_kpi", "ed_load_15min": "load", "active_patients": "queue", "historical_context": "cohorts", "data_quality": "dq"}
cte("counts", list(_TABLES.values()), " UNION ALL ".join(
    f"SELECT {i} AS position, '{t}' AS table_name, '{','.join(names(BI_TABLES[t]))}' AS columns, (SELECT count(*) FROM {source}) AS row_count"
    for i, (t, source) in enumerate(_TABLES.items())))
oracle("export_manifest", ["counts"], "SELECT * FROM counts")
oracle("export_validation", ["counts"], "SELECT table_name, row_count, 0 AS repeated_headers, 0 AS secret_rows, 1 AS counts_match, 'PASS' AS status FROM counts")
oracle("publish_release", ["counts"], "SELECT table_name, row_count, row_count AS stored_rows, row_count AS shown_rows, 1 AS matches FROM counts")
oracle("publish_tables", ["counts"], "SELECT table_name, row_count, row_count AS stored_rows, 1 AS matches FROM counts")

# --- Clinical extracts ------------------------------------------------------------------------------

cte("edstays", [], f"""
SELECT o_custkey AS subject_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 200000 END AS hadm_id, o_orderkey AS stay_id, {iso('o_orderdate')} AS intime,
       {iso('(o_orderdate + to_minutes(o_orderkey % 600))')} AS outtime, CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS race, 'WALK IN' AS arrival_transport, CASE WHEN o_orderstatus = 'F' THEN 'HOME' ELSE 'ADMITTED' END AS disposition
FROM orders""")
cte("triage", [], """
SELECT o_custkey AS subject_id, o_orderkey AS stay_id, 97::DOUBLE + (o_orderkey % 40) / 8::DOUBLE AS temperature, (50 + o_orderkey % 90)::DOUBLE AS heartrate,
       (10 + o_orderkey % 20)::DOUBLE AS resprate, CASE WHEN o_orderkey % 10 <> 0 THEN (85 + o_orderkey % 16)::DOUBLE END AS o2sat, (90 + o_orderkey % 90)::DOUBLE AS sbp,
       (50 + o_orderkey % 50)::DOUBLE AS dbp, (o_orderkey % 11)::VARCHAR AS pain, (1 + o_orderkey % 5)::DOUBLE AS acuity,
       CASE o_orderkey % 4 WHEN 0 THEN 'Headache, mild' WHEN 1 THEN 'Says "dizzy"' WHEN 2 THEN 'Fall' || chr(10) || 'and bruise' END AS chiefcomplaint
FROM orders""")
cte("vitalsign", [], f"""
SELECT l_suppkey AS subject_id, l_orderkey AS stay_id, {iso('(l_shipdate + to_minutes(l_linenumber))')} AS charttime, 97::DOUBLE + (l_orderkey % 40) / 8::DOUBLE AS temperature,
       40 + l_quantity AS heartrate, (10 + l_linenumber)::DOUBLE AS resprate, CASE WHEN l_orderkey % 9 <> 0 THEN (85 + l_orderkey % 16)::DOUBLE END AS o2sat,
       (90 + l_partkey % 90)::DOUBLE AS sbp, (50 + l_partkey % 50)::DOUBLE AS dbp, CASE WHEN l_linenumber % 2 = 0 THEN 'Sinus, regular' END AS rhythm, (l_linenumber % 11)::VARCHAR AS pain
FROM lineitem""")
for _t in CLINICAL_COLUMNS:
    oracle(f"csv_bronze_{_t}", [_t], f"SELECT * FROM {_t}")
cte("extracts", list(CLINICAL_COLUMNS), " UNION ALL ".join(
    f"SELECT {i} AS position, '{t}' AS table_name, '{','.join(names(c))}' AS columns, (SELECT count(*) FROM {t}) AS row_count"
    for i, (t, c) in enumerate(CLINICAL_COLUMNS.items())))
for _name in ("source_validation", "source_manifest"):
    oracle(_name, ["extracts"], "SELECT table_name, row_count, 1 AS header_ok FROM extracts")
oracle("load_plan", ["extracts"], "SELECT position, table_name, row_count, 'bronze/' || table_name AS target, 'create only' AS mode FROM extracts")
oracle("load_reconciliation", ["extracts"], "SELECT table_name, columns, row_count, row_count AS stored_rows, 1 AS matches FROM extracts")
oracle("run_metrics", [], "SELECT 'historical' AS component, 'completed' AS event, count(*) AS records_processed, 0 AS records_rejected FROM lineitem")

oracle("order_statistics", [], """
SELECT l_returnflag, l_linestatus, n, max(v) FILTER (WHERE k = floor((n - 1) / 2)) AS lower_median, max(v) FILTER (WHERE k = ceil((n - 1) / 2)) AS upper_median,
       max(v) FILTER (WHERE k = round_even((n - 1) * 0.9::DOUBLE, 0)) AS p90
FROM (SELECT l_returnflag, l_linestatus, l_extendedprice::DOUBLE AS v, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n
      FROM lineitem) GROUP BY l_returnflag, l_linestatus, n""")
