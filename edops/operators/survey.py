"""Fixed-width survey records to clean visits."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from edops.functions.numeric import code_number, real_number, scaled_number
from edops.operators.quality import add_quality, flag_repeats, number_repeats
from edops.schemas import (
    CLEAN_VISITS,
    DISPOSITIONS,
    RECORD_DIGITS,
    SEX_CODES,
    SOURCE_SYSTEM,
    SOURCE_YEAR,
    SURVEY_LAYOUT,
    VISIT_PREFIX,
    WEEKDAY_CODES,
    WEEKEND_CODES,
)

_BLANKS = " \t\x0b\x0c\x1c\x1d\x1e\x1f"
# Fields read as whole numbers: the cast leaves out blanks at both ends itself.
_WHOLE = [
    "visit_month", "age", "triage_level", "temperature_f", "heart_rate", "respiratory_rate", "systolic_bp",
    "diastolic_bp", "spo2", "pain_score", "waiting_time_minutes", "length_of_stay_minutes",
]


def parse_fields(
    records: DataFrame,
    layout: dict[str, tuple[int, int]] = SURVEY_LAYOUT,
    raw: str = "raw_record",
    untrimmed: Collection[str] = (),
) -> DataFrame:
    """Replace ``raw`` by one trimmed text column per layout field.

    Records are ASCII, so fields are cut by byte; cutting by character would count
    through the record from its start for every field. ``untrimmed`` fields keep their blanks,
    for readers to whom these make no difference.
    """
    record = F.col(raw).cast("binary")

    def cut(name: str, start: int, width: int) -> Column:
        whole = F.substring(record, start, width).cast("string")
        if name in untrimmed:
            return whole
        text = F.trim(whole)
        # Control blanks are rare; only a field that starts or ends with one pays for
        # the slower trim. They all sort before the space.
        odd = (text != "") & ((text < " ") | (F.right(text, F.lit(1)) < " "))
        return F.when(odd, F.trim(text, F.lit(_BLANKS))).otherwise(text)

    fields = [cut(name, *place).alias(name) for name, place in layout.items()]
    return records.select(*[c for c in records.columns if c != raw], *fields)


def code_label(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code; unknown codes become NULL."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), code)


def triage_code(code: Column) -> Column:
    """Triage levels 1 to 5; every other code becomes NULL."""
    level = code_number(code)
    return F.when(level.between(1, 5), level)


def weekend(code: Column) -> Column:
    return F.coalesce(code.isin(WEEKEND_CODES), F.lit(False))


def arrival_hour(clock: Column) -> Column:
    """Hour of a four-digit clock text."""
    return F.when(clock.rlike("^[0-9]{4}$"), F.substring(clock, 1, 2).cast("int"))


def disposition(flags: dict[str, Column]) -> Column:
    """Strongest disposition whose flag is set; ``flags`` maps flag name to its code."""
    chosen = F.lit(None).cast("string")
    for label, names in reversed(DISPOSITIONS):
        chosen = F.when(_any_set(flags, names), label).otherwise(chosen)
    return chosen


def admitted(flags: dict[str, Column]) -> Column:
    return F.coalesce(_any_set(flags, DISPOSITIONS[0][1]), F.lit(False))


def _any_set(flags: dict[str, Column], names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [flags[name] == "1" for name in names])


def record_id(row_number: Column) -> Column:
    """Year and row number, zero-padded to at least six digits."""
    digits = row_number.cast("long").cast("string")
    width = F.greatest(F.lit(RECORD_DIGITS), F.length(digits))
    return F.concat(F.lit(f"{SOURCE_YEAR}-"), F.lpad(digits, width, F.lit("0")))


def visit_id(record: Column) -> Column:
    """Stable visit id: prefix and 20 hex digits of the hashed record id."""
    digest = F.sha2(F.concat(F.lit(f"{SOURCE_SYSTEM}:"), record), 256)
    return F.concat(F.lit(VISIT_PREFIX), F.substring(digest, 1, 20))


def diagnosis_group(code: Column) -> Column:
    """First letter of a diagnosis code."""
    return F.coalesce(F.upper(F.substring(F.nullif(code, F.lit("")), 1, 1)), F.lit("UNKNOWN"))


def clean_visits(
    bronze: DataFrame, order: str = "source_row_number", heavy: list | None = None
) -> DataFrame:
    """Bronze records to the clean visit table with quality flags.

    Flagged rows stay. Second and later rows of a visit id, in ``order``, get
    ``DUPLICATE_VISIT_ID`` as their last flag. Rows move once, by visit id; what follows from
    other columns or is the same everywhere, like the flags, is added after that.
    """
    # Of a field of one byte only a byte that is no blank counts, trimmed or not.
    codes = [name for name, (_, width) in SURVEY_LAYOUT.items() if width == 1]
    text = parse_fields(bronze, untrimmed={*_WHOLE, *codes})
    f = {name: F.col(name) for name in SURVEY_LAYOUT}
    typed = text.select(
        F.col(order).alias("_order"),
        visit_id(record_id(F.col("source_row_number"))).alias("visit_id"),
        arrival_hour(f["arrival_time"]).alias("arrival_hour"),
        code_number(f["visit_month"]).alias("visit_month"),
        code_label(f["visit_weekday"], WEEKDAY_CODES).alias("visit_weekday"),
        weekend(f["visit_weekday"]).alias("weekend_flag"),
        code_number(f["age"]).alias("age"),
        code_label(f["sex"], SEX_CODES).alias("sex"),
        triage_code(f["triage_level"]).alias("triage_level"),
        F.when(
            f["reason_for_visit_code"] != "",
            F.concat(F.lit("RFV_CODE:"), f["reason_for_visit_code"]),
        ).alias("chief_complaint"),
        scaled_number(f["temperature_f"], 10).alias("temperature"),
        *[
            scaled_number(f[name]).alias(name)
            for name in ["heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score"]
        ],
        F.nullif(f["diagnosis_code"], F.lit("")).alias("diagnosis_code"),
        disposition(f).alias("disposition"),
        admitted(f).alias("admitted_flag"),
        scaled_number(f["waiting_time_minutes"]).alias("waiting_time_minutes"),
        scaled_number(f["length_of_stay_minutes"]).alias("length_of_stay_minutes"),
        record_id(F.col("source_row_number")).alias("source_record_id"),
        real_number(f["patient_weight"]).alias("source_weight"),
        F.col("ingestion_timestamp"),
    )
    numbered = number_repeats(typed, "visit_id", "_order", heavy)
    whole = numbered.withColumns(
        {
            "patient_id": F.lit(None).cast("string"),
            "arrival_time": F.lit(None).cast("timestamp"),
            "diagnosis_description": F.lit(None).cast("string"),
            "source_system": F.lit(SOURCE_SYSTEM),
        }
    )
    return flag_repeats(add_quality(whole)).select(*CLEAN_VISITS)
