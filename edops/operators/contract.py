"""Event contract: JSON text to typed events with a list of errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edops.functions.labels import labels_of
from edops.functions.times import parse_utc
from edops.schemas import EVENT_TYPES, EVENT_VERSION, PATIENT_EVENTS, REQUIRED_FIELDS, VITAL_FIELDS, names, struct

_NUMERIC = ["BIGINT", "DOUBLE", "FLOAT"]  # and every DECIMAL
# Fields whose JSON type matters for the contract are read as variants.
_TYPED = ["event_version", "event_time", "triage_level"]
EVENT_COLUMNS = names(PATIENT_EVENTS)


def parse_events(raw: DataFrame, text: str = "raw_value") -> DataFrame:
    """Add ``event`` (the typed fields), ``event_ts`` and ``errors`` to raw JSON rows.

    The JSON value must be one object and nothing else; otherwise the only error is
    ``MALFORMED_JSON``. A wrongly typed optional field is NULL, while a wrongly typed
    time, triage level or version is an error.
    """
    item, version, triage = F.col("_item"), F.col("_version"), F.col("_triage")
    time = item["event_time"]
    typed = {
        "event_version": F.when(version == F.floor(version), version.cast("int")),
        "event_time": F.col("_time"),
        "triage_level": F.when(triage.isin([1.0, 2.0, 3.0, 4.0, 5.0]), triage.cast("int")),
        "age": item["age"].try_cast("double").try_cast("int"),
    }
    event = [
        typed.get(f.name, item[f.name].try_cast(f.dataType)).alias(f.name)
        for f in struct(PATIENT_EVENTS)
    ]
    facts = F.struct(
        F.struct(*event).alias("event"),
        F.when(F.schema_of_variant(time) == "STRING", parse_utc(F.col("_time"))).alias("event_ts"),
        item.isNull().alias("_malformed"),
        _text(item["event_version"]).alias("_version_text"),
        _text(item["triage_level"]).isNotNull().alias("_has_triage"),
    )
    # The one-element inline keeps later filters above the parsing: pushed below it,
    # they would parse the text once per field they look at.
    read = (
        raw.withColumn("_items", _items(F.col(text)))
        .withColumn("_item", _only_object(F.col(text), F.col("_items")))
        .withColumns(
            {
                "_version": _number(item["event_version"]),
                "_triage": _number(item["triage_level"]),
                "_time": _text(time),
            }
        )
        .select(*raw.columns, F.inline(F.array(facts)))
    )
    errors = contract_errors(
        F.col("event"),
        F.col("event_ts"),
        malformed=F.col("_malformed"),
        version_text=F.col("_version_text"),
        bad_triage=F.col("_has_triage") & F.col("event.triage_level").isNull(),
    )
    return read.select(*raw.columns, "event", "event_ts", errors.alias("errors"))


def contract_errors(
    event: Column,
    event_ts: Column,
    malformed: Column,
    version_text: Column,
    bad_triage: Column,
) -> Column:
    """Ordered list of contract violations; empty for a valid event."""

    def missing(name: str) -> tuple[Column, str]:
        text = version_text if name == "event_version" else event[name]
        return F.coalesce(text, F.lit("")) == "", f"MISSING_{name.upper()}"

    checks = [missing(name) for name in sorted(REQUIRED_FIELDS)]
    known = F.coalesce(event["event_type"].isin(EVENT_TYPES), F.lit(False))
    checks.append((~known, "UNKNOWN_EVENT_TYPE"))
    supported = F.coalesce(event["event_version"] == EVENT_VERSION, F.lit(False))
    checks.append((~supported, "UNSUPPORTED_EVENT_VERSION"))
    checks.append((event_ts.isNull(), "INVALID_EVENT_TIME"))
    checks.append((bad_triage, "INVALID_TRIAGE"))
    return F.when(malformed, F.array(F.lit("MALFORMED_JSON"))).otherwise(labels_of(checks))


def flatten_events(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event fields as columns, with the parsed time and the error list."""
    return parsed.select(*keep, "event.*", "event_ts", "errors")


def has_vitals(prefix: str = "") -> Column:
    known = [F.col(f"{prefix}{name}").isNotNull() for name in VITAL_FIELDS]
    out = known[0]
    for other in known[1:]:
        out = out | other
    return out


def _items(text: Column, prefix: str = "[", suffix: str = "]") -> Column:
    """The text parsed as the elements of a JSON array; NULL when it is no JSON."""
    fields = ", ".join(
        f"{name} {'variant' if name in _TYPED else 'string'}" for name in EVENT_COLUMNS
    )
    return F.from_json(
        F.concat(F.lit(prefix), text, F.lit(suffix)),
        f"array<struct<{fields}>>",
        {"allowSingleQuotes": "false"},
    )


def _only_object(text: Column, items: Column) -> Column:
    """The single JSON object that makes up the whole text, else NULL.

    The parser stops after the first value, so the text was parsed inside an array:
    anything left over breaks the array or adds an element. A text that closes the
    array itself is caught by a second parse inside a object.
    """
    nested = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), "v struct<event_id string>, _bad string",
        {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"},
    )
    closes = text.contains("]") & text.rlike(r"\}\s*\]")  # most texts have no bracket to look at
    complete = F.when(closes, nested["_bad"].isNull()).otherwise(F.lit(True))
    return F.when((F.size(items) == 1) & complete, F.get(items, F.lit(0)))


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    """Numeric variant as a double; text that looks like a number is not a number."""
    kind = F.schema_of_variant(value)
    return F.when(kind.isin(_NUMERIC) | kind.startswith("DECIMAL"), F.try_variant_get(value, "$", "double"))
