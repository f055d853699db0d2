"""Column tests on raw change-event text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Reason codes written to the quarantine table.
NULL_OR_EMPTY = "null_or_empty_value"
INVALID_JSON = "invalid_json"
NULL_VALUE = "null_value"
JSON_PARSE_ERROR = "json_parse_error"
INVALID_OP = "invalid_op"
MISSING_TABLE = "missing_source_table"
STALE_EVENT = "stale_event"
KNOWN_OPS = ("r", "c", "u", "d")
MAX_EVENT_AGE_HOURS = 24


def _trimmed(text: Column) -> Column:
    return F.trim(F.translate(text, "\t\r\n\f", "    "))


def is_blank(text: Column) -> Column:
    return text.isNull() | (_trimmed(text) == "")


def is_json_object(text: Column) -> Column:
    """Whether the text is one complete JSON object in double quotes.

    The parser alone stops after a first document. In brackets the text must still be one element, and
    as the value of a field it must still close there; so trailing text, second documents and unbalanced
    braces are invalid. Repeated keys are valid.
    """
    listed = F.concat(F.lit("["), text, F.lit("]"))
    field = F.concat(F.lit('{"w":'), text, F.lit("}"))
    return (
        _trimmed(text).startswith("{")
        & F.get_json_object(listed, "$").isNotNull()
        & F.get_json_object(listed, "$[1]").isNull()
        & F.get_json_object(field, "$").isNotNull()
        & F.from_json(text, "map<string,string>", {"allowSingleQuotes": "false"}).isNotNull()
    )


def quarantine_reason(value: Column) -> Column:
    """Null for a usable event, else the reason it must be set aside."""
    return F.when(is_blank(value), F.lit(NULL_OR_EMPTY)).when(
        ~F.coalesce(is_json_object(value), F.lit(False)), F.lit(INVALID_JSON)
    )


def extended_reason(value: Column, as_of: Column, max_age_hours: int = MAX_EVENT_AGE_HOURS) -> Column:
    """Reason codes that also look at the operation, source table and event age."""
    fields = F.from_json(value, "payload struct<op:string,ts_ms:bigint,source:struct<`table`:string>>")["payload"]
    age_ms = F.unix_millis(as_of) - fields["ts_ms"]
    return (
        F.when(is_blank(value), F.lit(NULL_VALUE))
        .when(~F.coalesce(is_json_object(value), F.lit(False)), F.lit(JSON_PARSE_ERROR))
        .when(~F.coalesce(fields["op"].isin(*KNOWN_OPS), F.lit(False)), F.lit(INVALID_OP))
        .when(F.coalesce(fields["source"]["table"], F.lit("")) == "", F.lit(MISSING_TABLE))
        .when(F.coalesce(age_ms > max_age_hours * 3600000, F.lit(False)), F.lit(STALE_EVENT))
    )
