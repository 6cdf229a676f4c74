"""Message bodies: strict decoding and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNDECODABLE = "undecodable"
BAD_ID = "bad_id"
MISSING_DOCUMENT = "missing_document"
RESET_WITHOUT_START = "reset_without_start"

# Fixed value: document ids are 24 hex digits.
OBJECT_ID_PATTERN = "^[0-9a-fA-F]{24}$"


# A body is parsed in three steps, as three columns, so that each is worked out
# once: the variant, its typed parts, the checked fields.


def parse_sql(body: str) -> str:
    """The body as the only element of a JSON list; NULL if that is no JSON.

    The parser stops after the first value, so the body is parsed inside
    brackets, where text after it is an error.
    """
    return f"try_parse_json(concat('[', {body}, ']'))"


def parts_sql(listed: str, body: str) -> str:
    """``id`` and ``reset`` of the parsed body as variants; NULL unless the body is
    one JSON object.  A body that closes the bracket itself could still hide
    text after its value; such a body is parsed in braces too."""
    braced = f"try_parse_json(concat('{{\"m\":', {body}, '}}'))"
    whole = (
        f"try_variant_get({listed}, '$[1]', 'variant') IS NULL"
        f" AND (NOT {body} RLIKE r'\\}}\\s*\\]' OR {braced} IS NOT NULL)"
    )
    parts = f"try_variant_get({listed}, '$[0]', 'struct<id: variant, reset: variant>')"
    return f"CASE WHEN {whole} THEN {parts} END"


def typed_sql(parts: str) -> str:
    """The parts as text and list of texts, with the JSON types they had."""
    return (
        "named_struct("
        f"'id', try_variant_get({parts}.id, '$', 'string'), 'id_type', schema_of_variant({parts}.id),"
        f" 'id_fits', coalesce(try_variant_get({parts}.id, '$', 'string') RLIKE '{OBJECT_ID_PATTERN}', false),"
        f" 'reset', try_variant_get({parts}.reset, '$', 'array<string>'),"
        f" 'reset_type', schema_of_variant({parts}.reset))"
    )


def fields_sql(typed: str) -> str:
    """``struct<id, reset, ok, reason>``: ``ok`` if ``id`` is a string and ``reset`` is
    absent, null or a list of strings."""
    ok = (
        f"{typed}.id_type = 'STRING' AND CASE coalesce({typed}.reset_type, 'VOID') WHEN 'VOID' THEN true"
        f" WHEN 'ARRAY<VOID>' THEN size({typed}.reset) = 0"
        f" WHEN 'ARRAY<STRING>' THEN NOT exists({typed}.reset, r -> r IS NULL) ELSE false END"
    )
    return (
        f"CASE WHEN {ok} THEN named_struct("
        f"'id', CASE WHEN {typed}.id_fits THEN lower({typed}.id) ELSE {typed}.id END,"
        f" 'reset', {typed}.reset, 'ok', true,"
        f" 'reason', CASE WHEN NOT {typed}.id_fits THEN '{BAD_ID}' END)"
        " ELSE named_struct('id', CAST(NULL AS STRING), 'reset', CAST(NULL AS array<string>), 'ok', false,"
        f" 'reason', '{UNDECODABLE}') END"
    )


def render_body(document_id: Column) -> Column:
    """The message sent to a queue."""
    return F.to_json(F.struct(document_id.alias("id")))
