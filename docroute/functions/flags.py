"""Flag predicates and flag updates on the nested ``doclib`` array.

The functions give columns.  Their texts (``*_sql``) serve inside larger
expressions and lambdas; ``flags`` is the name of the flag array there.
Presence, head and any-of tests read single fields of the array
(``doclib.key``, ``doclib.reset`` ...), so that a Parquet scan under them reads
only those leaf columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docroute.schema import FLAG_TYPE

ANALYTICAL_FLAG = "analytical"
FLAG = FLAG_TYPE.simpleString()
NO_FLAGS = f"CAST(array() AS array<{FLAG}>)"


def quote(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let_sql(value: str, name: str, body: str) -> str:
    """Bind ``value`` to ``name`` once for use in ``body``, also within lambdas."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def contains_sql(array: str, value: str) -> str:
    return f"coalesce(array_contains({array}, {value}), false)"


# Longer tables enter an expression as one text, which Spark reads once when it plans:
# an expression of their entries would be gone through by every rule of the optimizer.
LONG_TABLE = 200


def table_sql(rows: Sequence | dict, kind: str) -> str:
    """A constant of SQL type ``kind`` from what its JSON form holds."""
    return f"from_json({quote(json.dumps(rows, ensure_ascii=False))}, {quote(kind)})"


def strings_sql(values: Sequence[str]) -> str:
    """An array of string literals."""
    if len(values) > LONG_TABLE:
        return table_sql(list(values), "array<string>")
    return f"CAST(array({', '.join(map(quote, values))}) AS array<string>)"


# -- predicates --------------------------------------------------------------------


def epoch_second_sql(ts: str) -> str:
    """Whole seconds since the epoch of a zone-less timestamp, whatever the
    session time zone is."""
    return (
        f"(CAST(unix_date(CAST({ts} AS DATE)) AS BIGINT) * 86400"
        f" + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"
    )


def _position_sql(key: str, flags: str) -> str:
    return f"CAST(array_position({flags}.key, {quote(key)}) AS INT) - 1"


def has_flag_sql(key: str, flags: str = "doclib") -> str:
    return contains_sql(f"{flags}.key", quote(key))


def has_flag(key: str, flags: str = "doclib") -> Column:
    return F.expr(has_flag_sql(key, flags))


def head_flag(key: str, flags: str = "doclib") -> Column:
    """The first flag with this key; NULL if there is none."""
    return F.expr(f"get({flags}, {_position_sql(key, flags)})")


def ended_keys_sql(flags: str = "doclib") -> str:
    """Keys of the flags that have ended; NULL in the place of the others."""
    return f"zip_with({flags}.key, {flags}.ended, (k, e) -> CASE WHEN e IS NOT NULL THEN k END)"


def queued_keys_sql(flags: str = "doclib") -> str:
    """Keys of the flags that are queued; NULL in the place of the others."""
    return f"zip_with({flags}.key, {flags}.queued, (k, q) -> CASE WHEN q THEN k END)"


def has_ended_sql(key: str, flags: str = "doclib") -> str:
    return contains_sql(ended_keys_sql(flags), key)


def completed(required: Sequence[str], flags: str = "doclib") -> Column:
    """Every required flag has an entry that ended; true if none is required."""
    return F.expr(f"forall({strings_sql(required)}, key -> {has_ended_sql('key', flags)})")


def started(required: Sequence[str], flags: str = "doclib") -> Column:
    """Every required flag exists; true if none is required."""
    return F.expr(f"forall({strings_sql(required)}, key -> {contains_sql(f'{flags}.key', 'key')})")


def _flag_allowed_sql(reset: str, begun: str) -> str:
    """May a flag that exists be sent?  NULL if it was reset but never started."""
    return (
        f"CASE WHEN {reset} IS NULL THEN false"
        f" ELSE {epoch_second_sql(reset)} > {epoch_second_sql(begun)} END"
    )


def sendable_allowed_each_sql(
    keys: str, flags: str = "doclib", analytical_flag: str = ANALYTICAL_FLAG
) -> str:
    """May work on each flag of the array ``keys`` be sent?  Absent flags may, present
    ones only if they were reset in a later second than they started; the analytical
    flag always may.  NULL stands for the error of a reset without a start.

    The flags are judged in one pass and then looked up, so the size of the
    expression does not grow with the number of keys.
    """
    lookup = let_sql(
        "CAST(array_position(own, key) AS INT)",
        "place",
        f"CASE WHEN key = {quote(analytical_flag)} THEN true WHEN place > 0 THEN judged[place - 1]"
        " ELSE true END",
    )
    looked_up = let_sql(f"{flags}.key", "own", f"transform({keys}, key -> {lookup})")
    allowed = _flag_allowed_sql("r", "s")
    return let_sql(f"zip_with({flags}.reset, {flags}.started, (r, s) -> {allowed})", "judged", looked_up)


def is_queued(key: str, flags: str = "doclib") -> Column:
    """Has any entry of the key been queued?"""
    return F.expr(contains_sql(queued_keys_sql(flags), quote(key)))


def can_queue_sql(flag: str, reset: str, flags: str = "doclib") -> str:
    return f"({contains_sql(reset, flag)} OR NOT {contains_sql(queued_keys_sql(flags), flag)})"


def can_queue(flag: str, reset: str = "reset", flags: str = "doclib") -> Column:
    """A flag that the message resets, or that no entry has queued."""
    return F.expr(can_queue_sql(quote(flag), reset, flags))


# -- updates -----------------------------------------------------------------------


def _latest_places_sql(flags: str) -> str:
    """The places of the entries of their key that started last (the first of
    equals; entries that never started come last), in order: the array is sorted
    by key once, and the last of each run is kept."""
    ranked = (
        f"array_sort(transform({flags}, (f, at) -> named_struct("
        "'key', f.key, 'started', f.started, 'before', -at)))"
    )
    lasts = "filter(ranked, (r, i) -> NOT (get(ranked, i + 1).key <=> r.key))"
    return let_sql(ranked, "ranked", f"array_sort(transform({lasts}, r -> -r.before))")


def latest_flags_sql(flags: str = "doclib") -> str:
    return let_sql(
        flags, "all_flags", f"transform({_latest_places_sql('all_flags')}, place -> get(all_flags, place))"
    )


def latest_flag_per_key(flags: str = "doclib") -> Column:
    """Keep the most current entry of every key."""
    return F.expr(latest_flags_sql(flags))


def with_sql(flag: str, **changed: str) -> str:
    fields = ", ".join(
        f"'{name}', {changed.get(name, f'{flag}.{name}')}" for name in FLAG_TYPE.fieldNames()
    )
    return f"named_struct({fields})"


def stamp_resets_sql(flags: str, stamp: Callable[[str], str]) -> str:
    """Collapse and stamp the flags for which ``stamp(key)`` gives a time;
    leave the others as they are."""
    plain = f"filter(transform({flags}, (own, at) -> CASE WHEN {stamp('own.key')} IS NULL THEN at END), at -> at IS NOT NULL)"
    places = f"array_sort(array_union({_latest_places_sql(flags)}, {plain}))"
    kept = f"transform({places}, place -> get({flags}, place))"
    stamped = with_sql("kept", reset=f"coalesce({stamp('kept.key')}, kept.reset)")
    return f"transform({kept}, kept -> {stamped})"


def resets_any_sql(reset: str, flags: str = "doclib") -> str:
    return f"coalesce(arrays_overlap({flags}.key, {reset}), false)"


def reset_changed(reset: str = "reset", flags: str = "doclib") -> Column:
    """Did the reset change a flag?  True for a message without a reset list."""
    return F.expr(f"{reset} IS NULL OR {resets_any_sql(reset, flags)}")


def new_flag_sql(key: str, reset: str = "NULL") -> str:
    """A flag that was queued before any consumer saw the document."""
    version = "named_struct('number', '', 'major', 0, 'minor', 0, 'patch', 0, 'hash', '')"
    return (
        f"CAST(named_struct('key', {key}, 'version', {version}, 'started', NULL, 'ended', NULL,"
        f" 'reset', {reset}, 'queued', true) AS {FLAG})"
    )


def mark_queued_sql(selected: str, flags: str = "doclib") -> str:
    queued = f"CASE WHEN array_contains({selected}, own.key) THEN true ELSE own.queued END"
    return f"transform({flags}, own -> {with_sql('own', queued=queued)})"
