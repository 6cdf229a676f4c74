"""The full handling of messages, with any rules or resolver.

Every message of every document is handled, in the order of ``seq``: its resets,
the resolution, the sends and their marks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from docroute.operators.engine import Engine
from docroute.plans.results import SupervisedLog
from docroute.plans.supervise_log import DECODED_COLUMNS, supervise_decoded
from docroute.plans.supervise_rounds import supervise_rounds
from docroute.sources.documents import Work
from docroute.sources.messages import decode_messages
from docroute.sources.rules import RulesTable

Resolver = Engine | Callable[[DataFrame], DataFrame]


def supervise(
    messages: DataFrame,
    documents: DataFrame,
    resolver: Resolver,
    table: RulesTable | None = None,
    keep: bool = False,
) -> SupervisedLog:
    """Handle all messages.

    ``resolver`` is an engine, or any function that adds a ``resolution`` column
    to documents and keeps their other columns; its sends are looked up in ``table``.  ``keep`` saves
    what the outputs have in common, for callers that use several of them.
    """
    work = Work(messages.sparkSession)
    decoded = work.table(decode_messages(messages).select(*DECODED_COLUMNS))
    return handle_decoded(decoded, documents, resolver, work, table, keep)


def handle_decoded(
    decoded: DataFrame,
    documents: DataFrame,
    resolver: Resolver,
    work: Work,
    table: RulesTable | None = None,
    keep: bool = False,
) -> SupervisedLog:
    """``supervise`` for decoded messages.  An engine whose conditions do not look
    at the flags has a closed form; anything else is handled in rounds."""
    if isinstance(resolver, Engine):
        if not resolver.reads_flags(documents):
            return supervise_decoded(decoded, documents, resolver, work, keep=keep)
        resolver, table = resolver.resolve, table or resolver.table
    log = supervise_rounds(decoded, documents, resolver, table or RulesTable.default(), work)
    if keep:
        log.results = work.table(log.results)
    return log
