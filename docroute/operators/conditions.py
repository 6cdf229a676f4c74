"""Conditions on flags that can be followed through a log.

A condition given as a column can only be asked of a document as it stands.  One
that is put together from these tests also has a form over the standings of the
flags that a log plan keeps, so rules with it are handled like any other.

    Rule("Idle", F.lit(True), ["media"], when=~any_flag("queued"))
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docroute.functions import flags as ff
from docroute.functions.flags import quote

#: What a flag may be asked: does an entry of it, named f, answer yes?
ENTRY_TESTS = {
    "queued": "coalesce(f.queued, false)",
    "started": "f.started IS NOT NULL",
    "ended": "f.ended IS NOT NULL",
}


@dataclass(frozen=True)
class FlagTest:
    """A condition on the flags of a document; combine with ``&``, ``|`` and ``~``.

    ``keys`` are the flags it names; ``every`` tells that it looks at all.  Its two
    texts take the name of the flag array, and of the standings with the text of
    one flag's place in them.
    """

    keys: tuple[str, ...]
    every: bool
    of_flags: Callable[[str], str]
    of_standings: Callable[[str, Callable[[str], str]], str]

    def column(self, flags: str = "doclib") -> Column:
        return F.expr(self.of_flags(flags))

    def _with(self, other: FlagTest, word: str) -> FlagTest:
        return FlagTest(
            tuple(dict.fromkeys(self.keys + other.keys)),
            self.every or other.every,
            lambda flags: f"({self.of_flags(flags)} {word} {other.of_flags(flags)})",
            lambda standings, place: f"({self.of_standings(standings, place)} {word} {other.of_standings(standings, place)})",
        )

    def __and__(self, other: FlagTest) -> FlagTest:
        return self._with(other, "AND")

    def __or__(self, other: FlagTest) -> FlagTest:
        return self._with(other, "OR")

    def __invert__(self) -> FlagTest:
        return FlagTest(
            self.keys,
            self.every,
            lambda flags: f"(NOT {self.of_flags(flags)})",
            lambda standings, place: f"(NOT {self.of_standings(standings, place)})",
        )


def _one(key: str, field: str, of_flags: Callable[[str], str]) -> FlagTest:
    return FlagTest((key,), False, of_flags, lambda standings, place: f"get({standings}, {place(key)}).{field}")


def has(key: str) -> FlagTest:
    """The document has the flag."""
    return _one(key, "has", lambda flags: ff.has_flag_sql(key, flags))


def _state(key: str, state: str) -> FlagTest:
    return _one(
        key, state, lambda flags: f"coalesce(exists({flags}, f -> f.key = {quote(key)} AND {ENTRY_TESTS[state]}), false)"
    )


def queued(key: str) -> FlagTest:
    """An entry of the flag is queued."""
    return _state(key, "queued")


def started(key: str) -> FlagTest:
    """An entry of the flag has been started."""
    return _state(key, "started")


def ended(key: str) -> FlagTest:
    """An entry of the flag has ended."""
    return _state(key, "ended")


def any_flag(state: str) -> FlagTest:
    """Some flag of the document is ``queued``, ``started`` or ``ended``."""
    return FlagTest(
        (),
        True,
        lambda flags: f"coalesce(exists({flags}, f -> {ENTRY_TESTS[state]}), false)",
        lambda standings, _: f"exists({standings}, s -> s.{state})",
    )


def all_flags(state: str) -> FlagTest:
    """Every flag of the document is; true if it has none."""
    return FlagTest(
        (),
        True,
        lambda flags: f"coalesce(forall({flags}.key, k -> exists({flags}, f -> f.key = k AND {ENTRY_TESTS[state]})), true)",
        lambda standings, _: f"forall({standings}, s -> NOT s.has OR s.{state})",
    )
