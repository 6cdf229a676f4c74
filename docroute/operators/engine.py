"""The engine: which stage does a document need next, and which queues hear of it?

The rules are flattened into ordered steps (rule, stage, condition).  The first
step that matches wins.  Everything is a narrow projection over one document:
no join and no shuffle.  The rules enter the expressions as literal tables, so
that the expressions stay small, however many rules and flags there are: large
generated methods would not be compiled by the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import flags as ff
from docroute.functions.flags import quote, strings_sql
from docroute.functions.messages import RESET_WITHOUT_START
from docroute.operators.conditions import FlagTest
from docroute.operators.rules import Rule, default_rules
from docroute.schema import RESOLUTION_TYPE, SENDS_TYPE
from docroute.sources.rules import Required, RulesTable

SENDS = SENDS_TYPE.simpleString()
NO_SENDS = f"CAST(array() AS {SENDS})"

# The text of a test of one required entry, given the name of the entry.
EntryTest = Callable[[str], str]


@dataclass(frozen=True)
class Step:
    rule: str
    stage_key: str
    condition: Column
    empty_wins: bool
    when: FlagTest | None


class Engine:
    """Ordered rules over a table of required flags.

    ``Engine.default()`` has the default rules; pass other rules, another
    table, or both to change the routing.
    """

    def __init__(
        self,
        rules: Sequence[Rule],
        table: RulesTable | None = None,
        analytical_flag: str = ff.ANALYTICAL_FLAG,
    ):
        self.rules = list(rules)
        self.table = table or RulesTable.default()
        self.analytical_flag = analytical_flag
        self.steps = [
            Step(
                rule.name,
                stage.key,
                rule.condition if stage.condition is None else rule.condition & stage.condition,
                stage.empty_wins,
                rule.when & stage.when if rule.when and stage.when else rule.when or stage.when,
            )
            for rule in self.rules
            for stage in rule.staged()
        ]
        self.stage_keys = list(dict.fromkeys(step.stage_key for step in self.steps))
        known = set(self.table.stages())
        for key in self.stage_keys:
            if key not in known:
                raise ValueError(f"the rules table has no stage '{key}'")
        # Every flag that a stage in use requires, in order.
        self.flags = list(
            dict.fromkeys(flag for key in self.stage_keys for flag in self.table.flags(key))
        )
        tests = [step.when for step in self.steps if step.when]
        #: Is a step's match up to the flags, beyond what it sends?
        self.tests_flags = bool(tests)
        #: The flags whose standing matters, those of the stages first.
        self.watched = list(dict.fromkeys([*self.flags, *(key for test in tests for key in test.keys)]))
        self.watches_all = any(test.every for test in tests)

    @staticmethod
    def default(analytical: bool = False, table: RulesTable | None = None) -> Engine:
        return Engine(default_rules(analytical), table)

    # -- texts: the rules are literal tables, walked by higher-order functions ----

    @property
    def flags_sql(self) -> str:
        return strings_sql(self.flags)

    def _steps_sql(self) -> str:
        """Per step its number, its stage and whether that wins when empty."""
        rows = [
            f"named_struct('n', {n}, 'stage', {self.stage_keys.index(step.stage_key)},"
            f" 'empty_wins', {str(step.empty_wins).lower()})"
            for n, step in enumerate(self.steps)
        ]
        return f"CAST(array({', '.join(rows)}) AS array<struct<n: int, stage: int, empty_wins: boolean>>)"

    def _stages_sql(self) -> str:
        """Per stage its entries: the place of the flag in ``flags``, the places of
        earlier entries with the same route, and the flag that is marked when
        the route is sent to (the flag of the stage's first entry for it)."""

        places = {flag: i for i, flag in enumerate(self.flags)}
        by_route: dict[tuple[str, str], list[Required]] = {}
        for key in self.stage_keys:
            for e in self.table.stage(key):
                by_route.setdefault((key, e.route), []).append(e)
        kind = (
            "array<struct<ordinal: int, flag: string, route: string, place: int,"
            " earlier: array<int>, marked: string, marked_place: int>>"
        )

        def values(e: Required) -> dict:
            marked = self.table.config(e.stage_key, e.route).flag
            earlier = [places[o.flag] for o in by_route[e.stage_key, e.route] if o.ordinal < e.ordinal]
            return {
                "ordinal": e.ordinal, "flag": e.flag, "route": e.route, "place": places[e.flag],
                "earlier": earlier, "marked": marked, "marked_place": places[marked],
            }

        if sum(len(self.table.stage(key)) for key in self.stage_keys) > ff.LONG_TABLE:
            rows = [[values(e) for e in self.table.stage(key)] for key in self.stage_keys]
            return ff.table_sql(rows, f"array<{kind}>")

        def entry(e: Required) -> str:
            v = values(e)
            return (
                f"named_struct('ordinal', {v['ordinal']}, 'flag', {quote(v['flag'])}, 'route', {quote(v['route'])},"
                f" 'place', {v['place']}, 'earlier', CAST(array({', '.join(map(str, v['earlier']))}) AS array<int>),"
                f" 'marked', {quote(v['marked'])}, 'marked_place', {v['marked_place']})"
            )

        stages = [
            f"CAST(array({', '.join(map(entry, self.table.stage(key)))}) AS {kind})" for key in self.stage_keys
        ]
        return f"array({', '.join(stages)})"

    def choose_sql(self, eligible: str, allowed: str, ended: EntryTest) -> str:
        """The first step that matches, as ``struct<n, stage, empty_wins>``; NULL if
        none does.  A step whose stage meets an error stops the search as well.

        ``eligible`` and ``allowed`` name arrays of booleans, by step and by flag.
        """
        if not self.steps:
            return "CAST(NULL AS struct<n: int, stage: int, empty_wins: boolean>)"
        entries = f"get({self._stages_sql()}, step.stage)"
        matches = (
            f"CASE WHEN step.empty_wins THEN NOT forall({entries}, e -> {ended('e')})"
            # Allowed or in error: anything but a plain no.
            f" ELSE exists({entries}, e -> coalesce({allowed}[e.place], true)) END"
        )
        return f"get(filter({self._steps_sql()}, step -> {eligible}[step.n] AND {matches}), 0)"

    def failed_sql(self, step: str, allowed: str) -> str:
        """Did the chosen step meet an error?"""
        if not self.steps:
            return "false"
        entries = f"get({self._stages_sql()}, {step}.stage)"
        return f"coalesce(exists({entries}, e -> {allowed}[e.place] IS NULL), false)"

    def sends_sql(self, step: str, allowed: str, can_queue: EntryTest | None = None) -> str:
        """What the chosen step, which has not failed, sends: the first allowed entry
        of every route.  With ``can_queue``, the second gate is applied, and the
        sends carry the flags to be marked."""
        if not self.steps:
            return NO_SENDS
        entries = f"get({self._stages_sql()}, {step}.stage)"
        first = f"{allowed}[e.place] AND NOT exists(e.earlier, i -> {allowed}[i])"
        flag = "e.flag"
        if can_queue is not None:
            first, flag = f"{first} AND {can_queue('e')}", "e.marked"
        send = f"named_struct('ordinal', e.ordinal, 'flag', {flag}, 'route', e.route)"
        return f"coalesce(transform(filter({entries}, e -> {first}), e -> {send}), {NO_SENDS})"

    def label_sql(self, step: str, field: str) -> str:
        """The rule or the stage_key of a step number."""
        return f"get({strings_sql([getattr(s, field) for s in self.steps])}, {step})"

    def eligible(self) -> Column:
        """Per step: does the document meet its condition, tests of flags apart?"""
        conditions = [F.coalesce(step.condition, F.lit(False)) for step in self.steps]
        return F.array(*conditions).cast("array<boolean>")

    def eligible_now(self) -> Column:
        """Per step: does the document meet its condition and its test of the flags?"""
        conditions = [F.coalesce(step.condition, F.lit(False)) for step in self.steps]
        tested = [c & step.when.column() if step.when else c for c, step in zip(conditions, self.steps)]
        return F.array(*tested).cast("array<boolean>")

    def passes_sql(self, eligible: str, standings: str) -> str:
        """The array ``eligible`` with the tests of flags, which look at the standings
        of the watched flags (and of all others behind them)."""
        if not self.tests_flags:
            return eligible
        places = {key: str(i) for i, key in enumerate(self.watched)}
        tests = ", ".join(step.when.of_standings(standings, places.__getitem__) if step.when else "true" for step in self.steps)
        return f"zip_with({eligible}, array({tests}), (a, b) -> a AND b)"

    def reads_flags(self, documents: DataFrame) -> bool:
        """Does a condition, other than by a test, look at the flags of the documents?"""
        references = documents.select(self.eligible())._jdf.queryExecution().analyzed().references().iterator()
        names = []
        while references.hasNext():
            names.append(references.next().name())
        return "doclib" in names

    # -- operators over documents ---------------------------------------------

    def resolve(self, documents: DataFrame, column: str = "resolution") -> DataFrame:
        """Add the resolution of every document: NULL if no rule matches, else
        the rule, the stage, the sends (one per queue) and the error, if any."""
        given = [F.col(f"`{name}`") for name in documents.columns]
        allowed = ff.sendable_allowed_each_sql(self.flags_sql, analytical_flag=self.analytical_flag)
        step = self.choose_sql(
            "__eligible", "__allowed", lambda entry: ff.contains_sql("__ended", f"{entry}.flag")
        )
        failed = self.failed_sql("__step", "__allowed")
        sends = self.sends_sql("__step", "__allowed")
        resolution = (
            "CASE WHEN __step IS NOT NULL THEN CAST(named_struct("
            f"'rule', {self.label_sql('__step.n', 'rule')},"
            f" 'stage_key', {self.label_sql('__step.n', 'stage_key')},"
            f" 'sends', CASE WHEN __failed THEN {NO_SENDS} ELSE {sends} END,"
            f" 'error', CASE WHEN __failed THEN {quote(RESET_WITHOUT_START)} END)"
            f" AS {RESOLUTION_TYPE.simpleString()}) END"
        )
        return (
            # All that is read of the flags is read here, by field.
            documents.select(
                *given,
                self.eligible_now().alias("__eligible"),
                F.expr(allowed).alias("__allowed"),
                F.expr(ff.ended_keys_sql()).alias("__ended"),
            )
            .select(*given, "__allowed", F.expr(step).alias("__step"))
            .select(*given, "__allowed", "__step", F.expr(failed).alias("__failed"))
            # Through a one-row generator: filters on the resolution stay above it,
            # instead of working it out again below.
            .select(*given, F.explode(F.array(F.expr(resolution))).alias(column))
        )


def distinct_routes(sends: str = "sends") -> Column:
    """Drop sends to a queue that an earlier send already names."""
    return F.expr(
        f"filter({sends}, (send, place) ->"
        f" array_position(transform({sends}, s -> s.route), send.route) = place + 1)"
    )


def select_sends(
    resolved: DataFrame,
    table: RulesTable | None = None,
    reset: str | None = None,
    column: str = "sends",
) -> DataFrame:
    """Add what is really sent: each queue of the resolution is looked up in its
    stage, and sent to if the flag found there can be queued.  ``reset`` names
    the column with the reset list of the message, if there is one.

    Works on the resolution of any engine.  The lookup table is configuration,
    so it is a constant map and not a join.
    """
    table = table or RulesTable.default()
    reset = reset or "CAST(NULL AS array<string>)"
    flag_of = {f"{e.stage_key}\n{e.route}": e.flag for e in reversed(table.entries)}
    if len(flag_of) > ff.LONG_TABLE:
        config = ff.table_sql(flag_of, "map<string, string>")
    else:
        config = f"map({', '.join(quote(x) for pair in flag_of.items() for x in pair)})"
    key = "concat_ws('\\n', resolution.stage_key, s.route)"
    configured = (
        "transform(resolution.sends, s -> named_struct('ordinal', s.ordinal,"
        f" 'flag', try_element_at({config}, {key}), 'route', s.route))"
    )
    queueable = ff.can_queue_sql("s.flag", reset)
    return resolved.withColumn(
        column,
        F.expr(
            f"CAST(CASE WHEN size(resolution.sends) > 0 THEN"
            f" filter({configured}, s -> s.flag IS NOT NULL AND {queueable})"
            f" ELSE array() END AS {SENDS})"
        ),
    )
