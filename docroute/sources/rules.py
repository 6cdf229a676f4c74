"""The rules table: which flags and queues every stage requires.

This is configuration, a few entries per stage.  It is held on the driver,
with a checked bound, and enters the plans as literals.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.schema import REQUIRED_SCHEMA

MAX_ENTRIES = 10_000

# The stages, flags and queues of the default configuration.
DEFAULT_ENTRIES = [
    ("archive", 0, "unarchived", "unarchive", "queue"),
    ("tabular.totsv", 0, "tabular.totsv", "tabular.totsv", "queue"),
    ("tabular.analyse", 0, "tabular.analysis", "tabular.analysis", "queue"),
    ("html", 0, "html.screenshot", "html.screenshot", "queue"),
    ("html", 1, "html.render", "html.render", "queue"),
    ("text", 0, "rawtext", "rawtext", "queue"),
    ("image_intermediate", 0, "pdf.intermediates", "pdf.intermediates", "queue"),
    ("bounding_box", 0, "bounding_box", "pdf.figures", "queue"),
    ("analytical", 0, "analytical", "analytical", "queue"),
    ("ner", 0, "ner.leadmine.chemblactivityterms", "ner.leadmine.chemblactivityterms", "queue"),
    ("ner", 1, "ner.leadmine.chemicalentities", "ner.leadmine.chemicalentities", "queue"),
    ("ner", 2, "ner.leadmine.chemicalidentifiers", "ner.leadmine.chemicalidentifiers", "queue"),
    ("ner", 3, "ner.leadmine.poseidon", "ner.leadmine.poseidon", "queue"),
    ("ner", 4, "ner.leadmine.geneprotein", "ner.leadmine.geneprotein", "queue"),
]


@dataclass(frozen=True)
class Required:
    """One entry of a stage: work on ``flag`` is sent to the queue ``route``."""

    stage_key: str
    ordinal: int
    flag: str
    route: str
    type: str = "queue"


class RulesTable:
    """The required entries of all stages, in order.  ``stages`` names further
    stages, which require nothing and so never send.

    The entries become part of every expression and go to every task, so a table
    with more than ``most`` of them is refused; ``most`` may be any number that
    tasks can hold (some hundred bytes an entry).
    """

    def __init__(self, entries: Iterable[Required | tuple], stages: Iterable[str] = (), most: int = MAX_ENTRIES):
        rows = [e if isinstance(e, Required) else Required(*e) for e in entries]
        if len(rows) > most:
            raise ValueError(f"a rules table has at most {most} entries, not {len(rows)}")
        seen = set()
        for row in rows:
            if row.type != "queue":
                raise ValueError(f"flag '{row.flag}' of stage '{row.stage_key}': '{row.type}' is no kind of route")
            if (row.stage_key, row.ordinal) in seen:
                raise ValueError(f"stage '{row.stage_key}' has two entries with ordinal {row.ordinal}")
            seen.add((row.stage_key, row.ordinal))
        self.entries = sorted(rows, key=lambda r: (r.stage_key, r.ordinal))
        self._by_stage: dict[str, list[Required]] = {key: [] for key in [*(r.stage_key for r in self.entries), *sorted(stages)]}
        self._config: dict[tuple[str, str], Required] = {}
        for row in self.entries:
            self._by_stage[row.stage_key].append(row)
            self._config.setdefault((row.stage_key, row.route), row)

    @staticmethod
    def default() -> RulesTable:
        return RulesTable(DEFAULT_ENTRIES)

    @staticmethod
    def from_dataframe(df: DataFrame, most: int = MAX_ENTRIES) -> RulesTable:
        """Take the table from a DataFrame with the columns of REQUIRED_SCHEMA; a row
        without a flag names a stage that requires nothing."""
        rows = df.select(*REQUIRED_SCHEMA.fieldNames()).limit(most + 1).collect()
        empty = [row.stage_key for row in rows if row.flag is None]
        return RulesTable((Required(*row) for row in rows if row.flag is not None), empty, most)

    @staticmethod
    def read(spark: SparkSession, path: str, most: int = MAX_ENTRIES) -> RulesTable:
        """Read JSON lines ``{"stage_key": ..., "required": [{"flag", "route", "type"}, ...]}``;
        the order of the list is the order of the entries, and it may be empty."""
        schema = "stage_key string, required array<struct<flag: string, route: string, type: string>>"
        stages = spark.read.schema(schema).json(path)
        entries = stages.select("stage_key", F.posexplode_outer("required").alias("ordinal", "r"))
        return RulesTable.from_dataframe(
            entries.select("stage_key", "ordinal", "r.flag", "r.route", "r.type"), most
        )

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        rows = [(e.stage_key, e.ordinal, e.flag, e.route, e.type) for e in self.entries]
        rows += [(key, None, None, None, None) for key in self._by_stage if not self.stage(key)]
        return spark.createDataFrame(rows, REQUIRED_SCHEMA)

    def stages(self) -> list[str]:
        return list(self._by_stage)

    def stage(self, stage_key: str) -> list[Required]:
        return list(self._by_stage.get(stage_key, []))

    def flags(self, stage_key: str) -> list[str]:
        return [e.flag for e in self.stage(stage_key)]

    def config(self, stage_key: str, route: str) -> Required | None:
        """The first entry of the stage with this route."""
        return self._config.get((stage_key, route))
