"""Rules: an ordered registry that says which stages a document may enter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docroute.functions import mimetypes as m
from docroute.operators.conditions import FlagTest


@dataclass(frozen=True)
class Stage:
    """A stage of a rule.

    ``condition`` and ``when`` narrow the rule's own.  With ``empty_wins`` the stage
    matches even with nothing to send, unless all its flags have ended.
    """

    key: str
    condition: Column | None = None
    empty_wins: bool = False
    when: FlagTest | None = None


@dataclass(frozen=True)
class Rule:
    """Documents that meet ``condition`` enter the first of ``stages`` that has
    something to send.  A rule without stages recognises documents and routes
    none of them.  Conditions are columns over the documents; ``when`` is a test of
    their flags (``operators/conditions.py``), which sees them as they are when the
    message is handled.  A condition may look at the flags (``doclib``) too, in ways
    that no such test has; logs with such rules are handled in rounds.
    """

    name: str
    condition: Column
    stages: Sequence[Stage | str] = ()
    when: FlagTest | None = None

    def staged(self) -> list[Stage]:
        return [s if isinstance(s, Stage) else Stage(s) for s in self.stages]


def default_rules(analytical: bool = False, mimetype: str = "mimetype") -> list[Rule]:
    """The twelve rules in their order; ``analytical`` switches the last one."""
    ner = "ner"
    return [
        Rule("Archive", m.is_archive(mimetype), [Stage("archive", empty_wins=True)]),
        Rule(
            "Tabular",
            F.lit(True),
            [
                Stage("tabular.totsv", m.is_spreadsheet(mimetype)),
                Stage(ner, m.is_tabular_text(mimetype)),
                Stage("tabular.analyse", m.is_tabular_text(mimetype) & m.is_analysable(mimetype)),
            ],
        ),
        Rule("HTML", m.is_html(mimetype), [ner]),
        Rule("XML", m.is_xml(mimetype), [ner]),
        Rule("Text", m.is_text(mimetype), [ner]),
        Rule("Document", m.is_raw_text_convertible(mimetype), ["text"]),
        Rule(
            "PDF",
            F.lit(True),
            [
                Stage("image_intermediate", m.needs_page_images(mimetype)),
                Stage("bounding_box", m.needs_bounding_boxes(mimetype)),
            ],
        ),
        Rule("Chemical", m.is_chemical(mimetype), [ner]),
        Rule("Image", m.is_image(mimetype)),
        Rule("Audio", m.is_audio(mimetype)),
        Rule("Video", m.is_video(mimetype)),
        # Switched off, it reaches no stage, so the table need not have one.
        Rule("Analytical", F.lit(analytical), ["analytical"] if analytical else []),
    ]
