"""Hand-written documents and rule tables."""

from datetime import datetime, timedelta

from docroute.schema import DOCUMENT_SCHEMA, MESSAGE_SCHEMA
from docroute.sources.rules import RulesTable

NOW = datetime(2024, 5, 1, 12, 0, 0, 250_000)
VERSION = ("0.0.1", 0, 0, 1, "1234567890")


def flag(key, started=None, ended=None, reset=None, queued=None, version=VERSION):
    return (key, version, started, ended, reset, queued)


def ended(key, **more):
    return flag(key, NOW, NOW, **more)


def begun(key, **more):
    return flag(key, NOW, **more)


LATER = NOW + timedelta(minutes=10)
EARLIER = NOW - timedelta(minutes=10)


def hex_id(number):
    return f"{number:024x}"


def documents(spark, *rows):
    """Documents from (mimetype, flags), numbered from 0."""
    full = [
        (hex_id(i), "dummy.txt", "01234567890", False, NOW, NOW, mimetype, list(flags), None)
        for i, (mimetype, flags) in enumerate(rows)
    ]
    return spark.createDataFrame(full, DOCUMENT_SCHEMA)


def messages(spark, *bodies):
    """Messages numbered from 0, a second apart."""
    rows = [(i, NOW + timedelta(hours=1, seconds=i), body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def _table(**stages):
    return RulesTable(
        (f"{stage.replace('__', '.')}", i, flag, route)
        for stage, entries in stages.items()
        for i, (flag, route) in enumerate(entries)
    )


def _same(*names):
    return [(name, name) for name in names]


NER3 = ["ner.chemblactivityterms", "ner.chemicalentities", "ner.chemicalidentifiers"]

ENGINE_TABLE = _table(
    archive=[("unarchived", "unarchive")],
    tabular__totsv=_same("tabular.totsv"),
    tabular__analyse=_same("tabular.analysis"),
    text=_same("rawtext"),
    image_intermediate=_same("pdf_intermediates"),
    bounding_box=[("bounding_boxes", "pdf_figures")],
    analytical=_same("analytical"),
    ner=_same(*NER3),
)

ANALYTICAL_TABLE = _table(
    archive=[("unarchived", "unarchive")],
    tabular__totsv=_same("tabular.totsv"),
    tabular__analyse=_same("tabular.analysis"),
    text=_same("rawtext"),
    image_intermediate=_same("pdf_intermediates"),
    bounding_box=[("bounding_box", "pdf.figures")],
    analytical=_same("analytical"),
    ner=_same(
        "ner.leadmine.chemblactivityterms",
        "ner.leadmine.chemicalentities",
        "ner.leadmine.chemicalidentifiers",
        "ner.leadmine.poseidon",
    ),
)

FLAG_TEST = "flag-test"
FLAG_TEST_TABLE = RulesTable(
    (FLAG_TEST, i, f"flag.{name}", f"flag.{name}")
    for i, name in enumerate(["one", "two", "three"])
)
