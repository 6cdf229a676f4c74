"""The rules, case by case: mimetype and flags in, stage and queues out."""

import pytest
from pyspark.sql import functions as F

from docroute.functions import mimetypes as m
from docroute.operators.engine import Engine, select_sends
from docroute.operators.rules import Rule, Stage, default_rules
from docroute.functions import flags as ff
from docroute.sources.rules import DEFAULT_ENTRIES, Required, RulesTable
from tests import helpers as h
from tests.helpers import EARLIER, ENGINE_TABLE, LATER, NER3, begun, ended, flag

PDF = "application/pdf"
TSV = "text/tab-separated-values"
EXCEL = "application/vnd.ms-excel"
OFFICE = [t for t in m.OFFICE if t != "application/vnd.ms-cab-compressed"]

NER = ("ner", NER3)
NONE = None


def each(types, expected):
    return [(t, [], expected) for t in types]


RESOLVE = [
    ("dummy/mimetype", [], NONE),
    *each(m.SPREADSHEET, ("tabular.totsv", ["tabular.totsv"])),
    (TSV, [], NER),
    ("text/csv", [], NER),
    ("text/tab-custom", [ended(k) for k in NER3], NONE),
    *each(m.TEXT, NER),
    *each(m.ARCHIVE, ("archive", ["unarchive"])),
    *each(OFFICE, ("text", ["rawtext"])),
    (PDF, [ended("prefetch"), ended("rawtext")], ("image_intermediate", ["pdf_intermediates"])),
    (PDF, [ended("rawtext"), ended("pdf_intermediates")], ("bounding_box", ["pdf_figures"])),
    (PDF, [ended("rawtext"), ended("pdf_intermediates"), ended("bounding_boxes")], NONE),
    *each(["text/html", "text/webviewhtml", "text/x-server-parsed-html", "text/html; charset=utf-8"], NER),
    *each(["image/png", "image/tiff", "image/webp", "image/bmp", "image/vnd.microsoft.icon"], NONE),
    *each(["video/mpeg", "video/mp2t", "audio/wav", "audio/aac"], NONE),
    *each(["chemical/x-inchi ", "chemical/x-chem3d"], NER),
    *each(m.XML, NER),
    (None, [], NONE),
    (
        PDF,
        [ended("rawtext"), ended("pdf_intermediates", reset=LATER), ended("bounding_boxes", reset=LATER)],
        ("image_intermediate", ["pdf_intermediates"]),
    ),
    (
        TSV,
        [ended(NER3[0]), ended(NER3[1], reset=LATER), ended(NER3[2], reset=LATER), begun("tabular.analysis")],
        ("ner", NER3[1:]),
    ),
    (
        TSV,
        [*map(ended, NER3), begun("tabular.analysis", reset=LATER)],
        ("tabular.analyse", ["tabular.analysis"]),
    ),
    (TSV, [*map(ended, NER3), begun("tabular.analysis", reset=EARLIER)], NONE),
    # A reset within the second of the start does not count.
    (TSV, [*map(ended, NER3), begun("tabular.analysis", reset=h.NOW.replace(microsecond=900_000))], NONE),
    # The first of duplicate flags decides.
    (
        PDF,
        [begun("rawtext"), begun("rawtext", reset=LATER)],
        ("image_intermediate", ["pdf_intermediates"]),
    ),
    (PDF, [begun("rawtext", reset=LATER), begun("rawtext")], ("text", ["rawtext"])),
    # Archives: in progress stops the search, completed falls through, also after a reset.
    ("application/gzip", [begun("unarchived")], ("archive", [])),
    ("application/gzip", [ended("unarchived")], NONE),
    ("application/gzip", [ended("unarchived", reset=LATER)], NONE),
    ("application/gzip", [begun("unarchived", reset=LATER)], ("archive", ["unarchive"])),
    (
        "application/vnd.ms-cab-compressed",
        [begun("unarchived"), ended("unarchived")],
        ("text", ["rawtext"]),
    ),
    (EXCEL, [ended("tabular.totsv")], ("text", ["rawtext"])),
    # A reset of a flag that never started is an error, if its stage is reached.
    (PDF, [flag("rawtext", reset=LATER)], ("text", "reset_without_start")),
    ("text/plain", [flag(NER3[1], reset=LATER)], ("ner", "reset_without_start")),
    (PDF, [flag("pdf_intermediates", reset=LATER)], ("text", ["rawtext"])),
]


def outcome(resolution):
    if resolution is None:
        return None
    return resolution.stage_key, resolution.error or [s.route for s in resolution.sends]


def outcomes(engine, df, column="resolution"):
    return [outcome(r[0]) for r in engine.resolve(df).orderBy("id").select(column).collect()]


def test_resolve(spark):
    df = h.documents(spark, *[(mimetype, flags) for mimetype, flags, _ in RESOLVE])
    got = outcomes(Engine.default(table=ENGINE_TABLE), df)
    assert got == [(e[0], e[1]) if e else None for _, _, e in RESOLVE]


def one_rule(name, table=ENGINE_TABLE):
    return Engine([r for r in default_rules(analytical=True) if r.name == name], table)


RULES = [
    ("Archive", "text/plain", [], None),
    ("Archive", "application/gzip", [], ["unarchive"]),
    ("Archive", "application/gzip", [begun("unarchived")], []),
    ("Archive", "application/gzip", [ended("unarchived")], None),
    ("Tabular", EXCEL, [begun("tabular.totsv")], None),
    ("Tabular", EXCEL, [ended("tabular.totsv")], None),
    ("Tabular", EXCEL, [ended("tabular.analysis")], ["tabular.totsv"]),
    ("Tabular", TSV, [*map(ended, NER3)], ["tabular.analysis"]),
    ("Tabular", TSV, [ended("tabular.totsv"), *map(ended, NER3), begun("tabular.analysis")], None),
    ("Tabular", "text/plain", [], None),
    ("Text", "text/plain", [], NER3),
    ("Text", "text/plain", [*map(ended, NER3[:2])], NER3[2:]),
    ("Text", "text/plain", [*map(ended, NER3[:2]), begun(NER3[2])], None),
    ("Text", "text/plain", [*map(ended, NER3)], None),
    ("Document", PDF, [], ["rawtext"]),
    ("Document", PDF, [ended("rawtext")], None),
    ("PDF", PDF, [], ["pdf_intermediates"]),
    ("PDF", PDF, [ended("pdf_intermediates")], ["pdf_figures"]),
    ("PDF", PDF, [ended("pdf_intermediates"), ended("bounding_boxes")], None),
    ("Analytical", "image/jpeg", [ended("analytical")], ["analytical"]),
    ("Image", "image/jpeg", [], None),
]


@pytest.mark.parametrize("name", list(dict.fromkeys(r[0] for r in RULES)))
def test_rule(spark, name):
    cases = [r for r in RULES if r[0] == name]
    df = h.documents(spark, *[(mimetype, flags) for _, mimetype, flags, _ in cases])
    got = [o and o[1] for o in outcomes(one_rule(name), df)]
    assert got == [expected for *_, expected in cases]


def test_analytical_comes_last(spark):
    flags = [ended("rawtext"), ended("pdf_intermediates"), ended("bounding_box")]
    df = h.documents(spark, (PDF, flags), (PDF, flags[:2]), ("application/gzip", [begun("unarchived")]))
    got = outcomes(Engine.default(True, h.ANALYTICAL_TABLE), df)
    assert got == [
        ("analytical", ["analytical"]),
        ("bounding_box", ["pdf.figures"]),
        ("archive", []),
    ]


def test_resolve_does_not_depend_on_the_session_time_zone(spark):
    df = h.documents(spark, *[(mimetype, flags) for mimetype, flags, _ in RESOLVE])
    engine = Engine.default(table=ENGINE_TABLE)
    want = outcomes(engine, df)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert outcomes(engine, df) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_route_type_raises():
    with pytest.raises(ValueError, match="something"):
        RulesTable([Required("someprocess", 0, "flag", "route", "something")])


def test_unknown_stage_raises(spark):
    with pytest.raises(ValueError, match="nowhere"):
        Engine([Rule("Nowhere", F.lit(True), ["nowhere"])])


def test_rules_table_round_trip(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(
        '{"stage_key": "a", "required": [{"flag": "x", "route": "q", "type": "queue"},'
        ' {"flag": "y", "route": "q", "type": "queue"}]}\n{"stage_key": "b", "required": []}\n'
    )
    table = RulesTable.read(spark, str(path))
    assert table.entries == [Required("a", 0, "x", "q"), Required("a", 1, "y", "q")]
    assert table.stages() == ["a", "b"] and table.flags("b") == []
    again = RulesTable.from_dataframe(table.to_dataframe(spark))
    assert (again.entries, again.stages()) == (table.entries, table.stages())
    assert table.config("a", "q").flag == "x"


def test_empty_and_unused_stages(spark):
    """A stage that requires nothing never sends and counts as completed; a stage
    that no active rule reaches need not be there."""
    df = h.documents(spark, ("text/html", []), ("application/zip", []))
    entries = [e for e in RulesTable.default().entries if e.stage_key not in ("ner", "analytical", "archive")]
    engine = Engine.default(analytical=False, table=RulesTable(entries, ["ner", "archive"]))
    assert [r.resolution for r in engine.resolve(df).orderBy("id").collect()] == [None, None]
    assert df.select(ff.completed(engine.table.flags("ner")).alias("c")).first().c
    with pytest.raises(ValueError, match="no stage 'archive'"):
        Engine.default(table=RulesTable(entries))


def test_tables_of_very_many_entries(spark, tmp_path):
    """Twenty thousand entries route the others as a short table does, and are read
    under a bound of one's own."""
    import json

    from docroute import fixtures
    from docroute.functions.flags import LONG_TABLE

    n = 20_000
    stages = {key: [{"flag": e.flag, "route": e.route, "type": e.type} for e in RulesTable.default().stage(key)] for key in RulesTable.default().stages()}
    stages["bulk"] = [{"flag": f"bulk'{i}\\", "route": f"q{i % 15_000}é", "type": "queue"} for i in range(n)]
    lines = "\n".join(json.dumps({"stage_key": k, "required": v}) for k, v in stages.items())
    (tmp_path / "rules.json").write_text(lines)
    with pytest.raises(ValueError, match="at most"):
        RulesTable.read(spark, str(tmp_path / "rules.json"))
    table = RulesTable.read(spark, str(tmp_path / "rules.json"), most=30_000)
    assert len(table.entries) > n > LONG_TABLE
    bulk = Rule("Bulk", F.col("mimetype") == "x/bulk", ["bulk"])
    long, short = Engine([bulk, *default_rules(True)], table), Engine.default(True)
    docs = fixtures.documents(spark, "/root/testdata/sf0.001").limit(60)
    sends = lambda engine, df: sorted(
        (r.id, repr(r.resolution), repr(r.sends)) for r in select_sends(engine.resolve(df), engine.table).collect()
    )
    assert sends(long, docs) == sends(short, docs)
    one = h.documents(spark, ("x/bulk", [begun("bulk'3\\"), ended("bulk'4\\", reset=LATER)]))
    resolved = select_sends(long.resolve(one), table).first()
    # One per route, but for that of the flag which has begun and has a second entry.
    flags = [s.flag for s in resolved.resolution.sends]
    assert len(flags) == 15_000 and "bulk'3\\" not in flags and "bulk'15003\\" in flags and "bulk'4\\" in flags
    assert len(resolved.sends) == 15_000


def test_own_constants_of_the_statements():
    """The statements hold the lists and the table themselves; both are the same."""
    import oracle
    from docroute.functions import mimetypes as m

    for name in ("ARCHIVE", "SPREADSHEET", "ANALYSABLE", "XML", "TEXT", "OFFICE"):
        assert sorted(getattr(oracle, name)) == sorted(getattr(m, name)), name
    assert [len(getattr(oracle, n)) for n in ("ARCHIVE", "SPREADSHEET", "ANALYSABLE", "XML", "TEXT", "OFFICE")] == [33, 8, 2, 9, 50, 21]
    assert oracle.DEFAULT_ENTRIES == DEFAULT_ENTRIES


def test_custom_rule_and_table(spark):
    table = RulesTable([("first", 0, "a", "qa"), ("second", 0, "b", "qb"), ("empty", 0, "a", "qa")])
    mime = F.col("mimetype")
    engine = Engine(
        [
            Rule("Waiting", mime == "x/wait", [Stage("empty", empty_wins=True)]),
            Rule("Both", mime.startswith("x/"), ["first", Stage("second", mime == "x/two")]),
        ],
        table,
    )
    df = h.documents(
        spark,
        ("x/one", []),
        ("x/one", [begun("a")]),
        ("x/two", [begun("a")]),
        ("x/wait", [begun("a")]),
        ("x/wait", [ended("a")]),
        ("y/one", []),
    )
    assert outcomes(engine, df) == [
        ("first", ["qa"]),
        None,
        ("second", ["qb"]),
        ("empty", []),
        None,
        None,
    ]


def test_quotes_in_names(spark):
    table = RulesTable([("it's", 0, "a'b\\c", "q'\\")])
    engine = Engine([Rule("Rule's", F.lit(True), ["it's"])], table)
    df = h.documents(spark, ("x", []), ("x", [begun("a'b\\c")]))
    assert outcomes(engine, df) == [("it's", ["q'\\"]), None]


def test_no_rules(spark):
    assert outcomes(Engine([]), h.documents(spark, ("text/plain", []))) == [None]


SHARED = RulesTable([("s", 0, "a", "q"), ("s", 1, "b", "q"), ("s", 2, "c", "r")])


def test_shared_route_is_sent_once_under_its_first_flag(spark):
    engine = Engine([Rule("All", F.lit(True), ["s"])], SHARED)
    df = h.documents(
        spark,
        ("x", []),
        ("x", [begun("a")]),
        ("x", [begun("a", queued=True)]),
        ("x", [begun("a"), begun("b")]),
    )
    rows = select_sends(engine.resolve(df), SHARED).orderBy("id").collect()
    assert [[(s.flag, s.route) for s in r.resolution.sends] for r in rows] == [
        [("a", "q"), ("c", "r")],
        [("b", "q"), ("c", "r")],
        [("b", "q"), ("c", "r")],
        [("c", "r")],
    ]
    assert [[(s.flag, s.route) for s in r.sends] for r in rows] == [
        [("a", "q"), ("c", "r")],
        [("a", "q"), ("c", "r")],
        [("c", "r")],
        [("c", "r")],
    ]


def test_mimetype_predicates_take_null_as_no(spark):
    df = spark.createDataFrame([(None,)], "mimetype string")
    row = df.select(*[p().alias(n) for n, p in m.PREDICATES.items()]).first()
    assert not any(row)
