"""DuckDB SQL with the same results as the registered queries.

Flags are rows here, one per document and entry, and the rules are joins and
grouped conditions, so the method differs from the nested arrays of the library.
"""

from __future__ import annotations

# Fixed values, written out here so that the statements do not rest on the library's.
ARCHIVE = [
    "application/gzip",
    "application/vnd.ms-cab-compressed",
    "application/x-7z-compressed",
    "application/x-ace-compressed",
    "application/x-alz-compressed",
    "application/x-apple-diskimage",
    "application/x-arj",
    "application/x-astrotite-afa",
    "application/x-b1",
    "application/x-bzip2",
    "application/x-cfs-compressed",
    "application/x-compress",
    "application/x-cpio",
    "application/x-dar",
    "application/x-dgc-compressed",
    "application/x-gca-compressed",
    "application/x-gtar",
    "application/x-lzh",
    "application/x-lzip",
    "application/x-lzma",
    "application/x-lzop",
    "application/x-lzx",
    "application/x-par2",
    "application/x-rar-compressed",
    "application/x-sbx",
    "application/x-shar",
    "application/x-snappy-framed",
    "application/x-stuffit",
    "application/x-stuffitx",
    "application/x-tar",
    "application/x-xz",
    "application/x-zoo",
    "application/zip",
]
SPREADSHEET = [
    "application/vnd.lotus-1-2-3",
    "application/vnd.ms-excel",
    "application/vnd.ms-excel.sheet.macroenabled.12",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.template",
    "application/vnd.stardivision.calc",
    "application/vnd.sun.xml.calc",
    "application/vnd.sun.xml.calc.template",
]
ANALYSABLE = [
    "text/csv",
    "text/tab-separated-values",
]
XML = [
    "application/rdf+xml",
    "application/smil+xml",
    "application/vnd.google-earth.kml+xml",
    "application/xml",
    "application/xslt+xml",
    "image/svg+xml",
    "model/x3d+xml",
    "text/xml",
    "xml/dtd",
]
TEXT = [
    "message/news",
    "message/rfc822",
    "text/aln",
    "text/calendar",
    "text/css",
    "text/fasta",
    "text/hkl",
    "text/html",
    "text/markdown",
    "text/matlab",
    "text/nex",
    "text/plain",
    "text/r",
    "text/rtf",
    "text/texmacs",
    "text/troff",
    "text/vcard",
    "text/x-asm",
    "text/x-awk",
    "text/x-bibtex",
    "text/x-c",
    "text/x-c++",
    "text/x-c++hdr",
    "text/x-c++src",
    "text/x-chdr",
    "text/x-csh",
    "text/x-csrc",
    "text/x-diff",
    "text/x-dsrc",
    "text/x-fortran",
    "text/x-gawk",
    "text/x-java",
    "text/x-lisp",
    "text/x-literate-haskell",
    "text/x-m4",
    "text/x-makefile",
    "text/x-msdos-batch",
    "text/x-objective-c",
    "text/x-pascal",
    "text/x-perl",
    "text/x-php",
    "text/x-po",
    "text/x-python",
    "text/x-ruby",
    "text/x-scala",
    "text/x-sfv",
    "text/x-sh",
    "text/x-shellscript",
    "text/x-tcl",
    "text/x-tex",
]
OFFICE = [
    "application/msword",
    "application/pdf",
    "application/rtf",
    "application/vnd.apple.pages",
    "application/vnd.ms-cab-compressed",
    "application/vnd.ms-powerpoint",
    "application/vnd.oasis.opendocument.chart",
    "application/vnd.oasis.opendocument.database",
    "application/vnd.oasis.opendocument.presentation",
    "application/vnd.oasis.opendocument.text",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.openxmlformats-officedocument.presentationml.slideshow",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.sun.xml.draw.template",
    "application/vnd.sun.xml.impress.template",
    "application/vnd.visio",
    "application/vnd.wordperfect",
    "application/x-appleworks3",
    "application/x-ms-manifest",
    "application/x-ms-pdb",
    "application/x-msaccess",
]
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

# -- the derived tables ---------------------------------------------------------------

DERIVED = """
mime(i, mimetype) AS (VALUES
 (0,'application/gzip'),(1,'application/vnd.ms-cab-compressed'),(2,'application/vnd.ms-excel'),(3,'text/csv'),
 (4,'text/tab-separated-values'),(5,'text/tab-custom'),(6,'text/html'),(7,'text/webviewhtml'),
 (8,'text/html; charset=utf-8'),(9,'application/xml'),(10,'image/svg+xml'),(11,'text/plain'),
 (12,'message/rfc822'),(13,'text/x-python'),(14,'application/msword'),(15,'application/rtf'),
 (16,'application/pdf'),(17,'application/pdf'),(18,'chemical/x-inchi'),(19,'image/png'),
 (20,'audio/wav'),(21,'video/mpeg'),(22,'dummy/mimetype'),(23,'application/x-tar')),
keys(k, flag_key) AS (VALUES
 (0,'unarchived'),(1,'tabular.totsv'),(2,'tabular.analysis'),(3,'rawtext'),(4,'pdf.intermediates'),
 (5,'bounding_box'),(6,'analytical'),(7,'ner.leadmine.chemblactivityterms'),
 (8,'ner.leadmine.chemicalentities'),(9,'ner.leadmine.chemicalidentifiers'),
 (10,'ner.leadmine.poseidon'),(11,'ner.leadmine.geneprotein')),
docs AS (SELECT lpad(lower(hex(d.doc_id)),24,'0') AS id, d.doc_id, m.mimetype
 FROM documents d JOIN mime m ON m.i = d.doc_id % 24),
st AS (SELECT id, doc_id, k, flag_key,
 ((doc_id+1)*(2*k+3)*7919 + k*104729) % 1009 % 10 AS s,
 TIMESTAMP '2024-01-01 00:00:00.25' + doc_id * INTERVAL '1' SECOND AS t0 FROM docs CROSS JOIN keys),
first_flags AS (SELECT id, doc_id, t0, k AS seq, flag_key, s,
 CASE WHEN s >= 3 THEN t0 END AS started,
 CASE WHEN s >= 4 THEN t0 + INTERVAL '60' SECOND END AS ended,
 CASE WHEN s = 8 THEN t0 + INTERVAL '600' SECOND
      WHEN s = 9 AND k % 2 = 1 THEN t0 + INTERVAL '0.5' SECOND
      WHEN s = 9 THEN t0 - INTERVAL '600' SECOND
      WHEN s = 2 AND doc_id % 5 = 0 THEN t0 END AS reset,
 CASE WHEN s IN (2,3) THEN true WHEN s = 8 AND doc_id % 3 = 0 THEN true
      WHEN s = 7 THEN false END AS queued
 FROM st WHERE s >= 2),
flags AS (SELECT id, seq, flag_key, started, ended, reset, queued FROM first_flags
 UNION ALL
 SELECT id, seq + 100, flag_key, t0 - INTERVAL '86400' SECOND, t0 - INTERVAL '86340' SECOND,
  CAST(NULL AS TIMESTAMP), true
 FROM first_flags WHERE (s = 6 AND doc_id % 4 = 0) OR (s = 8 AND doc_id % 7 = 0))"""

DERIVED_MESSAGES = """
msgs AS (SELECT e.event_id AS seq, e.ts,
 CASE WHEN e.event_id % 97 = 0 THEN 'not json'
      WHEN e.event_id % 89 = 0 THEN '{"reset":["rawtext"]}'
      WHEN e.event_type = 'error' THEN concat('{"id":"', lpad(lower(hex(CAST(floor(e.event_id/9) AS BIGINT))),24,'0'), '","reset":["rawtext","', k.flag_key, '"]}')
      ELSE concat('{"id":"', lpad(lower(hex(CAST(floor(e.event_id/9) AS BIGINT))),24,'0'), '"}') END AS body
 FROM events e JOIN keys k ON k.k = e.event_id % 12),"""

HOT_MESSAGES = DERIVED_MESSAGES.replace("msgs AS", "plain_msgs AS") + """
msgs AS (SELECT seq, ts, CASE WHEN seq % 7 = 1 THEN '{"id":"' || lpad(lower(hex(999999999)),24,'0') || '"}'
  WHEN seq % 3 = 0 THEN regexp_replace(body, '"id":"[0-9a-f]{24}"', '"id":"' || lpad(lower(hex(16)),24,'0') || '"')
  ELSE body END AS body FROM plain_msgs),"""

INTERLEAVED_MESSAGES = DERIVED_MESSAGES.replace("msgs AS", "plain_msgs AS") + """
msgs AS (SELECT seq % 9 * 1000000000000 + seq AS seq,
 TIMESTAMP '2030-01-01 00:00:00' + to_hours(CAST(seq % 9 AS INTEGER)) AS ts, body FROM plain_msgs),"""

DECODED = """
parsed AS (SELECT seq, ts, CASE WHEN json_valid(body) THEN body::JSON END AS j FROM msgs),
typed AS (SELECT seq, ts, j,
 coalesce(json_type(j, '$.id') = 'VARCHAR', false) AND (coalesce(json_type(j, '$.reset'), 'NULL') = 'NULL'
  OR (json_type(j, '$.reset') = 'ARRAY'
   AND len([x for x in json_extract(j, '$.reset[*]') if json_type(x) <> 'VARCHAR']) = 0)) AS ok
 FROM parsed),
decoded AS (SELECT seq, ts, ok,
 CASE WHEN ok THEN CASE WHEN regexp_matches(j->>'$.id', '^[0-9a-fA-F]{24}$') THEN lower(j->>'$.id') ELSE j->>'$.id' END END AS id,
 CASE WHEN ok AND json_type(j, '$.reset') = 'ARRAY' THEN CAST(json_extract(j, '$.reset') AS VARCHAR[]) END AS reset,
 CASE WHEN NOT ok THEN 'undecodable'
      WHEN NOT regexp_matches(j->>'$.id', '^[0-9a-fA-F]{24}$') THEN 'bad_id' END AS reason
 FROM typed),
valid AS (SELECT seq, ts, id, reset FROM decoded WHERE reason IS NULL)"""


MESSAGES = DERIVED_MESSAGES + DECODED


def _reset(flags: str, asked: str) -> str:
    """Flags after the resets in ``asked`` (id, flag_key, ts)."""
    return f"""
marked AS (SELECT f.id, f.seq, f.flag_key, f.started, f.ended, coalesce(a.ts, f.reset) AS reset, f.queued,
  a.ts IS NOT NULL AS renewed,
  row_number() OVER (PARTITION BY f.id, f.flag_key ORDER BY f.started DESC NULLS LAST, f.seq) AS latest
 FROM {flags} f LEFT JOIN {asked} a ON a.id = f.id AND a.flag_key = f.flag_key),
renewed_flags AS (SELECT id, seq, flag_key, started, ended, reset, queued FROM marked WHERE NOT renewed OR latest = 1)"""


ALL_ASKED = """
named AS (SELECT id, seq, ts, unnest(reset) AS flag_key FROM valid),
asked AS (SELECT id, flag_key, ts FROM named
 QUALIFY row_number() OVER (PARTITION BY id, flag_key ORDER BY seq DESC) = 1)"""


# -- the rules ----------------------------------------------------------------------


def _values(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


PREDICATES = f"""
pred AS (SELECT id, mimetype,
 mimetype IN ({_values(ARCHIVE)}) AS is_archive,
 mimetype IN ({_values(SPREADSHEET)}) AS is_spreadsheet,
 mimetype IN ({_values(ANALYSABLE)}) AS is_analysable,
 regexp_matches(mimetype, '^(text/(csv|tab.*))$') AS is_tabular_text,
 regexp_matches(mimetype, '(text/((x-server-parsed-|webview)*html))') AS is_html,
 mimetype IN ({_values(XML)}) AS is_xml,
 mimetype IN ({_values(TEXT)}) AS is_text,
 mimetype IN ({_values(OFFICE + SPREADSHEET)}) AS is_raw_text_convertible,
 mimetype = 'application/pdf' AS needs_page_images,
 mimetype = 'application/pdf' AS needs_bounding_boxes,
 regexp_matches(mimetype, 'chemical/(.*)') AS is_chemical,
 regexp_matches(mimetype, 'image/(.*)') AS is_image,
 regexp_matches(mimetype, 'audio/(.*)') AS is_audio,
 regexp_matches(mimetype, 'video/(.*)') AS is_video
 FROM docs)"""

# (rule, stage, condition, wins when empty)
STEPS = [
    ("Archive", "archive", "is_archive", True),
    ("Tabular", "tabular.totsv", "is_spreadsheet", False),
    ("Tabular", "ner", "is_tabular_text", False),
    ("Tabular", "tabular.analyse", "is_tabular_text AND is_analysable", False),
    ("HTML", "ner", "is_html", False),
    ("XML", "ner", "is_xml", False),
    ("Text", "ner", "is_text", False),
    ("Document", "text", "is_raw_text_convertible", False),
    ("PDF", "image_intermediate", "needs_page_images", False),
    ("PDF", "bounding_box", "needs_bounding_boxes", False),
    ("Chemical", "ner", "is_chemical", False),
    ("Analytical", "analytical", "true", False),
]


def _required(entries: list[tuple]) -> str:
    rows = ", ".join(f"('{s}', {o}, '{f}', '{r}')" for s, o, f, r, _ in entries)
    return f"\nreq(stage_key, ordinal, flag, route) AS (VALUES {rows})"


def _allowed(flags: str, entries: list[tuple]) -> str:
    """Every document against every required entry."""
    return f"""{_required(entries)},
head AS (SELECT * FROM {flags} QUALIFY row_number() OVER (PARTITION BY id, flag_key ORDER BY seq) = 1),
per_key AS (SELECT id, flag_key, bool_or(ended IS NOT NULL) AS any_ended, bool_or(coalesce(queued, false)) AS any_queued
 FROM {flags} GROUP BY id, flag_key),
allowed AS (SELECT d.id, r.*, CASE WHEN r.flag = 'analytical' THEN true
   WHEN h.flag_key IS NULL THEN true WHEN h.reset IS NULL THEN false WHEN h.started IS NULL THEN NULL
   ELSE date_trunc('second', h.reset) > date_trunc('second', h.started) END AS allowed
 FROM docs d CROSS JOIN req r LEFT JOIN head h ON h.id = d.id AND h.flag_key = r.flag),
progress AS (SELECT d.id, r.stage_key, bool_and(coalesce(p.any_ended, false)) AS completed,
  bool_and(p.flag_key IS NOT NULL) AS started_all
 FROM docs d CROSS JOIN req r LEFT JOIN per_key p ON p.id = d.id AND p.flag_key = r.flag GROUP BY d.id, r.stage_key)"""


def _resolved(flags: str, steps: list[tuple], entries: list[tuple] = DEFAULT_ENTRIES) -> str:
    """Every document with its rule and stage, and its sends in long form."""
    table = ", ".join(f"({n}, '{r}', '{s}', {str(e).lower()})" for n, (r, s, _, e) in enumerate(steps))
    conditions = " ".join(f"WHEN {n} THEN {c}" for n, (_, _, c, _) in enumerate(steps))
    return f"""{_allowed(flags, entries)},{PREDICATES},
step(n, rule, stage_key, empty_wins) AS (VALUES {table}),
stage AS (SELECT id, stage_key, count(*) FILTER (WHERE allowed) AS n_allowed, bool_or(allowed IS NULL) AS erred
 FROM allowed GROUP BY id, stage_key),
firing AS (SELECT p.id, s.n, s.rule, s.stage_key, g.erred
 FROM pred p CROSS JOIN step s JOIN stage g ON g.id = p.id AND g.stage_key = s.stage_key
 JOIN progress c ON c.id = p.id AND c.stage_key = s.stage_key
 WHERE (CASE s.n {conditions} END) AND (CASE WHEN s.empty_wins THEN NOT c.completed ELSE g.erred OR g.n_allowed > 0 END)),
chosen AS (SELECT * FROM firing QUALIFY row_number() OVER (PARTITION BY id ORDER BY n) = 1),
sends AS (SELECT c.id, a.stage_key, a.ordinal, a.flag, a.route
 FROM chosen c JOIN allowed a ON a.id = c.id AND a.stage_key = c.stage_key WHERE NOT c.erred AND a.allowed
 QUALIFY row_number() OVER (PARTITION BY c.id, a.route ORDER BY a.ordinal) = 1),
resolved AS (SELECT d.id, d.mimetype, c.rule, c.stage_key,
  CASE WHEN c.id IS NOT NULL THEN CAST(coalesce(n.n, 0) AS INTEGER) END AS n_sends,
  CASE WHEN c.erred THEN 'reset_without_start' END AS error
 FROM docs d LEFT JOIN chosen c ON c.id = d.id
 LEFT JOIN (SELECT id, count(*) AS n FROM sends GROUP BY id) n ON n.id = d.id)"""


def _selected(asked: str | None) -> str:
    """The sends that pass the second gate."""
    unless = (
        f" AND (p.any_queued IS NOT TRUE OR EXISTS (SELECT 1 FROM {asked} a WHERE a.id = s.id AND a.flag_key = c.flag))"
        if asked
        else " AND p.any_queued IS NOT TRUE"
    )
    return f"""
config AS (SELECT * FROM req QUALIFY row_number() OVER (PARTITION BY stage_key, route ORDER BY ordinal) = 1),
selected AS (SELECT s.id, s.stage_key, c.flag, s.route
 FROM sends s JOIN config c ON c.stage_key = s.stage_key AND c.route = s.route
 LEFT JOIN per_key p ON p.id = s.id AND p.flag_key = c.flag WHERE true{unless})"""


PLAIN = STEPS[:-1]
NO_ERROR = "resolved WHERE stage_key IS NOT NULL"

SHARED_ROUTES = [
    ("ner", 0, "ner.leadmine.chemblactivityterms", "ner.chemistry", "queue"),
    ("ner", 1, "ner.leadmine.chemicalentities", "ner.chemistry", "queue"),
    ("ner", 2, "ner.leadmine.chemicalidentifiers", "ner.chemistry", "queue"),
    ("ner", 3, "ner.leadmine.poseidon", "ner.biology", "queue"),
    ("ner", 4, "ner.leadmine.geneprotein", "ner.biology", "queue"),
] + [e for e in DEFAULT_ENTRIES if e[0] != "ner"]

CUSTOM_ENTRIES = DEFAULT_ENTRIES + [
    ("media", 0, "rawtext", "media.caption", "queue"),
    ("media", 1, "bounding_box", "media.objects", "queue"),
]
CUSTOM_STEPS = PLAIN + [("Media", "media", "is_image OR is_audio OR is_video", False)]

IDLE_STEPS = [
    ("Idle", "media", "NOT EXISTS (SELECT 1 FROM now_flags f WHERE f.id = p.id AND coalesce(f.queued, false))", False)
] + STEPS

FLAG_TEST_ENTRIES = [
    ("flag-test", 0, "rawtext", "flag.one", "queue"),
    ("flag-test", 1, "tabular.totsv", "flag.two", "queue"),
    ("flag-test", 2, "bounding_box", "flag.three", "queue"),
]


def _flag_test() -> str:
    """Every document is sent to all queues of one stage."""
    return f"""{_allowed("now_flags", FLAG_TEST_ENTRIES)},
chosen AS (SELECT id, 'flag-test' AS stage_key, false AS erred FROM docs d),
sends AS (SELECT d.id, r.stage_key, r.ordinal, r.flag, r.route FROM docs d CROSS JOIN req r)"""


# Between the two batches of the live store a consumer begins and ends every second
# flag that waits in a queue, and every fifth document arrives.
CONSUMED = "TIMESTAMP '2031-01-01 00:00:00'"


# In the log of three batches a consumer begins and ends every second flag that waits
# after the first one; of flags that the supervisor added, it writes its own entry.
FIRST_TURN, REQUEUE_CONSUMED = 3_000_000_000_000, "TIMESTAMP '2030-01-01 02:30:00'"


def _log(resolved: str | None = None, messages: str = MESSAGES, live: bool = False, requeue: bool = False) -> str:
    """All messages in order: the n-th round handles the n-th message of every
    document.  The state is rows too: ``doc`` and ``flag`` rows carry on to the
    next round, ``done`` rows are the outcomes and ``send`` rows what was sent.

    ``live``: the store changes halfway through the log.  ``requeue``: it does after
    the first third of every document's messages."""
    cur = "l.*"
    if requeue:
        consumed = (
            f"l.kind = 'flag' AND m.seq >= {FIRST_TURN} AND coalesce(m.before < {FIRST_TURN}, true) AND l.started IS NULL"
            " AND l.flag_key IN (SELECT flag_key FROM keys WHERE k % 2 = 0)"
        )
        cur = (
            f"l.* REPLACE (CASE WHEN {consumed} THEN {REQUEUE_CONSUMED} ELSE l.started END AS started,"
            f" CASE WHEN {consumed} THEN {REQUEUE_CONSUMED} ELSE l.ended END AS ended,"
            f" CASE WHEN {consumed} AND l.seq >= 1000 THEN NULL ELSE l.queued END AS queued)"
        )
    if live:
        consumed = (
            "l.kind = 'flag' AND m.seq > (SELECT seq FROM halfway) AND l.started IS NULL AND l.seq < 1000"
            " AND l.flag_key IN (SELECT flag_key FROM keys WHERE k % 2 = 0)"
        )
        cur = (
            f"l.* REPLACE (CASE WHEN {consumed} THEN {CONSUMED} ELSE l.started END AS started,"
            f" CASE WHEN {consumed} THEN {CONSUMED} ELSE l.ended END AS ended)"
        )
    late = """
halfway AS (SELECT min(seq) + (max(seq) - min(seq)) // 2 AS seq FROM msgs),
early AS (SELECT v.seq, v.id FROM valid v JOIN docs d ON d.id = v.id
 WHERE d.doc_id % 5 = 0 AND v.seq <= (SELECT seq FROM halfway)),"""
    late = late if live else "\nearly AS (SELECT seq, id FROM valid WHERE false),"
    resolved = resolved or _resolved("now_flags", STEPS)
    inner = f"{resolved},{_selected('asked')}".replace("FROM docs d", "FROM now_docs d")
    return f"""{DERIVED},{messages},{late}
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS n,
  lag(seq) OVER (PARTITION BY id ORDER BY seq) AS before FROM valid
 WHERE seq NOT IN (SELECT seq FROM early)),
log AS (
 SELECT CAST(0 AS BIGINT) AS n, id, 'doc' AS kind, CAST(0 AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS flag_key,
  CAST(NULL AS TIMESTAMP) AS started, CAST(NULL AS TIMESTAMP) AS ended, CAST(NULL AS TIMESTAMP) AS reset,
  CAST(NULL AS BOOLEAN) AS queued, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS stage_key,
  CAST(NULL AS INTEGER) AS n_sent FROM docs
 UNION ALL
 SELECT 0, id, 'flag', seq, flag_key, started, ended, reset, queued, NULL, NULL, NULL FROM flags
 UNION ALL
 (WITH cur AS (SELECT {cur}, m.seq AS message, m.ts, m.reset AS named
   FROM log l JOIN ranked m ON m.id = l.id AND m.n = l.n + 1 WHERE l.kind IN ('doc', 'flag')),
 now_docs AS (SELECT id, n + 1 AS n, message, ts, named FROM cur WHERE kind = 'doc'),
 asked AS (SELECT DISTINCT id, unnest(named) AS flag_key FROM now_docs),
 marked AS (SELECT *, coalesce(list_contains(named, flag_key), false) AS renewed,
   row_number() OVER (PARTITION BY id, flag_key ORDER BY started DESC NULLS LAST, seq) AS latest
  FROM cur WHERE kind = 'flag'),
 now_flags AS (SELECT id, seq, flag_key, started, ended, CASE WHEN renewed THEN ts ELSE reset END AS reset, queued
  FROM marked WHERE NOT renewed OR latest = 1),{inner},
 counted AS (SELECT id, CAST(count(*) AS INTEGER) AS n FROM selected GROUP BY id)
 SELECT n, id, 'doc', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM now_docs
 UNION ALL
 SELECT d.n, f.id, 'flag', f.seq, f.flag_key, f.started, f.ended, f.reset,
  CASE WHEN s.id IS NOT NULL THEN true ELSE f.queued END, NULL, NULL, NULL
 FROM now_flags f JOIN now_docs d ON d.id = f.id LEFT JOIN selected s ON s.id = f.id AND s.flag = f.flag_key
 UNION ALL
 SELECT d.n, s.id, 'flag', 1000, s.flag, NULL, NULL, NULL, true, NULL, NULL, NULL
 FROM selected s JOIN now_docs d ON d.id = s.id
 WHERE NOT EXISTS (SELECT 1 FROM now_flags f WHERE f.id = s.id AND f.flag_key = s.flag)
 UNION ALL
 SELECT d.n, d.id, 'done', d.message, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN c.erred THEN 'reset_without_start' WHEN c.id IS NULL THEN 'no_match'
   WHEN k.n > 0 THEN 'sent' ELSE 'held' END, c.stage_key, coalesce(k.n, 0)
 FROM now_docs d LEFT JOIN chosen c ON c.id = d.id LEFT JOIN counted k ON k.id = d.id
 UNION ALL
 SELECT d.n, s.id, 'send', d.message, s.flag, NULL, NULL, NULL, NULL, s.route, s.stage_key, NULL
 FROM selected s JOIN now_docs d ON d.id = s.id)),
handled_to AS (SELECT id, max(n) AS n FROM log WHERE kind = 'doc' GROUP BY id),
last_flags AS (SELECT l.id, l.flag_key, l.queued, l.seq = 1000 AS added, h.n FROM log l
 JOIN handled_to h ON h.id = l.id AND h.n = l.n WHERE l.kind = 'flag'),
results AS (SELECT seq, id, status, stage_key, n_sent FROM log WHERE kind = 'done'
 UNION ALL SELECT seq, id, reason, NULL, 0 FROM decoded WHERE reason IS NOT NULL
 UNION ALL SELECT seq, id, 'missing_document', NULL, 0 FROM early
 UNION ALL SELECT seq, id, 'missing_document', NULL, 0 FROM valid v WHERE NOT EXISTS (SELECT 1 FROM docs d WHERE d.id = v.id))"""


RESULTS = "SELECT seq, id, status, stage_key, n_sent FROM results"
FAILURES = "('undecodable', 'bad_id', 'missing_document', 'reset_without_start')"


def statements() -> dict[str, str]:
    base = f"WITH {DERIVED}"
    msgs = f"{base},{MESSAGES}"
    allowed = f"{base},{_allowed('flags', DEFAULT_ENTRIES)}"
    log = f"WITH RECURSIVE {_log()}"
    sql = {
        "mimetype_predicates": f"{base},{PREDICATES} SELECT * FROM pred",
        "head_flags": f"""{base}
SELECT id, flag_key, true AS has_flag, started, ended, reset, queued FROM flags
QUALIFY row_number() OVER (PARTITION BY id, flag_key ORDER BY seq) = 1
UNION ALL SELECT d.id, k.flag_key, false, NULL, NULL, NULL, NULL FROM docs d CROSS JOIN keys k
WHERE NOT EXISTS (SELECT 1 FROM flags f WHERE f.id = d.id AND f.flag_key = k.flag_key)""",
        "stage_completed": f"{allowed} SELECT id, stage_key, completed, started_all FROM progress",
        "sendable_allowed": f"{allowed} SELECT id, stage_key, flag, allowed FROM allowed",
        "can_queue": f"""{msgs},{_allowed("flags", DEFAULT_ENTRIES)}
SELECT v.seq, v.id, k.flag_key AS flag,
 coalesce(list_contains(v.reset, k.flag_key), false) OR coalesce(NOT p.any_queued, true) AS can_queue
FROM valid v JOIN docs d ON d.id = v.id CROSS JOIN keys k
LEFT JOIN per_key p ON p.id = v.id AND p.flag_key = k.flag_key""",
        "queued_flags": f"""{allowed} SELECT d.id, k.flag_key AS flag, coalesce(p.any_queued, false) AS is_queued
FROM docs d CROSS JOIN keys k LEFT JOIN per_key p ON p.id = d.id AND p.flag_key = k.flag_key""",
        "stage_sendables": f"""{allowed} SELECT id, stage_key, ordinal, flag, route FROM allowed a WHERE allowed
AND NOT EXISTS (SELECT 1 FROM allowed b WHERE b.id = a.id AND b.stage_key = a.stage_key AND b.allowed IS NULL)""",
        "never_routed_media": f"""{base},{PREDICATES} SELECT id, mimetype,
CASE WHEN is_image THEN 'image' WHEN is_audio THEN 'audio' ELSE 'video' END AS media
FROM pred WHERE is_image OR is_audio OR is_video""",
        "resolve": f"{base},{_resolved('flags', PLAIN)} SELECT id, rule, stage_key, n_sends, error FROM resolved",
        "resolve_analytical": f"{base},{_resolved('flags', STEPS)} SELECT id, rule, stage_key, n_sends, error FROM resolved",
        "routing_summary": f"""{base},{_resolved('flags', STEPS)}
SELECT c.stage_key, s.route, count(*) AS n_docs FROM chosen c LEFT JOIN sends s ON s.id = c.id
WHERE NOT c.erred GROUP BY c.stage_key, s.route""",
        "distinct_routes": f"""{base},{_resolved('flags', STEPS, SHARED_ROUTES)}
SELECT id, stage_key, flag, route FROM sends""",
        "shared_route_sends": f"""{base},{_resolved('flags', STEPS, SHARED_ROUTES)},{_selected(None)}
SELECT id, stage_key, flag, route FROM selected""",
        "select_sends": f"""{base},{_resolved('flags', STEPS)},{_selected(None)}
SELECT id, stage_key, flag, route FROM selected""",
        "decode_messages": f"""{msgs} SELECT seq, id, CAST(len(reset) AS INTEGER) AS n_reset, ok FROM decoded""",
        "messages_with_document": f"""{msgs} SELECT v.seq, v.id, d.mimetype FROM valid v JOIN docs d ON d.id = v.id""",
        "missing_documents": f"""{msgs} SELECT seq, id FROM valid v WHERE NOT EXISTS (SELECT 1 FROM docs d WHERE d.id = v.id)""",
        "latest_flag_per_key": f"""{base} SELECT id, flag_key, started, ended, reset, queued FROM flags
QUALIFY row_number() OVER (PARTITION BY id, flag_key ORDER BY started DESC NULLS LAST, seq) = 1""",
        "reset_flags": f"""{msgs},{ALL_ASKED},{_reset("flags", "asked")} SELECT id, flag_key, started, reset FROM renewed_flags""",
        "reset_changed": f"""{msgs} SELECT v.seq, v.id, v.reset IS NULL OR EXISTS (SELECT 1 FROM flags f
WHERE f.id = v.id AND list_contains(v.reset, f.flag_key)) AS changed FROM valid v JOIN docs d ON d.id = v.id""",
        "dead_letters": f"{log} SELECT seq, status AS reason FROM results WHERE status IN {FAILURES}",
        "publish": f"""{log} SELECT status AS route, concat('{{"id":"', id, '"}}') AS body FROM log WHERE kind = 'send'""",
        "queue_flags": f"{log} SELECT id, flag_key, queued, added FROM last_flags WHERE n > 0",
        "supervise": f"{log} {RESULTS}",
        "written_flags": f"""{log} SELECT d.id, count(n.id) AS n_flags, count(n.id) FILTER (WHERE n.queued) AS n_queued
FROM docs d LEFT JOIN last_flags n ON n.id = d.id GROUP BY d.id""",
        "supervise_log": f"{log} {RESULTS}",
        "supervise_log_hot": f"WITH RECURSIVE {_log(messages=HOT_MESSAGES + DECODED)} {RESULTS}",
        "supervise_stream": f"{log} {RESULTS}",
        "supervise_stream_requeue": f"WITH RECURSIVE {_log(messages=INTERLEAVED_MESSAGES + DECODED, requeue=True)} {RESULTS}",
        "supervise_stream_live": f"WITH RECURSIVE {_log(live=True)} {RESULTS}",
        "rules_table": f"""{base},{_resolved('flags', PLAIN, [e for e in DEFAULT_ENTRIES if e[0] != "ner"])}
SELECT id, rule, stage_key, n_sends, error FROM resolved""",
        "custom_rule_log": f"WITH RECURSIVE {_log(_resolved('now_flags', IDLE_STEPS, CUSTOM_ENTRIES))} {RESULTS}",
        "custom_condition_log": f"WITH RECURSIVE {_log(_resolved('now_flags', IDLE_STEPS, CUSTOM_ENTRIES))} {RESULTS}",
        "custom_rule": f"""{base},{_resolved('flags', CUSTOM_STEPS, CUSTOM_ENTRIES)}
SELECT id, rule, stage_key, n_sends FROM resolved""",
        "custom_engine": f"WITH RECURSIVE {_log(_flag_test())} {RESULTS}",
    }
    for rule in dict.fromkeys(step[0] for step in STEPS):
        steps = [step for step in STEPS if step[0] == rule]
        sql[f"rule_{rule.lower()}"] = (
            f"{base},{_resolved('flags', steps)} SELECT id, stage_key, n_sends, error FROM {NO_ERROR}"
        )
    return sql
