"""A plain-Python model of message handling, one message after another.

Independent of the library: only for comparison in tests.
"""

from docroute.functions import mimetypes as m
from docroute.sources.rules import DEFAULT_ENTRIES

NER = "ner"


def _is(pattern):
    import re

    return lambda t: re.search(pattern, t) is not None


STEPS = [
    ("tabular.totsv", lambda t: t in m.SPREADSHEET),
    (NER, _is(m.TABULAR_TEXT_PATTERN)),
    ("tabular.analyse", lambda t: t in m.ANALYSABLE),
    (NER, _is(m.HTML_PATTERN)),
    (NER, lambda t: t in m.XML),
    (NER, lambda t: t in m.TEXT),
    ("text", lambda t: t in m.OFFICE + m.SPREADSHEET),
    ("image_intermediate", lambda t: t == m.PDF),
    ("bounding_box", lambda t: t == m.PDF),
    (NER, _is(m.CHEMICAL_PATTERN)),
    ("analytical", lambda t: True),
]


class Failed(Exception):
    pass


def required(stage):
    return [(flag, route) for s, _, flag, route, _ in DEFAULT_ENTRIES if s == stage]


def second(ts):
    return ts.replace(microsecond=0)


def allowed(flags, key):
    own = [f for f in flags if f["key"] == key]
    if key == "analytical" or not own:
        return True
    if own[0]["reset"] is None:
        return False
    if own[0]["started"] is None:
        raise Failed
    return second(own[0]["reset"]) > second(own[0]["started"])


def sendables(flags, stage):
    return [(flag, route) for flag, route in required(stage) if allowed(flags, flag)]


def resolve(mimetype, flags):
    if mimetype in m.ARCHIVE:
        done = [any(f["key"] == k and f["ended"] for f in flags) for k, _ in required("archive")]
        if not all(done):
            return "archive", lambda: sendables(flags, "archive")
    for stage, fits in STEPS:
        if fits(mimetype):
            try:
                sends = sendables(flags, stage)
            except Failed:
                return stage, lambda: sendables(flags, stage)
            if sends:
                return stage, lambda: sends
    return None


def apply_reset(flags, keys, now):
    for key in keys:
        own = [f for f in flags if f["key"] == key]
        if own:
            started = [f for f in own if f["started"] is not None]
            best = max(started, key=lambda f: f["started"]) if started else own[0]
            best["reset"] = now
            flags[:] = [f for f in flags if f["key"] != key or f is best]


def handle(mimetype, flags, reset, now):
    """Change ``flags`` and give (status, stage, routes)."""
    apply_reset(flags, reset or [], now)
    found = resolve(mimetype, flags)
    if found is None:
        return "no_match", None, []
    stage, get = found
    try:
        sends = get()
    except Failed:
        return "reset_without_start", stage, []
    sent = [
        (flag, route)
        for flag, route in sends
        if flag in (reset or []) or not any(f["key"] == flag and f["queued"] for f in flags)
    ]
    for flag, _ in sent:
        own = [f for f in flags if f["key"] == flag]
        for f in own:
            f["queued"] = True
        if not own:
            flags.append({"key": flag, "started": None, "ended": None, "reset": None, "queued": True})
    return ("sent" if sent else "held"), stage, [route for _, route in sent]
