"""Removal of repeated byte strings against plain Python, and the sort against
Python's own."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docroute.llm import suffixes
from docroute.llm.text import Texts
from tests.llm.helpers import awkward_rows, rows_of, sentences, written


def plain(rows, size):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row."""
    bodies = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + size] for _, b in bodies for i in range(len(b) - size + 1))
    out = []
    for d, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def passages(seed, n):
    """Texts that share passages of about 200 bytes, in various surroundings."""
    r = random.Random(seed)
    stock = [sentences(seed + i, r.randrange(20, 60)) for i in range(6)]
    rows = []
    for i in range(n):
        parts = [sentences(1000 * seed + i, r.randrange(0, 30))]
        for _ in range(r.randrange(0, 4)):
            whole = r.choice(stock)
            lo = r.randrange(0, 60)
            parts += [whole[lo : lo + r.randrange(150, 300)], sentences(r.randrange(10**6), r.randrange(0, 12))]
        rows.append((1000 + i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("size, key, large", [(200, 64, 4096), (200, 64, 2), (67, 8, 4096), (200, 200, 3)])
def test_remove_repeated_bytes(spark, tmp_path, size, key, large):
    """Also where keys have more different segments than a task compares."""
    rows = awkward_rows() + passages(3, 80) + [(7000 + i, "ab" * 150 + "c" * i) for i in range(3)]
    docs = written(spark, tmp_path / "docs", rows).withColumns({c: F.lit("x") for c in ("file", "row", "text2", "spans", "key", "id")})
    got = suffixes.remove_repeated_bytes(docs, size, key, large)
    assert rows_of(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept"))) == sorted(
        [(d, n, m, s, bytearray(k)) for d, n, m, s, k in plain(rows, size)], key=repr
    )


def test_derived_and_empty_tables(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", passages(4, 30))
    some = docs.filter("doc_id % 2 = 0").orderBy("text")
    want = plain([r for r in passages(4, 30) if r[0] % 2 == 0], 200)
    assert [tuple(r)[:4] for r in rows_of(suffixes.remove_repeated_bytes(some))] == [r[:4] for r in want]
    assert suffixes.remove_repeated_bytes(written(spark, tmp_path / "empty", [])).collect() == []


def test_windows_have_one_anchor_and_meet(monkeypatch):
    """Pieces of any length give each window to one segment that holds its anchor."""
    import pyarrow as pa

    bodies = [sentences(9, 300), "z" * 700, "short", sentences(9, 300)[40:900]]
    texts = Texts(pa.array(bodies))
    for step in (1 << 21, 500, 64):
        seen = []
        for starts, numbers, anchors in suffixes.segments(texts, 200, 64, step):
            for p, n, a in zip(starts.tolist(), numbers.tolist(), anchors.tolist()):
                seen += [(p + i, a) for i in range(n)]
                assert p + n - 1 <= a <= p + 200 - 64
        want = [p for i in range(4) for p in range(texts.ptr[i], texts.ptr[i + 1] - 199)]
        assert [p for p, _ in seen] == want
        where = {}
        for p, a in seen:
            where.setdefault(texts.bytes_of(p, p + 200), set()).add(a - p)
        assert all(len(v) == 1 for v in where.values())


@pytest.mark.parametrize("shallow", [0, 2, 100])
@pytest.mark.parametrize("size", [30, 32, 5])
def test_suffix_sort(shallow, size):
    r = random.Random(size)
    raw = bytes(r.choice(b"ab\xff\0") for _ in range(400)) + b"abab" * 40 + bytes(range(256))
    raw += raw[100:300]
    data = np.frombuffer(raw + bytes(8), np.uint8)
    places = np.arange(len(raw) - size + 1)
    groups = places % 2
    sort = suffixes.SuffixSort(data, places, groups, size, shallow)
    keys = [(p % 2, raw[p : p + size]) for p in places]
    ordered = sorted(keys)
    assert [ordered.index(k) for k in keys] == sort.rank.tolist()
    count = Counter(keys)
    assert [count[k] > 1 for k in keys] == sort.repeated.tolist()
