import hashlib

from pyspark.sql import functions as F

import pytest

from docroute.llm import exact_dedup, ngram_join, substring
from docroute.llm.ngram_join import boundary
from tests.llm.helpers import (
    LOWER,
    awkward_rows,
    components,
    rows_of,
    sentences,
    without_repeated,
    written,
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_groups(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    out = []
    for d, t in rows:
        body = (t or "").translate(LOWER)
        known = [x for x in groups[body] if x is not None]
        keep = max(known) if known else None
        out.append((d, keep, len(groups[body]), d == keep, sha(body)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hex_digits", [64, 1])
def test_exact_dedup(spark, tmp_path, hex_digits):
    """With digests of one digit, texts of one digest differ and their bytes decide."""
    docs = written(spark, tmp_path / "docs", awkward_rows())
    digest = lambda text: F.substring(exact_dedup.sha256(text), 1, hex_digits)
    assert rows_of(exact_dedup.exact_dedup(docs, digest, files_per_trigger=1)) == exact_groups(awkward_rows())
    left = exact_dedup.drop_copies(docs, digest)
    assert left.columns == docs.columns
    bodies = sorted((t or "").translate(LOWER) for t in (r.text for r in left.collect()))
    assert bodies == sorted({(t or "").translate(LOWER) for _, t in awkward_rows()})


def test_exact_dedup_of_a_derived_and_an_empty_table(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows()).filter("doc_id < 5").orderBy("text")
    want = exact_groups([r for r in awkward_rows() if r[0] is not None and r[0] < 5])
    assert rows_of(exact_dedup.exact_dedup(docs)) == want
    empty = written(spark, tmp_path / "empty", [])
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert exact_dedup.drop_copies(empty).collect() == []


def test_columns_of_any_name_pass_through(spark, tmp_path):
    names = ["locator", "digest", "maybe", "bit", "bits", "bitmap", "own", "salt", "hot", "keep", "n", "file", "a.b"]
    rows = [(i, f"text {i % 4}", *(f"{c}{i}" for c in names)) for i in range(8)]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert rows_of(exact_dedup.exact_dedup(docs)) == exact_groups([r[:2] for r in rows])
    left = exact_dedup.drop_copies(docs)
    assert left.schema == docs.schema
    assert sorted(tuple(r) for r in left.collect()) == rows[4:]


def test_digests_of_many_rows_are_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 3)
    monkeypatch.setattr(exact_dedup, "HOT_DIGESTS", 10)
    rows = awkward_rows() + [(500 + i, "much the same" if i % 3 else "MUCH the same") for i in range(60)]
    docs = written(spark, tmp_path / "docs", rows)
    assert rows_of(exact_dedup.exact_dedup(docs)) == exact_groups(rows)
    digest = lambda text: F.substring(exact_dedup.sha256(text), 1, 1)
    assert rows_of(exact_dedup.exact_dedup(docs, digest)) == exact_groups(rows)
    assert exact_dedup.drop_copies(docs).count() == len({(t or "").translate(LOWER) for _, t in rows})


def test_exact_dedup_plan_is_native(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows())
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_near_copies(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows())
    assert rows_of(ngram_join.near_copies(docs)) == components(awkward_rows())
    left = ngram_join.drop_near_copies(docs)
    assert left.columns == docs.columns
    gone = {d for d, _, c in components(awkward_rows()) if d is not None and c is not None and c != d}
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(d) for d, _ in awkward_rows() if d not in gone)
    empty = written(spark, tmp_path / "empty", [])
    assert ngram_join.near_copies(empty).collect() == []


def test_near_copies_go_by_row_where_ids_repeat(spark, tmp_path):
    def near(seed, at):
        words = sentences(seed, 90).split()
        words[at] = f"other{at}"
        return " ".join(words)

    stay = [(1, sentences(1, 90)), (7, sentences(2, 90)), (8, sentences(4, 90)), (None, sentences(5, 90)), (None, None)]
    gone = [(7, near(1, 40)), (9, near(1, 50)), (None, near(1, 45)), (8, near(4, 30)), (None, near(5, 20)), (None, sentences(1, 90))]
    docs = written(spark, tmp_path / "docs", stay + gone)
    left = [(r.doc_id, r.text) for r in ngram_join.drop_near_copies(docs).collect()]
    # Which of two near copies with one id, or none, stays is for their places to say.
    either = {8: {sentences(4, 90), near(4, 30)}, None: {sentences(5, 90), near(5, 20), None}}
    assert sorted(t for d, t in left if d in (1, 7)) == sorted([sentences(1, 90), sentences(2, 90)])
    assert sorted(map(repr, (d for d, _ in left))) == sorted(repr(d) for d, _ in stay)
    assert all(t in either[d] for d, t in left if d not in (1, 7))
    derived = ngram_join.drop_near_copies(docs.filter("doc_id > 0"))
    assert sorted(r.doc_id for r in derived.collect()) == [1, 7, 8]


def group(seed, members, length, edits):
    """Near copies of one text, some of which are only linked by others."""
    import random

    r = random.Random(seed)
    base = sentences(seed, length, 5000).split()
    out = []
    for i in range(members):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(len(w))] = f"edit{seed}x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("light", [None, 0, 6, 30, 64])
def test_light_and_heavy_sets_agree(spark, tmp_path, monkeypatch, light):
    """Sets on both sides of the boundary, wherever it lies."""
    texts = [t for s in range(25) for t in group(s, 6, 5 + 3 * s, 4)] + group(99, 40, 60, 6)
    rows = list(enumerate(texts))
    if light is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda costs: light)
    docs = written(spark, tmp_path / "docs", rows)
    assert rows_of(ngram_join.near_copies(docs)) == components(rows)


@pytest.mark.parametrize("long_list,rounds", [(0, 1), (64, 1), (2, 2)])
def test_large_groups_lose_no_link(spark, tmp_path, monkeypatch, long_list, rounds):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", rounds)
    passage = sentences(500, 40, 5000)
    texts = group(7, 150, 80, 9) + [passage + " " + sentences(600 + i, 8, 5000) for i in range(60)]
    rows = list(enumerate(texts))
    docs = written(spark, tmp_path / "docs", rows)
    got = ngram_join.joined(docs, star_rounds=rounds)
    assert got[1].columns == ["u", "v"]
    assert rows_of(ngram_join.near_copies(docs)) == components(rows)


def test_boundary_weighs_subsets_against_scans():
    assert boundary([]) == 0
    assert boundary([(4, 1.0, 50.0), (40, 500.0, 60.0)]) in range(4, 40)
    assert boundary([(4, 100.0, 5.0), (40, 500.0, 60.0)]) == 0


def test_repeated_passages(spark, tmp_path):
    rows = awkward_rows()
    docs = written(spark, tmp_path / "docs", rows)
    want = sorted(((d, len(w), len(w) - len(k), sha(" ".join(k))) for d, w, k in without_repeated(rows)), key=repr)
    assert rows_of(substring.substring_digests(docs)) == want
    assert rows_of(substring.substring_digests(docs, cell_bits=3)) == want  # cells that nearly all collide
    left = substring.remove_repeated(docs)
    assert left.schema == docs.schema
    texts = [(d, t if len(k) == len(w) else " ".join(k)) for (d, w, k), (_, t) in zip(without_repeated(rows), rows)]
    assert rows_of(left.select("doc_id", "text")) == sorted(texts, key=repr)
    assert rows_of(left.drop("text")) == rows_of(docs.drop("text"))


def test_repeated_passages_of_other_sizes(spark, tmp_path):
    rows = [(i, sentences(i % 3, 12, 6)) for i in range(8)] + [(9, "a " * 30)]
    docs = written(spark, tmp_path / "docs", rows)
    for size in (1, 2, 9):
        want = sorted(((d, len(w), len(w) - len(k), sha(" ".join(k))) for d, w, k in without_repeated(rows, size)), key=repr)
        assert rows_of(substring.substring_digests(docs, size)) == want
    empty = written(spark, tmp_path / "empty", [])
    assert substring.substring_digests(empty).collect() == []
    assert substring.remove_repeated(empty).collect() == []
