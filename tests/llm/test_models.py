import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroute.llm import ann, elias_fano, exchange, langid, lm
from docroute.llm.exchange import Slices, pack_sorted, summed, unpack_sorted
from tests.llm.helpers import awkward_rows, sentences, words_of, written


def test_sorted_numbers_round_trip():
    r = np.random.default_rng(0)
    for wide in (False, True):
        for most in (5, 10**5, 2**40):
            cells = np.sort(r.integers(0, most, 1000, dtype=np.uint64))
            assert (unpack_sorted(pack_sorted(cells, wide), 1000, wide) == cells).all()
        assert len(unpack_sorted(pack_sorted(np.zeros(0, np.uint64), wide), 0, wide)) == 0


def test_counts_round_trip():
    counts = np.array([0, 1, 254, 255, 256, 70_000, 2**32 - 2, 2**32 - 1, 2**32, 2**40, 3])
    for some in (counts, counts[:3], counts[:0]):
        raw = exchange.pack_counts(some).tobytes()
        assert exchange.unpack_counts(raw, len(some)).tolist() == some.tolist()


def test_slices_cover_all_keys():
    keys = np.sort(np.array([0, 1, 2**63, 2**64 - 1], np.uint64))
    for n in (1, 3, 48, 844):
        s = Slices(n, 26)
        assert np.diff(s.edges(keys)).sum() == len(keys) and s.edges(keys)[0] == 0
        for i in range(n):
            a, b = s.edges(keys)[i : i + 2]
            assert (s.cells(keys[a:b], i) < 2**27).all()


def test_summed_counts_equals():
    keys = np.array([5, 3, 5, 9, 3, 5], np.uint64)
    assert summed(keys, None).tolist() == [3, 2, 3, 1, 2, 3]
    assert summed(keys, np.array([1, 2, 3, 4, 5, 0])).tolist() == [4, 7, 4, 4, 7, 4]
    assert summed(keys, None, np.array([1, 1, 2, 1, 1, 1], np.uint64)).tolist() == [2, 2, 1, 1, 2, 2]


def test_blocks_do_not_depend_on_batches(spark):
    import pyarrow as pa

    table = pa.table({"split": [1] * 7 + [2] * 5, "text": ["x" * 10] * 12, "i": list(range(12))})
    found = []
    for size in (1, 3, 100):
        got = exchange.blocks(iter(table.to_batches(max_chunksize=size)), most=25)
        found.append([(s, k, rows.column("i").to_pylist()) for s, k, rows in got])
    assert found[0] == found[1] == found[2]
    assert [f[2] for f in found[0]] == [[0, 1, 2], [3, 4, 5], [6], [7, 8, 9], [10, 11]]


def test_another_split_is_noticed(spark, tmp_path):
    table = exchange.with_split(written(spark, tmp_path / "docs", awkward_rows()), "text")
    slices = exchange.slices_for(table)
    keys = np.arange(1, 50, dtype=np.uint64) << np.uint64(50)

    def send(batches):
        for split, number, _ in exchange.blocks(batches):
            yield exchange.run_rows(slices, split, number, keys)

    folder = exchange.returned(table.mapInArrow(send, exchange.RUNS), slices, exchange.repeated_bits)
    split = table.first()["split"]
    assert exchange.Codes(folder, split).of(slices, 0, keys, bits=True).all()
    with pytest.raises(RuntimeError):
        exchange.Codes(folder, split).of(slices, 0, keys[1:], bits=True)


def test_elias_fano_sequence():
    r = np.random.default_rng(0)
    for n, most in ((0, 10), (1, 1), (1000, 50), (1000, 2**63), (5000, 10**6)):
        values = np.sort(r.integers(0, most, n, dtype=np.uint64))
        w = elias_fano.Writer()
        w.sequence(values, most)
        s = elias_fano.Sequence(elias_fano.Reader(w.buffer()))
        assert (s[np.arange(n)] == values).all()
        asked = np.concatenate([values[:100], r.integers(0, most, 200, dtype=np.uint64)])
        for v, place in zip(asked, s.find(asked)):
            assert values[place] == v if place >= 0 else v not in values
        places = np.full(len(asked), n // 2)
        inside = s.find(asked, places, np.full(len(asked), n))
        assert ((inside == -1) | (inside >= n // 2)).all()


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_trie_holds_what_it_is_given(tmp_path, order):
    r = np.random.default_rng(order)
    words = np.sort(r.integers(0, 2**63, 30, dtype=np.uint64))
    text = r.integers(0, 30, 500)
    streams, logs = [], []
    for k in range(order):
        grams = np.stack([text[i : len(text) - k + i] for i in range(k + 1)], axis=1)
        known: dict = {}
        streams.append(grams)
        logs.append(np.array([known.setdefault(tuple(g), -9 * r.random()) for g in grams.tolist()]))
    at = [np.arange(len(text) - k) for k in range(order)]
    writer = elias_fano.build(words, text, at, logs)
    writer.save(str(tmp_path / "trie"))
    for trie in (elias_fano.Trie(writer.buffer()), elias_fano.Trie.open(str(tmp_path / "trie"))):
        assert trie.word(words).tolist() == list(range(30))
        assert trie.word(np.array([1], np.uint64)).tolist() == [-1]
        longest = np.concatenate([*(logs[k][:1] for k in range(order - 1)), logs[-1]])
        assert np.abs(trie.scores(trie.word(words[text]), at) - longest).max() <= 0.5 / elias_fano.STEPS + 1e-9
        for grams, log in zip(streams, logs):
            assert np.abs(trie.log10(grams) - log).max() <= 0.5 / elias_fano.STEPS + 1e-9
            held = {tuple(g) for g in grams.tolist()}
            other = r.integers(0, 30, (200, grams.shape[1]))
            assert [not np.isnan(p) for p in trie.log10(other)] == [tuple(g) in held for g in other.tolist()]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(spark, tmp_path, order):
    rows = awkward_rows() + [(200 + i, sentences(20 + i % 7, 30, 40)) for i in range(30)]
    assert any(held(d) for d, _ in rows)
    docs = written(spark, tmp_path / "docs", rows)
    texts = [(d, [*words_of(t, lower=True), None]) for d, t in rows]
    counts = [Counter() for _ in range(order + 1)]
    for d, tokens in texts:
        if not held(d):
            for k in range(1, order + 1):
                counts[k].update(tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1))
    n, v = sum(counts[1].values()), len(counts[1])

    def p(gram):
        if len(gram) == 1:
            return (counts[1][gram] + 0.1) / (n + 0.1 * (v + 1))
        c, shorter = counts[len(gram) - 1][gram[:-1]], p(gram[1:])
        m = lm.RATE * c**lm.POWER
        return (counts[len(gram)][gram] + m * shorter) / (c + m) if c else shorter

    got = sorted((tuple(r) for r in lm.score(docs, order=order).collect()), key=lambda r: (repr(r[0]), r[2], round(r[5], 3)))
    want = []
    for d, tokens in texts:
        score = sum(math.log10(p(tuple(tokens[max(0, i + 1 - order) : i + 1]))) for i in range(len(tokens)))
        base = sum(math.log10(p((w,))) for w in tokens)
        want.append((d, held(d), len(tokens), sum(counts[1][(w,)] > 0 for w in tokens), n, base, score))
    want.sort(key=lambda r: (repr(r[0]), r[2], round(r[5], 3)))
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], abs=0.05 + 0.02 * b[2])


@pytest.mark.parametrize("times", [139, 1100])
def test_lm_of_a_frequent_context_sums_to_one(spark, tmp_path, times):
    # "a b" occurs so often, each time with another of ten words or the end after it.
    after = [*(f"w{i}" for i in range(10)), None]
    texts = [["a", "b", *([after[i % 11]] if after[i % 11] else [])] for i in range(times)]
    counts = [Counter() for _ in range(4)]
    for tokens in ([*t, None] for t in texts):
        for k in (1, 2, 3):
            counts[k].update(tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1))
    n, v = sum(counts[1].values()), len(counts[1])

    def p(*gram):
        if len(gram) == 1:
            return (counts[1][gram] + 0.1) / (n + 0.1 * (v + 1))
        c, shorter = counts[len(gram) - 1][gram[:-1]], p(*gram[1:])
        m = lm.RATE * c**lm.POWER
        return (counts[len(gram)][gram] + m * shorter) / (c + m) if c else shorter

    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = written(spark, tmp_path / "docs", rows)
    got = {r.doc_id: r.score for r in lm.score(docs, held=F.lit(False)).collect()}
    mass = p("other")  # every word that no text has
    for _ in range(2):
        mass *= (m := lm.RATE * times**lm.POWER) / (times + m)
    for i, w in enumerate(after):
        ends = [p("b", w, None)] if w else []
        mass += 10 ** (got[i] - sum(map(math.log10, [p("a"), p("a", "b"), *ends])))
    # The words a and b never follow; four probabilities a text are rounded in the trie.
    mass += p("a", "b", "a") + p("a", "b", "b")
    assert mass == pytest.approx(1, abs=0.01)


def test_lm_without_training_or_rows(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows()[:6])
    got = lm.score(docs, held=F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in got} == {(0, 0, 0.0)}
    assert lm.score(written(spark, tmp_path / "empty", [])).collect() == []


LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}


def language_text(r, lang, n):
    return " ".join("".join(r.choice(LETTERS[lang]) for _ in range(r.randint(2, 6))) for _ in range(n))


def language_docs(spark, path):
    r = random.Random(4)
    rows = [(i, language_text(r, lang, r.randint(3, 60)), lang) for i in range(300) for lang in [r.choice(list(LETTERS))]]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !?", "cc"), (None, language_text(r, "aa", 20), None)]
    rows += [(1003, language_text(r, "bb", 300) + " " + language_text(r, "cc", 100), None), (1004, language_text(r, "cc", 20_000), None)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path)), rows


def test_languages(spark, tmp_path):
    docs, rows = language_docs(spark, tmp_path / "docs")
    found = {r.doc_id: r for r in langid.languages(docs).collect()}
    assert len(found) == len(rows)
    for d, t, lang in rows[:300]:
        assert found[d].lang_pred == lang and found[d].score > 0.9
        assert found[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
    assert [(found[d].lang_pred, found[d].score) for d in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    mixed = found[1003]
    assert mixed.lang_pred == "bb" and set(mixed.mixture) == {"bb", "cc"} and mixed.score == pytest.approx(0.75, abs=0.02)
    assert found[1004].lang_pred == "cc" and found[None].lang_pred == "aa"
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.languages(docs, most=2)
    assert {r.doc_id for r in langid.keep_identified(docs).collect()} == set(found) - {1000, 1001, 1002}


@pytest.mark.parametrize("parts", [4, 6])
def test_languages_of_a_text_in_more_than_three(parts):
    r = random.Random(5)
    alphabet = "abcdefghijklmnopqrstuvwx"
    letters = [alphabet[4 * i : 4 * i + 4] for i in range(6)]
    texts = [" ".join("".join(r.choices(own, k=r.randint(2, 6))) for _ in range(400)) for own in letters]
    counts = np.array([np.bincount(langid.Grams(pa.array([t])).buckets, minlength=langid.BUCKETS) for t in texts])
    model = langid.Model([f"l{i}" for i in range(6)], counts)
    words = [w for t in texts[:parts] for w in t.split()[:100]]
    share = langid.mixtures(model, langid.Grams(pa.array([" ".join(words), texts[5], ""])))
    assert share[0] == pytest.approx([1 / parts] * parts + [0] * (6 - parts), abs=0.02)
    assert share[1].tolist() == [0, 0, 0, 0, 0, 1] and not share[2].any()


def plain_words(text):
    """Words as lists of gram buckets."""
    data = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in (text or "").encode())
    words = []
    for word in data.split(b" "):
        if word:
            padded = b" " + word + b" "
            grams = [padded[i] | padded[i + 1] << 8 | padded[i + 2] << 16 for i in range(len(word))]
            words.append([(g * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for g in grams])
    return words


def plain_mixture(likelihoods):
    """The proportions of the set of languages with the best penalised likelihood: all
    sets are tried, each fitted to the end."""
    n, k = likelihoods.shape
    best = None
    for subset in (s for size in range(1, k + 1) for s in itertools.combinations(range(k), size)):
        own = likelihoods[:, subset]
        top = own.max(1, keepdims=True)
        word, share = np.exp(own - top), np.full(len(subset), 1 / len(subset))
        for _ in range(300):
            joint = share * word
            share = (joint / joint.sum(1, keepdims=True)).mean(0)
        reached = np.log((share * word).sum(1)).sum() + top.sum()
        reached -= (len(subset) - 1) * langid.PENALTY / 2 * np.log(max(n, 2))
        if best is None or reached > best[0] + 1e-9:
            best = reached, dict(zip(subset, share))
    return best[1]


def test_languages_against_all_subsets(spark, tmp_path):
    """A plain model, and expectation-maximisation for every set of languages."""
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    r = random.Random(6)
    by_lang = {}
    for row in given:
        by_lang.setdefault(row.lang, []).append(row.text)
    rows = [(x.doc_id, x.text, x.lang) for x in given]
    rows += [rows[3], rows[3], (rows[5][0], rows[9][1], None)]  # repeated rows and ids
    for i in range(40):
        parts = [" ".join(r.choice(by_lang[v]).split()[: r.choice([5, 30, 120])]) for v in r.sample(sorted(by_lang), r.randint(2, 4))]
        rows.append((10**6 + i, " ".join(parts), None))
    schema = "doc_id long, text string, lang string, lang_pred string, score string, mixture string, letter string"
    spark.createDataFrame([(*x, "p", "s", "m", "l") for x in rows], schema).repartition(3).write.parquet(str(tmp_path / "docs"))
    got = langid.languages(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert len(got) == len(rows)

    counts = {lang: np.zeros(langid.BUCKETS) for lang in sorted(by_lang)}
    for d, text, lang in rows:
        if lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            for word in plain_words(text):
                np.add.at(counts[lang], word, 1)
    log = np.array([np.log((c + langid.SMOOTHING) / (c.sum() + langid.SMOOTHING * langid.BUCKETS)) for c in counts.values()])
    names, want = list(counts), {}
    for d, text, _ in rows:
        words = plain_words(text)
        found = plain_mixture(np.array([log[:, w].sum(1) for w in words])) if words else {}
        share = {names[j]: p for j, p in found.items()}
        want.setdefault(d, []).append(share)
    same, near = 0, 0
    for row in got:
        options = want[row.doc_id]
        assert row.lang_pred in {max(o, key=o.get) for o in options if o} or max(max(o.values()) for o in options) < 0.55
        same += any(set(row.mixture) == set(o) for o in options)
        near += any(abs(row.score - max(o.values())) < 0.03 for o in options if o)
    assert same >= 0.97 * len(got) and near >= 0.97 * len(got)


def test_languages_without_labels_and_clashing_names(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows())
    assert {r.lang_pred for r in langid.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    left = langid.keep_identified(docs)
    assert left.schema == docs.schema
    kept = {(t or "")[:20] for t in (r.text for r in left.collect())}
    assert kept == {t[:20] for _, t in awkward_rows() if t and any(c.isalpha() for c in t)}
    empty = written(spark, tmp_path / "empty", [])
    assert langid.languages(empty).collect() == [] and langid.keep_identified(empty).collect() == []


def vectors(spark, path, rows):
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.IntegerType())]
    )
    spark.createDataFrame([(i, v, 1) for i, v in rows], schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def brute_force(rows, k, step):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        scores = (x * x[i]).sum(1)
        others = np.flatnonzero(ids != ids[i])
        order = others[np.lexsort((ids[others], -scores[others]))][:k]
        out[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def test_nearest_vectors_on_awkward_rows(spark, tmp_path):
    r = np.random.default_rng(0)
    good = [(i, (r.normal(size=8) * (1 + i % 5)).tolist()) for i in range(200)]
    good += [(1000 + i, [1.0] * 8) for i in range(60)]  # equal vectors, ties
    bad = [(5000, None), (5001, [0.0] * 8), (5002, [1.0, None] + [0.0] * 6), (5020, [float("nan")] * 8)]
    bad += [(5003, [float("inf")] * 8), (None, [1.0] * 8), (5004, [1.0] * 3), (5005, [])]
    got: dict = {}
    for row in ann.nearest(vectors(spark, tmp_path / "v", good + bad), k=7).orderBy("query_id", "rank").collect():
        assert row.rank == len(got.setdefault(row.query_id, [])) + 1
        got[row.query_id].append((row.vec_id, row.score))
    # One list holds them all, so the result is exact.
    want = brute_force(good, 7, 20)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-13)


def test_nearest_vectors_recall_over_many_lists(spark, tmp_path):
    r = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(3000, 16)))]
    found: dict = {}
    for row in ann.nearest(vectors(spark, tmp_path / "v", rows), k=10, list_size=64).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    want = brute_force(rows, 10, 20)
    assert np.mean([len(found[q] & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_repeated_rows_take_no_neighbour_away(spark, tmp_path):
    """Rows that repeat an id and its vector count once."""
    rows = [(1, [1.0, 2.0])] * 30 + [(i, [1.0, 2.0]) for i in [*range(2, 26), 40]]
    got = sorted((x.query_id, x.rank, x.vec_id) for x in ann.nearest(vectors(spark, tmp_path / "v", rows)).collect())
    want = [(q, r + 1, v) for q in (20, 40) for r, v in enumerate([i for i in range(1, 26) if i != q][:20])]
    assert got == want


def test_nearest_vectors_of_few_or_no_rows(spark, tmp_path):
    few = ann.nearest(vectors(spark, tmp_path / "few", [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (40, [0.5, 0.5])])).collect()
    assert sorted((x.query_id, x.rank, x.vec_id) for x in few) == [(0, 1, 1), (0, 2, 40), (40, 1, 0), (40, 2, 1)]
    assert ann.nearest(vectors(spark, tmp_path / "one", [(0, [1.0, 2.0])])).collect() == []
    assert ann.nearest(vectors(spark, tmp_path / "none", [])).collect() == []


def test_replicas_and_graph_search():
    r = np.random.default_rng(3)
    points = r.normal(size=(4000, 6))
    means = ann.halve(points, 60)
    assert means.shape == (60, 6)
    c = ann.Centroids(means)
    far = ((points[:200, None] - c.points[None]) ** 2).sum(2)
    within, _ = c.near(points[:200], 1.2)
    true = far <= far.min(1)[:, None] * 1.44
    assert (within & true).sum() / true.sum() > 0.97 and not (within & (far > far.min(1)[:, None] * 1.45 + 1e-3)).any()
    lists = ann.replicas(c, points[:200], 1.3, 4)
    assert all(1 <= len(x) <= 4 for x in lists) and max(map(len, lists)) > 1
    equal = ann.halve(np.ones((50, 3)), 8)
    assert np.allclose(equal, 1)
