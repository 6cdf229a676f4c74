import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from docroute.llm import bpe_chunks, packing, token_counts, wavelet
from tests.llm.helpers import awkward_rows, rows_of, words_of, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def library_ids(name, text, end=True):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return t.encode(text or "", add_special_tokens=False).ids + [0] * end


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_stitching_chunks_gives_the_tokens_of_the_whole():
    enc, pattern, r = tik(), regex.compile(public_tokenizers.PATTERN), random.Random(2)
    parts = ["a", "b", "é", " ", "  ", "\n", "\t", "'ll", "'", "s", "S", "1", "22", "!", "?!", "　", "x" * 30, " the", "日"]
    cut = 0
    for _ in range(1500):
        some = r.sample(parts, r.randrange(1, len(parts)))
        text = "".join(r.choice(some) for _ in range(r.randrange(200)))
        chunk, overlap = r.choice([(16, 6), (32, 8), (50, 20), (12, 11)])
        starts = bpe_chunks.chunk_starts(len(text), chunk, overlap)
        ends = [bpe_chunks.boundaries(text[s : s + chunk], pattern) for s in starts]
        cuts = bpe_chunks.stitch(text, starts, ends, pattern, chunk)
        cut += len(cuts) > 1
        assert [i for a, b in zip(cuts, [*cuts[1:], len(text)]) for i in enc.encode_ordinary(text[a:b])] == enc.encode_ordinary(text)
    assert cut > 500


@pytest.mark.parametrize("chunk,overlap", [(bpe_chunks.CHUNK, bpe_chunks.OVERLAP), (64, 16)])
def test_byte_bpe(spark, tmp_path, chunk, overlap):
    rows, enc = awkward_rows(), tik()
    docs = written(spark, tmp_path / "docs", rows)
    want = []
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    got = bpe_chunks.encode_digests(docs, RANKS, public_tokenizers.PATTERN, chunk, overlap)
    assert rows_of(got) == sorted(want, key=repr)


def test_byte_bpe_round_trip_and_empty_table(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows())
    got = bpe_chunks.encode_decode(docs, RANKS, public_tokenizers.PATTERN, 64, 16).collect()
    assert sorted((bytes(r.decoded) for r in got)) == sorted((t or "").encode() for _, t in awkward_rows())
    empty = written(spark, tmp_path / "empty", [])
    assert bpe_chunks.encode_digests(empty, RANKS, public_tokenizers.PATTERN).collect() == []


def test_wavelet_matrix_answers(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 4096)
    r = np.random.default_rng(0)
    for n, most in ((0, 1), (1, 1), (5, 70_000), (20_000, 50_257), (9000, 3)):
        ids = r.integers(0, most, n).astype(np.uint32)
        names, lengths = ([None], [n]) if n < 3 else ([None, 5, 7], [1, n - 2, 1])
        shard = wavelet.Shard(wavelet.encode_shard(ids, names, np.array(lengths)))
        assert shard.ids().tolist() == ids.tolist()
        assert shard.documents()[0] == names and shard.documents()[1].tolist() == lengths
        for i in r.integers(0, max(n, 1), 40 if n else 0).tolist():
            token, (lo, hi) = int(ids[i]), sorted(r.integers(0, n + 1, 2).tolist())
            places = np.flatnonzero(ids == token)
            k = int(r.integers(0, len(places)))
            assert shard.access(i) == token
            assert shard.count(token, lo, hi) == int((ids[lo:hi] == token).sum())
            assert shard.occurrence(token, k) == places[k]
        assert shard.count(1 << 20) == 0
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.occurrence(2, n)


def test_token_files(spark, tmp_path, monkeypatch):
    rows = awkward_rows()
    docs = written(spark, tmp_path / "docs", rows)
    name = "byte_bpe_50k.json"
    folder = str(tmp_path / "files")
    manifest = wavelet.write_shards(docs, folder, public_tokenizers.path(name), shard_ids=500)
    assert manifest.count() > 3
    got = wavelet.read_documents(manifest, folder, keep_ids=True).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for row, (d, t) in zip(got, ordered, strict=True):
        ids = library_ids(name, t)
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (d, start, len(ids), crc(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)


def test_token_files_of_an_empty_table(spark, tmp_path):
    empty = written(spark, tmp_path / "empty", [])
    assert wavelet.token_files(empty, public_tokenizers.path("byte_bpe_50k.json")).collect() == []


@pytest.mark.parametrize("size", [2048, 50])
def test_packing(spark, tmp_path, size):
    rows, name = awkward_rows(), "word_bpe_49k.json"
    docs = written(spark, tmp_path / "docs", rows)
    want = []
    for d, t in rows:
        ids = library_ids(name, t)
        want += [(d, k // size, k, len(ids[k : k + size]), crc(ids[k : k + size])) for k in range(0, len(ids), size)]
    got = packing.pack_documents(docs, public_tokenizers.path(name), size).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    total = sum(w[3] for w in want)
    assert len(held) <= -(-total // size) + 2


def test_packed_sequences_hold_the_ids(spark, tmp_path):
    docs = written(spark, tmp_path / "docs", awkward_rows()[:9])
    got = packing.sequences(docs, public_tokenizers.path("word_bpe_49k.json"), 300).collect()
    ids = Counter(i for _, t in awkward_rows()[:9] for i in library_ids("word_bpe_49k.json", t))
    assert Counter(np.concatenate([np.frombuffer(r.ids, "<u4") for r in got]).tolist()) == ids
    assert all(r.length == len(r.ids) // 4 <= 300 for r in got)
    empty = written(spark, tmp_path / "empty", [])
    assert packing.pack_documents(empty, public_tokenizers.path("word_bpe_49k.json")).collect() == []


def test_plan_is_best_fit_and_complete():
    import bisect

    r = random.Random(0)
    for _ in range(60):
        size = r.choice([10, 64, 2048])
        lengths = [r.randint(1, size if r.random() < 0.5 else max(1, size // 8)) for _ in range(r.randrange(2000))]
        counts, bins, ranks = Counter(lengths), defaultdict(list), defaultdict(list)
        for length, first, number, sequence, offset in packing.plan(counts, size):
            for i in range(number):
                bins[sequence + i].append((offset, length))
                ranks[length].append(first + i)
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
        for places in bins.values():
            assert all(o == sum(n for p, n in places if p < o) for o, _ in places)
            assert sum(n for _, n in places) <= size
        rooms = []
        for length in sorted(lengths, reverse=True):
            i = bisect.bisect_left(rooms, length)
            room = rooms.pop(i) if i < len(rooms) else size
            bisect.insort(rooms, room - length)
        assert len(bins) <= len(rooms) + max(1, len(rooms) // 100)


def plain_count(word, pieces):
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        size = len(word[i - 1].encode())
        options = [(best[i - 1][0] + token_counts.BYTE_SCORE * size, best[i - 1][1] + size, 0)]
        options += [(best[j][0] + pieces[word[j:i]], best[j][1] + 1, i - j) for j in range(i) if word[j:i] in pieces]
        best.append(max(options, key=lambda x: (x[0], x[2]))[:2])
    return best[-1][1]


def test_token_counts(spark, tmp_path):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = token_counts.load_pieces(path)
    rows = [r for r in awkward_rows() if r[0] != 15] + [(15, "xyz" * 60)]
    docs = written(spark, tmp_path / "docs", rows)
    want = []
    for d, t in rows:
        words = words_of(t)
        want.append((d, len(words), sum(plain_count(token_counts.MARK + w, pieces) for w in words)))
    assert rows_of(token_counts.token_counts(docs, path)) == sorted(want, key=repr)
    assert token_counts.token_counts(written(spark, tmp_path / "empty", []), path).collect() == []


def test_shared_prefixes_are_scored_once():
    pieces = {"a": -1.0, "b": -1.0, "ab": -1.5, "aba": -4.0, "c": -1.0}
    looked = []

    class Watched(dict):
        def get(self, key, default=None):
            looked.append(key)
            return super().get(key, default)

    vocabulary = token_counts.Vocabulary(pieces)
    vocabulary.pieces = Watched(pieces)
    words = sorted(["", "ab", "aba", "abab", "ababc", "abc", "ac", "zé"])
    assert vocabulary.counts(words) == [plain_count(w, pieces) for w in words]
    nodes = {w[:i] for w in words for i in range(1, len(w) + 1)}
    assert len(looked) <= sum(min(len(n), 3) for n in nodes)
