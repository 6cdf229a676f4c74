import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docroute.llm.text import Texts, Words, pieces, starts_of_runs, windows
from docroute.llm.tokenise import PieceEncoder
from tests.llm.helpers import words_of

ALPHABET = list("ab é 　  \n\t'sZ1!日")


def some_texts(n=400, seed=0):
    r = random.Random(seed)
    return [None if r.random() < 0.05 else "".join(r.choice(ALPHABET) for _ in range(r.randrange(40))) for _ in range(n)] + ["", " ", None]


def test_words_and_windows():
    texts = some_texts()
    t = Texts(pa.array(texts))
    w = Words(t)
    want = [words_of(x) for x in texts]
    spans = list(zip(w.starts.tolist(), w.ends.tolist()))
    assert [[t.bytes_of(*s).decode() for s in spans[a:b]] for a, b in zip(w.first, w.first[1:])] == want
    flat = [x for one in want for x in one]
    hashes = w.hashes()
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    for size in (3, 12):
        runs = [tuple(flat[i : i + size]) for i in range(len(flat) - size + 1)]
        found = windows(hashes, size).tolist()
        assert len(set(zip(runs, found))) == len(set(runs)) == len(set(found))
        inside = [k + size <= len(one) for one in want for k in range(len(one))]
        assert starts_of_runs(w.first, size).tolist() == inside[: len(runs)]


def test_slice_of_an_array_and_no_texts():
    w = Words(Texts(pa.array(["a b", "c", "d e f"]).slice(1)))
    assert w.counts().tolist() == [1, 3]
    assert len(Words(Texts(pa.array([], pa.string()))).starts) == 0
    assert len(windows(np.zeros(0, np.uint64), 5)) == 0


def test_lower_case_is_ascii_only():
    t = Texts(pa.array(["ÀZ É"]), lower=True)
    assert t.data[: t.n_bytes].tobytes().decode() == "Àz É"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_whole_texts(name):
    special = ["<|endoftext|>", "<|startoftext|>"]
    texts = [x or "" for x in some_texts(1500, 3)] + [*special, "<|endoftext|", "<|endoftext|> x", "a  b", "ΟΔΟΣ ΟΔΟΣ"]
    r = random.Random(4)
    parts = [*special, "a", "Zé", " ", "  ", "\n", "\t ", "<", "|>", "<|", "endoftext", "'ll", "12", "　", "日", ".", "!?"]
    texts += ["".join(r.choice(parts) for _ in range(r.randrange(1, 12))) for _ in range(3000)]
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    ids, first = PieceEncoder(path).encode(Texts(pa.array(texts)))
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
    starts, ends, at = pieces(Texts(pa.array(texts)))
    assert at[-1] == len(starts) == len(ends)
