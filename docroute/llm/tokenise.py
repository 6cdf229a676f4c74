"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

Texts are cut into pieces across which no token reaches (``text.pieces``); each
distinct piece is encoded once by the library and its ids are looked up from
then on.  A worker keeps what it has learned between batches and tasks, up to a
bound, until it turns to other work on texts.

As by the library's default, a special token's text within a text is that token;
no piece ends within one.
"""

from __future__ import annotations

import itertools

import numpy as np

from docroute.llm.text import Texts, kept, pieces, ranges

#: Distinct pieces a worker remembers before it starts anew.
KEPT_PIECES = 1_500_000


def tokenizer_file(name: str) -> str:
    """Where an installed public vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.encode() for token in added]
        # A token that is found in other forms, or takes up what stands beside it, can
        # be anywhere: then texts are encoded as wholes.
        self.cuts = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, texts: Texts, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode the pieces that are not known; ``keys`` is sorted."""
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        fresh = np.flatnonzero(~known)
        if not len(fresh):
            return
        raw = texts.data[: texts.n_bytes].tobytes()
        strings = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int32, len(encoded))
        ids = np.fromiter(itertools.chain.from_iterable(encoded), np.int32, int(size.sum()))
        at = len(self.ids) + np.cumsum(size, dtype=np.int64) - size
        self.ids = np.concatenate([self.ids, ids])
        self.keys = np.insert(self.keys, place[fresh], keys[fresh])
        self.at = np.insert(self.at, place[fresh], at)
        self.size = np.insert(self.size, place[fresh], size)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of text i are ids[first[i]:first[i + 1]]."""
        if self.cuts:
            starts, ends, first = pieces(texts, self.added)
        else:
            starts, ends, first = texts.ptr[:-1], texts.ptr[1:], np.arange(len(texts) + 1)
        hashes = texts.hashes(starts, ends)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > KEPT_PIECES:
            self._forget()
        self._learn(texts, keys, starts[where], ends[where])
        slot = np.searchsorted(self.keys, keys)[back]
        size = self.size[slot].astype(np.int64)
        ids = self.ids[ranges(self.at[slot], size)]
        return ids, np.concatenate([[0], np.cumsum(size)])[first]

    def encode_ended(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after the ids of every text."""
        ids, first = self.encode(texts)
        n = len(texts)
        out = np.insert(ids, first[1:], end_id)
        return out, first + np.arange(n + 1)


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return kept(path, lambda: PieceEncoder(path))
