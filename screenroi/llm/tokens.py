"""Token ids of whole texts with the tokenizers library, for Arrow tasks.

A byte-level BPE first cuts text into words by a fixed pattern and never merges across a cut. The
places below are such cuts in any text, so a text is the sequence of its pieces between them.
Each distinct piece of a batch goes to the library once and the ids are laid out with numpy; a
bounded cache keeps pieces between batches. The ids are those of
``Tokenizer.encode(text, add_special_tokens=False)``.

* before a blank;
* between an ASCII letter and ASCII punctuation or a line feed;
* between a single line feed behind visible ASCII and an ASCII letter.

Texts where a blank touches other white space, or that contain a special token's string, go to
the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A blank next to white space of any kind (by Python's, Rust's or Unicode's notion).
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
TOUCHING = f"{_WHITE} | {_WHITE}"
#: Bounds on what a worker keeps: pieces (a dict of 700,000 doubles), and bytes of text in them. Bytes laid out, and
#: pieces encoded, at a time.
CACHE_PIECES = 690_000
CACHE_BYTES = 48 << 20
CHUNK_BYTES = 6 << 20
ENCODE_PIECES = 8192

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_GRAPH = np.zeros(256, bool)
_GRAPH[33:127] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127), 10]] = True


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def slices(batch: pa.RecordBatch, text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` cut between rows into slices of about ``most_bytes`` of text, one row at least."""
    if not batch.num_rows:
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64))
    a = 0
    while a < batch.num_rows:
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield batch.slice(a, b - a)
        a = b


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, nulls as empty; no copy of the text if nothing is null."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


class Encoder:
    """Encodes with a cache; one per worker and tokenizer file."""

    _own: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def __init__(self, path: str):
        self.tok = load_tokenizer(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.kept_bytes = 0

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Where the ids of each piece are kept."""
        if len(self.known) + len(pieces) > CACHE_PIECES or self.kept_bytes > CACHE_BYTES:
            self._reset()
        known = self.known
        new = [p for p in pieces if p not in known]
        for a in range(0, len(new), ENCODE_PIECES):
            self._learn(new[a:a + ENCODE_PIECES])
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self, new: list[bytes]) -> None:
        found = [e.ids for e in self.tok.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        n = len(self.known)
        at = int(self.starts[n])
        need = at + int(sizes.sum())
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[:at], np.empty(max(need, 2 * len(self.ids)) - at, np.uint32)])
        self.ids[at:need] = np.array(list(chain.from_iterable(found)), np.uint32)
        if n + len(new) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(len(new) + 1, len(self.starts)), np.int64)])
        self.starts[n + 1:n + 1 + len(new)] = at + np.cumsum(sizes)
        self.known.update(zip(new, range(n, n + len(new)), strict=True))
        self.kept_bytes += sum(map(len, new))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts, nulls as empty: text k has ids[offsets[k]:offsets[k + 1]]."""
        data, ends = utf8_bytes(texts)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        letter, punct, feed = _LETTER[data], _PUNCT[data], data == 10
        cut[:-1] = data == 32
        cut[1:-1] |= letter[:-1] & punct[1:]
        cut[2:-1] |= _GRAPH[data][:-2] & feed[1:-1] & letter[2:]
        whole = np.asarray(pc.fill_null(pc.match_substring_regex(texts, TOUCHING), False))
        for special in self.added:  # the library looks for these before it cuts
            whole = whole | np.asarray(pc.fill_null(pc.match_substring(texts, special), False))
        for k in np.flatnonzero(whole):
            cut[ends[k]:ends[k + 1]] = False
        cut[ends] = True
        bounds = np.flatnonzero(cut)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        where = self._numbers(pieces.dictionary.to_pylist())[np.asarray(pieces.indices)]
        starts = self.starts[where]
        sizes = self.starts[where + 1] - starts
        done = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat((starts - done[:-1]).astype(np.int32), sizes)
        at += np.arange(len(at), dtype=np.int32)
        return self.ids[at], done[np.searchsorted(bounds, ends)]
