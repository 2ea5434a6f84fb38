"""Words of a column of texts as flat arrays, without a Python object per word.

The bytes of the texts lie one after another in an Arrow buffer.  A table gives
each byte its class (word, space, or end of a piece), so word starts and ends
come from comparing neighbours, and the words themselves are dictionary-encoded
by Arrow.  All separators are ASCII, so the rules hold on UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE, PIECE_END = 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def byte_classes(space: bytes, piece_end: bytes = b"") -> np.ndarray:
    """A table of byte classes: 0 for bytes of words."""
    t = np.zeros(256, np.uint8)
    t[list(space)] = SPACE
    t[list(piece_end)] = PIECE_END
    return t


class FlatWords:
    """Words of some texts in order: ``codes`` into ``words`` (a string array of the
    distinct ones), ``doc`` (index of the text) and ``piece`` (never falls, differs
    between texts and across ends of pieces).  ``lengths`` are the words' bytes, ``raw``
    the bytes of all texts."""

    def __init__(self, texts: pa.Array, classes: np.ndarray, lower: bool = True):
        if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
            offsets = np.frombuffer(texts.buffers()[1], np.int64)
        else:
            offsets = np.frombuffer(texts.buffers()[1], np.int32)
        offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        kind = classes[raw]
        word = kind == 0
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        cut = offsets[(offsets > 0) & (offsets < len(raw))]  # words end with their text
        begin[cut] = word[cut]
        end[cut - 1] = word[cut - 1]
        at = np.flatnonzero(begin)
        length = np.flatnonzero(end) + 1 - at
        self.raw, self.lengths = raw, length
        body = raw[word]
        if lower:
            body = _LOWER[body]
        ends = np.zeros(len(at) + 1, np.int64)
        np.cumsum(length, out=ends[1:])
        coded = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(body)]).dictionary_encode()
        self.words = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
        self.doc = np.searchsorted(offsets, at, side="right").astype(np.int32) - 1
        if (classes == PIECE_END).any():
            self.piece = np.cumsum(kind == PIECE_END, dtype=np.int32)[at] + self.doc
        else:
            self.piece = self.doc


def text_bytes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; nulls count 0."""
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` bytes; one text at least, each whole."""
    total, lo = np.concatenate([[0], np.cumsum(sizes)]), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def pack(a: np.ndarray) -> bytes:
    """An array as compressed bytes (zstd, level 1)."""
    return a.nbytes.to_bytes(8, "little") + pa.Codec("zstd", 1).compress(a.tobytes(), asbytes=True)


def unpack(b: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(b[8:], n, asbytes=True), dtype) if n else np.empty(0, dtype)
