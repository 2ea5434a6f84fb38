"""Token ids of whole texts with a public tokenizer's vocabulary file.

``word_bpe_49k.json`` lower-cases, drops white space and splits words by a
pattern that never crosses white space, so the ids of a text are the ids of its
words in a row.  The words of some texts are dictionary-encoded by Arrow, and cut
into letters and the punctuation after them; only the distinct parts are looked at in
Python, and the ids are gathered for all words in one go.  Parts recur between
texts, so each worker keeps the ids of those it has seen (a bounded table: a full one
is put aside, and what is still in use comes back from it); new ones are encoded
by the library, many together.
``tests/llm`` holds this against encoding whole texts."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_table
from .flat import FlatWords, byte_classes, cuts, text_bytes

END_ID = 1
#: letters with composed forms only; then punctuation without an apostrophe: two pre-tokens that the pattern keeps apart
LETTERS = "^[a-zÀ-ÖØ-öø-ÿ]+$"
PUNCTUATION = "!#$%&()*+,-./:;<=>?@^_`{|}~"
MAX_CACHED = 500_000
#: Bytes of texts whose ids are laid out at a time; the memory of a worker follows it.
SLICE_BYTES = 4 << 20
#: Words of letters that the library gets as one text.
TOGETHER = 400
CHUNKS = byte_classes(b" \t\n\x0b\x0c\r")


class ChunkEncoder:
    """ids of texts; little-endian unsigned 32-bit bytes per part of a word are cached."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, new: list[str]) -> None:
        for w, e in zip(new, self.tok.encode_batch(new, add_special_tokens=False)):
            self.parts[w] = np.array(e.ids, dtype="<u4").tobytes()

    def _encode_letters(self, new: list[str]) -> None:
        """Words of letters are a pre-token each, so many go through the library as one text."""
        groups = [new[i:i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        for ws, e in zip(groups, self.tok.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            first = np.flatnonzero(np.diff(np.array(e.word_ids), prepend=-1))
            if len(first) != len(ws):
                self._encode(ws)
                continue
            raw, cut = np.array(e.ids, dtype="<u4").tobytes(), [*(4 * first).tolist(), 4 * len(e.ids)]
            self.parts.update((w, raw[x:y]) for w, x, y in zip(ws, cut, cut[1:]))

    def _look_up(self, words: list[str], letters: list[bool]) -> list[bytes]:
        if len(self.parts) > MAX_CACHED:
            self.parts, self.old = {}, self.parts
        got = list(map(self.parts.get, words))
        if None in got:
            new = [(w, x) for w, x, g in zip(words, letters, got) if g is None]
            again = [w for w, _ in new if w in self.old]
            self.parts.update((w, self.old[w]) for w in again)
            rest = [(w, x) for w, x in new if w not in self.old] if again else new
            self._encode_letters([w for w, x in rest if x])
            self._encode([w for w, x in rest if not x])
            got = list(map(self.parts.__getitem__, words))
        return got

    def word_ids(self, words: pa.Array) -> list[bytes]:
        """The ids of each of some distinct words."""
        stems = pc.utf8_rtrim(words, characters=PUNCTUATION)
        simple = pc.match_substring_regex(stems, pattern=LETTERS)
        first = pc.if_else(simple, stems, words)
        tail = pc.subtract(pc.binary_length(words), pc.binary_length(first)).to_numpy(zero_copy_only=False)
        coded = first.dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        letters = np.zeros(len(coded.dictionary), bool)
        letters[at] = simple.to_numpy(zero_copy_only=False)
        ids = self._look_up(coded.dictionary.to_pylist(), letters.tolist())
        out = [ids[i] for i in at.tolist()]
        ends = np.flatnonzero(tail)
        tails = [w[-n:] for w, n in zip(words.take(pa.array(ends)).to_pylist(), tail[ends].tolist())]
        kinds = sorted(set(tails))
        known = dict(zip(kinds, self._look_up(kinds, [False] * len(kinds))))
        for i, t in zip(ends.tolist(), tails):
            out[i] += known[t]
        return out

    def flat_ids(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text with its end id, and the texts' offsets."""
        f = FlatWords(texts, CHUNKS)
        got = self.word_ids(f.words)
        table = np.frombuffer(b"".join(got), "<u4")
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        start = np.cumsum(size) - size
        each = size[f.codes]
        doc_size = np.bincount(f.doc, weights=each, minlength=len(texts)).astype(np.int64) if len(each) else np.zeros(len(texts), np.int64)
        ends = int(end_id is not None)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(doc_size + ends, out=offsets[1:])
        before = np.cumsum(each) - each
        out = np.full(int(offsets[-1]), end_id or 0, np.uint32)
        place = np.arange(int(each.sum()))
        if len(place):
            from_table = np.repeat(start[f.codes] - before, each) + place
            out[place + np.repeat(f.doc * ends, each)] = table[from_table]
        return out, offsets

    def batches(self, texts: pa.Array, end_id: int | None = END_ID) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(first text, end, ids, offsets)`` of consecutive texts, about ``SLICE_BYTES`` at a time."""
        for lo, hi in cuts(text_bytes(texts), SLICE_BYTES):
            yield lo, hi, *self.flat_ids(texts.slice(lo, hi - lo), end_id)

    def ids(self, texts: list[str], end_id: int | None = END_ID) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit bytes, with the end id."""
        out: list[bytes] = []
        for _, _, ids, offsets in self.batches(pa.array(texts, pa.large_string()), end_id):
            out += [ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        return out


_ENCODERS: dict[str, ChunkEncoder] = worker_table(__name__)


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))
