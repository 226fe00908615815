"""Token ids of Arrow string batches with the `tokenizers` library.

Encoding is the cost of every token operator. The vocabulary used here never
merges across white space and ignores case (`_shared_form`), so a text is cut at white space, the distinct pieces
of a batch are found by Arrow's dictionary encoding, and the library encodes
only pieces that the worker has not seen yet. The result equals encoding the
whole text (tests compare both). Texts holding U+001C..U+001F, which Arrow
counts as white space and the tokenizer does not, go to the library whole.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_PIECES = 1_000_000   # pieces a worker remembers; it starts over beyond (memory only, no effect on results)
ENCODE_BYTES = 8 << 20     # the same for the encoder, where larger slices share more pieces
SLICE_BYTES = 2 << 20      # text encoded at a time


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _shared_form(texts: pa.StringArray) -> pa.StringArray:
    """Texts with the same ids and fewer distinct pieces: A-Z in lower case, as
    the vocabulary's normaliser makes them, and a space between a letter and the
    punctuation after it, where its pre-tokenizer cuts anyway. Texts with
    combining marks, which compose with letters of one case only, or with the
    start of a special token, which is matched by case, keep their case."""
    kept = pc.match_substring_regex(texts, "[\\x{300}-\\x{36f}]|<[|]")
    texts = pc.if_else(kept, texts, pc.ascii_lower(texts)) if pc.any(kept).as_py() else pc.ascii_lower(texts)
    return pc.replace_substring_regex(texts, "([a-z])([.,;:!?])", "\\1 \\2")


class Encoder:
    """Encodes white-space separated pieces and remembers them: piece -> row of
    a growing flat id array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "0"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.most = CACHE_PIECES
        self.reset()

    def reset(self) -> None:
        self.rows: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _add(self, pieces: list[str]) -> None:
        first = len(self.rows)
        ids = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        total, n = int(sizes.sum()), first + len(ids)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        ends = np.cumsum(sizes)
        self.flat[self.used:self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self.starts[first:n] = self.used + ends - sizes
        self.sizes[first:n] = sizes
        self.used += total
        self.rows.update(zip(pieces, range(first, n)))

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another as uint32, offsets of each text)."""
        if len(self.rows) > self.most:
            self.reset()
        odd = np.flatnonzero(pc.match_substring_regex(texts, "[\\x1c-\\x1f]").to_numpy(zero_copy_only=False))
        whole = {int(i): self._whole(texts[int(i)].as_py()) for i in odd}
        if whole:
            keep = np.ones(len(texts), bool)
            keep[odd] = False
            texts = pc.if_else(pa.array(keep), texts, "")
        split = pc.utf8_split_whitespace(_shared_form(texts))
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.rows]
        if new:
            self._add(new)
        row_of = np.fromiter(map(self.rows.__getitem__, pieces), np.int64, len(pieces))
        rows = row_of[coded.indices.to_numpy()] if len(pieces) else np.zeros(0, np.int64)
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[rows] - (ends - sizes), sizes) + np.arange(total)]
        offsets = np.concatenate([[0], ends])[bounds - bounds[0]]
        if whole:
            parts = [whole.get(i, ids[offsets[i]:offsets[i + 1]]) for i in range(len(texts))]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            ids = np.concatenate(parts) if parts else ids
        if self.most < CACHE_PIECES:
            pa.default_memory_pool().release_unused()      # asked to be lean
        return ids, offsets


def encoder(path: str, most: int = CACHE_PIECES) -> Encoder:
    """The worker's encoder, remembering `most` pieces, kept between tasks in a module of its own."""
    home = sys.modules.setdefault("_spanlake_encoders", types.ModuleType("_spanlake_encoders"))
    known = home.__dict__.setdefault("known", {})
    if path not in known:
        known[path] = Encoder(path)
    known[path].most = most
    return known[path]


def text_slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES):
    """Slices of a batch whose texts hold about `most` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def append_id(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same stream with `end_id` after each text."""
    n = len(offsets) - 1
    to = offsets + np.arange(n + 1)
    out = np.full(to[-1], end_id, ids.dtype)
    body = np.ones(len(out), bool)
    body[to[1:] - 1] = False
    out[body] = ids
    return out, to
