"""Fast exact token ids for the word-level BPE of ``public_tokenizers``.

The vocabulary lower-cases, drops white space and merges inside one pre-token
only, so the ids of a text are the ids of its white-space separated chunks, in
order.  ``WordEncoder`` cuts a whole Arrow column into chunks on its UTF-8
buffer, encodes every distinct chunk once with the tokenizers library and
gathers the result with numpy.  Distinct chunks are remembered in two bounded
generations per worker process; nothing grows with the input.

Cuts are made only where the library must cut as well: at a space or newline,
and between a Latin letter and a following full stop or comma.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 1
#: Distinct chunks kept in each of the two generations of the cache.
CACHE_ENTRIES = 200_000
#: UTF-8 bytes handled at once.
SLICE_BYTES = 8_000_000

#: Lower-case letters of one pre-token that every normaliser step leaves as they are.
LETTERS = [chr(c) for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
PLAIN = re.compile(f" ?([{''.join(LETTERS)}]+)")

_ENCODERS: dict[str, "WordEncoder"] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> "WordEncoder":
    """The encoder of this process; Spark reuses its Python workers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (from 0) of a string column, nulls as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(at):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(first, end) row ranges of about ``limit`` bytes, one row at least."""
    _, at = _flat(texts)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end
        first = end


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        whole = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.byte_level = {ord(c): whole(c)[0][0] for c in LETTERS}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _missing(self, chunks: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of chunks not seen before."""
        out: list[bytes | None] = [None] * len(chunks)
        rest = []
        tokenize = self.tokenizer.model.tokenize
        for i, c in enumerate(chunks):
            word = c.decode("utf-8")
            if m := PLAIN.fullmatch(word):  # one pre-token, normalised already
                out[i] = array("I", [t.id for t in tokenize(m[1].translate(self.byte_level))]).tobytes()
            else:
                rest.append(i)
        found = self.tokenizer.encode_batch_fast([chunks[i].decode("utf-8") for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found):
            out[i] = array("I", e.ids).tobytes()
        return out

    def _lookup(self, chunks: list[bytes]) -> list[bytes]:
        young, old = self.young, self.old
        if len(young) > CACHE_ENTRIES:
            self.old = old = young
            self.young = young = {}
        got = [young.get(c) for c in chunks]
        absent = [i for i, v in enumerate(got) if v is None]
        fresh = []
        for i in absent:
            v = old.get(chunks[i])
            if v is None:
                fresh.append(i)
            else:
                young[chunks[i]] = got[i] = v
        for i, v in zip(fresh, self._missing([chunks[i] for i in fresh])):
            young[chunks[i]] = got[i] = v
        return got

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end and the offset of each text in them."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        parts, counts = [], []
        for first, end in slices(texts):
            ids, at = self._encode(texts.slice(first, end - first))
            parts.append(ids)
            counts.append(np.diff(at))
        ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return ids, np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64) if counts else np.zeros(1, np.int64)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, at = _flat(texts)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(at), np.int64)
        raw = raw.copy()
        raw[raw == 10] = 32
        special = b"<|" in memoryview(raw).tobytes() if (raw == 60).any() else False
        letter = ((raw | 32) >= 97) & ((raw | 32) <= 122)
        if not special:  # the library lower-cases; its special tokens are told apart by case
            raw[letter & (raw < 97)] |= 32
        if len(raw) > 1:
            letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        cut = raw == 32
        cut[1:] |= ((raw[1:] == 46) | (raw[1:] == 44)) & letter[:-1]
        cut[at[:-1][at[:-1] < len(raw)]] = True
        edges = np.append(np.flatnonzero(cut), len(raw))
        del cut, letter
        chunks = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)]).dictionary_encode()
        found = self._lookup(chunks.dictionary.to_pylist())
        codes = chunks.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        pool_at = np.concatenate([[0], np.cumsum(sizes)])
        n = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        index = np.repeat((pool_at[:-1][codes] - ends[:-1]).astype(np.int32), n)
        index += np.arange(ends[-1], dtype=np.int32)
        return pool[index], ends[np.searchsorted(edges, at)]
