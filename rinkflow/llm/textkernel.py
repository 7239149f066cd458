"""Vectorised word and shingle hashing over Arrow string buffers.

Every operator on words reads the UTF-8 bytes of a batch in place: no Python
string is made for a word.  A word's 64-bit hash is a polynomial over random
byte values, taken from a running sum, and then mixed; a shingle's hash mixes
the hashes of its words in order.  Work goes in chunks of a quarter megabyte cut
between words, so memory beside the result is bounded however long a text is.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_MULT = 0x9E3779B97F4A7C15 | 1
_ROLL = 0xD6E8FEB86659FD93


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker does."""
    return sys.__dict__.setdefault("_rinkflow_llm_cache", {})


def trim() -> None:
    """Give memory that isn't used any more back to the system: workers live on, and what they keep adds up."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches that trims its worker's memory when it ends."""
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return trimmed


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = process_cache()
    if "powers" not in cache or len(cache["powers"][0]) < n:
        size = max(n, CHUNK + 4096)
        inverse = pow(_MULT, -1, 1 << 64)
        out = []
        for base in (_MULT, inverse):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        cache["powers"] = tuple(out)
    return cache["powers"]


def mix64(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on a new array."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def lower_ascii() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut


def byte_values() -> np.ndarray:
    """A fixed random value for each byte, equal for A-Z and a-z."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
    return values[lower_ascii()]


def space_words() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    lut = np.ones(256, bool)
    lut[[9, 10, 11, 12, 13, 32]] = False
    return lut


def letter_words() -> np.ndarray:
    """Bytes of words of ASCII letters and characters beyond ASCII."""
    lut = np.zeros(256, bool)
    lut[65:91] = lut[97:123] = lut[128:] = True
    return lut


def alnum_words() -> np.ndarray:
    """Bytes of words of ASCII letters, digits and characters beyond ASCII."""
    lut = letter_words()
    lut[48:58] = True
    return lut


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, from 0) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch of texts: byte range and hash of each, and each text's first word."""

    __slots__ = ("starts", "ends", "hashes", "ptr")

    def __init__(self, starts, ends, hashes, ptr):
        self.starts, self.ends, self.hashes, self.ptr = starts, ends, hashes, ptr


def words_of(data: np.ndarray, offsets: np.ndarray, cls: np.ndarray, hashed: bool = True) -> Words:
    """All words of the texts that ``offsets`` cuts out of ``data``."""
    total = len(data)
    values = byte_values()
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    cuts = offsets[:-1]
    while at < total:
        end = min(total, at + CHUNK)
        if end < total and cls[data[end - 1]] and cls[data[end]]:
            # the cut goes to the end of the word that lies over it, or to the next text
            while end < total and cls[data[end]]:
                step = cls[data[end : end + 65536]]
                stop = int(np.argmin(step)) if not step.all() else len(step)
                end += stop
                if stop < len(step):
                    break
        b = data[at:end]
        is_word = cls[b]
        first = np.searchsorted(cuts, at, "left")
        last = np.searchsorted(cuts, end, "left")
        heads = cuts[first:last] - at
        before = np.empty_like(is_word)
        before[1:] = is_word[:-1]
        before[0] = False
        before[heads] = False
        starts = np.flatnonzero(is_word & ~before)
        after = np.empty_like(is_word)
        after[:-1] = is_word[1:]
        after[-1] = False
        inner = heads[heads > 0]
        after[inner - 1] = False
        ends = np.flatnonzero(is_word & ~after) + 1
        if hashed:
            power, inverse = _powers(len(b) + 1)
            run = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(values[b] * power[: len(b)], dtype=np.uint64, out=run[1:])
            h = mix64((run[ends] - run[starts]) * inverse[starts])
        else:
            h = np.zeros(0, np.uint64)
        parts.append((starts + at, ends + at, h))
        at = end
    if parts:
        starts, ends, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        starts = ends = np.zeros(0, np.int64)
        hashes = np.zeros(0, np.uint64)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets, "left"))


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order, and each text's first one.

    A text of fewer than k words has one shingle, the whole sequence; one
    without words has none.
    """
    h, ptr = words.hashes, words.ptr
    n = np.diff(ptr)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_ptr = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    first = ptr[:-1][doc] + (np.arange(out_ptr[-1]) - out_ptr[:-1][doc])
    stop = ptr[1:][doc]
    short = (n < k)[doc]
    acc = np.zeros(len(first), np.uint64)
    roll = np.uint64(_ROLL)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    any_short = bool(short.any())
    for j in range(k):
        acc *= roll
        part = padded[first + j]
        if any_short:
            part = np.where(first + j < stop, part, np.uint64(0))
        acc += part
        acc ^= acc >> np.uint64(29)
    if any_short:
        acc = np.where(short, acc + n[doc].astype(np.uint64), acc)
    return mix64(acc), out_ptr


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting takes a small part of the time of numpy's hash table."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def unique_by_text(values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and each text's first one."""
    values = values.copy()
    for i, j in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
        values[i:j].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    heads = ptr[:-1][np.diff(ptr) > 0]
    keep[heads] = True
    run = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], run[ptr]


def slices(batch: pa.RecordBatch, column: str, most: int = 2 * CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``most`` bytes of text; a longer text comes alone."""
    index = batch.schema.get_field_index(column)
    _, offsets = string_buffers(batch.column(index))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield batch.slice(i, j - i)
        i = j


def gather_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, edges: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the given words one after another (between ``<`` and ``>`` with ``edges``), and their offsets."""
    extra = 2 if edges else 0
    size = ends - starts + extra
    ptr = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(starts)), size)
    at = np.arange(ptr[-1]) - ptr[:-1][word] - extra // 2
    out = data[np.clip(starts[word] + at, 0, max(0, len(data) - 1))] if len(data) else np.zeros(0, np.uint8)
    if edges:
        out = out.copy()
        out[ptr[:-1]] = 0x3C
        out[ptr[1:] - 1] = 0x3E
    return out, ptr


def char_ngrams(data: np.ndarray, ptr: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of all n-grams of characters inside the words that ``ptr`` cuts out of ``data``.

    Characters are those of UTF-8; A-Z count as a-z.
    """
    power, inverse = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * power[: len(data)], dtype=np.uint64, out=run[1:])
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    word = np.searchsorted(ptr, chars, "right") - 1
    stops = np.append(chars, len(data))
    last = len(chars) - n
    if last < 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.arange(last + 1)
    inside = stops[first + n] <= ptr[1:][word[first]]
    first = first[inside]
    a, b = chars[first], stops[first + n]
    return word[first], mix64((run[b] - run[a]) * inverse[a] + np.uint64(n))


def lookup(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted table, or -1."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1)
