"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by the size of their shingle sets.  A long document
is searched by windows of a size that fits the partition: two neighbouring
blocks of ``2 ** level`` shingles, so any run as long as an item of that level
lies within one window and makes up a good part of it.  A window that shares a
minimum with an item makes its document a candidate, and the exact containment
of the item's shingles in the whole document's set decides.  Items of few
shingles are too small a part of the smallest window; their shingles are looked
up one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from ._util import texts

WORDS = 5
#: An item of n shingles of which 0.8 lie in a window of at most 4 n has no common minimum with a chance below 3e-6.
MINIMA = 64
#: The smallest blocks have ``2 ** LEAST`` shingles.
LEAST = 4
#: Items of fewer shingles than a quarter of the smallest window, which the chance above doesn't hold for, are looked up.
FEW = (2 << LEAST) // 4
#: Bytes of item texts that are broadcast at once; more items take further passes over the documents.
ITEM_BYTES = 8 << 20
EMPTY = np.uint32(0xFFFFFFFF)


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tk.string_buffers(column)
    return tk.shingle_hashes(tk.words_of(data, offsets, tk.alnum_words()), WORDS)


def _keys() -> tuple[np.ndarray, np.ndarray]:
    keys = tk.mix64(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return (keys[:MINIMA] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (keys[MINIMA:] >> np.uint64(32)).astype(np.uint32)


def _minima(values: np.ndarray, heads: np.ndarray, j: int, keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.minimum.reduceat((values ^ keys[1][j]) * keys[0][j], heads)


def index_items(ids: list[int], column: pa.Array) -> dict:
    """Shingle sets of items, and by level and minimum a sorted table of values with their items."""
    values, ptr = tk.unique_by_text(*_hashes(column))
    size = np.diff(ptr)
    level = np.maximum(LEAST, np.ceil(np.log2(np.maximum(1, size))).astype(int))
    keys, levels = _keys(), {}
    v32 = (values >> np.uint64(32)).astype(np.uint32)
    few = np.flatnonzero((size > 0) & (size < FEW))
    for at in np.unique(level[size >= FEW]):
        own = np.flatnonzero((level == at) & (size >= FEW))
        flat = np.concatenate([v32[ptr[i] : ptr[i + 1]] for i in own])
        heads = np.concatenate([[0], np.cumsum(size[own])[:-1]])
        tables = []
        for j in range(MINIMA):
            m = _minima(flat, heads, j, keys)
            order = np.argsort(m, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[m >> np.uint32(16)] = True
            tables.append((m[order], own[order], seen))
        levels[int(at)] = tables
    single = np.concatenate([values[ptr[i] : ptr[i + 1]] for i in few]) if len(few) else values[:0]
    order = np.argsort(single, kind="stable")
    return {"ids": np.array(ids, np.int64), "values": values, "ptr": ptr, "levels": levels, "single": single[order], "owner": np.repeat(few, size[few])[order]}


def _windows(mins: np.ndarray, block_doc: np.ndarray) -> np.ndarray:
    """Minima of each block with the next one of its document, or alone at the document's end."""
    out = mins.copy()
    same = block_doc[1:] == block_doc[:-1]
    out[:-1][same] = np.minimum(mins[:-1][same], mins[1:][same])
    return out


def _search(items: dict, threshold: float):
    def candidates(sh: np.ndarray, ptr: np.ndarray, index: dict) -> set[tuple[int, int]]:
        """(document, item) pairs with a common minimum in some window, or a common shingle for items of few."""
        n = np.diff(ptr)
        blocks = -(-n // (1 << LEAST))
        doc = np.repeat(np.arange(len(n)), blocks)
        first = np.concatenate([[0], np.cumsum(blocks)])[:-1]
        heads = ptr[:-1][doc] + (np.arange(len(doc)) - first[doc]) * (1 << LEAST)
        v32, keys = (sh >> np.uint64(32)).astype(np.uint32), _keys()
        found: set[tuple[int, int]] = set()
        if len(index["single"]):
            hit = np.flatnonzero(tk.lookup(index["single"], sh) >= 0)
            text = np.repeat(np.arange(len(n)), n)[hit]
            lo, hi = np.searchsorted(index["single"], sh[hit], "left"), np.searchsorted(index["single"], sh[hit], "right")
            for x in range(len(hit)):
                found.update((int(text[x]), int(i)) for i in index["owner"][lo[x] : hi[x]])
        if not index["levels"]:
            return found
        top = max(index["levels"])
        for j in range(MINIMA):
            mins, owner = _minima(v32, heads, j, keys), doc
            for level in range(LEAST, top + 1):
                if level > LEAST:  # two blocks of the level below make one
                    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
                    even = np.flatnonzero(rank % 2 == 0)
                    mins, owner = np.minimum.reduceat(mins, even), owner[even]
                if level in index["levels"]:
                    values, own, seen = index["levels"][level][j]
                    w = _windows(mins, owner)
                    hit = np.flatnonzero(seen[w >> np.uint32(16)])
                    lo, hi = np.searchsorted(values, w[hit], "left"), np.searchsorted(values, w[hit], "right")
                    for x in np.flatnonzero(hi > lo):
                        found.update((int(owner[hit[x]]), int(i)) for i in own[lo[x] : hi[x]])
        return found

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = items.value
        for batch in batches:
            for part in tk.slices(batch, "text"):
                sh, ptr = _hashes(part.column(1))
                if not len(sh) or not len(index["values"]):
                    continue
                ids, rows = part.column(0).to_pylist(), []
                sets: dict[int, np.ndarray] = {}
                for d, i in sorted(candidates(sh, ptr, index)):
                    if d not in sets:
                        sets[d] = np.unique(sh[ptr[d] : ptr[d + 1]])
                    own = index["values"][index["ptr"][i] : index["ptr"][i + 1]]
                    shared = int((tk.lookup(sets[d], own) >= 0).sum())
                    if shared >= threshold * len(own):
                        rows.append((ids[d], int(index["ids"][i]), len(own), shared, shared / len(own)))
                if rows:
                    kinds = [pa.int64()] * 4 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

    return search


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """Items in runs of at most ``ITEM_BYTES`` of text, a longer item alone; one run is held at a time."""
    ids, held, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    for r in rows.toLocalIterator():
        n = len(r.text.encode())
        if held and size + n > ITEM_BYTES:
            yield ids, held
            ids, held, size = [], [], 0
        ids.append(r.item_id)
        held.append(r.text)
        size += n
    if held:
        yield ids, held


def contained(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every item found in a document.

    An item of ``benchmark(item_id, text, ...)`` is found in a document of
    ``docs(doc_id, text, ...)`` if at least ``threshold`` of its distinct
    five-word shingles are in the document's set; an item of one to four words
    is one shingle and matches a text of just those words.  Words are runs of
    ASCII letters, digits and characters beyond ASCII, so punctuation and line
    breaks don't hide an item; A-Z count as a-z.  Items that are null
    or hold no word match nothing, nor do such texts.  Repeated items and rows
    match as often as they occur, and a null doc_id is kept.  Empty tables give
    an empty result.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    out = None
    for ids, held in _item_blocks(benchmark):
        index = spark.sparkContext.broadcast(index_items(ids, pa.array(held, pa.large_string())))
        found = texts(docs).mapInArrow(tk.lean(_search(index, threshold)), schema)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], schema)
