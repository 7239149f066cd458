"""Near-duplicate documents by b-bit MinHash.

One pass over the texts gives each document the digest of its shingle set, the
keys of its bands of minima, and a packed signature of ``BITS`` low bits of each
minimum.  Equal sets fold into one representative.  Representatives that share a
band key meet in that band's bucket with their signatures alone: bit counts,
corrected for chance collisions, estimate their similarity, and those in reach
of the threshold form a cluster.  Texts move only to clusters, where full sets
are compared, and only confirmed links count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from . import textkernel as tk
from ._util import group_bounds, own_shuffle, partitions, texts, whole_groups
from .graph import connected_components

#: At a similarity of 0.85 a pair shares no band with a probability of 7e-7.
BANDS, ROWS, BITS = 30, 6, 2
WORDS = 5
#: Estimates this far (in standard deviations of the estimator) under the threshold are not compared.
SLACK = 6.0
#: Shingles in a block of a cluster; larger clusters are compared by pairs of blocks, each in its own task.
BLOCK = 1 << 17
#: Signatures in a block of a band's bucket; larger buckets are compared by pairs of blocks too.
BUCKET = 1 << 12

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, packed binary"


def minima(values: np.ndarray, ptr: np.ndarray, count: int, seed: int = 1) -> np.ndarray:
    """``count`` minima (uint32) of each non-empty set; rows of empty sets hold the largest value."""
    n = np.diff(ptr)
    out = np.full((count, len(n)), 0xFFFFFFFF, np.uint32)
    full = n > 0
    if not full.any():
        return out
    v = (values >> np.uint64(32)).astype(np.uint32)
    heads = ptr[:-1][full]
    keys = tk.mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    mult, add = (keys[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (keys[count:] >> np.uint64(32)).astype(np.uint32)
    work = np.empty_like(v)
    for j in range(count):
        np.bitwise_xor(v, add[j], out=work)
        np.multiply(work, mult[j], out=work)
        out[j, full] = np.minimum.reduceat(work, heads)
    return out


def band_keys(mins: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) keys of 64 bits; the band's number is part of the key."""
    bands = mins.shape[0] // rows
    out = np.empty((mins.shape[1], bands), np.int64)
    for b in range(bands):
        acc = np.full(mins.shape[1], b + 1, np.uint64)
        for r in range(rows):
            acc = tk.mix64(acc * np.uint64(0x9E3779B97F4A7C15) + mins[b * rows + r])
        out[:, b] = acc.view(np.int64)
    return out


def packed_bits(mins: np.ndarray) -> np.ndarray:
    """(documents, words of uint64): ``BITS`` low bits of each mixed minimum."""
    m = mins ^ (mins >> np.uint32(16))
    m *= np.uint32(0x85EBCA6B)
    m ^= m >> np.uint32(13)
    low = (m & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    bits = np.stack([(low >> b) & 1 for b in range(BITS)], axis=1).reshape(-1, mins.shape[1])
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))


def estimate(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """Similarity estimated from packed signatures: equal minima, less those equal by chance."""
    x = np.bitwise_xor(a, b)
    differs = x
    for k in range(1, BITS):
        differs = differs | (x >> np.uint64(k))
    mask = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    unequal = np.bitwise_count(differs & mask).sum(axis=-1)
    chance = 2.0**-BITS
    return ((1 - unequal / count) - chance) / (1 - chance)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cls = tk.space_words()
    for batch in batches:
        for part in tk.slices(batch, "text"):
            data, offsets = tk.string_buffers(part.column(1))
            sh, ptr = tk.unique_by_text(*tk.shingle_hashes(tk.words_of(data, offsets, cls), WORDS))
            mins = minima(sh, ptr, BANDS * ROWS)
            keys = band_keys(mins, ROWS)
            digest = np.array([xxhash.xxh3_128_intdigest(sh[i:j].data) for i, j in zip(ptr[:-1], ptr[1:], strict=True)], object)
            d = np.array([[x >> 64, x & (2**64 - 1)] for x in digest], np.uint64).reshape(-1, 2).view(np.int64)
            n = np.diff(ptr)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))
            packed = pa.array([x.tobytes() for x in packed_bits(mins)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), lists, packed], ["doc_id", "n_shingles", "d1", "d2", "bands", "packed"])


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, digest of the set, band keys and packed signature of every document."""
    return texts(docs).mapInArrow(tk.lean(_sign), SIGNED)


def least_estimate(percent: int) -> float:
    """Estimate that a linked pair falls short of with next to no chance."""
    t = percent / 100
    p = t + (1 - t) * 2.0**-BITS
    return t - SLACK * np.sqrt(p * (1 - p) / (BANDS * ROWS)) / (1 - 2.0**-BITS)


def near_group(sig: np.ndarray, size: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Component label (an index) of each signature, joined where sizes and estimates allow a link between unlike sides (or any, if all are on one)."""
    label = np.arange(len(sig))
    floor, one_side = least_estimate(percent), bool((side == side[0]).all())
    for i in range(len(sig)):
        c = label != label[i]
        if not one_side:
            c &= side != side[i]
        c = np.flatnonzero(c & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        if len(c):
            c = c[estimate(sig[c], sig[i], BANDS * ROWS) >= floor]
        if len(c):
            joined = np.append(label[c], label[i])
            label[np.isin(label, joined)] = joined.min()
    return label


def _spanning(ids: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of all members of each label to its smallest id."""
    order = np.lexsort((ids, label))
    ids, label = ids[order], label[order]
    new = np.append(True, label[1:] != label[:-1])
    least = ids[np.flatnonzero(new)[np.cumsum(new) - 1]]
    own = ids != least
    return ids[own], least[own]


def _estimator(percent: int):
    keys = ["key", "bi", "bj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            bounds = group_bounds(t, keys)
            ids, size, block, bi = (t.column(k).to_numpy() for k in ("rep", "n_shingles", "block", "bi"))
            sig = np.frombuffer(b"".join(t.column("packed").to_pylist()), np.uint64).reshape(t.num_rows, -1)
            found = [(np.zeros(0, np.int64),) * 2]
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                if j - i > 1:
                    found.append(_spanning(ids[i:j], near_group(sig[i:j], size[i:j], (block[i:j] == bi[i:j]).astype(np.int8), percent)))
            src, dst = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])

    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows (group, blocks, rep, ...) for each pair of blocks (bi, bj) that theirs is one of."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}).drop("other", "blocks")


class _Postings:
    """Intersection sizes of one set of a group with all others, by an inverted index."""

    def __init__(self, sh: np.ndarray, ptr: np.ndarray):
        self.ptr, self.n = ptr, len(ptr) - 1
        _, self.token = np.unique(sh, return_inverse=True)
        owner = np.repeat(np.arange(self.n), np.diff(ptr))
        order = np.argsort(self.token, kind="stable")
        self.owner = owner[order]
        self.head = np.concatenate([[0], np.cumsum(np.bincount(self.token))])
        self.spread = np.diff(self.head)

    def shared(self, i: int) -> np.ndarray:
        t = self.token[self.ptr[i] : self.ptr[i + 1]]
        t = t[self.spread[t] > 1]
        if not len(t):
            return np.zeros(self.n, np.int64)
        return np.bincount(np.concatenate([self.owner[self.head[x] : self.head[x + 1]] for x in t]), minlength=self.n)

    def centre(self) -> np.ndarray:
        """Sets in order of how common their shingles are in the group."""
        total = np.add.reduceat(self.spread[self.token], self.ptr[:-1])
        return np.argsort(-total / np.diff(self.ptr), kind="stable")


def link_group(sh: np.ndarray, ptr: np.ndarray, sig: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Component label (an index) of each set of a group, joined by confirmed links.

    Every pair on unlike sides (or, where all are on one side, every pair) is
    compared unless links found before already join it or its estimate is out
    of reach.  Starting with the set nearest to the group's centre joins most
    of a group of copies at once.
    """
    n = len(ptr) - 1
    size = np.diff(ptr)
    label = np.arange(n)
    one_side = bool((side == side[0]).all())
    index = _Postings(sh, ptr) if n > 8 else None
    order = index.centre() if index else label.copy()
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    count, floor = BANDS * ROWS, least_estimate(percent)
    for i in order:
        near = (label != label[i]) & (rank > rank[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        if not one_side:
            near &= side != side[i]
        c = np.flatnonzero(near)
        if len(c):
            c = c[estimate(sig[c], sig[i], count) >= floor]
        if not len(c):
            continue
        if index and len(c) > 4:
            shared = index.shared(i)[c]
        else:
            own = sh[ptr[i] : ptr[i + 1]]
            shared = np.array([len(np.intersect1d(own, sh[ptr[j] : ptr[j + 1]], assume_unique=True)) for j in c])
        linked = c[100 * shared >= percent * (size[i] + size[c] - shared)]
        if len(linked):
            joined = np.unique(np.append(label[linked], label[i]))
            label[np.isin(label, joined)] = joined[0]
    return label


def _linker(percent: int):
    keys = ["cluster", "bi", "bj"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = tk.space_words()
        for t in whole_groups(batches, keys):
            data, offsets = tk.string_buffers(t.column("text"))
            bounds = group_bounds(t, keys)
            ids, block, bi = (t.column(k).to_numpy() for k in ("rep", "block", "bi"))
            src, dst = [], []
            at = 0
            while at < len(bounds) - 1:
                # texts are hashed some groups at a time, so memory follows the largest group
                to = max(at + 1, int(np.searchsorted(offsets[bounds], offsets[bounds[at]] + 4 * tk.CHUNK, "right")) - 1)
                to = min(to, len(bounds) - 1)
                lo, hi = bounds[at], bounds[to]
                part = data[offsets[lo] : offsets[hi]]
                sh, ptr = tk.unique_by_text(*tk.shingle_hashes(tk.words_of(part, offsets[lo : hi + 1] - offsets[lo], cls), WORDS))
                sig = np.ascontiguousarray(packed_bits(minima(sh, ptr, BANDS * ROWS))).view(np.uint64)
                for g in range(at, to):
                    i, j = bounds[g] - lo, bounds[g + 1] - lo
                    if j - i < 2:
                        continue
                    own = slice(lo + i, lo + j)
                    label = link_group(sh[ptr[i] : ptr[j]], ptr[i : j + 1] - ptr[i], sig[i:j], (block[own] == bi[own]).astype(np.int8), percent)
                    rest, least = _spanning(ids[own], label)
                    src.append(rest)
                    dst.append(least)
                at = to
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"])

    return link


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs(doc_id, text, ...)``.

    Documents link when ``100 * intersection >= percent * union`` of their sets
    of distinct five-word shingles; a text of one to four words is one shingle.
    ``component_id`` is the smallest doc_id reachable by links, and a document
    is kept if that is its own.  Texts that are null or hold no word link with
    nothing and are kept.  Repeated rows each get a row; unlike texts under one id
    count as one document that has the links of all of them.  Rows with a null id
    take part in no group: their component is null and they are kept.  Other
    columns are ignored.  An empty table gives an empty result.

    Bands are chosen for thresholds of 80 and more.
    """
    signed = cut(signatures(docs))
    some = signed.where("doc_id is not null and n_shingles > 0")
    reps = some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    rep_rows = some.join(own_shuffle(reps, "d1", "d2"), ["d1", "d2"]).where("doc_id = rep").select("rep", "n_shingles", "bands", "packed")
    keyed = rep_rows.select("rep", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BUCKET).alias("blocks"))
    met = keyed.join(own_shuffle(shared, "key"), "key").join(rep_rows.drop("bands"), "rep")
    met = _in_blocks(met).select("key", "bi", "bj", "block", "rep", "n_shingles", "packed")
    near = met.repartition(partitions(docs), "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj").mapInArrow(tk.lean(_estimator(percent)), "src long, dst long")
    clusters = connected_components(near).select(F.col("id").alias("rep"), F.col("component").alias("cluster"))
    sizes = some.groupBy(F.col("doc_id").alias("rep")).agg(F.max("n_shingles").alias("n_shingles"))
    blocks = clusters.join(sizes, "rep").groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / BLOCK).alias("blocks"))
    member = _in_blocks(clusters.join(own_shuffle(blocks, "cluster"), "cluster"))
    rows = member.join(texts(docs).withColumnRenamed("doc_id", "rep"), "rep")
    sorted_rows = rows.repartition(partitions(docs), "cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj", "rep")
    links = sorted_rows.select("cluster", "bi", "bj", "block", "rep", "text").mapInArrow(tk.lean(_linker(percent)), "src long, dst long")
    found = connected_components(links).select(F.col("id").alias("rep"), "component")
    by_set = reps.join(found, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(by_set, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
