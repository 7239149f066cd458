"""Harmonic packing of tokenised documents into training sequences.

Piece lengths fall into reciprocal-capacity classes: class k holds pieces of
exactly ``capacity // k`` tokens, and a bin of that class always takes k of
them.  Since cutting is free, a document is cut into the largest class lengths
that fit, so all but a few pieces fill their bins.  Bins are filled on their
own by each worker: a worker ranks its pieces of a class, and a prefix sum over
the table of counts turns that rank into a place.  The pieces that are left
over at the end, fewer than k in each class, share the last sequences by first
fit.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut
from . import textkernel as tk
from ._util import texts

CAPACITY = 2048
END_ID = 1
#: Pieces that one worker ranks, for each class at most.
WORKER_PIECES = 200_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, klass int"


def class_pieces(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(class, length) of the pieces that a document of so many tokens is cut into."""
    out = [(1, capacity)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // (rest + 1) + 1  # the smallest k with capacity // k <= rest
        out.append((k, capacity // k))
        rest -= capacity // k
    return out


class Encoder:
    """Token ids of the byte-level BPE file, by two libraries that agree.

    tiktoken runs the same vocabulary several times faster; it takes the texts
    whose characters both libraries surely class alike (below U+0250) and that
    hold no special token's name.  All others go to tokenizers itself.
    """

    def __init__(self, tokenizer_file: str | None, ranks_file: str | None):
        import base64
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"))
        self.fast = None
        if ranks_file or not tokenizer_file:
            with open(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile("[^\x00-ɏ]|<\\|endoftext\\|>").search

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and not self.other(text):
            return np.asarray(self.fast.encode_to_numpy(text), np.uint32)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(tokenizer_file: str | None = None, ranks_file: str | None = None) -> Encoder:
    cache = tk.process_cache()
    key = ("encoder", tokenizer_file, ranks_file)
    if key not in cache:
        cache[key] = Encoder(tokenizer_file, ranks_file)
    return cache[key]


def _cutter(capacity: int, with_ids: bool, tokenizer_file: str | None, ranks_file: str | None):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_file, ranks_file)
        for batch in batches:
            for part in tk.slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(enc.encode(text), np.uint32(END_ID)).astype("<u4")
                    at = 0
                    for k, length in class_pieces(len(ids), capacity):
                        piece = ids[at : at + length].tobytes()
                        rows.append((doc, at, length, zlib.crc32(piece), len(ids), k, *((piece,) if with_ids else ())))
                        at += length
                kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.binary()] * with_ids
                names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return pieces


def _last_sequences(left: dict[int, int], capacity: int, first: int) -> list[tuple[int, int, int, int]]:
    """(class, index, sequence, offset) by first fit, longest first; fewer than k pieces of each class k."""
    used: list[int] = []
    out = []
    for k in sorted(left):
        length, b = capacity // k, 0
        for j in range(left[k]):
            while b < len(used) and used[b] + length > capacity:
                b += 1
            if b == len(used):
                used.append(0)
            out.append((k, j, first + b, used[b]))
            used[b] += length
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, tokenizer_file: str | None = None, ranks_file: str | None = None) -> DataFrame:
    """Pieces of all ``docs(doc_id, text, ...)`` and their places in sequences of ``capacity`` tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and with ``with_ids`` the piece's ids as little-endian unsigned 32-bit
    numbers.  A document's ids end with id 1; a null or empty text has that one
    alone.  Rows with null or repeated ids are packed like all others.  No
    sequence holds a gap; its end is padded unless it is full.  An empty table
    gives no pieces.
    """
    spark = docs.sparkSession
    schema = PIECES + (", ids binary" if with_ids else "")
    pieces = cut(texts(docs).mapInArrow(tk.lean(_cutter(capacity, with_ids, tokenizer_file, ranks_file)), schema))
    totals = {r.klass: r.n for r in pieces.groupBy("klass").agg(F.count("*").alias("n")).collect()}  # a row for each class: at most 2 * sqrt(capacity)
    base, full = 0, {}
    for k in sorted(totals):
        full[k] = (base, totals[k] // k)
        base += totals[k] // k
    last = _last_sequences({k: n % k for k, n in totals.items() if n % k}, capacity, base)
    workers = max(1, -(-sum(totals.values()) // WORKER_PIECES))
    placed = pieces.withColumn("worker", F.pmod(F.xxhash64("doc_id", "start"), F.lit(workers)))
    counts = placed.groupBy("klass", "worker").agg(F.count("*").alias("n"))
    before = Window.partitionBy("klass").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("klass", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("klass", "worker").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = placed.withColumn("rank", rank.cast("long")).join(counts, ["klass", "worker"])
    g = F.col("before") + F.col("rank")
    classes = spark.createDataFrame([(k, b, n) for k, (b, n) in full.items()], "klass int, base long, bins long")
    rest = spark.createDataFrame(last, "klass int, place long, last_sequence long, last_offset long")
    out = ranked.withColumn("g", g).join(F.broadcast(classes), "klass")
    out = out.withColumn("place", F.when(F.col("g") >= F.col("bins") * F.col("klass"), F.col("g") - F.col("bins") * F.col("klass")))
    out = out.join(F.broadcast(rest), ["klass", "place"], "left")
    inside = F.col("place").isNull()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    columns += [
        F.when(inside, F.col("base") + F.floor(F.col("g") / F.col("klass"))).otherwise(F.col("last_sequence")).cast("long").alias("sequence_id"),
        F.when(inside, F.pmod("g", "klass") * F.floor(F.lit(capacity) / F.col("klass"))).otherwise(F.col("last_offset")).cast("long").alias("offset"),
    ]
    return out.select(*columns, *(["ids"] if with_ids else []))
