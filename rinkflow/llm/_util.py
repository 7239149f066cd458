"""Lineage cuts, grouped streams and other small parts that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def own_shuffle(small: DataFrame, *keys: str) -> DataFrame:
    """The same rows of a table grouped by integer ``keys``, whose partitioning is no longer known to the plan.

    A join with the rows that were grouped would else reuse the grouping's
    shuffle, and such a join can't be split.  This way both sides are shuffled
    for the join, and AQE splits a hot key's rows over several tasks.
    """
    return small.withColumns({k: F.shiftleft(k, 0) for k in keys})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so other columns can't clash; null texts are empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids count as remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups, of rows that come sorted by ``keys``.

    Only the group that is open at a batch's end is carried over.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(t.num_rows, bool)
        for k in keys:
            c = t.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= c[1:] != c[:-1]
            if held:
                change[0] |= held[-1].column(k)[-1].as_py() != c[0]
        heads = np.flatnonzero(change)
        if not len(heads):
            held.append(t)
            continue
        last = int(heads[-1])
        held.append(t.slice(0, last))
        done = pa.concat_tables(held)
        if done.num_rows:
            yield done.combine_chunks()
        held = [t.slice(last)]
    if held:
        done = pa.concat_tables(held)
        if done.num_rows:
            yield done.combine_chunks()


def group_bounds(t: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each group, and the number of rows."""
    change = np.zeros(t.num_rows, bool)
    change[0] = True
    for k in keys:
        c = t.column(k).to_numpy(zero_copy_only=False)
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


#: Bits of a filter of ids at most, and bits and probes for each id below that.
FILTER_BITS, ID_BITS, ID_PROBES = 1 << 27, 16, 3


def _id_places(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    h = (ids.astype(np.int64).view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for _ in range(ID_PROBES):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        yield (h >> np.uint64(20)) % np.uint64(bits)


def id_filter(ids: DataFrame):
    """A broadcast Bloom filter of a table with one column of ids.

    Its size has the bound ``FILTER_BITS``: beyond that more ids pass that
    aren't in the table, which costs time but changes no result of a join.
    """
    n = ids.count()
    bits = int(min(FILTER_BITS, max(1 << 16, 1 << (ID_BITS * max(1, n) - 1).bit_length())))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(list(_id_places(batch.column(0).to_numpy(zero_copy_only=False), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "mask"])

    got = ids.mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table_ = np.zeros(bits // 64, np.uint64)
    table_[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(table_)


def filtered(shared, batches: Iterator[pa.RecordBatch], at: int, keep: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows of batches whose id, in column ``at``, the filter may hold; with ``keep`` false, all the others (null ids too)."""
    held = shared.value
    for batch in batches:
        ids = batch.column(at)
        there = ~np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        for place in _id_places(values, len(held) * 64):
            there &= (held[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        yield batch.filter(pa.array(there if keep else ~there))


def may_hold(shared, df: DataFrame, column: str, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose id the filter may hold; with ``keep`` false, all the others (null ids too)."""
    at = df.columns.index(column)
    return df.mapInArrow(lambda batches: filtered(shared, batches, at, keep), df.schema)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
