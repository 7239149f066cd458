"""Language-model scores from a log-frequency Bloom filter (Talbot and Osborne, 2007).

N-grams of up to ``ORDER`` words of the whole training corpus are counted by a
shuffle.  Counts of two words and more go into a Bloom filter as quantised
levels: a key of level q is inserted with the numbers 1 to q, and a reader
probes 1, 2, ... until one is absent, so a false positive can only raise a
count by a level or so.  Counts of single words are kept exactly.  The filter
grows with the corpus, so it can't be broadcast: it lies in segments by bucket
of keys, each as large as its own entries need.  Texts are dealt to runs; the
distinct n-grams of a run are sent to their segments and the levels back to the
run.  All sizes take this one way, and no count is ever left out.

Probabilities of each order are counts smoothed towards the next lower order
(Dirichlet priors).  Numerators take the low end of a level and denominators
the high end, so the distribution sums to one at most, but for false positives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from . import textkernel as tk
from ._util import group_bounds, id_remainder, partitions, texts, whole_groups

ORDER = 3
#: Weight of the next lower order in a context, by order.
PRIORS = {2: 256.0, 3: 0.25}
#: Bits for each entry of a segment, and probes for each.
ENTRY_BITS, PROBES = 8, 5
#: Tokens that a task counts before it sends the counts on.
BUFFER = 1 << 22
#: Bytes of training text behind a bucket of keys, and of scored texts in a run, as a mean.
BUCKET_BYTES, RUN_BYTES = 16 << 20, 8 << 20
#: Keys of two words and more keep so many bits over those that number the corpus's bytes, and this many at least.
SPARE_BITS, KEY_BITS = 7, 32
#: The token that ends each text.
END = np.uint64(0x0E0D0E0D0E0D0E0D)

#: Smallest count of each level: 1, 2, 3, 4, 6, 8, 12, 16, 24, ...
LEVELS = np.array([1, 2, 3] + [x for p in range(2, 48) for x in (1 << p, 3 << (p - 1))], np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    """Level of each count, from 1; 0 for no occurrence."""
    return np.searchsorted(LEVELS, counts, "right")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with the ends, and each text's first."""
    data, offsets = tk.string_buffers(column)
    w = tk.words_of(data, offsets, tk.space_words())
    ptr = w.ptr + np.arange(len(w.ptr))
    out = np.full(ptr[-1], END, np.uint64)
    doc = np.repeat(np.arange(len(w.ptr) - 1), np.diff(w.ptr))
    out[np.arange(len(w.hashes)) + doc] = w.hashes
    return out, ptr


def _before(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Each text's values moved on by one place; the end stands before the first."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    if len(values):
        out[ptr[:-1]] = END
    return out


def _grams(tokens: np.ndarray, ptr: np.ndarray, key_bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, keys) of the n words that end at each token; single words keep all 64 bits."""
    yield 1, tokens
    key = tokens
    for n in range(2, ORDER + 1):
        key = tk.mix64(_before(key, ptr) * np.uint64(0x9E3779B97F4A7C15) + tokens)
        yield n, key >> np.uint64(64 - key_bits)


def _pack(values: np.ndarray) -> bytes:
    """Compressed numbers from 0, byte by byte, in as many bytes as the largest needs."""
    size = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)
    packer = tk.process_cache().setdefault("packer", zstandard.ZstdCompressor(level=1))
    return bytes([size]) + packer.compress(planes.tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    unpacker = tk.process_cache().setdefault("unpacker", zstandard.ZstdDecompressor())
    planes = np.frombuffer(unpacker.decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : blob[0]] = planes.T
    return out.view("<u8").ravel()


def _width(n: int, key_bits: int) -> int:
    return 64 if n == 1 else key_bits


def _by_bucket(keys: np.ndarray, width: int, bits: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(bucket, first, end, packed keys) of sorted distinct keys of so many bits."""
    shift = np.uint64(width - bits)
    edge = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << shift).tolist()
    for b, (i, j) in enumerate(zip(edge, [*edge[1:], len(keys)], strict=True)):
        if j > i:
            yield b, i, j, _pack(np.diff(keys[i:j], prepend=np.uint64(b) << shift))


def _keys_of(blob: bytes, bucket: int, width: int, bits: int) -> np.ndarray:
    return np.cumsum(_unpack(blob), dtype=np.uint64) + (np.uint64(bucket) << np.uint64(width - bits))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    named = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), named, strict=True)], [n for n, _ in named])


COUNTED = "bucket int, n int, keys binary, counts binary"


def _counter(bits: int, key_bits: int):
    def flush(n: int, held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return _batch([(b, n, blob, _pack(counts[i:j])) for b, i, j, blob in _by_bucket(keys, _width(n, key_bits), bits)], COUNTED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for part in tk.slices(batch, "text"):
                t, ptr = _tokens(part.column(0))
                for n, keys in _grams(t, ptr, key_bits):
                    held.setdefault(n, []).append(keys)
                size += len(t)
                if size >= BUFFER:
                    yield from (flush(n, held.pop(n)) for n in list(held))
                    size = 0
        if size:
            yield from (flush(n, held.pop(n)) for n in list(held))

    return count


MERGED = "bucket int, tokens long, distinct long, keys binary, counts binary, segment binary"


def _merger(bits: int, key_bits: int):
    """Exact counts of a bucket's single words and the filter's segment of the others."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["bucket"]):
            bounds = group_bounds(t, ["bucket"])
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                part = t.slice(i, j - i)
                bucket, order = part.column("bucket")[0].as_py(), part.column("n").to_numpy()
                single, levels, entries = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), {}, 0
                for n in range(1, ORDER + 1):
                    own = part.filter(pa.array(order == n))
                    if own.num_rows:
                        keys = np.concatenate([_keys_of(x, bucket, _width(n, key_bits), bits) for x in own.column("keys").to_pylist()])
                        counts = np.concatenate([_unpack(x) for x in own.column("counts").to_pylist()])
                        by_key = np.argsort(keys, kind="stable")
                        keys, counts = keys[by_key], counts[by_key].astype(np.int64)
                        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                        keys, counts = keys[heads], np.add.reduceat(counts, heads)
                        if n == 1:
                            single = keys, counts
                        else:
                            levels[n] = keys, level_of(counts)
                            entries += int(levels[n][1].sum())
                seg = np.zeros(max(64, -(-entries * ENTRY_BITS // 64) * 64), bool)
                for n, (keys, level) in levels.items():
                    for q in range(1, int(level.max()) + 1):
                        for at in _places(keys[level >= q], n, q, len(seg)):
                            seg[at] = True
                packed = _pack(np.diff(single[0], prepend=np.uint64(bucket) << np.uint64(64 - bits)))
                yield _batch([(bucket, int(single[1].sum()), len(single[0]), packed, _pack(single[1]), np.packbits(seg, bitorder="little").tobytes())], MERGED)

    return merge


def _places(keys: np.ndarray, n: int, level: int, seg_bits: int) -> Iterator[np.ndarray]:
    """Places in a segment of ``seg_bits`` bits for each probe of an entry."""
    h = tk.mix64(keys ^ np.uint64((0xA0761D6478BD642F * (ORDER * level + n)) & (2**64 - 1)))
    a, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield ((a + np.uint64(i) * step) % np.uint64(seg_bits)).astype(np.int64)


def probe_levels(segment: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Level of each key by repeated probes; 0 if its first entry is absent."""
    out = np.zeros(len(keys), np.int64)
    live, q = np.arange(len(keys)), 1
    while len(live) and len(segment) and q <= len(LEVELS):
        left = np.arange(len(live))
        for at in _places(keys[live], n, q, len(segment) * 8):
            bit = at[left]
            left = left[(segment[bit >> 3] >> (bit & 7)) & 1 == 1]
        live = live[left]
        out[live] = q
        q += 1
    return out


def _bytes_of(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def train(docs: DataFrame) -> dict:
    """Counts of all n-grams of ``docs(text)``, as a model for ``score``.

    ``buckets`` is a table with a row for each bucket of keys: exact counts of
    its single words and the filter's segment of its other n-grams.  Their
    number grows with the corpus, so a task's memory doesn't.  Null texts are
    left out; repeated rows count as often as they occur.  An empty table gives
    a model without counts.
    """
    docs = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    size = _bytes_of(docs)
    bits = max(2, (size // BUCKET_BYTES).bit_length())
    key_bits = min(60, max(KEY_BITS, size.bit_length() + SPARE_BITS))
    counted = docs.mapInArrow(tk.lean(_counter(bits, key_bits)), COUNTED)
    buckets = cut(counted.repartition(max(partitions(docs), 1 << bits >> 1), "bucket").sortWithinPartitions("bucket").mapInArrow(tk.lean(_merger(bits, key_bits)), MERGED))
    total = buckets.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    return {"buckets": buckets, "bits": bits, "key_bits": key_bits, "tokens": total.tokens or 0, "distinct": total.distinct or 0}


#: Rows that meet in a bucket: the model's (run -2: counts, -1: segment), and probes of runs; and the answers.
ROUTED = "run long, bucket int, n int, data binary, more binary"


def _dealer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each batch by run, compressed."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        run = batch.column(0).to_numpy()
        order = np.argsort(run, kind="stable")
        edge = np.flatnonzero(np.append(True, run[order][1:] != run[order][:-1]))
        rows = []
        for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(order)], strict=True):
            own = batch.take(pa.array(order[i:j])).select([1, 2])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=options) as out:
                out.write_batch(own)
            rows.append((int(run[order[i]]), sink.getvalue().to_pybytes()))
        if rows:
            yield _batch(rows, "run long, data binary")


def _run_tokens(blobs: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, tokens and each text's first token of the texts of a run."""
    ids, tokens, ptr = [], [], [np.zeros(1, np.int64)]
    for blob in blobs:
        for batch in pa.ipc.open_stream(blob):
            for part in tk.slices(batch, "text"):
                t, p = _tokens(part.column(1))
                ids.append(part.column(0))
                tokens.append(t)
                ptr.append(p[1:] + ptr[-1][-1])
    return pa.concat_arrays(ids), np.concatenate(tokens), np.concatenate(ptr)


def _prober(bits: int, key_bits: int):
    """The distinct n-grams of each run by bucket."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["run"]):
            bounds = group_bounds(t, ["run"])
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                run = t.column("run")[int(i)].as_py()
                _, tokens, ptr = _run_tokens(t.column("data").slice(i, j - i).to_pylist())
                for n, keys in _grams(tokens, ptr, key_bits):
                    yield _batch([(run, b, n, blob, None) for b, _, _, blob in _by_bucket(tk.distinct(keys), _width(n, key_bits), bits)], ROUTED)

    return probe


def _answerer(bits: int, key_bits: int):
    """Exact counts of single words and levels of the others, for the probes of each bucket."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, none = -1, (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        single, segment = none, np.zeros(0, np.uint8)
        for batch in batches:
            rows = []
            for run, b, n, data, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:  # a bucket without counts holds no entry
                    bucket, single, segment = b, none, np.zeros(0, np.uint8)
                if run == -2:
                    single = _keys_of(data, b, 64, bits), _unpack(more)
                elif run == -1:
                    segment = np.frombuffer(data, np.uint8)
                else:
                    keys = _keys_of(data, b, _width(n, key_bits), bits)
                    if n == 1:
                        at = tk.lookup(single[0], keys)
                        found = np.where(at >= 0, single[1][at], 0) if len(single[0]) else np.zeros(len(keys), np.int64)
                    else:
                        found = probe_levels(segment, keys, n)
                    rows.append((run, b, n, _pack(found), None))
            if rows:
                yield _batch(rows, ROUTED)

    return answer


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scores(ids: pa.Array, tokens: np.ndarray, ptr: np.ndarray, found: dict[int, np.ndarray], total: int, key_bits: int) -> pa.Table:
    """Scores of a run's texts; ``found`` has the counts or levels of its distinct n-grams, in order of their keys."""
    top = np.append(LEVELS[1:], LEVELS[-1] * 2) - 1
    p, context, heads = None, None, ptr[:-1]
    for n, keys in _grams(tokens, ptr, key_bits):
        value = found[n].astype(np.int64)[np.unique(keys, return_inverse=True)[1]]
        if n == 1:
            known, p = value > 0, (value + 1) / total
            base = np.log10(p)
            low = high = value
            # a text stands after the end of another
            ends = low[ptr[1:] - 1]
        else:
            low, high = (np.where(value > 0, x[value - 1], 0) for x in (LEVELS, top))
            p = (np.minimum(low, context) + PRIORS[n] * p) / (context + PRIORS[n])
        context = np.empty(len(tokens), np.int64)
        context[1:] = high[:-1]
        context[heads] = ends
    add = lambda x: pa.array(np.add.reduceat(x, heads))
    return pa.table([ids, pa.array(np.diff(ptr)), add(known.astype(np.int64)), add(base), add(np.log10(p))], names=[x.split()[0] for x in SCORED.split(", ")])


def _scorer(total: int, key_bits: int):
    def score(dealt: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by([("n", "ascending"), ("bucket", "ascending")])
        order, data = answers.column("n").to_numpy(), answers.column("data").to_pylist()
        found = {n: np.concatenate([_unpack(x) for x, own in zip(data, order, strict=True) if own == n]) for n in range(1, ORDER + 1)}
        out = _scores(*_run_tokens(dealt.column("data").to_pylist()), found, total, key_bits)
        del answers, data, found
        tk.trim()
        return out

    return score


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs(doc_id, text, ...)``.

    ``base_score`` is the add-one log10 probability of the single tokens by
    exact counts; ``score`` is that of the smoothed n-grams, whose counts come
    from repeated probes.  A null or empty text is the end token alone.
    Repeated rows and null ids get their rows; other columns are ignored.  A
    very long text is a run of its own at most.  An empty table gives an empty
    result.
    """
    bits, key_bits, width = model["bits"], model["key_bits"], partitions(docs)
    named = texts(docs)
    runs = max(1, _bytes_of(named) // RUN_BYTES)
    # a row's run follows from its content, so a repeated task deals alike
    run = F.pmod(F.xxhash64("doc_id", "text"), F.lit(runs)).alias("run")
    dealt = named.select(run, "doc_id", "text").mapInArrow(tk.lean(_dealer), "run long, data binary").repartition(max(width, runs >> 2), "run")
    probes = dealt.sortWithinPartitions("run").mapInArrow(tk.lean(_prober(bits, key_bits)), ROUTED)
    b = model["buckets"]
    nothing = F.lit(None).cast("binary").alias("more")
    counts = b.select(F.lit(-2).cast("long").alias("run"), "bucket", F.lit(1).alias("n"), F.col("keys").alias("data"), F.col("counts").alias("more"))
    segments = b.select(F.lit(-1).cast("long").alias("run"), "bucket", F.lit(0).alias("n"), F.col("segment").alias("data"), nothing)
    both = probes.unionAll(counts).unionAll(segments).repartition(max(width, 1 << bits >> 1), "bucket").sortWithinPartitions("bucket", "run")
    answers = both.mapInArrow(tk.lean(_answerer(bits, key_bits)), ROUTED).select("run", "bucket", "n", "data")
    # both sides are dealt by run, and the texts' exchange is the one that the probes read
    total = model["tokens"] + model["distinct"] + 1
    scored = dealt.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_scorer(total, key_bits), SCORED)
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


def held_out(column: str = "doc_id") -> Column:
    return id_remainder(7, column) == 2
