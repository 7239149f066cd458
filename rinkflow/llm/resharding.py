"""Resharding by minimum-cost flow.

Rows lie in old shards and go to new shards of given capacities.  A flow over
(old shard, new shard) of least cost says how many bytes each pair exchanges; a
byte that stays costs nothing.  Rows move in blocks (rows of an old shard whose
texts hash alike, so equal texts move together), chosen to realise the flow.
The driver sees the table of blocks alone, whose length is a parameter.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Blocks of each old shard, and parts that a block's rows are ranked in.
BLOCKS, PARTS = 1024, 32
#: A block of more than this share of a shard's capacity (a group of copies, say) is split by id.
SPLIT = 0.9


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[float]]) -> list[list[int]]:
    """Bytes from each old to each new shard, at least cost (successive shortest paths with potentials).

    ``sum(capacity)`` must not be less than ``sum(supply)``.
    """
    n, m = len(supply), len(capacity)
    source, sink, size = n + m, n + m + 1, n + m + 2
    graph: list[list[list]] = [[] for _ in range(size)]  # [to, room, cost, index of the reverse edge]

    def edge(a: int, b: int, room: int, c: float) -> None:
        graph[a].append([b, room, c, len(graph[b])])
        graph[b].append([a, 0, -c, len(graph[a]) - 1])

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, cost[i][j])
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    potential = [0.0] * size
    left = sum(supply)
    while left:
        dist, via = [float("inf")] * size, [None] * size
        dist[source] = 0
        heap = [(0.0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for k, (b, room, c, _) in enumerate(graph[a]):
                to = d + c + potential[a] - potential[b]
                if room and to < dist[b] - 1e-12:
                    dist[b], via[b] = to, (a, k)
                    heapq.heappush(heap, (to, b))
        if via[sink] is None:
            raise ValueError("the capacities don't hold all bytes")
        potential = [p + (d if d < float("inf") else 0) for p, d in zip(potential, dist, strict=True)]
        path, b = [], sink
        while b != source:
            path.append(via[b])
            b = via[b][0]
        room = min(left, *(graph[a][k][1] for a, k in path))
        for a, k in path:
            graph[a][k][1] -= room
            graph[graph[a][k][0]][graph[a][k][3]][1] += room
        left -= room
    flow = [[0] * m for _ in range(n)]
    for i in range(n):
        for b, _, _, back in graph[i]:
            if n <= b < n + m:
                flow[i][b - n] = graph[b][back][1]
    return flow


def choose_blocks(blocks: list[tuple[int, int, int]], flow: list[list[int]], capacity: list[int]) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block) of ``blocks(old, block, bytes)``, near to the flow."""
    owed = [0.0] * len(capacity)
    held = [0] * len(capacity)
    place: dict[tuple[int, int], int] = {}
    by_old: dict[int, list[tuple[int, int]]] = {}
    for old, block, size in blocks:
        by_old.setdefault(old, []).append((size, block))
    for old in sorted(by_old):
        need = {j: f + owed[j] for j, f in enumerate(flow[old]) if f}
        for size, block in sorted(by_old[old], reverse=True):
            j = max(need, key=lambda x: (need[x], x == old, -x))
            place[old, block] = j
            need[j] -= size
            held[j] += size
        for j, x in need.items():
            owed[j] = x
    sizes = {(old, block): size for old, block, size in blocks}
    inside: list[set] = [set() for _ in capacity]
    for key, j in place.items():
        inside[j].add(key)
    # small blocks go from the fullest to the emptiest shard while that evens them out; each step lessens the
    # sum of squares, and a block that has no better place isn't moved, so a step for each block and pair of shards is ample
    for _ in range(len(blocks) * len(capacity) ** 2 + 1):
        over = [h - c for h, c in zip(held, capacity, strict=True)]
        a, b = max(range(len(over)), key=over.__getitem__), min(range(len(over)), key=over.__getitem__)
        gap = over[a] - over[b]
        best = min((k for k in inside[a] if 0 < sizes[k] < gap), key=lambda k: (abs(2 * sizes[k] - gap), k), default=None)
        if best is None:
            break
        inside[a].remove(best)
        inside[b].add(best)
        held[a] -= sizes[best]
        held[b] += sizes[best]
        place[best] = b
    return place


def hash_layout(n: int) -> Column:
    """An old layout to start from where rows have none: texts dealt to n shards by hash."""
    return F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")


def reshard(docs: DataFrame, old_shards: int, new_shards: int, old: Column | None = None, shares: list[float] | None = None, cost: list[list[float]] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) of every row of ``docs(doc_id, text, ...)``.

    ``old`` gives each row's old shard, from 0; by default texts are dealt by
    hash.  ``shares`` are the new shards' capacities (equal by default) and
    ``cost[i][j]`` is what a byte from old shard i to new shard j costs, 1
    unless it stays.  A row's size is its text's bytes in UTF-8 plus one; a null
    text has no bytes and the checksum of none.  Slots are gapless in each
    shard.  Null and repeated ids are dealt like others.  An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (old.cast("int") if old is not None else F.lit(None).cast("int")).alias("given"))
    rows = known.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.coalesce("given", hash_layout(old_shards)).alias("old_shard"), F.pmod(F.xxhash64("text", F.lit("block")), F.lit(BLOCKS)).cast("int").alias("block"))

    def measured(df: DataFrame) -> list[tuple[int, int, int]]:
        got = df.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes")).collect()  # at most old_shards * BLOCKS rows, and the parts of split blocks
        return [(r.old_shard, r.block, r.bytes) for r in got]

    blocks = measured(rows)
    total = sum(x[2] for x in blocks)
    shares = shares or [1.0] * new_shards
    ends = [round(total * sum(shares[: j + 1]) / sum(shares)) for j in range(new_shards)]
    capacity = [b - a for a, b in zip([0, *ends], ends, strict=False)]
    large = [(o, b) for o, b, size in blocks if size > SPLIT * max(capacity)]  # fewer than new_shards / SPLIT
    if large:
        part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(BLOCKS)).cast("int")
        hit = F.lit(False)
        for i, (o, b) in enumerate(sorted(large)):
            hit = F.when((F.col("old_shard") == o) & (F.col("block") == b), BLOCKS * (i + 1) + part).otherwise(hit if i else F.col("block"))
        rows = rows.withColumn("block", hit)
        blocks = measured(rows)
    supply = [0] * old_shards
    for o, _, size in blocks:
        supply[o] += size
    cost = cost or [[float(i != j) for j in range(new_shards)] for i in range(old_shards)]
    place = choose_blocks(blocks, min_cost_flow(supply, capacity, cost), capacity)
    plan = spark.createDataFrame([(o, b, j) for (o, b), j in place.items()], "old_shard int, block int, shard int")
    dealt = rows.join(F.broadcast(plan), ["old_shard", "block"]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(PARTS)).cast("int"))
    unit = ["old_shard", "block", "part"]
    counts = dealt.groupBy("shard", *unit).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(*unit).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*unit, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*unit).orderBy("doc_id", "text_crc32", "size")) - 1
    out = dealt.withColumn("rank", rank).join(counts, unit)
    return out.select("doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("before") + F.col("rank")).cast("long").alias("slot"))


def affected_shards(dealt: DataFrame) -> list[int]:
    """Shards that a row leaves or enters."""
    moved = dealt.where("old_shard <> shard")
    both = moved.select(F.col("old_shard").alias("s")).unionAll(moved.select(F.col("shard").alias("s"))).distinct()
    return sorted(r.s for r in both.collect())


def rewrite_affected(docs: DataFrame, dealt: DataFrame, path: str) -> list[int]:
    """Write the rows of affected shards under ``path/shard=N``; files of all others stay as they are.

    Ids must be unique.  Running it again writes the same shards anew.
    """
    shards = affected_shards(dealt)
    to = dealt.where(F.col("shard").isin(shards)).select(F.col("doc_id").alias("_rf_id"), F.col("shard").alias("shard"), F.col("slot").alias("_rf_slot"))
    rows = docs.drop("shard").join(to, F.col("doc_id").eqNullSafe(F.col("_rf_id"))).repartition("shard", F.floor(F.col("_rf_slot") / 100_000)).sortWithinPartitions("shard", "_rf_slot")
    rows.drop("_rf_id", "_rf_slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return shards
