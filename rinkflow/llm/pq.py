"""Near-duplicate vectors by product quantisation.

A coarse quantiser deals unit vectors to inverted lists.  A member of a list is
stored by subspace codes of its residual.  A query probes every list that may
hold a neighbour, ranks the list's members by asymmetric distances from lookup
tables, and takes the exact cosine, in double precision, of those in reach.

No link is lost: two unit vectors of cosine c are ``sqrt(2 - 2c)`` apart, so a
list is skipped only if the query lies farther than that beyond the plane
between the list's centre and its own, or from the list's ball; and a member
only if its asymmetric distance, less the error of its own code, exceeds it.
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
from ._util import group_bounds, own_shuffle, partitions, whole_groups
from .graph import connected_components

#: Vectors that the quantisers are fitted on at most, and rounds of fitting.
SAMPLE, ROUNDS = 16_384, 8
#: Subspaces and codes of each; lists grow with the root of the rows, up to a quarter of the sample.
SUBSPACES, CODES = 8, 64
#: Rows of a block of a list; larger lists are compared by pairs of blocks, each in its own task.
BLOCK = 2048
#: Pairs whose exact cosines are taken at a time; where most pairs survive, one product of matrices takes them all.
PAIRS, DENSE = 1 << 16, 0.1
EPS = 1e-9


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = np.maximum(0.0, (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * x @ centres.T)
    return d.argmin(1), d


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        at, d = _nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None], centres)
    return centres


def fit(sample: np.ndarray, rows: int, seed: int = 3) -> dict:
    """Coarse centres and residual codebooks from a sample of unit vectors, for so many rows."""
    rng = np.random.default_rng(seed)
    # few, large lists: a query is sent to each list that it probes, and blocks of members are cheap to compare
    lists = int(np.clip(np.sqrt(rows) / 8, 1, max(1, len(sample) // 4)))
    coarse = kmeans(sample, lists, rng)
    at, _ = _nearest(sample, coarse)
    rest = sample - coarse[at]
    parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
    return {"coarse": coarse, "parts": parts, "books": [kmeans(rest[:, p], CODES, rng) for p in parts]}


def encode(x: np.ndarray, lists: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Subspace codes of the residuals, and each code's error (distance from the vector)."""
    rest = x - model["coarse"][lists]
    codes, error = np.empty((len(x), len(model["parts"])), np.int64), np.zeros(len(x))
    for s, (p, book) in enumerate(zip(model["parts"], model["books"], strict=True)):
        codes[:, s], d = _nearest(rest[:, p], book)
        error += ((rest[:, p] - book[codes[:, s]]) ** 2).sum(1)
    return codes, np.sqrt(error)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


PROBED = "label int, list int, width int, rep long, home boolean, far double"


def _prober(shared, reach: float):
    """The vector's own list, and each list on whose side of the bisecting plane a neighbour may lie; no vectors."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            widths = batch.column(2).to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                c = models[int(width)]["coarse"]
                own, d2 = _nearest(_vectors(part.column(3), int(width)), c)
                between = np.sqrt(np.maximum(1e-30, _nearest(c, c)[1]))
                at = np.arange(len(own))
                near = (d2 - d2[at, own][:, None]) / (2 * between[own]) <= reach + EPS
                near[at, own] = True
                row, lst = np.nonzero(near)
                keep = lst >= own[row]  # a pair is found from the side whose own list comes first
                row, lst = row[keep], lst[keep]
                took = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [took.column(0), pa.array(lst.astype(np.int32)), took.column(2), took.column(1), pa.array(lst == own[row]), pa.array(np.sqrt(d2[row, lst]))],
                    [x.split()[0] for x in PROBED.split(", ")],
                )

    return probe


def _min_labels(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label reachable through a bipartite table of links."""
    big = np.iinfo(np.int64).max
    while True:
        new = np.minimum(right, np.where(linked, left[:, None], big).min(0)) if len(left) else right
        back = np.minimum(left, np.where(linked, new[None], big).min(1)) if len(new) else left
        if (new == right).all() and (back == left).all():
            return left, right
        left, right = back, new


def confirmed(a: np.ndarray, b: np.ndarray, near: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs ``near`` have a cosine of ``threshold`` at least."""
    if near.mean() > DENSE:
        return (a @ b.T >= threshold) & near
    x, y = np.nonzero(near)
    out = np.zeros_like(near)
    for i in range(0, len(x), PAIRS):
        p, r = x[i : i + PAIRS], y[i : i + PAIRS]
        out[p, r] = np.einsum("ij,ij->i", a[p], b[r]) >= threshold
    return out


def _matcher(shared, threshold: float, reach: float):
    keys = ["label", "list", "width", "qb", "mb"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            bounds = group_bounds(t, keys)
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                g = t.slice(i, j - i).combine_chunks()
                width, lst = g.column("width")[0].as_py(), g.column("list")[0].as_py()
                role = g.column("role").to_numpy()
                ids, weight, home = g.column("rep").to_numpy(), g.column("weight").to_numpy(), g.column("home").to_numpy(zero_copy_only=False)
                v = _vectors(g.column("v").chunk(0), width)
                q, m = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
                if not len(q) or not len(m):
                    continue
                model = shared.value[width]
                codes, error = encode(v[m], np.full(len(m), lst), model)
                rest = v[q] - model["coarse"][lst]
                far = np.zeros((len(q), len(m)))
                for s, (p, book) in enumerate(zip(model["parts"], model["books"], strict=True)):
                    far += _nearest(rest[:, p], book)[1][:, codes[:, s]]
                near = np.sqrt(np.maximum(0.0, far)) - error[None] <= reach + 1e-6
                # within its own list a pair comes up from both sides: one is taken
                near &= ~(home[q][:, None] & (ids[q][:, None] >= ids[m][None]))
                rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                if not len(rows):
                    continue
                q, m, near = q[rows], m[cols], near[np.ix_(rows, cols)]
                linked = confirmed(v[q], v[m], near, threshold)
                rows, cols = linked.any(1), linked.any(0)
                q, m, linked = q[rows], m[cols], linked[np.ix_(rows, cols)]
                if not len(q):
                    continue
                left, right = _min_labels(linked, ids[q].copy(), ids[m].copy())
                out = [np.concatenate([ids[q], ids[m]]), np.concatenate([linked @ weight[m], weight[q] @ linked]), np.concatenate([left, right])]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], ["rep", "links", "to"])

    return match


PREPARED = "vec_id long, label int, d1 long, d2 long, v array<double>"


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors and a digest of 128 bits of the given numbers, which equal vectors share; null where a row can't link."""
    for batch in batches:
        ids, lists, labels = batch.columns
        offsets = lists.offsets.to_numpy().astype(np.int64)
        x = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0] : offsets[-1]]  # a null is not-a-number
        n = np.diff(offsets)
        row = np.repeat(np.arange(len(n)), n)
        sound = (n > 0) & np.logical_and.reduce([np.asarray(c.is_valid().to_numpy(zero_copy_only=False), bool) for c in (ids, lists, labels)])
        sound &= (np.bincount(row, weights=~np.isfinite(x), minlength=len(n)) == 0) & (np.bincount(row, weights=x != 0, minlength=len(n)) > 0)
        y, size = x[sound[row]] + 0.0, n[sound]  # minus zero is zero
        heads = np.cumsum(size) - size
        digest = np.zeros((2, len(n)), np.int64)
        if len(size):
            # a scale first, so that no square overflows
            scaled = y / np.repeat(np.maximum.reduceat(np.abs(y), heads), size)
            unit = scaled / np.repeat(np.sqrt(np.add.reduceat(scaled * scaled, heads)), size)
            found = [xxhash.xxh3_128_intdigest(y[i : i + k].data) for i, k in zip(heads.tolist(), size.tolist(), strict=True)]
            digest[:, sound] = np.array([[f >> 64, f & (2**64 - 1)] for f in found], np.uint64).T.view(np.int64)
        else:
            unit = y
        ends = np.concatenate([[0], np.cumsum(np.where(sound, n, 0))]).astype(np.int32)
        v = pa.ListArray.from_arrays(pa.array(ends), pa.array(unit), mask=pa.array(~sound))
        yield pa.RecordBatch.from_arrays([ids, labels, *(pa.array(d, mask=~sound) for d in digest), v], ["vec_id", "label", "d1", "d2", "v"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors(vec_id, embedding, label, ...)``.

    Vectors of equal, non-null label link at a cosine of ``threshold`` and more
    (above 0).  Null vectors, and such as hold nulls or non-finite numbers or
    have no length, link with nothing; vectors of unlike dimension neither.
    Equal vectors count as one in the search and each as a link of the others.
    Repeated rows count as rows of their own; unlike vectors under one id share
    their links.  A row with a null id links with
    nothing and its component is null.  An empty table gives an empty result.

    The quantisers are fitted on the ``SAMPLE`` vectors of smallest hash (of
    each dimension); every vector is indexed and searched.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), F.col("label").cast("int").alias("label"))
    keyed = cut(rows.mapInArrow(tk.lean(_prepare), PREPARED))
    same = ["label", "d1", "d2"]
    unit = cut(keyed.where("v is not null").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("v").alias("v")).withColumn("width", F.size("v")))
    found = _links(unit, threshold)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("rep <> to").select(F.col("rep").alias("src"), F.col("to").alias("dst"))).select(F.col("id").alias("rep"), "component")
    by_rep = unit.select(*same, "rep", "weight").join(links, "rep", "left").join(parts, "rep", "left")
    by_rep = by_rep.select(*same, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    alone = keyed.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = keyed.where("v is not null").select("vec_id", *same).join(by_rep, same).select("vec_id", F.col("n").cast("long").alias("n_links"), F.col("c").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(unit: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, to): for blocks of comparisons, linked weight and smallest id reached."""
    spark = unit.sparkSession
    schema = "rep long, links long, to long"
    sizes = {r.width: r.n for r in unit.groupBy("width").agg(F.count("*").alias("n")).collect()}  # a row for each dimension
    if not sizes:
        return spark.createDataFrame([], schema)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    models = {}
    for width, n in sizes.items():
        draw = F.pmod(F.xxhash64("rep", F.lit("pq")), F.lit(1 << 30)) / float(1 << 30)
        # nearly all rows beyond the wanted ones are left out before the sort
        few = unit.where((F.col("width") == width) & (draw < 2 * SAMPLE / n + 1e-3))
        sample = few.orderBy(draw, "rep").limit(SAMPLE).select("v").toArrow()
        x = _vectors(sample.column(0).combine_chunks(), width) if sample.num_rows else np.eye(1, width)
        models[width] = fit(x, n)
    shared = spark.sparkContext.broadcast(models)
    probes = cut(unit.select("label", "rep", "width", "v").mapInArrow(_prober(shared, reach), PROBED))
    cell = ["label", "list", "width"]
    # a list's ball is that of its members of the label; lists without any aren't probed
    balls = probes.where("home").groupBy(*cell).agg(F.max("far").alias("ball"), F.ceil(F.count("*") / BLOCK).cast("int").alias("mbs"))
    probes = probes.join(own_shuffle(balls, *cell), cell).where(F.col("home") | (F.col("far") <= F.col("ball") + reach + EPS))
    asking = probes.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qbs"))
    sized = probes.join(own_shuffle(asking, *cell), cell)
    block = F.xxhash64("rep")
    members = sized.where("home").withColumn("mb", F.pmod(block, "mbs").cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)))
    queries = sized.withColumn("qb", F.pmod(block, "qbs").cast("int")).withColumn("mb", F.explode(F.sequence(F.lit(0), F.col("mbs") - 1)))
    keys = [*cell, "qb", "mb"]
    both = queries.select(*keys, "rep", "home", F.lit(0).alias("role")).unionByName(members.select(*keys, "rep", "home", F.lit(1).alias("role")))
    rows = both.join(unit.select("label", "width", "rep", "weight", "v"), ["label", "width", "rep"])
    return cut(rows.repartition(partitions(unit), *keys).sortWithinPartitions(*keys).mapInArrow(_matcher(shared, threshold, reach), schema))
