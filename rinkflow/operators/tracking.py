"""Stone identities through an end.

An end's shots are folded in order inside one row, so an end needs one shuffle
and no Python.  The state is each team's stones on the last board and the next
free identity, which both teams share; team 1 is matched before team 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import END, GHOST_DIST, MAX_STONES, SHOT, TRACK_DIST

#: What is told of a stone's shot.
ORDER = ("place", "before", "n_shots")
_STONE = "struct<slot:int,x:double,y:double,id:bigint,px:double,py:double>"
_PLACED = "struct<shot_number:int,team:int,slot:int,x:double,y:double,stone_id:bigint,prev_x:double,prev_y:double,place:int,before:int,n_shots:bigint>"

# Pairs in reach by (distance, previous, current); the nearest free pair wins.
_GREEDY = f"""
aggregate(
  array_sort(filter(flatten(transform(b.prev, (p, i) -> transform(b.curr, (c, j) ->
    named_struct('d', sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)), 'i', i, 'j', j)))), q -> q.d < {TRACK_DIST}D)),
  cast(array() as array<struct<d:double,i:int,j:int>>),
  (m, q) -> if(exists(m, z -> z.i = q.i or z.j = q.j), m, array_append(m, q)))
"""

_NEW_STATE = """
transform(b.curr, (c, j) -> named_struct(
  'slot', c.slot, 'x', c.x, 'y', c.y,
  'id', coalesce(get(transform(filter(m, z -> z.j = j), z -> get(b.prev, z.i).id), 0), s1.nxt + j - size(filter(m, z -> z.j < j))),
  'px', get(transform(filter(m, z -> z.j = j), z -> get(b.prev, z.i).x), 0),
  'py', get(transform(filter(m, z -> z.j = j), z -> get(b.prev, z.i).y), 0)))
"""

# aggregate() over a one-element array binds a name to a value.
_FOLD = f"""
aggregate(shots,
  named_struct('p1', cast(array() as array<{_STONE}>), 'p2', cast(array() as array<{_STONE}>), 'nxt', 1L, 'out', cast(array() as array<{_PLACED}>)),
  (st, sh) -> aggregate(array(1, 2), st, (s, team) ->
    aggregate(array(named_struct('prev', if(team = 1, s.p1, s.p2), 'curr', if(team = 1, sh.t1, sh.t2))), s, (s0, b) ->
      aggregate(array({_GREEDY}), s0, (s1, m) ->
        aggregate(array({_NEW_STATE}), s1, (s2, n) -> named_struct(
          'p1', if(team = 1, n, s2.p1), 'p2', if(team = 2, n, s2.p2),
          'nxt', s2.nxt + size(n) - size(m),
          'out', concat(s2.out, transform(n, z -> named_struct('shot_number', sh.shot_number, 'team', team, 'slot', z.slot, 'x', z.x, 'y', z.y, 'stone_id', z.id, 'prev_x', z.px, 'prev_y', z.py, 'place', sh.place, 'before', sh.before, 'n_shots', sh.n_shots)))))))),
  st -> st.out)
"""


def ends_of(stones: DataFrame, boards: DataFrame) -> DataFrame:
    """A row for each end with its shots in order and each team's stones by slot.

    ``boards`` holds every shot, so boards without stones clear the state.
    Rows with a null key belong to no end.  The shuffle is by end; both
    groupings use it.
    """
    keyed = " and ".join(f"{k} is not null" for k in SHOT)
    rows = stones.select(*SHOT, "team", F.struct("slot", "x", "y").alias("s")).unionByName(boards.select(*SHOT), allowMissingColumns=True).where(keyed)
    rows = rows.repartition(*END)
    board = rows.groupBy(*SHOT).agg(*(F.array_sort(F.collect_list(F.when(F.col("team") == t, F.col("s")))).alias(f"t{t}") for t in (1, 2)))
    ends = board.groupBy(*END).agg(F.array_sort(F.collect_list(F.struct("shot_number", "t1", "t2"))).alias("shots"))
    order = "transform(shots, (s, i) -> struct(s.shot_number, s.t1, s.t2, i + 1 as place, get(shots, i - 1).shot_number as before, cast(size(shots) as bigint) as n_shots))"
    return ends.withColumn("shots", F.expr(order))


def track_greedy(stones: DataFrame, boards: DataFrame) -> DataFrame:
    """Identities by nearest free pairs under ``TRACK_DIST``."""
    return ends_of(stones, boards).select(*END, F.inline(F.expr(_FOLD)))


def _fullest(pairs: list[tuple[float, int, int]]) -> tuple[int, int]:
    """Of matchings among ``pairs`` the most pairs, and for those the least total, less than nothing, in steps of 2 ** -80.

    By dynamic programming over the subsets of columns, of which there are few:
    a team has eight stones.  Whole numbers have one sum in any order.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for d, i, j in pairs:
        rows.setdefault(i, []).append((j, int(d * 2**80)))
    best = {0: (0, 0)}
    for reach in rows.values():
        new = dict(best)
        for mask, (count, total) in best.items():
            for j, d in reach:
                if not mask >> j & 1:
                    to, at = (count + 1, total - d), mask | 1 << j
                    if at not in new or to > new[at]:
                        new[at] = to
        best = new
    return max(best.values())


def _places(total: int) -> int:
    """A total of ``_fullest`` to nine places."""
    return (total * -(10**9) + 2**79) // 2**80


def best_matching(cost: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Most pairs under ``limit``, and of those the least total distance.

    Totals count to nine places.  Of matchings as good the first one stays, by
    their pairs (distance, previous, current) in order.
    """
    if cost.shape[1] > MAX_STONES:
        raise ValueError(f"more than {MAX_STONES} stones of a team")
    pairs = sorted((float(cost[i, j]), int(i), int(j)) for i, j in np.argwhere(cost < limit))
    if len({i for _, i, _ in pairs}) == len(pairs) == len({j for _, _, j in pairs}):
        return [(i, j) for _, i, j in pairs]
    count, total = _fullest(pairs)
    least, out = _places(total), []
    taken = 0
    while len(out) < count:
        d, i, j = pairs.pop(0)
        rest = [q for q in pairs if q[1] != i and q[2] != j]
        n, more = _fullest(rest)
        if len(out) + 1 + n == count and _places(taken - int(d * 2**80) + more) == least:
            out.append((i, j))
            taken -= int(d * 2**80)
            pairs = rest
    return out


def _optimal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*END, "shot_number", "team", "slot", "x", "y", "stone_id", "prev_x", "prev_y", *ORDER]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int64()]
    for batch in batches:
        rows = []
        for end in batch.to_pylist():
            state, nxt = {1: [], 2: []}, 1
            for shot in end["shots"]:
                for team in (1, 2):
                    prev, curr = state[team], shot[f"t{team}"]
                    found = {}
                    if prev and curr:
                        p = np.array([(x, y) for _, x, y in prev])
                        c = np.array([(s["x"], s["y"]) for s in curr])
                        found = {j: i for i, j in best_matching(np.sqrt(((p[:, None] - c[None]) ** 2).sum(2)), TRACK_DIST)}
                    new = []
                    for j, s in enumerate(curr):
                        if j in found:
                            sid, px, py = prev[found[j]]
                        else:
                            sid, px, py = nxt, None, None
                            nxt += 1
                        new.append((sid, s["x"], s["y"]))
                        rows.append((*(end[k] for k in END), shot["shot_number"], team, s["slot"], s["x"], s["y"], sid, px, py, *(shot[k] for k in ORDER)))
                    state[team] = new
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def track_optimal(stones: DataFrame, boards: DataFrame) -> DataFrame:
    """Identities by the matching of most pairs and least total distance."""
    schema = "event_id bigint, match_id bigint, end_number int, shot_number int, team int, slot int, x double, y double, stone_id bigint, prev_x double, prev_y double, place int, before int, n_shots bigint"
    ends = ends_of(stones, boards)
    return ends.select(F.col("event_id").cast("bigint").alias("event_id"), F.col("match_id").cast("bigint").alias("match_id"), F.col("end_number").cast("int").alias("end_number"), "shots").mapInArrow(_optimal, schema)


METHODS = {"greedy": track_greedy, "optimal": track_optimal}


def flag_delivered(tracked: DataFrame) -> DataFrame:
    """``is_shot_stone``: 1 on the only new stone of a later shot, 0 on the others, null where it is not told."""
    new = F.count_if(F.col("prev_x").isNull()).over(Window.partitionBy(*SHOT))
    told = (F.col("shot_number") > 1) & (new == 1)
    return tracked.withColumn("is_shot_stone", F.when(told, F.col("prev_x").isNull().cast("double")))


def track(stones: DataFrame, boards: DataFrame, method: str = "greedy", order: bool = False) -> DataFrame:
    """Tracked stones with delivered flags; previous places are rounded to three decimals.

    With ``order`` they have their shot's place in the end, the shot before and
    the end's number of shots too, which metrics would else join.
    """
    if method not in METHODS:
        raise ValueError(f"unknown tracking method {method!r}; known: {sorted(METHODS)}")
    found = METHODS[method](stones, boards)
    if not order:
        found = found.drop(*ORDER)
    return flag_delivered(found.withColumns({c: F.round(c, 3) for c in ("prev_x", "prev_y")}))


def match_ghosts(ghosts: DataFrame, tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """The stone of the board before that each ghost of a later shot marks, or null.

    The nearest within ``GHOST_DIST``; of equally near ones the lowest slot.
    Several ghosts may mark one stone.
    """
    order = Window.partitionBy(*END).orderBy("shot_number")
    before = boards.select(*SHOT).distinct().withColumn("before", F.lag("shot_number").over(order))
    g = ghosts.where("x is not null and y is not null and shot_number > 1").join(before, SHOT)
    s = tracked.select(*END, F.col("shot_number").alias("before"), "team", F.col("slot").alias("s_slot"), F.col("x").alias("sx"), F.col("y").alias("sy"), "stone_id")
    d = F.sqrt((F.col("x") - F.col("sx")) * (F.col("x") - F.col("sx")) + (F.col("y") - F.col("sy")) * (F.col("y") - F.col("sy")))
    near = g.join(s, [*END, "before", "team"], "left").withColumn("d", d)
    return near.groupBy(*SHOT, "team", "slot").agg(F.min_by("stone_id", F.when(F.col("d") < GHOST_DIST, F.struct("d", "s_slot"))).alias("stone_id"))
