"""The tracker on small boards: matching, ties, counters, odd inputs; and the two methods against each other."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rinkflow.operators import metrics, tracking
from rinkflow.streaming.tracker import step

STONE = "event_id bigint, match_id bigint, end_number int, shot_number int, team int, slot int, x double, y double"
BOARD = "event_id bigint, match_id bigint, end_number int, shot_number int"
T = 0.13


A, B, C = [(-0.62, 1.14)], [(0.31, -0.27)], [(1.07, 2.36)]


def _moved(stone, by):
    """A stone moved along a slope."""
    (x, y), = stone
    return [(x + by * 0.6, y - by * 0.8)]


def _boards(spark, *ends):
    """Ends of shots; a shot is {team: [(x, y), ...]}."""
    stones, boards = [], []
    for e, shots in enumerate(ends, 1):
        for s, shot in enumerate(shots, 1):
            boards.append((1, 1, e, s))
            stones += [(1, 1, e, s, team, k, float(x), float(y)) for team, places in shot.items() for k, (x, y) in enumerate(places, 1)]
    return spark.createDataFrame(stones, STONE), spark.createDataFrame(boards, BOARD)


def _ids(spark, *ends, method="greedy"):
    rows = tracking.track(*_boards(spark, *ends), method).collect()
    return {(r.end_number, r.shot_number, r.team, r.slot): (r.stone_id, r.prev_x, r.is_shot_stone) for r in rows}


@pytest.mark.parametrize("method", ["greedy", "optimal"])
@pytest.mark.parametrize(
    ("shots", "want"),
    [
        ([{1: A + B}], {(1, 1): 1, (1, 2): 2}),
        ([{1: B}, {1: C + B}], {(2, 1): 2, (2, 2): 1}),  # the new stone takes the first slot
        ([{1: A + B + C}, {1: C}, {1: C + A}], {(2, 1): 3, (3, 1): 3, (3, 2): 4}),
        ([{1: A}, {1: _moved(A, T * 1.25)}], {(2, 1): 2}),
        ([{1: A}, {1: _moved(A, T * 0.75)}], {(2, 1): 1}),
        ([{1: A + _moved(A, 2 * T)}, {1: _moved(A, 1.9 * T) + _moved(A, 0.1 * T)}], {(2, 1): 2, (2, 2): 1}),
        ([{1: B}, {2: C}, {1: B}], {(3, 1): 3}),
    ],
)
def test_identities(spark, method, shots, want):
    got = _ids(spark, shots, method=method)
    assert {(s, k): got[1, s, 1, k][0] for s, k in want} == want


def test_teams_share_the_counter_and_ends_reset_it(spark):
    got = _ids(spark, [{1: A, 2: B}, {1: A + C, 2: B}], [{2: B}])
    assert got[1, 1, 1, 1][0] == 1 and got[1, 1, 2, 1][0] == 2 and got[1, 2, 1, 2][0] == 3 and got[2, 1, 2, 1][0] == 1


def test_delivered_flag(spark):
    got = _ids(spark, [{1: B}, {1: B, 2: C}, {1: B, 2: C}])
    assert got[1, 1, 1, 1][2] is None
    assert got[1, 2, 2, 1][2] == 1.0 and got[1, 2, 1, 1][2] == 0.0
    assert got[1, 3, 1, 1][2] is None


def test_greedy_is_not_optimal(spark):
    # the second stone lies nearest to the first new place, and only it reaches the second one
    shots = [{1: C + _moved(C, 0.8 * T)}, {1: _moved(C, 0.7 * T) + _moved(C, 1.5 * T)}]
    greedy, optimal = _ids(spark, shots), _ids(spark, shots, method="optimal")
    assert [greedy[1, 2, 1, k][0] for k in (1, 2)] == [2, 3]
    assert [optimal[1, 2, 1, k][0] for k in (1, 2)] == [1, 2]


def test_null_keys_and_empty_tables(spark):
    stones, boards = _boards(spark, [{1: [(0, 0)]}])
    stones = stones.unionByName(spark.createDataFrame([(None, 1, 1, 1, 1, 1, 0.0, 0.0)], STONE))
    assert tracking.track(stones, boards).count() == 1
    assert tracking.track(stones.limit(0), boards.limit(0)).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        tracking.track(stones, boards, "other")


def test_ghosts_take_the_nearest_stone_before(spark):
    stones, boards = _boards(spark, [{1: [(0.0, 0.0), (0.15, 0.0)]}, {1: [(0.15, 0.0)]}])
    ghosts = spark.createDataFrame([(1, 1, 1, 2, 1, 1, 0.01, 0.0), (1, 1, 1, 2, 1, 2, 2.0, 2.0), (1, 1, 1, 2, 1, 3, None, 0.0), (1, 1, 1, 1, 1, 1, 0.0, 0.0)], STONE)
    got = {r.slot: r.stone_id for r in tracking.match_ghosts(ghosts, tracking.track(stones, boards), boards).collect()}
    assert got == {1: 1, 2: None}


points = st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=5, unique=True)


@settings(max_examples=60, deadline=None)
@given(points, points)
def test_optimal_matching_is_exact(prev, curr):
    if not prev or not curr:
        return
    cost = np.array([[np.hypot(a[0] - c[0], a[1] - c[1]) / 100 for c in curr] for a in prev])
    got = tracking.best_matching(cost, T)
    best = (0, 0.0)
    n, m = cost.shape
    for size in range(1, min(n, m) + 1):
        for rows in itertools.combinations(range(n), size):
            for cols in itertools.permutations(range(m), size):
                d = [cost[i, j] for i, j in zip(rows, cols, strict=True)]
                if max(d) < T:
                    best = max(best, (size, -sum(d)))
    assert len(got) == best[0]
    assert sum(cost[i, j] for i, j in got) == pytest.approx(-best[1])
    # greedy pairs are one-to-one, and never more
    state = {"1": [(i + 1, x / 100, y / 100) for i, (x, y) in enumerate(prev)], "2": [], "next": len(prev) + 1}
    out = step(state, {1: [(k + 1, x / 100, y / 100) for k, (x, y) in enumerate(curr)]})
    ids = [o[4] for o in out]
    assert len(set(ids)) == len(ids)
    assert sum(i <= len(prev) for i in ids) <= best[0]


@pytest.mark.parametrize(("prev", "curr"), [
    ([(0, 0), (0, 0)], [(30, 40), (0, 50)]),  # stones on one spot, all pairs equally far
    ([(0, 0), (60, 0)], [(60, 80), (0, 80)]),
    ([(0, 0), (100, 0), (50, 0)], [(50, 0), (150, 0), (0, 0)]),
    ([(0, 0), (40, 0), (0, 40), (40, 40)], [(20, 20), (20, 20), (60, 20), (20, 60)]),
])
def test_ties_of_optimal_matchings_fall_to_the_first_pairs(prev, curr):
    cost = np.array([[np.hypot(a[0] - c[0], a[1] - c[1]) / 1000 for c in curr] for a in prev])
    pairs = sorted((cost[i, j], i, j) for i, j in np.ndindex(cost.shape) if cost[i, j] < T)
    found = [[]]  # as the SQL grows them
    for q in pairs:
        found += [[*m, q] for m in found if all(q[1] != z[1] and q[2] != z[2] for z in m)]
    want = min(found, key=lambda m: (-len(m), round(sum(z[0] for z in m), 9), m))
    assert sorted(tracking.best_matching(cost, T)) == sorted((i, j) for _, i, j in want)


def test_metrics_of_no_rows_are_null(spark):
    stones, boards = _boards(spark, [{1: [(0, 0)]}])
    t = tracking.track(stones, boards).limit(0)
    row = metrics.evaluate(t, boards.limit(0)).first()
    assert row.total_ends == 0 and row.spurious_id_rate is None
    verdict = {r.metric: r.verdict for r in metrics.verdicts(metrics.all_metrics(t, boards.limit(0))).collect()}
    assert set(verdict.values()) == {"-"}
    assert not metrics.passes(t)


def test_swap_is_counted(spark):
    stones, boards = _boards(spark, [{1: [(0.0, 0.0), (0.2, 0.0)]}, {1: [(0.2, 0.0), (0.0, 0.0)]}])
    assert metrics.slot_swaps(tracking.track(stones, boards), boards).first().swap_events == 1


def test_plans_hold_no_cartesian_product(spark, sf_dir):
    from rinkflow import catalog

    for name in ("track_greedy", "spatial_edges", "cap_pressure", "enrich_features", "ghost_match"):
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def _moved_rows(plan):
    """Exchanges of a plan, and joins."""
    lines = [x for x in plan.split("Initial Plan")[-1].splitlines()]
    return sum("Exchange hashpartitioning" in x for x in lines), sum("Join" in x for x in lines)


def test_boards_are_shuffled_once(spark, sf_dir):
    """Beyond what the views take, graphs of boards move stones once and join no pair."""
    from rinkflow import catalog

    v = catalog.Views(spark, sf_dir)

    def moves(df):
        return _moved_rows(df._jdf.queryExecution().executedPlan().toString())

    exchanges, joins = moves(v.known)
    assert moves(catalog.QUERIES["message_passing_mean"](spark, sf_dir)) == (exchanges + 1, joins)
    moved = [x for x in catalog._samples(v)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning" in x]
    assert not any("shot_number" in x or "end_number" in x for x in moved)
    assert "thrown" not in "".join(x for x in v.known._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x)


def test_means_of_neighbours_equal_the_joined_ones(spark, sf_dir):
    from rinkflow import catalog
    from rinkflow.operators import graph, learning

    v = catalog.Views(spark, sf_dir)
    gid = F.xxhash64(*graph.SHOT).alias("graph_id")
    node = graph.nodes(v.known)
    want = learning.neighbour_mean(graph.spatial_edges(node).select(gid, "*"), node.select(gid, "*"), ["x", "y"])
    got = graph.neighbour_means(v.known).select(gid, "node", "x", "y")
    rounded = [df.select("graph_id", "node", F.round("x", 9).alias("x"), F.round("y", 9).alias("y")) for df in (got, want)]
    assert rounded[0].count() == rounded[1].count() > 0
    assert rounded[0].exceptAll(rounded[1]).isEmpty()


def test_images_are_not_shuffled(spark, sf_dir):
    """Pixels are looked at where they are drawn: no exchange stands above the drawing."""
    from rinkflow import catalog

    for name in ("board_images", "move_images"):
        lines = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
        drawn = next(i for i, x in enumerate(lines) if "run(" in x)
        assert not any("Exchange" in x for x in lines[:drawn])


def test_images_painted_together_equal_those_painted_alone():
    from rinkflow.sources import images

    rng = np.random.default_rng(3)
    boards = [[(int(t), x, y, *((0.2, y) if k % 3 == 0 else (None, None))) for k, (t, x, y) in enumerate(zip(rng.integers(1, 3, n), rng.uniform(-1.6, 1.6, n), rng.uniform(-1.7, 4.7, n), strict=True))] for n in (0, 1, 8, 5)]
    sets = [([s[1:3] for s in b], [(x + 0.05, y) for _, x, y, *_ in b], [(i, i) for i in range(0, len(b), 2)]) for b in boards]
    empty = images.house(28)
    for paint, values in ((images.draw_boards, boards), (images.draw_moves, boards), (images.draw_matches, sets)):
        together = np.repeat(empty[None], len(values), axis=0)
        paint(together, values, 28)
        for image, value in zip(together, values, strict=True):
            alone = empty[None].copy()
            paint(alone, [value], 28)
            assert (image == alone[0]).all()
            assert (images.read_png(images.png(image)) == image).all()
    # a later stone lies above an earlier one
    top = images.draw([(1, 0.0, 0.0), (2, 0.0, 0.0)], 28)
    assert images.shows(top, images.STONE_COLOURS[2]) and not images.shows(top, images.STONE_COLOURS[1])


def test_compared_trackings_are_kept_as_columns(spark, monkeypatch):
    """No row of a tracking is checkpointed, only the one of the result; the folder goes."""
    import os

    from rinkflow import shared

    stones, boards = _boards(spark, [{1: A + B}, {1: _moved(A, T * 0.5) + B, 2: C}])
    cuts = []
    monkeypatch.setattr(shared, "cut", lambda df, f=shared.cut: cuts.append(df.count()) or f(df))
    monkeypatch.setattr(metrics, "cut", lambda df: pytest.fail("rows are checkpointed"))
    row = metrics.compare(tracking.track(stones, boards, order=True), tracking.track(stones, boards, "optimal"), boards).first()
    assert row.link_agreement_rate == 1.0 and row.spurious_id_rate_improvement == 0.0 and cuts == [1]
    assert not any(x.startswith("trackers-") for x in os.listdir(shared.shared_folder(spark)))


def test_inference_moves_no_stone_for_samples(spark, sf_dir):
    """Lines are dealt by order once; shots and stones then lie by order, so ends alone are moved to them."""
    from rinkflow import catalog

    df = catalog.QUERIES["model_inference"](spark, sf_dir)
    lines = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    dealt = [x for x in lines if "REPARTITION_BY_COL" in x]
    assert dealt and all("hashpartitioning(l_orderkey#" in x for x in dealt)
    moved = set(re.findall(r"hashpartitioning\((\w+)#", "\n".join(lines)))
    assert not moved & {"event_id", "end_number", "shot_number"}, moved
