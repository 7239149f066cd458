"""All queries over the driver's tables, and what they are in DuckDB's SQL.

A query is an operator over adapter views; its SQL holds the same views and
says the operator anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import END, SHOT, VERDICTS
from .functions import geometry, text
from .operators import detection, dims, features, graph, learning, metrics, reshape, tracking
from .plans.adapters import oracle, view
from .shared import new_folder, settled
from .sources import pages as page_source
from .sources import tables
from .streaming import tracker

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


class Views:
    """Views of a folder by attribute: ``v.stones`` is ``v_stones``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, f"v_{name}")


def query(sql: str | None = None, recursive: str = "", name: str | None = None):
    """Register a function of the views as a query, with its SQL."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[key] = oracle(sql, recursive)
        return f

    return add


def _stones(v: Views) -> DataFrame:
    return v.stones.drop("okey", "thrown")


KEYS = "event_id, match_id, end_number, shot_number"

# ---- features ---------------------------------------------------------------

_ENRICHED = """
select s.event_id, s.match_id, s.end_number, s.shot_number, s.team_code, e.team1_score_before, e.team2_score_before, e.hammer_team_code, e.team1_time_left, e.team2_time_left,
       coalesce(s.team_code = e.team1_code, false) as shooting_team_is_team1, coalesce(s.team_code = e.hammer_team_code, false) as shooting_team_has_hammer,
       e.team1_score_before - e.team2_score_before as score_diff_before
from v_shots s left join v_known_ends e on s.event_id = e.event_id and s.match_id = e.match_id and s.end_number = e.end_number"""
_ENRICHED_COLUMNS = [*SHOT, "team_code", "team1_score_before", "team2_score_before", "hammer_team_code", "team1_time_left", "team2_time_left", "shooting_team_is_team1", "shooting_team_has_hammer", "score_diff_before"]


@query(_ENRICHED)
def enrich_features(v):
    return features.enrich(v.shots, v.known_ends).select(*_ENRICHED_COLUMNS)


@query(f"""
select s.event_id, s.n_shots, s.shots_with_hammer, e.n_ends, e.n_with_hammer, e.hammer_won, e.hammer_stolen, e.blank
from (select event_id, count(*) as n_shots, count(*) filter (where shooting_team_has_hammer) as shots_with_hammer from ({_ENRICHED}) group by event_id) s
join (select event_id, count(*) as n_ends, count(margin) as n_with_hammer, count(*) filter (where margin > 0) as hammer_won, count(*) filter (where margin < 0) as hammer_stolen, count(*) filter (where margin = 0) as blank
      from (select event_id, case when hammer_team_code = team1_code then try_cast(team1_score_this_end as double) - try_cast(team2_score_this_end as double)
                                  when hammer_team_code = team2_code then try_cast(team2_score_this_end as double) - try_cast(team1_score_this_end as double) end as margin from v_known_ends) group by event_id) e
on s.event_id = e.event_id""")
def hammer_summary(v):
    return features.hammer_summary(v.shots, v.known_ends)


_FILTERED = """
select s.*, e.team1_code, e.team2_code, try_cast(e.team1_score_this_end as double) as team1_score_this_end, try_cast(e.team2_score_this_end as double) as team2_score_this_end
from v_counted s join v_known_ends e on s.event_id = e.event_id and s.match_id = e.match_id and s.end_number = e.end_number
where try_cast(e.team1_score_this_end as double) is not null and s.team1_stones_in_play + s.team2_stones_in_play > 0
  and not exists (select 1 from v_events x where x.event_id = s.event_id and x.gender = 'mxd')"""


@query(f"select {KEYS}, team_code, team1_code, team2_code, team1_score_this_end, team2_score_this_end from ({_FILTERED})")
def load_and_filter(v):
    return features.load_and_filter(v.counted, v.known_ends, v.events).select(*SHOT, "team_code", "team1_code", "team2_code", "team1_score_this_end", "team2_score_this_end")


# ---- reshaping and geometry -------------------------------------------------


@query(f"select {KEYS}, team, slot, x, y, dist, angle from v_stones where slot <= 8")
def wide_to_long(v):
    wide = reshape.long_to_wide(_stones(v), v.boards)
    return reshape.wide_to_long(wide)


@query(f"""select b.{KEYS.replace(', ', ', b.')}, coalesce(count(*) filter (where s.team = 1), 0) as team1_stones_in_play, coalesce(count(*) filter (where s.team = 2), 0) as team2_stones_in_play,
max(case when s.team = 1 and s.slot = 1 then s.x end) as team1_stone1_x, max(case when s.team = 2 and s.slot = 3 then s.dist end) as team2_stone3_dist
from v_boards b left join v_stones s on b.event_id = s.event_id and b.match_id = s.match_id and b.end_number = s.end_number and b.shot_number = s.shot_number group by all""")
def long_to_wide(v):
    return reshape.long_to_wide(_stones(v), v.boards).select(*SHOT, "team1_stones_in_play", "team2_stones_in_play", "team1_stone1_x", "team2_stone3_dist")


@query(f"select {KEYS}, team, x, y, dist, slot from v_stones")
def slot_ranking(v):
    return reshape.rank_slots(v.stones.drop("slot"), ties=("x", "y", "thrown")).select(*SHOT, "team", "x", "y", "dist", "slot")


@query("""select event_id, case when dist < 0.083 then 'button' when dist < 0.333 then '4-foot' when dist < 0.667 then '8-foot' when dist < 1.0 then '12-foot' else 'outside' end as ring, count(*) as n
from v_stones group by all""")
def ring_zones(v):
    return v.stones.groupBy("event_id", geometry.ring(F.col("dist")).alias("ring")).agg(F.count("*").alias("n"))


@query(f"select {KEYS}, team, slot, sqrt(x * x + y * y) as dist, round(degrees(atan2(y, x)), 6) as angle from v_stones")
def polar_places(v):
    d, a = geometry.polar(F.col("x"), F.col("y"))
    return v.stones.select(*SHOT, "team", "slot", d.alias("dist"), F.round(a, 6).alias("angle"))


@query(f"""select s.{KEYS.replace(', ', ', s.')}, team, slot, case when h.house_orientation = 'top' then 161 + x * 112 else 161 - x * 112 end as px, case when h.house_orientation = 'top' then 171 + y * 112 else 171 - y * 112 end as py
from v_stones s join v_shots h on s.okey = h.okey and s.shot_number = h.shot_number""")
def board_pixels(v):
    h = v.shots.select("okey", "shot_number", "house_orientation")
    s = v.stones.join(h, ["okey", "shot_number"])
    px, py = geometry.to_pixel(F.col("x"), F.col("y"), F.col("house_orientation"))
    return s.select(*SHOT, "team", "slot", px.alias("px"), py.alias("py"))


@query("select event_id, match_id, end_number, shot_number, shot_type, case when turn = '' and starts_with(shot_type, 'Through') then 'Not considered' else turn end as turn from v_shots")
def considered_turns(v):
    return v.shots.select(*SHOT, "shot_type", text.considered_turn(F.col("turn"), F.col("shot_type")).alias("turn"))


# ---- tracking ---------------------------------------------------------------

_STONE = "struct(slot integer, x double, y double, id bigint, px double, py double)[]"
_MATCHED = "struct(d double, i integer, j integer)[]"


def _match_sql(team: int, prev: str) -> str:
    return f"""list_reduce(list_prepend([]::{_MATCHED}, list_transform(list_sort(list_filter(flatten(list_transform({prev}, lambda p, i: list_transform(t{team}, lambda c, j:
      {{'d': sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)), 'i': cast(i as integer), 'j': cast(j as integer)}}))), lambda q: q.d < 0.13)), lambda q: [q])),
      lambda m, q: case when len(list_filter(m, lambda z: z.i = q[1].i or z.j = q[1].j)) > 0 then m else list_concat(m, q) end)"""


def _state_sql(team: int, prev: str, nxt: str) -> str:
    hit = f"list_filter(m{team}, lambda z: z.j = j)"
    return f"""list_transform(t{team}, lambda c, j: {{'slot': c.slot, 'x': c.x, 'y': c.y,
      'id': coalesce({prev}[{hit}[1].i].id, {nxt} + j - 1 - len(list_filter(m{team}, lambda z: z.j < j))), 'px': {prev}[{hit}[1].i].x, 'py': {prev}[{hit}[1].i].y}})"""


#: The tracker as a recursion over shots: matching by ordered pairs, team 1 first, one counter for both.
TRACKED_SQL = f"""
places as (
  select b.event_id, b.match_id, b.end_number, b.shot_number,
         coalesce(list({{'slot': s.slot, 'x': s.x, 'y': s.y}} order by s.slot) filter (where s.team = 1), []) as t1,
         coalesce(list({{'slot': s.slot, 'x': s.x, 'y': s.y}} order by s.slot) filter (where s.team = 2), []) as t2
  from v_boards b left join v_stones s on b.event_id = s.event_id and b.match_id = s.match_id and b.end_number = s.end_number and b.shot_number = s.shot_number
  group by all),
steps as (
  select event_id, match_id, end_number, 0 as shot_number, []::{_STONE} as p1, []::{_STONE} as p2, cast(1 as bigint) as nxt from places group by all
  union all
  select event_id, match_id, end_number, shot_number, n1, {_state_sql(2, 'p2', 'nxt1')} as n2, nxt1 + len(t2) - len(m2)
  from (select *, {_state_sql(1, 'p1', 'nxt')} as n1, nxt + len(t1) - len(m1) as nxt1
        from (select a.event_id, a.match_id, a.end_number, b.shot_number, a.p1, a.p2, a.nxt, b.t1, b.t2, {_match_sql(1, 'a.p1')} as m1, {_match_sql(2, 'a.p2')} as m2
              from steps a join places b on a.event_id = b.event_id and a.match_id = b.match_id and a.end_number = b.end_number and b.shot_number = a.shot_number + 1))),
tracked as materialized (
  select event_id, match_id, end_number, shot_number, cast(1 as integer) as team, u.slot, u.x, u.y, u.id as stone_id, u.px as prev_x, u.py as prev_y from (select *, unnest(p1) as u from steps where shot_number > 0)
  union all
  select event_id, match_id, end_number, shot_number, cast(2 as integer), u.slot, u.x, u.y, u.id, u.px, u.py from (select *, unnest(p2) as u from steps where shot_number > 0)),
flagged as materialized (
  select *, case when shot_number > 1 and count(*) filter (where prev_x is null) over (partition by {KEYS}) = 1 then cast(prev_x is null as double) end as is_shot_stone from tracked)
"""

_TRACKED_COLUMNS = f"{KEYS}, team, slot, x, y, stone_id, prev_x, prev_y, is_shot_stone"


def _tracked(v: Views) -> DataFrame:
    return tracking.track(_stones(v), v.boards, order=True)


@query(f"select {_TRACKED_COLUMNS} from flagged", TRACKED_SQL)
def track_greedy(v):
    return _tracked(v).select(*_TRACKED_COLUMNS.split(", "))


@query(f"""select g.{KEYS.replace(', ', ', g.')}, g.team, g.slot,
  (select t.stone_id from flagged t where t.event_id = g.event_id and t.match_id = g.match_id and t.end_number = g.end_number and t.shot_number = g.shot_number - 1 and t.team = g.team
     and sqrt((g.x - t.x) * (g.x - t.x) + (g.y - t.y) * (g.y - t.y)) < 0.20 order by sqrt((g.x - t.x) * (g.x - t.x) + (g.y - t.y) * (g.y - t.y)), t.slot limit 1) as stone_id
from v_ghosts g where g.x is not null and g.shot_number > 1""", TRACKED_SQL)
def ghost_match(v):
    return tracking.match_ghosts(v.ghosts, _tracked(v), v.boards)


# ---- metrics ----------------------------------------------------------------
# On tracked stones, and once more on stones whose identities the views know.

_ORDER = f"(select {KEYS}, row_number() over (partition by event_id, match_id, end_number order by shot_number) as place, lag(shot_number) over (partition by event_id, match_id, end_number order by shot_number) as before from v_boards)"
_PAIRED = f"""(select n.*, a.stone_id as before_id from (select t.*, o.before from {{t}} t join {_ORDER} o using ({KEYS}) where o.before is not null) n
  join {{t}} a on a.event_id = n.event_id and a.match_id = n.match_id and a.end_number = n.end_number and a.shot_number = n.before and a.team = n.team and a.slot = n.slot)"""
_NEW = f"(select o.{KEYS.replace(', ', ', o.')}, count(t.slot) as n_new from {_ORDER} o left join (select * from {{t}} where prev_x is null) t using ({KEYS}) where o.place > 1 group by all)"
_MOVED = "(select *, sqrt((x - prev_x) * (x - prev_x) + (y - prev_y) * (y - prev_y)) as d from {t} where prev_x is not null and prev_y is not null)"

METRIC_SQL = {
    "tracking_metrics": f"""
        select total_ends, total_stone_appearances, cast(new as double) / nullif(occupied, 0) as new_stone_rate_mid_end, cast(shots as double) / nullif(occupied, 0) as expected_new_rate,
               case when occupied > 0 then greatest(0.0::double, cast(new - shots as double) / occupied) end as spurious_id_rate
        from (select count(*) filter (where place = 1) as total_ends, cast(coalesce(sum(n), 0) as bigint) as total_stone_appearances, coalesce(sum(n) filter (where place > 1), 0) as occupied,
                     coalesce(sum(new) filter (where place > 1), 0) as new, count(*) filter (where place > 1) as shots
              from {_ORDER} o left join (select {KEYS}, count(x) as n, count(*) filter (where prev_x is null) as new from {{t}} group by all) c using ({KEYS}))""",
    "displacement_distribution": f"""
        select count(*) as total_links, count(*) filter (where d >= 0.8 * 0.13::double and d < 0.13) as threshold_zone_count, cast(count(*) filter (where d >= 0.8 * 0.13::double and d < 0.13) as double) / count(*) as threshold_zone_fraction,
               cast(count(*) filter (where d < 0.05) as double) / count(*) as near_zero_fraction, round(quantile_cont(d, 0.5), 9) as median_displacement, round(quantile_cont(d, 0.95), 9) as p95_displacement from {_MOVED}""",
    "id_continuity": f"select count(*) as total_slot_pairs, count(*) filter (where stone_id = before_id) as preserved, cast(count(*) filter (where stone_id = before_id) as double) / count(*) as id_continuity_rate from {_PAIRED} where is_shot_stone is null or is_shot_stone <> 1",
    "stone_continuity": f"""
        select count(*) as total_stones, count(h.hit) as kept, cast(count(h.hit) as double) / count(*) as stone_continuity_rate
        from (select distinct event_id, match_id, end_number, shot_number as before, stone_id from {{t}}) a join (select * from {_ORDER} where before is not null) o using (event_id, match_id, end_number, before)
        left join (select distinct {KEYS}, stone_id, 1 as hit from {{t}}) h using ({KEYS}, stone_id)""",
    "slot_swaps": f"""
        select total_shot_pairs, swap_events, cast(swap_events as double) / total_shot_pairs as slot_swap_rate
        from (select count(before) as total_shot_pairs from {_ORDER}) a,
             (select cast(coalesce(sum(len(list_filter(pairs, lambda p: len(list_filter(pairs, lambda q: p.s < q.s and p.i = q.b and q.i = p.b and p.i <> q.i)) > 0))), 0) as bigint) as swap_events
              from (select list({{'s': slot, 'i': stone_id, 'b': before_id}}) as pairs from {_PAIRED} group by {KEYS}, team)) b""",
    "cap_pressure": f"""
        select count(*) as total_new_id_events, count(*) filter (where d >= 0.13 and d < 0.13::double + 0.05) as cap_pressure_events, cast(count(*) filter (where d >= 0.13 and d < 0.13::double + 0.05) as double) / count(*) as cap_pressure_rate
        from (select n.{KEYS.replace(', ', ', n.')}, n.team, n.slot, min(sqrt((n.x - a.x) * (n.x - a.x) + (n.y - a.y) * (n.y - a.y))) as d
              from (select t.*, o.before from {{t}} t join {_ORDER} o using ({KEYS}) where o.before is not null and t.prev_x is null) n
              left join {{t}} a on a.event_id = n.event_id and a.match_id = n.match_id and a.end_number = n.end_number and a.shot_number = n.before and a.team = n.team group by all)""",
    "displacement_symmetry": f"""
        select *, shot_stone_median_displacement / nullif(still_stone_median_displacement, 0) as separation_ratio
        from (select count(*) filter (where is_shot_stone = 1) as shot_stone_links, count(*) filter (where is_shot_stone = 0) as still_stone_links, round(quantile_cont(d, 0.5) filter (where is_shot_stone = 1), 9) as shot_stone_median_displacement,
                     round(quantile_cont(d, 0.5) filter (where is_shot_stone = 0), 9) as still_stone_median_displacement, round(quantile_cont(d, 0.95) filter (where is_shot_stone = 0), 9) as still_stone_p95_displacement from {_MOVED})""",
    "delivery_anomaly": f"select count(*) as total_mid_shots, count(*) filter (where n_new <> 1) as anomaly_shots, cast(count(*) filter (where n_new <> 1) as double) / count(*) as delivery_anomaly_rate from {_NEW}",
    "delivery_anomaly_examples": f"select * from {_NEW} where n_new <> 1 order by {KEYS} limit 5",
    "fragmentation": f"""
        select event_id, match_id, end_number, team, ids_assigned, total_mid, new_mid, min_ids, n_shots, cast(ids_assigned as double) / nullif(min_ids, 0) as frag, cast(new_mid as double) / nullif(total_mid, 0) as new_rate,
               case when cast(ids_assigned as double) / min_ids <= 1.05 then '1.0 (perfect)' when cast(ids_assigned as double) / min_ids <= 1.5 then '1.01-1.5' when cast(ids_assigned as double) / min_ids <= 2.0 then '1.51-2.0' when cast(ids_assigned as double) / min_ids <= 3.0 then '2.01-3.0' else '>3.0' end as frag_bucket
        from (select event_id, match_id, end_number, team, count(distinct stone_id) as ids_assigned, count(*) filter (where o.place > 1) as total_mid, count(*) filter (where o.place > 1 and prev_x is null) as new_mid from {{t}} join {_ORDER} o using ({KEYS}) group by all)
        join (select event_id, match_id, end_number, team, max(n) as min_ids from (select {KEYS}, team, count(*) as n from {{t}} group by all) group by all) using (event_id, match_id, end_number, team)
        join (select event_id, match_id, end_number, count(*) as n_shots from v_boards group by all) using (event_id, match_id, end_number)""",
    "verify_first_shot": "select team, slot, count(*) as n_violations from {t} where shot_number = 1 and prev_x is not null group by all",
    "verify_coverage": """
        select *, case when present = 0 then 'SKIP' when coverage_pct < 50 then 'WARN' else 'PASS' end as verdict
        from (select count(prev_x) as linked, count(x) as present, cast(100 * count(prev_x) as double) / nullif(count(x), 0) as coverage_pct from {t} where shot_number > 1)""",
    "verify_id_uniqueness": "select event_id, match_id, end_number, stone_id, count(distinct team) as n_teams from {t} where stone_id is not null group by all having count(distinct team) > 1",
    "verify_id_gaps": f"select * from (select {KEYS}, team, stone_id, shot_number - lag(shot_number) over (partition by event_id, match_id, end_number, team, stone_id order by shot_number) as gap from (select distinct {KEYS}, team, stone_id from {{t}} where stone_id is not null)) where gap > 1",
    "verify_displacement": f"select team, slot, count(*) as n_suspicious, round(max(d), 9) as max_displacement from {_MOVED} where shot_number > 1 and d > 0.05 group by all",
    "verify_new_stones": f"select {KEYS}, team, count(*) as n_new from {{t}} where shot_number > 1 and prev_x is null group by all having count(*) > 1",
    "displacement_histogram": f"""
        select bin, low, high, n, repeat('#', cast(floor(cast(n * 30 as double) / greatest(max(n) over (), 1)) as integer)) as bar
        from (select b.bin, b.low, b.high, count(d.d) as n from (values (0, 0.0::double, 0.01::double), (1, 0.01, 0.02), (2, 0.02, 0.03), (3, 0.03, 0.05), (4, 0.05, 0.13), (5, 0.13, null)) b(bin, low, high)
              left join (select d from {_MOVED} where shot_number > 1) d on d.d >= b.low and (b.high is null or d.d < b.high) group by all)""",
    "displacement_stats": f"select count(*) as n, round(avg(d), 9) as mean, round(quantile_cont(d, 0.5), 9) as median, round(quantile_cont(d, 0.95), 9) as p95, round(max(d), 9) as max from {_MOVED} where shot_number > 1",
}

_ROUNDED = ("median_displacement", "p95_displacement", "shot_stone_median_displacement", "still_stone_median_displacement", "still_stone_p95_displacement", "max_displacement", "mean", "median", "p95", "max")


def _round(df: DataFrame) -> DataFrame:
    """Interpolated and averaged numbers to nine places, as in the SQL."""
    return df.withColumns({c: F.round(c, 9) for c in df.columns if c in _ROUNDED})


METRICS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "tracking_metrics": metrics.evaluate,
    "displacement_distribution": lambda t, b: _round(metrics.displacement_distribution(t)),
    "id_continuity": metrics.id_continuity,
    "stone_continuity": metrics.stone_continuity,
    "slot_swaps": metrics.slot_swaps,
    "cap_pressure": metrics.cap_pressure,
    "displacement_symmetry": lambda t, b: _round(metrics.displacement_symmetry(t).drop("separation_ratio")).withColumn("separation_ratio", F.try_divide("shot_stone_median_displacement", "still_stone_median_displacement")),
    "delivery_anomaly": metrics.delivery_anomaly,
    "delivery_anomaly_examples": metrics.delivery_anomaly_examples,
    "fragmentation": metrics.fragmentation,
    "verify_first_shot": lambda t, b: metrics.check_first_shot(t),
    "verify_coverage": lambda t, b: metrics.check_coverage(t),
    "verify_id_uniqueness": lambda t, b: metrics.check_id_uniqueness(t),
    "verify_id_gaps": lambda t, b: metrics.check_id_gaps(t),
    "verify_displacement": lambda t, b: _round(metrics.check_displacement(t)),
    "verify_new_stones": lambda t, b: metrics.check_new_stones(t),
    "displacement_histogram": lambda t, b: metrics.displacement_histogram(t),
    "displacement_stats": lambda t, b: _round(metrics.displacement_stats(t)),
}

for _name, _metric in METRICS.items():
    query(METRIC_SQL[_name].replace("{t}", "flagged"), TRACKED_SQL, name=_name)(lambda v, m=_metric: m(_tracked(v), v.boards))
    query(METRIC_SQL[_name].replace("{t}", "v_known"), name=f"{_name}_known")(lambda v, m=_metric: m(v.known, v.boards))


_COUNT_SQL = f"""
select count(*) as total_shot_pairs, count(*) filter (where jump) as inconsistent_pairs, count(distinct case when jump then concat(event_id, '/', match_id, '/', end_number) end) as inconsistent_ends, 1 - cast(count(*) filter (where jump) as double) / count(*) as stone_count_consistency_rate
from (select *, abs(n1 - lag(n1) over w) > 1 or abs(n2 - lag(n2) over w) > 1 as jump, lag(shot_number) over w as before
      from (select b.{KEYS.replace(', ', ', b.')}, count(*) filter (where s.team = 1) as n1, count(*) filter (where s.team = 2) as n2 from v_boards b left join v_stones s using ({KEYS}) group by all)
      window w as (partition by event_id, match_id, end_number order by shot_number)) where before is not null"""


@query(_COUNT_SQL)
def count_consistency(v):
    return metrics.count_consistency(_stones(v), v.boards)


_PARTS = ["tracking_metrics", "displacement_distribution", "id_continuity", "slot_swaps", "cap_pressure", "displacement_symmetry", "delivery_anomaly"]
_ALL = ", ".join(f"(select {'* exclude (total_shot_pairs)' if n == 'slot_swaps' else '*'} from ({METRIC_SQL[n].replace('{t}', 'flagged')}))" for n in _PARTS)
_ALL = f"(select * from {_ALL}, ({_COUNT_SQL}))"


@query(f"select * from {_ALL}", TRACKED_SQL)
def all_metrics(v):
    return _round(metrics.all_metrics(_tracked(v), v.boards))


_SIGN = {"max": "<=", "min": ">=", "below": "<"}


@query(f"with a as materialized {_ALL} " + " union all ".join(
    f"select '{n}' as metric, cast({n} as double) as value, {float(limit)}::double as threshold, case when {n} is null then '-' when {n} {_SIGN[kind]} {float(limit)} then 'OK' else 'WARN' end as verdict from a"
    for n, kind, limit in VERDICTS), TRACKED_SQL)
def metric_verdicts(v):
    return metrics.verdicts(_round(metrics.all_metrics(_tracked(v), v.boards)))


@query(f"""
with c as (
  select 'first_shot_invariant' as "check", count(*) as n, 'FAIL' as bad from v_known where shot_number = 1 and prev_x is not null union all
  select 'id_uniqueness', count(*), 'FAIL' from ({METRIC_SQL['verify_id_uniqueness'].replace('{t}', 'v_known')}) union all
  select 'id_continuity', count(*), 'WARN' from ({METRIC_SQL['verify_id_gaps'].replace('{t}', 'v_known')}) union all
  select 'matched_displacement', count(*), 'WARN' from {_MOVED.replace('{t}', 'v_known')} where shot_number > 1 and d > 0.05 union all
  select 'new_stone_count', count(*), 'WARN' from ({METRIC_SQL['verify_new_stones'].replace('{t}', 'v_known')})),
r as (select "check", n, case when n > 0 then bad else 'PASS' end as verdict from c union all select 'coverage', linked, verdict from ({METRIC_SQL['verify_coverage'].replace('{t}', 'v_known')}))
select * from r union all
select 'overall', count(*) filter (where verdict in ('FAIL', 'WARN')), case when count(*) filter (where verdict = 'FAIL') > 0 then 'FAIL' when count(*) filter (where verdict = 'WARN') > 0 then 'PASS WITH WARNINGS' else 'PASS' end from r""", name="run_checks_known")
def run_checks_known(v):
    return metrics.run_checks(v.known)


# ---- graphs -----------------------------------------------------------------

_NODES = f"""(select {KEYS}, stone_id, slot, cast(row_number() over (partition by {KEYS} order by stone_id is null, stone_id, team, slot) - 1 as integer) as node, x, y, dist,
  sin(radians(angle)) as angle_sin, cos(radians(angle)) as angle_cos, cast(team - 1 as double) as team, case when prev_x is null then 0.0::double else x - prev_x end as dx, case when prev_x is null then 0.0::double else y - prev_y end as dy,
  cast(prev_x is null as double) as is_new, coalesce(is_shot_stone, 0.5::double) as is_shot_stone from v_known)"""
_NODE_COLUMNS = [*SHOT, "node", "stone_id", "slot", "x", "y", "dist", "team", "dx", "dy", "is_new", "is_shot_stone"]


@query(f"select {', '.join(_NODE_COLUMNS)}, round(angle_sin, 9) as angle_sin, round(angle_cos, 9) as angle_cos from {_NODES}")
def board_state_nodes(v):
    return graph.nodes(v.known).select(*_NODE_COLUMNS, F.round("angle_sin", 9).alias("angle_sin"), F.round("angle_cos", 9).alias("angle_cos"))


_EDGES = f"""(select * from (select a.{KEYS.replace(', ', ', a.')}, a.node as src, b.node as dst, b.x - a.x as rel_x, b.y - a.y as rel_y, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) as dist
  from {_NODES} a join {_NODES} b using ({KEYS}) where a.node <> b.node) where dist < 2.0 and dist > 0)"""


@query(f"select * from {_EDGES}")
def spatial_edges(v):
    return graph.spatial_edges(graph.nodes(v.known))


@query(f"""select n.{KEYS.replace(', ', ', n.')}, a.src, n.node as dst from {_NODES} n join {_ORDER} o using ({KEYS})
join (select event_id, match_id, end_number, shot_number as before, stone_id, max(node) as src from {_NODES} where stone_id is not null group by all) a
  on a.event_id = n.event_id and a.match_id = n.match_id and a.end_number = n.end_number and a.before = o.before and a.stone_id = n.stone_id""")
def temporal_edges(v):
    return graph.temporal_edges(graph.nodes(v.known), v.boards)


@query(f"""select s.{KEYS.replace(', ', ', s.')}, cast(s.shot_number as double) / 16 as shot_number_norm, cast(s.end_number as double) / 10 as end_number_norm, cast(c.team1_stones_in_play as double) as n1, cast(c.team2_stones_in_play as double) as n2,
cast(s.shooting_team_has_hammer as double) as has_hammer, coalesce(cast(s.score_diff_before as double), 0.0) as score_diff, cast(s.shooting_team_is_team1 as double) as is_team1
from ({_ENRICHED}) s join v_counted c using ({KEYS})""")
def graph_features(v):
    return graph.graph_features(features.enrich(v.counted, v.known_ends))


@query(f"""select {KEYS}, case shot_type when 'Draw' then 0 when 'Guard' then 1 when 'Take-out' then 2 when 'Raise' then 3 when 'Hit and Roll' then 4 when 'Wick / Soft Peeling' then 5 else -1 end as shot_type_idx,
try_cast(accuracy as double) as accuracy, team1_score_this_end, team2_score_this_end from ({_FILTERED})""")
def labels(v):
    return graph.labels(features.load_and_filter(v.counted, v.known_ends, v.events))


_SPLIT = "case when e.year is null or e.year <= 2023 then 'train' when e.year = 2024 then 'val' else 'test' end"


@query(f"select s.{KEYS.replace(', ', ', s.')}, {_SPLIT} as split from v_shots s left join v_events e using (event_id)")
def split_assignment(v):
    return graph.assign_splits(v.shots.select(*SHOT), v.events)


@query(f"select {_SPLIT} as split, count(*) as n from v_shots s left join v_events e using (event_id) group by all")
def split_counts(v):
    return graph.split_counts(graph.assign_splits(v.shots, v.events))


def _numbers_sql(cells: list[str]) -> str:
    """Numbers as floats, to four places, in one text."""
    return "concat_ws(',', " + ", ".join(f"cast(round(cast(cast({c} as float) as double) * 10000) as bigint)" for c in cells) + ")"


def _numbers(row):
    return F.array_join(F.transform(row, lambda v: F.round(v.cast("double") * 10000).cast("bigint").cast("string")), ",")


_NODE_TEXT = _numbers_sql(["x", "y", "dist", "angle_sin", "angle_cos", "team", "dx", "dy", "is_new", "is_shot_stone"])


def _samples(v: Views) -> DataFrame:
    """Samples of the known stones: an end is an order, which shots and stones lie by, so only ends are moved to them."""
    end = ["okey", *END]
    shots = features.load_and_filter(features.enrich(v.counted, v.known_ends, end).drop("team1_code", "team2_code"), v.known_ends, v.events, end)
    return graph.samples(shots, v.known_by_order, v.events, end)


@query(f"""with kept as materialized (select f.*, lag(shot_number) over (partition by event_id, match_id, end_number order by shot_number) as before from ({_FILTERED}) f),
node as materialized (select * from {_NODES}),
board as (select {KEYS}, string_agg({_NODE_TEXT}, ';' order by node) as x, count(*) as n from node group by all),
edge as (select {KEYS}, string_agg(concat(src, '>', dst, ':', {_numbers_sql(["rel_x", "rel_y", "dist"])}), ';' order by src, dst) as e from {_EDGES} group by all),
link as (select k.{KEYS.replace(', ', ', k.')}, string_agg(concat(a.src, '>', b.node), ';' order by b.node) as e from kept k join node b using ({KEYS})
  join (select event_id, match_id, end_number, shot_number as before, stone_id, max(node) as src from node where stone_id is not null group by all) a
    on a.event_id = k.event_id and a.match_id = k.match_id and a.end_number = k.end_number and a.before = k.before and a.stone_id = b.stone_id group by all)
select k.{KEYS.replace(', ', ', k.')}, {_SPLIT} as split, coalesce(b.x, '') as x_t, coalesce(w.x, '') as x_prev, coalesce(e2.e, '') as edges_t, coalesce(l.e, '') as edges_temporal,
  {_numbers_sql(["cast(k.shot_number as double) / 16", "cast(k.end_number as double) / 10", "k.team1_stones_in_play", "k.team2_stones_in_play", "coalesce(k.team_code = q.hammer_team_code, false)", "coalesce(q.team1_score_before - q.team2_score_before, 0)", "coalesce(k.team_code = q.team1_code, false)"])} as u
from kept k left join v_events e using (event_id) left join board b using ({KEYS}) left join edge e2 using ({KEYS}) left join link l using ({KEYS})
left join board w on w.event_id = k.event_id and w.match_id = k.match_id and w.end_number = k.end_number and w.shot_number = k.before
left join v_known_ends q on q.event_id = k.event_id and q.match_id = k.match_id and q.end_number = k.end_number""")
def graph_samples(v):
    """Whole samples: nodes, edges of both kinds, the board before and the graph's features, as text."""
    s = _samples(v)

    def arrow(e):
        return F.concat(e.src.cast("string"), F.lit(">"), e.dst.cast("string"))

    return s.select(
        *SHOT, "split", *(F.array_join(F.transform(c, _numbers), ";").alias(c) for c in ("x_t", "x_prev")),
        F.array_join(F.transform("edges_t", lambda e: F.concat(arrow(e), F.lit(":"), _numbers(F.array(e.rel_x, e.rel_y, e.dist)))), ";").alias("edges_t"),
        F.array_join(F.transform("edges_temporal", arrow), ";").alias("edges_temporal"), _numbers(F.col("u")).alias("u"),
    )


# ---- pages and text ---------------------------------------------------------

@query("""select e.event_id, p.page_idx, e.end_number, e.team1_code, 'Team One' as team1_name, cast(e.team1_score_before as integer) as team1_score_before, e.team1_score_this_end, cast(e.team1_score_after as integer) as team1_score_after,
e.team2_code, 'Team Two' as team2_name, cast(e.team2_score_before as integer) as team2_score_before, e.team2_score_this_end, cast(e.team2_score_after as integer) as team2_score_after
from v_ends e join v_pages p on p.okey = e.okey where e.okey % 37 <> 0""")
def parse_end_line(v):
    return v.pages.select("event_id", "page_idx", text.parse_end_line(F.col("text")).alias("e")).where("e is not null").select("event_id", "page_idx", "e.*")


@query("select event_id, page_idx, regexp_extract(text, '(SAT [0-9]+ NOV [0-9]+) (Round [0-9]+)', 1) as date, regexp_extract(text, '(SAT [0-9]+ NOV [0-9]+) (Round [0-9]+)', 2) as round, regexp_extract(text, 'Start Time ([0-9:]+)', 1) as start_time from v_pages")
def parse_match_header(v):
    return v.pages.select("event_id", "page_idx", text.parse_match_header(F.col("text")).alias("h")).select("event_id", "page_idx", "h.*")


@query("""select event_id, page_idx, nullif(regexp_extract(text, 'Total Score (\\d+) (\\d+)', 1), '') as total1, nullif(regexp_extract(text, 'Total Score (\\d+) (\\d+)', 2), '') as total2,
regexp_extract(text, 'Time left (\\S+) (\\S+)', 1) as left1, regexp_extract(text, 'Time left (\\S+) (\\S+)', 2) as left2 from v_pages""")
def parse_score_box(v):
    box = v.pages.select("event_id", "page_idx", text.parse_score_box(F.col("text")).alias("b"))
    return box.select("event_id", "page_idx", F.col("b.total.team1").alias("total1"), F.col("b.total.team2").alias("total2"), F.col("b.time_left.team1").alias("left1"), F.col("b.time_left.team2").alias("left2"))


@query("select event_id, page_idx from v_pages where text like '%Game - Shot by Shot%'")
def shot_pages(v):
    return page_source.shot_pages(v.pages).select("event_id", "page_idx")


@query("select event_id, trim(regexp_extract(event_name, '^(.*) in (.*)$', 1)) as name, regexp_extract(event_name, '\\b(\\d{4})\\b', 1) as year, trim(regexp_extract(event_name, '^(.*) in (.*)$', 2)) as location from v_events")
def parse_tournament(v):
    return v.events.select("event_id", text.parse_tournament(F.col("event_name")).alias("t")).select("event_id", "t.*")


@query("""select event_id, case when lower(event_name) like '%mixed doubles%' then 'mxd' when lower(event_name) like '%women%' then 'w' when lower(event_name) like '%men%' then 'm' when gender = 'mxd' then 'mxd' when gender = 'mx' then 'mx' when gender = 'm' then 'm' else 'w' end as resolved from v_events""")
def resolve_gender(v):
    image = F.concat(F.lit("img/pdf_"), F.when(F.col("gender") == "mxd", "md").otherwise(F.col("gender")), F.lit(".png"))
    return v.events.select("event_id", text.resolve_gender(F.col("event_name"), image, F.col("event_name")).alias("resolved"))


@query("""select category, count(*) as n_events, count(distinct event_name) as n_names, case when count(year) > 0 then concat(min(year), '-', max(year)) else 'N/A' end as years
from (select *, case when event_name like '%Mixed Doubles%' then 'Mixed Doubles' when event_name like '%Junior-B%' then 'Junior-B' when event_name like '%Olympic%' then 'Olympic' when event_name like '%B-Division%' then 'B/C Division' else 'Other' end as category from v_events) group by category""")
def event_category_profile(v):
    return dims.category_profile(v.events, text.event_category(F.col("event_name")))


@query("select page_id, len(regexp_extract_all(html, '<a [^>]*href=')) as n_links from pages")
def html_link_counts(v):
    p = v.spark.read.parquet(f"{v.sf_dir}/pages.parquet")
    n = page_source.links(p).groupBy("page_id").agg(F.count("*").alias("n"))
    return p.select("page_id").join(n, "page_id", "left").select("page_id", F.coalesce("n", F.lit(0)).alias("n_links"))


@query("""select page_id, cast(i - 1 as integer) as pos, hrefs[i] as href, case when regexp_matches(hrefs[i], '^https?://') then hrefs[i] else concat('https://curlit.com/', hrefs[i]) end as url
from (select page_id, hrefs, unnest(range(1, len(hrefs) + 1)) as i from (select page_id, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) as hrefs from pages))""")
def html_links(v):
    return page_source.links(v.spark.read.parquet(f"{v.sf_dir}/pages.parquet")).select("page_id", "pos", "href", "url")


def _books(v: Views) -> tuple[DataFrame, DataFrame]:
    e = v.events.select(F.lit(0).cast("long").alias("page_id"), F.col("event_id").alias("row_no"), "gender", "event_id")
    book = e.select("page_id", "row_no", "gender", F.concat(F.lit("b"), "event_id").alias("url"))
    summary = e.where("event_id % 3 <> 0").select("page_id", "row_no", "gender", F.explode(F.sequence(F.lit(0), F.col("event_id") % 2)).alias("pos")).select("*", F.concat(F.lit("s"), "row_no", F.lit("-"), "pos").alias("url"))
    return book, summary


@query("select cast(0 as bigint) as page_id, event_id as row_no, gender, concat('b', event_id) as url, case when event_id % 3 = 0 then '' else concat('s', event_id, '-', event_id % 2) end as result_summary_url from v_events")
def pair_summaries(v):
    return page_source.pair_summaries(*_books(v))


@query("select event_id, cast(year as string) as year from v_events where year >= 2018 and event_id % 4 <> 0")
def book_list(v):
    urls = v.events.select("event_id", F.col("year").cast("string").alias("year"), F.when(F.col("event_id") % 4 != 0, "x").otherwise(F.lit("")).alias("result_book_url"))
    return tables.books(urls, 2018).select("event_id", "year")


# ---- dimensions and quality -------------------------------------------------


def _page_heads(v: Views) -> DataFrame:
    p = v.pages.select("event_id", "page_idx", text.parse_match_header(F.col("text")).alias("h"), text.parse_end_line(F.col("text")).alias("e"))
    return p.select("event_id", "page_idx", "h.date", "h.round", "e.team1_code", "e.team2_code", "e.end_number")


@query("""select event_id, page_idx, sum(new) over (partition by event_id order by page_idx rows unbounded preceding) as match_no
from (select *, case when lag(k) over w is null or k <> lag(k) over w or n = 1 then 1 else 0 end as new
      from (select p.event_id, p.page_idx, concat(1 + p.match_id % 28, '|', 2013 + p.match_id % 12, '|', p.match_id % 9, '|', case when p.okey % 37 = 0 then '|' else concat(e.team1_code, '|', e.team2_code) end) as k, case when p.okey % 37 = 0 then 1 else p.end_number end as n from v_pages p join v_ends e on p.okey = e.okey)
      window w as (partition by event_id order by page_idx))""")
def match_segmentation(v):
    return dims.segment_matches(_page_heads(v)).select("event_id", "page_idx", "match_no")


@query("select e.event_id, coalesce(t.has_time_data, false) as has_time_data from v_events e left join (select event_id, bool_or(team1_time_left <> '' or team2_time_left <> '') as has_time_data from v_known_ends group by event_id) t using (event_id)")
def has_time_data(v):
    return dims.has_time_data(v.events, v.known_ends).select("event_id", "has_time_data")


@query("""select event_id, match_id, end_number, first(house_orientation order by n desc, f) as orientation, cast(sum(n) - max(n) as bigint) as n_disagree
from (select event_id, match_id, end_number, house_orientation, count(*) as n, min(shot_number) as f from v_shots group by all) group by all""")
def orientation_majority(v):
    return dims.majority_orientation(v.shots)


@query("""select event_id, team_code, case when event_id % 6 = 0 then null else concat('Team ', first_end) end as team_name, r[1] as player1_name, r[2] as player2_name, r[3] as player3_name, r[4] as player4_name, r[5] as player5_name, cast(len(r) as integer) as n_players
from (select event_id, team_code, list_sort(list(distinct player_name)) as r, min(end_number) as first_end from v_shots group by all)""")
def rosters(v):
    s = v.shots
    names = s.select("event_id", "team_code", F.when(F.col("event_id") % 6 != 0, F.concat(F.lit("Team "), "end_number")).otherwise(F.lit("")).alias("team_name"), F.col("end_number").alias("seen_at"))
    return dims.rosters(s, names).drop("roster")


@query("select row_number() over (order by event_id, f, team_code, player_name) as player_id, event_id, team_code, player_name from (select event_id, team_code, player_name, min((match_id, end_number, shot_number)) as f from v_shots group by event_id, team_code, player_name)")
def player_ids(v):
    return dims.player_ids(v.shots)


@query("""select event_id, match_id, cast(case when match_id % 4 = 0 then match_id % 10 else a1 end as bigint) as team1_final_score, cast(case when match_id % 4 = 0 then match_id % 7 else a2 end as bigint) as team2_final_score
from (select event_id, match_id, arg_max(team1_score_after, end_number) as a1, arg_max(team2_score_after, end_number) as a2 from v_ends group by all)""")
def final_scores(v):
    box = v.matches.where("match_id % 4 < 2").select("event_id", "match_id", *(F.when(F.col("match_id") % 4 == 0, (F.col("match_id") % k).cast("string")).otherwise(F.lit("")).alias(f"team{t}_box") for t, k in ((1, 10), (2, 7))))
    return dims.final_scores(v.ends, box)


@query("""with e as (select *, end_number - lag(end_number) over w as gap, lag(hammer_team_code) over w as lh, lag(p1) over w as l1, lag(p2) over w as l2
  from (select *, try_cast(team1_score_this_end as bigint) as p1, try_cast(team2_score_this_end as bigint) as p2 from v_known_ends) window w as (partition by event_id, match_id order by end_number)),
d as (select *, case when l1 > l2 then team2_code when l1 < l2 then team1_code else lh end as due, p1 is not null and p2 is not null as played from e),
k as (select *, played and l1 is not null and l2 is not null and hammer_team_code <> '' and coalesce(due, '') <> '' as known from d),
s as (select *, shot_number - lag(shot_number) over (partition by event_id, match_id, end_number order by shot_number) as gap, try_cast(accuracy as double) as a from v_shots)
select 'score_sum' as rule, count(*) filter (where played) as checked, count(*) filter (where played and (team1_score_before + p1 <> team1_score_after or team2_score_before + p2 <> team2_score_after)) as broken from k union all
select 'both_score', count(*) filter (where played), count(*) filter (where played and p1 > 0 and p2 > 0) from k union all
select 'end_gap', count(gap), count(*) filter (where gap <> 1) from k union all
select 'hammer', count(*) filter (where known), count(*) filter (where known and hammer_team_code <> due) from k union all
select 'shot_gap', count(gap), count(*) filter (where gap > 1) from s union all
select 'duplicate_shot', count(*), count(*) filter (where gap = 0) from s union all
select 'accuracy_range', count(a), count(*) filter (where a < 0 or a > 100) from s""")
def dq_rules(v):
    return dims.quality_rules(v.known_ends, v.shots)


@query("""select event_id, radius, abs(radius - 112) / 112 as deviation, coalesce(n, 0) as n_suspect, case when abs(radius - 112) / 112 > 0.1 then 'radius_deviation' when coalesce(n, 0) > 0 then 'suspect_stones' else 'ok' end as status
from (select event_id, quantile_cont(radius, 0.5) as radius from v_house group by event_id) left join (select event_id, count(*) filter (where dist > 1.5) as n from v_stones where shot_number = 1 group by event_id) using (event_id)""")
def calibration_status(v):
    return dims.calibration_status(v.house, v.stones)


# ---- detection --------------------------------------------------------------

_BLOBS = """(select event_id, match_id, end_number, shot_number, colour, case when orientation = 'top' then (sx - cx) / radius else (cx - sx) / radius end as x, case when orientation = 'top' then (sy - cy) / radius else (cy - sy) / radius end as y, colored_px / area < 0.45 as is_ghost
from v_blobs join v_house using (event_id, match_id, end_number, shot_number) where area > 80 * ((radius / 112) * (radius / 112)) and area < 600 * ((radius / 112) * (radius / 112)))"""


@query(f"select {KEYS}, colour, x, y, sqrt(x * x + y * y) as dist, is_ghost from {_BLOBS}")
def blob_classify(v):
    return detection.classify_blobs(v.blobs, v.house).drop("angle")


@query(f"""select {KEYS}, colour, cast(i as integer) as slot, k[i].x as x, k[i].y as y, k[i].dist as dist from (select *, unnest(range(1, len(k) + 1)) as i from (
select {KEYS}, colour, list_reduce(list_prepend([]::struct(dist double, x double, y double)[], list_transform(list_sort(list({{'dist': sqrt(x * x + y * y), 'x': x, 'y': y}})), lambda s: [s])),
  lambda a, s: case when len(list_filter(a, lambda z: sqrt((s[1].x - z.x) * (s[1].x - z.x) + (s[1].y - z.y) * (s[1].y - z.y)) < 0.08)) > 0 then a else list_concat(a, s) end) as k
from {_BLOBS} where not is_ghost group by {KEYS}, colour))""")
def blob_dedup(v):
    return detection.deduplicate(detection.classify_blobs(v.blobs, v.house).where("not is_ghost")).drop("angle")


_SETS = f"""(select {KEYS}, colour, is_ghost, coalesce(list({{'dist': dist, 'x': x, 'y': y}} order by dist, x, y) filter (where g), []) as gt, coalesce(list({{'dist': dist, 'x': x, 'y': y}} order by dist, x, y) filter (where not g), []) as det
from (select {KEYS}, colour, is_ghost, dist, x, y, true as g from v_truth union all select {KEYS}, colour, is_ghost, dist, x, y, false from v_detected) group by all)"""
_MATCH = f"""(select *, list_reduce(list_prepend([]::{_MATCHED}, list_transform(list_sort(list_filter(flatten(list_transform(gt, lambda p, i: list_transform(det, lambda c, j:
  {{'d': sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)), 'i': cast(i as integer), 'j': cast(j as integer)}}))), lambda q: q.d < 0.08)), lambda q: [q])),
  lambda m, q: case when len(list_filter(m, lambda z: z.i = q[1].i or z.j = q[1].j)) > 0 then m else list_concat(m, q) end) as pairs from {_SETS})"""
_COUNTED = f"(select {KEYS}, colour, is_ghost, cast(len(gt) as bigint) as n_gt, cast(len(det) as bigint) as n_det, cast(len(pairs) as bigint) as tp, cast(len(det) - len(pairs) as bigint) as fp, cast(len(gt) - len(pairs) as bigint) as fn, pairs from {_MATCH})"


@query(f"select {KEYS}, colour, is_ghost, n_gt, n_det, tp, fp, fn from {_COUNTED}")
def detection_match(v):
    return detection.match_sets(v.truth, v.detected, [*SHOT, "colour", "is_ghost"]).drop("pairs")


def _sum_sql(c: str, where: str) -> str:
    return f"cast(coalesce(sum({c}) filter (where {where}), 0) as bigint)"


_RECORDS = f"""(select {KEYS}, {', '.join(f"{_sum_sql(c, f'not is_ghost and colour = {chr(39)}{k}{chr(39)}')} as {s}_{k}, {_sum_sql(c, f'is_ghost and colour = {chr(39)}{k}{chr(39)}')} as {s}_ghost_{k}" for s, c in (('gt', 'n_gt'), ('det', 'n_det')) for k in ('red', 'yellow'))},
  {', '.join(f"{_sum_sql(c, 'not is_ghost')} as {c}, {_sum_sql(c, 'is_ghost')} as {c}_ghost" for c in ('tp', 'fp', 'fn'))}, list_filter(flatten(list(list_transform(case when is_ghost then [] else pairs end, lambda p: p.d))), lambda d: d is not null) as errors from {_COUNTED} group by {KEYS})"""
_RECORDS_FULL = f"(select r.*, e.pos_err_median, e.pos_err_p95 from {_RECORDS} r left join (select {KEYS}, quantile_cont(d, 0.5) as pos_err_median, quantile_cont(d, 0.95) as pos_err_p95 from (select {KEYS}, unnest(errors) as d from {_RECORDS}) group by all) e using ({KEYS}))"


@query(f"select * exclude (errors, pos_err_median, pos_err_p95), round(pos_err_median, 9) as pos_err_median, round(pos_err_p95, 9) as pos_err_p95 from {_RECORDS_FULL}")
def detection_records(v):
    r = detection.crop_records(v.truth, v.detected)
    return r.withColumns({c: F.round(c, 9) for c in ("pos_err_median", "pos_err_p95")})


@query(f"""select * exclude (p, r), 100 * p as precision, 100 * r as recall, case when p + r > 0 then 200 * p * r / (p + r) else 0.0 end as f1 from (
select event_id, count(*) as shots_evaluated, cast(sum(gt_red + gt_yellow) as bigint) as total_gt_stones, cast(sum(det_red + det_yellow) as bigint) as total_det_stones, {', '.join(f'cast(sum({c}) as bigint) as total_{c}' for c in ('tp', 'fp', 'fn', 'tp_ghost', 'fp_ghost', 'fn_ghost'))},
count(*) filter (where fp > 0) as shots_with_fp, count(*) filter (where fn > 0) as shots_with_fn, round(quantile_cont(pos_err_median, 0.5), 9) as pos_err_median_norm, round(quantile_cont(pos_err_median, 0.95), 9) as pos_err_p95_norm,
cast(sum(tp_ghost) as double) / greatest(sum(tp_ghost) + sum(fp_ghost), 1) * 100 as ghost_precision, cast(sum(tp_ghost) as double) / greatest(sum(tp_ghost) + sum(fn_ghost), 1) * 100 as ghost_recall,
cast(sum(tp) as double) / greatest(sum(tp) + sum(fp), 1) as p, cast(sum(tp) as double) / greatest(sum(tp) + sum(fn), 1) as r from {_RECORDS_FULL} group by event_id)""")
def detection_aggregate(v):
    out = detection.aggregate_records(detection.crop_records(v.truth, v.detected), ["event_id"])
    out = out.withColumns({c: F.round(c, 9) for c in ("pos_err_median_norm", "pos_err_p95_norm")})
    return out


@query("select round(avg(f1), 9) as avg_f1, round(avg(f1 * 0.99), 9) as avg_precision, round(avg(f1 * 1.01), 9) as avg_recall from v_results")
def macro_average(v):
    r = v.results.withColumns({"precision": F.col("f1") * 0.99, "recall": F.col("f1") * 1.01})
    return detection.macro_average(r).select(*(F.round(c, 9).alias(c) for c in ("avg_f1", "avg_precision", "avg_recall")))


@query("""with j as (select c.*, b.f1 as bf, b.ghost_recall as bg, b.filename is not null as known from v_results c left join v_baseline b using (filename))
select filename, 'WARN' as kind, 'min_f1' as rule, f1 as value from j where f1 < 97 union all
select filename, 'WARN', 'min_ghost_recall', ghost_recall from j where ghost_recall < 85 union all
select filename, 'WARN', 'max_pos_err_p95_norm', pos_err_p95_norm from j where pos_err_p95_norm > 0.05 union all
select filename, 'INFO', 'new_file', null from j where not known union all
select filename, 'REGRESSION', 'max_f1_regression', bf - f1 from j where bf - f1 > 2 union all
select filename, 'REGRESSION', 'max_ghost_recall_regression', bg - ghost_recall from j where bg - ghost_recall > 5""")
def regression_check(v):
    return detection.regressions(v.results, v.baseline)


@query("select filename, coalesce(c.f1, b.f1) as f1, coalesce(c.ghost_recall, b.ghost_recall) as ghost_recall, coalesce(c.pos_err_p95_norm, b.pos_err_p95_norm) as pos_err_p95_norm, coalesce(c.ends_evaluated, b.ends_evaluated) as ends_evaluated from v_results c full join v_baseline b using (filename)")
def baseline_merge(v):
    return detection.merge_baseline(v.results, v.baseline)


# ---- learning ---------------------------------------------------------------


def _predictions(v: Views) -> DataFrame:
    return v.predictions.withColumn("logits", F.array("z0", "z1", "z2"))


_LOSSES = """(select batch, count(*) as n, coalesce(avg((accuracy - y_accuracy) * (accuracy - y_accuracy)), 0) as la, coalesce(avg(case when y_score1 is not null and y_score2 is not null then ((score1 - y_score1) * (score1 - y_score1) + (score2 - y_score2) * (score2 - y_score2)) / 2 end), 0) as ls,
coalesce(avg(case when y_type >= 0 then ln(exp(z0) + exp(z1) + exp(z2)) - case y_type when 0 then z0 when 1 then z1 else z2 end end), 0) as lt from v_predictions group by batch)"""


@query(f"select batch, n, round(la, 6) as loss_accuracy, round(ls, 6) as loss_end_score, round(lt, 6) as loss_shot_type, round(0.5 * la + 0.5 * ls + lt, 6) as total from {_LOSSES}")
def masked_losses(v):
    out = learning.weighted_total(learning.losses(_predictions(v), ["batch"]))
    return out.select("batch", "n", *(F.round(c, 6).alias(c) for c in ("loss_accuracy", "loss_end_score", "loss_shot_type", "total")))


@query(f"""select * from (select round(sum(la * n) / sum(n), 6) as loss_accuracy, round(sum(ls * n) / sum(n), 6) as loss_end_score, round(sum(lt * n) / sum(n), 6) as loss_shot_type from {_LOSSES}) a,
(select round(avg(abs(accuracy - y_accuracy)), 6) as mae_accuracy, round(avg((abs(score1 - y_score1) + abs(score2 - y_score2)) / 2), 6) as mae_end_score,
 round(avg(case when y_type >= 0 then cast(case when z0 >= z1 and z0 >= z2 then 0 when z1 >= z2 then 1 else 2 end = y_type as double) end), 6) as acc_shot_type from v_predictions) b""")
def eval_metrics(v):
    out = learning.evaluate(_predictions(v))
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


_GRAPH = "(select event_id * 1000000000000 + match_id * 10000 + end_number * 100 + shot_number as graph_id, * from {})"


def _graph_id():
    return F.expr("event_id * 1000000000000 + match_id * 10000 + end_number * 100 + shot_number").alias("graph_id")


@query(f"""select n.graph_id, n.node, round(coalesce(avg(s.x), 0.0), 9) as x, round(coalesce(avg(s.y), 0.0), 9) as y from {_GRAPH.format(_NODES)} n left join {_GRAPH.format(_EDGES)} e on e.graph_id = n.graph_id and e.dst = n.node
left join {_GRAPH.format(_NODES)} s on s.graph_id = e.graph_id and s.node = e.src group by all""")
def message_passing_mean(v):
    return graph.neighbour_means(v.known).select(_graph_id(), "node", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query(f"""select b.graph_id, round(coalesce(avg(n.x), 0.0), 9) as x, round(coalesce(avg(n.dist), 0.0), 9) as dist, count(n.x) > 0 as has_nodes from {_GRAPH.format('v_boards')} b left join {_GRAPH.format(_NODES)} n using (graph_id) group by all""")
def mean_pool(v):
    return learning.mean_pool(v.boards.select(_graph_id()), graph.nodes(v.known).select(_graph_id(), "*"), ["x", "dist"]).select("graph_id", F.round("x", 9).alias("x"), F.round("dist", 9).alias("dist"), "has_nodes")


@query("""select graph_id, n_nodes, cast(batch as bigint) as batch, cast(coalesce(sum(n_nodes) over (partition by batch order by i rows between unbounded preceding and 1 preceding), 0) as bigint) as node_offset
from (select graph_id, n_nodes, i, floor(i / 32) as batch from (select okey * 100 + shot_number as graph_id, team1_stones_in_play + team2_stones_in_play as n_nodes, row_number() over (order by okey * 100 + shot_number) - 1 as i from v_counted))""")
def collate_offsets(v):
    g = v.counted.select((F.col("okey") * 100 + F.col("shot_number")).alias("graph_id"), (F.col("team1_stones_in_play") + F.col("team2_stones_in_play")).alias("n_nodes"))
    return learning.collate(g, 32)


@query()
def model_inference(v):
    s = _samples(v)
    w = graph.Window.partitionBy("okey", *END).orderBy("shot_number")
    s = s.withColumn("edges_prev", F.lag("edges_t").over(w))
    return learning.predict(s, learning.random_weights(hidden=16, embed=16, heads=16, layers=2))


# ---- profiles and sets ------------------------------------------------------


@query("select m.event_id, count(*) as n_matches, count(e.match_id) as n_with_ends from v_matches m left join (select distinct match_id from v_known_ends) e using (match_id) group by all")
def matches_with_ends(v):
    have = v.known_ends.select("match_id", F.lit(True).alias("has")).distinct()
    return v.matches.join(have, "match_id", "left").groupBy("event_id").agg(F.count("*").alias("n_matches"), F.count("has").alias("n_with_ends"))


@query("select event_id, match_id from v_matches m where not exists (select 1 from v_known_ends e where e.match_id = m.match_id)")
def matches_without_ends(v):
    return v.matches.join(v.known_ends, "match_id", "left_anti").select("event_id", "match_id")


@query("select distinct least(team1_code, team2_code) as a, greatest(team1_code, team2_code) as b from v_ends intersect select distinct least(team2_code, team1_code), greatest(team2_code, team1_code) from v_matches")
def team_pairs(v):
    def pair(df):
        return df.select(F.least("team1_code", "team2_code").alias("a"), F.greatest("team1_code", "team2_code").alias("b"))

    return pair(v.ends).intersect(pair(v.matches))


@query("""select e.year, count(*) as n_ends, count(*) filter (where k.team1_time_left <> '') as with_time, cast(count(*) filter (where k.team1_time_left <> '') as double) / count(*) as share
from v_known_ends k join v_events e using (event_id) group by all""")
def time_coverage(v):
    timed = F.count_if(F.col("team1_time_left") != "")
    return v.known_ends.join(v.events, "event_id").groupBy("year").agg(F.count("*").alias("n_ends"), timed.alias("with_time"), (timed / F.count("*")).alias("share"))


@query("select shot_type, count(*) as n, count(*) filter (where turn = '') as without_turn from v_shots group by all")
def null_turn_profile(v):
    return v.shots.groupBy("shot_type").agg(F.count("*").alias("n"), F.count_if(F.col("turn") == "").alias("without_turn"))


# ---- streams ----------------------------------------------------------------


def _board_rows(v: Views) -> DataFrame:
    return v.boards.join(_stones(v).select(*SHOT, "team", "slot", "x", "y"), SHOT, "left")


@query(f"select {KEYS}, team, slot, x, y, stone_id, prev_x, prev_y from tracked", TRACKED_SQL)
def stream_tracker(v):
    """The tracker as a stream of files, run until all are read."""
    base = new_folder(v.spark, "stream")
    rows = _board_rows(v)
    rows.repartition(4, *END).write.parquet(f"{base}/in")
    stream = v.spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    done = tracker.track_stream(stream).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    done.awaitTermination()
    return settled(v.spark.read.schema(tracker.TRACKED).parquet(f"{base}/out"), base)


@query("select event_id, count(*) as n_shots from v_shots group by all")
def incremental_ingest(v):
    """Shots written as files and taken in by a resumable stream."""
    base = new_folder(v.spark, "ingest")
    rows = v.shots.select(*SHOT, "team_code", "shot_type")
    rows.repartition(6).write.parquet(f"{base}/in")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    got = tracker.ingest(v.spark, f"{base}/in", schema, f"{base}/out", f"{base}/state", files_per_batch=2)
    return settled(got.groupBy("event_id").agg(F.count("*").alias("n_shots")), base)


from . import catalog_io  # noqa: E402, F401  (registers its queries)
