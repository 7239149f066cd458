"""Views in the domain's shape over the driver's tables.

The text is SQL that Spark and DuckDB read alike; ``{name}`` stands for a table.
Numbers come from integers divided by powers of ten, so both engines hold the
same doubles.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_events": """
        select cast(n_nationkey + 1 as bigint) as event_id,
               concat(case n_nationkey % 5 when 0 then 'World Mixed Doubles Championship ' when 1 then 'Junior-B Championships ' when 2 then 'Olympic Qualification ' when 3 then 'European Championships B-Division ' else 'Continental ' end, cast(2013 + (n_nationkey * 5) % 14 as string), ' in City', cast(n_nationkey as string)) as event_name,
               case when n_nationkey % 11 = 10 then null else cast(2013 + (n_nationkey * 5) % 14 as int) end as year,
               case n_nationkey % 4 when 0 then 'm' when 1 then 'w' when 2 then 'mx' else 'mxd' end as gender
        from {nation}""",
    "v_matches": """
        select cast(c_nationkey + 1 as bigint) as event_id, c_custkey as match_id,
               concat('T', cast(c_custkey % 97 as string)) as team1_code, concat('U', cast(c_custkey % 89 as string)) as team2_code
        from {customer}""",
    "v_ends": """
        select okey, event_id, match_id, end_number, team1_code, team2_code,
               coalesce(sum(q1) over (partition by match_id order by end_number rows between unbounded preceding and 1 preceding), 0) as team1_score_before,
               coalesce(sum(q2) over (partition by match_id order by end_number rows between unbounded preceding and 1 preceding), 0) as team2_score_before,
               case when conceded = 1 then 'X' else cast(p1 as string) end as team1_score_this_end,
               case when conceded = 1 then 'X' else cast(p2 as string) end as team2_score_this_end,
               coalesce(sum(q1) over (partition by match_id order by end_number rows between unbounded preceding and current row), 0) + case when okey % 71 = 0 then 1 else 0 end as team1_score_after,
               coalesce(sum(q2) over (partition by match_id order by end_number rows between unbounded preceding and current row), 0) as team2_score_after,
               case when okey % 17 = 0 then '' when okey % 3 = 0 then team1_code else team2_code end as hammer_team_code,
               case when okey % 5 = 0 or event_id % 7 = 3 then '' else concat(cast(10 + okey % 28 as string), ':', cast(10 + okey % 49 as string)) end as team1_time_left,
               case when okey % 5 = 0 or event_id % 7 = 3 then '' else concat(cast(10 + okey % 26 as string), ':', cast(10 + okey % 47 as string)) end as team2_time_left
        from (select o_orderkey as okey, m.event_id, m.match_id, m.team1_code, m.team2_code,
                     cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as int) as end_number,
                     case when o_orderkey % 53 = 0 then 1 else 0 end as conceded,
                     case when o_orderkey % 2 = 0 then o_orderkey % 4 else case when o_orderkey % 61 = 0 then 1 else 0 end end as p1,
                     case when o_orderkey % 2 = 1 then o_orderkey % 4 else case when o_orderkey % 61 = 0 then 1 else 0 end end as p2,
                     case when o_orderkey % 53 = 0 then 0 when o_orderkey % 2 = 0 then o_orderkey % 4 else case when o_orderkey % 61 = 0 then 1 else 0 end end as q1,
                     case when o_orderkey % 53 = 0 then 0 when o_orderkey % 2 = 1 then o_orderkey % 4 else case when o_orderkey % 61 = 0 then 1 else 0 end end as q2
              from {orders} o join v_matches m on o.o_custkey = m.match_id) e""",
    "v_known_ends": "select * from v_ends where okey % 29 <> 0",
    "v_shots": """
        select s.okey, e.event_id, e.match_id, e.end_number, s.shot_number, s.p, s.s,
               case when s.shot_number % 2 = 1 then e.team1_code else e.team2_code end as team_code,
               concat('PLAYER ', cast(s.p % 5 as string)) as player_name,
               case s.p % 10 when 0 then 'Draw' when 1 then 'Guard' when 2 then 'Take-out' when 3 then 'Raise' when 4 then 'Hit and Roll' when 5 then 'Wick / Soft Peeling' when 6 then 'Double Take-out' when 7 then 'Through' when 8 then '' else 'Front' end as shot_type,
               case when s.s % 7 = 0 then '' when s.s % 2 = 0 then 'Clockwise' else 'Counter-clockwise' end as turn,
               case when s.p % 11 = 0 then '' when s.p % 211 = 5 then '105' else cast((s.s % 21) * 5 as string) end as accuracy,
               case when s.okey % 3 = 0 and s.p % 9 <> 0 or s.okey % 3 <> 0 and s.p % 13 = 0 then 'bottom' else 'top' end as house_orientation
        from (select l_orderkey as okey, l_partkey as p, l_suppkey as s,
                     cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as int) as shot_number
              from {lineitem}) s join v_ends e on s.okey = e.okey
        where s.shot_number <= 16""",
    "v_places": """
        select b.okey, b.event_id, b.match_id, b.end_number, b.shot_number, cast(2 - t.shot_number % 2 as int) as team, t.shot_number as thrown,
               case when (t.p + 7 * b.shot_number) % 29 = 0 or (t.p + 5 * b.shot_number) % 23 = 0 or (t.p + 3 * b.shot_number) % 31 = 0 then 1 else 0 end as jumped,
               case when (t.p + t.s) % 9 = 0 and b.shot_number >= t.shot_number + 2 then 1 else 0 end as gone,
               cast((t.p * 37 + t.s * 11) % 2881 - 1440 + ((t.p * 31 + b.shot_number * 17) % 41 - 20)
                    + case when (t.p + 7 * b.shot_number) % 29 = 0 then 140 when (t.p + 5 * b.shot_number) % 23 = 0 then 110 when (t.p + 3 * b.shot_number) % 31 = 0 then 400 else 0 end as double) / cast(1000 as double) as x,
               cast((t.p * 53 + t.s) % 4600 - 1000 as double) / cast(1000 as double) as y
        from v_shots t join v_shots b on t.okey = b.okey and t.shot_number <= b.shot_number""",
    "v_stones": """
        select event_id, match_id, end_number, shot_number, team,
               cast(row_number() over (partition by okey, shot_number, team order by dist, x, y, thrown) as int) as slot,
               x, y, dist, round(degrees(atan2(y, x)), 4) as angle, okey, thrown
        from (select *, sqrt(x * x + y * y) as dist from v_places where gone = 0) d""",
    "v_ghosts": """
        select event_id, match_id, end_number, shot_number, team,
               cast(row_number() over (partition by okey, shot_number, team order by thrown) as int) as slot, x, y
        from (select b.event_id, b.match_id, b.end_number, b.shot_number, b.team, b.thrown, b.okey,
                     case when b.thrown % 5 = 4 then null else a.x + cast((b.thrown % 7) - 3 as double) / cast(100 as double) end as x, a.y as y
              from v_places b join v_places a on a.okey = b.okey and a.thrown = b.thrown and a.shot_number = b.shot_number - 1
              where a.gone = 0 and (b.gone = 1 or b.jumped = 1)) g""",
    # tracked by what the generator knows, so metrics are tested apart from the tracker
    "v_known": """
        select s.event_id, s.match_id, s.end_number, s.shot_number, s.team, s.slot, s.x, s.y, s.dist, s.angle,
               cast(case when s.thrown % 6 = 5 and s.shot_number % 4 = 0 then 100 + s.thrown when s.thrown % 11 = 10 then null else s.thrown end as bigint) as stone_id,
               case when s.thrown % 6 = 5 and s.shot_number % 4 = 0 then null else a.x end as prev_x,
               case when s.thrown % 6 = 5 and s.shot_number % 4 = 0 then null else a.y end as prev_y,
               case when s.shot_number > 1 and s.okey % 3 = 0 then case when s.thrown = s.shot_number then cast(1 as double) else cast(0 as double) end end as is_shot_stone
        from v_stones s left join v_stones a on a.okey = s.okey and a.thrown = s.thrown and a.shot_number = s.shot_number - 1""",
    "v_boards": "select distinct event_id, match_id, end_number, shot_number from v_shots",
    "v_counted": """
        select s.*, coalesce(n.n1, 0) as team1_stones_in_play, coalesce(n.n2, 0) as team2_stones_in_play
        from v_shots s left join (select okey, shot_number, sum(case when team = 1 then 1 else 0 end) as n1, sum(case when team = 2 then 1 else 0 end) as n2 from v_stones group by okey, shot_number) n
          on s.okey = n.okey and s.shot_number = n.shot_number""",
    "v_found": """
        select event_id, match_id, end_number, shot_number, case when team = 1 then 'red' else 'yellow' end as colour, thrown % 4 = 1 as is_ghost,
               x + cast(thrown % 5 - 2 as double) / cast(50 as double) as x, y + cast(shot_number % 7 - 3 as double) / cast(100 as double) as y
        from v_stones where thrown % 9 <> 8""",
    "v_detected": "select *, sqrt(x * x + y * y) as dist from v_found",
    "v_truth": "select event_id, match_id, end_number, shot_number, case when team = 1 then 'red' else 'yellow' end as colour, thrown % 4 = 1 as is_ghost, x, y, dist from v_stones where thrown % 8 <> 7",
    "v_house": """
        select event_id, match_id, end_number, shot_number, cast(161 as double) as cx, cast(171 as double) as cy, cast(100 + (okey % 25) + event_id % 3 * 4 as double) as radius, house_orientation as orientation
        from v_shots""",
    "v_blobs": """
        select s.event_id, s.match_id, s.end_number, s.shot_number, case when s.team = 1 then 'red' else 'yellow' end as colour,
               cast(161 as double) + s.x * cast(20 as double) as sx, cast(171 as double) + s.y * cast(10 as double) as sy,
               cast(60 + (s.thrown * 131 + s.okey * 7) % 600 as double) as area, cast(20 + (s.thrown * 57 + s.okey * 11) % 500 as double) as colored_px
        from v_stones s""",
    "v_pages": """
        select event_id, match_id, end_number, okey, cast(row_number() over (partition by event_id order by match_id, end_number) as int) as page_idx,
               concat('Game - Shot by Shot', chr(10), 'SAT ', cast(1 + match_id % 28 as string), ' NOV ', cast(2013 + match_id % 12 as string), ' Round ', cast(match_id % 9 as string), chr(10),
                      'Start Time ', cast(8 + okey % 12 as string), ':00', chr(10),
                      case when okey % 37 = 0 then 'no end here' else concat('End ', cast(end_number as string), ' ', team1_code, ' - Team One ', cast(team1_score_before as string), ' + ', team1_score_this_end, ' (this end) = ', cast(team1_score_after as string), ' ', team2_code, ' - Team Two ', cast(team2_score_before as string), ' + ', team2_score_this_end, ' (this end) = ', cast(team2_score_after as string)) end, chr(10),
                      'Total Score ', cast(team1_score_after as string), case when okey % 43 = 0 then '' else concat(' ', cast(team2_score_after as string)) end, chr(10), 'Time left 11:41 9:27') as text
        from v_ends""",
    "v_predictions": """
        select s.okey * 100 + s.shot_number as graph_id, s.event_id, cast(s.okey % 97 as int) as batch,
               cast((s.p * 7) % 101 as double) as accuracy, cast((s.s * 3) % 7 as double) / cast(2 as double) as score1, cast((s.p * 5) % 9 as double) / cast(2 as double) as score2,
               cast((s.p * 13) % 17 as double) / cast(8 as double) as z0, cast((s.p * 11) % 19 as double) / cast(8 as double) as z1, cast((s.s * 7) % 23 as double) / cast(8 as double) as z2,
               case when s.p % 11 = 0 then null else cast((s.s % 21) * 5 as double) end as y_accuracy,
               case when s.okey % 53 = 0 then null else cast(s.okey % 4 as double) end as y_score1, case when s.okey % 59 = 0 then null else cast(s.okey % 3 as double) end as y_score2,
               cast(case when s.p % 6 = 5 then -1 else s.p % 3 end as int) as y_type
        from v_shots s""",
    "v_results": """
        select concat('book', cast(n_nationkey as string), '.pdf') as filename, cast(9000 + (n_nationkey * 379) % 1000 as double) / cast(100 as double) as f1,
               case when n_nationkey % 6 = 5 then null else cast(8000 + (n_nationkey * 811) % 2000 as double) / cast(100 as double) end as ghost_recall,
               cast((n_nationkey * 17) % 90 as double) / cast(1000 as double) as pos_err_p95_norm, cast(n_nationkey as bigint) as ends_evaluated
        from {nation} where n_nationkey % 5 <> 4""",
    "v_baseline": """
        select concat('book', cast(n_nationkey as string), '.pdf') as filename, cast(9400 + (n_nationkey * 53) % 600 as double) / cast(100 as double) as f1,
               cast(8800 + (n_nationkey * 97) % 1200 as double) / cast(100 as double) as ghost_recall, cast((n_nationkey * 7) % 60 as double) / cast(1000 as double) as pos_err_p95_norm, cast(n_nationkey + 1 as bigint) as ends_evaluated
        from {nation} where n_nationkey % 7 <> 3""",
    # result pages: a book of men and, for some, one of women; of two summaries the last counts
    "v_link_pages": """
        select event_id as page_id, concat('<html><body><p><a href="index.html">home</a></p><table class="t" id="SearchTable"><tr><th>Name</th></tr><tr"><td class="n"><b>', event_name, '</b>&nbsp;</td><td>', gender, '</td><td>-</td><td>',
                 '<a title="Men&#39;s results" href="files/ResultsBook_', cast(event_id as string), 'm.pdf"><img alt="x" src="img/pdf_m.png"></a>',
                 case when event_id % 2 = 0 then concat('<a href="https://other.example/ResultBook_', cast(event_id as string), 'w.pdf"><img src="img/pdf_w.png"></a>') else '' end,
                 '<a href="files/Programme.pdf" title="Men">p</a></td><td>',
                 case when event_id % 3 = 0 then '' else concat('<a title="Men" href="files/ResultsSummary_', cast(event_id as string), 'a.pdf">s</a><a href="files/ResultSummary_', cast(event_id as string), 'b.pdf" title="Men">s</a>') end,
                 '</td></tr><tr><td>short</td><td>row</td></tr></table></body></html>') as html
        from v_events""",
    "v_boxes": """
        select okey as page_id, shot_number as image_id, event_id, cast(s % 50 as double) as x0, cast(s % 50 + 5 + p % 110 as double) as x1, cast(p % 30 as double) as top, cast(p % 30 + 5 + case when p % 3 = 0 then p % 110 else s * 7 % 160 end as double) as bottom
        from v_shots""",
    "v_grid": """
        select okey as page_id, cast(shot_number - 1 as int) as shot, cast(20 + (shot_number - 1) % 6 * 90 as double) as x0, cast(90 + (shot_number - 1) % 6 * 90 as double) as x1,
               cast(150 + 200 * case when shot_number <= 6 then 0 when shot_number <= 12 then 1 else 2 end as double) as bottom, p, s
        from v_shots""",
    # words under a shot's picture: names up to 6 below, types up to 25 below, noise beyond
    "v_words": """
        select page_id, cast(shot * 20 + k as int) as word_no, x0 + dx as x0, bottom + dy as top, text
        from (select page_id, shot, x0, bottom, 1 as k, cast(2 as double) as dx, cast(-2 as double) as dy, concat('T', cast(s % 97 as string), ':') as text from v_grid
              union all select page_id, shot, x0, bottom, 2, cast(20 as double), cast(1 as double), 'PLAYER' from v_grid
              union all select page_id, shot, x0, bottom, 3, cast(75 as double), cast(6 as double), concat('N', cast(p % 5 as string)) from v_grid
              union all select page_id, shot, x0, bottom, 4, cast(-5 as double), cast(7 as double), case p % 4 when 0 then 'Draw' when 1 then 'Take-out' when 2 then 'Hit' else 'Through' end from v_grid
              union all select page_id, shot, x0, bottom, 5, cast(10 as double), cast(8 as double), 'and' from v_grid where p % 4 = 2
              union all select page_id, shot, x0, bottom, 6, cast(20 as double), cast(8 as double), 'Roll' from v_grid where p % 4 = 2
              union all select page_id, shot, x0, bottom, 7, cast(30 as double), cast(9 as double), 'x' from v_grid where p % 5 = 0
              union all select page_id, shot, x0, bottom, 8, cast(40 as double), cast(20 as double), case s % 3 when 0 then '↺' when 1 then '↻' else '-' end from v_grid where s % 7 <> 0
              union all select page_id, shot, x0, bottom, 9, cast(50 as double), cast(25 as double), concat(cast(s % 21 * 5 as string), '%') from v_grid where p % 11 <> 0
              union all select page_id, shot, x0, bottom, 10, cast(50 as double), cast(26 as double), 'NOISE' from v_grid
              union all select page_id, shot, x0, bottom, 11, cast(80 as double), cast(1 as double), 'BESIDE' from v_grid) w""",
    # pixels of the ring: a good narrow mask, too few of them, none, none and no circle, and a wrong radius
    "v_crops": """
        select event_id, match_id, end_number, shot_number, cast(686 as double) as h, cast(okey % 5 as int) as kind,
               cast(161 + okey % 7 as double) as cx, cast(case when okey % 2 = 0 then 171 else 515 end as double) as cy, cast(100 + p % 25 as double) as r
        from v_shots""",
    "v_ring": """
        select event_id, match_id, end_number, shot_number, mask, cx + r * ux / cast(10 as double) as px, cy + r * uy / cast(10 as double) as py
        from (select event_id, match_id, end_number, shot_number, cx, cy, case when kind = 4 then 2 * r else r end as r, kind from v_crops) c
        cross join (values (0, 10, 0), (1, -10, 0), (2, 0, 10), (3, 0, -10), (4, 6, 8), (5, -6, 8), (6, 6, -8), (7, -6, -8)) u(k, ux, uy)
        cross join (values ('narrow'), ('broad')) m(mask)
        where (mask = 'narrow' and (kind in (0, 4) or kind = 1 and k < 5)) or (mask = 'broad' and kind in (0, 1))""",
    "v_circles": """
        select event_id, match_id, end_number, shot_number, cx + d as cx, cy + d as cy, r + e as r
        from v_crops cross join (values (cast(0 as double), cast(0 as double)), (cast(40 as double), cast(3 as double)), (cast(3 as double), cast(60 as double))) u(d, e) where kind in (1, 2)""",
    "v_hues": """
        select okey as page_id, shot_number as indicator,
               cast(case (okey + p) % 5 when 0 then 22 when 1 then 3 when 2 then 174 when 3 then 90 else 12 end + k % 5 as double) as hue, cast(40 + (p + k * 13) % 100 as double) as sat, cast(50 + (s + k * 29) % 150 as double) as val
        from v_shots cross join (values (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13)) u(k) where shot_number <= 3""",
    "v_rounds": "select event_id, match_id, concat('Round ', cast(match_id % 9 as string)) as round from v_matches",
}

#: The known stones, and true and detected ones, with their order, which they lie by.
VIEWS["v_known_by_order"] = VIEWS["v_known"].replace("select s.event_id", "select s.okey, s.event_id", 1)
VIEWS["v_found_by_order"], VIEWS["v_truth_by_order"] = (VIEWS[f"v_{k}"].replace("select event_id", "select okey, event_id", 1) for k in ("found", "truth"))
VIEWS["v_detected_by_order"] = VIEWS["v_detected"].replace("v_found", "v_found_by_order")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


def needed(text: str) -> list[str]:
    """Views that a text uses, each after those that it uses itself."""
    out: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\bv_\w+", sql):
            if name in VIEWS and name not in out:
                visit(VIEWS[name])
                if name not in out:
                    out.append(name)

    visit(text)
    return out


def with_views(text: str, recursive: str = "") -> str:
    """The text after the views it needs; ``recursive`` holds further steps of the WITH clause."""
    steps = [f"{name} as ({VIEWS[name].strip()})" for name in needed(recursive + " " + text)]
    if recursive:
        steps.append(recursive)
    if not steps:
        return text
    if text.lstrip().startswith("with "):
        return f"with {'recursive ' if recursive else ''}" + ",\n".join(steps) + ",\n" + text.lstrip()[5:]
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(steps) + "\n" + text


def oracle(text: str, recursive: str = "") -> str:
    """The text for DuckDB, where tables have their names."""
    out = with_views(text, recursive)
    for t in TABLES:
        out = out.replace("{" + t + "}", t)
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the Parquet tables of a folder.

    Rows that lie by order or by end may join by shot as they lie: these keys
    are parts of a shot's, and none of them has many rows.  The lines of orders
    are dealt by order as they are read: all uses share that shuffle, and an
    order's key under another name is known to lie as they do.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    out = with_views(f"select * from {name}")
    out = out.replace("{lineitem}", "(select /*+ repartition(l_orderkey) */ * from {lineitem})")
    for t in TABLES:
        out = out.replace("{" + t + "}", f"parquet.`{sf_dir}/{t}.parquet`")
    return spark.sql(out)
