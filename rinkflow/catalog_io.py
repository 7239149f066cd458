"""Queries of sources, sinks, pages and calibration, and what they are in DuckDB's SQL."""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas
from .catalog import _COUNTED, KEYS, METRIC_SQL, TRACKED_SQL, Views, _stones, _tracked, query
from .constants import SHOT
from .functions import text
from .operators import detection, dims, learning, metrics, reshape, tracking
from .shared import cut, new_folder, settled
from .sources import images as board
from .sources import pages as page_source
from .sources import tables
from .streaming import tracker


# ---- files --------------------------------------------------------------------


@query("select page_id, md5(html) as digest, cast(length(html) as integer) as n from pages")
def read_pages(v):
    """Pages saved as files and read whole."""
    folder = new_folder(v.spark, "pages")
    v.spark.read.parquet(f"{v.sf_dir}/pages.parquet").select("page_id", F.col("html").alias("value")).repartition("page_id").write.partitionBy("page_id").option("lineSep", "\x01").text(folder)
    got = page_source.read_html(v.spark, f"{folder}/*/*.txt")
    html = F.regexp_replace("html", "\x01$", "")
    return settled(got.select(F.regexp_extract("path", r"page_id=(\d+)", 1).cast("bigint").alias("page_id"), F.md5(html.cast("binary")).alias("digest"), F.length(html).alias("n")), folder)


@query("select event_id, page_idx, text, cast(null as varchar) as error from v_pages where event_id % 3 <> 0 union all select event_id, 0, null, 'ValueError: not a book' from v_events where event_id % 3 = 0")
def read_books(v):
    """Books as binary files, read by a decoder that callers bring; those that it can't read give their error."""
    folder = new_folder(v.spark, "books")
    books = v.pages.where("event_id % 3 <> 0").groupBy("event_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("page_idx", "text"))), lambda p: p.text)).alias("value"))
    books = books.unionByName(v.events.where("event_id % 3 = 0").select("event_id", F.lit("broken").alias("value")))
    books.repartition("event_id").write.partitionBy("event_id").text(folder)

    def decode(content: bytes) -> list[dict]:
        if content.strip() == b"broken":
            raise ValueError("not a book")
        return [{"text": x} for x in json.loads(content)]

    got = page_source.read_documents(v.spark, f"{folder}/*/*.txt", decode)
    event = F.regexp_extract("path", r"event_id=(\d+)", 1).cast("bigint")
    first = F.when(F.col("error").isNull(), 1).otherwise(0)
    return settled(got.select(event.alias("event_id"), (F.col("page_idx") + first).alias("page_idx"), "text", "error"), folder)


_ENDS = "event_id, match_id, end_number, team1_code, team2_code, cast(team1_score_before as bigint) as team1_score_before, nullif(team1_score_this_end, '') as team1_score_this_end, nullif(hammer_team_code, '') as hammer_team_code, nullif(team1_time_left, '') as team1_time_left"


@query(f"select {_ENDS}, coalesce(try_cast(team1_score_this_end as double) is null or try_cast(team2_score_this_end as double) is null, true) as is_conceded from v_known_ends")
def csv_ends(v):
    """Ends written as CSV and read by their declared types; empty text is null."""
    folder = new_folder(v.spark, "ends")
    tables.write_csv(v.known_ends.drop("okey"), f"{folder}/ends.csv")
    got = tables.read_ends(v.spark, f"{folder}/ends.csv")
    return settled(got.select("event_id", "match_id", "end_number", "team1_code", "team2_code", "team1_score_before", "team1_score_this_end", "hammer_team_code", "team1_time_left", "is_conceded"), folder)


@query("select event_id, event_name, year, gender from v_events")
def csv_fragments(v):
    """Several CSV files, each with its header, read as one table."""
    folder = new_folder(v.spark, "fragments")
    for k in range(3):
        tables.write_csv(v.events.where(F.col("event_id") % 3 == k), f"{folder}/part{k}.csv")
    return settled(tables.read_fragments(v.spark, [f"{folder}/part{k}.csv" for k in range(3)], schemas.EVENTS).select("event_id", "event_name", F.col("year").cast("int").alias("year"), "gender"), folder)


@query("select event_id, match_id, team1_code, case when event_id % 2 = 0 then 'second' else 'first' end as round from v_matches")
def event_store(v):
    """Matches by event: a rerun of some events replaces theirs and no others."""
    folder = new_folder(v.spark, "matches")
    first = v.matches.withColumn("round", F.lit("first"))
    tables.write_events(first, folder, schemas.MATCHES)
    tables.write_events(first.where("event_id % 2 = 0").withColumn("round", F.lit("second")), folder, schemas.MATCHES)
    return settled(tables.read_events(v.spark, folder, schemas.MATCHES).select("event_id", "match_id", "team1_code", "round"), folder)


_PLAYERS = "(select event_id, team_code, player_name, min((match_id, end_number, shot_number)) as f from v_shots group by all)"


@query(f"""select row_number() over (order by event_id, f, team_code, player_name) as player_id, event_id, team_code, player_name from {_PLAYERS} where event_id <= 12
union all select (select count(*) from {_PLAYERS} where event_id <= 12) + row_number() over (order by event_id, f, team_code, player_name), event_id, team_code, player_name from {_PLAYERS} where event_id > 12""")
def resume_registry(v):
    """Players stored by an earlier run, read again, and those of new events numbered after them."""
    folder = new_folder(v.spark, "players")
    tables.write_events(dims.player_ids(v.shots.where("event_id <= 12")), folder, schemas.PLAYERS)
    known = tables.read_events(v.spark, folder, schemas.PLAYERS)
    return settled(dims.resume_players(known, v.shots), folder)


@query("select distinct event_id, team_code, player_name from v_shots")
def team_names(v):
    """Wide team rows back to their players."""
    names = v.shots.select("event_id", "team_code", F.lit("x").alias("team_name"), F.col("end_number").alias("seen_at"))
    return tables.teams_to_names(dims.rosters(v.shots, names).drop("roster", "team_name"))


@query(f"select {KEYS}, team, slot, x, y, stone_id, prev_x, prev_y, is_shot_stone from flagged", TRACKED_SQL)
def tracked_file(v):
    """Tracked stones written wide as Parquet and CSV and read from each; both agree."""
    folder = new_folder(v.spark, "tracked")
    tracked = _tracked(v).select(*SHOT, "team", "slot", "x", "y", "stone_id", "prev_x", "prev_y", "is_shot_stone")
    tables.write_tracked(reshape.long_to_wide(tracked, v.boards), f"{folder}/t")
    want = [f.split()[0] for f in schemas.shots_tracked().split(", ")]
    sides = []
    for suffix in ("parquet", "csv"):
        wide = tables.read(v.spark, f"{folder}/t.{suffix}", schemas.shots_tracked())
        assert wide.columns == want
        sides.append(reshape.wide_to_long(wide).select(*SHOT, "team", "slot", "x", "y", F.col("stone_id").cast("bigint").alias("stone_id"), "prev_x", "prev_y", "is_shot_stone"))
    return settled(sides[0].intersectAll(sides[1]), folder)


@query("select split, count(*) as n, cast(sum(n) as bigint) as n_nodes from (select case when e.year is null or e.year <= 2023 then 'train' when e.year = 2024 then 'val' else 'test' end as split, c.team1_stones_in_play + c.team2_stones_in_play as n from v_counted c left join v_events e using (event_id)) where split <> 'train' group by split")
def sample_files(v):
    """Samples written by split; a reader takes the splits that it wants."""
    from .operators import graph

    folder = new_folder(v.spark, "samples")
    s = graph.assign_splits(v.counted.select(*SHOT, F.array_repeat(F.lit(0.0), (F.col("team1_stones_in_play") + F.col("team2_stones_in_play")).cast("int")).alias("x_t")), v.events)
    tables.write_samples(s, folder)
    got = tables.read_samples(v.spark, folder, "val").unionByName(tables.read_samples(v.spark, folder, "test"))
    return settled(got.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.size("x_t")).alias("n_nodes")), folder)


@query("select filename, concat('https://x/', filename) as url, cast(ends_evaluated as integer) as year, f1 from v_results where ends_evaluated % 2 = 0")
def manifest_files(v):
    """A JSON manifest joined with a results file in JSON."""
    folder = new_folder(v.spark, "manifest")
    pdfs = v.results.where("ends_evaluated % 2 = 0").select("filename", F.concat(F.lit("https://x/"), "filename").alias("url"), F.col("ends_evaluated").cast("int").alias("year"))
    one = pdfs.agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("pdfs"))).alias("value"))
    one.coalesce(1).write.text(f"{folder}/manifest")
    v.spark.createDataFrame([(tables.baseline_json(v.results, {"min_f1": 97.0}),)], "value string").coalesce(1).write.text(f"{folder}/results")
    assert tables.read_thresholds(v.spark, f"{folder}/results") == {"min_f1": 97.0}
    got = tables.read_manifest(v.spark, f"{folder}/manifest").join(tables.read_results(v.spark, f"{folder}/results"), "filename")
    return settled(got.select("filename", "url", "year", "f1"), folder)


@query("""select '| event_id | n |' as line union all select '|---|---|' union all select concat('| ', event_id, ' | ', n, ' |') from (select event_id, count(*) as n from v_matches group by event_id)""")
def markdown_table(v):
    lines = tables.markdown(v.matches.groupBy("event_id").agg(F.count("*").alias("n"))).splitlines()
    return v.spark.createDataFrame([(x,) for x in lines], "line string")


@query("select event_id, match_id, team_code, shot_type from v_shots where end_number = 1 and shot_number = 1 and match_id = (select min(match_id) from v_shots where end_number = 1 and shot_number = 1)")
def lookup_shot(v):
    """The one row of a shot by its four keys."""
    first = v.shots.where("end_number = 1 and shot_number = 1").agg(F.min(F.struct("match_id", "event_id")).alias("k")).first().k
    return tables.lookup_shot(v.shots, first.event_id, first.match_id, 1, 1).select("event_id", "match_id", "team_code", "shot_type")


@query("select event_id, count(*) as n from v_shots where event_id = 7 group by event_id")
def selected_event(v):
    return tables.select_matches(v.shots, event_id=7).groupBy("event_id").agg(F.count("*").alias("n"))


@query("select event_id, match_id from (select *, row_number() over (order by match_id) as i from v_matches) where i between 11 and 20")
def batch_of_matches(v):
    return tables.batch_slice(v.matches, ["match_id"], 10, 10).select("event_id", "match_id")


@query("select concat('team', t, '_stone', s, '_', c) as missing from (values (1), (2)) a(t), (select unnest(range(1, 9)) as s) b, (values ('id'), ('prev_x'), ('prev_y')) d(c)")
def missing_columns(v):
    """Columns of the tracked wide form that untracked stones lack."""
    wide = reshape.long_to_wide(_stones(v), v.boards)
    return v.spark.createDataFrame([(x,) for x in reshape.missing_columns(wide)], "missing string")


@query("select event_id, match_id, count(*) as n_shots, 2 as attempts from v_shots where match_id % 2 = 1 group by all union all select event_id, match_id, count(*), 1 from v_shots where match_id % 2 = 0 group by all")
def batch_loop(v):
    """Matches worked on in batches, with the state of each batch kept and a failed one tried again."""
    folder = new_folder(v.spark, "batches")

    def work(keys: DataFrame, attempt: int) -> DataFrame:
        if attempt == 1 and keys.where("match_id % 2 = 1").count():
            raise RuntimeError("first attempt")
        return v.shots.join(F.broadcast(keys), ["event_id", "match_id"]).groupBy("event_id", "match_id").agg(F.count("*").alias("n_shots")).withColumn("attempts", F.lit(attempt))

    keys = v.matches.select("event_id", "match_id")
    batches = {f"odd-{k}": keys.where(f"match_id % 2 = {k}") for k in (0, 1)}
    tables.run_batches(batches, work, folder, retries=2)
    tables.run_batches(batches, work, folder, retries=2)  # nothing is left to do
    return settled(v.spark.read.parquet(f"{folder}/done/*").select("event_id", "match_id", "n_shots", "attempts"), folder)


@query("select event_id, match_id, count(*) as n_shots, count(distinct end_number) as n_ends from v_shots group by all")
def match_emission(v):
    """Shots written match by match as a stream reads their files."""
    folder = new_folder(v.spark, "emission")
    rows = v.shots.select(*SHOT, "team_code")
    rows.repartition(24, "event_id", "match_id").write.parquet(f"{folder}/in")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    got = tracker.emit_matches(v.spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/state", files_per_batch=8)
    out = got.groupBy(F.col("event_id").cast("bigint").alias("event_id"), F.col("match_id").cast("bigint").alias("match_id"))
    return settled(out.agg(F.count("*").alias("n_shots"), F.count_distinct("end_number").alias("n_ends")), folder)


# ---- images ---------------------------------------------------------------------


_UNIT = 28
_WIDTH, _HEIGHT = board.extent(_UNIT)


@query(f"""select {KEYS}, {_WIDTH} as width, {_HEIGHT} as height, count(s.x) as n_stones,
count(*) filter (where floor((s.x + 1.44::double) * {_UNIT} + 0.5) between 0 and {_WIDTH - 1} and floor((s.y + 1.53::double) * {_UNIT} + 0.5) between 0 and {_HEIGHT - 1}) as n_drawn
from v_boards b left join v_stones s using ({KEYS}) group by {KEYS}""")
def board_images(v):
    """Each board's PNG, at a quarter of its size, decoded again: its extent, and how many of the stones on it show a stone's colour at their centre."""
    drawn = board.board_images(_stones(v), v.boards, _UNIT, keep=True)

    def look(batches):
        for batch in batches:
            rows = []
            for data, stones in zip(batch.column(4), batch.column(5).to_pylist(), strict=True):
                image, seen = board.read_png(data.as_py()), 0
                for s in stones or []:
                    cx, cy = (math.floor(c + 0.5) for c in board.pixel(s["x"], s["y"], _UNIT))
                    if 0 <= cx < image.shape[1] and 0 <= cy < image.shape[0]:
                        seen += (*image[cy, cx].tolist(),) in {*board.STONE_COLOURS.values(), (20, 20, 20)}
                rows.append((image.shape[1], image.shape[0], len(stones or []), int(seen)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True))], [*SHOT, "width", "height", "n_stones", "n_drawn"])

    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in drawn.select(*SHOT).schema)
    return drawn.select(*SHOT, "png", "s").mapInArrow(look, f"{keys}, width int, height int, n_stones long, n_drawn long")


@query(f"""select {KEYS}, count(prev_x) filter (where sqrt((x - prev_x) * (x - prev_x) + (y - prev_y) * (y - prev_y)) > 0.35 and least(x, prev_x) > -1.3 and greatest(x, prev_x) < 1.3 and least(y, prev_y) > -1.4 and greatest(y, prev_y) < 4.4) > 0 as moved
from v_known group by {KEYS}""")
def move_images(v):
    """Whether each tracked board's image, decoded again, shows a line of a stone that moved far on it."""
    far = F.sqrt((F.col("x") - F.col("prev_x")) ** 2 + (F.col("y") - F.col("prev_y")) ** 2) > 0.35
    inside = (F.least("x", "prev_x") > -1.3) & (F.greatest("x", "prev_x") < 1.3) & (F.least("y", "prev_y") > -1.4) & (F.greatest("y", "prev_y") < 4.4)
    # other stones' places before are left out, so that a line tells of a far move
    seen = v.known.select(*SHOT, "team", "slot", "x", "y", *(F.when(far & inside, F.col(c)).alias(c) for c in ("prev_x", "prev_y")))
    drawn = board.move_images(seen, _UNIT)

    def look(batches):
        for batch in batches:
            found = [board.shows(board.read_png(data.as_py()), board.MOVED) for data in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.bool_())], [*SHOT, "moved"])

    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in drawn.select(*SHOT).schema)
    return drawn.mapInArrow(look, f"{keys}, moved boolean")


@query(f"""select {KEYS}, count(*) filter (where tp > 0) > 0 as matched, count(*) filter (where fn > 0) > 0 as missed from {_COUNTED}
join (select {KEYS} from (select {KEYS}, x, y from v_truth union all select {KEYS}, x, y from v_detected) group by {KEYS} having bool_and(abs(x) < 1.2 and y > -1.2 and y < 4.2)) using ({KEYS}) group by {KEYS}""")
def match_images(v):
    """Whether the images of true and detected stones, decoded again, show rings of matched and of missed ones; of shots whose stones all lie on them."""
    # stones lie by order, which an end has one of, so none is moved
    truth, detected, shot = v.truth_by_order, v.detected_by_order, ["okey", *SHOT]
    on = truth.select(*shot, "x", "y").unionByName(detected.select(*shot, "x", "y")).groupBy(*shot).agg(F.bool_and((F.abs("x") < 1.2) & (F.col("y") > -1.2) & (F.col("y") < 4.2)).alias("on")).where("on")
    sets = detection.match_sets(truth, detected, [*shot, "colour", "is_ghost"], places=True)
    drawn = board.match_images(sets.join(on.select(*shot), shot, "left_semi"), _UNIT)

    def look(batches):
        for batch in batches:
            images = [board.read_png(data.as_py()) for data in batch.column(4)]
            rings = [[board.shows(image, c) for image in images] for c in (board.MATCHED, board.MISSED)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(r, pa.bool_()) for r in rings)], [*SHOT, "matched", "missed"])

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in drawn.select(*SHOT).schema)
    return drawn.mapInArrow(look, f"{names}, matched boolean, missed boolean").groupBy(*SHOT).agg(F.bool_or("matched").alias("matched"), F.bool_or("missed").alias("missed"))


@query("""select page_id, image_id, x1 - x0 > 50 and bottom - top > 100 as is_shot, x1 - x0 > 15 and x1 - x0 < 55 and bottom - top > 15 and bottom - top < 55 and abs((x1 - x0) - (bottom - top)) < 10 as is_indicator,
cast(trunc(x0 * (300::double / 72)) as integer) as x0_px, cast(trunc(bottom * (300::double / 72)) as integer) as bottom_px from v_boxes""")
def image_boxes(v):
    """Boxes of pages: which can be shots, which indicators, and their pixels at 300 dpi."""
    kinds = [f(v.boxes).select("page_id", "image_id", F.lit(True).alias(name)) for f, name in ((dims.shot_images, "is_shot"), (dims.indicator_images, "is_indicator"))]
    out = dims.crop_boxes(v.boxes)
    for k in kinds:
        out = out.join(k, ["page_id", "image_id"], "left")
    return out.select("page_id", "image_id", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("is_shot", "is_indicator")), "x0_px", "bottom_px")


# ---- pages ----------------------------------------------------------------------

_BOOK = "regexp_extract(event_name, '^(.*) in (.*)$', 1) as tournament_name, regexp_extract(event_name, '([0-9]{4})', 1) as year, regexp_extract(event_name, '^(.*) in (.*)$', 2) as location"


@query(f"""select event_id as page_id, cast(1 as integer) as row_no, {_BOOK}, 'm' as gender, concat('https://curlit.com/files/ResultsBook_', event_id, 'm.pdf') as result_book_url,
  case when event_id % 3 = 0 then '' else concat('https://curlit.com/files/ResultSummary_', event_id, 'b.pdf') end as result_summary_url from v_events
union all select event_id, 1, {_BOOK}, 'w', concat('https://other.example/ResultBook_', event_id, 'w.pdf'), '' from v_events where event_id % 2 = 0""")
def scrape_results(v):
    """Books and summaries of result tables."""
    return page_source.scrape(v.link_pages)


_TYPE = "case p % 4 when 0 then 'Draw' when 1 then 'Take-out' when 2 then 'Hit and Roll' else 'Through' end"


@query(f"""select page_id, shot, concat('T', s % 97) as team_code, concat('PLAYER N', p % 5) as player_name, {_TYPE} as shot_type,
  case when s % 7 = 0 then case when p % 4 = 3 then 'Not considered' else '' end when s % 3 = 0 then 'Counter-clockwise' when s % 3 = 1 then 'Clockwise' else 'Not considered' end as turn,
  case when p % 11 = 0 then '' else cast(s % 21 * 5 as varchar) end as accuracy from v_grid""")
def shot_words(v):
    """Words assigned to shots by place, and folded to team, player, type, turn and accuracy."""
    found = dims.words_to_shots(v.words, v.grid.drop("p", "s"))
    return found.select("page_id", "shot", text.shot_metadata().alias("m")).select("page_id", "shot", "m.*")


# ---- calibration ------------------------------------------------------------------


@query(f"""select {KEYS}, round(case kind when 0 then cx when 1 then cx when 2 then cx when 4 then cx else 161.0::double end, 6) as cx, round(case when kind = 3 then 171.0::double else cy end, 6) as cy,
  round(case when kind in (3, 4) then 112.0::double when abs(r / 112 - 1) <= 0.25 then r else 112.0 end, 6) as radius, case when kind = 3 or cy <= h / 2 then 'top' else 'bottom' end as orientation,
  case kind when 0 then 'narrow' when 1 then 'broad' when 2 then 'circle' when 4 then 'narrow' else 'fixed' end as source
from (select * replace (case when kind = 2 then c.cx + u.d else c.cx end as cx, case when kind = 2 then c.cy + u.d else c.cy end as cy, case when kind = 2 then c.r + u.e else c.r end as r) from v_crops c, (values (0.0::double, 0.0::double), (40.0, 3.0), (3.0, 60.0)) u(d, e)
  qualify row_number() over (partition by {KEYS} order by abs(c.r + u.e - 112) + 0.25::double * abs(c.cx + u.d - 161) + 0.25::double * least(abs(c.cy + u.d - 171), abs(c.cy + u.d - (c.h - 171))), c.cx + u.d) = 1)""")
def house_calibration(v):
    out = detection.calibrate_house(v.crops, v.ring, v.circles)
    return out.withColumns({c: F.round(c, 6) for c in ("cx", "cy", "radius")})


@query("""with one as (select page_id, indicator, quantile_cont(hue, 0.5) as m from v_hues where sat >= 60 and val >= 60 group by all having count(*) >= 10),
mid as (select p.page_id, quantile_cont(m, 0.5) filter (where m >= 10 and m <= 50) as y, quantile_cont(m, 0.5) filter (where (m < 10 or m > 50) and (m <= 15 or m >= 165)) as r
  from (select distinct page_id from v_hues) p left join one using (page_id) group by all),
e as (select page_id, cast(trunc(r - 12) as integer) as rl, cast(trunc(r + 12) as integer) as rh, cast(trunc(y - 12) as integer) as yl, cast(trunc(y + 12) as integer) as yh from mid)
select page_id, 'red' as colour, 1 as part, coalesce(greatest(0, rl), 0) as low, case when rh is null then 10 else least(180, rh) end as high from e
union all select page_id, 'red', 2, case when rl < 0 then 180 + rl when rh > 180 then 0 else 160 end, case when rl < 0 then 180 when rh > 180 then rh - 180 else 180 end from e
union all select page_id, 'yellow', 1, case when yl is null then 10 else greatest(0, yl) end, case when yh is null then 35 else least(180, yh) end from e""")
def hue_calibration(v):
    return detection.hue_windows(v.hues.select("page_id").distinct(), v.hues)


@query(f"""select {KEYS}, colour, x, y, sqrt(x * x + y * y) as dist, is_ghost from (
select {KEYS}, colour, case when orientation = 'top' then (sx - cx) / radius else (cx - sx) / radius end as x, case when orientation = 'top' then (sy - cy) / radius else (cy - sy) / radius end as y, colored_px / area < 0.45 as is_ghost
from (select * replace (sy - 165 as sy) from v_blobs) join v_house using ({KEYS}) where area >= 0.5::double * 80 * ((radius / 112) * (radius / 112)) and sy >= 15)""")
def truth_blobs(v):
    """Blobs by the rule of ground truth, some of them in the strip at the top."""
    blobs = v.blobs.withColumn("sy", F.col("sy") - 165)
    return detection.classify_blobs(blobs, v.house, permissive=True).drop("angle")


@query("""select e.event_id, case when e.event_id % 6 = 5 then 'error' when p.page_idx is null then 'no_shot_pages' when e.event_id % 6 = 3 then 'no_shot_images' when abs(h.radius - 112) / 112 > 0.1 then 'radius_deviation' when coalesce(n.n, 0) > 0 then 'suspect_stones' else 'ok' end as status
from v_events e left join (select event_id, min(page_idx) as page_idx from v_pages where event_id % 6 <> 4 group by event_id) p using (event_id) left join (select event_id, quantile_cont(radius, 0.5) as radius from v_house group by event_id) h using (event_id)
left join (select event_id, count(*) filter (where dist > 1.5) as n from v_stones where shot_number = 1 group by event_id) n using (event_id)""")
def calibration_diagnosis(v):
    """Every event's status, those that no page or picture tells of too."""
    pages = v.pages.where("event_id % 6 <> 5").select("event_id", "page_idx", F.when(F.col("event_id") % 6 != 4, F.col("text")).otherwise("cover").alias("text"), F.lit(None).cast("string").alias("error"))
    pages = pages.unionByName(v.events.where("event_id % 6 = 5").select("event_id", F.lit(0).alias("page_idx"), F.lit(None).cast("string").alias("text"), F.lit("ValueError: not a book").alias("error")))
    images = pages.where("event_id % 6 <> 3").select("event_id", "page_idx", F.lit(0.0).alias("x0"), F.lit(60.0).alias("x1"), F.lit(0.0).alias("top"), F.lit(120.0).alias("bottom"))
    return dims.diagnose(v.events, pages, images, v.house, v.stones).select("event_id", "status")


# ---- dimensions, profiles, figures ------------------------------------------------


@query(f"""select {KEYS}, s.team_code, s.player_name, i.player_id from v_shots s join (select row_number() over (order by event_id, f, team_code, player_name) as player_id, event_id, team_code, player_name from {_PLAYERS}) i using (event_id, team_code, player_name)""")
def shots_with_player_ids(v):
    return dims.with_player_ids(v.shots.select(*SHOT, "team_code", "player_name"), dims.player_ids(v.shots)).select(*SHOT, "team_code", "player_name", "player_id")


@query("""select event_id, match_id, end_number, sum(p1) over w - p1 as team1_before, sum(p1) over w as team1_after, sum(p2) over w - p2 as team2_before, sum(p2) over w as team2_after
from (select event_id, match_id, end_number, coalesce(try_cast(team1_score_this_end as bigint), 0) as p1, coalesce(try_cast(team2_score_this_end as bigint), 0) as p2 from v_ends)
window w as (partition by event_id, match_id order by end_number rows unbounded preceding)""".replace("select event_id, match_id, end_number, sum(p1) over w - p1 as team1_before, sum(p1) over w as team1_after, sum(p2) over w - p2 as team2_before, sum(p2) over w as team2_after", "select event_id, match_id, end_number, cast(sum(p1) over w - p1 as bigint) as team1_before, cast(sum(p1) over w as bigint) as team1_after, cast(sum(p2) over w - p2 as bigint) as team2_before, cast(sum(p2) over w as bigint) as team2_after"))
def running_score(v):
    return dims.running_score(v.ends)


@query("select round, count(*) as n_matches from v_rounds group by round order by n_matches desc, round limit 5")
def top_rounds(v):
    """The commonest rounds (a report)."""
    return dims.round_profile(v.rounds, 5)


_FRAG = f"({METRIC_SQL['fragmentation'].replace('{t}', 'v_known')})"


@query(f"""with f as materialized (select * from {_FRAG})
select 'describe' as measure, key, n, round(value, 9) as value from (select unnest(['mean', 'std', 'min', 'p25', 'p50', 'p75', 'max']) as key, count(frag) as n,
  unnest([avg(frag), stddev_samp(frag), min(frag), quantile_cont(frag, 0.25), quantile_cont(frag, 0.5), quantile_cont(frag, 0.75), max(frag)]) as value from f)
union all select 'bucket', frag_bucket, count(*), round(avg(frag), 9) from f group by frag_bucket
union all select 'end_number', cast(end_number as varchar), count(*), round(avg(frag), 9) from f group by end_number
union all select 'n_shots', cast(n_shots as varchar), count(*), round(avg(frag), 9) from f group by n_shots""")
def fragmentation_summary(v):
    return metrics.describe_fragmentation(cut(metrics.fragmentation(v.known, v.boards))).withColumn("value", F.round("value", 9))


@query(f"select event_id, match_id, end_number, team, ids_assigned, min_ids, frag from {_FRAG} where frag > 3 order by frag desc, event_id, match_id, end_number, team limit 20")
def worst_fragmentation(v):
    """The twenty ends with most identities for their stones (a report)."""
    return metrics.worst_fragmentation(metrics.fragmentation(v.known, v.boards)).select("event_id", "match_id", "end_number", "team", "ids_assigned", "min_ids", "frag")


_LOSS = """(select batch, coalesce(avg((accuracy - y_accuracy) * (accuracy - y_accuracy)), 0) as la, coalesce(avg(case when y_score1 is not null and y_score2 is not null then ((score1 - y_score1) * (score1 - y_score1) + (score2 - y_score2) * (score2 - y_score2)) / 2 end), 0) as ls,
coalesce(avg(case when y_type >= 0 then ln(exp(z0) + exp(z1) + exp(z2)) - case y_type when 0 then z0 when 1 then z1 else z2 end end), 0) as lt from v_predictions group by batch)"""


@query(f"select batch, round(0.5 * exp(-0.7) * la + 0.35 + 0.5 * exp(0.4) * ls - 0.2 + exp(-1.1) * lt + 1.1, 6) as total from {_LOSS}")
def uncertainty_total(v):
    """The total loss under uncertainties that aren't zero."""
    p = v.predictions.withColumn("logits", F.array("z0", "z1", "z2"))
    return learning.weighted_total(learning.losses(p, ["batch"]), 0.7, -0.4, 1.1).select("batch", F.round("total", 6).alias("total"))


# ---- the optimal matcher ------------------------------------------------------------


def _optimal_sql(team: int, prev: str) -> str:
    """All matchings of the pairs in reach, grown pair by pair; the largest, and of those the nearest, stays."""
    kind = "struct(n integer, total double, m struct(d double, i integer, j integer)[])"
    pairs = f"""list_sort(list_filter(flatten(list_transform({prev}, lambda p, i: list_transform(t{team}, lambda c, j:
      {{'n': 1, 'total': sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)), 'm': [{{'d': sqrt((c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y)), 'i': cast(i as integer), 'j': cast(j as integer)}}]}}))), lambda q: q.total < 0.13))"""
    grown = f"""list_reduce(list_prepend([{{'n': 0, 'total': 0.0::double, 'm': []::struct(d double, i integer, j integer)[]}}]::{kind}[], list_transform(list_transform({pairs}, lambda q: q::{kind}), lambda q: [q])),
      lambda a, q: list_concat(a, list_transform(list_filter(a, lambda s: len(list_filter(s.m, lambda z: z.i = q[1].m[1].i or z.j = q[1].m[1].j)) = 0), lambda s: {{'n': s.n + 1, 'total': s.total + q[1].total, 'm': list_concat(s.m, q[1].m)}}::{kind})))"""
    return f"list_sort(list_transform({grown}, lambda s: {{'a': -s.n, 'b': round(s.total, 9), 'm': s.m}}))[1].m"


def _optimal_tracked() -> str:
    from .catalog import _match_sql

    out = TRACKED_SQL
    for team, prev in ((1, "a.p1"), (2, "a.p2")):
        out = out.replace(_match_sql(team, prev), _optimal_sql(team, prev))
    return out


OPTIMAL_SQL = _optimal_tracked()


@query(f"select {KEYS}, team, slot, x, y, stone_id, prev_x, prev_y, is_shot_stone from flagged", OPTIMAL_SQL)
def track_optimal(v):
    return tracking.track(_stones(v), v.boards, "optimal").select(*SHOT, "team", "slot", "x", "y", "stone_id", "prev_x", "prev_y", "is_shot_stone")


#: The optimal matcher's steps under names of their own, beside the greedy one's.
_BOTH = f"{TRACKED_SQL.rstrip()},\n" + re.sub(r"\b(places|steps|tracked|flagged)\b", r"optimal_\1", OPTIMAL_SQL)


@query(f"""select l.rate as link_agreement_rate, g.spurious_id_rate as spurious_id_rate_greedy, g.new_stone_rate_mid_end as new_stone_rate_mid_end_greedy, o.spurious_id_rate as spurious_id_rate_optimal,
  o.new_stone_rate_mid_end as new_stone_rate_mid_end_optimal, g.spurious_id_rate - o.spurious_id_rate as spurious_id_rate_improvement
from (select cast(count(*) filter (where abs(a.prev_x - b.prev_x) < 0.0001 and abs(a.prev_y - b.prev_y) < 0.0001) as double) / nullif(count(*), 0) as rate
      from flagged a join optimal_flagged b using ({KEYS}, team, slot) where (a.prev_x is not null or b.prev_x is not null) and shot_number > (select min(shot_number) from flagged)) l,
  ({METRIC_SQL["tracking_metrics"].replace("{t}", "flagged")}) g, ({METRIC_SQL["tracking_metrics"].replace("{t}", "optimal_flagged")}) o""", _BOTH)
def compare_trackers(v):
    s, b = _stones(v), v.boards
    return metrics.compare(tracking.track(s, b, order=True), tracking.track(s, b, "optimal", order=True), b)
