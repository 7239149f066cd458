"""Dimension tables and flags derived from pages, ends and shots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CALIBRATION_DEVIATION, END, HOUSE_RADIUS, SCALE, SUSPECT_DIST


def segment_matches(pages: DataFrame) -> DataFrame:
    """``match_no`` of each page (event_id, page_idx, date, round, team1_code, team2_code, end_number).

    A match starts where date, round or teams change, or at an end 1 (a page
    that names no end counts as one).
    """
    w = Window.partitionBy("event_id").orderBy("page_idx")
    key = F.struct(*(F.coalesce(c, F.lit("")) for c in ("date", "round", "team1_code", "team2_code")))
    new = F.lag(key).over(w).isNull() | (key != F.lag(key).over(w)) | (F.coalesce("end_number", F.lit(1)) == 1)
    return pages.withColumn("match_no", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def has_time_data(events: DataFrame, ends: DataFrame) -> DataFrame:
    """Whether some end of an event has a clock."""
    clock = F.coalesce(F.col("team1_time_left"), F.lit("")) != ""
    clock = clock | (F.coalesce(F.col("team2_time_left"), F.lit("")) != "")
    flags = ends.groupBy("event_id").agg(F.bool_or(clock).alias("has_time_data"))
    return events.drop("has_time_data").join(flags, "event_id", "left").withColumn("has_time_data", F.coalesce("has_time_data", F.lit(False)))


def majority_orientation(shots: DataFrame) -> DataFrame:
    """Most common orientation of each end (ties: seen first) and how many shots differ."""
    known = shots.where("house_orientation is not null and house_orientation <> ''")
    n = known.groupBy(*END, "house_orientation").agg(F.count("*").alias("n"), F.min("shot_number").alias("first"))
    out = n.groupBy(*END).agg(F.max_by("house_orientation", F.struct("n", -F.col("first"))).alias("orientation"), (F.sum("n") - F.max("n")).alias("n_disagree"))
    return out


def rosters(players: DataFrame, names: DataFrame, width: int = 5) -> DataFrame:
    """Sorted distinct names of a team as player1_name, ...; ``names`` has event_id, team_code, team_name, seen_at.

    The team's name is its first non-empty one.  ``width`` is the largest
    roster to be expected; ``roster`` holds all names.
    """
    who = players.where("player_name is not null and player_name <> ''").groupBy("event_id", "team_code").agg(F.array_sort(F.collect_set("player_name")).alias("roster"))
    title = names.where("team_name is not null and team_name <> ''").groupBy("event_id", "team_code").agg(F.min_by("team_name", "seen_at").alias("team_name"))
    out = who.join(title, ["event_id", "team_code"], "left")
    return out.select("event_id", "team_code", "team_name", *(F.get("roster", F.lit(i)).alias(f"player{i + 1}_name") for i in range(width)), F.size("roster").alias("n_players"), "roster")


def resume_players(known: DataFrame, shots: DataFrame) -> DataFrame:
    """A stored player table with the players of new shots, numbered after the largest known id."""
    new = shots.join(known.select("event_id", "team_code", "player_name"), ["event_id", "team_code", "player_name"], "left_anti")
    last = known.agg(F.coalesce(F.max("player_id"), F.lit(0))).first()[0]
    return known.select("player_id", "event_id", "team_code", "player_name").unionByName(player_ids(new, last))


def round_profile(matches: DataFrame, n: int = 10) -> DataFrame:
    """The commonest rounds with their number of matches; ties by name."""
    return matches.groupBy("round").agg(F.count("*").alias("n_matches")).orderBy(F.desc("n_matches"), "round").limit(n)


def player_ids(shots: DataFrame, offset: int = 0) -> DataFrame:
    """Players numbered in the order in which they first appear.

    The ordered window spans the players alone, a small dimension.
    """
    first = shots.where("player_name is not null and player_name <> ''").groupBy("event_id", "team_code", "player_name").agg(F.min(F.struct("match_id", "end_number", "shot_number")).alias("first"))
    order = Window.orderBy("event_id", "first", "team_code", "player_name")
    return first.select((F.row_number().over(order) + offset).cast("bigint").alias("player_id"), "event_id", "team_code", "player_name")


def with_player_ids(shots: DataFrame, players: DataFrame) -> DataFrame:
    return shots.drop("player_id").join(players, ["event_id", "team_code", "player_name"], "left")


def final_scores(ends: DataFrame, box: DataFrame) -> DataFrame:
    """Score box of a match, or the score after its last end; box has event_id, match_id, team1_box, team2_box."""
    last = ends.groupBy("event_id", "match_id").agg(*(F.max_by(f"team{t}_score_after", "end_number").alias(f"after{t}") for t in (1, 2)))
    j = last.join(box, ["event_id", "match_id"], "left")
    return j.select("event_id", "match_id", *(F.coalesce(F.nullif(F.col(f"team{t}_box"), F.lit("")).try_cast("bigint"), F.col(f"after{t}").cast("bigint")).alias(f"team{t}_final_score") for t in (1, 2)))


def quality_rules(ends: DataFrame, shots: DataFrame) -> DataFrame:
    """(rule, checked, broken) for the invariants of ends and shots; conceded ends are left out."""
    w = Window.partitionBy("event_id", "match_id").orderBy("end_number")
    e = ends.withColumns({f"p{t}": F.col(f"team{t}_score_this_end").try_cast("bigint") for t in (1, 2)})
    e = e.withColumns({
        "gap": F.col("end_number") - F.lag("end_number").over(w),
        "last_hammer": F.lag("hammer_team_code").over(w),
        "last_p1": F.lag("p1").over(w),
        "last_p2": F.lag("p2").over(w),
    })
    due = F.when(F.col("last_p1") > F.col("last_p2"), F.col("team2_code")).when(F.col("last_p1") < F.col("last_p2"), F.col("team1_code")).otherwise(F.col("last_hammer"))
    played = F.col("p1").isNotNull() & F.col("p2").isNotNull()
    known = played & F.col("last_p1").isNotNull() & F.col("last_p2").isNotNull() & (F.coalesce("hammer_team_code", F.lit("")) != "") & (F.coalesce(due, F.lit("")) != "")
    cells = []
    for name, over, broken in [
        ("score_sum", played, (F.col("team1_score_before") + F.col("p1") != F.col("team1_score_after")) | (F.col("team2_score_before") + F.col("p2") != F.col("team2_score_after"))),
        ("both_score", played, (F.col("p1") > 0) & (F.col("p2") > 0)),
        ("end_gap", F.col("gap").isNotNull(), F.col("gap") != 1),
        ("hammer", known, F.col("hammer_team_code") != due),
    ]:
        cells.append(F.struct(F.lit(name).alias("rule"), F.count_if(over).alias("checked"), F.count_if(over & broken).alias("broken")))
    by_end = e.agg(F.array(*cells).alias("r")).select(F.inline("r"))
    order = Window.partitionBy(*END).orderBy("shot_number")
    acc = F.col("accuracy").try_cast("double")
    s = shots.withColumn("gap", F.col("shot_number") - F.lag("shot_number").over(order))
    cells = [
        F.struct(F.lit("shot_gap").alias("rule"), F.count_if(F.col("gap").isNotNull()).alias("checked"), F.count_if(F.col("gap") > 1).alias("broken")),
        F.struct(F.lit("duplicate_shot").alias("rule"), F.count("*").alias("checked"), F.count_if(F.col("gap") == 0).alias("broken")),
        F.struct(F.lit("accuracy_range").alias("rule"), F.count(acc).alias("checked"), F.count_if((acc < 0) | (acc > 100)).alias("broken")),
    ]
    return by_end.unionByName(s.agg(F.array(*cells).alias("r")).select(F.inline("r")))


def running_score(ends: DataFrame) -> DataFrame:
    """Scores before and after each end, by the points of the ends so far; conceded ends add none."""
    w = Window.partitionBy("event_id", "match_id").orderBy("end_number").rowsBetween(Window.unboundedPreceding, 0)
    out = ends.select(*END, *(F.coalesce(F.col(f"team{t}_score_this_end").try_cast("bigint"), F.lit(0).cast("bigint")).alias(f"p{t}") for t in (1, 2)))
    return out.select(*END, *(c for t in (1, 2) for c in ((F.sum(f"p{t}").over(w) - F.col(f"p{t}")).alias(f"team{t}_before"), F.sum(f"p{t}").over(w).alias(f"team{t}_after"))))


def diagnose(events: DataFrame, pages: DataFrame, images: DataFrame, house: DataFrame, stones: DataFrame) -> DataFrame:
    """Calibration status of every event, by its first shot page: error, no_shot_pages, no_shot_images, or ``calibration_status``.

    ``pages`` has event_id, page_idx, text, error (why a document couldn't be
    read, else null); ``images`` event_id, page_idx and boxes.
    """
    shot = F.col("text").contains("Game - Shot by Shot")
    p = pages.groupBy("event_id").agg(F.min(F.when(shot, F.col("page_idx"))).alias("page_idx"), F.max("error").alias("error"))
    n = shot_images(images).groupBy("event_id", "page_idx").agg(F.count("*").alias("n_images"))
    out = events.select("event_id").join(p, "event_id", "left").join(n, ["event_id", "page_idx"], "left").join(calibration_status(house, stones), "event_id", "left")
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("page_idx").isNull(), "no_shot_pages").when(F.coalesce("n_images", F.lit(0)) == 0, "no_shot_images").otherwise(F.coalesce("status", F.lit("ok")))
    return out.select("event_id", status.alias("status"), "page_idx", F.coalesce("n_images", F.lit(0)).alias("n_images"), "error")


def calibration_status(house: DataFrame, stones: DataFrame) -> DataFrame:
    """Per event: radius_deviation, suspect_stones or ok."""
    r = house.groupBy("event_id").agg(F.median("radius").alias("radius"))
    first = stones.where("shot_number = 1").groupBy("event_id").agg(F.count_if(F.col("dist") > SUSPECT_DIST).alias("n_suspect"))
    off = F.abs(F.col("radius") - HOUSE_RADIUS) / HOUSE_RADIUS
    out = r.join(first, "event_id", "left").na.fill(0, ["n_suspect"])
    return out.select("event_id", "radius", off.alias("deviation"), "n_suspect", F.when(off > CALIBRATION_DEVIATION, "radius_deviation").when(F.col("n_suspect") > 0, "suspect_stones").otherwise("ok").alias("status"))


def category_profile(events: DataFrame, category: Column) -> DataFrame:
    """Events by category: number, distinct names, and first to last year."""
    years = F.when(F.count("year") > 0, F.concat_ws("-", F.min("year").cast("string"), F.max("year").cast("string"))).otherwise("N/A")
    return events.withColumn("category", category).groupBy("category").agg(F.count("*").alias("n_events"), F.count_distinct("event_name").alias("n_names"), years.alias("years"))


def shot_images(images: DataFrame) -> DataFrame:
    """Boxes that can be shots (width over 50, height over 100)."""
    return images.where("x1 - x0 > 50 and bottom - top > 100")


def indicator_images(images: DataFrame) -> DataFrame:
    """Boxes that can be team indicators: small and nearly square."""
    w, h = F.col("x1") - F.col("x0"), F.col("bottom") - F.col("top")
    return images.where((w > 15) & (w < 55) & (h > 15) & (h < 55) & (F.abs(w - h) < 10))


def crop_boxes(images: DataFrame) -> DataFrame:
    """Pixel boxes at 300 dpi of boxes in points."""
    return images.withColumns({f"{c}_px": (F.col(c) * SCALE).cast("int") for c in ("x0", "top", "x1", "bottom")})


def grid_rows(images: DataFrame) -> DataFrame:
    """Row (0-2) and column of each of a page's boxes when they form a 6-6-4 grid; other pages stay without.

    Rows are cut at the two largest vertical gaps.  A row with one box too many
    loses the one whose absence leaves the most even spacing.
    """
    w = Window.partitionBy("page_id").orderBy("top", "x0", "image_id")
    g = images.withColumns({"i": F.row_number().over(w) - 1, "gap": F.lead("top").over(w) - F.col("top")})
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc_nulls_last("gap"), "i"))
    g = g.withColumn("cut", F.when(F.col("gap").isNotNull() & (rank <= 2), 1).otherwise(0))
    g = g.withColumn("row", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    g = g.withColumn("row", F.coalesce("row", F.lit(0)).cast("int"))
    rows = g.groupBy("page_id", "row").agg(F.array_sort(F.collect_list(F.struct("x0", "image_id"))).alias("boxes"))
    want = F.when(F.col("row") < 2, 6).otherwise(4)
    drop = F.transform(F.sequence(F.lit(0), F.size("boxes") - 1), lambda k: F.struct(_unevenness(F.filter("boxes", lambda b, i: i != k)).alias("v"), k.alias("k")))
    best = F.array_min(drop).k
    boxes = F.when(F.size("boxes") == want, F.col("boxes")).when(F.size("boxes") == want + 1, F.filter("boxes", lambda b, i: i != best))
    rows = rows.withColumn("boxes", boxes)
    good = rows.groupBy("page_id").agg((F.coalesce(F.sum(F.size("boxes")), F.lit(0)) == 16).alias("whole"))
    return rows.join(good.where("whole"), "page_id").select("page_id", "row", F.posexplode("boxes").alias("col", "b")).select("page_id", "row", "col", "b.image_id")


def _unevenness(boxes: Column) -> Column:
    """Sum of squared differences of the spacings from their mean."""
    gaps = F.zip_with(F.slice(boxes, F.lit(2), F.size(boxes) - 1), F.slice(boxes, F.lit(1), F.size(boxes) - 1), lambda b, a: b.x0 - a.x0)
    mean = F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x) / F.size(gaps)
    return F.aggregate(gaps, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))


def words_to_shots(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """Ordered words of each of a page's 16 shots, for ``shot_metadata``.

    ``words`` has page_id, word_no, x0, top, text; ``boxes`` has page_id, shot
    (0-15), x0, x1, bottom.  A row's name line lies from 2 above its boxes'
    bottom to 6 below, its type line from there to 25 below; a word belongs to
    the first line, and then to the first box (5 wider on both sides), that it
    fits.
    """
    row = F.when(F.col("shot") < 6, 0).when(F.col("shot") < 12, 1).otherwise(2)
    b = boxes.withColumn("row", row)
    bands = b.where(F.col("shot").isin(0, 6, 12)).select("page_id", "row", F.col("bottom").alias("edge"))
    d = F.col("top") - F.col("edge")
    line = words.join(bands, "page_id").where((d >= -2) & (d <= 25)).withColumn("is_type", d > 6)
    first = F.row_number().over(Window.partitionBy("page_id", "word_no").orderBy("is_type", "row"))
    line = line.withColumn("k", first).where("k = 1").drop("k", "edge")
    fit = line.alias("w").join(b.select("page_id", "row", "shot", F.col("x0").alias("left"), F.col("x1").alias("right")), ["page_id", "row"]).where("x0 >= left - 5 and x0 <= right + 5")
    fit = fit.withColumn("k", F.row_number().over(Window.partitionBy("page_id", "word_no").orderBy("shot"))).where("k = 1")
    return fit.groupBy("page_id", "shot").agg(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "is_type", "text"))), lambda x: F.struct(x.is_type.alias("is_type"), x.text.alias("text"))).alias("words"))
