"""Game context on shots, and the filters before graphs are built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import END, MIXED_DOUBLES

CONTEXT = ["team1_code", "team2_code", "team1_score_before", "team2_score_before", "hammer_team_code", "team1_time_left", "team2_time_left"]


def number(text: Column) -> Column:
    """A number from text; anything else ('X', '', words) is null."""
    return text.try_cast("double")


def same(a: Column, b: Column) -> Column:
    """Equality that is false, not null, where a side is missing."""
    return F.coalesce(a == b, F.lit(False))


def enrich(shots: DataFrame, ends: DataFrame, end: list[str] = END) -> DataFrame:
    """Context of the end on each shot: hammer, clocks, score before and its difference.

    A shot without an end keeps nulls, but its two booleans are false.  Ends
    must be unique; ``duplicate_ends`` tells.  ``end`` may name further columns
    that an end has one value of, as those that the tables lie by.
    """
    slim = ends.select(*end, *CONTEXT)
    out = shots.join(slim, end, "left")
    out = out.withColumns({
        "shooting_team_is_team1": same(F.col("team_code"), F.col("team1_code")),
        "shooting_team_has_hammer": same(F.col("team_code"), F.col("hammer_team_code")),
        "score_diff_before": F.col("team1_score_before") - F.col("team2_score_before"),
    })
    return out.drop("team1_code", "team2_code")


def duplicate_ends(ends: DataFrame) -> DataFrame:
    return ends.groupBy(*END).agg(F.count("*").alias("n")).where("n > 1")


def load_and_filter(shots: DataFrame, ends: DataFrame, events: DataFrame, end: list[str] = END) -> DataFrame:
    """Shots with the end's scores, without mixed doubles, conceded ends and empty boards."""
    labels = ends.select(*end, "team1_code", "team2_code", *(number(F.col(f"team{t}_score_this_end")).alias(f"team{t}_score_this_end") for t in (1, 2)))
    mixed = events.where(F.col("gender") == MIXED_DOUBLES).select("event_id")
    joined = shots.join(labels, end, "left").join(mixed, "event_id", "left_anti")
    return joined.where("team1_score_this_end is not null").where("team1_stones_in_play + team2_stones_in_play > 0")


def hammer_summary(shots: DataFrame, ends: DataFrame) -> DataFrame:
    """By event: ends played, and how often the team with the hammer won, lost or blanked them."""
    points = [number(F.col(f"team{t}_score_this_end")) for t in (1, 2)]
    mine = F.when(F.col("hammer_team_code") == F.col("team1_code"), points[0] - points[1]).when(F.col("hammer_team_code") == F.col("team2_code"), points[1] - points[0])
    scored = ends.withColumn("margin", mine)
    per_end = scored.groupBy("event_id").agg(
        F.count("*").alias("n_ends"),
        F.count("margin").alias("n_with_hammer"),
        F.count_if(F.col("margin") > 0).alias("hammer_won"),
        F.count_if(F.col("margin") < 0).alias("hammer_stolen"),
        F.count_if(F.col("margin") == 0).alias("blank"),
    )
    per_shot = enrich(shots, ends).groupBy("event_id").agg(F.count("*").alias("n_shots"), F.count_if("shooting_team_has_hammer").alias("shots_with_hammer"))
    return per_shot.join(per_end, "event_id")
