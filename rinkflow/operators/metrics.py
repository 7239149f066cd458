"""Quality metrics of tracked stones, each one aggregation over the long form.

``tracked`` has a row per stone (keys, shot, team, slot, x, y, stone_id,
prev_x, prev_y, is_shot_stone); ``boards`` a row per shot.  Rates are null where
they have no denominator, and aren't rounded.  A mid-end shot is one after the
first shot of its end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import COVERAGE_FLOOR, END, LINK_TOLERANCE, NEAR_ZERO, NOISE_DIST, PRESSURE, SHOT, TRACK_DIST, VERDICTS, ZONE_LOW
from ..shared import cut, new_folder, settled


def _rate(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def shot_order(boards: DataFrame) -> DataFrame:
    """Each shot with its place in the end (from 1), the shot before, and the end's number of shots."""
    w = Window.partitionBy(*END).orderBy("shot_number")
    return boards.select(*SHOT).distinct().withColumns({"place": F.row_number().over(w), "before": F.lag("shot_number").over(w), "n_shots": F.count("*").over(Window.partitionBy(*END))})


def placed(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Stones with their shot's place; a tracker that was asked for it has given it."""
    return tracked if "place" in tracked.columns else tracked.join(shot_order(boards), SHOT)


def mid_end(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    return placed(tracked, boards).where("place > 1").drop("place", "before", "n_shots")


def displacement() -> Column:
    dx, dy = F.col("x") - F.col("prev_x"), F.col("y") - F.col("prev_y")
    return F.sqrt(dx * dx + dy * dy)


def evaluate(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """New and spurious identity rates over mid-end shots, in one row."""
    mid = F.col("place") > 1
    shots = shot_order(boards).agg(F.count_if(F.col("place") == 1).alias("total_ends"), F.count_if(mid).alias("shots"))
    stones = placed(tracked, boards).agg(F.count("x").alias("total_stone_appearances"), F.count(F.when(mid, F.col("x"))).alias("occupied"), F.count_if(mid & F.col("prev_x").isNull()).alias("new"))
    return shots.crossJoin(stones).select(  # one row each
        "total_ends",
        "total_stone_appearances",
        _rate("new", "occupied").alias("new_stone_rate_mid_end"),
        _rate("shots", "occupied").alias("expected_new_rate"),
        F.when(F.col("occupied") > 0, F.greatest(F.lit(0.0), _rate(F.col("new") - F.col("shots"), "occupied"))).alias("spurious_id_rate"),
    )


def compare(a: DataFrame, b: DataFrame, boards: DataFrame, names: tuple[str, str] = ("greedy", "optimal")) -> DataFrame:
    """Agreement of two trackings on links, among slots that either links, and the rates of both."""
    keys = [*SHOT, "team", "slot"]
    folder = new_folder(boards.sparkSession, "trackers")
    # each is read twice, from columns, which take far less room than rows do
    a, b = (_kept(placed(t, boards).select(*keys, "x", "prev_x", "prev_y", "place"), f"{folder}/{k}") for k, t in enumerate((a, b)))
    left = mid_end(a, boards).select(*keys, F.col("prev_x").alias("ax"), F.col("prev_y").alias("ay"))
    right = b.select(*keys, F.col("prev_x").alias("bx"), F.col("prev_y").alias("by"))
    either = F.col("ax").isNotNull() | F.col("bx").isNotNull()
    agree = (F.abs(F.col("ax") - F.col("bx")) < LINK_TOLERANCE) & (F.abs(F.col("ay") - F.col("by")) < LINK_TOLERANCE)
    links = left.join(right, keys).where(either).agg(_rate(F.count_if(agree), F.count("*")).alias("link_agreement_rate"))
    rates = [evaluate(t, boards).select(F.col("spurious_id_rate").alias(f"spurious_id_rate_{n}"), F.col("new_stone_rate_mid_end").alias(f"new_stone_rate_mid_end_{n}")) for t, n in zip((a, b), names, strict=True)]
    out = links.crossJoin(rates[0]).crossJoin(rates[1])  # one row each
    return settled(out.withColumn("spurious_id_rate_improvement", F.col(f"spurious_id_rate_{names[0]}") - F.col(f"spurious_id_rate_{names[1]}")), folder)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def displacement_distribution(tracked: DataFrame) -> DataFrame:
    """How far linked stones moved, in one row."""
    d = tracked.select(displacement().alias("d")).where("d is not null")
    zone = (F.col("d") >= ZONE_LOW * TRACK_DIST) & (F.col("d") < TRACK_DIST)
    return d.agg(
        F.count("*").alias("total_links"),
        F.count_if(zone).alias("threshold_zone_count"),
        _rate(F.count_if(zone), F.count("*")).alias("threshold_zone_fraction"),
        _rate(F.count_if(F.col("d") < NEAR_ZERO), F.count("*")).alias("near_zero_fraction"),
        F.median("d").alias("median_displacement"),
        F.percentile("d", F.lit(0.95)).alias("p95_displacement"),
    )


def slot_pairs(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Stones of each slot on a shot whose slot was held on the shot before, with the identity there."""
    w = Window.partitionBy(*END, "team", "slot").orderBy("place")
    pairs = placed(tracked, boards).withColumns({"before_id": F.lag("stone_id").over(w), "held": F.lag("place").over(w)})
    return pairs.where("held = place - 1").drop("held")


def id_continuity(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Share of slots, held on both of two shots and not by the delivered stone, that keep their identity."""
    held = slot_pairs(tracked, boards).where("is_shot_stone is null or is_shot_stone <> 1")
    same = F.coalesce(F.col("stone_id") == F.col("before_id"), F.lit(False))
    return held.agg(F.count("*").alias("total_slot_pairs"), F.count_if(same).alias("preserved"), _rate(F.count_if(same), F.count("*")).alias("id_continuity_rate"))


def stone_continuity(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Share of identities on a board that the next board still has, whatever their slots (an addition)."""
    seen = placed(tracked, boards).where("place < n_shots or place > 1").select(*END, "place", "n_shots", "stone_id").distinct()
    after = F.lead("place").over(Window.partitionBy(*END, "stone_id").orderBy("place"))
    at = seen.withColumn("hit", F.when(F.col("stone_id").isNotNull() & (after == F.col("place") + 1), 1)).where("place < n_shots")
    return at.agg(F.count("*").alias("total_stones"), F.count("hit").alias("kept"), _rate(F.count("hit"), F.count("*")).alias("stone_continuity_rate"))


#: Pairs of a board's slots whose stones changed places with each other.
_SWAPS = """size(filter(flatten(transform(p, a -> transform(p, b ->
  a.slot < b.slot and a.stone_id = b.before_id and b.stone_id = a.before_id and a.stone_id <> b.stone_id))), hit -> hit))"""


def slot_swaps(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Pairs of stones that changed slots with each other between two shots."""
    known = slot_pairs(tracked, boards).where("stone_id is not null and before_id is not null")
    board = known.groupBy(*SHOT, "team").agg(F.collect_list(F.struct("slot", "stone_id", "before_id")).alias("p"))
    swaps = board.agg(F.coalesce(F.sum(F.expr(_SWAPS)), F.lit(0)).cast("bigint").alias("swap_events"))
    pairs = shot_order(boards).agg(F.count("before").alias("total_shot_pairs"))
    return pairs.crossJoin(swaps).withColumn("slot_swap_rate", _rate("swap_events", "total_shot_pairs"))


def cap_pressure(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Share of mid-end new stones whose nearest stone before lies just out of reach."""
    last = Window.partitionBy(*END, "team").orderBy("place").rangeBetween(-1, -1)
    new = placed(tracked, boards).withColumn("was", F.collect_list(F.struct("x", "y")).over(last)).where("prev_x is null and place > 1")
    near = new.select(F.array_min(F.transform("was", lambda s: F.sqrt((F.col("x") - s.x) * (F.col("x") - s.x) + (F.col("y") - s.y) * (F.col("y") - s.y)))).alias("d"))
    close = (F.col("d") >= TRACK_DIST) & (F.col("d") < TRACK_DIST + PRESSURE)
    return near.agg(F.count("*").alias("total_new_id_events"), F.count_if(close).alias("cap_pressure_events"), _rate(F.count_if(close), F.count("*")).alias("cap_pressure_rate"))


def displacement_symmetry(tracked: DataFrame) -> DataFrame:
    """Displacement of delivered against still stones.

    A delivered stone has no previous place, so on tracked stones there is no
    delivered link and the ratio is null.
    """
    d = tracked.withColumn("d", displacement()).where("d is not null")
    shot, still = F.when(F.col("is_shot_stone") == 1, F.col("d")), F.when(F.col("is_shot_stone") == 0, F.col("d"))
    out = d.agg(F.count(shot).alias("shot_stone_links"), F.count(still).alias("still_stone_links"), F.median(shot).alias("shot_stone_median_displacement"), F.median(still).alias("still_stone_median_displacement"), F.percentile(still, F.lit(0.95)).alias("still_stone_p95_displacement"))
    return out.withColumn("separation_ratio", F.try_divide("shot_stone_median_displacement", "still_stone_median_displacement"))


def count_consistency(stones: DataFrame, boards: DataFrame) -> DataFrame:
    """Share of consecutive shots whose stone counts differ by one at most in both teams."""
    n = stones.groupBy(*SHOT).agg(*(F.count_if(F.col("team") == t).alias(f"n{t}") for t in (1, 2)))
    w = Window.partitionBy(*END).orderBy("shot_number")
    counted = boards.select(*SHOT).distinct().join(n, SHOT, "left").na.fill(0, ["n1", "n2"])
    jump = reduce(lambda a, b: a | b, [F.abs(F.col(f"n{t}") - F.lag(f"n{t}").over(w)) > 1 for t in (1, 2)])
    pairs = counted.withColumns({"jump": jump, "paired": F.lag("shot_number").over(w).isNotNull()}).where("paired")
    ends = F.count_distinct(F.when(F.col("jump"), F.struct(*END)))
    return pairs.agg(F.count("*").alias("total_shot_pairs"), F.count_if("jump").alias("inconsistent_pairs"), ends.alias("inconsistent_ends"), (1 - _rate(F.count_if("jump"), F.count("*"))).alias("stone_count_consistency_rate"))


def new_stones(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """New stones on each mid-end shot, none included."""
    mid = shot_order(boards).where("place > 1").select(*SHOT)
    new = tracked.where("prev_x is null").groupBy(*SHOT).agg(F.count("*").alias("n_new"))
    return mid.join(new, SHOT, "left").na.fill(0, ["n_new"])


def delivery_anomaly(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Share of mid-end shots without exactly one new stone."""
    new = placed(tracked, boards).where("place > 1").groupBy(*SHOT).agg(F.count_if(F.col("prev_x").isNull()).alias("n"))
    single = new.agg(F.count_if(F.col("n") == 1).alias("single"))
    shots = shot_order(boards).agg(F.count("before").alias("total_mid_shots"))
    odd = F.col("total_mid_shots") - F.col("single")
    return shots.crossJoin(single).select("total_mid_shots", odd.alias("anomaly_shots"), _rate(odd, "total_mid_shots").alias("delivery_anomaly_rate"))


def delivery_anomaly_examples(tracked: DataFrame, boards: DataFrame, n: int = 5) -> DataFrame:
    return new_stones(tracked, boards).where("n_new <> 1").orderBy(*SHOT).limit(n)


def all_metrics(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """All metrics in one row; the tracked table, which each of them reads, is made once."""
    tracked = cut(tracked)
    rows = [
        evaluate(tracked, boards),
        displacement_distribution(tracked),
        id_continuity(tracked, boards),
        slot_swaps(tracked, boards).drop("total_shot_pairs"),
        cap_pressure(tracked, boards),
        displacement_symmetry(tracked),
        count_consistency(tracked, boards),
        delivery_anomaly(tracked, boards),
    ]
    return reduce(lambda a, b: a.crossJoin(b), rows)  # one row each


def verdicts(metrics: DataFrame) -> DataFrame:
    """(metric, value, threshold, verdict) for each gate: OK, WARN, or - without a value."""
    rows = []
    for name, kind, limit in VERDICTS:
        v = F.col(name).cast("double")
        good = {"max": v <= limit, "min": v >= limit, "below": v < limit}[kind]
        rows.append(F.struct(F.lit(name).alias("metric"), v.alias("value"), F.lit(float(limit)).alias("threshold"), F.when(v.isNull(), "-").when(good, "OK").otherwise("WARN").alias("verdict")))
    return metrics.select(F.inline(F.array(*rows)))


def fragmentation(tracked: DataFrame, boards: DataFrame) -> DataFrame:
    """Identities used over the largest number in play, by end and team, and new-stone rates."""
    at = placed(tracked, boards).withColumn("n", F.count("*").over(Window.partitionBy(*SHOT, "team")))
    mid = F.col("place") > 1
    out = at.groupBy(*END, "team").agg(
        F.size(F.collect_set("stone_id")).cast("bigint").alias("ids_assigned"), F.count_if(mid).alias("total_mid"), F.count_if(mid & F.col("prev_x").isNull()).alias("new_mid"),
        F.max("n").alias("min_ids"), F.max("n_shots").alias("n_shots"),
    )
    out = out.withColumns({"frag": _rate("ids_assigned", "min_ids"), "new_rate": _rate("new_mid", "total_mid")})
    f = F.col("frag")
    bucket = F.when(f <= 1.05, "1.0 (perfect)").when(f <= 1.5, "1.01-1.5").when(f <= 2.0, "1.51-2.0").when(f <= 3.0, "2.01-3.0").otherwise(">3.0")
    return out.withColumn("frag_bucket", bucket)


def describe_fragmentation(frag: DataFrame) -> DataFrame:
    """(measure, key, n, value): count, mean, deviation and quartiles of ``frag``, buckets, and means by end and by length."""
    one = frag.agg(F.count("frag").alias("n"), F.avg("frag").alias("mean"), F.stddev_samp("frag").alias("std"), F.min("frag").alias("min"), F.percentile("frag", F.lit(0.25)).alias("p25"), F.median("frag").alias("p50"), F.percentile("frag", F.lit(0.75)).alias("p75"), F.max("frag").alias("max"))
    cells = F.array(*(F.struct(F.lit("describe").alias("measure"), F.lit(c).alias("key"), F.col("n"), F.col(c).alias("value")) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")))
    out = one.select(F.inline(cells))
    for name, key in (("bucket", "frag_bucket"), ("end_number", "end_number"), ("n_shots", "n_shots")):
        out = out.unionByName(frag.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"), F.avg("frag").alias("value")).select(F.lit(name).alias("measure"), "key", "n", "value"))
    return out


def worst_fragmentation(frag: DataFrame, n: int = 20) -> DataFrame:
    """The ends with most identities for their stones, above three."""
    return frag.where("frag > 3").orderBy(F.desc("frag"), *END, "team").limit(n)


# ---- checks ---------------------------------------------------------------


def check_first_shot(tracked: DataFrame, column: str = "prev_x") -> DataFrame:
    """Slots that hold a previous place on an end's shot 1, with their number."""
    return tracked.where((F.col("shot_number") == 1) & F.col(column).isNotNull()).groupBy("team", "slot").agg(F.count("*").alias("n_violations"))


def check_coverage(tracked: DataFrame) -> DataFrame:
    """Percentage of stones of later shots that are linked, and the verdict."""
    later = tracked.where("shot_number > 1")
    pct = _rate(F.lit(100) * F.count("prev_x"), F.count("x"))
    out = later.agg(F.count("prev_x").alias("linked"), F.count("x").alias("present"), pct.alias("coverage_pct"))
    return out.withColumn("verdict", F.when(F.col("present") == 0, "SKIP").when(F.col("coverage_pct") < COVERAGE_FLOOR, "WARN").otherwise("PASS"))


def check_id_uniqueness(tracked: DataFrame) -> DataFrame:
    """Identities that both teams use in an end."""
    return tracked.where("stone_id is not null").groupBy(*END, "stone_id").agg(F.count_distinct("team").alias("n_teams")).where("n_teams > 1")


def check_id_gaps(tracked: DataFrame) -> DataFrame:
    """Identities that vanish and come back: places where consecutive shots of one differ by more than 1."""
    w = Window.partitionBy(*END, "team", "stone_id").orderBy("shot_number")
    seen = tracked.where("stone_id is not null").select(*SHOT, "team", "stone_id").distinct()
    return seen.withColumn("gap", F.col("shot_number") - F.lag("shot_number").over(w)).where("gap > 1")


def check_displacement(tracked: DataFrame) -> DataFrame:
    """Links of later shots over the noise distance, by slot, with the largest."""
    d = tracked.where("shot_number > 1").withColumn("d", displacement()).where(F.col("d") > NOISE_DIST)
    return d.groupBy("team", "slot").agg(F.count("*").alias("n_suspicious"), F.max("d").alias("max_displacement"))


def check_new_stones(tracked: DataFrame) -> DataFrame:
    """Later shots on which a team has more than one new stone."""
    return tracked.where("shot_number > 1 and prev_x is null").groupBy(*SHOT, "team").agg(F.count("*").alias("n_new")).where("n_new > 1")


def displacement_histogram(tracked: DataFrame, width: int = 30) -> DataFrame:
    """Six bins, closed on the left, with counts (zeros too) and a bar of up to ``width`` signs."""
    edges = [(0.0, 0.01), (0.01, 0.02), (0.02, 0.03), (0.03, 0.05), (0.05, 0.13), (0.13, None)]
    d = tracked.where("shot_number > 1").select(displacement().alias("d")).where("d is not null")
    counts = d.agg(*(F.count_if((F.col("d") >= a) & (F.col("d") < b if b else F.lit(True))).alias(f"n{i}") for i, (a, b) in enumerate(edges)))
    rows = F.array(*(F.struct(F.lit(i).alias("bin"), F.lit(a).alias("low"), F.lit(b).cast("double").alias("high"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(edges)))
    top = F.greatest(*(F.col(f"n{i}") for i in range(len(edges))), F.lit(1))
    return counts.select(top.alias("top"), F.inline(rows)).select("bin", "low", "high", "n", F.repeat(F.lit("#"), F.floor(F.col("n") * width / F.col("top")).cast("int")).alias("bar"))


def displacement_stats(tracked: DataFrame) -> DataFrame:
    d = tracked.where("shot_number > 1").select(displacement().alias("d")).where("d is not null")
    return d.agg(F.count("d").alias("n"), F.avg("d").alias("mean"), F.median("d").alias("median"), F.percentile("d", F.lit(0.95)).alias("p95"), F.max("d").alias("max"))


def run_checks(tracked: DataFrame) -> DataFrame:
    """(check, n, verdict) for all checks and, last, the overall one: FAIL, PASS WITH WARNINGS or PASS."""
    tracked = cut(tracked)
    parts = [
        ("first_shot_invariant", check_first_shot(tracked), F.coalesce(F.sum("n_violations"), F.lit(0)), "FAIL"),
        ("id_uniqueness", check_id_uniqueness(tracked), F.count("*"), "FAIL"),
        ("id_continuity", check_id_gaps(tracked), F.count("*"), "WARN"),
        ("matched_displacement", check_displacement(tracked), F.coalesce(F.sum("n_suspicious"), F.lit(0)), "WARN"),
        ("new_stone_count", check_new_stones(tracked), F.count("*"), "WARN"),
    ]
    rows = [df.agg(n.cast("bigint").alias("n")).select(F.lit(name).alias("check"), "n", F.when(F.col("n") > 0, bad).otherwise("PASS").alias("verdict")) for name, df, n, bad in parts]
    cover = check_coverage(tracked).select(F.lit("coverage").alias("check"), F.col("linked").alias("n"), "verdict")
    rows.append(cover)
    table = reduce(lambda a, b: a.unionByName(b), rows)
    overall = F.when(F.count_if(F.col("verdict") == "FAIL") > 0, "FAIL").when(F.count_if(F.col("verdict") == "WARN") > 0, "PASS WITH WARNINGS").otherwise("PASS")
    return table.unionByName(table.agg(F.lit("overall").alias("check"), F.count_if(F.col("verdict").isin("FAIL", "WARN")).alias("n"), overall.alias("verdict")))


def passes(tracked: DataFrame) -> bool:
    """False if the table lacks columns, is empty or fails a check."""
    if any(c not in tracked.columns for c in (*SHOT, "team", "slot", "x", "stone_id", "prev_x", "prev_y")) or tracked.isEmpty():
        return False
    return run_checks(tracked).where("check = 'overall'").first()["verdict"] != "FAIL"
