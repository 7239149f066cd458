"""Stone detection after pixels: blobs to stones, matching against ground truth, and its figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    AREA_MAX, AREA_MIN, DEDUP_RADIUS, FILL_RATIO, GT_AREA_FACTOR, HOUSE_CX, HOUSE_CY, HOUSE_RADIUS, HUE_HALF, HUE_PIXELS, HUE_SATURATION, HUE_VALUE,
    MATCH_RADIUS, PLAY_TOP, RADIUS_BAND, REGRESSION, RING_PIXELS, SHOT, STATIC_HUES,
)
from ..functions.geometry import polar, to_board

COLOUR = [*SHOT, "colour"]


def classify_blobs(blobs: DataFrame, house: DataFrame, permissive: bool = False) -> DataFrame:
    """Blobs of fitting area with their board place and whether they are outlines (ghosts).

    The area window grows with the square of the house's radius.  ``permissive``
    is the rule of ground truth: from half the least area, without a largest
    one, and without the strip at the top.
    """
    b = blobs.join(house, SHOT)
    scale = (F.col("radius") / HOUSE_RADIUS) * (F.col("radius") / HOUSE_RADIUS)
    if permissive:
        b = b.where((F.col("area") >= GT_AREA_FACTOR * AREA_MIN * scale) & (F.col("sy") >= PLAY_TOP))
    else:
        b = b.where((F.col("area") > AREA_MIN * scale) & (F.col("area") < AREA_MAX * scale))
    x, y = to_board(F.col("sx"), F.col("sy"), F.col("orientation"), F.col("cx"), F.col("cy"), F.col("radius"))
    b = b.withColumns({"x": x, "y": y})
    dist, angle = polar(F.col("x"), F.col("y"))
    return b.select(*COLOUR, "x", "y", dist.alias("dist"), angle.alias("angle"), (F.col("colored_px") / F.col("area") < FILL_RATIO).alias("is_ghost"))


def deduplicate(stones: DataFrame, radius: float = DEDUP_RADIUS) -> DataFrame:
    """Stones from the centre out, without those within ``radius`` of one kept before; slots number the rest."""
    row = F.struct("dist", "x", "y", "angle")
    kept = F.aggregate(
        F.array_sort(F.collect_list(row)),
        F.expr("cast(array() as array<struct<dist:double,x:double,y:double,angle:double>>)"),
        lambda acc, s: F.when(F.exists(acc, lambda k: F.sqrt((s.x - k.x) * (s.x - k.x) + (s.y - k.y) * (s.y - k.y)) < radius), acc).otherwise(F.array_append(acc, s)),
    )
    return stones.groupBy(*COLOUR).agg(kept.alias("k")).select(*COLOUR, F.posexplode("k").alias("slot", "s")).select(*COLOUR, (F.col("slot") + 1).alias("slot"), "s.x", "s.y", "s.dist", "s.angle")


_PAIRS = f"""
aggregate(
  array_sort(filter(flatten(transform(gt, (g, i) -> transform(det, (c, j) ->
    named_struct('d', sqrt((c.x - g.x) * (c.x - g.x) + (c.y - g.y) * (c.y - g.y)), 'gt', i, 'det', j)))), q -> q.d < {MATCH_RADIUS}D)),
  cast(array() as array<struct<d:double,gt:int,det:int>>),
  (m, q) -> if(exists(m, z -> z.gt = q.gt or z.det = q.det), m, array_append(m, q)))
"""


def match_sets(truth: DataFrame, found: DataFrame, keys: list[str], places: bool = False) -> DataFrame:
    """Greedy one-to-one pairs within ``MATCH_RADIUS``, by group: pairs, n_gt, n_det, tp, fp, fn.

    Rows are numbered by (dist, x, y) in each group; with ``places`` the numbered
    rows gt and det come along.
    """
    row = F.struct("dist", "x", "y")
    both = truth.select(*keys, row.alias("g"), F.lit(None).cast("struct<dist:double,x:double,y:double>").alias("c")).unionByName(found.select(*keys, F.lit(None).cast("struct<dist:double,x:double,y:double>").alias("g"), row.alias("c")))
    sets = both.groupBy(*keys).agg(F.array_sort(F.collect_list("g")).alias("gt"), F.array_sort(F.collect_list("c")).alias("det"))
    out = sets.select(*keys, *(("gt", "det") if places else ()), F.size("gt").cast("bigint").alias("n_gt"), F.size("det").cast("bigint").alias("n_det"), F.expr(_PAIRS).alias("pairs"))
    tp = F.size("pairs").cast("bigint")
    return out.withColumns({"tp": tp, "fp": F.col("n_det") - tp, "fn": F.col("n_gt") - tp})


def crop_records(truth: DataFrame, found: DataFrame) -> DataFrame:
    """One record per shot from stones with colour and is_ghost: counts and position errors."""
    m = match_sets(truth, found, [*COLOUR, "is_ghost"])
    live = ~F.col("is_ghost")

    def total(c: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))

    errors = F.flatten(F.collect_list(F.when(live, F.transform("pairs", lambda p: p.d))))
    cells = []
    for side, c in (("gt", "n_gt"), ("det", "n_det")):
        for colour in ("red", "yellow"):
            cells += [total(c, live & (F.col("colour") == colour)).alias(f"{side}_{colour}"), total(c, ~live & (F.col("colour") == colour)).alias(f"{side}_ghost_{colour}")]
    cells += [total(c, live).alias(c) for c in ("tp", "fp", "fn")] + [total(c, ~live).alias(f"{c}_ghost") for c in ("tp", "fp", "fn")]
    rows = m.groupBy(*SHOT).agg(*cells, errors.alias("errors"))
    e = rows.select(*SHOT, F.explode("errors").alias("e")).groupBy(*SHOT).agg(F.median("e").alias("pos_err_median"), F.percentile("e", F.lit(0.95)).alias("pos_err_p95"))
    return rows.drop("errors").join(e, SHOT, "left")


def aggregate_records(records: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall and F1 in percent, and position errors over the shots' medians."""
    s = records.groupBy(*by).agg(
        F.count("*").alias("shots_evaluated"),
        F.sum(F.col("gt_red") + F.col("gt_yellow")).alias("total_gt_stones"),
        F.sum(F.col("det_red") + F.col("det_yellow")).alias("total_det_stones"),
        *(F.sum(c).alias(f"total_{c}") for c in ("tp", "fp", "fn", "tp_ghost", "fp_ghost", "fn_ghost")),
        F.count_if(F.col("fp") > 0).alias("shots_with_fp"),
        F.count_if(F.col("fn") > 0).alias("shots_with_fn"),
        F.median("pos_err_median").alias("pos_err_median_norm"),
        F.percentile("pos_err_median", F.lit(0.95)).alias("pos_err_p95_norm"),
    )

    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(a) + F.col(b), F.lit(1))

    p, r = share("total_tp", "total_fp"), share("total_tp", "total_fn")
    return s.withColumns({
        "precision": p * 100,
        "recall": r * 100,
        "f1": F.when(p + r > 0, 200 * p * r / (p + r)).otherwise(F.lit(0.0)),
        "ghost_precision": share("total_tp_ghost", "total_fp_ghost") * 100,
        "ghost_recall": share("total_tp_ghost", "total_fn_ghost") * 100,
    })


def macro_average(results: DataFrame) -> DataFrame:
    return results.agg(*(F.avg(c).alias(f"avg_{c}") for c in ("f1", "precision", "recall")))


def regressions(current: DataFrame, baseline: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """(filename, kind, rule, value) for each rule that a file breaks, and for new files.

    Both tables have filename, f1, ghost_recall and pos_err_p95_norm.
    """
    t = REGRESSION | (limits or {})
    names = ["f1", "ghost_recall", "pos_err_p95_norm"]
    base = baseline.select("filename", *(F.col(c).alias(f"base_{c}") for c in names), F.lit(True).alias("known"))
    j = current.join(base, "filename", "left")
    f1_drop, ghost_drop = F.col("base_f1") - F.col("f1"), F.col("base_ghost_recall") - F.col("ghost_recall")
    rules = [
        ("WARN", "min_f1", F.col("f1"), F.col("f1") < t["min_f1"]),
        ("WARN", "min_ghost_recall", F.col("ghost_recall"), F.col("ghost_recall") < t["min_ghost_recall"]),
        ("WARN", "max_pos_err_p95_norm", F.col("pos_err_p95_norm"), F.col("pos_err_p95_norm") > t["max_pos_err_p95_norm"]),
        ("INFO", "new_file", F.lit(None).cast("double"), F.col("known").isNull()),
        ("REGRESSION", "max_f1_regression", f1_drop, f1_drop > t["max_f1_regression"]),
        ("REGRESSION", "max_ghost_recall_regression", ghost_drop, ghost_drop > t["max_ghost_recall_regression"]),
    ]
    hits = F.array(*(F.when(hit, F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), value.cast("double").alias("value"))) for kind, rule, value, hit in rules))
    return j.select("filename", F.inline(F.filter(hits, lambda h: h.isNotNull())))


def merge_baseline(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """New figures over old ones, by file; files of either side stay."""
    c, b = current.alias("c"), baseline.alias("b")
    cols = [x for x in current.columns if x != "filename"]
    return c.join(b, "filename", "full_outer").select("filename", *(F.coalesce(F.col(f"c.{x}"), F.col(f"b.{x}")).alias(x) for x in cols))


def calibrate_house(crops: DataFrame, ring: DataFrame, circles: DataFrame) -> DataFrame:
    """House centre, radius and orientation of each crop, and what they come from.

    ``crops`` has the keys and the crop's height h; ``ring`` pixels of a mask
    (keys, mask 'narrow' or 'broad', px, py); ``circles`` candidates (keys, cx,
    cy, r).  The narrow mask counts if it has ``RING_PIXELS``, else the broad
    one, else the circle nearest to the nominal one, at the top or mirrored at
    the bottom, else the nominal values.  A radius a quarter off is replaced by
    the nominal one.
    """
    mean = ring.groupBy(*SHOT, "mask").agg(F.count("*").alias("n"), F.avg("px").alias("cx"), F.avg("py").alias("cy")).where(F.col("n") >= RING_PIXELS)
    far = ring.join(mean, [*SHOT, "mask"]).withColumn("r", F.hypot(F.col("px") - F.col("cx"), F.col("py") - F.col("cy")))
    masks = far.groupBy(*SHOT, "mask", "cx", "cy").agg(F.median("r").alias("r"))
    by_mask = masks.groupBy(*SHOT).agg(*(F.max(F.when(F.col("mask") == m, F.struct("cx", "cy", "r"))).alias(m) for m in ("narrow", "broad")))
    mirrored = F.least(F.abs(F.col("cy") - HOUSE_CY), F.abs(F.col("cy") - (F.col("h") - HOUSE_CY)))
    score = F.abs(F.col("r") - HOUSE_RADIUS) + 0.25 * F.abs(F.col("cx") - HOUSE_CX) + 0.25 * mirrored
    nearest = circles.join(crops.select(*SHOT, "h"), SHOT).groupBy(*SHOT).agg(F.min(F.struct(score.alias("score"), "cx", "cy", "r")).alias("circle"))
    out = crops.select(*SHOT, "h").join(by_mask, SHOT, "left").join(nearest, SHOT, "left")
    none = F.struct(F.lit(HOUSE_CX).alias("cx"), F.lit(HOUSE_CY).alias("cy"), F.lit(HOUSE_RADIUS).alias("r"))
    circle = F.when(F.col("circle").isNotNull(), F.struct(F.col("circle.cx"), F.col("circle.cy"), F.col("circle.r")))
    found = F.coalesce("narrow", "broad", circle, none)
    source = F.when(F.col("narrow").isNotNull(), "narrow").when(F.col("broad").isNotNull(), "broad").when(F.col("circle").isNotNull(), "circle").otherwise("fixed")
    out = out.select(*SHOT, "h", found.alias("f"), source.alias("source"))
    radius = F.when(F.abs(F.col("f.r") / HOUSE_RADIUS - 1) <= RADIUS_BAND, F.col("f.r")).otherwise(F.lit(HOUSE_RADIUS))
    side = F.when((F.col("source") == "fixed") | (F.col("f.cy") <= F.col("h") / 2), "top").otherwise("bottom")
    return out.select(*SHOT, F.col("f.cx").alias("cx"), F.col("f.cy").alias("cy"), radius.alias("radius"), side.alias("orientation"), "source")


def hue_windows(pages: DataFrame, pixels: DataFrame) -> DataFrame:
    """(page_id, colour, part, low, high): windows of hues of each page's stones, from its indicators' pixels.

    ``pixels`` has page_id, indicator, hue (0-180), sat, val.  An indicator with
    enough saturated and bright pixels is yellow or red by their median hue; a
    page's window lies around the median of its indicators.  Red has two parts,
    as its hues wrap around.  A colour without indicators has its fixed windows.
    """
    good = pixels.where((F.col("sat") >= HUE_SATURATION) & (F.col("val") >= HUE_VALUE))
    one = good.groupBy("page_id", "indicator").agg(F.count("*").alias("n"), F.median("hue").alias("m")).where(F.col("n") >= HUE_PIXELS)
    colour = F.when(F.col("m").between(10, 50), "yellow").when((F.col("m") <= 15) | (F.col("m") >= 165), "red")
    mid = one.withColumn("colour", colour).where("colour is not null").groupBy("page_id").pivot("colour", ["red", "yellow"]).agg(F.median("m"))
    j = pages.select("page_id").join(mid, "page_id", "left")

    def edge(c: str, sign: int) -> Column:
        return (F.col(c) + sign * HUE_HALF).cast("int")

    def window(c: str, part: int, low: Column, high: Column) -> Column:
        fixed = STATIC_HUES[c, part]
        return F.struct(F.lit(c).alias("colour"), F.lit(part).alias("part"), F.coalesce(low, F.lit(fixed[0])).alias("low"), F.coalesce(high, F.lit(fixed[1])).alias("high"))

    low, high = edge("red", -1), edge("red", 1)
    known = F.col("red").isNotNull()
    rows = [
        window("red", 1, F.when(known, F.greatest(F.lit(0), low)), F.when(known, F.least(F.lit(180), high))),
        window("red", 2, F.when(low < 0, 180 + low).when(high > 180, 0), F.when(low < 0, 180).when(high > 180, high - 180)),
        window("yellow", 1, F.when(F.col("yellow").isNotNull(), F.greatest(F.lit(0), edge("yellow", -1))), F.when(F.col("yellow").isNotNull(), F.least(F.lit(180), edge("yellow", 1)))),
    ]
    return j.select("page_id", F.inline(F.array(*rows)))
