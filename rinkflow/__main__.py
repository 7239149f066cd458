"""Command line: python -m rinkflow COMMAND ...  Paths may be anything that Spark reads."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .constants import MIN_YEAR, SHOT
from .operators import detection, features, graph, metrics, reshape, tracking, training
from .sources import images, pages, tables


def _boards(wide: DataFrame) -> DataFrame:
    return wide.select(*SHOT).distinct()


def track_wide(raw: DataFrame, method: str = "greedy") -> DataFrame:
    """The wide tracked table: the raw columns, identities, previous places, flags, and ghosts' identities."""
    boards = _boards(raw)
    stones = reshape.wide_to_long(raw)
    tracked = tracking.track(stones, boards, method)
    wide = reshape.long_to_wide(tracked.select(*SHOT, "team", "slot", "stone_id", "prev_x", "prev_y", "is_shot_stone"), boards)
    out = raw.join(wide.select(*SHOT, *(c for c in wide.columns if "_stone" in c and not c.endswith("_in_play"))), SHOT, "left")
    if "team1_ghosts_in_play" in raw.columns:
        ghosts = tracking.match_ghosts(reshape.wide_to_long(raw, "ghost"), tracked, boards)
        g = reshape.long_to_wide(ghosts.withColumn("ghost_id", F.col("stone_id").cast("double")).drop("stone_id"), boards, "ghost")
        g = g.select(*SHOT, *(F.col(c).alias(c.replace("_ghost_id", "_stone_id")) for c in g.columns if c.endswith("_ghost_id")))
        out = out.join(g, SHOT, "left")
    return out.select(*tables.tracked_columns(out.columns))


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rinkflow")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("track", help="identities of stones in a wide table")
    c.add_argument("input")
    c.add_argument("output", help="without suffix: .parquet and .csv are written")
    c.add_argument("--method", choices=sorted(tracking.METHODS), default="greedy")
    c.add_argument("--evaluate", action="store_true")
    c = sub.add_parser("verify", help="checks of a tracked wide table; exit code 1 if they fail")
    c.add_argument("input")
    c.add_argument("--event", type=int)
    c.add_argument("--match", type=int)
    c = sub.add_parser("enrich", help="game context on shots")
    c.add_argument("shots")
    c.add_argument("ends")
    c.add_argument("output")
    c = sub.add_parser("samples", help="graph samples by split")
    c.add_argument("shots", help="tracked and enriched wide table")
    c.add_argument("ends")
    c.add_argument("events")
    c.add_argument("output")
    c = sub.add_parser("regress", help="results against a baseline, both JSON")
    c.add_argument("current")
    c.add_argument("baseline")
    c = sub.add_parser("evaluate", help="detected stones against true ones: records, and figures as JSON")
    c.add_argument("truth", help="keys, colour, is_ghost, x, y, dist")
    c.add_argument("detected")
    c.add_argument("output", help="folder of the records; .json beside it has the figures")
    c = sub.add_parser("metrics", help="figures of results files as Markdown, with their means")
    c.add_argument("results")
    c = sub.add_parser("baseline", help="new results over a baseline's, both JSON")
    c.add_argument("current")
    c.add_argument("baseline")
    c.add_argument("output")
    c = sub.add_parser("compare", help="two trackers on a wide table")
    c.add_argument("input")
    c = sub.add_parser("board", help="a shot's board as PNG")
    c.add_argument("shots")
    c.add_argument("keys", type=int, nargs=4, metavar="KEY", help="event, match, end, shot")
    c.add_argument("output")
    c = sub.add_parser("train", help="fit the model on samples and write its figures by epoch")
    c.add_argument("samples")
    c.add_argument("output")
    c.add_argument("--epochs", type=int, default=30)
    c = sub.add_parser("links", help="books and summaries of saved result pages")
    c.add_argument("html")
    c.add_argument("output")
    c.add_argument("--min-year", type=int, default=MIN_YEAR)
    a = p.parse_args(args)
    spark = SparkSession.builder.appName(f"rinkflow {a.command}").getOrCreate()

    if a.command == "track":
        raw = tables.read(spark, a.input, schemas.shots_raw())
        out = track_wide(raw, a.method)
        tables.write_tracked(out, a.output)
        if a.evaluate:
            long = reshape.wide_to_long(spark.read.parquet(f"{a.output}.parquet"))
            print(tables.markdown(metrics.verdicts(metrics.all_metrics(long, _boards(raw)))))
    elif a.command == "verify":
        wide = tables.select_matches(tables.read(spark, a.input, schemas.shots_tracked()), a.event, a.match)
        long = reshape.wide_to_long(wide)
        print(tables.markdown(metrics.run_checks(long)))
        return 0 if metrics.passes(long) else 1
    elif a.command == "enrich":
        shots = tables.read(spark, a.shots, schemas.shots_tracked())
        features.enrich(shots, tables.read_ends(spark, a.ends)).write.mode("overwrite").parquet(a.output)
    elif a.command == "samples":
        shots = spark.read.parquet(a.shots)
        kept = features.load_and_filter(shots, tables.read_ends(spark, a.ends), tables.read(spark, a.events, schemas.EVENTS))
        tables.write_samples(graph.samples(kept, reshape.wide_to_long(shots), tables.read(spark, a.events, schemas.EVENTS)), a.output)
    elif a.command == "regress":
        found = detection.regressions(tables.read_results(spark, a.current), tables.read_results(spark, a.baseline), tables.read_thresholds(spark, a.baseline))
        print(tables.markdown(found))
        return 1 if found.where("kind = 'REGRESSION'").count() else 0
    elif a.command == "evaluate":
        records = detection.crop_records(spark.read.parquet(a.truth), spark.read.parquet(a.detected))
        records.write.mode("overwrite").parquet(a.output)
        figures = detection.aggregate_records(spark.read.parquet(a.output), []).withColumn("filename", F.lit(Path(a.output).name))
        Path(f"{a.output}.json").write_text(tables.baseline_json(figures, {}))
        print(tables.markdown(figures))
    elif a.command == "metrics":
        results = tables.read_results(spark, a.results)
        print(tables.markdown(results))
        print(tables.markdown(results.agg(F.avg("f1").alias("avg_f1"), F.avg("ghost_recall").alias("avg_ghost_recall"))))
    elif a.command == "baseline":
        merged = detection.merge_baseline(tables.read_results(spark, a.current), tables.read_results(spark, a.baseline))
        Path(a.output).write_text(tables.baseline_json(merged.orderBy("filename"), tables.read_thresholds(spark, a.baseline)))
    elif a.command == "compare":
        raw = tables.read(spark, a.input, schemas.shots_raw())
        stones, boards = reshape.wide_to_long(raw), _boards(raw)
        print(tables.markdown(metrics.compare(tracking.track(stones, boards, order=True), tracking.track(stones, boards, "optimal", order=True), boards)))
    elif a.command == "board":
        shot = tables.lookup_shot(tables.read(spark, a.shots, schemas.shots_raw()), *a.keys)
        Path(a.output).write_bytes(images.board_images(reshape.wide_to_long(shot), shot.select(*SHOT)).first().png)
    elif a.command == "train":
        _, history = training.train(tables.read_samples(spark, a.samples), epochs=a.epochs)
        Path(a.output).write_text(json.dumps(history, indent=2))
    else:
        html = pages.read_html(spark, a.html).select(F.xxhash64("path").alias("page_id"), "html")
        tables.write_csv(tables.books(pages.scrape(html).drop("page_id", "row_no"), a.min_year), a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
