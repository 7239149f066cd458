"""Commands over small wide tables, end to end."""

import json

from pyspark.sql import functions as F

from rinkflow import schemas
from rinkflow.__main__ import main


def _raw(spark, path):
    want = [x.split()[0] for x in schemas.shots_raw().split(", ")]
    rows = []
    for shot, places in enumerate([[(0.1, 0.2)], [(0.1, 0.21), (0.8, 0.0)], [(0.1, 0.21)]], 1):
        row = dict.fromkeys(want) | {"event_id": 1, "match_id": 1, "end_number": 1, "shot_number": shot, "team_code": "A", "shot_type": "Draw", "accuracy": "75", "team1_stones_in_play": 12 if shot == 2 else len(places), "team2_stones_in_play": 0, "team1_ghosts_in_play": int(shot == 3)}
        for k, (x, y) in enumerate(places, 1):
            row |= {f"team1_stone{k}_x": x, f"team1_stone{k}_y": y, f"team1_stone{k}_dist": 0.5, f"team1_stone{k}_angle": 10.0}
        if shot == 3:
            row |= {"team1_ghost1_x": 0.8, "team1_ghost1_y": 0.01}
        rows.append(tuple(row[c] for c in want))
    spark.createDataFrame(rows, schemas.shots_raw()).write.parquet(path)


def test_track_verify_enrich_samples(spark, tmp_path, capsys):
    t = str(tmp_path)
    _raw(spark, f"{t}/raw.parquet")
    assert main(["track", f"{t}/raw.parquet", f"{t}/tracked", "--evaluate"]) == 0
    assert "spurious_id_rate" in capsys.readouterr().out
    got = {r.shot_number: r for r in spark.read.parquet(f"{t}/tracked.parquet").collect()}
    assert got[2].team1_stone1_id == 1 and got[2].team1_stone2_id == 2 and got[2].team1_stone2_is_shot_stone == 1.0
    assert got[3].team1_ghost1_stone_id == 2 and got[1].team1_stone1_prev_x is None
    assert list(got[1].asDict())[:4] == ["event_id", "match_id", "end_number", "shot_number"]
    assert main(["verify", f"{t}/tracked.parquet"]) == 0
    assert main(["verify", f"{t}/tracked.parquet", "--event", "9"]) == 1
    spark.createDataFrame([(1, 1, 1, "A", "B", 0, 0, "1", "0", 1, 0, "A", "", "")], schemas.ENDS).coalesce(1).write.option("header", True).csv(f"{t}/ends.csv")
    spark.createDataFrame([(1, "e", 2024, None, "m", None, True)], schemas.EVENTS).write.option("header", True).csv(f"{t}/events.csv")
    assert main(["enrich", f"{t}/tracked.parquet", f"{t}/ends.csv", f"{t}/enriched.parquet"]) == 0
    assert spark.read.parquet(f"{t}/enriched.parquet").where("shooting_team_has_hammer").count() == 3
    assert main(["samples", f"{t}/enriched.parquet", f"{t}/ends.csv", f"{t}/events.csv", f"{t}/samples"]) == 0
    s = spark.read.parquet(f"{t}/samples")
    assert s.count() == 3 and s.where("split = 'val'").count() == 3
    assert s.where("shot_number = 2").select(F.size("x_t").alias("n"), F.size("x_prev").alias("p"), F.size("edges_t").alias("e")).first() == (2, 1, 2)


def test_regress(spark, tmp_path, capsys):
    (tmp_path / "now.json").write_text(json.dumps({"results": [{"filename": "a", "f1": 90.0}]}))
    (tmp_path / "was.json").write_text(json.dumps({"thresholds": {"max_f1_regression": 20.0}, "results": [{"filename": "a", "f1": 99.0}]}))
    assert main(["regress", str(tmp_path / "now.json"), str(tmp_path / "was.json")]) == 0
    assert "min_f1" in capsys.readouterr().out


def test_results_commands(spark, sf_dir, tmp_path, capsys):
    """Detections to figures, figures merged with a baseline and printed."""
    from rinkflow import catalog

    v = catalog.Views(spark, sf_dir)
    for name, df in (("truth", v.truth), ("found", v.detected)):
        df.where("event_id = 3").write.parquet(f"{tmp_path}/{name}.parquet")
    assert main(["evaluate", f"{tmp_path}/truth.parquet", f"{tmp_path}/found.parquet", f"{tmp_path}/records"]) == 0
    figures = json.loads((tmp_path / "records.json").read_text())["results"]
    assert len(figures) == 1 and figures[0]["filename"] == "records" and 0 < figures[0]["f1"] < 100
    (tmp_path / "old.json").write_text(json.dumps({"thresholds": {"min_f1": 90.0}, "results": [{"filename": "records", "f1": 50.0}, {"filename": "other", "f1": 70.0, "ghost_recall": 60.0}]}))
    assert main(["baseline", f"{tmp_path}/records.json", f"{tmp_path}/old.json", f"{tmp_path}/new.json"]) == 0
    new = json.loads((tmp_path / "new.json").read_text())
    assert new["thresholds"] == {"min_f1": 90.0}
    assert {r["filename"]: r["f1"] for r in new["results"]} == {"other": 70.0, "records": figures[0]["f1"]}
    capsys.readouterr()
    assert main(["metrics", f"{tmp_path}/new.json"]) == 0
    said = capsys.readouterr().out
    assert "| other | 70.0000 |" in said and "avg_f1" in said


def test_board_compare_and_train(spark, sf_dir, tmp_path, capsys):
    from rinkflow import catalog
    from rinkflow.operators import features, graph, reshape
    from rinkflow.sources import images, tables

    v = catalog.Views(spark, sf_dir)
    some = v.boards.where("match_id % 40 = 1")
    wide = reshape.long_to_wide(catalog._stones(v).where("match_id % 40 = 1"), some)
    wide.write.parquet(f"{tmp_path}/wide.parquet")
    assert main(["compare", f"{tmp_path}/wide.parquet"]) == 0
    assert "link_agreement_rate" in capsys.readouterr().out
    shot = wide.where("team1_stones_in_play > 1").first()
    assert main(["board", f"{tmp_path}/wide.parquet", *(str(shot[k]) for k in ("event_id", "match_id", "end_number", "shot_number")), f"{tmp_path}/board.png"]) == 0
    image = images.read_png((tmp_path / "board.png").read_bytes())
    assert image.shape == (*images.extent()[::-1], 3) and (image != images.house()).any()
    shots = features.load_and_filter(features.enrich(v.counted, v.known_ends).drop("team1_code", "team2_code"), v.known_ends, v.events)
    samples = graph.samples(shots.where("match_id % 40 = 1"), v.known, v.events).withColumn("split", F.when(F.col("end_number") == 1, "val").otherwise("train"))
    tables.write_samples(samples, f"{tmp_path}/samples")
    assert main(["train", f"{tmp_path}/samples", f"{tmp_path}/history.json", "--epochs", "1"]) == 0
    assert json.loads((tmp_path / "history.json").read_text())[0]["epoch"] == 1
