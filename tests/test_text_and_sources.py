"""Parsers on awkward strings; readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from rinkflow import schemas
from rinkflow.functions import geometry, text
from rinkflow.operators import detection, dims, features, graph
from rinkflow.sources import pages, tables

def _one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("r")).first().r


def test_end_line(spark):
    line = "End 7 SUI - Switzerland 1 + 0 (this end) = 1 SWE - Sweden 2 + X (this end) = 3"
    r = _one(spark, f"head\n{line}", text.parse_end_line)
    assert (r.end_number, r.team1_code, r.team2_name, r.team2_score_this_end, r.team2_score_after) == (7, "SUI", "Sweden", "X", 3)
    assert _one(spark, line.replace("End 7 SUI", "End\u00a07\u00a0SUI"), text.parse_end_line).team1_name == "Switzerland"
    assert _one(spark, line.replace("SUI", "ÖST"), text.parse_end_line).team1_code == "ÖST"
    assert _one(spark, "no end", text.parse_end_line) is None
    assert _one(spark, None, text.parse_end_line) is None


def test_header_and_score_box(spark):
    r = _one(spark, "SAT 29 NOV 2025 Gold Medal Game\nSUN 30 NOV 2025 Final\nStart Time 15:00", text.parse_match_header)
    assert (r.date, r.round, r.start_time) == ("SUN 30 NOV 2025", "Final", "15:00")
    assert tuple(_one(spark, "", text.parse_match_header)) == ("", "", "")
    r = _one(spark, "Total Score 1 3\nTime left 11:41 9:27\nTotal Score 4", text.parse_score_box)
    assert (r.total.team1, r.total.team2, r.time_left.team2) == ("1", "3", "9:27")
    assert _one(spark, "Time left 1", text.parse_score_box).time_left.team1 is None


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("World Men's Curling Championship 2024 in Schaffhausen, Switzerland", ("World Men's Curling Championship 2024", "2024", "Schaffhausen, Switzerland")),
        ("Milano Cortina 2026 Olympic Winter Games, Curling in Cortina, Italy", ("Milano Cortina 2026 Olympic Winter Games, Curling", "2026", "Cortina, Italy")),
        ("World Junior-B Curling Championships 2022-2023 in Lohja, Finland", ("World Junior-B Curling Championships 2022-2023", "2022", "Lohja, Finland")),
        ("No year", ("No year", "", "")),
    ],
)
def test_tournament(spark, value, want):
    assert tuple(_one(spark, value, text.parse_tournament)) == want


@pytest.mark.parametrize(
    ("title", "image", "name", "want"),
    [("Results Book Women", "", "", "w"), ("Tournament", "pdf_w.png", "", "m"), ("", "img/pdf_md.png", "", "mxd"), ("", "img/pdf_mx.png", "", "mx"), ("", "", "World Mixed 2020", "mx"), (None, None, "Women's Worlds", "w"), ("", "", "", "")],
)
def test_gender(spark, title, image, name, want):
    df = spark.createDataFrame([(title, image, name)], "a string, b string, c string")
    assert df.select(text.resolve_gender(F.col("a"), F.col("b"), F.col("c")).alias("g")).first().g == want


def test_category_takes_the_first_hit(spark):
    for name, want in [("Youth Olympic Games", "Olympic"), ("World Junior-B", "Junior-B"), ("Paralympic Winter Games", "Olympic" if "olympic" in "paralympic" else "Paralympic"), (None, "Other")]:
        assert _one(spark, name, text.event_category) == want


def test_shot_words(spark):
    words = [(False, "SUI:"), (False, "SCHWARZ"), (False, "B"), (True, "↺75%"), (True, "Raise"), (True, "f"), (True, "and"), (True, "Roll")]
    df = spark.createDataFrame([(words,)], "words array<struct<is_type:boolean,text:string>>").select(text.shot_metadata().alias("m"))
    assert tuple(df.first().m) == ("SUI", "SCHWARZ B", "Raise and Roll", "Counter-clockwise", "75")
    df = spark.createDataFrame([([(True, "Through"), (True, "50%")],)], "words array<struct<is_type:boolean,text:string>>").select(text.shot_metadata().alias("m"))
    assert (df.first().m.turn, df.first().m.accuracy) == ("Not considered", "50")


HTML = """<table id="SearchTable"><tr"><td>World Men's Championship 2024 in Oslo, Norway</td><td></td><td></td>
<td><a title='Results Book Men' href="/ResultsBook_m.pdf"><img src="pdf_m.png"></a><a href="http://x.org/ResultBook_w.pdf" title="Women"></a></td>
<td><a href="/ResultsSummary_old.pdf" title="Men"></a><a href="/ResultsSummary_new.pdf" title="Men"></a></td></tr>
<tr><td>No book 2023 in Bern</td><td></td><td></td><td></td><td></td></tr><tr><th>x</th></tr></table>"""


def test_scrape(spark):
    got = pages.scrape(spark.createDataFrame([(1, HTML), (2, "<p>none</p>"), (3, None)], "page_id bigint, html string")).collect()
    rows = {r.gender: r for r in got}
    assert set(rows) == {"m", "w"}
    assert rows["m"].result_book_url == text.BASE_URL + "/ResultsBook_m.pdf"
    assert rows["m"].result_summary_url.endswith("_new.pdf") and rows["w"].result_summary_url == ""
    assert (rows["w"].tournament_name, rows["w"].year, rows["w"].location) == ("World Men's Championship 2024", "2024", "Oslo, Norway")


def test_words_to_boxes_and_grid(spark):
    boxes = [(1, i, 10.0 + 100 * (i % 6), 90.0 + 100 * (i % 6), 100.0 + 200 * (i // 6)) for i in range(16)]
    b = spark.createDataFrame(boxes, "page_id bigint, shot int, x0 double, x1 double, bottom double")
    words = spark.createDataFrame([(1, 0, 12.0, 101.0, "SUI:"), (1, 1, 110.0, 110.0, "Draw"), (1, 2, 12.0, 301.0, "SWE:"), (1, 3, 12.0, 900.0, "far"), (1, 4, 97.0, 101.0, "gap")], "page_id bigint, word_no int, x0 double, top double, text string")
    got = {r.shot: [(w.is_type, w.text) for w in r.words] for r in dims.words_to_shots(words, b).collect()}
    assert got == {0: [(False, "SUI:")], 1: [(True, "Draw")], 6: [(False, "SWE:")]}
    images = [(1, i, 10.0 + 100 * (i % 6), 50.0 + 200 * (i // 6)) for i in range(16)] + [(1, 99, 37.0, 50.0)]
    grid = dims.grid_rows(spark.createDataFrame(images, "page_id bigint, image_id int, x0 double, top double"))
    assert grid.count() == 16 and grid.where("image_id = 99").count() == 0


def test_enrich_keeps_rows_and_has_no_null_flags(spark):
    shots = spark.createDataFrame([(1, 1, 1, 1, "A"), (1, 1, 99, 1, "A"), (1, 1, 1, 2, None)], "event_id bigint, match_id bigint, end_number int, shot_number int, team_code string")
    ends = spark.createDataFrame([(1, 1, 1, "A", "B", 0, 2, "B", None, "")], "event_id bigint, match_id bigint, end_number int, team1_code string, team2_code string, team1_score_before int, team2_score_before int, hammer_team_code string, team1_time_left string, team2_time_left string")
    got = {(r.end_number, r.shot_number): r for r in features.enrich(shots, ends).collect()}
    assert len(got) == 3
    assert got[1, 1].shooting_team_is_team1 is True and got[1, 1].score_diff_before == -2
    assert got[99, 1].shooting_team_is_team1 is False and got[99, 1].score_diff_before is None
    assert got[1, 2].shooting_team_has_hammer is False
    assert features.duplicate_ends(ends).count() == 0


def test_splits(spark):
    df = spark.createDataFrame([(2020,), (2023,), (2024,), (2025,), (None,)], "y int").select(graph.split_of(F.col("y")).alias("s"))
    assert [r.s for r in df.collect()] == ["train", "train", "val", "test", "train"]
    odd = spark.createDataFrame([(2021,)], "y int").select(graph.split_of(F.col("y"), 2020, 2022).alias("s"))
    assert odd.first().s == "test"


def test_edges(spark):
    node = spark.createDataFrame([(1, 1, 1, 1, n, float(n), 0.0) for n in (0, 1)] + [(1, 1, 1, 1, 2, 0.0, 0.0), (1, 1, 1, 1, 3, 9.0, 0.0)], "event_id bigint, match_id bigint, end_number int, shot_number int, node int, x double, y double")
    got = sorted((r.src, r.dst) for r in graph.spatial_edges(node).collect())
    assert got == [(0, 1), (1, 0), (1, 2), (2, 1)]


def test_regressions(spark):
    schema = "filename string, f1 double, ghost_recall double, pos_err_p95_norm double"
    now = spark.createDataFrame([("a", 94.0, 90.0, 0.01), ("b", 99.0, None, 0.9), ("new", 99.0, 99.0, 0.0)], schema)
    was = spark.createDataFrame([("a", 98.0, 99.0, 0.01), ("b", 99.0, 99.0, 0.01)], schema)
    got = {(r.filename, r.rule) for r in detection.regressions(now, was).collect()}
    assert got == {("a", "min_f1"), ("a", "max_f1_regression"), ("a", "max_ghost_recall_regression"), ("b", "max_pos_err_p95_norm"), ("new", "new_file")}
    assert ("a", "min_f1") not in {(r.filename, r.rule) for r in detection.regressions(now, was, {"min_f1": 90.0}).collect()}


def test_geometry_round_trip(spark):
    df = spark.createDataFrame([("top",), ("bottom",)], "o string")
    px, py = geometry.to_pixel(F.lit(0.3), F.lit(-0.7), F.col("o"))
    x, y = geometry.to_board(px, py, F.col("o"))
    for r in df.select(x.alias("x"), y.alias("y")).collect():
        assert (r.x, r.y) == (pytest.approx(0.3), pytest.approx(-0.7))


def test_tables_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "e", 2024, None, "m", "f", True), (2, "", None, "x", "", "g", False)], schemas.EVENTS)
    tables.write_events(rows, str(tmp_path / "e.parquet"), schemas.EVENTS)
    back = tables.read(spark, str(tmp_path / "e.parquet"), schemas.EVENTS)
    assert back.count() == 2 and back.where("event_id = 2").first().event_name is None
    tables.write_events(rows.where("event_id = 2").withColumn("location", F.lit("y")), str(tmp_path / "e.parquet"), schemas.EVENTS)
    back = {r.event_id: r.location for r in tables.read(spark, str(tmp_path / "e.parquet"), schemas.EVENTS).collect()}
    assert back == {1: None, 2: "y"}
    tables.write_csv(rows, str(tmp_path / "e.csv"))
    assert tables.read(spark, str(tmp_path / "e.csv"), schemas.EVENTS).schema == back_schema(rows)


def back_schema(df):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])


def test_baseline_json(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text(json.dumps({"thresholds": {"min_f1": 90.0}, "results": [{"filename": "a", "f1": 98.5}]}))
    assert tables.read_thresholds(spark, str(path)) == {"min_f1": 90.0}
    r = tables.read_results(spark, str(path))
    assert r.first().f1 == 98.5 and r.first().ghost_recall is None
    assert json.loads(tables.baseline_json(r, {}))["results"][0]["filename"] == "a"
    assert tables.markdown(r).startswith("| filename |")


def test_ends_with_conceded(spark, tmp_path):
    text_ = "event_id,match_id,end_number,team1_code,team2_code,team1_score_this_end,team2_score_this_end,hammer_team_code\n1,1,1,A,B,0,2,A\n1,1,2,A,B,X,X,\n1,1,3,A,B,1.0,0,B\n"
    (tmp_path / "ends.csv").write_text(text_)
    ends = {r.end_number: r for r in tables.read_ends(spark, str(tmp_path / "ends.csv")).collect()}
    assert [ends[i].is_conceded for i in (1, 2, 3)] == [False, True, False]
    assert ends[2].hammer_team_code is None and ends[1].team1_time_left is None


def test_decoder_failures_leave_a_row(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"ok")
    (tmp_path / "b.bin").write_bytes(b"bad")

    def decode(content):
        if content == b"bad":
            raise ValueError
        return [{"text": "Game - Shot by Shot", "words": [], "images": []}, {"text": "other"}]

    got = pages.read_documents(spark, str(tmp_path), decode)
    assert got.count() == 3 and pages.shot_pages(got).count() == 1 and got.where("text is null").count() == 1


def test_markdown_holds_all_rows(spark):
    lines = tables.markdown(spark.range(2500)).splitlines()
    assert len(lines) == 2502 and {*lines[2:]} == {f"| {i} |" for i in range(2500)}
