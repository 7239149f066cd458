"""Text parsing of result pages and link tables, as column expressions.

Regular expressions carry ``(?U)``, so white space, words and digits are those
of Unicode (a no-break space separates words).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Site that relative links belong to (fixed value).
BASE_URL = "https://curlit.com/"

def strip(text: Column) -> Column:
    """Without white space at both ends, no-break spaces too."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it stands there."""
    return F.transform(F.array(value), use)[0]


def _team(words: Column) -> Column:
    """Struct(code, name, before, points) of words like ``SUI - Switzerland 1 + 0``; null if they aren't."""
    def found(sides: Column, left: Column, names: Column) -> Column:
        points, before = F.get(sides, F.lit(1)), F.get(left, F.lit(1))
        code, name = F.get(names, F.lit(0)), F.get(names, F.lit(1))
        whole = before.rlike(r"(?U)^\d+$") & points.rlike(r"(?U)^(\d+|X)$") & code.rlike(r"(?U)^\w+$") & (name != "")
        return F.when(whole, F.struct(code.alias("code"), strip(name).alias("name"), before.try_cast("int").alias("before"), points.alias("points")))

    def parted(sides: Column) -> Column:
        left = F.split(F.get(sides, F.lit(0)), r"(?U)\s+(?=\S+$)")
        return _let(left, lambda x: _let(F.split(F.get(x, F.lit(0)), r"(?U)\s*-\s*", 2), lambda names: found(sides, x, names)))

    return _let(F.split(words, r"(?U)\s*\+\s*(?=[^+]*$)"), parted)


def _after_equals(text: Column) -> Column:
    """Struct(score, rest) of text like ``= 1 SWE - Sweden``; null if no number follows."""
    def found(t: Column) -> Column:
        score = F.regexp_extract(t, r"(?U)^=\s*(\d+)", 1)
        return F.when(score != "", F.struct(score.try_cast("int").alias("score"), strip(F.regexp_replace(t, r"(?U)^=\s*\d+", "")).alias("rest")))

    return _let(strip(text), found)


def parse_end_line(text: Column) -> Column:
    """Struct of the end line's eleven parts, or null; this_end may be 'X'.

    The line's two marks ``(this end)`` part it: the end's number and the first
    team's words stand before the first one, the first team's new score and the
    other team's words between them, and the other team's new score after them.
    """
    def line(p: Column) -> Column:
        head = F.split(strip(F.element_at(F.split(p[0], r"(?U)End\s+(?=\d)"), -1)), r"(?U)\s+", 2)
        return _let(F.struct(head.alias("head"), _after_equals(p[1]).alias("middle"), _after_equals(p[2]).alias("last"), p[0].rlike(r"(?U)End\s+\d").alias("named")), teams)

    def teams(s: Column) -> Column:
        return _let(F.struct(_team(F.get(s.head, F.lit(1))).alias("first"), _team(s.middle.rest).alias("second")), lambda t: whole(s, t))

    def whole(s: Column, t: Column) -> Column:
        number = F.get(s.head, F.lit(0))
        parts = [number.try_cast("int").alias("end_number")]
        for k, team, after in ((1, t.first, s.middle.score), (2, t.second, s.last.score)):
            parts += [
                team.code.alias(f"team{k}_code"),
                team["name"].alias(f"team{k}_name"),
                team.before.alias(f"team{k}_score_before"),
                team.points.alias(f"team{k}_score_this_end"),
                after.alias(f"team{k}_score_after"),
            ]
        there = s.named & number.rlike(r"(?U)^\d+$") & t.first.isNotNull() & t.second.isNotNull() & s.middle.isNotNull() & s.last.isNotNull()
        return F.when(there, F.struct(*parts))

    # a text without both marks has no line, and most have none
    marked = F.when(text.contains("(this end)"), F.split(text, r"\(this end\)", 3))
    return _let(marked, lambda p: F.when(F.size(p) == 3, line(p)))


def _dated(line: Column) -> Column:
    """Words of a line that begins with weekday, day, month and year, and its rest as the fifth; else null."""
    w = F.split(line, r"(?U)\s+", 5)
    short = [w[i].rlike("^[A-Z]{3}$") for i in (0, 2)]
    return F.when((F.size(w) == 5) & short[0] & w[1].rlike(r"(?U)^\d{1,2}$") & short[1] & w[3].rlike(r"(?U)^\d{4}$"), w)


def parse_match_header(text: Column) -> Column:
    """Struct(date, round, start_time) by the last lines that hold them; '' if none does."""
    stripped = F.transform(lines(text), strip)
    head = _last(F.filter(stripped, lambda x: _dated(x).isNotNull()))
    rest = F.get(_dated(head), F.lit(4))
    start = _last(F.filter(lines(text), lambda x: x.contains("Start Time")))
    return F.struct(
        F.coalesce(strip(F.substring(head, F.lit(1), F.length(head) - F.length(rest))), F.lit("")).alias("date"),
        F.coalesce(strip(rest), F.lit("")).alias("round"),
        F.coalesce(strip(F.substring_index(start, "Start Time", -1)), F.lit("")).alias("start_time"),
    )


def _after(text: Column, mark: str, word: str) -> Column:
    """The two tokens after ``word`` on the last line that holds ``mark`` and has them."""
    rows = F.transform(F.filter(lines(text), lambda x: x.contains(mark)), tokens)
    whole = F.filter(rows, lambda r: (F.array_position(r, word) > 0) & (F.size(r) >= F.array_position(r, word) + 2))
    row = _last(whole)
    at = F.array_position(row, word).cast("int")
    return F.struct(F.try_element_at(row, at + 1).alias("team1"), F.try_element_at(row, at + 2).alias("team2"))


def parse_score_box(text: Column) -> Column:
    """Struct(total, time_left), each of team1 and team2, null where absent."""
    return F.struct(_after(text, "Total Score", "Score").alias("total"), _after(text, "Time left", "left").alias("time_left"))


def parse_tournament(text: Column) -> Column:
    """Struct(name, year, location): first four-digit number; location after the last ' in '."""
    t = strip(text)
    split = r"(?s)^(.*) in (.*)$"
    there = t.rlike(split)
    return F.struct(
        F.when(there, strip(F.regexp_extract(t, split, 1))).otherwise(t).alias("name"),
        F.regexp_extract(t, r"(?U)\b(\d{4})\b", 1).alias("year"),
        F.when(there, strip(F.regexp_extract(t, split, 2))).otherwise(F.lit("")).alias("location"),
    )


#: First hit wins (fixed values, in this order).
GENDER_TITLE = [("mixed doubles", "mxd"), ("women", "w"), ("men", "m")]
GENDER_IMAGE = [("pdf_md", "mxd"), ("pdf_mx", "mx"), ("pdf_m", "m"), ("pdf_w", "w")]
GENDER_NAME = [("mixed doubles", "mxd"), ("mixed", "mx"), ("women's", "w"), ("women ", "w"), ("men's", "m"), ("men ", "m")]
CATEGORIES = [
    ("mixed doubles", "Mixed Doubles"),
    ("senior", "Senior"),
    ("wheelchair", "Wheelchair"),
    ("junior-b", "Junior-B"),
    ("jb", "Junior-B"),
    ("junior", "Junior"),
    ("olympic", "Olympic"),
    ("paralympic", "Paralympic"),
    ("universiade", "Universiade"),
    ("youth", "Youth"),
    ("world cup", "World Cup"),
    ("cwc", "World Cup"),
    ("b-division", "B/C Division"),
    ("c-division", "B/C Division"),
    ("qualification", "Qualification"),
    ("mixed curling", "Mixed 4-person"),
    ("asian", "Asian Games"),
]


def first_hit(text: Column, cases: list[tuple[str, str]], default: Column) -> Column:
    """The value of the first word that the lowered text contains."""
    low = F.lower(text)
    return reduce(lambda out, case: F.when(low.contains(case[0]), F.lit(case[1])).otherwise(out), reversed(cases), default)


def resolve_gender(title: Column, image: Column, name: Column) -> Column:
    """By link title, else image file, else tournament name; '' if none tells."""
    by_name = first_hit(F.coalesce(name, F.lit("")), GENDER_NAME, F.lit(""))
    by_image = first_hit(F.coalesce(image, F.lit("")), GENDER_IMAGE, by_name)
    return first_hit(F.coalesce(title, F.lit("")), GENDER_TITLE, by_image)


def event_category(name: Column) -> Column:
    return first_hit(F.coalesce(name, F.lit("")), CATEGORIES, F.lit("Other"))


def absolute_url(href: Column, base: str = BASE_URL) -> Column:
    return F.when(href.rlike("^https?://"), href).otherwise(F.concat(F.lit(base), href))


TURNS = {"↺": "Counter-clockwise", "↻": "Clockwise"}

# Fold of a shot's words: struct(is_type, text) in order.
_WORDS = r"""
aggregate(words, named_struct('team_code', '', 'player_name', '', 'shot_type', '', 'turn', '', 'accuracy', ''), (s, w) ->
  if(not w.is_type,
    if(contains(w.text, ':') and length(w.text) <= 5, named_struct('team_code', rtrim(':', w.text), 'player_name', s.player_name, 'shot_type', s.shot_type, 'turn', s.turn, 'accuracy', s.accuracy),
      named_struct('team_code', s.team_code,
        'player_name', case when s.team_code <> '' and s.player_name = '' then w.text when s.player_name <> '' then concat(s.player_name, ' ', w.text) else '' end,
        'shot_type', s.shot_type, 'turn', s.turn, 'accuracy', s.accuracy)),
    named_struct('team_code', s.team_code, 'player_name', s.player_name,
      'shot_type', case
        when substr(w.text, 1, 1) in ('↺', '↻') or contains(w.text, '%') or w.text = '-' then s.shot_type
        when s.shot_type = '' then w.text
        when length(w.text) = 1 and w.text rlike '(?U)^(\\p{Lower}|\\d)$' then s.shot_type
        else concat(s.shot_type, ' ', w.text) end,
      'turn', case
        when substr(w.text, 1, 1) = '↺' then 'Counter-clockwise'
        when substr(w.text, 1, 1) = '↻' then 'Clockwise'
        when w.text = '-' then 'Not considered' else s.turn end,
      'accuracy', case
        when (substr(w.text, 1, 1) in ('↺', '↻') or contains(w.text, '%')) and w.text rlike '[0-9]+%' then regexp_extract(w.text, '([0-9]+)%', 1)
        else s.accuracy end)),
  s -> named_struct('team_code', s.team_code, 'player_name', s.player_name, 'shot_type', s.shot_type,
    'turn', if(s.turn = '' and startswith(s.shot_type, 'Through'), 'Not considered', s.turn), 'accuracy', s.accuracy))
"""


def shot_metadata() -> Column:
    """Struct(team_code, player_name, shot_type, turn, accuracy) of the column ``words``."""
    return F.expr(_WORDS)


def considered_turn(turn: Column, shot_type: Column) -> Column:
    """Shots that went through have no turn: 'Not considered'."""
    return F.when((F.coalesce(turn, F.lit("")) == "") & shot_type.startswith("Through"), F.lit("Not considered")).otherwise(turn)
