"""Narrative cleaning and the 21 scenario flags as native regex expressions.

Everything is ``regexp_replace`` / ``rlike`` on the JVM: no Python UDF, so the 22
flag columns are computed inside whole-stage codegen from one shared cleaned,
lower-cased text column.

Dialect contract: ``\\w \\d \\s`` are ASCII. ``\\b`` takes non-ASCII letters as word characters on
JDK 17, as the reference's language does (from JDK 19 on only with ``(?U)``); the SQL maps such letters to ``_``.
Patterns flagged DOTALL get ``(?s)``. The others rely on "``.`` excludes only a
newline"; Java's default ``.`` also excludes ``\\r`` and other line breaks, so
they get Java's UNIX_LINES flag ``(?d)``. RE2 (the DuckDB oracle) has no ``(?d)``
and its ``.`` already excludes only ``\\n``, so the SQL text omits it.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's for identical flags)
# ---------------------------------------------------------------------------

# Regulatory header and supplement sentence removed before matching
# (both case-insensitive, DOTALL).
HEADER_PATTERN = (r"(?:Pursuant to|Under|Filed under|Submitted pursuant to|In accordance with)"
                  r".*?(?:Standing General Order|SGO).*?(?:\.\s+|\n)")
SUPPLEMENT_PATTERN = r"Waymo may supplement.*?(?:\.\s+|\n)"
PLACEHOLDER_PATTERN = r"\[XXX\]"
REDACTION_TOKEN_PATTERN = r"\[REDACTED[^\]]*\]"   # case-insensitive
REDACTED_PATTERN = r"REDACTED|CBI|CONFIDENTIAL"   # case-insensitive, anywhere
MIN_NARRATIVE_LEN = 20

# (flag name, pattern on lower-cased cleaned text, DOTALL?) in reference order
NAV_PATTERNS = [
    ("nav_av_stopped",
     r"\b(waymo av|cruise av?|zoox vehicle|av|subject vehicle)\b.*?"
     r"\b(stopped|stationary|parked|came to a stop|slowed to a stop|remained stopped|at rest)\b"
     r"|\b(stopped|stationary|parked|came to a stop|slowed to a stop|remained stopped)\b.*?"
     r"\b(waymo av|cruise av?|zoox vehicle|av|subject vehicle)\b", True),
    ("nav_av_moving",
     r"\b(waymo av|cruise av?|zoox vehicle|av|subject vehicle)\b.*?"
     r"\b(traveling|proceeding|moving|driving|was in motion|drove)\b"
     r"|\b(traveling|proceeding|moving|driving)\b.*?"
     r"\b(waymo av|cruise av?|zoox vehicle|av|subject vehicle)\b", True),
    ("nav_av_turning",
     r"\b(left turn|right turn|u-turn|uturn|turning left|turning right|initiating a.{0,10}turn|executing.{0,15}turn)\b",
     False),
    ("nav_av_changing_lanes",
     r"\b(chang(ing|ed) lanes?|lane change|merg(ing|ed)|chang(ing|ed) into)\b", False),
    ("nav_av_reversing",
     r"\b(revers(ing|ed)|backing up|backed up|in reverse)\b", False),
    ("nav_av_struck_other",
     r"\b(waymo av|cruise av?|zoox vehicle|av|subject vehicle)\b.{0,80}"
     r"\b(struck|hit|made contact with|collided with|ran into)\b", True),
    ("nav_other_struck_av",
     r"\b(struck|hit|made contact with|collided with|ran into|rear.ended|sideswiped)\b.{0,80}"
     r"\b(waymo av|cruise av?|zoox vehicle|av|subject vehicle|stationary waymo|stopped waymo)\b"
     r"|\b(other.{0,15}(vehicle|party|car|truck|bus|cyclist|pedestrian))\b.{0,80}"
     r"\b(struck|hit|made contact with|collided with)\b", True),
    ("nav_rear_approach",
     r"\b(approached.{0,30}from behind|rear.end(ed)?|from the rear|"
     r"approach(ed|ing) from behind|rear of the|behind the (waymo|av|subject)|"
     r"collided with the rear)\b", False),
    ("nav_at_intersection",
     r"\b(intersection|red light|stop (sign|light)|traffic signal|yield sign|"
     r"crosswalk|at the light|at a light)\b", False),
    ("nav_on_highway",
     r"\b(freeway|highway|interstate|i-\d+|us-\d+|expressway|on-ramp|off-ramp)\b", False),
    ("nav_in_parking_lot",
     r"\b(parking lot|parking garage|parking structure|parking area)\b", False),
    ("nav_left_turn",
     r"\b(left turn|turning left|turn(ing)? left|left-turn lane|dedicated.*left)\b", False),
    ("nav_lane_change",
     r"\b(lane change|chang(ing|ed) lanes?|merg(ing|ed) (into|from)|"
     r"mov(ing|ed) (into|from).{0,20}lane)\b", False),
    ("nav_vulnerable_user",
     r"\b(pedestrian|cyclist|bicyclist|bicycle|e.?bike|scooter|"
     r"person on foot|moped|motorcyclist)\b", False),
    ("nav_emergency_vehicle",
     r"\b(police|fire truck|firetruck|ambulance|emergency vehicle|"
     r"first responder|law enforcement|patrol car)\b", False),
    ("nav_large_vehicle",
     r"\b(bus|semi.?truck|semi|tractor.?trailer|delivery truck|"
     r"garbage truck|box truck|heavy truck|18.?wheeler)\b", False),
    ("nav_av_disengaged",
     r"\b(disengaged|took (manual )?control|operator took over|"
     r"manual override|disengagement|switched to manual)\b", False),
    ("nav_hazard_lights",
     r"\b(hazard lights?|emergency lights?|flashers|hazard flashers?)\b", False),
    ("nav_double_parked",
     r"\b(double.?parked|blocking (the|a) lane|stopped in (the|a) (travel )?lane|"
     r"obstructing (the|a) lane)\b", False),
    ("nav_speed_mentioned",
     r"\b\d+\s*mph\b|\bspeed of \d+\b|\btraveling at \d+\b", False),
    ("nav_minor_damage_lang",
     r"\b(minor damage|minimal damage|no visible damage|cosmetic damage|"
     r"no damage|undamaged|slight damage)\b", False),
]

NAV_DESCRIPTIONS = {
    "nav_av_stopped": "AV was stopped/parked/stationary at time of impact",
    "nav_av_moving": "AV was traveling/proceeding at time of impact",
    "nav_av_turning": "AV was making a left/right/U-turn",
    "nav_av_changing_lanes": "AV was changing or merging lanes",
    "nav_av_reversing": "AV was reversing/backing up",
    "nav_av_struck_other": "AV initiated contact (AV struck the other party)",
    "nav_other_struck_av": "Other party initiated contact (struck the AV)",
    "nav_rear_approach": "Other party approached from behind / rear-end scenario",
    "nav_at_intersection": "Crash occurred at intersection, red light, or stop sign",
    "nav_on_highway": "Crash on freeway, highway, or interstate",
    "nav_in_parking_lot": "Crash in parking lot or garage",
    "nav_left_turn": "Left turn was involved in the crash sequence",
    "nav_lane_change": "Lane change or merge was involved",
    "nav_vulnerable_user": "Pedestrian, cyclist, or other vulnerable road user involved",
    "nav_emergency_vehicle": "Emergency or police vehicle involved",
    "nav_large_vehicle": "Bus, semi-truck, or heavy vehicle involved",
    "nav_av_disengaged": "Operator disengaged / took manual control near crash",
    "nav_hazard_lights": "AV had hazard/emergency lights on (unusual situation flag)",
    "nav_double_parked": "Double-parked or lane-blocking obstruction in the scene",
    "nav_speed_mentioned": "A specific speed in mph was mentioned in the narrative",
    "nav_minor_damage_lang": '"Minor damage" or "no visible damage" language present',
}

# ---------------------------------------------------------------------------

# Prefilters (own optimisation, not reference values): every match of a pattern on
# lower-cased text contains at least one of these literals, so
# ``contains(any) AND rlike(pattern)`` equals ``rlike(pattern)``; the cheap
# substring test lets most texts skip the regex scan. Checked in tests.
REQUIRED_LITERALS = {
    "nav_av_stopped": ["stop", "stationary", "parked", "at rest"],
    "nav_av_moving": ["travel", "proceed", "moving", "driving", "was in motion", "drove"],
    "nav_av_turning": ["turn"],
    "nav_av_changing_lanes": ["chang", "merg"],
    "nav_av_reversing": ["revers", "backing up", "backed up"],
    "nav_av_struck_other": ["struck", "hit", "made contact with", "collided with", "ran into"],
    "nav_other_struck_av": ["struck", "hit", "made contact with", "collided with", "ran into",
                            "rear", "sideswiped"],
    "nav_rear_approach": ["approach", "rear", "behind the "],
    "nav_at_intersection": ["intersection", "red light", "stop sign", "stop light", "traffic signal",
                            "yield sign", "crosswalk", "at the light", "at a light"],
    "nav_on_highway": ["freeway", "highway", "interstate", "i-", "us-", "expressway", "on-ramp",
                       "off-ramp"],
    "nav_in_parking_lot": ["parking "],
    "nav_left_turn": ["left"],
    "nav_lane_change": ["chang", "merg", "mov"],
    "nav_vulnerable_user": ["pedestrian", "cyclist", "bicycle", "bike", "scooter", "person on foot",
                            "moped"],
    "nav_emergency_vehicle": ["police", "fire truck", "firetruck", "ambulance", "emergency vehicle",
                              "first responder", "law enforcement", "patrol car"],
    "nav_large_vehicle": ["bus", "semi", "tractor", "delivery truck", "garbage truck", "box truck",
                          "heavy truck", "wheeler"],
    "nav_av_disengaged": ["disengag", "took ", "manual override", "switched to manual"],
    "nav_hazard_lights": ["hazard ", "emergency light", "flashers"],
    "nav_double_parked": ["double", "blocking ", "stopped in ", "obstructing "],
    "nav_speed_mentioned": ["mph", "speed of ", "traveling at "],
    "nav_minor_damage_lang": ["damage"],
}
#: Flags of the form "one before the other, however far apart".
ORDERED_PAIRS = ("nav_av_stopped", "nav_av_moving")
HEADER_PREFILTER = r"(?iu)standing general order|sgo"
SUPPLEMENT_PREFILTER = r"(?iu)waymo may supplement"

NAV_FEATURES = [n for n, _, _ in NAV_PATTERNS]
HAS_NARRATIVE = "nav_has_narrative"
ALL_FLAGS = NAV_FEATURES + [HAS_NARRATIVE]

# ASCII whitespace set trimmed from both ends of the cleaned text
WHITESPACE = S.WHITESPACE


def java_pattern(pattern: str, dotall: bool) -> str:
    return ("(?s)" if dotall else "(?d)") + pattern


def re2_pattern(pattern: str, dotall: bool) -> str:
    return ("(?s)" if dotall else "") + pattern


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def with_clean_narrative(df: DataFrame, text, out: str) -> DataFrame:
    """``df`` with column ``out``: ``text`` without header, supplement sentence, placeholders and
    redaction tokens, trimmed (D1). NULL -> empty string.

    Every step is a projection of its own, because a ``when`` names its input several times: one
    nested expression would evaluate the earlier steps again for each mention.
    """
    t = F.col(out)
    df = df.withColumn(out, F.coalesce(_c(text), F.lit("")))
    # the lazy header/supplement patterns rescan the text from every "under" etc.;
    # they can only match when their closing phrase occurs, so test that first
    for needed, pattern in ((HEADER_PREFILTER, HEADER_PATTERN), (SUPPLEMENT_PREFILTER, SUPPLEMENT_PATTERN)):
        df = df.withColumn(out, F.when(t.rlike(needed), F.regexp_replace(t, "(?isu)" + pattern, "")).otherwise(t))
    bare = F.regexp_replace(F.regexp_replace(t, PLACEHOLDER_PATTERN, " "), "(?iu)" + REDACTION_TOKEN_PATTERN, " ")
    return df.withColumn(out, F.btrim(bare, F.lit(WHITESPACE)))


def is_redacted(text) -> Column:
    """NULL, or REDACTED/CBI/CONFIDENTIAL anywhere, any case."""
    t = _c(text)
    return t.isNull() | t.rlike("(?iu)" + REDACTED_PATTERN)


def ordered_parts(pattern: str) -> list[tuple[str, str]]:
    """(first, second) of each alternative of a pattern ``A.*?B|C.*?A``."""
    subject, middle, last = pattern.split(".*?")
    later, earlier = middle.split(r"\b|\b")
    return [(subject, later + r"\b"), (r"\b" + earlier, last)]


def follows(text: Column, first: str, second: str) -> Column:
    """``first.*?second`` (over line breaks) matches, in time linear in the text: the first match of
    ``first`` also ends first, so ``second`` is looked for once, in what lies behind it. The ``x`` stands
    for the match's last letter, so that word borders there are as in the whole text."""
    rest = F.get(F.split(text, first, 2), 1)
    return F.coalesce(F.concat(F.lit("x"), rest).rlike(second), F.lit(False))


def flag_expr(text: Column, name: str, pattern: str, dotall: bool, prefilter: bool = True) -> Column:
    """One flag pattern on lower-cased text: ``rlike`` behind its literal prefilter, ordered pairs in
    linear time. ``prefilter=False``: the plain pattern."""
    if not prefilter:
        return text.rlike(java_pattern(pattern, dotall))
    if name in ORDERED_PAIRS:
        hit = reduce(or_, (follows(text, a, b) for a, b in ordered_parts(pattern)))
    else:
        hit = text.rlike(java_pattern(pattern, dotall))
    return reduce(or_, (text.contains(lit) for lit in REQUIRED_LITERALS[name])) & hit


def attach_narrative_flags(df: DataFrame, narrative_col: str = "narrative",
                           prefilter: bool = True) -> DataFrame:
    """Add 21 ``nav_*`` flags and ``nav_has_narrative`` as int 0/1.

    The cleaned lower-cased text is computed once in its own projection and the 22
    predicates read it, so each narrative is cleaned once however many flags use it.
    An ineligible narrative (redacted, or shorter than 20 characters after
    cleaning) gets 0 in every column (D3).
    """
    raw = F.col(narrative_col)
    staged = with_clean_narrative(df.withColumn("__nav_redacted", is_redacted(raw)), raw, "__nav_clean")
    staged = staged.withColumns({
        "__nav_ok": (~F.col("__nav_redacted")) & (F.length("__nav_clean") >= MIN_NARRATIVE_LEN),
        "__nav_t": F.lower(F.col("__nav_clean")),
    })
    ok = F.col("__nav_ok")
    t = F.col("__nav_t")
    flags = {name: (ok & flag_expr(t, name, p, dot, prefilter)).cast("int")
             for name, p, dot in NAV_PATTERNS}
    flags[HAS_NARRATIVE] = ok.cast("int")
    return staged.withColumns(flags).drop("__nav_clean", "__nav_redacted", "__nav_ok", "__nav_t")


def ensure_narrative_flags(df: DataFrame, narrative_col: str = "narrative") -> DataFrame:
    """``df`` as is when it already carries all 22 flag columns (e.g. the flagged
    stage table), else ``attach_narrative_flags``."""
    if all(c in df.columns for c in ALL_FLAGS):
        return df
    return attach_narrative_flags(df, narrative_col)
