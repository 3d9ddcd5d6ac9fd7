"""Narrative cleaning and flags on hand-written rows, plus a Python-``re`` cross-check."""
import re

import pytest

from sevscope.functions import narrative as N


def _flags(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, narrative string")
    return [r.asDict() for r in N.attach_narrative_flags(df).orderBy("i").collect()]


def _py_flags(text):
    """Reference semantics restated with Python's re (independent of Spark)."""
    out = {f: 0 for f in N.ALL_FLAGS}
    if text is None or re.search(N.REDACTED_PATTERN, text, re.I):
        return out
    t = re.sub(N.HEADER_PATTERN, "", text, flags=re.I | re.S)
    t = re.sub(N.SUPPLEMENT_PATTERN, "", t, flags=re.I | re.S)
    t = re.sub(N.PLACEHOLDER_PATTERN, " ", t)
    t = re.sub(N.REDACTION_TOKEN_PATTERN, " ", t, flags=re.I).strip(N.WHITESPACE)
    if len(t) < N.MIN_NARRATIVE_LEN:
        return out
    out[N.HAS_NARRATIVE] = 1
    lo = t.lower()
    for name, pat, dot in N.NAV_PATTERNS:
        out[name] = int(bool(re.search(pat, lo, re.S if dot else 0)))
    return out


POSITIVES = {
    "nav_av_stopped": "The subject vehicle was stopped at the light when hit.",
    "nav_av_moving": "The AV was proceeding through the green signal.",
    "nav_av_turning": "The vehicle was initiating a\rturn onto Main St. slowly",
    "nav_av_changing_lanes": "The car was merging onto the road from the ramp.",
    "nav_av_reversing": "The vehicle was backing up out of a driveway.",
    "nav_av_struck_other": "The AV then struck the curb while leaving the lot.",
    "nav_other_struck_av": "A sedan rear-ended the subject vehicle at low speed.",
    "nav_rear_approach": "Another car approached quickly from behind the vehicle.",
    "nav_at_intersection": "This happened in the crosswalk near the school.",
    "nav_on_highway": "Traffic on I-280 was heavy that afternoon overall.",
    "nav_in_parking_lot": "The event happened in a parking garage downtown.",
    "nav_left_turn": "The truck was turning left across two lanes of traffic.",
    "nav_lane_change": "A van moved into the adjacent lane without signal.",
    "nav_vulnerable_user": "A pedestrian stepped off the curb suddenly today.",
    "nav_emergency_vehicle": "An ambulance passed with sirens on the road.",
    "nav_large_vehicle": "A tractor trailer was parked on the shoulder area.",
    "nav_av_disengaged": "The operator took manual control before contact.",
    "nav_hazard_lights": "The car had its hazard lights flashing on the road.",
    "nav_double_parked": "A delivery van was double-parked on the street here.",
    "nav_speed_mentioned": "The other car was going about 25 mph on the road.",
    "nav_minor_damage_lang": "There was no visible damage to either of the cars.",
}

NEAR_MISSES = [
    "The cruise a lot was empty and the roads were clear today.",
    "A waymo vehicle drove past the intersection of nothing much.",
    "At rest stop areas the AV is usually fine and all quiet.",
    "The AV " + "x" * 81 + " struck something far beyond the window here.",
    "The AV " + "x" * 70 + " struck something inside the window here.",
]


@pytest.mark.parametrize("flag", list(POSITIVES))
def test_each_flag_positive(spark, flag):
    row = _flags(spark, [POSITIVES[flag]])[0]
    assert row[flag] == 1
    assert row[N.HAS_NARRATIVE] == 1


def test_matches_python_re(spark):
    texts = list(POSITIVES.values()) + NEAR_MISSES + [
        None, "", "Short text.", "x" * 19, "y" * 20,
        "Pursuant to the Standing General Order, this report is filed.   The AV was stopped.",
        "The AV was stopped. [XXX] details [REDACTED, CBI]",
        "This is a subCBIrecord of the AV that was stopped at the light",
        "The subject vehicle\nwas\r\nstopped at 12 mph\tnear the freeway on-ramp",
        "Waymo may supplement this report. The Waymo AV was stationary at a red light.",
    ]
    got = _flags(spark, texts)
    for t, g in zip(texts, got):
        exp = _py_flags(t)
        assert {k: g[k] for k in N.ALL_FLAGS} == exp, t


def test_redaction_and_length_guard(spark):
    rows = _flags(spark, [None, "contains CONFIDENTIAL data about the AV stopping",
                          "a" * 19, "b" * 20, "inCBIde the AV was stopped and parked"])
    assert [r[N.HAS_NARRATIVE] for r in rows] == [0, 0, 0, 1, 0]
    assert all(r["nav_av_stopped"] == 0 for r in rows)


def test_clean_narrative(spark):
    df = spark.createDataFrame([("Under the SGO rules we report.\nThe AV [XXX] stopped [redacted x] ",),
                                (None,)], "t string")
    clean = N.with_clean_narrative(df, "t", "c")
    assert [r.c for r in clean.collect()] == ["The AV   stopped", ""]
    # the header's removal stands once in the plan, however often the next step names the text
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(?isu)" + N.HEADER_PATTERN.replace("\n", "\\n")) == 1


def test_ordered_pairs_equal_the_patterns(spark):
    """The linear form of "A before B" gives the plain pattern's flags: overlaps, borders, line breaks, other letters."""
    rng = __import__("random").Random(11)
    words = ["waymo av", "cruise a", "cruise av", "cruise", "zoox vehicle", "av", "subject vehicle", "stopped", "stationary", "parked",
             "came to a stop", "came to a stopped", "slowed to a stop", "remained stopped", "at rest", "traveling", "proceeding", "moving",
             "driving", "was in motion", "drove", "a", "the", "éav", "avé", "stop", "x"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "", "-", "\n", "\r\n", ". "]) for _ in range(rng.randint(1, 7))) for _ in range(6000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name, pattern, dotall in N.NAV_PATTERNS:
        if name in N.ORDERED_PAIRS:
            assert all(pattern.count(part) for pair in N.ordered_parts(pattern) for part in pair)
            got = [r.f for r in df.select(N.flag_expr(F_col("t"), name, pattern, dotall).alias("f")).collect()]
            assert got == [bool(re.search(pattern, t, re.S)) for t in texts] and any(got) and not all(got)


def test_ordered_pairs_are_linear(spark):
    """A megabyte of the one without the other is read in under a second."""
    import time

    from pyspark.sql import functions as F
    flags = [N.flag_expr(F.col("t"), n, p, d).alias(n) for n, p, d in N.NAV_PATTERNS if n in N.ORDERED_PAIRS]
    # the literal in front passes the prefilter and is no word of the pattern
    run = lambda n: (spark.range(1).select(F.concat(F.lit("stopper unmoving "), F.repeat(F.lit("the av "), F.col("id").cast("int") + n)).alias("t"))
                     .select(*flags).first())
    run(10)
    start = time.time()
    assert tuple(run(150_000)) == (False, False)
    assert time.time() - start < 1


def test_required_literals_are_necessary():
    """Every regex match contains one of its flag's prefilter literals (pure Python check)."""
    rng = __import__("random").Random(5)
    vocab = re.findall(r"[a-z0-9\-]+", " ".join(p for _, p, _ in N.NAV_PATTERNS).lower())
    vocab += ["the", "a", "other", "vehicle", "av", "waymo", "subject", "lane", "from", "into",
              "12", "mph", "at", "of", "behind", "\n", "-", "."]
    seps = [" ", " ", " ", "", "-", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(vocab) + rng.choice(seps) for _ in range(rng.randint(1, 12)))
        for name, pat, dot in N.NAV_PATTERNS:
            for m in re.finditer(pat, text, re.S if dot else 0):
                assert any(lit in m.group(0) for lit in N.REQUIRED_LITERALS[name]), (name, m.group(0))


def test_prefilter_does_not_change_flags(spark):
    from tests.conftest import SF_ORACLE
    from sevscope.sources import fixtures
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", F_col("text").alias("narrative"))
    raw = fixtures.raw_reports(spark, SF_ORACLE).select(F_col("report_id").alias("doc_id"), "narrative")
    for df in (docs, raw):
        a = N.attach_narrative_flags(df, prefilter=True).select(*N.ALL_FLAGS)
        b = N.attach_narrative_flags(df, prefilter=False).select(*N.ALL_FLAGS)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def F_col(c):
    from pyspark.sql import functions as F
    return F.col(c)
