"""Label rules on hand-written rows (FIXTURES §4)."""
from pyspark.sql import functions as F

from sevscope.functions import flags as FL


def _eval(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr).collect()]


def test_yes_flag(spark):
    vals = ["y", "YES", "true", "1", "n", "No", "false", "0", "Not Applicable",
            "Yes Subject Vehicle", "No Subject Vehicle", "no subject vehicle; yes subject vehicle",
            "Unknown", "", None, "\t yes \n"]
    got = _eval(spark, FL.yes_flag("x"), vals)
    assert got == [1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 1.0, None, None, None, 1.0]


def test_injury_rank_and_flag(spark):
    vals = ["No Injuries Reported", "no apparent injury", "Minor", "Moderate", "Serious",
            "Fatality", "No Injured Reported", "Property Damage. No Injured Reported",
            "Minor W/O Hospitalization", "Minor W/ Hospitalization",
            "Moderate W/O Hospitalization", " Moderate W/ Hospitalization ",
            "Serious W/O Hospitalization", "Serious W/ Hospitalization",
            "Possible Fatality", "Unknown", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string").withColumn("r", FL.injury_rank("x"))
    rows = df.select("r", FL.injury_flag("r").alias("f")).collect()
    assert [r.r for r in rows] == [0, 0, 1, 2, 3, 4, 0, 0, 1, 1, 2, 2, 3, 3, 4, None, None]
    assert [r.f for r in rows] == [0, 0, 0, 1, 1, 1, 0, 0, 0, 0, 1, 1, 1, 1, 1, None, None]


def test_incident_key(spark):
    df = spark.createDataFrame([("R1", None), ("R2", "   "), ("R3", " I9 "), (None, None)],
                               "report_id string, same_incident_id string")
    got = [r[0] for r in df.select(FL.incident_key()).collect()]
    assert got == ["SINGLE_R1", "SINGLE_R2", " I9 ", "SINGLE_nan"]


def test_severe_and_known(spark):
    df = spark.createDataFrame([(None, None, None), (0.0, None, None), (None, 1.0, None),
                                (0.0, 0.0, 0.0), (1.0, 0.0, None)],
                               "injury_flag double, airbag_flag double, towed_flag double")
    rows = df.select(FL.severe().alias("s"), FL.severity_known().alias("k")).collect()
    assert [(r.s, r.k) for r in rows] == [(0, 0), (0, 1), (1, 1), (0, 1), (1, 1)]
    # severe implies known
    assert all(r.k == 1 for r in rows if r.s == 1)


def test_formatting_half_even(spark):
    df = spark.createDataFrame([("Street", 0.625), ("Street", 0.125)], "v string, s double")
    got = [r[0] for r in df.select(FL.value_with_pct("v", "s")).collect()]
    assert got == ["Street (62%)", "Street (12%)"]


def test_round1_matches_python_round_at_ties(spark):
    """One-decimal rounding equals Python's round(x, 1), including ties that are not
    exactly representable (n / 2000 * 100 = 0.05, 0.15, ...), where bround differs."""
    from pyspark.sql import functions as F

    from sevscope.functions.flags import round1
    xs = [n / 2000 * 100 for n in range(0, 2001)] + [0.25, 0.35, 2.675, -0.35, -0.25, 99.95]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(round1("x").alias("r")).collect()]
    assert got == [round(x, 1) for x in xs]
    # bround alone would not do: it rounds the shortest decimal text
    assert df.where(F.bround("x", 1) != round1("x")).count() > 0
