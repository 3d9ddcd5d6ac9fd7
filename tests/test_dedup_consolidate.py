"""Latest version and consolidation semantics."""
from pyspark.sql import functions as F

from sevscope.operators import groups as G
from sevscope.operators.consolidate import consolidate
from sevscope.operators.dedup import latest_version
from sevscope.plans import cleaning as C


def test_latest_version_rules(spark):
    rows = [("A", 1.0, 0, "a1"), ("A", 2.0, 0, "a2"), ("A", None, 0, "aN"),   # NULL version wins
            ("B", 3.0, 0, "b-src0"), ("B", 3.0, 1, "b-src1"),               # later source wins
            (None, 1.0, 0, "n1"), (None, 5.0, 0, "n5")]                      # NULL ids: one key
    df = spark.createDataFrame(rows, "report_id string, report_version double, src int, payload string")
    out = {r.report_id: r.payload for r in latest_version(df, tiebreak_cols=["src"]).collect()}
    assert out == {"A": "aN", "B": "b-src1", None: "n5"}
    # one row per id
    assert latest_version(df, tiebreak_cols=["src"]).count() == 3


def test_consolidate_rules(spark):
    rows = [("K1", "R2", 5.0, None, "ADS"), ("K1", "R1", None, None, "L2"), ("K1", "R3", 7.0, "late", "ADS"),
            ("K2", "R9", None, None, None)]
    df = spark.createDataFrame(rows, "incident_key string, report_id string, speed double, txt string, "
                                     "automation_level string")
    out = {r.incident_key: r for r in consolidate(df).collect()}
    k1 = out["K1"]
    assert k1.speed == 7.0                 # numeric -> max
    assert k1.automation_level == "L2"     # first by report id (mixed levels)
    assert k1.txt == "late"                # first non-NULL
    assert k1.report_id == "R1"
    assert out["K2"].speed is None         # all-NULL numeric stays NULL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_gather_moves_rows_once_and_keeps_the_result(spark):
    ids = ["A", "B", None, "C"]
    rows = [(ids[i % 4], None if i % 7 == 0 else float(i % 5), i % 3, f"p{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "report_id string, report_version double, src int, payload string").repartition(3)
    near = latest_version(df, tiebreak_cols=["src"], gather=True)
    assert sorted(near.collect(), key=str) == sorted(latest_version(df, tiebreak_cols=["src"]).collect(), key=str)
    # the only exchange by the id lies below both aggregates: no map task sorts its rows
    plan = _plan(near)
    assert plan.count("hashpartitioning(report_id") == 1
    assert plan.index("hashpartitioning(report_id") > plan.rindex("SortAggregate")
    rows = [(f"K{i % 5}" if i % 6 else None, None if i % 11 == 0 else f"R{i:03}", float(i) if i % 4 else None, f"t{i % 9}" if i % 3 else None) for i in range(80)]
    df = spark.createDataFrame(rows, "incident_key string, report_id string, speed double, txt string")
    df = df.where("report_id is not null or speed is null")
    assert sorted(consolidate(df, gather=True).collect(), key=str) == sorted(consolidate(df).collect(), key=str)


def test_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(G, "HOT_ROWS", 50)
    df = spark.range(2000).select(F.concat(F.lit("R"), "id").alias("even"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("nulls"))
    assert G.hot_keys(df, F.col("even"), F.col("nulls")) == [False, True]
    assert G.hot_keys(df.limit(0), F.col("even")) == [False]
    # a hot id is reduced where its rows lie
    raw = df.select(F.col("nulls").alias("report_id"), F.lit(1.0).alias("report_version"), "even")
    plan = _plan(C.latest_reports(raw, []))
    assert plan.index("hashpartitioning(report_id") < plan.rindex("SortAggregate")
    assert C.latest_reports(raw, []).count() == raw.select("report_id").distinct().count()


def test_incidents_of_few_columns_are_those_of_all(spark):
    rows = [(f"R{i % 23}" if i % 9 else None, float(i % 4) if i % 5 else None, f"I{i % 7}" if i % 3 else " ", "Serious" if i % 4 else None,
             "Yes" if i % 6 == 0 else "No", None, "ADS" if i % 2 else "L2", "archived", f"road{i % 3}" if i % 5 else None, f"text {i % 11}", i) for i in range(120)]
    raw = spark.createDataFrame(rows, "report_id string, report_version double, same_incident_id string, injury_text string, airbag_text string, "
                                      "towed_text string, automation_level string, era string, roadway_type string, narrative string, n int")
    every = C.incidents(raw, ["n"])
    for columns in ([], ["narrative"], ["roadway_type", "report_version"]):
        few = C.incidents(raw, ["n"], columns)
        assert set(few.columns) == {"incident_key", "report_id", "era", "automation_level", "injury_rank", "injury_flag", "airbag_flag", "towed_flag",
                                    "severe", "severity_known", *columns}
        assert sorted(few.collect(), key=str) == sorted(every.select(*few.columns).collect(), key=str)


def test_cleaned_tables_are_shared(spark, monkeypatch):
    built = []

    def clean(raw, columns=None):
        built.append(columns)
        return C.CleanResult(spark.range(1))
    monkeypatch.setattr(C, "_CLEANED", {})
    monkeypatch.setattr(C, "clean", clean)
    monkeypatch.setattr(C.fixtures, "raw_reports", lambda *a: None)
    for columns in (["narrative"], [], ["narrative"], None, ["roadway_type"], None):
        C.cleaned_incidents(spark, "/x", columns)
    assert built == [["narrative"], None]
