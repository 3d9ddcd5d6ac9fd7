"""Catalogue entries for scans, cleaning and label operators."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import flags as FL
from ..operators import profile as P
from ..sources import extracts as X
from ..sources import fixtures
from ..session import write_stage
from . import cleaning as C
from .catalog import register
from .oracle import INDICATOR_COLS, chain, injury_rank as sql_injury_rank, q, yes_flag as sql_yes_flag

R6 = 6

RAW_COLS = ["report_id", "report_version", "same_incident_id", "injury_text", "airbag_text",
            "towed_text", "automation_level", "era", "roadway_type", "crash_with",
            "sv_movement", "cp_movement", "sv_speed_mph", "report_month", "narrative"]


# --- B1/B2: harmonise archived names and union the extracts ------------------------
@register("union_by_name", chain() + f"select {', '.join(RAW_COLS)}, source_ord from raw_reports")
def union_by_name(spark, sf_dir):
    parts = fixtures.raw_extracts(spark, sf_dir)
    archived = X.harmonise(parts["archived"], fixtures.archived_internal_rename())
    return X.union_by_name([parts["current"], archived]).select(*RAW_COLS, "source_ord")


# --- A2: missing-token normalisation ----------------------------------------------
_TOKENS = ", ".join(q(t) for t in S.NA_TOKENS)
_STR_COLS = [c for c in RAW_COLS if c not in ("report_version", "sv_speed_mph", "report_month")]


@register("na_tokens", chain() + "select report_id, " + ", ".join(
    f"case when {c} in ({_TOKENS}) then null else {c} end as {c}" for c in _STR_COLS if c != "report_id")
    + " from raw_reports")
def na_tokens(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir).select(*_STR_COLS)
    return X.normalise_missing(raw)


# --- E1 ----------------------------------------------------------------------------
@register("latest_version", chain() + f"select {', '.join(RAW_COLS)}, source_ord from latest")
def latest_version(spark, sf_dir):
    return C.latest_reports(fixtures.raw_reports(spark, sf_dir), keep_tiebreak=True).select(*RAW_COLS, "source_ord")


# --- C1 / C3 / C4 on the raw view ---------------------------------------------------
@register("yes_flag", chain() + f"""
select airbag_text as text, {sql_yes_flag('airbag_text')} as flag, cast(count(*) as bigint) as n
from raw_reports group by all
union all
select towed_text as text, {sql_yes_flag('towed_text')} as flag, cast(count(*) as bigint) as n
from raw_reports group by all""")
def yes_flag(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir)
    a = raw.groupBy(F.col("airbag_text").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    t = raw.groupBy(F.col("towed_text").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionAll(t).select("text", FL.yes_flag("text").alias("flag"), "n")


@register("injury_rank", chain() + f"""
select injury_text as text, {sql_injury_rank('injury_text')} as injury_rank,
  cast({sql_injury_rank('injury_text')} >= {S.INJURY_SEVERE_MIN_RANK} as double) as injury_flag,
  cast(count(*) as bigint) as n
from raw_reports group by all""")
def injury_rank(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir)
    g = raw.groupBy(F.col("injury_text").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumn("injury_rank", FL.injury_rank("text"))
    return g.select("text", "injury_rank", FL.injury_flag("injury_rank").alias("injury_flag"), "n")


# --- C5 ----------------------------------------------------------------------------
@register("incident_key", chain() + "select report_id, incident_key from comp")
def incident_key(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir).select("report_id", "report_version", "same_incident_id", *fixtures.TIEBREAK_COLS)
    rep = C.latest_reports(raw)
    return rep.select("report_id", FL.incident_key().alias("incident_key"))


# --- F2 / E2 -----------------------------------------------------------------------
_INC_COLS = ["incident_key"] + RAW_COLS + ["injury_rank", "airbag_flag", "towed_flag", "injury_flag"]


@register("consolidate", chain() + f"select {', '.join(_INC_COLS)} from inc")
def consolidate(spark, sf_dir):
    return C.incidents(fixtures.raw_reports(spark, sf_dir)).select(*_INC_COLS)


# --- C6 / C7 -----------------------------------------------------------------------
@register("severity_label", chain() + """
select incident_key, injury_flag, airbag_flag, towed_flag, severe, severity_known from labelled""")
def severity_label(spark, sf_dir):
    inc = C.incidents(fixtures.raw_reports(spark, sf_dir), columns=[])
    return inc.select("incident_key", "injury_flag", "airbag_flag", "towed_flag", "severe",
                      "severity_known")


# --- F3 ----------------------------------------------------------------------------
@register("component_counts", chain() + """
select 'injury_flag' as component, cast(sum(injury_flag) as bigint) as positive,
       count(injury_flag) as known from latest_c
union all select 'airbag_flag', cast(sum(airbag_flag) as bigint), count(airbag_flag) from latest_c
union all select 'towed_flag', cast(sum(towed_flag) as bigint), count(towed_flag) from latest_c
""".replace("latest_c", "comp"))
def component_counts(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir).select("report_id", "report_version", "injury_text", "airbag_text", "towed_text", *fixtures.TIEBREAK_COLS)
    rep = C.add_components(C.latest_reports(raw))
    return P.component_counts(rep, ["injury_flag", "airbag_flag", "towed_flag"])


# --- C8 ----------------------------------------------------------------------------
@register("missing_indicators", chain() + "select incident_key, " + ", ".join(
    f"{c}{S.MISSING_SUFFIX}" for c in INDICATOR_COLS) + " from clean")
def missing_indicators(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir)
    inc = C.incidents(raw, columns=[c for c in raw.columns if c not in S.SKIP_INDICATOR])
    inc = write_stage(inc, "unfilled")  # read twice: NULL counts, indicators
    out, cols = C.add_missing_indicators(inc)
    return out.select("incident_key", *[f"{c}{S.MISSING_SUFFIX}" for c in cols])


# --- C9 / C10 -----------------------------------------------------------------------
_IMP_COLS = ["incident_key", "injury_text", "airbag_text", "towed_text", "roadway_type",
             "crash_with", "cp_movement", "sv_speed_mph", "report_month"]


@register("impute", chain() + f"select {', '.join(_IMP_COLS)} from clean")
def impute(spark, sf_dir):
    return C.cleaned_incidents(spark, sf_dir).select(*_IMP_COLS)


# --- F20: exact medians -----------------------------------------------------------
@register("column_median", chain() + """
select 'sv_speed_mph' as column_name, cast(median(sv_speed_mph) as double) as median from labelled
union all select 'report_month', cast(median(report_month) as double) from labelled
union all select 'report_version', cast(median(report_version) as double) from labelled
union all select 'injury_rank', cast(median(injury_rank) as double) from labelled""")
def column_median(spark, sf_dir):
    from ..operators.prefix import medians
    cols = ["sv_speed_mph", "report_month", "report_version", "injury_rank"]
    inc = C.incidents(fixtures.raw_reports(spark, sf_dir), columns=cols)
    names = spark.createDataFrame([(c,) for c in cols], "column_name string")
    found = medians(inc, cols).withColumnRenamed("col", "column_name")
    return names.join(found, "column_name", "left").select("column_name", "median")


# --- A7 ----------------------------------------------------------------------------
CLEAN_TYPES = {
    "incident_key": "string", "report_id": "string", "report_version": "double",
    "same_incident_id": "string", "injury_text": "string", "airbag_text": "string",
    "towed_text": "string", "automation_level": "string", "era": "string",
    "roadway_type": "string", "crash_with": "string", "sv_movement": "string",
    "cp_movement": "string", "sv_speed_mph": "double", "report_month": "int",
    "narrative": "string", "injury_rank": "double", "airbag_flag": "double",
    "towed_flag": "double", "injury_flag": "double", "severe": "int", "severity_known": "int",
    **{f"{c}{S.MISSING_SUFFIX}": "int" for c in INDICATOR_COLS},
}


def _dd_sql() -> str:
    parts = []
    for c, t in CLEAN_TYPES.items():
        ex = (f"(select cast({c} as varchar) from clean where {c} is not null "
              f"order by incident_key limit 1)")
        parts.append(f"select {q(c)} as column_name, {q(t)} as dtype, count({c}) as n_nonnull, "
                     f"count(distinct {c}) as n_unique, coalesce({ex}, '') as example from clean")
    return chain() + "\nunion all\n".join(parts)


@register("data_dictionary", _dd_sql())
def data_dictionary(spark, sf_dir):
    return P.data_dictionary(C.cleaned_incidents(spark, sf_dir), order_col="incident_key")


# --- A7 from stored sketches, one profile per extract --------------------------------
_SKETCHED = ["report_id", "same_incident_id", "roadway_type", "sv_speed_mph", "report_month"]


@register("merged_dictionary", chain() + "\nunion all\n".join(
    f"select {q(c)} as column_name, count(*) as n, count({c}) as n_nonnull, true as within_error from raw_reports" for c in _SKETCHED))
def merged_dictionary(spark, sf_dir):
    """Profiles of the four extracts, written and merged; ``within_error``: distinct count within five standard errors of the exact one."""
    raw = fixtures.raw_reports(spark, sf_dir).select(*_SKETCHED, "era", "automation_level")
    parts = [P.profile_sketches(raw.where((F.col("era") == e) & (F.col("automation_level") == lv)), _SKETCHED)
             for e in S.ERAS for lv in S.LEVELS]
    merged = P.read_profile(P.merge_profiles(write_stage(X.union_by_name(parts), "profiles")))
    exact = P.data_dictionary(raw.select(*_SKETCHED), "report_id").select("column_name", F.col("n_unique").alias("exact"))
    near = F.abs(F.col("n_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), 5 * P.DISTINCT_ERROR * F.col("exact"))
    return merged.join(exact, "column_name").select("column_name", "n", "n_nonnull", near.alias("within_error"))


# --- F1, F5, F4, F6 ----------------------------------------------------------------
@register("strata_counts", chain() + """
select era, automation_level, count(*) as n from raw_reports group by all""")
def strata_counts(spark, sf_dir):
    return P.group_counts(fixtures.raw_reports(spark, sf_dir), ["era", "automation_level"])


@register("severe_rate", chain() + f"""
select era, automation_level, count(*) as n, round(avg(severe), {R6}) as severe_rate
from known group by all""")
def severe_rate(spark, sf_dir):
    return C.severe_rate(C.load_known(C.cleaned_incidents(spark, sf_dir)))


@register("class_distribution", chain() + """
select s.subset, c.severe, coalesce(n, 0) as n
from (values ('all'), ('known')) s(subset) cross join (values (0), (1)) c(severe)
left join (
  select 'all' as subset, severe, count(*) as n from clean group by all
  union all select 'known', severe, count(*) from known group by all
) x using (subset, severe)""")
def class_distribution(spark, sf_dir):
    t = C.cleaned_incidents(spark, sf_dir)
    return P.class_distribution(t, "severe", subsets={"all": None,
                                                      "known": F.col("severity_known") == 1})


@register("component_shares", chain() + f"""
select 'injury_flag' as component, round(avg(injury_flag), {R6}) as share from known where severe = 1
union all select 'airbag_flag', round(avg(airbag_flag), {R6}) from known where severe = 1
union all select 'towed_flag', round(avg(towed_flag), {R6}) from known where severe = 1""")
def component_shares(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir, []))
    return P.component_shares(known.where(F.col("severe") == 1),
                              ["injury_flag", "airbag_flag", "towed_flag"])


# --- A1-A4, B1-B2 through real CSV files -------------------------------------------
_CSV_COLS = [c for c in RAW_COLS]


def _scratch(spark, name):
    import uuid
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


@register("csv_extracts", chain() + "select " + ", ".join(
    f"case when {c} = '' then null else {c} end as {c}" if c not in (
        "report_version", "sv_speed_mph", "report_month") else c for c in _CSV_COLS) + " from raw_reports")
def csv_extracts(spark, sf_dir):
    """Write the view as four raw CSV extracts, then run the extract scan on them:
    per-file encoding, multi-line quoted text, missing tokens, archived-name
    harmonisation, union by name, provenance and declared types."""
    ex = fixtures.write_raw_extracts(spark, sf_dir, _scratch(spark, "extracts"))
    return X.read_extracts(spark, ex).select(*_CSV_COLS)


# --- A1: records with quoted newlines, each file read by many tasks ------------------
_QUOTED = """concat('line "', report_id, '"', chr(10), coalesce(narrative, ''), chr(10), chr(10), ',"')"""


@register("csv_split_records", chain() + f"select report_id, report_version, {_QUOTED} as note from raw_reports")
def csv_split_records(spark, sf_dir):
    """Write the reports with a field of newlines, commas and quotes to CSV files, and read them split by split."""
    path = _scratch(spark, "quoted")
    (fixtures.raw_reports(spark, sf_dir).select("report_id", "report_version", F.expr(_QUOTED).alias("note"))
     .write.option("header", True).option("escape", '"').csv(path))
    return X.apply_declared_types(X.read_csv_text(spark, path, split=True), S.NUMERIC_RAW)


# --- A5 / A8: partitioned cleaned table, pruned reload ------------------------------
@register("partitioned_reload", chain() + """
select era, automation_level, count(*) as n, cast(sum(severe) as bigint) as n_severe
from known where automation_level = 'ADS' group by all""")
def partitioned_reload(spark, sf_dir):
    from ..sources import sinks
    path = _scratch(spark, "cleaned")
    sinks.write_cleaned(C.cleaned_incidents(spark, sf_dir), path)
    known = sinks.read_cleaned(spark, path, known_only=True)
    ads = known.where(F.col("automation_level") == "ADS")      # directory pruning
    return ads.groupBy("era", "automation_level").agg(F.count(F.lit(1)).alias("n"),
                                                      F.sum("severe").cast("bigint").alias("n_severe"))
