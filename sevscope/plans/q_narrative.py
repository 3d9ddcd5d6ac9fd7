"""Catalogue entries for narrative cleaning and flags."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import narrative as N
from ..operators import profile as P
from ..sources import fixtures
from . import cleaning as C
from .catalog import register
from .oracle import WS, chain, q, round1


def _sql_clean(x: str) -> str:
    t = f"coalesce({x}, '')"
    t = f"regexp_replace({t}, {q('(?is)' + N.HEADER_PATTERN)}, '', 'g')"
    t = f"regexp_replace({t}, {q('(?is)' + N.SUPPLEMENT_PATTERN)}, '', 'g')"
    t = f"regexp_replace({t}, {q(N.PLACEHOLDER_PATTERN)}, ' ', 'g')"
    t = f"regexp_replace({t}, {q('(?i)' + N.REDACTION_TOKEN_PATTERN)}, ' ', 'g')"
    return f"trim({t}, {WS})"


def _sql_redacted(x: str) -> str:
    return f"({x} is null or regexp_matches({x}, {q('(?i)' + N.REDACTED_PATTERN)}))"


def _sql_word_text(x: str) -> str:
    """RE2's \\b only knows ASCII word characters, while the reference (and Java)
    treat non-ASCII letters and digits as word characters. Map those to '_' - a
    word character that no pattern mentions - so boundaries agree."""
    x = f"regexp_replace({x}, '[^\\x00-\\x7F\\PL]', '_', 'g')"
    return f"regexp_replace({x}, '[^\\x00-\\x7F\\PN]', '_', 'g')"


def _sql_flag_cte(src: str, key: str, text: str) -> str:
    """CTE 'flags_src' with key + 22 int flags computed in SQL."""
    flags = ",\n    ".join(
        f"cast(ok and regexp_matches(t, {q(N.re2_pattern(p, d))}) as integer) as {n}"
        for n, p, d in N.NAV_PATTERNS)
    return f""", nav_stage as (
  select *, {_sql_word_text('lower(c)')} as t, (not r and length(c) >= {N.MIN_NARRATIVE_LEN}) as ok from (
    select *, {_sql_clean(text)} as c, {_sql_redacted(text)} as r from {src}) s),
flags_src as (
  select {key}, {flags},
    cast(ok as integer) as {N.HAS_NARRATIVE}
  from nav_stage)
"""


@register("narrative_clean", chain() + f"""
select report_id, {_sql_clean('narrative')} as clean_text,
  cast({_sql_redacted('narrative')} as integer) as redacted
from raw_reports""")
def narrative_clean(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir)
    clean = N.with_clean_narrative(raw.select("report_id", "narrative"), "narrative", "clean_text")
    return clean.select("report_id", "clean_text", N.is_redacted("narrative").cast("int").alias("redacted"))


@register("narrative_redacted", chain() + f"""
select automation_level, era, cast(count_if({_sql_redacted('narrative')}) as bigint) as n_redacted,
  count(*) as n from raw_reports group by all""")
def narrative_redacted(spark, sf_dir):
    raw = fixtures.raw_reports(spark, sf_dir)
    return raw.groupBy("automation_level", "era").agg(
        F.count_if(N.is_redacted("narrative")).alias("n_redacted"),
        F.count(F.lit(1)).alias("n"))


@register("narrative_flags", chain() + _sql_flag_cte("known", "incident_key", "narrative")
          + "select * from flags_src")
def narrative_flags(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir, ["narrative"]))
    return N.attach_narrative_flags(known.select("incident_key", "narrative")).drop("narrative")


def _prevalence_sql() -> str:
    rows = []
    for n in N.NAV_FEATURES:
        rows.append(
            f"select {q(n)} as feature, {q(N.NAV_DESCRIPTIONS[n])} as description, "
            f"avg({n}) * 100.0 as o, "
            f"avg(case when severe = 1 then {n} end) * 100.0 as s, "
            f"avg(case when severe = 0 then {n} end) * 100.0 as ns "
            f"from fl")
    return (chain() + _sql_flag_cte("known", "incident_key, severe", "narrative")
            + ", fl as (select * from flags_src)\n"
            + f"select feature, description, {round1('o')} as overall_pct, "
            + f"{round1('s')} as severe_pct, {round1('ns')} as nonsevere_pct from (\n"
            + "\nunion all\n".join(rows) + ")")


@register("flag_prevalence", _prevalence_sql())
def flag_prevalence(spark, sf_dir):
    # the flags are columns of the labelled stage table; no pattern runs again
    return P.flag_prevalence(C.flagged_known(spark, sf_dir, []), N.NAV_FEATURES, N.NAV_DESCRIPTIONS, "severe")


@register("document_flags", "with " + _sql_flag_cte("documents", "doc_id", "text")[2:] + """
select cast(count(*) as bigint) as n_docs, """ + ", ".join(
    f"cast(sum({n}) as bigint) as {n}" for n in N.ALL_FLAGS) + " from flags_src")
def document_flags(spark, sf_dir):
    """Flags over the whole ``documents`` table: long multilingual texts (negative/scale fixture)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    flagged = N.attach_narrative_flags(docs, "text")
    return flagged.agg(F.count(F.lit(1)).alias("n_docs"),
                       *[F.sum(n).cast("bigint").alias(n) for n in N.ALL_FLAGS])
