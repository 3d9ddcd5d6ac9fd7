"""Independent SQL statements of the cleaning chain, for the DuckDB oracle.

These are *not* used by the Spark jobs: they restate each operator's semantics in
plain SQL (window row_number for latest version, ordered ``first`` for
consolidation, ...) so the driver can check the DataFrame implementation against
a second engine. Every statement starts from the registered base tables.
"""
from __future__ import annotations

from .. import schema as S
from ..sources.fixtures import RAW_REPORTS_SQL

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def round1(e: str) -> str:
    """SQL text of Python's ``round(e, 1)`` on doubles: the same error-free steps as
    ``functions.flags.round1`` (plain double arithmetic, so both engines agree)."""
    d10, sp, half = "cast(10 as double)", "cast(134217729 as double)", "cast(0.5 as double)"
    a = f"cast(({e}) as double)"
    p = f"({a} * {d10})"
    c = f"({a} * {sp})"
    ah = f"({c} - ({c} - {a}))"
    al = f"({a} - {ah})"
    err = f"(({ah} * {d10} - {p}) + {al} * {d10})"
    fl = f"cast(floor({p}) as double)"
    dd = f"(({p} - ({fl} + {half})) + {err})"
    up = f"({dd} > 0 or ({dd} = 0 and abs({fl}) % 2 = 1))"
    return f"((case when {up} then {fl} + 1 else {fl} end) / {d10})"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def yes_flag(x: str) -> str:
    s = f"lower({strip(x)})"
    yes = ", ".join(q(t) for t in S.YES_TOKENS)
    no = ", ".join(q(t) for t in S.NO_TOKENS)
    return (f"cast(case when contains({s}, {q(S.YES_PHRASE)}) then 1 "
            f"when contains({s}, {q(S.NO_PHRASE)}) then 0 "
            f"when {s} in ({yes}) then 1 when {s} in ({no}) then 0 else null end as double)")


def injury_rank(x: str) -> str:
    s = f"lower({strip(x)})"
    whens = " ".join(f"when {q(k)} then {v}" for k, v in S.INJURY_RANK.items())
    return (f"cast(case {s} {whens} else (case when contains({s}, {q(S.INJURY_FALLBACK_WORD)}) "
            f"then {S.INJURY_FALLBACK_RANK} end) end as double)")


REPORT_COLS = ["report_id", "report_version", "same_incident_id", "injury_text", "airbag_text",
               "towed_text", "automation_level", "era", "roadway_type", "crash_with",
               "sv_movement", "cp_movement", "sv_speed_mph", "report_month", "narrative"]
NUMERIC_REPORT = {"report_version", "sv_speed_mph", "report_month"}
COMPONENTS = ["injury_rank", "airbag_flag", "towed_flag", "injury_flag"]
# columns of the fixture that have NULLs after consolidation (checked by the Spark job)
INDICATOR_COLS = ["injury_text", "airbag_text", "towed_text", "roadway_type", "crash_with",
                  "cp_movement", "sv_speed_mph"]
IMPUTE_NUMERIC = ["sv_speed_mph"]
IMPUTE_TEXT = ["injury_text", "airbag_text", "towed_text", "roadway_type", "crash_with",
               "cp_movement"]


def _consolidate_select() -> str:
    parts = ["incident_key"]
    for c in REPORT_COLS + COMPONENTS:
        if c in NUMERIC_REPORT or c in COMPONENTS:
            parts.append(f"max({c}) as {c}")
        else:
            parts.append(f"first({c} order by report_id nulls last) filter (where {c} is not null) as {c}")
    return ",\n    ".join(parts)


def _clean_select() -> str:
    parts = []
    for c in REPORT_COLS + COMPONENTS + ["severe", "severity_known"]:
        if c in IMPUTE_NUMERIC:
            parts.append(f"coalesce(cast({c} as double), (select median({c}) from labelled)) as {c}")
        elif c in IMPUTE_TEXT:
            parts.append(f"coalesce({c}, {q(S.UNKNOWN_CATEGORY)}) as {c}")
        else:
            parts.append(c)
    for c in INDICATOR_COLS:
        parts.append(f"cast({c} is null as integer) as {c}{S.MISSING_SUFFIX}")
    return "incident_key, " + ", ".join(parts)


def chain() -> str:
    """WITH-clause defining raw_reports, latest, comp, inc, labelled, clean, known."""
    sid = "same_incident_id"
    return f"""with raw_reports as ({RAW_REPORTS_SQL}),
latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by report_id order by (report_version is null) desc,
      report_version desc, source_ord desc, l_shipdate desc, l_partkey desc, l_suppkey desc,
      l_quantity desc, l_extendedprice desc) as rn
    from raw_reports) where rn = 1),
comp0 as (
  select {", ".join(REPORT_COLS)},
    {injury_rank("injury_text")} as injury_rank,
    {yes_flag("airbag_text")} as airbag_flag,
    {yes_flag("towed_text")} as towed_flag
  from latest),
comp as (
  select *, cast(injury_rank >= {S.INJURY_SEVERE_MIN_RANK} as double) as injury_flag,
    case when {sid} is not null and {strip(sid)} <> '' then {sid}
         else concat({q(S.SINGLE_PREFIX)}, coalesce(report_id, 'nan')) end as incident_key
  from comp0),
inc as (
  select {_consolidate_select()}
  from comp group by incident_key),
labelled as (
  select *,
    cast(greatest(coalesce(injury_flag, 0), coalesce(airbag_flag, 0), coalesce(towed_flag, 0)) > 0 as integer) as severe,
    cast(coalesce(injury_flag, airbag_flag, towed_flag) is not null as integer) as severity_known
  from inc),
clean as (
  select {_clean_select()} from labelled),
known as (select * from clean where severity_known = 1)
"""
