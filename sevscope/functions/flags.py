"""Column expressions for the severity label and small scalar rules.

All are native Catalyst expressions: they stay inside whole-stage codegen and
never leave the JVM.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def _norm(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.btrim(col.cast("string"), F.lit(S.WHITESPACE)))


def yes_flag(c) -> Column:
    """Yes/no text -> 1.0 / 0.0 / NULL.

    The phrase rules override the token rules; "yes subject vehicle" wins over
    "no subject vehicle" when both appear.
    """
    s = _norm(c)
    return (F.when(s.contains(S.YES_PHRASE), F.lit(1.0))
             .when(s.contains(S.NO_PHRASE), F.lit(0.0))
             .when(s.isin(*S.YES_TOKENS), F.lit(1.0))
             .when(s.isin(*S.NO_TOKENS), F.lit(0.0))
             .otherwise(F.lit(None).cast("double")))


def injury_rank(c) -> Column:
    """Injury text -> rank 0..4, with any text containing "fatality" -> 4."""
    s = _norm(c)
    mapping = F.create_map(*[x for k, v in S.INJURY_RANK.items()
                             for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(
        F.try_element_at(mapping, s),
        F.when(s.contains(S.INJURY_FALLBACK_WORD), F.lit(float(S.INJURY_FALLBACK_RANK))),
    ).cast("double")


def injury_flag(rank) -> Column:
    """rank >= 2 as 1.0/0.0; NULL rank stays NULL (C4)."""
    r = F.col(rank) if isinstance(rank, str) else rank
    return (r >= F.lit(S.INJURY_SEVERE_MIN_RANK)).cast("double")


def incident_key(same_incident_col="same_incident_id", report_col="report_id") -> Column:
    """Shared incident id when present and non-blank (kept untrimmed), else SINGLE_<report id>."""
    sid = F.col(same_incident_col)
    rid = F.col(report_col)
    fallback = F.concat(F.lit(S.SINGLE_PREFIX), F.coalesce(rid.cast("string"), F.lit("nan")))
    return F.when(sid.isNotNull() & (F.btrim(sid, F.lit(S.WHITESPACE)) != F.lit("")), sid).otherwise(fallback)


def severe(*flags: str) -> Column:
    """Any component equal to 1; NULL counts as 0."""
    cols = flags or ("injury_flag", "airbag_flag", "towed_flag")
    return (F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in cols]) > 0).cast("int")


def severity_known(*flags: str) -> Column:
    """At least one component known."""
    cols = flags or ("injury_flag", "airbag_flag", "towed_flag")
    return F.coalesce(*[F.col(c) for c in cols]).isNotNull().cast("int")


def threshold_decision(prob, t: float) -> Column:
    """prob >= t as 0/1."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return (p >= F.lit(float(t))).cast("int")


# Veltkamp splitter for doubles (2^27 + 1), used by the error-free product below
_SPLIT = 134217729.0


def round1(x) -> Column:
    """Python's ``round(x, 1)`` for doubles: half-even on the exact binary value (C14).

    ``bround`` rounds the double's shortest decimal text, which differs from Python
    at ties that are not exactly representable (0.05, 0.15, 0.35, ...: the double
    is just below or above the tie). Here the side of the tie is decided exactly:
    ``x * 10 = p + err`` with Dekker's error-free product, and ``p - (f + 0.5)`` for
    ``f = floor(p)`` is exact (Sterbenz), so ``d`` has the sign of ``x*10 - (f + 0.5)``.
    Plain double arithmetic, so the DuckDB oracle states the same steps.
    """
    a = (F.col(x) if isinstance(x, str) else x).cast("double")
    p = a * 10.0
    c = a * _SPLIT
    ah = c - (c - a)
    al = a - ah
    err = (ah * 10.0 - p) + al * 10.0
    f = F.floor(p).cast("double")
    d = (p - (f + 0.5)) + err
    up = (d > 0) | ((d == 0) & (F.pmod(f, F.lit(2.0)) == 1.0))
    return F.when(up, f + 1.0).otherwise(f) / 10.0


def value_with_pct(value, share) -> Column:
    """"value (NN%)" with NN rounded half-even, as Python's '%.0f' does (C14)."""
    v = F.col(value) if isinstance(value, str) else value
    s = F.col(share) if isinstance(share, str) else share
    return F.format_string("%s (%.0f%%)", v, F.bround(s * 100.0, 0))
