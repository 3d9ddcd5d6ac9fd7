"""Catalogue entries for metrics, sweeps, splits and weights.

Metrics are checked on a *given* score: a deterministic expression over the
cleaned incidents that both engines compute bit-for-bit, so the oracle can test
the metric operators without fitting a model.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import flags as FL
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import splits as SP
from ..operators.features import class_weights as cw, pos_weight_grid, standardise
from . import cleaning as C
from .catalog import register
from .oracle import chain, q


def score_expr():
    """Deterministic score in [0, 1] with ties and real signal."""
    speed = F.floor(F.col("sv_speed_mph")).cast("bigint")
    raw = (speed * 7 + F.col("report_month").cast("bigint") * 13
           + F.length("incident_key").cast("bigint")) % 71
    return (F.col("severe").cast("bigint") * 30 + raw) / F.lit(100.0)


SCORE_SQL = ("(cast(severe as bigint) * 30 + (cast(floor(sv_speed_mph) as bigint) * 7 "
             "+ cast(report_month as bigint) * 13 + cast(length(incident_key) as bigint)) % 71) "
             "/ cast(100 as double)")


def scored(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir))
    s = known.withColumn("score", score_expr())
    return s.withColumn("pred", FL.threshold_decision("score", 0.5))


def chain_scored() -> str:
    return chain() + f""", scored as (
  select *, {SCORE_SQL} as score, cast({SCORE_SQL} >= 0.5 as integer) as pred from known),
test as (select * from scored where era = 'current')
"""


def _rates_sql(tp="TP", fp="FP", fn="FN") -> str:
    return (f"round(case when {tp}+{fp} > 0 then {tp}/({tp}+{fp}) else 0 end, 6) as precision, "
            f"round(case when {tp}+{fn} > 0 then {tp}/({tp}+{fn}) else 0 end, 6) as recall, "
            f"round(case when 2*{tp}+{fp}+{fn} > 0 then 2*{tp}/(2*{tp}+{fp}+{fn}) else 0 end, 6) as f1, "
            f"round(case when {tp}+{fn} > 0 then {fn}/({tp}+{fn}) end, 6) as fn_rate")


_CONF_SQL = ("count_if(pred = 1 and severe = 1) as TP, count_if(pred = 1 and severe = 0) as FP, "
             "count_if(pred = 0 and severe = 1) as FN, count_if(pred = 0 and severe = 0) as TN")

_AUC_CTE = """, dist as (
  select {by_sel} score, count_if(severe = 1) as pos, count_if(severe = 0) as neg
  from {src} group by all),
cum as (
  select *, coalesce(sum(neg) over (partition by {by_part} order by score
    rows between unbounded preceding and 1 preceding), 0) as neg_before from dist),
auc as (
  select {by_sel} case when sum(pos) > 0 and sum(neg) > 0 then
    round(sum(pos * (neg_before + neg / 2.0)) / (sum(pos) * sum(neg)), 6) end as roc_auc
  from cum group by all)
"""


def _auc_cte(src: str, by: str | None) -> str:
    return _AUC_CTE.format(src=src, by_sel=f"{by}, " if by else "",
                           by_part=by if by else "1")


# --- F16 ---------------------------------------------------------------------------
@register("confusion", chain_scored() + f"select automation_level, {_CONF_SQL} from test group by all")
def confusion(spark, sf_dir):
    t = scored(spark, sf_dir).where(F.col("era") == "current")
    return M.confusion_counts(t, "severe", "pred", ["automation_level"])


# --- F17 + E3 ----------------------------------------------------------------------
@register("metrics_overall", chain_scored() + _auc_cte("test", None) + f"""
select TP, FP, FN, TN, {_rates_sql()}, (select roc_auc from auc) as roc_auc
from (select {_CONF_SQL} from test)""")
def metrics_overall(spark, sf_dir):
    t = scored(spark, sf_dir).where(F.col("era") == "current")
    return M.evaluate(t, "severe", "pred", "score")


# --- F18: per level, single-class slices skipped ------------------------------------
@register("metrics_sliced", chain_scored() + _auc_cte("test", "automation_level") + f"""
select c.*, a.roc_auc from (
  select automation_level, TP, FP, FN, TN, {_rates_sql()} from (
    select automation_level, {_CONF_SQL} from test group by all)) c
join auc a using (automation_level)
where automation_level in (select automation_level from test group by all
                           having count(distinct severe) = 2)""")
def metrics_sliced(spark, sf_dir):
    t = scored(spark, sf_dir).where(F.col("era") == "current")
    ev = M.evaluate(t, "severe", "pred", "score", ["automation_level"], presence=True)
    return ev.where(M.both_classes()).drop("__pos", "__neg")


# --- E3 ----------------------------------------------------------------------------
@register("roc_auc", chain_scored() + _auc_cte("scored", "era") + "select * from auc")
def roc_auc(spark, sf_dir):
    return M.roc_auc(scored(spark, sf_dir), "severe", "score", ["era"])


# --- F19 ---------------------------------------------------------------------------
def _sweep_sql(src: str) -> str:
    grid = ", ".join(f"({t})" for t in M.THRESHOLDS)
    return f""", grid as (select cast(t as double) as threshold from (values {grid}) g(t)),
sw as (
  select threshold, count_if(score >= threshold and severe = 1) as TP,
    count_if(score >= threshold and severe = 0) as FP,
    count_if(score < threshold and severe = 1) as FN
  from grid cross join {src} group by threshold),
sw2 as (
  select *, TP / greatest(TP + FP, 1) as precision, TP / greatest(TP + FN, 1) as recall from sw),
sw3 as (
  select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall)
    else 0.0 end as f1, cast(precision >= {M.PRECISION_FLOOR} as integer) as meets_floor from sw2)
select threshold, TP, FP, FN, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, meets_floor,
  cast(row_number() over (order by meets_floor desc, f1 desc, recall desc, threshold asc) = 1
       as integer) as chosen
from sw3"""


@register("threshold_sweep", chain_scored() + _sweep_sql("scored"))
def threshold_sweep(spark, sf_dir):
    return M.threshold_sweep(scored(spark, sf_dir), "severe", "score")


# --- B8 ----------------------------------------------------------------------------
@register("false_negatives", chain_scored() + """
select incident_key, automation_level, roadway_type, crash_with, score from test
where pred = 0 and severe = 1""")
def false_negatives(spark, sf_dir):
    t = scored(spark, sf_dir).where(F.col("era") == "current")
    return M.false_negatives(t, "severe", "pred").select(
        "incident_key", "automation_level", "roadway_type", "crash_with", "score")


# --- F9 ----------------------------------------------------------------------------
def _top_sql(col: str, alias: str) -> str:
    return f"""(select automation_level, {col} as {alias} from (
      select automation_level, {col}, row_number() over (partition by automation_level
        order by count(*) desc, {col} asc) as r
      from test where pred = 0 and severe = 1 and {col} is not null group by automation_level, {col}) where r = 1)"""


@register("miss_summary", chain_scored() + f"""
select b.automation_level, b.total_severe, b.FN, round(b.FN / greatest(b.total_severe, 1), 6) as fn_rate,
  coalesce(r.top_roadway, 'N/A') as top_roadway, coalesce(c.top_crash_with, 'N/A') as top_crash_with
from (select automation_level, count_if(severe = 1) as total_severe,
        count_if(pred = 0 and severe = 1) as FN from test group by all) b
left join {_top_sql('roadway_type', 'top_roadway')} r using (automation_level)
left join {_top_sql('crash_with', 'top_crash_with')} c using (automation_level)""")
def miss_summary(spark, sf_dir):
    t = scored(spark, sf_dir).where(F.col("era") == "current")
    return M.miss_summary(t, "severe", "pred", ["automation_level"],
                          {"roadway_type": "top_roadway", "crash_with": "top_crash_with"})


# --- F8 ----------------------------------------------------------------------------
_TOP_COLS = ["roadway_type", "crash_with", "sv_movement", "cp_movement", "automation_level"]


@register("top_categories", chain_scored() + ", fn as (select * from test where pred = 0 and severe = 1)\n"
          + "\nunion all\n".join(f"""select {q(c)} as column_name, cast(r as integer) as rank,
  value, n, round(n / (select count(*) from fn), 6) as share from (
  select {c} as value, count(*) as n, row_number() over (order by count(*) desc, {c} asc) as r
  from fn where {c} is not null group by {c}) where r <= 5""" for c in _TOP_COLS))
def top_categories(spark, sf_dir):
    t = scored(spark, sf_dir).where(F.col("era") == "current")
    fn = M.false_negatives(t, "severe", "pred")
    # one pass over the misses: unpivot the (string) columns, then top-5 per column;
    # NULL values stay in the per-column totals (share is over all misses)
    long = fn.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in _TOP_COLS])))
    return P.top_categories(long, "value", 5, by=["column_name"]).select(
        "column_name", "rank", "value", "n", "share")


# --- G1 / G2 / F15 -----------------------------------------------------------------
@register("split_temporal", chain() + """
, guard as (select count_if(era = 'current') >= 100
    and count(distinct case when era = 'current' then severe end) = 2
    and count(distinct case when era = 'archived' then severe end) = 2 as ok from known)
select incident_key, case when era = 'archived' then 'train' else 'test' end as split
from known where (select ok from guard)""")
def split_temporal(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir))
    s = SP.split_train_test(known)
    return (s.train.select("incident_key", F.lit("train").alias("split"))
            .unionByName(s.test.select("incident_key", F.lit("test").alias("split"))))


@register("split_by_level", chain() + """
, guard as (select automation_level, count_if(era = 'current') >= 50
    and count(distinct case when era = 'current' then severe end) = 2
    and count(distinct case when era = 'archived' then severe end) = 2 as ok
  from known group by all)
select k.automation_level, case when era = 'archived' then 'train' else 'test' end as split,
  'temporal' as split_type, count(*) as n, round(avg(severe), 6) as severe_rate
from known k join guard g using (automation_level) where g.ok group by all""")
def split_by_level(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir))
    guard = SP.temporal_guard(known, min_current=50, by=["automation_level"]).collect()
    out = None
    for g in guard:
        lvl = known.where(F.col("automation_level") == g["automation_level"])
        s = SP.split_within_level(lvl)
        for name, part in (("train", s.train), ("test", s.test)):
            agg = part.groupBy("automation_level").agg(
                F.count(F.lit(1)).alias("n"), F.round(F.avg("severe"), 6).alias("severe_rate"))
            agg = agg.select("automation_level", F.lit(name).alias("split"),
                             F.lit(s.split_type).alias("split_type"), "n", "severe_rate")
            out = agg if out is None else out.unionByName(agg)
    return out


@register("split_summary", chain() + """
select case when era = 'archived' then 'train' else 'test' end as split, count(*) as n,
  round(avg(severe), 6) as severe_rate, count(distinct (severe, automation_level)) as n_strata
from known group by all""")
def split_summary(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir))
    s = SP.split_train_test(known)
    marked = (s.train.withColumn("split", F.lit("train"))
              .unionByName(s.test.withColumn("split", F.lit("test"))))
    return SP.split_summary(marked)


# --- G3 / G4 (the sample, G5: rows / properties only) -------------------------------
@register("split_random", chain() + """,
hashed as (select incident_key, severe, automation_level,
  ('0x' || substr(md5(coalesce(incident_key, '') || ':42'), 1, 15))::bigint as h from known),
outer_rank as (select *, row_number() over (partition by severe, automation_level order by h, incident_key) as i,
  count(*) over (partition by severe, automation_level) as n from hashed),
inner_rank as (select *, row_number() over (partition by severe order by h, incident_key) as j,
  count(*) over (partition by severe) as m from outer_rank where i > round(n * 0.2::double))
select incident_key, case when j <= round(m * 0.25::double) then 'val' else 'fit' end as split from inner_rank
union all select incident_key, 'test' from outer_rank where i <= round(n * 0.2::double)""")
def split_random(spark, sf_dir):
    """Stratified 80/20 on severe x level, then 25% validation of train."""
    known = C.load_known(C.cleaned_incidents(spark, sf_dir))
    marked = SP.stratified_random(known, ["severe", "automation_level"], "incident_key", 0.2)
    train = marked.where("is_test = 0").drop("is_test")
    fit, val = SP.holdout(train)
    return (fit.select("incident_key", F.lit("fit").alias("split"))
            .unionByName(val.select("incident_key", F.lit("val").alias("split")))
            .unionByName(marked.where("is_test = 1").select("incident_key",
                                                            F.lit("test").alias("split"))))


@register("capped_sample", chain() + """,
hashed as (select incident_key, severe,
  ('0x' || substr(md5(coalesce(incident_key, '') || ':42'), 1, 15))::bigint as h from known)
select incident_key, severe from hashed order by h, incident_key limit 2000""")
def capped_sample(spark, sf_dir):
    """2,000-row hash-ordered sample (the reference's silhouette sample size)."""
    known = C.load_known(C.cleaned_incidents(spark, sf_dir, []))
    return SP.capped_sample(known, "incident_key", 2000).select("incident_key", "severe")


# --- H5 / H6 / H7 ------------------------------------------------------------------
@register("standardise", chain() + """
select incident_key,
  round(case when s1 = 0 then 0 else (sv_speed_mph - m1) / s1 end, 6) as sv_speed_mph,
  round(case when s2 = 0 then 0 else (report_month - m2) / s2 end, 6) as report_month,
  round(case when s3 = 0 then 0 else (severity_known - m3) / s3 end, 6) as severity_known
from known, (select avg(sv_speed_mph) m1, stddev_pop(sv_speed_mph) s1, avg(report_month) m2,
  stddev_pop(report_month) s2, avg(severity_known) m3, stddev_pop(severity_known) s3 from known)""")
def standardise_q(spark, sf_dir):
    known = C.load_known(C.cleaned_incidents(spark, sf_dir))
    cols = ["sv_speed_mph", "report_month", "severity_known"]
    out, _ = standardise(known, cols)
    return out.select("incident_key", *[F.round(c, 6).alias(c) for c in cols])


@register("class_weights", """
select 'toxic' as label_name, toxic as class, count(*) as n,
  round(sum(count(*)) over () / (2.0 * count(*)), 6) as weight from labels group by all
union all
select 'quality', quality, count(*), round(sum(count(*)) over () / (2.0 * count(*)), 6)
from labels group by all""")
def class_weights_q(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = None
    for c in ("toxic", "quality"):
        part = cw(labels, c).select(F.lit(c).alias("label_name"), F.col(c).alias("class"),
                                    "n", F.round("weight", 6).alias("weight"))
        out = part if out is None else out.unionByName(part)
    return out


@register("scale_pos_weight", """
select 'toxic' as label_name, o as option, round(v, 3) as spw from (
  select unnest([1.0, (neg / greatest(pos, 1)) / 2, neg / greatest(pos, 1)]) as v,
         unnest([0, 1, 2]) as o
  from (select count_if(toxic = 0) as neg, count_if(toxic = 1) as pos from labels))""")
def scale_pos_weight(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pos_weight_grid(labels, "toxic").select(F.lit("toxic").alias("label_name"), "option",
                                                   F.round("spw", 3).alias("spw"))
