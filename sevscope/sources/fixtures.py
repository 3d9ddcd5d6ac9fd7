"""Derived report views over the driver's tables.

The reference's raw extracts are not distributed, so the test input is a view of
``lineitem`` shaped like the raw report schema (``FIXTURES.md`` §2). The SQL text
is portable: Spark and DuckDB compute identical rows from it, which is what lets
the oracle queries in ``plans.catalog`` start from the same input.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import ARCHIVED_RENAME
from ..session import side_by_side

# Order columns that make "latest version" a total order on this view: the view
# stands in for the stable row order of concatenated source files.
TIEBREAK_COLS = ["source_ord", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice"]

RAW_REPORTS_SQL = """
select
  concat('R', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as report_id,
  case when l_partkey % 5 = 0 then null else cast(l_partkey % 5 as double) end as report_version,
  case when l_suppkey % 3 = 0 then null
       when l_suppkey % 7 = 0 then '  '
       else concat('I', cast(l_orderkey as string)) end as same_incident_id,
  case l_partkey % 9 when 0 then 'No Injuries Reported' when 1 then 'Minor'
       when 2 then ' Moderate W/ Hospitalization ' when 3 then 'Serious'
       when 4 then 'Fatality - Other' when 5 then 'Unknown' when 6 then 'No Apparent Injury'
       when 7 then 'Minor W/O Hospitalization' else null end as injury_text,
  case l_partkey % 7 when 0 then ' Yes ' when 1 then 'N' when 2 then 'No Subject Vehicle'
       when 3 then 'Yes Subject Vehicle' when 4 then 'Not Applicable' when 5 then 'Unknown' else null end as airbag_text,
  case when l_suppkey % 3 = 1 and l_partkey % 4 <> 0 then 'Yes'
       when l_partkey % 11 = 0 then null else 'No' end as towed_text,
  case when l_linestatus = 'O' then 'ADS' else 'L2' end as automation_level,
  case when year(l_shipdate) < 1998 then 'archived' else 'current' end as era,
  case l_suppkey % 5 when 0 then 'Street' when 1 then 'Highway / Freeway' when 2 then 'Intersection'
       when 3 then 'Parking Lot' else null end as roadway_type,
  case l_partkey % 6 when 0 then 'SUV' when 1 then 'Passenger Car' when 2 then 'Animal'
       when 3 then 'Other Fixed Object' when 4 then 'Non-Motorist: Cyclist' else null end as crash_with,
  case l_suppkey % 3 when 0 then 'Stopped' when 1 then 'Proceeding Straight' else 'Making Left Turn' end as sv_movement,
  case l_linenumber when 1 then 'Backing' when 2 then 'Changing Lanes' when 3 then null else 'Proceeding Straight' end as cp_movement,
  case when l_partkey % 8 = 0 then null else l_quantity end as sv_speed_mph,
  cast(month(l_shipdate) as int) as report_month,
  case when l_partkey % 13 = 0 then null
       when l_partkey % 17 = 0 then '[REDACTED, MAY CONTAIN CONFIDENTIAL BUSINESS INFORMATION]'
       when l_partkey % 19 = 0 then 'Short text.'
       else concat(
         case when l_suppkey % 4 = 0 then 'Pursuant to the Standing General Order, this report is filed. ' else '' end,
         'The subject vehicle was ',
         case l_suppkey % 3 when 0 then 'stopped at a red light' when 1 then 'traveling at 30 mph on the highway' else 'turning left in a parking lot' end,
         ' when the other ',
         case l_partkey % 4 when 0 then 'bus' when 1 then 'car' when 2 then 'cyclist' else 'truck' end,
         case l_partkey % 3 when 0 then ' struck the subject vehicle.' when 1 then ' approached from behind.' else ' merged into the lane.' end,
         case l_linenumber when 1 then ' The operator disengaged.' when 2 then ' Police arrived.' when 3 then ' There was minor damage.'
              when 4 then ' Hazard lights were on.' when 5 then ' It was double-parked.' when 6 then ' It then backed up.' else ' [XXX]' end)
  end as narrative,
  case when l_linestatus = 'O' then 0 else 1 end as source_ord,
  l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
from lineitem
"""

# Internal-name -> archived raw-style name, used to rebuild the archived extracts.
_ARCHIVED_INTERNAL = {"airbag_text": "sv_airbag_text", "towed_text": "sv_towed_text"}


def register_tables(spark: SparkSession, sf_dir: str, names=("lineitem",)) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet").createOrReplaceTempView(n)


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived report view (one row per report version)."""
    lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    # Bind the scan as a SQL parameter rather than a global temp view.
    return spark.sql(RAW_REPORTS_SQL.replace("from lineitem", "from {lineitem}"), lineitem=lineitem)


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Split the view into per-era extracts; archived ones carry archived column names.

    Mirrors the reference's four raw inputs (current/archived x level) closely enough
    to exercise schema harmonisation (B1) and union-by-name (B2).
    """
    raw = raw_reports(spark, sf_dir)
    out = {}
    for era in ("current", "archived"):
        part = raw.where(raw.era == era)
        if era == "archived":
            part = part.withColumnsRenamed(_ARCHIVED_INTERNAL)
        out[era] = part
    return out


def archived_internal_rename() -> dict[str, str]:
    """Archived internal name -> current internal name (mirror of ARCHIVED_RENAME)."""
    return {v: k for k, v in _ARCHIVED_INTERNAL.items()}


__all__ = ["RAW_REPORTS_SQL", "TIEBREAK_COLS", "raw_reports", "raw_extracts",
           "archived_internal_rename", "register_tables", "ARCHIVED_RENAME"]


def write_raw_extracts(spark: SparkSession, sf_dir: str, out_dir: str) -> list:
    """Write the view as four raw CSV extracts (level x era), raw column names,
    archived ones with archived names and Latin-1 for the archived L2 file, as the
    reference's inputs are laid out. Returns the ``Extract`` list to scan them."""
    from .. import schema as S
    from .extracts import Extract
    inv = {v: k for k, v in S.RAW_TO_INTERNAL.items()}
    arch_inv = {v: k for k, v in S.ARCHIVED_RENAME.items()}
    raw = raw_reports(spark, sf_dir)
    cols = [c for c in raw.columns if c in inv]

    def write(extract: Extract) -> None:
        part = raw.where((raw.automation_level == extract.automation_level) & (raw.era == extract.era))
        names = {c: inv[c] for c in cols}
        if extract.era == "archived":
            names = {c: arch_inv.get(n, n) for c, n in names.items()}
        (part.select(*[part[c].alias(n) for c, n in names.items()])
             .write.mode("overwrite").option("header", True).option("encoding", extract.encoding)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .csv(extract.path))

    out = [Extract(f"{out_dir.rstrip('/')}/{level}_{era}", enc, level, era)
           for level, era, enc in (("ADS", "current", "UTF-8"), ("L2", "current", "UTF-8"),
                                   ("ADS", "archived", "UTF-8"), ("L2", "archived", "ISO-8859-1"))]
    side_by_side(write, out)
    return out
