"""Every registered query of the engine's own operators, and the SQL it must agree with.

The tables at hand are no clinical ones, so views of them stand in: user activity for concept
events, users for subjects, order and shipping dates for linked stays. Floating-point results
are rounded to six decimals on both sides.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.functions.aggregates import in_range
from staygrid.operators import compare, grid, items, mapping, validate, wide
from staygrid.operators.paired import Paired
from staygrid.plans import build, identifiers, inventory, review, scope
from staygrid.plans.comparison import Comparison, compare_files, compare_tables, overview, write_plain_reports
from staygrid.plans.versions import DatasetVersion, VersionPair
from staygrid.registry import REFERENCE_STAY_SPACES, stay_spec
from staygrid.session import shared_folder, use_clusters, use_utc
from staygrid.sources import commits, layout, sinks
from staygrid.sources import events as ev
from staygrid.sources import reference as ref
from staygrid.sources import stays as st
from staygrid.sources.concept_dict import ConceptDict
from staygrid.sources.place import Place

FLAGSHIP = "wide_all_concepts"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
CONCEPTS = ["click", "error", "purchase", "signup", "view"]
MIXED = {"click": "median", "error": "mean", "purchase": "sum", "signup": "max", "view": "min"}
MEANS = dict.fromkeys(CONCEPTS, "mean")


def _query(sql: str | None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(use_utc(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# --- stand-in views -------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("subject_id"), F.col("ts").alias("time"), F.col("value").alias("numeric_value"), F.col("event_type").alias("concept"), "event_id")


def _holes(events: DataFrame) -> DataFrame:
    return events.withColumn("numeric_value", F.when(F.col("event_id") % 17 != 0, F.col("numeric_value")))


def _stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stay for each subject, from first to last event."""
    e = _table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("subject_id")).agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime")).withColumn("stay_id", F.col("subject_id"))


def _multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping stays for each subject; the second of every fifth subject is open."""
    one = _stays(spark, sf_dir).drop("stay_id")
    a = one.select("subject_id", (F.col("subject_id") * 10).alias("stay_id"), "intime", F.expr("intime + interval 10 days").alias("outtime"))
    b = one.select("subject_id", (F.col("subject_id") * 10 + 1).alias("stay_id"), F.expr("intime + interval 5 days").alias("intime"), F.when(F.col("subject_id") % 5 != 0, F.col("outtime")).alias("outtime"))
    return a.unionByName(b)


def _hour_stays(stays: DataFrame) -> DataFrame:
    hours = lambda c: (F.unix_millis(F.col(c).cast("timestamp")) / F.lit(3_600_000.0)).alias(f"{c}_hours")
    return stays.select("subject_id", "stay_id", hours("intime"), hours("outtime"))


def _orders_as_stays(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as stays of 90 days, and shipped lines as events linked to them."""
    orders, lines = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    stays = orders.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("stay_id"), F.col("o_orderdate").alias("intime"), F.expr("o_orderdate + interval 90 days").alias("outtime"))
    subject = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subject_id"))
    rows = lines.join(subject, "l_orderkey").select(
        "subject_id", F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("numeric_value"), F.col("l_orderkey").alias("visit_occurrence_id"),
        F.col("l_returnflag").alias("concept"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
    )
    return stays, rows


def _mapped(spark: SparkSession, sf_dir: str, holes: bool = False) -> DataFrame:
    e = _ev(spark, sf_dir)
    return mapping.map_by_time(ev.subject_events(_holes(e) if holes else e), _stays(spark, sf_dir))


def _wide_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.wide_table(_mapped(spark, sf_dir, holes=True), MEANS)


def _wide_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As _wide_a with other stays, values, rows and concepts, and with half of the values that are missing there."""
    e = _ev(spark, sf_dir).where("subject_id % 7 <> 0 and event_id % 13 <> 0")
    value = F.when(F.col("event_id") % 11 == 0, F.col("numeric_value") + 0.5).otherwise(F.col("numeric_value"))
    e = e.withColumn("numeric_value", F.when(F.col("event_id") % 34 != 17, value))
    return wide.wide_table(mapping.map_by_time(ev.subject_events(e), _stays(spark, sf_dir)), {c: "mean" for c in CONCEPTS if c != "view"})


def _crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _table(spark, sf_dir, "events").select("user_id").distinct().where("user_id % 2 = 0")
    return users.select(F.col("user_id").alias("reference_stay_id"), (F.col("user_id") + 100_000).alias("candidate_stay_id"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    names = columns or [c for c, t in df.dtypes if t in ("double", "float") or t.startswith("decimal")]
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), 6) for c in names})


EV = "ev AS (SELECT user_id AS subject_id, ts AS time, value AS numeric_value, event_type AS concept, event_id FROM events)"
HOLES = "holes AS (SELECT subject_id, time, CASE WHEN event_id % 17 <> 0 THEN numeric_value END AS numeric_value, concept, event_id FROM ev)"
STAYS = "stays AS (SELECT user_id AS subject_id, user_id AS stay_id, min(ts) AS intime, max(ts) AS outtime FROM events GROUP BY user_id)"
MULTI = STAYS + """, multi AS (SELECT subject_id, subject_id * 10 AS stay_id, intime, intime + INTERVAL 10 DAY AS outtime FROM stays
  UNION ALL SELECT subject_id, subject_id * 10 + 1, intime + INTERVAL 5 DAY, CASE WHEN subject_id % 5 <> 0 THEN outtime END FROM stays)"""
HOUR = "CAST(floor((epoch_us(e.time) - epoch_us(s.intime)) // 1000000 / 3600.0) AS BIGINT)"
INSIDE = "e.time >= s.intime AND (s.outtime IS NULL OR e.time <= s.outtime)"
ORDERS = """ostays AS (SELECT o_custkey AS subject_id, o_orderkey AS stay_id, o_orderdate AS intime, o_orderdate + INTERVAL 90 DAY AS outtime FROM orders),
lines AS (SELECT o_custkey AS subject_id, l_shipdate AS time, l_quantity AS numeric_value, l_orderkey AS visit, l_returnflag AS concept, l_orderkey * 10 + l_linenumber AS event_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _mapped_sql(source: str = "ev", stays: str = "stays") -> str:
    return f"mapped AS (SELECT s.stay_id, {HOUR} AS time, e.time AS at, e.numeric_value, e.concept, e.event_id FROM {source} e JOIN {stays} s ON e.subject_id = s.subject_id WHERE {INSIDE})"


def _agg_sql(name: str, where: str = "") -> str:
    f = f" FILTER ({where})" if where else ""
    return {
        "mean": f"avg(numeric_value){f}", "median": f"median(numeric_value){f}", "min": f"min(numeric_value){f}", "max": f"max(numeric_value){f}",
        "sum": f"CASE WHEN count(*){f} > 0 THEN coalesce(sum(numeric_value){f}, 0) END",
        "first": f'arg_min(numeric_value, struct_pack(a := "at", b := numeric_value)){f}', "last": f'arg_max(numeric_value, struct_pack(a := "at", b := numeric_value)){f}',
    }[name]


def _wide_sql(aggregates: dict[str, str], source: str = "mapped") -> str:
    cells = ", ".join(f"""round({_agg_sql(a, f"concept = '{c}'")}, 6) AS "{c}" """ for c, a in aggregates.items())
    return f"SELECT stay_id, time, {cells} FROM {source} GROUP BY stay_id, time"


WIDE_A = f"""{EV}, {HOLES}, {STAYS}, {_mapped_sql("holes")},
a AS (SELECT stay_id, time, {", ".join(f"avg(numeric_value) FILTER (concept = '{c}') AS {c}" for c in CONCEPTS)} FROM mapped GROUP BY stay_id, time)"""
_B = [c for c in CONCEPTS if c != "view"]
WIDE_B = f"""changed AS (SELECT subject_id, time, CASE WHEN event_id % 34 = 17 THEN NULL WHEN event_id % 11 = 0 THEN numeric_value + 0.5 ELSE numeric_value END AS numeric_value, concept, event_id
  FROM ev WHERE subject_id % 7 <> 0 AND event_id % 13 <> 0),
{_mapped_sql("changed").replace("mapped AS", "mapped_b AS")},
b AS (SELECT stay_id, time, {", ".join(f"avg(numeric_value) FILTER (concept = '{c}') AS {c}" for c in _B)} FROM mapped_b WHERE concept <> 'view' GROUP BY stay_id, time)"""
BOTH = f"{WIDE_A}, {WIDE_B}"

# --- scans, filters, times ------------------------------------------------------------------


@_query(f"WITH {EV} SELECT subject_id, time, numeric_value, concept, event_id FROM ev")
def scan_subject_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.subject_events(_ev(spark, sf_dir))


@_query(f"WITH {EV}, {HOLES} SELECT subject_id, time, numeric_value, concept, event_id FROM holes WHERE numeric_value >= 50 AND numeric_value <= 200")
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.subject_events(_holes(_ev(spark, sf_dir))).where(in_range(low=50, high=200))


@_query(f"WITH {EV} SELECT subject_id, time, numeric_value, concept, event_id FROM ev WHERE event_id % 2 <> 0")
def version_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _ev(spark, sf_dir).withColumn("dataset_version", F.when(F.col("event_id") % 2 == 0, "2.2").otherwise("3.1"))
    return ev.subject_events(e, "3.1")


@_query(f"WITH {EV} SELECT event_id, epoch_us(time) // 1000 / 3600000.0 AS time_hours FROM ev")
def time_as_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.subject_events_in_hours(_ev(spark, sf_dir)).select("event_id", "time_hours")


@_query("SELECT o_orderkey AS stay_id, CAST(year(o_orderdate) - 1992 AS BIGINT) AS time, o_totalprice AS numeric_value FROM orders")
def scan_stay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("stay_id"), (F.year("o_orderdate") - 1992).alias("time"), F.col("o_totalprice").alias("numeric_value"))
    return ev.stay_events(o).select("stay_id", "time", "numeric_value")


# --- stays and mapping ----------------------------------------------------------------------


@_query("SELECT user_id AS subject_id, user_id AS stay_id, min(epoch_us(ts) // 1000 / 3600000.0) AS intime_hours, max(epoch_us(ts) // 1000 / 3600000.0) FILTER (event_type <> 'signup') AS outtime_hours FROM events GROUP BY user_id HAVING count(*) FILTER (event_type <> 'error') > 0")
def stays_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _ev(spark, sf_dir)
    have = e.where("concept <> 'error'").select("subject_id").distinct()
    return st.stays_from_observations(e.join(have, "subject_id", "left_semi"), e.where("concept <> 'signup'"))


@_query("""SELECT o_custkey AS subject_id, o_orderkey AS stay_id, epoch_us(o_orderdate) // 1000 / 3600000.0 AS intime_hours, epoch_us(l_shipdate) // 1000 / 3600000.0 AS outtime_hours
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber = 2) ON l_orderkey = o_orderkey""")
def stays_visit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem").where("l_linenumber = 2")
    starts = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("time"), F.col("o_orderkey").alias("visit_occurrence_id"))
    owner = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subject_id"))
    ends = li.join(owner, "l_orderkey").select("subject_id", F.col("l_shipdate").alias("time"), F.col("l_orderkey").alias("visit_occurrence_id"))
    return st.stays_from_visits(starts, ends)


@_query("""SELECT o_custkey AS subject_id, o_orderkey AS stay_id, epoch_us(o_orderdate) // 1000 / 3600000.0 AS intime_hours, o.at AS outtime_hours
FROM orders LEFT JOIN (SELECT l_orderkey, max(epoch_us(l_shipdate) // 1000 / 3600000.0) AS at FROM lineitem GROUP BY 1) o ON l_orderkey = o_orderkey""")
def stays_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    admissions = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("time"), F.col("o_orderkey").alias("case_id"))
    observations = li.select(F.col("l_suppkey").alias("subject_id"), F.col("l_shipdate").alias("time"), F.col("l_orderkey").alias("case_id"))
    return st.stays_from_observations(admissions, observations, "case_id")


@_query(f"WITH {EV}, {MULTI} SELECT s.stay_id, {HOUR} AS time, e.event_id, e.numeric_value FROM ev e JOIN multi s ON e.subject_id = s.subject_id WHERE {INSIDE}")
def map_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mapping.map_by_time(ev.subject_events(_ev(spark, sf_dir)), _multi(spark, sf_dir))
    return out.select("stay_id", "time", "event_id", "numeric_value")


@_query(f"WITH {EV}, {MULTI} SELECT s.stay_id, {HOUR} AS time, e.event_id, e.numeric_value FROM ev e JOIN multi s ON e.subject_id = s.subject_id WHERE e.time >= s.intime")
def map_no_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mapping.map_by_time(ev.subject_events(_ev(spark, sf_dir)), _multi(spark, sf_dir), window=False)
    return out.select("stay_id", "time", "event_id", "numeric_value")


@_query(f"""WITH {ORDERS} SELECT s.stay_id, CAST(floor(epoch_us(e.time) // 1000 / 3600000.0 - epoch_us(s.intime) // 1000 / 3600000.0) AS BIGINT) AS time, e.event_id, e.numeric_value
FROM lines e JOIN ostays s ON e.subject_id = s.subject_id AND e.visit = s.stay_id WHERE {INSIDE}""")
def map_by_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays, rows = _orders_as_stays(spark, sf_dir)
    out = mapping.map_by_hours(ev.subject_events_in_hours(rows), _hour_stays(stays))
    return out.select("stay_id", "time", "event_id", "numeric_value")


@_query(f"WITH {EV}, {STAYS} SELECT e.event_id, {HOUR} AS time FROM ev e JOIN stays s ON e.subject_id = s.subject_id")
def hour_bin_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_by_time(ev.subject_events(_ev(spark, sf_dir)), _stays(spark, sf_dir)).select("event_id", "time")


@_query(f"WITH {EV}, {STAYS} SELECT e.event_id, CAST(floor(epoch_us(e.time) // 1000 / 3600000.0 - epoch_us(s.intime) // 1000 / 3600000.0) AS BIGINT) AS time FROM ev e JOIN stays s ON e.subject_id = s.subject_id")
def hour_bin_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_by_hours(ev.subject_events_in_hours(_ev(spark, sf_dir)), _hour_stays(_stays(spark, sf_dir))).select("event_id", "time")


@_query("SELECT user_id AS stay_id, CAST(floor(event_id / 60.0) AS BIGINT) AS time, event_id, value AS numeric_value FROM events")
def identity_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _ev(spark, sf_dir).withColumn("time", F.col("event_id"))
    minutes = ev.subject_events_in_hours(e, 1.0).withColumn("time_hours", F.col("event_id") / F.lit(60.0))
    return mapping.map_identity(minutes).select("stay_id", "time", "event_id", "numeric_value")


@_query("""SELECT o_custkey AS subject_id, o_orderkey AS stay_id, round(h, 6) AS intime_hours, round(h + span / 60.0, 6) AS outtime_hours FROM (SELECT *, o_custkey % 5000 AS span,
epoch_us(CAST(year(o_orderdate) || '-01-01 ' || printf('%02d:%02d:%02d', o_orderkey % 24, o_orderkey % 60, o_custkey % 60) AS TIMESTAMP)) // 1000 / 3600000.0 - (o_orderkey % 4001 - 2000) / 60.0 AS h FROM orders)""")
def eicu_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission made of the discharge year, the time of day and an offset in minutes."""
    key, other = F.col("o_orderkey"), F.col("o_custkey")
    table = _table(spark, sf_dir, "orders").select(
        key.alias("patientunitstayid"), other.alias("patienthealthsystemstayid"), F.year("o_orderdate").alias("hospitaldischargeyear"),
        F.format_string("%02d:%02d:%02d", key % 24, key % 60, other % 60).alias("hospitaladmittime24"), (key % 4001 - 2000).alias("hospitaladmitoffset"), (other % 5000).alias("unitdischargeoffset"),
    )
    return _rounded(st.normalized_stays(table, stay_spec("eicu")))


# --- aggregates -----------------------------------------------------------------------------


def _aggregate_query(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(wide.hourly(_mapped(spark, sf_dir, holes=True), name))

    run.__name__ = f"agg_{name}"
    _query(f"WITH {EV}, {HOLES}, {STAYS}, {_mapped_sql('holes')} SELECT stay_id, time, round({_agg_sql(name)}, 6) AS value FROM mapped GROUP BY stay_id, time")(run)


for _name in ("mean", "median", "sum", "min", "max"):
    _aggregate_query(_name)


def _edge_query(name: str) -> None:
    """First or last value of an hour: without nulls, whose place in time engines order differently."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(wide.hourly(_mapped(spark, sf_dir), name))

    run.__name__ = f"agg_{name}"
    _query(f"WITH {EV}, {STAYS}, {_mapped_sql()} SELECT stay_id, time, round({_agg_sql(name)}, 6) AS value FROM mapped GROUP BY stay_id, time")(run)


_edge_query("first")
_edge_query("last")


@_query(f"WITH {EV}, {HOLES}, {STAYS}, {_mapped_sql('holes')} {_wide_sql(MIXED)}")
def agg_policy_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(wide.wide_table(_mapped(spark, sf_dir, holes=True), MIXED))


# --- wide tables and grids ------------------------------------------------------------------


@_query(f"WITH {EV}, {STAYS}, {_mapped_sql()} {_wide_sql(MEANS)}")
def wide_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(wide.wide_table(_mapped(spark, sf_dir), MEANS))


@_query(f"WITH {EV}, {STAYS}, {_mapped_sql()} {_wide_sql(MIXED)}")
def wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form for very many concepts, over few."""
    return _rounded(wide.wide_table(_mapped(spark, sf_dir), MIXED, widest=2))


@_query(f"""WITH {ORDERS}, mapped AS (SELECT s.stay_id, CAST(floor(epoch_us(e.time) // 1000 / 3600000.0 - epoch_us(s.intime) // 1000 / 3600000.0) AS BIGINT) AS time, e.time AS at, e.numeric_value, e.concept
FROM lines e JOIN ostays s ON e.subject_id = s.subject_id AND e.visit = s.stay_id WHERE {INSIDE}) {_wide_sql({"A": "median", "N": "sum", "R": "max"})}""")
def wide_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays, rows = _orders_as_stays(spark, sf_dir)
    return _rounded(wide.wide_table(mapping.map_by_hours(ev.subject_events_in_hours(rows), _hour_stays(stays)), {"A": "median", "N": "sum", "R": "max"}))


_END = "(epoch_us(outtime) - epoch_us(intime)) // 1000000 / 3600.0"
_LENGTH = "(epoch_us(outtime) // 1000 / 3600000.0 - epoch_us(intime) // 1000 / 3600000.0)"


def _grid_sql(end: str, source: str) -> str:
    return f"SELECT stay_id, unnest(generate_series(0, CAST({end} AS BIGINT))) AS time FROM {source}"


@_query(f"WITH {MULTI} {_grid_sql(f'least(CASE WHEN outtime IS NULL OR outtime < intime THEN 0 ELSE floor({_END}) END, 168)', 'multi')}")
def grid_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.grid_from_times(_multi(spark, sf_dir))


@_query(f"WITH {MULTI} {_grid_sql(f'least(CASE WHEN outtime IS NULL OR outtime < intime THEN 0 ELSE ceil({_END}) END, 168)', 'multi')}")
def grid_ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.grid_from_times(_multi(spark, sf_dir), rounding="ceil")


@_query(f"WITH {MULTI} {_grid_sql(f'CASE WHEN outtime IS NULL OR {_LENGTH} < 0 THEN 48 ELSE least(floor({_LENGTH}), 48) END', 'multi')}")
def grid_null_los(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.grid_from_hours(_hour_stays(_multi(spark, sf_dir)), 48)


_ON_GRID = "SELECT g.stay_id, g.time, click, error, purchase, signup, view FROM grid g LEFT JOIN w ON g.stay_id = w.stay_id AND g.time = w.time"


@_query(f"WITH {EV}, {STAYS}, {_mapped_sql()}, w AS ({_wide_sql(MIXED)}), grid AS ({_grid_sql(f'least(floor({_END}), 168)', 'stays')}) {_ON_GRID}")
def wide_grid_168(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wide.wide_table(_mapped(spark, sf_dir), MIXED)
    return _rounded(wide.on_grid(w, grid.grid_from_times(_stays(spark, sf_dir))))


@_query(f"WITH {EV}, {STAYS}, {_mapped_sql()}, w AS ({_wide_sql(MIXED)}), grid AS ({_grid_sql(f'floor({_END})', 'stays')}) {_ON_GRID}")
def wide_all_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wide.wide_table(_mapped(spark, sf_dir), MIXED)
    return _rounded(wide.on_grid(w, grid.grid_from_times(_stays(spark, sf_dir), None)))


@_query(f"""WITH {EV}, {HOLES}, {STAYS}, mapped AS (SELECT s.stay_id, CAST(floor(epoch_us(e.time) // 1000 / 3600000.0 - epoch_us(s.intime) // 1000 / 3600000.0) AS BIGINT) AS time, e.time AS at, e.numeric_value, e.concept
FROM holes e JOIN stays s ON e.subject_id = s.subject_id WHERE {INSIDE}), w AS ({_wide_sql(MIXED)}), grid AS ({_grid_sql(f'least(floor({_LENGTH}), 168)', 'stays')}) {_ON_GRID}""")
def wide_all_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every concept without a range filter, on the grid of stays in hours, in order."""
    stays = _hour_stays(_stays(spark, sf_dir))
    mapped = mapping.map_by_hours(ev.subject_events_in_hours(_holes(_ev(spark, sf_dir))), stays).where("time <= 168")
    return _rounded(wide.ordered(wide.on_grid(wide.wide_table(mapped, MIXED), grid.grid_from_hours(stays, 168)), CONCEPTS))


# --- comparison reports ---------------------------------------------------------------------


@_query(f"WITH {WIDE_A} SELECT 'candidate' AS \"table\", count(*) AS n_rows, count(DISTINCT stay_id) AS n_stays, min(time) AS min_time, max(time) AS max_time FROM a")
def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.table_summary(_wide_a(spark, sf_dir), "candidate")


def _overlap_sql(keys: str, what: str) -> str:
    return f"""WITH {BOTH}, ka AS (SELECT DISTINCT {keys} FROM a), kb AS (SELECT DISTINCT {keys} FROM b)
SELECT (SELECT count(*) FROM ka) AS n_candidate_{what}, (SELECT count(*) FROM kb) AS n_reference_{what}, (SELECT count(*) FROM (FROM ka INTERSECT FROM kb)) AS n_common_{what},
(SELECT count(*) FROM (FROM ka EXCEPT FROM kb)) AS n_only_candidate_{what}, (SELECT count(*) FROM (FROM kb EXCEPT FROM ka)) AS n_only_reference_{what}"""


@_query(_overlap_sql("stay_id, time", "keys"))
def key_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.key_overlap(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir))


@_query(_overlap_sql("stay_id", "stays"))
def stay_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.stay_overlap(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir))


@_query(f"WITH {BOTH} " + " UNION ALL ".join(f"SELECT '{c}' AS concept, (SELECT count({c}) FROM a) AS candidate_non_null, (SELECT count({c}) FROM b) AS reference_non_null, (SELECT count({c}) FROM a) - (SELECT count({c}) FROM b) AS diff_non_null" for c in _B))
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.coverage(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir))


JOINED = f"{BOTH}, j AS (SELECT a.stay_id, a.time, {', '.join(f'a.{c} AS {c}, b.{c} AS {c}_ref' for c in _B)} FROM a JOIN b ON a.stay_id = b.stay_id AND a.time = b.time)"


@_query(f"WITH {JOINED} SELECT stay_id, time, {', '.join(f'round({c}, 6) AS {c}, round({c}_ref, 6) AS {c}_ref' for c in _B)} FROM j")
def common_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.on_common_keys(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir)))


@_query(f"WITH {JOINED} " + " UNION ALL ".join(f"SELECT '{c}' AS concept, count(*) FILTER ({c} IS NOT NULL AND {c}_ref IS NOT NULL) AS both_non_null, count(*) FILTER ({c} IS NOT NULL AND {c}_ref IS NULL) AS only_candidate, count(*) FILTER ({c} IS NULL AND {c}_ref IS NOT NULL) AS only_reference, count(*) FILTER ({c} IS NULL AND {c}_ref IS NULL) AS both_null FROM j" for c in _B))
def missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.missingness(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir))


@_query(f"WITH {JOINED} " + " UNION ALL ".join(f"SELECT '{c}' AS concept, count(abs({c} - {c}_ref)) AS n_both_non_null, round(avg(abs({c} - {c}_ref)), 6) AS mean_abs_diff, round(median(abs({c} - {c}_ref)), 6) AS median_abs_diff, round(max(abs({c} - {c}_ref)), 6) AS max_abs_diff, round(avg(abs({c} - {c}_ref) / abs({c}_ref)) FILTER ({c}_ref <> 0), 6) AS mean_rel_diff FROM j" for c in _B))
def value_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.value_differences(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir)))


@_query(f"""WITH {JOINED} SELECT stay_id, time, round(click, 6) AS candidate_value, round(click_ref, 6) AS reference_value, round(abs(click - click_ref), 6) AS abs_diff
FROM j WHERE click IS NOT NULL AND click_ref IS NOT NULL ORDER BY round(abs(round(click, 6) - round(click_ref, 6)), 9) DESC, stay_id, time LIMIT 20""")
def worst_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.worst_examples(_rounded(_wide_a(spark, sf_dir), "click"), _rounded(_wide_b(spark, sf_dir), "click"), "click").withColumn("abs_diff", F.round("abs_diff", 6))


_UNPIVOT = lambda t: " UNION ALL ".join(f"SELECT stay_id, time, '{c}' AS concept, round({c}, 6) AS value FROM {t} WHERE {c} IS NOT NULL" for c in (CONCEPTS if t == "a" else _B))


@_query(f"WITH {WIDE_A} {_UNPIVOT('a')}")
def to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.to_long(_wide_a(spark, sf_dir)))


_LONG_BOTH = f"{BOTH}, la AS (SELECT * FROM ({_UNPIVOT('a')}) WHERE concept <> 'view'), lb AS ({_UNPIVOT('b')})"
_ANTI = "SELECT x.* FROM {} x LEFT JOIN {} y ON x.stay_id = y.stay_id AND x.time = y.time AND x.concept = y.concept WHERE y.stay_id IS NULL"


@_query(f"WITH {_LONG_BOTH} {_ANTI.format('lb', 'la')}")
def reference_only_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.values_only_in(_wide_b(spark, sf_dir), _wide_a(spark, sf_dir)))


@_query(f"WITH {_LONG_BOTH} {_ANTI.format('la', 'lb')}")
def candidate_only_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.values_only_in(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir)))


PER_STAY = f"""{BOTH}, f AS (SELECT coalesce(a.stay_id, b.stay_id) AS stay_id, a.stay_id IS NOT NULL AS l, b.stay_id IS NOT NULL AS r,
  {" AND ".join(f"round(a.{c}, 6) IS NOT DISTINCT FROM round(b.{c}, 6)" for c in _B)} AS eq FROM a FULL JOIN b ON a.stay_id = b.stay_id AND a.time = b.time),
p0 AS (SELECT stay_id, count(*) FILTER (l) AS n_rows_candidate, count(*) FILTER (r) AS n_rows_reference, count(*) FILTER (l AND NOT r) AS n_only_candidate_rows,
  count(*) FILTER (r AND NOT l) AS n_only_reference_rows, count(*) FILTER (l AND r) AS n_common_rows, count(*) FILTER (l AND r AND eq) AS n_equal_rows FROM f GROUP BY stay_id),
p AS (SELECT *, n_common_rows - n_equal_rows AS n_value_mismatch_rows, n_rows_candidate > 0 AND n_rows_reference > 0 AS in_both, n_rows_candidate - n_rows_reference AS row_count_diff,
  CASE WHEN n_rows_reference > 0 THEN (n_rows_candidate - n_rows_reference) / n_rows_reference END AS row_count_relative_error,
  CASE WHEN n_rows_reference > 0 THEN abs((n_rows_candidate - n_rows_reference) / n_rows_reference) END AS row_count_absolute_relative_error,
  n_rows_candidate > 0 AND n_rows_reference > 0 AND n_only_candidate_rows + n_only_reference_rows + n_common_rows - n_equal_rows = 0 AS content_identical FROM p0)"""


def _per_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.per_stay_reproduction(_rounded(_wide_a(spark, sf_dir)), _rounded(_wide_b(spark, sf_dir)))


@_query(f"WITH {PER_STAY} SELECT * REPLACE (round(row_count_relative_error, 6) AS row_count_relative_error, round(row_count_absolute_relative_error, 6) AS row_count_absolute_relative_error) FROM p")
def per_stay_reproduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_per_stay(spark, sf_dir))


@_query(f"""WITH {PER_STAY}, t AS (SELECT count(*) FILTER (n_rows_candidate > 0) AS n_stays_candidate, count(*) FILTER (n_rows_reference > 0) AS n_stays_reference, count(*) FILTER (in_both) AS n_common_stays,
  count(*) FILTER (n_rows_candidate > 0 AND n_rows_reference = 0) AS n_only_candidate_stays, count(*) FILTER (n_rows_reference > 0 AND n_rows_candidate = 0) AS n_only_reference_stays,
  count(*) FILTER (content_identical) AS n_identical_stays, count(*) FILTER (in_both AND NOT content_identical) AS n_differing_common_stays,
  round(avg(row_count_relative_error) FILTER (in_both), 6) AS mean_common_stay_row_error, round(avg(row_count_absolute_relative_error) FILTER (in_both), 6) AS mean_absolute_common_stay_row_error,
  CAST(sum(row_count_diff) FILTER (in_both) AS BIGINT) AS cd, CAST(sum(abs(row_count_diff)) FILTER (in_both) AS BIGINT) AS ca, CAST(sum(n_rows_reference) FILTER (in_both) AS BIGINT) AS cr,
  CAST(sum(n_rows_candidate) AS BIGINT) AS n_rows_candidate, CAST(sum(n_rows_reference) AS BIGINT) AS n_rows_reference, CAST(sum(n_common_rows) AS BIGINT) AS n_common_rows,
  CAST(sum(n_only_candidate_rows) AS BIGINT) AS n_only_candidate_rows, CAST(sum(n_only_reference_rows) AS BIGINT) AS n_only_reference_rows, CAST(sum(n_equal_rows) AS BIGINT) AS n_equal_rows,
  CAST(sum(n_value_mismatch_rows) AS BIGINT) AS n_value_mismatch_rows FROM p)
SELECT * EXCLUDE (cd, ca, cr), round(n_identical_stays / n_common_stays, 6) AS exact_stay_match_rate, round((n_stays_candidate - n_stays_reference) / n_stays_reference, 6) AS stay_count_error,
  round(abs((n_stays_candidate - n_stays_reference) / n_stays_reference), 6) AS stay_count_absolute_error, round(cd / cr, 6) AS summed_common_stay_row_error,
  round(ca / cr, 6) AS summed_absolute_common_stay_row_error, round((n_rows_candidate - n_rows_reference) / n_rows_reference, 6) AS total_row_error,
  round(abs((n_rows_candidate - n_rows_reference) / n_rows_reference), 6) AS total_absolute_row_error,
  round((n_only_candidate_rows + n_only_reference_rows + n_value_mismatch_rows) / (n_common_rows + n_only_candidate_rows + n_only_reference_rows), 6) AS row_content_disagreement_rate FROM t""")
def reproduction_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.reproduction_accuracy(_per_stay(spark, sf_dir)))


def _windows_sql(table: str, prefix: str) -> str:
    return f"""SELECT *, {prefix}_end - {prefix}_start + 1 AS {prefix}_expected_n_timepoints, {prefix}_end - {prefix}_start + 1 - {prefix}_n_timepoints AS {prefix}_missing_grid_points
FROM (SELECT stay_id, min(time) AS {prefix}_start, max(time) AS {prefix}_end, count(DISTINCT time) AS {prefix}_n_timepoints FROM {table} GROUP BY stay_id)"""


@_query(f"WITH {WIDE_A} {_windows_sql('a', 'candidate')}")
def stay_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.stay_windows(_wide_a(spark, sf_dir), "candidate")


WINDOWS = f"""{WIDE_A}, cw AS ({_windows_sql("a", "candidate")}), rw AS (SELECT stay_id, CAST(0 AS BIGINT) AS reference_start, least(CASE WHEN stay_id % 9 <> 0 THEN CAST(floor({_END}) AS BIGINT) END, 500) AS reference_end FROM stays WHERE stay_id % 4 <> 0),
rw2 AS (SELECT stay_id, reference_start, CASE WHEN stay_id % 9 <> 0 THEN reference_end END AS reference_end, CASE WHEN stay_id % 9 <> 0 THEN reference_end - reference_start + 1 END AS reference_expected_n_timepoints FROM rw),
jw AS (SELECT * REPLACE (coalesce(cw.stay_id, rw2.stay_id) AS stay_id), candidate_start - reference_start AS diff_start, candidate_end - reference_end AS diff_end,
  candidate_n_timepoints - reference_expected_n_timepoints AS diff_n_timepoints FROM cw FULL JOIN rw2 USING (stay_id))"""


def _reference_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = _stays(spark, sf_dir).where("stay_id % 4 <> 0")
    end = F.floor((F.unix_micros(F.col("outtime").cast("timestamp")) - F.unix_micros(F.col("intime").cast("timestamp"))) / F.lit(3.6e9))
    return ref.reference_windows(stays.select(F.col("stay_id").alias("CaseID"), F.lit(0.0).alias("start"), F.when(F.col("stay_id") % 9 != 0, end.cast("double")).alias("end")), 500)


def _joined_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.joined_windows(compare.stay_windows(_wide_a(spark, sf_dir), "candidate"), _reference_windows(spark, sf_dir))


@_query(f"WITH {WINDOWS} SELECT * FROM jw WHERE diff_start IS NULL OR diff_end IS NULL OR diff_start <> 0 OR diff_end <> 0 OR diff_n_timepoints <> 0")
def window_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.window_differences(_joined_windows(spark, sf_dir))


@_query(f"""WITH {WINDOWS} SELECT count(*) AS n_stays_total, count(candidate_start) AS n_stays_in_candidate, count(reference_start) AS n_stays_in_reference, count(*) FILTER (diff_start = 0) AS n_same_start,
count(*) FILTER (diff_end = 0) AS n_same_end, count(*) FILTER (diff_end < 0) AS n_candidate_shorter, count(*) FILTER (diff_end > 0) AS n_candidate_longer, min(diff_end) AS min_diff_end, max(diff_end) AS max_diff_end,
round(avg(diff_end), 6) AS mean_diff_end, count(*) FILTER (reference_end IS NULL) AS n_excluded_metric_null_reference_end FROM jw""")
def window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.window_summary(_joined_windows(spark, sf_dir)), "mean_diff_end")


@_query(f"WITH {BOTH}, {WINDOWS.removeprefix(WIDE_A + ', ')} SELECT b.stay_id, time, {', '.join(f'round({c}, 6) AS {c}' for c in _B)} FROM b JOIN rw2 ON b.stay_id = rw2.stay_id WHERE time BETWEEN reference_start AND reference_end")
def normalize_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _wide_b(spark, sf_dir).withColumnsRenamed({"stay_id": "admissionid", "time": "measuredat"}).withColumn("measuredat", F.col("measuredat").cast("double"))
    return _rounded(ref.reference_wide(raw, _reference_windows(spark, sf_dir), CONCEPTS))


# --- scope, versions, identifiers -----------------------------------------------------------


def _scope_row(dimension: str, keys: str) -> str:
    return f"""SELECT '{dimension}' AS dimension, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM a)) AS n_candidate, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM b)) AS n_reference,
(SELECT count(*) FROM (SELECT {keys} FROM a INTERSECT SELECT {keys} FROM b)) AS n_shared"""


@_query(f"""WITH {BOTH}, s AS ({_scope_row("stays", "stay_id")} UNION ALL SELECT 'concepts', 5, 4, 4 UNION ALL {_scope_row("stay_time_keys", "stay_id, time")})
SELECT *, n_candidate - n_shared AS n_candidate_only, n_reference - n_shared AS n_reference_only, CASE WHEN n_shared = 0 THEN 'not_directly_comparable' WHEN n_shared = n_candidate AND n_shared = n_reference THEN 'equal'
WHEN n_shared = n_reference THEN 'candidate_superset' WHEN n_shared = n_candidate THEN 'reference_superset' ELSE 'partial_overlap' END AS relationship FROM s""")
def scope_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.scope_overlap(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir), CONCEPTS)


@_query(f"""WITH {BOTH} SELECT 'stay' AS dimension, CAST(stay_id AS VARCHAR) AS identifier, 'candidate_only' AS side FROM (SELECT stay_id FROM a EXCEPT SELECT stay_id FROM b)
UNION ALL SELECT 'stay', CAST(stay_id AS VARCHAR), 'reference_only' FROM (SELECT stay_id FROM b EXCEPT SELECT stay_id FROM a) UNION ALL SELECT 'concept', 'view', 'candidate_only'""")
def scope_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.scope_differences(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir), CONCEPTS)


@_query(f"WITH {WIDE_A} SELECT stay_id + 100000 AS stay_id, time, round(click, 6) AS click FROM a WHERE stay_id % 2 = 0")
def crosswalk_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = identifiers.StayIds(None, None, identifiers.load_stay_crosswalk(_crosswalk(spark, sf_dir)))
    return _rounded(ids.translate(_wide_a(spark, sf_dir).select("stay_id", "time", "click"))[0])


@_query(f"WITH {WIDE_A} SELECT DISTINCT stay_id FROM a WHERE stay_id % 2 <> 0")
def crosswalk_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.StayIds(None, None, _crosswalk(spark, sf_dir)).translate(_wide_a(spark, sf_dir))[1]


@_query("SELECT user_id AS stay_id, event_type AS concept, count(*) AS n_rows FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.duplicated(_ev(spark, sf_dir).withColumnRenamed("subject_id", "stay_id"), ["stay_id", "concept"])


@_query("SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN '2.2' ELSE '3.1' END AS dataset_version FROM events")
def versions_in_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _ev(spark, sf_dir).withColumn("dataset_version", F.when(F.col("event_id") % 2 == 0, "2.2").otherwise("3.1"))
    return spark.createDataFrame([(v,) for v in ev.dataset_versions([e])], "dataset_version string")


@_query(f"WITH {WINDOWS} SELECT * FROM rw2")
def reference_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference_windows(spark, sf_dir)


@_query("SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderkey + 1 AS stay_id, o_orderdate AS intime, o_orderdate + INTERVAL 90 DAY AS outtime FROM orders")
def scan_datetime_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return st.datetime_stays(o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"), (F.col("o_orderkey") + 1).alias("stay_id"), F.col("o_orderdate").alias("intime"), F.expr("o_orderdate + interval 90 days").alias("outtime")))


@_query(f"WITH {WIDE_A} SELECT stay_id, time, {', '.join(f'round(CAST(CAST(round({c}, 6) AS FLOAT) AS DOUBLE), 3) AS {c}' for c in CONCEPTS)} FROM a")
def comparable_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = ref.comparable_types(_rounded(_wide_a(spark, sf_dir)), CONCEPTS)
    return narrow.withColumns({c: F.round(F.col(c).cast("double"), 3) for c in CONCEPTS})


@_query("SELECT * FROM (VALUES ('missing_reference', 'view'), ('common', 'click'), ('common', 'error'), ('common', 'purchase'), ('common', 'signup')) t(kind, concept)")
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = compare.schema_report(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir), CONCEPTS)
    return spark.createDataFrame([(kind, c) for kind, names in report.items() for c in names], "kind string, concept string")


_F = ", ".join(f"CAST(round({c}, 6) AS FLOAT) AS {c}" for c in _B)


@_query(f"""WITH {BOTH}, {WINDOWS.removeprefix(WIDE_A + ', ')}, chosen AS (SELECT stay_id FROM rw2 WHERE reference_end IS NOT NULL INTERSECT SELECT stay_id FROM a WHERE time <= 500),
a2 AS (SELECT stay_id, time, {_F} FROM a WHERE time <= 500 AND stay_id IN (FROM chosen)),
b2 AS (SELECT b.stay_id, time, {_F} FROM b JOIN rw2 ON b.stay_id = rw2.stay_id WHERE time BETWEEN reference_start AND reference_end AND b.stay_id IN (FROM chosen)),
f AS (SELECT coalesce(a2.stay_id, b2.stay_id) AS stay_id, a2.stay_id IS NOT NULL AS l, b2.stay_id IS NOT NULL AS r, {" AND ".join(f"a2.{c} IS NOT DISTINCT FROM b2.{c}" for c in _B)} AS eq
  FROM a2 FULL JOIN b2 ON a2.stay_id = b2.stay_id AND a2.time = b2.time)
SELECT 'shared_subset' AS comparison_scope, 'shared_subset_cross_version' AS validation_level, count(DISTINCT stay_id) FILTER (l) AS n_stays_candidate, count(*) FILTER (l AND r) AS n_common_rows,
count(*) FILTER (l AND NOT r) AS n_only_candidate_rows, count(*) FILTER (r AND NOT l) AS n_only_reference_rows, count(*) FILTER (l AND r AND eq) AS n_equal_rows FROM f""")
def comparison_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole comparison of two verified versions in one identifier space."""
    stays = _stays(spark, sf_dir).where("stay_id % 4 <> 0")
    end = F.floor((F.unix_micros(F.col("outtime").cast("timestamp")) - F.unix_micros(F.col("intime").cast("timestamp"))) / F.lit(3.6e9))
    windows = stays.select("stay_id", F.lit(0.0).alias("start"), F.when(F.col("stay_id") % 9 != 0, end.cast("double")).alias("end"))
    pair = VersionPair(DatasetVersion("x", "3.1", "explicit"), DatasetVersion("reference:x", "2.2", "explicit"))
    out = compare_tables(_rounded(_wide_a(spark, sf_dir)), _rounded(_wide_b(spark, sf_dir)), windows, CONCEPTS, max_hours=500, versions=pair, stay_ids=identifiers.StayIds("x", "x"))
    return out.reports["reproduction_accuracy"].select("comparison_scope", "validation_level", "n_stays_candidate", "n_common_rows", "n_only_candidate_rows", "n_only_reference_rows", "n_equal_rows")


# --- validation and items -------------------------------------------------------------------


@_query(f"WITH {WIDE_A} " + " UNION ALL ".join(f"SELECT '{c}' AS concept, count({c}) AS n_non_null, round(count({c}) * 100.0 / count(*), 6) AS percent_non_null FROM a" for c in CONCEPTS))
def concept_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(validate.concept_coverage(_wide_a(spark, sf_dir)))


_BOUNDS = {"click": (1.0, 300.0), "error": (None, 1000.0), "purchase": (0.0, None)}


def _range_sql(c: str) -> str:
    low, high = (f"CAST({'NULL' if b is None else b} AS DOUBLE)" for b in _BOUNDS[c])
    return f"SELECT '{c}' AS concept, count({c}) AS n_non_null, round(min({c}), 6) AS observed_min, round(max({c}), 6) AS observed_max, {low} AS range_min, {high} AS range_max, coalesce(min({c}) < {low}, false) AS below_range_min, coalesce(max({c}) > {high}, false) AS above_range_max FROM a"


@_query(f"WITH {WIDE_A} " + " UNION ALL ".join(map(_range_sql, _BOUNDS)))
def range_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(validate.range_report(_wide_a(spark, sf_dir), _BOUNDS))


def _against_sql(rounding: str) -> str:
    return f"""WITH {WIDE_A}, o AS (SELECT stay_id, min(time) AS dyn_start, max(time) AS dyn_end, count(DISTINCT time) AS dyn_n_timepoints FROM a GROUP BY stay_id),
x AS (SELECT subject_id, stay_id + 1 AS hadm_id, stay_id, intime, CASE WHEN stay_id % 5 <> 0 THEN outtime END AS outtime FROM stays),
y AS (SELECT *, (epoch_us(outtime) - epoch_us(intime)) // 1000000 / 3600.0 AS los FROM x)
SELECT subject_id, hadm_id, stay_id, intime, outtime, round(los, 6) AS los_hours, CAST(0 AS BIGINT) AS expected_start, CAST({rounding}(los) AS BIGINT) AS expected_end, dyn_start, dyn_end, dyn_n_timepoints,
dyn_start AS diff_start, dyn_end - CAST({rounding}(los) AS BIGINT) AS diff_end FROM y LEFT JOIN o USING (stay_id)"""


def _timed_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stays(spark, sf_dir).withColumns({"hadm_id": F.col("stay_id") + 1, "outtime": F.when(F.col("stay_id") % 5 != 0, F.col("outtime"))})


@_query(_against_sql("floor"))
def compare_to_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(validate.against_stays(_wide_a(spark, sf_dir), _timed_stays(spark, sf_dir)))


@_query(_against_sql("ceil"))
def compare_to_stays_ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(validate.against_stays(_wide_a(spark, sf_dir), _timed_stays(spark, sf_dir), "ceil"))


@_query(f"""WITH {WIDE_A}, m AS (SELECT stay_id, time, median(numeric_value) AS click FROM mapped WHERE concept = 'click' GROUP BY 1, 2)
SELECT m.stay_id, m.time, round(m.click, 6) AS click, round(a.click, 6) AS click_final, round(abs(m.click - a.click), 6) AS abs_diff FROM m JOIN a ON m.stay_id = a.stay_id AND m.time = a.time WHERE a.click IS NOT NULL""")
def debug_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _mapped(spark, sf_dir, holes=True).where("concept = 'click'")
    return _rounded(validate.recompute_concept(mapped, _wide_a(spark, sf_dir), "click", "median")["joined"])


@_query(f"""WITH {WIDE_A}, raw AS (SELECT * FROM holes WHERE concept = 'click'), kept AS (SELECT * FROM raw WHERE numeric_value >= 5 AND numeric_value <= 200),
m0 AS (SELECT s.stay_id, {HOUR} AS time, e.numeric_value FROM kept e JOIN stays s ON e.subject_id = s.subject_id WHERE {INSIDE}),
c AS (SELECT abs(m.v - a.click) AS d FROM (SELECT stay_id, time, avg(numeric_value) AS v FROM m0 GROUP BY 1, 2) m JOIN a ON m.stay_id = a.stay_id AND m.time = a.time WHERE a.click IS NOT NULL)
SELECT 'raw' AS step, count(*) AS n, count(DISTINCT subject_id) AS units, round(min(numeric_value), 6) AS low, round(max(numeric_value), 6) AS high FROM raw
UNION ALL SELECT 'filtered', count(*), NULL, round(min(numeric_value), 6), round(max(numeric_value), 6) FROM kept
UNION ALL SELECT 'mapped', count(*), count(DISTINCT stay_id), min(time), max(time) FROM m0
UNION ALL SELECT 'compared', count(*), NULL, round(avg(d), 6), round(max(d), 6) FROM c""")
def debug_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of one concept's way into the wide table leaves."""
    raw = ev.subject_events(_holes(_ev(spark, sf_dir)).where("concept = 'click'"))
    out = validate.trace_concept(raw, _stays(spark, sf_dir), _wide_a(spark, sf_dir), "click", bounds=(5, 200))
    none = F.lit(None).cast("long")
    rows = [("raw", "rows", F.col("subjects"), "min_value", "max_value"), ("filtered", "rows", none, "min_value", "max_value"), ("mapped", "rows", F.col("stays"), "min_time", "max_time"), ("compared", "n_compared", none, "mean_abs_diff", "max_abs_diff")]
    frames = [out["comparison_summary" if step == "compared" else f"{step}_summary"].select(F.lit(step).alias("step"), F.col(n).alias("n"), units.alias("units"), F.col(low).cast("double").alias("low"), F.col(high).cast("double").alias("high")) for step, n, units, low, high in rows]
    return _rounded(frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3]))


# --- builds ---------------------------------------------------------------------------------


def _concept_tables(spark: SparkSession, sf_dir: str, names: dict[str, str]) -> dict[str, DataFrame]:
    """A concept table for each kind of event, by folder."""
    e = _holes(_ev(spark, sf_dir))
    return {folder: e.where(F.col("concept") == kind).drop("concept") for folder, kind in names.items()}


_POLICY = ConceptDict({"alb": {"aggregate": "max"}, "hr": {"aggregate": "median"}, "dobu_dur": {"aggregate": "max"}, "norepi_dur": {"aggregation": "sum"}})
_POLICY_NAMES = ("nwicu", "mimic-iv-demo", "MIIV", "other")


def _folders_sql(folders: dict[str, tuple[str, str]]) -> str:
    return ", ".join(f"""round({_agg_sql(name, f"concept = '{kind}'")}, 6) AS "{folder}" """ for folder, (kind, name) in folders.items())


_HOURLY = f"""{EV}, {HOLES}, {STAYS}, mapped AS (SELECT s.stay_id, CAST(floor(epoch_us(e.time) // 1000 / 3600000.0 - epoch_us(s.intime) // 1000 / 3600000.0) AS BIGINT) AS time, e.time AS at, e.numeric_value, e.concept
FROM holes e JOIN stays s ON e.subject_id = s.subject_id WHERE {INSIDE})"""


@_query(f"WITH {_HOURLY} " + " UNION ALL ".join(f"SELECT '{d}' AS dataset, stay_id, time, {_folders_sql({'albumin': ('click', 'mean' if d == 'other' else 'max'), 'heart_rate': ('view', 'mean' if d == 'other' else 'median'), 'anything': ('error', 'mean')})} FROM mapped WHERE concept IN ('click', 'view', 'error') GROUP BY stay_id, time" for d in _POLICY_NAMES))
def policy_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which datasets take aggregates from the dictionary, with or without a reference."""
    tables, stays = _concept_tables(spark, sf_dir, {"albumin": "click", "heart_rate": "view", "anything": "error"}), build.Stays(_hour_stays(_stays(spark, sf_dir)))
    parts = [build.build_all(tables, stays, d, _POLICY, grid=False, sort=False).withColumn("dataset", F.lit(d)) for d in _POLICY_NAMES]
    return _rounded(reduce(DataFrame.unionByName, parts))


@_query(f"WITH {_HOURLY} SELECT stay_id, time, {_folders_sql({'dobutamine_duration': ('click', 'max'), 'norepinephrine_duration': ('view', 'sum'), 'dobu_dur': ('error', 'mean')})} FROM mapped WHERE concept IN ('click', 'view', 'error') GROUP BY stay_id, time")
def policy_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations of drugs are found by their concept folders."""
    tables = _concept_tables(spark, sf_dir, {"dobutamine_duration": "click", "norepinephrine_duration": "view", "dobu_dur": "error"})
    return _rounded(build.build_all(tables, build.Stays(_hour_stays(_stays(spark, sf_dir))), "mimic-iv", _POLICY, grid=False, sort=False))


@_query(f"WITH {EV}, mapped AS (SELECT subject_id AS stay_id, CAST(floor(event_id / 60.0) AS BIGINT) AS time, event_id / 60.0 AS at, numeric_value, concept FROM ev) {_wide_sql({'click': 'max', 'view': 'median'})[:-len(' GROUP BY stay_id, time')]} WHERE concept IN ('click', 'view') GROUP BY stay_id, time")
def identity_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subject that is its stay, with times in minutes, aggregated."""
    e = _ev(spark, sf_dir).withColumn("time", F.col("event_id"))
    stays = build.Stays(None, "unknown", replace(stay_spec("nwicu"), hours_per_unit=1 / 60))
    tables = {c: e.where(F.col("concept") == c).drop("concept") for c in ("click", "view")}
    return _rounded(build.build_variables(tables, stays, "nwicu", ConceptDict({"click": {"aggregate": "max"}}), max_hours=None, sort=False))


@_query("""WITH o AS (SELECT o_custkey AS stay_id, CAST(year(o_orderdate) - 1992 AS BIGINT) AS time, o_totalprice AS v, o_orderstatus AS s FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 1000)
SELECT stay_id, time, round(min(v) FILTER (s = 'F'), 6) AS "F", round(median(v) FILTER (s = 'O'), 6) AS "O" FROM o WHERE time <= 5 GROUP BY stay_id, time""")
def stay_indexed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are in stays already, aggregated up to a last hour."""
    o = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("stay_id"), (F.year("o_orderdate") - 1992).alias("time"), F.col("o_totalprice").alias("numeric_value"), "o_orderstatus")
    tables = {s: o.where(F.col("o_orderstatus") == s) for s in ("F", "O")}
    meta = ConceptDict({s: {"min": 1000, **({"aggregate": "min"} if s == "F" else {})} for s in tables})
    return _rounded(build.build_variables(tables, build.Stays(None, "unknown", stay_spec("mimic-iv")), "mimic-iv", meta, max_hours=5, sort=False))


def _project(spark: SparkSession, sf_dir: str, stays: DataFrame) -> Place:
    """A project of two concepts and a stay table with times, in the shared folder."""
    root = Place(shared_folder(spark, "project"))
    for folder, table in _concept_tables(spark, sf_dir, {"albumin": "click", "heart_rate": "view"}).items():
        table.withColumn("dataset_version", F.lit("3.1")).write.parquet(str(root / "workspace" / "concept" / folder / "1.0.0" / "mimic-iv.parquet"))
    stays.withColumn("hadm_id", F.col("stay_id")).write.parquet(str(root / "stays.parquet"))
    return root


def _configured(spark: SparkSession, sf_dir: str, stays: DataFrame, rounding: str) -> DataFrame:
    """What a configuration file builds, written and read back."""
    root = _project(spark, sf_dir, stays)
    (root / "vars.yml").write_text("dynamic_vars: [alb, hr]\n")
    (root / "build.yml").write_text(f"""concepts: {{path: workspace/concept, dataset: mimic-iv, dataset_version: '3.1'}}
wide: {{dynamic_vars: vars.yml}}
stay_table: stays.parquet
aggregation: {{mode: mean}}
grid: {{include: true, max_hours: 240, end_rounding: {rounding}}}
output: {{path: out/wide.parquet, sort: false}}
""")
    return _rounded(spark.read.parquet(str(build.run_config(spark, root / "build.yml").path)))


def _configured_sql(stays: str, end: str) -> str:
    return f"""WITH {EV}, {HOLES}, {MULTI}, chosen AS (SELECT * FROM multi WHERE {stays}), {_mapped_sql("holes", "chosen")}, grid AS ({_grid_sql(end, "chosen")}),
w AS (SELECT stay_id, time, avg(numeric_value) FILTER (concept = 'click') AS alb, avg(numeric_value) FILTER (concept = 'view') AS hr FROM mapped GROUP BY stay_id, time)
SELECT g.stay_id, g.time, round(alb, 6) AS alb, round(hr, 6) AS hr FROM grid g LEFT JOIN w ON g.stay_id = w.stay_id AND g.time = w.time"""


@_query(_configured_sql("outtime IS NOT NULL", f"least(CASE WHEN outtime < intime THEN 0 ELSE ceil({_END}) END, 240)"))
def config_grid_ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _configured(spark, sf_dir, _multi(spark, sf_dir).where("outtime is not null"), "ceil")


@_query(_configured_sql("outtime IS NULL", "0"))
def config_open_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays without an end have hour 0 alone."""
    return _configured(spark, sf_dir, _multi(spark, sf_dir).where("outtime is null"), "floor")


@_query(f"""WITH {_HOURLY}, w AS (SELECT stay_id, time, {_folders_sql({'albumin': ('click', 'max'), 'heart_rate': ('view', 'median')})} FROM mapped WHERE concept IN ('click', 'view') AND time <= 100 GROUP BY stay_id, time),
grid AS ({_grid_sql(f'least(floor({_LENGTH}), 100)', 'stays')}) SELECT g.stay_id, g.time, albumin, heart_rate FROM grid g LEFT JOIN w ON g.stay_id = w.stay_id AND g.time = w.time""")
def build_all_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every concept of a workspace, written with provenance and read back."""
    root = _project(spark, sf_dir, _stays(spark, sf_dir))
    (root / "dict.json").write_text(json.dumps(_POLICY.concepts))
    export = build.write_all(spark, "mimic-iv", root, stay_table=root / "stays.parquet", max_hours=100, concept_dict=root / "dict.json", output_root=root / "out")
    if sinks.read_provenance(spark, export.path)["version"] != "3.1":
        raise ValueError("the provenance isn't the table's")
    return _rounded(spark.read.parquet(str(export.path)))


@_query("SELECT unnest(['albumin', 'heart_rate']) AS concept, '1.0.0' AS concept_version, '3.1' AS dataset_version, 'concept_column' AS dataset_version_source FROM (SELECT count(*) AS n FROM events) WHERE n > 0")
def build_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of such a build, read back."""
    root = _project(spark, sf_dir, _stays(spark, sf_dir))
    export = build.write_all(spark, "mimic-iv", root, stay_table=root / "stays.parquet", grid=False, output_root=root / "out")
    return spark.read.csv(str(export.manifest), header=True).drop("source_parquet")


_SOURCES = ("explicit", "concept_column", "manual_default", "unknown")


@_query(f"""WITH v AS (SELECT n_nationkey AS k, [{", ".join(repr(x) for x in _SOURCES)}][1 + n_nationkey % 4] AS source, n_regionkey AS major, (n_nationkey // 4) % 2 AS minor FROM nation)
SELECT CAST(a.k AS BIGINT) AS candidate, CAST(b.k AS BIGINT) AS reference, CASE WHEN a.k % 5 = 0 THEN 'not_comparable' WHEN a.source IN ('explicit', 'concept_column') AND b.source IN ('explicit', 'concept_column')
THEN CASE WHEN a.major = b.major AND a.minor = b.minor THEN 'full_same_version' ELSE 'shared_subset_cross_version' END ELSE 'shared_subset_unverified_version' END AS level,
CASE WHEN a.source <> 'unknown' AND b.source <> 'unknown' THEN a.major = b.major AND a.minor = b.minor END AS same_version FROM v a, v b""")
def version_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pairs of versions, differently known and written, allow to conclude."""
    known = {}
    for r in _table(spark, sf_dir, "nation").collect():  # 25 rows
        source, minor = _SOURCES[r["n_nationkey"] % 4], r["n_nationkey"] // 4 % 2
        text = f"v{r['n_regionkey']}.{minor}" if r["n_nationkey"] % 2 else f"{r['n_regionkey']}.0{minor}.0"
        known[r["n_nationkey"]] = DatasetVersion("x", None if source == "unknown" else text, source)
    rows = [(a, b, VersionPair(known[a], known[b]).level(a % 5 != 0), VersionPair(known[a], known[b]).same) for a in known for b in known]
    return spark.createDataFrame(rows, "candidate long, reference long, level string, same_version boolean")


@_query(f"WITH {PER_STAY} SELECT stay_id, n_rows_candidate, n_rows_reference, round(row_count_absolute_relative_error, 6) AS row_count_absolute_relative_error FROM p ORDER BY p.row_count_absolute_relative_error DESC NULLS FIRST, stay_id LIMIT 15")
def report_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of a report, the worst stays first."""
    result = Comparison({}, {"per_stay_reproduction": _per_stay(spark, sf_dir)})
    return _rounded(overview(result, 15)["per_stay_reproduction"].select("stay_id", "n_rows_candidate", "n_rows_reference", "row_count_absolute_relative_error"))


@_query("SELECT l_orderkey AS stay_id, CAST(l_linenumber AS BIGINT) AS time, l_quantity AS hr, l_tax AS map FROM lineitem")
def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.normalize_reference(_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("hr"), F.col("l_tax").alias("map")), "l_orderkey", "l_linenumber")


@_query("SELECT o_custkey AS subject_id, o_orderkey AS stay_id, round(o_shippriority, 6) AS intime_hours, round(o_shippriority + o_totalprice / 60.0, 6) AS outtime_hours FROM (SELECT *, (o_orderkey % 1000) / 60.0 AS o_shippriority FROM orders)")
def stays_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission and length of stay in minutes."""
    table = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("CaseID"), F.col("o_custkey").alias("subject"), (F.col("o_orderkey") % 1000).alias("ICUOffset"), F.col("o_totalprice").alias("TimeOfStay"))
    return _rounded(st.normalized_stays(table, replace(stay_spec("sic"), subject="subject")))


@_query("SELECT c_custkey AS subject_id, c_custkey AS stay_id, CAST(0 AS DOUBLE) AS intime_hours, CAST(NULL AS DOUBLE) AS outtime_hours FROM customer")
def stays_without_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.normalized_stays(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Subject_ID")), stay_spec("nwicu"))


CODES = "codes AS (SELECT event_type AS concept, CASE WHEN event_id % 10 = 0 THEN 'free text ' || event_type ELSE upper(event_type) || '//' || user_id || '//' || event_type || '//unit' END AS code, CASE WHEN event_id % 3 = 0 THEN 'chart' ELSE 'lab' END AS tab, event_id FROM events)"
OBSERVED = rf"""{CODES}, observed AS (SELECT concept, coalesce(nullif(regexp_extract(code, '^[A-Z_]+//(\d+)//', 1), ''), code) AS item_id, regexp_extract(code, '^[A-Z_]+//(\d+)//', 1) <> '' AS id_parsed,
CASE WHEN regexp_extract(code, '^[A-Z_]+//(\d+)//', 1) <> '' THEN concept || '//unit' ELSE '' END AS item_label, array_to_string(list_sort(list(DISTINCT tab)), '; ') AS item_table,
array_to_string(list_sort(list(DISTINCT code)), '; ') AS source_codes, count(*) AS n_rows FROM codes GROUP BY 1, 2, 3, 4)"""


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    code = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("free text "), "event_type")).otherwise(F.concat(F.upper("event_type"), F.lit("//"), F.col("user_id").cast("string"), F.lit("//"), "event_type", F.lit("//unit")))
    return e.select(F.col("event_type").alias("concept"), code.alias("source_code"), F.when(F.col("event_id") % 3 == 0, "chart").otherwise("lab").alias("table"))


def _dictionary() -> dict:
    ids = {c: [i for i in range(0, 400, 2 + k)] for k, c in enumerate(CONCEPTS)}
    return {c: {"sources": {"src": [{"ids": ids[c], "table": "chart", "sub_var": "itemid"}]}} for c in CONCEPTS}


DEFINED = "defined AS (" + " UNION ALL ".join(f"SELECT '{c}' AS concept, CAST(range AS VARCHAR) AS item_id FROM range(0, 400, {2 + k})" for k, c in enumerate(CONCEPTS)) + ")"
MATCHED = f"""{OBSERVED}, {DEFINED}, matched AS (SELECT coalesce(o.concept, d.concept) AS concept, CASE WHEN o.item_id IS NOT NULL AND d.item_id IS NOT NULL THEN 'both' WHEN d.item_id IS NULL THEN 'candidate' ELSE 'reference' END AS side,
CASE WHEN o.item_id IS NOT NULL AND d.item_id IS NOT NULL THEN 'shared' WHEN d.item_id IS NULL AND id_parsed THEN 'candidate_only' WHEN d.item_id IS NULL THEN 'not_directly_comparable' ELSE 'reference_only' END AS item_status,
coalesce(o.item_id, d.item_id) AS item_id, o.n_rows AS candidate_n_rows, o.item_id IS NOT NULL AS candidate_observed, d.item_id IS NOT NULL AS reference_configured FROM observed o FULL JOIN defined d ON o.concept = d.concept AND o.item_id = d.item_id AND o.id_parsed)"""


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = items.observed_items(_coded(spark, sf_dir))
    return items.match_items(observed, items.defined_items(spark, _dictionary(), CONCEPTS, "src"), "direct_identifier_match")


@_query(f"WITH {OBSERVED} SELECT * FROM observed")
def items_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.observed_items(_coded(spark, sf_dir))


@_query(f"""WITH {MATCHED} SELECT concept, side, item_status, item_id, candidate_n_rows, candidate_observed, reference_configured, concat_ws('; ',
CASE WHEN candidate_observed THEN 'observed in candidate data (' || candidate_n_rows || ' rows)' ELSE 'not observed in candidate data' END,
CASE WHEN reference_configured THEN 'configured in the reference dictionary' ELSE 'not configured in the reference' END, CASE WHEN reference_configured THEN 'reference data occurrence unknown' END) AS evidence FROM matched""")
def item_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select("concept", "side", "item_status", "item_id", "candidate_n_rows", "candidate_observed", "reference_configured", "evidence")


@_query(f"""WITH {MATCHED} SELECT concept, count(*) FILTER (side <> 'reference') AS n_candidate_observed_items, CAST(coalesce(sum(candidate_n_rows), 0) AS BIGINT) AS n_candidate_observed_rows,
CAST(NULL AS BIGINT) AS n_candidate_configured_items, CAST(NULL AS BIGINT) AS n_reference_observed_items, CAST(NULL AS BIGINT) AS n_reference_configured_not_observed, count(*) FILTER (side <> 'candidate') AS n_reference_configured_items, count(*) FILTER (item_status = 'shared') AS n_shared, count(*) FILTER (item_status = 'candidate_only') AS n_candidate_only,
count(*) FILTER (item_status = 'reference_only') AS n_reference_only, count(*) FILTER (item_status = 'not_directly_comparable') AS n_not_directly_comparable FROM matched GROUP BY concept""")
def item_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.item_summary(_matched(spark, sf_dir))


_SEEN = "seen AS (SELECT DISTINCT concept, item_id FROM defined WHERE try_cast(item_id AS BIGINT) % 2 = 0)"


@_query(f"""WITH {MATCHED}, {_SEEN} SELECT m.concept, count(DISTINCT m.item_id) FILTER (side <> 'candidate' AND s.item_id IS NOT NULL) AS n_reference_observed_items,
count(DISTINCT m.item_id) FILTER (side <> 'candidate' AND s.item_id IS NULL) AS n_reference_configured_not_observed, count(*) FILTER (s.item_id IS NOT NULL) AS n_rows_observed
FROM matched m LEFT JOIN seen s ON s.concept = m.concept AND s.item_id = m.item_id GROUP BY m.concept""")
def item_observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which configured items the reference's data hold, where that is known."""
    observed, defined = items.observed_items(_coded(spark, sf_dir)), items.defined_items(spark, _dictionary(), CONCEPTS, "src")
    seen = defined.where("try_cast(item_id as bigint) % 2 = 0").select("concept", "item_id").distinct().withColumn("n_rows", F.lit(7))
    matched = items.match_items(observed, defined, "direct_identifier_match", None, seen)
    held = matched.groupBy("concept").agg(F.count_if("reference_observed").alias("n_rows_observed"))
    return items.item_summary(matched).join(held, "concept").select("concept", "n_reference_observed_items", "n_reference_configured_not_observed", "n_rows_observed")


_CROSS = "cross_ids AS (SELECT CAST(range AS VARCHAR) AS r, CAST(range * 2 AS VARCHAR) AS c FROM range(0, 300))"


@_query(f"""WITH {OBSERVED}, {DEFINED}, {_CROSS}, hits AS (SELECT DISTINCT d.concept, d.item_id AS r, o.item_id AS c FROM defined d JOIN cross_ids ON d.item_id = r JOIN observed o ON o.concept = d.concept AND o.item_id = c AND id_parsed)
SELECT o.concept, 'candidate' AS side, o.item_id, CASE WHEN NOT id_parsed THEN 'not_directly_comparable' WHEN h.c IS NOT NULL THEN 'shared' WHEN x.c IS NOT NULL THEN 'candidate_only' ELSE 'not_directly_comparable' END AS item_status, coalesce(h.r, '') AS counterpart_item_ids
FROM observed o LEFT JOIN hits h ON h.concept = o.concept AND h.c = o.item_id LEFT JOIN cross_ids x ON x.c = o.item_id
UNION ALL SELECT d.concept, 'reference', d.item_id, CASE WHEN h.c IS NOT NULL THEN 'shared' WHEN x.c IS NOT NULL THEN 'reference_only' ELSE 'not_directly_comparable' END, coalesce(h.c, x.c, '')
FROM defined d LEFT JOIN hits h ON h.concept = d.concept AND h.r = d.item_id LEFT JOIN cross_ids x ON x.r = d.item_id""")
def item_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.range(300).select(F.col("id").alias("reference_item_id"), (F.col("id") * 2).alias("candidate_item_id"))
    observed, defined = items.observed_items(_coded(spark, sf_dir)), items.defined_items(spark, _dictionary(), CONCEPTS, "src")
    return items.match_items(observed, defined, "crosswalk", pairs).select("concept", "side", "item_id", "item_status", "counterpart_item_ids")


@_query(f"""WITH {OBSERVED}, old AS (SELECT concept, item_id, CASE WHEN item_id LIKE '%5' THEN 'accept' ELSE 'reject' END AS v FROM observed WHERE item_id LIKE '%5' OR item_id LIKE '%7')
SELECT o.concept, o.item_id, coalesce(v, '') AS reviewer_verdict, CASE WHEN v IS NULL THEN '' ELSE 'second look' END AS reviewer_comment, CASE WHEN v IS NULL THEN '' ELSE 'r2' END AS reviewer_name FROM observed o LEFT JOIN old USING (concept, item_id)""")
def review_carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = items.observed_items(_coded(spark, sf_dir)).select("concept", "item_id")
    old = new.where("item_id like '%5' or item_id like '%7'").withColumn("reviewer_verdict", F.when(F.col("item_id").endswith("5"), "accept").otherwise("reject"))
    first = old.select("concept", "item_id", F.lit("x").alias("reviewer_verdict"), F.lit("first look").alias("reviewer_comment"), F.lit("r1").alias("reviewer_name"), F.lit(1).alias("line"))
    second = old.withColumns({"reviewer_comment": F.lit("second look"), "reviewer_name": F.lit("r2"), "line": F.lit(2)})
    return items.carry_over(new, first.unionByName(second), ["concept", "item_id"], "line")


# --- through files --------------------------------------------------------------------------


@_query(f"WITH {EV}, {MULTI} SELECT s.stay_id, {HOUR} AS time, e.event_id, e.numeric_value FROM ev e JOIN multi s ON e.subject_id = s.subject_id WHERE {INSIDE}")
def map_by_subject_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As map_by_subject, for subjects with very many stays: events meet the stays of their bin of time."""
    out = mapping.map_by_time(ev.subject_events(_ev(spark, sf_dir)), _multi(spark, sf_dir), bins=mapping.BIN_HOURS)
    return out.select("stay_id", "time", "event_id", "numeric_value")


@_query(f"WITH {WIDE_A} SELECT stay_id, time, {', '.join(f'round({c}, 6) AS {c}' for c in CONCEPTS)}, '3.1' AS version, true AS intact, (SELECT count(*) FROM a) AS n_rows FROM a")
def provenance_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that others wrote gets provenance, is committed anew, and its files are verified."""
    path = Place(shared_folder(spark, "told")) / "wide.parquet"
    _wide_a(spark, sf_dir).where("stay_id % 2 = 0").write.parquet(str(path))
    sinks.attach_provenance(spark, path, {"dataset": "x", "version": "2.2"})
    sinks.write_table(commits.read_table(spark, path).unionByName(_wide_a(spark, sf_dir).where("stay_id % 2 <> 0")), path, {"dataset": "x", "version": "3.1"})
    intact = commits.verify(spark, path).where("not intact").count() == 0
    told = {"version": F.lit(sinks.read_provenance(spark, path)["version"]), "intact": F.lit(intact), "n_rows": F.lit(commits.manifest_of(path).rows).cast("long")}
    return _rounded(commits.read_table(spark, path), *CONCEPTS).withColumns(told)


def _in_buckets(spark: SparkSession, sf_dir: str) -> tuple[Place, Place]:
    """Both wide tables, written in buckets of stays; the first with provenance."""
    root = Place(shared_folder(spark, "wide"))
    notes = {"dataset": "mimic-iv", "version": "3.1", "source": "explicit", "representation": "native", "stay_id_space": REFERENCE_STAY_SPACES["miiv"]}
    for name, table, told in (("candidate", _wide_a(spark, sf_dir), notes), ("reference", _wide_b(spark, sf_dir), None)):
        sinks.write_table(_rounded(table), root / f"{name}.parquet", told, buckets=8)
    return root / "candidate.parquet", root / "reference.parquet"


@_query(ORACLE_SQL["per_stay_reproduction"])
def per_stay_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As per_stay_reproduction, of tables in buckets, which are joined without an exchange."""
    a, b = (commits.read_table(use_clusters(spark), path) for path in _in_buckets(spark, sf_dir))
    return _rounded(Paired.of(a, b).per_stay())


@_query(ORACLE_SQL["comparison_accuracy"].partition("SELECT 'shared_subset'")[0] + """SELECT stay_id, count(*) FILTER (l) AS n_rows_candidate, count(*) FILTER (r) AS n_rows_reference, count(*) FILTER (l AND NOT r) AS n_only_candidate_rows,
count(*) FILTER (r AND NOT l) AS n_only_reference_rows, count(*) FILTER (l AND r AND eq) AS n_equal_rows FROM f GROUP BY stay_id""")
def comparison_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comparison of tables on disk that writes its reports; those of the stays, read back."""
    candidate, reference = _in_buckets(spark, sf_dir)
    stays = _stays(spark, sf_dir).where("stay_id % 4 <> 0")
    end = F.floor((F.unix_micros(F.col("outtime").cast("timestamp")) - F.unix_micros(F.col("intime").cast("timestamp"))) / F.lit(3.6e9))
    windows = stays.select("stay_id", F.lit(0.0).alias("start"), F.when(F.col("stay_id") % 9 != 0, end.cast("double")).alias("end"))
    windows.write.parquet(str(candidate.parent / "windows.parquet"))
    _, folder = compare_files(spark, "mimic-iv", candidate, reference, candidate.parent / "windows.parquet", output_root=candidate.parent, max_hours=500, concepts=CONCEPTS, reference_version="2.2")
    names = ["stay_id", "n_rows_candidate", "n_rows_reference", "n_only_candidate_rows", "n_only_reference_rows", "n_equal_rows"]
    return spark.read.csv(str(folder / "per_stay_reproduction.csv"), header=True).select(*[F.col(c).cast("long") for c in names])


@_query(ORACLE_SQL["missingness"])
def plain_reports_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six reports of two tables without versions, written; where concepts are known, read back."""
    folder = Place(shared_folder(spark, "reports"))
    write_plain_reports(_wide_a(spark, sf_dir), _wide_b(spark, sf_dir), folder)
    table = spark.read.csv(str(folder / "missingness.csv"), header=True)
    return table.select("concept", *[F.col(c).cast("long") for c in table.columns if c != "concept"])


@_query(f"""WITH {MATCHED} SELECT concept, side, item_status, item_id, candidate_n_rows, CASE WHEN item_id LIKE '%5' THEN 'accept' WHEN item_id LIKE '%7' THEN 'reject' END AS reviewer_verdict FROM matched""")
def item_review_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review written, judged by an expert, and written anew: the judgements stay."""
    folder = Place(shared_folder(spark, "review"))
    coded = _coded(spark, sf_dir)
    tables = {c: coded.where(F.col("concept") == c).drop("concept") for c in CONCEPTS}
    configured = ConceptDict({c: {"sources": {"miiv": told["sources"]["src"]}} for c, told in _dictionary().items()})
    pair = VersionPair(DatasetVersion("mimic-iv", "3.1", "explicit"), DatasetVersion("reference:miiv", "3.1", "explicit"))
    made = review.build_review(spark, "mimic-iv", tables, configured, pair, CONCEPTS)
    path, _ = review.write_review(spark, made, folder)
    read = lambda: spark.read.csv(str(path), header=True, multiLine=True, escape='"')
    verdict = F.when(F.col("item_id").endswith("5"), "accept").when(F.col("item_id").endswith("7"), "reject")
    sinks.replace_rows(read().withColumn("reviewer_verdict", verdict), folder, "item_review")
    review.write_review(spark, made, folder)
    return read().select("concept", "side", "item_status", "item_id", F.col("candidate_n_rows").cast("long"), "reviewer_verdict")


@_query("SELECT event_type AS concept, CASE WHEN event_type < 'f' THEN '1.0.0' ELSE 'draft' END AS version, count(*) AS n_rows FROM events GROUP BY event_type")
def concepts_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept tables found below a concept root, in folders of versions, and their rows."""
    root = Place(shared_folder(spark, "concepts"))
    for c in CONCEPTS:
        _ev(spark, sf_dir).where(F.col("concept") == c).drop("concept").write.parquet(str(root / c / ("1.0.0" if c < "f" else "draft") / "mimic-iv.parquet"))
    found = layout.discover_concepts(root, "mimic-iv")
    return reduce(DataFrame.unionByName, [ev.read_concept(spark, str(t.path)).agg(F.lit(t.name).alias("concept"), F.lit(t.version).alias("version"), F.count("*").alias("n_rows")) for t in found])


@_query(f"WITH {STAYS} SELECT stay_id, intime, outtime, '3.1' AS version FROM stays WHERE stay_id % 3 = 1")
def stay_table_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stay table of the wanted version among those below a data root, by what its path says."""
    root = Place(shared_folder(spark, "data"))
    for k, folder in enumerate(("mimic-iv-2.2", "mimic-iv-3.1", "mimic-iv-demo-3.1")):
        table = _stays(spark, sf_dir).where(F.col("stay_id") % 3 == k).withColumn("hadm_id", F.col("stay_id"))
        table.withColumns({c: F.col(c).cast("string") for c in ("intime", "outtime")}).write.csv(str(root / folder / "icu" / "icustays.csv.gz"), header=True)
    chosen = layout.resolve_stay_table("mimic-iv", wanted="3.1", environment={"STAYGRID_DATA_ROOT": str(root)})
    return st.datetime_stays(st.read_table(spark, str(chosen.path))).select("stay_id", "intime", "outtime", F.lit(chosen.version).alias("version"))


_KNOWN_AS = ("explicit", "concept_column", "manual_default", "unknown")
_PAIRED_WITH = (("mimic-iv", "raw_table", "miiv"), ("aumc", "events", "aumc"), ("hirid", "raw_table", "hirid"))


@_query(f"""WITH p AS (SELECT *, o_orderkey % 3 AS k, [{", ".join(repr(x) for x in _KNOWN_AS)}][1 + o_orderkey % 4] AS candidate_source, o_custkey % 5 = 0 AS has_crosswalk,
  (o_orderkey // 4) % 3 AS major, (o_custkey // 5) % 2 AS other, o_custkey % 4 AS n_candidate, o_orderkey % 7 AS n_reference FROM orders),
v AS (SELECT *, least(n_candidate, n_reference) AS n_shared, candidate_source <> 'unknown' AS known, candidate_source IN ('explicit', 'concept_column') AS verified, major = other AS same, k <> 1 OR has_crosswalk AS matchable FROM p)
SELECT o_orderkey, CASE WHEN known THEN same END AS same_version, CASE WHEN has_crosswalk THEN 'crosswalk' WHEN k = 1 THEN 'side_by_side_only' ELSE 'direct_identifier_match' END AS stay_comparison_basis,
CASE WHEN NOT matchable THEN 'not_applicable' WHEN has_crosswalk THEN 'crosswalk' WHEN verified AND same THEN 'same_verified_version' ELSE 'unverified_cross_version_stability' END AS stay_id_version_assumption,
CASE WHEN NOT matchable OR n_shared = 0 THEN 'not_comparable' WHEN NOT verified THEN 'shared_subset_unverified_version' WHEN NOT same THEN 'shared_subset_cross_version' WHEN has_crosswalk THEN 'shared_subset_stay_crosswalk' ELSE 'full_same_version' END AS validation_level,
CASE WHEN NOT matchable THEN 'not_comparable' WHEN verified AND same AND NOT has_crosswalk THEN 'high' ELSE 'medium' END AS stay_comparison_confidence,
CASE WHEN NOT matchable OR n_shared = 0 THEN 'not_directly_comparable' WHEN n_candidate = n_reference THEN 'equal' WHEN n_shared = n_reference THEN 'candidate_superset' ELSE 'reference_superset' END AS stay_relationship FROM v""")
def pairs_assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of many comparisons allows to conclude, one for each order."""
    o, c = _table(spark, sf_dir, "orders"), F.col
    told = lambda values, k: F.element_at(F.array(*[F.lit(v) for v in values]), (k + 1).cast("int"))
    k, source = c("o_orderkey") % 3, told(_KNOWN_AS, c("o_orderkey") % 4)
    given, declared = (F.when(c("o_orderkey") % 2 == want, F.concat(F.lit("0"), (F.floor(c("o_custkey") / 5) % 2).cast("string"), F.lit(".0"))) for want in (0, 1))
    version, how = inventory.reference_evidence(given, declared, F.lit("9.9"), told([x[2] for x in _PAIRED_WITH], k))
    pairs = o.select(
        "o_orderkey", *[told([x[i] for x in _PAIRED_WITH], k).alias(n) for i, n in enumerate(("candidate_dataset", "candidate_stay_source", "reference_source"))],
        F.when(source != "unknown", F.concat(F.lit("v"), (F.floor(c("o_orderkey") / 4) % 3).cast("string"))).alias("candidate_version"), source.alias("candidate_version_source"),
        version.alias("reference_version"), how.alias("reference_version_source"), (c("o_custkey") % 5 == 0).alias("has_crosswalk"),
        (c("o_custkey") % 4).alias("n_candidate"), (c("o_orderkey") % 7).alias("n_reference"), F.least(c("o_custkey") % 4, c("o_orderkey") % 7).alias("n_shared"),
    )
    return inventory.assess(pairs).select("o_orderkey", "same_version", "stay_comparison_basis", "stay_id_version_assumption", "validation_level", "stay_comparison_confidence", "stay_relationship")


@_query(ORACLE_SQL["stays_visit_pairs"])
def event_stays_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As stays_visit_pairs, from the one file of either kind that is found in a workspace's extraction output of the wanted version."""
    root = Place(shared_folder(spark, "extracted"))
    o, li = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem").where("l_linenumber = 2")
    owner = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subject_id"))
    starts = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("time"), F.col("o_orderkey").alias("visit_occurrence_id"))
    ends = li.join(owner, "l_orderkey").select("subject_id", F.col("l_shipdate").alias("time"), F.col("l_orderkey").alias("visit_occurrence_id"))
    for version, rows in (("1.0.2", starts.where("false")), ("1.5.0", starts)):
        folder = root / "workspace" / layout.STEP / "aumc" / version / "visit"
        rows.write.parquet(str(folder / "VISIT_START.parquet"))
        (ends if version == "1.5.0" else ends.where("false")).write.parquet(str(folder / "VISIT_END.parquet"))
    return build.event_stays(spark, "aumc", root / "workspace", "1.5.0")
