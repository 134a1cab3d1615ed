"""Events into stays and hours."""

from datetime import datetime, timedelta

import pytest

from staygrid.operators import grid, mapping, wide
from staygrid.sources import events as ev
from staygrid.sources import stays as st

T0 = datetime(2026, 1, 1)
MINUTES = (0, 29, 30, 59, 60, 89, 119, 120)


def _hours(rows):
    return [r["time"] for r in sorted(rows.collect(), key=lambda r: r["numeric_value"])]


def test_hours_are_floored(spark):
    events = spark.createDataFrame([(1, h, float(i)) for i, h in enumerate((10.0, 10.49, 10.5, 10.99, 11.0, 11.49, 11.99, 12.0))], "subject_id long, time_hours double, numeric_value double")
    stays = spark.createDataFrame([(1, 7, 10.0, 20.0)], "subject_id long, stay_id long, intime_hours double, outtime_hours double")
    assert _hours(mapping.map_by_hours(events, stays)) == [0, 0, 0, 0, 1, 1, 1, 2]


def test_times_are_floored(spark):
    events = spark.createDataFrame([(1, T0 + timedelta(minutes=m), float(i)) for i, m in enumerate(MINUTES)], "subject_id long, time timestamp_ntz, numeric_value double")
    stays = spark.createDataFrame([(1, 7, T0, T0 + timedelta(hours=9))], "subject_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    assert _hours(mapping.map_by_time(events, stays)) == [0, 0, 0, 0, 1, 1, 1, 2]


def test_link_column_chooses_the_stay(spark):
    events = spark.createDataFrame([(1, 5.0, 10.0, "100"), (1, 5.0, 20.0, "200")], "subject_id long, time double, numeric_value double, visit_occurrence_id string")
    stays = spark.createDataFrame([(1, 100, 0.0, 9.0), (1, 200, 0.0, 9.0)], "subject_id long, stay_id long, intime_hours double, outtime_hours double")
    out = mapping.map_by_hours(ev.subject_events_in_hours(events), stays).collect()
    assert {(r["stay_id"], r["numeric_value"]) for r in out} == {(100, 10.0), (200, 20.0)}


def test_window_has_both_ends_and_may_be_open(spark):
    events = spark.createDataFrame([(1, 1.0, 1.0), (1, 3.0, 2.0), (1, 3.5, 3.0), (1, 0.5, 4.0)], "subject_id long, time_hours double, numeric_value double")
    stays = spark.createDataFrame([(1, 7, 1.0, 3.0), (1, 8, 1.0, None)], "subject_id long, stay_id long, intime_hours double, outtime_hours double")
    out = {(r["stay_id"], r["numeric_value"]) for r in mapping.map_by_hours(events, stays).collect()}
    assert out == {(7, 1.0), (7, 2.0), (8, 1.0), (8, 2.0), (8, 3.0)}
    free = {(r["stay_id"], r["numeric_value"]) for r in mapping.map_by_hours(events, stays, window=False).collect()}
    assert free == out | {(7, 3.0)}


def test_without_a_window_what_comes_before_admission_goes(spark):
    """To the microsecond, though hours are counted in whole seconds."""
    seconds = (-3600.0, -1.5, -1.0, -0.999999, -0.4, -0.000001, 0.0, 0.000001, 3599.999999, 3600.0, 36_000.0)
    events = spark.createDataFrame([(1, T0 + timedelta(seconds=x), x) for x in seconds], "subject_id long, time timestamp_ntz, numeric_value double")
    stays = spark.createDataFrame([(1, 7, T0, T0 + timedelta(hours=2))], "subject_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    free = {(r["numeric_value"], r["time"]) for r in mapping.map_by_time(events, stays, window=False).collect()}
    assert free == {(0.0, 0), (0.000001, 0), (3599.999999, 0), (3600.0, 1), (36_000.0, 10)}


def test_grids_differ_on_unknown_length(spark):
    rows = [(1, T0, T0 + timedelta(hours=2, minutes=30)), (2, T0, None), (3, T0, T0 - timedelta(hours=1))]
    times = spark.createDataFrame(rows, "stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    n = lambda g: {r["stay_id"]: r["count"] for r in g.groupBy("stay_id").count().collect()}
    assert n(grid.grid_from_times(times)) == {1: 3, 2: 1, 3: 1}
    assert n(grid.grid_from_times(times, rounding="ceil")) == {1: 4, 2: 1, 3: 1}
    hours = spark.createDataFrame([(1, 0.0, 2.5), (2, 0.0, None), (3, 0.0, -1.0)], "stay_id long, intime_hours double, outtime_hours double")
    assert n(grid.grid_from_hours(hours, 5)) == {1: 3, 2: 6, 3: 6}
    assert n(grid.grid_from_hours(hours)) == {1: 3, 2: 1, 3: 1}
    assert n(grid.grid_from_hours(hours, 0)) == {1: 1, 2: 1, 3: 1}


def test_stays_from_events(spark):
    admissions = spark.createDataFrame([(7, T0, 70), (7, T0, 80), (8, T0, 90)], "subject_id long, time timestamp_ntz, case_id long")
    seen = spark.createDataFrame([(7, T0 + timedelta(hours=2), 70), (7, T0 + timedelta(hours=9, minutes=30), 70)], "subject_id long, time timestamp_ntz, case_id long")
    by_case = {r["stay_id"]: (r["subject_id"], None if r["outtime_hours"] is None else r["outtime_hours"] - r["intime_hours"]) for r in st.stays_from_observations(admissions, seen, "case_id").collect()}
    assert by_case == {70: (7, 9.5), 80: (7, None), 90: (8, None)}
    by_subject = {r["stay_id"] for r in st.stays_from_observations(admissions, seen).collect()}
    assert by_subject == {7, 8}


def test_discharge_year_timeline(spark):
    from staygrid.registry import stay_spec

    table = spark.createDataFrame([("141179", "128927", "2015", "08:56:00", "-22", "2042")], "PatientUnitStayID string, patienthealthsystemstayid string, hospitaldischargeyear string, hospitaladmittime24 string, hospitaladmitoffset string, unitdischargeoffset string")
    row = st.normalized_stays(table, stay_spec("eicu")).first()
    admitted = (datetime(2015, 1, 1, 9, 18) - datetime(1970, 1, 1)).total_seconds() / 3600
    assert (row["subject_id"], row["stay_id"]) == (128927, 141179)
    assert abs(row["intime_hours"] - admitted) < 1e-9 and abs(row["outtime_hours"] - row["intime_hours"] - 2042 / 60) < 1e-9


def test_aggregates_of_nulls_and_ties(spark):
    rows = [("a", 1, 0, 1.0, None), ("a", 1, 0, 2.0, None), ("b", 1, 0, 5.0, 3.0), ("b", 1, 0, 5.0, 1.0), ("b", 1, 0, 4.0, float("nan"))]
    events = spark.createDataFrame(rows, "concept string, stay_id long, time long, at double, numeric_value double")
    row = wide.wide_table(events, {"a": "sum", "b": "max", "c": "sum"}).first()
    assert (row["a"], row["b"], row["c"]) == (0.0, 3.0, None)
    first = wide.wide_table(events.where("not isnan(numeric_value) or numeric_value is null"), {"b": "first"}).first()
    assert first["b"] == 1.0


def test_conditional_form_equals_joins(spark):
    import random

    r = random.Random(5)
    rows = [(r.choice("abcd"), r.randrange(4), r.randrange(6), r.random(), round(r.random() * 50, 2)) for _ in range(400)]
    events = spark.createDataFrame(rows, "concept string, stay_id long, time long, at double, numeric_value double")
    names = {"a": "mean", "b": "median", "c": "last", "d": "sum"}
    chain = None
    for c, a in names.items():
        one = wide.hourly(events.where(f"concept = '{c}'"), a, c)
        chain = one if chain is None else chain.join(one, ["stay_id", "time"], "full")
    key = lambda df: sorted((r["stay_id"], r["time"], *(None if r[c] is None else round(r[c], 9) for c in names)) for r in df.collect())
    assert key(wide.wide_table(events, names)) == key(chain) == key(wide.wide_table(events, names, widest=1))


def test_rows_of_medians_are_dealt_to_all_partitions(spark):
    """However few bytes they take in a shuffle, no task gets them all."""
    from functools import reduce

    from pyspark.sql import functions as F

    from staygrid.plans import build
    from staygrid.sources.concept_dict import ConceptDict

    stays = spark.range(40).select(F.col("id").alias("subject_id"), F.col("id").alias("stay_id"), F.lit(0.0).alias("intime_hours"), F.lit(99.0).alias("outtime_hours"))
    table = spark.range(4000).select((F.col("id") % 40).alias("subject_id"), (F.col("id") % 97).cast("double").alias("time"), F.col("id").cast("double").alias("numeric_value"))
    events = mapping.map_by_hours(ev.subject_events_in_hours(table.withColumn("concept", F.lit("a"))), stays)
    everywhere = set(range(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    assert len(everywhere) > 1
    where = lambda df: {r["p"] for r in df.withColumn("p", F.spark_partition_id()).collect()}
    assert where(wide.hourly(events, "median")) == where(wide.wide_table(events, {"a": "median", "b": "sum"})) == where(wide.wide_table(events, {"a": "mean", "b": "median"})) == everywhere
    each = [build.build_all({"heart_rate": table}, build.Stays(stays), d, ConceptDict({"hr": {"aggregate": "median"}}), grid=False, sort=False) for d in ("nwicu", "miiv", "hirid")]
    both = reduce(lambda a, b: a.unionByName(b), each)
    assert where(each[0]) == everywhere and both.count() == 3 * each[0].count() == 3 * table.select("subject_id", "time").distinct().count()


def test_a_subject_with_many_stays(spark):
    """Bins give what the plain join gives, and events meet few of a subject's thousand stays."""
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    t0 = datetime(2150, 1, 1)
    stays = [(1, k, t0 + timedelta(days=3 * k), t0 + timedelta(days=3 * k + 4, minutes=k)) for k in range(1000)]
    odd = [(2, 5000, t0, None), (2, 5001, t0 + timedelta(days=30), t0 + timedelta(days=29)), (2, 5002, t0, t0 + timedelta(days=2000)), (None, 5003, t0, None), (3, 5004, t0 - timedelta(days=9000), t0 - timedelta(days=8999))]
    events = [(1, t0 + timedelta(hours=7 * k), float(k)) for k in range(3000)] + [(2, t0 + timedelta(days=k), 1.0) for k in range(-3, 60)]
    events += [(1, None, 1.0), (None, t0, 1.0), (3, t0 - timedelta(days=9000), 3.0), (1, t0 + timedelta(days=4), 0.5)]
    e = spark.createDataFrame(events, "subject_id long, time timestamp_ntz, numeric_value double")
    hours = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / F.lit(3.6e9)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for rows, bounded in ((stays, True), (stays + odd, False)):
        s = spark.createDataFrame(rows, "subject_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
        assert mapping.crowded(s) and not mapping.crowded(s.where("stay_id >= 5000"))
        for many in (1.0, 168.0, 5000.0):
            got, want = (mapping.map_by_time(e, s, bins=b).collect() for b in (many, None))
            assert sorted(map(repr, got)) == sorted(map(repr, want))
            eh, sh = e.select("subject_id", hours("time").alias("time_hours"), "numeric_value"), s.select("subject_id", "stay_id", hours("intime").alias("intime_hours"), hours("outtime").alias("outtime_hours"))
            got, want = (mapping.map_by_hours(eh, sh, bins=b).collect() for b in (many, None))
            assert sorted(map(repr, got)) == sorted(map(repr, want))
        if bounded:
            place = lambda c: hours(c) / 168
            met = mapping._meeting(e, s, place("time"), place("intime"), place("outtime"))
            assert met.count() < 5 * len(events) < e.join(s, "subject_id").count() / 100
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_versions_by_footers(spark, tmp_path):
    """Files that hold a known version alone are settled by their footers: their data may be unreadable."""
    from pyspark.sql import functions as F

    from staygrid.sources.events import dataset_versions

    ids = spark.range(20_000, numPartitions=1).withColumn("x", F.rand(1))
    versions = F.when(F.col("id") < 10, "3.1").otherwise("2.2").alias("dataset_version")
    ids.select("id", "x", versions).write.parquet(str(tmp_path / "a.parquet"))
    ids.limit(500).select("id", "x", F.lit("2.2").alias("dataset_version")).coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "b.parquet"))
    (file,) = (tmp_path / "b.parquet").glob("part-*")
    raw = bytearray(file.read_bytes())
    footer = int.from_bytes(raw[-8:-4], "little")
    raw[4 : len(raw) - 8 - footer] = bytes(len(raw) - 12 - footer)
    file.write_bytes(raw)
    for crc in (tmp_path / "b.parquet").glob(".*.crc"):
        crc.unlink()
    a, b = (spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in "ab")
    with pytest.raises(Exception):  # noqa: B017
        b.agg(F.max("dataset_version")).collect()
    assert dataset_versions([a, b]) == ["2.2", "3.1"]
    assert dataset_versions([a, a.drop("dataset_version")]) is None and dataset_versions([]) == []
    odd = spark.createDataFrame([(None,), (2,), (3,)], "dataset_version int")
    assert dataset_versions([odd, odd.where("false")]) == ["2", "3"]
