"""Putting subject-level events into stays, at whole hours since admission.

Both joins have an equality key, so Catalyst plans a hash or sort-merge join and applies the
window as part of its condition; which side is small is left to statistics, and skewed subjects
to adaptive execution.

A subject with very many stays would still meet each of its events with each of its stays. For such
(`crowded` tells, from the stays alone) the join also has a key of time: a stay lies in the bins of `bins` hours
that it overlaps, an event in the one it falls into. Stays without an end, or over more than LONGEST bins, have a
bin of their own in which every event of the subject meets them, as it mostly belongs there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.functions.timeunits import floored_hours, whole_hours_between
from staygrid.schemas import link_column


#: Stays of a subject from which bins pay, hours of a bin, and bins that a stay may overlap to lie in them.
CROWD, BIN_HOURS, LONGEST = 32, 168.0, 64


def crowded(stays: DataFrame) -> bool:
    """Whether any subject has so many stays that its events should meet only those around them."""
    return stays.groupBy("subject_id").count().where(F.col("count") > CROWD).limit(1).count() > 0


def _meeting(events: DataFrame, stays: DataFrame, at: Column, begin: Column, end: Column) -> DataFrame:
    """Events and stays of equal subjects that lie in the same bin; at, begin and end in bins as doubles."""
    short = end.isNotNull() & (end - begin <= LONGEST)
    bins = F.when(short, F.when(end >= begin, F.sequence(F.floor(begin), F.floor(end)))).otherwise(F.array(F.lit(None).cast("long")))
    dealt = stays.withColumn("_bin", F.explode(bins))
    if not dealt.where("_bin is null").limit(1).count():
        return events.withColumn("_bin", F.floor(at)).join(dealt, ["subject_id", "_bin"])
    met = F.array(F.struct(F.floor(at).alias("bin"), F.lit(False).alias("long")), F.struct(F.lit(0).cast("long").alias("bin"), F.lit(True).alias("long")))
    dealt = dealt.withColumn("_long", F.col("_bin").isNull()).withColumn("_bin", F.coalesce("_bin", F.lit(0).cast("long")))
    twice = events.withColumn("_met", F.explode(met)).withColumns({"_bin": F.col("_met.bin"), "_long": F.col("_met.long")}).drop("_met")
    return twice.join(dealt, ["subject_id", "_bin", "_long"])


def _within(at: str, begin: str, end: str) -> Column:
    return (F.col(at) >= F.col(begin)) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))


def _placed(mapped: DataFrame, hour: Column, at: str, events: DataFrame) -> DataFrame:
    extra = [c for c in ("concept", "event_id") if c in events.columns]
    out = mapped.select("stay_id", hour.alias("_hour"), F.col(at).alias("at"), "numeric_value", *extra)
    return out.where("_hour >= 0").withColumnRenamed("_hour", "time")


def map_by_time(events: DataFrame, stays: DataFrame, *, window: bool = True, bins: float | None = None) -> DataFrame:
    """stay_id, time, at, numeric_value (and concept): each event in every stay of its subject it falls into.

    `events`: subject_id, time, numeric_value. `stays`: subject_id, stay_id, intime, outtime
    (null: open). The window includes both ends; without it only events before admission go.
    `bins`: hours of a bin, for subjects with very many stays; of no use without the window.
    """
    stays = stays.select("subject_id", "stay_id", "intime", "outtime")
    if bins and window:
        place = lambda c: F.unix_micros(c.cast("timestamp")) / F.lit(bins * 3.6e9)
        joined = _meeting(events, stays, place(F.col("time")), place(F.col("intime")), place(F.col("outtime")))
    else:
        joined = events.join(stays, "subject_id")
    # whole seconds are cut towards zero: hour 0 would take what comes less than a second before admission
    joined = joined.where(_within("time", "intime", "outtime") if window else F.col("time") >= F.col("intime"))
    return _placed(joined, whole_hours_between(F.col("intime"), F.col("time")), "time", events)


def map_by_hours(events: DataFrame, stays: DataFrame, *, window: bool = True, bins: float | None = None) -> DataFrame:
    """As `map_by_time` with time_hours and intime_hours/outtime_hours as doubles.

    Events with a link column (a visit or case) go to that stay alone.
    """
    stays = stays.select("subject_id", "stay_id", "intime_hours", "outtime_hours")
    link = link_column(events.columns)
    if link is None and bins and window:
        joined = _meeting(events, stays, *[F.col(c) / F.lit(bins) for c in ("time_hours", "intime_hours", "outtime_hours")])
    elif link is None:
        joined = events.join(stays, "subject_id")
    else:
        joined = events.withColumn("stay_id", F.col(link).cast("long")).join(stays, ["subject_id", "stay_id"])
    if window:
        joined = joined.where(_within("time_hours", "intime_hours", "outtime_hours"))
    return _placed(joined, floored_hours(F.col("intime_hours"), F.col("time_hours")), "time_hours", events)


def map_identity(events: DataFrame) -> DataFrame:
    """The subject is the stay, and times are hours since admission already."""
    mapped = events.withColumn("stay_id", F.col("subject_id"))
    return _placed(mapped, F.floor("time_hours").cast("long"), "time_hours", events)
