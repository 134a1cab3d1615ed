"""Events that arrive over time: the same mapping into stays on a stream, and aggregates of hours of the clock.

Stays are static; a stream-static join on the subject keeps no state. Hours are those of the clock (windows of event
time), not since admission as in wide tables: a watermark lets go of them for all stays alike. An hour's aggregate is
complete once the watermark has passed it, and late events beyond the watermark are dropped by
Structured Streaming, as always.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.operators.mapping import map_by_time


def hourly_stream(events: DataFrame, stays: DataFrame, late: str = "2 hours") -> DataFrame:
    """stay_id, concept, hour (a window of event time), n, mean, low, high from a stream of subject events.

    `events` has subject_id, time (a timestamp), numeric_value and concept. Only aggregates that
    keep bounded state are given; medians need the batch form.
    """
    mapped = map_by_time(events, stays).withWatermark("at", late)
    grouped = mapped.groupBy("stay_id", "concept", F.window("at", "1 hour").alias("hour"))
    return grouped.agg(F.count("numeric_value").alias("n"), F.avg("numeric_value").alias("mean"), F.min("numeric_value").alias("low"), F.max("numeric_value").alias("high"))
