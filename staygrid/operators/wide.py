"""From long stay events to one wide hourly table, by conditional aggregation.

All concepts are aggregated in one grouping by (stay_id, time): one shuffle whatever their
number, with partial aggregation before it. The result equals full outer joins of one table for
each concept, because those are unique in (stay_id, time) and a full join has the union of keys.

Medians keep every value until their group is complete, so partial aggregation saves them nothing: their rows
are dealt by (stay_id, time) first, to as many tasks as the session has shuffle partitions. Otherwise adaptive
execution goes by shuffled bytes, which for such short rows are a small part of what a task then holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.functions.aggregates import aggregate, check
from staygrid.schemas import KEYS

#: Concepts up to which one grouping holds an aggregation buffer for each.
WIDEST = 128


def _dealt(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows of a stay and hour together, in a number of partitions that isn't lowered, if any aggregate is a median."""
    if "median" not in names:
        return rows
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *KEYS)


def hourly(events: DataFrame, name: str, output: str = "value") -> DataFrame:
    """One concept's values, one row for each stay and hour."""
    return _dealt(events, [check(name)]).groupBy(*KEYS).agg(aggregate(name).alias(output))


def wide_table(events: DataFrame, aggregates: Mapping[str, str], widest: int = WIDEST) -> DataFrame:
    """stay_id, time and a column for each concept of `aggregates` (concept -> aggregate).

    `events` has concept, stay_id, time, at and numeric_value. Concepts without events keep
    their column. Beyond `widest` concepts each is aggregated first and pivoted then, so that a
    group's state stays small.
    """
    if not aggregates:
        raise ValueError("no concepts to put side by side")
    names = {c: check(a, c) for c, a in aggregates.items()}
    rows = _dealt(events.where(F.col("concept").isin(*names)), names.values())
    if len(names) <= widest:
        return rows.groupBy(*KEYS).agg(*[aggregate(a, only=F.col("concept") == c).alias(c) for c, a in names.items()])
    kinds = sorted(set(names.values()))
    each = rows.groupBy(*KEYS, "concept").agg(*[aggregate(a).alias(f"_{a}") for a in kinds])
    value = F.coalesce(*[F.when(F.col("concept").isin(*[c for c in names if names[c] == a]), F.col(f"_{a}")) for a in kinds])
    out = each.select(*KEYS, "concept", value.alias("value")).groupBy(*KEYS).pivot("concept", list(names)).agg(F.first("value"))
    return out.select(*KEYS, *[F.col(f"`{c}`") for c in names])


def on_grid(wide: DataFrame, grid: DataFrame) -> DataFrame:
    """Every row of the grid, with the wide table's values where it has some."""
    return grid.select(*KEYS).join(wide, KEYS, "left")


def ordered(wide: DataFrame, concepts: Sequence[str] | None = None, sort: bool = True) -> DataFrame:
    """stay_id, time and concepts; sorted by key over the whole table unless `sort` is false, which saves a shuffle."""
    concepts = list(concepts) if concepts is not None else sorted(c for c in wide.columns if c not in KEYS)
    out = wide.select(*KEYS, *[F.col(f"`{c}`") for c in concepts])
    return out.orderBy(*KEYS) if sort else out
