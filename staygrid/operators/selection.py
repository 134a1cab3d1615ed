"""Exact medians of columns of any size: no column's values come together, and none is shuffled whole.

The first pass over the rows counts each column's numbers and sketches their quantiles, which
combine before anything moves. While more than BOUND values lie strictly between the two values
known to hold a column's middle, a further pass counts exactly what lies below, and sketches what lies
between, which leaves under a tenth of it. In the last pass only rows between travel, equal values as
one row with its count, and are ranked: at most BOUND + 2 rows a column, whatever the input's size. The driver
sees a row of GRID + 1 quantiles a column and pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Quantiles between which columns are narrowed down, and the sketches' error as a part of one.
GRID, ACCURACY = 64, 2000
#: Values of a column that are ranked together, and columns of one pass.
BOUND, COLUMNS = 100_000, 64


@dataclass
class _Middle:
    """Where a column's two middle ranks lie (from 0): between two values, both included (None: no bound)."""

    value: Column
    low: int
    high: int
    inside: int
    grid: list[float]
    start: float | None = None
    end: float | None = None
    before: int = 0
    upto: int = 0

    def narrow(self) -> None:
        """Bring start and end closer: to quantiles further from the ranks than the sketch's error."""
        place = lambda rank, step: (rank - self.upto) * GRID // self.inside + step
        k = place(self.low, -2)
        if self.low >= self.upto and k >= 0:
            self.start = self.grid[k]
        k = place(self.high, 3)
        if self.high < self.upto + self.inside and k <= GRID:
            self.end = self.grid[k]

    def between(self, strictly: bool) -> Column:
        low, high = F.lit(self.start), F.lit(self.end)
        out = self.value.isNotNull() & ~F.isnan(self.value)
        if self.start is not None:
            out = out & (self.value > low if strictly else self.value >= low)
        if self.end is not None:
            out = out & (self.value < high if strictly else self.value <= high)
        return out

    def counts(self, name: str) -> list[Column]:
        below = lambda x: F.lit(0) if self.start is None else F.count_if(x)
        start = F.lit(self.start)
        return [below(self.value < start).alias(f"{name}_before"), below(self.value <= start).alias(f"{name}_upto"), *_sketch(F.when(self.between(True), self.value), name)]

    def learn(self, row: Row, name: str) -> None:
        self.before, self.upto, self.inside, self.grid = row[f"{name}_before"], row[f"{name}_upto"], row[f"{name}_n"], row[f"{name}_q"]


def _sketch(value: Column, name: str) -> list[Column]:
    return [F.count(value).alias(f"{name}_n"), F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY).alias(f"{name}_q")]


def _ranked(rows: DataFrame, middles: Mapping[str, _Middle]) -> DataFrame:
    """column and median: what lies between start and end, ranked."""
    ranks = lambda m: (F.lit(m.low - m.before).alias("low"), F.lit(m.high - m.before).alias("high"))
    entries = [F.when(m.between(False), F.struct(F.lit(name).alias("column"), m.value.alias("value"), *ranks(m))) for name, m in middles.items()]
    each = rows.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("column", "value", "low", "high").agg(F.count("*").alias("times"))
    upto = F.sum("times").over(Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    at = lambda rank: F.max(F.when((F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("times")), F.col("value")))
    found = each.withColumn("upto", upto).groupBy("column").agg(at("low").alias("low"), at("high").alias("high"))
    return found.select("column", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") * 0.5 + F.col("high") * 0.5).alias("median"))


def column_medians(rows: DataFrame, columns: Mapping[str, Column], also: Sequence[Column] = (), bound: int = BOUND) -> tuple[Row, DataFrame]:
    """The median of each of at most COLUMNS double columns as rows of `column` and `median`, and the first pass's aggregates.

    Nulls don't count, not-a-number sorts last; a column without values has no row. `also`: aggregates that the first
    pass takes along. `rows` are read in each pass: give what is cheap to read again, or persisted.
    """
    first = rows.agg(F.count("*").alias("_rows"), *also, *[c for i, v in enumerate(columns.values()) for c in (F.count(v).alias(f"{i}_all"), *_sketch(F.when(~F.isnan(v), v), str(i)))]).first()
    middles, unknown = {}, []
    for i, (name, value) in enumerate(columns.items()):
        n = first[f"{i}_all"]
        if n and n // 2 < first[f"{i}_n"]:
            middles[name] = _Middle(value, (n - 1) // 2, n // 2, first[f"{i}_n"], first[f"{i}_q"])
        elif n:
            unknown.append((name, float("nan")))
    while wide := {str(i): m for i, m in enumerate(middles.values()) if m.inside > bound}:
        for m in wide.values():
            m.narrow()
        row = rows.agg(F.count("*").alias("_rows"), *[c for i, m in wide.items() for c in m.counts(i)]).first()
        for i, m in wide.items():
            m.learn(row, i)
    out = rows.sparkSession.createDataFrame(unknown, "column string, median double")
    return first, out.unionByName(_ranked(rows, middles)) if middles else out


def medians(rows: DataFrame, by: str, value: str, output: str = "median") -> DataFrame:
    """`by` and the exact median of `value` (a double, no nulls) for each of few groups of any size."""
    kind = rows.schema[by].dataType
    groups = [r[0] for r in rows.select(by).distinct().collect()]
    parts = []
    for at in range(0, len(groups), COLUMNS):
        some = {str(at + i): F.when(F.col(by).eqNullSafe(F.lit(g)), F.col(value)) for i, g in enumerate(groups[at : at + COLUMNS])}
        parts.append(column_medians(rows, some)[1])
    names = rows.sparkSession.createDataFrame([(str(i), None if g is None else str(g)) for i, g in enumerate(groups)], "column string, group string").select("column", F.col("group").cast(kind).alias(by))
    out = names.limit(0).select(by, F.lit(None).cast("double").alias(output))
    for part in parts:
        out = out.unionByName(part.join(F.broadcast(names), "column").select(by, F.col("median").alias(output)))
    return out
