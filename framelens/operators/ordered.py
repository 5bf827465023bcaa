"""Ordered aggregates in two levels, for keys that may hold a large share of all rows.

A window over a whole key puts it into one task. Here the order column is cut into steps; a window runs inside each
(key, step) and a second one over the steps' summaries, of which a key has at most ``steps`` + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 1024


def step_of(confidence: Column, steps: int = STEPS) -> Column:
    """Cuts 0 to 1 into steps that count up as confidence goes down."""
    return (steps - F.floor(F.least(F.greatest(confidence, F.lit(0.0)), F.lit(1.0)) * steps)).cast("int")


def running_sums(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, str], step: str = "_step") -> DataFrame:
    """Adds the sums of columns up to and with each row: ``values`` maps new names to columns. ``step`` rises with the order."""
    inner = Window.partitionBy(*keys, step).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, step).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in values.items()])
    bases = totals.select(*keys, step, *[F.coalesce(F.sum(f"_t_{n}").over(ahead), F.lit(0)).alias(f"_b_{n}") for n in values])
    out = df.join(bases, [*keys, step])
    for n, c in values.items():
        out = out.withColumn(n, F.col(f"_b_{n}") + F.sum(c).over(inner))
    return out.drop(*[f"_b_{n}" for n in values])


def highest_from_here(df: DataFrame, keys: list[str], order: list[Column], value: str, into: str, step: str = "_step") -> DataFrame:
    """Adds the maximum of a column over each row and all rows after it."""
    inner = Window.partitionBy(*keys, step).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    behind = Window.partitionBy(*keys).orderBy(step).rowsBetween(1, Window.unboundedFollowing)
    tops = df.groupBy(*keys, step).agg(F.max(value).alias("_top"))
    later = tops.select(*keys, step, F.max("_top").over(behind).alias("_later"))
    joined = df.join(later, [*keys, step])
    return joined.withColumn(into, F.greatest(F.max(value).over(inner), F.coalesce("_later", F.max(value).over(inner)))).drop("_later")


def following(df: DataFrame, keys: list[str], order: list[Column], columns: list[str], into: str, step: str = "_step") -> DataFrame:
    """Adds a struct of the next row's columns, null on the last row of a key. ``order`` must be total."""
    row = F.struct(*columns)
    inner = Window.partitionBy(*keys, step).orderBy(*order)
    marked = df.withColumn("_place", F.row_number().over(inner)).withColumn(into, F.lead(row).over(inner))
    firsts = marked.where("_place = 1").select(*keys, step, row.alias("_first"))
    nexts = firsts.select(*keys, step, F.lead("_first").over(Window.partitionBy(*keys).orderBy(step)).alias("_after"))
    return marked.join(nexts, [*keys, step]).withColumn(into, F.coalesce(into, "_after")).drop("_place", "_after")
