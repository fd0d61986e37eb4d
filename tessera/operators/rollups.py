"""Grouped aggregates.

All of these are ``groupBy().agg()`` plans: Spark computes a partial
aggregate before the shuffle (map-side combine), so a hot key holding a large
share of the rows still sends only one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import q
from tessera.functions.scalars import is_weekend


def unnest_rollup(df: DataFrame, key: str, array_col: str, value_field: str,
                  min_count: int = 5, precision: int = 38, scale: int = 2,
                  count_name: str = "w_records", sum_name: str = "w_amounts") -> DataFrame:
    """C1 core (P4, A1, A6, F11): one row per element of an array column.

    Rows whose array is empty or NULL vanish (``explode``, not
    ``explode_outer``).  Only ``array_col.value_field`` is extracted before the
    explode, which lets nested schema pruning read just that leaf.
    """
    exploded = df.select(F.col(key), F.explode(F.col(f"{array_col}.{value_field}")).alias("_v"))
    return (exploded.groupBy(key)
            .agg(F.count(F.lit(1)).alias(count_name),
                 F.sum(F.col("_v").cast(f"decimal({precision},{scale})")).alias(sum_name))
            .filter(F.col(count_name) >= F.lit(min_count)))


def grouped_stats(df: DataFrame, keys: list[str], specs: dict[str, Column]) -> DataFrame:
    """A list of named aggregate expressions per group."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in specs.items()])


def weekday_weekend_counts(ts: str | Column) -> list[Column]:
    """Weekend and weekday counts (``SUM(CASE ...)`` as ``count_if``)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    weekend = is_weekend(t)
    return [F.count_if(weekend).alias("weekend_downloads"),
            F.count_if(~weekend).alias("weekday_downloads")]


def prior_period_counts(df: DataFrame, key: str, ts: str, before, name: str = "historical_downloads") -> DataFrame:
    """One grouped pass replacing per-group correlated subqueries."""
    from tessera.functions.predicates import time_range

    return df.filter(time_range(ts, end=before)).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def excess_copies(df: DataFrame, column: str) -> DataFrame:
    """``COUNT(c) - COUNT(DISTINCT c)`` as one grouped pass.

    The grouping is partially aggregated before the shuffle, unlike
    several ``COUNT(DISTINCT)`` in one select, which multiplies the rows
    through an ``Expand``.
    """
    c = F.col(q(column))
    per_value = df.select(c.alias("_k")).filter(F.col("_k").isNotNull()).groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    return per_value.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("failing_rows"))


def approx_distinct_with_check(df: DataFrame, key: str, column: str, rsd: float = 0.05,
                               tolerance: float = 0.15) -> DataFrame:
    """A4: ``approx_count_distinct`` per group, with an exactness flag.

    The flag compares the sketch with the exact count and is only meant for
    validation runs; reports use the sketch alone.
    """
    return (df.groupBy(key)
            .agg(F.approx_count_distinct(column, rsd).alias("approx_distinct"),
                 F.count_distinct(column).alias("exact_distinct"))
            .select(key, "exact_distinct",
                    (F.abs(F.col("approx_distinct") - F.col("exact_distinct"))
                     <= F.lit(tolerance) * F.col("exact_distinct")).alias("within_tolerance")))


def distinct_sketches(df: DataFrame, keys: list[str], ts: str, column: str, lg_k: int = 12, day: str = "day") -> DataFrame:
    """A4 to be stored: per group and day the row count and a mergeable HLL sketch of ``column`` (at most 2^lg_k bytes).

    A daily job appends its day; any window's distinct count then comes from the
    rollup (:func:`distinct_in_window`), the log is not read again.
    """
    from tessera.functions.scalars import to_day

    return df.groupBy(*[F.col(q(k)) for k in keys], to_day(ts).alias(day)).agg(
        F.count(F.lit(1)).alias("row_count"), F.hll_sketch_agg(F.col(q(column)), F.lit(lg_k)).alias("sketch"))


def distinct_in_window(rollup: DataFrame, keys: list[str], start=None, end=None, day: str = "day",
                       name: str = "approx_distinct") -> DataFrame:
    """Row count and approximate distinct count per group over the days from ``start`` to before ``end``, from sketches alone."""
    if start is not None:
        rollup = rollup.filter(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        rollup = rollup.filter(F.col(day) < F.lit(end).cast("date"))
    # an empty sketch (all values NULL that day) merges like any other
    return rollup.groupBy(*[F.col(q(k)) for k in keys]).agg(
        F.sum("row_count").alias("row_count"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
