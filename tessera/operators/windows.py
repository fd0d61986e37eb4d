"""Window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.names import unused
from tessera.functions.predicates import trailing_days
from tessera.functions.scalars import change, pct_change, to_day


def _order(c: str | Column, descending: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_last() if descending else col.asc_nulls_first()


def topn_per_group(df: DataFrame, group_cols: list[str | Column], order_col: str, n: int = 3,
                   tie_breaker: str | None = None, descending: bool = True, rn_name: str = "rn") -> DataFrame:
    """W1 + O3: ``row_number() <= n`` per group (exactly n rows under ties).

    Catalyst plans this as a partial ``WindowGroupLimit`` before the shuffle
    and a final one after it, so a hot group ships at most ``n`` rows per map
    task.  ``tie_breaker`` makes the choice among equal values deterministic.
    Where the input has a column ``rn_name``, the number gets the next free name.
    """
    rn_name = unused(rn_name, df.columns)
    order = [_order(order_col, descending)]
    if tie_breaker is not None:
        order.append(F.col(tie_breaker).asc())
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rn_name, F.row_number().over(w)).filter(F.col(rn_name) <= F.lit(n))


def daily_rollup(df: DataFrame, ts: str, metrics: dict[str, Column], day_name: str = "calendar_day") -> DataFrame:
    """Aggregate per calendar day of a timestamp."""
    return (df.groupBy(to_day(ts).alias(day_name))
            .agg(*[expr.alias(name) for name, expr in metrics.items()]))


def period_over_period(daily: DataFrame, metrics: list[str], last_n: int = 3, day: str = "calendar_day",
                       signed: bool = True, prefix_abs: str = "absolute_", prefix_pct: str = "prec_") -> DataFrame:
    """C3 tail (W2, F6, S15-S17) on a per-day table.

    ``lag`` is row based: a missing day compares with the previous available
    day.  The "last n available days" cut is applied *after* the window, so
    the first shown day keeps its predecessor.  The window has no partition:
    it runs on one row per day, so its size is bounded by the calendar, not by
    the data volume.
    """
    w = Window.orderBy(F.col(day).asc())
    everything = Window.partitionBy()
    cols = [F.col(day)] + [F.col(m) for m in metrics]
    prev = {m: unused(f"_prev_{m}", [day, *metrics]) for m in metrics}
    max_day = unused("_max_day", [day, *metrics])
    with_prev = daily.select(*cols,
                             *[F.lag(m).over(w).alias(prev[m]) for m in metrics],
                             F.max(day).over(everything).alias(max_day))
    out = [F.col(day)] + [F.col(m) for m in metrics]
    out += [change(m, prev[m], signed).alias(f"{prefix_abs}{m}") for m in metrics]
    out += [pct_change(m, prev[m]).alias(f"{prefix_pct}{m}") for m in metrics]
    return (with_prev.filter(F.col(day) > F.date_sub(F.col(max_day), last_n))
            .select(*out))


def trailing_period_over_period(df: DataFrame, ts: str, metrics: dict[str, Column], *, days: int = 7,
                                last_n: int = 3, as_of=None, exclude_today: bool = True,
                                signed: bool = True) -> DataFrame:
    """Day-over-day change over a trailing window of ``days`` days."""
    scoped = df.filter(trailing_days(ts, days, as_of=as_of, exclude_today=exclude_today))
    daily = daily_rollup(scoped, ts, metrics)
    return period_over_period(daily, list(metrics), last_n=last_n, signed=signed)


def percent_rank_within(df: DataFrame, partition_col: str, order_col: str, descending: bool = True,
                        name: str = "percent_rank", method: str = "split",
                        rows_per_split: int = 1_000_000) -> DataFrame:
    """``PERCENT_RANK() OVER (PARTITION BY p ORDER BY v [DESC])``.

    ``method="window"`` gives the rows of the plain window without its sort of a
    whole partition value in one task: it is ``split``.  ``method="histogram"`` is skew-safe for an order column with few
    distinct values (counts): it counts rows per
    ``(p, v)`` with a partially aggregated ``groupBy``, runs the window over
    the distinct values only (rank = 1 + rows strictly ahead), and joins the
    rank back on ``(p, v)``.  A hot partition value then costs one row per
    distinct order value instead of one row per input row.  ``method="split"``
    (default) also range-splits each partition's distinct values, of any
    orderable type, at quantiles or at values of a hash-chosen sample into as many parts as
    ``rows_per_split`` asks for, whatever their number.  ``df`` is read twice (histogram
    and join back): materialize an expensive input first.
    """
    if method == "window":
        method = "split"
    hist = df.groupBy(F.col(partition_col).alias("_p"), F.col(order_col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    if method == "split":
        return _join_ranks(df, partition_col, order_col, _split_ranks(hist, descending, name, *_n_splits(hist, rows_per_split)), name)
    ahead = (Window.partitionBy("_p").orderBy(_order("_v", descending))
             .rowsBetween(Window.unboundedPreceding, -1))
    total = Window.partitionBy("_p")
    ranks = hist.select(
        "_p", "_v",
        F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_ahead"),
        F.sum("_c").over(total).alias("_n"))
    ranks = ranks.select("_p", "_v", F.when(F.col("_n") <= 1, F.lit(0.0))
                         .otherwise(F.col("_ahead").cast("double") / (F.col("_n") - 1).cast("double"))
                         .alias(name))
    return _join_ranks(df, partition_col, order_col, ranks, name)


def _join_ranks(df: DataFrame, partition_col: str, order_col: str, ranks: DataFrame, name: str) -> DataFrame:
    p, v = unused("_p", df.columns), unused("_v", df.columns)
    ranks = ranks.select(F.col("_p").alias(p), F.col("_v").alias(v), name)
    cond = df[partition_col].eqNullSafe(ranks[p]) & df[order_col].eqNullSafe(ranks[v])
    return df.join(ranks, cond, "inner").drop(p, v)


#: Sampled values for each part of a range split.
_SAMPLED = 64


def _n_splits(hist: DataFrame, rows_per_split: int) -> tuple[int, int]:
    """Parts of the largest partition value, by its number of distinct order values, and one in how many of these is sampled."""
    largest = hist.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    splits = max(2, -(-largest // rows_per_split))
    return splits, max(1, largest // (splits * _SAMPLED))


def _split_ranks(hist: DataFrame, descending: bool, name: str, splits: int, sampled: int) -> DataFrame:
    """Exact percent rank from a ``(_p, _v, _c)`` histogram, range-split by value.

    Each partition value gets up to ``splits - 1`` boundaries: approximate quantiles
    (``percentile_approx``, a bounded sketch per group, combined map-side) where the
    type has them, else values from a sample of its distinct ones (one in
    ``sampled`` by hash, about 64 a part); one without a sampled value is small and
    stays whole.  A value's bucket is the number of boundaries below it (equal values share a
    bucket; NULL is bucket -1, which is last in descending and first in
    ascending order, like Spark's default NULL ordering).  The rank is then the
    rows of better buckets (window over at most ``splits`` rows per partition)
    plus the rows ahead inside the bucket (window per ``(partition, bucket)``),
    so a partition value holding a third of the data is spread over ``splits``
    window tasks instead of one.
    """
    if isinstance(hist.schema["_v"].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        cuts = F.percentile_approx("_v", [i / splits for i in range(1, splits)], 10000)
    else:
        chosen = F.col("_v").isNotNull() & (F.pmod(F.xxhash64("_v"), F.lit(sampled)) == 0)
        sample = F.array_sort(F.collect_list(F.when(chosen, F.col("_v"))))
        at = F.sequence(F.lit(1), F.lit(splits - 1))
        cuts = F.when(F.size(sample) == 0, sample).otherwise(F.transform(
            at, lambda i: F.element_at(sample, F.greatest(F.lit(1), F.ceil(i * F.size(sample) / splits).cast("int")))))
    bounds = hist.groupBy(F.col("_p").alias("_bp")).agg(cuts.alias("_bounds"))
    bucket = F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(F.col("_bounds"), lambda b: b < F.col("_v"))))
    bucketed = hist.join(bounds, F.col("_p").eqNullSafe(F.col("_bp"))).select(
        "_p", "_v", "_c", bucket.alias("_b"))
    better = Window.unboundedPreceding, -1
    per_bucket = bucketed.groupBy(F.col("_p").alias("_op"), F.col("_b").alias("_ob")).agg(
        F.sum("_c").alias("_bc"))
    offsets = per_bucket.select(
        "_op", "_ob",
        F.coalesce(F.sum("_bc").over(Window.partitionBy("_op").orderBy(_order("_ob", descending))
                                     .rowsBetween(*better)), F.lit(0)).alias("_off"),
        F.sum("_bc").over(Window.partitionBy("_op")).alias("_n"))
    local = bucketed.select(
        "_p", "_v", "_b",
        F.coalesce(F.sum("_c").over(Window.partitionBy("_p", "_b").orderBy(_order("_v", descending))
                                    .rowsBetween(*better)), F.lit(0)).alias("_in"))
    joined = local.join(offsets, F.col("_p").eqNullSafe(F.col("_op")) & (F.col("_b") == F.col("_ob"))).select(
        "_p", "_v", (F.col("_off") + F.col("_in")).alias("_ahead"), "_n")
    return joined.select("_p", "_v", F.when(F.col("_n") <= 1, F.lit(0.0))
                         .otherwise(F.col("_ahead").cast("double") / (F.col("_n") - 1).cast("double")).alias(name))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """O2: global ``ORDER BY ... LIMIT k`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)
