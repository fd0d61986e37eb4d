"""Incremental load with merge logic.

The latest version of every key is chosen with ``max_by`` in a grouped
aggregate rather than ``row_number()`` over a window: ``max_by`` is combined
map-side, so a key with millions of versions never has to be sorted inside
one task.  Merging a row twice changes nothing, so nothing needs to be left out
to be safe: rows with the same time as the target's newest, late rows and keys
that the target lacks all arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import q, unused


def high_water_mark(target: DataFrame, ts: str):
    """Largest ``ts`` already loaded (None for an empty target)."""
    return target.agg(F.max(F.col(q(ts))).alias("hwm")).first()["hwm"]


def new_rows(source: DataFrame, ts: str, since) -> DataFrame:
    """Rows of ``source`` from ``since`` on, itself included (all if None); rows without a time stay."""
    if since is None:
        return source
    return source.filter((F.col(q(ts)) >= F.lit(since)) | F.col(q(ts)).isNull())


def _like_target(target: DataFrame, delta: DataFrame, fill_missing: bool) -> DataFrame:
    """``delta`` with the columns of ``target``; nothing is dropped in silence."""
    extra = [c for c in delta.columns if c not in target.columns]
    missing = [f for f in target.schema.fields if f.name not in delta.columns]
    if extra or (missing and not fill_missing):
        raise ValueError(f"columns differ: the delta lacks {[f.name for f in missing]} and adds {extra}")
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in missing}
    return delta.select(*[blank.get(c, F.col(q(c))) for c in target.columns])


def merge_latest(target: DataFrame, delta: DataFrame, key: list[str], ts: str, fill_missing: bool = False) -> DataFrame:
    """Union target and delta; keep one row per key: latest ``ts``, delta wins ties.

    Both must have the same columns; with ``fill_missing`` columns that the
    delta lacks are NULL in its rows.
    """
    cols = target.columns
    payload = [c for c in cols if c not in key]
    both = target.select(*[F.col(q(c)) for c in cols])
    delta = _like_target(target, delta, fill_missing)
    if not payload:
        return both.unionByName(delta).distinct()
    src, latest = unused("_src", cols), unused("_latest", cols)
    both = both.withColumn(src, F.lit(0)).unionByName(delta.withColumn(src, F.lit(1)))
    picked = both.groupBy(*[F.col(q(k)) for k in key]).agg(
        F.max_by(F.struct(*[F.col(q(c)) for c in payload]), F.struct(F.col(q(ts)), F.col(src))).alias(latest))
    return picked.select(*[F.col(q(c)) if c in key else F.col(f"{latest}.{q(c)}").alias(c) for c in cols])


def incremental_merge(target: DataFrame, source: DataFrame, key: list[str], ts: str,
                      since=None, fill_missing: bool = False) -> DataFrame:
    """Merge ``source`` into ``target``.

    All rows of ``source`` are merged; a caller who knows that nothing older can
    arrive states it as ``since`` (for example ``high_water_mark`` less the
    greatest delay), and older rows are then not read.
    """
    return merge_latest(target, new_rows(source, ts, since), key, ts, fill_missing)


def merge_into_partitions(target_path: str, delta: DataFrame, key: list[str], ts: str,
                          partition_col: str, fill_missing: bool = False) -> DataFrame:
    """Merge ``delta`` into a parquet table partitioned by ``partition_col``,
    rewriting only the partitions the delta touches.

    ``partition_col`` must not change between versions of a key (e.g. a key
    bucket or a creation date), otherwise an old version would survive in its
    old partition.  The merged partitions are written whole to the shared
    checkpoint folder first, so the table is only touched once the copy is
    complete, and a failed overwrite can be repeated from it; the copy is
    deleted after the overwrite.  Returns the touched partition values, one row
    each.
    """
    from tessera.sources.sinks import drop_path, materialize, scratch_path, write_table

    spark = delta.sparkSession
    part = unused("_part", [*delta.columns, partition_col])
    touched = materialize(delta.select(F.col(q(partition_col)).alias(part)).distinct(), "touched-partitions")
    target = spark.read.parquet(target_path)
    scoped = target.join(touched, target[q(partition_col)].eqNullSafe(touched[part]), "left_semi")
    staged = scratch_path(spark, "merge-stage")
    merge_latest(scoped, delta, key, ts, fill_missing).write.parquet(staged)
    write_table(spark.read.parquet(staged), target_path, mode="overwrite", partition_by=[partition_col])
    drop_path(spark, staged)
    return touched.withColumnRenamed(part, partition_col)
