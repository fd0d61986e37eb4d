"""Sinks (IO5, IO7) and lineage cuts.

Intermediate tables are written under the session's ``spark.checkpoint.dir``
(a shared folder on a cluster), never to a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import checkpoint_dir


#: Scratch folders of this process that :func:`drop_scratch` deletes.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint directory."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def scratch_mark() -> int:
    """A point in time for :func:`drop_scratch`."""
    return len(_scratch)


def drop_scratch(spark: SparkSession, since: int = 0, keep_last: bool = False) -> int:
    """Delete every scratch folder that this process has written so far (after the mark ``since``); their number.

    Lazy results read their stages from there, so call it once a job's results
    are written elsewhere, or with ``keep_last`` in the folder written last.
    """
    until = len(_scratch) - keep_last
    paths = _scratch[since:until]
    del _scratch[since:until]
    for path in paths:
        drop_path(spark, path)
    return len(paths)


def write_table(df: DataFrame, path_or_table: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """IO5: ``CREATE TABLE ... AS SELECT`` as a DataFrame write.

    A name without a slash is a catalog table (``saveAsTable``); anything else
    is a path.  With ``partition_by`` and mode ``overwrite`` only the written
    partitions are replaced (dynamic partition overwrite).
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if "/" in path_or_table:
        writer.save(path_or_table)
    else:
        writer.saveAsTable(path_or_table)
    return path_or_table


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote below the checkpoint directory."""
    if not path.startswith(checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"not below the checkpoint directory: {path}")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - public py4j gateway
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)  # noqa: SLF001


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Survives executor loss (unlike a local checkpoint) and lets later stages
    restart from the written files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
