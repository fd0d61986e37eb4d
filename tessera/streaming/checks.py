"""Checks on streams.

The reference runs its checks on tables; on a stream the same checks apply
per micro-batch or per event-time window:

* ``check_each_batch`` runs the full ``run_checks`` (row-level, uniqueness
  and duplicates) on every micro-batch through ``foreachBatch``.  Results are
  written per ``batch_id`` partition with dynamic overwrite, so a batch that
  is replayed after a failure replaces its own rows instead of duplicating
  them.
* ``windowed_violation_counts`` keeps only row-level checks and turns them
  into a stateful windowed aggregate with a watermark: one row per window with
  the row count and one violation count per check (append mode emits a
  window once the watermark passes its end).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.checks import model as M
from tessera.checks.run import condition_for, run_checks, validate_checks


def write_batch_results(batch: DataFrame, batch_id: int, checks: list[M.Check], results_path: str,
                        source: str = "stream") -> None:
    """Check one micro-batch, read once, and (over)write its ``batch_id`` partition."""
    res = (run_checks(batch, checks, persist=True)
           .withColumn("source", F.lit(source))
           .withColumn("batch_id", F.lit(batch_id).cast("bigint")))
    (res.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(results_path))


def check_each_batch(stream: DataFrame, checks: list[M.Check], results_path: str, *,
                     checkpoint_location: str, source: str = "stream",
                     trigger: dict | None = None) -> StreamingQuery:
    """Start a query that checks every micro-batch and stores the results.

    ``checkpoint_location`` belongs to ``results_path``: a restart with the same
    one goes on with the next batch number, while a new one would count from
    zero and overwrite what earlier batches stored.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch_results(batch, batch_id, checks, results_path, source)

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint_location))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def windowed_violation_counts(stream: DataFrame, checks: list[M.Check], ts: str, window: str,
                              watermark: str) -> DataFrame:
    """Per event-time window: rows and violations of each row-level check.

    A check that can't run on the stream's columns has NULL counts; the others
    are not affected.
    """
    row_checks = [c for c in checks if c.kind == M.ROW]
    if len(row_checks) != len(checks):
        raise ValueError("only row-level checks can run as a windowed stream aggregate")
    aggs = [F.count(F.lit(1)).alias("rows")]
    errors = validate_checks(stream, row_checks)
    aggs += [(F.lit(None).cast("bigint") if i in errors else F.count_if(F.expr(condition_for(stream, c)))).alias(c.name)
             for i, c in enumerate(row_checks)]
    if stream.schema[ts].dataType.simpleString() == "timestamp_ntz":
        # watermarks need TIMESTAMP; the wall-clock value is UTC
        stream = stream.withColumn(ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone()))
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(F.col(ts), window).alias("window"))
            .agg(*aggs))
