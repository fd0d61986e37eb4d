"""One call for the whole check flow on a table, for scheduled jobs.

``check_table`` = suggest from the schema -> select by name -> run (one fused
pass + grouped passes) -> append the results to a history table partitioned by
run -> write the approved checks as re-runnable SQL text.  Nothing but the
per-check results (one row per check) reaches the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from tessera.checks.report import append_results, export_checks, write_checks_sql
from tessera.checks.rules import select_checks, suggest_checks
from tessera.checks.run import run_checks
from tessera.functions.names import q


def check_table(spark: SparkSession, df: DataFrame, name: str, *, history_path: str | None = None,
                sql_path: str | None = None, only: list[str] | None = None, skip: list[str] | None = None,
                run_id: str | None = None, materialize: bool = False, definition: str | None = None,
                data_path: str | None = None) -> tuple[DataFrame, str]:
    """Check ``df`` (called ``name`` in the exported SQL).

    ``definition`` is the SQL of ``df``; the exported file starts with it as a view,
    so it runs in any later session.  A frame without SQL text is written to
    ``data_path`` (the folder ``<sql_path>_data`` if not given), its checks run on
    that copy, and the view, made in this session too, reads it.  A retry with the same ``run_id`` replaces
    its results.  Returns ``(results, "Running n of m tests (k skipped)")``.
    """
    chosen, summary = select_checks(suggest_checks(df), only=only, skip=skip)
    if sql_path and definition is None:
        data_path = data_path or f"{sql_path.rstrip('/')}_data"
        df.write.mode("overwrite").parquet(data_path)
        definition = f"TABLE parquet.{q(data_path)}"
        df = spark.read.parquet(data_path)
        df.createOrReplaceTempView(name)
    results = run_checks(df, chosen, materialize=materialize)
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    if history_path:
        append_results(results, history_path, run_id, name)
    if sql_path:
        write_checks_sql(export_checks(spark, chosen, results, name, df), sql_path, name, definition,
                         _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"))
    return results, summary
