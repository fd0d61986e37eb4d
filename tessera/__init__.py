"""tessera: Spark-native analytical reports and distributed data-quality checks.

Sub-packages
------------
sources    table scans, CSV, view registration, sinks, derived test views
functions  predicate builders and scalar helpers (pure ``Column`` expressions)
operators  joins, rollups, windows, top-k, profiling, incremental merge
checks     check model, suggestion rules, fused distributed runner, reports
plans      composite reports and the query catalog used by ``__spark_entry__``
streaming  micro-batch check runner (``foreachBatch``)
"""

from tessera.checks.report import export_checks, summarize, summary_line, write_checks_sql
from tessera.checks.rules import select_checks, suggest_checks
from tessera.checks.run import auto_check, run_checks
from tessera.session import checkpoint_dir, get_spark, size_shuffle_partitions

__all__ = ["get_spark", "checkpoint_dir", "size_shuffle_partitions", "suggest_checks", "select_checks",
           "run_checks", "auto_check", "summarize", "summary_line", "export_checks", "write_checks_sql"]
