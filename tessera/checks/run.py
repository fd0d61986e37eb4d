"""Distributed check runner.

``run_checks`` replaces "one query per check, each re-running the source":

* every row-level check (NOT NULL, formats, ranges, cross-column, ...) and the
  empty-input check become ``count_if`` aggregates of **one** ``df.agg`` -
  one scan of the source, one tiny shuffle, whatever the number of checks;
* all uniqueness checks together are one pass over stacked (column, hash)
  pairs, and a second one over the columns wider than 64 bits whose hashes repeat, never several
  ``COUNT(DISTINCT)`` in one select (which would ``Expand`` every row);
* the duplicate-row check groups 64-bit row hashes first; only rows whose hash
  may repeat are shuffled whole;
* accepted values of a reference table are an anti-join of partial counts;
* grouped passes are independent jobs submitted concurrently.

Error isolation: every check is analysed on its own before anything runs (an
unknown or ambiguous column, or a range check on a non-numeric column, turns
into an ERROR result for that check only).  If the fused job still fails at
run time, its checks are re-run one by one so only the guilty check is ERROR.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import (AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException,
                            IllegalArgumentException, NumberFormatException, SparkRuntimeException)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DayTimeIntervalType, NumericType, YearMonthIntervalType

from tessera.checks import model as m
from tessera.operators.duplicates import excess_copies_of, stackable, suspect_rows
from tessera.operators.rollups import excess_copies


def _first_line(exc: BaseException) -> str:
    text = str(exc).strip() or exc.__class__.__name__
    return text.splitlines()[0][:500]


def _schema_errors(df: DataFrame, check: m.Check) -> str | None:
    """Column existence, ambiguity and type gates, from the schema alone."""
    fields = df.schema.fields
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    fold = (lambda x: x) if case_sensitive else str.lower
    for c in check.columns:
        hits = [f for f in fields if fold(f.name) == fold(c)]
        if not hits:
            return f"[UNRESOLVED_COLUMN] column '{c}' is not in the input {[f.name for f in fields]}"
        if len(hits) > 1:
            return f"[AMBIGUOUS_REFERENCE] column '{c}' appears {len(hits)} times in the input"
        dt = hits[0].dataType
        if check.needs_numeric and not isinstance(dt, (NumericType, DayTimeIntervalType, YearMonthIntervalType)):
            return f"column '{c}' has type {dt.simpleString()}, a range check needs a numeric column"
    if check.kind == m.DUPLICATES:
        names = [fold(f.name) for f in fields]
        dupes = sorted({n for n in names if names.count(n) > 1})
        if dupes:
            return f"[AMBIGUOUS_REFERENCE] duplicate output columns {dupes}"
    return None


def _analysis_error(df: DataFrame, check: m.Check) -> str | None:
    try:
        df.select(F.expr(condition_for(df, check)).alias("_probe"))
    except Exception as exc:  # AnalysisException and friends
        return _first_line(exc)
    return None


def validate_checks(df: DataFrame, checks: list[m.Check]) -> dict[int, str]:
    """Error text per check index for checks that cannot run on ``df``.

    Schema gates first; then all row-level conditions are analysed in one
    ``select`` and only if that fails is each one analysed alone, so a wide
    table with hundreds of valid checks costs one analyzer call.
    """
    errors = {i: e for i, c in enumerate(checks) if (e := _schema_errors(df, c)) is not None}
    rows = [(i, c) for i, c in enumerate(checks) if c.kind == m.ROW and i not in errors]
    if rows:
        try:
            df.select(*[F.expr(condition_for(df, c)).alias(f"_p{i}") for i, c in rows])
        except Exception:
            for i, c in rows:
                if (e := _analysis_error(df, c)) is not None:
                    errors[i] = e
    return errors


def count_duplicate_rows(df: DataFrame, strategy: str = "hashed") -> int:
    """Number of distinct full-row values that occur more than once.

    ``direct``: one grouping by all columns.  ``hashed`` (default): hashes of
    the rows are grouped first, and only rows whose hash may repeat travel to the
    exact grouping (:mod:`tessera.operators.duplicates`).  NULL equals NULL in
    both (grouping semantics).  Column names of the input are never used for
    computed columns.
    """
    fields = df.schema.fields
    names = [f"c{i}" for i in range(len(fields))]
    rows = df.toDF(*names)
    # nested types (maps cannot be hashed at all) group directly
    if strategy == "hashed" and all(stackable(f.dataType) for f in fields):
        rows = suspect_rows(rows)
        if rows is None:
            return 0
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count()


def condition_for(df: DataFrame, check: m.Check) -> str:
    """The check's condition, with the zero of a range check typed like the column.

    ``date - date`` is an interval in Spark, and an interval only compares
    with an interval zero.
    """
    cond = check.condition
    if check.needs_numeric and check.columns:
        target = check.columns[0].lower()
        hits = [f for f in df.schema.fields if f.name.lower() == target]
        if len(hits) != 1:
            return cond
        dt = hits[0].dataType
        zero = ("INTERVAL '0' SECOND" if isinstance(dt, DayTimeIntervalType)
                else "INTERVAL '0' MONTH" if isinstance(dt, YearMonthIntervalType) else None)
        if zero is not None:
            cond = cond.replace("< 0", f"< {zero}")
    return cond


def fused_aggregate(df: DataFrame, items: list[tuple[int, m.Check]]) -> DataFrame:
    """One-row aggregate holding ``_rows`` and one ``_c<i>`` count per row check."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.expr(condition_for(df, c))).alias(f"_c{i}") for i, c in items if c.kind == m.ROW]
    return df.agg(*aggs)


def _run_grouped(df: DataFrame, check: m.Check, duplicates: str) -> int:
    if check.kind == m.UNIQUE:
        return int(excess_copies(df, check.column).first()["failing_rows"])
    if check.kind == m.DUPLICATES:
        return int(count_duplicate_rows(df, duplicates))
    if check.kind == m.REFERENCE:
        return not_in_reference(df, check)
    raise ValueError(check.kind)


def not_in_reference(df: DataFrame, check: m.Check) -> int:
    """E4 against a table: rows whose value is not NULL and not in it.

    Values are counted before they meet the table, so a value that a third of
    all rows hold is one row a task; the planner chooses the join by size.
    """
    table, column = check.reference
    known = df.sparkSession.table(table).select(F.col(m.q(column)).alias("known"))
    counts = df.select(F.col(m.q(check.column)).alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    outside = counts.join(known, F.col("value") == F.col("known"), "left_anti")
    return int(outside.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])


def run_checks(df: DataFrame, checks: list[m.Check], *, duplicates: str = "hashed",
               max_parallel: int = 4, materialize: bool = False, persist: bool = False) -> DataFrame:
    """Run ``checks`` on ``df``; returns the results DataFrame (RESULT_SCHEMA).

    When more than one job will read ``df`` (fused pass + grouped passes) and
    ``df`` is an expensive query result rather than a table scan:
    ``materialize=True`` writes it once to the shared checkpoint folder (a
    lineage cut that survives executor loss), ``persist=True`` caches it
    (MEMORY_AND_DISK, recomputed from lineage if an executor is lost) and
    unpersists it before returning.
    """
    if df.isStreaming:
        raise ValueError("run_checks needs a batch DataFrame; use tessera.streaming.checks for streams")
    kinds = {c.kind for c in checks}
    several_passes = bool(kinds - {m.ROW, m.EMPTY}) and len(checks) > 1
    if materialize and several_passes:
        from tessera.sources.sinks import drop_path, scratch_path

        path = scratch_path(df.sparkSession, "checked-input")
        df.write.parquet(path)
        try:
            return _run_checks(df.sparkSession.read.parquet(path), checks, duplicates, max_parallel)
        finally:
            drop_path(df.sparkSession, path)
    elif persist and several_passes and not (df.storageLevel.useMemory or df.storageLevel.useDisk):
        from pyspark import StorageLevel

        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # the results are built from collected counts, so the cache can go
            return _run_checks(cached, checks, duplicates, max_parallel)
        finally:
            cached.unpersist()
    return _run_checks(df, checks, duplicates, max_parallel)


def results_frame(spark: SparkSession, checks: list[m.Check], outcome: dict[int, tuple[int | None, str | None]]) -> DataFrame:
    """RESULT_SCHEMA rows of the checks; ``outcome`` holds (failing rows, error) by index."""
    rows = []
    for i, c in enumerate(checks):
        failing, error = outcome[i]
        passed = error is None and failing == 0
        status = "ERROR" if error is not None else ("PASS" if passed else "FAIL")
        rows.append((i + 1, c.name, c.column, c.test_type, c.reason, failing, passed, error, status))
    return spark.createDataFrame(rows, m.RESULT_SCHEMA)


def _run_checks(df: DataFrame, checks: list[m.Check], duplicates: str, max_parallel: int) -> DataFrame:
    spark = df.sparkSession
    outcome: dict[int, tuple[int | None, str | None]] = {}
    fused: list[tuple[int, m.Check]] = []
    grouped: list[tuple[int, m.Check]] = []
    errors = validate_checks(df, checks)
    for i, c in enumerate(checks):
        if i in errors:
            outcome[i] = (None, errors[i])
        elif c.kind in (m.ROW, m.EMPTY):
            fused.append((i, c))
        else:
            grouped.append((i, c))

    def run_fused(items: list[tuple[int, m.Check]]) -> None:
        row = fused_aggregate(df, items).first()
        for i, c in items:
            if c.kind == m.EMPTY:
                outcome[i] = (1 if row["_rows"] == 0 else 0, None)
            else:
                outcome[i] = (int(row[f"_c{i}"]), None)

    def run_one_grouped(item: tuple[int, m.Check]) -> tuple[int, tuple[int | None, str | None]]:
        i, c = item
        try:
            return i, (_run_grouped(df, c, duplicates), None)
        except Exception as exc:
            return i, (None, _first_line(exc))

    kinds = {f.name: f.dataType for f in df.schema.fields}
    together = [(i, c) for i, c in grouped if c.kind == m.UNIQUE and c.column in kinds and stackable(kinds[c.column])]
    together = together if len(together) > 1 else []

    def run_together() -> list[tuple[int, tuple[int | None, str | None]]]:
        try:
            found = excess_copies_of(df, list(dict.fromkeys(c.column for _, c in together)))
            return [(i, (found[c.column], None)) for i, c in together]
        except Exception:  # a check the data rejects: each one alone
            return [run_one_grouped(it) for it in together]

    alone = [it for it in grouped if it not in together]
    pool = ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(grouped)))) if grouped else None
    futures = [pool.submit(run_one_grouped, it) for it in alone] if pool else []
    stacked = pool.submit(run_together) if together else None
    try:
        if fused:
            try:
                run_fused(fused)
            except (AnalysisException, ArithmeticException, NumberFormatException, IllegalArgumentException,
                    DateTimeException, ArrayIndexOutOfBoundsException, SparkRuntimeException):
                # A check the data or the analyser rejects: re-run each one alone.
                # Faults of the cluster are not a check's result and are raised.
                for item in fused:
                    try:
                        run_fused([item])
                    except Exception as exc:
                        outcome[item[0]] = (None, _first_line(exc))
        for fut in futures:
            i, res = fut.result()
            outcome[i] = res
        outcome.update(stacked.result() if stacked else [])
    finally:
        if pool:
            pool.shutdown(wait=True)

    return results_frame(spark, checks, outcome)


def auto_check(df: DataFrame, only: list[str] | None = None, skip: list[str] | None = None,
               **kwargs) -> DataFrame:
    """D8 + D18 + D19: suggest checks from the schema, select, run."""
    from tessera.checks.rules import select_checks, suggest_checks

    chosen, _ = select_checks(suggest_checks(df), only=only, skip=skip)
    return run_checks(df, chosen, **kwargs)
