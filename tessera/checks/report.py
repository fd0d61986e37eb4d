"""Results as tables (D20, D21, IO6, IO7)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.checks import model as m


def summarize(results: DataFrame) -> DataFrame:
    """One row with the passed / failed / error counts."""
    return results.agg(
        F.count_if(F.col("status") == "PASS").cast("bigint").alias("passed"),
        F.count_if(F.col("status") == "FAIL").cast("bigint").alias("failed"),
        F.count_if(F.col("status") == "ERROR").cast("bigint").alias("errors"))


def summary_line(results: DataFrame) -> str:
    """The statuses that occur with their counts, passed ones always."""
    n = {r["status"]: r["n"] for r in results.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = {"PASS": "passed", "FAIL": "failed", "ERROR": "error" if n.get("ERROR") == 1 else "errors"}
    return "  ·  ".join(f"{n.get(status, 0)} {word}" for status, word in words.items() if status == "PASS" or n.get(status))


def check_sql(check: m.Check, source: str, columns: list[str] | None = None, condition: str | None = None) -> str:
    """Re-runnable SQL over a table or view name; returns ``failing_rows``."""
    if check.kind == m.ROW:
        return f"SELECT COUNT(*) AS failing_rows FROM {source} WHERE {condition or check.condition}"
    if check.kind == m.EMPTY:
        return f"SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS failing_rows FROM {source}"
    if check.kind == m.UNIQUE:
        c = m.q(check.column)
        return (f"SELECT COALESCE(SUM(_cnt - 1), 0) AS failing_rows FROM "
                f"(SELECT {c}, COUNT(*) AS _cnt FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})")
    if check.kind == m.DUPLICATES:
        cols = ", ".join(m.q(c) for c in (columns or []))
        return (f"SELECT COUNT(*) AS failing_rows FROM (SELECT {cols}, COUNT(*) AS _cnt "
                f"FROM {source} GROUP BY {cols} HAVING COUNT(*) > 1)")
    if check.kind == m.REFERENCE:
        c, (table, known) = m.q(check.column), check.reference
        return (f"SELECT COALESCE(SUM(n), 0) AS failing_rows FROM (SELECT {c} AS v, COUNT(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) "
                f"LEFT ANTI JOIN (SELECT {m.q(known)} AS known FROM {table}) ON v = known")
    raise ValueError(check.kind)


def export_checks(spark, checks: list[m.Check], results: DataFrame | None, source: str,
                  df: DataFrame) -> DataFrame:
    """IO6: approved checks with reason, type, column, SQL and last-run status.

    ``sql`` runs with ``spark.sql`` against ``source``; the table can be
    written anywhere (``df.write.saveAsTable``) and re-run later.  ``df`` is
    what was checked: range checks compare with a zero of the column's type.
    """
    from tessera.checks.run import condition_for

    rows = [(i + 1, c.name, c.column or "(table-level)", c.test_type, c.reason,
             check_sql(c, source, df.columns, condition_for(df, c) if c.kind == m.ROW else None))
            for i, c in enumerate(checks)]
    defs = spark.createDataFrame(rows, "position int, name string, column string, test_type string, "
                                       "reason string, sql string")
    if results is None:
        return defs.withColumn("last_run", F.lit(None).cast("string"))
    last = results.select("name", F.when(F.col("status") == "PASS", F.lit("PASS"))
                          .when(F.col("status") == "ERROR", F.concat(F.lit("ERROR — "), F.col("error")))
                          .otherwise(F.concat(F.lit("FAIL — "), F.col("failing_rows").cast("string"),
                                              F.lit(" failing row(s)"))).alias("last_run"))
    return defs.join(last, "name", "left").orderBy("position")


def rerun_exported(spark, exported: DataFrame) -> DataFrame:
    """Run every exported SQL text again (one small job per check)."""
    rows = []
    for r in exported.select("position", "name", "sql").orderBy("position").collect():
        try:
            rows.append((r["position"], r["name"], int(spark.sql(r["sql"]).first()[0]), None))
        except Exception as exc:
            rows.append((r["position"], r["name"], None, str(exc).splitlines()[0][:500]))
    return spark.createDataFrame(rows, "position int, name string, failing_rows bigint, error string")


def append_results(results: DataFrame, path: str, run_id: str, source: str) -> str:
    """Store one run's results in a history table (parquet, partitioned by run and source).

    A retry of the same run replaces what the run stored before.
    """
    (results.withColumn("run_id", F.lit(run_id)).withColumn("source", F.lit(source))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "source").parquet(path))
    return path


def summary_by_run(history: DataFrame) -> DataFrame:
    """D21 over the history table: checks per run, source and status."""
    return history.groupBy("run_id", "source", "status").agg(F.count(F.lit(1)).alias("checks"))


def checks_sql_text(exported: DataFrame) -> DataFrame:
    """IO6 as text: a check is one comment line (its number, name and the rest as JSON) and its statement."""
    about = F.to_json(F.struct("column", "test_type", "reason", F.coalesce("last_run", F.lit("not run")).alias("last_run")))
    line = F.concat(F.format_string("-- [%2d] %s ", "position", "name"), about, F.lit("\n"), F.col("sql"), F.lit(";\n"))
    return exported.orderBy("position").select(line.alias("value"))


def source_header(source: str, definition: str | None, created: str) -> str:
    """What makes the text run later: the view of the checked query, or where it must come from."""
    made = f"CREATE OR REPLACE TEMPORARY VIEW {m.q(source)} AS\n{definition.strip().rstrip(';')}\n;" if definition else \
        f"-- needs a table or view {source}"
    return f"-- Checks of {source}, written {created}\n{made}\n"


def write_checks_sql(exported: DataFrame, path: str, source: str, definition: str | None = None, created: str = "") -> str:
    """Write the exported checks as one SQL text file (the table is tiny).

    ``definition`` is the query that was checked; the file then starts with it
    as a view, so the statements run without anything of this session.
    """
    spark = exported.sparkSession
    lines = [source_header(source, definition, created), *(r["value"] for r in checks_sql_text(exported).collect())]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


#: What a semicolon may stand in without ending a statement: literals, quoted names, comments.
_QUOTED = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/)|;""", re.S)


def statements(text: str) -> list[str]:
    """The statements of a text; semicolons within literals, names and comments end none."""
    out, start = [], 0
    for m in _QUOTED.finditer(text):
        if m[1] is None:
            out.append(text[start:m.start()])
            start = m.end()
    out.append(text[start:])
    return [x.strip() for x in out if _QUOTED.sub(lambda m: "" if (m[1] or "")[:2] in ("--", "/*") else m[0], x).strip()]


def run_sql_text(spark, text: str) -> list[int]:
    """Run a file written by :func:`write_checks_sql`; the counts of its checks in order."""
    results = [spark.sql(statement) for statement in statements(text)]
    return [int(out.first()[0]) for out in results if out.columns]
