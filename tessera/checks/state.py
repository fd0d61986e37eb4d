"""Checks of a partitioned table that read changed partitions only (D19, IO7).

What a check has found in one partition folder is kept as a state that merges:
a count for row-level checks, and a count of each value's SHA-256 for checks
that compare rows of several partitions (uniqueness, repeated rows, accepted
values).  A state belongs to the files it was taken from: their names, sizes and
times of change make the folder's signature.  The next run lists the files,
reads the folders whose signature has no state, and merges theirs with the rest.

Three folders below ``state_path`` hold it, each run a sub-folder of its own:
``counts``, ``values`` and, written last, ``known`` (which folder, check and
signature a run has finished).  Rows that ``known`` does not name are never read,
so a run may be stopped anywhere and two runs may write at once.

Results equal those of :func:`tessera.checks.run.run_checks` over the table.
Nulls, empty folders and repeated rows count as there.  Folders that are gone
leave the result with their files.  Uniqueness and repeated rows need columns
without nested types; a reference table must have the type of the column.  Other
checks are an ERROR of their own.  What reaches the driver is a row for each
changed folder and for each check.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from urllib.parse import unquote

from pyspark.errors import (AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException,
                            IllegalArgumentException, NumberFormatException, SparkRuntimeException)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.checks import model as m
from tessera.checks.run import condition_for, results_frame, validate_checks
from tessera.functions.names import q, unused
from tessera.operators.duplicates import as_text, stackable
from tessera.sources.sinks import materialize

COUNTS = "part string, key string, n bigint, batch string"
VALUES = "part string, key string, digest binary, n bigint, batch string"
KNOWN = "part string, key string, signature string, batch string"
#: Errors of the data or of the analyser, as opposed to faults of the cluster.
DATA_ERRORS = (AnalysisException, ArithmeticException, NumberFormatException, IllegalArgumentException,
               DateTimeException, ArrayIndexOutOfBoundsException, SparkRuntimeException)


def folder_of(file_path: str = "file_path") -> Column:
    return F.regexp_extract(file_path, r"^(.*)/[^/]*$", 1)


def folder_signatures(spark: SparkSession, path: str) -> DataFrame:
    """``part`` (folder), ``signature``: one row for each folder that holds files of the table; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        "_metadata.file_path", F.col("_metadata.file_size").alias("size"), F.unix_micros("_metadata.file_modification_time").alias("changed"))
    made = [F.sum(F.xxhash64(F.lit(i), "file_path", "size", "changed").cast("decimal(38,0)")).cast("string") for i in range(2)]
    return files.groupBy(folder_of().alias("part")).agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), *made).alias("signature"))


def state_key(table: DataFrame, check: m.Check) -> str:
    """Names what a check keeps: checks that need the same counts share them, a changed condition or type needs new ones."""
    types = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    if check.kind in (m.UNIQUE, m.REFERENCE):
        what = ["values", check.column, types.get(check.column)]
    elif check.kind == m.DUPLICATES:
        what = ["rows", types]
    elif check.kind == m.EMPTY:
        what = ["size"]
    else:
        what = ["condition", condition_for(table, check), {c: types.get(c) for c in check.columns}]
    return hashlib.sha256(json.dumps(what).encode()).hexdigest()


def value_digest(table: DataFrame, column: str) -> Column:
    """SHA-256 of a value; NULL of NULL."""
    return F.sha2(as_text(F.col(q(column)), table.select(q(column)).schema[0].dataType).cast("binary"), 256)


def row_digest(table: DataFrame) -> Column:
    """SHA-256 of a whole row; NULL equals NULL."""
    return F.sha2(F.concat_ws(",", *[F.coalesce(value_digest(table, f.name), F.lit("-")) for f in table.schema.fields]).cast("binary"), 256)


def _state_errors(table: DataFrame, check: m.Check) -> str | None:
    kinds = {f.name: f.dataType for f in table.schema.fields}
    if check.kind in (m.UNIQUE, m.REFERENCE, m.DUPLICATES):
        read = list(kinds) if check.kind == m.DUPLICATES else [check.column]
        nested = [c for c in read if c not in kinds or not stackable(kinds[c])]
        if nested:
            return f"no state is kept for the columns {nested}"
    if check.kind == m.REFERENCE:
        name, column = check.reference
        try:
            known = table.sparkSession.table(name).select(q(column)).schema[0].dataType
        except AnalysisException as exc:
            return str(exc).splitlines()[0][:500]
        if known != kinds[check.column]:
            return f"'{column}' of '{name}' has type {known.simpleString()}, '{check.column}' has {kinds[check.column].simpleString()}"
    return None


def _read_state(spark: SparkSession, state_path: str, name: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(f"{state_path.rstrip('/')}/{name}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _write_state(rows: DataFrame, state_path: str, name: str, batch: str) -> None:
    rows.write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/{name}/batch={batch}")


def _current(spark: SparkSession, state_path: str, now: DataFrame) -> DataFrame:
    """``part``, ``key``, ``batch``: the one run whose state counts for each folder as it is now."""
    known = _read_state(spark, state_path, "known", KNOWN)
    return known.join(now, ["part", "signature"], "left_semi").groupBy("part", "key").agg(F.max("batch").alias("batch"))


def _missing(now: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    wanted = now.select("part", "signature", F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))
    return wanted.join(known, ["part", "signature", "key"], "left_anti")


def changed_rows(spark: SparkSession, path: str, parts: list[str], schema: StructType) -> tuple[DataFrame, str]:
    """The rows of the named folders and the name of the column that holds each row's folder."""
    read = spark.read.schema(schema).option("basePath", path).parquet(*[unquote(p) for p in parts])
    part = unused("_part", read.columns)
    return read.withColumn(part, folder_of("_metadata.file_path")), part


def _take_counts(rows: DataFrame, part: str, wanted: dict[str, m.Check]) -> DataFrame:
    aggs = [F.count(F.lit(1)) if c.kind == m.EMPTY else F.count_if(F.expr(condition_for(rows, c))) for c in wanted.values()]
    names = [f"n{i}" for i in range(len(aggs))]
    per_part = rows.groupBy(F.col(part).alias("part")).agg(*[a.alias(n) for a, n in zip(aggs, names, strict=True)])
    return per_part.select("part", F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(n).alias("n")) for k, n in zip(wanted, names, strict=True)])))


def _take_values(rows: DataFrame, part: str, wanted: dict[str, m.Check]) -> DataFrame:
    table = rows.drop(part)
    made = [F.struct(F.lit(k).alias("key"), (row_digest(table) if c.kind == m.DUPLICATES else value_digest(table, c.column)).alias("digest"))
            for k, c in wanted.items()]
    stacked = rows.select(F.col(part).alias("part"), F.inline(F.array(*made))).filter("digest IS NOT NULL")
    return stacked.groupBy("part", "key", F.unhex("digest").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


def update_state(spark: SparkSession, path: str, checks: list[m.Check], state_path: str, schema: StructType,
                 now: DataFrame) -> dict[str, str]:
    """Read the folders whose state is missing and store it; the error text of each state key that the data reject."""
    table = spark.read.schema(schema).parquet(path)
    by_key = {state_key(table, c): c for c in checks}
    if not by_key:
        return {}
    missing = _missing(now, _read_state(spark, state_path, "known", KNOWN), list(by_key))
    parts, keys = set(), set()
    for row in missing.groupBy("part").agg(F.collect_set("key").alias("keys")).collect():
        parts.add(row["part"])
        keys.update(row["keys"])
    if not parts:
        return {}
    rows, part = changed_rows(spark, path, sorted(parts), schema)
    wanted = {k: c for k, c in by_key.items() if k in keys}
    counted = {k: c for k, c in wanted.items() if c.kind in (m.ROW, m.EMPTY)}
    valued = {k: c for k, c in wanted.items() if k not in counted}
    batch, errors = uuid.uuid4().hex, {}
    if counted:
        try:
            _write_state(_take_counts(rows, part, counted), state_path, "counts", batch)
        except DATA_ERRORS:
            for k, c in counted.items():  # which one is it
                try:
                    _take_counts(rows, part, {k: c}).agg(F.sum("n")).collect()
                except DATA_ERRORS as exc:
                    errors[k] = str(exc).strip().splitlines()[0][:500]
            if not errors:
                raise
            counted = {k: c for k, c in counted.items() if k not in errors}
            if counted:
                _write_state(_take_counts(rows, part, counted), state_path, "counts", batch)
    if valued:
        _write_state(_take_values(rows, part, valued), state_path, "values", batch)
    done = [k for k in wanted if k not in errors]
    if done:
        _write_state(missing.filter(F.col("key").isin(done)).select("part", "key", "signature"), state_path, "known", batch)
    return errors


def recheck(spark: SparkSession, path: str, checks: list[m.Check], state_path: str, schema: StructType | None = None) -> DataFrame:
    """Run ``checks`` on the parquet table at ``path``, reading only folders that have changed since ``state_path`` was written.

    Returns what :func:`run_checks` returns.  ``schema`` is needed only for a
    table that may hold no file at all.
    """
    schema = schema or spark.read.parquet(path).schema
    table = spark.read.schema(schema).parquet(path)
    errors = validate_checks(table, checks)
    for i, c in enumerate(checks):
        if i not in errors and (e := _state_errors(table, c)) is not None:
            errors[i] = e
    sound = [c for i, c in enumerate(checks) if i not in errors]
    now = materialize(folder_signatures(spark, path), "folder-signatures")
    rejected = update_state(spark, path, sound, state_path, schema, now)

    current = _current(spark, state_path, now)
    counts = _read_state(spark, state_path, "counts", COUNTS).join(current, ["part", "key", "batch"], "left_semi")
    totals = {r["key"]: int(r["n"]) for r in counts.groupBy("key").agg(F.sum("n").alias("n")).collect()}
    values = _read_state(spark, state_path, "values", VALUES).join(current, ["part", "key", "batch"], "left_semi").groupBy("key", "digest").agg(F.sum("n").alias("n"))
    keys = {i: state_key(table, c) for i, c in enumerate(checks) if i not in errors}
    repeats = {}
    if any(checks[i].kind in (m.UNIQUE, m.DUPLICATES) for i in keys):
        found = values.groupBy("key").agg(F.sum(F.col("n") - 1).alias("excess"), F.count_if(F.col("n") > 1).alias("repeated"))
        repeats = {r["key"]: r for r in found.collect()}

    outcome: dict[int, tuple[int | None, str | None]] = {}
    for i, c in enumerate(checks):
        key = keys.get(i)
        if key is None or key in rejected:
            outcome[i] = (None, errors.get(i) or rejected[key])
        elif c.kind == m.EMPTY:
            outcome[i] = (0 if totals.get(key) else 1, None)
        elif c.kind == m.ROW:
            outcome[i] = (totals.get(key, 0), None)
        elif c.kind == m.REFERENCE:
            name, column = c.reference
            source = spark.table(name)
            accepted = source.select(F.unhex(value_digest(source, column)).alias("digest"))
            outside = values.filter(F.col("key") == key).join(accepted, "digest", "left_anti")
            outcome[i] = (int(outside.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]), None)
        else:
            row = repeats.get(key)
            outcome[i] = (0 if row is None else int(row["excess" if c.kind == m.UNIQUE else "repeated"]), None)
    return results_frame(spark, checks, outcome)


def compact_state(spark: SparkSession, path: str, state_path: str, new_path: str) -> str:
    """Copy what counts for the table as it is now into a fresh folder, without states of replaced files."""
    now = materialize(folder_signatures(spark, path), "folder-signatures")
    current = _current(spark, state_path, now)
    batch = uuid.uuid4().hex
    for name, schema in (("counts", COUNTS), ("values", VALUES)):
        rows = _read_state(spark, state_path, name, schema).join(current, ["part", "key", "batch"], "left_semi")
        _write_state(rows.drop("batch"), new_path, name, batch)
    _write_state(current.join(now, "part").select("part", "key", "signature"), new_path, "known", batch)
    return new_path
