"""Versioned tables for incremental loads that may be stopped anywhere.

A table is a folder of data folders, one for each *slice* (a hash of the
partition column's value), and of manifests, one for each version.  A manifest
names the data folders that make up its version and stores the greatest time
that was loaded.  A merge writes new folders for the slices it touches and only
then a manifest, created under the next number and never over another: readers
see the version before or the version after, a load that dies leaves nothing but
unnamed folders (``vacuum`` deletes them), and of two writers one fails.

A *locator* table, kept in slices of the key's hash, says where each key lives.
The rows of a key that changes its partition are found by it, so the old version
goes with the merge that brings the new one.  Only the slices that the delta
names or its keys live in are read and written again.

Rows of the delta win ties of time, an older row does not replace a newer one,
and merging a delta twice changes nothing.  Rows whose key is NULL are a key of
their own.  An empty delta makes a version of the same rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tessera.functions.names import q
from tessera.operators.incremental import _like_target, merge_latest
from tessera.sources.sinks import materialize

_SLICE = "__slice"


class VersionConflict(RuntimeError):
    """Another writer has committed the version that this one was to become."""


@dataclass
class Manifest:
    version: int
    key: list[str]
    ts: str
    partition: str
    slices: int
    schema: dict
    high_water_mark: str | None = None
    data: dict[str, str] = field(default_factory=dict)
    locator: dict[str, str] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - public py4j gateway
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where  # noqa: SLF001


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n[1:-5]) for n in _names(spark, f"{path}/manifests") if n.startswith("v") and n.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The manifest of ``version``, by default of the last one that was written whole."""
    for v in sorted(_versions(spark, path), reverse=True) if version is None else [version]:
        text = spark.read.text(f"{path}/manifests/v{v:010d}.json", wholetext=True).first()
        try:
            return Manifest(**json.loads(text["value"]))
        except (TypeError, ValueError):  # its writer died while writing it
            continue
    raise FileNotFoundError(f"no version of a table at {path}")


def _commit(spark: SparkSession, path: str, m: Manifest) -> Manifest:
    files, where = _hadoop(spark, f"{path}/manifests/v{m.version:010d}.json")
    try:
        out = files.create(where, False)
    except Exception as exc:
        raise VersionConflict(f"version {m.version} of {path} is there already") from exc
    out.write(bytearray(json.dumps(m.__dict__).encode()))
    out.close()
    return m


def _slice(values: list[Column], slices: int) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(slices)).cast("int")


def _write(rows: DataFrame, path: str, kind: str) -> dict[str, str]:
    """Writes ``rows`` by their slice; the folder of each."""
    spark, folder = rows.sparkSession, f"{kind}/{uuid.uuid4().hex}"
    rows.hint("rebalance", _SLICE).write.partitionBy(_SLICE).parquet(f"{path}/{folder}")
    return {n.partition("=")[2]: f"{folder}/{n}" for n in _names(spark, f"{path}/{folder}") if n.startswith(f"{_SLICE}=")}


def _read(spark: SparkSession, path: str, folders: dict[str, str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in sorted(folders.values())])


def _schema(m: Manifest) -> StructType:
    return StructType.fromJson(m.schema)


def _locator_schema(m: Manifest) -> StructType:
    schema = _schema(m)
    return StructType([*[schema[k] for k in m.key], StructField("lives", IntegerType())])


def _next_version(m: Manifest, path: str, rows: DataFrame, delta: DataFrame, data: dict[str, str], locator: dict[str, str],
                  located: DataFrame | None = None, places: list[int] | None = None) -> Manifest:
    """Writes ``rows`` and their places, and commits them beside the folders that stay (``data``, ``locator``).

    ``located`` are the keys that live in other slices, ``places`` the slices of the locator that are written.
    """
    spark = rows.sparkSession
    staged = materialize(rows.withColumn(_SLICE, _slice([F.col(q(m.partition))], m.slices)), "snapshot-rows")
    made = _write(staged, path, "data")
    keys = staged.select(*[F.col(q(k)) for k in m.key], F.col(_SLICE).alias("lives"))
    keys = (keys if located is None else keys.unionByName(located)).withColumn(_SLICE, _slice([F.col(q(k)) for k in m.key], m.slices))
    found = _write(keys if places is None else keys.filter(F.col(_SLICE).isin(places)), path, "locator")
    known = F.lit(m.high_water_mark).cast(rows.schema[m.ts].dataType)
    newest = delta.agg(F.greatest(F.max(F.col(q(m.ts))), known).cast("string").alias("ts")).first()["ts"]
    return _commit(spark, path, replace(m, high_water_mark=newest, data={**data, **made}, locator={**locator, **found}))


def create(df: DataFrame, path: str, key: list[str], ts: str, partition: str, slices: int = 1024) -> Manifest:
    """The first version: the latest row of each key of ``df``."""
    if _versions(df.sparkSession, path):
        raise VersionConflict(f"there is a table at {path}")
    first = Manifest(1, key, ts, partition, slices, json.loads(df.schema.json()))
    return _next_version(first, path, merge_latest(df.limit(0), df, key, ts), df, {}, {})


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the last."""
    m = manifest(spark, path, version)
    return _read(spark, path, m.data, _schema(m))


def high_water_mark(spark: SparkSession, path: str) -> Column | None:
    """The greatest time loaded, as a literal for a filter on the source; from the manifest, nothing is read."""
    m = manifest(spark, path)
    return None if m.high_water_mark is None else F.lit(m.high_water_mark).cast(_schema(m)[m.ts].dataType)


def merge(delta: DataFrame, path: str, fill_missing: bool = False) -> Manifest:
    """Merges ``delta`` into the last version; the new one."""
    spark = delta.sparkSession
    m = manifest(spark, path)
    schema = _schema(m)
    empty = spark.createDataFrame([], schema)
    delta = materialize(merge_latest(empty, _like_target(empty, delta, fill_missing), m.key, m.ts), "snapshot-delta")
    key = [F.col(q(k)) for k in m.key]
    # at most as many as there are slices
    places = [r[0] for r in delta.select(_slice(key, m.slices)).distinct().collect()]
    located = _read(spark, path, {s: f for s, f in m.locator.items() if int(s) in places}, _locator_schema(m))
    new_keys = delta.select(*[c.alias(f"__k{i}") for i, c in enumerate(key)])
    same = None
    for i, k in enumerate(m.key):
        c = F.col(q(k)).eqNullSafe(F.col(f"__k{i}"))
        same = c if same is None else same & c
    arrives = delta.select(_slice([F.col(q(m.partition))], m.slices).alias("lives"))
    touched = [r[0] for r in located.join(new_keys, same, "left_semi").select("lives").union(arrives).distinct().collect()]
    target = _read(spark, path, {s: f for s, f in m.data.items() if int(s) in touched}, schema)
    rows = merge_latest(target, delta, m.key, m.ts)
    # keys of the locator's slices that live where nothing is read stay as they are
    elsewhere = located.filter(~F.col("lives").isin(touched))
    return _next_version(replace(m, version=max(_versions(spark, path)) + 1), path, rows, delta,
                         {s: f for s, f in m.data.items() if int(s) not in touched},
                         {s: f for s, f in m.locator.items() if int(s) not in places}, elsewhere, places)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes what no one of the last ``keep`` versions names; the number of folders.  Not while a merge runs."""
    versions = sorted(_versions(spark, path), reverse=True)
    kept, seen = set(), 0
    for v in versions:
        if seen == keep:
            break
        try:
            m = manifest(spark, path, v)
        except FileNotFoundError:
            continue
        seen += 1
        kept |= {f.rpartition("/")[0] for f in (*m.data.values(), *m.locator.values())}
    dropped = 0
    files, _ = _hadoop(spark, path)
    for kind in ("data", "locator"):
        for name in _names(spark, f"{path}/{kind}"):
            if f"{kind}/{name}" not in kept:
                files.delete(_hadoop(spark, f"{path}/{kind}/{name}")[1], True)
                dropped += 1
    return dropped
