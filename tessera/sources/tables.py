"""Named-table scans and view registration (IO1, IO3, IO4)."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

_DATA_SUFFIXES = (".parquet", ".csv", ".json", ".orc")


def scan_table(spark: SparkSession, name_or_path: str, columns: list[str] | None = None) -> DataFrame:
    """IO1: a catalog table by name, or a parquet path.

    Only the requested ``columns`` are selected so the scan's ReadSchema is
    pruned even before Catalyst sees later projections.
    """
    if os.sep in name_or_path or name_or_path.endswith(".parquet"):
        df = spark.read.parquet(name_or_path)
    else:
        df = spark.table(name_or_path)
    return df.select(*columns) if columns else df


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm  # noqa: SLF001 - public py4j gateway, used only for listing
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def _list_dir(spark: SparkSession, data_dir: str) -> list[tuple[str, bool]]:
    """(name, is_directory) of the entries, through the Hadoop FileSystem so
    that any scheme (hdfs://, s3a://, file:) works."""
    jpath, fs = _fs(spark, data_dir)
    if not fs.exists(jpath) or not fs.getFileStatus(jpath).isDirectory():
        raise FileNotFoundError(f"no such folder to register views from: {data_dir}")
    return sorted((st.getPath().getName(), st.isDirectory()) for st in fs.listStatus(jpath))


def _dataset_format(spark: SparkSession, path: str) -> str | None:
    """Format of a directory written by Spark (``part-*.parquet`` etc.), if any."""
    jpath, fs = _fs(spark, path)
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        for ext in _DATA_SUFFIXES:
            if name.endswith(ext) and not name.startswith((".", "_")):
                return ext[1:]
    return None


def register_views(spark: SparkSession, data_dir: str, csv_schemas: dict | None = None) -> dict[str, str]:
    """IO3 + IO4: create-or-replace one temp view per data file, named by stem.

    Parquet / ORC / JSON entries (files, or dataset folders with or without an
    extension in their name) are read natively; CSV
    files are read with a header, using an explicit schema from
    ``csv_schemas[stem]`` when given, else inferred.  A missing directory raises
    ``FileNotFoundError``, two files of one stem or a stem that is no
    identifier ``ValueError``.  Returns ``{view_name: path}``.
    """
    views: list[tuple[str, str, DataFrame]] = []
    for fname, is_dir in _list_dir(spark, data_dir):
        stem, ext = os.path.splitext(fname)
        path = f"{data_dir.rstrip('/')}/{fname}"
        if stem.startswith((".", "_")):
            continue
        if ext not in _DATA_SUFFIXES:
            # a dataset folder written by Spark, named without an extension
            fmt = _dataset_format(spark, path) if is_dir else None
            if fmt is None:
                continue
            ext = "." + fmt
        if ext == ".csv":
            from tessera.sources.csv import scan_csv

            df = scan_csv(spark, path, schema=(csv_schemas or {}).get(stem))
        else:
            df = spark.read.format(ext[1:]).load(path)
        views.append((stem, path, df))
    stems = [stem.lower() for stem, _, _ in views]
    doubled = sorted({stem for stem in stems if stems.count(stem) > 1})
    bad = sorted(stem for stem, _, _ in views if not re.fullmatch(r"\w+", stem))
    if doubled or bad:
        # checked before the first view is made, so that a rejected folder changes nothing
        raise ValueError(f"views can't be named after these files: used twice {doubled}, no identifiers {bad}")
    registered: dict[str, str] = {}
    for stem, path, df in views:
        df.createOrReplaceTempView(stem)
        registered[stem] = path
    return registered
