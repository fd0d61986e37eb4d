"""Helpers shared by the document operators.

Conventions: a document table has ``doc_id`` and ``text``; a null text counts as
empty.  Operators select the columns they need first, so further columns of the
input, whatever their names, never clash with computed ones.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.sinks import scratch_path

#: Rows that a Python operator turns into objects at once; long texts are rare
#: enough that a slice of this size stays small.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_text(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and the named extra columns only."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a table in the shared checkpoint folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(prefix: str = "c") -> str:
    """A column name that no input has."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1).cast("long"))


def fold_of(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def sample_rows(rows: DataFrame, column: str, totals: dict, limit: int, key: Column, seed: int = 11) -> DataFrame:
    """About ``limit`` rows of each value of ``column``, chosen by a hash of ``key`` (the same on every run).

    ``totals`` has the number of rows of each value; one pass serves all values.
    """
    buckets = 1 << 30
    share = [x for v, n in sorted(totals.items()) for x in (F.lit(v), F.lit(buckets if n <= limit else int(buckets * limit / n)))]
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)) < F.create_map(*share)[F.col(column)])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int,
                    held_out: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text, label of about ``per_class`` labelled rows of each class, outside the held-out fold.

    Also the number of such rows of each class.  Rows with a null id or label are left out.  A ``doc_id`` that
    ``docs`` repeats gives one row for each of its labels, with one of its texts, chosen by a digest.
    """
    taught = labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label"))
    taught = taught.filter(F.col("label").isin(0, 1) & F.col("label_id").isNotNull() & (fold(F.col("label_id"), folds) != held_out))
    totals = {r["label"]: r["count"] for r in taught.groupBy("label").count().collect()}
    sample = sample_rows(taught, "label", totals, per_class, F.col("label_id")).distinct() if totals else taught.limit(0)
    texts = doc_text(docs)
    # the sample is about 2 * per_class ids
    joined = texts.join(F.broadcast(sample), texts.doc_id == sample.label_id).select("doc_id", "text", "label")
    one = F.min_by("text", F.sha2(F.col("text").cast("binary"), 256))
    return joined.groupBy("doc_id", "label").agg(one.alias("text")).select("doc_id", "text", "label"), totals


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def filter_by_key(docs: DataFrame, keys: DataFrame, columns: dict[str, Column], how: str) -> DataFrame:
    """Rows of ``docs`` with (``left_semi``) or without (``left_anti``) a match in ``keys``.

    ``columns`` maps each column of ``keys`` to an expression over ``docs``.
    Nulls match nulls.  ``keys`` is the build side of a shuffled hash join at any
    size, so texts are shuffled at most once and never sorted.  A task holds its
    partition's keys, which are to be distinct: ``spark.sql.shuffle.partitions``
    must grow with their number.
    """
    made = {fresh("k"): (name, expr) for name, expr in columns.items()}
    right = keys.select(*[F.col(name).alias(f"{tmp}r") for tmp, (name, _) in made.items()])
    left = docs.select("*", *[expr.alias(tmp) for tmp, (_, expr) in made.items()])
    cond = None
    for tmp in made:
        c = same(left[tmp], right[f"{tmp}r"])
        cond = c if cond is None else cond & c
    return left.join(right.hint("shuffle_hash"), cond, how).drop(*made)


def keep_rows(docs: DataFrame, decided: DataFrame, here: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` that ``decided`` marks ``kept``, with all their columns.

    ``here`` maps the key columns of ``decided`` to expressions over ``docs``.
    ``decided`` has one row per input row; where rows agree in the whole key,
    one of them stays.
    """
    keys = list(here)
    kept = decided.groupBy(*keys).agg(F.count("*").alias("n"), F.max("kept").alias("any_kept")).filter("any_kept")
    kept = write_stage(kept.select(*keys, "n"), "kept-keys")
    out = filter_by_key(docs, kept.select(*keys), here, "left_semi")
    repeated = kept.filter("n > 1").select(*keys)
    if repeated.isEmpty():
        return out
    tmp = {fresh(k): v for k, v in here.items()}
    once = filter_by_key(out, repeated, here, "left_semi").withColumns(tmp).dropDuplicates(list(tmp)).drop(*tmp)
    return filter_by_key(out, repeated, here, "left_anti").unionByName(once)
