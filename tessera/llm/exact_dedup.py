"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text without white space is cut into chunks at places that its content
defines (the first separator after a least length, else a greatest length).
Chunks are deduplicated to identifiers: the 64-bit hash of a chunk is verified
against the chunk's text in one grouped pass, and chunks that share a hash with
another text are told apart by their own digest.  A document becomes its recipe, the ordered
list of its chunk identifiers; documents are equal when their recipes are.
Each distinct chunk is shuffled once; long documents are never grouped whole.

Defined results: a null text is the empty text, whose recipe is empty, and all
empty texts are one group.  A null ``doc_id`` sorts last.  Each input row is a
document of its own: a repeated row joins the group and is dropped like any
other copy.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import doc_text, keep_rows, same, write_stage

#: White space that does not count: space, tab, line feed, vertical tab, form feed, carriage return.
IGNORED = " \t\n\x0b\x0c\r"
#: A chunk ends at the first of these after MIN_CHUNK characters.
SEPARATORS = r".,;:!?|。，、"
MIN_CHUNK, MAX_CHUNK = 1024, 8192


def normalised(text: Column) -> Column:
    for c in IGNORED:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def chunked(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    pattern = f"(?s).{{{least - 1},{most - 1}}}?[{SEPARATORS}]|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _clashing(texts: DataFrame, least: int, most: int, hashed: Callable[[Column], Column]) -> DataFrame:
    """Hashes that more than one chunk has; grouping by the chunk itself is the byte comparison."""
    chunks = texts.select(F.explode(chunked(F.col("norm"), least, most)).alias("chunk"))
    distinct = chunks.select(hashed(F.col("chunk")).alias("h"), "chunk").groupBy("h", "chunk").agg(F.lit(1).alias("one"))
    return distinct.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1")


def recipes(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK,
            hashed: Callable[[Column], Column] = chunk_hash) -> DataFrame:
    """One row per input row: doc_id, n_chars, text_sha256, recipe, fix.

    ``recipe`` is the ordered list of chunk hashes; ``fix`` lists (position,
    digest) of the chunks whose hash alone does not identify them.
    """
    texts = doc_text(docs).select("doc_id", F.char_length("text").cast("long").alias("n_chars"),
                                  normalised(F.col("text")).alias("norm"))
    slim = write_stage(texts.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_chars",
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(chunked(F.col("norm"), least, most), hashed).alias("recipe")), "recipes")
    clashing = write_stage(_clashing(texts, least, most, hashed), "clashing-hashes")
    no_fix = F.array().cast("array<struct<pos:int,sha:string>>")
    if clashing.isEmpty():
        return slim.withColumn("fix", no_fix)
    # Chunks under a clashing hash are identified by their own digest as well.
    occurrences = texts.select("doc_id", "n_chars", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                               F.posexplode(chunked(F.col("norm"), least, most)).alias("pos", "chunk"))
    occurrences = occurrences.select("doc_id", "n_chars", "text_sha256", "pos", hashed(F.col("chunk")).alias("h"),
                                     F.sha2(F.col("chunk").cast("binary"), 256).alias("sha"))
    fixes = (occurrences.join(clashing.select("h"), "h", "left_semi")
             .groupBy("doc_id", "n_chars", "text_sha256")
             .agg(F.array_sort(F.collect_set(F.struct("pos", "sha"))).alias("fix")))
    f = fixes.select(F.col("doc_id").alias("f_id"), F.col("n_chars").alias("f_n"),
                     F.col("text_sha256").alias("f_sha"), "fix")
    joined = slim.join(f, same(slim.doc_id, f.f_id) & (slim.n_chars == f.f_n) & (slim.text_sha256 == f.f_sha), "left")
    return joined.select(*slim.columns, F.coalesce("fix", no_fix).alias("fix"))


def exact_groups(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK,
                 hashed: Callable[[Column], Column] = chunk_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chars: one row per input row."""
    rows = recipes(docs, least, most, hashed)
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("null"),
                     F.col("doc_id").alias("doc_id"), F.col("row_id").alias("row_id"))
    # Partial sums per task: a recipe with a third of all rows sends one row from each task.
    groups = write_stage(rows.groupBy("recipe", "fix").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
                         .select(F.col("recipe").alias("g_recipe"), F.col("fix").alias("g_fix"), "best", "group_size"),
                         "recipe-groups")
    joined = rows.join(groups, (rows.recipe == groups.g_recipe) & (rows.fix == groups.g_fix))
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                         (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256", "n_chars")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    here = {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(normalised(text).cast("binary"), 256),
            "n_chars": F.char_length(text).cast("long")}
    return keep_rows(docs, write_stage(exact_groups(docs), "exact-groups"), here)


def op1_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
