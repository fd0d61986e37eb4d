"""SimHash near-dedup by pigeonhole blocks.

A fingerprint of 64 bits is cut into blocks.  When at most ``distance`` bits
differ, all but ``distance`` blocks agree, so a close pair meets in the bucket
of at least one choice of ``blocks - distance`` blocks.  Buckets are formed
over distinct fingerprints (copies share one) and only those with two or more
members move on.  A bucket above ``HOT_BUCKET`` members is cut again by the
same rule over its remaining bits; what shares a bucket then agrees in 48 bits,
so no bucket exceeds 65,536 fingerprints at any input size.  In a bucket, a
breadth-first search over exact Hamming distances emits a spanning forest of
the links, never all pairs, and components are found over those edges.

Defined results: a null or blank text has fingerprint zero and links like any
other.  A repeated row is a document of its own.  A null ``doc_id`` is ignored
by the least id of a component (null only if the component has no other).  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, keep_rows, slices, write_stage
from tessera.llm.graph import components

SHINGLE, DISTANCE, SEED = 3, 3, 42
BLOCKS = 6
HOT_BUCKET = 4096
#: Shingles hashed at a time, so that a text of any length needs bounded memory.
STEP = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64; no words: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    from_, to = starts[:n].tolist(), ends[shingle - 1:].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, STEP):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(from_[at:at + STEP], to[at:at + STEP], strict=True)])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *extra: str) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row, and the named extra columns."""
    texts = doc_text(docs, *extra)
    schema = T.StructType([*texts.drop("text").schema.fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(fps)], [*kept, "fp"])

    return texts.mapInArrow(run, schema)


def _masks(free_bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks of the choices of ``blocks - distance`` blocks of the free bits, as signed longs."""
    parts = [int(sum(1 << int(b) for b in part)) for part in np.array_split(np.array(free_bits), blocks)]
    out = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def _keyed(fps: DataFrame, masks: list[int], at: str, key: str) -> DataFrame:
    made = [F.struct(F.lit(i).alias(at), F.col("fp").bitwiseAND(F.lit(m)).alias(key)) for i, m in enumerate(masks)]
    return fps.select("*", F.inline(F.array(*made)))


def _refined(hot: DataFrame, masks: list[int], blocks: int, distance: int) -> DataFrame:
    """Members of hot buckets under second keys, taken over the bits that the first key leaves free."""
    cases: Column | None = None
    for i, mask in enumerate(masks):
        free = [b for b in range(64) if not mask >> b & 1]
        made = F.array(*[F.struct(F.lit(j).alias("part2"), F.col("fp").bitwiseAND(F.lit(m)).alias("key2"))
                         for j, m in enumerate(_masks(free, blocks, distance))])
        cases = F.when(F.col("part") == i, made) if cases is None else cases.when(F.col("part") == i, made)
    return hot.select("part", "key", "fp", F.inline(cases))


def spanning_links(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges (indexes into ``values``) of a spanning forest of all pairs within ``distance`` bits."""
    rest = np.arange(len(values))
    out: list[tuple[int, int]] = []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = np.bitwise_count(values[rest] ^ values[i]) <= distance
            if near.any():
                found = rest[near].tolist()
                out += [(i, j) for j in found]
                queue += found
                rest = rest[~near]
    return out


def _bucket_links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        last = None

        def links(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()),
                                               pa.array([e[1] for e in edges], pa.int64())], ["u", "v"])

        edges: list[tuple[int, int]] = []

        def close() -> None:
            if len(held) > 1:
                values = np.unique(np.array(held, np.int64)).view(np.uint64)
                signed = values.view(np.int64).tolist()
                edges.extend((signed[i], signed[j]) for i, j in spanning_links(values, distance))
            held.clear()

        for batch in batches:
            cols = [batch[c].to_pylist() for c in ("part", "key", "part2", "key2", "fp")]
            for *bucket, fp in zip(*cols, strict=True):
                if bucket != last:
                    close()
                    last = bucket
                held.append(fp)
            if edges:
                yield links(edges)
                edges.clear()
        close()
        if edges:
            yield links(edges)

    return run


def close_links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``u``, ``v``: links between distinct fingerprints (column ``fp``) that connect all pairs within ``distance`` bits."""
    masks = _masks(list(range(64)), blocks, distance)
    keyed = _keyed(fps.select("fp"), masks, "part", "key")
    # Partial counts per task; a bucket of one fingerprint needs no more.
    sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("members")).filter("members > 1")
    sizes = write_stage(sizes.select(F.col("part").alias("p"), F.col("key").alias("k"), "members"), "buckets")
    members = keyed.join(sizes, (F.col("part") == F.col("p")) & (F.col("key") == F.col("k"))).select("part", "key", "fp", "members")
    members = write_stage(members, "bucket-members")
    cold = members.filter(F.col("members") <= hot_bucket).select("part", "key", F.lit(-1).alias("part2"), F.lit(0).cast("long").alias("key2"), "fp")
    hot = _refined(members.filter(F.col("members") > hot_bucket), masks, blocks, distance)
    bucket = ["part", "key", "part2", "key2"]
    dealt = cold.unionByName(hot.select(*bucket, "fp")).repartition(*bucket).sortWithinPartitions(*bucket)
    return dealt.mapInArrow(_bucket_links(distance), "u long, v long").distinct()


def _rooted_rows(docs: DataFrame, shingle: int, distance: int, *extra: str, blocks: int = BLOCKS,
                 hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint, component_id, component_root and the named extra columns of every row.

    The root is the least fingerprint of a component and names it; the id does not, as it may be null or repeated.
    """
    rows = write_stage(fingerprints(docs, shingle, *extra), "fingerprints")
    nodes = write_stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = write_stage(components(close_links(nodes, distance, blocks, hot_bucket)), "roots")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id")).select(F.col("root").alias("r"), "component_id")
    named = write_stage(rooted.join(least, F.col("root") == F.col("r")).select(
        F.col("fp").alias("f"), "component_id", F.col("root").alias("component_root")), "components")
    return rows.join(named, F.col("fp") == F.col("f")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_root", *extra)


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, *extra: str,
                blocks: int = BLOCKS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint, component_id and the named extra columns of every row."""
    rooted = _rooted_rows(docs, shingle, distance, *extra, blocks=blocks, hot_bucket=hot_bucket)
    return rooted.select("doc_id", "fingerprint", "component_id", *extra)


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, that of the least ``doc_id`` (a null id last) and then text digest, with all its columns."""
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    tagged = docs.select("doc_id", "text", sha.alias("text_sha"))
    rows = write_stage(_rooted_rows(tagged, shingle, distance, "text_sha").select("doc_id", "text_sha", "component_root"), "near-groups")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_sha")
    first = rows.groupBy("component_root").agg(F.min(place).alias("first")).select(F.col("component_root").alias("c"), "first")
    decided = rows.join(first, F.col("component_root") == F.col("c")).select("doc_id", "text_sha", (place == F.col("first")).alias("kept"))
    return keep_rows(docs, decided, {"doc_id": F.col("doc_id"), "text_sha": sha})


def op4_query(spark, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
