"""MinHash near-dedup by bottom-k sketches of one hash function.

A document is its set of word shingles; its sketch is the ``k`` smallest hashes
of that set, all by one hash function.  Equal sets are one class, of which one
row stands for the rest.  Inverted lists of retained values bring together the
classes that may overlap, the sketch of a pair's union estimates their Jaccard
similarity, and pairs that the estimate lets pass are verified on the full sets.

Lists are short where it matters: two sketches that overlap in ``o`` of ``s``
values share one of the first ``s - o + 1`` in any order of all values, so only
those, the rarest first, are listed.  That is done twice: over the small sketches
of all classes, and over sketches of ``REFINED`` values of the classes that still
share a list, where most sets are whole and the prefix is that of the limit.  A
passage that a third of all documents share is then listed only for documents
that hold little else.  A list is worked off
by hubs: every other member is compared with a few of them where sizes and the
values that a set has for itself allow a link, members that are
linked by then need no further comparison, and hubs leave the list; the number
of hubs grows until all members of every list are linked or compared.  So a
group of near copies costs about one comparison a member, never one a pair, and
no list is ever gathered in one task.

The estimate (of the ``ESTIMATED`` smallest hashes) never loses a pair of smaller
sets, nor do the lists one of at most ``k`` hashes; beyond, both let pass what is up to 6.5 standard deviations below the limit (a loss below one
linked pair in ten million).  Shingles are compared by 64-bit hashes.

Defined results: a null, empty or blank text has the empty set and is linked
with nothing.  A text of fewer words is one shingle.  Repeated rows are one class
and each keeps its own row.  A null ``doc_id`` is ignored by the least id of a
component (null only if there is no other).  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, read_table, same, slices, write_stage
from tessera.llm.graph import components

SHINGLE, PERCENT, SKETCH = 5, 85, 64
#: Values of the second sketch, of the classes that the first does not rule out.
REFINED = 512
#: Values of the sketches by which pairs are estimated before their full sets meet.
ESTIMATED = 256
#: Hubs of a list in the first round, and by what their number grows.
MORE_HUBS = 8
#: Ids that are broadcast to pick texts; with more of them the texts are shuffled.
BROADCAST_IDS = 1_000_000
#: The multipliers of the splitmix64 generator.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles' 64-bit hashes in ascending order, as signed longs."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    made = np.full(n, size, np.uint64)
    for i in range(size):
        made = made * _MIX[0] + hashes[i:i + n]
        made ^= made >> np.uint64(30)
        made *= _MIX[1]
        made ^= made >> np.uint64(27)
        made *= _MIX[2]
        made ^= made >> np.uint64(31)
    return np.unique(made.view(np.int64))


def _digest(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def sketches(docs: DataFrame, shingle: int = SHINGLE, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set; null if it is empty) and sketch of every row."""
    texts = doc_text(docs)
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("n_shingles long, digest binary, sketch array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, digests, kept = [], [], []
            for text in batch["text"].to_pylist():
                hashes = shingle_hashes(text, shingle)
                sizes.append(len(hashes))
                digests.append(_digest(hashes))
                kept.append(hashes[:k])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(kept, pa.list_(pa.int64()))], schema.names)

    return texts.mapInArrow(run, schema)


def least_overlap(k: int, percent: int) -> int:
    """Sketches of two linked sets share this many values at least, but for a loss that the module states."""
    t = percent / 100
    return max(1, int(k * t - 6.5 * (k * t * (1 - t)) ** 0.5))


def _listed(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """v, cls, n, own: the inverted lists of the values that two linked classes cannot both lack.

    ``own`` counts the values of a set that no other class has; 0 where the sketch is not the whole set.
    """
    values = classes.select("cls", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1").select(F.col("v").alias("w"), "df")
    found = values.join(shared, F.col("v") == F.col("w")).groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("found"))
    found = found.select(F.col("cls").alias("c"), "found")
    # a set of this size has only partners whose sketch is the whole set
    overlap = F.when(100 * F.col("n") <= percent * k, F.ceil(F.col("n") * percent / 100)).otherwise(least_overlap(k, percent))
    # values that no other class has come first in the order and fill a part of the prefix
    size = F.size("sketch") - overlap + 1 - (F.size("sketch") - F.size("found"))
    firsts = classes.join(found, F.col("cls") == F.col("c")).filter(size > 0)
    own = F.when(F.size("sketch") == F.col("n"), F.col("n") - F.size("found")).otherwise(0).alias("own")
    return firsts.select("cls", "n", own, F.explode(F.slice("found", F.lit(1), size.cast("int"))["v"]).alias("v"))


def _can_link(percent: int) -> Column:
    """What sizes and own values allow: neither side's own values are in the intersection, both are in the union."""
    both = F.least(F.col("n") - F.col("own"), F.col("hub_n") - F.col("hub_own"))
    either = F.greatest(F.col("n") + F.col("hub_own"), F.col("hub_n") + F.col("own"))
    return 100 * both >= percent * either


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """cls, shingles of the classes ``wanted`` (cls, doc_id, digest), from the texts of the rows that stand for them."""
    n = wanted.count()
    ids = wanted.select(F.col("doc_id").alias("rep_id")).distinct()
    classes = wanted.select("cls", F.col("doc_id").alias("rep_id"), F.col("digest").alias("rep_digest"))
    if n <= BROADCAST_IDS:
        ids, classes = F.broadcast(ids), F.broadcast(classes)
    texts = doc_text(docs)
    texts = texts.join(ids, same(F.col("doc_id"), F.col("rep_id")), "left_semi")
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("digest binary, shingles array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_hashes(text, shingle) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([_digest(s) for s in sets], pa.binary()),
                                              pa.array(sets, pa.list_(pa.int64()))], schema.names)

    sets = texts.mapInArrow(run, schema)
    sets = sets.join(classes, (F.col("digest") == F.col("rep_digest")) & same(F.col("doc_id"), F.col("rep_id"))).select("cls", "shingles")
    sets = write_stage(sets, "full-sets")
    if sets.select("cls").count() == n:
        return sets
    return write_stage(sets.groupBy("cls").agg(F.first("shingles").alias("shingles")), "one-set-each")


def _with_both(pairs: DataFrame, facts: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of both sides, named by side."""
    for side in ("a", "b"):
        named = facts.select(F.col("cls").alias("c"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(named, F.col(side) == F.col("c")).drop("c")
    return pairs


def _may_link(k: int, percent: int) -> Column:
    """The estimate from the sketch of the union: its values that both sketches hold."""
    union = F.slice(F.array_sort(F.array_union("a_sketch", "b_sketch")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("a_sketch", "b_sketch")))
    exact = (100 * both >= percent * F.size(union)) & (F.size(union) < k)
    return exact | ((F.size(union) >= k) & (both >= least_overlap(k, percent)))


def _linked(percent: int) -> Column:
    both = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return 100 * both >= percent * (F.size("a_shingles") + F.size("b_shingles") - both)


def class_links(docs: DataFrame, classes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, k: int = SKETCH) -> DataFrame | None:
    """``u``, ``v``: verified links between classes that connect all linked ones; None if no two share a value."""
    first = write_stage(_listed(classes, k, percent), "first-lists")
    shared = first.groupBy("v").agg(F.count("*").alias("members")).filter("members > 1").select(F.col("v").alias("w"))
    met = first.join(shared, F.col("v") == F.col("w"), "left_semi").select(F.col("cls").alias("c")).distinct()
    wanted = write_stage(classes.join(met, F.col("cls") == F.col("c"), "left_semi"), "listed-classes")
    if wanted.isEmpty():
        return None
    full = _full_sets(docs, wanted.select("cls", "doc_id", "digest"), shingle)
    refined = full.select("cls", F.size("shingles").alias("n"), F.slice("shingles", 1, max(k, REFINED)).alias("sketch"))
    estimated = full.select("cls", F.slice("shingles", 1, max(k, ESTIMATED)).alias("sketch"))
    open_ = write_stage(_listed(refined, max(k, REFINED), percent), "lists")
    lists_of = write_stage(open_.groupBy(F.col("cls").alias("of")).agg(F.collect_list("v").alias("lists")), "lists-of-classes")
    open_ = open_.withColumn("root", F.col("cls"))
    links: DataFrame | None = None
    refused: DataFrame | None = None
    comps: DataFrame | None = None
    hubs_of = 1
    while True:
        sides = open_.groupBy("v").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select(F.col("v").alias("w"))
        open_ = write_stage(open_.join(sides, F.col("v") == F.col("w"), "left_semi"), "open-lists")
        if open_.isEmpty():
            return links
        # the least own values first: what the others of a group were copied from
        share = F.pmod(F.xxhash64("cls"), F.lit(hubs_of)).alias("share")
        hubs = open_.groupBy("v", share).agg(F.min(F.struct("own", "cls", "n", "root")).alias("hub"))
        hubs = write_stage(hubs.select(F.col("v").alias("w"), F.col("hub.cls").alias("hub"), F.col("hub.n").alias("hub_n"),
                                       F.col("hub.own").alias("hub_own"), F.col("hub.root").alias("hub_root")), "hubs")
        meet = (F.col("v") == F.col("w")) & (F.col("root") != F.col("hub_root")) & _can_link(percent)
        if hubs_of == 1:
            pairs = open_.join(hubs, meet)
        else:
            # a pair is made by the first of the lists that both are in; that one stays open until one of them is its hub
            members = open_.join(lists_of, F.col("cls") == F.col("of"))
            known = hubs.join(lists_of.select(F.col("of").alias("hub_of"), F.col("lists").alias("hub_lists")), F.col("hub") == F.col("hub_of"))
            pairs = members.join(known, meet & (F.col("v") == F.array_min(F.array_intersect("lists", "hub_lists"))))
        pairs = pairs.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
        if refused is not None:
            pairs = pairs.join(refused.select(F.col("a").alias("ra"), F.col("b").alias("rb")),
                               (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb")), "left_anti")
        likely = _with_both(pairs, estimated, "sketch").filter(_may_link(max(k, ESTIMATED), percent)).select("a", "b")
        likely = write_stage(likely, "likely-pairs")
        told = write_stage(_with_both(likely, full, "shingles").select("a", "b", _linked(percent).alias("linked")), "told-pairs")
        now = told.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = now if links is None else links.unionByName(now)
        no = told.filter("not linked").select("a", "b")
        refused = no if refused is None else refused.unionByName(no)
        # hubs have met all members of their list
        rest = open_.drop("root").join(hubs.select("w", "hub"), (F.col("v") == F.col("w")) & (F.col("cls") == F.col("hub")), "left_anti")
        if comps is None or not now.isEmpty():
            comps = write_stage(components(links), "components")
        open_ = rest.join(comps, F.col("cls") == F.col("node"), "left").select("v", "cls", "n", "own", F.coalesce("root", "cls").alias("root"))
        hubs_of *= MORE_HUBS


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = write_stage(sketches(docs, shingle, k).withColumn("row_id", F.monotonically_increasing_id()), "sketches")
    filled = rows.filter("n_shingles > 0")
    # partial minima per task: a set that a third of all rows have sends one row from each
    reps = write_stage(filled.groupBy("digest").agg(F.min("row_id").alias("cls"), F.min("doc_id").alias("least_id")), "classes")
    classes = filled.join(reps.select("cls"), F.col("row_id") == F.col("cls"), "left_semi")
    classes = write_stage(classes.select(F.col("row_id").alias("cls"), "doc_id", "digest", F.col("n_shingles").alias("n"), "sketch"), "class-sketches")
    links = class_links(docs, classes, shingle, percent, k)
    named = reps.select("digest", "least_id", F.col("cls").alias("root"))
    if links is not None:
        roots = components(links).withColumnRenamed("root", "found")
        named = reps.join(roots, F.col("cls") == F.col("node"), "left").select("digest", "least_id", F.coalesce("found", "cls").alias("root"))
        named = write_stage(named, "roots")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id")).select(F.col("root").alias("r"), "component_id")
    named = named.join(least, F.col("root") == F.col("r")).select(F.col("digest").alias("d"), "component_id")
    placed = filled.join(write_stage(named, "named"), F.col("digest") == F.col("d")).select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", same(F.col("doc_id"), F.col("component_id")))


def op13_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w
), c AS (SELECT min(doc_id) AS cls, len(shingles) AS n, shingles FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s WHERE len(shingles) > 0) GROUP BY shingles),
e AS (SELECT cls, unnest(shingles) AS x FROM c),
often AS (SELECT a.cls AS u, b.cls AS v, count(*) AS both FROM e a JOIN e b ON a.x = b.x AND a.cls < b.cls GROUP BY a.cls, b.cls),
links AS (
  SELECT u, v FROM often JOIN (SELECT cls, n AS p FROM c) ON cls = u JOIN (SELECT cls AS other, n AS q FROM c) ON other = v
  WHERE 100 * both >= 85 * (p + q - both)
), both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT cls AS node, cls AS root FROM c UNION SELECT b.v, r.root FROM reach r JOIN both_ways b ON r.node = b.u),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
members AS (SELECT s.doc_id, len(s.shingles) AS n, r.root FROM s LEFT JOIN c ON list_sort(s.shingles) = c.shingles LEFT JOIN roots r ON r.node = c.cls)
SELECT doc_id, n AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept FROM members
"""
