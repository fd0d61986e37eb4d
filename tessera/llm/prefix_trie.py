"""Conversation prefix trie with a depth-band rollup.

Conversations that begin alike share the nodes of a trie: a node is a distinct
sequence of first turns, named by a chained 128-bit hash.  A conversation's
turns, sorted within their partition, stream through one pass that names its
nodes; nodes are then counted by partial aggregates, so that a beginning that
all conversations share costs a row a task.

Totals of subtrees are summed in bands of ``HEIGHT`` depths.  A node explodes
only to its ancestors within its band, which gives each node the total of its
subtree down to the end of the band.  The totals of band roots then pass from
band to band by doubling (after round k a band root has the total of 2^k bands),
and a completed band root is added to the ancestors of its parent within the
parent's band.  So a node makes at most ``HEIGHT`` rows and the rounds are the
logarithm of the number of bands, whatever the depth.

The digest of the conversations that end in a node is fed in order with pieces
of ids that range-partitioned tasks have joined, so that a node in which a third
of all conversations end is one row a piece in the last step.

Defined results: a null role or text is empty; rows with a null ``conv_id``
belong to no conversation and are ignored; null turns come first, and rows of
the same turn are ordered by role and text, repeated ones each counting.  An
empty table has no conversation and gives an empty result.  Other columns are
ignored.  One conversation's path is hashed turn after turn in one task, in
memory that does not grow with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import read_table, slices, write_stage

#: Conversations of a family, whose first member lends the others its first turns, and the folds of what it lends.
FAMILY, FOLDS = 20, 4
#: Depths of a band.
HEIGHT = 32
#: Ids that are joined to one piece of a digest's input.
PIECE = 1 << 14
ID = 16
ROOT = bytes(ID)


def rebuilt(conversations: DataFrame, family: int = FAMILY, folds: int = FOLDS) -> DataFrame:
    """conv_id, skip, own, turn, role, text: what a conversation borrows, then its own turns, of which ``skip`` are replaced."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text")).filter("conv_id IS NOT NULL")
    skip = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(folds)).cast("int").alias("skip")
    first = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    lent = turns.filter(F.col("conv_id") % family == 0).withColumn("place", F.row_number().over(first)).filter(F.col("place") < folds)
    lent = lent.select(F.col("conv_id").alias("lender"), F.col("place").cast("long").alias("place"), "role", "text")
    borrowers = turns.select("conv_id").distinct().select("conv_id", skip, (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    borrowed = borrowers.join(lent, (F.col("base") == F.col("lender")) & (F.col("place") <= F.col("skip")))
    borrowed = borrowed.select("conv_id", "skip", F.lit(False).alias("own"), F.col("place").alias("turn"), "role", "text")
    return turns.select("conv_id", skip, F.lit(True).alias("own"), "turn", "role", "text").unionByName(borrowed)


def _walk(height: int):
    """Rows of conversations in order -> one row for each node on each path, from the root."""
    names = ["conv_id", "depth", "node", "up", "tokens", "ended"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: int | None = None
        node, band, depth, left = ROOT, b"", 0, 0
        held: tuple | None = None  # the last node, until it is known whether the path ends in it
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out.clear()
            return batch

        for batch in slices(batches, 4096):
            for conv_id, skip, own, role, text in zip(*[batch[c].to_pylist() for c in ("conv_id", "skip", "own", "role", "text")], strict=True):
                if conv_id != conv:
                    if held is not None:
                        out.append((*held, True))
                    conv, node, band, depth, left = conv_id, ROOT, ROOT, 0, skip
                    held = (conv, 0, ROOT, b"", 0)
                if own and left:
                    left -= 1
                    continue
                out.append((*held, False))
                r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
                parent, depth = node, depth + 1
                node = hashlib.blake2b(b"%s%d:%s%s" % (parent, len(r), r, t), digest_size=ID).digest()
                up = band if depth % height else parent
                band = band + node if depth % height else node
                held = (conv, depth, node, up, len(t.split()))
            if out:
                yield made()
        if held is not None:
            out.append((*held, True))
            yield made()

    return run


def paths(turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """conv_id, depth, node, up, tokens, ended of every node on every conversation's path.

    ``up`` holds the ids from the band's root to the parent, of a band's root that of its parent alone.
    """
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "own", "turn", "role", "text")
    return dealt.mapInArrow(_walk(height), "conv_id long, depth long, node binary, up binary, tokens long, ended boolean")


def _ids(joined: Column) -> Column:
    """The ids that a binary column holds one after the other."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.octet_length(joined) / ID).cast("int") - 1), lambda i: F.substring(joined, i * ID + 1, F.lit(ID)))


def _parent(up: Column) -> Column:
    return F.when(F.octet_length(up) > 0, F.substring(up, F.octet_length(up) - ID + 1, F.lit(ID)))


def _sums(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def _band_totals(bands: DataFrame) -> DataFrame:
    """node, leaves, saved of whole subtrees, from ``bands`` (node, above: the root of the band above or null, leaves, saved)."""
    state = write_stage(bands, "bands")
    while not state.filter("above IS NOT NULL").isEmpty():
        added = _sums(state.filter("above IS NOT NULL"), "above", "leaves", "saved")
        added = added.select(F.col("above").alias("to"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        further = state.select(F.col("node").alias("via"), F.col("above").alias("beyond"))
        state = state.join(added, F.col("node") == F.col("to"), "left").join(further, F.col("above") == F.col("via"), "left")
        state = write_stage(state.select("node", F.col("beyond").alias("above"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                                         (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "bands")
    return state.drop("above")


def subtree_totals(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """node, leaves, saved summed over subtrees, from ``nodes`` (node, up, depth, leaves, saved: their own)."""
    at_top = F.col("depth") % height == 0
    itself = F.array("node")
    above = nodes.select(F.explode(F.when(at_top, itself).otherwise(F.concat(_ids(F.col("up")), itself))).alias("to"), "leaves", "saved")
    within = write_stage(_sums(above, "to", "leaves", "saved"), "within-bands")
    hanging = nodes.filter(at_top & (F.col("depth") > 0)).select(F.col("node").alias("top"), _parent(F.col("up")).alias("parent"))
    if hanging.isEmpty():
        return within.withColumnRenamed("to", "node")
    # a band's root hangs on a node at the end of the band above, whose ``up`` starts with that band's root
    ends = nodes.filter(F.col("depth") % height == height - 1)
    ends = ends.select(F.col("node").alias("end"), F.when(at_top, F.col("node")).otherwise(F.concat("up", "node")).alias("path"))
    hanging = write_stage(hanging.join(ends, F.col("parent") == F.col("end")).select("top", "path"), "hanging")
    tops = nodes.filter(at_top).select(F.col("node").alias("n")).join(within, F.col("n") == F.col("to"))
    tops = tops.join(hanging.select("top", F.substring("path", 1, ID).alias("above")), F.col("n") == F.col("top"), "left")
    complete = _band_totals(tops.select(F.col("n").alias("node"), "above", "leaves", "saved"))
    passed = hanging.join(complete, F.col("top") == F.col("node")).select(F.explode(_ids(F.col("path"))).alias("to"), "leaves", "saved")
    return _sums(within.unionByName(passed), "to", "leaves", "saved").withColumnRenamed("to", "node")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) -> (node, first, piece): decimal ids joined by commas."""
    node, ids = None, []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                                          ["node", "first", "piece"])

    for batch in slices(batches, 4096):
        out = []
        for n, i in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
            if ids and (n != node or len(ids) == PIECE):
                out.append(made())
                ids = []
            node = n
            ids.append(i)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield made()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, first, piece) -> (node, sha): one running digest, whatever the number of pieces."""
    node, digest = None, hashlib.sha256()
    for batch in slices(batches):
        nodes, shas = [], []
        for n, piece in zip(batch["node"].to_pylist(), batch["piece"].to_pylist(), strict=True):
            if n != node:
                if node is not None:
                    nodes.append(node)
                    shas.append(digest.hexdigest())
                node, digest = n, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(shas)], ["node", "sha"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "sha"])


def end_digests(steps: DataFrame) -> DataFrame:
    """node, sha: of the ids of the conversations that end in a node, ascending."""
    ends = steps.filter("ended").select("node", "conv_id")
    pieces = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_pieces, "node binary, first long, piece string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, sha string")


def prefix_trie(conversations: DataFrame, family: int = FAMILY, folds: int = FOLDS, height: int = HEIGHT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    steps = write_stage(paths(rebuilt(conversations, family, folds), height), "paths")
    # all of the key follows from the node
    nodes = steps.groupBy("node", "up", "depth", "tokens").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = write_stage(nodes, "nodes")
    children = nodes.groupBy(_parent(F.col("up")).alias("of")).agg(F.count("*").alias("n_children"))
    facts = write_stage(nodes.join(children, F.col("node") == F.col("of"), "left").select(
        "node", "up", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved")), "node-facts")
    totals = subtree_totals(facts.select("node", "up", "depth", "leaves", "saved"), height)
    totals = totals.select(F.col("node").alias("t"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    parents = facts.select(F.col("node").alias("p"), F.col("conv_id").alias("parent_conv_id"))
    ends = end_digests(steps).select(F.col("node").alias("e"), "sha")
    out = facts.join(totals, F.col("node") == F.col("t")).join(ends, F.col("node") == F.col("e"), "left")
    out = out.join(parents, _parent(F.col("up")) == F.col("p"), "left")
    nothing = hashlib.sha256().hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))


def op12_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), p AS (
  SELECT conv_id, row_number() OVER w AS depth, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS tokens,
         md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (w ROWS UNBOUNDED PRECEDING)) AS node
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), n AS (
  SELECT node, any_value(depth) AS depth, any_value(tokens) AS tokens, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY node
), up AS (SELECT DISTINCT a.node AS parent, b.node FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth = a.depth + 1),
children AS (SELECT parent, count(*) AS n_children FROM up GROUP BY parent),
below AS (SELECT DISTINCT a.node AS top, b.node FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
totals AS (
  SELECT top, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * tokens)::BIGINT AS saved_tokens
  FROM below JOIN n USING (node) LEFT JOIN children ON children.parent = node GROUP BY top
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id) USING (conv_id, depth) GROUP BY node
)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
       coalesce(e.sha, sha256('')) AS ends_sha256
FROM n JOIN totals s ON s.top = n.node LEFT JOIN children c ON c.parent = n.node LEFT JOIN ends e ON e.node = n.node
LEFT JOIN up ON up.node = n.node LEFT JOIN n q ON q.node = up.parent
"""
