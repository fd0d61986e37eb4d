"""Best-fit packing with certified bounds.

Texts are encoded where they lie and only piece lengths are shuffled.  Pieces
are dealt to partitions of bounded size; each is packed best-fit decreasing and
its bin count is compared with a lower bound from dual-feasible functions.
Partitions with a gap give up their bins with space left, every other partition
its emptiest bin, and what was given up is packed again over fewer partitions,
as long as that takes fewer bins.

Defined results: a null text is empty and packs as its end id alone.  A text of
more than ``capacity`` ids is cut from its end, so that only its first piece can
be shorter.  Repeated rows are packed each on their own, ties between equal
lengths are free.  An empty table gives an empty result.  Other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, fresh, ids_crc32, slices, write_stage
from tessera.llm.tokens import encode

CAPACITY, END_ID = 2048, 0
VOCABULARY = "byte_bpe_50k.json"
#: Bounds of a partition: what one task packs at a time, whatever the input.
PART_TOKENS, PART_PIECES = 1 << 26, 1 << 17
#: A bin with less space left than one part in so many is not given up.
SLACK = 128
ROUNDS = 4


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``) of every text."""
    path = path or public_tokenizers.path(VOCABULARY)
    texts = doc_text(docs)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            of, rows, parts = [], [], []
            for row, ids in enumerate(encode(path, batch["text"].to_pylist(), end_id)):
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start:start + length]
                    of.append(row)
                    rows.append((k, start, length, ids_crc32(part)))
                    parts.append(part)
            cols = list(zip(*rows, strict=True))
            out = [batch["doc_id"].take(pa.array(of)), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return texts.mapInArrow(run, schema)


def bin_bound(counts: np.ndarray, capacity: int) -> int:
    """Least number of bins for ``counts[l]`` pieces of each length l: the best of several dual-feasible functions."""
    lengths = np.arange(len(counts), dtype=np.int64)
    counts = counts.astype(np.int64)
    best = 0

    def thresholds(size: np.ndarray, unit: int) -> int:
        """f(x) = 1 above 1 - t, 0 below t, else x; for every t up to a half.  ``size`` is in ``unit``ths."""
        order = np.argsort(size, kind="stable")
        s, c = size[order], counts[order]
        number, weight = np.concatenate(([0], np.cumsum(c))), np.concatenate(([0], np.cumsum(c * s)))
        t = np.unique(np.concatenate(([0], s[2 * s <= unit])))
        low, high = np.searchsorted(s, t, "left"), np.searchsorted(s, unit - t, "right")
        return int(((number[-1] - number[high]) * unit + weight[high] - weight[low]).max() + unit - 1) // unit

    best = thresholds(lengths, capacity)
    for k in range(1, 33):
        # f(x) = x where (k + 1) x is whole, else floor((k + 1) x) / k; in units of 1 / (k * capacity)
        whole, rest = np.divmod((k + 1) * lengths, capacity)
        best = max(best, thresholds(np.where(rest == 0, k * lengths, whole * capacity), k * capacity))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: longest first, each into the fullest bin that takes it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, made = 0, 0  # bit s of spaces: a bin with s free exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = spaces >> n
        if fit:
            space = n + (fit & -fit).bit_length() - 1
            b = open_[space].pop()
            if not open_[space]:
                spaces ^= 1 << space
        else:
            space, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - space
        if space > n:
            if not open_[space - n]:
                spaces |= 1 << (space - n)
            open_[space - n].append(b)
    return bins, offsets


def _packed(rows: DataFrame, number: str, parts: int, capacity: int, run: int, first: int) -> DataFrame:
    """``rows`` dealt to ``parts`` partitions and packed, with what certifies each partition.

    They are dealt by a hash of their ``number``, which no two rows share, so that equal rows spread too.
    ``first`` is the number of partitions of all rounds before, so that no two rounds share a sequence id.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(number, F.lit(run)), F.lit(parts)))
    names = rows.columns
    added = ["sequence_id", "offset", "space", "part", "gap"]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in added]])

    def one(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        part = table["part"][0].as_py()
        gap = len(fill) - bin_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        made = [bins + ((first + part) << 32), offsets, (capacity - fill)[bins], np.full(len(bins), part), np.full(len(bins), gap)]
        return pa.table([*[table[c] for c in names], *[pa.array(x, pa.int64()) for x in made]],
                        names=[*names, *added])

    return dealt.groupBy("part").applyInArrow(one, schema)


def _parts(rows: DataFrame, part_tokens: int, part_pieces: int) -> int:
    n, tokens = rows.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return max(1, -(-tokens // part_tokens), -(-n // part_pieces))


def pack(rows: DataFrame, capacity: int = CAPACITY, part_tokens: int = PART_TOKENS, part_pieces: int = PART_PIECES,
         rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (doc_id, piece, start, length of at most ``capacity``, any others) with sequence_id and offset."""
    given, number = rows.columns, fresh("row")
    # written with the rows, so that a task that runs again deals them alike
    rows = write_stage(rows.withColumn(number, F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    # a full piece is a sequence by itself
    full = write_stage(rows.filter(whole).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}), "full-pieces")
    rest = rows.filter(~whole)
    parts = _parts(rest, part_tokens, part_pieces)
    out = [*given, "sequence_id", "offset"]
    settled, open_ = full.select(*out), write_stage(_packed(rest, number, parts, capacity, 0, 0), "packed")
    dealt = parts
    for run in range(1, rounds + 1):
        if parts == 1:
            break
        # the emptiest bin of each partition, and where the bound is not met all bins with space
        emptiest = open_.groupBy("part").agg(F.max_by("sequence_id", F.struct("space", "sequence_id")).alias("tail"))
        emptiest = emptiest.select(F.col("part").alias("p"), "tail")
        marked = open_.join(emptiest, F.col("part") == F.col("p")).withColumn(
            "again", ((F.col("gap") > 0) & (F.col("space") * SLACK >= capacity)) | (F.col("sequence_id") == F.col("tail")))
        marked = write_stage(marked.drop("p", "tail"), "marked")
        given_up = marked.filter("again")
        parts = _parts(given_up, part_tokens, part_pieces)
        packed = write_stage(_packed(given_up.select(*given, number), number, parts, capacity, run << 16, dealt), "repacked")
        dealt += parts
        before, after = (x.filter("offset = 0").count() for x in (given_up, packed))
        if after >= before:
            break
        settled = settled.unionByName(marked.filter("not again").select(*out))
        open_ = packed
    return settled.unionByName(open_.select(*out))


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of all texts with their places: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack(pieces(docs, capacity, path, end_id, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from :func:`packed_documents` with ids; a sequence is at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op8_query(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
