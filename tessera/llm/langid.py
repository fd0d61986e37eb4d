"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of zero to three bytes.  A byte costs
its share in the longest context that has been seen, and an escape (the share of
distinct followers) for every longer context of the language that lacks it; the
last resort is one byte in 256.  Statistics are frozen after training, so the
cost of a byte is a function of the four bytes that end there and a text's code
length is an exact sum over all its bytes.  The shortest code names the language.

Bounds: the trees are grown from about ``per_language`` labelled rows of each
language at most, chosen by a hash of ``doc_id``.  Texts are scored in pieces of
fixed size, whole.

Defined results: a null text, one without a letter, and every text when nothing
was learned get ``und`` with score 0.  Equal code lengths go to the first
language in order.  Rows with a null language or id teach nothing.  Repeated
rows score alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fold, read_table, sample_rows, slices

FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE = 2000
ORDER = 3
UNKNOWN = "und"
#: Stands before a text's first byte.
PAD = b"\n" * ORDER
#: Bytes of a text scored at a time.
STEP = 1 << 20


def grams(data: bytes) -> np.ndarray:
    """Codes of the four bytes ending at each byte of ``data`` after the first three."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:] if len(b) > ORDER else np.empty(0, np.uint32)


def encoded(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def pieces(data: bytes) -> Iterator[bytes]:
    """Parts of a text of bounded size, each with the three bytes before it."""
    for at in range(0, len(data), STEP):
        yield (data[at - ORDER:at] if at else PAD) + data[at:at + STEP]


class Table:
    """Codes to row numbers by open addressing; -1 for codes that are not there."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys) - 1).bit_length())
        self.shift, self.mask = np.uint32(32 - bits), np.uint32((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint32)
        self.rows = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = np.flatnonzero(self.rows[slot[left]] < 0)
            _, first = np.unique(slot[left[free]], return_index=True)
            put = left[free[first]]
            self.keys[slot[put]], self.rows[slot[put]] = keys[put], put
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + np.uint32(1)) & self.mask

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435769)) >> self.shift

    def find(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        out = np.where(self.keys[slot] == codes, self.rows[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.rows[slot] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot = (slot[open_] if len(slot) == len(codes) else slot) + np.uint32(1) & self.mask
            rows, hit = self.rows[slot], self.keys[slot] == codes[open_]
            out[open_[hit & (rows >= 0)]] = rows[hit & (rows >= 0)]
            more = ~hit & (rows >= 0)
            open_, slot = open_[more], slot[more]
        return out


@dataclass
class Trees:
    """Cost in bits of every known gram, by order, and of an escape from every known context; a column a language."""

    languages: list[str]
    codes: list[np.ndarray]  # sorted grams of 1 to 4 bytes
    bits: list[np.ndarray]
    contexts: list[np.ndarray]  # sorted contexts of 0 to 3 bytes
    escapes: list[np.ndarray]

    @staticmethod
    def grow(languages: list[str], codes: np.ndarray, counts: np.ndarray) -> Trees:
        """From counts of four-byte grams (rows: distinct ``codes``, columns: languages)."""
        by_length = []
        for length in range(1, ORDER + 2):
            short, at = np.unique(codes & np.uint32((1 << 8 * length) - 1), return_inverse=True)
            total = np.zeros((len(short), len(languages)))
            np.add.at(total, at, counts)
            by_length.append((short, total))
        out = Trees(languages, [], [], [], [])
        lower_codes, lower_bits = None, None
        for length, (short, n) in enumerate(by_length, 1):
            context, at = np.unique(short >> np.uint32(8) if length > 1 else np.zeros_like(short), return_inverse=True)
            total, distinct = (np.zeros((len(context), len(languages))) for _ in range(2))
            np.add.at(total, at, n)
            np.add.at(distinct, at, n > 0)
            room = np.maximum(total + distinct, 1)
            escape = np.where(total > 0, -np.log2(np.maximum(distinct, 1) / room), 0.0)
            if lower_bits is None:
                below = np.full((len(short), len(languages)), 8.0)
            else:
                below = lower_bits[np.searchsorted(lower_codes, short & np.uint32((1 << 8 * (length - 1)) - 1))]
            bits = np.where(n > 0, -np.log2(np.maximum(n, 1) / room[at]), escape[at] + below)
            out.codes.append(short)
            out.bits.append(bits.astype(np.float32))
            out.contexts.append(context)
            out.escapes.append(escape.astype(np.float32))
            lower_codes, lower_bits = short, bits
        return out

    def prepare(self) -> None:
        self.tables = [Table(c) for c in self.codes]
        self.context_tables = [Table(c) for c in self.contexts]

    def cost(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte, a column a language."""
        row = self.tables[ORDER].find(codes)
        out = self.bits[ORDER][row]
        left = np.flatnonzero(row < 0)
        if len(left):
            out[left] = 0
        for length in range(ORDER + 1, 0, -1):  # unknown at this length: escape and go on with a byte less
            if not len(left):
                return out
            context = self.context_tables[length - 1].find((codes[left] & np.uint32((1 << 8 * length) - 1)) >> np.uint32(8))
            known = context >= 0
            out[left[known]] += self.escapes[length - 1][context[known]]
            if length == 1:
                out[left] += 8.0
                return out
            row = self.tables[length - 2].find(codes[left] & np.uint32((1 << 8 * (length - 1)) - 1))
            known = row >= 0
            out[left[known]] += self.bits[length - 2][row[known]]
            left = left[~known]
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        owners, parts = [], []
        size = 0

        def flush() -> None:
            ends = np.cumsum([len(p) for p in parts])
            bits = self.cost(grams(b"".join(parts)))
            sums = np.concatenate((np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)))
            starts = np.concatenate(([0], ends[:-1]))
            np.add.at(out, owners, sums[ends - ORDER] - sums[starts])

        for i, data in enumerate(texts):
            for part in pieces(data):
                owners.append(i)
                parts.append(part)
                size += len(part)
                if size >= STEP:
                    flush()
                    owners, parts, size = [], [], 0
        if parts:
            flush()
        return out


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS, held_out: int = HELD_OUT) -> Trees:
    """Trees from ``text`` and ``lang`` of rows outside the held-out fold.

    A repeated ``doc_id`` counts once for each of its languages, with one of its
    texts, chosen by a digest.
    """
    taught = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    totals = {r["lang"]: r["count"] for r in taught.groupBy("lang").count().collect()}
    if not totals:
        return Trees([], [], [], [], [])
    one = F.min_by("text", F.sha2(F.col("text").cast("binary"), 256))
    sample = sample_rows(taught, "lang", totals, per_language, F.col("doc_id")).groupBy("doc_id", "lang").agg(one.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            by: dict[str, list[bytes]] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                by.setdefault(lang, []).append(encoded(text))
            for lang, texts in by.items():
                for data in texts if sum(map(len, texts)) > STEP else [None]:
                    made = [grams(p) for t in (texts if data is None else [data]) for p in pieces(t)]
                    codes, n = np.unique(np.concatenate(made), return_counts=True) if made else (np.empty(0, np.uint32),) * 2
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)),
                                                      pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counts = sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(totals)
    gram = counts["gram"].to_numpy().astype(np.uint32)
    codes, at = np.unique(gram, return_inverse=True)
    if not len(codes):
        return Trees([], [], [], [], [])
    table = np.zeros((len(codes), len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    table[at, [column[x] for x in counts["lang"].to_pylist()]] = counts["n"].to_numpy()
    return Trees.grow(languages, codes, table)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(docs: DataFrame, trees: Trees, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of every row."""
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(
        "held_out boolean, lang_pred string, score double, bits_per_byte double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if not hasattr(model, "tables"):
            model.prepare()
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            lang, score, rate = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            used = [i for i, t in enumerate(texts) if model.languages and _has_letter(t)]
            data = [encoded(texts[i]) for i in used]
            bits = model.lengths(data)
            for i, d, row in zip(used, data, bits, strict=True):
                best = int(row.argmin())
                lang[i], rate[i] = model.languages[best], row[best] / len(d)
                score[i] = 1.0 / np.exp2(np.clip(row[best] - row, -1000, 0)).sum()
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(score), pa.array(rate)],
                                             ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    return rows.mapInArrow(run, schema)


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
