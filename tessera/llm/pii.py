"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

The patterns give the base spans.  Tokens that hold a digit or an at sign (or a
written-out one), or that repeat a token of a base span, are nodes of a random
field over the labels none, email, ip, card and phone.  Neighbouring nodes share
a chain potential.  Skip potentials join a node with the next one of the same
token (marks, case and written-out marks aside) and the next number that ends in
the same seven digits, however far apart, so that the number of potentials is
linear in the nodes.  Loopy message passing gives marginals; runs of nodes that
are surely one kind, outside the base spans, become further spans if they have
the make-up of that kind (``plausible``).

Potentials are estimated from counts over all texts with the base spans as
labels.  A node outside the base spans that repeats or resembles a base token is
masked: its label is unknown, not "none", so it enters no count, and the field
does not learn to repeat what the patterns miss.  Shapes and contexts are hashed
to fixed numbers of buckets, so the model has a fixed size.

Defined results: a null or empty text has no span.  Offsets are code points, end
exclusive.  Repeated rows are reported alike, a null ``doc_id`` too; an empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, read_table, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
N = len(LABELS)
SHAPES, CONTEXTS = 4096, 1024
ROUNDS, DAMPING = 12, 0.3
#: Marginal from which a node belongs to a further span; bits of trust in a base span.
SURE, BASE_LOG_ODDS = 0.9, 8.0

#: The patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match starts where a run of digits does, so that a long run is tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]|[\[(](?i:at)[\])]")
_WRITTEN = re.compile(r"[\[(](?:at|dot)[\])]")
#: Last digits by which two numbers resemble each other.
TAIL = 7
_TOKENS = re.compile(r"\S+")

Span = tuple[int, int, int]  # start, kind (index in KINDS), end


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the email pattern: the local part is the run of its characters before an at sign."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, 0, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    if not _MARKED.search(text):
        return []
    out = list(_emails(text))
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


@dataclass
class Node:
    start: int
    end: int
    position: int  # among all tokens of the text
    key: str
    label: int  # of the base span that holds it, else 0
    shape: int
    context: int
    wrapped: bool = False  # in parentheses, which belong to a span that goes on
    tail: str = ""  # last digits of a number of at least ``TAIL``
    masked: bool = False  # outside the base spans, but like a token of one


def _shape(token: str) -> int:
    """Bucket of the token's runs of digits, letters and marks, with the lengths of runs of up to 11 digits."""
    runs = re.sub(r"[^\W\d_]+", "a", token)
    runs = re.sub(r"[0-9]+", lambda m: f"9{len(m[0]) if len(m[0]) < 12 else 'L'}", runs)
    return zlib.crc32(runs.encode("utf-8", "surrogatepass")) % SHAPES


_EDGES = ".,;:!?\"'()[]{}<>|#%$&*"


def nodes(text: str, base: list[Span]) -> list[Node]:
    """Tokens with a digit or at sign, and tokens that repeat one of a base span."""
    if not _MARKED.search(text):
        return []
    found, keys, tails, before = [], set(), set(), ""
    held = base
    k = 0
    rows = []
    for position, m in enumerate(_TOKENS.finditer(text)):
        token = m[0]
        core = token.strip(_EDGES)
        start = m.start() + token.find(core) if core else m.start()
        end = start + len(core)
        while k < len(held) and held[k][2] <= m.start():
            k += 1
        label, j = 0, k
        while j < len(held) and held[j][0] < m.end():
            if held[j][2] > m.start():
                label = held[j][1] + 1
                break
            j += 1
        marked = _MARKED.search(core) is not None
        key = "".join(c for c in _WRITTEN.sub("", core.lower()) if c.isalnum()) if marked else core.lower()
        tail = key[-TAIL:] if len(key) >= TAIL and key.isascii() and key.isdigit() else ""
        if label and len(key) >= 3:
            keys.add(key)
            tails.add(tail)
        wrapped = text[start - 1:start] == "(" and text[end:end + 1] == ")"
        rows.append((start, end, position, key, label, marked and bool(core), before, core, wrapped, tail))
        before = token
    for start, end, position, key, label, marked, prev, core, wrapped, tail in rows:
        if core and (marked or key in keys):
            found.append(Node(start, end, position, key, label, _shape(core), zlib.crc32(prev.lower().encode("utf-8", "surrogatepass")) % CONTEXTS, wrapped,
                              tail, not label and (key in keys or bool(tail) and tail in tails)))
    return found


def edges(some: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges (neighbouring tokens) and skip edges (a token and its next occurrence, a number and its next like)."""
    chain = [(i, i + 1) for i in range(len(some) - 1) if some[i + 1].position == some[i].position + 1]
    last: dict[str, int] = {}
    alike: dict[str, int] = {}
    skip = []
    for i, n in enumerate(some):
        if len(n.key) >= 3:
            if n.key in last:
                skip.append((last[n.key], i))
            if n.tail in alike and alike[n.tail] != last.get(n.key):
                skip.append((alike[n.tail], i))
            last[n.key] = i
            if n.tail:
                alike[n.tail] = i
    return chain, skip


@dataclass
class Field:
    """Log potentials: label, shape and context given the label, chain and skip pairs."""

    unary: np.ndarray
    shape: np.ndarray
    context: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @staticmethod
    def from_counts(counts: dict[tuple[str, int, int], int]) -> Field:
        def table(name: str, width: int, smooth: float) -> np.ndarray:
            out = np.full((N, width), smooth)
            for (kind, a, b), n in counts.items():
                if kind == name:
                    out[a, b] += n
            return out

        def alike(n: np.ndarray) -> np.ndarray:
            """The kinds share their skip counts, so that a kind without repeats in the corpus has the potential of the others."""
            n, kinds = n + n.T, slice(1, None)
            same = np.eye(N - 1, dtype=bool)
            out = n.copy()
            out[0, kinds] = out[kinds, 0] = n[0, kinds].mean()
            out[kinds, kinds] = np.where(same, n[kinds, kinds][same].mean(), n[kinds, kinds][~same].mean())
            return out / 2

        label = table("label", 1, 1.0)[:, 0]
        shape, context = table("shape", SHAPES, 0.05), table("context", CONTEXTS, 0.5)
        chain, skip = table("chain", N, 0.5), alike(table("skip", N, 0.05))

        def pairs(n: np.ndarray) -> np.ndarray:
            n = n + n.T
            p = n / n.sum()
            return np.log(p / (p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)))

        return Field(np.log(label / label.sum()), np.log(shape / shape.sum(axis=1, keepdims=True)),
                     np.log(context / context.sum(axis=1, keepdims=True)), pairs(chain), pairs(skip))

    def marginals(self, graphs: list[tuple[list[Node], list[tuple[int, int]], list[tuple[int, int]]]]) -> np.ndarray:
        """Loopy sum-product over the disjoint union of many graphs; a row for each node."""
        flat = [n for some, _, _ in graphs for n in some]
        label = np.array([n.label for n in flat])
        local = self.unary + self.shape[:, [n.shape for n in flat]].T + self.context[:, [n.context for n in flat]].T
        local[np.arange(len(flat)), label] += np.where(label > 0, BASE_LOG_ODDS, 0.0)
        pairs, kinds, at = [], [], 0
        for some, chain, skip in graphs:
            pairs += [(a + at, b + at) for a, b in chain] + [(a + at, b + at) for a, b in skip]
            kinds += [0] * len(chain) + [1] * len(skip)
            at += len(some)
        belief = local
        if pairs:
            ends = np.array(pairs)
            source, target = np.concatenate((ends[:, 0], ends[:, 1])), np.concatenate((ends[:, 1], ends[:, 0]))
            back = np.concatenate((np.arange(len(ends)) + len(ends), np.arange(len(ends))))
            potential = np.stack([self.chain, self.skip])[np.array(kinds * 2)]
            message = np.zeros((len(source), N))
            for _ in range(ROUNDS):
                belief = local.copy()
                np.add.at(belief, target, message)
                cavity = belief[source] - message[back]
                new = np.logaddexp.reduce(cavity[:, :, None] + potential, axis=1)
                new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
                message = DAMPING * message + (1 - DAMPING) * new
            belief = local.copy()
            np.add.at(belief, target, message)
        belief = belief - belief.max(axis=1, keepdims=True)
        p = np.exp(belief)
        return p / p.sum(axis=1, keepdims=True)


def fit(docs: DataFrame) -> Field:
    """Counts labels, shapes, contexts and pairs over all texts; the result has a fixed number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int, int], int] = {}
        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                some = nodes(text, base_spans(text))
                if not some:
                    continue
                chain, skip = edges(some)
                known = [n for n in some if not n.masked]
                seen = [("label", n.label, 0) for n in known] + [("shape", n.label, n.shape) for n in known]
                seen += [("context", n.label, n.context) for n in known]
                seen += [(kind, some[a].label, some[b].label) for kind, pairs in (("chain", chain), ("skip", skip)) for a, b in pairs
                         if not (some[a].masked or some[b].masked)]
                for x in seen:
                    total[x] = total.get(x, 0) + 1
        rows = sorted(total.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
                                          pa.array([k[2] for k, _ in rows], pa.int32()), pa.array([n for _, n in rows], pa.int64())],
                                         ["kind", "a", "b", "n"])

    counted = doc_text(docs).mapInArrow(run, "kind string, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    return Field.from_counts({(r["kind"], r["a"], r["b"]): r["n"] for r in counted.collect()})


def plausible(kind: int, held: list[Node]) -> bool:
    """Whether tokens have the make-up of a kind: a repeated address, four numbers, or a kind's count of digits."""
    text = "".join(n.key for n in held)
    digits = len(_digits(text))
    if kind == 0:
        return all(n.masked for n in held)
    if kind == 1:
        return 4 <= digits <= 12 and digits == len(text)
    low, high = ((14, 19), (TAIL, 15))[kind - 2]
    return low <= digits <= high and digits == len(text)


def further_spans(some: list[Node], marginals: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of neighbouring nodes that are surely of one kind, have its make-up and touch no base span."""
    out: list[Span] = []
    runs: list[list[Node]] = []
    best, sure = marginals.argmax(axis=1), marginals.max(axis=1) >= SURE
    last = -1
    for i, n in enumerate(some):
        if not best[i] or not sure[i] or n.label:
            continue
        if out and last == i - 1 and some[last].position == n.position - 1 and best[last] == best[i]:
            opened = some[last].wrapped and out[-1][0] == some[last].start
            out[-1] = (out[-1][0] - opened, out[-1][1], n.end)
            runs[-1].append(n)
        else:
            out.append((n.start, int(best[i]) - 1, n.end))
            runs.append([n])
        last = i
    return [s for s, held in zip(out, runs, strict=True)
            if plausible(s[1], held) and not any(b[0] < s[2] and s[0] < b[2] for b in base)]


def _told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    some = [nodes(t, b) for t, b in zip(texts, base, strict=True)]
    used = [i for i, n in enumerate(some) if n]
    out = [(b, b) for b in base]
    if used:
        marginals = field.marginals([(some[i], *edges(some[i])) for i in used])
        at = 0
        for i in used:
            rows = marginals[at:at + len(some[i])]
            at += len(some[i])
            out[i] = (base[i], sorted({*base[i], *further_spans(some[i], rows, base[i])}))
    return out


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans of every row."""
    texts = doc_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = [f"n_{k}" for k in KINDS]
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL(
        ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = find(batch["text"].to_pylist(), shared.value)
            counts = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(_told(base).encode()).hexdigest() for base, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *counts, digests, pa.array([_told(s) for _, s in found], pa.string())],
                                             ["doc_id", *names, "base_sha256", "spans"])

    return texts.mapInArrow(run, schema)


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return personal_data(docs, fit(docs))
