"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items build one automaton over word
numbers.  Document words stream through it; at each word it knows the longest
match that ends there.  A word is hit when it lies in an occurrence of a window:
``window`` consecutive words of an item, or all words of a shorter item.

The automaton grows with the benchmark, never with the corpus, and has a fixed
bound: a benchmark of more than ``max_words`` words makes several automata, through
which the texts stream in turn, one at a time in memory, and whose hits are
united.  The result is that of one automaton at any size.

Words: A-Z is lower-cased, and runs of ASCII letters, digits and characters
beyond ASCII are words.  Defined results: a null or empty text has no words and
no hit; an item without words has no window; items of the same text are both
reported, also where their ids are equal, and a null id is reported as an empty
string; an empty benchmark leaves every document clean; repeated rows are
judged alike.  Extra columns are ignored by the report and kept by the filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, fresh, read_table, slices, write_stage

WINDOW = 10
#: Words of an automaton (about 0.5 KB each), which the driver builds and each worker holds.
MAX_WORDS = 400_000

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
#: Lower-cases A-Z and turns every byte that is no part of a word into a space.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD_BYTES else 0x20 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class SuffixAutomaton:
    """All substrings of many word sequences; ``item ends`` say where each window of an item ends."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: dict[bytes, int] = {}
        self.items = [name for name, _ in items]
        pairs: set[int] = set()
        short: list[tuple[int, list[int]]] = []
        ends: list[tuple[int, int]] = []
        for k, (_, sequence) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in sequence]
            last = 0
            for i, w in enumerate(ids):
                last = self._extend(last, w)
                if i + 1 >= window:
                    ends.append((last, k))
            if 0 < len(ids) < window:
                short.append((k, ids))
            pairs.update(a << 32 | b for a, b in zip(ids, ids[1:], strict=False))
        self.pairs = np.array(sorted(pairs), np.int64)
        self.singles = np.zeros(len(self.vocabulary) + 1, bool)
        # state -> items with a window that ends in it: a window's own state, cut to ``window`` words
        self.window_items: dict[int, list[int]] = {}
        for state, k in ends:
            found = self.window_items.setdefault(self._cut(state, window), [])
            if k not in found[-1:]:
                found.append(k)
        # states of short items: (words, items)
        self.short_items: dict[int, list[tuple[int, int]]] = {}
        for k, ids in short:
            state = 0
            for w in ids:
                state = self.next[state][w]
            self.short_items.setdefault(state, []).append((len(ids), k))
            if len(ids) == 1:
                self.singles[ids[0]] = True
        self.shortest = min([window, *(len(ids) for _, ids in short)])
        self.has_short = self._reaches_short()

    def _extend(self, last: int, w: int) -> int:
        next_, link, length = self.next, self.link, self.length
        if w in next_[last]:
            q = next_[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, w, q)
        made = len(next_)
        next_.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in next_[p]:
            next_[p][w] = made
            p = link[p]
        if p != -1:
            q = next_[p][w]
            link[made] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return made

    def _clone(self, p: int, w: int, q: int) -> int:
        next_, link, length = self.next, self.link, self.length
        made = len(next_)
        next_.append(dict(next_[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = made
        while p != -1 and next_[p].get(w) == q:
            next_[p][w] = made
            p = link[p]
        return made

    def _cut(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _reaches_short(self) -> list[bool]:
        """Whether a state or one of its suffix links ends a short item."""
        out = [False] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            out[state] = state in self.short_items or (state > 0 and out[self.link[state]])
        return out

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs of words that may hold a window: outside them the longest match is below the shortest window.

        In an occurrence of a window every two neighbouring words are neighbours in an item.
        """
        inside = ids >= 0
        if self.shortest > 1 and len(ids) > 1:
            joined = (ids[:-1].astype(np.int64) << 32) | ids[1:]
            at = np.searchsorted(self.pairs, joined)
            linked = inside[:-1] & inside[1:] & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == joined) if len(self.pairs) else np.zeros(len(joined), bool)
            edge = np.diff(np.concatenate(([0], linked.view(np.int8), [0])))
            runs = zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + 1).tolist(), strict=True)
            return [(a, b) for a, b in runs if b - a >= self.shortest]
        if self.shortest > 1:
            return []
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))

    def hits(self, sequence: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans (first word, end) of hit words, disjoint and in order, and the items with an occurring window."""
        if not self.vocabulary:
            return [], set()
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in sequence], np.int32)
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        next_, link, length, window = self.next, self.link, self.length, self.window
        for start, end in self.candidates(ids):
            state = matched = 0
            for i, w in enumerate(ids[start:end].tolist(), start):
                while state and w not in next_[state]:
                    state = link[state]
                    matched = length[state]
                if w in next_[state]:
                    state, matched = next_[state][w], matched + 1
                    # the state must be the one whose shortest string is not longer than the match
                    while matched <= length[link[state]]:
                        state = link[state]
                hit = 0
                if matched >= window:
                    hit = window
                    found.update(self.window_items.get(self._cut(state, window), ()))
                if self.has_short[state]:
                    s = state
                    while s > 0 and self.has_short[s]:
                        for n, k in self.short_items.get(s, ()):
                            if n <= matched:
                                hit = max(hit, n)
                                found.add(k)
                        s = link[s]
                if hit:
                    a = i + 1 - hit
                    while spans and spans[-1][1] >= a:
                        a = min(a, spans.pop()[0])
                    spans.append((a, i + 1))
        return spans, found


def automata(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> Iterator[SuffixAutomaton]:
    """Automata of all items of ``benchmark`` (item_id, text), each of about ``max_words`` words; one is held at a time.

    An item that does not fit into one is cut into pieces that share ``window`` - 1 words, so that each of its
    windows lies in a piece; its pieces count as one item.  Items are (number, id), so that null or repeated ids
    stay apart.
    """
    items: list[tuple[tuple[int, str], list[bytes]]] = []
    n = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    for k, row in enumerate(rows.toLocalIterator()):
        sequence = words(row["text"] or "")
        step = max(1, max_words - window + 1)
        starts = range(0, max(1, len(sequence) - window + 1), step) if len(sequence) > max_words else (0,)
        for start in starts:
            piece = sequence[start:start + step + window - 1] if len(sequence) > max_words else sequence
            if items and n + len(piece) > max_words:
                yield SuffixAutomaton(items, window)
                items, n = [], 0
            items.append(((k, row["item_id"] or ""), piece))
            n += len(piece)
    yield SuffixAutomaton(items, window)


def build_automaton(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> SuffixAutomaton:
    """One automaton of all items, for a benchmark that is known to fit; an error if it does not."""
    passes = automata(benchmark, window, max_words)
    first = next(passes)
    if next(passes, None) is not None:
        raise ValueError(f"the benchmark has over {max_words} words; raise max_words or go through automata()")
    return first


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _as_columns(items: list[tuple[list[tuple[int, int]], list[tuple[int, str]]]]) -> list[pa.Array]:
    spans = [[{"start": a, "end": b} for a, b in s] for s, _ in items]
    found = [[{"k": k, "name": name} for k, name in f] for _, f in items]
    return [pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            pa.array(found, pa.list_(pa.struct([("k", pa.int64()), ("name", pa.string())])))]


_SPANS, _FOUND = "spans array<struct<start:int,end:int>>", "found array<struct<k:bigint,name:string>>"


def _hits(texts: DataFrame, automaton: SuffixAutomaton) -> DataFrame:
    """``texts`` (text, others) with the spans and items of one automaton in place of the text."""
    shared = texts.sparkSession.sparkContext.broadcast(automaton)
    kept = [c for c in texts.columns if c != "text"]
    schema = T.StructType([*[texts.schema[c] for c in kept], *T.StructType.fromDDL(f"n_words long, {_SPANS}, {_FOUND}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in slices(batches):
            sizes, rows = [], []
            for text in batch["text"].to_pylist():
                sequence = words(text)
                spans, found = held.hits(sequence)
                sizes.append(len(sequence))
                rows.append((spans, [held.items[k] for k in sorted(found)]))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(sizes, pa.int64()), *_as_columns(rows)], schema.names)

    return texts.mapInArrow(run, schema)


def _all_hits(texts: DataFrame, benchmark: DataFrame, window: int, max_words: int) -> DataFrame:
    """``texts`` (text, others) with n_words and the spans and items of all automata, in any order and perhaps repeated."""
    passes = automata(benchmark, window, max_words)
    first, second = next(passes), next(passes, None)
    if second is None:
        return _hits(texts, first)
    number, of = fresh("row"), fresh("of")
    texts = write_stage(texts.withColumn(number, F.monotonically_increasing_id()), "numbered-texts")
    given = [c for c in texts.columns if c not in ("text", number)]
    base = write_stage(_hits(texts, first), "hits")
    more = None
    for automaton in chain((second,), passes):
        some = write_stage(_hits(texts.select(number, "text"), automaton).filter("size(found) > 0").drop("n_words"), "hits")
        more = some if more is None else more.unionByName(some)
    # a row has at most as many lists as there are automata
    more = more.groupBy(F.col(number).alias(of)).agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("found")).alias("f"))
    none = F.array()
    return base.join(more, F.col(number) == F.col(of), "left").select(
        *given, "n_words", F.concat("spans", F.coalesce("s", none)).alias("spans"), F.concat("found", F.coalesce("f", none)).alias("found"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (word positions) of every row."""
    hits = _all_hits(doc_text(docs), benchmark, window, max_words)
    schema = T.StructType([hits.schema["doc_id"], *T.StructType.fromDDL(
        f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, {_SPANS}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, spans = [], []
            for met, found in zip(batch["spans"].to_pylist(), batch["found"].to_pylist(), strict=True):
                united = _united([(s["start"], s["end"]) for s in met])
                items = {f["k"]: f["name"] for f in found}
                n_hit = sum(b - a for a, b in united)
                rows.append((n_hit, len(items), hashlib.sha256(",".join(sorted(items.values())).encode()).hexdigest(), n_hit > 0))
                spans.append((united, []))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_words"], *cols, _as_columns(spans)[0]], schema.names)

    return hits.mapInArrow(run, schema)


def _word_places(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words of :func:`words`, in characters."""
    out, start = [], -1
    for i, c in enumerate(text):
        inside = ord(c) >= 0x80 or c.isalnum()
        if inside and start < 0:
            start = i
        elif not inside and start >= 0:
            out.append((start, i))
            start = -1
    if start >= 0:
        out.append((start, len(text)))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    places, parts, end = _word_places(text), [], 0
    for a, b in spans:
        parts.append(text[end:places[a][0]])
        end = places[b - 1][1]
    return " ".join([*parts, text[end:]])


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5,
                     max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` without benchmark passages.

    Hit spans are cut out of the text (a space stays in their place); a row whose
    hit words are more than ``max_coverage`` of its words goes.  Clean rows are
    unchanged.  All columns stay; ``n_chars``, where there is one, follows the text.
    """
    passes = automata(benchmark, window, max_words)
    first = next(passes)
    if next(passes, None) is not None:
        return _remove_in_passes(docs, benchmark, window, max_coverage, max_words)
    shared = docs.sparkSession.sparkContext.broadcast(first)
    at = docs.columns.index("text")
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            keep, changed = [], {}
            for i, text in enumerate(texts):
                sequence = words(text or "")
                spans, _ = automaton.hits(sequence)
                if sum(b - a for a, b in spans) > max_coverage * len(sequence):
                    continue
                keep.append(i)
                while spans:  # what a cut brings together may be a passage again
                    changed[i] = text = _without(text, spans)
                    spans, _ = automaton.hits(words(text))
            cols = list(batch.columns)
            if changed:
                new = [changed.get(i, t) for i, t in enumerate(texts)]
                cols[at] = pa.array(new, cols[at].type)
                if counted is not None:
                    n = cols[counted].to_pylist()
                    cols[counted] = pa.array([len(changed[i]) if i in changed else x for i, x in enumerate(n)], cols[counted].type)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in cols], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _remove_in_passes(docs: DataFrame, benchmark: DataFrame, window: int, max_coverage: float, max_words: int) -> DataFrame:
    """As :func:`remove_benchmark`, for a benchmark of several automata: rounds over the rows that still have hits."""
    number, cuts = fresh("row"), fresh("cuts")
    clean: DataFrame | None = None
    open_ = write_stage(docs.withColumn(number, F.monotonically_increasing_id()), "open-texts")
    schema = open_.schema
    at = open_.columns.index("text")
    counted = open_.columns.index("n_chars") if "n_chars" in open_.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            met = batch[cuts].to_pylist()
            texts = [_without(t, _united([(s["start"], s["end"]) for s in spans])) for t, spans in zip(batch.column(at).to_pylist(), met, strict=True)]
            cols = list(batch.columns)[:len(schema)]
            cols[at] = pa.array(texts, cols[at].type)
            if counted is not None:
                cols[counted] = pa.array([len(t) for t in texts], cols[counted].type)
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    while True:
        told = _all_hits(open_.select(F.col(number).alias("of"), F.coalesce("text", F.lit("")).alias("text")), benchmark, window, max_words)
        told = write_stage(told.select("of", "n_words", F.col("spans").alias(cuts)), "text-hits")
        marked = open_.join(told, F.col(number) == F.col("of"))
        done = marked.filter(F.size(cuts) == 0).select(*schema.names)
        # the share is of the text as it came in: only the first round drops rows
        hit = marked.filter(F.size(cuts) > 0)
        if clean is None:
            words_hit = F.size(F.array_distinct(F.flatten(F.transform(cuts, lambda s: F.sequence(s["start"], s["end"] - 1)))))
            hit = hit.filter(words_hit <= max_coverage * F.col("n_words"))
        clean = done if clean is None else clean.unionByName(done)
        open_ = write_stage(hit.select(*schema.names, cuts).mapInArrow(cut, schema), "open-texts")
        if open_.isEmpty():
            return clean.drop(number)


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")
