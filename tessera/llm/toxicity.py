"""Toxicity by noisy-channel deobfuscation.

Texts may hide words by look-alike characters, spacing and repetition.  Each
suspicious token becomes a lattice: every character offers the letters it may
stand for, separators may vanish and runs may shrink, each at a cost.  The
cheapest path under a character language model (Viterbi over the last two
letters) is the restored token; a token without such characters has one path,
itself.  The restored text is scored by its strongest words: a word's evidence is
the largest log-likelihood ratio of the word and its beginnings, and a logistic
model joins the three largest.

The language model counts character trigrams of all texts.  The scorer is fitted
on about ``per_class`` labelled rows of each class at most, chosen by a hash of
``doc_id``, and uses every feature above ``LEAST_GAIN``; the sample bounds their number.

Defined results: a null or empty text has no feature and gets the score of the
intercept, about the share of label 1; without labelled rows every score is 0.
Repeated rows score alike; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, fold, labelled_sample, read_table, slices, write_stage

FOLDS, HELD_OUT = 4, 2
PER_CLASS = 4000
#: Least gain (in nats of the sample) of a feature, so that a few rows of one label are no evidence.
LEAST_GAIN = 12.0
THRESHOLD = 0.3
#: Characters and the letters they may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
              "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = " .-_*~'`,/\\"
#: Bits that the channel takes for a look-alike, a dropped separator, shrinking a longer run, and making one of a double letter.
COST_ALIKE, COST_DROP, COST_SHRINK, COST_SINGLE = 1.0, 0.5, 0.5, 9.0
#: Bits for reading a look-alike as a boundary, or a separator between single letters as one.
COST_BREAK, COST_KEEP = 16.0, 4.0
#: The same where no letter follows: marks often end a word, digits less often.
COST_MARK, COST_DIGIT = 4.0, 10.0
#: Lengths of the word beginnings that are features.
STARTS = range(4, 9)
#: Letters of the language model: boundary, a-z, the Latin-1 letters, and one for all others.
ALPHABET = " " + "abcdefghijklmnopqrstuvwxyz" + "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ" + "￿"
SIZE = len(ALPHABET)
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
OTHER = SIZE - 1

_MARKS = "".join(LOOKALIKES)
_LETTER, _LIKE = r"[^\W\d_]", f"[{re.escape(_MARKS)}]"
#: A look-alike beside a letter; what stands around it is looked at then.
_ALIKE = re.compile(f"{_LIKE}(?={_LETTER})|(?<={_LETTER}){_LIKE}")
#: A token of letters and look-alikes that starts or goes on with a letter after one or two look-alikes.
_TOKEN = re.compile(f"{_LIKE}{{0,2}}{_LETTER}+(?:{_LIKE}+{_LETTER}+)*{_LIKE}*")
_APART = re.compile(rf"(?<![^\W_])(?:(?:{_LETTER}|{_LIKE})[{re.escape(SEPARATORS)}]{{1,3}}){{2,}}(?:{_LETTER}|{_LIKE})(?![^\W_])")
_HAS_LETTER = re.compile(_LETTER).search
_DOMAIN_GOES_ON = re.compile(r"[\w-]*\.\w").match
#: A word with a letter twice in a row, tried from its first letter only.
_RUN = re.compile(f"(?<!{_LETTER}){_LETTER}*?({_LETTER})\\1{_LETTER}*")
_WORDS = re.compile(r"[^\W\d_]+").findall
#: Decoded tokens that a worker remembers.
KEPT = 100_000


def letter_codes(text: str) -> np.ndarray:
    """Letters of a lower-case text as numbers of the alphabet; all that is no letter between words is one boundary."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _LATIN[np.minimum(points, 256)]
    return codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))] if len(codes) else codes


def _latin() -> np.ndarray:
    table = np.zeros(257, np.int64)
    table[256] = OTHER
    for i, c in enumerate(ALPHABET[:-1]):
        table[ord(c)] = i
    return table


_LATIN = _latin()
#: Letters and look-alikes among the first 256 characters; all above count.
_UNIT = (_LATIN != 0) | np.array([chr(i) in LOOKALIKES for i in range(257)])


def suspicious(text: str) -> tuple[bool, bool]:
    """Whether three single letters or look-alikes stand apart in a row, and whether a letter is repeated."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < 2:
        return False, False
    low = np.minimum(points, 256)
    double = (points[1:] == points[:-1]) & (_LATIN[low[1:]] != 0)
    edge = np.diff(_UNIT[low].view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    single = ends - starts == 1
    near = starts[1:] - ends[:-1] <= 3
    apart = single[2:] & single[1:-1] & single[:-2] & near[1:] & near[:-1] if len(starts) > 2 else np.zeros(0, bool)
    return bool(apart.any()), bool(double.any())


def _token_end(text: str, at: int) -> int:
    """End of the letters and look-alikes from ``at`` on; look-alikes before another digit are part of a number."""
    end = last = at
    while end < len(text):
        c = text[end]
        if c.isalpha():
            last = end + 1
        elif c not in LOOKALIKES:
            break
        end += 1
    return last if end < len(text) and text[end].isdigit() else end


@dataclass
class CharModel:
    """Bits of a letter after two others, interpolated with the shorter contexts."""

    bits: np.ndarray
    kept: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def from_counts(three: np.ndarray) -> CharModel:
        n3 = three.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
        p1 = (n1 + 1) / (n1.sum() + SIZE)
        p2 = (n2 + 4 * p1) / (n2.sum(axis=1, keepdims=True) + 4)
        p3 = (n3 + 4 * p2) / (n3.sum(axis=2, keepdims=True) + 4)
        return CharModel((-np.log2(p3)).astype(np.float32))

    def __getstate__(self):
        return {"bits": self.bits, "kept": {}}

    def restore(self, token: str) -> str:
        if token not in self.kept:
            if len(self.kept) >= KEPT:
                self.kept = {}
            self.kept[token] = self._decode(token)
        return self.kept[token]

    def _decode(self, token: str) -> str:
        """The cheapest reading of a token, by Viterbi over the last two letters."""
        bits = self.bits
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in lattice(token):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for emitted, channel in options:
                    c1, c2, total = a, b, cost + channel
                    for c in emitted:
                        k = _INDEX.get(c, OTHER)
                        if not (k == 0 and c2 == 0):
                            total += float(bits[c1, c2, k])
                            c1, c2 = c2, k
                    if (c1, c2) not in new or total < new[c1, c2][0]:
                        new[c1, c2] = (total, (path, emitted))
            best = new
        _, path = min(((cost + (float(bits[a, b, 0]) if b else 0.0), path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])
        parts = []
        while path is not None:
            path, emitted = path
            parts.append(emitted)
        return "".join(reversed(parts))

    def restored(self, text: str) -> str:
        """The lower-case text with its suspicious tokens restored."""
        text = text.lower()
        apart, runs = suspicious(text)
        if apart:
            text = _APART.sub(lambda m: self.restore(m[0]) if _HAS_LETTER(m[0]) else m[0], text)
        if _ALIKE.search(text):
            text = self._restore_alikes(text)
        if runs:
            text = _RUN.sub(lambda m: self.restore(m[0]), text)
        return text

    def _word(self, token: str) -> str:
        """A token restored; what is read as the boundary at its end stays as it is written."""
        out = self.restore(token)
        word, stem = out.rstrip(" "), token
        for _ in range(len(out) - len(word)):
            stem = stem.rstrip(stem[-1])
        return word + token[len(stem):]

    def _restore_alikes(self, text: str) -> str:
        """Only tokens with a look-alike beside a letter are looked at."""
        parts, end = [], 0
        for m in _ALIKE.finditer(text):
            at = m.start()
            if at < end:
                continue
            start = at
            while start > end and (text[start - 1].isalpha() or text[start - 1] in LOOKALIKES):
                start -= 1
            token = _TOKEN.fullmatch(text, start, _token_end(text, at))
            address = token and "@" in token[0] and _DOMAIN_GOES_ON(text, token.end())
            if token and not address and (start == 0 or not text[start - 1].isdigit()):
                parts += [text[end:start], self._word(token[0])]
                end = token.end()
        return "".join([*parts, text[end:]]) if parts else text


def lattice(token: str) -> Iterator[list[tuple[str, float]]]:
    """For each run of one character: the readings (letters, cost in bits) it allows."""
    tail = len(token.rstrip(_MARKS))
    for m in re.finditer(r"(.)\1*", token, re.DOTALL):
        c, n = m[1], len(m[0])
        if c in LOOKALIKES:
            end = COST_BREAK if m.start() < tail else COST_DIGIT if c.isdigit() else COST_MARK
            yield [*((x * k, COST_ALIKE * n) for x in LOOKALIKES[c] for k in {1, min(n, 2)}), (" ", end)]
        elif c in SEPARATORS:
            yield [("", COST_DROP), (" ", COST_KEEP)]
        elif n > 1 and c.isalpha():
            yield [(c, COST_SINGLE), (m[0], 0.0)] if n == 2 else [(c, COST_SHRINK), (c * 2, COST_SHRINK), (m[0], 0.0)]
        else:
            yield [(m[0], 0.0)]


def char_model(docs: DataFrame) -> CharModel:
    """Counts letter trigrams of all texts; at most one row for each trigram reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE ** 3, np.int64)
        for batch in slices(batches):
            c = letter_codes(" ".join(["", *batch["text"].to_pylist(), ""]).lower())
            if len(c) > 2:
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    counts = doc_text(docs).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    three = np.zeros(SIZE ** 3, np.int64)
    three[counts["gram"].to_numpy()] = counts["n"].to_numpy()
    return CharModel.from_counts(three)


def features(text: str) -> set[str]:
    """Words of a restored text and how they begin."""
    out = set(_WORDS(text))
    return out | {w[:k] + "+" for w in out for k in STARTS if len(w) > k}


@dataclass
class Scorer:
    """``evidence``: log-likelihood ratio of each feature; ``slopes`` of the strongest words' evidence, strongest first."""

    evidence: dict[str, float]
    slopes: list[float]
    intercept: float

    def __post_init__(self):
        # no word with another beginning can have a feature
        self.first = {w.removesuffix("+")[:4] for w in self.evidence}

    def strongest(self, text: str) -> list[float]:
        """Evidence of the three words with the most, each by its best feature."""
        first, get = self.first, self.evidence.get
        words = {w for w in set(_WORDS(text)) if w[:4] in first}
        best = sorted((max([get(w, 0.0), *(get(w[:k] + "+", 0.0) for k in STARTS if len(w) > k)]) for w in words), reverse=True)
        return [*best[:3], 0.0, 0.0, 0.0][:3]

    def score(self, text: str) -> float:
        """Probability of label 1 of a restored text."""
        total = self.intercept + sum(b * x for b, x in zip(self.slopes, self.strongest(text), strict=True))
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -700, 700))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Weighted ridge logistic regression by Newton steps; coefficients and intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    penalty = np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        gradient = x1.T @ (weight * (p - y)) + penalty * beta
        hessian = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, chars: CharModel, label: str = "toxic", per_class: int = PER_CLASS,
        folds: int = FOLDS, held_out: int = HELD_OUT) -> Scorer:
    sample, totals = labelled_sample(docs, labels, label, per_class, folds, held_out)
    if not totals:
        return Scorer({}, [0.0] * 3, -1e3)
    shared = docs.sparkSession.sparkContext.broadcast(chars)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [shared.value.restored(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch["label"]], ["text", "label"])

    rows = write_stage(sample.select("text", "label").mapInArrow(restore, "text string, label int"), "restored-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = (Counter(), Counter())
        for batch in slices(batches):
            for text, y in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                n[y].update(features(text))
        names = sorted(n[0].keys() | n[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[w] for w in names], pa.int64()) for c in n]], ["feature", "n0", "n1"])

    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n0, n1 = seen.get(0, 0), seen.get(1, 0)
    prior = totals.get(1, 0) / sum(totals.values())
    if not n0 or not n1:
        return Scorer({}, [0.0] * 3, float(np.clip(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)), -30, 30)))
    counts = rows.mapInArrow(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # the gain of a feature: how much likelier its rows are under the class's own rate than under the common one
    rate = (F.col("n0") + F.col("n1")) / float(n0 + n1)
    part = lambda n, of: F.when(n > 0, n * F.log((n / float(of)) / rate)).otherwise(0.0)
    gain = part(F.col("n0"), n0) + part(F.col("n1"), n1)
    best = (counts.filter("n1 >= 3").withColumn("gain", gain)
            .filter((F.col("gain") > LEAST_GAIN) & (F.col("n1") / float(n1) > F.col("n0") / float(n0)))
            .collect())
    evidence = {r["feature"]: float(np.log((r["n1"] + 0.5) / (n1 + 1)) - np.log((r["n0"] + 0.5) / (n0 + 1))) for r in best}
    scorer = Scorer(evidence, [0.0] * 3, 0.0)

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [scorer.strongest(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch["label"]], ["x", "label"])

    found = sorted((tuple(r["x"]), r["label"]) for r in rows.mapInArrow(strongest, "x array<double>, label int").collect())
    x, y = np.array([v for v, _ in found]), np.array([v for _, v in found], float)
    weight = np.where(y == 1, totals[1] / n1, totals[0] / n0) * len(found) / sum(totals.values())
    slopes, scorer.intercept = _logistic(x, y, weight)
    scorer.slopes = slopes.tolist()
    return scorer


def toxicity(docs: DataFrame, chars: CharModel, scorer: Scorer, threshold: float = THRESHOLD, folds: int = FOLDS,
             held_out: int = HELD_OUT, with_text: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted (and the restored text) of every row."""
    texts = doc_text(docs).withColumn("held_out", fold(F.col("doc_id"), folds) == held_out)
    shared = docs.sparkSession.sparkContext.broadcast((chars, scorer))
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL(
        "held_out boolean, score double, predicted int" + ", restored string" * with_text).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, judge = shared.value
        for batch in slices(batches):
            restored = [model.restored(t) for t in batch["text"].to_pylist()]
            score = np.array([judge.score(t) for t in restored])
            cols = [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            names = ["doc_id", "held_out", "score", "predicted"]
            if with_text:
                cols.append(pa.array(restored, pa.string()))
                names.append("restored")
            yield pa.RecordBatch.from_arrays(cols, names)

    return texts.mapInArrow(run, schema)


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    chars = char_model(docs)
    return toxicity(docs, chars, fit(docs, read_table(spark, sf_dir, "labels"), chars))
