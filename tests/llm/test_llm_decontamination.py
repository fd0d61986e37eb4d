"""Suffix automaton against brute force."""

import hashlib
import random
import re

import pytest
from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from tessera.llm import decontamination as dc

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, doc, window):
    hit, names = set(), set()
    for name, seq in items:
        for w in [seq[i:i + window] for i in range(len(seq) - window + 1)] if len(seq) >= window else [seq] if seq else []:
            for i in range(len(doc) - len(w) + 1):
                if doc[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    names.add(name)
    return hit, names


def test_automaton():
    random.seed(5)
    for _ in range(1500):
        window, letters = random.choice([2, 3, 4]), random.choice([2, 3, 5])
        items = [(str(k), [random.choice("abcde"[:letters]) for _ in range(random.randint(0, 9))]) for k in range(random.randint(0, 4))]
        doc = [random.choice("abcdez"[:letters + 1]) for _ in range(random.randint(0, 30))]
        made = dc.SuffixAutomaton([(n, [x.encode() for x in s]) for n, s in items], window)
        spans, found = made.hits([x.encode() for x in doc])
        assert ({i for a, b in spans for i in range(a, b)}, {made.items[k] for k in found}) == brute(items, doc, window)


def expected(rows, items):
    out = []
    for i, t in rows:
        doc = words(t)
        hit, names = brute(items, doc, dc.WINDOW)
        out.append((i, len(doc), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "short Item"), (3, None), (4, "..."),
            (5, "ONE two three four five six seven eight nine ten"), (6, "日本語")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_odd_rows(spark, odd_docs, no_docs, items):
    texts = [(50, "x ONE, two three four five six seven eight nine ten! y"), (51, "two three four five six seven eight nine ten"),
             (52, "a short. item of 日本語 z"), (53, "shorter item"), (50, "x ONE, two three four five six seven eight nine ten! y")]
    more = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, n_words string").unionByName(
        odd_docs.select("doc_id", "text", odd_docs.n.alias("n_words")).filter("doc_id is null or doc_id <> 7"))
    got = sorted((tuple(r) for r in dc.contamination(more, items).drop("spans").collect()), key=repr)
    pairs = [(str(r.item_id), words(r.text)) for r in items.collect()]
    assert got == expected([(r.doc_id, r.text) for r in more.collect()], pairs)
    assert dc.contamination(no_docs, items).count() == 0
    assert dc.contamination(more, items.limit(0)).filter("contaminated").count() == 0
    with pytest.raises(ValueError, match="max_words"):
        dc.build_automaton(items, max_words=5)


def test_several_automata_give_the_result_of_one(spark, odd_docs, items):
    random.seed(11)
    letters = "abcd"
    bench = [(k, " ".join(random.choice(letters) for _ in range(random.choice((0, 1, 3, 9, 10, 14, 40))))) for k in range(25)]
    bench = spark.createDataFrame(bench, "item_id long, text string").unionByName(items)
    rows = [(i, " ".join(random.choice(letters + "z") for _ in range(random.randint(0, 60)))) for i in range(60)] + [(None, "a"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text").filter("doc_id < 6"))
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    one = sorted(map(str, dc.contamination(docs, bench, 6).collect()))
    kept = sorted(map(str, dc.remove_benchmark(docs, bench, 6).collect()))
    for limit in (5, 37):
        assert sum(1 for _ in dc.automata(bench, 6, limit)) > 2
        assert sorted(map(str, dc.contamination(docs, bench, 6, limit).collect())) == one
        assert sorted(map(str, dc.remove_benchmark(docs, bench, 6, max_words=limit).collect())) == kept
    assert any("contaminated=True" in r for r in one)


def test_items_without_or_with_equal_ids_stay_apart(spark):
    rows = [(None, "alpha beta"), ("None", "gamma delta"), ("7", "alpha beta"), ("7", "gamma delta")]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    got = dc.contamination(spark.createDataFrame([(1, "x alpha beta y gamma delta")], "doc_id long, text string"), bench).first()
    assert (got.n_hit, got.n_items) == (4, 4)
    assert got.items_sha256 == hashlib.sha256(",7,7,None".encode()).hexdigest()


def test_query(spark):
    pairs = [(str(r.item_id), words(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in dc.op7_query(spark, SF_SMALL).collect()), key=repr)
    windows = {}
    for name, seq in pairs:
        for w in [seq[i:i + 10] for i in range(len(seq) - 9)] if len(seq) >= 10 else [seq]:
            windows.setdefault(tuple(w), set()).add(name)
    want = []
    for i, t in rows:
        doc, hit, names = words(t), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(doc) - size + 1):
                found = windows.get(tuple(doc[k:k + size]))
                if found:
                    hit.update(range(k, k + size))
                    names |= found
        want.append((i, len(doc), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=repr) and any(r[5] for r in got)


def test_removal(spark, odd_docs, items):
    long = "Keep this text. " * 5
    rows = [(1, f"{long}one two three four five six seven eight nine ten, and this.", "a"), (2, "one two three four five six seven eight nine ten", "b"),
            (3, long, "c"), (4, None, "d"), (5, f"{long} short short item item", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in dc.remove_benchmark(docs, items).collect()}
    assert sorted(got) == [1, 3, 4, 5]
    assert got[1].text == f"{long} , and this." and got[3].text == long and got[4].text is None
    assert "short" not in got[5].text.lower()  # what a cut brought together went too
    same = dc.remove_benchmark(odd_docs, items)
    assert same.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in same.collect()) == sorted(str(r.doc_id) for r in odd_docs.collect() if r.doc_id != 99)
