"""Every stage on its own input against what it must keep, and the whole."""

import re

import corpus_pipeline
from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F
from test_llm_decontamination import words
from test_llm_dedup import brute_components, brute_fingerprint, exact

from tessera.llm import quality
from tessera.llm.common import read_table, write_stage


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_filter", "exact_dedup", "simhash_near_dedup", "decontamination", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, write_stage(stage(spark, docs, SF_SMALL), name)
        kept[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.schema.simpleString() == before.schema.simpleString()
    before, after = map(texts, kept["quality_filter"])
    model = quality.fit(kept["quality_filter"][0], read_table(spark, SF_SMALL, "labels"))
    assert set(after) == {i for i, t in before.items() if model.scores([t])[0] >= quality.THRESHOLD}
    before, after = map(texts, kept["exact_dedup"])
    assert after == {r[0]: before[r[0]] for r in exact(list(before.items())) if r[3]}
    before, after = map(texts, kept["simhash_near_dedup"])
    ids = sorted(before)
    roots = brute_components([brute_fingerprint(before[i]) for i in ids])
    assert set(after) == {ids[r] for r in roots}
    before, after = map(texts, kept["decontamination"])
    windows = {tuple(w[i:i + 10]) for r in read_table(spark, SF_SMALL, "benchmark").collect() for w in [words(r.text)] for i in range(len(w) - 9)}
    dirty = {i for i, t in before.items() for w in [words(t)] if any(tuple(w[k:k + 10]) in windows for k in range(len(w) - 9))}
    assert dirty and all(after[i] == t for i, t in before.items() if i not in dirty)
    assert not any(tuple(w[k:k + 10]) in windows for t in after.values() for w in [words(t)] for k in range(len(w) - 9))
    packed = kept["best_fit_packing"][1]
    assert packed.select("doc_id").distinct().count() == len(after)
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.filter("n > 2048 or n <> end").count() == 0


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = write_stage(stage(spark, docs, SF_SMALL), name)
            assert name == "best_fit_packing" or docs.columns == odd_docs.columns


def test_what_each_stage_makes_of_odd_rows(spark, odd_docs):
    def rows(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    stages, before = dict(corpus_pipeline.STAGES), rows(odd_docs)
    model = quality.fit(odd_docs, read_table(spark, SF_SMALL, "labels"))
    assert rows(stages["quality_filter"](spark, odd_docs, SF_SMALL)) == [r for r in before if model.scores([r[1] or ""])[0] >= quality.THRESHOLD]
    single = [r for r in before if r[0] in (None, 6, 7, 8)]
    five, one, two, four = (next(r for r in before if r[0] == i) for i in (5, 1, 2, 4))
    assert rows(stages["exact_dedup"](spark, odd_docs, SF_SMALL)) == sorted([*single, five, four], key=repr)
    assert rows(stages["simhash_near_dedup"](spark, odd_docs, SF_SMALL)) == sorted([*single, one, two], key=repr)
    assert rows(stages["decontamination"](spark, odd_docs, SF_SMALL)) == before
    packed = stages["best_fit_packing"](spark, odd_docs, SF_SMALL).collect()
    whole = [r for r in packed if r.start == 0]
    assert sorted((r.doc_id for r in whole), key=repr) == sorted((i for i, _ in before), key=repr)
    assert {r.length for r in whole if r.doc_id in (2, 3)} == {1} and sum(r.length for r in packed if r.doc_id == 7) > 40_000


def test_import_errors_are_not_swallowed():
    source = open(corpus_pipeline.__file__).read()
    assert not re.search(r"except\s+(ImportError|ModuleNotFoundError|Exception)|except:", source)
