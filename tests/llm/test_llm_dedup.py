"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, graph, simhash


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact(rows):
    """(doc_id, keep_id, group_size, kept, sha) of each row; of equal rows the first is kept."""
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(normalised(t), []).append((-len(t or ""), i is None, i, k))
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0, m[3]))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[2], best[2], len(members), m[3] == best[3], sha) for m in members]
    return sorted(out, key=repr)


def got_exact(df, **kw):
    rows = exact_dedup.exact_groups(df, **kw).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows), key=repr)


def test_exact_odd_rows(odd_docs):
    assert got_exact(odd_docs) == exact([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_exact_empty(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


@pytest.mark.parametrize("hashed", [exact_dedup.chunk_hash, lambda c: F.char_length(c).cast("long")])
def test_exact_small_chunks_and_clashing_hashes(spark, hashed):
    """With a hash that is the length only, nearly all chunks clash and digests must tell them apart."""
    random.seed(1)
    rows = [(i, "".join(random.choice("ab. ") for _ in range(random.choice((0, 3, 20, 40))))) for i in range(120)]
    rows += [(i + 200, t.replace(" ", "\n ")) for i, t in rows[:60]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_exact(df, least=2, most=8, hashed=hashed) == exact(rows)


def test_exact_drop_keeps_columns_and_one_of_repeated_rows(odd_docs):
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    got = sorted((str(r.doc_id), r.text) for r in kept.collect())
    want = sorted((str(i), t) for i, t in {(5, "Alpha  beta gamma\tdelta. Alpha beta!"), (4, " \n\t "), *(
        (r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id not in (1, 2, 3, 4, 5))})
    assert got == want


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(values):
    """Root (smallest index) of each value under links of at most three bits."""
    values = np.array(values, np.uint64)
    root = [-1] * len(values)
    for a in range(len(values)):
        if root[a] < 0:
            queue, root[a] = [a], a
            while queue:
                x = queue.pop()
                for y in np.flatnonzero(np.bitwise_count(values ^ values[x]) <= 3).tolist():
                    if root[y] < 0:
                        root[y] = a
                        queue.append(y)
    return root


def test_fingerprint_of_xxhash64_matches_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert simhash.fingerprint("A b\tc") == row.h % (1 << 64)


def test_simhash_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    ids = sorted(docs)
    fps = [brute_fingerprint(docs[i]) for i in ids]
    want = [(i, f"{f:016x}", ids[r]) for i, f, r in zip(ids, fps, brute_components(fps), strict=True)]
    assert sorted(map(tuple, simhash.op4_query(spark, SF_SMALL).collect())) == want


def test_simhash_odd_rows(odd_docs, no_docs):
    got = simhash.near_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[2].fingerprint == by[3].fingerprint == by[4].fingerprint == "0" * 16
    assert by[2].component_id == by[3].component_id == by[4].component_id == 2
    assert by[5].component_id == by[1].component_id == 1 and by[None].component_id is None
    kept = simhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "6", "7", "8", "None"]
    assert simhash.near_groups(no_docs).count() == 0 and simhash.drop_near_copies(no_docs).count() == 0


def test_simhash_keeps_a_row_of_each_component_whatever_its_ids(spark):
    """Texts without an id and unrelated texts under one id are components of their own."""
    texts = [" ".join(f"{w}{k}" for k in range(30)) for w in ("alpha", "beta", "gamma", "delta")]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[3]), (None, texts[3])]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3])], key=repr)


@pytest.mark.parametrize("hot_bucket", [4096, 2])
def test_close_links_of_dense_groups(spark, hot_bucket):
    """Balls of close fingerprints and chains; with a tiny limit every bucket takes the refined way."""
    rng = np.random.default_rng(3)
    values = set()
    for centre in rng.integers(0, 1 << 63, 5, dtype=np.int64).tolist():
        x = centre
        for _ in range(40):
            values.add(x)
            x ^= 1 << int(rng.integers(0, 64)) ^ 0
            for _ in range(int(rng.integers(0, 5))):
                x ^= 1 << int(rng.integers(0, 64))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = simhash.close_links(nodes, hot_bucket=hot_bucket)
    assert links.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 3).count() == 0
    found = {r.node: r.root for r in graph.components(links).collect()}
    root = brute_components([v % (1 << 64) for v in signed])
    pairs = {}
    for i, r in enumerate(root):
        pairs.setdefault(r, set()).add(found.get(signed[i], signed[i]))
    assert all(len(p) == 1 for p in pairs.values()) and len({p for s in pairs.values() for p in s}) == len(pairs)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5)]
    random.seed(2)
    random.shuffle(edges)
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
