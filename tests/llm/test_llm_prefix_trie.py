"""The trie against a plain one built from whole conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tessera.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    for own in turns.values():
        own.sort()
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple((r, t) for *_, r, t in turns.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(convs) - 1) * words
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if whole[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children.get(node, 0), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def planted(seed, n=120):
    """Families with shared beginnings, conversations of no turns but borrowed ones, hot texts and odd values."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        for turn in range(rng.choice((1, 1, 2, 3, 5, 9))):
            text = rng.choice(["hi there", "what is up", None, "", "a b  c\td"])
            rows.append((c, rng.choice((turn, turn, None)), rng.choice(("user", "assistant", None)), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 3, 32])
def test_equal_to_brute_force(spark, height):
    rows = planted(height)
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), height=height)
    assert result(got) == brute(rows)


def test_deep_conversations_cross_many_bands(spark):
    rows = [(c, t, "u", f"t{t} x" if t < 70 or c % 3 else f"other {c}") for c in range(6) for t in range(40 + 15 * c)]
    assert result(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), height=4)) == brute(rows)


def test_digest_of_many_ids_comes_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, 0, "u", "same") for c in range(500)] + [(c, 0, "u", f"own {c}") for c in range(500, 520)]
    rows = [(c * 20, *rest) for c, *rest in rows]
    assert result(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(9))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (3, None, None, None), (3, None, None, None), (3, 0, "user", "x" * 100_000), (0, 1, "user", "a"), (0, 1, "user", "a"),
            (20, 5, "", " "), (21, 0, "user", "日本 é"), (7, 0, "user", "a"), (-3, 0, "user", "b"), (-3, 1, "user", "c"), (-3, 2, "user", "c")]
    docs = spark.createDataFrame([(*r, "clash", 1, "n") for r in rows], SCHEMA + ", node string, depth int, up string")
    got = result(prefix_trie.prefix_trie(docs))
    # the family of a negative id starts above it, as SQL's remainder has its sign
    assert [r for r in got if r[0] != -3][1:] and sum(r[1] == 0 for r in got) == 1
    assert result(prefix_trie.prefix_trie(docs.filter("conv_id >= 0 OR conv_id IS NULL"))) == brute([r for r in rows if r[0] is None or r[0] >= 0])
    assert prefix_trie.prefix_trie(docs.limit(0)).count() == 0
    assert prefix_trie.prefix_trie(docs.filter("conv_id IS NULL")).count() == 0
