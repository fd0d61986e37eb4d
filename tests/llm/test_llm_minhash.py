"""Near groups against brute force over all pairs, on planted clusters and odd rows."""

import random

import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from tessera.llm import minhash


def shingles(text, size=5):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=85):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def planted(seed):
    """Texts of 1 to 400 words with copies of 0 to 8 changed words, on a passage that most of them share."""
    rng = random.Random(seed)
    passage = [f"line{i}" for i in range(60)]
    rows = []
    while len(rows) < 160:
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((1, 3, 4, 6, 12, 40, 70, 150, 400)))]
        if rng.random() < 0.6:
            words = passage + words
        for _ in range(rng.choice((1, 1, 2, 6))):
            changed = list(words)
            for _ in range(rng.randrange(9)):
                changed[rng.randrange(len(changed))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(changed)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    rows = planted(seed)
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < 0.9 * len(rows)


def test_a_chain_in_one_list_needs_several_hubs(spark, monkeypatch):
    """Neighbours of a chain are linked, its ends are not, and the first hub is an outsider of the same lists."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([f"x{j}" for j in range(4 * i)] + base[4 * i:])) for i in range(1, 16)]
    rows.append((0, " ".join(base[100:])))
    rounds = []
    real = minhash.components
    monkeypatch.setattr(minhash, "components", lambda links: rounds.append(1) or real(links))
    got = {r.doc_id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()} and len(rounds) > 1


def test_a_cluster_makes_no_pairs_of_all_members(spark, monkeypatch):
    """300 near copies: about one comparison a member and list, not 45,000."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[:k], f"n{i}", *base[k + 1:]])) for i, k in enumerate(rng.randrange(300) for _ in range(300))]
    told = []
    real = minhash.write_stage
    monkeypatch.setattr(minhash, "write_stage", lambda df, name: told.append(out) or out if (out := real(df, name)) is not None and name == "likely-pairs" else out)
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.filter("component_id = 0").count() == 300 and got.filter("kept").count() == 1
    assert sum(t.count() for t in told) < 40 * 300


def test_sketch_is_the_smallest_hashes_of_the_set():
    hashes = minhash.shingle_hashes("A b c d e F a b c d e f")
    assert len(hashes) == len(shingles("A b c d e F a b c d e f")) and (hashes[1:] > hashes[:-1]).all()
    assert minhash.shingle_hashes("a b").tolist() != minhash.shingle_hashes("b a").tolist()
    assert minhash.shingle_hashes("a b").tolist() == minhash.shingle_hashes("\tA\n b ").tolist()
    assert len(minhash.shingle_hashes(" \n")) == 0
    assert minhash.least_overlap(64, 85) == 35


def test_odd_rows(spark, odd_docs, no_docs):
    got = minhash.near_groups(odd_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in rows) == sorted([
        ("1", 2, "1", True), ("5", 2, "1", False), ("5", 2, "1", False), ("2", 0, "2", True), ("3", 0, "3", True), ("4", 0, "4", True),
        ("None", 2, "None", True), ("6", 1, "6", True), ("7", 3, "7", True), ("8", 1, "8", True)])
    assert minhash.near_groups(no_docs).count() == 0
    none = spark.createDataFrame([(None, "a b c d e f g"), (None, "q r s t u v w"), (4, "a b c d e f g"), (4, "q r s t u v w")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_groups(none).collect()) == [("4", 4, True), ("4", 4, True), ("None", 4, False), ("None", 4, False)]
