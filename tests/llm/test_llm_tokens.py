"""Encoding, plane files and packing: exact round trips and brute force."""

import io
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from tessera.llm import packing, planes
from tessera.llm.tokens import encode
from tessera.sources.sinks import scratch_path

PIECES = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "a", "Bcd", "é", "é", "́", "İ", "ß", "1", "２", "'s", "'ll",
          "!", ",", "<|endoftext|>", "日本", "👍", "​", "\x00", "\x01", "|", "Ⅷ"]


def direct(name, text, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_segments_give_the_ids_of_whole_texts(name):
    random.seed(3)
    texts = ["".join(random.choice(PIECES) for _ in range(random.randint(0, 30))) for _ in range(1500)] + ["ab" * 5000]
    t = Tokenizer.from_file(public_tokenizers.path(name))
    want = [[*e.ids, 7] for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encode(public_tokenizers.path(name), texts, 7)] == want


@pytest.mark.parametrize("n_planes", [planes.BYTES, planes.BITS])
@pytest.mark.parametrize("block", [1, 7, 64])
def test_plane_file_round_trip(n_planes, block):
    rng = np.random.default_rng(1)
    docs = [(i or None, rng.integers(0, 1 << 32, int(n), dtype=np.uint32)) for i, n in enumerate(rng.integers(1, 40, 30))]
    out = io.BytesIO()
    writer = planes.Writer(out, n_planes, block)
    for i, ids in docs:
        writer.add(i, ids)
    assert writer.close() == len(out.getvalue())
    reader = planes.Reader(io.BytesIO(out.getvalue()))
    at = 0
    for (i, ids), (doc_id, start, parts) in zip(docs, reader.documents(), strict=True):
        assert (doc_id, start) == (i, at) and np.concatenate(list(parts)).tolist() == ids.tolist()
        at += len(ids)
    for k in (0, 13, 29):
        assert reader.document(k).tolist() == docs[k][1].tolist()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_tokens_are_encoded_as_the_tokenizer_does(name):
    texts = ["a b", "a <|endoftext|> b", "", "<|endoftext|>", "x<|ENDOFTEXT|>", "<|startoftext|><|endoftext|> Z", "c d <|endof text|>"]
    got = [ids.tolist() for ids in encode(public_tokenizers.path(name), texts, 7)]
    assert got == [direct(name, text, 7) for text in texts]
    assert len(got[1]) <= 5 and len(got[4]) > 4


def test_planes_query(spark):
    at, want = 0, []
    for r in sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()):
        ids = np.array(direct("word_bpe_49k.json", r.text, 1), "<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, planes.op3_query(spark, SF_SMALL).collect())) == want


def test_planes_odd_rows(spark, odd_docs, no_docs):
    got = planes.read_shards(planes.write_shards(odd_docs, scratch_path(spark, "planes"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert [r.n_tokens for r in got if r.doc_id in (2, 3, 4)] == [1, 1, 1]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:], strict=False))
    assert planes.read_shards(planes.write_shards(no_docs, scratch_path(spark, "planes"))).count() == 0


def check_packing(rows, ids, capacity=packing.CAPACITY):
    """Every id once, pieces in order, sequences gapless; the number of sequences."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for k, pieces in docs.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert all(r.length == capacity for r in pieces[1:])
        assert sum(r.length for r in pieces) == len(ids[k])
    assert docs.keys() == ids.keys()
    return len(sequences)


def test_packing_query(spark):
    ids = {r.doc_id: direct("byte_bpe_50k.json", r.text, 0) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    least = -(-sum(map(len, ids.values())) // packing.CAPACITY)
    assert check_packing(packing.op8_query(spark, SF_SMALL).collect(), ids) <= least * 1.01 + 1
    pieces = packing.pieces(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert check_packing(packing.pack(pieces, part_pieces=25).collect(), ids) <= least * 1.05 + 1


def test_rounds_of_packing_share_no_sequence(spark, monkeypatch):
    """Partitions 128, 32 and 16 in rounds 0, 1 and 2: sequences of all rounds stay apart."""
    given = [16, 32, 128]
    monkeypatch.setattr(packing, "_parts", lambda *_: given.pop() if given else 16)
    rows = spark.range(7680).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "1L AS length")
    got = packing.pack(rows, capacity=200).collect()
    assert not given and sorted(r.doc_id for r in got) == list(range(7680))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r.offset)
    assert all(sorted(places) == list(range(len(places))) and len(places) <= 200 for places in sequences.values())


def test_repeated_rows_are_dealt_evenly(spark, monkeypatch):
    """Rows that agree in all their columns go to all partitions, not to one."""
    monkeypatch.setattr(packing, "_parts", lambda *_: 8)
    dealt = []
    packed = packing._packed
    monkeypatch.setattr(packing, "_packed", lambda *a: dealt.append(packed(*a)) or dealt[-1])
    rows = spark.range(800).selectExpr("cast(NULL AS long) AS doc_id", "0 AS piece", "0L AS start", "1L AS length")
    got = packing.pack(rows, capacity=200, rounds=0)
    assert got.columns == [*rows.columns, "sequence_id", "offset"] and got.count() == 800
    sizes = [r["count"] for r in dealt[0].groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 200


def test_packing_odd_rows(odd_docs, no_docs):
    docs = odd_docs.dropDuplicates(["doc_id"])
    ids = {r.doc_id: direct("byte_bpe_50k.json", r.text, 0) for r in docs.collect()}
    packed = packing.packed_documents(docs, with_ids=True)
    n = check_packing(packed.collect(), ids)
    whole = packing.sequences(packed).collect()
    assert len(whole) == n and sum(len(r.ids) for r in whole) == sum(map(len, ids.values()))
    assert packing.packed_documents(odd_docs).filter("doc_id = 5").count() == 2
    assert packing.packed_documents(no_docs).count() == 0


def least_bins(lengths, capacity):
    """Fewest bins, by search."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1:]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_bound_and_best_fit():
    random.seed(6)
    for _ in range(150):
        capacity = random.choice((10, 12, 30))
        lengths = [random.randint(1, capacity) for _ in range(random.randint(1, 8))]
        bins, offsets = packing.best_fit(np.array(lengths), capacity)
        bound = packing.bin_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        assert bound <= least_bins(lengths, capacity) <= len(set(bins.tolist()))
        assert all(o + n <= capacity for o, n in zip(offsets.tolist(), lengths, strict=True))


def test_generations_of_segments_change_nothing(monkeypatch):
    from tessera.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_SEGMENTS", 20)
    random.seed(8)
    path = public_tokenizers.path("byte_bpe_50k.json")
    made = tokens.ENCODERS["byte_bpe_50k.json"](path)
    words = [f"word{i % 37}x" for i in range(400)]
    texts = [" ".join(random.sample(words, 12)) for _ in range(60)]
    got = [ids for i in range(0, 60, 3) for ids in made.encode(texts[i:i + 3])]
    assert got == [np.array(direct("byte_bpe_50k.json", t, 0)[:-1], np.uint32).tobytes() for t in texts]
    assert len(made.kept) < 80
