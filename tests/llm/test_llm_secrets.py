"""Secret scans against regular expressions, and the ledger's increments."""

import hashlib
import random
import re
from dataclasses import replace

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401

from tessera.llm import secrets
from tessera.llm.common import write_stage
from tessera.sources.sinks import scratch_path

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def expected(t):
    t = t or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    told = ",".join(f"{x[3]}:{x[0]}:{x[2]}" for x in sorted(found))
    return *(sum(x[1] == k for x in found) for k in range(3)), hashlib.sha256(told.encode()).hexdigest(), told


def check(rows, got):
    want = sorted((str(i), *expected(t)[:4]) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    for r in got:
        if len(texts[r.doc_id]) == 1:
            base = set(filter(None, expected(texts[r.doc_id][0])[4].split(",")))
            assert base <= set(r.spans.split(","))


def scanned(df):
    return secrets.findings(df, write_stage(secrets.scan(df, secrets.empty_ledger(df.sparkSession)), "ledger")).collect()


def test_random_texts(spark):
    random.seed(2)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abc", "abcdef123", "AKIA",
             "ABCDEFGHIJKLMNOP", "0123456789abcdef", "é", "👍", "\n", "x", "-----BEGIN RSA PRIVATE KEY-----", "://u:p@"]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 25)))) for i in range(1200)]
    got = scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    check(rows, got)
    assert any("url_login" in r.spans for r in got) and any("private_key" in r.spans for r in got)


def test_query_and_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, secrets.op6_query(spark, SF_SMALL).collect())
    check([(r.doc_id, r.text) for r in odd_docs.collect()], scanned(odd_docs))
    assert scanned(no_docs) == []


def test_no_python_in_the_plan(spark, capsys):
    secrets.scan(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), secrets.empty_ledger(spark)).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_only_unseen_pairs_are_scanned(spark):
    path = scratch_path(spark, "ledger")
    first = spark.createDataFrame([(1, "token=abcdefgh"), (2, "nothing")], "doc_id long, text string")
    n_rules = len(secrets.RULES)
    assert secrets.update_ledger(first, path).count() == 2 * n_rules
    more = first.unionByName(spark.createDataFrame([(3, "token=abcdefgh"), (4, "secret: 12345678")], "doc_id long, text string"))
    ledger = secrets.update_ledger(more, path)
    assert ledger.count() == 3 * n_rules  # row 3 holds a known blob
    assert secrets.update_ledger(more, path).count() == 3 * n_rules  # a retry adds nothing
    check([(r.doc_id, r.text) for r in more.collect()], secrets.findings(more, ledger).collect())
    newer = (replace(secrets.RULES[0], version=2), *secrets.RULES[1:])
    assert secrets.scan(more, ledger, newer).filter("rule = 'assign' and version = 2").count() == 3
    assert secrets.scan(more, ledger, newer).count() == 3


def test_doubled_ledger_rows_change_nothing(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh and AKIA" + "A" * 16), (2, "nothing")], "doc_id long, text string")
    ledger = write_stage(secrets.scan(docs, secrets.empty_ledger(spark)), "ledger")
    assert sorted(map(str, secrets.findings(docs, ledger.unionByName(ledger)).collect())) == sorted(map(str, secrets.findings(docs, ledger).collect()))


def test_few_unseen_blobs_move_no_text(spark, monkeypatch, capsys):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('token=abcdefgh', id) AS text")
    path = scratch_path(spark, "ledger")
    secrets.update_ledger(docs.filter("doc_id >= 20"), path)
    ledger = spark.read.schema(secrets.LEDGER_SCHEMA).parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = secrets.scan(docs, ledger)
        new.explain()
        few = capsys.readouterr().out
        monkeypatch.setattr(secrets, "BROADCAST_BLOBS", 5)
        again = secrets.scan(docs, ledger)
        again.explain()
        many = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in few and "ShuffledHashJoin" not in few and "ShuffledHashJoin" in many
    assert new.count() == 20 * len(secrets.RULES) and sorted(map(str, new.collect())) == sorted(map(str, again.collect()))


def test_incremental_query_equals_the_full_one(spark):
    full, parts = secrets.op6_query(spark, SF_SMALL), secrets.op6_incremental_query(spark, SF_SMALL)
    assert full.columns == parts.columns and sorted(map(str, full.collect())) == sorted(map(str, parts.collect()))


def test_no_text_passes_an_exchange(spark, monkeypatch, capsys):
    """Texts are scanned where they lie, for few unseen blobs and for many, and chance bits add nothing."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('token=abcdefgh', id % 700) AS text")
    path = scratch_path(spark, "ledger")
    secrets.update_ledger(docs.filter("doc_id < 300"), path)
    ledger = spark.read.schema(secrets.LEDGER_SCHEMA).parquet(path)
    for limit in (50_000, 5):
        monkeypatch.setattr(secrets, "BROADCAST_BLOBS", limit)
        new = secrets.scan(docs, ledger)
        new.explain("formatted")
        plan = capsys.readouterr().out
        assert not re.search(r"Exchange\nInput[^\n]*\btext#", plan)
        want = sorted(map(str, new.collect()))
        assert new.count() == 400 * len(secrets.RULES)
    monkeypatch.setattr(secrets, "BITS", 1 << 3)  # so full that every row meets a bit
    monkeypatch.setattr(secrets, "BUCKETS", 1)
    assert sorted(map(str, secrets.scan(docs, ledger).collect())) == want
