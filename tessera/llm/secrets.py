"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every text is a blob, addressed by the SHA-256 of its bytes.  The ledger has one
row for each blob and version of a rule that was scanned, with the spans found
(none is a finding too).  A scan takes the (blob, rule version) pairs of the
input that the ledger lacks and appends what it finds; findings are joined back
to all rows that hold a blob.  No text is shuffled, however many blobs are new:
the unseen pairs, each by one of the rows that hold the blob, set bits in a filter
of fixed size for each rule, and a row is scanned where it lies by the rules whose
bit it meets.  Matches of pairs that met a bit by chance are dropped exactly.

Positions need no Python: the pieces between matches and the matches themselves
have lengths, and running sums of them are the spans, in code points.

Defined results: a null text is the empty text.  Rows of equal text share their
findings; a repeated row is reported again.  A null ``doc_id`` is reported like
any other.  An empty table gives an empty result and an unchanged ledger.  Extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import doc_text, read_table, write_stage
from tessera.sources.sinks import scratch_path

#: Unseen blobs (about 300 bytes each with their pairs) up to which the pairs are broadcast to the matches.
BROADCAST_BLOBS = 50_000
#: Bits of a bitmap (fixed by Spark's bitmap functions) and bitmaps of a rule: 4 MB a rule at most, whatever the input.
BITS, BUCKETS = 1 << 15, 1 << 10

LEDGER_SCHEMA = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """``value`` is the group whose length must be ``least`` or more; ``hint`` is a cheap necessary condition."""

    name: str
    version: int
    pattern: str
    value: int = 0
    least: int = 1
    hint: tuple[str, ...] = ()
    base: bool = False


#: The base kinds in order, then what this scan adds.  A run of hex digits (or of capitals and digits
#: after AKIA) is greedy, so asking for the length within the pattern finds the same matches as dropping short ones.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, (":", "="), True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", hint=("AKIA",), base=True),
    Rule("hex", 1, r"[0-9a-f]{24,}", base=True),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint=("-----BEGIN",)),
    Rule("url_login", 1, r"://[^\s/:@]+:[^\s/:@]+@", hint=("://",)),
)


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _matches(text: Column, rule: Rule) -> Column:
    """(rule, version, i, before, length, ok) of each match in order; null if there is none."""
    possible = None
    for h in rule.hint:
        possible = F.contains(text, F.lit(h)) if possible is None else possible | F.contains(text, F.lit(h))
    found = text.rlike(rule.pattern) if possible is None else F.when(possible, text.rlike(rule.pattern)).otherwise(False)
    pattern = F.lit(rule.pattern)
    whole, value = (F.regexp_extract_all(text, pattern, F.lit(g)) for g in (0, rule.value))
    rows = F.transform(F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), whole.alias("match"), value.alias("value")),
                       lambda x, i: F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), i.alias("i"),
                                             F.char_length(x["piece"]).alias("before"), F.char_length(x["match"]).alias("length"),
                                             (F.char_length(x["value"]) >= rule.least).alias("ok")))
    # the last piece has no match behind it
    return F.when(found, F.filter(rows, lambda x: x["length"].isNotNull()))


def _maybe_unseen(texts: DataFrame, unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows of ``texts`` that may stand for an unseen blob, with ``todo_<i>``: whether rule i may lack it."""
    place = F.pmod(F.xxhash64("blob", "doc_id"), F.lit(BITS * BUCKETS))
    bucket, bit = F.shiftright(place, BITS.bit_length() - 1).cast("int"), place.bitwiseAND(F.lit(BITS - 1))
    filters = unseen.withColumnRenamed("rep_id", "doc_id").groupBy(bucket.alias("bucket")).agg(
        *[F.bitmap_construct_agg(F.when(F.col("rule") == r.name, bit)).alias(f"bits_{i}") for i, r in enumerate(rules)])

    def met(bits: str) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(F.col("bit"), 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.bit_get(byte, F.col("bit").bitwiseAND(F.lit(7))) == 1

    placed = texts.select("blob", "text", bucket.alias("at"), bit.cast("int").alias("bit"))
    tested = placed.join(F.broadcast(filters), F.col("at") == F.col("bucket")).select(
        "blob", "text", *[met(f"bits_{i}").alias(f"todo_{i}") for i in range(len(rules))])
    return tested.filter(" or ".join(f"todo_{i}" for i in range(len(rules))))


def scan(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the blobs of ``docs`` and versions of ``rules`` that ``ledger`` lacks."""
    texts = doc_text(docs).withColumn("blob", _blob(F.col("text")))
    reps = texts.groupBy("blob").agg(F.min("doc_id").alias("rep_id"))
    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    pairs = reps.select("blob", "rep_id", F.inline(wanted))
    seen = ledger.select(F.col("blob").alias("b"), F.col("rule").alias("r"), F.col("version").alias("v"))
    unseen = write_stage(pairs.join(seen, (F.col("blob") == F.col("b")) & (F.col("rule") == F.col("r")) & (F.col("version") == F.col("v")), "left_anti"),
                         "unseen-pairs")
    none = F.array().cast("array<struct<rule:string,version:int,i:int,before:int,length:int,ok:boolean>>")
    per_rule = [F.coalesce(F.when(F.col(f"todo_{i}"), _matches(F.col("text"), r)), none) for i, r in enumerate(rules)]
    met = _maybe_unseen(texts, unseen, rules).select("blob", F.inline(F.concat(*per_rule)))
    pairs = unseen.select("blob", "rule", "version")
    few = unseen.select("blob").distinct().limit(BROADCAST_BLOBS + 1).count() <= BROADCAST_BLOBS
    # rows of one text and id are equal, copies of a text as well: one stands for them
    matches = met.join(F.broadcast(pairs) if few else pairs.hint("shuffle_hash"), ["blob", "rule", "version"], "left_semi").distinct()
    until = Window.partitionBy("blob", "rule", "version").orderBy("i")
    placed = matches.withColumn("end", (F.sum("before").over(until) + F.sum("length").over(until)).cast("int"))
    spans = placed.filter("ok").select("blob", "rule", "version", F.struct((F.col("end") - F.col("length")).alias("start"), "end").alias("span"))
    rows = unseen.select("blob", "rule", "version", F.lit(None).cast("struct<start:int,end:int>").alias("span")).unionByName(spans)
    return rows.groupBy("blob", "rule", "version").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def update_ledger(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans what the ledger at ``path`` lacks and appends it; the ledger.  Nothing is scanned twice, also after a retry."""
    spark = docs.sparkSession
    from_path = spark.read.schema(LEDGER_SCHEMA).parquet
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    new = write_stage(scan(docs, from_path(path) if there else empty_ledger(spark), rules), "new-findings")
    new.write.mode("append").parquet(path)
    return from_path(path)


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<base kind>, base_sha256, spans (kind:start:end) of every row."""
    names = [r.name for r in rules]
    current = None
    for r in rules:
        c = (F.col("rule") == r.name) & (F.col("version") == r.version)
        current = c if current is None else current | c
    # two scans at a time may have appended the same pair: its spans are the same
    once = ledger.filter(current & (F.size("spans") > 0)).groupBy("blob", "rule").agg(F.first("spans").alias("spans"))
    found = once.select("blob", "rule", F.inline("spans"))
    kind = F.array_position(F.array(*map(F.lit, names)), F.col("rule")).cast("int")
    spans = found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", kind.alias("k"), "end", "rule"))).alias("all"))
    base = [r.name for r in rules if r.base]

    def text(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(name: str):
        return lambda s: s["rule"] == name

    told = spans.select(F.col("blob").alias("b"), *[F.size(F.filter("all", of_kind(n))).cast("long").alias(f"n_{n}") for n in base],
                        text(F.filter("all", lambda s: s["rule"].isin(base))).alias("base"), text(F.col("all")).alias("spans"))
    told = write_stage(told, "findings")
    here = doc_text(docs).select("doc_id", _blob(F.col("text")).alias("blob"))
    joined = here.join(told, F.col("blob") == F.col("b"), "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{n}", F.lit(0)).cast("long").alias(f"n_{n}") for n in base],
                         F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def op6_incremental_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same findings by two scans: a stored ledger of the even ids, to which a scan of all documents adds what it lacks."""
    docs = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "blob-ledger")
    update_ledger(docs.filter("doc_id % 2 = 0"), path)
    return findings(docs, update_ledger(docs, path))


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return findings(docs, write_stage(scan(docs, empty_ledger(spark)), "ledger"))
