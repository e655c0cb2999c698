"""Operator 6: secret scans with an incremental ledger of blobs.

Every version of every file is content-addressed. The ledger holds which blob was scanned with which
rule version and what was found, so a scan reads only pairs that are not in it: new contents under
all rules, old contents under new rules. Findings are joined back to every path that holds the blob.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BROADCAST_ROWS, columns_of, text_of, whole_row
from strata.session import scratch_folder, stage

#: The kinds in the order of their names in results (patterns of the contract are fixed values).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----)?")
WEB_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
HOST_TOKEN = re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})")


def assignments(text: str) -> Iterator[tuple[int, int]]:
    """A match whose value is short still uses up its characters, so it is dropped afterwards."""
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "apikey", "api_key")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield m.span()


def all_of(pattern: re.Pattern, needed: str = "") -> Callable[[str], Iterator[tuple[int, int]]]:
    """Finds ``pattern`` in texts that hold ``needed``. Runs that are too short can't hide longer ones here."""
    return lambda text: (m.span() for m in pattern.finditer(text)) if needed in text else iter(())


#: rule version: (kind, finder). A changed rule gets a new version and is run again over old blobs.
RULES = {
    "assign@1": ("assign", assignments),
    "access@1": ("access", all_of(ACCESS, "AKIA")),
    "hex@1": ("hex", all_of(HEX)),
    "private_key@1": ("private_key", all_of(PRIVATE_KEY, "PRIVATE KEY")),
    "web_token@1": ("web_token", all_of(WEB_TOKEN, "eyJ")),
    "host_token@1": ("host_token", all_of(HOST_TOKEN)),
}
BASE_KINDS = ("assign", "access", "hex")
LEDGER = "blob string, rules array<string>, found array<struct<rule: string, kind: string, start: long, end: long>>"


def scan_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns blob, text, missing (rule versions): one row of the ledger per blob."""
    shape = pa.schema([
        ("blob", pa.string()), ("rules", pa.list_(pa.string())),
        ("found", pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
    ])
    for batch in batches:
        blobs, texts, missing = (batch.column(c) for c in ("blob", "text", "missing"))
        found = []
        for text, rules in zip(texts, missing, strict=True):
            text = text.as_py()
            found.append([
                {"rule": rule, "kind": RULES[rule][0], "start": s, "end": e} for rule in rules.as_py() for s, e in RULES[rule][1](text)
            ])
        yield pa.RecordBatch.from_arrays([blobs.cast(pa.string()), missing.cast(pa.list_(pa.string())), pa.array(found, shape.field(2).type)], schema=shape)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries of the ledger in the folder ``ledger``, none if it doesn't exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan(docs: DataFrame, ledger: str, rules: tuple[str, ...] = tuple(RULES)) -> DataFrame:
    """Scan what the ledger lacks, add it there, and return the entries of this scan.

    ``docs``: text, one row per version; null texts are empty ones. Copies are one blob, so any
    number of repeated rows is scanned once, whole. An empty table adds nothing. Only hashes are compared with the
    ledger; while few blobs are unseen, no other text leaves its task.
    """
    spark = docs.sparkSession
    blob = F.sha2(text_of(), 256).alias("blob")
    seen = read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    wanted = F.array(*[F.lit(r) for r in rules])
    missing = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    listed = docs.select(blob).distinct().join(seen, "blob", "left").select("blob", missing.alias("missing"))
    listed = stage(listed.filter(F.size("missing") > 0), "ledger-unseen")
    texts = docs.select(blob, text_of().alias("text"))
    if listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        unseen = texts.join(F.broadcast(listed), "blob").dropDuplicates(["blob"])
    else:
        # Copies are dropped before the shuffle, so a text that very many paths hold is sent once a task.
        unseen = texts.dropDuplicates(["blob"]).join(listed, "blob")
    unseen = unseen.select("blob", "text", "missing")
    entries = stage(unseen.mapInArrow(scan_blobs, LEDGER), "ledger-entries")
    entries.write.mode("append").parquet(ledger)
    return entries


def findings(docs: DataFrame, ledger: str, rules: tuple[str, ...] = tuple(RULES)) -> DataFrame:
    """Every row of ``docs`` with _spans, all findings of its blob under ``rules``: start, place of the kind, kind, end.

    Findings of other versions of a rule do not count. A null text is the empty blob, repeated rows have equal
    spans, an empty table gives none, and blobs that were not scanned have no spans. All columns of
    ``docs`` stay, but one named ``_spans`` is replaced.
    """
    kinds = list(dict.fromkeys(RULES[r][0] for r in rules))
    entries = read_ledger(docs.sparkSession, ledger).filter(F.size("found") > 0)
    spans = entries.select("blob", F.explode("found").alias("f")).filter(F.col("f.rule").isin(list(rules))).select(
        "blob", F.struct("f.start", F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("f.kind")).alias("place"), "f.kind", "f.end").alias("s")
    )
    # Written before the join, so that Spark can split a blob that very many paths hold.
    spans = stage(spans.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("_spans")), "ledger-findings")
    docs = docs.drop("_spans")
    rows = docs.select(whole_row(docs), F.sha2(text_of(), 256).alias("_blob"))
    joined = rows.join(spans.withColumnRenamed("blob", "_found"), F.col("_blob") == F.col("_found"), "left")
    none = F.array().cast(spans.schema["_spans"].dataType)
    return joined.select(*columns_of(docs), F.coalesce("_spans", none).alias("_spans"))


def op6(spark, sf_dir: str) -> DataFrame:
    """The query: secrets of all documents through a new ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = f"{scratch_folder(spark)}/ledger-{uuid4().hex}"
    scan(docs, ledger)
    paths = findings(docs.select("doc_id", "text"), ledger).drop("text")
    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def listed(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return paths.select("doc_id", *map(number, BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"))


ORACLE = r"""
WITH RECURSIVE kinds(place, kind, pattern, least) AS (VALUES
    (1, 'assign', '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', 0),
    (2, 'access', 'AKIA[A-Z0-9]+', 20),
    (3, 'hex', '[0-9a-f]+', 24),
    (4, 'private_key', '-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----)?', 0),
    (5, 'web_token', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', 0),
    (6, 'host_token', '\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})', 0)),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT doc_id, text, place, kind, least, regexp_extract_all(text, pattern) AS ms FROM d, kinds
  WHERE CASE kind WHEN 'hex' THEN regexp_matches(text, '[0-9a-f]{24}') ELSE regexp_matches(text, pattern) END),
r AS (
  SELECT doc_id, text, place, kind, least, ms, 0 AS i, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS e FROM m
  UNION ALL
  SELECT doc_id, text, place, kind, least, ms, i + 1, e + instr(substr(text, e + 1), ms[i + 1]) - 1,
    e + instr(substr(text, e + 1), ms[i + 1]) - 1 + length(ms[i + 1])
  FROM r WHERE i < len(ms)),
found AS (SELECT doc_id, place, kind, s, e, kind || ':' || s || ':' || e AS t FROM r
  WHERE i > 0 AND length(ms[i]) >= least AND (kind <> 'assign' OR length(regexp_extract(ms[i],
    '(?i)^(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6)),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
    string_agg(t, ',' ORDER BY s, place) FILTER (place <= 3) AS base, string_agg(t, ',' ORDER BY s, place) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
