"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by its content. The ledger, a Parquet table in a shared folder, has a row for each
scanned (blob, rule version); a run scans only pairs that it lacks, appends them, and joins findings back to all rows
(paths) that hold the blob. Copies are collapsed by a partial aggregation before they are shuffled.

Defined results: null text counts as empty and has no findings; repeated rows get the same findings; overlapping
matches of different kinds are all reported, and redacted as their union; other columns are ignored (``redact`` carries
them along); an empty table gives an empty result. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint_dir, shared_path, texts

#: Changes whenever a rule does, so that old ledger rows no longer answer for new rules.
RULES_VERSION = "1"
KINDS = ("assign", "access", "hex", "pem")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run, as of [0-9a-f]+, of 16 or more
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")
#: Findings up to this number are sent to all executors when texts are redacted; more are joined by a shuffle.
BROADCAST_FINDINGS = 100_000

FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all findings, in that order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        out += [(m.start(), 3, m.end()) for m in PEM.finditer(text)]
    return sorted(out)


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _scan(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [find(t or "") for t in batch.column("text").to_pylist()]
        base = [[x for x in f if x[1] < 3] for f in found]
        count = [pa.array([sum(x[1] == k for x in f) for f in found], pa.int64()) for k in range(3)]
        digest = pa.array([hashlib.sha256(_joined(f).encode()).hexdigest() for f in base], pa.string())
        spans = pa.array([_joined(f) for f in found], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("blob"), *count, digest, spans], ["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def _addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    return texts(docs, id_col, text_col).select("doc_id", F.sha2(body, 256).alias("blob"))


def update_ledger(docs: DataFrame, ledger: str, text_col: str = "text", version: str = RULES_VERSION) -> DataFrame:
    """Scan what the ledger at this path lacks and append it; returns the ledger's rows of this rule version."""
    spark = docs.sparkSession
    blobs = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    blobs = blobs.select(F.sha2("text", 256).alias("blob"), "text")
    schema = f"blob string, {FOUND}, rule_version string"
    known = lambda: spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == version)
    kept = _exists(spark, ledger)
    if kept:
        blobs = blobs.join(known().select("blob"), "blob", "left_anti")
    found = blobs.mapInArrow(_scan, f"blob string, {FOUND}").withColumn("rule_version", F.lit(version))
    found.write.mode("append").parquet(ledger)
    rows = known().drop("rule_version")
    return rows.dropDuplicates(["blob"]) if kept else rows  # concurrent or repeated runs may have added a blob twice


def _exists(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row.

    Without a ledger path a new one is begun; a kept path makes later runs incremental.
    """
    ledger = ledger or shared_path(docs.sparkSession, "ledger")
    known = update_ledger(docs, ledger, text_col)
    found = _addressed(docs, id_col, text_col).join(known, "blob", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex")]
    return found.select("doc_id", *counts, F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]", ledger: str | None = None) -> DataFrame:
    """docs with every finding replaced by the mask; rows without findings pass unchanged."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    known = update_ledger(docs, ledger or shared_path(spark, "ledger"), text_col).where("spans <> ''").select(F.col("blob").alias("__secret_blob"), F.col("spans").alias("__secret_spans"))
    if known.count() <= BROADCAST_FINDINGS:
        known = F.broadcast(known)
    if {"__secret_blob", "__secret_spans"} & set(docs.columns):
        raise ValueError("the columns __secret_blob and __secret_spans are reserved")
    rows = docs.withColumn("__secret_blob", F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)).join(known, "__secret_blob", "left")

    @F.pandas_udf("string")
    def masked(text, spans):
        def one(t, s):
            out, at = [], 0
            for a, b in sorted(tuple(map(int, x.split(":")[1:])) for x in s.split(",")):
                if a >= at:
                    out += [t[at:a], mask]
                at = max(at, b)
            return "".join(out) + t[at:]

        return text.combine(spans, one)

    clean = rows.where("__secret_spans IS NULL").drop("__secret_blob", "__secret_spans")
    dirty = rows.where("__secret_spans IS NOT NULL").withColumn(text_col, masked(F.col(text_col).cast("string"), "__secret_spans"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return clean.select(*own).unionByName(dirty.select(*own))
