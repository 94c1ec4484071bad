"""Exact dedup by an extendible-hash index on shared files. DataFrame operations only.

Texts are equal when identical after replacing each run of white space by one space. The directory comes first, from
counts of distinct 64-bit keys: it starts as one bucket and doubles while a bucket is overfull, so a bucket's local depth
is the least at which the keys under its prefix fit a page. Each bucket, a range of keys, has an owner task, to which the
directory sends its rows; there texts with one key are chained, compared byte by byte, and each place in a chain is one
group. Owners write their pages to the shared folder, and results are read from these.

Keys with more than one in HEAVY of all rows, of which there are fewer than HEAVY whatever the input, are aggregated
where they lie before their groups go to the owner, so that no owner gets all copies of a frequent text.

Defined results: null text counts as empty; empty texts are one group; ties cannot occur, as the smallest doc_id stays
(rows that repeat a doc_id and text are each reported and count in group_size); a null doc_id stays only where all of a
group are null; other columns are ignored (``drop_exact_duplicates`` carries them along, whatever their names); an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import SPACE, texts, written

#: Bits of the directory at most: 2 ** SLOT_BITS entries of (slot, bucket), about 10 MB, go to all executors.
SLOT_BITS = 18
#: Distinct keys of a page. A bucket that the directory cannot split any more has overflow pages.
PAGE = 512
HEAVY = 10_000


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; the regular expression runs only where a run is longer than one."""
    out = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return F.when(F.contains(out, F.lit("  ")), F.regexp_replace(out, SPACE, " ")).otherwise(out)


def slot_of(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - SLOT_BITS)


def directory(keys: DataFrame, page_entries: int = PAGE) -> DataFrame:
    """(slot, bucket) of every slot with keys, a bucket as depth:prefix; ``keys`` has each distinct key once."""
    cells = keys.groupBy(slot_of(F.col("key")).alias("slot")).agg(F.count("*").alias("n"))
    levels = cells.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(SLOT_BITS))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {SLOT_BITS} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("n")).where((F.col("n") <= page_entries) | (F.col("depth") == SLOT_BITS))
    found = levels.join(fits.select("depth", "prefix"), ["depth", "prefix"]).groupBy("slot").agg(F.min("depth").alias("depth"))
    return found.select("slot", F.concat_ws(":", "depth", F.expr(f"shiftrightunsigned(slot, {SLOT_BITS} - depth)")).alias("bucket"))


def _chained(rows: DataFrame) -> DataFrame:
    """rows with their place in the chain of their key; equal bodies share one."""
    place = F.dense_rank().over(Window.partitionBy("bucket", "key").orderBy("body"))
    return rows.withColumn("chain", place)


def _routed(docs: DataFrame, id_col: str, text_col: str, page_entries: int, key_of) -> tuple[DataFrame, DataFrame, list[str]]:
    """docs with key and bucket, in two parts: the rows of the owners, and those of heavy keys. Names of ours begin with a
    prefix that no column has."""
    prefix = "__dedup"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    key, slot, bucket, heavy = (f"{prefix}_{c}" for c in ("key", "slot", "bucket", "heavy"))
    own = key_of(normalised(F.col(text_col).cast("string")))
    counts = written(docs.groupBy(own.alias("key")).agg(F.count("*").alias("n")), "keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = counts.where((F.col("n") * HEAVY > total) & (F.col("n") > 1)).select(F.col("key").alias(key), F.lit(True).alias(heavy))
    places = written(directory(counts, page_entries), "directory").toDF(slot, bucket)
    rows = docs.withColumn(key, own).withColumn(slot, slot_of(F.col(key)))
    rows = rows.join(F.broadcast(places), slot).join(F.broadcast(many), key, "left").drop(slot)
    light = rows.where(F.col(heavy).isNull()).drop(heavy).repartition(F.col(bucket))
    return light, rows.where(F.col(heavy)).drop(heavy), [key, bucket]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_entries: int = PAGE, key_of=F.xxhash64) -> DataFrame:
    """Pages (bucket, key, chain, text_sha256, doc_id, keep_id, group_size, heavy), written to the shared folder by their
    owners: a row for each document, and one, without its id, for each group of a heavy key."""
    source = texts(docs, id_col, text_col)
    light, heavy, (key, bucket) = _routed(source.select("doc_id", "text"), "doc_id", "text", page_entries, key_of)
    body = normalised(F.col("text")).alias("body")
    light = _chained(light.select(F.col(bucket).alias("bucket"), F.col(key).alias("key"), "doc_id", body))
    light = light.select("bucket", "key", "chain", F.sha2("body", 256).alias("text_sha256"), "doc_id")
    group = Window.partitionBy("bucket", "key", "chain")
    light = light.select("*", F.min("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"), F.lit(False).alias("heavy"))
    heavy = heavy.select(F.col(bucket).alias("bucket"), F.col(key).alias("key"), "doc_id", body)
    heavy = _chained(heavy.groupBy("bucket", "key", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    none = F.lit(None).cast(source.schema["doc_id"].dataType)
    heavy = heavy.select("bucket", "key", "chain", F.sha2("body", 256).alias("text_sha256"), none.alias("doc_id"), "keep_id", "group_size", F.lit(True).alias("heavy"))
    return written(light.unionByName(heavy), "pages")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_entries: int = PAGE, key_of=F.xxhash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, bucket, chain) of every row."""
    index = build_index(docs, id_col, text_col, page_entries, key_of)
    body = normalised(F.col("text"))
    groups = index.where("heavy").select("key", "text_sha256", "keep_id", "group_size", "bucket", "chain")
    rows = texts(docs, id_col, text_col).select("doc_id", body.alias("body")).withColumn("key", key_of(F.col("body")))
    # Fewer than HEAVY keys: only their rows are read again, as ids and digests.
    rows = rows.join(F.broadcast(groups.select("key").distinct()), "key", "left_semi").select("doc_id", "key", F.sha2("body", 256).alias("text_sha256"))
    found = index.where("NOT heavy").drop("heavy").unionByName(rows.join(groups, ["key", "text_sha256"]))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "chain")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_entries: int = PAGE, key_of=F.xxhash64) -> DataFrame:
    """Of each group the row with the smallest id, with all its columns; a row that repeats both id and text stays once,
    and a row without an id only where the whole group has none. Owners get whole rows, so texts move once."""
    light, heavy, (key, bucket) = _routed(docs, id_col, text_col, page_entries, key_of)
    own = [F.col(f"`{c}`") for c in docs.columns]
    names = [f"c{i}" for i in range(len(own))]
    whole = F.struct(*[c.alias(n) for c, n in zip(own, names, strict=True)]).alias("row")
    parts = [F.col(bucket).alias("bucket"), F.col(key).alias("key"), normalised(F.col(text_col).cast("string")).alias("body"), whole]
    at = F.col(f"row.{names[docs.columns.index(id_col)]}")
    order = (at.isNull(), at)
    first = F.row_number().over(Window.partitionBy("bucket", "key", "chain").orderBy(*order))
    light = _chained(light.select(*parts)).drop("body").withColumn("nth", first).where("nth = 1").select("row")
    heavy = heavy.select(*parts).groupBy("bucket", "key", "body").agg(F.min_by("row", F.struct(*order)).alias("row")).select("row")
    return light.unionByName(heavy).select(*[F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns, strict=True)])
