"""Line dedup by a log-template tree. DataFrame operations only.

A line is parsed at fixed depth: by its token count, then by its leading tokens, which tell its leaf, with tokens that
hold a digit as fields. Within a leaf a token is constant where enough documents of the leaf have it at its place, and a
field otherwise, so the lines of a leaf fall under templates: "session opened for user <*> by root". A line whose fields
outnumber its constants, or that has no constant beyond the leading tokens, is its own template. Templates that recur
across documents are dropped.

Tokens leave the documents only for lines of leaves that are worth it, and once for each different line: leaves are
counted first, and those that recur without all their lines recurring are found by a bounded table of slots.

Defined results: null or empty text has no lines with tokens and stays as it is (null becomes empty); blank lines are
never dropped; rows that repeat an id and text count as one document and get the same result; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, texts

#: Documents in which a template must occur to be dropped, and a token to be constant; leading tokens that are levels of
#: the tree; a constant's least share of its leaf, in parts of 100.
LEAST_DOCS, LEADING, SHARE = 5, 2, 1
FIELD = "[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*"
#: Slots of the table that goes to all executors: at most so many long values, about 32 MB.
SLOTS = 1 << 20
#: Parts in which the rows of a recurring template meet it.
PARTS = 8


def tree_paths(text: Column, tokens: bool = False) -> Column:
    """For each line of the text its path (the hash of the masked line) and its leaf, or its masked tokens if these are
    asked for; null for a blank line."""
    masked = F.when(text.rlike("[0-9]"), F.regexp_replace(text, FIELD, "<*>")).otherwise(text)

    def parsed(t):
        path = F.xxhash64(F.concat_ws(" ", t))
        leaf = F.xxhash64(F.size(t), F.concat_ws(" ", F.slice(t, 1, LEADING)))
        return F.when(F.size(t) > 0, F.struct(path.alias("path"), t.alias("tokens") if tokens else leaf.alias("leaf")))

    def line(one):
        return F.transform(F.array(F.filter(F.split(one, "[\\x20\\x09\\x0B-\\x0D]+"), lambda t: t != "")), parsed)[0]

    return F.transform(F.split(masked, "\n"), line)


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = texts(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    return rows.withColumn("row", F.xxhash64("doc_id", "body"))


def templates(rows: DataFrame, seen: DataFrame, scratch: Scratch, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(path, template) of the lines that fall under a template with fields of words; ``seen`` has (path, leaf, row)."""
    paths = scratch.written(seen.groupBy("path", "leaf").agg(F.count("*").alias("n")), "paths")
    leaves = paths.groupBy("leaf").agg(F.sum("n").alias("support"), F.count("*").alias("kinds"), F.min("n").alias("least"))
    leaves = leaves.where((F.col("support") >= least_docs) & (F.col("kinds") > 1) & (F.col("least") < least_docs)).select("leaf", "support")
    some = scratch.written(paths.join(leaves, "leaf"), "leaves")
    scratch.drop(paths)
    slot = F.pmod("path", F.lit(SLOTS)).alias("slot")
    lines = rows.select(F.explode(tree_paths(F.col("body"), tokens=True)).alias("line")).where("line IS NOT NULL").select("line.path", "line.tokens")
    lines = lines.withColumn("slot", F.pmod("path", F.lit(SLOTS))).join(F.broadcast(some.select(slot).distinct()), "slot", "left_semi")
    hashed = F.transform("tokens", lambda t: F.when(t == "<*>", F.lit(0).cast("long")).otherwise(F.xxhash64(t)))
    kinds = lines.select("path", hashed.alias("tokens")).groupBy("path").agg(F.first("tokens").alias("tokens")).join(some, "path")
    kinds = scratch.written(kinds, "kinds")
    scratch.drop(some)
    # A token at a place of a leaf; 0 stands for a field of digits.
    placed = F.transform("tokens", lambda t, i: F.when(t != 0, F.xxhash64(i, t)).otherwise(F.lit(0).cast("long")))
    tokens = kinds.select("path", "leaf", "support", "n", F.posexplode(placed).alias("place", "token"))
    counts = tokens.where("token <> 0").groupBy("leaf", "token").agg(F.sum("n").alias("c"), F.max("support").alias("support"))
    constant = counts.where((F.col("c") >= least_docs) & (100 * F.col("c") >= SHARE * F.col("support"))).select("leaf", "token", F.lit(True).alias("constant"))
    tokens = tokens.join(constant, ["leaf", "token"], "left").withColumn("field", F.col("constant").isNull() & (F.col("token") != 0))
    # Back to lines, in time linear in their tokens; 1 stands for a field of a word.
    form = F.array_sort(F.collect_list(F.struct("place", F.when(F.col("field"), F.lit(1).cast("long")).otherwise(F.col("token")).alias("token"))))
    beyond = F.count_if((F.col("place") >= LEADING) & F.col("constant").isNotNull())
    kept = tokens.groupBy("path", "leaf").agg(form.alias("form"), F.count("*").alias("m"), F.count_if("field").alias("fields"), beyond.alias("beyond"))
    kept = kept.where("fields > 0 AND 2 * fields <= m AND beyond > 0")
    found = kept.select("path", F.xxhash64("leaf", F.transform("form", lambda x: x["token"])).alias("template"))
    out = scratch.written(found, "templates")
    scratch.drop(kinds)
    return out


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, body, drop array<int>): rows once each, with the places (from 0) of the lines to drop, in order."""
    scratch = Scratch(docs.sparkSession)
    rows = _bodies(docs, id_col, text_col)
    lines = rows.select("row", F.posexplode(tree_paths(F.col("body"))).alias("place", "line")).where("line IS NOT NULL")
    seen = scratch.written(lines.groupBy("line.path", "line.leaf", "row").agg(F.collect_set("place").alias("places")), "lines")
    found = templates(rows, seen, scratch, least_docs)
    named = seen.join(found, "path", "left").select("row", "places", F.coalesce("template", "path").alias("template"))
    each = scratch.written(named.groupBy("template", "row").agg(F.flatten(F.collect_list("places")).alias("places")), "named")
    often = each.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= least_docs).select("template")
    # A template that holds a large part of all rows meets them in parts.
    parts = often.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    dropped = each.withColumn("part", F.pmod("row", F.lit(PARTS).cast("long"))).join(parts, ["template", "part"])
    drop = scratch.written(dropped.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("drop")), "drop")
    scratch.drop(seen, found, each)
    scratch.release()
    # One plan at every size: texts meet their places by a shuffle.
    return rows.join(drop.hint("merge"), "row", "left").drop("row")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) without the recurring lines."""
    found = recurring_lines(docs, id_col, text_col, least_docs)
    lines = F.split("body", "\n")
    # The lines that stay, in time linear in their number: by the places left over.
    places = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.transform("drop", lambda i: i + 1))
    left = F.transform(F.array(F.struct(lines.alias("all"), places.alias("left"))), lambda x: F.transform(x["left"], lambda i: F.element_at(x["all"], i)))[0]
    text = F.when(F.col("drop").isNull(), F.col("body")).otherwise(F.concat_ws("\n", left))
    n = F.coalesce(F.size("drop"), F.lit(0))
    return found.select("doc_id", text.alias("text"), F.size(lines).cast("bigint").alias("n_lines"), F.greatest(n, F.lit(0)).cast("bigint").alias("n_dropped"))
