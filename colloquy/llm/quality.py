"""Quality rules with adaptive thresholds from mergeable quantile sketches. DataFrame operations only.

Each metric of a document is a whole number (parts per thousand, or tenths of characters), so a sketch is a histogram:
exact for the bounded metrics, in buckets of 2 % width beyond 1,000. Sketches merge by adding counts; a group of (lang,
source) with too few documents uses the merged sketch of its lang, and that of all documents after that. From each sketch
come quartiles and from these fences; a document outside a fence is rejected, besides the fixed base rule. The upper
fence of a bounded metric is no looser than those of the wider sketches plus the slack, so that a group full of junk
cannot put its own fence beyond the greatest value.

Defined results: null or empty text has no words and fails the base rule; null lang or source is a group of its own;
repeated rows count each; other columns are ignored or, in ``filter_quality``, carried along; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import SPACE, written

#: metric: (slack above the upper quartile at least, whether a lower fence holds too)
FENCES = {"symbols": (100, False), "dup_lines": (300, False), "repeats": (250, False), "word_tenths": (40, True)}
#: Metrics that cannot pass 1,000 (word lengths can, and differ by language).
BOUNDED = ("symbols", "dup_lines", "repeats")
#: Documents that a group needs for thresholds of its own.
LEAST = 50
#: Groups up to this number are sent to all executors (under 10 MB); more are joined by a shuffle.
BROADCAST_GROUPS = 50_000


def _less(text: Column, chars: str) -> Column:
    out = text
    for c in chars:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def measured(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (names after ``prefix``)."""
    p = lambda c: f"{prefix}{c}"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.withColumn(p("words"), F.filter(F.split(text, SPACE), lambda w: w != ""))
    out = out.withColumn(p("lines"), F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    words, grams = F.col(p("words")), F.col(p("grams"))
    n = F.size(words)
    # A gram is told by one 64-bit hash, of the hash of its first two words and the third.
    out = out.withColumn(
        p("grams"),
        F.when(
            n >= 3,
            F.zip_with(
                F.zip_with(words, F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b)),
                F.slice(words, 3, n),
                lambda ab, c: F.xxhash64(ab, c),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # zip_with pads the shorter side, so only the first n - 2 values are windows
    out = out.withColumn(p("grams"), F.slice(grams, 1, F.greatest(n - 2, F.lit(0))))
    ordered = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    near = lambda a, x, i: (F.get(a, i + 1)["g"] == x["g"]) | (F.coalesce(F.get(a, i - 1)["g"] == x["g"], F.lit(False)))
    out = out.withColumn(p("ordered"), F.when(F.size(F.array_distinct(grams)) < F.size(grams), ordered))
    o = F.col(p("ordered"))
    out = out.withColumn(p("hits"), F.array_sort(F.transform(F.filter(o, lambda x, i: F.coalesce(near(o, x, i), F.lit(False))), lambda x: x["i"])))
    h = F.col(p("hits"))
    gaps = F.zip_with(h, F.slice(h, 2, F.size(h)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)).cast("bigint"))
    repeated = F.when(h.isNull(), F.lit(0).cast("bigint")).otherwise(F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, x: s + x))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.cast("bigint").alias(p("n_words")),
        F.length(_less(text, " \t\n\x0b\x0c\r")).cast("bigint").alias(p("word_chars")),
        (F.length(text) - F.length(_less(text, "#*$%&|<>"))).cast("bigint").alias(p("n_symbols")),
        (F.size(p("lines")) - F.size(F.array_distinct(p("lines")))).cast("bigint").alias(p("n_dup_lines")),
        repeated.alias(p("n_repeat_words")),
        F.size(p("lines")).cast("bigint").alias(p("n_lines")),
    )


def metrics(prefix: str = "") -> dict[str, str]:
    """Each metric as SQL over the measures."""
    p = prefix
    return {
        "symbols": f"1000 * {p}n_symbols div greatest({p}word_chars, 1)",
        "dup_lines": f"1000 * {p}n_dup_lines div greatest({p}n_lines, 1)",
        "repeats": f"1000 * {p}n_repeat_words div greatest({p}n_words, 1)",
        "word_tenths": f"10 * {p}word_chars div greatest({p}n_words, 1)",
    }


def bucket_of(value: Column) -> Column:
    """The place of a value in the sketches, the scale in which the fences are."""
    return F.when(value < 1000, value).otherwise(1000 + F.floor(50 * F.log(value / 1000))).cast("bigint")


def failed_base(prefix: str = "") -> Column:
    return (F.col(f"{prefix}n_words") < 50) | (100 * F.col(f"{prefix}n_repeat_words") > 50 * F.col(f"{prefix}n_words"))


def sketches(rows: DataFrame, group_cols: list[str], prefix: str = "") -> DataFrame:
    """(g1, g2, level, metric, bucket, n): a histogram for each group, each first column of it, and all."""
    named = [F.struct(F.lit(m).alias("metric"), F.expr(e).cast("bigint").alias("value")) for m, e in metrics(prefix).items()]
    long = rows.select(F.col(group_cols[0]).alias("g1"), F.col(group_cols[1]).alias("g2"), F.inline(F.array(*named)))
    fine = long.groupBy("g1", "g2", "metric", bucket_of(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))
    levels = F.explode(F.array(F.lit(2), F.lit(1), F.lit(0))).alias("level")
    return (
        fine.select("*", levels)
        .withColumn("g1", F.when(F.col("level") > 0, F.col("g1")))
        .withColumn("g2", F.when(F.col("level") > 1, F.col("g2")))
        .groupBy("g1", "g2", "level", "metric", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def thresholds(rows: DataFrame, group_cols: list[str], prefix: str = "") -> DataFrame:
    """(g1, g2, level, n_docs, and <metric>_lo, <metric>_hi of each metric)."""
    hist = sketches(rows, group_cols, prefix)
    group = ["level", "g1", "g2", "metric"]
    run = Window.partitionBy(*group).orderBy("bucket")
    total = Window.partitionBy(*group)
    cum = hist.select("*", F.sum("n").over(run).alias("below"), F.sum("n").over(total).alias("n_docs"))
    at = lambda q: F.min(F.when(100 * F.col("below") >= q * F.col("n_docs"), F.col("bucket")))
    quart = cum.groupBy(*group).agg(at(25).alias("q1"), at(75).alias("q3"), F.max("n_docs").alias("n_docs"))
    out = []
    for m, (slack, low) in FENCES.items():
        mine = F.col("metric") == m
        wide = F.greatest(3 * (F.col("q3") - F.col("q1")), F.lit(slack))
        out.append(F.max(F.when(mine, F.col("q3") + wide)).alias(f"{m}_hi"))
        if low:
            out.append(F.max(F.when(mine, F.col("q1") - wide)).alias(f"{m}_lo"))
    return quart.groupBy("level", "g1", "g2").agg(F.max("n_docs").alias("n_docs"), *out)


def judged(rows: DataFrame, group_cols: list[str], prefix: str = "") -> DataFrame:
    """rows (measured, and read twice) with ``base_failed`` and ``kept``."""
    limits = written(thresholds(rows, group_cols, prefix), "thresholds")
    fence = [c for c in limits.columns if c.endswith(("_hi", "_lo"))]
    level = lambda k, keys: limits.where(F.col("level") == k).select(*[F.col(c).alias(f"__{c}") for c in keys], F.col("n_docs").alias(f"__n{k}"), *[F.col(c).alias(f"__{c}{k}") for c in fence])
    keep = F.broadcast if limits.count() <= BROADCAST_GROUPS else (lambda x: x)
    g1, g2 = (F.col(f"`{c}`") for c in group_cols)
    joined = rows.join(keep(level(2, ["g1", "g2"])), g1.eqNullSafe(F.col("__g1")) & g2.eqNullSafe(F.col("__g2")), "left").drop("__g1", "__g2")
    joined = joined.join(keep(level(1, ["g1"])), g1.eqNullSafe(F.col("__g1")), "left").drop("__g1")
    joined = joined.join(F.broadcast(level(0, [])), F.lit(True), "left")  # one row
    limit = lambda c: F.when(F.col("__n2") >= LEAST, F.col(f"__{c}2")).when(F.col("__n1") >= LEAST, F.col(f"__{c}1")).otherwise(F.col(f"__{c}0"))
    inside = F.lit(True)
    for m, e in metrics(prefix).items():
        hi = limit(f"{m}_hi")
        if m in BOUNDED:
            wider = F.least(F.when(F.col("__n1") >= LEAST, F.col(f"__{m}_hi1")), F.col(f"__{m}_hi0"))  # least() skips nulls
            hi = F.least(hi, wider + FENCES[m][0])
        inside = inside & (bucket_of(F.expr(e)) <= hi)
        if FENCES[m][1]:
            inside = inside & (bucket_of(F.expr(e)) >= limit(f"{m}_lo"))
    bad = failed_base(prefix)
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], bad.alias(f"{prefix}base_failed"), (~bad & F.coalesce(inside, F.lit(True))).alias(f"{prefix}kept"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The measures and verdict of every row, without the text."""
    lean = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"g_{k}") for k, c in enumerate(group_cols)])
    rows = written(measured(lean).drop("text"), "measured")
    out = judged(rows, ["g_0", "g_1"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def filter_quality(docs: DataFrame, text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Documents that are kept, with the columns they had. They are read and measured twice, for the thresholds and for the
    verdict: written in between they would stay in the shared folder, texts and all."""
    out = judged(measured(docs, text_col, prefix="__q_"), list(group_cols), prefix="__q_")
    # Kept rows never fail the base rule. As one comparison, no part of this moves below the joins, where all would be measured again.
    return out.where(F.col("__q_base_failed") < F.col("__q_kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
