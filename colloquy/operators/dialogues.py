"""Fingerprints, dedup, split, census and structure of dialogues kept as one row for each turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import collapse_space, json_string, split_side


def gathered(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row for each dialogue with its messages in order."""
    one = F.struct(F.col(turn_col).alias("turn"), "role", F.col("text").alias("content"))
    return turns.groupBy(id_col).agg(F.array_sort(F.collect_list(one)).alias("messages"))


def fingerprint(messages: Column) -> Column:
    """SHA-256 of the canonical JSON of dialogues without calls: roles and contents with white space collapsed."""
    one = F.transform(messages, lambda m: F.concat(F.lit("["), json_string(m["role"]), F.lit(", "), json_string(collapse_space(m["content"])), F.lit(", []]")))
    return F.sha2(F.concat(F.lit('{"messages": ['), F.array_join(one, ", "), F.lit('], "tools": []}')), 256)


def structure(messages: Column) -> Column:
    """The first rule of turn order that a dialogue without calls breaks, or null."""
    return (
        F.when(~messages[0]["role"].isin("system", "user"), "must open with a system or user message")
        .when(F.exists(F.slice(messages, 2, F.greatest(F.size(messages), F.lit(1))), lambda m: m["role"] == "system"), "a system message may only come first")
        .when(F.element_at(messages, -1)["role"] != "assistant", "must end with an assistant message")
        .when(F.exists(messages, lambda m: m["role"] == "tool"), "tool result without a pending call")
    )


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, one without an order last. min_by aggregates before the shuffle, so a hot key is no hot
    task."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(key).agg(F.min_by(row, F.struct(F.isnull(order), F.col(order))).alias("__r")).select("__r.*")


def split(df: DataFrame, fp_col: str = "fp", salt: str = "v1", eval_fraction: float = 0.1) -> DataFrame:
    return df.withColumn("side", split_side(F.col(fp_col), salt, eval_fraction))


def census(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    return turns.agg(
        F.count_distinct(id_col).alias("dialogues"),
        F.count("*").alias("messages"),
        F.count_if(F.col("role") == "assistant").alias("assistant_messages"),
        F.count_if(F.col("role") == "tool").alias("tool_messages"),
    )


def examples(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row for each assistant turn, with prompt and target lengths in characters of the rendering
    ``<|role|>content<|end|>\\n``; the prompt ends with the assistant's opening tag. One window, no self-join."""
    before = Window.partitionBy(id_col).orderBy(turn_col).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.length("role") + F.length("text") + 4 + 8
    rows = turns.select(id_col, turn_col, "role", "text", F.coalesce(F.sum(whole).over(before), F.lit(0)).alias("before"))
    rows = rows.where(F.col("role") == "assistant")
    return rows.select(id_col, turn_col, (F.col("before") + 13).alias("prompt_tokens"), (F.length("text") + 8).cast("bigint").alias("target_tokens"))


def rollup(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    total = F.col("prompt_tokens") + F.col("target_tokens")
    return rows.groupBy(id_col).agg(F.count("*").alias("examples"), F.max(total).alias("longest_example"), F.sum(total).alias("epoch_tokens"), F.sum("target_tokens").alias("trained_tokens"))


def percentiles(df: DataFrame, col: str, fractions: tuple[float, ...]) -> DataFrame:
    """Nearest rank: the value at round-half-even(f * (n - 1)). Ranks come from counts of distinct values, so one row for
    each distinct value is ordered, not one for each row."""
    if not all(0 <= f <= 1 for f in fractions):
        raise ValueError("fractions must lie between 0 and 1")
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("c"))
    run = counts.select("v", F.sum("c").over(Window.orderBy("v")).alias("upto"), F.sum("c").over(Window.partitionBy()).alias("n"))
    wanted = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")
    return run.select("v", "upto", "n", wanted).where(F.col("upto") > F.bround(F.col("fraction") * (F.col("n") - 1))).groupBy("fraction").agg(F.min("v").alias("value"))


def histogram(df: DataFrame, col: str, edges: tuple[int, ...]) -> DataFrame:
    """Counts in [0, e1), [e1, e2), ..., [en, inf), empty ones kept."""
    place = sum((F.col(col) >= e).cast("int") for e in edges)
    labels = [f"{a}-{b - 1}" for a, b in zip((0, *edges), edges, strict=False)] + [f"{edges[-1]}+"]
    counts = df.groupBy(place.alias("place")).agg(F.count("*").alias("n"))
    buckets = df.sparkSession.createDataFrame(list(enumerate(labels)), "place int, bucket string")
    return F.broadcast(buckets).join(counts, "place", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def threshold_fits(df: DataFrame, col: str, limits: tuple[int, ...]) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(col) <= t).alias(str(t)) for t in limits])
    return one.select(F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"`{t}`").alias("fits")) for t in limits])))
