"""Order-insensitive pairing of expected and predicted calls, and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def paired(calls: DataFrame) -> DataFrame:
    """(turn_id, name, expected, predicted, exact, name_matches) from calls (turn_id, side, name, eq).

    Pairing within (turn, name) is the multiset intersection of arguments first, then of what is left; both are sums of
    minima of counts, so no pair of calls is made.
    """
    is_side = lambda s: F.count_if(F.col("side") == s)
    kinds = calls.groupBy("turn_id", "name", "eq").agg(is_side("expected").alias("e"), is_side("predicted").alias("p"))
    out = kinds.groupBy("turn_id", "name").agg(F.sum("e").alias("expected"), F.sum("p").alias("predicted"), F.sum(F.least("e", "p")).alias("exact"))
    return out.withColumn("name_matches", F.least("expected", "predicted"))


def argument_matches(calls: DataFrame) -> DataFrame:
    """(turn_id, name, expected_arguments, matched_arguments) of name-matched pairs; calls have pos and args, an array of
    (key, eq). Exact pairs match in full; the i-th left over expected call is held against the i-th predicted one."""
    same = Window.partitionBy("turn_id", "side", "name", "eq").orderBy("pos")
    kind = Window.partitionBy("turn_id", "name", "eq")
    rows = calls.withColumn("rank", F.row_number().over(same))
    common = F.least(F.count_if(F.col("side") == "expected").over(kind), F.count_if(F.col("side") == "predicted").over(kind))
    rows = rows.withColumn("exact", F.col("rank") <= common)
    left = rows.where(~F.col("exact")).withColumn("place", F.row_number().over(Window.partitionBy("turn_id", "side", "name").orderBy("pos")))
    e = left.where(F.col("side") == "expected").select("turn_id", "name", "place", F.col("args").alias("ea"))
    p = left.where(F.col("side") == "predicted").select("turn_id", "name", "place", F.col("args").alias("pa"))
    loose = e.join(p, ["turn_id", "name", "place"]).select("turn_id", "name", F.size("ea").alias("n"), F.size(F.array_intersect("ea", "pa")).alias("m"))
    full = rows.where((F.col("side") == "expected") & F.col("exact")).select("turn_id", "name", F.size("args").alias("n"), F.size("args").alias("m"))
    return loose.unionByName(full).groupBy("turn_id", "name").agg(F.sum("n").alias("expected_arguments"), F.sum("m").alias("matched_arguments"))


def judged_turns(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """turns (turn_id, branch, malformed) with the verdict of each turn."""
    sums = pairs.groupBy("turn_id").agg(*[F.sum(c).alias(c) for c in ("expected", "predicted", "exact", "name_matches")])
    rows = turns.join(sums, "turn_id", "left").na.fill(0, ["expected", "predicted", "exact", "name_matches"])
    acted = (F.col("predicted") > 0) | (F.col("malformed") > 0)
    return rows.select(
        "*",
        ((F.col("malformed") == 0) & (F.col("expected") == F.col("predicted")) & (F.col("expected") == F.col("exact"))).alias("correct"),
        (acted & (F.col("expected") == 0)).alias("false_fire"),
        (~acted & (F.col("expected") > 0)).alias("missed"),
    )


_SUMS = ("expected", "predicted", "exact", "name_matches")


def report(judged: DataFrame, by: str | None = None) -> DataFrame:
    """Totals and rates, over all turns or for each value of a column; rates without a base are null."""
    base = judged.where(F.col(by).isNotNull()).groupBy(by) if by else judged.groupBy()
    out = base.agg(
        F.count("*").alias("turns"),
        *[F.count_if(c).alias(f"{c}_turns") for c in ("correct", "false_fire", "missed")],
        F.sum("malformed").cast("bigint").alias("malformed"),
        *[F.sum(c).cast("bigint").alias(c) for c in _SUMS],
    )
    return out.select("*", F.try_divide("correct_turns", "turns").alias("turn_accuracy"), F.try_divide("exact", "expected").alias("exact_recall"), F.try_divide("name_matches", "predicted").alias("name_precision"))


def by_tool(pairs: DataFrame) -> DataFrame:
    out = pairs.groupBy("name").agg(*[F.sum(c).cast("bigint").alias(c) for c in _SUMS])
    return out.select("*", F.try_divide("exact", "expected").alias("exact_recall"), F.try_divide("name_matches", "predicted").alias("name_precision"))


_MEASURES = (*_SUMS, "expected_arguments", "matched_arguments")


def _rates() -> list:
    """All derived rates; without a base they are null."""
    rate = lambda a, b, name: F.try_divide(a, b).alias(name)
    return [
        rate("name_matches", "predicted", "name_precision"),
        rate("name_matches", "expected", "name_recall"),
        rate("exact", "predicted", "exact_precision"),
        rate("exact", "expected", "exact_recall"),
        rate("matched_arguments", "expected_arguments", "argument_accuracy"),
    ]


def measured_pairs(calls: DataFrame) -> DataFrame:
    """(turn_id, name) with all six measures."""
    out = paired(calls).join(argument_matches(calls), ["turn_id", "name"], "left")
    return out.na.fill(0, ["expected_arguments", "matched_arguments"])


def judged_records(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """records (turn_id, branch, malformed, invalid, truncated) with sums of measures and the verdict of each."""
    sums = pairs.groupBy("turn_id").agg(*[F.sum(c).alias(c) for c in _MEASURES])
    rows = records.join(sums, "turn_id", "left").na.fill(0, list(_MEASURES))
    acted = (F.col("predicted") > 0) | (F.col("malformed") > 0)
    expects = F.col("expected") > 0
    correct = (F.col("malformed") == 0) & (F.col("expected") == F.col("predicted")) & (F.col("expected") == F.col("exact"))
    return rows.select("*", expects.alias("expects"), correct.alias("correct"), (acted & ~expects).alias("false_fire"), (~acted & expects).alias("missed"))


def full_report(judged: DataFrame) -> DataFrame:
    """One row: decisions, call measures and all rates."""
    out = judged.agg(
        F.count("*").alias("turns"),
        F.count_if("correct").alias("correct_turns"),
        F.count_if(F.col("correct") & F.col("expects")).alias("correct_call_turns"),
        F.count_if("expects").alias("expected_call_turns"),
        F.count_if("false_fire").alias("false_fires"),
        F.count_if("missed").alias("missed_calls"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"{c}_calls") for c in ("malformed", "invalid")],
        F.count_if("truncated").alias("truncated_turns"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in _MEASURES],
    )
    out = out.withColumns({"correct_reply_turns": F.col("correct_turns") - F.col("correct_call_turns"), "expected_text_turns": F.col("turns") - F.col("expected_call_turns")})
    attempted = F.col("predicted") + F.col("malformed_calls")
    return out.select(
        "*",
        F.try_divide("correct_turns", "turns").alias("turn_accuracy"),
        F.try_divide("false_fires", "expected_text_turns").alias("false_fire_rate"),
        F.try_divide("missed_calls", "expected_call_turns").alias("missed_call_rate"),
        F.try_divide(F.col("predicted") - F.col("invalid_calls"), attempted).alias("valid_rate"),
        *_rates(),
    )


def full_by_tool(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("name").agg(*[F.sum(c).cast("bigint").alias(c) for c in _MEASURES]).select("*", *_rates())


def full_by_branch(judged: DataFrame) -> DataFrame:
    """Turns without an id are in the whole report alone."""
    counts = [F.count_if(c).alias(n) for c, n in (("correct", "correct_turns"), ("false_fire", "false_fires"), ("missed", "missed_calls"))]
    out = judged.where(F.col("branch").isNotNull()).groupBy("branch").agg(F.count("*").alias("turns"), *counts)
    return out.withColumn("turn_accuracy", F.try_divide("correct_turns", "turns"))
