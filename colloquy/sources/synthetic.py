"""Balanced synthetic dialogues: distinct by construction, exact quotas, deterministic in the seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WEIGHTS = {"transfer": 30, "no_amount": 20, "declined": 20, "off_topic": 30}
PEOPLE = [f"{a} {b}" for a in ("Mara", "Ilan", "Tove", "Nico", "Suri", "Olek") for b in ("Berg", "Costa", "Dahl", "Evans")]
OPENERS = ("Please send", "I want to pay", "Could you transfer", "Move")
TOPICS = ("the weather", "a recipe", "football", "my garden", "a poem")


class GenerationError(ValueError):
    """A request that the pools cannot meet."""


def quotas(count: int, weights: dict[str, int]) -> dict[str, int]:
    """Largest remainders; ties go to the later name."""
    total = sum(weights.values())
    out = {b: count * w // total for b, w in weights.items()}
    for b in sorted(weights, key=lambda b: (count * weights[b] % total, b), reverse=True)[: count - sum(out.values())]:
        out[b] += 1
    return out


def generate(spark: SparkSession, count: int, seed: int = 0, weights: dict[str, int] | None = None) -> DataFrame:
    """(dialogue_id, branch, user, reply, call_name, call_arguments)."""
    weights = {b: w for b, w in (weights or WEIGHTS).items() if w > 0}
    if count < 1 or not weights or set(weights) - set(WEIGHTS):
        raise GenerationError("a positive count and known branches with positive weights are needed")
    people = spark.createDataFrame([(p,) for p in PEOPLE], "person string")
    openers = spark.createDataFrame([(o,) for o in OPENERS], "opener string")
    topics = spark.createDataFrame([(t,) for t in TOPICS], "topic string")
    amounts = spark.range(1, 121).select((F.col("id") * 5).alias("amount"))
    pool = openers.crossJoin(people).crossJoin(amounts).crossJoin(topics)  # a fixed product of small word pools
    user = {
        "transfer": F.concat_ws(" ", "opener", F.col("amount").cast("string"), F.lit("to"), "person"),
        "no_amount": F.concat_ws(" ", "opener", F.lit("something to"), "person"),
        "declined": F.concat_ws(" ", "opener", F.col("amount").cast("string"), F.lit("to"), "person", F.lit("now")),
        "off_topic": F.concat_ws(" ", F.lit("Tell me about"), "topic", F.lit("and"), "person"),
    }
    out = None
    for branch, quota in quotas(count, weights).items():
        rows = pool.select(user[branch].alias("user"), *(["amount", "person"] if branch in ("transfer", "declined") else [F.lit(None).cast("long").alias("amount"), "person"])).distinct()
        order = F.sha2(F.concat(F.lit(f"{seed}:{branch}:"), "user"), 256)
        rows = rows.withColumn("rank", F.row_number().over(Window.orderBy(order))).where(F.col("rank") <= quota).withColumn("branch", F.lit(branch))
        if (n := rows.count()) < quota:
            raise GenerationError(f"{branch} has {n} dialogues; {quota} were asked for")
        out = rows if out is None else out.unionByName(rows)
    place = F.row_number().over(Window.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), "user"), 256)))
    call = F.col("branch").isin("transfer", "declined")
    return out.select(
        F.concat("branch", F.lit("-"), F.lpad(place.cast("string"), 5, "0")).alias("dialogue_id"), "branch", "user",
        F.when(F.col("branch") == "transfer", "Done.").when(F.col("branch") == "declined", "The bank declined it.").when(F.col("branch") == "no_amount", "How much?").otherwise("I can only help with payments.").alias("reply"),
        F.when(call, "create_payment").alias("call_name"),
        F.when(call, F.to_json(F.struct("amount", "person"))).alias("call_arguments"),
    )
