"""Scoring of prediction records as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "dialogue_id string, turn_index long, correct boolean, false_fire boolean, missed boolean"


def judged_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).json(path)


def running_report(turns: DataFrame) -> DataFrame:
    return turns.groupBy().agg(F.count("*").alias("turns"), *[F.count_if(F.col(c)).alias(c) for c in ("correct", "false_fire", "missed")])


def start(turns: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    return running_report(turns).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()
