"""Pseudonymization of dialogues: one pass over rows of dialogues, without a shuffle, and its totals."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import scrub_dialogue
from ..functions.tool_calls import equal_key
from ..sources.jsonl import CALL

MESSAGES = f"array<struct<role string, content string, tool_calls array<{CALL}>, tool_call_id string>>"


def anonymized(dialogues: DataFrame, salt: str, extra_terms: list[str] | None = None) -> DataFrame:
    """dialogues with ``messages`` scrubbed and ``replaced``, a map of counts by kind. Ids, roles, tools, call names and
    argument keys stay."""

    @F.pandas_udf(f"messages {MESSAGES}, replaced map<string,long>")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = []
        for messages in column:
            plain = [m | {"tool_calls": [c | {"arguments": json.loads(c["arguments"])} for c in m["tool_calls"]]} for m in map(dict, messages)]
            new, counts = scrub_dialogue(plain, salt, extra_terms)
            for m in new:
                m["tool_calls"] = [
                    c | {"arguments": json.dumps(c["arguments"], ensure_ascii=False), "fp": json.dumps(c["arguments"], sort_keys=True), "eq": equal_key(c["arguments"])} for c in m["tool_calls"]
                ]
            rows.append((new, counts))
        return pd.DataFrame(rows, columns=["messages", "replaced"])

    out = dialogues.withColumn("__scrubbed", run("messages"))
    return out.withColumn("messages", F.col("__scrubbed.messages")).withColumn("replaced", F.col("__scrubbed.replaced")).drop("__scrubbed")


def totals(rows: DataFrame) -> DataFrame:
    """(kind, n) over all dialogues."""
    return rows.select(F.explode("replaced").alias("kind", "n")).groupBy("kind").agg(F.sum("n").alias("n"))
