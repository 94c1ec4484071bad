"""Dialogues with calls and tools as native expressions: fingerprint, chat form, census, rendered examples and labels.

Columns are those of ``sources.jsonl``: messages (role, content, tool_calls, tool_call_id), tools and tools_fp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import collapse_space, json_string

IGNORED = -100
#: What marks the target of a rendered example.
MARKS = ("⟦", "⟧")


def _list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def fingerprint(messages: Column, tools_fp: Column) -> Column:
    """SHA-256 of the canonical JSON: ids are ignored, white space is collapsed, arguments and tools have sorted keys."""
    call = lambda c: F.concat(F.lit("["), json_string(c["name"]), F.lit(", "), json_string(c["fp"]), F.lit("]"))
    one = F.transform(messages, lambda m: F.concat(F.lit("["), json_string(m["role"]), F.lit(", "), json_string(collapse_space(m["content"])), F.lit(", "), _list(F.transform(m["tool_calls"], call)), F.lit("]")))
    return F.sha2(F.concat(F.lit('{"messages": '), _list(one), F.lit(', "tools": '), _list(F.transform(tools_fp, json_string)), F.lit("}")), 256)


def chat_record(messages: Column, tools: Column) -> Column:
    """JSON of the chat form: calls nested as functions, ids only where present, tools only where there are some."""

    def call(c):
        tail = F.when(c["id"].isNull(), F.lit("")).otherwise(F.concat(F.lit(', "id": '), json_string(c["id"])))
        return F.concat(F.lit('{"type": "function", "function": {"name": '), json_string(c["name"]), F.lit(', "arguments": '), c["arguments"], F.lit("}"), tail, F.lit("}"))

    def message(m):
        calls = F.when(F.size(m["tool_calls"]) > 0, F.concat(F.lit(', "tool_calls": '), _list(F.transform(m["tool_calls"], call)))).otherwise("")
        answer = F.when(m["tool_call_id"].isNull(), F.lit("")).otherwise(F.concat(F.lit(', "tool_call_id": '), json_string(m["tool_call_id"])))
        return F.concat(F.lit('{"role": '), json_string(m["role"]), F.lit(', "content": '), json_string(m["content"]), calls, answer, F.lit("}"))

    more = F.when(F.size(tools) > 0, F.concat(F.lit(', "tools": '), _list(tools))).otherwise("")
    return F.concat(F.lit('{"messages": '), _list(F.transform(messages, message)), more, F.lit("}"))


def census(dialogues: DataFrame) -> DataFrame:
    """One row: dialogues, messages, assistant messages and those with calls."""
    own = lambda test: F.coalesce(F.sum(F.size(F.filter("messages", test))), F.lit(0)).cast("bigint")
    return dialogues.agg(
        F.count("*").alias("dialogues"),
        F.coalesce(F.sum(F.size("messages")), F.lit(0)).cast("bigint").alias("messages"),
        own(lambda m: m["role"] == "assistant").alias("assistant_messages"),
        own(lambda m: (m["role"] == "assistant") & (F.size(m["tool_calls"]) > 0)).alias("tool_call_messages"),
    )


def call_census(names: DataFrame, name_col: str = "name") -> DataFrame:
    """(name, n) in order of falling counts, then names."""
    return names.groupBy(F.col(name_col).alias("name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name")


def called_names(dialogues: DataFrame) -> DataFrame:
    calls = F.flatten(F.transform("messages", lambda m: F.transform(m["tool_calls"], lambda c: c["name"])))
    return dialogues.select(F.explode(calls).alias("name"))


def rendered(message: Column) -> Column:
    """<|role|>content<|end|> and a new line; calls follow the content as blocks."""
    block = lambda c: F.concat(F.lit('\n<tool_call>\n{"name": '), json_string(c["name"]), F.lit(', "arguments": '), c["arguments"], F.lit("}\n</tool_call>"))
    calls = F.array_join(F.transform(message["tool_calls"], block), "")
    return F.concat(F.lit("<|"), message["role"], F.lit("|>"), message["content"], calls, F.lit("<|end|>\n"))


def rendered_examples(dialogues: DataFrame, id_col: str = "dialogue_id") -> DataFrame:
    """(id, turn_index, prompt, target): one row for each assistant message, rendered from its own prefix."""
    at = F.filter(F.sequence(F.lit(0), F.size("messages") - 1), lambda i: F.element_at("messages", i + 1)["role"] == "assistant")
    rows = dialogues.select(id_col, F.transform("messages", rendered).alias("lines"), F.explode(at).alias("turn_index"))
    opening = F.lit("<|assistant|>")
    prompt = F.concat(F.array_join(F.expr("slice(lines, 1, turn_index)"), ""), opening)
    line = F.element_at("lines", F.col("turn_index") + 1)
    return rows.select(id_col, F.col("turn_index").cast("bigint").alias("turn_index"), prompt.alias("prompt"), F.substring(line, F.length(opening) + 1, F.length(line)).alias("target"))


def marked(prompt: Column, target: Column) -> Column:
    return F.concat(prompt, F.lit(MARKS[0]), target, F.lit(MARKS[1]))


def labelled(examples: DataFrame) -> DataFrame:
    """examples as training rows of a character tokenizer: input_ids, attention_mask and labels, the prompt ignored."""
    ids = lambda t: F.transform(F.filter(F.split(t, ""), lambda c: c != ""), lambda c: F.ascii(c))
    rows = examples.withColumns({"input_ids": F.concat(ids(F.col("prompt")), ids(F.col("target"))), "n": F.length("prompt")})
    n = F.size("input_ids")
    labels = F.concat(F.array_repeat(F.lit(IGNORED), F.col("n")), F.expr("slice(input_ids, n + 1, size(input_ids) - n)"))
    return rows.withColumns({"attention_mask": F.array_repeat(F.lit(1), n), "labels": labels}).drop("n")


def replay_batches(examples: DataFrame, length: str, key: list[str], size: int) -> DataFrame:
    """examples with ``place`` and ``batch``: the longest first, in batches of a size. Ranks come from one row for each
    length, so no task orders all examples."""
    counts = examples.groupBy(length).agg(F.count("*").alias("c"))
    before = counts.select(length, (F.sum("c").over(Window.orderBy(F.desc(length))) - F.col("c")).alias("before"))
    rank = F.row_number().over(Window.partitionBy(length).orderBy(*key))
    rows = examples.withColumn("rank", rank).join(F.broadcast(before), length)
    place = (F.col("before") + F.col("rank") - 1).cast("bigint")
    return rows.withColumns({"place": place, "batch": F.floor(place / size)}).drop("rank", "before")
