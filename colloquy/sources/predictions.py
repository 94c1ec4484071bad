"""Prediction records: one JSON object a line with the expected and predicted calls of a turn; strict, as dialogues are."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tool_calls import checked, equal_key
from .jsonl import RecordError, _need, _text, numbered_lines, refuse

CALL = "struct<name string, arguments string, eq string, args array<struct<key string, eq string>>, problems array<string>>"
RECORD = f"dialogue_id string, turn_index long, expected array<{CALL}>, predicted array<{CALL}>, malformed long, truncated boolean, raw_output string, error string"
PARTS = ["dialogue_id", "turn_index", "expected", "predicted", "malformed", "truncated", "raw_output", "error"]


def _calls(raw, field: str) -> list[dict]:
    _need(isinstance(raw, list), f"'{field}' must be a list")
    out = []
    for item in raw:
        _need(isinstance(item, dict), f"each '{field}' entry must be a JSON object")
        args, problems = item.get("arguments", {}), item.get("problems", [])
        _need(_text(item.get("name")), f"'{field}' entry needs a non-empty 'name'")
        _need(isinstance(args, dict), f"'{field}' entry 'arguments' must be a JSON object")
        _need(isinstance(problems, list), f"'{field}' entry 'problems' must be a list")
        pairs = [{"key": k, "eq": equal_key(v)} for k, v in args.items()]
        out.append({"name": item["name"], "arguments": json.dumps(args, ensure_ascii=False), "eq": equal_key(args), "args": pairs, "problems": [str(p) for p in problems]})
    return out


def _malformed(value) -> int:
    if isinstance(value, list):
        return len(value)
    _need(value is None or (type(value) is int and value >= 0), "'malformed' must be a list of strings or a count")
    return value or 0


def parse_record(line: str) -> dict:
    """A typed record; ``error`` is set instead where the line breaks the schema."""
    out = dict.fromkeys(PARTS)
    try:
        raw = json.loads(line)
        _need(isinstance(raw, dict), "each line must be a JSON object")
        found = {f: _calls(raw.get(f), f) for f in ("expected", "predicted")}
        found["malformed"] = _malformed(raw.get("malformed"))
        for field, kind, said in (("dialogue_id", str, "a string"), ("turn_index", int, "an integer")):
            _need(raw.get(field) is None or type(raw[field]) is kind, f"'{field}' must be {said}")
            found[field] = raw.get(field)
        _need(type(raw.get("truncated", False)) is bool, "'truncated' must be a boolean")
        output = raw.get("raw_output")
        out |= found | {"truncated": raw.get("truncated", False), "raw_output": output if isinstance(output, str) else None}
    except RecordError as e:
        out["error"] = str(e)
    except (ValueError, RecursionError) as e:
        out["error"] = f"invalid JSON: {e}"
    return out


def read_predictions(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Records with rec_no, the line number, and ``invalid``, the number of predicted calls with problems. strict raises for
    the first bad line, or where there is no record."""

    @F.pandas_udf(RECORD)
    def parsed(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_record(x) for x in s], columns=PARTS).astype({"turn_index": "Int64", "malformed": "Int64"})

    rows = numbered_lines(spark, path).withColumn("r", parsed("line")).select("line_no", "r.*")
    if strict:
        refuse(rows, path)
    return rows.withColumnRenamed("line_no", "rec_no").withColumn("invalid", invalid_calls(F.col("predicted")))


def invalid_calls(calls: Column) -> Column:
    return F.size(F.filter(calls, lambda c: F.size(c["problems"]) > 0)).cast("bigint")


def rechecked(records: DataFrame, dialogues: DataFrame, path: str = "records") -> DataFrame:
    """records with the problems of predicted calls taken from the tools of their dialogues. A record without a dialogue is
    an error. Only ids and tools are joined."""
    tools = dialogues.select("dialogue_id", "tools")
    lost = records.join(tools, "dialogue_id", "left_anti").agg(F.min(F.struct("rec_no", "dialogue_id")).alias("r")).first()["r"]
    if lost:
        raise RecordError(f"{path}:{lost[0]}: dialogue_id {lost[1]!r} is not among the dialogues")
    calls = records.join(tools, "dialogue_id").select("rec_no", "tools", F.posexplode("predicted").alias("pos", "call"))
    judged = calls.withColumn("problems", checked(F.col("call.name"), F.col("call.arguments"), F.col("tools")))
    judged = judged.groupBy("rec_no").agg(F.array_sort(F.collect_list(F.struct("pos", "call", "problems"))).alias("judged"))
    new = F.transform("judged", lambda x: x["call"].withField("problems", x["problems"]))
    out = records.join(judged, "rec_no", "left").withColumn("predicted", F.coalesce(new, "predicted")).drop("judged")
    return out.withColumn("invalid", invalid_calls(F.col("predicted")))


def calls_of(records: DataFrame) -> DataFrame:
    """(turn_id, side, name, eq, pos, args) of all calls, as pairing wants them."""
    sides = [records.select(F.col("rec_no").alias("turn_id"), F.lit(s).alias("side"), F.posexplode(s).alias("pos", "c")) for s in ("expected", "predicted")]
    return sides[0].unionByName(sides[1]).select("turn_id", "side", "c.name", "c.eq", "pos", "c.args")


def described(calls: Column) -> Column:
    """One line for the calls of a side: names, arguments, and problems in brackets."""
    one = lambda c: F.concat(c["name"], F.lit(" "), c["arguments"], F.when(F.size(c["problems"]) > 0, F.concat(F.lit("  ["), F.array_join(c["problems"], "; "), F.lit("]"))).otherwise(""))
    return F.when(F.size(calls) > 0, F.array_join(F.transform(calls, one), " | ")).otherwise("(no call)")


def write_predictions(records: DataFrame, path: str) -> None:
    """One JSON object a line, with nulls left out."""
    call = lambda c: F.concat(F.lit('{"name": '), _quoted(c["name"]), F.lit(', "arguments": '), c["arguments"], F.lit(', "problems": '), F.to_json(c["problems"]), F.lit("}"))
    side = lambda s: F.concat(F.lit(f'"{s}": ['), F.array_join(F.transform(s, call), ", "), F.lit("]"))
    more = F.to_json(F.struct("dialogue_id", "turn_index", "malformed", "truncated", "raw_output"))
    records.select(F.concat(F.lit("{"), side("expected"), F.lit(", "), side("predicted"), F.lit(", "), F.substring(more, F.lit(2), F.length(more))).alias("value")).write.text(path)


def _quoted(text: Column) -> Column:
    from ..functions.text import json_string

    return json_string(text)
