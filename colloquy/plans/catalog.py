"""All queries of the dialogue engine, with the SQL that each must agree with.

The driver's tables hold no tool calls, so ``events`` stands in for them: an event is a turn, its type the tool, the
integer in ``props`` the argument that is expected, and a rule on event_id gives what is predicted.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import privacy
from ..functions.text import branch_of, collapse_space, json_string, split_side
from ..functions.tool_calls import blocks, checked, reply, unclosed
from ..operators import dialogues as D
from ..operators import records as R
from ..operators import scoring as S


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def structure(spark, d):
    rows = D.gathered(_t(spark, d, "conversations"))
    return rows.select("conv_id", D.structure(F.col("messages")).alias("error"))


def fingerprints(spark, d):
    return D.gathered(_t(spark, d, "conversations")).select("conv_id", D.fingerprint(F.col("messages")).alias("fp"))


def conversation_split(spark, d):
    rows = D.first_of(fingerprints(spark, d), "fp", "conv_id")
    return D.split(rows).groupBy("side").agg(F.count("*").alias("n"))


def document_dedup(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.sha2(collapse_space(F.col("text")), 256).alias("fp"))
    return D.first_of(rows, "fp", "doc_id")


def document_split(spark, d):
    return document_dedup(spark, d).select("doc_id", split_side(F.col("fp")).alias("side"))


def census(spark, d):
    return D.census(_t(spark, d, "conversations"))


def chat_records(spark, d):
    rows = D.gathered(_t(spark, d, "conversations"))
    one = F.transform("messages", lambda m: F.concat(F.lit('{"role": '), json_string(m["role"]), F.lit(', "content": '), json_string(m["content"]), F.lit("}")))
    return rows.select("conv_id", F.concat(F.lit('{"messages": ['), F.array_join(one, ", "), F.lit("]}")).alias("record"))


def turn_examples(spark, d):
    return D.examples(_t(spark, d, "conversations"))


def token_rollup(spark, d):
    return D.rollup(turn_examples(spark, d))


def length_filter(spark, d):
    return token_rollup(spark, d).select("conv_id", F.when(F.col("longest_example") <= 1024, "kept").otherwise("dropped").alias("status"))


def longest_dialogues(spark, d):
    return token_rollup(spark, d).orderBy(F.desc("longest_example"), "conv_id").limit(10)


def length_percentiles(spark, d):
    return D.percentiles(_t(spark, d, "documents"), "n_chars", (0.0, 0.5, 0.9, 1.0))


def length_histogram(spark, d):
    return D.histogram(_t(spark, d, "documents"), "n_chars", (256, 512, 1024, 2048, 4096))


def length_fits(spark, d):
    return D.threshold_fits(_t(spark, d, "documents"), "n_chars", (1024, 2048, 4096, 8192))


def _calls(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    want = e.where("event_id % 3 <> 0").select(F.col("event_id").alias("turn_id"), F.lit("expected").alias("side"), F.col("event_type").alias("name"), F.col("k").alias("eq"), F.lit(0).alias("pos"))
    name = F.when(F.col("event_id") % 11 == 0, "other").otherwise(F.col("event_type"))
    eq = F.when(F.col("event_id") % 5 == 0, "0").otherwise(F.col("k"))
    got = e.where("event_id % 7 <> 0").select(F.col("event_id").alias("turn_id"), F.lit("predicted").alias("side"), name.alias("name"), eq.alias("eq"), F.lit(0).alias("pos"))
    return want.unionByName(got)


def _judged(spark, d):
    e = _t(spark, d, "events")
    turns = e.select(F.col("event_id").alias("turn_id"), branch_of(F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string"))).alias("branch"), (F.col("event_id") % 13 == 0).cast("bigint").alias("malformed"))
    return S.judged_turns(turns, S.paired(_calls(spark, d)))


def call_pairs(spark, d):
    return S.paired(_calls(spark, d))


def call_arguments(spark, d):
    rows = _calls(spark, d).withColumn("args", F.array(F.concat(F.lit("k="), F.coalesce("eq", F.lit("")))))
    return S.argument_matches(rows.withColumn("eq", F.coalesce("eq", F.lit(""))))


def score_overall(spark, d):
    return S.report(_judged(spark, d))


def score_by_branch(spark, d):
    return S.report(_judged(spark, d), "branch")


def score_by_tool(spark, d):
    return S.by_tool(call_pairs(spark, d))


def wrong_turns(spark, d):
    return _judged(spark, d).where("NOT correct").orderBy("turn_id").limit(20).select("turn_id", "branch", "expected", "predicted")


def _outputs(spark, d):
    return _t(spark, d, "events").select("event_id", F.concat(F.lit(" Sure. "), F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.lit("<tool_call>\n"), "props", F.lit("\n</tool_call>"))), F.when(F.col("event_id") % 6 == 0, " more <tool_call>{cut").otherwise(" end ")).alias("raw"))


def tool_call_blocks(spark, d):
    return _outputs(spark, d).select("event_id", F.size(blocks(F.col("raw"))).cast("bigint").alias("n_blocks"), reply(F.col("raw")).alias("content"), unclosed(F.col("raw")).alias("cut"))


def detectors(spark, d):
    rows = _t(spark, d, "documents").select(F.explode(privacy.detected(F.col("text"))).alias("kind", "n"))
    return rows.groupBy("kind").agg(F.sum("n").alias("n"))


def stand_ins(spark, d):
    rows = _t(spark, d, "customer").select("c_custkey", privacy.fake_number("account_number", F.col("c_name"), "s").alias("n"))
    return rows.select("c_custkey", F.lpad((F.col("n") % 100_000_000).cast("string"), 8, "0").alias("account"))


def verbatim_leakage(spark, d):
    """Texts of the eval side that occur as a text of the train side."""
    rows = _t(spark, d, "conversations").select("conv_id", F.col("text").alias("t"), split_side(F.col("conv_id").cast("string")).alias("side")).where("role = 'assistant'")
    return rows.where("side = 'eval'").join(rows.where("side = 'train'").select("t"), "t", "left_semi").agg(F.count("*").alias("leaked"))


def _turn_calls(spark, d):
    """Several calls a turn: four events each, the first two expected and the others predicted; those with an even k fall out."""
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).where("k % 2 = 1")
    a, b = (F.col("k") % 3).cast("string"), (F.col("user_id") % 2).cast("string")
    arg = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("eq"))
    side = F.when(F.col("event_id") % 4 < 2, "expected").otherwise("predicted").alias("side")
    return e.select(F.floor(F.col("event_id") / 4).alias("turn_id"), side, F.col("event_type").alias("name"), F.concat_ws(",", a, b).alias("eq"), (F.col("event_id") % 4).alias("pos"), F.array(arg("a", a), arg("b", b)).alias("args"))


def _turn_judged(spark, d):
    e = _t(spark, d, "events").select("event_id", F.floor(F.col("event_id") / 4).alias("turn_id"), "event_type")
    turns = e.groupBy("turn_id").agg(F.min_by("event_type", "event_id").alias("first"))
    turns = turns.select("turn_id", F.when(F.col("turn_id") % 10 != 0, F.col("first")).alias("branch"))
    turns = turns.withColumns({"malformed": (F.col("turn_id") % 7 == 0).cast("bigint"), "invalid": (F.col("turn_id") % 5 == 0).cast("bigint"), "truncated": F.col("turn_id") % 11 == 0})
    return S.judged_records(turns, S.measured_pairs(_turn_calls(spark, d)))


def turn_pairs(spark, d):
    return S.measured_pairs(_turn_calls(spark, d))


def turn_report(spark, d):
    return S.full_report(_turn_judged(spark, d))


def turn_report_by_tool(spark, d):
    return S.full_by_tool(turn_pairs(spark, d))


def turn_report_by_branch(spark, d):
    return S.full_by_branch(_turn_judged(spark, d))


def call_census(spark, d):
    return R.call_census(_t(spark, d, "events"), "event_type")


def tool_checks(spark, d):
    """Events as calls against one declared tool."""
    schema = {"required": ["k", "v"], "properties": {"k": {"type": "integer", "enum": [1, 2, 3]}, "v": {"type": ["string", "null"]}}}
    tools = F.array(F.lit(json.dumps({"type": "function", "function": {"name": "click", "parameters": schema}})))
    v = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, ', "v": true').otherwise(', "v": null')
    more = F.when(F.col("event_id") % 5 == 0, ', "x": 1').otherwise("")
    args = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), v, more, F.lit("}"))
    return _t(spark, d, "events").select("event_id", F.array_join(checked(F.col("event_type"), args, tools), "; ").alias("problems"))


def _call_less(spark, d):
    none = F.array().cast("array<struct<name:string,arguments:string,fp:string,eq:string,id:string>>")
    rows = D.gathered(_t(spark, d, "conversations"))
    return rows.select("conv_id", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), none.alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"))).alias("messages"))


def turn_render(spark, d):
    rows = R.rendered_examples(_call_less(spark, d), "conv_id")
    return rows.select("conv_id", "turn_index", F.sha2(R.marked(F.col("prompt"), F.col("target")), 256).alias("example"))


def train_rows(spark, d):
    rows = R.labelled(R.rendered_examples(_call_less(spark, d), "conv_id"))
    n = lambda c: F.size(c).cast("bigint")
    return rows.select("conv_id", "turn_index", n("input_ids").alias("n_ids"), n("attention_mask").alias("n_mask"), n(F.filter("labels", lambda x: x == R.IGNORED)).alias("n_ignored"))


def replay_schedule(spark, d):
    return R.replay_batches(turn_examples(spark, d), "prompt_tokens", ["conv_id", "turn"], 4).select("conv_id", "turn", "place", "batch")


def split_by_source(spark, d):
    """Documents of each source on either side, sources of one side included."""
    sides = document_split(spark, d).join(_t(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return sides.groupBy("source").agg(F.count_if(F.col("side") == "train").alias("train"), F.count_if(F.col("side") == "eval").alias("eval"))


def stand_in_formats(spark, d):
    """Stand-ins of customers' names under several kinds."""
    kinds = ("name", "phone", "iban", "card_number", "uuid")

    @F.pandas_udf("array<string>")
    def made(s: pd.Series) -> pd.Series:
        return pd.Series([[privacy.fake(k, x, "s") for k in kinds] for x in s])

    rows = _t(spark, d, "customer").select("c_custkey", made("c_name").alias("m"))
    return rows.select("c_custkey", *[F.col("m")[i].alias(k) for i, k in enumerate(kinds)])


FLAGSHIP = "score_by_tool"
QUERIES = {
    f.__name__: f
    for f in (
        structure, fingerprints, conversation_split, document_dedup, document_split, census, chat_records, turn_examples, token_rollup, length_filter,
        longest_dialogues, length_percentiles, length_histogram, length_fits, call_pairs, call_arguments, score_overall, score_by_branch, score_by_tool,
        wrong_turns, tool_call_blocks, detectors, stand_ins, verbatim_leakage, turn_pairs, turn_report, turn_report_by_tool, turn_report_by_branch,
        call_census, tool_checks, turn_render, train_rows, replay_schedule, split_by_source, stand_in_formats,
    )
}

_FP_CONV = r"""SELECT conv_id, sha256('{"messages": [' || string_agg('["' || role || '", ' || to_json(trim(regexp_replace(text, '\s+', ' ', 'g')))::VARCHAR || ', []]', ', ' ORDER BY turn) || '], "tools": []}') AS fp FROM conversations GROUP BY 1"""
_FP_DOC = r"SELECT doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS fp FROM documents"
_SIDE = "CASE WHEN ('0x' || substr(sha256('v1:' || {0}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < 0.1 THEN 'eval' ELSE 'train' END"
_EX = """SELECT conv_id, turn, before + 13 AS prompt_tokens, length(text) + 8 AS target_tokens FROM (
 SELECT *, coalesce(sum(length(role) + length(text) + 12) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
 FROM conversations) WHERE role = 'assistant'"""
_ROLL = f"""SELECT conv_id, count(*) AS examples, max(prompt_tokens + target_tokens) AS longest_example, sum(prompt_tokens + target_tokens)::BIGINT AS epoch_tokens,
 sum(target_tokens)::BIGINT AS trained_tokens FROM ({_EX}) GROUP BY 1"""
_CALLS = """SELECT event_id AS turn_id, 'expected' AS side, event_type AS name, json_extract_string(props, '$.k') AS eq FROM events WHERE event_id % 3 <> 0
 UNION ALL SELECT event_id, 'predicted', CASE WHEN event_id % 11 = 0 THEN 'other' ELSE event_type END, CASE WHEN event_id % 5 = 0 THEN '0' ELSE json_extract_string(props, '$.k') END
 FROM events WHERE event_id % 7 <> 0"""
_PAIRS = f"""SELECT turn_id, name, sum(e)::BIGINT AS expected, sum(p)::BIGINT AS predicted, sum(least(e, p))::BIGINT AS exact, least(sum(e), sum(p))::BIGINT AS name_matches FROM (
 SELECT turn_id, name, eq, count(*) FILTER (side = 'expected') AS e, count(*) FILTER (side = 'predicted') AS p FROM ({_CALLS}) GROUP BY ALL) GROUP BY ALL"""
_JUDGED = f"""SELECT *, malformed = 0 AND expected = predicted AND expected = exact AS correct, (predicted > 0 OR malformed > 0) AND expected = 0 AS false_fire,
 NOT (predicted > 0 OR malformed > 0) AND expected > 0 AS missed FROM (
 SELECT event_id AS turn_id, event_type AS branch, (event_id % 13 = 0)::BIGINT AS malformed, coalesce(expected, 0)::BIGINT AS expected, coalesce(predicted, 0)::BIGINT AS predicted,
        coalesce(exact, 0)::BIGINT AS exact, coalesce(name_matches, 0)::BIGINT AS name_matches
 FROM events LEFT JOIN (SELECT turn_id, sum(expected) AS expected, sum(predicted) AS predicted, sum(exact) AS exact, sum(name_matches) AS name_matches FROM ({_PAIRS}) GROUP BY 1) ON event_id = turn_id)"""
_TOTAL = """count(*) AS turns, count(*) FILTER (correct) AS correct_turns, count(*) FILTER (false_fire) AS false_fire_turns, count(*) FILTER (missed) AS missed_turns,
 sum(malformed)::BIGINT AS malformed, sum(expected)::BIGINT AS expected, sum(predicted)::BIGINT AS predicted, sum(exact)::BIGINT AS exact, sum(name_matches)::BIGINT AS name_matches"""
_RATES = "exact::DOUBLE / nullif(expected, 0) AS exact_recall, name_matches::DOUBLE / nullif(predicted, 0) AS name_precision"
_OUT = """SELECT event_id, ' Sure. ' || CASE WHEN event_id % 4 = 0 THEN '' ELSE '<tool_call>' || chr(10) || props || chr(10) || '</tool_call>' END
 || CASE WHEN event_id % 6 = 0 THEN ' more <tool_call>{cut' ELSE ' end ' END AS raw FROM events"""
_DOC_FIRST = f"SELECT min(doc_id) AS doc_id, fp FROM ({_FP_DOC}) GROUP BY fp"

_TC = """SELECT event_id // 4 AS turn_id, event_id % 4 AS pos, CASE WHEN event_id % 4 < 2 THEN 'expected' ELSE 'predicted' END AS side, event_type AS name,
 json_extract_string(props, '$.k')::BIGINT % 3 AS a, user_id % 2 AS b FROM events WHERE json_extract_string(props, '$.k')::BIGINT % 2 = 1"""
_TP = f"""WITH c AS ({_TC}),
 r AS (SELECT *, row_number() OVER (PARTITION BY turn_id, side, name, a, b ORDER BY pos) AS rn,
              least(count(*) FILTER (side = 'expected') OVER (PARTITION BY turn_id, name, a, b), count(*) FILTER (side = 'predicted') OVER (PARTITION BY turn_id, name, a, b)) AS m FROM c),
 l AS (SELECT *, row_number() OVER (PARTITION BY turn_id, side, name ORDER BY pos) AS ln FROM r WHERE rn > m),
 x AS (SELECT turn_id, name, 2 AS n, 2 AS s FROM r WHERE side = 'expected' AND rn <= m
       UNION ALL SELECT e.turn_id, e.name, 2, (e.a = p.a)::INT + (e.b = p.b)::INT FROM l e JOIN l p ON e.turn_id = p.turn_id AND e.name = p.name AND e.ln = p.ln AND e.side = 'expected' AND p.side = 'predicted'),
 y AS (SELECT turn_id, name, sum(n) AS n, sum(s) AS s FROM x GROUP BY ALL),
 t AS (SELECT turn_id, name, count(*) FILTER (side = 'expected') AS expected, count(*) FILTER (side = 'predicted') AS predicted, count(*) FILTER (side = 'expected' AND rn <= m) AS exact FROM r GROUP BY ALL)
 SELECT t.turn_id, t.name, expected, predicted, exact, least(expected, predicted) AS name_matches, coalesce(n, 0)::BIGINT AS expected_arguments, coalesce(s, 0)::BIGINT AS matched_arguments
 FROM t LEFT JOIN y USING (turn_id, name)"""
_SIX = ", ".join(f"sum({c})::BIGINT AS {c}" for c in ("expected", "predicted", "exact", "name_matches", "expected_arguments", "matched_arguments"))
_TJ = f"""SELECT *, malformed = 0 AND expected = predicted AND expected = exact AS correct, (predicted > 0 OR malformed > 0) AND expected = 0 AS false_fire,
 NOT (predicted > 0 OR malformed > 0) AND expected > 0 AS missed FROM (
 SELECT turn_id, CASE WHEN turn_id % 10 <> 0 THEN branch END AS branch, (turn_id % 7 = 0)::BIGINT AS malformed, (turn_id % 5 = 0)::BIGINT AS invalid, turn_id % 11 = 0 AS truncated,
 {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("expected", "predicted", "exact", "name_matches", "expected_arguments", "matched_arguments"))}
 FROM (SELECT event_id // 4 AS turn_id, arg_min(event_type, event_id) AS branch FROM events GROUP BY 1) LEFT JOIN (SELECT turn_id, {_SIX} FROM ({_TP}) GROUP BY 1) USING (turn_id))"""
_ALL_RATES = """name_matches::DOUBLE / nullif(predicted, 0) AS name_precision, name_matches::DOUBLE / nullif(expected, 0) AS name_recall, exact::DOUBLE / nullif(predicted, 0) AS exact_precision,
 exact::DOUBLE / nullif(expected, 0) AS exact_recall, matched_arguments::DOUBLE / nullif(expected_arguments, 0) AS argument_accuracy"""
_LINES = "SELECT *, '<|' || role || '|>' || text || '<|end|>' || chr(10) AS line FROM conversations"
_FAKE_N = "('0x' || substr(sha256('s:{0}:' || lower(c_name)), 1, 12))::UBIGINT"

ORACLE_SQL = {
    "turn_pairs": _TP,
    "turn_report": f"""SELECT *, correct_turns - correct_call_turns AS correct_reply_turns, turns - expected_call_turns AS expected_text_turns, correct_turns::DOUBLE / nullif(turns, 0) AS turn_accuracy,
        false_fires::DOUBLE / nullif(turns - expected_call_turns, 0) AS false_fire_rate, missed_calls::DOUBLE / nullif(expected_call_turns, 0) AS missed_call_rate,
        (predicted - invalid_calls)::DOUBLE / nullif(predicted + malformed_calls, 0) AS valid_rate, {_ALL_RATES} FROM (
        SELECT count(*) AS turns, count(*) FILTER (correct) AS correct_turns, count(*) FILTER (correct AND expected > 0) AS correct_call_turns, count(*) FILTER (expected > 0) AS expected_call_turns,
        count(*) FILTER (false_fire) AS false_fires, count(*) FILTER (missed) AS missed_calls, sum(malformed)::BIGINT AS malformed_calls, sum(invalid)::BIGINT AS invalid_calls,
        count(*) FILTER (truncated) AS truncated_turns, {_SIX} FROM ({_TJ}))""",
    "turn_report_by_tool": f"SELECT *, {_ALL_RATES} FROM (SELECT name, {_SIX} FROM ({_TP}) GROUP BY 1)",
    "turn_report_by_branch": f"""SELECT branch, count(*) AS turns, count(*) FILTER (correct) AS correct_turns, count(*) FILTER (false_fire) AS false_fires, count(*) FILTER (missed) AS missed_calls,
        count(*) FILTER (correct)::DOUBLE / count(*) AS turn_accuracy FROM ({_TJ}) WHERE branch IS NOT NULL GROUP BY 1""",
    "call_census": "SELECT event_type AS name, count(*) AS n FROM events GROUP BY 1",
    "tool_checks": """SELECT event_id, CASE WHEN event_type <> 'click' THEN 'unknown tool ' || chr(39) || event_type || chr(39) ELSE concat_ws('; ',
        CASE WHEN event_id % 3 = 0 THEN 'missing required argument ' || chr(39) || 'v' || chr(39) END,
        CASE WHEN k NOT IN (1, 2, 3) THEN 'argument ' || chr(39) || 'k' || chr(39) || ' must be one of 1, 2, 3, got ' || k END,
        CASE WHEN event_id % 3 = 1 THEN 'argument ' || chr(39) || 'v' || chr(39) || ' should be string or null, got bool' END,
        CASE WHEN event_id % 5 = 0 THEN 'undeclared argument ' || chr(39) || 'x' || chr(39) END) END AS problems
        FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events)""",
    "turn_render": f"""SELECT conv_id, turn AS turn_index, sha256(before || '<|assistant|>⟦' || text || '<|end|>' || chr(10) || '⟧') AS example FROM (
        SELECT *, coalesce(string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before FROM ({_LINES})) WHERE role = 'assistant'""",
    "train_rows": f"SELECT conv_id, turn AS turn_index, prompt_tokens + target_tokens AS n_ids, prompt_tokens + target_tokens AS n_mask, prompt_tokens AS n_ignored FROM ({_EX})",
    "replay_schedule": f"SELECT conv_id, turn, place, place // 4 AS batch FROM (SELECT *, row_number() OVER (ORDER BY prompt_tokens DESC, conv_id, turn) - 1 AS place FROM ({_EX}))",
    "split_by_source": f"SELECT source, count(*) FILTER (side = 'train') AS train, count(*) FILTER (side = 'eval') AS eval FROM (SELECT doc_id, {_SIDE.format('fp')} AS side FROM ({_DOC_FIRST})) JOIN documents USING (doc_id) GROUP BY 1",
    "stand_in_formats": f"""SELECT c_custkey, list_extract({list(privacy.FIRST)}, ({_FAKE_N.format('name')} % 16 + 1)::INT) || ' ' || list_extract({list(privacy.LAST)}, ({_FAKE_N.format('name')} // 16 % 16 + 1)::INT) AS name,
        '+99 900 ' || lpad(({_FAKE_N.format('phone')} % 1000000)::VARCHAR, 6, '0') AS phone, 'XX00TEST' || lpad(({_FAKE_N.format('iban')} % 100000000000000)::VARCHAR, 14, '0') AS iban,
        '4111' || lpad(({_FAKE_N.format('card_number')} % 1000000000000)::VARCHAR, 12, '0') AS card_number,
        substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-4' || substr(u, 14, 3) || '-a' || substr(u, 18, 3) || '-' || substr(u, 21, 12) AS uuid FROM (SELECT *, sha256('s:uuid:' || lower(c_name)) AS u FROM customer)""",
    "structure": """SELECT conv_id, CASE WHEN arg_min(role, turn) NOT IN ('system', 'user') THEN 'must open with a system or user message'
        WHEN bool_or(role = 'system' AND turn > 0) THEN 'a system message may only come first' WHEN arg_max(role, turn) <> 'assistant' THEN 'must end with an assistant message'
        WHEN bool_or(role = 'tool') THEN 'tool result without a pending call' END AS error FROM conversations GROUP BY 1""",
    "fingerprints": _FP_CONV,
    "conversation_split": f"SELECT {_SIDE.format('fp')} AS side, count(*) AS n FROM (SELECT DISTINCT fp FROM ({_FP_CONV})) GROUP BY 1",
    "document_dedup": _DOC_FIRST,
    "document_split": f"SELECT doc_id, {_SIDE.format('fp')} AS side FROM ({_DOC_FIRST})",
    "census": """SELECT count(DISTINCT conv_id) AS dialogues, count(*) AS messages, count(*) FILTER (role = 'assistant') AS assistant_messages,
        count(*) FILTER (role = 'tool') AS tool_messages FROM conversations""",
    "chat_records": """SELECT conv_id, '{"messages": [' || string_agg('{"role": "' || role || '", "content": ' || to_json(text)::VARCHAR || '}', ', ' ORDER BY turn) || ']}' AS record
        FROM conversations GROUP BY 1""",
    "turn_examples": _EX,
    "token_rollup": _ROLL,
    "length_filter": f"SELECT conv_id, CASE WHEN longest_example <= 1024 THEN 'kept' ELSE 'dropped' END AS status FROM ({_ROLL})",
    "longest_dialogues": f"SELECT * FROM ({_ROLL}) ORDER BY longest_example DESC, conv_id LIMIT 10",
    "length_percentiles": """SELECT f::DOUBLE AS fraction, s[round_even(f * (len(s) - 1), 0)::BIGINT + 1] AS value
        FROM (SELECT list(n_chars ORDER BY n_chars) AS s FROM documents), (SELECT unnest([0.0, 0.5, 0.9, 1.0]::DOUBLE[]) AS f)""",
    "length_histogram": """SELECT bucket, count(n_chars) AS n FROM (VALUES ('0-255', 0, 256), ('256-511', 256, 512), ('512-1023', 512, 1024), ('1024-2047', 1024, 2048), ('2048-4095', 2048, 4096),
        ('4096+', 4096, 1000000000)) b(bucket, lo, hi) LEFT JOIN documents ON n_chars >= lo AND n_chars < hi GROUP BY 1""",
    "length_fits": "SELECT threshold, count(*) FILTER (n_chars <= threshold) AS fits FROM documents, (SELECT unnest([1024, 2048, 4096, 8192]) AS threshold) GROUP BY 1",
    "call_pairs": _PAIRS,
    "call_arguments": f"""SELECT turn_id, name, min(least(e, p))::BIGINT AS expected_arguments, sum(s)::BIGINT AS matched_arguments FROM (
        SELECT turn_id, name, sum(e) OVER w AS e, sum(p) OVER w AS p, least(e, p) AS s FROM (SELECT turn_id, name, eq, count(*) FILTER (side = 'expected') AS e,
        count(*) FILTER (side = 'predicted') AS p FROM ({_CALLS}) GROUP BY ALL) WINDOW w AS (PARTITION BY turn_id, name)) WHERE least(e, p) > 0 GROUP BY ALL""",
    "score_overall": f"SELECT *, correct_turns::DOUBLE / nullif(turns, 0) AS turn_accuracy, {_RATES} FROM (SELECT {_TOTAL} FROM ({_JUDGED}))",
    "score_by_branch": f"SELECT *, correct_turns::DOUBLE / nullif(turns, 0) AS turn_accuracy, {_RATES} FROM (SELECT branch, {_TOTAL} FROM ({_JUDGED}) GROUP BY 1)",
    "score_by_tool": f"""SELECT *, {_RATES} FROM (SELECT name, sum(expected)::BIGINT AS expected, sum(predicted)::BIGINT AS predicted, sum(exact)::BIGINT AS exact,
        sum(name_matches)::BIGINT AS name_matches FROM ({_PAIRS}) GROUP BY 1)""",
    "wrong_turns": f"SELECT turn_id, branch, expected, predicted FROM ({_JUDGED}) WHERE NOT correct ORDER BY turn_id LIMIT 20",
    "tool_call_blocks": rf"""SELECT event_id, len(regexp_extract_all(raw, '(?s)<tool_call>(.*?)</tool_call>'))::BIGINT AS n_blocks,
        trim(regexp_replace(rest, '(?s)<tool_call>.*$', '')) AS content, CASE WHEN instr(rest, '<tool_call>') > 0 THEN trim(substr(rest, instr(rest, '<tool_call>') + 11)) END AS cut
        FROM (SELECT *, regexp_replace(raw, '(?s)<tool_call>.*?</tool_call>', '', 'g') AS rest FROM ({_OUT}))""",
    "stand_ins": "SELECT c_custkey, lpad((('0x' || substr(sha256('s:account_number:' || lower(c_name)), 1, 12))::UBIGINT % 100000000)::VARCHAR, 8, '0') AS account FROM customer",
    "verbatim_leakage": f"""WITH r AS (SELECT text, {_SIDE.format('conv_id::VARCHAR')} AS side FROM conversations WHERE role = 'assistant')
        SELECT count(*) AS leaked FROM r WHERE side = 'eval' AND text IN (SELECT text FROM r WHERE side = 'train')""",
    "detectors": r"""SELECT kind, sum(n)::BIGINT AS n FROM (SELECT unnest(['email', 'iban', 'uuid', 'object_id', 'phone', 'card_number', 'account_number']) AS kind,
        unnest([len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')), len(regexp_extract_all(text, '\b[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}\b')),
        len(regexp_extract_all(text, '\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b')),
        len(regexp_extract_all(text, '\b[0-9a-f]{24}\b')), len(regexp_extract_all(text, '\+(?:[0-9][\s-]?){7,14}[0-9]\b')),
        len(list_filter(regexp_extract_all(text, '[0-9.]+'), lambda x: regexp_full_match(x, '[0-9]{13,19}'))),
        len(list_filter(regexp_extract_all(text, '[0-9.]+'), lambda x: regexp_full_match(x, '[0-9]{8}')))]) AS n FROM documents) GROUP BY 1""",
}
