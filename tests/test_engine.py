import json
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from colloquy.functions import privacy
from colloquy.functions.tool_calls import check_call, equal_key, parse_output, parse_outputs
from colloquy.operators import dialogues as D
from colloquy.operators import scoring as S
from colloquy.plans import catalog
from colloquy.sources import jsonl, synthetic

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = catalog.QUERIES[name](spark, SF), con.execute(catalog.ORACLE_SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in cols]
    key = lambda rows: Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert key(tuple(r[c] for c in cols) for r in got.collect()) == key(tuple(r[i] for i in order) for r in want.fetchall())


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_parse_output():
    assert parse_output('a <tool_call>{"name": "f", "arguments": "{\\"x\\": 1}"}</tool_call> b') == ("a  b", [{"name": "f", "arguments": {"x": 1}}], [])
    assert parse_output("<tool_call>no</tool_call> hi <tool_call> cut") == ("hi", [], ["no", "cut"])
    assert parse_output('<tool_call>{"name": ""}</tool_call>')[2] == ['{"name": ""}']


def test_check_call():
    tools = [{"type": "function", "function": {"name": "f", "parameters": {"required": ["a"], "properties": {"a": {"type": "integer"}, "b": {"enum": [1]}}}}}]
    assert check_call({"name": "f", "arguments": {"a": 2.0}}, tools) == []
    assert check_call({"name": "f", "arguments": {"a": True}}, tools) == ["argument 'a' should be integer, got bool"]
    assert check_call({"name": "f", "arguments": {"b": True, "c": 0}}, tools) == ["missing required argument 'a'", "argument 'b' must be one of 1, got True", "undeclared argument 'c'"]
    assert check_call({"name": "g", "arguments": {}}, tools) == ["unknown tool 'g'"]
    assert check_call({"name": "g", "arguments": {}}, []) == []


def test_parse_outputs_frame(spark):
    rows = parse_outputs(spark.createDataFrame([('<tool_call>{"name": "f", "arguments": {"b": 1, "a": 40.0}}</tool_call>',), (None,)], "raw_output string")).collect()
    assert rows[0]["calls"][0]["eq"] == equal_key({"a": 40, "b": True}) and rows[1]["calls"] == []


def _line(messages, **more):
    return json.dumps({"dialogue_id": "d", "messages": messages} | more)


@pytest.mark.parametrize(
    "messages,part",
    [
        ([{"role": "robot", "content": "x"}], "unknown role"),
        ([{"role": "user", "content": "x"}], "must end with"),
        ([{"role": "user", "content": "x", "tool_calls": [{"name": "f"}]}], "only assistant"),
        ([{"role": "user", "content": "x"}, {"role": "tool", "content": "y"}, {"role": "assistant", "content": "z"}], "without a pending"),
        ([{"role": "user", "content": "x"}, {"role": "assistant", "content": ""}], "needs content or tool calls"),
        ([{"role": "user", "content": None}], "content must be"),
    ],
)
def test_bad_records(messages, part):
    assert part in jsonl.parse_line(_line(messages))["error"]


def test_jsonl_round_trip(spark, tmp_path):
    call = {"name": "f", "arguments": {"x": 1, "é": [True]}, "id": "1"}
    messages = [{"role": "user", "content": "hé\n\"q\""}, {"role": "assistant", "content": "", "tool_calls": [call]}, {"role": "tool", "content": "ok", "tool_call_id": "1"}, {"role": "assistant", "content": "done"}]
    (tmp_path / "in.jsonl").write_text(_line(messages, tools=[{"name": "f"}]) + "\n\n")
    rows = jsonl.read_dialogues(spark, str(tmp_path / "in.jsonl"))
    jsonl.write_dialogues(rows, str(tmp_path / "out"))
    again = jsonl.read_dialogues(spark, str(tmp_path / "out"))
    assert again.drop("line_no").collect() == rows.drop("line_no").collect()
    (tmp_path / "bad.jsonl").write_text(_line(messages) + "\n{\n")
    with pytest.raises(jsonl.RecordError, match=":2:"):
        jsonl.read_dialogues(spark, str(tmp_path / "bad.jsonl"))


def test_pairing_against_a_greedy_matcher(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for t in range(300):
        sides = {s: [(rng.choice("fg"), str(rng.randint(0, 2))) for _ in range(rng.randint(0, 4))] for s in ("expected", "predicted")}
        rows += [(t, s, n, e, i) for s, calls in sides.items() for i, (n, e) in enumerate(calls)]
        for name in "fg":
            e, p = ([x for n, x in sides[s] if n == name] for s in ("expected", "predicted"))
            if e or p:
                want[t, name] = (len(e), len(p), sum((Counter(e) & Counter(p)).values()), min(len(e), len(p)))
    got = S.paired(spark.createDataFrame(rows, "turn_id int, side string, name string, eq string, pos int")).collect()
    assert {(r.turn_id, r.name): (r.expected, r.predicted, r.exact, r.name_matches) for r in got} == want


def test_percentile_is_nearest_rank(spark):
    df = spark.createDataFrame([(x,) for x in (10, 20, 30, 40)], "v int")
    assert {r.fraction: r.value for r in D.percentiles(df, "v", (0.0, 0.5, 1.0)).collect()} == {0.0: 10, 0.5: 30, 1.0: 40}


def test_scrub():
    text, n = privacy.scrub("Mail ann@x.org, acct 12345678, Ann Lee and annex.", ["Ann Lee"], "s")
    assert "ann@x.org" not in text and "12345678" not in text and "Ann Lee" not in text and "annex" in text
    assert n == {"email": 1, "account_number": 1, "name": 1}
    assert text == privacy.scrub("Mail ann@x.org, acct 12345678, Ann Lee and annex.", ["Ann Lee"], "s")[0]


def test_phones_object_ids_and_short_ibans(spark):
    values = {"phone": "+44 20 7946-0958", "object_id": "507f1f77bcf86cd799439011", "iban": "NO93" + "8601111794"}
    text = "Call {phone}, id {object_id}, pay {iban}; +1 2 is none.".format(**values)
    out, n = privacy.scrub(text, [], "s")
    assert n == {k: 1 for k in values} and not any(v in out for v in values.values()) and "+1 2 is none" in out
    row = spark.createDataFrame([(text,)], "t string").select(privacy.detected(F.col("t")).alias("n")).first()
    assert {k: v for k, v in row.n.items() if v} == {k: 1 for k in values}


def test_generate(spark):
    rows = synthetic.generate(spark, 100, 1).collect()
    assert Counter(r.branch for r in rows) == synthetic.quotas(100, synthetic.WEIGHTS) and len({r.user for r in rows}) == 100
    assert sorted(rows) == sorted(synthetic.generate(spark, 100, 1).collect())
    with pytest.raises(synthetic.GenerationError):
        synthetic.generate(spark, 0)
