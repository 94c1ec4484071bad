import hashlib
import json

import pytest
from pyspark.sql import functions as F

from colloquy.functions import privacy
from colloquy.functions.tool_calls import check_call
from colloquy.operators import anonymize
from colloquy.operators import dialogues as D
from colloquy.operators import records as R
from colloquy.plans import report
from colloquy.sources import jsonl, predictions

TOOL = {"type": "function", "function": {"name": "pay", "parameters": {"required": ["to"], "properties": {"to": {"type": "string"}, "sum": {"type": "number"}}}}}
CALL = {"name": "pay", "arguments": {"payee": "Ann Lee", "sum": 40}, "id": "c1"}
MESSAGES = [
    {"role": "system", "content": "Profile:\n- **Full name**: Bo Hart\n- **Date of birth**: 3 May 1980\n- **Home address**: 1 Elm Road\n"},
    {"role": "user", "content": "Pay Ann Lee 1,200.50 from 12345678, I am Bo Hart of 1 Elm Road, born 3 May 1980."},
    {"role": "assistant", "content": "", "tool_calls": [CALL]},
    {"role": "tool", "content": '{"payee_name": "Cy Dunn", "account_number": "87654321", "total": "12345678", "note": "fleet"', "tool_call_id": "c1"},
    {"role": "assistant", "content": "Sent to ann lee, not Cy Dunn. Mail cy.dunn@x.org"},
]


def record(i="pay-1", messages=MESSAGES, **more):
    return {"dialogue_id": i, "messages": messages, "tools": [TOOL]} | more


@pytest.fixture()
def dialogues(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    other = [{"role": "user", "content": " Pay  Ann\tLee"}, {"role": "assistant", "content": "", "tool_calls": [{"name": "pay", "arguments": {"b": 1.0, "a": True}}, {"name": "pay"}]}]
    path.write_text("\n".join(["", json.dumps(record()), "  ", json.dumps(record("pay-2", other, tools=[]))]) + "\n")
    return jsonl.read_dialogues(spark, str(path))


def test_fingerprint_and_chat_form(dialogues):
    def plain(d):
        calls = lambda m: m.get("tool_calls", [])
        payload = {"messages": [[m["role"], " ".join(m["content"].split()), [[c["name"], json.dumps(c.get("arguments", {}), sort_keys=True)] for c in calls(m)]] for m in d["messages"]], "tools": [json.dumps(t, sort_keys=True) for t in d["tools"]]}
        return hashlib.sha256(json.dumps(payload, ensure_ascii=False).encode()).hexdigest()

    rows = {r.dialogue_id: r for r in dialogues.select("*", R.fingerprint(F.col("messages"), F.col("tools_fp")).alias("fp"), R.chat_record(F.col("messages"), F.col("tools")).alias("chat")).collect()}
    assert rows["pay-1"].line_no == 2 and rows["pay-2"].line_no == 4
    assert rows["pay-1"].fp == plain(record())
    chat = json.loads(rows["pay-1"].chat)
    assert chat["tools"] == [TOOL] and chat["messages"][2]["tool_calls"] == [{"type": "function", "function": {"name": "pay", "arguments": CALL["arguments"]}, "id": "c1"}]
    assert chat["messages"][3]["tool_call_id"] == "c1" and "tools" not in json.loads(rows["pay-2"].chat)
    assert R.census(dialogues).first().asDict() == {"dialogues": 2, "messages": 7, "assistant_messages": 3, "tool_call_messages": 2}
    assert [tuple(r) for r in R.call_census(R.called_names(dialogues)).collect()] == [("pay", 3)]


def test_examples_and_labels(dialogues):
    rows = R.labelled(R.rendered_examples(dialogues)).orderBy("dialogue_id", "turn_index").collect()
    assert [(r.dialogue_id, r.turn_index) for r in rows] == [("pay-1", 2), ("pay-1", 4), ("pay-2", 1)]
    for r in rows:
        assert r.prompt.endswith("<|assistant|>") and len(r.input_ids) == len(r.prompt) + len(r.target) == len(r.attention_mask)
        assert r.labels == [R.IGNORED] * len(r.prompt) + r.input_ids[len(r.prompt) :]
    assert '"name": "pay"' in rows[0].target and rows[1].prompt.startswith(rows[0].prompt[: -len("<|assistant|>")])


def test_errors_tell_line_dialogue_and_message(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    bad = [{"role": "user", "content": "x"}, {"role": "assistant", "content": "", "tool_calls": [{"name": "f", "id": "1"}, {"name": "f", "id": "1"}]}]
    tool = lambda i=None: {"role": "tool", "content": "r"} | ({"tool_call_id": i} if i else {})
    end = {"role": "assistant", "content": "z"}
    cases = [(bad + [tool("1"), tool("1"), end], None), (bad + [tool("1"), tool(), end], None), (bad, None)]
    cases += [(bad + [tool("2"), end], "message 2: tool_call_id '2' matches no pending"), (bad + [tool("1"), end], "message 3: 1 tool call(s)")]
    cases += [(bad + [tool(), tool(), tool(), end], "message 4: tool result without a pending"), ([*bad, {"role": "system", "content": "s"}], "only come first")]
    cases += [([{"role": "user", "content": "x", "tool_call_id": "a"}, end], "message 0: only tool messages"), ([{"role": "tool", "content": "x"}, end], "must open with")]
    for messages, part in cases:
        error = jsonl.parse_line(json.dumps({"dialogue_id": "d", "messages": messages}))["error"]
        assert (error is None) if part is None else (part in error and "dialogue 'd'" in error), (error, part)
    path.write_text("\n".join([json.dumps(record()), "", json.dumps(record())]))
    with pytest.raises(jsonl.RecordError, match=":3: duplicate dialogue_id 'pay-1'"):
        jsonl.read_dialogues(spark, str(path))
    path.write_text("\n \n")
    with pytest.raises(jsonl.RecordError, match="no records"):
        jsonl.read_dialogues(spark, str(path))


def test_line_numbers_over_several_splits(spark, tmp_path):
    path = tmp_path / "d.txt"
    path.write_text("".join(f"{i} {'x' * 90}\n" if i % 7 else "\n" for i in range(1, 4001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = jsonl.numbered_lines(spark, str(path))
        assert rows.where("line_no <> cast(split(line, ' ')[0] as long)").count() == 0 and rows.count() == 4000 - 4000 // 7
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_checks_that_the_schema_leaves_odd():
    tool = lambda **p: [{"name": "f", "parameters": p}]
    call = {"name": "f", "arguments": {"a": 1, "b": "x"}}
    assert check_call(call, tool(properties={"a": {"type": {}}, "b": {"type": ["integer", "odd"], "enum": ["y", 2]}})) == ["argument 'b' should be integer, got str", "argument 'b' must be one of y, 2, got 'x'"]
    assert check_call(call, tool(properties={"a": "any", "b": {}})) == ["undeclared argument 'a'"]
    assert check_call(call, tool(required="ab", properties={"a": {}, "b": {}})) == [] == check_call(call, tool(required=["a"]))
    assert check_call(call, [{"function": "f", "name": "f"}]) == ["unknown tool 'f'"]
    assert check_call(call, [{"name": "f", "parameters": None}]) == []


def test_dialogues_are_pseudonymized(dialogues):
    rows = {r.dialogue_id: r for r in anonymize.anonymized(dialogues, "s", ["  Elm  "]).collect()}
    text = " ".join(m.content for m in rows["pay-1"].messages)
    assert not any(x in text for x in ("Ann Lee", "ann lee", "Bo Hart", "Cy Dunn", "cy.dunn", "87654321", "3 May 1980")) and "fleet" in text
    assert '"total": "12345678"' in text and "1,200.50" in text and "from 12345678" not in text
    call = rows["pay-1"].messages[2].tool_calls[0]
    assert json.loads(call.arguments) == {"payee": privacy.fake("name", "Ann Lee", "s"), "sum": 40}
    assert call.id == "c1" and rows["pay-1"].tools == [json.dumps(TOOL)]
    totals = {r.kind: r.n for r in anonymize.totals(anonymize.anonymized(dialogues, "s")).collect()}
    assert totals["date_of_birth"] == 2 and totals["address"] == 2 and totals["email"] == 1 and totals["account_number"] == 2


def test_keys_decide_what_is_scrubbed():
    args = {"payeeName": "Dee Orr", "accountNumber": 12345678, "items": [{"IBAN": "GB00X"}], "amount": "12345678", "memo": "to Dee Orr, 12345678", "ok": True, "x": 1.5}
    out, counts = privacy.scrub_dialogue([{"role": "assistant", "content": "x", "tool_calls": [{"name": "f", "arguments": args}]}], "s")
    args = out[0]["tool_calls"][0]["arguments"]
    assert args["payeeName"] == privacy.fake("name", "Dee Orr", "s") and args["memo"] == f"to {args['payeeName']}, {privacy.fake('account_number', '12345678', 's')}"
    assert args["accountNumber"] == int(privacy.fake("account_number", "12345678", "s")) and args["items"] == [{"IBAN": privacy.fake("iban", "GB00X", "s")}]
    assert args["amount"] == "12345678" and args["ok"] is True and args["x"] == 1.5
    assert counts == {"account_number": 2, "iban": 1, "name": 2}
    with pytest.raises(ValueError, match="unknown"):
        privacy.fake("shoe size", "x", "s")


def write(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    return str(path)


def test_records_are_scored_and_rechecked(spark, dialogues, tmp_path):
    call = lambda n="pay", p=None, **a: {"name": n, "arguments": a} | ({"problems": p} if p else {})
    rows = [
        {"dialogue_id": "pay-1", "turn_index": 2, "expected": [call(to="Ann", sum=40)], "predicted": [call(to="Ann", sum=40.0)]},
        {"dialogue_id": "pay-1", "turn_index": 4, "expected": [], "predicted": [call(to=5, p=["bad"])], "truncated": True},
        {"dialogue_id": "pay-2", "expected": [call(to="Ann", sum=40), call(to="Bo")], "predicted": [call(to="Bo"), call(to="Cy", sum=40)], "malformed": ["{"]},
        {"expected": [call()], "predicted": [], "malformed": 0, "raw_output": "hm"},
    ]
    path = write(tmp_path / "p.jsonl", rows)
    frames = report.evaluate(spark, path)
    got = frames["overall"].first()
    assert (got.turns, got.correct_turns, got.correct_call_turns, got.expected_call_turns, got.false_fires, got.missed_calls) == (4, 1, 1, 3, 1, 1)
    assert (got.malformed_calls, got.invalid_calls, got.truncated_turns, got.expected, got.predicted, got.exact, got.name_matches) == (1, 1, 1, 4, 4, 2, 3)
    assert (got.expected_arguments, got.matched_arguments) == (5, 4) and got.valid_rate == 3 / 5
    assert [(r.branch, r.turns) for r in frames["by_branch"].orderBy("branch").collect()] == [("pay", 3)]
    text = report.text_report(frames)
    assert text.startswith("turns: 4, correct: 1 (25.0%)\n") and "truncated: 1 of 4" in text and "  tool  expected" in text and "argument accuracy 0.800" in text
    wrong = frames["wrong"].collect()
    assert [r.turn_id for r in wrong] == [2, 3, 4] and wrong[0].wanted == "(no call)" and wrong[0].got == 'pay {"to": 5}  [bad]'
    known = predictions.read_predictions(spark, write(tmp_path / "q.jsonl", rows[:3]))
    again = predictions.rechecked(known, dialogues).orderBy("rec_no").collect()
    assert [r.invalid for r in again] == [0, 1, 0] and again[1].predicted[0].problems == ["argument 'to' should be string, got int"]
    with pytest.raises(jsonl.RecordError, match=":4: dialogue_id None"):
        predictions.rechecked(predictions.read_predictions(spark, path), dialogues, path)
    predictions.write_predictions(known, str(tmp_path / "out"))
    back = predictions.read_predictions(spark, str(tmp_path / "out"))
    assert back.drop("rec_no").collect() == known.drop("rec_no").collect()
    bad = [({"expected": {}}, "'expected' must be a list"), ({"expected": [], "predicted": [{}]}, "non-empty 'name'"), ({"expected": [], "predicted": [], "malformed": True}, "count")]
    bad += [({"expected": [], "predicted": [], "truncated": 1}, "boolean"), ([], "JSON object")]
    for raw, part in bad:
        assert part in predictions.parse_record(json.dumps(raw))["error"]


def test_rates_without_a_base_are_undefined(spark, tmp_path):
    frames = report.evaluate(spark, write(tmp_path / "p.jsonl", [{"expected": [], "predicted": []}]))
    text = report.text_report(frames)
    assert "missed calls 0 (— of call turns)" in text and "name precision —" in text and "by tool" not in text
    assert report.rounded({"a": 0.12345, "b": None, "c": 3}) == {"a": round(0.12345, 4), "b": None, "c": 3}


def test_gate_and_token_report(spark):
    rows = spark.createDataFrame([(i, 2, 100 * i, 150 * i, 10 * i) for i in range(1, 9)], "conv_id long, examples long, longest_example long, epoch_tokens long, trained_tokens long")
    report.length_gate(rows, 800)
    with pytest.raises(ValueError, match=r"6 dialogues exceed 200 tokens: 3 \(300\).* and 1 more"):
        report.length_gate(rows, 200)
    with pytest.raises(ValueError, match=">= 1"):
        report.length_gate(rows, 0)
    text = report.token_report(rows, top=2)
    assert "dialogues: 8, examples: 16" in text and "longest: 8 800\nlongest: 7 700" in text and "p50 500" in text
    with pytest.raises(ValueError, match="fractions"):
        D.percentiles(rows, "examples", (1.5,))
