"""Reports of the dialogue engine: scoring of prediction records as numbers and as text, and token statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import branch_of
from ..operators import dialogues as D
from ..operators import scoring as S
from ..sources import predictions as P


def evaluated(records: DataFrame) -> dict[str, DataFrame]:
    """Frames ``overall``, ``by_tool``, ``by_branch`` and ``wrong`` (wrong turns in order, with described calls)."""
    pairs = S.measured_pairs(P.calls_of(records))
    turns = records.select(F.col("rec_no").alias("turn_id"), "dialogue_id", branch_of(F.col("dialogue_id")).alias("branch"), "turn_index", "malformed", "invalid", "truncated", P.described(F.col("expected")).alias("wanted"), P.described(F.col("predicted")).alias("got"))
    judged = S.judged_records(turns, pairs)
    return {"overall": S.full_report(judged), "by_tool": S.full_by_tool(pairs), "by_branch": S.full_by_branch(judged), "wrong": judged.where("NOT correct").orderBy("turn_id")}


def evaluate(spark: SparkSession, path: str, dialogues: DataFrame | None = None) -> dict[str, DataFrame]:
    """Score a file of prediction records, with problems checked anew against dialogues where these are given."""
    records = P.read_predictions(spark, path)
    return evaluated(P.rechecked(records, dialogues, path) if dialogues is not None else records)


def rounded(row: dict) -> dict:
    """A report row with its rates to four digits."""
    return {k: round(v, 4) if isinstance(v, float) else v for k, v in row.items()}


def percent(rate: float | None) -> str:
    return "—" if rate is None else f"{100 * rate:.1f}%"


def ratio(rate: float | None) -> str:
    return "—" if rate is None else f"{rate:.3f}"


def aligned(header: list[str], rows: list[list[str]]) -> list[str]:
    """A table: the first column to the left, all others to the right, two spaces apart and before."""
    columns = [[str(x) for x in c] for c in zip(header, *rows, strict=True)]
    padded = [[x.ljust(max(map(len, c))) if k == 0 else x.rjust(max(map(len, c))) for x in c] for k, c in enumerate(columns)]
    return ["  " + "  ".join(line) for line in zip(*padded, strict=True)]


#: The lines of the text report.
HEADLINES = """turns: {turns}, correct: {correct_turns} ({turn_accuracy:%})
  {correct_call_turns} of {expected_call_turns} call turns, {correct_reply_turns} of {expected_text_turns} reply turns, whose text is not scored
decisions: {expected_call_turns} turns expect a call, {expected_text_turns} a reply; false fires {false_fires} ({false_fire_rate:%} of reply turns), missed calls {missed_calls} ({missed_call_rate:%} of call turns)
calls: {expected} expected, {predicted} predicted, {malformed_calls} malformed, {invalid_calls} invalid ({valid_rate:%} would run)
  name precision {name_precision:r}  recall {name_recall:r} | exact precision {exact_precision:r}  recall {exact_recall:r} | argument accuracy {argument_accuracy:r}"""


class _Cell:
    def __init__(self, value):
        self.value = value

    def __format__(self, spec: str) -> str:
        return percent(self.value) if spec == "%" else ratio(self.value) if spec == "r" else str(self.value)


def text_report(frames: dict[str, DataFrame]) -> str:
    """The report in lines, headline first, sections in order of names; only aggregates reach the driver."""
    row = frames["overall"].first().asDict()
    lines = HEADLINES.format(**{k: _Cell(v) for k, v in row.items()}).split("\n")
    if row["truncated_turns"]:
        lines.append(f"truncated: {row['truncated_turns']} of {row['turns']} turns hit the token budget before finishing")
    tools = frames["by_tool"].orderBy("name").collect()
    if tools:
        cells = [[t.name, t.expected, t.predicted, t.exact, ratio(t.exact_precision), ratio(t.exact_recall), ratio(t.argument_accuracy)] for t in tools]
        lines += ["by tool:", *aligned("tool expected predicted exact precision recall arguments".split(), cells)]
    groups = frames["by_branch"].orderBy("branch").collect()
    if groups:
        cells = [[g.branch, g.turns, g.correct_turns, ratio(g.turn_accuracy), g.false_fires, g.missed_calls] for g in groups]
        lines += ["by branch:", *aligned(["branch", "turns", "correct", "accuracy", "false fires", "missed"], cells)]
    return "\n".join(lines)


def length_gate(rollup: DataFrame, limit: int, id_col: str = "conv_id") -> None:
    """Raise where a dialogue's longest example exceeds the limit, naming the first five."""
    if limit < 1:
        raise ValueError(f"max_seq_length must be >= 1, got {limit}")
    over = rollup.where(F.col("longest_example") > limit)
    n = over.count()
    if n:
        first = [f"{r[0]} ({r[1]})" for r in over.orderBy(id_col).select(id_col, "longest_example").limit(5).collect()]
        raise ValueError(f"{n} dialogues exceed {limit} tokens: {', '.join(map(str, first))}" + (f" and {n - 5} more" if n > 5 else ""))


def token_report(rollup: DataFrame, top: int = 5, id_col: str = "conv_id", width: int = 40) -> str:
    """Totals, trained share, spreads, histogram with scaled bars, fits, and the longest dialogues."""
    t = rollup.agg(F.count("*").alias("n"), F.sum("examples").alias("e"), F.sum("epoch_tokens").alias("all"), F.sum("trained_tokens").alias("own")).first()
    if not t["n"]:
        return "dialogues: 0"
    lines = [f"dialogues: {t['n']}, examples: {t['e']}, tokens per epoch: {t['all']}, trained: {t['own']} ({percent(t['own'] / t['all'])})"]
    for c in ("longest_example", "epoch_tokens", "trained_tokens"):
        at = {r.fraction: r.value for r in D.percentiles(rollup, c, (0.0, 0.5, 0.9, 1.0)).collect()}
        lines.append(f"{c}: min {at[0.0]}, p50 {at[0.5]}, p90 {at[0.9]}, max {at[1.0]}")
    bars = D.histogram(rollup, "longest_example", (256, 512, 1024, 2048, 4096)).collect()
    most = max(r.n for r in bars)
    lines += aligned(["tokens", "n", ""], [[r.bucket, r.n, ("#" * -(-r.n * width // most)).ljust(width)] for r in sorted(bars, key=lambda r: int(r.bucket.split("-")[0].rstrip("+")))])
    lines += [f"<= {r.threshold}: {r.fits}" for r in D.threshold_fits(rollup, "longest_example", (1024, 2048, 4096, 8192)).orderBy("threshold").collect()]
    lines += [f"longest: {r[0]} {r[1]}" for r in rollup.orderBy(F.desc("longest_example"), id_col).select(id_col, "longest_example").limit(top).collect()]
    return "\n".join(lines)
