"""Substring dedup by seed and extend.

Seeds: of all 24 grams of 12 words in a window of 35, the one with the least hash (the last of equal ones) is its
anchor, so equal windows have equal anchors (winnowing). Windows of a document that share an anchor are one chunk.
Anchors that occur once are done with. Extension runs on both sides of an anchor at once: chunks around the same anchor
that are equal in full are repeated in full; where chunks around an anchor differ, one of each kind is opened into its
windows, which are counted around that anchor. Adjoining repeated windows form the maximal repeats.

No pair of occurrences is ever made: every step is a count by hash, with partial aggregation, or a join against one row
for each key, which adaptive execution can split. A window is told by two independent 64-bit fingerprints (anchor and
content).

Defined results: null or empty text has no words; a text below 35 words keeps all; rows that repeat an id and text are
separate places, so windows in them repeat; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Roller, arrow_bytes, texts, word_hashes, word_spans, written

WINDOW, GRAM = 35, 12
#: Keys up to this number (about 100 bytes each in a hash relation) are sent to all executors when windows are opened; with
#: more the texts are joined by a shuffle alone.
BROADCAST_KEYS = 250_000

_ANCHOR = Roller(0x8F14E45FCEEA167B)
_CONTENT = Roller(0xC9F0F895FB98AB91)


def _last_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the last place of the least of values[i : i + width], by doubling."""
    at = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] <= values[left], right, left)
        span += step
    return at


class _Words:
    """Fingerprints of the words of a batch of texts, for ranges of them."""

    def __init__(self, column):
        raw, offsets = arrow_bytes(column)
        start, end, self.first = word_spans(raw, offsets)
        self.one = word_hashes(raw, start, end, 0)
        self.two = word_hashes(raw, start, end, 1)
        self._prefix = _CONTENT.prefix(self.two)

    def content(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (_CONTENT.of(self._prefix, start, end) ^ (end - start).astype(np.uint64)).view(np.int64)


def chunks_of(column, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """row, start (word of the row at which the first window starts), windows, anchor, content of each chunk."""
    words = _Words(column)
    n = len(words.one)
    if n < window:
        return {k: np.zeros(0, np.int64) for k in ("row", "start", "windows", "anchor", "content")}
    places = np.arange(n - gram + 1)
    anchors = _ANCHOR.of(_ANCHOR.prefix(words.one), places, places + gram)
    anchors ^= anchors >> np.uint64(29)
    anchors *= np.uint64(0xBF58476D1CE4E5B9)
    at = _last_minimum(anchors, window - gram + 1)
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
    if not len(whole):
        return {k: np.zeros(0, np.int64) for k in ("row", "start", "windows", "anchor", "content")}
    own, of = at[whole], row[whole]
    head = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (of[1:] != of[:-1])]))
    tail = np.append(head[1:], len(whole)) - 1
    return {
        "row": of[head],
        "start": whole[head] - words.first[of[head]],
        "windows": tail - head + 1,
        "anchor": anchors[own[head]].view(np.int64),
        "content": words.content(whole[head], whole[tail] + window),
    }


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a key of 96 bits made from id and text; what one row of a key gets, all get."""
    return texts(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2"))


def _chunks(window: int, gram: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                c = chunks_of(batch.column("text"), window, gram)
                take = pa.array(c["row"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").take(take), batch.column("k2").take(take), pa.array(c["start"].astype(np.int32)), pa.array(c["windows"].astype(np.int32)), pa.array(c["anchor"]), pa.array(c["content"])],
                    ["k1", "k2", "start", "windows", "anchor", "content"],
                )

    return run


def _open(window: int):
    """The windows of the chunks listed with each text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.slice(at, 200)
                words = _Words(batch.column("text"))
                listed = batch.column("chunks")
                sizes = np.diff(listed.offsets.to_numpy())
                row = np.repeat(np.arange(len(batch)), sizes)
                flat = listed.flatten()
                field = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
                n = field["windows"].astype(np.int64)
                chunk = np.repeat(np.arange(len(n)), n)
                start = field["start"].astype(np.int64)[chunk] + np.arange(len(chunk)) - np.repeat(np.cumsum(n) - n, n)
                row = row[chunk]
                first = words.first[row] + start
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").take(take), batch.column("k2").take(take), pa.array(start.astype(np.int32)), pa.array(field["alone"][chunk].astype(bool)), pa.array(field["anchor"][chunk]), pa.array(words.content(first, first + window))],
                    ["k1", "k2", "start", "alone", "anchor", "content"],
                )

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(k1, k2, starts, windows): for each row with repeats the runs of window starts that occur elsewhere too."""
    keyed = _keyed(docs, id_col, text_col)
    chunks = keyed.select("k1", "k2", "text").mapInArrow(_chunks(window, gram), "k1 long, k2 int, start int, windows int, anchor long, content long")
    seeds = chunks.groupBy("anchor").agg(F.count("*").alias("n"), F.min("content").alias("a"), F.max("content").alias("b"))
    seeds = written(seeds.where("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("several")), "seeds")
    seeded = written(chunks.join(seeds, "anchor"), "seeded")
    kinds = seeded.where("several").groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start", "windows")).alias("one"))
    kinds = written(kinds, "kinds")
    equal = seeded.where("NOT several").select("k1", "k2", "start", "windows")
    copies = seeded.where("several").join(kinds.where("n > 1").select("anchor", "content"), ["anchor", "content"]).select("k1", "k2", "start", "windows")

    opened = kinds.groupBy("one.k1", "one.k2").agg(F.collect_list(F.struct("one.start", "one.windows", (F.col("n") == 1).alias("alone"), "anchor")).alias("chunks"))
    opened = written(opened, "opened")
    body = keyed.select("k1", "k2", "text")
    if opened.count() <= BROADCAST_KEYS:  # then only texts in which something is opened are shuffled
        body = body.join(F.broadcast(opened.select("k1", "k2")), ["k1", "k2"], "left_semi")
    # Rows that repeat a key open the same windows each, as separate places.
    windows = body.join(opened, ["k1", "k2"]).select("k1", "k2", "text", "chunks").mapInArrow(_open(window), "k1 long, k2 int, start int, alone boolean, anchor long, content long")
    windows = written(windows, "windows")
    often = windows.groupBy("anchor", "content").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "content")
    found = windows.where("alone").join(often, ["anchor", "content"]).select("k1", "k2", "start", F.lit(1).alias("windows"))
    return equal.unionByName(copies).unionByName(found).groupBy("k1", "k2").agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows"))


def _covered(n: int, starts: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + windows + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans): spans are the maximal repeats as word ranges, ends exclusive.

    With ``with_text`` also ``text``, the kept words joined by one space.
    """
    found = repeats(docs, id_col, text_col, window, gram)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, starts, runs in zip(batch.column("text"), batch.column("starts"), batch.column("windows"), strict=True):
                words = (text.as_py() or "").encode("utf-8").split()
                kept, spans = words, []
                if starts.is_valid:
                    gone = _covered(len(words), starts.values.to_numpy().astype(np.int64), runs.values.to_numpy().astype(np.int64), window)
                    kept = list(compress(words, (~gone).tolist()))
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans = edge.reshape(-1, 2).tolist()
                body = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest(), spans, body.decode("utf-8")))
            n, gone, sha, spans, body = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32())))]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
            if with_text:
                arrays, names = [*arrays, pa.array(body, pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = _keyed(docs, id_col, text_col).join(found, ["k1", "k2"], "left").select("doc_id", "text", "starts", "windows")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, spans array<array<int>>" + ", text string" * with_text)
