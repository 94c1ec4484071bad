"""Language identification with blended-spectrum n-gram presence kernels.

k(x, y) is the mean over n of |G_n(x) and G_n(y)| / sqrt(|G_n(x)| |G_n(y)|), where G_n is the set of hashed byte n-grams
of a text in lower case. Landmarks drawn from a bounded labelled sample give Nystrom features, on which one-versus-rest
kernel ridge regression is solved. The kernel is an inner product of scaled presence vectors, so landmarks and weights
fold into one matrix for each n, and a batch of texts is scored by matrix products over its presence matrix.

Defined results: a text that is null or has no letter gets ``und`` and score 0, as does every text if nothing can be
learned; equal scores go to the first language in order; repeated rows are predicted alike; labels that are null are no
training rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import arrow_bytes

#: n: bits of the hashed space.
ORDERS = {1: 8, 2: 13, 3: 14, 4: 14}
#: Bounds of the labelled sample: rows for each language and in all, landmarks for each language and in all. With more
#: languages than these take in full, each language has fewer; its first rows come before the second ones of any other.
SAMPLE, ROWS, LANDMARKS, MARKS = 250, 4_000, 48, 800
RIDGE, SHARPNESS, BATCH = 1e-3, 8.0, 128

_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[ord("A") : ord("Z") + 1] += 32
_CLASS[:65] = 32  # digits, punctuation and control characters count as white space
_CLASS[91:97] = 32
_CLASS[123:128] = 32


def presence(raw: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
    """For each n a float32 matrix (texts, 2 ** bits), rows scaled to unit length."""
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    symbol = _CLASS[raw]
    row = np.repeat(np.arange(rows, dtype=np.int64), lengths)
    left = np.repeat(offsets[1:], lengths) - np.arange(len(raw))  # bytes to the end of the text
    out = {}
    code = np.zeros(len(raw), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        size = len(raw) - n + 1
        code = code[: max(size, 0)] * np.uint32(257) + symbol[n - 1 :][: max(size, 0)]
        bits = ORDERS[n]
        flags = np.zeros((rows, 1 << bits), np.float32)
        if size > 0:
            slot = (code * np.uint32(2654435761) >> np.uint32(32 - bits)).astype(np.int64)
            whole = left[:size] >= n
            flags.ravel()[(row[:size] << bits | slot)[whole]] = 1
        flags /= np.sqrt(np.maximum(flags.sum(axis=1, keepdims=True), 1))
        out[n] = flags
    return out


def features_of(texts: list[str]) -> dict[int, np.ndarray]:
    data = [t.encode("utf-8", "replace") for t in texts]
    return presence(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64))


def _batches(texts: list[str]) -> Iterator[tuple[int, int, dict[int, np.ndarray]]]:
    for at in range(0, len(texts), BATCH):
        yield at, min(at + BATCH, len(texts)), features_of(texts[at : at + BATCH])


def learn(texts: list[str], labels: list[str]) -> dict | None:
    """Matrices for each n, and the languages in order. Only the landmarks' features are held; those of the sample pass by
    in batches."""
    names = sorted(set(labels))
    if not names:
        return None
    each = max(1, min(LANDMARKS, MARKS // len(names)))
    marks = [i for name in names[:MARKS] for i in [k for k, y in enumerate(labels) if y == name][:each]]
    held = [x for _, _, x in _batches([texts[i] for i in marks])]
    mark = {n: np.concatenate([x[n] for x in held]) for n in ORDERS}
    value, vector = np.linalg.eigh((sum(mark[n] @ mark[n].T for n in ORDERS) / len(ORDERS)).astype(np.float64))
    inverse_root = (vector / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    target = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    target = target * np.minimum(np.sqrt(1 / np.maximum((target > 0).mean(axis=0), 1e-9)), 1)
    left, right = RIDGE * len(labels) * np.eye(len(marks)), np.zeros((len(marks), len(names)))
    for a, b, x in _batches(texts):
        phi = (sum(x[n] @ mark[n].T for n in ORDERS) / len(ORDERS)).astype(np.float64) @ inverse_root
        left += phi.T @ phi
        right += phi.T @ target[a:b]
    fold = (inverse_root @ np.linalg.solve(left, right)) / len(ORDERS)
    return {"names": names, "matrix": {n: (mark[n].T @ fold).astype(np.float32) for n in ORDERS}}


def predict(model: dict | None, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best language and a score from 0 to 1, for each text."""
    found = presence(raw, offsets)
    score = sum(found[n] @ model["matrix"][n] for n in ORDERS).astype(np.float64)
    best = score.argmax(axis=1)
    e = np.exp(SHARPNESS * (score - score.max(axis=1, keepdims=True)))
    return best, np.clip(1 / e.sum(axis=1), 0, 1)


def training_sample(docs: DataFrame, learnable: Column, id_col: str, text_col: str, label_col: str) -> tuple[list[str], list[str]]:
    """At most SAMPLE rows of each language and ROWS in all, by the hash of their ids and texts; rows that repeat both
    count once. Only keys are ranked; the texts of those chosen come last."""
    text = F.col(text_col).cast("string")
    rows = docs.where(learnable & F.col(label_col).isNotNull() & text.isNotNull()).select(F.col(label_col).alias("lang"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    ranked = rows.select("lang", "key").withColumn("rank", F.dense_rank().over(Window.partitionBy("lang").orderBy("key"))).where(F.col("rank") <= SAMPLE)
    chosen = ranked.distinct().orderBy("rank", "lang").limit(ROWS).select("lang", "key")
    got = rows.join(F.broadcast(chosen), ["lang", "key"]).groupBy("key", "lang").agg(F.first("text").alias("text")).orderBy("key", "lang").toPandas()
    return got["text"].tolist(), got["lang"].tolist()


def identify(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; learns from rows where ``learnable`` holds."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learn(*training_sample(docs, learnable, id_col, text_col, label_col)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = model.value
        for whole in batches:
            at = 0
            sizes = [len(t) if t is not None else 0 for t in whole.column("text").to_pylist()]
            while at < len(sizes):  # at most BATCH texts, and about a million characters
                to, total = at, 0
                while to < len(sizes) and to - at < BATCH and (to == at or total + sizes[to] <= 1_000_000):
                    total += sizes[to]
                    to += 1
                batch = whole.slice(at, to - at)
                texts = batch.column("text").to_pylist()
                langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                if own:
                    best, scores = predict(own, *arrow_bytes(batch.column("text")))
                    lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
                    langs = [own["names"][b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
                    scores = np.where(lettered, scores, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])
                at = to

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
