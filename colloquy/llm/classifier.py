"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(theta_k - w . x) with ordered thresholds theta and one weight vector for all grades. x holds the
presence of hashed words and a few shares of character classes. The model is fitted on a bounded sample of labelled
rows; every text is scored whole.

Grades: 0 toxic, 1 low quality, 2 good. Defined results: null or empty text has no features and is scored by the
thresholds alone; labels that are null are left out, and of several labels of one document the worst counts; repeated
rows are scored alike; with fewer than two grades to learn from every document has expected grade null and is kept; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Roller, arrow_bytes, mix

#: Bits of the hashed space, labelled rows at most, documents in which a slot must occur, passes, step and shrinkage.
BITS, SAMPLE, LEAST_DF, PASSES, STEP, SHRINK = 20, 12_000, 4, 12, 0.15, 1e-5
GRADES = 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[97:123] = _WORD[65:91] = _WORD[128:] = True
_TABLE = mix(np.arange(256, dtype=np.uint64) + np.uint64(7), 0x51ED270B7F3A1C95)
_ROLL = Roller(0x9FB21C651E98DF25)
SHARES = [b"#*$%&", b"|<>", b"!", b"0123456789", bytes(range(65, 91)), b" ", b"\n", b"."]
_CLASSES = np.zeros((len(SHARES), 256), bool)
for _k, _chars in enumerate(SHARES):
    _CLASSES[_k, list(_chars)] = True


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot) of each word present, and a dense matrix of shares."""
    rows = len(offsets) - 1
    dense = np.zeros((rows, len(SHARES)))
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), dense
    length = np.diff(offsets)
    for k in range(len(SHARES)):
        total = np.concatenate([[0], np.cumsum(_CLASSES[k][raw])])
        dense[:, k] = np.sqrt((total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(length, 1))
    inside = _WORD[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    h = mix(_ROLL.of(_ROLL.prefix(_TABLE[_LOWER[raw]]), start, end), 0xA0761D6478BD642F) >> np.uint64(64 - BITS)
    row = np.searchsorted(offsets, start, side="right") - 1
    pair = np.unique(row.astype(np.int64) << BITS | h.astype(np.int64))
    return pair >> BITS, pair & ((1 << BITS) - 1), dense


def featured(batches: Iterator) -> Iterator:
    """Slots and shares of each text, a few texts at a time; the driver gets these instead of texts."""
    import pyarrow as pa

    for whole in batches:
        for at in range(0, len(whole), 100):
            batch = whole.slice(at, 100)
            row, slot, dense = features(*arrow_bytes(batch.column("text")))
            first = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
            slots = pa.ListArray.from_arrays(pa.array(first), pa.array(slot.astype(np.int32)))
            shares = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(SHARES)), pa.array(dense.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), batch.column("k1"), batch.column("k2"), slots, shares], ["grade", "k1", "k2", "slots", "shares"])


def fit(slots: list[np.ndarray], dense: np.ndarray, grades: np.ndarray) -> dict | None:
    """Weights, dense weights and ordered thresholds, by stochastic gradient steps scaled by past gradients."""
    if len(set(grades.tolist())) < 2:
        return None
    row, slot = np.repeat(np.arange(len(slots)), [len(x) for x in slots]), np.concatenate(slots)
    df = np.bincount(slot, minlength=1 << BITS)
    often = df[slot] >= LEAST_DF
    row, slot = row[often], slot[often]
    first = np.searchsorted(row, np.arange(len(slots) + 1))
    w, g2 = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    v, v2 = np.zeros(dense.shape[1]), np.full(dense.shape[1], 1e-3)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=GRADES))[:-1] / len(grades), 0.01, 0.99)
    theta, t2 = np.log(share / (1 - share)), np.full(GRADES - 1, 1e-3)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    rng = np.random.default_rng(20_240_601)
    for _ in range(PASSES):
        order = rng.permutation(len(slots))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            take = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            own = np.repeat(np.arange(len(some)), first[some + 1] - first[some])
            z = np.bincount(own, w[slot[take]], minlength=len(some)) + dense[some] @ v
            y = grades[some]
            cum = sigmoid(np.concatenate([np.full((len(some), 1), -1e9), theta[None, :] - z[:, None], np.full((len(some), 1), 1e9)], axis=1))
            cum[:, 0], cum[:, -1] = 0, 1
            slope = cum * (1 - cum)
            r = np.arange(len(some))
            p = np.maximum(cum[r, y + 1] - cum[r, y], 1e-9)
            dz = (slope[r, y + 1] - slope[r, y]) / p  # of the negative log likelihood
            dt = np.zeros(GRADES - 1)
            for k in range(GRADES - 1):
                dt[k] = ((y == k + 1) * slope[:, k + 1] / p - (y == k) * slope[:, k + 1] / p).sum()
            s, back = np.unique(slot[take], return_inverse=True)
            g = np.bincount(back, dz[own], minlength=len(s)) + SHRINK * len(some) * w[s]
            g2[s] += g * g
            w[s] -= STEP * g / np.sqrt(g2[s])
            g = dense[some].T @ dz
            v2 += g * g
            v -= STEP * g / np.sqrt(v2)
            t2 += dt * dt
            theta = np.maximum.accumulate(theta - STEP * dt / np.sqrt(t2))
    return {"w": w.astype(np.float32), "v": v, "theta": theta}


def score(model: dict, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """P(grade <= k) for each text and each threshold."""
    row, slot, dense = features(raw, offsets)
    z = np.bincount(row, model["w"][slot], minlength=len(offsets) - 1) + dense @ model["v"]
    return 1 / (1 + np.exp(-np.clip(model["theta"][None, :] - z[:, None], -30, 30)))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from the columns quality and toxic; the worst label of a document counts."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def classify(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, expected_grade, p_toxic, p_good, kept): kept where P(grade = best) is at least ``keep``."""
    spark = docs.sparkSession
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = rows.join(F.broadcast(chosen), "doc_id").select(F.col("grade").cast("long"), "text", F.xxhash64("doc_id").alias("k1"), F.xxhash64("text").alias("k2"))
    got = keyed.mapInArrow(featured, "grade long, k1 long, k2 long, slots array<int>, shares array<double>").orderBy("k1", "k2").limit(sample).toArrow()
    model = None
    if len(got):
        slots = [x.values.to_numpy() for x in got.column("slots")]
        model = fit(slots, np.array(got.column("shares").to_pylist()), got.column("grade").to_numpy())
    model = spark.sparkContext.broadcast(model)
    del got

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = model.value
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                n = len(batch)
                if own is None:
                    cols = [pa.nulls(n, pa.float64())] * 3 + [pa.array([True] * n)]
                else:
                    cum = score(own, *arrow_bytes(batch.column("text")))
                    cols = [pa.array(x) for x in ((1 - cum).sum(axis=1), cum[:, 0], 1 - cum[:, -1], 1 - cum[:, -1] >= keep)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "expected_grade", "p_toxic", "p_good", "kept"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, expected_grade double, p_toxic double, p_good double, kept boolean")
