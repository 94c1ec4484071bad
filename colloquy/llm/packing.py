"""Packing of token ids into sequences by order-preserving dynamic programming.

Documents are dealt out in ranges of doc_id and keep that order. Within a block of them the cuts are chosen among
document ends, sentence ends, and forced places inside a sentence that is longer than a sequence, so as to minimise
padding plus penalties for cutting a document. cost(i, j) = capacity - (pos j - pos i) + penalty j, so the best i is a
sliding-window minimum of f(i) + pos(i), which a monotone queue gives in constant time; sequences whose length is a power
of two need no padding and are further transitions.

Defined results: null or empty text is the end id alone; repeated rows are packed each; rows that tie on the id follow in
order of their text's hash; other columns are ignored; an empty table gives an empty result. A block is bounded in
tokens, so memory does not grow with a partition; a document longer than a block is a block.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import texts

CAPACITY = 2048
END_ID = 1
#: Penalties, in tokens of padding, for a cut at a sentence end and within a sentence.
CUT_SENTENCE, CUT_WORD = 12, 256
#: Cuts inside a document keep this distance, which bounds the candidates.
LEAST_GAP = 16
BLOCK_TOKENS = 2_000_000


def choose_cuts(pos: list[int], penalty: list[int], capacity: int = CAPACITY) -> list[int]:
    """Indices of the chosen cuts, first and last included; neighbours in ``pos`` are at most ``capacity`` apart."""
    n = len(pos)
    cost, came = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque()  # (cost + position, index), both rising
    powers = [p for p in (1 << k for k in range(8, 64)) if p < capacity]
    index = {p: i for i, p in enumerate(pos)}
    for j in range(1, n):
        here = pos[j]
        g = cost[j - 1] + pos[j - 1]
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, j - 1))
        while pos[queue[0][1]] < here - capacity:
            queue.popleft()
        best, i = queue[0]
        best += capacity - here
        for p in powers:
            k = index.get(here - p)
            if k is not None and cost[k] < best:
                best, i = cost[k], k
        cost[j], came[j] = best + penalty[j], i
    out = [n - 1] if n > 1 else []
    while out and out[-1]:
        out.append(came[out[-1]])
    return out[::-1]


#: The split pattern of byte-level vocabularies without one of their own, its form for texts without runs of
#: white space, and the characters whose classes every Unicode version gives alike.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
RUNLESS_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
SETTLED = r"[\x09\x0a\x0d\x20-\x7e\xc0-\u024f]*"
RUNS = ("  ", "\n\n", "\n ", " \n", "\t", "\r")


def token_bytes(spelled: str) -> bytes:
    """The bytes behind a byte-level spelling: printable Latin-1 stands for itself, the other bytes for U+0100 onwards."""
    return bytes(_BYTE_OF[c] for c in spelled)


_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class SentenceTokenizer:
    """Ids as the tokenizers library gives them, with the places after which a sentence ends.

    Where the file is a plain byte-level BPE whose ids rise with its merges, texts of settled characters go through
    tiktoken with the same merges, which keeps no offsets and gives the same ids; all others, and those that hold the
    string of an added token, go through the library.
    """

    def __init__(self, path: str):
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.packed = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token[-1:] in (".", "!", "?", "\n") or "\u010a" in token
        with open(path, encoding="utf-8") as f:
            self.plain, self.runless = self._merges(json.load(f))
        self._settled = re.compile(SETTLED).fullmatch
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None

    @staticmethod
    def _merges(spec: dict) -> tuple:
        """The same vocabulary for tiktoken under both patterns, or nothing where the file is anything but a plain
        byte-level BPE."""
        none = None, None
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get("type") != "BPE" or any(model.get(k) for k in odd) or spec.get("normalizer"):
            return none
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return none
        vocab = model["vocab"]
        if not all(set(t) <= _BYTE_OF.keys() for t in vocab) or not all(c in vocab for c in _BYTE_OF):
            return none
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(set(made)) or len(made) + 256 != len(vocab):
            return none
        import tiktoken

        ranks = {token_bytes(t): i for t, i in vocab.items()}
        return tuple(
            tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for name, pattern in (("plain", BYTE_LEVEL_PATTERN), ("runless", RUNLESS_PATTERN))
        )

    def ids(self, text: str) -> np.ndarray:
        if self.plain is not None and self._settled(text) and not self._added(text):
            own = self.plain if any(r in text for r in RUNS) else self.runless
            return own.encode_to_numpy(text, disallowed_special=()).astype(self.packed)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.packed)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text, and the places after which a sentence ends."""
        ids = self.ids(text)
        return ids, np.flatnonzero(self.ends[ids]) + 1


_TOKENIZERS: dict[str, SentenceTokenizer] = {}


def sentence_tokenizer(path: str) -> SentenceTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[path] = SentenceTokenizer(path)
    return _TOKENIZERS[path]


def candidates(lengths: list[int], sentence_ends: list[np.ndarray], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Positions of all places where a cut may be, with their penalties; lengths include the end id."""
    pos, penalty, base = [0], [0], 0
    for n, ends in zip(lengths, sentence_ends, strict=True):
        at = base
        for e in ends.tolist():
            here = base + e
            if here - at < LEAST_GAP or base + n - here < LEAST_GAP:
                continue
            while here - at > capacity:
                at += capacity
                pos.append(at)
                penalty.append(CUT_WORD)
            if here > at:
                pos.append(here)
                penalty.append(CUT_SENTENCE)
                at = here
        base += n
        while base - at > capacity:
            at += capacity
            pos.append(at)
            penalty.append(CUT_WORD)
        pos.append(base)
        penalty.append(0)
    return pos, penalty


def pack_block(ids: list[np.ndarray], sentence_ends: list[np.ndarray], capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int, int]]:
    """(document number, start, length, sequence number, offset) of each piece."""
    lengths = [len(x) for x in ids]
    pos, penalty = candidates(lengths, sentence_ends, capacity)
    cuts = [pos[i] for i in choose_cuts(pos, penalty, capacity)]
    doc, base = 0, 0
    for seq, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        at = a
        while at < b:
            while at >= base + lengths[doc]:
                base += lengths[doc]
                doc += 1
            n = min(b, base + lengths[doc]) - at
            yield doc, at - base, n, seq, at - a
            at += n


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and ``ids`` if asked for."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = sentence_tokenizer(tokenizer_path)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        names, ids, ends, held = [], [], [], 0

        def block():
            nonlocal sequence
            rows, last = [], -1
            for doc, start, n, seq, offset in pack_block(ids, ends, capacity):
                piece = ids[doc][start : start + n].astype("<u4")
                rows.append((names[doc], start, n, zlib.crc32(piece), len(ids[doc]), sequence + seq, offset, piece))
                last = seq
            sequence += last + 1
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:7]]]
            labels = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([x.tolist() for x in cols[7]], pa.list_(pa.int32())))
                labels.append("ids")
            out = pa.RecordBatch.from_arrays(arrays, labels)
            for c in (names, ids, ends):
                c.clear()
            return out

        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            keys = batch.column("doc_id").to_pylist()
            for at in range(0, len(keys), 1000):
                for key, text in zip(keys[at : at + 1000], batch.column("text").slice(at, 1000).to_pylist(), strict=True):
                    x, e = own(text or "")
                    names.append(key)
                    ids.append(np.append(x, np.array([END_ID], x.dtype)))
                    ends.append(e)
                    held += len(x) + 1
                    if held >= BLOCK_TOKENS:
                        yield block()
                        held = 0
        if names:
            yield block()

    source = texts(docs, id_col, text_col)
    ordered = source.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" * with_ids
    return ordered.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long{more}")
