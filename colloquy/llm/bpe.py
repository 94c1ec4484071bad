"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

The merges are compiled into a nondeterministic transducer over bytes. A sequence of tokens is the BPE encoding
of its bytes exactly when each token encodes to itself and every adjacent pair of tokens does, so a hypothesis needs
only (last token, place in the token trie). Subset construction on those hypotheses runs lazily and keeps the subsets
as states; a state gives the one token that can end on the way into it. What lies before the last token border that all
hypotheses of a subset share is settled and emitted; the lookahead is bounded by what the vocabulary leaves open.

Decoding streams ids through a table of token bytes and an incremental UTF-8 state machine.

Defined results: null or empty text gives no tokens (ids_sha256 and decoded_sha256 of the empty string); rows are
independent, so repeated rows and ties need no rule; columns other than the two named are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import getitem

import numpy as np
from pyspark.sql import DataFrame

from .shared import texts

ROOT = 0
#: Bytes after which settled tokens are emitted.
FLUSH = 4096


class State(dict):
    """A subset of hypotheses: transitions by byte, made at their first use, and the token that ends on the way in."""

    __slots__ = ("hypotheses", "machine", "token")

    def __init__(self, machine: MergeTransducer, hypotheses: tuple):
        super().__init__()
        self.machine, self.hypotheses = machine, hypotheses
        self.token = hypotheses[-1][0] if hypotheses and hypotheses[-1][1] == ROOT else -1

    def __missing__(self, byte: int) -> State:
        to = self[byte] = self.machine._move(self, byte)
        return to


class MergeTransducer:
    """Encodes byte strings by ranks, as repeated lowest-rank-first merging does."""

    #: States, pairs and pieces kept; beyond that a cache starts anew, which changes no result.
    max_states = 400_000
    max_pairs = 2_000_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        #: The trie: (node, byte) packed in one key, the token that ends at a node, and whether a node has children.
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner: list[bool] = [False]
        for token, rank in ranks.items():
            node = ROOT
            for b in token:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token_at)
                    self.inner[node] = True
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = nxt
            self.token_at[node] = rank
        self.depth = [0] * len(self.token_at)
        for key, node in self.child.items():  # parents come before their children
            self.depth[node] = self.depth[key >> 8] + 1
        self.length = {i: len(t) for t, i in ranks.items()}
        self._itself: dict[int, bool] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._split: dict[int, tuple[int, int] | None] = {}
        self._states: dict[tuple, State] = {}
        self._reset()

    def _reset(self) -> None:
        for state in self._states.values():
            state.clear()  # states lead to each other; without this they would wait for the cycle collector
        self._states = {}
        self.start = self._state(((-1, ROOT),))

    def _state(self, hypotheses: tuple) -> State:
        found = self._states.get(hypotheses)
        if found is None:
            found = self._states[hypotheses] = State(self, hypotheses)
        return found

    def _merged(self, piece: bytes, below: int = 1 << 60) -> list[int]:
        """Merge rule itself, for one token; ``below`` stops before merges of that rank."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(found)
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _stands(self, token: int) -> bool:
        known = self._itself.get(token)
        if known is None:
            known = self._itself[token] = self._merged(self.bytes_of[token]) == [token]
        return known

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the merge that makes this one; None for a single byte."""
        known = self._split.get(token, 0)
        if known == 0:
            piece = self.bytes_of[token]
            known = None
            if len(piece) > 1:
                left, right = self._merged(piece, below=token)
                known = left, right
            self._split[token] = known
        return known

    def _adjacent(self, a: int, b: int) -> bool:
        """Whether a and b stay apart: no merge across their border comes before those that made both sides of it."""
        known = self._pairs.get((a, b))
        if known is not None:
            return known
        if len(self._pairs) >= self.max_pairs:
            self._pairs.clear()
        left, right, limit, apart = a, b, 1 << 60, True
        while True:
            # left and right are now what stands at the border just before merges of rank ``limit``
            if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], 1 << 60) < limit:
                apart = False
                break
            # Undo the later of the two merges; of equal ones the right-hand one is the later.
            undo_left = left > right
            halves = self._halves(left if undo_left else right)
            if halves is None:
                undo_left = not undo_left
                halves = self._halves(left if undo_left else right)
                if halves is None:
                    break
            if undo_left:
                limit, left = left, halves[1]
            else:
                limit, right = right + 1, halves[0]
        self._pairs[a, b] = apart
        return apart

    def _move(self, state: State, byte: int) -> State:
        """Next state. Hypotheses stay in the order of where their open token begins, so equal subsets are equal tuples,
        and the one whose token ends here, if any, comes last."""
        child, inner = self.child, self.inner
        live, closed = [], -1
        for last, node in state.hypotheses:
            nxt = child.get(node << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                live.append((last, nxt))
            if closed < 0:  # a prefix has one encoding at most
                token = self.token_at[nxt]
                if token >= 0 and (last < 0 or self._adjacent(last, token)) and self._stands(token):
                    closed = token
        if closed >= 0:
            live.append((closed, ROOT))
        return self._state(tuple(live))

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > self.max_states:
            self._reset()
        out: list[int] = []
        path = [self.start]
        for at in range(0, len(piece), FLUSH):
            if at:
                cut = self._agreed(path)
                out += self._settled(path[: cut + 1])
                del path[:cut]
            path[-1:] = accumulate(piece[at : at + FLUSH], getitem, initial=path[-1])
        return out + self._settled(path)

    def _agreed(self, path: list[State]) -> int:
        """The last token border that the chains of all hypotheses share."""
        borders: set[int] | None = None
        for _, node in path[-1].hypotheses:
            at, own = len(path) - 1 - self.depth[node], set()
            while at > 0:
                own.add(at)
                at -= self.length[path[at].token]
            borders = own if borders is None else borders & own
        return max(borders or (), default=0)

    def _settled(self, path: list[State]) -> list[int]:
        """The tokens of a stretch, from the one that ends it back to its beginning."""
        out, at, length = [], len(path) - 1, self.length
        while at > 0:
            token = path[at].token
            if token < 0:
                raise ValueError("the vocabulary lacks some single byte")
            out.append(token)
            at -= length[token]
        out.reverse()
        return out


class Utf8Machine:
    """Incremental UTF-8 recogniser: how many continuation bytes are due, and in which range the next must lie."""

    START = (0, 0x80, 0xBF)

    @staticmethod
    def step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int]:
        due, low, high = state
        if due:
            if not low <= byte <= high:
                raise ValueError("not UTF-8")
            return (due - 1, 0x80, 0xBF)
        if byte < 0x80:
            return Utf8Machine.START
        if 0xC2 <= byte <= 0xDF:
            return (1, 0x80, 0xBF)
        if 0xE0 <= byte <= 0xEF:
            return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
        if 0xF0 <= byte <= 0xF4:
            return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
        raise ValueError("not UTF-8")

    @classmethod
    def run(cls, state: tuple[int, int, int], chunk: bytes) -> tuple[int, int, int]:
        for byte in chunk:
            state = cls.step(state, byte)
        return state


class StreamDecoder:
    """Ids in, text out; bytes of a character that is not complete wait for the next ids."""

    def __init__(self, bytes_of: dict[int, bytes]):
        size = max(bytes_of, default=-1) + 1
        self.table = [bytes_of.get(i, b"") for i in range(size)]
        self.flat = np.frombuffer(b"".join(self.table), np.uint8)
        self.length = np.array([len(t) for t in self.table], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.complete = np.zeros(size, bool)
        for i, chunk in enumerate(self.table):
            try:
                self.complete[i] = Utf8Machine.run(Utf8Machine.START, chunk) == Utf8Machine.START
            except ValueError:
                pass
        self.reset()

    def reset(self) -> None:
        self.state, self.held = Utf8Machine.START, b""

    def _bytes(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        length = self.length[ids]
        ends = np.cumsum(length)
        return self.flat[np.repeat(self.begin[ids] - ends + length, length) + np.arange(ends[-1])].tobytes()

    def feed(self, ids: np.ndarray) -> bytes:
        """The bytes of all characters that are now complete."""
        ids = np.asarray(ids, np.int64)
        open_at = np.flatnonzero(~self.complete[ids])
        state, k = self.state, -1
        for i in map(int, open_at):
            if state[0] and i != k + 1:
                raise ValueError("not UTF-8")
            state, k = Utf8Machine.run(state, self.table[ids[i]]), i
        if state[0] and k != len(ids) - 1:
            raise ValueError("not UTF-8")
        if self.state[0] and len(ids) and (not len(open_at) or open_at[0] != 0):
            raise ValueError("not UTF-8")
        data = self.held + self._bytes(ids)
        keep = 0
        if state[0]:
            keep = next(n for n in range(1, 5) if data[-n] >= 0xC0)
        self.state, self.held = state, data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep] if keep else data

    def finish(self) -> None:
        if self.state[0]:
            raise ValueError("ends within a character")
        self.reset()


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ChunkMemo(dict):
    """Decimal ids and packed ids (little-endian 16- or 32-bit) of a space and a chunk, by the chunk. A full memo starts
    anew."""

    max_chunks = 800_000

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> tuple[str, bytes]:
        return self.encode(" " + chunk)

    def keep(self, chunk: str, ids: tuple[str, bytes]) -> None:
        if len(chunk) <= 48:
            if len(self) >= self.max_chunks:
                self.clear()
            self[chunk] = ids


class BpeCodec:
    """Encoder and decoder of one rank file and split pattern.

    A text is cut where white space follows other text, which is always a piece boundary of the pattern, so that chunks
    can be looked up without the pattern.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.transducer = MergeTransducer(load_ranks(ranks_path))
        self.decoder = StreamDecoder(self.transducer.bytes_of)
        self.packed = np.dtype("<u2" if len(self.decoder.table) <= 1 << 16 else "<u4")
        self._common = re.compile(r"[\x09\x0a\x0d\x20-\x7e\xc0-\u024f]*").fullmatch
        self._uneven = regex.compile(r"\s(?=\x20)|(?![\x09-\x0d\x20])\s")
        self._memo = ChunkMemo(self._chunk)
        self._bare = ChunkMemo(self._chunk)

    def _piece(self, piece: str) -> tuple[str, bytes]:
        memo, key = (self._memo, piece[1:]) if piece[0] == " " and len(piece) > 1 else (self._bare, piece)
        known = memo.get(key)
        if known is None:
            ids = self.transducer.encode_piece(piece.encode("utf-8"))
            known = ",".join(map(str, ids)), np.array(ids, self.packed).tobytes()
            memo.keep(key, known)
        return known

    def _chunk(self, chunk: str) -> tuple[str, bytes]:
        pieces = self.pattern.findall(chunk)
        out = [self._piece(piece) for piece in pieces]
        if len(out) == 1:
            return out[0]
        found = ",".join([s for s, _ in out]), b"".join([p for _, p in out])
        if len(out) == 2 and chunk[0] == " " and "\n" not in chunk:
            self._memo.keep(chunk[1:], found)
        return found

    def _encoded(self, text: str) -> tuple[str, np.ndarray]:
        """White space before a space, and rare white space, make a cut there unsafe."""
        if not text:
            parts = []
        elif "  " in text or "\n " in text or "\t " in text or "\r " in text or (not self._common(text) and self._uneven.search(text)):
            parts = [self._chunk(text)]
        else:
            first, *rest = text.split(" ")
            parts = [self._chunk(first)] if first else []
            parts += map(self._memo.__getitem__, rest)
        return ",".join([s for s, _ in parts]), np.frombuffer(b"".join([p for _, p in parts]), self.packed)

    def encode(self, text: str) -> list[int]:
        return self._encoded(text)[1].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        self.decoder.reset()
        data = self.decoder.feed(np.fromiter(ids, np.int64))
        self.decoder.finish()
        return data.decode("utf-8")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the joined ids, SHA-256 of what they decode to."""
        joined, ids = self._encoded(text or "")
        self.decoder.reset()
        data = self.decoder.feed(ids)
        self.decoder.finish()
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(data).hexdigest()


_CODECS: dict[tuple[str, str], BpeCodec] = {}


@contextlib.contextmanager
def no_collector():
    """The memos hold many tuples and no cycles, and walking them again and again costs a tenth of the time. A worker
    process serves other tasks too, so the collector is off within one of ours only."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def codec(ranks_path: str, pattern: str) -> BpeCodec:
    """One codec for each Python worker process."""
    found = _CODECS.get((ranks_path, pattern))
    if found is None:
        _CODECS.clear()
        found = _CODECS[ranks_path, pattern] = BpeCodec(ranks_path, pattern)
    return found


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every text; null counts as empty."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = codec(ranks_path, pattern)
        for batch in batches:
            with no_collector():
                ids = [own.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    source = texts(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(rows: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every array of ids; null counts as no ids."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = codec(ranks_path, pattern)
        for batch in batches:
            out = [own.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    source = rows.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{ids_col}` AS array<int>) AS ids")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and return digests of both; no shuffle, one pass."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = codec(ranks_path, pattern)
        for batch in batches:
            with no_collector():
                found = [own.digest(t) for t in batch.column("text").to_pylist()]
            n, ids, back = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = texts(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
