"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens of a batch lie in one linked list of tokens. Every mergeable neighbour pair sits in
the bucket of its merge rank; a bitmap of three levels marks the ranks whose buckets have
entries, so the next rank is two or three find-first-set steps away whatever the list's length.
A merge only relinks neighbours and files the two new pairs; entries that an earlier merge made
stale are recognised by the rank now stored at their position and skipped. Nothing rescans a
pre-token, so one of a megabyte costs about as much for each byte as a short one.

Texts: null counts as empty, which gives no tokens. Special tokens are ordinary text. Each row is
encoded by itself; repeated rows give repeated results, other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltcomb.llm._pieces import PieceTable
from siltcomb.llm._runtime import give_back, narrowed, ship


#: Pre-tokens and pieces that are remembered, and characters of texts that are worked on at once; they decide what a worker takes.
KNOWN, CHUNK = 250_000, 2_000_000


class RankBitmap:
    """A set of small integers whose least member is found by find-first-set on each level."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + 63) >> 6
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, x: int) -> None:
        for level in self.levels:
            word = level[x >> 6]
            level[x >> 6] = word | (1 << (x & 63))
            if word:
                return
            x >>= 6

    def discard(self, x: int) -> None:
        for level in self.levels:
            word = level[x >> 6] & ~(1 << (x & 63))
            level[x >> 6] = word
            if word:
                return
            x >>= 6

    def first(self) -> int:
        """The least member, -1 if there is none."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = (at << 6) + (word & -word).bit_length() - 1
        return at


class RankQueueBPE:
    """BPE by ranks: of all neighbour pairs, the one with the least rank merges first, from the left.

    The entries of a bucket are handled together as arrays. That is exact as long as no pair that
    comes of them ranks below the bucket; where one does, its entries are taken one by one.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        keys, values = [], []
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        every = self.single[np.arange(65536) >> 8] << 32 | self.single[np.arange(65536) & 255]
        self.first_pairs = self._find(every)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair (left id << 32 | right id), -1 where it can't merge."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.values[at], -1)

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, four little-endian bytes each. A pre-token that is a token is that token."""
        ranks = self.ranks
        out: list = [ranks[p].to_bytes(4, "little") if p in ranks else b"" for p in pieces]
        todo = [i for i, p in enumerate(pieces) if p and not out[i]]
        if not todo:
            return out
        data = np.frombuffer(b"".join([pieces[i] for i in todo]), np.uint8)
        n = len(data)
        kind = np.int32 if n < 1 << 31 else np.int64
        ends = np.cumsum([len(pieces[i]) for i in todo])
        starts = np.concatenate([[0], ends[:-1]])
        token, alive = self.single.astype(np.int32)[data], np.ones(n, bool)
        after, before = np.arange(1, n + 1, dtype=kind), np.arange(-1, n - 1, dtype=kind)
        after[ends - 1], before[starts] = -1, -1
        pair = np.full(n, -1, np.int32)
        pair[:-1] = self.first_pairs[data[:-1].astype(np.int32) << 8 | data[1:]]
        pair[ends - 1] = -1
        queue, buckets = RankBitmap(self.size), {}

        def file(positions: np.ndarray, ranks_: np.ndarray) -> None:
            some = ranks_ >= 0
            positions, ranks_ = positions[some], ranks_[some]
            order = np.argsort(ranks_, kind="stable")
            positions, ranks_ = positions[order], ranks_[order]
            cuts = np.flatnonzero(np.diff(ranks_)) + 1
            for r, a, b in zip(ranks_[[0, *cuts]].tolist() if len(ranks_) else [], [0, *cuts.tolist()], [*cuts.tolist(), len(ranks_)], strict=False):
                if r in buckets:
                    buckets[r].append(positions[a:b])
                else:
                    buckets[r] = [positions[a:b]]
                    queue.add(r)

        def wide(positions: np.ndarray) -> np.ndarray:
            return token[positions].astype(np.int64)

        file(np.arange(n, dtype=kind), pair)
        while (rank := queue.first()) >= 0:
            queue.discard(rank)
            at = buckets.pop(rank)
            at = np.sort(at[0] if len(at) == 1 else np.concatenate(at))
            at = at[pair[at] == rank]  # the rest is stale
            if len(at) > 1:
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
                if (pair[after[at]] == rank).any():  # runs such as aaa, whose pairs overlap: leftmost first
                    keep, taken = [], -1
                    for i, j in zip(at.tolist(), after[at].tolist(), strict=True):
                        if i != taken:
                            keep.append(i)
                            taken = j
                    at = np.array(keep, np.int64)
                k, p = after[after[at]], before[at]
                near = np.concatenate([rank << 32 | wide(k[k >= 0]), wide(p[p >= 0]) << 32 | rank, [rank << 32 | rank]])
                near = self._find(near)
                if ((near >= 0) & (near < rank)).any():
                    # one of the new pairs comes before the rest of this bucket
                    buckets[rank] = [at[1:]]
                    queue.add(rank)
                    at = at[:1]
            if not len(at):
                continue
            j = after[at]
            k = after[j]
            token[at], after[at], pair[j], alive[j] = rank, k, -1, False
            has = k >= 0
            before[k[has]] = at[has]
            right = np.full(len(at), -1, np.int64)
            right[has] = self._find(rank << 32 | wide(k[has]))
            pair[at] = right
            p = before[at]
            p = p[p >= 0]
            left = self._find(wide(p) << 32 | rank)
            pair[p] = left
            file(np.concatenate([at, p]), np.concatenate([right, left]))
        ids = token[alive].astype("<u4").tobytes()
        bounds = (np.cumsum(alive)[ends - 1] * 4).tolist()
        a = 0
        for i, b in zip(todo, bounds, strict=True):
            out[i] = ids[a:b]
            a = b
        return out


class Codec:
    """Encodes texts and decodes ids for a tiktoken rank file and a pre-tokenizer pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.bpe = RankQueueBPE(ranks)
        self.split = regex.compile(pattern).findall
        self.plain = all(self.split(x) == y for x, y in ((" ab", [" ab"]), (" ab,", [" ab", ","]), ("ab!", ["ab", "!"]), (" a.", [" a", "."])))
        self.known: dict[str, bytes] = {}
        self.table = PieceTable(self._work, limit=KNOWN)

    def _work(self, chunks: list[str]) -> list[bytes]:
        split = self.split
        # an ASCII word is one match of any such pattern, a mark behind it another
        cut = [split(c) if not (c.isascii() and (c[:1] == " " or c[:1].isalpha())) else [c] if c[1:].isalpha() else [c[:-1], c[-1]] if c[1:-1].isalpha() and c[-1] in ".,;:?!" else split(c) for c in chunks] if self.plain else list(map(split, chunks))
        if len(self.known) > KNOWN:
            self.known.clear()
        known = self.known
        missing = [p for p in {p for c in cut for p in c} if p not in known]
        known.update(zip(missing, self.bpe.encode_many([p.encode() for p in missing]), strict=True))
        out = [b"".join([known[p] for p in c]) for c in cut]
        for p in missing:
            if len(p) > 64:
                del known[p]
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for values in self.table.rows(texts, CHUNK):
            yield b"".join(values)

    def forget(self) -> None:
        """Lets go of what is remembered of texts: a worker outlives its task, and what comes next needs the memory."""
        self.known = {}
        self.table = PieceTable(self._work, limit=KNOWN)
        give_back()

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bpe.bytes_of.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``CHUNK`` bytes, so that no more texts than that are Python objects at once."""
    for batch in batches:
        step = max(1, batch.num_rows * CHUNK // max(1, batch.nbytes))
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids as an array, one row for each row of ``df``."""

    def run(batches):
        c = codec(path, pattern)
        try:
            for batch in slices(batches):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = [memoryview(x).cast("I").tolist() for x in c.encode(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        finally:
            c.forget()

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): what :func:`encode` was given (null ids: an empty text)."""

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            texts = [b"".join([c.bpe.bytes_of[i] for i in x or []]).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, ids=ids_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids, both digested."""

    def run(batches):
        c = codec(path, pattern)
        sha = hashlib.sha256
        try:
            for batch in slices(batches):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                n, a, b = [], [], []
                for ids in c.encode(texts):
                    n.append(len(ids) >> 2)
                    a.append(sha(ids).hexdigest())
                    b.append(sha(c.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            c.forget()

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
