"""Token-id files: one concatenated id array a shard, document boundaries in Elias-Fano form.

A shard is a block of bytes (all integers little-endian):

    magic ``SLTK1``, id width in bytes (2 or 4), 2 spare bytes
    n_docs, n_null (documents without an id, first in order), first id (signed), base, n_ids: 8 bytes each
    Elias-Fano sequence of the document ids, less the first
    Elias-Fano sequence of the end offsets of the documents
    the ids

An Elias-Fano sequence of n values up to u keeps the low ``floor(log2(u / n))`` bits of each value
packed, and the high bits in unary: 2 n bits or so plus the low bits, where a table would take 64 n.
``select`` finds a value from a sample of each 256th one-bit and a scan of the words between.

Shards hold at most ``shard_tokens`` ids (a longer document has one of its own), so memory is bounded
by the shard and the longest document. They travel as the binary rows of a Parquet table, which
Spark commits atomically to any store; :func:`export` puts one in a plain file.

Texts: null counts as empty. Rows keep ascending order of (doc_id, text), null ids first, and ids that are no integers count as
null; repeated ids are separate documents. Empty tables give a table of no shards. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltcomb.llm._pieces import PieceTable
from siltcomb.llm._runtime import narrowed, persisted, ship

MAGIC, HEAD = b"SLTK1", struct.Struct("<5sB2xqqqqq")
#: Letters and marks that every version of Unicode takes for such.
_L, _P = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]", r"[!-&(-/:-@\[-`{-~]"
#: One pre-token; a word, marks, a line break, a word, marks, each of which is a pre-token; what may stand within that.
_LETTERS = re.compile(f" ?{_L}+").fullmatch
_PARTS = re.compile(f"( ?{_L}+)({_P}+)?(?:(\n)({_L}+)({_P}+)?)?").fullmatch
_WITHIN = re.compile(f" ?{_L}*{_P}*(?:\n{_L}*{_P}*)?").fullmatch


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


_SHOWN = {b: c for c, b in byte_alphabet().items()}


class EliasFano:
    """A monotone sequence of non-negative integers in near-minimal space."""

    SAMPLE = 256

    def __init__(self, n: int, low_bits: int, low: bytes, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        counts = np.bitwise_count(high).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])  # ones before each word
        marks = np.arange(0, n, self.SAMPLE)
        self.hints = np.searchsorted(self.before, marks, side="right") - 1  # the word of each 256th one

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        v = np.asarray(values, np.uint64)
        n = len(v)
        bits = max(0, (int(v[-1]) // n).bit_length() - 1) if n else 0
        low = b""
        if bits and n:
            spread = (v[:, None] >> np.arange(bits, dtype=np.uint64)[None, :]) & np.uint64(1)
            low = np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = ((v >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        high = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        high[ones] = 1
        words = np.packbits(high, bitorder="little").tobytes()
        return struct.pack("<qBqq", n, bits, len(low), len(words)) + low + words

    @classmethod
    def decode(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, bits, n_low, n_high = struct.unpack_from("<qBqq", data, at)
        at += struct.calcsize("<qBqq")
        low, high = data[at : at + n_low], np.frombuffer(data, np.uint64, n_high // 8, at + n_low)
        return cls(n, bits, low, high), at + n_low + n_high

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        w = int(self.hints[i // self.SAMPLE])
        while self.before[w + 1] <= i:
            w += 1
        word = int(self.high[w])
        for _ in range(i - int(self.before[w])):
            word &= word - 1
        high = w * 64 + (word & -word).bit_length() - 1 - i
        b, at = self.low_bits, i * self.low_bits
        low = int.from_bytes(self.low[at >> 3 : (at + b + 7) >> 3], "little") >> (at & 7) & ((1 << b) - 1) if b else 0
        return high << b | low

    def all(self) -> np.ndarray:
        """All values, as int64."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)) << self.low_bits
        if self.low_bits and self.n:
            spread = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            out = out + (spread.astype(np.int64) << np.arange(self.low_bits)[None, :]).sum(1)
        return out.astype(np.int64)


def pack(doc_ids: list, parts: list[bytes], base: int, width: int) -> bytes:
    """A shard. ``doc_ids`` ascend, nulls first; ``base`` is the number of ids before it in its partition."""
    nulls = sum(x is None for x in doc_ids)
    real = np.array(doc_ids[nulls:], np.int64)
    first = int(real[0]) if len(real) else 0
    ends = np.cumsum([len(p) // width for p in parts]) if parts else np.zeros(0, np.int64)
    gaps = (real.astype(np.uint64) - np.uint64(first & (2**64 - 1))) if len(real) else np.zeros(0, np.uint64)
    head = HEAD.pack(MAGIC, width, len(doc_ids), nulls, first, base, int(ends[-1]) if parts else 0)
    return b"".join([head, EliasFano.encode(gaps), EliasFano.encode(ends), *parts])


class Shard:
    """Reads a shard: ``len``, ``doc_id(i)``, ``span(i)`` within it and ``ids(i)``."""

    def __init__(self, data: bytes):
        magic, self.width, self.n, self.nulls, self.first, self.base, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC or self.width not in (2, 4):
            raise ValueError("not a token-id shard")
        self.names, at = EliasFano.decode(data, HEAD.size)
        self.ends, at = EliasFano.decode(data, at)
        self.data = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def __len__(self) -> int:
        return self.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.names.select(i - self.nulls)

    def span(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.data[a:b]


class Encoder:
    """A ``tokenizers`` file's ids of texts, by pieces where its pre-tokenizer lets texts be cut."""

    def __init__(self, path: str, width: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kind = f"<u{width}"
        self.known: dict[str, bytes] = {}
        self.known[""] = b""
        #: the model alone does for a pre-token, unless an added token may stand in what _PARTS takes apart
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.model = self.tok.model.tokenize if cuttable(path) and not any(map(_WITHIN, added)) else None
        self.table = PieceTable(self._work, limit=800_000) if cuttable(path) else None

    def _whole(self, texts: list[str]) -> list[bytes]:
        # 16 or 32 bits a number on every platform that Spark runs on
        code = "H" if self.kind == "<u2" else "I"
        return [array(code, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of pre-tokens, those of letters by the model alone, which saves the search for pre-tokens."""
        model, code = self.model, "H" if self.kind == "<u2" else "I"
        one = [_LETTERS(w) is not None for w in words]
        rest = iter(self._whole([w for w, x in zip(words, one, strict=True) if not x]))
        shown = [w.replace(" ", "\u0120") if w.isascii() else w.encode().decode("latin-1").translate(_SHOWN) for w in words]
        return [array(code, [t.id for t in model(s)]).tobytes() if x else next(rest) for s, x in zip(shown, one, strict=True)]

    def _work(self, chunks: list[str]) -> list[bytes]:
        # words share their ids whatever marks or lines come behind
        known = self.known
        cut = [m.groups("") if (m := _PARTS(c)) else (c,) for c in chunks] if self.model else [(c,) for c in chunks]
        missing = list({p for c in cut for p in c if p not in known})
        known.update(zip(missing, self._words(missing) if self.model else self._whole(missing), strict=True))
        get = known.__getitem__
        out = [b"".join(map(get, c)) for c in cut]
        if len(known) > 600_000:
            known.clear()
            known[""] = b""
        return out

    def encode(self, texts: list[str]):
        if self.table is None:
            for t in texts:
                yield self._whole([t])[0]
        else:
            for values in self.table.rows(texts):
                yield b"".join(values)


def cuttable(path: str) -> bool:
    """Whether a tokenizer file is byte-level BPE with the usual pattern, nothing before it, and no added token with a space."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = spec["model"]["type"] == "BPE" and not spec.get("normalizer") and not spec["model"].get("dropout")
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    added = spec.get("added_tokens") or []
    return bool(plain and byte_level and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or any(c.isspace() for c in a["content"]) for a in added))


@lru_cache(maxsize=4)
def encoder(path: str, width: int) -> Encoder:
    return Encoder(path, width)


def write_shards(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 1 << 21, width: int = 2) -> DataFrame:
    """Encode every text, append ``end_id``, and write the shards to the shared folder.

    Returns the table read back: (part int, seq int, n_ids long, shard binary), in doc order by (part, seq).
    ``width`` 2 takes vocabularies of up to 65,536 ids. The only shuffle deals the texts out by ranges of doc_id.
    """

    def run(batches):
        from pyspark import TaskContext

        part, enc, end = TaskContext.get().partitionId(), encoder(path, width), int(end_id).to_bytes(width, "little")
        names: list = []
        parts: list = []
        base = size = seq = 0

        def shard():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([pack(names, parts, base, width)], pa.binary())], ["part", "seq", "n_ids", "shard"])

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), enc.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                n = len(ids) // width + 1
                if parts and size + n > shard_tokens:
                    yield shard()
                    names, parts, base, size, seq = [], [], base + size, 0, seq + 1
                names.append(name)
                parts.append(ids + end)
                size += n
        if parts:
            yield shard()

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col).select(F.col("doc_id").try_cast("long").alias("doc_id"), "text")
    ordered = t.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return persisted(ordered.mapInArrow(run, "part int, seq int, n_ids long, shard binary"), "tokens")


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards alone."""

    def run(batches):
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = Shard(data)
                ends = [s.ends.select(i) for i in range(len(s))]
                starts = [0, *ends[:-1]]
                names = pa.array([s.doc_id(i) for i in range(len(s))], pa.int64())
                ids = s.data.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                first = s.base + base
                yield pa.RecordBatch.from_arrays([names, pa.array([a + first for a in starts], pa.int64()), pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # as many rows as the range partitions had, whatever the input
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    totals = {r["part"]: r["n"] for r in parts.collect()}
    bases, so_far = [], 0
    for p in sorted(totals):
        bases.append((p, so_far))
        so_far += totals[p]
    small = shards.sparkSession.createDataFrame(bases, "part int, before long")
    return shards.join(F.broadcast(small), "part").select("before", "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def export(shards: DataFrame, part: int, seq: int, path: str) -> None:
    """Put one shard in a plain local file, which ``Shard(open(path, 'rb').read())`` reads."""
    row = shards.where((F.col("part") == part) & (F.col("seq") == seq)).select("shard").first()
    if row is None:
        raise KeyError((part, seq))
    with open(path, "wb") as f:
        f.write(row["shard"])
