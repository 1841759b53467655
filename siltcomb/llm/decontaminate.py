"""Benchmark decontamination as a prefix-filtered set join with exact verification.

Every item is cut into windows of ``window`` words, and every window into shingles. A document holds
a window only if it holds each of the window's shingles, so one shingle, the rarest in the corpus, is
a sufficient prefix: only it is posted. The document's shingles meet the postings; a posting says how
far into its window the shingle stands, which bounds where the window must begin and end within the
document; what passes is compared word by word.

Rarity is counted over all documents first. The items are a side table with a proven bound: they
are taken in parts of at most ``part_bytes`` of text, and each part makes one pass over the
documents, so that no broadcast exceeds a part's size. A window is kept as the place where it begins among the numbers of
all items' words, so a part takes about 20 bytes a byte of text, its vocabulary included. Documents are never shuffled.

Words: A-Z in lower case; digits, letters and non-ASCII characters. An item of fewer words than a
window is one window; an item without words, or with null id or text, takes no part; rows that repeat
an item's id add their windows to it. Null and empty documents have no words and no hits. Each
document row gets its own result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, persisted, ship
from siltcomb.llm._words import words_of

SHINGLE = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_keys(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit key of every run of ``k`` word numbers; equal runs have equal keys (unequal ones are told apart later)."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    u = ids.astype(np.uint64)
    key = np.full(n, k, np.uint64)
    for j in range(k):
        key = (key ^ u[j : j + n]) * _MIX
        key ^= key >> np.uint64(29)
    return key


class Windows:
    """The windows of a part of the items: numbers of their words one after another, and where each window begins there."""

    def __init__(self, items: list[tuple], window: int):
        self.vocab: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        texts = [np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)], np.int32) for _, text in items]
        size = np.array([len(x) for x in texts], np.int64)
        self.ids = np.concatenate([*texts, np.zeros(0, np.int32)])
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        n = np.minimum(window, size)
        count = np.where(size > 0, size - n + 1, 0)
        #: item, first word and number of words of each window
        self.item = np.repeat(np.arange(len(items), dtype=np.int32), count)
        self.start = (np.repeat(begin - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())).astype(np.int32)
        self.length = np.repeat(n, count).astype(np.int32)
        self.lengths = sorted({min(SHINGLE, int(x)) for x in np.unique(self.length)})
        #: keys of the shingles of each length, at every word; and those that stand in a window, sorted
        self.keys = {k: shingle_keys(self.ids, k) for k in self.lengths}
        self.shingles = {k: self._sorted(k) for k in self.lengths}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "keys"}  # of use on the driver only

    def _of(self, k: int) -> np.ndarray:
        """The windows that are found by shingles of ``k`` words."""
        return np.flatnonzero(np.minimum(SHINGLE, self.length) == k)

    def _sorted(self, k: int) -> np.ndarray:
        some = self._of(k)
        begins = [self.start[some[self.length[some] >= k + j]] + j for j in range(int(self.length[some].max()) - k + 1)]
        return np.unique(self.keys[k][np.concatenate(begins)])

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(w, -1) for w in words_of(text)], np.int64)

    def present(self, ids: np.ndarray, k: int, among: np.ndarray) -> np.ndarray:
        """Positions whose shingle of ``k`` words is in ``among`` (sorted)."""
        if len(ids) < k or not len(among):
            return np.zeros(0, np.int64)
        known = np.concatenate([[0], np.cumsum(ids < 0)])
        whole = np.flatnonzero(known[k:] == known[:-k])  # runs without a word that no item has
        if not len(whole):
            return whole
        keys = shingle_keys(ids, k)[whole]
        at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
        return whole[among[at] == keys]

    def index(self, rarity: dict[int, np.ndarray]) -> dict[int, tuple]:
        """For each shingle length: (sorted keys, bounds, windows, offsets), with the rarest shingle of each window posted under its key.

        ``rarity`` has a count for each of ``shingles``.
        """
        out = {}
        for k in self.lengths:
            some, keys, sorted_ = self._of(k), self.keys[k], self.shingles[k]
            best, least, chosen = np.zeros(len(some), np.int32), np.full(len(some), np.iinfo(np.int64).max), np.zeros(len(some), np.uint64)
            for j in range(int(self.length[some].max()) - k + 1):
                inside = np.flatnonzero(self.length[some] >= k + j)
                key = keys[self.start[some[inside]] + j]
                n = rarity[k][np.searchsorted(sorted_, key)]
                better = (n < least[inside]) | ((n == least[inside]) & (key < chosen[inside]))
                at = inside[better]
                best[at], least[at], chosen[at] = j, n[better], key[better]
            order = np.argsort(chosen, kind="stable")
            posted, first = np.unique(chosen[order], return_index=True)
            out[k] = (posted, np.append(first, len(order)).astype(np.int32), some[order].astype(np.int32), best[order])
        return out

    def found(self, ids: np.ndarray, posted: dict[int, tuple]):
        """(a, b, item) of every window that the document's words ``ids`` hold from a to b."""
        for k, (keys, bounds, windows, offsets) in posted.items():
            at = self.present(ids, k, keys)
            if not len(at):
                continue
            where = np.searchsorted(keys, shingle_keys(ids, k)[at])
            for p, x in zip(at.tolist(), where.tolist(), strict=True):
                for i in range(int(bounds[x]), int(bounds[x + 1])):
                    w = int(windows[i])
                    a, n, s = p - int(offsets[i]), int(self.length[w]), int(self.start[w])
                    if a >= 0 and a + n <= len(ids) and np.array_equal(ids[a : a + n], self.ids[s : s + n]):
                        yield a, a + n, self.names[self.item[w]]


def _parts(items: DataFrame, part_bytes: int, item_id: str, item_text: str) -> list[list[tuple]]:
    t = narrowed(items, item_id=item_id, text=item_text).where("item_id is not null and text is not null")
    total, longest = t.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.max(F.octet_length("text"))).first()
    n = max(1, -(-2 * int(total) // part_bytes)) if total > part_bytes else 1
    for i in range(n):
        some = t.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) if n > 1 else t
        yield [(str(r["item_id"]), r["text"]) for r in some.collect()]  # bounded by part_bytes


def _rarity(t: DataFrame, shared) -> dict[int, np.ndarray]:
    """In how many documents each item shingle stands."""

    def run(batches):
        w = shared.value
        seen = {k: np.zeros(len(s), np.int64) for k, s in w.shingles.items()}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = w.numbers(text)
                for k, s in w.shingles.items():
                    at = w.present(ids, k, s)
                    if len(at):
                        seen[k][np.unique(np.searchsorted(s, shingle_keys(ids, k)[at]))] += 1
        for k, n in seen.items():
            i = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), k, np.int32)), pa.array(i), pa.array(n[i])], ["k", "i", "n"])

    counts = t.select("text").mapInArrow(run, "k int, i long, n long").groupBy("k", "i").agg(F.sum("n").alias("n"))
    out = {k: np.zeros(len(s), np.int64) for k, s in shared.value.shingles.items()}
    for r in counts.collect():  # bounded by the part's shingles
        out[r["k"]][r["i"]] = r["n"]
    return out


def hits(df: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", part_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, text, n_words, mask, items): mask has a byte for each word, 1 within any window; items the ids with windows found."""
    spark = df.sparkSession
    ship(spark)
    t = narrowed(df, doc_id=id_col, text=text_col)
    kind = t.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, n_words long, mask binary, items array<string>"
    out = None
    for part in _parts(items, part_bytes, item_id, item_text):
        made = Windows(part, window)
        shared = spark.sparkContext.broadcast(made)
        index = spark.sparkContext.broadcast(made.index(_rarity(t, shared)))

        def run(batches, shared=shared, index=index):
            w, posted = shared.value, index.value
            for batch in batches:
                more = batch.num_columns > 2
                n_words, masks, names = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    ids = w.numbers(text)
                    mask = np.frombuffer(batch.column(3)[i].as_py(), np.uint8).copy() if more else np.zeros(len(ids), np.uint8)
                    found = set(batch.column(4)[i].as_py()) if more else set()
                    for x, y, name in w.found(ids, posted):
                        mask[x:y] = 1
                        found.add(name)
                    n_words.append(len(ids))
                    masks.append(mask.tobytes())
                    names.append(sorted(found))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(masks, pa.binary()), pa.array(names, pa.list_(pa.string()))], ["doc_id", "text", "n_words", "mask", "items"])

        if out is not None:
            out = persisted(out, "hits")
        out = (t if out is None else out).mapInArrow(run, schema)
    return out


def digests(df: DataFrame, items: DataFrame, window: int = 10, **names: str) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = hits(df, items, window, **names)

    def run(batches):
        for batch in batches:
            n_hit = [sum(m.as_py()) for m in batch.column(2)]
            items = [x.as_py() for x in batch.column(3)]
            sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(sha, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "n_words", "mask", "items").mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def without_hits(df: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", **names: str) -> DataFrame:
    """``df`` without the rows whose text holds a window of an item."""
    spark = df.sparkSession
    ship(spark)
    out = df
    for part in _parts(items, names.get("part_bytes", 16 << 20), names.get("item_id", "item_id"), names.get("item_text", "text")):
        made = Windows(part, window)
        shared = spark.sparkContext.broadcast(made)
        index = spark.sparkContext.broadcast(made.index(_rarity(narrowed(df, text=text_col), shared)))

        def run(batches, shared=shared, index=index):
            for batch in batches:
                at = batch.schema.names.index(text_col)
                yield batch.filter(pa.array([not _any(shared.value, index.value, t) for t in batch.column(at).to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, df.schema)
    return out


def _any(w: Windows, posted: dict, text: str | None) -> bool:
    return next(w.found(w.numbers(text), posted), None) is not None
