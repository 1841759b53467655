"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Both dictionaries end in the same ordinary content, which zstandard's own trainer picks from ordinary
windows. Ahead of it, the toxic one holds the stretches that toxic documents share and ordinary ones
lack; the ordinary one holds as many bytes that occur in no text. Each window of a text is compressed
with either; what the toxic dictionary saves is the window's distance. As all else is equal, ordinary
windows save nothing, whatever their language. A document's distances (their mean, largest, sum and share
over a threshold) go through a logistic curve, fitted and calibrated on labelled documents that the
dictionaries were not made from.

Fitting uses a bounded sample of labelled rows: at most ``max_docs`` of either class by least hash of
id, read whole, copies left out. The curve's bias makes up for the share of each class that was sampled, so a score
means the same whatever the size of the input. Scoring reads whole texts.

Dictionaries that zstandard's trainer picks from windows of toxic and of ordinary documents were tried first: toxic documents
are mostly ordinary prose, so both hold nearly the same, and their distances rank held-out documents far worse (README).

Null and empty texts have no windows and get the score of distance zero. Without labels of both
classes every score is the share of toxic ones (0 without labels). Other columns are never looked at.
"""

from __future__ import annotations

import heapq
from collections import Counter
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, ship

#: RATIO: how much more often toxic documents must hold a stretch; of 15, 30 and 60 the one of least loss on learning rows alone.
WINDOW, OVERLAP, RATIO = 64, 8, 30
#: Lengths in bytes of the stretches that are counted (the better choice is found in fitting), and the least match of the compressor.
GRAMS, MATCH = ((5,), (5, 8)), 5
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def windows(data: bytes) -> list[bytes]:
    """Consecutive windows that end behind a space where there is one, each with a little of the one before."""
    out, i, n = [], 0, len(data)
    while i < n:
        j = i + WINDOW
        if j < n:
            k = data.rfind(b" ", i + WINDOW // 2, j)
            if k > 0:
                j = k + 1
        out.append(data[max(0, i - OVERLAP) : j])
        i = j
    return out


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    bias: float

    def score(self, text: str | None) -> float:
        z = float(np.dot(features(text, self.toxic, self.ordinary), self.weights) + self.bias) if self.weights else self.bias
        return float(1 / (1 + np.exp(-min(40.0, max(-40.0, z)))))


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes):
    import zstandard

    p = zstandard.ZstdCompressionParameters.from_level(6, source_size=2 * WINDOW, dict_size=len(dictionary), min_match=MATCH, write_content_size=0)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=p).compress


def features(text: str | None, toxic: bytes, ordinary: bytes) -> list[float]:
    """Of the windows' distances: mean, largest, mean of the three largest, log of the sum beyond noise, share that is large."""
    parts = windows((text or "").encode().translate(_LOWER))
    if not parts or not toxic:
        return [0.0] * 5
    a, b = _compressor(toxic), _compressor(ordinary)
    # doubled, a window always compresses; alone, a short one may be stored as it is and show nothing
    g = np.array([len(b(w + w)) - len(a(w + w)) for w in parts], float)
    top = np.sort(g)[-3:]
    # a mean over few windows says little: drawn towards none
    return [float(np.clip(g, 0, 12).sum() / (len(g) + 2)), float(min(g.max(), 15)), float(np.clip(top, 0, 15).sum() / 3), float(np.log1p(np.clip(g - 3, 0, None).sum())), float((g >= 4).sum() / (len(g) + 2))]


def _distinct(rows: list[tuple[str, int]]) -> list[tuple[bytes, int]]:
    """Lower-case texts without those that mostly repeat earlier ones; copies would make chance stretches look shared."""
    seen: set[int] = set()
    out = []
    for text, label in rows:
        w = text.split()
        s = {hash(tuple(w[i : i + 5])) for i in range(max(1, len(w) - 4))}
        if len(s & seen) <= 0.3 * len(s):
            out.append((text.encode().translate(_LOWER), label))
        seen |= s
    return out


def dictionaries(rows: list[tuple[bytes, int]], lengths: tuple[int, ...], size: int = 6144) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary; empty where toxic documents share nothing of their own."""
    import zstandard

    grams = lambda b: {b[i : i + k] for k in lengths for i in range(len(b) - k + 1)}
    toxic, ordinary = [t for t, y in rows if y], [t for t, y in rows if not y]
    # what is the toxic documents' own must show in either half of them
    halves = [Counter(), Counter()]
    for i, t in enumerate(toxic):
        halves[i % 2].update(grams(t))
    least = max(2, round(0.003 * len(toxic)))
    seen = Counter({g: n + halves[1][g] for g, n in halves[0].items() if min(n, halves[1][g]) >= least})
    also: Counter = Counter()
    for t in ordinary:
        also.update(grams(t).intersection(seen))
    ratio = min(RATIO, len(ordinary) / 3)  # with few ordinary documents, what a third of the toxic ones hold will do
    own = {g for g, n in seen.items() if n * len(ordinary) > ratio * (also[g] + 1) * len(toxic)}
    stretches: Counter = Counter()
    for t in toxic:
        begin = end = -1
        for i in range(len(t) - lengths[0] + 1):
            for k in lengths:
                if t[i : i + k] in own:
                    if i >= end:
                        if begin >= 0:
                            stretches[t[begin:end]] += 1
                        begin = i
                    end = max(end, i + k)
        if begin >= 0:
            stretches[t[begin:end]] += 1
    # greedy cover: most documents for a byte, not counting what is covered already
    have: set[bytes] = set()
    worth = lambda x: sum(seen[g] for g in (grams(x) & own) - have) / (len(x) + 4)
    heap = [(-worth(x), x) for x in stretches]
    heapq.heapify(heap)
    chosen, total = [], 0
    while heap and total < size:
        old, x = heapq.heappop(heap)
        now = worth(x)
        if now <= 0:
            continue
        if heap and now < -heap[0][0]:
            heapq.heappush(heap, (-now, x))
            continue
        chosen.append(x)
        have |= grams(x)
        total += len(x) + 1
    head = b"\0".join(chosen[::-1]) + b"\0" if chosen else b""
    if not head:
        return b"", b""
    some = [w for t in ordinary for w in windows(t)]
    some = [some[i] for i in np.random.default_rng(0).permutation(len(some))[:20_000]]
    try:
        shared = zstandard.train_dictionary(size, some).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        shared = b"".join(some)[-size:]
    # control characters, which no match will reach
    junk = bytes(np.random.default_rng(1).integers(1, 9, len(head), dtype=np.uint8))
    return shared + head, shared + junk


def fit_rows(rows: list[tuple[str, int]], offset: float = 0.0) -> Model:
    """A model from (text, label) rows: dictionaries from one half, the curve from the other; ``offset`` is added to its bias."""
    model = _fitted(_distinct(rows))
    return replace(model, bias=model.bias + offset)


def _fitted(rows: list[tuple[bytes, int]]) -> Model:
    share = float(np.mean([y for _, y in rows])) if rows else 0.0
    flat = Model(b"", b"", (), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    if not 0 < share < 1:
        return flat
    half = [i % 5 < 3 for i in range(len(rows))]
    learn = [r for r, h in zip(rows, half, strict=True) if h]
    rest = [r for r, h in zip(rows, half, strict=True) if not h]
    y = np.array([label for _, label in rest], float)
    if not len(y) or not 0 < y.mean() < 1:
        return flat
    tried = [x for x in (_curve(*dictionaries(learn, lengths), rest, y) for lengths in GRAMS) if x]
    return min(tried, key=lambda x: x[0])[1] if tried else flat


def _curve(toxic: bytes, ordinary: bytes, rest: list[tuple[bytes, int]], y: np.ndarray) -> tuple[float, Model] | None:
    """The logistic curve over the distances of ``rest``, with its loss."""
    if not toxic:
        return None
    x = np.array([features(t.decode("utf-8", "replace"), toxic, ordinary) for t, _ in rest])
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.5] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(z @ w, -30, 30))), 1e-9, 1 - 1e-9)
    weights = w[:-1] / scale
    return -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))), Model(toxic, ordinary, tuple(weights.tolist()), float(w[-1] - (weights * mean).sum()))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_docs: int = 2500) -> Model:
    """Fit on ``df`` joined with ``labels`` by id (rows with null labels or ids take no part)."""
    t = narrowed(df, doc_id=id_col, text=text_col)
    known = narrowed(labels, doc_id=id_col, y=label_col).where("y is not null and doc_id is not null")
    texts = t.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    of_all = {r["y"]: r["n"] for r in known.where("y in (0, 1)").groupBy("y").agg(F.count_distinct("doc_id").alias("n")).collect()}  # two rows
    rows: list = []
    offset = 0.0
    for y in (1, 0):
        # the ids are picked before any text is read
        some = known.where(F.col("y") == y).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
        found = texts.join(F.broadcast(some), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * max_docs).collect()  # bounded by max_docs
        rows += [(i / max(1, max_docs), r["text"], y) for i, r in enumerate(found)]
        if found and y in of_all:
            taken = min(of_all[y], max_docs)
            if len(found) == 2 * max_docs:  # of repeated ids, some were not reached
                last = F.lit(found[-1]["doc_id"])
                h, end = F.xxhash64("doc_id"), F.xxhash64(last)
                taken = some.where((h < end) | ((h == end) & (F.col("doc_id") <= last))).count()
            # the sample's odds are to the input's as the shares of the classes that were sampled
            offset += (1 if y else -1) * float(np.log(of_all[y] / taken))
    rows.sort(key=lambda r: (r[0], r[2]))
    return fit_rows([(text, y) for _, text, y in rows], offset)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries and a few weights

    def run(batches):
        for batch in batches:
            s = [shared.value.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], ["doc_id", "score", "predicted"])

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def reject(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` without the rows that the model takes for toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index(text_col)
            yield batch.filter(pa.array([shared.value.score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)
