"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most two bits agree in at least six of their eight bytes,
each at its own position. That minimum is what the index asks for: the postings of a fingerprint are
its 28 choices of six positional bytes, so a posting holds only fingerprints whose tally of shared
positional bytes has reached the minimum, and those left are verified by their bits. Postings of
single bytes would hold 1/256 of all fingerprints each, and tallying them would pair nearly everything.

A posting can't exceed 65,536 different fingerprints, whatever the input, since only two bytes are
free. Small ones are verified pair by pair. In a large one, each member files itself under itself
and its 64 one-bit neighbours: members within two bits share such a key, and members that share
one are within two bits. So links are found in linear time and no partner is left out.

Copies share a fingerprint and become one class first, so no group of copies is paired up or
gathered. Texts without words have fingerprint zero. Null ids keep their rows but never name a component.
Repeated rows and other columns: each row gets its own result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, persisted, ship
from siltcomb.llm.components import connected_components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
RADIUS, SHARED = 2, 6
#: Up to so many members, a posting is verified pair by pair.
PAIRWISE = 128
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, repeats included, by XXH64."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    k = min(shingle, len(words))
    grams = [joined[a:b] for a, b in zip(starts, ends[k - 1 :], strict=False)]
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), ">u8", len(grams))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, fp long")


def _postings() -> list[int]:
    """The masks of six of eight bytes, as signed 64-bit integers."""
    out = []
    for gone in combinations(range(8), 8 - SHARED):
        mask = (1 << 64) - 1
        for b in gone:
            mask &= ~(255 << 8 * b)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def linked(members: np.ndarray) -> np.ndarray:
    """Pairs (larger, smaller) that join members of a posting within the radius; enough to connect all that are linked."""
    members = np.unique(members.view(np.uint64))
    m = len(members)
    if m < 2:
        return np.zeros((0, 2), np.uint64)
    if m <= PAIRWISE:
        i, j = np.nonzero(np.triu(np.bitwise_count(members[:, None] ^ members[None, :]) <= RADIUS, 1))
        return np.stack([members[j], members[i]], 1)
    keys = np.concatenate([members, (members[:, None] ^ _BITS[None, :]).ravel()])
    owner = np.concatenate([np.arange(m), np.repeat(np.arange(m), 64)])
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    same = keys[1:] == keys[:-1]
    a, b = owner[1:][same], owner[:-1][same]
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
    return members[pairs]


def link_classes(classes: DataFrame, fp_col: str = "fp") -> DataFrame:
    """(a, b): links between different fingerprints, enough to connect all within the radius."""

    def run(batches):
        rest_k = rest_f = None
        for batch in batches:
            k = np.asarray(batch.column(0), np.int64) if not batch.column(0).null_count else batch.column(0).to_numpy(zero_copy_only=False)
            f = np.asarray(batch.column(1), np.int64)
            if rest_k is not None:
                k, f = np.concatenate([rest_k, k]), np.concatenate([rest_f, f])
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1]))  # the last posting may go on
            rest_k, rest_f = k[last:], f[last:]
            yield from _links(k[:last], f[:last])
        if rest_k is not None:
            yield from _links(rest_k, rest_f)

    ship(classes.sparkSession)
    fp = F.col(fp_col)
    keys = F.array(*[F.xxhash64(fp.bitwiseAND(F.lit(m)), F.lit(i)) for i, m in enumerate(_postings())])
    posted = classes.select(F.explode(keys).alias("k"), fp.alias("fp"))
    dealt = posted.repartition("k").sortWithinPartitions("k")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _links(k: np.ndarray, f: np.ndarray):
    cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
    bounds = np.concatenate([[0], cuts, [len(k)]])
    size = np.diff(bounds)
    out = []
    # postings of two, by far the most, at once
    two = bounds[:-1][size == 2]
    if len(two):
        a, b = f[two].view(np.uint64), f[two + 1].view(np.uint64)
        near = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
        out.append(np.stack([np.maximum(a, b)[near], np.minimum(a, b)[near]], 1))
    for s in np.flatnonzero(size > 2):
        out.append(linked(f[bounds[s] : bounds[s + 1]]))
    pairs = np.concatenate(out) if out else np.zeros((0, 2), np.uint64)
    if len(pairs):
        pairs = np.unique(pairs, axis=0).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def near_duplicates(df: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the least id that links reach."""
    fps = persisted(fingerprints(df, shingle, seed, id_col, text_col), "fingerprints")
    classes = persisted(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = persisted(connected_components(link_classes(classes)).select(F.col("node").alias("fp"), "root"), "roots")
    rooted = persisted(classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "rep"), "rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = persisted(rooted.join(least, "root").select("fp", "component_id"), "named")
    out = fps.join(named, "fp")  # between written tables, so that a hot fingerprint can be split
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
