"""Near-duplicate groups of texts at Jaccard similarity 0.8: SimHash, then an exact join of shingle sets for what it leaves.

A text is the set of its five-word shingles' 64-bit hashes. Rows of equal sets are one class. Classes whose SimHash fingerprints are
equal or, by the byte-position inverted index with count filtering, within two bits are linked first, each link only after
the two texts were compared. Most pairs of similarity 0.8 differ in more bits than any count of shared bytes could ask for, so all pairs that
these links don't put in one component are left to an exact join.

Texts of similarity 0.8 hold at least 0.8 of each other's shingles, so under any one order of all shingles the first fifth of either set (and one more) have a
shingle in common. Those prefixes are posted, and members of a posting whose sizes allow it are
compared, which finds every pair. The order is by hash, with shingles last that a sample shows to be frequent: a passage
that many texts share then links none of them. What the sample misses costs time, never a pair.

A posting of up to ``PAIRWISE`` members gives all its pairs. In a large one, members are linked with the first and with a few
neighbours, and links count only after the texts were compared. What then is not in one component is
linked anew in another order, and at last pair by pair wherever parity bitmaps don't rule the pair out (differing
bits are differing shingles, so the bound is exact). A group of near copies is joined by a few links for each member.

Null and empty texts are one class. Rows with null ids take part; the row that stays is that of the
least id (nulls last), then of the least text hash.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, persisted, ship
from siltcomb.llm.components import connected_components
from siltcomb.llm.simhash import LOWER, fingerprint, link_classes

SHINGLE, SIMILARITY, PAIRWISE = 5, 0.8, 64
#: Neighbours that a member of a large posting is linked with, and how often in another order before all pairs are tried.
NEIGHBOURS, ORDERS = 3, 3
#: One text of so many is counted for frequent shingles; they are those that so many of the sample hold, up to a number that can be broadcast.
SAMPLE, FREQUENT, MOST = 16, 6, 200_000
BITS, MOST_BITS = 512, 1 << 17


def _grams(text: str | None, n: int = SHINGLE) -> list[bytes]:
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    return [joined[a:b] for a, b in zip(starts, ends[min(n, len(words)) - 1 :], strict=False)]


def shingles(text: str | None) -> np.ndarray:
    """The set of a text's shingle hashes, ascending."""
    from xxhash import xxh64_intdigest

    grams = _grams(text)
    return np.unique(np.fromiter(map(xxh64_intdigest, grams, repeat(0)), np.uint64, len(grams)))


def jaccard(a: str | None, b: str | None) -> float:
    """Similarity of the sets of five-word shingles; texts without words are alike."""
    x, y = shingles(a), shingles(b)
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def prefix(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first of a set's shingles, frequent ones last: as many as any set of similarity 0.8 must share one of."""
    n = len(s) - (4 * len(s) + 4) // 5 + 1 if len(s) else 0
    if len(frequent) and n:
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        hot = frequent[at] == s
        s = np.concatenate([s[~hot], s[hot]])
    return s[:n]


def parity(s: np.ndarray) -> bytes:
    """For each of some parts of the hashes, whether an odd number of the set's fall there: ``BITS`` parts, or twice as many as the set has members.

    Sets differ in at least as many members as their bitmaps differ in bits. With fewer bits than members, all bitmaps of large sets look alike.
    """
    bits = min(MOST_BITS, max(BITS, 1 << int(2 * len(s) - 1).bit_length())) if len(s) else BITS
    return np.packbits(np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A parity bitmap of fewer parts (words of 64): those that fall together add up."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two parity bitmaps differ, in as many parts as the smaller has."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    n = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, n) ^ folded(b, n)).sum())


def _frequent(t: DataFrame) -> np.ndarray:
    """Hashes of shingles that many texts of a sample hold; ``MOST`` at most, the most frequent."""

    def run(batches):
        for batch in batches:
            sets = [shingles(x) for x in batch.column(0).to_pylist()]
            h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    # copies would make each of their shingles frequent, which does no harm
    some = t.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(SAMPLE)) == 0).select("text").distinct()
    counted = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    found = counted.orderBy(F.desc("n"), "h").limit(MOST).select("h").toArrow()  # bounded by MOST
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def _sets(df: DataFrame) -> DataFrame:
    """(doc_id, th, s1, s2, n, first, bits, fp): hash, size, posted prefix and parity bitmap of each row's set, SimHash of its text."""
    frequent = df.sparkSession.sparkContext.broadcast(_frequent(df))

    def run(batches):
        from xxhash import xxh3_128_digest

        for batch in batches:
            hashes, n, first, bits, fps = [], [], [], [], []
            for x in batch.column(2).to_pylist():
                s = shingles(x)
                hashes.append(xxh3_128_digest(s.tobytes()))
                n.append(len(s))
                first.append(prefix(s, frequent.value).tobytes())
                bits.append(parity(s))
                fps.append(fingerprint(x))
            f = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            columns = [batch.column(0), batch.column(1), pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy()), pa.array(n, pa.int32()), pa.array(first, pa.binary()), pa.array(bits, pa.binary()), pa.array(np.array(fps, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "s1", "s2", "n", "first", "bits", "fp"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, s1 long, s2 long, n int, first binary, bits binary, fp long")


def _fit(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be of similarity 0.8."""
    return 5 * np.minimum(n, m) >= 4 * np.maximum(n, m)


def _few(n: np.ndarray) -> np.ndarray:
    """Index pairs of a large posting's members: each with the first and with its neighbours."""
    m = len(n)
    p = [np.column_stack([np.zeros(m - 1, int), np.arange(1, m)])]
    p += [np.column_stack([np.arange(m - d), np.arange(d, m)]) for d in range(1, NEIGHBOURS + 1)]
    p = np.concatenate(p)
    return p[_fit(n[p[:, 0]], n[p[:, 1]])]


def _runs(batches, columns: int):
    """Arrays of whole runs of equal values of the first column, from batches sorted by it."""
    held = None
    for batch in batches:
        x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        if held is not None:
            x = [np.concatenate(y) for y in zip(held, x, strict=True)]
        last = int(np.searchsorted(x[0], x[0][-1])) if len(x[0]) else 0  # the last run may go on
        held = [y[last:] for y in x]
        if last:
            yield [y[:last] for y in x]
    if held is not None and len(held[0]):
        yield held


def _bounds(k: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])


def _candidates(classes: DataFrame) -> DataFrame:
    """(a, b, n, large): pairs a > b to be compared; where large is set, a is a member of posting b and n its size."""

    def post(batches):
        for batch in batches:
            first = batch.column(2).to_pylist()
            m = [len(x) // 8 for x in first]
            k = np.frombuffer(b"".join(first), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k), *[pa.array(np.repeat(batch.column(i).to_numpy(), m)) for i in (0, 1)]], ["k", "c", "n"])

    def run(batches):
        for k, c, n in _runs(batches, 3):
            bounds = _bounds(k)
            size = np.diff(bounds)
            pairs, members = [np.zeros((0, 2), int)], [np.zeros(0, int)]
            for m in np.unique(size[(size > 1) & (size <= PAIRWISE)]):  # postings of one size at once
                i, j = np.triu_indices(m, 1)
                at = bounds[:-1][size == m]
                pairs.append(np.column_stack([(at[:, None] + i).ravel(), (at[:, None] + j).ravel()]))
            for s in np.flatnonzero(size > PAIRWISE):
                pairs.append(_few(n[bounds[s] : bounds[s + 1]]) + bounds[s])
                members.append(np.arange(bounds[s], bounds[s + 1]))
            p, own = np.concatenate(pairs), np.concatenate(members)
            p = p[_fit(n[p[:, 0]], n[p[:, 1]])]
            ab = np.column_stack([np.maximum(c[p[:, 0]], c[p[:, 1]]), np.minimum(c[p[:, 0]], c[p[:, 1]])])
            ab = np.unique(ab, axis=0) if len(ab) else ab
            zeros = np.zeros(len(ab), np.int32)
            columns = (np.concatenate([ab[:, 0], c[own]]), np.concatenate([ab[:, 1], k[own]]), np.concatenate([zeros, n[own]]), np.concatenate([zeros, zeros[:0], np.ones(len(own), np.int32)]) > 0)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "n", "large"])

    posted = classes.select("c", "n", "first").mapInArrow(post, "k long, c long, n int")
    return posted.repartition("k").sortWithinPartitions("k", "c").mapInArrow(run, "a long, b long, n int, large boolean").distinct()


def _crossing(members: DataFrame, every: bool) -> DataFrame:
    """(a, b): pairs of the large postings' members (k, o, c, n, root, bits) that are not of one root: of neighbours in the order of o, or every one that bitmaps allow."""

    def run(batches):
        for k, _, c, n, root, bits in _runs(batches, 6):
            bounds = _bounds(k)
            for x, y in zip(bounds[:-1], bounds[1:], strict=True):
                r, d, e = root[x:y], n[x:y].astype(np.int64), c[x:y]
                if (r == r[0]).all():
                    continue
                b = np.stack([folded(np.frombuffer(v, np.uint64), BITS // 64) for v in bits[x:y]])
                p = [[i, i + 1 + np.arange(y - x - i - 1)] for i in range(y - x - 1)] if every else [_few(d).T]
                for i, j in p:
                    odd = np.bitwise_count(b[i] ^ b[j]).sum(-1).astype(np.int64)
                    ok = (r[i] != r[j]) & _fit(d[i], d[j]) & (9 * odd <= d[i] + d[j])
                    u, v = np.broadcast_to(e[i], ok.shape)[ok], e[j][ok]
                    if len(u):
                        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["a", "b"])

    return members.repartition("k").sortWithinPartitions("k", "o").mapInArrow(run, "a long, b long").distinct()


def _near(classes: DataFrame) -> DataFrame:
    """(a, b): pairs a > b of classes, enough to connect all whose SimHash fingerprints are equal or within two bits."""
    ends = persisted(classes.groupBy("fp").agg(F.min("c").alias("c")), "fingerprints")
    far = link_classes(ends)
    for x in "ab":
        far = far.join(ends.select(F.col("fp").alias(x), F.col("c").alias(f"c_{x}")), x)
    # in a chain, so that no class's text is needed once for each of its copies
    before = F.lag("c").over(Window.partitionBy("fp").orderBy("c"))
    same = classes.select(F.col("c").alias("a"), before.alias("b")).where(F.col("b").isNotNull())
    return same.union(far.select(F.greatest("c_a", "c_b"), F.least("c_a", "c_b")))


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that ``roots`` (node, root) doesn't hold in one component."""
    for x in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")), x, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that sizes and parity bitmaps don't rule out."""

    def run(batches):
        for batch in batches:
            ok = [9 * apart(x.as_py(), y.as_py()) <= n for n, x, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one, two = (classes.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", (F.col("na") + F.col("nb")).cast("long").alias("n"), "bits_a", "bits_b")
    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of classes whose representatives' texts are similar enough."""

    def run(batches):
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array([jaccard(p, q) >= SIMILARITY for p, q in zip(x, y, strict=True)], pa.bool_()))

    one = pairs.join(texts.select(F.col("c").alias("a"), F.col("text").alias("x")), "a")
    both = one.join(texts.select(F.col("c").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _linked(classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """(node, root) of the classes that have near copies: those linked by SimHash, then all others."""
    near = persisted(_possible(_near(classes), classes), "near")
    found = persisted(_candidates(classes), "pairs")
    pairs = persisted(_possible(found.where("not large").select("a", "b"), classes), "possible")
    large = found.where("large").select(F.col("b").alias("k"), F.col("a").alias("c"), "n")
    some = near.union(pairs).select(F.explode(F.array("a", "b")).alias("c")).union(large.select("c")).distinct()
    reps = classes.join(some, "c").select("c", F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th"))
    texts = persisted(keyed.join(reps, keyed["doc_id"].eqNullSafe(reps["doc_id"]) & (keyed["th"] == reps["th"])).select("c", "text").dropDuplicates(["c"]), "texts")
    roots = persisted(connected_components(_verified(near, texts)), "roots")
    more = persisted(_verified(_across(pairs, roots), texts), "links")
    roots = persisted(_merged(roots, more), "roots")
    if not large.limit(1).count():
        return roots
    members = persisted(large.join(classes.select("c", "bits"), "c"), "members")
    for turn in range(ORDERS + 1):
        named = members.join(roots.withColumnRenamed("node", "c"), "c", "left").select("k", F.xxhash64("c", F.lit(turn)).alias("o"), "c", "n", F.coalesce("root", "c").alias("root"), "bits")
        crossing = persisted(_possible(_crossing(named, turn == ORDERS), classes), "crossing")
        more = persisted(_verified(crossing, texts), "links")
        if more.limit(1).count():
            roots = persisted(_merged(roots, more), "roots")
    return roots


def _merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` (node, root) with the components joined that the links ``more`` connect; only their roots are gone through anew."""
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    ends = persisted(ends, "ends")
    one, two = (ends.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    between = more.join(one, "a").join(two, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    joined = connected_components(between).select(F.col("node").alias("root"), F.col("root").alias("new"))
    every = roots.union(ends.where("node = root").join(roots, "node", "left_anti").select("node", "root"))
    return every.join(joined, "root", "left").select("node", F.coalesce("new", "root").alias("root"))


def losers(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, keeper): the rows that a near-duplicate group can spare, and the id of the one that stays; th is xxhash64 of the text."""
    ship(df.sparkSession)
    t = narrowed(df, doc_id=id_col, text=text_col)
    fps = persisted(_sets(t), "sets")
    name = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("doc_id"), F.col("th").alias("th"))
    # a class is named by the first half of its set's 128-bit hash; should two share it, that of the lesser second half is
    # compared with others and the other one is let be
    code = F.col("s1").alias("c")
    found = fps.groupBy("s1").agg(F.min(F.struct("s2", name.alias("rep"), "fp")).alias("x"), F.min_by(F.struct("n", "first", "bits"), "s2").alias("y"))
    classes = persisted(found.select(code, "x.s2", "x.rep", "x.fp", "y.n", "y.first", "y.bits"), "classes")
    roots = _linked(classes, t.withColumn("th", F.xxhash64("text"))).select(F.col("node").alias("c"), "root")
    rooted = persisted(classes.join(roots, "c", "left").select("c", "s2", F.coalesce("root", "c").alias("root"), "rep"), "rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("keeper"))
    named = persisted(rooted.join(least, "root").select("c", "s2", "keeper"), "named")
    rows = fps.select("doc_id", "th", code, "s2").join(named, ["c", "s2"])
    return rows.where(~(F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("th") == F.col("keeper.th")))).select("doc_id", "th", F.col("keeper.doc_id").alias("keeper"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each near-duplicate group."""
    gone = persisted(losers(df, id_col, text_col).select("doc_id", "th").distinct(), "gone")
    own = df[f"`{id_col}`"]
    kept = df.join(gone, own.eqNullSafe(gone["doc_id"]) & (F.xxhash64(df[f"`{text_col}`"]) == gone["th"]), "left_anti")
    # rows that agree in id and text
    return kept.dropDuplicates([id_col, text_col]) if df.groupBy(own).count().where("count > 1").limit(1).count() else kept
