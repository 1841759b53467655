"""Nearest neighbours by collision-counting hashing, for the largest inner product.

Vectors are scaled by the largest norm and given one more component that fills them up to the unit
sphere, so the largest inner product is the least distance. Each of ``PROJECTIONS`` directions has one sorted
array of the projections of a block. A query places a window around its own projection in each array; a vector
inside collides there. Windows widen from round to round (virtual rehashing: the arrays stay, only the ends of the
windows move). Vectors whose collisions reach the threshold, which those within the round's radius do
with high probability, are verified by their exact inner product; a query is done once its k-th best
lies within the radius. About a tenth of a full block is verified.

The sorted arrays are kept as bitmaps of their beginnings in ``GRID`` steps, so a window is the difference of two
bitmaps, rounded outwards to a step, and collisions are counted for 64 vectors at a time by adding bitmaps up. The directions are orthogonal.

All vectors are indexed and all queries meet all blocks: vectors are dealt into blocks of about
``BLOCK`` and stay put, queries stream past each block's index. A task holds one block and one batch.

Equal vectors form one class first and are searched for once. Of a class only its k + 1 least ids
can appear among k nearest with ties to the lesser id; a group limit keeps these before the shuffle.

Null and zero vectors, vectors with null or non-finite components, vectors of other than the
most frequent dimension (the greater, if two tie) and rows with null ids take no part. Repeated
ids with equal vectors count once. Fewer candidates than k give them all; a lone vector gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, persisted, ship

PROJECTIONS, GRID, BLOCK, SEED, BATCH = 64, 48, 16_384, 11, 16
#: Radii of the rounds; no two points of the sphere are farther apart than the last.
RADII = np.array([0.4, 0.7, 0.9, 1.0, 1.06, 1.12, 1.18, 1.24, 1.35, 2.01])
#: Of PROJECTIONS windows of half-width WIDTH x radius, a vector within the radius is in so many or more, in 19 cases of 20.
WIDTH, THRESHOLD = 1.5, 55


def at_least(rows: np.ndarray, least: int) -> np.ndarray:
    """For bitmaps stacked along the first axis, the bits that are set in ``least`` of them or more.

    The bitmaps are added up as whole words: three of one weight make one of that weight and one of the next.
    """
    planes, now = [], rows
    while len(now):
        carried = []
        while len(now) > 2:
            t = len(now) // 3
            x, y, z = now[:t], now[t : 2 * t], now[2 * t : 3 * t]
            xy = x ^ y
            carried.append((x & y) | (xy & z))
            now = np.concatenate([xy ^ z, now[3 * t :]])
        if len(now) == 2:
            carried.append(now[:1] & now[1:])
            now = now[:1] ^ now[1:]
        planes.append(now[0])
        now = np.concatenate(carried) if carried else now[:0]
    if least >> len(planes):
        return np.zeros_like(planes[0])
    more, same = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
    for i in range(len(planes) - 1, -1, -1):
        if least >> i & 1:
            same = same & planes[i]
        else:
            more, same = more | (same & planes[i]), same & ~planes[i]
    return more | same


def directions(d: int) -> np.ndarray:
    """``PROJECTIONS`` directions of ``d`` components, orthogonal within each stretch of d.

    Projections onto a whole orthogonal set add up to the distance, so their collisions tell near from far better than independent ones.
    """
    rng, sets = np.random.default_rng(SEED), []
    for _ in range(-(-PROJECTIONS // d)):
        q, r = np.linalg.qr(rng.standard_normal((d, d)))
        sets.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(sets)[:PROJECTIONS] * np.sqrt(d)


class Index:
    """A block of vectors (rows of unit length or less, filled up to the sphere)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        n = len(ids)
        scaled = vectors / largest
        fill = np.sqrt(np.clip(1 - (scaled * scaled).sum(1), 0, None))
        self.directions = directions(vectors.shape[1] + 1)
        projected = self.directions[:, :-1] @ scaled.T + self.directions[:, -1:] * fill
        # each array is sorted and kept as bitmaps of its beginnings, one for each of GRID steps: a window is the difference of two
        cuts = np.unique(np.linspace(0, n, min(GRID, n) + 1).astype(np.int64))
        self.edges = np.zeros((PROJECTIONS, len(cuts) - 2))
        words = -(-n // 64)
        self.heads = np.zeros((PROJECTIONS, len(cuts), words), np.uint64)
        for p in range(PROJECTIONS):
            order = np.argsort(projected[p], kind="stable")
            self.edges[p] = projected[p][order[cuts[1:-1]]]
            head = np.zeros(words * 64, np.uint8)
            for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                head[order[x:y]] = 1
                self.heads[p, i + 1] = np.packbits(head, bitorder="little").view(np.uint64)

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """For each query, the ids and scores of the k nearest found, best first, ties to the lesser id; and how many were verified."""
        return [x for i in range(0, len(queries), BATCH) for x in self._some(queries[i : i + BATCH], k)]

    def _some(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
        n, m = len(self.ids), len(queries)
        norm = np.sqrt((queries * queries).sum(1))
        centre = (queries / norm[:, None]) @ self.directions[:, :-1].T
        verified = [np.zeros(n, bool) for _ in range(m)]
        got, scores = [np.zeros(0, np.int64)] * m, [np.zeros(0)] * m
        active, each = np.arange(m), np.arange(PROJECTIONS)[:, None]
        for i, radius in enumerate(RADII.tolist()):
            c = centre[active].T[:, :, None]
            low = (self.edges[:, None, :] < c - WIDTH * radius).sum(2)
            high = (self.edges[:, None, :] <= c + WIDTH * radius).sum(2) + 1
            hit = at_least(self.heads[each, high] ^ self.heads[each, low], THRESHOLD)
            last, rest = i == len(RADII) - 1, []
            for q, bits in zip(active.tolist(), hit, strict=True):
                some = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), bitorder="little")[:n].astype(bool) & ~verified[q]
                if last and len(got[q]) < k:  # too few so far: the rest is looked at as well
                    some = ~verified[q]
                verified[q] |= some
                some = np.flatnonzero(some)
                if len(some):
                    got[q] = np.concatenate([got[q], some])
                    scores[q] = np.concatenate([scores[q], (self.vectors[some] * queries[q]).sum(1)])
                if len(got[q]) >= k:
                    kth = np.partition(scores[q], len(got[q]) - k)[len(got[q]) - k]
                    # squared distance on the sphere, where the query has length one
                    if 2 - 2 * kth / (norm[q] * self.largest) <= radius * radius:
                        continue
                if len(got[q]) < n:
                    rest.append(q)
            active = np.array(rest, np.int64)
            if not rest:
                break
        out = []
        for g, s in zip(got, scores, strict=True):
            best = np.lexsort((self.ids[g], -s))[:k]
            out.append((self.ids[g][best], s[best], len(g)))
        return out


def usable(v: Column) -> Column:
    """Whether a vector can take part."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", query_id_col: str | None = None, query_vector_col: str | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query; a row with the query's own id is no candidate."""
    spark = df.sparkSession
    ship(spark)
    clean = lambda t: t.where(F.col("id").isNotNull()).withColumn("v", F.col("v").cast("array<double>")).where(usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # noqa: E731  -0.0 is 0.0
    every = clean(narrowed(df, id=id_col, v=vector_col))
    asked = clean(narrowed(queries, id=query_id_col or id_col, v=query_vector_col or vector_col))
    dims = every.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = dims["d"] if dims else 0
    key = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(7), "v").alias("k2")]
    every, asked = (t.where(F.size("v") == d).select("id", "v", *key) for t in (every, asked))

    least = Window.partitionBy("k1", "k2").orderBy("id")
    firsts = every.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    # at most k + 1 ids a class are left to collect
    classes = persisted(firsts.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids"), F.first("v").alias("v")), "classes")
    members = persisted(asked.select("id", "k1", "k2").distinct(), "queries")
    wanted = asked.groupBy("k1", "k2").agg(F.first("v").alias("v"))
    n, largest = classes.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    blocks = max(1, -(-n // BLOCK))
    largest = float(largest or 1.0) * (1 + 1e-12)

    def run(batches):
        held, index, ids, rows = None, None, [], []
        for batch in batches:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            name, k2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            flat = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) if d else np.zeros((len(block), 0))
            at = 0
            while at < len(block):
                # a stretch of one block's vectors, or of the queries that meet it
                end = at + int(np.argmax(np.append((block[at:] != block[at]) | (kind[at:] != kind[at]), True)))
                if block[at] != held:
                    held, index, ids, rows = block[at], None, [], []
                if kind[at] == 0:
                    ids.append(name[at:end])
                    rows.append(flat[at:end])
                elif rows:
                    index = index or Index(np.concatenate(ids), np.concatenate(rows), largest)
                    found = index.search(flat[at:end], k + 1)
                    if not found:
                        at = end
                        continue
                    size = [len(f[0]) for f in found]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name[at:end], size)), pa.array(np.repeat(k2[at:end], size)), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], ["k1", "k2", "rep", "score"])
                at = end

    stay = classes.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), F.col("rep").alias("name"), F.lit(0).cast("long").alias("k2"), "v")
    go = wanted.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), F.col("k1").alias("name"), "k2", "v")
    # with more bounds than blocks, each block has a range of its own
    met = stay.union(go).repartitionByRange(3 * blocks, "block").sortWithinPartitions("block", "kind", "name")
    found = met.mapInArrow(run, "k1 long, k2 long, rep long, score double")
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "rep")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    lists = found.join(classes.select("rep", "ids"), "rep")
    # for each query class at most (k + 1)^2 ids
    lists = persisted(lists.groupBy("k1", "k2").agg(F.collect_list(F.struct("score", "ids")).alias("found")), "found")
    pairs = members.join(lists, ["k1", "k2"]).select(F.col("id").alias("query_id"), nearest_of(F.col("found"), F.col("id"), k).alias("near"))
    return pairs.select("query_id", F.posexplode("near").alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def nearest_of(found: Column, own: Column, k: int) -> Column:
    """The k best (vec_id, score) of (score, ids) lists without ``own``."""
    flat = F.flatten(F.transform(found, lambda c: F.transform(c["ids"], lambda i: F.struct((-c["score"]).alias("cost"), i.alias("vec_id")))))
    ranked = F.slice(F.array_sort(F.filter(flat, lambda x: x["vec_id"] != own)), 1, k)
    return F.transform(ranked, lambda x: F.struct(x["vec_id"].alias("vec_id"), (-x["cost"]).alias("score")))
