"""The ten operators and the pipeline against brute force, the libraries, round trips and held-out accuracy."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from siltcomb.llm import ann, byte_bpe, chat_trees, components, decontaminate, licenses, line_dedup, near_copies, simhash, token_counts, token_files, toxicity  # noqa: E402
from siltcomb.llm._words import words_of  # noqa: E402

TIK, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
random.seed(7)
_BITS = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "😀", "'s", "'", "re", "'ll", "1", "22", ".", "!?", "\xa0", " ", "\x1c", "\x85", "<|endoftext|>", "<|endof", "漢字", " erthe", "tion", "Thonndon", "aaaa", "b's"]
ODD = ["", " ", "  ", "\n", "'", "a ", " a", "a  b", "a \n b", "it's", "'sthe b's", "<|endoftext|>", "x <|endoftext|> y", "a<|endoftext|> "]
TEXTS = ODD + ["".join(random.choice(_BITS) for _ in range(random.randint(0, 30))) for _ in range(400)]

#: Columns whose names the operators might use themselves.
CLASH = {"h": 1, "k": 2, "k1": 3, "k2": 4, "d1": 5, "pos": 6, "line": 7, "th": 8, "fp": 9, "c": 10, "n": 11, "row": 12, "keep": 13, "gone": 14, "rep": 15, "score": 16, "n_tokens": 17, "n_words": 18, "v": 19, "id": 20}


def docs(spark, texts, ids=None, clash=True):
    df = spark.createDataFrame(list(zip(ids or range(len(texts)), texts, strict=True)), "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}) if clash else df


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# 8


def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.codec(TIK, P.PATTERN).bpe.ranks, special_tokens={})


def test_bpe_is_the_librarys():
    c, e = byte_bpe.codec(TIK, P.PATTERN), tiktoken_encoding()
    for t, ids in zip(TEXTS, c.encode(TEXTS), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.encode_ordinary(t)
        assert c.decode(ids) == t.encode()


def test_bpe_of_very_long_pre_tokens():
    c, e = byte_bpe.codec(TIK, P.PATTERN), tiktoken_encoding()
    for t in ("a" * 3000, "ab" * 1500, "é" * 1000, " " * 2000, "erthonndtion" * 300):
        assert np.frombuffer(next(c.encode([t])), "<u4").tolist() == e.encode_ordinary(t)
    big = "xyzzy" * 40_000
    assert c.decode(next(c.encode([big]))) == big.encode()


def test_bitmap():
    b, have = byte_bpe.RankBitmap(5000), set()
    for _ in range(3000):
        x = random.randrange(5000)
        (b.discard if x in have else b.add)(x)
        have ^= {x}
        assert b.first() == min(have, default=-1)


def test_bpe_tables(spark):
    df = docs(spark, [None, "", "the cat", "the cat"], [3, None, 1, 1])
    ids = byte_bpe.encode(df, TIK, P.PATTERN)
    assert sorted(r["text"] for r in byte_bpe.decode(ids, TIK, P.PATTERN).collect()) == ["", "", "the cat", "the cat"]
    d = byte_bpe.round_trip_digests(df, TIK, P.PATTERN)
    assert [r["n_tokens"] for r in d.orderBy("n_tokens").collect()] == [0, 0, 2, 2]
    assert d.where("n_tokens = 0").first()["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert byte_bpe.round_trip_digests(df.limit(0), TIK, P.PATTERN).count() == 0


def test_bpe_workers_forget_what_they_saw(spark):
    """Tasks are cut to bounded pieces and leave nothing in the workers that the next stage gets."""
    texts = [f"w{i} " * 3 for i in range(4000)]
    first = byte_bpe.round_trip_digests(docs(spark, texts).repartition(4), TIK, P.PATTERN)
    assert {r["doc_id"]: r["decoded_sha256"] for r in first.collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}
    path, pattern = TIK, P.PATTERN

    def run(batches):
        import pyarrow as pa

        list(batches)
        loaded = byte_bpe.codec.cache_info().currsize
        c = byte_bpe.codec(path, pattern)
        yield pa.RecordBatch.from_pydict({"loaded": [loaded], "held": [len(c.known) + len(c.table.tail) + len(c.table.odd) + len(c.table.head)]})

    after = spark.range(0, 4, 1, 4).mapInArrow(run, "loaded long, held long").collect()
    assert any(r["loaded"] for r in after) and not any(r["held"] for r in after)


def test_bpe_takes_batches_in_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(byte_bpe, "CHUNK", 10_000)
    texts = ["ab " * 1000] * 40 + [None, ""]
    parts = list(byte_bpe.slices([pa.RecordBatch.from_pydict({"id": list(range(42)), "text": texts}), pa.RecordBatch.from_pydict({"id": [], "text": []})]))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(42)) and max(p.num_rows for p in parts) <= 4
    c = byte_bpe.Codec(TIK, P.PATTERN)
    assert [c.decode(x).decode() for p in parts for x in c.encode([t or "" for t in p.column(1).to_pylist()])] == [t or "" for t in texts]


# 3


def test_token_files(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    some = [*TEXTS[:120], None]
    ids = [7 * i - 300 for i in range(len(some))]
    shards = token_files.write_shards(docs(spark, some, ids).repartition(5), JSON, end_id=2, shard_tokens=40)
    got = {r["doc_id"]: r for r in token_files.read_shards(shards).collect()}
    start = 0
    for i, t in zip(ids, some, strict=True):
        want = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(want), zlib.crc32(want))
        start += len(want)
    assert shards.count() > 10


def test_token_file_edges(spark, tmp_path):
    df = docs(spark, ["b", "a", "a", None], [5, None, 5, 5])
    got = rows(token_files.read_shards(token_files.write_shards(df, JSON, 2)).select("start", "n_tokens", F.coalesce("doc_id", F.lit(-1))))
    assert got == [(0, 2, -1), (2, 1, 5), (3, 2, 5), (5, 2, 5)]
    assert token_files.read_shards(token_files.write_shards(df.limit(0), JSON, 2)).count() == 0
    shards = token_files.write_shards(docs(spark, ["the cat", "sat"], [1, 2]).coalesce(1), JSON, 2)
    one = shards.first()
    token_files.export(shards, one["part"], one["seq"], str(tmp_path / "x.bin"))
    s = token_files.Shard((tmp_path / "x.bin").read_bytes())
    assert s.doc_id(0) == 1 and s.span(0)[0] == 0 and s.ids(0)[-1] == 2


def test_elias_fano():
    for n, top in ((0, 1), (1, 0), (1, 10**12), (700, 50), (700, 10**9)):
        v = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
        data = token_files.EliasFano.encode(v)
        e, end = token_files.EliasFano.decode(b"x" * 3 + data, 3)
        assert end == 3 + len(data) and e.all().tolist() == v.tolist() and [e.select(i) for i in range(n)] == v.tolist()
        with pytest.raises(IndexError):
            e.select(n)
    # far below eight bytes a value
    assert len(token_files.EliasFano.encode(np.cumsum(np.full(10_000, 300)))) < 1.5 * 10_000


# 4


def test_prefix_counts():
    c = token_counts.counter(JSON)
    assert c.in_order
    for t in TEXTS[:120]:
        got = np.cumsum(next(c.tables([t]))).tolist()
        assert got == [len(c.tok.encode(t[:k], add_special_tokens=False)) for k in range(1, len(t) + 1)], t


@pytest.mark.parametrize("added", [["Zqxv"], ["~^`"], ["@@", "<|endoftext|>"], ["ab", "abc", "<|x|>"], ["Zqxvb1", "\u00e9"]])
def test_counts_with_added_tokens_of_any_length(tmp_path, added):
    import json

    from tokenizers import Tokenizer

    spec = json.loads(open(JSON, encoding="utf-8").read())
    top = max(spec["model"]["vocab"].values()) + 1
    spec["added_tokens"] += [{"id": spec["model"]["vocab"].get(a, top + i), "content": a, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} for i, a in enumerate(added) if a != "<|endoftext|>"]
    path = str(tmp_path / "t.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    c, tok = token_counts.PrefixCounter(path), Tokenizer.from_file(path)
    texts = ["Zqxv", "a ~^` b", "aZqxvb cd", "aZqxvb1 Zqxvb2", "@@ a@@@b", "abcab abd xabc", "x<|x|>ab <|x|", "caf\u00e9 \u00e9", *TEXTS[:60], "".join(added) * 3, " ".join(added), "a".join(added)]
    e = token_files.Encoder(path, 4)
    for t, ids in zip(texts, e.encode(texts), strict=True):
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.cumsum(next(c.tables([t]))).tolist() == [len(tok.encode(t[:k], add_special_tokens=False)) for k in range(1, len(t) + 1)], t
        assert np.frombuffer(ids, "<u4").tolist() == want, t


def test_budgets(spark):
    df = docs(spark, [None, "", "the cat sat on the mat", "é" * 3], [1, 2, 3, None])
    got = {r["doc_id"]: r for r in token_counts.budgets(df, JSON, 3).collect()}
    assert (got[1]["n_tokens"], got[2]["n_bytes"], got[3]["n_tokens"], got[3]["over_limit"], got[3]["fit_chars"], got[None]["n_bytes"]) == (0, 0, 6, True, 11, 6)
    t = token_counts.PrefixTable(token_counts.prefix_tables(df.where("doc_id = 3"), JSON).first()["table"])
    assert (t.tokens(0), t.tokens(7), t.tokens(22), t.longest(2), t.longest(99)) == (0, 2, 6, 7, 22)
    assert rows(token_counts.library_counts(df.where("doc_id < 3"), P.path("piece_bpe_32k.model"))) == [(1, 0), (2, 0)]
    with pytest.raises(ValueError):
        token_counts.PrefixCounter(P.path("word_bpe_49k.json"))


# 6


def brute_lines(texts, min_docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    seen = {}
    for i, t in enumerate(texts):
        for x in (t or "").split("\n"):
            seen.setdefault(key(x), set()).add(i)
    gone = {k for k, d in seen.items() if k and len(d) >= min_docs}
    return [(len((t or "").split("\n")), sum(key(x) in gone for x in (t or "").split("\n")), "\n".join(x for x in (t or "").split("\n") if key(x) not in gone)) for t in texts]


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_line_dedup(spark, broadcast, monkeypatch):
    lines = ["Same line", " same LINE\t", "ÄÖ", "äö", "", "x", "y", "unique"]
    texts = [None, "", "Same line", *["\n".join(random.choices(lines, k=random.randint(1, 9)) + [f"l{i}"]) for i in range(40)]]
    df = docs(spark, texts)
    bitmaps = line_dedup.keep_bitmaps(df, 10, broadcast_rows=broadcast)
    got = line_dedup.apply_bitmaps(df, bitmaps).orderBy("doc_id").select("n_lines", "n_dropped", "text").collect()
    assert [tuple(r) for r in got] == brute_lines(texts, 10)
    assert "Python" not in bitmaps._jdf.queryExecution().executedPlan().toString()


def test_first_occurrences_stream_in_order(spark):
    rng = random.Random(12)
    made = [(rng.randrange(4), 0, rng.randrange(6), 0, rng.randrange(9)) for _ in range(300)]
    first = line_dedup.first_occurrences(spark.createDataFrame(made, "k1 long, k2 long, d1 long, d2 long, pos int"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == plan.count("Exchange") == plan.count("+- Sort [") == 1 and "Window [lag" in plan
    assert rows(first) == sorted((k, 0) for k, d in {(k, d) for k, _, d, _, _ in made})


def test_line_dedup_edges(spark):
    df = docs(spark, ["a\nb"] * 3, [1, 1, 1])  # rows that repeat each other are one document
    assert line_dedup.dedup_lines(df, 2).where("n_dropped > 0").count() == 0
    both = line_dedup.dedup_lines(docs(spark, ["a\nb", "a\nc"], [None, 1]), 2).orderBy("doc_id").collect()
    assert [r["text"] for r in both] == ["b", "c"] and set(CLASH) <= set(both[0].asDict())
    assert line_dedup.dedup_lines(df.limit(0), 2).count() == 0


# 10


def brute_simhash(texts):
    import xxhash

    fps = []
    for t in texts:
        w = (t or "").encode().translate(simhash.LOWER).split()
        g = [b" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))] if w else []
        ones = [sum(xxhash.xxh64_intdigest(x, seed=42) >> b & 1 for x in g) for b in range(64)]
        fps.append(sum(1 << b for b in range(64) if g and 2 * ones[b] > len(g)))
    root = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            root[i] = min(root[j] for j in range(len(texts)) if (fps[i] ^ fps[j]).bit_count() <= 2)
        root = [root[r] for r in root]
    return fps, root


def test_simhash(spark):
    words = [f"w{i}" for i in range(50)]
    base = [random.choices(words, k=n) for n in (0, 1, 2, 3, 60, 400, 800)]
    texts = [None]
    for b in base:
        texts += [" ".join(b), " ".join(b).upper()]
        for _ in range(4):
            c = list(b)
            if c:
                c[random.randrange(len(c))] = "new"
            texts.append("  ".join(c))
    fps, root = brute_simhash(texts)
    got = simhash.near_duplicates(docs(spark, texts)).orderBy("doc_id").collect()
    assert [(r["fingerprint"], r["component_id"]) for r in got] == [(f"{f:016x}", r) for f, r in zip(fps, root, strict=True)]
    assert simhash.near_duplicates(docs(spark, []).limit(0)).count() == 0
    odd = simhash.near_duplicates(docs(spark, ["a b c", "a b c", "z"], [None, 4, None])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in odd) == [(-1, -1), (-1, 4), (4, 4)]


@pytest.mark.parametrize("m", [5, 100, 300])
def test_links_of_a_posting(m):
    f = np.random.default_rng(m).integers(0, 1 << 9, m).astype(np.uint64)
    parent = {int(x): int(x) for x in f}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in simhash.linked(f).tolist():
        assert (a ^ b).bit_count() <= 2
        parent[find(a)] = find(b)
    for a in set(f.tolist()):
        for b in set(f.tolist()):
            assert (a ^ b).bit_count() > 2 or find(a) == find(b)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200), (5, 5), (None, 1)]
    got = dict(rows(components.connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies(spark):
    words = [f"w{i}" for i in range(900)]
    base = [random.choices(words, k=300) for _ in range(12)]
    texts = [" ".join(b) for b in base] + [None, "", " "]
    for b in base[:6]:
        for _ in range(3):
            c = list(b)
            for _ in range(2):
                c[random.randrange(300)] = "changed"
            texts.append(" ".join(c))
    texts += texts[:2]
    kept = near_copies.keep_one(docs(spark, texts, clash=False))
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == list(range(13))
    again = near_copies.keep_one(docs(spark, ["a b", "a b", "c"], [None, None, 2], clash=False))
    assert sorted((r["text"]) for r in again.collect()) == ["a b", "c"]


def brute_near(texts):
    """The rows that stay: the least of each component of similarity 0.8 and more."""
    sets = [set(near_copies._grams(t)) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = max(root[i], root[j]), min(root[i], root[j])
                root = [b if x == a else x for x in root]
    return sorted(set(root))


def test_near_copies_of_every_kind_are_found(spark):
    rng = random.Random(31)
    words, texts = [f"v{i}" for i in range(4000)], []
    for i in range(240):
        w = rng.choices(words, k=rng.randint(60, 300))
        m = round(len(w) * rng.uniform(0.12, 0.24))
        at = rng.randrange(len(w) - m)
        texts += [" ".join(w), " ".join((w + rng.choices(words, k=m), w[:-m], w[:at] + w[at + m :])[i % 3])]
    assert [r["doc_id"] for r in near_copies.keep_one(docs(spark, texts)).orderBy("doc_id").collect()] == brute_near(texts)


def test_texts_of_few_words_are_no_copies(spark):
    rng = random.Random(32)
    texts = [" ".join(rng.choices("0123456789", k=1500)) for _ in range(20)] + ["ha " * 3, "ha " * 50, "HA ha ha ha ha ha"]
    assert [r["doc_id"] for r in near_copies.keep_one(docs(spark, texts)).orderBy("doc_id").collect()] == list(range(22))


def test_large_groups_of_near_copies(spark):
    rng = random.Random(33)
    words = [f"v{i}" for i in range(4000)]
    base, texts = rng.choices(words, k=300), []
    for i in range(300):
        c = list(base)
        for j in rng.sample(range(len(c)), 6):
            c[j] = f"x{i}.{j}"
        texts.append(" ".join(c))
    assert [r["doc_id"] for r in near_copies.keep_one(docs(spark, texts)).orderBy("doc_id").collect()] == brute_near(texts)


# 2


def test_decontaminate(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    long = " ".join(random.choices(words, k=30))
    items = [(1, long), (2, "One, TWO three"), (3, None), (None, "w1 w2"), (10, "é ü"), (4, ""), (1, "w0 w0 w0"), (11, long)]
    texts = [None, "", "one two. Three one two three", long.upper() + " end", " ".join(long.split()[3:12]), " ".join(["x", *long.split()[3:14], "y"]), "é, ü", *[" ".join(random.choices(words, k=200)) for _ in range(20)]]

    def brute(text):
        w, hit, found = words_of(text), set(), set()
        for name, t in items:
            iw = words_of(t) if t is not None and name is not None else []
            n = min(10, len(iw))
            for s in {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else ():
                for a in range(len(w) - n + 1):
                    if tuple(w[a : a + n]) == s:
                        hit.update(range(a, a + n))
                        found.add(str(name))
        return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)

    table = spark.createDataFrame(items, "item_id long, text string")
    for part in (1 << 20, 100):  # in one part, and in several
        monkeypatch.setattr(decontaminate.hits, "__defaults__", (*decontaminate.hits.__defaults__[:-1], part))
        got = decontaminate.digests(docs(spark, texts), table).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == [brute(t) for t in texts]
        kept = decontaminate.without_hits(docs(spark, texts, clash=False), table, part_bytes=part)
        assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, t in enumerate(texts) if not brute(t)[4]]
    assert decontaminate.digests(docs(spark, texts), table.limit(0)).where("contaminated").count() == 0
    assert decontaminate.digests(docs(spark, texts).limit(0), table).count() == 0


# 9


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [None, "", "x Under the MIT license. under the mit License", "Apache License, Version 2.0", "CC BY-NC 4.0 and cc by nc", mit, "GNU General Public License v3", "permission is hereby granted free of charge", "mit mit cc by", "GNU Lesser General Public License"]
    got = licenses.scan(docs(spark, texts)).orderBy("doc_id").collect()
    assert [(r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in got] == [
        (0, None, None, "", ""), (0, None, None, "", ""), (2, 1, 5, "mit", "mit"), (1, 0, 0, "apache-2", "apache-2"), (2, 0, 6, "cc-by-nc", "cc-by-nc"), (0, None, None, "", "mit"),
        (0, None, None, "", "gpl"), (0, None, None, "", ""), (0, None, None, "", ""), (0, None, None, "", "lgpl"),
    ]
    assert all(0 <= r["score"] <= 1 for r in got) and got[5]["score"] == 1 and got[0]["score"] == 0
    assert licenses.scan(docs(spark, texts).limit(0)).count() == 0
    # overlapping and adjacent places, whatever words turn out rarest
    base = (("a b a", "x"), ("b a", "y"))
    r = licenses.scan(docs(spark, ["a b a b a", "b b a"]), base=base, templates=()).orderBy("doc_id").collect()
    assert [(x["n_base"], x["first_word"], x["last_word"]) for x in r] == [(4, 0, 3), (1, 1, 1)]


def test_licenses_by_their_surroundings(spark):
    from siltcomb.llm.licenses import _GPL, _MIT

    w = _MIT.split()
    changed = " ".join(w[:30] + ["kindly"] + w[30:60] + w[61:])  # a word put in, one left out
    texts = {"this text is not cc by sa": "", "this work is licensed under CC BY-SA 4.0": "cc-by-sa", "x " * 500 + changed.upper(): "mit", _GPL.format("affero general"): "agpl", " ".join(w[::-1]): "", "the gnu general and the public license": "", "gnu " * 3000: ""}
    got = licenses.scan(docs(spark, list(texts))).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == list(texts.values())
    assert all((r["score"] >= licenses.LEAST) == bool(r["labels"]) for r in got)


def test_license_query_against_brute_force(spark, tmp_path):
    import re

    rng = random.Random(11)
    bits = ["under", "the", "mit", "MIT", "license", "License.", "apache", "version", "2", "cc", "by", "nc", "nc-", "é", "\x00", "_"]
    texts = [None, "", "under the mit license " * 20_000, *[" ".join(rng.choices(bits, k=rng.randint(1, 400))) for _ in range(60)]] + ["under the mit license apache license version 2 cc-by-nc"] * 3
    got = sorted(query_on(spark, tmp_path, "op9_licenses", documents=docs(spark, texts)), key=lambda r: r["doc_id"])
    assert len(got) == len(texts)
    for t, r in zip(texts, got, strict=True):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(i, label) for phrase, label in licenses.BASE for p in [phrase.split()] for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        want = (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        assert {x for _, x in places} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


# 7


def test_chat_round_trip():
    turns = [("user", "### assistant:\n</turn>\n \\ <x> #"), ("assistant", "\\### Assistant: </turn> ok"), ("a:b\n#", ""), (None, None), ("assistant", "é\n")]
    f, mask = chat_trees.format_turns(turns)
    assert chat_trees.parse_turns(f) == [(r or "", t or "") for r, t in turns]
    assert [chat_trees.unescape(f[a:b]) for a, b in mask] == ["\\### Assistant: </turn> ok", "é\n"]


def test_reply_trees(spark):
    nodes = [(1, None, 1.0), (2, 1, 5.0), (3, 1, 1.0), (4, 3, 9.0), (5, 2, None), (6, 99, 2.0), (7, None, 0.0), (8, 7, 1.0), (9, 7, 1.0)]
    df = spark.createDataFrame([(i, p, s, "assistant" if i % 2 else "user", f"t{i}") for i, p, s in nodes], "id long, parent long, score double, role string, text string")
    made = {r["root"]: r for r in chat_trees.conversations(df).collect()}
    texts = lambda r: [t for _, t in chat_trees.parse_turns(r["formatted"])]
    assert {k: texts(r) for k, r in made.items()} == {1: ["t1", "t3", "t4"], 6: ["t6"], 7: ["t7", "t8"]}
    assert made[1]["branch_score"] == 11.0
    assert chat_trees.conversations(df, per_root=2).count() == 5
    chain = spark.range(70).select("id", (F.when(F.col("id") > 0, F.col("id") - 1)).alias("parent"), F.lit(1.0).alias("score"))
    assert chat_trees.best_paths(chain).count() == 70
    # cycles, what hangs on them, nodes without an id, and other trees
    odd = [(1, 2, 0.0), (2, 1, 0.0), (3, 2, 0.0), (4, 4, 0.0), (None, None, 1.0), (None, 5, 1.0), (5, None, 1.0), (6, 5, 1.0)]
    odd = spark.createDataFrame([(i, p, s, "user", f"t{i}") for i, p, s in odd], "id long, parent long, score double, role string, text string").withColumns({c: F.lit(1) for c in ("jump", "root", "depth", "leaf", "dist", "p")})
    assert rows(chat_trees.cyclic(odd)) == [(1,), (2,), (3,), (4,)]
    assert [texts(r) for r in chat_trees.conversations(odd).collect()] == [["t5", "t6"]]
    assert chat_trees.conversations(df.limit(0)).count() == 0


def test_threads(spark):
    t = spark.createDataFrame([(1, 0, "user", None), (1, 1, None, "b"), (1, 1, None, "b"), (None, 0, "assistant", "c")], "conv_id long, turn long, role string, text string").withColumn("score", F.lit("x"))
    back = chat_trees.read_back(chat_trees.conversations(chat_trees.threads(t)))
    assert sorted((r["n_turns"], r["loss_chars"]) for r in back.collect()) == [(1, 1), (3, 0)]
    assert chat_trees.read_back(chat_trees.conversations(chat_trees.threads(t.limit(0)))).count() == 0


def query_on(spark, tmp_path, name, **tables):
    """A registered query over small tables of its own."""
    from siltcomb.llm import queries

    for table, df in tables.items():
        df.write.parquet(f"{tmp_path}/{table}.parquet")
    return queries.QUERIES[name](spark, str(tmp_path)).collect()


def test_chat_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    said = ["", None, "a\nb", "### assistant:\n", "</turn>\n", "\\", "é😀 <", "x" * 100_000]
    table = [(i % 9 - 1 if i % 9 else None, rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", None, "a:b#"]), rng.choice(said)) for i in range(70)]
    got = {r["conv_id"]: r for r in query_on(spark, tmp_path, "op7_chat_trees", conversations=spark.createDataFrame(table, "conv_id long, turn long, role string, text string"))}
    table += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {c for c, *_ in table}
    for conv, r in got.items():
        turns = sorted([(-1 if t is None else t, role or "", (text or "").encode()) for c, t, role, text in table if c == conv])
        turns = [(role, text.decode()) for _, role, text in turns]
        loss = "".join(t for role, t in turns if role == "assistant")
        chars = sum(len(role) + sum(c in "\\#<:" for c in role) + len(t) + sum(c in "\\#<" for c in t) + len("### :\n\n</turn>\n") for role, t in turns)
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss), chars)


# 1


def test_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 16)) * rng.uniform(0.2, 3, 600)[:, None]
    x[100:160] = x[100]  # copies
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [None] + [1.0] * 15), (704, [1.0] * 3), (None, [1.0] * 16), (5, x[5].tolist())]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").withColumns({k: F.lit(v) for k, v in CLASH.items()})
    got = ann.nearest(df, df.where("vec_id % 20 = 0")).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    recall = []
    for q in range(0, 600, 20):
        s = x @ x[q]
        best = [i for i in np.lexsort((np.arange(600), -np.round(s, 9))) if i != q][:20]
        mine = sorted(found[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and len({v for _, v, _ in mine}) == 20
        assert all(abs(s[v] - y) < 1e-9 for _, v, y in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        recall.append(len({v for _, v, _ in mine} & set(best)) / 20)
    assert set(found) == set(range(0, 600, 20)) and np.mean(recall) >= 0.9
    few = ann.nearest(spark.createDataFrame(vectors[:3], "vec_id long, embedding array<double>"), spark.createDataFrame(vectors[:1], "vec_id long, embedding array<double>"))
    assert few.count() == 2
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_few_vectors_are_verified():
    """A full block of vectors with little contrast, as random ones in 64 dimensions have: recall of 0.95 and more for 15 % verified."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((10, 64)) * 0.35
    x = centres[rng.integers(0, 10, ann.BLOCK)] + rng.standard_normal((ann.BLOCK, 64))
    x /= np.sqrt((x * x).sum(1))[:, None]
    ids = np.arange(len(x))
    found = ann.Index(ids, x, 1 + 1e-12).search(x[::400], 21)
    best = [np.lexsort((ids, -(x @ q)))[:21] for q in x[::400]]
    recall = np.mean([len(set(f[0]) & set(b)) / 21 for f, b in zip(found, best, strict=True)])
    share = np.mean([f[2] for f in found]) / len(x)
    assert recall >= 0.95 and share <= 0.15, (recall, share)


def test_bitmaps_add_up():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64):
        rows_ = rng.integers(0, 2, (n, 128), dtype=np.uint8)
        words = np.packbits(rows_, axis=1, bitorder="little").view(np.uint64)
        for least in (1, 2, n // 2, n, n + 1, 200):
            if least:
                got = np.unpackbits(ann.at_least(words, least).view(np.uint8), bitorder="little")
                assert (got == (rows_.sum(0) >= least)).all(), (n, least)


# 5


def test_toxicity(spark):
    rng = random.Random(5)
    parts = ["an", "er", "the", "ing", "tion", "ou", "st", "re"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(500):
        w = [word() for _ in range(rng.randint(20, 200))]
        if i % 4 == 0:
            for _ in range(1 + len(w) // 40):
                w.insert(rng.randrange(len(w)), rng.choice(["gruffle", "Blatherskite", "zorkmid"]))
        texts.append(" ".join(w))
        labels.append((i, int(i % 4 == 0)))
    df = docs(spark, [*texts, None, ""])
    table = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, table.where("doc_id % 5 != 0"))
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    held = [(i, y) for i, y in labels if i % 5 == 0]
    assert np.mean([got[i]["predicted"] == y for i, y in held]) > 0.95
    assert got[500]["score"] == got[501]["score"] < 0.5
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    kept = toxicity.reject(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] == 0 for r in got.values())
    none = toxicity.fit(df, table.limit(0))
    assert toxicity.score(df.limit(3), none).where("score < 0.01").count() == 3
    assert toxicity.score(df.limit(0), model).count() == 0


def test_toxic_share_does_not_depend_on_the_cap(spark):
    rng = random.Random(6)
    vague = ["maybe", "perhaps", "gruffle"]  # the last is as good a sign as the share of toxic texts that hold it
    texts, labels = [], []
    for i in range(3000):
        toxic = i % 15 == 0
        w = ["".join(rng.choices(["an", "er", "the", "ing", "tion", "ou", "st", "re"], k=3)) for _ in range(40)]
        w.insert(rng.randrange(40), rng.choice(vague[2:] if rng.random() < (0.9 if toxic else 0.02) else vague[:2]))
        texts.append(" ".join(w))
        labels.append((i, int(toxic)))
    df, table = docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")
    share = {m: toxicity.score(df, toxicity.fit(df, table, max_docs=m)).agg(F.avg("score")).first()[0] for m in (3000, 150)}
    assert abs(share[3000] - 1 / 15) < 0.02
    assert abs(share[150] - 1 / 15) < 0.03
    # what shows only behind 12,000 characters is learned from
    late = docs(spark, [" ".join(["an er the ou st re"] * 720 + [t]) for t in texts[:300]])
    marks = spark.createDataFrame([(i, int("gruffle" in texts[i])) for i in range(300)], "doc_id long, toxic int")
    assert 0 < marks.where("toxic = 1").count() < 100 and toxicity.fit(late, marks).toxic
    # rows that repeat an id: some ids are not reached
    twice = toxicity.fit(df.union(df).union(df), table, max_docs=150)
    assert abs(toxicity.score(df, twice).agg(F.avg("score")).first()[0] - 1 / 15) < 0.04


# pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("an", "er", "the", "ing") for b in ("ou", "st", "re", "tion", "ab", "ly", "ne", "ko")]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    bench = prose(30)
    texts = [prose(120) + "\nshared line\n" + f"own {i}" for i in range(60)]
    texts[5] = " ".join(prose(60).split() + ["zorkmid", "gruffle"] * 4)
    texts[7] += " " + bench
    texts[9] = texts[8]
    texts[11] = texts[10].replace("\n", " x\n", 1)
    more = [prose(60) + " zorkmid " + prose(5) + " gruffle" for _ in range(40)]
    every = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts + more)]
    (tmp_path / "d").mkdir()
    d = str(tmp_path / "d")
    spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 60)) for i in range(100) if i not in (5,)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "line dedup", "SimHash near-dedup", "decontamination", "byte-level BPE"]
    docs_, seen = spark.read.parquet(f"{d}/documents.parquet"), []
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs_, d)
        if i < 4:
            assert out.columns == docs_.columns
            out.write.parquet(f"{d}/{i}")
            docs_ = spark.read.parquet(f"{d}/{i}")
            seen.append({r["doc_id"]: r["text"] for r in docs_.collect()})
    clean = set(range(60)) - {5}
    assert set(seen[0]) == clean
    assert set(seen[1]) == clean and not any("shared line" in t for t in seen[1].values())
    assert set(seen[2]) == clean - {9, 11}
    assert set(seen[3]) == clean - {7, 9, 11}
    final = {r["doc_id"]: r for r in cp.run(spark, d).collect()}
    assert {i: r["decoded_sha256"] for i, r in final.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in seen[3].items()}


def test_empty_texts_pass_the_near_copy_stage(spark):
    import corpus_pipeline as cp

    kept = cp.drop_near_copies(spark, docs(spark, [None, "", " \n", "a b", "a b", ""]), "")
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [0, 1, 2, 3, 5]


def test_near_copies_among_odd_columns(spark):
    """Null ids, rows that repeat ids and texts, columns named like the operator's own, maps, very long texts, empty tables."""
    long = " ".join(f"v{i}" for i in range(60_000))
    texts = ["a b c d e f", "a b c d e f", "x y", "x y", long, long + " end", None, ""]
    df = docs(spark, texts, [1, 1, None, 3, 5, 4, 6, 7]).withColumn("m", F.create_map(F.lit("k"), F.lit(1))).withColumns({c: F.lit(0) for c in ("th", "keeper", "gone_id", "__gone_id", "__gone_th", "bits", "first", "root")})
    kept = near_copies.keep_one(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in kept.collect()) == [(1, 11), (3, 3), (4, len(long) + 4), (6, 0)]
    assert near_copies.keep_one(df.limit(0)).count() == 0


def test_parity_never_claims_too_much():
    rng = np.random.default_rng(4)
    for n in (0, 1, 3, 300, 5000, 90_000):
        s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for change in (0, 1, n // 10, n // 2):
            t = np.unique(np.concatenate([s[change:], rng.integers(0, 1 << 63, change // 2).astype(np.uint64)]))
            assert near_copies.apart(near_copies.parity(s), near_copies.parity(t)) <= len(np.setxor1d(s, t))


# every query over a table with all that may go wrong, and over an empty one

NASTY = [None, "", " \n\t\n", "a", "a", "same line\nother", "é" * 50_000, "word " * 60_000, "x" * 30_000 + "\n" * 5_000, "<|endoftext|> 'll \x00  ", "idiot trash clown " * 40]
NASTY_IDS = [7, None, 5, 5, 5, 1, 2, 3, 4, -9, None]


def nasty(spark):
    return docs(spark, NASTY, NASTY_IDS).withColumns({c: F.lit("x") for c in ("lang", "source", "fingerprint", "component_id", "start", "n_hit", "items", "mask", "keep", "labels", "predicted", "th", "pos1", "root")})


def side_tables(spark):
    return {"benchmark": spark.createDataFrame([(1, "word word word"), (2, None), (None, "a"), (3, "")], "item_id long, text string"), "labels": spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None), (3, 0)], "doc_id long, toxic int")}


@pytest.mark.parametrize("name", ["op2_decontaminate", "op3_token_files", "op4_token_counts", "op5_toxicity", "op6_line_dedup", "op8_byte_bpe", "op9_licenses", "op10_simhash"])
def test_queries_over_odd_and_empty_tables(spark, tmp_path, name):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    got = query_on(spark, tmp_path / "a", name, documents=nasty(spark), **side_tables(spark))
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(i or 0 for i in NASTY_IDS)
    texts = [t or "" for t in NASTY]
    if name == "op4_token_counts":
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(JSON)
        want = [(i or 0, len(t.encode()), len(tok.encode(t, add_special_tokens=False))) for i, t in zip(NASTY_IDS, texts, strict=True)]
        assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == sorted(want) and all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    if name == "op3_token_files":
        from tokenizers import Tokenizer

        tok, start, want = Tokenizer.from_file(JSON), 0, []
        for i, t in sorted(zip(NASTY_IDS, NASTY, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
            ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
            want.append((start, i or 0, len(ids), zlib.crc32(ids)))
            start += len(ids)
        assert sorted((r["start"], r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == want
    if name == "op8_byte_bpe":
        e = tiktoken_encoding()
        ids = [np.array(e.encode_ordinary(t), "<u4") for t in texts]
        want = [(i or 0, len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, x, t in zip(NASTY_IDS, ids, texts, strict=True)]
        assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(want)
    if name == "op10_simhash":
        fps, _ = brute_simhash(texts)
        assert sorted((r["doc_id"] or 0, r["fingerprint"]) for r in got) == sorted((i or 0, f"{f:016x}") for i, f in zip(NASTY_IDS, fps, strict=True))
    if name == "op5_toxicity":
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
        assert {r["doc_id"]: r["held_out"] for r in got if r["doc_id"] is not None} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in NASTY_IDS if i is not None}
    empty = {k: t.limit(0) for k, t in (("documents", nasty(spark)), *side_tables(spark).items())}
    assert query_on(spark, tmp_path / "b", name, **empty) == []


def test_pipeline_stages_over_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as cp

    for k, t in side_tables(spark).items():
        t.write.parquet(f"{tmp_path}/{k}.parquet")
    for df in (nasty(spark), nasty(spark).limit(0)):
        for i, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, df, str(tmp_path))
            if i < len(cp.STAGES) - 1:
                assert out.columns == df.columns
            some = df.count()
            assert out.count() <= some and (out.count() > 0) == (some > 0)


def test_near_copies_are_linked_by_simhash(spark, monkeypatch):
    """Without the exact join, what the fingerprints link goes, unless the texts differ; with it, what they have joined isn't compared again."""
    import corpus_pipeline as cp

    rng = random.Random(37)
    words, texts = [f"v{i}" for i in range(9000)], []
    for _ in range(12):
        w = rng.choices(words, k=900)
        texts += [" ".join(w), " ".join(w + ["end"]), " ".join([*w[:5], "new", *w[6:]]), " ".join(w[120:])]
    texts += ["ha " * 3, "ha " * 50]  # one fingerprint, no five words in common
    fps, root = brute_simhash(texts)
    sets = [set(near_copies._grams(t)) for t in texts]
    alike = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    assert fps[-1] == fps[-2] and not alike(-1, -2) and all(alike(i, r) for i, r in enumerate(root[:-2]))
    want = sorted(set(root[:-2])) + [len(texts) - 2, len(texts) - 1]
    assert len(brute_near(texts)) < len(want) < len(texts) - 12

    across, compared = near_copies._across, []
    monkeypatch.setattr(near_copies, "_across", lambda pairs, roots: (compared.append((pairs.count(), (x := across(pairs, roots)).count())), x)[1])
    assert [r["doc_id"] for r in cp.drop_near_copies(spark, docs(spark, texts), "").orderBy("doc_id").collect()] == brute_near(texts)
    assert 0 < compared[0][1] < compared[0][0]
    monkeypatch.setattr(near_copies, "_candidates", lambda classes: spark.createDataFrame([], "a long, b long, n int, large boolean"))
    assert [r["doc_id"] for r in cp.drop_near_copies(spark, docs(spark, texts), "").orderBy("doc_id").collect()] == want


def test_near_duplicate_groups_do_not_depend_on_size_switches(spark):
    """A posting of three and the same with seventy strangers more: no link is lost."""
    rng = random.Random(35)
    words = [f"v{i}" for i in range(9000)]
    base = rng.choices(words, k=400)
    shared = rng.choices(words, k=30)
    texts = [" ".join(base), " ".join(base[:40] + ["new"] + base[41:]), " ".join(base[200:] + rng.choices(words, k=200))]
    texts += [" ".join(shared + rng.choices(words, k=rng.randint(20, 60))) for _ in range(90)]
    for some in (texts[:3], texts):
        assert [r["doc_id"] for r in near_copies.keep_one(docs(spark, some)).orderBy("doc_id").collect()] == brute_near(some)


def test_components_grow_by_links(spark):
    rng = random.Random(36)
    first, more = ([(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (25, 12))
    first, more = ([(max(x), min(x)) for x in some if x[0] != x[1]] for some in (first, more))
    table = lambda some: spark.createDataFrame(some, "a long, b long")
    roots = components.connected_components(table(first))
    got, want = dict(rows(near_copies._merged(roots, table(more)))), dict(rows(components.connected_components(table(first + more))))
    assert set(got) == set(want)
    assert all((got[x] == got[y]) == (want[x] == want[y]) for x in got for y in got)
