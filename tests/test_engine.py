"""Operators on small tables, in both semantics where they differ."""

import json
import re

import pytest
from pyspark.sql import functions as F

from siltcomb.functions import entries as E
from siltcomb.functions import matching
from siltcomb.functions.matching import has_match, inside_quote, span_text, spans, unquoted_spans
from siltcomb.functions.regex import checked
from siltcomb.operators import counts, dedup, predicates, sampling, sinks
from siltcomb.plans.extract import extract, plan, save
from siltcomb.plans.spec import ExtractSpec
from siltcomb.sources import dumps
from siltcomb.sources.store import put_text

TEXTS = ["Never gonna give you up", "😀gonna 😀 go", "", None, "they are they", "THEY'RE, they’re; them_x", "a\nb\nc g\n", "x̂ é é", "\x1c a b", "ÄÖ äö ß ſ K", "1²३ ٣", "{a} [b] a-b ^"]
PATTERNS = [r"g\w+", r"^a", r"x", r"$", r"(?:(?<=^)|(?<=\W))(they|them)(?=$|(?=\W))", r"(?P<q>[aeiou])(?P=q)?", r"\bth\w*\b", r"[\w']+", r"\s+", r"\S+", r"[^\s]+", r"\d+", r"[äö]+", r"a*", r"\b", r"\{a\}", r"{a}", r"[[b\]]", r"a{,2}b", r"\w(?!\w)", r"\Z", r".+", r"[a-c&&b]+"]


@pytest.mark.parametrize("case", [True, False])
def test_spans_are_those_of_finditer(spark, case):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    for p in PATTERNS:
        c = checked(p, case)
        rows = df.select("i", spans(F.col("t"), c).alias("s"), has_match(F.col("t"), c).alias("h")).collect()
        for r in rows:
            t = TEXTS[r["i"]] or ""
            want = [(m.start(), m.end(), m[0]) for m in re.finditer(p, t, 0 if case else re.I)]
            assert [(x["start"], x["end"], x["matched"]) for x in r["s"]] == want, (p, t)
            if TEXTS[r["i"]] is not None:
                assert r["h"] == bool(re.search(p, t, 0 if case else re.I)), (p, t)


def test_python_workers_hand_over_few_spans_at_once(spark, monkeypatch):
    import pyarrow as pa

    texts, p = ["ab 123456 😀789 é", "", "x" * 5000, "z"] * 500, checked("(?:[0-9]{3})*")
    made = [(len(x), len(x.flatten())) for x in matching.finder(p)(iter([pa.array(texts)]))]
    assert sum(n for n, _ in made) == len(texts) and sum(n for _, n in made) == 500 * sum(len(re.findall(p.source, t)) for t in texts[:4])
    assert max(n for _, n in made) < matching.AT_ONCE + 6000
    monkeypatch.setattr(matching, "AT_ONCE", 20)
    df = spark.createDataFrame(list(enumerate([*TEXTS, *texts[:9]])), "i int, t string").coalesce(1)
    for source in (p.source, "(?:(é)|[0-9])*", "(?i)É*|a??"):  # without groups, with one, with flags that can't be in one
        for r in df.select("t", spans(F.col("t"), checked(source)).alias("s")).collect():
            assert [tuple(x) for x in r["s"]] == [(m.start(), m.end(), m[0]) for m in re.finditer(source, r["t"] or "", re.I)], source


def test_no_python_where_the_jvm_can(spark):
    df = spark.createDataFrame([("a",)], "t string")
    text = lambda p: df.select(spans(F.col("t"), checked(p)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text(r"g\w+")
    assert "Python" in text("a*")


QUOTE = "One\n\n    &gt; It was me who ate the pop tart.\n\nThey did it themself"


@pytest.mark.parametrize(("text", "upto", "documented", "compat"), [
    (QUOTE, "pop tart", True, False), (QUOTE, "themself", False, False), ("&gt; a b", "a", True, True), ("> a b", "a", True, False),
    ("&gt; a\nb", "b", False, False), ("b\n&gt; a", "a", True, False), ("x > a", "a", False, False), ("&gt; 😀 a\n", "a", True, True),
])
def test_quotes(spark, text, upto, documented, compat):
    df = spark.createDataFrame([(text, text.index(upto) + len(upto))], "t string, e int")
    got = df.select(inside_quote(F.col("t"), F.col("e")).alias("a"), inside_quote(F.col("t"), F.col("e"), "compat").alias("b")).first()
    assert tuple(got) == (documented, compat)


def entry(i, **more):
    base = {"id": f"c{i}", "author": "Ann", "author_flair_text": None, "body": "they said so", "subreddit": "Sub", "score": 1, "created_utc": 1262304000 + i, "link_id": "t3_p", "parent_id": "t3_p"}
    return base | more


ENTRIES = [
    entry(1, body="they and They"), entry(2, body="&gt; they\n\nno"), entry(3, body="I'm a bot. they"), entry(4, author="AutoModerator", score=-9), entry(5, score=-1, created_utc="1264982400"),
    entry(6, parent_id="t1_x", permalink="/r/Sub/x/"), entry(7, permalink=None), entry(8, link_id=None, author_flair_text="she/her"), entry(9, body="nothing here"), entry(10, created_utc=1262304000.0),
]


def folder(tmp_path, month_files):
    for name, rows in month_files.items():
        (tmp_path / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return str(tmp_path)


@pytest.fixture
def dump(tmp_path):
    (tmp_path / "comments").mkdir()
    turned = dict(reversed(list(ENTRIES[0].items())))
    files = {"RC_2010-01": [*ENTRIES, "{bad", "", "[1]"], "RC_2010-02": [turned, entry(1, body="they and They", score=2), entry(11)], "RC_2010-03": [entry(12)], "notes.txt": ["x"]}
    return folder(tmp_path / "comments", files)


def test_scan(spark, dump):
    t = dumps.scan(spark, dump)
    assert t.count() == 14
    assert dumps.scan(spark, dump, first=(2010, 2), last=(2010, 2)).count() == 3
    assert {r["file_name"]: r["n"] for r in dumps.malformed(dumps.lines(spark, dump)).collect()} == {"RC_2010-01": 3}
    assert dumps.month_range(spark, dump) == ((2010, 1), (2010, 3))
    idx = dumps.line_index(t).where("file_name = 'RC_2010-01'").orderBy("line_idx").select("line_idx", "id").collect()
    assert [(r[0], r[1]) for r in idx] == [(i, f"c{i + 1}") for i in range(10)]
    with pytest.raises(Exception, match="alformed|MALFORMED"):
        dumps.scan(spark, dump, mode="FAILFAST").collect()


def test_months_prune_files(spark, dump):
    plan_ = dumps.scan(spark, dump, first=(2010, 3))._jdf.queryExecution().executedPlan().toString()
    assert "file_name" in plan_
    assert dumps.scan(spark, dump, first=(2010, 3)).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("suffix", [".zst", ".xz", ".bz2", ".gz", ""])
def test_codecs(spark, tmp_path, suffix):
    import bz2
    import gzip
    import lzma

    import zstandard

    data = "".join(json.dumps(entry(i, body="zoë  they")) + "\n" for i in range(3)).encode()[:-1]
    if suffix == ".zst":  # two frames, one with a window the JVM refuses
        long = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(3, window_log=31))
        half = data.index(b"\n") + 1
        data = long.compress(data[:half]) + zstandard.ZstdCompressor().compress(data[half:])
    else:
        data = {".xz": lzma.compress, ".bz2": bz2.compress, ".gz": gzip.compress, "": bytes}[suffix](data)
    (tmp_path / f"RC_2010-01{suffix}").write_bytes(data)
    t = dumps.scan(spark, str(tmp_path), "comments", first=(2010, 1), codec="python")
    assert [(r["id"], r["body"]) for r in t.orderBy("id").collect()] == [(f"c{i}", "zoë  they") for i in range(3)]
    assert dumps.scan(spark, str(tmp_path), "comments", first=(2010, 2), codec="python").count() == 0


def test_monthly_counts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("year\tmonth\tcount\n2010\t1\t5\n2010\t02\t6\n")
    assert [tuple(r) for r in dumps.monthly_counts(spark, str(tmp_path / "a.txt")).collect()] == [(2010, 1, 5), (2010, 2, 6)]


def run(spark, dump, **options):
    return extract(spark, ExtractSpec(**({"input": dump, "output": "out"} | options)))


def test_extraction(spark, dump):
    x = run(spark, dump, body_regex="they", popularity=0)
    rows = x.results.collect()
    assert x.results.columns == sinks.columns(True)
    got = sorted((r["id"], r["span"], r["matched"]) for r in rows)
    # c1 stands in two files, once with its keys turned round (a duplicate) and once with another score (none)
    assert got == sorted([("c1", "(0, 4)", "they"), ("c1", "(9, 13)", "They")] * 2 + [(f"c{i}", "(0, 4)", "they") for i in (6, 7, 8, 10, 11, 12)])
    assert sorted((r["id"], r["filter reason"]) for r in x.review.collect()) == [("c3", "non-human generated"), ("c4", "score below defined threshold"), ("c5", "score below defined threshold")]
    assert [tuple(r) for r in x.stats.collect()] == [("Sub", 11)]
    assert {(r["year"], r["month"]): r["n"] for r in x.counts.collect()} == {(2010, 1): 9, (2010, 2): 3, (2010, 3): 1, (None, None): 13}
    assert [tuple(r) for r in x.malformed.collect()] == [("RC_2010-01", 3)]
    links = {r["id"]: r["permalink"] for r in rows}
    assert links["c6"] == "https://www.reddit.com/r/Sub/x/"
    assert links["c7"] == "https://www.reddit.com/r/Sub/comments/p//c7"
    assert links["c8"] is None
    assert {r["id"]: (r["year"], r["month"], r["timestamp_utc"]) for r in rows}["c10"][:2] == (2010, 1)


def test_compat(spark, dump):
    x = run(spark, dump, body_regex="they", popularity=0, semantics="compat")
    assert x.review.count() == 0
    assert x.results.where("id = 'c7'").first()["permalink"] == "https://www.reddit.comNone"
    assert x.raw_results.count() == 13
    assert run(spark, dump, body_regex="they", return_all=True, soft_filter=False).raw_results.count() == 11


@pytest.mark.parametrize(("options", "ids"), [
    ({"source": "user", "names": ("automoderator",)}, ["c4"]),
    ({"source": "user", "names": ("automoderator",), "case_sensitive": True}, []),
    ({"body_regex": "they", "toplevel": True, "time_from": (2010, 2)}, ["c1", "c1", "c11", "c12"]),
    ({"body_regex": "THEY", "case_sensitive": True}, []),
    ({"body_regex": "they", "include_quoted": True, "time_to": (2010, 1), "toplevel": True, "user_regex": "auto"}, ["c4"]),
    ({"flair_regex": "^SHE"}, ["c8"]),
    ({"body_regex": "^no"}, ["c2", "c9"]),
])
def test_conditions(spark, dump, options, ids):
    x = run(spark, dump, soft_filter=False, first_match=True, **options)
    assert sorted(r["id"] for r in x.results.collect()) == ids


def test_empty_range(spark, dump):
    x = run(spark, dump, body_regex="they", time_from=(2015, 1))
    assert x.results.count() == 0 and x.results.columns == sinks.columns(True)


def test_samples(spark, dump):
    a = run(spark, dump, body_regex="they", include_quoted=True, reservoir=4, soft_filter=False)
    assert a.matches.count() == 4
    assert a.matches.select("id", "match_index").collect() == a.matches.select("id", "match_index").collect()
    b = run(spark, dump, body_regex="they", include_quoted=True, reservoir=4, semantics="compat")
    assert [r["slot"] for r in b.matches.collect()] == [0, 1, 2, 3]
    c = run(spark, dump, body_regex="they", sample=0.0)
    assert c.results.count() == 0
    assert run(spark, dump, body_regex="they", sample=1.0, soft_filter=False).results.count() == 13
    ids = spark.range(1000).withColumn("g", F.col("id") % 2)
    assert sampling.proportional(ids, 0.1, ["id"], ["g"]).groupBy("g").count().where("count = 50").count() == 2
    slots = sampling.reservoir_scan(ids, 7, ["id"]).select("slot", "id").collect()
    assert [r["id"] for r in slots] == sampling.reservoir_slots(7, 1000)
    many = spark.range(700_000).select((F.col("id") % 2).cast("string").alias("file_name"), F.floor(F.col("id") / 2).alias("line_idx"))
    per = [("0", 350_000), ("1", 350_000)]
    points = sampling.scan_points(0.001, per)
    assert sorted(map(tuple, sampling.at_points(many, 0.001, per).collect())) == sorted((m, i) for m, at in points.items() for i in at)


def test_compat_sample_of_lines(spark, dump, tmp_path):
    x = run(spark, dump, body_regex="t", include_quoted=True, sample=0.5, semantics="compat", time_to=(2010, 2))
    points = sampling.scan_points(0.5, [("RC_2010-01", 10), ("RC_2010-02", 3)])
    want = {("RC_2010-01", i) for i in points["RC_2010-01"]} | {("RC_2010-02", i) for i in points["RC_2010-02"]}
    if ("RC_2010-01", 0) in want:  # of which the first entry of the next month is a copy
        want.discard(("RC_2010-02", 0))
    assert {(r["file_name"], r["line_idx"]) for r in x.entries.collect()} == want
    (tmp_path / "counts.txt").write_text("year\tmonth\tcount\n2010\t1\t10\n2010\t02\t3\n")
    y = run(spark, dump, body_regex="t", include_quoted=True, sample=0.5, semantics="compat", time_to=(2010, 2), monthly_counts=str(tmp_path / "counts.txt"))
    assert {(r["file_name"], r["line_idx"]) for r in y.entries.collect()} == want


def test_counts_tell_the_total_from_a_missing_month(spark):
    df = spark.createDataFrame([(None, None, 7), (2010, 1, 5)], "year int, month int, weight long")
    assert sorted((r["year"] or 0, r["n"], r["total"]) for r in counts.by_month(df).collect()) == [(0, 7, False), (0, 12, True), (2010, 5, False)]
    assert [(r["n"], r["total"]) for r in counts.by_month(df.limit(0)).collect()] in ([], [(0, True)])


def test_top_n_shuffles_once(spark):
    p = sampling.fixed_size(spark.range(10), 3, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in p and "Exchange" not in p


def test_duplicates(spark):
    rows = [('{"a":1,"b":{"x":1,"y":2}}', 2), ('{"b":{"y":2,"x":1},"a":1}', 1), ('{"a":2}', 3), ("no json", 4), ("no json", 5)]
    df = spark.createDataFrame(rows, "raw string, n int")
    for exact in (False, True):
        assert sorted(r["n"] for r in dedup.drop_duplicates(df, exact=exact, order=["n"]).collect()) == [1, 3, 4]
        assert dedup.drop_duplicates(df, exact=exact).count() == 3


def test_bots(spark):
    said = {"Bleep bloop, I'm a bot!": True, "i am a bot": True, "iabot": True, "i’m a bot": False, "robot": False}
    df = spark.createDataFrame([(t, 5, "x") for t in said], "body string, score int, author string")
    got = {r["body"]: r["r"] == "non-human generated" for r in df.select("body", E.filter_reason(F.col("body"), 5).alias("r")).collect()}
    assert got == said


def test_tagged(spark):
    calls = lambda: lambda text: [(w, "NOUN" if w[0].isupper() else "VERB") for w in text.split()]
    df = spark.createDataFrame([("a Run",), ("to run",), ("walk",), (None,)], "body string")
    assert [r["body"] for r in predicates.tagged(df, "body", "run", "VERB", calls).collect()] == ["to run"]


def test_pos_search_is_its_sql(spark, tmp_path):
    import duckdb

    from siltcomb import queries

    texts = [f"{a}{w}{b} {more}" for a in ("", "x ", "x\t.", "..,", "x\u00a0", "x\v", "x\x1c", "x\u3000", "(", "x\f") for w in ("The", "THE", "ThE", "the", "The's", "Then", "Thé") for b in ("", ".,", "\u00a0", "\v", "\x85y", "\r\n", "!", "\x00") for more in ("", "Then")]
    spark.createDataFrame(list(enumerate([*texts, None, "", "The", "a\nThe"])), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["pos_search"]).fetchall())
    assert len(want) == 32 and sorted(map(tuple, queries.pos_search(spark, str(tmp_path)).collect())) == want


def test_running_counts(spark):
    df = spark.createDataFrame([(2010, 1, "a"), (2010, 1, "a"), (2010, 2, "a"), (2010, 2, "b")], "year int, month int, subreddit string")
    got = {(r["month"], r["subreddit"]): r["n"] for r in counts.by_month_and_community(df, "compat").collect()}
    assert got == {(1, "a"): 2, (2, "a"): 3, (2, "b"): 1}


def test_files(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    x = extract(spark, ExtractSpec(dump, out, body_regex="they|said", popularity=0))
    paths = save(x)
    assert len(paths) == 3 and not [f for f in (tmp_path.parent).rglob("siltcomb-entries-*")]
    again = dumps.results(spark, paths[0])
    assert again.columns == sinks.columns(True) and again.count() == x.results.count()
    assert json.loads(spark.read.text(paths[2]).first()[0]) == {"Sub": 11}
    y = extract(spark, ExtractSpec(dump, out + "2", body_regex="they", return_all=True, stats=False))
    lines = [json.loads(r[0])["id"] for r in spark.read.text(save(y)[0]).collect()]
    assert len(lines) == len(set(lines)) + 1  # c1 with either score
    nl = spark.createDataFrame([('a;"b"\nc', None), ("", "x")], "t string, u string")
    sinks.write_csv(nl, out + "3")
    assert sorted((r["t"] or "", r["u"]) for r in dumps.results(spark, out + "3").collect()) == [("", "x"), ('a;"b"\nc', None)]


def test_posts(spark):
    rows = [("p1", "u", None, "They ran", "Title they", "S", 3, "1262304000", "/r/S/p1/")]
    t = spark.createDataFrame(rows, "id string, author string, author_flair_text string, selftext string, title string, subreddit string, score long, created_utc string, permalink string")
    t = t.withColumn("raw", F.to_json(F.struct("*")))
    x = plan(t, ExtractSpec("submissions", "o", post_regex="they", title_regex="they"))
    r = x.results.first()
    assert (r["type"], r["span"], r["permalink"]) == ("post", "(0, 4)", "https://www.reddit.com/r/S/p1/")
    compat = plan(t, ExtractSpec("submissions", "o", post_regex="they", flair_regex=None, user_regex="u", semantics="compat"))
    assert "span" not in compat.results.columns


def test_stream(spark, dump, tmp_path):
    from siltcomb.streaming import live

    s = live.unique(live.entries(spark, dump, "comments"))
    t = live.drained(s.select("id", "raw"), str(tmp_path / "stream"))
    assert t.count() == 13
    assert span_text is not None


@pytest.mark.parametrize(("suffix", "how"), [("", "none"), (".gz", "gzip"), (".bz2", "bzip2")])
def test_a_month_is_written_and_read_by_many_tasks(spark, tmp_path, suffix, how):
    rows = [entry(i, body=f"they {i} " + "".join(chr(97 + (i * k) % 26) for k in range(300))) for i in range(4000)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, value string").repartitionByRange(5, "i").sortWithinPartitions("i")
    put_text(df.select("value"), f"file://{tmp_path}/comments/RC_2010-01{suffix}", how)
    path = str(tmp_path / "comments")
    for codec in ("jvm", "python"):
        t = dumps.scan(spark, path, codec=codec).select("id")
        assert [r[0] for r in t.collect()] == [r["id"] for r in rows]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")  # many splits of concatenated streams
        try:
            assert dumps.scan(spark, path, codec="jvm").select("id").distinct().count() == dumps.lines(spark, path, codec="jvm").count() == 4000
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert dumps.lines(spark, path, codec=codec, spread=True).rdd.getNumPartitions() >= (1 if codec == "jvm" and suffix != ".gz" else 8)
    x = run(spark, path, body_regex="they", soft_filter=False)
    assert x.results.count() == 4000 and x.counts.where("total").first()["n"] == 4000
    assert [r["line_idx"] for r in dumps.line_index(dumps.scan(spark, path)).orderBy("line_idx").collect()] == list(range(4000))


def test_counts_alone_store_nothing(spark, dump, monkeypatch):
    from siltcomb.plans import cli
    from siltcomb.plans import extract as module

    monkeypatch.setattr(module, "stored", lambda *_: pytest.fail("entries were stored for no file"))
    assert cli.run(spark, ["--input", dump, "--commentregex", "they", "--count"])[0] == "9 instances for January 2010"


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    out, tasks = str(tmp_path / "out"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    sinks.write_csv(spark.range(60).select("id", F.col("id").alias("dump_month")), out, ("dump_month",))
    before = spark.conf.get(tasks)
    spark.sparkContext.setJobGroup("listing", "")
    assert dumps.results(spark, out).count() == 60 and spark.conf.get(tasks) == before
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
