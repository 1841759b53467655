"""Reply trees as conversations: root-to-leaf paths by iterative self-joins, ranked by score, formatted.

Each round joins the nodes with themselves and doubles the stretch of ancestors that a node knows, so
a tree of depth d takes log2(d) rounds; they yield each node's root, depth and the score of its branch.
The best leaves of each root are chosen by that score, and going through the stretches from the longest
to the shortest yields the ancestors of chosen leaves only. Each path becomes one conversation.

A turn is ``### role:``, a line break, the text, a line break, ``</turn>``, a line break. In roles and texts,
backslash, ``#`` and ``<`` get a backslash in front (in roles ``:`` too), so no text can pass for a mark and
everything is read back as it was. The loss mask lists the spans of assistant texts, in code points.

Null texts and roles are empty. A node whose parent is null or absent is a root. Of nodes with
one id, all but the least (parent, score, role, text) are left out, since a reply names one node. Nodes without an id take no
part: nothing can tell them apart. Nodes on a cycle of replies or below one are in no conversation; :func:`cyclic` lists them,
and the other trees are unharmed. Equal scores go to the lesser leaf id. Empty tables give no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltcomb.llm._runtime import persisted, ship

_MARKS, _ROLE_MARKS, _BACK = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]"), re.compile(r"\\(.)", re.S)
END = "\n</turn>\n"


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation and its loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head = f"### {_ROLE_MARKS.sub(r'\\\g<0>', role or '')}:\n"
        body = _MARKS.sub(r"\\\g<0>", text or "")
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), mask


def unescape(s: str) -> str:
    return _BACK.sub(r"\1", s)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """What :func:`format_turns` was given (nulls as empty strings)."""
    turns = []
    for part in formatted.split(END)[:-1]:
        m = re.match(r"### ((?:[^\\:]|\\.)*):\n", part, re.S)
        turns.append((unescape(m[1]), unescape(part[m.end() :])))
    return turns


def _single(nodes: DataFrame) -> DataFrame:
    """(id, parent, score), one row an id."""
    named = nodes.where(F.col("id").isNotNull())
    return persisted(named.groupBy("id").agg(F.min(F.struct("parent", "score")).alias("x")).select("id", "x.parent", F.coalesce("x.score", F.lit(0.0)).cast("double").alias("score")), "nodes")


def _resolved(one: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(id, jump, root, score, depth) of every node, with jump null where the root is reached, and the jumps of 1, 2, 4 ... ancestors.

    Nodes that still jump when stretches are longer than the table hang on a cycle.
    """
    known = one.select(F.col("id").alias("p"))
    state = one.join(known, one["parent"] == known["p"], "left").select("id", F.col("p").alias("jump"), F.col("id").alias("root"), "score", F.lit(1).cast("long").alias("depth"))
    state = persisted(state, "state")
    jumps, n = [], one.count()
    names = ["id", "jump", "root", "score", "depth"]
    done = None  # nodes that have reached their root aren't written again
    while 1 << len(jumps) <= n:
        active = state.where("jump is not null")
        if not active.limit(1).count():
            break
        jumps.append(active.select("id", "jump"))
        over = state.where("jump is null")
        done = over if done is None else done.union(over)
        far = done.union(active).select(F.col("id").alias("jump"), F.col("jump").alias("jump2"), F.col("root").alias("root2"), F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        state = persisted(active.join(far, "jump").select("id", F.col("jump2").alias("jump"), F.col("root2").alias("root"), (F.col("score") + F.col("score2")).alias("score"), (F.col("depth") + F.col("depth2")).alias("depth")), "state")
    return (state if done is None else done.union(state)).select(names), jumps


def cyclic(nodes: DataFrame) -> DataFrame:
    """(id) of the nodes whose ancestors form a cycle; they have no root and stand in no conversation."""
    return _resolved(_single(nodes))[0].where("jump is not null").select("id")


def best_paths(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """(leaf, root, branch_score, dist, id) of nodes (id, parent, score): the paths of the best leaves of each root, dist 0 at the leaf."""
    one = _single(nodes)
    state, jumps = _resolved(one)
    state = state.where("jump is null")
    leaves = state.join(one.select(F.col("parent").alias("id")).where("id is not null").distinct(), "id", "left_anti")
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.desc("score"), "id"))
    chosen = leaves.withColumn("n", rank).where(F.col("n") <= per_root)
    paths = persisted(chosen.select(F.col("id").alias("leaf"), "root", F.col("score").alias("branch_score"), F.lit(0).cast("long").alias("dist"), "id"), "paths")
    for i, jump in reversed(list(enumerate(jumps))):
        up = paths.join(jump, "id").select("leaf", "root", "branch_score", (F.col("dist") + (1 << i)).alias("dist"), F.col("jump").alias("id"))
        paths = persisted(paths.union(up), "paths")
    return paths


def conversations(nodes: DataFrame, per_root: int = 1) -> DataFrame:
    """(leaf, root, branch_score, formatted, loss) of nodes (id, parent, score, role, text)."""
    ship(nodes.sparkSession)
    paths = best_paths(nodes, per_root)
    said = nodes.groupBy("id").agg(F.min(F.struct("parent", "score", "role", "text")).alias("x")).select("id", "x.role", "x.text")
    turn = F.struct((-F.col("dist")).alias("at"), "role", "text")
    # one row a conversation, as long as its path
    rows = paths.join(said, "id").groupBy("leaf", "root", "branch_score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def run(batches):
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column(3).to_pylist()]
            loss = pa.array([[{"start": a, "end": b} for a, b in m] for _, m in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([f for f, _ in made], pa.string()), loss], ["leaf", "root", "branch_score", "formatted", "loss"])

    kind = nodes.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"leaf {kind}, root {kind}, branch_score double, formatted string, loss array<struct<start:bigint,end:bigint>>")


def read_back(made: DataFrame) -> DataFrame:
    """``made`` with n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, all from the formatted text and its mask."""

    def run(batches):
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            rows = []
            for f, mask in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                turns = parse_turns(f)
                loss = "".join([unescape(f[m["start"] : m["end"]]) for m in mask])
                rows.append((len(turns), sha("".join([f"{r}\n{t}\n" for r, t in turns])), len(loss), sha(loss), len(f)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], ["leaf", "root", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = made.schema["leaf"].dataType.simpleString()
    return made.select("leaf", "root", "branch_score", "formatted", "loss").mapInArrow(run, f"leaf {kind}, root {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def threads(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes of a table of turns: each turn replies to the one before it (ties by role, then text)."""
    t = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    n = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text"))
    t = t.withColumn("n", n)
    name = lambda k: F.struct(F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("conv"), k.alias("n"))
    parent = F.when(F.col("n") > 1, name(F.col("n") - 1))
    return t.select(name(F.col("n")).alias("id"), parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")
