"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns; it is named by its smallest member and its
depth. Prefixes are told apart by two 64-bit hashes: the exclusive or of the hashes of
(place, role, text) of their turns, taken in pieces of ``PIECE`` turns, so that no
conversation has to pass one task turn by turn.

Totals: every round rakes all leaves (their totals go to their parents) and compresses
unary chains: a node with one child leaves its chain if its lot of the round beats its
parent's and its child's, and what it holds waits on the edge to its child. Chains shrink
by a third a round, all else by its leaves, so rounds grow with the logarithm of the
nodes. Rake and compress each join nodes with what their neighbours send them as one union
and one aggregate by node, which combines a hot parent's children before the shuffle;
the nodes left are written to the shared folder. Then the rounds are run backwards: a node that left a
chain gets its child's total and what lay between, by a join with those still there.

Nulls: rows without a conversation are left out; a null turn sorts first; a null role or
text is empty. Rows of one turn sort by role, then text; repeated rows are turns of their
own. An empty table gives no rows, not even a root. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..operators.sequence import rank_within
from .common import settle

PIECE = 1024
GROUP = 20       # conversations c - c % GROUP, ..., share the first turns of the first
MOST_SHARED = 4  # fewer than this many


def ordered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos from 1, h1, h2, words): places of the turns, hashes of role and text, words of the text.
    Places come from a range exchange, which splits a hot conversation."""
    none = F.lit("")
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), none).alias("role"), F.coalesce(F.col(text), none).alias("text"))
    placed = rank_within(rows, "conv_id", ["turn", "role", "text"], rank_name="pos")
    return settle(placed.select(
        "conv_id", F.col("pos").cast("long").alias("pos"), F.xxhash64(F.lit(1), "role", "text").alias("h1"),
        F.xxhash64(F.lit(2), "role", "text").alias("h2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, their turns) after the first h turns of each were replaced by those of the
    conversation c - c % 20, h = crc32(c) % 4. A conversation may be left without turns."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    convs = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head"), h.alias("h"))
    heads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < MOST_SHARED)).withColumnRenamed("conv_id", "head")
    lent = convs.join(heads, "head").where(F.col("pos") <= F.col("h")).select("conv_id", "pos", "h1", "h2", "words")
    got = lent.groupBy("conv_id").agg(F.count(F.lit(1)).alias("got"))
    convs = settle(convs.join(got, "conv_id", "left").select("conv_id", "h", F.coalesce("got", F.lit(0)).alias("got")))
    own = (turns.join(convs, "conv_id").where(F.col("pos") > F.col("h"))
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "h1", "h2", "words"))
    return convs.select("conv_id"), settle(lent.unionByName(own))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, words): each turn's prefix hashes with and without itself."""
    rows = turns.select("conv_id", F.col("pos").alias("depth"), F.floor((F.col("pos") - 1) / PIECE).alias("piece"),
                        F.xxhash64("h1", "pos").alias("z1"), F.xxhash64("h2", "pos").alias("z2"), "words")
    pieces = rows.groupBy("conv_id", "piece").agg(F.bit_xor("z1").alias("t1"), F.bit_xor("z2").alias("t2"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    pieces = pieces.select("conv_id", "piece", F.coalesce(F.bit_xor("t1").over(before), zero).alias("b1"),
                           F.coalesce(F.bit_xor("t2").over(before), zero).alias("b2"))
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", F.bit_xor("z1").over(inside).alias("r1"), F.bit_xor("z2").over(inside).alias("r2"))
    k = [F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return (rows.join(pieces, ["conv_id", "piece"])
            .select("conv_id", "depth", k[0].alias("k1"), k[1].alias("k2"), k[0].bitwiseXOR(F.col("z1")).alias("p1"),
                    k[1].bitwiseXOR(F.col("z2")).alias("p2"), "words"))


def _first(mine: tuple[str, str], other: tuple[str, str], turn: int) -> Column:
    """Whether a node's lot of this round beats another's; never both ways."""
    lot = lambda node: F.xxhash64(*map(F.col, node), F.lit(turn))
    return lot(mine) > lot(other)


def _round(live: DataFrame, sent: list[DataFrame], names: list[str]) -> DataFrame:
    """One superstep: the nodes of ``live`` with what was sent to them, by one aggregate over node names.
    Every column has one sender, or is a sum (``s_``) or a count of children (``n``)."""
    rows = live
    for messages in sent:
        rows = rows.unionByName(messages, allowMissingColumns=True)
    kept = [c for c in rows.columns if c not in ("c", "d")]
    total = lambda c: F.sum(c) if c.startswith("s_") or c == "n" else F.max(c)
    return rows.groupBy("c", "d").agg(*[total(c).alias(c) for c in kept]).select("c", "d", *names)


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(c, d, *values) summed over subtrees. ``nodes``: c, d (together a node's name; the root has d = 0),
    pc, pd (its parent's; null for the root) and the values of the node itself."""
    edge = [f"e_{v}" for v in values]
    zero = F.lit(0).cast("long")
    state = ["c", "d", "pc", "pd", *values, *edge]
    live = settle(nodes.select("c", "d", "pc", "pd", *values, *[zero.alias(e) for e in edge]))
    leaves = None  # the first round finds out who has children
    steps = []     # (leaves raked, nodes that left a chain) by round
    while True:
        # rake: a leaf's total goes to its parent; everyone else says that it is there
        up = [F.col("pc").alias("c"), F.col("pd").alias("d")]
        raked = live.where("n = 0") if leaves else live.where("false")
        rest = live.where("n > 0") if leaves else live
        full = rest.select(*state).withColumn("n", zero)
        gifts = raked.where("pd IS NOT NULL").select(*up, *[(F.col(v) + F.col(e)).alias("s_" + v) for v, e in zip(values, edge, strict=True)])
        alive = rest.where("pd IS NOT NULL").select(*up, F.lit(1).cast("long").alias("n"), F.col("c").alias("kc"), F.col("d").alias("kd"))
        live = _round(full.withColumns({"s_" + v: zero for v in values}), [gifts, alive], [
            "pc", "pd", *[(F.col(v) + F.col("s_" + v)).alias(v) for v in values], *edge, "n", "kc", "kd"])
        live = settle(live)
        # compress: a node with one child leaves its chain if its lot beats its parent's and its child's;
        # what it holds waits on the edge to the child
        one = (F.col("n") == 1) & F.col("pd").isNotNull()
        goes = one & _first(("c", "d"), ("pc", "pd"), len(steps)) & _first(("c", "d"), ("kc", "kd"), len(steps))
        marked = live.withColumn("goes", F.coalesce(goes, F.lit(False)))
        heirs = marked.where("goes").select(
            F.col("kc").alias("c"), F.col("kd").alias("d"), F.col("c").alias("gc"), F.col("d").alias("gd"), F.col("pc").alias("to_c"),
            F.col("pd").alias("to_d"), *[F.col(x).alias("g_" + x) for x in values + edge])
        stay = marked.where("NOT goes").select(*state, "n")
        moved = [F.coalesce("to_c", "pc").alias("pc"), F.coalesce("to_d", "pd").alias("pd")]
        seen = Observation()
        live = settle(_round(stay, [heirs], [
            *moved, *values, *[(F.col(e) + F.coalesce(F.col("g_" + v) + F.col("g_" + e), zero)).alias(e) for v, e in zip(values, edge, strict=True)],
            "n", "gc", "gd", *[(F.col("g_" + v) + F.col(e)).alias("add_" + v) for v, e in zip(values, edge, strict=True)]])
            .observe(seen, F.count_if(F.col("pd").isNotNull()).alias("n"), F.count_if(F.col("gd").isNotNull()).alias("left")))
        left = live.where("gd IS NOT NULL").select("gc", "gd", "c", "d", *["add_" + v for v in values])
        steps.append((raked.select("c", "d", *values) if leaves else None, left if seen.get["left"] else None))
        leaves = True
        if not seen.get["n"]:
            break
    # backwards: whoever was alive after a round has its total by now
    totals = live.select("c", "d", *values)
    for raked, left in reversed(steps):
        parts = [totals]
        if raked is not None:
            parts.append(raked)
        if left is not None:
            parts.append(left.join(totals, ["c", "d"]).select(
                F.col("gc").alias("c"), F.col("gd").alias("d"), *[(F.col("add_" + v) + F.col(v)).alias(v) for v in values]))
        totals = reduce(DataFrame.unionByName, parts)
        if left is not None:
            totals = settle(totals)  # those alive before the round: a share that shrinks with every later round
    return totals


def _digests(ends: DataFrame) -> DataFrame:
    """(c, d, ends_sha256) from (c, d, conv_id): a node's ids stream through its digest in order, one batch at a time."""
    dealt = ends.repartition("c", "d").sortWithinPartitions("c", "d", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()),
                pa.array([x[2] for x in done], pa.string())], names=["c", "d", "ends_sha256"])

        for batch in batches:
            for c, d, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (c, d) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (c, d), hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            if len(done) > 10_000:
                yield rows()
                done = []
        if node is not None:
            done.append((*node, digest.hexdigest()))
        yield rows()

    return dealt.select("c", "d", "conv_id").mapInArrow(run, "c long, d long, ends_sha256 string")


def prefix_trie(conversations: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row per node of the trie of (conversations, their turns); see ``rebuilt`` for their columns."""
    convs, turns = conversations
    spark = convs.sparkSession
    first = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    names = "c long, d long, pc long, pd long, n_convs long, words long"
    top = spark.createDataFrame([(first[0], 0, None, None, first[1], 0)] if first[1] else [], names)
    paths = settle(prefixes(turns))
    grouped = settle(paths.groupBy("depth", "k1", "k2", "p1", "p2").agg(
        F.min("conv_id").alias("c"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")))
    parents = grouped.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("pc"))
    upper = grouped.where("depth = 1").withColumn("pc", F.lit(first[0]).cast("long"))
    named = upper.unionByName(grouped.where("depth > 1").join(parents, ["depth", "p1", "p2"])).select(
        "c", F.col("depth").alias("d"), "pc", (F.col("depth") - 1).alias("pd"), "n_convs", "words")
    nodes = settle(named.unionByName(top))
    children = nodes.where("d > 0").groupBy("pc", "pd").agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed({"pc": "c", "pd": "d"})
    nodes = settle(nodes.join(children, ["c", "d"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))
    totals = subtree_totals(nodes.select(
        "c", "d", "pc", "pd", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    # where each conversation ends
    depth = turns.groupBy("conv_id").agg(F.max("pos").alias("depth"))
    last = (paths.join(depth, ["conv_id", "depth"]).select("conv_id", "depth", "k1", "k2")
            .join(grouped.select("depth", "k1", "k2", "c"), ["depth", "k1", "k2"]).select("c", F.col("depth").alias("d"), "conv_id"))
    turnless = convs.join(depth, "conv_id", "left_anti").select(F.lit(first[0]).cast("long").alias("c"), F.lit(0).cast("long").alias("d"), "conv_id")
    ends = _digests(last.unionByName(turnless))
    return (nodes.join(totals, ["c", "d"]).join(ends, ["c", "d"], "left")
            .select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
