"""Mixing sources to target weights.

Native. Sizes are words. The words of a source, documents one after another, are
packed into blocks of ``block`` words. A mix is a row of slots, ``shard`` of them to
an output shard, each naming a block:

* targets: sources share the whole size by weight; a target stops at ``most`` times
  its source's size and the excess goes to the others by weight (water filling);
* counts: a source owns as many numbers of a grid as slots give its target, rounded to
  whole words and at least one word: all its blocks for each whole pass over the source,
  then blocks for the rest, of which the last is cut. A pseudorandom permutation deals
  the grid to the slots, so each output shard gets a multinomial draw of sources,
  conditioned on totals that are the targets;
* blocks: the source's i-th slot takes the block at place ``i`` of a pseudorandom
  permutation of its blocks, a new one for each pass over them, so no word is taken
  more often than another of its source by more than one. A source's last block may be
  short; in the pass that is not whole it comes last, so the words taken are exact;
* slots and blocks are joined by block number.

Permutations are four-round Feistel networks on the number's row and column in a
near-square, walked until they land in range: plain arithmetic per row.

Scale: a source's word order is that of a hash of the row. The running total that
gives a document its place is taken within ``buckets`` hash buckets of the source
and the bucket totals are added, so a hot source is ``buckets`` sorts. Slots of a
source are made in chunks. The join's keys are single blocks. Nothing per row
passes the driver; the only number it reads is the count of slots.

Nulls: a null text has size 0; a null source is a source, after all others. Size 0
is taken 0 times. Rows that are equal in all columns may swap their results. Input
columns named like a result column give way to it. No rows: no result rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

WORD = r"[^\x20\x09-\x0D]++"


@dataclass(frozen=True)
class Mixing:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)   # repeating over the sources in order
    most: float = 3.0
    block: int = 128
    shard: int = 4096
    buckets: int = 256
    chunk: int = 16_384


def shuffled(x: Column, n: Column, key: Column) -> Column:
    """The place of ``x`` in a pseudorandom permutation, named by ``key``, of 0 .. n-1."""
    rows = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    cols = F.ceil(n.cast("double") / rows).cast("long") + F.lit(1).cast("long")

    def network(v: Column) -> Column:
        a, b = F.pmod(v, rows), F.floor(v / rows).cast("long")
        for turn in range(4):
            if turn % 2 == 0:
                a = F.pmod(a + F.pmod(F.xxhash64(b, key, F.lit(turn)), rows), rows)
            else:
                b = F.pmod(b + F.pmod(F.xxhash64(a, key, F.lit(turn)), cols), cols)
        return a + b * rows

    # Numbers outside 0 .. n-1 go on through the network. They are about two rows of the
    # near-square, so more than 200 steps have no measurable chance at any size; below
    # that many outside numbers a walk must end sooner.
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(200)), network(x),
                       lambda v, _: F.when(v < n, v).otherwise(network(v)))
    return F.when(n > 1, walk).otherwise(F.lit(0).cast("long"))


def targets(sizes: DataFrame, params: Mixing) -> DataFrame:
    """``sizes`` (source, source_size) with ``sid``, the source's place by code point (null
    last), and ``target``. One row per source; windows over sources only."""
    n = len(params.weights)
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = sizes.withColumn("sid", F.row_number().over(ordered).cast("long") - 1)
    weighed = weighed.withColumn("weight", F.array(*map(F.lit, params.weights))[F.pmod("sid", F.lit(n)).cast("int")])
    weighed = weighed.withColumn("cap", params.most * F.col("source_size"))
    # in the order of cap / weight the capped sources come first
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    level = weighed.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                               / (weight - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # up to the first source that its share leaves under its cap, all are capped
    level = level.withColumn("rank", F.row_number().over(by_ratio))
    free = F.when(F.col("weight") * F.col("level") < F.col("cap"), F.struct("rank", "level"))
    level = level.withColumn("first", F.min(free).over(everything))
    target = F.when(F.col("rank") >= F.col("first.rank"), F.col("weight") * F.col("first.level")).otherwise(F.col("cap"))
    return level.select("source", "source_size", "sid", target.cast("double").alias("target"))


@dataclass(frozen=True)
class Mix:
    documents: DataFrame   # sid, start, size, source_size, target and the row's own key columns
    pieces: DataFrame      # sid, block, start (of the document), first, n_words, at (in the block)
    slots: DataFrame       # shard, slot, sid, block, words (the slot takes so many of the block, at most)


def plan(docs: DataFrame, keys: list[str], text: str = "text", source: str = "source",
         params: Mixing = Mixing()) -> Mix:
    """The mix of ``docs``: which blocks the slots take and of which words blocks consist."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(*keys, F.col(source).alias("_source"), size.alias("size"),
                       F.xxhash64(F.col(source), F.col(text), *[F.col(k) for k in keys]).alias("_order"))
    rows = settle(rows.withColumn("_bucket", F.pmod("_order", F.lit(params.buckets))))
    buckets = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("n"))
    sizes = buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("n").alias("source_size"))
    goals = settle(targets(sizes, params))
    goals = goals.withColumn("n_blocks", F.ceil(F.col("source_size") / params.block).cast("long"))
    goals = goals.withColumn("n_full", F.floor(F.col("source_size") / params.block).cast("long"))
    words = F.when(F.col("target") > 0, F.greatest(F.floor(F.col("target") + 0.5).cast("long"), F.lit(1).cast("long")))
    goals = goals.withColumn("passes", F.when(F.col("target") > 0, F.floor(words / F.col("source_size")).cast("long")))
    goals = goals.withColumn("rest", words - F.col("passes") * F.col("source_size"))
    goals = goals.withColumn("n_slots", F.coalesce(
        F.col("passes") * F.col("n_blocks") + F.ceil(F.col("rest") / params.block).cast("long"), F.lit(0).cast("long")))
    ahead = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("_source", "_bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long")).alias("_offset"))
    within = Window.partitionBy("_source", "_bucket").orderBy("_order", *keys, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long")))
    placed = placed.join(offsets.withColumnsRenamed({"_source": "s", "_bucket": "b"}),
                         F.col("_source").eqNullSafe(F.col("s")) & (F.col("_bucket") == F.col("b")))
    placed = placed.join(goals, F.col("_source").eqNullSafe(F.col("source")))
    documents = placed.select("sid", (F.col("_in") + F.col("_offset")).alias("start"), "size", "source_size", "target", *keys)

    whole = documents.where("size > 0").select("sid", "start", "size")
    first, last = F.floor(F.col("start") / params.block), F.floor((F.col("start") + F.col("size") - 1) / params.block)
    pieces = whole.select("*", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * params.block, "start")
    pieces = pieces.select("sid", "block", "start", (begin - F.col("start")).alias("first"),
                           (F.least((F.col("block") + 1) * params.block, F.col("start") + F.col("size")) - begin).alias("n_words"),
                           (begin - F.col("block") * params.block).alias("at"))

    in_order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    owned = goals.where("n_slots > 0").select(
        "sid", "n_slots", "n_blocks", "n_full", "passes", "rest", F.coalesce(F.sum("n_slots").over(in_order), F.lit(0).cast("long")).alias("grid"))
    total = goals.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    chunks = owned.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / params.chunk))).alias("chunk"))
    # a number of partitions of our own: the rows are few before they are exploded, and the
    # adaptive planner would put them in one
    chunks = chunks.repartition(min(10_000, 1 + total // params.chunk), "sid", "chunk")
    low = F.col("chunk") * params.chunk
    slots = chunks.select("sid", "n_blocks", "n_full", "passes", "rest", "grid", F.explode(
        F.sequence(low, F.least(low + params.chunk, F.col("n_slots")) - 1)).alias("i"))
    slot = shuffled(F.col("grid") + F.col("i"), F.lit(total).cast("long"), F.lit("slots"))
    turn = F.floor(F.col("i") / F.col("n_blocks")).cast("long")
    place = F.pmod("i", F.col("n_blocks"))
    in_whole = turn < F.col("passes")
    mixed = F.when(in_whole, F.col("n_blocks")).otherwise(F.col("n_full"))   # a short block keeps its place, the last
    block = F.when(place < mixed, shuffled(place, mixed, F.concat_ws("/", F.col("sid"), turn))).otherwise(place)
    whole_block = F.lit(params.block).cast("long")
    words = F.when(in_whole, whole_block).otherwise(F.least(whole_block, F.col("rest") - place * params.block))
    slots = slots.select("sid", slot.alias("slot"), block.alias("block"), words.alias("words"))
    return Mix(documents, pieces, slots.select(F.floor(F.col("slot") / params.shard).alias("shard"), "slot", "sid", "block", "words"))


def _in_slot() -> Column:
    """Words of a piece that a slot takes."""
    return F.greatest(F.least("n_words", F.col("words") - F.col("at")), F.lit(0).cast("long"))


def taken(mix: Mix) -> DataFrame:
    """The documents of a mix with the words that it takes of each, repeats counted."""
    # both grow with the input, whatever the planner makes of exploded ranges: no broadcast
    uses = mix.slots.groupBy("sid", "block", "words").agg(F.count(F.lit(1)).alias("uses")).hint("merge")
    words = (mix.pieces.join(uses, ["sid", "block"])
             .groupBy("sid", "start").agg(F.sum(_in_slot() * F.col("uses")).alias("taken")).hint("merge"))
    some = mix.documents.where("size > 0").join(words, ["sid", "start"], "left")
    none = mix.documents.where("size = 0").withColumn("taken", F.lit(None).cast("long"))
    return some.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_texts(docs: DataFrame, mix: Mix, key: str, text: str = "text") -> DataFrame:
    """The mix itself: per slot, in slot order, the words of its block, one row per document
    (shard, slot, part, ``key``, text). ``key`` must tell the documents apart."""
    named = mix.documents.where("size > 0").select("sid", "start", key)   # an empty text shares its start with the next
    used = (mix.slots.hint("merge").join(mix.pieces, ["sid", "block"]).join(named.hint("merge"), ["sid", "start"])
            .select("shard", "slot", F.col("start").alias("part"), key, "first", _in_slot().alias("n_words")).where("n_words > 0"))
    words = docs.select(key, F.regexp_extract_all(F.col(text), F.lit(WORD), 0).alias("_words"))
    cut = F.array_join(F.slice("_words", (F.col("first") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    return used.join(words, key).select("shard", "slot", "part", key, cut.alias("text"))
