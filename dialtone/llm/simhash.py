"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits; bit b is set if it is set in over half of the XXH64
values (seed 42) of the text's word shingles, repeats included. Fingerprints link
at ``distance`` or fewer differing bits; groups are connected components.

Pigeonhole: the bits are split in ``blocks`` parts. Two linked fingerprints differ
in at most ``distance`` parts, so they agree in ``blocks - distance`` whole parts at
least. Every choice of that many parts is a key; rows of one key are compared and
Hamming distance verified. More blocks make longer keys: take 5 for up to some
10^8 texts (keys of 25 bits), 6 beyond that (32 bits).

Skew: equal fingerprints are one row before the join. A key that still holds more
than ``hot`` different fingerprints is split again, exactly, by the pigeonhole over
its remaining bits. Within a key only a spanning forest of links leaves the task.

Nulls, empty texts: a null or empty text has fingerprint zero, linked like any
other. A null id never becomes a component id unless all ids of the group are null.
Repeated rows are judged row by row. Clashing input columns give way to results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, settle

BITS = 64
FINGERPRINT = T.StructField("_fp", T.LongType())
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


@dataclass(frozen=True)
class SimHash:
    shingle: int = 3
    distance: int = 3
    blocks: int = 5
    hot: int = 32_768


def fingerprint(raw: bytes | None, shingle: int) -> int:
    """As an unsigned number; 0 for a text without words."""
    words = (raw or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in
                       zip(begins[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with ``_fp``, the fingerprint as a signed long."""

    def run(raws: list) -> list[list]:
        return [np.array([fingerprint(raw, shingle) for raw in raws], np.uint64).view(np.int64).tolist()]

    return append_columns(docs, text, [FINGERPRINT], run)


def parts_of(n: int, count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``count`` nearly equal parts of ``n`` bits."""
    edges = [n * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(parts: list[tuple[int, int]]) -> int:
    return sum(((1 << n) - 1) << a for a, n in parts)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _masked(fp: Column, masks: list[int]) -> Column:
    """One struct per mask: its number and the fingerprint's bits under it."""
    return F.array(*[F.struct(F.lit(i).alias("no"), fp.bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits"))
                     for i, m in enumerate(masks)])


def links(distinct: DataFrame, params: SimHash = SimHash()) -> DataFrame:
    """(a, b) links between different fingerprints ``_fp``: within each key a spanning
    forest of its links, so components are whole and no group is expanded to pairs."""
    d, n = params.distance, params.blocks
    parts = parts_of(BITS, n)
    chosen = [list(c) for c in combinations(parts, n - d)]
    masks = [_mask(c) for c in chosen]
    keyed = (distinct.select("_fp", F.explode(_masked(F.col("_fp"), masks)).alias("k"))
             .select(F.col("k.no").alias("no"), F.col("k.bits").alias("bits"), F.lit(0).alias("sub"),
                     F.lit(0).cast("long").alias("rest"), "_fp"))
    sizes = keyed.groupBy("no", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = keyed.join(sizes, ["no", "bits"])
    # the rest of a hot key's bits in distance + 1 parts: linked rows agree in one of them
    finer = F.lit(None).cast("array<struct<no:int,bits:bigint>>")
    for i, mask in enumerate(masks):
        left = [b for b in range(BITS) if not mask >> b & 1]
        subs = [sum(1 << left[j] for j in range(a, a + w)) for a, w in parts_of(len(left), d + 1)]
        finer = F.when(F.col("no") == i, _masked(F.col("_fp"), subs)).otherwise(finer)
    whole = F.array(F.struct(F.lit(-1).alias("no"), F.lit(0).cast("long").alias("bits")))
    keyed = (keyed.withColumn("s", F.explode(F.when(F.col("n") > params.hot, finer).otherwise(whole)))
             .select("no", "bits", F.col("s.no").alias("sub"), F.col("s.bits").alias("rest"), "_fp"))
    keys = ["no", "bits", "sub", "rest"]
    # equal keys stand together after the exchange and the sort inside partitions
    dealt = keyed.repartition(*[F.col(c) for c in keys]).sortWithinPartitions(*keys, "_fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            a, b = forest([table[c] for c in keys], table["_fp"], d)
            for at in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[at:at + 50_000]), pa.array(b[at:at + 50_000])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 100_000) -> Iterator[dict]:
    """Columns of about ``rows`` rows at a time; rows with equal keys stay together."""
    held: list[dict] = []
    count = 0

    def joined() -> dict:
        return {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append({c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names)})
        count += batch.num_rows
        if count >= rows:
            table = joined()
            same = np.ones(count, bool)
            for k in keys:
                same &= table[k] == table[k][-1]
            cut = count - (np.argmin(same[::-1]) if not same.all() else count)
            if cut:
                yield {c: v[:cut] for c, v in table.items()}
            held, count = [{c: v[cut:] for c, v in table.items()}], count - cut
    if count:
        yield joined()


def forest(keys: list[np.ndarray], fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of each key's rows (rows sorted by key)."""
    n = len(fps)
    change = np.zeros(n, bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    group = np.cumsum(change)
    end = np.searchsorted(group, group, side="right")  # of each row's group
    fps = fps.view(np.uint64)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out: list[tuple[int, int]] = []
    left = np.arange(n)
    step = 1
    while True:
        left = left[left + step < end[left]]
        if not len(left):
            break
        near = left[np.bitwise_count(fps[left] ^ fps[left + step]) <= distance]
        near = near[parent[near] != parent[near + step]]
        for i in near.tolist():
            a, b = root(i), root(i + step)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, i + step))
        if len(near):
            while True:  # point everything at its root
                above = parent[parent]
                if np.array_equal(above, parent):
                    break
                parent = above
        step += 1
    pairs = np.array(out, np.int64).reshape(-1, 2)
    signed = fps.view(np.int64)
    return signed[pairs[:, 0]], signed[pairs[:, 1]]


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternating large-star and small-star rounds; each is one shuffle with a
    map-side minimum and a join, and is settled in the shared folder. A star's
    hub is a key with many rows: the minimum combines before the shuffle and the
    join may be split by the adaptive planner.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(most_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                               F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = settle(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(now)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _row_hashes(docs: DataFrame) -> list[Column]:
    """128 bits that tell rows apart."""
    columns = [F.col(c) for c in docs.columns]
    return [F.xxhash64(*columns).alias("_h1"), F.xxhash64(F.lit(1), *columns).alias("_h2")]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    params: SimHash = SimHash()) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``
    (the smallest id reachable) and ``_h1``, ``_h2``, which tell rows of one id apart."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *_row_hashes(docs))
    rows = settle(fingerprints(rows, "text", params.shingle).select("doc_id", "_h1", "_h2", "_fp"))
    distinct = rows.groupBy("_fp").agg(F.min("doc_id").alias("low"))
    reached = components(links(distinct, params))
    rooted = (distinct.join(reached, distinct["_fp"] == reached["node"], "left")
              .select("_fp", "low", F.coalesce("root", "_fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("_fp", "component_id")
    return (rows.join(named, "_fp")
            .select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id", "_h1", "_h2"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             params: SimHash = SimHash()) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, of rows with
    that id the one with the smallest hash, of wholly equal rows one. Of groups without
    any id one document per fingerprint stays. Columns may have any names."""
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*own.values())
    found = near_duplicates(rows, own[doc_id], own[text], params)
    unnamed = F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    first = (found.groupBy("component_id", unnamed.alias("f"))
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_h1", "_h2")).alias("k"))
             .select(F.col("k._h1").alias("_h1"), F.col("k._h2").alias("_h2")))
    kept = rows.select("*", *_row_hashes(rows)).join(first, ["_h1", "_h2"], "left_semi")
    return kept.dropDuplicates(["_h1", "_h2"]).select(*own.values()).toDF(*docs.columns)
