"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and lifted by one coordinate to the unit sphere,
where the largest inner product is the smallest Euclidean distance. Each of ``tables``
tables hashes with ``hashes`` functions floor((a.x + b) / width), a from the 2-stable
normal distribution; the values are clamped to three slots, so a table has
3 ** hashes buckets whatever the data.

Multiprobe: for a query, the chance that a neighbour at the wanted similarity falls in
a bucket is the product of normal probabilities of its slots, given the query's
projections. Buckets are visited in falling order of that chance until its sum reaches
``success`` and the buckets hold enough rows. The wanted similarity, a low quantile of
that of k-th neighbours, is fitted on a bounded sample of ``sample_floats`` numbers.
Data without structure makes many probes, clustered data few; nothing is capped.

Buckets are packed into blocks of about ``block_rows`` rows, a hot bucket is split over
several. A query is sent once to every block with a bucket that it visits, with a bit
per visited bucket; there its candidates are ranked by exact inner products in double
precision on the original vectors, and only the best k leave as one row. Lists of a
query are merged in two steps. Queries in turn are cut in parts of ``query_part``.

Vectors that are null, empty, zero or hold null or non-finite numbers, and rows with a
null id, take no part, neither as query nor as candidate. A query meets vectors of its
own dimension only and never rows with its own id; rows that repeat an id and vector count once. Ties go
to the smaller id. Fewer candidates than k: all of them. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, settle

SLOTS = 3


@dataclass(frozen=True)
class Search:
    k: int = 20
    tables: int = 2
    hashes: int = 8
    width: float = 1.0
    success: float = 0.75     # per table
    quantile: float = 0.1
    sample_floats: int = 4_000_000
    sample_queries: int = 128
    block_rows: int = 4096
    query_part: int = 8192
    seed: int = 5


def valid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, vector (doubles) and dim of the rows that take part, each id and vector once:
    neither a bucket's size nor a block's k best may count repeats. Written, as the index
    reads it several times."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = (rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull())
            .where((F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)))
    return settle(rows.dropDuplicates().withColumn("dim", F.size("vector")))


@dataclass
class Table:
    """One hash table over vectors of one dimension."""

    directions: np.ndarray    # hashes x (dim + 1)
    shifts: np.ndarray
    width: float
    first: np.ndarray | None = None    # block of a bucket
    splits: np.ndarray | None = None   # blocks of a bucket
    rows: np.ndarray | None = None     # rows of a bucket
    spans: np.ndarray | None = None    # first bucket of a block and one past its last

    def projections(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.directions.T + self.shifts

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        slots = np.clip(np.floor(self.projections(unit) / self.width), -1, 1).astype(np.int64) + 1
        return slots @ (SLOTS ** np.arange(slots.shape[1]))

    def chances(self, unit: np.ndarray, similarity: float) -> np.ndarray:
        """Of a neighbour being in each bucket, per query."""
        shifted = self.projections(unit)
        own = shifted - self.shifts
        spread = np.sqrt(np.maximum(1e-9, (1 - similarity ** 2) * ((self.directions ** 2).sum(axis=1) - own ** 2)
                                    / max(1, unit.shape[1] - 1)))
        centre = similarity * own + self.shifts
        edges = [_normal((edge - centre) / spread) for edge in (0.0, self.width)]
        slots = np.stack([edges[0], edges[1] - edges[0], 1 - edges[1]], axis=2)
        chance = np.ones((len(unit), 1))
        for i in reversed(range(slots.shape[1])):   # the last hash is the highest digit
            chance = (chance[:, :, None] * slots[:, i, None, :]).reshape(len(unit), -1)
        return chance


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function (Abramowitz and Stegun 26.2.17; error under 1e-7)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, 1 - tail, tail)


def lifted(rows: np.ndarray, largest: float) -> np.ndarray:
    scaled = rows / largest
    rest = np.sqrt(np.maximum(0.0, 1 - (scaled ** 2).sum(axis=1)))
    return np.hstack([scaled, rest[:, None]])


def as_query(rows: np.ndarray) -> np.ndarray:
    """The direction of a query; its length does not change the order of its neighbours."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return np.hstack([scaled / np.linalg.norm(scaled, axis=1, keepdims=True), np.zeros((len(rows), 1))])


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


@dataclass
class Index:
    params: Search
    vectors: DataFrame                 # of ``valid``
    largest: dict[int, float]          # by dimension
    similarity: dict[int, float]
    tables: dict[tuple[int, int], Table]


def build(vectors: DataFrame, params: Search = Search()) -> Index:
    """Fit the index to ``vectors`` (of ``valid``): norms, wanted similarity, bucket sizes."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    dims = {r["dim"]: r for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm")).collect()}
    index = Index(params, vectors, {d: float(r["norm"]) for d, r in dims.items()}, {}, {})
    for dim, row in sorted(dims.items()):
        share = min(1.0, params.sample_floats / dim / row["n"])
        sample = vectors.where((F.col("dim") == dim) & (hash_share(F.col("id"), salt="ann") < share)).select("id", "vector").toArrow()
        ids = np.array(sample.column("id"))
        rows = matrix(sample.column("vector").combine_chunks())[np.argsort(ids, kind="stable")] if len(ids) else np.ones((1, dim))
        index.similarity[dim] = _wanted(rows, index.largest[dim], share, params)
        for t in range(params.tables):
            draw = np.random.default_rng((params.seed, dim, t))
            index.tables[dim, t] = Table(draw.normal(size=(params.hashes, dim + 1)),
                                         draw.uniform(0, params.width, params.hashes), params.width)
    sizes = hashed(index).groupBy("dim", "table", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    for (dim, t), table in index.tables.items():
        table.rows = np.zeros(SLOTS ** params.hashes, np.int64)
        for r in sizes:
            if (r["dim"], r["table"]) == (dim, t):
                table.rows[r["bucket"]] = r["n"]
        _pack(table, params.block_rows)
    return index


def _wanted(rows: np.ndarray, largest: float, share: float, params: Search) -> float:
    unit, asked = lifted(rows, largest), as_query(rows[:: max(1, len(rows) // params.sample_queries)][:params.sample_queries])
    near = asked @ unit.T
    rank = min(near.shape[1], 1 + max(1, round(params.k * share)))   # the query itself is first
    kth = np.partition(near, near.shape[1] - rank, axis=1)[:, near.shape[1] - rank]
    return float(np.clip(np.quantile(kth, params.quantile), 0.0, 0.999))


def _pack(table: Table, block_rows: int) -> None:
    """Consecutive buckets share a block; a bucket over the size has blocks of its own."""
    table.first, table.splits = np.zeros_like(table.rows), np.ones_like(table.rows)
    block, held, spans = 0, 0, {}
    for b, n in enumerate(table.rows.tolist()):
        if not n:
            continue
        if held and held + n > block_rows:
            block, held = block + 1, 0
        pieces = max(1, -(-n // block_rows))
        table.first[b], table.splits[b] = block, pieces
        for i in range(block, block + pieces):
            spans[i] = (spans.get(i, (b, b))[0], b + 1)
        block, held = (block + pieces, 0) if pieces > 1 else (block, held + n)
    table.spans = np.array([spans[i] for i in sorted(spans)]).reshape(-1, 2)


def hashed(index: Index) -> DataFrame:
    """A row per vector and table: dim, table, bucket, block, id, vector."""
    tables, largest, count = index.tables, index.largest, index.params.tables
    names = ["dim", "table", "bucket", "block", "id", "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, column in by_dimension(batches):
            rows = lifted(matrix(column), largest[dim])
            for t in range(count):
                table = tables[dim, t]
                bucket = table.buckets(rows)
                block = bucket * 0
                if table.first is not None:
                    block = table.first[bucket] + np.array(ids).view(np.uint64) % table.splits[bucket].astype(np.uint64)
                fixed = [pa.array(np.full(len(bucket), v, np.int32)) for v in (dim, t)]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(bucket), pa.array(block.astype(np.int64)), ids, column], names=names)

    return index.vectors.select("id", "vector", "dim").mapInArrow(
        run, "dim int, table int, bucket long, block long, id long, vector array<double>")


def by_dimension(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, pa.Array]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            yield dim, part.column("id"), part.column("vector")


def probes(index: Index, queries: DataFrame, parts: int) -> DataFrame:
    """A row per query and block that it visits: dim, table, block, part, id, vector, visited
    (a bit for each of the block's buckets)."""
    tables, similarity, params = index.tables, index.similarity, index.params
    names = ["dim", "table", "block", "part", "id", "vector", "visited"]

    def visit(table: Table, unit: np.ndarray, wanted: float) -> np.ndarray:
        chance = table.chances(unit, wanted)
        order = np.argsort(-chance, axis=1, kind="stable")
        total = np.cumsum(np.take_along_axis(chance, order, 1), axis=1)
        rows = np.cumsum(table.rows[order], axis=1)
        # a bucket is visited unless those before it already suffice
        enough = (total[:, :-1] >= params.success) & (rows[:, :-1] > min(params.k, int(table.rows.sum()) - 1))
        visited = np.ones_like(chance, bool)
        np.put_along_axis(visited, order[:, 1:], ~enough, 1)
        return visited & (table.rows > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, all_ids, column in by_dimension(batches):
            for start in range(0, len(all_ids), 256):
                ids, part = all_ids.slice(start, 256), column.slice(start, 256)
                unit = as_query(matrix(part))
                piece = np.array(ids).view(np.uint64) % np.uint64(parts)
                for t in range(params.tables):
                    table = tables[dim, t]
                    visited = visit(table, unit, similarity[dim])
                    out: list[list] = [[], [], []]
                    for block, (low, end) in enumerate(table.spans.tolist()):
                        some = visited[:, low:end]
                        at = np.flatnonzero(some.any(axis=1))
                        out[0] += [block] * len(at)
                        out[1] += at.tolist()
                        out[2] += [np.packbits(some[i]).tobytes() for i in at]
                    at = pa.array(out[1], pa.int32())
                    fixed = [pa.array(np.full(len(at), v, np.int32)) for v in (dim, t)]
                    yield pa.RecordBatch.from_arrays(
                        [*fixed, pa.array(out[0], pa.int64()), pa.array(piece[out[1]].astype(np.int32)),
                         ids.take(at), part.take(at), pa.array(out[2], pa.binary())], names=names)

    return queries.select("id", "vector", "dim").mapInArrow(
        run, "dim int, table int, block long, part int, id long, vector array<double>, visited binary")


def best(scores: np.ndarray, ids: np.ndarray, exact, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query; ``exact`` gives the scores of the rows near the edge afresh,
    summed in the same order for equal vectors, so ties are ties."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge - 1e-9 * max(1.0, abs(edge)))
    else:
        near = np.arange(len(scores))
    found = exact(near)
    order = np.lexsort((ids[near], -found))[:k]
    return ids[near][order], found[order]


def search(index: Index, queries: DataFrame) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for ``queries`` (of ``valid``)."""
    params, tables = index.params, index.tables
    k = params.k
    parts = max(1, -(-queries.count() // params.query_part))
    rows = hashed(index).select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asked = probes(index, queries, parts)
    keys = ["dim", "table", "block", "part"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            dim, t, block = (left.column(c)[0].as_py() for c in keys[:3])
            low = int(tables[dim, t].spans[block][0])
            x, ids = matrix(left.column("vector").combine_chunks()), np.array(left.column("id"))
            at = np.array(left.column("bucket")) - low
            asks, asking = matrix(right.column("vector").combine_chunks()), np.array(right.column("id"))
            bits = right.column("visited").to_pylist()
            for start in range(0, len(asks), 512):
                scores = asks[start:start + 512] @ x.T
                for j, q in enumerate(range(start, min(start + 512, len(asks)))):
                    wanted = np.unpackbits(np.frombuffer(bits[q], np.uint8))
                    hit = np.flatnonzero(wanted[at].astype(bool) & (ids != asking[q]))
                    if len(hit):
                        one = asks[q]
                        names, found = best(scores[j, hit], ids[hit], lambda near: (x[hit[near]] * one).sum(axis=1), k)  # noqa: B023
                        for column, v in zip(out, (asking[q], block, names.tolist(), found.tolist()), strict=True):
                            column.append(v)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())),
                         pa.array(out[3], pa.list_(pa.float64()))], names=["query_id", "block", "ids", "scores"])

    lists = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        rank, "query_id long, block long, ids array<long>, scores array<double>")
    paired = lists.select("query_id", "block", F.arrays_zip(F.transform("scores", lambda s: -s).alias("far"),
                                                           F.col("ids").alias("id")).alias("found"))
    blocks = sum(len(t.spans) for t in index.tables.values())
    salt = F.pmod("block", F.lit(max(1, math.isqrt(blocks))))
    half = paired.groupBy("query_id", salt.alias("salt")).agg(_merged(k).alias("found"))
    whole = half.groupBy("query_id").agg(_merged(k).alias("found"))
    return whole.select("query_id", F.posexplode("found").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score"))


def _merged(k: int) -> Column:
    """The best k of lists of (far, id), without repeats."""
    return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), 1, k)
