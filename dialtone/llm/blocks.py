"""Blocks of documents that ask a table in shards, and get an answer each.

Where a model or a table of counts grows with the corpus it can't be broadcast, and
a join of every position of every text with it moves far more than the texts. Here a
block (some megabytes of text, one row) asks for each different key once: its keys are
dealt to shards by hash, a shard adds up what all blocks say and answers each block in
the order of its question. A hot key is one entry per block, however often it occurs.

A question is a row (block, shard, ask); there are at most as many as entries, and about
blocks x shards while shards are fewer than a block's keys. Blocks are written to the
shared folder once, so their numbers and the order of their keys stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on as compressed byte planes (sorted ones: pack their steps)."""
    v = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :blob[0]] = planes.T
    return out.view(np.uint64).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    v = np.ascontiguousarray(values, np.uint64)
    return pack(np.diff(v, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def bundle(parts: list[bytes]) -> bytes:
    """Several byte strings as one."""
    return b"".join([len(parts).to_bytes(4, "little"), *(len(p).to_bytes(8, "little") for p in parts), *parts])


def unbundle(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:4], "little")
    sizes = [int.from_bytes(blob[4 + 8 * i:12 + 8 * i], "little") for i in range(n)]
    ends = np.cumsum([4 + 8 * n, *sizes]).tolist()
    return [blob[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = (keys.astype(np.uint64) * _MIX) >> np.uint64(33)
    return (mixed % np.uint64(shards)).astype(np.int64)


def shards_for(entries: int, size: int) -> int:
    """As many shards as keep one at about ``size`` entries."""
    return max(1, -(-entries // size))


def blocks_of(batches: Iterator[pa.RecordBatch], text_at: int, size: int) -> Iterator[tuple[list, list]]:
    """(values of the other columns by row, UTF-8 texts) of about ``size`` bytes at a time."""
    from .common import utf8

    others: list[list] = []
    texts: list = []
    held = 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns) if i != text_at]
        for i, raw in enumerate(utf8(batch.column(text_at))):
            others.append([c[i] for c in columns])
            texts.append(raw)
            held += len(raw or b"") + 64
            if held >= size:
                yield others, texts
                others, texts, held = [], [], 0
    if texts:
        yield others, texts


def ask_all(blocks: DataFrame, questions: Callable[..., Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(block, shard, ask) rows; ``questions`` gets a block's row as a dict."""
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].as_py() for j, c in enumerate(names)}
                found = list(questions(row))
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["block"]] * len(found), pa.int64()), pa.array([s for s, _ in found], pa.int32()),
                    pa.array([a for _, a in found], pa.binary())], names=["block", "shard", "ask"])

    return blocks.mapInArrow(run, "block long, shard int, ask binary")


def gather_all(asked: DataFrame, shards: int) -> DataFrame:
    """(shard, blocks, asks): all questions of a shard as one row, by block. Written to the shared folder, the
    table may be read again and again without another shuffle."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        return pa.table({"shard": table.column("shard")[:1], "blocks": pa.array([table.column("block").to_pylist()], pa.list_(pa.int64())),
                         "asks": pa.array([bundle(table.column("ask").to_pylist())], pa.binary())})

    return asked.repartition(shards, "shard").groupBy("shard").applyInArrow(run, "shard int, blocks array<long>, asks binary")


def answer_gathered(gathered: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """(block, shard, reply) from the rows of ``gather_all``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blocks, asks in zip(*(batch.column(i) for i in range(3)), strict=True):
                replies = answer(unbundle(asks.as_py()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks.as_py(), pa.int64()), pa.array([shard.as_py()] * len(replies), pa.int32()),
                    pa.array(replies, pa.binary())], names=["block", "shard", "reply"])

    return gathered.select("shard", "blocks", "asks").mapInArrow(run, "block long, shard int, reply binary")


def answer_all(asked: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """(block, shard, reply): ``answer`` gets all questions of one shard, by block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        replies = answer(table.column("ask").to_pylist())
        return pa.table({"block": table.column("block"), "shard": table.column("shard"),
                         "reply": pa.array(replies, pa.binary())})

    return asked.groupBy("shard").applyInArrow(run, "block long, shard int, reply binary")


def with_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """``blocks`` with ``replies``, an array of (shard, reply)."""
    by_block = replies.groupBy("block").agg(F.collect_list(F.struct("shard", "reply")).alias("replies"))
    return blocks.join(by_block, "block", "left")
