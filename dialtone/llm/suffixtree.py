"""Language-model scores from a probabilistic suffix tree over words.

A state of the tree is a context, the last 1 to ``depth`` words (a start mark counts as a
word). Contexts that make up ``least_share`` of the training positions at least are
candidates: at most 1 / ``least_share`` of each length at any corpus size, which bounds
what is broadcast. Their next-symbol distributions, over all words, stay distributed.

Smoothing: P(w | s) = (c(s w) + m P(w | longer state's suffix)) / (c(s) + m), down to the
root, (c(w) + 1) / (N + V + 1). The strength m of a context is the one of ``strengths``
with the best leave-one-out likelihood.

Divergence test: the context is retained if that likelihood exceeds its suffix's by
``least_gain`` nats per occurrence: the Kullback-Leibler divergence of its next symbols
from its suffix's, each occurrence judged by the others. A text is scored word by word
from the longest retained suffix of what precedes.

Work: texts become blocks of word numbers once (see ``blocks``). A block asks for each
different (state, word) once, with its training count; shards of the words add up all
blocks, measure the gains of one context length after another, then answer. Words are
known by 64-bit hashes (two of 10^7 words share one with probability 3 in 10^6).

Nulls: a null text is empty: it has the end symbol only. A null ``train`` counts as
false. Repeated rows are documents of their own. Of strengths with equal likelihood the
smaller is taken. Without training documents there is no symbol, so every score is 0.
An empty table gives no rows. Only the named columns are read, so others can't clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from .blocks import (answer_gathered, ask_all, blocks_of, bundle, gather_all, pack, pack_sorted, shard_of, shards_for, unbundle, unpack,
                     unpack_sorted, with_replies)
from .common import _arrow_type, settle

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_GAP = regex.compile(rb"[\x20\x09-\x0D]")
#: No word holds white space, so these are no word's texts.
START, END = (np.uint64(xxh64_intdigest(mark)) for mark in (b" ", b"\n"))
NATS = float(1 << 20)  # gains are added up as whole numbers of this part, so their order is of no matter


@dataclass(frozen=True)
class SuffixTree:
    depth: int = 3
    least_share: float = 1e-5
    least_count: int = 2
    least_gain: float = 0.02
    strengths: tuple[float, ...] = (0.5, 2.0, 8.0, 32.0, 128.0, 512.0, 2048.0, 8192.0, 32768.0)
    block: int = 6 << 20       # bytes of text in a block
    shard: int = 1 << 20       # tokens that a shard answers for, about
    held_words: int = 500_000  # words whose hashes a task keeps


class Hashes(dict):
    def __missing__(self, word):
        self[word] = h = xxh64_intdigest(word)
        return h


def word_hashes(raw: bytes | None, known: Hashes, piece: int = 4 << 20) -> np.ndarray:
    """Hashes of a text's words and the end symbol."""
    out, at, raw = [], 0, raw or b""
    while at < len(raw):
        gap = _GAP.search(raw, min(at + piece, len(raw)))
        stop = gap.start() if gap else len(raw)
        words = raw[at:stop].translate(_LOWER).split()
        out.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        at = stop
    return np.concatenate([*out, np.array([END], np.uint64)])


def word_blocks(docs: DataFrame, params: SuffixTree) -> DataFrame:
    """A written table of blocks from (doc_id, train, text)."""
    id_type = _arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for others, texts in blocks_of(batches, 2, params.block):
            if len(known) > params.held_words:
                known.clear()
            found = [word_hashes(raw, known) for raw in texts]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            words, ids, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # frequent words get small numbers
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            train = np.array([bool(o[1]) for o in others])
            yield pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([[o[0] for o in others]], pa.list_(id_type)),
                pa.array([bundle([pack(words[order]), pack(rank[ids]), pack(sizes), pack(train)])], pa.binary()),
                pa.array([int(sizes[train].sum())], pa.int64()), pa.array([int(train.sum())], pa.int64()),
                pa.array([int(sizes.sum())], pa.int64())],
                names=["block", "ids", "payload", "n_train", "n_texts", "n_tokens"])

    longs = [T.StructField(c, T.LongType()) for c in ("n_train", "n_texts", "n_tokens")]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
                           T.StructField("payload", T.BinaryType()), *longs])
    return settle(docs.mapInArrow(run, schema))


class Block:
    """A block's words (sorted hashes), its tokens as places among them, and its documents."""

    def __init__(self, payload: bytes):
        words, ids, sizes, train = map(unpack, unbundle(payload))
        order = np.argsort(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.ids = words[order], place[ids.astype(np.int64)]
        self.sizes, self.train = sizes.astype(np.int64), train.astype(bool)
        self.in_train = np.repeat(self.train, self.sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes


@dataclass
class Tree:
    """Candidate contexts as nodes: 0 is the root; a node's parent lacks its oldest word."""
    tokens: int                    # N, training tokens
    symbols: int                   # V, distinct among them
    words: np.ndarray              # sorted hashes that contexts are made of
    keys: list[np.ndarray] = field(default_factory=list)  # by length from 2 on: parent * (words + 1) + word, sorted
    first: list[int] = field(default_factory=lambda: [1])  # first node by length
    count: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    parent: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    strength: np.ndarray = field(default_factory=lambda: np.zeros(1))  # inf: not retained

    @property
    def width(self) -> int:
        return len(self.words) + 1

    def add(self, parents: np.ndarray, counts: np.ndarray) -> None:
        self.parent = np.concatenate((self.parent, parents))
        self.count = np.concatenate((self.count, counts))
        self.strength = np.concatenate((self.strength, np.full(len(counts), np.inf)))
        self.first.append(len(self.count))

    def words_before(self, block: Block) -> Iterator[np.ndarray]:
        """Per position the context word (-1: none) one place before, two places before, ..."""
        places = find(self.words, block.words)
        before = np.concatenate(([-1], places[block.ids[:-1]])) if len(block.ids) else block.ids
        before[block.begins] = find(self.words, np.array([START]))[0]
        while True:
            yield before
            before = np.concatenate(([-1], before[:-1]))
            before[block.begins] = -1

    def nodes(self, block: Block, length: int) -> np.ndarray:
        """Per position the node of its last ``length`` words, 0 if that is no candidate."""
        words = self.words_before(block)
        node = next(words) + 1
        for keys, first in zip(self.keys[:length - 1], self.first[1:], strict=False):
            older = next(words)
            place = find(keys, node * self.width + older)
            node = np.where((node > 0) & (older >= 0) & (place >= 0), first + place, 0)
        return node

    def states(self, block: Block) -> np.ndarray:
        """Per position the longest candidate."""
        state = np.zeros(len(block.ids), np.int64)
        for length in range(1, len(self.first)):
            node = self.nodes(block, length)
            state = np.where(node > 0, node, state)
        return state

    def ancestor(self, nodes: np.ndarray, length: int) -> np.ndarray:
        """The suffix of ``length`` words of each node; 0 for shorter ones."""
        for n in range(len(self.first) - 1, length, -1):
            nodes = np.where(nodes >= self.first[n - 1], self.parent[nodes], nodes)
        return np.where(nodes >= self.first[length - 1], nodes, 0)


def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of ``values`` in a sorted table, -1 for others."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def by_shard(keys: np.ndarray, columns: list[np.ndarray], shards: int) -> Iterator[tuple[int, bytes]]:
    to = shard_of(keys, shards)
    for s in np.unique(to).tolist():
        mine = to == s
        yield s, bundle([pack_sorted(keys[mine]), *(pack(c[mine]) for c in columns)])


def frequent(asked: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys whose counts add up to ``least``, sorted, with the sums, and how many keys there are.

    At most (all counts) / ``least`` keys come back.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [unbundle(a) for a in table.column("ask").to_pylist()]
        keys, place = np.unique(np.concatenate([unpack_sorted(k) for k, _ in parts]), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, place, np.concatenate([unpack(c) for _, c in parts]).astype(np.int64))
        much = n >= least
        return pa.table({"key": np.append(keys[much].view(np.int64), 0), "n": np.append(n[much], len(keys)),
                         "whole": np.append(np.zeros(int(much.sum()), bool), True)})

    found = asked.groupBy("shard").applyInArrow(run, "key long, n long, whole boolean").toPandas()
    whole = found["whole"].to_numpy(bool)
    keys, n = found["key"].to_numpy(np.int64), found["n"].to_numpy(np.int64)  # no nulls: whole numbers stay whole
    order = np.argsort(keys[~whole].view(np.uint64))
    return keys[~whole].view(np.uint64)[order], n[~whole][order], int(n[whole].sum())


def candidates(blocks: DataFrame, params: SuffixTree) -> Tree:
    """The tree of all contexts that are frequent enough, none of them retained yet."""
    sizes = blocks.agg(F.sum("n_train"), F.sum("n_texts"), F.sum("n_tokens")).first()
    tokens, texts, total = (int(x or 0) for x in sizes)
    least = max(params.least_count, int(np.ceil(params.least_share * tokens)))
    shards = shards_for(total, 4 * params.shard)  # words, far fewer than tokens
    payloads = blocks.select("block", "payload")

    def words(row: dict) -> Iterator[tuple[int, bytes]]:
        block = Block(row["payload"])
        n = np.bincount(block.ids[block.in_train], minlength=len(block.words))
        return by_shard(block.words[n > 0], [n[n > 0]], shards)

    found, counts, symbols = frequent(ask_all(payloads, words), least)
    is_word = found != END
    found, counts = found[is_word], counts[is_word]
    if texts >= least:
        at = int(np.searchsorted(found, START))
        found, counts = np.insert(found, at, START), np.insert(counts, at, texts)
    tree = Tree(tokens, symbols, found)
    tree.add(np.zeros(len(found), np.int64), counts)
    for length in range(2, params.depth + 1):
        held = blocks.sparkSession.sparkContext.broadcast(tree)

        def longer(row: dict, held=held, length=length) -> Iterator[tuple[int, bytes]]:
            block, tree = Block(row["payload"]), held.value
            steps = tree.words_before(block)
            for _ in range(length):
                older = next(steps)
            node = tree.nodes(block, length - 1)
            far = block.in_train & (node > 0) & (older >= 0)
            keys, n = np.unique(node[far] * tree.width + older[far], return_counts=True)
            return by_shard(keys, [n], shards)

        found, counts, _ = frequent(ask_all(payloads, longer), least)
        keys = found.astype(np.int64)
        tree.keys.append(keys)
        tree.add(keys // tree.width, counts)
    return tree


def entries(block: Block, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block's different (word, state): their words' places and states, in that order,
    their training counts, and per position the entry's number."""
    span = len(tree.count)
    keys, place = np.unique(block.ids * span + tree.states(block), return_inverse=True)
    return keys // span, keys % span, np.bincount(place[block.in_train], minlength=len(keys)), place


def ask_entries(payload: bytes, tree: Tree, shards: int) -> Iterator[tuple[int, bytes]]:
    block = Block(payload)
    word, state, n, _ = entries(block, tree)
    to = shard_of(block.words, shards)
    mine_of = to[word]
    per_word = np.bincount(word, minlength=len(block.words))
    for s in np.unique(to).tolist():
        mine = mine_of == s
        yield s, bundle([pack_sorted(block.words[to == s]), pack(per_word[to == s]), pack(state[mine]), pack(n[mine])])


class Shard:
    """All that blocks say of some words: (word, state) entries with their training counts."""

    def __init__(self, asks: list[bytes], tree: Tree):
        parts = [unbundle(a) for a in asks]
        words = [unpack_sorted(p[0]) for p in parts]
        every = np.concatenate(words)
        self.words, place = np.unique(every, return_inverse=True)
        per_word = np.concatenate([unpack(p[1]) for p in parts]).astype(np.int64)
        span = len(tree.count)
        keys = np.repeat(place, per_word) * span + np.concatenate([unpack(p[2]) for p in parts]).astype(np.int64)
        unique, self.place = np.unique(keys, return_inverse=True)
        self.word, self.state = unique // span, unique % span
        self.n = np.zeros(len(unique), np.int64)
        np.add.at(self.n, self.place, np.concatenate([unpack(p[3]) for p in parts]).astype(np.int64))
        self.word_n = np.zeros(len(self.words), np.int64)
        np.add.at(self.word_n, self.word, self.n)
        self.word_place, self.words_by_ask, self.entries_by_ask = place, [len(w) for w in words], [int(unpack(p[1]).sum()) for p in parts]

    def level(self, tree: Tree, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which entries have a context of ``length`` words, its node, and c(context word)."""
        node = tree.ancestor(self.state, length)
        deep = np.flatnonzero(node)
        _, place = np.unique(self.word[deep] * len(tree.count) + node[deep], return_inverse=True)
        n = np.zeros(len(place), np.int64)
        np.add.at(n, place, self.n[deep])
        return deep, node[deep], n[place] if len(place) else n

    def probabilities(self, tree: Tree, length: int) -> np.ndarray:
        """P(word | state) of every entry, with contexts of up to ``length`` words."""
        p = (self.word_n[self.word] + 1) / (tree.tokens + tree.symbols + 1)
        for n in range(1, length + 1):
            deep, node, count = self.level(tree, n)
            kept = np.isfinite(tree.strength[node])
            deep, node, count = deep[kept], node[kept], count[kept]
            m = tree.strength[node]
            p[deep] = (count + m * p[deep]) / (tree.count[node] + m)
        return p

    def gains(self, tree: Tree, length: int, strengths: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of ``length`` words and, by strength, their leave-one-out gains over their suffixes."""
        p = self.probabilities(tree, length - 1)
        deep, node, count = self.level(tree, length)
        _, first = np.unique(self.word[deep] * len(tree.count) + node, return_index=True)
        first = first[count[first] > 0]
        node, count, p = node[first], count[first], p[deep[first]]
        nodes, place = np.unique(node, return_inverse=True)
        out = np.zeros((len(strengths), len(nodes)))
        for i, m in enumerate(strengths):
            other = (count - 1 + m * p) / (tree.count[node] - 1 + m)
            out[i] = np.bincount(place, count * np.log(other / p), minlength=len(nodes))
        return nodes, np.rint(out * NATS).astype(np.int64)


def gains_of(held, length: int, strengths: tuple[float, ...]):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asks in batch.column(0):
                nodes, gains = Shard(unbundle(asks.as_py()), held.value).gains(held.value, length, strengths)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), *map(pa.array, gains)],
                                                 names=["node", *(f"g{i}" for i in range(len(gains)))])

    return run


def retain(asked: DataFrame, tree: Tree, params: SuffixTree) -> None:
    """The divergence test, one context length after another; sets the strengths of ``tree``."""
    spark, strengths = asked.sparkSession, params.strengths
    for length in range(1, params.depth + 1):
        run = gains_of(spark.sparkContext.broadcast(tree), length, strengths)
        names = [f"g{i}" for i in range(len(strengths))]
        found = (asked.select("asks").mapInArrow(run, "node long, " + ", ".join(f"{c} long" for c in names))
                 .groupBy("node").agg(*[F.sum(c).alias(c) for c in names]).toPandas())  # one row per candidate at most
        nodes, gains = found["node"].to_numpy(np.int64), found[names].to_numpy(np.int64) / NATS
        best = gains.argmax(axis=1) if len(nodes) else np.zeros(0, np.int64)
        gain = gains[np.arange(len(nodes)), best]
        kept = gain > params.least_gain * tree.count[nodes]
        tree.strength[nodes[kept]] = np.array(strengths)[best[kept]]


def learn(blocks: DataFrame, params: SuffixTree) -> tuple[Tree, DataFrame, int]:
    """The tree, what blocks ask of shards (a written table), and the number of shards."""
    tree = candidates(blocks, params)
    shards = shards_for(blocks.agg(F.sum("n_tokens")).first()[0] or 0, params.shard)
    held = blocks.sparkSession.sparkContext.broadcast(tree)
    asked = settle(gather_all(ask_all(blocks.select("block", "payload"),
                                      lambda row: ask_entries(row["payload"], held.value, shards)), shards))
    retain(asked, tree, params)
    return tree, asked, shards


def contexts(tree: Tree) -> list[tuple[tuple[int, ...], int, float]]:
    """The retained contexts: hashes of their words, oldest first, occurrences and strength."""
    out = []
    for node in np.flatnonzero(np.isfinite(tree.strength[1:])) + 1:
        words, at = [], int(node)
        for length in range(len(tree.first) - 1, 1, -1):
            if at >= tree.first[length - 1]:
                words.append(int(tree.words[tree.keys[length - 2][at - tree.first[length - 1]] % tree.width]))
                at = int(tree.parent[at])
        out.append(((*words, int(tree.words[at - 1])), int(tree.count[node]), float(tree.strength[node])))
    return out


def score(docs: DataFrame, train: Column, text: str = "text", doc_id: str = "doc_id",
          params: SuffixTree = SuffixTree()) -> DataFrame:
    """Learn from the rows where ``train`` holds and score all: ``doc_id``, ``train``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    blocks = word_blocks(rows, params)
    tree, asked, shards = learn(blocks, params)
    held = docs.sparkSession.sparkContext.broadcast(tree)

    def answer(asks: list[bytes]) -> list[bytes]:
        shard = Shard(asks, held.value)
        logs = np.log10(shard.probabilities(held.value, params.depth)).astype(np.float32)[shard.place]
        counts = shard.word_n[shard.word_place]
        logs = np.split(logs, np.cumsum(shard.entries_by_ask)[:-1])
        counts = np.split(counts, np.cumsum(shard.words_by_ask)[:-1])
        return [bundle([pack(n), pack(p.view(np.uint32))]) for n, p in zip(counts, logs, strict=True)]

    schema = T.StructType([rows.schema["doc_id"], T.StructField("train", T.BooleanType())]
                          + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
                          + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")])
    id_type = _arrow_type(schema["doc_id"].dataType)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                block, tree = Block(row["payload"]), held.value
                word, _, _, place = entries(block, tree)
                to = shard_of(block.words, shards)
                counts, logs = np.zeros(len(block.words), np.int64), np.zeros(len(word))
                for r in row["replies"]:
                    n, p = map(unpack, unbundle(r["reply"]))
                    counts[to == r["shard"]] = n.astype(np.int64)
                    logs[to[word] == r["shard"]] = p.astype(np.uint32).view(np.float32)
                base = np.log10((counts + 1) / (tree.tokens + tree.symbols + 1))
                total = lambda x: np.add.reduceat(x, block.begins)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], id_type), pa.array(block.train), pa.array(block.sizes),
                    pa.array(total((counts > 0)[block.ids].astype(np.int64))), pa.array(np.full(len(block.sizes), tree.tokens)),
                    pa.array(total(base[block.ids])), pa.array(total(logs[place]))], names=schema.names)

    answered = with_replies(blocks.select("block", "ids", "payload"), answer_gathered(asked, answer))
    return answered.select("ids", "payload", "replies").mapInArrow(finish, schema)
