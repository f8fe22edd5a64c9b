"""Alignment of two tokenizers over the same texts by lockstep merging.

Space + text is encoded by tokenizer A (byte-level BPE) and text by tokenizer B
(sentencepiece, which adds the space). One vector holds a pair of pointers for each
document of a block; every step links the two tokens that each pair points at, then
advances whichever ends first, both at a common end, which is a cut. Finished
documents leave the vector. A long document enters as several lanes, which begin
where both tokenizers must have a cut.

Encoding: a single space between a visible ASCII or Latin character and a letter or digit
begins a token of both tokenizers, so texts are taken apart there, and each different
part of a block is encoded once. (A's pattern begins a match at such a space; no piece
of B holds a space after another character, which loading checks.) New parts are encoded
many at a time, with such spaces between them, and taken apart again by byte lengths,
which come from the vocabularies; those whose bytes don't come back so are encoded one by one.

Counts: how many documents hold an id pair linked is added up in shards of the pairs
(see ``blocks``); the highest count of an A id is one number per entry of A's
vocabulary, which bounds what is broadcast.

Nulls: a null or empty text, and one whose tokens do not give back its bytes, has no
tokens: all numbers are 0 and the digest is ''. Repeated rows are documents of their own
and count each; the counts of ties are equal, so ties are all best. An empty table gives no
rows. Only ``doc_id`` and ``text`` are read, so other columns can't clash.

The vocabulary files must be readable under ``folder`` on every executor.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import (answer_all, ask_all, blocks_of, bundle, pack, pack_sorted, shard_of, shards_for, unbundle, unpack,
                     unpack_sorted, with_replies)
from .common import _arrow_type, settle

#: A space before which both tokenizers begin a token.
_PARTS = re.compile(r"(?<=[!-~À-ɏ]) (?=[0-9A-Za-zÀ-ɏ])")
_LATIN = {chr(c) for c in range(0xC0, 0x250)}
_BEFORE = frozenset(map(chr, range(0x21, 0x7F))) | _LATIN
_AFTER = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _LATIN
SEPARATORS = (b",", b"|", b";")
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@dataclass(frozen=True)
class Alignment:
    folder: str = "/opt/tokenizers"
    a_file: str = "byte_bpe_50k.json"
    b_file: str = "piece_bpe_32k.model"
    block: int = 8 << 20          # bytes of text that one vector takes
    lane: int = 1024              # parts of a document in one lane
    shard: int = 1 << 21          # pair entries in one shard
    held_parts: int = 400_000     # encoded parts that a task keeps between blocks
    held_bytes: int = 64 << 20
    joined: int = 64              # parts encoded as one text


class Ragged:
    """Rows of numbers, end to end."""

    def __init__(self):
        self.values, self.sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]

    def add(self, values: list, sizes: list | np.ndarray) -> None:
        self.values.append(np.array(values, np.int32))
        self.sizes.append(np.array(sizes, np.int32))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        self.values, self.sizes = [np.concatenate(self.values)], [np.concatenate(self.sizes)]
        return self.values[0], self.sizes[0]


class Encoder:
    """Both tokenizers, and the parts encoded so far."""

    def __init__(self, params: Alignment):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.params = params
        self.a = Tokenizer.from_file(os.path.join(params.folder, params.a_file))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(params.folder, params.b_file))
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.n_a
        for entry, n in self.a.get_vocab().items():
            self.a_bytes[n] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.b_bytes = [piece_bytes(p) for p in self.b.id_to_piece(list(range(self.n_b)))]
        # the leading spaces aside, a piece with a space would cross the places where texts are cut
        self.whole = any(b" " in p.lstrip(b" ") for p in self.b_bytes)
        self.a_len = np.fromiter(map(len, self.a_bytes), np.int64, self.n_a)
        self.b_len = np.fromiter(map(len, self.b_bytes), np.int64, self.n_b)
        texts = [b"%d%s" % (n, s) for n in range(max(self.n_a, self.n_b)) for s in SEPARATORS]
        self.written = np.empty(len(texts), object)
        self.written[:] = texts
        self.forget()

    def forget(self) -> None:
        self.known = defaultdict(count().__next__)  # numbers for parts in order of their first use
        self.ids_a, self.ids_b, self.good, self.bytes = Ragged(), Ragged(), [], 0

    def codes(self, texts: list) -> list[np.ndarray]:
        """Per text the numbers of its parts, all of them encoded."""
        if len(self.known) > self.params.held_parts or self.bytes > self.params.held_bytes:
            self.forget()
        begun = len(self.known)
        out = []
        for raw in texts:
            text = raw.decode("utf-8", "replace") if raw else ""
            parts = [] if not text else [text] if self.whole else _PARTS.split(text)
            out.append(np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts)))
        fresh = list(islice(self.known, begun, None))
        for at in range(0, len(fresh), 20_000):
            self._encode(fresh[at:at + 20_000], 1 if self.whole else self.params.joined)
        return out

    def _encode(self, parts: list[str], most: int) -> None:
        """Adds the tokens of ``parts``, up to ``most`` encoded as one text."""
        runs = list(runs_of(parts, most))
        texts = [" ".join(run) for run in runs]
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        for run, text, x, y in zip(runs, texts, (e.ids for e in a), b, strict=True):
            raw = (" " + text).encode()
            good = b"".join(map(self.a_bytes.__getitem__, x)) == raw and b"".join(map(self.b_bytes.__getitem__, y)) == raw
            if len(run) == 1:
                sizes = [len(x)], [len(y)]
            elif good:
                ends = np.cumsum([len(p.encode()) + 1 for p in run])
                sizes = sizes_in(ends, self.a_len[x]), sizes_in(ends, self.b_len[y])
            else:
                sizes = None, None
            if sizes[0] is None or sizes[1] is None:
                self._encode(run, 1)
                continue
            self.good += [good] * len(run)
            self.bytes += len(raw)
            self.ids_a.add(x, sizes[0])
            self.ids_b.add(y, sizes[1])


def runs_of(parts: list[str], most: int) -> Iterator[list[str]]:
    """``parts`` in order, up to ``most`` at a time that a space between them would part again."""
    run: list[str] = []
    for part in parts:
        if run and (len(run) == most or run[-1][-1] not in _BEFORE or part[0] not in _AFTER):
            yield run
            run = []
        run.append(part)
    if run:
        yield run


def sizes_in(ends: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
    """How many tokens of these byte lengths each part takes; None if a part's end is no token's."""
    token_ends = np.cumsum(lengths)
    last = np.searchsorted(token_ends, ends)
    return np.diff(last, prepend=-1) if (token_ends[last] == ends).all() else None


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1
    ones for themselves, the others in order from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def gather(values: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``codes`` of a ragged table end to end, and their sizes."""
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    n = sizes[codes].astype(np.int64)
    total = int(n.sum())
    at = np.arange(total) + np.repeat(starts[codes] - (np.cumsum(n) - n), n)
    return values[at].astype(np.int64), n


def lockstep(end_a: np.ndarray, end_b: np.ndarray, ia: np.ndarray, ib: np.ndarray,
             stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (the A and B token that end there).

    ``ia``, ``ib``: each lane's first tokens; ``stop``: one past its last A token; ends
    are byte offsets that grow over all lanes.
    """
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(ia):
        links_a.append(ia)
        links_b.append(ib)
        a, b = end_a[ia], end_b[ib]
        both = a == b
        cuts_a.append(ia[both])
        cuts_b.append(ib[both])
        ia = ia + (a <= b)
        ib = ib + (b <= a)
        live = ia < stop
        if not live.all():
            ia, ib, stop = ia[live], ib[live], stop[live]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (links_a, links_b, cuts_a, cuts_b))


@dataclass
class Aligned:
    """Tokens, links and groups of a block; rows of tokens lie end to end by document."""
    ids_a: np.ndarray
    ids_b: np.ndarray
    n_a: np.ndarray        # by document
    n_b: np.ndarray
    links_a: np.ndarray    # token numbers in the block
    links_b: np.ndarray
    cut_a: np.ndarray      # by token: its end is a cut
    cut_b: np.ndarray


def align_texts(encoder: Encoder, texts: list) -> Aligned:
    codes = encoder.codes(texts)
    values_a, sizes_a = encoder.ids_a.joined()
    values_b, sizes_b = encoder.ids_b.joined()
    good = np.array(encoder.good, bool)
    codes = [c if good[c].all() else c[:0] for c in codes]
    n_parts = np.fromiter(map(len, codes), np.int64, len(codes))
    flat = np.concatenate([np.zeros(0, np.int64), *codes])
    ids_a, part_a = gather(values_a, sizes_a, flat)
    ids_b, part_b = gather(values_b, sizes_b, flat)
    first_a = np.concatenate(([0], np.cumsum(part_a)))  # by part
    first_b = np.concatenate(([0], np.cumsum(part_b)))
    ends = np.cumsum(n_parts)
    begins = ends - n_parts
    lane = encoder.params.lane
    lanes = np.concatenate([np.zeros(0, np.int64), *(np.arange(s, e, lane) for s, e in zip(begins, ends, strict=True))])
    stops = np.concatenate((lanes[1:], [len(flat)])).astype(np.int64) if len(lanes) else lanes
    links_a, links_b, at_a, at_b = lockstep(np.cumsum(encoder.a_len[ids_a]), np.cumsum(encoder.b_len[ids_b]),
                                            first_a[lanes], first_b[lanes], first_a[stops])
    cut_a, cut_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    cut_a[at_a] = True
    cut_b[at_b] = True
    return Aligned(ids_a, ids_b, first_a[ends] - first_a[begins], first_b[ends] - first_b[begins],
                   links_a, links_b, cut_a, cut_b)


def digests(found: Aligned, written: np.ndarray) -> list[str]:
    """SHA-256 of each document's groups, ``a1,a2|b1;a3|b2,b3``."""
    group_a = np.cumsum(found.cut_a) - found.cut_a
    group_b = np.cumsum(found.cut_b) - found.cut_b
    ends_a = np.flatnonzero(found.cut_a) + 1  # by group
    ends_b = np.flatnonzero(found.cut_b) + 1
    codes = np.empty(len(group_a) + len(group_b), np.int64)
    starts_b = np.concatenate(([0], ends_b))
    codes[np.arange(len(group_a)) + starts_b[group_a]] = found.ids_a * 3 + found.cut_a
    codes[np.arange(len(group_b)) + ends_a[group_b]] = found.ids_b * 3 + 2 * found.cut_b
    stops = np.cumsum(found.n_a + found.n_b)
    return [hashlib.sha256(b"".join(written[codes[e - n:e]].tolist())[:-1]).hexdigest() if n else ""
            for e, n in zip(stops.tolist(), (found.n_a + found.n_b).tolist(), strict=True)]


def link_entries(found: Aligned, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document its different id pairs (A id * n_b + B id), sorted, how often each is
    linked, and the number of different pairs by document."""
    docs = len(found.n_a)
    doc = np.searchsorted(np.cumsum(found.n_a), found.links_a, side="right")
    pair = found.ids_a[found.links_a] * n_b + found.ids_b[found.links_b]
    span = int(pair.max()) + 1 if len(pair) else 1
    key, times = np.unique(doc * span + pair, return_counts=True)
    return key % span, times, np.bincount(key // span, minlength=docs)


def block_row(encoder: Encoder, ids: list, texts: list, number: int, id_type: pa.DataType) -> pa.RecordBatch:
    found = align_texts(encoder, texts)
    pair, times, by_doc = link_entries(found, encoder.n_b)
    unique, place = np.unique(pair, return_inverse=True)
    n_links = np.bincount(np.searchsorted(np.cumsum(found.n_a), found.links_a, side="right"), minlength=len(texts))
    done_a = np.concatenate(([0], np.cumsum(found.cut_a)))
    last = np.cumsum(found.n_a)
    n_groups = done_a[last] - done_a[last - found.n_a]
    holders = np.bincount(place, minlength=len(unique))
    payload = bundle([pack(x) for x in (found.n_a, found.n_b, n_groups, n_links)]
                     + [pack_sorted(unique), pack(place), pack(times), pack(by_doc)])
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([digests(found, encoder.written)]),
        pa.array([payload], pa.binary()), pa.array([bundle([pack_sorted(unique), pack(holders)])], pa.binary()),
        pa.array([len(unique)], pa.int64())], names=["block", "ids", "sha", "payload", "pairs", "n_pairs"])


def encoded_blocks(docs: DataFrame, params: Alignment) -> DataFrame:
    """A written table of blocks from (doc_id, text)."""
    id_type = _arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(params)
        for others, texts in blocks_of(batches, 1, params.block):
            yield block_row(encoder, [o[0] for o in others], texts, uuid.uuid4().int >> 65, id_type)

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
                           T.StructField("sha", T.ArrayType(T.StringType())), T.StructField("payload", T.BinaryType()),
                           T.StructField("pairs", T.BinaryType()), T.StructField("n_pairs", T.LongType())])
    return settle(docs.mapInArrow(run, schema))


def count_pairs(asks: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A shard's pairs, the documents that hold each, and each block's pairs."""
    asked = [unbundle(a) for a in asks]
    pairs = [unpack_sorted(p) for p, _ in asked]
    unique, place = np.unique(np.concatenate(pairs), return_inverse=True)
    held = np.zeros(len(unique), np.int64)
    np.add.at(held, place, np.concatenate([unpack(n) for _, n in asked]).astype(np.int64))
    return unique, held, pairs


def align(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", params: Alignment = Alignment()) -> DataFrame:
    """Per document its tokens, groups and links, with the links judged corpus-wide:
    ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sizes = Encoder(params)
    n_a, n_b = sizes.n_a, sizes.n_b
    blocks = encoded_blocks(docs, params)
    shards = shards_for(blocks.agg(F.sum("n_pairs")).first()[0] or 0, params.shard)

    def questions(row: dict) -> Iterator[tuple[int, bytes]]:
        pairs, held = (f(x) for f, x in zip((unpack_sorted, unpack), unbundle(row["pairs"]), strict=True))
        to = shard_of(pairs, shards)
        for s in np.unique(to).tolist():
            yield s, bundle([pack_sorted(pairs[to == s]), pack(held[to == s])])

    def answer(asks: list[bytes]) -> list[bytes]:
        unique, held, pairs = count_pairs(asks)
        highest = np.zeros(n_a, np.int64)
        np.maximum.at(highest, (unique // np.uint64(n_b)).astype(np.int64), held)
        return [bundle([pack(held[np.searchsorted(unique, p)]), pack(highest) if i == 0 else b""])
                for i, p in enumerate(pairs)]

    replies = settle(answer_all(ask_all(blocks.select("block", "pairs"), questions), answer))
    best = spark.sparkContext.broadcast(highest_counts(replies, n_a))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(c, T.LongType()) for c in NUMBERS]
                          + [T.StructField("groups_sha256", T.StringType())])
    id_type = _arrow_type(schema["doc_id"].dataType)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}
                given = {r["shard"]: r["reply"] for r in row["replies"].as_py() or ()}
                columns = judged(row["payload"].as_py(), given, best.value, shards, n_b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"].as_py(), id_type), *(pa.array(c, pa.int64()) for c in columns),
                     pa.array(row["sha"].as_py(), pa.string())], names=schema.names)

    return with_replies(blocks.select("block", "ids", "sha", "payload"), replies).select("ids", "sha", "payload", "replies").mapInArrow(finish, schema)


def highest_counts(replies: DataFrame, n_a: int) -> np.ndarray:
    """Per A id the highest count of its pairs: the shards' own, combined to one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = np.zeros(n_a, np.int64)
        for batch in batches:
            for reply in batch.column(0).to_pylist():
                own = unbundle(reply)[1]
                if own:
                    high = np.maximum(high, unpack(own).astype(np.int64))
        seen = np.flatnonzero(high)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(high[seen], pa.int64())], names=["a", "n"])

    out = np.zeros(n_a, np.int64)
    for r in replies.select("reply").mapInArrow(run, "a long, n long").groupBy("a").agg(F.max("n").alias("n")).collect():
        out[r["a"]] = r["n"]  # one row per entry of A's vocabulary at most
    return out


def judged(payload: bytes, given: dict[int, bytes], best: np.ndarray, shards: int, n_b: int) -> list[np.ndarray]:
    n_a, n_b_, n_groups, n_links, unique, place, times, by_doc = unbundle(payload)
    unique, place, times, by_doc = unpack_sorted(unique), unpack(place).astype(np.int64), unpack(times).astype(np.int64), unpack(by_doc).astype(np.int64)
    to = shard_of(unique, shards)
    count = np.zeros(len(unique), np.int64)
    for s, reply in given.items():
        count[to == s] = unpack(unbundle(reply)[0]).astype(np.int64)
    is_best = count == best[(unique // np.uint64(n_b)).astype(np.int64)]
    stops = np.cumsum(by_doc)
    total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], stops))])
    return [unpack(x).astype(np.int64) for x in (n_a, n_b_, n_groups, n_links)] + [
        total(times * is_best[place]), total(times * count[place])]


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", params: Alignment = Alignment()) -> DataFrame:
    """The alignment itself: ``doc_id`` and ``groups``, an array of the A and B ids between cuts."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = _arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(params)
        for others, texts in blocks_of(batches, 1, params.block):
            found = align_texts(encoder, texts)
            sides = [pa.ListArray.from_arrays(np.concatenate(([0], np.flatnonzero(cut) + 1)).astype(np.int32), pa.array(ids, pa.int32()))
                     for ids, cut in ((found.ids_a, found.cut_a), (found.ids_b, found.cut_b))]
            done = np.concatenate(([0], np.cumsum(found.cut_a)))
            borders = done[np.concatenate(([0], np.cumsum(found.n_a)))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in others], id_type),
                pa.ListArray.from_arrays(borders, pa.StructArray.from_arrays(sides, ["a", "b"]))], names=["doc_id", "groups"])

    kind = T.ArrayType(T.StructType([T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType()))]))
    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("groups", kind)]))
