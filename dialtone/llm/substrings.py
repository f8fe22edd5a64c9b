"""Removal of repeated substrings of ``length`` bytes, exactly, by suffix sorting.

A byte goes if a ``length``-byte string that covers it starts at two places or more,
in one document or several; strings are judged on the input. Matches never cross
documents.

1. Anchors. Of every ``length``-byte string the leftmost least of the hashes of its
   ``anchor``-byte parts marks one position. Equal strings mark the same place in
   themselves, so only strings around anchors with an equal hash can be equal. About
   two in ``length - anchor + 2`` positions are anchors; they are all that is shuffled.
2. Contexts. All strings marked by an anchor lie within the ``length - anchor`` bytes
   before it and the ``length`` bytes from it. Anchors carry a hash of that context
   (two independent 64-bit hashes tell contexts apart). A context that occurs twice is
   covered whole, whatever else. Anchors whose hash stands alone fall out.
3. Suffix sort. Of the other contexts, one of each kind is fetched from the text. Within
   a group of one anchor hash the strings that start at each offset are suffixes of the
   contexts. They are put in order by a mergesort that compares two suffixes with prefix
   polynomial hashes: a binary search finds the common extension, the next byte decides.
   Neighbours with a common extension of ``length`` bytes are verified byte by byte.
   Suffixes whose hash nobody shares cannot have an equal and are left out beforehand.
4. The covered ranges go back to their documents, which are cut.

Scale: one scan and one shuffle of the texts (both joins with the texts use the same
exchange); what is shuffled beside are anchors, 40 bytes each, which are found twice (to
count their hashes, and to keep those that occur again). A group of more than ``hot``
different contexts of one anchor hash is dealt out anew in ``slices``: a slice has the
strings that reach nearly equally far to the left, so they share a longer part than the
anchor; its hash is the slice's group, and of a context it gets the bytes it needs. No
more than ``crowd`` contexts of one anchor hash are ever sorted in one task: beyond that
their strings go singly, as 128-bit digests that Spark counts, combined before the
shuffle, and joins back, which it can split at any size.

Nulls and empty texts have no strings: nothing is removed. Repeated rows cover each
other whole, if they have ``length`` bytes. Rows are told apart by 128-bit hashes of id
and text; equal rows get equal results. Input columns named like a result give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, utf8

_BASE = np.uint64(0x9E3779B97F4A7C15)      # odd: powers have inverses modulo 2**64
_PLACE_BITS = 24                            # a chunk has fewer bytes than 2 ** 24
_OTHER = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    anchor: int = 100
    chunk: int = 1 << 20        # bytes handled at once
    hot: int = 2_000
    slices: int = 4
    crowd: int = 50_000


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64."""
    out = np.full(max(1, n), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHash:
    """Polynomial hashes of all prefixes; equal pieces anywhere have equal hashes."""

    def __init__(self, data: np.ndarray, base: np.uint64 = _BASE):
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data))[:len(data)], out=self.prefix[1:])
        self.scale = powers(np.uint64(pow(int(base), -1, 1 << 64)), len(data) + 1)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.scale[start]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of a polynomial hash, whose low bits follow the low bits of bytes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


# --- anchors -----------------------------------------------------------------

def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` neighbouring values (by blocks, two passes)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors_of(texts: list[bytes], params: Repeats) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, position, anchor hash, context hash) of all anchors, in chunks."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0
    reach = params.length - params.anchor
    for i, raw in enumerate(texts):
        if len(raw) < params.length:
            continue
        if len(raw) <= params.chunk:
            held.append((i, 0, len(raw) - params.length + 1, raw))
            size += len(raw)
            if size >= params.chunk:
                yield _anchors(held, params)
                held, size = [], 0
            continue
        last = np.empty(0, np.int64)   # a long text in pieces: strings that start in [a, b)
        for a in range(0, len(raw) - params.length + 1, params.chunk):
            b = min(a + params.chunk, len(raw) - params.length + 1)
            low = max(0, a - reach)
            piece = raw[low:b + 2 * params.length]
            number, at, h, c = _anchors([(i, a - low, b - low, piece)], params)
            fresh = ~np.isin(at + low, last)
            yield number[fresh], (at + low)[fresh], h[fresh], c[fresh]
            last = at + low
    if held:
        yield _anchors(held, params)


def _anchors(pieces: list[tuple[int, int, int, bytes]], params: Repeats) -> tuple[np.ndarray, ...]:
    """For (number, first start, end of starts, bytes) of each piece."""
    length, k = params.length, params.anchor
    data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
    sizes = np.array([len(p[3]) for p in pieces])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    hashes = PrefixHash(data)
    parts = mixed(hashes.of(np.arange(len(data) - k + 1), k))
    # the hash's upper bits, then the position: the least is the leftmost of equal hashes
    bits = np.uint64(_PLACE_BITS)
    keyed = (parts >> bits << bits) | np.arange(len(parts), dtype=np.uint64)
    least = sliding_least(keyed, length - k + 1)
    starts = np.concatenate([np.arange(b + p[1], b + p[2]) for b, p in zip(begins, pieces, strict=True)])
    at = np.unique((least[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))
    owner = np.searchsorted(begins, at, side="right") - 1
    low = np.maximum(begins[owner], at - (length - k))
    high = np.minimum(begins[owner] + sizes[owner], at + length)
    other = PrefixHash(data, _OTHER)
    context = mixed(other.of(low, high - low) + (at - low).astype(np.uint64) * _BASE + (high - at).astype(np.uint64) * _OTHER)
    number = np.array([p[0] for p in pieces])[owner]
    return number, at - begins[owner], parts[at], context


# --- suffix sort --------------------------------------------------------------

def common_extension(hashes: PrefixHash, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, up to ``most``: binary search."""
    whole = hashes.of(a, most) == hashes.of(b, most)
    low = np.where(whole, most, 0)
    left = np.flatnonzero(~whole)
    if len(left):
        x, y = a[left], b[left]
        lo, hi = np.zeros(len(left), np.int64), np.full(len(left), most - 1)
        for _ in range(int(most).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = hashes.of(x, mid) == hashes.of(y, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        low[left] = lo
    return low


def not_after(data: np.ndarray, hashes: PrefixHash, a: np.ndarray, b: np.ndarray, most: int, strictly: bool) -> np.ndarray:
    """Whether the suffix at ``a`` comes before that at ``b``, or (not ``strictly``) is equal."""
    shared = common_extension(hashes, a, b, most)
    same = shared == most
    i = np.where(same, 0, shared)
    before = data[a + i] < data[b + i]
    return np.where(same, not strictly, before)


def suffix_sort(data: np.ndarray, hashes: PrefixHash, starts: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """``starts`` in suffix order within each ``group`` (groups stand together): a natural
    mergesort. All merges of a round run at once: every suffix finds its rank in the
    neighbouring run by binary search."""
    order = starts.copy()
    n = len(order)
    if n < 2:
        return order
    run = np.ones(n, bool)
    run[1:] = (group[1:] != group[:-1]) | ~not_after(data, hashes, order[:-1], order[1:], most, False)
    while True:
        heads = np.flatnonzero(run)
        ends = np.append(heads[1:], n)
        of_group = group[heads]
        first = np.searchsorted(of_group, of_group, side="left")
        odd = (np.arange(len(heads)) - first) % 2 == 1         # merges into the run before it
        if not odd.any():
            return order
        right = np.flatnonzero(odd)
        which = np.cumsum(run) - 1                              # run of each suffix
        other = np.full(len(heads), -1)
        other[right], other[right - 1] = right - 1, right
        at = np.flatnonzero(other[which] >= 0)
        mine, theirs = which[at], other[which[at]]
        is_right = odd[mine]
        lo, hi = heads[theirs].copy(), ends[theirs].copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            theirs_, own = order[mid], order[at[open_]]
            # stable: suffixes of the left run precede equal ones of the right
            ahead = np.where(is_right[open_], not_after(data, hashes, theirs_, own, most, False),
                             not_after(data, hashes, theirs_, own, most, True))
            lo[open_] = np.where(ahead, mid + 1, lo[open_])
            hi[open_] = np.where(ahead, hi[open_], mid)
        base = np.where(is_right, heads[theirs], heads[mine])
        place = base + (at - heads[mine]) + (lo - heads[theirs])
        merged = order.copy()
        merged[place] = order[at]
        order = merged
        run[heads[right]] = False


def repeated_strings(contexts: list[bytes], offsets: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset from the anchor) of all strings that another context of the group has
    at the same offset. ``offsets``: where the anchor stands in each context."""
    sizes = np.array([len(c) for c in contexts])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    data = np.frombuffer(b"".join(contexts), np.uint8)
    hashes = PrefixHash(data)
    counts = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(contexts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    shift = start - offsets[owner]
    start = start + begins[owner]
    whole = hashes.of(start, length)
    order = np.lexsort((whole, shift, group[owner]))
    owner, start, shift, whole = owner[order], start[order], shift[order], whole[order]
    key = np.zeros(len(order), bool)
    if len(order):
        key[1:] = (group[owner[1:]] != group[owner[:-1]]) | (shift[1:] != shift[:-1])
    twin = ~key[1:] & (whole[1:] == whole[:-1])
    some = np.zeros(len(order), bool)
    some[1:] |= twin
    some[:-1] |= twin
    keys = np.cumsum(key)[some]
    start, owner, shift = start[some], owner[some], shift[some]
    ordered = suffix_sort(data, hashes, start, keys, length)
    back = np.argsort(start, kind="stable")
    back = back[np.searchsorted(start[back], ordered)]          # places of the sorted suffixes before the sort
    a, b = ordered[:-1], ordered[1:]
    equal = np.flatnonzero((keys[1:] == keys[:-1]) & (hashes.of(a, length) == hashes.of(b, length)) if len(a) else np.empty(0, bool))
    if len(equal):
        windows = np.lib.stride_tricks.sliding_window_view(data, length)
        sure = np.concatenate([(windows[a[e]] == windows[b[e]]).all(axis=1)
                               for e in np.array_split(equal, max(1, len(equal) // 20_000))])
        equal = equal[sure]
    hit = np.zeros(len(ordered), bool)
    hit[equal] = True
    hit[equal + 1] = True
    return owner[back[hit]], shift[back[hit]]


# --- Spark ----------------------------------------------------------------------

_KEYS = ["_k1", "_k2"]
FIELDS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
          T.StructField("kept", T.BinaryType())]


def _anchor_rows(docs: DataFrame, params: Repeats) -> DataFrame:
    names = [*_KEYS, "at", "h", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for number, at, h, c in anchors_of([raw or b"" for raw in utf8(batch.column(2))], params):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k[number]) for k in keys), pa.array(at.astype(np.int64)),
                     pa.array(h.view(np.int64)), pa.array(c.view(np.int64))], names=names)

    return docs.mapInArrow(run, "_k1 long, _k2 long, at long, h long, c long")


def _context_rows(texts: DataFrame, wanted: DataFrame, params: Repeats) -> DataFrame:
    """The contexts of ``wanted`` places with the group in which they are compared."""
    reach = params.length - params.anchor
    edges = [reach * i // params.slices for i in range(params.slices + 1)]
    asked = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("at", "h", "alone", "hot")).alias("asked"))
    joined = texts.join(asked, _KEYS)
    names = ["g", *_KEYS, "at", "offset", "alone", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = dict(zip(batch.schema.names, batch.columns, strict=True))
            out: list[list] = [[] for _ in names]
            held = 0
            for k1, k2, raw, asked_ in zip(table["_k1"].to_pylist(), table["_k2"].to_pylist(), utf8(table["text"]),
                                           table["asked"], strict=True):
                for x in asked_.as_py():
                    at = x["at"]
                    pieces = [(x["h"], min(at, reach), raw[max(0, at - reach):at + params.length])]
                    if x["hot"]:   # strings that begin near .. far bytes before the anchor share what is hashed
                        pieces = [(_digest(x["h"], near, raw[at - near:at + params.length - far]), min(at, far),
                                   raw[max(0, at - far):at + params.length - near])
                                  for near, far in zip(edges, edges[1:], strict=False)
                                  if at >= near and at + params.length - far <= len(raw)]
                    for g, offset, context in pieces:
                        for column, v in zip(out, (g, k1, k2, at, offset, x["alone"], context), strict=True):
                            column.append(v)
                        held += len(context)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
                    out, held = [[] for _ in names], 0
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    return joined.mapInArrow(run, "g long, _k1 long, _k2 long, at long, offset int, alone boolean, context binary")


def _digest(h: int, near: int, part: bytes) -> int:
    return int.from_bytes(_named(h, near, part, 8), "little", signed=True)


def _named(h: int, near: int, part: bytes, size: int) -> bytes:
    return hashlib.blake2b(part, digest_size=size, key=f"{h} {near}".encode()).digest()


def _counted(texts: DataFrame, wanted: DataFrame, params: Repeats) -> DataFrame:
    """(key, from, to): the strings around the ``wanted`` places that occur twice at the same
    distance from one anchor hash, each string a row, its digest the key."""
    reach, length = params.length - params.anchor, params.length
    asked = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("at", "h", "alone")).alias("asked"))
    joined = texts.join(asked, _KEYS).select(*_KEYS, "text", "asked")
    names = [*_KEYS, "a", "alone", "s"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, raw, asked_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)),
                                           batch.column(3), strict=True):
                places = asked_.as_py()
                for start in range(0, len(places), 256):
                    rows = [(k1, k2, x["at"] - near, x["alone"], _named(x["h"], near, raw[x["at"] - near:x["at"] - near + length], 16))
                            for x in places[start:start + 256]
                            for near in range(max(0, x["at"] + length - len(raw)), min(reach, x["at"]) + 1)]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    strings = joined.mapInArrow(run, "_k1 long, _k2 long, a long, alone boolean, s binary")
    twice = strings.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s")
    return strings.where("alone").join(twice.hint("merge"), "s").select(*_KEYS, "a", (F.col("a") + length).alias("b"))


def _resolved(contexts: DataFrame, params: Repeats, rows: int = 4000) -> DataFrame:
    """(key, from, to): byte ranges covered by strings that a compared context shares."""
    dealt = contexts.repartition("g").sortWithinPartitions("g")

    def settle_groups(table: pa.Table) -> pa.RecordBatch:
        g = np.array(table.column("g"))
        alone = np.array(table.column("alone"))
        owner, shift = repeated_strings(table.column("context").to_pylist(), np.array(table.column("offset")).astype(np.int64),
                                        g, params.length)
        ours = alone[owner]
        owner, low = owner[ours], np.array(table.column("at"))[owner[ours]] + shift[ours]
        order = np.lexsort((low, owner))
        owner, low = owner[order], low[order]
        begin = np.ones(len(owner), bool)
        begin[1:] = (owner[1:] != owner[:-1]) | (low[1:] > low[:-1] + params.length)
        last = np.append(begin[1:], True)[:len(owner)]
        at = owner[begin]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(np.array(table.column(k))[at]) for k in _KEYS), pa.array(low[begin]), pa.array(low[last] + params.length)],
            names=[*_KEYS, "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, enough = 0, rows
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                held.append(batch.slice(start, rows))
                count += held[-1].num_rows
                if count >= enough:
                    table = pa.Table.from_batches(held).combine_chunks()
                    g = np.array(table.column("g"))
                    cut = int(np.searchsorted(g, g[-1]))       # the last group may go on
                    if cut:
                        yield settle_groups(table.slice(0, cut))
                    held, count = table.slice(cut).to_batches(), table.num_rows - cut
                    enough = max(rows, 2 * count)              # a long group is not searched at every step
        if count:
            yield settle_groups(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, "_k1 long, _k2 long, a long, b long")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Repeats = Repeats()) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (removed byte ranges) and ``kept`` (the
    remaining bytes) of every document."""
    keys = [F.xxhash64(F.col(doc_id), F.col(text)).alias("_k1"), F.xxhash64(F.col(text), F.col(doc_id), F.lit(1)).alias("_k2")]
    texts = docs.select(*keys, F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    found = _anchor_rows(texts.select(*_KEYS, "text"), params)
    # counts are combined before they are shuffled, and joined back: a join's hot side is
    # split at run time, a window's is not
    common = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    places = settle(found.join(common.hint("merge"), "h"))
    variants = places.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n_c"), F.min(F.struct(*_KEYS, "at")).alias("first"))
    several = variants.groupBy("h").agg(F.count(F.lit(1)).alias("n_kinds")).where("n_kinds > 1")
    wanted = settle(variants.join(several.hint("merge"), "h")
                    .select("first.*", "h", (F.col("n_c") == 1).alias("alone"), "n_kinds"))
    sorted_here = wanted.where(F.col("n_kinds") <= params.crowd).withColumn("hot", F.col("n_kinds") > params.hot)
    ranges = _resolved(_context_rows(texts, sorted_here, params), params).unionByName(
        _counted(texts, wanted.where(F.col("n_kinds") > params.crowd), params))
    reach = params.length - params.anchor
    twice = variants.where("n_c > 1").select("h", "c")
    whole = places.join(twice.hint("merge"), ["h", "c"]).select(
        *_KEYS, F.greatest(F.col("at") - reach, F.lit(0)).alias("a"), (F.col("at") + params.length).alias("b"))
    # equal rows find the same ranges: a set, so that every one of them meets each range once
    cuts = whole.unionByName(ranges).groupBy(*_KEYS).agg(F.collect_set(F.struct("a", "b")).alias("_cuts"))
    joined = texts.join(cuts, _KEYS, "left").select("doc_id", "text", "_cuts")
    schema = T.StructType([joined.schema["doc_id"], *FIELDS])
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [cut(raw or b"", given.as_py() or []) for raw, given in zip(utf8(batch.column(1)), batch.column(2), strict=True)]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return joined.mapInArrow(run, schema)


def cut(raw: bytes, ranges: list[dict]) -> tuple[int, int, list[dict], bytes]:
    """The text without the union of the ranges; touching ranges are one span."""
    spans: list[list[int]] = []
    for x in sorted(ranges, key=lambda r: r["a"]):
        a, b = x["a"], min(x["b"], len(raw))
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        elif a < b:
            spans.append([a, b])
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    rest = b"".join(kept)
    return len(raw), len(raw) - len(rest), [{"start": a, "end": b} for a, b in spans], rest
