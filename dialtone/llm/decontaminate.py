"""Benchmark decontamination: one Aho-Corasick automaton over the windows of
normalised test items scans every text once; hits are mapped back to the text.

Normalisation works on UTF-8 bytes: A-Z become a-z, every other byte that is not
a digit, a-z or at least 0x80 parts words. A window is ``window`` consecutive
words of an item; an item of fewer words (but not none) is one window.

The automaton reads words, not letters: every word of the benchmark has a code of a few
characters, each place of the code from an alphabet of its own, so a match begins and
ends with words and no node has many children. Words that the benchmark hasn't share a
code that is in no window. The automaton is built once, on the driver, and broadcast; its
nodes (about 40 bytes each) are bounded by the benchmark's words, and a benchmark that needs
more than ``most_nodes`` is refused with its size, before anything is built.

Nulls: a null text has no words and is clean; a null item has no windows; a null
item id is named "" in the result. An empty benchmark hits nothing. Repeated
documents are judged row by row, repeated items count once per item id. Input
columns named like a result column give way to it. Texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns


@dataclass(frozen=True)
class Decontamination:
    window: int = 13          # words
    share: int = 20           # contaminated: share * hit words >= words
    most_nodes: int = 20_000_000


#: Lower-cases A-Z; bytes that are no word characters become spaces.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))

FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("contaminated", T.BooleanType()),
]


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


UNKNOWN = "\xff"


class Codes:
    """Codes of ``width`` characters for the words of a benchmark."""

    def __init__(self, words: list[bytes]):
        self.width = next(w for w in range(1, 9) if (255 // w) ** w >= len(words))
        size = 255 // self.width
        self.unknown = UNKNOWN * self.width
        self.of = {}
        for n, word in enumerate(words):
            code = ""
            for place in range(self.width):
                n, digit = divmod(n, size)
                code += chr(place * size + digit)
            self.of[word] = code

    def read(self, words: list[bytes]) -> str:
        return "".join([self.of.get(w, self.unknown) for w in words])


@dataclass
class Benchmark:
    codes: Codes
    automaton: object   # None if no item has a word


def build_benchmark(items: list[tuple[str, bytes]], window: int, most_nodes: int) -> Benchmark:
    texts = [(name, words_of(raw)) for name, raw in items]
    codes = Codes(sorted({w for _, words in texts for w in words}))
    nodes = sum(max(1, len(words) - window + 1) * min(window, len(words)) for _, words in texts) * codes.width
    if nodes > most_nodes:
        raise ValueError(f"the benchmark may need {nodes:,} automaton nodes of about 40 bytes, more than most_nodes = {most_nodes:,}; "
                         "raise it, if workers have the memory, or judge the benchmark in parts")
    windows: dict[str, tuple[int, set[str]]] = {}
    for name, words in texts:
        n, text = min(window, len(words)), codes.read(words)
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(text[i * codes.width:(i + n) * codes.width], (n, set()))[1].add(name)
    if not windows:
        return Benchmark(codes, None)
    automaton = ahocorasick.Automaton()
    for text, (n, names) in windows.items():
        automaton.add_word(text, (n, sorted(names)))
    automaton.make_automaton()
    return Benchmark(codes, automaton)


def scan(words: list[bytes], bench: Benchmark) -> tuple[np.ndarray | None, list[str]]:
    """Which words of a text lie in a window (None: none), and the items whose windows occur."""
    if not words or bench.automaton is None:
        return None, []
    found = list(bench.automaton.iter(bench.codes.read(words)))
    if not found:
        return None, []
    ends = np.array([end for end, _ in found]) // bench.codes.width + 1
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, ends - np.array([value[0] for _, value in found]), 1)
    np.add.at(steps, ends, -1)
    names = {name for value in {id(v): v for _, v in found}.values() for name in value[1]}
    return np.cumsum(steps[:-1]) > 0, sorted(names)


def spans_of(raw: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code-point offsets in the text itself."""
    marks = np.frombuffer(raw.translate(_WORDS), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], marks.view(np.int8), [0])))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(points[begins[a]]), "end": int(points[ends[b - 1]])}
            for a, b in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True)]


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", params: Decontamination = Decontamination()) -> DataFrame:
    """``docs`` with words, hit words, items with occurring windows, hit spans and the verdict."""
    spark = docs.sparkSession
    bench = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"),
                         F.col(item_text).cast("binary").alias("raw")).where(F.col("raw").isNotNull())
    # a window has a node per word at least, a word a byte and a gap at least
    size = bench.agg(F.sum(F.length("raw"))).first()[0] or 0
    if size > 16 * params.most_nodes:
        raise ValueError(f"the benchmark has {size:,} bytes, too many for most_nodes = {params.most_nodes:,}")
    held = spark.sparkContext.broadcast(build_benchmark(
        [(r["name"], bytes(r["raw"])) for r in bench.collect()], params.window, params.most_nodes))
    share = params.share

    def judge(raws: list) -> list[list]:
        texts = [words_of(raw) if raw else [] for raw in raws]
        found = [scan(words, held.value) for words in texts]
        n_words = [len(words) for words in texts]
        n_hit = [0 if h is None else int(h.sum()) for h, _ in found]
        return [n_words, n_hit, [names for _, names in found],
                [[] if h is None else spans_of(raw, h) for raw, (h, _) in zip(raws, found, strict=True)],
                [h > 0 and share * h >= w for h, w in zip(n_hit, n_words, strict=True)]]

    return append_columns(docs, text, FIELDS, judge)


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that the rule does not find contaminated, with their own columns, whatever their names."""
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns)}
    judged = contamination(docs.toDF(*own.values()).withColumn("_text", F.col(own[text])), items, text="_text", **options)
    return judged.where(~F.col("contaminated")).select(*own.values()).toDF(*docs.columns)
