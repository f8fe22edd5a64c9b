"""Language identification by compression.

Per language a raw-content zstandard dictionary is cut from labelled texts; a text
is encoded with each language's dictionary and the smallest output names it. The
answer is ``rejected`` where the runner-up is nearly as small.

Texts are lower-cased and reduced to letters, then encoded whole, in blocks of
``block`` bytes, so that the dictionary and not the text's own start explains a
long text. Sizes that tie (texts of a few words) are told apart by the bytes that
the text adds to a carrier, a passage of the language outside its dictionary.

Fitting reads a bounded sample: for each language about ``sample_rows`` labelled
rows chosen by a hash of the id, of which ``dictionary`` + ``carrier`` bytes are
kept. That bounds what is broadcast: languages times these bytes (``most_bytes``
in all; with very many languages each dictionary shrinks).

Nulls: a null text, and a text without letters, is ``und`` with score 0; rows with a
null language are not learned from; without any labelled row all texts are ``und``.
Ties go to the smaller language name. Clashing input columns give way to results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, hash_share

UNKNOWN = "und"
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
#: Bytes that stay: a-z and parts of characters beyond ASCII.
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageId:
    dictionary: int = 65_536
    carrier: int = 2_048
    block: int = 8_192
    sample_rows: int = 200
    most_bytes: int = 64 << 20
    least_margin: float = 0.01   # of the smallest size; under it: rejected
    sharpness: float = 0.35      # score: softmax of minus the sizes in bytes times this
    level: int = 3


@dataclass
class Model:
    params: LanguageId
    dictionaries: dict[str, bytes]
    carriers: dict[str, bytes]
    _held: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_held": {}}

    def compressors(self) -> list:
        """(language, compressor, carrier, the carrier's own size), built once per worker."""
        if not self._held:
            p = self.params
            # greedy matching with three-byte matches: short words count
            setting = zstandard.ZstdCompressionParameters.from_level(
                p.level, source_size=p.block, dict_size=p.dictionary, min_match=3, search_log=3,
                strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False)
            for name in sorted(self.dictionaries):
                known = zstandard.ZstdCompressionDict(self.dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=setting)
                packer = zstandard.ZstdCompressor(compression_params=setting, dict_data=known)
                carrier = self.carriers[name]
                self._held[name] = (packer, carrier, len(packer.compress(carrier)))
        return [(name, *held) for name, held in self._held.items()]

    def predict(self, raw: bytes | None) -> tuple[str, float, float, bool]:
        text = letters(raw)
        if not text or not self.dictionaries:
            return UNKNOWN, 0.0, 0.0, True
        packers = self.compressors()
        block = self.params.block
        sizes = [float(sum(len(p.compress(text[a:a + block])) for a in range(0, len(text), block)))
                 for _, p, _, _ in packers]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        if len(order) > 1 and sizes[order[1]] - sizes[order[0]] < 1:
            sizes = [s + 0.9 * min(1.0, max(0.0, (len(p.compress(c + text[:block])) - own) / (len(text[:block]) + 16)))
                     for s, (_, p, c, own) in zip(sizes, packers, strict=True)]
            order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        weights = [math.exp(max(-50.0, (best - s) * self.params.sharpness)) for s in sizes]
        margin = (sizes[order[1]] - best) / best if len(order) > 1 else 1.0
        return packers[order[0]][0], 1.0 / sum(weights), margin, margin < self.params.least_margin


def letters(raw: bytes | None) -> bytes:
    """Lower-cased, words of letters only; empty if the text has no letter at all."""
    if not raw:
        return b""
    text = raw.decode("utf-8", "replace")
    found = b" ".join(text.lower().encode().translate(_LETTERS).split())
    return found if found and (found[0] < 0x80 or _LETTER.search(text)) else b""


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        params: LanguageId = LanguageId()) -> Model:
    """Learn from the rows of ``labelled`` that have a text and a language."""
    rows = labelled.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"), F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model(params, {}, {})
    need = min(params.dictionary, max(2048, params.most_bytes // len(counts) - params.carrier)) + params.carrier
    drawn = hash_share(F.coalesce("id", F.lit("")), salt="language")
    share: Column = F.lit(0.0)
    for name, n in sorted(counts.items()):
        share = F.when(F.col("lang") == name, F.lit(min(1.0, params.sample_rows / n))).otherwise(share)
    # the fit may be on a bounded sample: of a long training text its first bytes are enough
    sample = (rows.where(drawn < share).select("lang", "id", F.substring("text", 1, need).alias("text"))
              .orderBy("lang", F.xxhash64("id", "text")).toLocalIterator())
    pools: dict[str, list[bytes]] = {name: [] for name in counts}
    sizes = dict.fromkeys(counts, 0)
    for row in sample:
        if sizes[row["lang"]] < need:
            part = letters(row["text"].encode())
            pools[row["lang"]].append(part)
            sizes[row["lang"]] += len(part) + 1
    whole = {name: b" ".join(parts)[:need] for name, parts in pools.items()}
    # a short pool (few labelled rows) gives an eighth of itself as the carrier
    cut = {name: min(params.carrier, len(w) // 8) for name, w in whole.items()}
    return Model(params, {n: w[cut[n]:] for n, w in whole.items() if len(w) >= 8},
                 {n: w[:cut[n]] for n, w in whole.items()})


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the predicted language, score, margin and whether the margin is too narrow."""

    def run(raws: list) -> list[list]:
        return [list(x) for x in zip(*(model.predict(raw) for raw in raws), strict=True)]

    return append_columns(docs, text, FIELDS, run)
