"""Suffix tree and tokenizer alignment against brute force, with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialtone.llm import alignment, blocks, suffixtree
from dialtone.llm.common import bound_arrow_batches

SCHEMA = "doc_id long, text string, train boolean"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# --- blocks ---------------------------------------------------------------------------

def test_packed_numbers_come_back():
    draw = np.random.default_rng(1)
    for values in ([], [0], [7, 7, 300], draw.integers(0, 1 << 62, 1000), [2 ** 64 - 1, 0]):
        v = np.array(values, np.uint64)
        assert np.array_equal(blocks.unpack(blocks.pack(v)), v)
        assert np.array_equal(blocks.unpack_sorted(blocks.pack_sorted(np.sort(v))), np.sort(v))
    parts = [b"", b"abc", b"\0" * 10]
    assert blocks.unbundle(blocks.bundle(parts)) == parts


# --- suffix tree ------------------------------------------------------------------------

def brute_tree(rows, params):
    """{context: strength} of the retained contexts, and a function (context, word) -> probability."""
    docs = [re.findall("[^\x20\x09-\x0D]+", lowered(t or "")) + ["\n"] for _, t, train in rows if train]
    unigrams = Counter(w for d in docs for w in d)
    tokens, symbols = sum(unigrams.values()), len(unigrams)
    nexts = defaultdict(Counter)
    for d in docs:
        line = [" ", *d]
        for i in range(1, len(line)):
            for k in range(1, params.depth + 1):
                if k <= i:
                    nexts[tuple(line[i - k:i])][line[i]] += 1
    least = max(params.least_count, math.ceil(params.least_share * tokens))
    kept = {}

    def p(context, word):
        if not context:
            return (unigrams[word] + 1) / (tokens + symbols + 1)
        shorter = p(context[1:], word)
        if context not in kept:
            return shorter
        n = nexts[context]
        return (n[word] + kept[context] * shorter) / (sum(n.values()) + kept[context])

    for k in range(1, params.depth + 1):
        new = {}
        for s, n in nexts.items():
            total = sum(n.values())
            if len(s) != k or total < least:
                continue
            gains = [sum(c * math.log((c - 1 + m * p(s[1:], w)) / (total - 1 + m) / p(s[1:], w)) for w, c in n.items())
                     for m in params.strengths]
            best = max(range(len(gains)), key=lambda i: (round(gains[i], 5), -i))
            if gains[best] > params.least_gain * total:
                new[s] = params.strengths[best]
        kept.update(new)

    def score(text):
        words = re.findall("[^\x20\x09-\x0D]+", lowered(text or "")) + ["\n"]
        line = [" ", *words]
        base = sum(math.log10(p((), w)) for w in words)
        return (len(words), sum(unigrams[w] > 0 for w in words), tokens, base,
                sum(math.log10(p(tuple(line[max(0, i - params.depth):i]), line[i])) for i in range(1, len(line))))

    return kept, score


def phrases(draw, n):
    """Texts in which some words follow others."""
    lines = ["the cat sat on the mat", "a dog ran to the old house", "on the mat a cat", "Ünder the Bridge", "to be or not to be"]
    return " ".join(draw.choice(lines) if draw.random() < 0.7 else draw.choice(["zip", "zap", "zoom"]) + str(draw.randint(0, 30)) for _ in range(n))


@pytest.mark.parametrize("depth,share,block,shard", [(3, 1e-5, 12 << 20, 1 << 21), (2, 0.01, 500, 100), (1, 0.002, 2000, 10)])
def test_suffix_tree_scores(spark, depth, share, block, shard):
    bound_arrow_batches(spark)
    draw = random.Random(4)
    rows = [(i, phrases(draw, draw.randint(1, 30)), i % 5 != 0) for i in range(150)]
    rows += [(1000, None, True), (1001, "", False), (1002, " \n\t", True), (1003, None, False), (None, "the CAT sat", False),
             (1004, "the cat sat", None), (1005, "never seen words", False), (7, rows[7][1], True), (7, rows[7][1], True),
             (1006, "the cat sat on the mat " * 4000, False)]
    params = suffixtree.SuffixTree(depth=depth, least_share=share, block=block, shard=shard)
    docs = table(spark, rows).withColumn("N_TOKENS", F.lit("clash")).withColumn("score", F.lit(-1)).repartition(3)
    got = suffixtree.score(docs, F.col("train"), params=params).collect()
    kept, score = brute_tree(rows, params)
    assert kept and len(got) == len(rows)
    want = sorted(((i, bool(t)), score(x)) for i, x, t in rows if i is not None)
    found = sorted(((r["doc_id"], r["train"]), tuple(r)[2:]) for r in got if r["doc_id"] is not None)
    for (key, w), (name, g) in zip(want, found, strict=True):
        assert key == name and w[:3] == g[:3]
        assert g[3] == pytest.approx(w[3], rel=1e-9) and g[4] == pytest.approx(w[4], rel=1e-5, abs=1e-5)
    # states of two words are found where they say more than one word does
    assert depth == 1 or any(len(s) == 2 for s in kept)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1006]["score"] > by_id[1006]["base_score"]


def test_suffix_tree_keeps_the_brute_contexts(spark):
    bound_arrow_batches(spark)
    draw = random.Random(5)
    rows = [(i, phrases(draw, 20), True) for i in range(60)]
    params = suffixtree.SuffixTree(block=3000, shard=50)
    docs = table(spark, rows).select("doc_id", "train", "text")
    tree, _, _ = suffixtree.learn(suffixtree.word_blocks(docs, params), params)
    kept, _ = brute_tree(rows, params)
    name = lambda w: suffixtree.xxh64_intdigest(lowered(w).encode())
    assert {s: m for s, _, m in suffixtree.contexts(tree)} == {tuple(map(name, s)): m for s, m in kept.items()}


def test_suffix_tree_distributions_sum_to_one(spark):
    bound_arrow_batches(spark)
    rows = [(i, phrases(random.Random(i), 12), True) for i in range(40)]
    kept, _ = brute_tree(rows, suffixtree.SuffixTree())
    words = sorted({w for _, t, _ in rows for w in lowered(t).split()})
    # held-out texts "context word" for all known words and an unknown one: their last word but the end mark
    context = next(s for s in kept if len(s) == 1 and s != (" ",))[0]
    tests = [(1000 + i, f"{context} {w}", False) for i, w in enumerate([*words, "unknown-word"])] + [(999, context, False)]
    got = {r["doc_id"]: r["score"] for r in suffixtree.score(table(spark, rows + tests), F.col("train")).collect()}
    _, score = brute_tree(rows, suffixtree.SuffixTree())
    assert all(got[i] == pytest.approx(score(t)[4], rel=1e-5) for i, t, _ in tests)


def test_suffix_tree_of_nothing(spark):
    bound_arrow_batches(spark)
    assert suffixtree.score(table(spark, []), F.col("train")).count() == 0
    got = suffixtree.score(table(spark, [(1, "a b", False), (2, None, False)]), F.col("train")).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in sorted(got)] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]


# --- alignment -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return alignment.Encoder(alignment.Alignment())


def brute_alignment(encoder, text):
    """(A ids, B ids, groups, links) of a whole text, None without tokens."""
    if not text:
        return None
    a = encoder.a.encode(" " + text, add_special_tokens=False).ids
    b = encoder.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(encoder.a_bytes[i] for i in a) != raw or b"".join(encoder.b_bytes[i] for i in b) != raw:
        return None

    def spans(ids, names):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(names[i])))
            at += len(names[i])
        return out

    sa, sb = spans(a, encoder.a_bytes), spans(b, encoder.b_bytes)
    links, low = [], 0
    for i, (s, e) in enumerate(sa):
        while sb[low][1] <= s:
            low += 1
        j = low
        while j < len(sb) and sb[j][0] < e:
            links.append((a[i], b[j]))
            j += 1
    groups, i, j = [], 0, 0
    for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
        ga, gb = [], []
        while i < len(sa) and sa[i][1] <= cut:
            ga.append(a[i])
            i += 1
        while j < len(sb) and sb[j][1] <= cut:
            gb.append(b[j])
            j += 1
        groups.append((ga, gb))
    return a, b, groups, links


def odd_texts():
    draw = random.Random(6)
    words = ["alpha", "Bêta", "naïve", "don't", "x=1;", "1234567", "日本語", "tokenization", "<|endoftext|>", "<s>", "▁", "é", " ", "👩‍👩‍👧"]
    texts = [None, "", " ", "  two  spaces  ", "\n\nlines\n a", "trailing ", "\ttab", "a", "Hello world", "é combining", "ﬁ ligature ² ½",
             "　wide", "a​b", "\x00nul", "null\x00 x", " lead", "﻿bom x", "a ́b", "same text", "same text"]
    texts += [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    return texts + ["word " * 5000 + "nospace" * 3000, "日本" * 2000]


@pytest.mark.parametrize("block,lane,shard", [(8 << 20, 1024, 1 << 21), (3000, 2, 50)])
def test_alignment(spark, encoder, block, lane, shard):
    bound_arrow_batches(spark)
    rows = list(enumerate(odd_texts())) + [(None, "no id")]
    docs = table(spark, rows, "doc_id long, text string").withColumn("N_a", F.lit("clash")).withColumn("ids", F.lit(1)).repartition(3)
    params = alignment.Alignment(block=block, lane=lane, shard=shard)
    want = {i: brute_alignment(encoder, t) for i, t in rows}
    assert sum(w is None for w in want.values()) >= 2
    count = Counter(p for w in want.values() if w for p in set(w[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs, params=params).collect()}
    for i, w in want.items():
        if w is None:
            assert got[i] == (0, 0, 0, 0, 0, 0, "")
            continue
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in w[2])
        assert got[i] == (len(w[0]), len(w[1]), len(w[2]), len(w[3]), sum(count[p] == best[p[0]] for p in w[3]),
                          sum(count[p] for p in w[3]), hashlib.sha256(text.encode()).hexdigest())
    real = {r["doc_id"]: [(list(g["a"]), list(g["b"])) for g in r["groups"]] for r in alignment.groups(docs, params=params).collect()}
    assert real == {i: w[2] if w else [] for i, w in want.items()}


def test_parts_encode_like_whole_texts(encoder):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    letters = st.sampled_from(list("abE zé1.'-\n\t ") + ["  ", " the", "日", " ", "́", "▁", " ", " ́", "'s", "<s>", "ß"])

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.lists(letters, max_size=30).map("".join), st.text(max_size=30)))
    def check(text):
        found = alignment.align_texts(encoder, [text.encode("utf-8", "ignore")])
        want = brute_alignment(encoder, text.encode("utf-8", "ignore").decode())
        assert found.ids_a.tolist() == (want[0] if want else []) and found.ids_b.tolist() == (want[1] if want else [])

    check()


def test_new_parts_are_encoded_together(encoder):
    fresh = alignment.Encoder(alignment.Alignment())
    taken = []

    class Counted:
        def encode(self, texts, **more):
            taken.extend(texts)
            return encoder.b.encode(texts, **more)

    fresh.b = Counted()
    text = " ".join(f"w{n} naß{n}é" for n in range(1000))
    found = alignment.align_texts(fresh, [text.encode(), b"", text.encode()])
    want = brute_alignment(encoder, text)
    assert found.ids_a.tolist() == want[0] * 2 and found.ids_b.tolist() == want[1] * 2
    assert len(fresh.known) == 2000 and len(taken) < 50

    # a part whose bytes change costs its own document's tokens, not those of parts encoded beside it
    texts = ["one two▁three four", "five six seven", "ﬁve ²eight", "nine  ten eleven", "日本 twelve thirteen"]
    found = alignment.align_texts(alignment.Encoder(alignment.Alignment()), [t.encode() for t in texts])
    want = [brute_alignment(encoder, t) for t in texts]
    assert want[0] is None and want[1] is not None
    assert found.n_a.tolist() == [len(w[0]) if w else 0 for w in want] and found.n_b.tolist() == [len(w[1]) if w else 0 for w in want]
    assert found.ids_a.tolist() == [i for w in want if w for i in w[0]] and found.ids_b.tolist() == [i for w in want if w for i in w[1]]


def test_alignment_of_nothing(spark):
    bound_arrow_batches(spark)
    empty = table(spark, [], "doc_id long, text string")
    assert alignment.align(empty).count() == 0 and alignment.groups(empty).count() == 0
    assert tuple(alignment.align(table(spark, [(1, None)], "doc_id long, text string")).first()) == (1, 0, 0, 0, 0, 0, 0, "")
