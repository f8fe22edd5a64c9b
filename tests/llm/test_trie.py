"""Prefix trie by tree contraction against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dialtone.llm import trie

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    line = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        line[c] = tuple(own.get(c - c % 20, [])[:h]) + tuple(v[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, v in line.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
            if d:
                kids[v[:d - 1]].add(v[:d])
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
        ends = ",".join(str(c) for c in sorted(members[p]) if len(line[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("PC", F.lit("clash")).withColumn("depth", F.lit(9)).repartition(3)
    return sorted((tuple(r) for r in trie.prefix_trie(trie.rebuilt(trie.ordered_turns(turns))).select(*COLUMNS).collect()), key=str)


def dialogues(seed, n, longest=6):
    """Few different turns, so prefixes are shared; null, repeated and unordered turns."""
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        if draw.random() < 0.1:
            continue  # an absent conversation, maybe one that others would borrow from
        for t in range(draw.randint(1, longest)):
            rows.append((c, draw.choice([t, t, t, None, 0]), draw.choice(["user", "assistant", None]),
                         draw.choice(["hi", "Hi  there\tyou", "", None, "a\x0bb c", "tschüß"])))
    rows += rows[:5] + [(None, 0, "user", "no conversation")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n", [(1, 90), (2, 45)])
def test_trie(spark, seed, n):
    rows = dialogues(seed, n)
    assert nodes(spark, rows) == brute(rows)


def test_long_chains_and_pieces(spark, monkeypatch):
    """Conversations of hundreds of turns that part late, with prefixes taken in pieces of 16 turns."""
    monkeypatch.setattr(trie, "PIECE", 16)
    rows = [(c, t, "user", f"turn {t}" if t < 120 + c else f"own {c} {t}") for c in (40, 41, 42, 60) for t in range(150)]
    rows += [(c, 0, "user", "turn 0") for c in range(80, 95)]  # many that end early or lose all turns
    assert nodes(spark, rows) == brute(rows)


def test_a_hot_prefix_and_equal_conversations(spark):
    rows = [(c, t, "user", "same" if c % 3 else f"w{c}") for c in range(200) for t in range(3)]
    assert nodes(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "a", "b")]) == []
    assert nodes(spark, [(5, 1, None, None)]) == brute([(5, 1, None, None)])
    lost = [(c, 0, "user", "x") for c in range(21, 40)]  # nobody to borrow from: some are left without turns
    assert nodes(spark, lost) == brute(lost)
    assert brute(lost)[0][3] <= len(lost)


def test_very_long_text(spark):
    rows = [(c, t, "user", "word " * 200_000 + str(t)) for c in (20, 21) for t in range(2)]
    assert nodes(spark, rows) == brute(rows)


def test_totals_of_random_trees(spark):
    draw = random.Random(3)
    for n, near in ((120, 2), (150, 150), (40, 1)):  # long chains, stars, one chain
        parent = [None] + [draw.randint(max(0, i - near), i - 1) for i in range(1, n)]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        weight = [draw.randint(0, 9) for _ in range(n)]
        total = weight[:]
        for i in range(n - 1, 0, -1):
            total[parent[i]] += total[i]
        rows = [(i, depth[i], parent[i], None if i == 0 else depth[parent[i]], weight[i]) for i in range(n)]
        tree = spark.createDataFrame(rows, "c long, d long, pc long, pd long, w long")
        assert {r["c"]: r["w"] for r in trie.subtree_totals(tree, ["w"]).collect()} == dict(enumerate(total))
