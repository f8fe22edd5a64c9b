"""Operators on texts against brute force, with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dialtone.llm import decontaminate, langid, quality, secrets, simhash, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(draw, n, words=None):
    words = words or ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu"]
    return " ".join(draw.choice(words) for _ in range(n))


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# --- decontamination ---------------------------------------------------------------

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def hits(text, items):
    words = WORDS.findall(lowered(text or ""))
    hit, names = [False] * len(words), set()
    for name, item in items:
        own = WORDS.findall(lowered(item or ""))
        n = min(13, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for k in range(len(words) - n + 1):
                if words[k:k + n] == own[i:i + n]:
                    hit[k:k + n] = [True] * n
                    names.add(str(name))
    return len(words), sum(hit), sorted(names)


def test_contamination(spark):
    draw = random.Random(1)
    items = [(1, prose(draw, 20)), (2, prose(draw, 5) + " Ünder-Score"), (3, None), (4, "..."), (5, prose(draw, 14)), (1, "eins zwei")]
    rows = [(1, None), (2, ""), (3, "A " + items[0][1].upper() + "! end"), (4, prose(draw, 300) + "\n" + items[4][1] + " x"),
            (5, prose(draw, 50)), (5, prose(draw, 50)), (None, "é " + items[1][1].replace(" ", " -- ")), (7, "Eins, zwei; drei")]
    docs = table(spark, rows).withColumn("N_WORDS", F.lit("clash"))
    got = decontaminate.contamination(docs, table(spark, items, "item_id long, text string")).collect()
    assert len(got) == len(rows)
    for (doc, text), row in zip(rows, got, strict=True):
        n, hit, names = hits(text, items)
        assert (row["doc_id"], row["n_words"], row["n_hit"], row["hit_items"]) == (doc, n, hit, names)
        assert row["contaminated"] == (hit > 0 and 20 * hit >= n)
        marked = " ".join(text[s["start"]:s["end"]] for s in row["hit_spans"])
        assert len(WORDS.findall(lowered(marked))) == hit


def test_one_automaton_for_a_large_benchmark(spark, monkeypatch):
    """Over 500 KB of items: built once, on the driver; hits as by brute force."""
    draw = random.Random(7)
    words = [f"w{i}" for i in range(60_000)]
    items = [(i, prose(draw, 400, words)) for i in range(220)]
    assert sum(len(t) for _, t in items) > 500_000
    built = []
    real = decontaminate.build_benchmark
    monkeypatch.setattr(decontaminate, "build_benchmark", lambda *a: built.append(1) or real(*a))
    docs = []
    for i in range(30):
        own = items[i * 7 % 220][1].split()
        at, n = draw.randrange(380), draw.randint(10, 20)
        docs.append((i, prose(draw, 40, words) + " " + " ".join(own[at:at + n]) + " " + prose(draw, 40, words)))
    params = decontaminate.Decontamination(most_nodes=10_000_000)
    got = decontaminate.contamination(table(spark, docs).repartition(6), table(spark, items, "item_id long, text string"), params=params).collect()
    assert built == [1]
    few = lambda text: [(n, t) for n, t in items if len(set(text.split()) & set(t.split())) >= 10]
    for r in got:
        n, hit, names = hits(r["text"], few(r["text"]))
        assert (r["n_words"], r["n_hit"], r["hit_items"]) == (n, hit, names)
    assert sum(r["n_hit"] > 0 for r in got) > 10
    with pytest.raises(ValueError, match="most_nodes"):
        decontaminate.contamination(table(spark, docs), table(spark, items, "item_id long, text string"),
                                    params=decontaminate.Decontamination(most_nodes=1_000_000))


def test_codes_tell_words_apart():
    for n in (0, 1, 255, 256, 20_000):
        words = [b"%d" % i for i in range(n)]
        codes = decontaminate.Codes(words)
        assert len(set(codes.of.values()) | {codes.unknown}) == n + 1 and {len(c) for c in codes.of.values()} <= {codes.width}
        assert codes.read([b"nobody", *words[:2]]) == codes.unknown + "".join(codes.of[w] for w in words[:2])


def test_contamination_of_nothing(spark):
    empty = table(spark, [], "item_id long, text string")
    docs = table(spark, [(1, "a b")])
    assert decontaminate.contamination(docs, empty).collect()[0]["n_hit"] == 0
    assert decontaminate.drop_contaminated(docs.limit(0), table(spark, [(1, "a b")], "item_id long, text string")).count() == 0
    assert decontaminate.drop_contaminated(docs, table(spark, [(1, "a b")], "item_id long, text string")).count() == 0


# --- SimHash ------------------------------------------------------------------------

def brute_fingerprint(text, k=3):
    words = re.findall("[^\x20\x09-\x0D]+", lowered(text or ""))
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("hot", [32_768, 2])
def test_simhash(spark, hot):
    draw = random.Random(2)
    base = prose(draw, 200, [f"w{i}" for i in range(500)])
    rows = [(9, None), (4, ""), (3, "  \n"), (12, "One"), (11, "one"), (None, base), (20, base), (20, base)]
    for i in range(40):
        words = base.split()
        words[draw.randrange(200)] = f"x{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, prose(draw, draw.randint(1, 80), [f"v{j}" for j in range(300)])) for i in range(40)]
    got = simhash.near_duplicates(table(spark, rows), params=simhash.SimHash(hot=hot)).select("doc_id", "fingerprint", "component_id").collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = brute_groups(prints)
    lowest = {g: min((r[0] for r, h in zip(rows, groups, strict=True) if h == g and r[0] is not None), default=None) for g in groups}
    assert Counter(map(tuple, got)) == Counter((r[0], f"{p:016x}", lowest[g]) for r, p, g in zip(rows, prints, groups, strict=True))
    kept = simhash.keep_one(table(spark, rows)).collect()
    assert len(kept) == len(set(groups))
    assert {r["doc_id"] for r in kept} == {v for v in lowest.values()}


def test_simhash_links_are_whole():
    draw = np.random.default_rng(3)
    fps = np.unique(np.concatenate([draw.integers(0, 1 << 62, 50), 5 ^ (1 << draw.integers(0, 60, (200, 2))).sum(axis=1)])).astype(np.int64)
    a, b = simhash.forest([np.zeros(len(fps))], fps, 3)
    parent = {f: f for f in fps.tolist()}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert (x ^ y).bit_count() <= 3
        old, new = parent[x], parent[y]
        parent = {k: new if v == old else v for k, v in parent.items()}
    assert len(set(parent.values())) == len(set(brute_groups(fps.tolist())))


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(table(spark, [])).count() == 0


# --- repeated substrings --------------------------------------------------------------

def brute_cut(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        mark = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                mark[i:i + length] = [True] * length
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[m] for m in mark))]
        out.append((len(r), sum(mark), spans, bytes(b for b, m in zip(r, mark, strict=True) if not m)))
    return out


@pytest.mark.parametrize("params", [substrings.Repeats(20, 10), substrings.Repeats(20, 10, chunk=64, hot=2), substrings.Repeats(20, 12, hot=0),
                                    substrings.Repeats(20, 10, crowd=0), substrings.Repeats(20, 11, hot=2, crowd=5)])
def test_repeats(spark, params):
    draw = random.Random(4)
    line = prose(draw, 6)
    texts = [None, "", "short", "a" * 70, line, line + "é" + line, "x" + line[:30], line[5:40] + "yy" + prose(draw, 40)]
    texts += [prose(draw, draw.randint(1, 60), ["ab", "abc", "bca", "c"]) for _ in range(25)]
    texts += [f"{i}{line}{i * 7}" for i in range(12)] + [texts[-1], texts[-1]]
    got = {}
    rows = list(enumerate(texts))
    for r in substrings.remove_repeats(table(spark, rows), params=params).collect():
        got[r["doc_id"]] = (r["n_bytes"], r["n_removed"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
    assert got == dict(enumerate(brute_cut(texts, params.length)))


def test_suffix_sort():
    draw = random.Random(5)
    data = np.frombuffer("".join(draw.choice("ab") for _ in range(400)).encode(), np.uint8)
    starts = np.array(draw.sample(range(380), 200))
    group = np.sort(np.array([draw.randrange(5) for _ in range(200)]))
    got = substrings.suffix_sort(data, substrings.PrefixHash(data), starts, group, 20)
    for g in set(group.tolist()):
        own = [bytes(data[s:s + 20]) for s in got[group == g]]
        assert own == sorted(own)
        assert sorted(got[group == g].tolist()) == sorted(starts[group == g].tolist())


# --- language and quality ---------------------------------------------------------------

def test_language(spark):
    draw = random.Random(6)
    words = {"aa": ["thing", "whether", "shall", "would"], "bb": ["schön", "nicht", "zwischen", "über"]}
    rows = [(i, prose(draw, 60, words[lang]), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "123 ...", None), (None, "would shall", "aa")]
    docs = table(spark, rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.where("doc_id % 4 <> 2 or doc_id is null"))
    got = langid.identify(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == len(rows)
    for row, (_, text, lang) in zip(got, rows, strict=True):
        assert 0 <= row["score"] <= 1
        assert row["lang_pred"] == ("und" if not text or not re.search("[a-z]", text) else lang)
    nothing = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_quality(spark):
    draw = random.Random(7)
    rows, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        rows.append((i, " ".join(w + "$$$" if bad else w for w in prose(draw, draw.randint(20, 60)).split())))
        if i % 2:
            marks.append((i, 0 if bad else 1))
    rows += [(None, None), (900, ""), (901, "word " * 5000)]
    marks += [(None, 1), (7, None), (11, 0)]
    docs, labels = table(spark, rows), table(spark, marks, "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.classify(docs.withColumn("Predicted", F.lit(5)), model).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    right = sum(r["predicted"] == (r["doc_id"] % 5 != 0) for r in got[:600])
    assert right >= 590
    assert len(quality.classify(docs, quality.fit(docs, labels.limit(0))).collect()) == len(rows)


def test_quality_risk_is_not_negative_labelled(spark):
    """Rows labelled 0 serve for the prior only: other texts of theirs give the same weights."""
    draw = random.Random(8)
    docs = table(spark, [(i, prose(draw, 30)) for i in range(60)])
    some = quality.fit(docs, table(spark, [(i, int(i % 3 > 0)) for i in range(30)], "doc_id long, quality int"))
    others = [(i, 1) for i in range(30) if i % 3] + [(i, 0) for i in range(40, 50)]
    assert np.allclose(some.weights, quality.fit(docs, table(spark, others, "doc_id long, quality int")).weights)


# --- secrets ------------------------------------------------------------------------------

def test_secrets(spark):
    draw = random.Random(9)
    key = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, prose(draw, 40) + (f' token = "{key(i)}" ' if i % 4 == 0 else f" commit {key(i)} ") + "internationalization again",
             "src0", "en", 1) for i in range(80)]
    rows += [(100, None, None, None, None), (101, "", "a", "b", 0), (102, "averyveryverylongwordindeed", "c", "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, redacted long")
    model = secrets.train(docs)
    got = {r["doc_id"]: r for r in secrets.scan(docs, model).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        r = got[i]
        secret = i < 80 and i % 4 == 0
        assert r["n_secrets"] == int(secret), (text, r["findings"])
        for f in r["findings"]:
            assert text[f["start"]:f["end"]] == f["value"]
        assert r["redacted"] == (text.replace(key(i), "[SECRET]") if secret else text)
    bare = secrets.fit(spark.createDataFrame([], "value string, before string, after string, path string, label int"), model.vocabulary)
    assert secrets.scan(docs, bare).where("doc_id = 102").first()["n_secrets"] == 1
    assert secrets.scan(docs.limit(0), model).count() == 0


def test_secrets_after_long_names(spark):
    """A name of 16 characters or more is a candidate itself and still announces its value."""
    draw = random.Random(10)
    key = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    forms = ["AWS_SECRET_ACCESS_KEY={}", 'DATABASE_API_TOKEN = "{}"', "billing_client_secret: '{}'", "LAST_RELEASE_CHECKSUM={}", 'expected_commit_revision = "{}"']
    rows = [(i, f"{prose(draw, 30)} {forms[i % 5].format(key(i))} {prose(draw, 5)}", "src0") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in secrets.scan(docs, secrets.train(docs)).collect()}
    for i, text, _ in rows:
        assert got[i]["redacted"] == (text.replace(key(i), "[SECRET]") if i % 5 < 3 else text)


def test_short_secrets(spark):
    """Passwords of any characters after an announcing word or in a URL; placeholders and code stay."""
    draw = random.Random(11)
    said = [('password = "{}"', "Tr0ub4dor&3"), ("db_password: '{}'", "hunter42!x"), ("API_TOKEN={}", "Zk3!x9Qp"),
            ("postgres://app:{}@db.local/main", "s3cr3t9"), ('{{"passwd": "{}"}}', "q7#Lm,2v$"), ('password = "{}"', "abcdEFGH12345678!x&y;z")]
    left = ['password = "changeme"', "password: required", "token = os.environ[", 'secret: "${DB_SECRET}"', "http://host:8080/path", "user = summer12!x"]
    rows = [(i, f"{prose(draw, 20)} {form.format(value)} {prose(draw, 5)}", "src0") for i, (form, value) in enumerate(said * 10)]
    rows += [(1000 + i, f"{prose(draw, 20)} {text} {prose(draw, 5)}", "src0") for i, text in enumerate(left * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["redacted"] for r in secrets.scan(docs, secrets.train(docs)).collect()}
    for i, text, _ in rows:
        assert got[i] == (text.replace((said * 10)[i][1], "[SECRET]") if i < 1000 else text)


def test_secret_vocabulary_is_of_all_documents(spark):
    """Counted by hand over all rows, however small the sample of findings is."""
    rows = [(i, " ".join(["common"] * 3 + [f"rare{'abcdefghij'[i % 10]}"] * (1 + i % 10)), "src0") for i in range(200)]
    docs = spark.createDataFrame([*rows, (900, None, None)], "doc_id long, text string, source string")
    got = secrets.train(docs, params=secrets.SecretScan(sample_rows=5, dictionary=6, pairs=4)).vocabulary
    words = Counter(w for _, text, _ in rows for w in text.split())
    pairs = Counter()
    for w, n in words.items():
        for a, b in zip(w, w[1:], strict=False):
            pairs[a + b] += n
    most = lambda counts, k: tuple(w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k])
    assert (got.words, got.pairs) == (most(words, 6), most(pairs, 4))


def test_equal_rows_cost_as_much_as_own_ids(spark):
    """R equal rows of one text: work grows with R, not with its square."""
    import time

    text = prose(random.Random(8), 700, [f"w{i}" for i in range(5000)])
    times = {}
    for name, ids in (("warm", [1] * 50), ("equal", [1] * 2000), ("own", range(2000))):
        rows = table(spark, [(i, text) for i in ids])
        t = time.perf_counter()
        got = substrings.remove_repeats(rows).select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n")).distinct().collect()
        times[name] = time.perf_counter() - t
        n = len(text.encode())
        assert {tuple(r)[1:] for r in got} == {(n, n, 1)} and len(got) == len(set(ids))
    assert times["equal"] < 3 * times["own"] + 5
