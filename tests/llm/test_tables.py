"""Chat, neighbours, mixing, pages and the pipeline against brute force and round trips."""

import html as entities
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dialtone.llm import ann, chat, mixing, simhash, webtext

SF = "/root/testdata/sf0.001"


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "a\\", "\\<s>\\\\", "<<s>", "", None, "[[/INST]]", "<", "é<\\/s>", "line\nline", "x" * 50_000]
    draw = random.Random(1)
    rows = [(c, t, draw.choice(["user", "assistant", "system", None, "<s>", "to\nol"]), draw.choice(odd))
            for c in (1, 2, None) for t in [*range(30), None, 3, 3]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("mask", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert set(got) == {1, 2, None}
    for c, r in got.items():
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        back = [(t["role"], t["text"]) for t in r["turns"]]
        assert Counter(back) == Counter((x[2] or "", x[3] or "") for x in own)
        alone = [x for x in own if x[1] is not None and x[1] != 3]     # no ties
        assert [b for b in back if b in {(x[2] or "", x[3] or "") for x in alone}]
        assert "".join(r["loss_texts"]) == "".join(t for role, t in back if role == "assistant")
        assert sum(m["length"] for m in r["mask"]) == len(r["formatted"])
        roles = [role for role, _ in back]
        assert r["formatted"].count("[INST]") == 1 + sum(a != b for a, b in zip(roles, roles[1:], strict=False))
    assert chat.format_conversations(turns.limit(0)).count() == 0


def neighbours(rows, k):
    out = {}
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, v in good:
        if q % 20 == 0:
            near = sorted((-float((w * v).sum()), i) for i, w in good if i != q and len(w) == len(v))
            out[q] = near[:k]
    return out


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_neighbours(spark, block_rows):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] * (1 + i % 3) + 0.1 * draw.normal(size=16)).tolist()) for i in range(800)]
    rows += [(900 + i, centres[0].tolist()) for i in range(120)]                 # one common vector
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, []), (None, [1.0] * 16),
             (2100, [1.0, 2.0]), (2101, [1.0, 3.0]), (2120, [float("inf")] + [0.0] * 15)]
    params = ann.Search(k=5, hashes=4, block_rows=block_rows, query_part=30)
    vectors = ann.valid(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = defaultdict(list)
    for r in ann.search(ann.build(vectors, params), vectors.where("id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = neighbours(rows, 5)
    assert set(got) == set(want)
    assert [v for v, _ in got[2100]] == [2101]
    found = sum(len({i for _, i in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert found >= 0.9 * sum(map(len, want.values()))
    by_id = {i: v for i, v in rows if i is not None}
    for q, near in got.items():
        assert [(-s, v) for v, s in near] == sorted((-s, v) for v, s in near)
        assert all(abs(s - float(np.dot(by_id[q], by_id[v]))) < 1e-9 for v, s in near)
    assert ann.search(ann.build(vectors.limit(0), params), vectors.limit(0)).count() == 0


def test_neighbours_of_repeated_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(200)]
    rows[1] = (1, [x * 1.01 for x in rows[0][1]])      # near query 0, and there fifty times
    params = ann.Search(k=5, hashes=3, success=0.999)

    def found(table):
        vectors = ann.valid(spark.createDataFrame(table, "vec_id long, embedding array<double>"))
        got = ann.search(ann.build(vectors, params), vectors.where("id % 20 = 0"))
        return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())

    once = found(rows)
    assert Counter(q for q, *_ in once) == {q: 5 for q in range(0, 200, 20)}
    assert found(rows + rows) == once
    assert found(rows + rows[1:2] * 49) == once


def test_permutation(spark):
    for n in (1, 2, 3, 7, 100, 1009):
        got = [r[0] for r in spark.range(n).select(mixing.shuffled(F.col("id"), F.lit(n).cast("long"), F.lit("k"))).collect()]
        assert sorted(got) == list(range(n))


def filled(sizes, weights):
    left, target, free = float(sum(sizes.values())), {}, set(sizes)
    while free:
        total = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / total > 3 * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.remove(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def test_mixing(spark):
    draw = random.Random(3)
    rows = [(i, " ".join("w" * draw.randint(1, 3) for _ in range(draw.randint(0, 90))), draw.choice(["b", "a", "c", None, "z", "b", "b"])) for i in range(600)]
    rows += [(700, None, "a"), (701, "", "a"), (702, "only", "tiny"), (5, rows[5][1], rows[5][2]), (None, "x y z", "b"), (703, "u " * 9000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    params = mixing.Mixing(block=16, buckets=8, shard=64, chunk=50)
    runs = [sorted(map(tuple, mixing.taken(mixing.plan(docs, ["doc_id"], params=params)).select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)
            for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    target = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    source_of = {i: s for i, _, s in rows}
    took = Counter()
    for doc, size, source_size, goal, taken in runs[0]:
        source = source_of[doc]
        assert source_size == sizes[source] and abs(goal - target[source]) < 1e-6 and taken <= 3 * size
        took[source] += taken
    for s in order:
        assert abs(took[s] - target[s]) <= 2 * 16 + 0.05 * target[s]
    unique = docs.where("doc_id is not null and doc_id <> 5")
    mix = mixing.plan(unique, ["doc_id"], params=params)
    words = mixing.mixed_texts(unique, mix, "doc_id").select("doc_id", F.size(F.split("text", " ")).alias("n")).groupBy("doc_id").agg(F.sum("n")).collect()
    assert dict(map(tuple, words)) == {r["doc_id"]: r["taken"] for r in mixing.taken(mix).where("taken > 0").collect()}
    assert mixing.taken(mixing.plan(docs.limit(0), ["doc_id"])).count() == 0


def test_mixing_of_small_sources(spark):
    """Sources of any size get their target, to the word, and none is left out."""
    sizes = [1, 2, 21, 22, 63, 100, 128, 129, 150, 257, 300, 5, 1, 1000, 3, 7, 20_000, 40, 9000]
    rows, doc = [], 0
    for s, size in enumerate(sizes):
        while size:
            n = min(size, 37)
            rows.append((doc, " ".join(f"w{doc}" for _ in range(n)), f"s{s:02d}"))
            doc, size = doc + 1, size - n
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.plan(docs, ["doc_id"])
    source_of, took, target = {i: s for i, _, s in rows}, Counter(), {}
    for r in mixing.taken(mix).collect():
        s = source_of[r["doc_id"]]
        took[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert len(target) == len(sizes)
    for s, goal in target.items():
        assert took[s] >= 1 and abs(took[s] - goal) < 1, (s, goal, took[s])
    written = Counter()
    for r in mixing.mixed_texts(docs, mix, "doc_id").collect():
        written[source_of[r["doc_id"]]] += len(r["text"].split())
    assert written == took


def page(draw, i):
    paragraphs = [" ".join(draw.choice(["one", "two", "three", "four,", "five."]) for _ in range(draw.randint(3, 40))) for _ in range(draw.randint(1, 6))]
    body = "".join(f"<p>{entities.escape(p)} &amp;  co" for p in paragraphs)
    text = "\n\n".join([f"Title {i}", *(f"{p} & co" for p in paragraphs)])
    return (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/x'>home</a></li></ul></nav><!-- <p>no -->"
            f"<div class=\"ad\">buy &gt; now</div><article><h1>Title {i}</h1>{body}</article><footer>&copy; all</footer>"
            f"<script>var x = '<p>';</script></body></html>"), text


def test_pages(spark):
    draw = random.Random(4)
    made = [page(draw, i) for i in range(60)]
    rows = [(i, "u", p) for i, (p, _) in enumerate(made)] + [(100, None, None), (101, "", ""), (102, "x", "<nav><a>menu</a></nav>"), (103, "x", "<p unclosed")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("N_BLOCKS", F.lit("clash"))
    model = webtext.fit(pages, params=webtext.Extraction(sample=40))
    got = {r["page_id"]: r["main_text"] for r in webtext.extract(pages, model).collect()}
    assert [got[i] for i in range(60)] == [t for _, t in made]
    assert got[100] == got[101] == got[102] == ""
    assert webtext.extract(pages, webtext.fit(pages.limit(0))).count() == len(rows)


def undressed(draw, i):
    """The page of ``page`` with neither article nor main nor nav."""
    markup, text = page(draw, i)
    markup = markup.replace("<nav>", '<div class="menu">').replace("</nav>", "</div>").replace("<footer>", '<div class="footer">')
    return markup.replace("</footer>", "</div>").replace("<article>", '<div class="post-body">').replace("</article>", "</div>"), text


@pytest.mark.parametrize("sectioned", [0, 3, 30])
def test_pages_without_sectioning(spark, sectioned):
    """They teach nothing, so mixed in or alone they have their text."""
    draw = random.Random(6)
    made = [page(draw, i) if i < sectioned else undressed(draw, i) for i in range(150)]
    pages = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(made)], "page_id long, html string")
    got = {r["page_id"]: r["main_text"] for r in webtext.extract(pages, webtext.fit(pages)).collect()}
    right = sum(got[i] == t for i, (_, t) in enumerate(made))
    assert right >= 0.95 * len(made), (right, [(got[i], t) for i, (_, t) in enumerate(made) if got[i] != t][:3])


def test_page_blocks():
    found = webtext.blocks_of("<div>a<br>b<p>c <b>d</b>&nbsp;&lt;e<p>f<li>g</div><template><p>no</template>h<a href='>'>i</a>")
    assert [b.text for b in found] == ["a b", "c d <e", "f", "g", "hi"]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = simhash.settle(stage(spark, docs, SF))
        assert after.columns == docs.columns
        counts.append(after.count())
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        for r in after.collect():
            assert name == "secrets" or before[r["doc_id"]] == r["text"]
        docs = after
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == counts[-1]
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in docs.collect()}


# --- pages: linear reading, the field against enumeration ------------------------------

def test_long_and_deep_pages_are_read_in_time():
    import time

    begun = time.perf_counter()
    deep = webtext.blocks_of("<div>x" * 100_000)
    assert len(deep) == 100_000 and len(deep[-1].path.up()) == 100_000
    assert len(webtext.blocks_of("<b x " * 200_000)) == 1            # a megabyte of tags that never end
    assert len(webtext.blocks_of('<b x="' * 170_000)) == 1
    assert len(webtext.blocks_of("".join(f'<div class="c{i}">x' for i in range(50_000)))) == 50_000
    model = webtext.train([webtext.built_in(random.Random(1))])
    assert len(model.labels(deep)) == 100_000
    assert time.perf_counter() - begun < 60


def test_one_dense_training_page_is_bounded():
    import time

    usual = [webtext.built_in(random.Random(i)) for i in range(100)]
    dense = webtext.blocks_of("<article>" + "<p>ab" * 20_000 + "</article>")
    nested = webtext.blocks_of("<main>" + "<div>x" * 20_000)
    begun = time.perf_counter()
    webtext.train([*usual, (dense, [1] * len(dense)), (nested, [1] * len(nested))], webtext.Extraction(rounds=20))
    assert time.perf_counter() - begun < 60


def small_field(seed, n_blocks=5):
    draw = np.random.default_rng(seed)
    page = "".join(f"<{t}>{w}" for t, w in zip(draw.choice(["p", "li", "nav", "h1"], n_blocks), draw.choice(["A b.", "12 3", "x", "© y"], n_blocks), strict=True))
    blocks = webtext.blocks_of(page)
    seen = webtext.describe(blocks)
    index = {f: i for i, f in enumerate(sorted({f for a in seen for f in a}))}
    return blocks, seen, webtext.Model(index, draw.normal(size=(len(index), 2)), draw.normal(size=(2, 2)))


def value(model, seen, labels):
    emit = sum(model.weights[model.index[f], y] for a, y in zip(seen, labels, strict=True) for f in a)
    return emit + sum(model.steps[a, b] for a, b in zip(labels, labels[1:], strict=False))


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_and_gradient_equal_enumeration(seed):
    from itertools import product

    blocks, seen, model = small_field(seed)
    every = list(product((0, 1), repeat=len(blocks)))
    assert model.labels(blocks) == list(max(every, key=lambda y: value(model, seen, y)))
    longer, more, _ = small_field(seed + 100, 7)
    index = {f: i for i, f in enumerate(sorted({f for a in seen + more for f in a}))}
    draw = np.random.default_rng(seed)
    model = webtext.Model(index, draw.normal(size=(len(index), 2)), draw.normal(size=(2, 2)))
    pages = [(seen, [int(x) for x in draw.integers(0, 2, len(seen))]), (more, [int(x) for x in draw.integers(0, 2, len(more))])]

    def likelihood():
        return sum(value(model, s, y) - np.logaddexp.reduce([value(model, s, z) for z in product((0, 1), repeat=len(s))]) for s, y in pages)

    total, by_weight, by_step = webtext.batch_of(pages, index).likelihood(model.weights, model.steps)
    assert total == pytest.approx(likelihood())
    for table, gradient in ((model.weights, by_weight), (model.steps, by_step)):
        for at in np.ndindex(*table.shape):
            kept = table[at]
            table[at] = kept + 1e-5
            high = likelihood()
            table[at] = kept - 1e-5
            assert gradient[at] == pytest.approx((high - likelihood()) / 2e-5, abs=1e-5)
            table[at] = kept


# --- pipeline: any column names ----------------------------------------------------------

CLASHES = ["n_words", "score", "findings", "_h1", "_text", "predicted", "redacted", "_own0", "a.b"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame(
        [(9001, None, None, None, None), (None, "", None, "x", 0)], "doc_id long, text string, lang string, source string, n_chars long").select(*docs.columns))
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, docs, SF)
        got = stage(spark, wide, SF)
        assert plain.columns == docs.columns and got.columns == wide.columns, name
        rows = got.collect()
        assert Counter(tuple(r)[:len(docs.columns)] for r in rows) == Counter(map(tuple, plain.collect())), name
        for r in rows:
            mine = "none" if r["doc_id"] is None else str(r["doc_id"])
            assert list(r)[len(docs.columns):] == [f"{c} {mine}" for c in CLASHES], name
        assert stage(spark, wide.limit(0), SF).count() == 0, name
    mixed = corpus_pipeline.STAGES[-1][1](spark, wide, SF)
    assert mixed.count() == wide.count()
