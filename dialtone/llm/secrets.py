"""Secret scan: candidate strings, then a random forest that removes false positives.

Native: every step is a DataFrame expression. Candidates are runs of at least 16
characters of ``[A-Za-z0-9+/_-]``, values right after an announcing word with ``=`` or
``:`` (quoted or bare, 6 characters or more, of any kind but spaces) and passwords of
4 characters or more between ``://user:`` and ``@``. The text is split at them; a candidate's context is
the text right before and after it, other candidates included, as a long variable name
is one itself. The forest looks at the candidate's length, its character transitions,
how far a dictionary covers it, the path and the neighbouring words. It is trained on labelled findings by Spark ML and then written
out as an expression over constant arrays of its nodes, evaluated inside the array of
candidates: a scan is a single pass without a shuffle, and no row meets Python.

Words and letter pairs are counted over all documents: the ``dictionary`` most frequent
words and the ``pairs`` usual pairs. The contexts of labelled findings come from a bounded
sample: ``sample_rows`` documents drawn by a hash, ``most_findings`` at most.

Nulls and empty texts have no candidates; a null path counts as empty. A candidate
that repeats is judged at each place. Without both labels the forest is absent and
every candidate counts as a secret (score 1). Input columns named like a result
column give way to it. Texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, settle

_ANNOUNCING = r"(?i:token|secret|passw(?:or)?d|pwd|passphrase|api.?key|access.?key|private.?key|credentials?|authorization)"
_SET = _ANNOUNCING + r"[\w.\-]{0,24}[\"'\]]{0,2}[ \t]{0,3}[=:]{1,2}>?[ \t]{0,3}(?:(?i:bearer|basic|token) )?"
_URL_USER = r"://[^\s:/@]{0,100}:"
_LONG = r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}+={0,2}"
#: Follows from ``_SET``. A look back tries all its lengths, so this short one goes before the long one.
_NEAR = r"[=:][> \t]{0,4}(?:[A-Za-z]{5,6} )?"
#: The first looks back of each kind are cheap and fail at most places.
CANDIDATE = "|".join((
    rf"(?<=[\"'`])(?<={_NEAR}[\"'`])(?<={_SET}[\"'`])(?:(?<=\")[^\s\"]{{6,}}+|(?<=')[^\s']{{6,}}+|(?<=`)[^\s`]{{6,}}+)",
    rf"(?<=[=:> \t])(?<={_NEAR})(?<={_SET})(?!(?i:bearer|basic|token) )[^\s\"'`=:>][^\s\"'`]{{4,}}[^\s\"'`,;.)\]}}]",
    rf"(?<=:)(?<={_URL_USER})[^\s@/\"'`]{{4,}}+(?=@)",
    _LONG))
SHORTEST = 4   # characters of a candidate, at least
MASK = "[SECRET]"
_CHANGES = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
_KEYWORD = r"(?i)(token|secret|passw(or)?d|passwd|api.?key|access.?key|private.?key|credential|authorization|bearer)"
_HARMLESS = r"(?i)(commit|sha-?1|sha-?256|md5|checksum|digest|etag|uuid|revision|build|version|integrity)"
_ASSIGNED = r"[=:]\s*[\"'`]?$"
_TEST_PATH = r"(?i)(test|example|sample|fixture|docs?/|mock|\.lock$|\.md$|\.svg$|min\.js$)"
_CONFIG_PATH = r"(?i)(\.env|conf|\.cfg|\.ini|\.ya?ml|\.properties|settings|secret|deploy)"
_PREFIX = r"^(AKIA|ASIA|gh[pousr]_|xox[abps]-|sk_live_|sk-|AIza|glpat-|eyJ)"
_CODE = r"^[A-Za-z_][\w.]*[(\[.]|^[$<{%*]"
_NO_VALUE = r"(?i)^(none|null|true|false|string|required|optional|undefined|passw(or)?d|secret|hidden|default|missing|empty)\W*$"
_PLACEHOLDER = r"(?i)(example|placeholder|your[_-]|xxxx|change.?me|dummy|0000000|1234567|redacted)"


@dataclass(frozen=True)
class SecretScan:
    sample_rows: int = 1_500
    most_findings: int = 10_000
    dictionary: int = 300
    pairs: int = 150
    trees: int = 20
    depth: int = 6
    threshold: float = 0.5
    before: int = 40
    after: int = 20


@dataclass(frozen=True)
class Vocabulary:
    words: tuple[str, ...]
    pairs: tuple[str, ...]


@dataclass(frozen=True)
class Model:
    params: SecretScan
    vocabulary: Vocabulary
    #: Per tree a leaf (float) or (feature, threshold, tree up to it, tree above it).
    trees: tuple


def features(value: Column, before: Column, after: Column, path: Column, vocabulary: Vocabulary) -> list[Column]:
    """What the forest looks at, in a fixed order."""
    n = F.length(value).cast("double")
    low = F.lower(value)
    one = lambda text, pattern: F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False)).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    usual = F.lit(0.0)
    if vocabulary.pairs:
        usual = F.regexp_count(low, F.lit("(?=" + "|".join(vocabulary.pairs) + ")")) / n
    covered = F.lit(0.0)
    if vocabulary.words:
        longest_first = "|".join(sorted(vocabulary.words, key=lambda w: (-len(w), w)))
        covered = F.lit(1.0) - F.length(F.regexp_replace(low, longest_first, "")) / n
    return [
        n, share("[0-9]"), share("[A-Z]"), share("[a-z]"), share(r"[+/_\-=]"),
        share(_CHANGES), usual, F.size(F.array_distinct(F.split(value, ""))) / n,
        covered, F.array_max(F.transform(F.split(value, "[^A-Za-z]+"), F.length)) / n,
        one(value, "^[0-9a-f]+$"), one(value, "^[0-9]+$"), one(value, _PREFIX), one(value, _PLACEHOLDER),
        one(path, _TEST_PATH), one(path, _CONFIG_PATH),
        one(before, _KEYWORD), one(before, _HARMLESS), one(before, _ASSIGNED), one(after, "^[\"'`]"),
        one(before, _SET + "[\"'`]?$"), one(before, _URL_USER + "$"), share(r"[^A-Za-z0-9+/_\-=]"),
        one(value, _CODE), one(value, _NO_VALUE),
    ]


def learn_vocabulary(docs: DataFrame, text: str, params: SecretScan) -> Vocabulary:
    """The most frequent words of three letters or more and pairs of letters in ``docs``."""
    words = settle(docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}+"), 0)).alias("w"))
                   .where(F.length("w") < 16).groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    top = words.orderBy(F.desc("n"), "w").limit(params.dictionary).collect()
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substr("w", i, F.lit(2))))
    pairs = (words.select(pair.alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "p").limit(params.pairs).collect())
    return Vocabulary(tuple(r["w"] for r in top), tuple(r["p"] for r in pairs))


def fit(findings: DataFrame, vocabulary: Vocabulary, params: SecretScan = SecretScan()) -> Model:
    """Train on ``findings`` (value, before, after, path, label 1 for a secret)."""
    known = findings.where(F.col("value").isNotNull() & F.col("label").isin(0, 1) & (F.length("value") > 0))
    known = known.select("value", F.coalesce("before", F.lit("")).alias("before"),
                         F.coalesce("after", F.lit("")).alias("after"), F.coalesce("path", F.lit("")).alias("path"),
                         F.col("label").cast("double").alias("label"))
    columns = features(*(F.col(c) for c in ("value", "before", "after", "path")), vocabulary)
    names = [f"f{i}" for i in range(len(columns))]
    drawn = hash_share(F.col("value"), F.col("before"), salt="finding").alias("drawn")
    table = settle(known.select("label", drawn, *[c.cast("double").alias(n) for c, n in zip(columns, names, strict=True)]))
    counts = table.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    if counts[1] < 2:
        return Model(params, vocabulary, ())
    bounded = table.where(F.col("drawn") < params.most_findings / counts[0]).orderBy("label", "drawn", *names)
    table = settle(VectorAssembler(inputCols=names, outputCol="features").transform(bounded).select("label", "features").coalesce(1))
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=params.trees,
                                    maxDepth=params.depth, seed=11).fit(table)
    return Model(params, vocabulary, tuple(_tree(t._java_obj.rootNode()) for t in forest.trees))


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats) if sum(stats) else float(node.prediction())
    split = node.split()
    return (split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild()))


def _score(model: Model, x: Column) -> Column:
    """Mean leaf value of the trees for the feature array ``x``. The nodes stand in constant
    arrays; a walk goes from node to node, ``depth`` steps at most."""
    index, at, low, high, value, roots = [], [], [], [], [], []

    def add(t) -> int:
        i = len(index)
        for column in (index, at, low, high, value):
            column.append(-1 if column is index else 0)
        if isinstance(t, float):
            value[i] = t
        else:
            index[i], at[i] = t[0], t[1]
            low[i], high[i] = add(t[2]), add(t[3])
        return i

    roots = [add(t) for t in model.trees]
    if not roots:
        return F.lit(1.0)
    fixed = lambda column, kind: F.split(F.lit(",".join(map(repr, column))), ",").cast(f"array<{kind}>")
    feature, bound, left, right = fixed(index, "int"), fixed(at, "double"), fixed(low, "int"), fixed(high, "int")
    leaf = fixed(value, "double")
    walk = lambda root: F.aggregate(F.sequence(F.lit(1), F.lit(model.params.depth)), root, lambda i, _: (
        F.when(feature[i] < 0, i).when(x[feature[i]] <= bound[i], left[i]).otherwise(right[i])))
    total = F.aggregate(fixed(roots, "int"), F.lit(0.0), lambda sum_, root: sum_ + leaf[walk(root)])
    return total / F.lit(float(len(roots)))


RESULTS = ("n_candidates", "n_secrets", "findings", "redacted")


def scan(docs: DataFrame, model: Model, text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with candidates and secrets counted, the findings (code-point offsets, value,
    score) and the text with every secret replaced by ``[SECRET]``."""
    params = model.params
    kept = [c for c in docs.columns if c.lower() not in RESULTS]
    body = F.coalesce(F.col(text), F.lit(""))
    where = F.coalesce(F.col(path).cast("string"), F.lit(""))
    cut = docs.select(*kept, F.split(body, CANDIDATE, -1).alias("_parts"),
                      F.regexp_extract_all(body, F.lit(CANDIDATE), 0).alias("_found"), where.alias("_path"))

    # texts and candidates in turn, cut to what a context can hold of them; so many candidates
    # on a side fill a context whatever stands between them
    def in_turn(side, most: int) -> Column:
        return F.flatten(F.zip_with("_parts", "_found", lambda part, value: F.array(
            side(part, F.lit(most)), side(F.coalesce(value, F.lit("")), F.lit(most)))))

    cut = cut.select("*", in_turn(F.right, params.before).alias("_ends"), in_turn(F.left, params.after).alias("_starts"))
    back, ahead = (2 * -(-most // SHORTEST) for most in (params.before, params.after))

    def seen(value: Column, i: Column) -> Column:
        first = F.greatest(2 * i + 1 - back, F.lit(1))
        before = F.array_join(F.slice("_ends", first, 2 * i + 2 - first), "")
        after = F.array_join(F.slice("_starts", 2 * i + 3, F.lit(ahead + 1)), "")
        around = features(value, F.right(before, F.lit(params.before)), F.left(after, F.lit(params.after)),
                          F.col("_path"), model.vocabulary)
        return F.struct(value.alias("value"), F.array(*[c.cast("double") for c in around]).alias("x"))

    judged = cut.withColumn("_seen", F.transform("_found", seen))
    judged = judged.withColumn("_seen", F.transform("_seen", lambda c: F.struct(
        c["value"].alias("value"), _score(model, c["x"]).alias("score"))))
    secret = lambda x: x["score"] >= params.threshold
    # one pass along the text; the list of findings is copied only where one is added
    kind = "array<struct<start:int,end:int,value:string,score:double>>"
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(kind).alias("found"))
    steps = F.zip_with(F.slice("_parts", 1, F.size("_seen")), "_seen", lambda part, x: F.struct(
        F.length(part).alias("skip"), x["value"].alias("value"), x["score"].alias("score")))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["skip"]
        end = begin + F.length(x["value"])
        one = F.array(F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"), x["score"].alias("score")))
        return F.struct(end.alias("at"), F.when(secret(x), F.concat(F.coalesce(acc["found"], F.array().cast(kind)), one))
                        .otherwise(acc["found"]).alias("found"))

    walked = F.aggregate(steps, start, step, lambda acc: F.coalesce(acc["found"], F.array().cast(kind)))
    pieces = F.zip_with("_parts", "_seen", lambda part, x: F.concat(
        F.coalesce(part, F.lit("")), F.when(x.isNull(), F.lit("")).when(secret(x), F.lit(MASK)).otherwise(x["value"])))
    return judged.select(
        *kept, F.size("_seen").cast("long").alias("n_candidates"),
        F.size(F.filter("_seen", secret)).cast("long").alias("n_secrets"), walked.alias("findings"),
        F.when(F.col(text).isNotNull(), F.array_join(pieces, "")).alias("redacted"))


#: Where training findings stand: a path and the words before them. Fixed values.
_SECRET_PLACES = [("config/settings.py", "api_key = \""), ("deploy/prod.env", "SECRET_TOKEN="), ("src0", "token = \""),
                  ("src1", "TOKEN = \""), ("app/main.js", "password: '"), ("infra/values.yaml", "access_key: ")]
_PLAIN_PLACES = [("package.lock", "integrity: "), ("CHANGES.md", "commit "), ("src2", "md5 "), ("src3", "checksum="),
                 ("tests/data.json", "uuid: \""), ("src4", "")]
#: Ends of variable names that are candidates themselves.
_SECRET_NAMES = [("deploy/prod.env", "_SECRET_ACCESS_KEY="), ("config/settings.py", "_DATABASE_API_TOKEN = \""),
                 ("src0", "_client_secret_value: '"), ("infra/values.yaml", "_service_access_token: "),
                 ("src1", "_ADMIN_PASSWORD_PROD=\""), ("app/main.js", "_private_key_passphrase = '")]
_PLAIN_NAMES = [("package.lock", "_RELEASE_CHECKSUM_SHA256="), ("CHANGES.md", "_last_known_good_commit: "),
                ("src2", "_expected_md5_digest = \""), ("src3", "_BUILD_REVISION_NUMBER="),
                ("tests/data.json", "_request_correlation_uuid: \""), ("src4", "_artifact_content_digest = '")]
#: What stands in the place of a password and is none.
_NO_PASSWORDS = ["changeme", "password", "required", "undefined", "os.environ[", "getpass.getpass(", "${PASSWORD}", "<password>",
                 "********", "your-password", "xxxxxxxx", "args.password", "config.get(", "Optional[str]", "placeholder",
                 "string", "{{password}}", "%(password)s"]
_URLS = ["postgres://app:", "https://admin:", "redis://:", "mysql://root:", "amqp://worker:", "mongodb://svc:"]


def labelled_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Labelled findings made from ``docs``: random keys of several forms set after words
    that announce a secret, also at the end of long names, and passwords of several forms
    there and in URLs (label 1); placeholders and code in their place, digests after harmless
    words and names, the names themselves, plain numbers, placeholders, joined words of the
    text and its own long words (label 0)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digest = F.sha2(key.cast("binary"), 512)
    base64 = F.regexp_replace(F.base64(F.unhex(digest)), "=+$", "")
    words = F.slice(F.regexp_extract_all(F.coalesce(F.lower(text), F.lit("")), F.lit("[a-z]{3,}+"), 0), 1, 8)
    n = F.pmod(F.xxhash64(key), F.lit(6)).cast("int")
    tail = F.substring(digest, 1, 3)

    word = F.coalesce(F.get(words, F.lit(0)), F.lit(""))

    bare_path = F.coalesce(F.col(path).cast("string"), F.lit(""))

    def place(table: list[tuple[str, str]], joiner: str = " ") -> tuple[Column, Column]:
        at = lambda k: F.array(*[F.lit(row[k]) for row in table])[n]
        return at(0), F.concat(word, F.lit(joiner), at(1))

    def row(value: Column, where: tuple[Column, Column], after: str | Column, label: int) -> Column:
        return F.struct(value.alias("value"), where[1].alias("before"), (after if isinstance(after, Column) else F.lit(after)).alias("after"),
                        where[0].alias("path"), F.lit(label).alias("label"))

    def name(where: tuple[Column, Column]) -> Column:
        own = F.regexp_extract(where[1], CANDIDATE, 0)
        rest = F.concat(F.substr(where[1], F.length(own) + 1), F.substring(digest, 1, 20))
        return row(own, (where[0], F.lit("export ")), F.left(rest, F.lit(20)), 0)

    # passwords: random, of a word with digits and signs, of a word in other spelling
    digits = F.translate(F.substring(digest, 50, 4), "abcdef", "012345")
    sign = F.array(*map(F.lit, "&!#$@%"))[n]
    stem = F.left(F.coalesce(F.get(words, F.lit(1)), F.lit("summer")), F.lit(9))
    random8 = F.concat(F.substring(base64, 5, 5), sign, F.substring(base64, 11, 4))
    passwords = [
        random8, F.substring(base64, 15, 10), F.concat(F.initcap(stem), F.left(digits, F.lit(2)), sign, F.right(digits, F.lit(1))),
        F.concat(F.translate(F.initcap(stem), "aeio", "4310"), sign, F.right(digits, F.lit(2))), F.concat(stem, digits),
    ]
    other = lambda k: F.array(*map(F.lit, _NO_PASSWORDS))[n + 6 * k]
    url = (bare_path, F.concat(word, F.lit(" "), F.array(*map(F.lit, _URLS))[n]))
    in_url = F.regexp_replace(F.array(*passwords)[F.pmod(n, F.lit(5))], "[@/]", "x")

    secret, plain = place(_SECRET_PLACES), place(_PLAIN_PLACES)
    secret_name, plain_name = place(_SECRET_NAMES, ""), place(_PLAIN_NAMES, "")
    bare = (bare_path, F.concat(F.array_join(words, " "), F.lit(" ")))
    made = [
        row(F.substring(digest, 1, 40), secret, "\" the", 1), row(F.substring(digest, 41, 32), secret, "\"", 1),
        row(F.substring(base64, 1, 32), secret, "'", 1), row(F.substring(base64, 33, 40), secret, " and", 1),
        row(F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 5, 16))), bare, " ", 1),
        row(F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(base64, "[+/]", "x"), 1, 36)), bare, " ", 1),
        row(F.substring(digest, 1, 40), plain, " the", 0), row(F.substring(digest, 9, 64), plain, "\"", 0),
        row(F.translate(F.substring(digest, 1, 16), "abcdef", "012345"), bare, " ", 0),
        row(F.concat(F.lit("your_api_key_"), tail), secret, "\"", 0), row(F.lit("xxxxxxxxxxxxxxxxxxxxxxxx"), secret, "\"", 0),
        row(F.array_join(F.slice(words, 1, 4), "_"), secret, "(", 0), row(F.array_join(F.slice(words, 3, 5), "-"), bare, " ", 0),
        row(F.array_join(F.slice(words, 2, 5), "/"), bare, " ", 0),
        row(F.substring(digest, 21, 40), secret_name, "\" the", 1), row(F.substring(digest, 61, 32), secret_name, "", 1),
        row(F.substring(base64, 9, 40), secret_name, "'", 1), name(secret_name), name(plain_name),
        row(F.substring(digest, 41, 40), plain_name, "", 0), row(F.substring(digest, 11, 64), plain_name, "\"", 0),
        *[row(value, where, "\"", 1) for value, where in zip(passwords, (secret, secret_name, secret, secret_name, secret), strict=True)],
        row(in_url, url, "@db.local", 1), row(other(0), url, "@db.local", 0), row(F.get(words, F.lit(2)), url, "@", 0),
        row(other(0), secret, "\"", 0), row(other(1), secret_name, " ", 0), row(other(2), secret, "", 0),
        row(F.get(words, F.lit(3)), secret, " ", 0), row(F.get(words, F.lit(4)), secret_name, "\"", 0),
        row(F.concat_ws("_", F.get(words, F.lit(5)), F.get(words, F.lit(6))), secret, ",", 0),
        row(F.concat(F.get(words, F.lit(6)), F.lit("("), F.get(words, F.lit(7))), secret, ")", 0),
    ]
    own = F.transform(F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CANDIDATE), 0),
                               lambda v: F.regexp_like(v, F.lit("^[A-Za-z]+$"))),
                      lambda v: F.struct(v.alias("value"), F.lit("the ").alias("before"), F.lit(" ").alias("after"),
                                         bare[0].alias("path"), F.lit(0).alias("label")))
    found = docs.select(F.explode(F.concat(F.array(*made), F.slice(own, 1, 6))).alias("x")).select("x.*")
    short = F.regexp_like("before", F.lit(f"({_SET}[\"'`]?|{_URL_USER})$")) & (F.length("value") >= 6)
    return found.where((F.length("value") >= 16) | short)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source",
          params: SecretScan = SecretScan()) -> Model:
    """A model for ``docs``: the vocabulary of all of them, labelled findings from a bounded sample."""
    total = docs.count()
    share = min(1.0, params.sample_rows / max(1, total))
    drawn = hash_share(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), salt="secrets")
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(path).alias("source")).where(drawn < share)
    return fit(labelled_findings(sample), learn_vocabulary(docs, text, params), params)
