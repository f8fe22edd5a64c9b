"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut at block-level tags into leaf blocks. Each block is described by its
ancestors' tags, their class, id and role words, and by its text; the field scores the
two labels (article, rest) of every block together with those of its neighbours, and
Viterbi picks the best labelling. Blocks labelled article are the text.

What a page never shows (head, scripts, styles, comments and other markup) is no block.
Character references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined by a blank line. Nothing else is dropped and nothing is capped.

Training pages: a bounded sample of ``sample`` pages among those with an article or main
element. Their blocks are labelled by the page's own sectioning (article or main against
nav, header, footer, aside, form and the like); pages without it say nothing about labels
and are read only. Under ``least`` pages, built-in ones fill up. Each page is also relabelled in ``variants`` dresses that carry the same blocks
under div and class names of common kinds, with sidebars, notices, comments and forms
added, so that the field does not lean on one kind of markup. The driver holds the
sample only, of pages under ``longest`` characters, and of each page at most ``window``
blocks that follow one another; every page of any length is read, whole.

Reading is linear in a page's length: blocks share their ancestors as a linked path, a
path's features stand where they first occur on it, and the end of a tag is looked up
among the page's quotes and angle brackets, each resolved once.

Nulls: a null or empty page has no text; a page without article blocks gives an empty
text. Repeated pages are read row by row. Clashing input columns give way to results.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, hash_share

FIELDS = [T.StructField("main_text", T.StringType()), T.StructField("n_blocks", T.IntegerType()),
          T.StructField("n_article", T.IntegerType())]

#: Elements that part blocks (fixed values of HTML).
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
    pre search section select summary table tbody td textarea tfoot th thead tr ul""".split())
#: Elements whose content is no text of the page.
HIDDEN_TAGS = ("script", "style", "noscript", "template", "title", "head", "svg", "iframe", "object")
#: An opening tag that ends an open element of the same kind.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_CLOSING = re.compile("[>\"']")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Extraction:
    sample: int = 300
    least: int = 20
    longest: int = 200_000
    window: int = 256          # blocks of a page that are trained on
    features: int = 50_000     # of a page, about
    variants: int = 3
    rounds: int = 150
    rate: float = 0.1
    decay: float = 1e-3
    seed: int = 3


class Path:
    """An open element and its ancestors; ``fresh`` are the features that no ancestor has."""
    __slots__ = ("tag", "names", "above", "fresh", "score")

    def __init__(self, tag: str, names: tuple[str, ...], above: Path | None, fresh: tuple[str, ...]):
        self.tag, self.names, self.above, self.fresh, self.score = tag, names, above, fresh, None

    def up(self) -> list[Path]:
        """From the outermost ancestor to the element itself."""
        out, at = [], self
        while at is not None:
            out.append(at)
            at = at.above
        return out[::-1]


def path_of(tags: tuple[str, ...], names: tuple[str, ...]) -> Path | None:
    """A path of plain tags whose innermost element has all the names."""
    at, seen = None, set()
    for i, tag in enumerate(tags):
        own = names if i == len(tags) - 1 else ()
        fresh = tuple(f for f in dict.fromkeys([f"in {tag}", *(f"name {w}" for w in own)]) if f not in seen)
        seen.update(fresh)
        at = Path(tag, own, at, fresh)
    return at


@dataclass
class Block:
    text: str
    path: Path | None
    linked: int               # characters inside links

    @property
    def tags(self) -> tuple[str, ...]:
        """Of the ancestors, outermost first."""
        return tuple(p.tag for p in self.path.up()) if self.path else ()

    @property
    def names(self) -> tuple[str, ...]:
        """Words of their class, id and role."""
        return tuple(n for p in self.path.up() for n in p.names) if self.path else ()


class TagEnds:
    """Where the tags of a page end: the next ``>`` outside quotes."""

    def __init__(self, page: str):
        self.page = page
        self.marks = [m.start() for m in _CLOSING.finditer(page)]
        self.angles = [i for i in self.marks if page[i] == ">"]
        self.known: dict[int, int] = {}  # place among the marks, read outside quotes -> the tag's end or -1
        same: dict[str, int] = {}
        self.partner = [-1] * len(self.marks)  # the next mark of the same kind
        for i in range(len(self.marks) - 1, -1, -1):
            kind = page[self.marks[i]]
            self.partner[i] = same.get(kind, -1)
            same[kind] = i

    def after(self, at: int) -> int:
        """The place of the ``>`` that ends a tag read from ``at`` on, -1 if none does."""
        i = bisect_left(self.marks, at)
        trail = []
        while i < len(self.marks) and i not in self.known and self.page[self.marks[i]] != ">":
            trail.append(i)
            i = self.partner[i] + 1 if self.partner[i] >= 0 else len(self.marks)
        end = self.known.get(i, self.marks[i] if i < len(self.marks) and self.page[self.marks[i]] == ">" else -1)
        for j in trail:
            self.known[j] = end
        return end

    def angle(self, at: int) -> int:
        i = bisect_left(self.angles, at)
        return self.angles[i] if i < len(self.angles) else -1


def tokens_of(page: str):
    """(start, end, name, whether it closes, attributes) of tags; comments and the like have no name."""
    ends = TagEnds(page)
    at = page.find("<")
    while at >= 0:
        end, name, closes, rest = -1, "", False, ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
        else:
            tag = _TAG.match(page, at)
            last = ends.after(tag.end()) if tag else -1
            if last >= 0:
                end, name, closes, rest = last + 1, tag[2].lower(), bool(tag[1]), page[tag.end():last]
            elif page[at + 1:at + 2] in ("!", "?", "/"):
                end = ends.angle(at + 2) + 1 or -1
        if end >= 0:
            skip = yield at, end, name, closes, rest
            end = skip or end
        at = page.find("<", end if end >= 0 else at + 1)


def blocks_of(page: str) -> list[Block]:
    """The page's leaf blocks that have text, in page order."""
    out: list[Block] = []
    stack: list[Path] = []
    places: dict[str, list[int]] = {}   # of open elements in the stack, by tag
    active: dict[str, int] = {}         # how many open elements have a feature
    parts: list[str] = []
    linked = 0
    in_link = 0

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, stack[-1] if stack else None, linked))
            parts.clear()
        linked = 0

    def own_features(path: Path) -> list[str]:
        return list(dict.fromkeys([f"in {path.tag}", *(f"name {w}" for w in path.names)]))

    def close(tag: str) -> None:
        if not places.get(tag):
            return
        first = places[tag][-1]
        while len(stack) > first:
            gone = stack.pop()
            places[gone.tag].pop()
            for f in own_features(gone):
                active[f] -= 1

    at = 0
    tokens = tokens_of(page)
    token = next(tokens, None)
    while True:
        text = page[at:token[0] if token else len(page)]
        if text:
            parts.append(text)
            linked += len(text) * (in_link > 0)
        if not token:
            break
        _, at, tag, closes, rest = token
        skip = None
        if tag in HIDDEN_TAGS:
            if tag != "head" and not closes and not rest.endswith("/"):
                gone = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                skip = at = gone.end() if gone else len(page)
        elif tag == "a":
            in_link = 0 if closes else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK_TAGS:
            close_block()
            if closes or tag in SELF_CLOSING and stack and stack[-1].tag == tag:
                close(tag)
                in_link = 0
            if not closes and tag != "hr":
                names = tuple(w for m in _NAMED.finditer(rest) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()))
                path = Path(tag, names, stack[-1] if stack else None, ())
                own = own_features(path)
                path.fresh = tuple(f for f in own if not active.get(f))
                for f in own:
                    active[f] = active.get(f, 0) + 1
                places.setdefault(tag, []).append(len(stack))
                stack.append(path)
        try:
            token = tokens.send(skip)
        except StopIteration:
            token = None
    close_block()
    return out


def own_features(blocks: list[Block], i: int) -> set[str]:
    """The features of a block besides those of its path."""
    b = blocks[i]
    words = b.text.split(" ")
    n = len(b.text)
    active = {"bias", f"words {min(8, int(math.log2(len(words) + 1)))}", f"linked {min(4, 4 * b.linked // n)}",
              f"stops {min(3, sum(w[-1:] in '.!?' for w in words))}"}
    if b.path:
        active.add(f"tag {b.path.tag}")
    for name, holds in (("sign", b.text[0] in "©®→«»|·"), ("digits", 4 * sum(map(str.isdigit, b.text)) > n),
                        ("first", i == 0), ("last", i == len(blocks) - 1), ("upper", b.text.isupper())):
        if holds:
            active.add(name)
    return active


def describe(blocks: list[Block], first: int = 0, last: int | None = None) -> list[list[str]]:
    """The active features of the blocks from ``first`` to before ``last``."""
    return [sorted(own_features(blocks, i) | {f for p in (blocks[i].path.up() if blocks[i].path else ()) for f in p.fresh})
            for i in range(first, len(blocks) if last is None else last)]


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray        # features x 2
    steps: np.ndarray          # from label, to label

    def labels(self, blocks: list[Block]) -> list[int]:
        """Viterbi; 1 is article. Ties go to the rest."""
        if not blocks:
            return []
        scores = [[a + b for a, b in zip(self._sum(own_features(blocks, i)), self._of_path(b.path), strict=True)]
                  for i, b in enumerate(blocks)]
        (aa, ab), (ba, bb) = self.steps.tolist()
        rest, article = scores[0]
        back = []
        for r, a in scores[1:]:
            to_rest, to_article = (rest + aa, article + ba), (rest + ab, article + bb)
            back.append((int(to_rest[1] > to_rest[0]), int(to_article[1] > to_article[0])))
            rest, article = max(to_rest) + r, max(to_article) + a
        path = [int(article > rest)]
        for choice in reversed(back):
            path.append(choice[path[-1]])
        return path[::-1]

    def _sum(self, features) -> list[float]:
        if not hasattr(self, "_plain"):  # per worker: plain numbers by feature
            self._plain = dict(zip(self.index, self.weights[list(self.index.values())].tolist(), strict=True)) if self.index else {}
        rest = article = 0.0
        for f in sorted(features):
            if f in self._plain:
                r, a = self._plain[f]
                rest, article = rest + r, article + a
        return [rest, article]

    def _of_path(self, path: Path | None) -> list[float]:
        """Scores of the path's features; every element adds its own to its parent's once."""
        todo = []
        while path is not None and path.score is None:
            todo.append(path)
            path = path.above
        total = path.score if path is not None else [0.0, 0.0]
        for element in reversed(todo):
            total = element.score = [a + b for a, b in zip(total, self._sum(element.fresh), strict=True)] if element.fresh else total
        return total

    def extract(self, page: str) -> tuple[str, int, int]:
        blocks = blocks_of(page)
        kept = [b.text for b, label in zip(blocks, self.labels(blocks), strict=True) if label]
        return "\n\n".join(kept), len(blocks), len(kept)


_ARTICLE = frozenset(("article", "main"))
_REST = frozenset("nav header footer aside form menu button select fieldset dialog".split())
_REST_NAMES = frozenset("""ad ads advert advertisement banner breadcrumb comment comments cookie footer menu modal nav
    navigation newsletter notice popup promo related share sidebar social sponsored subscribe toolbar widget""".split())


def silver(blocks: list[Block]) -> list[int]:
    """Labels by the page's own sectioning; the innermost section decides."""
    known: dict[int, tuple[str, bool]] = {}   # by path: the innermost section's tag, and whether a name says rest

    def section(path: Path | None) -> tuple[str, bool]:
        todo = []
        while path is not None and id(path) not in known:
            todo.append(path)
            path = path.above
        tag, rest = known[id(path)] if path is not None else ("", False)
        for element in reversed(todo):
            tag = element.tag if element.tag in _ARTICLE or element.tag in _REST else tag
            rest = rest or not _REST_NAMES.isdisjoint(element.names)
            known[id(element)] = tag, rest
        return tag, rest

    return [int(tag in _ARTICLE and not rest) for tag, rest in (section(b.path) for b in blocks)]


#: Names that common templates give their parts (fixed values).
_BODIES = [("div", ("content",)), ("div", ("post", "body")), ("section", ("entry", "content")), ("div", ("article", "text")), ("main", ())]
_MENUS = [("div", ("menu",)), ("ul", ("navigation",)), ("div", ("nav", "bar")), ("header", ()), ("div", ("breadcrumb",))]
_FOOTS = [("div", ("footer",)), ("footer", ()), ("div", ("site", "info")), ("div", ("copyright",))]
_EXTRAS = [("aside", ()), ("div", ("sidebar",)), ("div", ("cookie", "notice")), ("div", ("comments",)), ("form", ()),
           ("div", ("ad",)), ("div", ("related",)), ("div", ("comment", "body")), ("div", ("newsletter", "subscribe")),
           ("section", ("comments",)), ("div", ("share", "social")), ("div", ("advert",))]


def redressed(blocks: list[Block], labels: list[int], draw: random.Random) -> tuple[list[Block], list[int]]:
    """The same blocks under other markup, with extra parts that are no article."""
    body, menu, foot = draw.choice(_BODIES), draw.choice(_MENUS), draw.choice(_FOOTS)
    texts = [b.text for b, label in zip(blocks, labels, strict=True) if label]
    out, marks, begun = [], [], False

    def extra(count: int) -> None:
        for tag, names in draw.sample(_EXTRAS, count):
            for _ in range(draw.randint(1, 3)):
                text = draw.choice(texts) if texts else "more"
                words = text.split(" ")
                cut = " ".join(words[:draw.randint(1, len(words))])
                inner = draw.choice(("p", "li", "div"))
                out.append(Block(cut, path_of(("html", "body", tag, inner), names), draw.choice((0, 0, len(cut)))))
                marks.append(0)

    for b, label in zip(blocks, labels, strict=True):
        if label and not begun:
            begun = True
            extra(draw.randint(0, 2))
        tag, names = body if label else foot if begun else menu
        own = b.path.tag if b.path and b.path.tag in ("p", "li", "h1", "h2", "h3") else tag
        out.append(Block(b.text, path_of(("html", "body", tag) + ((own,) if own != tag else ()), names), b.linked))
        marks.append(label)
        if begun and not label:
            extra(draw.randint(0, 1))
    extra(draw.randint(0, 2))
    return out, marks


#: Words of built-in pages (fixed values).
_PROSE = """the a of and to in that it was for on with as at by from this which had were their after before while
    council river market school report water people evening street winter village harvest railway garden letter
    found carried opened closed reached measured wrote described crossed repaired long early local small open late""".split()
_LINKS = ["Home", "About us", "Contact", "Log in", "Sign up", "Search", "Archive", "Topics", "Next page", "Help", "World", "Sport"]
_NOTICES = ["© 2020 All rights reserved", "Terms of use | Privacy", "Follow us", "© Example Ltd.", "Imprint", "Powered by a template"]


def built_in(draw: random.Random) -> tuple[list[Block], list[int]]:
    """A made page: links, a headed article of paragraphs, list items and short lines, notices."""
    def sentence() -> str:
        words = [draw.choice(_PROSE) for _ in range(draw.randint(3, 22))]
        return " ".join([words[0].capitalize(), *words[1:]]) + draw.choice("....?!")

    menu = [Block(t, path_of(("html", "body", "nav", "li"), ()), len(t)) for t in draw.sample(_LINKS, draw.randint(1, 8))]
    body = [Block(sentence()[:-1], path_of(("html", "body", "article", draw.choice(("h1", "h2"))), ()), 0)]
    for _ in range(draw.randint(1, 12)):
        text = " ".join(sentence() for _ in range(draw.choice((1, 1, 2, 4, 7))))
        tag = draw.choice(("p", "p", "p", "p", "li", "h2"))
        body.append(Block(text if tag == "p" else sentence().rstrip(".?!"), path_of(("html", "body", "article", tag), ()), 0))
    foot = [Block(t, path_of(("html", "body", "footer", "p"), ()), draw.choice((0, len(t)))) for t in draw.sample(_NOTICES, draw.randint(1, 3))]
    blocks = menu + body + foot
    return blocks, [int("article" in b.tags) for b in blocks]


@dataclass
class Pages:
    """Pages as one padded batch; rows past a page's last block are not real."""
    flat: np.ndarray      # by active feature: place in the batch
    column: np.ndarray    # and the feature's number
    gold: np.ndarray      # pages x blocks: the label, -1 past the end

    def likelihood(self, weights: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the gold labels and its gradient, by forward and backward sums."""
        count, longest = self.gold.shape
        real = self.gold >= 0
        hot = np.stack([self.gold == 0, self.gold == 1], axis=2).astype(float)
        emit = np.zeros((count * longest, 2))
        np.add.at(emit, self.flat, weights[self.column])
        emit = emit.reshape(count, longest, 2)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for i in range(1, longest):
            step = np.logaddexp.reduce(forward[:, i - 1, :, None] + steps, axis=1) + emit[:, i]
            forward[:, i] = np.where(real[:, i, None], step, forward[:, i - 1])
        for i in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(steps + (emit[:, i + 1] + backward[:, i + 1])[:, None, :], axis=2)
            backward[:, i] = np.where(real[:, i + 1, None], step, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        both = np.exp(forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :] - total[:, None, None, None])
        both = (both * real[:, 1:, None, None]).sum(axis=(0, 1))
        pairs = np.einsum("pia,pib->ab", hot[:, :-1], hot[:, 1:])
        by_weight = np.zeros_like(weights)
        np.add.at(by_weight, self.column, (hot - chance).reshape(-1, 2)[self.flat])
        return float((emit * hot).sum() + (pairs * steps).sum() - total.sum()), by_weight, pairs - both


def batch_of(pages: list[tuple[list[list[str]], list[int]]], index: dict[str, int]) -> Pages:
    longest = max(len(y) for _, y in pages)
    at = [(p * longest + i, index[f]) for p, (seen, _) in enumerate(pages) for i, active in enumerate(seen) for f in active]
    gold = np.full((len(pages), longest), -1)
    for p, (_, y) in enumerate(pages):
        gold[p, :len(y)] = y
    return Pages(np.array([i for i, _ in at]), np.array([f for _, f in at]), gold)


def train(pages: list[tuple[list[Block], list[int]]], params: Extraction = Extraction()) -> Model:
    """Maximum likelihood (with decay) by Adam. Of a page with more than ``window`` blocks as many that
    follow one another are trained on, of a page with very many features fewer."""
    known = []
    for number, (blocks, labels) in enumerate(pages):
        if not blocks:
            continue
        size = min(len(blocks), params.window)
        first = random.Random(f"{params.seed} window {number}").randint(0, len(blocks) - size)
        depth = max(len(b.path.up()) if b.path else 0 for b in blocks[first:first + size])
        last = first + max(1, min(size, params.features // (depth + 20)))
        known.append((describe(blocks, first, last), labels[first:last]))
    index = {f: i for i, f in enumerate(sorted({f for seen, _ in known for active in seen for f in active}))}
    n = len(index)
    weights, steps = np.zeros((n, 2)), np.zeros((2, 2))
    if not known:
        return Model(index, weights, steps)
    batch = batch_of(known, index)
    moments = [np.zeros((n + 2, 2)), np.zeros((n + 2, 2))]
    for t in range(1, params.rounds + 1):
        _, by_weight, by_step = batch.likelihood(weights, steps)
        gradient = params.decay * np.vstack([weights, steps]) - np.vstack([by_weight, by_step]) / len(known)
        moments = [0.9 * moments[0] + 0.1 * gradient, 0.999 * moments[1] + 0.001 * gradient ** 2]
        change = params.rate * (moments[0] / (1 - 0.9 ** t)) / (np.sqrt(moments[1] / (1 - 0.999 ** t)) + 1e-8)
        weights, steps = weights - change[:n], steps - change[n:]
    return Model(index, weights, steps)


def fit(pages: DataFrame, page_id: str = "page_id", markup: str = "html", params: Extraction = Extraction()) -> Model:
    """Train on a bounded sample of the sectioned pages among ``pages``, drawn by a hash of the id."""
    sectioned = pages.where(F.regexp_like(markup, F.lit(r"(?i)<(article|main)[\s/>]")) & (F.length(markup) < params.longest))
    total = sectioned.count()
    drawn = hash_share(F.coalesce(F.col(page_id).cast("string"), F.lit("")), salt="pages")
    sample = (sectioned.where(drawn < params.sample / max(1, total))
              .select(F.col(page_id).cast("string").alias("id"), F.col(markup).alias("page")).collect())
    pages_known = []
    for row in sorted(sample, key=lambda r: (r["id"] or "", r["page"])):
        blocks = blocks_of(row["page"])
        labels = silver(blocks)
        if any(labels):     # the tag may stand in a comment or script, or hold nothing
            pages_known.append((row["id"], blocks, labels))
    for i in range(params.least - len(pages_known)):
        pages_known.append((f"built-in {i}", *built_in(random.Random(f"{params.seed} built-in {i}"))))
    known = []
    for name, blocks, labels in pages_known:
        known.append((blocks, labels))
        for v in range(params.variants):
            known.append(redressed(blocks, labels, random.Random(f"{params.seed} {name} {v}")))
    return train(known, params)


def extract(pages: DataFrame, model: Model, markup: str = "html") -> DataFrame:
    """``pages`` with the article's text (``main_text``), blocks and article blocks counted."""

    def run(raws: list) -> list[list]:
        found = [model.extract((raw or b"").decode("utf-8", "replace")) for raw in raws]
        return [list(x) for x in zip(*found, strict=True)]

    return append_columns(pages, markup, FIELDS, run)
