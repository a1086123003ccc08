"""Main text of web pages: the contiguous region of greatest score.

A page is a sequence of words and tags. Each word scores by where it stands, each tag scores negative, and one linear
scan finds the contiguous run of greatest sum: the content region. A word's weight is the log-odds that a labelled page
gives to words in such a place, fitted by logistic regression over features of its block: names and class words of the
elements around it, the share of its words inside links, and its length. Blocks inside the region whose own words score
negative (an advert or a form in the middle of an article) are left out; inside an element
that speaks for content they do not end the region.

Labelled pages are (a) the layouts in ``labelled_pages`` and (b) a bounded sample of the given pages that name their
article by an ``article`` or ``main`` element; what stands outside of it is labelled as not content.

An element that by its meaning in HTML is no content (navigation, an aside, a footer, a dialog, a menu, a form, anything
hidden), or that calls itself the readers' comments or an advert, scores negative whatever the weights, unless it holds the article
itself. A form with half of a page's words or more is the page's frame and no form to fill in. Where the region is in
an ``article`` or ``main`` element, the rest of it, such as a heading or a list of links, goes with it, but for elements
whose class speaks against them.

The text: character references decoded, white space inside a block turned into one space, blocks trimmed and joined by
an empty line. A ``br`` is white space.

Defined results: a null html counts as empty; a page without a run of positive score gives an empty text; markup that
is cut off ends with the page, an element that is never closed with the one around it; a control, a drawing or the like
that is never closed takes out its own words, up to the next paragraph, heading or such; rows come out as often as they come in, also with a null or repeated
``page_id``; other columns are left out.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cardrail.llm import labelled_pages
from cardrail.llm.common import bounded_sample, small

#: Element names of HTML, by what they mean for a text.
RAW = frozenset("script style textarea title iframe".split())
SKIPPED = frozenset("noscript template svg math object select button option".split())
FOREIGN = frozenset({"svg", "math"})
#: What an element of SKIPPED that is never closed does not hold.
BREAKS = frozenset("article main section p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>[^>\"']*(?:(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))[^>\"']*)*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
#: Any attribute with its whole value, so that no name is found inside another name or a value.
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'>][^\s>]*))?""")
WORDED = frozenset({"class", "id", "role", "itemprop"})
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements that hold a page's content, and elements that are not part of the text around them.
CONTENT = frozenset({"tag:article", "tag:main"})
NOT_CONTENT = frozenset({"tag:nav", "tag:aside", "tag:footer", "tag:dialog", "tag:menu", "tag:form", "hidden", "named"})

#: Whole class names and ids of readers' comments and of adverts.
NAMED = frozenset(
    "comment comments commentlist comment-list comments-area comments-section disqus_thread discussion feedback replies "
    "reader-comments respond responses user-comments ad ads advert adverts advertisement advertising sponsored".split()
)

SAMPLE_PAGES = 400

#: The weight of the class words inside an article below which a block is no part of its text.
AGAINST = -0.5


@dataclass
class Block:
    """A run of text between block tags, with the features of its place."""

    around: tuple[frozenset[str], ...]  # the features of each element around it, the innermost last
    words: list[str] = field(default_factory=list)
    linked: int = 0
    label: int | None = None
    open: bool = False  # the next piece of text goes on the last word
    framed: bool = False  # the page stands in a form

    @property
    def features(self) -> frozenset[str]:
        return self.around[-1]

    def set_apart(self) -> bool:
        """Whether it stands in an element that is no content, and in none that holds content within that."""
        no_content = NOT_CONTENT - {"tag:form"} if self.framed else NOT_CONTENT
        inner = next((a for a in self.around if a & no_content), None)
        return inner is not None and not (self.features & CONTENT) - (inner & CONTENT)

    def article(self) -> frozenset[str] | None:
        """The features of the outermost element around it that holds a page's content by its name."""
        return next((a for a in self.around if a & CONTENT), None)

    def shape(self) -> tuple[str, str]:
        share, n = self.linked / max(1, len(self.words)), len(self.words)
        return f"links:{math.ceil(4 * share)}", f"length:{min(6, n.bit_length())}"


@dataclass
class Element:
    """An open element: the features around what stands in it, its label, whether its words are left out, and how many
    blocks and items of the sequence came before it."""

    name: str
    around: tuple[frozenset[str], ...]
    label: str | None = None
    skipped: bool = False
    before: tuple[int, int] = (0, 0)


@lru_cache(10_000)
def _marks(name: str, rest: str) -> tuple[tuple[str, ...], str | None]:
    """The features an element gives to what stands in it, and its label if it has one."""
    found, label = [f"tag:{name}"] if name not in INLINE else [], None
    for kind, value in ATTRIBUTE.findall(rest):
        kind, value = kind.lower(), value.strip("\"'")
        if kind == "data-label":
            label = value
        elif kind == "hidden" or (kind == "aria-hidden" and value.strip().lower() == "true"):
            found.append("hidden")
        elif kind in WORDED:
            if name not in ("html", "body", "article", "main") and not NAMED.isdisjoint(value.lower().split()):
                found.append("named")
            found += [f"word:{w.lower()}" for w in WORD_PARTS.findall(value)]
    return tuple(found), label


def read(html: str | None, labelled: bool = True) -> tuple[list[Block], list[int | str]]:
    """The blocks of a page, and its sequence: a block's number for each of its words, and the name of each tag.

    ``data-label`` is a label on the layouts only; a given page may use that attribute for anything.
    """
    html = html or ""
    blocks: list[Block] = []
    sequence: list[int | str] = []
    stack = [Element("", (frozenset(),))]
    links, at, fresh = 0, 0, True
    while found := TOKEN.match(html, at):
        at = found.end()
        name = (found["name"] or "").lower()
        if found["text"] is not None:
            if stack[-1].skipped:
                continue
            text = references.unescape(found["text"])
            words = text.split()
            if fresh and words:
                label = stack[-1].label
                blocks.append(Block(stack[-1].around, label=None if label is None else int(label)))
                fresh = False
            if not fresh:
                block = blocks[-1]
                if words and block.open and not text[0].isspace():
                    block.words[-1] += words.pop(0)
                block.words += words
                block.linked += len(words) * (links > 0)
                sequence += [len(blocks) - 1] * len(words)
                block.open = bool(text) and not text[-1].isspace() and (bool(words) or block.open)
        elif name:
            if name in ("option", "button") and name == stack[-1].name and not found["close"]:
                stack.pop()  # one of these ends the one before it
            if not stack[-1].skipped:
                sequence.append(name)
            if name not in INLINE:
                fresh = True
            elif name == "br" and not fresh:
                blocks[-1].open = False
            if found["close"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == name:
                        links -= sum(e.name == "a" for e in stack[depth:])
                        if name in SKIPPED:
                            del blocks[stack[depth].before[0] :], sequence[stack[depth].before[1] :]
                        del stack[depth:]
                        break
            elif name in RAW and not any(e.name in FOREIGN for e in stack):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif name not in VOID and not found["rest"].endswith("/"):
                marks, label = _marks(name, found["rest"])
                label = label if labelled else None
                above = stack[-1]
                around = above.around
                if not around[-1].issuperset(marks):
                    around = (*around, around[-1].union(marks))
                skipped = name in SKIPPED or (above.skipped and name not in BREAKS)
                label = above.label if label is None else label
                stack.append(Element(name, around, label, skipped, (len(blocks), len(sequence))))
                links += name == "a"
    in_forms = sum(len(b.words) for b in blocks if "tag:form" in b.features)
    if in_forms and 2 * in_forms >= sum(len(b.words) for b in blocks):
        for block in blocks:
            block.framed = True
    return blocks, sequence


@dataclass(frozen=True)
class Weights:
    """Weights of places, by feature, and the cost of a tag, by name; ``other`` is the cost of any other tag."""

    places: dict[str, float]
    tags: dict[str, float]
    other: float
    sums: dict[frozenset[str], float] = field(default_factory=dict, compare=False, repr=False)

    def word(self, block: Block) -> float:
        """The weight of each word of a block, from -1 to 1.

        A block of negative weight in an element that speaks for content only interrupts it, and weighs nothing.
        """
        total = self.around(block.features)
        weight = -1.0 if block.set_apart() else total + sum(self.places.get(f, 0.0) for f in (*block.shape(), "any"))
        if weight <= 0 and any(self.around(f) > 1 for f in block.around[:-1]):
            return 0.0
        return max(-1.0, min(1.0, weight))

    def belongs(self, block: Block) -> bool:
        """Whether a block of an article is part of its text: not set apart, and no class in it speaks against it."""
        own = sum(self.places.get(f, 0.0) for f in block.features - block.article() if f.startswith("word:"))
        return not block.set_apart() and own > AGAINST

    def around(self, features: frozenset[str]) -> float:
        if features not in self.sums:
            if len(self.sums) > 10_000:
                self.sums.clear()
            self.sums[features] = sum(self.places.get(f, 0.0) for f in features)
        return self.sums[features]


def fit(pages: Iterable[tuple[list[Block], list[int | str]]], steps: int = 300, rate: float = 0.5) -> Weights:
    """Weights from labelled pages: logistic regression for words, and a cost by log-odds for tags."""
    places: dict[str, int] = {}
    rows: dict[tuple[tuple[int, ...], int], float] = {}  # a place and a label: how much they weigh
    inside: dict[str, list[int]] = {}
    for blocks, sequence in pages:
        for block in blocks:
            marks = (places.setdefault(f, len(places)) for f in (*block.features, *block.shape(), "any"))
            key = tuple(sorted(marks)), block.label or 0
            rows[key] = rows.get(key, 0.0) + 1 + math.log2(max(1, len(block.words)))
        near = 0
        for item in sequence:
            if isinstance(item, int):
                near = blocks[item].label or 0
            else:
                inside.setdefault(item, [1, 1])[near] += 1
    x = np.zeros((len(rows), len(places)), "f4")
    for i, (row, _) in enumerate(rows):
        x[i, list(row)] = 1
    y, size = np.array([label for _, label in rows], "f4"), np.array(list(rows.values()), "f4")
    size /= max(1.0, size.sum())
    weights, speed = np.zeros(len(places), "f4"), np.full(len(places), 1e-6, "f4")
    for _ in range(steps):
        slope = x.T @ (size * (1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))) - y)) + 1e-5 * weights
        speed += slope**2
        weights -= rate * slope / np.sqrt(speed)
    tags = {t: -0.2 - 0.3 * max(0.0, math.log(out / in_)) for t, (out, in_) in inside.items()}
    return Weights(dict(zip(places, weights.tolist(), strict=True)), tags, -0.5)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of greatest sum, the first of equals; (0, 0) if none is positive."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, found = run, (start, i + 1)
    return found


def main_text(html: str | None, weights: Weights) -> str:
    blocks, sequence = read(html, labelled=False)
    words = [weights.word(b) for b in blocks]
    scores = [words[s] if isinstance(s, int) else weights.tags.get(s, weights.other) for s in sequence]
    start, end = best_run(scores)
    kept = {s for s in sequence[start:end] if isinstance(s, int) and words[s] > 0}
    articles = {a for b in kept if (a := blocks[b].article()) is not None}
    kept |= {i for i, b in enumerate(blocks) if b.article() in articles and weights.belongs(b)}
    return "\n\n".join(" ".join(blocks[b].words) for b in sorted(kept))


def self_labelled(html: str | None) -> tuple[list[Block], list[int | str]] | None:
    """A page that names its article, with the blocks in it labelled as content, unless an element in it says other."""
    blocks, sequence = read(html, labelled=False)
    if not any(b.features & CONTENT for b in blocks):
        return None
    for block in blocks:
        block.label = int(bool(block.features & CONTENT) and not block.set_apart())
    return blocks, sequence


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from the labelled layouts, and from at most ``sample_pages`` of the given pages, by a hash of their id."""
    found = bounded_sample(pages.select("page_id", "html"), sample_pages, "page_id", "html")
    rows = [r.html for r in found.collect()]
    layouts = [read(page) for page in labelled_pages.pages()]
    own = [p for p in map(self_labelled, rows) if p]
    return fit([*layouts, *own])


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page, from its whole html. A narrow pass."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            texts = [main_text(h, shared.value) for h in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            sizes = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, sizes], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
