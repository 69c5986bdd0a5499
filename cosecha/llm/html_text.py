"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into leaf blocks: runs of text between block tags.  A block's features are the tags, class, id and role
words of its ancestors, its own tag, its length, its links and its signs.  The labels, main text and other, follow
each other with weights of their own.  The field is trained by gradient descent on the exact likelihood over the pages
of ``cosecha.llm.html_pages``; Viterbi decodes.  Scripts, styles, heads, comments and hidden templates are no blocks.

A block's text has its character references decoded and white space turned to one space, trimmed; the blocks of main
text are joined by one space in page order.  Nothing else is dropped or cut.

Defined results: a null, empty or broken html gives what text its blocks hold, else the empty text; tags that are
never closed end with their parent, but a script, style, text area or title without an end takes the rest of the page;
a '<' that starts no tag is text; time grows with the page, however deep its elements lie; rows with equal html give equal texts; a null
page_id or url is carried; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cosecha.llm import words as W
from cosecha.llm.html_pages import labelled_page

TRAINING_PAGES = 400
EPOCHS = 30

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_ZEROS = re.compile(r"&#(?:0++(?=[0-9])|([xX])0++(?=[0-9a-fA-F]))")
_HUGE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_SKIPPED = {"script", "style", "head", "noscript", "template", "svg", "iframe", "textarea", "object", "title"}
_RAW = {"script", "style", "textarea", "title"}  # without an end they take the rest of the page
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in _SKIPPED}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img input meta link base area col param source track embed button select option".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BOXED_INLINE = {"ins", "label", "button", "select", "option"}
_NO_NEST = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_STOPS = {"li": {"ul", "ol"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}, "p": set(), "option": {"select"}}


@lru_cache(1 << 14)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """Features that an element gives to all blocks inside it."""
    out = [f"in:{tag}"]
    if attributes:
        for m in _NAMED.finditer(attributes):
            value = _CAMEL.sub(" ", html.unescape(m[2] or m[3] or m[4] or "")).lower()
            out += [f"name:{part}" for part in _PART.findall(value)]
    return tuple(dict.fromkeys(out))


def _decoded(text: str) -> str:
    """Character references decoded; numbers too long for one are what those beyond Unicode are."""
    if "&#" in text:
        text = _ZEROS.sub(lambda m: f"&#{m[1] or ''}", text)
        text = _HUGE.sub("\ufffd", text)
    return html.unescape(text)


class Blocks:
    """The leaf blocks of one page: texts, and the elements and counts that features come from.

    Elements form a tree: each is (parent, tag, attributes, depth), the parent by its number; number 0 is the page.
    """

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.inside: list[int] = []
        self.linked: list[int] = []
        self.elements: list[tuple[int, str, str, int]] = [(-1, "none", "", 0)]
        stack: list[int] = [0]
        opened: dict[str, int] = {}
        unclosed: set[str] = set()
        held: list[str] = []
        link = linked = 0
        at, size = 0, len(page)
        last = page.rfind(">")

        def flush() -> None:
            nonlocal linked
            if held:
                text = " ".join(_decoded("".join(held)).split())
                if text:
                    self.texts.append(text)
                    self.inside.append(stack[-1])
                    self.linked.append(linked)
                held.clear()
            linked = 0

        def close(k: int) -> None:
            for i in stack[k:]:
                opened[self.elements[i][1]] -= 1
            del stack[k:]

        def above(tags: set[str], stops: set[str]) -> int:
            """The place in the stack of the nearest open element of ``tags`` that no stop hides, or 0."""
            if any(opened.get(t) for t in tags):
                for k in range(len(stack) - 1, 0, -1):
                    tag = self.elements[stack[k]][1]
                    if tag in tags:
                        return k
                    if tag in stops:
                        break
            return 0

        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                lt = size
            if lt > at:
                held.append(page[at:lt])
                linked += (lt - at) if link else 0
            if lt == size:
                break
            if lt > last and not page.startswith("<!--", lt):  # no tag ends behind this place
                held.append(page[lt:] if (end := page.find("<!--", lt)) < 0 else page[lt:end])
                at = size if end < 0 else end
                continue
            m = _TOKEN.match(page, lt) or _LOOSE.match(page, lt)
            if not m:
                held.append("<")
                at = lt + 1
                continue
            at = m.end()
            if not m.lastindex:
                continue
            closing, tag, attributes = m[1], m[2].lower(), m[3]
            if tag in _SKIPPED:
                if not closing and not attributes.endswith("/") and tag not in unclosed:
                    end = _ENDS[tag].search(page, at)
                    if end:
                        at = end.end()
                    elif tag in _RAW:
                        at = size
                    else:  # what follows is not lost for it
                        unclosed.add(tag)
                if tag != "svg":
                    flush()
                continue
            if tag == "a":
                link = 0 if closing else 1
                continue
            if tag in _INLINE and tag not in _BOXED_INLINE:
                continue
            flush()
            if closing:
                if k := above({tag}, set()):
                    close(k)
            else:
                ended = _NO_NEST.get(tag)
                if tag in _ENDS_P and self.elements[stack[-1]][1] == "p":
                    close(len(stack) - 1)
                elif ended and (k := above(ended, _STOPS[tag])):
                    close(k)
                if tag not in _VOID and not attributes.endswith("/"):
                    self.elements.append((stack[-1], tag, attributes.strip(), len(stack)))
                    stack.append(len(self.elements) - 1)
                    opened[tag] = opened.get(tag, 0) + 1
        flush()

    def path(self, element: int) -> list[tuple[str, str]]:
        """(tag, attributes) of an element and all around it, outermost first."""
        out = []
        while element:
            parent, tag, attributes, _ = self.elements[element]
            out.append((tag, attributes))
            element = parent
        return out[::-1]


def _own(text: str, tag: str, depth: int, linked: int, place: int, count: int) -> list[str]:
    """Features of the block itself."""
    n = len(text)
    words = text.count(" ") + 1
    out = [f"tag:{tag}", f"words:{min(int(math.log2(words)), 7)}", f"linked:{min(int(4 * linked / n), 4)}", f"depth:{min(depth, 6)}"]
    if text[-1] in ".!?":
        out.append("ends")
    if "©" in text or "Copyright" in text:
        out.append("sign")
    if place == 0:
        out.append("first")
    if place == count - 1:
        out.append("last")
    return out


class Field:
    """Weights of features (main text against other), of the first block and of the four steps between labels."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.known: dict[tuple[str, str], float] = {}  # of elements, once trained
        self.steps = np.zeros((2, 2))
        self.start = 0.0

    def emissions(self, page: Blocks) -> list[float]:
        get, known, above = self.weights.get, self.known, [0.0]
        if len(known) > 1 << 14:
            known.clear()
        for parent, *element, _ in page.elements[1:]:
            key = tuple(element)
            if key not in known:
                known[key] = sum(get(f, 0.0) for f in _names(*key))
            above.append(above[parent] + known[key])
        out, count = [], len(page.texts)
        for i, (text, inside) in enumerate(zip(page.texts, page.inside, strict=True)):
            _, tag, _, depth = page.elements[inside]
            out.append(above[inside] + sum(get(f, 0.0) for f in _own(text, tag, depth, page.linked[i], i, count)))
        return out

    def decode(self, page: Blocks) -> list[bool]:
        """The likeliest labels, by Viterbi."""
        scores = self.emissions(page)
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.steps.tolist()
        other, main, back = 0.0, scores[0] + self.start, []
        for x in scores[1:]:
            from_other, from_main = (other + s00, main + s10), (other + s01, main + s11)
            back.append((from_other[1] > from_other[0], from_main[1] > from_main[0]))
            other, main = max(from_other), max(from_main) + x
        label = main > other
        out = [label]
        for b in reversed(back):
            label = b[label]
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        blocks = Blocks(page or "")
        return " ".join(t for t, keep in zip(blocks.texts, self.decode(blocks), strict=True) if keep)


def _marginals(scores: list[float], start: float, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(block is main text), and expected numbers of the four steps."""
    n = len(scores)
    e = np.zeros((n, 2))
    e[:, 1] = scores
    e[0, 1] += start
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0] = e[0]
    for i in range(1, n):
        forward[i] = e[i] + np.logaddexp(forward[i - 1, 0] + steps[0], forward[i - 1, 1] + steps[1])
    for i in range(n - 2, -1, -1):
        x = e[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(steps[:, 0] + x[0], steps[:, 1] + x[1])
    total = np.logaddexp(*forward[-1])
    expected = np.zeros((2, 2))
    if n > 1:
        expected = np.exp(forward[:-1, :, None] + steps + (e[1:] + backward[1:])[:, None, :] - total).sum(axis=0)
    return np.exp(forward[:, 1] + backward[:, 1] - total), expected


@lru_cache(4)
def trained(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = 11) -> Field:
    """The field, fitted by AdaGrad on labelled pages that ``seed`` makes."""
    rng = random.Random(seed)
    data = []
    for _ in range(pages):
        parts = labelled_page(rng)
        marked, labels = [], []
        for i, (main, markup) in enumerate(parts):
            marked.append(markup)
        page = Blocks("<html><head><title>t</title></head><body>" + "".join(marked) + "</body></html>")
        # which part a block comes from: parts are parsed behind each other, and each adds the same blocks
        seen = 0
        for i, (main, _) in enumerate(parts):
            upto = len(Blocks("<html><body>" + "".join(marked[: i + 1])).texts)
            labels += [bool(main)] * (upto - seen)
            seen = upto
        labels += [False] * (len(page.texts) - len(labels))
        if page.texts and len(labels) == len(page.texts):
            features = []
            for i, (t, inside) in enumerate(zip(page.texts, page.inside, strict=True)):
                _, tag, _, depth = page.elements[inside]
                around = [f for element in page.path(inside) for f in _names(*element)]
                features.append(around + _own(t, tag, depth, page.linked[i], i, len(page.texts)))
            data.append((page, np.array(labels, float), features))
    field, squares = Field(), {}
    step_squares, start_square = np.full((2, 2), 1e-2), 1e-2
    for _ in range(epochs):
        rng.shuffle(data)
        for page, labels, features in data:
            scores = [sum(field.weights.get(f, 0.0) for f in fs) for fs in features]
            p, expected = _marginals(scores, field.start, field.steps)
            gradient: dict[str, float] = {}
            for miss, fs in zip(labels - p, features, strict=True):
                for f in fs:
                    gradient[f] = gradient.get(f, 0.0) + miss
            for f, g in gradient.items():
                g -= 1e-3 * field.weights.get(f, 0.0)
                squares[f] = squares.get(f, 1e-2) + g * g
                field.weights[f] = field.weights.get(f, 0.0) + 0.2 * g / math.sqrt(squares[f])
            seen_steps = np.zeros((2, 2))
            np.add.at(seen_steps, (labels[:-1].astype(int), labels[1:].astype(int)), 1)
            g = seen_steps - expected
            step_squares += g * g
            field.steps += 0.1 * g / np.sqrt(step_squares)
            g = labels[0] - p[0]
            start_square += g * g
            field.start += 0.1 * g / math.sqrt(start_square)
    field.weights, field.start = {f: float(x) for f, x in field.weights.items()}, float(field.start)
    return field


def extracted(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    field = field or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "html"):
                texts = [field.text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7(spark, sf_dir: str) -> DataFrame:
    """One row per page: its main text."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
