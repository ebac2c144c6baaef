"""Main text of web pages: flat text blocks, judged by a decision tree on word counts, link densities and their neighbours'.

A page is cut at block-level tags into flat blocks of text. A block has its number of words, its link density (share of words
inside links), the same of the block before and after it, and what encloses it. A small classification tree, grown here from
the labelled table ``LAYOUTS``, decides whether a block is main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements and words of class names, by what they say about the text inside.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe object svg canvas select option textarea button title head math audio video map".split())
FRAME = frozenset("nav header footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th"}
FRAME_WORD = re.compile(
    r"ads?|advert\w*|banners?|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|sidebars?|footers?|header|masthead|cookies?|consent|notices?|"
    r"alerts?|newsletter|subscri\w*|signup|login|share|sharing|social|related|recommend\w*|widgets?|comments?|replies|respond|disqus|tags|pager|pagination|"
    r"popup|modal|copyright|toolbar|search|searchbox|searchform|form"
)
MAIN_WORD = re.compile(r"articles?|post|entry|story|main|content|body|text")
# What a class says about the page or about its state, not about the text inside: has-sidebar, no-sidebar, tag-news, comments-open.
ABOUT = frozenset("has no with without is not tag category cat hide show hidden".split())
STATES = frozenset("open closed enabled disabled on off none hidden left right".split())
HOLDERS = frozenset("area bar block box button buttons container content group holder inner item items links list panel region section text thread title wrap wrapper".split())
TITLES = frozenset("header masthead banner".split())
LANDMARKS = frozenset("article main nav header footer aside h1".split())

FORM = 2
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(?:[!?])[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.DOTALL)
HINT = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    heading: bool
    frame: bool  # inside a frame element, or one whose class says so
    main: bool  # inside an article or main element, or one whose class says so, nearer than any frame


def marks(hints: str) -> tuple[bool, bool]:
    """(frame, main) as class names and the like say it; each name counts as a whole.

    ``post-comments`` and ``comment-list`` are frames, ``article-header`` is the title of an article, ``has-sidebar`` and ``comments-open`` say nothing.
    """
    frame = main = False
    for token in hints.lower().split():
        parts = [p for p in re.split(r"[-_]+", token) if p]
        if not parts or parts[0] in ABOUT or parts[-1] in STATES:
            continue
        own_title = parts[-1] in TITLES and MAIN_WORD.fullmatch(parts[0]) is not None and len(parts) > 1 and parts[0] != "main"
        held = parts[-1] in HOLDERS and any(FRAME_WORD.fullmatch(p) for p in parts[:-1])
        if own_title:
            main = True
        elif held or FRAME_WORD.fullmatch(parts[-1]) or token in ("side-bar", "sign-up"):
            frame = True
        elif MAIN_WORD.fullmatch(parts[-1]) or MAIN_WORD.fullmatch(parts[0]):
            main = True
    return frame, main


def _raw_end(page: str, name: str, at: int) -> int:
    """Where an element whose content is no text ends; the page's end if nothing closes it."""
    found = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.IGNORECASE).search(page, at)
    return found.end() if found else len(page)


def blocks(page: str | None) -> list[Block]:
    """Flat blocks of a page in order. Unclosed and misplaced tags are allowed; what a page cuts off ends with it.

    A form that holds a heading of the page, an article or another landmark wraps the page and is no frame. An article or main element
    is main whatever its class says, unless it lies in a frame or in another one (there, one called a comment is a comment).
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = []  # name, 1 in a frame (FORM if only in a form), 1 in main, in a heading
    opened: Counter[str] = Counter()
    forms: list[tuple[int, int]] = []  # of open forms: place in the stack, first block
    parts: list[str] = []
    link_parts: list[str] = []
    frame = main = links = 0
    heading = False

    def flush() -> None:
        nonlocal heading
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(html.unescape(" ".join(link_parts)).split())
                out.append(Block(text, text.count(" ") + 1, linked, heading, frame, bool(main)))
        parts.clear()
        link_parts.clear()

    def close(depth: int) -> None:
        nonlocal frame, main, heading
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1
        while forms and forms[-1][0] >= depth:
            forms.pop()
        frame, main, heading = stack[-1][1:] if stack else (0, 0, False)

    def unwrap() -> None:
        """The open forms wrap the page: what lies in nothing but them is in no frame."""
        nonlocal frame
        place, first = forms[0]
        for i in range(place, len(stack)):
            if stack[i][1] == FORM:
                stack[i] = (stack[i][0], 0, *stack[i][2:])
        out[first:] = [b._replace(frame=0) if b.frame == FORM else b for b in out[first:]]
        frame = 0 if frame == FORM else frame
        forms.clear()

    at = 0
    for token in iter(lambda: TOKEN.search(page, at), None):
        if token.start() > at:
            parts.append(page[at : token.start()])
            if links:
                link_parts.append(page[at : token.start()])
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        closing = bool(token[1])
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if closing:
            flush()
            if opened[name]:
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                close(depth)
                links = 0
            continue
        if name in DROPPED and name != "head":
            flush()
            if not token[3].endswith("/"):
                at = _raw_end(page, name, at)
            continue
        flush()
        if name in VOID or name in ("html", "body", "head"):
            continue
        if name in ENDS_P and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        for open_name in SAME.get(name, "").split():
            if stack and stack[-1][0] == open_name:
                close(len(stack) - 1)
        hints = " ".join(a or b or c for a, b, c in HINT.findall(token[3])) if token[3] else ""
        if name in LANDMARKS and forms and frame != 1:
            unwrap()
        called_frame, called_main = marks(hints) if hints else (False, False)
        if name in MAIN:
            inner_frame, inner_main = called_frame and bool(main), True
        else:
            inner_frame, inner_main = name in FRAME or called_frame, called_main
        if name == "header" and main and not frame:
            inner_frame = False  # an article's own heading
        if name == "form" and not frame:
            forms.append((len(stack), len(out)))
            frame, main = FORM, 0
        elif inner_frame:
            frame, main = 1, 0
        elif inner_main and frame != 1:
            main = 1  # in a form it counts if that turns out to wrap the page
        heading = heading or name in ("h1", "h2", "h3", "h4", "h5", "h6")
        stack.append((name, frame, main, heading))
        opened[name] += 1
    if at < len(page):
        parts.append(page[at:])
    flush()
    return [b._replace(frame=bool(b.frame), main=b.main and not b.frame) for b in out]


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", "ends_sentence",
    "frame", "main", "page_has_main",
)
_SENTENCE = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*$")


def features(page: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` for each block; a missing neighbour counts as no words."""
    n = len(page)
    out = np.zeros((n, len(FEATURES)))
    words = np.array([b.words for b in page], float)
    density = np.array([b.linked / b.words for b in page])
    out[:, 0], out[:, 1] = words, density
    out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
    for i, b in enumerate(page):
        out[i, 6:10] = b.heading, _SENTENCE.search(b.text) is not None, b.frame, b.main
    out[:, 10] = any(b.main for b in page)
    return out


# The labelled table: pages as sequences of blocks. A block is (label, words, linked words, marks); marks: h heading, s ends like a
# sentence, f in a frame, m in main. Labels were set by hand for the kinds of pages that the comment of each group names.
LAYOUTS: tuple[tuple[tuple[int, int, int, str], ...], ...] = (
    # article element between navigation, advert and footer
    ((0, 1, 1, "f"), (0, 1, 1, "f"), (0, 2, 2, "f"), (0, 9, 0, "fs"), (1, 8, 0, "hm"), (1, 60, 2, "ms"), (1, 3, 0, "ms"), (1, 140, 0, "ms"), (1, 1, 0, "ms"), (1, 35, 0, "m"), (0, 14, 0, "fs")),
    ((0, 3, 3, "f"), (0, 40, 0, "fs"), (1, 12, 0, "hm"), (1, 2, 0, "m"), (1, 9, 0, "ms"), (1, 25, 9, "ms"), (0, 30, 1, "f"), (0, 6, 0, "fs")),
    ((1, 5, 0, "hm"), (1, 80, 0, "ms"), (1, 4, 0, "hm"), (1, 6, 0, "m"), (1, 7, 0, "m"), (1, 90, 3, "ms"), (0, 22, 0, "fs"), (0, 55, 0, "fs"), (0, 8, 8, "f")),
    ((0, 12, 12, ""), (0, 2, 0, ""), (1, 9, 0, "hm"), (1, 120, 4, "ms"), (1, 15, 15, "m"), (1, 70, 0, "ms"), (0, 18, 0, "s"), (0, 3, 3, "")),
    ((0, 45, 0, "s"), (1, 7, 0, "hm"), (1, 33, 0, "ms"), (1, 48, 0, "m"), (0, 60, 0, "s"), (0, 7, 0, "")),
    ((0, 9, 0, "h"), (1, 30, 0, "ms"), (1, 1, 0, "m"), (0, 25, 20, ""), (0, 80, 0, "fs"), (0, 90, 2, "fs")),
    # short and odd articles, alone or between anything: what lies in main is text
    ((1, 4, 0, "m"),), ((1, 1, 0, "ms"), (1, 1, 0, "ms")), ((1, 2, 0, "hm"), (1, 12, 0, "ms"), (1, 2, 0, "ms")), ((1, 3, 0, "m"), (1, 2, 0, "m"), (1, 1, 0, "m")),
    ((0, 3, 3, "f"), (1, 2, 0, "m"), (0, 9, 9, "f")), ((0, 4, 4, ""), (1, 5, 0, "m"), (0, 6, 6, "")), ((0, 9, 9, ""), (1, 7, 0, "hm"), (1, 1, 1, "m"), (1, 3, 0, "m"), (0, 8, 8, "")),
    ((1, 2, 0, "hm"), (1, 4, 4, "m"), (1, 9, 0, "ms"), (1, 2, 0, "m"), (0, 12, 0, "fs")), ((0, 2, 2, "f"), (1, 3, 0, "hm"), (0, 9, 0, "fs"), (1, 2, 0, "ms"), (0, 7, 7, "f"), (1, 1, 0, "m")),
    ((1, 9, 0, "ms"), (0, 11, 0, "s"), (0, 2, 0, "")), ((0, 21, 0, "s"), (1, 8, 0, "m"), (0, 35, 0, "s"), (0, 48, 0, "s")),
    # no main element: paragraphs among short lines and link lists
    ((0, 6, 6, ""), (0, 4, 4, ""), (1, 9, 0, "h"), (1, 60, 1, "s"), (1, 45, 0, "s"), (1, 12, 0, "s"), (1, 70, 3, "s"), (0, 5, 5, ""), (0, 8, 8, ""), (0, 9, 0, "")),
    ((0, 2, 2, ""), (0, 3, 3, ""), (1, 40, 0, "s"), (1, 22, 0, "s"), (1, 6, 0, "s"), (1, 50, 0, "s"), (0, 12, 10, ""), (0, 7, 7, "")),
    ((0, 1, 0, ""), (0, 7, 7, ""), (1, 5, 0, "h"), (1, 25, 0, "s"), (1, 90, 2, "s"), (0, 4, 0, "h"), (0, 6, 6, ""), (0, 7, 7, ""), (0, 6, 6, ""), (0, 10, 0, "")),
    ((0, 30, 28, ""), (1, 110, 5, "s"), (1, 8, 0, "h"), (1, 75, 0, "s"), (1, 18, 0, "s"), (0, 20, 18, ""), (0, 5, 1, "")),
    ((1, 7, 0, "h"), (1, 35, 0, "s"), (1, 28, 0, "s")),
    ((1, 50, 0, "s"),), ((1, 12, 0, "s"), (1, 40, 0, "s")), ((0, 3, 3, ""), (1, 20, 0, "s"), (0, 2, 2, "")),
    # no marks at all; short plain blocks are text between paragraphs (captions, list items, short answers) and are not beside links and other short ones
    ((0, 5, 0, ""), (0, 7, 7, ""), (0, 5, 0, ""), (1, 48, 0, "s"), (1, 5, 0, ""), (1, 62, 0, "s"), (1, 4, 0, ""), (1, 41, 1, "s"), (0, 5, 0, ""), (0, 6, 6, ""), (0, 4, 0, "")),
    ((0, 4, 4, ""), (0, 6, 0, ""), (0, 5, 5, ""), (1, 55, 0, "s"), (1, 6, 0, ""), (1, 38, 0, "s"), (1, 7, 0, ""), (1, 44, 0, "s"), (0, 3, 3, ""), (0, 7, 0, ""), (0, 4, 4, "")),
    ((0, 3, 0, ""), (0, 8, 8, ""), (0, 6, 0, ""), (0, 9, 9, ""), (1, 70, 2, "s"), (1, 3, 0, ""), (1, 36, 0, "s"), (1, 8, 0, ""), (1, 52, 0, "s"), (0, 6, 0, ""), (0, 9, 9, ""), (0, 3, 0, "")),
    # frames with long texts: sidebars, notices, forms and reader comments
    ((0, 50, 0, "fs"), (0, 70, 5, "fs"), (1, 8, 0, "h"), (1, 55, 0, "s"), (1, 65, 0, "s"), (0, 40, 0, "fs"), (0, 35, 0, "fs"), (0, 2, 0, "f")),
    ((0, 5, 0, "hf"), (0, 24, 0, "fs"), (0, 3, 0, "f"), (1, 42, 0, "s"), (1, 10, 0, "s"), (1, 44, 0, "s"), (0, 110, 0, "fs"), (0, 95, 0, "fs")),
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for layout in LAYOUTS:
        page = [Block("x." if "s" in marks else "x", words, linked, "h" in marks, "f" in marks, "m" in marks) for _, words, linked, marks in layout]
        rows.append(features(page))
        labels.extend(label for label, *_ in layout)
    return np.concatenate(rows), np.array(labels, bool)


class Node(NamedTuple):
    """A split of the tree: left if the feature is at most the value; or a leaf (feature -1) with its verdict."""

    feature: int
    value: float
    left: object
    right: object
    verdict: bool


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 2) -> Node:
    """A classification tree by Gini impurity; ties go to the first feature and the lowest value."""
    verdict = bool(labels.mean() >= 0.5)
    best = (0.0, -1, 0.0)
    if depth and 0 < labels.sum() < len(labels):
        for feature in range(rows.shape[1]):
            order = np.argsort(rows[:, feature], kind="stable")
            x, y = rows[order, feature], labels[order].astype(float)
            n = np.arange(1, len(x))
            ones, total = np.cumsum(y)[:-1], y.sum()
            left, right = ones / n, (total - ones) / (len(x) - n)
            gain = total / len(x) * (1 - total / len(x)) - (n * left * (1 - left) + (len(x) - n) * right * (1 - right)) / len(x)
            gain[(x[1:] == x[:-1]) | (n < least) | (len(x) - n < least)] = 0
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), feature, float((x[k] + x[k + 1]) / 2))
    if best[1] < 0:
        return Node(-1, 0.0, None, None, verdict)
    go_left = rows[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(rows[go_left], labels[go_left], depth - 1, least), grow(rows[~go_left], labels[~go_left], depth - 1, least), verdict)


def verdicts(tree: Node, rows: np.ndarray) -> np.ndarray:
    if tree.feature < 0:
        return np.full(len(rows), tree.verdict)
    go_left = rows[:, tree.feature] <= tree.value
    out = np.empty(len(rows), bool)
    out[go_left] = verdicts(tree.left, rows[go_left])
    out[~go_left] = verdicts(tree.right, rows[~go_left])
    return out


@lru_cache(maxsize=1)
def trained() -> Node:
    """The tree of the labelled table, grown once in each worker."""
    return grow(*labelled_table())


def main_text(page: str | None) -> str:
    """Main text of a page; empty if it has none."""
    found = blocks(page)
    if not found:
        return ""
    keep = verdicts(trained(), features(found))
    return " ".join(b.text for b, k in zip(found, keep.tolist(), strict=True) if k)


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page. A narrow map over whole pages.

    Cases: null or empty markup, or none that counts as main text: empty text; null keys and urls stay; repeated rows stay; empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{markup}`").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
