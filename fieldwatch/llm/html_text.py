"""Main text of web pages by the maximum-scoring contiguous run.

A page is read as a run of words and tags. A word scores by where it stands: the log-odds, fitted on labelled pages, that a word
with these landmark elements, class and id names around it, and inside a link or not, is content. A tag scores
negative, the more the less its kind occurs in content. One linear scan finds the run with the largest sum; of it, the words with
positive scores are the text, so adverts inside an article go. Pages are handled where they are read; nothing is shuffled.

Blocks (paragraphs, headings, list items and the like) are joined by one line feed, white space within is one space, character references
are decoded. Script, style, head, template and form control contents are never words, nor is what an svg holds beside its texts. A head without an end tag
ends at the first thing that can't stand in one, and a silent element that nothing closes at the next block.

Defined results: null, empty or word-free pages have the empty text. Broken or cut markup is read as far as it goes. Null and repeated
page_ids are carried along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm import labelled_pages

#: Fixed values of HTML: elements that stand apart, have no end, hold no text, close an open paragraph, or mark a page's regions.
BLOCKS = frozenset("address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title noscript template textarea select option button iframe svg".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
SVG_TEXT = frozenset("text foreignobject".split())
MAY_STAY_OPEN = frozenset("noscript template textarea select button iframe svg".split())
"""Silent elements that a page may forget to close."""
_TAGS = r"(?:<(?!/?title)[^<>]*>[^<]*){1,4}"
OPEN_TITLE = re.compile(r"(?i)(<title\b[^<>]*>[^<]*)(?=</?(?:head|meta|link|script|style|base|noscript|template|%s)\b)(?!%s</title)" % ("|".join(sorted(BLOCKS | {"html"})), _TAGS))
"""A title whose end tag is missing, up to the tag that shows it."""
TAGS_IN_TITLE = re.compile(rf"(?i)(<title\b[^<>]*>[^<]*){_TAGS}(?=</title)")
"""A title that writes of tags; they are its text."""
LANDMARKS = frozenset("article main nav header footer aside form".split())
CUT_TAG = re.compile(r"<[A-Za-z/!?][^<>]*$")
"""A tag that the page's end cuts off."""
HOMES = frozenset(("<article>", "<main>"))
LIMIT = 3.0


class Tokens(HTMLParser):
    """Lists of tokens: (features of the place, words, text, block) for text and (tag, 0, '', block) for tags."""

    def __init__(self, open_ends: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, frozenset[str], int, int]] = []  # tag, names, what it adds to silent, its number
        self.silent, self.block, self.number = 0, 0, 0
        self.open_ends = open_ends
        self.left_open: set[int] = set()
        self.out: list[tuple[frozenset[str] | str, int, str, int]] = []
        self._place: frozenset[str] | None = None

    def place(self) -> frozenset[str]:
        if self._place is None:
            found = {f"<{tag}>" for tag, *_ in self.stack if tag in LANDMARKS}.union(*(names for _, names, *_ in self.stack))
            self._place = frozenset(found | {"link"} if any(tag == "a" for tag, *_ in self.stack) else found)
        return self._place

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._place = None
        self.number += 1
        if tag == "body" or tag not in IN_HEAD and self.stack and self.stack[-1][0] in ("head", "title"):
            self._close("head")
        if tag in BLOCKS:
            self.block += 1
            for k, (*_, number) in enumerate(self.stack if self.open_ends else ()):
                if number in self.open_ends:
                    self._cut(k)
                    break
            if self.stack and any(t == "p" for t, *_ in self.stack):
                self._close("p", stop=BLOCKS - {"p"} | SILENT)
        self.out.append((tag, 0, "", self.block))
        if tag == "br" and not self.silent:
            self.out.append((self.place(), 0, " ", self.block))
        if tag not in VOID:
            names = frozenset(n for k, v in attrs if k in ("class", "id", "role") and v for n in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower()) if n)
            svg_text = tag in SVG_TEXT and any(t == "svg" for t, *_ in self.stack)
            adds = -1 if svg_text else int(tag in SILENT)
            self.stack.append((tag, names, adds, self.number))
            self.silent += adds
            if svg_text and not self.silent:
                self.out.append((self.place(), 0, " ", self.block))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, stop: frozenset[str] = frozenset()) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.left_open.update(number for t, _, _, number in self.stack[k + 1 :] if t in MAY_STAY_OPEN)
                self._cut(k)
                return
            if self.stack[k][0] in stop:
                return

    def _cut(self, k: int) -> None:
        """Ends the k-th open element and those in it."""
        self._place = None
        self.silent -= sum(adds for _, _, adds, _ in self.stack[k:])
        del self.stack[k:]

    def close(self) -> None:
        super().close()
        self.left_open.update(number for t, _, _, number in self.stack if t in MAY_STAY_OPEN)

    def handle_endtag(self, tag: str) -> None:
        self._place = None
        if tag in SVG_TEXT and not self.silent:
            self.out.append((self.place(), 0, " ", self.block))
        if tag in BLOCKS:
            self.block += 1
        self.out.append((f"/{tag}", 0, "", self.block))
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._close("head")
        if not self.silent:
            self.out.append((self.place(), len(data.split()), data, self.block))


def tokens(html: str) -> list[tuple[frozenset[str] | str, int, str, int]]:
    page = TAGS_IN_TITLE.sub(r"\1", OPEN_TITLE.sub(r"\1</title>", CUT_TAG.sub("", html)))
    reader = Tokens()
    reader.feed(page)
    reader.close()
    if reader.left_open:  # read again, knowing what is never closed
        reader = Tokens(frozenset(reader.left_open))
        reader.feed(page)
        reader.close()
    return reader.out


class Weights:
    """Word scores by place and tag scores by name."""

    def __init__(self, features: dict[str, float], bias: float, tags: dict[str, float]) -> None:
        self.features, self.bias, self.tags = features, bias, tags
        self.known: dict[frozenset[str], float] = {}

    def in_run(self, kind: frozenset[str] | str) -> float:
        """What a word or tag adds to a run. Words of inserts inside an article are left out of the text, so they don't part what stands around them."""
        score = self.of(kind)
        return 0.0 if score < 0 and not isinstance(kind, str) and not HOMES.isdisjoint(kind) else score

    def of(self, kind: frozenset[str] | str) -> float:
        if isinstance(kind, str):
            return self.tags.get(kind, -0.1)
        if kind not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[kind] = max(-LIMIT, min(LIMIT, self.bias + sum(self.features.get(f, 0.0) for f in kind)))
        return self.known[kind]


@lru_cache(maxsize=1)
def fitted() -> Weights:
    """Logistic regression over the words of the labelled pages, by their places; tags by how often they stand between content words."""
    rows, inside, outside = Counter(), Counter(), Counter()
    for parts, _ in labelled_pages.pages():
        reader = Tokens()
        for is_content, markup in parts:
            before = len(reader.out)
            reader.feed(markup)
            for kind, n, _, _ in reader.out[before:]:
                if isinstance(kind, str):
                    (inside if is_content else outside)[kind] += 1
                elif n:
                    rows[kind, is_content] += n
    names = sorted({f for place, _ in rows for f in place})
    at = {f: k for k, f in enumerate(names)}
    x, y, n = np.zeros((len(rows), len(names) + 1)), np.zeros(len(rows)), np.zeros(len(rows))
    for r, ((place, is_content), count) in enumerate(sorted(rows.items(), key=lambda i: (sorted(i[0][0]), i[0][1]))):
        x[r, [at[f] for f in place]] = 1
        x[r, -1], y[r], n[r] = 1, is_content, count
    w = np.zeros(len(names) + 1)
    for _ in range(25):  # Newton's steps, with a small penalty
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (n * (y - p)) - 0.5 * w
        w += np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w)), slope)
    cost = {t: float(np.clip(0.1 * np.log((inside[t] + 1) / (outside[t] + 1)) - 0.1, -1, -0.05)) for t in inside | outside}
    return Weights(dict(zip(names, w[:-1].tolist(), strict=True)), float(w[-1]), cost)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The first of the runs with the largest positive sum, as start and end; (0, 0) if there is none."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, found = total, (start, k + 1)
    return found


def main_text(html: str | None, weights: Weights) -> str:
    if not html:
        return ""
    run = tokens(html)
    scores = [weights.in_run(kind) * (1 if isinstance(kind, str) else n) for kind, n, _, _ in run]
    start, end = best_run(scores)
    blocks: dict[int, list[str]] = {}
    for kind, n, text, block in run[start:end]:
        if not isinstance(kind, str) and (weights.of(kind) > 0 or not n):
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(b for b in joined if b)


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    w = weights or fitted()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), w) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(each, "page_id long, url string, text string, n_chars long")
