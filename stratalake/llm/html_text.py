"""Main text of web pages by tag-path ratios.

A page is read in one pass into elements and text blocks. A block's root-to-leaf tag path names its block
elements and what their attributes say of them. For each path, text length, punctuation and linked text are
summed over its blocks and divided by their number (links by the length). Length and punctuation are smoothed over
the blocks in page order and fused by multiplication with the share of text that isn't linked and with a prior
for what names say. Blocks over the threshold are content, and content decides the rest:

* Only scripts, styles, templates, heads, frames and what is hidden hold no text at all.
* Other tags, roles, classes and ids that stand for boilerplate (menu, form, footer, advert, sidebar, notice) are evidence.
  Such an element goes unless it holds over half of the content and also the page's main heading, an article or a main part, or
  four fifths of it, or nothing lies outside such elements, and no article or main part elsewhere has text. So a form or a button around the whole page is no loss.
* Reader comments go however long they are, as long as other content is left: elements that are named so, and
  repeated siblings without headings that each show a date (``repeated_remarks``).
* A header in an article or main part stays if it holds a heading.
* The container is what articles and main parts hold, if that is most of the content, else the deepest element around all
  content. Within it, a path under the threshold goes if it is mostly links in three blocks or more, or
  if only part of a class names boilerplate; every other block stays.

Rules of text: character references are decoded, white space in a block becomes one space, blocks are
joined by one line feed. A line break element is white space.

Defined results: a null or empty page, or one without content, has an empty text; unclosed and stray tags are repaired as
browsers do for paragraphs, lists and tables, or ignored; a quote that is never closed is part of its attribute; an unclosed
comment, script, style or tag runs to the end of the page; repeated rows are pages like others. Cost is linear in the
page's length, whatever its markup (deep nesting, unclosed tags, stray ends). Each page is worked on by itself,
in one pass over the table without a shuffle.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.batches import appended

# fixed values: names of HTML elements and of what authors call parts of pages
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article blockquote body button center details dialog div dl fieldset figure form html main ol section table tbody td th tr ul".split())
RAW = frozenset("script style textarea title xmp iframe noscript noembed noframes".split())
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
HIDDEN = RAW | frozenset("head template svg annotation annotation-xml".split())
EVIDENCE = frozenset("nav header footer aside form button select menu dialog search label object audio video canvas".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
COMMENTS = frozenset("comment comments commentary commentlist discussion disqus replies reply respond".split())
NAMES = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies feedback"
    " footer form gdpr header hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination"
    " popup promo promoted promotion recommended related search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe subscription toolbar widget widgets alert".split())
NEUTRAL = frozenset(
    "area bar block body bottom box col column container content global group holder inner item items left link links list main module outer panel primary"
    " region right secondary section site slot text thread title top unit wrap wrapper".split())
STATES = frozenset("has with without no not is tag category cat show hide type format".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
SCOPE = frozenset("html table td th caption object template".split())
P_SCOPE, LI_SCOPE, DL_SCOPE = SCOPE | {"button"}, SCOPE | {"ul", "ol", "menu"}, SCOPE | {"dl"}
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"

# every quantifier is possessive: a tag is read once, and fails only where the page ends in it
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|(?![\"'])([^\s>]*+)))?+")
_MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"</?[a-zA-Z]")
_TELLING = re.compile(r"class|id|role|hidden|style", re.I)
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_WORDS = re.compile(r"[A-Za-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？؟¿¡]")
_DATE = re.compile(
    rf"\b\d{{4}}-\d\d-\d\d|\b\d\d?[./]\d\d?[./]\d{{2,4}}\b|\b(?:{MONTHS})[a-z]*\.? \d\d?,? \d{{4}}|\b\d\d?\.? (?:{MONTHS})[a-z]*\.? \d{{4}}"
    r"|\b\d+ (?:second|minute|hour|day|week|month|year)s? ago", re.I)

#: What an element's tag and attributes say, with the prior of its path.
PLAIN, PART, NAMED, COMMENT, GONE = range(5)
PRIOR = (1.0, 0.3, 0.1, 0.1, 0.0)


@lru_cache(maxsize=4096)
def named(token: str) -> int:
    """What one class or id says."""
    words = [w.lower() for w in _WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token))]
    names = NAMES.intersection([*words, "".join(words)])
    if not names or words[0] in STATES:
        return PLAIN
    if "".join(words) not in NAMES and not all(w in NAMES or w in NEUTRAL for w in words):
        return PART
    return COMMENT if COMMENTS.intersection(names) else NAMED


def said(tag: str, attributes: str) -> int:
    """What an element is by its tag and attributes."""
    if tag in HIDDEN:
        return GONE
    most = NAMED if tag in EVIDENCE else PLAIN
    if tag in ("html", "body", "main") or not _TELLING.search(attributes):
        return most
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name not in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            continue
        value = html.unescape(m[2] or m[3] or m[4] or "")
        if name in ("class", "id"):
            most = max([most, *(named(t[:100]) for t in value.split())])
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return GONE
        elif value.strip().lower() in (ROLES if name == "role" else ("true",)) and name != "style":
            most = max(most, NAMED)
    return most


class Page:
    """Elements in the order of their start tags, and blocks of text.

    Element 0 holds the page. ``pieces`` are a block's texts with their innermost elements, ``places`` the blocks'
    elements, ``linked`` the characters of their links. Parents have lower numbers than their children.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.kinds, self.paths = [""], [0], [PLAIN], [0]
        self.priors, self.dated = [1.0], set()
        self.pieces: list[list[tuple[int, str]]] = []
        self.places: list[int] = []
        self.linked: list[int] = []
        self._names: dict[tuple[int, str, int], int] = {}
        # open elements, and the places in that stack of block elements and of each tag
        self._stack, self._blocks, self._opened = [0], [], {}
        self._now: list[tuple[int, str]] = []
        self._place, self._links, self._gone = -1, 0, 0
        self._read(source)
        self._flush()

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            markup = _MARKUP.search(source, at)
            start = markup.start() if markup else end
            self._text(source[at:start])
            if not markup:
                return
            m = _TAG.match(source, start)
            if m:
                at, tag = m.end(), m[2].lower()
                if m[1]:
                    self._close(tag)
                    continue
                self._open(tag, m[3])
                if tag in RAW:
                    close = _RAW_END[tag].search(source, at)
                    at = close.start() if close else end
            elif source.startswith("<!--", start):
                close = _COMMENT_END.search(source, start + 2)
                at = close.end() if close else end
            elif _NAME.match(source, start):
                return
            else:
                close = source.find(">", start)
                at = close + 1 if close >= 0 else end

    def _text(self, text: str) -> None:
        if not text:
            return
        if self._opened.get("head") and self._gone and not text.isspace() and self.tags[self._stack[-1]] == "head":
            self._pop(self._opened["head"][-1])
        if self._gone:
            return
        if self._place < 0 and not text.isspace():
            self._place = self._stack[self._blocks[-1] if self._blocks else 0]
        self._now.append((self._stack[-1], html.unescape(text) if "&" in text else text))
        if self._opened.get("a"):
            self._links += len(text)

    def _flush(self) -> None:
        if self._place >= 0:
            self.pieces.append(self._now)
            self.places.append(self._place)
            self.linked.append(self._links)
        self._now, self._place, self._links = [], -1, 0

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in HEAD and self._opened.get("head"):
            self._pop(self._opened["head"][-1])
        if tag in BLOCKS:
            self._flush()
            self._end("p", P_SCOPE)
        if tag == "li":
            self._end("li", LI_SCOPE)
        elif tag in ("dt", "dd"):
            self._end("dt", DL_SCOPE)
            self._end("dd", DL_SCOPE)
        elif tag in ("td", "th", "tr"):
            for cell in ("td", "th", "tr")[: 3 if tag == "tr" else 2]:
                self._end(cell, {"table"})
        elif tag == "option":
            self._end("option", {"select"})
        elif tag == "a":
            self._end("a", SCOPE)
        elif tag == "br" and self._now:
            self._now.append((self._now[-1][0], " "))
        if tag == "time" and not self._gone:
            self.dated.add(self._stack[-1])
        if tag in VOID:
            return
        kind, parent = said(tag, attributes), self._stack[-1]
        path = self.paths[parent]
        if tag in BLOCKS:
            key = (path, tag, kind)
            if key not in self._names:
                self._names[key] = len(self.priors)
                self.priors.append(min(self.priors[path], PRIOR[kind]))
            path = self._names[key]
            self._blocks.append(len(self._stack))
        self._opened.setdefault(tag, []).append(len(self._stack))
        self._stack.append(len(self.tags))
        self._gone += kind == GONE
        self.tags.append(tag)
        self.parents.append(parent)
        self.kinds.append(kind)
        self.paths.append(path)

    def _pop(self, position: int) -> None:
        while len(self._stack) > position:
            element = self._stack.pop()
            self._opened[self.tags[element]].pop()
            if self.tags[element] in BLOCKS:
                self._blocks.pop()
            self._gone -= self.kinds[element] == GONE

    def _end(self, tag: str, limits: frozenset[str] | set[str]) -> None:
        """Ends the innermost open element of this tag, unless one of the limits is open within it."""
        mine = self._opened.get(tag)
        if not mine:
            return
        for t in limits:
            other = self._opened.get(t)
            if other and other[-1] > mine[-1]:
                return
        self._pop(mine[-1])

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._end(tag, {"table"} if tag in ("td", "th", "tr", "tbody", "thead", "tfoot") else () if tag in SCOPE else SCOPE)
        elif tag in HIDDEN:
            self._end(tag, ())
        elif self._opened.get(tag) and self._opened[tag][-1] > (self._blocks[-1] if self._blocks else 0):
            self._pop(self._opened[tag][-1])

    def texts(self, without: np.ndarray | None = None) -> list[str]:
        """Blocks' texts, but for elements that go."""
        return [" ".join("".join(t if without is None or not without[e] else " " for e, t in piece).split()) for piece in self.pieces]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Blocks' values summed over each element's subtree."""
        found = np.bincount(self.places, values, len(self.tags)) if self.places else np.zeros(len(self.tags))
        return self.upwards(found)

    def upwards(self, found: np.ndarray) -> np.ndarray:
        total = found.tolist()
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
        return np.array(total)

    def within(self, chosen: np.ndarray) -> np.ndarray:
        """Which elements are, or lie in, a chosen one."""
        found = chosen.tolist()
        for e in range(1, len(found)):
            found[e] = found[e] or found[self.parents[e]]
        return np.array(found, bool)


def smoothed(values: np.ndarray, radius: int = 2, width: float = 1.0) -> np.ndarray:
    """A Gaussian mean over neighbours in page order."""
    weights = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * width**2))
    padded = np.pad(values, radius)
    return sum(w * padded[k : k + len(values)] for k, w in enumerate(weights)) / np.convolve(np.ones(len(values)), weights, "same")[: len(values)] if len(values) > 2 * radius else values


def path_scores(texts: list[str], paths: list) -> np.ndarray:
    """Fused, smoothed ratios of length and punctuation per tag path, for each block."""
    _, which = np.unique(np.array(paths), return_inverse=True)
    n = np.bincount(which)
    length = np.bincount(which, [len(t) for t in texts]) / n
    marks = np.bincount(which, [len(_PUNCTUATION.findall(t)) for t in texts]) / n
    return smoothed(length[which]) * (1 + smoothed(marks[which]))


def path_links(texts: list[str], paths: list, linked: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Each block's path: its share of linked text and its number of blocks."""
    _, which = np.unique(np.array(paths), return_inverse=True)
    share = np.bincount(which, linked) / np.maximum(np.bincount(which, [len(t) for t in texts]), 1)
    return np.minimum(share, 1)[which], np.bincount(which)[which]


def over_threshold(scores: np.ndarray) -> np.ndarray:
    """Which blocks are content."""
    content = scores >= 0.5 * min(scores.std(), scores.max()) if len(scores) > 1 else np.ones(1, bool)
    content[np.argmax(scores)] = True
    return content


def repeated_remarks(page: Page, texts: list[str]) -> np.ndarray:
    """Elements that are one of two or more siblings with one path, each with a date in a short text of its own and without headings."""
    size = len(page.tags)
    dates = np.zeros(size)
    for e in page.dated:
        dates[e] += 1
    for place, text in zip(page.places, texts):
        if len(text) < 80 and _DATE.search(text):
            dates[place] += 1
    dates = page.upwards(dates)
    headed = page.upwards(np.array([t in HEADINGS for t in page.tags], float))
    main = page.upwards(np.array([t in ("h1", "article", "main") for t in page.tags], float))
    length = page.sums(np.array([len(t) for t in texts], float))
    groups: dict[tuple[int, int], list[int]] = {}
    for e in range(1, size):
        if page.tags[e] in ("article", "div", "li", "section", "dd") and length[e]:
            groups.setdefault((page.parents[e], page.paths[e]), []).append(e)
    found = np.zeros(size, bool)
    for (parent, _), items in groups.items():
        if len(items) > 1 and all(dates[e] and not headed[e] for e in items):
            found[items] = True
            # what stands around the remarks alone, as their heading, is of them too
            remarks = length[items].sum()
            while page.tags[parent] in ("div", "ol", "ul", "section") and not main[parent] and length[parent] - remarks < 100:
                found[parent] = True
                parent = page.parents[parent]
    return found


def boilerplate(page: Page) -> np.ndarray:
    """Which elements go for what names, tags and structure say of them, weighed by the content that they hold."""
    texts = page.texts()
    paths = [page.paths[e] for e in page.places]
    content = over_threshold(path_scores(texts, paths) * (1 - path_links(texts, paths, page.linked)[0]))
    weight = np.array([len(t) for t in texts], float) * content
    places, kinds, tags = np.array(page.places), np.array(page.kinds), np.array(page.tags)
    main = np.isin(tags, ("article", "main"))
    headings = page.upwards(np.isin(tags, tuple(HEADINGS)).astype(float)) > 0
    remarks = (kinds == COMMENT) | repeated_remarks(page, texts)
    evidence = (kinds == NAMED) & ~((tags == "header") & headings & page.within(main))
    said_so = page.within(remarks)[places]
    if not weight[~said_so].sum():
        remarks[:], said_so = False, np.zeros(len(places), bool)
    weight = weight * ~said_so
    total = weight.sum()
    held = page.sums(weight)
    free = weight[~page.within(evidence)[places]].sum()
    first = page.upwards((main | (tags == "h1")).astype(float)) > 0
    in_main = page.within(main)
    elsewhere = (in_main & ~page.within(evidence | remarks))[places].any()
    excused = (2 * held > total) & (first | ((held >= 0.8 * total) | (free == 0)) & (in_main | (not elsewhere)))
    return page.within(remarks | evidence & ~excused)


def main_text(source: str | None) -> str:
    page = Page(source or "")
    if not page.places:
        return ""
    gone = boilerplate(page)
    texts = page.texts(gone)
    kept = [k for k, t in enumerate(texts) if t]
    if not kept:
        return ""
    texts, places = [texts[k] for k in kept], np.array([page.places[k] for k in kept])
    paths = [page.paths[e] for e in places]
    links, blocks = path_links(texts, paths, [page.linked[k] for k in kept])
    part = page.within(np.array(page.kinds) == PART)[places]
    scores = path_scores(texts, paths) * (1 - links) * np.where(part, PRIOR[PART], 1.0)
    content = over_threshold(scores)
    weight = np.array([len(t) for t in texts], float) * content
    inside = page.within(np.isin(page.tags, ("article", "main")))[places]
    if (weight * inside).sum() < 0.5 * weight.sum():
        counts = np.bincount(places[content], minlength=len(page.tags)).astype(float)
        around = (page.upwards(counts) == content.sum()) & (np.isin(page.tags, tuple(CONTAINERS)) | (np.arange(len(page.tags)) == 0))
        deepest = np.zeros(len(page.tags), bool)
        deepest[np.flatnonzero(around)[-1]] = True
        inside = page.within(deepest)[places]
    stays = inside & (content | ~(((links > 0.8) & (blocks > 2)) | part))
    return "\n".join(t for t, s in zip(texts, stays) if s)


def extracted(pages: DataFrame, source: str = "html") -> DataFrame:
    """``row`` (all columns of ``pages``), ``main`` (the text) and ``size`` (its code points)."""

    def work():
        def extract(batch: pa.RecordBatch) -> list:
            texts = [main_text(h) for h in batch.column(0).to_pylist()]
            return [texts, [len(t) for t in texts]]

        return extract

    return appended(pages, {"html": source}, "main string, size bigint", work, "html")


def report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    return extracted(pages.select("page_id", "url", "html")).select("row.page_id", "row.url", F.col("main").alias("text"), F.col("size").alias("n_chars"))
