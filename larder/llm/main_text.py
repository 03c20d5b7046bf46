"""Main text of web pages by line-block distribution.

Markup is stripped to lines: block tags end a line, and what is never article text (scripts, forms,
menus, adverts, comments and the like, known by tag or by class, id and role) leaves a blank line in
its place, as does a line of links; the bounds of an article leave a gap as wide as a window. Over the text lengths of the lines,
sums of sliding windows are taken. A run starts at a surge point, where a window first has text, and
ends at a dive point, where the window is empty again. Runs whose fullest window is well below that of
the page's fullest run are dropped; inside an article a window counts several times, and the runs of an
article stay or go together. The text between the points of the others is kept whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.llm.rows import append_columns

#: Lines of a window.
WINDOW = 3
#: A run, or an article, is kept if its fullest window has this share of the fullest of all.
LEAST_SHARE = 0.25
#: How many times a window inside an article counts.
ARTICLE_BONUS = 3
#: A line with more of its text inside links than this is navigation.
MOST_LINKED = 0.6

# Names of elements.
RAW = frozenset("script style noscript template textarea title iframe svg select object math canvas audio video".split())
NEVER_TEXT = frozenset("nav footer aside form button dialog menu fieldset label option datalist head".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
ARTICLES = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDED_BY_BLOCKS = frozenset(("p", "li", "dt", "dd"))
# Words in classes, ids and roles of what is not article text.
NOT_ARTICLE = frozenset("""ad ads adv advert adverts advertisement advertising adsense adbox adslot banner banners sponsor sponsored sponsors
promo promos promotion cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay menu menus nav navbar
navigation breadcrumb breadcrumbs toolbar sidebar sidebars aside rail widget widgets related recommended recommendations share sharing social
comment comments commentlist disqus respond reply replies footer header masthead topbar copyright legal login signin signup register subscribe
subscription newsletter search searchbox pager pagination paging skip complementary contentinfo search tagcloud""".split())

#: A name with one of these parts is about something else than the element: "page-with-sidebar", "category-legal".
ABOUT_OTHERS = frozenset("no has with without hide show category tag topic type status format".split())
#: Parts at the end of a name that do not say what the element holds: "related-posts", "ad-slot".
HOLDERS = frozenset("""post posts article articles item items list wrap wrapper container box block section area zone bar slot unit button
buttons link links icon icons inner content body title heading form panel group row col""".split())
#: What the header of these is belongs to the article.
OWN_HEADERS = frozenset("article post entry story page content main".split())
#: On a page without an article, a reading by marks is given up if it leaves less than this share of the text, and so many characters less.
LEAST_LEFT, MOST_MARKED = 0.1, 500

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(?=[\s/>])")
_MARKS = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_RAW_ENDS = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


def _named(word: str, whole: bool) -> bool:
    """Whether a class, id or role says that its element is not article text: by all of the name or, unless ``whole``, its last part that counts."""
    parts = [p.lower() for p in _NAME_PARTS.findall(word)]
    if not parts or not ABOUT_OTHERS.isdisjoint(parts):
        return False
    if "".join(parts) in NOT_ARTICLE:
        return True
    if whole or parts[-1] == "header" and not OWN_HEADERS.isdisjoint(parts):
        return False
    while len(parts) > 1 and parts[-1] in HOLDERS:
        parts.pop()
    return parts[-1] in NOT_ARTICLE


def _marked(attributes: str, whole: bool = False) -> bool:
    """Whether an element is hidden, or a class, id or role says that it is not article text.

    Names are read in parts ("cookieBanner", "ad-slot2"), and with ``whole`` as one; "no-sidebar" and the like say nothing.
    """
    if not attributes.strip():
        return False
    for value in ("".join(m) for m in _MARKS.findall(attributes)):
        if any(_named(word, whole) for word in value.split()):
            return True
    return bool(_HIDDEN.search(attributes))


class _Lines:
    """Lines as they are found: text, characters inside links, and the number of the outermost article around (0: none)."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.inside: list[int] = []
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str, in_link: bool) -> None:
        if raw:
            self.parts.append(raw)
            if in_link:
                self.linked += len(raw.strip())

    def end(self, inside: int, blank: int = 0) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text and (inside or self.linked <= MOST_LINKED * len(text)):
                self.texts.append(text)
                self.inside.append(inside)
            elif text:
                blank = max(blank, 1)
            self.parts, self.linked = [], 0
        self.texts += [""] * blank
        self.inside += [inside] * blank


class _Closings:
    """Tells whether as many elements of a name as are open at a place are closed after it. Reads the page once."""

    def __init__(self, html: str):
        self.html, self.known = html, None

    def __call__(self, at: int, name: str, depth: int) -> bool:
        if self.known is None:
            steps: dict[str, tuple[list[int], list[int]]] = {}
            for match in _NAME.finditer(self.html):
                places, changes = steps.setdefault(match.group(2).lower(), ([], []))
                places.append(match.start())
                changes.append(-1 if match.group(1) else 1)
            self.known = {}
            for found, (places, changes) in steps.items():
                open_after = np.cumsum(changes)
                # The fewest open at this place or a later one, as counted from the start of the page.
                fewest = np.minimum.accumulate(open_after[::-1])[::-1]
                self.known[found] = places, open_after, fewest
        if name not in self.known:
            return False
        places, open_after, fewest = self.known[name]
        first = bisect_left(places, at)
        return first < len(places) and fewest[first] - (open_after[first - 1] if first else 0) + depth <= 0


def to_lines(html: str, by_marks: bool = True) -> tuple[list[str], list[int]]:
    """The lines of a page with markup stripped, blank where something was left out, and the outermost article each stands in (0: none).

    Without ``by_marks``, elements are left out by their tag alone.
    """
    lines, at, articles, number, links = _Lines(), 0, 0, 0, 0
    skipped, depth, closed = "", 0, None  # the element being left out, how many of its name are open, whether it is closed
    closings, last = _Closings(html), html.rfind(">") + 1
    while True:
        # Nothing after the last ">" is a tag: without this bound every "<" there would be followed to the end.
        match = _TAG.search(html, at, last)
        if not skipped:
            tail = match.start() if match else html.find("<!--", at)
            lines.text(html[at:tail if tail >= 0 else len(html)], links > 0)
        if not match:
            break
        at = match.end()
        if match.group().startswith("<!--") and not match.group().endswith("-->"):
            at = len(html)
        closing, name, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if not closing and name in RAW:
            found = _RAW_ENDS[name].search(html, at, last)
            at = found.end() if found else len(html)
            continue
        if skipped:
            ends = closing and name == skipped
            if name == skipped and not attributes.endswith("/"):
                depth += -1 if closing else 1
            implied = skipped in ENDED_BY_BLOCKS and name in BLOCKS and (closing and name != skipped or not closing)
            opened = not closing and name in ARTICLES and not (by_marks and _marked(attributes, True))
            if opened and skipped != "form":
                closed = closings(at, skipped, depth) if closed is None else closed
                opened = not closed
            if not (ends and depth <= 0 or implied or opened):
                continue
            skipped = ""
            if ends:
                continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            elif name in ARTICLES:
                lines.end(number if articles else 0)
                articles = max(0, articles - 1)
                lines.end(number if articles else 0, 0 if articles else WINDOW)
            elif name in BLOCKS:
                lines.end(number if articles else 0)
            continue
        never = name in NEVER_TEXT or name == "header" and not articles
        if name not in VOID and name not in ("html", "body") and (never or by_marks and _marked(attributes, name in ARTICLES)):
            if never or name in BLOCKS:  # others are part of a line
                lines.end(number if articles else 0, 1)
            if not attributes.endswith("/"):
                skipped, depth, closed = name, 1, None
            continue
        if name == "a":
            links += 1
        elif name == "br":
            lines.text(" ", False)
        elif name in ARTICLES:
            lines.end(number if articles else 0, 0 if articles else WINDOW)
            number += not articles
            articles += 1
            links = 0
        elif name in BLOCKS:
            lines.end(number if articles else 0)
            links = 0
    lines.end(number if articles else 0)
    return lines.texts, lines.inside


def block_runs(sizes: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge point, dive point, fullest window) of each run of windows with text; window i sums lines i to i + window - 1."""
    if not len(sizes):
        return []
    total = np.concatenate(([0], np.cumsum(sizes)))
    ends = np.minimum(np.arange(len(sizes)) + window, len(sizes))
    sums = total[ends] - total[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], sums > 0, [0]))))
    return [(int(a), int(b), int(sums[a:b].max())) for a, b in zip(edges[::2], edges[1::2])]


def main_text(html: str) -> str:
    """The article's blocks, one on a line; empty if the page has none.

    What is found in an article stands, however much text around it is marked as something else. Otherwise a
    page nearly all of whose text is marked is read again without the marks.
    """
    lines, inside = to_lines(html)
    found, in_article = _body(lines, inside)
    if not in_article and (len(found) < len(html) * LEAST_LEFT or not found):
        unmarked, _ = _body(*to_lines(html, False))
        if not found or len(found) < LEAST_LEFT * len(unmarked) and len(unmarked) - len(found) >= MOST_MARKED:
            return unmarked
    return found


def _body(lines: list[str], inside: list[int]) -> tuple[str, bool]:
    """The text of the runs that are kept, and whether an article has some of it."""
    runs = block_runs(np.array([len(x) for x in lines], np.int64))
    if runs:
        owners = [max(inside[i] for i in range(a, b) if lines[i]) for a, b, _ in runs]
        weights = [r[2] * (ARTICLE_BONUS if own else 1) for r, own in zip(runs, owners)]
        articles: dict[int, int] = {}
        for own, weight in zip(owners, weights):
            articles[own] = max(weight, articles.get(own, 0))
        least = LEAST_SHARE * max(weights)
        kept = [(r, own) for r, own, weight in zip(runs, owners, weights) if (articles[own] if own else weight) >= least]
        return "\n".join(x for (a, b, _), _ in kept for x in lines[a:b] if x), any(own for _, own in kept)
    return "", False


_ADDED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points); null and empty pages have an empty text.

    Pages are read whole and independently of one another. Columns of these names are replaced.
    """

    def run(htmls: list[str], part: pa.RecordBatch) -> list[pa.Array]:
        texts = [main_text(h) for h in htmls]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return append_columns(pages, html_col, _ADDED, run)
