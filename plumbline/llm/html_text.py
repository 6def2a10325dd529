"""Main text of web pages by tag-path ratios.

A page is read as blocks: runs of text between block tags, each with the path of open block tags from the root (names and classes), the length
of its text, of the part in links, and its punctuation. Blocks with the same path are taken together: the text length per
block and the punctuation per block are the path's two ratios. Along the page both ratios are smoothed over neighbouring blocks with the same
parent region (Gaussian weights), and fused as their product's square root, times the path's weight by name. A path is content if its
score reaches the bound: a share of the deviation of the fused ratios of the page, and at least a share of its best score. As whole paths
are chosen, short paragraphs of an article stay with its long ones.

Weight by name: paths through regions that by tag, role or class are menus, headers, footers, sidebars, notices, adverts, forms or comments
weigh FAINT, a paragraph or heading named so WEAK, so that one much longer than the others stays; others weigh 1. A class or id names such a
region by a whole token, or by one whose words all are of such regions or of layout ("share-box", not "share-price"). Regions that hold the
article weigh 1 whatever their name: the page's largest article or main region, or its h1 with more text than that where there is no such
region, or most of its unlinked text.

Score: the path's best fused ratio, raised by the page's best one times the share of the page's weighted text that stands under the
same parent, and that of its region by the share of its ``article`` or ``main`` region, so that short paths between long ones stay.

Reading is lenient, as in browsers: attributes in any quotes, comments and raw-text elements skipped, missing end tags of paragraphs,
list items, cells and the like implied, an unknown end tag ignored, a page cut off anywhere read as far as it goes.

Defined cases: null, empty and tag-free input (the last is one block of text). Nothing is cut off or capped; a page is read in
one pass, whose memory follows the page. Pages are rows of their own: ids, repeated rows and other columns do not matter.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMOOTHING = 1           # blocks on each side
THRESHOLD = 0.5         # of the fused ratios' deviation
LEAST_SCORE = 0.3       # of the page's best score
FAINT, WEAK = 0.02, 0.15    # weights of regions, and of paragraphs and headings, named as something else than the article
LINK_SHARE = 0.6        # from which a path is a menu
CONTENT_SHARE = 0.05    # of the page's text that an article region must hold to raise its paths

_NAMES = lambda text: frozenset(text.split())       # noqa: E731

# Fixed values of HTML: what its elements are.
VOID = _NAMES("area base br col embed hr img input link meta param source track wbr")
RAW = _NAMES("script style noscript template iframe object svg math canvas noembed noframes textarea title select audio video")
INLINE = _NAMES("a abbr acronym b bdi bdo big cite code data dfn em font i ins del kbd label mark q rp rt ruby s samp small span strike strong "
                "sub sup time tt u var wbr img nobr")
CLOSES_P = _NAMES("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
                  "main menu nav ol p pre search section table ul")
IMPLIED = {"li": _NAMES("li"), "dt": _NAMES("dt dd"), "dd": _NAMES("dt dd"), "tr": _NAMES("tr td th"), "td": _NAMES("td th"),
           "th": _NAMES("td th"), "option": _NAMES("option"), "thead": _NAMES("thead tbody tfoot tr td th"),
           "tbody": _NAMES("thead tbody tfoot tr td th"), "tfoot": _NAMES("thead tbody tfoot tr td th")}
SCOPES = {"li": _NAMES("ul ol menu"), "dt": _NAMES("dl"), "dd": _NAMES("dl"), "tr": _NAMES("table"), "td": _NAMES("table"),
          "th": _NAMES("table"), "option": _NAMES("select"), "thead": _NAMES("table"), "tbody": _NAMES("table"), "tfoot": _NAMES("table")}
LANDMARKS = _NAMES("article main")
NEVER_WRAPS = _NAMES("nav menu button head search dialog footer")     # outside even with most of the text, if no article region is in it
OUTSIDE = _NAMES("nav footer aside form menu dialog button fieldset head search")
ROLES = _NAMES("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar status")
SPACE = re.compile(r"\s+")

# Words of a class or id that name a region which is not the article's text.
OUTSIDE_WORDS = _NAMES(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer masthead topbar toolbar notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription "
    "signup login comment comments commentlist disqus respond replies reply related recommended recommendations share sharing social "
    "pagination pager copyright disclaimer alert side rail teaser adsbygoogle")
ADDED_WORDS = _NAMES("comment comments commentlist disqus respond replies reply related recommended recommendations")   # often longer than the article
LAYOUT_WORDS = _NAMES(      # beside them in a compound
    "box block area section wrapper wrap container content inner outer list item items bar links link button buttons icons widget widgets panel "
    "top bottom left right center main site page global primary secondary slot unit zone label form header post posts article articles story "
    "stories news thread id js layout col column row")
TEXT_TAGS = _NAMES("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption")
LEAD_WORDS = _NAMES("teaser")       # of a paragraph or heading, the article's lead
HEADER_OF_TEXT = _NAMES("article entry post content story")
NEGATED = _NAMES("has with no without not hide")

# A quote opens a value only straight after "=" and white space; anywhere else it is a character like others, up to ">".
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|["'][^\s>]*+|)"""
_TAG = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<([/]?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+" + _VALUE
                  + r")?)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+|["'][^\s>]*+)|))?""")
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?…、。，；：！？]")


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]
    text: str
    linked: int
    weight: float       # by the names of its regions; 0 if hidden
    article: int        # number of the article region it lies in, 0 for none
    unlinked_marks: int = 0


@dataclass(slots=True)
class Region:
    """An element that is no inline one; numbered as they open, so its contents are the numbers up to ``end``."""
    parent: int         # -1 for none
    tag: str
    suspect: bool       # by tag, role or class
    added: bool         # comments and the like
    hidden: bool
    article: int
    landmark: bool
    end: int = 0
    text: int = 0       # characters without links, hidden ones left out
    headed: int = 0     # h1 elements
    head_text: int = 0
    best: int = 0       # text of the largest article region in it
    inner: int = 0      # text of the article regions in it
    landmark_at: int = -1   # the innermost article region it lies in or is
    weight: float = 1.0


def _attributes(raw: str) -> dict[str, str]:
    """Names and values; of equal names the first, as in browsers."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        value = next((v for v in values if v), "")
        out.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return out


def _names_outside(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is named like a region that is not the article's text."""
    if tag in OUTSIDE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if attributes.get("role", "").strip().lower() in ROLES:
        return True
    for token in attributes.get("class", "").split() + attributes.get("id", "").split():
        if tag == "article":        # often carries settings of the whole page
            if token.lower() in OUTSIDE_WORDS:
                return True
            continue
        if tag in TEXT_TAGS and token.lower() in LEAD_WORDS:
            continue
        if _names_region(token, in_article):
            return True
    return False


def _names_region(token: str, in_article: bool) -> bool:
    """Whether a class or id is a word for such regions, or made of nothing but them and words for layout."""
    if token.lower() in OUTSIDE_WORDS:
        return True
    words = [w.lower() for w in _WORD.findall(token)]
    if not words or words[0] in NEGATED or not all(w in OUTSIDE_WORDS or w in LAYOUT_WORDS for w in words):
        return False
    return not OUTSIDE_WORDS.isdisjoint(words) or ("header" in words and not in_article and HEADER_OF_TEXT.isdisjoint(words))


def _added(attributes: dict[str, str]) -> bool:
    return any(w.lower() in ADDED_WORDS for name in ("class", "id") for w in _WORD.findall(attributes.get(name, "")))


def _weigh(regions: list[Region], texts: list[tuple[int, int]]) -> None:
    """Sets ``weight``. ``texts``: region and unlinked characters of each block."""
    for i, r in enumerate(regions):
        up = regions[r.parent] if r.parent >= 0 else None
        r.hidden = r.hidden or (up is not None and up.hidden)
        r.landmark_at = i if r.landmark else up.landmark_at if up is not None else -1
        r.end = i + 1
    total = 0
    for i, n in texts:
        if i < 0:
            total += n
        elif not regions[i].hidden:
            regions[i].text += n
            total += n
    for r in reversed(regions):
        if r.tag == "h1" and r.text:
            r.headed, r.head_text = 1, r.text
        if r.parent >= 0:
            up = regions[r.parent]
            up.end = max(up.end, r.end)
            up.text, up.headed, up.head_text = up.text + r.text, up.headed + r.headed, up.head_text + r.head_text
            up.best, up.inner = max(up.best, r.best, r.text if r.landmark else 0), up.inner + (r.text if r.landmark else r.inner)
    # Article regions that end before a place, and that begin after it.
    landmarks = [(i, r) for i, r in enumerate(regions) if r.landmark]
    by_end = sorted((r.end, r.text) for _, r in landmarks)
    ends, before = [e for e, _ in by_end], list(accumulate((n for _, n in by_end), max, initial=0))
    starts, after = [i for i, _ in landmarks], list(accumulate((r.text for _, r in reversed(landmarks)), max, initial=0))[::-1]
    top = {}            # the outermost article region by its number
    for i, r in landmarks:
        top.setdefault(r.article, i)
    heads = [regions[r.landmark_at] for r in regions if r.tag == "h1" and r.headed and r.landmark_at >= 0]
    heads_end = min((r.end for r in heads), default=len(regions) + 1)
    heads_start = max((r.landmark_at for r in heads), default=-1)
    any_article = any(r.text for _, r in landmarks)
    for i, r in enumerate(regions):
        r.weight = 0.0 if r.hidden else regions[r.parent].weight if r.parent >= 0 else 1.0
        by_name = WEAK if r.tag in TEXT_TAGS and not r.added else FAINT
        if r.weight <= by_name or not r.suspect:
            continue
        apart = max(before[bisect_right(ends, i)], after[bisect_left(starts, r.end)])
        own = r.text - r.inner
        holders = {top[r.article], regions[r.parent].landmark_at} if r.article and top[r.article] < i else ()
        elsewhere = max([apart, *(regions[h].text - regions[h].inner - own for h in holders)])
        if not r.headed and (heads_end <= i or heads_start >= r.end):       # the article's head is elsewhere
            outside = True
        elif r.best:
            outside = r.best < elsewhere
        elif r.headed and not any_article and r.text > 2 * r.head_text:
            outside = False
        else:
            beside = elsewhere > 0 if r.added else 2 * apart > total - r.text
            outside = r.tag in NEVER_WRAPS or 2 * r.text <= total or beside
        if outside:
            r.weight = by_name


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []       # tag and classes, region
    regions: list[Region] = []
    places: list[int] = []                  # region of each block
    parts: list[str] = []
    linked = links = articles = marks = 0
    at, end = 0, len(page)

    def close() -> None:
        nonlocal linked, marks
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text:
                place = stack[-1][1] if stack else -1
                out.append(Block(tuple(t for t, _ in stack), text, linked, 1.0, regions[place].article if stack else 0, marks))
                places.append(place)
            parts.clear()
        linked = marks = 0

    def add(raw: str) -> None:
        nonlocal linked, marks
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)
        else:
            marks += len(_MARKS.findall(text))

    def pop_to(depth: int) -> None:
        close()
        del stack[depth:]

    while at < end:
        found = _TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at:found.start()])
        at = found.end()
        cdata, slash, name, attributes = found.groups()
        if name is None:
            if cdata:
                add(cdata)
            continue
        tag = name.lower()
        if slash:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in INLINE:
                pass
            elif tag in ("br", "p") and not any(t == tag for t, _ in stack):
                parts.append(" ") if tag == "br" else close()
            else:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0].split(".")[0] == tag:
                        pop_to(depth)
                        links = 0
                        break
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag == "a":
            links += 1
            continue
        if tag in INLINE:
            continue
        if tag in ("br", "hr", "wbr") or tag in VOID:
            if tag == "hr":
                close()
            else:
                parts.append(" " if tag == "br" else "")
            continue
        if tag in CLOSES_P or tag in IMPLIED:
            for depth in range(len(stack) - 1, -1, -1):
                open_tag = stack[depth][0].split(".")[0]
                if open_tag == "p" or open_tag in IMPLIED.get(tag, ()):
                    pop_to(depth)
                    if open_tag != "p":
                        break
                elif open_tag in SCOPES.get(tag, ()) or tag not in IMPLIED:
                    break
        if tag == "body":       # the head ends where the body begins
            for depth, (open_tag, _) in enumerate(stack):
                if open_tag.split(".")[0] == "head":
                    pop_to(depth)
                    break
        close()
        given = _attributes(attributes) if attributes else {}
        parent = stack[-1][1] if stack else -1
        article = regions[parent].article if stack else 0
        suspect = _names_outside(tag, given, bool(article))
        landmark = tag in LANDMARKS or given.get("role", "").strip().lower() in LANDMARKS
        if landmark and not article:
            articles += 1
            article = articles
        hidden = "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true"
        hidden = hidden and tag not in ("html", "body", "main")
        stack.append((".".join([tag, *sorted(given.get("class", "").split())]), len(regions)))
        regions.append(Region(parent, tag, suspect, suspect and _added(given), hidden, article, landmark))
    close()
    _weigh(regions, [(place, max(0, len(b.text) - b.linked)) for place, b in zip(places, out)])
    for place, b in zip(places, out):
        b.weight = regions[place].weight if place >= 0 else 1.0
    return out


def _smoothed(values: np.ndarray, regions: list) -> np.ndarray:
    """Gaussian mean over neighbours in the same region."""
    out = np.empty(len(values))
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - SMOOTHING), min(len(values), i + SMOOTHING + 1)):
            if regions[j] == regions[i]:
                w = math.exp(-((i - j) ** 2) / 2)
                total, weight = total + w * values[j], weight + w
        out[i] = total / weight
    return out


def scores(found: list[Block]) -> tuple[dict[tuple, float], float]:
    """Score of each path and weight among the blocks, and the bound that content reaches."""
    paths: dict[tuple, list[float]] = {}
    parents: dict[tuple, float] = {}
    articles: dict[int, float] = {}
    total = 0.0
    for b in found:
        sums = paths.setdefault((b.path, b.weight), [0, 0, 0])
        sums[0] += len(b.text)
        sums[1] += len(_MARKS.findall(b.text))
        sums[2] += 1
        size = b.weight * len(b.text)
        total += size
        parents[b.path[:-1]] = parents.get(b.path[:-1], 0.0) + size
        articles[b.article] = articles.get(b.article, 0.0) + size
    regions = [(b.path[:-1], b.weight) for b in found]
    per_path = {k: (n / m, (marks + 0.5) / m) for k, (n, marks, m) in paths.items()}
    length = _smoothed(np.array([per_path[b.path, b.weight][0] for b in found]), regions)
    marks = _smoothed(np.array([per_path[b.path, b.weight][1] for b in found]), regions)
    fused = np.sqrt(length * marks)
    best: dict[tuple, float] = {}
    tops: dict[int, float] = {}
    for b, f in zip(found, fused):
        best[b.path, b.weight] = max(best.get((b.path, b.weight), 0.0), float(f))
        tops[b.article] = max(tops.get(b.article, 0.0), b.weight * float(f))
    out: dict[tuple, float] = {}
    for b in found:
        share = articles[b.article] / total if b.article else 0.0
        lift = max(parents[b.path[:-1]] / total * max(tops.values()), share * tops[b.article] if share >= CONTENT_SHARE else 0.0)
        key = b.path, b.weight
        out[key] = max(out.get(key, 0.0), b.weight * (best[key] + lift))
    top = max((v for (_, weight), v in out.items() if weight > FAINT), default=math.inf)    # no bound is reached if all are named otherwise
    weights = np.array([b.weight for b in found])
    return out, min(max(THRESHOLD * float(np.std(weights * fused)), LEAST_SCORE * top), top)


def content_blocks(found: list[Block]) -> list[Block]:
    """The blocks whose paths are content."""
    seen = [b for b in found if b.weight > 0]
    if not seen:
        return []
    links: dict[tuple, list[int]] = {}
    for b in seen:
        sums = links.setdefault((b.path, b.weight), [0, 0, 0, 0])
        sums[0] += len(b.text)
        sums[1] += b.linked
        sums[2] += b.unlinked_marks if b.article else 0
        sums[3] += 1
    # An article's sentences may be mostly links; a menu has no marks between its own.
    menus = {k for k, (n, linked, marks, m) in links.items() if linked >= LINK_SHARE * n and marks < m}
    candidates = [b for b in seen if (b.path, b.weight) not in menus]
    if not candidates:
        return []
    by_path, bound = scores(candidates)
    return [b for b in candidates if by_path[b.path, b.weight] >= bound]


def main_text(page: str) -> str:
    return "\n".join(b.text for b in content_blocks(blocks(page)))


@F.arrow_udf(T.StringType())
def extracted(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
    from plumbline.llm.words import texts

    for batch in column:
        yield pa.array([main_text(data.decode("utf-8", "replace")) for data in texts(batch)], pa.string())


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    return pages.select("page_id", "url", extracted("html").alias("text"))
