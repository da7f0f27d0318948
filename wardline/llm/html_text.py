"""Main text of HTML pages by tag-path ratios.

The blocks of text of a page are its leaves; a leaf's tag path leads from the root down to it. Over all leaves of one path
the length of text, its punctuation and its share in links are added up, so a short paragraph is judged by the company of
its like, not alone. Ratios per leaf are fused into a score, scores are smoothed along the tree of paths (a heading
gains from the paragraphs beside it), and paths over a threshold give the content.

A page is judged by itself: no shuffle, and a task holds one page at a time.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column, map_batches

# Kinds of elements, by the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rb rp rt rtc ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# An element of these ends an open one of the second kind, unless one of the third lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
SCOPE = {"table", "td", "th", "caption", "template", "object"}
# Elements that show no text of the article.
UNSEEN = set(
    "head script style noscript template textarea title iframe noembed noframes object canvas svg math audio video select datalist "
    "button fieldset".split()
)
BOILERPLATE = {"nav", "aside", "footer", "menu", "dialog", "search"}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
READERS = set("comment comments commentlist commentary reply replies respond disqus".split())
WORDS = READERS | set(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer foot copyright "
    "sidebar aside widget widgets related recommended recommendations trending popular share sharing social "
    "notice notices cookie cookies consent gdpr alert disclaimer popup modal overlay newsletter subscribe subscription signup signin login "
    "paywall search form".split()
)
HEADERS = {"header", "masthead"}
CONTAINERS = {"article", "main"}
CONTAINER_WORDS = set("article content main post entry story".split())

PUNCTUATION = re.compile("[.,;:!?…。，、；：！？،؛؟।]")
# A path prefix with this share of the scores holds the article.
ARTICLE_SHARE = 0.7
# What a path takes over from each step towards the article's head, and the share of the mean score that makes it content.
SMOOTHING = 0.8
THRESHOLD = 0.05
# A marked element with more of the page's text than this may wrap the page.
WRAPS = 0.5
# The least share of the scores with which an article or main element is the article.
NAMED_SHARE = 0.1

TOKEN = re.compile(
    r"<(?:!--(?:-?>|(?P<comment>.*?)(?:--!?>|\Z))|(?P<bogus>[!?][^>]*>?)"
    r"|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)[^>]*(?:>|\Z)|/[^>]*>)",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|href|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
NAME_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Element(NamedTuple):
    parent: int
    path: int
    name: str
    # Why it is no content: "" (nothing), "sure", or "unless" it wraps the page.
    mark: str


class Leaf(NamedTuple):
    element: int
    text: str
    # Characters within links; white space does not count, here and in the ratios.
    linked: int


class Page(NamedTuple):
    """Elements and leaves in page order; ``paths`` has the parent path and label of each tag path."""

    elements: list[Element]
    leaves: list[Leaf]
    paths: list[tuple[int, str]]


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if rest else {}


def _mark(name: str, words: set[str], given: dict[str, str], in_container: bool) -> str:
    if name in BOILERPLATE or words & READERS or given.get("role", "").lower() in ROLES:
        return "sure"
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower():
        return "sure"
    if name in ("html", "body", *CONTAINERS):
        return "sure" if name == "article" and words & WORDS - CONTAINER_WORDS else ""
    if (name == "header" or words & HEADERS) and not in_container:
        return "unless"
    return "unless" if name == "form" or words & WORDS - HEADERS else ""


def parse(source: str) -> Page:
    """The blocks of a page: text between tags of block elements, character references decoded, white space made one space.

    Open paragraphs, list items and cells end where the standard ends them; an end tag without a start is left out; raw
    text elements run to their end tag or the end of the page.
    """
    elements, leaves = [Element(-1, 0, "", "")], []
    paths, known = [(-1, "")], {}
    stack, buffer = [0], []
    unseen = linked = link_from = 0
    in_link = False
    held = 0  # open article or main elements
    opened: dict[str, int] = {}

    def flush() -> None:
        nonlocal buffer, linked
        text = " ".join("".join(buffer).split())
        if text:
            leaves.append(Leaf(stack[-1], text, linked))
        buffer, linked = [], 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece and not unseen:
            piece = html.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            if in_link:
                linked += sum(map(len, piece.split()))

    def close(to: int) -> None:
        """Leave all elements above the first ``to`` of the stack."""
        nonlocal unseen, in_link, held
        flush()
        for e in stack[to:]:
            name = elements[e].name
            opened[name] -= 1
            unseen -= name in UNSEEN
            held -= name in CONTAINERS
        del stack[to:]
        in_link = in_link and len(stack) >= link_from

    def end(names: set[str], within: set[str]) -> bool:
        if not any(opened.get(name) for name in names):
            return False
        for k in range(len(stack) - 1, 0, -1):
            name = elements[stack[k]].name
            if name in names:
                close(k)
                return True
            if name in within:
                return False
        return False

    at = 0
    for_raw = None
    while True:
        if for_raw:
            found = RAW_END[for_raw].search(source, at)
            at, for_raw = (found.start() if found else len(source)), None
        token = TOKEN.search(source, at)
        if token is None:
            say(source[at:])
            break
        say(source[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["close"]:
            if name == "a":
                in_link = False
            elif name == "br":
                buffer.append("\n")
            elif name not in INLINE and name not in ("body", "html"):
                end(HEADINGS if name in HEADINGS else {name}, SCOPE - {name})
            continue
        if name in ("br", "wbr"):
            if name == "br":
                buffer.append("\n")
            continue
        if name == "a":
            in_link, link_from = "href" in token["rest"].lower(), len(stack)
            continue
        if name in INLINE:
            continue
        if name in ENDS_P:
            end({"p"}, SCOPE | {"button"})
            if name in HEADINGS and elements[stack[-1]].name in HEADINGS:
                close(len(stack) - 1)
        if name in ENDS:
            end(*ENDS[name])
        if name == "body" and elements[stack[-1]].name == "head":
            close(len(stack) - 1)
        flush()
        if name in VOID or name in ("html", "body") and opened.get(name):
            continue
        given = _attributes(token["rest"])
        words = {w.lower() for k in ("class", "id") if k in given for w in NAME_WORD.findall(given[k])}
        label = " ".join([name, *sorted(words)])
        above = elements[stack[-1]]
        path = known.get((above.path, label))
        if path is None:
            path = known[above.path, label] = len(paths)
            paths.append((above.path, label))
        stack.append(len(elements))
        elements.append(Element(stack[-2], path, name, _mark(name, words, given, held > 0)))
        opened[name] = opened.get(name, 0) + 1
        unseen += name in UNSEEN
        held += name in CONTAINERS
        if name in RAW:
            for_raw = name
    flush()
    return Page(elements, leaves, paths)


def _marked(page: Page) -> list[bool]:
    """Whether each element lies in menus, notices and the like.

    A mark that wrappers may carry too (a form around the whole page, a class of many words) counts unless the element
    has most of the page's text, headings or paragraphs, and all article and main elements.
    """
    n = len(page.elements)
    size, blocks, held = [0] * n, [0] * n, [0] * n
    for leaf in page.leaves:
        size[leaf.element] += len(leaf.text)
    for e in range(n - 1, 0, -1):
        own = page.elements[e]
        blocks[e] += own.name == "p" or own.name in HEADINGS
        held[e] += own.name in CONTAINERS and not own.mark
        if own.mark != "sure":
            size[own.parent] += size[e]
            blocks[own.parent] += blocks[e]
            held[own.parent] += held[e]
    out = [False] * n
    for e, own in enumerate(page.elements[1:], 1):
        wraps = size[e] > WRAPS * size[0] and blocks[e] > 0 and held[e] == held[0]
        out[e] = out[own.parent] or own.mark == "sure" or own.mark == "unless" and not wraps
    return out


class Scored(NamedTuple):
    path: int
    text: str
    score: float
    chosen: bool


def score(page: Page) -> list[Scored]:
    """Every leaf with its tag path, the path's smoothed score in units of the article's mean, and whether it is content."""
    n_paths = len(page.paths)
    marked = _marked(page)
    chars, points, linked, leaves = ([0] * n_paths for _ in range(4))
    for leaf in page.leaves:
        if not marked[leaf.element]:
            p = page.elements[leaf.element].path
            chars[p] += len(leaf.text) - leaf.text.count(" ")
            points[p] += len(PUNCTUATION.findall(leaf.text))
            linked[p] += leaf.linked
            leaves[p] += 1
    unlinked = [1 - a / b if b else 0.0 for a, b in zip(linked, chars)]
    # Ratios per leaf: text and punctuation, fused with the share outside links.
    fused = [c / n * (1 + k / n) * u if n else 0.0 for c, k, n, u in zip(chars, points, leaves, unlinked)]
    # Paths come after their parents.
    mass, count = [f * n for f, n in zip(fused, leaves)], list(leaves)
    for p in range(n_paths - 1, 0, -1):
        mass[page.paths[p][0]] += mass[p]
        count[page.paths[p][0]] += count[p]
    head = _article(page, mass)
    mean = [m / c if c else 0.0 for m, c in zip(mass, count)]
    inside, smooth = [False] * n_paths, [0.0] * n_paths
    for p in range(n_paths):
        above = page.paths[p][0]
        inside[p] = p == head or above >= 0 and inside[above]
        if inside[p]:
            smooth[p] = mean[p] if p == head else max(mean[p], SMOOTHING * smooth[above])
    unit = mean[head] or 1.0
    beside = set()
    p = head
    while p > 0:
        p = page.paths[p][0]
        beside.add(p)
    out = []
    for leaf in page.leaves:
        own = page.elements[leaf.element]
        value = smooth[own.path] * unlinked[own.path] ** 2 / unit
        title = own.name == "h1" and page.paths[own.path][0] in beside
        chosen = not marked[leaf.element] and (value >= THRESHOLD or title)
        out.append(Scored(own.path, leaf.text, 0.0 if marked[leaf.element] else value, chosen))
    return out


def _article(page: Page, mass: list[float]) -> int:
    """The path that holds the article: an article or main element's, else the deepest with most of the scores or the container above it."""
    for kind in ("article", "main"):
        named = [p for p in range(1, len(page.paths)) if page.paths[p][1].split(" ")[0] == kind and mass[p] > NAMED_SHARE * mass[0]]
        if named:
            return max(named, key=lambda p: (mass[p], -p))
    best = 0
    for p in range(1, len(page.paths)):
        if page.paths[p][0] == best and mass[p] >= ARTICLE_SHARE * mass[0] and mass[0]:
            best = p
    chain = [best]
    while chain[-1] > 0:
        chain.append(page.paths[chain[-1]][0])
    named = [(p, page.paths[p][1].split(" ")) for p in chain if p]
    if found := [p for p, w in named if w[0] not in ("html", "body") and CONTAINER_WORDS & set(w[1:])]:
        return found[0]
    # No sign of a container: the next block that can hold headings and paragraphs side by side.
    return next((p for p, w in named if w[0] in ("div", "body", "td", "html")), 0)


def path_name(page: Page, path: int) -> str:
    labels = []
    while path > 0:
        path, label = page.paths[path]
        labels.append(label)
    return "/" + "/".join(reversed(labels))


def main_text(source: str | None) -> str:
    return " ".join(s.text for s in score(parse(source or "")) if s.chosen)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (the blocks of the article in page order, joined by one space) and n_chars of every row.

    Null or empty html, and html without content, give empty text; null ids and urls stay; repeated rows get a row each;
    other columns are not looked at; empty tables give no rows.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array((main_text(h.as_py()) for h in column(batch, "html")), pa.string())
        return pa.RecordBatch.from_pydict({"page_id": column(batch, "page_id"), "url": column(batch, "url"), "text": texts})

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_batches(rows, work, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))


def content_blocks(pages: DataFrame) -> DataFrame:
    """page_id, place, path, text, score and chosen of every block of text of every page, for a look at the choice."""

    def work(batch: pa.RecordBatch) -> dict:
        parsed = [parse(h.as_py() or "") for h in column(batch, "html")]
        found = [score(p) for p in parsed]
        ids = column(batch, "page_id").to_pylist()
        flat = [s for own in found for s in own]
        return {
            "page_id": pa.array([i for i, own in zip(ids, found) for _ in own], pa.int64()),
            "place": pa.array([k for own in found for k in range(len(own))], pa.int32()),
            "path": pa.array([path_name(p, s.path) for p, own in zip(parsed, found) for s in own], pa.string()), "text": pa.array([s.text for s in flat], pa.string()),
            "score": pa.array([s.score for s in flat], pa.float64()), "chosen": pa.array([s.chosen for s in flat], pa.bool_()),
        }

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html"))
    return map_batches(rows, work, "page_id bigint, place int, path string, text string, score double, chosen boolean")
