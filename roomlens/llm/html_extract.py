"""Main text of web pages, without the templates their sites repeat."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from roomlens.llm.common import MAX_BROADCAST_BYTES, broadcast_if_small
from roomlens.sources.scratch import shared_table

MIN_PAGES = 5

# Element names by their role in HTML.
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
))
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
DROPPED = frozenset((
    "aside", "button", "canvas", "datalist", "dialog", "embed", "footer", "form", "head", "iframe", "input", "map",
    "menu", "nav", "noembed", "noframes", "noscript", "object", "option", "script", "select", "style", "svg",
    "template", "textarea", "title", "xmp",
))
DROPPED_ROLES = frozenset(
    ("alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search")
)
# Class names and ids, as whole words, that mark what is not the article.
_COMMENTS = r"(?:(?:reader|user|visitor|post|page|article)s?[-_]?)?comments?|commentlist|disqus"
_PART = r"(?:[-_](?:area|bar|block|box|buttons?|container|form|items?|links?|list|posts|section|widget|wrapper))?"
_COMMENT_NAMES = re.compile(rf"(?<!\S)(?:{_COMMENTS}){_PART}(?!\S)")
_DROPPED_NAMES = re.compile(
    rf"(?<!\S)(?:{_COMMENTS}|ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar"
    r"|cookie\w*|consent|gdpr|alert(?:[-_]\w+)*|notice|notification|popup|modal|newsletter|subscribe|subscription|share|sharing|social"
    r"|related|recommended|breadcrumb\w*|menu|navbar|nav|navigation|footer|masthead|pagination|pager|skip-?link)"
    rf"{_PART}(?!\S)"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset(("ul", "ol", "dl", "table", "select", "article", "main", "section", "div", "body", "html"))
_LINKS = frozenset(("a", "button", "form", "input", "label", "option", "select"))
_WRAPPERS = frozenset(("div", "section"))
_FIRST, _LAST = 0x5851F42D4C957F2D, 0x14057B7EF767814F  # tell a subtree at an end of a main element from others
OUTSIDE, INSIDE, ARTICLE = 0, 1, 2  # kinds of subtrees that are counted
_WORDS = re.compile(r"\w")
_SECTION = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*/+([^/?#]+)/"
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


class Element:
    """An open or closed element: its digest parts, and the texts directly inside it."""

    __slots__ = ("tag", "dropped", "named", "main", "inside", "parts", "digest", "items")

    def __init__(self, tag: str, dropped: bool, main: bool, inside: bool, named: bool = False):
        self.tag, self.dropped, self.main, self.inside = tag, dropped, main, inside
        self.named = named  # its class or id says that it is not the article
        self.parts: list[str] = []  # what the digest covers
        self.items: list = []  # texts, line breaks (None) and child elements in page order
        self.digest = 0


def _names(attrs: str) -> tuple[str, str]:
    names, role = "", ""
    for key, a, b, c in _ATTRIBUTE.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id"):
            names += " " + value
        elif key == "role":
            role = value
    return names, role


def parse(page: str) -> Element:
    """Element tree of a page; what isn't closed ends with its parent, what isn't open is ignored."""
    root = Element("", False, False, False)
    stack = [root]
    is_open: Counter[str] = Counter()  # open elements by name, so that nothing is searched in vain

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            done = stack.pop()
            is_open[done.tag] -= 1
            done.digest = xxhash.xxh3_64_intdigest("\0".join(done.parts).encode("utf-8", "surrogatepass"))
            stack[-1].parts.append(f"<{done.digest:x}")

    def add_text(text: str) -> None:
        if text:
            text = html.unescape(text)
            stack[-1].items.append(text)
            if squeezed := " ".join(text.split()):
                stack[-1].parts.append(squeezed)

    at = 0
    while match := _TOKEN.search(page, at):
        add_text(page[at : match.start()])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["close"]:
            for depth in range(len(stack) - 1, 0, -1) if is_open[tag] else ():
                if stack[depth].tag == tag:
                    close_to(depth)
                    break
            continue
        if tag in BLOCK and tag not in ("html", "head", "body") and is_open["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close_to(depth)
                    break
                if stack[depth].tag in BLOCK:
                    break
        if tag in _CLOSES and any(is_open[t] for t in _CLOSES[tag]):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in _CLOSES[tag]:
                    close_to(depth)
                    break
                if stack[depth].tag in _SCOPE:
                    break
        if tag == "body" and is_open["head"]:
            for depth in range(1, len(stack)):
                if stack[depth].tag == "head":
                    close_to(depth)
                    break
        names, role = _names(match["attrs"]) if match["attrs"] else ("", "")
        parent = stack[-1]
        whole = tag in ("html", "body")  # a page is no advert, whatever its class says
        dropped = not whole and (tag in DROPPED or role in DROPPED_ROLES)
        main = not dropped and (tag in MAIN or role == "main")
        named = not whole and bool(names) and bool((_COMMENT_NAMES if main else _DROPPED_NAMES).search(names))
        element = Element(tag, dropped, main, parent.inside or parent.main, named)
        element.parts.append(f"{tag}.{names.strip()}")
        parent.items.append(element)
        if tag in VOID or match["attrs"].endswith("/") and tag not in BLOCK and tag not in RAW:
            element.digest = xxhash.xxh3_64_intdigest(element.parts[0].encode("utf-8", "surrogatepass"))
            parent.parts.append(f"<{element.digest:x}")
            continue
        stack.append(element)
        is_open[tag] += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            close_to(len(stack) - 1)
            at = end.end() if end else len(page)
    add_text(page[at:])
    close_to(1)
    root.digest = xxhash.xxh3_64_intdigest("\0".join(root.parts).encode("utf-8", "surrogatepass"))
    _drop_named(root)
    return root


def _drop_named(root: Element) -> None:
    """Drop elements by class or id, but no main element the page needs, nor an ancestor of one.

    Needed are the main elements that no class or id speaks against; without any, those that are not
    named themselves; without any, all.
    """
    above: list[tuple[Element, int, bool]] = [(root, -1, False)]  # element, place of its parent, named so far
    for place, (element, _, named) in enumerate(above):
        above += [
            (i, place, named or i.named) for i in element.items if isinstance(i, Element) and not i.dropped
        ]
    mains = [n for n, (element, _, _) in enumerate(above) if element.main]
    needed = [n for n in mains if not above[n][2]] or [n for n in mains if not above[n][0].named] or mains
    spared: set[int] = set()
    for n in needed:
        while n >= 0 and n not in spared:
            spared.add(n)
            n = above[n][1]
    for n, (element, _, _) in enumerate(above):
        if element.named and n not in spared:
            element.dropped, element.main = True, False


def _candidates(element: Element, free: bool) -> list[tuple[Element, bool]]:
    """Child elements outside main elements, and whether each may go as a template of its own.

    Blocks may, but for cells of a table. Inline elements may if no words stand bare in their line:
    parts of a sentence stay.
    """
    found: list[tuple[Element, bool]] = []
    line: list[Element] = []
    bare = False

    def end_line() -> None:
        found.extend((item, free and not bare) for item in line)

    for item in element.items:
        if not isinstance(item, Element):
            bare = bare or bool(_WORDS.search(item))
        elif item.tag in BLOCK or item.tag == "br":
            end_line()
            line, bare = [], False
            found.append((item, item.tag not in ("td", "th", "br")))
        elif len(item.parts) > 1:
            line.append(item)
        else:
            found.append((item, False))
    end_line()
    return found


def _mostly_links(element: Element) -> bool:
    """Whether a container holds text, no main element, and most of the text in links, buttons or form parts."""
    if element.main or not (element.tag in ("div", "section", "ul", "ol") or "-" in element.tag):
        return False
    linked = total = 0
    left = [(element, False)]
    while left:
        step, in_link = left.pop()
        for item in step.items:
            if isinstance(item, Element):
                if item.main:
                    return False
                left.append((item, in_link or item.tag in _LINKS))
            else:
                size = sum(map(len, item.split()))
                total += size
                linked += size * in_link
    return 2 * linked > total


def _link_blocks(main: Element) -> dict[int, tuple[Element, int]]:
    """id -> (element, key) of the link blocks that a main element begins or ends with.

    Wrappers that hold all of the main element are looked through. Nothing else inside a main element
    may go as a template, however often it recurs: headings, paragraphs and lists of text are article.
    """
    while True:
        content = [i for i in main.items if isinstance(i, Element) or i.strip()]
        if len(content) != 1 or isinstance(content[0], str) or content[0].tag not in _WRAPPERS or content[0].main:
            break
        main = content[0]
    found: dict[int, tuple[Element, int]] = {}
    for order, end in ((content, _FIRST), (content[::-1], _LAST)):
        for item in order:
            if isinstance(item, str) or not (item.dropped or len(item.parts) < 2 or _mostly_links(item)):
                break
            if not item.dropped and len(item.parts) > 1:
                found.setdefault(id(item), (item, item.digest ^ end))
    return found if len(found) < len(content) else {}


def template_candidates(page: str | None) -> set[tuple[int, int, int]]:
    """(kind, key, holder) of the page's subtrees that may go as templates, and of its main elements.

    Outside main elements: subtrees that hold text and no main element. Inside: link blocks at either
    end. The holder is the digest of the main element around the subtree, of the page without one: a
    subtree counts once for each different holder, so copies of a page make no template of its text.
    """
    root = parse(page or "")
    found: set[tuple[int, int, int]] = set()

    order: list[tuple[Element, int, bool]] = [(root, -1, False)]  # a parent before its children
    for place, (element, _, may_go) in enumerate(order):
        if element.main:
            found.add((ARTICLE, element.digest, element.digest))
            found.update((INSIDE, key, element.digest) for _, key in _link_blocks(element).values())
        if element.main or element.inside:
            order += [(item, place, False) for item in element.items if isinstance(item, Element) and not item.dropped]
        else:
            order += [(item, place, may) for item, may in _candidates(element, may_go or element.tag in BLOCK or not element.tag)]
    with_main = [element.main for element, *_ in order]  # a main element, or an ancestor of one
    for place in range(len(order) - 1, 0, -1):
        element, parent, may_go = order[place]
        if with_main[place]:
            with_main[parent] = True
        elif may_go and len(element.parts) > 1 and not element.dropped:
            found.add((OUTSIDE, element.digest, root.digest))
    return found


def main_text(page: str | None, recurring: frozenset[int] | set[int] = frozenset()) -> str:
    """The article's blocks, one a line: the page's main elements, or the whole page without one.

    Elements that are menus, forms, notices and the like by name, and subtrees whose key is in
    ``recurring``, are left out; a main element and its ancestors never go as subtrees, and of its
    inside only link blocks at its ends.
    """
    root = parse(page or "")
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if line := " ".join("".join(held).split()):
            blocks.append(line)
        held.clear()

    def has_main(element: Element) -> bool:
        left = [element]
        while left:
            inner = [i for i in left.pop().items if isinstance(i, Element) and not i.dropped]
            if any(i.main for i in inner):
                return True
            left += inner
        return False

    everything = not has_main(root)
    gone: set[int] = set()
    # What is left to do, last first: a text, the end of a block (None), or an element to enter.
    todo: list = [(root, False, everything, False)]
    while todo:
        step = todo.pop()
        if step is None:
            flush()
            continue
        if isinstance(step, str):
            held.append(step)
            continue
        element, may_go, wanted, titles_only = step
        if element.dropped or id(element) in gone or (
            may_go and not element.main and element.digest in recurring and not has_main(element)
        ):
            held.append(" ")
            continue
        wanted = wanted or element.main
        if element.main and recurring:
            gone |= {known for known, (_, key) in _link_blocks(element).items() if key in recurring}
        if element.tag == "header":
            titles_only = True
        show = wanted and (not titles_only or element.tag in HEADINGS)
        titles_only = titles_only and element.tag not in HEADINGS
        edge = element.tag in BLOCK
        if edge:
            flush()
            todo.append(None)
        if element.tag == "br":
            held.append(" ")
        free = may_go or edge or not element.tag
        outside = not (element.main or element.inside)
        may = {id(e): m for e, m in _candidates(element, free)} if recurring and outside else {}
        for item in reversed(element.items):
            if isinstance(item, Element):
                todo.append((item, may.get(id(item), False), wanted, titles_only))
            elif show:
                todo.append(item)
    flush()
    return "\n".join(blocks)


def _with_keys(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.withColumns({
        "_host": F.lower(F.regexp_extract(url, _HOST, 1)),
        "_section": F.regexp_extract(url, _SECTION, 1),
        "_page": F.xxhash64(F.col("html").cast("string")),
    })


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def page_subtrees(pages: DataFrame) -> DataFrame:
    """(host, section, page, kind, digest, holder) of every subtree that may go, and of the main elements.

    ``page`` is a hash of the page itself: equal pages of a section are one. A section is the first
    folder of a URL's path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [(row, *f) for row, page in enumerate(part["html"]) for f in template_candidates(page.as_py())]
                rows, kinds, digests, holders = zip(*found) if found else ((), (), (), ())
                of = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[c].take(of) for c in ("_host", "_section", "_page")), pa.array(kinds, pa.int8()),
                        pa.array(map(_signed, digests), pa.int64()), pa.array(map(_signed, holders), pa.int64()),
                    ],
                    names=["host", "section", "page", "kind", "digest", "holder"],
                )

    rows = _with_keys(pages).select("_host", "_section", "_page", F.col("html").cast("string"))
    return rows.mapInArrow(run, "host string, section string, page long, kind byte, digest long, holder long").distinct()


def site_templates(subtrees: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, section, digest) of the subtrees that recur; the section is null where it does not count.

    Outside main elements a subtree recurs in ``min_pages`` different pages of its host; that bound does
    not grow with the host. A link block at an end of a main element must stand there in
    ``min_pages`` different main elements of its section, and in half of all that the section has.
    Holders are told apart before they are counted in the tasks, so no host's rows meet in one task.
    """
    section = F.when(F.col("kind") != OUTSIDE, F.col("section")).alias("section")
    once = subtrees.select("host", section, "kind", "digest", "holder").distinct()
    counted = (
        once.where(F.col("kind") != ARTICLE).groupBy("host", "section", "kind", "digest")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    )
    articles = once.where(F.col("kind") == ARTICLE).groupBy("host", "section").agg(F.count(F.lit(1)).alias("articles"))
    outside = counted.where(F.col("kind") == OUTSIDE).select("host", "section", "digest")
    inside = counted.where(F.col("kind") == INSIDE).join(articles, ["host", "section"]).where("2 * n >= articles")
    return outside.union(inside.select("host", "section", "digest"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (columns page_id, url, html).

    Two passes: subtrees are counted per host, then each page is read again without those of its own
    that recur. Recurring subtrees are joined by host and digest, and each page gets the list of its
    own only, so no list grows with a host; tables are broadcast if their measured size allows. An
    article or main element is never taken for a template itself, and of its inside only blocks of
    links at its ends can go, counted once for all copies of the article. Null and empty pages give
    an empty text; pages without a host share the empty host; repeated rows come back as often; other
    columns are ignored. A page is parsed whole in a task, whatever its length. No pages, no rows.
    """
    subtrees = shared_table(page_subtrees(pages), "page-subtrees")
    templates = shared_table(site_templates(subtrees, min_pages), "page-templates")
    small = broadcast_if_small(templates, "octet_length(host) + coalesce(octet_length(section), 0) + 48", max_broadcast_bytes)
    found = subtrees.where(F.col("kind") != ARTICLE).withColumn(
        "counted", F.when(F.col("kind") != OUTSIDE, F.col("section"))
    )
    small = small.withColumnsRenamed({"section": "counted"})
    same = (found["host"] == small["host"]) & (found["digest"] == small["digest"]) & found["counted"].eqNullSafe(small["counted"])
    own = shared_table(
        found.join(small, same, "left_semi").groupBy("host", "section", "page").agg(F.collect_set("digest").alias("digests")),
        "page-own-templates",
    )
    joined = (
        _with_keys(pages).select("page_id", "url", F.col("html").cast("string"), F.col("_host").alias("host"), F.col("_section").alias("section"), F.col("_page").alias("page"))
        .join(broadcast_if_small(own, "8 * size(digests) + octet_length(host) + octet_length(section) + 96", max_broadcast_bytes), ["host", "section", "page"], "left")
        .select("page_id", "url", "html", "digests")
    )
    types = dict(joined.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), {d & (2**64 - 1) for d in digests.as_py() or ()})
                for digests, page in zip(batch["digests"], batch["html"])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return joined.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string")
