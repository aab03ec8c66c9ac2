"""Main text of web pages: what the site repeats is removed.

Pages are parsed into element trees. Block elements are hashed, the whole subtree with its text and the place
where it stands (tags and classes from the root down), and both are counted per host, in Spark. A subtree that
stands in one place on many pages of different content is the site's template. A place whose content
mostly recurs from page to page is one too, with the content that was met once: menus, adverts and
footers take turns. The largest such subtrees are deleted; what holds most of a page's prose never is, nor
are single paragraphs, headings and items between others. Copies of one page are one page.

On the first pages of a host, and beside this, elements go that say themselves by tag, role or
name that they are menus, notices, adverts, comments and the like.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, texts_of

LEAST_PAGES = 3        # of different content, with a template subtree
LEAST_SHARE = 0.05     # of the host's pages of different content
SLOT_SHARE = 0.15      # of what stands in a place, to be met on other pages too
SLOT_PAGES = 0.3       # of the host's pages, to have the place
SLOT_TIMES = 2         # on a page that has it, at most: what comes often on one page are its paragraphs

# Elements of HTML, by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe object svg canvas audio video map select datalist"
    " textarea button annotation annotation-xml".split()
)
CHROME = frozenset("nav menu aside footer form dialog search".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span"
    " strike strong sub sup time tt u var wbr br ruby rb rt rp math semantics mrow mi mo mn ms mtext msup msub msubsup"
    " mfrac msqrt mroot mover munder munderover mtable mtr mtd mspace mstyle mpadded menclose".split()
)
# What ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tr td th ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption caption td th tr".split())
BODY_TEXT = frozenset("p blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner banners"
    " cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login popup popover modal"
    " overlay nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars"
    " header masthead footer toolbar topbar comment comments commentlist disqus respond reply replies share sharing"
    " social related recommended recommendations widget widgets skip".split()
)
# Names of what readers wrote, however much it is.
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies".split())
# What a name of chrome may have beside it, in one class or id: "site-header", but not "no-sidebar".
BESIDE_NAMES = frozenset(
    "site page main left right top bottom primary secondary global wrapper wrap container box bar area block section inner"
    " outer list item items link links post posts entry article fixed sticky mobile desktop first second third row unit slot"
    " text title body panel group icon icons button buttons form".split()
)
# Names that the frame around an article may have for what stands beside the article.
FRAME_NAMES = frozenset("nav navbar navigation menu sidebar sidebars header footer toolbar topbar banner".split())
# What closes an open element of the same parent, and where the search for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
HOLDS_ARTICLE, HOLDS_HEADING = 1, 2   # of what stands below an element


@dataclass(slots=True)
class Element:
    tag: str
    attributes: dict[str, str]
    parent: "Element | None"
    parts: list = field(default_factory=list)   # elements and texts, in order
    number: int = -1
    holds: int = 0
    prose: int = 0    # characters of paragraphs and the like
    size: int = 0     # characters of all text that is seen


def parse(html: str) -> Element:
    """The element tree of a page, as lenient as pages need: ends may be missing or stray."""
    root = Element("#root", {}, None)
    here, at, number = root, 0, 0
    while match := TAG.search(html, at):
        if match.start() > at:
            here.parts.append(unescape(html[at:match.start()]))
        at = match.end()
        if not match.group(2):
            continue
        tag = match.group(2).lower()
        if match.group(1):
            here = _closed(here, tag)
            continue
        here = _opened(here, tag)
        element = Element(tag, _attributes(match.group(3)), here, number=number)
        number += 1
        here.parts.append(element)
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            element.parts.append(html[at:end.start() if end else len(html)])
            at = end.end() if end else len(html)
        elif tag not in VOID:
            here = element   # a slash at the end closes nothing in HTML
    if at < len(html):
        here.parts.append(unescape(html[at:]))
    _measure(root)
    return root


def _measure(root: Element) -> None:
    """Bottom up, what each element holds: every element once, however deep."""
    for e in reversed([root, *_below(root)]):
        for part in e.parts:
            if isinstance(part, str):
                e.size += len(part.strip())
            else:
                e.size += part.size
                e.prose += part.prose
                e.holds |= part.holds
                if part.tag in ("article", "main"):
                    e.holds |= HOLDS_ARTICLE
                elif part.tag in HEADINGS:
                    e.holds |= HOLDS_HEADING
        if e.tag in UNSEEN:
            e.size = e.prose = 0
        elif e.tag in BODY_TEXT:
            e.prose = e.size


def _holds_most(e: Element, root: Element) -> bool:
    """Whether most of the page's prose (of its text, if it has none) is below this element."""
    return 2 * e.prose > root.prose if root.prose else 2 * e.size > root.size


def _attributes(text: str) -> dict[str, str]:
    return {
        m.group(1).lower(): unescape(m.group(2) or m.group(3) or m.group(4) or "") for m in ATTRIBUTE.finditer(text)
    } if text.strip(" /\n\t\r") else {}


def _closed(here: Element, tag: str) -> Element:
    """Where we are after an end tag; a stray one changes nothing."""
    at = here
    while at.parent is not None:
        if at.tag == tag:
            return at.parent
        # An inline end tag does not reach out of the block it stands in.
        if tag in INLINE and at.tag not in INLINE:
            return here
        at = at.parent
    return here


def _opened(here: Element, tag: str) -> Element:
    """Where a new element belongs: blocks end an open paragraph, items their elder."""
    if tag in ENDS_P:
        at = here
        while at.parent is not None and at.tag in INLINE | {"p"}:
            if at.tag == "p":
                here = at.parent
                break
            at = at.parent
    closes, ends = CLOSES.get(tag, ((), ()))
    at = here
    while closes and at.parent is not None and at.tag not in ends:
        if at.tag in closes:
            here = at.parent
        at = at.parent
    return here


def _is_chrome(e: Element, in_article: bool, root: Element) -> bool:
    """Whether an element says itself that it is none of the main text."""
    if e.tag in UNSEEN:
        return True
    if e.tag in CHROME or (e.tag == "header" and not in_article):
        return in_article or not _frames_page(e)
    a = e.attributes
    if not a or e.tag in ("html", "body", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    if a.get("role", "").lower() in ROLES:
        return True
    said = _said(a)
    if not said or not said & COMMENT_NAMES and _holds_most(e, root):
        return False
    if said <= FRAME_NAMES and e.holds & HOLDS_ARTICLE:
        return False
    # The head of an article may be named so, and holds its title.
    return not (in_article and "header" in said and e.holds & HOLDS_HEADING)


def _said(attributes: dict[str, str]) -> set[str]:
    """Names of chrome that classes and id consist of, wholly: a class that also says another thing says that."""
    said = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = {part.lower() for part in NAME_PARTS.findall(name)}
        found = parts & CHROME_NAMES
        if found and all(p in BESIDE_NAMES or p.isdigit() for p in parts - found):
            said |= found
    return said


def _frames_page(e: Element) -> bool:
    """Whether a chrome tag stands around what the page is about: it holds articles or the main
    element and none is outside, or it is a form that holds all of the page's text."""
    if e.tag != "form" and not e.holds & HOLDS_ARTICLE:
        return False
    said, elsewhere, at = [], [], e
    while at.parent is not None:
        elsewhere += [x for x in at.parent.parts if x is not at]
        at = at.parent
    while elsewhere:
        part = elsewhere.pop()
        if isinstance(part, str):
            said.append(part)
        elif part.tag not in UNSEEN:
            if part.tag in ("article", "main"):
                return False
            elsewhere += part.parts
    return bool(e.holds & HOLDS_ARTICLE) or not "".join(said).strip()


def _below(e: Element) -> Iterator[Element]:
    waiting = [e]
    while waiting:
        for part in waiting.pop().parts:
            if isinstance(part, Element):
                yield part
                waiting.append(part)


def subtree_hashes(root: Element) -> dict[int, tuple[int, int]]:
    """For each block element, by number: hash of its subtree and of the place where it stands.

    Subtrees are told apart by tags and text and not by attributes, which may hold counters; places by the tags
    and classes from the root down, without numbers.
    """
    from xxhash import xxh64_intdigest

    order = [root, *_below(root)]
    own: dict[int, int] = {}
    for e in sorted(order, key=lambda x: -x.number):   # children before parents: they come later
        pieces = [e.tag]
        for part in e.parts:
            pieces.append(f"#{own[part.number]:x}" if isinstance(part, Element) else " ".join(part.split()))
        own[e.number] = xxh64_intdigest("\x1f".join(pieces).encode("utf-8", "surrogatepass"))
    places = {root.number: 0}
    for e in sorted(order[1:], key=lambda x: x.number):
        names = re.sub(r"\d+", "", " ".join(sorted(e.attributes.get("class", "").split()))) if e.attributes else ""
        place = f"{places[e.parent.number]:x}/{e.tag}.{names}"
        places[e.number] = xxh64_intdigest(place.encode("utf-8", "surrogatepass"))
    return {
        e.number: (own[e.number], places[e.number])
        for e in order
        if e.parent is not None and e.tag not in INLINE | VOID | UNSEEN | {"html", "body"}
    }


def _articles(root: Element, deleted: Callable[[Element], bool]) -> list[Element]:
    """The elements that hold the main text, of what is not deleted: the main element if it has paragraphs of its own
    outside its articles, else articles that are not comments, else the main element, else
    the whole page."""
    mains = _found(root, deleted, lambda e: e.tag == "main" or e.attributes.get("role", "").lower() == "main")
    if any(_has_own_paragraphs(e, root) for e in mains):
        return mains
    return _found(root, deleted, lambda e: e.tag == "article") or mains or [root]


def _found(root: Element, deleted: Callable[[Element], bool], wanted: Callable[[Element], bool]) -> list[Element]:
    """Elements outside templates and chrome that are wanted, the outermost of them."""
    found, waiting = [], [root]
    while waiting:
        e = waiting.pop()
        if wanted(e):
            found.append(e)
            continue
        waiting += [
            x for x in reversed(e.parts)
            if isinstance(x, Element) and not deleted(x) and not _is_chrome(x, False, root)
        ]
    return found


def _has_own_paragraphs(e: Element, root: Element) -> bool:
    waiting = [e]
    while waiting:
        for part in waiting.pop().parts:
            if isinstance(part, Element) and part.tag != "article" and not _is_chrome(part, True, root):
                if part.tag == "p" and any(isinstance(t, str) and t.strip() for x in (part, *_below(part)) for t in x.parts):
                    return True
                waiting.append(part)
    return False


def main_text(root: Element, templates: set[int] | frozenset[int] = frozenset()) -> str:
    """Blocks of the main text, one to a line. ``templates`` are hashes of subtrees and places to delete."""
    hashes = subtree_hashes(root) if templates else {}

    def known(e: Element) -> bool:
        return e.number in hashes and not templates.isdisjoint(hashes[e.number])

    def deleted(e: Element) -> bool:
        return (
            known(e) and e.tag not in PROSE and not e.holds & HOLDS_ARTICLE and not _holds_most(e, root)
            and not between_prose(e)
        )

    def between_prose(e: Element) -> bool:
        """Whether it is like a paragraph: no blocks in it, and before and after it its like that no template is."""
        if any(isinstance(x, Element) and x.number in hashes for x in e.parts):
            return False
        blocks = [x for x in e.parent.parts if isinstance(x, Element) and x.number in hashes]
        at = next(k for k, x in enumerate(blocks) if x is e)
        beside = blocks[at - 1:at] + blocks[at + 1:at + 2] if at else []
        return len(beside) == 2 and not any(known(x) or hashes[x.number][1] != hashes[e.number][1] for x in beside)

    blocks: list[str] = []
    for top in _articles(root, deleted):
        in_article = top.tag != "#root"
        open_block: list[str] = []

        def close() -> None:
            text = " ".join("".join(open_block).split())
            if text:
                blocks.append(text)
            open_block.clear()

        # Depth first with a stack of its own: pages may nest deeper than calls may.
        waiting: list = [*reversed(top.parts)]
        while waiting:
            part = waiting.pop()
            if part is None:
                close()
            elif isinstance(part, str):
                open_block.append(part)
            elif part.tag == "br":
                open_block.append(" ")
            elif deleted(part) or _is_chrome(part, in_article, root):
                if part.tag not in INLINE and part.tag not in UNSEEN:
                    close()
            elif part.tag in INLINE or part.tag in VOID and part.tag != "hr":
                waiting += reversed(part.parts)
            else:
                close()
                waiting.append(None)
                waiting += reversed(part.parts)
        close()
    return "\n".join(blocks)


# ---------------------------------------------------------------- on tables

def host_of(url: str = "url"):
    """The host of an address in lower case, without user and port; empty for none."""
    return F.lower(F.coalesce(
        F.regexp_extract(F.col(url), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")
    ))


def site_templates(
    pages: DataFrame,
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    slot_share: float = SLOT_SHARE,
    slot_pages: float = SLOT_PAGES,
    slot_times: float = SLOT_TIMES,
) -> DataFrame:
    """``host, templates``: hashes of subtrees and of places to delete on its pages.

    A subtree is one if it stands in the same place on at least ``least_pages`` pages, ``least_share`` of
    the host's. A place is one if at least ``least_pages`` subtrees in it, ``slot_share`` of
    all, stand there on another page too, ``slot_pages`` of the pages have it, and they have
    ``slot_times`` subtrees in it on average, at most.

    Pages of the host whose texts by tags and names are equal are copies and count as one, in
    all numbers. Pages are counted exactly. As each page has few elements, the shares bound
    what a host can have in ``templates``, however many its pages: not more than the elements
    of twenty pages.
    """
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in slices(batches, "html"):
            contents, found = [], []
            for html in texts_of(batch.column("html")):
                tree = parse(html)
                contents.append(_signed(xxh64_intdigest(main_text(tree).encode("utf-8", "surrogatepass"))))
                blocks = {e.number for e in _below(tree) if e.tag not in PROSE}
                placed = {
                    (_signed(place), _signed(own)) for number, (own, place) in subtree_hashes(tree).items() if number in blocks
                }
                # The null stands for the page itself.
                seen: set[int] = set()
                rows = []
                for place, subtree in sorted(placed):
                    rows.append({"place": place, "subtree": subtree, "page": int(place not in seen)})
                    seen.add(place)
                found.append([*rows, {"place": None, "subtree": None, "page": 1}])
            kind = pa.list_(pa.struct([("place", pa.int64()), ("subtree", pa.int64()), ("page", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(contents, pa.int64()), pa.array(found, kind)], ["host", "content", "found"]
            )

    distinct = (
        pages.select(host_of().alias("host"), "html")
        .mapInArrow(hashed, "host string, content bigint, found array<struct<place: bigint, subtree: bigint, page: int>>")
        .groupBy("host", "content").agg(F.min("found").alias("found"))
    )
    counts = stage(
        distinct.select("host", F.inline("found")).groupBy("host", "place", "subtree").agg(
            F.count("*").alias("n"), F.sum("page").alias("on_pages")
        ),
        "subtree-counts",
    )
    hosts = counts.where("place is null").select("host", F.col("n").alias("pages"))
    counts = counts.where("place is not null")
    subtrees = counts.where(F.col("n") >= least_pages).join(hosts, "host").where(F.col("n") >= F.col("pages") * least_share)
    again = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    places = counts.groupBy("host", "place").agg(
        F.sum("n").alias("all"), again.alias("again"), F.sum("on_pages").alias("on_pages")
    ).where(
        (F.col("again") >= least_pages) & (F.col("again") >= F.col("all") * slot_share)
        & (F.col("all") <= F.col("on_pages") * slot_times)
    ).join(hosts, "host").where(F.col("on_pages") >= F.col("pages") * slot_pages)
    return (
        subtrees.select("host", F.col("subtree").alias("hash")).unionByName(places.select("host", F.col("place").alias("hash")))
        .groupBy("host").agg(F.collect_set("hash").alias("templates"))
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages(page_id, url, html)``: ``page_id, url, text, n_chars``.

    Null and empty html give an empty text. Pages without a host in their url share the empty
    host. Repeated rows give repeated results and count as one page. No rows: none. Other
    columns are not read. Templates join the pages by their host; the hosts' side is
    broadcast if small by its written size, and else shuffled, a hot host's pages split.
    """
    templates = stage(site_templates(pages), "site-templates")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [
                main_text(parse(html), {h & (1 << 64) - 1 for h in known or ()})
                for html, known in zip(texts_of(batch.column("html")), batch.column("templates").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    sited = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host_of().alias("host"))
    return sited.join(templates, "host", "left").select("page_id", "url", "html", "templates").mapInArrow(
        extract, "page_id bigint, url string, text string, n_chars bigint"
    )
