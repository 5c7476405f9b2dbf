"""Main text of web pages by paths that the pages of a host agree on.

First pass: every page is cut into blocks, each container is scored by the plain text it holds
below it (links count against it, nearer text counts more), and the page votes for the
generalised path of its best containers: tags with their classes, digits as 0. A container stands
for the outermost one around it that adds mostly plain text, so a title or lead outside the
body's own container stays. Spark sums the votes by host and path. Second pass: every page is cut again below the best path of its host
that it has; a page with none of them uses its own best container.

Left out from a chosen container, by what they are: script, style, textarea, the page's title element,
noscript, iframe, template, svg, select, xmp and MathML annotations; nav, header (but not
headings in it below an article or main), footer, aside, form, menu, dialog and button; hidden
elements; and containers, lists, tables and figures with a word of ``UNWANTED`` in their class or
role, or in their id unless they are sections.

Votes are reduced on the map side, so a host with a third of all pages is a few rows for each task. Winners
are one short row for each host and rank; whether they are broadcast is decided by their size.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import fresh_name, text_or_empty

# Elements of HTML by their part in this extraction.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg select xmp annotation annotation-xml".split())
CONTAINERS = set("html body main article section div td form aside header footer nav center fieldset details dialog".split())
BLOCKS = CONTAINERS | set(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure figcaption hr address summary menu".split()
)
NEVER = set("nav header footer aside form menu dialog button".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: A start tag that closes an open element of the same set before it.
CLOSES = [({"p"}, BLOCKS), ({"li"}, {"li"}), ({"dt", "dd"}, {"dt", "dd"}), ({"tr", "td", "th"}, {"tr"}), ({"td", "th"}, {"td", "th"})]
#: Elements that words can exclude; headings, paragraphs and other text never are.
WORDED = CONTAINERS | set("ul ol dl table figure".split())
#: Words in class, id or role of what is not the article.
UNWANTED = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription sidebar sidebars aside nav navbar navigation "
    "menu menus breadcrumb breadcrumbs header masthead footer contentinfo complementary comment comments commentlist disqus "
    "reply replies respond discussion share sharing social related recommended recommendation widget widgets form login signup "
    "search pagination pager toolbar hidden".split()
)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
PATHS_FOR_EACH_HOST, PATHS_FOR_EACH_PAGE, NEARER = 3, 2, 0.6


class Element:
    __slots__ = ("tag", "path", "parent", "unwanted", "score", "container", "size", "linked", "own")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent, self.score = tag, parent, 0.0
        self.size = self.linked = self.own = 0
        found = {}
        if attributes and not attributes.isspace():
            for m in _ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        names = f"{found.get('class', '')} {found.get('id', '')}".strip() if found else ""
        self.container = tag in CONTAINERS
        step = tag + "".join(sorted({"." + re.sub(r"\d+", "0", n.lower()) for n in names.split()})) if names else tag
        above = parent.path if parent else ""
        self.path = f"{above}>{step}" if self.container else above
        words = ()
        if found and tag in WORDED:
            classes = found.get("class", "")
            # The id of a section is its title, not its part of the page.
            section = tag in ("section", "article") or "section" in classes.lower().split()
            words = set(_WORDS.findall(f"{classes if section else names} {found.get('role', '')}".lower()))
        hidden = found and (
            "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        )
        whole = tag in ("html", "body", "main", "article")
        self.unwanted = bool(hidden or (tag in NEVER) or (not whole and words and UNWANTED & set(words)))
        if whole and words and {"comment", "comments", "reply"} & set(words) and tag == "article":
            self.unwanted = True


class Block:
    __slots__ = ("owner", "text", "linked", "heading")

    def __init__(self, owner: Element | None, text: str, linked: int, heading: bool):
        self.owner, self.text, self.linked, self.heading = owner, text, linked, heading


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order, with the element each stands in."""
    out: list[Block] = []
    stack: list[Element] = []
    parts: list[str] = []
    linked = links = at = 0
    raw_until = -1

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                heading = any(e.tag in HEADINGS for e in stack)
                out.append(Block(stack[-1] if stack else None, text, min(linked, len(text)), heading))
            parts.clear()
        linked = 0

    for m in _TAG.finditer(page):
        if m.start() < raw_until:
            continue
        if m.start() > at:
            parts.append(page[at : m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
            elif tag == "a":
                links = max(0, links - 1)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(page, at)
            at = raw_until = end.end()
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 1
        if tag not in BLOCKS:
            continue
        flush()
        for closed, by in CLOSES:
            if tag in by:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in closed:
                        del stack[i:]
                        break
                    if stack[i].container or stack[i].tag in ("ul", "ol", "dl", "table"):
                        break
        links = 0
        if tag not in VOID:
            stack.append(Element(tag, m[3].rstrip("/"), stack[-1] if stack else None))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def _below(block: Block, top: Element | None) -> bool:
    """Whether the block stands in ``top`` with nothing unwanted between. Headings in a header
    of the article itself stay."""
    e, seen = block.owner, False
    while e is not None:
        if e is top:
            return True
        if e.unwanted and not (block.heading and e.tag == "header" and top is not None and top.tag in ("article", "main")):
            seen = True
            break
        e = e.parent
    return top is None and not seen


def whole_of(e: Element) -> Element:
    """The outermost container around ``e`` that adds mostly plain text to it.

    An article grows only to the article or main around it, and the whole page is taken only if no
    container beside ``e`` holds text.
    """
    best, p = e, e.parent
    while p is not None:
        more = p.size - best.size
        if p.container and more > 0 and 2 * (p.linked - best.linked) <= more:
            page = p.tag in ("html", "body")
            if p.tag in ("article", "main") or best.tag not in ("article", "main") and not (page and more > p.own):
                best = p
        p = p.parent
    return best


def ranked_containers(blocks: list[Block]) -> list[Element]:
    """Containers with the text they hold, best first."""
    held: dict[int, Element] = {}
    for b in blocks:
        good = max(0, len(b.text) - 3 * b.linked)
        share = 1.0
        e, within, nearest = b.owner, False, True
        while e is not None:
            if e.unwanted:
                if not (b.heading and e.tag == "header"):
                    break
                within = True
            elif e.container and (not within or e.tag in ("article", "main")):
                e.size += len(b.text)
                e.linked += b.linked
                e.own += len(b.text) * nearest
                nearest = False
            if e.container:
                e.score += good * share * (1.5 if e.tag in ("article", "main") else 1.0)
                held[id(e)] = e
                share *= NEARER
            e = e.parent
    return sorted(held.values(), key=lambda e: (-e.score, e.path))


def main_text(page: str, paths: list[str]) -> str:
    """Blocks below the elements of the first of ``paths`` that hold text, else below the page's
    own best container, else all wanted blocks."""
    blocks = blocks_of(page)
    found = ranked_containers(blocks)
    for path in paths:
        tops = [e for e in found if e.path == path and e.score > 0]
        if tops:
            break
    else:
        tops = [whole_of(e) for e in found[:1]]
    chosen = {id(e): e for e in tops}
    out = []
    for b in blocks:
        e, top = b.owner, None
        while e is not None:  # the outermost match, so nested matches are not cut out
            if id(e) in chosen:
                top = e
            e = e.parent
        if (top is not None or not tops) and _below(b, top):
            out.append(b.text)
    return "\n\n".join(out)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0, 0.0])
        for page, host in zip(batch.column("page").to_pylist(), batch.column("host").to_pylist(), strict=True):
            best = ranked_containers(blocks_of(page))[:PATHS_FOR_EACH_PAGE]
            total = sum(e.score for e in best)
            for e in best:
                if e.score > 0:
                    v = held[host, whole_of(e).path]
                    v[0] += int(1_000_000 * e.score / total)
        keys = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([held[k][0] for k in keys], pa.int64())],
            ["host", "path", "votes"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, paths)``: the paths with the most votes of each host, best first.

    Votes are whole numbers, so their sum does not depend on the order. The number of paths
    kept for a host is a fallback order, not a limit on pages or text.
    """
    votes = pages.select("page", "host").mapInArrow(_votes, "host string, path string, votes long")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = Window.partitionBy("host").orderBy(F.col("votes").desc(), "path")
    ranked = summed.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= PATHS_FOR_EACH_HOST)
    return ranked.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))


def _extracted(page: str, paths: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [
                main_text(h, p or [])
                for h, p in zip(batch.column(page).to_pylist(), batch.column(paths).to_pylist(), strict=True)
            ]
            keep = [i for i, n in enumerate(batch.schema.names) if n not in (page, paths)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(got, pa.string())], [*(batch.schema.names[i] for i in keep), text]
            )

    return run


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without its html and with the main text, by host agreement.

    White space inside a block becomes one space; blocks are joined by an empty line. A null or
    empty html gives an empty text, also html without text. A null or unreadable url counts as
    a host of its own name, the empty one. An empty table gives an empty result. Other columns
    pass through; one named like the result is replaced.
    """
    pages = pages.drop(*[c for c in pages.columns if c.lower() == text_col.lower() and c != html_col])
    page, host, paths = fresh_name(pages, "page_", "host_", "paths_")
    found = F.lower(F.regexp_extract(text_or_empty(F.col(url_col)), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    ready = pages.withColumn(page, text_or_empty(F.col(html_col))).withColumn(host, found).drop(html_col)
    winners = host_paths(ready.select(F.col(page).alias("page"), F.col(host).alias("host")))
    joined = ready.join(winners.select(F.col("host").alias(host), F.col("paths").alias(paths)), host, "left").drop(host)
    schema = joined.drop(page, paths).withColumn(text_col, F.lit("")).schema
    return joined.mapInArrow(_extracted(page, paths, text_col), schema)
