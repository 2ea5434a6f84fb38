"""HTML extraction by consensus host paths.

Pass 1 scores the containers of each page: text in paragraphs and headings,
less what is inside links, is credited to the container that holds the blocks.  From the
best one the choice climbs to the containers around it while these add only text that is not
mostly links, so headlines and introductions beside the body belong to it.  The chosen
container's generalised path (tag and class names from the root, digits turned
into N) is a vote of the page, weighted by its share of the page's text.  Spark
adds up the votes per host and path; the host's path is the one with the most
votes (ties to the longer, then the smaller path).

Pass 2 extracts every page again: the text of all containers on the host's
path, in page order; a page without that path uses its own best container.

Left out, wherever they are: nav, header, footer, aside, form, script, style,
noscript, template, svg, iframe, buttons and comments, what browsers show only in place of canvas,
object, audio and video, annotations of formulas, elements whose role, class or
id names menus, notices, adverts or reader comments, and hidden elements.  Class names
that tell of a layout (``no-sidebar``, ``has-sidebar``, ``layout-with-sidebar``) name nothing.
Character references are decoded; white space inside a block becomes one space,
blocks are trimmed and joined by a line feed; empty blocks do not count.  ``br``
is white space.

Result per row: ``page_id, url, text, n_chars, path, voted`` (the path used, and
whether it is the host's).  Null and empty html gives an empty text.  Pages
without a url, or whose url has no host, vote together as the host ''.  Rows
that share a page_id give a row each.  Malformed pages: unclosed elements end
with their parents, stray end tags are skipped, unclosed script or comment runs to the
end.  Extra columns are ignored."""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, small, table

#: Element names of the HTML standard by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROP = frozenset("nav header footer aside form script style noscript template svg iframe object canvas audio video button select "
                 "option textarea dialog menu head title noembed noframes xmp input label fieldset".split())
BLOCK = frozenset("address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre "
                  "section summary table tbody td tfoot th thead tr ul caption hgroup search".split()) | DROP
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
CONTAINERS = frozenset("article main section div body td".split())
#: Names that mark what is not main text, as whole words of a class, id or role.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|side|aside|footer|foot|header|masthead|banner|ads?|adverts?|"
    r"advertisement|sponsor(?:ed)?|promo|cookies?|consent|gdpr|notice|notices|popup|modal|newsletter|subscribe|social|share|sharing|related|"
    r"recommended|comments?|commentlist|respond|replies|disqus|widget|pagination|pager|toolbar|login|signup|search|contentinfo|"
    r"complementary|skip)(?:$|[\s_-]|\d)", re.I)
#: Parts of a class name that make it tell of a layout or a state.
LAYOUT = re.compile(r"(?:^|[_-])(?:(?:no|not|non|has|have|with|without|hide)(?=[_-])|layout(?:$|[_-]))", re.I)
#: The header of an article, not of a page.
OWN_HEADER = re.compile(r"(?:article|post|entry|story|content)[_-]header$", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Inline elements without text of the page.
UNSHOWN = frozenset(("annotation", "annotation-xml"))

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("tag", "path", "dropped", "heads", "score")

    def __init__(self, tag: str, path: str, dropped: bool, heads: bool = False):
        self.tag, self.path, self.dropped, self.heads, self.score = tag, path, dropped, heads, 0


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTR.finditer(raw):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _hidden(a: dict[str, str]) -> bool:
    return "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")


def _boilerplate_names(a: dict[str, str]) -> list[str]:
    return [x for k in ("class", "id", "role") if k in a for x in a[k].split() if BOILERPLATE.search(x) and not LAYOUT.search(x)]


def blocks(page: str) -> tuple[list[tuple[tuple[Node, ...], str, int]], list[Node]]:
    """``(ancestors, text, characters inside links)`` of each block with text, and all containers."""
    root = Node("", "", False)
    stack, containers, out = [root], [root], []
    buf: list[str] = []
    links, link_depth, at, n = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal links
        if buf:
            text = SPACE.sub(" ", "".join(buf)).strip()
            if text:
                out.append((tuple(stack), text, links))
            buf.clear()
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        if raw and not stack[-1].dropped:
            t = entities.unescape(raw) if "&" in raw else raw
            buf.append(t)
            if link_depth:
                links += len(t)

    def close(tag: str, stop: frozenset) -> None:
        nonlocal link_depth
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                if any(x.tag in BLOCK for x in stack[i:]):
                    flush()
                link_depth -= sum(x.tag == "a" for x in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    none: frozenset = frozenset()
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        end, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag in BLOCK:
                if tag == "p" and not any(x.tag == "p" for x in stack):
                    flush()  # a stray </p> is an empty paragraph
                    continue
                close(tag, none)
            elif tag != "br":
                close(tag, BLOCK)
            else:
                add(" ")
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSES_P:
            close("p", CONTAINERS)
        if tag == "li":
            close("li", frozenset(("ul", "ol", "menu")))
        elif tag in ("dd", "dt"):
            close("dd", frozenset(("dl",)))
            close("dt", frozenset(("dl",)))
        elif tag in ("td", "th"):
            close("td", frozenset(("tr", "table")))
            close("th", frozenset(("tr", "table")))
        elif tag == "tr":
            close("tr", frozenset(("table",)))
        if tag in VOID:
            continue
        up = stack[-1]
        a = _attributes(raw) if raw.strip(" /\n\t\r") else {}
        names = _boilerplate_names(a) if a and tag not in ("html", "body", "article", "main") else []
        own = tag in UNSHOWN or bool(a) and tag not in ("html", "body", "article", "main") and _hidden(a)
        own_head = tag == "header" and any(x.tag in ("article", "main") for x in stack) or tag not in DROP and any(map(OWN_HEADER.match, names))
        # an article's own header is dropped but for its headings
        heads = not own and (up.heads or not up.dropped) and (own_head and all(map(OWN_HEADER.match, names)) or up.heads and tag not in DROP and not names)
        dropped = up.dropped or tag in DROP or own or bool(names)
        if tag in HEADINGS and heads and up.heads:
            dropped = heads = False
        if tag in RAW:
            e = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(page, at)
            at = e.start() if e else n
            if e:
                gt = page.find(">", at)
                at = gt + 1 if gt >= 0 else n
            continue
        if tag not in BLOCK and raw.rstrip().endswith("/") and tag in ("path", "use"):
            continue
        cls = a.get("class", "")
        path = up.path
        if tag in BLOCK and tag != "p":
            name = tag + "".join("." + c for c in sorted(DIGITS.sub("N", cls).split()))
            path = f"{up.path}/{name}"
        node = Node(tag, path, dropped, heads)
        stack.append(node)
        if tag in CONTAINERS and not dropped:
            containers.append(node)
        link_depth += tag == "a"
    flush()
    return out, containers


def _climbed(best: Node, found: list[tuple[tuple[Node, ...], str, int]]) -> Node:
    """The outermost container around ``best`` that adds text and no block that is mostly links; an article or main may hold
    some, as long as less than half of what it adds is inside links.  Around an article or main only such ones count."""
    around = next(ns[:ns.index(best)] for ns, _, _ in found if best in ns)
    closed, inside = False, best.tag in ("article", "main")
    for x in reversed(around):
        if x.tag not in CONTAINERS or inside and x.tag not in ("article", "main"):
            continue
        more = [(len(t), links) for ns, t, links in found if x in ns and best not in ns]
        closed = closed or any(2 * links >= n for n, links in more)
        named = x.tag in ("article", "main")
        inside = inside or named
        if closed and not (named and 2 * sum(links for _, links in more) < sum(n for n, _ in more)):
            continue
        if sum(n for n, _ in more) > 0:
            best = x
    return best


def best_container(found: list[tuple[tuple[Node, ...], str, int]], containers: list[Node]) -> tuple[Node | None, float]:
    """The container with the most credit and its share of the page's credit."""
    total = 0
    for nodes, text, links in found:
        credit = max(0, len(text) - 2 * links)
        total += credit
        # a block counts for the container that holds it, half for the next one up
        weight = 2
        for x in reversed(nodes):
            if x.tag in CONTAINERS:
                x.score += credit * weight * (3 if x.tag in ("article", "main") else 2)
                weight //= 2
                if not weight:
                    break
    best = max(containers[1:], key=lambda x: x.score, default=None)
    if best is None or not best.score:
        best = containers[0] if found else None
    else:
        best = _climbed(best, found)
    return best, (1.0 if best is None or not total else min(1.0, sum(len(t) for ns, t, _ in found if best in ns) / max(1, sum(len(t) for _, t, _ in found))))


def vote(page: str) -> tuple[str, float]:
    found, containers = blocks(page)
    best, share = best_container(found, containers)
    return (best.path if best else ""), share


def extract(page: str, path: str | None) -> tuple[str, str, bool]:
    """``(text, path used, whether it is the given one)``."""
    found, containers = blocks(page)
    voted = path is not None and any(c.path == path for c in containers) and any(any(x.path == path for x in ns) for ns, _, _ in found)
    if not voted:
        best, _ = best_container(found, containers)
        if best is None:
            return "", "", False
        path = best.path
    return "\n".join(t for ns, t, _ in found if any(x.path == path for x in ns)), path, voted


def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the consensus path of every host."""
    p = pages.select(host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    def run(b: pa.RecordBatch) -> list[tuple]:
        sums: dict[tuple[str, str], float] = {}
        for h, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            path, share = vote(page)
            if path:
                sums[(h, path)] = sums.get((h, path), 0.0) + share
        return [(h, p, round(v * 1000)) for (h, p), v in sums.items()]

    votes = map_arrow(p, run, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    top = F.max(F.struct("votes", F.length("path").alias("n"), "path"))
    return votes.groupBy("host").agg(top.alias("t")).select("host", F.col("t.path").alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    best = host_paths(pages).checkpoint()
    kind = pages.schema["page_id"].dataType.simpleString()
    p = pages.select("page_id", "url", host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    p = p.join(small(best), "host", "left").select("page_id", "url", "html", "path")

    def run(b: pa.RecordBatch) -> list:
        got = [extract(h, x) for h, x in zip(b.column("html").to_pylist(), b.column("path").to_pylist())]
        return [b.column("page_id"), b.column("url"), [g[0] for g in got], [len(g[0]) for g in got], [g[1] for g in got], [g[2] for g in got]]

    return map_arrow(p, run, f"page_id {kind}, url string, text string, n_chars long, path string, voted boolean")


def op5(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
