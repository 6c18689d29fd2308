"""Main text by consensus host paths (operator 7).

First pass: each page's containers are scored by the text they hold outside of
links. The page votes for the article that the best one is in; without one, for
the lowest container that also holds the headings and text next to the best
one. A vote is a path: the tags from the root with their class names, digits
made alike. Spark counts the votes of each
host. Second pass: every page is read again and the containers at its host's
winning path are its main text; a page without such a container keeps its own
best one. So a page whose menu or comments outweigh its article follows the
other pages of its host. Noisy names (sidebar, widget), forms and roles drop an
element, but not one around the page's article, nor those that hold most of the
page's text outside of links; navigation, footers, asides and hidden elements
always go.

Scale: the votes are aggregated map-side to one row per host and path; the
winners (one row per host) are written, and the planner broadcasts them while
they are few. A hot host is many rows of the same aggregate and nothing else.

Defined cases: null or empty html has empty text; null url votes as a host of
its own; repeated rows vote and are extracted each; ties between paths go to
the larger score, then the greater path; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
#: One attribute: its whole name, then its value; what stands in a value is no name.
ATTRIBUTE = re.compile(r"([^\s/>=\"'][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noframes noembed".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var nobr wbr img".split())
#: Elements that close an open paragraph.
BLOCK = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: An opening tag that closes a sibling left open.
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
DROPPED = frozenset("nav header footer aside button select menu svg math object audio video canvas dialog "
                    "fieldset input datalist head".split())
#: Parts of class names and ids that mark what is no article text.
NOISE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav "
                  "navbar navigation breadcrumb breadcrumbs sidebar sidebars footer masthead cookie cookies consent "
                  "notice notices popup modal newsletter subscribe signup share sharing social related recommended "
                  "comment comments disqus replies reply widget toolbar pager pagination paywall".split())
#: Of these, what can outweigh an article without being one, whatever else is in the name.
TALK = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent "
                 "notice notices popup modal newsletter subscribe comment comments disqus replies reply".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
ARTICLE = ("article", "main")
#: Elements that hold text but are no containers.
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAF = INLINE | frozenset("p li h1 h2 h3 h4 h5 h6 pre dd dt blockquote".split())


class Node:
    """``gone``: inside of what is always dropped; ``noise``: the marks of its
    own for which it would be dropped; ``dropped``: what ``settle`` decides."""

    __slots__ = ("article", "dropped", "gone", "link", "main", "noise", "parent", "path", "score", "tag")

    def __init__(self, tag: str, path: str, parent: Node | None, gone: bool, link: bool, article: Node | None, noise: tuple):
        self.tag, self.path, self.parent, self.gone, self.link, self.article = tag, path, parent, gone, link, article
        self.noise, self.main, self.dropped, self.score = noise, False, gone, 0.0

    def up(self) -> Iterator[Node]:
        """The node and what it is in, outwards."""
        node = self
        while node is not None:
            yield node
            node = node.parent


def attributes(tag: str) -> dict[str, str]:
    """The attributes of an opening tag; of a repeated name the first counts."""
    values: dict[str, str] = {}
    for a in ATTRIBUTE.findall(tag):
        values.setdefault(a[0].lower(), a[1] or a[2] or a[3])
    return values


def hidden(values: dict[str, str]) -> bool:
    return ("hidden" in values or values.get("aria-hidden", "").strip().lower() == "true"
            or re.search(r"visibility\s*:\s*hidden", values.get("style", ""), re.I) is not None)


def step_of(tag: str, names: str) -> str:
    """A tag with its class names, sorted, digits made alike."""
    classes = sorted({re.sub(r"[0-9]+", "#", x) for x in names.split()})
    return ".".join([tag, *classes])


def words_of(name: str) -> set[str]:
    return set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()))


def noise_of(names: str, own_id: str, role: str, inside: bool) -> tuple:
    """The class names (``.x``), id (``#x``) and role (``@x``) that mark what
    is no article text; a header by name counts only outside of an article."""
    marks = [f"{kind}{x}" for kind, value in ((".", names), ("#", own_id)) for x in value.split()
             if not NOISE.isdisjoint(parts := words_of(x)) or ("header" in parts and not inside)]
    return (*marks, f"@{role}") if role in ROLES else tuple(marks)


def weak(mark: str) -> bool:
    """Whether a mark may well be that of a wrapper: a form, or a noisy word
    as a part of a longer name (has-sidebar)."""
    parts = words_of(mark[1:]) - {""}
    return mark == "form" or (mark[0] != "@" and not parts <= NOISE and TALK.isdisjoint(parts))


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """The elements of a page in order, and its text in order: (node, piece)
    outside of what is always dropped; piece '' a break, None the end of a
    block."""
    root = Node("#root", "", None, False, False, None, ())
    stack, nodes, at = [root], [root], 0
    told: list[tuple[Node, str | None]] = []

    def close(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                if any(x.tag not in INLINE for x in stack[k:]):
                    told.append((stack[-1], None))
                del stack[k:]
                return

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece and not stack[-1].gone:
            told.append((stack[-1], entities.unescape(piece)))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "p" and not any(x.tag == "p" for x in stack):
                told.append((stack[-1], ""))
            close(tag)
            continue
        if tag == "br" or tag in BLOCK or tag in SIBLING:
            told.append((stack[-1], "" if tag == "br" else None))
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = stop.start() if stop else end
            if stop:
                tail = page.find(">", at)
                at = end if tail < 0 else tail + 1
            continue
        if tag in BLOCK and any(x.tag == "p" for x in stack):
            close("p")
        for sibling in SIBLING.get(tag, ()):
            for x in stack[:0:-1]:
                if x.tag == sibling:
                    close(sibling)
                if x.tag in ("ul", "ol", "dl", "table", "select", sibling):
                    break
        top = stack[-1]
        if m[3].endswith("/") and tag not in BLOCK and tag not in INLINE:
            continue
        values = attributes(m[3]) if m[3] else {}
        names, role = values.get("class", ""), values.get("role", "").strip().lower()
        gone = top.gone or tag in DROPPED or (bool(values) and hidden(values))
        chief = tag in ARTICLE or role == "main"
        noise: tuple = ()
        named = noise_of(names, values.get("id", ""), role, top.article is not None) if values and not gone else ()
        if not chief and not gone and tag not in ("html", "body"):
            noise = (*named, "form") if tag == "form" else named
        node = Node(tag, top.path if tag in INLINE else f"{top.path}>{step_of(tag, names)}", top, gone,
                    top.link or tag == "a", top.article, noise)
        if chief and not gone:
            node.main = tag != "article" or not named
            node.article = node.article or node
        stack.append(node)
        nodes.append(node)
    told.append((stack[-1], None))
    return nodes, told


def settle(nodes: list[Node], told: list, path: str | None = None) -> None:
    """Decides what is dropped: what has a noisy mark. On a page whose article
    would go with it, an element around that article stays, and so do the
    elements with a mark that together hold most of the page's text outside
    of links (if the mark isn't ``weak``: and little of it is elsewhere). The
    marks that the host's ``path`` names don't count on the way to it."""
    for n in nodes:
        n.dropped = n.gone
    if not any(n.noise for n in nodes):
        return
    marks: dict[Node, frozenset] = {}
    for n in nodes:
        around = marks[n.parent] if n.parent else frozenset()
        marks[n] = around.union(n.noise) if n.noise else around
    total = live = 0
    held: dict[str, int] = {}
    articles: dict[Node, int] = {}
    for n, piece in told:
        if piece and not n.link and (size := len(piece.strip())):
            total += size
            live += size * (not marks[n])
            for mark in marks[n]:
                held[mark] = held.get(mark, 0) + size
            if n.article:
                articles[n.article] = articles.get(n.article, 0) + size
    chief = [n for n in nodes if n.main and not n.gone and n.article is n and articles.get(n)]
    cleared: set[str] = set()
    if all(marks[n] for n in chief):  # no article that stays anyway
        cleared = {x for x, size in held.items() if size * 2 > total and (weak(x) or live * 10 < total)}
        chief = [n for n in chief if n.tag != "article" or articles[n] > live]
    else:
        chief = []
    spared = {x for n in chief for x in n.up()}
    for n in nodes[1:]:
        own = [x for x in n.noise if x not in cleared] if n not in spared else []
        if own and path is not None and n.tag not in INLINE and (path == n.path or path.startswith(f"{n.path}>")):
            own = [x for x in own if x[0] in "#@"]
        n.dropped = n.gone or n.parent.dropped or bool(own)


def rate(told: list) -> None:
    """Scores the containers by the blocks of text in them."""
    run = link = 0
    for n, piece in told:
        if piece:
            if not n.dropped:
                size = len(piece.strip())
                run += size
                link += size * n.link
        elif piece is None and run:
            holders = (x for x in n.up() if x.tag not in LEAF)
            weight = max(0, run - 2 * link)
            for share, holder in zip((1.0, 0.5, 0.25), holders, strict=False):
                holder.score += weight * share
            run = link = 0


def whole_of(best: Node, nodes: list[Node], told: list) -> Node:
    """The lowest container that also holds the headings and the text blocks
    next to ``best``, as far as these have no more links than an article.

    Going outwards, a level counts if it adds a heading, or text; text in the
    body or beside navigation or the like counts from a tenth of what is there.
    Blocks of links may come along only if they are less than what is won."""
    plain, linked, head, own = ({n: 0 for n in nodes} for _ in range(4))
    for n, piece in told:
        if piece and not n.dropped:
            size = len(piece.strip())
            (linked if n.link else plain)[n] += size
            own[n] += size * (not n.link)
    place = {n: k for k, n in enumerate(nodes)}
    outer = set(best.up())
    children: dict[Node, list[Node]] = {n: [] for n in outer}
    for n in nodes[:0:-1]:
        if n.tag in HEADING:
            head[n] = plain[n]
        plain[n.parent] += plain[n]
        linked[n.parent] += linked[n]
        head[n.parent] += head[n]
        if n.parent in outer:
            children[n.parent].append(n)
    chosen = last = best
    won = title = links = 0  # since the chosen one: characters of text, of headings, of blocks of links
    bounded = False  # whether a level since then is one of the page's layout
    for level in best.up():
        if level is best:
            continue
        page_wide = level.tag in ("#root", "html", "body")
        bounded = bounded or page_wide or any(n.noise or n.tag in ("nav", "header", "footer", "aside")
                                              for n in children[level] if n.dropped)
        most = max(0.25, 2 * linked[chosen] / max(1, plain[chosen] + linked[chosen]))
        won += own[level]
        for n in children[level]:
            size = plain[n] + linked[n]
            if n is last or n.dropped or not size:
                continue
            before = place[n] < place[last]
            if n.tag in HEADING and (plain[n] or not page_wide) and (before or not page_wide):
                title += size
            elif linked[n] > most * size:
                links += size
            elif before and head[n] * 2 >= size:
                title += size
            else:
                won += plain[n]
        last = level
        enough = title or (won * 10 >= plain[chosen] if bounded else won)
        spare = 0 if page_wide else plain[chosen] / 10
        if enough and links <= won + title + spare and level.tag not in LEAF:
            chosen, won, title, links, bounded = level, 0, 0, 0, False
    return chosen


def best_node(page: tuple) -> Node:
    """A settled page's main container: the article that its best one is in, else what is whole around that."""
    nodes, told = page
    rate(told)
    best = max((n for n in nodes if n.tag not in INLINE and not n.dropped), key=lambda n: n.score)
    return best.article or whole_of(best, nodes, told)


def best_container(page: str) -> tuple[str, float]:
    """The path of a page's main container, and the score of the best one."""
    nodes, told = parse(page)
    settle(nodes, told)
    whole = best_node((nodes, told))
    return whole.path, max(n.score for n in nodes)


def joined_text(pieces: list[str]) -> str:
    return " ".join("".join(pieces).split())


def text_under(page: tuple, path: str) -> str | None:
    """The text of a settled page's containers at ``path``; None if there is none."""
    nodes, told = page
    inside: dict[Node, bool] = {}
    for n in nodes:
        inside[n] = n.path == path or (n.parent is not None and inside[n.parent])
    if not any(inside[n] and not n.dropped for n in nodes):
        return None
    return joined_text([piece or " " for n, piece in told if inside[n] and not (piece and n.dropped)])


def main_text(page: str | None, path: str | None) -> str:
    """The text at the host's path, else at the page's own best container."""
    if not page:
        return ""
    parsed = parse(page)
    text = None
    if path is not None:
        settle(*parsed, path)
        text = text_under(parsed, path)
    if not text:
        settle(*parsed)
        text = text_under(parsed, best_node(parsed).path)
    return text or ""


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, n, score): the pages of a host that vote for a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [best_container(x) if x else (None, 0.0) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found])],
                names=["host", "path", "score"])

    rows = pages.select(host_of(F.col("url")).alias("host"), "html")
    return (rows.mapInArrow(run, "host string, path string, score double").where("score > 0")
            .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score")))


def winners(counted: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host."""
    return counted.groupBy("host").agg(F.max(F.struct("n", "score", "path")).alias("w")).select("host", "w.path")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and path (of the host) for every page."""
    won = stored(winners(votes(pages)), "paths").select(F.col("host").alias("h"), "path")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), "html", host_of(F.col("url")).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, p) for x, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                                                     strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64()), batch.column(3)],
                names=["page_id", "url", "text", "n_chars", "path"])

    joined = rows.join(won, F.col("host") == F.col("h"), "left").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", "path")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long, path string")
