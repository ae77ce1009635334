"""Main-text extraction by composite text density (CETD).

For every DOM node of a page the composite density is its characters per tag, adjusted by the
share of link characters and link tags. A node's density sum is the sum of its children's
densities; the block with the largest sum is the core of the article on every page, whatever its
tag (of equal sums, that of an ``article`` or ``main`` wins). The smallest density met on the way
from the body down to that block, with all of the page's text counted, or that of the core's
thinnest block if smaller, is the threshold at which blocks beside the way are kept too.
Boilerplate elements (navigation, page headers and footers, asides, forms, adverts, notices,
reader comments ...) only count towards that threshold: they cannot be the core and never
contribute text.

A page is parsed in one linear pass; pages are independent, so the operator is a map over the
partitions of the table: no shuffle, no collected state, and a few MB of pages at a time.

Defined results: null or empty html gives an empty text of 0 characters; a page without any
article text gives an empty text; broken markup is closed as browsers do; extra columns are kept
out of the result unless named in ``keep``.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.util import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)", re.S)
#: An attribute's name and, unless it is bare, its value.
_ATTR = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math textarea title select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var br wbr img".split())
#: Elements whose start closes an open paragraph.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: An open element of the key ends where one of the listed elements starts, up to the given container.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table html body div article section td th".split())
#: Elements that never hold article text.
NOISE_TAGS = frozenset("nav aside footer form button dialog menu object canvas audio video head".split())
#: Words in class, id or role that mark boilerplate containers.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs comment comments "
    "commentlist complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay "
    "pager pagination paywall popup promo promoted promotion rail recommended recommendations related replies respond "
    "responses search share sharing sidebar sidebars signin signup skip social sponsor sponsored subscribe taboola toast "
    "toolbar topbar trending widget widgets".split())
#: Words that may stand beside one of those in a compound name (``site-footer``, ``sidebar-left``, ``related-posts``).
#: With any other word beside it the name says something else: ``no-sidebar``, ``comments-open``, ``search-algorithms``.
LAYOUT_WORDS = frozenset(
    "a and area articles aside bar blog body bottom bottomright box btn button buttons center col column container content "
    "desktop fixed form global group heading holder icon icons inline inner input item items left link links list main "
    "mobile module outer page panel post posts primary right row secondary section site slot small sticky stories story "
    "tag tags text the tile title toggle top unit wrap wrapper zone".split())
NEVER_NOISE = frozenset("html body main article".split())
_WORD = re.compile(r"[a-z]+")
#: Of the blocks beside the core, headings are kept whatever their density.
HEADINGS = frozenset("h1 h2 h3".split())
#: Elements that are a menu when most of their text is links, and those a lone cell or item belongs to.
MENU_TAGS = frozenset("ul ol dl div section table tbody tr td".split())
LISTS = frozenset("ul ol dl table tbody thead tfoot tr".split())


def _names_noise(token: str, in_article: bool) -> bool:
    """Whether one class name, id or role as a whole names boilerplate: a noise word, alone or with layout words."""
    words = _WORD.findall(token)
    return any(w in NOISE_WORDS and not (w == "header" and in_article) for w in words) and all(
        w in NOISE_WORDS or w in LAYOUT_WORDS for w in words)


def _is_noise(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in NOISE_TAGS:
        return True
    if tag == "header":
        return not in_article
    if not attrs or tag in NEVER_NOISE:
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            if any(_names_noise(token, in_article) for token in value.lower().split()):
                return True
        elif name == "aria-hidden" and value == "true":
            return True
        elif name == "hidden" and value.lower() != "until-found":
            return True
        elif name == "style" and _UNSEEN.search(value):
            return True
    return False


class _Page:
    """Nodes of one page in document order, with the text pieces and block breaks between them."""

    def __init__(self, source: str):
        self.parent, self.tag, self.noise = [-1], ["#root"], [False]
        self.chars, self.link_chars = [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # (node, block number, text)
        self._parse(source)

    def _text(self, raw: str, node: int, block: int, in_link: bool) -> None:
        if not raw or raw.isspace():
            if raw and self.pieces:
                self.pieces.append((node, block, " "))
            return
        text = _html.unescape(raw) if "&" in raw else raw
        self.pieces.append((node, block, text))
        n = len(" ".join(text.split()))
        self.chars[node] += n
        if in_link:
            self.link_chars[node] += n

    def _parse(self, source: str) -> None:
        stack, block, links, articles = [0], 0, 0, 0
        opened: dict[str, int] = {}
        at, end = 0, len(source)

        def pop_to(depth: int) -> None:
            nonlocal links, articles
            for node in stack[depth:]:
                links -= self.tag[node] == "a"
                articles -= self.tag[node] in ("article", "main")
                opened[self.tag[node]] -= 1
            del stack[depth:]

        while at < end:
            start = source.find("<", at)
            if start < 0:
                start = end
            m = _TOKEN.match(source, start) if start < end else None
            if start < end and m is None:  # a bare "<" is text
                nxt = source.find("<", start + 1)
                nxt = end if nxt < 0 else nxt
                self._text(source[at:nxt], stack[-1], block, links > 0)
                at = nxt
                continue
            if start > at:
                self._text(source[at:start], stack[-1], block, links > 0)
            if m is None:
                break
            at = m.end()
            if m["tag"] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"), stack[-1], block, links > 0)
                continue
            tag = m["tag"].lower()
            if m["end"]:
                if tag not in INLINE:
                    block += 1
                for depth in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                    if self.tag[stack[depth]] == tag:
                        pop_to(depth)
                        break
                    if tag in INLINE and self.tag[stack[depth]] not in INLINE:
                        break
                continue
            if tag not in INLINE:
                block += 1
            if tag in CLOSES_P and opened.get("p"):
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == "p":
                        pop_to(depth)
                        break
                    if self.tag[stack[depth]] not in INLINE:
                        break
            if tag in SIBLINGS:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] in SIBLINGS[tag]:
                        pop_to(depth)
                        if tag != "tr":
                            break
                    elif self.tag[stack[depth]] in SCOPES:
                        break
            node, attrs = len(self.tag), m["attrs"] or ""
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.noise.append(self.noise[stack[-1]] or tag in RAW or _is_noise(tag, attrs, articles > 0))
            self.chars.append(0)
            self.link_chars.append(0)
            if tag in RAW:
                if not attrs.rstrip().endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
                    at = close.end() if close else end
            elif tag not in VOID and not (attrs.rstrip().endswith("/") and tag not in CLOSES_P):
                stack.append(node)
                opened[tag] = opened.get(tag, 0) + 1
                links += tag == "a"
                articles += tag in ("article", "main")
            elif tag == "br":
                self.pieces.append((stack[-1], block, " "))


def densities(page: _Page, whole: bool = False) -> tuple[list[float], list[float], list[bool]]:
    """Composite density and density sum of every node, and which nodes are link lists.

    Boilerplate has no density and adds nothing to other nodes', unless the ``whole`` page is counted.
    """
    n = len(page.tag)
    left_out = [False] * n if whole else page.noise
    chars, link_chars = list(page.chars), list(page.link_chars)
    tags, link_tags = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if left_out[i]:
            continue
        p = page.parent[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (page.tag[i] == "a")
    body_links = link_chars[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        c = chars[i]
        if left_out[i] or not c:
            continue
        t, lc, lt = max(tags[i], 1), max(link_chars[i], 1), max(link_tags[i], 1)
        base = math.log(c / max(c - link_chars[i], 1) * link_chars[i] + body_links * c + math.e)
        density[i] = c / t * math.log(max(c / lc * t / lt, 1.0) + 1.0) / math.log(base + 1.0)
        if i and page.tag[i] not in INLINE:
            total[page.parent[i]] += density[i]
    menus = [page.tag[i] in MENU_TAGS and link_tags[i] >= 3 and link_chars[i] > 0.6 * chars[i] for i in range(n)]
    return density, total, menus


def extract(source: str | None) -> str:
    """Article text of one page: blocks in page order, one line each."""
    if not source:
        return ""
    page = _Page(source)
    n = len(page.tag)
    density, total, menus = densities(page)
    blocks = [i for i in range(n) if density[i] > 0 and page.tag[i] not in INLINE]
    if not blocks:
        return ""
    # a childless block stands for itself
    best = max(blocks, key=lambda i: (max(total[i], density[i] if not total[i] else 0.0),
                                      page.tag[i] in ("article", "main"), -i))
    # a lone paragraph, item or cell stands beside others of its kind: take their container
    core = best
    if not total[best] and page.tag[best] not in ("div", "section", "body", "article", "main"):
        core = max(page.parent[best], 0) or best
    while page.tag[core] in LISTS and page.parent[core] > 0:
        core = page.parent[core]
    path = []
    node = core
    while node > 0:
        path.append(node)
        node = page.parent[node]
    on_path = {0, *path}
    diluted = densities(page, whole=True)[0]
    threshold = min([min(density[i], diluted[i]) for i in path if page.tag[i] != "html"] + [
        density[i] for i in range(1, n) if page.parent[i] == core and density[i] > 0
        and page.tag[i] not in INLINE and page.tag[i] not in HEADINGS and not menus[i]], default=0.0)
    chosen = {core} | {i for i in range(1, n) if page.parent[i] in on_path and i not in on_path and not page.noise[i]
                       and (page.tag[i] in HEADINGS or page.tag[i] not in INLINE and density[i] >= threshold > 0)}
    kept = [False] * n
    for i in range(n):
        kept[i] = not page.noise[i] and not menus[i] and (i in chosen or (i > 0 and kept[page.parent[i]]))
    out, current, parts = [], None, []
    for node, block, text in page.pieces:
        if not kept[node]:
            continue
        if block != current:
            out.append(" ".join("".join(parts).split()))
            current, parts = block, []
        parts.append(text)
    out.append(" ".join("".join(parts).split()))
    return "\n".join(b for b in out if b)


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (code points) of every row of ``pages``."""
    fields = {f.name: f for f in pages.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [extract(s) for s in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string()),
                                                                     pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    source = pages.select(*[F.col(c) for c in keep], F.col(html).alias("__html"))
    return source.mapInArrow(run, schema)
