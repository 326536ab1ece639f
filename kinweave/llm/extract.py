"""Main text of web pages by minimum cut.

A page is read into text blocks: runs of text between block-level tags. A classifier gives every
block odds of being content, from what its ancestors say of themselves (tag, class, id, role), its
length and its share of link text. A listed word in a class or id moves the odds by NAMED at most, and
the less the less of the page's prose lies outside of it: layout names of wrappers tell no part of a
page from another. Neighbouring blocks of the same container and the same leaning
form one node. The costs of calling a node boilerplate or content are its capacities from the source
and to the sink; edges between neighbours, and between nodes of the same container, cost what it
takes to label them apart, more the more of their ancestors they share. The minimum cut labels
the page: what stays with the source is content.

An article or main inside what speaks against a place by its tag, role or ``hidden`` weighs against that as against a
listed name; only below navigation, footers and controls it does not.

Defined cases: null or empty html gives empty text, and so does a page without content. Tags may be
unclosed or unopened; a ``<`` whose tag never ends is text; a comment, script or style that does not end takes the rest of
the page. Whole pages are read, in time linear in their length however broken they are. Repeated rows are pages like others; columns other than page_id, url and html are not read.
"""

import html as entities
import math
import re
from bisect import bisect_left
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from kinweave.llm.tables import as_texts, map_texts

# Names of HTML elements by their role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template svg math iframe object textarea canvas audio video xmp".split())
CLOSED_BY_BLOCK = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split())
HEAD_TAGS = RAW_TAGS | frozenset("title meta link base".split())
# An opening tag of the key ends an open element of the same list that no container lies above.
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("ul ol dl table select menu body article div section".split())
BOILERPLATE_TAGS = frozenset(
    "nav footer aside form menu dialog head title button select option fieldset legend search label".split())
CONTENT_TAGS = frozenset(("article", "main"))
# Of what speaks against a place, the tags that never hold an article.
CERTAIN_TAGS = frozenset("nav footer menu head title button select option legend search label".split())
LEVEL_TAGS = frozenset("li dt dd tr td th option".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promos "
    "promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations widget widgets comment "
    "comments respond reply replies discussion disqus pagination pager form search disclaimer copyright announcement "
    "paywall skip".split())
# Beginnings that mark a name of several words in one, as in cookiebar or commentlist.
BOILERPLATE_STEMS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "popup", "promo", "sidebar", "sidenav", "sponsor",
                     "subscri", "topnav")
CONTENT_NAMES = frozenset("article content main post entry story text maintext".split())
NOT_NAMES = frozenset("with has no without".split())

# How a comment, a declaration and a tag begin; what stands between a tag's name and its end; one attribute.
BEGIN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/><]*))")
REST = re.compile(r"""(?:"[^"]*"|'[^']*'|[^'">])*+>""")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

END_TAGS = {tag: re.compile(f"</{tag}[^>]*>", re.I) for tag in RAW_TAGS}

CONTENT, OPEN, BOILERPLATE = 1, 0, -1
CERTAIN, OUTSIDE = 6.0, 3.0
NAMED, INNER = 4.0, 5.0  # against what a listed name is above; for an article or main below such a name
PROSE_OUTSIDE = 0.25  # the share of the page's prose outside of a name that gives it its full weight
NEIGHBOURS, SAME_CONTAINER = 0.5, 1.0


class Element:
    __slots__ = ("tag", "leaning", "in_article", "depth", "up", "named", "certain", "soft", "block", "scope")

    def __init__(self, tag: str, up: "Element | None", own: int, named: bool = False):
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up else 0
        self.in_article = tag in CONTENT_TAGS or bool(up and up.in_article)
        self.named: Element | None = self if named else up.named if up else None  # the nearest with a listed name
        self.block: Element = self if tag in BLOCK_TAGS or not up else up.block  # the nearest block-level element
        # the nearest element at which the search for an open element of the same list may end
        self.scope: Element = self if not up or tag in CONTAINERS or tag in LEVEL_TAGS else up.scope
        against = own == BOILERPLATE
        self.certain = against and tag in CERTAIN_TAGS or bool(up and up.certain)
        self.soft: Element | None = self if against and tag not in CERTAIN_TAGS else up.soft if up else None
        outer = up.leaning if up else OPEN
        inside = outer == BOILERPLATE and tag in CONTENT_TAGS and not self.certain
        if against or outer == BOILERPLATE and not inside:
            self.leaning = BOILERPLATE
        elif named:
            self.leaning = OPEN
        elif inside:
            # an article or main below an aside, form, dialog or a role weighs against that as against a name
            self.leaning, self.named = CONTENT, up.soft
        elif self.named and tag not in CONTENT_TAGS:
            self.leaning = outer
        else:
            self.leaning = own or outer


class Block:
    __slots__ = ("text", "place", "odds", "words")

    def __init__(self, text: str, place: Element, link_share: float):
        self.text, self.place = text, place
        self.words = text.count(" ") + 1
        if place.leaning:
            self.odds = INNER if place.leaning == CONTENT and place.named else CERTAIN * place.leaning
        else:
            self.odds = (min(self.words, 40) / 10 - 1 - 5 * link_share + (0.7 if text[-1] in ".!?…\"”»" else -0.5)
                         + (0.8 if place.tag in ("h1", "h2", "h3", "p", "blockquote", "pre") else 0.0))


def name_weights(blocks: list[Block]) -> dict[Element, float]:
    """What each listed name takes from the odds of the blocks below it: of nested names the heaviest counts."""
    prose: dict[Element, int] = {}
    total = 0
    for block in blocks:
        said = block.words if block.odds > 0 else 0
        total += said
        if block.place.named:
            prose[block.place.named] = prose.get(block.place.named, 0) + said
    waiting = list(prose)
    for name in waiting:
        outer = name.up.named
        if outer and outer not in prose:
            prose[outer] = 0
            waiting.append(outer)
    names = sorted(prose, key=lambda name: -name.depth)
    for name in names:
        if name.up.named:
            prose[name.up.named] += prose[name]
    weights: dict[Element, float] = {}
    for name in reversed(names):
        outside = (total - prose[name]) / total if prose[name] else 1.0
        weights[name] = max(NAMED * min(1.0, outside / PROSE_OUTSIDE), weights.get(name.up.named, 0.0))
    return weights


def own_leaning(tag: str, attributes: str, in_article: bool) -> tuple[int, bool]:
    """What an element says of itself, and whether its class or id has a listed word."""
    named = False
    against = tag in BOILERPLATE_TAGS or tag == "header" and not in_article
    speaks_for = tag in CONTENT_TAGS
    for name, value in ATTRIBUTE.findall(attributes) if attributes and not attributes.isspace() else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true":
            against = True
        elif name == "style":
            against |= "display:none" in value.replace(" ", "").lower()
        elif name == "role":
            against |= value.lower() in BOILERPLATE_ROLES
            speaks_for |= value.lower() in ("main", "article")
        elif name in ("class", "id"):
            for word in value.split():
                names = [part.lower() for part in NAME.findall(word)]
                bad = {n for at, n in enumerate(names) if (n in BOILERPLATE_NAMES or n.startswith(BOILERPLATE_STEMS))
                       and not (at and names[at - 1] in NOT_NAMES)}
                good = CONTENT_NAMES.intersection(names)
                if bad == {"header"} and (good or in_article):
                    bad = set()
                named |= bool(bad)
                speaks_for |= bool(good) and not bad
    return BOILERPLATE if against else CONTENT if speaks_for else OPEN, named


class TagEnds:
    """Where tags of a page end: at the first ``>`` outside of quotes. Linear over all tags of a page, however broken."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.marks: list[int] | None = None

    def simple(self, at: int) -> int:
        """The end of a declaration, quotes or not; -1 if it has none."""
        return self.page.find(">", at) + 1 if at <= self.last else -1

    def tag(self, at: int) -> int:
        """The end of a tag whose name ends at ``at``; -1 if it has none."""
        if at > self.last:
            return -1
        if self.marks is None:
            found = REST.match(self.page, at)
            if found:
                return found.end()
            self._look_ahead()
        return self.ends[bisect_left(self.marks, at)]

    def _look_ahead(self) -> None:
        """From the page's end: where a tag ends that goes on, outside of quotes, at each quote or ``>``."""
        self.marks = [mark.start() for mark in re.finditer("[\"'>]", self.page)]
        outside, in_double, in_single = -1, -1, -1
        self.ends = [-1] * (len(self.marks) + 1)
        for number in range(len(self.marks) - 1, -1, -1):
            mark = self.page[self.marks[number]]
            if mark == ">":
                outside = self.marks[number] + 1
            elif mark == '"':
                outside, in_double = in_double, outside
            else:
                outside, in_single = in_single, outside
            self.ends[number] = outside


def read_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, with white space made single."""
    root = Element("html", None, OPEN)
    place, blocks = root, []
    texts: list[str] = []
    link_texts: list[str] = []
    open_tags: dict[str, int] = {}
    links, at = 0, 0

    def close(block_place):
        nonlocal texts, link_texts
        if texts:
            text = "".join(texts)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                linked = sum(map(len, link_texts))
                blocks.append(Block(text, block_place, min(1.0, linked / len(text))))
            texts = []
        link_texts = []

    def take_text(low, high):
        texts.append(page[low:high])
        if links:
            link_texts.append(page[low:high])

    def leave(element):
        """Go to ``element``, an ancestor: what lies below is closed."""
        nonlocal place
        while place is not element:
            open_tags[place.tag] -= 1
            place = place.up

    def end_tag(tag):
        nonlocal links
        if tag in BLOCK_TAGS:
            close(place.block)
        if tag == "a":
            links = max(0, links - 1)
        if open_tags.get(tag):
            element = place
            while element.tag != tag:
                element = element.up
            leave(element.up)

    def start_tag(tag, attributes):
        nonlocal place, links
        if tag in BLOCK_TAGS:
            close(place.block)
        if place.tag == "head" and tag not in HEAD_TAGS:
            leave(place.up)
        if tag in CLOSED_BY_BLOCK:
            if place.block.up and place.block.tag == "p":
                leave(place.block.up)
        elif tag in SAME_LEVEL:
            element = place.scope
            while element.up and element.tag not in CONTAINERS and element.tag not in SAME_LEVEL[tag]:
                element = element.up.scope
            if element.up and element.tag in SAME_LEVEL[tag]:
                leave(element.up)
        if tag == "a":
            links += 1
        if tag not in VOID_TAGS and tag not in ("html", "body"):
            place = Element(tag, place, *own_leaning(tag, attributes, place.in_article))
            open_tags[tag] = open_tags.get(tag, 0) + 1

    ends = TagEnds(page)
    token = BEGIN.search(page)
    while token:
        start, behind = token.span()
        comment, declaration, slash, tag = token.groups()
        if comment:
            found = page.find("-->", behind)
            end = found + 3 if found >= 0 else len(page)
        else:
            end = ends.simple(behind) if declaration else ends.tag(behind)
        if end < 0:  # no tag, but text
            token = BEGIN.search(page, behind)
            continue
        if start > at:
            take_text(at, start)
        at = end
        if tag:
            tag, attributes = tag.lower(), page[behind:end - 1]
            if not slash and tag in RAW_TAGS and not attributes.endswith("/"):
                # what looks like tags inside is none: go on behind the end tag
                found = END_TAGS[tag].search(page, at) if at <= ends.last else None
                at = found.end() if found else len(page)
            elif slash:
                end_tag(tag)
            else:
                start_tag(tag, attributes)
        token = BEGIN.search(page, at)
    if at < len(page):
        take_text(at, len(page))
    close(place.block)
    return blocks


def shared_depth(a: Element, b: Element) -> float:
    """The share of the deeper element's ancestors that both have."""
    deepest = max(a.depth, b.depth)
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
    return (a.depth + 1) / (deepest + 1)


def minimum_cut(n: int, from_source: list[float], to_sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which of n nodes stay with the source in a minimum cut; edges are undirected. Dinic's algorithm."""
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def connect(a, b, forward, backward):
        heads[a].append(len(to))
        to.append(b)
        room.append(forward)
        heads[b].append(len(to))
        to.append(a)
        room.append(backward)

    for node in range(n):
        # what source and sink both pull at flows through at once
        both = min(from_source[node], to_sink[node])
        if from_source[node] > both:
            connect(source, node, from_source[node] - both, 0.0)
        elif to_sink[node] > both:
            connect(node, sink, to_sink[node] - both, 0.0)
    for a, b, weight in edges:
        connect(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        waiting = deque([source])
        while waiting:
            node = waiting.popleft()
            for edge in heads[node]:
                if room[edge] > 1e-9 and level[to[edge]] < 0:
                    level[to[edge]] = level[node] + 1
                    waiting.append(to[edge])
        if level[sink] < 0:
            return [level[node] >= 0 for node in range(n)]
        next_edge = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[edge] for edge in path)
                for edge in path:
                    room[edge] -= flow
                    room[edge ^ 1] += flow
                path, node = [], source
            if next_edge[node] < len(heads[node]):
                edge = heads[node][next_edge[node]]
                if room[edge] > 1e-9 and level[to[edge]] == level[node] + 1:
                    path.append(edge)
                    node = to[edge]
                else:
                    next_edge[node] += 1
            elif path:
                node = to[path.pop() ^ 1]
                next_edge[node] += 1
            else:
                break


def main_text(page: str) -> str:
    blocks = read_blocks(page)
    weights = name_weights(blocks)
    against = [weights.get(block.place.named, 0.0) for block in blocks]
    # the page says where its content is, so what lies elsewhere and says nothing is less likely content
    says = any(block.place.leaning == CONTENT and weight < NAMED / 2 for block, weight in zip(blocks, against))
    for block, weight in zip(blocks, against):
        if block.place.leaning != BOILERPLATE:
            block.odds -= weight + (OUTSIDE if says and (block.place.leaning == OPEN or weight >= NAMED / 2) else 0.0)
    nodes: list[list[Block]] = []
    for block in blocks:
        container = block.place.up or block.place
        last = nodes[-1][-1] if nodes else None
        if last and (last.place.up or last.place) is container and (last.odds > 0) == (block.odds > 0):
            nodes[-1].append(block)
        else:
            nodes.append([block])
    odds = [sum(block.odds for block in node) for node in nodes]
    edges, seen = [], {}
    for number, node in enumerate(nodes):
        place = node[0].place
        if number:
            edges.append((number - 1, number, NEIGHBOURS * shared_depth(nodes[number - 1][-1].place, place)))
        container = place.up or place
        if container in seen:
            edges.append((seen[container], number, SAME_CONTAINER * shared_depth(nodes[seen[container]][0].place, place)))
        seen[container] = number

    def cost(x):
        return math.log1p(math.exp(min(x, 500.0)))

    content = minimum_cut(len(nodes), [cost(x) for x in odds], [cost(-x) for x in odds], edges)
    return "\n".join(block.text for node, kept in zip(nodes, content) if kept for block in node)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def start():
        def handle(batch):
            texts = [main_text(page) for page in as_texts(batch["html"])]
            return pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])
        return handle

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_texts(pages.select("page_id", "url", "html"), f"page_id {kind}, url string, text string, n_chars long", start)
