"""Main text of web pages by composite text density.

Each page becomes a DOM tree inside one Python task (pages are independent, so
there is no shuffle).  Every node gets its characters per tag, adjusted by the
share of the characters that stand in links: a menu has few characters per tag
and nearly all of them linked, prose has many and few linked.  The sum of the
densities of a node's children says where the prose hangs together.  The
threshold is the least density on the path from ``body`` to the node of the
largest sum; from ``body`` down, each node at or above the threshold gives its
subtree of the largest sum to the text.  Only elements that can hold a whole
article are measured against each other, so a lone paragraph never wins over
the article around it.  What is chosen grows to the article (or main) around it.
Other prose follows: blocks nearly as dense as those chosen, in a page with
articles only those in an article or main; a subtree that is mostly such blocks
comes whole, and so do short unlinked blocks between two chosen ones and headings
right before one.

Elements that are furniture by their tag or role (menus, footers, forms, scripts
...) leave the tree first.  A class or id (advert, sidebar ...) is evidence
only: a whole name or its last word counts, and the element stays if it holds an
article (one that is no advert or comment itself), the page's headline with prose,
or most of the unlinked prose around it.  Names that articles have too (discussion,
share ...) count outside articles only.

Reader comments go by what they are: elements named so, unless there is next to no
other prose; what stands under a heading that says so ("Comments", "12 replies")
after prose; and a discussion whose entries repeat an author or a date.

Defined results: null or empty html gives an empty text; malformed html is
closed the way browsers do (a new block ends an open paragraph, unknown end
tags are ignored); ``<br>`` counts as white space inside its block; nulls in
page_id or url are passed through; repeated rows are extracted each; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import only_columns, text_slices

#: What may stand at a "<" (a comment's end is looked for by itself).
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<[/!?][^>]*>"
    r"|</?[a-zA-Z][^>]*>", re.S)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: An open element of the first kind ends where one of the second begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
         "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
         "option": {"option", "optgroup"}, "p": BLOCKS}
#: Elements that can hold an article as a whole; a heading or a paragraph can't.
CONTAINERS = frozenset(
    "html body article main section div center table tbody tr td ul ol dl dd blockquote details "
    "fieldset figure hgroup pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A block is prose from this share of the usual density of the chosen blocks on.
PROSE_SHARE = 0.25
_SCOPES = frozenset("body article section div main ul ol dl table blockquote".split())
#: Page furniture by tag, by role, and by names of class and id.
FURNITURE_TAGS = frozenset(
    "nav aside footer form script style noscript template iframe svg math button select "
    "textarea input label object embed canvas audio video head menu dialog".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split())
COMMENT_NAMES = frozenset("comment comments commentlist respond reply replies disqus".split())
FURNITURE_NAMES = COMMENT_NAMES | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor "
    "sponsored nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar side "
    "aside widget widgets related recommended share sharing social cookie cookies consent notice "
    "notices notification popup modal newsletter subscribe subscription signup login "
    "discussion pagination pager toolbar masthead skip "
    "disclaimer copyright gdpr alert".split())
#: Names that parts of an article have as well.
AMBIGUOUS_NAMES = frozenset(
    "discussion alert disclaimer copyright side share sharing social skip menu navigation".split())
#: Names by which an article element is no article.
NO_ARTICLE_NAMES = COMMENT_NAMES | frozenset(
    "ad ads advert adverts advertisement advertising promo promotion sponsor sponsored related recommended".split())
#: Names of the parts that every entry of a discussion has.
ENTRY_NAMES = frozenset("author user username avatar byline date time timestamp posted".split())
#: What a heading above reader comments says.
_COMMENT_HEADING = re.compile(
    r"(?:\d+ +)?(?:(?:reader|user|your|all|recent|latest|our readers'?) +)?"
    r"(?:comments?|responses?|replies|reactions|kommentare?|commentaires?|comentarios?)"
    r"(?: +(?:from|by|of) +(?:our +)?readers)?(?: *\(\d+\))? *:?|(?:leave|post|write) an? (?:comment|reply)", re.I)
#: Prose beside an element of comments for it to go, and before a heading of comments.
OTHER_PROSE = 200
#: Last words that say where or in which form, and words that tell a state of the page.
_FORM_WORDS = frozenset(
    "area bar block bottom box buttons container content form inner item items left links list "
    "main outer right section slot top unit wrap wrapper".split())
_STATE_WORDS = frozenset("has is no not with without".split())
#: Characters of prose that a named element needs for its headline to count.
HEADLINE_PROSE = 200
_WORD = re.compile(r"[a-z]+")
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|(\S+)))?""",
                   re.I)


class _Node:
    __slots__ = ("tag", "children", "furniture", "named", "entry", "chars", "tags", "link_chars",
                 "link_tags", "density", "total", "best")

    def __init__(self, tag: str, furniture: bool = False, named: int = 0, entry: bool = False):
        self.tag, self.furniture, self.named, self.entry = tag, furniture, named, entry
        self.children: list = []  # nodes, and strings of text


def _is_furniture(tag: str, attrs: str, open_count: dict[str, int]) -> bool:
    if tag in FURNITURE_TAGS:
        return True
    if tag == "header":  # an article's own header holds its headline
        return not (open_count.get("article") or open_count.get("main"))
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "role":
            if value in FURNITURE_ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _named(tag: str, attrs: str) -> tuple[int, bool]:
    """Whether class or id name furniture: 0 no, 1 by a name that parts of an
    article have too, 2 yes, 3 comments; and whether they name an author or a date."""
    found, entry = 0, tag == "time"
    if not attrs or tag in ("html", "body", "main"):
        return found, entry
    names = NO_ARTICLE_NAMES if tag == "article" else FURNITURE_NAMES
    for name, a, b, c in _ATTR.findall(attrs):
        if name.lower() not in ("class", "id"):
            continue
        for token in (a or b or c).lower().split():
            words = _WORD.findall(token)
            if not _STATE_WORDS.isdisjoint(words):
                continue
            while len(words) > 1 and words[-1] in _FORM_WORDS:
                words.pop()
            last = words[-1] if words else ""
            entry = entry or last in ENTRY_NAMES
            if last in names:
                found = max(found, 3 if last in COMMENT_NAMES else 1 if last in AMBIGUOUS_NAMES else 2)
    return found, entry


def parse(page: str) -> _Node:
    """The tree of a page; text is decoded, comments and raw elements are gone."""
    root = _Node("html")
    stack = [root]
    open_count = {"html": 1}

    def pop() -> None:
        open_count[stack.pop().tag] -= 1

    at, n = 0, len(page)
    last = page.rfind(">")  # a "<" beyond it begins no tag: nothing is looked for from there
    while at < n:
        begin, m = at, None
        while m is None:
            begin = page.find("<", begin)
            if begin < 0:
                break
            if page.startswith("<!--", begin):
                break
            m = _TAG.match(page, begin) if begin < last else None
            begin += m is None
        text = page[at:begin if begin >= 0 else n]
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)
        if begin < 0:
            break
        if m is None:
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else n
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3]
        if m[1]:
            if open_count.get(tag):
                while stack[-1].tag != tag:
                    pop()
                if len(stack) > 1:
                    pop()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in ("html", "body") and open_count.get(tag):
            continue
        for open_tag, enders in _ENDS.items():
            if tag in enders and open_count.get(open_tag):
                i = len(stack) - 1
                while stack[i].tag != open_tag and (stack[i].tag not in _SCOPES):
                    i -= 1
                if stack[i].tag == open_tag:
                    while len(stack) > i:
                        pop()
        node = _Node(tag, _is_furniture(tag, attrs, open_count), *_named(tag, attrs))
        stack[-1].children.append(node)
        if tag not in VOID and not (attrs.endswith("/") and tag not in BLOCKS):
            stack.append(node)
            open_count[tag] = open_count.get(tag, 0) + 1
    return root


def _measure(root: _Node) -> list[_Node]:
    """Characters, tags and link shares of all nodes, children first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        node.children = [c for c in node.children if isinstance(c, str) or not c.furniture]
        todo += [c for c in node.children if not isinstance(c, str)]
    order.reverse()
    for node in order:
        chars = tags = link_chars = link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                chars += len(c.strip())
            else:
                chars += c.chars
                tags += c.tags + 1
                link_chars += c.link_chars
                link_tags += c.link_tags
        if node.tag == "a":
            link_chars, link_tags = chars, tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    return order


def _text(node: _Node, most: int = 80) -> str:
    """The text of a small node (a longer one: its beginning)."""
    out, todo, size, seen = [], [node], 0, 0
    while todo and size <= most and seen < 4 * most:
        item = todo.pop()
        seen += 1
        if isinstance(item, str):
            out.append(item)
            size += len(item)
        else:
            todo += reversed(item.children)
    return " ".join("".join(out).split())


def _mark_comments(root: _Node) -> None:
    """Names as comments what stands under a heading of comments, if there is prose
    before: the section that the heading begins, or else all up to the next heading
    of its rank."""
    seen = 0
    first: dict[int, int] = {}  # place of the first child with text
    todo: list = [(root, None, 0, False)]
    while todo:
        item, around, place, link = todo.pop()
        if isinstance(item, str):
            seen += 0 if link else len(item.strip())
            continue
        if item.tag in HEADINGS and around is not None and seen >= OTHER_PROSE and item.chars <= 60 \
                and _COMMENT_HEADING.fullmatch(_text(item)):
            if id(around) not in first:
                first[id(around)] = next(i for i, c in enumerate(around.children)
                                         if (c.strip() if isinstance(c, str) else c.chars))
            if first[id(around)] == place and around.tag not in ("html", "body", "article", "main"):
                around.named = 3
            else:
                item.named = 3
                for c in map(around.children.__getitem__, range(place + 1, len(around.children))):
                    if isinstance(c, str):
                        continue
                    if c.tag in HEADINGS and c.tag <= item.tag:
                        break
                    c.named = 3
        todo += [(c, item, i, link or item.tag == "a") for i, c in reversed(list(enumerate(item.children)))]


def _without_named(root: _Node, order: list[_Node]) -> list[_Node]:
    """The nodes once more, without those that are furniture by name, and
    without reader comments."""
    if any(n.tag in HEADINGS for n in order):
        _mark_comments(root)
    if not any(n.named for n in order):
        return order
    plain = lambda n: n.chars - n.link_chars
    # an article or main with text, number of h1, an author or date, children with one
    holds: dict[int, tuple[bool, int, bool, int]] = {}
    for node in order:
        inner = [holds[id(c)] for c in node.children if not isinstance(c, str)]
        own = node.tag in ("article", "main") and plain(node) > 0
        entries = sum(i[2] for i in inner)
        holds[id(node)] = (not node.named and own or any(i[0] for i in inner),
                           (node.tag == "h1") + sum(i[1] for i in inner), node.entry or entries > 0, entries)
    in_articles, headlines = holds[id(root)][:2]
    todo = [(root, root)]
    while todo:
        node, around = todo.pop()
        if node.tag in ("article", "main") and not node.named:
            around = node
        if node.named:
            article, h1, _, entries = holds[id(node)]
            inside = around is not root
            named = node.named
            if named == 1 and entries > 1:  # a discussion among readers
                named = 3
            if named == 3:
                node.furniture = not article and plain(around) - plain(node) >= OTHER_PROSE
            else:
                node.furniture = not (
                    article or h1 and h1 == headlines and plain(node) >= HEADLINE_PROSE
                    or (inside or not in_articles) and 2 * plain(node) > plain(around)
                    or named == 1 and (inside or not in_articles) and plain(node) > node.link_chars
                    and node.tag in ("section", "p", *HEADINGS))
        if not node.furniture:
            todo += [(c, around) for c in node.children if not isinstance(c, str)]
    return _measure(root)


def _density(node: _Node, page_link_share: float) -> float:
    """Characters per tag, less the more of both is in links."""
    if not node.chars:
        return 0.0
    tags = max(node.tags, 1)
    linked, plain = max(node.link_chars, 1), max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + page_link_share * node.chars + math.e)
    ratio = node.chars / linked * tags / max(node.link_tags, 1)
    return node.chars / tags * math.log(max(ratio, 1.0)) / base if ratio > 1 else 0.0


def main_text(page: str) -> str:
    """The main text of one page: its blocks in page order, one per line."""
    if not page:
        return ""
    root = parse(page)
    order = _without_named(root, _measure(root))
    body = next((n for n in reversed(order) if n.tag == "body"), root)
    if not body.chars:
        body = root
    share = body.link_chars / max(body.chars, 1)
    parent: dict[int, _Node] = {}
    for node in order:
        node.density = _density(node, share)
        node.total, node.best = 0.0, None
        for c in node.children:
            if isinstance(c, str):
                node.total += len(c.strip())
            else:
                node.total += c.density
                parent[id(c)] = node
        if node.tag in CONTAINERS:
            node.best = node
        for c in node.children:
            if not isinstance(c, str) and c.best and (not node.best
                                                      or c.best.total > node.best.total):
                node.best = c.best
    best, threshold = body.best, body.best.density
    step = best
    while step is not body and id(step) in parent:
        step = parent[id(step)]
        threshold = min(threshold, step.density)
    chosen: dict[int, _Node] = {}
    todo = [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold and node.best and node.chars:
            chosen[id(node.best)] = node.best
            todo += [c for c in node.children if not isinstance(c, str)]
    return _render(body, _completed(body, chosen, parent))


def _inner(node: _Node) -> list[_Node]:
    return [c for c in node.children if not isinstance(c, str)]


def _leaves(node: _Node) -> list[_Node]:
    """The blocks without blocks in them, headings apart, in page order."""
    out, todo = [], [node]
    while todo:
        node = todo.pop()
        inner = _inner(node)
        if node.tag in BLOCKS and node.tag not in HEADINGS and node.chars and not any(
                c.tag in BLOCKS for c in inner):
            out.append(node)
        else:
            todo += reversed(inner)
    return out


def _completed(body: _Node, chosen: dict[int, _Node], parent: dict[int, _Node]) -> set[int]:
    """What is chosen, grown to the articles around it, with the prose, the short
    blocks and the headings that belong to it."""
    of_article: dict[int, _Node] = {}  # the outermost article around a node, or else its main
    todo: list = [(body, None)]
    while todo:
        node, around = todo.pop()
        if node.tag in ("article", "main") and (around is None or around.tag == "main" != node.tag):
            around = node
        if around:
            of_article[id(node)] = around
        todo += [(c, around) for c in _inner(node)]
    roots = {id(n): n for n in (of_article.get(i, n) for i, n in chosen.items())}
    in_articles = any(i in of_article for i in roots)

    above: set[int] = set()
    for node in roots.values():
        while id(node) in parent and id(parent[id(node)]) not in above:
            node = parent[id(node)]
            above.add(id(node))
    found = sorted((n for r in roots.values() if id(r) not in above for n in _leaves(r)),
                   key=lambda n: n.density)
    if not found:
        return set(roots)
    half, level = sum(n.chars for n in found) / 2, 0.0
    for n in found:
        half, level = half - n.chars, n.density * PROSE_SHARE
        if half <= 0:
            break

    def linked(n: _Node) -> bool:
        return 2 * n.link_chars >= n.chars

    prose: dict[int, int] = {}  # unlinked characters of the dense blocks below
    for leaf in _leaves(body):
        if leaf.density >= level and not linked(leaf):
            prose[id(leaf)] = leaf.chars - leaf.link_chars
    order, todo = [], [body]
    while todo:
        order.append(todo.pop())
        todo += _inner(order[-1])
    for node in reversed(order):
        if id(node) in prose and node is not body:
            up = id(parent[id(node)])
            prose[up] = prose.get(up, 0) + prose[id(node)]

    units, todo = [], [body]  # what is taken, headings and other blocks, in page order
    taken: dict[int, _Node] = {}
    while todo:
        node = todo.pop()
        whole = id(node) in roots
        if not whole and id(node) not in above and id(node) in prose and not linked(node):
            whole = (not in_articles or id(node) in of_article) and \
                2 * prose[id(node)] >= node.chars - node.link_chars
        if whole:
            taken[id(node)] = node
            units.append(node)
        elif node.tag in HEADINGS and node.chars:
            units.append(node)
        else:
            inner = _inner(node)
            if node.tag in BLOCKS and node.chars and not any(c.tag in BLOCKS for c in inner):
                units.append(node)
            todo += reversed(inner)

    def holds_h1(node: _Node) -> bool:
        todo = [node]
        while todo:
            node = todo.pop()
            if node.tag == "h1":
                return True
            todo += _inner(node)
        return False

    first = [i for i, n in enumerate(units) if id(n) in taken]
    if not first:
        return set(roots)
    for n in list(taken.values()):
        while id(n) in parent and id(parent[id(n)]) not in above:
            n = parent[id(n)]
            above.add(id(n))
    has_h1 = any(map(holds_h1, taken.values()))
    at = {id(n): i for i, n in enumerate(units)}
    following = None  # the next unit that is no heading is taken
    for n in reversed(units):
        if id(n) in taken:
            following = True
        elif n.tag not in HEADINGS:
            near = id(parent[id(n)]) in above and first[0] < at[id(n)] < first[-1]
            following = near and not linked(n)
            if following:
                taken[id(n)] = n
        elif following and (id(parent[id(n)]) in above or n.tag == "h1" and not has_h1):
            taken[id(n)] = n
    return set(taken)


def _render(body: _Node, chosen: set[int]) -> str:
    lines: list[str] = []
    block: list[str] = []

    def close() -> None:
        line = " ".join("".join(block).split())
        if line:
            lines.append(line)
        block.clear()

    todo: list = [(body, id(body) in chosen, False)]
    while todo:
        item, inside, leaving = todo.pop()
        if isinstance(item, str):
            if inside:
                block.append(item)
        elif leaving:
            close()
        elif item.tag == "br":
            block.append(" ")
        else:
            if item.tag in BLOCKS:
                close()
                todo.append((item, inside, True))
            todo += [(c, inside or not isinstance(c, str) and id(c) in chosen, False)
                     for c in reversed(item.children)]
    close()
    return "\n".join(lines)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its n_chars for every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in text_slices(batch.column("html")):
                texts = [main_text(p) for p in group]
                yield pa.record_batch({
                    "page_id": batch.column("page_id").slice(first, len(group)),
                    "url": batch.column("url").slice(first, len(group)),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    pages = only_columns(pages, "page_id", "url", "html")
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return pages.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
