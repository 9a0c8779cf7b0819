"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from orelode.llm.common import mapped, slices

# nothing in a tag is matched in two ways, so that broken markup costs no more than its length
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)

# Fixed values of HTML: elements without content, with raw text, and that begin a block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that never hold main text.
DROPPED = frozenset(
    "nav header footer aside form script style noscript template button select option textarea "
    "iframe object svg canvas head title menu dialog audio video input".split()
)
#: Words of a class, id or role that name something other than main text.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
    "navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup "
    "login share sharing social comment comments reply replies disqus related recommended "
    "recommendations pagination pager toolbar search contentinfo complementary alert".split()
)
#: Words that tell reader comments, and words beside them that say only whose or in what form.
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
FORM_OF = frozenset(
    "user users reader readers visitor post article blog entry page site list lists section area thread "
    "threads container wrapper wrap box block item items body content feed form panel main all".split()
)
#: Elements of running text: a block of these stays, whatever its links.
PROSE = frozenset("p pre blockquote figcaption h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that an opening tag closes when they are open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
CLOSES |= {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
WALLS = frozenset("ul ol dl table select div article section main body html td th".split())
MARKS = WALLS.union(*CLOSES.values())
#: Elements that can be the main one, whole articles, and what lies outside the body.
CONTAINERS = frozenset("#root html body article main section div td table center details".split())
ARTICLES = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
OUTSIDE = frozenset("html #root".split())
#: Share of a subtree's text that an article or main element must hold to be taken instead.
MOSTLY = 0.5


class Node:
    """An element: its own pieces of text and children in page order, and subtree counts."""

    __slots__ = ("tag", "parent", "items", "dropped", "named", "chars", "tags", "link_chars", "link_tags",
                 "density", "sum", "best", "article", "para", "mark")

    def __init__(self, tag: str, parent: Node | None, dropped: bool):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, False
        # the nearest open paragraph, and the nearest element that a search for one to end looks at
        self.para = self if tag == "p" else None if tag in WALLS or parent is None else parent.para
        self.mark = self if tag in MARKS else None if parent is None else parent.mark
        self.items: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.best: Node | None = None
        self.article: Node | None = None


def told(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes hide an element, and whether a whole class, id or role names it as
    something beside the main text: a token made of such words alone."""
    hidden = named = False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden = hidden or UNSEEN.search(value) is not None
        elif name == "aria-hidden":
            hidden = hidden or value.strip().lower() == "true"
        elif name in ("class", "id", "role"):
            named = named or any(names_other(token) for token in value.lower().split())
    return hidden, named


def names_other(token: str) -> bool:
    """Whether a whole token is made of words for what is not main text, or is one for comments."""
    words = {word for word in re.split("[-_]+", token) if word}
    if words & COMMENTS:
        return (NAMED | COMMENTS | FORM_OF).issuperset(words)
    return bool(words) and NAMED.issuperset(words)


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its nodes with parents before children."""
    root = Node("#root", None, False)
    nodes, here, at = [root], root, 0
    #: open elements by name, so that an end tag without a start is not searched for
    opened: Counter[str] = Counter()

    def up_to(node: Node) -> Node:
        above = here
        while above is not node:
            opened[above.tag] -= 1
            above = above.parent
        return node

    last = page.rfind(">") + 1
    while found := MARKUP.search(page, at, last):
        if found.start() > at:
            here.items.append(page[at : found.start()])
        at, tag = found.end(), (found["tag"] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA["):
                here.items.append(html.escape(found[0][9:-3]))
            elif found[0].startswith("<!--") and not found[0].endswith("-->"):
                at = len(page)
            continue
        if found["end"]:
            if opened[tag]:
                node = here
                while node.tag != tag:
                    node = node.parent
                here = up_to(node.parent)
            continue
        here = up_to(closed_by(tag, here))
        rest = found["rest"]
        dropped = here.dropped or tag in DROPPED
        named = False
        if rest and not dropped and tag not in ("html", "body", "article", "main"):
            dropped, named = told(rest)
        node = Node(tag, here, dropped)
        node.named = named
        here.items.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            if not dropped:
                node.items.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif tag not in VOID and not rest.endswith("/"):
            opened[tag] += 1
            here = node
    if at < len(page):
        here.items.append(page[at:])
    drop_named(nodes)
    return root, nodes


def drop_named(nodes: list[Node]) -> None:
    """Drops what its name tells to be something else, and all below it.

    An element that holds a main element or an article is kept whatever its name; articles within
    an article (its comments) do not count. So is one with most of the text of a page whose
    articles have none: beside one that has, an advert may be the longer text.
    """
    if not any(node.named for node in nodes):
        return
    chars = {node: 0 for node in nodes}
    holds: set[Node] = set()
    for node in reversed(nodes):
        if node.dropped:
            continue
        chars[node] += own_chars(node)
        if node.parent is not None:
            chars[node.parent] += chars[node]
            if node.tag in ARTICLES or node in holds:
                holds.add(node.parent)
    within: set[Node] = set()
    marked = any(node.tag in ARTICLES and chars[node] for node in nodes)
    for node in nodes:
        up = node.parent
        if up is None:
            continue
        if up in within or up.tag == "article":
            within.add(node)
        if up.dropped:
            node.dropped = True
        elif node.named and (node not in holds or node in within):
            node.dropped = marked and node not in within or chars[node] <= MOSTLY * chars[nodes[0]]


def own_chars(node: Node) -> int:
    return sum(len("".join(x.split())) for x in node.items if isinstance(x, str))


def closed_by(tag: str, here: Node) -> Node:
    """The open element that an opening tag belongs into: it may end a paragraph or an item."""
    if tag in BLOCK and here.para is not None:
        here = here.para.parent
    if tag in CLOSES:
        node = here.mark
        while node is not None and (node.tag not in WALLS or node.tag in CLOSES[tag]):
            if node.tag in CLOSES[tag]:
                here = node.parent
            node = node.parent.mark
    return here


def weigh(nodes: list[Node]) -> float:
    """Counts of every subtree, its link-adjusted density and the sum over its children; the
    container with the largest sum in it, and the longest article below it. Gives the page's
    share of links."""
    for node in reversed(nodes):
        if node.dropped:
            continue
        node.chars += own_chars(node)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    whole = nodes[0]
    share = whole.link_chars / max(whole.chars, 1)
    for node in nodes:
        if node.dropped or not node.chars:
            continue
        node.density = density_of(node.chars, node.tags, node.link_chars, node.link_tags, share)
        if node.parent is not None:
            node.parent.sum += node.density
    for node in reversed(nodes):
        if node.dropped:
            continue
        # of equal ones the outer, then the first
        if node.tag in CONTAINERS and node.sum > 0 and (node.best is None or node.sum >= node.best.sum):
            node.best = node
        up = node.parent
        if up is None:
            continue
        if node.best is not None and (up.best is None or node.best.sum >= up.best.sum):
            up.best = node.best
        longest = node if node.tag in ARTICLES else node.article
        if longest is not None and (up.article is None or longest.chars >= up.article.chars):
            up.article = longest
    return share


def density_of(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, lowered by links."""
    links, plain = max(link_chars, 1), max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + share * chars + math.e)
    tags, link_tags = max(tags, 1), max(link_tags, 1)
    ratio = chars / links * tags / link_tags
    return chars / tags * max(math.log(max(ratio, 1.0)) / math.log(max(base, 1.0001)), 0)


def main_nodes(root: Node, share: float) -> tuple[list[Node], float]:
    """The subtrees with main text in page order, and the threshold: the least density between
    the container with the largest sum of child densities and the body.

    From the root down, every subtree that reaches the threshold is taken apart until it is the
    one with the largest sum in it, which is taken whole; where that one lies deeper, it is taken
    and the others beside its path are looked at in turn. It gives way to an element around it
    that adds little text and few links. An article is taken whole, and a container that holds
    one with most of its text is taken apart. Text that lies bare between elements counts as an
    element of its own; a heading goes with what follows it.
    """
    best = root.best or root
    path = [best, *ancestors(best)]
    if any(node.tag == "body" for node in path):
        path = [node for node in path if node.tag not in OUTSIDE] or path
    threshold = min(node.density for node in path)
    taken: list[Node] = []
    forced: set[Node] = set()
    ends: dict[Node, Node] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        inner, target = node.article, node.best
        mostly = inner is not None and inner.chars >= MOSTLY * node.chars
        if node.tag in ARTICLES:
            whole = not (node.tag == "main" and mostly and target is not None and inner in ancestors(target))
        else:
            whole = not mostly and (target is None or around(target, node, ends, forced) is node)
        if whole:
            taken.append(node)
            continue
        if mostly:
            forced.add(inner)
            forced.update(between(inner, node))
        stack.extend(reversed(parts(node, threshold, share, forced)))
    return taken, threshold


def around(target: Node, top: Node, ends: dict[Node, Node], forced: set[Node]) -> Node:
    """The target or the element below ``top``, or that itself, to which it gives way; what lies
    on the way from ``top`` to it is marked."""
    if target not in ends:
        end = target
        while end is not top:
            up = end.parent
            added, links = up.chars - end.chars, up.link_chars - end.link_chars
            if up.tag == "body" or up.tag in OUTSIDE or added > MOSTLY * end.chars or 2 * links > added:
                break
            end = up
        ends[target] = end
        if end is not top:
            forced.add(end)
            forced.update(between(end, top))
    return ends[target]


def between(node: Node, top: Node) -> Iterator[Node]:
    up = node.parent
    while up is not top:
        yield up
        up = up.parent


def parts(node: Node, threshold: float, share: float, forced: set[Node]) -> list[Node]:
    """Children of an element, and runs of bare text between them, that can hold main text."""
    units: list[Node] = []
    run: Node | None = None
    for item in node.items:
        if isinstance(item, Node) and (item.tag in BLOCK or item.best is not None or item in forced):
            run = None
            if not item.dropped and item.chars:
                units.append(item)
            continue
        if run is None:
            run = Node("#run", node, False)
            units.append(run)
        run.items.append(item)
        if isinstance(item, str):
            run.chars += len("".join(item.split()))
        elif not item.dropped:
            run.chars += item.chars
            run.tags += item.tags + 1
            run.link_chars += item.link_chars
            run.link_tags += item.link_tags
    kept, follows = [], False
    for unit in reversed([unit for unit in units if unit.chars]):
        if unit.tag == "#run":
            unit.density = density_of(unit.chars, unit.tags, unit.link_chars, unit.link_tags, share)
        if unit.density >= threshold or unit in forced:
            follows = True
        elif not is_heading(unit):
            follows = False
        if follows:
            kept.append(unit)
    return kept[::-1]


def is_heading(node: Node) -> bool:
    """Whether all text of an element is that of one heading which is not mostly links."""
    if 2 * node.link_chars > node.chars:
        return False
    while node.tag not in HEADINGS:
        inner = [x for x in node.items if isinstance(x, Node) and not x.dropped and x.chars]
        if len(inner) != 1 or inner[0].chars < node.chars:
            return False
        node = inner[0]
    return True


def ancestors(node: Node) -> list[Node]:
    found, up = [], node.parent
    while up is not None:
        found.append(up)
        up = up.parent
    return found


def blocks_of(top: Node, threshold: float) -> list[str]:
    """Texts of the blocks below a node in page order, without menus: blocks other than running
    text that hold links and no more than a sign between them, and are thinner than the threshold."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    stack: list = [iter([top])]
    closing: list[Node | None] = [None]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            node = closing.pop()
            if node is not None and node.tag in BLOCK:
                end()
        elif isinstance(item, str):
            line.append(item)
        elif item.dropped:
            continue
        elif item.tag == "br":
            line.append(" ")
        elif not (item.tag in BLOCK and item.tag not in PROSE and item is not top and item.chars
                  and item.chars - item.link_chars <= item.link_tags and item.density < threshold):
            if item.tag in BLOCK:
                end()
            stack.append(iter(item.items))
            closing.append(item)
    end()
    return blocks


def main_text(page: str | None) -> str:
    """The main text of one page; empty for null, for an empty page and for one without text."""
    root, nodes = parse(page or "")
    tops, threshold = main_nodes(root, weigh(nodes))
    return "\n\n".join(block for top in tops for block in blocks_of(top, threshold))


def extract_main_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """All columns but the page itself, with ``text`` and ``n_chars`` of its main text.

    Elements that by tag, class, id or role are menus, headers, footers, sidebars, notices,
    adverts, forms, comments or code are left out. Among the others, the subtree with the
    largest sum of child densities (characters per tag, lowered by links) is a main one, and so
    is every other that is as dense as the least dense element between that one and the body;
    within them, blocks other than running text that hold nothing but links, and are thinner than
    that, go as menus.

    Null and empty pages give an empty text. Broken markup never fails: unclosed elements end
    with the page. Rows are independent, so repeated rows and ids give repeated results;
    columns called text or n_chars give way to the new ones.
    """
    kept = [c for c in pages.columns if c not in (page, "text", "n_chars")]
    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(value) for value in part.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(kept)], pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                [*kept, "text", "n_chars"],
            )

    schema = ", ".join([*kinds, "text string", "n_chars long"])
    return mapped(pages.select(*kept, page), extract, schema)
