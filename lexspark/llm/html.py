"""Main text of HTML pages by tree scoring."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text, not markup, and never part of an article.
RAW = frozenset("script style noscript template iframe noembed noframes textarea title xmp".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements that never belong to the main text.
DROPPED = RAW | frozenset("nav aside footer form button select datalist svg math canvas object audio video dialog menu head fieldset search input".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: An open element ends where one of these begins.
CLOSED_BY = {
    "p": BLOCKS - {"body", "html", "option", "optgroup"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]), "head": frozenset(["body"]), "thead": frozenset(["tbody", "tfoot"]), "tbody": frozenset(["tbody", "tfoot"]),
}
#: An end tag or an implied end does not reach beyond these.
SCOPES = frozenset("table td th body html article section main aside nav header footer form".split())
LISTS = frozenset(["ul", "ol", "dl", "menu", "table", "tbody", "thead", "tfoot", "tr"])
#: Nothing beyond these is ended by a later element.
STOPS = (LISTS - {"tr", "tbody", "thead"}) | (SCOPES - {"td", "th"})
#: Elements that are parts of a container.
PARTS = HEADINGS | frozenset("section p li dt dd tr td th tbody thead blockquote pre ul ol dl figure figcaption".split())

#: Words in class, id or role that mark what surrounds an article.
AROUND = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion|tions)?|banners?|breadcrumbs?|menus?|nav|navs?|navbar|navigation|sidebars?|side-?bar|"
    r"rail|footers?|foot-?bar|masthead|site-?header|page-?header|header-?bar|topbar|toolbar|comments?|comment-?list|respond|replies|disqus|discussion|cookies?|consent|gdpr|notices?|alerts?|"
    r"popups?|pop-up|modal|overlay|newsletter|subscribe|subscription|signup|sign-up|login|share|sharing|social|related|recommended|recommendations|widgets?|pagination|pager|"
    r"contentinfo|complementary|search|skip-?link|disclaimer|outbrain|taboola|hidden|tags|tag-?cloud)(?![a-z])", re.I)
TOWARDS = re.compile(r"(?<![a-z])(?:articles?|body|content|contents|entry|entry-content|main|page-content|post|posts|post-body|story|text|blog|hentry)(?![a-z])", re.I)

#: Names that tell how a page or an element is laid out, not what it is.
LAYOUT = re.compile(r"^(?:has|no|with|without|is|show|hide|hides|shows)[-_]|[-_](?:open|opened|closed|collapsed|expanded|left|right|page|layout|template|enabled|disabled|on|off)$", re.I)

_TAG = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[A-Za-z])")
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_TAG_END = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "named", "weight", "score", "own", "size", "links", "near")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, named: bool = False, weight: float = 0.0):
        self.tag, self.parent, self.dropped, self.weight, self.score = tag, parent, dropped or named, weight, 0.0
        #: Whether only its names speak against it; the points of its own paragraphs; the text and the linked text below it.
        self.named, self.own, self.size, self.links = named and not dropped, 0.0, 0, 0
        self.children: list[Node | str] = []
        #: The nearest open element, itself included, that a later one may end; none beyond a list or a scope.
        self.near: Node | None = self if tag in CLOSED_BY else None if parent is None or tag in STOPS else parent.near


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """``kind, name, rest`` of a page: text (character references decoded), start tags with their attributes, end tags."""
    at, size = 0, len(html)
    while at < size:
        found = _TAG.search(html, at)
        stop = found.start() if found else size
        if stop > at:
            yield "text", "", unescape(html[at:stop])
        if not found:
            return
        mark = found.group()
        if mark == "<!--":
            end = html.find("-->", stop + 2)
            at = size if end < 0 else end + 3
        elif mark == "<![CDATA[":
            end = html.find("]]>", stop)
            yield "text", "", html[stop + 9:size if end < 0 else end]
            at = size if end < 0 else end + 3
        elif mark in ("<!", "<?"):
            end = html.find(">", stop)
            at = size if end < 0 else end + 1
        else:
            closed = _TAG_END.match(html, stop + 1)
            # A quote that nothing ends: the tag ends at its first >. One without > is cut off, and is no text.
            end = closed.end() if closed else html.find(">", stop) + 1
            if not end:
                return
            tag = html[stop:end]
            name = _NAME.match(tag).group(1).lower()
            at = end
            if mark[1] == "/":
                yield "end", name, ""
                continue
            yield "start", name, tag[len(name) + 1:-1]
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else size


def _weigh(name: str, rest: str) -> tuple[bool, bool, float]:
    """Whether an element is hidden, whether its names mark what surrounds an article, and how much they speak for one."""
    if not rest.strip():
        return False, False, 0.0
    attributes = {a.lower(): unescape(b or c or d or "") for a, b, c, d in _ATTRIBUTE.findall(rest)}
    said = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True, False, 0.0
    towards = bool(TOWARDS.search(said)) or attributes.get("itemprop", "").lower() == "articlebody"
    around = any(AROUND.search(re.sub(r"([a-z])([A-Z])", r"\1-\2", x)) for x in said.split() if not LAYOUT.search(x))
    if around and name not in ("body", "html") and not (towards and name in ("p", *HEADINGS)):
        return False, True, 0.0
    return False, False, 25.0 if towards else 0.0


def tree(html: str) -> Node:
    """The page as a tree; ends that are missing are implied, ends without a start are ignored."""
    root = Node("html", None)
    node = root
    for kind, name, rest in tokens(html):
        if kind == "text":
            node.children.append(rest)
        elif kind == "start":
            if name in ("html", "body"):
                while name == "body" and node.tag in ("head", "p"):
                    node = node.parent
                root.weight = max(root.weight, _weigh(name, rest)[2])
                continue
            scan = node.near
            while scan is not None:
                if name in CLOSED_BY[scan.tag]:
                    node = scan.parent
                    if scan.tag not in ("td", "th", "tr"):
                        break
                scan = scan.parent.near if scan.tag not in STOPS else None
            hidden, named, weight = _weigh(name, rest)
            child = Node(name, node, name in DROPPED or hidden, named and name not in ("article", "main"), weight)
            child.named |= named and name in ("article", "main")
            node.children.append(child)
            if name not in VOID and not (rest.rstrip().endswith("/") and name not in BLOCKS and name in ("svg", "path")):
                node = child
        elif name not in VOID:
            scan = node
            while scan is not root and scan.tag != name:
                if scan.tag in SCOPES and name not in SCOPES and name not in LISTS:
                    break
                scan = scan.parent
            if scan is not root and scan.tag == name:
                node = scan.parent
    return root


def _drop_headers(node: Node) -> None:
    """A page's header is dropped; one inside an article or main part holds its title and stays."""
    stack = [(node, False)]
    while stack:
        at, inside = stack.pop()
        for child in at.children:
            if isinstance(child, Node):
                child.dropped |= child.tag == "header" and not inside
                stack.append((child, inside or child.tag in ("article", "main")))


def _spare(root: Node) -> None:
    """Takes back drops that would lose the article: those by name, and of forms, around all there is of articles and main
    parts, and that of a form that holds most of the page's text. One whose own names are those of a comment is none."""
    whole: list[tuple[Node, list[Node], bool]] = []
    forms: dict[int, tuple[Node, int]] = {}
    total = 0
    stack: list[tuple[Node, tuple, bool, tuple]] = [(root, (), False, ())]
    while stack:
        at, soft, hard, within = stack.pop()
        if at.tag in ("article", "main") and not at.named:
            whole.append((at, _listed(soft), hard))
        if at.tag == "form" and not at.named and not hard:
            within = (at, within)
            forms[id(at)] = at, 0
        if at.dropped:
            if at.named or at.tag == "form":
                soft = (at, soft)
            else:
                hard = True
        for child in at.children:
            if isinstance(child, Node):
                stack.append((child, soft, hard, within))
            elif not hard and (size := len(child.strip())):
                total += size
                for form in _listed(within):
                    forms[id(form)] = form, forms[id(form)][1] + size
    free = [x for x in whole if not x[2]]
    if not any(not soft for _, soft, _ in free):
        for _, soft, _ in free:
            for node in soft:
                node.dropped = False
    for form, size in forms.values():
        if 2 * size > total:
            form.dropped = False


def _listed(linked: tuple) -> list[Node]:
    out = []
    while linked:
        node, linked = linked
        out.append(node)
    return out


def blocks(node: Node) -> list[tuple[Node, str, int]]:
    """The blocks of text below a node in page order: the element each belongs to, the text, and how much of it is in links."""
    out: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    linked = 0
    owner = node

    def close():
        nonlocal parts, linked
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            out.append((owner, text, linked))
        parts, linked = [], 0

    # A stack instead of recursion: pages may nest deeply.
    stack: list[tuple[str, object, Node, bool]] = [("in", node, node, False)]
    while stack:
        what, item, holder, link = stack.pop()
        if what == "text":
            owner = holder
            parts.append(item)
            if link:
                linked += len(_SPACE.sub(" ", item).strip())
        elif what == "close":
            close()
        elif not item.dropped:
            block = item.tag in BLOCKS
            if block:
                close()
                stack.append(("close", None, holder, link))
            if item.tag == "br":
                parts.append(" ")
            inner = item if block else holder
            for child in reversed(item.children):
                stack.append(("text" if isinstance(child, str) else "in", child, inner, link or item.tag == "a"))
    close()
    return out


def _score(root: Node, found: list[tuple[Node, str, int]]) -> list[Node]:
    """Points of paragraphs, passed to their ancestors, halved at each step; returns the nodes with text below, in page order.

    Children come before their parents, so each node is looked at once however deep the page is.
    """
    for owner, text, linked in found:
        if owner.tag not in HEADINGS and owner.tag not in ("li", "dt", "th", "option", "caption", "legend"):
            # A container with text of its own is its own paragraph's parent.
            own = owner.parent if owner.tag in ("p", "pre", "blockquote", "td", "figcaption", "dd") and owner.parent else owner
            own.own += (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / max(len(text), 1)) * min(1.0, len(text) / 25)
        owner.size += len(text)
        owner.links += linked
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [x for x in reversed(node.children) if isinstance(x, Node) and not x.dropped]
    for node in reversed(order):
        node.score += node.own
        if node.parent is not None:
            node.parent.score += node.score / 2
            node.parent.size += node.size
            node.parent.links += node.links
    return [x for x in order if x.size]


def main_text(html: str | None) -> str:
    """The main text of a page, a line per block; empty if there is none.

    Each paragraph gives points for its length and commas, discounted by its share of link text, to
    the elements around it, less with distance. The element with most points, by its own link share
    and what its names say, is the container; its siblings join if they score enough or are prose.
    """
    if not html:
        return ""
    root = tree(html)
    _spare(root)
    _drop_headers(root)
    found = blocks(root)
    order = _score(root, found)
    if not order:
        return ""

    def density(node: Node) -> float:
        return node.links / node.size if node.size else 0.0

    def value(node: Node) -> float:
        bonus = 1.5 if node.tag in ("article", "main") else 0.3 if node.tag in LISTS or node.tag in HEADINGS or node.tag in ("p", "li") else 1.0
        return (node.score + (node.weight if node.score > 0 else 0)) * (1 - density(node)) * bonus

    best = max(order, key=value)
    if value(best) <= 0:
        best = next((n for n in order if n.tag in ("article", "main")), root)
    # One with about as much text of its own around it is a step within the text.
    while best.parent is not None and best.tag not in ("article", "main") and best.parent.own >= 0.4 * best.score > 0:
        best = best.parent
    # An article or main part around the best element is the whole of it.
    up, whole = best, best
    while up is not None:
        if up.tag in ("article", "main") and (up.tag == "article" or whole.tag != "article"):
            whole = up
        up = up.parent
    best = whole
    # A part of a container is not the container.
    while best.parent is not None and (best.tag in PARTS or best.tag not in BLOCKS):
        best = best.parent
    kept = [best]
    if best.parent is not None and best.tag != "main":
        # Beside an article a sibling has to be one as well; parts of a container are judged by their text, names apart.
        least = 0.2 * (value(best) if best.tag == "article" else best.score * (1 - density(best)))
        kept = []
        for child in best.parent.children:
            if child is best:
                kept.append(child)
            elif isinstance(child, Node) and not child.dropped and child.size:
                prose = child.tag == "p" and density(child) < 0.25 and (child.size > 80 or density(child) == 0 and best.tag != "article")
                alike = value(child) >= max(10.0, least) if best.tag == "article" else child.score * (1 - density(child)) >= least and density(child) < 0.25
                if alike or prose or (child.tag in HEADINGS and best.tag not in ("article", "main") and density(child) < 0.25):
                    kept.append(child)
    return "\n".join(text for part in kept for _, text, _ in blocks(part))


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``page_id``, the kept columns, ``text`` and ``n_chars`` for every page.

    Whole pages are read, whatever their length. A null or empty page, and one without main text,
    has an empty text. Repeated rows and null ids stay; other columns of the input don't matter; no
    rows give no rows.
    """
    schema = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_column, *keep)), "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array((main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), made], [id_column, *keep, "text"])

    rows = pages.select(id_column, *keep, F.col(html_column).cast("string").alias("__html"))
    return rows.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
