"""Main text of web pages by composite text density.

A page's tags become a tree; elements that never hold the article (menus, forms, scripts ...) are left out. Every node
has C characters and T tags below it, of which LC characters and LT tags belong to links. Its density is characters per tag, adjusted
for links: ``C/T * log_b(C/LC * T/LT)`` with base ``b = ln(C/(C-LC) * LC + LCb/Cb * C + e)``, b for the body and zero denominators as 1. The
node with the largest sum of child densities is the core of the article; the smallest density on its path to the body is the
threshold that other parts of the body must reach. The innermost article around the core, or else its main element, is taken as a whole but
for articles in it that are named as furniture (comments) and for blocks of three links or more that are mostly links and thinner than the threshold.

Names (class, id) leave elements out, but never an article or main. Outside of articles a part of a name is enough, unless an article or main lies inside;
inside an article a whole class token or id must be such a name, ids of headings say nothing, and a named section goes only if most of it is links.

Defined cases: null, empty or tagless pages (a tagless page is one block); unclosed, misnested and cut-off tags; very deep trees (no recursion);
of equal density sums the first in page order; other columns and repeated rows do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.frames import fields, small_batches

# Element kinds of the HTML standard and names that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "svg", "template", "object", "canvas", "math")
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
CLOSES_P = BLOCKS - {"body", "html", "caption", "legend", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
SAME_KIND = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "option": ({"option"}, {"select"})}
FURNITURE_TAGS = frozenset("nav footer aside form button select dialog menu label input head".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_NAMES = (
    r"(?:ads?|advert\w*|adv|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|"
    r"overlay|subscri\w+|newsletter|paywall|side-?bar|widget|nav\w*|menu|bread-?crumbs?|footer|header|masthead|toolbar|pagination|"
    r"pager|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|respond|replies|reply|discussion|login|signup)")
FURNITURE_NAMES = re.compile(rf"(?:^|[\s_-]){_NAMES}(?:$|[\s_-])")
# A whole class token or id made of such names and of words for boxes; one other word in it (comments-open, related-work) makes it another name.
_BOXES = r"(?:areas?|bar|blocks?|box|buttons?|container|icons?|inner|links?|list|posts?|section|slot|wrap(?:per)?)"
WHOLE_NAME = re.compile(rf"(?:{_BOXES}[_-]+)*{_NAMES}(?:[_-]+(?:{_NAMES}|{_BOXES}))*")
LINK_BLOCKS = frozenset("div section ul ol dl table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:(?>[^>\"']+)|\"[^\"]*\"|'[^']*'|[\"'])*?>.*?(?:</(?P=raw)\s*>|\Z)|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:(?>[^>\"']+)|\"[^\"]*\"|'[^']*')*+)>|"
    r"<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
NAMES = re.compile(r"(?<![\w-])(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ROLE = re.compile(r"role\s*=\s*[\"']?([\w-]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
BODY_ITEM = re.compile(r"itemprop\s*=\s*[\"']?articleBody", re.I)


class Node:
    __slots__ = ("tag", "parent", "kids", "skip", "loose", "doubtful", "whole", "named", "within", "chars", "tags", "link_chars", "link_tags", "links", "density", "sum")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.kids = tag, parent, []
        self.skip = self.whole = False
        self.named = False  # an article whose class says that it is furniture, such as a reader's comment
        self.loose = False  # left out for a part of a name only, until an article is found inside
        self.doubtful = False  # a named section of an article, for its links to decide
        self.within = parent is not None and (parent.whole or parent.within)  # of an article
        self.chars = self.tags = self.link_chars = self.link_tags = self.links = 0
        self.density = self.sum = 0.0


def _furniture(tag: str, attrs: str) -> bool:
    """Left out whatever its names are."""
    if tag in FURNITURE_TAGS:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    role = ROLE.search(attrs)
    return bool((role and role[1].lower() in FURNITURE_ROLES) or HIDDEN.search(attrs))


def _mark(node: Node, attrs: str) -> None:
    """Whether an element is left out. No article or main is for its names."""
    tag = node.tag
    never = _furniture(tag, attrs) or (tag == "header" and not node.within)
    node.skip = node.parent.skip or never
    node.loose = node.parent.loose and not never
    if node.skip and not node.loose or not attrs or tag in ("html", "body", "article", "main"):
        return
    names = [(kind.lower(), (a or b or c).lower()) for kind, a, b, c in NAMES.findall(attrs)]
    if node.within:
        names = [(kind, token) for kind, value in names for token in value.split()]
        if tag == "section" or ("class", "section") in names:
            node.doubtful = any(WHOLE_NAME.fullmatch(token) for _, token in names)
        elif any(WHOLE_NAME.fullmatch(token) for kind, token in names if kind == "class" or tag not in HEADINGS):
            node.skip, node.loose = True, False
    elif any(FURNITURE_NAMES.search(value) for _, value in names):
        whole = any(WHOLE_NAME.fullmatch(token) for _, value in names for token in value.split())
        node.loose = not whole and (not node.skip or node.loose)
        node.skip = True


def _open(node: Node) -> None:
    """An article or main in elements that are left out for a part of a name: these are page layout."""
    up = node
    while up is not None and up.loose:
        up.skip = up.loose = False
        up = up.parent


def parse(page: str) -> list[Node]:
    """Nodes in page order; the first is the root. Texts stay encoded, as strings among ``kids``."""
    root = Node("html", None)
    nodes, here, at = [root], root, 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            here.kids.append(page[at:m.start()])
        at = m.end()
        if m["raw"]:
            continue
        tag = (m["name"] or m["name2"] or "").lower()
        if not tag:
            continue
        if m["close"] or m["close2"]:
            up = here
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                here = up.parent
            continue
        if tag in CLOSES_P:
            here = _left(here, {"p"}, {"table", "td", "th", "article", "section", "div", "body", "li", "button"})
        if tag in SAME_KIND:
            here = _left(here, *SAME_KIND[tag])
        node = Node(tag, here)
        attrs = m["attrs"] or m["attrs2"] or ""
        node.whole = tag in ("article", "main") or (bool(attrs) and bool(BODY_ITEM.search(attrs)))
        if tag == "article" and attrs:
            node.named = any(WHOLE_NAME.fullmatch(token.lower()) for kind, a, b, c in NAMES.findall(attrs) if kind.lower() == "class"
                             for token in (a or b or c).split())
        _mark(node, attrs)
        if node.loose and tag in ("article", "main"):
            _open(node)
        here.kids.append(node)
        nodes.append(node)
        if tag not in VOID and not attrs.endswith("/"):
            here = node
    if at < len(page):
        here.kids.append(page[at:])
    return nodes


def _left(here: Node, kinds: set[str], stops: set[str]) -> Node:
    """Where a new element goes that ends an open element of ``kinds`` within the nearest of ``stops``."""
    up = here
    while up is not None and up.tag not in stops:
        if up.tag in kinds:
            return up.parent
        up = up.parent
    return here


def plain(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def measure(nodes: list[Node]) -> Node:
    """Fill counts and densities bottom-up; returns the body."""
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    for node in reversed(nodes):
        if node.skip:
            continue
        for kid in node.kids:
            if isinstance(kid, str):
                node.chars += len(plain(kid))
            elif not kid.skip:
                node.chars += kid.chars
                node.tags += kid.tags + 1
                node.link_chars += kid.link_chars
                node.link_tags += kid.link_tags + (kid.tag == "a")
                node.links += kid.links + (kid.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        node.skip = node.doubtful and 2 * node.link_chars > node.chars
    for node in nodes:
        node.skip = node.skip or (node.parent is not None and node.parent.skip)
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, lc, t, lt = node.chars, node.link_chars, max(node.tags, 1), max(node.link_tags, 1)
        if node.skip or not c:
            continue
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        adjusted = c / max(lc, 1) * t / lt
        # With hardly any links the base is near 1: the logarithm would exceed all measure.
        node.density = c / t * math.log(max(adjusted, 1.0)) / max(math.log(base), 1.0)
    for node in reversed(nodes):
        if not node.skip and node.parent is not None and not node.parent.skip:
            node.parent.sum += node.density
    return body


def _article(path: list[Node], nodes: list[Node]) -> Node | None:
    """The article around the core, whose path to the root is given.

    Innermost article first, one with a furniture name only if there is no other; then main or the marked body. Where the core lies between the articles of
    such an element, the one with more than half of its characters is meant; with no such article it is a list, and stays whole.
    """
    wholes = [n for n in path if n.whole]
    found = next((n for n in wholes if n.tag == "article" and not n.named), next((n for n in wholes if not n.named), wholes[-1] if wholes else None))
    if found is not None and found.tag != "article":
        below = {found}
        for node in nodes:
            if node.parent in below and not node.skip:
                if node.tag == "article" and not node.named and 2 * node.chars > found.chars:
                    return node
                below.add(node)
    return found


def _leave_out(nodes: list[Node], article: Node, path: list[Node], threshold: float) -> None:
    """Leave out of an article what is another one with a furniture name, and blocks of links thinner than the path of the core."""
    inside, above = {article}, set(path)
    for node in nodes:
        if node.parent in inside and not node.skip:
            menu = (node.tag in LINK_BLOCKS and node not in above and 2 * node.link_chars > node.chars and node.links >= 3
                    and node.density < threshold)
            node.skip = node.named or menu
            inside.add(node)
        elif node.parent in inside:
            inside.add(node)
    for node in nodes:
        node.skip = node.skip or (node.parent is not None and node.parent.skip)


def _blocks(top: Node, chosen: set[Node] | None) -> list[str]:
    """Texts of the blocks below ``top`` in page order; with ``chosen``, only what lies in those subtrees."""
    out: list[str] = []
    run: list[str] = []

    def close():
        text = plain("".join(run))
        if text:
            out.append(text)
        run.clear()

    stack: list = [(top, chosen is None, False)]
    while stack:
        item, wanted, leaving = stack.pop()
        if isinstance(item, str):
            if wanted:
                run.append(item)
            continue
        if item.skip:
            continue
        if item.tag == "br":
            run.append("\n")
            continue
        wanted = wanted or item in chosen
        if item.tag in BLOCKS:
            close()
        if leaving:
            continue
        stack.append((item, wanted, True))
        stack.extend((kid, wanted, False) for kid in reversed(item.kids))
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes = parse(page)
    body = measure(nodes)
    core = max((n for n in nodes if not n.skip), key=lambda n: n.sum, default=body)
    path = []
    up = core
    while up is not None:
        path.append(up)
        up = up.parent
    threshold = min(n.density for n in path)
    around = _article(path, nodes)
    if around is not None:
        _leave_out(nodes, around, path, threshold)
        return "\n\n".join(_blocks(around, None))
    if core.sum <= 0:
        return "\n\n".join(_blocks(body, None))
    above = set(path)
    # Other parts count where they are as dense as the thinnest node between the core and the body.
    chosen = {core} | {n for n in nodes if not n.skip and n not in above and n.tag in BLOCKS and n.density >= threshold}
    return "\n\n".join(_blocks(body, chosen))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, the main text and its length in code points, one row per page."""
    chosen = pages.select(*keep, "html")

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*keep, "text", "n_chars"])

    return small_batches(chosen).mapInArrow(run, fields(chosen, keep, "text string, n_chars bigint"))
