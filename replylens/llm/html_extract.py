"""Main text of a web page by tree scoring.

A small tolerant reader builds the tree (implied ends of paragraphs, list items
and table cells; void elements; raw script and style text; a page cut off at any
place). Blocks that are not the article's text by kind or by name (menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments)
are left out. A name is read word by word: a word that tells a state ("no-sidebar",
"comments-open") says nothing, and a word of an article's name ("content", "post")
speaks for the element. An element with an unlikely name, or a form, that holds most
of the unlinked text around it stays (readers' comments and cookie notices do not),
and when nothing is left the names are not used at all. Every block of text passes points to its ancestors: one, plus one
a comma, plus up to three for length; the parent gets all, the grandparent half,
further ancestors less (up to 64 of them). A container's points are discounted by the share of its
text inside links. The best container is kept, widened to the article or main
element around it; without one, to its parent and to the elements further out as
long as others in them hold prose too. On that way everything beside it stays, bare
text as well, except what is mostly links and, directly in the body, what is neither
prose nor a kind of text.

Text of a block has white space folded and references decoded; blocks are
joined in page order by one space. No text is capped; the work grows with the length of
the page, however deep its elements lie in each other.

Defined cases: null, empty and text-free pages give the empty string; a page
without any block element is one block; repeated rows are extracted as rows;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# One token: comment, CDATA or declaration, or a tag. Possessive, so no input makes it backtrack.
TOKEN = re.compile(r"<!--(?:(?!--!?>).)*+(?:--!?>)?|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>?", re.S)
CLASS = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html li td th tr tbody thead tfoot dd dt".split()) | {"table"}
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form iframe object embed button select textarea input svg math "
    "canvas audio video dialog menu noembed noframes xmp".split())
SOFT = frozenset(["form"])       # left out by kind, unless it holds the page
# A start tag of the key ends an open element of the values, unless one of the walls stands between.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
WALLS = frozenset("ul ol dl table select article body div section".split())
P_WALLS = WALLS | {"td", "th", "li"}
LEVELS = 64                      # ancestors a block passes points to; further ones would get less than 1 / 189

UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|comments?|commentlist|respond|repl(?:y|ies)|disqus|cookies?\w*|"
    r"consent|gdpr|notices?|alerts?|popups?|modals?|overlay|newsletter|subscri\w+|signup|sign-up|login|sidebar\w*|side|aside|widget\w*|menu\w*|nav|"
    r"navbar|navigation|topbar|breadcrumbs?|pagination|pager|footer\w*|foot|masthead|header|share\w*|sharing|social|related|"
    r"recommend\w*|more-stories|trending|toolbar|skip-link|disclaimer|copyright|search|complementary|contentinfo)(?=$|[\s_-])", re.I)
READERS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|respond|responses?|repl(?:y|ies)|disqus|related|recommend\w*|teasers?|promo|"
                     r"sponsor\w*)(?=$|[\s_-])", re.I)
# Words that tell how the page looks or works, not what the element is.
STATE = re.compile(r"^(?:has|no|with|without)[_-]|[_-](?:open|opened|closed|enabled|disabled)$", re.I)
OWN_HEADER = re.compile(r"(?:^|[_-])(?:article\w*|post|entry|story)(?=$|[\s_-])", re.I)
HEADER = re.compile(r"(?<![^_-])header(?![^_-])", re.I)
NEVER = re.compile(r"(?:^|[\s_-])(?:cookies?\w*|consent|gdpr)(?=$|[\s_-])", re.I)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article\w*|content|main|post|entry|story|body|text|blog)(?=$|[\s_-])", re.I)
ARTICLE_NAME = re.compile(r"(?:^|\s)(?:article|post|entry|story|content|main)(?=$|\s)", re.I)
TEXT_KINDS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table section figure details".split())
PRIOR = {"article": 25.0, "main": 25.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0,
         "ol": -3.0, "ul": -3.0, "dl": -3.0, "li": -3.0, "address": -3.0, "th": -5.0}


class Node:
    """``depth``: elements above it; ``scope``: the nearest article or main element, itself included; ``within``: it or one
    above it is an article by kind or name (None: not looked at yet); ``held``: an article below it has spoken for it."""
    __slots__ = ("tag", "parent", "kids", "dropped", "name", "points", "chars", "linked", "depth", "scope", "within", "held", "prose")

    def __init__(self, tag, parent, name=""):
        self.tag, self.parent, self.kids, self.name = tag, parent, [], name
        self.dropped, self.points, self.chars, self.linked = False, 0.0, 0, 0
        self.depth = parent.depth + 1 if parent is not None else 0
        self.scope = self if tag in ("article", "main") else parent.scope if parent is not None else None
        self.within, self.held, self.prose = None, False, 0


class Open:
    """The open elements, by tag, so that no search walks up the tree."""

    def __init__(self, root: Node):
        self.here, self.by_tag = root, {}

    def push(self, node: Node) -> None:
        self.here = node
        self.by_tag.setdefault(node.tag, []).append(node)

    def nearest(self, tag: str, walls=frozenset()):
        """The nearest open element of that tag, or None when a wall comes first."""
        found = self.by_tag.get(tag)
        if not found:
            return None
        depth = found[-1].depth
        return None if any(w[-1].depth > depth for t in walls if (w := self.by_tag.get(t))) else found[-1]

    def close(self, node: Node) -> None:
        """Ends the element and all that are open in it."""
        while self.here is not node.parent:
            self.by_tag[self.here.tag].pop()
            self.here = self.here.parent


def _names(attrs: str) -> tuple[str, str]:
    found = {}
    for k, a, b, c in CLASS.findall(attrs):
        found.setdefault(k.lower(), a or b or c)
    return " ".join(found.values()), found.get("role", "")


def parse(page: str) -> tuple[Node, list[Node], list[Node]]:
    """The tree of a page, all its elements in page order, and those left out by name (or as a form); kids are nodes
    and strings (already decoded)."""
    root, suspects = Node("#root", None), []
    nodes, tree, at, n = [root], Open(root), 0, len(page)
    lower = None
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            tree.here.kids.append(entities.unescape(page[at:]))
            break
        m = TOKEN.match(page, lt)
        if m is None:                                   # a bare "<" is text
            tree.here.kids.append(entities.unescape(page[at:lt + 1]))
            at = lt + 1
            continue
        if lt > at:
            tree.here.kids.append(entities.unescape(page[at:lt]))
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if (up := tree.nearest(tag)) is not None:
                tree.close(up)
            continue
        if (tag in CLOSES_P or tag == "p") and (up := tree.nearest("p", P_WALLS)) is not None:
            tree.close(up)
        for other in ENDS.get(tag, ()):
            if (up := tree.nearest(other, WALLS)) is not None:
                tree.close(up)
        attrs = m.group(3)
        name, role = _names(attrs) if "=" in attrs else ("", "")
        node = Node(tag, tree.here, name)
        node.dropped = tag in DROPPED or _boiler(node, role)
        tree.here.kids.append(node)
        nodes.append(node)
        if node.dropped and (tag in SOFT or tag not in DROPPED):
            suspects.append(node)
        if tag in ("article", "main") and not node.dropped:
            _holds_article(node)
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == n else page
            end = lower.find(f"</{tag}", at)
            if tag == "textarea" or tag == "title":
                node.kids.append(entities.unescape(page[at:end if end >= 0 else n]))
            if end < 0:
                break
            close = page.find(">", end)
            at = n if close < 0 else close + 1
        elif tag not in VOID and not attrs.endswith("/") or tag in BLOCK and tag not in VOID:
            tree.push(node)
    return root, nodes, suspects


def _boiler(node: Node, role: str) -> bool:
    """Left out by name or role; the page's header element, but not an article's own."""
    if node.tag in ("html", "body"):
        return False
    if node.tag == "header":
        return not _in_article(node)
    if not node.name or not UNLIKELY.search(node.name) and not READERS.search(node.name):
        return False
    words = [w for w in node.name.split() if not STATE.search(w)]
    first = [w for w in words if (m := READERS.search(w)) and m.start() == 0]
    likely = any(LIKELY.search(w) and not UNLIKELY.search(w) and not READERS.search(w) for w in words)
    if likely and not first:
        return False
    if node.tag in ("article", "main") or role == "main":
        return any(READERS.search(w) for w in words)
    # "article-header", or any header inside an article, is the article's own.
    bad = [w for w in words if UNLIKELY.search(HEADER.sub("", w) if OWN_HEADER.search(w) or HEADER.search(w) and _in_article(node) else w)]
    return bool(bad)


def _speaks(node: Node) -> bool:
    """An article or main element, or one with an article's name."""
    return node.tag in ("article", "main") or bool(node.name) and node.tag not in ("html", "body") and any(
        OWN_HEADER.search(w) and not UNLIKELY.search(w) for w in node.name.split() if not STATE.search(w))


def _in_article(node: Node) -> bool:
    """Inside an element that speaks for an article. What is found is kept, so an element is looked at once."""
    new, up = [], node.parent
    while up is not None and up.within is None:
        new.append(up)
        up = up.parent
    known = up is not None and up.within
    for up in reversed(new):
        up.within = known = known or _speaks(up)
    return known


def _holds_article(node: Node) -> None:
    """An article inside an element of an unlikely name (a layout with a sidebar, say) or inside a form speaks for
    that element, unless it is about readers' comments or other articles."""
    up = node.parent
    while up is not None and not up.held:
        up.held = True
        if up.dropped and (up.tag in SOFT or up.tag not in DROPPED) and not READERS.search(up.name):
            up.dropped = False
        up = up.parent


def _may_stay(node: Node) -> bool:
    """Whether an element left out by name can stay for the text it holds."""
    return node.tag in SOFT or node.tag not in DROPPED and not READERS.search(node.name) and not NEVER.search(node.name)


def _count_prose(nodes: list[Node]) -> None:
    """Unlinked characters of every subtree, with the elements whose names do not settle the case; children first."""
    for node in reversed(nodes):
        node.prose = sum(len(" ".join(k.split())) if isinstance(k, str) else 0 if k.tag == "a" or k.dropped and not _may_stay(k) else k.prose
                         for k in node.kids)


def _keep_prose(nodes: list[Node], suspects: list[Node], blocks) -> bool:
    """Take back in the elements that hold most of the unlinked text around them: of the article or main element they
    are in, or of a page whose article and main elements (if any) hold no text. True if any was."""
    marked = any(linked < len(text) and block.scope is not None for block, text, linked in blocks)
    _count_prose(nodes)
    clear, changed = {}, False                            # whether nothing at or above an element is left out
    for node in suspects:                                 # in page order, so those above a suspect are settled
        if not node.dropped or not _may_stay(node):
            continue
        new, up = [], node.parent
        while up is not None and id(up) not in clear:
            new.append(up)
            up = up.parent
        free = up is None or clear[id(up)]
        for up in reversed(new):
            free = clear[id(up)] = free and not up.dropped
        inner = node.parent.scope
        if not free or marked and inner is None:          # inside another one that is left out, or beside the article
            continue
        if 2 * node.prose > (inner or nodes[0]).prose:
            node.dropped, changed = False, True
    return changed


def _blocks(node: Node):
    """(block element, text, linked characters) of a subtree in page order; white space folded, empty blocks left out."""
    out, parts, linked, stack = [], [], 0, [(node, iter(node.kids), node)]
    owner = node

    def flush():
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((owner, text, min(linked, len(text))))
        parts, linked = [], 0

    depth_a = 0
    while stack:
        here, kids, block = stack[-1]
        kid = next(kids, None)
        if kid is None:
            stack.pop()
            if here.tag in BLOCK:
                flush()
            if here.tag == "a":
                depth_a -= 1
            owner = stack[-1][2] if stack else node
            continue
        if isinstance(kid, str):
            parts.append(kid)
            if depth_a:
                linked += len(" ".join(kid.split()))
        elif kid.dropped:
            if kid.tag in BLOCK:
                flush()
        elif kid.tag == "br":
            parts.append(" ")
        elif kid.tag in VOID:
            if kid.tag == "hr":
                flush()
        else:
            if kid.tag in BLOCK:
                flush()
                owner = kid
            if kid.tag == "a":
                depth_a += 1
            stack.append((kid, iter(kid.kids), kid if kid.tag in BLOCK else block))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The page's main text ('' if none)."""
    if not page or not page.strip():
        return ""
    root, nodes, suspects = parse(page)
    blocks = _blocks(root)
    if suspects and _keep_prose(nodes, suspects, blocks):
        blocks = _blocks(root)
    if not blocks:
        for node in suspects:
            node.dropped = False
        blocks = _blocks(root)
    if not blocks:
        return ""
    for block, text, linked in blocks:
        # A block that is mostly links is a list of links, not prose.
        points = (1.0 + text.count(",") + min(len(text) / 100.0, 3.0)) * (1.0 - linked / len(text))
        up = block if block.tag not in ("p", "pre", "li", "td", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6") else block.parent
        up.chars += len(text)
        up.linked += linked
        for level in range(1, LEVELS + 1):
            up.points += points / (1 if level == 1 else 2 if level == 2 else 3 * (level - 1))
            up = up.parent
            if up is None:
                break
    scored = {}
    for node in reversed(nodes):                          # children first: the lengths of whole subtrees
        if node.chars:
            node.points += PRIOR.get(node.tag, 0.0) + (25.0 if node.name and LIKELY.search(node.name) else 0.0)
            node.points *= 1.0 - node.linked / node.chars
            scored[id(node)] = node
            if node.parent is not None:
                node.parent.chars += node.chars
                node.parent.linked += node.linked
    best = max(scored.values(), key=lambda x: (x.points, x.chars, x.depth))
    top, up = best, best
    while up is not None:
        if up.tag in ("article", "main"):
            top = up
        up = up.parent
    if top.tag not in ("article", "main"):
        top = _widen(best, scored)
    return " ".join(text for _, text, _ in _blocks(top))


def _widen(best: Node, scored) -> Node:
    """The element around the best container that holds the whole article; what does not belong to it inside that
    element is marked as dropped."""
    top, node = best, best
    while node.parent is not None:
        up = node.parent
        units = _units(up, node)
        whole = ARTICLE_NAME.search(node.name) and not any(isinstance(k, Node) and k is not node and k.name == node.name for k in up.kids)
        if whole and node is not best:
            break
        judged = [(True, 0) if u[0] is node else _judge(u, best, scored) for u in units]
        keep = [ok for ok, _ in judged]
        if up.tag in ("#root", "html", "body"):
            sure = [ok and (u[0] is node or longest >= 40 or isinstance(u[0], Node) and u[0].tag in TEXT_KINDS) for u, (ok, longest) in zip(units, judged)]
            first, last = sure.index(True), len(sure) - 1 - sure[::-1].index(True)
            # Bare words between two kept parts belong to them.
            keep = [yes or ok and first < k < last and not (isinstance(u[0], Node) and u[0].tag in BLOCK)
                    for k, (u, yes, ok) in enumerate(zip(units, sure, keep))]
        if node is best or any(yes and longest >= 80 for yes, (_, longest) in zip(keep, judged)):
            top = up
        up.kids = []
        for unit, yes in zip(units, keep):
            if not yes:
                out = Node("div" if isinstance(unit[0], Node) and unit[0].tag in BLOCK else "span", up)
                out.kids, out.dropped = unit, True
                unit = [out]
            up.kids += unit
        if whole:
            break
        node = up
    return top


def _units(up: Node, node: Node) -> list[list]:
    """The kids of an element as blocks (and ``node``) of their own and runs of bare text with the inline elements in it."""
    units, open_run = [], False
    for kid in up.kids:
        alone = kid is node or isinstance(kid, Node) and kid.tag in BLOCK
        if alone or not open_run:
            units.append([])
        units[-1].append(kid)
        open_run = not alone
    return units


def _judge(unit: list, best: Node, scored) -> tuple[bool, int]:
    """Whether a neighbour of the best container is text rather than links, and its longest block of unlinked text."""
    if isinstance(unit[0], Node) and unit[0].dropped and len(unit) == 1:
        return True, 0
    holder = Node("#run", None)
    holder.kids = unit
    got = _blocks(holder)
    chars, linked = sum(len(t) for _, t, _ in got), sum(x for _, _, x in got)
    strong = len(unit) == 1 and id(unit[0]) in scored and unit[0].points >= max(10.0, 0.2 * best.points)
    return strong or 2 * linked < chars or chars == 0, max((len(t) - x for _, t, x in got), default=0)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    def run(batches):
        for b in batches:
            texts = [main_text(p) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
