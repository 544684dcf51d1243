"""Block trees of web pages, and their alignment by simple tree matching.

A tree holds the block elements of a page; the text between two block borders
is one leaf. Markup inside a block (bold, links, line breaks) adds no node.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import xxhash

# Elements without content, elements that form a block, and elements that end an open one of the same kind.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul title noscript template head".split()
)
_ENDS_ITSELF = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
                "th": {"tr", "table"}, "option": {"select"}}
_PARAGRAPH, _PARAGRAPH_BORDERS = {"p"}, {"table", "td", "th", "button"}
_SAME = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}

# Elements, roles and words of class or id names that are no article text.
_OUT_TAGS = set(
    "nav footer aside form script style noscript template iframe object svg canvas audio video button select textarea title "
    "dialog menu fieldset label option datalist head".split()
)
_OUT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
_OUT_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promotion "
    "cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar aside footer masthead topbar comment comments disqus respond replies related share "
    "sharing social login banner".split()
)
_HEADER = "header"
_NOT_OWN = {"has", "with", "no", "without", "is"}
_REGION = {"article", "main"}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Deeper elements are flattened into the one at this depth, as browsers do at some depth.
DEPTH = 100
# An element with so many links that make up most of its text is a menu.
MENU_LINKS = 3
MENU_SHARE = 0.8


@dataclass(slots=True, eq=False)
class Node:
    """A block element, or a leaf of text (tag ``#``)."""

    tag: str
    mark: str
    out: bool = False
    region: bool = False
    kids: list["Node"] = field(default_factory=list)
    text: str = ""
    hash: int = 0
    links: int = 0
    link_chars: int = 0


def _named_out(words: str, inside: bool) -> bool:
    """Whether a class or id says so; ``has-sidebar`` and ``content-with-comments`` speak of something else."""
    for name in words.split():
        before = ""
        for part in re.findall("[a-z]+", name):
            if before not in _NOT_OWN and (part in _OUT_WORDS or (part == _HEADER and not inside)):
                return True
            before = part
    return False


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", "#root")
        # Open blocks, and for each its open inline elements: tag and whether their text is left out.
        self.blocks = [self.root]
        self.inline: list[list[tuple[str, bool]]] = [[]]
        self.pieces: list[str] = []
        self.links = self.link_chars = 0

    def _flush(self) -> None:
        """The text since the last border becomes a leaf."""
        if not self.pieces:
            self.links = self.link_chars = 0
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            self.blocks[-1].kids.append(
                Node("#", "#", text=text, hash=xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1,
                     links=self.links, link_chars=min(self.link_chars, len(text)))
            )
        self.pieces, self.links, self.link_chars = [], 0, 0

    def _is_out(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in _OUT_TAGS:
            return True
        if tag != _HEADER and not attrs:
            return False
        inside = any(n.region for n in self.blocks)
        if tag == _HEADER and not inside:
            return True
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
            return tag not in ("html", "body")
        if tag in ("html", "body", "main"):
            return False
        words = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
        return attrs.get("role", "").lower() in _OUT_ROLES or _named_out(words, inside)

    def _close_to(self, index: int) -> None:
        self._flush()
        del self.blocks[index:]
        del self.inline[index:]

    def _find(self, tags: set[str], borders: set[str]) -> int | None:
        for i in range(len(self.blocks) - 1, 0, -1):
            if self.blocks[i].tag in tags:
                return i
            if self.blocks[i].tag in borders:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.pieces.append(" ")
            return
        values = {name: value or "" for name, value in attrs}
        if tag not in _BLOCKS:
            if tag == "a":
                self.inline[-1] = [x for x in self.inline[-1] if x[0] != "a"]
                self.links += 1
            if tag not in _VOID:
                self.inline[-1].append((tag, self._is_out(tag, values)))
            return
        if tag == "html" or (tag == "body" and any(n.tag == "body" for n in self.blocks)):
            return
        paragraph = self._find(_PARAGRAPH, _PARAGRAPH_BORDERS)
        if paragraph is not None and tag != "option":
            self._close_to(paragraph)
        while self.blocks[-1].tag in ("title", "head") and tag not in ("title", "noscript", "template"):
            # Left open by mistake: they end where the page begins.
            self._close_to(len(self.blocks) - 1)
        if tag in _ENDS_ITSELF:
            found = self._find(_SAME.get(tag, {tag}), _ENDS_ITSELF[tag])
            if found is not None:
                self._close_to(found)
        self._flush()
        if tag in _VOID:
            return
        mark = tag
        if "class" in values or "id" in values:
            names = f"{values.get('class', '')} {values.get('id', '')}".lower().split()
            mark = " ".join([tag, *sorted({re.sub("[0-9]+", "", name) for name in names})])
        out = self._left_out() or self._is_out(tag, values)
        node = Node(tag, mark, out, region=not out and (tag in _REGION or values.get("role") in _REGION))
        self.blocks[-1].kids.append(node)
        if len(self.blocks) < DEPTH:
            self.blocks.append(node)
            # A link may hold blocks.
            self.inline.append([x for x in self.inline[-1] if x[0] == "a"])

    def _left_out(self) -> bool:
        return self.blocks[-1].out or any(out for _, out in self.inline[-1])

    def handle_startendtag(self, tag, attrs):
        # The slash means nothing in HTML, but for elements of foreign kinds.
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path", "iframe", "script", "object", "canvas"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _BLOCKS:
            if tag in ("html", "body"):
                return
            for i in range(len(self.blocks) - 1, 0, -1):
                if self.blocks[i].tag == tag:
                    self._close_to(i)
                    return
            return
        inline = self.inline[-1]
        for i in range(len(inline) - 1, -1, -1):
            if inline[i][0] == tag:
                del inline[i:]
                return

    def handle_data(self, data):
        if self._left_out():
            return
        self.pieces.append(data)
        if any(tag == "a" for tag, _ in self.inline[-1]):
            self.link_chars += len(" ".join(data.split()))

    def updatepos(self, i, j):
        """Line numbers are of no use here."""
        return j

    def unknown_decl(self, data):
        """Marked sections are markup."""


def parse(html: str | None) -> Node:
    """Block tree of a page; text that is none of the article's (scripts, menus, forms) is left out."""
    builder = _Builder()
    # No parser accepts a null character or half of a surrogate pair in its input.
    builder.feed((html or "").replace("\0", "�"))
    builder.close()
    builder._flush()
    return builder.root


def leaves(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        top = stack.pop()
        if top.tag == "#":
            yield top
        stack.extend(reversed(top.kids))


def _drop_menus(node: Node) -> tuple[int, int, int]:
    """Marks menus outside the article as out; returns links, their characters and all characters below."""
    if node.tag == "#":
        return node.links, node.link_chars, len(node.text)
    if node.out or node.region:
        return 0, 0, 0
    sums = [_drop_menus(kid) for kid in node.kids]
    links, linked, total = (sum(s[i] for s in sums) for i in range(3))
    if node.tag not in ("#root", "body") and links >= MENU_LINKS and linked >= MENU_SHARE * total:
        node.out = True
        return 0, 0, 0
    return links, linked, total


def content_leaves(root: Node) -> list[Node]:
    """Leaves that can be content, in page order: those of the article elements if there are any, else of the whole page."""
    _drop_menus(root)
    regions, stack = [], [root]
    while stack:
        top = stack.pop()
        if top.out:
            continue
        if top.region:
            regions.append(top)
        else:
            stack.extend(reversed(top.kids))
    found = [leaf for region in regions for leaf in _inside(region)]
    return found or list(_inside(root))


def _inside(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        top = stack.pop()
        if top.out:
            continue
        if top.tag == "#":
            yield top
        stack.extend(reversed(top.kids))


def layout(node: Node) -> str:
    """Digest of the tree without text, repeated siblings taken once: pages of one layout share it."""

    def shape(n: Node) -> str:
        kids: list[str] = []
        for kid in n.kids:
            inner = "" if kid.out else shape(kid)
            if not kids or kids[-1] != inner or kid.out:
                kids.append(inner or kid.mark)
        return f"{n.mark}({','.join(kids)})"

    return xxhash.xxh128_hexdigest(shape(node).encode("utf-8", "replace"))


def packed(node: Node) -> list:
    """The tree as nested lists: mark, hash of a leaf's text, kids. Kids of what is left out are not kept."""
    kids = [] if node.out else node.kids
    return [node.mark, node.hash, [packed(kid) for kid in kids]]


def unpacked(tree: list) -> Node:
    mark, value, kids = tree
    return Node(mark.split(" ")[0], mark, kids=[unpacked(kid) for kid in kids], hash=value)


def size(node: Node) -> int:
    return 1 + sum(size(kid) for kid in node.kids)


def align(template: Node, page: Node) -> dict[int, Node]:
    """Simple tree matching: the nodes of ``page`` that meet a node of ``template``, by its place in preorder.

    Nodes match if their marks are equal, order is kept, and the matching with
    the most nodes wins; leaves of equal text count twice, so that constant
    text meets its like.
    """
    memo: dict[tuple[int, int], tuple[int, list[tuple[Node, Node]]]] = {}
    signs: dict[int, bytes] = {}

    def match(a: Node, b: Node) -> int:
        if a.mark != b.mark:
            return 0
        if a.tag == "#":
            return 1 + (a.hash == b.hash)
        if not a.kids or not b.kids or b.out:
            return 1
        key = (id(a), id(b))
        if key not in memo:
            left, right = a.kids, b.kids
            if _sign(a, signs) == _sign(b, signs):
                # Equal trees: only matching every node with its twin reaches the greatest sum.
                memo[key] = sum(match(x, y) for x, y in zip(left, right)), list(zip(left, right))
            else:
                marks: dict[str, list[int]] = {}
                for j, y in enumerate(right):
                    marks.setdefault(y.mark, []).append(j)

                def weights(x: Node) -> np.ndarray:
                    row = np.zeros(len(right), dtype=np.int64)
                    for j in marks.get(x.mark, ()):
                        row[j] = match(x, right[j])
                    return row

                memo[key] = _best_order(weights, left, right)
        return 1 + memo[key][0]

    found: dict[int, Node] = {}
    places: dict[int, int] = {}

    def number(node: Node) -> None:
        places[id(node)] = len(places)
        for kid in node.kids:
            number(kid)

    number(template)
    if match(template, page):
        stack = [(template, page)]
        while stack:
            a, b = stack.pop()
            found[places[id(a)]] = b
            if (id(a), id(b)) in memo:
                stack.extend(memo[id(a), id(b)][1])
    return found


def _best_order(weights, left: list[Node], right: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
    """Greatest sum of weights of pairs that keep both orders, and the pairs.

    ``weights(x)`` gives the row of ``x`` against all of ``right``. Rows are summed one at a time;
    a byte per pair keeps the way back, so memory grows by one byte, not sixteen, a pair.
    """
    if len(left) == 1:
        row = weights(left[0])
        j = int(row.argmax())
        return int(row[j]), [(left[0], right[j])] if row[j] else []
    # Way back from a cell: 0 its row is skipped, 1 its column is skipped, 2 its pair is taken.
    back = np.zeros((len(left) + 1, len(right) + 1), dtype=np.uint8)
    last = np.zeros(len(right) + 1, dtype=np.int64)
    for i, x in enumerate(left, 1):
        row = weights(x)
        best = np.zeros_like(last)
        taken = np.where(row > 0, last[:-1] + row, 0)
        best[1:] = np.maximum.accumulate(np.maximum(last[1:], taken))
        back[i, 1:] = np.where(best[1:] == last[1:], 0, np.where(best[1:] == best[:-1], 1, 2))
        last = best
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if back[i, j] == 0:
            i -= 1
        elif back[i, j] == 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((left[i], right[j]))
    return int(last[-1]), pairs


def _sign(node: Node, signs: dict[int, bytes]) -> bytes:
    """Digest of all that an alignment sees of a tree: marks, texts of leaves, kids of what is not left out."""
    stack, order = [node], []
    while stack:
        top = stack.pop()
        if id(top) in signs:
            continue
        order.append(top)
        if not top.out:
            stack.extend(top.kids)
    for n in reversed(order):
        digest = xxhash.xxh3_128(n.mark.encode("utf-8", "replace"))
        digest.update(n.hash.to_bytes(8, "little", signed=True) if n.tag == "#" else b"\0" * 8)
        for kid in [] if n.out else n.kids:
            digest.update(signs[id(kid)])
        signs[id(n)] = digest.digest()
    return signs[id(node)]


def text_digest(root: Node) -> int:
    """Digest of all text that is not left out."""
    digest = xxhash.xxh64()
    for leaf in leaves(root):
        digest.update(leaf.hash.to_bytes(8, "little"))
    return digest.intdigest() >> 1
