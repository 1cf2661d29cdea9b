"""Main text of web pages by wrapper induction.

The pages of a host are grouped by layout and aligned, node by node, with one page of their layout by simple tree matching. Text
nodes that hold the same text on most aligned pages are template, the others are slots. The wrapper descends towards the element that
holds most of the slots' prose; what stands beside its way is left out where it is links or a block or two per page. Markup is a
further vote: a page's text is what stands in slots inside its article and outside menus, forms and the like.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh
from riskloom.sources.store import materialise

OTHER = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|"
NAME = r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
TOKEN = re.compile(OTHER + NAME + r"""((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>|""" + NAME + r"([^>]*+)>", re.S)
#: After a quote that never ends: quotes protect nothing, so that no tag is read to the end of the page more than once.
PLAIN = re.compile(OTHER + NAME + r"([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|\Z)""", re.I)

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noscript template svg math select object canvas video audio".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption button option".split()
)
#: A start tag of the key ends an open element of the values, if no element of the last column lies between.
ENDS = {
    **{t: ({"p"}, {"td", "th", "li", "div", "section", "article", "blockquote", "body"}) for t in BLOCKS},
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"form"}),
}

# What marks an element as no part of the article.
OUTSIDE_TAGS = set("nav footer aside form menu dialog search button option head".split())
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
OUTSIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices newsletter "
    "subscribe subscription signup popup modal overlay nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar "
    "comment comments commentlist disqus discussion replies respond related recommended recommendations share sharing social login search pagination pager "
    "toolbar skip copyright banner disclaimer".split()
)
TITLE_WORDS = {"header", "heading"}
# Elements that hold text of an article rather than a part of the page.
PROSE_TAGS = set("# p h1 h2 h3 h4 h5 h6 hgroup blockquote pre figure figcaption table dl dt dd caption details summary".split())
WORDS = re.compile(r"[a-z0-9]+")
DIGITS = re.compile(r"[0-9]+")


@dataclass
class Tree:
    """Block elements and text leaves of a page in document order; a label is the tag with class and id, without digits, or ``#``."""

    labels: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    outside: list[bool] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters of the text that are links

    def add(self, label: str, parent: int, text: str = "", outside: bool = False, linked: int = 0) -> int:
        self.labels.append(label)
        self.parents.append(parent)
        self.texts.append(text)
        self.outside.append(outside)
        self.linked.append(linked)
        return len(self.labels) - 1


def _attributes(raw: str) -> dict[str, str]:
    if not raw or "=" not in raw and "hidden" not in raw.lower():
        return {}
    return {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(raw)}


def _outside(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in OUTSIDE_TAGS or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in OUTSIDE_ROLES:
        return True
    if tag in ("html", "body", "article", "main") and not {"comment", "comments"} & set(WORDS.findall(attributes.get("class", ""))):
        return False
    words = set(WORDS.findall(attributes.get("class", "") + " " + attributes.get("id", "")))
    return bool(words & OUTSIDE_WORDS) or (not in_article and bool(words & TITLE_WORDS) and tag != "h1")


def parse(html: str | None) -> Tree:
    """Blocks and texts of a page: character references decoded, white space single, raw elements and comments left out."""
    tree, html = Tree(), html or ""
    stack: list[tuple[str, int, bool, bool]] = []  # tag, node, outside, inside an article
    buffer: list[str] = []
    skipped: list[str] = []  # inline elements that are outside, such as a span of adverts
    low = None
    link, linked = -1, 0  # depth of the open link, and the length of what the buffer has of links

    def flush() -> None:
        nonlocal linked
        if buffer:
            raw = "".join(buffer)
            text = " ".join(unescape(raw).split())
            buffer.clear()
            if text:
                tree.add("#", stack[-1][1] if stack else -1, text, stack[-1][2] if stack else False, len(text) * linked // len(raw))
        linked = 0

    at, token, last = 0, TOKEN, html.rfind(">")
    while at <= last and (m := token.search(html, at)) is not None:
        if m.start() > at and not skipped:
            buffer.append(html[at : m.start()])
            linked += (m.start() - at) * (link >= 0)
        at = m.end()
        slash, tag, inner = m.group(1, 2, 3)
        if token is TOKEN and tag is None and m[5]:
            slash, tag, inner = m.group(4, 5, 6)
            token = PLAIN
        if not tag:
            continue
        tag = tag.lower()
        closing, block = bool(slash), tag in BLOCKS
        if tag in RAW and not closing:
            if not inner.endswith("/"):
                low = low if low is not None else html.lower() if len(html.lower()) == len(html) else re.sub("[A-Z]+", lambda x: x.group().lower(), html)
                end = low.find(f"</{tag}", at)
                close = html.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(html)
            continue
        if not block:
            if tag == "a":
                link = -1 if closing else len(stack)
            if tag == "br" or tag == "hr":
                buffer.append(" ")
            elif skipped:
                if closing and tag == skipped[-1]:
                    skipped.pop()
                elif not closing and tag == skipped[-1] and tag not in VOID:
                    skipped.append(tag)
            elif not closing and tag not in VOID and ("=" in inner or "hidden" in inner):
                attributes = _attributes(inner)
                if attributes and _outside(tag, attributes, True):
                    skipped.append(tag)
            continue
        skipped.clear()
        flush()
        if closing:
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
                if link > len(stack):
                    link = -1
            continue
        ends, walls = ENDS[tag]
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in walls and stack[depth][0] not in ends:
                break
            if stack[depth][0] in ends:
                del stack[depth:]
                if tag not in ("tr", "td", "th"):
                    break
        parent = stack[-1] if stack else ("", -1, False, False)
        attributes = _attributes(inner)
        outside = parent[2] or _outside(tag, attributes, parent[3])
        label = tag if not attributes else " ".join([tag, DIGITS.sub("", attributes.get("class", "")), DIGITS.sub("", attributes.get("id", ""))]).strip()
        node = tree.add(label, parent[1], "", outside)
        if not inner.endswith("/") or tag in ("p", "div"):
            stack.append((tag, node, outside, parent[3] or (tag in ("article", "main") and not outside)))
    if at < len(html) and not skipped:
        rest = html[at:].split("<!--", 1)[0]
        buffer.append(rest)
        linked += len(rest) * (link >= 0)
    flush()
    return tree


def _children(parents: list[int]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(len(parents) + 1)]  # the last is the list of roots
    for node, parent in enumerate(parents):
        out[parent].append(node)
    return out


def _totals(values: list[int], parents: list[int]) -> list[int]:
    """Sums over subtrees; the last is that of the whole page."""
    out = [*values, 0] if len(values) == len(parents) else list(values)
    for node in range(len(parents) - 1, -1, -1):
        out[parents[node]] += out[node]
    return out


def _shapes(labels: list[str], children: list[list[int]]) -> list[int]:
    """A number per node that equal subtrees share."""
    out = [0] * len(labels)
    for node in range(len(labels) - 1, -1, -1):
        out[node] = hash((labels[node], *(out[c] for c in children[node])))
    return out


#: Child lists with more pairs than this are aligned row by row in little memory. The pairs are those of the plain way.
WIDE = 250_000
#: Rows that are held at a time: of a table at each level of the way back through it, and of weights.
HELD = 16


def _wide(
    a: np.ndarray, b: np.ndarray, shapes_a: np.ndarray, shapes_b: np.ndarray, sizes: np.ndarray, inner: Callable[[int], np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Pairs of positions of the heaviest alignment of two long lists: a pair of equal labels weighs 1 and what is matched below it, one of equal subtrees their size.

    ``inner`` gives what is matched below a position of the first list and every position of the second; without it, that is nothing.
    Of equally heavy alignments it is the one that the whole table leads back to. Few rows of the table are held, those
    between them are made again on the way back.
    """
    known: dict[int, np.ndarray] = {}

    def weights(x: int) -> np.ndarray:
        key = int(shapes_a[x])
        if key not in known:
            if len(known) == HELD:
                del known[next(iter(known))]
            below = (shapes_b == key) * (sizes[x] - 1)
            known[key] = (b == a[x]) * (1 + (below if inner is None else np.maximum(below, inner(x))))
        return known[key]

    def after(x: int, row: np.ndarray) -> np.ndarray:
        out = np.zeros_like(row)
        best = row[:-1] + weights(x)[: len(row) - 1]
        np.maximum(best, row[1:], out=best)
        np.maximum.accumulate(best, out=out[1:])
        return out

    pairs, j, todo = [], len(b), [(0, len(a), np.zeros(len(b) + 1, dtype=np.int64))]
    while todo and j:
        i, end, row = todo.pop()
        row = row[: j + 1]
        if end - i > 1:
            starts = range(i, end, -(-(end - i) // HELD))
            for start, stop in zip(starts, [*starts[1:], end]):
                todo.append((start, stop, row))
                for x in range(start, stop if stop < end else start):
                    row = after(x, row)
        elif end > i:
            below = after(i, row)
            while j and below[j] != row[j]:
                j -= 1
                if below[j + 1] != below[j]:
                    pairs.append((i, j))
                    break
    return pairs[::-1]


def _forest(roots: list[int], labels: np.ndarray, children: list[list[int]], shapes: list[int]) -> list[tuple[np.ndarray, ...]]:
    """The different subtrees of a list by depth: their labels; the child lists one behind the other as numbers of the next depth; and where these begin and end, with
    the subtrees that have them."""
    depths, nodes = [], list({shapes[v]: v for v in roots}.values())
    while nodes:
        lists = [children[v] for v in nodes]
        numbers: dict[int, int] = {}
        slots = [numbers.setdefault(shapes[c], len(numbers)) for some in lists for c in some]
        lengths = np.array([len(some) for some in lists])
        owners, ends = np.flatnonzero(lengths), np.cumsum(lengths)
        depths.append((labels[nodes], np.array(slots, dtype=np.int64), (ends - lengths)[owners], ends[owners] - 1, owners))
        nodes = list({shapes[c]: c for some in lists for c in some}.values())
    return depths


def _inner(forest: list[tuple[np.ndarray, ...]], labels: np.ndarray, children: list[list[int]], shapes: list[int], limit: int) -> Callable[[int], np.ndarray]:
    """What simple tree matching matches below a node and below every root of a forest, as a function of the node.

    The tables of all child lists of a depth are filled at once, a row per child. ``limit`` is above every size.
    """
    empty = [np.zeros(len(depth[0]), dtype=np.int64) for depth in forest]
    # Numbers of a list stay above those of the lists before, so that a running maximum ends with its list.
    bases = [np.repeat(np.arange(len(starts)), ends - starts + 1) * limit for _, _, starts, ends, _ in forest]
    known: list[dict[int, np.ndarray]] = [{} for _ in forest]

    def below(u: int, depth: int) -> np.ndarray:
        _, slots, starts, ends, owners = forest[depth]
        if not children[u] or not len(slots):
            return empty[depth]
        base = bases[depth]
        row, before = base.copy(), np.empty_like(base)
        for c in children[u]:
            before[1:] = row[:-1]
            before[starts] = base[starts]
            before += whole(c, depth + 1)[slots]
            np.maximum(row, before, out=row)
            np.maximum.accumulate(row, out=row)
        out = empty[depth].copy()
        out[owners] = (row - base)[ends]
        return out

    def whole(u: int, depth: int) -> np.ndarray:
        held = known[depth]
        if shapes[u] not in held:
            if len(held) == HELD:
                del held[next(iter(held))]
            same = forest[depth][0] == labels[u]
            held[shapes[u]] = same * (1 + below(u, depth)) if same.any() else empty[depth]
        return held[shapes[u]]

    return lambda u: below(u, 0)


def match(a_labels: list[str], a_parents: list[int], b_labels: list[str], b_parents: list[int]) -> list[tuple[int, int]]:
    """Simple tree matching of two trees in document order: the largest set of node pairs with equal labels that keeps ancestors and the order of siblings.

    Equal subtrees at both ends of two child lists are paired at once, which loses nothing; between
    them the lists are aligned by dynamic programming over the sizes of their subtrees' matchings. Long lists are aligned
    alike, with the sizes of a subtree and all others at once.
    """
    ca, cb = _children(a_parents), _children(b_parents)
    sa, sb = _shapes(a_labels, ca), _shapes(b_labels, cb)
    below = _totals([1] * len(a_labels), a_parents)
    done: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    @cache
    def numbered() -> list[np.ndarray]:
        numbers: dict[str, int] = {}
        return [np.array([numbers.setdefault(x, len(numbers)) for x in labels]) for labels in (a_labels, b_labels)]

    def align(x: int, y: int) -> tuple[int, list[tuple[int, int]]]:
        """Size of the best matching of the child lists of two nodes, and the child pairs of it."""
        left, right = ca[x], cb[y]
        pairs, low = [], 0
        high_a, high_b = len(left), len(right)
        while low < high_a and low < high_b and sa[left[low]] == sb[right[low]]:
            pairs.append((left[low], right[low]))
            low += 1
        while high_a > low and high_b > low and sa[left[high_a - 1]] == sb[right[high_b - 1]]:
            high_a, high_b = high_a - 1, high_b - 1
            pairs.append((left[high_a], right[high_b]))
        left, right = left[low:high_a], right[low:high_b]
        if len(left) * len(right) > WIDE:
            numbers_a, numbers_b = numbered()
            forest = _forest(right, numbers_b, cb, sb)
            inner = _inner(forest, numbers_a, ca, sa, len(a_labels) + 1)
            rows: dict[int, int] = {}
            at = np.array([rows.setdefault(sb[v], len(rows)) for v in right])
            sides = numbers_a[left], numbers_b[right], np.array([sa[u] for u in left]), np.array([sb[v] for v in right]), np.array([below[u] for u in left])
            found = _wide(*sides, lambda i: inner(left[i])[at])
            pairs += [(left[i], right[j]) for i, j in found]
            return sum(size(u, v) for u, v in pairs), pairs
        table = [[0] * (len(right) + 1)]
        for u in left:
            above, row = table[-1], [0]
            for j, v in enumerate(right):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if a_labels[u] == b_labels[v] and (w := above[j] + size(u, v)) > best:
                    best = w
                row.append(best)
            table.append(row)
        i, j = len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
        total = 0
        for u, v in pairs:
            total += size(u, v)
        return total, pairs

    def size(u: int, v: int) -> int:
        if sa[u] == sb[v]:
            return below[u]
        if not ca[u] or not cb[v]:
            return 1
        if (u, v) not in done:
            done[u, v] = align(u, v)
        return 1 + done[u, v][0]

    out, todo = [], [(-1, -1)]
    while todo:
        pair = u, v = todo.pop()
        if u >= 0 and sa[u] == sb[v]:  # equal subtrees, which document order numbers alike
            out += zip(range(u + 1, u + below[u]), range(v + 1, v + below[u]))
        elif ca[u] and cb[v]:
            if pair not in done:
                done[pair] = align(*pair)
            out += done[pair][1]
            todo += done[pair][1]
    return out


def article(tree: Tree) -> list[int]:
    """The text leaves of the article: inside ``article`` elements, else ``main``, else all that are not outside."""
    leaves = [i for i, label in enumerate(tree.labels) if label == "#" and not tree.outside[i]]
    for kind in ("article", "main"):
        inside = [False] * len(tree.labels)
        for i, label in enumerate(tree.labels):
            up = tree.parents[i]
            inside[i] = up >= 0 and inside[up] or label.split(" ", 1)[0] == kind
        if found := [i for i in leaves if inside[i]]:
            return found
    return leaves


def text_hash(text: str) -> int:
    """A number other than 0."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63) or 1


#: Pages have the same layout if their elements of the upper levels have the same label paths.
LEVELS = 4


def layout(tree: Tree) -> int:
    paths: list[tuple[str, ...] | None] = []
    for label, parent in zip(tree.labels, tree.parents):
        above = () if parent < 0 else paths[parent]
        paths.append(None if label == "#" or above is None or len(above) == LEVELS else (*above, label))
    return text_hash("\n".join(sorted({"\t".join(p) for p in paths if p is not None})))


def _leaves(tree: Tree, markup: bool) -> list[int]:
    """The text leaves that may be content, by markup or all of them."""
    return article(tree) if markup else [i for i, label in enumerate(tree.labels) if label == "#"]


SKELETON = "layout long, labels array<string>, parents array<int>, hashes array<long>, sizes array<int>, linked array<int>"


def _skeletons(pages: pd.Series) -> pd.DataFrame:
    """Trees without texts: hashes, lengths and link lengths of the texts, 0 for all other nodes."""
    rows = []
    for html in pages:
        tree = parse(html)
        hashes = [text_hash(text) if text else 0 for text in tree.texts]
        rows.append((layout(tree), tree.labels, tree.parents, hashes, [len(text) for text in tree.texts], tree.linked))
    return pd.DataFrame(rows, columns=["layout", "labels", "parents", "hashes", "sizes", "linked"])


def _layouts(pages: pd.Series) -> pd.Series:
    return pd.Series([layout(parse(html)) for html in pages], dtype="int64")


def _is_part(label: str) -> bool:
    return label.split(" ", 1)[0] not in PROSE_TAGS


SPOTS = "array<struct<node:int,text:long,prose:long,linked:long,blocks:long>>"


def _spots(labels: pd.Series, parents: pd.Series, hashes: pd.Series, sizes: pd.Series, linked: pd.Series, ref_labels: pd.Series, ref_parents: pd.Series) -> pd.Series:
    """What each page holds at the nodes of its reference page: texts, and for elements (text 0) what stands in them without a node of its own."""
    sys.setrecursionlimit(1_000_000)
    out = []
    for la, pa, ha, sizes_a, linked_a, lb, pb in zip(labels, parents, hashes, sizes, linked, ref_labels, ref_parents):
        la, pa = list(la), list(pa)
        place = dict(match(la, pa, list(lb), list(pb)))
        found = {(v, 0): [0, 0, 0] for u, v in place.items() if la[u] != "#" and _is_part(la[u])}
        near = []  # the reference node of the nearest ancestor that has one
        for u, up in enumerate(pa):
            above = near[up] if up >= 0 else -1
            near.append(place.get(u, above))
            if ha[u]:
                spot = found.setdefault((place[u], int(ha[u])) if u in place else (above, 0), [0, 0, 0])
                spot[0] += int(sizes_a[u] - linked_a[u])
                spot[1] += int(linked_a[u])
                spot[2] += 1
        out.append([{"node": v, "text": t, "prose": p, "linked": k, "blocks": n} for (v, t), (p, k, n) in found.items()])
    return pd.Series(out, dtype=object)


#: A part of the page with at most so many blocks on the pages that have it is no text of several paragraphs.
FEW = 2


def beside(labels: list[str], parents: list[int], nodes: list[dict], markup: bool = True) -> list[int]:
    """The elements of a wrapper that are no content: those that the way from the root to the bulk of the prose leaves beside.

    ``nodes`` tells for each node the pages that have it and the sums of prose, links and blocks over them. The way goes on while one
    child holds more than half of the prose in several blocks a page. A child beside it goes if it is more links than prose,
    or has a block or two; elements of text, such as paragraphs and headings, and parts with headings stay. With ``markup`` an article
    or main element on the way ends it.
    """
    n = len(labels)
    prose, linked, blocks, pages = ([0] * (n + 1) for _ in range(4))
    for v in nodes:
        prose[v["node"]], linked[v["node"]], blocks[v["node"]], pages[v["node"]] = v["prose"], v["linked"], v["blocks"], v["pages"]
    prose, linked, blocks = (_totals(x, parents) for x in (prose, linked, blocks))
    headed = _totals([int(re.match(r"h[1-6]\b", label) is not None) for label in labels], parents)
    children, at, out = _children(parents), -1, []
    while children[at]:
        way = max(children[at], key=lambda c: (prose[c], -c))
        if 2 * prose[way] <= prose[at] or not _is_part(labels[way]) or blocks[way] <= FEW * pages[way]:
            break
        for c in children[at]:
            if c != way and blocks[c] and _is_part(labels[c]) and (linked[c] > prose[c] or (blocks[c] <= FEW * pages[c] and not headed[c])):
                out.append(c)
        at = way
        if markup and labels[way].split(" ", 1)[0] in ("article", "main"):
            break
    return out


def _beside(markup: bool):
    @F.pandas_udf("array<int>")
    def udf(labels: pd.Series, parents: pd.Series, nodes: pd.Series) -> pd.Series:
        return pd.Series([beside(list(la), [int(p) for p in pa], list(ns), markup) for la, pa, ns in zip(labels, parents, nodes)], dtype=object)

    return udf


def _texts(markup: bool):
    @F.pandas_udf("string")
    def udf(pages: pd.Series, labels: pd.Series, parents: pd.Series, template: pd.Series, outside: pd.Series) -> pd.Series:
        sys.setrecursionlimit(1_000_000)
        out = []
        for html, lb, pb, fixed, parts in zip(pages, labels, parents, template, outside):
            tree = parse(html)
            kept = _leaves(tree, markup)
            if lb is not None:
                known, left = {f["node"]: f["text"] for f in fixed}, set(parts)
                place = dict(match(tree.labels, tree.parents, list(lb), list(pb)))
                gone: list[bool] = []
                for i, up in enumerate(tree.parents):
                    gone.append(up >= 0 and gone[up] or place.get(i) in left)
                kept = [i for i in kept if not gone[i] and known.get(place.get(i)) != text_hash(tree.texts[i])]
            out.append("\n\n".join(tree.texts[i] for i in kept))
        return pd.Series(out, dtype=object)

    return udf


def host_of(url: Column) -> Column:
    """The host of an address in lower case, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def induce(pages: DataFrame, least_pages: int = 4, share: float = 0.8, markup: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rules (host, layout, rule) and those wrappers (host, rule, labels, parents, template, outside) that leave something out, from rows (host, html).

    A layout's reference page is the one with the smallest hash; layouts of fewer than ``least_pages`` different pages take that of the
    host's most frequent layout. A text node of it is template if at least ``least_pages`` pages align a text with it and ``share`` of
    them the same text; ``outside`` are the elements that are no content (see ``beside``). Copies of a page count once, so that copied articles are no template.
    """
    seen = pages.where("html is not null and host <> ''").select("host", F.xxhash64("html").alias("page"), F.pandas_udf(_skeletons, SKELETON)("html").alias("s"))
    seen = materialise(seen.dropDuplicates(["host", "page"]).select("host", "s.*", "page"), "wrapper_pages")
    layouts = seen.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min_by(F.struct("labels", "parents"), "page").alias("r"))
    layouts = materialise(layouts, "wrapper_layouts")
    hosts = layouts.groupBy("host").agg(F.sum("n").alias("all"), F.max(F.struct("n", "layout"))["layout"].alias("first")).where(F.col("all") >= least_pages)
    ruled = layouts.select("host", "layout", "n").join(hosts, "host")
    ruled = materialise(ruled.select("host", "layout", F.when(F.col("n") >= least_pages, F.col("layout")).otherwise(F.col("first")).alias("rule")), "wrapper_rules")
    references = layouts.select("host", F.col("layout").alias("rule"), F.col("r.labels").alias("ref_labels"), F.col("r.parents").alias("ref_parents"))
    rules = ruled.join(references, ["host", "rule"])
    spots = F.pandas_udf(_spots, SPOTS)("labels", "parents", "hashes", "sizes", "linked", "ref_labels", "ref_parents")
    spots = seen.join(rules, ["host", "layout"]).select("host", "rule", F.explode(spots).alias("t")).select("host", "rule", "t.*")
    sums = [F.sum(c).alias(c) for c in ("prose", "linked", "blocks")]
    texts = spots.groupBy("host", "rule", "node", "text").agg(F.count("*").alias("n"), *sums)
    most = F.max(F.struct("n", "text", "prose", "linked", "blocks"))
    nodes = texts.groupBy("host", "rule", "node").agg(F.sum("n").alias("pages"), *sums, most.alias("most"))
    fixed = (F.col("most.text") != 0) & (F.col("pages") >= least_pages) & (F.col("most.n") >= share * F.col("pages"))
    free = [(F.col(c) - F.when(fixed, F.col(f"most.{c}")).otherwise(0)).alias(c) for c in ("prose", "linked", "blocks")]
    node = F.struct("node", F.when(fixed, F.col("most.text")).alias("text"), "pages", *free)
    found = nodes.groupBy("host", "rule").agg(F.array_sort(F.collect_list(node)).alias("nodes")).join(references, ["host", "rule"])
    template = F.transform(F.filter("nodes", lambda v: v["text"].isNotNull()), lambda v: F.struct(v["node"].alias("node"), v["text"].alias("text")))
    found = found.withColumn("outside", _beside(markup)("ref_labels", "ref_parents", "nodes")).withColumn("template", template)
    found = materialise(found.where((F.size("template") > 0) | (F.size("outside") > 0)).drop("nodes"), "wrappers")
    return ruled, found.select("host", "rule", F.col("ref_labels").alias("labels"), F.col("ref_parents").alias("parents"), "template", "outside")


def main_text(pages: DataFrame, url: str = "url", html: str = "html", name: str = "main_text", markup: bool = True, **how) -> DataFrame:
    """Add the main text of each page: its blocks in page order, joined by empty lines; empty if there is none.

    Null and empty pages have no text. Pages without a host, or of hosts with few pages, are read without a wrapper. Rows keep their
    number and columns; ``name`` must be new. Broken markup is read as far as it goes, whatever its length. Without ``markup``
    article and navigation tags, classes and roles have no vote: the wrapper alone tells what is content.
    """
    if name.lower() in {c.lower() for c in pages.columns}:
        raise ValueError(f"column {name} exists")
    rules, wrappers = induce(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")), markup=markup, **how)
    own_host, own, host, kind, rule, other, same, *tree = fresh(
        pages, "own host", "own layout", "host", "layout", "rule", "wrapper host", "wrapper rule", "labels", "parents", "template", "outside"
    )
    rules, wrappers = rules.toDF(host, kind, rule), wrappers.toDF(other, same, *tree)
    keyed = pages.withColumn(own_host, host_of(F.col(url))).withColumn(own, F.pandas_udf(_layouts, "long")(F.col(html)))
    joined = keyed.join(rules, (F.col(own_host) == F.col(host)) & (F.col(own) == F.col(kind)), "left")
    joined = joined.join(wrappers, (F.col(own_host) == F.col(other)) & (F.col(rule) == F.col(same)), "left")
    return joined.select(*pages.columns, _texts(markup)(F.col(html), *[F.col(c) for c in tree]).alias(name))
