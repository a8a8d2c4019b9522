"""Operator 7 -- main text of web pages by wrapper induction.

Pages of one host share a template, or one of several.  Which pages stand as
references is found from the texts, and pages are aligned to references by
simple tree matching: the largest set of node pairs with equal labels that
keeps parents and the order of siblings, by dynamic programming over the lists
of children.

1. References: a text is common if at least ``MIN_PAGES`` pages of the host and
   ``CONSTANT`` of those with its path (the labels from the root) have it there.
   Of the pages with a common text the one with the smallest hash of its html
   is a reference, for that text; so a host has as many as its layouts need,
   and none is empty.
2. Evidence: for every node of a reference that holds a text it stands for,
   over all pages of the host that have its path, how many matched it and how
   many had the very same text there; summed in each task and then by (host,
   reference, node).  A node is constant if at least ``MIN_PAGES`` pages matched
   it and ``CONSTANT`` of them had its text: it is template.  The others are
   slots.
3. Slots: which of the varying parts is the article is learnt per host and
   layout (the labels right below the body).  The layout's page with the
   smallest hash stands for it; every page of the layout is aligned to it, and
   for each container of the reference the words outside links, the words
   inside links and the text blocks found in it are summed over the pages
   (constant nodes and dropped roles do not count).  From the root the wrapper
   goes down into the part that holds at least ``HEAVY`` of the words outside
   links and more than one block a page: menus are nearly all links, adverts
   and notices few words.  What it ends at is the content; a page's text is
   what lies in the part matched to it.
4. Extraction: a page is aligned again; text outside the part matched to the
   content is dropped, as is text matched to constant nodes and every part whose
   role is not content, by element (nav, header, footer, aside, form, script,
   ...), ARIA role or class and id words (ad, menu, sidebar, cookie, comments,
   ...): such slots vary from page to page and alignment alone cannot tell them
   from the article.  Where ``article`` or ``main`` elements hold the part or lie
   in it they are its bounds (a title beside the part belongs to it), and
   constant nodes are kept (copies of a page must not lose their text); where
   they are elsewhere, as teasers are, the part stands.  On pages without a part
   (hosts or layouts too small to learn from) those elements are the content.

A block is a block element's own text: references decoded, white space
collapsed, trimmed; blocks follow in page order, one line each.

Of a host only the references are gathered; they meet the pages in an
equi-join, evidence is counted.  Pages are not shuffled: which of them are
references is broadcast by their hashes, and hosts are taken in parts, each
with few enough references to broadcast (a part with more bytes of them than
``BROADCAST_BYTES`` is joined by shuffle).  Sibling lists of any length are
matched exactly, pages of any depth are parsed and aligned whole.

Defined cases: null or empty html gives the empty text; a null url is a host of
its own; broken, cut-off or nested markup is closed as browsers do; pages alone
on their host have no constant nodes; repeated rows are extracted row by row;
an empty table gives an empty result; very long pages are parsed whole.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from tessera.session import scratch_path

MIN_PAGES = 4
CONSTANT = 0.8
#: Weights held at once while two lists of siblings are matched.
HELD_CELLS = 4_000_000
#: Lists of so many siblings are matched without arrays.
SHORT = 64
#: A part is the content's if it has this share of the words outside links.
HEAVY = 0.6
#: References are broadcast if they have at most so many bytes in all.
BROADCAST_BYTES = 16 << 20
#: Hosts to learn from in a part, and the most parts (folders that a task writes).
PART_HOSTS, PARTS = 512, 64

# Fixed values of HTML: how elements nest and which carry no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split())
CLOSES = {  # an opening tag ends these open elements
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
         "th": {"table", "tr"}, "option": {"select"}}
DROPPED = frozenset(
    "nav footer aside form script style noscript template head iframe object svg canvas button select textarea "
    "dialog menu search title math audio video".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar side footer masthead topbar cookie cookies consent gdpr notice notification alert "
    "popup modal overlay newsletter subscribe subscription signup login comment comments disqus discussion replies "
    "reply respond share sharing social related recommended pagination pager toolbar widget legal copyright "
    "disclaimer".split())
CONTAINERS = frozenset(("article", "main"))
#: End tags of inline elements reach no further.
BARRIERS = frozenset(("table", "article", "body"))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                  r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


class Node:
    """An element: tag, attributes that matter, children (nodes and strings)."""

    __slots__ = ("tag", "label", "drop", "children", "constant")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag = tag
        self.children: list = []
        self.constant = False
        if not attributes:
            self.label, self.drop = f"{tag} ", tag in DROPPED
            return
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
        self.label = f"{tag} {names.strip().lower()}"
        words = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", names).lower())) if names != " " else set()
        self.drop = (tag in DROPPED or bool(words & DROPPED_WORDS) or "hidden" in attributes
                     or attributes.get("role", "").lower() in DROPPED_ROLES or attributes.get("aria-hidden") == "true")


def parse(page: str) -> Node:
    """A tree of the page; never fails."""
    root = Node("#root", {})
    stack, at = [root], 0
    # Places in the stack by tag, of all block elements and of BARRIERS: no
    # tag walks down the stack, whatever its depth.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    barriers: list[int] = []

    def close(k: int) -> None:
        for node in reversed(stack[k:]):
            places[node.tag].pop()
            if node.tag in BLOCK:
                blocks.pop()
            if node.tag in BARRIERS:
                barriers.pop()
        del stack[k:]

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            k = last((tag,))
            if k and (tag in BLOCK or not barriers or barriers[-1] <= k):
                close(k)
            continue
        if tag in BLOCK and blocks and stack[blocks[-1]].tag == "p":  # a paragraph ends where a block begins
            close(blocks[-1])
        if tag in CLOSES:
            k = last(CLOSES[tag])
            if k > last(SCOPE[tag]):
                close(k)
        node = Node(tag, {a.lower(): b or c or d or "" for a, b, c, d in _ATTR.findall(m.group(3) or "")})
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]|\Z", re.I).search(page, at)
            node.children.append(page[at:end.start()])
            bracket = page.find(">", end.start())
            at = len(page) if bracket < 0 else bracket + 1
        elif tag not in VOID:  # a slash closes nothing in HTML
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                blocks.append(len(stack))
            if tag in BARRIERS:
                barriers.append(len(stack))
            stack.append(node)
    return root


def squeeze(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _inline_text(node: Node) -> str:
    """Text of a node that is not in a block element below it."""
    out = []
    todo = [iter(node.children)]
    while todo:
        for child in todo[-1]:
            if isinstance(child, str):
                out.append(child)
            elif child.tag == "br":
                out.append("\n")
            elif child.tag not in BLOCK and not child.drop:
                todo.append(iter(child.children))
                break
        else:
            todo.pop()
    return squeeze("".join(out))


# ── alignment ─────────────────────────────────────────────────────────────
# A tree travels as three lists, by node in page order: label, text digest and
# the numbers of its children.  Nothing here recurses, so depth is free.

def _elements(node: Node) -> list[Node]:
    return [c for c in node.children if not isinstance(c, str) and not c.drop and c.tag not in VOID]


def _flat(root: Node) -> tuple[list[Node], list[list[int]]]:
    """Elements that are not dropped, in page order, and their children's numbers."""
    nodes, kids, todo = [], [], [(root, -1)]
    while todo:
        node, parent = todo.pop()
        if parent >= 0:
            kids[parent].append(len(nodes))
        nodes.append(node)
        kids.append([])
        todo += [(c, len(nodes) - 1) for c in reversed(_elements(node))]
    return nodes, kids


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=8).digest()


def _digest(node: Node) -> bytes:
    """Digest of a block's own text."""
    text = _inline_text(node) if node.tag in BLOCK or node.tag == "#root" else ""
    return _hash(text.encode("utf-8", "replace")) if text else b""


def skeleton(node: Node) -> tuple[list[str], list[bytes], list[list[int]]]:
    nodes, kids = _flat(node)
    return [n.label for n in nodes], [_digest(n) for n in nodes], kids


def paths(labels: list[str], kids: list[list[int]]) -> list[bytes]:
    """A hash of the labels from the root to each node."""
    out = [b""] * len(labels)
    for k, label in enumerate(labels):
        out[k] = _hash(out[k] + label.encode("utf-8", "replace"))
        for c in kids[k]:
            out[c] = out[k]
    return out


def match(page: Node, tree: tuple) -> Iterator[tuple[Node, int]]:
    """Matched (page node, number of the reference node), by simple tree
    matching.  Equal subtrees (of labels) are one shape: weights are by pair of
    shapes, and equal shapes at the ends of two lists of siblings are paired
    first, which no largest matching exceeds."""
    labels, _, other = tree
    nodes, kids = _flat(page)
    known: dict[tuple, int] = {}
    forms: list[tuple] = []  # label, shapes of the children
    sizes: list[int] = []

    def shapes(names: list[str], below: list[list[int]]) -> list[int]:
        out = [0] * len(names)
        for k in range(len(names) - 1, -1, -1):
            form = (names[k], tuple([out[c] for c in below[k]]))
            out[k] = known.setdefault(form, len(known))
            if out[k] == len(forms):
                forms.append(form)
                sizes.append(1 + sum(sizes[c] for c in form[1]))
        return out

    mine, theirs = shapes([n.label for n in nodes], kids), shapes(labels, other)
    memo: dict[tuple[int, int], int] = {}

    def ends(xs: tuple, ys: tuple) -> tuple[int, int]:
        """Lengths of the equal heads and of the equal tails after them."""
        most = min(len(xs), len(ys))
        head = next((k for k in range(most) if xs[k] != ys[k]), most)
        tail = next((k for k in range(most - head) if xs[-1 - k] != ys[-1 - k]), most - head)
        return head, tail

    def simple(x: int, y: int) -> int | None:
        """The weight of two shapes where it takes no table."""
        if x == y:
            return sizes[x]
        if forms[x][0] != forms[y][0]:
            return 0
        return memo.get((x, y)) if forms[x][1] and forms[y][1] else 1

    def settle(xs: tuple, ys: tuple) -> list[tuple[int, int]]:
        """Pairs of shapes in two lists whose weight is not known yet."""
        by: dict[str, set[int]] = {}
        for y in set(ys):
            by.setdefault(forms[y][0], set()).add(y)
        return [(x, y) for x in set(xs) for y in by.get(forms[x][0], ()) if simple(x, y) is None]

    def inner(xs: tuple, ys: tuple) -> tuple[tuple, tuple]:
        head, tail = ends(xs, ys)
        return xs[head:len(xs) - tail], ys[head:len(ys) - tail]

    def prepare(xs: tuple, ys: tuple) -> None:
        todo = settle(*inner(xs, ys))
        while todo:
            x, y = todo[-1]
            if (x, y) not in memo:
                a, b = forms[x][1], forms[y][1]
                missing = settle(*inner(a, b))
                if missing:
                    todo += missing
                    continue
                head, tail = ends(a, b)
                equal = sum(sizes[c] for c in a[:head]) + sum(sizes[c] for c in a[len(a) - tail:])
                memo[x, y] = 1 + equal + table(*inner(a, b), False)
            todo.pop()

    def table(xs: tuple, ys: tuple, paired: bool):
        """Weight of the largest matching of two lists, or its pairs; every
        sqrt-th row is kept, the others are computed again on the way back."""
        where: dict[str, list[int]] = {}
        for j, y in enumerate(ys):
            where.setdefault(forms[y][0], []).append(j)
        rows_of = [i for i, x in enumerate(xs) if forms[x][0] in where]
        if not rows_of:
            return [] if paired else 0
        gains: dict[int, tuple | dict] = {}

        def short_step(last: list[int], x: int) -> list[int]:
            if x not in gains:
                gains[x] = {j: simple(x, ys[j]) for j in where[forms[x][0]]}
            gain, best, row = gains[x], 0, [0]
            for j in range(len(ys)):
                best = max(best, last[j + 1], last[j] + gain[j] if j in gain else 0)
                row.append(best)
            return row

        def long_step(last: np.ndarray, x: int) -> np.ndarray:
            if x not in gains:
                if len(gains) * len(ys) > HELD_CELLS:
                    gains.clear()
                at = where[forms[x][0]]
                gains[x] = np.array(at), np.array([simple(x, ys[j]) for j in at])
            at, gain = gains[x]
            row = last.copy()
            row[at + 1] = np.maximum(row[at + 1], last[at] + gain)
            return np.maximum.accumulate(row)

        every = math.isqrt(len(rows_of)) + 1
        short = len(ys) <= SHORT
        step = short_step if short else long_step
        row = [0] * (len(ys) + 1) if short else np.zeros(len(ys) + 1, np.int64)
        saved = [row]
        for n, i in enumerate(rows_of, 1):
            row = step(row, xs[i])
            if paired and n % every == 0:
                saved.append(row)
        if not paired:
            return int(row[-1])
        pairs, j = [], len(ys)
        for part in range(len(saved) - 1, -1, -1):
            block = rows_of[part * every:(part + 1) * every]
            rows = [saved[part]]
            for i in block:
                rows.append(step(rows[-1], xs[i]))
            k = len(block)
            while k and j:
                if rows[k][j] == rows[k - 1][j]:
                    k -= 1
                elif rows[k][j] == rows[k][j - 1]:
                    j -= 1
                else:
                    pairs.append((block[k - 1], j - 1))
                    k, j = k - 1, j - 1
        return pairs

    todo = [(0, 0)] if labels else []
    while todo:
        a, b = todo.pop()
        yield nodes[a], b
        own, ref = kids[a], other[b]
        if not own or not ref:
            continue
        xs, ys = tuple([mine[c] for c in own]), tuple([theirs[c] for c in ref])
        head, tail = ends(xs, ys)
        todo += [(own[k], ref[k]) for k in range(head)]
        todo += [(own[-1 - k], ref[-1 - k]) for k in range(tail)]
        xs, ys = inner(xs, ys)
        if xs and ys:
            prepare(xs, ys)
            todo += [(own[head + i], ref[head + j]) for i, j in table(xs, ys, True)]


def main_text(page: str, references: list[tuple] = (), slot: tuple | None = None) -> str:
    """Blocks of the page's content, one line each; ``references`` are
    (skeleton, paths it was chosen for, constant nodes), ``slot`` the layout's
    (skeleton, number of its content part)."""
    root = parse(page)
    part = None
    if slot and slot[1]:
        part = next((node for node, number in match(root, slot[0]) if number == slot[1]), None)
    starts, whole = _content(root, part)
    if not whole:
        mark_constant(root, references)
    blocks: list[str] = []
    for start in starts:
        _blocks(start, whole, blocks)
    return "\n".join(blocks)


def _content(root: Node, part: Node | None) -> tuple[list[Node], bool]:
    """Where the page's text is, from the part matched to the layout's content,
    and whether constant nodes in it stay.  Article and main elements that hold
    the part or lie in it give its bounds; if the page has them elsewhere only,
    the part stands.  They stand for the content of a page without a part."""
    marked = _containers(root)
    if part is None:
        return marked or [root], bool(marked)
    bounds = any(_holds(node, {id(part)}) for node in marked) or _holds(part, {id(node) for node in marked})
    return (marked, True) if bounds else ([part], False)


def _holds(top: Node, wanted: set[int]) -> bool:
    """Whether a node or one below it is wanted (by id)."""
    todo = [top] if wanted else []
    while todo:
        node = todo.pop()
        if id(node) in wanted:
            return True
        todo += [c for c in node.children if not isinstance(c, str)]
    return False


def mark_constant(root: Node, references: list[tuple]) -> None:
    for tree, constant in _near(root, references):
        for node, number in match(root, tree):
            node.constant = node.constant or number in constant


def layout(root: Node) -> bytes:
    """A hash of the labels right below the body, runs of one label as one."""
    body = root
    while True:
        inner = [c for c in _elements(body) if c.tag in ("html", "body")]
        if not inner:
            break
        body = inner[0]
    labels = [c.label for c in _elements(body)]
    return _hash("\n".join(x for k, x in enumerate(labels) if k == 0 or x != labels[k - 1]).encode("utf-8", "replace"))


def weights(root: Node) -> tuple[list[Node], list[list[int]]]:
    """The nodes in page order and, of each with all below it, the words
    outside links, the words in links and the blocks with words of their own."""
    nodes, kids = _flat(root)
    sums = [[0, 0, 0] for _ in nodes]
    linked = [False] * len(nodes)
    for k, node in enumerate(nodes):
        linked[k] = linked[k] or node.tag == "a"
        for c in kids[k]:
            linked[c] = linked[k]
        if node.constant:
            continue
        own = [c for c in node.children if isinstance(c, str)]
        sums[k][1 if linked[k] else 0] = sum(len(c.split()) for c in own)
        if node.tag in BLOCK:  # a reference alone may stand for white space
            sums[k][2] = int(any("&" not in c and c.strip() for c in own) or bool(_inline_text(node)))
    for k in range(len(nodes) - 1, -1, -1):
        for c in kids[k]:
            sums[k] = [a + b for a, b in zip(sums[k], sums[c])]
    return nodes, sums


def content_part(kids: list[list[int]], found: dict[int, tuple[int, int, int, int]], heavy: float = HEAVY) -> int:
    """The reference node that holds the content (0: the whole page), from the
    pages and summed weights of its containers."""
    at = 0
    while True:
        whole = found.get(at, (0, 0, 0, 0))[1]
        best = max((c for c in kids[at] if c in found), key=lambda c: found[c][1], default=None)
        if best is None:
            return at
        pages, text, _, blocks = found[best]
        if pages < MIN_PAGES or text < heavy * whole or blocks <= 1.2 * pages:
            return at
        at = best


def _near(root: Node, references: list[tuple]) -> Iterator[tuple]:
    """The references chosen for a path that the page has."""
    if not references:
        return
    nodes, kids = _flat(root)
    held = set(paths([n.label for n in nodes], kids))
    for tree, chosen, rest in references:
        if not held.isdisjoint(chosen):
            yield tree, rest


def _containers(root: Node) -> list[Node]:
    """Outermost article and main elements outside dropped parts; within a
    main element its articles, if it has any."""
    above = _above_articles(root)
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "article" or node.tag == "main" and id(node) not in above:
            found.append(node)
            continue
        todo += [c for c in reversed(node.children) if not isinstance(c, str) and not c.drop and c.tag != "header"]
    return found


def _above_articles(root: Node) -> set[int]:
    """ids of the nodes with an article below them, outside dropped parts."""
    nodes, todo = [], [(root, None)]
    while todo:
        node, parent = todo.pop()
        nodes.append((node, parent))
        todo += [(c, node) for c in node.children if not isinstance(c, str) and not c.drop]
    found: set[int] = set()
    for node, parent in reversed(nodes):
        if parent is not None and (node.tag == "article" or id(node) in found):
            found.add(id(parent))
    return found


def _blocks(start: Node, inside: bool, out: list[str]) -> None:
    held: list[str] = []

    def flush() -> None:
        text = squeeze("".join(held))
        held.clear()
        if text:
            out.append(text)

    todo = [(start, iter(start.children))]
    while todo:
        node, rest = todo[-1]
        for child in rest:
            if isinstance(child, str):
                if inside or not node.constant:
                    held.append(child)
                continue
            if child.tag == "br":
                held.append("\n")
                continue
            if child.drop or child.tag in VOID or (child.tag == "header" and not inside):
                if child.tag in BLOCK:
                    flush()
                continue
            if child.tag in BLOCK:
                flush()
            todo.append((child, iter(child.children)))
            break
        else:
            if node.tag in BLOCK or node is start:
                flush()
            todo.pop()


# ── the jobs ──────────────────────────────────────────────────────────────
def host_key(url: str) -> Column:
    host = F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(F.concat(F.lit("="), host), F.lit(""))


def _joined(pages: DataFrame, table: DataFrame, size: str, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join with a written table of references, which is broadcast if
    the bytes in its column ``size`` are few."""
    total = table.agg(F.sum(size)).first()[0] or 0
    return pages.join(F.broadcast(table) if total <= BROADCAST_BYTES else table, on, how)


def _parts(pages: DataFrame) -> int:
    """In how many parts the hosts of the pages are taken."""
    hosts = pages.groupBy("host").count().filter(F.col("count") >= MIN_PAGES).count()
    return min(PARTS, max(1, -(-hosts // PART_HOSTS)))


def _loaded(coded: list[dict] | None) -> list[tuple]:
    return [(*pickle.loads(r["tree"])[:2], frozenset(r["constant"])) for r in coded or ()]


class _Held(dict):
    """Decoded references of the last hosts."""

    def of(self, host: str, coded) -> list[tuple]:
        if host not in self:
            if len(self) > 256:
                self.clear()
            self[host] = _loaded(coded.as_py())
        return self[host]

    def tree(self, coded: bytes | None):
        if coded is None:
            return None
        if coded not in self:
            if len(self) > 256:
                self.clear()
            self[coded] = pickle.loads(coded)
        return self[coded]


def laid_out(pages: DataFrame, parts: int = 1) -> DataFrame:
    """The pages (page_id, url, html, host) with their layout and the texts at
    each path (path and digest; the path alone says that there is one), from
    one parse (written, a folder a part of the hosts if they have several)."""
    from tessera.operators.sinks import materialize

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts, texts = [], []
            for page in batch.column(batch.schema.get_field_index("html")).to_pylist():
                root = parse(page or "")
                labels, digests, kids = skeleton(root)
                found = {(p, d) for p, d in zip(paths(labels, kids), digests) if d}
                layouts.append(layout(root))
                texts.append([p + d for p, d in found | {(p, b"") for p, _ in found}])
            yield (batch.append_column("layout", pa.array(layouts, pa.binary()))
                   .append_column("texts", pa.array(texts, pa.list_(pa.binary()))))

    laid = pages.mapInArrow(lay, pages.select("*").schema.add("layout", "binary").add("texts", ArrayType(BinaryType())))
    if parts == 1:
        return materialize(laid, "html-pages")
    return materialize(laid.withColumn("part", F.pmod(F.xxhash64("host"), F.lit(parts)).cast("int")), "html-pages", ["part"])


def induce(pages: DataFrame) -> DataFrame:
    """host, references (pickled skeleton, paths, constant nodes) and their
    bytes, from pages (host, html, texts)."""
    from tessera.operators.sinks import materialize

    given = pages.select("host", "html", "texts").filter("html <> ''").withColumn("spread", F.xxhash64("html"))
    # Pages with a text at a path; the empty digest counts those with any.
    at = given.select("host", "spread", F.explode("texts").alias("at"))
    counted = materialize(
        at.select("host", F.substring("at", 1, 8).alias("path"), F.substring("at", 9, 8).alias("digest"), "spread")
        .groupBy("host", "path", "digest").agg(F.count("*").alias("n"), F.min("spread").alias("spread"))
        .filter(F.col("n") >= MIN_PAGES), "html-texts")
    whole = counted.filter("digest = X''").select("host", "path", F.col("n").alias("whole"))
    chosen = materialize(
        counted.filter("digest <> X''").join(whole, ["host", "path"]).filter(F.col("n") >= CONSTANT * F.col("whole"))
        .groupBy("host", "spread").agg(F.sort_array(F.collect_list(F.concat("path", "digest"))).alias("texts"))
        .withColumn("bytes", F.octet_length("host") + 16 * F.size("texts")), "html-chosen")
    sample = (_joined(given.drop("texts"), chosen, "bytes", ["host", "spread"]).groupBy("host", "spread")
              .agg(F.min("html").alias("html"), F.first("texts").alias("texts")))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for page, chosen in zip(batch.column("html").to_pylist(), batch.column("texts").to_pylist()):
                tree, chosen = skeleton(parse(page)), set(chosen)
                place = paths(tree[0], tree[2])
                nodes = [k for k, d in enumerate(tree[1]) if place[k] + d in chosen]
                coded.append(pickle.dumps((tree, frozenset(place[k] for k in nodes), frozenset(nodes))))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("spread"), pa.array(coded, pa.binary())],
                                             names=["host", "spread", "tree"])

    references = materialize(sample.select("host", "spread", "texts", "html").mapInArrow(
        trees, "host string, spread long, tree binary"), "html-references")

    def together(rows: DataFrame) -> DataFrame:
        one = F.struct("spread", "tree", "constant")
        return rows.groupBy("host").agg(F.sort_array(F.collect_list(one)).alias("references"),
                                        F.sum(F.octet_length("tree")).alias("bytes"))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], list[int]] = {}
        held: dict[str, list[tuple]] = {}
        for batch in batches:
            for host, page, coded in zip(*batch.columns):
                host = host.as_py()
                if host not in held:
                    if len(held) > 256:
                        held.clear()
                    trees = [(*pickle.loads(r["tree"]), r["spread"]) for r in coded.as_py()]
                    held[host] = [(tree, place, (nodes, spread)) for tree, place, nodes, spread in trees]
                root = parse(page.as_py())
                for tree, (nodes, spread) in _near(root, held[host]):
                    for node, number in match(root, tree):
                        if number in nodes:
                            entry = sums.setdefault((host, spread, number), [0, 0])
                            entry[0] += 1
                            entry[1] += _digest(node) == tree[1][number]
        yield pa.RecordBatch.from_pydict({
            "host": pa.array([k[0] for k in sums], pa.string()), "spread": pa.array([k[1] for k in sums], pa.int64()),
            "node": pa.array([k[2] for k in sums], pa.int64()),
            "seen": pa.array([v[0] for v in sums.values()], pa.int64()),
            "same": pa.array([v[1] for v in sums.values()], pa.int64())})

    none = F.lit(None).cast("array<bigint>")
    all_of = materialize(together(references.withColumn("constant", none)), "html-references-by-host")
    aligned = _joined(given.select("host", "html"), all_of, "bytes", ["host"])
    constant = (aligned.select("host", "html", "references")
                .mapInArrow(evidence, "host string, spread long, node long, seen long, same long")
                .groupBy("host", "spread", "node").agg(F.sum("seen").alias("seen"), F.sum("same").alias("same"))
                .filter((F.col("seen") >= MIN_PAGES) & (F.col("same") >= CONSTANT * F.col("seen")))
                .groupBy("host", "spread").agg(F.sort_array(F.collect_list("node")).alias("constant")))
    return materialize(together(references.join(constant, ["host", "spread"])), "html-wrappers")


def slots(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """host, layout, slot (pickled skeleton and content part) and its bytes,
    from pages (host, html, layout) and their hosts' references: one reference
    a layout, so a page is aligned once."""
    from tessera.operators.sinks import materialize

    given = pages.select("host", "layout", "html").filter("html <> ''")
    keyed = given.withColumn("spread", F.xxhash64("html"))
    chosen = materialize(
        keyed.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min("spread").alias("spread"))
        .filter(F.col("n") >= MIN_PAGES).drop("n")
        .withColumn("bytes", F.octet_length("host") + F.octet_length("layout") + 8), "html-chosen-layouts")
    sample = _joined(keyed, chosen, "bytes", ["host", "layout", "spread"]).groupBy("host", "layout").agg(F.min("html").alias("html"))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [pickle.dumps(skeleton(parse(page))) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(coded, pa.binary()),
                                              pa.array(list(map(len, coded)), pa.int64())], names=["host", "layout", "tree", "bytes"])

    trees_of = materialize(sample.select("host", "layout", "html").mapInArrow(
        trees, "host string, layout binary, tree binary, bytes long"), "html-layouts")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = _Held(), {}
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            for host, place, page, tree, coded in zip(*(col[c].to_pylist() for c in ("host", "layout", "html", "tree")), col["references"]):
                root = parse(page)
                mark_constant(root, held.of(host, coded))
                nodes, own = weights(root)
                number_of = {id(n): k for k, n in enumerate(nodes)}
                tree = held.tree(tree)
                for node, number in match(root, tree):
                    if tree[2][number]:
                        entry = sums.setdefault((host, place, number), [0, 0, 0, 0])
                        entry[:] = [a + b for a, b in zip(entry, (1, *own[number_of[id(node)]]))]
            if len(sums) > 200_000:
                yield rows(sums)
                sums = {}
        yield rows(sums)

    def rows(sums: dict) -> pa.RecordBatch:
        values = np.array(list(sums.values()), np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_pydict({
            "host": pa.array([k[0] for k in sums], pa.string()), "layout": pa.array([k[1] for k in sums], pa.binary()),
            "node": pa.array([k[2] for k in sums], pa.int64()),
            **{name: pa.array(values[:, k]) for k, name in enumerate(("pages", "text", "links", "blocks"))}})

    aligned = _joined(_joined(given, wrappers, "bytes", ["host"], "left").drop("bytes"), trees_of, "bytes", ["host", "layout"])
    names = ("pages", "text", "links", "blocks")
    found = (aligned.select("host", "layout", "html", "references", "tree")
             .mapInArrow(weigh, "host string, layout binary, node long, pages long, text long, links long, blocks long")
             .groupBy("host", "layout", "node").agg(*[F.sum(c).alias(c) for c in names])
             .groupBy("host", "layout").agg(F.collect_list(F.struct("node", *names)).alias("found")))  # a page's containers

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for tree, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                tree = pickle.loads(tree)
                part = content_part(tree[2], {x["node"]: tuple(x[c] for c in names) for x in found})
                coded.append(pickle.dumps((tree, part)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(coded, pa.binary()),
                                              pa.array(list(map(len, coded)), pa.int64())], names=["host", "layout", "slot", "slot_bytes"])

    return materialize(trees_of.join(found, ["host", "layout"]).select("host", "layout", "tree", "found").mapInArrow(
        choose, "host string, layout binary, slot binary, slot_bytes long"), "html-slots")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    from tessera.operators.sinks import append

    given = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_key("url").alias("host"))
    parts = _parts(given)
    own = laid_out(given, parts)
    if parts == 1:
        return texts_of(own)
    # One part after another: only one part's references are broadcast.
    path = scratch_path(pages.sparkSession, "html-main-texts")
    for part in range(parts):
        append(texts_of(own.filter(F.col("part") == part)), path)
    return pages.sparkSession.read.parquet(path)


def texts_of(own: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of pages as ``laid_out``; whole hosts."""
    schema = own.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            col = {n: c for n, c in zip(batch.schema.names, batch.columns)}
            pages = zip(col["host"].to_pylist(), col["html"].to_pylist())
            texts = [main_text(page or "", held.of(host, coded), held.tree(slot)) for (host, page), coded, slot
                     in zip(pages, col["references"], col["slot"].to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "page_id": col["page_id"], "url": col["url"], "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    # References are joined to the pages, never written with them.
    wrappers = induce(own)
    found = slots(own, wrappers)
    own = _joined(own.drop("texts"), wrappers, "bytes", ["host"], "left").drop("bytes")
    own = _joined(own, found, "slot_bytes", ["host", "layout"], "left")
    return own.select("page_id", "url", "host", "html", "references", "slot").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
