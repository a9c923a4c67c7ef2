"""Main text of web pages by wrapper induction.

Pages of one host are parsed to element trees and aligned with simple tree matching: two nodes match
if their labels do, and their children are matched in order so that as many nodes as possible, at
all depths, match. Runs of equally labelled siblings are one repeated node whose items are all aligned with
one slot, so that lists and paragraphs of any number align. What the aligned nodes hold decides: a text
that most pages have in a slot is template, what varies is content. The content is all varying slots in page
order, but for parts that say by their element that they are something else (menus, footers, forms, ...).
Names are a tie-break: a part whose class, id or role is made of words for adverts, comments and the like is excluded unless it
holds most of the page's varying text; and where a page has nothing to be compared with, its main and article elements decide.

Hosts are dealt to groups of about ``GROUP`` pages, so a host of any size is never in one task.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import re
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import materialize, schema

GROUP = 48
#: Fixed values of HTML: elements without content, with raw content, and that begin a block of their own.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "select"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: A start tag ends an open element of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that are never part of an article.
NEVER = {"nav", "footer", "aside", "form", "menu", "button", "dialog", "label", "input", "head", "search"}
#: Words in class, id or role for what isn't part of an article; on ``WHOLE`` elements they don't count. A name of several parts
#: counts if all of its parts are such words or only say where or how something lies.
STRONG = set(
    "ad ads advert adverts advertisement breadcrumb breadcrumbs comments complementary contentinfo cookie cookies disqus footer masthead menu modal nav navbar navigation "
    "newsletter pagination popup sidebar signup sponsored subscribe toolbar".split()
)
#: Words that also have a meaning within articles: these count only if the whole attribute is made of such words.
WEAK = set("banner comment notice notices promo related replies share sharing social widget".split())
LAYOUT = set(
    "area bar block bottom box btn button buttons col container content float icon icons inner item items left link links list main outer page panel post posts primary right row "
    "secondary section site slot sticky sub top unit wrap wrapper".split()
)
PARTS = re.compile(r"[a-z]+")
WHOLE = {"html", "body", "main", "article"}
TAG_NAME = re.compile(r"[^\s/>]*")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]*)(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")


class Node:
    """An element: label (tag and class names), children (nodes and texts), whether it is never content, and whether its names say so."""

    __slots__ = ("tag", "label", "named", "children", "never", "doubtful", "link", "_hash", "_runs")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag = tag
        of = attributes or {}
        names = [of[k].lower() for k in ("class", "id", "role") if of.get(k)]
        self.named = " ".join(names)
        self.label = f"{tag}.{self.named}" if names else tag
        self.never = tag in NEVER or "hidden" in of or of.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(of.get("style", "")))
        self.doubtful = tag not in WHOLE and any(map(says_other, names))
        self.children: list = []
        self.link = tag == "a"
        self._hash = self._runs = None

    def text_hash(self) -> bytes:
        """Hash of all text below, blocks and inline alike; made from the leaves up, so depth doesn't matter."""
        if self._hash is None:
            order = [self]
            for x in order:
                order.extend(c for c in x.children if isinstance(c, Node) and c._hash is None)
            for x in reversed(order):
                h = hashlib.blake2b(digest_size=8)
                for c in x.children:
                    h.update(c._hash if isinstance(c, Node) else SPACE.sub(" ", c).strip().encode("utf-8", "replace"))
                x._hash = h.digest()
        return self._hash

    def runs(self) -> list[tuple[str, list[Node]]]:
        """Element children of block kind as runs of equally labelled ones; inline elements are looked through."""
        if self._runs is None:
            out: list[tuple[str, list[Node]]] = []
            stack = self.children[::-1]
            while stack:
                c = stack.pop()
                if not isinstance(c, Node):
                    continue
                if c.tag not in BLOCK:
                    stack.extend(c.children[::-1])
                elif out and out[-1][0] == c.label:
                    out[-1][1].append(c)
                else:
                    out.append((c.label, [c]))
            self._runs = out
        return self._runs


def says_other(name: str) -> bool:
    """Whether an attribute's words are those of something beside the article."""
    weak, foreign = False, False
    for token in name.split():
        parts = PARTS.findall(token)
        if not all(p in STRONG or p in WEAK or p in LAYOUT for p in parts):
            foreign = True
        elif any(p in STRONG for p in parts):
            return True
        else:
            weak = weak or any(p in WEAK for p in parts)
    return weak and not foreign


def attributes(source: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes of a tag from ``at`` on, whether it closes itself, and where it ends: -1 if the page ends before.

    A value begins after ``=``: it is quoted if a quote comes first, and ends at white space or ``>`` otherwise.
    """
    out: dict[str, str] = {}
    n = len(source)
    while at < n:
        m = ATTRIBUTE.match(source, at)
        at, valued = m.end(), False
        if m[1] and m[2] and at < n:
            valued = True
            if source[at] in "\"'":
                end = source.find(source[at], at + 1)
                if end < 0:
                    break
                value, at = source[at + 1 : end], end + 1
            else:
                value = UNQUOTED.match(source, at)[0]
                at += len(value)
            out.setdefault(m[1].lower(), entities.unescape(value))
        elif m[1]:
            out.setdefault(m[1].lower(), "")
        if at < n and source[at] == ">":
            return out, source[at - 1] == "/" and not valued, at + 1
    return out, False, -1


class Open:
    """The open elements, with the places of each tag and of blocks, so that none is searched for."""

    def __init__(self, root: Node):
        self.stack, self.by_tag, self.blocks = [root], {root.tag: [0]}, [0]

    def last(self, *tags: str) -> int:
        return max((self.by_tag[t][-1] for t in tags if self.by_tag.get(t)), default=-1)

    def push(self, node: Node) -> None:
        self.by_tag.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def close(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            self.by_tag[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()


LISTS = ("ul", "ol", "dl", "table", "select")


def parse(source: str) -> Node:
    """The element tree of a page. Unclosed and misplaced tags close as browsers do in the common cases; a tag that the page ends in is none."""
    root = Node("html")
    top = Open(root)
    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        lt = n if lt < 0 else lt
        if lt > at:
            top.stack[-1].children.append(source[at:lt])
        at = lt + 1
        if source.startswith(("!", "?"), at):
            comment = source.startswith("!--", at)
            end = source.find("-->" if comment else ">", at + 1 if comment else at)  # <!--> and <!---> are whole comments
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        closing = source.startswith("/", at)
        first = source[at + closing : at + closing + 1]
        if not (first.isascii() and first.isalpha()):
            if closing:  # a comment up to the next >, as in browsers
                end = source.find(">", at)
                at = n if end < 0 else end + 1
            elif lt < n:
                top.stack[-1].children.append("<")
            continue
        name = TAG_NAME.match(source, at + closing)
        tag = name[0].lower()
        given, alone, at = attributes(source, name.end())
        if at < 0:
            break
        if closing:
            place = top.last(tag)
            if place > 0 and (tag in BLOCK or place > top.blocks[-1]):  # an inline end tag doesn't close a block
                top.close(place)
            continue
        if tag in ("html", "body") and top.last(tag) >= 0:
            continue
        if tag in BLOCK and top.stack[top.blocks[-1]].tag == "p":
            top.close(top.blocks[-1])  # a block ends an open paragraph, with what is inline in it
        if tag in CLOSES:
            while (place := top.last(*CLOSES[tag])) > max(0, top.last(*LISTS)):
                top.close(place)
                if tag != "tr":
                    break
        node = Node(tag, given)
        top.stack[-1].children.append(node)
        if tag in RAW:
            end = _raw_end(tag).search(source, at)
            at = end.end() if end else n
            node.never = True
        elif tag not in VOID and not (alone and tag not in BLOCK and tag not in ("a", "b", "i", "span", "em", "strong")):
            top.push(node)
    return root


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?:\s[^>]*)?>", re.I)


def blocks(node: Node, drop: set[int], inside: bool = False) -> list[str]:
    """Texts of the blocks below, in page order. ``drop`` holds ids of template nodes."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append(text)
            parts.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            parts.append(x)
        elif x is not node and (x.never or id(x) in drop):
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br":
            parts.append(" ")
        elif x.tag in BLOCK:
            flush()
            stack.append(None)
            stack.extend(x.children[::-1])
        else:
            stack.extend(x.children[::-1])
    flush()
    return out


def doubtful(root: Node, drop: set[int]) -> set[int]:
    """Ids of nodes that are excluded by their names.

    Names don't count on a node that holds over half of the page's varying text outside links, unless an
    article or main element beside it holds text: then a long advert or comments are what they say.
    """
    order, above, size = [root], [0], [0]
    at = 0
    while at < len(order):
        for c in order[at].children:
            if isinstance(c, str):
                size[at] += len(c.strip())
            elif not c.never and not c.link and id(c) not in drop:
                order.append(c)
                above.append(at)
                size.append(0)
        at += 1
    for at in range(len(order) - 1, 0, -1):
        size[above[at]] += size[at]
    # Main and article elements that hold text: at or below a node, and above it.
    below = [int(x.tag in ("article", "main") and size[at] > 0) for at, x in enumerate(order)]
    over = [0] * len(order)
    for at in range(1, len(order)):
        over[at] = over[above[at]] + below[above[at]]
    for at in range(len(order) - 1, 0, -1):
        below[above[at]] += below[at]

    def beside(at: int) -> bool:
        """Whether one of them is neither below nor above the node."""
        return below[0] > below[at] + over[at]

    found, stack = set(), [root]
    number = {id(x): at for at, x in enumerate(order)}
    while stack:
        x = stack.pop()
        at = number.get(id(x))
        if x.doubtful and (at is None or 2 * size[at] <= size[0] or beside(at)):
            found.add(id(x))
        else:
            stack.extend(c for c in x.children if isinstance(c, Node))
    return found


class Slot:
    """A node of the wrapper: the pages' nodes that were aligned here, as (page, node), and its children's slots."""

    __slots__ = ("label", "seen", "children")

    def __init__(self, label: str):
        self.label, self.seen, self.children = label, [], []


def align(wrapper: Slot, root: Node, page: int) -> None:
    """Align a page with the wrapper, growing it by what it lacks. Every item of a run is aligned with the run's slot."""
    todo, sizes = [(wrapper, root)], {}
    while todo:
        slot, node = todo.pop()
        slot.seen.append((page, node))
        theirs = node.runs()
        merged, i = [], 0
        for mine, other in simple_tree_matching(slot.children, theirs, sizes):
            while i < mine:
                merged.append(slot.children[i])
                i += 1
            if mine >= 0:
                merged.append(slot.children[i])
                i += 1
            else:
                merged.append(Slot(theirs[other][0]))
            todo.extend((merged[-1], item) for item in theirs[other][1][::-1])
        merged.extend(slot.children[i:])
        slot.children = merged


#: Levels below a node that count when one of several alignments is chosen, and cells of a table that are worked out
#: for that; deeper levels count as one node each, and larger tables are matched by labels in order.
DEPTH, CELLS = 24, 1 << 18


def match_size(slot: Slot, node: Node, sizes: dict[tuple[int, int], int], depth: int) -> int:
    """Nodes of the largest matching of two trees with equal labels, themselves included."""
    key = id(slot), id(node)
    if key not in sizes:
        below = 0
        if depth and slot.children:
            theirs = node.runs()
            pairs = simple_tree_matching(slot.children, theirs, sizes, depth - 1)
            below = sum(match_size(slot.children[i], theirs[j][1][0], sizes, depth - 1) for i, j in pairs if i >= 0)
        sizes[key] = 1 + below
    return sizes[key]


def simple_tree_matching(slots: list[Slot], runs: list[tuple[str, list[Node]]], sizes: dict, depth: int = DEPTH) -> list[tuple[int, int]]:
    """Largest matching in order of children: for each run its slot, or -1. A pair counts with all that matches below it.

    Equal ends are matched first; only the rest needs the table.
    """
    a, b = [s.label for s in slots], [label for label, _ in runs]
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    middle = _by_label(x, y) if len(x) * len(y) > CELLS else _by_size(x, y, lambda i, j: match_size(slots[head + i], runs[head + j][1][0], sizes, depth))
    middle = [(head + i if i >= 0 else -1, head + j) for i, j in middle]
    return [(k, k) for k in range(head)] + middle + [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]


def _by_size(x: list[str], y: list[str], size) -> list[tuple[int, int]]:
    weight = {(i, j): size(i, j) for i, p in enumerate(x) for j, q in enumerate(y) if p == q}
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            both = weight.get((i, j))
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + both if both else 0)
    out, i, j = [], 0, 0
    while j < len(y):
        both = weight.get((i, j))
        if both and best[i][j] == best[i + 1][j + 1] + both:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            out.append((-1, j))
            j += 1
    return out


def _by_label(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Each run takes the next slot of its label that is left."""
    places: dict[str, list[int]] = {}
    for i, label in enumerate(x):
        places.setdefault(label, []).append(i)
    out, at = [], 0
    for j, label in enumerate(y):
        of = places.get(label, ())
        k = bisect.bisect_left(of, at)
        if k < len(of):
            at = of[k] + 1
        out.append((of[k] if k < len(of) else -1, j))
    return out


def kinds_of(pages: list[list[str]]) -> list[int]:
    """The kind of each page, told by its blocks: a page that shares over half of its text with one before is of that one's kind.

    Copies and near copies of a page prove nothing about what is constant.
    """
    first: list[tuple[dict[str, int], int]] = []
    out = []
    for page in pages:
        mine = {b: len(b) for b in page}
        total = sum(mine.values())
        for kind, (other, size) in enumerate(first):
            if 2 * sum(n for b, n in mine.items() if b in other) > min(total, size) or mine == other:
                out.append(kind)
                break
        else:
            out.append(len(first))
            first.append((mine, total))
    return out


def extract(pages: list[str]) -> list[str]:
    """Main texts of pages that share a template. A page may be empty.

    A text that a slot has on at least two kinds of page, and on over half of all kinds, is template.
    """
    trees = [parse(p) for p in pages]
    wrapper = Slot("html")
    for i, t in enumerate(trees):
        align(wrapper, t, i)
    kinds = kinds_of([blocks(t, set()) for t in trees])
    need = max(2, len(set(kinds)) // 2 + 1)
    drops: list[set[int]] = [set() for _ in trees]
    queue = [wrapper]
    while queue:
        s = queue.pop()
        queue.extend(s.children)
        on: dict[bytes, set[int]] = {}
        for page, node in s.seen:
            on.setdefault(node.text_hash(), set()).add(kinds[page])
        common = {h for h, where in on.items() if len(where) >= need}
        for page, node in s.seen if common else ():
            if node.text_hash() in common:
                drops[page].add(id(node))
    out = []
    for tree, drop in zip(trees, drops, strict=True):
        drop |= doubtful(tree, drop)
        out.append("\n\n".join(b for top in content(tree, len(set(kinds)) > 1) for b in blocks(top, drop)))
    return out


def content(root: Node, compared: bool) -> list[Node]:
    """The nodes of a page that hold its content: all of it where pages were compared, as the wrapper tells the template.

    Where all pages are of one kind nothing is known to vary; there the outermost main and article elements hold it, if any do.
    """
    if compared:
        return [root]
    found, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.never or x.doubtful and x is not root:
            continue
        if x.tag in ("article", "main") and blocks(x, set()):
            found.append(x)
        else:
            stack.extend(c for c in x.children[::-1] if isinstance(c, Node))
    return found or [root]


def _extract_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["page_id", "url", "html"], na_position="last", kind="mergesort")
    texts = extract(list(pdf["html"]))
    return pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": texts})


def extract_pages(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``page_id, url, html``.

    The host is what the URL has between ``//`` and the next ``/``, ``?`` or ``#``, in lower case;
    pages without one are a group of their own. Null html is empty; a page without content has text
    ``''``. A page that is alone in its group is extracted by its elements only. Copies of a page give
    equal rows. An empty table gives an empty result; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"//([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    counts = rows.groupBy("host").agg(F.ceil(F.count("*") / group).cast("long").alias("groups"))
    # The counts are written first: Spark then knows their size, and broadcasts them if they are small.
    counts = materialize(counts, "hosts")
    # One column names the group: pages dealt by host for the join must be dealt anew.
    g = F.pmod(F.xxhash64("page_id", "url", "html"), F.col("groups")).cast("string")
    dealt = rows.join(counts, "host").select("page_id", "url", "html", F.concat_ws("#", "host", g).alias("dealt"))
    out = dealt.groupBy("dealt").applyInPandas(_extract_group, schema("page_id bigint, url string, text string"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op6_html(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
