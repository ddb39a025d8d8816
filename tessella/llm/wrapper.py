"""Main text of web pages by wrapper induction.

Every page becomes a tree of its block elements with text leaves (inline markup belongs to the text around it). A host's pages
are grouped by layout (the label paths of their blocks); one page of each of its ``LAYOUTS`` most frequent layouts is a pivot. A
page is aligned with the pivot of its layout, or with the one that matches it best, by simple tree matching: a top-down
alignment of equal labels in which the children of two matched nodes are matched in order so that the number of matched nodes
below is largest; of equal alignments the one with more equal subtrees wins.

The pivot's text leaves are the wrapper's slots. A slot whose texts recur, each on many pages of the host, on nearly all of its
pages is template: constant notices and menus as well as adverts that take turns. A slot whose texts vary carries content.
Pages with equal remaining text count once, so mirrored articles don't become template. Leaves inside a marked article are
never template, nor evidence of one: versions of one article would agree on them.

What no induction can tell is told by rules: semantic elements and roles (nav, footer, aside, forms, hidden parts), and slots
that vary from page to page although they aren't content (reader comments, adverts) by class and id names. A name counts only
if all of its words are known ones ("comment-list", but not "comment-on-law"), never for an article or main part as a whole,
and not at all if names would leave nothing of a page. If a page marks its articles or main part, only these are content, and of
what stands right before them what the wrapper finds to vary (a headline); otherwise all of the page is.

A pivot tree is a few kB; pivots are broadcast only if all of them together are below ``broadcast_bytes`` and joined by
host otherwise. No task holds a host's pages. Parsing takes linear time and no step recurses, so pages may be as deep or wide as
they like.

Defined results: a null or empty html, or one without content, has an empty text and 0 characters; pages with a null url,
or one without a host, form one host; repeated rows each get their own, equal results; an empty table gives an empty one. A
host with fewer than ``min_pages`` pages has no wrapper; there only the rules apply.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*)/?>|<![^>]*>|<\?[^>]*>""", re.DOTALL)
NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|itemprop|type)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
DIGITS = re.compile(r"\d+")
#: Elements that end a text block and open one of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select canvas audio video xmp noembed noframes".split())
#: Elements that are never content.
DROPPED = frozenset("head nav footer aside form dialog menu fieldset legend".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id names that mark what is not content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promoted promotion sidebar sidebars nav navbar navigation "
    "menu menus breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices notification notifications popup popups modal overlay banner banners "
    "newsletter newsletters subscribe subscription signup login social share sharing shares related recommended recommendations comment comments reply replies respond responses disqus "
    "discussion discussions feedback widget widgets pagination pager toolbar search skip hidden alert alerts warning disclaimer copyright tags toc outbrain taboola paywall teaser teasers".split()
)
#: Words that say nothing by themselves: a name of marks and such words is a mark.
NEUTRAL = frozenset(
    "list lists area section box boxes wrapper wrap container block blocks top bottom left right item items inner outer unit slot slots bar bars form forms link links thread holder "
    "panel module group column col row grid main primary secondary content body head title count text label icon icons button buttons btn site page global sticky fixed floating "
    "mobile desktop small large first last all my the js reader readers user users id".split()
)
#: Words that turn a mark into a remark about another element (has-sidebar, no-ads), words for articles: their headers are
#: content, and what an article's own names may mark it as.
REMARKS = frozenset("has with no without not".split())
OF_ARTICLES = frozenset("article post entry story content".split())
NO_ARTICLE = frozenset("comment comments reply replies teaser teasers related promo sponsored ad advert advertisement".split())
CLOSES_P = BLOCKS - {"option", "optgroup", "html", "head", "body", "title"}
#: An opening tag ends an open element of these, up to the given container.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.IGNORECASE) for t in RAW}
#: Pivots of a host at most, and depth of the paths that tell layouts apart.
LAYOUTS, PATH_DEPTH = 3, 5


@dataclass
class Tree:
    """Nodes in page order, children after their parents.

    Each has a label, children, a text (leaves) and its hash, whether rules or names speak against it, whether it is in an
    article, in a marked part (article or main), or right before one, whether its text is mostly links, and whether it is in an
    article or main part that only the names of blocks around it speak against.
    """

    label: list[str] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    hash: list[int] = field(default_factory=list)
    out: list[bool] = field(default_factory=list)
    named: list[bool] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)
    part: list[bool] = field(default_factory=list)
    links: list[bool] = field(default_factory=list)
    shadow: list[bool] = field(default_factory=list)
    before: set[int] = field(default_factory=set)

    def add(self, parent: int, label: str, text: str = "", out=False, named=False, article=False, part=False, links=False, shadow=False) -> int:
        k = len(self.label)
        self.label.append(label)
        self.children.append([])
        self.text.append(text)
        self.hash.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) if text else 0)
        self.out.append(out)
        self.named.append(named)
        self.article.append(article)
        self.part.append(part)
        self.links.append(links)
        self.shadow.append(shadow)
        if parent >= 0:
            self.children[parent].append(k)
        return k


@lru_cache(maxsize=10_000)
def _word_kind(word: str) -> str:
    """"mark", "neutral" or "other"; two known words written as one count as both."""
    if word in MARKS:
        return "mark"
    if word in NEUTRAL or word in OF_ARTICLES or word.isdigit():
        return "neutral"
    for k in range(2, len(word) - 1):
        if word[:k] in MARKS and (word[k:] in NEUTRAL or word[k:] in MARKS):
            return "mark"
    return "other"


@lru_cache(maxsize=50_000)
def _marked(value: str, inside: bool, whole: bool) -> bool:
    """Whether a class or id names something that is not content; ``whole``: of an article."""
    for name in value.split():
        words = [w.lower() for w in PART.findall(name)]
        if not words or not REMARKS.isdisjoint(words):
            continue
        if whole:
            if not NO_ARTICLE.isdisjoint(words) and all(w in NO_ARTICLE or _word_kind(w) == "neutral" for w in words):
                return True
            continue
        if inside or not OF_ARTICLES.isdisjoint(words):
            words = [w for w in words if w != "header"]  # an article's own header
        kinds = [_word_kind(w) for w in words]
        if "mark" in kinds and "other" not in kinds:
            return True
    return False


@lru_cache(maxsize=50_000)
def _judged(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool, bool, str]:
    """(ruled out, ruled out by name, marks an article, marks a main part, label) of an element."""
    label, out, named = tag, tag in DROPPED or (tag == "header" and not inside), False
    article, main = tag == "article", tag == "main"
    if attributes and not attributes.isspace():
        for name, a, b, c in NAMES.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                if name == "class":
                    label = f"{tag}.{value.strip().lower()}"
                if tag not in ("html", "body", "main"):
                    named = named or _marked(value, inside, tag == "article")
            elif name == "role":
                out = out or value.lower() in ROLES
                main = main or value.lower() == "main"
                article = article or value.lower() == "article"
            elif name == "itemprop":
                article = article or value.lower() == "articlebody"
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                out = out or tag not in ("html", "body")
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                out = True
    return out, named, article, main, label


@dataclass
class Open:
    """An open element, with what its leaves inherit."""

    node: int
    tag: str
    out: bool = False
    named: bool = False
    article: bool = False
    part: bool = False
    shadow: bool = False


def parse(page: str) -> Tree:
    """The block tree of a page; unclosed and crossing elements are closed as browsers do, more or less."""
    tree = Tree()
    stack = [Open(tree.add(-1, "#root"), "#root")]
    is_open: Counter[str] = Counter()
    pieces: list[str] = []
    linked: list[str] = []
    in_link = False
    skipped: list = []  # tag, depth, pieces and linked before an inline element that is ruled out

    def flush():
        skipped.clear()  # it does not end in this block: its text stays
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            share = sum(len(x.strip()) for x in linked) / max(1, sum(len(x.strip()) for x in pieces)) if linked else 0.0
            pieces.clear()
            linked.clear()
            if text:
                at = stack[-1]
                tree.add(at.node, "#text", text, at.out, at.named, at.article, at.part, share > 0.6, at.shadow)

    def pop(size: int) -> None:
        while len(stack) > size:
            is_open[stack.pop().tag] -= 1

    def close(tags: set, within: set) -> None:
        if not any(is_open[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in within:
                return
            if stack[k].tag in tags:
                flush()
                pop(k)
                return

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at : m.start()])
            if in_link:
                linked.append(pieces[-1])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "a" or tag in BLOCKS:
            in_link = tag == "a" and not m[1]
        if m[1]:
            if skipped and tag == skipped[0]:
                skipped[1] -= 1
                if not skipped[1]:
                    del pieces[skipped[2] :], linked[skipped[3] :]
                    skipped.clear()
            if tag in BLOCKS and is_open[tag]:
                flush()
                while stack[-1].tag != tag:
                    pop(len(stack) - 1)
                pop(len(stack) - 1)
            continue
        if tag in RAW:
            done = RAW_END[tag].search(page, at)
            at = done.end() if done else end
            pieces.append(" ")
            continue
        if tag == "br" or tag in VOID and tag != "hr":
            pieces.append(" " if tag in ("br", "img", "input", "embed") else "")
            continue
        if tag == "hr":
            flush()
            continue
        if tag not in BLOCKS:
            if skipped:
                skipped[1] += tag == skipped[0]
            elif m[3] and not stack[-1].out:
                ruled, named, *_ = _judged(tag, m[3], stack[-1].part)
                if ruled or named:  # an inline element that is not content: dropped if it ends in this block
                    skipped += [tag, 1, len(pieces), len(linked)]
            continue
        if tag in CLOSES_P:
            close({"p"}, {"td", "th", "table", "article", "body"})
        if tag in SIBLINGS:
            close(*SIBLINGS[tag])
        flush()
        over = stack[-1]
        ruled, named, article, main, label = _judged(tag, m[3] or "", over.part)
        here = Open(-1, tag, over.out or ruled, over.named or named, over.article, over.part, over.shadow and not named)
        if (article or main) and tag != "body" and not here.out:
            here.shadow = here.shadow or (over.named and not named)
            if not here.named:
                here.article, here.part = over.article or article, True
                if not over.part:
                    tree.before.update(tree.children[over.node])
        here.node = tree.add(over.node, label, "", here.out, here.named, here.article, here.part)
        stack.append(here)
        is_open[tag] += 1
    flush()
    return tree


def candidates(tree: Tree) -> list[tuple[int, bool, bool]]:
    """(leaf, kept unless the wrapper says template, whether the wrapper has a say) of the leaves that may be content.

    Outside of an article, leaves that are mostly links are menus.
    """
    leaves = [k for k, t in enumerate(tree.label) if t == "#text" and not tree.out[k]]
    plain = [k for k in leaves if not tree.named[k]]
    marked = any(tree.part[k] for k in plain)
    if not marked and any(tree.shadow[k] for k in leaves):  # names would leave nothing of the article
        return [(k, True, False) for k in leaves if tree.shadow[k]]
    if not plain:  # nor of the page
        return [(k, True, False) for k in leaves if not tree.links[k]]
    early: set[int] = set()
    if marked:
        todo = list(tree.before)
        while todo:
            k = todo.pop()
            if k not in early:
                early.add(k)
                todo += tree.children[k]
    out = []
    for k in plain:
        if tree.article[k]:
            out.append((k, True, False))
        elif not tree.links[k] and (tree.part[k] or not marked or k in early):
            out.append((k, tree.part[k] or not marked, True))
    return out


def content(tree: Tree) -> list[int]:
    """The leaves that are content as far as the rules can tell, without a wrapper."""
    return [k for k, keep, _ in candidates(tree) if keep]


def skeleton(tree: Tree) -> tuple[Tree, dict[int, int]]:
    """The tree without what is in articles, and where its nodes went."""
    out, place = Tree(), {0: 0}
    out.add(-1, tree.label[0])
    for k in range(len(tree.label)):  # parents come first
        if k in place and not tree.article[k]:
            for c in tree.children[k]:
                place[c] = out.add(place[k], tree.label[c])
                out.hash[place[c]] = tree.hash[c]
    return out, place


def layout(tree: Tree) -> int:
    """A hash of the label paths of a skeleton's upper blocks, digits aside."""
    level, paths = [(0, "")], set()
    for _ in range(PATH_DEPTH):
        level = [(c, f"{path}/{DIGITS.sub('', tree.label[c])}") for k, path in level for c in tree.children[k] if tree.label[c] != "#text"]
        paths.update(path for _, path in level)
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"))


def _best(left, right, weights) -> np.ndarray:
    """Best sums of weights of an order-preserving matching of all of ``left`` with each prefix of ``right``."""
    if len(left) * len(right) <= 256:  # short lists: plain loops are faster
        best = [0] * (len(right) + 1)
        for i in left:
            diagonal = 0
            for k, w in enumerate(weights(i)):
                was = best[k + 1]
                best[k + 1] = max(was, best[k], diagonal + w)
                diagonal = was
        return np.array(best)
    wide = np.zeros(len(right) + 1, np.int64)
    for i in left:
        wide[1:] = np.maximum(wide[1:], wide[:-1] + np.array(weights(i), np.int64))
        np.maximum.accumulate(wide, out=wide)
    return wide


class Matching:
    """Simple tree matching of two trees: ``pairs`` maps nodes of ``b`` to nodes of ``a``.

    How many nodes two subtrees have in common depends on their shapes only, so it is worked out once for each pair of shapes.
    """

    def __init__(self, a: Tree, b: Tree):
        self.shapes: list[tuple[str, tuple[int, ...]]] = []
        self.sizes: list[int] = []
        self.known: dict[tuple[int, int], int] = {}
        shapes: dict = {}
        equals: dict = {}
        self.a, self.b = self._folded(a, shapes, equals), self._folded(b, shapes, equals)
        self.pairs, self.nodes = {0: 0}, self.weigh(self.a[0][0], self.b[0][0])
        todo = [(0, 0)]
        while todo:
            x, y = todo.pop()
            for i, j in self.aligned(a.children[x], b.children[y]):
                self.pairs[j] = i
                todo.append((i, j))

    def _folded(self, tree: Tree, shapes: dict, equals: dict):
        """By node: its shape, a number that equal subtrees (texts included) share, and its number of texts."""
        n = len(tree.label)
        shape, equal, texts = [0] * n, [0] * n, [0] * n
        for k in range(n - 1, -1, -1):
            below = tree.children[k]
            key = tree.label[k], tuple(shape[c] for c in below)
            if key not in shapes:
                shapes[key] = len(self.shapes)
                self.shapes.append(key)
                self.sizes.append(1 + sum(self.sizes[c] for c in key[1]))
            shape[k] = shapes[key]
            equal[k] = equals.setdefault((tree.label[k], tree.hash[k], tuple(equal[c] for c in below)), len(equals))
            texts[k] = (tree.hash[k] != 0) + sum(texts[c] for c in below)
        return shape, equal, texts

    def plain(self, x: int, y: int) -> int | None:
        """Nodes in common of two shapes where no alignment is needed to tell, or None."""
        (label, left), (other, right) = self.shapes[x], self.shapes[y]
        if label != other:
            return 0
        if x == y:
            return self.sizes[x]
        return 1 if not left or not right else self.known.get((x, y))

    def weigh(self, x: int, y: int) -> int:
        """Nodes that a matching of two shapes pairs at most."""
        todo = [(x, y)]
        while todo:
            i, j = todo[-1]
            if self.plain(i, j) is not None:
                todo.pop()
                continue
            left, right = self.shapes[i][1], self.shapes[j][1]
            open_pairs = [(c, d) for c in set(left) for d in set(right) if self.plain(c, d) is None]
            if open_pairs:
                todo += open_pairs
                continue
            self.known[i, j] = 1 + int(_best(left, right, lambda c: self._row_of(c, right))[-1])
            todo.pop()
        return self.plain(x, y)

    def _row_of(self, c: int, right: tuple[int, ...]) -> list[int]:
        by_shape = {d: self.plain(c, d) for d in set(right)}
        return [by_shape[d] for d in right]

    def weights(self, i: int, right: list[int]) -> list[int]:
        """Of one node of ``a`` with nodes of ``b``: nodes in common first, equal texts second."""
        (shape, equal, texts), (shapes, equals, _) = self.a, self.b
        by_shape = {s: self.weigh(shape[i], s) << 24 for s in {shapes[j] for j in right}}
        return [by_shape[shapes[j]] + (texts[i] if equals[j] == equal[i] else 0) for j in right]

    def row(self, left: list[int], right: list[int]) -> np.ndarray:
        """Best weights of matching all of ``left`` with each prefix of ``right``."""
        return _best(left, right, lambda i: self.weights(i, right))

    def aligned(self, left: list[int], right: list[int]) -> list[tuple[int, int]]:
        """Matched children, in order: equal subtrees at both ends first, which loses nothing, then divide and conquer.

        Lists of equal shapes are matched one by one: no other alignment has as many nodes.
        """
        out: list[tuple[int, int]] = []
        todo = [(left, right)]
        while todo:
            left, right = todo.pop()
            a, b = self.a[1], self.b[1]
            n = 0
            while n < min(len(left), len(right)) and a[left[n]] == b[right[n]]:
                out.append((left[n], right[n]))
                n += 1
            left, right = left[n:], right[n:]
            n = 0
            while n < min(len(left), len(right)) and a[left[-1 - n]] == b[right[-1 - n]]:
                out.append((left[-1 - n], right[-1 - n]))
                n += 1
            left, right = left[: len(left) - n], right[: len(right) - n]
            if not left or not right:
                continue
            if len(left) == len(right) and all(self.a[0][i] == self.b[0][j] for i, j in zip(left, right, strict=True)):
                out += zip(left, right, strict=True)
                continue
            if len(left) == 1:
                w = self.weights(left[0], right)
                if max(w) > 0:
                    out.append((left[0], right[w.index(max(w))]))
                continue
            mid = len(left) // 2
            above = self.row(left[:mid], right)
            below = self.row(left[mid:][::-1], right[::-1])[::-1]
            cut = int((above + below).argmax())
            todo += [(left[:mid], right[:cut]), (left[mid:], right[cut:])]
        return out


def dump(tree: Tree) -> str:
    """A skeleton without its texts (their hashes stay)."""
    return json.dumps([tree.label, tree.children, tree.hash])


def load(text: str) -> Tree:
    label, children, hashes = json.loads(text)
    return Tree(label=label, children=children, hash=hashes)


def host() -> Column:
    """Lower-cased host of ``url``, without user and port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def layouts(pages: DataFrame, flush_rows: int = 20_000) -> DataFrame:
    """(host, layout, n, k): pages of each layout of a host, and the smallest content hash among them."""

    def run(batches):
        found: dict[tuple[str, int], list[int]] = {}

        def flush():
            rows = [(h, at - (1 << 63), n, k) for (h, at), (n, k) in found.items()]
            found.clear()
            columns = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["host", "layout", "n", "k"])

        for b in batches:
            for h, k, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                own = found.setdefault((h, layout(skeleton(parse(t))[0])), [0, k])
                own[0] += 1
                own[1] = min(own[1], k)
            if len(found) > flush_rows:
                yield flush()
        yield flush()

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    rows = pages.select("host", "k", "html").filter("html <> ''").mapInArrow(run, "host string, layout long, n long, k long")
    return rows.groupBy("host", "layout").agg(F.sum("n").alias("n"), F.min("k").alias("k"))


def pivots(pages: DataFrame, scratch: Scratch, min_pages: int, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(host, pivots): for each host of at least ``min_pages`` pages its pivots, each (layout, tree), the most frequent first."""
    by_layout = scratch.table(layouts(pages).withColumn("x", F.struct("n", "k", "layout")))
    chosen = by_layout.groupBy("host").agg(F.max("x").alias("x"), F.sum("n").alias("all")).filter(F.col("all") >= min_pages).select("host", "x")
    found = last = scratch.table(chosen)
    for _ in range(LAYOUTS - 1):
        less = by_layout.filter(F.col("n") >= min_pages).join(last.select("host", F.col("x").alias("y")), "host").filter("x < y")
        last = scratch.table(less.groupBy("host").agg(F.max("x").alias("x")))
        found = found.unionByName(last)
    found = found.select("host", "x.n", "x.k", "x.layout")
    few = found.count() <= broadcast_rows
    one_page = pages.filter("html <> ''").join(F.broadcast(found) if few else found, ["host", "k"]).dropDuplicates(["host", "k", "layout"])

    def run(batches):
        for b in batches:
            trees = [dump(skeleton(parse(t))[0]) for t in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(trees, pa.string())], ["host", "n", "k", "layout", "tree"])

    trees = one_page.select("host", "n", "k", "layout", "html").mapInArrow(run, "host string, n long, k long, layout long, tree string")
    ordered = F.reverse(F.array_sort(F.collect_list(F.struct("n", "k", "layout", "tree"))))  # at most LAYOUTS
    return trees.groupBy("host").agg(F.transform(ordered, lambda x: F.struct(x["layout"].alias("layout"), x["tree"].alias("tree"))).alias("pivots"))


def aligned_blocks(pages: DataFrame) -> DataFrame:
    """Pages with the blocks that may be content: texts, whether each is kept by default, the number of the pivot, and for each
    block the pivot's node that it is matched to (-1: none) and its text's hash."""

    def run(batches):
        cache: dict[str, Tree] = {}

        def tree_of(text: str) -> Tree:
            if text not in cache:
                if len(cache) > 500:
                    cache.clear()
                cache[text] = load(text)
            return cache[text]

        def aligned(tree: Tree, own_pivots, ask: bool):
            if not own_pivots or not ask:
                return -1, {}
            bare, place = skeleton(tree)
            own = layout(bare) - (1 << 63)
            which = [i for i, p in enumerate(own_pivots) if p["layout"] == own] or range(len(own_pivots))
            tried = [(i, Matching(tree_of(own_pivots[i]["tree"]), bare)) for i in which]
            number, best = max(tried, key=lambda x: (x[1].nodes, -x[0]))
            return number, {k: best.pairs[j] for k, j in place.items() if j in best.pairs}

        for b in batches:
            col = lambda name, b=b: b.column(b.schema.get_field_index(name)).to_pylist()
            rows = []
            for page, own_pivots in zip(col("html"), col("pivots"), strict=True):
                tree = parse(page)
                keep = candidates(tree)
                number, pairs = aligned(tree, own_pivots, any(ask for _, _, ask in keep))
                nodes = [pairs.get(k, -1) if ask else -1 for k, _, ask in keep]
                hashes = [tree.hash[k] - (1 << 63) for k, _, _ in keep]
                rows.append((number, [tree.text[k] for k, _, _ in keep], [d for _, d, _ in keep], nodes, hashes))
            head = [b.column(b.schema.get_field_index(x)) for x in ("page_id", "url", "host")]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*head, *arrays], ["page_id", "url", "host", "pivot", "texts", "keep", "nodes", "hashes"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, url string, host string, pivot int, texts array<string>, keep array<boolean>, nodes array<int>, hashes array<long>"
    return pages.mapInArrow(run, schema)


def slots(blocks: DataFrame, min_pages: int, share: float) -> DataFrame:
    """(host, pivot, template, content): the pivot's nodes whose texts recur on nearly all pages, and those whose texts vary."""
    once = blocks.filter("pivot >= 0").groupBy("host", "pivot", F.xxhash64("texts").alias("k")).agg(F.min(F.struct("nodes", "hashes")).alias("x"))
    once = once.filter(F.exists("x.nodes", lambda k: k >= 0))
    pages = once.groupBy("host", "pivot").agg(F.count("*").alias("pages"))
    leaves = once.select("host", "pivot", F.explode(F.arrays_zip("x.nodes", "x.hashes")).alias("y")).filter("y.nodes >= 0")
    values = leaves.groupBy("host", "pivot", F.col("y.nodes").alias("node"), F.col("y.hashes").alias("hash")).agg(F.count("*").alias("c"))
    recurs = F.col("c") >= F.greatest(F.lit(3), F.col("pages") / 10)
    seen = values.join(pages, ["host", "pivot"]).groupBy("host", "pivot", "node", "pages")
    judged = seen.agg(F.sum("c").alias("n"), F.sum(F.when(recurs, F.col("c")).otherwise(0)).alias("r")).filter(F.col("n") >= min_pages)
    template, varying = F.col("r") >= share * F.col("pages"), F.col("r") < 0.5 * F.col("n")
    nodes = lambda which: F.collect_list(F.when(which, F.col("node")))  # noqa: E731  at most the leaves of a pivot
    return judged.groupBy("host", "pivot").agg(nodes(template).alias("template"), nodes(varying & ~template).alias("content"))


def main_text(pages: DataFrame, min_pages: int = 5, share: float = 0.8, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(page_id, url, text, n_chars): the article of every page."""
    scratch = Scratch(pages.sparkSession)
    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host")).withColumn("k", F.xxhash64("html"))
    chosen = scratch.table(pivots(read, scratch, min_pages))
    size = chosen.agg(F.coalesce(F.sum(F.length(F.to_json("pivots")) + 64), F.lit(0))).first()[0]
    small = (lambda df: F.broadcast(df)) if size <= broadcast_bytes else (lambda df: df)
    blocks = scratch.table(aligned_blocks(read.join(small(chosen), "host", "left")), keep=True)
    verdicts = scratch.table(slots(blocks, min_pages, share), keep=True)
    scratch.clear()
    none = F.array().cast("array<int>")
    both = blocks.join(small(verdicts), ["host", "pivot"], "left").withColumns({c: F.coalesce(c, none) for c in ("template", "content")})
    is_in = lambda c, b: F.array_contains(F.col(c), b["nodes"])
    rest = F.filter(F.arrays_zip("texts", "nodes", "keep"), lambda b: ~is_in("template", b) & (b["keep"] | is_in("content", b)))
    text = F.array_join(F.transform(rest, lambda b: b["texts"]), "\n")
    return both.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
