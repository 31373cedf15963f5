"""Main text of web pages by wrapper induction.

For each host a few pages of different main text are picked by a hash (``sample`` at most,
a bound of the method: a wrapper is a small template; copies count once). Their DOM trees are aligned
with the one most like the others by simple tree matching, a dynamic program over the
children of equally named nodes. Matched nodes are the wrapper's slots: slots that hold the
same text in most pages, from two up, are template, the others vary. Paragraphs, headings and
the like that stand among varying ones, or in the main region, are never template: an
article's licence line stays, however many pages have it. Each slot is known by its path of tags and classes. Slots
under elements whose name or class says that they are not content (menus, headers, footers,
notices, adverts, forms, comments, ...) are no content, but a class or id does not hide an
element that holds most of a page's text. Among the remaining paths the wrapper's main
region is the ``article`` or ``main`` element with most of the varying text, or else the
smallest element that holds all of it.

A page's text is that of its nodes in the main region, without template blocks and without elements that are no content. If
the element with the most constant text has more of it than all that varies, it holds an
article that all pages carry and is no template. A page that has much text elsewhere, or whose
host has no wrapper, is judged by itself in the same way; text is template only as
long as a page has other text.

References are decoded; white space inside a block becomes one space, blocks are joined by
one space. Nothing is dropped for its length. A null or empty page gives an empty text; a
null url is a host of its own kind. Every input row gives one output row.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Pages that are looked at for each one sampled, as copies of one main text count once.
CANDIDATES = 4
#: Share of the text that an article or main element must hold to be the region, and that
#: a page must have in its host's region for it to be taken from there.
MAIN_SHARE = 0.8
#: Children of one node that simple tree matching aligns by its dynamic program; longer
#: lists are aligned in order of names, so the work stays in proportion to the page.
ALIGN = 200

# Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
NOT_CONTENT = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea input label fieldset iframe"
    " object embed svg canvas audio video map menu dialog".split()
)
NOT_CONTENT_CLASSES = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " notification alert popup modal overlay newsletter subscribe signup login menu nav navbar navigation breadcrumb breadcrumbs"
    " sidebar side aside footer foot header masthead topbar toolbar share sharing social comment comments disqus reply replies"
    " related recommended widget pagination pager search form copyright skip".split()
)
#: Elements that their names never make no content.
WHOLE = frozenset("#root html body main article".split())
_DIGITS = re.compile(r"[0-9]+")

#: An open element that a new one of these closes.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}


class Node:
    __slots__ = ("tag", "key", "children", "content", "named")

    def __init__(self, tag: str, attrs=()):
        self.tag = tag
        given = dict(attrs)
        names = ((given.get("class") or "") + " " + (given.get("id") or "") + " " + (given.get("role") or "")).lower().split()
        self.key = ".".join([tag, *[_DIGITS.sub("0", name) for name in names]])  # post-17 and post-18 are one slot
        parts = {part for name in names for part in name.replace("_", "-").split("-")}
        hidden = "hidden" in given or (given.get("aria-hidden") or "").lower() == "true"
        self.content = not (tag in NOT_CONTENT or hidden)
        #: By name no content, which parse() follows unless most of the page's text is in it.
        self.named = self.content and tag not in WHOLE and bool(parts & NOT_CONTENT_CLASSES)
        self.children: list = []  # nodes and strings


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS and tag != "br":
            self._close_to({"p"}, {"table", "td", "th", "button", "article", "section", "div", "body", "li", "#root"})
        if tag in _CLOSES:
            self._close_to(_CLOSES[tag], {"table", "ul", "ol", "dl", "select", "#root"}, every=True)
        node = Node(tag, attrs)
        if tag == "header" and not any(x.tag in ("article", "main") for x in self.open):
            node.content = False  # the page's header, not an article's
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in ("article", "table") and tag not in ("body", "html", "main", "section", "div", "article"):
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def _close_to(self, tags, stops, every=False):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                if not every:
                    return
            elif self.open[k].tag in stops:
                return


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    _leave_out(builder.root)
    return builder.root


def _leave_out(root: Node) -> None:
    """Elements whose names say that they are no content become such, but for those that
    hold most of the page's text. Where an article or main element has text outside all of
    them, an element without one (long comments) is left out whatever it holds."""
    order: list[tuple[Node, int, bool]] = []  # node, place of its parent, inside a named one
    todo = [(root, -1, False)]
    while todo:
        node, parent, inside = todo.pop()
        at = len(order)
        order.append((node, parent, inside or node.named))
        todo.extend((x, at, inside or node.named) for x in node.children if isinstance(x, Node) and x.content)
    if not any(node.named for node, *_ in order):
        return
    size, article, outside = [0] * len(order), [False] * len(order), False
    for k in range(len(order) - 1, -1, -1):
        node, parent, inside = order[k]
        size[k] += sum(len(x.strip()) for x in node.children if isinstance(x, str))
        article[k] |= node.tag in ("article", "main") and size[k] > 0
        outside |= article[k] and not inside
        if parent >= 0:
            size[parent] += size[k]
            article[parent] |= article[k]
    for k, (node, _, _) in enumerate(order):
        if node.named and (2 * size[k] <= size[0] or outside and not article[k]):
            node.content = False


def _pieces(node: Node, skip=frozenset(), path: str = "") -> list[str]:
    """A node's text in page order, block boundaries as white space, without elements that
    are no content and without (path, text) pairs in ``skip``. Not recursive: pages may nest
    without end."""
    out, todo, paths = [], [(node, path, 0)], {p for p, _ in skip}
    while todo:
        now, at, k = todo.pop()
        if isinstance(now, str):
            out.append(now)
            continue
        if k == 0 and at in paths and (at, plain(now)) in skip:
            out.append(" ")
            continue
        block = now.tag in BLOCKS
        if block:
            out.append(" ")
        rest = [(x, "" if isinstance(x, str) else at + "/" + x.key, 0) for x in now.children if isinstance(x, str) or x.content]
        if block:
            rest.append((" ", "", 0))
        todo.extend(reversed(rest))
    return out


def plain(node: Node) -> str:
    return " ".join("".join(_pieces(node)).split())


def _below(node: Node, path: str):
    """(path, child) of a node's content children."""
    return [(path + "/" + x.key, x) for x in node.children if isinstance(x, Node) and x.content]


def tree_match(a: Node, b: Node, path: str, found: list[tuple[str, Node, Node]]) -> int:
    """Simple tree matching: the size of the largest order-keeping match of two trees whose
    roots have equal names; matched pairs go to ``found``."""
    if a.key != b.key:
        return 0
    found.append((path, a, b))
    left, right = [x for _, x in _below(a, path)], [x for _, x in _below(b, path)]
    if not left or not right or path.count("/") > ALIGN:
        return 1
    if len(left) > ALIGN or len(right) > ALIGN:
        queue: dict[str, list[Node]] = {}
        for y in reversed(right):
            queue.setdefault(y.key, []).append(y)
        pairs = [(x, queue[x.key].pop()) for x in left if queue.get(x.key)]
    else:
        weight = {}
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if x.key == y.key:
                    own: list = []
                    weight[i, j] = (tree_match(x, y, path + "/" + x.key, own), own)
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i in range(len(left)):
            for j in range(len(right)):
                w = weight.get((i, j), (0,))[0]
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
        total, i, j = 1 + best[-1][-1], len(left), len(right)
        while i and j:
            w = weight.get((i - 1, j - 1), (0,))[0]
            if w and best[i][j] == best[i - 1][j - 1] + w:
                found.extend(weight[i - 1, j - 1][1])
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return total
    return 1 + sum(tree_match(x, y, path + "/" + x.key, found) for x, y in pairs)


def main_path(masses: dict[str, int]) -> str:
    """The outermost ``article`` or ``main`` path that holds most of the text; else from the
    top the child path that holds all of it, as long as one does, so that no text is lost."""
    tag = lambda path: path.rpartition("/")[2].split(".")[0]
    whole = [p for p, n in masses.items() if tag(p) in ("article", "main") and n >= MAIN_SHARE * masses[""]]
    if whole:
        return min(whole, key=lambda p: (p.count("/"), p))
    below: dict[str, list[str]] = {}
    for p in masses:
        below.setdefault(p.rpartition("/")[0], []).append(p)
    at = ""
    while True:
        best = max(sorted(p for p in below.get(at, ()) if p), key=lambda p: masses[p], default="")
        if not best or masses[best] < masses[at] or tag(best) in _FINE:
            return at
        at = best


#: Elements that make up a text rather than hold one.
_FINE = frozenset("p h1 h2 h3 h4 h5 h6 b i em strong a span ul ol li dl dt dd blockquote pre table tbody thead tr td th br hr img figure".split())


def _masses(root: Node, constant: frozenset) -> dict[str, int]:
    """Letters of varying text at or below each path."""
    out: dict[str, int] = {}
    paths = {p for p, _ in constant}
    todo = [(root, "", [""])]
    while todo:
        node, path, above = todo.pop()
        if path in paths and (path, plain(node)) in constant:
            continue
        own = sum(len(x.strip()) for x in node.children if isinstance(x, str))
        if own:
            for p in above:
                out[p] = out.get(p, 0) + own
        for p, x in _below(node, path):
            todo.append((x, p, [*above, p] if p.count("/") <= ALIGN else above))
    return out


def _own_text(root: Node) -> str:
    """A page's main text, judged by itself."""
    path = main_path(_masses(root, frozenset()))
    return " ".join(plain(x) for _, x in _at(root, path))


def _distinct(pages: list[str], sample: int) -> list[Node]:
    """The first ``sample`` pages of different main text; copies of one text count once."""
    trees: dict[str, Node] = {}
    for page in pages:
        if len(trees) == sample:
            break
        root = parse(page)
        trees.setdefault(_own_text(root), root)
    return list(trees.values())


def _holder(path: str) -> str:
    """The path of the element that holds the text a path is part of."""
    keys = path.split("/")
    while len(keys) > 1 and keys[-1].split(".")[0] in _FINE:
        keys.pop()
    return "/".join(keys)


def _without_article(trees: list[Node], constant: frozenset) -> frozenset:
    """``constant`` without the slots that hold an article all pages carry: those at, below
    and above the element with the most constant text, if that is more than all text that
    varies."""
    held: dict[str, int] = {}
    varying = 0
    paths = {p for p, _ in constant}
    for tree in trees:
        todo = [(tree, "", False)]
        while todo:
            node, path, inside = todo.pop()
            inside = inside or (path in paths and (path, plain(node)) in constant)
            own = sum(len(x.strip()) for x in node.children if isinstance(x, str))
            if inside and own:
                held[_holder(path)] = held.get(_holder(path), 0) + own
            elif own:
                varying += own
            todo.extend((x, p, inside) for p, x in _below(node, path))
    if not held or max(held.values()) <= varying:
        return constant
    at = max(sorted(held), key=lambda p: held[p])
    return frozenset(s for s in constant if not (s[0] + "/").startswith(at + "/") and not (at + "/").startswith(s[0] + "/"))


def _slots(root: Node) -> set[tuple[str, str]]:
    """(path, text) of a page's blocks."""
    out, todo = set(), [("", root)]
    while todo:
        path, node = todo.pop()
        if node.tag in BLOCKS and (text := plain(node)):  # words inside a block stay
            out.add((path, text))
        if path.count("/") <= ALIGN:
            todo.extend(_below(node, path))
    return out


def _agreed(trees: list[Node]) -> frozenset:
    """The slots of equal text in most pages, two at least. A paragraph, heading or item
    with others at its path that vary is an article's own, however many pages carry it."""
    slots = [_slots(tree) for tree in trees]
    paths = [{p for p, _ in x} for x in slots]
    alike = [sum(len(a & b) / max(1, len(a | b)) for b in paths) for a in paths]
    base = alike.index(max(alike)) if trees else 0  # the page most like the others
    same: dict[tuple[str, str], int] = {}
    for k, other in enumerate(trees):
        found: list = []
        if k != base:
            tree_match(trees[base], other, "", found)
            matched = {(path, plain(y)) for path, _, y in found if y.tag in BLOCKS}
        else:
            matched = slots[k]
        for slot in matched:
            same[slot] = same.get(slot, 0) + 1
    most = {s for s, n in same.items() if n >= 2 and 2 * n > len(trees) and s[1]}
    mixed = {s[0] for x in slots for s in x - most if s[0].rpartition("/")[2].split(".")[0] in _FINE}
    return frozenset(s for s in most if s[0] not in mixed)


def induce(pages: list[str], sample: int = 8) -> dict:
    """The wrapper of a host's pages: its main path and its constant slots (path, text)."""
    trees = _distinct(pages, sample)
    constant = _agreed(trees)
    constant = _without_article(trees, constant)
    masses: dict[str, int] = {}
    for tree in trees:
        for p, n in _masses(tree, constant).items():
            masses[p] = masses.get(p, 0) + n
    main = main_path(masses)
    # a paragraph, heading or list inside the main region is the article's, though all carry it
    own = {s for s in constant if s[0].startswith(main + "/") and s[0].rpartition("/")[2].split(".")[0] in _FINE}
    return {"main": main, "constant": constant - own}


def _at(root: Node, path: str) -> list[tuple[str, Node]]:
    """The nodes at a path."""
    now = [("", root)]
    for key in path.split("/")[1:]:
        now = [(p, x) for at, node in now for p, x in _below(node, at) if x.key == key]
    return now


def extract(html: str, wrapper: dict | None) -> str:
    """The main text of one page."""
    root = parse(html)
    constant = wrapper["constant"] if wrapper else frozenset()
    nodes = _at(root, wrapper["main"]) if wrapper else []
    text = _text(nodes, constant)
    masses = _masses(root, constant)
    held = masses.get(wrapper["main"], 0) if wrapper else 0
    if not text or held < MAIN_SHARE * masses.get("", 0):  # another layout: the page is judged by itself
        text = _text(_at(root, main_path(masses)), constant)
    return text or _text(_at(root, main_path(_masses(root, frozenset()))), frozenset())


def _text(nodes: list[tuple[str, Node]], constant: frozenset) -> str:
    return " ".join(" ".join("".join(_pieces(x, constant, p)) for p, x in nodes).split())


def _induce(sample: int):
    """Wrappers from sampled pages, a host's pages in one row."""

    def run(batches):
        for batch in batches:
            made = [induce(pages, sample) for pages in batch.column(1).to_pylist()]
            constant = [[{"path": p, "text": t} for p, t in sorted(m["constant"])] for m in made]
            kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m["main"] for m in made], pa.string()), pa.array(constant, kind)], names=["host", "main", "constant"])

    return run


def _extract(batches):
    for batch in batches:
        texts = []
        for html, main, constant in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            wrapper = None if main is None else {"main": main, "constant": frozenset((x["path"], x["text"]) for x in constant or ())}
            texts.append(extract(html, wrapper) if html else "")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def wrappers(pages: DataFrame, sample: int = 8) -> DataFrame:
    """host, main path, constant slots: a row per host."""
    hosts = pages.filter("html IS NOT NULL AND html <> ''").select(_host().alias("host"), "html", F.xxhash64("html").alias("h"))
    # copies of a page are one before pages are ranked, by hashes alone: no task gets them all
    order = Window.partitionBy("host").orderBy("h")
    picked = hosts.select("host", "h").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= CANDIDATES * sample)
    picked = c.written(picked.select("host", "h"), "sampled-pages")
    picked = hosts.join(picked, ["host", "h"]).groupBy("host", "h").agg(F.min("html").alias("html"))
    picked = picked.groupBy("host").agg(F.sort_array(F.collect_list("html")).alias("pages"))
    return picked.mapInArrow(_induce(sample), "host string, main string, constant array<struct<path:string,text:string>>")


def _host():
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.coalesce(host, F.lit(""))


def main_text(pages: DataFrame, sample: int = 8) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    c.small_batches(pages.sparkSession)
    found = c.written(wrappers(pages, sample), "wrappers")
    rows = pages.select("page_id", "url", "html", _host().alias("host"))
    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "main", "constant")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
