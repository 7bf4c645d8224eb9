"""Main text of web pages by wrapper induction.

Every page becomes a tree of elements, in which runs of siblings of one label (tag, class, id) count as one node that keeps
the texts of each sibling apart. Of the pages of a host that have the same text before any template is known, one
counts. Pages of a host are of one layout if they have the same labels near the root and the same classes and ids outside
the article. The reference of a host, and of each of its layouts, is the page whose hashed id comes first; simple tree matching
aligns every other page with both of its references. Siblings of a reference node whose text is the same on nearly all pages
aligned at the node are constant: they are the template. All else are slots. The main text is what the slots of the article hold, that is of `article` or `main`,
or of the body where a page has neither; slots whose place names a menu, header, footer, sidebar, notice, advert, form
or reader comments are no content, nor are scripts, styles and hidden parts.

Only skeletons, labels and numbers that stand for texts, are shuffled by host; their counts are summed in each task first,
and a host with many pages is split like any skewed join. Templates that have constants go back to the pages.

Null html is the empty page; its text is empty. Pages without a host match no template. Repeated rows get a row each.
Broken markup never fails: open elements end with their parent, stray end tags are dropped, and comments and scripts without an
end reach to the end of the page. Elements nested more than DEEPEST levels deep are taken as siblings at that level. Of a page without any
content outside of parts that their name excludes, an article inside them is the text.
"""

from __future__ import annotations

import hashlib
import html as H
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import staged

#: A text of a node is constant if this share of the pages aligned there, and so many, have it.
SHARE, LEAST = 0.8, 4
#: Labels down to this depth tell layouts apart, and the layout number of the reference of all pages of a host.
DEPTH, ALL = 3, 0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|textarea|title|select|xmp)\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=\"'/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements nested deeper than this are siblings there, as in browsers.
DEEPEST = 200
#: Pairs of siblings that are compared one by one; more are compared a line at a time, with the same result.
CELLS = 1 << 12
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that end an open paragraph, and elements that end an open one of their own kind.
_BREAKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ALIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
_NO_TEXT = frozenset("head nav footer aside form button dialog menu object canvas audio video".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menubar|header|masthead|footer|sidebar|side|ad|ads|adv|advert|advertisement|advertising|adsense|banner|promo|promotion|sponsor|sponsored"
    r"|cookie|cookies|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|related|recommended"
    r"|breadcrumb|breadcrumbs|pagination|pager|comment|comments|reply|replies|respond|disqus|widget|toolbar|copyright|legal|contentinfo|complementary)(?:$|[\s_-])",
    re.I,
)


class Node:
    """An element: `items` are its texts and children in page order."""

    __slots__ = ("tag", "label", "skip", "items", "constant")

    def __init__(self, tag: str, label: str = "", skip: bool = False):
        self.tag, self.label, self.skip, self.items, self.constant = tag, label or tag, skip, [], False


def _hidden(rest: str) -> bool:
    """Whether the attributes of a tag hide it; what the values of others say does not matter."""
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; comments, scripts, styles and the like are left out."""
    root = Node("")
    path, at = [root], 0
    # Tags that are open beyond the deepest level, and how often each.
    over: list[str] = []
    beyond: Counter[str] = Counter()
    for token in _TOKEN.finditer(page):
        begin, end = token.span()
        if begin > at:
            path[-1].items.append(page[at:begin])
        at, name = end, token[3]
        if name is None:
            continue
        tag = name.lower()
        if token[2]:
            if beyond[tag]:
                while True:
                    last = over.pop()
                    beyond[last] -= 1
                    if last == tag:
                        break
                continue
            over.clear()
            beyond.clear()
            for k in range(len(path) - 1, 0, -1):
                if path[k].tag == tag:
                    del path[k:]
                    break
            continue
        if tag in _BREAKS:
            for k in range(len(path) - 1, 0, -1):
                if path[k].tag == "p":
                    del path[k:]
                    break
                if path[k].tag not in _INLINE:
                    break
        elif tag in _ALIKE:
            for k in range(len(path) - 1, 0, -1):
                if path[k].tag in _ALIKE[tag]:
                    del path[k:]
                    break
                if path[k].tag in _HOLDS[tag]:
                    break
        rest, label, skip = token[4], tag, False
        if rest and not rest.isspace():
            values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(rest)}
            label = "|".join((tag, *values.values())) if values else tag
            skip = any(_NAMES.search(v) for v in values.values()) and tag not in ("html", "body", "article", "main") or bool(_HIDDEN.search(rest)) and _hidden(rest)
        node = Node(tag, label, skip or tag in _NO_TEXT)
        path[-1].items.append(node)
        if tag not in _VOID and not rest.endswith("/"):
            if len(path) < DEEPEST:
                path.append(node)
            else:
                over.append(tag)
                beyond[tag] += 1
    if at < len(page):
        path[-1].items.append(page[at:])
    return root


def mark(node: Node) -> int:
    """A number that stands for an element's own text; 0 without any."""
    said = "\n".join(" ".join(x.split()) for x in node.items if isinstance(x, str))
    return zlib.crc32(said.encode("utf-8", "replace")) | len(said) << 32 if said.strip() else 0


class Shape:
    """Siblings of one label that follow each other, as one node."""

    __slots__ = ("label", "nodes", "children", "marks")

    def __init__(self, label: str, nodes: list[Node]):
        self.label, self.nodes = label, nodes
        own = [x for n in nodes for x in n.items]
        self.marks = [mark(n) for n in nodes]
        self.children: list[Shape] = []
        run: list[Node] = []
        for x in own:
            if isinstance(x, Node):
                if run and run[0].label != x.label:
                    self.children.append(Shape(run[0].label, run))
                    run = []
                run.append(x)
        if run:
            self.children.append(Shape(run[0].label, run))

    def skeleton(self) -> list:
        return [self.label, self.marks, [c.skeleton() for c in self.children]]


def _filled(rows: Sequence[int], columns: Sequence[int], worth: Callable[[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """The most that pairs of rows and columns in order are worth together, and these pairs, the first ones of equal worth."""
    best = [[0] * (len(columns) + 1)]
    for x in rows:
        above, own = best[-1], [0]
        for j, y in enumerate(columns):
            own.append(max(above[j + 1], own[j], above[j] + worth(x, y)))
        best.append(own)
    i, j, pairs = len(rows), len(columns), []
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[-1][-1], pairs


def _filled_by_line(rows: Sequence[int], columns: Sequence[int], worth: Callable[[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """As `_filled`, a line at a time. Of the lines every so many are kept, and those between are filled again on the way back."""
    of_row, row = np.unique(rows, return_inverse=True)
    of_column, column = np.unique(columns, return_inverse=True)
    table = np.array([[worth(x, y) for y in of_column.tolist()] for x in of_row.tolist()], np.int32)
    step = math.isqrt(len(rows)) + 1

    def lines(line: np.ndarray, low: int, high: int) -> Iterator[np.ndarray]:
        at = column[: len(line) - 1]
        for i in range(low, high):
            below = np.zeros_like(line)
            np.maximum(line[1:], line[:-1] + table[row[i]][at], out=below[1:])
            line = np.maximum.accumulate(below)
            yield line

    line = np.zeros(len(columns) + 1, np.int32)
    kept = {0: line}
    for i, line in enumerate(lines(line, 0, len(rows)), 1):
        if i % step == 0:
            kept[i] = line
    i, j, pairs, low, block = len(rows), len(columns), [], len(rows), []
    while i and j:
        if i == low or not block:
            low = (i - 1) // step * step
            block = [kept[low][: j + 1], *lines(kept[low][: j + 1], low, i)]
        own, above = block[i - low], block[i - 1 - low]
        if own[j] == above[j]:
            i -= 1
        elif own[j] == own[j - 1]:
            j = int(np.searchsorted(own[: j + 1], own[j]))
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return int(line[-1]), pairs


def matching(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching of two skeletons: the most nodes that pair up with equal labels, in order and level by level.

    Siblings with the same labels all over pair up first at both ends, which loses nothing; every pair of the others counts, however many
    there are. Subtrees with the same labels all over are matched once.
    """
    numbers: dict[tuple, int] = {}
    kinds: list[tuple[str, tuple[int, ...], int]] = []

    def kind(tree: list) -> int:
        """A number for the labels of a subtree."""
        own = tree[0], tuple([kind(c) for c in tree[2]])
        if own not in numbers:
            numbers[own] = len(kinds)
            kinds.append((*own, 1 + sum(kinds[c][2] for c in own[1])))
        return numbers[own]

    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def aligned(x: int, y: int) -> tuple[int, list[tuple[int, int]]]:
        """How many nodes of two kinds of one label pair up, and which of their children do."""
        if (x, y) not in known:
            rows, columns = kinds[x][1], kinds[y][1]
            most, head, tail = min(len(rows), len(columns)), 0, 0
            while head < most and rows[head] == columns[head]:
                head += 1
            while tail < most - head and rows[-1 - tail] == columns[-1 - tail]:
                tail += 1
            middle = rows[head : len(rows) - tail], columns[head : len(columns) - tail]
            fill = _filled if len(middle[0]) * len(middle[1]) <= CELLS else _filled_by_line
            more, pairs = fill(*middle, worth) if all(middle) else (0, [])
            ends = [(k, k) for k in range(head)] + [(len(rows) - k, len(columns) - k) for k in range(1, tail + 1)]
            score = 1 + sum(kinds[rows[i]][2] for i, _ in ends) + more
            known[x, y] = score, ends + [(head + i, head + j) for i, j in pairs]
        return known[x, y]

    def worth(x: int, y: int) -> int:
        return kinds[x][2] if x == y else aligned(x, y)[0] if kinds[x][0] == kinds[y][0] else 0

    if a[0] != b[0]:
        return 0, []
    pairs, open_ = [], [(a, kind(a), b, kind(b))]
    score = worth(open_[0][1], open_[0][3])
    while open_:
        one, x, two, y = open_.pop()
        pairs.append((one, two))
        open_ += [(one[2][i], kinds[x][1][i], two[2][j], kinds[y][1][j]) for i, j in aligned(x, y)[1]]
    return score, pairs


def layout(tree: list) -> int:
    """A number that stands for the layout of a skeleton."""
    labels, open_ = set(), [(tree, 0)]
    while open_:
        (label, _, children), depth = open_.pop()
        tag = label.split("|")[0]
        if tag not in _INLINE and (depth <= DEPTH or "|" in label):
            labels.add(re.sub(r"\d+", "0", label))
        if tag not in ("article", "main"):
            open_ += [(c, depth + 1) for c in children]
    return _number("\n".join(sorted(labels)))


def _number(said: str) -> int:
    """63 bits, never ALL."""
    return int.from_bytes(hashlib.blake2b(said.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1 or 1


def numbered(tree: list) -> list[list]:
    """The nodes of a skeleton in page order."""
    out, open_ = [], [tree]
    while open_:
        out.append(open_.pop())
        open_ += reversed(out[-1][2])
    return out


def main_text(root: Node) -> str:
    """The blocks of the content slots, one to a line."""
    starts: list[Node] = []

    def search(node: Node, anywhere: bool = False) -> None:
        for x in node.items:
            if isinstance(x, Node) and (not x.skip or anywhere and (x.tag == "form" or x.tag not in _NO_TEXT)) and not (x.tag == "header"):
                if x.tag in ("article", "main"):
                    starts.append(x)
                else:
                    search(x, anywhere)

    search(root)
    blocks, run = [], []

    def close() -> None:
        block = " ".join(H.unescape("".join(run)).split())
        if block:
            blocks.append(block)
        run.clear()

    def walk(node: Node, within: bool) -> None:
        if node.skip or (node.tag == "header" and not within):
            return
        block = node.tag not in _INLINE
        if block:
            close()
        elif node.tag == "br":
            run.append(" ")
        for x in node.items:
            if not isinstance(x, str):
                walk(x, within)
            elif not node.constant:
                run.append(x)
        if block:
            close()

    for start in starts or [root]:
        walk(start, bool(starts))
    close()
    if not blocks and not starts:
        # All there is lies in parts that are no content by their name or in a form: then an article there is the article.
        search(root, anywhere=True)
        for start in starts:
            walk(start, True)
        close()
    return "\n".join(blocks)


def extract(page: str | None, references: tuple = ()) -> str:
    """The main text of a page, given its reference skeletons, each with the texts of the constant nodes by number."""
    root = parse(page or "")
    shapes = {}

    def index(s: Shape) -> list:
        own = [s.label, s.marks, [index(c) for c in s.children]]
        shapes[id(own)] = s
        return own

    own_tree = index(Shape("", [root])) if references else None
    for template, constants in references:
        place = {id(n): k for k, n in enumerate(numbered(template))}
        for own, reference in matching(own_tree, template)[1]:
            known = constants.get(place[id(reference)], ())
            for node, said in zip(shapes[id(own)].nodes, own[1], strict=True):
                node.constant = node.constant or said in known
    return main_text(root)


def host():
    return F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """host, layout, template (JSON) and constants (JSON: node number to text marks) of the references that have constant nodes."""
    schema = "host string, page_id long, layout long, said long, skeleton string"

    def skeletons(part: pa.RecordBatch) -> dict:
        roots = [parse(p or "") for p in part.column("html").to_pylist()]
        trees = [Shape("", [r]).skeleton() for r in roots]
        return {
            "host": part.column("host"), "page_id": part.column("page_id"), "layout": [layout(t) for t in trees],
            "said": [_number(main_text(r)) for r in roots], "skeleton": [json.dumps(t, separators=(",", ":")) for t in trees],
        }

    known = pages.select(host().alias("host"), F.col("page_id").cast("long").alias("page_id"), "html").where("host <> '' and html is not null")
    order = F.struct(F.xxhash64("page_id"), "page_id", "layout", "skeleton")
    parsed = X.map_slices(known, schema, skeletons, column="html").groupBy("host", "said").agg(F.min(order).alias("seed"))
    parsed = staged(parsed.select("host", "seed.*"), "skeletons")
    order = F.struct(F.xxhash64("page_id"), "page_id", "skeleton")
    both = (parsed.withColumn("layout", F.lit(ALL).cast("long")), parsed)
    firsts = [df.groupBy("host", "layout").agg(F.min(order).alias("seed"), F.count("*").alias("pages")).where(F.col("pages") >= least) for df in both]
    # A host of one layout has one reference.
    single = firsts[0].select("host", F.col("pages").alias("every"))
    firsts[1] = firsts[1].join(single, "host").where("pages < every").drop("every")
    seeds = staged(firsts[0].unionByName(firsts[1]).select("host", "layout", F.col("seed.skeleton").alias("template")), "references")
    into = X.arrow_schema("host string, layout long, node int, mark long, n long")

    def votes(batches):
        """Pages by text of a node; mark 0 counts all pages aligned there."""
        seen: Counter = Counter()
        for batch in batches:
            trees: dict[tuple, tuple[list, dict[int, int]]] = {}
            columns = (batch.column(c).to_pylist() for c in ("host", "layout", "skeleton", "template"))
            for name, kind, skeleton, reference in zip(*columns, strict=True):
                if (name, kind) not in trees:
                    tree = json.loads(reference)
                    trees[name, kind] = tree, {id(n): k for k, n in enumerate(numbered(tree))}
                tree, place = trees[name, kind]
                for own, matched in matching(json.loads(skeleton), tree)[1]:
                    for said in {0, *own[1]}:
                        seen[name, kind, place[id(matched)], said] += 1
            if len(seen) > 200_000:
                yield counted(seen)
                seen.clear()
        if seen:
            yield counted(seen)

    def counted(seen: Counter) -> pa.RecordBatch:
        names, kinds, nodes, marks = zip(*seen, strict=True)
        return X.record({"host": names, "layout": kinds, "node": nodes, "mark": marks, "n": list(seen.values())}, into)

    asked = parsed.select("host", F.explode(F.array(F.lit(ALL).cast("long"), "layout")).alias("layout"), "skeleton")
    joined = asked.join(seeds, ["host", "layout"])
    keys = ["host", "layout", "node"]
    each = joined.mapInArrow(votes, "host string, layout long, node int, mark long, n long").groupBy(*keys, "mark").agg(F.sum("n").alias("n"))
    each = staged(each, "votes")
    often = each.where("mark <> 0").join(each.where("mark = 0").select(*keys, F.col("n").alias("aligned")), keys)
    often = often.where((F.col("n") >= least) & (F.col("n") >= share * F.col("aligned"))).groupBy(*keys).agg(F.collect_list("mark").alias("marks"))
    constants = often.groupBy("host", "layout").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("node", "marks")))).alias("constants"))
    return staged(constants.join(seeds, ["host", "layout"]), "templates")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    found = templates(pages).withColumnsRenamed({"host": "_host", "layout": "_layout"})
    kind = pages.schema["page_id"].dataType.simpleString()

    def layouts(part: pa.RecordBatch) -> dict:
        own = [layout(Shape("", [parse(p or "")]).skeleton()) for p in part.column("html").to_pylist()]
        return {n: part.column(n) for n in ("page_id", "url", "html", "_host")} | {"_layout": own}

    with_host = pages.select("page_id", "url", "html").withColumn("_host", host())
    with_host = X.map_slices(with_host, f"page_id {kind}, url string, html string, _host string, _layout long", layouts, column="html")
    every = found.where(F.col("_layout") == ALL).drop("_layout").withColumnsRenamed({"template": "template_all", "constants": "constants_all"})
    with_host = with_host.join(every, "_host", "left").join(found.where(F.col("_layout") != ALL), ["_host", "_layout"], "left")
    schema = f"page_id {kind}, url string, text string, n_chars long"

    def setup():
        known: dict[tuple, tuple[list, dict[int, set]]] = {}

        def reference(key: tuple, template: str, constants: str) -> tuple[list, dict[int, set]]:
            if key not in known:
                if len(known) > 1000:
                    known.clear()
                known[key] = json.loads(template), {int(k): set(v) for k, v in json.loads(constants).items()}
            return known[key]

        def work(part: pa.RecordBatch) -> dict:
            texts = []
            columns = (part.column(c).to_pylist() for c in ("html", "_host", "_layout", "template_all", "constants_all", "template", "constants"))
            for page, name, kind, *given in zip(*columns, strict=True):
                pairs = (((name, ALL), *given[:2]), ((name, kind), *given[2:]))
                texts.append(extract(page, tuple(reference(*p) for p in pairs if p[1])))
            return {"page_id": part.column("page_id"), "url": part.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return X.map_slices(with_host, schema, None, column="html", setup=setup)


def op1_wrapper_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{folder}/pages.parquet"))
