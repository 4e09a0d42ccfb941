"""Main text of pages by wrapper induction.

Pages of one host share a template. The trees of all pages of a host are aligned
by simple tree matching, with runs of alike neighbours as one node: each different
tree once, with the one that is nearest to what most pages have. Nodes that this one
lacks are named by the place where they would stand in it, so that a node found in
most pages is found anyhow. Nodes found in most pages form the wrapper; texts that
stay the same there are template, all other texts are varying slots. Pages that share
half of their text with one page before them are not counted here, but what varies in
them does. The content root is the innermost
container that holds all varying text, and none inside an article or main element;
lines that only fill a value into fixed words do not count as varying. A page is aligned with its host's
wrapper the same way: the element that matches the content root gives its text,
less constant texts, in an article or main element too. Parts that the markup names
as menu, header, footer, sidebar, notice, advert, form or comment, by the element or
a whole class, id or role, are never text, but no heading is such a part, and no
figure caption. Hosts without a wrapper (a single page) fall back on the markup's article, main or body.
"""

from __future__ import annotations

import json
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field
from functools import lru_cache
from hashlib import blake2b
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import release, sliced, stored
from refrain.llm.dom import Element, parse
from refrain.llm.url_filter import url_parts

#: A node or text belongs to the wrapper if this share of the host's unlike pages,
#: and at least two, have it.
WRAPPER_SHARE = 0.6
#: A page that shares this part of its text with one page before it is like that one.
ALIKE_SHARE = 0.5
#: Different trees that a task matches; they are small but take long.
TREES_A_TASK = 1_000
#: Rows handed on at once where a tree makes one for each node.
ROWS_A_BATCH = 20_000
#: Hosts whose slots a task holds at once before it hands them on.
HELD_HOSTS = 1_000

#: Elements and name parts that mark what is no article text.
NOT_ARTICLE = frozenset(
    "head nav footer aside form button select fieldset dialog menu".split()
)
NOT_ARTICLE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer notice notices "
    "cookie cookies consent gdpr popup modal overlay alert comment comments disqus reply "
    "replies share sharing social related recommended newsletter subscribe subscription "
    "widget toolbar masthead pagination pager contentinfo complementary search login".split()
)
#: Containers; the content root is one of these.
CONTAINERS = frozenset("#root html body div article main section center table tbody tr td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

def _is_article(node: Element, inside: bool) -> bool:
    """Whether an element may hold article text; ``inside`` an article already."""
    if node.hidden or node.tag in NOT_ARTICLE or (node.tag == "header" and not inside):
        return False
    if not node.names:
        return True
    if node.tag in HEADINGS or node.tag == "figcaption":
        return True
    parts = set(node.names.lower().split())
    if parts & NOT_ARTICLE_NAMES and node.tag not in ("html", "body", "article", "main"):
        return False
    if node.tag == "article" and parts & {"comment", "comments", "reply", "ad", "ads", "advert", "related"}:
        return False
    return not ("header" in parts and not inside)


def _blocks(root: Element) -> Iterator[tuple[Element, str, int]]:
    """Text blocks that may be article text, in page order: the element a block is
    in, the block, and 2, 1 or 0 if that is in an article, a main element or neither."""
    pending: list[tuple[Element, Element | str, int]] = [(root, root, 0)]
    while pending:
        parent, node, rank = pending.pop()
        if isinstance(node, str):
            yield parent, node, rank
        elif node is root or _is_article(node, rank > 0):
            rank = max(rank, {"article": 2, "main": 1}.get(node.tag, 0))
            pending += [(node, kid, rank) for kid in reversed(node.kids)]


@dataclass
class Skeleton:
    """Alike neighbouring elements as one node."""

    key: str
    elements: list[Element]
    kids: list[Skeleton]


def skeleton(elements: list[Element]) -> Skeleton:
    runs: list[list[Element]] = []
    for kid in (k for e in elements for k in e.kids):
        if not isinstance(kid, str):
            if runs and _key(runs[-1][0]) == _key(kid):
                runs[-1].append(kid)
            else:
                runs.append([kid])
    return Skeleton(_key(elements[0]), elements, [skeleton(run) for run in runs])


def _key(element: Element) -> str:
    return f"{element.tag} {element.names}".strip()


def _tag(key: str) -> str:
    return key.split(" ")[0]


def match_trees(a, b) -> tuple[int, list[tuple]]:
    """Simple tree matching: the most nodes of two ordered trees that can be paired
    keeping order and descent, roots paired with roots; and these pairs."""
    if a.key != b.key:
        return 0, []
    above: list[tuple[int, tuple]] = [(0, ())] * (len(b.kids) + 1)
    for x in a.kids:
        row: list[tuple[int, tuple]] = [(0, ())]
        for j, y in enumerate(b.kids):
            best = above[j + 1] if above[j + 1][0] >= row[j][0] else row[j]
            if x.key == y.key:
                size, pairs = match_trees(x, y) if x.kids and y.kids else (1, [(x, y)])
                if above[j][0] + size > best[0]:
                    best = (above[j][0] + size, (above[j][1], pairs))
            row.append(best)
        above = row
    size, chain = above[-1]
    pairs = [(a, b)]
    while chain:
        chain, found = chain
        pairs += found
    return size + 1, pairs


def _elements(nodes: list[Element]) -> Iterator[Element]:
    pending = list(nodes)
    while pending:
        node = pending.pop()
        yield node
        pending += [k for k in node.kids if not isinstance(k, str)]


@dataclass
class Wrapper:
    """A node of a host's wrapper; a draft has digests in place of constant texts."""

    key: str
    kids: list[Wrapper] = field(default_factory=list)
    constant: list[str] | list[int] = field(default_factory=list)
    is_root: bool = False

    @classmethod
    def read(cls, data: dict) -> Wrapper:
        return cls(data["key"], [cls.read(k) for k in data["kids"]], data["constant"], data["is_root"])


@dataclass
class Shape:
    """The keys of a skeleton; nodes are numbered in page order."""

    key: str
    kids: list[Shape]
    number: int

    @classmethod
    def read(cls, text: str) -> Shape:
        def made(data: list) -> Shape:
            node = cls(data[0], [], count[0])
            count[0] += 1
            node.kids = [made(k) for k in data[1]]
            return node

        count = [0]
        return made(json.loads(text))


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def outline(page: str) -> tuple[str, list[tuple[int, int, int]]]:
    """The shape of a page as JSON, and each different text of each node: the node's
    number, the text's digest, and its length, or 0 if an earlier node has it too."""
    blocks: list[tuple[int, int, int]] = []
    seen: set[int] = set()
    count = 0

    def walk(node: Skeleton) -> list:
        nonlocal count
        number, count = count, count + 1
        for text in dict.fromkeys(k for e in node.elements for k in e.kids if isinstance(k, str)):
            digest = _digest(text)
            blocks.append((number, digest, 0 if digest in seen else len(text)))
            seen.add(digest)
        return [node.key, [walk(k) for k in node.kids]]

    shape = json.dumps(walk(skeleton([parse(page)])), ensure_ascii=False, separators=(",", ":"))
    return shape, blocks


def places(base: Shape, tree: Shape) -> Iterator[tuple[int, int, int, int, int, str]]:
    """What node of the template each node of a tree is: its number in the tree, the
    template node and its parent, the base node it stands behind (-1: none), how far
    behind, and its key.

    Nodes paired with one of the base are that one; any other is named by its parent,
    the paired sibling before it, its key and how many such nodes are between them.
    """
    paired = {found.number: node.number for node, found in match_trees(base, tree)[1]}
    yield tree.number, 0, -1, -1, 0, tree.key
    pending = [(tree, 0)]
    while pending:
        parent, name = pending.pop()
        behind, far, alike = -1, 0, Counter()
        for kid in parent.kids:
            if kid.number in paired:
                own = behind = paired[kid.number]
                far, alike = 0, Counter()
            else:
                own = _digest(f"{name} {behind} {alike[kid.key]} {kid.key}")
                far += 1
                alike[kid.key] += 1
            yield kid.number, own, name, behind, far, kid.key
            pending.append((kid, own))


def paths(tree: Shape) -> list[int]:
    """What nodes a tree has, each by the keys above it and its place among siblings of its key."""
    return [name for _, name, *_ in places(Shape(tree.key, [], 0), tree)]


def distance(tree: Shape, usual: set[int]) -> int:
    """How many of the ``usual`` paths a tree lacks, and of its own are not usual."""
    return len(usual.symmetric_difference(paths(tree)))


def draft(nodes: Iterable[tuple[int, int, int, float, str, list[int]]]) -> Wrapper:
    """The wrapper of its nodes: template node, parent, base node before it, mean
    distance from that, key, and digests of the constant texts."""
    made, below = {}, {}
    for name, parent, behind, far, key, constant in nodes:
        made[name] = Wrapper(key, constant=sorted(constant))
        below.setdefault(parent, []).append((behind, far, key, name))
    for parent, kids in below.items():
        if parent in made:
            made[parent].kids = [made[name] for *_, name in sorted(kids)]
    return made[0]


def _common(a: list[str], b: list[str]) -> list[str]:
    """The words that both lists begin with."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[:i]
    return a if len(a) < len(b) else b


@dataclass
class Slot:
    """What a wrapper node holds in the pages seen so far: constant texts; characters
    of its varying texts, the words that all of these begin with, those that all end
    with (last first), least and most words; characters in parts without a node."""

    constant: list[str] = field(default_factory=list)
    own: int = 0
    start: list[str] = field(default_factory=list)
    end: list[str] = field(default_factory=list)
    least: int = 0
    most: int = 0
    other: int = 0

    def add(self, text: str) -> None:
        if not self.own or self.start or self.end:  # else the words tell no more
            words = text.split()
            self._merge_words(not self.own, words, words[::-1], len(words), len(words))
        self.own += len(text)

    def merge(self, more: Slot) -> None:
        if more.own:
            self._merge_words(not self.own, more.start, more.end, more.least, more.most)
        self.own += more.own
        self.other += more.other
        self.constant = sorted({*self.constant, *more.constant})

    def _merge_words(self, is_first: bool, start: list[str], end: list[str], least: int, most: int) -> None:
        if is_first:
            self.start, self.end, self.least, self.most = start, end, least, most
        else:
            self.start, self.end = _common(self.start, start), _common(self.end, end)
            self.least, self.most = min(self.least, least), max(self.most, most)

    def is_filled_in(self) -> bool:
        """Whether the texts, if there are several, are one line with a value in it,
        such as "Call 7": at least half of the words of each stand at its start or
        end in all of them."""
        fixed = len(self.start) + len(self.end)
        return len(self.start) < self.most and fixed < self.least and 2 * fixed >= self.most


def _nodes(wrapper: Wrapper) -> list[Wrapper]:
    """The nodes of a wrapper in page order."""
    found, pending = [], [wrapper]
    while pending:
        found.append(pending.pop())
        pending += reversed(found[-1].kids)
    return found


def fill_slots(wrapper: Wrapper, slots: list[Slot], page: str) -> None:
    """Add the texts of a page to the slots of a draft, one for each of ``_nodes``."""
    tree = parse(page)
    eligible = {id(e) for e, *_ in _blocks(tree)}
    pairs = match_trees(wrapper, skeleton([tree]))[1]
    own = {id(e): node for node, found in pairs for e in found.elements}
    slot_of = dict(zip(map(id, _nodes(wrapper)), slots))
    for node, found in pairs:
        slot = slot_of[id(node)]
        for element in found.elements:
            for kid in element.kids:
                if not isinstance(kid, str):
                    if id(kid) not in own:  # what has no node in the wrapper varies, too
                        slot.other += sum(
                            len(t) for e in _elements([kid]) if id(e) in eligible for t in e.kids if isinstance(t, str)
                        )
                elif node.constant and _digest(kid) in node.constant:
                    if kid not in slot.constant:
                        slot.constant.append(kid)
                elif id(element) in eligible:
                    slot.add(kid)


def finish(wrapper: Wrapper, slots: list[Slot]) -> Wrapper:
    """The draft with its constant texts and its content root."""
    nodes = _nodes(wrapper)
    amounts: dict[int, int] = {}
    for node, slot in reversed([*zip(nodes, slots)]):
        node.constant = sorted(slot.constant)
        is_varying = _tag(node.key) in HEADINGS or not slot.is_filled_in()
        amounts[id(node)] = slot.own * is_varying + slot.other + sum(amounts[id(k)] for k in node.kids)
    root = wrapper
    while _tag(root.key) not in ("article", "main"):
        inner = [k for k in root.kids if _tag(k.key) in CONTAINERS and amounts[id(k)] == amounts[id(root)] > 0]
        if not inner:
            break
        root = inner[0]
    root.is_root = amounts[id(root)] > 0
    return wrapper


def _unlike(pages: list[list[tuple[int, int, int]]]) -> list[int]:
    """Which pages share less than half of their text with any one before them, as
    far as that is the first to have it."""
    first: dict[int, int] = {}
    taken = []
    for i, blocks in enumerate(pages):
        shared = Counter()
        for _, text, size in blocks:
            if first.setdefault(text, i) != i:
                shared[first[text]] += size
        size = sum(size for *_, size in blocks)
        if size and max(shared.values(), default=0) < ALIKE_SHARE * size:
            taken.append(i)
    return taken


def induce(pages: list[str]) -> Wrapper | None:
    """The wrapper of the pages of one host; None if there are not two unlike ones.

    ``induce_wrappers`` does the same with Spark, and orders pages by hash.
    """
    found = [outline(p) for p in pages]
    taken = _unlike([blocks for _, blocks in found])
    if len(taken) < 2:
        return None
    least = max(2, WRAPPER_SHARE * len(taken))
    kinds = Counter(found[i][0] for i in taken)
    trees = {shape: Shape.read(shape) for shape in kinds}
    with_path = Counter()
    for shape, n in kinds.items():
        with_path.update(dict.fromkeys(paths(trees[shape]), n))
    usual = {path for path, n in with_path.items() if 2 * n > len(taken)}
    base = min(trees, key=lambda shape: (distance(trees[shape], usual), -kinds[shape]))
    template = {shape: {p[0]: p for p in places(trees[base], tree)} for shape, tree in trees.items()}
    held: dict[int, list[tuple]] = {}
    counts = Counter()
    for i in taken:
        shape, blocks = found[i]
        for place in template[shape].values():
            held.setdefault(place[1], []).append(place)
        counts.update((template[shape][number][1], text) for number, text, _ in blocks)
    wrapper = draft(
        (name, *rows[0][2:4], sum(r[4] for r in rows) / len(rows), rows[0][5],
         [text for (node, text), n in counts.items() if node == name and n >= least])
        for name, rows in held.items() if len(rows) >= least
    )
    slots = [Slot() for _ in _nodes(wrapper)]
    for page in pages:
        fill_slots(wrapper, slots, page)
    return finish(wrapper, slots)


@lru_cache(maxsize=512)
def _wrapper(data: str) -> Wrapper:
    return Wrapper.read(json.loads(data))


def main_text(page: str, wrapper: str | None = None) -> str:
    """The article's blocks, joined by line feeds; empty if there is none.

    ``wrapper`` is the host's wrapper as JSON.
    """
    tree = parse(page)
    roots, constant = [tree], {}
    if wrapper:
        pairs = match_trees(_wrapper(wrapper), skeleton([tree]))[1]
        roots = [e for node, found in pairs if node.is_root for e in found.elements] or [tree]
        constant = {id(e): node.constant for node, found in pairs if node.constant for e in found.elements}
    held = {id(e) for e in _elements(roots)}
    blocks = [b for b in _blocks(tree) if id(b[0]) in held]
    marked = any(rank for *_, rank in blocks)
    return "\n".join(
        text for element, text, rank in blocks
        if (rank or not marked) and text not in constant.get(id(element), ())
    )


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``outline`` of pages; a shape goes along with the first page of a task."""
    block = pa.struct([("node", pa.int32()), ("text", pa.int64()), ("size", pa.int32())])
    known: set[int] = set()
    for batch in sliced(batches):
        kinds, shapes, sizes, ends = [], [], [], [0]
        columns = array("i"), array("q"), array("i")
        for page in batch["html"].to_pylist():
            shape, found = outline(page)
            kinds.append(kind := _digest(shape))
            shapes.append(None if kind in known else shape)
            known.add(kind)
            sizes.append(sum(size for *_, size in found))
            for column, values in zip(columns, zip(*found)):
                column.extend(values)
            ends.append(len(columns[0]))
        held = pa.StructArray.from_arrays(
            [pa.Array.from_buffers(f.type, ends[-1], [None, pa.py_buffer(c)]) for c, f in zip(columns, block)], fields=[*block]
        )
        yield pa.RecordBatch.from_arrays(
            [batch["host"], batch["page"], pa.array(kinds, pa.int64()), pa.array(shapes, pa.string()),
             pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)],
            names=["host", "page", "kind", "shape", "size", "blocks"],
        )


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := [*islice(rows, ROWS_A_BATCH)]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _pathed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``paths`` of each kind of page."""
    return _in_batches((
        (host, path, pages)
        for batch in sliced(batches)
        for host, pages, shape in zip(*(batch[n].to_pylist() for n in ("host", "pages", "shape")))
        for path in paths(Shape.read(shape))
    ), _PATHS)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``distance`` of each kind of page from the usual paths of its host."""
    for batch in sliced(batches):
        found = [
            distance(Shape.read(shape), {*usual})
            for shape, usual in zip(batch["shape"].to_pylist(), batch["usual"].to_pylist())
        ]
        kept = ("host", "kind", "pages", "first")
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in kept), pa.array(found, pa.int64())], names=[*kept, "distance"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``places`` of each kind of page."""
    read = lru_cache(maxsize=64)(Shape.read)
    return _in_batches((
        (*row, *place)
        for batch in sliced(batches)
        for *row, shape, base in zip(*(c.to_pylist() for c in batch.columns))
        for place in places(read(base), Shape.read(shape))
    ), _PLACED)


_DDL = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double"}
_PATHS = pa.schema([("host", pa.string()), ("path", pa.int64()), ("pages", pa.int64())])
_PLACED = pa.schema([
    ("host", pa.string()), ("kind", pa.int64()), ("pages", pa.int64()), ("least", pa.float64()), ("node", pa.int32()),
    ("name", pa.int64()), ("parent", pa.int64()), ("behind", pa.int64()), ("far", pa.int32()), ("key", pa.string()),
])


def _drafted(found: pa.Table) -> pa.Table:
    names = ("name", "parent", "behind", "far", "key", "constant")
    wrapper = draft(zip(*(found[n].to_pylist() for n in names)))
    return pa.table({"host": found["host"][:1], "draft": pa.array([json.dumps(asdict(wrapper))], pa.string())})


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of each host, filled with its pages of this task."""

    def rows() -> pa.RecordBatch:
        made = [json.dumps([asdict(s) for s in slots]) for _, slots in held.values()]
        return pa.RecordBatch.from_arrays([pa.array([*held], pa.string()), pa.array(made, pa.string())], names=["host", "slots"])

    held: dict[str, tuple[Wrapper, list[Slot]]] = {}
    for batch in sliced(batches):
        for host, page, data in zip(*(batch[n].to_pylist() for n in ("host", "html", "draft"))):
            if host not in held:
                if len(held) == HELD_HOSTS:
                    yield rows()
                    held.clear()
                wrapper = Wrapper.read(json.loads(data))
                held[host] = wrapper, [Slot() for _ in _nodes(wrapper)]
            fill_slots(*held[host], page)
    yield rows()


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        made = []
        for data, parts in zip(batch["draft"].to_pylist(), batch["parts"].to_pylist()):
            wrapper = Wrapper.read(json.loads(data))
            slots = [Slot() for _ in _nodes(wrapper)]
            for part in parts:
                for slot, more in zip(slots, json.loads(part)):
                    slot.merge(Slot(**more))
            made.append(json.dumps(asdict(finish(wrapper, slots))))
        yield pa.RecordBatch.from_arrays([batch["host"], pa.array(made, pa.string())], names=["host", "wrapper"])


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` as JSON for hosts with two unlike pages, from all of
    their pages; equal pages count once.

    Pages stay where they are and are read twice: for their outlines and, once it is
    known what most pages have, for their slots. Between these only digests of texts
    and different trees are counted and matched, each by itself, so a hot host is no
    burden. The result is stored.
    """
    pages = pages.where("host <> '' AND html IS NOT NULL").select("host", "html")
    block = "array<struct<node:int,text:bigint,size:int>>"
    outlines = stored(
        pages.withColumn("page", F.xxhash64("html"))
        .mapInArrow(_outlines, f"host string, page bigint, kind bigint, shape string, size bigint, blocks {block}")
        .groupBy("host", "page")
        .agg(F.first("kind").alias("kind"), F.max("shape").alias("shape"), F.first("size").alias("size"), F.first("blocks").alias("blocks")),
        "outlines",
    )
    blocks = outlines.select("host", "page", "kind", F.inline("blocks"))
    repeated = (
        blocks.groupBy("host", "text")
        .agg(F.min("page").alias("first"), F.max("page").alias("last"), F.expr("count_if(size > 0)").alias("holders"))
        .where("first < last").drop("last")
    )
    held = stored(blocks.join(repeated, ["host", "text"]), "held_texts")
    shared = (
        held.where("page <> first").groupBy("host", "page", "first").agg(F.sum("size").alias("shared"))
        .groupBy("host", "page").agg(F.max("shared").alias("shared"))
    )
    taken = outlines.select("host", "page", "kind", "size").join(shared, ["host", "page"], "left")
    taken = stored(
        taken.where(f"size > 0 AND coalesce(shared, 0) < {ALIKE_SHARE} * size").select("host", "page", "kind"), "unlike_pages"
    )
    hosts = (
        taken.groupBy("host").agg(F.count("*").alias("n")).where("n >= 2")
        .withColumn("least", F.greatest(F.lit(2.0), F.lit(WRAPPER_SHARE) * F.col("n")))
    )
    kinds = taken.groupBy("host", "kind").agg(F.count("*").alias("pages"), F.min("page").alias("first"))
    shapes = outlines.where("shape IS NOT NULL").groupBy("kind").agg(F.max("shape").alias("shape"))
    trees = stored(kinds.join(hosts, "host").join(shapes, "kind"), "trees")
    tasks = 1 + trees.count() // TREES_A_TASK
    usual = (
        trees.repartition(tasks, "host", "kind").select("host", "pages", "shape")
        .mapInArrow(_pathed, "host string, path bigint, pages bigint")
        .groupBy("host", "path").agg(F.sum("pages").alias("pages")).join(hosts, "host").where("2 * pages > n")
        .groupBy("host").agg(F.collect_list("path").alias("usual"))
    )
    bases = (
        trees.select("host", "kind", "pages", "first", "shape").join(usual, "host").repartition(tasks, "host", "kind")
        .mapInArrow(_measured, "host string, kind bigint, pages bigint, first bigint, distance bigint")
        .groupBy("host").agg(F.expr("min_by(kind, struct(distance, -pages, first))").alias("base_kind"))
    )
    placed = stored(
        trees.join(bases, "host").join(shapes.toDF("base_kind", "base"), "base_kind")
        .select("host", "kind", "pages", "least", "shape", "base").repartition(tasks, "host", "kind")
        .mapInArrow(_placed, ", ".join(f"{f.name} {_DDL[f.type]}" for f in _PLACED)),
        "placed_nodes",
    )
    nodes = (
        placed.groupBy("host", "name")
        .agg(
            F.sum("pages").alias("pages"), F.first("least").alias("least"), F.first("parent").alias("parent"),
            F.first("behind").alias("behind"), (F.sum(F.col("far") * F.col("pages")) / F.sum("pages")).alias("far"),
            F.first("key").alias("key"),
        )
        .where("pages >= least")
    )
    constants = (
        held.join(taken.select("host", "page"), ["host", "page"])
        .groupBy("host", "kind", "node", "text").agg(F.count("*").alias("with_text"), F.first("holders").alias("holders"))
        .join(hosts, "host").where("holders >= least")
        .join(placed.select("host", "kind", "node", "name"), ["host", "kind", "node"])
        .groupBy("host", "name", "text").agg(F.sum("with_text").alias("with_text"), F.first("least").alias("least"))
        .where("with_text >= least")
        .groupBy("host", "name").agg(F.collect_list("text").alias("constant"))
    )
    drafts = stored(
        nodes.join(constants, ["host", "name"], "left")
        .select("host", "name", "parent", "behind", "far", "key", F.coalesce("constant", F.expr("array()")).alias("constant"))
        .groupBy("host").applyInArrow(_drafted, "host string, draft string"),
        "drafts",
    )
    filled = pages.join(drafts, "host").select("host", "html", "draft").mapInArrow(_filled, "host string, slots string")
    found = stored(
        filled.groupBy("host").agg(F.collect_list("slots").alias("parts")).join(drafts, "host")
        .select("host", "draft", "parts").mapInArrow(_finished, "host string, wrapper string"),
        "wrappers",
    )
    release(outlines, held, taken, trees, placed, drafts)
    return found


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    ``pages`` has ``page_id``, ``url`` and ``html``. Character references are decoded,
    white space inside a block becomes one space, blocks are joined by one line
    feed. A NULL or empty page has an empty text; a page without a host has no
    wrapper; repeated rows each get a row; NULL ids stay NULL; other columns are
    ignored.
    """
    host = url_parts(F.col("url"))[0]
    pages = pages.select(F.col("page_id").cast("long"), "url", "html", host.alias("host"))
    wrappers = induce_wrappers(pages).withColumnRenamed("host", "t_host")
    joined = pages.join(wrappers, F.col("host") == F.col("t_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [
                main_text(page or "", wrapper)
                for page, wrapper in zip(batch["html"].to_pylist(), batch["wrapper"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint"
    )
