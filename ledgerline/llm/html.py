"""Main-text extraction by wrapper induction.

For each host a page of its most common layout is aligned with the layouts of all its pages by simple tree matching;
nodes matched in more than half of the different pages are slots, named by their path. Over all pages of the host, a
block that every page with its slot has there is template. Each page then is cut in place, block by block: only template goes, inside <article> and <main> too. A page without any
slot of its host's wrapper (as the only page of a host) gives its <article> or <main> elements, if there are any.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .shared import materialize
from .urlfilter import host_and_path

#: Wrappers that together stay below this many bytes are broadcast.
BROADCAST_BYTES = 4_000_000
#: Items of a node above which its like-named children are aligned as one.
WIDE = 256

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"))
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
JUNK = frozenset("aside button canvas dialog footer form head header iframe menu nav noscript object script select style svg template textarea title".split())
JUNK_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of class and id names that mark what is not the article, and words that may stand beside them in a name.
JUNK_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
BESIDE_JUNK = frozenset(
    "area bar block bottom box button buttons container content footer global group header icons inner item items left link links list main menu "
    "outer page panel primary right row secondary section sec site small tools top wrap wrapper".split()
)
#: Elements that an opening tag closes first.
CLOSES = {t: frozenset(("p",)) for t in BLOCK - {"body", "html"}} | {"li": frozenset(("p", "li")), "dd": frozenset(("p", "dd", "dt")), "dt": frozenset(("p", "dd", "dt")), "tr": frozenset(("p", "td", "th", "tr")), "td": frozenset(("p", "td", "th")), "th": frozenset(("p", "td", "th")), "option": frozenset(("option",))}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def junk_name(name: str) -> bool:
    """True for a class or id like comments, ad-1 or top_menu; false for one like share-price."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return not JUNK_NAMES.isdisjoint(words) and all(w in JUNK_NAMES or w in BESIDE_JUNK for w in words)


class Node:
    __slots__ = ("tag", "name", "junk", "items")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.items, self.name = tag, [], tag
        self.junk = tag in JUNK
        if attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                value = "".join(values).lower()
                if tag not in ("html", "body", "main"):
                    self.junk |= not JUNK_ROLES.isdisjoint(value.split()) if key.lower() == "role" else any(map(junk_name, value.split()))
                if key.lower() == "class":
                    self.name = f"{tag}.{'.'.join(value.split())}"


def parse(page: str) -> Node:
    """Element tree; text items are strings with references still encoded.

    Behind the page's last ">" no tag can end, so the rest is text up to an open comment; unclosed tags are not searched anew.
    """
    root = Node("")
    stack = [root]
    at, end = 0, len(page)
    last = page.rfind(">")
    while at < end:
        if at > last:
            comment = page.find("<!--", at)
            stack[-1].items.append(page[at : comment if comment >= 0 else end])
            break
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token[2]
        if tag is None:
            text = token[0]
            if not text.startswith(("<!", "<?")):
                stack[-1].items.append(text)
            continue
        tag = tag.lower()
        if token[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break  # a stray inline end tag closes no block
            continue
        closes = CLOSES.get(tag)
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK and stack[i].tag not in closes:
                    break
        node = Node(tag, token[3])
        stack[-1].items.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if tag not in JUNK:
                node.items.append(page[at : close.start() if close else end])
            at = close.end() if close else end
        elif tag not in VOID and not token[3].endswith("/"):
            stack.append(node)
    return root


def placed(node: Node) -> list[tuple[str, str]]:
    """Path (names of the block elements down to it) and text of a node's blocks in page order, without junk."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    path = ""

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((path, text))

    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, tuple):
            flush()
            path = item[0]
        elif isinstance(item, str):
            held.append(item)
        elif item.junk and item is not node:
            if item.tag in BLOCK:
                flush()
        elif item.tag == "br":
            held.append(" ")
        else:
            if item.tag in BLOCK:
                flush()
                todo.append((path,))
                path = f"{path}/{item.name}"
            todo.extend(reversed(item.items))
    flush()
    return out


def blocks(node: Node) -> list[str]:
    return [text for _, text in placed(node)]


class Shape:
    """A node for alignment: runs of like-named siblings are one node, as list items and paragraphs vary in number.

    Among more than WIDE siblings like-named ones are one node wherever they stand, as in tables of striped rows.
    """

    __slots__ = ("name", "text", "children")

    def __init__(self, name: str):
        self.name, self.text, self.children = name, [], []

    @classmethod
    def of(cls, root: Node) -> Shape:
        top = cls(root.name)
        todo = [(top, [root])]
        while todo:
            shape, nodes = todo.pop()
            for node in nodes:
                run: list[Node] = []
                runs: dict[str, list[Node]] | None = {} if len(node.items) > WIDE else None
                for item in node.items:
                    if isinstance(item, str):
                        shape.text.append(item)
                    elif item.tag not in BLOCK:
                        if not item.junk:
                            shape.text.extend(blocks(item))
                    elif not item.junk:
                        if runs is not None:
                            run = runs.get(item.name, [])
                        if not run or run[0].name != item.name:
                            run = []
                            if runs is not None:
                                runs[item.name] = run
                            child = cls(item.name)
                            shape.children.append(child)
                            todo.append((child, run))
                        run.append(item)
        return top

    def words(self) -> str:
        return " ".join(entities.unescape(" ".join(self.text)).split())


def _table(a: Shape, b: Shape, sizes: dict[tuple[int, int], int]) -> list[list[int]]:
    """Sizes of the best order-preserving matchings of the first i children of a and the first j of b."""
    table = [[0] * (len(b.children) + 1)]
    for x in a.children:
        above, row = table[-1], [0]
        for j, y in enumerate(b.children):
            best = above[j + 1] if above[j + 1] > row[j] else row[j]
            if x.name == y.name and above[j] + sizes[id(x), id(y)] > best:
                best = above[j] + sizes[id(x), id(y)]
            row.append(best)
        table.append(row)
    return table


def match(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    """Simple tree matching: the pairs of a largest order-preserving matching.

    Only sizes are kept on the way up, whatever the depth; the pairs are traced back from the root.
    """
    if a.name != b.name:
        return []
    sizes: dict[tuple[int, int], int] = {}
    todo = [(a, b, False)]
    while todo:
        x, y, ready = todo.pop()
        if ready or not (x.children and y.children):
            sizes[id(x), id(y)] = 1 + (_table(x, y, sizes)[-1][-1] if ready else 0)
            continue
        todo.append((x, y, True))
        todo.extend((c, d, False) for c in x.children for d in y.children if c.name == d.name)
    pairs, open_ = [], [(a, b)]
    while open_:
        x, y = open_.pop()
        pairs.append((x, y))
        table = _table(x, y, sizes)
        i, j = len(x.children), len(y.children)
        while i and j:
            c, d = x.children[i - 1], y.children[j - 1]
            if c.name == d.name and table[i][j] == table[i - 1][j - 1] + sizes[id(c), id(d)]:
                open_.append((c, d))
                i, j = i - 1, j - 1
            elif table[i][j] == table[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return pairs


def layout(shape: Shape) -> str:
    """Names, depths and whether there is text of all nodes in page order; it decides all that matching does."""
    out, todo = [], [(shape, 0)]
    while todo:
        node, depth = todo.pop()
        out.append((depth, node.name, 1 if node.words() else 0))
        todo.extend((c, depth + 1) for c in reversed(node.children))
    return json.dumps(out, separators=(",", ":"))


def drawn(written: str) -> Shape:
    """The shape of a layout, with a mark in place of its texts."""
    top, way = None, []
    for depth, name, text in json.loads(written):
        node = Shape(name)
        node.text = ["x"] if text else []
        del way[depth:]
        if way:
            way[-1].children.append(node)
        else:
            top = node
        way.append(node)
    return top


def matched_paths(seed: Shape, other: Shape) -> set[str]:
    """Paths of the seed's nodes with text that simple tree matching finds in the other shape."""
    found = {id(mine) for mine, _ in match(seed, other)}
    paths, todo = set(), [(seed, "")]
    while todo:
        shape, path = todo.pop()
        if id(shape) in found and shape.words():
            paths.add(path)
        todo += [(c, f"{path}/{c.name}") for c in shape.children]
    return paths


def induce(pages: list[str]) -> list[str]:
    """Wrapper of a host, as extract() finds it in Spark: paths with text matched in more than half of its different pages; one page: none."""
    layouts: dict[str, int] = {}
    for page in set(pages):
        written = layout(Shape.of(parse(page)))
        layouts[written] = layouts.get(written, 0) + 1
    if sum(layouts.values()) < 2:
        return []
    seed = drawn(max(layouts, key=lambda w: (layouts[w], len(w), w)))
    counts: dict[str, int] = {}
    for written, n in layouts.items():
        for path in matched_paths(seed, drawn(written)):
            counts[path] = counts.get(path, 0) + n
    return sorted(path for path, n in counts.items() if 2 * n > sum(layouts.values()))


def block_key(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}".encode()) - (1 << 63)


def outermost(root: Node, tag: str) -> list[Node]:
    """All elements of a tag that lie in no other one, in page order, without junk."""
    todo, found = [root], []
    while todo:
        node = todo.pop()
        if node.tag == tag:
            found.append(node)
        else:
            todo.extend(x for x in reversed(node.items) if isinstance(x, Node) and not x.junk)
    return found


def main_text(page: str | None, slots: frozenset[str], template: frozenset[int]) -> str:
    """Text of one page under its host's slots and template blocks; a page without a slot is cut by its own tags."""
    if not page:
        return ""
    root = parse(page)
    found = placed(root)
    if any(path in slots for path, _ in found):
        return "\n".join(text for path, text in found if path not in slots or block_key(path, text) not in template)
    nodes = outermost(root, "article") or outermost(root, "main") or [root]
    return "\n".join(b for node in nodes for b in blocks(node))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id_col, url_col and text of every page, one row per input row.

    The slots of a host are fitted on the layouts of all its pages, its template blocks are counted over all of its
    pages (two different ones at least each); the cut applies to whole pages of all rows. Every header
    element goes, an article's own too, with whatever heading stands in it. A null or empty
    page has the empty text; pages without a host share the host ''; repeated rows come out alike; an empty table
    gives no rows; other columns are dropped.
    """
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("page"))
    host = host_and_path(F.col("url"))[0]
    named = rows.withColumn("host", host)

    def survey(batches):
        """Layout and digests of layout and page."""
        for batch in batches:
            texts = [page.as_py() for page in batch.column(1)]
            layouts = [layout(Shape.of(parse(text))) for text in texts]
            digests = [[xxhash.xxh64_intdigest(x.encode()) - (1 << 63) for x in of] for of in (layouts, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(layouts, pa.string()), *[pa.array(x, pa.int64()) for x in digests]], ["host", "layout", "form", "digest"])

    def align(batches):
        """Per layout of a host the seed's paths matched in it, once for each, and how many pages have it."""
        for batch in batches:
            hosts, paths, counts = [], [], []
            for name, written, seed, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found = matched_paths(drawn(seed), drawn(written))
                hosts += [name] * len(found)
                paths += found
                counts += [n] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["host", "path", "n"])

    def held(name: str, df: DataFrame, column: str) -> DataFrame:
        df = materialize(df, name)
        size = df.agg(F.sum(F.length(column) + F.length("host"))).first()[0] or 0
        return F.broadcast(df) if size <= BROADCAST_BYTES else df

    surveyed = materialize(named.where("page != ''").select("host", "page").mapInArrow(survey, "host string, layout string, form bigint, digest bigint"), "layouts")
    pages_of = surveyed.select("host", "form", "digest").distinct().groupBy("host", "form").agg(F.count("*").alias("n"))
    layouts = surveyed.groupBy("host", "form").agg(F.min("layout").alias("layout")).join(pages_of, ["host", "form"])
    layouts = materialize(layouts, "host-layouts")
    seeds = layouts.groupBy("host").agg(F.max_by("layout", F.struct("n", F.length("layout"), "layout")).alias("seed"), F.sum("n").alias("total")).where("total > 1")
    seeds = held("seeds", seeds, "seed")
    aligned = layouts.join(seeds, "host").select("host", "layout", "seed", "n").mapInArrow(align, "host string, path string, n bigint")
    common = aligned.groupBy("host", "path").agg(F.sum("n").alias("n")).join(seeds.select("host", "total"), "host").where("2 * n > total")
    slots = held("slots", common.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths")).select("host", F.to_json("paths").alias("slots")), "slots")

    def known(cache: dict, written: str | None, form):
        if written not in cache:
            if len(cache) > 10_000:
                cache.clear()
            cache[written] = form(json.loads(written)) if written else form()
        return cache[written]

    def count(batches):
        """Per page one row of every block in a slot (block) and of every slot (no block)."""
        cache: dict = {}
        for batch in batches:
            hosts, paths, keys, ids = [], [], [], []
            for name, page, written in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                mine, text = known(cache, written, frozenset), page.as_py()
                seen = {(p, block_key(p, t)) for p, t in placed(parse(text)) if p in mine}
                seen |= {(p, None) for p, _ in seen}
                digest = xxhash.xxh64_intdigest(text.encode()) - (1 << 63)
                for path, key in seen:
                    hosts.append(name)
                    paths.append(block_key(path, ""))
                    keys.append(key)
                    ids.append(digest)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *[pa.array(x, pa.int64()) for x in (paths, keys, ids)]], ["host", "path", "block", "digest"])

    told = named.where("page != ''").join(slots, "host").select("host", "page", "slots")
    counts = told.mapInArrow(count, "host string, path bigint, block bigint, digest bigint")
    counts = counts.groupBy("host", "path", "block").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    counts = materialize(counts.where("low != high"), "blocks")
    whole = counts.where("block is null").select("host", "path", "n")
    template = counts.where("block is not null").join(whole, ["host", "path", "n"]).groupBy("host").agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("block")), ","), F.lit("]")).alias("template"))
    template = held("template", template, "template")
    fitted = named.join(slots, "host", "left").join(template, "host", "left")

    def cut(batches):
        cache: dict = {}
        for batch in batches:
            texts = [
                main_text(page.as_py(), known(cache, slots, frozenset), known(cache, template, frozenset))
                for page, slots, template in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, url string, text string"
    out = fitted.select("id", "url", "page", "slots", "template").mapInArrow(cut, schema)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")


shared.by_value(sys.modules[__name__])
