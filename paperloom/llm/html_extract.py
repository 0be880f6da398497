"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is read into a stream of structural tags and texts (scripts, styles, comments and inline
markup fall away, unclosed tags are closed) and so into a tree. A wrapper starts as the tree of one
page and is generalised by one page of the same host after another: the children of two matched
elements are aligned as token streams; neighbours of one kind collapse into a repeated group; what
only one side has becomes optional; texts that differ become slots. There are no unions. Numbers in
names count as one sign, so ``id="post-17"`` is the same element on every page.

The wrapper decides what is content. Counts over all pages of the host tell how much prose and how
much link text its slots hold. The content region is the element that holds most of the prose in
slots, or an ``article`` or ``main`` around it; without these it is widened to the elements around it while they
hold nothing but prose. Of the rest

* texts that are constant at one path, on many pages with otherwise different text, are dropped;
* outside the region, so are elements whose slots hold links for the most part (a menu needs no
  name), headers, and elements named as boilerplate (``WEAK``);
* inside the region a name alone drops nothing but adverts, notices, reader comments and the like
  (``STRONG``); a weakly named element goes only if links fill it;
* elements that are boilerplate by their meaning (``ALWAYS``) go everywhere;
* all other text stays, inside the region and out: nothing is dropped because another element holds more.
  Elements around the region are never dropped, whatever their names.

A page is matched with its host's wrapper by walking both down the same path. A page without the
region (another template) and a host without wrapper are judged by the wrapper of the page itself.

Wrappers are inferred from all pages of the host. A wrapper needs of a page only its tree without texts, which most pages
of a template share once repeated groups are collapsed: the different ones travel, are generalised over ``SALTS`` parts of
a host by a hash, and the parts with each other, each in an order of its own, so that the order of rows does not matter. They give
paths, and which of these are repeated; all figures about them are counted over all pages, each page of equal text once.
A text that is not repeated in its page is the template's by its share of the pages that have its path. Only a caller who
gives ``sample`` has wrappers from about so many pages a host, by a hash of url and page; then texts at paths that these have
are dropped if they are the same on all of them, too. Every page is extracted whole.
Wrappers are broadcast while they are small; else they are joined by host, with each host's pages dealt
over several salts.

Defined cases: null html is empty; no text gives '' and 0; a null url is a host of its own ('');
repeated rows get equal texts; very deep pages cost no recursion; ties go to the element that comes
first; an empty table gives no rows; other columns of the table are never touched.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.store import materialize
from .common import small_batches, table, tidied

SAMPLE = 12
#: Pages of different text on which a text must be the same to count as the template's.
CONSTANT_PAGES = 8
#: And the share of the pages that have a text at its path.
CONSTANT_SHARE = 0.9
#: An element is the region's heart if it holds more than this share of the prose around it; a named one needs NAMED_SHARE.
HEART_SHARE, NAMED_SHARE = 0.5, 0.8
#: An element is full of links if they make up this share of its characters.
LINK_SHARE = 0.5
BROADCAST_BYTES = 32 << 20
SALTS = 32
#: Hosts whose page counts are broadcast (about 30 MB).
BROADCAST_HOSTS = 500_000
#: Products of lengths up to which two token streams are aligned by longest blocks; longer ones in order, by the next of a kind.
LONGEST_BLOCKS = 250_000

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)", re.DOTALL)
RAW = frozenset("script style noscript template textarea iframe svg object select canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that are never content, by what they mean.
ALWAYS = frozenset("nav footer aside form head title button menu dialog".split())
#: Names of elements that are never content; a part of a name counts at its beginning or end.
STRONG = frozenset("ad ads advert adverts advertisement advertising sponsor sponsors sponsored promo promotion cookie cookies consent notice notices popup modal newsletter subscribe comment comments commentlist respond disqus sidebar breadcrumb breadcrumbs nav navbar navigation menu footer".split())
#: Names that count outside the region, and inside it for elements full of links; whole names only.
WEAK = frozenset("header banner share social related search login skip".split())
#: Names of elements that hold no region, however much they hold.
READERS = frozenset("comment comments commentlist respond disqus".split())
NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
#: An element that opens closes these, up to the next list or table.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset(("ul", "ol", "dl", "table"))
SPACE = re.compile(r"\s+")
#: Numbers that differ from page to page: any in an id, those of two digits or more in a class.
DIGITS, NUMBERS = re.compile(r"[0-9]+"), re.compile(r"[0-9]{2,}")
PARTS = re.compile(r"[\s_-]+")


def named(name: str) -> int:
    """2 for a strong name of boilerplate, 1 for a weak one, 3 for readers' comments, else 0."""
    found = 0
    for token in name.lower().split():
        parts = PARTS.split(token)
        for x in (parts[0], parts[-1]):
            if x in READERS:
                return 3
            if x in STRONG:
                found = 2
        if not found and token in WEAK:
            found = 1
    return found


class Node:
    """An element. chars, linked: of its own texts and all below, once measure() has run."""

    __slots__ = ("tag", "name", "children", "many", "maybe", "hint", "chars", "linked")

    def __init__(self, tag: str, name: str = ""):
        self.tag, self.name, self.children, self.many, self.maybe = tag, name, [], False, False
        self.hint = named(name) if name else 0
        self.chars = self.linked = 0

    @property
    def kind(self) -> tuple[str, str]:
        return self.tag, self.name


class Text:
    """value None: a slot. linked: of its characters, those inside links."""

    __slots__ = ("value", "linked", "maybe", "many", "seen")
    kind = ("#", "")

    def __init__(self, value: str | None, linked: int = 0):
        self.value, self.linked, self.maybe, self.many, self.seen = value, linked, False, False, 1


def _name(m: re.Match) -> str:
    value = next(filter(None, m.groups()[1:]), "")
    return (DIGITS if m[1].lower() == "id" else NUMBERS).sub("#", value)


def parse(page: str) -> Node:
    """The tree of a page's block elements; a text is one run between block edges."""
    root = Node("#root")
    stack, text, links, at, raw, link = [root], [], [], 0, None, False
    opened: dict[str, int] = {}

    def add(part: str) -> None:
        text.append(part)
        if link:
            links.append(part)

    def flush() -> None:
        if text:
            value = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if value:
                inside = len(SPACE.sub(" ", entities.unescape("".join(links))).strip()) if links else 0
                stack[-1].children.append(Text(value, min(inside, len(value))))
            links.clear()

    def pop_to(i: int) -> None:
        flush()
        for n in stack[i:]:
            opened[n.tag] -= 1
        del stack[i:]

    def close(tag: str, stop: frozenset = frozenset()) -> None:
        if not opened.get(tag):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                return pop_to(i)
            if stack[i].tag in stop:
                return

    while at < len(page):
        if raw:
            m = re.compile(rf"</{re.escape(raw)}\s*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at, raw = (m.end() if m else len(page)), None
            continue
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "a":
            link = not m[1]
            continue
        if m[1]:
            if tag in BLOCK:
                close(tag)
            continue
        if tag in RAW:
            if not (m[3] or "").rstrip().endswith("/"):
                raw = tag
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCK:
            continue
        flush()
        if tag in VOID:
            continue
        if stack[-1].tag == "p":  # no block stands inside a paragraph
            pop_to(len(stack) - 1)
        for old in CLOSES.get(tag, ()):
            close(old, SCOPE)
        node = Node(tag, " ".join(filter(None, map(_name, NAMED.finditer(m[3] or "")))))
        stack[-1].children.append(node)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return root


def order(root: Node) -> list[Node]:
    """Every element, each before those inside it."""
    out, work = [], [root]
    while work:
        n = work.pop()
        out.append(n)
        work += [c for c in reversed(n.children) if isinstance(c, Node)]
    return out


def measure(root: Node) -> Node:
    for n in reversed(order(root)):
        n.chars = sum(c.chars if isinstance(c, Node) else len(c.value or "") for c in n.children)
        n.linked = sum(c.linked for c in n.children)
    return root


def alike(x, y) -> bool:
    """Of one kind, and half of the kinds in one are in the other too: an unnamed menu and an unnamed body stay apart."""
    if x.kind != y.kind or isinstance(x, Text):
        return x.kind == y.kind
    a, b = {c.kind for c in x.children}, {c.kind for c in y.children}
    return 2 * len(a & b) >= min(len(a), len(b))


def collapse(root: Node) -> Node:
    """Neighbours of one kind and like contents become one repeated group, generalised over all of them."""
    for n in reversed(order(root)):
        out: list = []
        for c in n.children:
            if out and alike(out[-1], c):
                out[-1] = generalise(out[-1], c)
                out[-1].many = True
            else:
                out.append(c)
        n.children = out
    return root


def aligned(a: list, b: list) -> Iterator[tuple[int, int, int, int, bool]]:
    """Blocks (i, j, k, n, equal) of two token streams, in order."""
    if a == b:
        if a:
            yield 0, len(a), 0, len(b), True
        return
    if len(a) * len(b) <= LONGEST_BLOCKS:
        for op, i, j, k, n in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
            yield i, j, k, n, op == "equal"
        return
    places: dict = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    i = k = 0
    for n, x in enumerate(b):
        own = places.get(x, ())
        at = bisect_left(own, i)
        if at < len(own):
            j = own[at]
            if j > i or n > k:
                yield i, j, k, n, False
            yield j, j + 1, n, n + 1, True
            i, k = j + 1, n + 1
    if len(a) > i or len(b) > k:
        yield i, len(a), k, len(b), False


def generalise(wrapper, page):
    """The wrapper widened so that it also matches the page (both of one kind, both collapsed)."""
    work = [(wrapper, page)]
    while work:
        w, p = work.pop()
        w.maybe, w.many = w.maybe or p.maybe, w.many or p.many
        if isinstance(w, Text):
            w.value = w.value if w.value == p.value else None
            w.seen += p.seen
            continue
        out: list = []
        for i, j, k, n, equal in aligned([c.kind for c in w.children], [c.kind for c in p.children]):
            if equal:
                work += zip(w.children[i:j], p.children[k:n], strict=True)
                out += w.children[i:j]
            else:
                for c in [*w.children[i:j], *p.children[k:n]]:
                    c.maybe = True
                    out.append(c)
        merged: list = []
        for c in out:  # two optional neighbours of one kind are a repeated group
            if merged and merged[-1].kind == c.kind and (c.maybe or merged[-1].maybe):
                work.append((merged[-1], c))
                merged[-1].many = merged[-1].maybe = True
            else:
                merged.append(c)
        w.children = merged
    return wrapper


def signed(h: int) -> int:
    """A hash as a long."""
    return h - (1 << 64) if h >> 63 else h


def step(path: int, node: Node) -> int:
    """The hash of a path from the root, one element further down."""
    return signed(xxhash.xxh3_64_intdigest(f"{node.tag}\0{node.name}", path & (1 << 64) - 1))


def block(path: int, text: str) -> int:
    """The hash of a text at a path."""
    return signed(xxhash.xxh3_64_intdigest(text, path & (1 << 64) - 1))


def texts(root: Node) -> Iterator[tuple[int, Text]]:
    """Every text that is not boilerplate by its meaning, with the path of its element."""
    work: list = [(0, root)]
    while work:
        path, x = work.pop()
        if isinstance(x, Text):
            yield path, x
        else:
            work += [(path, c) if isinstance(c, Text) else (step(path, c), c) for c in reversed(x.children) if isinstance(c, Text) or c.tag not in ALWAYS]


def infer(pages: list[str]) -> Node:
    """The wrapper of one host's pages."""
    wrapper = collapse(parse(pages[0]))
    for p in pages[1:]:
        wrapper = generalise(wrapper, collapse(parse(p)))
    return wrapper


def packed(wrapper: Node) -> str:
    """A collapsed tree without its texts."""
    out, work = [], [wrapper]
    while work:
        x = work.pop()
        flags = x.many + 2 * x.maybe
        if isinstance(x, Text):
            out.append(flags)
        else:
            out.append([x.tag, x.name, flags, len(x.children)])
            work += reversed(x.children)
    return json.dumps(out, separators=(",", ":"))


def unpacked(data: str) -> Node:
    top = Node("")
    work = [[top, 1]]
    for item in json.loads(data):
        while not work[-1][1]:
            work.pop()
        x = Text(None) if isinstance(item, int) else Node(item[0], item[1])
        flags = item if isinstance(item, int) else item[2]
        x.many, x.maybe = bool(flags & 1), bool(flags & 2)
        work[-1][0].children.append(x)
        work[-1][1] -= 1
        if isinstance(x, Node):
            work.append([x, item[3]])
    return top.children[0]


def merged(shapes: list[str]) -> Node:
    """One wrapper for trees or wrappers, whatever their order."""
    shapes = sorted(set(shapes))
    wrapper = unpacked(shapes[0])
    for x in shapes[1:]:
        wrapper = generalise(wrapper, unpacked(x))
    return wrapper


def single(wrapper: Node) -> list[int]:
    """The paths of texts that a page has once, if it has them."""
    once, often = set(), set()
    work: list = [(0, wrapper, False)]
    while work:
        path, x, many = work.pop()
        for c in x.children:
            if isinstance(c, Text):
                (often if many or c.many else once).add(path)
            else:
                work.append((step(path, c), c, many or c.many))
    return sorted(once - often)


def described(wrapper: Node, n: int) -> dict:
    """The wrapper of n pages as plain data: nodes [path, path of the parent, tag, hint], each path once; paths that have
    texts; the blocks that are the same on all pages, neither slots, repeated nor optional."""
    nodes, slots, fixed = {}, set(), set()
    work: list = [(0, None, wrapper, n > 1)]
    while work:
        path, above, x, firm = work.pop()
        nodes.setdefault(path, [path, above, x.tag, x.hint])
        for c in reversed(x.children):
            sure = firm and not (c.maybe or c.many)
            if isinstance(c, Text):
                slots.add(path)
                if sure and c.value is not None and c.seen >= n:
                    fixed.add(block(path, c.value))
            else:
                work.append((step(path, c), path, c, sure))
    return {"nodes": list(nodes.values()), "slots": sorted(slots), "fixed": sorted(fixed)}


def judge(nodes: list[list], counts: dict[int, tuple[int, int]]) -> dict:
    """The region of a wrapper and the paths full of links. counts: of the texts at a path, characters and those inside links."""
    at = {p: (above, tag, hint) for p, above, tag, hint in nodes}
    below: dict = {}
    for p, above, _, _ in nodes:
        below.setdefault(above, []).append(p)
    chars, linked, prose, bad = {}, {}, {}, {}
    line, work = [], [0]
    while work:
        p = work.pop()
        line.append(p)
        work += below.get(p, [])
    for p in reversed(line):
        c, k = counts.get(p, (0, 0))
        own = 0 if k >= LINK_SHARE * c else c - k
        kids = below.get(p, ())
        chars[p], linked[p] = c + sum(chars[x] for x in kids), k + sum(linked[x] for x in kids)
        out = at[p][1] in ALWAYS
        prose[p] = 0 if out else own + sum(prose[x] for x in kids)
        bad[p] = chars[p] if out or at[p][2] or linked[p] >= LINK_SHARE * chars[p] else c - own + sum(bad[x] for x in kids)
    total, here = prose[0], 0

    def heart(x: int) -> bool:
        hint = at[x][2]
        return prose[x] > HEART_SHARE * prose[here] and hint != 3 and (not hint or prose[x] >= NAMED_SHARE * total)

    while total and (best := [x for x in below.get(here, ()) if heart(x)]):
        here = max(best, key=lambda x: prose[x])
    up = [here]
    while at[up[-1]][0] is not None:
        up.append(at[up[-1]][0])
    marked = [i for i, p in enumerate(up) if at[p][1] in ("article", "main")]
    i = marked[-1] if marked else 0
    titled = lambda x: any(at[y][1] in ("h1", "h2") for y in below.get(x, ()))
    clean = lambda x: at[x][1] not in ALWAYS and not at[x][2] and 2 * bad[x] < chars[x] and (at[x][1] != "header" or titled(x))
    while not marked and i + 1 < len(up) and all(clean(x) for x in below[up[i + 1]] if chars[x] and x != up[i]):
        i += 1
    full = [p for p in chars if chars[p] and linked[p] >= LINK_SHARE * chars[p]]
    return {"region": up[i] if total else None, "around": up[i:], "full": full}


def of_page(root: Node) -> dict:
    """The decisions of a page's own wrapper."""
    counts: dict = {}
    for path, t in texts(root):
        c, k = counts.get(path, (0, 0))
        counts[path] = (c + len(t.value), k + t.linked)
    nodes, work = {}, [(0, None, root)]
    while work:
        path, above, x = work.pop()
        nodes.setdefault(path, [path, above, x.tag, x.hint])
        work += [(step(path, c), path, c) for c in reversed(x.children) if isinstance(c, Node)]
    return judge(list(nodes.values()), counts)


class Wrapper:
    """What a host's wrapper decided; known: paths that the wrapper has."""

    def __init__(self, data: dict):
        self.region, self.around, self.full = data.get("region"), frozenset(data.get("around", ())), frozenset(data.get("full", ()))
        self.known, self.drop = frozenset(data.get("known", ())), frozenset(data.get("drop", ()))


def extract(page: str, wrapper: Wrapper | None) -> str:
    root = measure(parse(page))
    drop = wrapper.drop if wrapper else ()
    if wrapper is None or wrapper.region is None or not _has(root, wrapper.region):
        wrapper = Wrapper(of_page(root))
    out: list[str] = []
    work: list = [(0, root, wrapper.region == 0)]
    while work:
        path, x, inside = work.pop()
        if isinstance(x, Text):
            if not drop or block(path, x.value) not in drop:
                out.append(x.value)
            continue
        inside = inside or path == wrapper.region
        for c in reversed(x.children):
            if isinstance(c, Text):
                work.append((path, c, inside))
                continue
            below = step(path, c)
            if below in wrapper.around or below == wrapper.region:
                work.append((below, c, inside))
            elif c.tag not in ALWAYS and c.hint < 2:
                links = c.linked >= LINK_SHARE * c.chars if c.chars else False
                if inside:
                    junk = c.hint and links
                else:
                    # the wrapper's word on its own paths; a path full of links on the whole goes, else what is on this page
                    junk = c.hint or c.tag == "header" or links or below in wrapper.full
                if not junk:
                    work.append((below, c, inside))
    return " ".join(out)


def _has(root: Node, region: int) -> bool:
    work = [(0, root)]
    while work:
        path, x = work.pop()
        if path == region:
            return True
        work += [(step(path, c), c) for c in x.children if isinstance(c, Node)]
    return False


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def count_blocks(p: DataFrame, shapes: bool = False) -> DataFrame:
    """(host, path, block, shape, n, chars, linked): on how many pages of different text each block stands, and, with block null, each
    path, and its characters there; of blocks those on CONSTANT_PAGES pages or more. With shapes, also a row for each different tree of the host's pages."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: dict = {}
            trees: set = set()
            seen: set = set()
            for h, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (h, page) in seen:
                    continue
                seen.add((h, page))
                root = parse(page)
                found = [(path, t.value, t.linked) for path, t in texts(root)]
                if shapes:
                    trees.add((h, packed(collapse(root))))
                digest = signed(xxhash.xxh3_64_intdigest(" ".join(t for _, t, _ in found)))
                if (h, digest) in rows:
                    continue
                rows[h, digest] = None
                sums: dict = {}
                for path, t, linked in found:
                    c, k = sums.get(path, (0, 0))
                    sums[path] = (c + len(t), k + linked)
                    rows[h, path, block(path, t), digest] = (None, None)
                for path, x in sums.items():
                    rows[h, path, None, digest] = x
            every = [(*k, None, *v) for k, v in rows.items() if v is not None] + [(h, None, None, None, x, None, None) for h, x in sorted(trees)]
            cols = [*zip(*every, strict=True)] if every else [()] * 7
            kinds = (pa.string(), *[pa.int64()] * 3, pa.string(), *[pa.int64()] * 2)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["host", "path", "block", "page", "shape", "chars", "linked"])

    rows = small_batches(p.select("host", "html")).mapInArrow(run, "host string, path long, block long, page long, shape string, chars long, linked long")
    once = rows.groupBy("host", "path", "block", "page", "shape").agg(F.max("chars").alias("chars"), F.max("linked").alias("linked"))
    often = once.groupBy("host", "path", "block", "shape").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    return materialize(often.filter(F.col("block").isNull() | (F.col("n") >= CONSTANT_PAGES)), "blocks")


def drawn(p: DataFrame, sample: int) -> DataFrame:
    """(host, html): about `sample` different pages of each host, by a hash of url and page. p: (host, url, html)."""
    p = p.withColumn("key", F.xxhash64("url", "html"))
    keys = p.select("host", "key").distinct()
    per = keys.groupBy("host").agg(F.count("*").alias("n"))
    part = F.pmod("key", F.lit(1 << 30)) / F.lit(float(1 << 30))
    if per.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:  # with few enough hosts their counts are broadcast, and only drawn pages are ever dealt out
        few = p.join(F.broadcast(per), "host").filter(part * F.col("n") < sample)
    else:  # only keys meet the hosts' counts; the pages are dealt out by key, not by host
        chosen = keys.join(per, "host").filter(part * F.col("n") < sample).select(F.col("host").alias("_host"), F.col("key").alias("_key"))
        few = p.join(chosen, (p["key"] == chosen["_key"]) & (p["host"] == chosen["_host"]), "left_semi")
    return few.dropDuplicates(["host", "key"]).select("host", "key", "html")


def fit_wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", sample: int | None = None) -> DataFrame:
    """(host, wrapper): the decisions of each host's wrapper, as JSON. sample: from about so many pages a host; else from all."""
    p = pages.select(host(F.col(url_col)).alias("host"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).filter(F.col("html").isNotNull())

    @tidied
    def run(key, t):
        found = [h for _, h in sorted(zip(t.column("key").to_pylist(), t.column("html").to_pylist(), strict=True))]
        return pa.table([pa.array([key[0].as_py()], pa.string()), pa.array([json.dumps(described(infer(found), len(found)))], pa.string())], names=["host", "inferred"])

    @tidied
    def part(key, t):
        return pa.table([pa.array([key[0].as_py()], pa.string()), pa.array([packed(merged(t.column("shape").to_pylist()))], pa.string())], names=["host", "shape"])

    @tidied
    def whole_host(key, t):
        wrapper = merged(t.column("shape").to_pylist())
        # texts are told apart by the counts alone
        data = described(wrapper, 1) | {"single": single(wrapper)}
        return pa.table([pa.array([key[0].as_py()], pa.string()), pa.array([json.dumps(data)], pa.string())], names=["host", "inferred"])

    counted = count_blocks(p, sample is None)
    if sample is None:
        shapes = counted.filter("shape is not null").select("host", "shape", F.pmod(F.xxhash64("shape"), F.lit(SALTS)).alias("salt"))
        inferred = shapes.groupBy("host", "salt").applyInArrow(part, "host string, shape string").groupBy("host").applyInArrow(whole_host, "host string, inferred string")
    else:
        inferred = small_batches(drawn(p, sample)).groupBy("host").applyInArrow(run, "host string, inferred string")
    inferred = materialize(inferred, "inferred")
    counted = counted.filter("shape is null")
    whole = counted.filter("block is null").select("host", "path", F.col("n").alias("n_path"), "chars", "linked")
    # figures of the wrapper's own paths only, so that a host with a third of all pages and ever new paths brings no more rows
    slots = inferred.select("host", F.explode(F.from_json(F.get_json_object("inferred", "$.slots"), "array<long>")).alias("path"))
    figures = slots.join(whole, ["host", "path"]).groupBy("host").agg(F.collect_list(F.struct("path", "chars", "linked")).alias("figures"))
    same = counted.filter("block is not null").select("host", "path", "block", "n").join(whole, ["host", "path"]).filter(F.col("n") >= CONSTANT_SHARE * F.col("n_path"))
    same = same.groupBy("host").agg(F.collect_list(F.struct("path", "block")).alias("same"))

    @tidied
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, figures, same in zip(*[b.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                data = json.loads(text) if text else {"nodes": [], "slots": [], "fixed": []}
                got = judge(data["nodes"], {x["path"]: (x["chars"], x["linked"]) for x in figures or ()}) if data["nodes"] else {}
                slots, fixed = set(data["slots"]), set(data["fixed"])
                # what the wrapper has as slot, repeated or optional stays; at paths it has not seen the counts alone decide
                alone = set(data.get("single", ()))
                got["drop"] = sorted(x["block"] for x in same or () if x["path"] not in slots or x["path"] in alone or x["block"] in fixed)
                out.append(json.dumps(got))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["host", "wrapper"])

    every = inferred.join(same, "host", "full").join(figures, "host", "left").select("host", "inferred", "figures", "same")
    return small_batches(every).mapInArrow(decide, "host string, wrapper string")


def extract_text(pages: DataFrame, wrappers: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars): one row for each row of pages."""
    wrappers = materialize(wrappers, "wrappers")
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        p = p.join(F.broadcast(wrappers), "host", "left")
    else:
        dealt = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        p = p.withColumn("salt", F.pmod(F.xxhash64("url", "id"), F.lit(SALTS)).cast("int")).join(dealt, ["host", "salt"], "left")

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict = {None: None}
        for b in batches:
            out = []
            for page, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if w not in read:
                    read[w] = Wrapper(json.loads(w))
                out.append(extract(page or "", read[w]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["id", "url", "text", "n_chars"])

    types = dict(pages.dtypes)
    out = small_batches(p.select("id", "url", "html", "wrapper")).mapInArrow(run, f"id {types[id_col]}, url {types[url_col]}, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, fit_wrappers(pages))
