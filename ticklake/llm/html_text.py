"""Main text of HTML pages by site style trees.

The pages of a host are merged into one style tree: a node is a path of styled elements.
A leaf node's importance is one minus the mean entropy of its contents over the host's
pages (a content that every page repeats has entropy 1, one that a single page has 0). A
branch is an element that holds blocks (inside a marked article only one with a style of its
own), an inner node of the tree: its layouts are the sequences of blocks and branches that
the elements with its path hold. Its composite importance is the entropy of its layouts, weighed by how many
there are, and the mean importance of what they hold. A branch goes when it, every branch
below it and every leaf in them are of low importance and it is more than headings. A
heading or paragraph that pages repeat next to text of their own, be it in a branch below,
thus always stays. How a branch lays out its children never lowers a leaf. Elements whose markup says that they
are no main text go as well. A marked article is a prior: it adds to the importance of the
leaves in it, and what stands outside it is text where its leaf is of importance.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from bisect import bisect_right
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch

#: Weight of a leaf's contents in its importance; importance below which a branch goes; pages of a host that must show a node before it is judged.
GAMMA = 0.9
LOW = 0.35
MIN_PAGES = 8

#: HTML element names by what they mean for the text.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "math",
       "object", "canvas", "noframes", "xmp"}
NOISE = {"nav", "footer", "aside", "form", "head", "button", "select", "menu", "dialog", "fieldset",
         "label", "input", "option", "datalist", "audio", "video", "map", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
         "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
         "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary",
         "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements that a start tag closes when they are open (their end tags may be left out),
#: and the elements that such a search does not leave.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
          "thead": {"tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
FENCE = {"ul", "ol", "dl", "table", "select", "article", "main", "section", "div", "body", "nav", "aside"}
#: Elements that can be a branch.
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "details", "fieldset", "figure", "center", "header", "hgroup", "address"}
#: Names of furniture: whole classes and whole ids. PLAIN names can also be the slug of a section.
_BEFORE = r"(?:(?:site|page|main|top|bottom|left|right|cookie|social|post|share|sharing|newsletter|primary|secondary|global|sub)[_-])?"
_AFTER = (r"(?:[_-](?:ads?|nav|banner|bar|box|buttons?|links?|list|form|popup|area|section|container|wrapper|slot|posts?|"
          r"articles?|items?|menu|widgets?|left|right|top|bottom|inner|content|icons?|message|primary|secondary|\d+))*")
_SURE = (r"ads?|advert(?:s|isement)?s?|adsense|sponsored|cookies?|consent|gdpr|newsletter|subscribe|signup|popup|modal|nav|"
         r"navbar|navigation|breadcrumbs?|sidebar|side-bar|footer|masthead|comments?|disqus(?:_thread)?|respond|share|sharing|"
         r"toolbar|pagination|pager|login")
_PLAIN = (r"sponsors?|promo(?:s|tions?|ted)?|banner|notices?|overlay|menu|aside|replies|related|recommend(?:ed|ations?)|social|"
          r"widget|skip")
SURE = re.compile(f"{_BEFORE}(?:{_SURE}){_AFTER}", re.I)
FURNITURE = re.compile(f"{_BEFORE}(?:{_SURE}|{_PLAIN}){_AFTER}", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HEADER = re.compile(r"(?:(?:site|page|main|top|global|blog|web)[_-])?header(?:[_-](?:bar|nav|wrap|wrapper|container|inner|top|logo|area|\d+))*", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "alert", "menu", "menubar", "toolbar"}
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
SPECIAL = re.compile(r"[>\"']")
ATTR = re.compile(r"(?<![^\s\"'/])([^\s=\"'/>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
#: Tags of a page without an end, after which its other "<" are text.
UNENDED = 32


def _furniture(name: str, ids: str, classes: str) -> bool:
    """Whether one of an element's ids or classes is a name of furniture; a heading's id is its
    slug, and a section's may be."""
    known = SURE if name == "section" else FURNITURE
    return (name not in HEADINGS and any(known.fullmatch(x) for x in ids.split())
            or any(FURNITURE.fullmatch(x) for x in classes.split()))


def _style(name: str, attrs: str, in_main: bool) -> tuple[str, bool, bool]:
    """An element's style (name, class and role), whether its markup says that it is no
    main text, and whether it says that it is."""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return name, name in NOISE, name in ("article", "main")
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
    cls, role = got.get("class", ""), got.get("role", "").lower()
    noise = (name in NOISE or role in ROLES or _furniture(name, got.get("id", ""), cls)
             or not in_main and any(HEADER.fullmatch(x) for x in cls.split())
             or bool(HIDDEN.search(attrs)) or got.get("aria-hidden") == "true")
    if name in ("html", "body", "article", "main"):
        noise = False
    style = name + "".join("." + c for c in sorted(cls.split())) + (f"[{role}]" if role else "")
    return style, noise, name in ("article", "main") or role in ("main", "article")


def tags(text: str):
    """(start, end, name, attributes) of a page's tags, (start, end, "", "") of its comments,
    declarations and raw elements. The name of an end tag begins with a slash. Each character is read a bounded
    number of times: what has no end is known after the first search for it."""
    at, ended, quotes, unended = 0, True, {'"': True, "'": True}, 0
    last_end = text.rfind(">")
    failed: list[tuple[list[int], list[int]]] = []  # quoted spans of searches that met no end
    while ended and unended < UNENDED and (start := text.find("<", at)) >= 0:
        m = NAME.match(text, start)
        if not m:
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                end = end + 3 if end >= 0 else len(text)
            elif text.startswith(("<!", "<?", "</"), start):
                end = text.find(">", start) + 1
                ended = end > 0
            else:
                at = start + 1
                continue
            if ended:
                yield start, end, "", ""
                at = end
            continue
        j = m.end()
        # a search that begins outside the quotes of one that met no end goes the same way
        if j > last_end or any((k := bisect_right(opens, j - 1)) == 0 or closes[k - 1] < j for opens, closes in failed):
            unended += 1
            at = start + 1
            continue
        before, opens, closes = dict(quotes), [], []
        while (s := SPECIAL.search(text, j)) and s[0] != ">":
            close = text.find(s[0], s.end()) if quotes[s[0]] else -1
            quotes[s[0]] = close >= 0
            if close >= 0:
                opens.append(s.start())
                closes.append(close)
            j = close + 1 if close >= 0 else s.end()
        if not s:
            if before == quotes:
                failed.append((opens, closes))
            else:
                failed.clear()
            unended += 1
            at = start + 1
            continue
        slash = "/" if text[start + 1] == "/" else ""
        name, attrs, at = m[1].lower(), text[m.end():s.start()], s.end()
        if name in RAW and not slash and not attrs.rstrip().endswith("/"):
            # a raw element is one piece, up to the first of its end tags
            last = re.compile(f"</{name}(?=[\\s/>])", re.I).search(text, at)
            at = (text.find(">", last.end()) + 1 or len(text)) if last else len(text)
            name, attrs = "", ""
        yield start, at, slash + name, attrs


class _Open(NamedTuple):
    """An open element: its path's digest, the paths of its block and of its branch, and which of
    the page's branches that is (0: none)."""

    name: str
    path: str
    noise: bool
    main: bool
    block: str
    branch: str
    nth: int


class Layout(NamedTuple):
    """What an element that is a branch holds: (path, whether it is a leaf) of its children, a run of
    equal ones as one. ``nth``: its number on the page."""

    nth: int
    path: str
    inside: bool
    above: str
    children: list[tuple[str, bool]]


def _path(parent: str, style: str) -> str:
    return hashlib.blake2b(f"{parent}>{style}".encode("utf-8", "replace"), digest_size=8).hexdigest()


def parse(text: str) -> tuple[list[tuple[str, str, bool, str, bool]], list[tuple[str, str, int]]]:
    """Blocks (path, text, in the marked article, branch, a heading) without noise, and the page's
    leaves of the style tree: (path, 'main' in the marked article and 'leaf' elsewhere, content
    hash). Paths and branches are digests; a block outside any branch has an empty one."""
    return parse_tree(text)[:2]


def parse_tree(text: str) -> tuple[list[tuple[str, str, bool, str, bool]], list[tuple[str, str, int]], list[Layout]]:
    """``parse``, and the layouts of the branches that hold blocks."""
    blocks: list[tuple[str, str, bool, str, bool]] = []
    tree: set[tuple[str, str, int]] = set()
    stack = [_Open("", "", False, False, "", "", 0)]
    opened: list[tuple[str, bool, int]] = [("", False, 0)]  # branches: path, in the marked article, the one above
    shown: set[int] = {0}
    layouts: dict[int, Layout] = {}
    count: Counter[str] = Counter()  # open elements by name
    held: list[str] = []
    held_at: list[tuple[_Open, bool]] = []

    def place(k: int, path: str, leaf: bool) -> None:
        if k:
            if k not in layouts:
                name, inside, up = opened[k]
                layouts[k] = Layout(k, name, inside, opened[up][0], [])
            children = layouts[k].children
            if not children or children[-1] != (path, leaf):
                children.append((path, leaf))

    def flush() -> None:
        if held:
            body = " ".join(html.unescape("".join(held)).split())
            top, heading = held_at[0]
            if body and not top.noise:
                tree.add((top.block, "main" if top.main else "leaf", zlib.crc32(body.encode("utf-8", "replace"))))
                blocks.append((top.block, body, top.main, top.branch, heading))
                place(top.nth, top.block, True)
                k = top.nth
                while k not in shown:  # the branches that this block is the first of
                    shown.add(k)
                    place(opened[k][2], opened[k][0], False)
                    k = opened[k][2]
            held.clear()
            held_at.clear()

    def hold(part: str) -> None:
        if part:
            if not held_at:
                if part.isspace():
                    return
                held_at.append((stack[-1], any(count[h] for h in HEADINGS)))
            held.append(part)

    def close(k: int) -> None:
        """Close the open elements from the k-th on."""
        for e in stack[k:]:
            count[e.name] -= 1
        del stack[k:]

    at = 0
    for start, end, name, attrs in tags(text):
        hold(text[at:start])
        at = end
        if not name:
            continue
        if name[0] == "/":
            name = name[1:]
            k = len(stack) - 1
            if count[name]:
                while stack[k].name != name:
                    k -= 1
            else:
                k = 0
            if name in BLOCK or k and stack[k].noise != stack[k - 1].noise:
                flush()
            if k:
                close(k)
            continue
        if name in ("br", "hr"):
            hold(" " if held else "")
        single = attrs.rstrip().endswith("/")
        if name in BLOCK:
            flush()
            if count["p"]:  # a block ends an open paragraph
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == "p":
                        close(k)
                        break
                    if stack[k].name in BLOCK:
                        break
        if name in CLOSES and any(count[x] for x in CLOSES[name]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in CLOSES[name]:
                    close(k)
                    break
                if stack[k].name in FENCE:
                    break
        top = stack[-1]
        style, noise, main = _style(name, attrs, top.main)
        if noise and not top.noise:
            flush()
        if name == "header" and not top.main:
            noise = True
        if name not in VOID and not single:
            path = _path(top.path, style)
            if main and not top.main:
                branch, nth = "", 0
            elif name in CONTAINERS and (style != name or not top.main):
                branch, nth = path, len(opened)
                opened.append((path, top.main, top.nth))
            else:
                branch, nth = top.branch, top.nth
            stack.append(_Open(name, path, top.noise or noise, top.main or main, path if name in BLOCK else top.block, branch, nth))
            count[name] += 1
    hold(text[at:])
    flush()
    return blocks, sorted(tree), list(layouts.values())


BLOCKS = "blocks array<struct<path:string,body:string,main:boolean,branch:string,heading:boolean>>"
TREE = "tree array<struct<path:string,kind:string,h:long>>"
LAYOUTS = ("layouts array<struct<nth:int,path:string,inside:boolean,above:string,h:string,"
           "children:array<struct<path:string,leaf:boolean,share:double>>>>")


def _shares(layout: Layout) -> dict:
    """A layout with a digest and each child's share of its children."""
    n = Counter(layout.children)
    return {"nth": layout.nth, "path": layout.path, "inside": layout.inside, "above": layout.above,
            "h": _path("", " ".join(f"{path}{leaf:d}" for path, leaf in layout.children)),
            "children": [{"path": path, "leaf": leaf, "share": c / len(layout.children)} for (path, leaf), c in sorted(n.items())]}


def _parse_pages(batches):
    blocks_type = pa.list_(pa.struct([("path", pa.string()), ("body", pa.string()), ("main", pa.bool_()),
                                      ("branch", pa.string()), ("heading", pa.bool_())]))
    tree_type = pa.list_(pa.struct([("path", pa.string()), ("kind", pa.string()), ("h", pa.int64())]))
    layouts_type = pa.list_(pa.struct([
        ("nth", pa.int32()), ("path", pa.string()), ("inside", pa.bool_()), ("above", pa.string()), ("h", pa.string()),
        ("children", pa.list_(pa.struct([("path", pa.string()), ("leaf", pa.bool_()), ("share", pa.float64())])))]))
    for batch in batches:
        done, size = 0, 0
        blocks, trees, layouts = [], [], []

        def out(to):
            return pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(done, to - done) for k in range(3)), pa.array(blocks, blocks_type),
                 pa.array(trees, tree_type), pa.array(layouts, layouts_type)], ["key", "id", "url", "blocks", "tree", "layouts"])

        for i, page in enumerate(batch.column(3)):
            text = page.as_py() or ""
            b, t, shapes = parse_tree(text)
            blocks.append([{"path": p, "body": x, "main": m, "branch": r, "heading": h} for p, x, m, r, h in b])
            trees.append([{"path": p, "kind": k, "h": h} for p, k, h in t])
            layouts.append([_shares(x) for x in shapes])
            size += len(text)
            if size > 4_000_000:
                yield out(i + 1)
                done, size, blocks, trees, layouts = i + 1, 0, [], [], []
        if blocks:
            yield out(batch.num_rows)


def host_of(url):
    """The host of an address in lower case, without port and user; null if it has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def importance(parsed: DataFrame) -> DataFrame:
    """(host, path, kind, pages, importance) of the leaf nodes of each host's style tree."""
    seen = parsed.select("host", F.explode("tree").alias("t")).select("host", "t.path", "t.kind", "t.h")
    # counts of one content first, so a hot host is summed up before each shuffle
    each = seen.groupBy("host", "path", "kind", "h").agg(F.count("*").alias("c"))
    pages = parsed.select("host", F.explode(F.array_distinct(F.transform("tree", lambda t: F.struct(
        t["path"].alias("path"), t["kind"].alias("kind"))))).alias("t")).groupBy(
        "host", F.col("t.path").alias("path"), F.col("t.kind").alias("kind")).agg(F.count("*").alias("m"))
    node = each.groupBy("host", "path", "kind").agg(
        F.sum("c").alias("total"), F.sum(F.col("c") * F.log("c")).alias("clogc")).join(
        pages, ["host", "path", "kind"])
    content = 1 - F.col("clogc") / F.col("total") / F.log(F.greatest("m", F.lit(2)))
    prior = F.when(F.col("kind") == "main", 1.0).otherwise(0.0)
    return node.select("host", "path", "kind", F.col("m").alias("pages"),
                       (GAMMA * content + (1 - GAMMA) * prior).alias("importance"))


NODE = ["host", "path", "inside"]


def _up(scratch: Scratch, nodes: DataFrame, sums: bool) -> DataFrame:
    """``nodes`` (host, path, inside, above, value and, for sums, weight: of the node in the one
    above) with each value taken together with those of all nodes below: the sum, each weighed
    along its way up, or the largest. Reaches double each round, so a tree that is d deep takes log2 d."""
    while not nodes.where("above <> ''").isEmpty():
        below = nodes.where("above <> ''").select(
            "host", F.col("above").alias("path"), "inside", (F.col("value") * F.col("weight") if sums else F.col("value")).alias("_v"))
        below = below.groupBy(*NODE).agg((F.sum("_v") if sums else F.max("_v")).alias("_v"))
        over = nodes.select("host", F.col("path").alias("above"), "inside", F.col("above").alias("_above"),
                            *([F.col("weight").alias("_weight")] if sums else []))
        nodes = nodes.join(below, NODE, "left").join(over, ["host", "above", "inside"], "left").select(
            *NODE, F.coalesce("_above", F.lit("")).alias("above"),
            (F.col("value") + F.coalesce("_v", F.lit(0.0)) if sums else F.greatest("value", "_v")).alias("value"),
            *([(F.col("weight") * F.coalesce("_weight", F.lit(1.0))).alias("weight")] if sums else []))
        nodes = scratch.keep(nodes, "up")
    return nodes


def composite(scratch: Scratch, layouts: DataFrame, leaves: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """(host, path, inside, importance, highest) of the branches in ``layouts`` (host, path, inside,
    above, h, children; one row per element with the branch's path). ``leaves``: (host, path, inside,
    importance); a leaf that is not there counts 1. With l layouts a branch's importance is
    (1 - gamma^l) times the entropy of its layouts and gamma^l times the mean importance of
    their children. ``highest``: the largest importance of it and of all below, leaves included."""
    each = layouts.groupBy(*NODE, "above", "h").agg(F.count("*").alias("c"))
    shape = each.groupBy(*NODE, "above").agg(
        F.sum("c").alias("m"), F.count("*").alias("l"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    # all elements alike: 0; a single one: 1
    entropy = F.when(F.col("m") > 1, 1 - F.col("clogc") / F.col("m") / F.log(F.greatest("m", F.lit(2)))).otherwise(1.0)
    less = F.pow(F.lit(gamma), F.col("l"))
    shape = scratch.keep(shape.select(*NODE, "above", "m", less.alias("less"), ((1 - less) * entropy).alias("own")), "shapes")
    child = layouts.select(*NODE, F.explode("children").alias("c")).groupBy(
        *NODE, F.col("c.path").alias("child"), F.col("c.leaf").alias("leaf")).agg(F.sum("c.share").alias("share"))
    child = scratch.keep(child.join(shape.select(*NODE, "m", "less"), NODE).select(
        *NODE, "child", "leaf", (F.col("less") * F.col("share") / F.col("m")).alias("weight")), "children")
    held = child.where("leaf").join(leaves.withColumnRenamed("path", "child"), ["host", "child", "inside"], "left").withColumn(
        "importance", F.coalesce("importance", F.lit(1.0))).groupBy(*NODE).agg(
        F.sum(F.col("weight") * F.col("importance")).alias("held"), F.max("importance").alias("leaf_high"))
    weights = child.where("not leaf").select("host", F.col("path").alias("above"), "inside", F.col("child").alias("path"), "weight")
    nodes = shape.join(held, NODE, "left").join(weights, [*NODE, "above"], "left").select(
        *NODE, "above", (F.col("own") + F.coalesce("held", F.lit(0.0))).alias("value"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("leaf_high", F.lit(0.0)).alias("leaf_high"))
    nodes = scratch.keep(nodes, "branches")
    own = scratch.keep(_up(scratch, nodes.drop("leaf_high"), True).select(*NODE, F.col("value").alias("importance")), "composite")
    high = nodes.join(own, NODE).select(*NODE, "above", F.greatest("importance", "leaf_high").alias("value"))
    return _up(scratch, scratch.keep(high, "highest"), False).select(*NODE, F.col("value").alias("highest")).join(own, NODE)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """(id, url, text) per row of ``pages``: the blocks of the main text, joined by blank lines.

    Noise apart, a page that marks an article or main element gives that element's blocks
    and other pages give all blocks, but where the host's style tree (a node seen on at least
    ``min_pages`` pages, copies of a page counted once) says otherwise: a branch that is of low
    composite importance with all below it and not only headings goes, in the article too, and a leaf
    outside the article that is not of low importance stays. A page whose text would all go
    keeps its article. Null or empty html gives an empty text. Pages without a host form no
    tree, which changes nothing on them. Repeated rows and ids are pages of their own. A page
    is parsed in time in proportion to its length, however its tags are nested or cut off.
    Other columns are not read.
    """
    scratch = Scratch(pages.sparkSession)
    rows = pages.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                        F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()
    parsed = rows.mapInArrow(_parse_pages, f"key long, id {kind}, url string, {BLOCKS}, {TREE}, {LAYOUTS}")
    # written once: the keys of the pages stay what they are
    parsed = scratch.keep(parsed.withColumn("host", host_of("url")), "parsed")
    known = parsed.where("host is not null")
    nodes = scratch.keep(importance(known.select("host", "tree").distinct()).where(F.col("pages") >= min_pages).select(
        "host", "path", (F.col("kind") == "main").alias("inside"), "importance"), "leaves")
    leaves, nodes = nodes, nodes.withColumn("faint", F.col("importance") < low).drop("importance")
    # a branch can be faint if all its own leaves are and one is no heading
    inside, of_block = F.col("inside"), F.explode("blocks").alias("b")
    placed = known.select("host", of_block).select("host", "b.branch", "b.path", F.col("b.main").alias("inside"), "b.heading").distinct()
    branches = placed.where("branch <> ''").join(nodes, NODE, "left").groupBy("host", "branch", "inside").agg(
        (F.bool_and(F.coalesce("faint", F.lit(False))) & ~F.bool_and("heading")).alias("gone"))
    branches = scratch.keep(branches.where("gone").drop("gone"), "faint")
    if not branches.isEmpty():
        # and it is if its composite importance and that of all below it are low
        layouts = known.join(branches.select("host").distinct(), "host", "left_semi").select(
            "host", F.xxhash64("tree").alias("copy"), F.explode("layouts").alias("a")).select("host", "copy", "a.*").distinct()
        low_ones = composite(scratch, layouts, leaves).where(F.col("highest") < low)
        branches = branches.join(low_ones.select("host", F.col("path").alias("branch"), "inside"), ["host", "branch", "inside"], "left_semi")
    gone = placed.join(branches, ["host", "branch", "inside"]).select("host", "path", "inside").distinct()
    # what can change a page: the leaves of a branch that goes, and those of importance outside an article
    nodes = nodes.where("not inside and not faint").select("host", "path", "inside", F.lit(False).alias("goes")).unionByName(
        gone.withColumn("goes", F.lit(True)))
    nodes = scratch.keep(nodes, "nodes")
    has_main = F.exists("blocks", lambda b: b["main"])
    leaves = known.select("key", "host", has_main.alias("has_main"), F.explode(F.array_distinct(F.transform(
        "blocks", lambda b: F.struct(b["path"].alias("path"), b["main"].alias("inside"))))).alias("b")).select(
        "key", "host", "has_main", "b.path", "b.inside")
    changed = leaves.join(nodes, ["host", "path", "inside"]).where(
        F.col("goes") == (inside | ~F.col("has_main"))).groupBy("key").agg(
        F.collect_set(F.struct("path", "inside")).alias("changed"))
    changed = scratch.keep(changed, "changed")

    def stays(b):
        own = F.struct(b["path"].alias("path"), b["main"].alias("inside"))
        return (b["main"] | ~has_main) != F.coalesce(F.array_contains("changed", own), F.lit(False))

    kept = F.filter("blocks", stays)
    main = F.filter("blocks", lambda b: b["main"])
    out = parsed.select("key", "id", "url", "blocks").join(changed, "key", "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col),
        F.array_join(F.transform(F.when(F.size(kept) > 0, kept).otherwise(main), lambda b: b["body"]),
                     "\n\n").alias("text"))
    out = scratch.keep(out, "main-text")
    scratch.close(out)
    return out
