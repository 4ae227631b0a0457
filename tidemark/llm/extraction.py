"""Main text of web pages with a site style tree.

All pages of a host are merged into one tree of styles: an element is known by its path of
tags and classes, its presentations are the sequences of child elements it was seen with,
and its content the blocks of text and the link targets below it.  Over the ``m`` elements
merged into a node,

* presentation importance is ``-sum p log_m p`` over its presentations: 0 if all pages lay
  it out alike, 1 if each does so in its own way;
* content importance is ``1 - mean log_m n`` over its contents, ``n`` being how many of the
  elements hold a content: 0 if they are the same everywhere, 1 if found once only;
* importance is ``(1 - g^l) presentation + g^l content`` with ``l`` child elements on average.

A branch below ``threshold`` is template and is removed from every page of the host.

Elements at any depth are nodes; long paths are carried as a running hash.  A text or link counts
for all elements round it that are among the outer 64 levels of blocks or at most 64 levels
above it.  To the others further up the block 64 levels below them counts as one content, so the
work on a page grows with its length and not with its length times its depth.

What HTML itself says comes first, since a host with few pages gives no evidence: navigation,
page headers, footers, asides, forms, scripts, styles and hidden parts go, as do elements
whose class, id or role names a menu, advert, notice, share bar or reader comments; ``main``,
or else ``article``, holds the main text where a page has one.  The tree decides on what is left:
on the branches inside these, or on the whole page where it has neither; ``main`` and ``article``
themselves stay.

A word in a class or id, and a form, may also stand for a wrapper of the whole page
(``page-with-sidebar``, ``search-results-page``).  Such an element is opened, that is, taken for
a plain one, if it holds the page's ``main``, or articles with more text than all that lies
outside such elements (where an article lies outside, one article with more text than that); and
where nothing else of a page has text, the outermost with text are.  The tree judges opened
branches like others.

The text keeps all other blocks in page order: character references decoded, white space in
a block turned into one space, blocks joined by an empty line.  Nothing is cut.  Pages are
parsed in Python in two passes; counts of the tree are Spark aggregations keyed by host,
path and content, so a host with a third of all pages is spread over its contents.

Null and empty pages have an empty text.  Null urls, and urls without host, form one site.
Pages left open or broken in a tag are closed at their end.  Repeated pages count again in
the tree and get equal texts.  Where the tree would leave nothing of a page (a host of copies),
the page keeps all that HTML does not rule out; with nothing outside opened elements, it is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, unpacked
from tidemark.scratch import stage

GAMMA, THRESHOLD, MIN_SEEN = 0.9, 0.3, 5
#: Paths longer than this go on from a hash of what they were; blocks this far apart meet by a hash, see above.
PATH, NEAR = 200, 64
#: Contents handed on at once by a task.
HELD = 500_000
NEW = ("text", "n_chars")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# What HTML fixes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
          "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"})}

# What is never main text, by tag, by role, and by a word in a class or id.
NOISE_TAGS = frozenset("nav footer aside form script style head title template iframe object svg canvas button select "
                       "textarea input noscript dialog menu audio video".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset("nav navbar navigation navi menu submenu footer sidebar aside ad ads adv advert adverts advertisement "
                        "advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice "
                        "notices notification alert popup modal overlay newsletter subscribe subscription signup share "
                        "sharing social breadcrumb breadcrumbs pagination pager related recommended recommendations "
                        "comment comments respond disqus widget widgets toolbar topbar masthead login search skip".split())
NEGATED = frozenset("has with no without".split())
PAGE_HEADER = frozenset(["header"])
#: Noise that may be a wrapper of the page, and noise that may not.
SOFT, HARD = 1, 2
SOFT_ROLES = frozenset("form search".split())
KEPT = frozenset("html body main".split())
#: An outermost article is only ruled out by what cannot be said of a page's own article.
NOT_ARTICLE = frozenset("comment comments ad ads advert advertisement sponsored related recommended promo".split())


class Node:
    __slots__ = ("tag", "name", "parent", "children", "noise", "opened")

    def __init__(self, tag: str, name: str, parent: Node | None, noise: int) -> None:
        self.tag, self.name, self.parent, self.noise = tag, name, parent, noise
        self.opened = False
        self.children: list[Node | str] = []


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(value.strip("\"'")))
    return found


def _noise(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """How far HTML itself marks the element as no part of a main text: 0, ``SOFT`` or ``HARD``."""
    soft = SOFT if tag == "form" else 0
    if (tag in NOISE_TAGS and not soft) or (tag == "header" and not in_article):
        return HARD
    if not attributes or tag in KEPT:
        return soft
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return HARD
    if attributes.get("style") and "display:none" in attributes["style"].replace(" ", "").lower():
        return HARD
    role = attributes.get("role", "").lower()
    if role in NOISE_ROLES:
        return SOFT if role in SOFT_ROLES else HARD
    noise = NOT_ARTICLE if tag == "article" and not in_article else NOISE_WORDS
    for name in attributes.get("class", "").split() + attributes.get("id", "").split():
        words = [w.lower() for w in NAME_PART.findall(name)]
        if words and words[0] not in NEGATED and any(
                w in noise or (w in PAGE_HEADER and not in_article) for w in words):
            return HARD if tag == "article" else SOFT
    return soft


def parse(html: str) -> Node:
    """The element tree, with tags left open closed as browsers do."""
    root = Node("", "", None, 0)
    here, open_tags = root, {}
    at, end = 0, len(html)

    def close(stop: Node) -> Node:
        nonlocal here
        while here is not stop:
            open_tags[here.tag] -= 1
            here = here.parent
        open_tags[stop.tag] -= 1
        here = stop.parent
        return here

    def find(tags, barriers=()) -> Node | None:
        node = here
        while node.parent is not None:
            if node.tag in tags:
                return node
            if node.tag in barriers:
                return None
            node = node.parent
        return None

    for token in TOKEN.finditer(html):
        start = token.start()
        if start < at:
            continue
        if start > at:
            here.children.append(html[at:start])
        at = token.end()
        tag = token[3]
        if tag is None:
            if token[1]:
                here.children.append(token[1])
            continue
        tag = tag.lower()
        if token[2]:
            if open_tags.get(tag):
                inline = tag not in BLOCK
                node = find((tag,), BLOCK if inline else ())
                if node is not None:
                    close(node)
            continue
        if tag in CLOSES_P and open_tags.get("p"):
            node = find(("p",), ("table", "td", "th", "caption", "button", "object"))
            if node is not None:
                close(node)
        elif tag in CLOSES:
            tags, barriers = CLOSES[tag]
            if any(open_tags.get(t) for t in tags):
                node = find(tags, barriers)
                if node is not None:
                    close(node)
        source = token[4]
        attributes = _attributes(source) if len(source) > 2 else {}
        in_article = bool(open_tags.get("article") or open_tags.get("main"))
        name = tag
        if attributes.get("class"):
            name += "." + ".".join(sorted(attributes["class"].split()))
        node = Node(tag, name, here, _noise(tag, attributes, in_article))
        here.children.append(node)
        if tag == "a" and "href" in attributes:
            node.name = name + "@" + attributes["href"]
        if tag in RAW:
            stop = re.compile("</" + tag + r"[\s/>]", re.I).search(html, at)
            at = stop.start() if stop else end
            if stop:
                close_at = html.find(">", at)
                at = close_at + 1 if close_at >= 0 else end
        elif tag not in VOID and not (source.endswith("/>") and tag not in BLOCK):
            open_tags[tag] = open_tags.get(tag, 0) + 1
            here = node
    if at < end:
        here.children.append(html[at:end])
    _open_wrappers(root)
    return root


def main_roots(root: Node) -> list[Node]:
    """The outermost ``main`` elements, else the outermost articles, outside noise; else the page."""
    found = {"main": [], "article": []}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.noise:
            continue
        inside = True
        if node.tag in found:
            found[node.tag].append(node)
            inside = node.tag == "article" and not found["main"]
        if inside:
            stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    if found["main"]:
        return found["main"]
    outer = []
    for node in found["article"]:
        above = node.parent
        while above is not None and above not in outer:
            above = above.parent
        if above is None:
            outer.append(node)
    return outer or [root]


def _text_size(tops: list[Node]) -> int:
    """Characters of text outside noise."""
    size, stack = 0, list(tops)
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            size += len(node.strip())
        elif not node.noise:
            stack.extend(node.children)
    return size


def _soft_within(tops: list[Node]) -> list[Node]:
    """The outermost soft noise."""
    found, stack = [], list(tops)
    while stack:
        node = stack.pop()
        if node.noise == SOFT:
            found.append(node)
        elif not node.noise:
            stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return found


def _wrapped(tops: list[Node]) -> tuple[bool, list[tuple[Node, list[Node]]]]:
    """Whether an article lies outside noise, and (node, soft noise round it from the outside) of others and of ``main``."""
    clear, found = False, []
    stack: list = [(top, None) for top in reversed(tops)]
    while stack:
        node, around = stack.pop()
        if node.noise == HARD:
            continue
        if node.noise == SOFT:
            around = (node, around)
        elif node.tag == "article" or (node.tag == "main" and around):
            if not around:
                clear = True
                continue
            chain = []
            while around:
                chain.append(around[0])
                around = around[1]
            found.append((node, chain[::-1]))
            continue
        stack.extend((c, around) for c in reversed(node.children) if not isinstance(c, str))
    return clear, found


def _open(wrappers: list[Node]) -> None:
    """Takes the elements for plain ones, and those next inside as long as no text has come out."""
    while wrappers:
        for node in wrappers:
            node.noise, node.opened = 0, True
        if _text_size(wrappers):
            return
        wrappers = _soft_within(wrappers)


def _open_wrappers(root: Node) -> None:
    """Opens the soft noise that wraps the page's main text, see above."""
    levels = 1
    while True:
        roots = main_roots(root)
        has_main = roots[0].tag == "main"
        clear, found = _wrapped(roots if has_main else [root])
        mains = [f for f in found if f[0].tag == "main"]
        if mains and not has_main:
            found = mains
        elif found:
            sizes = [_text_size([node]) for node, _ in found]
            outside = _text_size(roots)
            if clear:
                found = [f for f, size in zip(found, sizes) if size > outside and size == max(sizes)]
            elif sum(sizes) <= outside:
                found = []
        if not found:
            break
        # Step by step, so that boxes within a wrapper are judged by what it holds outside them.
        for node in {n: None for _, chain in found for n in chain[:levels]}:
            node.noise, node.opened = 0, True
        levels *= 2
    if not _text_size(roots):
        _open(_soft_within(roots))
        root.opened = True


def _path_name(node: Node) -> str:
    return node.name.split("@")[0]


def _below(path: str, node: Node) -> str:
    path = path + "/" + _path_name(node)
    return path if len(path) <= PATH else "#" + xxhash.xxh3_128_hexdigest(path)


def text_of(root: Node, template: frozenset[str] = frozenset()) -> str:
    """The blocks of main text; branches whose path is in ``template`` go, but not the roots."""
    blocks: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            block = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if block:
                blocks.append(block)

    for top in main_roots(root):
        stack: list = [(top, "")]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
                continue
            node, path = item
            if isinstance(node, str):
                buffer.append(node)
                continue
            if node.noise:
                if node.tag in BLOCK:
                    flush()
                continue
            if template and node.tag:
                path = _below(path, node)
                if node is not top and path in template:
                    flush()
                    continue
            if node.tag == "br":
                buffer.append(" ")
                continue
            if node.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend((c, path) for c in reversed(node.children))
        flush()
    return "\n\n".join(blocks)


PRIME, BASE = 2 ** 61 - 1, 1_000_003_579


def observations(root: Node) -> Iterator[tuple[str, int, int, list[int]]]:
    """(path, presentation, children, contents) of each element that HTML does not decide on."""
    seen: list[tuple[str, Node, set[int]]] = []
    chain: list[set[int]] = []  # contents of the blocks now open, the outermost first
    total = n = 0               # a rolling hash of all contents, for those of a block as one

    def hold(content: int) -> None:
        nonlocal total, n
        total, n = (total * BASE + content) % PRIME, n + 1
        for contents in chain if len(chain) <= 2 * NEAR else chain[:NEAR] + chain[-NEAR:]:
            contents.add(content)

    roots = main_roots(root)
    tops = frozenset(roots)
    stack: list = [(top, "") for top in reversed(roots)]
    while stack:
        node, path = stack.pop()
        if node is None:
            chain.pop()
            before, had = path
            if len(chain) >= 2 * NEAR and n > had:
                chain[-NEAR].add((total - before * pow(BASE, n - had, PRIME)) % PRIME)
            continue
        if isinstance(node, str):
            if not node.isspace():
                hold(xxhash.xxh3_64_intdigest(" ".join(unescape(node).split())) >> 1)
            continue
        if node.noise:
            continue
        if node.tag:
            path = _below(path, node)
            if node.tag in BLOCK and node not in tops:
                chain.append(set())
                seen.append((path, node, chain[-1]))
                stack.append((None, (total, n)))
        if "@" in node.name:
            hold(xxhash.xxh3_64_intdigest(node.name) >> 1)
        stack.extend((c, path) for c in reversed(node.children))
    for path, node, contents in seen:
        children = [c.name.split("@")[0] for c in node.children if not isinstance(c, str)]
        yield path, xxhash.xxh3_64_intdigest(" ".join(children)) >> 1, len(children), sorted(contents)


def style_tree(pages: DataFrame, site: str, html: str) -> DataFrame:
    """(site, path, seen, presentation, content, importance) of the merged tree of each site."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("site", pa.string()), ("path", pa.string()), ("style", pa.int64()), ("children", pa.int32()),
                            ("contents", pa.list_(pa.int64()))])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part, rows, held = batch.slice(start, 200), [], 0
                for s, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for o in observations(parse(h or "")):
                        rows.append((s, *o))
                        held += len(o[3]) + 1
                        if held >= HELD:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    seen = stage(pages.select(site, html).mapInArrow(run, "site string, path string, style long, children int, contents array<long>"), "style-tree")
    node = ["site", "path"]
    styles = seen.groupBy(*node, "style").agg(F.count("*").alias("n"), F.sum("children").alias("children"))
    of_style = styles.groupBy(*node).agg(F.sum("n").alias("seen"), F.sum(F.col("n") * F.log("n")).alias("nlogn"),
                                         F.sum("children").alias("children"))
    contents = seen.select(*node, F.explode("contents").alias("content")).groupBy(*node, "content").agg(F.count("*").alias("n"))
    of_content = contents.groupBy(*node).agg(F.avg(F.log("n")).alias("repeated"))
    log_m = F.log("seen")
    presentation = F.when(F.col("seen") == 1, F.lit(1.0)).otherwise(1 - F.col("nlogn") / F.col("seen") / log_m)
    content = F.when(F.col("repeated").isNull(), F.lit(0.0)).when(F.col("seen") == 1, F.lit(1.0)).otherwise(1 - F.col("repeated") / log_m)
    share = F.pow(F.lit(GAMMA), F.col("children") / F.col("seen"))
    return (of_style.join(of_content, node, "left").withColumn("presentation", presentation).withColumn("content", content)
            .withColumn("importance", (1 - share) * F.col("presentation") + share * F.col("content"))
            .select(*node, "seen", "presentation", "content", "importance"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", threshold: float = THRESHOLD, min_seen: int = MIN_SEEN,
            keep: list[str] | None = None) -> DataFrame:
    """The pages with ``text``, their main text, and ``n_chars``, its length in characters.

    Runs jobs to build the style trees.  Branches seen fewer than ``min_seen`` times are kept.
    ``keep`` names the columns to carry along (all by default); an input column named like
    the new ones gives way.
    """
    kept = pages.columns if keep is None else keep
    site = F.lower(F.coalesce(F.regexp_extract(F.col(url), "(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    rows = packed(pages, kept, site=site, html=F.col(html))
    low = style_tree(rows, "site", "html").where((F.col("importance") < threshold) & (F.col("seen") >= min_seen))
    templates = stage(low.groupBy("site").agg(F.collect_set("path").alias("template")), "site-templates")
    rows = rows.join(templates, "site", "left").select("_row", "html", "template")
    row_type = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = []
                for source, template in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    tree = parse(source or "")
                    text = text_of(tree, frozenset(template or ()))
                    texts.append(text if text or tree.opened else text_of(tree))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["_row", "text"])

    found = rows.mapInArrow(run, f"_row {row_type}, text string")
    return unpacked(found, "text", F.length("text").cast("long").alias("n_chars"), new=NEW)
