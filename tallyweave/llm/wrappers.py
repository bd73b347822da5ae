"""Main text of web pages by inferred wrappers: union-free regular expressions of each host's pages.

A page is a tree of elements and texts; inline markup is part of its text. Equal
neighbours of a page fold into a repeated group. Pages of one host are aligned
one after another: equal elements meet, texts that differ become text slots,
elements that one page lacks become optional, and neighbours of the same kind
become one repeated group. The result is the host's wrapper. Tasks merge what
they read, then partial wrappers meet by host and slice, then by host, so a host
with a third of all pages is never gathered in one place.

From the wrapper follows where the article stands: the innermost element that
holds nearly all of the changing text, an article or main element first, without
elements that are boilerplate by their tag or name. What is left beside it is
at most a tenth, over all levels; where the text is spread, their common container is
the article, and several article elements of one place count together. Texts that never change
although many pages differ in most of their text are template and do not count
in that search; inside the article they stay. Equal pages count once. Each page
is then read through its host's wrapper, or through its own where that finds
less than half of the page's text outside boilerplate and template.

Elements nested deeper than ``DEPTH`` levels keep their text in its order but
are no part of the wrapper.

Null pages give empty texts, as do pages without text; pages without a host form
one group. Broken markup is closed as browsers do. Texts keep every word of the
article. Repeated rows give repeated results; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import stage

# Elements of HTML by their role.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video head title".split())
BOILERPLATE = frozenset("nav footer aside form button select textarea input option menu dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers that the search for the article may enter.
CONTAINERS = frozenset("html body div section main article center table tbody tr td content".split())
#: An opening tag of the first kind ends an open element of the second.
_ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOPS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
#: Parts of class names, ids and roles that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets footer masthead topbar comment comments respond reply replies discussion disqus "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations pagination pager toolbar search searchform hidden skip copyright contentinfo complementary".split()
)
ARTICLE_MARKS = frozenset("articlebody".split())
#: Class names that make an article or main element boilerplate; other marks there only describe the page.
NO_ARTICLE = frozenset("ad advert comment comments reply promo related sponsored".split())

#: Different pages a wrapper must rest on before texts that never change count as template; share of all text that the article must hold.
LEAST_PAGES, LEAST_SHARE = 8, 0.9
#: Share that article elements must hold where only loose paragraphs stand beside them; share of a page that its host's path must read.
LOOSE_SHARE, READ_SHARE = 2 / 3, 0.5
#: Elements nested deeper than this are no nodes of their own; their text stands in the last one that is.
DEPTH = 200
#: Hosts that a task merges before it passes them on; slices of one host.
HOSTS_HELD, SLICES = 5_000, 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|math|iframe|object|textarea|title)\b[^>]*(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Names such as with-sidebar tell what stands elsewhere.
_ABOUT = re.compile(r"\b(?:has|with|without|no)[-_]?[a-zA-Z]+")

Node = list  # [label, is_boilerplate, children]; a child is a Node or a text


@lru_cache(maxsize=20_000)
def _label(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Label of an element, whether it is boilerplate, and whether its name says article."""
    found = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(attributes)}
    named = re.sub(r"(?<=[-_])\d+|\d{2,}", "#", " ".join(filter(None, (found.get("class"), found.get("id")))))
    parts = {p.lower() for key in ("class", "id", "role") for p in _PARTS.findall(_ABOUT.sub("", found.get(key) or ""))}
    if tag in ("article", "main"):
        parts = {p.lower() for p in (found.get("class") or "").split()} & NO_ARTICLE
    shut = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in (found.get("style") or "").replace(" ", "")
    good = (found.get("itemprop") or "").lower() in ARTICLE_MARKS
    return f"{tag}.{named}" if named else tag, tag in BOILERPLATE or shut or (not good and tag not in ("html", "body") and bool(parts & MARKS)), good


def parse(page: str) -> Node:
    """Tree of a page's block elements; inline markup only leaves its text, boilerplate inline elements are nodes."""
    root: Node = ["", False, []]
    stack: list[tuple[str, Node]] = [("", root)]
    at = 0

    def text(begin: int, end: int) -> None:
        if end > begin:
            stack[-1][1][2].append(html.unescape(page[begin:end]))

    def close(tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                del stack[depth:]
                if depth >= DEPTH:
                    stack[-1][1][2].append(" ")
                return
            if stack[depth][0] in stops:
                return

    for match in _TOKEN.finditer(page):
        text(at, match.start())
        at = match.end()
        tag = (match.group(3) or "").lower()
        if not tag:
            continue
        if match.group(2):
            if tag == "br":
                stack[-1][1][2].append(" ")
            elif tag not in INLINE:
                close((tag,), ())
            elif any(s[0] == tag for s in stack[-3:]):  # an inline element that is a node
                close((tag,), ())
            continue
        if tag in VOID:
            if tag not in INLINE:
                stack[-1][1][2].append(" ")
            continue
        label, boiler, _ = _label(tag, match.group(4))
        if tag in INLINE and not boiler:
            continue
        if tag == "body":
            close(("head",), ())
        if tag in _ENDS_PARAGRAPH:
            close(("p",), ("table", "td", "li", "article", "section", "div"))
        elif tag in _ENDS_SAME:
            close(_ENDS_SAME[tag], _STOPS[tag])
        if tag == "header":
            boiler = boiler or not any(s[0] in ("article", "main") for s in stack)
        node: Node = [label, boiler or tag in SKIPPED, []]
        if len(stack) > DEPTH and not node[1]:
            node = stack[-1][1]
            node[2].append(" ")
        else:
            stack[-1][1][2].append(node)
        if not match.group(0).endswith("/>"):
            stack.append((tag, node))
    text(at, len(page))
    return root


# A wrapper element is [label, repeated, optional, boilerplate, children]; a text is [text or None, letters].


def fold(node: Node) -> list:
    """Wrapper of one page: children of the same kind that stand together become one repeated group."""
    children: list = []
    for child in node[2]:
        if isinstance(child, str):
            plain = " ".join(child.split())
            if plain:
                add = [[plain, len(plain)]]
                children = align(children, add) if children and len(children[-1]) == 2 else children + add
        elif child[1]:
            if not children or children[-1][0] != child[0] or len(children[-1]) == 2:
                children.append([child[0], False, False, True, []])
        else:
            new = fold(child)
            if children and len(children[-1]) == 5 and children[-1][0] == new[0]:
                children[-1] = _join(children[-1], new, repeated=True)
            else:
                children.append(new)
    return [node[0], False, False, node[1], children]


def _join(a: list, b: list, repeated: bool = False) -> list:
    """Two elements or two texts in one."""
    if len(a) == 2:
        return [a[0] if a[0] == b[0] else None, a[1] + b[1]]
    return [a[0], repeated or a[1] or b[1], a[2] or b[2], a[3] and b[3], align(a[4], b[4])]


def align(a: list, b: list) -> list:
    """Alignment of two sequences: the longest common one of their labels meets, what one lacks is optional.

    Optional elements next to one of the same label join it as a repeated group.
    """
    name = lambda x: x[0] if len(x) == 5 else None
    left, right = [name(x) for x in a], [name(x) for x in b]
    if left == right:
        return [_join(x, y) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i] == right[j] else max(best[i + 1][j], best[i][j + 1])
    out: list = []

    def add(x: list) -> None:
        if out and name(out[-1]) == name(x):
            joined = _join(out[-1], x, repeated=True)
            if len(joined) == 5:
                joined[2] = out[-1][2] and x[2]
            out[-1] = joined
        else:
            out.append(x)

    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and left[i] == right[j]:
            add(_join(a[i], b[j]))
            i, j = i + 1, j + 1
        else:
            first = j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1])
            x = a[i] if first else b[j]
            i, j = (i + 1, j) if first else (i, j + 1)
            add([None, x[1]] if len(x) == 2 else [x[0], x[1], True, x[3], x[4]])
    return out


def _weight(node: list, many: bool) -> int:
    """Letters of changing text below an element, boilerplate left out."""
    if len(node) == 2:
        return 0 if many and node[0] is not None else node[1]
    return 0 if node[3] else sum(_weight(c, many) for c in node[4])


def _tag(label: str) -> str:
    return label.split(".", 1)[0]


def _differ(wrapper: list, pages: int) -> bool:
    """Whether so many different pages differ in most of their text that what never changes is template."""
    return pages >= LEAST_PAGES and 2 * _weight(wrapper, True) > _weight(wrapper, False)


def article_path(wrapper: list, pages: int) -> list[str]:
    """Labels from the root to the element that holds the article; ``pages`` counts different ones."""
    many = _differ(wrapper, pages)
    total = _weight(wrapper, many)
    for wanted in ("article", "main"):
        found = _semantic(wrapper, wanted, [], many)
        if found and found[0] >= LEAST_SHARE * total:
            return found[1]
        if found and wanted == "article" and found[0] >= LOOSE_SHARE * total and found[0] + _loose(wrapper, found[1], many) >= LEAST_SHARE * total:
            return found[1]
    path, node = [], wrapper
    while True:
        inner = [c for c in node[4] if len(c) == 5 and not c[3] and not c[1] and _tag(c[0]) in CONTAINERS]
        best = max(inner, key=lambda c: _weight(c, many), default=None)
        # Of all text, so that what is left beside the path does not add up from level to level.
        if best is None or _weight(best, many) < LEAST_SHARE * max(1, total):
            return path
        path.append(best[0])
        node = best


def _semantic(node: list, tag: str, path: list[str], many: bool) -> tuple[int, list[str]] | None:
    """The heaviest place of elements of a tag, all of one parent counting together; the path ends with the tag."""
    found = []
    own = [c for c in node[4] if len(c) == 5 and not c[3] and _tag(c[0]) == tag]
    if own:
        found.append((sum(_weight(c, many) for c in own), [*path, tag]))
    for c in node[4]:
        if len(c) == 5 and not c[3] and not c[1] and _tag(c[0]) != tag and (inner := _semantic(c, tag, [*path, c[0]], many)):
            found.append(inner)
    return max(found, default=None)


def _loose(node: list, path: list[str], many: bool) -> int:
    """Letters beside a path that stand in no container."""
    total = 0
    for label in path:
        total += sum(_weight(c, many) for c in node[4] if len(c) == 2 or _tag(c[0]) not in CONTAINERS)
        node = next(c for c in node[4] if len(c) == 5 and label in (c[0], _tag(c[0])) and not c[3])
    return total


def template_texts(wrapper: list, path: list[str], pages: int) -> list[str]:
    """Texts inside the element at ``path`` that are the same on all of many different pages."""
    if not _differ(wrapper, pages):
        return []
    node = wrapper
    for label in path:
        node = next(c for c in node[4] if len(c) == 5 and label in (c[0], _tag(c[0])))
    out: list[str] = []

    def walk(x: list) -> None:
        for c in x[4]:
            if len(c) == 2:
                if c[0] is not None:
                    out.append(c[0])
            elif not c[1] and not c[2] and not c[3]:
                walk(c)

    walk(node)
    return out


def _blocks(root: Node, path: list[str]) -> list[str]:
    """Texts of the element at ``path``, or of all article or main elements there; none where the page lacks it."""
    nodes = [root]
    for label in path:
        # Articles of one place are read whole; above them the path is unique.
        nodes = [c for node in nodes[:1] for c in node[2] if not isinstance(c, str) and not c[1] and (c[0] == label or (label in ("article", "main") and _tag(c[0]) == label))]
    if path and path[-1] not in ("article", "main"):
        nodes = nodes[:1]
    parts: list[str] = []

    def walk(x: Node) -> None:
        own: list[str] = []

        def flush() -> None:
            block = " ".join("".join(own).split())
            own.clear()
            if block:
                parts.append(block)

        for c in x[2]:
            if isinstance(c, str):
                own.append(c)
            elif c[1]:
                if _tag(c[0]) not in INLINE:
                    flush()
            else:
                flush()
                walk(c)
        flush()

    for node in nodes:
        walk(node)
    return parts


def read(page: str, path: list[str]) -> str:
    """Text of the element at ``path``; empty where the page lacks it."""
    return " ".join(_blocks(parse(page), path))


def extract(page: str, rule: tuple[list[str], frozenset[str]] | None) -> str:
    """Main text of one page through its host's rule (article path, template texts), or through its own wrapper."""
    root = parse(page)
    if rule is not None and (found := _blocks(root, rule[0])):
        held = sum(map(len, found))
        # Template texts only tell how much there is to read.
        if held >= READ_SHARE * max(held, sum(len(b) for b in _blocks(root, []) if b not in rule[1])):
            return " ".join(found)
    return " ".join(_blocks(root, article_path(fold(root), 1)))


def host(url: str | Column) -> Column:
    """Host name in small letters, empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _mark(wrapper: str) -> str:
    """Digest of one page's wrapper: pages that say the same have the same."""
    return hashlib.blake2b(wrapper.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def _merge(wrappers: list[tuple[str, list[str]]]) -> tuple[str, list[str]]:
    """One wrapper of several; in a fixed order, so that a repeated task gives the same."""
    ordered = sorted(wrappers)
    out = json.loads(ordered[0][0])
    for other, _ in ordered[1:]:
        out = _join(out, json.loads(other))
    return json.dumps(out, ensure_ascii=False), sorted({m for _, marks in ordered for m in marks})[:LEAST_PAGES]


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) and the marks of its different pages, of ``LEAST_PAGES`` at most."""
    kinds = (pa.string(), pa.string(), pa.list_(pa.string()))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            rows = [(h, json.dumps(w, ensure_ascii=False), sorted(m)) for h, (w, m) in held.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["host", "wrapper", "pages"])

        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = fold(parse(page or ""))
                old = held.setdefault(name, [new, set()])
                if len(old[1]) < LEAST_PAGES:
                    old[1].add(_mark(json.dumps(new, ensure_ascii=False)))
                if old[0] is not new:
                    old[0] = _join(old[0], new)
            if len(held) > HOSTS_HELD:
                yield out()
                held = {}
        if held:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows = None, []
        done: list[tuple[str, str, list[str]]] = []
        for batch in batches:
            for key, wrapper, seen in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if key != name and rows:
                    done.append((name, *_merge(rows)))
                    rows = []
                name = key
                rows.append((wrapper, seen))
        if rows:
            done.append((name, *_merge(rows)))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names=["host", "wrapper", "pages"])

    schema = "host string, wrapper string, pages array<string>"
    parts = pages.select(host("url").alias("host"), "html").mapInArrow(first, schema)
    parts = parts.withColumn("slice", F.pmod(F.xxhash64("wrapper"), F.lit(SLICES)))
    parts = parts.repartition("host", "slice").sortWithinPartitions("host", "slice").select("host", "wrapper", "pages").mapInArrow(merge, schema)
    return parts.repartition("host").sortWithinPartitions("host").mapInArrow(merge, schema)


def rules(found: DataFrame) -> DataFrame:
    """host and its rule: path of the article and texts of the whole page that are template (JSON)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for wrapper, seen in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tree = json.loads(wrapper)
                out.append(json.dumps([article_path(tree, len(seen)), template_texts(tree, [], len(seen))], ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["host", "rule"])

    return found.select("host", "wrapper", "pages").mapInArrow(run, "host string, rule string")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    learned = stage(rules(wrappers(pages)), "rules")
    frame = pages.select("page_id", "url", "html").withColumn("host", host("url")).join(learned, "host", "left").select("page_id", "url", "html", "rule")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                texts = []
                for page, rule in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if rule is not None and rule not in known:
                        if len(known) > 10_000:
                            known.clear()
                        path, template = json.loads(rule)
                        known[rule] = path, frozenset(template)
                    texts.append(extract(page or "", known.get(rule)))
                arrays = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    return frame.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
