"""Main text of web pages by union-free wrappers and counted template texts.

All pages of a host are cut into tokens (tags, and texts).  Runs that repeat,
like list items, are folded into repeated groups.  Pages of one structure (equal
but for texts) are merged where they are read, a partial aggregate; then a
host's structures are aligned, a few by each task until one wrapper is left:
where tags differ, the tokens of one side become an optional group, where texts
differ they become a text slot.  The result is a regular expression without unions:
tags, fixed texts, slots ``#``, ``( ... )?`` and ``( ... )+``.

The wrapper tells which part of the host's pages holds their own text: the
element under which most of the slots' text stands; fixed texts are the host's
template.  A page's own ``article`` or ``main`` element comes before it.  The
main text is the text in that element without menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and comments, by element or
by the words of its class, id and role.  Such words of elements *around* an
article or the wrapper's element don't count where nothing speaks against it:
an article in a ``div`` of class ``layout with-sidebar`` is the main text unless
the page has an article without such words around it, or more text outside.

Template texts inside that element go too.  A text that differs on one page is
a slot, and a page must still give its texts where it strays from the others, so
pages are matched by path instead of token by token: over *all* pages of a host
it is counted how often a block of text stands at its path (the open elements
with their classes), and a block is a fixed text of the template if it does so
on at least ``PAGES`` pages and on ``SHARE`` of those with a block at this path.
What differs (the slots, optional and repeated groups) is the page's own.  Pages
whose longest other block is the same count once, so near copies of a page don't
make its text a template; nor does a block that a page holds twice at one path,
like a table's cells.

Blocks are the texts between block-level tags; character references are
decoded, white space becomes one space, blocks are joined by a line feed.

Cases: null and empty pages give an empty text, and so do pages without text;
pages of a host without a wrapper, or whose wrapper's element is missing, are
judged by their own tags; unclosed tags end with their parent; a ``<`` that no
letter, ``/``, ``!`` or ``?`` follows is text; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import cut, small, table

#: structures of a host that one task aligns (about), longest repeated run in tokens
GROUP, PERIOD = 8, 16
#: tokens of structures that a reading task holds before it folds and sends them
HELD = 200_000
#: hosts up to which wrappers are broadcast (about 2 KB each)
MAX_BROADCAST = 20_000
#: least pages of a host, and share of its pages with the path, on which a block is a template's
PAGES, SHARE = 4, 0.5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</[^>]*(?:>|\Z)|<[a-z][^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_SKIP = frozenset("head nav header footer aside form button select option iframe svg object dialog menu".split())
_NOT_MAIN = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer
    login menu modal nav navbar navigation newsletter notice notices popup promo promotion related recommended reply replies share sharing sidebar signup
    social sponsor sponsored subscribe subscription toolbar widget complementary contentinfo search""".split())
_REPLIES = frozenset("comment comments disqus reply replies".split())
#: why an element isn't main text: words of its class, id or role; such words of readers' comments; its name
WORDS, REPLIES, NAME = 1, 2, 3
#: elements that end an open element of the same kind when they begin
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@lru_cache(1 << 14)
def _label(name: str, attributes: str) -> tuple[str, int]:
    """The name with the words of class, id and role, and why it isn't main text (0: it may be)."""
    marks = [" ".join(filter(None, g[1:])) for g in _MARK.findall(attributes)]
    words = set(re.split(r"[^a-z0-9]+", " ".join(marks).lower()))
    why = 0
    if name in _SKIP:
        why = NAME
    elif name == "article":
        why = REPLIES if words & {"comment", "reply"} else 0
    elif name not in ("html", "body", "main") and words & _NOT_MAIN:
        why = REPLIES if words & _REPLIES else WORDS
    return name + "".join("." + x for x in sorted(words) if x and not x.isdigit()), why


def parse(page: str) -> list[tuple[str, str, tuple]]:
    """Tokens (kind, value, path): kind '<' or '>' for tags, value their name
    with class; '#' for texts.  path: the open elements, as (label, why it
    isn't main text)."""
    out: list = []
    stack: list[tuple[str, str]] = []
    path: tuple = ()
    end = 0

    def text(s: str) -> None:
        if s and not s.isspace():
            out.append(("#", s, path))
        elif s:
            out.append((" ", "", path))

    def close(n: int) -> None:
        nonlocal path
        while len(stack) > n:
            _, label = stack.pop()
            path = path[:-1]
            out.append((">", label, path))

    for m in _TOKEN.finditer(page):
        text(page[end:m.start()])
        end = m.end()
        name = (m.group(3) or "").lower()
        if not name:
            continue
        if m.group(2):
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                close(at)
            continue
        if name not in _INLINE:
            # a paragraph ends where a block begins, an item where the next begins
            ends = _ENDS.get(name, set()) | {"p"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] not in _INLINE and stack[i][0] != "p":
                    break
        label, why = _label(name, m.group(4) or "")
        out.append(("<", label, path))
        if name in _VOID or (m.group(4) or "").endswith("/"):
            continue
        stack.append((name, label))
        path = (*path, (label, why))
    text(page[end:])
    close(0)
    return out


def where(path: tuple) -> str:
    return ">".join(label for label, _ in path)


# wrapper nodes: [key, text or None, children or None, path, chars, marked]; key of a text is '#', of a group '+' or '?' with its children's
# keys; chars and marked: of texts outside elements that are out, and of those that are out for no other reason than WORDS too
def _leaf(key: str, text: str | None = None, path: str = "", chars: int = 0, marked: int = 0) -> list:
    return [key, text, None, path, chars, marked]


def _group(sign: str, children: list) -> list:
    return [sign + "(" + " ".join(c[0] for c in children) + ")", None, children, "", 0, 0]


def _same(a: list, b: list) -> list:
    """Two nodes of one key as one: differing texts become a slot."""
    if a[2] is not None:
        return [a[0], None, [_same(x, y) for x, y in zip(a[2], b[2])], "", 0, 0]
    return [a[0], a[1] if a[1] == b[1] else None, None, min(a[3], b[3]), a[4] + b[4], a[5] + b[5]]


def fold(nodes: list) -> list:
    """Runs that repeat, as repeated groups; inner and short ones first."""
    changed = True
    while changed:
        changed = False
        for size in range(1, PERIOD + 1):
            keys, out, i = [x[0] for x in nodes], [], 0
            while i < len(nodes):
                n = 1
                if size == 1 and keys[i][0] == "+" or keys[i][0] == "<" and keys[i + size - 1:i + size] == [">" + keys[i][1:]]:
                    while keys[i + n * size:i + (n + 1) * size] == keys[i:i + size]:
                        n += 1
                if n > 1:
                    body = nodes[i:i + size]
                    for k in range(1, n):
                        body = [_same(x, y) for x, y in zip(body, nodes[i + k * size:i + (k + 1) * size])]
                    out.append(body[0] if size == 1 and body[0][0][0] == "+" else _group("+", body))
                    changed = True
                else:
                    out.append(nodes[i])
                i += n * size if n > 1 else 1
            nodes = out
    return nodes


def align(a: list, b: list) -> list:
    """The wrapper of two: common nodes in order, the rest optional; a
    repeated group also matches a single copy of its body."""
    out: list = []
    ka, kb = [x[0] for x in a], [x[0] for x in b]

    def optional(part: list) -> list:
        return [part[0]] if len(part) == 1 and part[0][0][0] == "?" else [_group("?", part)] if part else []

    def repeated(one: list, body: list) -> list | None:
        if len(one) == 1 and one[0][0][0] == "+" and [c[0] for c in one[0][2]] == [c[0] for c in body]:
            return [_group("+", [_same(x, y) for x, y in zip(one[0][2], body)])]
        return None

    def within(one: list, part: list) -> list | None:
        if len(one) == 1 and one[0][0][0] == "?" and part:
            return [_group("?", align(one[0][2], part))]
        return None

    for kind, i, j, k, m in SequenceMatcher(None, ka, kb, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_same(x, y) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += repeated(a[i:j], b[k:m]) or repeated(b[k:m], a[i:j]) or within(a[i:j], b[k:m]) or optional(a[i:j]) + optional(b[k:m])
    return out


def leaves_of(page: str, most: int = 0) -> list:
    """Nodes of a page, not folded; chars counts texts in elements that are out
    for no other reason than ``most``."""
    out = []
    for kind, value, path in parse(page):
        if kind == "#":
            why = max((why for _, why in path), default=0)
            out.append(_leaf("#", " ".join(value.split()), where(path), len(value) if why <= most else 0, len(value) if why <= WORDS else 0))
        elif kind != " ":
            out.append(_leaf(kind + value))
    return out


def nodes_of(page: str, most: int = 0) -> list:
    """Folded nodes of a page."""
    return fold(leaves_of(page, most))


def infer(pages: list[str], most: int = 0) -> list:
    """The wrapper of some pages, aligned one after the other."""
    wrapper = nodes_of(pages[0], most)
    for page in pages[1:]:
        wrapper = fold(align(wrapper, nodes_of(page, most)))
    return wrapper


def expression(nodes: list) -> str:
    """The wrapper as a regular expression."""
    parts = []
    for key, text, children, *_ in nodes:
        if children is not None:
            parts.append(f"({expression(children)}){key[0]}")
        elif key == "#":
            parts.append("#" if text is None else text)
        else:
            parts.append(f"<{'/' * (key[0] == '>')}{key[1:]}>")
    return "".join(parts)


def main_element(nodes: list, n_pages: int, marked: bool = False) -> str | None:
    """Path of the element that holds the pages' own text, if any text counts."""
    slots: dict[str, int] = defaultdict(int)

    def gather(part: list) -> None:
        for key, text, children, path, *chars in part:
            if children is not None:
                gather(children)
            elif key == "#" and (text is None or n_pages == 1):
                steps = path.split(">")
                for i in range(1, len(steps) + 1):
                    slots[">".join(steps[:i])] += chars[marked]

    gather(nodes)
    total = max(slots.values(), default=0)
    deep = [p for p, n in slots.items() if n and n >= 0.7 * total and p.split(">")[-1].split(".")[0] not in _INLINE | {"p", "h1", "h2", "h3", "li", "td"}]
    return max(deep, key=lambda p: (p.count(">"), p), default=None)


def _parts(path: tuple, steps: tuple) -> set[str]:
    """The parts of a page that a text with this path belongs to."""
    worst = lambda part: max((why for _, why in part), default=0)
    out = set() if worst(path) else {"any"}
    at = next((i for i, (label, why) in enumerate(path) if not why and label.split(".")[0] in ("article", "main")), None)
    if at is not None and not worst(path[at:]) and worst(path[:at]) < NAME:
        out.add(("article", "marked article", "comments")[worst(path[:at])])
    n = len(steps)
    if n and tuple(label for label, _ in path[:n]) == steps and not worst(path[n:]) and worst(path[:n]) < NAME:
        out.add("root")
    return out


def main_blocks(page: str | None, root: str | None) -> list[tuple[str, str]]:
    """(path, text) of the blocks of a page's main element; ``root``: path of
    the host's main element, if known."""
    if not page:
        return []
    tokens = parse(page)
    steps, parts, size = tuple(root.split(">")) if root else (), {}, defaultdict(int)
    for kind, value, path in tokens:
        if kind == "#":
            if path not in parts:
                parts[path] = _parts(path, steps)
            for part in parts[path]:
                size[part] += len(value)
    order = ["article", "marked article", "root", "any", "comments"]
    if size["marked article"] < size["any"]:
        order.remove("marked article")
    chosen = next((part for part in order if size[part]), None)
    blocks, current, at = [], [], ()

    def end() -> None:
        nonlocal current, at
        text = " ".join(html.unescape("".join(current)).split())
        if text:
            while at and at[-1][0].split(".")[0] in _INLINE:
                at = at[:-1]
            blocks.append((where(at), text))
        current, at = [], ()

    for kind, value, path in tokens:
        if kind == "#":
            if chosen in parts[path]:
                current.append(value)
                at = at or path
        elif kind == " ":
            current.append(" ")
        elif value.split(".")[0] not in _INLINE:
            end()
        elif value == "br":
            current.append(" ")
    end()
    return blocks


def _key(path: str, text: str = "") -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def extract(page: str | None, root: str | None, fixed: frozenset = frozenset()) -> str:
    """Main text of a page without the blocks whose keys are in ``fixed``."""
    return "\n".join(text for path, text in main_blocks(page, root) if not fixed or _key(path, text) not in fixed)


def counted(page: str | None, root: str | None) -> set[tuple[int, int, int]]:
    """(key, of, body): each block that the page holds once at its path, with
    its path's key, and each path (of: its own key).  body: the page's longest
    block but this."""
    blocks = main_blocks(page, root)
    times = Counter(blocks)
    long = [_key("", text) for _, text in sorted(set(blocks), key=lambda x: (-len(x[1]), x[1]))[:2]] + [0, 0]
    out = set()
    for (path, text), n in times.items():
        own, of = _key("", text), _key(path)
        body = long[1] if own == long[0] else long[0]
        out.add((of, of, body))
        if n == 1:
            out.add((_key(path, text), of, body))
    return out


def template_texts(pages: DataFrame) -> DataFrame:
    """(host, fixed): keys of each host's template blocks, from ``pages`` (host, html, root)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                hosts, pages, roots = (c.to_pylist() for c in batch.slice(s, 512).columns)
                rows = list({(h, *x) for h, p, r in zip(hosts, pages, roots) for x in counted(p, r)})
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(4)], names=["h", "key", "of", "body"])

    rows = pages.select(F.xxhash64("host").alias("h"), "html", "root").mapInArrow(run, "h long, key long, of long, body long")
    # one row per page that counts, then its number; both are partial aggregates
    n = cut(rows.distinct().groupBy("h", "key", "of").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES))
    paths = n.where("key = of").select("h", "of", F.col("n").alias("all"))
    fixed = n.where("key != of").join(paths, ["h", "of"]).where(F.col("n") >= SHARE * F.col("all"))
    return fixed.groupBy("h").agg(F.collect_set("key").alias("fixed"))


#: structures: s hash of the keys, n pages, lo and hi the least and greatest hash of a page, nodes as JSON
STRUCTURE = "host string, s long, n long, lo long, hi long, nodes string"


def _merged(rows: pd.DataFrame) -> list:
    """s, n, lo and hi of several structures as one."""
    return [int(rows["s"].min()), int(rows["n"].sum()), int(rows["lo"].min()), int(rows["hi"].max())]


def structures(pages: DataFrame) -> DataFrame:
    """The structures of all pages of ``pages`` (host, html), each once per
    host, with their texts merged."""
    def add(held: dict, key: tuple, n: int, lo: int, hi: int, nodes: list) -> None:
        old = held.get(key)
        held[key] = (n, lo, hi, nodes) if old is None else (old[0] + n, min(old[1], lo), max(old[2], hi), [_same(x, y) for x, y in zip(old[3], nodes)])

    def folded(raw: dict) -> pa.RecordBatch:
        held: dict = {}
        for (host, _), (n, lo, hi, nodes) in raw.items():
            nodes = fold(nodes)
            add(held, (host, tuple(x[0] for x in nodes)), n, lo, hi, nodes)
        rows = [(host, _key("", "\0".join(keys)), n, lo, hi, json.dumps(nodes)) for (host, keys), (n, lo, hi, nodes) in held.items()]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds)], names=["host", "s", "n", "lo", "hi", "nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: dict = {}
        size = 0
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                for host, h, page in zip(*(c.to_pylist() for c in batch.slice(s, 512).columns)):
                    nodes = leaves_of(page)
                    key = (host, tuple(x[0] for x in nodes))
                    size += 0 if key in raw else len(nodes) + 1
                    add(raw, key, 1, h, h, nodes)
                    if size > HELD:
                        yield folded(raw)
                        raw, size = {}, 0
        if raw:
            yield folded(raw)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        nodes = json.loads(rows["nodes"].iloc[0])
        for other in rows["nodes"].iloc[1:]:
            nodes = [_same(x, y) for x, y in zip(nodes, json.loads(other))]
        return pd.DataFrame([[key[0], *_merged(rows), json.dumps(nodes)]], columns=["host", "s", "n", "lo", "hi", "nodes"])

    read = pages.where("html is not null").select("host", F.xxhash64("html").alias("h"), "html").mapInArrow(run, STRUCTURE)
    return read.groupBy("host", "s").applyInPandas(merge, STRUCTURE)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, root, expression) per host of ``pages`` (host, html), from all its
    pages: rounds of aligning GROUP structures, the ones of most pages first,
    until each host has one."""
    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = rows.sort_values(["n", "s"], ascending=[False, True])["nodes"].tolist()
        nodes = json.loads(parts[0])
        for other in parts[1:]:
            nodes = fold(align(nodes, json.loads(other)))
        return pd.DataFrame([[key[0], *_merged(rows), json.dumps(nodes)]], columns=["host", "s", "n", "lo", "hi", "nodes"])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for host, lo, hi, nodes in zip(rows["host"], rows["lo"], rows["hi"], map(json.loads, rows["nodes"])):
                n = 1 if lo == hi else 2     # copies of one page show no template
                out.append((host, main_element(nodes, n) or main_element(nodes, n, True), expression(nodes)))
            yield pd.DataFrame(out, columns=["host", "root", "expression"])

    parts, turn = cut(structures(pages)), 0
    while (most := parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        turn += 1
        deal = F.pmod(F.xxhash64("s", F.lit(turn)), F.lit(-(-most // GROUP)))
        parts = cut(parts.groupBy("host", deal.alias("part")).applyInPandas(join, STRUCTURE))
    return parts.mapInPandas(finish, "host string, root string, expression string")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract("url", "://([^/?#]*)", 1)), F.lit(""))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    roots = cut(wrappers(pages.select("host", "html")).select("host", "root"))
    joined = pages.join(small(roots, MAX_BROADCAST), "host", "left")
    fixed = cut(template_texts(joined.select("host", "html", "root")))
    joined = joined.withColumn("h", F.xxhash64("host")).join(small(fixed, MAX_BROADCAST), "h", "left").select("page_id", "url", "html", "root", "h", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, frozenset] = {}
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                hosts, sets, texts = part.column(4).to_pylist(), part.column(5), []
                for i, (page, root, h) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), hosts)):
                    if h not in known:
                        if len(known) >= MAX_BROADCAST:
                            known.clear()
                        known[h] = frozenset(sets[i].as_py() or ())
                    texts.append(extract(page, root, known[h]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)["page_id"]
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
