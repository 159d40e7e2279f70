"""Self-join of documents on the Jaccard similarity of their word n-grams by
signature trees.

A document's set is its distinct ``k``-word shingles (lower-cased A-Z, words
between white space; with fewer words, the whole sequence is one shingle).
Two documents link when ``100 * |A and B| >= pct * |A or B|``; the result has
one row per document with the smallest ``doc_id`` reachable by links.

How the work is spread
----------------------
1.  Documents with equal sets share a *node* (64-bit hash of the sorted set),
    so copies cost nothing after the first pass.
2.  *Routing* brings nodes that may link into one cluster.  The hash space is
    cut into blocks, their number fixed per size class; a linked pair differs
    in at most ``h`` shingles, so of ``h + 1`` non-empty blocks of either
    document at least one is equal in both.  Each document sends the hashes of
    its first ``h + 1`` non-empty blocks and nothing else.  Shingles that are
    frequent (counted over all documents) are left out of the blocks; documents
    that keep too few blocks also send the blocks of their full set, so no pair
    is lost.  Any order of the blocks will do that their content alone gives: the
    first equal block has at most ``h`` before it in either document.  So *hot*
    blocks, which several documents of a share of the corpus have, come last, and
    before them those of one shingle.  A line that stands in many documents would
    else tie ever more of them together as the corpus grows, and the pairs of
    step 4 grow with their square.  Equal keys within an Arrow batch are merged
    before the shuffle, and its sorted keys cross as differences, with 40 bits of
    each node: what agrees by chance only makes a cluster larger.
3.  Nodes connected by keys form clusters.  A cluster is cut into cells of
    bounded weight.  Each cell builds a *signature tree*: leaves are documents,
    inner nodes hold the OR of their token bitmaps and the range of set sizes.
    A dual traversal visits pairs of tree nodes and drops those whose sizes or
    largest possible overlap rule a link out; surviving document pairs are
    verified on the full sets, unless already connected.
4.  In clusters of several cells, two members of each cell's main component
    meet in cells of their own, level by level; then every document outside the
    cluster's main component meets all its documents.  Any pair still
    unconnected has such a document, so the result is exact.

Cases: null and empty texts have no shingles, link with nothing and are their
own component; repeated rows give repeated rows; a null ``doc_id`` never is a
component id unless its component has no other.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import U64, blocks, cut, mix, small, span_hashes, table, utf8, words

#: documents of a cell; longer documents count as one for each SHINGLES_PER_DOC
CELL, SHINGLES_PER_DOC = 64, 4096
#: documents on either side of a cell in which strays meet their cluster
STRAY_CELL = 512
#: a shingle is frequent if batches that hold it LOCAL times or more see it GLOBAL times together
LOCAL, GLOBAL = 8, 64
#: frequent shingles kept at most; a shorter list costs time, never results
MAX_FREQUENT = 200_000
#: a block is hot if several different documents of one in HOT_SHARE have it
HOT_SHARE = 16
#: hot blocks kept at most; a shorter list costs time, never results
MAX_HOT = 1_000_000
#: bytes of a node's hash that cross with its keys
SHORT_BYTES = 5
#: shingles of all documents for each range of keys that meets at once
RANGE = 1 << 21
#: rows up to which a list of ids is broadcast (16 bytes each)
MAX_BROADCAST = 4_000_000


def shingle_sets(off: np.ndarray, data: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    mult = [U64(pow(0xD1342543DE82EF95, j + 1, 1 << 64)) for j in range(k)]
    for i, j in blocks(off):
        o = off[i:j + 1]
        s, e, counts = words(data, o)
        h = span_hashes(data[o[0]:o[-1]], s, e)
        with np.errstate(over="ignore"):
            g = np.zeros(max(0, len(h) - k + 1), np.uint64)
            for m in range(k):
                g += h[m:len(h) - k + 1 + m] * mult[m]
            g = mix(g)
            at = 0
            for n in counts.tolist():
                if n >= k:
                    yield np.unique(g[at:at + n - k + 1])
                elif n:
                    yield mix(np.array([(h[at:at + n] * np.array(mult[:n])).sum() + U64(n)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
                at += n


def node_of(u: np.ndarray) -> int:
    """Signed 64-bit hash of a sorted set."""
    with np.errstate(over="ignore"):
        x = (u * (np.arange(len(u), dtype=np.uint64) * U64(2) + U64(1))).sum(dtype=np.uint64)
        return int(mix(np.array([x + U64(len(u))], np.uint64)).view(np.int64)[0])


def size_classes(pct: int, upto: int) -> list[int]:
    """Lower bounds of the size classes; the sizes of a linked pair fall in one
    class or in two neighbours."""
    out = [1]
    while out[-1] <= upto:
        x = out[-1]
        for _ in range(2):
            x = x * 100 // pct + 1
        out.append(x)
    return out


#: hot blocks, sorted by key: their keys and how many documents of the share have each
NO_HOT = np.zeros(0, np.uint64), np.zeros(0, np.int64)


def block_keys(u: np.ndarray, size: int, cls: int, top: int, pct: int, salt: int,
               hot: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Keys of the first h + 1 non-empty blocks of ``u`` in one class, and None.
    With fewer of them, the keys of all, and those of the empty blocks.  Blocks
    go by how ``hot`` they are, then those of several shingles go first; None
    asks for all non-empty blocks.

    ``size``: of the document's full set; ``top``: the largest size of the
    class.  A document above ``top`` is the larger of each pair it looks for."""
    h_top = top * (100 - pct) // pct
    h = size * (100 - pct) // pct if size <= top else (size + top) * (100 - pct) // (100 + pct)
    b = h_top + 3 + int(2 * math.sqrt(h_top))
    tag = mix(np.array([cls * 2 + salt + 1], np.uint64))
    with np.errstate(over="ignore"):
        j = ((u >> U64(32)) * U64(b)) >> U64(32)
        first = np.flatnonzero(np.concatenate(([True], j[1:] != j[:-1]))) if len(u) else np.zeros(0, np.int64)
        sums = np.add.reduceat(mix(u ^ tag), first) if len(u) else u
        keys = mix(sums ^ mix(j[first] + tag))
        if hot is None:
            return keys, None
        if len(keys) > h:
            level = np.zeros(len(keys), np.int64)
            if len(hot[0]):
                at = np.minimum(np.searchsorted(hot[0], keys), len(hot[0]) - 1)
                level = np.where(hot[0][at] == keys, hot[1][at], 0)
            return keys[np.lexsort((np.diff(np.append(first, len(u))) == 1, level))[:h + 1]], None
        empty = np.setdiff1d(np.arange(b, dtype=np.uint64), j[first])
        return keys, mix(mix(empty + tag) + U64(77))


def routing_keys(u: np.ndarray, bounds: list[int], pct: int, frequent: np.ndarray,
                 hot: tuple[np.ndarray, np.ndarray] | None = NO_HOT) -> np.ndarray:
    """All keys of a document (see the module's text); with ``hot`` None those
    of all its non-empty blocks."""
    size = len(u)
    cls = int(np.searchsorted(bounds, size, side="right")) - 1
    rare = u
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, u), len(frequent) - 1)
        rare = u[frequent[at] != u]
    out = []
    for c in (cls, cls - 1):
        top = bounds[c + 1] - 1
        if c < 0 or c < cls and size * pct > 100 * top:
            continue
        keys, empty = block_keys(rare, size, c, top, pct, 0, hot)
        out.append(keys)
        if empty is not None:
            keys, empty = block_keys(u, size, c, top, pct, 1, hot)
            out.append(keys)
            if empty is not None:
                out.append(empty)
    return np.concatenate(out)


def pack(keys: np.ndarray, nodes: np.ndarray) -> bytes:
    """Sorted keys as differences of their 48 upper bits, with 5 bytes of each node."""
    top = keys >> U64(16)
    steps = np.diff(top)
    steps = steps.astype("<u4") if not len(steps) or int(steps.max()) < 1 << 32 else steps.astype("<u8")
    return b"".join((bytes([steps.itemsize]), top[:1].astype("<u8").tobytes(), steps.tobytes(),
                     np.ascontiguousarray(nodes.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :SHORT_BYTES]).tobytes()))


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(key, short node) of :func:`pack`."""
    n = (len(raw) - 9 + raw[0]) // (raw[0] + SHORT_BYTES)
    steps = np.frombuffer(raw, f"<u{raw[0]}", n - 1, 9)
    top = np.cumsum(np.concatenate((np.frombuffer(raw, "<u8", 1, 1), steps.astype(np.uint64))), dtype=np.uint64)
    nodes = np.zeros((n, 8), np.uint8)
    nodes[:, :SHORT_BYTES] = np.frombuffer(raw, np.uint8, n * SHORT_BYTES, 9 + (n - 1) * raw[0]).reshape(n, SHORT_BYTES)
    return top, nodes.view("<i8").ravel()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, sorted by ``p``: neighbours among the different nodes of
    each key, the pairs of one ``p`` once."""
    def close() -> Iterator[pa.RecordBatch]:
        key, node = map(np.concatenate, zip(*map(unpack, here)))
        at = np.lexsort((node, key))
        key, node = key[at], node[at]
        at = np.flatnonzero((key[1:] == key[:-1]) & (node[1:] != node[:-1]))
        pairs = np.unique(np.stack([node[at], node[at + 1]]), axis=1)
        if pairs.size:
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    now, here = None, []
    for batch in batches:
        for x, raw in zip(*(col.to_pylist() for col in batch.columns)):
            if x != now and here:
                yield from close()
                here = []
            now = x
            here.append(raw)
    if here:
        yield from close()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): connected components of edges (a, b), root the smallest
    node.  Alternates large-star and small-star steps until nothing changes;
    each step is grouping by minimum and joins, so no component is gathered."""
    e = cut(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n, state = e.count(), None
    # few edges: their smallest neighbours fit every task
    few = F.broadcast if 2 * n <= MAX_BROADCAST else (lambda x: x)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), n)
        big = cut(both.join(few(low), "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).where("u > v").distinct(), n)
        low = cut(big.groupBy("u").agg(F.min("v").alias("m")), n)
        e = cut(big.join(few(low), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).distinct(), n)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    # converged: every node hangs from its root
    return cut(e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), n)


class SignatureTree:
    """Documents sorted so that similar ones are neighbours, under nodes of
    ``FAN`` children.  Per level: OR of the token bitmaps, range of set sizes,
    and the largest number of tokens a document has beyond its bits."""

    FAN = 8

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        n = len(sets)
        low = np.array([int(u[0]) for u in sets], np.uint64)
        sizes = np.array([len(u) for u in sets], np.int64)
        self.order = np.lexsort((sizes, low))
        maps = np.zeros((n, bits // 64), np.uint64)
        for r, i in enumerate(self.order):
            bit = sets[i] & U64(bits - 1)
            np.bitwise_or.at(maps[r], (bit >> U64(6)).astype(np.int64), U64(1) << (bit & U64(63)))
        sizes = sizes[self.order]
        spare = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, spare)]
        while len(self.levels[-1][1]) > 1:
            maps, lo, hi, spare = self.levels[-1]
            at = np.arange(0, len(lo), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(lo, at),
                                np.maximum.reduceat(hi, at), np.maximum.reduceat(spare, at)))


def survivors(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, pct: int) -> np.ndarray:
    """Which pairs of tree nodes may hold a link: the ranges of sizes allow it,
    and the common bits plus the tokens beyond the bits reach the least overlap."""
    ok = (x[2][i] * 100 >= y[1][j] * pct) & (y[2][j] * 100 >= x[1][i] * pct)
    at = np.flatnonzero(ok)
    for s in range(0, len(at), 1 << 14):
        p = at[s:s + (1 << 14)]
        bits = np.bitwise_count(x[0][i[p]] & y[0][j[p]]).sum(axis=1, dtype=np.int64)
        most = bits + np.minimum(x[3][i[p]], y[3][j[p]])
        ok[p] = most * (100 + pct) >= pct * (x[1][i[p]] + y[1][j[p]])
    return ok


def linked(a: np.ndarray, b: np.ndarray, pct: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) * 100 < pct * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= pct * (len(a) + len(b) - common)


class Forest:
    """Union-find over the positions of a cell."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def flat(self) -> np.ndarray:
        while (nxt := self.up[self.up]).tolist() != self.up.tolist():
            self.up = nxt
        return self.up


def dual_traversal(x: SignatureTree, y: SignatureTree, forest: Forest, place_x: np.ndarray, place_y: np.ndarray,
                   pct: int) -> list[tuple[int, int]]:
    """Link documents of two trees (or of one with itself) that aren't
    connected yet; returns the pairs that connected two components.

    ``place_*``: positions in ``forest`` by document."""
    same, found, fan = x is y, [], SignatureTree.FAN

    def leaves(i: np.ndarray, j: np.ndarray) -> None:
        di, dj = x.order[i], y.order[j]
        for s in range(0, len(di), 4096):
            a, b = di[s:s + 4096], dj[s:s + 4096]
            up = forest.flat()
            apart = up[place_x[a]] != up[place_y[b]]
            p = np.flatnonzero(apart)
            if not len(p):
                continue
            p = p[survivors(x.levels[0], y.levels[0], i[s:s + 4096][p], j[s:s + 4096][p], pct)]
            for q in p.tolist():
                u, v = int(place_x[a[q]]), int(place_y[b[q]])
                if forest.root(u) != forest.root(v) and linked(x.sets[a[q]], y.sets[b[q]], pct):
                    forest.join(u, v)
                    found.append((u, v))

    # neighbours first: in a group of near copies, they connect most documents
    if same:
        i = np.arange(len(x.sets) - 1)
        leaves(i, i + 1)
    stack = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        lx, ly, i, j = stack.pop()
        ok = survivors(x.levels[lx], y.levels[ly], i, j, pct) if lx + ly else np.ones(len(i), bool)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not lx and not ly:
            leaves(i, j)
            continue
        down_x, down_y = lx >= ly and lx > 0, ly >= lx and ly > 0
        step = 1 << 10
        for s in range(0, len(i), step):
            a, b = i[s:s + step], j[s:s + step]
            if down_x:
                a, b = np.add.outer(a * fan, np.arange(fan)).ravel(), np.repeat(b, fan)
                keep = a < len(x.levels[lx - 1][1])
                a, b = a[keep], b[keep]
            if down_y:
                a, b = np.repeat(a, fan), np.add.outer(b * fan, np.arange(fan)).ravel()
                keep = b < len(y.levels[ly - 1][1])
                a, b = a[keep], b[keep]
            nx, ny = lx - down_x, ly - down_y
            if same and nx == ny:
                keep = a < b if nx == 0 else a <= b
                a, b = a[keep], b[keep]
            stack.append((nx, ny, a, b))
    return found


def _bits(sets: list[np.ndarray]) -> int:
    middle = sorted(len(u) for u in sets)[len(sets) // 2]
    return max(256, min(8192, 1 << int(math.ceil(math.log2(4 * middle + 1)))))


def cell_links(nodes: list[int], sets: list[np.ndarray], sides: list[bool],
               pct: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect the documents of one cell; if some are of side True
    (strays), only pairs with one of them are looked at, once per cell."""
    found: list[tuple[int, int]] = []
    forest = Forest(len(nodes))
    here = [i for i, s in enumerate(sides) if not s]
    there = [i for i, s in enumerate(sides) if s]
    bits = _bits(sets)
    if not there:
        tree = SignatureTree(sets, bits)
        place = np.arange(len(nodes))
        found = dual_traversal(tree, tree, forest, place, place, pct)
    elif here:
        x, y = SignatureTree([sets[i] for i in here], bits), SignatureTree([sets[i] for i in there], bits)
        found = dual_traversal(x, y, forest, np.array(here), np.array(there), pct)
    return [(nodes[i], nodes[j]) for i, j in found], forest.flat()


def _link_cells(pct: int):
    """Per partition, sorted by cell: the links of each cell (a, b, null), and
    of a cell that is one of many, two members of its largest component (node,
    null, set).  Cells are streamed one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, root, many, nodes, sets, sides = None, 0, False, [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            if not nodes:
                return
            links, up = cell_links(nodes, sets, sides, pct)
            picks = []
            if many:
                main = np.flatnonzero(up == np.bincount(up).argmax())
                picks = sorted({int(main[0]), int(main[-1])})
            n, m = len(links), len(picks)
            if n + m:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([root] * (n + m), pa.int64()),
                     pa.array([a for a, _ in links] + [nodes[i] for i in picks], pa.int64()),
                     pa.array([b for _, b in links] + [None] * m, pa.int64()),
                     pa.array([None] * n + [sets[i].tobytes() for i in picks], pa.binary())], names=["root", "a", "b", "set"])

        for batch in batches:
            for c, r, x, node, side, raw in zip(*(col.to_pylist() for col in batch.columns)):
                if c != cell:
                    yield from close()
                    cell, root, many, nodes, sets, sides = c, r, x, [], [], []
                nodes.append(node)
                sides.append(side)
                sets.append(np.frombuffer(raw, np.uint64))
        yield from close()

    return run


def _cells(df: DataFrame, pct: int) -> DataFrame:
    """Traverse the cells of (cell, root, many, node, stray, set) rows."""
    return cut(df.select("cell", "root", "many", "node", "stray", "set").repartition("cell").sortWithinPartitions("cell", "node")
               .mapInArrow(_link_cells(pct), "root long, a long, b long, set binary"))


def _spread(df: DataFrame, count: DataFrame, per_cell: int) -> DataFrame:
    """Deal the rows of a cluster (root) out to cells of about ``per_cell``."""
    cells = count.select("root", F.ceil(F.col("w") / per_cell).cast("int").alias("g"))
    return df.drop("g").join(cells, "root").withColumn("c", F.pmod(F.xxhash64("node"), "g").cast("int"))


def _within(df: DataFrame) -> DataFrame:
    return df.select(F.xxhash64("root", "c").alias("cell"), "root", (F.col("g") > 1).alias("many"), "node", F.lit(False).alias("stray"), "set")


def near_duplicates(docs: DataFrame, k: int = 5, pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    # rows are told apart by id and text, as an id may be null or repeated
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row"))

    # 1: nodes, and the frequent shingles of each batch
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            n, node, seen = [], [], {}
            for u in shingle_sets(off, data, k):
                n.append(len(u))
                x = node_of(u) if len(u) else None
                node.append(x)
                if x is not None:
                    seen.setdefault(x, u)
            often: list = [None] * len(n)
            if len(seen) >= LOCAL:
                # a share of the hash space at a time bounds the memory
                values, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
                hot = counts >= LOCAL
                often[0] = [{"h": int(h), "n": int(c)} for h, c in zip(values[hot].view(np.int64), counts[hot])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(often, pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())])))],
                names=["doc_id", "row", "n_shingles", "node", "often"])

    base = cut(docs.mapInArrow(first, "doc_id long, row long, n_shingles long, node long, often array<struct<h: bigint, n: bigint>>"))
    ids = base.select("doc_id", "n_shingles", "node")
    hot = (base.select(F.explode("often").alias("o")).groupBy("o.h").agg(F.sum("o.n").alias("n")).where(F.col("n") >= GLOBAL)
           .orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).select("h").toPandas()["h"].to_numpy(np.int64))
    frequent = docs.sparkSession.sparkContext.broadcast(np.sort(hot.view(np.uint64)))
    largest, total = base.agg(F.max("n_shingles"), F.sum("n_shingles")).first()
    bounds = size_classes(pct, largest or 1)
    ranges = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total or 0) // RANGE)

    # 2: blocks that several documents of a share have, then routing keys, merged within a batch
    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(0))
            for i, j in blocks(off):
                sets = [u for u in shingle_sets(off[i:j + 1], data, k) if len(u)]
                keys = [np.unique(routing_keys(u, bounds, pct, frequent.value, None)) for u in sets]
                if keys:
                    nodes = np.repeat(np.array([node_of(u) for u in sets], np.int64), [len(x) for x in keys])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(nodes)], names=["key", "node"])

    some = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(HOT_SHARE)) == 0).mapInArrow(share, "key long, node long")
    hot = (some.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("n")).where("a != b")
           .orderBy(F.desc("n"), "key").limit(MAX_HOT).select("key", "n").toPandas())
    keys = hot["key"].to_numpy(np.int64).view(np.uint64)
    at = np.argsort(keys)
    crowded = docs.sparkSession.sparkContext.broadcast((keys[at], hot["n"].to_numpy(np.int64)[at]))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(0))
            seen, keys, owner = {}, [], []
            for u in shingle_sets(off, data, k):
                if len(u) and (x := node_of(u)) not in seen:
                    seen[x] = True
                    keys.append(routing_keys(u, bounds, pct, frequent.value, crowded.value).view(np.int64))
                    owner.append(np.full(len(keys[-1]), x, np.int64))
            if not keys:
                continue
            key, own = np.concatenate(keys), np.concatenate(owner)
            at = np.lexsort((own, key))
            key, own = key[at], own[at]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            center = own[np.flatnonzero(new)][np.cumsum(new) - 1]
            # documents that share a key here meet under a key of this batch's own
            rest = np.unique(np.stack([center, own])[:, center != own], axis=1)
            tag = mix(np.array([abs(hash((int(own[0]), len(own), int(own[-1]))))], np.uint64))
            local = mix(rest[0].view(np.uint64) ^ tag).view(np.int64)
            k_out, n_out = np.concatenate((key[new], local, local)).view(np.uint64), np.concatenate((own[new], rest[0], rest[1]))
            at = np.argsort(k_out)
            k_out, n_out = k_out[at], n_out[at]
            p = ((k_out >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int32)
            cuts = np.concatenate(([0], np.flatnonzero(p[1:] != p[:-1]) + 1, [len(p)]))
            yield pa.RecordBatch.from_arrays([pa.array(p[cuts[:-1]]), pa.array([pack(k_out[i:j], n_out[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())],
                                             names=["p", "data"])

    packed = docs.select("text").mapInArrow(route, "p int, data binary")
    pairs = packed.repartition("p").sortWithinPartitions("p").mapInArrow(_meet, "a long, b long")
    clusters = connected(pairs).withColumnRenamed("node", "short")
    short = F.col("node").bitwiseAND(F.lit((1 << 8 * SHORT_BYTES) - 1)).alias("short")
    n = clusters.count()

    # 3: cells of the clusters
    owner = base.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.first("n_shingles").alias("n"))
    # as many tasks as the nodes need, though few of them are written
    placed = cut(owner.select("*", short).join(small(clusters, MAX_BROADCAST), "short").drop("short"))
    weights = cut(placed.groupBy("root").agg(F.greatest(F.count("*"), F.sum("n") / SHINGLES_PER_DOC).alias("w")), n)
    cell_of = _spread(placed, weights, CELL).select("row", "root", "g", "c")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            for s, e in blocks(off, 1 << 22):
                us = list(shingle_sets(off[s:e + 1], data, k))
                part = batch.slice(s, e - s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(u) if len(u) else None for u in us], pa.int64()),
                     pa.array([u.tobytes() for u in us], pa.binary()), *part.columns[2:]],
                    names=["node", "set", "root", "g", "c"])

    def chosen(cells: DataFrame) -> DataFrame:
        with_sets = docs.join(small(cells, MAX_BROADCAST), "row").select("row", "text", "root", "g", "c").mapInArrow(
            sets, "node long, set binary, root long, g int, c int").where("node is not null")
        # rows that share a hash may bring other texts along
        return with_sets.select("*", short).join(small(clusters.select("short", F.col("root").alias("root_of")), MAX_BROADCAST), "short") \
            .where("root = root_of").select("root", "g", "c", "node", "set")

    many = weights.where(F.col("w") > CELL).count() > 0
    found = _cells(_within(chosen(cell_of)), pct)
    links, level = [found.where("b is not null").select("a", "b")], found.where("b is null")
    while many and level.limit(1).count():
        # members of the cells' main components meet, level by level
        level = level.select("root", F.col("a").alias("node"), "set")
        level = _spread(level, cut(level.groupBy("root").agg(F.count("*").alias("w")), n), CELL)
        found = _cells(_within(level), pct)
        links.append(found.where("b is not null").select("a", "b"))
        level = found.where("b is null")
    links = cut(functools.reduce(DataFrame.unionByName, links), n)
    if many:
        links = cut(links.unionByName(_strays(cut(chosen(cell_of.where("g > 1"))), links, pct)), n)

    # components of documents
    low = cut(owner.join(small(connected(links), MAX_BROADCAST), "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root")))
    named = cut(low.join(cut(low.groupBy("root").agg(F.min("doc_id").alias("component_id"))), "root").select("node", "component_id"))
    return ids.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _strays(docs: DataFrame, links: DataFrame, pct: int) -> DataFrame:
    """In clusters of several cells, links of the documents outside the main
    component, found by letting them meet all documents of the cluster."""
    comps = connected(links).withColumnRenamed("root", "comp")
    n = docs.count()
    docs = cut(docs.select("root", "node", "set").join(small(comps, MAX_BROADCAST), "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    size = cut(docs.groupBy("root", "comp").agg(F.count("*").alias("n")), n)
    main = cut(size.groupBy("root").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("n_main"))
               .where("n > n_main").select("root", "main", F.ceil(F.col("n") / STRAY_CELL).cast("int").alias("g"),
                                           F.ceil((F.col("n") - F.col("n_main")) / STRAY_CELL).cast("int").alias("s")))
    docs = docs.join(small(main, MAX_BROADCAST), "root")
    at = lambda which, seed: F.pmod(F.xxhash64("node", F.lit(seed)), which).cast("int")
    here = docs.select("root", "node", "set", at("g", 1).alias("c"), F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("k"), F.lit(False).alias("stray"))
    there = docs.where("comp != main").select("root", "node", "set", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("c"), at("s", 2).alias("k"),
                                              F.lit(True).alias("stray"))
    met = here.unionByName(there).select(F.xxhash64("root", "c", "k").alias("cell"), "root", F.lit(False).alias("many"), "node", "stray", "set")
    return _cells(met, pct).where("b is not null").select("a", "b")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, pct=90)


SQL = """
WITH docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rid,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT rid, doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM docs),
items AS (SELECT rid, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.rid AS a, b.rid AS b FROM items a JOIN items b ON a.g = b.g AND a.rid < b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT rid, rid FROM docs UNION SELECT r.a, e.b FROM r JOIN edges e ON r.b = e.a)
  SELECT a, min(doc_id) AS component_id FROM r JOIN docs ON docs.rid = r.b GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, reach.component_id FROM sets s JOIN reach ON reach.a = s.rid
"""
