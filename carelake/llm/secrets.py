"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns (``PATTERNS``) are matched leftmost and without overlap per kind;
matches that fail their least length are dropped.

The battery looks at maximal runs of at least ``MIN_RUN`` characters of
``[A-Za-z0-9+/_=-]`` that hold a letter and a digit.  For each, an encoding is
inferred (hex, base32, base36 or base64) and three tests against random
symbols of its alphabet give p-values: chi-squared uniformity, runs above and
below the middle of the alphabet, and serial correlation.  A run that passes
all three may be random; whether it may be ordinary text is a second p-value,
the likelihood of ordinary text over that of random symbols (at most that share
of ordinary texts has so small a ratio).  Ordinary text is a chain of characters
with the pairs' frequencies of all documents outside the runs, so rare letters and changes of
case or between letters and digits count alike; a share ``FREE`` of its
characters may be anything, so no single character tells much.  These p-values
are controlled for false discoveries (Benjamini-Hochberg) over all documents,
within strata of length, so that one threshold per stratum results.

The scan has two passes over the texts, one for the pairs' frequencies and one
for spans and p-values; only small rows are kept between them.

Cases: null counts as empty, with no span and the hash of an empty string;
repeated rows give repeated rows; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import blocks, cut, table, utf8, words

# fixed values: the patterns to find and their least lengths
PATTERNS = (
    ("assign", re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE), 2, 6),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(rb"[0-9a-f]+"), 0, 24),
)
KINDS = [k for k, *_ in PATTERNS] + ["random"]
MIN_RUN = 16
ALPHA, FDR = 0.001, 0.001
#: share of ordinary text's characters that follow no frequencies; pairs that a character's own frequency counts as
FREE, PRIOR = 0.2, 100.0
#: strata of length are STRATUM characters wide, the last is open; p-values are counted in steps of 1 / STEPS of their log10
STRATUM, STRATA, STEPS, MOST = 8, 16, 8, 320

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_INDEX = {}
for _name, _chars in ENCODINGS.items():
    _INDEX[_name] = np.full(256, -1, np.int64)
    _INDEX[_name][[ord(c) for c in _chars]] = np.arange(len(_chars))
_RUN_GAP = np.ones(256, bool)
_RUN_GAP[[ord(c) for c in _DIGITS + _UPPER + _LOWER + "+/_=-"]] = False
#: number of a byte among the characters of runs, 0 for those between them
_CLASS = np.cumsum(~_RUN_GAP) * ~_RUN_GAP
CLASSES = int(_CLASS.max()) + 1
_HEX_GAP = np.ones(256, bool)
_HEX_GAP[[ord(c) for c in _DIGITS + "abcdef"]] = False
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[65:91] = _LETTER[97:123] = 1


def _tail(z: float) -> float:
    """Upper tail of the normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(run: np.ndarray, chain: np.ndarray) -> tuple[str, float, float] | None:
    """(encoding, smallest p-value of the three tests, p-value as ordinary text) of a run of bytes; None if no alphabet fits."""
    name, x = next(((k, t[run]) for k, t in _INDEX.items() if (t[run] >= 0).all()), (None, None))
    if name is None:
        return None
    n, k = len(x), len(ENCODINGS[name])
    count = np.bincount(x, minlength=k)
    chi = k / n * float((count.astype(float)**2).sum()) - n
    # Wilson-Hilferty; both a very uneven and a very even run are suspicious, only the first is tested
    p_chi = _tail(((chi / (k - 1))**(1 / 3) - 1 + 2 / (9 * (k - 1))) / math.sqrt(2 / (9 * (k - 1)))) if chi > 0 else 1.0
    high = x >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        var = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        p_runs = 2 * _tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var))
    else:
        p_runs = 2.0 ** (1 - n)
    y = x - (k - 1) / 2
    r = float((y[1:] * y[:-1]).sum()) / max(1e-9, float((y * y).sum()))
    p_serial = 2 * _tail(abs(r) * math.sqrt(n))
    at = _CLASS[run]
    ordinary = (1 - FREE) * chain[np.concatenate(([0], at[:-1])), at] + FREE / k
    return name, min(p_chi, p_runs, p_serial), math.exp(min(0.0, n * math.log(k) + float(np.log(ordinary).sum())))


def mixed_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, from off[0], of the runs that hold a letter and a digit."""
    s, e, _ = words(data, off, _RUN_GAP)
    long = e - s >= MIN_RUN
    s, e = s[long], e[long]
    if len(s):
        d = data[off[0]:off[-1]]
        digits, letters = np.concatenate(([0], np.cumsum(_DIGIT[d]))), np.concatenate(([0], np.cumsum(_LETTER[d])))
        mixed = (digits[e] > digits[s]) & (letters[e] > letters[s])
        s, e = s[mixed], e[mixed]
    return s, e


def pair_chain(docs: DataFrame) -> np.ndarray:
    """Probability of each class of characters after each other one in all
    texts, without the runs to test, smoothed by the second one's own frequency."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            off, data = utf8(batch.column(0))
            for i, j in blocks(off):
                d = data[off[i]:off[j]]
                if not len(d):
                    continue
                at = _CLASS[d]
                before = np.concatenate(([0], at[:-1]))
                starts = off[i:j] - off[i]
                before[starts[starts < len(d)]] = 0
                s, e = mixed_runs(data, off[i:j + 1])
                out = np.zeros(len(d) + 1, np.int64)
                out[s] += 1
                out[e] -= 1
                total += np.bincount((before * CLASSES + at)[np.cumsum(out[:-1]) == 0], minlength=CLASSES * CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES * CLASSES)), pa.array(total)], names=["b", "n"])

    rows = docs.select("text").mapInArrow(run, "b long, n long").where("n > 0").groupBy("b").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(CLASSES * CLASSES)
    for r in rows:
        pairs[r["b"]] = r["n"]
    return smoothed(pairs.reshape(CLASSES, CLASSES))


def smoothed(pairs: np.ndarray) -> np.ndarray:
    single = (pairs.sum(axis=0) + 1) / (pairs.sum() + CLASSES)
    return (pairs + PRIOR * single) / (pairs.sum(axis=1, keepdims=True) + PRIOR)


def spans_of(data: np.ndarray, off: np.ndarray, chain: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(document, start, end, kind, p) in bytes from the document's start; p:
    of a random run, -STEPS * log10 of its p-value as ordinary text (-1 for
    runs that are counted but don't pass), else 0."""
    base, d = int(off[0]), data[off[0]:off[-1]]
    raw, found = d.tobytes(), []
    doc_of = lambda at: int(np.searchsorted(off, at + base, side="right")) - 1
    # assign: only documents with a colon or an equals sign; access: with its first letters
    signs = np.flatnonzero((d == 58) | (d == 61))
    for kind, pattern, group, least in PATTERNS[:2]:
        at = signs if kind == "assign" else [m.start() for m in re.finditer(b"AKIA", raw)]
        for i in np.unique(np.searchsorted(off, np.asarray(at, np.int64) + base, side="right") - 1).tolist():
            s, e = int(off[i]) - base, int(off[i + 1]) - base
            for m in pattern.finditer(raw[s:e]):
                if len(m.group(group)) >= least:
                    found.append((i, m.start(), m.end(), KINDS.index(kind), 0))
    s, e, _ = words(data, off, _HEX_GAP)
    for at in np.flatnonzero(e - s >= PATTERNS[2][3]).tolist():
        i = doc_of(s[at])
        found.append((i, int(s[at] + base - off[i]), int(e[at] + base - off[i]), 2, 0))
    for a, b in zip(*(x.tolist() for x in mixed_runs(data, off))):
        run = d[a:b]
        while len(run) and run[-1] == 61:  # padding
            run, b = run[:-1], b - 1
        if len(run) < MIN_RUN or (got := battery(run, chain)) is None:
            continue
        i = doc_of(a)
        p = min(MOST, int(-STEPS * math.log10(max(got[2], 1e-300)))) if got[1] >= ALPHA else -1
        found.append((i, a + base - int(off[i]), b + base - int(off[i]), 3, p))
    return found


def _code_points(d: np.ndarray, found: list[tuple]) -> list[tuple]:
    """The same spans of one document in code points."""
    chars = np.concatenate(([0], np.cumsum((d & 0xC0) != 0x80)))
    return [(int(chars[s]), int(chars[e]), kind, p) for _, s, e, kind, p in found]


def scan(docs: DataFrame, chain: np.ndarray) -> DataFrame:
    """(doc_id, found): per row of ``docs`` the spans of all kinds, in code
    points, ordered by start and kind; of random runs all that were tested."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("k", pa.int64()), ("p", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            out: list[list] = [[] for _ in range(len(off) - 1)]
            for i, j in blocks(off):
                by: dict[int, list] = {}
                for x in spans_of(data, off[i:j + 1], shared.value):
                    by.setdefault(x[0], []).append(x)
                for at, xs in by.items():
                    rows = _code_points(data[off[i + at]:off[i + at + 1]], xs)
                    out[i + at] = [dict(zip("sekp", x)) for x in sorted(rows, key=lambda x: (x[0], x[2], x[1]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, found array<struct<s: bigint, e: bigint, k: bigint, p: bigint>>")


def thresholds(scanned: DataFrame) -> list[int]:
    """Per stratum of length, the least p (see ``spans_of``) of a discovery:
    Benjamini-Hochberg over the runs tested in all documents."""
    rows = scanned.select(F.explode("found").alias("x")).where("x.k = 3").select(
        F.least(F.floor((F.col("x.e") - F.col("x.s")) / STRATUM), F.lit(STRATA - 1)).alias("stratum"), F.col("x.p").alias("p")).groupBy(
        "stratum", "p").agg(F.count("*").alias("n")).collect()
    out = []
    for stratum in range(STRATA):
        mine = sorted(((r["p"], r["n"]) for r in rows if r["stratum"] == stratum), reverse=True)
        total, so_far, least = sum(n for _, n in mine), 0, MOST + 1
        for p, n in mine:
            so_far += n
            if p >= 0 and 10 ** (-p / STEPS) <= FDR * so_far / total:
                least = p
        out.append(least)
    return out


def discovered(least: list[int]) -> Column:
    """``found`` without the random runs that aren't discoveries or that overlap a pattern's match."""
    bound = F.array(*(F.lit(x) for x in least))
    stratum = lambda x: F.least(F.floor((x["e"] - x["s"]) / STRATUM), F.lit(STRATA - 1)).cast("int")
    base = F.filter("found", lambda x: x["k"] < 3)
    return F.filter("found", lambda x: (x["k"] < 3) | ((x["p"] >= F.get(bound, stratum(x))) & ~F.exists(
        base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))))


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, found) per row of ``docs`` (doc_id, text): patterns' matches and discoveries (s, e, k: start, end, kind)."""
    scanned = cut(scan(docs, pair_chain(docs)))
    return scanned.select("doc_id", discovered(thresholds(scanned)).alias("found"))


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(kinds, x["k"].cast("int")), x["s"], x["e"])), ",")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs``, all columns, with each secret replaced by ``mark`` in the text
    and n_chars, if there, the new length.  The texts are scanned again with
    the thresholds of a first scan, so no text is shuffled."""
    chain = pair_chain(docs)
    scanned = cut(scan(docs, chain))
    least = thresholds(scanned)
    shared = docs.sparkSession.sparkContext.broadcast((chain, least))
    at, names, sign = docs.columns.index("text"), docs.columns, mark.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, least = shared.value
        for batch in batches:
            col = batch.column(at)
            off, data = utf8(col)
            change: dict[int, str] = {}
            for i, j in blocks(off):
                by: dict[int, list] = {}
                for d, s, e, k, p in spans_of(data, off[i:j + 1], chain):
                    chars = int(((data[off[i + d] + s:off[i + d] + e] & 0xC0) != 0x80).sum())
                    if k < 3 or p >= least[min(chars // STRATUM, STRATA - 1)]:
                        by.setdefault(i + d, []).append((s, e))
                for d, xs in by.items():
                    raw, out, end = data[off[d]:off[d + 1]].tobytes(), [], 0
                    for s, e in sorted(xs):
                        if s >= end:
                            out += [raw[end:s], sign]
                        end = max(end, e)
                    change[d] = b"".join([*out, raw[end:]]).decode()
            if change:
                text = col.to_pylist()
                for d, new in change.items():
                    text[d] = new
                cols = list(batch.columns)
                cols[at] = pa.array(text, col.type)
                if "n_chars" in names:
                    n = cols[names.index("n_chars")].to_pylist()
                    for d, new in change.items():
                        n[d] = len(new)
                    cols[names.index("n_chars")] = pa.array(n, batch.schema.field("n_chars").type)
                batch = pa.RecordBatch.from_arrays(cols, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                        F.sha2(listed(F.filter("found", lambda x: x["k"] < 3)), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
