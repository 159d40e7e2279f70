"""WARC archives, hard negatives and importance resampling against brute force, on tables with awkward rows."""

import base64
import hashlib
import io
import math
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from carelake.llm import hard_negatives, importance, warc
from carelake.llm.registry import QUERIES
from tests.llm import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return data.write(spark, tmp_path_factory.mktemp("odd"), data.documents(), data.BENCHMARK, data.LABELS, data.PAGES, data.EMBEDDINGS)


# ── archives ──────────────────────────────────────────────────────────────

def brute_warc(pages, least=0):
    last = {}
    for i, _, html, *_ in pages:
        key = html or ""
        if len(key.encode()) >= least:
            last[key] = i if last.get(key) is None else max(last[key], i if i is not None else last[key])
    out = []
    for i, _, html, *_ in pages:
        b = (html or "").encode()
        response = len(b) < least or last[html or ""] == i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else last[html or ""]))
    return sorted(out, key=repr)


def test_warc(spark, odd):
    got = QUERIES["op11_warc"](spark, odd)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_warc(data.PAGES)


@pytest.mark.parametrize("least", [0, 3, 10**6])
def test_warc_groups(spark, tmp_path, least):
    rng = random.Random(least)
    pages = [(i, f"http://x/{i % 7}\n é", rng.choice([None, "", "a", "ab\r\n\r\nc", "é" * 3, "z" * 200_000, f"own {i}"])) for i in range(900)]
    pages += [(None, None, "a"), (None, None, "only null"), (5000, "u", "a")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    archives = warc.write_archives(df, str(tmp_path / "out"), least)
    rows = warc.read_records(warc.locate(archives), payload=True).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr) == brute_warc(pages, least)
    html = {i: h or "" for i, _, h in pages if i is not None}
    assert all(r["payload"] == html[r["page_id"]] for r in rows if r["record_type"] == "response" and r["page_id"] is not None)
    assert all(r["payload"] is None for r in rows if r["record_type"] == "revisit")
    assert {r["url"] for r in rows if r["page_id"] is not None and r["page_id"] < 900} == {f"http://x/{i}%0A%20é" for i in range(7)}
    assert archives.agg(F.sum("records")).first()[0] == len(pages)
    for r in archives.collect():
        with zipfile.ZipFile(r["path"]) as z:  # any ZIP reader can open it
            assert z.testzip() is None and set(z.namelist()) == {warc.RECORDS, warc.INDEX}


def test_a_hot_payload_leaves_its_group_unshuffled(spark, tmp_path):
    pages = spark.range(30_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("p"), (F.col("id") / 2).cast("long"))).alias("html"))
    marked = warc.mark_revisits(pages)
    got = marked.groupBy("revisit").count().collect()
    want = 10_000 - 1 + sum(n - 1 for n in Counter(f"p{i // 2}" for i in range(30_000) if i % 3).values())
    assert {r["revisit"]: r["count"] for r in got} == {True: want, False: 30_000 - want}
    assert marked.where("revisit and html is not null").count() == 0
    assert marked.where("revisit and digest = sha1('same')").select("refers_to").distinct().collect() == [(29_997,)]


def zip_bytes(members, prefix=b"", comment=b"", kind=zipfile.ZIP_STORED, force=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", kind) as z:
        z.comment = comment
        for name, body in members:
            with z.open(zipfile.ZipInfo(name) if kind == zipfile.ZIP_STORED else name, "w", force_zip64=force) as f:
                f.write(body)
    return prefix + out.getvalue()


@pytest.mark.parametrize("prefix, comment, force", [(b"", b"", False), (b"junk" * 9, b"", True), (b"", b"PK\x05\x06 as a comment", False), (b"x", b"c" * 65535, True)])
def test_directories(tmp_path, prefix, comment, force):
    members = [("a", b""), ("dir/é", b"body" * 500), ("PK\x05\x06", b"PK\x05\x06" * 9)]
    path = tmp_path / "a.zip"
    path.write_bytes(zip_bytes(members, prefix, comment, force=force))
    with pa.OSFile(str(path)) as f:
        archive = warc.Archive(f)
        assert set(archive.members) == {n for n, _ in members}
        assert all(archive.read(*archive.data(n)) == b for n, b in members)


def test_zip64_directory(tmp_path):
    members = [(f"m{i}", str(i).encode()) for i in range(70_000)]  # more than a short directory counts
    path = tmp_path / "a.zip"
    path.write_bytes(zip_bytes(members, b"prefix"))
    with pa.OSFile(str(path)) as f:
        archive = warc.Archive(f)
        assert len(archive.members) == 70_000
        assert all(archive.read(*archive.data(f"m{i}")) == str(i).encode() for i in (0, 65_535, 69_999))


def test_zip64_fields():
    # sizes and offsets beyond four bytes stand in the extra field, in this order, and only those that are full
    extra = (9).to_bytes(2, "little") + (2).to_bytes(2, "little") + b"xx" + (1).to_bytes(2, "little")
    values = [5 << 32, 6 << 32, 7 << 32]
    full = extra + (24).to_bytes(2, "little") + b"".join(v.to_bytes(8, "little") for v in values)
    assert warc.Archive._wide(full, 0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFF) == (6 << 32, 7 << 32)
    part = extra + (8).to_bytes(2, "little") + values[2].to_bytes(8, "little")
    assert warc.Archive._wide(part, 10, 10, 0xFFFFFFFF) == (10, 7 << 32)


def test_broken_archives(tmp_path):
    path = tmp_path / "a.zip"
    for body, said in ((b"no archive at all", "no end of a central directory"), (b"", "no end of a central directory")):
        path.write_bytes(body)
        with pa.OSFile(str(path)) as f, pytest.raises(ValueError, match=said):
            warc.Archive(f)
    path.write_bytes(zip_bytes([("a", b"x" * 99)], kind=zipfile.ZIP_DEFLATED))
    with pa.OSFile(str(path)) as f, pytest.raises(ValueError, match="isn't stored"):
        warc.Archive(f).data("a")


def test_a_changed_payload_is_an_error(spark, tmp_path):
    writer = warc.Writer(str(tmp_path))
    writer.add(1, "u", warc.record(1, "u", b"body", warc.digest32(b"another"), 4, None), "x", "response")
    path, _ = writer.close()
    with pytest.raises(Exception, match="isn't what its digest says"):
        warc.read_records(warc.locate(spark.createDataFrame([(path,)], "path string"))).collect()


# ── hard negatives ────────────────────────────────────────────────────────

def brute_negatives(rows, every, k_positive=5, k_negative=3, least=50, most=95):
    one = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (label, [float(np.float32(x)) for x in v])
        one[i] = min(one.get(i, key), key)
    whole = {i: (label, tuple(math.floor(256 * x) for x in v)) for i, (label, v) in one.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in whole.items() if i != a and len(w) == len(v)}
        same = sorted((-s, i) for i, s in score.items() if whole[i][0] == label)[:k_positive]
        for ps, p in ((-s, i) for s, i in same):
            found = sorted((-s, i) for i, s in score.items() if whole[i][0] != label and least * ps <= 100 * s <= most * ps)[:k_negative]
            out += [(a, p, r, i, clip(ps), clip(-s)) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def clip(x):
    return max(-2**63, min(2**63 - 1, x))


def test_hard_negatives(spark, odd):
    rows = [(i, None if label is None else (label + 1) % 10 if i is not None and i % 7 == 0 else label, v) for i, v, label, *_ in data.EMBEDDINGS]
    assert sorted(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, odd).collect()) == brute_negatives(rows, 50)


@pytest.mark.parametrize("size, dim", [(0.5, 3), (0.02, 2), (3.0, 16), (1e9, 4), (1e30, 4), (0.0, 3), (1.0, 0)])
def test_hard_negatives_at_all_sizes(spark, monkeypatch, size, dim):
    """Small blocks and groups, ties, repeated and odd rows, components of any size."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    rng = np.random.default_rng(4)
    rows = [(i, None if i % 41 == 7 else int(rng.integers(0, 3)) if i % 3 else 0, (rng.integers(-4, 9, dim) * size / 8).tolist()) for i in range(200)]
    rows += [(4, 1, [1.0] * dim), rows[10], (None, 1, [1.0] * dim), (300, 1, None), (301, 1, [float("nan")] * (dim + 1)), (302, 1, [1.0] * (dim + 1)),
             (304, 0, [1.0] * (dim + 1)), (308, 1, [0.75] * (dim + 1))]
    df = spark.createDataFrame(rows, "vec_id long, label int, v array<float>").withColumn("score", F.lit("x")).withColumn("dim", F.lit("y"))
    assert sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 4 == 0).collect()) == brute_negatives(rows, 4)


def test_packed_products():
    rng = np.random.default_rng(2)
    for size in (1, 255, 2**20, 2**31, 2**61):
        rows, anchors = (rng.integers(-size, size + 1, (n, 5)) for n in (33, 4))
        packed = hard_negatives.Packed(rows, int(np.abs(anchors).max()))
        for a in anchors:
            assert packed.scores(a).tolist() == [sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows]


# ── importance resampling ─────────────────────────────────────────────────

def brute_importance(docs, items, percent=25):
    def grams(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), Counter(zlib.crc32(f.encode()) % 10000 for f in w + [f"{x} {y}" for x, y in zip(w, w[1:])])

    read = [(i, *grams(t)) for i, t in docs]
    s, t = sum((c for _, _, c in read), Counter()), sum((grams(x)[1] for x in items), Counter())
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0)))) for b in s}
    rows = []
    for i, n, c in read:
        weight = sum(gain[b] * k for b, k in c.items()) // c.total() if c else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = k
    return sorted([(r[0], *r[2:]) for r in rows], key=repr)


def test_importance(spark, odd):
    got = QUERIES["op13_importance"](spark, odd)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_importance([(d[0], d[1]) for d in data.documents()], [b[1] for b in data.BENCHMARK])


def test_importance_draw(spark, monkeypatch):
    monkeypatch.setattr(importance, "WORDS", 50)  # documents of several pieces
    rng = random.Random(3)
    vocabulary = ["Zug", "über", "a" * 300, "B2", "c"] + [f"w{i}" for i in range(60)]
    docs = [(i, " - ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 260)))) for i in range(300)]
    docs += [(None, docs[5][1] + " w1" * 30), (7, docs[7][1]), (400, None), (401, ""), (402, "!?")]
    items = [" ".join(rng.choice(vocabulary[:20]) for _ in range(30)) for _ in range(20)] + [None, ""]
    for texts in (items, []):
        got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame([(x,) for x in texts], "text string"))
        rows = sorted((tuple(r) for r in got.drop("n_words").collect()), key=repr)
        assert rows == brute_importance(docs, texts)


def test_spans_are_interned_by_their_bytes():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    start, size = rng.integers(0, 2000, 4000), rng.integers(1, 15, 4000)
    spans = [text[a:a + n].tobytes() for a, n in zip(start, size)]
    # equal and clustered keys make different bytes meet in a slot
    for keys in (None, np.zeros(4000, np.uint64), (size % 3).astype(np.uint64)):
        slot, held = importance.intern(importance.Lanes(text), start, size, keys)
        assert all(spans[held[s]] == x for s, x in zip(slot, spans)) and len(set(spans)) == len(held)


def test_span_hashes():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 5000).astype(np.uint8)
    start, size = rng.integers(0, 4000, 900), np.concatenate((np.arange(600), rng.integers(0, 1000, 300)))
    spans = [raw[a:a + n].tobytes() for a, n in zip(start, size)]
    assert importance.xxhash64(importance.Lanes(raw), start, size).tolist() == [xxhash.xxh64_intdigest(x) for x in spans]
    assert importance.crc32(raw, start, size).tolist() == [zlib.crc32(x) for x in spans]
