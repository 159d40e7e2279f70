"""Each operator against a brute-force version, on tables with awkward rows."""

import argparse
import hashlib
import inspect
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from carelake.llm import html_extract, language_id, mixing, neighbours, ngram_join, secrets, token_counts, toxicity, url_filter
from carelake.llm.registry import QUERIES
from tests.llm import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return data.write(spark, tmp_path_factory.mktemp("odd"), data.documents(), data.BENCHMARK, data.LABELS, data.PAGES, data.EMBEDDINGS)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return data.write(spark, tmp_path_factory.mktemp("empty"), [])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_language_id(spark, odd):
    got = QUERIES["op1_language_id"](spark, odd).collect()
    assert len(got) == len(data.documents())
    for r, (i, text, *_) in zip(sorted(got, key=lambda r: repr(r["doc_id"])), sorted(data.documents(), key=lambda d: repr(d[0]))):
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r["score"] <= 1
    full = QUERIES["op1_language_id"](spark, data.SF).join(spark.read.parquet(f"{data.SF}/documents.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in full]) >= 0.95


def test_language_scores_do_not_depend_on_blocks():
    text = ("über die wörter " * 9).encode()
    off, flat = np.array([0, len(text), 2 * len(text)]), np.frombuffer(text * 2, np.uint8)
    model = language_id.Model(["a", "b"], np.random.default_rng(1).normal(size=(language_id.BUCKETS, 2)), np.zeros(2))
    both, one = model.logits(flat, off), model.logits(flat[:len(text)], off[:2])
    assert np.allclose(both[0], both[1]) and np.allclose(both[0], one[0])
    long = b"wort und " * 200_000
    parts = model.logits(np.frombuffer(long, np.uint8), np.array([0, len(long)]))
    assert np.allclose(parts, model.logits(np.frombuffer(b"wort und " * 2, np.uint8), np.array([0, 18])), atol=0.05)


def brute_decontaminate(docs, items):
    wins = defaultdict(set)
    for i, t, *_ in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[k:k + 10])].add(i)
    out = []
    for d, t, *_ in docs:
        w, hit, found = WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_decontaminate(spark, odd):
    got = QUERIES["op2_decontaminate"](spark, odd)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute_decontaminate(data.documents(), data.BENCHMARK)


def test_proximity(spark, odd):
    from carelake.llm import decontaminate as D
    docs = spark.createDataFrame([(1, "b a c far away"), (2, "a x x b x x x c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    wins = D.windows(items, 3)
    counts = D.term_counts(docs, wins.selectExpr("explode(w) term").distinct())
    index = D.postings(docs, D.anchors(wins, counts), 3)
    assert [r["doc_id"] for r in D.proximity_matches(index, wins, counts).join(index.select("rid", "doc_id").distinct(), "rid").collect()] == [1]


def test_neighbours(spark, odd):
    got = [tuple(r) for r in QUERIES["op3_neighbours"](spark, odd).collect()]
    vectors = {i: v for i, v, *_ in data.EMBEDDINGS if i is not None and i not in (3, 4, 5, 6, 7, 60)}
    want = []
    for q, v in vectors.items():
        if q % 20 == 0:
            near = sorted((-float(np.dot(v, u)), i) for i, u in vectors.items() if i != q and len(u) == len(v))
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:20])]
    assert sorted(got) == sorted(want)


def test_neighbours_recall():
    rng = np.random.default_rng(0)
    ids, v = np.arange(4000), rng.normal(size=(4000, 64)) * rng.uniform(0.5, 1.5, (4000, 1))
    v[100:160] = v[100]
    index, hit, n = neighbours.Index(ids, v), 0, 0
    for q, found, score in index.search(ids[::100], v[::100], 20):
        s = v @ v[q]
        s[q] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        hit, n = hit + len(set(best) & set(found)), n + 20
        assert np.allclose(score, s[found])
    assert hit / n >= 0.9


def test_neighbours_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = defaultdict(set)
    for r in QUERIES["op3_neighbours"](spark, "/root/testdata/sf0.01").collect():
        found[r["query_id"]].add(r["vec_id"])
    hit = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = v @ v[q]
        s[q] = -np.inf
        hit += len(found[ids[q]] & set(ids[np.lexsort((ids, -s))[:20]]))
    assert hit / (20 * len(found)) >= 0.9


def test_neighbours_verify_a_small_part():
    """Clusters of unequal norms: recall, few verified vectors, and the same result wherever the search for the width begins."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 32))
    ids, v = np.arange(8000), (np.repeat(centre, 200, axis=0) + 0.3 * rng.normal(size=(8000, 32))) * rng.uniform(0.2, 3, (8000, 1))
    index, hit, verified = neighbours.Index(ids, v), 0, []
    collisions = index._verify

    def counted(query_id, query, count, enough, k):
        verified.append(int((count >= PROJ - np.searchsorted(np.bincount(count, minlength=PROJ + 1)[::-1].cumsum(), enough)).sum()))
        return collisions(query_id, query, count, enough, k)

    PROJ = neighbours.PROJECTIONS
    index._verify = counted
    asked = np.arange(0, 8000, 80)
    for q, found, _ in index.search(ids[asked], v[asked], 20):
        s = v @ v[q]
        s[q] = -np.inf
        hit += len(set(np.lexsort((ids, -s))[:20]) & set(found))
    assert hit / (20 * len(asked)) >= 0.9 and max(verified) < 0.2 * len(ids)
    one_by_one = [next(index.search(ids[[q]], v[[q]], 20)) for q in asked[::9]]
    for q, found, _ in one_by_one:
        assert found.tolist() == next(f for i, f, _ in index.search(ids[asked], v[asked], 20) if i == q).tolist()


def test_token_counts(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, counter = Tokenizer.from_file(path), token_counts.Counter(open(path, encoding="utf-8").read())
    rng = random.Random(4)
    pool = [chr(i) for i in range(1, 0x180)] + ["'s", "'LL", "<|startoftext|>", "<|endoftext|>", "İ", "Σ", "́", "中文", "😀", "aaaaaa", " ", "Ⱥ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["a" * 5000, "ab" * 999, ""]
    assert counter.count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = rows_of(QUERIES["op4_token_counts"](spark, odd), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t, *_ in data.documents()]
    assert got == sorted(want, key=repr)


def test_merges_follow_the_ranks():
    spec = {"model": {"vocab": {}, "merges": [["a", "b</w>"], ["a", "a"], ["aa", "ab</w>"]], "end_of_word_suffix": "</w>"}, "added_tokens": []}
    names = [chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]] + [chr(256 + i) for i in range(68)]
    for x in [*names, *(n + "</w>" for n in names), "ab</w>", "aa", "aaab</w>"]:
        spec["model"]["vocab"][x] = len(spec["model"]["vocab"])
    import json
    assert token_counts.Merges(json.dumps(spec)).counts([b"ab", b"aab", b"aaab", b"aaaa", b"x"]).tolist() == [1, 2, 1, 3, 1]


def test_mixing(spark, odd):
    got = QUERIES["op5_mixing"](spark, odd).collect()
    assert len(got) == len(data.documents())
    assert sorted(map(repr, got)) == sorted(map(repr, QUERIES["op5_mixing"](spark, odd).collect()))
    per = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        per[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(n - target) <= 1 for (_, target), n in per.items())


def test_buckets_of_keys_change_no_result(spark, monkeypatch):
    docs = [(i, "w " * (i % 7), "hot" if i % 3 else f"s{i % 5}", 0) for i in range(600)] + [(None, "a b", "hot", 0)] * 3
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string, n int")
    labels = spark.createDataFrame([(i, 0) for i in range(0, 600, 2)], "doc_id long, quality int")
    want = rows_of(mixing.mix(docs, labels), "doc_id", "size", "target", "taken")
    for least, per in ((1, 10**6), (7, 10**6), (1, 3)):
        monkeypatch.setattr(mixing, "BUCKETS", least)
        monkeypatch.setattr(mixing, "PER_BUCKET", per)
        assert rows_of(mixing.mix(docs, labels), "doc_id", "size", "target", "taken") == want


def test_targets_stop_at_three_times_the_size(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    assert got["a"] == 30 and got[None] == 3 and abs(got["b"] - 978) < 1e-9


BASE = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]


def brute_secrets(text):
    found = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(BASE) for m in re.finditer(p, text or "") if len(m.group(g)) >= least]
    return [f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


def test_secrets(spark, odd):
    got = sorted(QUERIES["op6_secrets"](spark, odd).collect(), key=repr)
    want = {(i, hashlib.sha256(",".join(brute_secrets(t)).encode()).hexdigest()) for i, t, *_ in data.documents()}
    assert len(got) == len(data.documents()) and {(r["doc_id"], r["base_sha256"]) for r in got} == want


def test_battery(spark):
    rng = random.Random(2)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(48))
    prose = "the internationalisation of compartmentalised responsibilities 2024 in example/some-long-path-of-words-and-more-words/page1 "
    docs = spark.createDataFrame([(1, prose * 30), (2, prose + key + " end"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["found"] for r in secrets.secrets(docs).collect()}
    assert [(x["s"], x["e"], x["k"]) for x in found[2]] == [(len(prose), len(prose) + 48, 3)] and not found[1] and not found[3]
    whole = docs.selectExpr("text", "doc_id", "cast(length(text) as int) n_chars")
    out = {r["doc_id"]: r for r in secrets.redact(whole).collect()}
    assert out[2]["text"] == prose + "[secret] end" and out[2]["n_chars"] == len(out[2]["text"]) and out[3]["text"] is None


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(LOWER)
    fits = [h + p for h, p, _ in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_url_filter(spark, odd):
    got = rows_of(QUERIES["op7_url_filter"](spark, odd), "page_id", "host", "path", "rule")
    assert got == sorted(((i, *brute_url(u)) for i, u, *_ in data.PAGES), key=repr)
    verdicts = {r["rule"]: r["verdict"] for r in QUERIES["op7_url_filter"](spark, odd).where("rule is not null").collect()}
    assert verdicts == {"example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def test_templates_learn_from_rules(spark):
    rules = (("shop.test", "/buy/1", "block"), ("shop.test", "/help/", "allow"))
    urls = [f"http://shop.test/buy/{i}" for i in range(100, 300)] + [f"http://shop.test/help/{i}" for i in range(30)] + ["http://shop.test/buy/999", "http://shop.test/new/1"]
    got = {r["url"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).join(
        spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), "page_id").collect()}
    assert got["http://shop.test/buy/999"] == "block" and got["http://shop.test/help/3"] == "allow" and got["http://shop.test/new/1"] == "allow"


def test_deep_branches_are_told_apart(spark):
    rules = (("shop.test", "/a/b/c/d/e/f/bad/", "block"),)
    urls = ["http://shop.test/a/b/c/d/e/f/bad/1"] + [f"http://shop.test/a/b/c/d/e/f/good/{i}" for i in range(40)] + [f"http://shop.test/{'a/' * 60}{i}" for i in range(5)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert got == {i: "allow" if i else "block" for i in range(len(urls))}


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 0, 1, 70, 2])
    score, trans, start = rng.normal(size=lengths.sum()), np.exp(rng.normal(size=(2, 2))), 0.4
    p, _, _ = toxicity.marginals(score, lengths, trans, start)
    at = 0
    for n in lengths:
        s = score[at:at + n]
        alpha, beta = np.zeros((n, 2)), np.ones((n, 2))
        for t in range(n):
            e = np.array([1, np.exp(s[t])])
            alpha[t] = e * (np.array([1, np.exp(start)]) if t == 0 else alpha[t - 1] @ trans)
            alpha[t] /= alpha[t].sum()
        for t in range(n - 2, -1, -1):
            beta[t] = trans @ (np.array([1, np.exp(s[t + 1])]) * beta[t + 1])
            beta[t] /= beta[t].sum()
        both = alpha * beta
        assert np.allclose(p[at:at + n], both[:, 1] / both.sum(axis=1)) if n else True
        at += n


def test_toxicity(spark, odd):
    got = QUERIES["op8_toxicity"](spark, odd).collect()
    assert len(got) == len(data.documents()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    rng = random.Random(1)
    texts = [" ".join(rng.choice("sun moon river stone cloud tree path".split()) + rng.choice("abcdefgh") for _ in range(60)) for _ in range(400)]
    texts = [t + (" you vilewort stinker" if i % 4 == 0 else "") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    scored = {r["doc_id"]: r for r in toxicity.toxicity(docs, toxicity.train(docs, labels)).collect()}
    right = [(scored[i]["score"] >= 0.5) == (i % 4 == 0) for i in range(300, 400)]
    assert np.mean(right) >= 0.95
    a, b = (int(x) for x in scored[304]["spans"].split(",")[-1].split(":"))
    assert "vilewort" in texts[304][a:b] or "stinker" in texts[304][a:b]


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(docs, k, pct):
    sets = [shingles(t, k) for _, t, *_ in docs]
    up = list(range(len(docs)))
    root = lambda i: i if up[i] == i else root(up[i])
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    low = defaultdict(list)
    for i in range(len(docs)):
        low[root(i)] += [docs[i][0]] if docs[i][0] is not None else []
    return sorted(((docs[i][0], len(sets[i]), min(low[root(i)], default=None)) for i in range(len(docs))), key=repr)


def test_ngram_join(spark, odd):
    assert rows_of(QUERIES["op9_ngram_join"](spark, odd), "doc_id", "n_shingles", "component_id") == brute_components(data.documents(), 3, 90)


def near_copies(n, seed, words=80):
    rng = random.Random(seed)
    bases = [[rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(words)] for _ in range(6)]
    line = "this very common line stands in many of the texts".split()
    out = []
    for i in range(n):
        w = list(bases[i % 6]) if i % 2 else [str(rng.randrange(10**6)) for _ in range(words // 2)] + line
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
        out.append((i, " ".join(w[:rng.randrange(words - 4, words + 1)])))
    return out


def test_ngram_join_null_ids_in_a_chain(spark):
    """Links through rows without an id hold: a null between two documents, alone, repeated, and with another id's text."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(140)]
    step = lambda n: " ".join(base[:100 + n])
    docs = [(3, step(0)), (None, step(9)), (8, step(18)), (None, step(9)), (None, "only null " * 3), (None, "only null " * 3), (9, "alone"), (None, None), (5, step(30)),
            (None, step(34)), (5, "another text of five")]
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=3, pct=90)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(docs, 3, 90)
    assert {r["component_id"] for r in got.where("doc_id = 8").collect()} == {3}


def test_ngram_join_many_cells(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 8)
    monkeypatch.setattr(ngram_join, "STRAY_CELL", 16)
    monkeypatch.setattr(ngram_join, "GLOBAL", 30)
    docs = near_copies(300, 5)
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), k=5, pct=80)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(docs, 5, 80)


def test_ngram_join_lines_of_many_documents_tie_none(spark, monkeypatch):
    """Different documents with one of some common lines don't become one cluster, though no line is frequent in a batch; links hold."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    lines = [[word() for _ in range(12)] for _ in range(20)]
    texts = [[word() for _ in range(24)] + lines[i % 20] for i in range(600)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000 + i, " ".join(texts[i] + ["end"])) for i in range(0, 600, 40)]
    sizes, inner = [], ngram_join.connected
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 2, raising=False)
    monkeypatch.setattr(ngram_join, "connected", lambda edges: [out := inner(edges), sizes.append(out.count())][0])
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=5, pct=80)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(docs, 5, 80)
    assert sizes[0] < 150


@pytest.mark.parametrize("seed", [1, 2])
def test_routing_keeps_every_link_in_any_order_of_blocks(seed):
    """Hot blocks come last, whatever the list of hot blocks."""
    sets = []
    for _, t in near_copies(120, seed, 40):
        raw = np.frombuffer(t.encode(), np.uint8)
        sets.append(next(ngram_join.shingle_sets(np.array([0, len(raw)]), raw, 3)))
    bounds = ngram_join.size_classes(80, max(map(len, sets)))
    none = np.zeros(0, np.uint64)
    every = np.unique(np.concatenate([ngram_join.routing_keys(u, bounds, 80, none, None) for u in sets]))
    rng = np.random.default_rng(seed)
    hot = np.sort(rng.choice(every, len(every) // 2, replace=False))
    levels = rng.integers(2, 9, len(hot))
    keys = [set(ngram_join.routing_keys(u, bounds, 80, none, (hot, levels)).tolist()) for u in sets]
    links = [(i, j) for i in range(120) for j in range(i) if ngram_join.linked(sets[i], sets[j], 80)]
    assert links and all(keys[i] & keys[j] for i, j in links)


@pytest.mark.parametrize("gap", [1 << 40, 1 << 62])
def test_packed_routing_keys(gap):
    rng = np.random.default_rng(3)
    for n in (1, 2, 500):
        keys = np.cumsum(rng.integers(0, max(1, gap // n), n).astype(np.uint64), dtype=np.uint64)
        nodes = rng.integers(-2**63, 2**63, n)
        raw = ngram_join.pack(keys, nodes)
        got, short = ngram_join.unpack(raw)
        assert got.tolist() == (keys >> np.uint64(16)).tolist() and short.tolist() == (nodes & (2**40 - 1)).tolist()
    assert len(ngram_join.pack(np.arange(500, dtype=np.uint64) << np.uint64(40), nodes)) < 10 * 500


@pytest.mark.parametrize("k,pct,words", [(3, 90, 60), (5, 80, 200), (2, 60, 12)])
def test_routing_keeps_every_link(k, pct, words):
    docs = near_copies(150, 9 + k, words)
    sets = []
    for _, t in docs:
        raw = np.frombuffer(t.encode(), np.uint8)
        sets.append(next(ngram_join.shingle_sets(np.array([0, len(raw)]), raw, k)))
    bounds = ngram_join.size_classes(pct, max(map(len, sets)))
    seen = Counter(x for u in sets for x in u.tolist())
    frequent = np.sort(np.array([x for x, n in seen.items() if n >= 20], np.uint64))
    keys = [set(ngram_join.routing_keys(u, bounds, pct, frequent).tolist()) for u in sets]
    links = [(i, j) for i in range(150) for j in range(i) if ngram_join.linked(sets[i], sets[j], pct)]
    assert links and all(keys[i] & keys[j] for i, j in links)
    got, _ = ngram_join.cell_links(list(range(150)), sets, [False] * 150, pct)
    up = list(range(150))
    root = lambda i: i if up[i] == i else root(up[i])
    for i, j in got:
        up[root(i)] = root(j)
    assert all(root(i) == root(j) for i, j in links) and all(ngram_join.linked(sets[i], sets[j], pct) for i, j in got)


def test_html_extract(spark, odd):
    got = {r["page_id"]: r for r in QUERIES["op10_html_extract"](spark, odd).collect()}
    want = {1: "T&T\nOne bold text\nTwo", 2: "x", 3: "", 4: "", None: "plain text only", 5: "yes <1>", 6: "deep", 8: "z"}
    assert {k: got[k]["text"] for k in want} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_wrapper():
    page = lambda n, extra: (f"<html><body><ul>{'<li><a>m</a></li>' * n}</ul><div class=box><div class=txt>{extra}<p>Own text {n} {'word ' * 20}</p>"  # noqa: E731
                             f"<p>more {n}</p></div></div><div class=foot>Always here</div></body></html>")
    wrapper = html_extract.infer([page(2, ""), page(5, "<h2>Head</h2>"), page(3, "")])
    text = html_extract.expression(wrapper)
    assert "(<li><a>m</a></li>)+" in text and "(<h2>Head</h2>)?" in text and "(<p>#</p>)+" in text and "Always here" in text
    root = html_extract.main_element(wrapper, 3)
    assert root.endswith("div.box>div.txt")
    assert html_extract.extract(page(4, "<h2>A &amp; B</h2>"), root).startswith("A & B\nOwn text 4 word")


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P
    rng = random.Random(6)
    body = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    passage = " ".join(f"item{i}" for i in range(15))
    clean = [body() for _ in range(40)]
    docs = [(i, t) for i, t in enumerate(clean)] + [(100, clean[0]), (101, clean[1] + " tail"), (102, body() + " " + passage), (103, body() + " password=a1b2c3d4e5f6"), (104, None)]
    toxic = [(200 + i, body() + " vilewort stinker vilewort") for i in range(30)]
    rows = [(i, t, "en", f"s{i % 3}", len(t) if t else None, *"abcdefg") for i, t in docs + toxic]
    d = data.write(spark, tmp_path, rows, [(1, passage, 0)], [(i, 1, 0, "") for i in range(40)] + [(i, 1, 1, "") for i, _ in toxic])
    kept = spark.read.parquet(f"{d}/documents.parquet")
    cols = kept.columns
    for name, stage in P.STAGES[:4]:
        kept = stage(spark, kept, d)
        assert kept.columns == cols, name
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(got) == set(range(40)) | {103, 104} and got[103].endswith("[secret]") and "a1b2c3" not in got[103]
    final = P.run(spark, d).collect()
    assert {r["doc_id"] for r in final} == set(got)


def test_pipeline_drops_contaminated_rows_by_row(spark, tmp_path):
    import corpus_pipeline as P
    passage = " ".join(f"item{i}" for i in range(15))
    docs = [(1, "clean words"), (1, "more " + passage), (None, passage), (None, "clean too"), (None, None), (2, passage), (3, "")]
    d = data.write(spark, tmp_path, [(i, t, "en", "s", 1, *"abcdefg") for i, t in docs], [(1, passage, 0)])
    kept = P.drop_contaminated(spark, spark.read.parquet(f"{d}/documents.parquet"), d)
    assert kept.columns == spark.read.parquet(f"{d}/documents.parquet").columns
    assert rows_of(kept, "doc_id", "text") == sorted([(1, "clean words"), (None, "clean too"), (None, None), (3, "")], key=repr)


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline as P
    assert P.run(spark, data.write(spark, tmp_path, [])).collect() == []


def test_bare_less_than_is_text():
    assert html_extract.extract("<p>if a < b then stop</p><p>I <3 it</p>", None) == "if a < b then stop\nI <3 it"
    assert html_extract.extract("<p>1 <2 and no end", None) == "1 <2 and no end"
    assert html_extract.extract("<!doctype html><?x y?><p>a</p></ b>c<p title='x>y'>d</p><p title=\"e>f", None) == "a\nc\nd\nf"


def test_main_text_among_comments_and_marked_parents():
    own = "<p>" + "Own text of this page. " * 5 + "</p>"
    want = " ".join(["Own text of this page."] * 5)
    root = html_extract.main_element(html_extract.infer([f"<body><div class='layout search'>{own}{i}</div>" for i in range(3)], html_extract.WORDS), 3)
    for page in (f"<body><div class=post>{own}</div><article class='comment'>Nice one</article><article class='comment'>No</article>",
                 f"<body><div class=post>{own}</div><aside><article>A teaser</article></aside>",
                 f"<body><div class=post>{own}</div><div class='comments'><article>{'A long comment. ' * 50}</article></div>",
                 f"<body><div class=post>{own}</div><div class='related'><article>A teaser</article></div>",
                 f"<body><div class='related'><article>A teaser, {'long ' * 99}</article></div><article>{own}</article>",
                 f"<body><div class='layout with-sidebar'><div class='sidebar'>Side</div><article>{own}<div class='share'>Share</div></article></div>",
                 f"<body><div id='search-page'><nav>n</nav><main>{own}</main></div>", f"<section class='related-work'><article>{own}</article></section>",
                 f"<div class='page comments-open'><article>{own}</article></div>", f"<body><div class='layout search'>{own}</div>"):
        assert html_extract.extract(page, root) == want, page


def test_template_texts_go(spark):
    own = lambda h, i: f"<h2>Head {h} {i}</h2><p>Own text number {i} of host {h}, <b>see</b> below.</p><table><tr><td>yes<td>yes</table>"
    notice = "<p>This very long text stands in each article of the host, under no word that tells what it is.</p>"
    pages = [(i, f"http://a.org/{i}", f"<article>{own('a', i)}{notice if i % 3 else ''}</article>") for i in range(30)]
    pages += [(100 + i, f"http://b.org/{i}", f"<article>{own('b', 1)}{notice}<p>{i}</p></article>") for i in range(30)]
    pages += [(200 + i, f"http://c.org/{i}", f"<article>{own('c', i)}{notice}</article>") for i in range(3)]
    pages += [(300 + i, f"http://d.org/{i}", f"<body><div class=txt>{own('d', i)}{notice}</div>") for i in range(20)]
    pages += [(400, "http://d.org/x", f"<body><div class=txt><p>Once</p>{notice}</div>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(df).collect()}
    body = lambda h, i: f"Head {h} {i}\nOwn text number {i} of host {h}, see below.\nyes\nyes"
    assert len(got) == len(pages)
    assert all(got[i] == body("a", i) for i in range(30)) and all(got[300 + i] == body("d", i) for i in range(20)) and got[400] == "Once"
    # near copies count as one page, and three pages are too few to tell
    assert all(got[100 + i] == body("b", 1) + f"\n{notice[3:-4]}\n{i}" for i in range(30))
    assert all(got[200 + i] == body("c", i) + "\n" + notice[3:-4] for i in range(3))


def test_short_random_secrets(spark):
    rng = random.Random(5)
    kinds = ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdefghijklmnopqrstuvwxyz"]
    source = [inspect.getsource(m) for m in (argparse, inspect, random, html_extract, mixing)]  # no hash constants
    prose = "An ordinary text of 2024 with HttpRequestHandler2 and test_case_number_12 in some-long-path/of/words/page1 "
    planted = []
    for n in (16, 20, 24, 32, 40):
        for alphabet in kinds:
            made = ("".join(rng.choice(alphabet) for _ in range(n)) for _ in range(1000))
            planted += [x for x in made if re.search("[0-9]", x) and re.search("[A-Za-z]", x)][:40]
    docs = [(i, f"{prose}{x} end") for i, x in enumerate(planted)] + [(-1 - i, x) for i, x in enumerate(source)]
    found = {r["doc_id"]: [(x["s"], x["e"]) for x in r["found"] if x["k"] == 3] for r in secrets.secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hit, every = Counter(), Counter(map(len, planted))
    for i, x in enumerate(planted):
        assert all(s >= len(prose) for s, _ in found[i])
        hit[len(x)] += bool(found[i])
    assert not any(found[-1 - i] for i in range(len(source)))
    recall = {n: hit[n] / every[n] for n in every}
    assert recall[16] >= 0.85 and recall[20] >= 0.9 and min(recall[n] for n in (24, 32, 40)) >= 0.95, recall


@pytest.mark.parametrize("n", [1, 3, 4, 40])
def test_few_labels_block_no_other_branch(spark, n):
    rules = (("shop.test", "/de/", "block"), ("many.test", "/de/", "block"))
    urls = [f"http://shop.test/de/{i}" for i in range(n)] + [f"http://shop.test/{x}/{i}" for x in ("en", "fr") for i in range(3)]
    urls += [f"http://many.test/de/{i}" for i in range(n)] + [f"http://many.test/{x}{y}/1" for x in "abcdef" for y in "uvwxyz"]
    pages = list(enumerate(urls))
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), rules).collect()}
    assert all(got[i] == ("block" if "/de/" in u else "allow") for i, u in pages)


def test_wrapper_of_all_pages(spark):
    page = lambda i: (f"<html><body><div class=top>Site</div><div class=box><div class=txt><p>Own text {i} {'word ' * 20}</p>"  # noqa: E731
                      f"<section class=s{i}>Part {i}</section></div></div></body></html>")
    pages = spark.createDataFrame([("h", page(i)) for i in range(40)] + [("h", None), ("one", "<div class=a><p>x</p></div>"), ("none", "")], "host string, html string")
    got = {r.host: r for r in html_extract.wrappers(pages.repartition(5)).collect()}
    assert all(f"<section.s{i}>" in got["h"].expression for i in range(40))
    assert got["h"].root.endswith("div.box>div.txt") and "Site" in got["h"].expression
    assert got["one"].root == "div.a" and got["none"].root is None
