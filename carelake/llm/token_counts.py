"""Token counts by rank-synchronous array merging.

The byte-pair merges of a public vocabulary (a tokenizers .json with word-end
suffix) are applied to whole batches: pre-tokens not seen before are held as
ragged numpy arrays, and each round merges, in all of them at once, the pair
of lowest rank that each has, until none is left.  The surviving symbols are
the tokens.  Counts of recent pre-tokens are kept in a bounded dictionary.

Texts of characters below U+0180 are normalised and split by expressions made
from the Unicode tables; for others, the library's own normaliser and
pre-tokeniser give the pre-tokens.  Special strings inside a text count as one
token each, as the library's default has it.

Cases: null counts as empty (0 bytes, 0 tokens); repeated rows give repeated
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import blocks, table, utf8

LIMIT = 2048
#: pre-tokens whose counts a worker keeps
REMEMBERED = 300_000
NO_PAIR = np.int64(1) << 40


def _class(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x180) if test(chr(c)))


_LETTERS = _class(lambda c: unicodedata.category(c)[0] == "L")
_NUMBERS = _class(lambda c: unicodedata.category(c)[0] == "N")
_BLANKS = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"
_SPLIT = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+")
_BEYOND = re.compile("[^\x00-ſ]")


class Merges:
    """The merge table as sorted arrays."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        # the byte alphabet: printable bytes stand for themselves, others follow from U+0100
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        chars = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[chars[b] + suffix] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # a later line for the same pair replaces an earlier one
        last = {int(k): i for i, k in enumerate(key)}
        order = np.array(sorted(last.values(), key=lambda i: key[i]))
        self.key, self.rank, self.new = key[order], order.astype(np.int64), new[order]
        made: dict[int, int] = {}
        for i, x in enumerate(new.tolist()):
            made[x] = max(made.get(x, -1), i)
        # a pair that holds a new symbol ranks after the pair that made it: then all occurrences can merge at once
        self.ordered = all(i > max(made.get(vocab[a], -1), made.get(vocab[b], -1)) for i, (a, b) in enumerate(pairs))
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NO_PAIR), self.new[at]

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        ids = self.inner[flat]
        ends = np.cumsum(sizes)
        ids[ends - 1] = self.final[flat[ends - 1]]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        out, live = sizes.copy(), np.ones(len(tokens), bool)
        while len(ids) > 1:
            rank, new = self.ranks(ids[:-1], ids[1:])
            rank[seq[:-1] != seq[1:]] = NO_PAIR
            rank, new = np.append(rank, NO_PAIR), np.append(new, 0)
            first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            size = np.diff(np.append(first, len(seq)))
            low = np.minimum.reduceat(rank, first)
            hit = (rank == np.repeat(low, size)) & (rank < NO_PAIR)
            at = np.flatnonzero(hit)
            if not len(at):
                break
            if self.ordered:
                # of overlapping occurrences (a run of one symbol) every second one merges
                run = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
                start = np.repeat(at[run], np.diff(np.append(run, len(at))))
                at = at[(at - start) % 2 == 0]
            else:
                at = at[np.concatenate(([True], seq[at][1:] != seq[at][:-1]))]
            ids[at] = new[at]
            out -= np.bincount(seq[at], minlength=len(out))
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            keep &= np.repeat(low < NO_PAIR, size)  # done sequences leave
            ids, seq = ids[keep], seq[keep]
        return out


class Counter:
    """Counts tokens of texts; one per worker process."""

    def __init__(self, text: str):
        self.merges, self.text, self.seen, self._library = Merges(text), text, {}, None
        self.special = re.compile("|".join(map(re.escape, sorted(self.merges.specials, key=len, reverse=True))) or "(?!)")

    def pre_tokens(self, text: str) -> list[str]:
        if _BEYOND.search(text) is None:
            return _SPLIT.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_str(self.text)
        text = self._library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, texts: list[str]) -> list[int]:
        lists, extra = [], []
        for text in texts:
            if "<|" in text:
                parts = self.special.split(text)
                extra.append(len(parts) - 1)
                lists.append([t for p in parts for t in self.pre_tokens(p)])
            else:
                extra.append(0)
                lists.append(self.pre_tokens(text))
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        fresh = list(set().union(*lists).difference(self.seen))
        for s in range(0, len(fresh), 1 << 16):
            part = fresh[s:s + (1 << 16)]
            self.seen.update(zip(part, self.merges.counts([t.encode() for t in part]).tolist()))
        get = self.seen.__getitem__
        return [sum(map(get, x)) + n for x, n in zip(lists, extra)]


_COUNTERS: dict[int, Counter] = {}


def token_counts(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of ``docs`` (doc_id, text) by the
    vocabulary in ``tokenizer_file``, which only the driver reads."""
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, Counter(shared.value))
        for batch in batches:
            off, _ = utf8(batch.column(1))
            n: list[int] = []
            for i, j in blocks(off):
                n += counter.count([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off), pa.int64()), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
