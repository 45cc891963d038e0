"""Benchmark decontamination by winnowing.

Both sides are read as words. Every ``GRAM`` consecutive words are hashed, and
of every ``SPAN - GRAM + 1`` neighbouring hashes the smallest is kept as a
fingerprint. Whatever ``SPAN`` words a document and an item share, they share the
fingerprint chosen inside it. A document's fingerprints are looked up among the
benchmark's, and each hit is extended: the windows of ``SPAN`` words around it are
compared word by word with the items' windows. Items of fewer words are one
window; their fingerprint is the hash of all their words.

Scale: documents are scanned once per benchmark block and never shuffled. The
benchmark is cut into blocks of at most about ``BLOCK_WORDS`` words, so what a
task holds is bounded however large the benchmark is; with several blocks the
hit intervals of a document are united afterwards. Work per document is linear in
its words: a hit is checked against the table of windows, not against each item.

Defined results: null or empty text has no words and no hits; an item without
words never occurs; equal items all count; items repeating an id count once; an
item with a null id marks words but is not listed; the digest of no items is that
of the empty string; every input row gives one row.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import (
    materialize,
    mix64,
    slices,
    text_digest,
    tidy,
    without_rows,
    word_bytes,
)

SPAN = 10
GRAM = 5
BLOCK_WORDS = 4_000_000
_SLICE_CHARS = 4_000_000
_UNSEEN = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = np.uint64(0x9E3779B97F4A7C15)

_HITS = "row long, doc_id long, digest long, n_words long, starts array<long>, ends array<long>, items array<string>"


def gram_hashes(ids: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` consecutive ids; the largest value where one is 0."""
    n = len(ids) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for k in range(gram):
        part = ids[k : k + n]
        total = total * _BASE + part.astype(np.uint64)
        known &= part != 0
    hashes = mix64(total)
    hashes[~known] = _UNSEEN
    return hashes


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the fingerprints: the rightmost smallest hash of each window."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for k in range(1, window):
        other = hashes[k : k + n]
        less = other <= best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    at = np.unique(at[best != _UNSEEN])
    return at


class BenchmarkIndex:
    """Words, fingerprints and windows of one block of the benchmark."""

    def __init__(self, items: list[tuple[int | None, str | None]], span: int, gram: int):
        self.span, self.gram = span, gram
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, list[int]]] = defaultdict(dict)
        self.item_ids: list[str | None] = []
        prints: dict[int, set[int]] = defaultdict(set)
        for item_id, text in items:
            words = word_bytes(text)
            if not words:
                continue
            ids = np.array(
                [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32
            )
            size = min(span, len(ids))
            hashes = gram_hashes(ids, gram if size == span else size)
            at = winnow(hashes, span - gram + 1) if size == span else np.array([0])
            prints[size].update(hashes[at].tolist())
            index = len(self.item_ids)
            self.item_ids.append(None if item_id is None else str(item_id))
            for a in range(len(ids) - size + 1):
                owners = self.windows[size].setdefault(ids[a : a + size].tobytes(), [])
                if not owners or owners[-1] != index:
                    owners.append(index)
        self.prints = {size: np.array(sorted(v), np.uint64) for size, v in prints.items()}

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(start, size, items) of every window of an item that occurs in ``ids``.

        Zeros are words that no item has; they also separate documents.
        """
        for size, known in self.prints.items():
            long = size == self.span
            hashes = gram_hashes(ids, self.gram if long else size)
            at = winnow(hashes, self.span - self.gram + 1) if long else np.arange(len(hashes))
            place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
            seeds = at[known[place] == hashes[at]]
            reach = size - self.gram if long else 0
            starts = np.unique(
                np.concatenate([seeds - back for back in range(reach + 1)] or [seeds])
            )
            table = self.windows[size]
            for a in starts[(starts >= 0) & (starts + size <= len(ids))].tolist():
                owners = table.get(ids[a : a + size].tobytes())
                if owners:
                    yield a, size, owners


def _merge(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _scan(index):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block: BenchmarkIndex = index.value
        get = block.vocabulary.get
        for frame in slices(frames, "text", _SLICE_CHARS):
            words = [word_bytes(t) for t in frame["text"]]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            first = np.cumsum(sizes + 1) - (sizes + 1)
            ids = np.zeros(int((sizes + 1).sum()), np.int32)
            for a, n, ws in zip(first.tolist(), sizes.tolist(), words, strict=True):
                ids[a : a + n] = [get(w, 0) for w in ws]
            spans: dict[int, list] = defaultdict(list)
            items: dict[int, set] = defaultdict(set)
            for a, size, owners in block.hits(ids):
                doc = int(np.searchsorted(first, a, "right")) - 1
                spans[doc].append((a - int(first[doc]), a - int(first[doc]) + size))
                items[doc].update(owners)
            merged = [_merge(spans[k]) if k in spans else ([], []) for k in range(len(words))]
            names = [
                sorted({x for i in items[k] if (x := block.item_ids[i]) is not None})
                if k in items
                else []
                for k in range(len(words))
            ]
            yield pd.DataFrame(
                {
                    "row": frame["row"],
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "digest": frame["digest"],
                    "n_words": sizes,
                    "starts": [m[0] for m in merged],
                    "ends": [m[1] for m in merged],
                    "items": names,
                },
                index=frame.index,
            )

    return tidy(run)


def _digest(starts: pd.Series, ends: pd.Series, items: pd.Series) -> pd.DataFrame:
    out = []
    for a, b, names in zip(starts, ends, items, strict=True):
        ids = sorted({*names})
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        spans = _merge(list(zip(a, b, strict=True)))
        out.append((sum(y - x for x, y in zip(*spans, strict=True)), len(ids), digest))
    return pd.DataFrame(out, columns=["n_hit", "n_items", "items_sha256"])


def hit_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row: doc_id, text digest, n_words, word intervals [starts, ends) of items, items."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = items.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-words // (4 * block_words)))
    source = docs.select(
        F.lit(0).cast("long").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest().alias("digest"),
        "text",
    )
    if blocks > 1:  # rows are told apart when their hits are united
        source = materialize(
            source.withColumn("row", F.monotonically_increasing_id()), "numbered-documents"
        )
    parts = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = [(r["item_id"], r["text"]) for r in block.toLocalIterator()]
        index = spark.sparkContext.broadcast(BenchmarkIndex(rows, span, gram))
        part = source.mapInPandas(_scan(index), _HITS)
        parts = part if parts is None else parts.unionByName(part)
    if blocks > 1:
        parts = parts.groupBy("row", "doc_id", "digest", "n_words").agg(
            *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items"))
        )
    return parts.drop("row")


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, **options
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    digest = F.pandas_udf(_digest, "n_hit long, n_items long, items_sha256 string")
    return (
        hit_spans(docs, benchmark, span, gram, **options)
        .withColumn("d", digest("starts", "ends", "items"))
        .select("doc_id", "n_words", "d.*", (F.col("d.n_hit") > 0).alias("contaminated"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all their columns."""
    hits = hit_spans(docs, benchmark, **options).where(F.size("starts") > 0)
    return without_rows(docs, hits)
