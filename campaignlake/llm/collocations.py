"""Collocations: exact scores of frequent phrases, found by mergeable summaries.

First pass. Texts are cut into pieces and words, and every phrase of 2 to
``LONGEST`` words of a piece is dealt by its hash to one of many hash partitions. For
each partition its occurrences are merged into a Misra-Gries summary whose capacity
exceeds the partition's mass divided by ``least``: what a merge subtracts from all
counters is then less than ``least`` in sum, so every phrase that occurs ``least``
times or more has a counter left. A phrase is named by its partition and 32 bits in it;
phrases that share a name share a counter, which can only add survivors.

Second pass. The survivors' names fill one bitmap per hash partition. Texts are read
again; a phrase whose bit is set, and every word, is counted exactly, by its words.
Rare phrases that a bitmap lets through fall to the exact count. Scores follow by
joins of the counted phrases with their parts.

Scale: a task aggregates a slice of text before it sends anything, so a frequent phrase
is one entry per slice. The number of hash partitions follows the size of the corpus
and bounds what one merge holds (about ``PARTITION_CHARS`` characters' phrases). The
bitmaps together have ``FILTER_BITS`` at most, whatever the corpus: only this is
broadcast, and where it gets too small for the corpus more rare phrases reach the exact
count, with the same result. The first places of a language are taken in rounds over
salted parts of it, so no task holds a language.

Defined results: null and empty texts have no words; a null language is ``und``; rows
with equal or null doc_ids count like others; ties are broken by the count, then by the
phrase's bytes; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignlake.llm.common import materialize, mix64, slices, tidy, utf8

LEAST = 10
SUBSUMED_PERCENT = 50
TOP = 2000
LONGEST = 3
UNKNOWN = "und"
PARTITION_CHARS = 8_000_000
FILTER_BITS = 1 << 28
_BITS_EACH = 32
_FEWEST_BITS = 1 << 10
_SLICE_CHARS = 4_000_000
_SALTS = (256, 32, 4, 1)

# A-Z to a-z, the marks that end a piece to line feeds, tabs to blanks
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TURNS = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


_LETTERS_AT_ONCE = 64


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: the polynomial of a word's bytes, mixed with its length.

    Goes letter by letter over all words, so that it holds numbers per word, not per byte.
    """
    sums, alive, power = np.zeros(len(starts), np.uint64), np.arange(len(starts)), np.uint64(1)
    for k in range(min(_LETTERS_AT_ONCE, int(lengths.max()))):
        alive = alive[lengths[alive] > k]
        sums[alive] += data[starts[alive] + k] * power
        power *= _BASE
    for k in np.flatnonzero(lengths > _LETTERS_AT_ONCE).tolist():  # the few long ones
        rest = data[starts[k] + _LETTERS_AT_ONCE : starts[k] + lengths[k]].astype(np.uint64)
        rest[0] *= power
        sums[k] += (rest * np.cumprod(np.full(len(rest), _BASE, np.uint64))).sum(dtype=np.uint64)
    return mix64(sums + lengths.astype(np.uint64) * _TURNS[0])


class Words:
    """The words of texts of one language, with their pieces, as arrays."""

    def __init__(self, texts: list[str | None]):
        joined = b"\n".join(utf8(t).translate(_FOLDED) for t in texts) + b"\n"
        self.bytes, data = joined, np.frombuffer(joined, np.uint8)
        inside = (data != 32) & (data != 10)
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts, self.ends = edges[0::2], edges[1::2]
        if not len(self.starts):
            self.piece = self.code = self.hashes = np.zeros(0, np.int64)
            return
        self.piece = np.cumsum(data == 10, dtype=np.int32)[self.starts]
        hashed = _hashes(data, self.starts, self.ends - self.starts)
        # codes number the distinct words of the slice
        self.hashes, self.sample, self.code = np.unique(hashed, return_index=True, return_inverse=True)

    def word(self, code: int) -> bytes:
        k = self.sample[code]
        return self.bytes[self.starts[k] : self.ends[k]]

    def phrases(self, size: int) -> np.ndarray:
        """Codes of the words of every phrase of ``size`` words: a row per occurrence."""
        last = len(self.code) - size + 1
        if last <= 0:
            return np.zeros((0, size), np.int64)
        whole = np.flatnonzero(self.piece[:last] == self.piece[size - 1 :])
        return np.stack([self.code[whole + k] for k in range(size)], axis=1)

    def counted(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases of ``size`` words, and how often each occurs."""
        rows = self.phrases(size)
        base = max(1, len(self.hashes))
        if base**size >= 1 << 63:  # too many words for one number each
            return np.unique(rows, axis=0, return_counts=True) if len(rows) else (rows, np.zeros(0, np.int64))
        number = np.zeros(len(rows), np.int64)
        for k in range(size):
            number = number * base + rows[:, k]
        number, times = np.unique(number, return_counts=True)
        back = np.empty((len(number), size), np.int64)
        for k in range(size - 1, -1, -1):
            number, back[:, k] = np.divmod(number, base)
        return back, times

    def names(self, phrases: np.ndarray, lang: str) -> np.ndarray:
        """64-bit names of phrases (rows of word codes) in a language."""
        seed = np.uint64(int.from_bytes(utf8(lang)[:8].ljust(8, b"\0"), "little")) + np.uint64(len(lang))
        total = np.full(len(phrases), mix64(np.array([seed + np.uint64(phrases.shape[1])]))[0])
        for k in range(phrases.shape[1]):
            total = mix64(total * _BASE + self.hashes[phrases[:, k]] * _TURNS[k % 3])
        return total


def _parted(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition of each name, and 32 bits within it."""
    return ((names >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), names.astype(np.uint32)


def _by_language(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Words]]:
    for frame in slices(frames, "text", _SLICE_CHARS):
        for lang, texts in frame.groupby("lang", sort=False)["text"]:
            words = Words(texts.tolist())
            if len(words.code):
                yield lang, words


def _summaries(parts: int):
    """Entries of a slice for each hash partition: names in order, and their counts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, words in _by_language(frames):
            names, times = [], []
            for size in range(2, LONGEST + 1):
                phrases, counts = words.counted(size)
                names.append(words.names(phrases, lang))
                times.append(counts)
            part, low = _parted(np.concatenate(names), parts)
            if not len(part):
                continue
            times = np.minimum(np.concatenate(times), 0xFFFFFFFF).astype(np.uint32)
            order = np.argsort(part, kind="stable")
            part, low, times = part[order], low[order], times[order]
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            rows = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
                once = times[a:b] == 1  # most occur once; these need no count
                rows.append(
                    (
                        int(part[a]),
                        int(times[a:b].sum(dtype=np.int64)),
                        low[a:b][once].tobytes(),
                        low[a:b][~once].tobytes(),
                        times[a:b][~once].tobytes(),
                    )
                )
            yield pd.DataFrame(rows, columns=["part", "mass", "once", "often", "times"])

    return tidy(run)


class Summary:
    """A Misra-Gries summary over 32-bit names that is merged with sets of counts."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.names, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.subtracted = 0

    def merge(self, names: np.ndarray, counts: np.ndarray) -> None:
        joined, at = np.unique(np.concatenate((self.names, names)), return_inverse=True)
        total = np.bincount(at, np.concatenate((self.counts, counts)), len(joined)).astype(np.int64)
        if len(joined) > self.capacity:
            # all lose the count of the first that finds no counter
            spare = len(total) - self.capacity - 1
            cut = int(np.partition(total, spare)[spare])
            self.subtracted += cut
            left = total > cut
            joined, total = joined[left], total[left] - cut
        self.names, self.counts = joined, total


def capacity_for(mass: int, least: int) -> int:
    """Counters that leave each name of ``least`` occurrences in ``mass`` one."""
    return mass // least + 1


_MERGED_AT_ONCE = 1 << 20


def _survivors(least: int, bits: int):
    """The bitmap of the names that survive in a hash partition."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        summary = Summary(capacity_for(int(frame["mass"].sum()), least))
        names, counts, held = [], [], 0

        def take() -> None:
            nonlocal held
            if names:
                summary.merge(np.concatenate(names), np.concatenate(counts))
            names.clear(), counts.clear()
            held = 0

        for once, often, times in zip(frame["once"], frame["often"], frame["times"], strict=True):
            for low, n in ((once, None), (often, np.frombuffer(times, np.uint32))):
                name = np.frombuffer(low, np.uint32)
                names.append(name)
                counts.append(np.ones(len(name), np.int64) if n is None else n.astype(np.int64))
                held += len(name)
            if held >= _MERGED_AT_ONCE:
                take()
        take()
        if bits < _FEWEST_BITS:
            return pd.DataFrame({"part": [frame["part"].iloc[0]], "bitmap": [b""]})
        size = _FEWEST_BITS
        while size < min(bits, _BITS_EACH * len(summary.names)):
            size *= 2
        set_bits = np.zeros(size, np.uint8)
        set_bits[summary.names & np.uint32(size - 1)] = 1
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "bitmap": [np.packbits(set_bits).tobytes()]})

    return run


class Bitmaps:
    """The survivors' bitmaps of all hash partitions, one after another."""

    def __init__(self, parts: int, rows: list[tuple[int, bytes]]):
        self.parts = parts
        self.size = np.zeros(parts, np.int64)  # bytes; 0: nothing survives
        self.always = np.zeros(parts, bool)
        data, self.start = [], np.zeros(parts, np.int64)
        at = 0
        for part, bitmap in sorted(rows):
            self.always[part] = not bitmap
            self.size[part], self.start[part] = len(bitmap), at
            data.append(bitmap)
            at += len(bitmap)
        self.data = np.frombuffer(b"".join(data), np.uint8)

    def holds(self, names: np.ndarray) -> np.ndarray:
        """Whether each name may have survived."""
        part, low = _parted(names, self.parts)
        size = self.size[part]
        found = self.always[part]
        at = np.flatnonzero(size)
        bit = low[at].astype(np.int64) & (8 * size[at] - 1)
        found[at] = self.data[self.start[part[at]] + (bit >> 3)] >> (7 - (bit & 7)).astype(np.uint8) & 1
        return found


def _count(shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmaps = shared.value
        for lang, words in _by_language(frames):
            spelled = [words.word(c) for c in range(len(words.hashes))]
            for size in range(1, LONGEST + 1):
                phrases, times = words.counted(size)
                if size > 1:
                    kept = np.flatnonzero(bitmaps.holds(words.names(phrases, lang)))
                    phrases, times = phrases[kept], times[kept]
                for a in range(0, len(phrases), 50_000):
                    rows = phrases[a : a + 50_000].tolist()
                    said = [b" ".join([spelled[c] for c in row]).decode() for row in rows]
                    yield pd.DataFrame(
                        {"lang": lang, "size": size, "phrase": said, "times": times[a : a + 50_000]}
                    )

    return tidy(run)


def phrase_counts(
    docs: DataFrame,
    least: int = LEAST,
    partition_chars: int = PARTITION_CHARS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """lang, size, phrase, f: every word, and every longer phrase with f >= ``least``."""
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + chars // partition_chars
    entries = source.mapInPandas(
        _summaries(parts), "part long, mass long, once binary, often binary, times binary"
    )
    bitmaps = entries.groupBy("part").applyInPandas(
        _survivors(least, filter_bits // parts), "part long, bitmap binary"
    )
    shared = spark.sparkContext.broadcast(Bitmaps(parts, [(r[0], bytes(r[1])) for r in bitmaps.collect()]))
    counted = (
        source.mapInPandas(_count(shared), "lang string, size int, phrase string, times long")
        .groupBy("lang", "size", "phrase")
        .agg(F.sum("times").alias("f"))
        .where((F.col("size") == 1) | (F.col("f") >= least))
    )
    counts = materialize(counted, "phrase-counts")
    shared.unpersist()
    return counts


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    over = wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over, wide[1] * wide[2])


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score: candidates with their lowest-scoring cut."""
    words = F.split("phrase", " ")
    candidates = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    cuts = candidates.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), words.alias("words")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    known = counts.select("lang", "phrase", "f")
    cuts = cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"])
    cuts = cuts.join(known.toDF("lang", "right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    best = F.min(F.struct("score", "k", "a", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase").agg(best).select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")


def without_subsumed(counts: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer one with ``percent`` of their count contains."""
    longer = counts.where("size > 2").select(
        "lang", "f", "size", F.split("phrase", " ").alias("words")
    )
    spans = F.expr(
        "flatten(transform(sequence(2, size - 1), n ->"
        " transform(sequence(1, size - n + 1), p -> array_join(slice(words, p, n), ' '))))"
    )
    inside = longer.select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    joined = found.join(most, ["lang", "phrase"], "left")
    kept = F.coalesce(F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a"), F.lit(True))
    return joined.where(kept).drop("longer")


def first_places(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, ranked; in rounds over ever fewer parts."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS[0]))
    found = found.withColumn("__salt", salt)
    for parts in _SALTS:
        found = found.withColumn("__salt", F.col("__salt") % parts)
        window = Window.partitionBy("lang", "__salt").orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(window).cast("long")).where(F.col("rank") <= top)
    return found.drop("__salt")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    subsumed_percent: int = SUBSUMED_PERCENT,
    top: int = TOP,
    **sizes_of_work: int,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    counts = phrase_counts(docs, least, **sizes_of_work)
    sizes = counts.where("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    kept = without_subsumed(counts, scored(counts), subsumed_percent)
    ranked = first_places(kept, top).join(sizes, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
