"""Near-duplicate classes by ProbMinHash, banding and verification.

A text's weighted shingles are its runs of five words (all its words, where it has
fewer) with their counts. Every shingle is a Poisson process whose rate is its
share of the text: its arrivals, drawn from the shingle's hash, hit registers at
random, and a register keeps the shingle that hit it first. Arrivals later than
the latest first hit of a text change nothing, which ends its drawing early. Two
texts agree on a register with a chance of their probability Jaccard similarity.

Registers are banded. In a bucket every text is compared with the bucket's leader,
a different one in each band, so a bucket costs as many pairs as it has texts. This
goes in two rounds: the ``FIRST_BANDS`` bands unite most texts that belong together, and
of all bands only pairs of different classes follow, as a link inside a class adds
nothing. Pairs whose registers agree too seldom are set aside, the others are verified
on their shingles with the exact similarity, and links unite texts to classes. Buckets that
still hold several classes compare the texts outside the largest with more leaders of
it, and where several classes remain, they are searched without leaders: their texts'
rarest shingles, of more than ``1 - threshold`` of the weight in sum, are joined,
which every similar pair must share, and pairs of different classes verified. A pair
comes from the first of its common shingles; each row carries the ``_BEFORE`` rarest
that precede its own, and a pair with a common one among them has come already. Texts
with a rare shingle in common with another class get ``_FINE`` more registers, of
which a bit each is kept, and a pair comes only if its bits agree as often as those of
similar texts do, less 4.5 standard errors. So the choice of leaders loses no link
between classes, a passage that many texts share doesn't make pairs, as its shingles
are not rare, and a group of texts a little below the threshold makes few.

Scale: words and registers are computed where rows are read; equal word sequences
are one class from the start, so large groups of copies are one row in all that
follows. Nothing is collected but counts.

Defined results: texts without words (null, empty, signs only) are classes of
their own; repeated rows are copies; the kept document of a class has its largest
doc_id (null is smallest); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import (
    materialize,
    mix64,
    slices,
    staying_rows,
    text_digest,
    tidy,
    word_hashes,
)
from campaignlake.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 5
FIRST_BANDS = 4
LEADERS = 6
_SLICE_CHARS = 1_000_000
_BROADCAST_ROWS = 500_000
_BEFORE = 16
_FINE = 1024
_FINE_SALT = 0x5851F42D4C957F2D

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD1342543DE82EF95)

_SIGNED = (
    "rid long, doc_id long, digest long, words long, key1 long, key2 long,"
    " registers array<int>, text string"
)


def shingles(texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, count) of the distinct shingles, and words per text."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    starts = ends - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(len(words), _U)
    for k in range(size):
        total *= _BASE
        total[: len(words) - k] += words[k:]
    room = ends[doc] - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
    hashes = mix64(total)
    inside = room >= size
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.array(
        [mix64(np.add.reduce(words[a:b] * _BASE ** np.arange(b - a, dtype=_U), keepdims=True))[0]
         for a, b in zip(starts[short].tolist(), ends[short].tolist(), strict=True)],
        _U,
    )
    hashes = np.concatenate((hashes[inside], extra))
    doc = np.concatenate((doc[inside], short))
    _, first, times = np.unique(
        mix64(hashes + doc.astype(_U) * _STEP), return_index=True, return_counts=True
    )
    return doc[first], hashes[first], times, counts


def registers(doc, hashes, times, texts: int, size: int) -> np.ndarray:
    """(texts, size) register contents; -1 where a text has no shingles."""
    weight = np.bincount(doc, times, texts)
    scale = weight[doc] / times  # one over the shingle's share
    first = np.full(texts * size, np.inf)
    holder = np.full(texts * size, -1, np.int64)
    until = np.full(texts, (np.log(size) + 3) * size)
    until[weight == 0] = 0
    waiting = (doc, hashes, scale, np.zeros(len(doc)), np.zeros(len(doc), _U))
    while len(waiting[0]):
        later = []
        d, h, s, at, turn = waiting
        while len(d):
            lot = mix64(h + (turn + _U(1)) * _STEP)
            chance = ((lot >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
            new = at - np.log(chance) * s
            early = new < until[d]
            late = ~early
            later.append((d[late], h[late], s[late], at[late], turn[late]))
            d, h, s, at, turn, lot = d[early], h[early], s[early], new[early], turn[early], lot[early]
            place = d * size + (mix64(lot) % _U(size)).astype(np.int64)
            np.minimum.at(first, place, at)
            won = first[place] == at
            holder[place[won]] = (h[won] >> _U(33)).astype(np.int64)
            turn = turn + _U(1)
        open_ = ~np.isfinite(first.reshape(texts, size)).all(axis=1) & (weight > 0)
        until = np.where(open_, until * 2, until)
        parts = [np.concatenate(x) for x in zip(*later, strict=True)]
        still = open_[parts[0]]
        waiting = tuple(p[still] for p in parts)
    return holder.reshape(texts, size).astype(np.int32)


def probability_jaccard(a_hash, a_count, b_hash, b_count) -> float:
    """Exact probability Jaccard similarity of two sorted weighted sets."""
    if not len(a_hash) or not len(b_hash):
        return 0.0
    every = np.union1d(a_hash, b_hash)
    a, b = np.zeros(len(every)), np.zeros(len(every))
    a[np.searchsorted(every, a_hash)] = a_count
    b[np.searchsorted(every, b_hash)] = b_count
    both = (a > 0) & (b > 0)
    ratio = np.divide(a, b, out=np.full(len(every), np.inf), where=b > 0)
    order = np.argsort(ratio, kind="stable")
    ranked = ratio[order]
    a_from = np.append(np.cumsum(a[order][::-1])[::-1], 0)
    b_below = np.append(0, np.cumsum(b[order]))
    at = np.searchsorted(ranked, ratio[both])
    return float((1 / (a_from[at] / a[both] + b_below[at] / b[both])).sum())


def _sign(size: int, count: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rid = TaskContext.get().partitionId() << 33
        for frame in slices(frames, "text", _SLICE_CHARS):
            texts = frame["text"].tolist()
            doc, hashes, times, counts = shingles(texts, size)
            content = registers(doc, hashes, times, len(texts), count)
            words, _ = word_hashes(texts)
            place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
            owner = np.repeat(np.arange(len(texts)), counts)
            keys = []
            for salt in (1, 2):
                turned = mix64(words + mix64(place.astype(_U) * _STEP + _U(salt)))
                sums = np.zeros(len(texts), _U)
                np.add.at(sums, owner, turned)
                keys.append(mix64(sums).view(np.int64))
            yield pd.DataFrame(
                {
                    "rid": np.arange(rid, rid + len(texts)),
                    "doc_id": frame["doc_id"].astype("Int64").to_numpy(),
                    "digest": frame["digest"].to_numpy(),
                    "words": counts,
                    "key1": keys[0],
                    "key2": keys[1],
                    "registers": list(content),
                    "text": frame["text"].to_numpy(),
                }
            ).astype({"doc_id": "Int64"})
            rid += len(texts)

    return tidy(run)


def _verify(size: int, threshold: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for frame in frames:
            want: dict[int, str] = {}
            for u, v, a, b in zip(frame["u"], frame["v"], frame["text_u"], frame["text_v"], strict=True):
                want[u], want[v] = a, b
            held = {k: x for k, x in held.items() if k in want}
            new = [k for k in want if k not in held]
            for a in range(0, len(new), 500):
                part = new[a : a + 500]
                doc, hashes, times, _ = shingles([want[k] for k in part], size)
                order = np.lexsort((hashes, doc))
                doc, hashes, times = doc[order], hashes[order], times[order]
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                for i, k in enumerate(part):
                    held[k] = hashes[cuts[i] : cuts[i + 1]], times[cuts[i] : cuts[i + 1]]
            likeness = [
                probability_jaccard(*held[u], *held[v])
                for u, v in zip(frame["u"], frame["v"], strict=True)
            ]
            good = np.array(likeness) >= threshold - 1e-9
            yield frame.loc[good, ["u", "v"]]

    return tidy(run)


def _prefixes(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "text", _SLICE_CHARS):
            doc, hashes, times, _ = shingles(frame["text"].tolist(), size)
            weight = np.bincount(doc, times, len(frame))
            yield pd.DataFrame(
                {
                    "rid": frame["rid"].to_numpy()[doc],
                    "shingle": hashes.view(np.int64),
                    "part": times / weight[doc],
                }
            )

    return tidy(run)


def _fine(size: int):
    """A bit of each of ``_FINE`` registers drawn apart from those of the bands.

    A shingle has a bit of its own in each register, so that bits of registers that
    differ are independent also where few shingles hold them.
    """
    lots = np.arange(_FINE, dtype=_U) * _STEP

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "text", _SLICE_CHARS):
            texts = frame["text"].tolist()
            for a in range(0, len(texts), 200):
                doc, hashes, times, counts = shingles(texts[a : a + 200], size)
                content = registers(doc, mix64(hashes ^ _U(_FINE_SALT)), times, len(counts), _FINE)
                ones = (mix64(content.astype(_U) + lots) & _U(1)).astype(np.uint8)
                bits = np.packbits(ones, axis=1).view(np.int64)
                rids = frame["rid"].to_numpy()[a : a + 200]
                yield pd.DataFrame({"rid": rids, "bits": list(bits)})

    return tidy(run)


class NearDuplicates:
    """Classes of one table; the steps share the signed rows."""

    def __init__(self, docs, size=SHINGLE, threshold=THRESHOLD, bands=BANDS, rows=ROWS):
        self.size, self.threshold, self.bands, self.rows = size, threshold, bands, rows
        # 4.5 standard errors below the threshold, so that an unlucky estimate is no loss
        registers_ = bands * rows
        error = (threshold * (1 - threshold) / registers_) ** 0.5
        self.least = int(registers_ * max(0.0, threshold - 4.5 * error))
        # bits also agree by chance, half of those whose registers differ
        bit = (1 + threshold) / 2
        error = (bit * (1 - bit) / _FINE) ** 0.5
        self.most_apart = int(_FINE * (1 - bit + 4.5 * error)) + 1
        source = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_digest().alias("digest"),
            "text",
        )
        self.signed = materialize(
            source.mapInPandas(_sign(size, registers_), _SIGNED), "signed-documents"
        )
        # one row per word sequence
        self.texts = materialize(
            self.signed.where("words > 0")
            .groupBy("key1", "key2")
            .agg(F.min(F.struct("rid", "registers")).alias("r"))
            .select("key1", "key2", "r.rid", "r.registers"),
            "word-sequences",
        )

    def buckets(self) -> DataFrame:
        """(bucket, rid, first) of every bucket of two texts or more; first: of a first band."""
        keys = [
            F.xxhash64(F.lit(k), F.slice("registers", k * self.rows + 1, self.rows))
            for k in range(self.bands)
        ]
        rows = self.texts.select(F.posexplode(F.array(*keys)).alias("band", "bucket"), "rid")
        rows = rows.select("bucket", "rid", (F.col("band") < FIRST_BANDS).alias("first"))
        shared = rows.groupBy("bucket").count().where("count > 1").select("bucket")
        return materialize(rows.join(shared, "bucket"), "buckets")

    def _text_of(self, rids: DataFrame) -> DataFrame:
        needed = materialize(rids.select("rid").distinct(), "needed")
        if needed.count() <= _BROADCAST_ROWS:
            needed = F.broadcast(needed)
        return self.signed.select("rid", "text").join(needed, "rid", "left_semi")

    def _agree(self, a: str, b: str):
        """Whether two register columns agree often enough."""
        same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
        return F.aggregate(same, F.lit(0), lambda total, x: total + x) >= self.least

    def _near(self, a: str, b: str):
        """Whether two columns of fine bits differ seldom enough."""
        apart = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        return F.aggregate(apart, F.lit(0), lambda total, x: total + x) <= self.most_apart

    def _alike(self, pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) whose registers agree often enough."""
        r = self.texts.select("rid", "registers")
        both = pairs.join(r.toDF("u", "ru"), "u").join(r.toDF("v", "rv"), "v")
        return both.where(self._agree("ru", "rv")).select("u", "v")

    def verify(self, pairs: DataFrame, alike: bool = False) -> DataFrame:
        """The pairs (u, v) whose texts are similar; ``alike``: registers are compared already."""
        pairs = materialize(pairs if alike else self._alike(pairs), "pairs")
        text = materialize(self._text_of(pairs.select(F.explode(F.array("u", "v")).alias("rid"))), "texts")
        both = pairs.join(text.toDF("u", "text_u"), "u").join(text.toDF("v", "text_v"), "v")
        return materialize(
            both.mapInPandas(_verify(self.size, self.threshold), "u long, v long"), "links"
        )

    def leader_pairs(self, placed: DataFrame) -> DataFrame:
        """Texts (bucket, rid, label) with their bucket's leader, where its class is another."""
        lot = F.struct(F.xxhash64("bucket", "rid").alias("lot"), F.col("rid").alias("leader"), "label")
        leaders = placed.groupBy("bucket").agg(F.min(lot).alias("x"))
        leaders = leaders.select("bucket", "x.leader", F.col("x.label").alias("of"))
        pairs = placed.join(leaders, "bucket").where("label <> of")
        return pairs.select(
            F.least("rid", "leader").alias("u"), F.greatest("rid", "leader").alias("v")
        ).distinct()

    def placed(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """(bucket, rid, label): the buckets with the class that each text has by now."""
        placed = buckets.join(labels.toDF("rid", "label"), "rid", "left")
        return materialize(placed.select("bucket", "rid", F.coalesce("label", "rid").alias("label")), "placed")

    def open_buckets(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """(bucket, rid, label, main) of buckets of several classes; main is the largest."""
        placed = self.placed(buckets, labels)
        several = (
            placed.groupBy("bucket", "label")
            .count()
            .groupBy("bucket")
            .agg(F.max(F.struct("count", "label")).alias("x"), F.count("*").alias("classes"))
            .where("classes > 1")
            .select("bucket", F.col("x.label").alias("main"))
        )
        return materialize(placed.join(several, "bucket"), "open-buckets")

    def stray_pairs(self, open_buckets: DataFrame) -> DataFrame:
        """Texts outside a bucket's largest class, with ``LEADERS`` texts of that class."""
        lots = [
            F.min(F.struct(F.xxhash64("bucket", "rid", F.lit(k)), "rid")).alias(f"x{k}")
            for k in range(LEADERS)
        ]
        leaders = open_buckets.where("label = main").groupBy("bucket").agg(*lots)
        leaders = leaders.select(
            "bucket", F.explode(F.array(*(F.col(f"x{k}.rid") for k in range(LEADERS)))).alias("v")
        ).distinct()
        strays = open_buckets.where("label <> main").select("bucket", F.col("rid").alias("u"))
        pairs = strays.join(leaders, "bucket")
        return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    def rare_pairs(self, open_texts: DataFrame) -> DataFrame:
        """Pairs of different classes that share a shingle of their rarest and seem alike."""
        open_texts = materialize(open_texts, "open-texts")
        source = self._text_of(open_texts)
        parts = materialize(
            source.mapInPandas(_prefixes(self.size), "rid long, shingle long, part double"),
            "open-shingles",
        )
        often = parts.groupBy("shingle").count().where("count > 1")
        # shingles of one text alone come first in every order: their weight is summed
        alone = parts.join(often, "shingle", "left_anti").groupBy("rid").agg(F.sum("part").alias("alone"))
        ranked = materialize(
            parts.join(often, "shingle").join(alone, "rid", "left"), "shared-shingles"
        )
        prefix = materialize(
            ranked.where(F.coalesce("alone", F.lit(0.0)) <= 1 - self.threshold + 1e-9)
            .repartition("rid")
            .sortWithinPartitions("rid", "count", "shingle")
            .mapInPandas(
                _rarest(1 - self.threshold), "rid long, shingle long, before array<long>"
            )
            .join(open_texts, "rid"),
            "prefixes",
        )
        largest = (
            prefix.groupBy("shingle", "label")
            .count()
            .groupBy("shingle")
            .agg(F.max(F.struct("count", "label")).alias("x"), F.count("*").alias("classes"))
            .where("classes > 1")
            .select("shingle", F.col("x.label").alias("main"))
        )
        member = materialize(prefix.join(largest, "shingle"), "members")
        bits = self._text_of(member).mapInPandas(_fine(self.size), "rid long, bits array<long>")
        fine = materialize(bits, "bits")
        member = member.join(fine, "rid")
        stray = member.where("label <> main").select(
            "shingle", F.col("rid").alias("u"), F.col("label").alias("lu"),
            F.col("bits").alias("au"), F.col("before").alias("bu"),
        )
        other = member.select(
            F.col("shingle").alias("same"), F.col("rid").alias("v"), F.col("label").alias("lv"),
            F.col("bits").alias("av"), F.col("before").alias("bv"), "main",
        )
        alike = (F.col("shingle") == F.col("same")) & F.expr("lu <> lv and (lv = main or u < v)")
        first = ~F.arrays_overlap("bu", "bv")
        pairs = stray.join(other, alike & first & self._near("au", "av"))
        return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    def labels(self) -> DataFrame:
        """(node, label) of the texts that have a link."""
        buckets = self.buckets()
        apart = buckets.where("first").select("bucket", "rid", F.col("rid").alias("label"))
        labels = components(self.verify(self.leader_pairs(apart)))
        links = self.verify(self.leader_pairs(self.placed(buckets, labels)))
        if not links.isEmpty():  # labels stand for the links they come from
            labels = components(labels.toDF("u", "v").union(links))
        open_ = self.open_buckets(buckets, labels)
        if open_.isEmpty():
            return labels
        links = labels.toDF("u", "v").union(self.verify(self.stray_pairs(open_)))
        labels = materialize(components(links), "labels")
        open_ = self.open_buckets(open_.select("bucket", "rid"), labels)
        more = self.verify(self.rare_pairs(open_.select("rid", "label").distinct()), alike=True)
        return labels if more.isEmpty() else components(labels.toDF("u", "v").union(more))

    def classes(self) -> DataFrame:
        """Per row: doc_id, class_id, class_size, kept, and its rid and text digest."""
        labels = self.labels().toDF("rid", "label")
        named = self.texts.select("key1", "key2", "rid").join(labels, "rid", "left")
        named = named.select("key1", "key2", F.coalesce("label", "rid").alias("label"))
        wordless = self.signed.where("words = 0").select("rid", "doc_id", "digest", "rid")
        placed = (
            self.signed.where("words > 0")
            .select("rid", "doc_id", "digest", "key1", "key2")
            .join(named, ["key1", "key2"])
            .select("rid", "doc_id", "digest", "label")
            .union(wordless)
        )
        placed = materialize(placed, "labelled")
        of = placed.groupBy("label").agg(
            F.count("*").alias("class_size"),
            F.max(F.struct("doc_id", "rid")).alias("best"),
        )
        of = of.select(
            "label",
            "class_size",
            F.col("best.doc_id").alias("class_id"),
            F.col("best.rid").alias("best_rid"),
        )
        return placed.join(of, "label").select(
            "doc_id",
            "class_id",
            "class_size",
            (F.col("rid") == F.col("best_rid")).alias("kept"),
            "rid",
            "digest",
        )


def _rarest(share: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, spent, lead = None, 0.0, []
        for frame in frames:
            keep, before = [], []
            for rid, shingle, part, alone in zip(
                frame["rid"].tolist(),
                frame["shingle"].tolist(),
                frame["part"].tolist(),
                frame["alone"].tolist(),
                strict=True,
            ):
                if rid != last:
                    last, spent, lead = rid, 0.0 if alone != alone or alone is None else alone, []
                keep.append(spent <= share + 1e-9)
                if keep[-1]:
                    before.append(lead)
                    lead = [*lead, shingle] if len(lead) < _BEFORE else lead
                spent += part
            if before:
                yield frame.loc[keep, ["rid", "shingle"]].assign(before=before)

    return tidy(run)


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, class_id, class_size, kept."""
    found = NearDuplicates(docs, **options).classes()
    return found.select("doc_id", "class_id", "class_size", "kept")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    found = materialize(NearDuplicates(docs, **options).classes(), "classes")
    return staying_rows(docs, found, text_digest())
