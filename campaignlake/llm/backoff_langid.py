"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. A word that the model
doesn't know is scored by its character n-grams, the longest that it shares with
the model: five characters, else four, and so on to one. A text's languages are
weighed by the sum over its words. ``recognised`` says whether any word of a text was
known or shared an n-gram with the model; it depends on no number of languages.

Fit: word and n-gram counts of at most about ``SAMPLE`` training texts of each
language (drawn by a hash of doc_id and text; the bound of the model's size). Words seen
once are left to the n-grams. Scale: the sample is counted in Spark and collected;
every text is scored where it is read, with a table of bounded size for the words
of a task. Language, source and doc_id are no inputs of a score.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a
text with letters of which the model knows nothing gets the first language with
the share of a guess and is not recognised; without training rows every text is ``und``; repeated rows
score alike; an empty table has no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import keep_in_worker, slices, text_digest, tidy

SAMPLE = 500
LONGEST = 5
_KNOWN_WORDS = 600_000
_SLICE_CHARS = 2_000_000
UNKNOWN = "und"

LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def grams(word: str, n: int) -> list[str]:
    """N-grams with the word's edges marked; single characters are those of the word."""
    if n == 1:
        return list(word)
    edged = f"<{word}>"
    return [edged[k : k + n] for k in range(len(edged) - n + 1)] or [edged]


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in slices(frames, "text", _SLICE_CHARS):
        rows = []
        for lang, part in frame.groupby("lang"):
            words = Counter()
            for text in part["text"]:
                words.update(LETTERS.findall(text.lower()))
            rows += ((lang, 0, w, c) for w, c in words.items())
            for n in range(1, LONGEST + 1):
                found: Counter = Counter()
                for w, c in words.items():
                    for g in grams(w, n):
                        found[g] += c
                rows += ((lang, n, g, c) for g, c in found.items())
        yield pd.DataFrame(rows, columns=["lang", "n", "gram", "times"])


class BackoffModel:
    """Log frequencies of words (n = 0) and n-grams, a row for each and a column a language."""

    def __init__(self, counts: pd.DataFrame, smooth: float = 0.5):
        self.languages = sorted(counts["lang"].unique())
        self.place: dict[int, dict[str, int]] = {}
        self.rows: dict[int, np.ndarray] = {}
        for n, part in counts.groupby("n"):
            at, names = pd.factorize(part["gram"])
            times = np.zeros((len(names), len(self.languages)))
            np.add.at(times, (at, np.searchsorted(self.languages, part["lang"])), part["times"])
            below = np.log(times.sum(axis=0) + smooth * len(names))
            self.place[int(n)] = {gram: k for k, gram in enumerate(names)}
            self.rows[int(n)] = (np.log(times + smooth) - below).astype(np.float32)

    def evidence(self, word: str) -> tuple[np.ndarray, bool]:
        """Differences from the mean over the languages, and whether the model met the word or a part."""
        for n in (0, *range(LONGEST, 0, -1)):
            place = self.place.get(n, {})
            known = [place[g] for g in ([word] if n == 0 else grams(word, n)) if g in place]
            if known:
                row = self.rows[n][known].mean(axis=0)
                return row - row.mean(), True
        return np.zeros(len(self.languages), np.float32), False

    def word(self, word: str) -> np.ndarray:
        return self.evidence(word)[0]

    def __call__(self, texts: list[str | None], table: WordTable) -> list[tuple[str, float, bool]]:
        words = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        rows = table.rows([w for ws in words for w in ws])
        out = []
        for k, end in enumerate(np.cumsum(counts).tolist()):
            n = int(counts[k])
            if not n or not self.languages:
                out.append((UNKNOWN, 0.0, False))
                continue
            *total, recognised = rows[end - n : end].sum(axis=0, dtype=np.float64)
            total = np.array(total)
            total *= min(n, 25) / n  # words of a text are no independent witnesses
            share = np.exp(total - total.max())
            share /= share.sum()
            best = int(np.argmax(share))
            out.append((self.languages[best], float(share[best]), recognised > 0))
        return out


class WordTable:
    """Evidence of the words met so far, of bounded size; the last column is 1 if recognised."""

    def __init__(self, model: BackoffModel):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.found = np.zeros((1 << 16, len(self.model.languages) + 1), np.float32)

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.place) > _KNOWN_WORDS:
            self.reset()
        for word in set(words).difference(self.place):
            k = len(self.place)
            if k == len(self.found):
                self.found = np.concatenate((self.found, np.zeros_like(self.found)))
            self.found[k, :-1], self.found[k, -1] = self.model.evidence(word)
            self.place[word] = k
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return self.found[at]


def fit(docs: DataFrame, sample: int = SAMPLE) -> BackoffModel:
    """A model of the training rows of ``docs`` (doc_id, text, lang)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")
    ).where(
        F.col("text").isNotNull()
        & F.col("lang").isNotNull()
        & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    lot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chance = F.lit(0.0)
    for lang, n in sizes.items():
        chance = F.when(F.col("lang") == lang, F.lit(sample / n)).otherwise(chance)
    counted = (
        rows.where(lot < chance)
        .select("lang", "text")
        .mapInPandas(tidy(_count), "lang string, n int, gram string, times long")
        .groupBy("lang", "n", "gram")
        .agg(F.sum("times").alias("times"))
    )
    # a word seen once in all is no known word
    often = counted.where("n = 0").groupBy("gram").agg(F.sum("times").alias("all")).where("all > 1")
    words = counted.where("n = 0").join(often.select("gram"), "gram", "left_semi")
    kept = words.select("lang", "n", "gram", "times").union(
        counted.where("n > 0").select("lang", "n", "gram", "times")
    )
    return BackoffModel(kept.toPandas())


def _predict(model, key: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = keep_in_worker(key, lambda: WordTable(model.value))
        for frame in slices(frames, "text", _SLICE_CHARS):
            found = table.model(frame["text"].tolist(), table)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64").to_numpy(),
                    "digest": frame["digest"].to_numpy(),
                    "lang_pred": [lang for lang, _, _ in found],
                    "score": [score for _, score, _ in found],
                    "recognised": [bool(met) for _, _, met in found],
                }
            ).astype({"doc_id": "Int64"})

    return tidy(run, key)


def identify(docs: DataFrame, model: BackoffModel) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, recognised, and a digest of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"), "text"
    )
    found = source.mapInPandas(
        _predict(shared, f"model-{id(model)}-{shared._jbroadcast.id()}"),
        "doc_id long, digest long, lang_pred string, score double, recognised boolean",
    )
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return found.select("doc_id", out, "lang_pred", "score", "recognised", "digest")
