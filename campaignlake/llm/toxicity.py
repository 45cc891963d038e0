"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

Lexicon: words and stems (word beginnings) that occur in texts labelled toxic far
more often than in others, over texts of many different lengths (copies of one text
make no word toxic). The entries form a trie. A word of a text is matched by walking
the trie with the states of the word's Levenshtein automaton, so that a misspelled
term is found too: entries of 5 to 8 letters allow one edit, longer ones two. A stem
matches a word's beginning. Digits and signs that stand for letters are read as such.

Each hit is weighed by its window of ``WINDOW`` words on both sides: inside quotation
marks, or after words of reporting, it is a quotation, else abuse. Counts of exact and
misspelled hits in both contexts, and their density, feed a logistic regression.

Fit: at most about ``SAMPLE`` labelled training rows (a documented bound; drawn by a
hash of doc_id). All texts are scored whole, where they are read.

Defined results: null and empty texts score as texts without hits; without labelled
rows of both kinds every score is 0; rows that repeat a doc_id score by their own text;
labels that repeat a doc_id count as toxic if any of them does; an empty table has no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.backoff_langid import held_out
from campaignlake.llm.common import keep_in_worker, slices

SAMPLE = 20_000
WINDOW = 6
THRESHOLD = 0.3
LEAST_G, LEAST_LENGTHS, LEAST_PURITY = 20.0, 4, 0.8
_STEMS = range(4, 8)
_KNOWN_WORDS = 1_000_000
_SLICE_CHARS = 2_000_000

WORD = re.compile(r"[^\W_](?:[\w@$]*[^\W_])?")
_LETTER_FOR = str.maketrans("013457@$", "oieastas")
_SIGNS = re.compile(r"[\d@$]")
_QUOTES = re.compile("[\"“”„«»‟‹›]")
#: Words of reporting in the languages of the corpus, fixed values.
_REPORT = frozenset(
    "said says quote quoted quotes called wrote word term dit cité mot sagte zitat wort dijo palabra cita".split()
)


def edits(entry: str) -> int:
    """Edits that an entry allows; a stem (``*``) of six letters or more allows one."""
    if entry.endswith("*"):
        return int(len(entry) > 6)
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


@dataclass
class Node:
    children: dict[str, Node] = field(default_factory=dict)
    word: int = -1  # edits that a word ending here allows
    stem: int = -1
    most: int = 0  # the most edits that an entry below allows


class Lexicon:
    """Trie of entries; stems end with ``*``."""

    def __init__(self, entries: list[str]):
        self.entries = sorted(entries)
        self.root = Node()
        self.starts: set[str] = set()
        self.shapes: set[tuple[str, int]] = set()
        self.tails: set[tuple[str, int]] = set()
        middles = []
        for entry in self.entries:
            text, node, k = entry.rstrip("*"), self.root, edits(entry)
            for letter in text:
                node = node.children.setdefault(letter, Node())
                node.most = max(node.most, k)
            if entry.endswith("*"):
                node.stem = k
            else:
                node.word = k
            # what an edited form keeps: one of its beginning, its end and (two edits) its middle
            if entry.endswith("*"):
                self.starts.add(text[: len(text) // 2] if k else text)
                if k:
                    middles.append(text[len(text) // 2 :])
                continue
            for n in range(len(text) - k, len(text) + k + 1):
                self.shapes.add((text[:2], n))
                self.tails.add((text[-3:], n))
            if k > 1:
                middles.append(text[2:-3])
        self.longest_start = max(map(len, self.starts), default=0)
        self.middle = re.compile("|".join(map(re.escape, sorted({*middles} - {""})))) if middles else None

    def may_match(self, word: str) -> bool:
        if (word[:2], len(word)) in self.shapes or (word[-3:], len(word)) in self.tails:
            return True
        if any(word[:k] in self.starts for k in range(2, self.longest_start + 1)):
            return True
        return bool(self.middle and self.middle.search(word))

    def distance(self, word: str) -> int | None:
        """Edits to the nearest entry that may have so many; None where there is none.

        The word's Levenshtein automaton runs as bit sets: bit i of ``states[e]`` stands
        for i letters of the word read with e edits. Branches without a state are left.
        """
        size = len(word)
        full, end = (2 << size) - 1, 1 << size
        at: dict[str, int] = {}
        for k, letter in enumerate(word):
            at[letter] = at.get(letter, 0) | 2 << k
        best: int | None = None
        todo = [(child, letter, (1, 3 & full, 7 & full)) for letter, child in self.root.children.items()]
        while todo:
            node, letter, (a0, a1, a2) = todo.pop()
            match = at.get(letter, 0)
            b0 = a0 << 1 & match
            b1 = (a1 << 1 & match | a0 | a0 << 1 | b0 << 1 | b0) & full if node.most > 0 else 0
            b2 = (a2 << 1 & match | a1 | a1 << 1 | b1 << 1 | b1) & full if node.most > 1 else 0
            states = (b0, b1, b2)
            if not (b0 or b1 or b2):
                continue
            for e in range(node.word + 1):
                if states[e] & end and (best is None or e < best):
                    best = e
            for e in range(node.stem + 1):
                if states[e] and (best is None or e < best):
                    best = e
            todo.extend((child, x, states) for x, child in node.children.items())
        return best


class Matcher:
    """Distances of the words met so far, in a table of bounded size."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        for word in words.difference(self.known):
            found = None
            for form in {word, word.translate(_LETTER_FOR)} if _SIGNS.search(word) else (word,):
                if self.lexicon.may_match(form):
                    d = self.lexicon.distance(form)
                    d = d + (form != word) if d is not None else None
                    found = d if found is None else found if d is None else min(d, found)
            self.known[word] = -1 if found is None else min(found, 2)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: exact and misspelled hits in abuse, the same in quotation, density."""
        lowered = [t.lower() if t else "" for t in texts]
        words = [WORD.findall(t) for t in lowered]
        self.learn(set().union(*words) if words else set())
        out = np.zeros((len(texts), 5))
        get = self.known.__getitem__
        for k, ws in enumerate(words):
            found = list(map(get, ws))
            if not ws or max(found) < 0:
                continue
            spans = [m.span() for m in WORD.finditer(lowered[k])]
            for at, d in enumerate(found):
                if d >= 0:
                    quoted = self.is_quoted(lowered[k], ws, spans, at)
                    out[k, 2 * quoted + (d > 0)] += 1
            out[k, 4] = min(1.0, 20 * out[k, :2].sum() / len(ws))
        out[:, :4] = np.log1p(out[:, :4])
        return out

    @staticmethod
    def is_quoted(text: str, words: list[str], spans: list[tuple[int, int]], at: int) -> bool:
        a, b = max(0, at - WINDOW), min(len(words), at + WINDOW + 1)
        before = text[spans[a][0] : spans[at][0]]
        after = text[spans[at][1] : spans[b - 1][1] + 1]
        marks = len(_QUOTES.findall(before))
        if marks % 2 and _QUOTES.search(after):
            return True
        return marks > 0 and any(w in _REPORT for w in words[a:at])


@dataclass
class ToxicityModel:
    lexicon: list[str]
    weights: np.ndarray  # of the features, and the constant last

    def score(self, features: np.ndarray) -> np.ndarray:
        value = features @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's method."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _terms(words: set[str]) -> set[str]:
    plain = {w for w in words if 3 <= len(w) <= 24}
    return plain | {f"{w[:n]}*" for w in plain for n in _STEMS if len(w) >= n}


def _count(wanted=None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "text", _SLICE_CHARS):
            rows = []
            for text in frame["text"]:
                words = WORD.findall(text.lower())
                terms = _terms(set(words))
                if wanted is not None:
                    terms &= wanted.value
                size = len(words) // 12
                rows += ((t, size) for t in terms)
            yield pd.DataFrame(rows, columns=["term", "size"])

    return run


def _choose(counts: pd.DataFrame, toxic: int, clean: int) -> list[str]:
    """Entries by purity, evidence and diversity; stems where words branch."""
    rate = toxic / (toxic + clean)
    pos, neg = counts["pos"].to_numpy(float), counts["neg"].to_numpy(float)
    every = pos + neg
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (pos * np.log(pos / (every * rate)) + np.where(neg > 0, neg * np.log(neg / (every * (1 - rate))), 0))
    purity = (pos / toxic) / (pos / toxic + (neg + 0.5) / clean)
    good = (g >= LEAST_G) & (purity >= LEAST_PURITY) & (pos / every >= 0.4)
    good &= counts["sizes"].to_numpy() >= LEAST_LENGTHS
    seen = dict(zip(counts["term"], pos, strict=True))
    chosen = set(counts["term"][good])
    stems = set()
    for stem in sorted(t for t in chosen if t.endswith("*")):
        text = stem[:-1]
        if any(text[:n] + "*" in stems for n in _STEMS if n < len(text)):
            continue
        # where one longer form has nearly all of its texts, that is the entry
        longer = max((n for t, n in seen.items() if t != stem and t.startswith(text) and t.rstrip("*") != text), default=0)
        if longer < 0.75 * seen[stem]:
            stems.add(stem)
    words = {
        t for t in chosen
        if not t.endswith("*") and not any(t[:n] + "*" in stems for n in _STEMS)
    }
    return sorted(words | stems)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn lexicon and weights from the training rows of ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(lot < sample / max(n, 1))  # expected bound of the broadcast: ``sample`` rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    rows = texts.join(F.broadcast(drawn), "doc_id").dropDuplicates(["text"]).select("text", "toxic").persist()
    kinds = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not clean:
        rows.unpersist()
        return ToxicityModel([], np.array([0.0] * 5 + [-50.0]))
    schema = "term string, size int"
    pos = (
        rows.where("toxic = 1").select("text").mapInPandas(_count(), schema).groupBy("term")
        .agg(F.count("*").alias("pos"), F.countDistinct("size").alias("sizes"))
        .where("pos >= 4").toPandas()
    )
    wanted = spark.sparkContext.broadcast(set(pos["term"]))
    neg = (
        rows.where("toxic = 0").select("text").mapInPandas(_count(wanted), schema).groupBy("term")
        .agg(F.count("*").alias("neg")).toPandas()
    )
    counts = pos.merge(neg, "left", "term").fillna({"neg": 0})
    entries = _choose(counts, toxic, clean)
    shared = spark.sparkContext.broadcast(entries)

    def featurize(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(Lexicon(shared.value))
        for frame in slices(frames, "text", _SLICE_CHARS):
            found = matcher.features(frame["text"].tolist())
            out = pd.DataFrame(found, columns=["f0", "f1", "f2", "f3", "f4"])
            yield out.assign(toxic=frame["toxic"].to_numpy())

    found = rows.mapInPandas(
        featurize, "f0 double, f1 double, f2 double, f3 double, f4 double, toxic int"
    ).toPandas()
    rows.unpersist()
    x, y = found[["f0", "f1", "f2", "f3", "f4"]].to_numpy(), found["toxic"].to_numpy(float)
    return ToxicityModel(entries, _logistic(x, y))


def _predict(model, key: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = keep_in_worker(key, lambda: Matcher(Lexicon(model.value.lexicon)))
        for frame in slices(frames, "text", _SLICE_CHARS):
            score = model.value.score(matcher.features(frame["text"].tolist()))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64").to_numpy(), "score": score}
            ).astype({"doc_id": "Int64"})

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = f"model-{id(model)}-{shared._jbroadcast.id()}"
    found = source.mapInPandas(_predict(shared, key), "doc_id long, score double")
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
