"""Collocations: summaries keep what they must, results against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from campaignlake.llm import collocations


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=12), st.integers(2, 9))
def test_every_frequent_name_survives(batches, least):
    truth = Counter(x for b in batches for x in b)
    summary = collocations.Summary(collocations.capacity_for(sum(truth.values()), least))
    for batch in batches:
        names, counts = np.unique(np.array(batch, np.uint32), return_counts=True)
        summary.merge(names, counts)
        assert len(summary.names) <= summary.capacity
    assert summary.subtracted < least
    held = dict(zip(summary.names.tolist(), summary.counts.tolist(), strict=True))
    for name, times in truth.items():
        assert times - summary.subtracted <= held.get(name, 0) <= times
        assert times < least or name in held


def brute(rows, least, percent=50, top=2000):
    fold = {c: c + 32 for c in range(65, 91)}
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(fold)):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[k : k + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in found.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        n = sum(a for p, a in counts.items() if len(p) == 1)
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def _rows(seed=5):
    rng = random.Random(seed)
    plain = [f"w{k}" for k in range(40)] + ["Äpfel", "naïve", "日本", "x y", "IS", "a\tb", "co-op", " q"]
    fixed = ["new york city", "San  Francisco", "ad\thoc", "to be, or not", "aha aha aha aha"]
    rows = []
    for k in range(160):
        words = [rng.choice(plain if rng.random() < 0.7 else fixed) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for w in words)
        rows.append((rng.choice(["en", "fr", None]), text))
    rows += [("en", None), ("en", ""), ("fr", " . \n"), ("de", "one"), (None, "same words here " * 400)]
    return rows + [rows[0]] * 30


@pytest.mark.parametrize("limits", [{}, {"partition_chars": 500}, {"partition_chars": 400, "filter_bits": 1 << 14}])
def test_against_brute_force(spark, limits):
    rows = _rows()
    docs = spark.createDataFrame([(7, t, g, 1) for g, t in rows], "doc_id long, text string, lang string, rank int")
    for least, top in ((4, 2000), (10, 5)):
        got = collocations.collocations(docs.repartition(5), least=least, top=top, **limits).collect()
        assert sorted(map(tuple, got)) == brute(rows, least, top=top)


def test_small_filters_are_given_up(spark):
    rows = _rows(6)
    docs = spark.createDataFrame([(t, g) for g, t in rows], "text string, lang string")
    got = collocations.collocations(docs, least=6, filter_bits=64).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6)




def test_no_words_at_all(spark):
    for rows in ([], [(None, None)], [("", "en")]):
        docs = spark.createDataFrame(rows, "text string, lang string")
        assert collocations.collocations(docs).count() == 0
