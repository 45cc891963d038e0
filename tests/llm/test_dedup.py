"""Exact and near dedup against brute force on small fixtures."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import block_naming, common, probminhash
from campaignlake.llm.common import word_bytes
from campaignlake.llm.components import components

DOCS = "doc_id long, text string"


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "é", "ü"]
    base = [" ".join(rng.choices(words, k=rng.choice([3, 20, 60, 200]))) for _ in range(30)]
    rows = []
    for text in base:
        rows.append(text)
        for _ in range(rng.randrange(3)):
            parts = text.split()
            for _ in range(rng.randrange(4)):
                parts[rng.randrange(len(parts))] = rng.choice(words) + "x"
            rows.append(" ".join(parts))
    rows += ["ABC abc", "abc ABC", "abc abc", "ÄBC", "äbc", "", None, None, "###", "one", "ONE!"]
    rows += ["x" * 40 + str(k % 3) for k in range(9)] + [base[0]] * 20
    data = [(k * 7 % 1000, t) for k, t in enumerate(rows)]
    return data + [(data[0][0], data[0][1]), (None, "null id"), (None, "null id"), (3, "other text of 3")]


def test_exact_groups_match_brute_force(spark, documents):
    frame = spark.createDataFrame(documents, DOCS)
    for size in (4, 64, 16384):  # many levels of pairs, and none
        got = block_naming.exact_groups(frame, size).collect()
        groups = defaultdict(list)
        for doc_id, text in documents:
            groups[_lower(text)].append(doc_id)
        want = Counter(
            (d, max((x for x in ids if x is not None), default=None), len(ids))
            for ids in groups.values()
            for d in ids
        )
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
        assert sum(r["kept"] for r in got) == len(groups)
        assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_drop_copies_keeps_one_row_of_each_text_and_its_columns(spark, documents):
    frame = spark.createDataFrame([(*r, 1, "z") for r in documents], DOCS + ", name int, content string")
    kept = block_naming.drop_copies(frame)
    assert kept.columns == ["doc_id", "text", "name", "content"]
    texts = [_lower(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({_lower(t) for _, t in documents})


def test_empty_tables(spark):
    frame = spark.createDataFrame([], DOCS)
    assert block_naming.exact_groups(frame).count() == 0
    assert block_naming.drop_copies(frame).count() == 0
    assert probminhash.near_duplicates(frame).count() == 0
    assert probminhash.drop_near_copies(frame).count() == 0


def _shingles(text):
    words = word_bytes(text)
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def _similarity(a, b):
    na, nb, every, total = sum(a.values()), sum(b.values()), set(a) | set(b), 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i] * 1.0) for j in every) if na == nb else 1 / sum(
            max((a[j] / na) / (a[i] / na), (b[j] / nb) / (b[i] / nb)) for j in every
        )
    return total


def test_probability_jaccard_matches_its_definition():
    rng = random.Random(2)
    for _ in range(200):
        a = Counter({k: rng.randint(1, 4) for k in rng.sample(range(12), rng.randint(1, 9))})
        b = Counter({k: rng.randint(1, 4) for k in rng.sample(range(12), rng.randint(1, 9))})
        got = probminhash.probability_jaccard(
            *(np.array(x) for c in (a, b) for x in zip(*sorted(c.items()), strict=True))
        )
        assert got == pytest.approx(_similarity(a, b))


def test_near_duplicate_classes_match_brute_force(spark, documents):
    sets = [(d, t, _shingles(t)) for d, t in documents]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (_, _, a) in enumerate(sets):
        for j, (_, _, b) in enumerate(sets[:i]):
            if a and b and (a == b or _similarity(a, b) >= 0.8):
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for k, (d, _, _) in enumerate(sets):
        classes[root(k)].append(d)
    want = Counter(
        (d, max((x for x in ids if x is not None), default=None), len(ids))
        for ids in classes.values()
        for d in ids
    )
    got = probminhash.near_duplicates(spark.createDataFrame(documents, DOCS)).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(classes)


def test_no_link_is_lost_in_a_large_bucket(spark):
    """A chain of near copies whose ends are not similar is one class."""
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(25):
        rows.append((k, " ".join(words)))
        words = [*words[:k * 8], *(f"n{k}x{j}" for j in range(8)), *words[k * 8 + 8 :]]
    got = probminhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["class_size"] for r in got} == {25}


def test_fine_bits_tell_similar_texts_from_others():
    rng = random.Random(11)
    words = [f"w{rng.random()}" for _ in range(300)]
    changed = [*words[:100], "x", *words[101:]]  # five shingles of 296
    other = [*words[:150], *(f"o{rng.random()}" for _ in range(150))]
    texts = [" ".join(w) for w in (words, changed, other)]
    frame = pd.DataFrame({"rid": range(3), "text": texts})
    (found,) = probminhash._fine(5)(iter([frame]))
    a, b, c = (np.array(x).view(np.uint64) for x in found["bits"])
    assert list(found["rid"]) == [0, 1, 2] and len(a) * 64 == probminhash._FINE

    def apart(x, y):
        return sum(bin(v).count("1") for v in (x ^ y).tolist()) / probminhash._FINE

    # half of the share of registers that differ
    assert apart(a, b) == pytest.approx((1 - _similarity(*map(_shingles, texts[:2]))) / 2, abs=0.05)
    assert apart(a, c) == pytest.approx((1 - _similarity(*map(_shingles, texts[::2]))) / 2, abs=0.07)


def test_rare_pairs_keep_similar_texts_of_few_shingles(spark):
    rng = random.Random(17)
    rows = []

    def words(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    def add(*texts):
        at = len(rows)
        rows.extend((at + k, " ".join(t)) for k, t in enumerate(texts))

    for _ in range(25):
        for short, more in ((8, 1), (9, 1), (12, 2), (13, 2), (16, 3), (20, 4), (25, 5), (25, 4)):
            text = words(short)
            add(text, text + words(more))
        sentence = words(5)
        add(sentence * 3, [*(sentence * 3)[:-1], *words(1)])
        add(sentence * 12, sentence * 6 + words(5))
    sets = [_shingles(t) for _, t in rows]
    want = {(k, k + 1) for k in range(0, len(rows), 2) if _similarity(sets[k], sets[k + 1]) >= 0.8 - 1e-9}
    assert len(want) >= 200 and all(_similarity(*(sets[x] for x in p)) < 0.87 for p in want)
    found = probminhash.NearDuplicates(spark.createDataFrame(rows, DOCS))
    own = found.signed.select("rid", "doc_id").collect()
    ids = {r["rid"]: r["doc_id"] for r in own}
    pairs = found.rare_pairs(found.texts.select("rid", F.col("rid").alias("label"))).collect()
    assert want <= {tuple(sorted((ids[r["u"]], ids[r["v"]]))) for r in pairs}


def test_a_shared_passage_makes_no_class(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, passage + " " + " ".join(f"u{rng.random()}" for _ in range(50))) for k in range(60)]
    got = probminhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["class_size"] for r in got} == {1}


def test_near_copies_keep_columns_and_one_of_each_class(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(1, text, "a"), (2, text + " more", "b"), (2, text + " more", "b"), (3, "alone", "c"), (3, None, "d")]
    frame = spark.createDataFrame(rows, DOCS + ", label string")
    kept = probminhash.drop_near_copies(frame)
    assert kept.columns == ["doc_id", "text", "label"]
    assert sorted(r["label"] for r in kept.collect()) == ["b", "c", "d"]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7)] + [(100 + k, 101 + k) for k in range(40)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5} | {100 + k: 100 for k in range(41)}


def test_rows_that_stay_are_found_without_a_shuffle_of_texts(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(1, text, "a"), (2, text + " more", "b"), (3, "alone", "c"), (None, None, "d"), (None, text, "e")]
    frame = spark.createDataFrame(rows, DOCS + ", label string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables too large for it
    try:
        for drop, want in ((probminhash.drop_near_copies, "bcd"), (block_naming.drop_copies, "abcd")):
            kept = drop(frame)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
            assert sorted(r["label"] for r in kept.collect()) == list(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_stay_where_many_are_rejected(spark, documents, monkeypatch):
    frame = spark.createDataFrame([(*r, 1) for r in documents], DOCS + ", name int")
    for drop in (probminhash.drop_near_copies, block_naming.drop_copies):
        monkeypatch.setattr(common, "_BROADCAST_REJECTED", 1_500_000)
        want = sorted(drop(frame).collect(), key=str)
        monkeypatch.setattr(common, "_BROADCAST_REJECTED", 0)
        assert sorted(drop(frame).collect(), key=str) == want
