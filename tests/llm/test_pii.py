"""Personal data: base spans against Python's patterns, boosted trees, planted spans."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import pii_boosting as pii
from campaignlake.llm.catalog import op12_boosted_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]


def _random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["a@b.c", "@", ".", "x", "+", "1", "22", "255", "256", "0001", " ", "-", "(", ")", "_", "é", "😀", "\n",
             "4111111111111111", "4111 1111-1111 1111", "10.0.0.1", "+1 (523) 555-1055", "u.v%w", "%", "12345678"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(n)]


def test_base_spans_against_plain_patterns(spark):
    texts = _random_texts(3000, 3) + [
        None, "", "a@b.c_d@e.f", "a@b@c.d", "a@b.@c.d", "a@b.c.@d.e", "1.2.3.4.5.6.7.8", "1.2.3.256", "+1.", "+1((((",
        "000255.1.1.001", "+12345678901234567", "4111111111111112", "x" * 300 + "@y.z", "+4111 1111 1111 1111",
    ]
    docs = spark.createDataFrame([(k % 1000, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, base int")
    out = pii.personal_data(docs).collect()
    got = sorted((r["doc_id"], r["base_spans"]) for r in out)
    assert got == sorted((k % 1000, ",".join(base_spans(t))) for k, t in enumerate(texts))
    for r in out:
        spans, base = r["spans"].split(","), r["base_spans"].split(",")
        assert r["base_spans"] == "" or set(base) <= set(spans)


def test_long_texts_take_linear_time(spark):
    many = " ".join(f"u{k}@mail.example.com, 10.0.{k % 300}.1" for k in range(20_000))
    texts = ["a" * 400_000, "1" * 400_000, "1 " * 200_000, "1." * 200_000, "+1" + "(" * 300_000, "a.b@" * 80_000,
             "1((" * 100_000, "+" * 200_000, many]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begun = time.time()
    out = {r["doc_id"]: r for r in pii.find_spans(docs).select("doc_id", pii._named(F.col("base")).alias("b")).collect()}
    assert time.time() - begun < 90
    assert [out[k]["b"] for k in (0, 1, 2, 4, 7)] == [""] * 5
    assert out[3]["b"] == ",".join(f"ip:{a}:{a + 7}" for a in range(0, 400_000, 8))
    assert out[8]["b"] == ",".join(base_spans(many))


def _planted(n=4000, seed=9):
    """Texts with sure spans, refuted numbers, and undecided personal data and numbers."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    tel = lambda: f"({num(3)}) {num(3)}-{num(4)}"
    rows, wanted, junk = [], {}, {}
    for k in range(n):
        word = rng.choice(["alpha", "beta", "gamma", "delta"])
        case = k % 8
        if case < 2:
            text = f"{word}: call +1 {tel()} now"
        elif case == 2:
            text = f"{word} {rng.choice(['order', 'invoice'])} +{num(3)} {num(3)} and serial +{num(6)}, date {num(4)}-{num(2)}-{num(2)}"
        elif case == 3:
            text = f"{word} write to {word}{k}@mail{k % 9}.example.com or see @{word} at 4.{num(2)}"
        elif case == 4:
            text = f"{word} mail {word}{k}@host.{num(2)} failed"
        elif case == 5:
            phone = tel()
            text = f"{word}: call {phone} now"
            wanted[k] = (text.index(phone), text.index(phone) + len(phone))
        elif case == 6:
            number = num(4) + "-" + num(2) + "-" + num(2)
            text = f"{word} order {number} done"
            junk[k] = text.index(number)
        else:
            text = f"nothing to see here, {word}"
        rows.append((k, text))
    return rows, wanted, junk


def test_planted_spans_are_added_and_numbers_left(spark):
    rows, wanted, junk = _planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    found = [k for k, (a, b) in wanted.items() if f"phone:{a}:{b}" in out[k]["spans"]]
    assert len(found) >= 0.95 * len(wanted)
    assert not [k for k in junk if out[k]["spans"]]
    assert not [k for k, t in rows if t.startswith("nothing") and out[k]["spans"]]
    assert all(",".join(base_spans(t)) == out[k]["base_spans"] for k, t in rows)


def test_score_in_sql_is_the_trees(spark):
    found = pii.find_spans(spark.createDataFrame(_planted(800)[0], "doc_id long, text string"))
    booster = pii.fit(found)
    scored = pii.proposals(found).withColumn("score", booster.score()).collect()
    x = np.array([[r[f] for f in pii.FEATURES] for r in scored])
    assert all(x[:, f].max() < n and x[:, f].min() >= 0 for f, n in enumerate(pii.FEATURES.values()))
    want = 1 / (1 + np.exp(-booster.margin(x)))
    assert np.allclose([r["score"] for r in scored], want, atol=1e-9)
    sure = [(r["score"], r["label"]) for r in scored if r["label"] is not None and r["kind"] == 3]
    assert np.mean([(s >= 0.5) == bool(y) for s, y in sure]) > 0.95


def test_boosting_learns_an_interaction():
    x = np.array([[k, d, 0, 0, 0, 0, 0, 0] for k in range(4) for d in range(10)])
    y = ((x[:, 0] >= 2) & (x[:, 1] >= 5)).astype(int)
    booster = pii.boost(x, y, np.full(len(x), 50.0))
    assert ((booster.margin(x) > 0) == (y == 1)).all()


def test_overlaps_and_redaction(spark):
    text = "é mail bob@x.example.com or +1 (523) 555-1055."
    docs = spark.createDataFrame([(1, text), (1, text), (None, None)], "doc_id long, text string")
    out = pii.personal_data(docs)
    assert out.count() == 3
    spans = out.where("doc_id = 1").first()["all"]
    frame = docs.where("doc_id = 1").limit(1).crossJoin(out.where("doc_id = 1").limit(1).select("all"))
    assert frame.select(pii.redact(F.col("text"), F.col("all"))).first()[0] == "é mail [EMAIL] or [PHONE]."
    assert len(spans) == 2


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame(_planted(80)[0], "doc_id long, text string")
    plan = pii.personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(empty).count() == 0
    none = pii.personal_data(spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string"))
    assert [(r["base_spans"], r["spans"]) for r in none.collect()] == [("", "")] * 2


def test_query_against_plain_patterns(spark):
    import hashlib

    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    out = op12_boosted_pii(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        want = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(w.startswith(kind) for w in want)


@pytest.mark.parametrize("number", ["4111111111111111", "5500005555555559", "4111111111111112", "6011000990139424"])
def test_luhn(spark, number):
    got = spark.range(1).select(pii.luhn(F.lit(number))).first()[0]
    assert got == passes("card", number)
