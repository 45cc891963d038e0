"""Fill-in-the-middle: boundary sets against plain sets, round trips, defined cases."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlake.llm import fim_boundaries as fim

OFFSETS = {
    "one": [0],
    "run": range(200_000),
    "sparse": range(0, 700_000, 977),
    "dense": [k for k in range(300_000) if k % 3],
    "mixed": [*range(70_000), *range(70_000, 500_000, 2), 600_001, *range(655_000, 660_000)],
    "edges": [65_535, 65_536, 131_071, 131_072, 1 << 33],
}


@pytest.mark.parametrize("name", sorted(OFFSETS))
def test_select_and_rank_against_a_sorted_list(name):
    offsets = np.array(OFFSETS[name], np.int64)
    held = fim.BoundarySet(offsets)
    assert len(held) == len(offsets)
    rng = np.random.default_rng(7)
    for k in {0, len(offsets) - 1, *rng.integers(0, len(offsets), 300).tolist()}:
        at = held.select(k)
        assert at == offsets[k] and held.rank(at) == k
    for value in rng.integers(0, int(offsets[-1]) + 70_000, 300).tolist():
        assert held.rank(value) == int(np.searchsorted(offsets, value))
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            held.select(k)


def test_container_kinds():
    kinds = {n: {type(c).__name__ for c in fim.BoundarySet(np.array(o)).containers} for n, o in OFFSETS.items()}
    assert kinds["run"] == {"RunContainer"} and kinds["sparse"] == {"ArrayContainer"}
    assert kinds["dense"] == {"BitmapContainer"} and len(kinds["mixed"]) >= 2
    empty = fim.BoundarySet(np.zeros(0, np.int64))
    assert len(empty) == 0 and empty.rank(5) == 0


TEXTS = [
    "plain words and more of them", "äöü ñandú 漢字 😀 mixed", "😀" * 40_000, "a" * 200_000 + "é" * 5_000,
    "é", "x", "", None, "holds <P> itself", "<S>", "ends with <", "<M", "P>S>M>", "퟿ edges",
    "line\nline two\n\nlast",
]


def _expected(doc_id, text):
    """The contract, over code points."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, mid, tail = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{tail}<P>{head}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{head}<S>{tail}<M>{mid}"


def test_against_slices_of_code_points(spark):
    rows = [(k, t, "c") for k, t in enumerate(TEXTS * 6)] + [(None, "no id", "c"), (3, TEXTS[3], "c"), (-5, "neg", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    made = fim.fill_in_middle(docs)
    out = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((repr(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"])
                 for r in out)
    want = sorted((repr(d), *_expected(d, t), t or "") for d, t, _ in rows)
    assert got == want
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("units", ["words", "lines"])
def test_cuts_at_coarser_units_restore_too(spark, units):
    rows = [(k, t) for k, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.fill_in_middle(docs, units=units)
    for r in made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect():
        text = rows[r["doc_id"]][1] or ""
        assert r["back"] == text and r["n"] == len(text)
        if r["form"] == "plain":
            continue
        for place in (r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]):
            before, after = text[:place], text[place:]
            if units == "lines":
                assert not before or not after or before.endswith("\n")
            else:
                assert not before or not after or (after[0].isspace() and not before[-1].isspace())
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, units="syllables")


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
