"""Registered queries against their DuckDB SQL, and the pipeline against its parts."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import corpus_pipeline  # noqa: E402
from compare import duck, norm  # noqa: E402

from campaignlake.llm import backoff_langid, block_naming, probminhash, winnowing  # noqa: E402
from campaignlake.llm.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from campaignlake.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


def _lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted("|".join(norm(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    result = duck(SF).execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _lines(frame.columns, frame.collect()) == _lines(columns, result.fetchall())


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {*QUERIES, "pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline_is_its_operators_in_turn(spark):
    docs = table(spark, SF, "documents")
    kept = corpus_pipeline.keep_known_language(spark, docs, SF)
    known = backoff_langid.identify(docs, backoff_langid.fit(docs)).where("lang_pred <> 'und'")
    assert kept.columns == docs.columns and kept.count() == known.count()
    single = corpus_pipeline.drop_exact_copies(spark, kept, SF)
    assert single.count() == block_naming.exact_groups(kept).where("kept").count()
    near = corpus_pipeline.drop_near_copies(spark, single, SF)
    assert near.count() == probminhash.near_duplicates(single).where("kept").count()
    clean = corpus_pipeline.drop_contaminated(spark, near, SF)
    bad = winnowing.contamination(near, table(spark, SF, "benchmark")).where("contaminated")
    assert clean.count() == near.count() - bad.count() and clean.columns == docs.columns
    packed = corpus_pipeline.run(spark, SF)
    ids = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@pytest.mark.parametrize("languages", [1, 2, 12])
def test_language_stage_with_any_number_of_languages(spark, languages):
    """Short texts of a known language stay; texts of an unknown script, without letters or null go."""
    names = [chr(97 + k) for k in range(languages)]
    rows = [(k, f"{n}um {n}or the", n) for k, n in enumerate(names * 20)]
    odd = [(1000, "漢字 かな", None), (1001, "a", None), (1002, "12", None), (1003, None, None), (None, "the", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_known_language(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(len(rows)), 1001, None}
