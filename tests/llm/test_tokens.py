"""Tokenizing, packing, token files and sharding: round trips and brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campaignlake.llm import range_coder, splitters, token_files, vector_packing
from campaignlake.llm.common import scratch_path
from campaignlake.llm.tokenizing import Encoder

DOCS = "doc_id long, text string"
KEEPING = public_tokenizers.path("byte_bpe_50k.json")
DROPPING = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "plain words, and more.", "", None, "a  b\n\n c\t\r\nd ", "x\x1cy \x1f z", "ΑΣ ΣΑΣ.", "é é ́",
    "<|endoftext|> <|startoftext|>", "日本語　テスト", "don't they'll 12345", "z" * 9000, "word " * 3000, " ", "#" * 70,
]


def _whole(path, text, end_id):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]


@pytest.mark.parametrize(("path", "keep"), [(KEEPING, True), (DROPPING, False)])
def test_stretches_give_the_ids_of_whole_texts(path, keep):
    encoder = Encoder(path, keep, 1)
    for _ in range(2):  # unknown stretches, then known ones
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder(TEXTS)]
        assert got == [_whole(path, t, 1) for t in TEXTS]


@given(st.lists(st.text(alphabet=" \n\t\xa0 \x1cabZ's1é́ß漢<|>.!", max_size=40), max_size=5))
@settings(max_examples=60, deadline=None)
def test_stretches_of_odd_texts(texts):
    for path, keep in ((KEEPING, True), (DROPPING, False)):
        got = [np.frombuffer(x, "<u4").tolist() for x in Encoder(path, keep, 1)(texts)]
        assert got == [_whole(path, t, 1) for t in texts]


def _id_samples():
    rng = np.random.default_rng(1)
    yield np.zeros(20000, int)
    yield np.tile([1, 2, 3], 9000)
    yield rng.integers(0, 50257, 9000)
    yield np.concatenate((np.full(5000, 7), [50256], np.full(5000, 9), rng.zipf(1.3, 9000) % 50257))
    yield np.array([5])
    yield np.array([], int)


def test_blocks_round_trip():
    for ids in _id_samples():
        blocks = range_coder.encode_blocks(ids, 50257)
        assert (range_coder.decode_blocks(blocks, 50257) == ids).all()
        if len(blocks) > 2:  # blocks stand alone
            assert (range_coder.decode_blocks(blocks[1:2], 50257) == ids[4096:8192]).all()


def test_coder_predicts():
    ids = np.tile(np.arange(50), 400)
    size = sum(len(b[2]) for b in range_coder.encode_blocks(ids, 50257))
    assert size < len(ids) / 2  # less than four bits an id


def test_a_damaged_block_is_an_error():
    n, crc, code = range_coder.encode_blocks(np.arange(3000), 50257)[0]
    broken = code[:100] + bytes([code[100] ^ 1]) + code[101:]
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode_blocks([(n, crc, broken)], 50257)


def test_too_large_a_vocabulary_is_an_error():
    with pytest.raises(ValueError, match="vocabulary"):
        range_coder.encode_blocks(np.arange(3), 1 << 17)


def test_token_files_match_direct_encoding(spark):
    rows = [(k * 37 % 101, t) for k, t in enumerate(TEXTS * 3)] + [(None, "null id"), (4, "again 4"), (4, "again 4")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", shard string").repartition(3)
    path = scratch_path(spark, "test-files")
    token_files.write_token_files(frame, path, KEEPING, container_ids=5000)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    for r, (doc_id, text) in zip(got, ordered, strict=True):
        ids = np.array(_whole(KEEPING, text, 2), "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (
            doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.round_trip(spark.createDataFrame([], DOCS), KEEPING).count() == 0


def _sequences(pieces):
    out = defaultdict(list)
    for r in pieces:
        out[r["sequence_id"]].append(r)
    for part in out.values():
        part.sort(key=lambda r: r["offset"])
        at = 0
        for r in part:
            assert r["offset"] == at
            at += r["length"]
    return out


def test_packing_covers_every_id_once(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS * 4)] + [(None, "null"), (1, "again")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], DOCS + ", length int").repartition(3)
    pieces = vector_packing.pack_documents(frame, DROPPING, max_segments=16, pool_size=8).collect()
    for part in _sequences(pieces).values():
        used = sum(r["length"] for r in part)
        assert used <= 2048 and len(part) <= 16
    by = defaultdict(list)
    for r in pieces:
        by[r["doc_id"], r["doc_tokens"]].append(r)
    want = defaultdict(int)
    for doc_id, text in rows:
        want[doc_id, len(_whole(DROPPING, text, 1))] += 1
    assert {k: sum(r["length"] for r in v) for k, v in by.items()} == {k: k[1] * n for k, n in want.items()}
    for doc_id, text in rows:
        ids = _whole(DROPPING, text, 1)
        if want[doc_id, len(ids)] == 1:
            got = sorted(by[doc_id, len(ids)], key=lambda r: r["start"])
            assert np.frombuffer(b"".join(r["ids"] for r in got), "<u4").tolist() == ids
    assert vector_packing.pack_documents(spark.createDataFrame([], DOCS), DROPPING).count() == 0


def test_packer_ends_on_many_small_pieces(spark):
    for pool_size in (8, 1024):
        sequences = []
        packer = vector_packing.Packer(sequences.append, pool_size=pool_size)
        for k in range(5000):
            packer.add(vector_packing.Document(k, bytes(4)))
            assert len(packer.pool) <= pool_size + vector_packing.CAPACITY
        packer.finish()
        assert sorted(d.doc_id for s in sequences for d, _, _ in s) == list(range(5000))
    frame = spark.createDataFrame([(k, None, 7) for k in range(5000)], DOCS + ", length int").coalesce(1)
    pieces = vector_packing.pack_documents(frame, DROPPING).collect()
    assert sorted(r["doc_id"] for r in pieces) == list(range(5000))
    for part in _sequences(pieces).values():
        used = sum(r["length"] for r in part)
        assert used == 2048 or used & (used - 1) == 0


def test_packer_keeps_all_limits_and_pads_little():
    rng = np.random.default_rng(4)
    sequences = []
    packer = vector_packing.Packer(sequences.append, capacity=256, max_segments=6, max_loss=100, pool_size=64)
    total = 0
    for k in range(600):
        n = int(rng.integers(1, 400))
        mask = rng.random(n) < 0.3
        loss = np.concatenate(([0], np.cumsum(mask)))
        total += n
        packer.add(vector_packing.Document(k, np.arange(n, dtype="<u4").tobytes(), loss))
    packer.finish()
    used = 0
    for sequence in sequences:
        tokens = sum(n for _, _, n in sequence)
        used += tokens
        assert tokens <= 256 and len(sequence) <= 6
        assert sum(d.loss_between(a, a + n) for d, a, n in sequence) <= 100
    assert used == total
    assert total / (256 * len(sequences)) > 0.85


def test_dot_product_prefers_the_piece_that_fits_what_is_left():
    """With few loss-bearing tokens left, a context-heavy piece goes in before an equal one of replies."""
    sequences = []
    packer = vector_packing.Packer(sequences.append, capacity=100, max_segments=9, max_loss=40, pool_size=99)
    for k, (n, loss) in enumerate([(60, 40), (40, 0), (40, 40)]):
        mask = np.zeros(n, int)
        mask[:loss] = 1
        packer.add(vector_packing.Document(k, bytes(4 * n), np.concatenate(([0], np.cumsum(mask)))))
    packer.finish()
    assert sorted(d.doc_id for d, _, _ in sequences[0]) == [0, 1]


def _sizes(text):
    return len((text or "").encode()) + 1


def test_shards_are_near_equal_and_gapless(spark):
    rows = [(k * 13 % 997, "é" * (k * 7 % 50)) for k in range(900)] + [(5, "hot key")] * 500 + [(None, None)] * 3
    frame = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", size int").repartition(4)
    got = splitters.shard_by_size(frame, sample=300).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (d is None, d or 0, _sizes(t), zlib.crc32((t or "").encode())) for d, t in rows
    )
    total = sum(_sizes(t) for _, t in rows)
    for shard in range(8):
        part = [r for r in got if r["shard"] == shard]
        assert abs(sum(r["size"] for r in part) - total / 8) <= 2 * max(_sizes(t) for _, t in rows)
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    # key order: slots and shards follow doc_id
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
    assert ids == sorted(ids)
    assert splitters.shard_by_size(spark.createDataFrame([], DOCS)).count() == 0


def test_dozens_of_very_large_records_are_sharded(spark):
    large = 40
    frame = spark.range(0, 4000, 1, 4).select(
        "id", F.when(F.col("id") % (4000 // large) == 7, 60_000).otherwise(F.lit(1) + F.col("id") % 19).alias("n")
    )
    frame = frame.select(F.col("id").alias("doc_id"), F.expr("repeat('x', int(n))").alias("text"))
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    try:
        got = splitters.shard_by_size(frame, sample=300).orderBy("doc_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    sizes = [60_001 if k % (4000 // large) == 7 else 2 + k % 19 for k in range(4000)]
    total, at, slots = sum(sizes), 0, defaultdict(int)
    assert [(r["doc_id"], r["size"]) for r in got] == list(enumerate(sizes))
    for r in got:  # the shard that the record's middle falls into
        shard = (2 * at + r["size"]) * 8 // (2 * total)
        assert (r["shard"], r["slot"]) == (shard, slots[shard])
        slots[shard] += 1
        at += r["size"]
