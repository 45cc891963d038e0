"""Packing token ids into sequences: vector bin packing by the dot-product heuristic.

A piece of a document needs three things at once: tokens, one segment, and its
loss-bearing tokens. A sequence offers ``capacity`` tokens, ``max_segments``
segments and ``max_loss`` loss-bearing tokens. While a sequence is open, the piece
that fits and whose demand has the largest dot product with what is left of the
sequence (both as shares of the capacities) goes in. Texts longer than a sequence
are cut into full ones first; a gap that no whole piece fills is filled by cutting
the piece that scores best, so only the last sequence of a task is short. That
rest is cut into sequences whose lengths are powers of two, which need no padding.

Scale: each task packs what it reads, a pool of ``POOL`` remainders at a time, so
nothing is shuffled and memory is bounded by the pool and the longest text.

Defined results: null and empty texts have the end id alone; every row of the
input has at least one piece; repeated rows and null doc_ids are packed like
others; an empty table has no sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import slices
from campaignlake.llm.tokenizing import Encoder

CAPACITY = 2048
MAX_SEGMENTS = 256
POOL = 1024
SMALLEST_CUT = 8
_SLICE_CHARS = 2_000_000

_PIECES = (
    "doc_id long, start long, length long, doc_tokens long, loss_tokens long,"
    " sequence_id long, offset long, ids binary"
)


@dataclass
class Document:
    doc_id: int | None
    ids: bytes
    loss: np.ndarray | None = None  # cumulated loss mask; None: every id bears loss

    def loss_between(self, a: int, b: int) -> int:
        return b - a if self.loss is None else int(self.loss[b] - self.loss[a])


@dataclass
class Packer:
    """Packs pieces (document, start, length); ``emit`` takes whole sequences."""

    emit: Callable[[list[tuple[Document, int, int]]], None]
    capacity: int = CAPACITY
    max_segments: int = MAX_SEGMENTS
    max_loss: int = CAPACITY
    pool_size: int = POOL
    pool: list[tuple[Document, int, int]] = field(default_factory=list)
    held: int = 0  # tokens in the pool

    def add(self, document: Document) -> None:
        total, at = len(document.ids) // 4, 0
        while total - at >= self.capacity and self.max_segments >= 1:
            if document.loss_between(at, at + self.capacity) > self.max_loss:
                break
            self.emit([(document, at, self.capacity)])
            at += self.capacity
        while at < total:
            size = self._most(document, at, min(total - at, self.capacity))
            self.pool.append((document, at, size))
            self.held += size
            at += size
        # short of a sequence's worth the pool grows, to less than ``capacity`` pieces more
        while len(self.pool) >= self.pool_size and self.held >= self.capacity:
            self.pack(len(self.pool) // 2)

    def _most(self, document: Document, at: int, size: int) -> int:
        """The longest cut from ``at`` that a sequence can take."""
        while size > 1 and document.loss_between(at, at + size) > self.max_loss:
            size = max(1, size // 2)
        return size

    def pack(self, leave: int) -> None:
        """Fill sequences until only ``leave`` pieces are in the pool, or one sequence's worth."""
        tokens = np.array([p[2] for p in self.pool], float)
        loss = np.array([d.loss_between(a, a + n) for d, a, n in self.pool], float)
        left = np.ones(len(self.pool), bool)
        unit, loss_unit = 1 / self.capacity, 1 / max(self.max_loss, 1)
        while left.sum() > leave and tokens[left].sum() >= self.capacity:
            room, segments, loss_room = self.capacity, self.max_segments, self.max_loss
            sequence: list[tuple[Document, int, int]] = []
            while room and segments:
                fits = left & (tokens <= room) & (loss <= loss_room)
                score = (
                    tokens * unit * (room * unit)
                    + 1 / self.max_segments * (segments / self.max_segments)
                    + loss * loss_unit * (loss_room * loss_unit)
                )
                best = int(np.argmax(np.where(fits, score, -1.0)))
                if not fits[best]:
                    cut = self._cut(tokens, loss, left, score, room, loss_room)
                    if cut:
                        sequence.append(cut)
                        room -= cut[2]
                    break
                left[best] = False
                piece = self.pool[best]
                sequence.append(piece)
                room -= piece[2]
                segments -= 1
                loss_room -= int(loss[best])
            self.emit(sequence)
        self.pool = [p for p, kept in zip(self.pool, left.tolist(), strict=True) if kept]
        self.held = sum(p[2] for p in self.pool)

    def _cut(self, tokens, loss, left, score, room, loss_room):
        """Cut the best piece to fill ``room``; the rest stays in the pool."""
        if room < SMALLEST_CUT:
            return None
        for at in np.argsort(np.where(left, -score, 1.0), kind="stable")[:8].tolist():
            document, a, n = self.pool[at]
            if left[at] and n > room and document.loss_between(a, a + room) <= loss_room:
                self.pool[at] = (document, a + room, n - room)
                tokens[at] = n - room
                loss[at] = document.loss_between(a + room, a + n)
                return document, a, room
        return None

    def finish(self) -> None:
        self.pack(0)
        rest = [p for p in self.pool if p[2]]
        self.pool, self.held = [], 0
        while rest:  # sequences of 2^k tokens, the largest first
            total, loss_room = sum(p[2] for p in rest), self.max_loss
            room = min(1 << (total.bit_length() - 1), self.capacity)
            sequence: list[tuple[Document, int, int]] = []
            while room and rest and len(sequence) < self.max_segments:
                document, a, n = rest.pop()
                size = min(n, room)
                bears = document.loss_between(a, a + size)
                if bears > loss_room and sequence:
                    rest.append((document, a, n))
                    break
                sequence.append((document, a, size))
                loss_room -= bears
                room -= size
                if size < n:
                    rest.append((document, a + size, n - size))
            self.emit(sequence)


def _pack(tokenizer: str, keep_blanks: bool, end_id: int, limits: dict):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer, keep_blanks, end_id)
        rows: list[tuple] = []
        number = TaskContext.get().partitionId() << 40

        def emit(sequence) -> None:
            nonlocal number
            offset = 0
            for document, a, n in sequence:
                total, ids = len(document.ids) // 4, document.ids[4 * a : 4 * (a + n)]
                bears = document.loss_between(a, a + n)
                rows.append((document.doc_id, a, n, total, bears, number, offset, ids))
                offset += n
            number += 1

        def taken() -> pd.DataFrame:
            names = [c.split()[0] for c in _PIECES.split(", ")]
            frame = pd.DataFrame(rows, columns=names)
            rows.clear()
            return frame.astype({"doc_id": "Int64"})

        packer = Packer(emit, **limits)
        for frame in slices(frames, "text", _SLICE_CHARS):
            coded = encoder(frame["text"].tolist())
            for doc_id, ids in zip(frame["doc_id"], coded, strict=True):
                packer.add(Document(None if pd.isna(doc_id) else int(doc_id), ids))
            yield taken()
        packer.finish()
        yield taken()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    keep_blanks: bool = False,
    end_id: int = 1,
    capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = CAPACITY,
    pool_size: int = POOL,
) -> DataFrame:
    """One row per piece: its document, place and ids, and its place in a sequence.

    In plain documents every id bears loss; ``Packer`` takes a loss mask per text.
    """
    limits = {
        "capacity": capacity,
        "max_segments": max_segments,
        "max_loss": max_loss,
        "pool_size": pool_size,
    }
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInPandas(_pack(tokenizer, keep_blanks, end_id, limits), _PIECES)
