"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks that are reset, checksummed and decodable on their own.
Inside a block each id is predicted three ways: order 2 (what followed the last
two ids here before), order 1 (what followed the last id) and order 0 (how often
each id came so far, with a rest for ids not seen yet). Orders 2 and 1 each name
one candidate. How much of the probability goes to a candidate is learned per
block, for each order and confidence, from how often such candidates were right;
order 0 shares out what they leave. One step of the range coder codes an id with
the mixed probability.

The model starts empty and learns what was coded after every ``SEGMENT`` ids
(order 0 after 64, 128, 256, 512 and then every 1024). Between these points its
tables stand still, so the coder computes a segment's probabilities at once, and
many blocks are coded side by side: arrays have one row (lane) per block, and a
step codes one id of each. Coder and decoder run the same model.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK_IDS = 4096
LANES = 1024
SEGMENT = 64

_U = np.uint64
_SCALE = 24  # probabilities are shares of 2**24
_ONE = 1 << _SCALE
_FULL = _U((1 << 64) - 1)
_LOWEST = _U(1 << 32)  # a range below this is shifted by 32 bits
_WORD = _U(32)
_CONTEXTS = 1 << 12
_LEVELS = 8
_MOST = 60000
#: With both candidates at ``_MOST``, order 0 has 119,716 of 2**24 left to share out.
LARGEST_VOCABULARY = 1 << 16


class _Model:
    """Predictions for ``lanes`` blocks; ids are below ``vocabulary``."""

    def __init__(self, lanes: int, vocabulary: int, steps: int):
        self.vocabulary = vocabulary
        self.base_c = np.arange(lanes) * _CONTEXTS
        self.base_l = np.arange(lanes) * _LEVELS
        self.base_0 = np.arange(lanes) * steps
        # candidate * _LEVELS + confidence for each context; -1: none yet
        self.next2 = np.full(lanes * _CONTEXTS, -1, np.int32)
        self.next1 = np.full(lanes * _CONTEXTS, -1, np.int32)
        # how often candidates were right and looked up, by lane and confidence
        self.right = np.full((2, lanes * _LEVELS), 1.0)
        self.tried = np.full((2, lanes * _LEVELS), 6.0)
        self.share = np.zeros((2, lanes * _LEVELS), np.int64)
        self.shares()
        # order 0: the ids so far in order, and for each the first place and count of its run
        self.seen = 0
        self.sorted = np.zeros((lanes, steps), np.uint32)
        self.first = np.zeros((lanes, steps), np.uint16)
        self.count = np.zeros((lanes, steps), np.uint16)

    def shares(self) -> None:
        """16-bit shares of candidates by confidence; the most leaves every id a share."""
        part = self.right / self.tried * 65536
        np.clip(part.astype(np.int64), 64, _MOST, out=self.share)

    def contexts(self, last2, last):
        """Table places of both contexts; broadcast over lanes in the last axis."""
        mixed = last2 * 40503 + last * 2654435
        at2 = self.base_c + ((mixed ^ (mixed >> 13)) & (_CONTEXTS - 1))
        at1 = self.base_c + (((last * 40503) >> 4) & (_CONTEXTS - 1))
        return at2, at1

    def predict(self, last2, last):
        """Candidates, their shares of 2^24, and entries and places of both tables."""
        at2, at1 = self.contexts(last2, last)
        e2, e1 = self.next2[at2], self.next1[at1]
        cand2, cand1 = e2 >> 3, e1 >> 3
        share2 = self.share[0][self.base_l + (e2 & 7)]
        share2 *= e2 >= 0
        share1 = self.share[1][self.base_l + (e1 & 7)]
        share1 *= (e1 >= 0) & (cand1 != cand2)
        share1 = (65536 - share2) * share1 >> 8
        return cand2, cand1, share2 << 8, share1, e2, e1, at2, at1

    def units(self, before0):
        """Share of one count of order 0, and of one id not seen yet."""
        free = _ONE - before0
        fresh = free // (self.seen // 16 + 4) + self.vocabulary
        unit = (free - fresh) // max(self.seen, 1)
        return unit, (free - unit * self.seen) // self.vocabulary

    def learn(self, ids, cand2, cand1, share2, share1, e2, e1, at2, at1) -> None:
        """Take in a segment: all arrays are (steps, lanes).

        A candidate that was right gains confidence; one that was wrong gives way
        to the id that came. Of a context's several turns in a segment the last counts.
        """
        size = self.right.shape[1]
        fresh = (ids << 3).astype(np.int32)
        for order, (table, at, entry, cand, share) in enumerate(
            ((self.next2, at2, e2, cand2, share2), (self.next1, at1, e1, cand1, share1))
        ):
            hit = cand == ids
            level = entry & 7
            table[at] = np.where(hit, entry + (level < _LEVELS - 1), fresh)
            used = share > 0
            level = (self.base_l + level)[used]
            self.right[order] += np.bincount(level, hit[used], size)
            self.tried[order] += np.bincount(level, minlength=size)
        self.shares()

    def count_all(self, ids) -> None:
        """Order 0 over all ids so far: (steps, lanes)."""
        n = self.seen = len(ids)
        kind = np.uint16 if self.vocabulary <= 65536 else np.uint32
        ordered = np.sort(np.ascontiguousarray(ids.T, dtype=kind), axis=1, kind="stable")
        edge = np.ones((len(ordered), n), bool)
        edge[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        at = np.flatnonzero(edge)
        runs = np.diff(np.append(at, edge.size))
        self.sorted[:, :n] = ordered
        self.first[:, :n] = np.repeat(at % n, runs).reshape(ordered.shape)
        self.count[:, :n] = np.repeat(runs, runs).reshape(ordered.shape)

    def order0(self, ids):
        """First place and count of ids in order 0 (count 0: not seen): (steps, lanes)."""
        first, count = np.zeros(ids.shape, np.int64), np.zeros(ids.shape, np.int64)
        n = self.seen
        if n:
            asked = np.ascontiguousarray(ids.T, dtype=np.uint32)
            for k in range(ids.shape[1]):
                row = self.sorted[k, :n]
                at = row.searchsorted(asked[k])
                at[at == n] = 0
                first[:, k] = at
                count[:, k] = self.count[k][at] * (row[at] == asked[k])
        return first, count


def _segments(steps: int) -> list[tuple[int, int]]:
    return [(a, min(a + SEGMENT, steps)) for a in range(0, steps, SEGMENT)]


def _count_ends(steps: int) -> list[int]:
    """Steps after which order 0 counts anew."""
    return [n for n in (64, 128, 256, 512) if n < steps] + list(range(1024, steps, 1024))


def _encode_lanes(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    lanes, steps = len(blocks), max(map(len, blocks))
    ids = np.zeros((steps + 2, lanes), np.int64)  # after two zeros, the first context
    for k, block in enumerate(blocks):
        ids[2 : len(block) + 2, k] = block
    model = _Model(lanes, vocabulary, steps)
    out = np.zeros((lanes, steps + 4), np.uint32)
    used = np.zeros(lanes, np.int64)
    low, width = np.zeros(lanes, _U), np.full(lanes, _FULL)
    ends = [0, *_count_ends(steps), steps]
    for a, b in _segments(steps):
        if a in ends:
            until = ends[ends.index(a) + 1]
            firsts, counts = model.order0(ids[a + 2 : until + 2])
            since = a
        part = ids[a + 2 : b + 2]
        guess = model.predict(ids[a:b], ids[a + 1 : b + 1])
        cand2, cand1, share2, share1 = guess[:4]
        before0 = share2 + share1
        unit, fresh = model.units(before0)
        first, count = firsts[a - since : b - since], counts[a - since : b - since]
        seen = count > 0
        start = before0 + np.where(seen, first * unit, model.seen * unit + part * fresh)
        size = np.where(seen, count * unit, fresh)
        hit1 = (part == cand1) & (share1 > 0)
        start, size = np.where(hit1, share2, start), np.where(hit1, share1, size)
        hit2 = (part == cand2) & (share2 > 0)
        start, size = np.where(hit2, 0, start).astype(_U), np.where(hit2, share2, size).astype(_U)
        for t in range(b - a):
            width >>= _U(_SCALE)
            moved = low + width * start[t]
            carry = np.flatnonzero(moved < low)
            if len(carry):
                back = used[carry]
                while len(carry):  # one more in the word before, on while that overflows
                    back = back - 1
                    out[carry, back] += 1
                    over = out[carry, back] == 0
                    carry, back = carry[over], back[over]
            low = moved
            width *= size[t]
            move = np.flatnonzero(width < _LOWEST)
            if len(move):
                out[move, used[move]] = low[move] >> _WORD
                used[move] += 1
                low[move] <<= _WORD
                width[move] <<= _WORD
        model.learn(part, *guess)
        if b in ends[:-1]:
            model.count_all(ids[2 : b + 2])
    row = np.arange(lanes)
    for _ in range(2):
        out[row, used] = low >> _WORD
        used += 1
        low <<= _WORD
    return [out[k, :n].astype("<u4").tobytes() for k, n in enumerate(used.tolist())]


def _decode_lanes(codes: list[bytes], sizes: list[int], vocabulary: int) -> list[np.ndarray]:
    lanes, steps = len(codes), max(sizes)
    length = max(len(c) // 4 for c in codes) + 4
    data = np.zeros((lanes, length), _U)
    for k, code in enumerate(codes):
        data[k, : len(code) // 4] = np.frombuffer(code, "<u4")
    data = data.reshape(-1)
    ids = np.zeros((steps + 2, lanes), np.int64)
    model = _Model(lanes, vocabulary, steps)
    sorted0, first0, count0 = (x.reshape(-1) for x in (model.sorted, model.first, model.count))
    at = np.arange(lanes) * length
    stop = at + length - 1
    ahead = (data[at] << _WORD) | data[at + 1]  # the code less the low end of the range
    at += 2
    width = np.full(lanes, _FULL)
    most = _U(_ONE - 1)
    # below 2^24 a float quotient cut to an integer is exact
    ends = _count_ends(steps)
    for a, b in _segments(steps):
        seen = model.seen
        kept = []
        for t in range(a, b):
            guess = model.predict(ids[t], ids[t + 1])
            cand2, cand1, share2, share1 = guess[:4]
            before0 = share2 + share1
            unit, fresh = model.units(before0)
            width >>= _U(_SCALE)
            target = np.minimum(ahead // width, most).astype(np.int64)
            place = target - before0
            rest = place - unit * seen
            if seen:
                slot = model.base_0 + np.clip((place / unit).astype(np.int64), 0, seen - 1)
                old = rest < 0
                fresh_id = np.minimum((rest / fresh).astype(np.int64), vocabulary - 1)
                found = np.where(old, sorted0[slot], fresh_id)
                start = before0 + np.where(old, first0[slot] * unit, seen * unit + found * fresh)
                size = np.where(old, count0[slot] * unit, fresh)
            else:
                found = np.minimum((rest / fresh).astype(np.int64), vocabulary - 1)
                start, size = before0 + found * fresh, fresh
            by1 = target < before0
            if by1.any():
                by2 = target < share2
                found = np.where(by1, np.where(by2, cand2, cand1), found)
                start = np.where(by1, np.where(by2, 0, share2), start)
                size = np.where(by1, np.where(by2, share2, share1), size)
            ahead -= width * start.astype(_U)
            width *= size.astype(_U)
            move = np.flatnonzero(width < _LOWEST)
            if len(move):
                place = at[move]
                ahead[move] = (ahead[move] << _WORD) | data[np.minimum(place, stop[move])]
                width[move] <<= _WORD
                at[move] = place + 1
            ids[t + 2] = found
            kept.append(guess)
        model.learn(ids[a + 2 : b + 2], *map(np.stack, zip(*kept, strict=True)))
        if b in ends:
            model.count_all(ids[2 : b + 2])
    return [ids[2 : n + 2, k].astype("<u4") for k, n in enumerate(sizes)]


def encode_blocks(ids: np.ndarray, vocabulary: int, block_ids: int = BLOCK_IDS) -> list[tuple]:
    """(number of ids, crc32 of the ids, code) of each block of ``ids`` in order."""
    if vocabulary > LARGEST_VOCABULARY:
        raise ValueError(f"vocabulary is {vocabulary}, at most {LARGEST_VOCABULARY} can be coded")
    blocks = [ids[a : a + block_ids] for a in range(0, len(ids), block_ids)]
    out = []
    for a in range(0, len(blocks), LANES):
        group = blocks[a : a + LANES]
        for block, code in zip(group, _encode_lanes(group, vocabulary), strict=True):
            out.append((len(block), zlib.crc32(block.astype("<u4").tobytes()), code))
    return out


def decode_blocks(blocks: list[tuple], vocabulary: int) -> np.ndarray:
    """The ids of blocks as ``encode_blocks`` gave them; a damaged block is an error."""
    parts = []
    for a in range(0, len(blocks), LANES):
        group = blocks[a : a + LANES]
        found = _decode_lanes([b[2] for b in group], [b[0] for b in group], vocabulary)
        for k, (ids, block) in enumerate(zip(found, group, strict=True)):
            if zlib.crc32(ids.tobytes()) != block[1]:
                raise ValueError(f"block {a + k} does not match its checksum")
            parts.append(ids)
    return np.concatenate(parts) if parts else np.zeros(0, "<u4")
