"""Fill-in-the-middle examples, cut at boundaries held in a compressed set.

The offsets at which a text may be cut (byte offsets of its code points, words or
lines, and its end) are a boundary set: offsets are dealt by their upper 48 bits to
containers, and a container holds its low 16 bits as an array (few), a bitmap (many)
or runs (consecutive ones), whichever takes the fewest bytes. Cumulated cardinalities
find the container of the k-th boundary by bisection; a local select in it gives the
offset. Cutting at the k-th code point is then a select and a slice of the UTF-8 bytes:
a text of ASCII letters is a single run however long it is.

A text is cut at two of its boundaries drawn by hashes of its doc_id, and written as
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``) behind sentinels; a
share of texts stays ``plain``. ``restored`` rebuilds the text from output and form.

Scale: a text is transformed where it is read; nothing is shuffled or broadcast, and
memory is bounded by an Arrow batch and its longest text.

Defined results: null and empty texts, and texts that hold a sentinel, are plain with
null cut columns; a null doc_id draws like an empty one; equal rows give equal rows; an
empty table has no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
TRANSFORMED_PERCENT = 90
SPM_PERCENT = 20

_CHUNK = 1 << 16
_MOST_IN_ARRAY = 4096  # 2 bytes each: as large as a bitmap of 65536 bits


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, value: int) -> int:
        """Members below ``value``."""
        return int(np.searchsorted(self.low, value))


class BitmapContainer:
    """A bit for each 16-bit value, and the members before each word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_CHUNK, np.uint8)
        bits[low] = 1
        self.bits = np.packbits(bits, bitorder="little")
        words = bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate(([0], np.cumsum(words)))

    def _word(self, k: int) -> np.ndarray:
        return np.unpackbits(self.bits[8 * k : 8 * k + 8], bitorder="little")

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        return 64 * word + int(np.flatnonzero(self._word(word))[k - int(self.before[word])])

    def rank(self, value: int) -> int:
        word, bit = divmod(value, 64)
        return int(self.before[word]) + (int(self._word(word)[:bit].sum()) if bit else 0)


class RunContainer:
    """First values of runs, and the members before each run."""

    def __init__(self, first: np.ndarray, lengths: np.ndarray):
        self.first = first.astype(np.uint16)
        self.before = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])

    def rank(self, value: int) -> int:
        run = int(np.searchsorted(self.first, value, side="right")) - 1
        if run < 0:
            return 0
        begun, ended = int(self.before[run]), int(self.before[run + 1])
        return begun + min(value - int(self.first[run]), ended - begun)


def _container(low: np.ndarray):
    """The smallest container for sorted 16-bit values (at least one)."""
    edges = np.flatnonzero(np.diff(low) != 1) + 1
    plain = 2 * len(low) if len(low) <= _MOST_IN_ARRAY else _CHUNK // 8
    if 4 * (len(edges) + 1) < plain:
        starts = np.concatenate(([0], edges))
        return RunContainer(low[starts], np.diff(np.append(starts, len(low))))
    return ArrayContainer(low) if len(low) <= _MOST_IN_ARRAY else BitmapContainer(low)


class BoundarySet:
    """A set of non-negative offsets with rank and select."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` are sorted and distinct."""
        high = offsets >> 16
        cuts = np.flatnonzero(np.diff(high)) + 1
        starts = np.concatenate(([0], cuts)) if len(offsets) else np.zeros(0, np.int64)
        self.keys = high[starts].tolist()
        self.cumulated = [*starts.tolist(), len(offsets)]
        ends = self.cumulated[1:]
        self.containers = [
            _container(offsets[a:b] & (_CHUNK - 1)) for a, b in zip(starts.tolist(), ends, strict=True)
        ]

    def __len__(self) -> int:
        return self.cumulated[-1]

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = bisect_right(self.cumulated, k) - 1
        return (self.keys[at] << 16) + self.containers[at].select(k - self.cumulated[at])

    def rank(self, offset: int) -> int:
        """How many offsets are smaller than ``offset``."""
        at = bisect_right(self.keys, offset >> 16) - 1
        if at < 0:
            return 0
        if self.keys[at] < offset >> 16:
            return self.cumulated[at + 1]
        return self.cumulated[at] + self.containers[at].rank(offset & (_CHUNK - 1))


def character_boundaries(data: np.ndarray) -> np.ndarray:
    """Byte offsets of the code points of UTF-8 ``data``, and its end."""
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def word_boundaries(data: np.ndarray) -> np.ndarray:
    """The start, the ends of words (stretches between ASCII white space), and the end."""
    blank = np.isin(data, (9, 10, 11, 12, 13, 32))
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    return np.unique(np.concatenate(([0], ends, [len(data)])))


def line_boundaries(data: np.ndarray) -> np.ndarray:
    """The start, the places after line feeds, and the end."""
    return np.unique(np.concatenate(([0], np.flatnonzero(data == 10) + 1, [len(data)])))


BOUNDARIES: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "characters": character_boundaries,
    "words": word_boundaries,
    "lines": line_boundaries,
}


def draws(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit draws of a document."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut(data: bytes, first: int, second: int, units: str) -> tuple[int, int, BoundarySet]:
    """Byte offsets of two cuts, at the boundaries that two draws name."""
    allowed = BoundarySet(BOUNDARIES[units](np.frombuffer(data, np.uint8)))
    ranks = sorted((first % len(allowed), second % len(allowed)))
    return allowed.select(ranks[0]), allowed.select(ranks[1]), allowed


_P, _S, _M = (s.encode() for s in SENTINELS)
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_OUT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", pa.string())]
)


def _characters(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _transform(units: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            forms = batch.column("form").to_pylist()
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            rows: dict[str, list] = {k: [] for k in ("n", "prefix_chars", "middle_chars", "output")}
            for data, form, first, second in zip(texts, forms, h1, h2, strict=True):
                if form == "plain":
                    rows["n"].append(_characters(data))
                    rows["prefix_chars"].append(None)
                    rows["middle_chars"].append(None)
                    rows["output"].append(data)
                    continue
                a, b, allowed = cut(data, first, second, units)
                if units == "characters":
                    n, prefix, both = len(allowed) - 1, allowed.rank(a), allowed.rank(b)
                else:
                    n, prefix, both = _characters(data), _characters(data[:a]), _characters(data[:b])
                rows["n"].append(n)
                rows["prefix_chars"].append(prefix)
                rows["middle_chars"].append(both - prefix)
                head, tail = _P + data[:a], _S + data[b:]
                rows["output"].append((head + tail if form == "psm" else tail + head) + _M + data[a:b])
            columns = [
                batch.column("doc_id"),
                pa.array(rows["n"], pa.int64()),
                batch.column("form"),
                pa.array(rows["prefix_chars"], pa.int64()),
                pa.array(rows["middle_chars"], pa.int64()),
                pa.array(rows["output"], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_OUT_ARROW)

    return run


def fill_in_middle(docs: DataFrame, units: str = "characters", seed: str = "1") -> DataFrame:
    """Per row: doc_id, n (code points), form, prefix_chars, middle_chars, output."""
    if units not in BOUNDARIES:
        raise ValueError(f"units is {units!r}, one of {sorted(BOUNDARIES)} is needed")
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    h1, h2, h3, h4 = draws(doc_id, seed)
    held = F.lit(False)
    for sentinel in SENTINELS:
        held = held | F.contains(text, F.lit(sentinel))
    plain = (text == "") | held | (h3 % 100 >= TRANSFORMED_PERCENT)
    form = F.when(plain, "plain").when(h4 % 100 < SPM_PERCENT, "spm").otherwise("psm")
    source = docs.select(
        doc_id.alias("doc_id"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2")
    )
    return source.mapInArrow(_transform(units), _OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    No part of a transformed text holds a sentinel, and none can arise where a part
    meets a sentinel, so the first of each is the one that was written.
    """
    p, s, m = (F.locate(mark, output) for mark in SENTINELS)
    size = len(MIDDLE)
    middle = F.substr(output, m + size)
    prefix = F.substr(output, p + size, F.when(form == "psm", s).otherwise(m) - p - size)
    suffix = F.substr(output, s + size, F.when(form == "psm", m).otherwise(p) - s - size)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
