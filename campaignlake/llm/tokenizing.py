"""Token ids of texts, encoded stretch by stretch with the tokenizers library.

A byte-level or word BPE never merges across white space, so a text's ids are
those of its stretches (a run of other characters, with the blank before it where
the vocabulary keeps blanks) one after another. Frequent stretches are encoded
once per task and then taken from a table of bounded size.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
from tokenizers import Tokenizer

from campaignlake.llm.common import keep_in_worker

# Python's \s is Unicode's White_Space and the separators 1C to 1F, which the
# vocabularies take for ordinary characters; texts with these are cut by _SPACE.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = "\t\n\v\f\r \x85\xa0  -     　"
# a vocabulary that keeps blanks has a blank with the word after it
_KEEPING = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_KEEPING_EXACT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_DROPPING_EXACT = re.compile(f"[^{_SPACE}]+")


def stretches(text: str, keep_blanks: bool) -> list[str]:
    if _SEPARATORS.search(text):
        return (_KEEPING_EXACT if keep_blanks else _DROPPING_EXACT).findall(text)
    return _KEEPING.findall(text) if keep_blanks else text.split()


_TABLE_ENTRIES = 1_000_000
_LONGEST_ENTRY = 64


class IdTable(dict):
    """Stretch -> its ids as little-endian unsigned 32-bit bytes; of bounded size."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()

    def encode(self, wanted: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(wanted, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def learn(self, wanted: set[str]) -> list[str]:
        """Encode the stretches not in the table yet, all at once; the long ones of them."""
        if len(self) > _TABLE_ENTRIES:
            self.clear()
        new = list(wanted.difference(self))
        self.update(zip(new, self.encode(new), strict=True))
        return [s for s in new if len(s) > _LONGEST_ENTRY]


class Encoder:
    """Encodes whole texts."""

    def __init__(self, path: str, keep_blanks: bool, end_id: int):
        # the tasks of a Python worker share its table
        self.table = keep_in_worker(f"ids of {path}", lambda: IdTable(path))
        self.keep_blanks = keep_blanks
        self.end = np.array([end_id], "<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 32-bit bytes."""
        cut = [stretches(t, self.keep_blanks) if t else [] for t in texts]
        once = self.table.learn(set().union(*cut))
        get = self.table.__getitem__
        ids = [b"".join(map(get, c)) + self.end for c in cut]
        for stretch in once:  # the table keeps short stretches only
            del self.table[stretch]
        return ids
