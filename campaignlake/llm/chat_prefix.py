"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only the reply (with its closing mark) is trainable. Turns after the
last assistant turn, or a conversation without one, give a last example without a
target, so that nothing of a conversation is lost.

Template of a turn: ``<|im_start|>``, role, newline, text, ``<|im_end|>``, newline. Control
strings inside roles and texts are escaped by a backslash after their first
character; one that already has backslashes there gets one more, which makes the
escape reversible. The marks of other common templates are escaped too. An example
keeps its target as code-point offsets [loss_start, loss_end) into its text.

Scale: turns are partitioned by conversation and sorted by turn; a task streams over
them and holds one conversation's formatted text. An example's text can't be
shorter than its context, so examples of one conversation grow with the square of
its turns: this is the method's output, and it is made row by row, never held.

Defined results: null text and null role are empty; a conversation's rows go by turn
(null first), then role, then text, and repeated rows are turns of their own; rows
with a null conv_id are one conversation; an empty table has no examples; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
_BATCH_CHARS = 8_000_000

# after the first character: backslashes, then the rest of a control string
_CONTROL = r"\|im_start\|>|\|im_end\|>|/?s>|<SYS>>|</SYS>>"
_BRACKET = r"/?INST\]"
_PLAIN = re.compile(rf"<(\\*)(?={_CONTROL})|\[(\\*)(?={_BRACKET})")
_ESCAPED = re.compile(rf"<\\(\\*)(?={_CONTROL})|\[\\(\\*)(?={_BRACKET})")
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE), re.DOTALL)

_EXAMPLES = (
    "conv_id long, example int, n_turns long, final boolean, text string,"
    " loss_start long, loss_end long"
)
_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, examples long"
)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: f"{m[0][0]}\\{m[1] or m[2] or ''}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[0][0]}{m[1] or m[2] or ''}", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def format_turn(role: str | None, text: str | None) -> tuple[str, int]:
    """A turn in the template, and where its text starts."""
    head = f"{OPEN}{_escape_role(role or '')}\n"
    return f"{head}{escape(text or '')}{CLOSE}", len(head)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text; anything else in it is an error."""
    turns, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        turns.append((_unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"text at {at} is not a turn")
    return turns


def _key(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _expand(trained: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        conv, began, text, turns, example, open_ = None, False, "", 0, 0, False

        def finish() -> None:
            if began and open_:
                rows.append((conv, example, turns, True, text, None, None))
            elif began:  # the last example has all turns
                rows[-1] = (*rows[-1][:3], True, *rows[-1][4:])

        def taken() -> pd.DataFrame:
            names = [c.split()[0] for c in _EXAMPLES.split(", ")]
            kinds = dict.fromkeys(("conv_id", "loss_start", "loss_end"), "Int64")
            frame = pd.DataFrame(rows, columns=names).astype(kinds)
            rows.clear()
            return frame

        for frame in frames:
            for key, role, said in zip(frame["conv_id"], frame["role"], frame["text"], strict=True):
                if not began or _key(key) != conv:
                    finish()
                    if held > _BATCH_CHARS:
                        yield taken()
                        held = 0
                    conv, began, text, turns, example, open_ = _key(key), True, "", 0, 0, False
                elif held > _BATCH_CHARS and len(rows) > 1:  # the last may yet be the final one
                    last = rows.pop()
                    yield taken()
                    rows.append(last)
                    held = 0
                turn, head = format_turn(role, said)
                start = len(text) + head
                text, turns, open_ = text + turn, turns + 1, True
                if role == trained:
                    end = len(text) - 1  # with the closing mark, without its newline
                    rows.append((conv, example, turns, False, text, start, end))
                    example, open_ = example + 1, False
                    held += len(text)
        finish()
        yield taken()

    return run


def expand(turns: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """One row per example: conv_id, example, n_turns, final, text, loss_start, loss_end."""
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text",
    )
    ordered = source.repartition(tasks, "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )
    return ordered.mapInPandas(_expand(trained), _EXAMPLES)


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    close = CLOSE.rstrip("\n")
    conv, began, rows = None, False, []
    loss, loss_chars, chars, examples = hashlib.sha256(), 0, 0, 0
    for frame in frames:
        for key, turns, final, text, start, end in zip(
            *(frame[c] for c in ("conv_id", "n_turns", "final", "text", "loss_start", "loss_end")),
            strict=True,
        ):
            if not began:
                conv, began = _key(key), True
                loss, loss_chars, chars, examples = hashlib.sha256(), 0, 0, 0
            chars, examples = chars + len(text), examples + 1
            if not pd.isna(start):
                said = text[int(start) : int(end)]
                if not said.endswith(close):
                    raise ValueError(f"the target of conversation {conv} is not a whole reply")
                said = unescape(said[: -len(close)])
                loss_chars += len(said)
                loss.update(said.encode("utf-8", "surrogatepass"))
            if final:
                said = read_turns(text)
                if len(said) != turns:
                    raise ValueError(f"conversation {conv} has {turns} turns, {len(said)} were read")
                every = "".join(f"{role}\n{words}\n" for role, words in said)
                digest = hashlib.sha256(every.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((conv, turns, digest, loss_chars, loss.hexdigest(), chars, examples))
                began = False
        names = [c.split()[0] for c in _DIGESTS.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
        rows.clear()


def read_back(examples: DataFrame) -> DataFrame:
    """Digests per conversation, read from the examples of ``expand`` as they come."""
    return examples.mapInPandas(_digest, _DIGESTS)
