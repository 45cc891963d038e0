"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Base patterns give spans that always stay: e-mail addresses, IPv4 addresses, card
numbers that pass Luhn's check, and phone numbers with a leading plus. Beside them,
wide generators propose overlapping spans: addresses spelled with "at" and "dot",
dotted numbers, digit chains with other marks, phone numbers without a plus. Some
proposals decide themselves (a chain of 16 digits passes the check or fails it; a
dotted number has a part over 255); these are the labelled ones. Boosted trees learn
from them, by format and context features that don't see the deciding mark, and score
the undecided ones. A kind's threshold is the lowest of ``LIKELY`` and more at which the
labelled proposals of documents kept from training (crc32 of doc_id mod 4 is 2) are
right in ``PRECISION`` of the cases; a kind with fewer than ``FEWEST`` of either label there
adds nothing. Spans that overlap form a cluster, in which base spans stay, or else the
best added one.

Scale: one narrow pass over the texts writes the spans of each row, with some
characters around them; all else reads that table. Training needs the counts per cell
of the feature grid, at most ``CELLS`` rows whatever the corpus (features are binned),
over all documents; the trees grow on the driver from these and are SQL expressions in
the scoring pass. Only spans above the threshold, and base spans, are shuffled, by row.
Patterns run in linear time: possessive, and entered at the start of a run only.

Defined results: null and empty texts have no spans; rows with equal or null doc_ids
are rows of their own (null ids train); equal texts have equal spans; an empty table
has no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignlake.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
LIKELY = 0.5
FEWEST = 20
ROUNDS = 30
RATE = 0.3
_BEFORE, _AFTER = 24, 12

# Leftmost non-overlapping matches of the plain patterns: a match starts a run or follows one.
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:@| ?[\[(](?i:at)[\])] ?| (?i:at) )", r"(?:\.| ?[\[(](?i:dot)[\])] ?| (?i:dot) )"
WIDE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:(?:\.|[\[(]\.[\])]| ?[\[(](?i:dot)[\])] ?)[0-9]++){2,}+",
    "card": r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){12,}+",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9][0-9() ./-]{5,}[0-9]",
}
_DATE = r"^(?:[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{4})$"

# Words that tell what a number near them is, fixed values.
CONTEXTS = (
    r"phone|tel\b|tel[.:]|call|mobile|cell|fax|whatsapp|contact|reach",
    r"mail|write to|address",
    r"card|visa|master|credit|debit|pay|amex",
    r"\bip\b|host|server|addr|login|connect",
    r"order|invoice|ref|serial|version|\bv$|isbn|sku|page|date|total|sum|price|[$€£]|\bid\b|no[.:]",
)
#: Features of a proposal and how many values each has.
FEATURES = {
    "kind": 4, "digits": 10, "groups": 6, "marks": 6, "before": 4, "after": 4, "context": 6, "tail": 5,
}
#: E-mail proposals have one value of ``digits`` and ``groups``, others one of ``tail``.
CELLS = 2 * 2 * (6 * 4 * 4 * 6 * 5 + 3 * 10 * 6 * 6 * 4 * 4 * 6)
_BLOCK = 256

_SPAN = "array<struct<kind:int,start:bigint,end:bigint>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x)


def _once(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``frame`` with more columns, computed once a row also if a lambda reads them.

    A projection may be merged into the next one, and then into the body of a lambda,
    which is evaluated for each element; a generator of one row is never merged.
    """
    values = F.struct(*(c.alias(n) for n, c in columns.items()))
    return frame.select("*", F.inline(F.array(values)))


# The place of the i-th match: the lengths of what comes before, summed by whole blocks
# and then within its block, so that a text with many matches takes no squared time.
def _steps(name: str) -> Column:
    pieces = F.col(f"p_{name}")
    return F.transform(f"m_{name}", lambda m, i: (F.length(pieces[i]) + F.length(m)).cast("long"))


def _block_sums(name: str) -> Column:
    steps = F.col(f"s_{name}")
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: _sum(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))))
    return F.when(F.size(steps) > 0, sums)


def _before_blocks(name: str) -> Column:
    sums = F.col(f"t_{name}")
    return F.transform(sums, lambda _, b: _sum(F.slice(sums, F.lit(1), b)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes Luhn's check."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, size - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def base_valid(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern is a base span."""
    if kind == "ip":
        return match.rlike(_IP)
    if kind == "card":
        return _is_card(match)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row: row, doc_id, base (spans), proposed (spans with their text and context)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    frame = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    )
    patterns = {f"{name}_{kind}": p for name, of in (("base", BASE), ("wide", WIDE)) for kind, p in of.items()}
    frame = _once(frame, {f"m_{n}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for n, p in patterns.items()})
    frame = _once(frame, {f"p_{n}": F.when(F.size(f"m_{n}") > 0, F.split("text", p, -1)) for n, p in patterns.items()})
    frame = _once(frame.drop("text"), {f"s_{n}": _steps(n) for n in patterns})
    frame = _once(frame, {f"t_{n}": _block_sums(n) for n in patterns})
    frame = _once(frame, {f"b_{n}": _before_blocks(n) for n in patterns})

    def spans(name: str, wide: bool) -> Column:
        m, p, s, b = (F.col(f"{x}_{name}") for x in "mpsb")
        kind = KINDS.index(name.split("_")[1])

        def span(match: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            inside = _sum(F.slice(s, block * _BLOCK + 1, i % _BLOCK + 1))
            end = b[block] + inside
            fields = [
                F.lit(kind).alias("kind"),
                (end - F.length(match)).alias("start"),
                end.alias("end"),
            ]
            if wide:
                left, right = p[i], p[i + 1]
                fields += [
                    match.alias("match"),
                    F.right(left, F.lit(_BEFORE)).alias("left"),
                    F.left(right, F.lit(_AFTER)).alias("right"),
                ]
            else:
                fields.append(base_valid(KINDS[kind], match).alias("valid"))
            return F.struct(*fields)

        return F.coalesce(F.transform(m, span), F.array())

    base = F.filter(F.concat(*(spans(f"base_{k}", False) for k in KINDS)), lambda x: x["valid"])
    base = F.transform(base, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    wide = F.concat(*(spans(f"wide_{k}", True) for k in KINDS))
    return frame.select("row", "doc_id", base.alias("base"), wide.alias("proposed"))


def _bin(value: Column, bounds: list[int]) -> Column:
    """How many of the bounds a value reaches."""
    return sum((F.when(value >= b, 1).otherwise(0) for b in bounds), F.lit(0))


def _side(char: Column) -> Column:
    """0 end or line end, 1 blank, 2 letter or digit, 3 other."""
    return (
        F.when((char == "") | char.isin("\n", "\r"), 0)
        .when(char.isin(" ", "\t"), 1)
        .when(char.rlike(r"[\p{L}\p{N}]"), 2)
        .otherwise(3)
    )


def decided(kind: Column, match: Column) -> Column:
    """1 for a proposal that is personal data for sure, 0 for one that isn't, else null."""
    last = F.substring_index(match, ".", -1)
    email = F.when(F.contains(match, F.lit("@")), last.rlike("^[A-Za-z]{2,}$").cast("int"))
    ip = F.when(match.rlike(r"^[0-9.]+$"), match.rlike(_IP).cast("int"))
    digits, plain = _digits(match), match.rlike(r"^[0-9](?:[ -]?[0-9])++$")
    sure = F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    card = F.when(~sure, 0).when(plain & F.length(digits).between(16, 19), 1)
    phone = F.when(match.startswith("+"), F.length(digits).between(8, 15).cast("int")).when(
        match.rlike(_DATE) | match.rlike(_IP) | ~F.length(digits).between(7, 15), 0
    )
    return F.when(kind == 0, email).when(kind == 1, ip).when(kind == 2, card).otherwise(phone)


def proposals(found: DataFrame) -> DataFrame:
    """A row per proposed span with its features and, where it decides itself, its label."""
    rows = found.select("row", "doc_id", F.explode("proposed").alias("x")).select("row", "doc_id", "x.*")
    match, email = F.col("match"), F.col("kind") == 0
    runs = F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))
    marks = F.regexp_replace(match, r"[0-9A-Za-z+@%_]", "")
    context = F.lit(0)
    for k, words in reversed(list(enumerate(CONTEXTS, 1))):
        context = F.when(F.col("left").rlike(f"(?i)(?:{words})"), k).otherwise(context)
    features = {
        "digits": F.when(email, 0).otherwise(_bin(F.length(_digits(match)), [5, 7, 8, 9, 10, 11, 13, 16, 17])),
        "groups": F.when(email, 0).otherwise(_bin(F.size(runs), [1, 2, 3, 4, 5])),
        "marks": F.when(marks == "", 0)
        .when(marks.rlike(r"^\.+$"), 1)
        .when(marks.rlike("^-+$"), 2)
        .when(marks.rlike("^ +$"), 3)
        .when(marks.rlike(r"[\[(]"), 4)
        .otherwise(5),
        "before": _side(F.right("left", F.lit(1))),
        "after": _side(F.left("right", F.lit(1))),
        "context": context,
        "tail": F.when(email, _bin(F.length(F.regexp_extract("match", "[A-Za-z]*$", 0)), [1, 2, 3, 7])).otherwise(0),
    }
    return rows.select(
        "row",
        "doc_id",
        "kind",
        "start",
        "end",
        *(c.cast("int").alias(n) for n, c in features.items()),
        decided(F.col("kind"), match).alias("label"),
    )


@dataclass
class Tree:
    """A split (feature, greatest value that goes left) over two trees, or a leaf's value."""

    value: float = 0.0
    feature: int = -1
    bound: int = 0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.bound, self.left.predict(x), self.right.predict(x))

    def sql(self) -> str:
        if self.left is None:
            return f"{self.value!r}D"
        name = list(FEATURES)[self.feature]
        return f"CASE WHEN {name} <= {self.bound} THEN {self.left.sql()} ELSE {self.right.sql()} END"


def _grow(x: np.ndarray, pull: np.ndarray, weight: np.ndarray, depth: int, least: float = 1.0) -> Tree:
    """The tree that follows the gradient ``pull`` best, by sums per feature value."""
    total, mass = pull.sum(), weight.sum()
    best, split = total**2 / (mass + least) + 1e-9, None
    for f, values in enumerate(FEATURES.values() if depth else ()):
        g = np.cumsum(np.bincount(x[:, f], pull, values))[:-1]
        h = np.cumsum(np.bincount(x[:, f], weight, values))[:-1]
        gain = g**2 / (h + least) + (total - g) ** 2 / (mass - h + least)
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, split = gain[at], (f, at)
    if split is None:
        return Tree(RATE * float(total / (mass + least)))
    go = x[:, split[0]] <= split[1]
    sides = [_grow(x[s], pull[s], weight[s], depth - 1, least) for s in (go, ~go)]
    return Tree(0.0, *split, *sides)


@dataclass
class Booster:
    """Logistic boosting over cells, with a threshold per kind (None: the kind adds nothing)."""

    start: float
    trees: list[Tree]
    thresholds: dict[int, float | None]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def score(self) -> Column:
        parts = " + ".join([f"{self.start!r}D", *(t.sql() for t in self.trees)])
        return 1 / (1 + F.exp(-F.expr(parts)))


def boost(x: np.ndarray, y: np.ndarray, times: np.ndarray, rounds: int = ROUNDS, depth: int = 3) -> Booster:
    """Trees for cells ``x`` with labels ``y`` that occur ``times``."""
    share = (times[y == 1].sum() + 1) / (times.sum() + 2)
    booster = Booster(float(np.log(share / (1 - share))), [], {})
    margin = booster.margin(x)
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, times * (y - p), times * p * (1 - p), depth)
        booster.trees.append(tree)
        margin = margin + tree.predict(x)
    return booster


def calibrate(booster: Booster, x, y, times, precision: float = PRECISION) -> None:
    """Each kind's lowest threshold with that precision on the held-out cells."""
    scores = 1 / (1 + np.exp(-booster.margin(x)))
    for kind in range(len(KINDS)):
        of = x[:, 0] == kind
        booster.thresholds[kind] = None
        if min(times[of & (y == 1)].sum(), times[of & (y == 0)].sum()) < FEWEST:
            continue
        values = np.unique(scores[of])[::-1]
        for value in values.tolist():
            above = of & (scores >= value)
            if times[above & (y == 1)].sum() >= precision * times[above].sum():
                booster.thresholds[kind] = max(value, LIKELY)
            else:
                break


def fit(found: DataFrame, precision: float = PRECISION) -> Booster:
    """A booster from the labelled proposals of ``find_spans``."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    cells = (
        proposals(found)
        .where(F.col("label").isNotNull())
        .groupBy(*FEATURES, "label", held.alias("held"))
        .agg(F.count("*").alias("times"))
        .collect()
    )
    cells.sort()
    table = np.array([tuple(map(int, c)) for c in cells], np.int64).reshape(-1, len(FEATURES) + 3)
    x, (y, held_out, times) = table[:, : len(FEATURES)], table[:, len(FEATURES) :].T
    train = held_out == 0
    booster = boost(x[train], y[train], times[train].astype(float))
    calibrate(booster, x[~train], y[~train], times[~train].astype(float), precision)
    return booster


def added_spans(found: DataFrame, booster: Booster) -> DataFrame:
    """row, added: the spans that the booster adds to a row's base spans."""
    least = F.lit(None).cast("double")
    for kind, value in booster.thresholds.items():
        if value is not None:
            # sums in another order may differ in the last bits
            least = F.when(F.col("kind") == kind, value - 1e-9).otherwise(least)
    undecided = proposals(found).where(F.col("label").isNull())
    good = undecided.withColumn("score", booster.score()).where(F.col("score") >= least)
    good = good.select("row", "kind", "start", "end", "score", F.lit(False).alias("base"))
    base = found.select("row", F.explode("base").alias("x")).select(
        "row", "x.kind", "x.start", "x.end", F.lit(2.0).alias("score"), F.lit(True).alias("base")
    )
    ordered = Window.partitionBy("row").orderBy("start", "end", "kind", "base")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    spans = good.unionByName(base).withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    spans = spans.withColumn("cluster", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    first = Window.partitionBy("row", "cluster").orderBy(
        F.desc("score"), F.desc(F.col("end") - F.col("start")), "start", "kind"
    )
    best = spans.withColumn("place", F.row_number().over(first)).where("place = 1 AND NOT base")
    return best.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))


def _named(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(one, ",")


def personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per row: doc_id, base and all spans (kind, start, end) sorted, and both as text.

    ``base_spans`` and ``spans`` are kind:start:end in code points, comma-joined.
    """
    found = materialize(find_spans(docs), "personal-data")
    added = added_spans(found, fit(found, precision))
    out = found.select("row", "doc_id", "base").join(added, "row", "left")
    every = F.concat("base", F.coalesce("added", F.array().cast(_SPAN)))
    out = out.select("doc_id", "base", F.array_sort(every).alias("all"))
    return out.select("*", _named(F.col("base")).alias("base_spans"), _named(F.col("all")).alias("spans"))


def count_of(kind: str, spans: str = "base") -> Column:
    """How many of a row's spans are of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def redact(text: Column, spans: Column, mask: str = "[{}]") -> Column:
    """``text`` with each span (sorted by start, disjoint) replaced by its kind's name."""
    names = F.array(*(F.lit(mask.format(k.upper())) for k in KINDS))
    edges = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def put(state: Column, x: Column) -> Column:
        gap = F.substr(text, (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        return F.struct(
            F.when(x["start"] >= state["at"], F.concat(state["out"], gap, names[x["kind"]])).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], x["end"]).alias("at"),
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(edges, begin, put, lambda s: F.concat(s["out"], F.substr(text, (s["at"] + 1).cast("int"))))
