"""Decontamination, language, toxicity, extraction and chat formatting."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from campaignlake.llm import backoff_langid, chat_prefix, mincut_html, toxicity, winnowing
from campaignlake.llm.common import table, word_bytes

DOCS = "doc_id long, text string"
SF = "/root/testdata/sf0.01"


# ---- winnowing -----------------------------------------------------------------


def _brute(docs, items, span=10):
    out = []
    for doc_id, text in docs:
        words, hit, named = word_bytes(text), set(), set()
        for item_id, item in items:
            w = word_bytes(item)
            n = min(span, len(w))
            for a in range(len(w) - n + 1) if n else ():
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == w[a : a + n]:
                        hit.update(range(p, p + n))
                        if item_id is not None:
                            named.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def shared_spans():
    rng = random.Random(8)
    words = ["A", "b", "ç", "d1", "e"]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 4, 9, 10, 11, 30])))) for k in range(12)]
    items += [(3, items[0][1]), (None, "b b b b b"), (77, None), (78, ""), (79, "--"), (80, items[1][1].upper())]
    docs = []
    for k in range(40):
        parts = rng.choices(words, k=rng.choice([0, 3, 12, 60]))
        if k % 2:
            w = rng.choice(items)[1] or ""
            parts += w.split()[: rng.choice([5, 9, 10, 30])] + rng.choices(words, k=4)
        docs.append((k, ", ".join(parts)))
    return [*docs, (None, None), (0, docs[1][1]), (5, "a-b " * 50)], items


@pytest.mark.parametrize("block_words", [4_000_000, 20])
def test_contamination_matches_brute_force(spark, shared_spans, block_words):
    docs, items = shared_spans
    frame = spark.createDataFrame([(*r, 1, 2) for r in docs], DOCS + ", row int, items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.contamination(frame, bench, block_words=block_words).collect()
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got]
    assert sorted(rows, key=str) == _brute(docs, items)
    kept = winnowing.drop_contaminated(frame, bench, block_words=block_words)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows if not r[5])


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert winnowing.contamination(docs, items).first()["n_hit"] == 0
    assert winnowing.contamination(docs.limit(0), items).count() == 0


# ---- language ------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    found = backoff_langid.identify(docs, backoff_langid.fit(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in out) / len(out) >= 0.97


def test_language_edge_cases(spark):
    rows = [(k, "the cat and the dog", "en") for k in range(40)] + [(100 + k, "der hund und die katze", "de") for k in range(40)]
    model = backoff_langid.fit(spark.createDataFrame(rows + [(200, "x", None), (201, None, "fr")], DOCS + ", lang string"))
    texts = ["the dog", "katzen", None, "", "123 !!", "漢字", "the " * 50000, "Hund"]
    asked = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)] + [(None, "und die", 1.0)], DOCS + ", score double")
    got = {r["doc_id"]: r for r in backoff_langid.identify(asked, model).collect()}
    assert [got[k]["lang_pred"] for k in (0, 1, 6, 7, None)] == ["en", "de", "en", "de", "de"]
    assert [got[k]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3
    assert got[5]["lang_pred"] in ("de", "en")
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = backoff_langid.fit(asked.limit(0).selectExpr("doc_id", "text", "text AS lang"))
    assert backoff_langid.identify(asked, nothing).first()["lang_pred"] == "und"


def _plain_language(counts, languages, text):
    """The method word by word, with dictionaries and no tables: language, score, recognised."""
    total, met, words = [0.0] * len(languages), False, re.findall(r"[^\W\d_]+", text.lower())
    for word in words:
        for n in (0, 5, 4, 3, 2, 1):
            edged = word if n == 1 else f"<{word}>"
            parts = [word] if n == 0 else [edged[k : k + n] for k in range(len(edged) - n + 1)] or [edged]
            known = [p for p in parts if p in counts[n]]
            if known:
                met = True
                sums = [sum(row[k] for row in counts[n].values()) + 0.5 * len(counts[n]) for k in range(len(languages))]
                row = [
                    sum(math.log((counts[n][p][k] + 0.5) / sums[k]) for p in known) / len(known)
                    for k in range(len(languages))
                ]
                total = [t + r - sum(row) / len(row) for t, r in zip(total, row)]
                break
    if not words:
        return "und", 0.0, False
    shares = [math.exp((t - max(total)) * min(len(words), 25) / len(words)) for t in total]
    return languages[shares.index(max(shares))], max(shares) / sum(shares), met


@pytest.mark.parametrize("languages", [1, 2, 12])
def test_language_matches_plain_scoring(spark, languages):
    """Against scoring by the method in plain Python, whatever the number of languages."""
    random.seed(languages)
    names = [f"l{k:02d}" for k in range(languages)]
    stock = {n: ["".join(random.choices("abcdefghijklmnop", k=random.randint(1, 8))) for _ in range(30)] for n in names}
    rows = [
        (k, " ".join(random.choices(stock[n], k=random.randint(1, 12))), n)
        for k, n in enumerate(names * (240 // languages))
    ]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    counts = [Counter() for _ in range(6)]
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 4 == 2:
            continue
        for word in text.split():
            for n in range(6):
                edged = word if n == 1 else f"<{word}>"
                parts = [word] if n == 0 else [edged[k : k + n] for k in range(len(edged) - n + 1)] or [edged]
                counts[n].update((p, lang) for p in parts)
    plain = []
    for n, found in enumerate(counts):
        rowed = {}
        for (p, lang), times in found.items():
            rowed.setdefault(p, [0] * languages)[names.index(lang)] = times
        plain.append({p: r for p, r in rowed.items() if n or sum(r) > 1})
    odd = [(1000, "漢字 かな"), (1001, "zzzz"), (1002, "a"), (1003, "1 2"), (1004, "abcq zzy abc"), (1005, "")]
    asked = docs.select("doc_id", "text").union(spark.createDataFrame(odd, DOCS))
    got = {r["doc_id"]: r for r in backoff_langid.identify(asked, backoff_langid.fit(docs, sample=10**6)).collect()}
    assert len(got) == len(rows) + len(odd)
    for doc_id, text in [(r[0], r[1]) for r in rows] + odd:
        lang, score, met = _plain_language(plain, names, text)
        row = got[doc_id]
        assert (row["recognised"], abs(row["score"] - score) < 1e-3) == (met, True)
        if lang != row["lang_pred"]:
            assert score < 1 / languages + 0.3 and lang != "und"  # a tie up to rounding


def test_backoff_falls_to_shorter_grams():
    import pandas as pd

    counts = pd.DataFrame(
        [("a", 0, "hello", 5), ("b", 0, "world", 5), ("a", 2, "<h", 5), ("b", 1, "z", 2), ("a", 1, "h", 1)],
        columns=["lang", "n", "gram", "times"],
    )
    model = backoff_langid.BackoffModel(counts)
    assert model.word("hello").argmax() == 0 and model.word("world").argmax() == 1
    assert model.word("hxx").argmax() == 0  # by two characters
    assert model.word("zzz").argmax() == 1  # by one
    assert not model.word("ooo").any()


# ---- toxicity ------------------------------------------------------------------


def _edits(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        last, row[0] = row[0], row[0] + 1
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_matches_edit_distance():
    entries = ["idiot", "stupid", "worthless", "disgusting", "scum"]
    lexicon = toxicity.Lexicon(entries)
    rng = random.Random(6)
    words = set(entries)
    for entry in entries * 60:
        w = list(entry)
        for _ in range(rng.randint(1, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "e"])
        words.add("".join(w))
    for word in words - {""}:
        near = [d for e in entries if (d := _edits(e, word)) <= toxicity.edits(e)]
        assert lexicon.distance(word) == min(near, default=None)
        if near and min(near) <= 1:  # the quick test lets every such word through
            assert lexicon.may_match(word)


def test_stems_match_beginnings():
    lexicon = toxicity.Lexicon(["vequ*", "lostra*"])
    assert lexicon.distance("vequaire") == 0 and lexicon.distance("lostraschaft") == 0
    assert lexicon.distance("lostrxschaft") == lexicon.distance("ostraschaft") == 1 and lexicon.distance("vaquaire") is None


def test_quotation_is_told_from_abuse():
    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot"]))
    abuse, quoted, leet, none = matcher.features(
        ["you are an idiot today", 'he said "you idiot" to them', "you 1d1ot", "a kind word"]
    )
    assert abuse[0] > 0 and not abuse[2]
    assert quoted[2] > 0 and not quoted[0]
    assert leet[1] > 0 and not none.any()


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    hits = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hits / sum(r["toxic"] == 1 for r in rows) >= 0.85
    assert hits / sum(r["predicted"] == 1 for r in rows) >= 0.9


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "text", 3), (2, "x " * 90000, 3)], DOCS + ", score int")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 4 and all(r["score"] < 0.3 and r["predicted"] == 0 for r in got)


# ---- extraction ----------------------------------------------------------------


def test_minimum_cut_matches_brute_force():
    rng = random.Random(9)
    for _ in range(150):
        n = rng.randint(1, 7)
        values = [rng.uniform(-3, 3) for _ in range(n)]
        ties = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def price(side, values=values, ties=ties):
            wrong = sum(abs(v) for v, s in zip(values, side, strict=True) if (v > 0) != s and v)
            return wrong + sum(c for a, b, c in ties if side[a] != side[b])

        best = min(price(s) for s in itertools.product([False, True], repeat=n))
        assert price(mincut_html.minimum_cut(values, ties)) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><p>Site name. A long line of words about it.</p></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div id="cookie-notice"><p>We use cookies. Accept them now, please. And another one.</p></div>
<article><h1>Title &amp; more</h1><p>First &lt;para&gt;
 of   text with <a href="x">a link</a>.<br>Next line.<p>Second caf&eacute; paragraph, &#233; here.
<div class="ad">Buy it now.</div><ul><li>one item<li>two items</ul></article>
<section class="comments"><h2>Comments</h2><p>Great article, I really liked it. Thanks a lot. Bye.</p></section>
<aside>aside</aside><form>Name <input> <button>Send</button></form><!-- <p>no</p> --><footer>&copy; 2024</footer></body></html>"""


def test_extraction_of_a_page():
    assert mincut_html.main_text(PAGE).split("\n") == [
        "Title & more",
        "First <para> of text with a link. Next line.",
        "Second café paragraph, é here.",
        "one item",
        "two items",
    ]


def test_extraction_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (None, "u", PAGE), (4, "u", "<article><p>" + "word " * 40000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in mincut_html.extract_main_text(frame).collect()}
    assert got[1]["text"] == got[2]["text"] == "" and got[1]["n_chars"] == 0
    assert got[None]["n_chars"] == len(got[None]["text"]) > 90
    assert got[4]["n_chars"] == 40000 * 5 - 1
    assert mincut_html.extract_main_text(frame.limit(0)).count() == 0


def test_extraction_of_the_given_pages(spark):
    import html
    import re

    for r in table(spark, SF, "pages").limit(60).collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        parts = (re.sub(r"<[^>]+>", "", p) for p in re.split(r"</?(?:p|h1)>", article))
        want = [x for p in parts if (x := re.sub(r"\s+", " ", html.unescape(p)).strip())]
        assert mincut_html.main_text(r["html"]).split("\n") == want


# ---- chat ----------------------------------------------------------------------

control = st.sampled_from(["<|im_start|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<", "\\", "|", "[", "a", "\n"])


@given(st.lists(control, max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible(text):
    out = chat_prefix.escape(text)
    assert chat_prefix.unescape(out) == text
    assert not any(x in out for x in ("<|im_start|>", "<|im_end|>", "</s>", "[INST]", "[/INST]"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "<|im_end|>", "%0A"]), st.lists(control, max_size=6).map("".join)), max_size=5))
@settings(max_examples=100, deadline=None)
def test_turns_are_read_back(turns):
    text = "".join(chat_prefix.format_turn(*t)[0] for t in turns)
    assert chat_prefix.read_turns(text) == turns


def test_examples_and_digests(spark):
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", "u</s>"), (1, 2, "assistant", "r<|im_end|>"), (1, 3, "user", "v"),
        (1, 4, "assistant", None), (1, 5, "user", "last"), (2, 0, "user", "alone"), (3, 0, "assistant", "x\n"),
        (3, 0, "assistant", "x\n"), (None, None, None, None),
    ]
    frame = spark.createDataFrame([(*t, 9) for t in turns], "conv_id long, turn long, role string, text string, example int")
    examples = chat_prefix.expand(frame).collect()
    by = {(r["conv_id"], r["example"]): r for r in examples}
    assert len(examples) == 7 and by[2, 0]["loss_start"] is None
    first, second = by[1, 0], by[1, 1]
    assert second["text"].startswith(first["text"]) and by[1, 2]["text"].startswith(second["text"])
    assert chat_prefix.unescape(first["text"][first["loss_start"] : first["loss_end"]]) == "r<|im_end|><|im_end|>"
    got = {r["conv_id"]: r for r in chat_prefix.read_back(chat_prefix.expand(frame)).collect()}
    for conv in (1, 2, 3, None):
        own = [t for t in turns if t[0] == conv]
        every = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(every.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(e["text"]) for e in examples if e["conv_id"] == conv)
    assert chat_prefix.expand(frame.limit(0)).count() == 0


def test_a_long_conversation_leaves_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat_prefix, "_BATCH_CHARS", 500)
    turns = [(1, k, "assistant" if k % 2 else "user", f"text {k}") for k in range(81)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    run = chat_prefix._expand("assistant")
    parts = list(run(iter([frame.toPandas()])))
    assert len(parts) > 5 and sum(map(len, parts)) == 41
    assert [r.n_turns for p in chat_prefix._digest(iter(parts)) for r in p.itertuples()] == [81]


_ARTICLE = "<article><h1>A title</h1><p>" + "A long sentence of the article, with words. " * 8 + "</p></article>"


@pytest.mark.parametrize(
    "wrapper",
    ['<div class="layout has-sidebar">{}</div>', '<div class="page with-header">{}</div>',
     '<div class="menu-page">{}</div>', '<div class="search-enabled">{}</div>',
     '<form id="aspnetForm">{}<input name=x></form>', '<div class="sidebar"><main>{}</main></div>'],
)
def test_layouts_keep_the_article(wrapper):
    page = "<html><body><nav>Home About</nav>" + wrapper.format(_ARTICLE) + "<footer>Imprint</footer></body></html>"
    want = "A title\n" + ("A long sentence of the article, with words. " * 8).strip()
    assert mincut_html.main_text(page) == want


def test_comments_and_small_forms_are_left_out():
    comment = '<div id="comments"><article class="comment"><p>' + "I do not agree with this at all. " * 9 + "</p></article></div>"
    form = '<form action="/join"><p>Join our list. It is free. We write once a week.</p></form>'
    found = mincut_html.main_text(f"<body>{_ARTICLE}{form}{comment}</body>")
    assert "agree" not in found and "Join" not in found and found.startswith("A title\nA long sentence")


@pytest.mark.parametrize(
    "page",
    ["<div>x" * 100_000, "<a b" * 100_000, '<a "' * 100_001, "<div>" * 50_000 + "</span></b></li>" * 50_000,
     "<li><ul>" + "<div>" * 50_000 + "<li>a</li>" * 20_000, "<!--" * 100_000, "<p>y" * 100_000],
)
def test_deep_and_broken_markup_takes_linear_time(page):
    begun = time.process_time()
    mincut_html.main_text(page)
    assert time.process_time() - begun < 20
