"""Vectors, pages, tokens, conversations, similar documents, the pipeline."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from gridsense.llm import bpe, chat, jaccard, language, main_text, nearest
from gridsense.llm import components as components_of
from gridsense.llm.components import components
from gridsense.llm.queries import ORACLE, QUERIES, VOCABULARY
from gridsense.llm.tables import held_out
from tests.conftest import SF0001
from tests.llm import brute
from tests.oracle_compare import compare

DOC = "doc_id long, text string"


# -- nearest neighbours -------------------------------------------------------------

def test_chi_square_quantile():
    assert nearest.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_tree_cells_hold_every_point_once():
    p = np.random.default_rng(0).standard_normal((500, 4))
    p[100:300] = p[0]
    t = nearest.Tree(p, 16)
    assert sorted(np.concatenate(t.leaves).tolist()) == list(range(500))
    at = t.leaf_of(p)
    assert all(k in set(t.leaves[at[k]].tolist()) for k in range(500))


def _nearest_by_hand(rows, k=10):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[(i, tuple(v))] = (i, np.array(v, float))
    out = {}
    for i, v in ok.values():
        if i % 100 == 0:
            d = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in ok.values() if j != i and len(w) == len(v))
            out[i] = d[:k]
    return out


@pytest.mark.parametrize("cell", [8192, 40])
def test_nearest_equals_brute_force_at_full_confidence(spark, monkeypatch, cell):
    monkeypatch.setattr(nearest, "CELL", cell)
    monkeypatch.setattr(nearest, "BLOCK", 3 * cell)
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.standard_normal(6)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(1000, 1200)]  # many equal vectors
    rows += [(500, None), (600, []), (700, [0.0] * 6), (800, [float("nan")] * 6), (900, [None] * 6), (None, rows[1][1]),
             (5000, [1.0, 2.0]), (5001, [1.0, 2.5]), (0, rows[0][1]), (950, [float("inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = {}
    for x in nearest.nearest(df, F.col("vec_id") % 100 == 0, confidence=1 - 1e-12).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["score"], x["vec_id"]))
    want = _nearest_by_hand(rows)
    assert set(got) == {q for q, d in want.items() if d}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert [f[2] for f in found] == [j for _, j in want[q]]
        assert [f[1] for f in found] == pytest.approx([d for d, _ in want[q]], abs=1e-12)
    assert nearest.nearest(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_nearest_recall(spark):
    df = QUERIES["op2_nearest"](spark, SF0001)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    want = _nearest_by_hand(rows)
    found = {(r["query_id"], r["vec_id"]) for r in df.collect()}
    assert np.mean([(q, j) in found for q, d in want.items() for _, j in d]) >= 0.9


# -- pages ------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a><li><a href='/b>'>Menu two</a></ul></nav><!-- <p>gone</p> --><div class="ad">Buy now.</div>
<article><h1>Title &amp; more</h1><p><b>First  line<br>second line.<p>Caf&eacute; &lt;x&gt; in<i>li</i>ne a &#233; 3 < 4.</p>
<ul><li>point one.<li>point two.</ul><form><input value="q"><button>Send it</button></form>
<aside class="sidebar">See also these.</aside><div id="comments"><p>I like it, said a reader.</p></div><p>Last words here.</p></article>
<div class="cookie-notice">We use cookies.</div><footer>&copy; site</footer></body></html>"""
TEXT = "Title & more First line second line. Café <x> inline a é 3 < 4. point one. point two. Last words here."
ODD = [None, "", "   ", "just text", "<", "<p", "<!-- open <p>x</p>", "<script>var x", "<article>a<script>b</article>c",
       "<div " + 'a="' * 50, "</p></div><article><p>ok.", "<article>" + "<div>" * 3000 + "deep.", "&am", "<article>x &amp",
       "<article><p>" + "word " * 100000 + "</article>"]


def test_main_text_of_odd_pages(spark):
    plain = ["<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>A title</h1><p>Some text, and more.</p>"
             f"<p>Then {i} words.</p></article><footer>Foot note</footer></body></html>" for i in range(30)]
    rows = [(i, "u", h) for i, h in enumerate(plain)] + [(100, None, PAGE), (100, None, PAGE), (None, "u", PAGE)] \
        + [(200 + i, "u", h) for i, h in enumerate(ODD)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    model = main_text.train(pages.where("page_id < 100"))
    got = main_text.extract(pages, model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is None or r["page_id"] == 100:
            assert r["text"] == TEXT
        elif r["page_id"] < 100:
            assert r["text"] == f"A title Some text, and more. Then {r['page_id']} words."
        assert r["n_chars"] == len(r["text"])
    odd = {r["page_id"] - 200: r["text"] for r in got if r["page_id"] and r["page_id"] >= 200}
    assert [odd[i] for i in (0, 1, 2, 8, 10, 11, 13)] == ["", "", "", "a", "ok.", "deep.", "x &"]
    assert len(odd[14]) == 499999
    untrained = main_text.extract(pages.where("page_id = 100"), main_text.train(pages.where("false")))
    assert "First line" in untrained.first()["text"] and "Menu" not in untrained.first()["text"]
    assert main_text.extract(pages.where("false"), model).count() == 0


def test_names_inside_an_article_drop_no_headings_or_sections(spark):
    """A word of a class or id is no verdict; comments and advertisements stay out."""
    para = "<p>We describe the method, which is known; it works well in practice.</p>"
    kept = ['<h1 class="entry-title">{}</h1>', '<h2 class="post-title">{}</h2>', '<h2 class="section-head">{}</h2>',
            '<h2 id="related-work">{}</h2>', '<h2 id="search">{}</h2>', '<h2 class="title header">{}</h2>',
            '<section id="search-methods"><h2>{}</h2>' + para + '</section>',
            '<div class="entry-content with-sidebar"><p>{}</p></div>', '<p id="notice-of-appeal">{}</p>']
    out = ['<div id="comments"><p>{}, said a reader.</p><p>I do not, said another.</p></div>', '<div class="ad">{}</div>',
           '<article class="comment"><p>{}, said a reader.</p></article>', '<aside>{}</aside>',
           '<div class="related"><ul><li><a href="/x">{}</a></li></ul></div>']
    page = "<html><body><nav><a href=x>Home</a></nav><article><h1>A title</h1>{0}{1}{0}</article><footer>F</footer></body></html>"
    rows = [(i, None, page.format(para, p.format("It is here"))) for i, p in enumerate(kept + out)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for training in (pages, pages.where("false"), spark.read.parquet(f"{SF0001}/pages.parquet")):
        got = {r["page_id"]: "It is here" in r["text"] for r in main_text.extract(pages, main_text.train(training)).collect()}
        assert got == {i: i < len(kept) for i in range(len(rows))}


def test_marginals_are_exact_on_a_small_tree():
    """Sum-product against summing over all labellings."""
    import itertools
    import math
    model = main_text.Model({"word:x": (3, 9), "part:y": (7, 5), "pair:p:0": (40, 10), "pair:p:1": (5, 45),
                             "pair:div:0": (9, 2), "pair:#text:1": (1, 30), "size:1": (8, 4)})
    page = main_text.Page('<div class="x"><p>a</p><p class="ad-y">b<b>c</b></p></div>')
    weight = [sum(model.ratio.get(f, 0.0) for f in fs) for fs in page.features()]
    weight[0] -= main_text.LIKELY
    total, yes = 0.0, [0.0] * len(weight)
    for y in itertools.product((0, 1), repeat=len(weight)):
        w = math.exp(sum(a * b for a, b in zip(weight, y)))
        for k in range(1, len(y)):
            c = model.pairs(page)[k][y[page.parent[k]]]
            w *= c if y[k] else 1 - c
        total += w
        for k, b in enumerate(y):
            yes[k] += w * b
    got = [1 / (1 + math.exp(-b)) for b in model.marginals(page)]
    assert got == pytest.approx([v / total for v in yes], rel=1e-9)


PARA = "<p>We describe the method, which is known; it works well in practice, as all have seen.</p>"
NAV = '<nav><ul><li><a href="/x">Home</a></li><li><a href="/y">More</a></li></ul></nav>'
LINKS = "<ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(40)) + "</ul>"


def test_an_article_keeps_all_that_is_not_named_otherwise(spark):
    """Lists, links, headers inside it; what stands beside it stays out."""
    words = PARA[3:-4]

    def page(inner, after=""):
        return f"<html><body>{NAV}<article><h1>T</h1>{PARA}{inner}</article>{after}<footer>foot</footer></body></html>"

    cases = [(page("<ul><li>flour</li><li>two eggs</li></ul>"), f"T {words} flour two eggs"),
             (page(LINKS), f"T {words} " + " ".join(f"Item {i}" for i in range(40))),
             (page('<p><a href="/d">Download</a></p>'), f"T {words} Download"),
             (page("<table><tr><td>a</td><td>b</td></tr></table>"), f"T {words} a b"),
             (page("").replace("<h1>T</h1>", "<header><h1>Headline</h1><p>By X</p></header>"), f"Headline By X {words}"),
             (f"<html><body><header>Site</header><form>{page('')[12:-14]}</form></body></html>", f"T {words}"),
             (f"<html><body>{NAV}<main>{LINKS}</main></body></html>", " ".join(f"Item {i}" for i in range(40))),
             (page("", f"<div><h3>Comments</h3>{PARA * 8}</div>"), f"T {words}"),
             (page("", f'<div class="responses"><article class="c1">{PARA * 4}</article></div>'), f"T {words}"),
             (page(f'<section id="comments">{PARA * 9}</section><div class="ad">Buy, now.</div>'), f"T {words}"),
             (page("<form><label>Your name</label></form><aside>See also</aside><footer>Tags</footer>"), f"T {words}")]
    pages = spark.createDataFrame([(i, None, h) for i, (h, _) in enumerate(cases)], "page_id long, url string, html string")
    for training in (spark.read.parquet(f"{SF0001}/pages.parquet"), pages, pages.where("false")):
        got = main_text.extract(pages, main_text.train(training)).collect()
        assert {r["page_id"]: r["text"] for r in got} == {i: t for i, (_, t) in enumerate(cases)}


def test_training_reads_pages_without_an_article(spark):
    """What labelled pages teach finds the articles of the table's pages when
    their tags are gone; without training nothing tells them."""
    pages = spark.read.parquet(f"{SF0001}/pages.parquet").select("page_id", "url", "html")
    model = main_text.train(pages)
    want = {r["page_id"]: r["text"] for r in main_text.extract(pages, model).collect()}
    bare = pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))
    got = {r["page_id"]: r["text"] for r in main_text.extract(bare, model).collect()}
    assert np.mean([got[k] == want[k] for k in want]) > 0.85
    untrained = main_text.extract(bare, main_text.train(bare)).collect()
    assert not any(r["text"] for r in untrained)


def test_pages_table_gives_the_articles(spark):
    import html
    import re
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    for r in QUERIES["op4_main_text"](spark, SF0001).collect():
        inner = re.search("<article>(.*)</article>", rows[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split())


# -- tokens -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_vocabulary(VOCABULARY))


PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2003", "é", "漢", "😀", "'s", "'", "'re", "1", "²",
          "<|endoftext|>", "<|end", "###", "aaaa", "-", "\u200b", "\x00", "Ⅷ", "\u0301", "\U0001F1E6", "tion", "ing"]


def test_ids_and_texts_equal_the_library(library, coder):
    r = random.Random(2)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    for t, got in zip(texts, coder.encode_many(texts)):
        want = library.encode(t, add_special_tokens=False).ids
        assert got == want, repr(t)
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_long_pieces_stream_with_bounded_lookahead(library, coder):
    assert coder.lookahead < 1000
    r = random.Random(3)
    for letters in ("ab", "-", "=-_", "tion", "er0", "Ġ", "\n", " ", "é漢", "the", "aaaab"):
        for n in (coder.window + 1, 5 * coder.window):
            t = "".join(r.choice(letters) for _ in range(n))
            assert coder.encode(t) == library.encode(t, add_special_tokens=False).ids
            raw = t.encode()[: n // 2 * 2]
            assert list(coder.stream(raw)) == coder.merge(raw)


def test_blocks_and_forgetting_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 30)
    coder = bpe.Coder(bpe.read_vocabulary(VOCABULARY))
    r = random.Random(4)
    for _ in range(60):
        t = "".join(r.choice([*PIECES, " word", " x"]) for _ in range(400))
        assert coder.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_decoding_replaces_malformed_bytes(library, coder):
    r = random.Random(5)
    for _ in range(500):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 12))]
        assert coder.decode(ids, at_once=3) == library.decode(ids, skip_special_tokens=False)


def test_tokenize_rows(spark, library):
    texts = ["a text", None, "", "<|endoftext|> x", "a text", "漢字 " * 30000]
    rows = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(texts)], DOC + ", ids int")
    got = bpe.tokenize(rows, bpe.read_vocabulary(VOCABULARY)).collect()
    for r in got:
        t = texts[r["doc_id"] or 0] or ""
        assert r["ids"] == library.encode(t, add_special_tokens=False).ids and r["decoded"] == t
    assert bpe.tokenize(rows.where("false"), bpe.read_vocabulary(VOCABULARY)).count() == 0


def test_bpe_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    for r in QUERIES["op8_bpe"](spark, SF0001).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == brute.sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == brute.sha(library.decode(ids, skip_special_tokens=False))


# -- conversations ----------------------------------------------------------------------

def test_escapes_are_reversible():
    r = random.Random(6)
    for _ in range(2000):
        t = "".join(r.choice(["\\", "#", "###", "<turn>", "</turn>", "a", " ", "\n", "</", ">"]) for _ in range(r.randint(0, 12)))
        e = chat.escape(t)
        assert chat.unescape(e) == t
        assert not any(c in e.replace("\\###", "").replace("\\<turn>", "").replace("\\</turn>", "") for c in ("<turn>", "</turn>"))


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> <|endoftext|> ok"
    rows = [(1, 1, "assistant", said), (1, 0, "user", said), (1, 2, "user", None), (2, 0, "assistant", "a"),
            (2, 0, "assistant", "a"), (3, None, None, "x"), (3, 0, "assistant", ""), (None, 0, "assistant", "n"),
            (4, 0, "user", "long " * 50000), (5, 0, "### role: x", "y"), (None, 1, "assistant", "m")]
    rows += [(6, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(0))
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    turns = chat.format_turns(df, vocabulary)
    got = {r["conv_id"]: r for r in chat.read_back(turns, vocabulary).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, None}
    for c in got:
        mine = sorted(((t if t is not None else -1, r or "", x or "") for k, t, r, x in rows if k == c), key=lambda v: v[0])
        r = got[c]
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == brute.sha("".join(f"{a}\n{b}\n" for _, a, b in mine))
        learnt = "".join(b for _, a, b in mine if a == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), brute.sha(learnt))
        assert r["formatted_chars"] == sum(sum(map(len, chat.CONTROL)) + len(chat.escape(a) + chat.escape(b)) for _, a, b in mine)
    coder = bpe.Coder(vocabulary, False)
    one = sorted(turns.where("conv_id = 1").collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in one] == [0, 1, 2]
    assert all(b["start"] == a["start"] + len(a["ids"]) for a, b in zip(one, one[1:]))
    assert all(sum(i >= coder.size for i in r["ids"]) == 3 for r in one)
    shown = "".join(chat.render(list(r["ids"]), coder) for r in one)
    assert shown.startswith("<turn>### user: \\\\\\### Assistant: \\</turn>") and len(shown) == got[1]["formatted_chars"]
    assert chat.read_back(chat.format_turns(df.where("false"), vocabulary), vocabulary).count() == 0


# -- similar documents --------------------------------------------------------------------

@pytest.mark.parametrize("gathered", [1 << 20, 10])
def test_components(spark, monkeypatch, gathered):
    monkeypatch.setattr(components_of, "GATHERED", gathered)
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = {x["node"]: x["label"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _similar_docs(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for k in range(n):
        kind = r.random()
        if out and kind < 0.55:
            words = r.choice(out)[1].split()
            for _ in range(r.randint(0, 6)):
                if words:
                    i = r.randrange(len(words))
                    words[i:i + r.randint(0, 1)] = [r.choice(vocab)] * r.randint(0, 2)
        else:
            words = [r.choice(vocab) for _ in range(r.choice([0, 1, 3, 4, 5, 6, 20, 60, 120]))]
            if r.random() < 0.5:
                words += "this line of words stands in many documents of the set".split()
        out.append((k, (" " if r.random() < 0.5 else "\n").join(words)))
    return out


def _check_similar(spark, rows):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], DOC + ", n_shingles string")
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_shingles"], r["component_id"] is None, r["component_id"])
                 for r in jaccard.similar(df).collect())
    want = sorted((k is None, k, n, c is None, c) for (k, _), (n, c) in zip(rows, brute.components(rows)))
    assert got == want


def test_similar_equals_brute_force(spark):
    rows = _similar_docs(11, 400)
    rows += [(900, None), (901, ""), (902, " \t"), (903, "One Two three four"), (904, "one two three FOUR"), (905, "one two three"),
             (3, rows[3][1]), (906, "e" * 50000), (907, " ".join(f"q{i}" for i in range(30000)))]
    _check_similar(spark, rows)


def test_similar_in_dealt_blocks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 12)
    monkeypatch.setattr(jaccard, "SPOKEN", 2)
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    r = random.Random(13)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for k in range(150):  # one large group of near copies, many of them at the threshold
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(60)] = f"x{r.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    _check_similar(spark, rows + [(k + 1000, t) for k, t in _similar_docs(17, 120)])


def test_similar_null_keys_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "lone text of a row without a key"), (None, "")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {(None, 2, 7), (7, 2, 7), (None, 4, None), (None, 0, None)}
    empty = spark.createDataFrame([], DOC)
    assert jaccard.similar(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_one_of_each(spark):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (9, "another text that is alone here"), (9, "another text that is alone here"), (5, "")]
    got = sorted(r["doc_id"] for r in jaccard.one_of_each(spark.createDataFrame(rows, DOC)).collect())
    assert got == [2, 5, 9]


def test_one_of_each_judges_rows_of_one_key_by_their_text(spark):
    """A repeated key's clean text stays when its other text is a copy, exact
    or near; rows without a key stay."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(2, "a b c d e f"), (4, "a b c d e f"), (4, "this text of the key stands quite alone"),
            (6, long), (8, long + " more"), (8, "and so does this one of another key"),
            (9, "first text of the key nine here"), (9, "second one of nine is another thing"), (11, "second one of nine is another thing"),
            (None, "a text without any key at all"), (None, "a text without any key at all"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, DOC)
    got = sorted(((r["doc_id"], r["text"]) for r in jaccard.one_of_each(df).collect()), key=str)
    assert got == sorted((r for k, r in enumerate(rows) if k not in (1, 4, 8)), key=str)
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar(df).collect()}
    assert sorted(f[2] for f in found if f[0] == 8) == [6, 8] and {f[2] for f in found if f[0] in (9, 11)} == {9}


def test_trie_equals_pairwise_overlaps():
    r = random.Random(19)
    sets = [np.array(sorted(r.sample(range(40), r.randint(1, 30)))) for _ in range(80)]
    n = np.array([len(s) + r.randint(0, 3) for s in sets])
    trie, mark = jaccard.Trie(sets, n), np.zeros(41, bool)
    for i, s in enumerate(sets):
        mark[:] = False
        mark[s] = True
        for percent in (30, 50, 80):
            want = {j for j, t in enumerate(sets)
                    if 100 * len(set(s) & set(t)) >= percent * (n[i] + n[j] - len(set(s) & set(t)))}
            assert set(trie.probe(s, int(n[i]), mark, percent).tolist()) == want


DOC_SCHEMA = "doc_id long, text string"


def test_no_link_is_lost_whatever_the_batches(spark):
    """70,000 texts of one word and 200 near pairs, all in one Arrow batch."""
    r = random.Random(3)
    rows = [(i, f"w{i}") for i in range(70_000)]
    for k in range(200):
        words = [f"p{r.randint(0, 10**9)}" for _ in range(60)]
        rows += [(100_000 + 2 * k, " ".join(words)), (100_001 + 2 * k, " ".join(words[:-1] + ["other"]))]
    r.shuffle(rows)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    df = spark.createDataFrame(rows, DOC_SCHEMA).coalesce(1)
    try:
        spark.conf.set(size, "200000")
        got = {x["doc_id"]: x["component_id"] for x in jaccard.similar(df).collect()}
    finally:
        spark.conf.set(size, before)
    assert len(set(got.values())) == 70_200
    assert all(got[100_001 + 2 * k] == got[100_000 + 2 * k] == 100_000 + 2 * k for k in range(200))


# -- the registered queries ---------------------------------------------------------------

def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    r = compare(spark, name, SF0001)
    assert r["cols_match"] and r["hash_match"] and r["spark_rows"] == r["duck_rows"] > 0, r


def test_queries_without_sql_equal_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = sorted(texts.items())
    want = dict(zip(texts and [k for k, _ in rows], brute.components(rows)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op7_jaccard"](spark, SF0001).collect()} == want
    for r in QUERIES["op5_secrets"](spark, SF0001).collect():
        spans = brute.base_spans(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert r["base_sha256"] == brute.sha(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans))


def test_held_out_accuracy(spark):
    from tests.conftest import SF001
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_quality"](spark, SF001).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.9
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op6_language"](spark, SF001).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) > 0.95


def test_pipeline_stages(spark):
    """Each stage against a plain version on its own input, with odd rows and
    columns of clashing names."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    cols = docs.columns
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "12 34", "en", "s", 5),
                                 (None, "the words of a text", "en", "s", 19)], docs.schema)
    docs = docs.unionByName(odd).withColumn("score", F.lit(1)).withColumn("n_hit", F.lit("x")).withColumn("ids", F.lit(2))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    f = dict(corpus_pipeline.STAGES)
    one = f["language ID"](spark, docs, SF0001)
    assert one.columns == docs.columns
    left = one.collect()
    # Documents with a letter stay, with the language that op6's model finds.
    labelled = language.labelled_text(docs.where(~held_out()))
    found = language.identify(docs, labelled, carry=["doc_id", "text", "lang"]).collect()
    assert {r["lang"] for r in left} <= set(labelled)
    assert sorted((str(r["doc_id"]), r["text"], r["lang"]) for r in left) == sorted(
        (str(r["doc_id"]), r["text"], r["lang_pred"]) for r in found if r["text"] and any(c.isalpha() for c in r["text"]))
    assert [r for r in docs.drop("lang").exceptAll(one.drop("lang")).collect() if r["text"] and any(map(str.isalpha, r["text"]))] == []
    two = f["n-gram Jaccard join"](spark, one, SF0001)
    rows = [(r["doc_id"], r["text"]) for r in left]
    stay = [k for (k, _), (_, c) in zip(rows, brute.components(rows)) if k is None or k == c]
    left = two.collect()
    assert two.columns == docs.columns and sorted(map(str, stay)) == sorted(str(r["doc_id"]) for r in left)
    three = f["benchmark decontamination"](spark, two, SF0001)
    left = [r for r in left if not brute.hits(r["text"], items)[1]]
    assert three.columns == docs.columns and sorted(map(str, three.collect())) == sorted(map(str, left))
    four = f["secret scans"](spark, three, SF0001)
    masked = {r["doc_id"]: r for r in four.collect()}
    assert four.columns == docs.columns and len(masked) == len(left)
    for r in left:
        if not brute.base_spans(r["text"]):
            continue
        assert not any(r["text"][s:e] in masked[r["doc_id"]]["text"] for s, _, e in brute.base_spans(r["text"]))
        assert masked[r["doc_id"]]["n_chars"] == len(masked[r["doc_id"]]["text"])
    five = f["BPE encoding and decoding"](spark, four.select(*cols), SF0001).collect()
    assert len(five) == len(left) and all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in five)


def test_pipeline_keeps_chosen_languages(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ["en", "es"])
    kept = corpus_pipeline.language_id(spark, docs, SF0001)
    want = QUERIES["op6_language"](spark, SF0001).where("lang_pred in ('en', 'es')")
    assert sorted(tuple(r) for r in kept.select("doc_id", "lang").collect()) \
        == sorted(tuple(r) for r in want.select("doc_id", "lang_pred").collect())


def test_pipeline_run(spark):
    df = corpus_pipeline.run(spark, SF0001)
    assert df.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "lossless"] and df.count() > 100
