"""Ranked lexical search, token files, cross-tokenizer alignment."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsense.llm import alignment, bpe, lexical, queries, token_files
from tests.conftest import SF0001
from tests.llm import brute

DOC = "doc_id long, text string"
TERMS = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall((text or "").translate(brute.LOWER))


def ranked(docs, items, k):
    """{item: [(doc_id, score)]} by the formula, over all documents."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    for item in {i for i, _ in items if i is not None}:
        query = {t for i, x in items if i == item for t in terms(x)}
        got = []
        for d, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in query if t in c)
            if score > 0 and d is not None:
                got.append((-score, d))
        if got:
            out[item] = [(d, -s) for s, d in sorted(got)[:k]]
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["item_id"], r["rank"])):
        assert r["rank"] == len(out[r["item_id"]]) + 1
        out[r["item_id"]].append((r["doc_id"], r["score"]))
    return dict(out)


def _search_case(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "ß", "X9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 30)))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(50)]  # a group of copies: ties
    docs += [(5, docs[5][1]), (5, "w1 w2"), (None, "w1 w1 w9"), (n + 90, None), (n + 91, ""), (n + 92, "?! -"),
             (n + 93, "w3 " * 5000), (n + 94, "W1,w2;W3\tété")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(12)]
    items += [(3, "w1 w59"), (20, None), (21, "..."), (None, "w1"), (22, "nowhere")]
    return docs, items


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    docs, items = _search_case(block)
    df = spark.createDataFrame(docs, DOC).repartition(5).withColumn("score", F.lit("clash")).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(df, bench, k=10)) == ranked(docs, items, 10)


def test_search_in_several_passes_and_of_empty_tables(spark):
    docs, items = _search_case(1, 60)
    df, bench = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(df, bench, k=5, block_words=20)) == ranked(docs, items, 5)
    assert lexical.search(df.where("false"), bench).count() == 0
    none = lexical.search(df, bench.where("false"))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_few_masks_are_evaluated():
    """Masks stop as soon as none can reach the k-th best score."""
    rng = np.random.default_rng(2)
    n, k = 5000, 10
    held = rng.random((n, 12)) < 0.3
    held[:40] = True
    doc, term = np.nonzero(held)
    ranker = lexical.Ranker([np.arange(12)], np.full(12, 1000), n, n * 20, k)
    ranker.block(np.arange(n), np.full(n, 20), doc, term, np.ones(len(doc), np.int64))
    assert ranker.best[0][1].tolist() == list(range(k))
    assert ranker.evaluated < 0.05 * ranker.masks


# -- token files -----------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 3, 511, 512, 513, 4000])
@pytest.mark.parametrize("high", [1, 2, 30, 49408, 1 << 40, (1 << 64) - 1])
def test_words_give_all_ids_back(monkeypatch, n, high):
    monkeypatch.setattr(token_files, "STEP", 2 * token_files.BLOCK)
    rng = np.random.default_rng(n + high % 97)
    ids = rng.integers(0, high, n, dtype=np.uint64, endpoint=high > 2)
    if n > 600:
        ids[200:500] = 0
    file = token_files.TokenFile(token_files.to_bytes(np.array([7, -2]), np.array([n, 0]), ids))
    assert (file.ids() == ids).all() and file.doc_ids.tolist() == [7, -2] and file.begin.tolist() == [0, n]
    for a, b in rng.integers(0, n + 1, (20, 2)).tolist():
        assert (file.ids(a, b) == ids[a:b]).all()


def test_words_are_full():
    ids = np.arange(3000) % 1024  # ten bits: six of a word
    words, first, escapes = token_files.pack(ids)
    assert len(words) <= 3000 / 5 and not len(escapes) and first[-1] == len(words)
    assert len(token_files.pack(np.full(100, 1 << 62, np.uint64))[2]) == 100


def _library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _odd_texts(seed, n):
    rng = random.Random(seed)
    chars = "aAbB'sΣσİıéñ́ \n\t\x1c\x85  .,!?-<|>0129日本語😀ﬁ가각ᄀ　​﻿\x07▁ "
    parts = ["<|endoftext|>", "ΑΣ ", "İ", "<|startoftext|> ", "<s>", "<0x0A>", "  ", "hello world", "don't", "\r\n"]
    return ["".join(rng.choice(chars) if rng.random() < 0.9 else rng.choice(parts) for _ in range(rng.randint(0, 14)))
            for _ in range(n)]


def _lists(encoder, texts):
    ids, size = encoder.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]


def test_chunks_encode_as_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 500)
    monkeypatch.setattr(token_files, "PIECE", 700)
    vocabulary = bpe.read_vocabulary(queries.WORD_VOCABULARY)
    assert token_files.chunks_are_apart(vocabulary)
    assert not token_files.chunks_are_apart(bpe.read_vocabulary(queries.VOCABULARY))
    library, encoder = _library(queries.WORD_VOCABULARY), token_files.Encoder(vocabulary)
    for seed in range(5):
        texts = _odd_texts(seed, 800)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert _lists(encoder, texts) == want
    assert _lists(encoder, [None, "", " a"])[:2] == [[], []]
    whole = token_files.Encoder(bpe.read_vocabulary(queries.VOCABULARY))
    texts = _odd_texts(9, 200)
    want = [e.ids for e in _library(queries.VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert _lists(whole, texts) == want


def test_token_files_round_trip(spark, workdir):
    rng = random.Random(4)
    texts = _odd_texts(3, 300) + ["the same text"] * 100 + ["long text " * 20000, "", None]
    rows = [(rng.randint(-50, 10**12), t) for t in texts] + [(None, "no id"), (7, "a"), (7, "b b"), (7, "a")]
    library = _library(queries.WORD_VOCABULARY)
    df = spark.createDataFrame(rows, DOC).repartition(6).withColumn("start", F.lit("clash")).withColumn("d", F.lit(0))
    manifest = token_files.write_tokens(df, bpe.read_vocabulary(queries.WORD_VOCABULARY), file_ids=700, folder=workdir)
    files = sorted(manifest.collect(), key=lambda r: r["start"])
    assert len(files) >= 3 and sum(r["n_docs"] for r in files) == len(rows)
    at = 0
    for r in files:
        assert r["start"] == at and r["path"].startswith(workdir)
        at += r["n_ids"]
    got = sorted((r["start"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist())
                 for r in token_files.read_tokens(manifest, batch_ids=500).collect())
    at = 0
    for start, _, ids in got:  # every place is where the documents before it end
        assert start == at
        at += len(ids)
    order = [d for _, d, _ in got]
    assert order[0] is None and order[1:] == sorted(order[1:])
    want = sorted((d is not None, d or 0, library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows)
    assert sorted((d is not None, d or 0, ids) for _, d, ids in got) == want
    empty = token_files.write_tokens(df.where("false"), bpe.read_vocabulary(queries.WORD_VOCABULARY))
    assert empty.count() == 0 and token_files.read_tokens(empty).count() == 0


def test_token_files_query(spark):
    library = _library(queries.WORD_VOCABULARY)
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r["doc_id"]: r for r in queries.op12_token_files(spark, SF0001).collect()}
    at = 0
    for d in sorted(docs):
        ids = np.array(library.encode(docs[d] or "", add_special_tokens=False).ids + [1], "<u4")
        assert tuple(rows[d])[1:] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(rows) == len(docs)


# -- alignment ----------------------------------------------------------------------

def _aligned(aligner, text):
    """(tokens of A, of B, groups as text, links as pairs) on whole texts."""
    if not text:
        return 0, 0, "", []
    data = (" " + text).encode()
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    ab, bb = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if b"".join(ab) != data or b"".join(bb) != data:
        return 0, 0, "", []
    ea, eb = np.cumsum(list(map(len, ab))).tolist(), np.cumsum(list(map(len, bb))).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ea) & set(eb)):
        x, y = [], []
        while i < len(a) and ea[i] <= cut:
            x.append(str(a[i]))
            i += 1
        while j < len(b) and eb[j] <= cut:
            y.append(str(b[j]))
            j += 1
        groups.append(",".join(x) + "|" + ",".join(y))
    owner_a = [i for i, x in enumerate(ab) for _ in x]  # token of each byte
    owner_b = [j for j, x in enumerate(bb) for _ in x]
    links = [(a[i], b[j]) for i, j in sorted(set(zip(owner_a, owner_b)))]
    return len(a), len(b), ";".join(groups), links


def _weighed(rows):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) per row."""
    count = Counter(p for r in rows for p in set(r[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(na, nb, groups.count(";") + 1 if na else 0, len(links), sum(count[p] == most[p[0]] for p in links),
             sum(count[p] for p in links), brute.sha(groups) if na else "") for na, nb, groups, links in rows]


@pytest.fixture(scope="module")
def aligner():
    return alignment.aligner_of(bpe.read_vocabulary(queries.VOCABULARY), alignment.read_model(queries.PIECE_MODEL))


@pytest.mark.parametrize("segmented", [True, False])
def test_alignment_equals_whole_texts(spark, aligner, monkeypatch, segmented):
    monkeypatch.setattr(alignment, "CALL", 50)
    own = alignment.Aligner(bpe.read_vocabulary(queries.VOCABULARY), open(queries.PIECE_MODEL, "rb").read())
    own.apart = segmented
    texts = _odd_texts(1, 700) + [None, "", " ", "a", "x ▁y", "日本 語\x00", "tail ", "one two  three\n four"]
    cols = [c.tolist() if hasattr(c, "tolist") else c for c in own.align(texts)]
    for k, t in enumerate(texts):
        na, nb, groups, links = _aligned(aligner, t)
        got = sorted((p // own.n_b, p % own.n_b) for p, n in zip(cols[5][k], cols[6][k]) for _ in range(n))
        assert (cols[0][k], cols[1][k], cols[4][k], got) == (na, nb, groups, sorted(links)), t
        assert cols[2][k] == (groups.count(";") + 1 if na else 0) and cols[3][k] == len(links)


def test_alignment_query_and_its_passes(spark, aligner):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    docs = [(r[0], r[1]) for r in docs if r[1] is None or len(r[1]) < 1500]
    docs += [(10**6, "odd ▁ text"), (10**6 + 1, docs[0][1]), (10**6 + 1, docs[0][1]), (10**6 + 2, "é 日本\x07 ok")]
    want = sorted((d, *w) for (d, _), w in zip(docs, _weighed([_aligned(aligner, t) for _, t in docs])))
    df = spark.createDataFrame(docs, DOC).repartition(4).withColumn("pairs", F.lit("clash")).withColumn("n_a", F.lit(1))
    found = alignment.align(df, bpe.read_vocabulary(queries.VOCABULARY), alignment.read_model(queries.PIECE_MODEL))
    found = alignment.keep(found.withColumn("sha", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
                           .drop("groups"), "aligned")
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha"]
    for at_once in (alignment.PAIRS_AT_ONCE, 300):
        got = alignment.weigh(found, aligner.n_b, at_once).select(*cols).collect()
        assert sorted(map(tuple, got)) == want
    assert alignment.weigh(found.where("false"), aligner.n_b).count() == 0


def test_alignment_query(spark, aligner):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r["doc_id"]: r for r in queries.op13_alignment(spark, SF0001).collect()}
    assert set(rows) == set(docs)
    for d in sorted(docs)[:60]:
        if docs[d] is None or len(docs[d]) < 1500:
            na, nb, groups, links = _aligned(aligner, docs[d])
            assert (rows[d]["n_a"], rows[d]["n_b"], rows[d]["n_links"]) == (na, nb, len(links))
            assert rows[d]["groups_sha256"] == (brute.sha(groups) if na else "")
