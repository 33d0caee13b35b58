"""Ranked lexical search by presence-mask grouping.

Every item of a benchmark is a query of distinct terms; all documents are
ranked for it by an integer score that sums, over the item's terms, a rarity
weight times a saturating function of the term's occurrences and the
document's length.

Two passes over the documents, neither shuffles a text. The first counts, per
task, documents with terms, terms with repeats, and the documents that hold
each term of the benchmark; one small row per term leaves a task. The second
ranks: a task gathers the postings of a block of documents (``BLOCK_DOCS``
documents or ``BLOCK_POSTINGS`` postings at most, so a task's memory does not
grow with its input) and makes one bitmap over the block per term. For an item,
the bitmaps of its terms are turned into one presence mask per document;
documents of equal mask form a group. A mask's greatest possible score is the
sum, over its terms, of the greatest part that the term has in any document of
the block. Masks are evaluated in descending order of it, documents exactly,
until the next mask's bound is below the k-th best score found so far (over all
blocks of the task); a mask whose bound equals that score is still evaluated,
since a tie may go to a smaller id. Each task gives its best ``k`` per item, and
two rounds of merging (by item and a part of the tasks, then by item) give the
best of all, so no merge holds more than a part of the tasks' lists.

The benchmark is sent to the tasks in blocks of at most ``block_words`` terms,
a size that is checked by counting; a larger benchmark takes several passes,
each written before the next begins.

Terms are compared by 64-bit hash. Weights are taken in doubles, all else is
64-bit integer arithmetic.

Defined results: a null or empty text has no terms and counts nowhere; a
document without an id counts in the statistics but is not ranked; each row is
a document, also where ids or texts repeat. Rows of the benchmark with one id
are one item with the terms of all its rows; items without an id or a term
have no rows in the result. Fewer than ``k`` documents of positive score: all
of them. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import arrow_slices, give_back, keep, map_rows
from gridsense.llm.words import LETTERS_DIGITS, word_hashes

TOP = 50
BLOCK_WORDS = 1_000_000  # terms of items that one pass sends to the tasks
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 2_000_000
MERGE_PARTS = 64


def item_terms(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, terms): one row per item with at least one term."""
    def make():
        def run(texts):
            flat, off = word_hashes(texts, LETTERS_DIGITS)
            return ([np.unique(flat[s:e]).view(np.int64) for s, e in zip(off, off[1:])],)
        return run

    rows = benchmark.select(F.col(key).cast("long").alias("item"), F.col(text).alias("t")).where("item is not null")
    each = map_rows(rows, [F.col("t")], ["item"], make, {"terms": "array<long>"})
    return each.groupBy("item").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms")) \
        .where(F.size("terms") > 0)


def _postings(texts, vocabulary: np.ndarray):
    """Of a list of texts: terms with repeats per text, and (text, term of the
    sorted vocabulary, occurrences), by text and term."""
    flat, off = word_hashes(texts, LETTERS_DIGITS)
    at = np.searchsorted(vocabulary, flat)
    at[at == len(vocabulary)] = 0
    met = np.flatnonzero(vocabulary[at] == flat)
    doc = np.searchsorted(off, met, "right") - 1
    pair, tf = np.unique(doc * len(vocabulary) + at[met], return_counts=True)
    return np.diff(off), pair // len(vocabulary), pair % len(vocabulary), tf


def _statistics(docs: DataFrame, text: str, vocabulary: np.ndarray):
    """Documents with terms, terms with repeats, documents of each term."""
    def run(batches):
        n, total, df = 0, 0, np.zeros(len(vocabulary), np.int64)
        for b in batches:
            texts = b.column(0)
            for part in arrow_slices(texts):
                size, _, term, _ = _postings(texts[part].to_pylist(), vocabulary)
                n += int((size > 0).sum())
                total += int(size.sum())
                df += np.bincount(term, minlength=len(vocabulary))
            del b, texts
            give_back()
        i = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-2, -1], i), pa.int64()),
                                          pa.array(np.append([n, total], df[i]), pa.int64())], ["t", "n"])

    rows = docs.select(F.col(text).alias("t")).mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n"))
    df = np.zeros(len(vocabulary), np.int64)
    n = total = 0
    for t, c in rows.collect():  # one row per term of the block at most
        if t == -2:
            n = c
        elif t == -1:
            total = c
        else:
            df[t] = c
    return n, total, df


def weight(n: int, df: int) -> int:
    """How much a term of ``df`` among ``n`` documents counts."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def best_of(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: highest score first, ties by ascending id."""
    if len(score) > 4 * k:  # all that reach the k-th best score, then in order
        least = np.partition(score, len(score) - k)[len(score) - k]
        reach = np.flatnonzero(score >= least)
        return reach[np.lexsort((ids[reach], -score[reach]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Ranker:
    """The best ``k`` documents of each item over the blocks it is shown."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, n: int, total: int, k: int):
        """``items``: places of each item's terms among ``weights``."""
        self.items, self.weights, self.n, self.total, self.k = items, weights, n, total, k
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items]
        self.masks = self.evaluated = 0  # distinct masks met, and those evaluated

    def block(self, ids: np.ndarray, size: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """A block of documents: ids, terms with repeats, postings by document."""
        if not len(doc):
            return
        m = 50 + (50 * size * self.n) // self.total
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        first = np.searchsorted(doc, np.arange(len(ids) + 1))  # postings of each document
        order = np.argsort(term, kind="stable")
        there, begin = np.unique(term[order], return_index=True)
        most = np.zeros(len(self.weights), np.int64)
        most[there] = np.maximum.reduceat(part[order], begin)
        row = np.full(len(self.weights), -1)
        row[there] = np.arange(len(there))
        bits = np.zeros((len(there), len(ids)), bool)
        bits[row[term], doc] = True
        bitmaps = np.packbits(bits, axis=1)
        del bits
        for i, terms in enumerate(self.items):
            terms = terms[(row[terms] >= 0) & (most[terms] > 0)]
            if len(terms):
                self._item(i, terms, most, bitmaps[row[terms]], ids, term, part, first)

    def _item(self, i, terms, most, maps, ids, term, part, first) -> None:
        who = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps, axis=0), count=len(ids)))
        held = np.unpackbits(maps, axis=1, count=len(ids))[:, who]
        mask = np.ascontiguousarray(np.packbits(held, axis=0).T)  # a row of bytes per document
        kinds, group = np.unique(mask.view(f"V{mask.shape[1]}").ravel(), return_inverse=True)
        kinds = np.unpackbits(kinds.view(np.uint8).reshape(len(kinds), -1), axis=1, count=len(terms))
        bound = kinds.astype(np.int64) @ most[terms]
        falling = np.argsort(-bound, kind="stable")
        place = np.empty(len(falling), np.int64)
        place[falling] = np.arange(len(falling))
        by_mask = np.argsort(place[group], kind="stable")  # documents in the order of their masks
        ends = np.cumsum(np.bincount(place[group], minlength=len(falling)))
        bound = bound[falling]
        wanted = np.zeros(len(self.weights), bool)
        wanted[terms] = True
        self.masks += len(bound)
        now, step = 0, self.k
        while now < len(bound):
            score, doc_ids = self.best[i]
            floor = score[-1] if len(score) >= self.k else 0
            if bound[now] < floor:
                break
            # The next masks that are still needed, about ``step`` documents of them.
            done = ends[now - 1] if now else 0
            upto = min(int(np.searchsorted(ends, done + step, "left")) + 1,
                       int(np.searchsorted(-bound, -floor, "right")))
            self.evaluated += upto - now
            docs = who[by_mask[done:ends[upto - 1]]]
            n = first[docs + 1] - first[docs]
            at = np.repeat(first[docs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            own = np.where(wanted[term[at]], part[at], 0)
            got = np.add.reduceat(own, np.cumsum(n) - n)
            ok = got > 0
            score, doc_ids = np.append(score, got[ok]), np.append(doc_ids, ids[docs[ok]])
            top = best_of(score, doc_ids, self.k)
            self.best[i] = score[top], doc_ids[top]
            now, step = upto, step * 2


def _rank(docs: DataFrame, doc_id: str, text: str, items: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    vocabulary = np.unique(np.concatenate([t for _, t in items]))
    n, total, df = _statistics(docs, text, vocabulary)
    weights = np.array([weight(n, int(x)) for x in df], np.int64)
    names = np.array([i for i, _ in items], np.int64)
    places = [np.searchsorted(vocabulary, t) for _, t in items]

    def run(batches):
        ranker = Ranker(places, weights, n, total, k)
        block: list = []
        docs_held = postings_held = 0

        def flush():
            nonlocal block, docs_held, postings_held
            if block:
                ids, size, doc, term, tf = zip(*block)
                shift = np.cumsum([0, *map(len, ids[:-1])])
                ranker.block(np.concatenate(ids), np.concatenate(size),
                             np.concatenate([d + s for d, s in zip(doc, shift)]),
                             np.concatenate(term), np.concatenate(tf))
            block, docs_held, postings_held = [], 0, 0

        for b in batches:
            texts = b.column(1)
            for cut in arrow_slices(texts):
                ids = b.column(0)[cut].to_numpy(zero_copy_only=False)
                size, doc, term, tf = _postings(texts[cut].to_pylist(), vocabulary)
                block.append((ids, size, doc, term, tf))
                docs_held, postings_held = docs_held + len(ids), postings_held + len(doc)
                if docs_held >= BLOCK_DOCS or postings_held >= BLOCK_POSTINGS:
                    flush()
            del b, texts
            give_back()
        flush()
        found = [i for i, (s, _) in enumerate(ranker.best) if len(s)]
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        for at in range(0, len(found), 1000):
            some = found[at:at + 1000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[some], pa.int64()), pa.array([task] * len(some), pa.int64()),
                 pa.array([ranker.best[i][0] for i in some], pa.list_(pa.int64())),
                 pa.array([ranker.best[i][1] for i in some], pa.list_(pa.int64()))], ["item", "task", "score", "doc"])

    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).where("d is not null")
    lists = rows.mapInArrow(run, "item long, task long, score array<long>, doc array<long>").select(
        "item", (F.col("task") % MERGE_PARTS).alias("part"),
        F.transform(F.arrays_zip("score", "doc"), lambda x: F.struct((-x["score"]).alias("s"), x["doc"].alias("d"))).alias("best"))

    def merged(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))

    return merged(merged(lists, "item", "part"), "item").select("item", F.posexplode("best").alias("p", "b"))


def search(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", k: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``item``, ``rank`` (from 1), ``doc_id``, ``score`` of each item's best
    ``k`` documents."""
    spark = docs.sparkSession
    items = item_terms(benchmark, item, item_text)
    words = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-words // block_words))
    out = None
    for j in range(n_blocks):
        own = [(r["item"], np.array(r["terms"], np.int64).view(np.uint64))
               for r in items.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == j).collect()]  # about block_words terms
        if not own:
            continue
        found = _rank(docs, doc_id, text, sorted(own, key=lambda x: x[0]), k)
        if n_blocks > 1:
            found = keep(found, "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "item long, p int, b struct<s:long,d:long>")
    return out.select(F.col("item").alias(item), (F.col("p") + 1).alias("rank"), F.col("b.d").alias(doc_id),
                      (-F.col("b.s")).alias("score"))
