"""Benchmark decontamination: a prefix-filtered set join.

The windows of an item are its runs of ``width`` words (an item of fewer words,
but not none, is one window). A text word is hit if it lies inside any
occurrence of a window. The words of a window are its shingles, ordered by how
rare they are over all documents; since every word of a window must be there,
the necessary prefix is its one rarest word. The join is then: text words equal
to some window's rarest word (an index by hash), candidates (text position,
window) from it, positional and length bounds (the window must fit into the
text around that word), and the exact comparison of all words of the window.

Rarity is counted over all documents in a first pass: each task counts the
benchmark's words in its documents and emits one count per word. The second
pass joins; documents are never shuffled. The benchmark is sent to all tasks in
blocks of at most ``block_words`` words, a size that is checked by counting;
of a larger benchmark each block takes a pass of its own, which is built, used
and written (documents with hits only) before the next, and the hits are united
per document. Candidates are compared ``CANDIDATES`` at a time.

Words are compared by 64-bit hash, all words of a window at once.

Defined results: a null or empty text has no words and no hits; an item
without words (or null) has no windows and occurs nowhere; items of the same
id count once; null ids of items are left out of ``items``. Repeated documents
are judged once per row. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import arrow_slices, give_back, keep, map_rows, whole_rows
from gridsense.llm.words import LETTERS_DIGITS, combine, word_hashes

WIDTH = 10
BLOCK_WORDS = 4_000_000
CANDIDATES = 1 << 18  # (place, window) pairs compared at once


class Windows:
    """The windows of a block of items, indexed by their rarest word."""

    def __init__(self, items: list[tuple[int, np.ndarray]], counts: dict[int, int], width: int):
        seen: dict[tuple[int, int], int] = {}
        self.words, keys, at, self.owners = [], [], [], []
        for item, words in items:
            n = min(width, len(words))
            for s in range(len(words) - n + 1) if n else ():
                w = words[s:s + n]
                key = (n, int(combine(w)))
                k = seen.get(key)
                if k is None:
                    k = seen[key] = len(self.words)
                    p = min(range(n), key=lambda i: (counts.get(int(w[i]), 0), int(w[i]), i))
                    self.words.append(w)
                    keys.append(w[p])
                    at.append(p)
                    self.owners.append(set())
                self.owners[k].add(item)
        order = np.argsort(np.array(keys, np.uint64), kind="stable")
        self.keys = np.array(keys, np.uint64)[order]
        self.window = order
        self.at = np.array(at, np.int64)
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.tables = {}  # by window size: the words of every window of that size
        for size in np.unique(self.size):
            own = np.flatnonzero(self.size == size)
            row = np.zeros(len(self.words), np.int64)
            row[own] = np.arange(len(own))
            self.tables[int(size)] = row, np.stack([self.words[k] for k in own])

    def find(self, flat: np.ndarray, off: np.ndarray):
        """Occurrences (first word, window) in the texts ``flat`` / ``off``."""
        lo, hi = np.searchsorted(self.keys, flat, "left"), np.searchsorted(self.keys, flat, "right")
        pos = np.flatnonzero(hi > lo)
        lo, n = lo[pos], (hi - lo)[pos]
        ends, found, at = np.cumsum(n), [], 0
        while at < len(pos):  # some places with their candidates
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
            found.append(self._compare(pos[at:to], lo[at:to], n[at:to], flat, off))
            at = to
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _compare(self, pos, lo, n, flat, off):
        place = np.repeat(pos, n)
        which = self.window[np.repeat(lo, n) + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)]
        first = place - self.at[which]
        doc = np.searchsorted(off, place, "right") - 1
        fits = (first >= off[doc]) & (first + self.size[which] <= off[doc + 1])
        first, which = first[fits], which[fits]
        keep = np.zeros(len(which), bool)
        for size, (row, table) in self.tables.items():
            part = np.flatnonzero(self.size[which] == size)
            for j in range(size):  # all words, window against text
                part = part[flat[first[part] + j] == table[row[which[part]], j]]
            keep[part] = True
        return first[keep], which[keep]


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(item, words): one row per distinct pair with at least one word."""
    def make():
        def run(texts):
            flat, off = word_hashes(texts, LETTERS_DIGITS)
            return ([flat[s:e].view(np.int64) for s, e in zip(off, off[1:])],)
        return run

    rows = benchmark.select(F.col(key).cast("long").alias("item"), F.col(text).alias("t"))
    return map_rows(rows.where("item is not null"), [F.col("t")], ["item"], make, {"words": "array<long>"}) \
        .where(F.size("words") > 0).dropDuplicates(["item", "words"])


def _word_counts(docs: DataFrame, text: str, words: np.ndarray) -> dict[int, int]:
    """How often each of ``words`` (sorted) stands in the documents."""
    def run(batches):
        total = np.zeros(len(words), np.int64)
        for b in batches:
            texts = b.column(0)
            for part in arrow_slices(texts):
                flat, _ = word_hashes(texts[part].to_pylist(), LETTERS_DIGITS)
                at = np.searchsorted(words, flat)
                at[at == len(words)] = 0
                total += np.bincount(at[words[at] == flat], minlength=len(words))
            del b, texts
            give_back()
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(total[i], pa.int64())], ["w", "n"])

    rows = docs.select(F.col(text).alias("t")).mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n"))
    return {int(words[r[0]]): r[1] for r in rows.collect()}  # at most one row per benchmark word


def _ranges(docs: DataFrame, text: str, carry: list[str], windows: Windows) -> DataFrame:
    """Per row: number of words, hit ranges [first, end), items."""
    def make():
        def run(texts):
            flat, off = word_hashes(texts, LETTERS_DIGITS)
            ranges: list = [[] for _ in texts]
            items: list = [[] for _ in texts]
            first, which = windows.find(flat, off)
            doc = np.searchsorted(off, first, "right") - 1
            for d in np.unique(doc):
                mine = doc == d
                start = first[mine] - off[d]
                ranges[d] = _union(np.stack([start, start + windows.size[which[mine]]], 1)).ravel()
                items[d] = sorted(set().union(*(windows.owners[k] for k in np.unique(which[mine]))))
            return np.diff(off), ranges, items
        return run

    return map_rows(docs, [text if text.split(".")[0] in carry and "." in text else F.col(text)], carry, make,
                    {"n_words": "long", "ranges": "array<long>", "items": "array<long>"})


def _union(r: np.ndarray) -> np.ndarray:
    """Disjoint sorted ranges that cover the same places as ``r`` (n, 2)."""
    r = r[np.lexsort((r[:, 1], r[:, 0]))]
    reach = np.maximum.accumulate(r[:, 1])
    new = np.append(True, r[1:, 0] > reach[:-1])
    starts = np.flatnonzero(new)
    return np.stack([r[starts, 0], reach[np.append(starts[1:], len(r)) - 1]], 1)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", carry=("doc_id",),
                  item: str = "item_id", item_text: str = "text", width: int = WIDTH,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``carry`` columns, ``n_words``, ``n_hit``, ``ranges`` (hit words as
    first, end, first, end, ...), ``items`` (ids whose windows occur)."""
    carry = list(carry)
    items = _items(benchmark, item, item_text)
    total = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))

    def windows(k: int) -> Windows:
        own = [(r["item"], np.array(r["words"], np.int64).view(np.uint64))
               for r in items.where(block == k).collect()]  # about block_words words
        own.sort(key=lambda x: x[0])
        words = np.unique(np.concatenate([w for _, w in own])) if own else np.empty(0, np.uint64)
        return Windows(own, _word_counts(docs, text, words) if own else {}, width)

    if n_blocks == 1:
        found = _ranges(docs, text, carry, windows(0))
    else:
        # A row number tells repeated rows apart; the last block's pass carries the rows.
        number = "_".join(["", "row", *docs.columns])  # no other column's name
        rows = docs.withColumn(number, F.monotonically_increasing_id())
        more = None
        for k in range(1, n_blocks):
            part = _ranges(rows, text, [number], windows(k)).where(F.size("ranges") > 0)
            part = keep(part.select(F.col(number).alias("__n"), F.col("ranges").alias("__r"), F.col("items").alias("__i")), "hits")
            more = part if more is None else more.unionByName(part)
        more = more.groupBy("__n").agg(F.flatten(F.collect_list("__r")).alias("__r"),
                                       F.flatten(F.collect_list("__i")).alias("__i"))  # at most a row per block
        found = _ranges(rows, text, [*carry, number], windows(0)).join(more, F.col(number) == F.col("__n"), "left")
        none = F.array().cast("array<long>")
        found = found.select(*carry, "n_words",
                             F.concat("ranges", F.coalesce("__r", none)).alias("__r"),
                             F.array_sort(F.array_distinct(F.concat("items", F.coalesce("__i", none)))).alias("items"))

        def make():
            return lambda _, ranges: ([_union(np.reshape(r, (-1, 2))).ravel() if r else [] for r in ranges],)

        found = map_rows(found, [F.lit(""), F.col("__r")], [*carry, "n_words", "items"], make, {"ranges": "array<long>"})
    hits = F.aggregate("ranges", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")),
                       lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")),
                       lambda a: a["n"])
    return found.withColumn("n_hit", hits)


def without_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of the benchmark;
    ``options`` as those of :func:`decontaminate`."""
    found = decontaminate(whole_rows(docs), benchmark, text=f"__row.{text}", carry=["__row"], **options)
    return found.where(F.col("n_hit") == 0).select("__row.*")
