"""N-gram Jaccard join: a prefix-tree join of globally ordered shingle sets.

A document's set holds its distinct word n-grams (64-bit hashes). Two sets link
when ``100 * |A and B| >= percent * |A or B|``. The result is each document's
component of links; documents of equal sets are one node from the start.

1. *Sets*: one pass gives each row its set's size and 128-bit digest, and the
   shingles that are frequent within a batch. Those that are frequent overall
   (at least one in ``FREQUENT`` documents) are known to all later steps; there
   are no more than ``FREQUENT`` times the mean set size of them.
2. *Order*: shingles are ordered by how many sets hold them, rare ones first,
   frequent ones last. A batch of documents sends its other shingles, packed
   and sorted, to the bucket of their hash; a bucket sends back those held by
   more than one set. A shingle of one set only can be in no overlap; it counts
   in the set's size and goes no further.
3. *Prefix*: two sets that link share a shingle among the first
   ``n - ceil(percent * n) + 1`` of each in that order. Sets whose prefix holds
   only their own shingles are done; the others (a small part) are put into
   blocks, the components of "shares a prefix shingle".
4. *Prefix tree*: the sets of a block form a trie. Each set walks it from the
   root: overlaps of shared beginnings are counted once, and a subtree is left
   as soon as the overlap so far plus the shorter of the two remaining lengths
   (or the set sizes alone) cannot reach the threshold. A block over
   ``CHUNK`` sets is dealt over several tasks: first chunks against themselves,
   then some sets of each component found against each other, then every set
   outside a block's largest component against all chunks. Pairs of one
   component need no test, since only components are asked for.

All counts are over all documents, and no pair, candidate or group is capped.
Nothing of the documents' size goes to the driver.

Defined results: a null, empty or blank text has an empty set (size 0), links
with nothing and is its own component; fewer than ``width`` words are one
shingle; repeated rows get the same result each; the component of a row whose
ids are all null is null. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridsense.llm.components import components
from gridsense.llm.tables import arrow_slices, as_long, give_back, keep
from gridsense.llm.words import combine, mix, ngrams, word_hashes

WIDTH, PERCENT = 5, 80
FREQUENT = 1000  # a shingle in one of so many documents is frequent (64 documents at least)
BATCH = 1 << 19  # shingles of the documents that a task handles at once
BUCKET = 1 << 19  # shingles of a bucket, about
SETS = 1 << 15  # texts taken at once; a set's place in a batch fits 16 bits
CHUNK = 1024  # sets of a trie
CHUNK_TOKENS = 1 << 20
SPOKEN = 24  # sets of a component that are tried against other chunks' first

_LOW48 = np.uint64((1 << 48) - 1)


# -- sets -------------------------------------------------------------------------

def shingle_sets(texts, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    flat, off = word_hashes(texts)
    grams = ngrams(flat, width)
    out = []
    for s, e in zip(off[:-1].tolist(), off[1:].tolist()):
        if e - s >= width:
            out.append(np.unique(grams[s:e - width + 1]))
        elif e > s:
            out.append(np.array([combine(flat[s:e])], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _digest(sets: list[np.ndarray]):
    """Two 64-bit digests of each set."""
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    out = []
    for salt in (0x1B873593CC9E2D51, 0x52DCE729A0761D64):
        total = np.append(np.uint64(0), np.cumsum(mix(flat ^ np.uint64(salt)), dtype=np.uint64))
        ends = np.cumsum(size)
        out.append(mix(total[ends] - total[ends - size] + size.astype(np.uint64)))
    return size, out[0], out[1]


def _batches(texts: pa.Array, width: int):
    """Runs of consecutive texts with their sets, ``BATCH`` shingles or so and
    less than twice ``SETS`` sets, whatever the size of Arrow's batches."""
    first, sets, room = 0, [], BATCH
    for part in arrow_slices(texts):
        for at in range(part.start, part.stop, SETS):
            got = shingle_sets(texts[at:min(at + SETS, part.stop)].to_pylist(), width)
            sets += got
            room -= sum(map(len, got))
            if room <= 0 or len(sets) >= SETS:
                yield first, sets
                first, sets, room = first + len(sets), [], BATCH
    if sets:
        yield first, sets


def _set_rows(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Rows of documents (key, n, s1, s2, the text's hash) and of frequent
    shingles (token, df)."""
    def run(batches):
        for b in batches:
            keys, texts, hashes = b.column(0), b.column(1), b.column(2)
            for first, sets in _batches(texts, width):
                n, s1, s2 = _digest(sets)
                _, own = np.unique(np.stack([s1, s2]), axis=1, return_index=True)
                held = np.concatenate([np.empty(0, np.uint64), *(sets[i] for i in own)])
                token, df = np.unique(held, return_counts=True)
                often = df >= max(8, len(sets) / (2 * FREQUENT))
                k, m = len(sets), int(often.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([keys.slice(first, k), pa.nulls(m, keys.type)]),
                     pa.array(np.append(n, np.full(m, -1)), pa.int64()),
                     pa.array(np.append(as_long(s1), as_long(token[often]))),
                     pa.array(np.append(as_long(s2), df[often]), pa.int64()),
                     pa.concat_arrays([hashes.slice(first, k), pa.nulls(m, pa.int64())])], ["k", "n", "s1", "s2", "h"])
            del b, keys, texts, hashes
            give_back()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h")).mapInArrow(
        run, f"k {kind}, n long, s1 long, s2 long, h long")


# -- order and prefix ---------------------------------------------------------------

def _candidates(docs: DataFrame, text: str, width: int, percent: int, frequent: np.ndarray, bits: int) -> DataFrame:
    """Sets with a shared shingle in their prefix: ``(s1, s2, n, pre, tokens)``,
    the shared shingles in global order and how many of them are in the prefix."""
    def split(tokens):
        bucket = tokens >> np.uint64(64 - bits) if bits else np.zeros(len(tokens), np.uint64)
        return bucket.astype(np.int64), tokens & _LOW48

    def send(batches):
        task, serial = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = b.column(0)
            for _, sets in _batches(texts, width):
                n, s1, s2 = _digest(sets)
                _, own = np.unique(np.stack([s1, s2]), axis=1, return_index=True)
                own = own[n[own] > 0]
                if not len(own):
                    continue
                sets, batch, serial = [sets[i] for i in own], (task << 24) + serial, serial + 1
                size = np.array([len(s) for s in sets])
                flat, doc = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint64), size)
                at = np.minimum(np.searchsorted(frequent, flat), max(len(frequent) - 1, 0))
                often = frequent[at] == flat if len(frequent) else np.zeros(len(flat), bool)
                bucket, low = split(flat[~often])
                packed = (low << np.uint64(16)) | doc[~often]
                order = np.lexsort((packed, bucket))
                packed, bucket = packed[order], bucket[order]
                names, begin = np.unique(bucket, return_index=True)
                parts = np.split(packed, begin[1:]) if len(names) else []
                fb, fl = split(flat[often])
                known = np.concatenate([n[own].astype(np.uint64), s1[own], s2[own]])
                rows = [(-1 - batch, batch, known.tobytes(), _ids(fb, fl, bits).tobytes(),
                         doc[often].astype(np.uint16).tobytes())]
                rows += [(int(k), batch, p.tobytes(), b"", b"") for k, p in zip(names, parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), *[pa.binary()] * 3))],
                    ["key", "batch", "x", "y", "z"])
            del b, texts
            give_back()

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        key = int(pdf["key"].iloc[0])
        if key < 0:  # what a batch knows of its own sets goes on to it
            return pdf
        parts = [np.frombuffer(x, np.uint64) for x in pdf["x"]]
        packed = np.concatenate(parts)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        low = packed >> np.uint64(16)
        _, back, df = np.unique(low, return_inverse=True, return_counts=True)
        df = df[back]
        shared = df > 1
        packed, row, df = packed[shared], row[shared], df[shared]
        rows = np.unique(row)
        ends = np.searchsorted(row, rows, "right")
        begins = np.searchsorted(row, rows, "left")
        return pd.DataFrame({"key": key, "batch": pdf["batch"].to_numpy()[rows],
                             "x": pd.Series([packed[s:e].tobytes() for s, e in zip(begins, ends)], dtype=object),
                             "y": pd.Series([df[s:e].astype(np.uint32).tobytes() for s, e in zip(begins, ends)],
                                            dtype=object), "z": b""},
                            columns=["key", "batch", "x", "y", "z"])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["key"] < 0].iloc[0]
        n, s1, s2 = np.frombuffer(own["x"], np.uint64).reshape(3, -1)
        n = n.astype(np.int64)
        token, doc = [np.frombuffer(own["y"], np.uint64)], [np.frombuffer(own["z"], np.uint16)]
        rank = [np.full(len(token[0]), 1 << 40, np.int64)]
        for key, x, y in zip(pdf["key"], pdf["x"], pdf["y"]):
            if key >= 0:
                packed = np.frombuffer(x, np.uint64)
                token.append(_ids(np.int64(key), packed >> np.uint64(16), bits))
                doc.append((packed & np.uint64(0xFFFF)).astype(np.uint16))
                rank.append(np.frombuffer(y, np.uint32).astype(np.int64))
        token, doc, rank = np.concatenate(token), np.concatenate(doc), np.concatenate(rank)
        order = np.lexsort((token, rank, doc))
        token, doc = token[order], doc[order]
        shared = np.bincount(doc, minlength=len(n))
        first = np.cumsum(shared) - shared
        prefix = n - (-(-percent * n // 100)) + 1
        pre = prefix - (n - shared)  # the set's own shingles come first
        rows = np.flatnonzero((pre > 0) & (shared > 0))
        return pd.DataFrame({"s1": as_long(s1[rows]), "s2": as_long(s2[rows]), "n": n[rows], "pre": pre[rows],
                             "tokens": pd.Series([as_long(token[first[i]:first[i] + shared[i]]) for i in rows],
                                                 dtype=object)},
                            columns=["s1", "s2", "n", "pre", "tokens"])

    layout = "key long, batch long, x binary, y binary, z binary"
    sent = docs.select(F.col(text).alias("t")).mapInArrow(send, layout)
    back = sent.groupBy("key").applyInPandas(bucket, layout)
    found = back.groupBy("batch").applyInPandas(gather, "s1 long, s2 long, n long, pre long, tokens array<long>")
    return found.groupBy("s1", "s2").agg(*[F.first(c).alias(c) for c in ("n", "pre", "tokens")])


def _ids(bucket, low: np.ndarray, bits: int) -> np.ndarray:
    """A shingle's number from its bucket and its low 48 bits: the hash itself
    with 16 bits of buckets or more, else all that was kept of it."""
    b = bucket.astype(np.uint64)
    if bits <= 16:
        return (b << np.uint64(48)) | low
    return (b << np.uint64(64 - bits)) | (low & np.uint64((1 << (64 - bits)) - 1))


# -- prefix tree --------------------------------------------------------------------

class Trie:
    """A path-compressed trie of integer sequences in one global order."""

    def __init__(self, seqs: list[np.ndarray], n: np.ndarray, comp: np.ndarray | None = None):
        order = sorted(range(len(seqs)), key=lambda i: seqs[i].astype(">u4").tobytes())
        lcp = [0] * len(order)
        for k in range(1, len(order)):
            a, b = seqs[order[k - 1]], seqs[order[k]]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            lcp[k] = int(differ[0]) if len(differ) else m
        lcp = np.array(lcp, np.int64)
        parent, segs, ends, self.leaves, level = [-1], [np.empty(0, np.int64)], [], [], [0]
        todo = [(0, len(order), 0, 0)]  # (from, to, depth, node): the sequences below a node
        while todo:
            lo, hi, depth, node = todo.pop()
            cuts = lo + 1 + np.flatnonzero(lcp[lo + 1:hi] == depth)
            bounds = [lo, *cuts.tolist(), hi]
            for s, e in zip(bounds, bounds[1:]):
                first = seqs[order[s]]
                if len(first) == depth:  # ends here; equal ones are split by the same bound
                    self.leaves.append((node, order[s]))
                    if e - s > 1:
                        todo.append((s + 1, e, depth, node))
                    continue
                deep = int(lcp[s + 1:e].min()) if e - s > 1 else len(first)
                parent.append(node)
                segs.append(first[depth:deep])
                level.append(level[node] + 1)
                child = len(parent) - 1
                if e - s == 1:
                    self.leaves.append((child, order[s]))
                else:
                    todo.append((s, e, deep, child))
        self.parent, self.level = np.array(parent), np.array(level)
        self.size = np.array([len(s) for s in segs], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.concatenate(segs)
        self.last = np.array([s[-1] if len(s) else -1 for s in segs], np.int64)
        count = len(parent)
        self.least, self.most = np.full(count, 1 << 60), np.zeros(count, np.int64)
        self.below = np.zeros(count, np.int64)  # longest rest of a sequence below the node
        self.comp = np.full(count, -1, np.int64)  # the one component below the node, -2: several
        self.leaf_node = np.array([k for k, _ in self.leaves], np.int64)
        self.leaf_doc = np.array([d for _, d in self.leaves], np.int64)
        for k, d in self.leaves:
            self._seen(k, n[d], n[d], -1 if comp is None else comp[d])
        for k in range(count - 1, 0, -1):  # children come after their parents
            p = parent[k]
            self.below[p] = max(self.below[p], self.size[k] + self.below[k])
            self._seen(p, self.least[k], self.most[k], self.comp[k])
        if comp is None:
            self.comp[:] = -2
        self.n = n
        by_level = np.argsort(self.level, kind="stable")
        self.levels = np.split(by_level, np.searchsorted(self.level[by_level], np.arange(1, self.level.max() + 1)))
        by_node = np.argsort(self.leaf_node, kind="stable")
        self.leaf_node, self.leaf_doc = self.leaf_node[by_node], self.leaf_doc[by_node]

    def _seen(self, k, least, most, comp):
        self.least[k], self.most[k] = min(self.least[k], least), max(self.most[k], most)
        self.comp[k] = comp if self.comp[k] in (-1, comp) else -2

    def probe(self, seq: np.ndarray, size: int, mark: np.ndarray, percent: int, comp: int = -3) -> np.ndarray:
        """Documents whose sets link with the set of ``size`` shingles, of
        which those that occur in the trie are ``seq`` (marked in ``mark``)."""
        share = percent / (100 + percent)  # of both sizes, that the overlap must have
        over = np.zeros(len(self.parent), np.int64)
        live = np.zeros(len(self.parent), bool)
        live[0] = True
        for nodes in self.levels[1:]:
            nodes = nodes[live[self.parent[nodes]]]
            nodes = nodes[(self.comp[nodes] != comp) & (100 * self.most[nodes] >= percent * size)
                          & (percent * self.least[nodes] <= 100 * size)]
            if not len(nodes):
                break
            m = self.size[nodes]
            ends = np.cumsum(m)
            where = np.arange(ends[-1]) + np.repeat(self.begin[nodes] - (ends - m), m)
            hits = np.add.reduceat(mark[self.flat[where]].astype(np.int64), ends - m)
            over[nodes] = over[self.parent[nodes]] + hits
            rest = np.minimum(len(seq) - np.searchsorted(seq, self.last[nodes], "right"), self.below[nodes])
            live[nodes] = over[nodes] + rest >= share * (size + self.least[nodes]) - 1e-6
        reached = live[self.leaf_node]
        docs, o = self.leaf_doc[reached], over[self.leaf_node[reached]]
        return docs[100 * o >= percent * (size + self.n[docs] - o)]


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def linked(tokens: list[np.ndarray], n: np.ndarray, percent: int, comp=None, probes=None) -> list[tuple[int, int]]:
    """Links between the sets, enough to connect all that links connect.
    ``comp``: components known already; ``probes``: the sets that walk."""
    size = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate([*tokens, np.empty(0, np.int64)])
    names, back, df = np.unique(flat, return_inverse=True, return_counts=True)
    # Order within the group: the most frequent first, so that sets share
    # beginnings; shingles of one set only are left out.
    order = np.lexsort((names, -df))
    code = np.empty(len(names), np.int64)
    code[order] = np.arange(len(names))
    code[df == 1] = -1
    coded = code[back.ravel()]
    seqs = [np.sort(c[c >= 0]) for c in np.split(coded, np.cumsum(size)[:-1])] if len(size) else []
    trie = Trie(seqs, n, comp)
    mark = np.zeros(len(names) + 1, bool)
    union, out = _Union(len(n)), []
    for i in range(len(n)) if probes is None else probes:
        mark[seqs[i]] = True
        found = trie.probe(seqs[i], int(n[i]), mark, percent, -3 if comp is None else int(comp[i]))
        mark[seqs[i]] = False
        for j in found.tolist():
            if j != i and union.join(i, j):
                out.append((i, j))
    return out


def _arrays(pdf: pd.DataFrame):
    return [np.asarray(t, np.int64) for t in pdf["tokens"]], pdf["n"].to_numpy(np.int64)


def _edges_of(percent: int):
    """Task of a group: links within it, as edges of set numbers."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, n = _arrays(pdf)
        ids = pdf["id"].to_numpy(np.int64)
        links = linked(tokens, n, percent)
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, dtype="int64")
    return run


def _cross_edges_of(percent: int):
    """Task of a chunk and a part of a block's remaining sets."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, n = _arrays(pdf)
        ids = pdf["id"].to_numpy(np.int64)
        comp = np.unique(pdf["comp"], return_inverse=True)[1]  # 0, 1, .., whatever the keys are
        links = linked(tokens, n, percent, comp, np.flatnonzero(pdf["probe"].to_numpy()))
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, dtype="int64")
    return run


SHAPE = "a long, b long"


def _with_components(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """``sets`` with the component that ``edges`` (a stored table) give each
    (its own id: none)."""
    comp = components(edges, written=True)
    return keep(sets.join(comp, F.col("id") == F.col("node"), "left")
                .withColumn("comp", F.coalesce("label", "id")).drop("node", "label"), "comp")


def _links_of_big(big: DataFrame, percent: int) -> DataFrame:
    """Links within blocks that are dealt over chunks; ``big``: block, chunk,
    parts (chunks of the block), id, n, tokens."""
    edges = keep(big.groupBy("block", "chunk").applyInPandas(_edges_of(percent), SHAPE), "links")
    comp, turn, before = _with_components(big, edges), 0, None
    while True:
        # Some sets of each component are tried against each other's. This only
        # makes the last step cheaper; it goes on while it joins components.
        turn += 1
        rank = F.row_number().over(Window.partitionBy("block", "comp").orderBy(F.xxhash64("id", F.lit(turn)), "id"))
        some = keep(comp.withColumn("r", rank).where(F.col("r") <= SPOKEN), "speakers")
        count = keep(some.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("p")), "counts")
        place = some.select("id", "block").join(count, "block").select("id", F.pmod(F.xxhash64("id", F.lit(-turn)), "p").alias("g"))
        dealt = some.join(place, "id")
        found = dealt.groupBy("block", "g").applyInPandas(_edges_of(percent), SHAPE)
        edges = keep(edges.unionByName(found), "links")
        comp = _with_components(big, edges)
        left, parts = comp.agg(F.countDistinct("comp")).first()[0], count.agg(F.max("p")).first()[0]
        if parts == 1 or left == before:
            break
        before = left
    # Every set outside the largest component of its block walks all chunks.
    # What a block decides is joined to narrow rows, and sets by their id.
    narrow = comp.select("id", "block", "comp")
    largest = keep(narrow.groupBy("block", "comp").count().groupBy("block").agg(
        F.max_by("comp", F.struct("count", "comp")).alias("main")), "largest")
    rest = F.col("comp") != F.col("main")
    narrow = keep(narrow.join(largest, "block").select("id", "block", rest.alias("probe")), "rest")
    walks = keep(narrow.where("probe").groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("walks")), "walks")
    sets = comp.join(keep(narrow.join(walks, "block").drop("block"), "placed"), "id")
    cols = ["block", "chunk", "walk", "id", "n", "tokens", "comp", "probe"]
    base = sets.withColumn("walk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("walks") - 1))) \
        .withColumn("probe", F.lit(False)).select(*cols)
    walk = sets.where("probe").withColumn("walk", F.pmod(F.xxhash64("id", F.lit(0)), F.col("walks"))) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(*cols)
    cross = base.unionByName(walk).groupBy("block", "chunk", "walk").applyInPandas(_cross_edges_of(percent), SHAPE)
    return edges.unionByName(cross)


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of set ids that connect all linked sets of ``sets``
    (id, n, pre, tokens)."""
    member = sets.select("id", F.explode(F.slice("tokens", F.lit(1), F.col("pre").cast("int"))).alias("token"))
    least = member.groupBy("token").agg(F.min("id").alias("b"), F.max("id").alias("top")).where("b < top")
    near = member.join(least, "token").where("id <> b").select(F.col("id").alias("a"), "b")
    blocks = components(near).select(F.col("node").alias("id"), F.col("label").alias("block"))
    # Blocks are weighed and dealt on narrow rows; sets move once, by their id
    # and then by block and chunk, so a large block is never in one task.
    narrow = keep(sets.select("id", F.size("tokens").alias("w")).join(blocks, "id"), "members")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("w") / CHUNK_TOKENS))
    sizes = keep(narrow.groupBy("block").agg(parts.alias("parts")), "sizes")
    dealt = keep(narrow.join(sizes, "block").select("id", "block", "parts",
                                                    F.pmod(F.xxhash64("id"), F.col("parts")).alias("chunk")), "dealt")
    found = sets.drop("pre").join(dealt.where("parts = 1"), "id").groupBy("block") \
        .applyInPandas(_edges_of(percent), SHAPE)
    if not sizes.where("parts > 1").isEmpty():
        big = keep(sets.drop("pre").join(dealt.where("parts > 1"), "id"), "big")
        found = found.unionByName(_links_of_big(big, percent))
    return found


# -- the join -------------------------------------------------------------------------

def similar(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WIDTH,
            percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` (the smallest key reachable
    by links, the row's own included) of every row. ``key`` is a whole number
    below 2**62. ``docs`` is a stored table: its rows are read twice, and a task
    that runs again must meet them in the same order."""
    return _similar(docs, key, text, width, percent).drop("h").toDF(key, "n_shingles", "component_id")


def _similar(docs: DataFrame, key: str, text: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``k``, ``n``, ``comp`` and ``h`` (the text's hash) of every row."""
    rows = keep(_set_rows(docs, key, text, width), "shingle-sets")
    known = rows.where("n >= 0")
    n_docs, n_shingles = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = rows.where("n < 0").groupBy("s1").agg(F.sum("s2").alias("df")).where(F.col("df") >= max(64, n_docs / FREQUENT))
    frequent = np.sort(np.array([r[0] for r in often.select("s1").collect()], np.int64).view(np.uint64))
    bits = max(0, int(np.ceil(np.log2(max(n_shingles, 1) / BUCKET))))
    # A set's number is its smallest key; sets of null keys alone get one
    # beyond all keys, and so do sets whose smallest key is another set's too.
    beyond = F.shiftrightunsigned(F.xxhash64("s1", "s2"), 2) + F.lit(1 << 62)
    sets = keep(known.where("n > 0").groupBy("s1", "s2").agg(
        F.coalesce(F.min(F.col("k").cast("long")), beyond).alias("id")), "sets")
    twice = keep(sets.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("id").alias("key")), "twice")
    repeated = not twice.isEmpty()
    if repeated:
        sets = keep(sets.join(twice, F.col("id") == F.col("key"), "left").select(
            "s1", "s2", F.when(F.col("key").isNull(), F.col("id")).otherwise(beyond).alias("id"),
            F.col("id").alias("least")), "numbered")
    shared = keep(_candidates(docs, text, width, percent, frequent, bits).join(sets.select("s1", "s2", "id"), ["s1", "s2"])
                  .drop("s1", "s2"), "candidates")
    comp = components(keep(_links(shared, percent), "links"), written=True)
    label = keep(sets.join(comp, F.col("id") == F.col("node"), "left").select(
        *sets.drop("id").columns, F.coalesce("label", "id").alias("label")), "labels")
    if repeated:  # a component's smallest key may not be its label
        least = label.groupBy("label").agg(F.min("least").alias("least"))
        label = label.drop("least").join(least, "label").select("s1", "s2", F.col("least").alias("label"))
    kind = docs.schema[key].dataType
    found = known.join(label, ["s1", "s2"], "left")
    own = F.when(F.col("label") < F.lit(1 << 62), F.col("label").cast(kind))
    return found.select("k", "n", F.when(F.col("n") > 0, own).otherwise(F.col("k")).alias("comp"), "h")


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of similar documents: that of the
    smallest key, once if its row is repeated. Rows of one key and different
    texts are judged each by its own component. Rows without a key stay, all."""
    gone = _similar(docs, key, text).where("k <> comp").select("k", "h").distinct()
    kept = docs.join(gone, (docs[key] == gone["k"]) & (F.xxhash64(docs[text]) == gone["h"]), "left_anti")
    own = "_" + "_".join(docs.columns)  # no other column's name
    return kept.withColumn(own, F.when(F.col(key).isNull(), F.monotonically_increasing_id())) \
        .dropDuplicates([key, text, own]).select(*docs.columns)
