"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

Encoding splits a text into pieces by the byte-level pattern and merges bytes
within each piece by the rank of the merge list. A piece may be of any length:
it is read through a window, and a token is emitted once no further input can
change it, that is once it ends ``lookahead`` bytes before the window's end.
``lookahead`` is computed from the merge list (see :func:`sufficient_lookahead`),
so the memory of the transducer does not depend on the input. Short pieces are
remembered in a table of bounded size.

Decoding is an incremental state machine from ids to bytes to text: each id
gives its bytes, an incremental UTF-8 decoder holds the bytes of an unfinished
character (at most three), and malformed bytes become U+FFFD.

The vocabulary file's path is a parameter; it is read on the driver and its
fixed size of content goes to the tasks.

Defined results: a null text counts as empty (no ids, empty text). Repeated
rows are encoded once per row. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import codecs
import gc
import json
from array import array
from collections import ChainMap
from heapq import heapify, heappop, heappush
from itertools import chain, compress
from operator import not_

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import map_rows

# Fixed value: the byte-level pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT = 48  # characters of a piece that is merged in step with others and remembered
REMEMBERED = 300_000  # short pieces kept per worker
_NEVER = np.iinfo(np.int64).max
BLOCK = 1 << 16  # characters of a text that are split into pieces at once


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where printable, else the next one from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which more input cannot change a token.

    What follows a text changes its tokens only from the end leftwards: each
    step is a merge ``(u, v)``, applied on one side and not on the other,
    where ``u`` was still the same on both. Steps happen in rank order, and
    the next one's right part begins with the token that the last step's left
    part had been. So a change reaches no further than the heaviest chain of
    merges of growing rank in which each left part is a prefix of the next
    right part, plus the token in which the end lies.
    """
    reach: dict[bytes, int] = {}
    best = 0
    for u, v in merges:
        most = max((reach.get(v[:k], 0) for k in range(1, len(v) + 1)), default=0) + len(u)
        if most > reach.get(u, 0):
            reach[u] = most
        best = max(best, most)
    return best + max((len(u) + len(v) for u, v in merges), default=1)


class Coder:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, content: str, special: bool = True):
        """``special``: strings of added tokens in a text become their ids."""
        spec = json.loads(content)
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: t for t, i in vocab.items()}
        merges = [tuple(bytes(alphabet[c] for c in x) for x in (m if isinstance(m, list) else m.split(" ")))
                  for m in spec["model"]["merges"]]
        self.ranks = {(vocab[u], vocab[v]): (r, vocab[u + v]) for r, (u, v) in enumerate(merges)}
        self.single = [vocab[bytes([b])] for b in range(256)]
        self.lookahead = sufficient_lookahead(merges)
        self.window = 4 * self.lookahead
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])} if special else {}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        self.size = max(self.bytes_of) + 1
        self._pieces_of_bytes = [self.bytes_of.get(i, b"") for i in range(self.size)]
        self.pattern = regex.compile(PATTERN)
        self.gap = regex.compile(r"(?<=\S) (?=\S)")
        self.control = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        self.fixed = {t: (i,) for t, i in self.added.items()}
        self.known: dict[str, tuple[int, ...]] = dict(self.fixed)
        # The merge list as arrays, for merging many pieces in step: ranks by
        # pair in a hash table with linear probing, and the tokens they make.
        keys = np.array([(a << 32) | b for a, b in self.ranks], np.int64)
        ranks = np.array([r for r, _ in self.ranks.values()], np.int64)
        self._bits = max(10, int(3 * max(len(keys), 1)).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int64)
        self._slot_rank = np.full(1 << self._bits, _NEVER)
        for slot, key, rank in zip(self._slot_of(keys).tolist(), keys.tolist(), ranks.tolist()):
            while self._slots[slot] >= 0:
                slot = (slot + 1) & ((1 << self._bits) - 1)
            self._slots[slot], self._slot_rank[slot] = key, rank
        self._merged = np.zeros(len(merges), np.int64)
        for r, new in self.ranks.values():
            self._merged[r] = new
        self._byte_ids = np.array(self.single, np.int64)

    def _slot_of(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def _ranks_of(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NEVER where there is no such merge."""
        slot = self._slot_of(keys)
        met = self._slots[slot]
        rank = np.where(met == keys, self._slot_rank[slot], _NEVER)
        open_ = np.flatnonzero((met != keys) & (met >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self._bits) - 1)
            met = self._slots[slot[open_]]
            hit = met == keys[open_]
            rank[open_[hit]] = self._slot_rank[slot[open_[hit]]]
            open_ = open_[~hit & (met >= 0)]
        return rank

    # -- encoding --------------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """Tokens of ``data`` as a whole: the lowest rank is merged first, from
        the left, by a queue of pairs and links between neighbours."""
        ids = [self.single[b] for b in data]
        n, ranks = len(ids), self.ranks
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(ranks[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapify(queue)
        while queue:
            _, i, pair = heappop(queue)
            j = right[i]
            if ids[i] != pair[0] or j >= n or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = ranks[pair][1], -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (p := (ids[a], ids[b])) in ranks:
                    heappush(queue, (ranks[p][0], a, p))
        return [t for t in ids if t >= 0]

    def stream(self, data: bytes):
        """Tokens of a piece of any length, emitted as they become stable."""
        at = 0
        while len(data) - at > self.window:
            end = at + self.window
            stable = end - self.lookahead
            ids, size, done = self.merge(data[at:end]), at, []
            for t in ids:
                size += len(self.bytes_of[t])
                if size > stable:
                    break
                done.append(t)
                at = size
            yield from done
        yield from self.merge(data[at:])

    def _learn(self, pieces: list[str]) -> None:
        """Merge many short pieces in step and remember their tokens."""
        data = [p.encode() for p in pieces]
        size = np.array([len(d) for d in data], np.int64)
        ids = self._byte_ids[np.frombuffer(b"".join(data), np.uint8)]
        who = np.arange(len(pieces))
        while len(who):
            first = np.cumsum(size) - size
            rank = np.full(len(ids), _NEVER)
            if len(ids) > 1:
                rank[:-1] = self._ranks_of((ids[:-1] << 32) | ids[1:])
            rank[first + size - 1] = _NEVER
            low = np.minimum.reduceat(rank, first)
            if (done := np.flatnonzero(low == _NEVER)).size:
                flat = ids.tolist()
                for k in done:
                    f = first[k]
                    self.known[pieces[who[k]]] = tuple(flat[f:f + size[k]])
                more = low < _NEVER
                stay = np.repeat(more, size)
                ids, rank, who, size, low = ids[stay], rank[stay], who[more], size[more], low[more]
            if not len(who):
                break
            hit = rank == np.repeat(low, size)
            # Of overlapping pairs (a run of one token) every second merges.
            where = np.arange(len(ids))
            begin = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), where, 0))
            hit &= (where - begin) % 2 == 0
            ids[hit] = self._merged[rank[hit]]
            kept = np.append(True, ~hit[:-1])
            size = np.add.reduceat(kept, np.cumsum(size) - size, dtype=np.int64)
            ids = ids[kept]

    def _pieces(self, text: str) -> list[str]:
        out, at = [], 0
        while at < len(text):
            cut = self.gap.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            end = cut.start() if cut else len(text)
            out += self.pattern.findall(text[at:end] if at or cut else text)
            at = end
        return out

    def encode_many(self, texts) -> list[list[int]]:
        """Ids of each text (null: none)."""
        lists = []
        for text in texts:
            pieces, at = [], 0
            for m in self.control.finditer(text or "") if self.control else ():
                pieces += self._pieces(text[at:m.start()])
                pieces.append(m.group())
                at = m.end()
            lists.append(pieces + self._pieces((text or "")[at:]))
        known = self.known
        got = [list(map(known.get, pieces)) for pieces in lists]
        new = set(chain.from_iterable(compress(p, map(not_, g)) for p, g in zip(lists, got)))
        if len(known) + len(new) > REMEMBERED:
            known = self.known = dict(self.fixed)
        self._learn([p for p in new if len(p) <= SHORT])
        long = {p: tuple(self.stream(p.encode())) for p in new if len(p) > SHORT}
        find = ChainMap(known, long).__getitem__ if long else known.__getitem__
        return [list(chain.from_iterable([g or find(p) for g, p in zip(got_, pieces)]))
                for got_, pieces in zip(got, lists)]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0]

    # -- decoding --------------------------------------------------------------

    def decode(self, ids, at_once: int = 1 << 14) -> str:
        """Text of ``ids``; unused ids of the vocabulary give nothing."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        get = self._pieces_of_bytes.__getitem__
        parts = [machine.decode(b"".join(map(get, ids[k:k + at_once]))) for k in range(0, len(ids), at_once)]
        return "".join(parts) + machine.decode(b"", True)


_coders: dict[tuple[int, bool], Coder] = {}


def coder_of(content: str, special: bool = True) -> Coder:
    """The coder, built once per Python worker."""
    k = hash(content), special
    if k not in _coders:
        _coders[k] = Coder(content, special)
    return _coders[k]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenize(docs: DataFrame, vocabulary: str, *, text: str = "text", carry=("doc_id",),
             decode: bool | str = True) -> DataFrame:
    """``carry`` columns, ``ids`` and, with ``decode``, ``decoded``: the text
    that the ids give back; or, with ``decode="compare"``, ``lossless``: whether
    that is the row's text. ``vocabulary``: content of the vocabulary file."""
    def make():
        coder = coder_of(vocabulary)

        def run(texts):
            # Many small lists and tuples, none of them in a cycle: the cycle
            # collector would only walk them.
            gc.disable()
            try:
                ids = coder.encode_many(texts)
            finally:
                gc.enable()
            out = [[np.frombuffer(array("i", x), np.int32) for x in ids]]
            if decode == "compare":
                return [*out, [coder.decode(x) == (t or "") for x, t in zip(ids, texts)]]
            return out + [[coder.decode(x) for x in ids]] if decode else out
        return run

    checked = {"lossless": "boolean"} if decode == "compare" else {"decoded": "string"} if decode else {}
    new = {"ids": "array<int>"} | checked
    return map_rows(docs, [F.col(text)], list(carry), make, new)
