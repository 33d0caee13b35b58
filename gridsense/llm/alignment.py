"""Cross-tokenizer alignment by byte spans.

A text is encoded by a byte-level BPE (A) and by a sentencepiece model (B), and
the tokens of both are placed on the bytes of one string: the text after one
space, the prefix that B adds by itself. The spans that the libraries give,
character offsets of A and spans of B's proto, are the coarse cuts. They are
exact where every token covers whole characters that stand for themselves; in
texts with multibyte characters or byte-fallback tokens the cuts inside are
refined from the tokens' decoded bytes. Decoded bytes are also compared with the
string: a text that either tokenizer does not give back has no tokens.

Byte places where tokens of both end cut them into groups. Tokens whose ranges
overlap are linked. Links of a pair of ids are counted by documents over the
whole corpus, and each document's links are weighed by these counts.

Both tokenizers are called on the distinct segments of texts, cut at single
spaces between other characters. A begins a word at such a space; B has no piece
that holds a space beyond its beginning (this is checked against the model,
whose normaliser must leave texts as they are; otherwise whole texts are the
segments). So tokens of both end there, and groups and links of a text are those
of its segments. What a segment gives is remembered (``REMEMBERED`` per worker).

Links leave a task as distinct pairs with their number per document and are
written once. Counting them is a grouped count, partial before the shuffle. The
counts go back to the documents as a sorted table of at most ``PAIRS_AT_ONCE``
pairs, a size that is checked; more pairs go in blocks by ranges of A's ids, one
pass over the written links each, whose sums per document are added.

Defined results: texts null or empty, or not given back, have no tokens: zeros,
and an empty ``groups``. Repeated rows are documents of their own. A table
without rows gives none. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import base64
import gc
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.bpe import byte_alphabet
from gridsense.llm.tables import give_back, keep, map_rows

REMEMBERED = 700_000  # segments after which a worker begins anew
CALL = 500  # segments given to the libraries at once
PAIRS_AT_ONCE = 4_000_000  # pairs with counts that a pass sends to the tasks

_GAP = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" \s|\s ")
SPACE = "▁"  # stands for a space in B's pieces


class Segments:
    """What each known segment gives, by its number: tokens of A and of B
    (-1: not given back), groups, groups as text, links."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.empty((1024, 3), np.int32)  # tokens of A, of B, groups
        self.first = np.zeros(1025, np.int64)  # of its links
        self.links = np.empty(8192, np.uint32)  # an id of A times B's size plus one of B: below 2**32

    def add(self, texts: list[str], counts: np.ndarray, groups: list[str], links: np.ndarray, n_links: np.ndarray) -> None:
        n, m = len(self.groups), len(texts)
        while n + m > len(self.counts):
            self.counts = np.concatenate([self.counts, np.empty_like(self.counts)])
            self.first = np.append(self.first, np.zeros(len(self.first) - 1, np.int64))
        end = self.first[n]
        while end + len(links) > len(self.links):
            self.links = np.append(self.links, np.empty_like(self.links))
        self.counts[n:n + m] = counts
        self.links[end:end + len(links)] = links
        self.first[n + 1:n + m + 1] = end + np.cumsum(n_links)
        self.groups += groups
        self.number.update(zip(texts, range(n, n + m)))

    def add_bad(self, text: str) -> None:
        self.add([text], np.array([[-1, -1, -1]]), [""], np.empty(0, np.int64), np.zeros(1, np.int64))


class Aligner:
    """Both tokenizers, and what each segment gives."""

    def __init__(self, vocabulary: str, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        alphabet = byte_alphabet()
        spec = json.loads(vocabulary)
        entries = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.b = SentencePieceProcessor(model_proto=model)
        self.n_b = self.b.vocab_size()
        if self.n_b * len(self.a_bytes) >= 1 << 32:
            raise ValueError("the two vocabularies have 2**32 pairs of ids or more")
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.fallback = np.array([self.b.is_byte(i) for i in range(self.n_b)])
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        # Spans of the proto are in bytes or, in some versions, in characters.
        self.spans_in_bytes = self._proto("é").pieces[-1].end == 2
        self.apart = self._segments_are_apart(pieces)
        self.known = Segments()

    def _proto(self, text: str):
        """B's tokens of a text with their spans."""
        return self.b.encode(text, return_type="proto")

    def _segments_are_apart(self, pieces: list[str]) -> bool:
        """No piece holds a space after something else, and the normaliser
        leaves text alone but for the prefix."""
        probe = ["AÅﬁ① x", "a  b ", " é\t\n."]
        same = all(b"".join(self.b_bytes[i] for i in self.b.encode(t)) == (" " + t).encode() for t in probe)
        return same and not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def segments(self, text: str) -> list[str]:
        """The text cut at single spaces between other characters."""
        if not self.apart:
            return [text]
        if text[0] == " " or text[-1] == " " or _ODD.search(text):
            return _GAP.split(text)
        return text.split(" ")

    def learn(self, texts: list[str]) -> None:
        """Align new segments. Those that neither begin nor end with white
        space stand apart also when many are encoded as one text."""
        plain = []
        for t in texts:
            if SPACE in t:
                self.known.add_bad(t)  # B gives it back as a space
            elif not self.apart or t[0].isspace() or t[-1].isspace():
                self._learn([t])
            else:
                plain.append(t)
        for k in range(0, len(plain), CALL):
            self._learn(plain[k:k + CALL])

    def _learn(self, texts: list[str]) -> None:
        whole = " ".join(texts)
        data = (" " + whole).encode()
        proto = self._proto(whole).pieces
        b = np.array([x.id for x in proto], np.int64)
        # A is faster on texts of about a hundred words; segments stand apart.
        parts = [" " + " ".join(texts[k:k + 100]) for k in range(0, len(texts), 100)]
        found = self.a.encode_batch(parts, add_special_tokens=False)
        begin = np.cumsum([0, *map(len, parts)])
        a = np.array(list(chain.from_iterable(e.ids for e in found)), np.int64)
        span = np.concatenate([np.array(e.offsets, np.int64).reshape(-1, 2) + x for e, x in zip(found, begin.tolist())])
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data \
                or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != data:
            if len(texts) == 1:
                self.known.add_bad(texts[0])
            else:  # find those that are not given back
                self._learn(texts[:len(texts) // 2])
                self._learn(texts[len(texts) // 2:])
            return
        # Bytes before each character, for spans in characters.
        raw = np.frombuffer(data, np.uint8)
        chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        # A cut of A is inside a character where the next token's span begins before it.
        inside = np.append(span[1:, 0] < span[:-1, 1], False)
        ends_a = np.where(inside, np.cumsum(self.a_size[a]), chars[span[:, 1]])
        end = np.array([x.end for x in proto], np.int64) + 1
        ends_b = np.where(self.fallback[b], np.cumsum(self.b_size[b]), end if self.spans_in_bytes else chars[end])
        # Every segment and the space before it; tokens of both end there.
        stop = np.cumsum([len(t.encode()) + 1 for t in texts])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        to_a, to_b, to_g = (np.searchsorted(x, stop, "right") for x in (ends_a, ends_b, both))
        # B tokens whose range meets that of an A token: one run of them.
        lo = np.searchsorted(ends_b, np.append(0, ends_a[:-1]), "right")
        n = np.searchsorted(ends_b, ends_a, "left") + 1 - lo
        links = np.repeat(a, n) * self.n_b + b[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        n_links = np.diff(np.append(0, np.cumsum(n)[to_a - 1]))

        def by_group(ids: np.ndarray, ends: np.ndarray) -> list[str]:
            cut = np.isin(ends, both, assume_unique=True)
            text = ",".join(map(str, ids.tolist())).split(",") if cut.all() else None
            return text or "".join([f"{i};" if c else f"{i}," for i, c in zip(ids.tolist(), cut.tolist())])[:-1].split(";")

        groups = [f"{x}|{y}" for x, y in zip(by_group(a, ends_a), by_group(b, ends_b))]
        cuts = to_g.tolist()
        self.known.add(texts, np.stack([np.diff(to_a, prepend=0), np.diff(to_b, prepend=0), np.diff(to_g, prepend=0)], 1),
                       [";".join(groups[x:y]) for x, y in zip([0, *cuts], cuts)], links, n_links)

    def align(self, texts) -> list:
        """Columns of a list of texts: tokens of A and of B, groups, links,
        groups as text, distinct linked pairs, how often each."""
        cut = [self.segments(t) if t else [] for t in texts]
        if len(self.known.groups) > REMEMBERED:
            self.known = Segments()
        known = self.known
        self.learn(list(set(chain.from_iterable(cut)).difference(known.number)))
        number = np.fromiter(map(known.number.__getitem__, chain.from_iterable(cut)), np.int64)
        n = np.array(list(map(len, cut)), np.int64)
        row = np.repeat(np.arange(len(cut)), n)
        bad = np.zeros(len(cut), bool)
        bad[row[known.counts[number, 0] < 0]] = True
        stays = ~bad[row]
        number, row = number[stays], row[stays]
        sums = np.stack([np.bincount(row, c, len(cut)) for c in known.counts[number].T], 1).astype(np.int64)
        first, size = known.first[number], known.first[number + 1] - known.first[number]
        links = known.links[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        owner = np.repeat(row, size)
        n_links = np.bincount(owner, minlength=len(cut))
        both = np.sort(owner << 32 | links)
        links, owner = both & 0xFFFFFFFF, both >> 32
        new = np.flatnonzero(np.append(True, (links[1:] != links[:-1]) | (owner[1:] != owner[:-1]))[:len(links)])
        pairs, times = links[new], np.diff(np.append(new, len(links))).astype(np.int32)
        at = np.searchsorted(owner[new], np.arange(len(cut) + 1)).astype(np.int32)
        names, here = number.tolist(), np.searchsorted(row, np.arange(len(cut) + 1)).tolist()
        text = known.groups
        groups = [";".join([text[k] for k in names[x:y]]) for x, y in zip(here, here[1:])]
        return [sums[:, 0], sums[:, 1], sums[:, 2], n_links, groups,
                pa.ListArray.from_arrays(pa.array(at), pa.array(pairs)),
                pa.ListArray.from_arrays(pa.array(at), pa.array(times))]


_aligners: dict[tuple, Aligner] = {}


def aligner_of(vocabulary: str, model: str) -> Aligner:
    """The aligner, built once per Python worker (``model`` in base 64)."""
    k = hash(vocabulary), hash(model)
    if k not in _aligners:
        _aligners[k] = Aligner(vocabulary, base64.b64decode(model))
    return _aligners[k]


def read_model(path: str) -> str:
    """Content of a model file, in base 64."""
    with open(path, "rb") as f:
        return base64.b64encode(f.read()).decode()


def model_size(model: str) -> int:
    """Ids of a model given by :func:`read_model`."""
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_proto=base64.b64decode(model)).vocab_size()


def align(docs: DataFrame, vocabulary: str, model: str, *, text: str = "text", carry=("doc_id",)) -> DataFrame:
    """``carry`` columns, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (``a,a|b;a|b,b``: ids of A and B by group) and the distinct
    linked pairs of ids: ``pairs`` (A's id times B's vocabulary size plus B's)
    with their number, ``times``."""
    def make():
        aligner = aligner_of(vocabulary, model)

        def run(texts):
            gc.disable()  # many strings, none of them in a cycle
            try:
                return aligner.align(texts)
            finally:
                gc.enable()
        return run

    new = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string",
           "pairs": "array<long>", "times": "array<int>"}
    return map_rows(docs, [F.col(text)], list(carry), make, new)


def _weighed(aligned: DataFrame, keys: np.ndarray, counts: np.ndarray, n_b: int) -> DataFrame:
    """Rows with ``n_best`` and ``count_sum`` over the links whose pair is
    among ``keys`` (sorted; all pairs of an A id are, or none)."""
    where = np.flatnonzero(np.append(True, np.diff(keys // n_b) != 0)) if len(keys) else np.empty(0, np.int64)
    most = np.repeat(np.maximum.reduceat(counts, where), np.diff(np.append(where, len(keys)))) if len(keys) else counts
    best = counts == most
    names = [c for c in aligned.columns if c not in ("pairs", "times")]
    lo, hi = (int(keys[0]), int(keys[-1])) if len(keys) else (0, -1)

    def run(batches):
        for b in batches:
            pairs, times = b.column("pairs"), b.column("times")
            at = np.asarray(pairs.offsets)
            p, t = np.asarray(pairs.flatten()), np.asarray(times.flatten())
            row = np.repeat(np.arange(len(pairs)), np.diff(at))
            here = (p >= lo) & (p <= hi)
            place = np.searchsorted(keys, p[here])
            row, t = row[here], t[here].astype(np.int64)
            n_best, total = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            np.add.at(n_best, row, t * best[place])
            np.add.at(total, row, t * counts[place])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(n_best), pa.array(total)],
                                             [*names, "n_best", "count_sum"])
            del b, pairs, times
            give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name in names)
    return aligned.select(*names, "pairs", "times").mapInArrow(run, f"{fields}, n_best long, count_sum long")


def weigh(aligned: DataFrame, n_b: int, pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """The written rows of :func:`align` without ``pairs`` and ``times``, with
    ``n_best`` (links whose count is the highest of their A id, ties included)
    and ``count_sum`` (counts over all links). The count of a pair: how many
    rows hold it linked. ``n_b``: B's vocabulary size."""
    counts = keep(aligned.select(F.explode("pairs").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")), "pairs")
    total = counts.count()

    def part(lo: int, hi: int | None):
        own = counts.where((F.col("p") >= lo * n_b) & (F.col("p") < (hi * n_b if hi is not None else (1 << 62))))
        got = own.toArrow()  # pairs_at_once rows at most, or those of one A id
        p, n = got["p"].to_numpy(), got["n"].to_numpy()
        order = np.argsort(p)
        return p[order], n[order]

    if total <= pairs_at_once:
        return _weighed(aligned, *part(0, None), n_b)
    # Ranges of A's ids (a vocabulary of them at most) that hold so many pairs.
    by_a = counts.groupBy(F.floor(F.col("p") / n_b).alias("a")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    ids, n = by_a["a"].to_numpy(), by_a["n"].to_numpy()
    order = np.argsort(ids)
    cuts, held = [0], 0
    for a, k in zip(ids[order].tolist(), n[order].tolist()):
        if held and held + k > pairs_at_once:
            cuts.append(a)
            held = 0
        held += k
    rows = keep(aligned.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    sums = None
    for lo, hi in zip(cuts, [*cuts[1:], None]):
        one = keep(_weighed(rows.select("__row", "pairs", "times"), *part(lo, hi), n_b), "weighed")
        sums = one if sums is None else sums.unionByName(one)
    sums = sums.groupBy("__row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "__row").drop("__row")
