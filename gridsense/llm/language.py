"""Language identification by cross-parsing entropy.

A suffix automaton per language is built from labelled text. A text is
cross-parsed by each: cut greedily into phrases, each the longest match that
the automaton still reads. The language with the fewest phrases per byte,
normalised by the phrase's cost ``log2(size of the labelled text)``, wins.

The automaton runs over byte classes (a-z after lower-casing, each non-ASCII
byte of the labelled text, and one class for a run of anything else). Texts are parsed in segments of ``SEGMENT`` bytes, all segments
of a batch in step, one table look-up per byte and language; a phrase never
spans two segments. Whole texts are parsed.

Labelled text: at most ``MAX_BYTES`` per language and ``TOTAL_BYTES`` in all, of
the ``MAX_LANGUAGES`` languages with most labelled documents, taken from a sample
of about ``SAMPLE_DOCS`` documents per language (hash of the id), copies once, of
each a window of a sixteenth of the bound at a hashed place. These bounds are
parameters; they keep the tables (about 0.5 kB per labelled byte) small whatever
the corpus holds.

Defined results: ``und`` with score 0 for a null text, a text without a
letter (Unicode categories L*), or when nothing was labelled; a tie goes to
the language that comes first in order. Null languages and null ids are not
learned from. Repeated rows are judged once per row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import map_rows
from gridsense.llm.words import LOWER

UND = "und"
MAX_BYTES = 24_000
TOTAL_BYTES = 128_000
MAX_LANGUAGES = 128
SAMPLE_DOCS = 150
SEGMENT = 512
CHUNK = 2 << 20  # bytes parsed at once
GAP, FIRST, ASCII_CLASSES = 0, 1, 27  # classes: no letter 0, a-z 1-26, then non-ASCII bytes


def suffix_automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the automaton that reads every substring of ``symbols``."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


class Parser:
    """Cross-parses texts by the automata of several languages."""

    def __init__(self, labelled: dict[str, bytes]):
        self.langs = sorted(labelled)
        classes = np.zeros(256, np.uint8)
        classes[97:123] = np.arange(FIRST, FIRST + 26)
        high = sorted({b for t in labelled.values() for b in t if b >= 128})
        classes[high] = ASCII_CLASSES + np.arange(len(high), dtype=np.uint8)
        unseen = ASCII_CLASSES + len(high)
        classes[[b for b in range(128, 256) if b not in set(high)]] = unseen
        self.classes, self.width = classes[LOWER], unseen + 1
        self.tables = [self._table(labelled[k]) for k in self.langs]
        self.cost = np.array([np.log2(max(len(labelled[k]), 2)) for k in self.langs])

    def _table(self, text: bytes) -> np.ndarray:
        """Next state by state and class, times two; odd: a phrase ended and
        the class began the next one."""
        nxt = suffix_automaton(self._symbols([text])[0].tolist())
        alone = len(nxt)  # state after a class that the text does not have: a phrase of its own
        root = np.full(self.width, 2 * alone, np.int32)
        for c, q in nxt[0].items():
            root[c] = 2 * q
        t = np.tile(root + 1, (len(nxt) + 1, 1))
        t[0] = root  # nothing has ended at the start
        for s, to in enumerate(nxt):
            for c, q in to.items():
                t[s, c] = 2 * q
        return t.ravel()

    def _symbols(self, data: list[bytes]):
        """Classes of the texts, one after the other, and each text's number
        of them; a run without letters is one class."""
        c = self.classes[np.frombuffer(b"".join(data), np.uint8)]
        kept = (c != GAP) | np.append(True, c[:-1] != GAP)
        ends = np.cumsum([len(d) for d in data])
        upto = np.append(0, np.cumsum(kept))[ends]
        return c[kept], np.diff(upto, prepend=0)

    def phrases(self, data: list[bytes]):
        """Number of phrases of each text by each language, and its size."""
        buf, size = self._symbols(data)
        n_seg = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(data)), n_seg)
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        first = np.repeat(start, n_seg) + SEGMENT * (np.arange(len(owner)) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg))
        length = np.minimum(SEGMENT, np.repeat(start + size, n_seg) - first)
        order = np.argsort(-length, kind="stable")
        owner, first, length = owner[order], first[order], length[order]
        buf = buf.astype(np.int64)
        active = np.searchsorted(-length, -np.arange(1, SEGMENT + 1), side="right")
        out = np.zeros((len(data), len(self.langs)))
        for k, table in enumerate(self.tables):
            state = np.zeros(len(owner), np.int64)
            count = np.zeros(len(owner), np.int64)
            for j in range(SEGMENT):
                m = active[j]
                if not m:
                    break
                to = table[state[:m] * self.width + buf[first[:m] + j]]
                count[:m] += to & 1
                state[:m] = to >> 1
            out[:, k] = np.bincount(owner, count + 1, len(data))
        return out, size

    def judge(self, texts) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        langs, scores = [UND] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return langs, scores
        at = 0
        while at < len(texts):
            end, room, ids, data = at, 0, [], []
            while end < len(texts) and room < CHUNK:
                t = texts[end]
                if isinstance(t, str) and has_letter(t):
                    ids.append(end)
                    data.append(t.encode())
                    room += len(data[-1])
                end += 1
            at = end
            if not ids:
                continue
            count, size = self.phrases(data)
            bits = count * self.cost / np.maximum(size, 1)[:, None]
            best = np.argmin(bits, 1)
            p = np.exp2(bits.min(1, keepdims=True) - bits)
            scores[ids] = 1 / p.sum(1)
            for i, b in zip(ids, best):
                langs[i] = self.langs[b]
        return langs, scores


_ASCII_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def has_letter(text: str) -> bool:
    return any(c in _ASCII_LETTERS or c.isalpha() for c in text)


def labelled_text(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id",
                  max_bytes: int = MAX_BYTES, total_bytes: int = TOTAL_BYTES,
                  max_languages: int = MAX_LANGUAGES) -> dict[str, bytes]:
    """At most ``max_bytes`` of text of each of ``max_languages`` languages, from
    a sample of the labelled documents ``docs``."""
    d = docs.where(F.col(lang).isNotNull() & F.col(key).isNotNull() & (F.col(lang) != UND)
                   & (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0))
    counts = {r[0]: r[1] for r in d.groupBy(lang).count().orderBy(F.desc("count"), lang)
              .limit(max_languages).collect()}
    if not counts:
        return {}
    room = min(max_bytes, total_bytes // len(counts))
    # Languages are few; a row is in the sample if its hash falls under the
    # share that gives its language about SAMPLE_DOCS rows.
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(lang) == F.lit(name), F.lit(min(1.0, SAMPLE_DOCS / n))).otherwise(share)
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << 20)) / float(1 << 20)
    size = max(room // 16, 1)
    place = F.pmod(F.xxhash64(key), F.greatest(F.length(text) - size + 1, F.lit(1)).cast("long"))
    rows = d.where(hashed < share).withColumn("__t", F.xxhash64(text)).dropDuplicates([lang, "__t"]) \
        .select(F.col(lang).alias("l"), F.xxhash64(key).alias("h"),
                F.substring(F.col(text), place.cast("int") + 1, F.lit(size)).alias("t")) \
        .orderBy("h", "t").limit(8 * SAMPLE_DOCS * len(counts)).collect()
    out: dict[str, bytes] = {}
    for r in rows:
        have = out.get(r["l"], b"")
        if len(have) < room:
            out[r["l"]] = (have + r["t"].encode() + b"\n")[:room]
    return out


_parsers: dict[int, Parser] = {}


def parser_of(labelled: dict[str, bytes]) -> Parser:
    """The parser, built once per Python worker."""
    k = hash(tuple(sorted(labelled.items())))
    if k not in _parsers:
        _parsers.clear()
        _parsers[k] = Parser(labelled)
    return _parsers[k]


def identify(docs: DataFrame, labelled: dict[str, bytes], *, text: str = "text", carry=("doc_id",)) -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score`` of every row."""
    def make():
        return parser_of(labelled).judge

    return map_rows(docs, [text if "." in text else F.col(text)], list(carry), make, {"lang_pred": "string", "score": "double"})
