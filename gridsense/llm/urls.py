"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

Every rule is a glob over the canonical URL ``.host/path``. All globs are laid
side by side in one row of bits, packed into 64-bit words; one step per byte
(Shift-And) moves all of them at once::

    D' = ((D << 1 | first) & eats[byte]) | (D & loops[byte])

``?`` eats one byte but ``/``, ``*`` any run without ``/`` and ``**`` any run.
The URLs of a batch are stepped together, so a step costs a few numpy
operations for the whole batch and all rules; a URL leaves once it is read.

The verdict of a URL is that of the longest host / path rule that fits (longest
by ``host + path``; of equally long ones a block goes before an allow); without
one it is ``block`` if a block glob matches, else ``allow``.

Host: what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or
the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or the end. A null
url, or one without ``://``, has an empty host and path (rule null, verdict
``allow``). Whole URLs are read whatever their length. Repeated rows are judged
once per row; columns other than the named ones are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import map_rows

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# The host / path rules of the query.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)
# Hosts of the kinds that are blocked where no rule above speaks.
BLOCK_GLOBS = (".**casino**/**", ".**free-bets**/**", ".**cheap-pills**/**")

# Letters for lower-casing A-Z alone.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _escape(text: str) -> str:
    """``text`` as a glob that matches it alone."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


class Automaton:
    """All globs as one row of states; state bits are word-packed."""

    def __init__(self, globs):
        eats, loops, self.ends = [], [], []
        firsts = []
        not_slash = np.ones(256, bool)
        not_slash[ord("/")] = False
        for g in globs:
            firsts.append(len(eats))
            # State 0 of a glob has read nothing; it loops on a leading run.
            eats.append(np.zeros(256, bool))
            loops.append(np.zeros(256, bool))
            data, i = g.encode(), 0
            while i < len(data):
                b = data[i:i + 1]
                if b == b"*":
                    deep = data[i + 1:i + 2] == b"*"
                    loops[-1] = np.ones(256, bool) if deep else loops[-1] | not_slash
                    i += 2 if deep else 1
                    continue
                if b == b"\\" and i + 1 < len(data):
                    i += 1
                    b = data[i:i + 1]
                eat = not_slash.copy() if b == b"?" else np.zeros(256, bool)
                if b != b"?":
                    eat[b[0]] = True
                eats.append(eat)
                loops.append(np.zeros(256, bool))
                i += 1
            self.ends.append(len(eats) - 1)
        n = len(eats)
        self.words = max(1, -(-n // 64))
        self.eats, self.loops = self._pack(eats), self._pack(loops)
        self.start = np.zeros(self.words, np.uint64)
        for f in firsts:
            self.start[f // 64] |= np.uint64(1) << np.uint64(f % 64)

    def _pack(self, states) -> np.ndarray:
        """(256, words) masks of the states that take each byte."""
        m = np.zeros((256, self.words), np.uint64)
        for s, takes in enumerate(states):
            m[takes, s // 64] |= np.uint64(1) << np.uint64(s % 64)
        return m

    def match(self, texts: list[bytes]) -> np.ndarray:
        """(texts, globs): which globs match which whole texts."""
        size = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-size, kind="stable")
        first = (np.cumsum(size) - size)[order]
        buf = np.frombuffer(b"".join(texts), np.uint8)
        steps = np.sort(size)
        d = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for j in range(int(size.max(initial=0))):
            m = len(steps) - np.searchsorted(steps, j, side="right")
            c, now = buf[first[:m] + j], d[:m]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            d[:m] = (moved & self.eats[c]) | (now & self.loops[c])
        out = np.empty((len(texts), len(self.ends)), bool)
        for k, e in enumerate(self.ends):
            out[order, k] = (d[:, e // 64] >> np.uint64(e % 64)) & one
        return out


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substr(u, F.instr(u, "://") + F.lit(3)))
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^?#]*", 0)
    host = F.regexp_extract(rest, r"(?s)^[^/]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.substr(rest, F.length(host) + F.lit(1))


def judge(pages: DataFrame, *, url: str = "url", carry=("page_id",), rules=RULES,
          block_globs=BLOCK_GLOBS) -> DataFrame:
    """``carry`` columns, ``host``, ``path``, ``rule`` and ``verdict`` of every row."""
    # Longest first; the first match decides.
    ranked = sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict != BLOCK, r.host + r.path))
    globs = [f"*.{_escape(r.host)}{_escape(r.path)}**" for r in ranked] + list(block_globs)
    names = [r.host + r.path for r in ranked]
    verdicts = [r.verdict for r in ranked] + [BLOCK] * len(block_globs)

    def make():
        automaton = Automaton(globs)

        def run(urls, hosts, paths):
            hit = automaton.match([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
            first = np.where(hit.any(1), hit.argmax(1), -1)
            return (hosts, paths, [names[k] if 0 <= k < len(names) else None for k in first],
                    [verdicts[k] if k >= 0 else ALLOW for k in first])
        return run

    host, path = canonical(F.col(url))
    return map_rows(pages, [F.col(url), host, path], list(carry), make,
                    {"host": "string", "path": "string", "rule": "string", "verdict": "string"})
