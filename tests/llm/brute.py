"""Plain Python versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile("[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, width=5):
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def components(rows, percent=80):
    """{index: (set size, smallest key of its component)} of (key, text) rows."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and sets[j] and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [(len(s), least.get(root(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def hits(text, items, width=10):
    """(number of words, hit word places, ids of items) of a text."""
    w = ITEM_WORDS.findall((text or "").translate(LOWER))
    places, ids = set(), set()
    for key, item in items:
        v = ITEM_WORDS.findall((item or "").translate(LOWER))
        n = min(width, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in windows:
                places |= set(range(i, i + n))
                ids.add(key)
    return len(w), places, ids


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    rest = re.split("[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    host, path = host.translate(LOWER), slash + path
    fits = [r for r in RULES if ("." + host).endswith("." + r[1]) and path.startswith(r[2])]
    if fits:
        v, h, p = max(fits, key=lambda r: len(r[1] + r[2]))
        return host, path, h + p, v
    spam = path and any(s in host for s in ("casino", "free-bets", "cheap-pills"))
    return host, path, None, "block" if spam else "allow"
