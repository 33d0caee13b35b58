"""Words of whole texts as 64-bit hashes, computed on byte arrays.

A batch of texts is joined into one UTF-8 buffer; word bounds come from a
256-entry byte table and word hashes from prefix sums of a polynomial hash
(modulo 2**64), so the cost per byte is a few numpy operations. Both word
definitions used here only look at bytes below 0x80 and treat every byte of a
non-ASCII character alike, so working on UTF-8 bytes is exact.

Null texts count as empty. Texts longer than a buffer are cut between words
and put together again, so a very long text needs one word hash (8 bytes) per
word and no more than one buffer of work arrays.
"""

from __future__ import annotations

import numpy as np

BUFFER = 1 << 19  # bytes hashed at once

_A_Z = np.arange(256, dtype=np.uint8)
_A_Z[65:91] += 32
LOWER = _A_Z  # A-Z to a-z, every other byte as it is

# Bytes that belong to a word.
NON_SPACE = np.ones(256, dtype=bool)  # everything but space and \t \n \v \f \r
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False
LETTERS_DIGITS = np.zeros(256, dtype=bool)  # 0-9 a-z (A-Z) and every non-ASCII byte
LETTERS_DIGITS[48:58] = LETTERS_DIGITS[65:91] = LETTERS_DIGITS[97:123] = LETTERS_DIGITS[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base, of its inverse


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of a multiply-xorshift hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int):
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        inverse = pow(int(_BASE), -1, 1 << 64)
        for k, b in enumerate((int(_BASE), inverse)):
            t = np.full(size, np.uint64(b), np.uint64)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes, as they are, of each span of a buffer."""
    up, down = _power_tables(len(buf) + 1)
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_CODES[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _hash_buffer(buf: np.ndarray, in_word: np.ndarray):
    """(hash, start) of each word of a buffer whose last byte is no word byte."""
    w = in_word[buf].view(np.int8)
    edge = np.diff(w, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(buf) + 1)
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_CODES[LOWER[buf]] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts


def _long_text(data: bytes, in_word: np.ndarray) -> np.ndarray:
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + BUFFER)
        while end < len(data) and in_word[data[end]]:
            step = np.flatnonzero(~in_word[np.frombuffer(data[end:end + BUFFER], np.uint8)])
            end = end + int(step[0]) if len(step) else min(len(data), end + BUFFER)
        parts.append(_hash_buffer(np.frombuffer(data[at:end] + b"\n", np.uint8), in_word)[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def word_hashes(texts, in_word: np.ndarray = NON_SPACE):
    """Hashes of the words of each text: ``(flat, offsets)``; the words of
    text ``i`` are ``flat[offsets[i]:offsets[i + 1]]``, in order."""
    flat, counts, group, size = [], [], [], 0

    def flush():
        nonlocal group, size
        if group:
            buf = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
            h, starts = _hash_buffer(buf, in_word)
            bounds = np.cumsum([len(g) + 1 for g in group])
            counts.append(np.diff(np.searchsorted(starts, bounds), prepend=0))
            flat.append(h)
        group, size = [], 0

    for t in texts:
        data = t.encode() if isinstance(t, str) else b""
        if len(data) > BUFFER:
            flush()
            h = _long_text(data, in_word)
            flat.append(h)
            counts.append(np.array([len(h)]))
            continue
        if size + len(data) > BUFFER:
            flush()
        group.append(data)
        size += len(data) + 1
    flush()
    offsets = np.concatenate([np.zeros(1, np.int64), *counts]).cumsum() if counts else np.zeros(1, np.int64)
    return (np.concatenate(flat) if flat else np.empty(0, np.uint64)), offsets


def ngrams(flat: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words beginning at each word (the last ``n - 1``
    entries, and those that reach into a next text, are the caller's to drop)."""
    if n == 1:
        return flat
    m = len(flat) - n + 1
    out = np.zeros(max(m, 0), np.uint64)
    if m > 0:
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + flat[k:k + m]
    return mix(out + np.uint64(n))


def combine(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence, as :func:`ngrams` gives for its length."""
    return ngrams(words, len(words))[0]
