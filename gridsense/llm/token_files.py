"""Token ids in files of Simple-8b words.

A file holds the ids of consecutive documents. Ids are cut into blocks of
``BLOCK`` ids (across documents) and each block into 64-bit words: the upper
four bits of a word select how many ids of how many bits its other 60 bits hold,
the first id lowest. Each word takes as many of the next ids as fit. An id of
more than 60 bits is an escape: its word holds a place in the file's table of
full 64-bit values. A table of the words at which blocks begin lets a reader
decode any range of ids, and all words of one selector are decoded at once.

File layout, little-endian, 8-byte aligned::

    magic | ids, documents, blocks, words, escapes (uint64 each)
    document ids (int64) | first id of each document in the file (uint64)
    first word of each block (uint64, and the number of words) | words | escapes

:func:`write_tokens` deals the documents by ranges of their id, encodes the
texts of a range in order and writes files of about ``FILE_IDS`` ids to the
shared folder, each under a name of its own. A task gives one row per file; only
rows of tasks that succeed reach the manifest, so a file of a lost executor is
never read. A file's place in the whole sequence is a prefix sum over ranges,
then over the files of a range: text and ids are never gathered.

Encoding calls the tokenizers library on the distinct chunks of texts (cut at
spaces and line breaks, and between letters and the usual marks) and remembers
their ids by a 64-bit hash of their bytes and length, where the vocabulary file
removes white space between words and lets no word span such a cut
(:func:`chunks_are_apart`); with any other file it calls it on whole texts.

Defined results: a null text counts as empty and has the end id alone;
documents without an id come first (the least 64-bit integer stands for their
id in a file); rows of equal id are ordered by a hash of their text, repeated
rows are repeated documents; an empty table gives an empty manifest.
Columns other than the named ones are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridsense.llm.tables import arrow_slices, give_back, keep
from gridsense.llm.words import span_hashes
from gridsense.session import new_work_path

# Ids per word and bits per id of the selectors 2 to 15 of the
# word format; selector 1 holds 120 zeros, selector 0 is the escape.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0
MAGIC = b"S8BTOKN1"
BLOCK = 512  # ids of a block
FILE_IDS = 16_000_000  # a file is closed at the first document's end beyond it
STEP = 1024 * BLOCK  # ids packed at once
NO_ID = -(1 << 63)  # stands for a document without an id
READERS = 10_000  # tasks that read files, at most
REMEMBERED = 2_000_000  # chunks of text after which a worker begins anew (about 60 bytes each)
PIECE = 1 << 20  # bytes of text cut into chunks at once
CALL = 500  # chunks given to the library at once

_CHUNK_KIND = np.full(256, 8, np.uint8)  # of a byte: white space 0, letter or digit 1, usual mark 2, any other 8
_CHUNK_KIND[[10, 32]] = 0
_CHUNK_KIND[48:58] = _CHUNK_KIND[65:91] = _CHUNK_KIND[97:123] = 1
_CHUNK_KIND[list(b".,;:!?")] = 2
_COUNTS = np.array(COUNTS)
_POWERS = np.array([1 << k for k in range(64)], np.uint64)


# -- the word format ---------------------------------------------------------------

def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block and the number of words, escapes)."""
    words, first, escapes, n, held = [], [np.zeros(1, np.uint64)], [], 0, 0
    for at in range(0, len(values), STEP):
        w, f, e = _pack(np.asarray(values[at:at + STEP], np.uint64), held)
        words.append(w)
        first.append(f[1:] + np.uint64(n))
        escapes.append(e)
        n, held = n + len(w), held + len(e)
    none = [np.empty(0, np.uint64)]
    return np.concatenate(words or none), np.concatenate(first), np.concatenate(escapes or none)


def _pack(values: np.ndarray, escaped: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`pack` of whole blocks, after so many escapes."""
    n = len(values)
    blocks = -(-n // BLOCK)
    # Bits of each id, and the most in windows of 1, 2, 4, ... ids. Places
    # beyond a block's end need none: its last word may hold fewer ids.
    need = np.zeros((blocks, BLOCK + COUNTS[1]), np.uint8)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = np.searchsorted(_POWERS, values, "right")
    need[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    windows = [need]
    while 2 << len(windows) <= 2 * COUNTS[1]:
        half = 1 << (len(windows) - 1)
        wider = windows[-1].copy()
        np.maximum(wider[:, :-half], windows[-1][:, half:], out=wider[:, :-half])
        windows.append(wider)
    best = np.zeros((blocks, BLOCK), np.uint8)
    for s in range(len(COUNTS) - 1, 0, -1):
        k = COUNTS[s].bit_length() - 1  # two windows of a power of two cover the word's ids
        far = COUNTS[s] - (1 << k)
        most = np.maximum(windows[k][:, :BLOCK], windows[k][:, far:far + BLOCK])
        best[most <= BITS[s]] = s
    best = best.ravel()
    ends = np.minimum((np.arange(n) // BLOCK + 1) * BLOCK, n)
    # All blocks take their next word in step.
    at, stop = np.arange(blocks) * BLOCK, np.minimum((np.arange(blocks) + 1) * BLOCK, n)
    who, starts, owners = np.arange(blocks), [], []
    while len(who):
        here = at[who]
        starts.append(here)
        owners.append(who)
        here = here + _COUNTS[best[here]]
        at[who] = here
        who = who[here < stop[who]]
    first = np.append(0, np.cumsum(np.bincount(np.concatenate(owners), minlength=blocks)))
    start = np.sort(np.concatenate(starts))
    chosen = best[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[own] |= np.arange(escaped, escaped + len(own), dtype=np.uint64)
            continue
        if not BITS[s]:
            continue
        full = own[start[own] + COUNTS[s] <= ends[start[own]]]
        place = start[full]
        for j in range(COUNTS[s]):
            words[full] |= values[place + j] << np.uint64(j * BITS[s])
        for k in np.setdiff1d(own, full, assume_unique=True).tolist():  # at most one of a block
            for j, v in enumerate(values[start[k]:ends[start[k]]].tolist()):
                words[k] |= np.uint64(v << (j * BITS[s]))
    return words, first.astype(np.uint64), values[start[chosen == ESCAPE]]


def unpack(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of all blocks of ``words``."""
    out = np.zeros(n, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # Where each word's ids begin: blocks begin at multiples of BLOCK.
    before = np.append(0, np.cumsum(_COUNTS[selector]))
    first = first.astype(np.int64)
    block = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = block * BLOCK + before[:-1] - before[first[block]]
    end = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[start[own]] = escapes[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        if not BITS[s]:
            continue
        low = np.uint64((1 << BITS[s]) - 1)
        for j in range(COUNTS[s]):
            if j:  # words at a block's end may hold fewer
                own = own[start[own] + j < end[own]]
            out[start[own] + j] = (words[own] >> np.uint64(j * BITS[s])) & low
    return out


def to_bytes(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents with the given ids and numbers of tokens."""
    words, first, escapes = pack(ids)
    head = np.array([len(ids), len(doc_ids), len(first) - 1, len(words), len(escapes)], "<u8")
    begin = np.cumsum(sizes) - sizes
    return b"".join([MAGIC, head.tobytes(), np.asarray(doc_ids, "<i8").tobytes(), begin.astype("<u8").tobytes(),
                     first.astype("<u8").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


class TokenFile:
    """A file's content: its documents, and any range of its ids."""

    def __init__(self, data: bytes):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.n, docs, blocks, words, escapes = map(int, np.frombuffer(data, "<u8", 5, 8))
        at = 48

        def take(kind, count):
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += 8 * count
            return got

        self.doc_ids, self.begin = take("<i8", docs), take("<u8", docs)
        self.first, self.words, self.escapes = take("<u8", blocks + 1), take("<u8", words), take("<u8", escapes)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks they lie in."""
        end = self.n if end is None else min(end, self.n)
        if start >= end:
            return np.empty(0, np.uint64)
        lo, hi = start // BLOCK, -(-end // BLOCK)
        first = self.first[lo:hi + 1]
        got = unpack(self.words[int(first[0]):int(first[-1])], first - first[0], self.escapes,
                     min(hi * BLOCK, self.n) - lo * BLOCK)
        return got[start - lo * BLOCK:end - lo * BLOCK]


# -- encoding -------------------------------------------------------------------

def chunks_are_apart(vocabulary: str) -> bool:
    """Whether texts can be cut at spaces and line breaks, and between an ASCII
    letter or digit and one of ``.,;:!?``: normalising looks at single characters
    or composes letters with accents, what the pattern gives as words holds no
    white space and letters, digits and marks apart, and no added token holds
    any of these."""
    spec = json.loads(vocabulary)
    norm = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = norm["normalizers"] if norm["type"] == "Sequence" else [norm]
    plain = all(s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"}
                                                      and s["content"] == " ") for s in steps)
    pre = spec.get("pre_tokenizer") or {}
    parts = pre["pretokenizers"] if pre.get("type") == "Sequence" else [pre]
    split = parts[0]
    # What matches becomes words, the rest goes: letters, digits or others, or a short form.
    forms = split.get("pattern", {}).get("Regex", "").split("|")
    drops = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"] \
        and all(re.fullmatch(r"'[a-z]+|\[?\\p\{[LN]\}\]?\+?|\[\^\\s\\p\{L\}\\p\{N\}\]\+", f) for f in forms)
    rest = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in parts[1:])
    added = spec.get("added_tokens", [])
    whole = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                    or any(c.isspace() or c in ".,;:!?" for c in t["content"]) for t in added)
    return bool(plain and drops and rest and whole and spec.get("post_processor") is None)


class Encoder:
    """Ids of texts by the tokenizers library."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.apart = chunks_are_apart(vocabulary)
        spec = json.loads(vocabulary)
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        # A-Z may be lowered beforehand (bytes.lower leaves other bytes alone)
        # where the file lowers all, but for the names of added tokens.
        self.lowers = '"Lowercase"' in json.dumps(spec.get("normalizer"))
        self._forget()

    def _forget(self) -> None:
        # Chunks by hash, in order; where each one's ids are.
        self.hashes, self.entry = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.first, self.ids = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of chunks, many in a call: they stand apart in a text,
        and the places of tokens in it tell whose they are."""
        ids, sizes = [self.ids], []
        for k in range(0, len(chunks), CALL):
            some = chunks[k:k + CALL]
            found = self.library.encode(" ".join(some), add_special_tokens=False)
            begin = np.cumsum([len(c) + 1 for c in some])
            place = np.array([x for x, _ in found.offsets], np.int64)
            sizes.append(np.diff(np.searchsorted(place, begin, "left"), prepend=0))
            ids.append(np.array(found.ids, np.uint32))
        self.ids = np.concatenate(ids)
        self.first = np.append(self.first, self.first[-1] + np.cumsum(np.concatenate(sizes)))

    def _entries(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, entry) of each chunk of a text that ends with a line break."""
        buf = np.frombuffer(data, np.uint8)
        kind = _CHUNK_KIND[buf]
        # A chunk ends at a space or line break, and where an ASCII letter or
        # digit and one of the usual marks meet, which words never span.
        met = kind[1:] + kind[:-1]
        cut = np.append(True, (met == 3) | (kind[1:] == 0) | (kind[:-1] == 0))
        starts = np.flatnonzero(cut & (kind > 0))
        ends = np.append(np.flatnonzero(cut), len(buf))
        ends = ends[np.searchsorted(ends, starts, "right")]
        names, one, which = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, names)
        known = np.append(self.hashes, 0)[at] == names if len(self.hashes) else np.zeros(len(names), bool)
        known &= at < len(self.hashes)
        new = np.flatnonzero(~known)
        if len(new):
            n = len(self.first) - 1
            self._learn([data[x:y].decode() for x, y in zip(starts[one[new]].tolist(), ends[one[new]].tolist())])
            self.hashes = np.insert(self.hashes, at[new], names[new])
            self.entry = np.insert(self.entry, at[new], np.arange(n, n + len(new)))
            at = np.searchsorted(self.hashes, names)
        return starts, self.entry[at][which]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each text's)."""
        if not self.apart:
            lists = [e.ids for e in self.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(lists), np.uint32), np.array(list(map(len, lists)), np.int64)
        if len(self.first) > REMEMBERED:
            self._forget()
        data = [(t or "").encode() for t in texts]
        if self.lowers:
            data = [d if any(a in d for a in self.added) else d.lower() for d in data]
        ends = np.cumsum([len(d) + 1 for d in data])
        data = b"\n".join(data) + b"\n"
        place, entry, at = [], [], 0
        while at < len(data):  # pieces of about PIECE bytes, cut at white space
            cut = [c for c in (data.find(x, at + PIECE) for x in (b"\n", b" ")) if c >= 0]
            to = min(cut, default=len(data) - 1) + 1
            starts, found = self._entries(data[at:to - 1] + b"\n")
            place.append(starts + at)
            entry.append(found)
            at = to
        place, entry = np.concatenate(place), np.concatenate(entry)
        size = self.first[entry + 1] - self.first[entry]
        total = np.append(0, np.cumsum(size))
        upto = total[np.searchsorted(place, ends)]
        ids = self.ids[np.repeat(self.first[entry] - total[:-1], size) + np.arange(total[-1])]
        return ids, np.diff(upto, prepend=0)


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    """The encoder, built once per Python worker."""
    k = hash(vocabulary)
    if k not in _encoders:
        _encoders[k] = Encoder(vocabulary)
    return _encoders[k]


# -- files ----------------------------------------------------------------------

def _place(path: str):
    """(file system, path there) of a folder or file that Spark names."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_tokens(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 1,
                 folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending
    order of document, and return the manifest: ``path``, ``start`` (ids in all
    files before it), ``n_ids``, ``n_docs``. ``folder``: where all executors can
    write (default: a new one in the shared work folder)."""
    folder = folder or new_work_path(docs.sparkSession, "token-files")
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # Rows of one id are dealt apart by their text, and equal rows by a row number.
    spread = [F.col("d").asc_nulls_first(), "t_hash", "row"]
    ranges = rows.withColumn("t_hash", F.xxhash64("t")).withColumn("row", F.monotonically_increasing_id()) \
        .repartitionByRange(*spread).sortWithinPartitions(*spread).select("d", "t")

    def run(batches):
        part, encoder = TaskContext.get().partitionId(), encoder_of(vocabulary)
        system, where = _place(folder)
        system.create_dir(where, recursive=True)
        names: list = []
        sizes: list = []
        data: list = []
        held, done = 0, []

        def close():
            nonlocal names, sizes, data, held
            if names:
                ids = np.concatenate(names)
                name = f"{part:06d}-{len(done):06d}-{uuid.uuid4().hex}.s8b"
                with system.open_output_stream(f"{where}/{name}") as f:
                    f.write(to_bytes(ids, np.concatenate(sizes), np.concatenate(data)))
                done.append((part, len(done), f"{folder}/{name}", held, len(ids)))
            names, sizes, data, held = [], [], [], 0

        for b in batches:
            texts = b.column(1)
            for cut in arrow_slices(texts):
                ids, size = encoder.encode(texts[cut].to_pylist())
                own = b.column(0)[cut].fill_null(NO_ID).to_numpy()
                ids = np.insert(ids, np.cumsum(size), end_id)  # the end of each document
                size = size + 1
                upto, at = np.cumsum(size), 0
                while at < len(own):
                    before = int(upto[at - 1]) if at else 0
                    to = min(int(np.searchsorted(upto, before + file_ids - held)) + 1, len(own))
                    names.append(own[at:to])
                    sizes.append(size[at:to])
                    data.append(ids[before:upto[to - 1]].copy())
                    held, at = held + int(upto[to - 1]) - before, to
                    if held >= file_ids:
                        close()
            del b, texts
            give_back()
        close()
        cols = list(zip(*done)) if done else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()),
                                          pa.array(cols[4], pa.int64())], ["part", "seq", "path", "n_ids", "n_docs"])

    files = keep(ranges.mapInArrow(run, "part long, seq long, path string, n_ids long, n_docs long"), "manifest")
    # One row per range, then one per file.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    parts = parts.select("part", before.alias("part_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return files.join(parts, "part").select("path", (F.col("part_start") + inside).alias("start"), "n_ids", "n_docs")


def read_tokens(manifest: DataFrame, *, doc_id: str = "doc_id", batch_ids: int = 1_000_000) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids of all documents
    before it) and ``ids`` as little-endian unsigned 32-bit bytes."""
    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                system, where = _place(path)
                with system.open_input_stream(where) as f:
                    file = TokenFile(f.read())
                bounds = np.append(file.begin, file.n).astype(np.int64)
                at = 0
                while at < len(file.doc_ids):
                    to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + batch_ids, "right")) - 1)
                    ids = file.ids(int(bounds[at]), int(bounds[to])).astype("<u4")
                    own = bounds[at:to + 1] - bounds[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids[at:to], pa.int64(), mask=file.doc_ids[at:to] == NO_ID),
                         pa.array(start + bounds[at:to], pa.int64()),
                         pa.array([ids[x:y].tobytes() for x, y in zip(own, own[1:])], pa.binary())],
                        ["d", "start", "ids"])
                    at = to
                del file
            give_back()

    # A task reads few files: a number that is given is not lowered for the few bytes of the manifest's rows.
    files = manifest.select("path", "start")
    files = files.repartition(min(max(files.count(), 1), READERS))
    return files.mapInArrow(run, "d long, start long, ids binary").withColumnRenamed("d", doc_id)
