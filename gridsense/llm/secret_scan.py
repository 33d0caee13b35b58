"""Secret scans: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by log-likelihood ratio.

Only DataFrame functions work here, training included; there is no Python on
the way of a row.

Fixed patterns give the *base* spans (``assign``, ``access``, ``hex``). The
models give ``random`` spans: runs of ``MIN_RUN`` token characters or more whose
log-likelihood ratio (random against ordinary, summed over character pairs)
passes ``MIN_RATIO`` nats per pair. Both models are first-order Markov chains
over ``ALPHABET``, counted from labelled samples with one added count per pair:
the values that the fixed patterns find are the random strings, all other words
of the same documents are the ordinary ones. The sample is ``TRAIN_DOCS``
documents at most (those of the smallest hash of their id; a documented bound).
The models are two tables of ``len(ALPHABET) ** 2`` numbers.

Positions are code points, end exclusive. They come from the lengths of the
pieces between matches, summed in blocks, so a text with many matches costs
about as much as its length.

Defined results: a null text counts as empty and has no spans; without any
sample the models are equal and add nothing. Repeated rows are scanned once per
row. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, and the least length of the group that counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # all runs of 20 or more, as shorter ones fail whole
HEX = r"[0-9a-f]{24,}"
BASE = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24)}
KINDS = (*BASE, "random")
# Characters of tokens.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN, MIN_RATIO = 20, 0.5
RUN = rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
WORD = r"[A-Za-z0-9+/_=-]{4,}"
TRAIN_DOCS = 5000
STEP = 64  # lengths summed per block
MASK = "[SECRET]"

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _sum(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, x: total + x)


def _pair_places(word: Column) -> Column:
    """Place in the model tables of each pair of neighbouring characters."""
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    n = F.size(chars) - 1

    def code(c: Column) -> Column:
        return F.position(c, F.lit(ALPHABET)) - 1

    return F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n),
                      lambda a, b: code(a) * len(ALPHABET) + code(b))


# -- models ---------------------------------------------------------------------------

def train(docs: DataFrame, *, text: str = "text", key: str = "doc_id", max_docs: int = TRAIN_DOCS) -> list[float]:
    """Log-likelihood ratio of every character pair, learned from ``docs``."""
    chosen = docs.select(F.col(key).alias("k")).where("k is not null").distinct() \
        .orderBy(F.xxhash64("k"), "k").limit(max_docs)
    t = F.coalesce(F.col(text), F.lit(""))
    sample = docs.select(F.col(key).alias("k"), t.alias("t")).join(F.broadcast(chosen), "k", "left_semi")
    for name, (pattern, group, least) in BASE.items():
        sample = sample.withColumn(name, F.filter(_all(F.col("t"), pattern, group), lambda x: F.length(x) >= least))
    rest = F.col("t")
    for pattern, _, _ in BASE.values():
        rest = F.regexp_replace(rest, pattern, " ")
    words = sample.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), F.concat(*BASE).alias("words")),
        F.struct(F.lit(0).alias("random"), _all(rest, WORD, 0).alias("words")))).alias("s")) \
        .select("s.random", F.explode("s.words").alias("word")).groupBy("random", "word").count()
    counts = words.select("random", "count", F.explode(_pair_places(F.col("word"))).alias("place")) \
        .where(F.col("place") >= 0).groupBy("random", "place").agg(F.sum("count").alias("n")).collect()
    n = len(ALPHABET)
    table = [[1.0] * (n * n), [1.0] * (n * n)]
    for r in counts:  # at most 2 * len(ALPHABET) ** 2 rows
        if r["place"] < n * n:
            table[r["random"]][r["place"]] += r["n"]
    for chain in table:
        for a in range(n):
            total = sum(chain[a * n:a * n + n])
            chain[a * n:a * n + n] = [math.log(x / total) for x in chain[a * n:a * n + n]]
    return [r - o for r, o in zip(table[1], table[0])]


# -- spans ----------------------------------------------------------------------------

def _matches(df: DataFrame, ratios: list[float], kinds=KINDS) -> DataFrame:
    """Adds, by kind, the matches in ``__text`` and which of them count."""
    t = F.col("__text")
    for kind in kinds:
        df = df.withColumn(f"__m_{kind}", _all(t, _pattern(kind), 0))
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def random(word: Column) -> Column:
        total = F.aggregate(_pair_places(word), F.lit(0.0), lambda s, p: s + F.get(table, p))
        return total >= MIN_RATIO * (F.length(word) - 1)

    for kind in kinds:
        m = F.col(f"__m_{kind}")
        if kind == "random":
            counts = F.transform(m, random)
        else:
            pattern, group, least = BASE[kind]
            counts = F.transform(m if group == 0 else _all(t, pattern, group), lambda x: F.length(x) >= least)
        df = df.withColumn(f"__ok_{kind}", F.when(F.size(m) > 0, counts).otherwise(F.array().cast("array<boolean>")))
    return df


def _pattern(kind: str) -> str:
    return BASE[kind][0] if kind in BASE else RUN


def _spans(kind: str) -> Column:
    """Spans of a kind: structs of start, kind's number, end."""
    m, ok, t = F.col(f"__m_{kind}"), F.col(f"__ok_{kind}"), F.col("__text")
    # Length of each match and of the piece before it.
    gaps = F.transform(F.split(t, _pattern(kind), -1), lambda x: F.length(x).cast("long"))
    sizes = F.transform(m, lambda x: F.length(x).cast("long"))
    both = F.zip_with(F.slice(gaps, 1, F.size(m)), sizes, lambda g, s: F.struct(g.alias("gap"), s.alias("size")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / STEP).cast("int")),
                         lambda b: F.slice(both, b * STEP + 1, F.lit(STEP)))
    ends = F.transform(blocks, lambda b: _sum(F.transform(b, lambda x: x["gap"] + x["size"])))

    def within(block: Column, number: Column) -> Column:
        before = _sum(F.slice(ends, F.lit(1), number))
        return F.transform(block, lambda x, i: F.struct(
            (before + _sum(F.transform(F.slice(block, F.lit(1), i), lambda y: y["gap"] + y["size"])) + x["gap"]).alias("start"),
            x["size"].alias("size")))

    placed = F.flatten(F.transform(blocks, within))
    kept = F.filter(F.zip_with(placed, ok, lambda p, k: F.struct(p.alias("p"), k.alias("ok"))), lambda x: x["ok"])
    return F.when(F.exists(ok, lambda x: x), F.transform(kept, lambda x: F.struct(
        x["p"]["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        (x["p"]["start"] + x["p"]["size"]).alias("end")))).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, ratios: list[float], *, text: str = "text", carry=("doc_id",)) -> DataFrame:
    """``carry`` columns and ``spans``: structs of start, kind (its place in
    ``KINDS``) and end, by start, then kind."""
    df = docs.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    df = _matches(df, ratios)
    for kind in KINDS:
        df = df.withColumn(f"__s_{kind}", _spans(kind))
    return df.select(*carry, F.array_sort(F.concat(*[f"__s_{k}" for k in KINDS])).alias("spans"))


def named(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ratios: list[float], *, text: str = "text", mask: str = MASK) -> DataFrame:
    """The rows of ``docs`` with every span of their text put as ``mask``, kind
    after kind. A null text stays null."""
    cols = docs.columns
    df = docs
    for kind in KINDS:
        df = df.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
        df = _matches(df, ratios, [kind])
        m, ok = F.col(f"__m_{kind}"), F.col(f"__ok_{kind}")
        put = F.concat(F.zip_with(m, ok, lambda x, k: F.when(k, F.lit(mask)).otherwise(x)), F.array(F.lit("")))
        whole = F.array_join(F.zip_with(F.split("__text", _pattern(kind), -1), put, lambda a, b: F.concat(a, b)), "")
        df = df.withColumn(text, F.when(F.exists(ok, lambda x: x), whole).otherwise(F.col(text))).select(*cols)
    return df
