"""Chat formatting by token-level assembly.

Each turn becomes ``TURN role SEP text END``: role and text are encoded apart
(byte-level BPE, never joined with what stands around them) and spliced between
reserved ids beyond the vocabulary, so no content can form a control token.
The strings of control tokens that occur in content are escaped with a
backslash before encoding, reversibly, so the rendered text is unambiguous too.

The loss mask covers the text of the trained role's turns. Turns of a
conversation are put in order, and prefix sums of their sizes give each turn's
place and its masked range in the conversation's token sequence.

Encoding happens before the shuffle, row by row. Assembly and reading back
stream over partitions sorted by conversation and turn with constant memory:
one row per turn leaves, never a list of a whole conversation, so a
conversation of any number of turns needs no large group. (The digests of a
conversation are sequential by nature: one task reads its turns in order.)

Defined results: null texts and roles count as empty; rows without a
conversation id form one conversation of null id; rows without a turn come
first; rows of equal turn are ordered by role and text as encoded, repeated
rows are repeated turns. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.bpe import Coder, coder_of
from gridsense.llm.tables import map_rows

# The rendered forms of the reserved ids, in id order.
CONTROL = ("<turn>### ", ": ", "</turn>\n")
TURN, SEP, END = range(3)  # reserved ids, counted from the vocabulary's size
TRAINED = "assistant"

_ESCAPED = re.compile(r"\\|###|</?turn>")
_MARKED = re.compile(r"\\(\\|###|</?turn>)")


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: m.group(1), text)


def format_turns(rows: DataFrame, vocabulary: str, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", trained: str = TRAINED) -> DataFrame:
    """One row per turn, in order within its partition: ``conv``, ``seq`` (from
    0), ``ids`` (control tokens included), ``start`` (place of the first id in
    the conversation), ``loss_start`` and ``loss_end`` (masked range there)."""
    def encode():
        coder = coder_of(vocabulary, False)

        def run(texts, roles):
            return ([np.array(x, np.int32) for x in coder.encode_many([escape(r or "") for r in roles])],
                    [np.array(x, np.int32) for x in coder.encode_many([escape(t or "") for t in texts])],
                    [(r or "") == trained for r in roles])
        return run

    source = rows.select(F.col(conv).alias("__conv"), F.col(turn).alias("__turn"), F.col(role).alias("__role"),
                         F.col(text).alias("__text"))
    encoded = map_rows(source, [F.col("__text"), F.col("__role")], ["__conv", "__turn"], encode,
                       {"role_ids": "array<int>", "text_ids": "array<int>", "loss": "boolean"})
    ordered = encoded.repartition("__conv").sortWithinPartitions("__conv", F.col("__turn").asc_nulls_first(),
                                                                 "role_ids", "text_ids")

    def assemble(batches):
        base = coder_of(vocabulary, False).size
        now, seq, start, begun = None, 0, 0, False
        for b in batches:
            ids, seqs, starts, los, his = [], [], [], [], []
            for c, r, t, loss in zip(*(b.column(k).to_pylist() for k in ("__conv", "role_ids", "text_ids", "loss"))):
                if not begun or c != now:
                    now, seq, start, begun = c, 0, 0, True
                ids.append([base + TURN, *r, base + SEP, *t, base + END])
                lo = start + len(r) + 2
                seqs.append(seq)
                starts.append(start)
                los.append(lo)
                his.append(lo + len(t) if loss else lo)
                seq, start = seq + 1, start + len(ids[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("__conv"), pa.array(seqs, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(starts, pa.int64()), pa.array(los, pa.int64()), pa.array(his, pa.int64())],
                ["conv", "seq", "ids", "start", "loss_start", "loss_end"])

    kind = rows.schema[conv].dataType.simpleString()
    return ordered.mapInArrow(assemble, f"conv {kind}, seq long, ids array<int>, start long, loss_start long, "
                                        "loss_end long").withColumnRenamed("conv", conv)


def turn_parts(ids: list[int], coder: Coder) -> tuple[str, str, int]:
    """(role, text, place of the text's first id) of a turn's ids, as rendered,
    escapes included."""
    sep = ids.index(coder.size + SEP)
    return coder.decode(ids[1:sep]), coder.decode(ids[sep + 1:-1]), sep + 1


def render(ids: list[int], coder: Coder) -> str:
    """The turn as text, control tokens and escapes included."""
    role, text, _ = turn_parts(ids, coder)
    return CONTROL[TURN] + role + CONTROL[SEP] + text + CONTROL[END]


def read_back(turns: DataFrame, vocabulary: str, conv: str = "conv_id") -> DataFrame:
    """Per conversation, from the rows of :func:`format_turns` as they stand:
    number of turns, digest of roles and texts, characters and digest of all
    text under the loss mask, characters of the rendered text."""
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        coder = coder_of(vocabulary, False)
        now, begun, done = None, False, []

        def fresh():
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        state = fresh()

        def close():
            n, whole, chars, loss, size = state
            done.append((now, n, whole.hexdigest(), chars, loss.hexdigest(), size))

        def out():
            cols = list(zip(*done)) if done else [[]] * 6
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], key_type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int64())], names)

        key_type = None
        for b in batches:
            key_type = b.column(0).type
            for c, ids, start, lo, hi in zip(*(b.column(k).to_pylist()
                                               for k in (conv, "ids", "start", "loss_start", "loss_end"))):
                if begun and c != now:
                    close()
                    state = fresh()
                now, begun = c, True
                role, text, first = turn_parts(ids, coder)
                state[4] += sum(map(len, CONTROL)) + len(role) + len(text)
                role, text = unescape(role), unescape(text)
                lo, hi = lo - start, hi - start
                whole = lo == first and hi == len(ids) - 1  # the mask is the text
                masked = text if whole else unescape(coder.decode(ids[lo:hi]))
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(masked)
                state[3].update(masked.encode())
            yield out()
        if begun:
            close()
            yield out()

    kind = turns.schema[conv].dataType.simpleString()
    return turns.select(conv, "ids", "start", "loss_start", "loss_end").mapInArrow(
        run, f"`{conv}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
