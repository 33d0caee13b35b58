"""Connected components of an edge list.

Each task first replaces its edges by a forest that connects the same nodes.
Edges of at most ``GATHERED`` (counted) are labelled by one task; more by
alternating star steps over the whole cluster. Both give the same labels.

Defined results: edges of a node with itself, and edges with a null end, connect
nothing; repeated edges count once; without edges there are no rows; nodes that
only such edges name have none either. Columns other than the two ends are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import keep


GATHERED = 1 << 20  # edges that one task may label (16 MB)


def smallest_of_component(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component) of edges ``a``, ``b``."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = np.split(at, 2)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _forest(batches):
    """A star of each component of a task's edges."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for pdf in batches:
        a, b = smallest_of_component(np.append(a, pdf["a"].to_numpy(np.int64)), np.append(b, pdf["b"].to_numpy(np.int64)))
    rest = a != b
    yield pd.DataFrame({"a": a[rest], "b": b[rest]})


def _labels(batches):
    """All nodes of a task's edges with their labels."""
    for pdf in _forest(batches):
        tops = np.unique(pdf["b"])
        yield pd.DataFrame({"node": np.append(pdf["a"], tops), "label": np.append(pdf["b"], tops)})


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: every node hands the smallest of its neighbours and
    itself to its larger neighbours (``larger``), or to its smaller ones and
    itself."""
    if larger:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, written: bool = False) -> DataFrame:
    """``(node, label)`` of every node of the undirected edges ``(a, b)``;
    the label is the smallest node of its component. ``written``: the edges
    are a stored table already (they are used as they are; this also keeps a
    task that makes edges in Python from needing a second worker).

    Large-star and small-star steps alternate until nothing changes; each step
    is an aggregate and a join of the edge list, written to the shared folder,
    and the number of steps grows with the logarithm of the longest path.
    """
    now = edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    if not written:
        now = keep(now.mapInPandas(_forest, "a long, b long"), "edges")
    if now.count() <= GATHERED:
        return keep(now.coalesce(1).mapInPandas(_labels, "node long, label long"), "components")
    mark = None
    while True:
        got = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(got) == mark or not got[0]:
            break
        mark = tuple(got)
        now = keep(_stars(_stars(now, True), False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
