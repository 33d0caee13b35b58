"""Approximate nearest neighbours by low-dimensional stable projections.

Vectors are projected on ``M`` random Gaussian directions (a 2-stable
projection: the projected squared distance over the true one follows a
chi-square law with ``M`` degrees of freedom). The projected points are indexed
by kd-trees; a query takes its projected neighbours in growing distance,
verifies them on the original vectors in double precision and stops once the
chi-square test holds: the next projected distance ``r`` is so large against
the distance ``d`` of its k-th best so far that a nearer vector would project
that far with probability below ``1 - CONFIDENCE``.

Distribution. The top of the kd-tree is built from a sample of at most
``SAMPLE`` projected vectors (a documented bound) and cuts space into cells of
about ``CELL`` vectors; every vector is indexed, in the cell it falls into, and
a cell that holds more is dealt over several blocks, each with a kd-tree of its
own. A query first searches its own cell; then it visits those cells whose
projected box the test has not ruled out yet. A block is a task's bounded
group; queries go to blocks, blocks never to queries.

Defined results: vectors that are null, zero, empty, or hold null or non-finite
components take no part, nor does a row without an id; vectors of different
sizes have no distance and are searched apart; ties in distance go to the
smaller id; fewer candidates than ``k`` are all returned; repeated rows are
candidates once per id and vector. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsense.llm.tables import keep

K, M, CONFIDENCE = 10, 8, 0.995
SAMPLE, CELL, BLOCK, MAX_CELLS = 20_000, 8192, 16_384, 4096
LEAF = 32


def chi_square_quantile(p: float, m: int = M) -> float:
    """The ``p`` quantile of the chi-square law of an even ``m`` degrees."""
    def below(x):
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def directions(dim: int, m: int = M) -> np.ndarray:
    """The (dim, m) projection of vectors of a size; the same everywhere."""
    return np.random.default_rng([dim, m, 97]).standard_normal((dim, m))


def project(vectors: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors have equal projections."""
    a = directions(vectors.shape[1])
    return np.stack([(vectors * a[:, j]).sum(1) for j in range(a.shape[1])], 1)


class Tree:
    """A kd-tree: median cuts on the widest side down to ``leaf`` points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.cuts: list[tuple] = []  # (side, at, left, right) or the number of a leaf
        order, leaves = np.arange(len(points)), []
        todo = [(order, None, 0)]
        while todo:
            own, parent, side = todo.pop()
            here = len(self.cuts)
            if parent is not None:
                self.cuts[parent][side] = here
            spread = points[own].max(0) - points[own].min(0) if len(own) else np.zeros(1)
            axis = int(spread.argmax())
            if len(own) <= leaf or spread[axis] == 0:
                self.cuts.append(len(leaves))
                leaves.append(own)
                continue
            values = points[own, axis]
            at = np.partition(values, len(own) // 2)[len(own) // 2]
            left = values < at
            if not left.any():
                left = values <= at
                at = np.nextafter(at, np.inf)
            self.cuts.append([axis, float(at), None, None])
            todo.append((own[left], here, 2))
            todo.append((own[~left], here, 3))
        self.leaves = leaves
        boxes = [(points[x].min(0), points[x].max(0)) for x in leaves if len(x)]
        self.low = np.array([b[0] for b in boxes])
        self.high = np.array([b[1] for b in boxes])

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.empty(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, own = todo.pop()
            cut = self.cuts[at]
            if isinstance(cut, int):
                out[own] = cut
                continue
            left = points[own, cut[0]] < cut[1]
            todo += [(cut[2], own[left]), (cut[3], own[~left])]
        return out


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared projected distance of a point to boxes."""
    gap = np.maximum(np.maximum(low - q, q - high), 0)
    return (gap * gap).sum(-1)


def search(tree: Tree, points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int,
           bound: float, k: int, limit: float):
    """The ``k`` best of a tree's vectors for a query that already has ``k``
    within ``bound``: (distances, ids), ascending."""
    q = project(query[None])[0]
    near = box_distance(q, tree.low, tree.high)
    order = np.argsort(near, kind="stable")
    best_d, best_i = np.empty(0), np.empty(0, np.int64)
    at, step = 0, 4
    while at < len(order):
        worst = min(bound, best_d[k - 1]) if len(best_d) >= k else bound
        # No nearer vector is to be expected from here on. (A hair of slack,
        # so that rounding never stops a search among equal vectors.)
        if near[order[at]] > limit * worst * worst * (1 + 1e-9) + 1e-12:
            break
        rows = np.concatenate([tree.leaves[j] for j in order[at:at + step]])
        at, step = at + step, min(2 * step, 64)
        gap = points[rows] - q
        rows = rows[((gap * gap).sum(1) <= limit * worst * worst * (1 + 1e-9) + 1e-12) & (ids[rows] != own)]
        diff = vectors[rows] - query
        best_d = np.concatenate([best_d, np.sqrt((diff * diff).sum(1))])
        best_i = np.concatenate([best_i, ids[rows]])
        top = np.lexsort((best_i, best_d))[:k]
        best_d, best_i = best_d[top], best_i[top]
    return best_d, best_i


def _usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0)


def nearest(table: DataFrame, is_query: Column, *, key: str = "vec_id", vec: str = "embedding", k: int = K,
            confidence: float = CONFIDENCE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (the distance): the
    ``k`` nearest found of each row where ``is_query`` holds."""
    limit = chi_square_quantile(confidence)
    rows = table.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), is_query.alias("asks"), F.col(vec).cast("array<double>").alias("v"))
    rows = rows.where(_usable(F.col("v"))).withColumn("dim", F.size("v")).dropDuplicates(["id", "v"])

    # The top of the tree, by size of vectors.
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().orderBy(F.desc("count")).limit(64).collect()}
    if not counts:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score")).limit(0)
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).select("dim", "v").toPandas()
    tops: dict[int, Tree] = {}
    for dim, some in sample.groupby("dim"):
        points = project(np.array(some["v"].tolist(), float))
        cells = min(MAX_CELLS, max(1, counts.get(dim, 0) // CELL))
        tops[int(dim)] = Tree(points, max(1, -(-len(points) // cells)))

    def place(batches):
        for b in batches:
            out = []
            for dim, part in b.groupby("dim"):
                points = project(np.array(part["v"].tolist(), float))
                top = tops.get(int(dim))
                part = part.copy()
                part["cell"] = top.leaf_of(points) if top else 0
                part["p"] = list(points)
                out.append(part)
            if out:
                yield pd.concat(out)

    shape = "id long, asks boolean, v array<double>, dim int, cell long"
    placed = keep(rows.mapInPandas(place, shape + ", p array<double>"), "placed")
    # Boxes of cells: at most MAX_CELLS rows for each of at most 64 sizes, and
    # one row for any further size.
    ends = [f(F.col("p")[j]).alias(f"{n}{j}") for n, f in (("lo", F.min), ("hi", F.max)) for j in range(M)]
    boxes = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), *ends) \
        .withColumn("parts", F.ceil(F.col("n") / BLOCK))
    boxes = keep(boxes, "boxes")
    known = boxes.toPandas()
    low = known[[f"lo{j}" for j in range(M)]].to_numpy()
    high = known[[f"hi{j}" for j in range(M)]].to_numpy()
    by_dim = {int(d): np.flatnonzero(known["dim"] == d) for d in known["dim"].unique()}
    cell_of, parts_of = known["cell"].to_numpy(np.int64), known["parts"].to_numpy(np.int64)

    points = placed.join(F.broadcast(boxes.select("dim", "cell", "parts")), ["dim", "cell"]).select(
        F.col("dim").alias("pdim"), F.col("cell").alias("pcell"), F.pmod(F.xxhash64("id"), "parts").alias("ppart"),
        F.col("id").alias("pid"), F.col("v").alias("pv"))
    queries = placed.where("asks").select("dim", "cell", "id", "v")
    found_shape = "query_id long, dim int, vec_id long, score double"

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Queries (left) in a block of vectors (right)."""
        out = []
        if len(left) and len(right):
            vectors = np.array(right["pv"].tolist(), float)
            pts, ids = project(vectors), right["pid"].to_numpy(np.int64)
            tree = Tree(pts)
            for q in left.itertuples():
                d, i = search(tree, pts, vectors, ids, np.asarray(q.v, float), q.id, q.bound, k, limit)
                out.append(pd.DataFrame({"query_id": q.id, "dim": q.dim, "vec_id": i, "score": d}))
        return pd.concat(out) if out else pd.DataFrame(
            {"query_id": [], "dim": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "dim": "int32", "vec_id": "int64"})

    def ask(visits: DataFrame) -> DataFrame:
        blocks = points.groupBy("pdim", "pcell", "ppart")
        return visits.groupBy("dim", "cell", "part").cogroup(blocks).applyInPandas(look, found_shape)

    # Own cells first.
    home = queries.join(F.broadcast(boxes.select("dim", "cell", "parts")), ["dim", "cell"]) \
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))) \
        .select("dim", "cell", "part", "id", "v", F.lit(float("inf")).alias("bound"))
    order = Window.partitionBy("query_id", "dim").orderBy("score", "vec_id")
    first = keep(ask(home).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "home")
    bound = first.groupBy("query_id", "dim").agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("bound"))

    # Then the cells that the test leaves open.
    def visits(batches):
        for b in batches:
            out = []
            for q in b.itertuples():
                mine = by_dim[int(q.dim)]
                vector = np.asarray(q.v, float)
                near = box_distance(project(vector[None])[0], low[mine], high[mine])
                reach = limit * q.bound * q.bound * (1 + 1e-9) + 1e-12
                for j in mine[(near <= reach) & (cell_of[mine] != q.cell)]:
                    for part in range(parts_of[j]):
                        out.append((q.dim, cell_of[j], part, q.id, q.v, q.bound))
            yield pd.DataFrame(out, columns=["dim", "cell", "part", "id", "v", "bound"])

    asked = queries.join(bound.withColumnRenamed("query_id", "id"), ["id", "dim"], "left") \
        .select("dim", "cell", "id", "v", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    more = ask(asked.mapInPandas(visits, "dim int, cell long, part long, id long, v array<double>, bound double"))
    both = first.drop("rank").unionByName(more)
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
