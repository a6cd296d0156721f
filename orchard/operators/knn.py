"""Exact nearest neighbours by pivots: cells, triangle-inequality bounds, no distance matrix.

A bounded number of points serve as pivots; every point belongs to the cell of its nearest
one. A first pass searches each point's own cell and gives a bound on its k-th distance; a
second visits only the cells that the bounds leave open: the ball of a cell (distance to its pivot less its radius) and
the plane between two pivots. Inside a cell the points stand in the order of their distance to
the pivot, so tiles out of a point's reach are passed over. A cell with many points or
visitors is searched by several tasks, each with a bounded number of visitors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_PIVOTS = 1024
VISITORS = 4096  # points that one block looks up neighbours for
TILE = 1024  # points compared at once
ROWS = 128  # visitors compared at once
CHOOSERS = 256  # points that choose their cells at once
SLACK = 1e-9

_FOUND = "id long, nb long, d2 double"


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances from differences (equal points are at 0 exactly), some rows at a time."""
    out = np.empty((len(x), len(y)))
    for a in range(0, len(x), ROWS):
        out[a:a + ROWS] = ((x[a:a + ROWS, None, :] - y[None, :, :]) ** 2).sum(2)
    return out


class Cells:
    """Pivots with the size and radius of their cells; all bounded by ``MAX_PIVOTS``."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.apart = np.sqrt(_distances(pivots, pivots))
        self.count = np.zeros(len(pivots), np.int64)
        self.radius = np.zeros(len(pivots))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell, near = np.empty(len(x), np.int64), np.empty(len(x))
        for a in range(0, len(x), CHOOSERS):
            d = np.sqrt(_distances(x[a:a + CHOOSERS], self.pivots))
            cell[a:a + CHOOSERS] = d.argmin(1)
            near[a:a + CHOOSERS] = d.min(1)
        return cell, near

    def visits(self, x: np.ndarray, cell: np.ndarray, reach: np.ndarray, k: int) -> tuple[list, np.ndarray]:
        """Per row the (cell, distance to its pivot) pairs still to visit, and the bound on the k-th distance."""
        d = np.sqrt(_distances(x, self.pivots))
        far = np.where(self.count > 0, d + self.radius, np.inf)
        order = np.argsort(far, axis=1)
        enough = np.cumsum(self.count[order], axis=1) > k  # the point itself is one of them
        first = np.where(enough.any(1), enough.argmax(1), 0)
        at = np.arange(len(x))
        sure = np.where(enough.any(1), far[at, order[at, first]], np.inf)
        reach = np.minimum(reach, sure) * (1 + SLACK) + SLACK
        own = d[at, cell]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d ** 2 - own[:, None] ** 2) / (2 * self.apart[cell])
        low = np.maximum(d - self.radius, np.where(self.apart[cell] > 0, plane, 0))
        open_ = (low <= reach[:, None]) & (self.count > 0)
        open_[at, cell] = False
        return [list(zip(np.flatnonzero(o).tolist(), r[o].tolist())) for o, r in zip(open_, d)], reach

    def choose(self, pdf: pd.DataFrame, k: int):
        """Rows (id, x, cell, d, reach) of the open visits of (id, x, cell, reach) rows, for ``CHOOSERS`` of them at a time:
        an Arrow batch times all pivots would fill the worker."""
        for a in range(0, len(pdf), CHOOSERS):
            part = pdf.iloc[a:a + CHOOSERS]
            found, bound = self.visits(_stack(part["x"]), part["cell"].to_numpy(), part["reach"].fillna(np.inf).to_numpy(), k)
            row = np.repeat(np.arange(len(part)), [len(f) for f in found])
            flat = [c for f in found for c in f]
            yield pd.DataFrame({"id": part["id"].to_numpy()[row], "x": part["x"].to_numpy()[row], "cell": [c for c, _ in flat],
                                "d": [d for _, d in flat], "reach": bound[row]})


def _stack(column) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(np.float64, copy=False)


class _Block:
    """Visitors of one cell with their best neighbours so far."""

    def __init__(self, ids, x, d, reach, k):
        self.ids, self.x, self.d, self.k = np.array(ids, np.int64), np.vstack(x), np.array(d), k
        self.reach = np.array(reach) * (1 + SLACK) + SLACK
        self.d2, self.nb = np.full((len(ids), k), np.inf), np.zeros((len(ids), k), np.int64)

    def meet(self, ids: np.ndarray, x: np.ndarray, d: np.ndarray) -> None:
        near = np.flatnonzero((d[0] - self.d <= self.reach) & (self.d - d[-1] <= self.reach))
        for a in range(0, len(near), ROWS):
            rows = near[a:a + ROWS]
            d2 = _distances(self.x[rows], x)
            d2[self.ids[rows][:, None] == ids[None, :]] = np.inf  # itself
            if len(ids) > self.k:  # all up to the k-th, ties included
                kth = np.partition(d2, self.k - 1, axis=1)[:, self.k - 1]
                width = int((d2 <= kth[:, None]).sum(1).max())
                pick = np.argsort(d2, axis=1, kind="stable")[:, :width]
            else:
                pick = np.broadcast_to(np.arange(len(ids)), d2.shape)
            all_d2 = np.concatenate((self.d2[rows], np.take_along_axis(d2, pick, 1)), 1)
            all_nb = np.concatenate((self.nb[rows], ids[pick]), 1)
            best = np.lexsort((all_nb, all_d2), axis=1)[:, :self.k]
            self.d2[rows], self.nb[rows] = np.take_along_axis(all_d2, best, 1), np.take_along_axis(all_nb, best, 1)
            self.reach[rows] = np.minimum(self.reach[rows], np.sqrt(self.d2[rows, -1]) * (1 + SLACK) + SLACK)

    def result(self) -> pd.DataFrame:
        real = np.isfinite(self.d2)
        return pd.DataFrame({"id": np.repeat(self.ids, real.sum(1)), "nb": self.nb[real], "d2": self.d2[real]})


def _search(visitors: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(id, nb, d2): the k nearest points of the visited cell for each (visitor, cell).

    visitors: (id, x, cell, d, reach), points: (id, x, cell, d); d is the distance to the cell's pivot.
    """
    spark = visitors.sparkSession
    sizes = visitors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("blocks"))  # MAX_PIVOTS rows
    blocks = F.broadcast(sizes)
    own = visitors.join(blocks, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("sub"), F.lit(0).alias("kind"), "id", "x", "d", "reach")
    met = points.join(blocks, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("sub"), F.lit(1).alias("kind"), "id", "x", "d",
        F.lit(0.0).alias("reach"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = own.unionByName(met).repartition(parts, "cell", "sub").sortWithinPartitions("cell", "sub", "kind", "d", "id")

    def run(it):
        who, held, block, number = ([], [], [], []), ([], [], []), None, None

        def meet():
            block.meet(np.array(held[0], np.int64), np.vstack(held[1]), np.array(held[2]))
            for part in held:
                part.clear()

        def finish():
            if block is not None:
                if held[0]:
                    meet()
                yield block.result()

        for pdf in it:
            key = list(zip(pdf["cell"], pdf["sub"], pdf["kind"]))
            starts = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)] if key else []
            for a, b in zip(starts, starts[1:]):
                if key[a][:2] != number:
                    yield from finish()
                    block, number = None, key[a][:2]
                    for part in (*who, *held):
                        part.clear()
                part = pdf.iloc[a:b]
                if key[a][2] == 0:
                    for own_, c in zip(who, ("id", "x", "d", "reach")):
                        own_.extend(part[c])
                    continue
                if block is None and who[0]:
                    block = _Block(*who, k)
                for s in range(0, len(part), TILE):
                    for own_, c in zip(held, ("id", "x", "d")):
                        own_.extend(part[c].iloc[s:s + TILE])
                    if len(held[0]) >= TILE:
                        meet()
        yield from finish()

    return stream.mapInPandas(run, _FOUND)


def nearest_neighbours(points: DataFrame, k: int, id_col: str = "id", vector_col: str = "x",
                       pivots: int | None = None) -> DataFrame:
    """(id, nb, rank, d2): the k nearest other points of every point, by distance, ties by smaller id.

    ``points`` has unique long ids and arrays of one length without nulls. Fewer than k others: all of them.
    ``pivots``: cells, by default the root of the number of points, ``MAX_PIVOTS`` at most.
    """
    from orchard.session import cut_lineage

    rows = cut_lineage(points.select(F.col(id_col).cast("long").alias("id"),
                                     F.transform(vector_col, lambda v: v.cast("double")).alias("x")))
    n = rows.count()
    m = max(1, min(pivots or math.isqrt(n), MAX_PIVOTS))
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(m).select("x").collect()  # MAX_PIVOTS vectors at most
    window = Window.partitionBy("id").orderBy("d2", "nb")
    if not chosen:
        return rows.sparkSession.createDataFrame([], "id long, nb long, rank long, d2 double")
    cells = Cells(np.unique(np.array([r.x for r in chosen], np.float64), axis=0))

    def assign(it):
        for pdf in it:
            if len(pdf):
                pdf["cell"], pdf["d"] = cells.assign(_stack(pdf["x"]))
                yield pdf

    placed = cut_lineage(rows.mapInPandas(assign, "id long, x array<double>, cell int, d double"))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius")).collect():
        cells.count[r.cell], cells.radius[r.cell] = r.n, r.radius
    near = cut_lineage(_search(placed.withColumn("reach", F.lit(float("inf"))), placed, k))
    reach = near.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.max("d2"))).alias("reach"))

    def visit(it):
        for pdf in it:
            yield from cells.choose(pdf, k)

    more = cut_lineage(placed.select("id", "x", "cell").join(reach, "id", "left").mapInPandas(
        visit, "id long, x array<double>, cell int, d double, reach double"))
    both = near.unionByName(_search(more, placed, k))
    return both.withColumn("rank", F.row_number().over(window).cast("long")).where(F.col("rank") <= k).select(
        "id", "nb", "rank", "d2")
