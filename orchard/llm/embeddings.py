"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated into the eigenvectors of their second moments, strongest first, so
that a few leading dimensions carry most of a product. Vectors of one label are laid out
along the leading dimensions in tiles. A pair of tiles is compared only when the boxes of
their leading coordinates are near enough for some cosine to reach the threshold. Inside a
pair products are accumulated over growing groups of dimensions; the part still missing is
at most the product of the two suffix norms (Cauchy-Schwarz), and a pair of vectors is
dropped as soon as that cannot reach the threshold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import Scratch, components, forest, shuffle_partitions

TILE = 512  # vectors of a tile
BOX = 4  # leading coordinates that a tile's box bounds
CHUNKS = (8, 16, 32, 64, 128, 256, 512)  # dimensions after which bounds are applied
MARGIN = 1e-9  # decisions nearer to the threshold are taken by the plain formula


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaling by the largest part first avoids overflow."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _groups(batch: pa.RecordBatch, column: str):
    """(row numbers, matrix) of each vector length of a batch."""
    lists = batch.column(column)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[(ends[at] - d)[:, None] + np.arange(d)]


def principal_axes(valid: DataFrame) -> dict[int, np.ndarray]:
    """Rotation per vector length, from the second moments of all unit vectors.

    Partial sums are added up by Spark; the driver gets one length x length matrix each.
    """

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, rows in _groups(batch, "embedding"):
                x = _unit(rows)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d * d, d)), pa.array(np.arange(d * d)), pa.array(m.ravel())], ["d", "cell", "value"])

    cells = (valid.select("embedding").mapInArrow(moments, "d long, cell long, value double")
             .groupBy("d", "cell").agg(F.sum("value").alias("value")).collect())
    out: dict[int, np.ndarray] = {}
    for d, cell, value in cells:
        out.setdefault(d, np.zeros(d * d))[cell] = value
    return {d: np.linalg.eigh(m.reshape(d, d))[1][:, ::-1].copy() for d, m in out.items()}


def _link_tiles(xa: np.ndarray, xb: np.ndarray, axes: np.ndarray, threshold: float, same: bool):
    """Index pairs (i, j) whose cosine reaches the threshold; i < j within one tile."""
    ua, ub = _unit(xa), _unit(xb)
    ya, yb = ua @ axes, ub @ axes
    d = axes.shape[0]
    steps = [c for c in CHUNKS if c < d] + [d]

    def suffix(y: np.ndarray) -> np.ndarray:
        tail = np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.concatenate((tail, np.zeros((len(y), 1))), axis=1))

    ra, rb = suffix(ya), suffix(yb)
    low = threshold - MARGIN
    product = ya[:, :steps[0]] @ yb[:, :steps[0]].T
    alive = product + np.outer(ra[:, steps[0]], rb[:, steps[0]]) >= low
    if same:
        alive &= np.tri(len(ya), dtype=bool).T & ~np.eye(len(ya), dtype=bool)
    done = 1
    while done < len(steps) and alive.sum() > alive.size // 8:  # many left: whole blocks of products
        a, b = steps[done - 1], steps[done]
        product += ya[:, a:b] @ yb[:, a:b].T
        alive &= product + np.outer(ra[:, b], rb[:, b]) >= low
        done += 1
    i, j = np.nonzero(alive)
    s = product[i, j]
    for a, b in zip(steps[done - 1:], steps[done:]):  # few left: pair by pair, in bounded parts
        parts = [np.einsum("ij,ij->i", ya[i[k:k + 65536], a:b], yb[j[k:k + 65536], a:b]) for k in range(0, len(i), 65536)]
        s = s + (np.concatenate(parts) if parts else 0.0)
        keep = s + ra[i, b] * rb[j, b] >= low
        i, j, s = i[keep], j[keep], s[keep]
    near = np.flatnonzero(np.abs(s - threshold) <= MARGIN)
    keep = s >= threshold
    for k in near.tolist():
        p, q = xa[i[k]].astype(np.float64), xb[j[k]].astype(np.float64)
        keep[k] = float(p @ q) / math.sqrt(float(p @ p)) / math.sqrt(float(q @ q)) >= threshold
    return i[keep], j[keep]


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vec_id: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, their lengths are equal, and their
    cosine in double precision is at least ``threshold``. Vectors that are null, empty,
    zero or hold a null or non-finite part link with nothing. Rows that share a vec_id are one
    vector, the one greatest by label, then parts; a null vec_id is an id like any other, and
    smaller than none. Equal vectors are compared once and counted as often as they occur. An
    empty table gives no rows; other columns play no part.

    Tiles are formed in sorted runs of a range partitioning, which splits frequent labels and
    equal leading coordinates. A pair of tiles returns one row per linked vector: how many
    it links with and one spanning-forest link, never its pairs. The comparisons of a label
    whose vectors all lie near each other grow with the square of its tiles.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    label_kind = vectors.schema[label_col].dataType.simpleString()
    one = (vectors.groupBy(F.col(id_col).cast("long").alias("vec_id"))
           .agg(F.max(F.struct(F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))).alias("v"))
           .select("vec_id", "v.label", "v.embedding"))
    inf = float("inf")
    sound = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
             & F.exists("embedding", lambda x: x != 0))
    rows = scratch.write(one.withColumn("sound", F.coalesce(sound, F.lit(False))), "rows")
    valid = scratch.write(rows.where("sound").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n")), "valid")
    axes = principal_axes(valid)
    reach = math.sqrt(2 - 2 * threshold) + 1e-6  # distance of unit vectors at the threshold

    def lead(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, BOX))
            for at, x in _groups(batch, "embedding"):
                y = _unit(x) @ axes[x.shape[1]][:, :BOX]
                out[at, :y.shape[1]] = y
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(out[:, k]) for k in range(BOX)]],
                [*batch.schema.names, *[f"y{k}" for k in range(BOX)]])

    coordinates = ", ".join(f"y{k} double" for k in range(BOX))
    body = f"label {label_kind}, embedding array<{kind}>, rep long, n long"
    placed = scratch.write(valid.select("label", "embedding", "rep", "n").mapInArrow(lead, f"{body}, {coordinates}"), "placed")
    cell = [F.floor(F.col(f"y{k}") / reach) for k in range(2)]
    order = [F.col("label"), F.size("embedding"), *cell, F.col("y2"), F.col("rep")]
    laid = placed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def cut(batches):
        partition, n, held, key = TaskContext.get().partitionId() << 32, 0, [], None

        def tile():
            nonlocal n
            labels, xs, reps, ns, ys = zip(*held)
            y = np.array(ys)
            row = {"tile": partition + n, "label": labels[0], "d": len(xs[0]), "reps": list(reps), "ns": list(ns),
                   "parts": np.concatenate(xs), "lo": y.min(axis=0), "hi": y.max(axis=0)}
            n += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            schema = pa.schema([("tile", pa.int64()), ("label", batch.schema.field("label").type), ("d", pa.int32()),
                                ("reps", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())),
                                ("parts", batch.schema.field("embedding").type),
                                ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))])
            ys = np.stack([batch.column(f"y{k}").to_numpy() for k in range(BOX)], axis=1)
            for k, (label, rep, m) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("label", "rep", "n")])):
                x = batch.column("embedding")[k].values.to_numpy(zero_copy_only=False)
                if held and (key != (label, len(x)) or len(held) == TILE):
                    yield tile()
                key = (label, len(x))
                held.append((label, x, rep, m, ys[k]))
        if held:
            yield tile()

    tiles = scratch.write(laid.mapInArrow(cut, f"tile long, label {label_kind}, d int, reps array<long>, ns array<long>, "
                                               f"parts array<{kind}>, lo array<double>, hi array<double>"), "tiles")

    def ends(side: str) -> DataFrame:
        cells = F.sequence(F.floor(F.col("lo")[0] / reach), F.floor(F.col("hi")[0] / reach) + 1)
        return tiles.select("label", "d", F.explode(cells).alias("cell"),
                            *[F.col(c).alias(f"{side}_{c}") for c in ("tile", "lo", "hi")])

    apart = sum(F.pow(F.greatest(F.col("b_lo")[k] - F.col("a_hi")[k], F.col("a_lo")[k] - F.col("b_hi")[k], F.lit(0.0)), F.lit(2))
                for k in range(BOX))
    pairs = (ends("a").join(ends("b"), ["label", "d", "cell"]).where("a_tile <= b_tile").where(apart <= reach * reach)
             .select("a_tile", "b_tile").distinct())

    def body_of(side: str) -> DataFrame:
        return tiles.select(F.col("tile").alias(f"{side}_tile"),
                            F.struct("d", "reps", "ns", "parts").alias(side))

    meet = pairs.join(body_of("a"), "a_tile").join(body_of("b"), "b_tile")
    meet = meet.select("a", F.when(F.col("a_tile") != F.col("b_tile"), F.col("b")).alias("b"))

    def link(batches):
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                d, reps, ns, xa = _tile(a)
                same = not b.is_valid
                _, reps_b, ns_b, xb = (d, reps, ns, xa) if same else _tile(b)
                i, j = _link_tiles(xa, xb, axes[d], threshold, same)
                if not len(i):
                    continue
                if same:
                    nodes, weights = reps, ns
                else:
                    nodes, weights, j = np.concatenate((reps, reps_b)), np.concatenate((ns, ns_b)), j + len(reps)
                links = np.bincount(i, weights[j], len(nodes)) + np.bincount(j, weights[i], len(nodes))
                root = nodes[forest(i, j, len(nodes))]
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[at]), pa.array(links[at].astype(np.int64)), pa.array(root[at])], ["rep", "links", "root"])

    found = scratch.write(meet.mapInArrow(link, "rep long, links long, root long"), "found")
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch).select(
        F.col("node").alias("rep"), "root")
    classes = (valid.join(totals, "rep", "left").join(roots, "rep", "left")
               .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("root", "rep").alias("component_id")))
    linked = rows.where("sound").join(classes, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _tile(row: pa.StructScalar):
    d = row["d"].as_py()
    reps, ns, parts = (row[c].values.to_numpy(zero_copy_only=False) for c in ("reps", "ns", "parts"))
    return d, reps, ns, parts.reshape(-1, d)


# DuckDB: every pair of one label
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS n, vec_id AS m FROM embeddings UNION SELECT reach.n, links.b FROM reach JOIN links ON links.a = reach.m)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, min(m) AS component_id,
  e.vec_id = min(m) AS kept FROM embeddings e JOIN reach ON n = e.vec_id GROUP BY e.vec_id
"""
