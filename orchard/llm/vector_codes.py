"""Vector code compression: product codes by exact integer k-means with norm-of-sum bounds.

Vectors are scaled to integers and cut into equal parts; each part position has a codebook that some rounds of
assignment and averaging refine. A row keeps, per part, an upper bound on the distance to its entry and a
lower bound on the distance to every other entry, each with the round in which it was measured. All
codebooks since the start are kept (a few kilobytes), so a bound is carried into the present round by the entry's
*net* displacement since its stamp, the norm of the sum of its moves, which is never more than the sum of
their norms. Only where the two bounds meet is the own entry measured, and only where they still
meet are all entries scanned, in exact integers.

A round is one pass: each task reads its rows, writes them with their bounds and adds one row of
integer sums per entry, from which the next codebook comes. Written tables survive lost executors; the
last one goes when the next is there.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from orchard.llm.common import Scratch

LARGEST = 10 ** 18  # integer components are clamped to this size, so that sums stay exact
_LONG = 2 ** 63 - 1
_TOTAL = "array<struct<part:int,entry:int,pos:int,n:bigint,total:decimal(38,0)>>"


@dataclass
class Codes:
    """The codes of the kept rows, the final codebooks (part, entry, component) and the scans of each round."""

    rows: DataFrame  # id column, label column, code array<tinyint>-like bytes, error
    codebooks: list[list[list[int]]]
    scans: list[int]  # (row, part) pairs for which all entries were measured, by round; the last is the final one

    def digest(self) -> str:
        """SHA-256 of all components in decimal by part, entry, position, comma-joined."""
        flat = ",".join(str(x) for part in self.codebooks for entry in part for x in entry)
        return hashlib.sha256(flat.encode()).hexdigest()


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as long, clamped to ±``LARGEST``."""
    top = F.lit(float(LARGEST))
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, -top), top)).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _exact(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as doubles where squared distances stay below 2^53, else as Python integers."""
    most = max(max(abs(int(a.min())), abs(int(a.max()))) for a in arrays)
    small = arrays[0].shape[-1] * (2 * most) ** 2 < 2 ** 53
    return tuple(a.astype(np.float64 if small else object) for a in arrays)


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n, w) to entries (k, w)."""
    x, entries = _exact(x, entries)
    return (x * x).sum(1)[:, None] - 2 * x.dot(entries.T) + (entries * entries).sum(1)


def _own(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n, w) to one entry each (n, w)."""
    x, entries = _exact(x, entries)
    return ((x - entries) ** 2).sum(1)


def _root(squares: np.ndarray, up: bool) -> np.ndarray:
    """Roots as single floats, rounded outward."""
    roots = np.sqrt(squares.astype(np.float64)).astype(np.float32)
    return np.nextafter(roots, np.float32(np.inf if up else 0))


class Round:
    """One assignment of rows to the newest of ``history``, the codebooks (part, entry, component) so far."""

    def __init__(self, history: list[np.ndarray]):
        self.now, self.books = len(history) - 1, history[-1]
        moves = [_own(self.books.reshape(-1, self.books.shape[2]), old.reshape(-1, self.books.shape[2])) for old in history]
        # (stamp, part, entry): net displacement since the stamp, rounded up
        self.net = np.stack([_root(m, True).reshape(self.books.shape[:2]) * (m.reshape(self.books.shape[:2]) > 0)
                             for m in moves]).astype(np.float64)
        order = np.sort(self.net, axis=2)
        self.farthest = self.net.argmax(2)
        self.most = order[:, :, -1]
        self.next_most = order[:, :, -2] if order.shape[2] > 1 else np.zeros_like(self.most)
        self.scans = 0

    def scan(self, x: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry, upper bound, lower bound) of rows by measuring all entries; ties to the lower index."""
        self.scans += len(x)
        d = _squared(x, self.books[part])
        code = np.argmin(d, axis=1) if d.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in d])
        at = np.arange(len(x))
        upper = _root(d[at, code], True)
        if d.shape[1] == 1:
            return code, upper, np.full(len(x), np.inf, np.float32)
        d = d.copy()
        d[at, code] = np.inf if d.dtype != object else float("inf")
        return code, upper, _root(d.min(1), False)

    def assign(self, x: np.ndarray, part: int, code, upper, lower, upper_at, lower_at) -> None:
        """Updates codes, bounds and their stamps of rows (n, w) in place."""
        others = np.where(self.farthest[lower_at, part] == code, self.next_most[lower_at, part], self.most[lower_at, part])
        low = lower - others * (1 + 1e-6)
        high = upper + self.net[upper_at, part, code] * (1 + 1e-6)
        open_ = np.flatnonzero(~(high * (1 + 1e-6) < low))
        if not len(open_):
            return
        own = _root(_own(x[open_], self.books[part][code[open_]]), True)
        upper[open_], upper_at[open_] = own, self.now
        open_ = open_[~(own.astype(np.float64) * (1 + 1e-6) < low[open_])]
        if len(open_):
            code[open_], upper[open_], lower[open_] = self.scan(x[open_], part)
            upper_at[open_] = lower_at[open_] = self.now


def _lists(column: pa.Array, n: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1)


def _as_lists(array: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, w = array.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * w + 1, w), pa.int32()), pa.array(array.reshape(-1), kind))


_STATE = [("code", "array<smallint>", pa.int16()), ("upper", "array<float>", pa.float32()),
          ("lower", "array<float>", pa.float32()), ("upper_at", "array<smallint>", pa.int16()),
          ("lower_at", "array<smallint>", pa.int16())]


def _pass(table: DataFrame, history: list[np.ndarray], last: bool) -> DataFrame:
    """``table`` (id, label, v and, after the first round, state) with the state of one more round.

    The rows of a task are followed by one row with its sums (``totals``) and count of scans. The ``last`` pass has
    id, label, code as bytes and error in place of vector and bounds.
    """
    parts, entries, width = history[-1].shape
    first = "code" not in table.columns
    keep = ["id", "label"] + ["v"] * (not last)
    schema = T.StructType([table.schema[c] for c in keep])
    for name, kind, _ in _STATE * (not last):
        schema.add(name, T.DataType.fromDDL(kind))
    if last:
        schema.add("code", "binary").add("error", "long")
    schema.add("totals", T.DataType.fromDDL(_TOTAL)).add("scans", "long")
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def step(batches):
        rnd, sums, counts = Round(history), np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = _lists(batch.column("v"), n, np.int64).reshape(n, parts, width)
            if first:
                state = [np.zeros((n, parts), k) for k in (np.int16, np.float32, np.float32, np.int16, np.int16)]
            else:
                state = [_lists(batch.column(c), n, k.to_pandas_dtype()).copy() for c, _, k in _STATE]
            code, upper, lower, upper_at, lower_at = state
            error = np.zeros(n, object)
            for p in range(parts):
                x = np.ascontiguousarray(v[:, p])
                if first:
                    code[:, p], upper[:, p], lower[:, p] = rnd.scan(x, p)
                else:
                    own = [np.ascontiguousarray(s[:, p]) for s in state]
                    rnd.assign(x, p, *own)
                    for s, o in zip(state, own):
                        s[:, p] = o
                if last:
                    error += np.array([int(e) for e in _own(x, rnd.books[p][code[:, p]])], object)
                    continue
                counts[p] += np.bincount(code[:, p], minlength=entries)
                for k in np.unique(code[:, p]).tolist():
                    rows = x[code[:, p] == k]
                    safe = max(abs(int(rows.min())), abs(int(rows.max()))) * len(rows) < 2 ** 62
                    sums[p, k] += rows.sum(0) if safe else rows.astype(object).sum(0)
            columns = [batch.column(c) for c in keep]
            if last:
                columns += [pa.array([bytes(c) for c in code.astype(np.uint8)], pa.binary()),
                            pa.array([min(e, _LONG) for e in error], pa.int64())]
            else:
                columns += [_as_lists(s, k) for s, (_, _, k) in zip(state, _STATE)]
            columns += [pa.nulls(n, arrow.field("totals").type), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        from decimal import Decimal

        totals = [dict(part=p, entry=k, pos=j, n=int(counts[p, k]), total=Decimal(int(sums[p, k, j])))
                  for p, k in zip(*np.nonzero(counts)) for j in range(width)]
        tail = [pa.nulls(1, f.type) for f in arrow][:-2]
        tail += [pa.array([totals], arrow.field("totals").type), pa.array([rnd.scans], pa.int64())]
        yield pa.RecordBatch.from_arrays(tail, schema=arrow)

    return table.mapInArrow(step, schema)


def _next_books(written: DataFrame, books: np.ndarray) -> tuple[np.ndarray, int]:
    """The codebooks after a round (floor of the mean; unused entries stay) and the round's scans."""
    marks = written.where("totals IS NOT NULL")
    sums = (marks.select(F.explode("totals").alias("t")).groupBy("t.part", "t.entry", "t.pos")
            .agg(F.sum("t.n").alias("n"), F.sum("t.total").alias("total")).collect())  # one row per component
    out = books.copy()
    for r in sums:
        out[r.part, r.entry, r.pos] = int(r.total) // r.n
    return out, marks.agg(F.sum("scans")).first()[0] or 0


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes:
    """Product codes of all usable rows: ``rows`` has the id and label columns, ``code`` (bytes) and ``error`` (long).

    Dropped: null vectors, vectors with null or non-finite components, empty ones, those whose length is no multiple of
    ``parts``, and those of another length than the row that comes first by id. The first ``entries`` rows by id
    (null ids last, equal ids by their integers) are the first codebook; with fewer rows it is
    smaller. Rows with repeated or null ids count as rows of their own. Components beyond ±10^18
    after scaling are clamped; an error beyond the largest long is that long. Other columns play no part.
    An empty table gives no rows and an empty codebook.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries from 1 to 256")
    scratch = Scratch(vectors.sparkSession, "codes")
    vector = F.col(f"`{vector_col}`")
    table = scratch.write(
        vectors.where(usable(vector) & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
        .select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), scaled(vector, scale).alias("v")),
        "vectors")
    by_id = [F.col("id").asc_nulls_last(), F.col("v")]
    start = table.select("id", "v").orderBy(*by_id).first()
    names = F.col("id").alias(id_col), F.col("label").alias(label_col)
    if start is None:
        return Codes(table.select(*names, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), [], [])
    size = len(start.v)
    seeds = table.where(F.size("v") == size).select("id", "v").orderBy(*by_id).limit(entries).collect()
    books = np.array([r.v for r in seeds], np.int64).reshape(len(seeds), parts, size // parts).transpose(1, 0, 2)
    history, scans, read = [np.ascontiguousarray(books)], [], "vectors"
    table = table.where(F.size("v") == size)
    for t in range(rounds):
        written = scratch.write(_pass(table, history, False), f"round-{t}")
        scratch.drop(read)
        read = f"round-{t}"
        books, n = _next_books(written, history[-1])
        history.append(books)
        scans.append(n)
        table = written.where("totals IS NULL").drop("totals", "scans")
    written = scratch.write(_pass(table, history, True), "codes")
    scratch.drop(read)
    scans.append(written.agg(F.sum("scans")).first()[0] or 0)
    rows = written.where("totals IS NULL").select(*names, "code", "error")
    return Codes(rows, history[-1].tolist(), scans)


def label_errors(codes: Codes, label_col: str = "label") -> DataFrame:
    """``codes.rows`` with ``label_error``: the errors summed over equal labels, nulls together (at most the largest long).

    The sums meet per label before the join, whose skewed side Spark splits.
    """
    label = F.col(f"`{label_col}`")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    sums = codes.rows.groupBy(label.alias("__label")).agg(total.alias("label_error"))
    return codes.rows.join(sums, label.eqNullSafe(F.col("__label"))).drop("__label")


def decoded(code: Column, codebooks: list[list[list[int]]], scale: int = 4096) -> Column:
    """array<double>: the vector that a code stands for."""
    books = np.array(codebooks, np.float64) / scale

    @F.arrow_udf("array<double>")
    def look_up(codes: pa.Array) -> pa.Array:
        found = [None if c.as_py() is None else books[range(len(books)), list(c.as_py())].reshape(-1) for c in codes]
        return pa.array(found, pa.list_(pa.float64()))

    return look_up(code)


def oracle(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """DuckDB: every round as one plain assignment of all parts to all entries."""
    sql = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS place, len(embedding) // {parts} AS w,
         [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (
  SELECT place, part, pos, q[part * w + pos + 1] AS x
  FROM (SELECT place, q, w, unnest(range(0, {parts})) AS part, range(0, w) AS r FROM v), unnest(r) AS u(pos)),
c0 AS MATERIALIZED (SELECT part, place - 1 AS entry, pos, x FROM p WHERE place <= {entries})"""
    for t in range(rounds + 1):
        sql += f""",
d{t} AS MATERIALIZED (SELECT place, part, entry, sum((p.x - c.x) * (p.x - c.x)) AS d
  FROM p JOIN c{t} c USING (part, pos) GROUP BY place, part, entry),
a{t} AS MATERIALIZED (SELECT place, part, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d FROM d{t} GROUP BY place, part)"""
        if t < rounds:
            sql += f""",
m{t} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM p JOIN a{t} USING (place, part) GROUP BY part, entry, pos),
c{t + 1} AS MATERIALIZED (SELECT part, entry, pos,
  CASE WHEN n IS NULL THEN x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x
  FROM c{t} LEFT JOIN m{t} USING (part, entry, pos))"""
    return sql + f""",
o AS (SELECT place, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY place)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM v JOIN o USING (place)
"""
