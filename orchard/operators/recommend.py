"""Scoring and recommendation: factor scoring, per-user top-K, popularity fallback for
cold users, request routing and rejects, index decoding.

Top-K over a whole catalog never materialises the user x item table. Users are dealt into
blocks; every block meets the items in descending order of their norm, tile by tile, in one
sorted stream per task. A user leaves the race at the tile whose largest norm cannot reach the
user's k-th score any more (Cauchy-Schwarz), so most tiles are not scored. No item passes the
driver, a task holds one block of users and one tile, and the same path serves every catalogue size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orchard.functions.expressions import mf_logit, sigmoid

TOP_SCHEMA = "user_idx long, item_idx long, logit double, rank long"
USER, SEEN, ITEM = range(3)  # kinds of rows in a block's stream

BLOCK_USERS = 65536  # users that one task holds at most
BLOCK_BYTES = 2 << 20  # item factors of one tile
PLAIN_ROWS = 16384  # rows of a factor table (8 MB at 64 factors) up to which it is broadcast
BLOCK_ROWS = 65536  # rows of a factor table that one task holds
SLICE = 4096  # items scored at once
ROWS = 1024  # users scored at once


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top k of each row by (score desc, id asc); fewer columns than k stay as they are, sorted."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _block_top_k(P: np.ndarray, bu: np.ndarray, ids: np.ndarray, Q: np.ndarray, bi: np.ndarray, k: int, mu: float,
                 seen: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """(scores, item ids) of the k best items of one block for each user row; missing ones are -inf.

    ``ids`` ascend. ``seen``: user rows and item ids that never compete.
    """
    n = len(P)
    best, best_ids = np.full((n, 0), -np.inf), np.zeros((n, 0), np.int64)
    if seen is not None:
        rows, items = seen
        at = np.searchsorted(ids, items)
        hit = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == items)
        rows, at = rows[hit], at[hit]
    for a in range(0, len(ids), SLICE):
        part = ids[a:a + SLICE]
        S = P @ Q[a:a + SLICE].T + bu[:, None] + bi[None, a:a + SLICE] + mu
        if seen is not None:
            here = (at >= a) & (at < a + SLICE)
            S[rows[here], at[here] - a] = -np.inf
        if S.shape[1] > 4 * k:  # all that reach the k-th score, ties included, then in order
            kth = -np.partition(-S, k - 1, axis=1)[:, k - 1:k]
            keep = S >= kth
            width = int(keep.sum(axis=1).max())
            column = np.argsort(~keep, axis=1, kind="stable")[:, :width]
            S, part = np.where(np.take_along_axis(keep, column, axis=1), np.take_along_axis(S, column, axis=1), -np.inf), part[column]
        else:
            part = np.broadcast_to(part, S.shape)
        best, best_ids = _best(np.concatenate((best, S), axis=1), np.concatenate((best_ids, part), axis=1), k)
    return best, best_ids


def _matrix(series: pd.Series) -> np.ndarray:
    """Arrow list<double> column (object array of 1-d arrays) -> 2-d float64 matrix."""
    return np.vstack(series.to_numpy()).astype(np.float64, copy=False)


class _UserBlock:
    """The users of one block with their best items so far; tiles come in descending order of norm."""

    def __init__(self, ids: list, factors: list, bias: list, k: int, mu: float):
        self.ids, self.k, self.mu = np.array(ids, np.int64), k, mu
        self.P, self.bu = np.vstack(factors).astype(np.float64), np.array(bias, np.float64)
        self.norm = np.sqrt((self.P ** 2).sum(1) + 1)  # of (factors, 1): the item's bias is its last coordinate
        self.row_of = {u: n for n, u in enumerate(self.ids.tolist())}
        self.open = np.arange(len(ids))
        self.best = np.full((len(ids), 0), -np.inf)
        self.best_ids = np.zeros((len(ids), 0), np.int64)

    def meet(self, items: np.ndarray, Q: np.ndarray, bi: np.ndarray, norm: float, seen: tuple[np.ndarray, np.ndarray]) -> None:
        """Scores a tile whose items' norms are at most ``norm`` for the users that it can still serve."""
        if self.best.shape[1] >= self.k:
            reach = self.norm[self.open] * norm * (1 + 1e-9) + self.bu[self.open] + self.mu + 1e-9
            self.open = self.open[reach >= self.best[self.open, self.k - 1]]
        order = np.argsort(items, kind="stable")
        items, Q, bi = items[order], Q[order], bi[order]
        width = min(self.k, self.best.shape[1] + len(items))
        best, best_ids = np.full((len(self.ids), width), -np.inf), np.zeros((len(self.ids), width), np.int64)
        best[:, :self.best.shape[1]], best_ids[:, :self.best.shape[1]] = self.best, self.best_ids
        for a in range(0, len(self.open), ROWS):
            rows = self.open[a:a + ROWS]
            at = np.searchsorted(rows, seen[0])
            own = (at < len(rows)) & (rows[np.minimum(at, len(rows) - 1)] == seen[0])
            S, ids = _block_top_k(self.P[rows], self.bu[rows], items, Q, bi, self.k, self.mu,
                                  (at[own], seen[1][own]) if own.any() else None)
            S, ids = _best(np.concatenate((self.best[rows], S), 1), np.concatenate((self.best_ids[rows], ids), 1), self.k)
            best[rows, :S.shape[1]], best_ids[rows, :S.shape[1]] = S, ids
        self.best, self.best_ids = best, best_ids

    def result(self) -> pd.DataFrame:
        real = np.isfinite(self.best)
        row, rank = np.nonzero(real)
        return pd.DataFrame({"user_idx": self.ids[row], "item_idx": self.best_ids[real], "logit": self.best[real], "rank": rank + 1})


def _race(k: int, mu: float, tile: int):
    """Function over a stream of rows (block, norm, kind, id, item, factors, bias): the top k of each block's users.

    In a block the users come first, then the items in descending order of their norm, each right after
    the seen pairs that name it.
    """

    def run(it):
        users, seen, held, block, number = ([], [], []), ([], []), ([], [], [], []), None, None

        def score():
            ids, factors, bias, norms = held
            rows = np.array([block.row_of.get(u, -1) for u in seen[0]], np.int64)
            items = np.array(seen[1], np.int64)
            block.meet(np.array(ids, np.int64), np.vstack(factors).astype(np.float64), np.array(bias, np.float64),
                       norms[0], (rows[rows >= 0], items[rows >= 0]))
            for part in (*held, *seen):
                part.clear()

        def finish():
            nonlocal block
            if block is not None:
                if held[0]:
                    score()
                yield block.result()
            block = None
            for part in (*users, *seen, *held):
                part.clear()

        for pdf in it:
            kinds, blocks = pdf["kind"].to_numpy(), pdf["block"].to_numpy()
            turns = np.flatnonzero(np.diff(blocks * 2 + (kinds != USER))) + 1
            starts = [0, *turns.tolist(), len(pdf)] if len(pdf) else []
            for a, b in zip(starts, starts[1:]):
                if blocks[a] != number:
                    yield from finish()
                    number = blocks[a]
                if kinds[a] == USER:
                    for own, c in zip(users, ("id", "factors", "bias")):
                        own.extend(pdf[c].iloc[a:b])
                    continue
                if block is None and users[0]:
                    block = _UserBlock(*users, k, mu)
                at = np.flatnonzero(kinds[a:b] == ITEM) + a
                while a < b and block is not None and len(block.open):
                    room = tile - len(held[0])
                    end = int(at[room - 1]) + 1 if len(at) >= room else b
                    part, kind = pdf.iloc[a:end], kinds[a:end]
                    for own, c in zip(seen, ("id", "item")):
                        own.extend(part[c][kind == SEEN].astype(np.int64))
                    for own, c in zip(held, ("id", "factors", "bias", "norm")):
                        own.extend(part[c][kind == ITEM])
                    if len(held[0]) >= tile:
                        score()
                    a, at = end, at[room:]
        yield from finish()

    return run


def user_blocks(spark: SparkSession, n: int, block_users: int = BLOCK_USERS) -> int:
    """Blocks for ``n`` users: one per core, fewer where they would be tiny, more where they would exceed ``block_users``."""
    return max(-(-n // block_users), min(spark.sparkContext.defaultParallelism, n // 64), 1)


def top_k_scores(users: DataFrame, items: DataFrame, k: int, global_bias: float = 0.0,
                 block_bytes: int = BLOCK_BYTES, exclude_seen: DataFrame | None = None,
                 block_users: int = BLOCK_USERS) -> DataFrame:
    """Top-k items per user under the biased dot-product (MF) score.

    users: (user_idx, factors, bias), one row per user; items: (item_idx, factors, bias).
    Returns (user_idx, item_idx, logit, score, rank); ordering score desc, item asc.
    ``exclude_seen`` (user_idx, item_idx): those pairs are never recommended (default: the
    reference behaviour, seen items stay eligible).

    One shuffle: users once, the items once per block, the seen pairs to the place of their item in the
    stream. There is a block for each core that the job has, so the items' traffic grows with the items
    alone; more blocks only where one would hold over ``block_users`` users. Items are scored in tiles
    of about ``block_bytes``.
    """
    blocks = user_blocks(users.sparkSession, users.count(), block_users)
    block = F.pmod(F.xxhash64("user_idx"), F.lit(blocks)).cast("int")
    squares = F.aggregate("factors", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norm = F.sqrt(squares + F.col("bias") * F.col("bias"))
    bias, every = F.col("bias").cast("double").alias("bias"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    factors = F.transform("factors", lambda x: x.cast("double")).alias("factors")
    no = F.lit(None)
    stream = users.select(block.alias("block"), F.lit(float("inf")).alias("norm"), F.lit(USER).alias("kind"),
                          F.col("user_idx").alias("id"), no.cast("long").alias("item"), factors, bias)
    stream = stream.unionByName(items.select(every, norm.alias("norm"), F.lit(ITEM).alias("kind"),
                                             F.col("item_idx").alias("id"), F.col("item_idx").alias("item"), factors, bias))
    if exclude_seen is not None:
        # the hint keeps the pairs, whose number Spark does not know before they are made, from being broadcast
        pairs = exclude_seen.select("user_idx", "item_idx").join(
            items.select("item_idx", norm.alias("norm")).hint("shuffle_hash"), "item_idx")
        stream = stream.unionByName(pairs.select(
            block.alias("block"), "norm", F.lit(SEEN).alias("kind"), F.col("user_idx").alias("id"),
            F.col("item_idx").alias("item"), no.cast("array<double>").alias("factors"), no.cast("double").alias("bias")))
    dim = items.select(F.max(F.size("factors"))).first()[0] or 1
    tile = max(1, block_bytes // (8 * (dim + 2)))
    top = (stream.repartition(blocks, "block").sortWithinPartitions("block", F.col("kind") != USER, F.col("norm").desc(), "item", "kind")
           .mapInPandas(_race(k, float(global_bias), tile), TOP_SCHEMA))
    return top.select("user_idx", "item_idx", "logit", sigmoid("logit").alias("score"), "rank")


def top_k_per_user(scores: DataFrame, k: int, user_col: str = "user_idx", item_col: str = "item_idx",
                   score_col: str = "score") -> DataFrame:
    """Top-k rows per user of an explicit score table; ties -> smaller item id.

    ``row_number() <= k`` lets Spark insert a per-partition group limit before the shuffle.
    """
    w = Window.partitionBy(user_col).orderBy(F.col(score_col).desc(), F.col(item_col).asc())
    return scores.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def with_factors(pairs: DataFrame, users: DataFrame, items: DataFrame, how: str = "inner",
                 plain_rows: int = PLAIN_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``pairs`` joined with both factor tables on user_idx and item_idx, without a shuffle of rows that hold factors.

    Two joins one after the other would send every pair with its user's factors to its item. Here users and items
    are cut into blocks by hash, and a pair of blocks is a cell: the pairs go to their cell as they are, each user
    to the cells of its block and each item to those of its own, and both joins happen there. A task holds the
    factors of a few cells, at most about ``block_rows`` users and items each, and pairs stream past them.
    """
    n_users, n_items = max(users.count(), 1), max(items.count(), 1)
    if max(n_users, n_items) <= plain_rows:
        # said here: Spark would rather broadcast pairs that it takes for few, as it does not count what an explode makes
        return pairs.join(F.broadcast(users), "user_idx", how).join(F.broadcast(items), "item_idx", how)
    spark = pairs.sparkSession
    wanted = 4 * spark.sparkContext.defaultParallelism
    # blocks that copy the fewest rows: users times item blocks, items times user blocks
    i_blocks = max(-(-n_items // block_rows), min(wanted, round((wanted * n_items / n_users) ** 0.5)), 1)
    u_blocks = max(-(-n_users // block_rows), -(-wanted // i_blocks))
    tasks = max(u_blocks * i_blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # rows that share a cell share a task, whatever other columns a join names
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def dealt(table: DataFrame, every: int, cell) -> DataFrame:
        copies = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(every - 1)))) if every else table
        return copies.withColumn("_cell", cell).drop("_copy").repartition(tasks, "_cell")

    u_block = F.pmod(F.xxhash64(F.col("user_idx").cast("long")), F.lit(u_blocks)) * i_blocks
    i_block = F.pmod(F.xxhash64(F.col("item_idx").cast("long")), F.lit(i_blocks))
    u = dealt(users, i_blocks, u_block + F.col("_copy")).hint("shuffle_hash")
    i = dealt(items, u_blocks, F.col("_copy") * i_blocks + i_block).hint("shuffle_hash")
    return dealt(pairs, 0, u_block + i_block).join(u, ["_cell", "user_idx"], how).join(i, ["_cell", "item_idx"], how).drop("_cell")


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, global_bias: float = 0.0) -> DataFrame:
    """MF score of explicit (user_idx, item_idx) pairs: two equi joins + a JVM expression."""
    u = users.select("user_idx", F.col("factors").alias("_pu"), F.col("bias").alias("_bu"))
    i = items.select("item_idx", F.col("factors").alias("_qi"), F.col("bias").alias("_bi"))
    j = with_factors(pairs, u, i)
    logit = mf_logit("_pu", "_qi", "_bu", "_bi", global_bias)
    return j.withColumn("score", sigmoid(logit)).drop("_pu", "_qi", "_bu", "_bi")


def popularity_lookup(pairs: DataFrame, popularity: DataFrame, item_col: str = "item_id",
                      pop_item_col: str = "itemid", score_col: str = "popularity") -> DataFrame:
    """Popularity score per requested item; unknown items score 0.0."""
    p = popularity.select(F.col(pop_item_col).alias(item_col), F.col(score_col).alias("_pop"))
    return pairs.join(p, item_col, "left").withColumn("score", F.coalesce("_pop", F.lit(0.0))).drop("_pop")


def explode_requests(requests: DataFrame) -> DataFrame:
    """(user_id, item_ids, k) -> one (user_id, item_id) row per requested item."""
    return requests.select("user_id", F.explode("item_ids").alias("item_id"))


def unknown_item_rejects(requests: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Requested items of known users that have no factor row (reason column)."""
    pairs = explode_requests(requests)
    known = pairs.join(users.select(F.col("user_idx").alias("user_id")), "user_id", "left_semi")
    bad = known.join(items.select(F.col("item_idx").alias("item_id")), "item_id", "left_anti")
    return bad.select("user_id", "item_id", F.lit("unknown item").alias("reason"))


def cold_start_route(requests: DataFrame, users: DataFrame, items: DataFrame, popularity: DataFrame,
                     global_bias: float = 0.0) -> DataFrame:
    """Score requested items: known users with the factor model (unknown items go to the
    reject output, see ``unknown_item_rejects``), cold users by popularity (unknown -> 0).

    Returns (user_id, item_id, score, cold_start).
    """
    pairs = explode_requests(requests)
    known_users = users.select(F.col("user_idx").alias("user_id"))
    warm = pairs.join(known_users, "user_id", "left_semi")
    cold = pairs.join(known_users, "user_id", "left_anti")
    warm_scored = score_pairs(warm.select(F.col("user_id").alias("user_idx"), F.col("item_id").alias("item_idx")),
                              users, items, global_bias)
    warm_out = warm_scored.select(F.col("user_idx").alias("user_id"), F.col("item_idx").alias("item_id"), "score",
                                  F.lit(False).alias("cold_start"))
    cold_out = popularity_lookup(cold, popularity).select("user_id", "item_id", "score",
                                                          F.lit(True).alias("cold_start"))
    return warm_out.unionByName(cold_out)


def score_requests(requests: DataFrame, users: DataFrame, items: DataFrame, global_bias: float = 0.0) -> DataFrame:
    """Batch form of single-request scoring: every (user, item) of every request at once."""
    pairs = explode_requests(requests).select(F.col("user_id").alias("user_idx"), F.col("item_id").alias("item_idx"))
    return score_pairs(pairs, users, items, global_bias)


def popular_top_k_array(popularity: DataFrame, k: int, item_col: str = "itemid",
                        score_col: str = "popularity") -> DataFrame:
    """One row: the global top-k as an array of (item, score, rank) structs (k bounded)."""
    w = Window.orderBy(F.col(score_col).desc(), F.col(item_col).asc())
    top = (popularity.orderBy(F.col(score_col).desc(), F.col(item_col).asc()).limit(k)
           .withColumn("rank", F.row_number().over(w).cast("long")))
    return top.agg(F.sort_array(F.collect_list(F.struct("rank", F.col(item_col).alias("item"),
                                                        F.col(score_col).alias("score")))).alias("top"))


def invalid_k(requests: DataFrame, k_col: str = "k") -> DataFrame:
    """Requests whose k is given but not positive (reason column)."""
    return requests.where(F.col(k_col) < 1).withColumn("reason", F.lit("k must be a positive integer"))


def recommend(requests: DataFrame, users: DataFrame, items: DataFrame, popularity: DataFrame, k: int,
              global_bias: float = 0.0, **top_k_kwargs) -> DataFrame:
    """Top-k per requested user: factor model for known users, global popularity for cold ones.

    requests: (user_id) or (user_id, k): each request gets as many rows as its own k says,
    ``k`` where it is null or there is no such column. Requests with a k below 1 get none (see
    ``invalid_k``). A user with several requests gets the largest of them, once.
    Returns (user_id, item_id, score, rank, cold_start).
    """
    own = F.coalesce(F.col("k").cast("long"), F.lit(k)) if "k" in requests.columns else F.lit(k).cast("long")
    ids = requests.select("user_id", own.alias("k")).where("k >= 1").groupBy("user_id").agg(F.max("k").alias("k"))
    most = int(ids.agg(F.max("k")).first()[0] or 0)
    known = users.join(ids.select(F.col("user_id").alias("user_idx")), "user_idx", "left_semi")
    warm = top_k_scores(known, items, max(most, 1), global_bias, **top_k_kwargs).select(
        F.col("user_idx").alias("user_id"), F.col("item_idx").alias("item_id"), "score", "rank",
        F.lit(False).alias("cold_start"))
    cold_ids = ids.join(users.select(F.col("user_idx").alias("user_id")), "user_id", "left_anti")
    top = popular_top_k_array(popularity, max(most, 1)).scalar()  # one row of that many structs
    cold = cold_ids.select("user_id", F.explode(top).alias("t")).select(
        "user_id", F.col("t.item").alias("item_id"), F.col("t.score").alias("score"), F.col("t.rank").alias("rank"),
        F.lit(True).alias("cold_start"))
    return warm.unionByName(cold).join(ids, "user_id").where("rank <= k").drop("k")


def decode_index(df: DataFrame, index: DataFrame, idx_col: str, id_col: str) -> DataFrame:
    """Replace a dense index column by the external id (equi join with the index table)."""
    return df.join(index, idx_col).drop(idx_col)
