"""Vector bin packing of instruction data: sequences under limits on tokens, segments and loss-bearing tokens.

An example demands three things of a sequence: its tokens, its attention segments, and its
loss-bearing tokens (those after the prompt). Sequences are filled one after the other by the dot-product
heuristic: of the waiting examples that fit, the one whose demand vector has the largest weighted
dot product with the sequence's remaining capacities comes next. When none fits, the gap is closed
with the first part of the longest example, and the rest of that waits on, so nearly all
sequences are full.

Each partition is packed where it is read: there is no shuffle, no table between and no row on the
driver. A task holds at most ``POOL_TOKENS`` waiting tokens (and the Arrow batch it reads).
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orchard.llm.packing import _tokenizer

POOL_TOKENS = 1 << 22  # waiting tokens from which a task starts to fill sequences
POOL_ROWS = 1 << 17  # the same for waiting examples
LOSS_CLASSES = 8  # classes of the share of loss-bearing tokens


@dataclass(frozen=True)
class Limits:
    """What one sequence can take."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


class Piece:
    """Tokens [start, start + length) of one example; from ``loss_from`` on its tokens bear loss."""

    __slots__ = ("key", "ids", "start", "length", "segments", "loss_from")

    def __init__(self, key, ids: bytes, start: int, length: int, segments: int, loss_from: int):
        self.key, self.ids, self.start, self.length = key, ids, start, length
        self.segments, self.loss_from = segments, loss_from

    @property
    def loss(self) -> int:
        return self.start + self.length - min(max(self.loss_from, self.start), self.start + self.length)

    def prefix(self, tokens: int, loss: int) -> int:
        """Tokens of the longest first part with at most ``tokens`` tokens and ``loss`` loss-bearing ones."""
        return min(self.length, tokens, max(0, self.loss_from - self.start) + loss)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.key, self.ids, self.start, n, self.segments, self.loss_from),
                Piece(self.key, self.ids, self.start + n, self.length - n, self.segments, self.loss_from))


class Pool:
    """Waiting pieces in cells of alike direction, each with the set of its lengths as bits.

    A cell is a bound on the segments (exact up to 8, then one below a power of two) and a class of the
    share of loss-bearing tokens. The longest piece of a cell that surely fits has about the
    cell's largest dot product, so a choice looks at one piece per cell.
    """

    def __init__(self, limits: Limits):
        self.limits = limits
        self.lengths: dict[tuple[int, int], int] = defaultdict(int)  # (segments, class) -> bits
        self.held: dict[tuple[int, int, int], list[Piece]] = defaultdict(list)  # (cell, length) -> pieces
        self.rows = self.tokens = self.segments = self.loss = 0

    def cell(self, piece: Piece) -> tuple[int, int]:
        n = piece.segments if piece.segments <= 8 else min(self.limits.segments, (1 << piece.segments.bit_length()) - 1)
        return n, -(-LOSS_CLASSES * piece.loss // piece.length)

    def add(self, piece: Piece) -> None:
        cell = self.cell(piece)
        self.lengths[cell] |= 1 << piece.length
        self.held[(*cell, piece.length)].append(piece)
        self._count(piece, 1)

    def _count(self, piece: Piece, sign: int) -> None:
        self.rows += sign
        self.tokens += sign * piece.length
        self.segments += sign * piece.segments
        self.loss += sign * piece.loss

    def take(self, cell: tuple[int, int], length: int) -> Piece:
        pieces = self.held[(*cell, length)]
        piece = pieces.pop()
        if not pieces:
            del self.held[(*cell, length)]
            self.lengths[cell] ^= 1 << length
            if not self.lengths[cell]:
                del self.lengths[cell]
        self._count(piece, -1)
        return piece

    def weights(self) -> tuple[float, float, float]:
        """Demand for each capacity, for the dot product: the scarcest weighs most."""
        return (self.tokens / self.limits.tokens ** 2, self.segments / self.limits.segments ** 2,
                self.loss / self.limits.loss ** 2)

    def best(self, tokens: int, segments: int, loss: int, weights: tuple) -> Piece | None:
        """Removes and returns the fitting piece of the largest dot product with what remains."""
        a, b, c = weights[0] * tokens, weights[1] * segments, weights[2] * loss
        top = None
        for cell, bits in self.lengths.items():
            if cell[0] > segments:
                continue
            fits = min(tokens, loss * LOSS_CLASSES // cell[1]) if cell[1] else tokens
            length = (bits & ((2 << fits) - 1)).bit_length() - 1
            if length > 0:
                piece = self.held[(*cell, length)][-1]
                score = a * length + b * piece.segments + c * piece.loss
                if top is None or score > top[0]:
                    top = score, cell, length
        return self.take(*top[1:]) if top else None

    def part(self, tokens: int, segments: int, loss: int) -> Piece | None:
        """Removes and returns the longest first part that fits, of the longest piece; the rest stays."""
        top = None
        for cell, bits in self.lengths.items():
            length = bits.bit_length() - 1
            piece = self.held[(*cell, length)][-1]
            n = piece.prefix(tokens, loss) if piece.segments <= segments else 0
            if n and (top is None or (n, length) > top[:2]):
                top = n, length, cell
        if top is None:
            return None
        piece = self.take(top[2], top[1])
        if top[0] == piece.length:
            return piece
        first, rest = piece.cut(top[0])
        self.add(rest)
        return first


def fill(pool: Pool, cut: bool = True) -> list[Piece]:
    """The pieces of one sequence, taken from a ``pool`` that is not empty.

    With ``cut``, a sequence that cannot be filled ends at the largest power of two that it reaches: such a length
    needs no padding. What is beyond goes back to the pool.
    """
    limits = pool.limits
    tokens, segments, loss = limits.tokens, limits.segments, limits.loss
    weights = pool.weights()
    out = []
    while tokens and segments:
        piece = pool.best(tokens, segments, loss, weights)
        if piece is None and (cut or not out):  # a piece alone fits whole
            piece = pool.part(tokens, segments, loss)
        if piece is None:
            break
        out.append(piece)
        tokens, segments, loss = tokens - piece.length, segments - piece.segments, loss - piece.loss
    if not cut or not tokens:
        return out
    over = limits.tokens - tokens
    over -= 1 << (over.bit_length() - 1)
    while over:
        piece = out.pop()
        if piece.length > over:
            piece, rest = piece.cut(piece.length - over)
            out.append(piece)
            over = 0
        else:
            rest = piece
            over -= rest.length
        pool.add(rest)
    return out


def pack(examples: DataFrame, tokenizer_path: str, limits: Limits = Limits(), end_id: int = 2, cut: bool = True,
         id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
         segments_col: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, segments, loss (and ids).

    An example's tokens are those of its prompt, of its whole text and ``end_id``; all after the prompt bear
    loss (without ``prompt_col``: all). It brings one segment, or those of ``segments_col`` (null and less than
    one: one; more than the limit: the limit); a part of an example counts all of them. Null prompts and texts are empty, so every row has
    a piece; rows are examples of their own also where ids or whole rows repeat or the id is null; an
    empty table gives no rows; other columns play no part.

    ``cut``: parts close the gaps. Without it an example is cut only where it exceeds the limits itself, and
    sequences keep their gaps. ``sequence_id`` numbers a partition's sequences; write the result
    before it is used twice, because the rows of a partition may come in another order when a
    shuffle below runs again.
    """
    kind = examples.schema[id_col].dataType
    columns = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
               (F.col(f"`{prompt_col}`") if prompt_col else F.lit(None).cast("string")).alias("prompt"),
               (F.col(f"`{segments_col}`").cast("int") if segments_col else F.lit(1)).alias("segments")]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segments", "loss"]
    types = [to_arrow_type(kind)] + [pa.int64()] * 6 + [pa.int32(), pa.int64()]
    schema = "{}, {}".format(f"doc_id {kind.simpleString()}", ", ".join(f"`{n}` long" for n in names[1:7]))
    schema += ", segments int, loss long" + ", ids array<int>" * with_ids
    if with_ids:
        names, types = [*names, "ids"], [*types, pa.list_(pa.int32())]

    def place(batches):
        ids_of, end = _tokenizer(tokenizer_path), np.array([end_id], "<u4").tobytes()
        pool, number = Pool(limits), TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def emit(sequence: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for p in sequence:
                ids = p.ids[4 * p.start:4 * (p.start + p.length)]
                row = (p.key, p.start, p.length, zlib.crc32(ids), len(p.ids) // 4, number, offset, p.segments, p.loss)
                rows.append((*row, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else row)
                offset += p.length
            number += 1

        def done():
            arrays = [pa.array(values, t) for values, t in zip(zip(*rows), types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        def wait(key, text, prompt, segments) -> None:
            first = ids_of(prompt) if prompt else b""
            ids = first + ids_of(text or "") + end
            segments = min(max(segments or 1, 1), limits.segments)
            piece = Piece(key, ids, 0, len(ids) // 4, segments, len(first) // 4)
            while (n := piece.prefix(limits.tokens, limits.loss)) < piece.length:
                part, piece = piece.cut(n)
                if n == limits.tokens:
                    emit([part])
                else:
                    pool.add(part)
            pool.add(piece)

        for batch in batches:
            for key, text, prompt, segments in zip(*batch.columns):
                wait(key.as_py(), text.as_py(), prompt.as_py(), segments.as_py())
                if pool.tokens > POOL_TOKENS or pool.rows > POOL_ROWS:
                    while pool.tokens > POOL_TOKENS // 2 or pool.rows > POOL_ROWS // 2:
                        emit(fill(pool, cut))
                    yield done()
        while pool.rows:
            emit(fill(pool, cut))
            if len(rows) > 10_000:
                yield done()
        if rows:
            yield done()

    return examples.select(*columns).mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the sequences of pieces that ``pack`` made with ids, lengths by segment."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"),
                        F.transform("parts.ids", lambda x: F.size(x)).alias("lengths"))
