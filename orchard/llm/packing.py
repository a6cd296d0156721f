"""Best-fit decreasing packing of tokenized documents into sequences of fixed length.

Documents are cut into pieces of at most ``capacity`` tokens. Pieces are dealt evenly into
groups of about ``GROUP`` pieces; in a group the pieces are placed from the longest on, each
into the open sequence that it fills most tightly. A segment tree over the remaining
capacities finds that sequence in logarithmic time. Each group leaves at most a handful of
unfilled sequences, however many groups there are.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import Scratch

GROUP = 1 << 18  # pieces that one task packs
CACHE = 200_000  # words, and as many parts of words, in each of the two generations whose ids a Python worker holds

# Lower-case letters and digits below U+0250, as the tokenizer's classes \p{L} and \p{N} have them
_LETTERS, _DIGITS = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾"
_PARTS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+").findall
# characters below U+0250 whose lower case is there too (not that of U+0130, U+0181, U+023A, ..)
_PLAIN = re.compile("[!-~{}]*".format("".join(
    c for c in map(chr, [*range(0xA1, 0xAD), *range(0xAE, 0x250)]) if max(c.lower()) < "\u0250"))).fullmatch
_ODD_SPACE = re.compile("[\x1c-\x1f]").search  # white space to Python only


def _generations(make, limit: int) -> dict:
    """A cache of at most ``limit`` values of ``make`` and those of the generation before.

    When it is full it becomes the older generation. What is asked for again comes back from there, so frequent
    keys outlive any number of rare ones.
    """
    older: dict = {}

    class Cache(dict):
        def __missing__(self, key):
            nonlocal older
            value = older.get(key)
            if value is None:
                value = make(key)
            if len(self) >= limit:
                older = dict(self)
                self.clear()
            self[key] = value
            return value

    return Cache()


class WordTokenizer:
    """Ids of texts by a tokenizer that drops white space and never joins across it.

    Such a tokenizer (``word_bpe_49k``) gives each run between white space the same ids
    wherever it stands, so the ids of a run are asked for once and kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {b: chr(b) for b in printable}
        byte |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in byte)}
        encode = self._encode

        def of_part(part: str) -> bytes:
            name = part if part.isascii() else "".join(map(byte.get, part.encode()))
            return b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(name)])

        parts = _generations(of_part, CACHE)

        def of_run(run: str) -> bytes:
            if _PLAIN(run) and "<|" not in run:
                return b"".join([parts[p] for p in _PARTS(run.lower())])
            return encode(run)

        self.runs = _generations(of_run, CACHE)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if _ODD_SPACE(text):
            return self._encode(text)
        return b"".join(map(self.runs.__getitem__, text.split()))


_TOKENIZERS: dict[str, WordTokenizer] = {}  # of this Python worker


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every row of ``docs``.

    A row's tokens are those of its whole text (null: empty), then ``end_id``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    size = 4 * capacity

    def cut(batches):
        ids_of = _tokenizer(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                all_ids = ids_of(text.as_py() or "") + end
                for p, s in enumerate(range(0, len(all_ids), size)):
                    part = all_ids[s:s + size]
                    row.append(k), piece.append(p), start.append(s // 4)
                    length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                   pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(out + [pa.array(ids, pa.list_(pa.int32()))] * with_ids,
                                             ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


class OpenBins:
    """Segment tree over remaining capacities: the tightest open bin that takes a length."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)  # open bins below each node
        self.bins = [[] for _ in range(capacity + 1)]

    def add(self, left: int, bin_: int) -> None:
        self.bins[left].append(bin_)
        k = left + self.leaves
        while k:
            self.open[k] += 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (remaining capacity, bin) of the tightest bin with room for ``need``."""
        count, k = self.open, need + self.leaves
        while not count[k]:  # the least leaf from ``need`` on that has a bin
            while k & 1:
                k >>= 1
            if not k:
                return None
            k += 1
        while k < self.leaves:
            k *= 2
            if not count[k]:
                k += 1
        left = k - self.leaves
        while k:
            count[k] -= 1
            k >>= 1
        return left, self.bins[left].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; bins are numbered from 0. Ties keep the given order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, n = OpenBins(capacity), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        at = tree.take(need)
        if at is None:
            at, n = (capacity, n), n + 1
        left, b = at
        bins[k], offsets[k] = b, capacity - left
        if left > need:
            tree.add(left - need, b)
    return bins, offsets


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """The rows of ``cut`` (any columns, with length from 1 to ``capacity``) with sequence_id and offset.

    ``cut`` is counted and dealt out, so it should be a written table. The dealing is by row, so
    many equal rows spread; it is the same when a task runs again. An empty table gives no rows.
    """
    groups = max(1, -(-cut.count() // GROUP))
    names = [c for c in cut.columns if c not in ("sequence_id", "offset")]
    schema = cut.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        held = list(batches)  # of about GROUP narrow rows
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        bins, offsets = best_fit_decreasing(table.column("length").to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))
        yield from table.to_batches(max_chunksize=10_000)

    return cut.select(*names).repartition(groups).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``.

    Every row is a document of its own, also where ids or whole rows repeat or the id is null;
    null and empty texts are the end id alone. Other columns play no part.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.write(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, at most ``capacity`` ids each."""
    scratch = Scratch(docs.sparkSession, "sequences")
    cut = scratch.write(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids=True), "pieces")
    parts = pack(cut, capacity).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))


def default_tokenizer() -> str:
    """Place of the public tokenizer file ``word_bpe_49k.json`` on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
