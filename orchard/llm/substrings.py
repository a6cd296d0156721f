"""Removal of repeated byte strings with a collection Burrows-Wheeler transform.

A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a
smaller document, or earlier in the same one. Equal strings have to be brought together first:

1. Every string of ``length`` bytes has an anchor, the ``gram``-byte substring with the
   smallest hash (the leftmost of equals). Neighbouring strings with one anchor form a stretch.
   Equal strings have equal anchors, so only stretches with equal anchors are compared.
2. Of equal stretches all but the first go whole. Anchors with one stretch need no more.
3. The first of each of the other stretches, where it agrees with another on enough bytes
   beside the anchor, are indexed in batches that hold all stretches of their anchors, by column-wise construction: in each round one more symbol of every
   stretch, from its end on, is inserted, which updates the batch's Burrows-Wheeler transform
   and its array of common prefixes (``column_index``). Suffixes that follow each other with
   a common prefix of ``length`` hold equal strings; all but the earliest go.

The rounds read sorted shuffle files batch after batch; a batch's transform is bounded by
``BATCH`` stretches and so stays in memory. An anchor with over ``HOT`` different stretches
(a common line with many surroundings) is not indexed in one task: its strings are dealt
out by content and the earliest of each kept by partial minimums.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import Scratch, shuffle_partitions

LENGTH = 100
GRAM = 24
BUFFER = 1 << 22  # bytes of text that are anchored at once
BATCH = 4000  # stretches that one transform holds, about
HOT = 8192  # different stretches of one anchor from which they are dealt out by content

_U = np.uint64


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of all substrings of ``gram`` bytes, by doubling."""
    power, h, width = _U(0x9E3779B97F4A7C15), data.astype(np.uint64) + _U(1), 1
    out, done, shift = None, 0, _U(1)
    left = gram
    with np.errstate(over="ignore"):
        while left:
            if left & 1:  # the substring is a run of pieces of 1, 2, 4, .. bytes
                n = len(data) - done - width + 1
                out = h[:n].copy() if out is None else out[:n] * power + h[done:done + n]
                done += width
            left >>= 1
            if left:
                h = h[:-width] * power + h[width:]
                power, width = power * power, width * 2
        out = out[: max(0, len(data) - gram + 1)]
        out ^= out >> _U(32)
        out *= _U(0xD6E8FEB86659FD93)
        out ^= out >> _U(32)
    return out


def stretches(data: bytes, lengths: np.ndarray, length: int, gram: int):
    """(starts, counts, anchor hashes) of the stretches of documents that lie one after another in ``data``.

    A stretch of count c holds the strings that start at its first c bytes.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, np.zeros(0, np.uint64)
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    low_bits = _U((1 << int(len(h)).bit_length()) - 1)
    least, span, window = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64), 1, length - gram + 1
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    anchor = (least & low_bits).astype(np.int64)
    ends = np.cumsum(lengths)
    inside = np.zeros(len(data) + 1, np.int64)
    whole = lengths >= length
    np.add.at(inside, (ends - lengths)[whole], 1)
    np.add.at(inside, ends[whole] - length + 1, -1)
    inside = np.cumsum(inside)[: len(anchor)] > 0
    changed = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | ~inside[:-1])) & inside
    closing = np.concatenate((changed[1:] | ~inside[1:], [True])) & inside
    starts = np.flatnonzero(changed)
    return starts, np.flatnonzero(closing) + 1 - starts, h[anchor[starts]]


def _buffers(batches, length: int):
    """Documents of Arrow batches, joined to about ``BUFFER`` bytes: (keys, orders, places, lengths, data).

    A document over ``BUFFER`` bytes comes in parts that overlap by ``length`` - 1 bytes.
    """
    held, size = [], 0
    for batch in batches:
        for key, order, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2).cast(pa.binary())):
            data = text.as_py() or b""
            for at in range(0, max(1, len(data) - length + 1), BUFFER):
                part = data[at:at + BUFFER + length - 1]
                held.append((key, order, at, len(part), part))
                size += len(part)
                if size >= BUFFER:
                    yield zip(*held)
                    held, size = [], 0
    if held:
        yield zip(*held)


def _find(length: int, gram: int):
    """Stretches (anchor, content, key, ord, start, n); of equal ones in a buffer all but the first have n < 0."""

    def find(batches):
        for keys, orders, places, lengths, parts in _buffers(batches, length):
            data, lengths = b"".join(parts), np.array(lengths)
            keys, orders, places = np.array(keys, np.int64), np.array(orders, np.int64), np.array(places, np.int64)
            starts, counts, anchors = stretches(data, lengths, length, gram)
            if not len(starts):
                continue
            view, digest = memoryview(data), xxhash.xxh3_64_intdigest
            content = np.fromiter((digest(view[s:e]) for s, e in zip(
                starts.tolist(), (starts + counts + length - 1).tolist())), np.uint64, len(starts))
            ends = np.cumsum(lengths)
            doc = np.searchsorted(ends, starts, "right")
            key, order, start = keys[doc], orders[doc], starts - (ends - lengths)[doc] + places[doc]
            by = np.lexsort((start, order, key, content, anchors))
            again = np.zeros(len(by), bool)
            again[by[1:]] = (anchors[by[1:]] == anchors[by[:-1]]) & (content[by[1:]] == content[by[:-1]])
            # repeats that follow each other are one row, dealt by its place
            run = again & np.concatenate(([False], again[:-1] & (key[1:] == key[:-1]) & (order[1:] == order[:-1])
                                          & (start[1:] == start[:-1] + counts[:-1])))
            first = np.flatnonzero(~run)
            n = np.add.reduceat(counts, first)
            again, key, order, start = again[first], key[first], order[first], start[first]
            with np.errstate(over="ignore"):
                anchor = np.where(again, (key * 1_000_003 + start).astype(np.uint64) * _U(0x9E3779B97F4A7C15), anchors[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(content[first].view(np.int64)), pa.array(key),
                 pa.array(order.astype(np.int32)), pa.array(start), pa.array(np.where(again, -n, n))],
                ["anchor", "content", "key", "ord", "start", "n"])

    return find


def _compare(batches):
    """Sorted stretches -> (key, ord, start, n, anchor, first): repeats, and the firsts of anchors with several."""
    last_anchor = last_content = None
    waiting = None  # the first stretch of the anchor at hand, not yet known to have company
    names = ["key", "ord", "start", "n", "anchor", "first"]
    for batch in batches:
        anchor, content, key, order, start, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        done = n < 0
        rows = np.flatnonzero(~done)
        out, firsts = [np.flatnonzero(done)], []
        if len(rows):
            a, c = anchor[rows], content[rows]
            same = np.concatenate(([last_anchor is not None and a[0] == last_anchor], a[1:] == a[:-1]))
            equal = same & np.concatenate(([last_content is not None and c[0] == last_content], c[1:] == c[:-1]))
            last_anchor, last_content = a[-1], c[-1]
            out.append(rows[equal])
            distinct = rows[~equal]
            joins = same[~equal]  # not the first of its anchor
            company = joins | np.concatenate((joins[1:], [False]))
            firsts = distinct[company]
            if waiting is not None and len(joins) and joins[0]:
                yield pa.RecordBatch.from_arrays([*waiting, pa.array([True])], names)
            if len(distinct):
                k = int(distinct[-1])
                waiting = None if joins[-1] else [pa.array(x[k:k + 1]) for x in (key, order, start, n, anchor)]
        at = np.concatenate([*out, firsts]).astype(np.int64)
        flag = np.arange(len(at)) >= len(at) - len(firsts)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(x[at]) for x in (key, order, start, np.abs(n), anchor)], pa.array(flag)], names)


def column_index(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of a collection in order: (string, place, common prefix with the one before, transform).

    Column-wise construction. Round k inserts the suffix of k symbols of every string that has
    one. The transform holds, for each suffix so far, the symbol before it (0: none); its
    stable order by symbol is where the suffix extended by that symbol stands. Suffixes inserted
    in the last round are the ones whose extension is new. A new suffix shares with each
    neighbour one symbol more than the least common prefix between the two suffixes that they
    extend; other common prefixes stay. Common prefixes are kept up to ``depth``; strings
    that end stand before those that go on, in the order given.
    """
    m = len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, m)
    ends = np.cumsum(sizes + 1)  # text: 0 s0 0 s1 .. so that 0 stands before each string
    text = np.frombuffer(b"\0" + b"\0".join(strings), np.uint8)
    present, codes = np.unique(text, return_inverse=True)
    codes = (codes + 1).astype(np.uint16 if len(present) > 254 else np.uint8)
    codes[ends - sizes - 1] = 0
    empty = ends.astype(np.int32)
    place, fresh, common = empty, np.ones(m, bool), np.zeros(m, np.uint8)
    before = codes[place - 1]
    none, no_prefix = np.zeros(m, bool), np.zeros(m, np.uint8)
    while True:
        order = np.argsort(before, kind="stable")[len(before) - np.count_nonzero(before):]
        new = fresh[order]
        to = np.flatnonzero(new)
        if not len(to):
            break
        # the new suffixes and those after them, where the one before begins with the same symbol
        near = np.unique(np.concatenate((to, to + 1)))
        near = near[(near > 0) & (near < len(order))]
        near = near[before[order[near]] == before[order[near - 1]]]
        shared = _range_minimum(common, order[near - 1] + 1, order[near] + 1)
        # the new list: the empty suffixes, then the extensions; suffixes of earlier rounds keep their order
        prefix = np.zeros(len(order), np.uint8)
        prefix[~new] = common[m:]
        prefix[to] = 0
        prefix[near] = np.minimum(shared.astype(np.int64) + 1, depth)
        place = np.concatenate((empty, place[order] - 1))
        common = np.concatenate((no_prefix, prefix))
        fresh = np.concatenate((none, new))
        before = codes[place - 1]
    string = np.searchsorted(ends, place, "left")
    return string, place - (ends - sizes)[string], common, before


def _range_minimum(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of ``values[lo[k]:hi[k]]`` for non-empty ranges, from minima over runs of doubling length."""
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.zeros(len(lo), values.dtype)
    run = values
    for v in range(int(level.max(initial=-1)) + 1):
        k = np.flatnonzero(level == v)
        out[k] = np.minimum(run[lo[k]], run[hi[k] - (1 << v)])
        run = np.minimum(run[: -(1 << v)], run[1 << v:])
    return out


def _related(strings: list[bytes], anchors: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which stretches can share a string of ``length`` bytes with another of the same anchor.

    A shared string holds the anchor's ``gram`` bytes and reaches at least half of the other
    bytes to one side of it, so two stretches that share one agree on the anchor with that many
    bytes before it, or after it. Where the gram occurs more than once in a stretch, each place
    counts, because the partner may hold it once.
    """
    width = gram + (length - gram + 1) // 2
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(strings), np.uint8)
    h = gram_hashes(data, gram)
    owner = np.repeat(np.arange(len(strings)), sizes)[: len(h)]
    hit = np.flatnonzero(h.view(np.int64) == anchors[owner])
    hit = hit[hit - starts[owner[hit]] + gram <= sizes[owner[hit]]]
    keep = np.zeros(len(strings), bool)
    own, wide = owner[hit], gram_hashes(data, width)
    for shift in (width - gram, 0):  # the bytes before the anchor, then those after it
        begin = hit - shift
        whole = (begin >= starts[own]) & (begin + width <= starts[own] + sizes[own])
        seen = own[whole]
        with np.errstate(over="ignore"):
            side = wide[begin[whole]] * _U(0x9E3779B97F4A7C15) ^ anchors[seen].view(np.uint64)
        _, back, times = np.unique(side, return_inverse=True, return_counts=True)
        keep[seen[times[back] > 1]] = True
    return keep


def _repeats(strings, keys, orders, starts, length: int):
    """(key, ord, start) of the strings of ``length`` bytes that another one precedes."""
    if not strings:
        return keys, orders, starts
    string, at, common, _ = column_index(strings, length)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    long = np.flatnonzero(sizes[string] - at >= length)
    string, at, linked = string[long], at[long], common[long] >= length
    linked[1:] &= long[1:] == long[:-1] + 1
    group = np.cumsum(~linked)
    key, order, start = keys[string], orders[string], starts[string] + at
    by = np.lexsort((start, order, key, group))
    later = by[1:][group[by[1:]] == group[by[:-1]]]
    return key[later], order[later], start[later]


def _index(length: int, gram: int):
    names = ["key", "ord", "start", "n", "w0", "w1"]

    def rows(key, order, start, w0=None, w1=None):
        n = len(key)
        empty = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(order), pa.array(start), pa.array(np.ones(n, np.int64)),
             empty if w0 is None else pa.array(w0), empty if w1 is None else pa.array(w1)], names)

    def flush(held):
        strings, keys, orders, starts, anchors = zip(*held)
        kept = np.flatnonzero(_related(strings, np.array(anchors, np.int64), length, gram))
        return rows(*_repeats([strings[k] for k in kept.tolist()], np.array(keys, np.int64)[kept],
                              np.array(orders, np.int32)[kept], np.array(starts, np.int64)[kept], length))

    def deal(held):
        for data, key, order, start, _ in held:
            view, n = memoryview(data), len(data) - length + 1
            both = np.array([[xxhash.xxh3_64_intdigest(view[k:k + length]), xxhash.xxh64_intdigest(view[k:k + length], 7)]
                             for k in range(n)], np.uint64).view(np.int64)
            yield rows(np.full(n, key), np.full(n, order, np.int32), start + np.arange(n), both[:, 0], both[:, 1])

    def index(batches):
        done, open_, anchor, hot = [], [], None, False  # stretches of closed anchors, of the one at hand
        for batch in batches:
            for a, key, order, start, data in zip(*[c.to_pylist() for c in batch.columns]):
                if a != anchor:
                    if hot:
                        yield from deal(open_)
                    else:
                        done += open_
                    open_, anchor, hot = [], a, False
                    if len(done) >= BATCH:
                        yield flush(done)
                        done = []
                open_.append((data, key, order, start, a))
                if len(open_) >= HOT:
                    hot = True
                if hot:
                    yield from deal(open_)
                    open_ = []
        if hot:
            yield from deal(open_)
        else:
            done += open_
        if done:
            yield flush(done)

    return index


def _cut(length: int, with_text: bool):
    """Text and its removable starts -> lengths, hash and what is left."""

    def cut(batches):
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.binary())
            for text, order, marks in zip(texts, batch.column("ord").to_pylist(), batch.column("marks").to_pylist()):
                data = text.as_py() or b""
                own = sorted((m["start"], m["start"] + m["n"] + length - 1) for m in marks or () if m["ord"] == order)
                left, at, spans, removed = [], 0, 0, 0
                for s, e in own:
                    if s > at or not spans:
                        left.append(data[at:s])
                        spans += 1
                        removed += e - s
                        at = e
                    elif e > at:
                        removed += e - at
                        at = e
                left.append(data[at:])
                kept = b"".join(left)
                out.append((len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            n, removed, spans, sha, kept = zip(*out) if out else [()] * 5
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(spans, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return cut


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left).

    Texts are UTF-8 bytes, null as empty. Documents are ordered by ``id_col`` (integer; null
    first); rows that share an id are documents of their own, ordered by XXH64 of the text, and
    equal rows one after the other. Texts under ``length`` bytes stay whole. An empty table
    gives no rows; other columns play no part. ``gram`` is at most ``length``; common prefixes
    are kept in one byte, so ``length`` is at most 255.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    parts = shuffle_partitions(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    twin = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("text"))) - 1
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
             .withColumn("key", key).withColumn("ord", twin))
    # bucketed by key: the two joins with the texts below read it without another shuffle
    table = f"llm_texts_{uuid.uuid4().hex}"
    (keyed.write.option("path", f"{scratch.base}/texts").option("compression", "zstd")
     .bucketBy(parts, "key").saveAsTable(table))
    texts = spark.table(table)

    found = (texts.select("key", "ord", "text").mapInArrow(
        _find(length, gram), "anchor long, content long, key long, ord int, start long, n long")
        .repartition(parts, "anchor").sortWithinPartitions("anchor", "content", "key", "ord", "start")
        .mapInArrow(_compare, "key long, ord int, start long, n long, anchor long, first boolean"))
    found = scratch.write(found, "found")

    wanted = found.where("first").groupBy("key").agg(
        F.collect_list(F.struct("ord", "start", "n", "anchor")).alias("marks"))  # of one document

    def fetch(batches):
        for batch in batches:
            out = []
            data = batch.column("text").cast(pa.binary())
            for k, o, text, marks in zip(batch.column("key").to_pylist(), batch.column("ord").to_pylist(), data,
                                         batch.column("marks").to_pylist()):
                text = text.as_py()
                out += [(m["anchor"], k, o, m["start"], text[m["start"]:m["start"] + m["n"] + length - 1])
                        for m in marks if m["ord"] == o]
            columns = zip(*out) if out else [()] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["anchor", "key", "ord", "start", "data"])

    chosen = texts.join(wanted, "key").select("key", "ord", "text", "marks").mapInArrow(
        fetch, "anchor long, key long, ord int, start long, data binary")
    indexed = scratch.write(
        chosen.repartition(parts, "anchor").sortWithinPartitions("anchor", "key", "ord", "start")
        .mapInArrow(_index(length, gram), "key long, ord int, start long, n long, w0 long, w1 long"), "indexed")

    place = F.struct("key", "ord", "start")
    dealt = indexed.where("w0 is not null")
    earliest = dealt.groupBy("w0", "w1").agg(F.min(place).alias("earliest"), F.count("*").alias("same")).where("same > 1")
    repeated = dealt.join(earliest, ["w0", "w1"]).where(place != F.col("earliest"))
    columns = ["key", "ord", "start", "n"]
    marks = (found.where("not first").select(*columns)
             .unionAll(indexed.where("w0 is null").select(*columns)).unionAll(repeated.select(*columns))
             .groupBy("key").agg(F.collect_list(F.struct("ord", "start", "n")).alias("marks")))  # of one document
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return texts.join(marks, "key", "left").select("doc_id", "ord", "text", "marks").mapInArrow(
        _cut(length, with_text), schema)
