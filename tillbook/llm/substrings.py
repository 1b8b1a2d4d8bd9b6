"""Substring dedup by relative Lempel-Ziv parsing.

The reference is every passage that several documents may share, each kept once
under the first document that has it, dealt into indexed blocks. A document is
factored against every block that can hold a window of it:

* Each window of consecutive words has an anchor, the 16-word run of the lowest
  hash in it (the first of equals), so equal windows have equal anchors at the
  same place. Consecutive windows of one anchor make a segment. Segments whose
  anchor only one document has cannot repeat and are dropped.
* A segment that is the same in several documents is one factor of all but the
  first of them. The different segments of an anchor meet in the anchor's block.
  Each is parsed greedily there: a factor is the longest run of words from a
  place, at least a window, that an earlier document's segment has, compared word
  by word; the next one is looked for from the windows that cross its end.
* An anchor with very many different segments (a common passage in ever new
  surroundings) would make too large a block. Its segments are parsed window by
  window instead: the windows' 128-bit hashes find their first documents by an
  aggregate.

Factors go back to the documents as spans of words to remove. Words are compared
as 64-bit hashes, whole segments by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import bit_table, cut, skew_join, split_runs

#: Words of a window and of an anchor.
WINDOW = 50
ANCHOR = 16
#: Different segments of an anchor that a block takes.
BLOCK = 4096
#: Rows of a block's index at a time.
INDEX_ROWS = 20_000
#: Words read at a time; a longer document is read alone.
STEP = 1 << 20
#: Bits of the tables that say which anchors and documents may matter.
BITS = 25

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 26) - 1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    """The runs of characters other than space and the control characters 9 to 13."""
    return text.split() if text else []


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a ^ (a >> np.uint64(31))) * _MIX + b
    out = (out ^ (out >> np.uint64(29))) * _MIX
    return out ^ (out >> np.uint64(32))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out, done, power, width = None, 0, words, 1
    while True:                                   # runs of 1, 2, 4, ... words; those of the size's bits are joined
        if size & width:
            part = power[done:]
            out = part if out is None else _joined(out[:len(part)], part)
            done += width
        if width * 2 > size:
            return out[:len(words) - size + 1]
        power, width = _joined(power[:len(power) - width], power[width:]), width * 2


def segments(words: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Segments of documents laid end to end: (first window, windows, anchor, hash).

    ``owner`` is the document of each word; no window goes over two documents.
    """
    count = len(words) - window + 1
    if count < 1:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    anchors = runs(words, ANCHOR)
    low = (anchors & ~_PLACE) | np.arange(len(anchors), dtype=np.uint64)
    width, span = 1, window - ANCHOR + 1
    while width * 2 <= span:
        low, width = np.minimum(low[:len(low) - width], low[width:]), width * 2
    low = np.minimum(low[:count], low[span - width:span - width + count])
    place = (low & _PLACE).astype(np.int64)
    whole = owner[:count] == owner[window - 1:]
    begins = np.flatnonzero(whole & np.append(True, (place[1:] != place[:-1]) | ~whole[:-1]))
    ends = np.flatnonzero(whole & np.append((place[1:] != place[:-1]) | ~whole[1:], True))
    each = runs(words, window)
    return begins, ends - begins + 1, anchors[place[begins]], _joined(each[begins], each[ends])


def _read(batch: pa.RecordBatch, hashes: _Hashes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a batch by steps: (row numbers, words of all, number of words of each)."""
    held, rows, size = [], [], 0
    for n, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        if len(hashes) > STEP:
            hashes.clear()
        words = words_of(text)
        if rows and size + len(words) > STEP:
            yield np.array(rows), np.concatenate(held), np.array([len(h) for h in held])
            held, rows, size = [], [], 0
        held.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        rows.append(n)
        size += len(words)
    if rows:
        yield np.array(rows), np.concatenate(held), np.array([len(h) for h in held])


def _taken(column: pa.Array, rows: np.ndarray) -> pa.Array:
    return column.take(pa.array(rows))


def find_segments(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(anchor, hash, id, text_hash, first, n)`` of every segment of ``(id, text_hash, text)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for rows, words, sizes in _read(batch, hashes):
                begins = np.cumsum(sizes) - sizes
                owner = np.repeat(np.arange(len(rows)), sizes)
                first, n, anchor, digest = segments(words, owner, window)
                of = owner[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)), _taken(batch.column("id"), rows[of]),
                     _taken(batch.column("text_hash"), rows[of]), pa.array(first - begins[of]), pa.array(n)],
                    names=["anchor", "hash", "id", "text_hash", "first", "n"])

    return docs.mapInArrow(run, "anchor long, hash long, id long, text_hash long, first long, n long")


def _with_words(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``wanted`` segments ``(anchor, hash, id, text_hash, first, n)`` with the hashes of their words as ``words``."""
    per_doc = wanted.groupBy(F.col("id").alias("of"), F.col("text_hash").alias("of_hash")).agg(
        F.collect_list(F.struct("anchor", "hash", "first", "n")).alias("parts"))
    chosen = may_be_in(docs, F.xxhash64("id", "text_hash"), wanted.select(F.xxhash64("id", "text_hash").alias("x")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            ids, parts = batch.column("id").to_pylist(), batch.column("parts")
            for rows, words, sizes in _read(batch, hashes):
                for row, begin in zip(rows.tolist(), (np.cumsum(sizes) - sizes).tolist()):
                    of = parts[row].values
                    first, n = (of.field(c).to_numpy() for c in ("first", "n"))
                    blobs = [words[begin + f:begin + f + k + window - 1].tobytes() for f, k in zip(first.tolist(), n.tolist())]
                    yield pa.RecordBatch.from_arrays([of.field("anchor"), of.field("hash"), pa.array([ids[row]] * len(of), pa.int64()),
                                                      pa.array(blobs, pa.binary())], names=["anchor", "hash", "id", "words"])

    joined = chosen.join(per_doc, (F.col("id") == F.col("of")) & (F.col("text_hash") == F.col("of_hash"))).select("id", "text", "parts")
    return joined.mapInArrow(run, "anchor long, hash long, id long, words binary")


def may_be_in(df: DataFrame, number: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``number`` may be among the one column of ``keys``:
    those whose bit in a table of fixed size is set, which are all that are. Fewer
    rows are then shuffled by the exact join that follows."""
    modulus = F.lit(1 << BITS)
    table = bit_table(keys.select(F.pmod(F.col(keys.columns[0]), modulus).alias("bit")), BITS)
    parts = [(n, bytearray(table[n * 4096:(n + 1) * 4096])) for n in range(len(table) // 4096) if any(table[n * 4096:(n + 1) * 4096])]
    bits = F.broadcast(df.sparkSession.createDataFrame(parts, "__part int, __bits binary"))
    bit = F.pmod(number, modulus)
    byte = F.conv(F.hex(F.substring("__bits", (F.col("__bit") / 8 % 4096).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return (df.withColumn("__bit", bit).join(bits, F.floor(F.col("__bit") / 32768) == F.col("__part"))
            .where(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1).drop("__bit", "__part", "__bits"))


def parse_block(anchors: np.ndarray, ids: np.ndarray, blobs: list[bytes], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """For each segment of a block, sorted by anchor and document, its factors
    that earlier documents' segments have: (first word, words)."""
    sizes = np.array([len(b) // 8 for b in blobs])
    words = np.frombuffer(b"".join(blobs), np.uint64)
    ends = np.cumsum(sizes)
    begins, row = ends - sizes, np.repeat(np.arange(len(sizes)), sizes)
    each = runs(words, window)
    whole = np.flatnonzero(row[:len(each)] == row[window - 1:])
    _, first, kind = np.unique(each[whole], return_index=True, return_inverse=True)
    source = whole[first[kind]]                                # the window's first place in the block
    hit = ids[row[source]] < ids[row[whole]]
    out: list[list[tuple[int, int]]] = [[] for _ in blobs]
    places, sources = whole[hit], source[hit]
    at = 0
    while at < len(places):
        here, there = int(places[at]), int(sources[at])
        own, other = int(row[here]), int(row[there])
        most = min(int(ends[own]) - here, int(ends[other]) - there)
        differs = np.flatnonzero(words[here:here + most] != words[there:there + most])
        length = int(differs[0]) if len(differs) else most
        if length < window:                                    # equal hashes of different words
            at += 1
            continue
        out[own].append((here - int(begins[own]), length))
        # the windows inside the factor are covered; those that cross its end are looked up next
        at = int(np.searchsorted(places, here + length - window + 1))
    return out


def _parsed(block: DataFrame, window: int) -> DataFrame:
    """``(anchor, hash, id, at, size)`` of the factors in segments, each anchor's in one block."""
    dealt = block.repartition("anchor").sortWithinPartitions("anchor", "id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in split_runs(batches, "anchor", INDEX_ROWS):
            columns = [table.column(c).to_numpy() for c in ("anchor", "id", "hash")]
            found = parse_block(columns[0], columns[1], table.column("words").to_pylist(), window)
            rows = [(columns[0][n], columns[2][n], columns[1][n], at, size) for n, factors in enumerate(found) for at, size in factors]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)],
                                             names=["anchor", "hash", "id", "at", "size"])

    return dealt.mapInArrow(run, "anchor long, hash long, id long, at long, size long")


def _by_window(block: DataFrame, window: int) -> DataFrame:
    """The same for anchors of too many segments, window by window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, digest, doc, blob in zip(*(batch.column(c).to_pylist() for c in ("anchor", "hash", "id", "words"))):
                words = np.frombuffer(blob, np.uint64)
                n = len(words) - window + 1
                pair = [runs(words, window), runs(words ^ _MIX, window)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(n, x, np.int64)) for x in (anchor, digest, doc)), pa.array(np.arange(n)), *(pa.array(p.view(np.int64)) for p in pair)],
                    names=["anchor", "hash", "id", "at", "h1", "h2"])

    each = block.mapInArrow(run, "anchor long, hash long, id long, at long, h1 long, h2 long")
    first = each.groupBy(F.col("h1").alias("f1"), F.col("h2").alias("f2")).agg(F.min("id").alias("first_id"))
    return (skew_join(each, first, {"h1": "f1", "h2": "f2"}).where("first_id < id")
            .select("anchor", "hash", "id", "at", F.lit(window).cast("long").alias("size")))


def repeated_spans(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``(of, of_hash, spans)``: the runs of words of each document ``(id,
    text_hash, text)`` that lie in windows of earlier documents, as
    ``array<struct<at, size>>`` in any order, which may overlap."""
    every = find_segments(docs, window)
    shared = cut(every.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select(F.col("anchor").alias("of")))
    hits = cut(skew_join(may_be_in(every, F.col("anchor"), shared.select("of")), shared, {"anchor": "of"}).drop("of"))
    first = cut(hits.groupBy("anchor", "hash").agg(F.min(F.struct("id", "text_hash", "first", "n")).alias("s"))
                .select("anchor", "hash", "s.*"))
    many = (first.groupBy(F.col("anchor").alias("of")).agg(F.count("*").alias("kinds")).where("kinds > 1"))
    sources = cut(_with_words(docs, skew_join(first, many.drop("kinds"), {"anchor": "of"}).drop("of"), window))
    large = many.where(F.col("kinds") > block).select("of")
    small = many.where(F.col("kinds") <= block).select("of")
    factors = _parsed(skew_join(sources, small, {"anchor": "of"}).drop("of"), window).unionAll(
        _by_window(skew_join(sources, large, {"anchor": "of"}).drop("of"), window))
    # the first document of a segment loses its factors, the others lose all of it
    owner = first.select(F.col("anchor").alias("a"), F.col("hash").alias("h"), F.col("id").alias("first_id"))
    owned = skew_join(hits, owner, {"anchor": "a", "hash": "h"})
    copies = owned.where("id > first_id").select("id", "text_hash", F.col("first").alias("at"), (F.col("n") + window - 1).alias("size"))
    parsed = (hits.join(factors.select(F.col("anchor").alias("a"), F.col("hash").alias("h"), F.col("id").alias("of"), "at", "size"),
                        (F.col("anchor") == F.col("a")) & (F.col("hash") == F.col("h")) & (F.col("id") == F.col("of")))
              .select("id", "text_hash", (F.col("first") + F.col("at")).alias("at"), "size"))
    return (copies.unionAll(parsed).groupBy(F.col("id").alias("of"), F.col("text_hash").alias("of_hash"))
            .agg(F.collect_list(F.struct("at", "size")).alias("spans")))


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``(key, text, n_words, n_removed, removed)``: one row for each document,
    its text without the words that lie in a run of ``window`` words which an
    earlier document (of a smaller integer key) has too.

    Words are runs of characters other than space and the control characters 9
    to 13, unchanged; the kept ones are joined by one space. ``removed`` lists the
    removed runs as ``array<struct<at, size>>`` of words of the input, ascending and apart. All windows
    are judged on the input.

    A null text has no words and becomes empty. A row with a null key is no
    document: it keeps its words and takes none from others. Rows of one key are
    neither earlier than each other. Texts shorter than a window, and those that
    one key repeats within itself, lose nothing. ``window`` is at least 32 words.
    Other columns are ignored and not returned. An empty table gives an empty
    result. ``block`` decides how an anchor's segments are compared, not the result.
    """
    body = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
                       F.col(text).cast("string").alias("text"))
    spans = cut(repeated_spans(body.where("id IS NOT NULL AND text IS NOT NULL"), window, block))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, (doc, body) in enumerate(zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())):
                words = words_of(body)
                found = batch.column("spans")[n].values
                lost = np.zeros(len(words) + 1, np.int64)
                if found is not None:
                    at, size = (found.field(c).to_numpy() for c in ("at", "size"))
                    np.add.at(lost, at, 1)
                    np.add.at(lost, at + size, -1)
                gone = np.cumsum(lost)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if len(edge) else b" ".join(words)
                out.append((doc, kept.decode(), len(words), int(gone.sum()), [{"at": a, "size": b - a} for a, b in edge.reshape(-1, 2).tolist()]))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)],
                                             names=["id", "text", "n_words", "n_removed", "removed"])

    def cleaned(rows: DataFrame) -> DataFrame:
        return rows.select("id", "text", "spans").mapInArrow(run, "id long, text string, n_words long, n_removed long, removed array<struct<at:long,size:long>>")

    joined = body.join(spans, (F.col("id") == F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left")
    return cleaned(joined).select(F.col("id").alias(key), F.col("text").alias(text), "n_words", "n_removed", "removed")
