"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are short and documents may be long, so the similarity of their whole
shingle sets says little. The items are partitioned by their number of
shingles, with upper sizes that double. For each partition but the smallest, documents are read
through windows of twice the upper size that advance by the upper size, so an
item that stands in a document lies whole in one window of comparable size. A
task reads its documents one after the other, so a window may hold the end of
one and the beginning of the next, but a shingle never does. A window and an
item with an equal MinHash value are candidates, and a candidate counts if the
document holds at least the threshold's share of the item's different shingles,
compared word by word.

In windows, MinHash would miss many of the smallest items, so these are looked
up exactly: a document that holds the threshold's share of an item's shingles
holds one at least of any that are one more than it may lack. Those of them
that the fewest items of the block have are kept in a sorted table, in which
every shingle of a document is looked up.

The items go to the tasks in blocks of bounded size, each block searched
against all documents; documents are never shuffled.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

SHINGLE = 5
THRESHOLD = 0.8
#: MinHash functions; a window that holds 0.8 of an item of more than ``SMALLEST`` shingles is missed with a chance under 0.002.
FUNCTIONS = 32
#: The smallest upper size of a partition; items up to it are looked up exactly.
SMALLEST = 16
#: Words of the items that one block may hold.
BLOCK_WORDS = 1_000_000
#: Words of the documents that are searched at a time; a longer document is searched alone.
STEP_WORDS = 200_000
#: Segments whose MinHash values are computed at a time.
STEP = 4096

_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plain_words(text: str | None) -> list[bytes]:
    """The words of a text in lower case; ASCII punctuation counts as white space."""
    return (text or "").lower().encode().translate(_PLAIN).split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each run of five words."""
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(words) - SHINGLE + 1
    out = np.full(max(count, 0), SHINGLE, np.uint64)
    for i in range(SHINGLE if count > 0 else 0):
        out = (out ^ each[i:i + count]) * _MIX
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Item:
    item_id: int | None
    words: list[bytes]
    hashes: np.ndarray          # of its different shingles
    first: np.ndarray           # where each of them begins


class Index:
    """A block of items, partitioned by size, with their MinHash values or,
    for the smallest, the shingles that ``threshold`` needs to be looked up."""

    def __init__(self, rows: list[tuple[int | None, list[bytes]]], threshold: float = THRESHOLD):
        self.items: list[Item] = []
        self.short: dict[tuple[bytes, ...], list[int]] = {}  # items of fewer than five words
        self.parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[int]] = {}
        for item_id, words in rows:
            if 0 < len(words) < SHINGLE:
                self.short.setdefault(tuple(words), []).append(item_id)
            elif words:
                hashes, first = np.unique(shingle_hashes(words), return_index=True)
                upper = SMALLEST
                while upper < len(hashes):
                    upper *= 2
                by_size.setdefault(upper, []).append(len(self.items))
                self.items.append(Item(item_id, words, hashes, first))
        few = by_size.pop(SMALLEST, [])
        every, many = np.unique(np.concatenate([np.zeros(0, np.uint64), *(self.items[m].hashes for m in few)]), return_counts=True)
        chosen = [np.zeros(0, np.uint64)]
        for m in few:
            own = self.items[m].hashes
            wanted = max(1, math.ceil(threshold * len(own)))
            rarest = np.argsort(many[np.searchsorted(every, own)], kind="stable")
            chosen.append(own[rarest[:max(0, len(own) - wanted + 1)]])
        order = np.argsort(np.concatenate(chosen), kind="stable")
        self.few = np.concatenate(chosen)[order]             # shingles, and the item of each
        self.few_of = np.repeat(np.array(few, np.int64), [len(c) for c in chosen[1:]])[order]
        for upper, members in by_size.items():
            low = np.array([[(self.items[m].hashes * a).min() for a in _FACTORS] for m in members])
            order = np.argsort(low, axis=0, kind="stable")
            self.parts[upper] = (np.take_along_axis(low, order, 0).T.copy(), np.array(members)[order].T.copy())

    def candidates(self, hashes: np.ndarray) -> set[tuple[int, int, int]]:
        """(begin, end, item) of the windows of a row of shingles that share a MinHash value with an item."""
        if not self.parts:
            return set()
        count = -(-len(hashes) // SMALLEST)
        full = np.full(count * SMALLEST, hashes[-1], np.uint64)
        full[:len(hashes)] = hashes
        by_place = np.ascontiguousarray(full.reshape(count, SMALLEST).T)
        segment = np.empty((FUNCTIONS, count), np.uint64)    # the lowest value of each function in each segment
        for start in range(0, count, STEP):
            part = by_place[:, start:start + STEP]
            low = part[0] * _FACTORS[:, None]
            for i in range(1, SMALLEST):
                np.minimum(low, part[i] * _FACTORS[:, None], out=low)
            segment[:, start:start + STEP] = low
        found: set[tuple[int, int, int]] = set()
        upper = SMALLEST
        for wanted in sorted(self.parts):
            while upper < wanted:                            # two segments make one of twice the size
                even, odd = segment[:, ::2].copy(), segment[:, 1::2]
                np.minimum(even[:, :odd.shape[1]], odd, out=even[:, :odd.shape[1]])
                segment, upper = even, upper * 2
            window = segment if segment.shape[1] == 1 else np.minimum(segment[:, :-1], segment[:, 1:])
            values, members = self.parts[wanted]
            for f in range(FUNCTIONS):
                low = np.searchsorted(values[f], window[f])
                low[low == len(values[f])] = 0
                for w in np.flatnonzero(values[f][low] == window[f]).tolist():
                    high = int(np.searchsorted(values[f], window[f][w], "right"))
                    found.update((w * upper, min((w + 2) * upper, len(hashes)), m) for m in members[f][low[w]:high].tolist())
        return found

    def search(self, texts: Iterable[str | None], threshold: float) -> Iterator[list[tuple[int, int, int]]]:
        """For each text: (item id, its different shingles in the text, its
        different shingles) of the items that reach the threshold."""
        held: list[list[bytes]] = []
        size = 0
        for text in texts:
            words = plain_words(text)
            if held and size + len(words) > STEP_WORDS:
                yield from self._search(held, threshold)
                held, size = [], 0
            held.append(words)
            size += len(words)
        yield from self._search(held, threshold)

    def _search(self, docs: list[list[bytes]], threshold: float) -> list[list[tuple[int, int, int]]]:
        out = [[(i, 1, 1) for i in self.short.get(tuple(words), ())] if len(words) < SHINGLE else [] for words in docs]
        # the shingles of all documents in a row; those that would begin in one document and end in another are left out
        sizes = np.array([len(words) for words in docs], np.int64)
        counts = np.maximum(sizes - SHINGLE + 1, 0)
        if not self.items or not counts.any():
            return out
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        whole = place < np.repeat(counts, sizes)
        hashes = shingle_hashes([w for words in docs for w in words])
        hashes = hashes[whole[:len(hashes)]]
        ends = np.cumsum(counts)
        wanted: dict[int, set[int]] = {}
        for begin, end, item in self.candidates(hashes):
            for d in range(int(np.searchsorted(ends, begin, "right")), int(np.searchsorted(ends, end - 1, "right")) + 1):
                wanted.setdefault(d, set()).add(item)
        for d, item in self._looked_up(hashes, ends):
            wanted.setdefault(d, set()).add(item)
        for d, items in wanted.items():
            own = hashes[ends[d] - counts[d]:ends[d]]
            if len(own):
                places = np.argsort(own, kind="stable")
                out[d] = [hit for n in sorted(items) if (hit := self._verified(self.items[n], docs[d], own[places], places, threshold))]
        return out

    def _looked_up(self, hashes: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) where a document has one of the item's chosen shingles."""
        if not len(self.few):
            return set()
        low = np.searchsorted(self.few, hashes)
        low[low == len(self.few)] = 0
        at = np.flatnonzero(self.few[low] == hashes)
        hits = np.unique(np.searchsorted(ends, at, "right") * len(self.few) + low[at])   # a document's shingle once
        found: set[tuple[int, int]] = set()
        for d, first in zip((hits // len(self.few)).tolist(), (hits % len(self.few)).tolist()):
            last = int(np.searchsorted(self.few, self.few[first], "right"))
            found.update((d, m) for m in self.few_of[first:last].tolist())
        return found

    @staticmethod
    def _verified(item: Item, words: list[bytes], ordered: np.ndarray, places: np.ndarray, threshold: float) -> tuple[int, int, int] | None:
        at = np.searchsorted(ordered, item.hashes)
        at[at == len(ordered)] = 0
        same = ordered[at] == item.hashes
        if same.sum() < threshold * len(same):
            return None
        shared = sum(words[p:p + SHINGLE] == item.words[i:i + SHINGLE]
                     for p, i in zip(places[at[same]].tolist(), item.first[same].tolist()))
        return (item.item_id, int(shared), len(same)) if shared >= threshold * len(same) else None


def item_blocks(items: DataFrame, key: str, text: str, block_words: int = BLOCK_WORDS, threshold: float = THRESHOLD) -> Iterator[Broadcast]:
    """The items as broadcast indexes of about ``block_words`` words each; they
    pass the driver one partition and one block at a time."""
    rows: list[tuple[int, list[bytes]]] = []
    size = 0
    texts = items.where(F.col(text).isNotNull()).select(F.col(key).cast("long"), F.col(text).cast("string"))
    for item_id, body in texts.toLocalIterator():
        words = plain_words(body)
        if rows and size + len(words) > block_words:
            yield items.sparkSession.sparkContext.broadcast(Index(rows, threshold))
            rows, size = [], 0
        rows.append((item_id, words))
        size += len(words)
    if rows:
        yield items.sparkSession.sparkContext.broadcast(Index(rows, threshold))


def contained_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                    item_text: str = "text", threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The items that stand in documents: one row for each document and item,
    ``(doc_id, item_id, n_shared, n_item)`` under the names of ``key`` and
    ``item_key``, where ``n_shared`` of the item's ``n_item`` different shingles
    of five words, at least the threshold's share, are in the document.

    An item of fewer than five words is a single shingle, found only in a
    document of the same words. Null or wordless texts hold nothing, nor do
    items with a null key. Repeated rows of documents or items give repeated
    rows. Other columns are ignored; empty tables give an empty result.
    """
    schema = "doc long, item long, n_shared long, n_item long"
    body = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))

    def search(index: Broadcast) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = index.value.search((t.as_py() for t in batch.column(1)), threshold)
                rows = [(d, *hit) for d, hits in zip(batch.column(0).to_pylist(), found) for hit in hits]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)],
                                                 names=["doc", "item", "n_shared", "n_item"])
        return body.mapInArrow(run, schema)

    found = docs.sparkSession.createDataFrame([], schema)
    keyed = items.where(F.col(item_key).cast("long").isNotNull())
    for n, index in enumerate(item_blocks(keyed, item_key, item_text, block_words, threshold)):
        found = search(index) if n == 0 else found.unionAll(search(index))
    return found.select(F.col("doc").alias(key), F.col("item").alias(item_key), "n_shared", "n_item")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                  threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the documents that hold an item (see ``contained_items``),
    with all their columns. Rows with a null text stay. Items with a null key
    count like others."""
    schema = docs.schema

    def without(rest: DataFrame, index: Broadcast) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not hits for hits in index.value.search((t.as_py() for t in batch.column(text)), threshold)]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return rest.mapInArrow(run, schema)

    for index in item_blocks(items, item_key, item_text, block_words, threshold):
        docs = without(docs, index)
    return docs
