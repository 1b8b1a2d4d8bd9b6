"""SimHash near-duplicates, searched with BK-trees.

A fingerprint is 64 bits wide. Fingerprints are dealt into shards of which two
within the radius always share one: the 64 bits are cut into ``radius + 2``
blocks (16 bits each for the radius 2), so fingerprints that differ in at most
``radius`` bits agree on at least two blocks, and every pair of blocks names a
shard (six for the radius 2). Each shard is a BK-tree whose children are keyed
by their integer Hamming distance to the parent, and a search follows only the
edges within the radius of the distance to the node.

The trees of all fingerprints grow with the input, so they are not sent through
the driver: a shard's tree is built in the task that its fingerprints are
shuffled to, next to the fingerprints that search it. A shard over
``SHARD_ROWS`` is never held: its fingerprints are dealt once more by two of
four shares of the bits that the shard leaves free, after which 48 bits are
fixed and a shard has 65,536 different fingerprints at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import components, cut, split_runs, tied_classes

SEED = 42
SHARD_ROWS = 16_384
#: Pairs of (search, node) that one step of the tree search may hold.
FRONTIER = 1_000_000
_LANES = np.uint64(0x0101010101010101)


def text_fingerprint(text: bytes | None, words: int) -> int:
    """The 64-bit SimHash of a UTF-8 text's word shingles, repeats included.

    A-Z count as a-z; words end at space and the control characters 9 to 13. A
    text of fewer words is one shingle; one without words, or null, gives 0.
    """
    found = (text or b"").lower().split()
    if not found:
        return 0
    shingles = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    starts = np.arange(0, len(hashes), 255)                 # 255 ones still fit a byte lane
    ones = np.empty((8, 8), np.int64)                       # [bit of a byte, byte]
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        ones[bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    over = (2 * ones > len(hashes)).T                       # [byte, bit of a byte]
    return int.from_bytes(np.packbits(over, axis=1, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, out: str = "fp") -> DataFrame:
    """``docs`` without its text, with the fingerprint as a signed long ``out``."""
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(*kept, F.col(text).cast("binary").alias("__text"))
    schema = rows.drop("__text").schema.add(out, "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((text_fingerprint(x.as_py(), words) for x in batch.column("__text")),
                                 np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(values.view(np.int64))],
                                             names=[*kept, out])

    return rows.mapInArrow(run, schema)


def _shard_keys(fp: Column, radius: int, within: Column | None = None) -> Column:
    """The shards of a fingerprint: one for each pair of its ``radius + 2`` parts.

    A part is a block of bits next to each other. ``within`` a shard, a part is
    an equal share of the bits of every block, so it halves what is still free.
    """
    parts = radius + 2
    width = -(-64 // parts)
    if within is None:
        bits = [[(i * width, width)] for i in range(parts)]
    else:
        fine = -(-width // parts)
        bits = [[(i, fine) for i in range(s * fine, 64, parts * fine)] for s in range(parts)]
    part = [[F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1)) for at, n in own] for own in bits]
    first = [] if within is None else [within]
    return F.explode(F.array(*(F.xxhash64(*first, F.lit(n).cast("long"), *part[i], *part[j])
                               for n, (i, j) in enumerate(combinations(range(parts), 2)))))


class Forest:
    """BK-trees over runs of fingerprints, one tree for each run, in arrays.

    ``run`` numbers the runs in ascending order. The first fingerprint of a run
    is its root; a fingerprint joins the child of its node that is keyed by its
    Hamming distance to the node, or becomes that child.
    """

    def __init__(self, fps: np.ndarray, run: np.ndarray):
        self.fps, self.run = fps, run
        n = len(fps)
        self.root = np.searchsorted(run, run)                # the first of each run
        parent, key = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        rows = np.flatnonzero(np.arange(n) != self.root)
        node = self.root[rows]
        while len(rows):
            distance = np.bitwise_count(fps[rows] ^ fps[node]).astype(np.int64)
            order = np.lexsort((rows, distance, node))
            rows, node, distance = rows[order], node[order], distance[order]
            slot = node * 65 + distance
            first = np.r_[True, slot[1:] != slot[:-1]]
            parent[rows[first]], key[rows[first]] = node[first], distance[first]
            child = rows[first][np.cumsum(first) - 1]        # the child that the others go below
            rows, node = rows[~first], child[~first]
        self.children = np.flatnonzero(parent >= 0)
        slots = parent[self.children] * 65 + key[self.children]
        order = np.argsort(slots, kind="stable")
        self.children, self.slots = self.children[order], slots[order]

    def near(self, radius: int, most: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows (search, node) of a run within ``radius`` bits, each way once."""
        step = max(1, most // int(np.bincount(self.run).max(initial=1)))
        for start in range(0, len(self.fps), step):
            who = np.arange(start, min(start + step, len(self.fps)))
            node = self.root[who]
            while len(who):
                distance = np.bitwise_count(self.fps[who] ^ self.fps[node]).astype(np.int64)
                hit = (distance <= radius) & (node < who)
                if hit.any():
                    yield who[hit], node[hit]
                low = np.searchsorted(self.slots, node * 65 + np.maximum(distance - radius, 0))
                high = np.searchsorted(self.slots, node * 65 + np.minimum(distance + radius, 64), side="right")
                count = high - low
                who = np.repeat(who, count)
                ends = np.cumsum(count)
                node = self.children[np.arange(len(who)) - np.repeat(ends - count - low, count)]


def link_roots(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches through ``pairs``."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:                                      # every row points to a root again
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _search(batches: Iterable[pa.RecordBatch], radius: int, most: int) -> Iterator[pa.RecordBatch]:
    """Edges (node, smallest node linked to it within the shard); rows of shards
    over ``most`` come back with their shard for the next round."""
    names = ["node", "low", "fp", "shard"]
    for over, table in split_runs(batches, "shard", most):
        if over:
            for part in table.to_batches():
                yield pa.RecordBatch.from_arrays([part["node"], pa.nulls(part.num_rows, pa.int64()),
                                                  part["fp"], part["shard"]], names=names)
            continue
        fp, node, shard = (table[c].to_numpy() for c in ("fp", "node", "shard"))
        same = shard[1:] == shard[:-1]
        kept = np.r_[False, same] | np.r_[same, False]       # a shard of one has no links
        fp, node, shard = fp[kept], node[kept], shard[kept]
        if not len(fp):
            continue
        run = np.cumsum(np.r_[0, shard[1:] != shard[:-1]])
        root = link_roots(len(fp), Forest(fp.view(np.uint64), run).near(radius))
        moved = np.flatnonzero(root != np.arange(len(fp)))
        if len(moved):
            none = pa.nulls(len(moved), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]]), none, none], names=names)


def near_links(classes: DataFrame, radius: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``(node, low)`` that connect exactly the nodes whose fingerprints
    are linked by steps of at most ``radius`` differing bits.

    ``classes`` holds ``(fp, node)``, one row for each different fingerprint. A
    shard's edges form a forest towards its smallest nodes, never all pairs.
    """
    if not 1 <= radius <= 14:
        raise ValueError("the radius must be 1 to 14 bits")

    def searched(dealt: DataFrame, most: int) -> DataFrame:
        return cut(dealt.repartition("shard").sortWithinPartitions("shard", "node")
                   .mapInArrow(lambda batches: _search(batches, radius, most), "node long, low long, fp long, shard long"))

    first = searched(classes.select("fp", "node", _shard_keys(F.col("fp"), radius).alias("shard")), shard_rows)
    links, late = first.where("low is not null").select("node", "low"), first.where("low is null")
    if late.isEmpty():
        return links
    again = late.select("fp", "node", _shard_keys(F.col("fp"), radius, F.col("shard")).alias("shard"))
    return links.unionAll(searched(again, 1 << 62).where("low is not null").select("node", "low"))


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
                       radius: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Near-duplicate groups of documents by their SimHash fingerprints.

    Returns one row per input row: ``key``, ``fingerprint`` (16 lowercase hex
    digits), ``component_id``, the smallest key reachable over links of at most
    ``radius`` differing bits, its own included, and ``text_hash`` (XXH64 of the
    text), which tells rows of one key apart.

    A null or wordless text has the fingerprint zero and is linked like any
    other. Rows with a null key get a fingerprint, link with nothing and have a
    null component. Rows that repeat a key are one document in all their texts,
    so they share a component, with all that any of them is near to.
    Other columns are ignored. An empty table gives an empty result.
    """
    own = F.col(text).cast("string")
    marked = cut(fingerprints(docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(own).alias("text_hash"), own.alias("text")), "text", words))
    keyed = marked.where("key is not null")
    classes = cut(keyed.groupBy("fp").agg(F.min("key").alias("node")))
    group = components(near_links(classes, radius, shard_rows).unionAll(tied_classes(keyed, classes, "key", ["fp"])), "node", "low")
    ids = classes.join(group, "node", "left").select(F.col("fp").alias("of"), F.coalesce("component", "node").alias("id"))
    return (marked.join(ids, marked["fp"] == ids["of"], "left")
            .select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("key").isNotNull(), F.col("id")).alias("component_id"), "text_hash"))
