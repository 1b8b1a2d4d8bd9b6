"""Near-duplicate vectors by Euclidean p-stable hashing.

Two unit vectors with cosine c are sqrt(2 - 2c) apart, so a cosine search is a
Euclidean one on normalised vectors. A hash is floor((a.x + b) / width) with a
Gaussian direction a and a random shift b; a table's bucket is the tuple of its
hashes. Vectors that share a bucket of some table are compared exactly.

Equal vectors are one class from the start. Buckets with one class are dropped
before any vector moves. Inside a bucket, links are counted and merged where
they are found: a link is counted by the first table in which it is met, and a
bucket leaves one row per member and never its pairs. A bucket with more than
``BLOCK`` members is cut into blocks, and each pair of blocks is one task's
work, so all its pairs are compared without holding it in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.common import components, cut, skew_join, split_runs, tied_classes
from tillbook.llm.simhash import link_roots

SIMILARITY = 0.98
#: At cosine 0.98 (distance 0.2) a table's 8 hashes of width 1.0 agree with a chance
#: of 0.25, so one of 32 tables does with 0.9999; at a right angle with 3e-5.
TABLES, HASHES, WIDTH = 32, 8, 1.0
#: So many vectors of a label are compared well by that; see ``sized`` for more.
ROOM = 1 << 14
#: The chances that one hash of that width agrees at cosine 0.98 and at a right angle.
NEAR, FAR = 0.84, 0.271
BLOCK = 256
#: Buckets of so many members at most are compared many at a time.
SMALL = 32
SEED = 7


def sized(n: int) -> tuple[int, int]:
    """Tables and hashes for ``n`` vectors of a label: each hash more lets a
    vector meet ``FAR`` times as many strangers in a bucket, so their number stays
    what it is at ``ROOM``; as many tables more keep the chance to meet a near
    one. Work grows with the power 1.14 of ``n`` at most."""
    hashes = HASHES + max(0, math.ceil(math.log(max(n, 1) / ROOM) / -math.log(FAR)))
    return math.ceil(TABLES * NEAR ** (HASHES - hashes)), hashes


def bucket_keys(unit: np.ndarray, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH) -> np.ndarray:
    """A 64-bit bucket for each unit row and table."""
    rng = np.random.default_rng(SEED)
    direction = rng.standard_normal((unit.shape[1], tables * hashes))
    shift = rng.random(tables * hashes) * width
    cell = np.floor((unit @ direction + shift) / width).astype("<i4").reshape(len(unit), tables, hashes)
    return np.array([[xxhash.xxh64_intdigest(row[t].tobytes(), t) for t in range(tables)] for row in cell], np.uint64
                    ).reshape(len(unit), tables).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True)        # so that squares neither overflow nor vanish
    scaled = rows / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


#: A class of equal vectors goes by 128 bits of hash.
CLASS = ["h1", "h2"]


def _hashed(batches: Iterable[pa.RecordBatch], tables: int, hashes: int, width: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
        for n in np.unique(size):
            some = batch.filter(pa.array(size == n))
            keys = bucket_keys(_unit(_matrix(some.column("vector"))), tables, hashes, width)
            yield pa.RecordBatch.from_arrays(
                [some.column("h1"), some.column("h2"), pa.FixedSizeListArray.from_arrays(keys.ravel(), keys.shape[1]).cast(pa.list_(pa.int64()))],
                names=[*CLASS, "keys"])


def _linked(batches: Iterable[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks: its members' new links, weighted by the copies at
    the other end, and the smallest member that each one reaches."""
    for _, table in split_runs(batches, "work", 1 << 62):
        sizes = table["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            yield _links(table.filter(pa.array(sizes == size)).combine_chunks(), similarity)


def _near(unit: np.ndarray, starts: np.ndarray, ends: np.ndarray, side: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of near rows of the same work, which begins and ends at the given rows; a few at a time."""
    small = (side[starts] == 2) & (ends - starts <= SMALL)
    # the rows of small buckets, each with those behind it
    rows = np.flatnonzero(np.repeat(small, ends - starts))
    behind = np.repeat(ends, ends - starts)[rows] - 1 - rows
    step = max(1, (1 << 21) // unit.shape[1])
    total = np.cumsum(behind)
    for some in np.split(np.arange(len(rows)), np.searchsorted(total, np.arange(step, total[-1] if len(total) else 0, step))):
        a = np.repeat(rows[some], behind[some])
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(behind[some]) - behind[some], behind[some])
        near = np.einsum("ij,ij->i", unit[a], unit[b]) >= similarity
        yield a[near], b[near]
    for start, end in zip(starts[~small].tolist(), ends[~small].tolist()):
        one_block = side[start] == 2
        left = start + np.flatnonzero(side[start:end] != 1)
        right = left if one_block else start + np.flatnonzero(side[start:end] == 1)
        for first in range(0, len(left), 256):
            rows = left[first:first + 256]
            a, b = np.nonzero(unit[rows] @ unit[right].T >= similarity)
            a, b = rows[a], right[b]
            yield (a[a < b], b[a < b]) if one_block else (a, b)


def _links(part: pa.Table, similarity: float) -> pa.RecordBatch:
    """Links within the works of rows whose vectors are equally long."""
    work, h1, h2, node, copies, side, at = (part[c].to_numpy() for c in ("work", *CLASS, "node", "copies", "side", "at"))
    keys, unit = _matrix_of_longs(part["keys"]), _unit(_matrix(part["vector"].combine_chunks()))
    ends = np.flatnonzero(np.r_[work[1:] != work[:-1], True]) + 1
    links, pairs, table = np.zeros(len(node), np.int64), [], np.arange(keys.shape[1])
    for a, b in _near(unit, np.r_[0, ends[:-1]], ends, side, similarity):
        for first in range(0, len(a), 65_536):               # not counted before, by a table in which both met
            x, y = a[first:first + 65_536], b[first:first + 65_536]
            most = int(at[x].max())
            new = ~((keys[x, :most] == keys[y, :most]) & (table[:most] < at[x, None])).any(axis=1)
            x, y = x[new], y[new]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            if len(x):
                pairs.append((x, y))
    root = link_roots(len(node), pairs)
    used = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (h1[used], h2[used], node[used], links[used], node[root[used]])],
                                      names=[*CLASS, "node", "links", "low"])


def _matrix_of_longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 similarity: float = SIMILARITY, tables: int | None = None, hashes: int | None = None, width: float = WIDTH,
                 block: int = BLOCK) -> DataFrame:
    """Links between vectors of the same label with cosine ``similarity`` or more.

    Returns one row per input row: ``key``, ``n_links`` (other rows linked
    directly), ``component_id`` (the smallest key reachable by links, its own
    included) and ``kept`` (the key is its component's).

    A vector links with nothing if it, its label or its key is null, if it is
    empty or zero, or if a component is null or not finite; its component is its
    key. Vectors of different lengths never link. Equal rows link like others;
    rows that repeat a key are counted one by one and share a component. Other
    columns are ignored; an empty table gives an empty result.

    ``tables`` and ``hashes`` follow from the largest label's number of
    different vectors (see ``sized``) unless they are given, as they should be for
    another ``similarity`` or ``width``.
    """
    values = F.col(vector) if dict(vectors.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), values.alias("vector"))
    sound = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        F.exists("vector", lambda x: x != 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    used = rows.where(sound).withColumns({"h1": F.xxhash64("label", "vector"), "h2": F.xxhash64(F.lit(1), "label", "vector")})
    # copies are one class, named by its smallest key
    classes = cut(used.groupBy(*CLASS).agg(F.min("id").alias("node"), F.count("*").alias("copies"),
                                           F.first("label").alias("label"), F.first("vector").alias("vector")))
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    tables, hashes = (given or own for given, own in zip((tables, hashes), sized(largest)))
    keyed = cut(classes.select(*CLASS, "vector").mapInArrow(
        lambda b: _hashed(b, tables, hashes, width), "h1 long, h2 long, keys array<long>"))
    kind = classes.select(*CLASS, "label", F.size("vector").alias("size"))
    spot = (keyed.join(kind, CLASS).select(*CLASS, "label", "size", F.posexplode("keys").alias("at", "bucket"))
            .select(*CLASS, "at", F.xxhash64("label", "size", "at", "bucket").alias("spot")))
    sizes = spot.groupBy("spot").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("spot", "of")
    shared = (skew_join(spot, sizes, {"spot": "of"})
              .select(*CLASS, "at", "spot", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    # a member of a block works with its own block and with every other one
    work = (shared.withColumn("mine", F.pmod(F.col("h1"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*CLASS, "at", F.xxhash64("spot", F.least("mine", "other"), F.greatest("mine", "other")).alias("work"),
                    F.when(F.col("mine") == F.col("other"), 2).otherwise((F.col("mine") > F.col("other")).cast("int")).alias("side")))
    full = work.join(classes.select(*CLASS, "node", "copies", "vector"), CLASS).join(keyed, CLASS)
    found = cut(full.repartition("work").sortWithinPartitions("work", "node").mapInArrow(
        lambda b: _linked(b, similarity), "h1 long, h2 long, node long, links long, low long"))
    group = components(found.select("node", "low").unionAll(tied_classes(used, classes, "id", CLASS)), "node", "low")
    counted = found.groupBy(*CLASS).agg(F.sum("links").alias("links"))
    about = (classes.select(*CLASS, "node", "copies").join(counted, CLASS, "left").join(group, "node", "left")
             .select(F.col("h1").alias("of1"), F.col("h2").alias("of2"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    linked = skew_join(used.select("id", *CLASS), about, {"h1": "of1", "h2": "of2"}).select("id", "n_links", "component_id")
    lone = rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(lone).select(F.col("id").alias(key), "n_links", "component_id",
                                        (F.col("id") == F.col("component_id")).alias("kept"))
