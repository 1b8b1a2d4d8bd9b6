"""Cross-entropy difference of two n-gram language models.

A target model is counted on the documents that are labelled good, a background
model on all documents. They are matched: one vocabulary (the ids of a public
tokenizer and a begin mark), the same order and smoothing, and the background's
counts scaled to the target's number of tokens, so that smoothing weighs the
same in both. A document's score is the mean over its tokens of the difference
of their losses.

Counts come from every token of every document and are exact. Those of single
ids, bounded by the vocabulary, are sent to all tasks. Those of pairs grow with
the corpus and stay apart: documents are read in chunks of about ``STEP``
tokens, a group of ``CHUNKS`` of them names each of its different pairs once,
with its count there, as one row; the rows of a pair are added up, every group
gets the sums of its own pairs back, and its documents are scored with them.
So the rows grow with the groups' different pairs, and a pair has one row for
each group at most, however common it is: no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillbook.llm.common import cut
from tillbook.llm.packing import _encoders, token_ids

#: Bits of a pair's number; no two pairs share one.
PAIR_BITS = 64
#: Weight of the lower order, in tokens.
PAIR_WEIGHT = 20.0
#: Added to the count of every id.
EXTRA = 0.5
#: Ids that are looked at together; a longer document is looked at alone.
STEP = 1 << 19
#: Chunks whose pairs are counted together.
CHUNKS = 8


def vocabulary(tokenizer: str) -> int:
    """Ids of the tokenizer; the number itself is the begin mark's id."""
    return _encoders(tokenizer)[2].get_vocab_size()


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0, compressed, behind their width and count."""
    low = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    return bytes([low.itemsize]) + len(low).to_bytes(7, "little") + pa.compress(low.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, count = data[0], int.from_bytes(data[1:8], "little")
    if not count:
        return np.zeros(0, np.int64)
    return np.frombuffer(pa.decompress(data[8:], width * count, "zstd", asbytes=True), f"<u{width}").astype(np.int64)


def _befores(ids: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """The id before each, where the texts' ids stand one after the other."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = size
    return before


def _chunks(marked: DataFrame, tokenizer: str, step: int) -> DataFrame:
    """``(part, keys, sizes, chosen, ids)``: rows (key, text, chosen), some ``step`` ids together, and their group of chunks."""
    kind = marked.schema["key"].dataType.simpleString()
    schema = f"part long, keys array<{kind}>, sizes array<long>, chosen array<boolean>, ids binary"
    arrow = to_arrow_schema(marked.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, total, done = TaskContext.get().partitionId() << 32, [], 0, 0

        def row() -> pa.RecordBatch:
            keys, chosen, ids = zip(*held)
            values = (first + done // (CHUNKS * step), keys, [len(x) for x in ids], chosen, _packed(np.concatenate(ids)))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

        for batch in batches:
            for key, text, chosen in zip(*batch.columns):
                held.append((key.as_py(), chosen.as_py(), token_ids(text.as_py(), tokenizer)[:-1]))
                total += len(held[-1][2]) + 1                # so that empty texts fill a chunk too
                if total >= step:
                    yield row()
                    held, total, done = [], 0, done + total
        if held:
            yield row()

    return marked.select("key", "text", "chosen").mapInArrow(run, schema)


def count_ids(chunks: DataFrame, size: int) -> np.ndarray:
    """How often each id and, from ``size + 1``, each id as a context occurs: [target or all, place]."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * (size + 1)), np.int64)
        for batch in batches:
            for sizes, chosen, data in zip(batch.column(0), batch.column(1), batch.column(2)):
                sizes, ids = np.array(sizes.as_py(), np.int64), _unpacked(data.as_py())
                before, good = _befores(ids, sizes, size), np.repeat(np.array(chosen.as_py(), bool), sizes)
                for row, some in ((0, good), (1, slice(None))):
                    counts[row] += np.bincount(ids[some], minlength=2 * (size + 1))
                    counts[row] += np.bincount(before[some] + size + 1, minlength=2 * (size + 1))
        at = np.flatnonzero(counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[0, at]), pa.array(counts[1, at])],
                                         names=["place", "in_target", "in_all"])

    table = (chunks.select("sizes", "chosen", "ids").mapInArrow(run, "place int, in_target long, in_all long")
             .groupBy("place").agg(F.sum("in_target").alias("in_target"), F.sum("in_all").alias("in_all"))
             .toArrow())                                     # as many rows as there are places at most
    counts = np.zeros((2, 2 * (size + 1)), np.int64)
    at = table["place"].to_numpy()
    counts[0, at], counts[1, at] = table["in_target"].to_numpy(), table["in_all"].to_numpy()
    return counts


def _pairs(ids: np.ndarray, before: np.ndarray, size: int) -> np.ndarray:
    assert (size + 1) ** 2 <= 1 << (PAIR_BITS - 1)
    return before * (size + 1) + ids


def count_pairs(chunks: DataFrame, size: int) -> DataFrame:
    """``(part, pair, target, every)``: for each group of chunks, how often each
    of its pairs occurs in the target and in all documents."""
    names = ["part", "pair", "target", "every"]

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> pa.RecordBatch:
            pairs, of = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            counts = [np.bincount(of, np.concatenate([h[n] for h in held]), len(pairs)).astype(np.int64) for n in (1, 2)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(pairs), now, np.int64), pairs, *counts)], names=names)

        now, held = None, []
        for batch in batches:
            for part, sizes, chosen, data in zip(*batch.columns):
                if held and part.as_py() != now:             # a group met in two places has two rows for a pair, and gets both back
                    yield merged()
                    held = []
                now, sizes, ids = part.as_py(), np.array(sizes.as_py(), np.int64), _unpacked(data.as_py())
                each = _pairs(ids, _befores(ids, sizes, size), size)
                pairs, every = np.unique(each, return_counts=True)
                of_target, counts = np.unique(each[np.repeat(np.array(chosen.as_py(), bool), sizes)], return_counts=True)
                target = np.zeros(len(pairs), np.int64)
                target[np.searchsorted(pairs, of_target)] = counts
                held.append((pairs, target, every))
        if held:
            yield merged()

    pair = Window.partitionBy("pair")
    return (chunks.select("part", "sizes", "chosen", "ids").mapInArrow(named, "part long, pair long, target long, every long")
            .select("part", "pair", *(F.sum(n).over(pair).alias(n) for n in ("target", "every"))))


@dataclass
class Model:
    size: int
    counts: np.ndarray          # of ids and contexts: [target or background, place]
    totals: np.ndarray
    scale: np.ndarray           # of the counts

    @classmethod
    def of(cls, counts: np.ndarray, size: int) -> Model:
        totals = counts[:, :size].sum(axis=1).astype(np.float64)
        scale = np.array([1.0, totals[0] / totals[1] if totals[0] and totals[1] else 1.0])
        return cls(size, counts * scale[:, None], totals * scale, scale)

    def losses(self, ids: np.ndarray, before: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """The loss of each id in nats, under the target and the background
        model; ``pairs`` has the counts of its pair in the target and in all."""
        one = (self.counts[:, ids] + EXTRA) / (self.totals[:, None] + EXTRA * self.size)
        two = (pairs * self.scale[:, None] + PAIR_WEIGHT * one) / (self.counts[:, self.size + 1 + before] + PAIR_WEIGHT)
        return -np.log(two)


def score_documents(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
                    tokenizer: str = "byte_bpe_50k", step: int = STEP) -> DataFrame:
    """Cross-entropy difference of every document.

    ``target`` holds the keys of the documents that the target model is counted
    on. Returns one row per input row: ``key``, ``n_tokens``, ``loss_target``
    and ``loss_background`` (mean per token, in nats) and ``difference``, the
    first less the second: the lower, the more the document is like the target.

    A null or empty text has no token and null losses. Null keys are in no
    target; repeated rows count and are scored one by one; repeated or null
    target keys change nothing. With no target document all differences tell
    only of smoothing. Other columns are ignored; an empty table gives an empty
    result.
    """
    good = target.select(F.col(target.columns[0]).alias("__good")).where("__good is not null").distinct()
    body = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # the plan is the same at every size: labels grow with the corpus, so they are never sent whole to all tasks
    marked = (body.join(good.hint("merge"), F.col("key") == F.col("__good"), "left")
              .select("key", "text", F.col("__good").isNotNull().alias("chosen")))
    size = vocabulary(tokenizer)
    chunks = cut(_chunks(marked, tokenizer, step))
    model = docs.sparkSession.sparkContext.broadcast(Model.of(count_ids(chunks, size), size))
    schema = body.select("key").schema.add("n_tokens", "long")
    for name in ("loss_target", "loss_background", "difference"):
        schema = schema.add(name, "double")
    arrow = to_arrow_schema(schema)

    def scored(own: pa.Table, sums: pa.Table) -> pa.Table:
        """One group of chunks with the sums of its pairs."""
        pairs, *sums = (sums[n].to_numpy() for n in ("pair", "target", "every"))
        order = np.argsort(pairs)
        pairs, sums = pairs[order], np.array(sums)[:, order]
        done = []
        for keys, sizes, data in zip(*(own[n] for n in ("keys", "sizes", "ids"))):
            sizes, ids = np.array(sizes.as_py(), np.int64), _unpacked(data.as_py())
            before = _befores(ids, sizes, size)
            mean = np.full((2, len(sizes)), np.nan)
            some = sizes > 0
            if some.any():
                counts = sums[:, np.searchsorted(pairs, _pairs(ids, before, size))]
                starts = (np.cumsum(sizes) - sizes)[some]
                mean[:, some] = np.add.reduceat(model.value.losses(ids, before, counts), starts, axis=1) / sizes[some]
            done.append(pa.RecordBatch.from_arrays(
                [pa.array(keys.as_py(), arrow[0].type), pa.array(sizes), *(pa.array(x, from_pandas=True) for x in (*mean, mean[0] - mean[1]))],
                schema=arrow))
        return pa.Table.from_batches(done, arrow)

    return (chunks.select("part", "keys", "sizes", "ids").groupBy("part").cogroup(count_pairs(chunks, size).groupBy("part"))
            .applyInArrow(scored, schema).withColumnRenamed("key", key))
