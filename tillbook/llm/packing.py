"""Best-fit packing of tokenized documents, certified by lower bounds.

Every partition packs its pieces by best-fit decreasing and computes a lower
bound on its number of sequences from dual-feasible functions of the piece
lengths. A partition whose count is above its bound, be it by a fraction of a
sequence, has a gap: such partitions give up the pieces of their sequences with
free space, exchange them, and best-fit decreasing runs again on what was
exchanged, until the total meets the bound of the whole length histogram, one
partition holds all that is exchanged, or an exchange closes nothing.

Only lengths travel: a row is about 50 bytes, whatever the text. The histogram
has as many rows as a sequence has tokens.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tillbook.llm.common import cut

CAPACITY = 2048
#: Pieces that one task packs at a time, under a million.
PER_PARTITION = 65_536
#: Dual-feasible functions u(k) of Fekete and Schepers up to this k.
MOST_K = 100

#: How the tokenizer's expression ends, and what tells two white-space characters in a row.
BLANK_RUNS = r"|\s+(?!\S)|\s+"
_RUN = re.compile(r"\s\s")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _encoders(name: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding, Tokenizer, list[str]]:
    """Two libraries with the same vocabulary and merges: the first, with its
    usual expression and a faster one for texts without runs of white space, is
    several times as fast; the other also knows the special tokens' strings."""
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    slow = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    pattern = public_tokenizers.PATTERN
    # without a look ahead the expression is matched faster; it differs only for runs of white space
    assert pattern.endswith(BLANK_RUNS)
    fast, plain = (tiktoken.Encoding(name, pat_str=p, mergeable_ranks=ranks, special_tokens={})
                   for p in (pattern, pattern.removesuffix(BLANK_RUNS) + r"|\s+"))
    return fast, plain, slow, special


def token_ids(text: str | None, tokenizer: str) -> np.ndarray:
    """The ids of a whole text, without special tokens added, and the final 0."""
    fast, plain, slow, special = _encoders(tokenizer)
    text = text or ""
    if any(s in text for s in special):
        ids = slow.encode(text, add_special_tokens=False).ids
    else:
        ids = (fast if _RUN.search(text) else plain).encode_ordinary(text)
    return np.array([*ids, 0], dtype="<u4")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: whole
    sequences, but for the first piece, which takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenized_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``; the last
    is the CRC-32 of the piece's ids as unsigned 32-bit little-endian numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = token_ids(body.as_py(), tokenizer)
                rows += [(doc_id, n, start, length, zlib.crc32(ids[start:start + length].tobytes()))
                         for n, (start, length) in enumerate(cuts(len(ids), capacity))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, PIECES)


def lower_bound(counts: np.ndarray, capacity: int) -> float:
    """No packing of ``counts[n]`` pieces of length n has fewer sequences than
    this, rounded up. The largest of the bounds from dual-feasible functions:
    pieces under a limit count nothing, those over capacity - limit a whole
    sequence, and the others their length, or its rounding u(k)."""
    lengths = np.arange(capacity + 1)
    limit = np.arange(capacity // 2 + 1)
    above = np.cumsum(counts[::-1])[::-1]
    large = np.r_[above[1:], 0][capacity - limit]            # longer than capacity - limit
    best = 0.0
    for k in range(MOST_K + 1):
        if k == 0:
            value, unit = lengths, capacity
        else:
            scaled = (k + 1) * lengths
            value, unit = np.where(scaled % capacity, scaled // capacity * capacity, k * lengths), k * capacity
        sums = np.r_[0, np.cumsum(value * counts)]           # sums[n]: of the lengths below n
        middle = sums[capacity - limit + 1] - sums[limit]
        best = max(best, float(((unit * large + np.maximum(middle, 0)) / unit).max()))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the sequence and offset of each piece, and the
    tokens in each sequence. Ties go to the sequence that got its last piece last."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]   # sequences by their free space
    spaces = 0                                                   # bit n: some sequence has n free
    used: list[int] = []
    for row in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[row])
        fits = spaces >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            s = open_[space].pop()
            if not open_[space]:
                spaces &= ~(1 << space)
        else:
            s, space = len(used), capacity
            used.append(0)
        sequence[row], offset[row] = s, used[s]
        used[s] += n
        if space > n:
            open_[space - n].append(s)
            spaces |= 1 << (space - n)
    return sequence, offset, np.array(used, np.int64)


def _packed(pieces: DataFrame, capacity: int, partitions: int, turn: int) -> DataFrame:
    """``pieces`` dealt over ``partitions`` tasks and packed in each, with the
    sequence, the offset, the sequence's free space, and the task's gap: its
    number of sequences less its lower bound."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        lengths = table["length"].to_numpy()
        sequence, offset, used = best_fit(lengths, capacity)
        gap = len(used) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        first = (turn << 44) + (TaskContext.get().partitionId() << 20)
        for name, column in (("sequence_id", sequence + first), ("offset", offset), ("free", capacity - used[sequence]),
                             ("gap", np.full(len(lengths), gap))):
            table = table.append_column(name, pa.array(column))
        yield from table.to_batches()

    return cut(pieces.repartition(partitions).mapInArrow(
        run, f"{PIECES}, sequence_id long, offset long, free long, gap double"))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   tokenizer: str = "byte_bpe_50k", per_partition: int = PER_PARTITION) -> DataFrame:
    """The place of every document in as few sequences of at most ``capacity``
    tokens as best-fit decreasing finds.

    A document is its text's ids and a final id 0. Only a document longer than
    a sequence is cut: into whole sequences, but for its first piece. Returns
    one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, certified``. The pieces of a sequence follow each other from offset
    0 without gaps. ``certified``: the partition that made the sequence needed
    as many sequences as its lower bound.

    A null or empty text is a document of one token. Null keys and repeated
    rows are documents like others. Other columns are ignored. An empty table
    gives no sequences.
    """
    pieces = cut(tokenized_pieces(docs, key, text, capacity, tokenizer))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():       # as many rows as capacity at most
        histogram[row["length"]] = row["count"]
    least = math.ceil(lower_bound(histogram, capacity) - 1e-9)
    width = lambda rows: max(1, -(-rows // per_partition))
    partitions = width(int(histogram.sum()))
    placed = _packed(pieces, capacity, partitions, 0)
    total, turn = _sequences(placed), 0
    done: list[DataFrame] = []
    while total > least and partitions > 1:
        turn += 1
        giving = (F.col("gap") > 0) & (F.col("free") > 0)
        pool = placed.where(giving)
        before, fewer = _sequences(pool), width(pool.count())
        if fewer >= partitions:                                  # nothing was closed: the same mix again
            break
        again = _packed(pool.select(*pieces.columns), capacity, fewer, turn)
        saved = before - _sequences(again)
        if saved < 0:
            break
        done.append(placed.where(~giving))
        placed, total, partitions = again, total - saved, fewer
    for closed in done:
        placed = placed.unionAll(closed)
    return placed.select(F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                         (F.col("gap") < 1 - 1e-9).alias("certified"))


def _sequences(placed: DataFrame) -> int:
    return placed.where("offset = 0").count()


def packed_sequences(docs: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """The sequences of a plan of ``pack_documents``: ``(sequence_id, ids)``.
    ``key`` must name each document once. A sequence is bounded by its capacity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, n, ids[s:s + length].tolist())
                    for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1))
                    for ids in [token_ids(body.as_py(), tokenizer)] for n, (s, length) in enumerate(cuts(len(ids), capacity))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int32(), pa.list_(pa.int64())))],
                names=["of", "n", "ids"])

    ids = docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, "of long, n int, ids array<long>")
    rows = plan.join(ids, (F.col(key) == F.col("of")) & (F.col("piece") == F.col("n")))
    parts = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
