"""Ranked lexical search by pipelined term partitioning.

The terms of the items belong to owners by their weight, the rarest first. The
items travel in bundles: one for each bundle of items and chunk of documents,
carrying a sparse accumulator of integers for each item and document. At every
stage a cogroup brings a bundle together with the postings that the stage's
owner holds for its terms in its chunk; their contributions are added, and the
bundle goes on to the next owner. After the last one each bundle gives its best
documents, from which the best of all chunks are chosen.

The rare terms come first because what the later owners can still add is known:
once an item has ``k`` documents in its chunk that the rest cannot reach, no
document is added any more, and those that fell behind are dropped. That never
changes a result.

Only a bit table of fixed size is broadcast: it says which terms may occur in
items, so that a document sends few others. Chunks and bundles are bounded,
hence also every group of a cogroup, however common a term is.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillbook.llm.common import bit_table, cut, skew_join

#: Documents, and about so many terms, of a chunk.
CHUNK_DOCS = 8192
CHUNK_TERMS = 1 << 21
#: Items of a bundle.
BUNDLE = 256
#: Bits of the table of terms that may occur in items.
TERM_BITS = 23
#: The least weight of the terms of each owner: found in at most a thousandth, a hundredth and a tenth of the documents, and all others.
OWNERS = (6900, 4600, 2300, 1)
#: No term adds as much as this times its weight.
SCALE = 1_000_000

_UPPER = range(ord("A"), ord("Z") + 1)
_TERM = bytes(c + 32 if c in _UPPER else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))

_INDEX = "chunk long, term binary, docs binary, freqs binary, absent binary, n_docs long, n_terms long"
_BUNDLE = ("bundle long, chunk long, ids binary, absent binary, lengths binary, later array<struct<slot:int,stage:int,weight:long>>, "
           "slots binary, docs binary, scores binary, closed binary")
_LATER = pa.list_(pa.struct([("slot", pa.int32()), ("stage", pa.int32()), ("weight", pa.int64())]))
_FOUND = "bundle long, slot int, id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.translate(_TERM).split() if text else []


def _binary(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


class _Codes(dict):
    """A number for each term that may occur in an item; -1 for the others."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table, self.terms = table, []

    def __missing__(self, term: bytes) -> int:
        code = -1
        if self.table[zlib.crc32(term) & (len(self.table) - 1)]:
            code = len(self.terms)
            self.terms.append(term)
        self[term] = code
        return code


class _Chunk:
    """Documents read one after the other, and the postings of their terms."""

    def __init__(self, number: int, table: np.ndarray, most: int):
        self.number, self.codes, self.most = number, _Codes(table), most
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.found: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        terms = terms_of(text)
        codes = np.fromiter(map(self.codes.__getitem__, terms), np.int64, len(terms))
        self.found.append(codes[codes >= 0] * self.most + len(self.ids))
        self.ids.append(doc_id)
        self.lengths.append(len(terms))

    def rows(self) -> pa.RecordBatch:
        lengths = np.array(self.lengths, np.int64)
        head = [self.number, None, np.array([i or 0 for i in self.ids], np.int64).tobytes(), lengths.tobytes(),
                np.array([i is None for i in self.ids], np.uint8).tobytes(), int((lengths > 0).sum()), int(lengths.sum())]
        out = [head]
        keys, freqs = np.unique(np.concatenate(self.found), return_counts=True)
        code, doc = keys // self.most, (keys % self.most).astype(np.uint16)
        begins = np.flatnonzero(np.diff(code, prepend=-1))
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)]):
            out.append([self.number, self.codes.terms[code[begin]], doc[begin:end].tobytes(),
                        freqs[begin:end].astype(np.uint32).tobytes(), None, end - begin, None])
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                          names=["chunk", "term", "docs", "freqs", "absent", "n_docs", "n_terms"])


def index_documents(docs: DataFrame, key: str, text: str, table: bytes, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Postings of the terms whose bit is set: one row for each chunk of
    documents and term (``docs``: places in the chunk, ``freqs``: how often), and
    one with a null term for each chunk (``docs``: keys, ``freqs``: numbers of terms)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")
        number = TaskContext.get().partitionId() << 33
        chunk, size = _Chunk(number, bits, chunk_docs), 0
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), _binary(batch.column(1))):
                chunk.add(doc_id, body)
                size += chunk.lengths[-1]
                if len(chunk.ids) == chunk_docs or size > CHUNK_TERMS:
                    yield chunk.rows()
                    number += 1
                    chunk, size = _Chunk(number, bits, chunk_docs), 0
        if chunk.ids:
            yield chunk.rows()

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, _INDEX)


def bundle_items(items: DataFrame, key: str, text: str, bundle: int = BUNDLE) -> DataFrame:
    """The items' terms, ``(bundle, slot, item, term, times, bit)``: each row of
    ``items`` has a slot of its own in a bundle."""
    schema = "bundle long, slot int, item long, term binary, times long, bit long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            rows = []
            for item, body in zip(batch.column(0).to_pylist(), _binary(batch.column(1))):
                for term, times in Counter(terms_of(body)).items():
                    rows.append((first + n // bundle, n % bundle, item, term, times, zlib.crc32(term) & ((1 << TERM_BITS) - 1)))
                n += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)],
                                             names=["bundle", "slot", "item", "term", "times", "bit"])

    return items.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def _owner_stage(stage: int, k: int, n_docs: int, n_terms: int, bundle: int):
    """The work of one owner: a bundle and the postings of its terms in, the bundle or, at the last owner, its best documents out."""
    last = stage == len(OWNERS) - 1

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        row = {name: column[0].as_py() for name, column in zip(bundles.column_names, bundles.columns)}
        ids, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
        m = 100 - 75 + (75 * lengths * n_docs) // n_terms
        score = np.zeros((bundle, len(ids)), np.int64)
        score[np.frombuffer(row["slots"], np.uint16), np.frombuffer(row["docs"], np.uint16)] = np.frombuffer(row["scores"], np.int64)
        closed = np.frombuffer(row["closed"], np.uint8).astype(bool)
        open_to = (score > 0) | ~closed[:, None]
        for docs, freqs, users in zip(*(postings.column(c).to_pylist() for c in ("docs", "freqs", "users"))):
            at, tf = np.frombuffer(docs, np.uint16), np.frombuffer(freqs, np.uint32).astype(np.int64)
            part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[at])
            for user in users:
                score[user["slot"], at] += user["weight"] * part
        score[~open_to] = 0
        later = np.zeros(bundle, np.int64)
        for x in row["later"]:
            later[x["slot"]] += x["weight"] * SCALE if x["stage"] > stage else 0
        if last:
            absent = np.frombuffer(row["absent"], np.uint8)
            rows = []
            for slot in np.flatnonzero(score.any(axis=1)).tolist():
                at = _best(score[slot], k)
                at = at[np.lexsort((ids[at], absent[at], -score[slot][at]))][:k]
                rows += [(row["bundle"], slot, None if absent[d] else int(ids[d]), int(score[slot, d])) for d in at.tolist()]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)],
                                        names=["bundle", "slot", "id", "score"])
        for slot in np.flatnonzero(score.any(axis=1)).tolist():
            own = score[slot]
            least = int(own[_best(own, k)].min()) if (own > 0).sum() >= k else 0
            if least > later[slot]:               # the rest cannot lift an unseen document among the best
                closed[slot] = True
                own[own + later[slot] < least] = 0
        slots, docs = np.nonzero(score)
        row |= {"slots": slots.astype(np.uint16).tobytes(), "docs": docs.astype(np.uint16).tobytes(),
                "scores": score[slots, docs].tobytes(), "closed": closed.astype(np.uint8).tobytes()}
        return pa.Table.from_pylist([row], schema=pa.schema([(f.name, _LATER if f.name == "later" else f.type) for f in bundles.schema]))

    return run


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores above 0 and of all that equal the lowest of them."""
    at = np.flatnonzero(scores)
    if len(at) <= k:
        return at
    least = np.partition(scores[at], len(at) - k)[len(at) - k]
    return at[scores[at] >= least]


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = 10, chunk_docs: int = CHUNK_DOCS, bundle: int = BUNDLE) -> DataFrame:
    """The ``k`` documents that score highest for each item: ``(item_key, rank,
    key, score)``, rank from 1, equal scores by ascending key.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z in
    lower case. A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))`` and a
    document's score the sum, over the item's terms with repeats, of the weight
    times ``10^9 tf div (1000 tf + 8 m)``, where ``m = 25 + 75 n N div L``: N
    documents have a term, L terms in all, n in the document. Only scores above 0
    count, so fewer rows than ``k`` are possible, and none for an item without
    terms (null, empty) or without a document that has one. ``chunk_docs`` (at
    most 65,536) and ``bundle`` bound what one task holds, not the result.

    Every row is a document or an item of its own, even if it repeats another
    one or has a null key (which comes last among equal scores). Other columns
    are ignored; empty tables give an empty result.
    """
    query = cut(bundle_items(items, item_key, item_text, bundle))
    index = cut(index_documents(docs, key, text, bit_table(query.select("bit"), TERM_BITS), chunk_docs))
    size = index.where("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = size["n"] or 0, size["l"] or 0
    df = index.where("term is not null").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    stage = sum((F.col("w") < least).cast("int") for least in OWNERS[:-1])
    weighed = cut(query.join(df, "term").withColumn("w", weight).where(F.col("w") >= OWNERS[-1])
                  .select("bundle", "slot", "term", stage.alias("stage"), (F.col("w") * F.col("times")).alias("weight")))
    users = weighed.groupBy("bundle", "stage", F.col("term").alias("of")).agg(F.collect_list(F.struct("slot", "weight")).alias("users"))
    routed = cut(skew_join(index.where("term is not null").select("chunk", "term", "docs", "freqs"), users, {"term": "of"})
                 .select("bundle", "chunk", "stage", "docs", "freqs", "users"))
    later = (weighed.groupBy("bundle", "slot", "stage").agg(F.sum("weight").alias("weight"))
             .groupBy("bundle").agg(F.collect_list(F.struct("slot", "stage", "weight")).alias("later")))
    nothing = F.lit(b"")
    bundles = (skew_join(routed.select("bundle", F.col("chunk").alias("of")).distinct(),
                         index.where("term is null").select("chunk", F.col("docs").alias("ids"), "absent", F.col("freqs").alias("lengths")), {"of": "chunk"})
               .join(later, "bundle")
               .select("bundle", "chunk", "ids", "absent", "lengths", "later", nothing.alias("slots"), nothing.alias("docs"),
                       nothing.alias("scores"), F.lit(bytes(bundle)).alias("closed")))
    for n in range(len(OWNERS)):
        owned = routed.where(F.col("stage") == n).select(
            F.col("bundle").alias("of_bundle"), F.col("chunk").alias("of_chunk"), "docs", "freqs", "users")
        bundles = (bundles.groupBy("bundle", "chunk").cogroup(owned.groupBy("of_bundle", "of_chunk"))
                   .applyInArrow(_owner_stage(n, k, n_docs, n_terms, bundle), _FOUND if n == len(OWNERS) - 1 else _BUNDLE))
    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = query.select("bundle", "slot", "item").distinct()
    return (best.join(names, ["bundle", "slot"])
            .select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score"))
