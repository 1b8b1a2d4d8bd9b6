"""Language identification by the nearest centroid.

A text is a TF-IDF vector of hashed byte pairs and triples of its lower-cased
letters. For each language, a bounded sample of labelled documents is clustered
by cosine into a few centroids; a text gets the language of its nearest
centroid, and is rejected if its cosine is under a share of a low quantile of
those that texts of the language with about as many terms have: documents that
were held back from clustering, and their beginnings of a few words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillbook.llm.common import cut

#: Dimensions of a vector, as a power of two.
BITS = 13
CENTROIDS = 4
#: Documents that a language is learned from at most; they are those with the lowest hashes of their keys.
SAMPLE = 1000
#: A text is rejected under this share of the ``QUANTILE`` of the cosines of held-back texts of its size.
REJECT = 0.3
#: The same for short texts, whose cosine depends on a few words: those of fewer different terms than this.
REJECT_SHORT = 0.2
SHORT_TERMS = 128
QUANTILE = 0.01
#: One more document is held back for so many that are learned from.
HELD_BACK = 4
#: Words of the beginnings of held-back documents.
BEGINNINGS = (1, 2, 4, 8, 16, 32, 64)
#: Sizes are told apart by numbers of different terms, from each of these on.
SIZES = np.array([16, 32, 64, 128, 256, 512])
#: Texts of fewer different terms are near to nothing; a language that has longer ones is not learned from them.
FEW_TERMS = 64
#: Bytes that the centroids of all languages may take.
MODEL_BYTES = 256 << 20

_NO_WORD = re.compile(rb"[^\x09-\x0d\x20]*[0-9@][^\x09-\x0d\x20]*")
#: ASCII letters in lower case and all other bytes as they are; ASCII without letters becomes white space.
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions that a text has and their counts. Words with digits, such
    as numbers and keys, are left out, unless the text has no others."""
    body = text.lower().encode("utf-8", "replace")
    words = _NO_WORD.sub(b" ", body).translate(_LETTERS).split() or body.translate(_LETTERS).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    shift = np.uint32(32 - BITS)
    pair = (b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)) >> shift
    triple = (b[:-2] * np.uint32(0xC2B2AE3D) + b[1:-1] * np.uint32(0x27D4EB2F) + b[2:] * np.uint32(0x165667B1)) >> shift
    counts = np.bincount(pair, minlength=1 << BITS) + np.bincount(triple, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A unit vector of (1 + log count) x idf; zero stays zero."""
    value = (1 + np.log(counts)) * idf
    norm = np.sqrt((value * value).sum())
    return value / norm if norm else value


@dataclass
class Model:
    languages: list[str]        # of each centroid
    centroids: np.ndarray       # float32 [dimension, centroid]
    limits: np.ndarray          # cosine under which a text is rejected [size, centroid]
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine to the nearest centroid, and whether it is rejected."""
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        at, counts = term_counts(text)
        cosine = weighted(counts, self.idf[at]) @ self.centroids[at]
        best = int(cosine.argmax())
        score = min(1.0, max(0.0, float(cosine[best])))
        return self.languages[best], score, bool(score < self.limits[np.searchsorted(SIZES, len(at), "right"), best])


def clusters(rows: np.ndarray, count: int, turns: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows: centroids and the lowest cosine of each.

    Begins with the row nearest to the mean, then the row farthest from those
    chosen, so the result depends on the rows alone.
    """
    centre = rows[[int((rows @ rows.mean(axis=0)).argmax())]]
    while len(centre) < min(count, len(rows)):
        nearest = (rows @ centre.T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        centre = np.vstack([centre, rows[int(nearest.argmin())]])
    for _ in range(turns):
        own = (rows @ centre.T).argmax(axis=1)
        sums = np.vstack([rows[own == c].sum(axis=0) if (own == c).any() else centre[c] for c in range(len(centre))])
        moved = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
        if np.allclose(moved, centre):
            break
        centre = moved
    cosine = rows @ centre.T
    own = cosine.argmax(axis=1)
    return centre, np.array([cosine[own == c, c].min(initial=1.0) for c in range(len(centre))])


def size_limits(sizes: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """The cosine under which a text of each size is rejected, from held-back
    texts' numbers of terms and cosines. A size without any takes the next
    smaller one's limit; under the smallest with any, nothing is rejected."""
    of = np.searchsorted(SIZES, sizes, "right")
    out = np.zeros(len(SIZES) + 1)
    for n in range(len(out)):
        own = cosines[of == n]
        share = REJECT if n and SIZES[n - 1] >= SHORT_TERMS else REJECT_SHORT
        out[n] = share * np.quantile(own, QUANTILE) if len(own) else out[n - 1] if n else 0.0
    return out


def learn(docs: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE, count: int = CENTROIDS) -> Model:
    """Centroids of every language in the rows where ``usable`` holds and
    neither the text nor the language is null. At most ``sample`` documents of a
    language are learned from, those whose keys have the lowest hashes, but for
    every fifth, which is held back to find the limits of rejection."""
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull())
    most = max(1, MODEL_BYTES // (count * 4 << BITS))
    found = rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    sizes = {r["lang"]: r["n"] for r in found.collect()}
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SIZES) + 1, 0)), np.ones(1 << BITS))
    # a little over the sample by a limit on the hash, then exactly the lowest
    chance = F.element_at(F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 2 * sample / n)))), F.col(lang))
    place = F.xxhash64(F.lit("sample"), F.col(key).cast("string"))
    some = (rows.select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"), place.alias("place"), F.xxhash64(text).alias("tie"))
            .where(F.pmod("place", F.lit(1 << 20)) < chance * (1 << 20)))
    lowest = Window.partitionBy("lang").orderBy("place", "tie")
    chosen = (some.withColumn("n", F.row_number().over(lowest)).where(F.col("n") <= sample + sample // HELD_BACK)
              .select("lang", "text", (F.col("n") % (HELD_BACK + 1) == 0).alias("held")))

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for own, body, held in zip(*(c.to_pylist() for c in batch.columns)):
                words = body.split(maxsplit=BEGINNINGS[-1]) if held else []
                pieces = [" ".join(words[:w]) for w in BEGINNINGS if w < len(words)]
                found += [(own, held, *term_counts(piece)) for piece in (*pieces, body) if has_letter(piece)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*found) if found else [[]] * 4,
                                                      (pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                names=["lang", "held", "at", "counts"])

    learned = cut(chosen.mapInArrow(vectors, "lang string, held boolean, at array<int>, counts array<int>"))
    used = learned.where("not held")
    total, having = used.count(), np.zeros(1 << BITS)
    for r in used.select(F.explode("at").alias("at")).groupBy("at").count().collect():   # one row per dimension
        having[r["at"]] = r["count"]
    idf = np.log((1 + total) / (1 + having)) + 1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        held, sizes = group["held"].to_numpy(bool), group["at"].map(len).to_numpy()
        used = ~held & (sizes >= FEW_TERMS)
        if not used.any():
            used = ~held
        dense = np.zeros((int(used.sum()), 1 << BITS), np.float32)
        for n, (at, counts) in enumerate(zip(group["at"][used], group["counts"][used])):
            dense[n, at] = weighted(np.asarray(counts), idf[at])
        centre, _ = clusters(dense, count)
        cosines = [(centre[:, at] @ weighted(np.asarray(counts), idf[at])).max() for at, counts in zip(group["at"][held], group["counts"][held])]
        limits = size_limits(sizes[held], np.array(cosines))
        return pd.DataFrame({"lang": group["lang"].iloc[0], "n": range(len(centre)), "centre": list(centre), "limits": [limits] * len(centre)})

    centres = learned.groupBy("lang").applyInPandas(cluster, "lang string, n int, centre array<float>, limits array<double>").collect()
    centres.sort(key=lambda r: (r["lang"], r["n"]))
    return Model([r["lang"] for r in centres], np.array([r["centre"] for r in centres], np.float32).reshape(-1, 1 << BITS).T.copy(),
                 np.array([r["limits"] for r in centres]).reshape(-1, len(SIZES) + 1).T.copy(), idf)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (``und`` if the text is null or has no
    letter), ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``
    (no language, or too far from its centroid). Columns of these names in
    ``docs`` are replaced. Only the text is looked at; no row is dropped."""
    docs = docs.drop("lang_pred", "score", "rejected")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column(text)]
            more = [pa.array([f[n] for f in found], t) for n, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, schema)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that are kept for testing: the CRC-32 of the key as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))
