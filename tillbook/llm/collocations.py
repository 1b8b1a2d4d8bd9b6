"""Phrase collocations by best-first branch-and-bound growth.

Phrases grow to the right, word by word, from their first word. No phrase that
begins with a word found ``f`` times scores above ``1000 n / f``: in the cut
after the first word, the phrase is at most as frequent as its rest. So the
words are the frontier, ordered by that bound, and are expanded in bands from
the highest bound down. A language is settled, and takes no part in the next
band, once the score of its last wanted survivor is above the bound of every
word that is left.

Texts are read once. Chunks of them are kept as codes of words, exchange their
different words for exact numbers and counts, and drop the words that are too
rare to be part of any phrase. A level of a band is then a pass over the chunks:
each counts the phrases whose beginnings are frequent, and the counts of all
chunks are added. Which phrases are frequent comes to the chunks as a bit table
of fixed size; a bit set by chance costs work, never a result. The phrases found
have bounds of their own, from the counts of their beginnings; those of the
highest bounds are settled first, and no others than may reach the last wanted
score: a pass counts their parts that begin with other words, and sees whether a
phrase always has the same neighbour, which decides what survives.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillbook.llm.common import bit_table, cut

#: Words of a phrase.
LONGEST = 5
#: A band holds words up to so many times as frequent as its rarest.
BAND = 64
#: Words that a task gathers, in all languages, before it writes its chunks.
CHUNK_WORDS = 1 << 21
#: Bits of the tables of frequent phrases.
BITS = 24
#: Settled languages that are left out of further bands; any others only cost work.
SETTLED = 1000

_BREAK = b"."
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else 0x2E if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in range(256))
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
# phrases' bits: the words' numbers modulo a prime below 2^31, times these, modulo the prime
_FACTORS = (1_103_515_245, 1_664_525_107, 1_299_709_021, 1_540_483_477, 1_812_433_253)
_PRIME = 2_147_483_629

_CHUNK = "chunk long, lang string, codes binary, words array<binary>, counts array<long>"
_CODED = "chunk long, lang string, codes binary, ids binary, freqs binary"


class _Codes(dict):
    """Numbers from 1 in the order of appearance; 0 for the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def read_chunks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Chunks of documents of one language: their words as codes (0 between
    pieces), the words themselves by code from 1, and their counts."""

    def write(number: int, name: str, codes: _Codes, parts: list[np.ndarray]) -> list:
        all_codes = np.concatenate(parts)
        counts = np.bincount(all_codes, minlength=len(codes))
        return [number, name, zlib.compress(all_codes.tobytes(), 1), list(codes)[1:], counts[1:]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [write(number + n, name, *held[name]) for n, name in enumerate(held)]
            types = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["chunk", "lang", "codes", "words", "counts"])

        for batch in batches:
            for body, name in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                words = body.translate(_SPLIT).replace(_BREAK, b" . ").split()
                codes, parts = held.setdefault(name, (_Codes({_BREAK: 0}), []))
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                parts.append(np.zeros(1, np.int32))
                size += len(parts[-2])
                if size > CHUNK_WORDS:
                    yield flush()
                    number += len(held)
                    held, size = {}, 0
        if held:
            yield flush()

    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(lang).cast("string"), F.lit("und")))
    return texts.mapInArrow(run, _CHUNK)


def number_words(chunks: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``(id, lang, word, f)`` of the words found at least ``least`` times in
    their language, with ids from 1, and ``(lang, n)``."""
    n = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    pairs = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", "x.words", "x.counts")
    freqs = pairs.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).where(F.col("f") >= least)
    return cut(freqs.select((F.monotonically_increasing_id() + 1).alias("id"), "lang", "word", "f")), cut(n.where("n > 0"))


def code_chunks(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """The chunks with the words that have a number: ``codes`` (0 for all else)
    index ``ids`` and ``freqs``."""
    local = chunks.select("chunk", "lang", F.posexplode("words").alias("at", "word"))
    # every word of a chunk gets an answer, so that rows grow with the chunks and not with the words that turn frequent
    answer = F.when(F.col("id").isNotNull(), F.struct((F.col("at") + 1).alias("at"), "id", "f"))
    known = local.join(words, ["lang", "word"], "left").groupBy(F.col("chunk").alias("of")).agg(F.collect_list(answer).alias("known"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known_of = batch.column("known")
            for i, (number, lang, codes, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("chunk", "lang", "codes", "size")))):
                at, ids, freqs = (known_of[i].values.field(c).to_numpy().astype(np.int64) for c in ("at", "id", "f"))
                new = np.zeros(size + 1, np.int32)
                new[at] = np.arange(1, len(at) + 1)
                codes = new[np.frombuffer(zlib.decompress(codes), np.int32)]
                alone = codes > 0               # a word between rare ones or ends of pieces is no part of a phrase
                alone[1:] &= codes[:-1] == 0
                alone[:-1] &= codes[1:] == 0
                codes[alone] = 0
                codes = np.append(codes[(codes > 0) | (np.append(codes[1:], 0) > 0)], 0).astype(np.int32)
                blobs = [zlib.compress(codes.tobytes(), 1), np.append(0, ids).tobytes(), np.append(0, freqs).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([lang]), *(pa.array([b], pa.binary()) for b in blobs)],
                                                 names=["chunk", "lang", "codes", "ids", "freqs"])

    joined = chunks.select("chunk", "lang", "codes", F.size("words").alias("size")).join(known, F.col("chunk") == F.col("of")).drop("of")
    return cut(joined.mapInArrow(run, _CODED))


class _Chunk:
    """A coded chunk: the bits and the exact counts of the phrases in it."""

    def __init__(self, codes: bytes, ids: bytes, freqs: bytes):
        self.codes = np.frombuffer(zlib.decompress(codes), np.int32)
        self.ids, self.freqs = np.frombuffer(ids, np.int64), np.frombuffer(freqs, np.int64)

    def begins(self, size: int, at: np.ndarray) -> np.ndarray:
        """Those of the places at which a phrase of ``size`` words may begin."""
        at = at[at <= len(self.codes) - size]
        for i in range(size):
            at = at[self.codes[at + i] > 0]
        return at

    def bits(self, size: int, at: np.ndarray) -> np.ndarray:
        each = [(self.ids % _PRIME * _FACTORS[i]) % _PRIME for i in range(size)]
        return sum(each[i][self.codes[at + i]] for i in range(size)) & ((1 << BITS) - 1)

    def groups(self, size: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases of ``size`` words at ``at``: where one of each kind is, and the kind of each."""
        kind = self.codes[at].astype(np.int64)
        first = np.zeros(0, np.int64)
        for i in range(1, size):
            _, first, kind = np.unique(kind * len(self.ids) + self.codes[at + i], return_index=True, return_inverse=True)
        return first, kind

    def words(self, size: int, at: np.ndarray) -> list[np.ndarray]:
        return [self.ids[self.codes[at + i]] for i in range(size)]


_DECIMALS = "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(17,0))"


def bit_of(size: int):
    """The bit of a phrase, as in ``_Chunk.bits``."""
    total = F.lit(0).cast("long")
    for i in range(size):
        total = total + (F.col(_WORDS[i]) % F.lit(_PRIME) * F.lit(_FACTORS[i])) % F.lit(_PRIME)
    return total.bitwiseAND(F.lit((1 << BITS) - 1))


def _over(coded: DataFrame, names: list[str], work: Callable[[_Chunk], Iterator[list[np.ndarray]]]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in zip(*(batch.column(c).to_pylist() for c in ("codes", "ids", "freqs"))):
                for columns in work(_Chunk(*parts)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return coded.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def count_level(coded: DataFrame, size: int, low: int, high: int, table: bytes | None, least: int) -> DataFrame:
    """The phrases of ``size`` words found at least ``least`` times whose first
    word is found ``low`` to ``high - 1`` times. ``table`` has the bits of the
    frequent phrases one word shorter with first words up to ``high - 1``."""
    shared = coded.sparkSession.sparkContext.broadcast(table)

    def work(chunk: _Chunk) -> Iterator[list[np.ndarray]]:
        first = chunk.freqs[chunk.codes]
        at = chunk.begins(size, np.flatnonzero((first >= low) & (first < high)))
        if size > 2:
            known = np.frombuffer(shared.value, np.uint8)
            hit = lambda bit: (known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
            at = at[hit(chunk.bits(size - 1, at))]
            at = at[(first[at + 1] >= high) | hit(chunk.bits(size - 1, at + 1))]
        one, kind = chunk.groups(size, at)
        yield [*chunk.words(size, at[one]), np.bincount(kind, minlength=len(one))]

    names = _WORDS[:size]
    partial = _over(coded, [*names, "a"], work)
    return cut(partial.groupBy(*names).agg(F.sum("a").alias("a")).where(F.col("a") >= least))


def count_parts(coded: DataFrame, tables: dict[int, bytes]) -> DataFrame:
    """Counts of the phrases of 2 to 4 words whose bits are set, from any first
    word: ``(w1..w4, f, alike)``, where ``alike`` says that all are preceded, or
    all followed, by one and the same word."""
    sizes = sorted(tables)
    shared = coded.sparkSession.sparkContext.broadcast(tables)
    most = LONGEST - 1
    names = [*_WORDS[:most], "f", "p0", "p1", "n0", "n1"]

    def work(chunk: _Chunk) -> Iterator[list[np.ndarray]]:
        by_place = chunk.ids[chunk.codes]
        before, after = np.append(0, by_place[:-1]), np.append(by_place[1:], 0)
        for size in sizes:
            known = np.frombuffer(shared.value[size], np.uint8)
            at = chunk.begins(size, np.flatnonzero(chunk.codes))
            bit = chunk.bits(size, at)
            at = at[(known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0]
            one, kind = chunk.groups(size, at)
            order = np.argsort(kind, kind="stable")
            begins = np.searchsorted(kind[order], np.arange(len(one)))
            ends = []
            for side in (before[at][order], after[at + size - 1][order]):
                ends += [np.minimum.reduceat(side, begins), np.maximum.reduceat(side, begins)] if len(one) else [side, side]
            none = np.zeros(len(one), np.int64)
            yield [*chunk.words(size, at[one]), *([none] * (most - size)), np.bincount(kind, minlength=len(one)), *ends]

    same = lambda a, b: (F.min(a) == F.max(b)) & (F.min(a) > 0)
    return (_over(coded, names, work).groupBy(*names[:most])
            .agg(F.sum("f").alias("f"), (same("p0", "p1") | same("n0", "n1")).alias("alike")))


def expand(coded: DataFrame, words: DataFrame, sizes: DataFrame, tables: dict[int, bytes], low: int, high: int, least: int) -> DataFrame:
    """All phrases whose first word is found ``low`` to ``high - 1`` times:
    ``(lang, n, w1..w5, a, bound)``, unused words 0, with a bound of the score
    from the phrase's beginnings and its last word, which is the score itself for
    two words. ``tables`` collects the bits of frequent phrases by size over the
    bands."""
    one = words.select(F.col("id").alias("w1"), "lang", F.col("f").alias("f1")).join(sizes, "lang")
    last = words.select(F.col("id").alias("of"), F.col("f").alias("f_last"))
    score = F.expr(f"{_DECIMALS} div (CAST(before AS DECIMAL(18,0)) * CAST(f_last AS DECIMAL(18,0)))")
    found, shorter = [], words.select(F.col("id").alias("w1"), F.col("f").alias("before"))
    for size in range(2, LONGEST + 1):
        level = count_level(coded, size, low, high, tables.get(size - 1), least)
        bits = np.frombuffer(bit_table(level.select(bit_of(size).alias("bit")), BITS), np.uint8)
        tables[size] = (bits | np.frombuffer(tables.get(size, bytes(len(bits))), np.uint8)).tobytes()
        bound = level.join(shorter, _WORDS[:size - 1]).join(last, F.col(_WORDS[size - 1]) == F.col("of")).join(one, "w1")
        found.append(bound.select("lang", "n", *_WORDS[:size], *(F.lit(0).cast("long").alias(w) for w in _WORDS[size:]), "a",
                                  F.least(score, F.expr("CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(18,0)) div f1")).alias("bound")))
        if not bits.any():
            break
        shorter = level.select(*_WORDS[:size], F.col("a").alias("before"))
    return cut(reduce(DataFrame.unionByName, found))


def settle(coded: DataFrame, words: DataFrame, found: DataFrame) -> DataFrame:
    """The survivors among some of the phrases ``found``, scored: ``(lang,
    w1..w5, a, l, r, n, score)``."""
    length = F.size(F.filter(F.array(*_WORDS), lambda w: w > 0))
    # the parts of each phrase: its words from place i, j of them
    parts = F.expr(f"flatten(transform(sequence(1, {LONGEST - 1}), k -> array(struct(k, true AS left, 1 AS i, k AS j), struct(k, false AS left, k + 1 AS i, len - k AS j))))")
    pieces = (found.withColumn("len", length).select("lang", "n", *_WORDS, "a", "len", F.explode(parts).alias("p")).where("p.k < len")
              .select("lang", "n", *_WORDS, "a", F.col("p.k").alias("k"), F.col("p.left").alias("left"),
                      F.expr(f"slice(array({', '.join(_WORDS)}), p.i, p.j)").alias("part")))
    padded = [F.coalesce(F.get("part", F.lit(i)), F.lit(0).cast("long")).alias(f"q{i + 1}") for i in range(LONGEST - 1)]
    pieces = pieces.select("lang", "n", *_WORDS, "a", "k", "left", *padded)
    wanted = pieces.select(*(F.col(f"q{i}").alias(f"w{i}") for i in range(1, LONGEST))).unionAll(
        found.where("w5 = 0").select(*_WORDS[:-1])).where("w2 > 0").distinct()
    wanted = cut(wanted.withColumn("size", F.size(F.filter(F.array(*_WORDS[:-1]), lambda w: w > 0))))
    tables = {s: bit_table(wanted.where(F.col("size") == s).select(bit_of(s).alias("bit")), BITS) for s in range(2, LONGEST)}
    counts = cut(count_parts(coded, {s: b for s, b in tables.items() if any(b)}).join(wanted.drop("size"), _WORDS[:-1], "left_semi"))
    freq = counts.select(*_WORDS[:-1], "f").unionAll(words.select(F.col("id").alias("w1"), *(F.lit(0).cast("long").alias(w) for w in _WORDS[1:-1]), "f"))
    freq = freq.select(*(F.col(f"w{i}").alias(f"q{i}") for i in range(1, LONGEST)), "f")
    score = F.expr(f"{_DECIMALS} div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    best = (pieces.join(freq, [f"q{i}" for i in range(1, LONGEST)]).groupBy("lang", "n", *_WORDS, "a", "k")
            .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
            .withColumn("score", score).groupBy("lang", *_WORDS, "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    alike = counts.where("alike").select(*_WORDS[:-1], F.lit(0).cast("long").alias("w5"))
    return best.join(alike, _WORDS, "left_anti").select("lang", *_WORDS, "a", "best.l", "best.r", "n", "best.score")


def _last(survivors: DataFrame, top: int) -> DataFrame:
    """``(lang, rank, score)`` of each language's last wanted survivor so far."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    return (survivors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .groupBy("lang").agg(F.max("rank").alias("rank"), F.min("score").alias("score")))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000, band: int = BAND) -> DataFrame:
    """The first ``top`` phrases of each language: ``(lang, rank, phrase, a, l,
    r, n, score)`` by score and then ``a`` descending, then phrase ascending.

    Texts are lower-cased (A-Z) and split at ``. , ; : ! ?`` and the characters
    10 to 13 into pieces, these at spaces and tabs into words. ``n`` counts a
    language's words, ``a`` a phrase of 2 to 5 words within pieces (``least`` or
    more). Its score is the lowest ``floor(1000 a n / (l r))`` of its cuts into a
    first part found ``l`` times and a rest found ``r`` times, the earliest cut if
    several are lowest. A phrase inside a longer one found as often is left out.

    A null text is empty and a null language is ``und``. Every row counts,
    repeated ones too. Other columns are ignored. A language without such a
    phrase gives no row; an empty table gives an empty result. ``band`` decides
    how much is expanded at a time, not the result.
    """
    spark = docs.sparkSession
    chunks = cut(read_chunks(docs, text, lang))
    words, sizes = number_words(chunks, least)
    coded = code_chunks(chunks, words)
    schema = f"lang string, {', '.join(f'{w} long' for w in _WORDS)}, a long, l long, r long, n long, score long"
    survivors = spark.createDataFrame([], schema)
    tables: dict[int, bytes] = {}
    low = least
    while True:
        left = words.where(F.col("f") >= low).groupBy("lang").agg(F.min("f").alias("next")).join(sizes, "lang")
        bound = F.expr("CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(18,0)) div next")
        frontier = left.join(_last(survivors, top), "lang", "left").withColumn("settled", (F.col("rank") >= top) & (F.col("score") > bound))
        state = cut(frontier.select("lang", "n", "next", F.coalesce("settled", F.lit(False)).alias("settled")))
        begin = state.where("NOT settled").agg(F.min("next")).first()[0]
        if begin is None:
            break
        done = [r["lang"] for r in state.where("settled").orderBy(F.desc("n")).limit(SETTLED).collect()]
        active = coded.where(~F.col("lang").isin(done)) if done else coded
        low = begin * band
        rest, most = expand(active, words, sizes, tables, begin, low, least), 2 * top
        while True:                  # the phrases of the highest bounds, until no bound reaches the last wanted score
            rest = rest.join(_last(survivors, top).where(F.col("rank") >= top).select("lang", "score"), "lang", "left").where(
                F.col("score").isNull() | (F.col("bound") >= F.col("score"))).drop("score")
            batch = cut(rest.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("bound"))))
                        .where(F.col("place") <= most).drop("place"))
            if batch.isEmpty():
                break
            best = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score")))
            survivors = cut(survivors.unionByName(settle(active, words, batch)).withColumn("rank", best).where(F.col("rank") <= top).drop("rank"))
            rest, most = cut(rest.join(batch.select(_WORDS), _WORDS, "left_anti")), 2 * most
    named = survivors
    for w in _WORDS:
        named = named.join(words.select(F.col("id").alias(w), F.col("word").cast("string").alias(f"{w}_name")), w, "left")
    phrase = F.concat_ws(" ", *(f"{w}_name" for w in _WORDS))
    full = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (named.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(full).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
