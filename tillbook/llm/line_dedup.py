"""Lines that many documents share, dropped from all but one of them.

Everything is DataFrame functions: the lines are exploded with their positions,
normalised and hashed to 128 bits; an aggregate counts the different documents
of each hash; the positions to drop go back to their document, whose other
lines are joined again in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import BLANKS, cut, lower_ascii, set_aside, skew_join


def line_key(line: Column) -> Column:
    """A line without space and control characters 9 to 13 at its ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20,
                 min_docs: int = 3) -> DataFrame:
    """The lines to drop: ``(id, text_hash, drop)``, one row for each document
    that loses lines, with the ascending positions (from 0) in ``drop``.

    ``text_hash`` is ``xxhash64`` of the text: rows that repeat a key with
    another text are told apart by it.
    """
    line = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"),
                       F.posexplode(F.split(text, "\n", -1)).alias("at", "line")).where("id is not null")
    hashed = cut(line.select("id", "text_hash", "at", line_key(F.col("line")).alias("k"))
                 .where(F.length("k") >= min_chars)
                 .select("id", "text_hash", "at", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2")))
    shared = (hashed.groupBy("h1", "h2").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
              .where(F.col("n") >= min_docs).select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), "keeper"))
    hit = skew_join(hashed, shared, {"h1": "s1", "h2": "s2"}).where("id <> keeper")
    return hit.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("drop"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20,
                min_docs: int = 3) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, and two more long
    columns ``n_lines`` (before dropping) and ``n_dropped``; columns of these
    names in ``docs`` are replaced.

    A line is shared if its key has at least ``min_chars`` code points and is
    found in at least ``min_docs`` documents; only the largest key among them
    keeps it, with all its repeats. A null or empty text is one empty line. A
    row with a null key is no document: it counts nowhere and loses nothing.
    Rows that repeat a key count as one document. A document may end up empty.
    No row is dropped.
    """
    drops = shared_lines(docs, key, text, min_chars, min_docs)
    rest, own = set_aside(docs.drop("n_lines", "n_dropped"), ["__hash", "__id", "__of", "__drop", "__lines"])
    names = [c for c in rest.columns]
    rest = rest.withColumn("__hash", F.xxhash64(text))
    joined = rest.join(drops.select(F.col("id").alias("__id"), F.col("text_hash").alias("__of"), F.col("drop").alias("__drop")),
                       (F.col(key) == F.col("__id")) & (F.col("__hash") == F.col("__of")), "left")
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    parts = joined.withColumn("__lines", lines)
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drop")
    kept = F.when(F.col("__drop").isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda at: F.element_at("__lines", at + 1)), "\n"))
    return parts.select(*(kept.alias(c) if c == text else F.col(c) for c in names),
                        F.size("__lines").cast("long").alias("n_lines"),
                        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped")).select(*own, "n_lines", "n_dropped")
