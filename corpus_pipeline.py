"""A corpus pipeline of the operators in ``tillbook.llm``.

Each stage takes what its predecessor kept, as (spark, docs, sf_dir), and
returns the documents that stay, with their columns; the last one returns the
packed pieces instead. A stage works on any table with the columns of
``documents``; other columns stay as they are, whatever their names. Rows with a
null ``doc_id`` pass the filters like others, but SimHash keeps them all, as they
can't be told apart. Empty tables stay empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbook.llm.common import set_aside
from tillbook.llm.contain import decontaminate
from tillbook.llm.langid import held_out, identify, learn
from tillbook.llm.line_dedup import dedup_lines
from tillbook.llm.packing import pack_documents
from tillbook.llm.simhash import simhash_components
from tillbook.session import ensure_checkpoint_dir
from tillbook.sources.tables import load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier, learned from their labels, does
    not reject. A text that is null or has no letter is rejected; without any
    label all go. Ties between languages don't matter here."""
    model = learn(docs, ~held_out(F.col("doc_id")))
    rest, own = set_aside(docs, ["lang_pred", "score", "rejected"])
    return identify(rest, model).where(~F.col("rejected")).select(*own)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others share; ``n_chars`` is counted
    anew. A null text becomes an empty one; a row with a null key loses nothing."""
    rest, own = set_aside(docs, ["n_lines", "n_dropped"])
    return dedup_lines(rest).withColumn("n_chars", F.length("text").cast("long")).select(*own)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group. If rows repeat
    that id, one of each fingerprint stays: the text of the lowest hash, and of
    equal texts the row that is lowest in its other columns. Null and empty texts
    are a group. Rows with a null id all stay."""
    groups = simhash_components(docs, words=3, radius=2).where("doc_id = component_id")
    kept = (groups.groupBy(F.col("doc_id").alias("__kept"), "fingerprint").agg(F.min("text_hash").alias("__text_hash"))
            .drop("fingerprint"))
    rest, own = set_aside(docs, ["__kept", "__text_hash", "__row"])
    named = rest.join(kept, (F.col("doc_id") == F.col("__kept")) & (F.xxhash64("text") == F.col("__text_hash")))
    row = F.struct(*rest.columns)
    order = F.struct(*(f.name for f in rest.schema.fields if "map<" not in f.dataType.simpleString()))
    one = named.groupBy("__kept", "__text_hash").agg(F.min_by(row, order).alias("__row")).select("__row.*")
    return one.unionAll(rest.where("doc_id is null")).select(*own)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the table ``benchmark``; null and empty texts hold none."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of 2048 tokens. A null or
    empty text is its closing id alone; repeated rows are packed one by one."""
    return pack_documents(docs, capacity=2048, tokenizer="byte_bpe_50k")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Fingerprints, tokenizers and trained models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to the table ``documents``. Each stage
    but the last is written under the shared checkpoint folder and read again, so
    a lost executor costs a part of one stage."""
    docs = load(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
