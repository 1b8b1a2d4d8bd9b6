"""File sources and sinks: listing, CSV dialects, the per-file copy job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.text import sanitize_name


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False,
               require: bool = False) -> DataFrame:
    """(path, file_name, size, modified) for every file; contents are not read.

    With ``require``, a folder without any matching file raises (the job must
    stop before copying, as when the listing step fails). Zero-length files
    are skipped by Spark's file scan, so they are never listed and never copied."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(folder).select("path", "length", "modificationTime")
    out = df.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    if require and not out.take(1):
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, header: bool = True,
             multiline: bool = False, mode: str = "PERMISSIVE", infer: bool = False, **options) -> DataFrame:
    """CSV with quoted fields that may hold quotes (doubled) and, with
    ``multiline``, line breaks; that reads each file in one task, so it is only
    for files that need it.

    An explicit schema is the default; ``infer=True`` runs the extra inference
    job and is meant for exploration. ``mode='FAILFAST'`` aborts on a bad row
    (like a bulk COPY)."""
    r = (spark.read.option("header", header).option("quote", '"').option("escape", '"')
         .option("multiLine", multiline).option("mode", mode))
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Blanks and hyphens in column names become underscores."""
    return df.withColumnsRenamed({c: sanitize_name(c) for c in df.columns if sanitize_name(c) != c})


def rename_strict(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; unlike withColumnsRenamed, a missing source column raises."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(mapping)


def copy_quote_all(spark: SparkSession, source_folder: str, target_folder: str, pattern: str = "*.csv",
                   prefix: str = "output_") -> DataFrame:
    """Copy every CSV file of a folder to ``<target>/_out=<prefix><name>/`` with
    every field quoted, keeping each file's own columns.

    One pass finds the header line of each file; files with the same header are
    copied together by one distributed job, so there are as many jobs as kinds
    of files, not as files. Each row keeps its source file name from the scan
    metadata; the writer partitions by the output name. A header takes one line.
    """
    list_files(spark, source_folder, pattern, require=True)
    lines = (spark.read.option("pathGlobFilter", pattern).text(source_folder)
             .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("at")).filter(F.col("start") == 0))
    kinds = (lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))      # one row per file
             .groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect())
    for n, kind in enumerate(kinds):
        rows = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
                .csv(kind["paths"]).withColumn("_out", F.concat(F.lit(prefix), F.col("_metadata.file_name"))))
        (rows.write.mode("append" if n else "overwrite").option("header", True).option("quoteAll", True).option("escape", '"')
         .partitionBy("_out").csv(target_folder))
    return list_files(spark, target_folder, "*.csv", recursive=True)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with header. ``single_file`` funnels through one task: small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
