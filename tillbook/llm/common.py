"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.session import ensure_checkpoint_dir

#: The white space that separates words: space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the session's shared checkpoint folder,
    so that later stages neither recompute it nor lose it with an executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def split_runs(batches: Iterable[pa.RecordBatch], key: str, most: int) -> Iterator[tuple[bool, pa.Table]]:
    """Cut Arrow batches that are sorted by ``key`` into tables of whole runs.

    Yields ``(False, table)`` where every run of equal keys in ``table`` is
    complete and has at most ``most`` rows, give or take one batch, and
    ``(True, table)`` for pieces of longer runs, which are never held in memory.
    """
    held: list[pa.RecordBatch] = []
    rows, held_key, long_run = 0, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        others = (keys != keys[-1]).nonzero()[0]
        at = int(others[-1]) + 1 if len(others) else 0        # the last run begins here
        if long_run:                                         # the long run's rows at the front
            differs = (keys != held_key).nonzero()[0]
            front = int(differs[0]) if len(differs) else batch.num_rows
            if front:
                yield True, pa.Table.from_batches([batch.slice(0, front)])
            if front == batch.num_rows:
                continue
            long_run, at = False, max(at, front)
            if at > front:
                yield False, pa.Table.from_batches([batch.slice(front, at - front)])
            held, rows = [], 0
        elif at or (held and keys[-1] != held_key):
            done = [*held, *([batch.slice(0, at)] if at else [])]
            yield False, pa.Table.from_batches(done)
            held, rows = [], 0
        held.append(batch.slice(at))
        rows, held_key = rows + held[-1].num_rows, keys[-1]
        if rows > most:
            yield True, pa.Table.from_batches(held)
            held, rows, long_run = [], 0, True
    if held:
        yield False, pa.Table.from_batches(held)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the undirected graph of integer ``edges``.

    Returns ``(node, component)`` for every node that occurs in an edge between
    two different nodes; ``component`` is the smallest node reachable. Edges
    with a null end are ignored, repeated edges count once, and no edges give an
    empty result.

    Alternates large-star and small-star steps: each links the neighbours of a
    node to the smallest one, until the edges are stars around the smallest
    node of each component. Every step is a join and an aggregate over the
    edges; a node with very many edges is pre-aggregated on the map side, and the
    joins shuffle for themselves, so that its partition can be split where it is skewed.
    """
    edge = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    state = _state(edge)
    while state[0]:
        low = (edge.select(F.col("v").alias("n"), F.col("v").alias("m"))
               .unionAll(edge.select(F.col("u"), F.col("v"))).groupBy("n").agg(F.min("m").alias("low")))
        large = skew_join(edge, low, {"v": "n"}).select("u", F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (skew_join(large, least.withColumnRenamed("u", "n"), {"u": "n"})
                 .select(F.explode(F.array(F.struct("u", F.col("low").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u > v").distinct())
        edge = cut(small)
        before, state = state, _state(edge)
        if state == before:
            break
    nodes = edge.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edge: DataFrame) -> tuple[int, int | None]:
    """A number of edges and a checksum that does not depend on their order."""
    row = edge.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def tied_classes(rows: DataFrame, classes: DataFrame, key: str, of: list[str]) -> DataFrame:
    """Edges ``(node, low)`` from every ``key`` that occurs in rows of several
    classes to the nodes of these. ``of`` names a row's class; ``classes`` has a ``node`` for each."""
    several = (rows.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*of)).alias("a"), F.max(F.struct(*of)).alias("b"))
               .where("a <> b").select("__key"))
    of_several = rows.join(several, F.col(key) == F.col("__key")).select(F.col(key).alias("__key"), *of).distinct()
    return of_several.join(classes.select(*of, "node"), of).select(F.col("__key").alias("node"), F.col("node").alias("low"))


def set_aside(df: DataFrame, used: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with the columns that have one of the ``used`` names (in any case)
    renamed, and the columns that give it its own names back."""
    lower = {c.lower() for c in (*df.columns, *used)}
    taken, names = {u.lower() for u in used}, {}
    for c in df.columns:
        name = c
        while name.lower() in (taken if name == c else lower):
            name = f"_{name}_"
        lower.add(name.lower())
        names[c] = name
    return df.withColumnsRenamed({c: n for c, n in names.items() if c != n}), [F.col(n).alias(c) for c, n in names.items()]


def skew_join(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner") -> DataFrame:
    """Equi-join on ``{left column: right column}`` with both sides dealt anew.

    An aggregate leaves its result partitioned by its keys, and a join that
    reuses this partitioning can't split the partition of a very common key. A
    hash of the keys as one more join key makes Spark shuffle both sides for the
    join itself, which adaptive execution then splits where it is skewed.
    """
    deal_left = left.withColumn("__deal_l", F.xxhash64(*keys))
    deal_right = right.withColumn("__deal_r", F.xxhash64(*keys.values()))
    on = deal_left["__deal_l"] == deal_right["__deal_r"]
    for a, b in keys.items():
        on = on & (deal_left[a] == deal_right[b])
    return deal_left.join(deal_right, on, how).drop("__deal_l", "__deal_r")


def bit_table(numbers: DataFrame, bits: int) -> bytes:
    """A table of ``2 ** bits`` bits, lowest first in each byte, with those set
    that the one column of ``numbers`` (from 0) names. It is built where the rows
    are; the driver gets at most the whole table, whose size is fixed."""
    at = F.col(numbers.columns[0]) + 1
    rows = (numbers.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("part")).where("bucket is not null").collect())
    table = bytearray((1 << bits) // 8)
    for row in rows:
        begin = (row["bucket"] - 1) * 4096
        table[begin:begin + 4096] = row["part"]
    return bytes(table)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
