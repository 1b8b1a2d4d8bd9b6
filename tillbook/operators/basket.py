"""Co-occurrence counts ("bought together") without a row per pair.

For every group (order) and every two of its items a < b, one is counted for
(label of a, label of b), times the rows that each item has in the group:

1. equal (group, item, label) rows are combined;
2. a group's rows meet once, in item order: item b adds the counts of the labels
   seen before it, so the work follows the labels that the group has. A task
   keeps the label counts of one group and a buffer of label pairs, which goes
   downstream as partial sums whenever it is full;
3. a group with more than ``block`` items is cut into blocks by a hash of the
   item, and each pair of blocks is a group of its own for step 2, in which only
   items of different blocks (or, for a block by itself, of that block) are
   counted. So the items of a huge group are spread over many tasks, and no
   count is lost;
4. one aggregate adds the partial sums.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 10_000
BUFFER = 200_000


def pair_counts(df: DataFrame, group: str, item: str, label: str, block: int = BLOCK, buffer: int = BUFFER) -> DataFrame:
    """Rows (label_a, label_b, pairs): number of (a, b) row pairs in a common
    group with item(a) < item(b), by the labels of a and b. Rows with a NULL
    group or item pair with nothing; a NULL label is a label."""
    weighted = (df.select(F.col(group).alias("g"), F.col(item).alias("x"), F.col(label).cast("string").alias("label"))
                .dropna(subset=["g", "x"]).groupBy("g", "x", "label").agg(F.count(F.lit(1)).alias("m")))
    large = (weighted.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
             .select(F.col("g").alias("of"), F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    blocked = (weighted.join(large, weighted["g"] == large["of"], "left")
               .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
               .withColumn("mine", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("g", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "x", "label", "m",
                       (F.col("mine") < F.col("other")).alias("first")))
    partial = (blocked.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "x")
               .mapInArrow(lambda batches: _scan(batches, buffer), "label_a string, label_b string, pairs long"))
    return partial.groupBy("label_a", "label_b").agg(F.sum("pairs").alias("pairs"))


def _scan(batches: Iterable[pa.RecordBatch], buffer: int) -> Iterator[pa.RecordBatch]:
    """Label pairs of rows sorted by (group, block pair, item)."""
    totals: dict[tuple, int] = defaultdict(int)
    # of the open group: the labels of smaller items for each side, and the rows of the current item
    key, seen, pending, current = None, ({}, {}), [], None

    def settle() -> None:
        for lab, m, side in pending:
            seen[side][lab] = seen[side].get(lab, 0) + m
        pending.clear()

    for batch in batches:
        for g, i, j, x, lab, m, first in zip(*(batch.column(c).to_pylist() for c in ("g", "i", "j", "x", "label", "m", "first"))):
            if (g, i, j) != key:
                key, seen, current = (g, i, j), ({}, {}), x
                pending.clear()
            elif x != current:
                settle()
                current = x
            side = 0 if i == j else int(first)
            for before, n in seen[side if i == j else 1 - side].items():
                totals[before, lab] += n * m
            pending.append((lab, m, side))
            if len(totals) > buffer:
                yield _rows(totals)
                totals.clear()
    if totals:
        yield _rows(totals)


def _rows(totals: dict[tuple, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in totals], pa.string()), pa.array([k[1] for k in totals], pa.string()),
                                       pa.array(totals.values(), pa.int64())], names=["label_a", "label_b", "pairs"])
