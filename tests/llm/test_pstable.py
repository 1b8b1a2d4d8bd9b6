import math

import numpy as np
import pandas as pd
import pytest

from tillbook.llm.pstable import near_vectors, sized
from tillbook.llm.queries import op5_embedding_dedup


def slow(rows, similarity=0.98):
    """rows: (id, vector, label); (id, links, component, kept) for each row."""
    def sound(i, v, label):
        return i is not None and label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v) / np.linalg.norm(v) if sound(i, v, label) else None for i, v, label in rows]
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] >= similarity or rows[a][1] == rows[b][1]:
                    links[a].append(b)
    low = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            same = [b for b in range(len(rows)) if b in links[a] or (rows[a][0] == rows[b][0] and unit[a] is not None and unit[b] is not None)]
            least = min([low[a], *(low[b] for b in same)]) if same else low[a]
            if least != low[a]:
                low[a], changed = least, True
    return sorted((repr(r[0]), len(links[n]), low[n], None if r[0] is None else r[0] == low[n]) for n, r in enumerate(rows))


def run(table, rows, kind="float", **more):
    frame = table([(i, v, label, 1, "x") for i, v, label in rows], f"vec_id long, embedding array<{kind}>, label int, node long, work string")
    return sorted((repr(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(frame, **more).collect())


def groups(rng, dim=16):
    rows, n = [], 0
    for label in (1, 2):
        for _ in range(12):
            base = rng.normal(size=dim)
            for _ in range(int(rng.integers(1, 12))):
                near = base + rng.normal(size=dim) * np.linalg.norm(base) * 0.03
                rows.append((n, np.float32(near).tolist(), label))
                n += 1
    return rows


@pytest.mark.parametrize("block", [2048, 3])
def test_matches_brute_force(table, block):
    rows = groups(np.random.default_rng(8))
    copies = [(1000 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 4)] * 1 + [(2000 + i, rows[4][1], rows[4][2]) for i in range(9)]
    assert run(table, rows + copies, block=block, tables=48) == slow(rows + copies)


def test_hard_rows(table):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [math.nan, 2.0, 3.0], 1),
            (6, [math.inf, 2.0, 3.0], 1), (7, v, None), (None, v, 1), (9, v, 1), (10, v, 1), (11, v, 2), (12, [2.0, 4.0, 6.0], 1),
            (13, [1.0, 2.0], 1), (13, [1.0, 2.0], 1), (14, [-1.0, -2.0, -3.0], 1), (15, [1e-30, 2e-30, 3e-30], 1)]
    assert run(table, rows) == slow(rows)
    doubles = [*rows, (16, [1e-300, 2e-300, 3e-300], 1), (17, [1e300, 2e300, 3e300], 1)]
    got = {r[0]: r for r in run(table, doubles, "double")}
    assert {got[str(i)][2] for i in (9, 10, 12, 15, 16, 17)} == {9} and got["17"][1] == 5
    assert run(table, []) == []


def test_recall_at_the_threshold(table):
    """Pairs with a cosine just over 0.98 are found nearly always; none below it is."""
    rng = np.random.default_rng(5)
    rows = []
    for n in range(600):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = 0.9803 if n % 2 else 0.9797
        rows += [(2 * n, a.tolist(), 1), (2 * n + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 1)]
    got = {int(i): n for i, n, _, _ in run(table, rows, "double")}
    assert sum(got[2 * n] for n in range(1, 600, 2)) >= 297
    assert not any(got[2 * n] for n in range(0, 600, 2))


def brute(rows):
    """n_links and component of pandas rows, by all cosines."""
    unit = np.vstack(rows["embedding"]).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = rows["label"].to_numpy()
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    low = rows["vec_id"].to_numpy()
    while True:
        least = np.minimum(low, np.where(near, low, low.max()).min(axis=1))
        if (least == low).all():
            return near.sum(axis=1).tolist(), low.tolist()
        low = least


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    links, low = brute(rows)
    got = op5_embedding_dedup(spark, sf).orderBy("vec_id").toPandas()
    assert got["n_links"].tolist() == links and got["component_id"].tolist() == low
    assert got["kept"].tolist() == (got["vec_id"] == low).tolist()


@pytest.mark.parametrize("size", [None, 1_000_000])
def test_recall_among_real_vectors(spark, table, size):
    """With the tables and hashes of ``size`` vectors; the table's vectors with copies and near copies of some, against all cosines."""
    rng = np.random.default_rng(11)
    base = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()
    more = base.sample(600, random_state=1, replace=True).reset_index(drop=True)
    noise = rng.normal(size=(600, 64)) * rng.uniform(0, 0.03, (600, 1)) / 8 ** 0.5
    more["embedding"] = list((np.vstack(more["embedding"]) + noise * (np.arange(600) % 5 > 0)[:, None]).astype(np.float32))
    more["vec_id"] = 1_000_000 + np.arange(600)
    rows = pd.concat([base, more], ignore_index=True)
    links, low = brute(rows)
    found = near_vectors(spark.createDataFrame(rows), **dict(zip(("tables", "hashes"), sized(size) if size else ()))).orderBy("vec_id").toPandas()
    assert sum(links) > 600
    assert abs(sum(links) - found["n_links"].sum()) <= 0.001 * sum(links)       # a recall of 0.999, where 0.9 is asked for
    assert (found["component_id"].to_numpy() == low).mean() > 0.999


def test_a_key_in_several_classes_joins_them(table):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = table([(3, "x", a), (5, "x", a), (5, "x", b), (9, "x", b), (10, "y", b)], "vec_id long, label string, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(rows).collect())
    assert got == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (9, 1, 3, False), (10, 0, 10, True)]


def test_strangers_stay_few():
    for n in (1, 100, 1 << 14, 10**6, 10**9):
        tables, hashes = sized(n)
        assert n * 0.271 ** hashes <= (1 << 14) * 0.271 ** 8 * 1.001
        assert (1 - 0.84 ** hashes) ** tables < 4e-4
    assert sized(1 << 14) == (32, 8)


def test_buckets_of_all_sizes_and_lengths(table):
    """Buckets below and above the size that is compared many at a time, in vectors of several lengths."""
    rng = np.random.default_rng(3)
    rows = groups(rng) + [(i + 1000, v, label) for i, v, label in groups(rng, 8)]
    base = rng.normal(size=16)
    rows += [(5000 + i, np.float32(base + rng.normal(size=16) * 0.08).tolist(), 1) for i in range(70)]
    assert run(table, rows, tables=48) == run(table, rows, tables=48, block=9) == slow(rows)
