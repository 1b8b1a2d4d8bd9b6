import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from tillbook.llm.common import components, split_runs
from tillbook.llm.queries import op1_simhash
from tillbook.llm.simhash import Forest, link_roots, near_links, simhash_components, text_fingerprint

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text, words=3):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        found = found.replace(c, " ")
    found = [w for w in found.split(" ") if w]
    if not found:
        return 0
    shingles = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, radius):
    """fps: {key: fingerprint}; smallest key reachable."""
    low = {k: k for k in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= radius and low[a] < low[b]:
                    low[b], changed = low[a], True
    return low


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBé \t\n\x1c xY", max_size=40))
def test_fingerprint_matches_the_definition(text):
    assert text_fingerprint(text.encode(), 3) == slow_fingerprint(text)


def test_long_text_fingerprint():
    text = " ".join(f"w{i % 97}" for i in range(5000))
    assert text_fingerprint(text.encode(), 3) == slow_fingerprint(text)
    assert text_fingerprint(None, 3) == text_fingerprint(b" \n", 3) == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**64 - 1), st.integers(0, 63)), min_size=1, max_size=40), st.integers(1, 6))
def test_trees_find_every_near_pair(rows, radius):
    rows = sorted({(run, value ^ (1 << bit) if bit % 2 else value % 251) for run, value, bit in rows})
    _, run = np.unique([r for r, _ in rows], return_inverse=True)
    fps = np.array([v for _, v in rows], np.uint64)
    got = {(int(a), int(b)) for x, y in Forest(fps, run).near(radius, most=64) for a, b in zip(x, y)}
    want = {(a, b) for a in range(len(fps)) for b in range(a)
            if run[a] == run[b] and (int(fps[a]) ^ int(fps[b])).bit_count() <= radius}
    assert got == want


def test_link_roots():
    pairs = [(np.array([5, 3]), np.array([4, 1])), (np.array([4]), np.array([3])), (np.array([2]), np.array([0]))]
    assert link_roots(6, pairs).tolist() == [0, 1, 0, 1, 1, 1]


def test_split_runs_keeps_runs_whole():
    import pyarrow as pa
    keys = [1] * 3 + [2] * 9 + [3] + [4] * 2 + [5] * 7
    rng = np.random.default_rng(1)
    for _ in range(30):
        at = sorted(rng.integers(0, len(keys) + 1, 5).tolist())
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64())], names=["k"]) for a, b in zip([0, *at], [*at, len(keys)])]
        out = [(over, t["k"].to_pylist()) for over, t in split_runs(batches, "k", 5)]
        assert [k for _, ks in out for k in ks] == keys
        whole = [set(ks) for over, ks in out if not over]
        assert all(a.isdisjoint(b) for i, a in enumerate(whole) for b in whole[:i])
        assert not any(a & {k for over, ks in out if over for k in ks} for a in whole)


@pytest.mark.parametrize("edges", [[], [(1, 1), (None, 2), (3, None)], [(1, 2), (2, 1), (2, 3), (9, 8), (8, 9)],
                                   [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 60), (60, 59)]])
def test_components(table, edges):
    got = {r["node"]: r["component"] for r in components(table(edges, "a long, b long"), "a", "b").collect()}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)

    def reach(n):
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        return min(seen)
    assert got == {n: reach(n) for n in near}


def test_a_full_shard_is_dealt_again(table):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**62, 6)]
    fps = sorted({b ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 60, (40, 2))} | set(base))
    classes = table([(f, n) for n, f in enumerate(fps)], "fp long, node long")
    want = slow_components(dict(enumerate(fps)), 2)
    for most in (2, 1 << 20):
        links = near_links(classes, 2, most)
        low = {r["node"]: r["component"] for r in components(links, "node", "low").collect()}
        assert {n: low.get(n, n) for n in range(len(fps))} == want


def test_query_matches_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in op1_simhash(spark, SF).collect()}
    fps = {k: slow_fingerprint(t) if len(t) < 20_000 else text_fingerprint(t.encode(), 3) for k, t in texts.items()}
    assert {k: r["fingerprint"] for k, r in got.items()} == {k: f"{v:016x}" for k, v in fps.items()}
    assert {k: r["component_id"] for k, r in got.items()} == slow_components(fps, 2)
    assert len(set(r["component_id"] for r in got.values())) < len(got)


def test_hard_rows(docs_of):
    long = "lorem ipsum dolor " * 30_000
    rows = [(1, None), (2, ""), (3, " \t "), (None, "a b c"), (5, "A b  c"), (6, "a B\nc"), (6, "a B\nc"), (8, long), (9, long), (10, "one")]
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash_components(docs_of(rows)).collect())
    by = {k: (f, c) for k, f, c in got}
    assert len(got) == len(rows)
    assert by[1] == by[2] == by[3] == ("0" * 16, 1)
    assert by[5][1] == by[6][1] == 5 and by[5][0] == by[6][0] == by[-1][0] and by[-1][1] is None
    assert by[8] == by[9] and by[9][1] == 8 and by[10][1] == 10
    assert simhash_components(docs_of([]).where("false")).collect() == []


def test_a_key_in_several_classes_joins_them(docs_of):
    a, b = " ".join(f"alpha{i}" for i in range(60)), " ".join(f"omega{i}" for i in range(60))
    got = simhash_components(docs_of([(3, a), (5, a), (5, b), (9, b), (11, "else where now")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(3, 3), (5, 3), (5, 3), (9, 3), (11, 11)]


def test_components_of_a_star(table):
    edges = [(i, 0) for i in range(1, 2000)] + [(i, i + 1) for i in range(3000, 3010)]
    got = {r["node"]: r["component"] for r in components(table(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(2000)} | {i: 3000 for i in range(3000, 3011)}
