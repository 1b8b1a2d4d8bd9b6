import random
import re

import numpy as np
import pytest

from tillbook.llm.queries import QUERIES
from tillbook.llm.substrings import dedup_substrings, runs, segments


def slow(docs, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            s = tuple(w[p:p + window])
            if i is not None:
                first[s] = min(i, first.get(s, i))
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, " ".join(x for n, x in enumerate(w) if n not in gone), len(w), len(gone)))
    return sorted(out, key=repr)


def corpus(rng, window):
    prose = lambda n: " ".join(rng.choice("äb cd ef g hi".split()) + str(rng.randrange(50)) for _ in range(n))
    passages = [prose(n) for n in (window - 1, window, window + 1, 3 * window, window // 2, 700)]
    docs = [(0, None), (1, ""), (2, " \n"), (3, "ha " * 400), (4, "ha " * (window + 5)), (5, "ha " * (window - 1)), (6, prose(5000))]
    for i in range(7, 90):
        parts = [prose(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(passages), prose(rng.choice([0, 1, 3, 40]))]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    near = docs[6][1].split()
    near[1000] = near[1020] = near[3000] = "other"
    docs += [(91, " ".join(near)), (92, docs[6][1]), (93, " ".join(near[990:1100])), (None, docs[6][1]), (20, passages[3]), (20, passages[3]),
             (94, " ".join(near[2000:2040] + near[100:140])), (95, " ".join(near[100:140] + near[2000:2060] + near[2060:2100] + near[60:99]))]
    docs += [(200 + i, prose(7) + " " + passages[0] + " " + prose(7)) for i in range(40)]
    docs += [(300 + i, passages[3]) for i in range(20)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("window,block,seed", [(50, 4096, 1), (50, 3, 2), (32, 5, 3)])
def test_matches_brute_force(docs_of, window, block, seed):
    docs = corpus(random.Random(seed), window)
    got = dedup_substrings(docs_of(docs), window=window, block=block).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == slow(docs, window)
    for r in got:
        assert sum(s["size"] for s in r["removed"]) == r["n_removed"]
        assert all(a["at"] + a["size"] < b["at"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_runs_and_segments():
    words = np.random.default_rng(1).integers(0, 3, 300).astype(np.uint64)
    for size in (1, 2, 3, 16, 50, 300, 301):
        got = runs(words, size)
        kinds = {}
        for p in range(len(words) - size + 1):
            kinds.setdefault(tuple(words[p:p + size].tolist()), set()).add(int(got[p]))
        assert len(got) == max(0, 301 - size) and all(len(v) == 1 for v in kinds.values())
        assert len(set(got.tolist())) == len(kinds)
    owner = np.repeat(np.arange(4), [100, 40, 60, 100])
    first, n, _, _ = segments(words, owner)
    covered = sorted(p for f, k in zip(first.tolist(), n.tolist()) for p in range(f, f + k))
    assert covered == [p for p in range(251) if owner[p] == owner[p + 49]]


def test_empty_tables(docs_of):
    assert dedup_substrings(docs_of([(1, "a")]).where("false")).collect() == []
    assert [tuple(r) for r in dedup_substrings(docs_of([(1, "a  b")])).collect()] == [(1, "a b", 2, 0, [])]


def test_query_matches_its_sql(spark, duck):
    query, sql = QUERIES["op13_substring_dedup"]
    got = query(spark, "/root/testdata/sf0.001")
    rows = sorted(map(tuple, got.collect()))
    assert any(r[2] for r in rows) and rows == sorted(duck.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall())
