import math
import random
import re
from collections import Counter

import pytest

from tillbook.llm.queries import QUERIES
from tillbook.llm.ranked_search import search

ITEMS = "item_id long, text string, doc_id long, rank int, score string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def slow(docs, items, k=10):
    bags = [(i, Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in docs)]
    N, L = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, bag, n in bags:
            m = 25 + (75 * n * N) // L if L else 25
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in terms(text) if bag[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def corpus(rng, n):
    common = ["the", "of", "Über", "a1"]
    rare = [f"w{i}" for i in range(300)]
    text = lambda size: " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(size))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "...!?"), (n + 3, text(30_000)), (None, docs[3][1]), (5, docs[5][1]), (5, text(9))]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]
    items = [(i, text(rng.randrange(1, 30))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere"), (None, "w1 w2 THE"), (53, "the of"), (54, items[0][1]), (54, items[1][1]), (55, "w3 w3, W3")]
    items.append((56, docs[7][1]))
    return docs, items


@pytest.mark.parametrize("chunk,bundle", [(8192, 256), (16, 4)])
def test_matches_brute_force(docs_of, table, chunk, bundle):
    docs, items = corpus(random.Random(chunk), 150)
    got = search(docs_of(docs), table([(i, t, 1, 2, "x") for i, t in items], ITEMS), chunk_docs=chunk, bundle=bundle)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == slow(docs, items)


def test_fewer_and_more_than_ten(docs_of, table):
    docs, items = corpus(random.Random(3), 40)
    got = search(docs_of(docs), table([(i, t, 1, 2, "x") for i, t in items], ITEMS), k=2)
    assert sorted(map(tuple, got.collect()), key=repr) == slow(docs, items, 2)


def test_empty_tables(docs_of, table):
    none, one = table([], ITEMS), table([(1, "a b", 1, 1, "x")], ITEMS)
    some = docs_of([(1, "a b c")])
    assert search(some, none).collect() == []
    assert search(some.where("false"), one).collect() == []
    assert search(docs_of([(1, None), (2, "?")]), one).collect() == []


def test_query_matches_its_sql(spark, duck):
    query, sql = QUERIES["op11_ranked_search"]
    got = query(spark, "/root/testdata/sf0.001")
    names = got.columns
    assert sorted(map(tuple, got.collect())) == sorted(duck.execute(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
