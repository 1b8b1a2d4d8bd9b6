import random
import string

import pytest

from tillbook.llm.contain import Index, contained_items, decontaminate, plain_words

ITEMS = "item_id long, text string, doc_id long"


def words_of(text):
    low = (text or "").lower()
    for c in string.punctuation:
        low = low.replace(c, " ")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow(docs, items, threshold=0.8):
    out = []
    for d, text in docs:
        have = shingles(text)
        for i, body in items:
            want = shingles(body)
            if i is not None and want and len(want & have) >= threshold * len(want):
                out.append((d, i, len(want & have), len(want)))
    return sorted(out, key=repr)


def prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.mark.parametrize("block_words", [1_000_000, 60])
def test_matches_brute_force(docs_of, table, block_words):
    rng = random.Random(4)
    items = [(n, prose(rng, k)) for n, k in enumerate([5, 6, 9, 20, 21, 37, 64, 150, 400])]
    items += [(20, "two words"), (21, ""), (22, None), (None, items[3][1]), (23, "...!"), (24, items[5][1])]
    docs = [(0, None), (1, ""), (2, "two words"), (3, "two words more"), (4, prose(rng, 300))]
    for n, (_, body) in enumerate(items[:9]):
        w = body.split()
        docs.append((10 + n, prose(rng, rng.randrange(0, 3000)) + " " + body.upper() + ". " + prose(rng, 50)))
        docs.append((30 + n, prose(rng, 700) + " " + " ".join(w[:-len(w) // 4] if len(w) > 30 else w[:-1]) + " " + prose(rng, 7)))
        docs.append((50 + n, prose(rng, 99) + " " + ",\n".join(w[:len(w) // 2]) + " " + prose(rng, 200) + " " + " ".join(w[len(w) // 2:])))
    docs += [(70, docs[12][1]), (70, docs[12][1]), (None, docs[12][1]), (71, prose(rng, 60_000) + " " + items[4][1])]
    frame = table([(i, t, None) for i, t in items], ITEMS)
    got = sorted(map(tuple, contained_items(docs_of(docs), frame, block_words=block_words).collect()), key=repr)
    assert got == slow(docs, items)
    kept = decontaminate(docs_of(docs), frame, block_words=block_words)
    dirty = {i: bool(slow([(0, t)], items)) for i, t in docs}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (i is None, i or 0) for i, t in docs if not dirty[i])
    assert kept.columns == docs_of(docs).columns


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_short_items_are_never_missed(threshold):
    for seed in range(30):
        rng = random.Random(seed)
        items = [(10 * k + n, prose(rng, k)) for k in (5, 6, 7, 8, 9, 14, 20) for n in range(8)]
        items.append((900, items[8][1] + " " + items[0][1]))
        docs = []
        for _, body in items:
            docs.append(prose(rng, rng.randrange(90)) + " " + body + " " + prose(rng, rng.randrange(90)))
            docs.append(prose(rng, 40) + " " + " ".join(body.split()[:-1]) + " " + prose(rng, rng.randrange(300)))
        index = Index([(i, plain_words(body)) for i, body in items], threshold)
        found = [(d, *hit) for (d, hits) in enumerate(h for h in index.search(docs, threshold)) for hit in hits]
        assert sorted(found, key=repr) == slow(list(enumerate(docs)), items, threshold)


def test_items_without_a_key_remove_documents(docs_of, table):
    rng = random.Random(5)
    passage = prose(rng, 40)
    docs = docs_of([(1, "so " + passage), (2, prose(rng, 40)), (3, "two words")])
    items = table([(None, passage, 1), (None, "two words", 1), (None, None, 1)], ITEMS)
    assert [r["doc_id"] for r in decontaminate(docs, items).collect()] == [2]
    assert contained_items(docs, items).collect() == []


def test_empty_tables(docs_of, table):
    none = table([], ITEMS)
    some = docs_of([(1, "a b c d e f")])
    assert contained_items(some, none).collect() == []
    assert decontaminate(some, none).count() == 1
    assert contained_items(some.where("false"), table([(1, "a b c d e f", 1)], ITEMS)).collect() == []
    assert decontaminate(some.where("false"), table([(1, "a b c d e f", 1)], ITEMS)).collect() == []
