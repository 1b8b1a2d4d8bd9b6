import math
import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tillbook.llm.packing import best_fit, cuts, lower_bound, pack_documents, packed_sequences, token_ids
from tillbook.llm.queries import op7_best_fit_packing

SF = "/root/testdata/sf0.001"
NAME = "byte_bpe_50k"
SLOW = Tokenizer.from_file(public_tokenizers.path(f"{NAME}.json"))


def slow_ids(text):
    return [*SLOW.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" \t\n\x0b\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200bab1'st.", max_size=30)))
def test_both_tokenizers_agree(text):
    assert token_ids(text, NAME).tolist() == slow_ids(text)


def test_special_strings_and_blanks():
    for text in ("a<|endoftext|>b", "  two  blanks \n\n\t x ", "  x\u0085y", "it's we'LL 123 ½²", None, ""):
        assert token_ids(text, NAME).tolist() == slow_ids(text)


@given(st.integers(1, 40), st.integers(1, 12))
def test_cuts(n, capacity):
    parts = cuts(n, capacity)
    assert sum(p[1] for p in parts) == n and [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)])[:-1].tolist()
    assert all(p[1] == capacity for p in parts[1:]) and 1 <= parts[0][1] <= capacity
    assert len(parts) == math.ceil(n / capacity)


def fewest(lengths, capacity):
    """The smallest number of sequences, by trying."""
    lengths = sorted(lengths, reverse=True)

    def fits(i, free):
        if i == len(lengths):
            return True
        return any(fits(i + 1, [*free[:b], f - lengths[i], *free[b + 1:]])
                   for b, f in enumerate(free) if f >= lengths[i] and f not in free[:b])
    return next(n for n in range(len(lengths) + 1) if fits(0, [capacity] * n))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_bound_and_packing_against_the_optimum(lengths):
    best = fewest(lengths, 12)
    bound = lower_bound(np.bincount(lengths, minlength=13), 12)
    assert math.ceil(bound - 1e-9) <= best
    assert math.ceil(bound - 1e-9) >= math.ceil(sum(lengths) / 12)
    sequence, offset, used = best_fit(np.array(lengths), 12)
    assert len(used) >= best and used.max() <= 12
    for s in range(len(used)):
        mine = sorted((int(offset[i]), lengths[i]) for i in range(len(lengths)) if sequence[i] == s)
        assert [o for o, _ in mine] == np.cumsum([0, *(n for _, n in mine)])[:-1].tolist()
        assert sum(n for _, n in mine) == used[s]


def test_large_pieces_raise_the_bound():
    counts = np.bincount([7] * 5 + [2] * 3, minlength=13)
    assert math.ceil(lower_bound(counts, 12)) == 5 > math.ceil((7 * 5 + 2 * 3) / 12)


def check_plan(rows, texts, capacity):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = np.array(slow_ids(text), "<u4")
        mine = sorted(by_doc.pop(doc_id), key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in mine] == cuts(len(ids), capacity)
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in mine]
    assert not by_doc
    return len(by_sequence)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_best_fit_packing(spark, SF).collect()
    n = check_plan(rows, texts, 2048)
    assert n <= math.ceil(lower_bound(np.bincount([r["length"] for r in rows], minlength=2049), 2048)) + 1


@pytest.mark.parametrize("per_partition", [8, 60, 10_000])
def test_partitions_exchange(spark, per_partition):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pack_documents(docs, capacity=512, per_partition=per_partition).collect()
    n = check_plan(rows, texts, 512)
    bound = math.ceil(lower_bound(np.bincount([r["length"] for r in rows], minlength=513), 512))
    assert bound <= n <= bound * (1.05 if per_partition < 60 else 1.01) + 1


def test_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    plan = pack_documents(docs, capacity=300).cache()
    sequences = {r["sequence_id"]: r["ids"] for r in packed_sequences(docs, plan, capacity=300).collect()}
    back = {}
    for r in plan.orderBy("doc_id", "piece").collect():
        back.setdefault(r["doc_id"], []).extend(sequences[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]])
    assert back == {r["doc_id"]: slow_ids(r["text"]) for r in docs.collect()}


def test_hard_rows(docs_of):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "same"), (3, "same"), (4, "word " * 30_000)]
    out = pack_documents(docs_of(rows), capacity=64, per_partition=100).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in out if r["doc_id"] != 4) == [(0, len(slow_ids("x y"))), (1, 1), (2, 1), (3, 2), (3, 2)]
    assert sum(r["length"] for r in out if r["doc_id"] == 4) == len(slow_ids("word " * 30_000))
    assert pack_documents(docs_of([]).where("false")).collect() == []


def test_tie_lengths_pack_fully():
    for pair in combinations_with_replacement((4, 6), 2):
        sequence, _, used = best_fit(np.array(pair * 6), 12)
        assert used.sum() == sum(pair) * 6 and len(used) <= 12
