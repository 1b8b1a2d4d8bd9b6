import math
import random
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tillbook.llm import chat_repair as cr
from tillbook.llm import lm_score
from tillbook.llm.packing import token_ids
from tillbook.llm.queries import op2_lm_score, op3_chat_repair

NAME = "byte_bpe_50k"


def slow_losses(rows, good, exact):
    """Mean losses by dictionaries; pairs are told apart by themselves, or by their places."""
    def pair(a, b):
        key = (a * (size + 1) + b) * 0x9E3779B97F4A7C15 % 2**64
        return (a, b) if exact else key >> (64 - lm_score.PAIR_BITS)
    size = lm_score.vocabulary(NAME)
    ids = [token_ids(t, NAME)[:-1].tolist() for _, t in rows]
    models = []
    for chosen in ([x for x, (i, _) in zip(ids, rows) if i in good], ids):
        one = Counter(t for x in chosen for t in x)
        two = Counter(pair(a, b) for x in chosen for a, b in zip([size, *x], x))
        context = Counter(a for x in chosen for a in [size, *x[:-1]] if x)
        models.append((one, two, context, sum(one.values())))
    scale = models[0][3] / models[1][3]
    out = []
    for (i, _), x in zip(rows, ids):
        losses = []
        for (one, two, context, total), by in zip(models, (1, scale)):
            single = lambda t: (one[t] * by + lm_score.EXTRA) / (total * by + lm_score.EXTRA * size)  # noqa: E731, B023
            losses.append(sum(-math.log((two[pair(a, b)] * by + lm_score.PAIR_WEIGHT * single(b)) / (context[a] * by + lm_score.PAIR_WEIGHT))
                              for a, b in zip([size, *x], x)) / len(x) if x else None)
        out.append((i, len(x), *losses))
    return out


def test_scores_match_brute_force(spark, docs_of, table):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows += [(901, None), (902, ""), (None, rows[3][1]), (903, rows[5][1]), (903, rows[5][1]), (904, "word " * 30_000)]
    good = [r[0] for r in rows[:20:2]] + [903]
    target = table([(i,) for i in [*good, None, good[0], 55_555]], "doc_id long")
    got = sorted(map(tuple, lm_score.score_documents(docs_of(rows), target).collect()), key=lambda r: (repr(r[0]), r[1]))
    for exact in (False, True):
        want = sorted(slow_losses(rows, set(good), exact), key=lambda r: (repr(r[0]), r[1]))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(g[2:] == (None, None, None) for g, w in zip(got, want) if w[2] is None)
        off = [abs(g[n] - x) for g, w in zip(got, want) if w[2] is not None for n, x in ((2, w[2]), (3, w[3]), (4, w[2] - w[3]))]
        if exact:                                            # places that pairs share change little
            assert np.quantile(off, 0.9) < 0.03
        else:
            assert max(off) < 1e-4
    assert lm_score.score_documents(docs_of(rows).where("false"), target).collect() == []
    assert lm_score.score_documents(docs_of(rows), target.where("false")).count() == len(rows)


@pytest.mark.parametrize("step", [lm_score.STEP, 3000])
def test_pairs_share_no_count(spark, docs_of, table, step):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    rows += [(None, rows[3][1]), (rows[5][0], rows[5][1]), (90_001, None)]
    good = [r[0] for r in rows[:100:2]]
    got = sorted(map(tuple, lm_score.score_documents(docs_of(rows), table([(i,) for i in good], "doc_id long"), step=step).collect()),
                 key=lambda r: (repr(r[0]), r[1]))
    want = sorted(slow_losses(rows, set(good), True), key=lambda r: (repr(r[0]), r[1]))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert max(abs(g[n] - w[n]) for g, w in zip(got, want) if w[2] is not None for n in (2, 3)) < 1e-9


def test_good_documents_score_lower(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = {r["doc_id"]: r["difference"] for r in op2_lm_score(spark, sf).collect()}
    good = [scored[i] for i, r in labels.items() if r["quality"] and not r["toxic"]]
    bad = [scored[i] for i, r in labels.items() if not r["quality"]]
    assert np.median(good) < np.median(bad)


@lru_cache(maxsize=None)
def slow_cost(roles, state=0):
    """Cheapest (cost, turns) of a legal end, by trying everything."""
    if not roles:
        return {0: (0, 0) if state == 0 else None, 1: (4, 2), 2: (2, 1), 3: (0, 0)}[state]
    ways = []
    for own in (1, 2, 3):
        other = 0 if roles[0] == own else 3 if roles[0] else 1
        if own == state:
            rest = slow_cost(roles[1:], state)
            ways.append((1 + other + rest[0], rest[1]))
        for before in ((), (1,), (2,), (3,), (1, 2), (2, 3), (3, 2)):
            at, legal = state, True
            for x in (*before, own):
                legal &= x in {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}[at]
                at = x
            if legal:
                rest = slow_cost(roles[1:], own)
                ways.append((2 * len(before) + other + rest[0], len(before) + 1 + rest[1]))
    return min(ways)


NAMES = ["tool", "system", "user", "assistant"]


def repaired(table, convs, segment):
    rows = [(c, n, NAMES[r] if r else random.Random(n).choice(["tool", None, ""]), f"t{n}", 5, "x")
            for c, roles in convs.items() for n, r in enumerate(roles)]
    out = defaultdict(list)
    frame = table(rows, "conv_id long, turn long, role string, text string, cost long, segment string")
    for r in cr.repair_conversations(frame, segment=segment).collect():
        out[r["conv_id"]].append(r)
    return {c: sorted(rs, key=lambda r: (r["segment"], r["piece"])) for c, rs in out.items()}


def legal(roles):
    at = 0
    for r in roles:
        if r not in cr.NEXT[at]:
            return False
        at = r
    return at == 3


@pytest.mark.parametrize("segment", [4096, 3])
def test_repairs_are_cheapest_and_legal(table, segment):
    rng = random.Random(segment)
    convs = {n: tuple(rng.choice([0, 1, 2, 3, 2, 3]) for _ in range(rng.randrange(1, 15))) for n in range(120)}
    convs |= {500: (1,), 501: (3,), 502: (2, 3) * 40, 503: (1, 1, 2, 2, 3, 3), 504: (0,), 505: (2, 3, 1, 2)}
    got = repaired(table, convs, segment)
    assert set(got) == set(convs)
    for c, roles in convs.items():
        rows = got[c]
        assert [r["cost"] for r in rows[:-1]] == [None] * (len(rows) - 1)
        assert (rows[-1]["cost"], rows[-1]["out_turn"] + 1) == slow_cost(roles)
        turns = {}
        for r in rows:
            assert turns.setdefault(r["out_turn"], r["role_out"]) == r["role_out"]
        assert list(turns) == list(range(len(turns))) and legal([NAMES.index(x) for x in turns.values()])
        assert [r["rendered"] is not None for r in rows] and sum(r["action"] != "insert" for r in rows) == len(roles)
        text, bodies = "".join(r["rendered"] for r in rows), defaultdict(list)
        n = 0
        for r in rows:
            if r["action"] != "insert":
                bodies[r["out_turn"]].append(f"t{n}")
                n += 1
        assert text == "".join(f"<|im_start|>{turns[t]}\n" + "\n".join(bodies[t]) + "<|im_end|>\n" for t in turns)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=8))
def test_steps_reach_the_optimum(roles):
    costs = [(0, 0), cr.NEVER, cr.NEVER, cr.NEVER]
    for r in roles:
        costs = cr.advance(costs, r)
    best = min((costs[s][0] + cr.ENDING[s][0][0], costs[s][1] + cr.ENDING[s][0][1]) for s in (1, 2, 3))
    assert best == slow_cost(tuple(roles))


def test_hard_rows(table):
    rows = [(1, None, "User", None), (1, 0, " ASSISTANT ", "a"), (None, 1, "user", "q"), (None, 2, "assistant", "r"), (3, 1, "user", "same"),
            (3, 1, "user", "same"), (4, 5, None, "x" * 100_000), (5, 7, "user", "")]
    frame = table(rows, "conv_id long, turn long, role string, text string")
    out = defaultdict(list)
    for r in cr.repair_conversations(frame).collect():
        out[r["conv_id"]].append(r)
    view = {c: [(r["action"], r["role_out"]) for r in sorted(rs, key=lambda r: (r["segment"], r["piece"]))] for c, rs in out.items()}
    assert view[1] == view[None] == [("keep", "user"), ("keep", "assistant")]
    assert view[3] == [("keep", "user"), ("merge", "user"), ("insert", "assistant")]
    assert view[4][0][0] == "relabel" and sum(len(r["rendered"]) for r in out[4]) > 100_000
    assert view[5] == [("keep", "user"), ("insert", "assistant")]
    assert cr.repair_conversations(frame.where("false")).collect() == []


def test_segments_are_bounded_by_rows(table):
    rng = random.Random(8)
    rows = [(None, rng.choice([None, 0, 1]), NAMES[rng.randrange(4)], f"t{n}") for n in range(60)]
    rows += [(1, 7, NAMES[rng.randrange(4)], "same") for _ in range(30)] + [(2, 10**9 * n, NAMES[2 + n % 2], "far") for n in range(10)]
    out = cr.repair_conversations(table(rows, "conv_id long, turn long, role string, text string"), segment=4).collect()
    held = Counter((r["conv_id"], r["segment"]) for r in out if r["action"] != "insert")
    assert max(held.values()) == 4 and len(held) == 15 + 8 + 3
    for c in (None, 1, 2):
        roles = tuple(r for _, r in sorted((-1 if t is None else t, NAMES.index(r)) for i, t, r, _ in rows if i == c))
        own = sorted((r for r in out if r["conv_id"] == c), key=lambda r: (r["segment"], r["piece"]))
        assert (own[-1]["cost"], own[-1]["out_turn"] + 1) == slow_cost(roles)
        assert sum(r["action"] != "insert" for r in own) == len(roles)


def test_query_covers_every_turn(spark):
    sf = "/root/testdata/sf0.001"
    rows = op3_chat_repair(spark, sf).collect()
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert sum(r["action"] != "insert" for r in rows) == turns.count()
    assert sum(r["cost"] is not None for r in rows) == turns.select("conv_id").distinct().count()


def test_texts_go_with_their_rows(table):
    rng = random.Random(5)
    rows = [(c, rng.choice([None, n, 0]), NAMES[rng.randrange(4)], rng.choice(["", None, "same", "other\n", f"t{n}", "é " * 2000]), 1, "x")
            for c in (None, 0, 1, 2) for n in range(25)] * 2
    frame = table(rows, "conv_id long, turn long, role string, text string, row1 int, id string")
    out = sorted(cr.repair_conversations(frame, segment=7).collect(), key=lambda r: (repr(r["conv_id"]), r["segment"], r["piece"]))
    marks = ("<|im_start|>system\n", "<|im_start|>user\n", "<|im_start|>assistant\n", "<|im_end|>\n")

    def body(r):
        s = r["rendered"]
        for m in marks:
            s = s.replace(m, "")
        return s[1:] if r["action"] == "merge" else s
    assert (Counter((r["conv_id"], r["role_in"], body(r)) for r in out if r["action"] != "insert")
            == Counter((c, role, text or "") for c, _, role, text, _, _ in rows))
    assert all(body(r) == "" for r in out if r["action"] == "insert")
