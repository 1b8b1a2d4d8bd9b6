"""Chat conversations repaired at least cost and rendered.

A legal conversation is a path through an automaton: an optional system turn,
then user and assistant turns by turns, ending with the assistant. Each turn is
kept, given another role, or merged into the turn before it, and empty turns
are inserted where one is missing; dynamic programming over the automaton's
states finds the cheapest way, the fewest turns among equals.

A turn's effect is a 4 x 4 matrix (cheapest cost from each state to each), and
matrices compose. A conversation's rows are numbered in their order, and every
``SEGMENT`` of them are a segment; tasks compose the matrices within segments, a conversation's short
list of segment matrices tells with which states its segments begin and end,
and each segment is then repaired by itself. So a conversation of any length
is repaired as a whole, without being in one place.

All this reads numbers and roles only. A text moves once, when it joins the
piece that its row became.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillbook.llm.common import cut, split_runs
from tillbook.operators.global_window import segmented

SEGMENT = 4096
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 3, 1, 2

#: States are the role of the last turn; 0 is the beginning. Role 0 is any other or none.
ROLES = ("", "system", "user", "assistant")
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
END = 3
NEVER = (1 << 40, 0)

#: A row's hashes.
ROW = ["row1", "row2"]

#: (cost, new turns), and what is done: inserted roles, then the turn's own role and whether it is merged.
Step = tuple[tuple[int, int], tuple[int, ...], int, bool]


def _insertions(a: int, b: int) -> tuple[int, ...] | None:
    """The fewest empty turns that make a turn of role ``b`` legal after state ``a``."""
    if b in NEXT[a]:
        return ()
    for x in NEXT[a]:
        if x != 1 and b in NEXT[x]:
            return (x,)
    return None


def _steps() -> dict[tuple[int, int, int], Step]:
    """The best way for a turn of each role from each state to each state."""
    best: dict[tuple[int, int, int], Step] = {}
    for role, a, b in product(range(4), range(4), range(1, 4)):
        other = 0 if role == b else RELABEL if role else RELABEL_UNKNOWN
        ways: list[Step] = []
        if (before := _insertions(a, b)) is not None:
            ways.append(((INSERT * len(before) + other, len(before) + 1), before, b, False))
        if a == b:
            ways.append(((MERGE + other, 0), (), b, True))
        if ways:
            best[role, a, b] = min(ways)
    return best


STEPS = _steps()
#: For each role: (from, to, cost, new turns).
MOVES = [[(a, b, *s[0]) for (r, a, b), s in STEPS.items() if r == role] for role in range(4)]
#: What it costs to end in each state: an assistant turn is inserted after a user turn, both after another.
ENDING = {0: ((0, 0), ()), 1: ((2 * INSERT, 2), (2, 3)), 2: ((INSERT, 1), (3,)), 3: ((0, 0), ())}


def advance(costs: list[tuple[int, int]], role: int) -> list[tuple[int, int]]:
    """Cheapest (cost, new turns) of each state after one more turn."""
    out = [NEVER] * 4
    for a, b, cost, new in MOVES[role]:
        way = (costs[a][0] + cost, costs[a][1] + new)
        if way < out[b]:
            out[b] = way
    return out


def trace(roles: list[int], start: int, end: int) -> list[Step]:
    """The cheapest steps over ``roles`` from a state to a state."""
    costs = [NEVER if s != start else (0, 0) for s in range(4)]
    back: list[list[int]] = []
    for role in roles:
        out, came = [NEVER] * 4, [0] * 4
        for a, b, cost, new in MOVES[role]:
            way = (costs[a][0] + cost, costs[a][1] + new)
            if way < out[b]:
                out[b], came[b] = way, a
        costs = out
        back.append(came)
    steps = []
    for role, came in zip(reversed(roles), reversed(back)):
        steps.append(STEPS[role, came[end], end])
        end = came[end]
    return steps[::-1]


def role_code(role: Column) -> Column:
    name = F.lower(F.trim(role))
    return F.coalesce(*(F.when(name == r, n) for n, r in enumerate(ROLES) if n), F.lit(0))


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, segment, role) in order, to a matrix for each segment, without holding one."""
    now, conv, segment, out = None, None, None, []

    def done(last: bool) -> Iterator[pa.RecordBatch]:
        if now is not None:
            out.append((now, conv, segment, [x for row in rows for way in row for x in way]))
        if out and (last or len(out) >= 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=["part", "conv", "segment", "ways"])
            out.clear()

    rows: list[list[tuple[int, int]]] = []
    for batch in batches:
        for part, c, s, role in zip(*(batch.column(n).to_pylist() for n in ("part", "conv", "segment", "role"))):
            if part != now:
                yield from done(False)
                now, conv, segment = part, c, s
                rows = [[NEVER if s2 != s1 else (0, 0) for s2 in range(4)] for s1 in range(4)]
            rows = [advance(r, role) for r in rows]
    yield from done(True)


def _plan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's segments in order, to the states that each begins and ends
    with, the turns before it, and the whole's cost on its last segment."""
    names = ["part", "first", "last", "turns", "cost"]
    for _, table in split_runs(batches, "conv", 1 << 62):
        out, group = [], []
        part, conv, ways = (table[n].to_pylist() for n in ("part", "conv", "ways"))

        def finish() -> None:
            costs, back = [(0, 0), NEVER, NEVER, NEVER], []
            for _, flat in group:
                ahead = [min(((costs[a][0] + flat[8 * a + 2 * b], costs[a][1] + flat[8 * a + 2 * b + 1]), a) for a in range(4))
                         for b in range(4)]
                costs = [x[0] for x in ahead]
                back.append([x[1] for x in ahead])
            end = min(range(1, 4), key=lambda s: (costs[s][0] + ENDING[s][0][0], costs[s][1] + ENDING[s][0][1]))
            total = costs[end][0] + ENDING[end][0][0]
            path = [end]
            for came in reversed(back):
                path.append(came[path[-1]])
            path.reverse()
            turns = 0
            for n, (p, flat) in enumerate(group):
                a, b = path[n], path[n + 1]
                out.append((p, a, b, turns, total if n == len(group) - 1 else None))
                turns += flat[8 * a + 2 * b + 1]

        for n in range(len(part)):
            if group and conv[n] != conv[n - 1]:
                finish()
                group = []
            group.append((part[n], ways[n]))
        if group:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def _before(role: int, opened: bool, first: bool, template: tuple[str, str]) -> str:
    """What a piece of the rendered conversation has before its text: it closes the turn before a new one."""
    return ("" if first else template[1] if opened else "\n") + (template[0].format(role=ROLES[role]) if opened else "")


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         segment: int = SEGMENT, template: tuple[str, str] = ("<|im_start|>{role}\n", "<|im_end|>\n")) -> DataFrame:
    """Conversations repaired at least cost and rendered, piece by piece.

    Returns ``(conv, out_turn, segment, piece, role_in, role_out, action, cost,
    rendered)``, named ``conv`` as in the input: one row for each input turn and
    each inserted one. ``action`` is keep, relabel, merge, or insert, a merged
    turn with another role is ``merge``; ``out_turn`` numbers the repaired turns
    from 0. By ``segment`` and ``piece``, the ``rendered`` strings of a
    conversation one after the other are the repaired conversation. ``cost`` is
    the whole repair's, on the last piece, else null.

    Turns go by number, then by role and a hash of the text; null numbers come
    first. Roles are read without case and blanks; null or unknown roles are
    given another at a lower cost. A null text is empty. Rows that repeat are
    turns of their own. Rows with a null conversation are one conversation.
    Other columns are ignored; an empty table gives an empty result. A segment
    takes ``segment`` input rows, whatever their turn numbers.
    """
    kind = dict(turns.dtypes)[conv]
    # a conversation goes by a hash of its id, so that null is one too; a row that has a text goes by
    # 128 bits of hash of all that is read of it, as rows equal in that may change places
    rows = (turns.select(F.col(conv).alias("id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role_in"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .withColumn("conv", F.xxhash64(F.lit(1), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("id").isNull())))
    read = [F.coalesce("turn", F.lit(0)), F.col("turn").isNull(), F.coalesce("role_in", F.lit("")), F.col("role_in").isNull(), F.col("text")]
    rows = rows.withColumns({n: F.when(F.col("text") != "", F.xxhash64(F.lit(k), "conv", *read)) for k, n in enumerate(ROW, 2)})
    texts = rows.where("text <> ''").groupBy(*(F.col(n).alias(f"of_{n}") for n in ROW)).agg(F.first("text").alias("text"))
    rows = (rows.withColumn("role", role_code(F.col("role_in"))).withColumn("tie", F.xxhash64("text"))
            .withColumn("copy", F.monotonically_increasing_id()).drop("text"))
    # rows are numbered by ranges of the order, so a conversation or a turn number with very many rows is in several tasks
    rows = segmented(rows, ["conv"], [(c, False) for c in ("turn", "role", "tie", "copy")], row_col="place").drop("turn", "tie", "copy")
    rows = rows.withColumn("segment", F.floor((F.col("place") - 1) / segment)).withColumn("part", F.xxhash64("conv", "segment"))
    order = ["part", "place"]
    ways = (rows.select(*order, "conv", "segment", "role").repartition("part").sortWithinPartitions(*order)
            .mapInArrow(_matrices, "part long, conv long, segment long, ways array<long>"))
    plan = cut(ways.repartition("conv").sortWithinPartitions("conv", "segment")
               .mapInArrow(_plan, "part long, first long, last long, turns long, cost long"))
    full = rows.join(plan, "part").select(*order, "role", "id", "segment", "role_in", *ROW, "first", "last", "turns", "cost")
    schema = (f"id {kind}, out_turn long, segment long, piece long, role_in string, role_out string, action string, cost long, "
              "before string, after string, row1 long, row2 long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in split_runs(batches, "part", 1 << 62):
            part, codes, ids, number_of, role_in, row1, row2, first, last, turns_before, cost = (table[n].to_pylist() for n in (
                "part", "role", "id", "segment", "role_in", *ROW, "first", "last", "turns", "cost"))
            start, out = 0, []
            for end in range(1, len(part) + 1):
                if end < len(part) and part[end] == part[start]:
                    continue
                number, place = turns_before[start] - 1, len(out)  # of the turn that is open; where the part's rows begin
                begins = number < 0
                at = number_of[start]
                for n, ((_, _), inserted, own, merged) in zip(range(start, end), trace(codes[start:end], first[start], last[start])):
                    for extra in inserted:
                        number += 1
                        out.append((ids[n], number, at, len(out) - place, None, ROLES[extra], "insert", None,
                                    _before(extra, True, begins, template), "", None, None))
                        begins = False
                    number += not merged
                    action = "merge" if merged else "keep" if codes[n] == own else "relabel"
                    out.append((ids[n], number, at, len(out) - place, role_in[n], ROLES[own], action, None,
                                _before(own, not merged, begins, template), "", row1[n], row2[n]))
                    begins = False
                if cost[start] is not None:                  # the conversation's last segment
                    for extra in ENDING[last[start]][1]:
                        number += 1
                        out.append((ids[start], number, at, len(out) - place, None, ROLES[extra], "insert", None,
                                    _before(extra, True, False, template), "", None, None))
                    final = out[-1]
                    out[-1] = (*final[:7], cost[start], final[8], template[1], *final[10:])
                start = end
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], f.type) for n, f in enumerate(arrow)], schema=arrow)

    arrow = to_arrow_schema(turns.sparkSession.createDataFrame([], schema).schema)
    pieces = full.repartition("part").sortWithinPartitions(*order).mapInArrow(run, schema)
    # pieces without a text are dealt by themselves and find none
    pieces = pieces.withColumn(ROW[0], F.coalesce(ROW[0], F.xxhash64("id", "segment", "piece"))).withColumn(ROW[1], F.coalesce(ROW[1], F.lit(0)))
    return (pieces.join(texts, [F.col(n) == F.col(f"of_{n}") for n in ROW], "left")
            .select(F.col("id").alias(conv), "out_turn", "segment", "piece", "role_in", "role_out", "action", "cost",
                    F.concat("before", F.coalesce("text", F.lit("")), "after").alias("rendered")))
