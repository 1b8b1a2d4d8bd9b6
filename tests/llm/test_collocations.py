import random
import re
from collections import Counter

import pytest

from tillbook.llm.collocations import collocations
from tillbook.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, id long, f long, score string, chunk long, w1 string"


def slow(rows, least, top):
    by_lang = {}
    for _, text, lang in rows:
        by_lang.setdefault(lang or "und", []).append("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    out = []
    for lang, texts in by_lang.items():
        f = Counter()
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                w = re.findall(r"[^\x20\x09]+", piece)
                f.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = [p for p, a in f.items() if len(p) > 1 and a >= least]
        inside = {q[i:i + k] for q in frequent for k in range(2, len(q)) for i in range(len(q) - k + 1) if f[q[i:i + k]] <= f[q]}
        scored = []
        for p in frequent:
            if p not in inside:
                score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, l, x, n, -s) for r, (s, a, p, l, x) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def corpus(rng):
    words = ["the", "of", "Ünd", "a\x00b", "new", "york", "new", "old", "to", "x" * 200]
    fixed = ["kind regards from all of us", "new york city", "ha ha ha ha ha ha", "a b c d e f g"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(rng.randrange(0, 8)):
            parts.append(" ".join(rng.choice(words) for _ in range(rng.randrange(0, 9))))
            if rng.random() < 0.6:
                parts.append(rng.choice(fixed).upper() if rng.random() < 0.3 else rng.choice(fixed))
            parts[-1] += rng.choice([". ", ", ", "\n", " ", "\t", "\r\n", "?"])
        rows.append((i % 250, " ".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    rows += [(1, None, "en"), (2, "", "fr"), (3, "...", "fr"), (4, "once only here", "es"), (None, rows[5][1], "en"), (5, rows[5][1], "en")]
    rows.append((6, " ".join(rng.choice(words + ["york city"]) for _ in range(20_000)), "en"))
    return rows


@pytest.mark.parametrize("least,top,band", [(3, 2000, 64), (5, 10, 2), (20, 3, 1000)])
def test_matches_brute_force(table, least, top, band):
    rows = corpus(random.Random(least))
    frame = table([(i, t, l, 9, 9, "x", 9, "y") for i, t, l in rows], DOCS)
    got = collocations(frame, least=least, top=top, band=band)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == slow(rows, least, top)


def test_ties_at_the_last_place(table):
    rows = [(i, f"a{i // 3} b{i // 3}", "en") for i in range(30)]
    frame = table([(i, t, l, 9, 9, "x", 9, "y") for i, t, l in rows], DOCS)
    assert sorted(map(tuple, collocations(frame, least=3, top=4, band=64).collect())) == slow(rows, 3, 4)


def test_empty_tables(table):
    assert collocations(table([], DOCS)).collect() == []
    assert collocations(table([(1, None, None, 1, 1, "", 1, "")], DOCS)).collect() == []


def test_query_matches_its_sql(spark, duck):
    query, sql = QUERIES["op12_collocations"]
    got = query(spark, "/root/testdata/sf0.001")
    rows = sorted(map(tuple, got.collect()))
    assert rows and rows == sorted(duck.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall())
