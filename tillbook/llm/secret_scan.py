"""Secrets in texts, found with a trigram inverted index.

A Boolean trigram query is derived from each rule's regular expression: the
trigrams that every match must contain, as a list of alternatives. The index
holds a posting (trigram, document) for each trigram that some query asks for;
the postings of an alternative are intersected by counting them per document,
and only the documents that remain are searched with the expression. A rule
without mandatory trigrams searches all documents.

Everything that touches rows is DataFrame functions; only the short list of
rules is analysed on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as rc, _parser as rp

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillbook.llm.common import skew_join


@dataclass(frozen=True)
class Rule:
    """A match counts if its group ``body`` has at least ``least`` characters.

    The expression must mean the same to Java and Python, and no match may hold
    more than one reading: matches are the leftmost ones that do not overlap.
    """
    kind: str
    regex: str
    body: int = 0
    least: int = 1


#: Fixed patterns. The first three are the base; a run of 24 or more hexadecimal
#: digits is the same as a longest run that has 24 or more.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

#: Above so many strings the analysis stops multiplying them out.
MOST_STRINGS = 64


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams: the lower-cased form of
    any text that ``regex`` matches holds all trigrams of at least one of them.
    ``[frozenset()]`` asks for nothing, so it fits every text."""
    return _query(list(rp.parse(regex)))


def _and(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    both = {x | y for x in a for y in b}
    if len(both) > MOST_STRINGS:                            # the stronger one alone is still mandatory
        return a if min(map(len, a)) >= min(map(len, b)) else b
    return [x for x in both if not any(y < x for y in both)]


def _query(items: list) -> list[frozenset[str]]:
    query, strings = [frozenset()], {""}

    def flush() -> None:
        nonlocal query, strings
        found = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings]
        if all(found):
            query = _and(query, found)
        strings = {""}

    for op, arg in items:
        exact = _strings([(op, arg)])
        if exact is not None and len(exact) * len(strings) <= MOST_STRINGS:
            strings = {s + x for s in strings for x in exact}
            continue
        flush()
        if op is rc.SUBPATTERN:
            query = _and(query, _query(list(arg[-1])))
        elif op is rc.BRANCH:
            query = _and(query, list({x for part in arg[1] for x in _query(list(part))}))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] >= 1:
            query = _and(query, _query(list(arg[2])))
    flush()
    return query


def _strings(items: list) -> set[str] | None:
    """All lower-cased strings that ``items`` can match, or None if too many."""
    out = {""}
    for op, arg in items:
        if op is rc.LITERAL:
            each = {chr(arg).lower()}
        elif op is rc.IN and all(x[0] is rc.LITERAL for x in arg):
            each = {chr(x[1]).lower() for x in arg}
        elif op is rc.SUBPATTERN:
            each = _strings(list(arg[-1]))
        elif op is rc.BRANCH:
            parts = [_strings(list(p)) for p in arg[1]]
            each = None if None in parts else set().union(*parts)
        elif op is rc.MAX_REPEAT and arg[1] is not rc.MAXREPEAT and arg[1] <= 8:
            one = _strings(list(arg[2]))
            each, power = (None, None) if one is None else (set(), {""})
            for n in range(int(arg[1]) + 1 if one is not None else 0):
                each |= power if n >= arg[0] else set()
                power = {s + x for s in power for x in one}
                if len(power) > MOST_STRINGS:
                    return None
        elif op is rc.AT:
            each = {""}
        else:
            return None
        if each is None or len(out) * len(each) > MOST_STRINGS:
            return None
        out = {s + x for s in out for x in each}
    return out


def postings(docs: DataFrame, rules: tuple[Rule, ...], key: str, text: str) -> DataFrame:
    """The inverted index over the trigrams that the rules ask for:
    ``(trigram, id, text_hash)``, one row for each trigram that a text holds."""
    asked = sorted({t for r in rules for alternative in trigram_query(r.regex) for t in alternative})
    low = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.lower(text).alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in asked)))
    return low.select("id", "text_hash", F.explode(held).alias("trigram"))


def candidates(spark: SparkSession, index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(id, text_hash, kinds)``: the texts whose postings satisfy the rules' queries."""
    wanted = [(n, m, t, len(alternative)) for n, r in enumerate(rules)
              for m, alternative in enumerate(trigram_query(r.regex)) for t in alternative]
    if not wanted:
        return index.select("id", "text_hash", F.array(F.lit(0)).alias("kinds")).limit(0)
    query = spark.createDataFrame(wanted, "rule int, alternative int, trigram string, needs long")
    # the query is as long as the rules, whatever the data
    met = (index.join(F.broadcast(query), "trigram").groupBy("id", "text_hash", "rule", "alternative")
           .agg(F.count_distinct("trigram").alias("n"), F.max("needs").alias("needs")).where("n = needs"))
    return met.groupBy("id", "text_hash").agg(F.collect_set("rule").alias("kinds"))


def _pieces(n: int, rule: Rule, text: Column) -> Column:
    """For each match: the characters before it since the last one, its own, and its body's."""
    regex = F.lit(rule.regex)
    return F.struct(F.lit(n).alias("rule"), F.when(F.regexp_like(text, regex), F.arrays_zip(
        F.transform(F.split(text, rule.regex, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.length).alias("long"),
        F.transform(F.regexp_extract_all(text, regex, F.lit(rule.body)), F.length).alias("body"))).alias("found"))


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every secret in every text: ``(id, text_hash, rule, start, end)``.

    ``rule`` is the place in ``rules``; the span counts code points, its end is
    exclusive. ``text_hash`` is ``xxhash64`` of the text. Rows with the same key
    and text give their spans once; a null key is kept as null. A null or empty
    text has none. Other columns are ignored.
    """
    indexed = tuple(r for r in rules if min(map(len, trigram_query(r.regex))))
    free = [(n, r) for n, r in enumerate(rules) if r not in indexed]
    body = docs.select(F.col(key).alias("id"), F.struct(F.col(key)).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    found = []
    if indexed:
        chosen = candidates(docs.sparkSession, postings(docs, indexed, key, text), indexed)
        # a struct of a null key equals another; one text may be a third of all rows
        hit = skew_join(body, chosen.select(F.struct("id").alias("c_key"), F.col("text_hash").alias("c_hash"), "kinds"),
                        {"key": "c_key", "text_hash": "c_hash"})
        found.append(hit.select("id", "text_hash", F.explode(F.array_compact(F.array(*(
            F.when(F.array_contains("kinds", n), _pieces(rules.index(r), r, F.col("text")))
            for n, r in enumerate(indexed))))).alias("p")))
    if free:
        found.append(body.select("id", "text_hash", F.explode(F.array(*(_pieces(n, r, F.col("text")) for n, r in free))).alias("p")))
    piece = found[0] if len(found) == 1 else found[0].unionAll(found[1])
    piece = piece.select("id", "text_hash", "p.rule", F.posexplode("p.found").alias("at", "m"))
    once = (piece.where("m.long is not null").groupBy("id", "text_hash", "rule", "at")
            .agg(*(F.min(f"m.{c}").cast("long").alias(c) for c in ("gap", "long", "body"))))
    so_far = Window.partitionBy("id", "text_hash", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = once.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(so_far))
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("rule") + 1)
    return placed.where(F.col("body") >= least).select("id", "text_hash", "rule", (F.col("end") - F.col("long")).alias("start"), "end")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: ``key`` and ``spans``, an array of ``(start, rule,
    kind, end)`` by start, then by the order of the rules. Null and empty texts
    have an empty array; repeated rows stay, and each has its spans."""
    spans = secret_spans(docs, key, text, rules)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    by_text = (spans.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct(
        "start", "rule", F.element_at(kinds, F.col("rule") + 1).alias("kind"), "end"))).alias("spans"))
        .select(F.struct("id").alias("s_key"), F.col("text_hash").alias("s_hash"), "spans"))
    rows = docs.select(F.col(key).alias("id"), F.struct(F.col(key)).alias("key"), F.xxhash64(text).alias("text_hash"))
    return (skew_join(rows, by_text, {"key": "s_key", "text_hash": "s_hash"}, "left")
            .select(F.col("id").alias(key), F.coalesce("spans", F.expr(
                "cast(array() as array<struct<start:bigint,rule:int,kind:string,end:bigint>>)")).alias("spans")))
