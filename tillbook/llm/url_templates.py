"""URL filter with a tree of path templates for each host.

Labelled URLs come from rules on hosts and path prefixes. The other URLs are
judged by their template. Per host, a tree of the paths is built from the root
down, until no path has a further segment. At each node, segments that are many
and each rare become a wildcard; then similar branches are merged into one:

* branches with labels, in the order of their bad share, as long as the bad
  shares of the labelled URLs of the next one and of what is merged so far don't
  differ significantly;
* branches without labels, of which nothing is known that they could be told apart
  by, are one branch, apart from those with labels.

A template is rejected if its smoothed share of bad among labelled URLs is high
enough.

Everything is DataFrame functions over the different (host, path) pairs with
their counts. A level is one row per branch after it is aggregated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import cut, lower_ascii, skew_join


@dataclass(frozen=True)
class UrlRule:
    """Fits the host and its subdomains, where the path begins with ``path``."""
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed rules.
RULES = (
    UrlRule("net", "/", "block"),
    UrlRule("example.net", "/en/", "allow"),
    UrlRule("example.com", "/de/", "block"),
    UrlRule("org", "/fr/", "allow"),
)

#: A node with more different segments than this has wildcards.
MOST_BRANCHES = 16
#: Branches are alike if two proportions differ by less than this many standard errors.
ALIKE = 1.96
#: A template is bad if (bad + 1) / (labelled + 2) is at least this.
REJECT = 0.9


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case. Path: then up to ``?``, ``#`` or the end. Both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...], what: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, or null."""
    fit = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
                  F.lit(getattr(r, what))) for r in sorted(rules, key=lambda r: (-len(r.name), r.name))]
    return F.coalesce(*fit, F.lit(None).cast("string"))


def segments(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "^/", ""), "/")


#: Merged branches of a node, with sums over their tokens.
GROUPS = "array<struct<tokens: array<string>, labelled: double, bad: double, kinds: bigint>>"


def _apart(x: Column, n: Column, y: Column, m: Column, alike: float) -> Column:
    """Whether the shares x / n and y / m differ significantly."""
    share = (x + y) / (n + m)
    return (x * m != y * n) & (F.abs(x / n - y / m) >= alike * F.sqrt(share * (1 - share) * (1 / n + 1 / m)))


def _merged(tokens: Column, alike: float) -> Column:
    """The merged branches, with their tokens in order, of a node's (token, labelled,
    bad, kinds): at most ``most`` + 1 tokens, each for so many kinds of segments."""
    sums = ("labelled", "bad", "kinds")
    ranked = F.array_sort(F.transform(F.filter(tokens, lambda t: t["labelled"] > 0), lambda t: F.struct(
        (t["bad"] / t["labelled"]).alias("share"), t["token"].alias("token"), *(t[c].alias(c) for c in sums))))

    def take(groups: Column, t: Column) -> Column:
        last = F.try_element_at(groups, F.lit(-1))
        own = F.struct(F.array(t["token"]).alias("tokens"), *(t[c].alias(c) for c in sums))
        both = F.struct(F.concat(last["tokens"], F.array(t["token"])).alias("tokens"), *((last[c] + t[c]).alias(c) for c in sums))
        begins = (F.size(groups) == 0) | _apart(last["bad"], last["labelled"], t["bad"], t["labelled"], alike)
        return F.when(begins, F.concat(groups, F.array(own))).otherwise(F.concat(F.slice(groups, 1, F.size(groups) - 1), F.array(both)))

    groups = F.aggregate(ranked, F.array().cast(GROUPS), take)
    plain = F.filter(tokens, lambda t: t["labelled"] == 0)
    rest = F.struct(F.transform(plain, lambda t: t["token"]).alias("tokens"),
                    F.aggregate(plain, F.lit(0).cast("long"), lambda n, t: n + t["kinds"]).alias("kinds"))
    labelled = F.transform(groups, lambda g: F.struct(g["tokens"].alias("tokens"), g["kinds"].alias("kinds")))
    return F.transform(F.concat(labelled, F.array(rest)), lambda g: F.struct(F.array_sort(g["tokens"]).alias("tokens"), g["kinds"].alias("kinds")))


def _common(a: Column, b: Column) -> Column:
    """The segments that two arrays both begin with."""
    size = F.least(F.size(a), F.size(b))
    same = F.transform(F.slice(a, 1, size), lambda x, i: x == F.get(b, i))
    differ = F.array_position(same, F.lit(False)).cast("int")
    return F.slice(a, 1, F.when(differ > 0, differ - 1).otherwise(size))


def _level(here: DataFrame, most: int, alike: float) -> DataFrame:
    """``here`` with ``template`` longer and ``segments``, those after it, fewer: by the
    next one, and by all that follow in every path where only one leads on."""
    here = here.withColumns({"segment": F.element_at("segments", 1), "rest": F.slice("segments", 2, F.size("segments"))}).drop("segments")
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    # what all have in common is what the lowest and the highest have
    branch = (here.groupBy("host", "template", "segment").agg(*sums, F.min("rest").alias("low"), F.max("rest").alias("high"))
              .withColumn("common", _common(F.col("low"), F.col("high"))).drop("low", "high"))
    node = (branch.groupBy("host", "template").agg(F.count("*").alias("branches"), F.sum("n").alias("node_n"))
            .withColumnsRenamed({"host": "of_host", "template": "of_template"}))
    rare = (F.col("branches") > most) & (F.col("n") * most < F.col("node_n"))
    token = cut(skew_join(branch, node, {"host": "of_host", "template": "of_template"})
                .withColumn("token", F.when(rare, F.lit("*")).otherwise(F.col("segment")))
                .select("host", "template", "segment", "token", "labelled", "bad", "common"))
    # at most most + 1 tokens to a node: the frequent ones and the wildcard
    kinds = token.groupBy("host", "template", "token").agg(*sums[1:], F.count("*").alias("kinds"))
    one = F.struct("token", *(F.col(c).cast("double").alias(c) for c in ("labelled", "bad")), "kinds")
    names = (kinds.groupBy("host", "template").agg(F.collect_list(one).alias("tokens"))
             .select(F.col("host").alias("m_host"), F.col("template").alias("m_template"), F.explode(_merged(F.col("tokens"), alike)).alias("g"))
             .select("m_host", "m_template", F.explode("g.tokens").alias("m_token"), F.array_join("g.tokens", "|").alias("branch"),
                     (F.col("g.kinds") == 1).alias("single")))
    longer = (skew_join(token.select("host", "template", "segment", "token", "common"), names,
                        {"host": "m_host", "template": "m_template", "token": "m_token"})
              .select(F.col("host").alias("l_host"), F.col("template").alias("l_template"), F.col("segment").alias("l_segment"), "branch",
                      F.when(F.col("single"), F.col("common")).otherwise(F.slice("common", 1, 0)).alias("common")))
    return cut(skew_join(here, longer, {"host": "l_host", "template": "l_template", "segment": "l_segment"})
               .select("host", "path", F.slice("rest", F.size("common") + 1, F.size("rest")).alias("segments"),
                       F.concat_ws("/", "template", "branch", "common").alias("template"), "n", "labelled", "bad"))


def path_templates(urls: DataFrame, most: int = MOST_BRANCHES, alike: float = ALIKE) -> DataFrame:
    """The template of each row of ``(host, path, n, labelled, bad)``: its columns and ``template``.

    A step takes all nodes one level down, and past the levels where they don't
    branch, until no path has a further segment.
    """
    here, done = urls.select("host", "path", segments(F.col("path")).alias("segments"), F.lit("").alias("template"), "n", "labelled", "bad"), []
    while not done or not here.isEmpty():
        moved = _level(here, most, alike)
        done.append(moved.where(F.size("segments") == 0).drop("segments"))
        here = moved.where(F.size("segments") > 0)
    return reduce(DataFrame.unionAll, done)


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[UrlRule, ...] = RULES,
                most: int = MOST_BRANCHES, alike: float = ALIKE, reject: float = REJECT) -> DataFrame:
    """A verdict on every URL: one row per input row with ``key``, ``host``,
    ``path``, ``rule`` (the longest that fits, like ``net/``, else null),
    ``verdict`` (block or allow: the rule's, else block where the template is
    rejected) and ``template``.

    The URLs with a rule are the labelled ones, bad if their rule blocks. A null
    URL or one without ``://`` has an empty host and path. Null keys and
    repeated rows stay as they are, and each row counts. Other columns are
    ignored; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    kinds = (rows.groupBy("host", "path").agg(F.count("*").alias("n"))
             .withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules, "verdict"))
             .select("host", "path", "n", F.when(F.col("ruled").isNotNull(), F.col("n")).otherwise(0).alias("labelled"),
                     F.when(F.col("ruled") == "block", F.col("n")).otherwise(0).alias("bad")))
    trees = path_templates(kinds, most, alike)
    share = (F.sum("bad") + 1) / (F.sum("labelled") + 2)
    judged = (trees.groupBy("host", "template").agg((share >= reject).alias("rejected"))
              .withColumnsRenamed({"host": "j_host", "template": "j_template"}))
    by_path = (skew_join(trees, judged, {"host": "j_host", "template": "j_template"})
               .select(F.col("host").alias("t_host"), F.col("path").alias("t_path"), "template", "rejected"))
    rule = lambda what: rule_of(F.col("host"), F.col("path"), rules, what)
    return (skew_join(rows, by_path, {"host": "t_host", "path": "t_path"})
            .select(F.col("key").alias(key), "host", "path", rule("name").alias("rule"),
                    F.coalesce(rule("verdict"), F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template"))


def filter_urls_sql(rules: tuple[UrlRule, ...] = RULES, levels: int = 4, most: int = MOST_BRANCHES, alike: float = ALIKE,
                    reject: float = REJECT) -> str:
    """DuckDB SQL for the rows of ``filter_urls`` on the table ``pages``, whose paths have at most ``levels`` segments."""
    chosen = sorted(rules, key=lambda r: (-len(r.name), r.name))

    def case(what: str) -> str:
        return "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
                                  f"THEN '{getattr(r, what)}'" for r in chosen) + " END"

    def apart(x: str, n: str, y: str, m: str) -> str:
        share = f"(({x} + {y}) / ({n} + {m}))"
        return f"({x} * {m} <> {y} * {n} AND abs({x} / {n} - {y} / {m}) >= {alike} * sqrt({share} * (1 - {share}) * (1 / {n} + 1 / {m})))"

    steps, last = [], "tree0"
    for level in range(levels):
        steps.append(f"""
here{level} AS (SELECT *, segs[{level + 1}] AS segment FROM {last} WHERE len(segs) > {level}),
branch{level} AS (
  SELECT host, template, segment, sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad FROM here{level} GROUP BY ALL),
token{level} AS (
  SELECT *, CASE WHEN count(*) OVER node > {most} AND n * {most} < sum(n) OVER node THEN '*' ELSE segment END AS token
  FROM branch{level} WINDOW node AS (PARTITION BY host, template)),
kind{level} AS (
  SELECT host, template, token, CAST(sum(labelled) AS DOUBLE) AS labelled, CAST(sum(bad) AS DOUBLE) AS bad FROM token{level} GROUP BY ALL),
ranked{level} AS (
  SELECT *, row_number() OVER (PARTITION BY host, template ORDER BY bad / labelled, token) AS r FROM kind{level} WHERE labelled > 0),
walk{level} AS (
  SELECT host, template, token, r, 1 AS g, labelled AS gl, bad AS gb FROM ranked{level} WHERE r = 1
  UNION ALL
  SELECT host, template, token, r, IF(far, g + 1, g), IF(far, labelled, gl + labelled), IF(far, bad, gb + bad)
  FROM (SELECT t.*, w.g, w.gl, w.gb, {apart("w.gb", "w.gl", "t.bad", "t.labelled")} AS far
        FROM walk{level} w JOIN ranked{level} t ON t.host = w.host AND t.template = w.template AND t.r = w.r + 1)),
place{level} AS (SELECT host, template, token, coalesce(g, 0) AS g FROM kind{level} LEFT JOIN walk{level} USING (host, template, token)),
name{level} AS (
  SELECT host, template, token, string_agg(token, '|') OVER (PARTITION BY host, template, g ORDER BY token
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS branch FROM place{level}),
tree{level + 1} AS (
  SELECT h.host, h.path, h.segs, h.template || '/' || x.branch AS template, h.n, h.labelled, h.bad
  FROM here{level} h JOIN token{level} t USING (host, template, segment)
  JOIN name{level} x ON x.host = t.host AND x.template = t.template AND x.token = t.token
  UNION ALL SELECT host, path, segs, template, n, labelled, bad FROM {last} WHERE len(segs) <= {level}),""")
        last = f"tree{level + 1}"
    return f"""
WITH RECURSIVE url AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
ruled AS (SELECT *, {case("name")} AS rule, {case("verdict")} AS said FROM url),
tree0 AS (
  SELECT host, path, string_split(regexp_replace(path, '^/', ''), '/') AS segs, '' AS template, count(*) AS n,
         count(said) AS labelled, count(*) FILTER (said = 'block') AS bad FROM ruled GROUP BY host, path),
{"".join(steps)}
judged AS (SELECT host, template, (sum(bad) + 1) / (sum(labelled) + 2) >= {reject} AS rejected FROM {last} GROUP BY ALL)
SELECT page_id, r.host, r.path, rule, coalesce(said, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM ruled r JOIN {last} t ON r.host = t.host AND r.path = t.path JOIN judged j ON t.host = j.host AND t.template = j.template
"""
