"""The named queries of this subpackage: one for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbook.llm.chat_repair import repair_conversations
from tillbook.llm.collocations import collocations
from tillbook.llm.contain import contained_items
from tillbook.llm.langid import held_out, identify, learn
from tillbook.llm.line_dedup import dedup_lines
from tillbook.llm.lm_score import score_documents
from tillbook.llm.packing import pack_documents
from tillbook.llm.pstable import near_vectors
from tillbook.llm.ranked_search import search
from tillbook.llm.secret_scan import RULES, scan_secrets
from tillbook.llm.simhash import simhash_components
from tillbook.llm.substrings import dedup_substrings
from tillbook.llm.url_templates import filter_urls, filter_urls_sql
from tillbook.sources.tables import load


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(load(spark, sf_dir, "documents"), "doc_id", "text", words=3, radius=2)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels")
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    return score_documents(load(spark, sf_dir, "documents"), good)


def op3_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(load(spark, sf_dir, "conversations"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(load(spark, sf_dir, "pages"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", similarity=0.98)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"), capacity=2048, tokenizer="byte_bpe_50k")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(load(spark, sf_dir, "documents"))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["rule"] < 3)
    count = lambda n: F.size(F.filter("spans", lambda s: s["rule"] == n)).cast("long").alias(f"n_{RULES[n].kind}")
    return found.select("doc_id", *map(count, range(3)), F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs, ~held_out(F.col("doc_id")))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents"), least=100, top=2000)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_substrings(load(spark, sf_dir, "documents"), window=50)
            .select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")))


_KINDS = "['assign', 'access', 'hex', 'github', 'slack', 'google', 'stripe', 'jwt', 'pem']"


def _span_sql(rule: int) -> str:
    """Spans of one rule: the text between the matches and the matches give their places."""
    r = RULES[rule]
    regex = r.regex.replace("(?i)", "").replace("'", "''")
    flag = ", 'i'" if "(?i)" in r.regex else ""
    return f"""
      SELECT doc_id, {rule} AS rule, unnest(list_transform(range(1, len(hit) + 1), lambda i: struct_pack(
               e := list_sum(list_transform(gap[1:i], lambda x: length(x))) + list_sum(list_transform(hit[1:i], lambda x: length(x))),
               n := length(hit[i]), body := length(body[i])))) AS s
      FROM (SELECT doc_id, regexp_split_to_array(text, '{regex}'{flag}) AS gap,
                   regexp_extract_all(text, '{regex}', 0{flag}) AS hit,
                   regexp_extract_all(text, '{regex}', {r.body}{flag}) AS body FROM documents WHERE text IS NOT NULL)
      WHERE len(hit) > 0"""


_OP8_SQL = f"""
WITH found AS ({" UNION ALL ".join(_span_sql(n) for n in range(len(RULES)))}),
good AS (SELECT doc_id, rule, CAST(s.e - s.n AS BIGINT) AS start, concat_ws(':', ({_KINDS})[rule + 1], CAST(s.e - s.n AS BIGINT), CAST(s.e AS BIGINT)) AS name
         FROM found WHERE s.body >= ({[r.least for r in RULES]})[rule + 1]),
by_doc AS (SELECT doc_id, count(*) FILTER (rule = 0) AS a, count(*) FILTER (rule = 1) AS b, count(*) FILTER (rule = 2) AS c,
                  string_agg(name, ',' ORDER BY start, rule) FILTER (rule < 3) AS base,
                  string_agg(name, ',' ORDER BY start, rule) AS every FROM good GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM documents d LEFT JOIN by_doc USING (doc_id)
"""

_OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS place, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP5_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN counts USING (vec_id)
"""

_OP6_SQL = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE text IS NOT NULL),
words AS (
  SELECT side, id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', ' ', 'g'), '[\x09-\x0D\x20]+'),
                               lambda w: w <> '') AS w FROM texts),
shingles AS (
  SELECT DISTINCT side, id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: w[i:i + 4])) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT id AS item_id, count(*) AS n_item FROM shingles WHERE side = 'b' GROUP BY id),
overlap AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared
  FROM shingles d JOIN shingles b ON d.s = b.s WHERE d.side = 'd' AND b.side = 'b' GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item FROM overlap JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_item
"""

_OP11_SQL = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
terms AS (
  SELECT side, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM texts WHERE text IS NOT NULL),
freqs AS (SELECT side, id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT id, sum(tf)::BIGINT AS n FROM freqs WHERE side = 'd' GROUP BY id),
size AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM freqs, size WHERE side = 'd' GROUP BY term, big_n),
scores AS (
  SELECT b.id AS item_id, d.id AS doc_id,
         sum(b.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM freqs b JOIN freqs d USING (term) JOIN weights USING (term) JOIN lengths ON lengths.id = d.id CROSS JOIN size
  WHERE b.side = 'b' AND d.side = 'd' GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

_OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, unnest([1, 2, 3, 4, 5]) AS ks(k) WHERE len(w) >= k)),
freq AS (SELECT lang, k AS size, p, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::HUGEINT AS n FROM freq WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, p, string_split(p, ' ') AS w, f AS a FROM freq WHERE size >= 2 AND f >= 100),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score, n
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN freq x ON x.lang = c.lang AND x.size = k AND x.p = array_to_string(c.w[1:k], ' ')
  JOIN freq y ON y.lang = c.lang AND y.size = c.size - k AND y.p = array_to_string(c.w[k + 1:c.size], ' ')
  JOIN total ON total.lang = c.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS p, c.a
  FROM (SELECT *, unnest(range(1, size - s + 2)) AS i FROM candidates, unnest([2, 3, 4]) AS ss(s) WHERE s < size) c)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM least ANTI JOIN inner_parts USING (lang, p, a) QUALIFY rank <= 2000
"""

_OP13_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (s) WHERE first_id < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words) ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

#: name -> (query, SQL that gives the same rows, or None where SQL can't express it)
QUERIES = {
    "op1_simhash": (op1_simhash, None),
    "op2_lm_score": (op2_lm_score, None),
    "op3_chat_repair": (op3_chat_repair, None),
    "op4_url_templates": (op4_url_templates, filter_urls_sql()),
    "op5_embedding_dedup": (op5_embedding_dedup, _OP5_SQL),
    "op6_decontamination": (op6_decontamination, _OP6_SQL),
    "op7_best_fit_packing": (op7_best_fit_packing, None),
    "op8_secret_scan": (op8_secret_scan, _OP8_SQL),
    "op9_line_dedup": (op9_line_dedup, _OP9_SQL),
    "op10_language_id": (op10_language_id, None),
    "op11_ranked_search": (op11_ranked_search, _OP11_SQL),
    "op12_collocations": (op12_collocations, _OP12_SQL),
    "op13_substring_dedup": (op13_substring_dedup, _OP13_SQL),
}
