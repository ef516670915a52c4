"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from groundplan.llm.bpe import op3_byte_bpe
from groundplan.llm.chat import op9_chat_turns
from groundplan.llm.divergence import op13_source_divergence
from groundplan.llm.license_scan import op5_license_scan
from groundplan.llm.minhash import op2_near_duplicates
from groundplan.llm.ngram_join import op11_ngram_jaccard
from groundplan.llm.packing import op4_packing
from groundplan.llm.periodic import op12_periodic_runs
from groundplan.llm.pii import op1_pii_pseudonyms
from groundplan.llm.quality import op8_quality_classifier
from groundplan.llm.rules import op10_quality_rules
from groundplan.llm.topk import op7_topk_search
from groundplan.llm.warc import op6_warc_derivatives

QUERIES = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_packing": op4_packing,
    "op5_license_scan": op5_license_scan,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_topk_search": op7_topk_search,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_turns": op9_chat_turns,
    "op10_quality_rules": op10_quality_rules,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL = {
    "op7_topk_search": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op10_quality_rules": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM dup, range(5) AS r(o) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^!|{}\[\]=_~^\\/@]', '', 'g')) AS n_marks,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_twice_running
  FROM w LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, (n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (word_chars < 2 * n_words)::INT + 16 * (word_chars > 15 * n_words)::INT + 32 * (10 * n_dup_lines > 5 * n_lines)::INT
    + 64 * (10 * n_upper > 4 * word_chars AND n_words >= 10)::INT + 128 * (2 * n_marks > n_words)::INT
    + 256 * (10 * n_twice_running > 3 * n_words)::INT + 512 * (n_words > 1000000)::INT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed,
       (failures & 511) = 0 AS kept, failures::BIGINT AS failures FROM f
""",
    "op11_ngram_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS gs FROM w),
e AS (SELECT doc_id, len(gs) AS n, hash(unnest(gs)) AS s FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
t AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(doc_id, other) AS (SELECT a, a FROM t UNION SELECT r.doc_id, t.b FROM r JOIN t ON r.other = t.a),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(gs)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM g LEFT JOIN c USING (doc_id)
""",
    "op13_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT k) AS docs FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT g.lang, g.source, kept.term, kept.n AS all_n, coalesce(c.n, 0)::HUGEINT AS n
          FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cells GROUP BY ALL),
p AS (SELECT lang, source, term, cells.n, 1 + 1000000000::HUGEINT * (cells.n + 2) // (total + 2 * v) AS p, 1 + 1000000000::HUGEINT * (all_n + 2) // (v.n + 2 * v) AS q
      FROM cells JOIN tot USING (lang, source) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
          UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
""",
}
