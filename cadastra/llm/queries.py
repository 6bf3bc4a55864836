"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from cadastra.llm.code_search import op5_hamming_top_k
from cadastra.llm.line_dedup import op2_line_dedup
from cadastra.llm.mixing import op3_mix_sources
from cadastra.llm.packing import op4_best_fit_packing
from cadastra.llm.pii import op6_pii_semi_markov
from cadastra.llm.quality_classifier import op9_quality_classifier
from cadastra.llm.quality_rules import op8_quality_rules
from cadastra.llm.secret_scan import op1_secret_scan
from cadastra.llm.simhash import op10_simhash_near_dedup
from cadastra.llm.substring_dedup import op7_substring_dedup

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_hamming_top_k": op5_hamming_top_k,
    "op6_pii_semi_markov": op6_pii_semi_markov,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
}

WORDS = r"[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"

#: The other queries hold a model, a tokenizer, a hash function or an optimiser that SQL has not; their tests compare them
#: with brute force, bounds or held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op5_hamming_top_k": """
WITH flat AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
bits AS (SELECT id, (i - 1) % 64 AS b, sum(CASE WHEN x IS NULL OR isnan(x) THEN 0 ELSE x END) > 0 AS bit FROM flat GROUP BY 1, 2),
pairs AS (SELECT q.id AS query_id, n.id AS neighbour_id, sum((q.bit <> n.bit)::INT)::INT AS distance
  FROM bits q JOIN bits n USING (b) WHERE q.id % 100 = 0 AND q.id <> n.id GROUP BY 1, 2),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INT AS rank, neighbour_id, distance FROM pairs)
SELECT * FROM ranked WHERE rank <= 10""",
    "op7_substring_dedup": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
places AS (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS p FROM docs WHERE len(w) >= 35),
windows AS (SELECT r, p, md5(array_to_string(list_slice(w, p, p + 34), ' ')) AS h FROM places),
hit AS (SELECT r, p FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, p + j AS p FROM hit, range(35) AS t(j)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (r)""",
    "op8_quality_rules": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS w,
  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS l FROM documents),
places AS (SELECT r, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS s, p FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS p FROM docs WHERE len(w) >= 3)),
twice AS (SELECT r, s FROM places GROUP BY 1, 2 HAVING count(*) > 1),
repeated AS (SELECT r, count(DISTINCT p + j) AS n FROM places JOIN twice USING (r, s), range(3) AS t(j) GROUP BY r),
base AS (SELECT r, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines FROM docs LEFT JOIN repeated USING (r)),
long AS (SELECT r, lang, source, n_words, n_lines, unnest(['symbol_ratio', 'dup_line_ratio', 'repeat_ratio', 'mean_word_chars']) AS m,
  unnest([n_symbols / n_words, n_dup_lines / n_lines, n_repeat_words / n_words, word_chars / n_words]) AS x FROM base WHERE n_words > 0),
cut AS (SELECT *, floor(x * 1048576)::BIGINT AS v FROM long),
filed AS (SELECT *, v // (1 << greatest(length(bin(v)) - 7, 0)) * (1 << greatest(length(bin(v)) - 7, 0)) AS b FROM cut),
own AS (SELECT lang, source, m, count(*) AS n, list(b ORDER BY b) AS bs FROM filed GROUP BY 1, 2, 3),
langs AS (SELECT lang, m, count(*) AS n, list(b ORDER BY b) AS bs FROM filed GROUP BY 1, 2),
overall AS (SELECT m, count(*) AS n, list(b ORDER BY b) AS bs FROM filed GROUP BY 1),
parts(k) AS (VALUES (1), (2), (3)),
q_all AS (SELECT m, k, bs[((n * k + 3) // 4)] / 1048576.0::DOUBLE AS q FROM overall, parts),
q_lang AS (SELECT lang, m, k, (l.n * (bs[((l.n * k + 3) // 4)] / 1048576.0::DOUBLE) + 200.0::DOUBLE * q) / (l.n + 200.0::DOUBLE) AS q FROM langs l CROSS JOIN parts JOIN q_all USING (m, k)),
q_own AS (SELECT o.lang, o.source, o.m, parts.k AS k, (o.n * (bs[((o.n * parts.k + 3) // 4)] / 1048576.0::DOUBLE) + 200.0::DOUBLE * q) / (o.n + 200.0::DOUBLE) AS q
  FROM own o CROSS JOIN parts JOIN q_lang g ON g.k = parts.k AND g.m = o.m AND g.lang IS NOT DISTINCT FROM o.lang),
wide AS (SELECT lang, source, m, max(CASE WHEN k = 1 THEN q END) AS q25, max(CASE WHEN k = 2 THEN q END) AS q50, max(CASE WHEN k = 3 THEN q END) AS q75 FROM q_own GROUP BY 1, 2, 3),
judged AS (SELECT r, x, q50, m, greatest(6.0::DOUBLE * (q75 - q25), CASE WHEN m = 'mean_word_chars' THEN 2.0::DOUBLE * q50 ELSE 1.0::DOUBLE END / sqrt(CASE WHEN m IN ('symbol_ratio', 'mean_word_chars') THEN n_words ELSE n_lines END)) AS width
  FROM long JOIN wide USING (m) WHERE long.lang IS NOT DISTINCT FROM wide.lang AND long.source IS NOT DISTINCT FROM wide.source),
verdict AS (SELECT r, bool_and(x <= q50 + width AND (m <> 'mean_word_chars' OR x >= q50 - width)) AS inside FROM judged GROUP BY r),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  base_failed, NOT base_failed AND coalesce(inside, true) AS kept FROM failed LEFT JOIN verdict USING (r)""",
}
