"""DuckDB SQL for the queries of the catalog, over the same sample tables."""

from __future__ import annotations

CASES = """
cases AS (
  SELECT cast(doc_id AS varchar) AS case_id, text, lang AS issue, source AS product,
         DATE '2020-01-01' + cast(doc_id % 730 AS integer) AS received, doc_id AS ingest_pos
  FROM documents)"""


# Inside of a regex class that matches the Unicode whitespace code points.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def is_usable(column: str) -> str:
    return f"{column} IS NOT NULL AND regexp_matches({column}, '[^{SPACE}]') AND lower({column}) <> 'nan'"


def usable(source: str, label: bool = False) -> str:
    tests = [is_usable(column) for column in (["text", "issue"] if label else ["text"])]
    return f"usable AS (SELECT * FROM {source} WHERE {' AND '.join(tests)})"


def split_of(source: str) -> str:
    """Positions in (received, case_id) order, cut at 70 and 85 percent in double arithmetic."""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (ORDER BY received, case_id) - 1 AS r, count(*) OVER () AS total
  FROM {source} WHERE received IS NOT NULL),
bounded AS (
  SELECT *, cast(floor(total * 0.70::double) AS bigint) AS te,
         cast(floor(total * 0.70::double) AS bigint) + cast(floor(total * 0.15::double) AS bigint) AS ve
  FROM ranked),
splits AS (
  SELECT *, CASE WHEN r < te THEN 'train' WHEN r < ve THEN 'val' ELSE 'test' END AS split,
         CASE WHEN r < te THEN r WHEN r < ve THEN r - te ELSE r - ve END AS pos
  FROM bounded)"""


BASE = f"WITH {CASES}, {usable('cases', label=True)}"
LISTED = f"WITH {CASES}, {usable('cases')}, {split_of('usable')}"
WORDS = f"len(regexp_extract_all(text, '[^{SPACE}]+'))"
LENGTHS = f"lengths AS (SELECT *, length(text) AS chars, {WORDS} AS words FROM usable)"

ORACLES: dict[str, str] = {}


ORACLES["usable_cases"] = f"""
{BASE}, {LENGTHS}
SELECT case_id, cast(chars AS bigint) AS text_len_chars, cast(words AS bigint) AS text_len_words FROM lengths"""

for _key, _column in (("top_issues", "issue"), ("top_products", "product")):
    ORACLES[_key] = f"""
{BASE}
SELECT {_column} AS label, count(*) AS n,
       round(count(*) / greatest((SELECT count(*) FROM usable), 1) * 100.0, 6) AS percent
FROM usable GROUP BY 1 ORDER BY n DESC, label ASC NULLS LAST LIMIT 10"""

ORACLES["length_percentiles"] = f"""
{BASE}, {LENGTHS}
SELECT 'chars' AS facet, round(quantile_cont(chars, 0.1), 6) AS p10, round(quantile_cont(chars, 0.5), 6) AS p50,
       round(quantile_cont(chars, 0.9), 6) AS p90 FROM lengths
UNION ALL
SELECT 'words', round(quantile_cont(words, 0.1), 6), round(quantile_cont(words, 0.5), 6),
       round(quantile_cont(words, 0.9), 6) FROM lengths"""

SUMMARY = """
summary AS (
  SELECT count(*) AS rows_loaded_after_skip,
         strftime(min(received), '%Y-%m-%d %H:%M:%S') AS date_min,
         strftime(max(received), '%Y-%m-%d %H:%M:%S') AS date_max,
         quantile_cont(chars, 0.1) AS text_chars_p10, quantile_cont(chars, 0.5) AS text_chars_p50,
         quantile_cont(chars, 0.9) AS text_chars_p90,
         quantile_cont(words, 0.1) AS text_words_p10, quantile_cont(words, 0.5) AS text_words_p50,
         quantile_cont(words, 0.9) AS text_words_p90,
         count(DISTINCT product) AS num_unique_products, count(DISTINCT issue) AS num_unique_issues
  FROM lengths)"""

ORACLES["eda_summary"] = f"{BASE}, {LENGTHS}, {SUMMARY} SELECT * FROM summary"

ORACLES["monthly_counts"] = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
WHERE o_orderdate IS NOT NULL GROUP BY 1 ORDER BY 1"""

ORACLES["monthly_case_counts"] = f"""
{BASE} SELECT strftime(received, '%Y-%m') AS month, count(*) AS n FROM usable GROUP BY 1"""

ORACLES["length_histogram"] = f"""
{BASE}, {LENGTHS},
clipped AS (SELECT least(cast(words AS double), (SELECT quantile_cont(words, 0.99) FROM lengths)) AS w FROM lengths),
span AS (SELECT min(w) AS low, (max(w) - min(w)) / 50.0 AS width FROM clipped),
counted AS (
  SELECT least(cast(floor((w - low) / width) AS integer), 49) AS bin, count(*) AS n FROM clipped, span GROUP BY 1)
SELECT cast(b.bin AS integer) AS bin, round(low + b.bin * width, 6) AS bin_start,
       cast(coalesce(n, 0) AS bigint) AS n
FROM (SELECT unnest(range(50)) AS bin) b CROSS JOIN span LEFT JOIN counted c ON c.bin = b.bin"""

COVERAGE = """
coverage AS (
  SELECT 'issue' AS facet, sum(n) / (SELECT count(*) FROM usable) AS coverage
  FROM (SELECT issue, count(*) AS n FROM usable GROUP BY 1 ORDER BY n DESC, issue NULLS LAST LIMIT 10)
  UNION ALL
  SELECT 'product', sum(n) / (SELECT count(*) FROM usable)
  FROM (SELECT product, count(*) AS n FROM usable GROUP BY 1 ORDER BY n DESC, product NULLS LAST LIMIT 10))"""

ORACLES["top_coverage"] = f"{BASE}, {COVERAGE} SELECT facet, round(coverage, 6) AS coverage FROM coverage"

ORACLES["eda_report"] = f"""
{BASE}, {LENGTHS}, {SUMMARY}, {COVERAGE}
SELECT 0 AS ln, format('Usable narratives (after robust parsing + filtering): N = {{}}', rows_loaded_after_skip) AS value FROM summary
UNION ALL SELECT 1, format('Time coverage: {{}} to {{}}', date_min, date_max) FROM summary
UNION ALL SELECT 2, format('Narrative length (words): P10={{:.1f}}, P50={{:.1f}}, P90={{:.1f}}',
  text_words_p10, text_words_p50, text_words_p90) FROM summary
UNION ALL SELECT 3, format('Narrative length (chars): P10={{:.1f}}, P50={{:.1f}}, P90={{:.1f}}',
  text_chars_p10, text_chars_p50, text_chars_p90) FROM summary
UNION ALL SELECT 4, format('Label space size: #Products={{}}, #Issues={{}}', num_unique_products, num_unique_issues) FROM summary
UNION ALL SELECT 5, format('Top-10 Issue coverage: {{:.2f}}% of narratives', coverage * 100) FROM coverage WHERE facet = 'issue'
UNION ALL SELECT 6, format('Top-10 Product coverage: {{:.2f}}% of narratives', coverage * 100) FROM coverage WHERE facet = 'product'"""

ORACLES["capped_cases"] = f"""
WITH {CASES}, first_rows AS (SELECT * FROM cases WHERE ingest_pos < 200), {usable('first_rows')}
SELECT case_id, issue, ingest_pos FROM usable"""

FLAT = f"trim(regexp_replace(text, '[{SPACE}]+', ' ', 'g'))"


def shorten(flat: str, n: int) -> str:
    return f"CASE WHEN length({flat}) > {n} THEN substring({flat}, 1, {n}) || '...' ELSE {flat} END"


ORACLES["snippets"] = f"""
WITH {CASES}, flat AS (SELECT case_id, {FLAT} AS flat FROM cases)
SELECT case_id, {shorten('flat', 220)} AS snippet_220, {shorten('flat', 350)} AS snippet_350 FROM flat"""

ORACLES["chronological_split"] = f"""
{LISTED} SELECT case_id, split, pos, cast(1 AS bigint) AS n FROM splits"""

STATS = """
SELECT split, count(*) AS n, strftime(min(received), '%Y-%m-%d %H:%M:%S') AS date_min,
       strftime(max(received), '%Y-%m-%d %H:%M:%S') AS date_max
FROM splits GROUP BY 1"""

ORACLES["split_stats"] = f"{LISTED} {STATS}"

ORACLES["order_split_stats"] = f"""
WITH o AS (SELECT cast(o_orderkey AS varchar) AS case_id, o_orderdate AS received FROM orders), {split_of('o')} {STATS}"""

ORACLES["attach_split"] = f"""
{LISTED}
SELECT case_id, issue, split FROM splits
WHERE {is_usable('issue')}"""

ORACLES["attach_split_by_id"] = f"""
{LISTED} SELECT case_id, quality, toxic, split FROM labels JOIN splits ON case_id = cast(labels.doc_id AS varchar)"""

TURNS = f"""
WITH turns AS (
  SELECT cast(conv_id AS varchar) AS case_id, DATE '2020-01-01' + cast(conv_id % 730 AS integer) AS received,
         text, conv_id * 1000000 + turn AS ingest_pos FROM conversations),
{usable('turns')}, {split_of('usable')}"""

ORACLES["repeated_id_split"] = f"""
{TURNS} SELECT case_id, split, min(pos) AS pos, count(*) AS n FROM splits GROUP BY case_id, split"""

LAST = """last AS (
  SELECT case_id, arg_max(split, CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END) AS split
  FROM splits GROUP BY 1)"""

ORACLES["repeated_id_attach"] = f"""
{TURNS}, {LAST} SELECT u.case_id, u.ingest_pos, l.split FROM usable u JOIN last l USING (case_id)"""

ORACLES["latest_text_per_id"] = f"""
{TURNS}, texts AS (SELECT case_id, arg_max(text, ingest_pos) AS text FROM usable GROUP BY 1),
runs AS (SELECT case_id, split, count(*) AS n FROM splits GROUP BY 1, 2)
SELECT case_id, split, n, text FROM runs JOIN texts USING (case_id)"""

BM25 = f"""
{LISTED},
docs AS (SELECT case_id, received, text, regexp_extract_all(lower(text), '[a-z0-9]+') AS tokens FROM splits WHERE split = 'train'),
sizes AS (SELECT count(*) AS total, avg(len(tokens)) AS mean_length FROM docs),
postings AS (
  SELECT case_id, term, count(*) AS tf FROM (SELECT case_id, unnest(tokens) AS term FROM docs) GROUP BY 1, 2),
raw AS (
  SELECT term, count(*) AS df, ln(total - count(*) + 0.5) - ln(count(*) + 0.5) AS raw_idf
  FROM postings, sizes GROUP BY term, total),
terms AS (
  SELECT term, df, CASE WHEN raw_idf < 0 THEN 0.25 * (SELECT avg(raw_idf) FROM raw) ELSE raw_idf END AS idf
  FROM raw)"""

ORACLES["bm25_corpus_stats"] = f"{BM25} SELECT term, df, round(idf, 6) AS idf FROM terms"

BM25_MATCHED = f"""
{BM25},
asked AS (SELECT case_id AS query_id, text FROM splits WHERE split = 'test' ORDER BY received, case_id LIMIT 2),
query_terms AS (
  SELECT query_id, term, count(*) AS qtf
  FROM (SELECT query_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM asked) GROUP BY 1, 2),
matched AS (
  SELECT query_id, case_id, sum(qtf * idf * tf * 2.5 /
         (tf + 1.5 * (0.25 + 0.75 * len(tokens) / mean_length))) AS score
  FROM query_terms JOIN terms USING (term) JOIN postings USING (term) JOIN docs USING (case_id), sizes
  GROUP BY 1, 2)"""

BM25_HITS = f"""
{BM25_MATCHED},
scored AS (
  SELECT a.query_id, a.text AS query_text, d.case_id AS hit_id, d.received, d.text AS hit_text, coalesce(m.score, 0.0) AS score
  FROM asked a CROSS JOIN docs d LEFT JOIN matched m ON m.query_id = a.query_id AND m.case_id = d.case_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, received, hit_id) AS place
  FROM scored),
hits AS (
  SELECT query_id, {FLAT.replace('text', 'query_text')} AS query_flat, cast(place AS integer) AS rank, hit_id,
         round(score, 6) AS bm25_score, {FLAT.replace('text', 'hit_text')} AS hit_flat
  FROM placed WHERE place <= 5)"""

ORACLES["bm25_topk"] = f"""
{BM25_HITS}
SELECT query_id, {shorten('query_flat', 220)} AS query_snippet, rank, hit_id, bm25_score,
       {shorten('hit_flat', 220)} AS hit_snippet FROM hits"""

# 200 questions, with the lengths instead of the tokens of a document in the large join.
BM25_QUESTIONS = (
    BM25_MATCHED.replace("LIMIT 2)", "LIMIT 200)")
    .replace("JOIN docs USING (case_id)", "JOIN (SELECT case_id, len(tokens) AS n FROM docs) USING (case_id)")
    .replace("0.75 * len(tokens)", "0.75 * n")
)

ORACLES["bm25_questions"] = f"""
{BM25_QUESTIONS},
placed AS (
  SELECT a.case_id AS query_id, d.case_id AS hit_id, coalesce(m.score, 0.0) AS score,
         row_number() OVER (PARTITION BY a.case_id ORDER BY round(coalesce(m.score, 0.0), 9) DESC, received, d.case_id) AS place
  FROM (SELECT query_id AS case_id FROM asked) a CROSS JOIN (SELECT case_id, received FROM docs) d
  LEFT JOIN matched m ON m.query_id = a.case_id AND m.case_id = d.case_id)
SELECT query_id, cast(place AS integer) AS rank, hit_id, round(score, 6) AS bm25_score
FROM placed WHERE place <= 5"""

ORACLES["bm25_nested_hits"] = f"""
{BM25_HITS}
SELECT query_id, {shorten('query_flat', 220)} AS query_snippet, string_agg(hit_id, ',' ORDER BY rank) AS hit_ids
FROM hits GROUP BY query_id, query_flat"""

VOCABULARY = f"""
{LISTED},
labelled AS (
  SELECT * FROM splits
  WHERE {is_usable('issue')}),
tokenized AS (
  SELECT case_id, split, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM labelled),
grams AS (
  SELECT case_id, split, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tokenized),
counted AS (SELECT case_id, split, term, count(*) AS n FROM grams GROUP BY 1, 2, 3),
train_size AS (SELECT count(*) AS total FROM labelled WHERE split = 'train'),
vocabulary AS (
  SELECT term, count(*) AS df, cast(sum(n) AS bigint) AS tf, ln((1.0 + total) / (1.0 + count(*))) + 1.0 AS idf
  FROM counted, train_size WHERE split = 'train' GROUP BY term, total
  HAVING count(*) >= 3 AND count(*) <= 0.9::double * total
  ORDER BY tf DESC, term LIMIT 100000),
raw_weights AS (
  SELECT case_id, split, term, (1.0 + ln(n)) * idf AS w FROM counted JOIN vocabulary USING (term)),
weights AS (
  SELECT case_id, split, term, w / sqrt(sum(w * w) OVER (PARTITION BY case_id)) AS weight FROM raw_weights)"""

ORACLES["tfidf_vocabulary"] = f"{VOCABULARY} SELECT term, df, tf, round(idf, 6) AS idf FROM vocabulary"

ORACLES["tfidf_weights"] = f"{VOCABULARY} SELECT case_id, term, round(weight, 6) AS weight FROM weights"

ORACLES["matrix_stats"] = f"""
{VOCABULARY}
SELECT (SELECT total FROM train_size) AS n_rows, (SELECT count(*) FROM vocabulary) AS n_cols,
       count(*) AS nnz FROM weights WHERE split = 'train'"""

ORACLES["train_label_count"] = f"""
{LISTED}
SELECT count(*) AS train_rows, count(DISTINCT issue) AS distinct_issues FROM splits
WHERE split = 'train' AND issue IS NOT NULL AND lower(issue) <> 'nan'"""

VECTORS = f"""
WITH vectors AS (
  SELECT vec_id, cast(vec_id AS varchar) AS case_id, DATE '2020-01-01' + cast(vec_id % 730 AS integer) AS received,
         cast(label AS varchar) AS issue, cast(embedding AS double[]) AS embedding FROM embeddings),
{split_of('vectors')}"""

EVIDENCE = f"""
{VECTORS},
texts AS (SELECT doc_id, {FLAT} AS flat FROM documents),
pairs AS (
  SELECT q.case_id AS query_id, q.split AS query_split, t.vec_id AS hit_pos, t.case_id AS hit_id, t.issue AS hit_issue,
         list_dot_product(q.embedding, t.embedding) / (sqrt(list_dot_product(q.embedding, q.embedding))
           * sqrt(list_dot_product(t.embedding, t.embedding))) AS sim
  FROM splits q JOIN splits t ON t.split = 'train' AND NOT (q.split = 'train' AND q.case_id = t.case_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, hit_pos) AS place FROM pairs),
evidence AS (
  SELECT query_id, query_split, cast(place AS integer) AS rank, hit_id, hit_issue, sim AS cosine_similarity,
         coalesce({shorten('flat', 350)}, '') AS hit_snippet
  FROM placed LEFT JOIN texts ON doc_id = hit_pos WHERE place <= 3)"""

ORACLES["ivf_full_probe"] = f"""
{EVIDENCE}
SELECT query_id, query_split, rank, hit_id, hit_issue, round(cosine_similarity, 6) AS cosine_similarity, hit_snippet
FROM evidence"""

ORACLES["ivf_split_cells"] = ORACLES["ivf_full_probe"]

ORACLES["ivf_recall"] = f"""
{EVIDENCE}
SELECT query_split, count(DISTINCT query_id) AS n_queries, count(*) AS n_exact, true AS met_most
FROM evidence GROUP BY 1"""

VOTES = f"""
{EVIDENCE},
ballots AS (SELECT query_id, hit_issue, count(*) AS n, min(rank) AS seen FROM evidence GROUP BY 1, 2),
winners AS (
  SELECT query_id, hit_issue FROM ballots
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, seen) = 1),
votes AS (
  SELECT e.query_id AS case_id, arg_min(e.hit_issue, e.rank) AS retrieval_top1_issue,
         any_value(w.hit_issue) AS retrieval_vote_issue,
         count(*) = 3 AND count(DISTINCT e.hit_issue) = 1 AS top3_all_agree
  FROM evidence e JOIN winners w USING (query_id) GROUP BY e.query_id)"""

ORACLES["knn_votes"] = f"{VOTES} SELECT * FROM votes"

ORACLES["augmented_text"] = f"""
{EVIDENCE},
lines AS (
  SELECT query_id, string_agg(format('Similar case {{}}. Issue: {{}}. Narrative: {{}}', rank, hit_issue, hit_snippet),
         chr(10) ORDER BY rank) AS hits FROM evidence GROUP BY 1)
SELECT s.case_id, s.split, 'Query narrative: ' || coalesce(d.text, '') || chr(10) || chr(10) || 'Retrieved evidence:' || chr(10)
       || coalesce(hits, '') AS augmented_text
FROM splits s LEFT JOIN documents d ON d.doc_id = s.vec_id LEFT JOIN lines ON query_id = s.case_id"""

PREDICTIONS = """
preds AS (
  SELECT case_id, split, issue, cast((vec_id // 10) % 10 AS varchar) AS pred_issue FROM splits WHERE split <> 'train')"""

MERGED = f"""
{VOTES}, {PREDICTIONS},
merged AS (
  SELECT p.*, v.retrieval_top1_issue, v.retrieval_vote_issue, v.top3_all_agree,
         CASE WHEN coalesce(v.top3_all_agree, false) THEN v.retrieval_vote_issue ELSE p.pred_issue END AS hybrid_pred_issue
  FROM preds p LEFT JOIN votes v USING (case_id))"""

ORACLES["hybrid_override"] = f"{MERGED} SELECT * FROM merged"


def scores(name: str, source: str, pred: str) -> str:
    """Per-class and per-split scores of one prediction column."""
    return f"""
{name}_classes AS (
  SELECT split, label, count(*) FILTER (role = 't') AS support, count(*) FILTER (role = 'p') AS predicted,
         count(*) FILTER (role = 't' AND hit) AS tp
  FROM (SELECT split, issue AS label, 't' AS role, issue = {pred} AS hit FROM {source}
        UNION ALL SELECT split, {pred}, 'p', false FROM {source})
  GROUP BY 1, 2),
{name}_f1 AS (SELECT *, 2.0 * tp / (support + predicted) AS f1 FROM {name}_classes),
{name} AS (
  SELECT split, cast(sum(support) AS bigint) AS n, sum(tp) / sum(support) AS accuracy,
         cast(sum(cast(f1 AS decimal(20, 12))) AS double) / count(*) AS macro_f1,
         cast(sum(cast(f1 AS decimal(20, 12)) * cast(support AS decimal(12, 0))) AS double) / sum(support) AS weighted_f1
  FROM {name}_f1 GROUP BY 1)"""


ROUNDED = "round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1"

ORACLES["split_metrics"] = f"""
{VECTORS}, {PREDICTIONS}, {scores('base', 'preds', 'pred_issue')}
SELECT split, n, {ROUNDED} FROM base"""

HYBRID = f"""
{MERGED}, {scores('hybrid', 'merged', 'hybrid_pred_issue')},
rates AS (SELECT split, avg(coalesce(top3_all_agree, false)::integer) AS rate FROM merged GROUP BY 1)"""

ORACLES["hybrid_metrics"] = f"""
{HYBRID} SELECT split, n, round(rate, 6) AS retrieval_override_rate, {ROUNDED} FROM hybrid JOIN rates USING (split)"""

COMPARISON = f"""
{HYBRID}, {scores('base', 'preds', 'pred_issue')},
voted_preds AS (SELECT p.case_id, p.split, p.issue, v.retrieval_vote_issue AS pred_issue FROM preds p JOIN votes v USING (case_id)),
{scores('voted', 'voted_preds', 'pred_issue')},
comparison AS (
  SELECT 'TF-IDF + LogReg' AS model, split, n, accuracy, macro_f1, weighted_f1, cast(NULL AS double) AS rate FROM base
  UNION ALL SELECT 'RAC: augmented text', split, n, accuracy, macro_f1, weighted_f1, NULL FROM voted
  UNION ALL SELECT 'Hybrid retrieval', split, n, accuracy, macro_f1, weighted_f1, rate FROM hybrid JOIN rates USING (split))"""

ORACLES["compare_models"] = f"""
{COMPARISON} SELECT model, split, n, {ROUNDED}, round(rate, 6) AS retrieval_override_rate FROM comparison"""

ORACLES["best_model"] = f"""
{COMPARISON}
SELECT model, round(weighted_f1, 6) AS weighted_f1 FROM comparison WHERE split = 'test'
ORDER BY weighted_f1 DESC, model LIMIT 1"""

ORACLES["confusion_counts"] = """
SELECT cast(quality AS varchar) AS label, cast(toxic AS varchar) AS pred, count(*) AS n FROM labels GROUP BY 1, 2"""

ORACLES["classification_report"] = """
WITH pairs AS (SELECT cast(quality AS varchar) AS t, cast(toxic AS varchar) AS p FROM labels),
names AS (SELECT t AS label FROM pairs UNION SELECT p FROM pairs),
counted AS (
  SELECT label, (SELECT count(*) FROM pairs WHERE t = label) AS support,
         (SELECT count(*) FROM pairs WHERE p = label) AS predicted,
         (SELECT count(*) FROM pairs WHERE t = label AND p = label) AS tp FROM names),
classes AS (
  SELECT label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
         2.0 * tp / (predicted + support) AS f1_score, cast(support AS double) AS support, tp FROM counted),
report AS (
  SELECT 0 AS section, label, precision, recall, f1_score, support FROM classes
  UNION ALL
  SELECT 1, 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support) FROM classes
  UNION ALL
  SELECT 2, 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM classes
  UNION ALL
  SELECT 3, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1_score * support) / sum(support), sum(support) FROM classes)
SELECT section, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
       round(support, 6) AS support FROM report"""

ORACLES["compare_report"] = f"""
{COMPARISON},
held_out AS (SELECT * FROM comparison WHERE split = 'test'),
best AS (SELECT * FROM held_out ORDER BY weighted_f1 DESC, model LIMIT 1)
SELECT 0 AS ln, 'Issue classification results on the held-out test split:' AS value
UNION ALL
SELECT CASE model WHEN 'TF-IDF + LogReg' THEN 1 WHEN 'RAC: augmented text' THEN 2 ELSE 3 END,
       format('- {{}}: accuracy={{:.3f}}, macro-F1={{:.3f}}, weighted-F1={{:.3f}}.',
         CASE model WHEN 'TF-IDF + LogReg' THEN 'TF-IDF + Logistic Regression baseline'
                    WHEN 'RAC: augmented text' THEN 'Retrieval-augmented text classifier'
                    ELSE 'Conservative hybrid retrieval classifier' END, accuracy, macro_f1, weighted_f1)
FROM held_out
UNION ALL
SELECT 4, format('Best test weighted-F1 in the current run: {{}} ({{:.3f}}).', model, weighted_f1) FROM best
UNION ALL
SELECT 5, CASE WHEN helped > plain
    THEN 'Conclusion: similar cases raise the weighted-F1 of the baseline on held-out cases.'
  WHEN helped = plain
    THEN 'Conclusion: with similar cases the weighted-F1 on held-out cases is that of the baseline.'
  ELSE 'Conclusion: similar cases explain a prediction, but held-out weighted-F1 falls below the baseline.' END
FROM (SELECT max(weighted_f1) FILTER (model = 'TF-IDF + LogReg') AS plain,
             max(weighted_f1) FILTER (model <> 'TF-IDF + LogReg') AS helped FROM held_out)"""

SHIFTED = f"""
WITH {CASES},
shifted AS (
  SELECT * REPLACE (received + INTERVAL (CASE WHEN ingest_pos % 5 = 0 THEN 40 ELSE 0 END) DAY AS received) FROM cases)"""

ORACLES["attach_split_unlisted"] = f"""
{SHIFTED}, {usable('cases')}, kept AS (SELECT * FROM usable WHERE ingest_pos % 3 <> 0), {split_of('kept')}
SELECT u.case_id, s.split FROM usable u JOIN splits s USING (case_id)"""

ORACLES["listed_texts_unlisted"] = f"""
{SHIFTED}, {usable('cases')}, {split_of('usable')}
SELECT s.case_id, s.split, cast(1 AS bigint) AS n, u.text
FROM splits s JOIN usable u USING (case_id) WHERE u.ingest_pos % 3 <> 0"""

ORACLES["tfidf_vocabulary_cut"] = (
    VOCABULARY.replace("LIMIT 100000", "LIMIT 1000") + " SELECT term, df, tf, round(idf, 6) AS idf FROM vocabulary"
)

ORACLES["svd_invariants"] = f"""
{VOCABULARY},
size AS (
  SELECT least(256, least((SELECT total FROM train_size), (SELECT count(*) FROM vocabulary)) - 1) AS k),
i AS (SELECT unnest(range(k)) AS i FROM size)
SELECT cast(a.i AS integer) AS i, cast(b.i AS integer) AS j, CASE WHEN a.i = b.i THEN 1.0::double ELSE 0 END AS value
FROM i a JOIN i b ON b.i <= a.i
UNION ALL SELECT i, NULL, 1 FROM i"""

ORACLES["ovr_optimality"] = f"""
{LISTED},
train AS (SELECT issue AS label FROM splits WHERE split = 'train' AND {is_usable('issue')})
SELECT label, count(*) AS n, cast((SELECT count(*) FROM train) AS double) AS weight_sum, true AS solved
FROM train GROUP BY label"""

GIVEN = f"""
{VECTORS},
texts AS (SELECT doc_id, {FLAT} AS flat FROM documents),
cells AS (SELECT vec_id AS cell, embedding AS center FROM splits WHERE vec_id < 40),
near AS (
  SELECT s.vec_id, cell, row_number() OVER (PARTITION BY s.vec_id ORDER BY list_dot_product(s.embedding, center)
    / sqrt(list_dot_product(center, center)) DESC, cell) AS place
  FROM splits s, cells),
pairs AS (
  SELECT q.case_id AS query_id, q.split AS query_split, t.vec_id AS hit_pos, t.case_id AS hit_id, t.issue AS hit_issue,
         list_dot_product(q.embedding, t.embedding) / (sqrt(list_dot_product(q.embedding, q.embedding))
           * sqrt(list_dot_product(t.embedding, t.embedding))) AS sim
  FROM splits q JOIN near a ON a.vec_id = q.vec_id AND a.place <= 16
  JOIN near b ON b.cell = a.cell AND b.place = 1
  JOIN splits t ON t.vec_id = b.vec_id AND t.split = 'train' AND NOT (q.split = 'train' AND q.case_id = t.case_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, hit_pos) AS place FROM pairs)"""

ORACLES["ivf_given_cells"] = f"""
{GIVEN}
SELECT query_id, query_split, cast(place AS integer) AS rank, hit_id, hit_issue,
       round(sim, 6) AS cosine_similarity, coalesce({shorten('flat', 350)}, '') AS hit_snippet
FROM placed LEFT JOIN texts ON doc_id = hit_pos WHERE place <= 3"""

COARSE = (
    MERGED.replace("t.issue AS hit_issue", "cast(cast(t.issue AS integer) % 2 AS varchar) AS hit_issue")
    .replace("SELECT case_id, split, issue, cast((vec_id // 10) % 10 AS varchar) AS pred_issue",
             "SELECT case_id, split, cast(cast(issue AS integer) % 2 AS varchar) AS issue, "
             "cast((vec_id // 10) % 2 AS varchar) AS pred_issue")
)

ORACLES["coarse_override"] = f"{COARSE} SELECT * FROM merged"

ORACLES["coarse_hybrid_metrics"] = (
    f"{COARSE}, {scores('hybrid', 'merged', 'hybrid_pred_issue')}, rates AS (SELECT split, "
    "avg(coalesce(top3_all_agree, false)::integer) AS rate FROM merged GROUP BY 1) "
    f"SELECT split, n, round(rate, 6) AS retrieval_override_rate, {ROUNDED} FROM hybrid JOIN rates USING (split)"
)

COMPLAINTS = """
WITH complaints AS (
  SELECT CASE WHEN doc_id % 11 <> 0 THEN cast(doc_id AS varchar) END AS case_id,
         CASE WHEN doc_id % 7 <> 0 THEN strftime(DATE '2020-01-01' + cast(doc_id % 730 AS integer), '%Y-%m-%d') END AS received,
         CASE WHEN doc_id % 13 <> 0 THEN source END AS product, lang AS issue,
         CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN ' ' || chr(9) || ' ' ELSE text END AS text
  FROM documents)"""

ORACLES["csv_ingest"] = f"{COMPLAINTS} SELECT * FROM complaints"

ORACLES["csv_usable"] = f"""
{COMPLAINTS}
SELECT coalesce(case_id, 'nan') AS case_id, count(*) AS n, count(received) AS dated
FROM complaints WHERE {is_usable('text')} AND {is_usable('issue')} GROUP BY 1"""

ORACLES["source_columns"] = """
SELECT * FROM (VALUES (0, 'doc_id'), (1, 'lang'), (2, 'source'), (3, 'n_chars')) AS t(idx, name)"""

ORACLES["dev_subset"] = """
SELECT cast(doc_id AS varchar) AS case_id, source AS product, text FROM documents WHERE doc_id < 100"""

ORACLES["splits_round_trip"] = ORACLES["chronological_split"]

ORACLES["predictions_round_trip"] = """
SELECT cast(doc_id AS varchar) AS case_id, 'val' AS split, lang AS issue, source AS pred_issue, text FROM documents"""

ORACLES["hits_json_round_trip"] = ORACLES["bm25_nested_hits"]

ORACLES["report_round_trip"] = f"SELECT value FROM ({ORACLES['eda_report']})"

ORACLES["augmented_checkpoint"] = ORACLES["augmented_text"]
