"""Check statements of the text, topic, prediction and sink queries."""

from oracle.common import BASE, REPLY_TEXTS, SCORED, r, statement
from oracle.statements import SAME_CATEGORY, SPACE, STATEMENTS, STATS, strip, t_exact, text
from replyscope.functions.text import STOP_WORDS

NOT_SPACE = SPACE.replace("[", "[^", 1)
PHRASES = ["dear customer,?", "thank you for contacting us,?", "we appreciate your patience,?", "best regards,?",
           "sincerely,?", "thanks,?"]
STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


def clean(e: str) -> str:
    no_url = f"regexp_replace(lower(coalesce({e}, '')), 'http{NOT_SPACE}+|www{NOT_SPACE}+', '', 'g')"
    return strip(f"regexp_replace({no_url}, '{SPACE}+', ' ', 'g')")


def plain(e: str, patterns: list[str] = PHRASES) -> str:
    out = f"lower({e})"
    for p in patterns:
        out = f"regexp_replace({out}, '{p}', '', 'gi')"
    return strip(out)


def title(e: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({e}, '\\p{{L}}+|[^\\p{{L}}]+'), "
            "lambda x: CASE x[1] WHEN 'ß' THEN 'Ss' ELSE upper(x[1]) END || lower(x[2:])), '')")


def token_list(e: str) -> str:
    return f"list_filter(regexp_extract_all({e}, '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: NOT list_contains({STOP}, x))"


def term_list(t: str, bigrams: bool = True) -> str:
    if not bigrams:
        return t
    return f"list_concat({t}, list_transform(range(1, greatest(len({t}), 1)), lambda i: {t}[i] || ' ' || {t}[i + 1]))"


COMBINED = f"""docs AS (SELECT macro_id AS id, {plain(clean(
    "concat_ws(' ', coalesce(macro_name, ''), coalesce(category, ''), coalesce(macro_body, ''))"))} AS cleaned FROM reply_texts)"""
BODIES = f"docs AS (SELECT macro_id AS id, {plain(clean('macro_body'))} AS cleaned FROM reply_texts)"
RAW_BODIES = "docs AS (SELECT macro_id AS id, lower(coalesce(macro_body, '')) AS cleaned FROM reply_texts)"


def tfidf(min_df: int = 1, max_df: float = 1.0, features: int = 500, bigrams: bool = True) -> str:
    return f"""toks AS (SELECT id, {token_list('cleaned')} AS t FROM docs),
terms AS (SELECT id, unnest({term_list('t', bigrams)}) AS term FROM toks),
tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1
 HAVING count(*) >= {min_df} AND count(*) <= {max_df}E0 * (SELECT count(*) FROM docs)
 ORDER BY total DESC, term LIMIT {features}),
idf AS (SELECT term, ln((1.0E0 + (SELECT count(*) FROM docs)) / (1.0E0 + df)) + 1.0E0 AS idf FROM vocab),
w0 AS (SELECT id, tf.term, tf * idf AS w FROM tf JOIN idf ON tf.term = idf.term),
w AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM w0)"""


TOPIC = [REPLY_TEXTS, COMBINED, tfidf(2, 0.8)]
STATEMENTS["clean_text"] = f"SELECT doc_id, md5({clean('text')}) AS digest FROM documents"
STATEMENTS["remove_boilerplate"] = f"""SELECT doc_id,
 md5({plain("concat('Dear Customer,  ', text, '  THANKS, Best regards')")}) AS digest,
 md5({plain('text', ['[0-9]+'])}) AS own_digest FROM documents"""
STATEMENTS["title_case"] = f"SELECT doc_id, md5({title('text')}) AS digest FROM documents"
STATEMENTS["macro_texts"] = statement(
    "SELECT id AS macro_id, md5(cleaned) AS digest, length(cleaned) AS n_chars FROM docs", [REPLY_TEXTS], [COMBINED])
STATEMENTS["tfidf_terms"] = statement(f"SELECT id AS macro_id, term, {r('w')} AS weight FROM w", TOPIC)
STATEMENTS["tfidf_apply"] = statement(f"""SELECT id AS macro_id, term,
 {r('v / sqrt(sum(v * v) OVER (PARTITION BY id))')} AS weight
 FROM (SELECT n.id, n.term, count(*) * any_value(idf) AS v FROM new_terms n JOIN idf ON n.term = idf.term GROUP BY 1, 2)""",
    TOPIC, [f"""new_toks AS (SELECT concat_ws('-', conv_id, turn) AS id, {token_list(clean('text'))} AS t FROM conversations)""",
            f"new_terms AS (SELECT id, unnest({term_list('t')}) AS term FROM new_toks)"])
STATEMENTS["top_terms"] = statement(f"""SELECT term, {r('total_weight')} AS total_weight FROM
 (SELECT term, sum(w) AS total_weight FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)""", TOPIC)
STATEMENTS["tfidf_vectors"] = statement(f"""SELECT docs.id AS macro_id, count(w.term) AS n_terms,
 {r('coalesce(sum(w * w), 0.0E0)')} AS length FROM docs LEFT JOIN w ON docs.id = w.id GROUP BY 1""", TOPIC)

SIMS = "sims AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS s FROM w a JOIN w b ON a.term = b.term AND a.id < b.id GROUP BY ALL)"
FIRST = """grp AS (SELECT id, min(id) OVER (PARTITION BY cleaned) AS rep,
 count(*) OVER (PARTITION BY cleaned) AS n FROM docs)"""
BEST = """grp AS (SELECT d.id, first_value(d.id) OVER (PARTITION BY cleaned ORDER BY coalesce(usage_count, 0) DESC,
  coalesce(macro_effectiveness_index, 0) DESC, d.id DESC) AS rep, count(*) OVER (PARTITION BY cleaned) AS n
 FROM docs d LEFT JOIN indexed i ON d.id = i.macro_id)"""


def similar(threshold: float | None) -> str:
    limit = "s > 0" if threshold is None else f"s >= {threshold}E0 - 1.0E-9"
    return f"""alike AS (SELECT a AS macro_a, b AS macro_b, least(1.0E0, s) AS similarity, CAST(x.n * y.n AS DOUBLE) AS n_pairs
 FROM sims JOIN grp x ON x.id = a JOIN grp y ON y.id = b WHERE x.id = x.rep AND y.id = y.rep AND {limit}
 UNION ALL SELECT least(id, rep), greatest(id, rep), 1.0E0, n / 2.0E0 FROM grp
 WHERE id <> rep AND rep IN (SELECT id FROM w))"""


STATEMENTS["cosine_pairs"] = statement(
    f"SELECT macro_a, macro_b, {r('similarity')} AS similarity, {r('n_pairs')} AS n_pairs FROM alike",
    [REPLY_TEXTS, BODIES, tfidf(), SIMS, FIRST, similar(None)])
STATEMENTS["cosine_pairs_unigram"] = statement(
    f"SELECT macro_a, macro_b, {r('similarity')} AS similarity, {r('n_pairs')} AS n_pairs FROM alike",
    [REPLY_TEXTS, RAW_BODIES, tfidf(bigrams=False), SIMS, FIRST, similar(0.5)])
STATEMENTS["near_dup_approx"] = statement(
    f"SELECT macro_a, macro_b, {r('n_pairs')} AS n_pairs FROM alike",
    [REPLY_TEXTS, COMBINED, tfidf(), SIMS, FIRST, similar(0.95)])
REDUNDANT = [*SCORED, REPLY_TEXTS, BODIES, tfidf(), SIMS, BEST, similar(0.8), """advice AS (SELECT p.*,
  a.macro_name AS name_a, b.macro_name AS name_b, a.category AS category_a, b.category AS category_b,
  a.usage_count AS usage_a, b.usage_count AS usage_b, a.macro_effectiveness_index AS effectiveness_a,
  b.macro_effectiveness_index AS effectiveness_b FROM alike p JOIN indexed a ON a.macro_id = macro_a
  JOIN indexed b ON b.macro_id = macro_b)"""]
KEEP_A = "(usage_a > usage_b OR (usage_a = usage_b AND effectiveness_a > effectiveness_b))"
STATEMENTS["redundant_pairs"] = statement(f"""SELECT macro_a, macro_b, {r('similarity')} AS similarity,
 {r('n_pairs')} AS n_pairs, name_a, name_b, category_a, category_b, usage_a, usage_b,
 {r('effectiveness_a')} AS effectiveness_a, {r('effectiveness_b')} AS effectiveness_b,
 CASE WHEN {KEEP_A} THEN concat('Keep ', macro_a, ', archive ', macro_b)
  ELSE concat('Keep ', macro_b, ', archive ', macro_a) END AS recommendation,
 CASE WHEN effectiveness_a >= effectiveness_b THEN macro_a ELSE macro_b END AS keep_best FROM advice""", REDUNDANT)
STATEMENTS["pairs_threshold"] = statement(
    f"SELECT macro_a, macro_b, {r('similarity')} AS similarity FROM advice WHERE similarity >= 0.9E0 - 1.0E-9", REDUNDANT)
STATEMENTS["similarity_edges"] = statement(f"""SELECT macro_a, macro_b, {r('similarity')} AS similarity,
 substring(name_a, 1, 20) AS label_a, substring(name_b, 1, 20) AS label_b FROM
 (SELECT * FROM advice ORDER BY round(similarity, 9) DESC, macro_a, macro_b LIMIT 30)""", REDUNDANT)
STATEMENTS["tier_summary"] = statement("""SELECT count(*) FILTER (effectiveness_level = 'High') AS high,
 count(*) FILTER (effectiveness_level = 'Low') AS low, count(*) FILTER (usage_count = 0) AS unused,
 (SELECT count(*) FROM sims WHERE s >= 0.8E0 - 1.0E-9) AS redundant_pairs FROM scores""", REDUNDANT)
ALL_PAIRS = """every AS (SELECT least(1.0E0, coalesce(s, 0.0E0)) AS s FROM docs x JOIN docs y ON x.id < y.id
 LEFT JOIN sims ON sims.a = x.id AND sims.b = y.id),
steps AS (SELECT s, floor(s * 1.0E6 + 0.500137E0) AS step FROM every)"""
STATEMENTS["similarity_stats"] = statement(f"""SELECT {r('avg(s)')} AS mean_similarity,
 {r('quantile_cont(step, 0.5) / 1.0E6')} AS median_similarity, {r('max(step) / 1.0E6')} AS max_similarity,
 {r('min(step) / 1.0E6')} AS min_similarity, {r('stddev_pop(s)')} AS std_similarity,
 count(*) FILTER (step >= 800000) AS pairs_above_80, count(*) FILTER (step >= 600000) AS pairs_above_60,
 count(*) FILTER (step >= 400000) AS pairs_above_40 FROM steps""",
    [REPLY_TEXTS, BODIES, tfidf(), SIMS, ALL_PAIRS])
STATEMENTS["histogram_sim"] = statement("""SELECT CAST(least(50, 1 + floor((step - lo) / (hi - lo) * 50.0E0)) AS BIGINT) AS bin,
 count(*) AS n_pairs FROM steps, (SELECT min(step) AS lo, max(step) AS hi FROM steps) GROUP BY 1""",
    [REPLY_TEXTS, BODIES, tfidf(), SIMS, ALL_PAIRS])

STATEMENTS["cluster_labels"] = statement(f"""SELECT source AS cluster_id,
 {title("string_agg(term, ' / ' ORDER BY k)")} AS cluster_label FROM
 (SELECT source, term, row_number() OVER (PARTITION BY source ORDER BY floor(sum(w) / any_value(n) * 1.0E9 + 0.5E0) DESC, term) AS k
  FROM w JOIN reply_texts x ON x.macro_id = w.id JOIN (SELECT source AS s, count(*) AS n FROM reply_texts GROUP BY 1) z ON z.s = source
  GROUP BY 1, 2 QUALIFY k <= 3) GROUP BY 1""", TOPIC)
SILHOUETTE = """dist AS (SELECT a.vec_id, a.label AS own, b.label AS other,
  sum(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS d
 FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY ALL),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
ab AS (SELECT vec_id, own, max(d / (n - 1)) FILTER (own = other) AS a, min(d / n) FILTER (own <> other) AS b
 FROM dist JOIN sizes ON label = other GROUP BY 1, 2),
sil AS (SELECT vec_id, CAST(own AS BIGINT) AS cluster, coalesce((b - a) / greatest(a, b), 0.0E0) AS silhouette FROM ab)"""
STATEMENTS["silhouette"] = statement(f"SELECT vec_id, cluster, {r('silhouette')} AS silhouette FROM sil", [SILHOUETTE])
STATEMENTS["silhouette_by_cluster"] = statement(f"""SELECT cluster, {r('avg(silhouette)')} AS silhouette, count(*) AS size
 FROM sil GROUP BY 1 UNION ALL SELECT -1, {r('avg(silhouette)')}, count(*) FROM sil""", [SILHOUETTE])

# --- tests of pairs: the density of t is integrated by Simpson's rule ------------------------------------


def p_value(t: str) -> str:
    """Two-sided p of column t with n_a + n_b - 2 degrees of freedom."""
    nu = "(n_a + n_b - 2)"
    pdf = f"power(1.0E0 + x * x / {nu}, -({nu} + 1) / 2.0E0)"
    weight = "CASE WHEN i IN (0, 2000) THEN 1.0E0 WHEN i % 2 = 1 THEN 4.0E0 ELSE 2.0E0 END"
    area = f"(SELECT sum({weight} * {pdf}) * abs({t}) / 6000.0E0 FROM (SELECT i, abs({t}) * i / 2000.0E0 AS x FROM range(2001) g(i)))"
    scale = f"exp(lgamma(({nu} + 1) / 2.0E0) - lgamma({nu} / 2.0E0)) / sqrt({nu} * pi())"
    return f"greatest(0.0E0, 1.0E0 - 2.0E0 * {scale} * {area})"


def tests(alpha: float) -> list[str]:
    raw = f"""compared AS (SELECT macro_a, macro_b, a.n AS n_a, b.n AS n_b, {t_exact('csat')} AS tc, {t_exact('handle_time')} AS th,
  a.csat_mean AS ca, b.csat_mean AS cb, a.handle_time_mean AS ha, b.handle_time_mean AS hb
 FROM pairs JOIN stats a ON a.macro_id = macro_a JOIN stats b ON b.macro_id = macro_b WHERE a.n >= 20 AND b.n >= 20)"""
    judged = f"""judged AS (SELECT *, pc < {alpha} AS sc, ph < {alpha} AS sh,
  CASE WHEN pc < {alpha} AND ca > cb THEN 'A' WHEN pc < {alpha} AND cb > ca THEN 'B' ELSE 'Tie' END AS wc,
  CASE WHEN ph < {alpha} AND ha < hb THEN 'A' WHEN ph < {alpha} AND hb < ha THEN 'B' ELSE 'Tie' END AS wh
  FROM (SELECT *, {p_value('tc')} AS pc, {p_value('th')} AS ph FROM compared))"""
    return [SAME_CATEGORY, STATS, raw, judged]


STATEMENTS["compare_macros"] = statement(f"""SELECT macro_a, macro_b, {r('pc')} AS csat_p_value, sc AS csat_significant,
 wc AS csat_winner, {r('ph')} AS handle_time_p_value, sh AS handle_time_significant, wh AS handle_time_winner
 FROM judged""", SCORED, tests(0.05))
STATEMENTS["ab_summary"] = statement("""SELECT count(*) AS total_comparisons, count(*) FILTER (sc) AS significant_csat,
 count(*) FILTER (sh) AS significant_handle_time FROM judged""", SCORED, tests(0.3))
STATEMENTS["ab_findings"] = statement(f"""SELECT macro_a, macro_b, x.macro_name AS name_a, y.macro_name AS name_b,
 CASE WHEN sc THEN CASE WHEN wc = 'A' THEN x.macro_name ELSE y.macro_name END END AS csat_winner_name,
 CASE WHEN sh THEN CASE WHEN wh = 'A' THEN x.macro_name ELSE y.macro_name END END AS handle_time_winner_name,
 {r('pc')} AS csat_p_value, {r('ph')} AS handle_time_p_value
 FROM (SELECT * FROM judged WHERE sc OR sh ORDER BY macro_a, macro_b LIMIT 10) JOIN macros x ON x.macro_id = macro_a
 JOIN macros y ON y.macro_id = macro_b""", SCORED, tests(0.3))

# --- prediction and sinks -----------------------------------------------------------------------------

STATEMENTS["predictor_training_set"] = statement("""SELECT ticket_id, macro_id, md5(text) AS digest FROM
 (SELECT * FROM macro_usage WHERE macro_id IN (SELECT macro_id FROM indexed WHERE macro_effectiveness_index >=
   (SELECT quantile_cont(macro_effectiveness_index, 0.5) FROM indexed))
  QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY applied_at, position_in_thread, macro_id) = 1)
 JOIN documents ON ticket_id = doc_id""", SCORED)
TRAINED = """training AS (SELECT ticket_id, macro_id, text FROM
 (SELECT * FROM macro_usage WHERE macro_id IN (SELECT macro_id FROM indexed WHERE macro_effectiveness_index >=
   (SELECT quantile_cont(macro_effectiveness_index, 0.5) FROM indexed))
  QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY applied_at, position_in_thread, macro_id) = 1)
 JOIN documents ON ticket_id = doc_id),
learned AS (SELECT count(DISTINCT macro_id) AS n_classes, count(*) AS n_samples FROM training)"""
TRAINED_TERMS = [f"words AS (SELECT {token_list('lower(text)')} AS t FROM training)",
                 f"terms AS (SELECT DISTINCT unnest({term_list('t')}) AS term FROM words)"]
STATEMENTS["predictor_fit_checks"] = statement("""SELECT n_classes, n_classes AS n_numbers, n_classes - 1 AS last_number,
 n_samples, (SELECT least(1000, count(*)) FROM terms) AS n_terms, 1.0E0 AS importance FROM learned""",
    [*SCORED, TRAINED], TRAINED_TERMS)
STATEMENTS["predictor_metrics_checks"] = statement(
    "SELECT true AS in_order, n_classes, n_samples FROM learned", [*SCORED, TRAINED])
STATEMENTS["predict_batch_checks"] = statement("""SELECT doc_id AS ticket_id, least(3, n_classes) AS n_rows,
 least(3, n_classes) AS n_macros, least(3, n_classes) AS n_known, true AS in_order FROM documents, learned""",
    [*SCORED, TRAINED])
STATEMENTS["topn_checks"] = statement("""SELECT concat_ws('-', conv_id, turn) AS ticket_id, least(5, n_classes) AS n_rows,
 least(5, n_classes) AS n_macros, least(5, n_classes) AS n_known, true AS in_order FROM conversations, learned""",
    [*SCORED, TRAINED])
STATEMENTS["src_csv"] = statement(f"""SELECT CAST(ticket_id AS VARCHAR) AS ticket_id, {text('created_at', 'resolved_at')},
 status, channel, priority, contact_driver, {r('first_response_time_minutes')} AS first_response_time_minutes,
 {r('total_handle_time_minutes')} AS total_handle_time_minutes, CAST(reopens_count AS BIGINT) AS reopens_count,
 CAST(csat_score AS DOUBLE) AS csat_score, CAST(agent_id AS VARCHAR) AS agent_id, macro_sequence, final_macro_id
 FROM tickets""")
STATEMENTS["src_csv_report"] = statement("""SELECT measure, n FROM (
 SELECT count(*) AS rows, count(*) FILTER (lost) AS rejected, count(*) FILTER (ticket_id % 50 = 0) AS unparsed_created_at,
  count(*) FILTER (ticket_id % 41 = 0) AS unparsed_resolved_at, count(*) FILTER (ticket_id % 70 = 0) AS unparsed_csat_score,
  count(*) FILTER (NOT lost) AS kept, count(*) FILTER (NOT lost AND ticket_id % 41 <> 0 AND resolved_at IS NOT NULL) AS with_resolved_at,
  count(*) FILTER (NOT lost AND ticket_id % 3 = 0) AS with_response, count(*) FILTER (ticket_id % 50 = 0) AS aside_for_created_at
 FROM (SELECT *, ticket_id % 50 = 0 OR ticket_id % 90 = 0 AS lost FROM tickets)) UNPIVOT (n FOR measure IN (rows, rejected,
  unparsed_created_at, unparsed_resolved_at, unparsed_csat_score, kept, with_resolved_at, with_response, aside_for_created_at))
 WHERE n > 0 OR measure IN ('kept', 'with_resolved_at', 'with_response', 'aside_for_created_at')""")
STATEMENTS["job_resumed"] = statement("""SELECT 'tickets_clean' AS "table", 'clean' AS step, count(*) AS n_rows FROM tickets
 UNION ALL SELECT 'macros_clean', 'clean', count(*) FROM macros
 UNION ALL SELECT 'macro_usage_clean', 'clean', count(*) FROM macro_usage WHERE ticket_id IN (SELECT ticket_id FROM tickets)
  AND macro_id IN (SELECT macro_id FROM macros)
 UNION ALL SELECT 'ticket_features', 'features', count(*) FROM tickets
 UNION ALL SELECT 'macro_features', 'features', count(*) FROM macros
 UNION ALL SELECT 'macro_scores', 'score', count(*) FROM macros""", BASE)
STATEMENTS["sink_table"] = statement("""SELECT strftime(applied_at, '%Y-%m') AS month, count(*) AS n_uses FROM macro_usage
 WHERE applied_at >= TIMESTAMP '1997-01-01' AND applied_at < TIMESTAMP '1998-01-01' GROUP BY 1""")
STATEMENTS["sink_table_months"] = statement("""SELECT strftime(applied_at, '%Y-%m') AS month, count(*) AS n_uses FROM macro_usage
 GROUP BY 1""")
STATEMENTS["sink_multi"] = statement("""SELECT 'macro_summary' AS table_name, count(*) AS n_rows FROM macros
 UNION ALL SELECT 'top_performers', least(20, count(*)) FROM macros
 UNION ALL SELECT 'needs_improvement', least(20, count(*)) FROM macros
 UNION ALL SELECT 'ticket_summary', count(DISTINCT contact_driver) FROM tickets
 UNION ALL SELECT 'category_stats', count(DISTINCT category) FROM macros
 UNION ALL SELECT 'daily_metrics', count(DISTINCT CAST(created_at AS DATE)) FROM tickets""", BASE)
STATEMENTS["sink_csv_exports"] = statement("""SELECT 'full' AS table_name, count(*) AS n_rows FROM macros
 UNION ALL SELECT 'by_category', count(DISTINCT category) FROM macros
 UNION ALL SELECT 'action_items', count(*) FROM scores WHERE effectiveness_level = 'Low' OR usage_count < 5""", SCORED)
