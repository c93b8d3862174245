"""SQL counterparts of the registered queries, written from the definitions, over the same tables."""

from __future__ import annotations

from tallyloom.operators import quality as Q
from tallyloom.operators import synthetic as S
from tallyloom.operators.ranking import BASELINE, METRICS, RERANKED
from tallyloom.plans import catalog as C
from tallyloom.plans.bindings import EVAL_RUNS

_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD = r"[\p{L}\p{N}_]+"
_NL = "chr(10)"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _normalised(x: str) -> str:
    return f"regexp_replace(lower({_strip(x)}), '{_WS}+', ' ', 'g')"


def _joined(*parts: str) -> str:
    return f" || {_NL} || ".join(parts)


def _row_hash(*cols: str) -> str:
    text = " || ".join(f"CAST(length({c}) AS VARCHAR) || ':' || {c}" for c in cols)
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"


def _seeded(seed: int) -> str:
    return f"CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 15) AS BIGINT)"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- inputs and exports -----------------------------------------------------------------------------------------

_SFT = f"""
sft_raw AS (
  SELECT a.conv_id * 1048576 + a.turn AS pos, u.text AS instruction, '' AS input, a.text AS output
  FROM conversations a JOIN conversations u
    ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user'
  WHERE a.role = 'assistant'),
sft_judged AS (
  SELECT *, CASE
      WHEN {_strip("output")} = '' THEN 'blank_output'
      WHEN length({_strip(_joined("instruction", "input", "output"))}) NOT BETWEEN {C.SFT_MIN} AND {C.SFT_MAX}
        THEN 'length'
      ELSE 'kept' END AS reason
  FROM sft_raw),
sft AS (SELECT pos, instruction, input, output FROM sft_judged WHERE reason = 'kept')"""

_DPO = f"""
dpo_raw AS (
  SELECT conv_id AS pos,
    {_strip("coalesce(arg_min(text, turn) FILTER (WHERE role = 'user'), '')")} AS instruction,
    '' AS input,
    coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') AS chosen,
    coalesce(arg_min(text, turn) FILTER (WHERE role = 'assistant'), '') AS rejected
  FROM conversations GROUP BY conv_id),
dpo_judged AS (
  SELECT *, CASE
      WHEN instruction = '' THEN 'empty_prompt'
      WHEN length({_strip(_joined("instruction", "input", "chosen", "rejected"))})
           NOT BETWEEN {C.DPO_MIN} AND {C.DPO_MAX} THEN 'length'
      WHEN chosen = '' OR rejected = '' THEN 'empty_side'
      WHEN chosen = rejected THEN 'identical_sides'
      ELSE 'kept' END AS reason
  FROM dpo_raw),
dpo AS (SELECT pos, instruction, input, chosen, rejected FROM dpo_judged WHERE reason = 'kept')"""

_CPT = f"""
cpt_judged AS (
  SELECT doc_id AS pos, {_strip("text")} AS text,
    CASE WHEN length({_strip("text")}) < 80 THEN 'too_short' ELSE 'kept' END AS reason
  FROM documents),
cpt AS (SELECT pos, substr(text, 1, 8000) AS text FROM cpt_judged WHERE reason = 'kept')"""

_ALL = f"WITH {_SFT}, {_DPO}, {_CPT}"

_ACCOUNTING = """
accounting AS (
  SELECT 'sft' AS role, count(*) AS raw_rows, count(*) FILTER (WHERE reason = 'kept') AS exported_rows FROM sft_judged
  UNION ALL SELECT 'dpo', count(*), count(*) FILTER (WHERE reason = 'kept') FROM dpo_judged
  UNION ALL SELECT 'cpt', count(*), count(*) FILTER (WHERE reason = 'kept') FROM cpt_judged)"""

_DIGESTS = f"""
digests AS (
  SELECT 'sft' AS role, count(*) AS rows,
    coalesce(CAST(sum({_row_hash("instruction", "input", "output")}) AS VARCHAR), '0') AS digest FROM sft
  UNION ALL SELECT 'dpo', count(*),
    coalesce(CAST(sum({_row_hash("instruction", "input", "chosen", "rejected")}) AS VARCHAR), '0') FROM dpo
  UNION ALL SELECT 'cpt', count(*), coalesce(CAST(sum({_row_hash("text")}) AS VARCHAR), '0') FROM cpt)"""


def _trigrams(source: str, key: str, text: str) -> str:
    return f"""
words AS (SELECT {key} AS id, regexp_extract_all(lower({text}), '{_WORD}') AS w FROM {source}),
places AS (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3),
trigrams AS (
  SELECT id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t, count(*) AS n FROM places GROUP BY id, t),
repetition AS (
  SELECT words.id, coalesce(CAST(sum(n) FILTER (WHERE n > 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 0.0) AS score
  FROM words LEFT JOIN trigrams ON trigrams.id = words.id GROUP BY words.id)"""


def _length_lines(dataset: str, metric: str, source: str, length: str) -> str:
    stats = [(f"p{p}", f"quantile_cont(CAST({length} AS DOUBLE), {p / 100})") for p in (50, 90, 95, 99)]
    stats.append(("mean", f"avg(CAST({length} AS DOUBLE))"))
    return " UNION ALL ".join(_line(dataset, metric, stat, value, source) for stat, value in stats)


def _line(dataset: str, metric: str, stat: str, value: str, source: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{metric}' AS metric, '{stat}' AS stat, "
        f"round(CAST({value} AS DOUBLE), 6) AS value FROM {source}"
    )


def _duplicates(key: str) -> tuple[str, str]:
    unique = f"count(DISTINCT sha256({_normalised(key)}))"
    return f"1.0 - CAST({unique} AS DOUBLE) / CAST(count(*) AS DOUBLE)", unique


_SFT_DUP, _SFT_UNIQUE = _duplicates(_joined("instruction", "input", "output"))
_DPO_DUP, _DPO_UNIQUE = _duplicates(_joined("instruction", "chosen", "rejected"))
_DOC_DUP, _DOC_UNIQUE = _duplicates("text")
_PREFIX = (
    "least(length(chosen), length(rejected)) > 0 AND "
    "substr(chosen, 1, least(length(chosen), length(rejected))) = "
    "substr(rejected, 1, least(length(chosen), length(rejected)))"
)

# --- retrieval --------------------------------------------------------------------------------------------------

_SEARCH = """
cells AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x
          FROM embeddings),
means AS (SELECT label, i, avg(x) AS x FROM cells GROUP BY label, i),
query_vectors AS (SELECT label, list(x ORDER BY i) AS v FROM means GROUP BY label),
pairs AS (
  SELECT 't' || q.label AS qid, q.label, CAST(e.vec_id AS VARCHAR) AS doc_id, e.vec_id,
    round(list_cosine_similarity(q.v, CAST(e.embedding AS DOUBLE[])), 6) AS score
  FROM query_vectors q CROSS JOIN embeddings e),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rk FROM pairs
  QUALIFY rk <= 100)"""

_RERANK = f"""
merged AS (
  SELECT qid, doc_id, CASE WHEN rk <= {C.SEARCH.rerank_pool}
      THEN 1000 + (CAST((vec_id * 7919 + label * 104729) % 1000 AS DOUBLE) / 100 - 5) ELSE score END AS score
  FROM ranked),
reranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rk FROM merged)"""

_METRICS = """
qrels AS (SELECT 't' || label AS qid, CAST(vec_id AS VARCHAR) AS doc_id, vec_id % 3 AS rel FROM embeddings),
runs AS (SELECT 'dense' AS system, qid, doc_id, rk FROM ranked
         UNION ALL SELECT 'rerank', qid, doc_id, rk FROM reranked),
cutoffs AS (SELECT unnest([1, 3, 5, 10, 100]) AS k),
judged AS (SELECT r.*, coalesce(q.rel, 0) AS rel FROM runs r LEFT JOIN qrels q
           ON q.qid = r.qid AND q.doc_id = r.doc_id),
counted AS (SELECT *, sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY system, qid ORDER BY rk) AS hits_here FROM judged),
best AS (SELECT qid, rel, row_number() OVER (PARTITION BY qid ORDER BY rel DESC) AS place FROM qrels WHERE rel > 0),
ideal AS (SELECT b.qid, k, sum(rel / log2(place + 1.0::DOUBLE)) AS dcg FROM best b, cutoffs WHERE place <= k
          GROUP BY b.qid, k),
relevant AS (SELECT qid, count(*) FILTER (WHERE rel > 0) AS n FROM qrels GROUP BY qid),
per_query AS (
  SELECT c.system, c.qid, k,
    sum(CASE WHEN rel > 0 THEN rel / log2(rk + 1.0::DOUBLE) ELSE 0 END) AS dcg,
    sum(CASE WHEN rel > 0 THEN CAST(hits_here AS DOUBLE) / rk ELSE 0 END) AS ap,
    CAST(sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS hits
  FROM counted c, cutoffs WHERE rk <= k GROUP BY c.system, c.qid, k),
metrics AS (
  SELECT system, CAST(p.k AS INTEGER) AS k, count(*) AS n_queries,
    round(avg(CASE WHEN i.dcg > 0 THEN p.dcg / i.dcg ELSE 0 END), 5) AS ndcg,
    round(avg(CASE WHEN n > 0 THEN ap / n ELSE 0 END), 5) AS map,
    round(avg(CASE WHEN n > 0 THEN hits / n ELSE 0 END), 5) AS recall,
    round(avg(hits / p.k), 5) AS precision
  FROM per_query p JOIN relevant r ON r.qid = p.qid LEFT JOIN ideal i ON i.qid = p.qid AND i.k = p.k
  GROUP BY system, p.k)"""

_COMPARED = """
compared AS (
  SELECT 'topics' AS dataset, d.k, d.n_queries,
    d.ndcg AS ndcg_dense, d.map AS map_dense, d.recall AS recall_dense, d.precision AS precision_dense,
    r.ndcg AS ndcg_rerank, r.map AS map_rerank, r.recall AS recall_rerank, r.precision AS precision_rerank,
    round(r.ndcg - d.ndcg, 5) AS ndcg_delta
  FROM metrics d JOIN metrics r ON r.k = d.k WHERE d.system = 'dense' AND r.system = 'rerank')"""

_SAMPLE = f"""
judged_ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS qid FROM labels),
known AS (SELECT CAST(doc_id AS VARCHAR) AS qid, text FROM documents
          WHERE CAST(doc_id AS VARCHAR) IN (SELECT qid FROM judged_ids)),
drawn AS (
  SELECT *, row_number() OVER (ORDER BY substr(sha256('{C.QUERY_SEED}:' || qid), 1, 15), qid) AS place FROM known),
picked AS (
  SELECT qid, text FROM drawn
  WHERE place <= {C.MAX_QUERIES} OR {C.MAX_QUERIES} >= (SELECT count(*) FROM judged_ids))"""

# --- evaluation runs --------------------------------------------------------------------------------------------

_EVAL = """
per_hour AS (
  SELECT event_type AS run, CAST(extract('hour' FROM ts) AS INTEGER) AS h,
    CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(value) AS mean,
    CAST(count(value) AS DOUBLE) AS n, min(value) AS low, max(value) AS high
  FROM events GROUP BY ALL),
fields AS (
  SELECT run, h, 1 AS pos, 'acc_norm,none' AS metric, mean AS number, NULL AS other FROM per_hour WHERE h < 6
  UNION ALL SELECT run, h, 2, 'acc,none', NULL, 'nan' FROM per_hour WHERE h < 6
  UNION ALL SELECT run, h, 0, 'zeta', high, NULL FROM per_hour WHERE h BETWEEN 6 AND 11
  UNION ALL SELECT run, h, 1, 'beta', n, NULL FROM per_hour WHERE h BETWEEN 6 AND 11
  UNION ALL SELECT run, h, 0, 'acc,none', NULL, '0.5' FROM per_hour WHERE h BETWEEN 12 AND 15
  UNION ALL SELECT run, h, 1, 'acc', mean, NULL FROM per_hour WHERE h BETWEEN 12 AND 15
  UNION ALL SELECT run, h, 0, 'acc', mean, NULL FROM per_hour WHERE h BETWEEN 16 AND 17
  UNION ALL SELECT run, h, 1, 'exact_match,strict-match', low, NULL FROM per_hour WHERE h BETWEEN 16 AND 17
  UNION ALL SELECT run, h, 0, 'n', n, NULL FROM per_hour WHERE h BETWEEN 18 AND 22
  UNION ALL SELECT run, h, 1, 'acc,none', low, NULL FROM per_hour WHERE h BETWEEN 18 AND 22),
named AS (
  SELECT run, 'h' || lpad(CAST(h AS VARCHAR), 2, '0') AS task,
    pos, metric, number, other,
    coalesce(list_position(['acc,none', 'acc_norm,none', 'exact_match,strict-match', 'acc'], metric), 9) AS rank
  FROM fields),
strict AS (
  SELECT run, task, metric, number AS value FROM named WHERE number IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run, task ORDER BY rank, pos) = 1),
lenient AS (
  SELECT run, task, metric, number, other FROM named WHERE number IS NOT NULL OR rank < 9
  QUALIFY row_number() OVER (PARTITION BY run, task ORDER BY rank, pos) = 1)"""

_FIRST_RUN, _LAST_RUN = EVAL_RUNS[0], EVAL_RUNS[-1]
_RUN_COLUMNS = ", ".join(
    f"round(max(value) FILTER (WHERE run = '{r}'), 6) AS {r}_value, max(metric) FILTER (WHERE run = '{r}') AS {r}_metric"
    for r in EVAL_RUNS
)
_STRICT_ROWS = f"WITH {_EVAL} SELECT run, task, metric, round(value, 6) AS value FROM strict"

_PASSAGES = f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id,
    CASE WHEN {_strip("source")} = '' THEN {_strip("text")}
         ELSE {_strip(_strip("source") + " || ' ' || " + _strip("text"))} END AS passage FROM documents"""

ORACLE: dict[str, str] = {
    "sft_examples": f"{_ALL} SELECT * FROM sft",
    "sft_first_rows": f"{_ALL} SELECT * FROM sft ORDER BY pos LIMIT {C.SFT_CAP}",
    "sft_from_lines": f"{_ALL} SELECT instruction, input, output FROM sft ORDER BY pos LIMIT {C.SFT_CAP}",
    "dpo_pairs": f"{_ALL} SELECT * FROM dpo",
    "dpo_first_rows": f"{_ALL} SELECT * FROM dpo ORDER BY pos LIMIT {C.DPO_CAP}",
    "cpt_corpus": f"{_ALL} SELECT * FROM cpt",
    "cpt_first_rows": f"{_ALL} SELECT * FROM cpt ORDER BY pos LIMIT {C.CPT_CAP}",
    "sft_from_files": f"{_ALL} SELECT * FROM sft",
    "dpo_from_files": f"{_ALL} SELECT * FROM dpo",
    "cpt_from_files": f"{_ALL} SELECT * FROM cpt",
    "judged_passages_from_files": f"""SELECT CAST(doc_id AS VARCHAR) AS qid, CAST(doc_id AS VARCHAR) AS doc_id, quality AS rel,
        CASE WHEN {_strip("source")} = '' THEN {_strip("text")}
             ELSE {_strip(_strip("source") + " || ' ' || " + _strip("text"))} END AS passage
        FROM documents JOIN labels USING (doc_id)""",
    "drop_reasons": f"""{_ALL}
        SELECT 'sft' AS role, reason, count(*) AS rows FROM sft_judged GROUP BY reason
        UNION ALL SELECT 'dpo', reason, count(*) FROM dpo_judged GROUP BY reason
        UNION ALL SELECT 'cpt', reason, count(*) FROM cpt_judged GROUP BY reason""",
    "row_accounting": f"{_ALL}, {_ACCOUNTING} SELECT * FROM accounting",
    "last_assistant_text": f"{_ALL} SELECT pos, chosen, rejected FROM dpo_raw",
    "chunked_content": f"SELECT doc_id, replace(text, {_NL}, '') AS content FROM documents",
    "jsonl_round_trip": f"{_ALL} SELECT instruction, input, chosen, rejected FROM dpo",
    "export_file_rows": f"{_ALL} SELECT count(*) AS rows, CAST(64 AS INTEGER) AS hash_length FROM cpt",
    "event_first_rows": f"SELECT user_id, event_id FROM events ORDER BY user_id, event_id LIMIT {C.EVENT_CAP}",
    "deduplicated_documents": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_normalised('text')}",
    "deduplicated_in_batches": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_normalised('text')}",
    "half_of_documents": f"""SELECT doc_id, lang FROM documents
        WHERE {_seeded(C.FRACTION_SEED)} < CAST({C.SHARE} * 1152921504606846976 AS BIGINT)""",
    "balanced_languages": f"""SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (
        PARTITION BY lang ORDER BY {_seeded(C.BALANCE_SEED)}, doc_id) <= {C.LANG_QUOTA}""",
    "balanced_margins": f"""WITH l AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
        q AS (SELECT CAST(floor({C.RAREST_SHARE} * min(n)) AS BIGINT) AS each, count(*) AS k FROM l),
        s AS (SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS i, count(*) OVER () AS m FROM documents GROUP BY source)
        SELECT 'lang' AS axis, lang AS value, each AS rows FROM l, q WHERE each > 0
        UNION ALL SELECT 'source', source, each * k // m + CASE WHEN i <= each * k % m THEN 1 ELSE 0 END FROM s, q WHERE each * k // m + CASE WHEN i <= each * k % m THEN 1 ELSE 0 END > 0""",
    "arm_comparison": f"""WITH k AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_normalised('text')}),
        a AS (SELECT 'before' AS arm, length(text) AS n FROM documents
          UNION ALL SELECT 'after', length(text) FROM documents SEMI JOIN k USING (doc_id)),
        s AS (SELECT arm, {{'rows': count(*)::DOUBLE, 'p50': quantile_cont(n, 0.5), 'p90': quantile_cont(n, 0.9), 'p95': quantile_cont(n, 0.95),
          'p99': quantile_cont(n, 0.99), 'mean': avg(n)}} AS v FROM a GROUP BY arm),
        l AS (SELECT arm, unnest(['rows', 'p50', 'p90', 'p95', 'p99', 'mean']) AS metric, unnest([v.rows, v.p50, v.p90, v.p95, v.p99, v.mean]) AS value FROM s)
        SELECT x.metric, round(x.value, 6) AS before, round(y.value, 6) AS after, round(y.value - x.value, 6) AS delta
        FROM l x JOIN l y ON x.metric = y.metric AND x.arm = 'before' AND y.arm = 'after'""",
    "part_quality": f"""WITH d AS (SELECT source, length(coalesce(text, '')) AS n, {_normalised("coalesce(text, '')")} AS k FROM documents),
        u AS (SELECT source AS dataset, n, k FROM d UNION ALL SELECT 'all', n, k FROM d),
        s AS (SELECT dataset, count(*)::DOUBLE AS r, count(DISTINCT k)::DOUBLE AS q, quantile_cont(n, [0.5, 0.9, 0.95, 0.99]) AS p, avg(n) AS m FROM u GROUP BY dataset),
        l AS (SELECT dataset,
          unnest(['rows', '{Q.TEXT_LENGTH}', '{Q.TEXT_LENGTH}', '{Q.TEXT_LENGTH}', '{Q.TEXT_LENGTH}', '{Q.TEXT_LENGTH}', '{Q.DUPLICATE_FRACTION}', '{Q.UNIQUE_KEYS}']) AS metric,
          unnest(['value', 'p50', 'p90', 'p95', 'p99', 'mean', 'value', 'value']) AS stat,
          unnest([r, p[1], p[2], p[3], p[4], m, 1 - q / r, q]) AS value FROM s)
        SELECT dataset, metric, stat, round(value, 6) AS value FROM l""",
    "arm_changes": f"""WITH k AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_normalised('text')}),
        a AS (SELECT doc_id, lang, source FROM documents),
        b AS (SELECT doc_id, CASE WHEN length(text) > {C.LONG_TEXT} THEN NULL ELSE lang END AS lang, source FROM documents SEMI JOIN k USING (doc_id))
        SELECT *, 'removed' AS change, count(*) AS rows FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
        UNION ALL SELECT *, 'added', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""",
    "seed_spread": """WITH p AS (SELECT lang, doc_id % 3 AS s, source, avg(n_chars) AS v FROM documents GROUP BY ALL)
        SELECT lang AS id, source AS task, count(*) AS n_seeds, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS spread
        FROM p GROUP BY lang, source""",
    "normalised_keys": f"SELECT doc_id, sha256({_normalised('text')}) AS norm_key FROM documents",
    "trigram_scores": f"WITH {_trigrams('documents', 'doc_id', 'text')} "
    "SELECT id AS doc_id, round(score, 6) AS score FROM repetition",
    "stripped_text": f"SELECT page_id, sha256({_strip('html')}) AS stripped FROM pages",
    "text_lengths": f"""{_ALL}
        SELECT pos, CAST(length(output) AS INTEGER) AS output_chars,
          CAST(length(instruction) + length(input) + length(output) AS INTEGER) AS total_chars,
          CAST(length({_strip(_joined("instruction", "input", "output"))}) AS INTEGER) AS filter_chars
        FROM sft_raw""",
    "pair_diagnostics": f"""{_ALL}
        SELECT pos, length(chosen) - length(rejected) AS len_diff,
          length(chosen) > length(rejected) AS chosen_longer, {_PREFIX} AS shared_prefix
        FROM dpo""",
    "document_passages": _PASSAGES,
    "length_percentiles": """SELECT count(*) AS rows,
        round(quantile_cont(CAST(length(text) AS DOUBLE), 0.5), 6) AS p50,
        round(quantile_cont(CAST(length(text) AS DOUBLE), 0.9), 6) AS p90,
        round(quantile_cont(CAST(length(text) AS DOUBLE), 0.95), 6) AS p95,
        round(quantile_cont(CAST(length(text) AS DOUBLE), 0.99), 6) AS p99,
        round(avg(length(text)), 6) AS mean FROM documents""",
    "duplicate_rate": f"""SELECT count(*) AS rows, {_DOC_UNIQUE} AS unique_keys,
        round({_DOC_DUP}, 6) AS duplicate_fraction FROM documents""",
    "sft_quality": f"{_ALL}, {_trigrams('sft', 'pos', 'output')} "
    + " UNION ALL ".join(
        [
            _line("sft", "rows", "value", "count(*)", "sft"),
            _length_lines("sft", Q.OUTPUT_LENGTH, "sft", "length(output)"),
            _length_lines("sft", Q.TOTAL_LENGTH, "sft", "length(instruction) + length(input) + length(output)"),
            _line("sft", Q.DUPLICATE_FRACTION, "value", _SFT_DUP, "sft"),
            _line("sft", Q.UNIQUE_KEYS, "value", _SFT_UNIQUE, "sft"),
            _line("sft", Q.TRIGRAM_MEAN, "value", "avg(score)", "repetition"),
        ]
    ),
    "dpo_quality": f"{_ALL} "
    + " UNION ALL ".join(
        [
            _line("dpo", "rows", "value", "count(*)", "dpo"),
            _length_lines("dpo", Q.CHOSEN_LENGTH, "dpo", "length(chosen)"),
            _length_lines("dpo", Q.REJECTED_LENGTH, "dpo", "length(rejected)"),
            _length_lines("dpo", Q.LENGTH_DIFFERENCE, "dpo", "length(chosen) - length(rejected)"),
            _line("dpo", Q.CHOSEN_LONGER, "value", "avg(CASE WHEN length(chosen) > length(rejected) THEN 1.0 ELSE 0.0 END)", "dpo"),
            _line("dpo", Q.SHARED_PREFIX, "value", f"avg(CASE WHEN {_PREFIX} THEN 1.0 ELSE 0.0 END)", "dpo"),
            _line("dpo", Q.DUPLICATE_FRACTION, "value", _DPO_DUP, "dpo"),
            _line("dpo", Q.UNIQUE_KEYS, "value", _DPO_UNIQUE, "dpo"),
        ]
    ),
    "content_digests": f"{_ALL}, {_DIGESTS} SELECT * FROM digests",
    "manifest_files": f"""{_ALL}, {_DIGESTS}, {_ACCOUNTING}
        SELECT role AS name, digest, exported_rows AS rows, 0::BIGINT AS files_that_differ FROM accounting JOIN digests USING (role)""",
    "export_descriptor": f"""{_ALL}, {_ACCOUNTING},
        fixed(name, formatting, ranking, roles) AS (VALUES
          ('sft', 'alpaca', CAST(NULL AS BOOLEAN), [['prompt', 'instruction'], ['query', 'input'], ['response', 'output']]),
          ('dpo', 'alpaca', true, [['prompt', 'instruction'], ['query', 'input'], ['chosen', 'chosen'], ['rejected', 'rejected']]),
          ('cpt', NULL, NULL, [['prompt', 'text']])),
        each AS (SELECT name, formatting, ranking, unnest(roles) AS r FROM fixed)
        SELECT e.name, e.name || '.jsonl' AS file, formatting, ranking, r[1] AS role, r[2] AS "column", exported_rows AS rows
        FROM each e JOIN accounting a ON a.role = e.name""",
    "export_manifest": f"""{_ALL}, {_ACCOUNTING}, {_DIGESTS}
        SELECT 'tables' AS recipe_id, CAST(1 AS INTEGER) AS schema_version, role, raw_rows, exported_rows, digest
        FROM accounting JOIN digests USING (role)""",
    "metrics_snapshot": f"""{_ALL}
        SELECT 'tables' AS recipe_id, (SELECT count(*) FROM sft) AS sft_rows, (SELECT count(*) FROM dpo) AS dpo_rows,
          (SELECT round(avg(length(output)), 6) FROM sft) AS sft_output_mean,
          (SELECT round(quantile_cont(CAST(length(chosen) AS DOUBLE), 0.95), 6) FROM dpo) AS dpo_chosen_p95,
          (SELECT round(avg(CASE WHEN length(chosen) > length(rejected) THEN 1.0 ELSE 0.0 END), 6) FROM dpo)
            AS dpo_chosen_longer""",
    "sampled_queries": f"WITH {_SAMPLE} SELECT qid, text FROM picked",
    "sampled_qrels": f"""WITH {_SAMPLE}
        SELECT CAST(doc_id AS VARCHAR) AS qid, CAST(doc_id AS VARCHAR) AS doc_id, quality AS rel FROM labels
        WHERE CAST(doc_id AS VARCHAR) IN (SELECT qid FROM picked)
           OR {C.MAX_QUERIES} >= (SELECT count(*) FROM judged_ids)""",
    "cosine_topk": f"WITH {_SEARCH} SELECT qid, doc_id, score, CAST(rk AS INTEGER) AS rk FROM ranked",
    "reranked": f"WITH {_SEARCH}, {_RERANK} "
    "SELECT qid, doc_id, round(score, 6) AS score, CAST(rk AS INTEGER) AS rk FROM reranked",
    "scored_heads": f"""WITH {_SEARCH}, p AS ({_PASSAGES})
        SELECT qid, r.doc_id, round(coalesce((length(passage) - length(translate(passage, qid, ''))) / (1.0 + length(passage)), 0), 6) AS score
        FROM ranked r LEFT JOIN p ON p.doc_id = r.doc_id WHERE rk <= {C.SEARCH.rerank_pool}""",
    "ranking_metrics": f"WITH {_SEARCH}, {_RERANK}, {_METRICS} SELECT * FROM metrics",
    "system_comparison": f"WITH {_SEARCH}, {_RERANK}, {_METRICS}, {_COMPARED} SELECT * FROM compared",
    "comparison_records": f"WITH {_SEARCH}, {_RERANK}, {_METRICS}, {_COMPARED} " + " UNION ALL ".join(
        f"SELECT dataset, n_queries, '{system}' AS system, '{m}@' || k AS metric, {m}_{system} AS value FROM compared"
        for system in (BASELINE, RERANKED)
        for m in METRICS
    ),
    "improvement_gate": f"""WITH {_SEARCH}, {_RERANK}, {_METRICS}, {_COMPARED}
        SELECT dataset, ndcg_dense AS ndcg_base, ndcg_rerank AS ndcg_new,
          NOT ndcg_rerank <= ndcg_dense + 1e-6 AS passed FROM compared WHERE k = 10""",
    "eval_numbers": f"""WITH {_EVAL}
        SELECT run, 'type=' || run AS model_args, task,
          CAST(pos AS INTEGER) AS pos,
          metric, round(number, 6) AS number FROM named WHERE number IS NOT NULL""",
    "eval_files": _STRICT_ROWS,
    "eval_pick_strict": _STRICT_ROWS,
    "eval_summary": f"""WITH {_EVAL}
        SELECT run, task, metric, CASE WHEN number IS NULL THEN other
          WHEN number = floor(number) THEN CAST(CAST(number AS BIGINT) AS VARCHAR)
          ELSE format('{{:.4f}}', number) END AS display
        FROM lenient""",
    "eval_comparison": f"""WITH {_EVAL}
        SELECT task, {_RUN_COLUMNS},
          round(max(value) FILTER (WHERE run = '{_LAST_RUN}') - max(value) FILTER (WHERE run = '{_FIRST_RUN}'), 6)
            AS delta_last_minus_first,
          max(metric) FILTER (WHERE run = '{_LAST_RUN}') = max(metric) FILTER (WHERE run = '{_FIRST_RUN}')
            AS same_metric
        FROM strict GROUP BY task""",
    "synthetic_pairs": f"""SELECT doc_id AS pos,
        'Give a concise, correct answer about ' || {S.TOPICS!r}[1 +
          CAST('0x' || substr(sha256(CAST(xor(CAST(13 AS BIGINT), doc_id) AS VARCHAR)), 1, 8) AS BIGINT) % 4]
          || ' (question #' || doc_id || ').' AS instruction,
        '' AS input, {_literal(S.CHOSEN)} AS chosen, {_literal(S.REJECTED)} AS rejected FROM documents""",
}
