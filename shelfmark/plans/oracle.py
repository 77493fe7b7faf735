"""What each query should return, as SQL over the same tables.

Written from the tables' columns, without JSON wherever the query's JSON only
carries them, so that it shares nothing with the operators it checks.
"""

from __future__ import annotations

_SPLIT = "CASE WHEN source IN ('src0','src5','src10','src15') THEN 'dev' ELSE 'train' END"

_UNIT = """
unit AS (
  SELECT vec_id AS row_id,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)
           / (sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * y))) + 1e-12)) AS e
  FROM embeddings)"""

_SIMS = f"""{_UNIT},
sims AS (
  SELECT q.row_id AS query_id, u.row_id, round(list_dot_product(q.e, u.e), 9) AS sim
  FROM unit u, unit q)"""

_TOP = f"""{_SIMS},
top AS (
  SELECT query_id, row_id, sim,
         row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, row_id) AS rank
  FROM sims QUALIFY rank <= 5)"""

_FIRST = _TOP.replace("FROM unit u, unit q", "FROM unit u, (SELECT * FROM unit WHERE row_id = 0) q")

# Documents whose line is well-formed and not blank, as a merge keeps them.
_KEPT = f"""
kept AS (
  SELECT {_SPLIT} AS split, source AS doc_type, lang, doc_id,
         '{{"doc_id": ' || doc_id || ', "text": ' || CAST(to_json(text) AS VARCHAR) || '}}' AS json
  FROM documents
  WHERE lang <> 'es' AND NOT (lang = 'fr' AND n_chars < 500))"""

_SUBJECTS = """
labelled AS (
  SELECT p_partkey, 'part-' || p_partkey AS id,
         CASE WHEN p_brand = 'Brand#2' THEN ' ' ELSE p_name END AS label,
         CASE WHEN p_size >= 20 THEN p_type || ' ' || p_brand END AS definition
  FROM part WHERE p_brand <> 'Brand#1'),
subject AS (
  SELECT p_partkey, id, CASE WHEN definition IS NULL THEN label ELSE label || '. ' || definition END AS text
  FROM labelled)"""

_ORDERS = """
ord AS (
  SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, year(o_orderdate) AS y,
         CASE WHEN year(o_orderdate) >= 2000 THEN 'dev' ELSE 'train' END AS split,
         'cust:' || c_custkey AS cust, 'nat:' || n_nationkey AS nat, 'seg:' || lower(c_mktsegment) AS seg,
         c_custkey, n_nationkey, c_name, n_name, c_mktsegment AS segment
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

_LABELS = f"""{_ORDERS},
mention AS (
  SELECT cust AS entity_id, c_name AS label FROM ord
  UNION ALL SELECT cust, segment FROM ord WHERE segment = 'BUILDING'
  UNION ALL SELECT nat, n_name FROM ord
  UNION ALL SELECT seg, segment FROM ord),
counts AS (
  SELECT entity_id, label, count(*) AS n_mentions FROM mention GROUP BY ALL),
canonical AS (
  SELECT entity_id, label FROM counts
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY n_mentions DESC, label) = 1)"""

_EDGES = """
edge AS (
  SELECT split, CAST(o_orderkey AS VARCHAR) AS paper_id, unnest([cust, nat]) AS subject_id FROM ord)"""

_PAPERS = """
paper AS (
  SELECT split, CAST(o_orderkey AS VARCHAR) AS paper_id,
         CASE WHEN status = 'P' THEN 'Report' ELSE 'Book' END AS record_type,
         'Order ' || o_orderkey || ' ' || n_name || CASE WHEN status = 'P' THEN ' ' || priority ELSE '' END AS title,
         segment || ' of ' || c_name AS abstract,
         CASE WHEN status <> 'O' THEN CASE WHEN segment = 'BUILDING' THEN 'de' ELSE 'en' END END AS lang_tag,
         CASE WHEN priority <> '5-LOW' THEN CAST(y AS INTEGER) END AS issued_year
  FROM ord)"""


def _hashed(source: str, key: str) -> str:
    """CTEs ``cell`` (key, pos, v): the hashed-word vector of every ``text``."""
    return f"""
word AS (
  SELECT {key} AS k, unnest(string_split_regex(text, '[ \\n\\t]')) AS w FROM {source}),
hit AS (
  SELECT k, CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % 64 AS pos, CAST(count(*) AS DOUBLE) AS n
  FROM word WHERE w <> '' GROUP BY ALL),
size AS (
  SELECT k, sqrt(sum(n * n)) + 1e-12 AS norm FROM hit GROUP BY k),
cell AS (
  SELECT s.k, p.pos, CAST(coalesce(h.n / z.norm, 0) AS FLOAT) AS v
  FROM (SELECT {key} AS k FROM {source}) s CROSS JOIN range(64) p(pos)
  LEFT JOIN hit h ON h.k = s.k AND h.pos = p.pos LEFT JOIN size z ON z.k = s.k)"""


def _truth_rows() -> str:
    kept = {
        ("O", "1-URGENT"): "'1'",
        ("O", "2-HIGH"): "'True'",
        ("O", "3-MEDIUM"): "' '",
        ("O", "4-NOT SPECIFIED"): "NULL",
        ("O", "5-LOW"): "NULL",
        ("P", "3-MEDIUM"): "'0'",
        ("P", "4-NOT SPECIFIED"): "'-0.5'",
    }
    return ", ".join(f"('{s}', '{p}', {v})" for (s, p), v in kept.items())


_SPOILT = """
spoilt AS (
  SELECT event_id, CASE event_type
      WHEN 'error' THEN props || ' trailing'
      WHEN 'view' THEN replace(props, '"', '''')
      WHEN 'click' THEN rtrim(props, '}')
      WHEN 'signup' THEN '[' || props || ']'
      ELSE props END AS line
  FROM events)"""

_GRID = """
grid AS (
  SELECT split, 'src' || n AS doc_type, lang
  FROM (VALUES ('train'), ('dev')) s(split), range(20) r(n), (VALUES ('de'), ('en'), ('es'), ('fr')) l(lang))"""

_AGENTS = """
agent AS (
  SELECT o_orderkey, 'creator' AS role, 'reference' AS kind, unnest([cust, seg]) AS value
  FROM ord WHERE segment IN ('MACHINERY', 'FURNITURE')
  UNION ALL SELECT o_orderkey, 'creator', 'literal', c_name FROM ord WHERE segment IN ('BUILDING', 'HOUSEHOLD')
  UNION ALL SELECT o_orderkey, 'creator', 'literal', n_name FROM ord WHERE status = 'O'
  UNION ALL SELECT o_orderkey, 'creator', 'reference', nat FROM ord WHERE status = 'P'
  UNION ALL SELECT o_orderkey, 'contributor', 'literal', 'Clerk' FROM ord
  UNION ALL SELECT o_orderkey, 'contributor', 'reference', cust FROM ord)"""


def _expanded(name: str) -> str:
    return (
        f"CASE WHEN {name} LIKE 'cust:%' THEN 'http://example.org/customer/' || substr({name}, 6) "
        f"WHEN {name} LIKE 'nat:%' THEN 'http://example.org/nation/' || substr({name}, 5) ELSE {name} END"
    )


ORACLE: dict[str, str] = {
    "topk_similar": f"WITH {_FIRST} SELECT query_id, row_id, CAST(rank AS INTEGER) AS rank, round(sim, 6) AS sim, "
    "printf('%.4f', sim) AS sim_text FROM top",
    "similarity_vector": f"WITH {_SIMS.replace('FROM unit u, unit q', 'FROM unit u, (SELECT * FROM unit WHERE row_id = 0) q')} "
    "SELECT row_id, round(sim, 6) AS sim FROM sims",
    "vector_norms": "SELECT vec_id AS row_id, round(sqrt(list_sum(list_transform(embedding, "
    "lambda y: CAST(y AS DOUBLE) * y))), 6) AS norm FROM embeddings",
    "normalized_vectors": f"WITH {_UNIT} SELECT row_id, CAST(pos AS INTEGER) AS pos, "
    "round(CAST(CAST(e[pos + 1] AS FLOAT) AS DOUBLE), 6) AS v FROM unit, range(64) p(pos)",
    "embedding_shape": "SELECT count(*) AS n_rows, CAST(max(len(embedding)) AS INTEGER) AS dim FROM embeddings",
    "batch_knn": f"WITH {_TOP} SELECT query_id, row_id, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM top",
    "batch_knn_pruned": f"WITH {_TOP} SELECT query_id, row_id, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM top",
    "graph_knn_recall": "SELECT least(count(*), 5) * count(*) AS n_exact, 0::BIGINT AS n_inexact, true AS finds_most, "
    "true AS scores_few FROM embeddings",
    "batch_knn_by_split": f"WITH {_TOP} SELECT query_id % 4 AS split, query_id // 4 AS query_id, row_id, round(sim, 6) AS sim, "
    "CAST(rank AS INTEGER) AS rank FROM top",
    "knn_with_text": f"WITH {_FIRST} SELECT row_id, query_id, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank, lang, text "
    "FROM top JOIN documents ON doc_id = row_id",
    "subject_text": f"WITH {_SUBJECTS} SELECT id, text FROM subject",
    "paper_text": f"SELECT {_SPLIT} AS split, 'doc-' || doc_id AS id, text FROM documents "
    "WHERE lang IN ('en', 'fr', 'de') AND source NOT IN ('src3', 'src4')",
    "paper_outcomes": f"SELECT {_SPLIT} AS split, CASE WHEN source = 'src4' THEN 'bad_content' "
    "WHEN lang = 'es' OR source = 'src3' THEN 'incomplete' ELSE 'embeddable' END AS outcome, "
    "count(*) AS n_records FROM documents GROUP BY ALL",
    "strict_json": f"WITH {_SPOILT} SELECT event_id, CASE WHEN NOT json_valid(line) THEN 'bad_json' "
    "WHEN json_type(line) <> 'OBJECT' THEN 'not_object' ELSE 'ok' END AS verdict, "
    "json_valid(line) AS is_json FROM spoilt",
    "skipped_report": f"SELECT {_SPLIT} AS split, source AS doc_type, lang, count(*) AS n_skipped "
    "FROM documents WHERE lang = 'es' GROUP BY ALL",
    "truthy_filter": f"SELECT o_orderkey, v_text FROM orders JOIN (VALUES {_truth_rows()}) "
    "t(status, priority, v_text) ON o_orderstatus = status AND o_orderpriority = priority",
    "merge_ordered": f"WITH {_KEPT} SELECT split, doc_type, lang, row_number() OVER (PARTITION BY split "
    "ORDER BY CAST(substr(doc_type, 4) AS INTEGER), lang, doc_id) - 1 AS row_id, json FROM kept",
    "merge_counts": f"WITH {_KEPT} SELECT split, count(*) AS n_records FROM kept GROUP BY split",
    "merge_coverage": f"WITH {_GRID} SELECT g.* FROM grid g ANTI JOIN (SELECT {_SPLIT} AS split, "
    "source AS doc_type, lang FROM documents) d USING (split, doc_type, lang)",
    "collection_files": f"SELECT {_SPLIT} AS split, source AS doc_type, lang, CAST(substr(source, 4) AS INTEGER) AS doc_type_ord, "
    "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS lang_ord, count(*) AS n_lines "
    "FROM documents WHERE NOT (lang = 'fr' AND n_chars < 500) GROUP BY ALL",
    "merged_text_files": f"WITH {_KEPT} SELECT split, json FROM kept",
    "hash_embed": f"WITH {_hashed('documents', 'doc_id')} SELECT k AS doc_id, CAST(pos AS INTEGER) AS pos, "
    "round(CAST(v AS DOUBLE), 6) AS v FROM cell",
    "embedding_table": f"WITH {_SUBJECTS} SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_id, id, text, "
    "64 AS dim, CASE WHEN trim(text) = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS norm FROM subject",
    "document_files": "SELECT CASE WHEN s_acctbal < 0 THEN 'dev' ELSE 'train' END AS split, "
    "CASE WHEN s_nationkey % 2 = 0 THEN 'Book' ELSE 'Report' END AS doc_type, "
    "CASE WHEN n_regionkey = 3 THEN 'de' ELSE 'en' END AS dir_lang, CAST(p AS INTEGER) AS position, "
    "CASE p WHEN 0 THEN 'nat:' || s_nationkey ELSE 'https://example.org/id/SUP%3A' || s_suppkey END AS node_id, "
    "CASE p WHEN 1 THEN 'bibo:Book' END AS node_type "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey, range(2) r(p)",
    "graph_nodes": f"WITH {_ORDERS} SELECT o_orderkey, split, CAST(p AS INTEGER) AS position, "
    "CASE p WHEN 0 THEN cust WHEN 1 THEN nat WHEN 2 THEN seg ELSE 'https://example.org/id/ORD%3A' || o_orderkey END "
    "AS node_id, CASE WHEN p = 3 THEN CASE WHEN status = 'P' THEN 'bibo:Report' ELSE 'bibo:Book' END END AS node_type "
    "FROM ord, range(4) r(p)",
    "graph_edges": f"WITH {_ORDERS}, {_EDGES} SELECT split, paper_id, subject_id FROM edge",
    "graph_labels": f"WITH {_LABELS} SELECT entity_id, label, n_mentions FROM counts",
    "canonical_labels": f"WITH {_LABELS} SELECT entity_id, label FROM canonical",
    "edge_labels": f"WITH {_LABELS}, {_EDGES} SELECT subject_id, paper_id, label AS subject_label "
    "FROM edge LEFT JOIN canonical ON subject_id = entity_id",
    "identifier_split": f"WITH {_ORDERS} SELECT CAST(o_orderkey AS VARCHAR) AS paper_id, scheme, "
    "prefix || o_orderkey AS value FROM ord, (VALUES ('ppn', ''), ('firstid', 'ORD:')) s(scheme, prefix)",
    "subject_split": f"WITH {_ORDERS}, s AS ("
    "SELECT o_orderkey, NULL AS scheme, NULL AS scheme_id, segment AS value FROM ord WHERE status = 'F' "
    "UNION ALL SELECT o_orderkey, 'prio', NULL, priority FROM ord WHERE status <> 'F' "
    "UNION ALL SELECT o_orderkey, 'bk', CAST(c_custkey AS VARCHAR), segment FROM ord WHERE status <> 'F' "
    "UNION ALL SELECT o_orderkey, NULL, NULL, '(other) ' || segment FROM ord WHERE status <> 'F') "
    "SELECT CAST(o_orderkey AS VARCHAR) AS paper_id, scheme, scheme_id, value FROM s",
    "term_resolve": f"WITH {_ORDERS}, {_AGENTS} SELECT CAST(o_orderkey AS VARCHAR) AS paper_id, role, kind, value, "
    f"CASE WHEN kind = 'reference' THEN {_expanded('value')} END AS iri FROM agent",
    "iri_expand": f"WITH {_ORDERS}, n AS (SELECT o_orderkey, "
    "unnest([cust, nat, seg, 'https://example.org/id/ORD%3A' || o_orderkey]) AS name FROM ord) "
    f"SELECT o_orderkey, name, {_expanded('name')} AS iri FROM n",
    "records_from_graph": f"WITH {_ORDERS}, {_PAPERS} SELECT *, title || '. ' || abstract AS text, "
    "CASE WHEN lang_tag = 'en' THEN title END AS title_en FROM paper",
    "subjects_from_graph": f"WITH {_LABELS}, {_EDGES} SELECT entity_id AS code, label, CAST(NULL AS VARCHAR) AS definition "
    "FROM canonical SEMI JOIN edge ON subject_id = entity_id",
    "split_audit_subjects": f"WITH {_ORDERS}, {_EDGES} SELECT subject_id, count(*) AS n_links FROM edge "
    "GROUP BY subject_id HAVING count(*) FILTER (split = 'train') = 0",
    "split_audit_texts": f"WITH d AS (SELECT {_SPLIT} AS split, lang, text FROM documents) "
    "SELECT sha256(length(lang) || ':' || lang || '|' || length(text) || ':' || text) AS text_key, "
    "count(*) AS n_docs, count(DISTINCT split) AS n_splits FROM d GROUP BY lang, text HAVING n_splits > 1",
    "suggested_subjects": f"""WITH {_LABELS}, {_EDGES}, {_PAPERS},
subj AS (
  SELECT row_number() OVER (ORDER BY entity_id) - 1 AS n, entity_id, label
  FROM canonical SEMI JOIN edge ON subject_id = entity_id),
item AS (
  SELECT 'p' || paper_id AS k, title || '. ' || abstract AS text FROM paper
  UNION ALL SELECT 's' || n, label FROM subj),
{_hashed('item', 'k')},
vec AS (
  SELECT k, list(CAST(v AS DOUBLE) ORDER BY pos) AS e, sqrt(sum(CAST(v AS DOUBLE) * v)) + 1e-12 AS norm
  FROM cell GROUP BY k),
pair AS (
  SELECT CAST(substr(p.k, 2) AS BIGINT) AS query_id, CAST(substr(s.k, 2) AS BIGINT) AS n,
         round(list_dot_product(p.e, s.e) / (p.norm * s.norm), 9) AS sim
  FROM vec p, vec s WHERE p.k LIKE 'p%' AND s.k LIKE 's%'),
best AS (
  SELECT query_id, n, sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, n) AS rank
  FROM pair QUALIFY rank <= 5)
SELECT query_id, CAST(rank AS INTEGER) AS rank, entity_id AS subject_id, round(sim, 6) AS sim FROM best JOIN subj USING (n)""",
}
