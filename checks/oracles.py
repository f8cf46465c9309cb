"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from checks.inputs import PRIORITY_TOPICS, STOP_WORDS
from checks.queries import LISTED, SEED, SHOWN_CLUSTERS
from quern.operators.lloyd import CLUSTERS, ETA, MAX_ITERATIONS
from quern.operators.postings import TOPIC_SPREAD

ORACLES: dict[str, str] = {}

_STOPS = ", ".join(f"('{w}')" for w in STOP_WORDS)
_STOP_LIST = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


# ---- words ---------------------------------------------------------------------------------


def _corpus(name: str, source: str, stops: str = f"SELECT w FROM (VALUES {_STOPS}) AS s(w)") -> str:
    """CTE of one corpus: the words between spaces within its lines, stop words left out, counted."""
    return f"""{name} AS (
  SELECT word, count(*) AS cnt
  FROM (SELECT unnest(string_split(line, ' ')) AS word
        FROM (SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n')) AS line FROM {source}))
  WHERE word <> '' AND word NOT IN ({stops})
  GROUP BY word)"""


_DOCUMENTS = _corpus("l", "documents")
_BENCHMARK = _corpus("r", "benchmark")
_CHAT = _corpus("c", "conversations")
_LISTED = (
    _corpus("b", "benchmark", "SELECT '' AS w")
    + f", listed AS (SELECT word FROM b ORDER BY cnt DESC, word LIMIT {LISTED})"
)

ORACLES["word_count"] = """
SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""

ORACLES["corpus_word_count"] = f"WITH {_DOCUMENTS} SELECT word, cnt FROM l"

ORACLES["file_stop_words"] = f"""
WITH {_LISTED}, {_corpus("d", "documents", "SELECT word FROM listed")} SELECT word, cnt FROM d"""

ORACLES["common_words"] = f"""
WITH {_DOCUMENTS}, {_BENCHMARK}
SELECT least(l.cnt, r.cnt) AS cnt, word FROM l JOIN r USING (word)"""

ORACLES["topk_common_words"] = ORACLES["common_words"] + " ORDER BY cnt DESC, word LIMIT 20"

ORACLES["multi_input_union"] = """
SELECT doc_id AS id, text, 'documents' AS source FROM documents
UNION ALL SELECT item_id, text, 'benchmark' FROM benchmark
UNION ALL SELECT conv_id, text, 'conversations' FROM conversations"""

ORACLES["text_lines"] = """
SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n')) AS value FROM documents WHERE text <> ''"""

ORACLES["kv_scan"] = """
SELECT conv_id || ':' || turn AS key,
       CASE WHEN turn % 3 <> 2 THEN role || chr(9) || translate(text, chr(13) || chr(10), '  ') ELSE '' END AS value
FROM conversations"""


# ---- recommendation ------------------------------------------------------------------------

_RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, p_brand || '|' || p_type AS item_id,
         max((l_quantity % 10) / 2) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2)"""
_MATRIX = """cooc AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS cnt
  FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id <> b.item_id
  GROUP BY 1, 2)"""
_RAW = """raw AS (
  SELECT user_id, item_b AS item_id, sum(cnt * rating) AS score
  FROM ratings JOIN cooc ON item_id = item_a
  GROUP BY 1, 2)"""

ORACLES["ratings_parse"] = f"WITH {_RATINGS} SELECT * FROM ratings"

ORACLES["user_preferences"] = f"""
WITH {_RATINGS}
SELECT user_id, CAST((n - 1) // 20 AS INTEGER) AS piece, string_agg(item_id || ':' || rating, ',' ORDER BY item_id) AS prefs
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS n FROM ratings) GROUP BY user_id, piece"""

ORACLES["item_raters"] = f"""
WITH {_RATINGS}
SELECT item_id, CAST((n - 1) // 20 AS INTEGER) AS piece, string_agg(user_id || ':' || rating, ',' ORDER BY user_id) AS raters
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY user_id) AS n FROM ratings) GROUP BY item_id, piece"""

ORACLES["cooccurrence_counts"] = f"WITH {_RATINGS}, {_MATRIX} SELECT * FROM cooc"

ORACLES["cooccurrence_rows"] = f"""
WITH {_RATINGS}, {_MATRIX}
SELECT item_a, CAST((n - 1) // 20 AS INTEGER) AS piece, string_agg(item_b || ':' || cnt, ',' ORDER BY item_b) AS entries
FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY item_b) AS n FROM cooc) GROUP BY item_a, piece"""

ORACLES["recommendation_raw_scores"] = f"WITH {_RATINGS}, {_MATRIX}, {_RAW} SELECT * FROM raw"

ORACLES["recommendations"] = f"""
WITH {_RATINGS}, {_MATRIX}, {_RAW}
SELECT * FROM raw ANTI JOIN ratings USING (user_id, item_id)"""

ORACLES["recommendations_rounded"] = ORACLES["recommendations"].replace(
    "sum(cnt * rating)", "sum(round(cnt * rating, 6))"
)
ORACLES["drop_seen"] = ORACLES["recommendations"]
ORACLES["recommendations_grid"] = ORACLES["recommendations"]


# ---- postings ------------------------------------------------------------------------------

_POSTINGS = """postings AS (
  SELECT 1 AS posting_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS parent_id,
         CAST(o_orderkey % 20 - 3 AS INTEGER) AS score, o_orderpriority AS tag
  FROM orders
  UNION ALL
  SELECT 2, l_orderkey * 10 + l_linenumber, l_orderkey, CAST(l_quantity AS INTEGER) - 6, NULL
  FROM lineitem)"""
_PAIRS = """pairs AS (
  SELECT q.*, a.id AS answer_id, a.score AS answer_score
  FROM postings q JOIN postings a ON a.parent_id = q.id AND a.posting_type = 2
  WHERE q.posting_type = 1)"""
_BEST = """best AS (
  SELECT posting_type, id, parent_id, score, tag, max(answer_score) AS max_score FROM pairs GROUP BY ALL)"""
_TOPIC_LIST = "[" + ", ".join(f"'{t}'" for t in PRIORITY_TOPICS) + "]"
_VECTORS = f"""vectors AS (
  SELECT id, CAST(coalesce(list_position({_TOPIC_LIST}, tag), 0) * {TOPIC_SPREAD} AS BIGINT) AS x,
         CAST(max_score AS BIGINT) AS y
  FROM best WHERE coalesce(list_position({_TOPIC_LIST}, tag), 0) > 0)"""
_POINTS = "points AS (SELECT x, y, count(*) AS w FROM vectors GROUP BY x, y)"
_TO_POINTS = f"{_POSTINGS}, {_PAIRS}, {_BEST}, {_VECTORS}, {_POINTS}"


def _ordered_start(k: int) -> str:
    """Distinct points at ranks floor(i * n / k) in (x, y) order."""
    return f"""placed AS (
  SELECT x, y, row_number() OVER (ORDER BY x, y) - 1 AS place, count(*) OVER () AS n FROM points),
c0 AS (
  SELECT CAST(i AS INTEGER) AS idx, x, y
  FROM placed JOIN (SELECT range AS i FROM range({k})) ON i < n AND place = (i * n) // least(n, {k}))"""


def _assigned(centers: str) -> str:
    """Points with their nearest centre; equal distances go to the lowest index."""
    return f"""(SELECT p.x, p.y, p.w,
            min(row(CAST((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) AS DOUBLE), c.idx)) AS near
     FROM points p CROSS JOIN {centers} c GROUP BY p.x, p.y, p.w)"""


def _means(centers: str) -> str:
    return f"""(SELECT near[2] AS idx, CAST(sum(x * w) // sum(w) AS BIGINT) AS x,
            CAST(sum(y * w) // sum(w) AS BIGINT) AS y
     FROM {_assigned(centers)} GROUP BY 1)"""


def _step(before: str, after: str) -> str:
    """One iteration; an empty cluster keeps its centre."""
    return f"""{after} AS (
  SELECT c.idx, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y
  FROM {before} c LEFT JOIN {_means(before)} m USING (idx))"""


_START = f"WITH {_TO_POINTS}, {_ordered_start(SHOWN_CLUSTERS)}"
_THREE = ", ".join(_step(f"c{i}", f"c{i + 1}") for i in range(3))


def _summary_of(centers: str) -> str:
    return f"""
SELECT c.x, c.y, size, median, average
FROM (SELECT near[2] AS idx, CAST(sum(w) AS BIGINT) AS size, CAST(sum(y * w) // sum(w) AS BIGINT) AS average
      FROM near GROUP BY 1)
JOIN (SELECT idx, CAST((min(y) + max(y)) // 2 AS BIGINT) AS median
      FROM (SELECT near[2] AS idx, y, row_number() OVER (PARTITION BY near[2] ORDER BY y) AS rn,
                   count(*) OVER (PARTITION BY near[2]) AS n
            FROM near, range(near.w))
      WHERE rn IN ((n + 1) // 2, n // 2 + 1) GROUP BY idx) USING (idx)
JOIN {centers} c USING (idx)
ORDER BY ALL"""


ORACLES["postings_parse"] = f"WITH {_POSTINGS} SELECT * FROM postings"
ORACLES["question_answer_join"] = f"WITH {_POSTINGS}, {_PAIRS} SELECT * FROM pairs"
ORACLES["question_answer_digest"] = f"""
WITH {_POSTINGS}, {_PAIRS}
SELECT id, score, tag, count(*) AS answers, CAST(sum(answer_score) AS BIGINT) AS total,
       md5(string_agg(answer_id || ':' || answer_score, ',' ORDER BY answer_id || ':' || answer_score)) AS digest
FROM pairs GROUP BY id, score, tag"""
ORACLES["posting_line_report"] = """
WITH lines AS (
  SELECT concat('1,', o_orderkey, ',,', o_orderkey % 20 - 3, ',', o_orderpriority) AS line, o_orderkey % 20 - 3 AS score FROM orders
  UNION ALL
  SELECT concat('2,', l_orderkey * 10 + l_linenumber, ',', l_orderkey, ',', CAST(l_quantity AS INTEGER) - 6, ','),
         CAST(l_quantity AS INTEGER) - 6
  FROM lineitem),
sorted AS (
  SELECT score, length(line) AS size, length(split_part(line, ',', 1)) + length(split_part(line, ',', 2)) + 1 AS head FROM lines)
SELECT CASE size % 7 WHEN 0 THEN 'type is no number' WHEN 1 THEN 'too few fields' WHEN 2 THEN 'parent is no number' ELSE 'kept' END AS reason,
       count(*) AS lines,
       CAST(sum(CASE size % 7 WHEN 0 THEN size + 1 WHEN 1 THEN head WHEN 2 THEN size + 1 ELSE score END) AS BIGINT) AS measure
FROM sorted GROUP BY 1"""
ORACLES["question_max_score"] = f"WITH {_POSTINGS}, {_PAIRS}, {_BEST} SELECT * FROM best"
ORACLES["posting_vectors"] = f"WITH {_POSTINGS}, {_PAIRS}, {_BEST}, {_VECTORS} SELECT * FROM vectors"

_DRAW = f"SELECT md5('{SEED}:' || id) AS draw, x, y FROM vectors ORDER BY draw, x, y LIMIT {CLUSTERS}"
ORACLES["sample_points"] = f"WITH {_POSTINGS}, {_PAIRS}, {_BEST}, {_VECTORS} {_DRAW}"

ORACLES["nearest_center"] = f"{_START} SELECT x, y, w, near[2] AS idx, near[1] AS dist FROM {_assigned('c0')}"
ORACLES["kmeans_step"] = f"{_START} SELECT idx, x, y FROM {_means('c0')}"
ORACLES["kmeans_3_iterations"] = f"{_START}, {_THREE} SELECT idx, x, y FROM c3"
ORACLES["kmeans_summary"] = f"{_START}, {_THREE}, near AS {_assigned('c3')} {_summary_of('c3')}"
ORACLES["kmeans_history"] = f"{_START}, {_THREE}, steps AS (" + " UNION ALL ".join(
    f"""
  SELECT {i + 1} AS iter, idx, o.x AS old_x, o.y AS old_y, n.x AS new_x, n.y AS new_y,
         CAST((n.x - o.x) * (n.x - o.x) + (n.y - o.y) * (n.y - o.y) AS DOUBLE) AS moved
  FROM c{i} o JOIN c{i + 1} n USING (idx)"""
    for i in range(3)
) + """)
SELECT *, sum(moved) OVER (PARTITION BY iter) AS total_moved, sum(moved) OVER (PARTITION BY iter) < 0 AS converged,
       iter >= 3 AS reached_max
FROM steps"""


def _loop(start: str) -> str:
    """All iterations until the centres move less than ETA in total."""
    return f"""WITH RECURSIVE {_TO_POINTS}, {start},
loop AS (
  SELECT 0 AS iter, idx, x AS old_x, y AS old_y, x, y, CAST(1e18 AS DOUBLE) AS total_moved FROM c0
  UNION ALL
  SELECT iter + 1, idx, old_x, old_y, x, y,
         sum(CAST((x - old_x) * (x - old_x) + (y - old_y) * (y - old_y) AS DOUBLE)) OVER ()
  FROM (SELECT c.iter, c.idx, c.x AS old_x, c.y AS old_y, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y
        FROM loop c LEFT JOIN {_means('loop')} m USING (idx)
        WHERE c.total_moved >= {ETA} AND c.iter < {MAX_ITERATIONS}))"""


_SAMPLED = f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY draw, x, y) - 1 AS INTEGER) AS idx, x, y FROM ({_DRAW}))"
ORACLES["kmeans_converged"] = f"""{_loop(_SAMPLED)},
final AS (SELECT idx, x, y FROM loop WHERE iter = (SELECT max(iter) FROM loop)),
near AS {_assigned('final')} {_summary_of('final')}"""

ORACLES["kmeans_converged_history"] = f"""{_loop(_ordered_start(CLUSTERS))}
SELECT iter, idx, old_x, old_y, x AS new_x, y AS new_y,
       CAST((x - old_x) * (x - old_x) + (y - old_y) * (y - old_y) AS DOUBLE) AS moved,
       total_moved, total_moved < {ETA} AS converged, iter >= {MAX_ITERATIONS} AS reached_max
FROM loop WHERE iter > 0"""


# ---- short texts ---------------------------------------------------------------------------

_LINES = """lines AS (
  SELECT doc_id, lang, unnest(regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n')) AS line FROM documents WHERE text <> '')"""
_TOKENS = f"""tokens AS (
  SELECT doc_id, lang,
         CASE WHEN line <> '' AND regexp_replace(line, '[ \\t\\n\\r\\f\\v]+$', '') = '' THEN []
              ELSE regexp_split_to_array(lower(regexp_replace(line, '[ \\t\\n\\r\\f\\v]+$', '')), '[ \\t\\n\\r\\f\\v]')
         END AS tokens
  FROM lines),
clean AS (
  SELECT doc_id, lang, tokens, list_filter(tokens, lambda t: NOT list_contains({_STOP_LIST}, t)) AS kept FROM tokens),
counts AS (
  SELECT lang, word, count(*) AS cnt FROM (SELECT lang, unnest(kept) AS word FROM clean)
  WHERE word <> '' GROUP BY lang, word)"""

ORACLES["tail_field_text"] = f"""
WITH {_LINES}
SELECT doc_id, regexp_replace(line, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS text FROM lines"""

ORACLES["tokens_clean"] = f"""
WITH {_LINES}, {_TOKENS}
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n, array_to_string(kept, ' ') AS kept FROM clean"""

ORACLES["tokens_clean_joined"] = f"""
WITH {_LINES}, {_TOKENS}, {_LISTED}, stops AS (SELECT list(lower(word)) AS stop FROM listed)
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n,
       array_to_string(list_filter(tokens, lambda t: NOT list_contains(stop, t)), ' ') AS kept
FROM clean CROSS JOIN stops"""

ORACLES["token_freq_by_group"] = f"WITH {_LINES}, {_TOKENS} SELECT lang, word, cnt FROM counts"

ORACLES["top_tokens_by_group"] = f"""
WITH {_LINES}, {_TOKENS}
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, word) AS INTEGER) AS rank, word, cnt
FROM counts QUALIFY rank <= 5"""

ORACLES["word2vec_vocabulary"] = f"""
WITH {_LINES}, {_TOKENS}
SELECT word FROM (SELECT unnest(kept) AS word FROM clean) GROUP BY word HAVING count(*) >= 2"""

ORACLES["word2vec_means"] = f"WITH {_LINES} SELECT count(*) AS texts, 0 AS differing FROM lines"
ORACLES["text_cluster_sizes"] = f"WITH {_LINES} SELECT {SHOWN_CLUSTERS} AS clusters, count(*) AS texts FROM lines"
ORACLES["pca_facts"] = "SELECT count(*) AS points, 0::DOUBLE AS covariance, true AS ordered FROM embeddings"
ORACLES["ml_kmeans_facts"] = "SELECT count(*) AS points, 0 AS misplaced FROM embeddings"

ORACLES["cluster_report_by_key"] = f"""
WITH {_LINES}, {_TOKENS},
keys AS (SELECT CAST(range AS INTEGER) AS cluster FROM range({SHOWN_CLUSTERS} + 1)),
sizes AS (SELECT doc_id % {SHOWN_CLUSTERS} AS cluster, count(*) AS size FROM clean GROUP BY 1),
freq AS (
  SELECT cluster, word, count(*) AS n
  FROM (SELECT doc_id % {SHOWN_CLUSTERS} AS cluster, unnest(kept) AS word FROM clean) WHERE word <> '' GROUP BY ALL),
top AS (
  SELECT cluster, string_agg(word || ':' || n, ' ' ORDER BY n DESC, word) AS top
  FROM (SELECT * FROM freq QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, word) <= 5) GROUP BY cluster)
SELECT cluster, coalesce(size, 0) AS size, CAST(cluster AS DOUBLE) AS center_x, coalesce(top, '') AS top
FROM keys LEFT JOIN sizes USING (cluster) LEFT JOIN top USING (cluster)"""

ORACLES["silhouette_by_label"] = """
WITH long AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
norms AS (SELECT vec_id, label, sum(v * v) AS sq FROM long GROUP BY ALL),
sizes AS (SELECT label, count(*) AS n, sum(sq) AS sq FROM norms GROUP BY label),
sums AS (SELECT label, d, sum(v) AS v FROM long GROUP BY ALL),
dots AS (SELECT l.vec_id, s.label AS other, sum(l.v * s.v) AS dot FROM long l JOIN sums s USING (d) GROUP BY ALL),
means AS (
  SELECT vec_id, n.label, other, z.n, n.sq + z.sq / z.n - 2 * dot / z.n AS mean
  FROM norms n JOIN dots USING (vec_id) JOIN sizes z ON z.label = other),
sides AS (
  SELECT vec_id, max(n) FILTER (label = other) AS n,
         max(mean * n / nullif(n - 1, 0)) FILTER (label = other) AS a, min(mean) FILTER (label <> other) AS b
  FROM means GROUP BY vec_id)
SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides"""

ORACLES["vector_text"] = """
SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS "at", unnest(embedding)::DOUBLE AS value
FROM embeddings"""


# ---- comparison ----------------------------------------------------------------------------

ORACLES["result_diff"] = f"""
WITH {_RATINGS},
expected AS (SELECT user_id, item_id, rating AS score FROM ratings),
actual AS (
  SELECT user_id, item_id, CASE WHEN CAST(user_id AS BIGINT) % 7 = 0 THEN score + 0.5 ELSE score END AS score
  FROM expected)
SELECT 'expected only' AS side, *, count(*) AS copies
FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual) GROUP BY ALL
UNION ALL
SELECT 'actual only', *, count(*) FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM expected) GROUP BY ALL"""

ORACLES["topk_diff"] = f"""
WITH {_DOCUMENTS}, {_BENCHMARK}, {_CHAT},
e AS (SELECT least(l.cnt, r.cnt) AS cnt, word FROM l JOIN r USING (word) ORDER BY cnt DESC, word LIMIT 20),
a AS (SELECT least(l.cnt, c.cnt) AS cnt, word FROM l JOIN c USING (word) ORDER BY cnt DESC, word LIMIT 20),
g AS (
  SELECT coalesce(e.cnt, a.cnt) AS cnt, count(e.word) AS expected, count(a.word) AS actual,
         count(*) FILTER (e.word IS NOT NULL AND a.word IS NOT NULL) AS shared
  FROM e FULL JOIN a ON e.cnt = a.cnt AND e.word = a.word GROUP BY 1)
SELECT *, CASE WHEN expected = 0 THEN 'unexpected count'
               WHEN actual = 0 THEN 'missing count'
               WHEN cnt = (SELECT min(cnt) FROM e) THEN CASE WHEN shared = actual THEN 'ok' ELSE 'not a subset' END
               WHEN shared = expected AND shared = actual THEN 'ok'
               ELSE 'words differ' END AS status
FROM g"""

ORACLES["top_k_verdict"] = f"""
WITH statuses AS ({ORACLES["topk_diff"]}),
bad AS (SELECT status FROM statuses WHERE status <> 'ok')
SELECT 'same' AS "case", 'passed' AS verdict
UNION ALL
SELECT 'turned', CASE WHEN (SELECT count(DISTINCT cnt) FROM ({ORACLES["topk_common_words"]})) > 1
                      THEN 'wrong order' ELSE 'passed' END
UNION ALL
SELECT 'other', CASE WHEN NOT EXISTS (FROM bad) THEN 'passed'
                     WHEN NOT EXISTS (FROM bad WHERE status <> 'unexpected count') THEN 'too long'
                     ELSE 'wrong words' END"""

ORACLES["result_verdict"] = f"""
WITH {_RATINGS}, turned AS (SELECT item_id AS user_id, user_id AS item_id, rating FROM ratings),
back AS (SELECT item_id AS user_id, user_id AS item_id, rating FROM turned)
SELECT CASE WHEN NOT EXISTS (SELECT * FROM ratings EXCEPT ALL SELECT * FROM turned)
             AND NOT EXISTS (SELECT * FROM turned EXCEPT ALL SELECT * FROM ratings) THEN 'same'
            WHEN NOT EXISTS (SELECT * FROM ratings EXCEPT ALL SELECT * FROM back)
             AND NOT EXISTS (SELECT * FROM back EXCEPT ALL SELECT * FROM ratings) THEN 'swapped'
            ELSE 'different' END AS verdict"""

ORACLES["order_breaks"] = f"""
WITH {_LINES}, {_TOKENS},
ranked AS (
  SELECT CAST(row_number() OVER (ORDER BY sum(cnt) DESC, word) AS INTEGER) AS rank, CAST(sum(cnt) AS BIGINT) AS cnt
  FROM counts GROUP BY word QUALIFY rank <= 1000),
raised AS (SELECT rank, CASE WHEN rank % 5 = 0 THEN cnt + 100 ELSE cnt END AS cnt FROM ranked)
SELECT * FROM (SELECT rank, cnt, lag(cnt) OVER (ORDER BY rank) AS previous FROM raised) WHERE cnt > previous"""


# ---- sinks ---------------------------------------------------------------------------------

ORACLES["kv_sink"] = f"SELECT word AS key, CAST(cnt AS VARCHAR) AS value FROM ({ORACLES['word_count']})"
ORACLES["score_sink"] = f"WITH {_RATINGS} SELECT user_id || chr(9) || item_id || ',' || rating AS value FROM ratings"
ORACLES["score_csv_sink"] = ORACLES["ratings_parse"]
ORACLES["projection_sink"] = """
SELECT embedding[i]::DOUBLE AS x, embedding[i + 1]::DOUBLE AS y, cluster
FROM (SELECT embedding, label AS cluster, unnest(range(1, len(embedding), 2)) AS i FROM embeddings)"""
ORACLES["projection_sink_bracketed"] = ORACLES["projection_sink"]
ORACLES["text_sink"] = f"WITH {_LINES} SELECT line AS value, count(*) AS cnt FROM lines GROUP BY line"
ORACLES["short_text_csv"] = """
SELECT md5(regexp_replace(text, '[^\\x{00}-\\x{ff}]', '?', 'g')) AS digest FROM documents"""
ORACLES["silhouette_sweep_facts"] = """
SELECT CAST(k AS INTEGER) AS k, CAST(s AS INTEGER) AS vector_size, CAST(m AS INTEGER) AS min_count, true AS in_order, true AS as_alone
FROM (VALUES (3, 3, 2), (5, 3, 2), (4, 2, 1)) AS v(k, s, m), (SELECT count(*) AS n FROM documents) WHERE n > 0"""
