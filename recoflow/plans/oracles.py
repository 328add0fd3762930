"""The catalogue as SQL, for an independent engine to check.

``PARTS`` are named sub-queries; each oracle is a final SELECT, and the parts
it mentions (directly or through others) become its WITH clause.
"""

from __future__ import annotations

import re

from recoflow.operators.similar import projections
from recoflow.plans import inputs as I
from recoflow.sources.adapters import STOPWORDS

STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
SPLIT = f"TIMESTAMP '{I.SPLIT} 00:00:00'"
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _unrolled_rank(iterations: int) -> dict[str, str]:
    parts = {"rank0": "SELECT article_id, x, 1e0 / n AS r FROM word_out JOIN word_size USING (article_id)"}
    for i in range(1, iterations + 1):
        parts[f"rank{i}"] = f"""SELECT t.article_id, t.x, 0.15e0 + 0.85e0 * sum(t.p * r.r) AS r
            FROM word_moves t JOIN rank{i - 1} r ON r.article_id = t.article_id AND r.x = t.y
            GROUP BY t.article_id, t.x"""
    return parts


def _buckets(column: str, spec: dict) -> str:
    tables = projections(spec["dim"], spec["tables"], spec["per_table"])
    one = lambda r: f"floor(list_dot_product({column}, {r!r}::DOUBLE[]) / {spec['bucket_length']!r})"
    return "[" + ", ".join("[" + ", ".join(one(r) for r in t) + "]" for t in tables) + "]"


def _nearest(left: str, right: str, threshold: float, k: int = 10, where: str = "TRUE") -> str:
    return f"""SELECT article_id, channel_id, similar_id, distance, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id, channel_id ORDER BY distance, similar_id) AS rank
        FROM (SELECT a.article_id, a.channel_id, b.article_id AS similar_id,
                     round(list_distance(a.v, b.v), 4) AS distance
              FROM {left} a JOIN {right} b ON a.channel_id = b.channel_id AND a.article_id <> b.article_id
              WHERE ({where}) AND list_distance(a.v, b.v) < {threshold!r})) WHERE rank <= {k}"""


def _similar(left: str, right: str, spec: dict) -> str:
    shared = " OR ".join(f"a.b[{i}] = b.b[{i}]" for i in range(1, spec["tables"] + 1))
    return _nearest(left, right, spec["threshold"], where=shared)


def _served_channel() -> str:
    return f"CASE WHEN event_type = 'error' THEN 0 ELSE CAST({K} % 25 + 1 AS INTEGER) END"


def _message(action: str, article: str) -> str:
    return (f"to_json({{'action': '{action}', 'userId': user_id::VARCHAR, "
            f"'articleId': {article}, 'algorithmCombine': strategy}})::VARCHAR")


_DAY_MS = "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) * 86400000"

PARTS: dict[str, str] = {
    # action log
    "log": f"""SELECT event_id, user_id, ts AS action_time, {K} AS k, value,
        CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'collect' WHEN 'signup' THEN 'share'
             WHEN 'view' THEN 'exposure' WHEN 'error' THEN 'read' END AS action,
        CAST({K} % 25 + 1 AS INTEGER) AS channel_id FROM events""",
    "flags": """SELECT user_id, action_time,
        unnest(CASE WHEN action = 'exposure' THEN [k, (k + 1) % 100, (k + 7) % 100] ELSE [k] END) AS article_id,
        channel_id, action = 'share' AS shared, action = 'click' AS clicked, action = 'collect' AS collected,
        TRUE AS exposure, value AS read_time FROM log""",
    "fold": """SELECT user_id, article_id, max(action_time) AS action_time, max(channel_id) AS channel_id,
        bool_or(shared) AS shared, bool_or(clicked) AS clicked, bool_or(collected) AS collected,
        bool_or(exposure) AS exposure, max(read_time) AS read_time FROM flags GROUP BY user_id, article_id""",
    "earlier": f"SELECT DISTINCT user_id, channel_id, article_id FROM flags WHERE action_time < {SPLIT}",
    "later": f"SELECT DISTINCT user_id, channel_id, article_id FROM flags WHERE action_time >= {SPLIT}",
    # text
    "docs": """SELECT doc_id AS article_id, text,
        CAST(regexp_replace(source, '[^0-9]', '', 'g') AS INTEGER) AS channel_id FROM documents""",
    "words": rf"""SELECT article_id, channel_id, list_filter(
        string_split_regex(lower(regexp_replace(text, '<.*?>', '', 'g')), '[^\p{{L}}]+'),
        lambda w: length(w) >= 3 AND w NOT IN ({STOP})) AS words FROM docs""",
    "tf": """SELECT article_id, channel_id, w AS keyword, count(*) AS tf
        FROM (SELECT article_id, channel_id, unnest(words) AS w FROM words) GROUP BY ALL""",
    "vocabulary": """SELECT keyword, count(*) AS df, sum(tf) AS n FROM tf GROUP BY keyword""",
    "idf": """SELECT keyword, ln(((SELECT count(*) FROM docs) + 1e0) / (df + 1e0)) AS idf,
        row_number() OVER (ORDER BY n DESC, keyword) - 1 AS idx FROM vocabulary""",
    "tfidf": """SELECT article_id, channel_id, keyword, tfidf FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY tfidf DESC, keyword) AS rn
        FROM (SELECT article_id, channel_id, keyword, round(tf * idf, 4) AS tfidf FROM tf JOIN idf USING (keyword)))
        WHERE rn <= 20""",
    "positions": r"""SELECT article_id, channel_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
        FROM (SELECT article_id, channel_id, string_split_regex(lower(text), '[^\p{L}]+') AS ws FROM docs)""",
    "candidates": f"""SELECT article_id, channel_id, w, p FROM positions
        WHERE length(w) >= 3 AND w NOT IN ({STOP})""",
    "word_pairs": """SELECT a.article_id, a.w AS x, b.w AS y
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS d FROM candidates) a
        JOIN candidates b ON b.article_id = a.article_id AND b.p = a.p + a.d""",
    "word_edges": """SELECT article_id, x, y, count(*)::DOUBLE AS w FROM (
        SELECT article_id, x, y FROM word_pairs UNION ALL SELECT article_id, y AS x, x AS y FROM word_pairs)
        GROUP BY ALL""",
    "word_out": "SELECT article_id, x, sum(w) AS o FROM word_edges GROUP BY article_id, x",
    "word_size": "SELECT article_id, count(*) AS n FROM word_out GROUP BY article_id",
    "word_moves": """SELECT e.article_id, e.x, e.y, e.w / o.o AS p FROM word_edges e
        JOIN word_out o ON o.article_id = e.article_id AND o.x = e.y""",
    **_unrolled_rank(10),
    "ranked": """SELECT article_id, channel_id, keyword, textrank FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY textrank DESC, keyword) AS rn FROM (
          SELECT r.article_id, d.channel_id, r.x AS keyword, round((r.r - lo / 10) / (hi - lo / 10), 8) AS textrank
          FROM rank10 r JOIN docs d USING (article_id)
          JOIN (SELECT article_id, min(r) AS lo, max(r) AS hi FROM rank10 GROUP BY article_id) USING (article_id)))
        WHERE rn <= 20""",
    "weighted": """SELECT article_id, channel_id, keyword, textrank * idf AS weight
        FROM ranked JOIN idf USING (keyword)""",
    "topic_terms": """SELECT t.article_id, t.keyword FROM tfidf t
        WHERE EXISTS (SELECT 1 FROM ranked r WHERE r.article_id = t.article_id AND r.keyword = t.keyword)""",
    # users
    "scored": f"""SELECT user_id, article_id,
        1e0 / (ln(floor(epoch(TIMESTAMP '{I.NOW}' - action_time) / 86400) + 1e0) + 1e0)
        * (3 * shared::INT + 5 * clicked::INT + 2 * collected::INT
           + CASE WHEN coalesce(read_time, 0) > {I.READ_THRESHOLD} THEN 2 ELSE 1 END) AS score FROM fold""",
    "interests": """SELECT user_id, t.channel_id, keyword AS topic, sum(score) AS weight
        FROM scored JOIN tfidf t USING (article_id) GROUP BY user_id, t.channel_id, keyword""",
    # vectors
    "vectors": "SELECT vec_id AS article_id, label AS channel_id, embedding::DOUBLE[] AS v FROM embeddings",
    "hashed": f"SELECT article_id, channel_id, v, {_buckets('v', I.LSH)} AS b FROM vectors",
    "near": _nearest("vectors", "vectors", I.LSH["threshold"]),
    "term_vectors": """SELECT keyword, v FROM idf
        JOIN vectors ON article_id = idx % (SELECT count(*) FROM vectors)""",
    "weighted_vectors": """SELECT DISTINCT article_id, channel_id,
        list_transform(v, lambda x: x * tfidf) AS v FROM tfidf JOIN term_vectors USING (keyword)""",
    "article_mean": """SELECT article_id, channel_id, list(m ORDER BY pos) AS v FROM (
        SELECT article_id, channel_id, pos, avg(x) AS m
        FROM (SELECT article_id, channel_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM weighted_vectors)
        GROUP BY ALL) GROUP BY article_id, channel_id""",
    "hashed_new": f"SELECT article_id, channel_id, v, {_buckets('v', I.LSH_NEW)} AS b FROM article_mean",
    "hashed_known": f"SELECT article_id, channel_id, v, {_buckets('v', I.LSH_NEW)} AS b FROM vectors",
    # recall
    "hot_scores": """SELECT channel_id, k AS article_id, count(*) AS score FROM log
        WHERE action NOT IN ('exposure', 'read') GROUP BY channel_id, k""",
    "hot": """SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY channel_id ORDER BY score DESC, article_id) AS rank FROM hot_scores) WHERE rank <= 10""",
    "arrived": "SELECT channel_id, k AS article_id, max(action_time) AS arrived FROM log GROUP BY channel_id, k",
    "stored": f"""SELECT DISTINCT user_id, channel_id, CASE action WHEN 'collect' THEN 'als'
        WHEN 'click' THEN 'content' ELSE 'online' END AS recall_type, k AS article_id
        FROM log WHERE action IN ('collect', 'click', 'share') AND action_time >= {SPLIT}""",
    "requests": f"""SELECT DISTINCT user_id, channel_id, {I.ARTICLE_NUM} AS article_num,
        CAST({I.REQUEST_MS} AS BIGINT) AS time_stamp FROM log""",
    "recalled": """SELECT user_id, channel_id, article_id, list_sort(list(DISTINCT recall_type)) AS sources FROM (
        SELECT s.user_id, s.channel_id, s.article_id, s.recall_type FROM requests JOIN stored s USING (user_id, channel_id)
        UNION ALL SELECT user_id, channel_id, article_id, 'new' FROM requests JOIN arrived USING (channel_id)
        UNION ALL SELECT user_id, channel_id, article_id, 'hot' FROM requests JOIN hot USING (channel_id))
        GROUP BY user_id, channel_id, article_id""",
    "served": f"""SELECT user_id, channel_id, request_ts,
        row_number() OVER (PARTITION BY user_id, channel_id, request_ts ORDER BY event_id) AS pos, article_id
        FROM (SELECT event_id, user_id, {_served_channel()} AS channel_id, {_DAY_MS} AS request_ts, {K} AS article_id
              FROM events WHERE ts < {SPLIT})""",
    "served_all": f"""SELECT user_id, channel_id, request_ts,
        row_number() OVER (PARTITION BY user_id, channel_id, request_ts ORDER BY event_id) AS pos, article_id
        FROM (SELECT event_id, user_id, {_served_channel()} AS channel_id, {_DAY_MS} AS request_ts, {K} AS article_id
              FROM events)""",
    "stored_all": """SELECT DISTINCT user_id, channel_id, CASE action WHEN 'collect' THEN 'als'
        WHEN 'click' THEN 'content' ELSE 'online' END AS recall_type, k AS article_id
        FROM log WHERE action IN ('collect', 'click', 'share')""",
    "recalled_all": """SELECT user_id, channel_id, article_id, list_sort(list(DISTINCT recall_type)) AS sources FROM (
        SELECT s.user_id, s.channel_id, s.article_id, s.recall_type FROM requests JOIN stored_all s USING (user_id, channel_id)
        UNION ALL SELECT user_id, channel_id, article_id, 'new' FROM requests JOIN arrived USING (channel_id)
        UNION ALL SELECT user_id, channel_id, article_id, 'hot' FROM requests JOIN hot USING (channel_id))
        GROUP BY user_id, channel_id, article_id""",
    # features
    "user_feats": """SELECT user_id, channel_id, list(weight ORDER BY weight) AS weights FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, channel_id ORDER BY weight) AS rn FROM interests)
        WHERE rn <= 10 GROUP BY user_id, channel_id""",
    "article_feats": """SELECT article_id, t.channel_id, list_resize(w, 10, 0e0) AS w, v FROM (
        SELECT article_id, min(channel_id) AS channel_id, list_slice(list(tfidf ORDER BY tfidf), 1, 10) AS w
        FROM tfidf GROUP BY article_id) t JOIN vectors USING (article_id)""",
    "samples": """SELECT f.user_id, f.article_id, a.channel_id, a.v, a.w,
        list_resize(coalesce(u.weights, []), 10, 0e0) AS u, f.clicked::INT AS clicked,
        u.weights AS raw, f.user_id IN (SELECT user_id FROM user_feats) AS profiled
        FROM fold f JOIN article_feats a USING (article_id)
        LEFT JOIN user_feats u ON u.user_id = f.user_id AND u.channel_id = a.channel_id""",
    "label_scores": """SELECT n_chars / (n_chars + 2000) AS score, quality AS label
        FROM labels JOIN documents USING (doc_id)""",
    "ranked_feed": """SELECT user_id, channel_id, article_id, row_number() OVER (
        PARTITION BY user_id, channel_id ORDER BY score DESC NULLS LAST, article_id) AS rank
        FROM (SELECT c.user_id, c.channel_id, c.article_id, CASE WHEN u.weights IS NOT NULL THEN
                round(1e0 / (1e0 + exp(-(coalesce(a.channel_id + list_sum(a.w) + list_sum(a.v), 0)
                                         + list_sum(u.weights)) / 100e0)), 8) END AS score
              FROM recalled c LEFT JOIN article_feats a USING (article_id)
              LEFT JOIN user_feats u ON u.user_id = c.user_id AND u.channel_id = c.channel_id
              WHERE NOT EXISTS (SELECT 1 FROM served s WHERE s.user_id = c.user_id
                AND s.article_id = c.article_id AND s.channel_id IN (0, c.channel_id)))""",
    "orders_in": "SELECT o_custkey, o_orderdate, o_orderkey FROM orders",
}

_SAMPLE_VIEW = """SELECT user_id, article_id, channel_id, CAST(1 + len(v) + 20 AS BIGINT) AS n,
    round(list_sum(v), 5) AS vector, round(list_sum(u), 5) AS "user", round(list_sum(w), 4) AS article,
    clicked FROM samples"""

QUERIES: dict[str, str] = {
    "actions_scan": """SELECT user_id, action_time, channel_id, action,
        CASE WHEN action = 'exposure' THEN concat_ws(',', k, (k + 1) % 100, (k + 7) % 100)
             ELSE k::VARCHAR END AS article_ids, 'C2' AS algorithm
        FROM log WHERE CAST(action_time AS DATE) <= DATE '2024-01-20'""",
    "exposure_flags": """SELECT user_id, channel_id, article_id, count(*) AS n, CAST(sum(shared::INT) AS BIGINT) AS shared,
        CAST(sum(clicked::INT) AS BIGINT) AS clicked, CAST(sum(collected::INT) AS BIGINT) AS collected,
        count(*) AS exposure FROM flags GROUP BY user_id, channel_id, article_id""",
    "user_article_basic": "SELECT * FROM fold",
    "action_merge": "SELECT * FROM fold",
    "interest_weights": "SELECT user_id, channel_id, topic, round(weight, 6) AS weight FROM interests",
    "interest_by_day": f"""SELECT day, user_id, channel_id, topic, round(sum(score), 6) AS weight FROM (
        SELECT n.day, f.user_id, t.channel_id, t.keyword AS topic,
          1e0 / (ln(floor(epoch(CAST(n.day AS TIMESTAMP) - action_time) / 86400) + 1e0) + 1e0)
          * (3 * shared::INT + 5 * clicked::INT + 2 * collected::INT
             + CASE WHEN coalesce(read_time, 0) > {I.READ_THRESHOLD} THEN 2 ELSE 1 END) AS score
        FROM fold f JOIN tfidf t USING (article_id), (SELECT unnest({I.INTEREST_DAYS}) AS day) n)
        GROUP BY ALL""",
    "interest_map": "SELECT user_id, channel_id, topic, round(weight, 6) AS weight FROM interests",
    "interest_top10": """SELECT user_id, channel_id, topic, weight, rank FROM (
        SELECT user_id, channel_id, topic, round(weight, 6) AS weight, row_number() OVER (
          PARTITION BY user_id ORDER BY round(weight, 6) DESC, channel_id, topic) AS rank FROM interests)
        WHERE rank <= 10""",
    "profile_basics": """SELECT user_id, gender, CAST(coalesce(
          2024 - year(born) - (month(born) * 100 + day(born) > 228)::INT, 0) AS BIGINT) AS age
        FROM (SELECT c_custkey AS user_id, c_mktsegment < 'HOUSEHOLD' AS gender, CASE WHEN c_custkey % 11 <> 0
          THEN DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) END AS born FROM customer)""",
    "window_merge": """SELECT o_orderkey AS article_id, c_nationkey AS channel_id, n_name AS channel_name,
        concat_ws(',', n_name, o_orderpriority, '<p>' || o_orderkey || '</p>') AS sentence
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
        WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'""",
    "strip_html": """SELECT page_id, length(t) AS n_chars, md5(t) AS digest FROM (
        SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS t FROM pages)""",
    "tokens": """SELECT article_id, channel_id, CAST(len(words) AS BIGINT) AS n,
        md5(array_to_string(words, ' ')) AS digest FROM words""",
    "term_counts": """SELECT d.article_id, count(keyword) AS n_terms,
        md5(coalesce(string_agg(keyword || ':' || tf, ',' ORDER BY keyword), '')) AS digest
        FROM docs d LEFT JOIN tf USING (article_id) GROUP BY d.article_id""",
    "idf_table": "SELECT keyword, round(idf, 6) AS idf, idx FROM idf",
    "idf_hours": "SELECT keyword, round(idf, 6) AS idf, idx FROM idf",
    "tfidf_top20": "SELECT article_id, channel_id, keyword, tfidf FROM tfidf",
    "textrank_top20": "SELECT article_id, channel_id, keyword, textrank FROM ranked",
    "keyword_weights": "SELECT article_id, channel_id, keyword, round(weight, 5) AS weight FROM weighted",
    "article_topics": """SELECT article_id, string_agg(keyword, ',' ORDER BY keyword) AS topics
        FROM topic_terms GROUP BY article_id""",
    "global_topics": """SELECT article_id, string_agg(keyword, ',' ORDER BY keyword) AS topics FROM tfidf
        WHERE keyword IN (SELECT keyword FROM ranked) GROUP BY article_id""",
    "article_profile": """SELECT article_id, channel_id, keywords, weight, topics FROM (
          SELECT article_id, channel_id, string_agg(keyword, ',' ORDER BY keyword) AS keywords,
                 round(sum(weight), 4) AS weight FROM weighted GROUP BY article_id, channel_id)
        JOIN (SELECT article_id, string_agg(keyword, ',' ORDER BY keyword) AS topics
              FROM topic_terms GROUP BY article_id) USING (article_id)""",
    "word2vec_vocabulary": """SELECT channel_id, keyword, CAST(100 AS BIGINT) AS dims FROM tf
        GROUP BY channel_id, keyword HAVING sum(tf) >= 3""",
    "article_vector_mean": f"""SELECT article_id, channel_id, CAST(len(v) AS BIGINT) AS dims,
        round(v[1], 6) AS first, round(v[{I.DIM}], 6) AS last, round(list_sum(v), 5) AS total FROM article_mean""",
    "similar_top10": _similar("hashed", "hashed", I.LSH),
    "nearest_top10": "SELECT * FROM near",
    "nearest_indexed": _nearest("article_mean", "vectors", I.LSH_NEW["threshold"]),
    "similar_incremental": _similar("hashed_new", "hashed_known", I.LSH_NEW),
    "similar_topn": """SELECT article_id, similar_id, distance, rank FROM near
        WHERE rank <= 3 AND article_id IN (SELECT article_id FROM docs)""",
    "content_recall": """SELECT DISTINCT f.user_id, f.channel_id, n.similar_id AS article_id
        FROM fold f JOIN near n USING (article_id) WHERE f.clicked AND NOT EXISTS (
          SELECT 1 FROM earlier e WHERE e.user_id = f.user_id AND e.channel_id = f.channel_id
          AND e.article_id = n.similar_id)""",
    "history_anti": "SELECT * FROM later EXCEPT SELECT * FROM earlier",
    "dense_ids": """SELECT 'l_orderkey' AS key, count(DISTINCT l_orderkey) AS n, count(DISTINCT l_orderkey) AS n_idx,
          count(DISTINCT l_orderkey) - 1 AS max_idx FROM lineitem
        UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey), count(DISTINCT l_partkey),
          count(DISTINCT l_partkey) - 1 FROM lineitem""",
    "inner_top10": """WITH f AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1000)) AS v FROM embeddings)
        SELECT user_id, article_id, score, rank FROM (SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY score DESC, article_id) AS rank
          FROM (SELECT q.vec_id AS user_id, i.vec_id AS article_id, list_dot_product(q.v, i.v) AS score FROM f q, f i))
        WHERE rank <= 10""",
    "als_factor_checks": """SELECT user_id, least(20, (SELECT count(DISTINCT article_id) FROM fold)) AS n,
        TRUE AS products, TRUE AS beats_zeros, TRUE AS clicks_higher FROM fold GROUP BY user_id""",
    "als_recall_checks": """SELECT DISTINCT user_id, TRUE AS few, TRUE AS known, TRUE AS fresh, TRUE AS falling FROM fold""",
    "hot_top10": "SELECT channel_id, article_id, score, rank FROM hot",
    "hot_parts": """SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY channel_id ORDER BY score DESC, article_id) AS rank FROM (
          SELECT o_orderstatus AS channel_id, l_partkey AS article_id, count(*) AS score
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)) WHERE rank <= 10""",
    "new_articles": """SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY channel_id ORDER BY arrived DESC, article_id) AS rank FROM arrived) WHERE rank <= 10""",
    "read_recall": "SELECT * FROM stored_all WHERE recall_type IN ('als', 'online')",
    "recall_union": """SELECT user_id, channel_id,
        CASE WHEN left(md5(user_id::VARCHAR), 1) IN ('e', 'f') THEN 'Algo-2' ELSE 'Algo-1' END AS strategy,
        article_id, array_to_string(sources, ',') AS sources FROM recalled""",
    "recall_union_all": """SELECT user_id, channel_id,
        CASE WHEN left(md5(user_id::VARCHAR), 1) IN ('e', 'f') THEN 'Algo-2' ELSE 'Algo-1' END AS strategy,
        article_id, array_to_string(sources, ',') AS sources FROM recalled_all""",
    "served_bitmaps": """SELECT user_id, channel_id, CASE WHEN article_id > 0 THEN 1 + (article_id - 1) // 32768 ELSE 0 END AS part,
        count(DISTINCT article_id) AS n_articles FROM served_all GROUP BY ALL""",
    "bought_bitmaps": """SELECT o_custkey AS user_id, o_orderstatus AS channel_id,
        CASE WHEN l_partkey > 0 THEN 1 + (l_partkey - 1) // 32768 ELSE 0 END AS part,
        count(DISTINCT l_partkey) AS n_articles FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "unseen_candidates": """SELECT user_id, channel_id, article_id FROM recalled_all c WHERE NOT EXISTS (
        SELECT 1 FROM served_all s WHERE s.user_id = c.user_id AND s.article_id = c.article_id
        AND s.channel_id IN (0, c.channel_id))""",
    "timely_samples": """WITH days AS (SELECT user_id, CAST(action_time AS DATE) AS d, count(*) AS a,
            count(*) FILTER (action = 'click') AS c FROM log GROUP BY ALL),
          versions AS (SELECT user_id, CAST(d + 1 AS TIMESTAMP) AS valid_from,
            CAST(sum(c) OVER w AS BIGINT) AS n_clicks, CAST(sum(a) OVER w AS BIGINT) AS n_actions
            FROM days WINDOW w AS (PARTITION BY user_id ORDER BY d))
        SELECT l.user_id, l.action_time, l.channel_id, CAST(l.action = 'click' AS INTEGER) AS clicked,
          v.valid_from, v.n_clicks, v.n_actions
        FROM log l ASOF LEFT JOIN versions v ON v.user_id = l.user_id AND v.valid_from <= l.action_time""",
    "user_features": """SELECT user_id, channel_id, CAST(len(weights) AS BIGINT) AS n,
        round(list_sum(weights), 5) AS total FROM user_feats""",
    "article_features": """SELECT article_id, channel_id, CAST(11 + len(v) AS BIGINT) AS n,
        channel_id::DOUBLE AS channel, round(list_sum(w), 4) AS weights, round(list_sum(v), 5) AS vector
        FROM article_feats""",
    "ctr_samples": _SAMPLE_VIEW,
    "ctr_samples_strict": _SAMPLE_VIEW + " WHERE NOT profiled OR len(raw) = 10",
    "feature_means": """SELECT user_id, article_id, channel_id, round(list_avg(v), 6) AS vector_mean,
        round(list_avg(u), 6) AS user_mean, round(list_avg(w), 6) AS article_mean, clicked FROM samples""",
    "export_samples": f"""SELECT clicked AS label, count(*) AS n,
        CAST(sum({I.DIM + 21}) AS BIGINT) AS n_values FROM samples GROUP BY clicked""",
    "ctr_model_checks": """SELECT count(*) AS n, round(avg(clicked), 6) AS click_rate, TRUE AS calibrated,
        TRUE AS probabilities, TRUE AS better_than_constant, TRUE AS clicks_rank_higher FROM samples""",
    "auc_accuracy": """SELECT round((sum(CASE WHEN label = 1 THEN rk END)
            - sum(label) * (sum(label) + 1) / 2e0) / (sum(label) * sum(1 - label)), 6) AS auc,
          round(avg(CASE WHEN (score >= 0.5)::INT = label THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n
        FROM (SELECT label, score, rank() OVER (ORDER BY score)
                + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk FROM label_scores)""",
    "roc_curve": """SELECT round(score, 8) AS threshold,
          round(sum(neg) OVER (ORDER BY score DESC) / sum(neg) OVER (), 6) AS fpr,
          round(sum(pos) OVER (ORDER BY score DESC) / sum(pos) OVER (), 6) AS tpr
        FROM (SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
              FROM label_scores GROUP BY 1)""",
    "ab_bucket": """SELECT user_id, bucket, strategy, unnest(['als', 'content', 'online', 'new', 'hot']) AS source,
          CASE strategy WHEN 'Algo-1' THEN 'LR' ELSE 'WDL' END AS sort
        FROM (SELECT *, CASE WHEN bucket IN ('e', 'f') THEN 'Algo-2' ELSE 'Algo-1' END AS strategy
              FROM (SELECT c_custkey AS user_id, left(md5(c_custkey::VARCHAR), 1) AS bucket FROM customer))""",
    "feed_split": f"""SELECT user_id, channel_id, CAST({I.REQUEST_MS} AS BIGINT) AS request_ts, rank AS pos, article_id
        FROM ranked_feed WHERE rank <= {I.ARTICLE_NUM}""",
    "wait_split": f"""SELECT user_id, channel_id, rank - {I.ARTICLE_NUM} AS pos, article_id
        FROM ranked_feed WHERE rank > {I.ARTICLE_NUM}""",
    "serve_waiting": f"""SELECT user_id, channel_id, time_stamp, CASE WHEN opened THEN n ELSE pos0 END AS pos, article_id,
          CASE WHEN opened AND n <= {I.ARTICLE_NUM} THEN 'served' WHEN opened OR level = 0 THEN 'cached'
               ELSE 'waiting' END AS state
        FROM (SELECT *, n <= 3 AND level = min(level) OVER (PARTITION BY user_id, channel_id) AS opened
          FROM (SELECT *, row_number() OVER (
                  PARTITION BY user_id, channel_id ORDER BY level, pos0, article_id) AS n
                FROM (SELECT user_id, channel_id, article_id AS pos0, article_id, 1 AS level FROM later
                      UNION ALL SELECT user_id, channel_id, pos, article_id, 0 FROM served
                      WHERE (user_id, channel_id, request_ts) IN (
                        SELECT (user_id, channel_id, max(request_ts)) FROM served GROUP BY user_id, channel_id))))
        JOIN requests USING (user_id, channel_id)""",
    "serve_lines": f"""WITH asks AS (SELECT *, max(ts) OVER (PARTITION BY user_id, channel_id) AS newest,
            {I.ARTICLE_NUM} * (row_number() OVER (PARTITION BY user_id, channel_id ORDER BY ts) - 1) AS before
          FROM (SELECT DISTINCT user_id, channel_id,
            CAST(date_diff('day', DATE '1970-01-01', CAST(action_time AS DATE)) AS BIGINT) * 86400000 AS ts FROM log)),
          list AS (SELECT *, row_number() OVER (PARTITION BY user_id, channel_id ORDER BY article_id) AS n
            FROM (SELECT * FROM earlier UNION SELECT * FROM later)),
          lines AS (SELECT DISTINCT user_id, channel_id, newest FROM asks)
        SELECT l.user_id, l.channel_id, coalesce(a.ts, newest) AS time_stamp,
          CASE WHEN n <= 5 THEN n ELSE article_id END AS pos, article_id,
          CASE WHEN a.ts IS NOT NULL THEN 'served' WHEN n <= 5 THEN 'cached' ELSE 'waiting' END AS state
        FROM list l JOIN lines USING (user_id, channel_id) LEFT JOIN (SELECT user_id, channel_id, ts, before FROM asks) a
          ON a.user_id = l.user_id AND a.channel_id = l.channel_id AND n <= 5
          AND n > before AND n <= before + {I.ARTICLE_NUM}""",
    "last_served": "SELECT user_id, channel_id, max(request_ts) AS last_ts FROM served_all GROUP BY user_id, channel_id",
    "refresh_or_history": """SELECT r.user_id, r.channel_id, coalesce(s.last_ts, 0) AS last_ts,
          CASE WHEN coalesce(s.last_ts, 0) < 1704844800000 THEN 'refresh' ELSE 'history' END AS route
        FROM requests r LEFT JOIN (SELECT user_id, channel_id, max(request_ts) AS last_ts
          FROM served_all GROUP BY user_id, channel_id) s USING (user_id, channel_id)""",
    "history_page": """WITH pages AS (SELECT user_id, channel_id, request_ts,
            string_agg(article_id::VARCHAR, ',' ORDER BY pos) AS articles FROM served_all GROUP BY ALL),
          asks AS (SELECT DISTINCT user_id, channel_id,
            unnest([request_ts, request_ts + 3600000, 1]) AS time_stamp FROM pages)
        SELECT a.user_id, a.channel_id, a.time_stamp,
          coalesce((SELECT articles FROM pages p WHERE p.user_id = a.user_id AND p.channel_id = a.channel_id
            AND p.request_ts = a.last_ts), '') AS articles,
          coalesce((SELECT max(request_ts) FROM pages p WHERE p.user_id = a.user_id
            AND p.channel_id = a.channel_id AND p.request_ts < a.last_ts), 0) AS next_ts
        FROM (SELECT *, (SELECT max(request_ts) FROM pages p WHERE p.user_id = asks.user_id
            AND p.channel_id = asks.channel_id AND p.request_ts <= asks.time_stamp) AS last_ts FROM asks) a""",
    "track_payload": f"""SELECT user_id, channel_id, time_stamp,
          CASE WHEN channel_id = 0 THEN '' ELSE {_message(
              "exposure", "'[' || array_to_string(articles, ',') || ']'")} END AS param,
          to_json(list_transform(articles, lambda a: {{'article_id': a, 'param': {{{', '.join(
              f"'{x}': " + _message(x, 'a::VARCHAR') for x in ('click', 'collect', 'share', 'read'))}}}}}))::VARCHAR
            AS recommends, coalesce(lag(time_stamp) OVER (PARTITION BY user_id, channel_id ORDER BY time_stamp), 0) AS next_ts
        FROM (SELECT user_id, channel_id, request_ts AS time_stamp, list(article_id ORDER BY pos) AS articles,
                CASE WHEN left(md5(user_id::VARCHAR), 1) IN ('e', 'f') THEN 'Algo-2' ELSE 'Algo-1' END AS strategy
              FROM served_all GROUP BY user_id, channel_id, request_ts)""",
    "latest_upsert": """SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders_in) WHERE rn = 1""",
    "version_read": """SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS version
        FROM orders_in WHERE o_orderdate < TIMESTAMP '1998-01-01') WHERE version <= 3""",
    "delete_keys": """SELECT c_custkey AS o_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
    "append_read": """SELECT CAST(action_time AS DATE) AS dt, channel_id, count(*) AS n
        FROM log GROUP BY 1, 2""",
    "remap_ids": """SELECT CAST(CASE article_id WHEN 3 THEN 1 WHEN 14 THEN 2 WHEN 15 THEN 3 WHEN 92 THEN 4
          WHEN 65 THEN 5 WHEN 35 THEN 6 WHEN 89 THEN 7 WHEN 79 THEN 8 WHEN 32 THEN 9 ELSE 10 END AS INTEGER) AS article_id,
        count(*) AS n, CAST(sum(clicked::INT) AS BIGINT) AS clicks FROM fold GROUP BY 1""",
    "stream_hot": "SELECT channel_id, article_id, score FROM hot_scores",
    "stream_new": "SELECT channel_id, article_id, arrived FROM arrived",
    "stream_recall": """SELECT DISTINCT l.user_id, l.channel_id, n.similar_id AS article_id
        FROM log l JOIN near n ON n.article_id = l.k WHERE l.action IN ('click', 'collect', 'share')""",
    "stream_recall_state": """SELECT DISTINCT l.user_id, l.channel_id, n.similar_id AS article_id
        FROM log l JOIN near n ON n.article_id = l.k WHERE l.action IN ('click', 'collect', 'share')""",
}


def _needed(sql: str) -> list[str]:
    """Parts used by ``sql``, dependencies first."""
    names = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
    out: list[str] = []
    for name, part in PARTS.items():
        if name in names and re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
            for dep in _needed(part):
                if dep not in out:
                    out.append(dep)
            if name not in out:
                out.append(name)
    return out


def sql() -> dict[str, str]:
    built = {}
    for name, body in QUERIES.items():
        parts = ",\n".join(f"{p} AS MATERIALIZED ({PARTS[p]})" for p in _needed(body))
        if parts and body.startswith("WITH "):
            built[name] = f"WITH {parts},\n{body[5:]}"
        else:
            built[name] = f"WITH {parts}\n{body}" if parts else body
    return built
