"""The registered queries of this subpackage and the SQL that some of them are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.llm import (collocations, exact, language, merkle, packing, pii, quality,
                           sentencepiece_codec, setsketch, substring, suffix, tokens, topk)
from matchlens.llm.columns import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False)


def op4_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_groups(table(spark, sf_dir, "documents"), shingle=3,
                                 percent=85).drop("text_key")


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).drop("text_key")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"))


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(table(spark, sf_dir, "documents"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, claims=merkle.tampered(docs))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_sentencepiece, op3_packing, op4_near, op5_exact, op6_pii, op7_substring,
    op8_suffix, op9_tokens, op10_topk, op11_collocations, op12_manifest, op13_language)}

SQL = {
    "op4_near": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1),
                            lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
            FROM words),
        items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
               doc_id = component_id AS kept
        FROM sets JOIN least USING (doc_id)""",
    "op5_exact": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op7_substring": """
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        starts AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words13 FROM starts),
        repeated AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, min(doc_id) OVER (PARTITION BY words13) AS first_id
                FROM windows) WHERE first_id < doc_id),
        covered AS (
            SELECT DISTINCT doc_id, p FROM (
                SELECT doc_id, unnest(range(i, i + 13)) AS p FROM repeated)),
        gone AS (
            SELECT doc_id, list(p) AS places, count(*) AS n FROM covered GROUP BY doc_id)
        SELECT w.doc_id, len(w.w) AS n_words, coalesce(g.n, 0) AS n_removed,
               sha256(CASE WHEN g.n IS NULL THEN array_to_string(w.w, ' ')
                      ELSE array_to_string(list_filter(w.w,
                               lambda x, i: NOT list_contains(g.places, i)), ' ') END)
                   AS kept_sha256
        FROM words w LEFT JOIN gone g USING (doc_id)""",
    "op10_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding,
                       lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))
                        AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id
                       ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scores)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
                       coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        words AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        lengths AS (SELECT unnest(range(1, 6)) AS k),
        spots AS (
            SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
            FROM words, lengths WHERE len(w) >= k),
        phrases AS (
            SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS f
            FROM spots GROUP BY ALL HAVING count(*) >= 100),
        whole AS (
            SELECT DISTINCT s.lang, s.p FROM phrases s JOIN phrases q
            ON q.lang = s.lang AND q.k = s.k + 1 AND (q.p[:s.k] = s.p OR q.p[2:] = s.p)
               AND 100 * q.f >= 100 * s.f),
        cuts AS (
            SELECT lang, k, p, f, unnest(range(1, k)) AS c FROM phrases
            WHERE k >= 2 AND (lang, p) NOT IN (SELECT (lang, p) FROM whole)),
        scored AS (
            SELECT c.lang, array_to_string(c.p, ' ') AS phrase, c.f AS a, l.f AS l, r.f AS r, t.n,
                   c.c, CAST(CAST(1000 AS HUGEINT) * c.f * t.n
                             // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
            FROM cuts c JOIN phrases l ON l.lang = c.lang AND l.p = c.p[:c.c]
                 JOIN phrases r ON r.lang = c.lang AND r.p = c.p[c.c + 1:]
                 JOIN totals t ON t.lang = c.lang),
        lowest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
        SELECT lang, CAST(row_number() OVER (PARTITION BY lang
                   ORDER BY score DESC, a DESC, encode(phrase)) AS INTEGER) AS rank,
               phrase, a, l, r, n, score
        FROM lowest QUALIFY rank <= 2000""",
    "op12_manifest": """
        WITH RECURSIVE framed AS (
            SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS id_text,
                   CASE WHEN doc_id IS NULL THEN '-'
                        ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
                   || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
                   || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
                   CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail
            FROM documents),
        marked AS (
            SELECT *, 4294967295 - list_reduce(
                       list_concat([4294967295], flatten(list_transform(range(1, len(id_text) + 1),
                           lambda i: [CAST(ord(id_text[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
                       lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) AS crc
            FROM framed),
        leaves AS (
            SELECT doc_id, coalesce('=' || lang, '') AS g,
                   sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE
                          strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
                   sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE
                          strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END || tail)
                       AS changed,
                   crc % 7 = 0 AS tampered
            FROM marked),
        placed AS (
            SELECT *, CASE WHEN tampered THEN changed ELSE leaf END AS claimed,
                   row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
                   count(*) OVER (PARTITION BY g) AS n
            FROM leaves),
        nodes AS (
            SELECT g, 0 AS lvl, p, n, leaf AS h FROM placed
            UNION ALL
            SELECT g, lvl + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p))
            FROM nodes WHERE n > 1 GROUP BY g, lvl, n, p // 2),
        tops AS (
            SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS p, count(*) OVER () AS n
            FROM nodes WHERE n = 1),
        top_nodes AS (
            SELECT 0 AS lvl, p, n, h FROM tops
            UNION ALL
            SELECT lvl + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p))
            FROM top_nodes WHERE n > 1 GROUP BY lvl, n, p // 2),
        walk AS (
            SELECT g, p AS start, 0 AS lvl, p, n, claimed AS c, '' AS siblings FROM placed
            UNION ALL
            SELECT w.g, w.start, w.lvl + 1, w.p // 2, (w.n + 1) // 2,
                   CASE WHEN s.h IS NULL THEN sha256(w.c) WHEN w.p % 2 = 1 THEN sha256(s.h || w.c)
                        ELSE sha256(w.c || s.h) END,
                   w.siblings || coalesce(s.h, '')
            FROM walk w LEFT JOIN nodes s ON s.g = w.g AND s.lvl = w.lvl
                 AND s.p = CASE WHEN w.p % 2 = 1 THEN w.p - 1 ELSE w.p + 1 END
            WHERE w.n > 1),
        top_walk AS (
            SELECT w.g, w.start, 0 AS lvl, t.p, t.n, w.c, w.siblings
            FROM walk w JOIN tops t ON t.g = w.g WHERE w.n = 1
            UNION ALL
            SELECT w.g, w.start, w.lvl + 1, w.p // 2, (w.n + 1) // 2,
                   CASE WHEN s.h IS NULL THEN sha256(w.c) WHEN w.p % 2 = 1 THEN sha256(s.h || w.c)
                        ELSE sha256(w.c || s.h) END,
                   w.siblings || coalesce(s.h, '')
            FROM top_walk w LEFT JOIN top_nodes s ON s.lvl = w.lvl
                 AND s.p = CASE WHEN w.p % 2 = 1 THEN w.p - 1 ELSE w.p + 1 END
            WHERE w.n > 1)
        SELECT d.doc_id, d.leaf, t.h AS subroot, r.h AS root, sha256(w.siblings) AS proof_sha256,
               w.c AS folded_root, w.c = r.h AS verified
        FROM placed d JOIN top_walk w ON w.g = d.g AND w.start = d.p AND w.n = 1
             JOIN tops t ON t.g = d.g CROSS JOIN (SELECT h FROM top_nodes WHERE n = 1) r""",
}
